"""Upsert, change detection, schema sync and first-seen stamps on plain tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.incremental import ts_literal
from blotter.operators.joins import DEFAULT_BROADCAST_ROWS, fits_broadcast, staged


class DuplicateKeyError(ValueError):
    pass


def rows_differ(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any pair differs, null-safely (``IS DISTINCT FROM``)."""
    if not pairs:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [~a.eqNullSafe(b) for a, b in pairs])


def assert_unique_keys(df: DataFrame, keys: list[str], what: str = "source") -> None:
    """Fail when a non-null key occurs twice (a MERGE source must be unique).

    Aggregates the keys of ``df`` only (partial aggregation before the shuffle)
    and fetches at most one offending key.
    """
    dup = (df.select(*keys).dropna(how="any").groupBy(*keys).count()
           .filter(F.col("count") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"{what} has duplicate key {dup[0].asDict()}")


_WIDENING = {
    (T.IntegerType, T.LongType), (T.ShortType, T.IntegerType), (T.ShortType, T.LongType),
    (T.ByteType, T.ShortType), (T.ByteType, T.IntegerType), (T.ByteType, T.LongType),
    (T.FloatType, T.DoubleType), (T.IntegerType, T.DoubleType), (T.LongType, T.DoubleType),
    (T.DateType, T.TimestampNTZType),
}


def sync_columns(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Project ``target`` onto ``incoming``'s columns, in ``incoming``'s order.

    New columns are null for old rows; columns gone from ``incoming`` are
    dropped; a type change is allowed only when it widens, else it raises.
    """
    tfields = {f.name: f.dataType for f in target.schema.fields}
    out = []
    for f in incoming.schema.fields:
        if f.name not in tfields:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        old = tfields[f.name]
        if old != f.dataType and (type(old), type(f.dataType)) not in _WIDENING:
            raise TypeError(f"column {f.name}: {old.simpleString()} cannot become "
                            f"{f.dataType.simpleString()}")
        out.append(F.col(f.name).cast(f.dataType).alias(f.name) if old != f.dataType
                   else F.col(f.name))
    return target.select(*out)


def merge_upsert(target: DataFrame | None, source: DataFrame, keys: list[str],
                 update_cols: list[str] | None = None,
                 change_cols: list[str] | None = None,
                 with_action: bool = False,
                 check_unique: bool = True,
                 source_rows: int | None = None,
                 broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                 insert_partitioning: tuple[int, list[str]] | None = None) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``keys`` and return the new table.

    * matched and changed -> ``update_cols`` (default: every non-key column) come
      from ``source``, the other columns stay; "changed" means any of
      ``change_cols`` differs null-safely (``None``: every matched row counts);
    * matched and unchanged -> target row as it was;
    * source row without a match -> inserted (a null key never matches);
    * target row without a match -> kept. There is no delete branch.

    The result has ``source``'s columns (sync the target first with
    ``sync_columns`` when the schema moved). ``with_action`` adds ``_action`` in
    ``insert / update / unchanged / keep``.

    A source without a known row count is written to the scratch folder first
    and counted there, so its plan runs once.

    Physical plan: when the source is small (at most
    ``broadcast_rows`` and within the broadcast byte bound) the target is never
    shuffled: it is streamed once past a broadcast of the source, and new keys
    are found by a key-only semi join. Otherwise one full outer sort-merge join
    on the keys; against a target bucketed on ``keys`` or some of them only the
    source is shuffled (into the target's buckets).

    When the target is a bucketed table, pass ``(bucket count, bucket
    columns)`` as ``insert_partitioning``: on the broadcast path the rewritten
    target rows stay in their bucket's task (the broadcast join streams the
    bucketed scan) and new rows are hash-partitioned the same way, so the
    result can be written bucketed without reshuffling the target.
    """
    cols = source.columns
    update_cols = [c for c in (update_cols if update_cols is not None else cols) if c not in keys]
    if source_rows is None and target is not None:
        source, source_rows = staged(source, "merge_source")
    if check_unique:
        assert_unique_keys(source, keys)
    if target is None:
        out = source
        return out.withColumn("_action", F.lit("insert")) if with_action else out
    target = target.select(*cols)

    t = target.select(*[F.col(c).alias(f"t__{c}") for c in cols], F.lit(True).alias("t__hit"))
    s = source.select(*[F.col(c).alias(f"s__{c}") for c in cols], F.lit(True).alias("s__hit"))
    on = reduce(lambda a, b: a & b, [F.col(f"t__{k}") == F.col(f"s__{k}") for k in keys])

    if broadcast_merge(source_rows, source.schema, broadcast_rows):
        rewritten = t.join(F.broadcast(s), on, "left")
        hits = (target.select(*keys).join(F.broadcast(source.select(*keys)), keys, "left_semi"))
        inserts = source.join(F.broadcast(hits), keys, "left_anti")
        if insert_partitioning:
            n_buckets, bucket_cols = insert_partitioning
            inserts = inserts.repartition(n_buckets, *bucket_cols)
        merged = _resolve(rewritten, cols, keys, update_cols, change_cols)
        ins = inserts.select(*cols, F.lit("insert").alias("_action"))
        out = merged.unionByName(ins)
    else:
        if insert_partitioning and set(insert_partitioning[1]) <= set(keys):
            # Into the target's buckets, also where these are fewer than the
            # shuffle partitions or made of some of the keys only (Spark would
            # shuffle both sides).
            s = s.repartition(insert_partitioning[0], *[f"s__{k}" for k in insert_partitioning[1]])
        joined = t.join(s, on, "full_outer")
        out = _resolve(joined, cols, keys, update_cols, change_cols)
    return out if with_action else out.drop("_action")


def broadcast_merge(source_rows: int, schema: T.StructType,
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """Whether ``merge_upsert`` takes the broadcast (no target shuffle) path:
    the source is within the row bound and its estimated size within the
    byte bound."""
    return fits_broadcast(source_rows, schema, broadcast_rows)


def _resolve(joined: DataFrame, cols: list[str], keys: list[str],
             update_cols: list[str], change_cols: list[str] | None) -> DataFrame:
    t_hit, s_hit = F.col("t__hit").isNotNull(), F.col("s__hit").isNotNull()
    if change_cols is None:
        changed = F.lit(True)
    else:
        changed = rows_differ([(F.col(f"t__{c}"), F.col(f"s__{c}")) for c in change_cols])
    action = (F.when(~s_hit, F.lit("keep")).when(~t_hit, F.lit("insert"))
              .when(changed, F.lit("update")).otherwise(F.lit("unchanged")))
    j = joined.withColumn("_action", action)
    a = F.col("_action")
    out = []
    for c in cols:
        tc, sc = F.col(f"t__{c}"), F.col(f"s__{c}")
        if c in keys:
            v = F.when(a == "insert", sc).otherwise(tc)
        elif c in update_cols:
            v = F.when(a.isin("insert", "update"), sc).otherwise(tc)
        else:
            v = F.when(a == "insert", sc).otherwise(tc)
        out.append(v.alias(c))
    return j.select(*out, a)


def carry_first_seen(incoming: DataFrame, target: DataFrame | None, keys: list[str],
                     load_ts: dt.datetime | str, doe_col: str = "doe", dlu_col: str = "dlu",
                     broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Stamp ``incoming`` with first-seen ``doe`` (kept from ``target`` when the
    key exists there, else ``load_ts``) and last-update ``dlu = load_ts``.

    For a small increment the target is first semi-joined against a broadcast
    of the increment's keys, so only matching target rows are joined back.
    """
    stamp = ts_literal(load_ts)
    base = incoming.drop(doe_col, dlu_col)
    if target is None:
        return base.withColumn(doe_col, stamp).withColumn(dlu_col, stamp)
    existing = target.select(*keys, F.col(doe_col).alias("__doe"))
    base, n = staged(base, "first_seen")
    if fits_broadcast(n, base.select(*keys).schema, broadcast_rows):
        existing = existing.join(F.broadcast(base.select(*keys)), keys, "left_semi")
    joined = base.join(existing, keys, "left")
    return (joined.withColumn(doe_col, F.coalesce(F.col("__doe"), stamp))
            .withColumn(dlu_col, stamp).drop("__doe"))
