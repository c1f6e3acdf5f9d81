"""Type-2 snapshots laid out so that a load touches what it changes.

A snapshot is a live table partitioned by ranges of its key's hash, open
versions apart from closed ones. A load reads the open versions of the ranges
that its keys fall into, compares, and replaces those ranges; where versions are
closed it also replaces the closed part of their ranges, in the same write. All
other files stay as they are, and history that no key of the load belongs to is
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.joins import staged, written
from blotter.operators.snapshot import VALID_TO, snapshot_check
from blotter.sources.store import PART, TableStore


def key_range(keys: list[str], ranges: int) -> Column:
    """Range of the key's hash: 0 .. ranges - 1."""
    return F.pmod(F.xxhash64(*keys), F.lit(ranges))


def snapshot_part(keys: list[str], ranges: int) -> Column:
    """Partition of a version: its key's range, closed ones after all open ones."""
    return key_range(keys, ranges) + F.when(F.col(VALID_TO).isNotNull(), ranges).otherwise(0)


def advance_snapshot(store: TableStore, schema: str, name: str, incoming: DataFrame, keys: list[str],
                     check_cols: list[str], load_ts, watermark, key_covers_checks: bool = False) -> DataFrame:
    """Apply one snapshot run of ``incoming`` (one row per key; see
    ``snapshot_check``) to the snapshot table ``name``, made if there is none.
    A run that was interrupted is run again with the same rows and stamp. Where
    the key is made of the compared columns (``key_covers_checks``) no version is
    ever closed, so none is looked for."""
    known = store.meta(schema, name)
    ranges = int((known or {}).get("hash_parts") or store.hash_parts)
    part = snapshot_part(keys, ranges)
    if known is None:
        first = snapshot_check(None, incoming, keys, check_cols, load_ts)
        return store.write_live(first, schema, name, [], watermark, part=part)
    incoming, n = staged(incoming, f"{name}_incoming")
    touched = [r[0] for r in incoming.select(key_range(keys, ranges)).distinct().collect()]
    table = store.read_live(schema, name)
    compared = snapshot_check(table.filter(F.col(PART).isin(touched)).drop(PART), incoming, keys, check_cols,
                              load_ts, incoming_rows=n)
    if key_covers_checks:
        return store.write_live(compared, schema, name, [], watermark, part=part, parts=sorted(touched))
    versions = written(compared, f"{name}_versions")
    closing = versions.filter(F.col(VALID_TO).isNotNull())
    closed = [r[0] for r in closing.select(part).distinct().collect()]
    if closed:
        versions = versions.unionByName(table.filter(F.col(PART).isin(closed)).drop(PART))
    return store.write_live(versions, schema, name, [], watermark, part=part, parts=sorted([*touched, *closed]))
