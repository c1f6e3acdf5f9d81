"""Exact dedup by deterministic block naming.

Every document's text is cut into blocks of a fixed number of bytes. Equal
blocks are brought together by sorting and receive one integer name (the
smallest occurrence number among them), then adjacent names are paired, equal
pairs are named in the same way, and so on until one name is left per
document. Names stand for contents, not for digests: two documents get the
same (number of blocks, name) exactly if their texts are equal.

Only DataFrame functions run here. The text itself is shuffled once; all later
rounds move integers.

Skew: occurrences of a block or pair that is more than 1/2000 of all repeated
occurrences are dealt to several salts first (at most 4,000 salted groups
exist, whatever the input), and the salts' names are merged afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITE, cut

#: A key with more than 1/HOT of all repeated occurrences is salted. At most
#: HOT keys can be that frequent, so their list is broadcast.
HOT = 2000


def _named(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Replace the columns ``keys`` by ``name``: one long per distinct key,
    the smallest ``occ`` among the rows that have it. ``occ`` is unique."""
    rows = rows.withColumn("_h", F.xxhash64(*keys))
    counts = cut(rows.groupBy("_h").count().filter("count > 1"), f"{label}_counts")
    repeated = counts.agg(F.sum("count")).first()[0] or 0
    share = max(1, repeated // HOT)
    hot = counts.filter(F.col("count") > share).select(
        "_h", F.ceil(F.col("count") / share).cast("long").alias("_salts"))
    salted = rows.join(F.broadcast(hot), "_h", "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64("occ"), F.col("_salts")), F.lit(0)))
    same = Window.partitionBy("_h", *keys, "_salt")
    first = salted.withColumn("_m", F.min("occ").over(same))
    # The first row of each salted group keeps its key for the merge below.
    leads = F.col("_salts").isNotNull() & (F.col("occ") == F.col("_m"))
    kept = [c for c in rows.columns if c not in (*keys, "_h")]
    part = cut(first.select(*kept, "_m", F.when(leads, F.struct("_h", *keys)).alias("_key")),
               f"{label}_names")
    key = part.filter(F.col("_key").isNotNull()).select("_m", "_key.*")
    both = ["_h", *keys]
    merged = key.groupBy(*both).agg(F.min("_m").alias("name"))
    moved = (key.join(merged, both).filter("_m <> name").select("_m", "name"))
    return (part.drop("_key").join(F.broadcast(moved), "_m", "left")
            .withColumn("name", F.coalesce("name", "_m")).drop("_m"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = 2048) -> DataFrame:
    """One row per input row: ``row_id, doc_id, keep_id, group_size, kept,
    text_sha256, n_chars``.

    Texts are equal when identical without white space; the row with the most
    code points in its original text stays, then the smallest id (null last),
    then the first row.

    Null texts count as empty, and all empty texts are one group. Ids may be
    null or repeat: every row is a document of its own, and exactly one row of
    a group is kept. Very long texts only have more blocks. Other columns are
    not read, so their names do not matter. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col(id_col).alias("doc_id"),
        F.char_length(text).alias("n_chars"),
        F.translate(text, WHITE, "").cast("binary").alias("norm"),
    )
    blocks = base.select(
        "row_id", "doc_id", "n_chars", F.sha2("norm", 256).alias("text_sha256"),
        F.greatest(F.ceil(F.octet_length("norm") / block_bytes), F.lit(1)).cast("int").alias("n_blocks"),
        "norm",
    ).select(
        "*", F.explode(F.expr(
            f"transform(sequence(0, n_blocks - 1), "
            f"i -> struct(i AS pos, substring(norm, i * {block_bytes} + 1, {block_bytes}) AS block))"
        )).alias("b"),
    ).select(
        "row_id", "n_blocks", F.col("b.pos").alias("pos"), F.col("b.block").alias("block"),
        F.when(F.col("b.pos") == 0, F.struct("doc_id", "n_chars", "text_sha256")).alias("doc"),
        F.monotonically_increasing_id().alias("occ"),
    )
    named = cut(_named(blocks, ["block"], "blocks"), "named_blocks")

    first = named.filter("pos = 0").select("row_id", "n_blocks", "doc.*")
    done = named.filter("n_blocks = 1").select("row_id", "name")
    level, width = named.filter("n_blocks > 1").select(
        "row_id", "pos", F.col("n_blocks").alias("width"), "name", "occ"), 1
    most = named.agg(F.max("n_blocks")).first()[0] or 1
    while width < most:
        width *= 2
        left, right = F.when(F.col("pos") % 2 == 0, F.col("name")), F.when(F.col("pos") % 2 == 1, F.col("name"))
        pairs = level.groupBy("row_id", F.expr("pos div 2").cast("int").alias("pos"),
                              F.expr("(width + 1) div 2").cast("int").alias("width")).agg(
            F.max(left).alias("l"), F.coalesce(F.max(right), F.lit(-1)).alias("r"),
            F.min("occ").alias("occ"))
        level = cut(_named(pairs, ["l", "r"], "pairs"), f"named_{width}")
        done = done.unionByName(level.filter("width = 1").select("row_id", "name"))
        level = level.filter("width > 1")

    whole = cut(first.join(done, "row_id"), "identities")
    best = F.min(F.struct((-F.col("n_chars")).alias("a"), F.col("doc_id").isNull().alias("b"),
                          F.col("doc_id").alias("keep_id"), F.col("row_id").alias("keep_row")))
    groups = cut(whole.groupBy("n_blocks", "name").agg(F.count("*").alias("group_size"), best.alias("k"))
                 .select("n_blocks", "name", "group_size", "k.keep_id", "k.keep_row"), "groups")
    return whole.join(groups, ["n_blocks", "name"]).select(
        "row_id", "doc_id", "keep_id", "group_size",
        (F.col("row_id") == F.col("keep_row")).alias("kept"), "text_sha256",
        F.col("n_chars").cast("long").alias("n_chars"))
