"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir), calls one
operator on all of ``docs`` and applies its decisions. All but the last return
the columns of ``docs``.

For every stage: a null text counts as empty; ids may be null or repeat, since
decisions come back by a key of id, text and source; equal rows stand for each
other, as many stay as the operator keeps; texts of any length are used whole
(keys hold a digest); ties go as the operator says; columns that the operators
use inside may exist in ``docs`` under any name; an empty table gives an empty
result with the same columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, cut, read, with_small_side
from .exact_dedup import exact_dedup
from .mixing import mix_blocks
from .packing import pack
from .quality import THRESHOLD, fit_quality, quality_score
from .simhash import simhash_dedup

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _fresh(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def _key() -> Column:
    """What decisions are brought back by: the id (null last), then a digest of
    text and source, so a key has a fixed size. Rows with equal keys are alike,
    and any of them may stand for another."""
    mark = F.when(F.col("text").isNull(), "n").otherwise("t")
    source = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    whole = F.concat(mark, F.coalesce("text", F.lit("")), F.lit("\0"), source)
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"),
                    F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"))


def _one_of_each(docs: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """One row of ``docs`` for each key of ``wanted(<key>, n)``; n is how many
    rows have it."""
    rows = docs.join(with_small_side(wanted.select(key)), key, "left_semi")
    many = wanted.filter("n > 1").select(key)
    if many.isEmpty():
        return rows
    return rows.join(many, key, "left_anti").unionByName(
        rows.join(many, key, "left_semi").dropDuplicates([key]))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Null and empty texts are scored
    like any other text; equal texts have equal scores."""
    net = fit_quality(docs, read(spark, sf_dir, "labels"))
    return docs.filter(quality_score(net, F.col("text")) >= THRESHOLD)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the longest, then the one with the smallest id stays (null
    ids last, then the smallest digest). All texts without words are equal."""
    key = _fresh(docs, "_key")
    keyed = docs.withColumn(key, _key())
    found = cut(exact_dedup(keyed, id_col=key).select(F.col("doc_id").alias(key), "keep_id"), "exact_decisions")
    rows = found.groupBy(key).agg(F.count("*").alias("n"), F.max(F.col(key) == F.col("keep_id")).alias("kept"))
    return _one_of_each(keyed, key, cut(rows.filter("kept").drop("kept"), "exact_kept")).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents, the one with the smallest id stays (null ids last,
    then the smallest digest). Texts without words have fingerprint zero and
    link with each other."""
    key = _fresh(docs, "_key")
    keyed = docs.withColumn(key, _key())
    found = cut(simhash_dedup(keyed, id_col=key).select(F.col("doc_id").alias(key), "component_id"),
                "near_decisions")
    kept = found.filter(F.col(key) == F.col("component_id")).groupBy(key).agg(F.count("*").alias("n"))
    return _one_of_each(keyed, key, cut(kept, "near_kept")).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each pass in which the mix takes words of a document: the
    whole document, or its first words where a source's target ends inside.
    Documents that are not taken go, those without words among them; a null
    source is a source of its own."""
    key = _fresh(docs, "_key")
    keyed = docs.withColumn(key, _key())
    rows, pieces = mix_blocks(keyed, id_col=key)
    taken = pieces.groupBy("row", "pass").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("words"))
    words, part = _fresh(docs, "_words"), _fresh(docs, "_part")
    copies = cut(rows.select("row", F.col("doc_id").alias(key), "size").join(taken, "row").select(
        key, F.col("words").alias(words), (F.col("words") < F.col("size")).alias(part)), "mix_copies")
    counts = cut(rows.groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n"))
                 .join(copies.select(key).distinct(), key, "left_semi"), "mix_rows")
    tokens = F.split("text", f"(?<={WORD[:-1]})(?={WORD[:-1].replace('^', '')})")
    text = F.when(F.col(part), F.array_join(F.slice(tokens, F.lit(1), F.col(words).cast("int")), "")) \
        .otherwise(F.col("text"))
    out = _one_of_each(keyed, key, counts).join(with_small_side(copies, 500_000), key).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(part), F.char_length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-budget batches of sequences. Documents without words have none."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("source_mix", mix),
    ("packing", packing),
]
