"""Registered queries of this folder: each applies one operator, with its
production parameters, to its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .embedding import embedding_dedup
from .exact_dedup import exact_dedup
from .filter_audit import COUNTS, audit_filters, filter_cells
from .fingerprints import fingerprint_edits
from .html import extract_main_text
from .licenses import scan_licenses
from .lm_score import lm_score
from .merkle import build_manifest, folded_root, leaf_digest, prove
from .mixing import mix_sources
from .packing import pack
from .paragraphs import SHINGLE, substring_dedup
from .quality import fit_quality, held_out, score_quality
from .simhash import simhash_dedup


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated span of five or more words, also inside one document;
    ``n_words`` is its length."""
    return substring_dedup(read(spark, sf_dir, "documents"), min_span=SHINGLE, across=False).select(
        "doc_id", "first_word", "n_words", "component_id", "n_units", "kept")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read(spark, sf_dir, "pages"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(read(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(read(spark, sf_dir, "embeddings"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    net = fit_quality(docs, read(spark, sf_dir, "labels"))
    return score_quality(docs, net).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents")).drop("row")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target set: the documents labelled as good."""
    good = read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_score(read(spark, sf_dir, "documents"), good)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = filter_cells(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return audit_filters(cells).select("part", "filter_order", "step", *COUNTS)


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, held against its row without line feeds where
    the unsigned crc32 of its id is even."""
    values = ["doc_id", "source", "lang", "n_chars", "text"]
    flat = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit("")))
    tampered = leaf_digest([*map(F.col, values[:-1]), F.coalesce(flat, F.col("text"))])
    manifest = build_manifest(read(spark, sf_dir, "documents"), values, payload={"now": tampered})
    found = prove(manifest, manifest.leaves.select("tree", "rank", "id", "node", "now"))
    text = lambda c: F.lower(F.hex(c))
    return found.withColumn("folded", folded_root(F.col("now"), F.col("proof"), F.col("steps"))).select(
        F.col("id").alias("doc_id"), text("node").alias("leaf"), text("subroot").alias("subroot"),
        text("root").alias("root"), F.sha2(text("proof"), 256).alias("proof_sha256"),
        text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_substring_dedup, op2_html_extraction, op3_simhash_dedup, op4_exact_dedup, op5_embedding_dedup,
             op6_license_scan, op7_quality_classifier, op8_packing, op9_source_mix, op10_lm_score,
             op11_filter_audit, op12_document_fingerprints, op13_merkle_manifest]
    return {f.__name__: f for f in found}


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER w = 1 AS kept
  FROM t
  WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM r
"""


OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT * FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(vec_id, root) AS (
  SELECT vec_id, vec_id FROM v
  UNION
  SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.vec_id)
SELECT v.vec_id, coalesce(n.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v
JOIN (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY 1) c ON c.vec_id = v.vec_id
LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY 1) n ON n.x = v.vec_id
"""


OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
f AS (
  SELECT part, doc_id,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(x, '[A-Z]')) > 2 * length(x) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS pattern
  FROM t),
marks AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, pattern, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN marks USING (doc_id) GROUP BY part, pattern),
letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, CAST(s AS INT) AS step, l.l AS letter, l.bit AS bit,
         (SELECT coalesce(sum(p.bit), 0) FROM letters p
          WHERE contains(substr(filter_order, 1, CAST(s AS INT) - 1), p.l)) AS before
  FROM orders, range(1, 6) r(s) JOIN letters l ON l.l = substr(filter_order, CAST(s AS INT), 1)),
counted AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN pattern & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN pattern & before = 0 AND pattern & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN pattern & before > 0 AND pattern & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN pattern = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN pattern & before = 0 AND pattern & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN pattern & before = 0 AND pattern & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""


def _merkle_levels(name: str, leaves: str, group: str) -> str:
    """CTEs ``<name>_0 ..`` of the nodes level by level: a group's nodes are
    hashed in runs of three while more than one is left. 14 levels hold
    4,782,969 leaves a group."""
    out = [f"{name}_0 AS (SELECT {group}, r, node, count(*) OVER (PARTITION BY {group}) AS m FROM {leaves})"]
    for i in range(14):
        out.append(f"""{name}_{i + 1} AS (
  SELECT {group}, r // 3 AS r, sha256(string_agg(node, '' ORDER BY r)) AS node, (any_value(m) + 2) // 3 AS m
  FROM {name}_{i} WHERE m > 1 GROUP BY {group}, r // 3
  UNION ALL SELECT {group}, r, node, m FROM {name}_{i} WHERE m = 1)""")
    return ",\n".join(out)


def _merkle_paths(name: str, leaves: str, levels: str, group: str) -> str:
    """CTEs that add to each row of ``leaves`` one text per level, ``left|right``
    siblings, or ``-`` where its group is already down to one node."""
    out = [f"{name}_0 AS (SELECT *, r AS spot, [] :: VARCHAR[] AS path FROM {leaves})"]
    side = "list_aggregate(list_concat([''], list_slice(u.nodes, {}, {})), 'string_agg', '')"
    for i in range(14):
        out.append(f"""{name}_run_{i} AS (
  SELECT {group}, r // 3 AS run, list(node ORDER BY r) AS nodes, any_value(m) AS m
  FROM {levels}_{i} GROUP BY {group}, r // 3),
{name}_{i + 1} AS (
  SELECT p.* REPLACE (p.spot // 3 AS spot, list_append(p.path, CASE WHEN u.m = 1 THEN '-' ELSE
           {side.format("1", "p.spot % 3")} || '|' || {side.format("p.spot % 3 + 2", "3")} END) AS path)
  FROM {name}_{i} p JOIN {name}_run_{i} u ON u.{group} = p.{group} AND u.run = p.spot // 3)""")
    return ",\n".join(out)


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0} :: VARCHAR) || ':' || ({0} :: VARCHAR) END"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
#: CRC-32 of a text of decimal digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
  list_transform(str_split(doc_id :: VARCHAR, ''), lambda c: CAST(ord(c) AS BIGINT))), lambda a, c:
  list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z:
    xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

OP13_SQL = f"""
WITH l AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS g,
         sha256({_HEAD} || {_FIELD.format('text')}) AS node,
         CASE WHEN {_CRC} % 2 = 0
              THEN sha256({_HEAD} || {_FIELD.format("replace(text, chr(10), '')")}) END AS changed
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS r FROM l),
{_merkle_levels("t", "leaves", "g")},
sub AS (SELECT g, node, row_number() OVER (ORDER BY g) - 1 AS r, 0 AS k FROM t_14),
{_merkle_levels("u", "sub", "k")},
{_merkle_paths("p", "leaves", "t", "g")},
{_merkle_paths("q", "sub", "u", "k")},
paths AS (
  SELECT p.doc_id, p.node AS leaf, coalesce(p.changed, p.node) AS now, s.node AS subroot,
         (SELECT node FROM u_14) AS root, list_concat(p.path, s.path) AS path
  FROM p_14 p JOIN q_14 s ON s.g = p.g),
folded AS (
  SELECT *, sha256(replace(replace(array_to_string(path, ''), '|', ''), '-', '')) AS proof_sha256,
         list_reduce(list_prepend(now, path), lambda a, c: CASE WHEN c = '-' THEN a ELSE
           sha256(split_part(c, '|', 1) || a || split_part(c, '|', 2)) END) AS folded_root
  FROM paths)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4_SQL, "op5_embedding_dedup": OP5_SQL, "op11_filter_audit": OP11_SQL,
            "op13_merkle_manifest": OP13_SQL}
