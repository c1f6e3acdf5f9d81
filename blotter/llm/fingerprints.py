"""Document fingerprints by consistent weighted sampling.

A document is a bag of words with their counts as weights. For each of the
samples every word gets two gamma(2, 1) variates r and c and a uniform b, drawn
from a hash of the word and the sample's number alone. With t = floor(ln w / r
+ b) the word's value is ln a = ln c - r (t - b + 1), and the sample is the pair
(word, t) of smallest value. Two bags have the same pair with probability
sum(min) / sum(max) of their weights, the generalised Jaccard similarity, so
the share of equal samples estimates it.

r, c and b come from two hashes: r from two numbers of 21 bits, b from 22 bits,
c from two numbers of 32 bits.

Only DataFrame functions run here. A document's text is shuffled once; words,
counts, variates and minima of both its versions are computed where it then is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators.position import with_position

from .common import WORD, cut

#: Samples of a fingerprint: the likeness has a standard error of at most
#: 1 / (2 sqrt(48)) = 0.072.
SAMPLES = 48
#: Samples that one row of terms is taken for at a time, so that the generated
#: code of a step stays small.
BLOCK = 8
#: Values ln a are kept as fixed-point numbers of 31 bits above the 32 bits that
#: name the pair, so the smallest pair is the minimum of one long.
_OFFSET, _SCALE, _LOW, _LN2 = 1 << 30, float(1 << 20), (1 << 32) - 1, 0.6931471805599453


def _bits(h: Column, at: int, n: int) -> Column:
    """``n`` bits of a hash as a number in (0, 2^n)."""
    return F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << n) - 1)) + F.lit(0.5)


def sampled(term: Column, log_weight: Column, sample: Column) -> Column:
    """Value and name of one term (a 64-bit hash) in one sample (a long), packed
    into a long."""
    h = F.xxhash64(term, sample)
    g = F.xxhash64(h)
    r = F.lit(42 * _LN2) - F.ln(_bits(h, 0, 21) * _bits(h, 21, 21))
    c = F.lit(64 * _LN2) - F.ln(_bits(g, 0, 32) * _bits(g, 32, 32))
    b = _bits(h, 42, 22) * F.lit(0.5 ** 22)
    t = F.floor(log_weight / r + b)
    value = F.ln(c) - r * (t - b + F.lit(1.0))
    fixed = F.floor(value * F.lit(_SCALE)) + F.lit(_OFFSET)
    name = F.xxhash64(term, t).bitwiseAND(F.lit(_LOW))
    return F.shiftleft(fixed, 32).bitwiseOR(name)


def signatures(terms: DataFrame, key: str, weights: dict[str, str], samples: int = SAMPLES) -> DataFrame:
    """``terms(key, term, <weight columns>)``, one row per key and term hash,
    to ``key`` and, for each ``weights`` item (weight column -> result column),
    an array of ``samples`` names of 32 bits (null for a bag without a term of
    positive weight). A term with one weight in all bags of its row is sampled
    once for all of them.

    Per key, kind of term (in all bags, or in one) and block of samples a hash
    aggregate keeps the block's minima, so a bag of any size is a fixed number
    of longs."""
    bags = list(weights)
    whole = (1 << len(bags)) - 1
    first = F.col(bags[0])
    alike = reduce(lambda x, y: x & y, [first.eqNullSafe(F.col(w)) for w in bags])
    one = lambda kind, w: F.struct(F.lit(kind).alias("kind"), F.ln(w.cast("double")).alias("log_weight"))
    parts = F.when(alike, F.array(one(whole, first))).otherwise(F.array(*[
        one(1 << i, F.col(w)) for i, w in enumerate(bags)]))
    blocks = F.sequence(F.lit(0).cast("long"), F.lit((samples - 1) // BLOCK).cast("long"))
    rows = (terms.select(key, "term", F.inline(parts)).filter("log_weight IS NOT NULL")
            .select("*", F.explode(blocks).alias("block")))
    best = rows.groupBy(key, "kind", "block").agg(*[
        F.min(sampled(F.col("term"), F.col("log_weight"), F.col("block") * BLOCK + i)).alias(f"_{i}") for i in range(BLOCK)])
    found = (best.select(key, F.struct("kind", "block", F.array(*[f"_{i}" for i in range(BLOCK)]).alias("best")).alias("b"))
             .groupBy(key).agg(F.array_sort(F.collect_list("b")).alias("found")))

    def of(kind: int) -> Column:
        own = F.filter("found", lambda b: b["kind"] == kind)
        minima = F.slice(F.flatten(F.transform(own, lambda b: b["best"])), 1, samples)
        return F.when(F.size(own) > 0, minima)

    kinds = found.select(key, of(whole).alias("common"), *[of(1 << i).alias(f"_{i}") for i in range(len(bags))])

    def name(i: int) -> Column:
        common, own = F.col("common"), F.col(f"_{i}")
        both = F.zip_with(common, own, lambda x, y: F.least(x, y))
        return F.transform(F.coalesce(both, common, own), lambda x: x.bitwiseAND(F.lit(_LOW)))

    return kinds.select(key, *[name(i).alias(out) for i, out in enumerate(weights.values())])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples; two bags without words are alike, a bag without
    words is unlike every other."""
    equal = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(equal / F.size(a))


def as_text(signature: Column) -> Column:
    """Eight hex digits a sample; the empty string without words."""
    digits = F.transform(signature, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third of its
    code points replaced by as many of the next document's first (or all of
    them), by descending id, the first document after the last.

    Per document ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited`` and ``near_next`` (likeness to the edited
    and to the next document's fingerprint).

    Nulls count as empty texts. Null ids come last. Rows with equal id and text
    are one document in the order and have one result each; of equal ids with
    different texts the order is by a digest of the text. A document alone is
    its own next. Texts without words have the empty fingerprint. Very long
    texts are cut into words where they lie. Other columns are not read. An
    empty table gives no rows."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), text)
    rows = docs.select(F.unhex(F.sha2(name, 256)).alias("key"), F.col(id_col).alias("doc_id"), text.alias("text"))
    heads = rows.groupBy("key").agg(F.max("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"),
                                    F.max(F.char_length("text").cast("long")).alias("n_chars"))
    placed = with_position(heads, [F.col("doc_id").desc_nulls_last(), F.col("key")])
    total, repeats = placed.agg(F.count(F.lit(1)), F.max("copies")).first()
    after = F.when(F.col("position") + 1 < (total or 0), F.col("position") + 1).otherwise(F.lit(0).cast("long"))
    chain = cut(placed.withColumn("after", after).join(
        placed.select(F.col("position").alias("after"), F.col("key").alias("next_key")), "after")
        .drop("position", "after"), "edit_chain")

    # Both uses below read one exchange of the texts by their key.
    texts = rows.select("key", "text")
    if (repeats or 1) > 1:
        texts = texts.groupBy("key").agg(F.max("text").alias("text"))
    third = F.expr("cast(n_chars div 3 AS int)")
    gifts = (texts.join(chain.select("key", "next_key", "n_chars").withColumnsRenamed({"key": "taker", "next_key": "key"}), "key")
             .select(F.col("taker").alias("key"), "n_chars", F.substr("text", F.lit(1), third).alias("gift")))
    both = texts.join(gifts, "key").select(
        "key", "text", F.concat(F.substr("text", F.lit(1), (F.col("n_chars") - third).cast("int")), "gift").alias("edited"))

    versions = F.array(F.struct(F.col("text").alias("v"), F.lit(1).alias("w"), F.lit(0).alias("e")),
                       F.struct(F.col("edited").alias("v"), F.lit(0).alias("w"), F.lit(1).alias("e")))
    words = both.select("key", F.explode(versions).alias("x")).select(
        "key", "x.w", "x.e", F.explode(F.regexp_extract_all("x.v", F.lit(WORD), F.lit(0))).alias("word"))
    terms = (words.groupBy("key", F.xxhash64("word").alias("term"))
             .agg(F.sum("w").alias("w"), F.sum("e").alias("e")))
    found = signatures(terms, "key", {"w": "own", "e": "edit"}, samples)
    hashes = both.select("key", F.sha2("edited", 256).alias("edited_sha256"))
    marked = cut(hashes.join(found, "key", "left").join(chain, "key").withColumn("near_edited", likeness(F.col("own"), F.col("edit"))),
                 "fingerprints")
    nexts = marked.select(F.col("key").alias("next_key"), F.col("own").alias("next"))
    out = marked.join(nexts, "next_key").withColumn("near_next", likeness(F.col("own"), F.col("next")))
    if (repeats or 1) > 1:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"),
                      as_text(F.col("edit")).alias("edited_fingerprint"), "near_edited", "near_next")
