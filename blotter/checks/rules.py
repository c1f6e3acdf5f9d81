"""Row-level data checks. Every check yields rows of
``(check, table, column, failures, passed)``.

* not-null and pattern checks on one table are a single aggregate (one scan);
* uniqueness groups each column by its own typed values with a partial
  aggregate, so a hot value never reaches a reducer as more than one row per
  map task, and a table bucketed on the column is not shuffled at all;
* relationships first reduce the child to its distinct keys (partial
  aggregate), then anti-join them with the parent's keys.

Nulls are counted by not-null and ignored by every other check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import CHECK_RESULT_SCHEMA

# Spark type names accepted by the type check, by family.
TYPE_FAMILIES = {
    "date": ("date",),
    "timestamp": ("timestamp", "timestamp_ntz"),
    "string": ("string",),
    "integer": ("int", "bigint", "smallint", "tinyint"),
    "double": ("double", "float"),
    "boolean": ("boolean",),
}


def _result(check: str, table: str, column: str | None, failures) -> F.Column:
    f = F.coalesce(failures.cast("long"), F.lit(0).cast("long"))
    return F.struct(F.lit(check).alias("check"), F.lit(table).alias("table"),
                    F.lit(column).cast("string").alias("column"), f.alias("failures"),
                    (f == 0).alias("passed"))


def _rows(df_one_row: DataFrame, results: list[F.Column]) -> DataFrame:
    return df_one_row.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def check_columns(df: DataFrame, table: str, not_null: list[str] = (),
                  regex: dict[str, str] | None = None) -> DataFrame:
    """Not-null and pattern checks of one table in a single aggregate."""
    regex = regex or {}
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(f"nn__{c}") for c in not_null]
    aggs += [F.sum((F.col(c).isNotNull() & ~F.col(c).cast("string").rlike(p)).cast("long"))
             .alias(f"rx__{c}") for c, p in regex.items()]
    one = df.agg(*aggs)
    results = [_result("not_null", table, c, F.col(f"nn__{c}")) for c in not_null]
    results += [_result("regex", table, c, F.col(f"rx__{c}")) for c in regex]
    return _rows(one, results)


def check_not_null(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    return check_columns(df, table, not_null=cols)


def check_regex(df: DataFrame, table: str, col: str, pattern: str) -> DataFrame:
    return check_columns(df, table, regex={col: pattern})


def check_unique(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """Failures = number of distinct non-null values occurring more than once.

    Each column is grouped as it is stored: a table bucketed on the column is
    counted bucket by bucket without an exchange."""
    parts = []
    for c in cols:
        repeated = (df.select(F.col(c).alias("__v")).filter(F.col("__v").isNotNull()).groupBy("__v").count()
                    .filter(F.col("count") > 1).agg(F.count(F.lit(1)).alias("f")))
        parts.append(_rows(repeated, [_result("unique", table, c, F.col("f"))]))
    return union_all(parts)


def check_relationship(child: DataFrame, fk: str, parent: DataFrame, pk: str,
                       table: str, parent_table: str) -> DataFrame:
    """Failures = child rows whose non-null ``fk`` has no ``pk`` in the parent."""
    keys = (child.filter(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("__k"))
            .agg(F.count(F.lit(1)).alias("__n")))
    orphans = keys.join(parent.select(F.col(pk).alias("__k")).filter(F.col("__k").isNotNull()),
                        "__k", "left_anti")
    one = orphans.agg(F.sum("__n").alias("f"))
    return _rows(one, [_result(f"relationship:{parent_table}.{pk}", table, fk, F.col("f"))])


def check_relationships(child: DataFrame, table: str,
                        links: list[tuple[str, DataFrame, str, str]]) -> DataFrame:
    """Several foreign keys of one child table in one scan and one shuffle.

    ``links`` holds (fk column, parent frame, parent key, parent name). The
    child's keys are exploded into (fk column, value) pairs and reduced with a
    partial aggregate; the parents' keys, tagged with the fk column they
    serve, are anti-joined against them. Same rows as ``check_relationship``
    per link.
    """
    pairs = child.select(F.explode(F.array(*[
        F.struct(F.lit(fk).alias("__fk"), F.col(fk).cast("string").alias("__k"))
        for fk, _, _, _ in links])).alias("p")).select("p.*").filter(F.col("__k").isNotNull())
    keys = pairs.groupBy("__fk", "__k").agg(F.count(F.lit(1)).alias("__n"))
    parents = union_all([p.select(F.lit(fk).alias("__fk"), F.col(pk).cast("string").alias("__k"))
                         for fk, p, pk, _ in links]).filter(F.col("__k").isNotNull())
    orphans = (keys.join(parents, ["__fk", "__k"], "left_anti")
               .groupBy("__fk").agg(F.sum("__n").alias("f")))
    spec = child.sparkSession.createDataFrame(
        [(fk, f"relationship:{name}.{pk}") for fk, _, pk, name in links], "__fk string, check string")
    return (spec.join(orphans, "__fk", "left")
            .select("check", F.lit(table).alias("table"), F.col("__fk").alias("column"),
                    F.coalesce(F.col("f"), F.lit(0)).cast("long").alias("failures"))
            .withColumn("passed", F.col("failures") == 0))


def check_type(spark: SparkSession, df: DataFrame, table: str, col: str, expected: str) -> DataFrame:
    """Schema-only: 0 failures when ``col``'s type is in the ``expected``
    family (no scan)."""
    actual = df.schema[col].dataType.simpleString()
    ok = actual in TYPE_FAMILIES.get(expected, (expected,))
    return spark.createDataFrame([("type:" + expected, table, col, 0 if ok else 1, ok)],
                                 CHECK_RESULT_SCHEMA)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def summarise_checks(results: DataFrame) -> DataFrame:
    """Pass/fail counts per table."""
    return (results.groupBy("table")
            .agg(F.count(F.lit(1)).alias("checks"),
                 F.sum(F.col("passed").cast("long")).alias("passed_checks"),
                 F.sum((~F.col("passed")).cast("long")).alias("failed_checks"),
                 F.sum("failures").cast("long").alias("failures")))
