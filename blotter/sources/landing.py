"""Landing: delimited report files in, typed raw rows out."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions.calendar import INCIDENT_DATE_FORMAT
from blotter.operators.incremental import ts_literal
from blotter.operators.joins import staged
from blotter.schemas import LANDING_SCHEMA

# Text that stands for a missing value in the landing files.
NULL_TOKENS = ("", "NULL")

# Landed columns by what staging makes of them.
DATE_COLUMNS = ["date_rptd", "date_occ"]
INT_COLUMNS = ["area", "rpt_dist_no", "crm_cd", "vict_age", "premis_cd", "weapon_used_cd",
               "crm_cd_1", "crm_cd_2", "crm_cd_3", "crm_cd_4"]
NUMBER_COLUMNS = ["lat", "lon"]


#: Column that a permissive scan puts a malformed record into.
CORRUPT = "_record"


def landing_options(reader, keep_bad: bool = False):
    """The landing format for a batch or a stream reader: ``,`` delimited, one
    header row that must name the schema's columns in order, optional ``"``
    quoting with doubled quotes inside, empty fields null. A malformed record
    fails the job, or with ``keep_bad`` goes to the column ``_record``."""
    options = {"header": True, "sep": ",", "quote": '"', "escape": '"', "multiLine": False, "nullValue": "",
               "enforceSchema": False, "mode": "PERMISSIVE" if keep_bad else "FAILFAST"}
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.option("columnNameOfCorruptRecord", CORRUPT) if keep_bad else reader


def landing_schema(schema: T.StructType = LANDING_SCHEMA, keep_bad: bool = False) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]) if keep_bad else schema


def null_tokens(df: DataFrame) -> DataFrame:
    """The literal ``NULL`` as null."""
    return df.select(*[F.col(f.name) if f.name == CORRUPT else
                       F.when(F.col(f.name) == F.lit(NULL_TOKENS[1]), F.lit(None).cast(f.dataType))
                       .otherwise(F.col(f.name)).alias(f.name) for f in df.schema.fields])


def read_incidents_csv(spark: SparkSession, path: str | list[str],
                       schema: T.StructType = LANDING_SCHEMA, keep_bad: bool = False) -> DataFrame:
    """Scan landing CSV files (see ``landing_options``).

    Empty fields and the literal ``NULL`` read as null. A missing path or a
    header with other columns fails the job (never falls back to older landing
    data); a malformed record fails it too, unless ``keep_bad`` is set. Files
    are split across tasks by ``spark.sql.files.maxPartitionBytes``.
    """
    reader = landing_options(spark.read.schema(landing_schema(schema, keep_bad)), keep_bad)
    return null_tokens(reader.csv(path))


def _unless(column: str, ok: Column, why: str) -> Column:
    return F.when(F.col(column).isNotNull() & ~F.coalesce(ok, F.lit(False)), F.lit(f"{column}: {why}"))


def reject_reasons(columns: list[str]) -> Column:
    """Why staging would fail on a landed row: an array of ``column: reason``,
    empty for a good row. The same parses as in staging, in their ``try_`` form;
    a malformed record has that one reason."""
    c = F.col
    reasons = [F.when(c("dr_no").isNull(), F.lit("dr_no: missing")),
               _unless("dr_no", c("dr_no").try_cast("long").cast("string") == c("dr_no"), "not a canonical integer")]
    reasons += [_unless(d, F.try_to_timestamp(c(d), F.lit(INCIDENT_DATE_FORMAT)).isNotNull(), "not a date")
                for d in DATE_COLUMNS]
    padded = F.lpad(c("time_occ"), 4, "0")
    in_day = (padded.rlike("^[0-9]{4}$") & (F.substring(padded, 1, 2).try_cast("int") <= 23)
              & (F.substring(padded, 3, 2).try_cast("int") <= 59))
    reasons.append(_unless("time_occ", in_day, "not a time of day"))
    reasons += [_unless(n, c(n).try_cast("int").isNotNull(), "not an integer") for n in INT_COLUMNS]
    reasons += [_unless(n, c(n).try_cast("double").isNotNull(), "not a number") for n in NUMBER_COLUMNS]
    found = F.array_compact(F.array(*reasons))
    if CORRUPT not in columns:
        return found
    return F.when(c(CORRUPT).isNotNull(), F.array(F.lit("malformed record"))).otherwise(found)


def split_landed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed rows (read with ``keep_bad``) as good rows and rejected ones. The
    rows are scanned and judged once and written; rejected rows keep their
    columns, the malformed record where there is one, and ``reasons``."""
    judged, _ = staged(rows.withColumn("reasons", reject_reasons(rows.columns)), "landed")
    good = judged.filter(F.size("reasons") == 0).drop("reasons", CORRUPT)
    return good, judged.filter(F.size("reasons") > 0)


def with_load_ts(df: DataFrame, load_ts: dt.datetime | str, col: str = "dl_upd") -> DataFrame:
    """Stamp every row of one load with the load time (an argument, so a
    replayed load carries the same stamp)."""
    return df.withColumn(col, ts_literal(load_ts))


def write_landing_csv(df: DataFrame, path: str) -> None:
    """Write rows as landing CSV (header, quoted where needed, null as empty)."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').option("nullValue", "").option("emptyValue", '""')
     .csv(path))
