"""Many-to-many bridges: incident <-> crime code, incident <-> MO code."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.codes import code_array, explode_codes, split_int_codes
from blotter.operators.incremental import since_watermark, ts_literal
from blotter.operators.joins import bounded_broadcast
from blotter.plans.staging import LOAD_SEQ


CODE_SLOTS = ("crm_cd_1", "crm_cd_2", "crm_cd_3", "crm_cd_4")


def _window(stg: DataFrame, watermark, upto) -> DataFrame:
    """Staged rows of the loads after ``watermark``, up to ``upto``."""
    src = since_watermark(stg, LOAD_SEQ, watermark)
    return src if upto is None else src.filter(F.col(LOAD_SEQ) <= upto)


def _stamp(df: DataFrame, load_ts) -> DataFrame:
    s = ts_literal(load_ts)
    return df.withColumn("doe", s).withColumn("dlu", s)


def bridge_crime_code(stg: DataFrame, dim_crime_code: DataFrame, load_ts,
                      watermark=None, dim_rows: int | None = None, upto=None,
                      late: DataFrame | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """(dr_no, crime code id) for the four code slots of each report.

    The slots are de-duplicated inside the row before ``explode``, so a code
    repeated within one report yields one row without any shuffle; codes
    missing from the crime dimension drop out in the inner join.

    ``late`` are the codes that the dimension's merges have inserted since
    ``watermark`` (``None``: there are none): they bring back the older rows
    that carry them, and only then older rows are read. ``fresh`` are the rows
    of the loads after ``watermark``, where they are staged already.
    """
    src = _window(stg, watermark, upto) if fresh is None else fresh
    codes = explode_codes(src, ["dr_no"], code_array(*CODE_SLOTS))
    if watermark is not None and late is not None:
        old = explode_codes(stg.filter(F.col(LOAD_SEQ) <= watermark), ["dr_no"], code_array(*CODE_SLOTS))
        again = bounded_broadcast(late.select(F.col("code").alias("__late")), dim_rows)
        codes = codes.unionByName(old.join(again, F.col("code") == F.col("__late"), "left_semi"))
    dim = bounded_broadcast(dim_crime_code.select(F.col("code").alias("__code"),
                                                  F.col("id").alias("crime_code_dim_id")), dim_rows)
    j = codes.join(dim, F.col("code") == F.col("__code"), "inner").select("dr_no", "crime_code_dim_id")
    return _stamp(j, load_ts)


def bridge_mocode(stg: DataFrame, dim_mocode: DataFrame, load_ts,
                  watermark=None, dim_rows: int | None = None, upto=None,
                  fresh: DataFrame | None = None) -> DataFrame:
    """(dr_no, MO code id): the space-separated MO list split, cast to int
    (``0416`` matches 416, junk tokens drop) and matched to the MO dimension."""
    src = _window(stg, watermark, upto) if fresh is None else fresh
    codes = explode_codes(src.filter(F.col("mocodes").isNotNull()), ["dr_no"], split_int_codes("mocodes"))
    dim = bounded_broadcast(dim_mocode.select(F.col("code").alias("__code"),
                                              F.col("id").alias("mocode_dim_id")), dim_rows)
    j = codes.join(dim, F.col("code") == F.col("__code"), "inner").select("dr_no", "mocode_dim_id")
    return _stamp(j, load_ts)
