"""Incident fact: one row per report with the keys of every dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.incremental import since_watermark, ts_literal
from blotter.operators.joins import bounded_broadcast
from blotter.plans.dims import location_key
from blotter.plans.staging import LOAD_SEQ

FACT_COLUMNS = ["dr_no", "date_rptd_id", "date_occ_id", "time_occ_id", "victims_id",
                "weapons_id", "status_dim_id", "area_dim_id", "premis_dim_id",
                "location_dim_id", "doe", "dlu"]


def lookup(df: DataFrame, dim: DataFrame, pairs: list[tuple[str, str]], id_as: str,
           rows: int | None = None, null_safe: bool = False) -> DataFrame:
    """Left-join ``dim`` on ``pairs`` (fact column, dim column) and add its
    ``id`` as ``id_as``. The dimension side is broadcast when its row count
    (known from its write, or checked) is within the bound."""
    d = dim.select(*[F.col(dc).alias(f"__{id_as}_{i}") for i, (_, dc) in enumerate(pairs)],
                   F.col("id").alias(id_as))
    d = bounded_broadcast(d, rows)
    conds = []
    for i, (fc, _) in enumerate(pairs):
        a, b = F.col(fc), F.col(f"__{id_as}_{i}")
        conds.append(a.eqNullSafe(b) if null_safe else a == b)
    out = df.join(d, reduce(lambda x, y: x & y, conds), "left")
    return out.drop(*[f"__{id_as}_{i}" for i in range(len(pairs))])


def fct_incidents(stg: DataFrame, dims: dict[str, DataFrame], descent: DataFrame, load_ts,
                  rows: dict[str, int] | None = None, watermark=None, upto=None,
                  late: DataFrame | None = None, fresh: DataFrame | None = None) -> DataFrame:
    """Fact rows for staged incidents newer than ``watermark`` (all when None).

    Every dimension here is bounded (calendar, minutes, codes, victim groups)
    and broadcast, so the whole fact build is one map-only stage. The location
    key is the hash of the location columns: the location snapshot is built
    from the same staged rows before the fact, so the hash always names an
    existing current version and no fact-sized join is needed for it.
    ``doe``/``dlu`` are ``load_ts``; the merge keeps an existing ``doe``.
    ``late`` are the premises that the dimension's merges have inserted since
    ``watermark`` (a premise that got its text; ``None``: there are none): they
    bring back the older rows that name them, and only then older rows are
    read. ``fresh`` are the rows of the loads after ``watermark``, where they
    are staged already.
    """
    rows = rows or {}
    src = fresh
    if src is None:
        src = since_watermark(stg, LOAD_SEQ, watermark)
        if upto is not None:
            src = src.filter(F.col(LOAD_SEQ) <= upto)
    if watermark is not None and late is not None:
        again = bounded_broadcast(late.select(F.col("code").alias("__late")), rows.get("dim_premise"))
        old = stg.filter(F.col(LOAD_SEQ) <= watermark).join(again, F.col("premis_cd") == F.col("__late"), "left_semi")
        src = src.unionByName(old)
    f = src.select("dr_no", "date_occ", "date_rptd", "hour_occ", "minute_occ", "vict_age",
                   "vict_sex", "vict_descent", "weapon_used_cd", "status", "area", "premis_cd",
                   location_key().alias("location_dim_id"))
    date = dims["dim_date"]
    f = lookup(f, date, [("date_occ", "full_date")], "date_occ_id", rows.get("dim_date"))
    f = lookup(f, date, [("date_rptd", "full_date")], "date_rptd_id", rows.get("dim_date"))
    f = lookup(f, dims["dim_time"], [("hour_occ", "hour_of_day"), ("minute_occ", "minute_of_hour")],
               "time_occ_id", rows.get("dim_time"))
    # Victim groups are stored with the descent text; map it back to the code.
    victim = dims["dim_victim"].join(
        F.broadcast(descent.select(F.col("descent_description").alias("descent"),
                                   "descent_code")), "descent", "left")
    f = lookup(f, victim, [("vict_age", "age"), ("vict_sex", "sex"), ("vict_descent", "descent_code")],
               "victims_id", rows.get("dim_victim"), null_safe=True)
    f = lookup(f, dims["dim_weapon"], [("weapon_used_cd", "code")], "weapons_id", rows.get("dim_weapon"))
    f = lookup(f, dims["dim_status"], [("status", "code")], "status_dim_id", rows.get("dim_status"))
    f = lookup(f, dims["dim_area"], [("area", "code")], "area_dim_id", rows.get("dim_area"))
    f = lookup(f, dims["dim_premise"], [("premis_cd", "code")], "premis_dim_id", rows.get("dim_premise"))
    stamp = ts_literal(load_ts)
    return f.select(*FACT_COLUMNS[:-2], stamp.alias("doe"), stamp.alias("dlu"))
