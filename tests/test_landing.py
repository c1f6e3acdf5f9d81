import datetime as dt
import os
import tempfile

import pytest

from blotter.plans import pipeline as P
from blotter.schemas import RAW_TEXT_COLUMNS
from blotter.session import scratch_path
from blotter.sources.landing import read_incidents_csv, split_landed
from blotter.sources.store import TableStore
from blotter.streaming.ingest import QUARANTINE, ingest_available

GOOD = {c: "" for c in RAW_TEXT_COLUMNS} | {"dr_no": "1", "date_rptd": "01/02/2024 12:00:00 AM", "time_occ": "5",
                                            "date_occ": "01/01/2024 12:00:00 AM", "area": "1", "lat": "34.05", "lon": "-118.25"}


def line(**values):
    return ",".join((GOOD | values).values())


LINES = [line(), line(dr_no="2", crm_cd_desc='"A, ""B"""'), line(dr_no="007"), line(dr_no=""), line(dr_no="3", date_occ="31/31/2024 12:00:00 AM"),
         line(dr_no="4", time_occ="2460", lat="north"), line(dr_no="5") + ",more", "6,too,few", line(dr_no="7", vict_age="NULL"),
         line(dr_no="8", weapon_used_cd="1x"), line(dr_no="9", time_occ="12345")]
REASONS = {"007": "dr_no: not a canonical integer", None: "dr_no: missing", "3": "date_occ: not a date",
           "4": "time_occ: not a time of day; lat: not a number", "5": "malformed record", "6": "malformed record",
           "8": "weapon_used_cd: not an integer"}


def landing(lines, header=RAW_TEXT_COLUMNS):
    folder = tempfile.mkdtemp(prefix="landing-")
    with open(os.path.join(folder, "a.csv"), "w") as fh:
        fh.write("\n".join([",".join(header), *lines]) + "\n")
    return folder


def test_split(spark):
    good, rejected = split_landed(read_incidents_csv(spark, landing(LINES), keep_bad=True))
    assert good.columns == RAW_TEXT_COLUMNS
    found = {r.dr_no: "; ".join(r.reasons) for r in rejected.collect()}
    assert {k: v for k, v in found.items() if k != "9"} == REASONS
    rows = {r.dr_no: r for r in good.collect()}
    assert set(rows) | set(found) - set(REASONS) == {"1", "2", "7", "9"}
    assert rows["2"].crm_cd_desc == 'A, "B"' and rows["7"].vict_age is None
    record = {r.dr_no: r._record for r in rejected.collect()}
    assert record["6"] == "6,too,few" and record["4"] is None


def test_default_fails_fast(spark):
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        read_incidents_csv(spark, landing(LINES)).collect()


def test_good_rows_survive_staging(spark):
    """What passes the quarantine is what staging can type."""
    from pyspark.sql import functions as F

    from blotter.plans.staging import stg_incidents
    good, _ = split_landed(read_incidents_csv(spark, landing(LINES), keep_bad=True))
    assert stg_incidents(good.withColumn("dl_upd", F.current_timestamp())).count() == good.count()
    stg_incidents(good.withColumn("dl_upd", F.current_timestamp())).collect()


def test_stream_quarantine(spark):
    store = TableStore(spark, scratch_path(spark, "quarantine"))
    folder, ckpt = landing(LINES), scratch_path(spark, "quarantine-ckpt")
    tick = lambda: dt.datetime(2024, 3, 1)
    ingest_available(spark, folder, store, ckpt, tick, advance_models=False, keep_bad=True)
    assert {r.dr_no for r in store.read(P.RAW, P.RAW_TABLE).collect()} >= {"1", "2", "7"}
    bad = store.read(P.RAW, QUARANTINE)
    assert bad.filter("dr_no IN ('3', '4', '5', '6', '007')").count() == 5 and "dl_upd" in bad.columns
    with open(os.path.join(folder, "b.csv"), "w") as fh:
        fh.write("\n".join([",".join(RAW_TEXT_COLUMNS), line(dr_no="20"), line(dr_no="21", area="z")]) + "\n")
    n = bad.count()
    ingest_available(spark, folder, store, ckpt, tick, advance_models=False, keep_bad=True)
    assert store.read(P.RAW, QUARANTINE).count() == n + 1
    assert store.read(P.RAW, P.RAW_TABLE).filter("dr_no = '20'").count() == 1


def test_stream_checks_the_header(spark):
    names = list(RAW_TEXT_COLUMNS)
    names[0], names[1] = names[1], names[0]
    store = TableStore(spark, scratch_path(spark, "stream-header"))
    with pytest.raises(Exception, match="header|STREAM_FAILED"):
        ingest_available(spark, landing([line()], names), store, scratch_path(spark, "header-ckpt"), advance_models=False)
    assert store.read(P.RAW, P.RAW_TABLE) is None
