"""Date texts as JavaScript reads them (session zone UTC unless said)."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from boardlake.functions.dates import js_timestamp

FORMS = {
    "2026-03-01": "2026-03-01 00:00", "2026-03": "2026-03-01 00:00", "2026": "2026-01-01 00:00",
    "2026-03-01T10:20:30.5Z": "2026-03-01 10:20:30.500", "2026-03-01T10:00-04:00": "2026-03-01 14:00", "2026-03-01 10:00": "2026-03-01 10:00",
    "3/1/2026": "2026-03-01 00:00", "03/31/26": "2026-03-31 00:00", "3/1/75": "1975-03-01 00:00", "2026/03/01": "2026-03-01 00:00",
    "2026/3/1 8:05": "2026-03-01 08:05", "3-1-2026": "2026-03-01 00:00", "3/1": "2001-03-01 00:00", "2/30/2026": "2026-03-02 00:00",
    "12/25/2026 1:05 PM": "2026-12-25 13:05", "12/25/2026 12:00 am": "2026-12-25 00:00", "12/25/2026 12:30pm": "2026-12-25 12:30",
    "Mar 1, 2026": "2026-03-01 00:00", "1 March 2026 10:00": "2026-03-01 10:00", "MARCH 1 2026": "2026-03-01 00:00", "2026 Mar 1": None,
    "Sept. 9, 2026 9:08:07": "2026-09-09 09:08:07", "Jul 4": "2001-07-04 00:00", "2026 July": None,
    "Tue, 03 Mar 2026 10:00:00 GMT": "2026-03-03 10:00", "Tue Mar 03 2026 10:00:00 GMT+0100 (Central European Time)": "2026-03-03 09:00",
    "Mar 3 2026 10:00 EST": "2026-03-03 15:00", "3/3/2026 10:00 PDT": "2026-03-03 17:00", "3/3/2026 10:00 +05:30": "2026-03-03 04:30",
    "posted on 3/3/2026": "2026-03-03 00:00", "3/3/2026 soon": None, "13/1/2026": None, "0/1/2026": None, "3/1/2026 25:00": None,
    "3/1/2026 13:00 pm": None, "3/1/2026 10:60": None, "recently": None, "": None, "  ": None, "10:00": None, "1/2/3/4": None, "99": None,
}
FORMS["2026 Mar 1"] = "2026-03-01 00:00"  # the first number is no day
FORMS["2026 July"] = None  # a month and a year without a day


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_forms(spark, zone):
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(list(enumerate(FORMS)), "i int, x string").repartition(2)
        got = {r.x: r.ms for r in df.select("x", F.unix_millis(js_timestamp("x")).alias("ms")).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    for x, want in FORMS.items():
        if want is None:
            assert got[x] is None, x
            continue
        at = dt.datetime.fromisoformat(want)
        fixed = re.search(r"^\d{4}(-\d\d){0,2}$|T\d|GMT|EST|PDT|\+", x)
        if zone != "UTC" and not fixed:
            from zoneinfo import ZoneInfo

            at = at.replace(tzinfo=ZoneInfo(zone)).astimezone(dt.timezone.utc).replace(tzinfo=None)
        assert got[x] == round(at.replace(tzinfo=dt.timezone.utc).timestamp() * 1000), x


def test_null(spark):
    assert spark.createDataFrame([(None,)], "x string").select(js_timestamp("x").alias("t")).first().t is None


def test_each_step_once(spark):
    """The text is built once, and the time is looked for once in the whole text."""
    df = spark.createDataFrame([("3/1/2026 10:00",)], "x string")
    plan = df.select(js_timestamp(F.concat("x", F.lit(" EST"))).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(" EST") == 1
    assert plan.count(r"(?<![+\-\d:])(\d{1,2})") <= 7


def test_date_forms_dealt_out(spark, tmp_path):
    from boardlake.plans.queries import date_forms

    rows = [(k, dt.datetime(1998, 2, 1 + k)) for k in range(14)]
    spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = date_forms(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() > 1
    assert [r.ms for r in got.orderBy("o_orderkey").collect()][:3] == [round(x.replace(tzinfo=dt.timezone.utc).timestamp() * 1000) for x in (
        dt.datetime(1998, 2, 1), dt.datetime(1998, 2, 2, 1, 5), dt.datetime(1998, 2, 3))]
