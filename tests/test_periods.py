from datetime import datetime

import pytest
from conftest import at, collected, ledger
from pyspark.sql import functions as F

from tallybook.functions.labels import age_years, capitalised, event_text
from tallybook.functions.money import dollars, units_and_nanos
from tallybook.functions.periods import TORONTO, ReportWindow, bucket, in_window, seconds_between, to_local
from tallybook.sources.catalog import Catalog, DayLayout


def stamps(spark, *texts):
    return spark.createDataFrame([(at(t),) for t in texts], "ts timestamp_ntz")


def test_month_window_across_both_clock_changes():
    march = ReportWindow.month(2023, 3)
    assert march.start_utc == datetime(2023, 3, 1, 5) and march.end_utc == datetime(2023, 4, 1, 4)
    november = ReportWindow.month(2023, 11)
    assert november.start_utc == datetime(2023, 11, 1, 4) and november.end_utc == datetime(2023, 12, 1, 5)
    assert ReportWindow.month(2023, 12).end == datetime(2024, 1, 1)
    assert ReportWindow.day(2023, 2, 28).end == datetime(2023, 3, 1)


def test_half_open_bounds(spark):
    day = ReportWindow.day(2023, 1, 10)
    df = stamps(spark, "2023-01-10 04:59:59.999999", "2023-01-10 05:00:00", "2023-01-11 04:59:59", "2023-01-11 05:00:00")
    assert in_window(df, "ts", day).count() == 2
    local = stamps(spark, "2023-01-10 00:00:00", "2023-01-11 00:00:00")
    assert local.where(day.holds_local("ts")).count() == 1
    assert local.where(day.holds_local("ts", closed=True)).count() == 2


def test_look_back(spark):
    window = ReportWindow(datetime(2023, 8, 31), datetime(2023, 9, 1))
    df = stamps(spark, "2023-02-28 04:00:00", "2023-02-28 03:59:59", "2023-08-30 04:00:00", "2023-08-30 03:00:00")
    assert in_window(df, "ts", window, months_back=6).count() == 3
    assert in_window(df, "ts", window, days_back=1).count() == 1


def by_day(spark, path, zone, column):
    df = stamps(spark, "2023-01-09 12:00:00", "2023-01-10 12:00:00", "2023-01-11 02:00:00", "2023-01-12 12:00:00")
    df.withColumn(column, to_local("ts", zone).cast("date")).write.partitionBy(column).parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("zone", ["UTC", TORONTO])
def test_declared_layout_prunes_directories(spark, tmp_path, zone):
    path = str(tmp_path / "t")
    kept = in_window(DayLayout("ts", "kept_on", zone).mark(by_day(spark, path, zone, "kept_on")), "ts", ReportWindow.day(2023, 1, 10))
    assert kept.count() == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "kept_on" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_a_column_named_like_a_day_is_left_alone(spark):
    df = stamps(spark, "2023-01-10 12:00:00").withColumn("ts_day", F.lit("1999-01-01").cast("date"))
    assert in_window(df, "ts", ReportWindow.day(2023, 1, 10)).count() == 1


def test_catalog_reads_a_declared_layout(spark, tmp_path):
    rows = ledger(spark, {"t_changed_at": at("2023-01-10 12:00:00")}, {"t_changed_at": at("2023-01-12 12:00:00")})
    rows.withColumn("day", F.col("t_changed_at").cast("date")).write.partitionBy("day").parquet(str(tmp_path / "accounting"))
    tables = Catalog.parquet(spark, str(tmp_path), {"accounting": DayLayout("t_changed_at", "day")})
    kept = in_window(tables.accounting, "t_changed_at", ReportWindow.day(2023, 1, 10))
    assert kept.count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("zone", ["UTC", "America/Toronto", "Europe/Berlin"])
def test_local_time_in_spring_and_autumn(spark, zone):
    df = stamps(
        spark, "2023-03-12 06:59:00", "2023-03-12 07:00:00", "2023-03-26 02:30:00", "2023-11-05 05:30:00", "2023-11-05 06:30:00"
    )
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = [r[0] for r in df.select(to_local("ts")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        at("2023-03-12 01:59:00"),
        at("2023-03-12 03:00:00"),
        at("2023-03-25 22:30:00"),
        at("2023-11-05 01:30:00"),
        at("2023-11-05 01:30:00"),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Toronto"])
def test_buckets_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = stamps(spark, "2023-03-12 02:30:15.75", "2023-01-31 23:59:59.999999")
        got = collected(df.select(bucket("ts", "month"), bucket("ts", "day"), bucket("ts", "second")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        (at("2023-01-01"), at("2023-01-31"), at("2023-01-31 23:59:59")),
        (at("2023-03-01"), at("2023-03-12"), at("2023-03-12 02:30:15")),
    ]


def test_seconds_keep_the_fraction(spark):
    df = spark.createDataFrame([(at("2023-01-01 00:00:00.25"), at("2023-01-02 00:00:01"))], "a timestamp_ntz, b timestamp_ntz")
    assert float(df.select(seconds_between(F.col("a"), F.col("b"))).first()[0]) == 86400.75


def test_money_is_exact(spark):
    df = spark.createDataFrame([(-12345, 3, 5_000_001)], "c bigint, u bigint, n bigint")
    row = df.select(dollars("c"), units_and_nanos("u", "n")).first()
    assert [str(v) for v in row] == ["-123.45", "3.005000001"]


def test_labels(spark):
    df = spark.createDataFrame(
        [("VIDEO poker", at("1990-01-01").date(), "", "parlay", "m"), (None, None, None, "straight", "m")],
        "c string, b date, e string, t string, m string",
    )
    got = df.select(
        capitalised(F.col("c")),
        age_years("b", F.lit(at("2020-01-01").date())),
        event_text(F.col("e"), F.col("t"), F.col("m")),
        event_text(F.col("e"), F.col("t"), F.col("m"), any_case=False),
    ).collect()
    # 10,957 days are 30 years of 365 days and 7 more
    assert tuple(got[0]) == ("Video poker", 30, "", "m")
    assert tuple(got[1]) == (None, None, "m", "m")
