"""Timestamps: every notation against zoneinfo, daylight saving, ages, and the zone estimate."""

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from tidemark.operators.moments import offset_histories, place, read_moments, resolve, zone_evidence

RUN = dt.datetime(2025, 6, 1, 12, 0, 0, 250_000, dt.timezone.utc)


def ms(*a, z="UTC", fold=0):
    return int(dt.datetime(*a, tzinfo=ZoneInfo(z), fold=fold).timestamp() * 1000 // 1)


CASES = [
    ("2025-06-29T05:59:44+09:00", "UTC", ms(2025, 6, 29, 5, 59, 44, z="Asia/Tokyo")),
    ("2025-06-29T05:59:44Z", "Asia/Tokyo", ms(2025, 6, 29, 5, 59, 44)),
    ("2025-06-29 05:59:44.1239", "Asia/Tokyo", ms(2025, 6, 29, 5, 59, 44, z="Asia/Tokyo") + 123),
    ("2025-06-29T05:59:44.987654321Z", "UTC", ms(2025, 6, 29, 5, 59, 44) + 987),
    ("2025-06-29T05:59:44+02:00[Europe/Berlin]", "UTC", ms(2025, 6, 29, 3, 59, 44)),
    ("20250629T055944+0545", "UTC", ms(2025, 6, 29, 0, 14, 44)),
    ("2025-06-29", "America/New_York", ms(2025, 6, 29, z="America/New_York")),
    ("2025-06-29T05:59", "UTC", ms(2025, 6, 29, 5, 59)),
    ("29 June 2025", "Europe/Paris", ms(2025, 6, 29, z="Europe/Paris")),
    ("Jun 9, 2025, 12:05 a.m.", "UTC", ms(2025, 6, 9, 0, 5)),
    ("June 9, 2025, 12:05 PM", "UTC", ms(2025, 6, 9, 12, 5)),
    ("Sun, 29 Jun 2025 05:59:44 -0700", "UTC", ms(2025, 6, 29, 12, 59, 44)),
    ("Sun, 9 Nov 2025 13:12:17 EST", "UTC", ms(2025, 11, 9, 18, 12, 17)),
    ("November 9, 2025 13:12:17 CET", "UTC", ms(2025, 11, 9, 12, 12, 17)),
    ("03/04/2025 10:00", "UTC", ms(2025, 3, 4, 10)),
    ("25/04/2025 10:00", "UTC", ms(2025, 4, 25, 10)),
    ("2025-03-30T02:30:00", "Europe/Berlin", ms(2025, 3, 30, 1, 30)),  # skipped: counts on from before
    ("2025-10-26T02:30:00", "Europe/Berlin", ms(2025, 10, 26, 0, 30)),  # twice: the earlier
    ("1737578567", "UTC", 1737578567000),
    ("1755963098332", "UTC", 1755963098332),
    ("1752833062083410", "UTC", 1752833062083),
    ("2 days ago", "UTC", ms(2025, 5, 30, 12) + 250),
    ("15m", "UTC", ms(2025, 6, 1, 11, 45) + 250),
    ("1 min ago", "UTC", ms(2025, 6, 1, 11, 59) + 250),
    ("3w", "UTC", ms(2025, 5, 11, 12) + 250),
    ("11 hours ago", "UTC", ms(2025, 6, 1, 1) + 250),
    ("  Jul   14, 2025 ", "UTC", ms(2025, 7, 14)),
    ("2025-02-30", "UTC", None),
    ("2025-06-29T25:00:00", "UTC", None),
    ("Recently", "UTC", None),
    ("nan", "UTC", None),
    ("--", "UTC", None),
    ("", "UTC", None),
    (None, "UTC", None),
    ("5 June 2025 10:00:00 XYZ", "UTC", None),
    ("x" * 100_000, "UTC", None),
]


def test_notations(spark):
    rows = [(i, t, z, RUN) for i, (t, z, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, text string, zone string, run_at timestamp").withColumn("s", F.lit(1)).withColumn("kind", F.lit(2))
    out = read_moments(df, "text", "run_at")
    got = {r.i: r.e for r in out.select("i", resolve(F.col("m"), F.col("zone")).alias("e")).collect()}
    for i, (t, z, want) in enumerate(CASES):
        assert got[i] == want, (t, z)


def test_day_first_and_missing_run(spark):
    df = spark.createDataFrame([("03/04/2025 10:00", True), ("2 days ago", None)], "text string, df boolean")
    got = [r.e for r in read_moments(df, "text", None, "df").select(resolve(F.col("m"), F.lit("UTC")).alias("e")).collect()]
    assert got == [ms(2025, 4, 3, 10), None]
    assert read_moments(df.limit(0), "text").count() == 0


def test_zone_estimate(spark):
    rows = []
    for d in range(1, 300, 3):
        day = dt.date(2025, 1, 1) + dt.timedelta(days=d)
        off = dt.datetime(day.year, day.month, day.day, 12, tzinfo=ZoneInfo("America/New_York")).strftime("%z")
        rows.append(("ny", f"{day.isoformat()}T12:00:00{off}", None))
    # no stated offset: only ingestion tells that the clock runs ahead of UTC
    rows += [("tk", f"2025-05-{d:02d} 12:00:00", dt.datetime(2025, 5, d, 3, 30)) for d in range(1, 28)]
    rows += [(None, "2025-05-01 12:00:00", dt.datetime(2025, 5, 1, 13, 0))]
    df = spark.createDataFrame(rows, "source string, text string, seen timestamp")
    ev = zone_evidence(read_moments(df, "text").select("source", "m", "seen"), ["UTC", "America/New_York", "Europe/Berlin", "Asia/Tokyo"])
    none = spark.createDataFrame([("tk", "Europe/Berlin")], "source string, tz string")
    got = {r.source: r for r in offset_histories(ev, none).collect()}
    assert got["ny"].zone == "America/New_York" and got["ny"].declared is None and got["ny"].since is None and got["ny"].until is None
    # the evidence outweighs a declaration that the readings contradict
    assert got["tk"].zone == "Asia/Tokyo" and got["tk"].declared == "Europe/Berlin"
    assert got[None].zone == "UTC"


def test_equal_errors_keep_the_declared_clock(spark):
    rows = [("p", f"2025-0{1 + d % 9}-10 12:00:00", dt.datetime(2025, 1 + d % 9, 20)) for d in range(40)]
    df = spark.createDataFrame(rows, "source string, text string, seen timestamp")
    ev = zone_evidence(read_moments(df, "text").select("source", "m", "seen"), ["UTC", "Europe/Berlin", "Europe/Paris"])
    for tz in ("Europe/Paris", "Europe/Berlin"):
        assert [r.zone for r in offset_histories(ev, spark.createDataFrame([("p", tz)], "source string, tz string")).collect()] == [tz]
    assert [r.zone for r in offset_histories(ev, spark.createDataFrame([], "source string, tz string")).collect()] == ["UTC"]


def test_a_source_that_moves(spark):
    # stated offsets tell that the desk went from Tokyo to New York in July; open readings follow
    rows = [(m * 100 + d, "x", f"2025-{m:02d}-{d:02d}T12:00:00{'+09:00' if m < 7 else '-04:00'}") for m in range(4, 11) for d in range(1, 9)]
    rows += [(m * 100 + 50, "x", f"2025-{m:02d}-10 12:00:00") for m in (1, 5, 9, 10)] + [(1, "y", "2025-05-10 12:00:00"), (2, None, "2025-05-10 12:00:00")]
    df = spark.createDataFrame(rows, "i int, source string, text string").withColumns({"since": F.lit(1), "zone": F.lit("Mars"), "seen": F.lit(None).cast("timestamp")})
    read = read_moments(df, "text").drop("zone", "since")
    declared = spark.createDataFrame([("x", "Asia/Tokyo"), ("y", "Europe/Berlin"), (None, "Asia/Tokyo")], "source string, tz string")
    history = offset_histories(zone_evidence(read, ["UTC", "Asia/Tokyo", "America/New_York", "Europe/Berlin"]), declared)
    assert [(r.zone, r.since, r.until) for r in sorted(history.filter("source = 'x'").collect(), key=lambda r: str(r.until))] == [
        ("Asia/Tokyo", None, dt.date(2025, 7, 1)), ("America/New_York", dt.date(2025, 7, 1), None)
    ]
    got = {r.i: r.e for r in place(read, history, declared).select("i", resolve(F.col("m"), F.col("zone")).alias("e")).collect()}
    assert got[150] == ms(2025, 1, 10, 3) and got[550] == ms(2025, 5, 10, 3) and got[950] == ms(2025, 9, 10, 16) and got[1050] == ms(2025, 10, 10, 16)
    assert got[1] == ms(2025, 5, 10, 10) and got[2] == ms(2025, 5, 10, 12) and len(got) == len(rows)
