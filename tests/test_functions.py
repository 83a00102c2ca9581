import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from tidemark import functions as C


def values(spark, column, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_parse_snapshot_date(spark):
    texts = ["17.14.11", "bad", None, "17.31.02", "2017-11-14", "17.11.14 ", "", "18.01.02"]
    got = values(spark, C.parse_snapshot_date("x"), *texts)
    assert got == [date(2017, 11, 14), None, None, None, None, None, None, date(2018, 2, 1)]


def test_to_long(spark):
    assert values(spark, C.to_long("x"), "12", "x", "", None, "-3", "9" * 30) == [12, None, None, None, -3, None]


def test_to_long_cuts_decimals_like_the_lenient_cast(spark):
    texts = ["12.7", "-3.9", "5.", ".5", " 7 ", "1e3", "9" * 30, "", ".", "-.5", "+4.2", "1.2.3", "..5", "-", "12.x", "0.9 ", "a.5"]
    got = values(spark, C.to_long("x"), *texts)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert got == values(spark, F.col("x").cast("long"), *texts)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_ratio(spark):
    frame = spark.createDataFrame([(3, 2), (1, 0), (None, 1), (0, 5)], "a long, b long")
    assert [r[0] for r in frame.select(C.ratio("a", "b")).collect()] == [1.5, None, None, 0.0]


def test_split_tags(spark):
    got = values(spark, C.split_tags("x"), '"a"|"b"|"a"', "", "[none]", None, "a|", "a.b|c")
    assert got == [["a", "b", "a"], [""], ["[none]"], None, ["a", ""], ["a.b", "c"]]


def test_spread(spark):
    frame = spark.createDataFrame([([5, 1, 9],), ([4],), ([],), ([None, 2, 6],)], "v array<long>")
    assert [r[0] for r in frame.select(C.spread("v")).collect()] == [8, 0, None, 4]


def test_week_and_periods_match_plain_python(spark):
    rng = random.Random(1)
    days = [date(2000, 1, 1) + timedelta(days=rng.randrange(36000)) for _ in range(300)]
    frame = spark.createDataFrame([(d,) for d in days], "d date").select(
        "d",
        C.week_start("d").alias("monday"),
        C.week_end("d").alias("sunday"),
        C.period_ends(F.col("d"), F.date_add("d", 29)).alias("ends"),
        C.period_start("d").alias("start"),
    )
    for r in frame.collect():
        assert r.monday == r.d - timedelta(days=r.d.weekday())
        assert r.sunday == r.monday + timedelta(days=6)
        assert r.ends == [r.d + timedelta(days=i) for i in range(30)]
        assert r.start == r.d - timedelta(days=30)


def test_week_does_not_depend_on_zone(spark):
    frame = spark.createDataFrame([(date(2024, 3, 31),)], "d date")
    try:
        for zone in ("America/Sao_Paulo", "Pacific/Apia", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert frame.select(C.week_start("d")).first()[0] == date(2024, 3, 25)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_minutes(spark):
    text = "2017-10-31 22:00:59"
    assert values(spark, C.minute_text("x"), text, None) == ["2017-10-31 22:00", None]
    assert values(spark, C.minute_key("x"), text) == ["2017_10_31_22_00_00"]
    minute = C.minute_of(F.to_timestamp("x")).cast("string")
    assert values(spark, minute, text) == ["2017-10-31 22:00:00"]


def test_utc_now_text(spark):
    rows = spark.range(1)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        tokyo = rows.select(C.utc_now_text()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    utc = rows.select(C.utc_now_text()).first()[0]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", utc)
    assert tokyo[:13] <= utc[:13] and utc[:10] >= tokyo[:10]
    assert abs(int(tokyo[11:13]) - int(utc[11:13])) in (0, 1, 23)


def test_pairs_are_packed_in_their_order(spark):
    """Quotients of extreme, equal and missing longs, with numbers of any size, against the order of tuples."""
    source = random.Random(3)
    longs = [0, 1, -1, 2**63 - 1, -(2**63), 3, 7, 10, 97, 2**52, 2**53 - 1, 2**53 + 1]
    longs += [source.randrange(-(2**63), 2**63) for _ in range(20)] + [source.randrange(100) for _ in range(20)]
    rows = [(a, b, v) for a in longs for b in longs for v in source.sample(longs, 2)] + [(None, 1, 5), (1, None, None), (5, 2, None)]
    frame = spark.createDataFrame(rows, "a long, b long, v long").withColumn("q", F.try_divide("a", "b"))
    frame = frame.withColumn("packed", C.pair_order("q", "v")).withColumn("back", C.number_of_pair("packed"))
    found = frame.collect()
    assert all(r.back == r.v for r in found)
    key = lambda r: (r.q is not None, r.q or 0.0, r.v is not None, r.v or 0)
    found.sort(key=key)
    for a, b in zip(found, found[1:]):
        assert (key(a) < key(b)) == (a.packed < b.packed) and (key(a) == key(b)) == (a.packed == b.packed)
