import pytest
from pyspark.sql import functions as F

from emberline.functions import scalars as s
from emberline.operators import clean
from emberline.sources import detections as sd


def column(df, name):
    return [row[name] for row in df.orderBy("i").collect()]


@pytest.mark.parametrize("text, percent, kept", [
    ("l", 25.0, False), (" H ", 95.0, True), ("29.9", 29.9, False), ("30", 30.0, True), ("", None, False),
    ("x", None, False), ("nan", None, False), (None, None, False), ("95d", None, False), ("N", 65.0, True)])
def test_confidence(spark, text, percent, kept):
    df = clean.normalise_confidence(spark.createDataFrame([(text,)], "confianca string"))
    assert df.first()[0] == percent
    assert (clean.with_confidence(df).count() == 1) is kept


def test_confidence_filter_is_skipped_without_the_column(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert clean.with_confidence(clean.normalise_confidence(df)).count() == 1


def test_coercion_and_invalid_rows(spark):
    rows = [(0, "1.5", "2", "2026-05-31"), (1, "abc", "2", "2026-05-31"), (2, None, "2", "2026-05-31"),
            (3, "nan", "2", "2026-05-31"), (4, "1", "2", "bad"), (5, "1", "2", "")]
    df = spark.createDataFrame(rows, "i int, latitude string, longitude string, data string").withColumns(
        {c: s.to_number(c) for c in ("latitude", "longitude")})
    assert column(df, "latitude") == [1.5, None, None, None, 1.0, 1.0]
    kept = clean.with_valid_day(clean.parse_day(clean.with_coordinates(df)))
    assert column(kept, "i") == [0]


def test_natural_key(spark):
    rows = [(0, 0.0005, -12.0, "2026-05-31", "7"), (1, -11.6190, -52.54849, "2026-05-31", "0"),
            (2, 100.0, -0.1, "2026-05-31", "2359"), (3, 1.0, 1.0, "2026-05-31", "12345")]
    df = spark.createDataFrame(rows, "i int, a double, b double, d string, t string")
    assert column(df.withColumn("k", s.natural_key("a", "b", "d", "t")), "k") == [
        "0.0005|-12.0|2026-05-31|0007", "-11.619|-52.5485|2026-05-31|0000",
        "100.0|-0.1|2026-05-31|2359", "1.0|1.0|2026-05-31|12345"]


def test_key_falls_back_to_the_position(spark):
    df = spark.createDataFrame([("1", "2", 7)], "latitude string, longitude string, ordinal long")
    assert sd.standardise(df).first()["id_externo"] == "7"


def test_both_brightness_names_are_coalesced(spark):
    df = spark.createDataFrame([(None, 2.0), (1.0, 2.0)], "bright_ti4 double, brightness double")
    assert sorted(r["brilho"] for r in sd.rename_canonical(df).collect()) == [1.0, 2.0]


def test_keep_first_prefers_arrival_after_the_filter(spark):
    rows = [("k", "l", 0, 1.0), ("k", "n", 1, 2.0), ("k", "h", 2, 3.0)]
    df = spark.createDataFrame(rows, "id_externo string, confianca string, ordinal long, frp double").withColumns(
        {"latitude": F.lit(1.0), "longitude": F.lit(1.0)})
    assert clean.clean_detections(df).first()["frp"] == 2.0


def test_keep_first_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 1 as string) as id_externo", "id as ordinal")
    plan = clean.keep_first(df)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(id_externo"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert clean.keep_first(df).collect()[0]["ordinal"] == 0


def test_funnel_counts_each_step(spark):
    rows = [("a", 1.0, "2026-01-01", "n"), ("a", 1.0, "2026-01-01", "h"), ("b", None, "2026-01-01", "h"),
            ("c", 1.0, "x", "h"), ("d", 1.0, "2026-01-01", "l")]
    df = spark.createDataFrame(rows, "id_externo string, latitude double, data string, confianca string").withColumn(
        "longitude", F.lit(1.0))
    assert tuple(clean.funnel(df).first()) == (5, 4, 3, 2, 1)


def test_clip_keeps_null_and_zero_fill_keeps_length(spark):
    df = spark.createDataFrame([(0, None, "7"), (1, 99.0, "12345"), (2, -99.0, "0")], "i int, v double, t string")
    assert column(df.withColumn("c", s.clip("v", 0.0, 10.0)), "c") == [None, 10.0, 0.0]
    assert column(df.withColumn("c", s.clip(F.col("v"), 0.0, 10.0)), "c") == [None, 10.0, 0.0]
    assert column(df.withColumn("z", s.zero_fill("t")), "z") == ["0007", "12345", "0000"]


@pytest.mark.parametrize("probability, tier", [(0.7, "alto"), (0.4, "moderado"), (0.39999, "baixo")])
def test_tiers(spark, probability, tier):
    df = spark.createDataFrame([(probability,)], "probabilidade double")
    assert df.select(s.alert_tier()).first()[0] == tier


def test_rain_proxy_rounds_half_even_and_keeps_null(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 1.5), (2, None), (3, 99.0)], "i int, precipitacao_mm double")
    assert column(df.withColumn("d", s.days_without_rain()), "d") == [30, 28, None, 0]


def test_month_recency_maps_month_ends(spark):
    df = spark.sql("select date'2024-01-31' as d union all select date'2024-01-30' order by d")
    assert [r[0] for r in df.select(s.month_recency("d", "2024-02-29")).collect()] == [False, True]


def test_daily_scan_order_and_missing_days(spark, tmp_path):
    landing = str(tmp_path / "landing")
    header = "latitude,longitude,bright_ti4,acq_date,acq_time,satellite,confidence,frp\n"
    for day, lines in {"2026-05-31": ["1.0,2.0,300,2026-05-31,7,N,n,5", "1.0,2.0,301,2026-05-31,7,N,h,6"],
                       "2026-05-29": ["3.0,4.0,300,2026-05-29,2359,1,n,7"], "2026-05-30": [],
                       "2026-05-01": ["9.0,9.0,300,2026-05-01,1,1,n,7"]}.items():
        folder = tmp_path / "landing" / "sensor=S" / f"date={day}"
        folder.mkdir(parents=True)
        (folder / "part.csv").write_text(header + "".join(line + "\n" for line in lines))
    scanned = sd.scan_daily(spark, landing, "S", "2026-05-31", days=3)
    rows = sd.standardise(scanned).orderBy("ordinal").collect()
    assert [(r["id_externo"], r["brilho"]) for r in rows] == [
        ("1.0|2.0|2026-05-31|0007", 300.0), ("1.0|2.0|2026-05-31|0007", 301.0), ("3.0|4.0|2026-05-29|2359", 300.0)]
    # days outside the window are not even listed
    assert not any("date=2026-05-01" in path for path in scanned.inputFiles())
    assert sd.scan_daily(spark, landing, "T", "2026-05-31") is None
    assert clean.clean_detections(sd.standardise(scanned)).count() == 2


def test_batches_follow_arrival(spark, tmp_path):
    from emberline.sources import weather as sw
    for day in ("2026-05-31", "2026-05-30"):
        folder = tmp_path / "sensor=S" / f"date={day}"
        folder.mkdir(parents=True)
        lines = [f"{i}.0,2.0,300,{day},{i},N,n,5\n" for i in range(7)]
        (folder / "part.csv").write_text("latitude,longitude,bright_ti4,acq_date,acq_time,satellite,confidence,frp\n"
                                         + "".join(lines))
    rows = sd.standardise(sd.scan_daily(spark, str(tmp_path), "S", "2026-05-31"))
    batches = sw.build_batches(rows, size=5).orderBy("lote").collect()
    flat = [key for batch in batches for key in batch["ids"]]
    assert [len(b["ids"]) for b in batches] == [5, 5, 4]
    assert flat == [f"{i}.0|2.0|{day}|{i:04d}" for day in ("2026-05-31", "2026-05-30") for i in range(7)]


def test_cascade_is_for_the_whole_table(spark):
    empty = spark.createDataFrame([], "v int")
    full = spark.createDataFrame([(1,)], "v int")
    called = []
    chosen = sd.first_with_rows([("a", lambda: None), ("b", lambda: empty), ("c", lambda: full),
                                 ("d", lambda: called.append(1))])
    assert chosen.first()["fonte"] == "c" and not called
    assert sd.first_with_rows([("b", lambda: empty)]).count() == 0
