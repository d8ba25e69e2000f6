import math

import pytest
from pyspark.sql import functions as F

from emberline import fixtures as fx
from emberline import schemas
from emberline.plans import marts
from emberline.plans import warehouse as wh
from emberline.session import scratch_path, write_once


@pytest.fixture(scope="module")
def treated(spark, sf_dir):
    return fx.treated(spark, sf_dir)


def test_binding(spark):
    rows = spark.createDataFrame(
        [("k", 1.00005, math.nan, "", "2026-05-31", "x" * 30, None, "Bioma com nome comprido", None)],
        "id_externo string, latitude double, brilho double, satelite string, data string, extra string, "
        "estado string, bioma string, estacao_seca int").withColumn("longitude", F.lit(2.0))
    bound = wh.bind_detections(rows)
    assert [f.dataType for f in bound.schema] == [f.dataType for f in schemas.DETECTIONS]
    row = bound.first()
    assert (row["brilho"], row["satelite"], row["estado"], row["bioma"]) == (None, None, "??", "Bioma com nome compr")
    assert row["frp"] is None and str(row["data_foco"]) == "2026-05-31"
    assert wh.bind_weather(rows).first()["estacao_seca"] == 0


def test_loading_twice_changes_nothing(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    assert store.detections().count() == 0
    store.load(treated.filter("seq % 2 = 0"))
    store.load(treated)
    first = store.detections().collect(), store.weather().collect()
    store.load(treated)
    assert (len(store.detections().collect()), len(store.weather().collect())) == tuple(map(len, first))
    assert store.detections().count() == treated.count()
    assert store.detections().exceptAll(wh.bind_detections(treated)).count() == 0
    report = wh.constraint_report(store.detections(), store.weather(), store.images())
    assert {row["violacoes"] for row in report.collect()} == {0}


def test_half_done_load_is_completed(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    store.merge_detections(treated)
    assert store.weather().count() == 0
    store.load(treated)
    assert store.detections().count() == store.weather().count() == treated.count()


def test_first_row_of_a_repeated_key_wins(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    one = treated.limit(1).drop("ordinal")
    rows = one.withColumns({"ordinal": F.lit(2), "frp": F.lit(9.0)}).unionByName(
        one.withColumns({"ordinal": F.lit(1), "frp": F.lit(7.0)}))
    store.load(rows)
    store.load(rows.withColumn("frp", F.lit(1.0)))
    assert [float(r["frp"]) for r in store.detections().collect()] == [7.0]


def test_a_key_comes_in_once_whatever_its_date(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    some = treated.limit(3).drop("data")
    other = some.withColumn("id_externo", F.concat(F.lit("SYN"), F.col("id_externo")))
    store.load(some.unionByName(other))
    for shift in (0, 4, -400):
        store.load(some.unionByName(other).withColumn("data_foco", F.date_add("data_foco", shift)))
    assert store.detections().count() == store.weather().count() == 6
    moved = some.withColumns({"data_foco": F.date_add("data_foco", 9), "id_externo": F.concat("id_externo", F.lit("0"))})
    store.load(moved)
    store.load(moved.withColumn("data_foco", F.date_sub("data_foco", 9)))
    assert store.detections().count() == store.weather().count() == 9


def test_undated_rows_are_refused(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    rows = treated.limit(2).drop("data")
    undated = rows.withColumn("data_foco", F.lit(None).cast("date"))
    with pytest.raises(wh.ConstraintError):
        store.load(rows.unionByName(undated.withColumn("id_externo", F.lit("x"))))
    assert store.detections().count() == 0


def test_an_unmarked_load_is_not_seen(spark, treated, monkeypatch):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    bind = dict(wh._BIND)
    monkeypatch.setitem(wh._BIND, "clima_associado", lambda rows: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.load(treated)
    assert store.detections().count() == 0
    monkeypatch.setitem(wh._BIND, "clima_associado", bind["clima_associado"])
    store.load(treated)
    assert store.detections().count() == store.weather().count() == treated.count()


def test_merge_reads_only_the_batch_dates(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    store.load(treated)
    day = treated.select("data_foco").first()[0]
    plan = store.reachable("focos_incendio", [day], ["outra1"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(((forma" in plan
    files = store.reachable("focos_incendio", [day], []).inputFiles()
    assert files
    fresh = wh.new_rows(wh.bind_detections(treated.filter(F.col("data_foco") == day)),
                        store.reachable("focos_incendio", [day], ["outra1"]))
    scanned = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(((forma" in scanned and fresh.count() == 0


def test_undated_keys_read_their_own_parts_only(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    some = treated.withColumn("id_externo", F.concat(F.lit("SYN"), F.xxhash64("id_externo")))
    store.load(some)
    ten = some.orderBy("id_externo").limit(10)
    parts = [r[0] for r in ten.select(wh._bucket()).distinct().collect()]
    everything = store.read("focos_incendio").select("forma").distinct().count()
    read = store.reachable("focos_incendio", [], parts)
    assert len(parts) <= 10 < everything
    assert {r.forma for r in read.select("forma").distinct().collect()} == set(parts)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [forma" in plan and "BroadcastHashJoin" in plan
    store.load(ten)
    assert store.detections().count() == some.count()


def test_a_load_that_overlaps_another_is_refused(spark, treated):
    root = scratch_path(spark, "wh")
    first, second = wh.Warehouse(spark, root), wh.Warehouse(spark, root)
    first.load(treated.limit(5))
    commit = second._mark

    def overtaken(load, number):
        second._mark = commit
        first.load(treated)
        commit(load, number)

    second._mark = overtaken
    with pytest.raises(wh.ConcurrentLoadError):
        second.load(treated)
    keys = second.detections().groupBy("id_externo").count()
    assert keys.count() == treated.count() and keys.filter("count > 1").count() == 0
    second.load(treated)
    assert second.detections().count() == second.weather().count() == treated.count()


def test_a_mark_that_was_not_finished_hides_its_load(spark, treated):
    store = wh.Warehouse(spark, scratch_path(spark, "wh"))
    store.load(treated.limit(3))
    assert write_once(spark, f"{store.path('_cargas')}/{2:020d}", "")
    assert not write_once(spark, f"{store.path('_cargas')}/{2:020d}", "x")
    store.load(treated)
    assert store.detections().count() == treated.count()


def test_failure_leaves_evidence_and_says_so(spark, treated):
    treated = treated.withColumn("ordinal", F.struct(F.lit(1).alias("idade"), F.col("ordinal").alias("linha")))
    evidence = scratch_path(spark, "evidence")
    result = wh.Warehouse(spark, "nowhere://x").load_or_quarantine(treated, evidence)
    assert result.status == "quarentena" and result.rows == 0 and result.detail
    assert spark.read.option("header", True).csv(evidence).count() == treated.count()
    done = wh.Warehouse(spark, scratch_path(spark, "wh")).load_or_quarantine(treated, evidence)
    assert done.status == "carregado" and done.rows == treated.count()


def star(spark):
    facts = spark.createDataFrame(
        [("a", "PA", "X", 60.0), ("b", "PA", "X", 80.0), ("c", "PA", "X", 90.0), ("d", "PA", "X", 70.0),
         ("e", "MT", "Y", 10.0), ("f", "MT", "Y", None)], "id_externo string, estado string, bioma string, frp double")
    weather = facts.select("id_externo", F.lit(30.0).alias("umidade"))
    images = spark.createDataFrame([("a", "fogo"), ("a", None), ("b", "nao_fogo"), ("c", "nao_fogo"), ("c", "fogo")],
                                   "id_externo string, classificacao string")
    return facts, weather, images


def test_critical_rows_keep_unmatched_and_unclassified(spark):
    facts, weather, images = star(spark)
    keys = sorted(r["id_externo"] for r in marts.critical_rows(facts, weather, images).collect())
    assert keys == ["a", "a", "c", "d"]
    by_image = marts.critical_hotspots(facts, weather, images).first()
    assert (by_image["focos_criticos"], by_image["frp_medio"], by_image["frp_max"]) == (4, 70.0, 90.0)
    once = marts.critical_hotspots_distinct(facts, weather, images).first()
    assert (once["focos_criticos"], once["frp_medio"]) == (3, 73.3)


def test_strongest_is_a_heap_and_puts_null_last(spark):
    facts = star(spark)[0].withColumns({"brilho": F.lit(1.0), "data_foco": F.lit("2024-01-01")})
    top = marts.strongest(facts.unionByName(facts.withColumn("id_externo", F.lit("A0"))), 3)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert [r["id_externo"] for r in top.collect()][:2] == ["A0", "c"]
    assert [r["frp"] for r in marts.strongest(facts, 10).collect()][-1] is None


def test_cleaning_plan_has_no_python(spark, sf_dir):
    plan = fx.treated(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
