import numpy as np
from pyspark.sql import functions as F

from emberline import lookups
from emberline.functions import random as r
from emberline.operators import boxes, enrich
from emberline.sources import synthetic
from emberline.sources import weather as sw

BOXES = [("A", 0.0, 10.0, 0.0, 10.0), ("B", 5.0, 15.0, 5.0, 15.0)]
POINTS = [(0, 10.0, 10.0, "A"), (1, 10.1, 10.0, "B"), (2, 15.0, 15.0, "B"), (3, 7.0, 7.0, "A"),
          (4, 20.0, 20.0, "??"), (5, None, 1.0, "??")]


def points(spark):
    return spark.createDataFrame([p[:3] for p in POINTS], "i int, latitude double, longitude double")


def test_first_box_wins_on_shared_edges(spark):
    found = {row["i"]: row["b"] for row in points(spark).withColumn("b", boxes.box_label(BOXES, "??")).collect()}
    assert found == {p[0]: p[3] for p in POINTS}


def test_box_table_agrees(spark):
    table = spark.createDataFrame([(*box, i) for i, box in enumerate(BOXES)],
                                  "nome string, lat_min double, lat_max double, lon_min double, lon_max double, prioridade int")
    found = {row["i"]: row["b"] for row in boxes.locate(points(spark), table, "i", "b", "??").collect()}
    assert found == {p[0]: p[3] for p in POINTS}


def test_box_table_against_brute_force(spark):
    draw = np.random.default_rng(5)
    size = np.exp(draw.uniform(-4, 3, 300))
    table = [(f"b{i}", float(a), float(a + h), float(o), float(o + h * 0.7), i) for i, (a, o, h) in
             enumerate(zip(draw.uniform(-30, 5, 300), draw.uniform(-70, -35, 300), size))]
    # a third of the points in one spot
    spots = [(i, -10.0, -50.0) if i % 3 == 0 else (i, float(draw.uniform(-34, 6)), float(draw.uniform(-74, -34)))
             for i in range(600)]
    expected = {i: next((n for n, a, b, c, d, _ in table if a <= y <= b and c <= x <= d), "-") for i, y, x in spots}
    df = spark.createDataFrame(spots, "i int, latitude double, longitude double")
    lookup = spark.createDataFrame(
        table, "nome string, lat_min double, lat_max double, lon_min double, lon_max double, prioridade int")
    assert {r["i"]: r["n"] for r in boxes.locate(df, lookup, "i", "n", "-").collect()} == expected


def test_tables_are_complete():
    assert len(lookups.STATE_BOXES) == 19 and len(lookups.BIOME_BOXES) == 6
    assert set(lookups.NDVI_BY_BIOME) == {b[0] for b in lookups.BIOME_BOXES} | {"Desconhecido"}


def test_batch_replies(spark):
    body = ('[{"current":{"temperature_2m":30.5,"relative_humidity_2m":40,"wind_speed_10m":3,"precipitation":null}},'
            '{"current":null},{"current":{}},{"other":1},'
            '{"current":{"temperature_2m":1,"relative_humidity_2m":2,"wind_speed_10m":3,"precipitation":4}}]')
    bare = '{"current":{"temperature_2m":9,"relative_humidity_2m":8,"wind_speed_10m":7}}'
    rows = [(0, list("abcdef"), body), (1, ["z"], bare), (2, ["x"], "erro"), (3, ["y"], None)]
    landed = spark.createDataFrame(rows, "lote int, ids array<string>, corpo string")
    parsed = sw.parse_batches(landed)
    found = {r[0]: tuple(r)[1:] for r in parsed.drop("ordinal").collect()}
    assert [r[0] for r in parsed.orderBy("ordinal").collect()] == ["a", "e", "z"]
    assert found == {"a": (30.5, 40.0, 3.0, 0.0), "e": (1.0, 2.0, 3.0, 4.0), "z": (9.0, 8.0, 7.0, 0.0)}


def test_single_replies(spark):
    rows = [("a", '{"main":{"temp":30,"humidity":50},"wind":{"speed":10},"rain":{"1h":2.5}}'),
            ("b", '{"main":{"temp":30,"humidity":50}}'), ("c", '{"main":{"temp":30}}'), ("d", "nada"), ("e", None)]
    found = {r[0]: tuple(r)[1:] for r in sw.parse_single(
        spark.createDataFrame(rows, "id_externo string, corpo string")).drop("ordinal").collect()}
    assert found == {"a": (30.0, 50.0, 36.0, 2.5), "b": (30.0, 50.0, 0.0, 0.0)}


def test_enrichment_edges(spark):
    focus = spark.createDataFrame([("a",), ("b",), ("c",)], "id_externo string")
    schema = "id_externo string, temperatura string, umidade double, vento double, precipitacao double, ordinal long"
    weather = spark.createDataFrame([("a", "10", 20.0, None, 0.0, 0), ("a", "99", 99.0, None, 9.0, 1),
                                     ("b", "x", 30.0, None, 0.5, 2), ("zz", "77", 1.0, None, 1.0, 3)], schema)
    rows = {r["id_externo"]: r for r in enrich.enrich(focus, weather).collect()}
    assert [rows[k]["temperatura"] for k in "abc"] == [10.0, 10.0, 10.0]
    assert [rows[k]["umidade"] for k in "abc"] == [20.0, 30.0, 25.0]
    assert rows["a"]["vento"] is None
    assert [rows[k]["estacao_seca"] for k in "abc"] == [1, 0, 1]
    assert enrich.enrich(focus, None).first()["estacao_seca"] == 0
    assert enrich.enrich(focus, weather.limit(0)).filter("estacao_seca = 1").count() == 0


def test_fan_out_is_the_product(spark):
    left = spark.createDataFrame([("a",)] * 4 + [("b",)], "id_externo string")
    right = spark.createDataFrame([("a",)] * 3, "id_externo string")
    assert {tuple(r) for r in enrich.fan_out(left, right).collect()} == {("a", 12, 12), ("b", 1, 0)}
    weather = right.selectExpr("id_externo", "1.0D as temperatura", "1 as ordinal")
    assert enrich.stage_join(left, weather).count() == 5


def test_draws_do_not_depend_on_partitioning(spark):
    one = synthetic.synthetic_training(spark.range(2000).coalesce(1))
    many = synthetic.synthetic_training(spark.range(2000).repartition(13))
    assert one.exceptAll(many).count() == 0 and one.count() == many.count()


def test_distributions(spark):
    cases = {"normal": (r.normal("id", "t", 10, 5), 10, 5), "gamma2": (r.gamma("id", "t", 2.0, 6), 12, 6 * 2 ** 0.5),
             "gamma1_2": (r.gamma("id", "t", 1.2, 3), 3.6, 3 * 1.2 ** 0.5),
             "poisson": (r.poisson("id", "t", 8), 8, 8 ** 0.5), "uniform": (r.uniform("id", "t", 0, 12), 6, 12 ** 0.5)}
    for name, (column, mean, deviation) in cases.items():
        row = spark.range(40_000).select(column.alias("v")).agg(F.avg("v"), F.stddev("v")).first()
        assert abs(row[0] - mean) < 5 * deviation / 200, name
        assert abs(row[1] - deviation) < 0.03 * deviation, name


def test_null_injection_is_exact(spark):
    df = spark.range(12_345).withColumns({"a": F.lit(1.0), "b": F.lit(2.0)})
    blanked = synthetic.inject_nulls(df, "id", ["a", "b"])
    assert blanked.filter("a is null").count() == blanked.filter("b is null").count() == 246
    assert blanked.filter("a is null and b is null").count() < 246
    assert synthetic.inject_nulls(spark.range(10).selectExpr("id", "1 as a"), "id", ["a"]).filter("a is null").count() == 0


def test_dense_boxes_get_short_lists(spark):
    rng = np.random.default_rng(12)
    corner, extent = rng.uniform(-30, 0, (4_000, 2)), rng.uniform(0.5, 9, (4_000, 2))
    rows = [(f"b{i}", *map(float, (c[0], c[0] + e[0], c[1], c[1] + e[1])), int(p))
            for i, (c, e, p) in enumerate(zip(corner, extent, rng.permutation(4_000)))]
    rows += [("twin", -20.0, -10.0, -20.0, -10.0, 10_000 + i) for i in range(60)] + [("odd", 5.0, 4.0, 1.0, 2.0, 0)]
    table = spark.createDataFrame(rows, "nome string, lat_min double, lat_max double, lon_min double, lon_max double, prioridade int")
    cells = boxes.box_cells(table)
    assert cells.groupBy("_level", "_row", "_col").count().agg(F.max("count")).first()[0] <= boxes.CELL_BOXES
    places = [tuple(map(float, p)) for p in rng.uniform(-35, 12, (600, 2))] + [(r[1], r[3]) for r in rows[:100]]
    places += [(r[2], r[4]) for r in rows[:100]] + [(0.0, 0.0), (90.0, 400.0)]
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "k int, latitude double, longitude double")
    got = {r.k: r.lugar for r in boxes.locate(points, table, "k", "lugar", "nenhum").collect()}
    for i, (lat, lon) in enumerate(places):
        found = [(r[5], r[0]) for r in rows if r[1] <= lat <= r[2] and r[3] <= lon <= r[4]]
        assert got[i] == (min(found)[1] if found else "nenhum")


def test_gamma_without_proposals_is_the_inverse(spark):
    rows = spark.range(3_000).select(*[r.gamma("id", f"g{shape}", shape, 2.0, tries=0).alias(f"g{i}")
                                       for i, shape in enumerate((1.2, 2.0, 6.5))],
                                     F.expr(r._unit("id", "g2.0.last", 42)).alias("u")).toPandas()
    for i, shape in enumerate((1.2, 2.0, 6.5)):
        values = rows[f"g{i}"]
        assert abs(values.mean() - 2 * shape) < 4 * 2 * shape ** 0.5 / 3_000 ** 0.5 and values.min() > 0
    x = rows["g1"] / 2
    np.testing.assert_allclose(1 - np.exp(-x) * (1 + x), rows["u"], atol=1e-12)
