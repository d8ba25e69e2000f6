import itertools
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from emberline.ml import curves, evaluate, explain, models, prep, scoring, split, trees, treeshap
from emberline.schemas import CONTINUOUS, LABEL
from emberline.session import scratch_path
from emberline.sources import synthetic
from emberline.sources.stage import read_stage, write_stage

SETTINGS = models.Settings(trees=8, tree_depth=6, rounds=5, round_depth=4, epochs=25)


@pytest.fixture(scope="module")
def table(spark):
    rows = synthetic.synthetic_training(spark.range(1500))
    rows = synthetic.inject_nulls(rows, "id", ["umidade", "velocidade_vento", "ndvi"])
    return read_stage(spark, write_stage(rows, scratch_path(spark, "training")))


@pytest.fixture(scope="module")
def prepared(table):
    train, test = split.train_test(table, LABEL, "id")
    fitted = models.preparation().fit(train)
    return fitted, train, fitted.transform(train).cache(), fitted.transform(test).cache()


@pytest.fixture(scope="module")
def fitted_models(prepared):
    fitted, _, train, _ = prepared
    inputs = len(models.feature_names(fitted))
    return {name: models.fit_classifier(name, train, inputs, SETTINGS)
            for name in (models.FOREST, models.BOOSTING, models.NETWORK)}


def test_split_is_exact_per_label(table):
    flagged = split.stratified_split(table, LABEL, "id")
    for row in flagged.groupBy(LABEL).agg(F.count("id").alias("n"), F.count_if("teste").alias("t")).collect():
        assert row["t"] == int(0.2 * row["n"] + 0.5)
    again = split.stratified_split(table.repartition(11), LABEL, "id")
    assert flagged.filter("teste").select("id").exceptAll(again.filter("teste").select("id")).count() == 0


def test_preparation_against_numpy(table):
    model = prep.RiskPrep().fit(table)
    frame = model.transform(table).toPandas()
    raw = prep.engineer(table, model.getOrDefault(model.humidityMedian)).toPandas()
    for c in CONTINUOUS:
        values = raw[c].astype(float).to_numpy()
        q1, q3 = np.nanquantile(values, [0.25, 0.75])
        values = np.clip(values, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
        values = np.where(np.isnan(values), np.nanmedian(values), values)
        np.testing.assert_allclose(frame[f"x_{c}"], (values - values.mean()) / values.std(), atol=1e-9)


def test_unknown_category_is_all_zero(prepared, table):
    fitted = prepared[0]
    names = models.feature_names(fitted)
    hot = [i for i, n in enumerate(names) if "=" in n]
    odd = fitted.transform(table.limit(3).withColumns({"bioma": F.lit("Novo"), "estado": F.lit(None).cast("string")}))
    x = np.array([r[0] for r in odd.select(vector_to_array("features")).collect()])
    biome = [i for i in hot if names[i].startswith("bioma")]
    assert x[:, biome].sum() == 0 and (x[:, hot].sum(axis=1) == 1).all()


def test_all_null_column_is_harmless(table):
    broken = table.withColumn("ndvi", F.lit(None).cast("double"))
    frame = prep.RiskPrep().fit(broken).transform(broken).select("x_ndvi").toPandas()
    assert (frame["x_ndvi"] == 0).all()


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows", [
    [(int(v > 0.5), round(float(v + w) / 2, 2)) for v, w in np.random.default_rng(4).random((300, 2))],
    [(i % 2, 0.5) for i in range(50)], [(1, 0.1), (0, 0.9)]])
@pytest.mark.parametrize("ranges", [1, 7])
def test_auc_against_pairs(spark, rows, ranges):
    df = spark.createDataFrame(rows, "y int, s double").repartition(3)
    assert evaluate.auc(df, "y", "s", ranges=ranges).first()["auc"] == pytest.approx(brute_auc(rows))


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (1, 0, 0.6)], "y int, p int, s double")
    row = evaluate.classification_metrics(df, "y", "p", "s").first()
    assert row["auc"] is None and row["precisao"] == 1.0 and row["recall"] == 0.5
    nothing = evaluate.classification_metrics(df.withColumn("p", F.lit(0)), "y", "p", "s").first()
    assert (nothing["precisao"], nothing["f1"]) == (0.0, 0.0)


@pytest.mark.parametrize("cells, published", [
    ((989, 76, 86, 350), (0.8921, 0.8216, 0.8028, 0.8121)), ((986, 79, 89, 347), (0.8881, 0.8146, 0.7959, 0.8051)),
    ((998, 67, 106, 330), (0.8847, 0.8312, 0.7569, 0.7923))])
def test_published_measures_follow_from_their_cells(spark, cells, published):
    vn, fp, fn, vp = cells
    rows = [(0, 0)] * vn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * vp
    df = spark.createDataFrame(rows, "y int, p int").withColumn("s", F.col("p").cast("double"))
    row = evaluate.classification_metrics(df, "y", "p", "s").first()
    assert (row["acuracia"], row["precisao"], row["recall"], row["f1"]) == published


def test_confusion_has_all_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    assert sorted(map(tuple, evaluate.confusion_matrix(df, "y", "p").collect())) == [
        (0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 2)]


def test_leaderboard_prefers_the_earlier_on_a_tie(spark):
    df = spark.createDataFrame([("b", 1, 0.8), ("a", 0, 0.8), ("c", 2, 0.9)], "modelo string, ordem int, f1 double")
    assert [r[0] for r in evaluate.leaderboard(df).collect()] == ["c", "a", "b"]


def exact_shapley(tree, row):
    """Shapley values of the path-dependent game by enumeration."""
    used = sorted({int(f) for f, left in zip(tree.feature, tree.left) if left >= 0})

    def value(node, known):
        if tree.left[node] < 0:
            return tree.value[node]
        f = int(tree.feature[node])
        children = (tree.left[node], tree.right[node])
        if f in known:
            return value(children[0] if row[f] <= tree.threshold[node] else children[1], known)
        return sum(tree.cover[c] / tree.cover[node] * value(c, known) for c in children)

    result = np.zeros(len(row))
    n = len(used)
    for f in used:
        rest = [u for u in used if u != f]
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for chosen in itertools.combinations(rest, size):
                result[f] += weight * (value(0, {*chosen, f}) - value(0, set(chosen)))
    return result


def test_tree_shap_equals_enumeration(spark):
    rows = spark.range(400).selectExpr(*[f"(xxhash64(id, {i}) % 1000) / 1000 as f{i}" for i in range(5)]).withColumn(
        LABEL, F.expr("cast(f0 + f1 * f2 - f3 > 0.2 as int)"))
    ready = VectorAssembler(inputCols=[f"f{i}" for i in range(5)], outputCol="features").transform(rows)
    model = models.fit_classifier(models.FOREST, ready, 5, models.Settings(trees=3, tree_depth=7))
    ensemble = trees.load_ensemble(spark, model)
    x = np.array([r[0].toArray() for r in ready.select("features").limit(25).collect()])
    found = treeshap.shap_values(ensemble, x)
    for row, impacts in zip(x, found):
        expected = sum(exact_shapley(t, row) * w for t, w in zip(ensemble.trees, ensemble.weights))
        np.testing.assert_allclose(impacts, expected, atol=1e-12)


def test_tree_shap_of_a_feature_used_again_a_lone_leaf_and_a_missing_number():
    # x0 <= 5, then x0 <= 2 on the left and x1 <= 1 on the right; the second tree never splits
    split_twice = trees.Tree(
        feature=np.array([0, 0, 1, 0, 0, 0, 0]), threshold=np.array([5.0, 2.0, 1.0, 0, 0, 0, 0]),
        left=np.array([1, 3, 5, -1, -1, -1, -1]), right=np.array([2, 4, 6, -1, -1, -1, -1]),
        value=np.array([0, 0, 0, 1.0, -2.0, 4.0, 8.0]), cover=np.array([10.0, 6, 4, 5, 1, 2, 2]))
    none = np.array([-1])
    leaf = trees.Tree(np.zeros(1, dtype=int), np.zeros(1), none, none, np.array([3.0]), np.array([10.0]))
    ensemble = trees.Ensemble([split_twice, leaf], [0.5, 2.0], True)
    x = np.array([[1.0, 0.0], [2.0, 9.0], [3.0, 1.0], [6.0, 1.0], [np.inf, 2.0], [-np.inf, 0.0], [np.nan, np.nan]])
    found = treeshap.shap_values(ensemble, x)
    for row, impacts in zip(np.where(np.isnan(x), np.inf, x), found):
        np.testing.assert_allclose(impacts, exact_shapley(split_twice, row) * 0.5, atol=1e-12)
    total = treeshap.expected_value(ensemble) + found.sum(axis=1)
    np.testing.assert_allclose(total, 0.5 * split_twice.predict(x) + 6.0, atol=1e-12)
    assert treeshap.shap_values(ensemble, x[:0]).shape == (0, 2)


def test_tree_shap_does_not_depend_on_the_block(monkeypatch):
    draw = np.random.default_rng(3)
    inner = 63
    feature, threshold = draw.integers(0, 4, 127), draw.random(127)
    left = np.where(np.arange(127) < inner, 2 * np.arange(127) + 1, -1)
    right = np.where(left < 0, -1, left + 1)
    cover = np.ones(127)
    for node in reversed(range(inner)):
        cover[node] = cover[left[node]] + cover[right[node]]
    tree = trees.Tree(feature, threshold, left, right, draw.random(127), cover)
    x = draw.random((50, 4))
    whole = treeshap.shap_values(trees.Ensemble([tree], [1.0], False), x)
    monkeypatch.setattr(treeshap, "BLOCK_CELLS", 1)
    np.testing.assert_allclose(treeshap.shap_values(trees.Ensemble([tree], [1.0], False), x), whole, atol=1e-14)
    for row, impacts in zip(x[:5], whole):
        np.testing.assert_allclose(impacts, exact_shapley(tree, row), atol=1e-12)


def test_forest_explanations_add_up(prepared, fitted_models):
    fitted, _, _, test = prepared
    names = models.feature_names(fitted)
    impacts = explain.explain_trees(fitted_models[models.FOREST], test, "id", names)
    sums = impacts.groupBy("id").agg((F.sum("impacto") + F.first("base")).alias("total"), F.count("atributo").alias("n"))
    scored = models.positive_probability(fitted_models[models.FOREST].transform(test)).select("id", "probabilidade")
    rows = sums.join(scored, "id").collect()
    assert len(rows) == test.count() and all(r["n"] == len(names) for r in rows)
    assert max(abs(r["total"] - r["probabilidade"]) for r in rows) < 1e-9


def test_boosting_explanations_add_up_to_the_margin(prepared, fitted_models):
    fitted, _, _, test = prepared
    impacts = explain.explain_trees(fitted_models[models.BOOSTING], test, "id", models.feature_names(fitted))
    sums = impacts.groupBy("id").agg((F.sum("impacto") + F.first("base")).alias("total"))
    scored = models.positive_probability(fitted_models[models.BOOSTING].transform(test)).select("id", "probabilidade")
    assert max(abs(1 / (1 + math.exp(-2 * r["total"])) - r["probabilidade"]) for r in sums.join(scored, "id").collect()) < 1e-9


def test_network_forward_pass_and_sampled_explanations(spark, prepared, fitted_models):
    fitted, _, train, test = prepared
    model = fitted_models[models.NETWORK]
    scored = models.positive_probability(model.transform(test)).select("id", vector_to_array("features").alias("x"),
                                                                     "probabilidade").limit(20).collect()
    predict = explain.network_probability(list(model.getLayers()), model.weights.toArray())
    np.testing.assert_allclose(predict(np.array([r["x"] for r in scored])), [r["probabilidade"] for r in scored], atol=1e-9)
    background = explain.background_rows(train, "id", 10)
    assert background.shape[0] == 10
    few = test.filter(F.col("id").isin([r["id"] for r in scored]))
    impacts = explain.explain_network(model, few, background, "id", models.feature_names(fitted), samples=60)
    totals = {r["id"]: r["t"] for r in impacts.groupBy("id").agg((F.sum("impacto") + F.first("base")).alias("t")).collect()}
    assert all(abs(totals[r["id"]] - r["probabilidade"]) < 1e-9 for r in scored)


def test_kernel_is_exact_for_a_linear_model():
    draw = np.random.default_rng(0)
    weights, background, rows = draw.normal(size=6), draw.normal(size=(30, 6)), draw.normal(size=(4, 6))
    found = explain.KernelExplainer(lambda x: x @ weights, background, samples=200)(rows)
    np.testing.assert_allclose(found, (rows - background.mean(axis=0)) * weights, atol=1e-9)


def test_masked_network_equals_masked_inputs():
    draw = np.random.default_rng(4)
    layers = [6, 5, 4, 2]
    weights = draw.normal(size=sum(a * b + b for a, b in zip(layers, layers[1:])))
    predict = explain.network_probability(layers, weights)
    background, rows = draw.normal(size=(9, 6)), draw.normal(size=(23, 6))
    split, plain = (explain.KernelExplainer(p, background, samples=40) for p in (predict, lambda x: predict(x)))
    np.testing.assert_allclose(split(rows), plain(rows), atol=1e-9)
    np.testing.assert_allclose(split(rows).sum(axis=1), predict(rows) - predict(background).mean(), atol=1e-9)
    mask = split.masks[7]
    mixed = [mask * rows[3] + (1 - mask) * b for b in background]
    assert split._seen(rows)[3, 7] == pytest.approx(predict(np.array(mixed)).mean(), abs=1e-12)
    assert split(rows[:0]).shape == (0, 6)


def test_prefix_scores_end_at_the_model(prepared, fitted_models):
    test = prepared[3]
    for name, steps in ((models.FOREST, [4, 8]), (models.BOOSTING, [2, 5])):
        model = fitted_models[name]
        ours = curves.tree_prefix_scores(model, test, steps).filter(F.col("passo") == steps[-1])
        theirs = models.positive_probability(model.transform(test))
        a = np.sort([r[0] for r in ours.select("probabilidade").collect()])
        b = np.sort([r[0] for r in theirs.select("probabilidade").collect()])
        np.testing.assert_allclose(a, b, atol=1e-9)
        curve = curves.tree_curve(model, test, steps).collect()
        assert [r["passo"] for r in curve] == steps and all(0 <= r["auc"] <= 1 and r["perda"] > 0 for r in curve)


def test_network_curve_learns(prepared):
    fitted, _, train, test = prepared
    rows = curves.network_curve(train, test, len(models.feature_names(fitted)), epochs=4, hidden=(8,)).collect()
    assert [r["epoca"] for r in rows] == [1, 2, 3, 4] and rows[-1]["perda"] < rows[0]["perda"]


def test_step_lists():
    assert curves.forest_steps(12) == [5, 10] and curves.boosting_steps(60) == [20, 40, 60]


def test_comparison_saves_and_reloads(spark, table):
    train, test = split.train_test(table, LABEL, "id")
    result = models.compare(train, test, SETTINGS, (models.FOREST, models.BOOSTING))
    rows = result.metrics.collect()
    assert rows[0]["modelo"] == result.best and rows[0]["f1"] >= rows[1]["f1"] and rows[0]["auc"] > 0.7
    folder = scratch_path(spark, "models")
    result.save(folder)
    again = PipelineModel.load(f"{folder}/modelo")
    a = scoring.score(result.pipeline(), test).orderBy("id").select("probabilidade", "nivel").collect()
    b = scoring.score(again, test).orderBy("id").select("probabilidade", "nivel").collect()
    assert a == b
    assert scoring.alerts(scoring.score(again, test)).filter("probabilidade < 0.7").count() == 0
    path = models.write_metrics(result.metrics, result.best, scratch_path(spark, "metrics"))
    assert spark.read.json(path).filter("melhor").first()["modelo"] == result.best


def test_waterfall_ends_at_the_output(spark):
    rows = [("r", i, f"f{i}", 0.0, (-1) ** i * (i + 1) / 10, 0.5) for i in range(20)]
    impacts = spark.createDataFrame(rows, "k string, posicao int, atributo string, valor double, impacto double, base double")
    steps = explain.waterfall(impacts, "k", 14).orderBy(F.desc("ordem")).collect()
    assert len(steps) == 14 and steps[0]["atributo"] == "outros" and steps[0]["inicio"] == pytest.approx(0.5)
    assert steps[-1]["atributo"] == "f19" and steps[-1]["fim"] == pytest.approx(0.5 + sum(r[4] for r in rows))
    assert explain.waterfall(impacts.filter("posicao < 14"), "k", 14).filter("atributo = 'outros'").count() == 0
    assert [r["atributo"] for r in explain.top_features(impacts, "k", 2).orderBy("ordem").collect()] == ["f19", "f18"]
