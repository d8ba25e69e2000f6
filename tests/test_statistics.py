import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import order_stats, ordered


@pytest.mark.parametrize("values", [
    list(np.random.default_rng(1).normal(size=4001)),
    [1.0] * 900 + [2.0, 3.0] * 40 + [None] * 50,
    [5.0], [1.0, 2.0], [None, None],
    list(np.exp(np.random.default_rng(2).normal(size=3000) * 20)),
    [7.0] * 3000,
    [1e308, -1e308, 1e-300, 5e-324, 0.0, 3.0] * 50 + [1.7976931348623157e308] * 3,
])
@pytest.mark.parametrize("options", [{}, {"direct": 20}, {"direct": 0}])
def test_quantiles_match_numpy(spark, values, options):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(4)
    shares = [0.0, 0.25, 0.5, 0.613, 0.75, 1.0]
    found = order_stats.quantiles(df, ["v"], shares, **options)["v"]
    present = [v for v in values if v is not None]
    if not present:
        assert found == [None] * len(shares)
    else:
        np.testing.assert_allclose(found, np.quantile(present, shares), rtol=1e-12)


def test_order_statistics_keep_no_distinct_map(spark):
    """Large columns must be searched, not gathered."""
    df = spark.range(200_000).select((F.xxhash64("id") / 1e6).alias("v"))
    expected = np.sort([r[0] for r in df.collect()])
    found = order_stats.kth_values(df, {"v": F.col("v")}, {"v": [0, 77_777, 199_999]}, {"v": 200_000}, direct=500)
    assert [found["v", k] for k in (0, 77_777, 199_999)] == [expected[k] for k in (0, 77_777, 199_999)]


def test_infinite_values_are_found(spark):
    values = [float("-inf")] * 3 + [-1.7976931348623157e308, 2.0, 3.0, 1.7976931348623157e308] + [float("inf")] * 4
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = order_stats.kth_values(df, {"v": F.col("v")}, {"v": range(11)}, {"v": 11}, direct=0)
    assert [found["v", k] for k in range(11)] == sorted(values)


@pytest.mark.parametrize("rows", [1, 7, 100])
def test_cut_points_make_even_ranges(spark, rows):
    values = list(np.exp(np.random.default_rng(2).normal(size=900) * 30)) + [5.0] * 300
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    cuts = order_stats.cut_points(df, "v", rows)
    sizes = np.bincount(np.searchsorted(cuts, values, "right"))
    assert cuts == sorted(set(cuts)) and sorted(sizes)[-2] <= rows and sizes.max() <= max(rows, 300)
    assert len(sizes) <= 2 * len(values) / rows + 2


def test_mode_takes_the_smaller_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "c string")
    assert order_stats.most_frequent(df, "c") == "a"
    assert order_stats.most_frequent(df.filter("c is null"), "c") is None


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_running_sums_match_a_plain_prefix(spark, ranges):
    order = np.random.default_rng(3).permutation(500)
    rows = [(float(k), int(k % 7), "ab"[k % 2]) for k in order]
    df = spark.createDataFrame(rows, "k double, n long, g string").repartition(5)
    total = {r["k"]: r["before"] for r in ordered.running_sums(df, "k", {"before": F.col("n")}, ranges=ranges).collect()}
    grouped = {r["k"]: r["before"] for r in
               ordered.running_sums(df, "k", {"before": F.col("n")}, by=["g"], ranges=ranges).collect()}
    for k in range(500):
        assert total[float(k)] == sum(i % 7 for i in range(k))
        assert grouped[float(k)] == sum(i % 7 for i in range(k % 2, k, 2))


def test_running_sums_use_no_single_partition_sort(spark):
    df = spark.range(1000).withColumn("k", F.col("id").cast("double"))
    plan = ordered.running_sums(df, "k", {"s": F.col("id")})._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    over_rows = [line for line in windows if "_total_" not in line]
    assert len(windows) == 2 and len(over_rows) == 1 and "windowspecdefinition(_range" in over_rows[0]


def test_row_numbers(spark):
    df = spark.createDataFrame([(30.0,), (10.0,), (20.0,)], "k double")
    assert {r["k"]: r["posicao"] for r in ordered.number_rows(df, "k").collect()} == {10.0: 0, 20.0: 1, 30.0: 2}


def test_many_cut_points_cost_no_more_than_few(spark):
    values = np.random.default_rng(8).exponential(size=60_000) ** 3
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(4).cache()
    cuts = order_stats.cut_points(df, "v", 20)
    sizes = np.diff(np.concatenate([[0], np.searchsorted(np.sort(values), cuts), [len(values)]]))
    assert sizes.max() <= 20 and 3_000 < len(cuts) < 6_000
    mixed = [float("-inf")] * 30 + [float("inf")] * 50 + [1e308, -1e308] * 9 + [0.0] * 200 + list(range(90))
    df = spark.createDataFrame([(float(v),) for v in mixed], "v double")
    cuts = order_stats.cut_points(df, "v", 10)
    sizes = np.diff(np.concatenate([[0], np.searchsorted(np.sort(mixed), cuts), [len(mixed)]]))
    singles = {30, 50, 200, 201, 9}
    assert all(n <= 10 or n in singles for n in sizes) and sizes.sum() == len(mixed)
