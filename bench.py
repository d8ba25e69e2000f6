"""Time the headline jobs and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
data and cores. The analytical queries run on the loaded star schema, as they
do in production; each is warmed up once, then the median of three runs counts.
Models are fitted once, at full size.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from emberline import fixtures as fx  # noqa: E402
from emberline import schemas  # noqa: E402
from emberline.ml import evaluate, explain, models, prep, split  # noqa: E402
from emberline.operators import order_stats  # noqa: E402
from emberline.plans import export, marts  # noqa: E402
from emberline.plans.treatment import transform  # noqa: E402
from emberline.plans.warehouse import Warehouse  # noqa: E402
from emberline.session import build_session, scratch_path, ship_package, spread  # noqa: E402
from emberline.sources.detections import standardise  # noqa: E402
from emberline.sources.stage import read_stage, write_stage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def median(action, runs: int = 3) -> float:
    action()
    return statistics.median(timed(action) for _ in range(runs))


def main() -> None:
    spark = build_session("bench", CPUS)
    ship_package(spark)
    times: dict[str, float] = {}
    events = fx.events(spark, SF_DIR)
    landed = read_stage(spark, write_stage(fx.raw_detections(events), scratch_path(spark, "raw")))
    readings = read_stage(spark, write_stage(fx.weather(events), scratch_path(spark, "readings")))
    raw_rows = landed.count()
    times["etl"] = median(lambda: run(transform(standardise(landed), readings)))

    treated = read_stage(spark, write_stage(transform(standardise(landed), readings),
                                            scratch_path(spark, "treated")))
    Warehouse(spark, scratch_path(spark, "warm")).load(treated)
    store = Warehouse(spark, scratch_path(spark, "warehouse"))
    times["load_first"] = timed(lambda: store.load(treated))
    times["load_repeat"] = timed(lambda: store.load(treated))
    store.append_images(fx.images(events))

    facts, weather, images = store.detections(), store.weather(), store.images()
    queries = {
        "q1_state_ranking": lambda: run(marts.state_ranking(facts, fx.AS_OF)),
        "q2_daily": lambda: run(marts.daily_evolution(facts, fx.AS_OF)),
        "q3_weather_by_biome": lambda: run(marts.weather_by_biome(facts, weather)),
        "q4_top_frp": lambda: run(marts.strongest(facts)),
        "q5_satellite_stats": lambda: run(marts.satellite_statistics(facts)),
        "q6_critical_cnn": lambda: run(marts.critical_hotspots(facts, weather, images)),
        "sanity_means": lambda: run(marts.column_means(treated)),
        "quartiles": lambda: order_stats.quantiles(treated, ["frp", "brilho", *schemas.WEATHER_COLUMNS],
                                                   [0.25, 0.5, 0.75]),
        "snapshot_export": lambda: run(export.model_table(facts, weather, keep_key=True)),
    }
    for name, action in queries.items():
        times[name] = median(action)

    path = write_stage(export.model_table(facts, weather, keep_key=True), scratch_path(spark, "model"))
    table = read_stage(spark, path)
    times["stratified_split"] = median(
        lambda: run(split.stratified_split(table, schemas.LABEL, schemas.KEY)))
    times["prepare_fit"] = median(lambda: prep.RiskPrep().fit(table), runs=1)
    score = table.selectExpr("cast(umidade < 45 as int) as real", "cast(frp > 60 as int) as previsto",
                             "frp + brilho / 1000 as score")
    times["metrics_auc"] = median(lambda: run(evaluate.classification_metrics(score, "real", "previsto", "score")))

    train, test = split.train_test(table, schemas.LABEL, schemas.KEY)
    fitted = models.preparation().fit(train)
    names = models.feature_names(fitted)
    ready = spread(fitted.transform(train).select("features", schemas.LABEL)).persist()
    ready.count()
    fits: dict = {}
    for key, name in (("forest_fit_300", models.FOREST), ("boosting_fit_300", models.BOOSTING),
                      ("network_fit_400", models.NETWORK)):
        times[key] = timed(lambda: fits.update({name: models.fit_classifier(name, ready, len(names))}))
    forest = fits[models.FOREST]
    ready.unpersist()
    ready_test = fitted.transform(test)
    explained = ready_test.count()
    times["tree_shap_300"] = timed(lambda: run(explain.explain_trees(forest, ready_test, schemas.KEY, names)))

    loaded = treated.count()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": {name: round(value, 3) for name, value in times.items()},
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "rows_per_sec": {
            "etl": round(raw_rows / times["etl"]), "load_first": round(2 * loaded / times["load_first"]),
            "load_repeat": round(2 * loaded / times["load_repeat"]),
            "tree_shap_300": round(explained / times["tree_shap_300"]),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
