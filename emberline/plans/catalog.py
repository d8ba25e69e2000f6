"""Every operator as a named query over the driver tables.

Each entry takes ``(spark, sf_dir)``; results carry doubles, longs and text
only, so that another engine can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import fixtures as fx
from emberline import lookups, schemas
from emberline.functions import scalars as s
from emberline.ml import evaluate, explain, prep, split
from emberline.ml import curves, models, scoring
from emberline.operators import boxes, clean, enrich, order_stats
from emberline.plans import export, marts
from emberline.plans.treatment import transform
from emberline.plans.warehouse import (Warehouse, bind_detections, bind_weather, constraint_report, new_rows,
                                       table_counts)
from emberline.schemas import KEY, LABEL
from emberline.session import scratch_path, ship_package, spread
from emberline.sources import detections as sd
from emberline.sources import stage, synthetic
from emberline.sources import weather as sw
from emberline.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return plain(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return function


def _raw(spark, sf_dir):
    return fx.raw_detections(fx.events(spark, sf_dir))


def _weather(spark, sf_dir):
    return fx.weather(fx.events(spark, sf_dir))


def _images(spark, sf_dir):
    return fx.images(fx.events(spark, sf_dir))


def _star(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Fact and weather dimension off one stored treatment."""
    path = stage.write_stage(fx.treated(spark, sf_dir), scratch_path(spark, "treated"))
    rows = stage.read_stage(spark, path)
    return bind_detections(rows), bind_weather(rows)


def _clean(spark, sf_dir):
    return clean.clean_detections(fx.detections(spark, sf_dir))


# ---------------------------------------------------------------- sources

@query
def daily_scan(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    rows = _raw(spark, sf_dir).drop("seq", "ordinal").withColumns(
        {"sensor": F.lit("VIIRS"), "date": F.col("acq_date")})
    (rows.write.partitionBy("sensor", "date").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(landing))
    scanned = sd.scan_daily(spark, landing, "VIIRS", fx.AS_OF, days=12)
    return sd.standardise(scanned).select(
        KEY, "data", "hora", "satelite", "brilho", "frp", s.confidence_percent("confianca").alias("confianca"))


@query
def daily_scan_mixed_headers(spark, sf_dir):
    """Odd days come with another column order and another name for the brightness."""
    landing = scratch_path(spark, "landing")
    rows = _raw(spark, sf_dir).drop("seq", "ordinal").withColumns(
        {"sensor": F.lit("VIIRS"), "date": F.col("acq_date")})
    odd = F.dayofmonth(F.col("acq_date").cast("date")) % 2 == 1
    other = rows.filter(odd).withColumnRenamed("bright_ti4", "brightness")
    for part in (rows.filter(~odd), other.select(*reversed(other.columns))):
        (part.write.mode("append").partitionBy("sensor", "date").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(landing))
    scanned = sd.scan_daily(spark, landing, "VIIRS", fx.AS_OF, days=12)
    return sd.standardise(scanned).select(
        KEY, "data", "hora", "satelite", "brilho", "frp", s.confidence_percent("confianca").alias("confianca"))


@query
def daily_concat(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    first = raw.filter("acq_date < '2024-01-11'").drop("bright_ti4")
    second = raw.filter("acq_date >= '2024-01-11'")
    return sd.concatenate([first, second]).select("seq", "ordinal", "acq_date", "bright_ti4")


@query
def bbox_filter(spark, sf_dir):
    wider = _raw(spark, sf_dir).selectExpr("ordinal", "latitude * 1.25 as latitude", "longitude + 10 as longitude")
    return sd.in_country(wider).select("ordinal", F.round("latitude", 6).alias("latitude"),
                                       F.round("longitude", 6).alias("longitude"))


@query
def weather_batches(spark, sf_dir):
    batches = sw.build_batches(fx.originals(fx.events(spark, sf_dir)))
    return batches.select(
        "lote", F.size("ids").alias("n"), F.get("ids", F.lit(0)).alias("primeiro"),
        F.element_at("ids", -1).alias("ultimo"), F.size(F.split("latitudes", ",")).alias("coordenadas"))


def landed_batches(source: DataFrame) -> DataFrame:
    """Replies per batch: every third failed, single ones bare, some without reading."""
    reply = F.struct(F.when(F.col("seq") % 50 != 7, F.struct(
        F.col("temperatura").alias("temperature_2m"), F.col("umidade").alias("relative_humidity_2m"),
        F.col("vento").alias("wind_speed_10m"),
        F.when(F.col("seq") % 2 == 1, F.col("precipitacao")).alias("precipitation"))).alias("current"))
    member = F.struct("seq", "id_externo", reply.alias("reply"))
    grouped = (fx.all_weather(source).withColumn("lote", F.expr("if(seq % 1000 = 999, -seq, seq div 100)"))
               .groupBy("lote").agg(F.sort_array(F.collect_list(member)).alias("m")))
    body = (F.when((F.col("lote") >= 0) & (F.col("lote") % 3 == 0), "erro 429")
            .when(F.size("m") == 1, F.to_json(F.col("m.reply")[0]))
            .otherwise(F.to_json("m.reply")))
    return grouped.select("lote", F.col("m.id_externo").alias("ids"), body.alias("corpo"))


@query
def weather_batch_parse(spark, sf_dir):
    return sw.parse_batches(landed_batches(fx.events(spark, sf_dir))).drop("ordinal")


def landed_single(source: DataFrame) -> DataFrame:
    body = F.to_json(F.struct(
        F.struct(F.col("temperatura").alias("temp"),
                 F.when(F.col("seq") % 17 != 0, F.col("umidade")).alias("humidity")).alias("main"),
        F.when(F.col("seq") % 11 != 0, F.struct(F.col("vento").alias("speed"))).alias("wind"),
        F.when(F.col("seq") % 2 == 1, F.struct(F.col("precipitacao").alias("1h"))).alias("rain")))
    return fx.all_weather(source).select(
        KEY, F.when(F.col("seq") % 13 == 0, "{sem resposta").otherwise(body).alias("corpo"))


@query
def weather_single_parse(spark, sf_dir):
    parsed = sw.parse_single(landed_single(fx.events(spark, sf_dir)))
    return parsed.withColumn("vento", F.round("vento", 6)).drop("ordinal")


@query
def weather_fallback(spark, sf_dir):
    source = fx.events(spark, sf_dir)
    failed = landed_batches(source).withColumn("corpo", F.lit("erro 429"))
    chosen = sd.first_with_rows([
        ("lote", lambda: sw.parse_batches(failed)),
        ("foco", lambda: sw.parse_single(landed_single(source))),
        ("sintetico", lambda: synthetic.synthetic_weather(fx.originals(source))),
    ])
    return chosen.groupBy("fonte").agg(F.count(F.lit(1)).alias("linhas"),
                                       F.round(F.avg("temperatura"), 6).alias("temp_media"))


@query
def dataset_source(spark, sf_dir):
    empty = _model_table(spark, sf_dir).filter("frp < 0")
    chosen = sd.first_with_rows([
        ("instantaneo", lambda: empty),
        ("arquivo", lambda: _model_table(spark, sf_dir)),
        ("gerado", lambda: synthetic.synthetic_dataset(spark.range(10_000))),
    ])
    return chosen.groupBy("fonte").agg(F.count(F.lit(1)).alias("linhas"))


@query
def stage_roundtrip(spark, sf_dir):
    path = stage.write_stage(fx.fact(spark, sf_dir), scratch_path(spark, "stage"))
    return stage.read_stage(spark, path)


@query
def evidence_roundtrip(spark, sf_dir):
    path = stage.write_evidence(fx.fact(spark, sf_dir), scratch_path(spark, "evidence"))
    return stage.read_evidence(spark, path, schemas.DETECTIONS)


def _outside(columns):
    bad = F.lit(False)
    for name, low, high in columns:
        bad = bad | (F.col(name) < low) | (F.col(name) > high)
    return F.count_if(bad).alias("fora")


@query
def synthetic_detections(spark, sf_dir):
    rows = synthetic.synthetic_detections(fx.events(spark, sf_dir).selectExpr("event_id as id"), fx.AS_OF)
    return rows.agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct(KEY).alias("chaves"),
        F.count_distinct("data").alias("dias"), F.count_distinct("satelite").alias("satelites"),
        _outside([("latitude", -33, 5), ("longitude", -73, -34), ("confianca", 40, 100),
                  ("brilho", 300, 380), ("frp", 1, 500)]))


@query
def synthetic_weather(spark, sf_dir):
    rows = synthetic.synthetic_weather(fx.originals(fx.events(spark, sf_dir)))
    return rows.agg(F.count(F.lit(1)).alias("linhas"), F.count_distinct(KEY).alias("chaves"),
                    _outside([("temperatura", 20, 42), ("umidade", 10, 90), ("vento", 0, 45),
                              ("precipitacao", 0, 30)]))


@query
def synthetic_training(spark, sf_dir):
    """Ranges, and whether the means are where the distributions put them."""
    rows = synthetic.synthetic_training(fx.events(spark, sf_dir).selectExpr("event_id as id"))
    near = lambda name, mean, by: (F.abs(F.avg(name) - mean) < by).cast("int").alias(f"{name}_ok")
    return rows.agg(
        F.count(F.lit(1)).alias("linhas"),
        _outside([("temperatura", 15, 48), ("umidade", 8, 100), ("velocidade_vento", 0, 60),
                  ("precipitacao_mm", 0, 80), ("dias_sem_chuva", 0, 60), ("brilho", 280, 400), ("frp", 1, 600),
                  ("confianca", 40, 100), ("ndvi", 0.1, 0.9), ("declividade", 0, 60)]),
        near("temperatura", 31, 0.6), near("velocidade_vento", 12, 1), near("precipitacao_mm", 3.6, 0.4),
        near("dias_sem_chuva", 8, 0.4), near("frp", 50, 4), near("declividade", 12, 1), near("ndvi", 0.5, 0.03))


@query
def null_injection(spark, sf_dir):
    rows = fx.all_weather(fx.events(spark, sf_dir))
    blanked = synthetic.inject_nulls(rows, "seq", ["temperatura", "umidade", "vento"])
    missing = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulos") for c in ("temperatura", "umidade", "vento")]
    return blanked.agg(F.count(F.lit(1)).alias("linhas"), *missing)


# ---------------------------------------------------------------- cleaning

@query
def rename_canonical(spark, sf_dir):
    raw = _raw(spark, sf_dir).withColumns({
        "brightness": F.col("bright_ti4") + 1000, "bright_ti4": F.expr("if(seq % 3 = 0, null, bright_ti4)")})
    return sd.rename_canonical(raw).select("ordinal", "data", "hora", "satelite", "confianca", "brilho", "frp")


@query
def numeric_coercion(spark, sf_dir):
    raw = _raw(spark, sf_dir).select("ordinal", "latitude", F.expr(
        "case seq % 7 when 0 then 'abc' when 1 then 'nan' when 2 then '' when 3 then '5d' else cast(frp as string) end").alias("v"))
    return raw.select("ordinal", s.number_in(raw, "v").alias("valor"), F.round("latitude", 6).alias("latitude"))


@query
def natural_key(spark, sf_dir):
    raw = _raw(spark, sf_dir).withColumn("acq_time", F.col("acq_time").cast("int"))
    return sd.standardise(raw).select("ordinal", KEY)


def _dirty(spark, sf_dir):
    """Some coordinates and dates made unusable."""
    return sd.standardise(_raw(spark, sf_dir)).withColumns({
        "latitude": F.expr("if(seq % 19 = 0, null, latitude)"),
        "longitude": F.expr("if(seq % 23 = 0, null, longitude)"),
        "data": F.expr("case when seq % 17 = 0 then 'ruim' when seq % 31 = 0 then '' else data end")})


@query
def drop_invalid(spark, sf_dir):
    kept = clean.with_valid_day(clean.parse_day(clean.with_coordinates(_dirty(spark, sf_dir))))
    return kept.select("ordinal", KEY, "data_foco")


@query
def conf_normalise(spark, sf_dir):
    return clean.normalise_confidence(fx.detections(spark, sf_dir)).select("ordinal", "confianca")


@query
def conf_filter(spark, sf_dir):
    rows = clean.normalise_confidence(fx.detections(spark, sf_dir))
    return clean.with_confidence(rows).select("ordinal", KEY, "confianca")


@query
def dedup_first(spark, sf_dir):
    return _clean(spark, sf_dir).select(KEY, "ordinal", "brilho", "frp", "confianca")


@query
def dedup_weather(spark, sf_dir):
    rows = _weather(spark, sf_dir)
    again = rows.filter("seq % 10 = 1").withColumns({
        "temperatura": F.lit(0.0), "ordinal": F.col("ordinal") + 10 ** 9})
    return clean.keep_first(rows.unionByName(again)).select(KEY, "temperatura", "ordinal")


@query
def dedup_full_rows(spark, sf_dir):
    rows = _weather(spark, sf_dir).select(KEY, *schemas.WEATHER_COLUMNS)
    return clean.split_stage(rows.unionByName(rows.filter("temperatura > 30")), schemas.WEATHER_COLUMNS)[1]


@query
def column_split(spark, sf_dir):
    staged = enrich.stage_join(_clean(spark, sf_dir).select(KEY, "frp"),
                               _weather(spark, sf_dir))
    detections, weather = clean.split_stage(staged, schemas.WEATHER_COLUMNS)
    return (detections.agg(F.count(F.lit(1)).alias("linhas"), F.lit(len(detections.columns)).alias("colunas"))
            .select(F.lit("focos").alias("parte"), "linhas", "colunas")
            .unionByName(weather.agg(F.count(F.lit(1)).alias("linhas"),
                                     F.lit(len(weather.columns)).alias("colunas"))
                         .select(F.lit("clima").alias("parte"), "linhas", "colunas")))


@query
def transform_funnel(spark, sf_dir):
    return clean.funnel(_dirty(spark, sf_dir))


# ---------------------------------------------------------------- places and weather

@query
def geo_state(spark, sf_dir):
    return fx.detections(spark, sf_dir).select("ordinal", boxes.state_label().alias("estado"))


@query
def geo_biome(spark, sf_dir):
    return fx.detections(spark, sf_dir).select("ordinal", boxes.biome_label().alias("bioma"))


@query
def geo_box_table(spark, sf_dir):
    """First match in a box table made of the customers."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    table = customers.selectExpr(
        "c_name as nome", "cast(-34 + (c_custkey * 37 % 400) / 10.0 as double) as lat_min",
        "cast(-34 + (c_custkey * 37 % 400) / 10.0 + (c_custkey % 7 + 1) * 0.3 as double) as lat_max",
        "cast(-74 + (c_custkey * 53 % 400) / 10.0 as double) as lon_min",
        "cast(-74 + (c_custkey * 53 % 400) / 10.0 + (c_custkey % 5 + 1) * 0.4 as double) as lon_max",
        "c_custkey as prioridade")
    points = fx.detections(spark, sf_dir).select("ordinal", "latitude", "longitude")
    return boxes.locate(points, table, "ordinal", "lugar", "nenhum").select("ordinal", "lugar")


@query
def dictionary_lookup(spark, sf_dir):
    rows = fx.fact(spark, sf_dir).withColumn("bioma", F.expr("if(frp > 100, 'Outro', bioma)"))
    return rows.select(KEY, s.ndvi_of("bioma").alias("ndvi"), s.dryness_of("bioma").alias("fator"))


@query
def stage_fan_out(spark, sf_dir):
    weather = _weather(spark, sf_dir).select(KEY, "temperatura")
    doubled = weather.unionByName(weather.filter("temperatura < 25"))
    return enrich.fan_out(fx.detections(spark, sf_dir), doubled)


@query
def weather_join(spark, sf_dir):
    return enrich.join_weather(_clean(spark, sf_dir).select(KEY, "frp"), _weather(spark, sf_dir))


@query
def climate_coercion(spark, sf_dir):
    text = _weather(spark, sf_dir).withColumns({
        c: F.expr(f"case seq % 9 when 0 then 'x' when 1 then 'nan' when 2 then '7f' else cast({c} as string) end")
        for c in schemas.WEATHER_COLUMNS})
    return enrich.coerce_weather(text).select(KEY, *schemas.WEATHER_COLUMNS)


@query
def weather_medians(spark, sf_dir):
    found = enrich.weather_medians(_clean(spark, sf_dir), _weather(spark, sf_dir))
    return spark.range(1).select(*[F.round(F.lit(v), 6).alias(c) for c, v in found.items()])


@query
def median_impute(spark, sf_dir):
    rows = fx.treated(spark, sf_dir)
    return rows.select(KEY, *[F.round(c, 6).alias(c) for c in schemas.WEATHER_COLUMNS])


@query
def dry_flag(spark, sf_dir):
    rows = enrich.join_weather(_clean(spark, sf_dir), _weather(spark, sf_dir))
    return rows.select(KEY, s.dry_flag().alias("estacao_seca"))


@query
def treated_rows(spark, sf_dir):
    return fx.treated(spark, sf_dir).select(
        KEY, "data_foco", "satelite", "confianca", "brilho", "frp", "estado", "bioma",
        *[F.round(c, 6).alias(c) for c in schemas.WEATHER_COLUMNS], "estacao_seca")


# ---------------------------------------------------------------- load

@query
def bind_rows(spark, sf_dir):
    rows = fx.treated(spark, sf_dir).withColumns({
        "satelite": F.expr("if(seq % 7 = 0, '', concat(satelite, '-abcdefghijklmnopqrstuvwxyz'))"),
        "estado": F.expr("if(seq % 11 = 0, null, estado)"),
        "bioma": F.expr("if(seq % 13 = 0, '', bioma)"),
        "brilho": F.expr("if(seq % 17 = 0, double('nan'), brilho)"),
        "estacao_seca": F.expr("if(seq % 5 = 0, null, estacao_seca)")})
    return bind_detections(rows).join(bind_weather(rows), KEY)


def _loaded(spark, sf_dir) -> Warehouse:
    """Part of the batch, then all of it twice."""
    store = Warehouse(spark, scratch_path(spark, "warehouse"))
    staged = stage.read_stage(spark, stage.write_stage(fx.treated(spark, sf_dir), scratch_path(spark, "treated")))
    store.load(staged.filter("seq % 3 = 0"))
    store.load(staged)
    store.load(staged)
    return store


@query
def merge_insert_only(spark, sf_dir):
    return _loaded(spark, sf_dir).detections()


@query
def merge_weather(spark, sf_dir):
    return _loaded(spark, sf_dir).weather()


@query
def merge_moved_dates(spark, sf_dir):
    """The same keys come again under other dates: natural ones, and ones without a date in them."""
    store = Warehouse(spark, scratch_path(spark, "warehouse"))
    rows = fx.treated(spark, sf_dir)
    both = rows.unionByName(rows.filter("seq % 5 = 0").withColumn(KEY, F.format_string("SYN%06d", "seq")))
    staged = stage.read_stage(spark, stage.write_stage(both.drop("data"), scratch_path(spark, "treated")))
    for days in (0, 4, -3):
        store.load(staged.withColumn("data_foco", F.date_add("data_foco", days)))
    return store.detections().select(KEY, "data_foco", "frp")


@query
def pipeline_end_to_end(spark, sf_dir):
    """Landed files and replies, treated, loaded twice and joined."""
    landing = scratch_path(spark, "landing")
    rows = _raw(spark, sf_dir).drop("seq").withColumns({"sensor": F.lit("VIIRS"), "date": F.col("acq_date")})
    (rows.repartition("date").sortWithinPartitions("sensor", "date", "ordinal").drop("ordinal")
     .write.partitionBy("sensor", "date").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(landing))
    raw = sd.standardise(sd.scan_daily(spark, landing, "VIIRS", fx.AS_OF, days=40))
    readings = sw.parse_batches(landed_batches(fx.events(spark, sf_dir)))
    treated = transform(raw, readings)
    store = Warehouse(spark, scratch_path(spark, "warehouse"))
    for _ in range(2):
        store.load(treated)
    joined = store.detections().join(store.weather(), KEY)
    return joined.groupBy("bioma").agg(
        F.count(F.lit(1)).alias("focos"), F.sum("frp").alias("frp_total"), F.sum("temperatura").alias("temperatura_total"),
        F.sum("umidade").alias("umidade_total"), F.sum("estacao_seca").alias("em_seca"))


@query
def merge_new_rows(spark, sf_dir):
    rows = fx.fact(spark, sf_dir)
    return new_rows(rows, rows.filter("frp > 40")).select(KEY, "frp")


@query
def table_counts_loaded(spark, sf_dir):
    store = _loaded(spark, sf_dir)
    store.append_images(_images(spark, sf_dir))
    return table_counts({"focos_incendio": store.detections(), "clima_associado": store.weather(),
                         "imagens_satelite_metadata": store.images()})


@query
def constraint_check(spark, sf_dir):
    facts = fx.fact(spark, sf_dir)
    broken = facts.unionByName(facts.filter("frp > 200")).withColumn(
        "data_foco", F.expr("if(frp > 300, null, data_foco)"))
    weather = bind_weather(_weather(spark, sf_dir))
    return constraint_report(broken, weather, _images(spark, sf_dir))


@query
def load_quarantine(spark, sf_dir):
    """A target that cannot be written: evidence is kept and the failure told."""
    evidence, landing = scratch_path(spark, "quarantine"), scratch_path(spark, "landing")
    raw = _raw(spark, sf_dir).drop("seq", "ordinal").withColumns({"sensor": F.lit("V"), "date": F.col("acq_date")})
    raw.write.partitionBy("sensor", "date").option("header", True).csv(landing)
    rows = clean.clean_detections(sd.standardise(sd.scan_daily(spark, landing, "V", fx.AS_OF, days=40)))
    outcome = Warehouse(spark, "nowhere://unreachable").load_or_quarantine(rows, evidence)
    kept = spark.read.option("header", True).csv(evidence)
    return kept.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(outcome.status).alias("estado"), "linhas")


# ---------------------------------------------------------------- analytics

@query
def q1_state_ranking(spark, sf_dir):
    return marts.state_ranking(fx.fact(spark, sf_dir), fx.AS_OF)


@query
def q2_daily(spark, sf_dir):
    return marts.daily_evolution(fx.fact(spark, sf_dir), fx.AS_OF)


@query
def q2_daily_filled(spark, sf_dir):
    return marts.daily_evolution_filled(fx.fact(spark, sf_dir), fx.AS_OF)


@query
def q3_weather_by_biome(spark, sf_dir):
    return marts.weather_by_biome(*_star(spark, sf_dir))


@query
def q4_top_frp(spark, sf_dir):
    return marts.strongest(fx.fact(spark, sf_dir))


@query
def q5_satellite_stats(spark, sf_dir):
    return marts.satellite_statistics(fx.fact(spark, sf_dir))


@query
def q6_critical_cnn(spark, sf_dir):
    return marts.critical_hotspots(*_star(spark, sf_dir), _images(spark, sf_dir))


@query
def q6_critical_distinct(spark, sf_dir):
    return marts.critical_hotspots_distinct(*_star(spark, sf_dir), _images(spark, sf_dir))


@query
def critical_predicate(spark, sf_dir):
    return marts.critical_rows(fx.fact(spark, sf_dir), bind_weather(_weather(spark, sf_dir)),
                               _images(spark, sf_dir))


@query
def recency(spark, sf_dir):
    rows = fx.fact(spark, sf_dir)
    return rows.groupBy("data_foco").agg(
        F.count_if(s.month_recency("data_foco", "2024-02-29")).alias("ultimo_mes"),
        F.count_if(s.day_recency("data_foco", fx.AS_OF, 20)).alias("ultimos_20"))


@query
def preview_first(spark, sf_dir):
    return marts.preview(marts.state_ranking(fx.fact(spark, sf_dir), fx.AS_OF), 10)


@query
def sanity_top5(spark, sf_dir):
    return marts.group_counts(fx.fact(spark, sf_dir), "estado", 5)


@query
def sanity_by_biome(spark, sf_dir):
    return marts.group_counts(fx.fact(spark, sf_dir), "bioma")


@query
def sanity_means(spark, sf_dir):
    return marts.column_means(fx.treated(spark, sf_dir))


@query
def global_quartiles(spark, sf_dir):
    columns = ["brilho", "frp", "confianca", *schemas.WEATHER_COLUMNS]
    found = order_stats.quantiles(fx.treated(spark, sf_dir), columns, [0.25, 0.5, 0.75])
    rows = [(name, *map(float, values)) for name, values in found.items()]
    return spark.createDataFrame(rows, "coluna string, q1 double, mediana double, q3 double").select(
        "coluna", *[F.round(c, 6).alias(c) for c in ("q1", "mediana", "q3")])


@query
def column_modes(spark, sf_dir):
    rows = fx.fact(spark, sf_dir)
    modes = [(c, order_stats.most_frequent(rows, c)) for c in ("estado", "bioma", "satelite")]
    return spark.createDataFrame(modes, "coluna string, moda string")


# ---------------------------------------------------------------- features

def _model_table(spark, sf_dir, noise: float = 0.0):
    return export.model_table(*_star(spark, sf_dir), noise=noise, keep_key=True)


@query
def snapshot_export(spark, sf_dir):
    """Inner join, renames, proxies, flags and label; the random slope left out."""
    return _model_table(spark, sf_dir).drop("declividade")


@query
def rain_proxy(spark, sf_dir):
    rows = _weather(spark, sf_dir).select(KEY, (F.col("precipitacao") * 5 - 20).alias("precipitacao_mm"))
    return rows.select(KEY, s.days_without_rain().alias("dias_sem_chuva"))


@query
def slope_proxy(spark, sf_dir):
    """Range, mean and spread of the random slope."""
    rows = fx.originals(fx.events(spark, sf_dir)).select(export.slope_proxy().alias("v"))
    return rows.agg(F.count(F.lit(1)).alias("linhas"), _outside([("v", 0, 60)]),
                    (F.abs(F.avg("v") - 10) < 0.7).cast("int").alias("media_ok"),
                    (F.abs(F.stddev("v") - 5) < 0.5).cast("int").alias("desvio_ok"))


@query
def scalar_functions(spark, sf_dir):
    rows = fx.all_weather(fx.events(spark, sf_dir)).withColumn("valor", F.col("temperatura") * 1.37 - 35)
    return rows.select(
        "seq", F.round(s.clip("round(valor, 1)", -5.0, 12.0), 6).alias("limitado"),
        F.round(s.ms_to_kmh("vento"), 6).alias("kmh"), s.zero_fill("(seq % 1000000)").alias("preenchido"),
        F.trim(F.lower(F.concat(F.lit(" X"), F.col("seq").cast("string"), F.lit(" ")))).alias("texto"),
        F.date_sub(F.lit(fx.AS_OF).cast("date"), (F.col("seq") % 400).cast("int")).alias("dia"))


def _stored_model_table(spark, sf_dir, noise: float = 0.0):
    """The model table on disk: fitting reads it several times."""
    path = scratch_path(spark, "model-table")
    return stage.read_stage(spark, stage.write_stage(_model_table(spark, sf_dir, noise), path))


def _engineered(spark, sf_dir):
    rows = _stored_model_table(spark, sf_dir).join(
        _weather(spark, sf_dir).select(KEY, F.col("umidade").alias("medida")), KEY, "left")
    rows = rows.withColumn("umidade", F.col("medida").cast("double")).drop("medida")
    median = order_stats.medians(rows, ["umidade"])["umidade"]
    return prep.engineer(rows, median)


@query
def engineered_features(spark, sf_dir):
    return _engineered(spark, sf_dir).select(
        KEY, F.round("indice_secura", 6).alias("indice_secura"), "estacao_seca", "vento_forte")


@query
def iqr_clip(spark, sf_dir):
    rows = _engineered(spark, sf_dir)
    columns = [c for c in schemas.CONTINUOUS if c != "declividade"]
    clipped = prep.iqr_clip(rows, prep.iqr_bounds(rows, columns))
    return clipped.select(KEY, *[F.round(c, 6).alias(c) for c in columns])


@query
def standardise(spark, sf_dir):
    rows = _engineered(spark, sf_dir)
    columns = [c for c in schemas.CONTINUOUS if c != "declividade"]
    filled = enrich.fill_missing(rows, order_stats.medians(
        rows, {c: F.col(c).cast("double") for c in columns}))
    scaled = prep.scale(filled, prep.scale_statistics(filled, columns))
    return scaled.select(KEY, *[F.round(c, 5).alias(c) for c in columns])


@query
def label_rule_a(spark, sf_dir):
    return fx.fact(spark, sf_dir).select(KEY, s.observed_risk().alias("alto_risco"))


@query
def label_rule_b(spark, sf_dir):
    return _model_table(spark, sf_dir).select(KEY, s.simulated_risk().alias("alto_risco"))


@query
def target_share(spark, sf_dir):
    return marts.value_shares(_model_table(spark, sf_dir), LABEL)


@query
def biome_share(spark, sf_dir):
    return marts.value_shares(fx.fact(spark, sf_dir), "bioma")


@query
def profile(spark, sf_dir):
    return marts.dataset_profile(_model_table(spark, sf_dir).drop(KEY))


@query
def stratified_split(spark, sf_dir):
    rows = split.stratified_split(_stored_model_table(spark, sf_dir).select(KEY, LABEL), LABEL, KEY)
    return rows.groupBy(LABEL).agg(F.count(F.lit(1)).alias("linhas"),
                                   F.sum(F.col("teste").cast("int")).alias("teste"))


@query
def mode_impute(spark, sf_dir):
    rows = fx.fact(spark, sf_dir).withColumn("estado", F.expr("if(estado = '??', null, estado)"))
    mode = order_stats.most_frequent(rows, "estado")
    return rows.groupBy(F.coalesce("estado", F.lit(mode)).alias("estado")).agg(F.count(F.lit(1)).alias("linhas"))


@query
def onehot_counts(spark, sf_dir):
    """Column sums of the one-hot block; rows of a category unseen in fitting are zero."""
    rows = _stored_model_table(spark, sf_dir)
    fitted = models.preparation().fit(rows.filter("bioma <> 'Pampa'"))
    names = models.feature_names(fitted)
    from pyspark.ml.functions import vector_to_array
    wide = fitted.transform(rows).select(vector_to_array("features").alias("x"))
    hot = [(i, name) for i, name in enumerate(names) if "=" in name]
    sums = wide.agg(*[F.sum(F.get("x", F.lit(i))).alias(f"c{i}") for i, _ in hot])
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("atributo"), F.col(f"c{i}").alias("total"))
                                for i, name in hot])).alias("p")
    return sums.select(pairs).select("p.atributo", "p.total")


# ---------------------------------------------------------------- evaluation

_SCORES = (("temperatura", 42.0), ("vento", 45.0), ("precipitacao", 30.0))


def _scored(spark, sf_dir, *names):
    """Deterministic scores against one label, as models; the named ones, or all three."""
    rows = _weather(spark, sf_dir).select(
        KEY, (F.col("umidade") < 40).cast("int").alias("real"), "temperatura", "vento", "precipitacao")
    return rows.select(KEY, "real", F.explode(F.array(*[
        F.struct(F.lit(i).alias("ordem"), F.lit(name).alias("modelo"), (F.col(name) / top).alias("score"))
        for i, (name, top) in enumerate(_SCORES) if name in (names or dict(_SCORES))])).alias("m")
    ).select(KEY, "real", "m.*").withColumn("previsto", (F.col("score") > 0.6).cast("int"))


@query
def metrics(spark, sf_dir):
    return evaluate.classification_metrics(_scored(spark, sf_dir, "temperatura"),
                                           "real", "previsto", "score")


@query
def leaderboard(spark, sf_dir):
    measured = evaluate.classification_metrics(_scored(spark, sf_dir), "real", "previsto", "score",
                                               by=["modelo", "ordem"])
    return evaluate.leaderboard(measured)


@query
def confusion(spark, sf_dir):
    return evaluate.confusion_matrix(_scored(spark, sf_dir, "vento"), "real", "previsto")


@query
def auc_exact(spark, sf_dir):
    rows = fx.treated(spark, sf_dir).select(
        (F.col("umidade") < 45).cast("int").alias("real"), (F.col("frp") + F.col("brilho") / 1000).alias("score"))
    return evaluate.auc(rows, "real", "score").withColumn("auc", F.round("auc", 8))


@query
def alert_tiers(spark, sf_dir):
    rows = _scored(spark, sf_dir, "vento").select(KEY, F.round("score", 6).alias("probabilidade"))
    return rows.withColumn("nivel", s.alert_tier())


@query
def alert_table(spark, sf_dir):
    rows = _scored(spark, sf_dir, "vento").select(KEY, F.round("score", 6).alias("probabilidade"))
    return scoring.alerts(rows.withColumn("nivel", s.alert_tier()))


# ---------------------------------------------------------------- models

# Prepared rows and fitted models of this application, by data folder: each is made once, at full size.
_prepared_rows: dict[tuple, tuple] = {}
_models: dict[tuple, object] = {}
FULL = models.Settings()


def _prepared(spark, sf_dir):
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _prepared_rows:
        train, test = split.train_test(_stored_model_table(spark, sf_dir), LABEL, KEY)
        fitted = models.preparation().fit(train)
        stored = [stage.read_stage(spark, stage.write_stage(fitted.transform(rows), scratch_path(spark, "prepared")))
                  for rows in (train, test)]
        _prepared_rows[key] = (fitted, *stored)
    return _prepared_rows[key]


def _fitted(spark, sf_dir, name):
    fitted, train, test = _prepared(spark, sf_dir)
    names = models.feature_names(fitted)
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _models:
        ready = spread(train.select("features", LABEL)).persist()
        try:
            _models[key] = models.fit_classifier(name, ready, len(names), FULL)
        finally:
            ready.unpersist()
    return fitted, _models[key], names, train, test


def _measured(spark, sf_dir, name) -> DataFrame:
    _, model, _, _, test = _fitted(spark, sf_dir, name)
    scored = models.positive_probability(model.transform(test)).select(LABEL, "prediction", "probabilidade")
    scored = stage.read_stage(spark, stage.write_stage(scored, scratch_path(spark, "scored")))
    return evaluate.classification_metrics(scored, LABEL, "prediction", "probabilidade")


def _model_metrics(spark, sf_dir, name):
    """Test rows and positives in the four cells, and whether the model beats the larger label."""
    rows, positives = F.expr("vn + fp + fn + vp"), F.expr("fn + vp")
    better = F.col("acuracia") > F.greatest(positives, rows - positives) / rows
    return _measured(spark, sf_dir, name).select(
        F.lit(name).alias("modelo"), rows.alias("linhas"), positives.alias("positivos"),
        (better & (F.col("auc") > 0.9)).cast("int").alias("melhor_que_maioria"))


@query
def rf_metrics(spark, sf_dir):
    return _model_metrics(spark, sf_dir, models.FOREST)


@query
def gbt_metrics(spark, sf_dir):
    return _model_metrics(spark, sf_dir, models.BOOSTING)


@query
def mlp_metrics(spark, sf_dir):
    return _model_metrics(spark, sf_dir, models.NETWORK)


@query
def model_comparison(spark, sf_dir):
    """All three, winner marked, through the metrics sink."""
    fitted, _, test = _prepared(spark, sf_dir)
    result = models.rank(fitted, {name: _fitted(spark, sf_dir, name)[1] for name in models.FOLDERS}, test)
    written = spark.read.json(models.write_metrics(result.metrics, result.best, scratch_path(spark, "metrics")))
    cells = F.expr("vn + fp + fn + vp")
    return written.agg(
        F.countDistinct("modelo").alias("modelos"), F.min(cells).alias("linhas_min"), F.max(cells).alias("linhas_max"),
        F.count_if("melhor").alias("melhores"),
        (F.max(F.when(F.col("melhor"), F.col("f1"))) == F.max("f1")).cast("int").alias("melhor_tem_maior_f1"))


@query
def model_roundtrip(spark, sf_dir):
    """Rows scored by a saved and reloaded pipeline, and how many differ from the fitted one."""
    from pyspark.ml import PipelineModel
    fitted, model, _, _, _ = _fitted(spark, sf_dir, models.FOREST)
    path = scratch_path(spark, "model")
    pipeline = PipelineModel(stages=[*fitted.stages, model])
    pipeline.write().save(path)
    rows = _stored_model_table(spark, sf_dir)
    one, other = (scoring.score(p, rows).select(KEY, F.struct("probabilidade", "nivel").alias(c))
                  for p, c in ((pipeline, "a"), (PipelineModel.load(path), "b")))
    return one.join(other, KEY).agg(F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("a") != F.col("b")).alias("desvios"))


def _tree_curve_check(spark, sf_dir, name, steps):
    """Number of steps, the last one, and whether that one is as good as the whole model."""
    _, model, _, _, test = _fitted(spark, sf_dir, name)
    curve = curves.tree_curve(model, test, steps)
    last = curve.agg(F.count(F.lit(1)).alias("passos"), F.max("passo").alias("ultimo"),
                     F.max_by(F.struct("acuracia", "f1", "auc"), "passo").alias("fim"))
    whole = _measured(spark, sf_dir, name).select(F.struct("acuracia", "f1", "auc").alias("modelo"))
    same = " and ".join(f"abs(fim.{c} - modelo.{c}) < 1e-9" for c in ("acuracia", "f1", "auc"))
    return last.join(whole, F.lit(True)).select("passos", "ultimo", F.expr(f"cast({same} as int)").alias("fim_igual"))


@query
def learning_curve_rf(spark, sf_dir):
    return _tree_curve_check(spark, sf_dir, models.FOREST, curves.forest_steps(FULL.trees))


@query
def learning_curve_gbt(spark, sf_dir):
    return _tree_curve_check(spark, sf_dir, models.BOOSTING, curves.boosting_steps(FULL.rounds))


@query
def learning_curve_mlp(spark, sf_dir):
    """Number of epochs, the last one, and whether loss fell and validation rose above chance."""
    fitted, train, test = _prepared(spark, sf_dir)
    inputs = len(models.feature_names(fitted))
    ready = spread(train.select("features", LABEL)).persist()
    try:
        curve = curves.network_curve(ready, test, inputs, epochs=80)
    finally:
        ready.unpersist()
    learnt = (F.max_by("perda", "epoca") < F.min_by("perda", "epoca")) & (F.max_by("acc_val", "epoca") > 0.5)
    return curve.agg(F.count(F.lit(1)).alias("epocas"), F.max("epoca").alias("ultima"), learnt.cast("int").alias("aprendeu"))


# ---------------------------------------------------------------- explanations

def _deviations(impacts: DataFrame, outputs: DataFrame, names, tolerance: float) -> DataFrame:
    """Rows explained, and how many whose impacts miss the model's output or a feature."""
    sums = impacts.groupBy(KEY, "base").agg(F.sum("impacto").alias("soma"), F.count(F.lit(1)).alias("n"))
    gap = F.abs(F.col("base") + F.col("soma") - F.col("saida"))
    return sums.join(outputs, KEY).agg(F.count(F.lit(1)).alias("linhas"),
                                       F.count_if((gap > tolerance) | (F.col("n") != len(names))).alias("desvios"))


@query
def shap_long(spark, sf_dir):
    """Test rows explained, one line per feature, and how many lack one."""
    _, model, names, _, test = _fitted(spark, sf_dir, models.FOREST)
    lines = explain.explain_trees(model, test, KEY, names).groupBy(KEY).agg(F.countDistinct("atributo").alias("n"))
    return lines.agg(F.count(F.lit(1)).alias("focos"), F.count_if(F.col("n") != len(names)).alias("incompletos"))


@query
def shap_additivity(spark, sf_dir):
    _, model, names, train, test = _fitted(spark, sf_dir, models.FOREST)
    rows = train.unionByName(test)
    scored = models.positive_probability(model.transform(rows)).select(KEY, F.col("probabilidade").alias("saida"))
    return _deviations(explain.explain_trees(model, rows, KEY, names), scored, names, 1e-9)


@query
def shap_boosting(spark, sf_dir):
    """In margin: half the log odds."""
    _, model, names, _, test = _fitted(spark, sf_dir, models.BOOSTING)
    margin = F.element_at(vector_to_array("rawPrediction"), 2).alias("saida")
    return _deviations(explain.explain_trees(model, test, KEY, names), model.transform(test).select(KEY, margin), names, 1e-6)


@query
def shap_network(spark, sf_dir):
    _, model, names, train, test = _fitted(spark, sf_dir, models.NETWORK)
    background = explain.background_rows(train, KEY, 50)
    scored = models.positive_probability(model.transform(test)).select(KEY, F.col("probabilidade").alias("saida"))
    return _deviations(explain.explain_network(model, test, background, KEY, names), scored, names, 1e-6)


def given_impacts(spark, sf_dir):
    """Impacts by arithmetic, sixteen features per detection."""
    rows = fx.originals(fx.events(spark, sf_dir))
    return rows.select(KEY, "seq", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("posicao")).selectExpr(
        KEY, "seq", "posicao", "concat('f', posicao) as atributo",
        "cast((seq * 31 + posicao * 17) % 101 - 50 as double) / 64 as impacto", "0.25D as base")


@query
def shap_global(spark, sf_dir):
    ranked = explain.global_importance(given_impacts(spark, sf_dir), top=20)
    return ranked.select("atributo", *[F.round(c, 8).alias(c) for c in ("impacto_medio_abs", "impacto_medio")])


@query
def shap_topk(spark, sf_dir):
    return explain.top_features(given_impacts(spark, sf_dir), KEY, 12).select(KEY, "ordem", "atributo", "impacto")


@query
def shap_waterfall(spark, sf_dir):
    return explain.waterfall(given_impacts(spark, sf_dir), KEY, 14)


# ---------------------------------------------------------------- streams

def event_stream(spark, sf_dir):
    """The events file as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir))


@query
def stream_ingest(spark, sf_dir):
    """Ingest twice, the second time with a new checkpoint."""
    store = Warehouse(spark, scratch_path(spark, "stream-warehouse"))

    def load(batch: DataFrame) -> None:
        rows = sd.standardise(fx.raw_detections(batch))
        store.merge_detections(boxes.tag_places(clean.clean_detections(rows)))

    for _ in range(2):
        jobs.ingest(event_stream(spark, sf_dir), load, scratch_path(spark, "checkpoint"))
    return store.detections()


@query
def stream_daily_counts(spark, sf_dir):
    stream = sd.standardise(fx.raw_detections(event_stream(spark, sf_dir)))
    timed = stream.select(KEY, F.to_timestamp(F.concat_ws(" ", "data", "hora"), "yyyy-MM-dd HHmm").alias("momento"))
    path = scratch_path(spark, "daily")
    jobs.run_to_parquet(jobs.daily_counts(timed, "momento"), path, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(path)


@query
def stream_daily_totals(spark, sf_dir):
    """Every day, the newest too, in several micro-batches that each hold rows of all days."""
    folder = scratch_path(spark, "events-in-parts")
    fx.events(spark, sf_dir).repartition(4, "event_id").write.parquet(folder)
    events = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stream = sd.standardise(fx.raw_detections(events))
    store = scratch_path(spark, "daily-totals")
    jobs.upsert_daily(stream, F.to_date("data"), store, scratch_path(spark, "checkpoint"))
    return jobs.daily_totals(spark, store).withColumn("dia", F.col("dia").cast("string"))


@query
def stream_landing(spark, sf_dir):
    """Daily files with two kinds of header, as they land, several at a time: parsed, treated and merged."""
    landing = scratch_path(spark, "landing")
    rows = _raw(spark, sf_dir).drop("seq", "ordinal").withColumns(
        {"sensor": F.lit("VIIRS"), "date": F.col("acq_date")})
    odd = F.dayofmonth(F.col("acq_date").cast("date")) % 2 == 1
    other = rows.filter(odd).withColumnRenamed("bright_ti4", "brightness")
    for part in (rows.filter(~odd), other.select(*reversed(other.columns))):
        (part.repartition("date").write.mode("append").partitionBy("sensor", "date").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(landing))
    store = Warehouse(spark, scratch_path(spark, "landing-warehouse"))

    def load(lines: DataFrame) -> None:
        parsed = sd.parse_lines(lines)
        if parsed is not None:
            store.merge_detections(boxes.tag_places(clean.clean_detections(sd.standardise(parsed))))

    jobs.ingest(sd.landing_stream(spark, landing, fx.AS_OF, files=9), load, scratch_path(spark, "checkpoint"))
    return store.detections()


@query
def stream_scoring(spark, sf_dir):
    """The stream of model rows scored as it arrives equals the batch."""
    from pyspark.ml import PipelineModel
    fitted, model, _, _, _ = _fitted(spark, sf_dir, models.FOREST)
    pipeline = PipelineModel(stages=[*fitted.stages, model])
    source = scratch_path(spark, "model-stream")
    stage.write_stage(_model_table(spark, sf_dir), source)
    rows = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    path = scratch_path(spark, "scored")
    jobs.run_to_parquet(jobs.scored_stream(pipeline, rows), path, scratch_path(spark, "checkpoint"))
    batch = scoring.score(pipeline, spark.read.parquet(source)).select(
        KEY, F.col("probabilidade").alias("p"), F.col("nivel").alias("t"))
    same = (F.abs(F.col("p") - F.col("probabilidade")) < 1e-12) & (F.col("t") == F.col("nivel"))
    return batch.join(spark.read.parquet(path), KEY, "left").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_if(same).alias("iguais"))
