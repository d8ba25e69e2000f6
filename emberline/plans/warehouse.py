"""Star schema on Parquet: binding, insert-only merges, constraints, counts."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import lookups, schemas
from emberline.functions.scalars import literal
from emberline.operators.clean import keep_first
from emberline.schemas import KEY
from emberline.session import list_files, remove_path, write_once
from emberline.sources.stage import read_stage, write_evidence, write_stage


def _number(df: DataFrame, name: str, kind: T.DataType) -> Column:
    if name not in df.columns:
        return F.lit(None).cast(kind).alias(name)
    value = name
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        value = f"nullif({name}, double('NaN'))"
    return F.expr(f"cast({value} as {kind.simpleString()}) as {name}")


def _text(df: DataFrame, name: str, length: int, default: str | None = None) -> Column:
    fallback = "cast(null as string)" if default is None else literal(default)
    if name not in df.columns:
        return F.expr(f"{fallback} as {name}")
    return F.expr(f"substring(coalesce(nullif(cast({name} as string), ''), {fallback}), 1, {length}) as {name}")


def _day(treated: DataFrame) -> Column:
    """The date as delivered, else as parsed."""
    if "data" not in treated.columns:
        return F.col("data_foco").cast("date")
    parsed = "data_foco" if "data_foco" in treated.columns else "null"
    return F.expr(f"cast(coalesce(nullif(cast(data as string), ''), cast({parsed} as string)) as date)")


def bind_detections(treated: DataFrame) -> DataFrame:
    """Rows as stored: typed, defaults in place, text cut to column width."""
    kinds = {f.name: f.dataType for f in schemas.DETECTIONS}
    return treated.select(
        F.col(KEY).cast("string").alias(KEY),
        _number(treated, "latitude", kinds["latitude"]),
        _number(treated, "longitude", kinds["longitude"]),
        _day(treated).alias("data_foco"),
        _text(treated, "satelite", 20),
        _number(treated, "confianca", kinds["confianca"]),
        _number(treated, "brilho", kinds["brilho"]),
        _number(treated, "frp", kinds["frp"]),
        _text(treated, "estado", 2, lookups.UNKNOWN_STATE),
        _text(treated, "bioma", 20, lookups.UNKNOWN_BIOME),
    )


def bind_weather(treated: DataFrame, *extra: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in schemas.WEATHER}
    dry = (F.coalesce(F.col("estacao_seca").cast("int"), F.lit(0))
           if "estacao_seca" in treated.columns else F.lit(0))
    return treated.select(
        F.col(KEY).cast("string").alias(KEY),
        *[_number(treated, c, kinds[c]) for c in schemas.WEATHER_COLUMNS],
        dry.alias("estacao_seca"),
        *extra,
    )


def _arrival(treated: DataFrame) -> list[str]:
    """Arrival order if the rows carry one, else any fixed order."""
    return ["ordinal"] if "ordinal" in treated.columns else sorted(set(treated.columns) - {KEY})


def new_rows(batch: DataFrame, target: DataFrame | None, key: str = KEY) -> DataFrame:
    """Insert-only merge: batch rows whose key the target lacks.

    The target is first cut down to the batch's keys, so the large side is shuffled
    only if the batch is too large to broadcast.
    """
    if target is None:
        return batch
    known = target.select(key).join(batch.select(key), key, "left_semi")
    return batch.join(known, key, "left_anti")


# On disk both tables also carry the date, the form of the key and the load.
_FILED = T.StructType([T.StructField("carga", T.StringType()), T.StructField("forma", T.StringType())])
_STORED = {
    "focos_incendio": T.StructType([*schemas.DETECTIONS.fields, *_FILED.fields]),
    "clima_associado": T.StructType([*schemas.WEATHER.fields, schemas.DETECTIONS["data_foco"], *_FILED.fields]),
}


def _bind_dated_weather(treated: DataFrame) -> DataFrame:
    dated = treated.withColumn("_day", _day(treated))
    return bind_weather(dated, "_day").withColumnRenamed("_day", "data_foco")


#: Parts of a table for rows that are not filed under the date in their key.
BUCKETS = 64
_MARK = 32  # characters of a load's name: a shorter mark is not written to its end


def _bucket(key: str = KEY) -> Column:
    """The part that a key's row is in unless it is filed under the key's own date."""
    return F.concat(F.lit("outra"), F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("string"))


_BIND = {"focos_incendio": bind_detections, "clima_associado": _bind_dated_weather}


def key_day(key: str = KEY) -> Column:
    """The date inside a natural key; NULL for keys of another form."""
    return F.regexp_extract(key, r"^[^|]*\|[^|]*\|(\d{4}-\d{2}-\d{2})\|[^|]*$", 1).try_cast("date")


class ConstraintError(ValueError):
    """A batch breaks a rule of the star schema; nothing of it was loaded."""


class ConcurrentLoadError(RuntimeError):
    """Another load was committed since this one read the tables; nothing of this one is visible, load again."""


@dataclass
class LoadResult:
    rows: int
    status: str
    detail: str = ""


class Warehouse:
    """Three Parquet tables under one folder.

    A load writes both tables and then its mark; readers only see the rows of
    marked loads, so a load that stopped half-way shows nothing and is simply
    run again. A key is in a table once, whatever date it comes with.

    Marks are numbered files, each made only if there is none of its number. A load takes the number after those it
    saw when it began: where another one took it meanwhile, the later is refused, so two loads that overlap cannot
    both add a key. (The file system has to make a file only once, as HDFS and local ones do.)

    Rows whose key contains their own date are filed as ``natural`` under it,
    others in one of ``BUCKETS`` parts by their key. A key can thus only be met under the date it contains or
    in its part, and a merge reads no more than that of the target.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _read(self, path: str, schema: T.StructType, **options) -> DataFrame | None:
        try:
            return self.spark.read.options(**options).schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _last_mark(self) -> int:
        """The number of the last mark, whoever made it; 0 before the first."""
        names = [path.rsplit("/", 1)[-1] for path in list_files(self.spark, self.path("_cargas"))]
        return max((int(name) for name in names if name.isdigit()), default=0)

    def _mark(self, load: str, number: int) -> None:
        """Commit: the mark makes the load's rows visible."""
        path = f"{self.path('_cargas')}/{number:020d}"
        if not write_once(self.spark, path, load):
            raise ConcurrentLoadError(f"another load was committed as number {number}")

    def read(self, table: str) -> DataFrame | None:
        """The committed rows of a table with their filing columns."""
        rows = self._read(self.path(table), _STORED[table])
        if rows is None:
            return None
        try:
            marks = self.spark.read.text(self.path("_cargas"))
        except AnalysisException as missing:
            if missing.getCondition() == "PATH_NOT_FOUND":
                return None
            raise
        marks = marks.select(F.col("value").alias("carga")).filter(F.length("carga") == _MARK)
        return rows.join(marks, "carga", "left_semi")

    def detections(self) -> DataFrame:
        return self._or_empty(self.read("focos_incendio"), schemas.DETECTIONS)

    def weather(self) -> DataFrame:
        return self._or_empty(self.read("clima_associado"), schemas.WEATHER)

    def images(self) -> DataFrame:
        return self._or_empty(self._read(self.path("imagens_satelite_metadata"), schemas.IMAGES), schemas.IMAGES)

    def _or_empty(self, found: DataFrame | None, schema: T.StructType) -> DataFrame:
        if found is None:
            return self.spark.createDataFrame([], schema)
        return found.select(*schema.fieldNames())

    def merge_detections(self, treated: DataFrame) -> int:
        """Append unseen detections; the number of different keys in the batch."""
        return self._load(treated, ["focos_incendio"])

    def merge_weather(self, treated: DataFrame) -> int:
        """Append unseen weather rows, filed under their detection's date."""
        return self._load(treated, ["clima_associado"])

    def load(self, treated: DataFrame) -> int:
        """Both merges as one load."""
        return self._load(treated, ["focos_incendio", "clima_associado"])

    def _load(self, treated: DataFrame, tables: list[str]) -> int:
        staged, path = self._stage(treated)
        try:
            return self._commit(staged, tables)
        finally:
            remove_path(self.spark, path)

    def _stage(self, treated: DataFrame) -> tuple[DataFrame, str]:
        """The batch, one row per key, in a folder of its own, so that its making runs once."""
        path = self.path(f"_stage-{uuid.uuid4().hex}")
        return read_stage(self.spark, write_stage(keep_first(treated, KEY, _arrival(treated)), path)), path

    def _commit(self, staged: DataFrame, tables: list[str]) -> int:
        load, seen = uuid.uuid4().hex, self._last_mark()
        bound = bind_detections(staged).select(*[f.name for f in schemas.DETECTIONS if not f.nullable])
        missing = F.lit(False)
        for name in bound.columns:
            missing = missing | F.col(name).isNull()
        # days on the calendar and parts of the table, not rows
        rows, broken, days, parts = bound.agg(F.count(F.lit(1)), F.count_if(missing), F.collect_set(key_day()),
                                              F.collect_set(_bucket())).first()
        if broken:
            raise ConstraintError(f"{broken} rows lack one of {', '.join(bound.columns)}")
        for table in tables:
            batch = _BIND[table](staged)
            own = F.coalesce(key_day() == F.col("data_foco"), F.lit(False))
            filed = batch.withColumns({"carga": F.lit(load), "forma": F.when(own, "natural").otherwise(_bucket())})
            (new_rows(filed, self.reachable(table, days, parts)).hint("rebalance", "forma", "data_foco").write.mode("append")
             .partitionBy("forma", "data_foco").parquet(self.path(table)))
        self._mark(load, seen + 1)
        return rows

    def reachable(self, table: str, days: list, parts: list[str]) -> DataFrame | None:
        """The part of a table in which keys with these dates and in these parts can be."""
        target = self.read(table)
        if target is None:
            return None
        dated = (F.col("forma") == "natural") & F.col("data_foco").isin(days) if days else F.lit(False)
        return target.filter(dated | F.col("forma").isin(parts))

    def append_images(self, images: DataFrame) -> None:
        images.select(*[F.col(f.name).cast(f.dataType) for f in schemas.IMAGES]).write.mode("append").parquet(
            self.path("imagens_satelite_metadata"))

    def load_or_quarantine(self, treated: DataFrame, quarantine: str) -> LoadResult:
        """Load; on an error keep the batch as CSV evidence and report it."""
        staged = path = None
        try:
            staged, path = self._stage(treated)
            return LoadResult(self._commit(staged, ["focos_incendio", "clima_associado"]), "carregado")
        except Exception as error:  # noqa: BLE001 - any failure must leave evidence
            write_evidence(treated if staged is None else staged, quarantine)
            return LoadResult(0, "quarentena", f"{type(error).__name__}: {error}")
        finally:
            if path is not None:
                remove_path(self.spark, path)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
              for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def _duplicate_keys(df: DataFrame, table: str) -> DataFrame:
    return (df.groupBy(KEY).count().filter("count > 1").agg(F.count(F.lit(1)).alias("violacoes"))
            .select(F.lit(f"{table}: chave unica").alias("regra"), "violacoes"))


def _missing(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    empty = F.lit(False)
    for c in columns:
        empty = empty | F.col(c).isNull()
    return df.agg(F.count_if(empty).alias("violacoes")).select(
        F.lit(f"{table}: nao nulo").alias("regra"), "violacoes")


def _orphans(df: DataFrame, parent: DataFrame, table: str) -> DataFrame:
    return (df.join(parent.select(KEY), KEY, "left_anti").agg(F.count(F.lit(1)).alias("violacoes"))
            .select(F.lit(f"{table}: chave estrangeira").alias("regra"), "violacoes"))


def constraint_report(detections: DataFrame, weather: DataFrame, images: DataFrame) -> DataFrame:
    """Violations per rule of the star schema; all zero when it holds."""
    required = [f.name for f in schemas.DETECTIONS if not f.nullable]
    rules = [
        _duplicate_keys(detections, "focos_incendio"),
        _missing(detections, "focos_incendio", required),
        _duplicate_keys(weather, "clima_associado"),
        _missing(weather, "clima_associado", [KEY]),
        _orphans(weather, detections, "clima_associado"),
        _missing(images, "imagens_satelite_metadata", [KEY]),
        _orphans(images, detections, "imagens_satelite_metadata"),
    ]
    report = rules[0]
    for rule in rules[1:]:
        report = report.unionByName(rule)
    return report
