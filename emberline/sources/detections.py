"""Detection files: daily landing scan, canonical schema."""

from __future__ import annotations

import csv
from collections.abc import Callable, Sequence
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from emberline import lookups
from emberline.functions import scalars as s
from emberline.session import list_files

# Source column -> canonical column
CANONICAL_NAMES = {
    "acq_date": "data",
    "acq_time": "hora",
    "satellite": "satelite",
    "confidence": "confianca",
    "bright_ti4": "brilho",
    "brightness": "brilho",
}


_PATH_DAY = r"date=([0-9-]+)/[^/]*$"


def _place(as_of: str) -> list[Column]:
    """Day, file and block that a row was read from."""
    age = F.datediff(F.lit(as_of).cast("date"), F.regexp_extract("_metadata.file_path", _PATH_DAY, 1).cast("date"))
    return [age.alias("idade"), F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("bloco")]


def _line() -> Column:
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("linha")


def _arrival(as_of: str) -> Column:
    """Day, file and position of a row, in the order in which rows are held to have arrived."""
    return F.struct(*_place(as_of), _line())


def headers(lines: DataFrame) -> dict[tuple[str, ...], list[str]]:
    """Files by their header, from (arquivo, bloco, linha, value) lines: one job for all files; empty files have none."""
    first = lines.filter(F.col("bloco") == 0).groupBy("arquivo").agg(F.min_by("value", "linha").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("arquivo").collect():  # one row per file
        if row.header:
            found.setdefault(tuple(next(csv.reader([row.header]))), []).append(row.arquivo)
    return found


def _text_schema(header: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in header])


def scan_daily(spark: SparkSession, landing: str, sensor: str, as_of: str, days: int = 3) -> DataFrame | None:
    """Rows of the last ``days`` daily CSV folders, newest day first.

    Layout: ``landing/sensor=<sensor>/date=<yyyy-mm-dd>/*.csv`` with a header. Only the wanted
    days' folders are listed. All headers are read by one job, files are read under their own and put
    together by column name; missing or empty days add nothing, and ``None`` means that
    nothing has arrived. ``ordinal`` sorts rows as they arrived (day, file,
    position), however the files are split.
    """
    today = date.fromisoformat(as_of)
    folders = [f"{landing}/sensor={sensor}/date={today - timedelta(days=back)}" for back in range(days)]
    paths = [path for folder in folders for path in list_files(spark, folder)]
    if not paths:
        return None
    arrival = _arrival(as_of)
    by_header = headers(spark.read.text(paths).select("value", arrival.alias("at")).select("value", "at.*"))
    if not by_header:
        return None
    return concatenate([
        spark.read.schema(_text_schema(header)).option("header", True).option("mode", "PERMISSIVE")
        .csv([unquote(path) for path in files]).withColumn("ordinal", arrival)
        for header, files in by_header.items()])


def landing_stream(spark: SparkSession, landing: str, as_of: str, files: int = 100) -> DataFrame:
    """The lines of the daily CSV files of all sensors as they land, at most ``files`` files at a time.

    Same layout as ``scan_daily``; (value, idade, arquivo, bloco) rows. Each micro-batch goes through ``parse_lines``.
    """
    return (spark.readStream.option("maxFilesPerTrigger", files).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.csv").text(landing).select("value", *_place(as_of)))


def parse_lines(lines: DataFrame) -> DataFrame | None:
    """The rows of whole files from a micro-batch of their lines, each under its own file's header, put together by column name.

    Reads ``lines`` once for the headers and once per different header; None if there is no header.
    """
    flat = lines.select("value", F.struct("idade", "arquivo", "bloco", _line()).alias("ordinal")).select(
        "value", "ordinal", "ordinal.arquivo", "ordinal.bloco", "ordinal.linha")
    by_header = headers(flat)
    if not by_header:
        return None
    told = lines.sparkSession.createDataFrame(
        [(path, number) for number, files in enumerate(by_header.values()) for path in files], "arquivo string, _header int")
    heads = flat.filter("bloco = 0").groupBy("arquivo").agg(F.min("linha").alias("_first"))
    body = flat.join(told, "arquivo").join(heads, "arquivo").filter(
        ((F.col("bloco") > 0) | (F.col("linha") > F.col("_first"))) & (F.trim("value") != ""))
    return concatenate([
        body.filter(F.col("_header") == number).select(
            F.from_csv("value", ", ".join(f"`{name}` string" for name in header)).alias("row"), "ordinal").select(
                "row.*", "ordinal")
        for number, header in enumerate(by_header)])


def in_country(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    """The source's bounding box, as plain comparisons a Parquet scan can use."""
    box = lookups.COUNTRY_BOX
    return df.filter(F.col(latitude).between(box["south"], box["north"])
                     & F.col(longitude).between(box["west"], box["east"]))


def concatenate(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name; absent columns become NULL."""
    frames = list(frames)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def rename_canonical(df: DataFrame) -> DataFrame:
    """Canonical names; several sources of one name are coalesced in order."""
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(CANONICAL_NAMES.get(name, name), []).append(name)
    return df.select(*[
        (F.coalesce(*[F.col(x) for x in names]) if len(names) > 1 else F.col(names[0])).alias(target)
        for target, names in sources.items()])


def standardise(df: DataFrame, position: str = "ordinal") -> DataFrame:
    """Canonical names, numeric readings, natural key.

    Without date and time the key falls back to the row's position.
    """
    named = rename_canonical(df)
    numeric = [c for c in ("latitude", "longitude", "brilho", "frp") if c in named.columns]
    named = named.withColumns({c: s.number_in(named, c) for c in numeric})
    if {"data", "hora"} <= set(named.columns):
        key = s.natural_key("latitude", "longitude", "data", "hora")
    else:
        key = F.col(position).cast("string")
    return named.withColumn("id_externo", key)


def first_with_rows(candidates: Sequence[tuple[str, Callable[[], DataFrame | None]]],
                    label: str | None = "fonte") -> DataFrame:
    """The first candidate table with any row; the last one if all are empty.

    The choice is for the whole table, never row by row. Each thunk runs only
    when those before it came up empty.
    """
    chosen = None
    for name, make in candidates:
        table = make()
        if table is None:
            continue
        chosen = table.withColumn(label, F.lit(name)) if label else table
        if not table.isEmpty():
            return chosen
    if chosen is None:
        raise ValueError("no candidate table")
    return chosen
