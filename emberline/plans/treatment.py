"""The batch transform: raw detections and weather to treated detections."""

from __future__ import annotations

from pyspark.sql import DataFrame

from emberline.operators.boxes import tag_places
from emberline.operators.clean import clean_detections
from emberline.operators.enrich import enrich


def detections_table(raw: DataFrame) -> DataFrame:
    """Clean, deduplicated, geo-tagged detections; no weather involved."""
    return tag_places(clean_detections(raw))


def transform(raw: DataFrame, weather: DataFrame | None) -> DataFrame:
    """The whole treatment. The weather medians run as small jobs first."""
    return enrich(detections_table(raw), weather)
