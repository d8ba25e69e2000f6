"""Table schemas and column groups."""

from __future__ import annotations

from pyspark.sql import types as T

DETECTIONS = T.StructType([
    T.StructField("id_externo", T.StringType(), False),
    T.StructField("latitude", T.DecimalType(9, 4), False),
    T.StructField("longitude", T.DecimalType(9, 4), False),
    T.StructField("data_foco", T.DateType(), False),
    T.StructField("satelite", T.StringType()),
    T.StructField("confianca", T.DecimalType(5, 1)),
    T.StructField("brilho", T.DecimalType(7, 1)),
    T.StructField("frp", T.DecimalType(8, 1)),
    T.StructField("estado", T.StringType()),
    T.StructField("bioma", T.StringType()),
])

WEATHER = T.StructType([
    T.StructField("id_externo", T.StringType(), False),
    T.StructField("temperatura", T.DecimalType(5, 1)),
    T.StructField("umidade", T.DecimalType(5, 1)),
    T.StructField("vento", T.DecimalType(5, 1)),
    T.StructField("precipitacao", T.DecimalType(6, 1)),
    T.StructField("estacao_seca", T.IntegerType()),
])

IMAGES = T.StructType([
    T.StructField("id_externo", T.StringType(), False),
    T.StructField("url_tile", T.StringType()),
    T.StructField("resolucao", T.StringType()),
    T.StructField("classificacao", T.StringType()),
    T.StructField("confianca_cnn", T.DecimalType(5, 1)),
])

KEY = "id_externo"
WEATHER_COLUMNS = ["temperatura", "umidade", "vento", "precipitacao"]

# Columns of the flat table the risk model is trained on, in order.
MODEL_COLUMNS = [
    "temperatura", "umidade", "velocidade_vento", "precipitacao_mm", "dias_sem_chuva",
    "brilho", "frp", "confianca", "ndvi", "declividade",
    "bioma", "estado", "estacao_seca", "vento_forte", "alto_risco",
]
CONTINUOUS = [
    "temperatura", "umidade", "velocidade_vento", "precipitacao_mm", "dias_sem_chuva",
    "brilho", "frp", "confianca", "ndvi", "declividade", "indice_secura",
]
CATEGORICAL = ["bioma", "estado"]
FLAGS = ["estacao_seca", "vento_forte"]
LABEL = "alto_risco"
