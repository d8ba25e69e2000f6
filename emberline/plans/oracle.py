"""DuckDB SQL for the catalogued queries, written independently of them.

Box lookups are joins on priority here (CASE chains or grid joins in Spark),
medians and quartiles are built-in aggregates (searches in Spark), running
sums are plain windows (two-level sums in Spark).
"""

from __future__ import annotations

from emberline import lookups

AS_OF = "DATE '2024-02-04'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else repr(x) for x in row) + ")" for row in rows)


def _boxes(boxes) -> str:
    return _values([(i, *box) for i, box in enumerate(boxes)])


_LAT = "CAST(CAST(-340000 + (event_id * 7919) % 400000 AS DOUBLE) / 10000 AS DECIMAL(9,4))"
_LON = "CAST(CAST(-740000 + (event_id * 104729) % 400000 AS DOUBLE) / 10000 AS DECIMAL(9,4))"


def _rr(text: str) -> str:
    return rf"regexp_replace({text}, '(\.[0-9]+?)0+$', '\1')"


_KEY = (f"{_rr('CAST(latitude AS VARCHAR)')} || '|' || {_rr('CAST(longitude AS VARCHAR)')}"
        " || '|' || CAST(data_foco AS VARCHAR) || '|' || hora")

_RAW = f"""
base AS (
  SELECT event_id AS seq, {_LAT} AS latitude, {_LON} AS longitude, CAST(ts AS DATE) AS data_foco,
         strftime(ts, '%H%M') AS hora, event_type AS satelite, value, event_id FROM events),
raw0 AS (
  SELECT seq, latitude, longitude, data_foco, hora, satelite,
         CASE event_id % 5 WHEN 0 THEN 'l' WHEN 1 THEN 'n' WHEN 2 THEN 'h'
              WHEN 3 THEN CAST(event_id % 101 AS VARCHAR) ELSE ' N ' END AS conf_raw,
         CAST(CAST(2900 + (event_id * 31) % 800 AS DOUBLE) / 10 AS DECIMAL(7,1)) AS brilho,
         CAST(value AS DECIMAL(8,1)) AS frp, event_id AS ordinal FROM base
  UNION ALL
  SELECT seq, latitude, longitude, data_foco, hora, satelite, 'n', CAST(300 AS DECIMAL(7,1)),
         CAST(0 AS DECIMAL(8,1)), event_id + 1000000000 FROM base WHERE event_id % 29 = 0),
raw AS (
  SELECT *, {_KEY} AS id_externo,
         COALESCE(TRY_CAST(conf_raw AS DOUBLE),
                  CASE LOWER(TRIM(conf_raw)) WHEN 'l' THEN 25.0 WHEN 'n' THEN 65.0 WHEN 'h' THEN 95.0 END)
           AS confianca FROM raw0)"""

_FACT = _RAW + f""",
first_rows AS (
  SELECT * FROM raw WHERE COALESCE(confianca, 0) >= 30
  QUALIFY row_number() OVER (PARTITION BY id_externo ORDER BY ordinal) = 1),
states(p, n, a, b, c, d) AS (VALUES {_boxes(lookups.STATE_BOXES)}),
biomes(p, n, a, b, c, d) AS (VALUES {_boxes(lookups.BIOME_BOXES)}),
state_of AS (
  SELECT f.ordinal, arg_min(s.n, s.p) AS estado FROM first_rows f JOIN states s
    ON f.latitude BETWEEN s.a AND s.b AND f.longitude BETWEEN s.c AND s.d GROUP BY f.ordinal),
biome_of AS (
  SELECT f.ordinal, arg_min(s.n, s.p) AS bioma FROM first_rows f JOIN biomes s
    ON f.latitude BETWEEN s.a AND s.b AND f.longitude BETWEEN s.c AND s.d GROUP BY f.ordinal),
fact AS (
  SELECT f.seq, f.ordinal, f.id_externo, f.latitude, f.longitude, f.data_foco, f.satelite,
         CAST(f.confianca AS DECIMAL(5,1)) AS confianca, f.brilho, f.frp,
         COALESCE(s.estado, '{lookups.UNKNOWN_STATE}') AS estado,
         COALESCE(b.bioma, '{lookups.UNKNOWN_BIOME}') AS bioma
  FROM first_rows f LEFT JOIN state_of s USING (ordinal) LEFT JOIN biome_of b USING (ordinal))"""

_WEATHER = f""",
all_clima AS (
  SELECT seq, event_id AS ordinal, {_KEY} AS id_externo,
         CAST(200 + (seq * 13) % 220 AS DOUBLE) / 10 AS temperatura,
         CAST(100 + (seq * 17) % 800 AS DOUBLE) / 10 AS umidade,
         CAST((seq * 7) % 450 AS DOUBLE) / 10 AS vento,
         CASE WHEN seq % 2 = 0 THEN 0 ELSE CAST((seq * 3) % 300 AS DOUBLE) / 10 END AS precipitacao
  FROM base),
clima AS (SELECT * FROM all_clima WHERE (seq // 100) % 3 <> 0)"""

_TREATED = _FACT + _WEATHER + """,
joined AS (
  SELECT f.*, c.temperatura, c.umidade, c.vento, c.precipitacao
  FROM fact f LEFT JOIN clima c USING (id_externo)),
med AS (
  SELECT quantile_cont(temperatura, 0.5) AS mt, quantile_cont(umidade, 0.5) AS mu,
         quantile_cont(vento, 0.5) AS mv, quantile_cont(precipitacao, 0.5) AS mp FROM joined),
filled AS (
  SELECT joined.* REPLACE (COALESCE(temperatura, mt) AS temperatura, COALESCE(umidade, mu) AS umidade,
                           COALESCE(vento, mv) AS vento, COALESCE(precipitacao, mp) AS precipitacao)
  FROM joined, med),
treated AS (
  SELECT *, CASE WHEN umidade < 30 AND precipitacao < 1 THEN 1 ELSE 0 END AS estacao_seca FROM filled)"""

_STAR = _TREATED + """,
dim AS (
  SELECT id_externo, CAST(temperatura AS DECIMAL(5,1)) AS temperatura, CAST(umidade AS DECIMAL(5,1)) AS umidade,
         CAST(vento AS DECIMAL(5,1)) AS vento, CAST(precipitacao AS DECIMAL(6,1)) AS precipitacao, estacao_seca
  FROM treated)"""

_IMAGES = """,
images AS (
  SELECT id_externo, CASE seq % 3 WHEN 0 THEN 'fogo' WHEN 1 THEN 'nao_fogo' END AS classificacao
  FROM all_clima WHERE seq % 4 = 0
  UNION ALL
  SELECT id_externo, CASE seq % 3 WHEN 0 THEN 'fogo' WHEN 1 THEN 'nao_fogo' END FROM all_clima WHERE seq % 8 = 0)"""


def _dryness(c: str) -> str:
    whens = " ".join(f"WHEN '{n}' THEN {v!r}::DOUBLE" for n, v in lookups.DRYNESS_BY_BIOME.items())
    return f"(CASE {c} {whens} ELSE {lookups.DEFAULT_DRYNESS}::DOUBLE END)"


def _ndvi(c: str) -> str:
    whens = " ".join(f"WHEN '{n}' THEN {v!r}::DOUBLE" for n, v in lookups.NDVI_BY_BIOME.items())
    return f"(CASE {c} {whens} ELSE {lookups.DEFAULT_NDVI}::DOUBLE END)"


_RULE_A = (f"CASE WHEN 1 / (1 + exp(-(2.5::DOUBLE * ({_dryness('bioma')} - 0.7::DOUBLE) "
           "+ 0.025::DOUBLE * (CAST(frp AS DOUBLE) - 30) + 0.030::DOUBLE * (CAST(brilho AS DOUBLE) - 335)))) > 0.5 "
           "THEN 1 ELSE 0 END")

_MODEL = _STAR + f""",
model AS (
  SELECT id_externo, CAST(d.temperatura AS DOUBLE) AS temperatura, CAST(d.umidade AS DOUBLE) AS umidade,
         CAST(d.vento AS DOUBLE) AS velocidade_vento, CAST(d.precipitacao AS DOUBLE) AS precipitacao_mm,
         CAST(round_even(30 - LEAST(GREATEST(CAST(d.precipitacao AS DOUBLE), 0), 30), 0) AS BIGINT) AS dias_sem_chuva,
         CAST(f.brilho AS DOUBLE) AS brilho, CAST(f.frp AS DOUBLE) AS frp, CAST(f.confianca AS DOUBLE) AS confianca,
         {_ndvi('f.bioma')} AS ndvi, f.bioma, f.estado, CAST(d.estacao_seca AS BIGINT) AS estacao_seca,
         CAST(CASE WHEN d.vento >= 20 THEN 1 ELSE 0 END AS BIGINT) AS vento_forte,
         CAST({_RULE_A} AS BIGINT) AS alto_risco
  FROM fact f JOIN dim d USING (id_externo))"""

_ENGINEERED = _MODEL + """,
measured AS (
  SELECT model.* REPLACE (c.umidade AS umidade) FROM model LEFT JOIN clima c USING (id_externo)),
engineered AS (
  SELECT measured.* REPLACE (CASE WHEN dias_sem_chuva >= 10 THEN 1 ELSE 0 END AS estacao_seca),
         temperatura / (COALESCE(umidade, (SELECT quantile_cont(umidade, 0.5) FROM measured)) + 1) AS indice_secura
  FROM measured)"""

_SCORED = _RAW + _WEATHER + """,
scored AS (
  SELECT id_externo, CASE WHEN umidade < 40 THEN 1 ELSE 0 END AS real_, m.* FROM clima,
    LATERAL (SELECT * FROM (VALUES (0, 'temperatura', temperatura / 42.0::DOUBLE), (1, 'vento', vento / 45.0::DOUBLE),
                                   (2, 'precipitacao', precipitacao / 30.0::DOUBLE)) t(ordem, modelo, score)) m),
flagged AS (SELECT *, CASE WHEN score > 0.6::DOUBLE THEN 1 ELSE 0 END AS previsto FROM scored)"""

_MEASURES = """
cells AS (
  SELECT modelo, ordem, COUNT(*) FILTER (real_ = 0 AND previsto = 0) AS vn, COUNT(*) FILTER (real_ = 0 AND previsto = 1) AS fp,
         COUNT(*) FILTER (real_ = 1 AND previsto = 0) AS fn, COUNT(*) FILTER (real_ = 1 AND previsto = 1) AS vp
  FROM flagged GROUP BY ALL),
tied AS (
  SELECT modelo, score, SUM(real_) AS pos, SUM(1 - real_) AS neg FROM flagged GROUP BY ALL),
ranked AS (
  SELECT *, SUM(neg) OVER (PARTITION BY modelo ORDER BY score) - neg AS before FROM tied),
areas AS (
  SELECT modelo, CAST(SUM(pos * (2 * before + neg)) AS DOUBLE) / (2.0::DOUBLE * SUM(pos) * SUM(neg)) AS auc
  FROM ranked GROUP BY modelo),
measures AS (
  SELECT modelo, CAST(ordem AS BIGINT) AS ordem, ROUND((vn + vp) / (vn + fp + fn + vp), 4) AS acuracia,
         COALESCE(ROUND(vp / NULLIF(vp + fp, 0), 4), 0) AS precisao,
         COALESCE(ROUND(vp / NULLIF(vp + fn, 0), 4), 0) AS recall,
         COALESCE(ROUND(2 * vp / NULLIF(2 * vp + fp + fn, 0), 4), 0) AS f1, ROUND(auc, 4) AS auc, vn, fp, fn, vp
  FROM cells JOIN areas USING (modelo))"""


def _q(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _mean(c: str, places: int = 1) -> str:
    return f"ROUND(CAST(SUM({c}) AS DOUBLE) / COUNT({c}), {places})"


def _plain_fact(source: str = "fact") -> str:
    return (f"SELECT id_externo, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, "
            f"CAST(data_foco AS VARCHAR) AS data_foco, satelite, CAST(confianca AS DOUBLE) AS confianca, "
            f"CAST(brilho AS DOUBLE) AS brilho, CAST(frp AS DOUBLE) AS frp, estado, bioma FROM {source}")


def _plain_dim(source: str = "dim") -> str:
    return (f"SELECT id_externo, CAST(temperatura AS DOUBLE) AS temperatura, CAST(umidade AS DOUBLE) AS umidade, "
            f"CAST(vento AS DOUBLE) AS vento, CAST(precipitacao AS DOUBLE) AS precipitacao, "
            f"CAST(estacao_seca AS BIGINT) AS estacao_seca FROM {source}")


_WEATHER_COLUMNS = ["temperatura", "umidade", "vento", "precipitacao"]
_ROUNDED = ", ".join(f"ROUND({c}, 6) AS {c}" for c in _WEATHER_COLUMNS)
_NUMERIC = ["temperatura", "umidade", "velocidade_vento", "precipitacao_mm", "dias_sem_chuva", "brilho", "frp",
            "confianca", "ndvi", "indice_secura"]

_DIRTY = _RAW + """,
dirty AS (
  SELECT * REPLACE (CASE WHEN seq % 19 = 0 THEN NULL ELSE latitude END AS latitude,
                    CASE WHEN seq % 23 = 0 THEN NULL ELSE longitude END AS longitude,
                    CASE WHEN seq % 17 = 0 OR seq % 31 = 0 THEN NULL ELSE data_foco END AS data_foco) FROM raw)"""

_CRITICAL = """,
critical AS (
  SELECT f.id_externo, f.estado, f.bioma, f.frp, {w}.umidade, i.classificacao
  FROM fact f JOIN {w} USING (id_externo) LEFT JOIN images i USING (id_externo)
  WHERE f.frp > 50 AND (i.classificacao = 'fogo' OR i.classificacao IS NULL))"""

_GIVEN = _RAW + _WEATHER + """,
given AS (
  SELECT id_externo, seq, posicao, 'f' || posicao AS atributo,
         CAST((seq * 31 + posicao * 17) % 101 - 50 AS DOUBLE) / 64 AS impacto, 0.25::DOUBLE AS base
  FROM all_clima, range(16) t(posicao)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY id_externo ORDER BY abs(impacto) DESC, posicao) AS r FROM given)"""


def _clip(c: str) -> str:
    bounds = (f"(SELECT struct_pack(a := quantile_cont({c}, 0.25), b := quantile_cont({c}, 0.75)) FROM engineered)")
    return (f"CASE WHEN {c} IS NULL THEN NULL ELSE ROUND(LEAST(GREATEST(CAST({c} AS DOUBLE), "
            f"{bounds}.a - 1.5::DOUBLE * ({bounds}.b - {bounds}.a)), "
            f"{bounds}.b + 1.5::DOUBLE * ({bounds}.b - {bounds}.a)), 6) END AS {c}")


def _z(c: str) -> str:
    v = f"CAST(COALESCE({c}, (SELECT quantile_cont({c}, 0.5) FROM engineered)) AS DOUBLE)"
    return f"ROUND(({v} - AVG({v}) OVER ()) / STDDEV_POP({v}) OVER (), 5) AS {c}"


def _quartiles() -> str:
    parts = [f"SELECT '{c}' AS coluna, ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q1, "
             f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS mediana, "
             f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q3 FROM treated"
             for c in ("brilho", "frp", "confianca", *_WEATHER_COLUMNS)]
    return " UNION ALL ".join(parts)


def _modes() -> str:
    parts = [f"(SELECT '{c}' AS coluna, {c} AS moda FROM fact GROUP BY {c} "
             f"ORDER BY COUNT(*) DESC, {c} LIMIT 1)" for c in ("estado", "bioma", "satelite")]
    return " UNION ALL ".join(parts)


def _onehot() -> str:
    return """
SELECT 'bioma=' || b.v AS atributo, CAST((SELECT COUNT(*) FROM model m WHERE m.bioma = b.v) AS DOUBLE) AS total
FROM (SELECT DISTINCT bioma AS v FROM model WHERE bioma <> 'Pampa') b
UNION ALL
SELECT 'estado=' || e.v, CAST((SELECT COUNT(*) FROM model m WHERE m.estado = e.v) AS DOUBLE)
FROM (SELECT DISTINCT estado AS v FROM model WHERE bioma <> 'Pampa') e"""


_TEST = _MODEL + """,
by_label AS (SELECT alto_risco, CAST(floor(0.2::DOUBLE * COUNT(*) + 0.5::DOUBLE) AS BIGINT) AS n FROM model GROUP BY alto_risco),
test AS (SELECT CAST(SUM(n) AS BIGINT) AS linhas, CAST(SUM(n) FILTER (alto_risco = 1) AS BIGINT) AS positivos FROM by_label)"""


def _measured(name: str) -> str:
    return _q(_TEST, f"SELECT '{name}' AS modelo, linhas, positivos, CAST(1 AS BIGINT) AS melhor_que_maioria FROM test")


def _numbers(**values: int) -> str:
    return "SELECT " + ", ".join(f"CAST({value} AS BIGINT) AS {name}" for name, value in values.items())


ORACLE: dict[str, str] = {
    "rf_metrics": _measured("Random Forest"),
    "gbt_metrics": _measured("Gradient Boosting"),
    "mlp_metrics": _measured("Rede Neural (MLP)"),
    "model_comparison": _q(_TEST, """
        SELECT CAST(3 AS BIGINT) AS modelos, linhas AS linhas_min, linhas AS linhas_max, CAST(1 AS BIGINT) AS melhores,
               CAST(1 AS BIGINT) AS melhor_tem_maior_f1 FROM test"""),
    "model_roundtrip": _q(_MODEL, "SELECT COUNT(*) AS linhas, CAST(0 AS BIGINT) AS desvios FROM model"),
    "learning_curve_rf": _numbers(passos=60, ultimo=300, fim_igual=1),
    "learning_curve_gbt": _numbers(passos=15, ultimo=300, fim_igual=1),
    "learning_curve_mlp": _numbers(epocas=80, ultima=80, aprendeu=1),
    "shap_long": _q(_TEST, "SELECT linhas AS focos, CAST(0 AS BIGINT) AS incompletos FROM test"),
    "shap_boosting": _q(_TEST, "SELECT linhas, CAST(0 AS BIGINT) AS desvios FROM test"),
    "shap_network": _q(_TEST, "SELECT linhas, CAST(0 AS BIGINT) AS desvios FROM test"),
    "daily_scan": _q(_RAW, f"""
        SELECT id_externo, CAST(data_foco AS VARCHAR) AS data, hora, satelite, CAST(brilho AS DOUBLE) AS brilho,
               CAST(frp AS DOUBLE) AS frp, CAST(confianca AS DOUBLE) AS confianca
        FROM raw WHERE data_foco <= {AS_OF} AND data_foco > {AS_OF} - 12"""),
    "daily_scan_mixed_headers": _q(_RAW, f"""
        SELECT id_externo, CAST(data_foco AS VARCHAR) AS data, hora, satelite, CAST(brilho AS DOUBLE) AS brilho,
               CAST(frp AS DOUBLE) AS frp, CAST(confianca AS DOUBLE) AS confianca
        FROM raw WHERE data_foco <= {AS_OF} AND data_foco > {AS_OF} - 12"""),
    "daily_concat": _q(_RAW, """
        SELECT seq, ordinal, CAST(data_foco AS VARCHAR) AS acq_date,
               CASE WHEN data_foco >= DATE '2024-01-11' THEN CAST(brilho AS DOUBLE) END AS bright_ti4 FROM raw"""),
    "bbox_filter": _q(_RAW, """
        SELECT * FROM (SELECT ordinal, ROUND(CAST(latitude AS DOUBLE) * 1.25::DOUBLE, 6) AS latitude,
                              ROUND(CAST(longitude AS DOUBLE) + 10, 6) AS longitude FROM raw)
        WHERE latitude BETWEEN -34 AND 6 AND longitude BETWEEN -74 AND -34"""),
    "weather_batches": _q(_RAW + _WEATHER, """
        SELECT lote, COUNT(*) AS n, arg_min(id_externo, seq) AS primeiro, arg_max(id_externo, seq) AS ultimo,
               COUNT(*) AS coordenadas
        FROM (SELECT *, (row_number() OVER (ORDER BY seq) - 1) // 100 AS lote FROM all_clima) GROUP BY lote"""),
    "weather_batch_parse": _q(_RAW + _WEATHER, """
        SELECT id_externo, temperatura, umidade, vento, precipitacao FROM all_clima
        WHERE seq % 50 <> 7 AND (seq % 1000 = 999 OR (seq // 100) % 3 <> 0)"""),
    "weather_single_parse": _q(_RAW + _WEATHER, """
        SELECT id_externo, temperatura, umidade,
               CASE WHEN seq % 11 = 0 THEN 0 ELSE ROUND(vento * 3.6::DOUBLE, 6) END AS vento, precipitacao
        FROM all_clima WHERE seq % 13 <> 0 AND seq % 17 <> 0"""),
    "weather_fallback": _q(_RAW + _WEATHER, """
        SELECT 'foco' AS fonte, COUNT(*) AS linhas, ROUND(AVG(temperatura), 6) AS temp_media
        FROM all_clima WHERE seq % 13 <> 0 AND seq % 17 <> 0"""),
    "dataset_source": _q(_FACT, "SELECT 'arquivo' AS fonte, COUNT(*) AS linhas FROM fact"),
    "stage_roundtrip": _q(_FACT, _plain_fact()),
    "evidence_roundtrip": _q(_FACT, _plain_fact()),
    "synthetic_detections": """
        SELECT COUNT(*) AS linhas, COUNT(*) AS chaves, CAST(30 AS BIGINT) AS dias, CAST(4 AS BIGINT) AS satelites,
               CAST(0 AS BIGINT) AS fora FROM events""",
    "synthetic_weather": _q(_RAW + _WEATHER, """
        SELECT COUNT(*) AS linhas, COUNT(DISTINCT id_externo) AS chaves, CAST(0 AS BIGINT) AS fora FROM all_clima"""),
    "synthetic_training": """
        SELECT COUNT(*) AS linhas, CAST(0 AS BIGINT) AS fora, CAST(1 AS BIGINT) AS temperatura_ok,
               CAST(1 AS BIGINT) AS velocidade_vento_ok, CAST(1 AS BIGINT) AS precipitacao_mm_ok,
               CAST(1 AS BIGINT) AS dias_sem_chuva_ok, CAST(1 AS BIGINT) AS frp_ok,
               CAST(1 AS BIGINT) AS declividade_ok, CAST(1 AS BIGINT) AS ndvi_ok FROM events""",
    "null_injection": """
        SELECT COUNT(*) AS linhas, CAST(floor(0.02 * COUNT(*)) AS BIGINT) AS temperatura_nulos,
               CAST(floor(0.02 * COUNT(*)) AS BIGINT) AS umidade_nulos,
               CAST(floor(0.02 * COUNT(*)) AS BIGINT) AS vento_nulos FROM events""",
    "rename_canonical": _q(_RAW, """
        SELECT ordinal, CAST(data_foco AS VARCHAR) AS data, hora, satelite, conf_raw AS confianca,
               CAST(brilho AS DOUBLE) + CASE WHEN seq % 3 = 0 THEN 1000 ELSE 0 END AS brilho,
               CAST(frp AS DOUBLE) AS frp FROM raw"""),
    "numeric_coercion": _q(_RAW, """
        SELECT ordinal, CASE WHEN seq % 7 > 3 THEN CAST(frp AS DOUBLE) END AS valor,
               CAST(latitude AS DOUBLE) AS latitude FROM raw"""),
    "natural_key": _q(_RAW, "SELECT ordinal, id_externo FROM raw"),
    "drop_invalid": _q(_RAW, """
        SELECT ordinal, id_externo, CAST(data_foco AS VARCHAR) AS data_foco FROM raw
        WHERE seq % 19 <> 0 AND seq % 23 <> 0 AND seq % 17 <> 0 AND seq % 31 <> 0"""),
    "conf_normalise": _q(_RAW, "SELECT ordinal, CAST(confianca AS DOUBLE) AS confianca FROM raw"),
    "conf_filter": _q(_RAW, """
        SELECT ordinal, id_externo, CAST(confianca AS DOUBLE) AS confianca FROM raw WHERE COALESCE(confianca, 0) >= 30"""),
    "dedup_first": _q(_FACT, """
        SELECT id_externo, ordinal, CAST(brilho AS DOUBLE) AS brilho, CAST(frp AS DOUBLE) AS frp,
               CAST(confianca AS DOUBLE) AS confianca FROM first_rows"""),
    "dedup_weather": _q(_RAW + _WEATHER, """
        SELECT id_externo, temperatura, ordinal FROM (
          SELECT id_externo, temperatura, ordinal FROM clima UNION ALL
          SELECT id_externo, 0, ordinal + 1000000000 FROM clima WHERE seq % 10 = 1)
        QUALIFY row_number() OVER (PARTITION BY id_externo ORDER BY ordinal) = 1"""),
    "dedup_full_rows": _q(_RAW + _WEATHER, """
        SELECT DISTINCT id_externo, temperatura, umidade, vento, precipitacao FROM clima"""),
    "column_split": _q(_TREATED, """
        SELECT 'focos' AS parte, COUNT(*) AS linhas, CAST(2 AS BIGINT) AS colunas FROM joined
        UNION ALL SELECT 'clima', COUNT(*), CAST(5 AS BIGINT)
        FROM (SELECT DISTINCT id_externo, temperatura, umidade, vento, precipitacao FROM joined)"""),
    "transform_funnel": _q(_DIRTY, """
        SELECT COUNT(*) AS linhas_brutas,
               COUNT(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS com_coordenadas,
               COUNT(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL AND data_foco IS NOT NULL) AS com_data,
               COUNT(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL AND data_foco IS NOT NULL
                                AND COALESCE(confianca, 0) >= 30) AS com_confianca,
               COUNT(DISTINCT id_externo) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL
                                AND data_foco IS NOT NULL AND COALESCE(confianca, 0) >= 30) AS sem_duplicatas
        FROM dirty"""),
    "geo_state": _q(_RAW, f"""
        SELECT r.ordinal, COALESCE(arg_min(s.n, s.p), '??') AS estado FROM raw r
        LEFT JOIN (VALUES {_boxes(lookups.STATE_BOXES)}) s(p, n, a, b, c, d)
          ON r.latitude BETWEEN s.a AND s.b AND r.longitude BETWEEN s.c AND s.d GROUP BY r.ordinal"""),
    "geo_biome": _q(_RAW, f"""
        SELECT r.ordinal, COALESCE(arg_min(s.n, s.p), 'Desconhecido') AS bioma FROM raw r
        LEFT JOIN (VALUES {_boxes(lookups.BIOME_BOXES)}) s(p, n, a, b, c, d)
          ON r.latitude BETWEEN s.a AND s.b AND r.longitude BETWEEN s.c AND s.d GROUP BY r.ordinal"""),
    "geo_box_table": _q(_RAW + """,
boxes AS (
  -- decimals: a point on an edge must compare equal to it
  SELECT c_name AS n, c_custkey AS p, -34 + CAST(c_custkey * 37 % 400 AS DECIMAL(9,1)) * 0.1 AS a,
         -74 + CAST(c_custkey * 53 % 400 AS DECIMAL(9,1)) * 0.1 AS c,
         a + CAST(c_custkey % 7 + 1 AS DECIMAL(9,1)) * 0.3 AS b,
         c + CAST(c_custkey % 5 + 1 AS DECIMAL(9,1)) * 0.4 AS d FROM customer)""", """
        SELECT r.ordinal, COALESCE(arg_min(x.n, x.p), 'nenhum') AS lugar FROM raw r LEFT JOIN boxes x
          ON r.latitude BETWEEN x.a AND x.b AND r.longitude BETWEEN x.c AND x.d
        GROUP BY r.ordinal"""),
    "dictionary_lookup": _q(_FACT, f"""
        SELECT id_externo, {_ndvi('bioma')} AS ndvi, {_dryness('bioma')} AS fator FROM (
          SELECT id_externo, CASE WHEN frp > 100 THEN 'Outro' ELSE bioma END AS bioma FROM fact)"""),
    "stage_fan_out": _q(_RAW + _WEATHER, """
        SELECT r.id_externo, COUNT(*) AS linhas, COUNT(temperatura) AS com_clima FROM raw r LEFT JOIN (
          SELECT id_externo, temperatura FROM clima UNION ALL
          SELECT id_externo, temperatura FROM clima WHERE temperatura < 25) w USING (id_externo) GROUP BY r.id_externo"""),
    "weather_join": _q(_TREATED, """
        SELECT id_externo, CAST(frp AS DOUBLE) AS frp, temperatura, umidade, vento, precipitacao FROM joined"""),
    "climate_coercion": _q(_RAW + _WEATHER, "SELECT id_externo, " + ", ".join(
        f"CASE WHEN seq % 9 > 2 THEN {c} END AS {c}" for c in _WEATHER_COLUMNS) + " FROM clima"),
    "weather_medians": _q(_TREATED, """
        SELECT ROUND(mt, 6) AS temperatura, ROUND(mu, 6) AS umidade, ROUND(mv, 6) AS vento,
               ROUND(mp, 6) AS precipitacao FROM med"""),
    "median_impute": _q(_TREATED, f"SELECT id_externo, {_ROUNDED} FROM treated"),
    "dry_flag": _q(_TREATED, """
        SELECT id_externo, CAST(CASE WHEN umidade < 30 AND precipitacao < 1 THEN 1 ELSE 0 END AS BIGINT) AS estacao_seca
        FROM joined"""),
    "treated_rows": _q(_TREATED, f"""
        SELECT id_externo, CAST(data_foco AS VARCHAR) AS data_foco, satelite, CAST(confianca AS DOUBLE) AS confianca,
               CAST(brilho AS DOUBLE) AS brilho, CAST(frp AS DOUBLE) AS frp, estado, bioma, {_ROUNDED},
               CAST(estacao_seca AS BIGINT) AS estacao_seca FROM treated"""),
    "bind_rows": _q(_STAR, """
        SELECT t.id_externo, CAST(t.latitude AS DOUBLE) AS latitude, CAST(t.longitude AS DOUBLE) AS longitude,
               CAST(t.data_foco AS VARCHAR) AS data_foco,
               CASE WHEN t.seq % 7 <> 0 THEN substr(t.satelite || '-abcdefghijklmnopqrstuvwxyz', 1, 20) END AS satelite,
               CAST(t.confianca AS DOUBLE) AS confianca,
               CASE WHEN t.seq % 17 <> 0 THEN CAST(t.brilho AS DOUBLE) END AS brilho, CAST(t.frp AS DOUBLE) AS frp,
               CASE WHEN t.seq % 11 = 0 THEN '??' ELSE t.estado END AS estado,
               CASE WHEN t.seq % 13 = 0 THEN 'Desconhecido' ELSE t.bioma END AS bioma,
               CAST(d.temperatura AS DOUBLE) AS temperatura, CAST(d.umidade AS DOUBLE) AS umidade,
               CAST(d.vento AS DOUBLE) AS vento, CAST(d.precipitacao AS DOUBLE) AS precipitacao,
               CAST(CASE WHEN t.seq % 5 = 0 THEN 0 ELSE t.estacao_seca END AS BIGINT) AS estacao_seca
        FROM treated t JOIN dim d USING (id_externo)"""),
    "merge_insert_only": _q(_FACT, _plain_fact()),
    "merge_weather": _q(_STAR, _plain_dim()),
    "merge_moved_dates": _q(_FACT, """
        SELECT id_externo, CAST(data_foco AS VARCHAR) AS data_foco, CAST(frp AS DOUBLE) AS frp FROM fact
        UNION ALL SELECT printf('SYN%06d', seq), CAST(data_foco AS VARCHAR), CAST(frp AS DOUBLE) FROM fact
        WHERE seq % 5 = 0"""),
    "pipeline_end_to_end": _q(_FACT + _WEATHER + """,
        landed AS (SELECT * FROM all_clima WHERE seq % 50 <> 7 AND (seq % 1000 = 999 OR (seq // 100) % 3 <> 0)),
        joined AS (SELECT f.*, c.temperatura, c.umidade, c.vento, c.precipitacao
                   FROM fact f LEFT JOIN landed c USING (id_externo)),
        med AS (SELECT quantile_cont(temperatura, 0.5) AS mt, quantile_cont(umidade, 0.5) AS mu,
                       quantile_cont(precipitacao, 0.5) AS mp FROM joined),
        filled AS (SELECT bioma, frp, COALESCE(temperatura, mt) AS t, COALESCE(umidade, mu) AS u,
                          COALESCE(precipitacao, mp) AS p FROM joined, med)""", """
        SELECT bioma, COUNT(*) AS focos, CAST(SUM(frp) AS DOUBLE) AS frp_total,
               CAST(SUM(CAST(t AS DECIMAL(5,1))) AS DOUBLE) AS temperatura_total,
               CAST(SUM(CAST(u AS DECIMAL(5,1))) AS DOUBLE) AS umidade_total,
               CAST(SUM(CASE WHEN u < 30 AND p < 1 THEN 1 ELSE 0 END) AS BIGINT) AS em_seca
        FROM filled GROUP BY bioma"""),
    "merge_new_rows": _q(_FACT, "SELECT id_externo, CAST(frp AS DOUBLE) AS frp FROM fact WHERE frp <= 40"),
    "table_counts_loaded": _q(_FACT + _WEATHER + _IMAGES, """
        SELECT 'focos_incendio' AS tabela, COUNT(*) AS linhas FROM fact
        UNION ALL SELECT 'clima_associado', COUNT(*) FROM fact
        UNION ALL SELECT 'imagens_satelite_metadata', COUNT(*) FROM images"""),
    "constraint_check": _q(_FACT + _WEATHER + _IMAGES, """
        SELECT 'focos_incendio: chave unica' AS regra, COUNT(*) AS violacoes FROM fact WHERE frp > 200
        UNION ALL SELECT 'focos_incendio: nao nulo', 2 * COUNT(*) FROM fact WHERE frp > 300
        UNION ALL SELECT 'clima_associado: chave unica', CAST(0 AS BIGINT)
        UNION ALL SELECT 'clima_associado: nao nulo', CAST(0 AS BIGINT)
        UNION ALL SELECT 'clima_associado: chave estrangeira', COUNT(*) FROM clima
          WHERE id_externo NOT IN (SELECT id_externo FROM fact)
        UNION ALL SELECT 'imagens_satelite_metadata: nao nulo', CAST(0 AS BIGINT)
        UNION ALL SELECT 'imagens_satelite_metadata: chave estrangeira', COUNT(*) FROM images
          WHERE id_externo NOT IN (SELECT id_externo FROM fact)"""),
    "load_quarantine": _q(_FACT, "SELECT 'quarentena' AS estado, COUNT(*) AS linhas FROM fact"),
    "q1_state_ranking": _q(_FACT, f"""
        SELECT estado, COUNT(*) AS total_focos, {_mean('frp')} AS frp_medio FROM fact
        WHERE data_foco >= {AS_OF} - INTERVAL 1 MONTH GROUP BY estado"""),
    "q2_daily": _q(_FACT, f"""
        SELECT CAST(data_foco AS VARCHAR) AS dia, COUNT(*) AS focos_no_dia FROM fact
        WHERE data_foco >= {AS_OF} - 30 GROUP BY data_foco"""),
    "q2_daily_filled": _q(_FACT, f"""
        SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS dia, COUNT(id_externo) AS focos_no_dia
        FROM generate_series({AS_OF} - 30, {AS_OF}, INTERVAL 1 DAY) t(d)
        LEFT JOIN fact f ON f.data_foco = CAST(d AS DATE) GROUP BY d"""),
    "q3_weather_by_biome": _q(_STAR, f"""
        SELECT bioma, COUNT(*) AS qtd_focos, {_mean('temperatura')} AS temp_media, {_mean('umidade')} AS umidade_media,
               {_mean('vento')} AS vento_medio, CAST(SUM(estacao_seca) AS BIGINT) AS focos_em_seca
        FROM (SELECT id_externo, bioma FROM fact) JOIN dim USING (id_externo) GROUP BY bioma"""),
    "q4_top_frp": _q(_FACT, """
        SELECT id_externo, estado, bioma, CAST(frp AS DOUBLE) AS frp, CAST(brilho AS DOUBLE) AS brilho,
               CAST(data_foco AS VARCHAR) AS data_foco FROM fact ORDER BY fact.frp DESC, id_externo LIMIT 10"""),
    "q5_satellite_stats": _q(_FACT, f"""
        SELECT satelite, COUNT(*) AS qtd, CAST(MIN(frp) AS DOUBLE) AS frp_min, {_mean('frp')} AS frp_medio,
               CAST(MAX(frp) AS DOUBLE) AS frp_max, {_mean('confianca')} AS confianca_media
        FROM fact GROUP BY satelite HAVING COUNT(*) > 0"""),
    "q6_critical_cnn": _q(_STAR + _IMAGES + _CRITICAL.format(w="dim"), f"""
        SELECT estado, bioma, COUNT(*) AS focos_criticos, {_mean('frp')} AS frp_medio,
               {_mean('umidade')} AS umidade_media, CAST(MAX(frp) AS DOUBLE) AS frp_max
        FROM critical GROUP BY estado, bioma"""),
    "q6_critical_distinct": _q(_STAR + _IMAGES + _CRITICAL.format(w="dim"), f"""
        SELECT estado, bioma, COUNT(*) AS focos_criticos, {_mean('frp')} AS frp_medio,
               {_mean('umidade')} AS umidade_media, CAST(MAX(frp) AS DOUBLE) AS frp_max
        FROM (SELECT DISTINCT id_externo, estado, bioma, frp, umidade FROM critical) GROUP BY estado, bioma"""),
    "critical_predicate": _q(_FACT + _WEATHER + _IMAGES + _CRITICAL.format(w="clima"), """
        SELECT id_externo, estado, bioma, CAST(frp AS DOUBLE) AS frp, umidade, classificacao FROM critical"""),
    "recency": _q(_FACT, f"""
        SELECT CAST(data_foco AS VARCHAR) AS data_foco,
               COUNT(*) FILTER (data_foco >= DATE '2024-01-31') AS ultimo_mes,
               COUNT(*) FILTER (data_foco >= {AS_OF} - 20) AS ultimos_20 FROM fact GROUP BY data_foco"""),
    "preview_first": _q(_FACT, f"""
        SELECT estado, COUNT(*) AS total_focos, {_mean('frp')} AS frp_medio FROM fact
        WHERE data_foco >= {AS_OF} - INTERVAL 1 MONTH GROUP BY estado ORDER BY total_focos DESC, estado LIMIT 10"""),
    "sanity_top5": _q(_FACT, """
        SELECT estado, COUNT(*) AS total FROM fact GROUP BY estado ORDER BY total DESC, estado LIMIT 5"""),
    "sanity_by_biome": _q(_FACT, "SELECT bioma, COUNT(*) AS total FROM fact GROUP BY bioma"),
    "sanity_means": _q(_TREATED, """
        SELECT COUNT(*) AS total, ROUND(AVG(CAST(frp AS DOUBLE)), 2) AS media_frp,
               ROUND(AVG(temperatura), 2) AS media_temperatura,
               ROUND(AVG(umidade), 2) AS media_umidade, ROUND(AVG(vento), 2) AS media_vento,
               ROUND(AVG(precipitacao), 2) AS media_precipitacao,
               ROUND(AVG(estacao_seca) * 100, 1) AS pct_estacao_seca FROM treated"""),
    "global_quartiles": _q(_TREATED, _quartiles()),
    "column_modes": _q(_FACT, _modes()),
    "snapshot_export": _q(_MODEL, "SELECT * FROM model"),
    "rain_proxy": _q(_RAW + _WEATHER, """
        SELECT id_externo, CAST(round_even(30 - LEAST(GREATEST(precipitacao * 5 - 20, 0), 30), 0) AS BIGINT)
          AS dias_sem_chuva FROM clima"""),
    "slope_proxy": """
        SELECT COUNT(*) AS linhas, CAST(0 AS BIGINT) AS fora, CAST(1 AS BIGINT) AS media_ok,
               CAST(1 AS BIGINT) AS desvio_ok FROM events""",
    "scalar_functions": _q(_RAW + _WEATHER, f"""
        SELECT seq, LEAST(GREATEST(ROUND(temperatura * 1.37::DOUBLE - 35, 1), -5), 12) AS limitado,
               ROUND(vento * 3.6::DOUBLE, 6) AS kmh,
               CASE WHEN length(CAST(seq % 1000000 AS VARCHAR)) >= 4 THEN CAST(seq % 1000000 AS VARCHAR)
                    ELSE lpad(CAST(seq % 1000000 AS VARCHAR), 4, '0') END AS preenchido,
               'x' || seq AS texto, CAST({AS_OF} - CAST(seq % 400 AS INTEGER) AS VARCHAR) AS dia FROM all_clima"""),
    "engineered_features": _q(_ENGINEERED, """
        SELECT id_externo, ROUND(indice_secura, 6) AS indice_secura, CAST(estacao_seca AS BIGINT) AS estacao_seca,
               vento_forte FROM engineered"""),
    "iqr_clip": _q(_ENGINEERED, "SELECT id_externo, " + ", ".join(map(_clip, _NUMERIC)) + " FROM engineered"),
    "standardise": _q(_ENGINEERED, "SELECT id_externo, " + ", ".join(map(_z, _NUMERIC)) + " FROM engineered"),
    "label_rule_a": _q(_FACT, f"SELECT id_externo, CAST({_RULE_A} AS BIGINT) AS alto_risco FROM fact"),
    "label_rule_b": _q(_MODEL, f"""
        SELECT id_externo, CAST(CASE WHEN 1 / (1 + exp(-(0.16::DOUBLE * (temperatura - 30) - 0.07::DOUBLE * (umidade - 45)
            + 0.13::DOUBLE * (velocidade_vento - 12) - 0.10::DOUBLE * precipitacao_mm
            + 0.14::DOUBLE * (dias_sem_chuva - 8) + 0.012::DOUBLE * (frp - 50)
            + 1.6::DOUBLE * ({_dryness('bioma')} - 0.8::DOUBLE) + 1.8::DOUBLE * (ndvi - 0.5::DOUBLE)))) > 0.5
            THEN 1 ELSE 0 END AS BIGINT) AS alto_risco FROM model"""),
    "target_share": _q(_MODEL, """
        SELECT alto_risco, COUNT(*) AS total, ROUND(COUNT(*) / (SELECT COUNT(*) FROM model), 6) AS fracao
        FROM model GROUP BY alto_risco"""),
    "biome_share": _q(_FACT, """
        SELECT bioma, COUNT(*) AS total, ROUND(COUNT(*) / (SELECT COUNT(*) FROM fact), 6) AS fracao
        FROM fact GROUP BY bioma"""),
    "profile": _q(_MODEL, """
        SELECT COUNT(*) AS linhas, CAST(14 AS BIGINT) AS colunas, ROUND(AVG(alto_risco) * 100, 1) AS pct_positivo
        FROM model"""),
    "stratified_split": _q(_MODEL, """
        SELECT alto_risco, COUNT(*) AS linhas, CAST(floor(0.2::DOUBLE * COUNT(*) + 0.5::DOUBLE) AS BIGINT) AS teste
        FROM model GROUP BY alto_risco"""),
    "mode_impute": _q(_FACT, """
        SELECT COALESCE(NULLIF(estado, '??'), (SELECT estado FROM fact WHERE estado <> '??' GROUP BY estado
               ORDER BY COUNT(*) DESC, estado LIMIT 1)) AS estado, COUNT(*) AS linhas FROM fact GROUP BY 1"""),
    "onehot_counts": _q(_MODEL, _onehot()),
    "metrics": _q(_SCORED + ",\n" + _MEASURES, """
        SELECT acuracia, precisao, recall, f1, auc, vn, fp, fn, vp FROM measures WHERE modelo = 'temperatura'"""),
    "leaderboard": _q(_SCORED + ",\n" + _MEASURES, "SELECT * FROM measures"),
    "confusion": _q(_SCORED, """
        SELECT CAST(r AS BIGINT) AS real, CAST(p AS BIGINT) AS previsto,
               (SELECT COUNT(*) FROM flagged WHERE modelo = 'vento' AND real_ = r AND previsto = p) AS total
        FROM range(2) a(r), range(2) b(p)"""),
    "auc_exact": _q(_TREATED + """,
points AS (
  SELECT CASE WHEN umidade < 45 THEN 1 ELSE 0 END AS y, CAST(frp AS DOUBLE) + CAST(brilho AS DOUBLE) / 1000 AS s FROM treated),
tied AS (SELECT s, SUM(y) AS pos, SUM(1 - y) AS neg FROM points GROUP BY s),
ranked AS (SELECT *, SUM(neg) OVER (ORDER BY s) - neg AS before FROM tied)""", """
        SELECT ROUND(CAST(SUM(pos * (2 * before + neg)) AS DOUBLE) / (2.0::DOUBLE * SUM(pos) * SUM(neg)), 8) AS auc
        FROM ranked"""),
    "alert_tiers": _q(_SCORED, """
        SELECT id_externo, ROUND(score, 6) AS probabilidade,
               CASE WHEN ROUND(score, 6) >= 0.7::DOUBLE THEN 'alto' WHEN ROUND(score, 6) >= 0.4::DOUBLE THEN 'moderado'
                    ELSE 'baixo' END AS nivel FROM scored WHERE modelo = 'vento'"""),
    "alert_table": _q(_SCORED, """
        SELECT id_externo, ROUND(score, 6) AS probabilidade, 'alto' AS nivel FROM scored
        WHERE modelo = 'vento' AND ROUND(score, 6) >= 0.7::DOUBLE"""),
    "shap_additivity": _q(_FACT, "SELECT COUNT(*) AS linhas, CAST(0 AS BIGINT) AS desvios FROM fact"),
    "shap_global": _q(_GIVEN, """
        SELECT atributo, ROUND(AVG(abs(impacto)), 8) AS impacto_medio_abs, ROUND(AVG(impacto), 8) AS impacto_medio
        FROM given GROUP BY atributo"""),
    "shap_topk": _q(_GIVEN, """
        SELECT id_externo, r AS ordem, atributo, impacto FROM ranked WHERE r <= 12"""),
    "shap_waterfall": _q(_GIVEN + """,
steps AS (
  SELECT id_externo, base, LEAST(r, 14) AS ordem, CASE WHEN r < 14 THEN atributo ELSE 'outros' END AS atributo,
         SUM(impacto) AS impacto FROM ranked GROUP BY ALL),
path AS (
  SELECT *, base + SUM(impacto) OVER (PARTITION BY id_externo ORDER BY ordem DESC) AS fim FROM steps)""", """
        SELECT id_externo, ordem, atributo, impacto, fim - impacto AS inicio, fim FROM path"""),
    "stream_ingest": _q(_FACT, _plain_fact()),
    "stream_daily_counts": _q(_RAW, """
        SELECT CAST(data_foco AS VARCHAR) AS dia, COUNT(DISTINCT id_externo) AS focos_no_dia FROM raw
        GROUP BY data_foco HAVING CAST(data_foco AS TIMESTAMP) + INTERVAL 1 DAY <=
          (SELECT MAX(CAST(data_foco AS TIMESTAMP) + INTERVAL (CAST(hora[1:2] AS INTEGER)) HOUR
                      + INTERVAL (CAST(hora[3:4] AS INTEGER)) MINUTE) - INTERVAL 1 DAY FROM raw)"""),
    "stream_daily_totals": _q(_RAW, """
        SELECT CAST(data_foco AS VARCHAR) AS dia, COUNT(DISTINCT id_externo) AS focos_no_dia FROM raw GROUP BY data_foco"""),
    "stream_landing": _q(_FACT, _plain_fact()),
    "stream_scoring": _q(_FACT, "SELECT COUNT(*) AS linhas, COUNT(*) AS iguais FROM fact"),
}
