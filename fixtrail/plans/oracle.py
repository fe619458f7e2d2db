"""The same results in plain SQL, for checking the registered queries on another engine."""

from __future__ import annotations

import math

from fixtrail.plans.queries import FOREST_FEATURES, FOREST_NODES, GAP_SECONDS, SEQUENCE_FEATURES, WINDOW

_FLAGS = [f"HBOS_bins{b}_p{p}_label" for b in (10, 20) for p in (90, 95, 99)]
_TRUTH = "HBOS_bins20_p95_label"
_REGIONS = ("click", "error", "purchase", "signup", "view")
_MOTION = ("velocidade_kmh", "dist_m", "aceleracao")
_SCALED = ("hora_sin", "hora_cos", "dia_sem", "eh_feriado", *_MOTION)
_HIST = ("velocidade_kmh", "aceleracao", "dist_m", "hora", "dia_sem", "eh_feriado")

# Good Fridays and the fixed dates of the years that occur in the tables.
_GOOD_FRIDAYS = (
    "1995-04-14",
    "1996-04-05",
    "1997-03-28",
    "1998-04-10",
    "1999-04-02",
    "2000-04-21",
    "2001-04-13",
    "2024-03-29",
)
_FIXED_DAYS = ("01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25")


def _holiday(day: str) -> str:
    fixed = ", ".join(f"'{d}'" for d in _FIXED_DAYS)
    fridays = ", ".join(f"DATE '{d}'" for d in _GOOD_FRIDAYS)
    return (
        f"CAST(strftime({day}, '%m-%d') IN ({fixed}) OR CAST({day} AS DATE) IN ({fridays}) "
        f"OR (strftime({day}, '%m-%d') = '11-30' AND year({day}) >= 1996) "
        f"OR (strftime({day}, '%m-%d') = '11-20' AND year({day}) >= 2024) AS INTEGER)"
    )


_TRAJ = """traj AS (
  SELECT event_id, user_id AS placa, ts AS "timestamp",
         -15.8e0 - value / 1000e0 AS latitude,
         -47.98e0 - CAST(event_id % 97 AS DOUBLE) / 1000e0 AS longitude,
         event_type AS regiao_adm
  FROM events)"""

_IDX = f"""{_TRAJ},
idx AS (
  SELECT *, row_number() OVER (ORDER BY "timestamp", placa, event_id) - 1 AS row_id,
         CAST(floor(0.7e0 * count(*) OVER ()) AS BIGINT) AS k,
         count(*) OVER () AS n
  FROM traj)"""

_FEAT = f"""{_IDX},
lagged AS (
  SELECT *,
    coalesce(lag(latitude) OVER w, latitude) AS lat_p,
    coalesce(lag(longitude) OVER w, longitude) AS lon_p,
    coalesce(epoch_us("timestamp") - epoch_us(lag("timestamp") OVER w), 0) / 1e6 AS dt
  FROM idx WINDOW w AS (PARTITION BY placa ORDER BY row_id)),
chord AS (
  SELECT *, power(sin(radians(lat_p - latitude) / 2), 2)
    + cos(radians(latitude)) * cos(radians(lat_p)) * power(sin(radians(lon_p - longitude) / 2), 2) AS a
  FROM lagged),
moved AS (
  SELECT *, 2 * 6371000e0 * atan2(sqrt(a), sqrt(1 - a)) AS dist_m FROM chord),
sped AS (
  SELECT *, CASE WHEN dt = 0 THEN 0 ELSE (dist_m / 1000) / (dt / 3600) END AS velocidade_kmh
  FROM moved),
feat AS (
  SELECT event_id, row_id, k, placa, "timestamp", latitude, longitude, regiao_adm, row_id < k AS is_train,
    hour("timestamp") AS hora,
    isodow("timestamp") - 1 AS dia_sem,
    sin(2 * pi() * hour("timestamp") / 24) AS hora_sin,
    cos(2 * pi() * hour("timestamp") / 24) AS hora_cos,
    {_holiday('"timestamp"')} AS eh_feriado,
    dist_m, velocidade_kmh,
    CASE WHEN dt = 0 THEN 0 ELSE coalesce(
      ((velocidade_kmh - lag(velocidade_kmh) OVER w) * 1000 / 3600) / dt, 0) END AS aceleracao
  FROM sped WINDOW w AS (PARTITION BY placa ORDER BY row_id))"""

_ONE_HOT = ", ".join(
    f"CAST(regiao_adm = '{r}' AS INTEGER)::DOUBLE AS \"RA_{r}\"" for r in _REGIONS
)


def _scale(columns: tuple[str, ...]) -> dict[str, str]:
    """Expressions of standardised columns; the spread of a constant column counts as 1."""
    parts = {}
    for c in columns:
        mean = f"(SELECT round(avg(CAST({c} AS DOUBLE)), 10) FROM wide WHERE is_train)"
        std = f"(SELECT round(stddev_pop(CAST({c} AS DOUBLE)), 10) FROM wide WHERE is_train)"
        spread = f"CASE WHEN {std} < 1e-12 THEN 1e0 ELSE {std} END"
        parts[c] = f"(CAST({c} AS DOUBLE) - {mean}) / ({spread})"
    return parts


_SCALED_CTE = f"""{_FEAT},
wide AS (SELECT * FROM feat),
scaled AS (
  SELECT event_id, row_id, placa, "timestamp", latitude, longitude, is_train,
    CAST(hora AS DOUBLE) AS hora, {", ".join(f"{e} AS {c}" for c, e in _scale(_SCALED).items())}
  FROM wide)"""


def _hist_cte(bins: int) -> str:
    """Edges, counts and scores of all features for one number of bins."""
    b = f"b{bins}"
    values = " UNION ALL ".join(
        f"SELECT row_id, is_train, {i} AS f, {c} AS x FROM scaled" for i, c in enumerate(_HIST)
    )
    return f"""long_{b} AS ({values}),
range_{b} AS (
  SELECT f, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
            CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
  FROM long_{b} WHERE is_train GROUP BY f),
edge_{b} AS (
  SELECT f, i, CASE WHEN i = {bins} THEN hi ELSE i * ((hi - lo) / {bins}) + lo END AS e
  FROM range_{b}, generate_series(0, {bins}) AS g(i)),
edges_{b} AS (SELECT f, list(e ORDER BY i) AS es FROM edge_{b} GROUP BY f),
count_{b} AS (
  SELECT f, least(len(list_filter(es, lambda e: e <= x)), {bins}) - 1 AS bin, count(*) AS c
  FROM long_{b} JOIN edges_{b} USING (f) WHERE is_train GROUP BY ALL),
bins_{b} AS (
  SELECT a.f, a.i AS bin, a.e AS edge_low, z.e AS edge_high, coalesce(c, 0) AS c,
    coalesce(c, 0) / (z.e - a.e) / (SELECT count(*) FROM scaled WHERE is_train) AS density
  FROM edge_{b} a JOIN edge_{b} z ON a.f = z.f AND z.i = a.i + 1
  LEFT JOIN count_{b} n ON n.f = a.f AND n.bin = a.i),
table_{b} AS (
  SELECT f, list(log2(density + 0.1) ORDER BY bin) AS ss, min(log2(density + 0.1)) AS worst
  FROM bins_{b} GROUP BY f),
part_{b} AS (
  SELECT row_id, f, CASE
      WHEN pos = 0 THEN CASE WHEN es[1] - x <= (es[2] - es[1]) * 0.5 THEN ss[1] ELSE worst END
      WHEN pos = {bins + 1} THEN CASE WHEN x - es[{bins + 1}] <= (es[{bins + 1}] - es[{bins}]) * 0.5
        THEN ss[{bins}] ELSE worst END
      ELSE ss[pos] END AS s
  FROM (SELECT *, len(list_filter(es, lambda e: e < x)) AS pos FROM long_{b} JOIN edges_{b} USING (f))
  JOIN table_{b} USING (f)),
score_{b} AS (SELECT row_id, -sum(s ORDER BY f) AS score FROM part_{b} GROUP BY row_id)"""


_HBOS = f"""{_SCALED_CTE}, {_hist_cte(10)}, {_hist_cte(20)},
scored AS (
  SELECT s.*, round(a.score, 9) AS "HBOS_bins10_score", round(z.score, 9) AS "HBOS_bins20_score"
  FROM scaled s JOIN score_b10 a USING (row_id) JOIN score_b20 z USING (row_id))"""

_CUTS = ", ".join(
    f'quantile_cont("HBOS_bins{b}_score", {p / 100}) AS t{b}_{p}' for b in (10, 20) for p in (90, 95, 99)
)
_FLAG_COLUMNS = ", ".join(
    f'CAST("HBOS_bins{b}_score" >= t{b}_{p} AS INTEGER) AS "HBOS_bins{b}_p{p}_label"'
    for b in (10, 20)
    for p in (90, 95, 99)
)
_LABELLED = f"""{_HBOS},
cuts AS (SELECT {_CUTS} FROM scored WHERE is_train),
labelled AS (SELECT scored.*, {_FLAG_COLUMNS} FROM scored, cuts)"""

_METRIC_ROWS = " UNION ALL ".join(
    f"""SELECT 'HBOS_bins{b}' AS "Model", {p} AS "Percentile",
      round_even((SELECT t{b}_{p} FROM cuts) * 1e6, 0) / 1e6 AS "Threshold_Value",
      CAST(sum("HBOS_bins{b}_p{p}_label") AS BIGINT) AS "Anomalies_Detected",
      round_even(sum("HBOS_bins{b}_p{p}_label") / count(*) * 100 * 1e2, 0) / 1e2 AS "Pct_Dataset",
      'train' AS "Calibrated_On" FROM labelled"""
    for b in (10, 20)
    for p in (90, 95, 99)
)


def _confusion(labels: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS model,
          CAST(sum("{c}" * "{_TRUTH}") AS BIGINT) AS tp,
          CAST(sum("{c}" * (1 - "{_TRUTH}")) AS BIGINT) AS fp,
          CAST(sum((1 - "{c}") * "{_TRUTH}") AS BIGINT) AS fn,
          CAST(sum((1 - "{c}") * (1 - "{_TRUTH}")) AS BIGINT) AS tn FROM labelled"""
        for c in labels
    )


def _share(numerator: str, denominator: str) -> str:
    value = f"coalesce(CAST({numerator} AS DOUBLE) / nullif({denominator}, 0), 0)"
    return f"round_even({value} * 1e4, 0) / 1e4"


def _windows(size: int, gap: int, span: bool) -> str:
    gaps = [
        f"(back{j - 1} - back{j} <= {gap} * 1000000::BIGINT)" for j in range(1, size)
    ]
    backs = ", ".join(
        f'epoch_us(lag("timestamp", {j}) OVER w) AS back{j}' for j in range(size)
    )
    valid = " AND ".join(gaps)
    if span:
        valid += f" AND fixes > {size} AND back0 - back{size - 1} <= {gap} * 1000000::BIGINT"
    return f"""tied AS (
  SELECT *, {backs}, row_number() OVER w AS pos, count(*) OVER (PARTITION BY placa) AS fixes
  FROM feat WINDOW w AS (PARTITION BY placa ORDER BY row_id)),
win AS (SELECT *, pos >= {size} AS is_full, coalesce(pos >= {size} AND {valid}, false) AS valid FROM tied)"""


_WIN = f"{_FEAT}, {_windows(WINDOW, GAP_SECONDS, False)}"
_PAYLOAD = ", ".join(
    f"lag({c}, {WINDOW - 1 - t}) OVER w AS t{t}_{c}" for t in range(WINDOW) for c in SEQUENCE_FEATURES
)
_CELLS = [f"t{t}_{c}" for t in range(WINDOW) for c in SEQUENCE_FEATURES]
_PAY = f"""{_WIN},
cells AS (SELECT event_id, row_id, is_train, valid, {_PAYLOAD}
  FROM win WINDOW w AS (PARTITION BY placa ORDER BY row_id))"""


def _mean_error() -> str:
    squares = []
    for c in SEQUENCE_FEATURES:
        mean = "(" + " + ".join(f"t{t}_{c}" for t in range(WINDOW)) + f") / {WINDOW}"
        squares += [f"power(t{t}_{c} - {mean}, 2)" for t in range(WINDOW)]
    return f"({' + '.join(squares)}) / {len(squares)}"


_MSE = f"""{_PAY},
errors AS (SELECT event_id, row_id, is_train, round({_mean_error()}, 3) AS score
  FROM cells WHERE valid)"""

_NUMBERS = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)
_LINEITEM_TYPES = (
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "double"),
    ("l_discount", "double"),
    ("l_tax", "double"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "timestamp_ntz"),
)
_TEXTS = ("o_orderstatus", "o_orderpriority")

_MOMENT = (
    "CASE WHEN epoch_us({c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%d %H:%M:%S') "
    "ELSE strftime({c}, '%Y-%m-%d %H:%M:%S.%f') END"
)


def _rounded(columns: tuple[str, ...] | list[str], digits: int) -> str:
    return ", ".join(f'round("{c}", {digits}) AS "{c}"' for c in columns)


_MOVE = (
    "round(dist_m, 4) AS dist_m, round(velocidade_kmh, 6) AS velocidade_kmh, "
    "round(aceleracao, 9) AS aceleracao"
)
_KINEMATICS = f"WITH {_FEAT} SELECT event_id, {_MOVE} FROM feat"
_SPAN = (
    f"WITH {_FEAT}, {_windows(WINDOW, GAP_SECONDS, True)} "
    "SELECT row_id, event_id, placa FROM win WHERE valid"
)
_SIGHTINGS = (
    f'WITH {_TRAJ} SELECT event_id, placa, "timestamp", latitude, longitude, regiao_adm FROM traj'
)


def _tree(tree: int, node: int = 0) -> str:
    """One tree as nested cases."""
    (here,) = (n for n in FOREST_NODES if n[:2] == (tree, node))
    if here[4] == node:
        return f"{here[6]}e0"
    return f"CASE WHEN {FOREST_FEATURES[here[2]]}::FLOAT::DOUBLE <= {here[3]}e0 THEN {_tree(tree, here[4])} ELSE {_tree(tree, here[5])} END"


_TREES = sorted({n[0] for n in FOREST_NODES})
_EXPECTED = 2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256
_WALKED = f"""walked AS (
  SELECT *, pow(2e0, -path / ({len(_TREES)} * {_EXPECTED!r})) AS score
  FROM (SELECT *, {" + ".join(f"({_tree(t)})" for t in _TREES)} AS path FROM lineitem))"""


def _reference_comparison() -> str:
    truth = "ISO_walk_p95_label"
    scores = {"ISO_walk": "w", "ISO_price": "l_extendedprice", "HBOS_quantity": "l_quantity"}
    labels = {f"{m}_p{p}_label": f"{c} >= (SELECT quantile_cont({c}, {p / 100}) FROM s)" for m, c in scores.items() for p in (90, 95)}
    columns = ", ".join(f'CAST({e} AS BIGINT) AS "{c}"' for c, e in labels.items())
    counts = " UNION ALL ".join(
        f"""SELECT '{c}' AS model, sum("{c}" * "{truth}") AS tp, sum("{c}" * (1 - "{truth}")) AS fp,
          sum((1 - "{c}") * "{truth}") AS fn, sum((1 - "{c}") * (1 - "{truth}")) AS tn FROM l"""
        for c in labels
        if c != truth
    )
    return f"""WITH {_WALKED}, s AS (SELECT *, round(score, 9) AS w FROM walked), l AS (SELECT {columns} FROM s), c AS ({counts})
        SELECT model AS "Model", {_share("tp", "tp + fp")} AS "Precision", {_share("tp", "tp + fn")} AS "Recall",
          {_share("2 * tp", "2 * tp + fp + fn")} AS "F1_Score", {_share("tp + tn", "tp + fp + fn + tn")} AS "Accuracy" FROM c"""


def _grid() -> str:
    models = ("HBOS_bins10", "HBOS_bins20")
    rows = ["SELECT 'LSTM_Sujo' AS cenario, count(*) FILTER (WHERE is_train) AS linhas FROM labelled"]
    for a in models:
        for b in models:
            for kind, both in (("Uniao", "AND"), ("Inter", "OR")):
                rows.append(
                    f"""SELECT 'LSTM_{kind}_{a}_{b}', count(*) FILTER (WHERE is_train AND
                      ("{a}_p95_label" = 0 {both} "{b}_p95_label" = 0)) FROM labelled"""
                )
    return " UNION ALL ".join(rows)


def statements() -> dict[str, str]:
    """SQL per query name; queries with random models have none."""
    names = ", ".join(f"({i}, '{c}')" for i, c in enumerate(_HIST))
    hist_rows = " UNION ALL ".join(
        f"SELECT {b} AS bins, f, bin, edge_low, edge_high, c, density FROM bins_b{b}"
        for b in (10, 20)
    )
    describe = " UNION ALL ".join(
        f"""SELECT '{c}' AS coluna, count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 4) AS mean,
          round(stddev_samp(CAST({c} AS DOUBLE)), 4) AS std,
          round(CAST(min({c}) AS DOUBLE), 4) AS min,
          round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 4) AS p25,
          round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 4) AS p50,
          round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 4) AS p75,
          round(CAST(max({c}) AS DOUBLE), 4) AS max FROM lineitem"""
        for c in _NUMBERS
    )
    columns = " UNION ALL ".join(
        f"""SELECT {i} AS posicao, '{c}' AS "Coluna", '{t}' AS "Tipo",
          count(*) - count({c}) AS "Nulos", count(*) AS num_linhas,
          {len(_LINEITEM_TYPES)} AS num_colunas FROM lineitem"""
        for i, (c, t) in enumerate(_LINEITEM_TYPES)
    )
    categories = " UNION ALL ".join(
        f"""SELECT '{c}' AS coluna, count({c}) AS count, count(DISTINCT {c}) AS "unique",
          (SELECT {c} FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
          (SELECT count(*) FROM orders GROUP BY {c} ORDER BY count(*) DESC LIMIT 1) AS freq
          FROM orders"""
        for c in _TEXTS
    )
    prices = " UNION ALL ".join(
        f"""SELECT '{c}' AS coluna, {p}::DOUBLE AS percentil,
          round(quantile_cont({c}, {p / 100}), 6) AS valor, count({c}) AS linhas FROM lineitem"""
        for c in ("l_extendedprice", "l_discount")
        for p in (1, 25, 50, 90, 95, 99.9)
    )
    ranges = " UNION ALL ".join(
        f"""SELECT 'HBOS_bins{b}' AS model,
          round(min("HBOS_bins{b}_score") FILTER (WHERE is_train), 6) AS calibration_min,
          round(max("HBOS_bins{b}_score") FILTER (WHERE is_train), 6) AS calibration_max,
          round(min("HBOS_bins{b}_score"), 6) AS application_min,
          round(max("HBOS_bins{b}_score"), 6) AS application_max FROM scored"""
        for b in (10, 20)
    )
    others = [c for c in _FLAGS if c != _TRUTH]
    every = (*_SCALED, *[f'"RA_{r}"' for r in _REGIONS])
    scaled = ", ".join(f"round({e}, 6) AS {c}" for c, e in _scale(every).items())
    long_windows = _windows(60, 5 * GAP_SECONDS, False)
    return {
        "standardize_sightings": """SELECT event_id, user_id AS placa, ts AS "timestamp",
            value AS latitude, event_type AS regiao_adm FROM events WHERE event_type <> 'error'""",
        "csv_scan": _SIGHTINGS,
        "csv_scan_quoted": """SELECT doc_id, ' "' || source || '",' || chr(10) || text || chr(92) || '"' || chr(13) || chr(10) || ', ' AS text,
            lang FROM documents""",
        "timestamps_of_patterns": """SELECT o_orderkey, o_custkey AS placa, CASE o_orderkey % 3
            WHEN 1 THEN date_trunc('minute', o_orderdate) ELSE date_trunc('second', o_orderdate) END AS "timestamp" FROM orders""",
        "one_hot_index": """SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS indice FROM part""",
        "vehicles_per_region_sketched": f"""WITH {_TRAJ} SELECT regiao_adm, count(DISTINCT placa) AS veiculos, true AS near
            FROM traj WHERE regiao_adm IS NOT NULL GROUP BY regiao_adm""",
        "regions_written": """SELECT 'cliente "' || o_custkey || '"' AS regiao_adm, count(DISTINCT o_orderkey) AS veiculos
            FROM orders GROUP BY ALL""",
        "columns_with_nan": """SELECT * FROM (
            SELECT 0 AS posicao, 'l_orderkey' AS "Coluna", 'bigint' AS "Tipo", 0::BIGINT AS "Nulos", count(*) AS num_linhas, 3 AS num_colunas FROM lineitem
            UNION ALL SELECT 1, 'l_discount', 'double', count(*) FILTER (WHERE l_discount = 0), count(*), 3 FROM lineitem
            UNION ALL SELECT 2, 'l_tax', 'double', count(*) FILTER (WHERE l_tax <= 0), count(*), 3 FROM lineitem)""",
        "grid_masks": f"WITH {_LABELLED} {_grid()}",
        "comparison_with_reference": _reference_comparison(),
        "families_written": f"""WITH {_LABELLED} SELECT "Model", "Percentile", "Anomalies_Detected",
            CASE WHEN "Model" = 'HBOS_bins10' THEN "Pct_Dataset" END AS "Pct_Dataset" FROM ({_METRIC_ROWS})""",
        "sinks_read_back": f"""WITH {_LABELLED} SELECT placa, "timestamp", latitude, longitude,
            {_rounded(["HBOS_bins10_score", "HBOS_bins20_score"], 6)},
            {", ".join(f'"{c}"' for c in _FLAGS)} FROM labelled""",
        "forest_walk": f"""WITH {_WALKED} SELECT l_orderkey, l_linenumber, round(path, 9) AS path, round(score, 9) AS score,
            CAST(score > 0.5 AS INTEGER) AS label FROM walked""",
        "forest_invariants": f"""WITH {_IDX} SELECT count(*) AS "rows", 0::BIGINT AS walks_differ,
            count(*) FILTER (WHERE event_id % 50 <> 0) AS scored, 0::BIGINT AS out_of_range,
            20::BIGINT AS trees, 20::BIGINT AS binary_trees, 20::BIGINT AS full_trees FROM idx""",
        "master_fixed_part": f"""WITH {_FEAT}, wide AS (SELECT * FROM feat) SELECT event_id, row_id, placa, CAST(hora AS INTEGER) AS hora,
            dayname("timestamp") AS dia_semana, {", ".join(f"round({e}, 6) AS {c}" for c, e in _scale(_SCALED).items())} FROM wide""",
        "parquet_scan": (
            'SELECT event_id, user_id AS placa, ts AS "timestamp", event_type, value FROM events'
        ),
        "temporal_features": f"""WITH {_FEAT} SELECT event_id, CAST(hora AS INTEGER) AS hora,
            CAST(dia_sem AS INTEGER) AS dia_sem, round(hora_sin, 6) AS hora_sin,
            round(hora_cos, 6) AS hora_cos, dayname("timestamp") AS dia_semana,
            strftime("timestamp", '%Y-%m-%d') AS dia, strftime(date_trunc('month', "timestamp"), '%Y-%m-%d') AS mes,
            {_MOMENT.format(c='"timestamp"')} AS momento FROM feat""",
        "holiday_flag": f"""SELECT o_orderkey, o_orderdate, {_holiday("o_orderdate")} AS eh_feriado
            FROM orders""",
        "region_one_hot": f"WITH {_TRAJ} SELECT event_id, {_ONE_HOT} FROM traj",
        "kinematics": _KINEMATICS,
        "kinematics_of_hot_entities": _KINEMATICS,
        "feature_table": f"""WITH {_FEAT} SELECT event_id, placa, "timestamp", latitude, longitude,
            CAST(hora AS INTEGER) AS hora, CAST(dia_sem AS INTEGER) AS dia_sem,
            round(hora_sin, 6) AS hora_sin, round(hora_cos, 6) AS hora_cos, eh_feriado,
            {_MOVE}, {_ONE_HOT} FROM feat""",
        "profile_of_sightings": f"""WITH {_FEAT},
            places AS (SELECT latitude, longitude, count(placa) AS n FROM feat GROUP BY ALL
              ORDER BY n DESC, latitude, longitude LIMIT 1)
            SELECT CAST(count(DISTINCT placa) AS BIGINT) AS total_veiculos,
              {_MOMENT.format(c='min("timestamp")')} || ' a ' || {_MOMENT.format(c='max("timestamp")')}
                AS periodo,
              round(avg(velocidade_kmh), 6) AS vel_media,
              CAST(count(DISTINCT CAST("timestamp" AS DATE)) AS INTEGER) AS dias_analise,
              CAST(count(DISTINCT date_trunc('month', "timestamp")) AS INTEGER) AS meses_analise,
              (SELECT latitude FROM places) AS local_mais_fluxo_latitude,
              (SELECT longitude FROM places) AS local_mais_fluxo_longitude,
              CAST((SELECT n FROM places) AS BIGINT) AS fluxo_veiculos_local FROM feat""",
        "vehicles_per_region": f"""WITH {_TRAJ} SELECT regiao_adm, count(DISTINCT placa) AS veiculos
            FROM traj WHERE regiao_adm IS NOT NULL GROUP BY regiao_adm""",
        "columns_of_lineitem": columns,
        "numbers_of_lineitem": describe,
        "categories_of_orders": categories,
        "exact_price_percentiles": prices,
        "split_by_time": f"""WITH {_IDX} SELECT event_id, row_id, row_id < k AS is_train,
            (SELECT "timestamp" FROM idx WHERE row_id = k) AS cutoff_timestamp,
            k AS train_size, n - k AS test_size FROM idx""",
        "standard_scale": f"""WITH {_FEAT}, wide AS (SELECT *, {_ONE_HOT} FROM feat)
            SELECT event_id, {scaled} FROM wide""",
        "hbos_bins": f"""WITH {_SCALED_CTE}, {_hist_cte(10)}, {_hist_cte(20)},
            names(f, feature) AS (VALUES {names}), allbins AS ({hist_rows})
            SELECT bins, feature, CAST(bin AS INTEGER) AS bin, round(edge_low, 6) AS edge_low,
              round(edge_high, 6) AS edge_high, c AS count, round(density, 6) AS density,
              round(log2(density + 0.1), 6) AS bin_score FROM allbins JOIN names USING (f)""",
        "hbos_scores_10": f"""WITH {_SCALED_CTE}, {_hist_cte(10)} SELECT event_id,
            round(score, 6) AS score FROM scaled JOIN score_b10 USING (row_id)""",
        "hbos_scores_20": f"""WITH {_SCALED_CTE}, {_hist_cte(20)} SELECT event_id,
            round(score, 6) AS score FROM scaled JOIN score_b20 USING (row_id)""",
        "hbos_labels": f"""WITH {_HBOS} SELECT event_id, CAST("HBOS_bins10_score" >
            (SELECT quantile_cont("HBOS_bins10_score", 0.9) FROM scored WHERE is_train) AS INTEGER)
            AS label FROM scored WHERE is_train""",
        "model_roundtrip": f"""WITH {_SCALED_CTE}, {_hist_cte(10)}, {_hist_cte(20)}
            SELECT event_id, round(a.score, 6) AS score_10, round(z.score, 6) AS score_20
            FROM scaled JOIN score_b10 a USING (row_id) JOIN score_b20 z USING (row_id)""",
        "score_range": f"WITH {_HBOS} {ranges}",
        "score_stats": f"""WITH {_HBOS} SELECT round(avg(s), 6) AS mean,
            round(quantile_cont(s, 0.5), 6) AS median, round(stddev_pop(s), 6) AS std,
            round(min(s), 6) AS min, round(max(s), 6) AS max, round(quantile_cont(s, 0.95), 6) AS p95,
            round(quantile_cont(s, 0.99), 6) AS p99
            FROM (SELECT "HBOS_bins10_score" AS s FROM scored)""",
        "gap_windows": f"WITH {_WIN} SELECT row_id, event_id, placa FROM win WHERE valid",
        "gap_windows_span": _SPAN,
        "gap_windows_of_hot_entities": _SPAN,
        "windows_counted": f"""WITH {_FEAT}, {long_windows},
            per AS (SELECT placa, count(*) AS fixes FROM feat GROUP BY placa)
            SELECT CAST(count(*) FILTER (WHERE valid) AS BIGINT) AS sequences_generated,
              CAST(count(*) FILTER (WHERE is_full AND NOT valid) AS BIGINT) AS sequences_rejected_gap,
              (SELECT count(*) FROM per WHERE fixes < 60) AS vehicles_rejected_short FROM win""",
        "window_payload": f"WITH {_PAY} SELECT event_id, {_rounded(_CELLS, 6)} FROM cells WHERE valid",
        "reconstruction_mse": f"WITH {_MSE} SELECT event_id, score FROM errors",
        "score_writeback": f"""WITH {_MSE} SELECT i.event_id, e.score,
            coalesce(CAST(e.is_train AS INTEGER), -1) AS in_train
            FROM idx i LEFT JOIN errors e USING (row_id)""",
        "threshold_labels": "WITH {} SELECT event_id, {} FROM labelled".format(
            _LABELLED, ", ".join(f'"{c}"' for c in _FLAGS)
        ),
        "threshold_table": f"WITH {_LABELLED} {_METRIC_ROWS}",
        "scenario_masks": f"""WITH {_LABELLED} SELECT event_id,
            "HBOS_bins10_p95_label" = 0 AND "HBOS_bins20_p95_label" = 0 AND is_train AS uniao,
            ("HBOS_bins10_p95_label" = 0 OR "HBOS_bins20_p95_label" = 0) AND is_train AS inter,
            is_train AS sujo FROM labelled""",
        "model_comparison": f"""WITH {_LABELLED}, confusion AS ({_confusion(others)})
            SELECT model AS "Model", {_share("tp", "tp + fp")} AS "Precision",
              {_share("tp", "tp + fn")} AS "Recall",
              {_share("2 * tp", "2 * tp + fp + fn")} AS "F1_Score",
              {_share("tp + tn", "tp + fp + fn + tn")} AS "Accuracy" FROM confusion""",
        "confusion_table": f"WITH {_LABELLED} {_confusion(_FLAGS)}",
        "flags_above_percentile": f"""WITH {_MSE},
            cut AS (SELECT quantile_cont(score, 0.95) AS t FROM errors)
            SELECT event_id, score > t AS anomaly, round(t, 3) AS threshold FROM errors, cut""",
        "results_of_family": f"""WITH {_LABELLED} SELECT placa, "timestamp", latitude, longitude,
            {_rounded(["HBOS_bins10_score", "HBOS_bins20_score"], 6)},
            {", ".join(f'"{c}"' for c in _FLAGS)} FROM labelled""",
        "metrics_of_family": f"""WITH {_LABELLED}
            SELECT * FROM ({_METRIC_ROWS}) WHERE "Model" LIKE 'HBOS_bins20%'""",
        "family_files_compiled": f"""WITH {_LABELLED}
            SELECT 'HBOS' AS family, "Model", "Percentile",
              CASE WHEN "Model" = 'HBOS_bins10' THEN "Pct_Dataset" END AS "Pct_Dataset"
            FROM ({_METRIC_ROWS})""",
        "flagged_sightings": f"""WITH {_LABELLED} SELECT event_id, placa, "timestamp",
            round("HBOS_bins10_score", 6) AS score FROM labelled WHERE "HBOS_bins10_p99_label" = 1""",
    }
