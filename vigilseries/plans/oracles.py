"""The same answers in plain SQL, for checking the catalog on another engine."""

from __future__ import annotations

from itertools import combinations

from vigilseries.plans.tables import EVENT_ANOMALY, EVENT_METRIC, HIGH
from vigilseries.sources.files import METRICS

ORACLES: dict[str, str] = {}


def r(expr: str, name: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"


def i(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def cols(parts) -> str:
    return ",\n  ".join(parts)


_type = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{a}'" for e, a in EVENT_ANOMALY.items()) + " END"
TELE = f"""tele AS (SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS row_idx,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS user_idx, event_id, user_id, ts, event_type, value,
  {cols(f"CASE WHEN event_type = '{e}' THEN value END AS {m}" for e, m in EVENT_METRIC.items())},
  CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS cpu_util_pct,
  CASE WHEN value > {HIGH} THEN 1 ELSE 0 END AS is_anomaly,
  CASE WHEN value > {HIGH} THEN {_type} ELSE 'none' END AS anomaly_type FROM events)"""


def imputed(part: str = "", idx: str = "row_idx", metrics=METRICS) -> str:
    over = f"PARTITION BY {part} " if part else ""
    prev = f"OVER ({over}ORDER BY {idx} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    foll = f"OVER ({over}ORDER BY {idx} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    near = cols(
        f"last_value({m} IGNORE NULLS) {prev} AS pv_{m}, last_value(CASE WHEN {m} IS NOT NULL THEN {idx} END IGNORE NULLS) {prev} AS pi_{m}, "
        f"first_value({m} IGNORE NULLS) {foll} AS fv_{m}, first_value(CASE WHEN {m} IS NOT NULL THEN {idx} END IGNORE NULLS) {foll} AS fi_{m}"
        for m in metrics)
    value = cols(
        f"CASE WHEN {m} IS NOT NULL THEN {m} WHEN pi_{m} IS NOT NULL AND fi_{m} IS NOT NULL "
        f"THEN pv_{m} + (fv_{m} - pv_{m}) / (fi_{m} - pi_{m}) * ({idx} - pi_{m}) ELSE coalesce(pv_{m}, fv_{m}) END AS {m}" for m in metrics)
    return f"""near AS (SELECT *, {near} FROM tele),
imp AS (SELECT row_idx, user_idx, event_id, user_id, ts, is_anomaly, anomaly_type, {value} FROM near)"""


CLEAN = f"""{TELE}, {imputed()},
clean AS (SELECT row_idx, event_id, user_id, ts, is_anomaly, anomaly_type, {cols(f"floor({m} * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE AS {m}" for m in METRICS)} FROM imp)"""
SPLIT_CASE = ("CASE WHEN {i} < floor({n} * 0.7::DOUBLE) THEN 'train' WHEN {i} < floor({n} * 0.7::DOUBLE) + floor({n} * 0.15::DOUBLE) "
              "THEN 'val' ELSE 'test' END")
SPLIT = f"""{CLEAN}, split AS (SELECT *, {SPLIT_CASE.format(i="row_idx", n="count(*) OVER ()")} AS split FROM clean)"""
SCALER = "scaler AS (SELECT " + cols(f"avg({m}) AS mu_{m}, CASE WHEN stddev_pop({m}) > 0 THEN stddev_pop({m}) ELSE 1.0 END AS sd_{m}" for m in METRICS) + " FROM split WHERE split = 'train')"
SCORED = """scored AS (SELECT event_id, event_type, value, value / (value + 50.0::DOUBLE) AS score,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label, CASE WHEN value / (value + 50.0::DOUBLE) >= 0.6::DOUBLE THEN 1 ELSE 0 END AS pred FROM events)"""
RAW = cols(r(m, m) for m in METRICS)


def long(source: str, keep: str) -> str:
    return " UNION ALL ".join(f"SELECT {keep}, '{m}' AS metric, {m} AS value FROM {source}" for m in METRICS)


# --- sources and sinks ---
ORACLES["read_telemetry_csv"] = f"""WITH {TELE} SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, {RAW},
  {i('is_anomaly', 'is_anomaly')}, anomaly_type FROM tele"""
ORACLES["write_csv"] = f"SELECT event_id, event_type, {r('value', 'value')} FROM events"

_auc = """auc AS (SELECT (sum(CASE WHEN label = 1 THEN lower_neg + same_neg / 2.0 END)) / (sum(label) * sum(1 - label)) AS roc_auc FROM (
  SELECT label, sum(1 - label) OVER (ORDER BY score RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sum(1 - label) OVER (PARTITION BY score) AS lower_neg,
  sum(1 - label) OVER (PARTITION BY score) AS same_neg FROM scored))"""


def _prf(cut: str) -> str:
    return (f"sum(CASE WHEN label = 1 AND {cut} THEN 1 ELSE 0 END)::DOUBLE AS tp, sum(CASE WHEN label = 0 AND {cut} THEN 1 ELSE 0 END)::DOUBLE AS fp, "
            f"sum(CASE WHEN label = 1 AND NOT {cut} THEN 1 ELSE 0 END)::DOUBLE AS fn")


P, R_, F1 = ("CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END", "CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END",
             "CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END")
_models = " UNION ALL ".join(f"SELECT '{n}' AS model, {_prf(f'score >= {c}::DOUBLE')} FROM scored" for n, c in (("strict", 0.7), ("even", 0.5), ("loose", 0.2)))
ORACLES["leaderboard"] = ORACLES["write_leaderboard"] = f"""WITH {SCORED}, {_auc}, models AS ({_models})
SELECT model AS "Model", {r(P, '"Precision"', 4)}, {r(R_, '"Recall"', 4)}, {r(F1, '"F1"', 4)}, {r('roc_auc', '"ROC_AUC"', 4)} FROM models, auc"""
ORACLES["save_scaler"] = f"WITH {SPLIT}, {SCALER} " + " UNION ALL ".join(
    f"SELECT '{m}' AS feature, {r(f'mu_{m}', 'mean')}, {r(f'sd_{m}', 'scale')} FROM scaler" for m in METRICS)
_scaled = cols(r(f"({m} - mu_{m}) / sd_{m}", m) for m in METRICS)
ORACLES["load_scaler"] = f"WITH {SPLIT}, {SCALER} SELECT event_id, {_scaled} FROM split, scaler WHERE split = 'test'"
ORACLES["standard_scale"] = f"WITH {SPLIT}, {SCALER} SELECT event_id, split, {_scaled} FROM split, scaler"

VECTORS = """vectors AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, CASE WHEN label = 0 THEN 'normal' ELSE 'cause_' || label END AS category,
  'log line ' || vec_id AS log_text, 'S' || label AS severity, 'E' || label AS error_code FROM embeddings)"""
ORACLES["store_embeddings"] = f"""WITH {VECTORS} SELECT 'log_' || (row_number() OVER (ORDER BY id) - 1) AS id, log_text AS document, category, severity, error_code,
  {i('len(e)', 'dim')}, {r('list_dot_product(e, e)', 'sq_norm')} FROM vectors"""
ORACLES["run_log"] = f"""WITH {TELE} SELECT 'summary' AS run_id, 'rows' AS metric, {r('count(*)', 'value')}, {i('0', 'step')} FROM tele
UNION ALL SELECT 'summary', 'anomalies', {r('sum(is_anomaly)', 'value')}, {i('1', 'step')} FROM tele"""

# --- projections, filters, scalars ---
ORACLES["feature_columns"] = f"WITH {TELE} SELECT event_id, {RAW} FROM tele"
ORACLES["filter_class"] = f"WITH {TELE} SELECT event_id, {r('latency_ms', 'latency_ms')} FROM tele WHERE is_anomaly = 1 AND latency_ms IS NOT NULL"
ORACLES["drop_warmup"] = f"WITH {TELE} SELECT event_id, {i('row_idx - 30', 'row_idx')} FROM tele WHERE row_idx >= 30"
ORACLES["drop_warmup_by_user"] = f"WITH {TELE} SELECT event_id, user_id, {i('user_idx - 30', 'row_idx')} FROM tele WHERE user_idx >= 30"
ORACLES["head_rows"] = f"WITH {TELE} SELECT event_id, {r('cpu_util_pct', 'cpu_util_pct')} FROM tele ORDER BY ts, event_id LIMIT 500"
_category = """CASE WHEN is_anomaly = 0 THEN 'normal' ELSE CASE anomaly_type WHEN 'latency_spike' THEN 'timeout' WHEN 'packet_loss_burst' THEN 'packet_loss'
  WHEN 'throughput_drop' THEN 'congestion' WHEN 'handover_storm' THEN 'handover_fail' ELSE 'normal' END END AS category"""
ORACLES["category_map"] = f"WITH {TELE} SELECT event_id, {_category} FROM tele"
ORACLES["category_counts"] = f"WITH {TELE}, c AS (SELECT {_category} FROM tele) SELECT category, {i('count(*)', 'count')} FROM c GROUP BY category"
ORACLES["binarize_score"] = f"WITH {SCORED} SELECT event_id, {i('CASE WHEN score >= 0.5::DOUBLE THEN 1 ELSE 0 END', 'flag')} FROM scored"
ORACLES["sigmoid"] = f"SELECT event_id, {r('1.0 / (1.0 + exp(-((value - 50.0) / 25.0)))', 'p')} FROM events"
ORACLES["round4"] = f"WITH {SCORED} SELECT event_id, {r('score', 'score', 4)} FROM scored"
ORACLES["truncate_doc"] = "SELECT doc_id, substring(text, 1, 200) AS document FROM documents"
_line = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || ' | ' || upper(event_type) || ' | EV_' || event_id || ' | ' || props"
ORACLES["log_line_format"] = f"SELECT event_id, {_line} AS log_text FROM events"
ORACLES["log_line_parse"] = f"""SELECT event_id, {i('0', 'broken')}, strftime(ts, '%Y-%m-%d %H:%M:%S') AS log_ts, upper(event_type) AS severity,
  'EV_' || event_id AS error_code, props AS message FROM events
UNION ALL SELECT event_id, {i('1', 'broken')}, NULL, NULL, NULL, NULL FROM events"""
ORACLES["time_parts"] = f"SELECT event_id, {i('hour(ts)', 'hour')}, {i('isodow(ts) - 1', 'weekday')}, dayname(ts) AS day_name FROM events"
ORACLES["time_features"] = f"""SELECT event_id, {r('sin(2 * pi() * hour(ts) / 24)', 'hour_sin')}, {r('cos(2 * pi() * hour(ts) / 24)', 'hour_cos')},
  {r('sin(2 * pi() * (isodow(ts) - 1) / 7)', 'dow_sin')}, {r('cos(2 * pi() * (isodow(ts) - 1) / 7)', 'dow_cos')},
  {i('CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END', 'is_weekend')} FROM events"""

# --- missing data ---
ORACLES["missing_profile"] = f"WITH {TELE} " + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {i(f'count(*) - count({m})', 'missing')}, {r(f'(count(*) - count({m})) * 100.0 / count(*)', 'missing_pct')} FROM tele" for m in METRICS)
ORACLES["missing_mask"] = f"""WITH {TELE} SELECT event_id, {cols(i(f'CASE WHEN {m} IS NULL THEN 1 ELSE 0 END', m) for m in METRICS)}
FROM tele ORDER BY ts, event_id LIMIT 500"""
ORACLES["impute_linear"] = f"WITH {TELE}, {imputed()} SELECT event_id, {RAW} FROM imp"
ORACLES["impute_linear_by_user"] = f"WITH {TELE}, {imputed('user_id', 'user_idx')} SELECT event_id, {RAW} FROM imp"
ORACLES["impute_forward_linear"] = f"WITH {TELE}, {imputed()} SELECT event_id, {cols(r(m, m) for m in METRICS)} FROM imp"
_carried = cols(r(f"coalesce(last_value({m} IGNORE NULLS) OVER (ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0.0)", m) for m in METRICS)
ORACLES["ffill_zero"] = f"WITH {TELE} SELECT event_id, {_carried} FROM tele"
ORACLES["fill_stat_zero"] = f"""SELECT user_id, event_type, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {r('coalesce(stddev_samp(value), 0.0)', 'std')}
FROM events GROUP BY user_id, event_type, CAST(ts AS DATE)"""

# --- profiling ---
ORACLES["table_summary"] = f"""WITH {TELE} SELECT {i('count(*)', 'rows')}, {i('11', 'columns')}, {i('sum(is_anomaly)', 'anomalies')},
  {r('avg(is_anomaly)', 'anomaly_rate')} FROM tele"""
ORACLES["class_means"] = f"""WITH {TELE}, l AS ({long('tele', 'is_anomaly')})
SELECT {i('is_anomaly', 'is_anomaly')}, metric, {r('avg(value)', 'mean')} FROM l GROUP BY is_anomaly, metric"""
_facts = f"""l AS (SELECT * FROM ({long('tele', 'is_anomaly')}) WHERE value IS NOT NULL),
f AS (SELECT metric, is_anomaly, count(*)::DOUBLE AS n, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd FROM l GROUP BY metric, is_anomaly)"""
ORACLES["histogram"] = f"""WITH {TELE}, {_facts},
e AS (SELECT metric, is_anomaly, n, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi FROM f),
w AS (SELECT *, (hi - lo) / 60 AS width FROM e),
b AS (SELECT metric, is_anomaly, least(floor((value - lo) / width), 59) AS bin, count(*) AS c FROM l JOIN w USING (metric, is_anomaly) GROUP BY ALL),
s AS (SELECT w.*, bin FROM w, range(60) AS g(bin))
SELECT metric, {i('is_anomaly', 'is_anomaly')}, {i('bin', 'bin')}, {r('lo + bin * width', 'left_edge')}, {i('coalesce(c, 0)', 'count')},
  {r('coalesce(c, 0) / (n * width)', 'density')} FROM s LEFT JOIN b USING (metric, is_anomaly, bin)"""
ORACLES["kde"] = f"""WITH {TELE}, {_facts},
g AS (SELECT metric, is_anomaly, n, sd * n ** -0.2 AS h, point, lo + point * ((hi - lo) / 299) AS x FROM f, range(300) AS p(point) WHERE n > 10 AND sd > 0)
SELECT metric, {i('is_anomaly', 'is_anomaly')}, {i('point', 'point')}, {r('any_value(x)', 'x')},
  {r('sum(exp(-0.5 * ((x - value) / h) * ((x - value) / h))) / any_value(n * h * sqrt(2 * pi()))', 'density')}
FROM g JOIN l USING (metric, is_anomaly) GROUP BY metric, is_anomaly, point"""
_pairs = [(b, a) for a, b in combinations(METRICS, 2)] + list(combinations(METRICS, 2)) + [(m, m) for m in METRICS]
ORACLES["correlation_matrix"] = f"WITH {CLEAN} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r(f'corr({a}, {b})', 'r')} FROM clean" for a, b in _pairs)
ORACLES["anomaly_type_counts"] = f"WITH {TELE} SELECT anomaly_type, {i('count(*)', 'count')} FROM tele WHERE is_anomaly = 1 GROUP BY anomaly_type"
ORACLES["anomaly_day_hour_pivot"] = f"""WITH {TELE} SELECT {i('isodow(ts) - 1', 'day_no')}, dayname(ts) AS day,
  {cols(i(f'sum(CASE WHEN hour(ts) = {h} THEN 1 ELSE 0 END)', f'h{h:02d}') for h in range(24))} FROM tele WHERE is_anomaly = 1 GROUP BY isodow(ts), dayname(ts)"""
_plain_split = f"s AS (SELECT *, {SPLIT_CASE.format(i='row_idx', n='count(*) OVER ()')} AS split FROM tele)"
ORACLES["split_summary"] = f"WITH {TELE}, {_plain_split} SELECT split, {i('count(*)', 'rows')}, {r('avg(is_anomaly)', 'anomaly_rate')} FROM s GROUP BY split"
ORACLES["class_weight"] = f"""WITH {TELE} SELECT {i('sum(is_anomaly)', 'n_pos')}, {i('count(*) - sum(is_anomaly)', 'n_neg')},
  {r('(count(*) - sum(is_anomaly))::DOUBLE / greatest(sum(is_anomaly), 1)', 'pos_weight')} FROM tele"""


# --- windows ---
def rolling(metrics, over: str, digits: int = 6):
    for m in metrics:
        for w in (5, 15, 30):
            frame = f"OVER ({over} ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
            yield r(f"avg({m}) {frame}", f"{m}_mean_{w}", digits)
            yield r(f"coalesce(stddev_samp({m}) {frame}, 0.0)", f"{m}_std_{w}", digits)
            yield r(f"min({m}) {frame}", f"{m}_min_{w}", digits)
            yield r(f"max({m}) {frame}", f"{m}_max_{w}", digits)


def lags(metrics, over: str, digits: int = 6):
    return [r(f"lag({m}, {k}) OVER ({over})", f"{m}_lag_{k}", digits) for m in metrics for k in (1, 5, 15, 30)]


_by_row, _by_user = "ORDER BY row_idx", "PARTITION BY user_id ORDER BY user_idx"
ORACLES["rolling_stats"] = f"WITH {CLEAN} SELECT event_id, {cols(rolling(METRICS, _by_row))} FROM clean"
ORACLES["rolling_stats_by_user"] = f"WITH {TELE} SELECT event_id, user_id, {r('value', 'value')}, {cols(rolling(['value'], _by_user))} FROM tele"
_frame15 = "OVER (ORDER BY row_idx ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)"
ORACLES["rolling_mean_std"] = f"WITH {TELE} SELECT event_id, " + cols(
    f"{r(f'avg({m}) {_frame15}', f'{m}_roll_mean_15')}, {r(f'coalesce(stddev_samp({m}) {_frame15}, 0.0)', f'{m}_roll_std_15')}" for m in METRICS) + " FROM tele"


def _valid() -> str:
    parts = [TELE]
    for n, m in enumerate(METRICS):
        parts.append(f"v{n} AS (SELECT row_idx, avg({m}) {_frame15} AS a, coalesce(stddev_samp({m}) {_frame15}, 0.0) AS s FROM tele WHERE {m} IS NOT NULL)")
    far = "OVER (ORDER BY row_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    now = cols(f"coalesce(last_value(v{n}.a IGNORE NULLS) {far.replace('row_idx', 'tele.row_idx')}, 0.0) AS {m}_roll_mean_15, "
               f"coalesce(last_value(v{n}.s IGNORE NULLS) {far.replace('row_idx', 'tele.row_idx')}, 0.0) AS {m}_roll_std_15" for n, m in enumerate(METRICS))
    joins = " ".join(f"LEFT JOIN v{n} ON tele.row_idx = v{n}.row_idx" for n in range(len(METRICS)))
    parts.append(f"valid AS (SELECT tele.row_idx, event_id, {now} FROM tele {joins})")
    return ", ".join(parts)


ORACLES["rolling_mean_std_valid"] = f"WITH {_valid()} SELECT event_id, " + cols(
    r(f"{m}_roll_{s}_15", f"{m}_roll_{s}_15") for m in METRICS for s in ("mean", "std")) + " FROM valid"
ORACLES["reconcile_outputs"] = f"""WITH {_valid()}, plain AS (SELECT event_id, {cols(f'avg({m}) {_frame15} AS {m}_roll_mean_15' for m in METRICS)} FROM tele)
""" + " UNION ALL ".join(
    f"""SELECT '{m}_roll_mean_15' AS "column", {r(f'max(abs(a.{m}_roll_mean_15 - b.{m}_roll_mean_15))', 'max_abs_diff')},
  {i(f'sum(CASE WHEN (a.{m}_roll_mean_15 IS NULL) <> (b.{m}_roll_mean_15 IS NULL) THEN 1 ELSE 0 END)', 'one_side_null')},
  {i('0', 'only_a')}, {i('0', 'only_b')}, coalesce(max(abs(a.{m}_roll_mean_15 - b.{m}_roll_mean_15)) < 0.0001, false) AS ok
FROM plain a JOIN valid b USING (event_id)""" for m in METRICS)
ORACLES["lag_features"] = f"WITH {CLEAN} SELECT event_id, {cols(lags(METRICS, _by_row))} FROM clean"
ORACLES["lag_features_by_user"] = f"WITH {TELE} SELECT event_id, {cols(lags(['value'], _by_user))} FROM tele"
_roc = [f"coalesce({m} - lag({m}) OVER ({_by_row}), 0.0)" for m in METRICS]
ORACLES["rate_of_change"] = f"WITH {CLEAN} SELECT event_id, {cols(r(e, f'{m}_roc') for e, m in zip(_roc, METRICS))} FROM clean"
ORACLES["build_features"] = f"""WITH {CLEAN}, built AS (SELECT row_idx - 30 AS row_idx, event_id, is_anomaly, anomaly_type, {cols(r(m, m, 5) for m in METRICS)},
  {cols(rolling(METRICS, _by_row, 5))}, {cols(lags(METRICS, _by_row, 5))}, {cols(r(e, f'{m}_roc', 5) for e, m in zip(_roc, METRICS))},
  {r('sin(2 * pi() * hour(ts) / 24)', 'hour_sin', 5)}, {r('cos(2 * pi() * hour(ts) / 24)', 'hour_cos', 5)},
  {r('sin(2 * pi() * (isodow(ts) - 1) / 7)', 'dow_sin', 5)}, {r('cos(2 * pi() * (isodow(ts) - 1) / 7)', 'dow_cos', 5)},
  {i('CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END', 'is_weekend')} FROM clean)
SELECT * REPLACE (CAST(is_anomaly AS BIGINT) AS is_anomaly, CAST(row_idx AS BIGINT) AS row_idx) FROM built WHERE row_idx >= 0"""
_filled = [*METRICS, *[f"{m}_{s}_{n}" for m in METRICS for n in (5, 15, 30) for s in ("mean", "min", "max")], *[f"{m}_lag_{k}" for m in METRICS for k in (1, 5, 15, 30)]]
ORACLES["build_features_gaps"] = ORACLES["build_features"].replace(CLEAN, TELE).replace("FROM clean", "FROM tele").replace(
    "SELECT * REPLACE (", "SELECT * REPLACE (" + cols(f"coalesce(last_value({c} IGNORE NULLS) OVER (ORDER BY row_idx), 0.0) AS {c}" for c in _filled) + ", ")
ORACLES["chronological_split"] = f"WITH {TELE}, {_plain_split} SELECT event_id, split FROM s"
ORACLES["chronological_split_by_user"] = f"""WITH {TELE} SELECT event_id, user_id,
  {SPLIT_CASE.format(i='user_idx', n='count(*) OVER (PARTITION BY user_id)')} AS split FROM tele"""
_w30 = "OVER (PARTITION BY split ORDER BY row_idx ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
ORACLES["sliding_sequences"] = f"""WITH {SPLIT}, s AS (SELECT row_idx, split, is_anomaly, row_number() OVER (PARTITION BY split ORDER BY row_idx) - 1 AS pos,
  count(*) OVER (PARTITION BY split) AS n, lag(latency_ms, 29) OVER (PARTITION BY split ORDER BY row_idx) AS first_x, packet_loss_pct AS last_y,
  sum({' + '.join(METRICS)}) {_w30} AS total FROM split)
SELECT {i('row_idx', 'row_idx')}, split, {i('is_anomaly', 'label')}, {i('30', 'steps')}, {r('first_x', 'first_x')}, {r('last_y', 'last_y')}, {r('total', 'total')}
FROM s WHERE pos >= 29 AND pos <= n - 2"""
ORACLES["score_windows_scaled"] = f"""WITH {SPLIT}, s AS (SELECT row_idx, split, row_number() OVER (PARTITION BY split ORDER BY row_idx) - 1 AS pos,
  count(*) OVER (PARTITION BY split) AS n FROM split)
SELECT {i('row_idx', 'row_idx')}, CAST(NULL AS VARCHAR) AS error, true AS same_score, true AS flag_fits FROM s WHERE split = 'test' AND pos >= 29 AND pos <= n - 2"""
ORACLES["model_info_recomputed"] = f"""SELECT 'window_classifier' AS model_name, '1.0.0' AS model_version, {i(str(len(METRICS)), 'feature_count')}, {i('30', 'window_size')},
  true AS threshold_on_grid, true AS same_f1"""
ORACLES["window_classifier_rows"] = f"""WITH {TELE}, kept AS (SELECT row_idx - 30 AS row_idx, is_anomaly FROM tele WHERE row_idx >= 30),
f AS (SELECT *, {SPLIT_CASE.format(i='row_idx', n='count(*) OVER ()')} AS split FROM kept),
s AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY row_idx) - 1 AS pos, count(*) OVER (PARTITION BY split) AS n FROM f)
SELECT {i('row_idx', 'row_idx')}, split, {i('is_anomaly', 'label')}, true AS scored, true AS same_after_reload
FROM s WHERE split = 'test' AND pos >= 29 AND pos <= n - 2"""
ORACLES["isolation_forest_planted"] = f"""WITH {SPLIT} SELECT event_id, CAST(planted AS BIGINT) AS planted, CAST(CASE WHEN planted = 1 THEN 1 END AS BIGINT) AS flagged, true AS in_range
FROM split, (VALUES (0), (1)) v(planted) WHERE split = 'test'"""
ORACLES["last_window"] = f"""WITH d AS (SELECT user_id, value,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
SELECT user_id, CASE WHEN count(*) < 30 THEN 'window needs 30 steps, request has ' || count(*) END AS error,
  {r('CASE WHEN count(*) >= 30 THEN sum(CASE WHEN rn <= 30 THEN value END) END', 'total')} FROM d GROUP BY user_id"""


def _decomposed(period: int, part: str, idx: str, value: str = "value") -> str:
    h, by = period // 2, f"PARTITION BY {part} " if part else ""
    on = f"USING ({part})" if part else "ON true"
    key = f"{part}, " if part else ""
    group = f"GROUP BY {part}" if part else ""
    inner = (f"(sum(value) OVER (w ROWS BETWEEN {h - 1} PRECEDING AND {h - 1} FOLLOWING) + 0.5 * (lag(value, {h}) OVER w + lead(value, {h}) OVER w)) / {period}.0"
             if period % 2 == 0 else f"sum(value) OVER (w ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING) / {period}.0")
    return f"""{TELE}, o AS (SELECT event_id, user_id, CAST({idx} AS DOUBLE) AS x, {value} AS value, count(*) OVER ({by.strip()}) AS n FROM tele),
c AS (SELECT *, CASE WHEN x >= {h} AND x <= n - 1 - {h} THEN {inner} END AS tr FROM o WHERE n >= {2 * period} WINDOW w AS ({by}ORDER BY x)),
k AS (SELECT {key}regr_slope(CASE WHEN x < least({h + period}, n - 1 - {h}) THEN tr END, x) AS k0, regr_intercept(CASE WHEN x < least({h + period}, n - 1 - {h}) THEN tr END, x) AS c0,
  regr_slope(CASE WHEN x >= greatest({h}, n - 1 - {h} - {period}) AND x < n - 1 - {h} THEN tr END, x) AS k1,
  regr_intercept(CASE WHEN x >= greatest({h}, n - 1 - {h} - {period}) AND x < n - 1 - {h} THEN tr END, x) AS c1 FROM c WHERE tr IS NOT NULL {group}),
d AS (SELECT c.*, CASE WHEN x < {h} THEN k0 * x + c0 WHEN x > n - 1 - {h} THEN k1 * x + c1 ELSE tr END AS trend FROM c JOIN k {on}),
p AS (SELECT {key}CAST(x AS BIGINT) % {period} AS phase, avg(value - trend) AS a FROM d GROUP BY {key}phase),
z AS (SELECT {key}phase, a - avg(a) OVER ({by.strip()}) AS seasonal FROM p),
f AS (SELECT d.*, seasonal FROM d JOIN z ON CAST(d.x AS BIGINT) % {period} = z.phase {f'AND d.{part} = z.{part}' if part else ''})"""


ORACLES["seasonal_decompose"] = f"""WITH {_decomposed(288, '', 'row_idx', 'ln(1 + value)')} SELECT event_id, {r('value', 'observed')}, {r('trend', 'trend')}, {r('seasonal', 'seasonal')},
  {r('value - trend - seasonal', 'resid')} FROM f"""
ORACLES["seasonal_decompose_by_user"] = f"""WITH {_decomposed(7, 'user_id', 'user_idx')} SELECT event_id, user_id, {r('trend', 'trend')}, {r('seasonal', 'seasonal')},
  {r('value - trend - seasonal', 'resid')} FROM f"""

# --- evaluation ---
ORACLES["binary_metrics"] = f"""WITH {SCORED}, {_auc}, c AS (SELECT {_prf('pred = 1')} FROM scored)
SELECT {r(P, 'precision')}, {r(R_, 'recall')}, {r(F1, 'f1')}, {r('roc_auc', 'roc_auc')} FROM c, auc"""
ORACLES["confusion_matrix"] = f"""WITH {SCORED} """ + " UNION ALL ".join(
    f"SELECT {i(str(a), 'actual')}, {i(str(b), 'predicted')}, {i(f'sum(CASE WHEN label = {a} AND pred = {b} THEN 1 ELSE 0 END)', 'count')} FROM scored" for a in (0, 1) for b in (0, 1))
_CLASSES = f"""{SCORED}, g AS (SELECT event_type AS y, CASE WHEN score > 0.6::DOUBLE THEN 'view' WHEN score > 0.3::DOUBLE THEN 'click' ELSE event_type END AS p FROM scored),
s AS (SELECT y AS label, count(*)::DOUBLE AS support, sum(CASE WHEN y = p THEN 1 ELSE 0 END)::DOUBLE AS tp FROM g GROUP BY y),
q AS (SELECT p AS label, count(*)::DOUBLE AS predicted FROM g GROUP BY p),
k AS (SELECT label, coalesce(tp, 0) AS tp, coalesce(predicted, 0) - coalesce(tp, 0) AS fp, coalesce(support, 0) - coalesce(tp, 0) AS fn, coalesce(support, 0) AS support
  FROM s FULL JOIN q USING (label)),
m AS (SELECT label, {P} AS precision, {R_} AS recall, {F1} AS f1, support, tp FROM k)"""
ORACLES["classification_report"] = f"""WITH {_CLASSES} SELECT label, {r('precision', 'precision')}, {r('recall', 'recall')}, {r('f1', 'f1')}, {i('support', 'support')} FROM m
UNION ALL SELECT 'accuracy', {r('sum(tp) / sum(support)', 'a')}, {r('sum(tp) / sum(support)', 'b')}, {r('sum(tp) / sum(support)', 'c')}, {i('sum(support)', 'd')} FROM m
UNION ALL SELECT 'macro avg', {r('avg(precision)', 'a')}, {r('avg(recall)', 'b')}, {r('avg(f1)', 'c')}, {i('sum(support)', 'd')} FROM m
UNION ALL SELECT 'weighted avg', {r('sum(precision * support) / sum(support)', 'a')}, {r('sum(recall * support) / sum(support)', 'b')},
  {r('sum(f1 * support) / sum(support)', 'c')}, {i('sum(support)', 'd')} FROM m"""
ORACLES["macro_f1"] = f"WITH {_CLASSES} SELECT label, {r('f1', 'f1')} FROM m UNION ALL SELECT 'macro', {r('avg(f1)', 'f1')} FROM m"
ORACLES["optimise_threshold"] = f"""WITH {SCORED}, {_auc},
t AS (SELECT k, CASE WHEN k = 199 THEN 0.99::DOUBLE ELSE k * ((0.99::DOUBLE - 0.01::DOUBLE) / 199) + 0.01::DOUBLE END AS threshold FROM range(200) AS g(k)),
c AS (SELECT k, threshold, {_prf('score >= threshold')} FROM t, scored GROUP BY k, threshold),
b AS (SELECT threshold, {P} AS precision, {R_} AS recall, {F1} AS f1, k FROM c)
SELECT {r('threshold', 'threshold')}, {r('precision', 'precision')}, {r('recall', 'recall')}, {r('f1', 'f1')}, {r('roc_auc', 'roc_auc')} FROM b, auc ORDER BY b.f1 DESC, k LIMIT 1"""
_names = ", ".join(f"'{m}'" for m in METRICS)
_fold = ("list_reduce(list_prepend(struct_pack(ord := -1::BIGINT, start := -1::BIGINT, op := '', value := {m}::DOUBLE), {ops}), lambda a, b: struct_pack(ord := b.ord, start := b.start, op := b.op, "
         "value := CASE WHEN b.op = 'set' THEN b.value WHEN a.value IS NOT NULL THEN least(greatest(a.value * b.value, 0.0::DOUBLE), 500.0::DOUBLE) END)).value")
ORACLES["overlay_episodes"] = f"""WITH {TELE}, ep AS (SELECT event_id AS start, CAST(floor(value) AS BIGINT) AS pick, value / 25.0::DOUBLE AS value
  FROM events WHERE event_type = 'purchase' AND value > {HIGH}),
ops AS (SELECT start + o AS row_idx, start, pick % 6 AS ord, list_extract([{_names}], CAST(pick % 6 + 1 AS BIGINT)) AS metric, CASE WHEN pick % 2 = 0 THEN 'multiply' ELSE 'set' END AS op, value
  FROM ep, range(12) AS g(o) WHERE o <= pick % 9 + 2),
pm AS (SELECT row_idx, metric, list(struct_pack(ord := ord, start := start, op := op, value := value) ORDER BY ord, start) AS l FROM ops GROUP BY row_idx, metric),
kind AS (SELECT row_idx, 'episode_' || arg_max(metric, ord * 1000000000 + start) AS kind FROM ops GROUP BY row_idx),
done AS (SELECT event_id, {cols(f"CASE WHEN p{n}.l IS NULL THEN {m} ELSE {_fold.format(m=m, ops=f'p{n}.l')} END AS {m}" for n, m in enumerate(METRICS))},
  CASE WHEN kind IS NULL THEN is_anomaly ELSE 1 END AS is_anomaly, coalesce(kind, anomaly_type) AS anomaly_type
  FROM tele LEFT JOIN kind USING (row_idx) {" ".join(f"LEFT JOIN pm p{n} ON p{n}.row_idx = tele.row_idx AND p{n}.metric = '{m}'" for n, m in enumerate(METRICS))})
SELECT event_id, {RAW}, {i('is_anomaly', 'is_anomaly')}, anomaly_type FROM done"""
ORACLES["unified_alert"] = f"""WITH st AS (SELECT CAST(epoch(date_trunc('hour', ts)) + floor(minute(ts) / 5.0) * 300 AS BIGINT) AS step, value FROM events),
s AS (SELECT step, avg(value / (value + 50.0)) AS p_seq FROM st GROUP BY step),
k AS (SELECT step, max(value / (value + 150.0)) AS p_knn FROM st WHERE value > {HIGH} GROUP BY step)
SELECT step, {r('p_seq', 'p_seq')}, {r('coalesce(p_knn, 0.0)', 'p_knn')}, {r('0.7 * p_seq + 0.3 * coalesce(p_knn, 0.0)', 'alert_score')} FROM s LEFT JOIN k USING (step)"""

# --- vectors ---
PARTS = f"""{VECTORS}, parts AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY category ORDER BY md5(id || ':42'), id) - 1
  < round(count(*) OVER (PARTITION BY category) * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM vectors)"""
ORACLES["label_encode"] = f"""WITH {VECTORS} SELECT id, category, {i('dense_rank() OVER (ORDER BY category) - 1', 'label_id')}, category AS label_name FROM vectors"""
ORACLES["stratified_split"] = f"WITH {PARTS} SELECT id, category, split FROM parts"
_near = """near AS (SELECT q.id AS qid, c.id AS cid, c.category, c.log_text, 1 - list_cosine_similarity(q.e, c.e) AS d,
  row_number() OVER (PARTITION BY q.id ORDER BY round(1 - list_cosine_similarity(q.e, c.e), 12), c.id) AS rn FROM {q} q, {c} c)"""
_test_train = _near.format(q="(SELECT * FROM parts WHERE split = 'test')", c="(SELECT * FROM parts WHERE split = 'train')")
_votes = f"""{PARTS}, {_test_train}, votes AS (SELECT qid, category AS label, count(*) AS v FROM near WHERE rn <= 7 GROUP BY qid, category),
win AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY v DESC, label) AS place FROM votes)"""
ORACLES["knn_classify"] = f"WITH {_votes} SELECT qid, label, {r('v / 7.0', 'confidence')} FROM win WHERE place = 1"
ORACLES["knn_anomaly_prob"] = f"WITH {_votes} SELECT qid, {r('1 - sum(CASE WHEN label = $$normal$$ THEN v ELSE 0 END) / 7.0', 'p_anomaly')} FROM votes GROUP BY qid"
ORACLES["similar_logs"] = f"""WITH {VECTORS}, {_near.format(q='vectors', c='vectors')}
SELECT qid, {i('rn', 'rank')}, cid, {r('1 - d', 'similarity', 4)}, log_text, category FROM near WHERE rn <= 5"""
ORACLES["analyze_logs"] = f"""WITH {_votes}, al AS (SELECT q.id AS qid, c.log_text, row_number() OVER (PARTITION BY q.id ORDER BY round(1 - list_cosine_similarity(q.e, c.e), 12), c.id) AS rn
  FROM (SELECT * FROM parts WHERE split = 'test') q, parts c),
sim AS (SELECT qid, string_agg(log_text, '; ' ORDER BY rn) AS near_logs FROM al WHERE rn <= 3 GROUP BY qid)
SELECT qid AS id, label AS predicted_category, {r('v / 7.0', 'confidence', 4)}, near_logs FROM win JOIN sim USING (qid) WHERE place = 1"""
ORACLES["local_outlier_factor"] = f"""WITH {PARTS}, tr AS (SELECT id, e FROM parts WHERE split = 'train'), te AS (SELECT id, e FROM parts WHERE split = 'test'),
tt AS (SELECT a.id AS q, b.id AS c, list_distance(a.e, b.e) AS d, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.e, b.e), b.id) AS rn FROM tr a, tr b WHERE a.id <> b.id),
edge AS (SELECT q, c, d FROM tt WHERE rn <= 20), kd AS (SELECT q, max(d) AS kd FROM edge GROUP BY q),
lrd AS (SELECT edge.q, 1.0 / (avg(greatest(d, kd.kd)) + 1e-10) AS lrd FROM edge JOIN kd ON edge.c = kd.q GROUP BY edge.q),
fac AS (SELECT edge.q, avg(n.lrd) / any_value(o.lrd) AS lof FROM edge JOIN lrd n ON edge.c = n.q JOIN lrd o ON edge.q = o.q GROUP BY edge.q),
off AS (SELECT quantile_cont(-lof, 0.07) AS o FROM fac),
xt AS (SELECT a.id AS q, b.id AS c, list_distance(a.e, b.e) AS d, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.e, b.e), b.id) AS rn FROM te a, tr b),
xs AS (SELECT xt.q, avg(lrd.lrd) * (avg(greatest(d, kd.kd)) + 1e-10) AS lof FROM xt JOIN kd ON xt.c = kd.q JOIN lrd ON xt.c = lrd.q WHERE rn <= 20 GROUP BY xt.q)
SELECT q AS id, {r('lof', 'lof')}, {r('lof + o', 'anomaly_score')}, {i('CASE WHEN lof + o > 0 THEN 1 ELSE 0 END', 'is_outlier')} FROM xs, off"""

# --- streams ---
_u30 = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"
ORACLES["stream_score_windows"] = f"""WITH w AS (SELECT event_id, value, avg(value) {_u30} AS m, coalesce(stddev_samp(value) {_u30}, 0.0) AS s FROM events)
SELECT event_id, {r('m', 'value_roll_mean_30')}, {r('s', 'value_roll_std_30')}, {r('1.0 / (1.0 + exp(-((value - m) / (s + 1.0))))', 'anomaly_score')} FROM w"""

_vowel = {c: f"(length(text) - length(replace(text, '{c}', '')))" for c in "aeiou"}
ORACLES["embed_text_letters"] = f"""SELECT doc_id AS id, {i('5', 'dim')}, {r(_vowel['a'], 'first_dim')},
  {r(' + '.join(f'{v} * {v}' for v in _vowel.values()), 'sq_norm')} FROM documents"""
ORACLES["embed_text_batched"] = ORACLES["embed_text_letters"]
ORACLES["similar_logs_stored"] = ORACLES["similar_logs"]
ORACLES["similar_logs_recall"] = f"SELECT {i('count(*)', 'queries')}, true AS enough FROM embeddings"
_texts = f"""vectors AS (SELECT doc_id AS id, [{', '.join(f'{v}::DOUBLE' for v in _vowel.values())}] AS e, 'quality_' || quality AS category,
  text AS log_text FROM documents JOIN labels USING (doc_id))"""
_zero_safe = "coalesce(CASE WHEN isnan(list_cosine_similarity(q.e, c.e)) THEN 0 ELSE list_cosine_similarity(q.e, c.e) END, 0)"
ORACLES["analyze_log_text"] = f"""WITH {_votes}, al AS (SELECT q.id AS qid, round(list_cosine_similarity(q.e, c.e), 4) AS s,
  row_number() OVER (PARTITION BY q.id ORDER BY round(1 - list_cosine_similarity(q.e, c.e), 12), c.id) AS rn
  FROM (SELECT * FROM parts WHERE split = 'test') q, parts c),
sim AS (SELECT qid, count(*) AS n, sum(s) AS s FROM al WHERE rn <= qid % 10 + 1 GROUP BY qid)
SELECT qid AS id, label AS predicted_category, {r('v / 7.0', 'confidence', 3)}, {i('n', 'n_similar')}, {r('s', 'similarity', 3)}
FROM win JOIN sim USING (qid) WHERE place = 1""".replace(VECTORS, _texts).replace("list_cosine_similarity(q.e, c.e)", _zero_safe)

# A reloaded model scores every row of the test split like the one that was saved.
ORACLES["load_model"] = """SELECT 'anomaly_score' AS "column", CAST(0 AS DOUBLE) AS max_abs_diff, CAST(0 AS BIGINT) AS one_side_null,
  CAST(0 AS BIGINT) AS only_a, CAST(0 AS BIGINT) AS only_b, true AS ok"""
ORACLES["load_bundle"] = " UNION ALL ".join(ORACLES["load_model"].replace("anomaly_score", c) for c in ("confidence", "p_anomaly", "similarity"))
_report = ORACLES["classification_report"]
ORACLES["log_pipeline_letters"] = f"""WITH {_votes}, g AS (SELECT category AS y, label AS p FROM win JOIN parts ON qid = id WHERE place = 1),
{_report[_report.index("s AS (SELECT y AS label"):]}""".replace(VECTORS, _texts).replace("list_cosine_similarity(q.e, c.e)", _zero_safe)
