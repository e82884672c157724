"""For each registered query that SQL can express, the SQL for the same parquet tables.

Doubles are rounded as in the queries; ``+ 0.0`` turns -0.0 into 0.0.
"""

from __future__ import annotations

from math import exp

from grainmill.operators.sampling import alias_table
from grainmill.plans.queries import ALIAS_WEIGHTS, OOB_TREES, STATED

MEASURES = {"m_value": "z_value", "m_k": "z_k", "m_user": "z_user", "m_minute": "z_minute"}
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents"]


def r(expression: str, name: str, places: int = 4) -> str:
    return f"round({expression}, {places}) + 0.0 AS {name}"


def digest(columns: list[str], seed: int) -> str:
    return "md5(concat_ws('-', '{}', {}))".format(seed, ", ".join(f"CAST({c} AS VARCHAR)" for c in columns))


def seeded_int(columns: list[str], seed: int) -> str:
    return f"CAST('0x' || substr({digest(columns, seed)}, 1, 8) AS BIGINT)"


def in_share(columns: list[str], share: float, seed: int) -> str:
    return f"{seeded_int(columns, seed)} < {int(share * 2**32)}"


OBS = """obs AS (
  SELECT event_id AS "Id", CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour, value AS m_value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS m_k, CAST(user_id AS DOUBLE) AS m_user,
         CAST(minute(ts) AS DOUBLE) AS m_minute, event_type AS target
  FROM events)"""

LINES = """lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
         l_quantity, l_extendedprice, l_discount, l_tax,
         CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS target
  FROM lineitem)"""


def z(source: str, where: str = "true", name: str = "feats", moments: str | None = None) -> str:
    """CTEs for moments of ``source`` rows under ``where`` and the z-scores of its rows."""
    fitted = ", ".join(f"avg({m}) AS {m}_mean, stddev_pop({m}) AS {m}_sd" for m in MEASURES)
    scores = ", ".join(f"coalesce(({m} - {m}_mean) / nullif({m}_sd, 0), 0) AS {n}" for m, n in MEASURES.items())
    fit_where = moments if moments is not None else where
    return f"""{name}_m AS (SELECT {fitted} FROM {source} WHERE {fit_where}),
{name} AS (SELECT {scores}, "Id", date, hour, target FROM {source}, {name}_m WHERE {where})"""


Z_ROUNDED = ", ".join(r(n, n) for n in MEASURES.values())
M_ROUNDED = ", ".join(r(m, m) for m in MEASURES)
LINE_LIST = ", ".join(LINE_KEYS)
TRAIN_LINE = in_share(LINE_KEYS, 0.7, 123)


def nearest(rows: str, centroids: str, features: list[str], keep: str, keys: list[str]) -> str:
    """SQL for the class of the nearest centroid, smallest class on a tie."""
    distance = " + ".join(f"(r.{f} - c.{f}) * (r.{f} - c.{f})" for f in features)
    order = ", ".join(f'r."{k}"' for k in keys)
    return f"""SELECT {keep}, c.target AS prediction FROM {rows} r, {centroids} c
  QUALIFY row_number() OVER (PARTITION BY {order} ORDER BY {distance}, c.target) = 1"""


def centroids(source: str, features: list[str], where: str) -> str:
    means = ", ".join(f"avg({f}) AS {f}" for f in features)
    return f"SELECT target, {means} FROM {source} WHERE {where} GROUP BY target"


SCORED_LINES = f"""{LINES},
cent AS ({centroids('lines', LINE_FEATURES, TRAIN_LINE)}),
tests AS (SELECT * FROM lines WHERE NOT ({TRAIN_LINE})),
scored AS ({nearest('tests', 'cent', LINE_FEATURES, 'r.' + ', r.'.join(LINE_KEYS + ['target']), LINE_KEYS)})"""

DRIFT_FEATURES = ["m_value", "m_k", "m_user", "m_minute", "m_sequence"]
DRIFT = f"""{OBS},
sides AS (SELECT *, CAST("Id" AS DOUBLE) AS m_sequence, date < DATE '2024-01-16' AS early FROM obs),
long AS ({" UNION ALL ".join(f"SELECT '{f}' AS feature, {f} AS v, early FROM sides WHERE {f} IS NOT NULL" for f in DRIFT_FEATURES)}),
byvalue AS (SELECT feature, v, count(*) FILTER (early) AS a, count(*) FILTER (NOT early) AS b FROM long GROUP BY feature, v),
running AS (
  SELECT feature, CAST(sum(a) OVER w AS DOUBLE) AS ca, CAST(sum(b) OVER w AS DOUBLE) AS cb,
         sum(a) OVER f AS ta, sum(b) OVER f AS tb
  FROM byvalue WINDOW w AS (PARTITION BY feature ORDER BY v), f AS (PARTITION BY feature)),
ks AS (
  SELECT feature, CAST(max(ta) AS BIGINT) AS n_reference, CAST(max(tb) AS BIGINT) AS n_current,
         max(abs(ca / ta - cb / tb)) AS statistic
  FROM running GROUP BY feature),
lam AS (
  SELECT *, statistic * sqrt(CAST(n_reference AS DOUBLE) * n_current / (CAST(n_reference AS DOUBLE) + n_current)) AS l FROM ks),
perfeature AS (
  SELECT feature, n_reference, n_current, statistic, p_value, p_value < 0.05 AS drifted FROM (
    SELECT *, CASE WHEN l < 0.2 THEN 1.0::DOUBLE ELSE least(1.0::DOUBLE, greatest(0.0::DOUBLE,
      2 * list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)
                                  * exp(-2.0::DOUBLE * k * k * l * l))))) END AS p_value
    FROM lam))"""

VERSIONS = """versions AS (
  SELECT o_custkey AS name, CAST(o_orderkey AS VARCHAR) AS version,
         CASE o_orderstatus WHEN 'O' THEN 'None' WHEN 'P' THEN 'Staging' ELSE 'Production' END AS stage,
         o_orderkey AS run_id, o_totalprice / 500000.0::DOUBLE AS accuracy
  FROM orders)"""
TAGS = """tags AS (
  SELECT l_orderkey AS run_id,
         CASE WHEN l_linestatus = 'F' THEN 'train_dataset_version' ELSE 'test_dataset_version' END AS key,
         l_partkey AS value, l_shipdate AS logged_at
  FROM lineitem),
last_tags AS (
  SELECT run_id, key, value FROM tags
  QUALIFY row_number() OVER (PARTITION BY run_id, key ORDER BY logged_at DESC, value DESC) = 1)"""
NEWEST = "QUALIFY row_number() OVER (PARTITION BY name ORDER BY CAST(version AS BIGINT) DESC) = 1"


def promote(chosen: str, stage: str) -> str:
    return f"""WITH {VERSIONS}, chosen AS ({chosen})
SELECT v.name, v.version, CASE WHEN c.version IS NULL THEN v.stage ELSE '{stage}' END AS stage, v.run_id
FROM versions v LEFT JOIN chosen c ON v.name = c.name AND v.version = c.version"""


def performance(side: str, source: str) -> str:
    return f"""SELECT '{side}' AS side, k.class,
  CAST(count(*) FILTER (target = k.class) AS BIGINT) AS support,
  round(coalesce(count(*) FILTER (target = k.class AND prediction = k.class)
    / nullif(CAST(count(*) FILTER (prediction = k.class) AS DOUBLE), 0), 0), 6) + 0.0 AS precision,
  round(coalesce(count(*) FILTER (target = k.class AND prediction = k.class)
    / nullif(CAST(count(*) FILTER (target = k.class) AS DOUBLE), 0), 0), 6) + 0.0 AS recall,
  round(coalesce(2 * count(*) FILTER (target = k.class AND prediction = k.class)
    / nullif(CAST(count(*) FILTER (target = k.class) + count(*) FILTER (prediction = k.class) AS DOUBLE), 0), 0), 6) + 0.0 AS f1,
  round(avg(CASE WHEN target = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) + 0.0 AS accuracy
FROM {source}, (SELECT unnest([0, 1]) AS class) k GROUP BY k.class"""


def summary(side: str, test: str) -> list[str]:
    return [
        f"""SELECT '{f}' AS feature, '{side}' AS side, count({f}) AS n, count(*) - count({f}) AS n_missing,
  {r(f'avg({f})', 'mean')}, {r(f'stddev_pop({f})', 'sd')}, {r(f'min({f})', 'min')}, {r(f'max({f})', 'max')}
FROM sides WHERE {test}"""
        for f in DRIFT_FEATURES
    ]


HISTORY = """history AS (SELECT * FROM obs WHERE date < (SELECT max(date) FROM obs))"""
SPLIT_ID = f"CASE WHEN {in_share(['\"Id\"'], 0.7, 123)} THEN 'train' ELSE 'test' END AS split"
TRAINING = f"""{OBS}, {HISTORY}, {z('obs')},
training AS (
  SELECT h."Id", h.target, f.z_value, f.z_k, f.z_user, f.z_minute, {SPLIT_ID.replace('"Id"', 'h."Id"')}
  FROM history h LEFT JOIN feats f ON h."Id" = f."Id" AND h.hour = f.hour)"""

DOCS = f"""docs AS (SELECT doc_id, n_chars, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words FROM documents),
labelled AS (SELECT d.*, l.quality AS target FROM docs d JOIN labels l ON d.doc_id = l.doc_id),
cent AS ({centroids('labelled', ['n_chars', 'n_words'], in_share(['doc_id'], 0.7, 123))}),
scored AS ({nearest('labelled', 'cent', ['n_chars', 'n_words'], 'r.doc_id, r.target', ['doc_id'])}),
tests AS (SELECT * FROM scored WHERE NOT ({in_share(['doc_id'], 0.7, 123)}))"""


def draw_of(components) -> str:
    """SQL for two features drawn from stated components of each class."""

    def u(seed: int) -> str:
        return f"({seeded_int(LINE_KEYS, seed)} / 4294967296.0::DOUBLE)"

    z = [f"sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {u(13 + 2 * i)})) * cos(2.0::DOUBLE * pi() * {u(14 + 2 * i)})" for i in range(2)]
    tests, running = [], {}
    for c in components:
        running[c.label] = running.get(c.label, 0.0) + c.weight
        values = [*c.mean, c.factor[0][0], c.factor[1][0], c.factor[1][1]]
        tests.append(f"WHEN target = {c.label} AND u < {running[c.label]}::DOUBLE THEN {[float(v) for v in values]}::DOUBLE[]")
    return f"""WITH {LINES}, draws AS (SELECT {LINE_LIST}, target, {u(3)} AS u, {z[0]} AS a, {z[1]} AS b FROM lines),
parts AS (SELECT *, CASE {" ".join(tests)} END AS p FROM draws WHERE target IS NOT NULL)
SELECT {r('p[1] + p[3] * a', 'x')}, {r('p[2] + p[4] * a + p[5] * b', 'y')}, {LINE_LIST}, target FROM parts"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["scan_observations"] = (
        'SELECT value AS m_value, user_id AS m_user, event_id AS "Id", CAST(ts AS DATE) AS date,'
        " CAST(hour(ts) AS INTEGER) AS hour FROM events"
    )
    sized = "CASE WHEN {0} IS NULL THEN '~' ELSE length(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR) END"
    identity = ", ".join(sized.format(k) for k in LINE_KEYS)
    sql["row_identity"] = (
        f"WITH {LINES} SELECT md5(concat({identity})) AS \"Id\", {', '.join(LINE_FEATURES)} FROM lines"
    )
    sql["preview_top_n"] = f"WITH {LINES} SELECT * FROM lines ORDER BY {LINE_LIST} LIMIT 20"
    sql["flag_newest"] = (
        f'WITH {OBS} SELECT "Id", date, date = (SELECT max(date) FROM obs) AS is_newest FROM obs'
    )
    keys = '"Id", date, hour'
    sql["join_labels"] = (
        f"WITH {OBS} SELECT a.\"Id\", a.date, a.hour, {', '.join(r('a.' + m, m) for m in MEASURES)}, b.target"
        ' FROM obs a JOIN obs b ON a."Id" = b."Id" AND a.date = b.date AND a.hour = b.hour'
    )
    sql["join_labels_salted"] = (
        "SELECT s_suppkey, l_quantity, l_tax, l_returnflag, s_nationkey"
        " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
    )
    sql["join_labels_typed"] = (
        "SELECT CAST(s_suppkey AS INTEGER) AS s_suppkey, l_quantity, l_tax, l_returnflag, s_nationkey"
        " FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"
    )
    hot = "CAST(CASE WHEN {0} % 3 = 0 THEN 0 ELSE {0} % 200 END AS INTEGER) AS bucket"
    sql["join_hot_both"] = (
        f"WITH a AS (SELECT {hot.format('o_custkey')}, o_orderkey AS key FROM orders),"
        f" b AS (SELECT {hot.format('c_custkey')}, c_nationkey AS target FROM customer)"
        " SELECT bucket, count(*) AS n_rows, CAST(sum(key % 1000 * target) AS BIGINT) AS total FROM a JOIN b USING (bucket) GROUP BY bucket"
    )
    sql["newest_date"] = f"WITH {OBS} SELECT max(date) AS newest_date FROM obs"
    sql["drop_newest_day"] = f"WITH {OBS}, {HISTORY} SELECT {keys}, {M_ROUNDED}, target FROM history"
    sql["drop_newest"] = f"WITH {OBS}, {HISTORY} SELECT {keys}, {M_ROUNDED} FROM history"
    sql["standardise"] = f"WITH {OBS}, {z('obs')} SELECT {Z_ROUNDED}, {keys} FROM feats"
    sql["create_feature_table"] = sql["standardise"]
    sql["feature_moments"] = f"WITH {OBS} " + " UNION ALL ".join(
        f"SELECT '{m}' AS feature, count({m}) AS n, {r(f'avg({m})', 'mean')}, {r(f'stddev_pop({m})', 'sd')} FROM obs"
        for m in MEASURES
    )
    sql["feature_moments_merged"] = sql["feature_moments"]
    sql["feature_lookup"] = (
        f"WITH {OBS}, {z('obs')} SELECT o.\"Id\", o.hour, o.date, {Z_ROUNDED}"
        ' FROM obs o LEFT JOIN feats f ON o."Id" = f."Id" AND o.hour = f.hour'
    )
    sql["lookup_coverage"] = (
        "SELECT count(*) AS n_rows, count(*) FILTER (quality IS NULL OR toxic IS NULL) AS n_missing"
        " FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    )
    sql["train_test_split"] = f'WITH {OBS} SELECT "Id", hour, {SPLIT_ID} FROM obs'
    sql["training_set"] = f'WITH {TRAINING} SELECT "Id", target, {Z_ROUNDED}, split FROM training'
    sql["training_counts"] = (
        f"WITH {TRAINING} SELECT split, target, count(*) AS n_rows, count(z_value) AS n_found,"
        f" {r('avg(z_value)', 'mean_z')} FROM training GROUP BY split, target"
    )
    sql["union_classes"] = " UNION ALL ".join(
        f"SELECT {', '.join(LINE_FEATURES)}, CAST({i} AS INTEGER) AS target FROM lineitem WHERE l_returnflag = '{c}'"
        for i, c in enumerate("ANR")
    )
    sql["union_frames"] = (
        "SELECT o_orderkey AS key, o_totalprice AS amount FROM orders"
        " UNION ALL SELECT l_orderkey AS key, l_extendedprice AS amount FROM lineitem"
    )
    first = z("obs", "date < DATE '2024-01-21'", "old")
    batch = z("obs", "date >= DATE '2024-01-11'", "new", moments="true")
    sql["upsert_features"] = (
        f"WITH {OBS}, {first}, {batch} SELECT {Z_ROUNDED}, {keys} FROM old WHERE date < DATE '2024-01-11'"
        f" UNION ALL SELECT {Z_ROUNDED}, {keys} FROM new"
    )
    sql["append_batch"] = f"WITH {OBS} SELECT {keys}, m_value FROM obs"
    sql["append_keyed"] = sql["append_batch"]
    sql["read_as_of"] = f"WITH {OBS} SELECT {keys}, m_value FROM obs WHERE date < DATE '2024-01-16'"
    sql["overwrite_version"] = f"WITH {OBS} SELECT date, count(*) AS n_rows FROM obs GROUP BY date"
    sql["latest_version"] = (
        "SELECT o_custkey, max(o_orderkey) AS latest_version FROM orders GROUP BY o_custkey"
    )
    signal = "CAST(CASE WHEN l_quantity < 17 THEN 0 WHEN l_quantity < 34 THEN 1 ELSE 2 END AS INTEGER)"
    sql["batch_score"] = (
        f"WITH {LINES} SELECT {LINE_LIST}, {signal} AS target, {signal} AS prediction FROM lines"
    )
    sql["rf_grid_search"] = (
        f"WITH {LINES}, tests AS (SELECT {signal} AS cls FROM lines WHERE NOT ({TRAIN_LINE})),"
        " g AS (SELECT a.c AS actual, p.c AS predicted FROM (SELECT unnest([0, 1, 2]) AS c) a, (SELECT unnest([0, 1, 2]) AS c) p)"
        " SELECT actual, predicted, count(t.cls) AS n_rows FROM g LEFT JOIN tests t"
        " ON t.cls = g.actual AND g.actual = g.predicted GROUP BY actual, predicted"
    )
    sql["rf_regression"] = (
        f"WITH {LINES}, tests AS (SELECT {signal} AS cls, {signal} AS told FROM lines WHERE NOT ({TRAIN_LINE}))"
        " SELECT 1 - sum((cls - told) ** 2) / (var_pop(cls) * count(*)) AS r2 FROM tests"
    )
    zed = {f: f.replace("l_", "z_") for f in LINE_FEATURES}
    scores = ", ".join(f"({f} - avg({f}) OVER ()) / stddev_pop({f}) OVER () AS {z_}" for f, z_ in zed.items())
    names = list(zed.values())
    parts = [f"SELECT target, '{a}' AS feature, NULL::VARCHAR AS other, {r(f'avg({a})', 'value', 3)} FROM scores GROUP BY target" for a in names]
    parts += [
        f"SELECT target, '{a}' AS feature, '{b}' AS other, {r(f'covar_pop({a}, {b})', 'value', 3)} FROM scores GROUP BY target"
        for i, a in enumerate(names)
        for b in names[: i + 1]
    ]
    sql["mixture_moments"] = (
        f"WITH {LINES}, scores AS (SELECT target, {scores} FROM lines WHERE target IS NOT NULL) " + " UNION ALL ".join(parts)
    )
    unseen = " + ".join(
        f"CAST({seeded_int(LINE_KEYS, 21 + t)} / 4294967296.0::DOUBLE < {exp(-1)!r}::DOUBLE AS INTEGER)" for t in range(OOB_TREES)
    )
    sql["oob_votes"] = (
        f"WITH {LINES}, v AS (SELECT {LINE_LIST}, {signal} AS target, CAST({unseen} AS INTEGER) AS n_out FROM lines)"
        " SELECT *, CASE WHEN n_out > 0 THEN target END AS prediction FROM v"
    )
    sql["mixture_clusters"] = f"WITH {LINES} SELECT {signal} AS target, count(*) AS n_rows FROM lines GROUP BY ALL"
    sql["mixture_draw"] = draw_of(STATED)
    sql["predictions"] = f"WITH {SCORED_LINES} SELECT * FROM scored"
    right = "CASE WHEN target = prediction THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    sql["accuracy"] = f"WITH {SCORED_LINES} SELECT {r(f'avg({right})', 'accuracy')}, count(*) AS n_rows FROM scored"
    cells = (
        "(SELECT a.c AS actual, p.c AS predicted FROM (SELECT unnest({0}) AS c) a, (SELECT unnest({0}) AS c) p) g"
        " LEFT JOIN scored s ON s.target = g.actual AND s.prediction = g.predicted GROUP BY actual, predicted"
    )
    sql["confusion_counts"] = (
        f"WITH {SCORED_LINES} SELECT actual, predicted, count(s.target) AS n_rows FROM {cells.format([0, 1, 2, 3])}"
    )
    share = "count(s.target) / CAST((SELECT count(*) FROM scored) AS DOUBLE)"
    sql["confusion_normalised"] = (
        f"WITH {SCORED_LINES} SELECT actual, predicted, {r(share, 'share', 6)} FROM {cells.format([0, 1, 2])}"
    )
    sql["class_counts"] = "SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type"
    sql["row_counts"] = " UNION ALL ".join(
        f"SELECT '{n}' AS name, count(*) AS n_rows FROM {n}" for n in ("orders", "lineitem", "events", "documents")
    )
    fit_line = in_share(LINE_KEYS, 0.75, 7)
    sql["r_squared"] = f"""WITH {LINES},
line AS (SELECT regr_slope(l_extendedprice, l_quantity) AS s, regr_intercept(l_extendedprice, l_quantity) AS i
         FROM lines WHERE {fit_line}),
t AS (SELECT l_extendedprice AS y, s * l_quantity + i AS p FROM lines, line WHERE NOT ({fit_line}))
SELECT round(1 - sum((y - p) * (y - p)) / (SELECT var_pop(y) * count(*) FROM t), 6) + 0.0 AS r2 FROM t"""
    names = list(MEASURES.values())
    sql["score_lookup"] = f"""WITH {OBS}, {z('obs')}, cent AS ({centroids('feats', names, 'true')})
{nearest('feats', 'cent', names, 'r."Id", r.date, r.hour', ['Id'])}"""
    flat = f"feature, n_reference, n_current, {r('statistic', 'statistic', 6)}, {r('p_value', 'p_value', 6)}, drifted"
    sql["drift_ks"] = f"WITH {DRIFT} SELECT {flat} FROM perfeature"
    sql["drift_sketch"] = (
        f"WITH {DRIFT} SELECT feature, n_reference, n_current, {r('statistic', 'statistic', 6)}, true AS within FROM perfeature"
    )
    place = "CASE WHEN high > low THEN least(floor((v - low) / (high - low) * 10), 9) ELSE 0 END"
    sql["drift_distributions"] = f"""WITH {DRIFT},
ends AS (SELECT feature, min(v) AS low, max(v) AS high FROM long GROUP BY feature),
placed AS (SELECT feature, early, CAST({place} AS INTEGER) AS bin FROM long JOIN ends USING (feature)),
counts AS (SELECT feature, bin, count(*) FILTER (early) AS a, count(*) FILTER (NOT early) AS b FROM placed GROUP BY feature, bin)
SELECT e.feature, {r('e.low', 'low')}, {r('e.high', 'high')}, CAST(g.bin AS INTEGER) AS bin, coalesce(a, 0) AS in_reference, coalesce(b, 0) AS in_current
FROM ends e CROSS JOIN range(10) g(bin) LEFT JOIN counts c ON c.feature = e.feature AND c.bin = g.bin"""
    sql["drift_summary"] = f"WITH {DRIFT} " + " UNION ALL ".join(
        summary("reference", "early") + summary("current", "NOT early")
    )
    rolled = "count(*) FILTER (drifted) / CAST(count(*) AS DOUBLE)"
    sql["drift_dataset"] = (
        f"WITH {DRIFT} SELECT count(*) AS n_features, count(*) FILTER (drifted) AS n_drifted,"
        f" {r(rolled, 'drift_share')}, {rolled} >= 0.5 AS dataset_drift FROM perfeature"
    )
    sql["drift_document"] = (
        f"WITH {DRIFT} SELECT (SELECT {rolled} >= 0.5 FROM perfeature) AS dataset_drift, {flat} FROM perfeature"
    )
    sql["join_late_labels"] = (
        f'WITH {OBS} SELECT a."Id", a.hour, a.date, a.m_value, b.target'
        ' FROM obs a JOIN obs b ON a."Id" = b."Id" AND a.hour = b.hour'
    )
    sql["label_join_performance"] = (
        f"WITH {DOCS} {performance('reference', 'tests')} UNION ALL {performance('current', 'scored')}"
    )
    sql["newest_model"] = f"WITH {VERSIONS} SELECT name, version, stage, run_id FROM versions {NEWEST}"
    staging = f"SELECT name, version, stage, run_id FROM versions WHERE stage = 'Staging' {NEWEST}"
    sql["newest_in_stage"] = f"WITH {VERSIONS} {staging}"
    sql["gate"] = (
        f"WITH {VERSIONS} SELECT name, version, accuracy,"
        " CASE WHEN accuracy >= 0.8 THEN 'passed' ELSE 'failed' END AS validation FROM versions"
    )
    unstaged = f"SELECT * FROM versions WHERE stage = 'None' {NEWEST}"
    sql["promote_staging"] = promote(f"SELECT * FROM ({unstaged}) WHERE accuracy >= 0.8", "Staging")
    sql["promote_production"] = promote(staging, "Production")
    sql["run_tags_latest"] = f"WITH {TAGS} SELECT run_id, key, value FROM last_tags"
    sql["resolve_versions"] = f"""WITH {VERSIONS}, {TAGS},
newest AS (SELECT name, version, stage, run_id FROM versions {NEWEST})
SELECT n.*, a.value AS train_dataset_version, b.value AS test_dataset_version FROM newest n
LEFT JOIN last_tags a ON a.run_id = n.run_id AND a.key = 'train_dataset_version'
LEFT JOIN last_tags b ON b.run_id = n.run_id AND b.key = 'test_dataset_version'"""
    sql["balanced_sample"] = (
        f"WITH {LINES} SELECT {LINE_LIST}, target FROM lines"
        f" QUALIFY row_number() OVER (PARTITION BY target ORDER BY {digest(LINE_KEYS, 11)}) <= 500"
    )
    sql["exact_split"] = (
        f'WITH {OBS} SELECT "Id", hour, CASE WHEN row_number() OVER (ORDER BY {digest(["\"Id\""], 123)})'
        " <= floor(count(*) OVER () * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM obs"
    )
    u = f"{seeded_int(['\"Id\"'], 5)} / 4294967296.0::DOUBLE"
    sql["weighted_draw"] = (
        f'WITH {OBS} SELECT "Id", CASE WHEN {u} < 0.25::DOUBLE THEN 0 WHEN {u} < 0.875::DOUBLE THEN 2'
        " ELSE 3 END AS drawn FROM obs"
    )
    share, other = alias_table(ALIAS_WEIGHTS)
    sql["alias_draw"] = f"""WITH {OBS},
slots AS (SELECT unnest(range({len(share)})) AS slot, unnest({share}::DOUBLE[]) AS kept, unnest({other}) AS other),
drawn AS (SELECT "Id", {seeded_int(['"Id"'], 7)} / 4294967296.0::DOUBLE * {float(len(share))}::DOUBLE AS u FROM obs)
SELECT "Id", CAST(CASE WHEN u - slot < kept THEN slot ELSE other END AS INTEGER) AS drawn FROM drawn JOIN slots ON slot = CAST(floor(u) AS BIGINT)"""
    fit_id = in_share(['"Id"'], 0.75, 0)
    sql["apply_stored_scaler"] = (
        f"WITH {OBS}, {z('obs', f'NOT ({fit_id})', moments=fit_id)} SELECT {Z_ROUNDED}, \"Id\" FROM feats"
    )
    return sql
