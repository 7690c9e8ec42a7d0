"""The same questions in SQL, written by hand for DuckDB."""

from __future__ import annotations

BASE = """
WITH base AS (
  SELECT event_id, CAST(user_id % 5 AS VARCHAR) AS data_type, epoch_us(ts) // 1000 AS ts, event_type, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events),
models AS (
  SELECT 'm' || event_id AS name, 'model of event ' || event_id AS description, data_type, ts, event_id AS seq,
         value AS intercept, k / 100 AS coef, k
  FROM base WHERE event_type = 'signup'),
records AS (
  SELECT event_id AS record_id, data_type, ts, value, k FROM base WHERE event_type <> 'signup'),
points AS (
  SELECT data_type, ts, arg_max(name, seq) AS name, arg_max(intercept, seq) AS intercept, arg_max(coef, seq) AS coef
  FROM models GROUP BY data_type, ts),
latest AS (
  SELECT data_type, unnest(arg_max(m, (ts, seq))) FROM (
    SELECT data_type, ts, seq, struct_pack(name := name, description := description, since := ts,
           intercept := intercept, coef := coef) AS m FROM models) GROUP BY data_type),
served AS (
  SELECT r.record_id, m.name, r.data_type, r.ts AS submission_ts, m.intercept + r.value * m.coef AS result,
         m.ts AS since, r.k AS duration
  FROM records r ASOF JOIN points m ON r.data_type = m.data_type AND r.ts >= m.ts),
results AS (
  SELECT record_id, name, data_type, submission_ts, round(result, 6) AS result FROM served)
"""

STATS = """,
by_model AS (
  SELECT data_type, name, since, CAST(count(*) AS BIGINT) AS usage, sum(duration) AS duration,
         CAST(min(duration) AS BIGINT) AS "min", CAST(max(duration) AS BIGINT) AS "max"
  FROM served GROUP BY data_type, name, since),
wanted AS (SELECT DISTINCT CAST(user_id % 7 AS VARCHAR) AS data_type FROM events),
state AS (
  SELECT w.data_type, coalesce(l.name, '') AS name, coalesce(l.description, '') AS description,
         2 AS model_type, CAST(coalesce(l.since, 0) AS BIGINT) AS since,
         CAST(coalesce(s.usage, 0) AS BIGINT) AS usage, coalesce(s.duration, 0.0::DOUBLE) AS duration,
         CAST(coalesce(s."min", 9223372036854775807) AS BIGINT) AS "min",
         CAST(coalesce(s."max", -9223372036854775808) AS BIGINT) AS "max"
  FROM wanted w LEFT JOIN latest l ON w.data_type = l.data_type
  LEFT JOIN by_model s ON s.data_type = l.data_type AND s.name = l.name AND s.since = l.since)
"""

RESULTS = BASE + "SELECT * FROM results"

_NETWORK = """
WITH input AS (SELECT vec_id, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings)
"""


def _bad(rule: str) -> str:
    return (
        BASE
        + f""",
documents AS (SELECT data_type, ts, arg_max(name, seq) AS name, arg_max(intercept, seq) AS intercept,
                     arg_max(coef, seq) AS coef, arg_max(k, seq) AS k FROM models {rule} GROUP BY data_type, ts)
SELECT r.record_id, m.name, r.data_type, r.ts AS submission_ts, round(m.intercept + r.value * m.coef, 6) AS result
FROM records r ASOF JOIN documents m ON r.data_type = m.data_type AND r.ts >= m.ts
WHERE CAST(m.k AS INTEGER) % 10 <> 0
"""
    )


DOCUMENTS = """,
documents AS (
  SELECT *, CASE WHEN CAST(k AS INTEGER) % 30 = 0 THEN 9 ELSE 2 END AS model_kind,
    '<PMML xmlns="http://www.dmg.org/PMML-4_3" version="4.3"><RegressionModel functionName="regression">'
    || '<RegressionTable intercept="' || CAST(intercept AS VARCHAR) || '"><NumericPredictor name="value" coefficient="'
    || CAST(coef AS VARCHAR) || '"/></RegressionTable></RegressionModel></PMML>' AS document
  FROM models),
payloads AS (
  SELECT *, CASE WHEN CAST(k AS INTEGER) % 30 = 10 THEN '' WHEN CAST(k AS INTEGER) % 30 = 20
            THEN substr(document, 1, 60) ELSE document END AS payload FROM documents)
"""

TREE_CLASS_LEAF = """
CASE WHEN l_quantity <= 25 THEN CASE WHEN l_extendedprice <= 20000 THEN 1 ELSE 2 END
     ELSE CASE WHEN l_tax > 0.03 THEN 3 ELSE 4 END END
"""

ORACLE: dict[str, str] = {
    "serve_asof": RESULTS,
    "serve_asof_interval": RESULTS,
    "serve_asof_chunked": RESULTS,
    "serve_asof_mark": BASE
    + """
SELECT r.record_id, coalesce(m.name, 'No model available') AS name,
       CASE WHEN m.name IS NULL THEN '' ELSE r.data_type END AS data_type,
       CASE WHEN m.name IS NULL THEN 0 ELSE r.ts END AS submission_ts,
       round(coalesce(m.intercept + r.value * m.coef, 0.0), 6) AS result
FROM records r ASOF LEFT JOIN points m ON r.data_type = m.data_type AND r.ts >= m.ts
""",
    "serve_broadcast": BASE
    + """
SELECT r.record_id, m.name, r.data_type, r.ts AS submission_ts, round(m.intercept + r.value * m.coef, 6) AS result
FROM records r JOIN latest m ON r.data_type = m.data_type
""",
    "serve_models_first": BASE
    + """,
daily AS (
  SELECT data_type, ts // 86400000 AS day, arg_max(name, (ts, seq)) AS name,
         arg_max(intercept, (ts, seq)) AS intercept, arg_max(coef, (ts, seq)) AS coef
  FROM models GROUP BY ALL)
SELECT r.record_id, m.name, r.data_type, r.ts AS submission_ts, round(m.intercept + r.value * m.coef, 6) AS result
FROM (SELECT *, ts // 86400000 AS day FROM records) r ASOF JOIN daily m
  ON r.data_type = m.data_type AND r.day >= m.day
""",
    "bad_model_keep": _bad("WHERE CAST(k AS INTEGER) % 10 <> 0"),
    "bad_model_clear": _bad(""),
    "results_per_type_top": BASE
    + """
SELECT data_type, CAST(rank AS INTEGER) AS rank, record_id, name, result FROM (
  SELECT *, row_number() OVER (PARTITION BY data_type ORDER BY result DESC, record_id) AS rank FROM results)
WHERE rank <= 10
""",
    "display_rows": RESULTS + " ORDER BY submission_ts DESC, record_id DESC LIMIT 10",
    "result_lines": BASE
    + """
SELECT 'Model served in ' || (1706745600000 - submission_ts) || ' ms, with result ' || CAST(result AS VARCHAR)
       || ' (model ' || name || ', data type ' || data_type || ')' AS line FROM results
""",
    "latency": BASE + "SELECT record_id, CAST(1706745600000 - submission_ts AS BIGINT) AS latency_ms FROM results",
    "model_parameters": BASE
    + """
SELECT name, CASE WHEN ok THEN 'linear' END AS form, CASE WHEN ok THEN intercept END AS intercept,
       CASE WHEN ok THEN coef END AS coef, data_type
FROM (SELECT *, CAST(k AS INTEGER) % 10 <> 0 AS ok FROM models)
""",
    "kind_lookup": BASE
    + DOCUMENTS
    + """
SELECT name, CASE WHEN model_kind = 9 THEN 'rejected' ELSE 'supported' END AS verdict, model_kind,
       CASE WHEN model_kind = 2 THEN 'PMML' END AS kind FROM documents
""",
    "payload_guard": BASE
    + DOCUMENTS
    + "SELECT name, CAST(strlen(payload) AS INTEGER) AS bytes, sha256(payload) AS digest FROM payloads WHERE payload <> ''",
    "registry_merge": BASE + "SELECT data_type, name, since AS ts, intercept FROM latest",
    "model_validity": BASE
    + """
SELECT name, data_type, ts, lead(ts) OVER (PARTITION BY data_type ORDER BY ts, seq) AS valid_to FROM models
""",
    "model_history": BASE
    + """
SELECT name, data_type, ts, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY data_type ORDER BY ts DESC, seq DESC) AS rank FROM models) WHERE rank <= 3
""",
    "model_rollback": BASE
    + """
SELECT name, data_type, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY data_type ORDER BY ts DESC, seq DESC) AS rank FROM models) WHERE rank = 2
""",
    "model_dedupe": BASE
    + """
SELECT name, data_type, ts, digest,
       coalesce(digest <> lag(digest) OVER (PARTITION BY data_type ORDER BY ts, seq), true) AS changed
FROM (SELECT *, sha256('payload ' || CAST(CAST(floor(k / 50) AS BIGINT) AS VARCHAR)) AS digest FROM models)
""",
    "linear_score": """
SELECT l_orderkey, l_linenumber, round(3.25 + 0.5 * l_quantity - 12.5 * l_discount + 8 * l_tax, 6) AS result FROM lineitem
""",
    "glm_score": """
SELECT l_orderkey, l_linenumber,
       round(exp(0.5::DOUBLE + 0.0004::DOUBLE * l_quantity * l_quantity + 0.003::DOUBLE * sqrt(l_extendedprice)
                 - 1.5::DOUBLE * l_discount), 6) AS result FROM lineitem
""",
    "tree_reg": """
SELECT l_orderkey, l_linenumber, CAST(CASE
  WHEN l_extendedprice <= 30000 THEN CASE WHEN l_quantity <= 20 THEN 1.5 ELSE 2.25 END
  WHEN l_discount <= 0.05::DOUBLE THEN 3.75
  WHEN l_tax < 0.04::DOUBLE THEN 4.5 ELSE 5.125 END AS DOUBLE) AS result FROM lineitem
""",
    "tree_class": f"""
SELECT l_orderkey, l_linenumber, CAST(CASE leaf WHEN 2 THEN 5 WHEN 3 THEN 7 ELSE 6 END AS DOUBLE) AS result,
  round(CAST(CASE leaf WHEN 1 THEN 0.5 WHEN 2 THEN 0.7 WHEN 3 THEN 0 ELSE 1 / 6 END AS DOUBLE), 6) AS p_5,
  round(CAST(CASE leaf WHEN 1 THEN 0.5 WHEN 2 THEN 0.2 WHEN 3 THEN 0.25 ELSE 5 / 6 END AS DOUBLE), 6) AS p_6,
  round(CAST(CASE leaf WHEN 1 THEN 0 WHEN 2 THEN 0.1 WHEN 3 THEN 0.75 ELSE 0 END AS DOUBLE), 6) AS p_7
FROM (SELECT *, {TREE_CLASS_LEAF.replace("0.03", "0.03::DOUBLE")} AS leaf FROM lineitem)
""",
    "forest_class": """
WITH sold AS (SELECT l_partkey, sum(l_quantity) AS sold, count(*) AS lines FROM lineitem GROUP BY l_partkey),
input AS (
  SELECT p_partkey, p_size, p_retailprice, coalesce(sold, 0) AS sold, coalesce(lines, 0) AS lines
  FROM part LEFT JOIN sold ON p_partkey = l_partkey),
shares AS (
  SELECT p_partkey,
    (CASE WHEN p_size <= 20 THEN 6 / 8::DOUBLE ELSE 1 / 8::DOUBLE END
     + CASE WHEN p_retailprice <= 950 THEN CASE WHEN sold <= 700 THEN 0.75::DOUBLE ELSE 0.25::DOUBLE END ELSE 0::DOUBLE END
     + CASE WHEN lines < 30 THEN 2 / 8::DOUBLE ELSE 4 / 5::DOUBLE END) / 3 AS a,
    (CASE WHEN p_size <= 20 THEN 2 / 8::DOUBLE ELSE 1 / 8::DOUBLE END
     + CASE WHEN p_retailprice <= 950 THEN CASE WHEN sold <= 700 THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END ELSE 0.5::DOUBLE END
     + CASE WHEN lines < 30 THEN 5 / 8::DOUBLE ELSE 0::DOUBLE END) / 3 AS b,
    (CASE WHEN p_size <= 20 THEN 0::DOUBLE ELSE 6 / 8::DOUBLE END
     + CASE WHEN p_retailprice <= 950 THEN 0::DOUBLE ELSE 0.5::DOUBLE END
     + CASE WHEN lines < 30 THEN 1 / 8::DOUBLE ELSE 1 / 5::DOUBLE END) / 3 AS c
  FROM input)
SELECT p_partkey, CAST(CASE WHEN a >= b AND a >= c THEN 5 WHEN b >= c THEN 6 ELSE 7 END AS DOUBLE) AS result,
       round(a, 6) AS p_5, round(b, 6) AS p_6, round(c, 6) AS p_7 FROM shares
""",
    "mlp_class": _NETWORK
    + """,
hidden AS (
  SELECT vec_id, [1 / (1 + exp(-((j % 5 - 2) / 10::DOUBLE + list_inner_product(
           e, [((i * 7 + j * 3) % 11 - 5) / 10::DOUBLE FOR i IN range(64)])))) FOR j IN range(4)] AS h FROM input),
outputs AS (
  SELECT vec_id, [exp(((j + 1) % 5 - 2) / 10::DOUBLE + list_inner_product(
           h, [((i * 7 + (j + 1) * 3) % 11 - 5) / 10::DOUBLE FOR i IN range(4)])) FOR j IN range(3)] AS z FROM hidden)
SELECT vec_id, CAST(4 + list_position(z, list_max(z)) AS DOUBLE) AS result, round(z[1] / list_sum(z), 6) AS p_5,
       round(z[2] / list_sum(z), 6) AS p_6, round(z[3] / list_sum(z), 6) AS p_7 FROM outputs
""",
    "dense_argmax": _NETWORK
    + """,
outputs AS (
  SELECT vec_id, [1 / (1 + exp(-((j % 5 - 2) / 10::DOUBLE + list_inner_product(
           e, [((i * 7 + j * 3) % 11 - 5) / 10::DOUBLE FOR i IN range(64)])))) FOR j IN range(10)] AS z FROM input)
SELECT vec_id, CAST(list_position(z, list_max(z)) - 1 AS DOUBLE) AS result, round(list_max(z), 6) AS best FROM outputs
""",
    "score_dispatch": """
WITH input AS (
  SELECT *, 1 / (1 + exp(-(0.1::DOUBLE * l_quantity - 2 * d + t))) AS z0,
    1 / (1 + exp(-(0.2::DOUBLE + 0.05::DOUBLE * l_quantity + 0.00001::DOUBLE * p + 3 * d - t))) AS z1,
    1 / (1 + exp(-(0.4::DOUBLE - 0.02::DOUBLE * l_quantity + 0.00002::DOUBLE * p + 4 * t))) AS z2
  FROM (SELECT *, l_discount::FLOAT::DOUBLE AS d, l_tax::FLOAT::DOUBLE AS t, l_extendedprice::FLOAT::DOUBLE AS p
        FROM lineitem))
SELECT l_orderkey, l_linenumber,
  CASE l_returnflag WHEN 'A' THEN 'lines linear' WHEN 'N' THEN 'lines tree' ELSE 'lines dense' END AS name,
  round(CAST(CASE l_returnflag
    WHEN 'A' THEN 3.25 + 0.5 * l_quantity - 12.5 * l_discount + 8 * l_tax
    WHEN 'N' THEN CASE
      WHEN l_extendedprice <= 30000 THEN CASE WHEN l_quantity <= 20 THEN 1.5 ELSE 2.25 END
      WHEN l_discount <= 0.05::DOUBLE THEN 3.75
      WHEN l_tax < 0.04::DOUBLE THEN 4.5 ELSE 5.125 END
    ELSE CASE WHEN z0 >= z1 AND z0 >= z2 THEN 0 WHEN z1 >= z2 THEN 1 ELSE 2 END END AS DOUBLE), 6) AS result
FROM input WHERE l_returnflag IN ('A', 'N', 'R')
""",
    "batch_scorer": BASE + "SELECT record_id, round(value + value * k / 100, 6) AS result FROM records",
    "predict_request": """
SELECT vec_id, 'predict' AS signature, CAST(1 AS BIGINT) AS instances, CAST(len(embedding) AS BIGINT) AS width,
       round(CAST(embedding[1] AS DOUBLE), 6) AS first_input,
       round(list_sum([CAST(embedding[i] AS DOUBLE) * i FOR i IN range(1, len(embedding) + 1)]), 4) AS weighed_inputs
FROM embeddings
""",
    "predict_response": """
SELECT vec_id, CAST(len(embedding) AS BIGINT) AS scores,
       CAST(list_position(embedding, list_max(embedding)) - 1 AS DOUBLE) AS result FROM embeddings
""",
    "field_by_name": """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN l_quantity WHEN 'N' THEN l_tax ELSE 0::DOUBLE END AS input FROM lineitem
""",
    "stats_by_model": BASE + STATS + "SELECT *, round(duration / usage, 6) AS average FROM by_model",
    "stats_running": BASE
    + """
SELECT record_id, data_type, name, CAST(count(*) OVER w AS BIGINT) AS run_usage, sum(duration) OVER w AS run_duration,
       CAST(min(duration) OVER w AS BIGINT) AS run_min, CAST(max(duration) OVER w AS BIGINT) AS run_max
FROM served WINDOW w AS (PARTITION BY data_type, name, since ORDER BY submission_ts, record_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
    "stats_running_chunked": BASE
    + """
SELECT record_id, data_type, CAST(count(*) OVER w AS BIGINT) AS run_usage, sum(duration) OVER w AS run_duration,
       CAST(min(duration) OVER w AS BIGINT) AS run_min, CAST(max(duration) OVER w AS BIGINT) AS run_max
FROM served WINDOW w AS (PARTITION BY data_type ORDER BY submission_ts, record_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
""",
    "processors": BASE + "SELECT data_type FROM records UNION SELECT data_type FROM models",
    "state_lookup": BASE + STATS + "SELECT * FROM state",
    "stats_report": BASE
    + STATS
    + """
SELECT data_type, name, 'PMML' AS kind, usage, CASE WHEN usage > 0 THEN round(duration / usage, 6) END AS average,
  printf('| %-50s | %-38s | %-19s | %s | %3d | %3d |', name, description,
         strftime(make_timestamp(since * 1000), '%Y/%m/%d %H:%M:%S'),
         CASE WHEN usage = 0 THEN '     NaN' ELSE printf('%8.5f', duration / usage) END, "min", "max") AS line
FROM state
""",
    "remote_state": BASE
    + """
SELECT 'TensorFlow Model Serving' AS name, 'TensorFlow Model Serving' AS description, 2 AS model_type,
       CAST(0 AS BIGINT) AS since, CAST(count(*) AS BIGINT) AS usage, sum(duration) AS duration,
       CAST(min(duration) AS BIGINT) AS "min", CAST(max(duration) AS BIGINT) AS "max" FROM served
""",
    "decode_records": BASE
    + """
SELECT event_id AS record_id, data_type, ts, value, k FROM base WHERE event_type NOT IN ('signup', 'error')
""",
    "decode_or_default": BASE
    + """
SELECT b.event_id, CASE WHEN bad THEN 'Bad input record' ELSE l.name END AS name,
       CASE WHEN bad THEN '' ELSE b.data_type END AS data_type,
       CASE WHEN bad THEN 0 ELSE b.ts END AS submission_ts,
       round(CASE WHEN bad THEN 0 ELSE l.intercept + b.value * l.coef END, 6) AS result
FROM (SELECT *, event_type = 'error' AS bad FROM base WHERE event_type <> 'signup') b
JOIN latest l ON b.data_type = l.data_type
""",
    "decode_models": BASE
    + DOCUMENTS
    + """
SELECT name, 'linear document' AS description, data_type, model_kind,
       CASE WHEN model_kind = 2 THEN 'PMML' END AS kind,
       CAST(CASE WHEN k >= 50 THEN 0 ELSE strlen(payload) END AS BIGINT) AS bytes,
       CASE WHEN k >= 50 THEN 'models/' || name END AS location, ts FROM payloads WHERE k >= 10
""",
    "rejects": BASE
    + """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'record' ELSE 'model' END AS stream
FROM base WHERE event_type = 'error' OR (event_type = 'signup' AND k < 10)
""",
    "envelope_roundtrip": BASE
    + """
SELECT 'record' AS side, CAST(event_id AS VARCHAR) AS name, data_type, ts, round(value, 6) AS amount
FROM base WHERE event_type NOT IN ('signup', 'error')
UNION ALL
SELECT 'model', name, data_type, ts,
       CASE WHEN k < 50 AND CAST(k AS INTEGER) % 10 <> 0 THEN round(intercept + 2 * coef, 6) END
FROM models WHERE k >= 10
""",
    "csv_scan": """
SELECT CAST(p_partkey AS DOUBLE) AS part_key, CAST(p_size AS DOUBLE) AS "size", p_retailprice AS price,
       'part' AS data_type FROM part
""",
    "model_files": """
SELECT regexp_replace(p_brand, '[^0-9]', '', 'g') AS brand, true AS named, 'linear' AS form,
       CAST(count(*) AS DOUBLE) AS intercept, CAST(max(p_size) AS DOUBLE) AS coef FROM part GROUP BY p_brand
""",
    "publish_read": BASE
    + """
, bodies AS (
  SELECT event_id, event_type, '{"record_id":' || event_id || ',"data_type":"' || data_type || '","ts":' || ts || ',"features":['
         || CAST(value AS VARCHAR) || ',' || CAST(k AS VARCHAR) || ']}' AS body FROM base WHERE event_type <> 'signup'),
messages AS (SELECT event_id, CASE WHEN event_type = 'error' THEN substr(body, 1, 20) ELSE body END AS value FROM bodies)
SELECT CAST(event_id AS VARCHAR) AS key, CAST(strlen(value) AS BIGINT) AS bytes, sha256(value) AS digest FROM messages
""",
}
ORACLE["decode_records_sql"] = ORACLE["decode_records"]
ORACLE["score_dispatch_compiled"] = ORACLE["score_dispatch"]
ORACLE["csv_lines"] = """
SELECT CAST(p_partkey AS DOUBLE) AS part_key, CAST(p_size AS DOUBLE) AS "size", p_retailprice AS price, 'part' AS data_type,
       row_number() OVER (ORDER BY p_partkey) AS number, row_number() OVER (ORDER BY p_partkey DESC) AS from_end FROM part
"""
ORACLE["mlp_class_blocks"] = ORACLE["mlp_class"]
ORACLE["dense_argmax_blocks"] = ORACLE["dense_argmax"]
ORACLE["forest_class_blocks"] = ORACLE["forest_class"]
ORACLE["serve_blocks"] = RESULTS
ORACLE["network_versions"] = f"""
SELECT vec_id, 'mlp' AS version, result FROM ({ORACLE["mlp_class"]}) WHERE vec_id % 3 > 0
UNION ALL SELECT vec_id, 'dense' AS version, result FROM ({ORACLE["dense_argmax"]}) WHERE vec_id % 3 = 0
"""
_STEPS = """,
steps AS (SELECT data_type, ts, seq, name, [intercept / 2, intercept] AS knots, [0.5, 10 * coef, 100 * coef] AS levels FROM models)
"""
_LEVEL = "m.levels[1 + len([k FOR k IN m.knots IF k <= r.value])]"
ORACLE["own_kind_asof"] = (
    BASE
    + _STEPS
    + f"""
SELECT r.record_id, m.name, r.data_type, r.ts AS submission_ts, round({_LEVEL}, 6) AS result
FROM records r ASOF JOIN (SELECT data_type, ts, arg_max(name, seq) AS name, arg_max(knots, seq) AS knots,
  arg_max(levels, seq) AS levels FROM steps GROUP BY data_type, ts) m ON r.data_type = m.data_type AND r.ts >= m.ts
"""
)
ORACLE["own_kind_latest"] = (
    BASE
    + _STEPS
    + f"""
SELECT r.record_id, m.name, r.data_type, r.ts AS submission_ts, round({_LEVEL}, 6) AS result
FROM records r JOIN (SELECT data_type, arg_max(name, (ts, seq)) AS name, arg_max(knots, (ts, seq)) AS knots,
  arg_max(levels, (ts, seq)) AS levels FROM steps GROUP BY data_type) m ON r.data_type = m.data_type
"""
)

for _name in ("stream_keyed", "stream_recover", "stream_arrivals"):
    ORACLE[_name] = RESULTS
ORACLE["stream_broadcast"] = ORACLE["serve_broadcast"]
ORACLE["stream_stats"] = BASE + STATS + "SELECT * FROM by_model"
ORACLE["state_reader"] = (
    BASE + "SELECT data_type, name, since, round(intercept, 6) AS intercept, round(coef, 6) AS coef FROM latest"
)
ORACLE["stream_state_stats"] = (
    BASE
    + STATS
    + "SELECT s.* FROM by_model s JOIN latest l ON s.data_type = l.data_type AND s.name = l.name AND s.since = l.since"
)
ORACLE["stream_state_history"] = (
    BASE
    + """,
slices AS (
  SELECT i AS batch_id, first + (i + 1) * ((last - first) // 3 + 1) AS until
  FROM (SELECT min(ts) AS first, max(ts) AS last FROM base), range(3) r(i)),
newest AS (
  SELECT batch_id, until, data_type, arg_max(name, (ts, seq)) AS name, arg_max(ts, (ts, seq)) AS since
  FROM slices JOIN models ON ts < until GROUP BY batch_id, until, data_type)
SELECT CAST(batch_id AS BIGINT) AS batch_id, s.data_type, s.name, s.since, CAST(count(*) AS BIGINT) AS usage,
       sum(duration) AS duration, CAST(min(duration) AS BIGINT) AS "min", CAST(max(duration) AS BIGINT) AS "max"
FROM newest n JOIN served s ON s.data_type = n.data_type AND s.name = n.name AND s.since = n.since AND s.submission_ts < n.until
GROUP BY batch_id, s.data_type, s.name, s.since
"""
)
ORACLE["stream_state_lookup"] = ORACLE["state_lookup"]
ORACLE["stream_messages"] = (
    BASE
    + """,
arrived AS (SELECT data_type, ts, arg_max(name, seq) AS name, arg_max(intercept, seq) AS intercept,
                   arg_max(coef, seq) AS coef
            FROM models WHERE k >= 10 AND k < 50 AND CAST(k AS INTEGER) % 10 <> 0 GROUP BY data_type, ts)
SELECT r.record_id, m.name, r.data_type, r.ts AS submission_ts, round(m.intercept + r.value * m.coef, 6) AS result
FROM (SELECT event_id AS record_id, data_type, ts, value FROM base WHERE event_type NOT IN ('signup', 'error')) r
ASOF JOIN arrived m ON r.data_type = m.data_type AND r.ts >= m.ts
"""
)
ORACLE["serve_salted"] = ORACLE["serve_broadcast"]
