"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

# White space as Python's str methods see it, in RE2 syntax.
W = (
    r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)
# The white space the contract strips holds none of the separators U+001C..U+001F.
STAMP = "'%Y-%m-%d %H:%M:%S.%f'"


def stamp(expression: str) -> str:
    return f"strftime({expression}, {STAMP})"


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half away from zero."""
    return (
        f"(CASE WHEN ({numerator}) < 0 THEN -((2 * abs({numerator}) + {denominator}) // (2 * {denominator})) "
        f"ELSE (2 * ({numerator}) + {denominator}) // (2 * {denominator}) END)"
    )


# --- readings -----------------------------------------------------------------------------

WIRE = """
wire AS (
  SELECT event_id, ts, user_id, value, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
),
machines AS (SELECT DISTINCT 'M' || c_custkey AS machine_id FROM customer),
judged AS (
  SELECT w.*,
         k IN (5, 12) AS malformed,
         CASE WHEN k = 13 THEN 1.0 ELSE value END AS temperature_c,
         CASE WHEN k = 3 THEN 'GHOST_M' || user_id ELSE 'M' || user_id END AS machine_id,
         CASE WHEN k = 8 THEN date_trunc('second', ts) ELSE ts END AS recorded_at,
         CAST(event_id AS VARCHAR) AS reading_id
  FROM wire w
),
found AS (
  SELECT event_id, '' AS field, 'payload is not one JSON object' AS error FROM judged WHERE malformed
  UNION ALL SELECT event_id, 'reading_id', 'Input should be a valid string' FROM judged WHERE k = 7
  UNION ALL SELECT event_id, 'reading_id', 'String should have at least 1 character' FROM judged WHERE k = 9
  UNION ALL SELECT event_id, 'machine_id', 'Value error, unknown machine_id ''' || machine_id || ''''
    FROM judged WHERE NOT malformed AND machine_id NOT IN (SELECT machine_id FROM machines)
  UNION ALL SELECT event_id, 'temperature_c', 'Field required' FROM judged WHERE k = 1
  UNION ALL SELECT event_id, 'temperature_c', 'Input should be a valid number' FROM judged WHERE k = 11
  UNION ALL SELECT event_id, 'temperature_c',
      'Value error, temperature_c ' || CAST(temperature_c AS VARCHAR) || ' outside plausible range [-50, 200]'
    FROM judged WHERE NOT malformed AND k NOT IN (1, 11) AND NOT temperature_c BETWEEN -50 AND 200
  UNION ALL SELECT event_id, 'recorded_at',
      'Input should be a valid datetime or date, invalid character in year' FROM judged WHERE k = 2
  UNION ALL SELECT event_id, 'firmware', 'Extra inputs are not permitted' FROM judged WHERE k = 4
)
"""

REASON = "CASE WHEN malformed THEN 'malformed_json' ELSE 'schema_validation_failed' END"

PAYLOAD = """
payloads AS (
  SELECT j.event_id, malformed,
    '{"reading_id":' || CASE k WHEN 7 THEN reading_id WHEN 9 THEN '"  "'
        WHEN 10 THEN '" ' || reading_id || '\\t"' ELSE '"' || reading_id || '"' END
    || ',"machine_id":' || CASE k WHEN 3 THEN '"GHOST_' WHEN 10 THEN '"  ' ELSE '"' END || 'M' || user_id || '"'
    || CASE WHEN k = 1 THEN '' ELSE ',"temperature_c":' || CASE k WHEN 6 THEN '" ' || value || ' "'
        WHEN 11 THEN 'null' WHEN 13 THEN 'true' ELSE CAST(value AS VARCHAR) END END
    || ',"recorded_at":' || CASE k WHEN 2 THEN '"not-a-timestamp"'
        WHEN 8 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
        ELSE '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"' END
    || CASE WHEN k = 4 THEN ',"firmware":"v2"' ELSE '' END || '}' AS body, k
  FROM judged j
)
"""

READINGS = WIRE.rstrip() + ", " + """
readings AS MATERIALIZED (
  SELECT reading_id, machine_id, temperature_c, recorded_at, temperature_c > 85.0 AS is_anomaly,
         CAST(user_id % 4 AS INTEGER) AS kafka_partition, event_id AS kafka_offset,
         recorded_at + INTERVAL 1 HOUR AS ingested_at, event_type
  FROM judged WHERE event_id NOT IN (SELECT event_id FROM found)
),
corrections AS (
  SELECT reading_id, machine_id, temperature_c + 10 AS temperature_c, recorded_at,
         temperature_c + 10 > 85.0 AS is_anomaly, kafka_partition, kafka_offset,
         ingested_at + INTERVAL 1 HOUR AS ingested_at, event_type
  FROM readings WHERE event_type = 'error'
),
deliveries AS (SELECT * FROM readings UNION ALL SELECT * FROM corrections)
"""


def cleaned(source: str) -> str:
    """Silver rows of a Bronze-shaped relation."""
    return f"""(
  SELECT reading_id, upper(trim(machine_id)) AS machine_id, round(temperature_c, 2) AS temperature_c,
         recorded_at, CAST(recorded_at AS DATE) AS reading_date,
         CASE WHEN round(temperature_c, 2) > 85.0 THEN 'ANOMALY' ELSE 'NORMAL' END AS status,
         is_anomaly, ingested_at
  FROM (SELECT *, row_number() OVER (PARTITION BY reading_id
          ORDER BY kafka_offset DESC, ingested_at DESC) AS rn FROM {source})
  WHERE rn = 1)"""


SILVER_COLUMNS = f"""reading_id, machine_id, temperature_c, {stamp('recorded_at')} AS recorded_at,
  CAST(reading_date AS VARCHAR) AS reading_date, status, is_anomaly, {stamp('ingested_at')} AS ingested_at"""

CHANGES = f"""
changed AS (
  SELECT * FROM corrections UNION ALL
  SELECT * REPLACE ('N' || reading_id AS reading_id) FROM readings WHERE event_type = 'signup'
),
target AS (SELECT * FROM {cleaned('readings')}),
source AS (SELECT * FROM {cleaned('changed')}),
merged AS (SELECT * FROM target WHERE reading_id NOT IN (SELECT reading_id FROM source)
           UNION ALL SELECT * FROM source)
"""

# The corrections of the latest three days only.
LAST_DAYS = CHANGES.replace("""SELECT * FROM corrections UNION ALL
  SELECT * REPLACE ('N' || reading_id AS reading_id) FROM readings WHERE event_type = 'signup'""", """SELECT * FROM corrections
  WHERE CAST(recorded_at AS DATE) >= (SELECT max(CAST(recorded_at AS DATE)) - 2 FROM corrections)""")

GOLD = f"""
grouped AS (
  SELECT machine_id, reading_date, count(*) AS n, count(*) FILTER (is_anomaly) AS a,
         CAST(sum(CAST(round(temperature_c * 100) AS BIGINT)) AS BIGINT) AS s,
         max(CAST(round(temperature_c * 100) AS BIGINT)) AS hi,
         min(CAST(round(temperature_c * 100) AS BIGINT)) AS lo
  FROM {cleaned('readings')} GROUP BY ALL
),
gold AS (
  SELECT machine_id, reading_date, n AS readings, a AS anomaly_count,
         {half_up('s', 'n')} / 100.0 AS avg_temperature_c, hi / 100.0 AS max_temperature_c,
         lo / 100.0 AS min_temperature_c, {half_up('a * 10000', 'n')} / 10000.0 AS anomaly_rate,
         (hi - lo) / 100.0 AS temp_spread_c
  FROM grouped
)
"""


# --- quality ------------------------------------------------------------------------------


def check(number: int, kind: str, column: str | None, bad: str, source: str) -> str:
    """A report row whose check counts violating rows."""
    name = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return f"""SELECT {number} AS check_no, '{kind}' AS expectation, {name} AS "column",
      count(*) FILTER ({bad}) = 0 AS success, CAST(NULL AS VARCHAR) AS observed_value,
      count(*) FILTER ({bad}) AS unexpected_count FROM {source}"""


def known(number: int, kind: str, column: str | None, success: str, observed: str, source: str) -> str:
    """A report row answered by one observed value."""
    name = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    return f"""SELECT {number}, '{kind}', {name}, {success}, {observed}, CAST(NULL AS BIGINT) FROM {source}"""


def unique(number: int, columns: str, source: str) -> str:
    label = columns.replace(" ", "")
    return f"""SELECT {number}, 'expect_compound_columns_to_be_unique', '{label}',
      coalesce(sum(n) FILTER (n > 1), 0) = 0, CAST(NULL AS VARCHAR),
      CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT)
      FROM (SELECT count(*) AS n FROM {source} GROUP BY {columns})"""


NULL, SET = "expect_column_values_to_not_be_null", "expect_column_values_to_be_in_set"
RANGE, PAIR = "expect_column_values_to_be_between", "expect_column_pair_values_A_to_be_greater_than_B"
TYPE = "expect_column_values_to_be_of_type"
ALLOWED = "(SELECT 'M' || i FROM range(100) t(i))"
GOLD_COLUMNS = (
    "anomaly_count,anomaly_rate,avg_temperature_c,machine_id,max_temperature_c,"
    "min_temperature_c,reading_date,readings,temp_spread_c"
)
REPORT = " UNION ALL ".join(
    [
        check(3, NULL, "machine_id", "machine_id IS NULL", "gold"),
        check(4, NULL, "reading_date", "reading_date IS NULL", "gold"),
        check(5, NULL, "readings", "readings IS NULL", "gold"),
        check(6, NULL, "anomaly_rate", "anomaly_rate IS NULL", "gold"),
        check(7, SET, "machine_id", f"machine_id NOT IN {ALLOWED}", "gold"),
        check(10, RANGE, "readings", "readings < 1", "gold"),
        check(11, RANGE, "anomaly_count", "anomaly_count < 0", "gold"),
        check(12, RANGE, "avg_temperature_c", "avg_temperature_c NOT BETWEEN -50 AND 200", "gold"),
        check(13, PAIR, "max_temperature_c,min_temperature_c", "max_temperature_c < min_temperature_c", "gold"),
        check(14, RANGE, "anomaly_rate", "anomaly_rate NOT BETWEEN 0 AND 0.6", "gold"),
        known(1, "expect_table_columns_to_match_set", None, "true", f"'{GOLD_COLUMNS}'", "(SELECT 1)"),
        known(2, "expect_table_row_count_to_be_between", None, "n >= 1",
              "CAST(n AS VARCHAR)", "(SELECT count(*) AS n FROM gold)"),
        known(8, TYPE, "readings", "true", "'int64'", "(SELECT 1)"),
        unique(9, "machine_id, reading_date", "gold"),
    ]
)


# --- text ---------------------------------------------------------------------------------


def strip(text: str) -> str:
    return f"regexp_replace(regexp_replace({text}, '^{W}+', ''), '{W}+$', '')"


def split_sentences(text: str) -> str:
    """RE2 has no look-behind: mark the boundaries, then split at the mark."""
    return f"string_split(regexp_replace({strip(text)}, '([.!?]){W}+', '\\1' || chr(1), 'g'), chr(1))"


def chunk_rows(n: int, source: str = "documents") -> str:
    step = max(1, n - 1)
    return f"""(
  SELECT doc_id || '#c' || CASE WHEN i < 10 THEN '0' ELSE '' END || i AS id, CAST(doc_id AS VARCHAR) AS doc_id,
         source, CAST(i AS INTEGER) AS pos, doc_id AS doc_ord,
         {strip(f"array_to_string(s[i + 1 : i + {n}], ' ')")} AS text
  FROM (SELECT doc_id, source, s,
               unnest(range(0, CAST(ceil(greatest(len(s) - {n}, 0) / {step}) AS BIGINT) * {step} + 1, {step})) AS i
        FROM (SELECT doc_id, source, {split_sentences('text')} AS s FROM {source})))"""


CHUNKS = f"""
chunks AS MATERIALIZED (SELECT * FROM {chunk_rows(2)} WHERE text <> ''),
words AS MATERIALIZED (SELECT id, doc_ord, pos, unnest(list_filter(string_split_regex(lower(text), '{W}+'), lambda x: x <> '')) AS term
          FROM chunks),
tf AS MATERIALIZED (SELECT id, any_value(doc_ord) AS doc_ord, any_value(pos) AS pos, term, count(*) AS tf FROM words GROUP BY id, term),
dl AS (SELECT id, count(*) AS dl FROM words GROUP BY id),
totals AS (SELECT (SELECT count(*) FROM chunks) AS n, (SELECT count(*) FROM words) AS len),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
raw AS (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM df, totals),
idf AS (SELECT term, df, CASE WHEN idf < 0 THEN 0.25 * (SELECT avg(idf) FROM raw) ELSE idf END AS idf FROM raw)
"""


def bm25(queries: str) -> str:
    """CTEs ending in ``bm25_hits``; ``queries`` gives ``query_id, query``."""
    return f"""
asked AS ({queries}),
query_words AS (SELECT query_id, unnest(list_filter(string_split_regex(lower(query), '{W}+'), lambda x: x <> '')) AS term
                FROM asked),
qtf AS (SELECT query_id, term, count(*) AS qtf FROM query_words GROUP BY ALL),
scored AS (
  SELECT query_id, tf.id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / (len / n)))) AS score
  FROM qtf JOIN tf USING (term) JOIN idf USING (term) JOIN dl ON dl.id = tf.id, totals GROUP BY ALL
),
bm25_hits AS (
  SELECT query_id, id AS chunk_id, score, CAST(rn AS INTEGER) AS rank FROM (
    SELECT a.query_id, c.id, coalesce(s.score, 0) AS score,
           row_number() OVER (PARTITION BY a.query_id
             ORDER BY round(coalesce(s.score, 0), 9) DESC, doc_ord, pos) AS rn
    FROM asked a CROSS JOIN chunks c LEFT JOIN scored s ON s.query_id = a.query_id AND s.id = c.id)
  WHERE rn <= 8
)
"""


CHANGED_DOCUMENTS = """
changed_documents AS (
  SELECT doc_id, source, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND coalesce(toxic, 0) <> 1)
    THEN text || ' Checked twice.' ELSE text END AS text
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)
  UNION ALL SELECT item_id + 1000000000, 'benchmark', text FROM benchmark
)
"""

QUESTIONS = "SELECT item_id AS query_id, text AS query FROM benchmark"

# Hashed text vectors: 64 buckets from the first 32 bits of the MD5, weights 1 + ln(tf).
DENSE = """
chunk_weights AS (
  SELECT id, bucket, 1 + ln(count(*)) AS w FROM
    (SELECT id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64 AS bucket FROM words) GROUP BY ALL
),
chunk_vectors AS (
  SELECT id, bucket, w / norm AS w FROM chunk_weights
  JOIN (SELECT id, sqrt(sum(w * w)) AS norm FROM chunk_weights GROUP BY id) USING (id)
),
query_weights AS (
  SELECT query_id, bucket, 1 + ln(count(*)) AS w FROM
    (SELECT query_id, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 64 AS bucket FROM query_words) GROUP BY ALL
),
query_vectors AS (
  SELECT query_id, bucket, w / norm AS w FROM query_weights
  JOIN (SELECT query_id, sqrt(sum(w * w)) AS norm FROM query_weights GROUP BY query_id) USING (query_id)
),
products AS (
  SELECT query_id, id, sum(q.w * c.w) AS p FROM query_vectors q JOIN chunk_vectors c USING (bucket) GROUP BY ALL
),
dense_hits AS (
  SELECT query_id, id AS chunk_id, distance, CAST(rn AS INTEGER) AS rank FROM (
    SELECT a.query_id, c.id, 2 - 2 * coalesce(p, 0) AS distance,
           row_number() OVER (PARTITION BY a.query_id
             ORDER BY round(2 - 2 * coalesce(p, 0), 9), doc_ord, pos) AS rn
    FROM asked a CROSS JOIN chunks c LEFT JOIN products p ON p.query_id = a.query_id AND p.id = c.id)
  WHERE rn <= 8
)
"""

FUSED = """
ranks AS (
  SELECT query_id, chunk_id, min(d) AS d, min(b) AS b FROM (
    SELECT query_id, chunk_id, rank AS d, NULL AS b FROM dense_hits UNION ALL
    SELECT query_id, chunk_id, NULL, rank FROM bm25_hits) GROUP BY ALL
),
fused AS (
  SELECT query_id, chunk_id, score, CAST(rn AS INTEGER) AS rank, concat_ws(',', 'dense@' || d, 'bm25@' || b) AS retrieved_by
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, d NULLS LAST, b NULLS LAST) AS rn
        FROM (SELECT *, coalesce(1.0::DOUBLE / (d + 60), 0) + coalesce(1.0::DOUBLE / (b + 60), 0) AS score FROM ranks))
  WHERE rn <= 8
)
"""


def reranked(hits: str) -> str:
    return f"""
overlap AS (
  SELECT h.query_id, h.chunk_id, sum(idf) AS score FROM {hits} h
  JOIN qtf USING (query_id) JOIN tf ON tf.id = h.chunk_id AND tf.term = qtf.term
  JOIN idf ON idf.term = qtf.term GROUP BY ALL
),
reranked AS (
  SELECT query_id, chunk_id, score, CAST(rn AS INTEGER) AS rank FROM (
    SELECT h.query_id, h.chunk_id, coalesce(o.score, 0) AS score,
           row_number() OVER (PARTITION BY h.query_id ORDER BY round(coalesce(o.score, 0), 9) DESC, h.rank) AS rn
    FROM {hits} h LEFT JOIN overlap o ON o.query_id = h.query_id AND o.chunk_id = h.chunk_id)
  WHERE rn <= 4
)
"""


ANSWERS = f"""
pieces AS (
  SELECT query_id, chunk_rank, CAST(generate_subscripts(s, 1) - 1 AS INTEGER) AS pos, {strip('unnest(s)')} AS sentence
  FROM (SELECT r.query_id, r.rank AS chunk_rank, {split_sentences('c.text')} AS s
        FROM reranked r JOIN chunks c ON c.id = r.chunk_id)
),
firsts AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, print ORDER BY chunk_rank, pos) AS seen
  FROM (SELECT *, trim(regexp_replace(lower(sentence), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) AS print
        FROM pieces WHERE sentence <> '')
),
sentence_words AS (
  SELECT DISTINCT query_id, chunk_rank, pos, unnest(string_split_regex(lower(sentence), '{W}+')) AS term
  FROM firsts WHERE seen = 1
),
sentence_scores AS (
  SELECT query_id, chunk_rank, pos, sum(idf) AS score
  FROM sentence_words JOIN qtf USING (query_id, term) JOIN idf USING (term) GROUP BY ALL
),
chosen AS (
  SELECT f.query_id, f.chunk_rank, sentence,
         row_number() OVER (PARTITION BY f.query_id
           ORDER BY round(coalesce(score, 0), 9) DESC, f.chunk_rank, f.pos) AS place
  FROM firsts f LEFT JOIN sentence_scores s
    ON s.query_id = f.query_id AND s.chunk_rank = f.chunk_rank AND s.pos = f.pos
  WHERE seen = 1
),
composed AS (
  SELECT query_id, string_agg(
      CASE WHEN sentence LIKE '%.' THEN left(sentence, -1) || ' [Source ' || chunk_rank || '].'
           ELSE sentence || ' [Source ' || chunk_rank || ']' END, ' ' ORDER BY place) AS answer
  FROM chosen WHERE place <= 3 GROUP BY query_id
),
replies AS (
  SELECT a.query_id, coalesce(answer, 'The retrieved context does not contain this information.') AS answer
  FROM asked a LEFT JOIN composed USING (query_id)
),
cited AS (
  SELECT r.query_id, string_agg(k.chunk_id, ',' ORDER BY k.rank) AS retrieved,
         coalesce(string_agg(k.chunk_id, ',' ORDER BY k.rank)
           FILTER (contains(answer, '[Source ' || k.rank || ']')), '') AS cited
  FROM replies r JOIN reranked k USING (query_id) GROUP BY r.query_id
)
"""

RETRIEVAL = ", ".join([CHUNKS, bm25(QUESTIONS), DENSE, FUSED, reranked("fused")])

PROMPT = (
    "Your task is to explain sensor readings to the people who run the machines. "
    "Answer ONLY from the context below. Cite every claim with the matching [Source N] marker. "
    "If the context does not contain the answer, reply exactly: "
    "''The retrieved context does not contain this information.''"
)

KPI_DOCUMENTS = """
kpi_docs AS (
  SELECT 'gold_' || machine_id || '_' || reading_date AS id,
    'delta://gold/machine_daily_kpi/' || machine_id || '/' || reading_date AS source,
    'On ' || reading_date || ', machine ' || machine_id || ' reported ' || readings || ' temperature readings. '
    || anomaly_count || ' of them were anomalies, an anomaly rate of ' || anomaly_rate
    || '. The average temperature was ' || avg_temperature_c || ' degrees Celsius, ranging from '
    || min_temperature_c || ' to ' || max_temperature_c || ', a thermal spread of ' || temp_spread_c
    || ' degrees.' AS text,
    machine_id || '|' || reading_date AS ord_key
  FROM gold
)
"""

RUNS = """
run_events AS (
  SELECT 'START' AS type, ts AS happened, 'run-' || event_id AS run_id, 'M' || user_id AS job_name, NULL AS message,
         json_extract_string(props, '$.k') = '1' AS no_producer FROM events
  UNION ALL
  SELECT CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'COMPLETE' END,
         make_timestamp(epoch_us(ts) + CAST(round(value * 1000) AS BIGINT) * 1000),
         'run-' || event_id, 'M' || user_id,
         CASE WHEN event_type = 'error' THEN 'RuntimeError: value ' || value END,
         json_extract_string(props, '$.k') = '1'
  FROM events WHERE event_type <> 'signup'
)
"""


def with_(ctes: list[str], body: str) -> str:
    return "WITH " + ", ".join(c.strip() for c in ctes) + " " + body


def _required(field: str, missing: str) -> str:
    return (
        f"SELECT '{field}' AS field, count(*) AS events, count(*) FILTER ({missing}) AS missing, "
        f"count(*) FILTER ({missing}) = 0 AS conforms FROM run_events"
    )


REPEATED = """
repeated AS (SELECT machine_id, reading_date FROM gold GROUP BY ALL HAVING count(*) > 1)
"""


def _sample(number: int, value: str, bad: str, source: str = "gold") -> str:
    return (
        f"SELECT {number} AS check_no, value FROM (SELECT {value} AS value FROM {source} AS g WHERE {bad} "
        f"ORDER BY machine_id, g.reading_date LIMIT 20)"
    )


ORACLES: dict[str, str] = {
    "contract_accepted": with_([WIRE], f"""
        SELECT reading_id, machine_id, temperature_c, {stamp('recorded_at')} AS recorded_at,
          temperature_c > 85.0 AS is_anomaly, CAST(user_id % 4 AS INTEGER) AS kafka_partition,
          event_id AS kafka_offset
        FROM judged WHERE event_id NOT IN (SELECT event_id FROM found)"""),
    "contract_rejected": with_([WIRE], f"""
        SELECT f.event_id AS kafka_offset, any_value({REASON}) AS rejection_reason,
          string_agg(field || ': ' || error, '; ' ORDER BY field || ': ' || error) AS problems
        FROM found f JOIN judged j USING (event_id) GROUP BY f.event_id"""),
    "dead_letters": with_([WIRE, PAYLOAD], f"""
        SELECT 'readings' AS source_topic, {REASON} AS rejection_reason,
          CAST(n AS INTEGER) AS errors, CASE k WHEN 5 THEN left(body, -1) WHEN 12 THEN '[' || body || ']'
            ELSE body END AS original_payload
        FROM payloads JOIN (SELECT event_id, count(*) AS n FROM found GROUP BY event_id) USING (event_id)"""),
    "contract_error_counts": with_([WIRE], f"""
        SELECT {REASON} AS rejection_reason, field, count(*) AS errors
        FROM found JOIN judged USING (event_id) GROUP BY ALL"""),
    "contract_routing_counts": with_([WIRE], """
        SELECT count(*) FILTER (event_id NOT IN (SELECT event_id FROM found)) AS accepted,
          count(*) FILTER (event_id IN (SELECT event_id FROM found)) AS rejected FROM judged"""),
    "bronze_rows": with_([READINGS], f"""
        SELECT reading_id, machine_id, temperature_c, {stamp('recorded_at')} AS recorded_at, is_anomaly,
          kafka_partition, kafka_offset, {stamp('ingested_at')} AS ingested_at FROM readings"""),
    "bronze_appended": with_([READINGS], f"""
        SELECT reading_id, machine_id, temperature_c, {stamp('recorded_at')} AS recorded_at, is_anomaly,
          kafka_partition, kafka_offset FROM readings"""),
    "distinct_keys_by_range": with_([READINGS], """
        SELECT strftime(date_trunc('week', recorded_at), '%Y-%m-%d') AS week, count(DISTINCT reading_id) AS exact, true AS within
        FROM deliveries GROUP BY 1"""),
    "kpi_after_changes": with_([READINGS, CHANGES, GOLD.replace(cleaned("readings"), "merged")],
        "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM gold"),
    "unchanged_days": with_([READINGS, LAST_DAYS], """
        SELECT CAST(reading_date AS VARCHAR) AS reading_date, count(*) AS readings FROM merged
        WHERE reading_date NOT IN (SELECT reading_date FROM source) GROUP BY merged.reading_date"""),
    "gold_overwritten": with_([READINGS, GOLD], """
        SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date), CAST(2 AS INTEGER) AS operations FROM gold"""),
    "gate_incremental": with_([READINGS, LAST_DAYS, GOLD.replace(cleaned("readings"), "merged")], REPORT),
    "silver_latest": with_([READINGS], f"SELECT {SILVER_COLUMNS} FROM {cleaned('deliveries')}"),
    "silver_status": with_([READINGS], f"""
        SELECT status, is_anomaly, count(*) AS readings FROM {cleaned('deliveries')} GROUP BY ALL"""),
    "silver_touched": with_([READINGS], f"""
        SELECT {SILVER_COLUMNS} FROM {cleaned('deliveries')}
        WHERE reading_id IN (SELECT reading_id FROM corrections)"""),
    "silver_incremental": with_([READINGS], f"""
        SELECT {SILVER_COLUMNS} FROM {cleaned('deliveries')}
        WHERE reading_id IN (SELECT reading_id FROM corrections)"""),
    "silver_upsert": with_([READINGS, CHANGES], f"SELECT {SILVER_COLUMNS} FROM merged"),
    "silver_rewritten": with_([READINGS], f"""
        , changed AS (SELECT * FROM corrections
          WHERE CAST(recorded_at AS DATE) >= (SELECT max(CAST(recorded_at AS DATE)) - 2 FROM corrections)),
        target AS (SELECT * FROM {cleaned('readings')}), source AS (SELECT * FROM {cleaned('changed')})
        SELECT CAST(reading_date AS VARCHAR) AS reading_date, count(*) AS readings,
          bool_or(reading_id IN (SELECT reading_id FROM source)) AS rewritten
        FROM target GROUP BY target.reading_date""".strip()),
    "rejected_write": with_([READINGS], f"""
        SELECT 'temperature_c: string instead of double' AS problem, count(*) AS rows_after, 1::BIGINT AS operations
        FROM {cleaned('readings')}"""),
    "upsert_metrics": with_([READINGS, CHANGES], """
        SELECT 'merge' AS operation, (SELECT count(*) FROM target) AS rows_before,
          count(*) FILTER (reading_id IN (SELECT reading_id FROM target)) AS rows_updated,
          count(*) FILTER (reading_id NOT IN (SELECT reading_id FROM target)) AS rows_inserted,
          (SELECT count(*) FROM merged) AS rows_after FROM source"""),
    "upsert_diff": with_([READINGS, CHANGES], """
        SELECT reading_id, b.temperature_c AS before_temperature_c, b.status AS before_status,
          a.temperature_c AS after_temperature_c, a.status AS after_status,
          CASE WHEN b.temperature_c IS NULL THEN 'inserted' ELSE 'updated' END AS change
        FROM target b FULL JOIN merged a USING (reading_id)
        WHERE b.temperature_c IS DISTINCT FROM a.temperature_c OR b.status IS DISTINCT FROM a.status"""),
    "distinct_keys": with_([READINGS], """
        SELECT count(*) AS row_count, count(DISTINCT reading_id) AS distinct_keys FROM deliveries"""),
    "key_lookup": with_([READINGS], f"""
        SELECT reading_id, machine_id, temperature_c, {stamp('recorded_at')} AS recorded_at, is_anomaly,
          kafka_partition, kafka_offset, {stamp('ingested_at')} AS ingested_at
        FROM readings WHERE reading_id = '7'"""),
    "kpi_daily": with_([READINGS, GOLD], "SELECT * REPLACE (CAST(reading_date AS VARCHAR) AS reading_date) FROM gold"),
    "kpi_reduction_check": with_([READINGS, GOLD], """
        SELECT s AS silver_rows, g AS gold_rows, g < s AS is_reduced FROM
          (SELECT count(DISTINCT reading_id) AS s FROM readings), (SELECT count(*) AS g FROM gold)"""),
    "schema_check": with_([READINGS], f"""
        SELECT count(*) AS rows_refused, 'temperature_c: string instead of double' AS problem
        FROM {cleaned('readings')}"""),
    "gate_report": with_([READINGS, GOLD], REPORT),
    "gate_summary": with_([READINGS, GOLD, f"report AS ({REPORT})"], """
        SELECT bool_and(success) AS success, count(*) AS expectations_evaluated,
          count(*) FILTER (success) AS expectations_passed,
          count(*) FILTER (NOT success) AS expectations_failed,
          round(100.0 * count(*) FILTER (success) / count(*), 2) AS success_percent,
          (SELECT count(*) FROM gold) AS gold_rows, 0.6::DOUBLE AS max_anomaly_rate_allowed,
          (SELECT max(anomaly_rate) FROM gold) AS observed_max_anomaly_rate FROM report"""),
    "gate_failed_checks": with_([READINGS, GOLD, REPEATED], " UNION ALL ".join([
        _sample(3, "CAST(machine_id AS VARCHAR)", "machine_id IS NULL"),
        _sample(4, "CAST(reading_date AS VARCHAR)", "reading_date IS NULL"),
        _sample(5, "CAST(readings AS VARCHAR)", "readings IS NULL"),
        _sample(6, "CAST(anomaly_rate AS VARCHAR)", "anomaly_rate IS NULL"),
        _sample(7, "CAST(machine_id AS VARCHAR)", f"machine_id NOT IN {ALLOWED}"),
        _sample(9, "machine_id || ',' || reading_date", "true", "repeated"),
        _sample(10, "CAST(readings AS VARCHAR)", "readings < 1"),
        _sample(11, "CAST(anomaly_count AS VARCHAR)", "anomaly_count < 0"),
        _sample(12, "CAST(avg_temperature_c AS VARCHAR)", "avg_temperature_c NOT BETWEEN -50 AND 200"),
        _sample(13, "max_temperature_c || ',' || min_temperature_c", "max_temperature_c < min_temperature_c"),
        _sample(14, "CAST(anomaly_rate AS VARCHAR)", "anomaly_rate NOT BETWEEN 0 AND 0.6"),
    ])),
    "gate_quarantine": with_([READINGS, GOLD], f"""
        SELECT * FROM (SELECT machine_id, CAST(reading_date AS VARCHAR) AS reading_date, anomaly_rate,
          concat_ws(';', CASE WHEN machine_id NOT IN {ALLOWED} THEN '{SET}(machine_id)' END,
            CASE WHEN anomaly_rate > 0.6 THEN '{RANGE}(anomaly_rate)' END) AS violations FROM gold)
        WHERE violations <> ''"""),
    "label_checks": with_(["labelled AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))"], " UNION ALL ".join([
        check(1, NULL, "doc_id", "doc_id IS NULL", "labelled"),
        check(2, NULL, "quality", "quality IS NULL", "labelled"),
        check(3, SET, "quality", "quality <> 1", "labelled"),
        check(4, SET, "toxic", "toxic NOT IN (0, 1)", "labelled"),
        check(5, RANGE, "n_chars", "n_chars NOT BETWEEN 20 AND 5000", "labelled"),
        unique(6, "doc_id", "labelled"),
        check(7, PAIR, "quality,toxic", "quality < toxic", "labelled"),
    ])),
    "order_checks": " UNION ALL ".join([
        check(1, NULL, "o_orderkey", "o_orderkey IS NULL", "orders"),
        check(2, SET, "o_orderstatus", "o_orderstatus NOT IN ('F', 'O')", "orders"),
        check(3, RANGE, "o_totalprice", "o_totalprice NOT BETWEEN 1000 AND 450000", "orders"),
        known(4, TYPE, "o_orderkey", "true", "'int64'", "(SELECT 1)"),
        unique(5, "o_orderkey", "orders"),
    ]),
    "compound_dups": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "lineitem_checks": " UNION ALL ".join([
        check(2, PAIR, "l_extendedprice,l_quantity", "l_extendedprice <= l_quantity", "lineitem"),
        check(3, RANGE, "l_discount", "l_discount NOT BETWEEN 0 AND 0.05", "lineitem"),
        unique(1, "l_orderkey, l_linenumber", "lineitem"),
    ]),
    "kpi_documents": with_([READINGS, GOLD, KPI_DOCUMENTS], "SELECT id, source, text FROM kpi_docs"),
    "corpus_union": with_([READINGS, GOLD, KPI_DOCUMENTS], """
        SELECT CAST(doc_id AS VARCHAR) AS id, source, text, '0|' || lpad(CAST(CAST(doc_id AS HUGEINT) + 9223372036854775808 AS VARCHAR), 20, '0') AS ord_key
        FROM documents UNION ALL SELECT id, source, text, '1|' || ord_key FROM kpi_docs"""),
    "chunks": f"SELECT id, doc_id, source, pos, text FROM {chunk_rows(2)} WHERE text <> ''",
    "chunks_of_three": f"SELECT id, doc_id, source, pos, text FROM {chunk_rows(3)} WHERE text <> ''",
    "chunk_counts": f"SELECT doc_id, count(*) AS chunk_count FROM {chunk_rows(2)} WHERE text <> '' GROUP BY doc_id",
    "term_stats": f"""
        WITH chunk AS MATERIALIZED (SELECT id, text FROM {chunk_rows(2)} WHERE text <> ''),
        word AS MATERIALIZED (
          SELECT id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '{W}+'), lambda x: x <> ''))) AS term
          FROM chunk),
        df AS MATERIALIZED (SELECT term, count(*) AS df FROM word GROUP BY term),
        size AS MATERIALIZED (SELECT count(*) AS n FROM chunk),
        raw AS MATERIALIZED (SELECT term, df, ln(n - df + 0.5) - ln(df + 0.5) AS idf FROM df, size),
        mean AS MATERIALIZED (SELECT avg(idf) AS mean_idf FROM raw)
        SELECT term, df, round(CASE WHEN idf < 0 THEN 0.25 * mean_idf ELSE idf END, 6) AS idf FROM raw, mean""",
    "postings": with_([CHUNKS], """
        SELECT term, id, CAST(tf AS INTEGER) AS tf, CAST(dl AS INTEGER) AS dl FROM tf JOIN dl USING (id)"""),
    "bm25_topk": with_([CHUNKS, bm25(QUESTIONS)], """
        SELECT query_id, rank, chunk_id, round(score, 4) AS bm25_score FROM bm25_hits"""),
    "index_after_changes": with_([CHANGED_DOCUMENTS, CHUNKS.replace(chunk_rows(2), chunk_rows(2, "changed_documents")), bm25(QUESTIONS)], """
        SELECT query_id, rank, chunk_id, round(score, 4) AS bm25_score FROM bm25_hits"""),
    "bm25_work": "SELECT true AS fewer_blocks, true AS fewer_postings",
    "conversation_topk": with_([CHUNKS, bm25(
        "SELECT conv_id || '-' || turn AS query_id, text AS query FROM conversations")], """
        SELECT query_id, rank, chunk_id, round(score, 4) AS bm25_score FROM bm25_hits"""),
    "dense_topk": """
        WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
        SELECT query_id, CAST(rn AS INTEGER) AS rank, CAST(id AS VARCHAR) AS chunk_id, abs(round(d, 4)) AS distance FROM (
          SELECT query_id, id, d, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), id) AS rn FROM (
            SELECT q.vec_id AS query_id, x.vec_id AS id,
              greatest(list_dot_product(q.e, q.e) + list_dot_product(x.e, x.e) - 2 * list_dot_product(q.e, x.e), 0) AS d
            FROM v q CROSS JOIN v x)) WHERE rn <= 8""",
    "dense_work": "SELECT count(*) * count(*) AS pairs, true AS fewer_distances FROM embeddings",
    "dense_ann_recall": """
        SELECT n * least(n, 8) AS exact_hits, true AS recall_reached, true AS fewer_distances
        FROM (SELECT count(*) AS n FROM embeddings)""",
    "dense_text_topk": with_([CHUNKS, bm25(QUESTIONS), DENSE], """
        SELECT query_id, rank, chunk_id, round(distance, 4) AS distance FROM dense_hits"""),
    "rrf_fused": with_([CHUNKS, bm25(QUESTIONS), DENSE, FUSED], """
        SELECT query_id, rank, chunk_id, round(score, 6) AS rrf_score, retrieved_by FROM fused"""),
    "funnel": with_([RETRIEVAL], """
        SELECT s.*, c.source FROM (
        SELECT query_id, 'dense' AS stage, rank, chunk_id, round(distance, 4) AS score, CAST(NULL AS VARCHAR) AS retrieved_by
        FROM dense_hits UNION ALL
        SELECT query_id, 'bm25', rank, chunk_id, round(score, 4), NULL FROM bm25_hits UNION ALL
        SELECT query_id, 'fused', rank, chunk_id, round(score, 6), retrieved_by FROM fused UNION ALL
        SELECT query_id, 'reranked', rank, chunk_id, round(score, 4), NULL FROM reranked) s
        JOIN chunks c ON c.id = s.chunk_id"""),
    "rerank_topk": with_([CHUNKS, bm25(QUESTIONS), reranked("bm25_hits")], """
        SELECT query_id, rank, chunk_id, round(score, 4) AS score FROM reranked"""),
    "context_block": with_([RETRIEVAL], f"""
        SELECT query_id, block AS context_block,
          '{PROMPT}' || chr(10) || chr(10) || 'CONTEXT:' || chr(10) || block || chr(10) || chr(10)
            || 'QUESTION: ' || query || chr(10) || chr(10) || 'ANSWER:' AS prompt
        FROM (SELECT r.query_id, string_agg('[Source ' || r.rank || '] ' || c.text, chr(10) || chr(10) ORDER BY r.rank) AS block
              FROM reranked r JOIN chunks c ON c.id = r.chunk_id GROUP BY r.query_id) JOIN asked USING (query_id)"""),
    "answers": with_([RETRIEVAL, ANSWERS], """
        SELECT query_id, 'extractive' AS backend, answer, cited, retrieved, cited <> '' AS grounded
        FROM replies JOIN cited USING (query_id)"""),
    "citation_audit": with_([RETRIEVAL, ANSWERS], """
        SELECT query_id, CAST(NULL AS VARCHAR) AS chunk_id, 'no citation' AS problem FROM cited WHERE cited = ''"""),
    "run_status": with_([RUNS], f"""
        SELECT run_id, job_name,
          CASE WHEN count(*) FILTER (type = 'FAIL') > 0 THEN 'FAIL'
               WHEN count(*) FILTER (type = 'COMPLETE') > 0 THEN 'COMPLETE' ELSE 'OPEN' END AS status,
          {stamp("min(happened) FILTER (type = 'START')")} AS started_at,
          {stamp("max(happened) FILTER (type <> 'START')")} AS ended_at,
          (epoch_us(max(happened) FILTER (type <> 'START')) - epoch_us(min(happened) FILTER (type = 'START'))) // 1000 AS duration_ms
        FROM run_events GROUP BY run_id, job_name"""),
    "gate_outcome": with_([READINGS, GOLD, f"report AS ({REPORT})"], """
        SELECT count(*) FILTER (NOT success) > 0 AS refused, count(*) FILTER (NOT success) || ' of ' || count(*)
          || ' expectations did not pass' AS reason, 0 AS rows_published FROM report"""),
    "forged_citations": with_([RETRIEVAL, ANSWERS], """
        SELECT query_id, 'forged#c00' AS chunk_id, 'not retrieved' AS problem FROM cited WHERE cited <> ''
        UNION ALL SELECT query_id, NULL, 'no citation' FROM cited WHERE cited = ''"""),
    "logged_run_status": with_([RUNS], """
        SELECT status, count(*) AS runs, CAST(sum(ms) AS BIGINT) AS total_ms FROM (
          SELECT run_id, CASE WHEN count(*) FILTER (type = 'FAIL') > 0 THEN 'FAIL'
               WHEN count(*) FILTER (type = 'COMPLETE') > 0 THEN 'COMPLETE' ELSE 'OPEN' END AS status,
            (epoch_us(max(happened) FILTER (type <> 'START')) - epoch_us(min(happened) FILTER (type = 'START'))) // 1000 AS ms
          FROM run_events GROUP BY run_id) GROUP BY status"""),
    "run_errors": with_([RUNS], """
        SELECT run_id, job_name, message, 'PYTHON' AS programming_language FROM run_events WHERE type = 'FAIL'"""),
    "event_conformance": with_([RUNS], " UNION ALL ".join([
        _required("eventType", "type IS NULL"), _required("eventTime", "happened IS NULL"),
        _required("run.runId", "run_id IS NULL"), _required("job.namespace", "false"),
        _required("job.name", "job_name IS NULL"), _required("producer", "no_producer"),
    ])),
    "events_pivot": with_([RUNS], """
        SELECT job_name, count(*) FILTER (type = 'START') AS start, count(*) FILTER (type = 'COMPLETE') AS complete,
          count(*) FILTER (type = 'FAIL') AS fail FROM run_events GROUP BY job_name"""),
}
