"""SQL texts of the views over the driver tables, shared by the comparison queries."""

from __future__ import annotations

import math

from fathomline.functions import normal

STATION_HOURLY = """station_hourly AS (
  SELECT event_type AS city, ts AS time, value AS pm25, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS pm10,
         event_id
  FROM events)"""

CITY_DAILY = """city_daily AS (
  SELECT n_name AS city, r_name AS "group", CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) / 1000 AS pm25
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
  GROUP BY ALL)"""

WEATHER_DAILY = """weather_daily AS (
  SELECT n_name AS city, CAST(l_shipdate AS DATE) AS date, avg(l_discount) * 100 AS tmean,
         max(l_discount) * 100 AS tmax, min(l_discount) * 100 AS tmin, sum(l_quantity) AS precip
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL)"""

CITY_MONTHS = """city_months AS (
  SELECT city, "group", CAST(date_trunc('month', date) AS DATE) AS ym, avg(pm25) AS pm25, avg(tmean) AS tmean,
         sum(precip) AS precip
  FROM city_daily JOIN weather_daily USING (city, date) GROUP BY ALL)"""

EXPERIMENT_UNITS = """experiment_units AS (
  SELECT c_custkey AS unit, c_mktsegment AS segment,
         CASE WHEN ('0x' || substr(md5('42|' || c_custkey), 1, 8))::BIGINT % 2 = 0 THEN 'A' ELSE 'B' END AS arm,
         CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000
                             AND year(o_orderdate) = 1998) THEN 1 ELSE 0 END AS converted
  FROM customer)"""

CORPUS = """corpus AS (SELECT source || '/' || lang || '/' || doc_id AS doc, text FROM documents)"""

QUERIES = """queries AS (SELECT item_id AS query_id, text AS query FROM benchmark)"""

CASES = """cases AS (
  SELECT item_id AS query_id, text AS query, text AS keyword,
         ['/en/', 'src1', 'src' || (item_id % 10) || '/', 'src99/'] AS relevant_docs FROM benchmark)"""

TURN_DOCUMENTS = """turn_documents AS (
  SELECT 'conv-' || conv_id || '-' || turn AS doc,
         'Note before any heading, on turn ' || turn || E' of this conversation.\\n'
         || '# conversation ' || conv_id || E'\\n## ' || role || ' ' || turn || E'\\n' || text
         || E'\\n\\n#### size\\n<b>this turn holds ' || length(text)
         || E' characters</b> in one message\\n## empty\\n\\n### <i>again</i>\\n' || text || E'\\n \\n' || text
         || E'\\n\\nEnd of turn.\\n' AS text
  FROM conversations)"""

LANDED = """landed AS (
  SELECT page_id, url, page_id AS fetched_at, html AS payload FROM pages
  UNION ALL
  SELECT page_id, url, page_id + 1000000, html || '<!-- again -->' FROM pages WHERE page_id % 2 = 0)"""

EMBEDDING_FEATURES = """feature_rows AS (
  SELECT vec_id AS row_id, label, CAST(embedding AS DOUBLE[]) AS features FROM embeddings)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def tokens_sql(text: str) -> str:
    """Tokens of a text whose only Han run is the section name of an opening (the driver tables hold none)."""
    return f"regexp_extract_all(lower({text}), '[a-z0-9]+|简介')"


def _polynomial(coefficients: list[float], x: str) -> str:
    text = f"CAST({coefficients[0]!r} AS DOUBLE)"
    for c in coefficients[1:]:
        text = f"({text} * {x} + CAST({c!r} AS DOUBLE))"
    return text


def two_sided_p_sql(z: str) -> str:
    """Two-sided normal p of an expression, with the same published approximation the library uses."""
    x = f"(abs({z}) / {math.sqrt(2)!r}::DOUBLE)"
    sq, inv = f"({x} * {x})", f"(1.0::DOUBLE / ({x} * {x}))"
    inner = f"1 - {x} * {_polynomial(normal.ERF_NUM, sq)} / {_polynomial(normal.ERF_DEN, sq)}"
    middle = f"exp(-{sq}) * {_polynomial(normal.MID_NUM, x)} / {_polynomial(normal.MID_DEN, x)}"
    outer = (f"exp(-{sq}) * ({1 / math.sqrt(math.pi)!r}::DOUBLE - {inv} * {_polynomial(normal.TAIL_NUM, inv)}"
             f" / {_polynomial(normal.TAIL_DEN, inv)}) / {x}")
    return f"(CASE WHEN {x} <= 0.46875 THEN {inner} WHEN {x} <= 4 THEN {middle} ELSE {outer} END)"


def normal_cdf_sql(z: str) -> str:
    return f"(CASE WHEN {z} < 0 THEN {two_sided_p_sql(z)} / 2 ELSE 1 - {two_sided_p_sql(z)} / 2 END)"
