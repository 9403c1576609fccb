"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Only the test tables are views; the derived inputs are re-declared here as
CTEs with the same definitions as ``tessera.sources.derived``.  Double
constants are written as ``CAST('<repr>' AS DOUBLE)`` so both engines use
bit-identical values; integer sums are exact (HUGEINT) and divided once.
"""

from __future__ import annotations

from ..functions import colour as C
from ..functions.logs import LOG_PATTERN
from ..functions.random import TWO_52
from ..functions.stats import DIGITS
from ..functions.text import FINAL_SIGMA, DELIM_RUN, HOUR_PATH_PATTERN, LINE_BREAK, PUNCT_CLASS, SPACE_RUN, special_folds
from ..operators.sampling import MAX_DRAWS
from ..sources import derived as V
from . import queries as Q


def D(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def fold(expr: str) -> str:
    """Python's ``upper().lower()``."""
    for char, to in special_folds():
        expr = f"replace({expr}, '{char}', '{to}')"
    sigma = FINAL_SIGMA.replace("'", "''")
    return f"regexp_replace(lower(upper({expr})), '{sigma}', '\\1ς\\2', 'g')"


def significant(expr: str) -> str:
    return f"(CAST(printf('%.{DIGITS - 1}e', {expr}) AS DOUBLE) + {D(0.0)})"


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
CENTS = "CAST(round({c} * 100) AS BIGINT)"


def mean_cents(c: str) -> str:
    return f"CAST(sum({c}) AS DOUBLE) / count({c}) / {D(100.0)}"


OBSERVATIONS = f"""observations AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS station, CAST(ts AS DATE) AS date,
         CASE WHEN event_type = '{V.TMAX_EVENT}' THEN 'TMAX'
              WHEN event_type = '{V.TMIN_EVENT}' THEN 'TMIN' ELSE event_type END AS observation,
         CAST(floor(value * 10) AS INTEGER) AS value,
         CASE WHEN {K} % {V.QFLAG_EVERY} = 0 THEN 'X' END AS qflag
  FROM events)"""

PAGES = f"""pages AS (
  SELECT strftime(ts, '%Y%m%d-%H') AS hour, event_type AS language,
         'P' || CAST(user_id AS VARCHAR) AS title, CAST(floor(value) AS BIGINT) AS views
  FROM events),
fp AS (SELECT * FROM pages WHERE language = '{Q.PAGE_LANGUAGE}' AND title <> '{Q.MAIN_PAGE}'
       AND NOT starts_with(title, '{Q.SPECIAL_PREFIX}')),
maxima AS (SELECT hour AS g, max(views) AS m FROM fp GROUP BY hour),
ties AS (SELECT fp.hour, fp.title, fp.views FROM fp JOIN maxima ON fp.hour = maxima.g AND fp.views = maxima.m)"""

LOGS = f"""lines AS (
  SELECT event_id AS line_no,
         'h' || CAST(user_id AS VARCHAR) || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S')
         || ' -0700] "GET /' || event_type || ' HTTP/1.0" 200 '
         || CASE WHEN {K} % {V.BAD_LINE_EVERY} = 0 THEN '-'
                 ELSE CAST({CENTS.format(c='value')} AS VARCHAR) END AS line
  FROM events),
parsed AS (
  SELECT line_no, line, regexp_extract(line, '{LOG_PATTERN}', 1) AS host,
         try_strptime(regexp_extract(line, '{LOG_PATTERN}', 2), '%d/%b/%Y:%H:%M:%S') AS datetime,
         regexp_extract(line, '{LOG_PATTERN}', 3) AS path,
         TRY_CAST(regexp_extract(line, '{LOG_PATTERN}', 4) AS BIGINT) AS bytes
  FROM lines WHERE regexp_matches(line, '{LOG_PATTERN}')),
logs AS (
  SELECT host, datetime, path, bytes, sha256(CAST(line_no AS VARCHAR) || '|' || line) AS id
  FROM parsed WHERE datetime IS NOT NULL AND bytes IS NOT NULL),
totals AS (SELECT host, count(*) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes FROM logs GROUP BY host)"""

EDGES = f"""edges AS (
  SELECT DISTINCT l_partkey AS source, l_orderkey % (SELECT count(*) FROM part) AS node
  FROM lineitem)"""

FLAGS = f"""vprefixes AS (
  SELECT DISTINCT substring(n_name, 1, {Q.PREFIX_LEN}) AS vp FROM nation WHERE n_regionkey = {Q.FLAG_REGION}),
flags AS (
  SELECT c_custkey, CASE WHEN vp IS NULL THEN 0 ELSE 1 END AS in_region
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN vprefixes ON substring(n_name, 1, {Q.PREFIX_LEN}) = vp)"""

def _channel(i: int) -> str:
    return f"CAST('0x' || substr(md5(CAST(p_partkey AS VARCHAR)), {1 + 2 * i}, 2) AS INTEGER)"


_APART = ", ".join(f"((R - {r}) * (R - {r}) + (G - {g}) * (G - {g}) + (B - {b}) * (B - {b})) * 100 + {i}"
                   for i, (r, g, b) in enumerate(C.COLOUR_RGB.values()))
_WORDS = ", ".join(f"'{w}'" for w in C.COLOUR_RGB)
COLOURS = f"""channels AS (
  SELECT p_partkey, {_channel(0)} AS R, {_channel(1)} AS G, {_channel(2)} AS B FROM part),
colours AS (
  SELECT p_partkey, R, G, B, list_extract([{_WORDS}], least({_APART}) % 100 + 1) AS word FROM channels)"""

TMAX_DAILY = """observed AS (
  SELECT o_custkey AS k, CAST(floor(o_totalprice) AS BIGINT) % 11 AS noise,
         unnest([CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 1]) AS date
  FROM orders),
tmax_daily AS (
  SELECT 'S' || CAST(k AS VARCHAR) AS station, date, CAST(k % 120 - 60 AS DOUBLE) AS latitude,
         CAST(k * 7 % 360 - 180 AS DOUBLE) AS longitude, CAST(k * 13 % 2500 AS DOUBLE) AS elevation,
         max(100 + abs((dayofyear(date) + 172) % 365 - 182) + k * 37 % 101
             + date_diff('day', DATE '1992-01-01', date) // 5 * 7919 % 61 + noise) / CAST('10.0' AS DOUBLE) AS tmax
  FROM observed GROUP BY 1, 2, 3, 4, 5),
features AS (
  SELECT t.station, t.date, CAST(dayofyear(t.date) AS INTEGER) AS day_of_year, t.tmax,
         y.tmax AS yesterday_tmax, t.latitude, t.longitude, t.elevation
  FROM tmax_daily t JOIN tmax_daily y ON t.station = y.station AND t.date - 1 = y.date)"""


def r6(expr: str) -> str:
    return f"(round({expr}, {Q.ROUND}) + {D(0.0)})"


# --- colour expressions (same operation order as tessera.functions.colour) ----

def _lin(c):
    return (f"(CASE WHEN {c} > {D(C.LIN_THRESHOLD)} THEN pow(({c} + {D(C.LIN_OFFSET)}) / {D(C.LIN_SCALE)}, "
            f"{D(C.GAMMA)}) ELSE {c} / {D(C.LIN_SLOPE)} END)")


def _f(t):
    return (f"(CASE WHEN {t} > {D(C.LAB_EPS)} THEN pow({t}, {D(1.0 / 3)}) "
            f"ELSE {D(C.LAB_KAPPA)} * {t} + {D(16.0 / 116)} END)")


def _row(m, i, a, b, c):
    return f"({a} * {D(m[i][0])} + {b} * {D(m[i][1])} + {c} * {D(m[i][2])})"


LAB_SQL = f"""WITH {COLOURS},
s1 AS (SELECT *, R / {D(255.0)} AS r1, G / {D(255.0)} AS g1, B / {D(255.0)} AS b1 FROM colours),
s2 AS (SELECT *, {_lin('r1')} AS r2, {_lin('g1')} AS g2, {_lin('b1')} AS b2 FROM s1),
s3 AS (SELECT *, {_row(C.XYZ_FROM_RGB, 0, 'r2', 'g2', 'b2')} / {D(C.WHITE_X)} AS x1,
              {_row(C.XYZ_FROM_RGB, 1, 'r2', 'g2', 'b2')} AS y1,
              {_row(C.XYZ_FROM_RGB, 2, 'r2', 'g2', 'b2')} / {D(C.WHITE_Z)} AS z1 FROM s2),
s4 AS (SELECT *, {_f('x1')} AS x2, {_f('y1')} AS y2, {_f('z1')} AS z2 FROM s3)
SELECT p_partkey, R, G, B, word,
       {r6(f"{D(116.0)} * y2 - {D(16.0)}")} AS labL,
       {r6(f"{D(500.0)} * (x2 - y2)")} AS labA,
       {r6(f"{D(200.0)} * (y2 - z2)")} AS labB
FROM s4"""

HSV_SQL = f"""WITH {COLOURS},
s1 AS (SELECT *, R / {D(255.0)} AS r1, G / {D(255.0)} AS g1, B / {D(255.0)} AS b1 FROM colours),
s2 AS (SELECT *, greatest(r1, g1, b1) AS mx, greatest(r1, g1, b1) - least(r1, g1, b1) AS delta FROM s1),
s3 AS (SELECT *,
  (CASE WHEN delta = 0 THEN {D(0.0)}
        WHEN mx = r1 THEN (g1 - b1) / delta
        WHEN mx = g1 THEN {D(2.0)} + (b1 - r1) / delta
        ELSE {D(4.0)} + (r1 - g1) / delta END) / {D(6.0)} AS hue,
  CASE WHEN delta = 0 THEN {D(0.0)} ELSE delta / mx END AS sat FROM s2)
SELECT p_partkey, R, G, B, word,
       {r6(f"CASE WHEN hue < 0 THEN hue + {D(1.0)} ELSE hue END")} AS H,
       {r6('sat')} AS S, {r6('mx')} AS V
FROM s3"""


def _finv(t):
    return (f"(CASE WHEN {t} > {D(C.INV_EPS)} THEN pow({t}, {D(3.0)}) "
            f"ELSE ({t} - {D(16.0 / 116)}) / {D(C.LAB_KAPPA)} END)")


def _gamma(c):
    v = (f"(CASE WHEN {c} > {D(C.OUT_THRESHOLD)} THEN {D(C.LIN_SCALE)} * pow({c}, {D(1 / C.GAMMA)}) "
         f"- {D(C.LIN_OFFSET)} ELSE {c} * {D(C.LIN_SLOPE)} END)")
    return f"least(greatest({v}, {D(0.0)}), {D(1.0)})"


_STEP = 200.0 / (Q.GRID_SIZE - 1)
GRID_SQL = f"""WITH g AS (
  SELECT p_partkey,
         {D(-100.0)} + CAST(p_partkey % {Q.GRID_SIZE} AS DOUBLE) * {D(_STEP)} AS labA,
         {D(-100.0)} + CAST(floor(p_partkey / {Q.GRID_SIZE}) % {Q.GRID_SIZE} AS DOUBLE) * {D(_STEP)} AS labB
  FROM part),
s1 AS (SELECT *, ({D(Q.GRID_LUM)} + {D(16.0)}) / {D(116.0)} AS y FROM g),
s2 AS (SELECT *, labA / {D(500.0)} + y AS x, y - labB / {D(200.0)} AS z0 FROM s1),
s3 AS (SELECT *, CASE WHEN z0 < 0 THEN {D(0.0)} ELSE z0 END AS z FROM s2),
s4 AS (SELECT *, {_finv('x')} * {D(C.WHITE_X)} AS XX, {_finv('y')} AS YY,
              {_finv('z')} * {D(C.WHITE_Z)} AS ZZ FROM s3),
s5 AS (SELECT *, {_row(C.RGB_FROM_XYZ, 0, 'XX', 'YY', 'ZZ')} AS lr,
              {_row(C.RGB_FROM_XYZ, 1, 'XX', 'YY', 'ZZ')} AS lg,
              {_row(C.RGB_FROM_XYZ, 2, 'XX', 'YY', 'ZZ')} AS lb FROM s4)
SELECT p_partkey, {r6('labA')} AS labA, {r6('labB')} AS labB,
       {r6(_gamma('lr') + f' * {D(255.0)}')} AS R,
       {r6(_gamma('lg') + f' * {D(255.0)}')} AS G,
       {r6(_gamma('lb') + f' * {D(255.0)}')} AS B
FROM s5"""

_LUT = ", ".join(f"('{w}', {r}, {g}, {b})" for w, (r, g, b) in C.COLOUR_RGB.items())
LOOKUP_SQL = f"""WITH lut(word, R, G, B) AS (VALUES {_LUT}),
w AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS word FROM part)
SELECT p_partkey, word, R, G, B FROM w JOIN lut USING (word)"""


# --- BFS, unrolled hop by hop ------------------------------------------------

def _bfs_ctes() -> str:
    s, h = Q.BFS_SOURCE, Q.BFS_HOPS
    parts = [EDGES, "e AS (SELECT DISTINCT source AS s, node AS d FROM edges)",
             f"v0 AS (SELECT CAST({s} AS BIGINT) AS node, 0 AS distance, CAST(NULL AS BIGINT) AS parent, "
             f"[CAST({s} AS BIGINT)] AS path)",
             "vis0 AS (SELECT * FROM v0)"]
    for k in range(1, h + 1):
        parts.append(f"r{k} AS (SELECT e.d AS node, min(f.node) AS parent FROM v{k-1} f "
                     f"JOIN e ON f.node = e.s GROUP BY e.d)")
        parts.append(f"v{k} AS (SELECT r.node, {k} AS distance, r.parent, list_append(p.path, r.node) AS path "
                     f"FROM r{k} r JOIN v{k-1} p ON p.node = r.parent "
                     f"WHERE r.node NOT IN (SELECT node FROM vis{k-1}))")
        parts.append(f"vis{k} AS (SELECT * FROM vis{k-1} UNION ALL SELECT * FROM v{k})")
    return "WITH " + ",\n".join(parts)


def _bfs_iterations() -> str:
    rows = ["SELECT 0 AS hop, (SELECT count(*) FROM vis0) AS known"]
    for k in range(1, Q.BFS_HOPS + 1):
        rows.append(f"SELECT {k} AS hop, (SELECT count(*) FROM vis{k}) AS known "
                    f"WHERE EXISTS (SELECT 1 FROM v{k})")
    return _bfs_ctes() + "\n" + "\nUNION ALL\n".join(rows)


_H = Q.BFS_HOPS

SQL = {
    "wordcount_whitespace": f"""
SELECT word, count(*) AS count FROM (
  SELECT {fold(f"regexp_replace(token, '{PUNCT_CLASS}', '', 'g')")} AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '{SPACE_RUN}')) AS token FROM documents)
  WHERE token <> '') WHERE word <> '' GROUP BY word""",

    "wordcount_whitespace_empty": f"""
SELECT word, count(*) AS count FROM (
  SELECT {fold(f"regexp_replace(token, '{PUNCT_CLASS}', '', 'g')")} AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '{SPACE_RUN}')) AS token FROM documents)
  WHERE token <> '') GROUP BY word""",

    "wordcount_delimited": f"""
SELECT word, count(*) AS count FROM (
  SELECT {fold('token')} AS word
  FROM (SELECT unnest(regexp_split_to_array(text, '{DELIM_RUN}')) AS token FROM documents))
WHERE word <> '' GROUP BY word""",

    "wordcount_keep_empty": f"""
SELECT word, count(*) AS count FROM (
  SELECT {fold('token')} AS word FROM (
    SELECT unnest(regexp_split_to_array(line, '{DELIM_RUN}')) AS token
    FROM (SELECT unnest(regexp_split_to_array(text, '{LINE_BREAK}')) AS line FROM documents)))
GROUP BY word""",

    "max_by_group_one": f"""WITH {PAGES}
SELECT hour, views, title FROM (
  SELECT hour, views, title,
         row_number() OVER (PARTITION BY hour ORDER BY views DESC, title DESC) AS rn FROM fp)
WHERE rn = 1""",

    "max_by_group_value": f"""WITH {PAGES}
SELECT hour, greatest(max(views), 0) AS views FROM fp GROUP BY hour""",

    "max_by_group_ties": f"""WITH {PAGES}
SELECT hour, title, views FROM ties""",

    "max_by_group_list": f"""WITH {PAGES}
SELECT hour, max(views) AS views, array_to_string(list_sort(list(title)), ',') AS titles
FROM ties GROUP BY hour""",

    "path_to_hour": f"""
SELECT event_id, nullif(regexp_extract(path, '{HOUR_PATH_PATTERN}', 1), '') AS hour FROM (
  SELECT event_id,
         CASE WHEN {K} % {V.BAD_LINE_EVERY} = 0 THEN '/data/pagecounts-x' || CAST(event_id AS VARCHAR) || '.gz'
              ELSE '/data/pagecounts-' || strftime(ts, '%Y%m%d-%H') || '0000.gz' END AS path
  FROM events)""",

    "mean_by_key": f"""
SELECT event_type, {mean_cents('c')} AS avg_value
FROM (SELECT event_type, {CENTS.format(c='value')} AS c FROM events) GROUP BY event_type""",

    "split_positive": f"""
SELECT event_type AS subreddit, value AS score, user_id AS author FROM events
WHERE contains(event_type, 'e') AND value > {Q.SCORE_SPLIT}""",

    "split_non_positive": f"""
SELECT event_type AS subreddit, value AS score, user_id AS author FROM events
WHERE contains(event_type, 'e') AND value <= {Q.SCORE_SPLIT}""",

    "etl_filter_project": f"""WITH {OBSERVATIONS}
SELECT station, date, value / {D(10.0)} AS tmax FROM observations
WHERE qflag IS NULL AND starts_with(station, '{Q.STATION_PREFIX}') AND observation = 'TMAX'""",

    "range_leader_df": f"""WITH {OBSERVATIONS},
clean AS (SELECT * FROM observations WHERE qflag IS NULL),
tmax AS (SELECT station, date, value AS mx FROM clean WHERE observation = 'TMAX'),
tmin AS (SELECT station, date, value AS mn FROM clean WHERE observation = 'TMIN'),
r AS (SELECT tmax.station, tmax.date, (mx - mn) / {D(10.0)} AS range
      FROM tmax JOIN tmin ON tmax.station = tmin.station AND tmax.date = tmin.date),
rm AS (SELECT date AS d, max(range) AS m FROM r GROUP BY date)
SELECT r.date, r.station, r.range, count(*) AS pairs
FROM r JOIN rm ON r.date = rm.d AND r.range = rm.m GROUP BY r.date, r.station, r.range""",

    "log_parse": f"WITH {LOGS}\nSELECT host, datetime, path, bytes, id FROM logs",
    "log_host_totals": f"WITH {LOGS}\nSELECT host, requests, bytes FROM totals",
    "log_correlation": f"""WITH {LOGS},
m AS (SELECT count(*) AS n, CASE WHEN stddev_pop(requests) > 0 AND stddev_pop(bytes) > 0
                                 THEN corr(CAST(requests AS DOUBLE), CAST(bytes AS DOUBLE)) END AS r FROM totals)
SELECT n, {significant('r')} AS r, {significant('r * r')} AS r2 FROM m""",
    "total_sum": f"WITH {LOGS}\nSELECT CAST(sum(bytes) AS BIGINT) AS total_bytes FROM logs",

    "upsert_latest": """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",

    "graph_edges": f"WITH {EDGES}\nSELECT source, node FROM edges",
    "bfs_distances": _bfs_ctes() + f"\nSELECT node, distance, parent FROM vis{_H}",
    "bfs_iterations": _bfs_iterations(),
    "shortest_path": _bfs_ctes() + f"""
SELECT CAST(generate_subscripts(path, 1) - 1 AS INTEGER) AS step, unnest(path) AS node
FROM vis{_H} WHERE node = (SELECT max(node) FROM vis{_H} WHERE distance = (SELECT max(distance) FROM vis{_H}))""",
    "path_to_destination": _bfs_ctes() + f"""
SELECT CAST(generate_subscripts(path, 1) - 1 AS INTEGER) AS step, unnest(path) AS node
FROM vis{_H} WHERE node = {Q.BFS_DESTINATION}""",

    "except_distinct": """
SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'
EXCEPT
SELECT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'view'""",
    "union_all": """
SELECT event_id, user_id FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, user_id FROM events WHERE event_type = 'view'""",
    "distinct_keys": "SELECT DISTINCT user_id, event_type FROM events",
    "top_k_rows": f"""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT {Q.TOP_K}""",

    "avg_by_dimension": f"""
SELECT o_orderpriority, {mean_cents('c')} AS avg_price FROM (
  SELECT o_orderpriority, {CENTS.format(c='o_totalprice')} AS c
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE n_name = '{Q.REPORT_NATION}') GROUP BY o_orderpriority""",
    "region_flag": f"WITH {FLAGS}\nSELECT c_custkey, in_region FROM flags",
    "spend_by_flags": f"""WITH {FLAGS},
j AS (SELECT o_totalprice, {CENTS.format(c='o_totalprice')} AS c, c_mktsegment, in_region
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN flags ON flags.c_custkey = customer.c_custkey)
SELECT CASE WHEN c_mktsegment = '{Q.FLAG_SEGMENT}' AND in_region = 0 THEN true ELSE false END AS segment_outside,
       CASE WHEN in_region = 1 THEN true ELSE false END AS inside,
       count(o_totalprice) AS n, {mean_cents('c')} AS mean_price, median(c) / {D(100.0)} AS median_price
FROM j GROUP BY 1, 2""",
    "semi_join_like": f"""WITH {FLAGS}
SELECT in_region, {mean_cents('c')} AS avg_price FROM (
  SELECT {CENTS.format(c='l_extendedprice')} AS c, in_region
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN flags ON o_custkey = c_custkey
  WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_name ILIKE '{Q.PART_PATTERN}'))
GROUP BY in_region""",
    "daily_mean_window": f"""
SELECT order_date, {mean_cents('c')} AS avg_price FROM (
  SELECT CAST(o_orderdate AS DATE) AS order_date, {CENTS.format(c='o_totalprice')} AS c FROM orders)
WHERE month(order_date) = {Q.WINDOW_MONTH} AND day(order_date) <= {Q.WINDOW_MAX_DAY}
GROUP BY order_date""",

    "previous_day_features": f"WITH {TMAX_DAILY}\nSELECT * FROM features",
    "rgb_to_lab": LAB_SQL,
    "rgb_to_hsv": HSV_SQL,
    "colour_lookup": LOOKUP_SQL,
    "colour_grid": GRID_SQL,
    "json_roundtrip": """
SELECT event_id, k, CAST(json_object('k', k) AS VARCHAR) AS props_json FROM (
  SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",

    "first_passage_mean": f"""
WITH draws AS (
  SELECT event_id, k,
         CAST('0x' || substr(md5(concat_ws(':', '{Q.PASSAGE_SEED}', CAST(event_id AS VARCHAR), CAST(k AS VARCHAR))), 1, 13) AS BIGINT) AS d
  FROM events, range(1, {MAX_DRAWS + 1}) t(k)),
c AS (SELECT event_id, k, sum(d) OVER (PARTITION BY event_id ORDER BY k) AS cs FROM draws),
n AS (SELECT event_id, min(k) AS n FROM c WHERE cs >= {TWO_52} GROUP BY event_id)
SELECT count(n) AS samples, CAST(sum(n) AS DOUBLE) / count(n) AS mean_draws FROM n""",

    "hash_split": f"""
SELECT event_id,
       CASE WHEN CAST('0x' || substr(md5(concat_ws(':', '{Q.SPLIT_SEED}', CAST(event_id AS VARCHAR))), 1, 8) AS BIGINT) % 100 < 75
            THEN 'train' ELSE 'validation' END AS split
FROM events""",

    "string_index": """
WITH f AS (SELECT p_brand, count(*) AS c FROM part GROUP BY p_brand),
r AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY c DESC, p_brand ASC) - 1 AS DOUBLE) AS label_index FROM f)
SELECT p_partkey, p_brand, label_index FROM part JOIN r USING (p_brand)""",

    "regression_metrics": f"""WITH {TMAX_DAILY},
m AS (SELECT count(*) AS n, avg((tmax - yesterday_tmax) * (tmax - yesterday_tmax)) AS mse, var_pop(tmax) AS var
      FROM features)
SELECT n, {significant(f"CASE WHEN var > 0 THEN {D(1.0)} - mse / var END")} AS r2, {significant('sqrt(mse)')} AS rmse
FROM m""",

    "accuracy_metric": f"""
SELECT count(*) AS n, CAST(sum(CASE WHEN quality = predicted THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS accuracy
FROM (SELECT quality, CASE WHEN n_chars >= {Q.LONG_DOC_CHARS} THEN 1 ELSE 0 END AS predicted
      FROM documents JOIN labels USING (doc_id))""",
}

# Pairs with the same oracle as another key.
SQL["relative_score_join"] = f"""
WITH s AS (SELECT event_id, user_id AS author, event_type, {CENTS.format(c='value')} AS cents FROM events),
m AS (SELECT event_type AS k, CAST(sum(cents) AS DOUBLE) / count(cents) AS mean FROM s GROUP BY event_type)
SELECT event_id, author, event_type, CASE WHEN mean <> 0 THEN cents / mean END AS relative_score
FROM s JOIN m ON s.event_type = m.k"""
SQL["relative_score_broadcast"] = SQL["relative_score_join"]
SQL["etl_pushdown"] = SQL["etl_filter_project"]
SQL["range_leader_sql"] = SQL["range_leader_df"]
for _k in ("region_flag", "avg_by_dimension", "semi_join_like", "daily_mean_window"):
    SQL[_k + "_sql"] = SQL[_k]

SQL["mean_by_key_json"] = SQL["mean_by_key"]
SQL["wordcount_text"] = SQL["wordcount_whitespace"]
SQL["top_pages_text"] = SQL["max_by_group_ties"]

SQL["regression_batch"] = f"""
WITH m AS (SELECT count(*) AS n, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM (
  SELECT CAST(event_id AS DOUBLE) AS x, CAST({CENTS.format(c='value')} AS DOUBLE) AS y FROM events))
SELECT n, {significant('slope')} AS slope, {significant('intercept')} AS intercept FROM m"""
SQL["stream_regression"] = SQL["regression_batch"]


def _split(key: str) -> str:
    return (f"CASE WHEN CAST('0x' || substr(md5(concat_ws(':', '{Q.SPLIT_SEED}', {key})), 1, 8) AS BIGINT) % 100 < 75 "
            "THEN 'train' ELSE 'validation' END")


# The fits' rows, labels and splits; the quality bounds must hold.
SQL["gbt_predictions"] = f"""WITH {TMAX_DAILY}
SELECT station, date, {_split("station || ':' || CAST(date AS VARCHAR)")} AS split, tmax,
       true AS r2_ok, true AS rmse_ok, true AS predicted FROM features"""
SQL["mlp_predictions"] = f"""WITH {COLOURS}
SELECT p_partkey, {_split("CAST(p_partkey AS VARCHAR)")} AS split, word, true AS accuracy_ok, true AS predicted
FROM colours"""
SQL["prediction_grid"] = (
    GRID_SQL.replace("p_partkey / ", "cell // ").replace("p_partkey", "cell").replace(
        "FROM part)", f"FROM (SELECT unnest(range({Q.GRID_SIZE * Q.GRID_SIZE})) AS cell))").replace(
        "SELECT cell, (round", "SELECT (round").replace("FROM s5", ", true AS word_found FROM s5"))


# --- keyed table, layouts, malformed input, nested columns, catalog ----------------

SQL["keyed_upsert"] = SQL["stream_upsert"] = SQL["upsert_latest"]
SQL["keyed_lookup"] = f"""
SELECT * FROM ({SQL["upsert_latest"]}) WHERE event_type = 'purchase'
  AND user_id IN (SELECT user_id FROM events WHERE event_type = 'error')"""
SQL["etl_clustered"] = SQL["etl_json_gzip"] = SQL["etl_filter_project"]

_FAULT = (f"CASE WHEN {K} % {V.MALFORMED_EVERY} = 0 THEN 'malformed' WHEN {K} % {V.WRONG_TYPE_EVERY} = 0 THEN 'wrong type' "
          f"WHEN {K} % {V.MISSING_EVERY} = 0 THEN 'missing' ELSE 'none' END")
_HEAD = """'{"author": "u' || event_id || '", "subreddit": "' || event_type"""
_SCORE = f"""'", "score": ' || {CENTS.format(c='value')}"""
SQL["json_good"] = f"""
SELECT event_type AS subreddit, {CENTS.format(c='value')} AS score, 'u' || event_id AS author
FROM events WHERE {_FAULT} = 'none'"""
SQL["json_quarantine"] = f"""
SELECT CASE {_FAULT} WHEN 'malformed' THEN {_HEAD} || {_SCORE} WHEN 'wrong type' THEN {_HEAD} || '", "score": "many"}}'
                     ELSE {_HEAD} || '"}}' END AS line,
       CASE {_FAULT} WHEN 'malformed' THEN 'malformed' WHEN 'wrong type' THEN 'wrong type: score'
                     ELSE 'missing: score' END AS reason
FROM events WHERE {_FAULT} <> 'none'"""
_DAY = "strftime(ts, '%Y%m%d')"
_NUMBER = "CAST(floor(value * 10) AS INTEGER)"
SQL["csv_good"] = f"""
SELECT 'U' || user_id AS station, {_DAY} AS date, event_type AS observation, {_NUMBER} AS value, 'E' || event_id AS sflag
FROM events WHERE {_FAULT} = 'none'"""
SQL["csv_quarantine"] = f"""
SELECT CASE {_FAULT} WHEN 'malformed' THEN 'U' || user_id || ',' || {_DAY} || ',E' || event_id
       WHEN 'wrong type' THEN 'U' || user_id || ',' || {_DAY} || ',' || event_type || ',warm,,,E' || event_id || ',0700'
       ELSE ',' || {_DAY} || ',' || event_type || ',' || {_NUMBER} || ',,,E' || event_id || ',0700' END AS line,
       CASE {_FAULT} WHEN 'malformed' THEN 'malformed' WHEN 'wrong type' THEN 'wrong type: value'
                     ELSE 'missing: station' END AS reason
FROM events WHERE {_FAULT} <> 'none'"""

SQL["semi_join_nested"] = SQL["semi_join_like"].replace(
    f"WHERE p_name ILIKE '{Q.PART_PATTERN}'", f"WHERE p_size % 2 = 0 AND p_name ILIKE '{Q.PART_PATTERN}'")
SQL["catalog_avg_by_dimension"] = SQL["avg_by_dimension"]
SQL["catalog_semi_join"] = SQL["semi_join_like"]
SQL["catalog_daily_mean"] = SQL["daily_mean_window"]

# --- models -----------------------------------------------------------------------

SQL["lab_sql_stage"] = SQL["rgb_to_lab"]
SQL["sql_stage_predictions"] = f"""WITH {TMAX_DAILY}
SELECT station, date, day_of_year, tmax, yesterday_tmax, true AS same FROM features"""
SQL["next_day_predictions"] = f"""WITH {TMAX_DAILY}
SELECT station, date + 1 AS date, tmax AS yesterday_tmax, true AS near FROM tmax_daily t
WHERE date = (SELECT max(date) FROM tmax_daily m WHERE m.station = t.station)"""
SQL["feature_ablation"] = """
SELECT * FROM (VALUES ('all', 5, true, true, 'yesterday_tmax'), ('without_yesterday', 4, false, false, 'day_of_year'),
                      ('yesterday_only', 1, true, true, 'yesterday_tmax')) AS t(name, n_features, r2_ok, rmse_ok, first_feature)"""
SQL["gbt_early_stop"] = f"""WITH {TMAX_DAILY}
SELECT count(*) AS n, true AS stopped_early, true AS r2_ok, true AS rmse_ok FROM features
WHERE {_split("station || ':' || CAST(date AS VARCHAR)")} = 'validation'"""
SQL["path_both_ways"] = SQL["path_to_destination"]

# --- written and read back ----------------------------------------------------------

SQL["log_totals_gzip"] = SQL["log_host_totals"]
SQL["split_files"] = f"""
SELECT *, 'positive' AS side FROM ({SQL["split_positive"]})
UNION ALL SELECT *, 'negative' AS side FROM ({SQL["split_non_positive"]})"""
SQL["wordcount_lines"] = f"""SELECT word || ' ' || count AS value FROM ({SQL["wordcount_delimited"]})"""
SQL["max_tab_separated"] = f"""SELECT hour || chr(9) || views || chr(9) || title AS value FROM ({SQL["max_by_group_one"]})"""
SQL["max_json_arrays"] = f"""SELECT '["' || hour || '", ' || views || ']' AS value FROM ({SQL["max_by_group_value"]})"""
SQL["top_pages_json"] = SQL["max_by_group_ties"]
SQL["range_leader_csv"] = SQL["range_leader_df"]
SQL["bfs_snapshots"] = _bfs_ctes() + "\n" + "\nUNION ALL\n".join(
    f"SELECT {k} AS hop, node, parent, distance FROM vis{k} WHERE EXISTS (SELECT 1 FROM v{k})" for k in range(_H + 1))
SQL["path_lines"] = f"""SELECT CAST(node AS VARCHAR) AS value FROM ({SQL["path_to_destination"]})"""
SQL["mean_by_key_full"] = SQL["mean_by_key"]
