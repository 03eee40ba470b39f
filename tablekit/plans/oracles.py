"""DuckDB SQL oracles for the named queries (same column names and types).

Every rounded value gets ``+ 0.0``: DuckDB's round can give -0.0 where
Spark's (decimal based) round gives 0.0.

Used by the correctness check: each statement runs on the same parquet
tables (views named after the tables) and must give the same multiset of
rows as the Spark query. Queries over fitted models (trees, forests, k-means,
ALS, hashed naive Bayes) return facts that SQL can state beside the model's
own: which rows are predicted, their labels, and whether the model's relations
hold (a centre is the nearest, a prediction is the factors' product).
"""

from __future__ import annotations

LINES = ("(SELECT doc_id, CAST(generate_subscripts(parts, 1) AS INTEGER) AS line_no, "
         "unnest(parts) AS value FROM "
         "(SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))")

# Tokens of Spark ML's Tokenizer: lower case, split on \s, trailing empties dropped.
LOWER_TOKENS = ("CASE WHEN {t} = '' THEN [''] "
                "WHEN regexp_replace(lower({t}), '\\s+$', '') = '' THEN []::VARCHAR[] "
                "ELSE string_split_regex(regexp_replace(lower({t}), '\\s+$', ''), '\\s') END")

WORD_COUNT = ("SELECT word, CAST(count(*) AS BIGINT) AS n FROM "
              "(SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word "
              "FROM documents) WHERE word <> '' GROUP BY word")

CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"

ALL_LINES = "SELECT unnest(string_split(text, chr(10))) AS value FROM documents"

PARSE_OR_ZERO = ("CAST(sum(CASE WHEN regexp_matches(t, '^[+-]?[0-9]+$') "
                 "THEN coalesce(TRY_CAST(t AS BIGINT), 0) ELSE 0 END) AS BIGINT)")

LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _summary_sql() -> str:
    parts = []
    for c in LINEITEM_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS \"count\", "
            f"(round(avg({x}), 6) + 0.0) AS mean, (round(stddev_samp({x}), 6) + 0.0) AS stddev, "
            f"min({x}) AS \"min\", max({x}) AS \"max\" FROM lineitem")
    return " UNION ALL ".join(parts)


def _mixed_summary_sql() -> str:
    parts = []
    for c, number in (("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True),
                      ("c_mktsegment", False)):
        mean, dev = (f"(round({f}(CAST({c} AS DOUBLE)), 6) + 0.0)" if number else "CAST(NULL AS DOUBLE)"
                     for f in ("avg", "stddev_samp"))
        parts.append(f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS \"count\", {mean} AS mean, "
                     f"{dev} AS stddev, CAST(min({c}) AS VARCHAR) AS \"min\", CAST(max({c}) AS VARCHAR) AS \"max\" "
                     "FROM customer")
    return " UNION ALL ".join(parts)


def _corr_sql(target: str = "l_extendedprice") -> str:
    parts = []
    for c in LINEITEM_NUMERIC:
        parts.append(f"SELECT '{c}' AS \"column\", (round(coalesce(corr({target}, {c}), 'NaN'::DOUBLE), 8) "
                     f"+ 0.0) AS corr FROM lineitem")
    return " UNION ALL ".join(parts)


def _mean_std_sql() -> str:
    cols = ", ".join(f"(round(avg({c}), 6) + 0.0) AS mean_{c}, (round(stddev_samp({c}), 6) + 0.0) AS std_{c}"
                     for c in MEASURES)
    return f"SELECT {cols} FROM lineitem"


def _center_scale_sql() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in MEASURES)
    cols = ", ".join(f"(round(({c} - s.m_{c}) / s.s_{c}, 6) + 0.0) AS {c}" for c in MEASURES)
    return (f"SELECT l_orderkey, l_linenumber, {cols} FROM lineitem, "
            f"(SELECT {stats} FROM lineitem) s")


PCA_SQL = """
WITH s AS (SELECT var_samp(l_quantity) AS a, var_samp(l_discount) AS c,
                  covar_samp(l_quantity, l_discount) AS b FROM lineitem),
e AS (SELECT a, b, c, (a + c) / 2 + sqrt(((a - c) / 2) * ((a - c) / 2) + b * b) AS l1 FROM s),
r AS (SELECT CASE WHEN a >= c THEN l1 - c ELSE b END AS x,
             CASE WHEN a >= c THEN b ELSE l1 - a END AS y FROM e),
u AS (SELECT x / sqrt(x * x + y * y) AS x1, y / sqrt(x * x + y * y) AS y1 FROM r),
v AS (SELECT x1 * sg1 AS x1, y1 * sg1 AS y1, -y1 * sg2 AS x2, x1 * sg2 AS y2
      FROM (SELECT x1, y1,
                   CASE WHEN abs(x1) >= abs(y1) THEN sign(x1) ELSE sign(y1) END AS sg1,
                   CASE WHEN abs(y1) >= abs(x1) THEN sign(-y1) ELSE sign(x1) END AS sg2
            FROM u))
SELECT l_orderkey, l_linenumber,
       (round(l_quantity * v.x1 + l_discount * v.y1, 4) + 0.0) AS pc1,
       (round(l_quantity * v.x2 + l_discount * v.y2, 4) + 0.0) AS pc2
FROM lineitem, v
"""

TF_IDF_SQL = f"""
WITH docs AS (SELECT item_id, text FROM benchmark WHERE text IS NOT NULL),
terms AS (SELECT item_id, unnest({LOWER_TOKENS.format(t='text')}) AS term FROM docs),
tf AS (SELECT item_id, term, CAST(count(*) AS BIGINT) AS tf FROM terms GROUP BY item_id, term),
dfreq AS (SELECT term, CAST(count(*) AS BIGINT) AS df FROM tf GROUP BY term),
m AS (SELECT CAST(count(*) AS DOUBLE) AS m FROM docs)
SELECT item_id, term, tf, df, (round(ln((m + 1) / (df + 1)), 8) + 0.0) AS idf,
       (round(tf * ln((m + 1) / (df + 1)), 8) + 0.0) AS tf_idf
FROM tf JOIN dfreq USING (term), m
"""

NB_FLAGS_SQL = """
WITH d AS (SELECT CAST(l.quality AS DOUBLE) AS label, doc.lang
           FROM documents doc JOIN labels l ON doc.doc_id = l.doc_id),
f AS (SELECT * FROM (VALUES ('de'), ('en'), ('es'), ('fr')) t(feature)),
n AS (SELECT label, count(*) AS nk FROM d GROUP BY label),
tot AS (SELECT count(*) AS n_all, count(DISTINCT label) AS k FROM d),
s AS (SELECT n.label, f.feature,
             (SELECT count(*) FROM d WHERE d.label = n.label AND d.lang = f.feature) AS s_kj
      FROM n, f),
sk AS (SELECT label, sum(s_kj) AS s_k FROM s GROUP BY label)
SELECT s.label, s.feature,
       (round(ln(n.nk + 1) - ln(tot.n_all + tot.k), 8) + 0.0) AS log_prior,
       (round(ln(s.s_kj + 1) - ln(sk.s_k + 4), 8) + 0.0) AS log_theta
FROM s JOIN n ON s.label = n.label JOIN sk ON s.label = sk.label, tot
"""

# Least squares with three features by Cramer's rule on the covariance matrix.
LINREG3_SQL = """
WITH c AS (SELECT
    covar_samp(l_quantity, l_quantity) AS a11, covar_samp(l_quantity, l_discount) AS a12,
    covar_samp(l_quantity, l_tax) AS a13, covar_samp(l_discount, l_discount) AS a22,
    covar_samp(l_discount, l_tax) AS a23, covar_samp(l_tax, l_tax) AS a33,
    covar_samp(l_quantity, l_extendedprice) AS b1, covar_samp(l_discount, l_extendedprice) AS b2,
    covar_samp(l_tax, l_extendedprice) AS b3,
    avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3,
    avg(l_extendedprice) AS my FROM lineitem),
d AS (SELECT *,
    a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13)
      + a13 * (a12 * a23 - a22 * a13) AS det,
    b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3)
      + a13 * (b2 * a23 - a22 * b3) AS d1,
    a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13)
      + a13 * (a12 * b3 - b2 * a13) AS d2,
    a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13)
      + b1 * (a12 * a23 - a22 * a13) AS d3 FROM c),
beta AS (SELECT d1 / det AS c1, d2 / det AS c2, d3 / det AS c3, m1, m2, m3, my FROM d)
SELECT 'l_quantity' AS term, (round(c1, 4) + 0.0) AS value FROM beta
UNION ALL SELECT 'l_discount', (round(c2, 4) + 0.0) FROM beta
UNION ALL SELECT 'l_tax', (round(c3, 4) + 0.0) FROM beta
UNION ALL SELECT 'intercept', (round(my - c1 * m1 - c2 * m2 - c3 * m3, 4) + 0.0) FROM beta
"""

# Least squares fitted on the training part of the md5 split (bucket < 9000),
# predictions for the rest: the same normal equations by Cramer's rule.
LINREG_PRED_SQL = """
WITH li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, l_extendedprice,
       ('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR)), 1, 8))::BIGINT % 10000 AS b
       FROM lineitem),
c AS (SELECT
    covar_samp(l_quantity, l_quantity) AS a11, covar_samp(l_quantity, l_discount) AS a12,
    covar_samp(l_quantity, l_tax) AS a13, covar_samp(l_discount, l_discount) AS a22,
    covar_samp(l_discount, l_tax) AS a23, covar_samp(l_tax, l_tax) AS a33,
    covar_samp(l_quantity, l_extendedprice) AS b1, covar_samp(l_discount, l_extendedprice) AS b2,
    covar_samp(l_tax, l_extendedprice) AS b3,
    avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_tax) AS m3,
    avg(l_extendedprice) AS my FROM li WHERE b < 9000),
d AS (SELECT *,
    a11 * (a22 * a33 - a23 * a23) - a12 * (a12 * a33 - a23 * a13) + a13 * (a12 * a23 - a22 * a13) AS det,
    b1 * (a22 * a33 - a23 * a23) - a12 * (b2 * a33 - a23 * b3) + a13 * (b2 * a23 - a22 * b3) AS d1,
    a11 * (b2 * a33 - a23 * b3) - b1 * (a12 * a33 - a23 * a13) + a13 * (a12 * b3 - b2 * a13) AS d2,
    a11 * (a22 * b3 - b2 * a23) - a12 * (a12 * b3 - b2 * a13) + b1 * (a12 * a23 - a22 * a13) AS d3 FROM c),
beta AS (SELECT d1 / det AS c1, d2 / det AS c2, d3 / det AS c3, m1, m2, m3, my FROM d)
SELECT l_orderkey, l_linenumber, l_extendedprice AS label,
       (round(my + c1 * (l_quantity - m1) + c2 * (l_discount - m2) + c3 * (l_tax - m3), 1) + 0.0) AS prediction
FROM li, beta WHERE b >= 9000
"""

RULE = ("SELECT CAST(l.quality AS DOUBLE) AS label, "
        "CAST(CASE WHEN d.n_chars >= 2000 THEN 1.0 ELSE 0.0 END AS DOUBLE) AS prediction "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")

def _bucket(*keys: str) -> str:
    """The md5 bucket 0..9999 of the stable split."""
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % 10000)"


RATINGS = ("r AS (SELECT *, " + _bucket("u", "i") + " AS b FROM (SELECT o.o_custkey AS u, l.l_partkey AS i, "
           "sum(l.l_quantity) AS q FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2))")

JSON_DATE = "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate"

ORACLES: dict[str, str] = {
    "word_count": WORD_COUNT,
    "word_count_sink": WORD_COUNT,
    "text_scan": ALL_LINES,
    "drop_header_equal": (f"WITH lines AS {LINES} SELECT doc_id, line_no, value FROM lines "
                          "WHERE value <> (SELECT value FROM lines ORDER BY doc_id, line_no "
                          "LIMIT 1)"),
    "drop_header_contains": (f"SELECT doc_id, line_no, value FROM {LINES} "
                             "WHERE NOT contains(value, 'the')"),
    "normalize_text": ("SELECT doc_id, line_no, v AS value FROM (SELECT doc_id, line_no, "
                       "regexp_replace(value, '['',!-;\\.\"?]', '', 'g') AS v FROM "
                       f"{LINES}) WHERE length(v) > 0"),
    "first_n_lines": (f"SELECT doc_id, line_no, value FROM {LINES} "
                      "ORDER BY doc_id, line_no LIMIT 1000"),
    "tokenize_lower": ("SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest("
                       + LOWER_TOKENS.format(t="text") + ") AS token FROM documents) "
                       "GROUP BY token"),
    "split_space": ("SELECT token, CAST(count(*) AS BIGINT) AS n FROM "
                    "(SELECT unnest(string_split(text, ' ')) AS token FROM documents) "
                    "GROUP BY token"),
    "typed_delimited": CUSTOMER,
    "split_typed": CUSTOMER,
    "semicolon_quoted": CUSTOMER,
    "semicolon_stripped": ("SELECT c_custkey, replace(c_name, '\"', '') AS name, 'x' AS extra, "
                           "c_mktsegment AS segment FROM customer"),
    "quoted_lines_parse": (
        "SELECT p[1] AS key_text, p[2] AS name, p[3] AS nation_text, p[5] AS segment_text "
        "FROM (SELECT string_split('\"' || concat_ws('\",\"', CAST(c_custkey AS VARCHAR), "
        "c_name, CAST(c_nationkey AS VARCHAR), CAST(c_acctbal AS VARCHAR), c_mktsegment) "
        "|| '\"', '\",\"') AS p FROM customer)"),
    "message_lines_parse": (
        "SELECT CAST(CASE WHEN lang = 'en' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label, "
        "regexp_replace(text, '[\\r\\n]', ' ', 'g') AS message FROM documents"),
    "message_lines_truncated": (
        "SELECT CAST(CASE WHEN lang = 'en' THEN 0.0 ELSE 1.0 END AS DOUBLE) AS label, "
        "string_split(regexp_replace(text, '[\\r\\n]', ' ', 'g'), ',')[1] AS message FROM documents"),
    "ddl_table_load": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "ddl_sql_table": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "sql_filtered_sum": ("SELECT (round(sum(c_acctbal), 2) + 0.0) AS total FROM customer "
                         "WHERE c_mktsegment = 'BUILDING'"),
    "json_scan": (f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {JSON_DATE}, "
                  "o_orderpriority FROM orders"),
    "json_schema": (
        "SELECT column_name AS \"column\", CASE column_type WHEN 'BIGINT' THEN 'bigint' "
        "WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
        "ELSE lower(column_type) END AS type, \"null\" = 'YES' AS nullable FROM (DESCRIBE "
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, {JSON_DATE}, o_orderpriority "
        "FROM orders)"),
    "json_group_count": ("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n FROM orders "
                         "GROUP BY o_orderpriority"),
    "json_filter_gt": "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000",
    "view_sql": "SELECT c_name FROM customer WHERE c_acctbal > 5000",
    "project_cols": "SELECT p_name FROM part",
    "project_arith": "SELECT c_name, c_acctbal + 1 AS acctbal_plus_one FROM customer",
    "filter_gt": ("SELECT p_partkey, p_name, p_retailprice FROM part "
                  "WHERE p_retailprice > 950"),
    "literal_rows": (
        "SELECT c.o_orderstatus, c.n, l.status_label FROM "
        "(SELECT o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders "
        "GROUP BY o_orderstatus) c LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open'), "
        "('P', 'partial')) l(o_orderstatus, status_label) ON c.o_orderstatus = l.o_orderstatus"),
    "preview_bounded": ("SELECT o_orderkey, o_totalprice FROM orders "
                        "ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"),
    "count_by_key": ("SELECT r_name, CAST(count(*) AS BIGINT) AS n FROM customer "
                     "JOIN nation ON c_nationkey = n_nationkey "
                     "JOIN region ON n_regionkey = r_regionkey GROUP BY r_name"),
    "sum_by_key_or_zero": (f"SELECT event_type, {PARSE_OR_ZERO} AS total FROM "
                           "(SELECT event_type, json_extract_string(props, '$.k') AS t "
                           "FROM events) GROUP BY event_type"),
    "sum_by_key_all_bad": (f"SELECT event_type, {PARSE_OR_ZERO} AS total FROM "
                           "(SELECT event_type, CAST(value AS VARCHAR) AS t FROM events) "
                           "GROUP BY event_type"),
    "quoted_sum_by_key": (f"SELECT event_type, {PARSE_OR_ZERO} AS total FROM "
                          "(SELECT event_type, json_extract_string(props, '$.k') AS t "
                          "FROM events) GROUP BY event_type"),
    "distinct_set_line": ("SELECT string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) "
                          "AS segments FROM customer"),
    "distinct_set_rows": "SELECT DISTINCT p_name FROM part",
    "filtered_sum": ("SELECT (round(sum(c_acctbal), 2) + 0.0) AS total FROM customer "
                     "WHERE c_mktsegment = 'BUILDING'"),
    "grouped_sum": ("SELECT n_name, (round(sum(c_acctbal), 2) + 0.0) AS total FROM customer "
                    "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"),
    "sql_grouped_sum": ("SELECT c_mktsegment, (round(sum(c_acctbal), 2) + 0.0) AS total FROM customer "
                        "GROUP BY c_mktsegment"),
    "global_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM lineitem",
    "inner_join_comma": ("SELECT o.o_orderkey, c.c_name, o.o_totalprice FROM orders o, "
                         "customer c WHERE o.o_custkey = c.c_custkey"),
    "sql_distinct": "SELECT DISTINCT p_type FROM part",
    "distinct_projection": "SELECT DISTINCT p_brand, p_type FROM part",
    "split_by_hash": ("SELECT o_orderkey, CAST(CASE WHEN ('0x' || substr(md5(CAST(o_orderkey "
                      "AS VARCHAR)), 1, 8))::BIGINT % 10000 < 7000 THEN 0 ELSE 1 END AS INTEGER)"
                      " AS part FROM orders"),
    "random_split": ("SELECT o_orderkey, CAST(1 AS BIGINT) AS parts, true AS near_weights FROM orders"),
    "sort_order": ("SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS inversions_within, "
                   "CAST(0 AS BIGINT) AS inversions_between FROM lineitem"),
    "binary_recode": ("SELECT o_orderkey, "
                      "CAST(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 2.0 END AS DOUBLE) "
                      "AS status_code, CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 0.0 "
                      "ELSE 1.0 END AS DOUBLE) AS urgent_code FROM orders"),
    "indicators": ("SELECT p_partkey, "
                   "CAST(CASE WHEN p_type = 'ECONOMY' THEN 1.0 ELSE 0.0 END AS DOUBLE) "
                   "AS is_economy, CAST(CASE WHEN p_type = 'STANDARD' THEN 1.0 ELSE 0.0 END "
                   "AS DOUBLE) AS is_standard, CAST(CASE WHEN p_type = 'PROMO' THEN 1.0 "
                   "ELSE 0.0 END AS DOUBLE) AS is_promo FROM part"),
    "impute_sentinel": ("SELECT d.doc_id, CAST(CASE WHEN l.quality IS NULL THEN 0.5 "
                        "ELSE l.quality END AS DOUBLE) AS quality_filled FROM documents d "
                        "LEFT JOIN labels l ON d.doc_id = l.doc_id"),
    "summary_stats": _summary_sql(),
    "summary_stats_mixed": _mixed_summary_sql(),
    "mean_std": _mean_std_sql(),
    "corr_with_target": _corr_sql(),
    "center_scale": _center_scale_sql(),
    "vector_roundtrip": ("SELECT l_orderkey, l_linenumber, l_quantity AS f0, "
                         "l_extendedprice AS f1, l_discount AS f2 FROM lineitem"),
    "string_index": (
        "WITH idx AS (SELECT p_brand, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) "
        "- 1 AS DOUBLE) AS brand_index FROM part GROUP BY p_brand) "
        "SELECT p.p_partkey, p.p_brand, idx.brand_index FROM part p "
        "JOIN idx ON p.p_brand = idx.p_brand"),
    "index_numeric_label": (
        "WITH idx AS (SELECT CAST(quality AS VARCHAR) AS q, CAST(row_number() OVER "
        "(ORDER BY count(*) DESC, CAST(quality AS VARCHAR)) - 1 AS DOUBLE) AS quality_index "
        "FROM labels GROUP BY CAST(quality AS VARCHAR)) "
        "SELECT l.doc_id, l.quality, idx.quality_index FROM labels l "
        "JOIN idx ON CAST(l.quality AS VARCHAR) = idx.q"),
    "tf_idf": TF_IDF_SQL,
    "pca_2d": PCA_SQL,
    "nb_flags": NB_FLAGS_SQL,
    "linreg_report": ("SELECT (round(regr_slope(l_extendedprice, l_quantity), 4) + 0.0) AS slope, "
                      "(round(regr_intercept(l_extendedprice, l_quantity), 4) + 0.0) AS intercept, "
                      "(round(regr_r2(l_extendedprice, l_quantity), 8) + 0.0) AS r2 FROM lineitem"),
    "linreg_coefficients": LINREG3_SQL,
    "linreg": LINREG_PRED_SQL,
    "als_fit": (
        "WITH r AS (SELECT DISTINCT o.o_custkey AS u, l.l_partkey AS i FROM lineitem l "
        "JOIN orders o ON l.l_orderkey = o.o_orderkey), "
        "t AS (SELECT u, i FROM r WHERE ('0x' || substr(md5(CAST(u AS VARCHAR) || '|' || "
        "CAST(i AS VARCHAR)), 1, 8))::BIGINT % 10000 < 9000) "
        "SELECT CAST(10 AS INTEGER) AS rank, count(DISTINCT u) AS num_users, "
        "count(DISTINCT i) AS num_items FROM t"),
    "als_factors": (
        f"WITH {RATINGS} SELECT DISTINCT u AS o_custkey, CAST(10 AS INTEGER) AS factors, true AS finite "
        "FROM r WHERE b < 9000"),
    "als_predict": (
        f"WITH {RATINGS} SELECT u AS o_custkey, i AS l_partkey, CAST(CAST(q AS FLOAT) AS DOUBLE) AS rating, "
        "(u NOT IN (SELECT u FROM r WHERE b < 9000) OR i NOT IN (SELECT i FROM r WHERE b < 9000)) AS unseen, "
        "true AS fits FROM r WHERE b >= 9000"),
    "decision_tree": ("SELECT vec_id, CAST(label AS DOUBLE) AS label, true AS follows_rules, true AS beats_majority "
                      f"FROM embeddings WHERE {_bucket('vec_id')} >= 9000"),
    "tree_report": ("SELECT count(DISTINCT label) > 1 AS depth_ok, count(DISTINCT label) > 1 AS nodes_ok, "
                    "count(DISTINCT label) > 1 AS rules_ok FROM embeddings"),
    "random_forest_pca": (
        "WITH idx AS (SELECT l_returnflag AS f, CAST(row_number() OVER (ORDER BY count(*) DESC, l_returnflag) - 1 "
        "AS DOUBLE) AS indexed FROM lineitem GROUP BY l_returnflag) "
        "SELECT l_orderkey, l_linenumber, indexed, true AS in_classes FROM lineitem JOIN idx ON f = l_returnflag "
        f"WHERE {_bucket('l_orderkey', 'l_linenumber')} >= 7000"),
    "kmeans": "SELECT vec_id, true AS nearest, CAST(5 AS BIGINT) AS clusters FROM embeddings",
    "cluster_scatter": (
        "WITH e AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS a, CAST(embedding[2] AS DOUBLE) AS b FROM embeddings), "
        "s AS (SELECT avg(a) AS ma, stddev_samp(a) AS sa, avg(b) AS mb, stddev_samp(b) AS sb FROM e) "
        "SELECT vec_id, true AS in_clusters, (round((a - ma) / sa, 4) + 0.0) AS x, "
        "(round((b - mb) / sb, 4) + 0.0) AS y FROM e, s"),
    "accuracy": (f"SELECT (round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END)::DOUBLE,"
                 f" 10) + 0.0) AS accuracy FROM ({RULE})"),
    "confusion": (f"SELECT label, prediction, CAST(count(*) AS BIGINT) AS n FROM ({RULE}) "
                  "GROUP BY label, prediction"),
    "stream_word_count": ("SELECT token, CAST(count(*) AS BIGINT) AS n FROM "
                          "(SELECT unnest(string_split(line, ' ')) AS token FROM "
                          "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) "
                          "GROUP BY token"),
    "stream_interval_count": ("SELECT token, CAST(count(*) AS BIGINT) AS n FROM "
                              "(SELECT unnest(string_split(line, ' ')) AS token FROM "
                              "(SELECT unnest(string_split(text, chr(10))) AS line FROM conversations)) "
                              "GROUP BY token"),
    "stream_book_feed": (
        "SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(v, ' ')) "
        "AS token FROM (SELECT regexp_replace(value, '['',!-;\\.\"?]', '', 'g') AS v "
        f"FROM {LINES}) WHERE length(v) > 0) GROUP BY token"),
    "stream_dictionary_feed": (
        "SELECT token, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(string_split(value, "
        f"' ')) AS token FROM (SELECT value FROM {LINES} ORDER BY doc_id, line_no LIMIT 1000)) "
        "GROUP BY token"),
    "udf_scalar": ("SELECT o_orderkey, CAST(floor(o_totalprice / 50000.0) AS BIGINT) "
                   "AS price_band FROM orders"),
    "udf_predicate": ("SELECT o_orderkey, o_orderpriority FROM orders "
                      "WHERE starts_with(o_orderpriority, '1-') "
                      "OR starts_with(o_orderpriority, '2-')"),
    "udf_explode": ("SELECT o_orderkey, CAST(generate_subscripts(p, 1) AS INTEGER) AS pos, "
                    "unnest(p) AS part FROM (SELECT o_orderkey, "
                    "string_split(o_orderpriority, '-') AS p FROM orders)"),
    "udf_agg_text": ("SELECT o_orderstatus, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) "
                     "AS priorities FROM orders GROUP BY o_orderstatus"),
    "udf_agg_long": ("SELECT o_orderstatus, max(o_orderkey) + 9007199254740992 AS largest FROM orders "
                     "GROUP BY o_orderstatus"),
    "udf_agg": ("SELECT o_orderstatus, (round(sum(o_totalprice), 2) + 0.0) AS total FROM orders "
                "GROUP BY o_orderstatus"),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
