"""Named queries: each composes the operators over the test tables.

Every query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables (no id subsets, no row caps; a ``limit`` only where first-n or preview
is the feature). Queries that exercise a file source first write the table in
that format to a fresh folder under the session's checkpoint folder and read
it back with the source under test.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import parse, text as textf, vectors
from ..operators import evaluate, features, models, profile, relational, trees, udfs
from ..session import scratch_path
from ..sources import delimited, json as jsonsrc, literal, tables, text
from .. import streaming

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


# Unique keys of the tables spread for CPU-heavy work (hash spread, no hot key).
SPREAD_KEYS = {"embeddings": ["vec_id"], "events": ["event_id"], "documents": ["doc_id"], "lineitem": ["l_orderkey", "l_linenumber"]}


def T(spark, sf_dir, name, heavy=False):
    """A table scan; ``heavy`` marks CPU-heavy work that needs at least the
    cluster's parallelism in tasks (a no-op for tables of that many files)."""
    df = tables.table(spark, sf_dir, name)
    return tables.spread(df, SPREAD_KEYS[name]) if heavy else df


def doc_lines(spark, sf_dir) -> DataFrame:
    return text.numbered_lines(T(spark, sf_dir, "documents", heavy=True), "doc_id", "text")


def _s(c):
    return F.col(c).cast("string")


def _line(sep, *cols):
    """Fields joined to a line; a null is an empty field, so positions hold."""
    return F.concat_ws(sep, *[F.coalesce(_s(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def _own_name(name):
    """A name for a temporary view or table that no other run uses."""
    return f"tk_{name}_{uuid.uuid4().hex}"


# Parameters of the queries (not values of the reference): thresholds and tokens.
HEADER_TOKEN = "the"
SEGMENT = "BUILDING"
ACCTBAL_MIN = 5000.0
RETAILPRICE_MIN = 950.0
TOTALPRICE_MIN = 300000.0
LONG_DOC_CHARS = 2000
LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


# ---------------------------------------------------------------- text and word counts

@query("word_count")
def q_word_count(spark, sf_dir):
    """StringTokenizer word count over all document text."""
    docs = T(spark, sf_dir, "documents", heavy=True)
    return relational.word_count(docs, "text")


@query("word_count_sink")
def q_word_count_sink(spark, sf_dir):
    """Sorted key<TAB>value text output (replaces existing), read back."""
    out = scratch_path(spark, "word_count_sink")
    counts = q_word_count(spark, sf_dir)
    sinks.write_key_value_text(counts, out, "word", "n")
    return sinks.read_key_value_text(spark, out, "word", "n")


def _documents_as_text_files(spark, sf_dir) -> str:
    out = scratch_path(spark, "documents_text")
    T(spark, sf_dir, "documents").select(F.col("text").alias("value")).write.text(out)
    return out


@query("text_scan")
def q_text_scan(spark, sf_dir):
    """A1: document text written as text files, scanned back line by line."""
    return text.read_lines(spark, _documents_as_text_files(spark, sf_dir))


@query("drop_header_equal")
def q_drop_header_equal(spark, sf_dir):
    """A3: drop every line equal to the first line (first by doc, then line)."""
    lines = doc_lines(spark, sf_dir)
    header = text.first_line(lines, ["doc_id", "line_no"])
    return text.drop_lines_equal(lines, header)


@query("drop_header_contains")
def q_drop_header_contains(spark, sf_dir):
    """Drop every line that contains the token."""
    return text.drop_lines_containing(doc_lines(spark, sf_dir), HEADER_TOKEN)


@query("normalize_text")
def q_normalize_text(spark, sf_dir):
    """Strip the punctuation/digit class, drop lines left empty."""
    return textf.normalize_lines(doc_lines(spark, sf_dir))


@query("first_n_lines")
def q_first_n_lines(spark, sf_dir):
    """The first 1000 lines by position (first n is the feature)."""
    return text.first_n_lines(doc_lines(spark, sf_dir), 1000, ["doc_id", "line_no"])


@query("tokenize_lower")
def q_tokenize_lower(spark, sf_dir):
    """Tokenizer tokens (lower case, split on whitespace), counted.

    Uses the built-in expression form of the ML Tokenizer (same tokens,
    property-tested), which stays in generated code."""
    return relational.word_count(T(spark, sf_dir, "documents", heavy=True),
                                 tokens=textf.lower_tokens("text"), out="token")


@query("split_space")
def q_split_space(spark, sf_dir):
    """Single-space split with empty tokens kept, counted."""
    return relational.word_count(T(spark, sf_dir, "documents", heavy=True),
                                 tokens=textf.space_tokens("text"), out="token")


# ---------------------------------------------------------------- delimited sources

CUSTOMER_DDL = ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string")
CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _customer_lines(spark, sf_dir, sep=",", quote_fields=False) -> str:
    out = scratch_path(spark, "customer_lines")
    cust = T(spark, sf_dir, "customer")
    if quote_fields:
        line = F.concat(F.lit('"'), _line('"' + sep + '"', *CUSTOMER_COLS), F.lit('"'))
    else:
        line = _line(sep, *CUSTOMER_COLS)
    cust.select(line.alias("value")).write.text(out)
    return out


@query("typed_delimited")
def q_typed_delimited(spark, sf_dir):
    """A5 A10: comma lines without header read with a declared schema."""
    path = _customer_lines(spark, sf_dir)
    return delimited.read_delimited(spark, path, CUSTOMER_DDL)


@query("split_typed")
def q_split_typed(spark, sf_dir):
    """The same lines split and cast field by field."""
    lines = text.read_lines(spark, _customer_lines(spark, sf_dir))
    return delimited.typed_split(lines, ",", [("c_custkey", 0, "bigint"), ("c_name", 1, "string"),
                                              ("c_nationkey", 2, "int"),
                                              ("c_acctbal", 3, "double"),
                                              ("c_mktsegment", 4, "string")])


@query("semicolon_quoted")
def q_semicolon_quoted(spark, sf_dir):
    """A6 G5: ';'-separated, every field quoted, header per file."""
    out = scratch_path(spark, "customer_semicolon")
    (T(spark, sf_dir, "customer").select(*CUSTOMER_COLS).write
        .option("sep", ";").option("quoteAll", "true").option("header", "true").csv(out))
    return delimited.read_semicolon_quoted(spark, out, CUSTOMER_DDL)


@query("semicolon_stripped")
def q_semicolon_stripped(spark, sf_dir):
    """Quotes removed from the whole line, then split on every ';';
    names hold quotes and separators of their own, so later fields move."""
    out = scratch_path(spark, "customer_stripped")
    name = F.concat(F.col("c_name"), F.lit('";"x'))
    cust = T(spark, sf_dir, "customer")
    cust.select(F.concat(F.lit('"'), _line('";"', "c_custkey", name, "c_mktsegment"), F.lit('"')).alias("value")) \
        .unionByName(spark.range(2).select(F.lit('"c_custkey";"c_name";"c_mktsegment"').alias("value"))) \
        .write.text(out)
    lines = text.drop_lines_containing(text.read_lines(spark, out), "c_custkey")
    return delimited.stripped_fields(lines, [("c_custkey", 0, "bigint"), ("name", 1, "string"),
                                             ("extra", 2, "string"), ("segment", 3, "string")])


@query("quoted_lines_parse")
def q_quoted_lines_parse(spark, sf_dir):
    """Split on '","', fields by index; outer quotes stay on the ends."""
    lines = text.read_lines(spark, _customer_lines(spark, sf_dir, quote_fields=True))
    return delimited.quoted_fields(lines, {"key_text": 0, "name": 1, "nation_text": 2,
                                           "segment_text": 4})


def _message_lines(spark, sf_dir) -> str:
    """All documents as ``kind,text`` lines (line ends in the text as blanks)."""
    out = scratch_path(spark, "message_lines")
    kind = F.when(F.col("lang") == "en", F.lit("ham")).otherwise(F.lit("spam"))
    T(spark, sf_dir, "documents").select(
        _line(",", kind, F.regexp_replace("text", "[\\r\\n]", " ")).alias("value")).write.text(out)
    return out


@query("message_lines_parse")
def q_message_lines_parse(spark, sf_dir):
    """Kind,message lines; the message keeps its own commas."""
    lines = text.read_lines(spark, _message_lines(spark, sf_dir))
    return delimited.labelled_messages(lines)


@query("message_lines_truncated")
def q_message_lines_truncated(spark, sf_dir):
    """The literal split(",")[1]: the message ends at its first comma."""
    lines = text.read_lines(spark, _message_lines(spark, sf_dir))
    return delimited.labelled_messages(lines, truncate_at_comma=True)


@query("ddl_table_load")
def q_ddl_table_load(spark, sf_dir):
    """Declared comma table, loaded with overwrite, read back."""
    src = scratch_path(spark, "nation_lines")
    nation = T(spark, sf_dir, "nation")
    nation.select(_line(",", *nation.columns).alias("value")).write.text(src)
    declared = delimited.read_declared(spark, src, "n_nationkey int, n_name string, "
                                                   "n_regionkey int")
    target = scratch_path(spark, "nation_table")
    sinks.load_overwrite(declared, target)
    return spark.read.parquet(target)


@query("ddl_sql_table")
def q_ddl_sql_table(spark, sf_dir):
    """A11 A12 T5 in SQL: CREATE TABLE ... USING csv, then INSERT OVERWRITE twice."""
    name = _own_name("nation")
    T(spark, sf_dir, "nation").createOrReplaceTempView(f"{name}_src")
    delimited.create_csv_table(spark, name, "n_nationkey int, n_name string, "
                               "n_regionkey int", scratch_path(spark, "nation_csv"))
    for _ in range(2):  # the second load replaces the first
        sinks.insert_overwrite(spark, name, f"SELECT n_nationkey, n_name, n_regionkey FROM {name}_src")
    return spark.table(name)  # resolved after the loads: current file listing


# ---------------------------------------------------------------- JSON / SQL lab

ORDERS_JSON_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    "o_orderdate", "o_orderpriority"]


def _orders_json(spark, sf_dir) -> DataFrame:
    out = scratch_path(spark, "orders_json")
    T(spark, sf_dir, "orders").select(*ORDERS_JSON_COLS).write.json(out)
    return jsonsrc.read_json(spark, out)


@query("json_scan")
def q_json_scan(spark, sf_dir):
    """JSON lines with an inferred schema, projected. A timestamp is
    text to the inference."""
    return _orders_json(spark, sf_dir).select(*ORDERS_JSON_COLS)


@query("json_schema")
def q_json_schema(spark, sf_dir):
    """The schema inferred from the JSON lines, as a table."""
    return jsonsrc.schema_rows(spark, _orders_json(spark, sf_dir))


@query("json_group_count")
def q_json_group_count(spark, sf_dir):
    """Group count over the JSON scan."""
    return relational.count_by_key(_orders_json(spark, sf_dir), "o_orderpriority")


@query("json_filter_gt")
def q_json_filter_gt(spark, sf_dir):
    """Numeric threshold filter over the JSON scan."""
    df = _orders_json(spark, sf_dir)
    return df.where(F.col("o_totalprice") > TOTALPRICE_MIN).select("o_orderkey", "o_totalprice")


@query("view_sql")
def q_view_sql(spark, sf_dir):
    """SQL projection + filter over a registered view."""
    name = _own_name("customers")
    T(spark, sf_dir, "customer").createOrReplaceTempView(name)
    return spark.sql(f"SELECT c_name FROM {name} WHERE c_acctbal > {ACCTBAL_MIN}")


@query("project_cols")
def q_project_cols(spark, sf_dir):
    """B1: one-column projection (the scan reads that column only)."""
    return T(spark, sf_dir, "part").select("p_name")


@query("project_arith")
def q_project_arith(spark, sf_dir):
    """B2: column plus one."""
    c = T(spark, sf_dir, "customer")
    return c.select("c_name", (F.col("c_acctbal") + 1).alias("acctbal_plus_one"))


@query("filter_gt")
def q_filter_gt(spark, sf_dir):
    """Numeric threshold filter (pushed into the parquet scan)."""
    p = T(spark, sf_dir, "part")
    return (p.where(F.col("p_retailprice") > RETAILPRICE_MIN)
             .select("p_partkey", "p_name", "p_retailprice"))


@query("literal_rows")
def q_literal_rows(spark, sf_dir):
    """A literal lookup table joined to order counts per status."""
    labels = literal.literal_table(spark, [("F", "finished"), ("O", "open"), ("P", "partial")],
                                   "o_orderstatus string, status_label string")
    counts = relational.count_by_key(T(spark, sf_dir, "orders"), "o_orderstatus")
    # A literal table has a known size (its rows are in the plan), so it is
    # broadcast; a frame made from local rows carries no size statistics.
    return counts.join(F.broadcast(labels), "o_orderstatus", "left")


@query("preview_bounded")
def q_preview_bounded(spark, sf_dir):
    """The ten largest orders (a preview is the feature)."""
    orders = T(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return relational.top_n(orders, 10, F.col("o_totalprice").desc(), F.col("o_orderkey"))


# ---------------------------------------------------------------- grouped aggregates

@query("count_by_key")
def q_count_by_key(spark, sf_dir):
    """Customers per region; counted per nation key before the
    (tiny) dimension joins, so the big side is reduced map-side first."""
    per_nation = relational.count_by_key(T(spark, sf_dir, "customer"), "c_nationkey")
    nation = T(spark, sf_dir, "nation")
    region = T(spark, sf_dir, "region")
    joined = (per_nation.join(nation, per_nation.c_nationkey == nation.n_nationkey)
              .join(region, nation.n_regionkey == region.r_regionkey))
    return joined.groupBy("r_name").agg(F.sum("n").cast("bigint").alias("n"))


@query("sum_by_key_or_zero")
def q_sum_by_key_or_zero(spark, sf_dir):
    """Sum of the integer in props.k per event type; bad text is 0."""
    ev = T(spark, sf_dir, "events")
    return relational.sum_by_key_or_zero(
        ev.select("event_type", F.get_json_object("props", "$.k").alias("t")),
        "event_type", "t")


@query("sum_by_key_all_bad")
def q_sum_by_key_all_bad(spark, sf_dir):
    """Decimal text never parses as an integer; every group shows 0, and
    none is lost."""
    ev = T(spark, sf_dir, "events")
    return relational.sum_by_key_or_zero(
        ev.select("event_type", _s("value").alias("t")), "event_type", "t")


@query("quoted_sum_by_key")
def q_quoted_sum_by_key(spark, sf_dir):
    """Quoted lines, field 2 is the key, field 6 the number text."""
    out = scratch_path(spark, "events_quoted")
    ev = T(spark, sf_dir, "events")
    fields = [_s("event_id"), _s("user_id"), F.col("event_type"), F.col("props"),
              _s("value"), _s("ts"), F.get_json_object("props", "$.k"), _s("event_id")]
    # concat_ws skips nulls, which would shift positions: nulls become empty fields
    fields = [F.coalesce(f, F.lit("")) for f in fields]
    ev.select(F.concat(F.lit('"'), F.concat_ws('","', *fields), F.lit('"')).alias("value")) \
        .write.text(out)
    parsed = delimited.quoted_fields(text.read_lines(spark, out), {"event_type": 2, "t": 6})
    return relational.sum_by_key_or_zero(parsed, "event_type", "t")


@query("distinct_set_line")
def q_distinct_set_line(spark, sf_dir):
    """The distinct market segments as one sorted comma-joined line."""
    return relational.distinct_set_line(T(spark, sf_dir, "customer"), "c_mktsegment",
                                        out="segments")


@query("distinct_set_rows")
def q_distinct_set_rows(spark, sf_dir):
    """The distinct part names as sorted rows, any number of them."""
    return relational.distinct_values(T(spark, sf_dir, "part"), "p_name")


@query("filtered_sum")
def q_filtered_sum(spark, sf_dir):
    """Sum over the rows with a string key equal to a constant."""
    c = T(spark, sf_dir, "customer")
    s = relational.filtered_sum(c, F.col("c_mktsegment") == SEGMENT, "c_acctbal")
    return s.select(parse.round_half_away("total", 2).alias("total"))


@query("grouped_sum")
def q_grouped_sum(spark, sf_dir):
    """Balance per nation name, summed per key before the dimension join."""
    per_key = relational.sum_by_key(T(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal")
    nation = T(spark, sf_dir, "nation")
    j = per_key.join(nation, per_key.c_nationkey == nation.n_nationkey)
    return j.select("n_name", parse.round_half_away("total", 2).alias("total"))


@query("sql_grouped_sum")
def q_sql_grouped_sum(spark, sf_dir):
    """The same shape in SQL over views."""
    return spark.sql("SELECT c_mktsegment, round(sum(c_acctbal), 2) AS total "
                     "FROM {customer} GROUP BY c_mktsegment", customer=T(spark, sf_dir, "customer"))


@query("sql_filtered_sum")
def q_sql_filtered_sum(spark, sf_dir):
    """Filtered global sum in SQL over a view."""
    return spark.sql("SELECT round(sum(c_acctbal), 2) AS total FROM {customer} "
                     f"WHERE c_mktsegment = '{SEGMENT}'", customer=T(spark, sf_dir, "customer"))


@query("global_count")
def q_global_count(spark, sf_dir):
    """Row count."""
    return relational.global_count(T(spark, sf_dir, "lineitem"))


@query("inner_join_comma")
def q_inner_join_comma(spark, sf_dir):
    """Comma join with an equality in WHERE, planned as an equi-join."""
    return spark.sql("SELECT o.o_orderkey, c.c_name, o.o_totalprice "
                     "FROM {orders} o, {customer} c WHERE o.o_custkey = c.c_custkey",
                     orders=T(spark, sf_dir, "orders"), customer=T(spark, sf_dir, "customer"))


@query("sql_distinct")
def q_sql_distinct(spark, sf_dir):
    """SELECT DISTINCT over a view."""
    return spark.sql("SELECT DISTINCT p_type FROM {part}", part=T(spark, sf_dir, "part"))


@query("distinct_projection")
def q_distinct_projection(spark, sf_dir):
    """distinct pairs of a projection."""
    return relational.distinct_rows(T(spark, sf_dir, "part"), "p_brand", "p_type")


@query("split_by_hash")
def q_split_by_hash(spark, sf_dir):
    """70/30 split by key hash, stable across partitionings."""
    o = T(spark, sf_dir, "orders").select("o_orderkey")
    return relational.split_label(o, ["o_orderkey"], [0.7, 0.3])


@query("random_split")
def q_random_split(spark, sf_dir):
    """seeded randomSplit; every key is in exactly one part, and the first
    part's share is near its weight (within 0.05 at any of the test sizes)."""
    o = T(spark, sf_dir, "orders").select("o_orderkey")
    parts = relational.random_split(o, [0.7, 0.3], seed=42)
    tagged = parts[0].withColumn("part", F.lit(0)).unionByName(
        parts[1].withColumn("part", F.lit(1)))
    near = tagged.agg((F.abs(F.avg(F.lit(1) - F.col("part")) - 0.7) < 0.05).alias("near")).scalar()
    return (tagged.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("parts"))
                  .withColumn("near_weights", near))


@query("sort_order")
def q_sort_order(spark, sf_dir):
    """Inversions in the delivered order of sorted rows, in and between
    partitions."""
    li = T(spark, sf_dir, "lineitem").select("l_extendedprice")
    return relational.order_report(relational.sort_by(li, "l_extendedprice"), "l_extendedprice")


# ---------------------------------------------------------------- recodes

@query("binary_recode")
def q_binary_recode(spark, sf_dir):
    """Two-valued recodes with an else branch."""
    o = T(spark, sf_dir, "orders")
    return o.select("o_orderkey",
                    parse.recode_binary("o_orderstatus", "F", 1.0, 2.0).alias("status_code"),
                    parse.recode_binary("o_orderpriority", "1-URGENT", 0.0, 1.0)
                    .alias("urgent_code"))


@query("indicators")
def q_indicators(spark, sf_dir):
    """Flags for three listed part types; other types are all zero."""
    p = T(spark, sf_dir, "part")
    return p.select("p_partkey", *parse.indicators("p_type", {
        "is_economy": "ECONOMY", "is_standard": "STANDARD", "is_promo": "PROMO"}))


@query("impute_sentinel")
def q_impute_sentinel(spark, sf_dir):
    """Documents without a label show '?', imputed by a constant."""
    d = T(spark, sf_dir, "documents").select("doc_id")
    lab = T(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    q_text = F.coalesce(_s("quality"), F.lit("?"))
    return j.select("doc_id", parse.impute_sentinel(q_text, 0.5).alias("quality_filled"))


# ---------------------------------------------------------------- statistics

def _lineitem_numeric(spark, sf_dir):
    li = T(spark, sf_dir, "lineitem")
    return li, parse.numeric_columns(li)


@query("summary_stats")
def q_summary_stats(spark, sf_dir):
    """describe() of every numeric column, one aggregation pass."""
    li, cols = _lineitem_numeric(spark, sf_dir)
    s = profile.summary_stats(li, cols)
    return s.select("column", "count", parse.round_half_away("mean", 6).alias("mean"),
                    parse.round_half_away("stddev", 6).alias("stddev"),
                    F.col("min").cast("double").alias("min"), F.col("max").cast("double").alias("max"))


@query("summary_stats_mixed")
def q_summary_stats_mixed(spark, sf_dir):
    """describe() of a table with text columns; min and max in the own type."""
    c = T(spark, sf_dir, "customer")
    s = profile.summary_stats(c, CUSTOMER_COLS)
    return s.select("column", "count", parse.round_half_away("mean", 6).alias("mean"),
                    parse.round_half_away("stddev", 6).alias("stddev"), "min", "max")


@query("mean_std")
def q_mean_std(spark, sf_dir):
    """Mean and stddev vectors of the measures, one row."""
    m = profile.mean_std(T(spark, sf_dir, "lineitem"), LINEITEM_MEASURES)
    return m.select(*[parse.round_half_away(c, 6).alias(c) for c in m.columns])


@query("corr_with_target")
def q_corr_with_target(spark, sf_dir):
    """Correlation of every numeric column with the price."""
    li, cols = _lineitem_numeric(spark, sf_dir)
    r = profile.corr_with_target(li, "l_extendedprice", cols)
    return r.select("column", parse.round_half_away("corr", 8).alias("corr"))


@query("center_scale")
def q_center_scale(spark, sf_dir):
    """(x - mean) / stddev per row for the measures."""
    li = T(spark, sf_dir, "lineitem")
    s = profile.center_scale(li, LINEITEM_MEASURES, keep=["l_orderkey", "l_linenumber"])
    return s.select("l_orderkey", "l_linenumber",
                    *[parse.round_half_away(c, 6).alias(c) for c in LINEITEM_MEASURES])


@query("vector_roundtrip")
def q_vector_roundtrip(spark, sf_dir):
    """Columns assembled into a vector and unpacked again."""
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity",
                                             "l_extendedprice", "l_discount")
    v = vectors.assemble(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return vectors.unpack(v, "features", ["f0", "f1", "f2"], keep=["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- features

@query("string_index")
def q_string_index(spark, sf_dir):
    """H1: brand index by descending frequency, ties alphabetical."""
    p = T(spark, sf_dir, "part").select("p_partkey", "p_brand")
    out, _ = features.string_index(p, "p_brand", "brand_index")
    return out


@query("index_numeric_label")
def q_index_numeric_label(spark, sf_dir):
    """H2: index of a numeric label (by its text form)."""
    lab = T(spark, sf_dir, "labels").select("doc_id", "quality")
    out, _ = features.string_index(lab, "quality", "quality_index")
    return out


@query("tf_idf")
def q_tf_idf(spark, sf_dir):
    """H3 H4: term frequency and IDF per (item, term) of the benchmark texts."""
    t = features.tf_idf_table(T(spark, sf_dir, "benchmark"), "item_id", "text")
    return t.select("item_id", "term", "tf", "df", parse.round_half_away("idf", 8).alias("idf"),
                    parse.round_half_away("tf_idf", 8).alias("tf_idf"))


PCA_COLS = ["l_quantity", "l_discount"]


@query("pca_2d")
def q_pca_2d(spark, sf_dir):
    """H5: two principal components of two measures, signs fixed."""
    li = T(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *PCA_COLS)
    # The fit passes over its two columns several times.
    with sinks.persisted(T(spark, sf_dir, "lineitem", heavy=True).select(*PCA_COLS)) as kept:
        comps = features.fit_pca_columns(kept, PCA_COLS, 2)
    out = features.pca_project(li, PCA_COLS, comps, keep=["l_orderkey", "l_linenumber"])
    return out.select("l_orderkey", "l_linenumber", parse.round_half_away("pc1", 4).alias("pc1"),
                      parse.round_half_away("pc2", 4).alias("pc2"))


# ---------------------------------------------------------------- models

def _labelled_docs(spark, sf_dir):
    """Documents with a quality label."""
    d = T(spark, sf_dir, "documents", heavy=True).select("doc_id", "text", "lang")
    lab = T(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double")
                                            .alias("label"))
    return d.join(lab, "doc_id")


NB_LANGS = ["de", "en", "es", "fr"]


@query("nb_flags")
def q_nb_flags(spark, sf_dir):
    """Naive Bayes on language flags; its log priors and conditionals."""
    docs = _labelled_docs(spark, sf_dir)
    flags = docs.select("label", *parse.indicators("lang", {l: l for l in NB_LANGS}))
    v = vectors.assemble(flags, NB_LANGS)
    model = models.naive_bayes().fit(v)
    p = models.naive_bayes_params(spark, model, NB_LANGS)
    return p.select("label", "feature", parse.round_half_away("log_prior", 8).alias("log_prior"),
                    parse.round_half_away("log_theta", 8).alias("log_theta"))


LINREG_FEATURES = ["l_quantity", "l_discount", "l_tax"]


@query("linreg")
def q_linreg(spark, sf_dir):
    """Price from three measures, fitted on 90%, predicted on 10%."""
    li = T(spark, sf_dir, "lineitem", heavy=True).select("l_orderkey", "l_linenumber",
                                                         *LINREG_FEATURES,
                                             F.col("l_extendedprice").alias("label"))
    v = vectors.assemble(li, LINREG_FEATURES)
    train, test = relational.hash_split(v, ["l_orderkey", "l_linenumber"], [0.9, 0.1])
    model = models.linear_regression(train)
    return model.transform(test).select("l_orderkey", "l_linenumber", "label",
                                        parse.round_half_away("prediction", 1).alias("prediction"))


@query("linreg_report")
def q_linreg_report(spark, sf_dir):
    """One-feature least squares over all rows: slope, intercept, R^2."""
    li = T(spark, sf_dir, "lineitem").select("l_quantity",
                                             F.col("l_extendedprice").alias("label"))
    with sinks.persisted(vectors.assemble(li, ["l_quantity"])) as kept:  # fit and R^2
        model = models.linear_regression(kept)
        r2 = evaluate.r2(model.transform(kept)).first()["r2"]
    report = literal.literal_table(spark, [(float(model.coefficients[0]),
                                            float(model.intercept), float(r2))],
                                   "slope double, intercept double, r2 double")
    return report.select(parse.round_half_away("slope", 4).alias("slope"),
                         parse.round_half_away("intercept", 4).alias("intercept"),
                         parse.round_half_away("r2", 8).alias("r2"))


@query("linreg_coefficients")
def q_linreg_coefficients(spark, sf_dir):
    """Three-feature least squares over all rows; coefficients and intercept."""
    li = T(spark, sf_dir, "lineitem").select(*LINREG_FEATURES,
                                             F.col("l_extendedprice").alias("label"))
    model = models.linear_regression(vectors.assemble(li, LINREG_FEATURES))
    rep = models.regression_report(spark, model, LINREG_FEATURES)
    return rep.select("term", parse.round_half_away("value", 4).alias("value"))


def _embeddings(spark, sf_dir):
    e = T(spark, sf_dir, "embeddings")
    return vectors.array_as_vector(e, "embedding").withColumn("label",
                                                              F.col("label").cast("double"))


@query("decision_tree")
def q_decision_tree(spark, sf_dir):
    """Depth-2 tree on the embedding vectors, 90/10 split: the held-out rows,
    with whether the prediction is that of the tree's rules, and training accuracy
    at least the share of the most frequent class."""
    train, test = relational.hash_split(_embeddings(spark, sf_dir), ["vec_id"], [0.9, 0.1])
    with sinks.persisted(train) as kept:
        model = models.decision_tree(kept)
        beats = _beats_majority(model.transform(kept))
    x = vector_to_array("features")
    rule = trees.rule_column(trees.tree_nodes(spark, model), [x[i] for i in range(model.numFeatures)])
    return model.transform(test).select("vec_id", "label", (F.col("prediction") == rule).alias("follows_rules"),
                                        F.lit(beats).alias("beats_majority"))


def _beats_majority(pred: DataFrame, label: str = "label") -> bool:
    """Whether accuracy reaches the share of the most frequent class."""
    acc = evaluate.accuracy(pred, label).first()["accuracy"]
    share = (relational.count_by_key(pred, label).agg(F.max("n") / F.sum("n"))).first()[0]
    return bool(acc >= share - 1e-12)


@query("tree_report")
def q_tree_report(spark, sf_dir):
    """I4: the report of the depth-2 tree: depth and nodes within bounds, and one
    printed line per node and branch."""
    train, _ = relational.hash_split(_embeddings(spark, sf_dir), ["vec_id"], [0.9, 0.1])
    r = models.tree_report(spark, models.decision_tree(train))
    lines = F.size(F.split("rules", "\n")) - 2  # a heading and an empty end
    return r.select((F.col("depth").between(1, 2)).alias("depth_ok"),
                    (F.col("num_nodes").between(3, 7)).alias("nodes_ok"),
                    # every inner node prints two branches, every leaf one line
                    (lines == F.col("num_nodes") - 1 + (F.col("num_nodes") + 1) / 2).alias("rules_ok"))


@query("random_forest_pca")
def q_random_forest_pca(spark, sf_dir):
    """PCA(3) of four measures, indexed return flag, random forest: the
    held-out rows with their index, predictions within the classes."""
    li = tables.spread_rows(T(spark, sf_dir, "lineitem"), SPREAD_KEYS["lineitem"], models.TREE_ROWS).select(
        "l_orderkey", "l_linenumber", "l_returnflag", *LINEITEM_MEASURES)
    comps = features.fit_pca_columns(li, LINEITEM_MEASURES, 3)
    pcs = features.pca_project(li, LINEITEM_MEASURES, comps,
                               keep=["l_orderkey", "l_linenumber", "l_returnflag"])
    v = vectors.assemble(pcs, ["pc1", "pc2", "pc3"], out="pcaFeatures")
    p, indexer = features.string_index(v, "l_returnflag", "indexed")
    train, test = relational.hash_split(p, ["l_orderkey", "l_linenumber"], [0.7, 0.3])
    # The fit keeps its projected, indexed training rows; prediction is one narrow pass.
    rf = models.random_forest(train, features="pcaFeatures", label="indexed")
    classes = [float(i) for i in range(len(indexer.labels))]
    return rf.transform(test).select("l_orderkey", "l_linenumber", "indexed",
                                     F.col("prediction").isin(*classes).alias("in_classes"))


KMEANS_K = 5


def _kmeans_predictions(spark, sf_dir):
    e = _embeddings(spark, sf_dir)
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True,
                            withStd=True).fit(e)
    scaled = scaler.transform(e).select("vec_id", F.col("scaled").alias("features"))
    model = models.kmeans(scaled, k=KMEANS_K, seed=1)
    return model.transform(scaled), [[float(x) for x in c] for c in model.clusterCenters()]


@query("kmeans")
def q_kmeans(spark, sf_dir):
    """Centred and scaled embeddings, k-means k=5 seed 1: for every row
    whether its cluster's centre is the nearest, and the clusters in use."""
    pred, centres = _kmeans_predictions(spark, sf_dir)
    x = vector_to_array("features")
    apart = [F.aggregate(F.zip_with(x, F.array(*[F.lit(v) for v in c]), lambda a, b: (a - b) * (a - b)),
                         F.lit(0.0), lambda a, d: a + d) for c in centres]
    far = pred.select("vec_id", "prediction", F.array(*apart).alias("d"))
    used = far.agg(F.count_distinct("prediction")).scalar()
    nearest = F.col("d").getItem(F.col("prediction")) <= F.array_min("d") * (1 + 1e-9)
    return far.select("vec_id", nearest.alias("nearest"), used.alias("clusters"))


@query("cluster_scatter")
def q_cluster_scatter(spark, sf_dir):
    """(cluster, x, y) per row, the data behind the scatter plot."""
    pred, _ = _kmeans_predictions(spark, sf_dir)
    s = models.cluster_scatter(pred, keep=["vec_id"])
    return s.select("vec_id", F.col("cluster").between(0, KMEANS_K - 1).alias("in_clusters"),
                    parse.round_half_away("x", 4).alias("x"), parse.round_half_away("y", 4).alias("y"))


def _ratings(spark, sf_dir):
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = T(spark, sf_dir, "lineitem", heavy=True).select("l_orderkey", "l_partkey",
                                                         "l_quantity")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.groupBy("o_custkey", "l_partkey").agg(F.sum("l_quantity").cast("float")
                                                    .alias("rating"))


def _als(spark, sf_dir):
    """``(model, train, test)``; ids are numbered from the keys."""
    with sinks.persisted(_ratings(spark, sf_dir)) as kept:  # both numberings read it
        r, _ = models.dense_ids(kept, "o_custkey", "user")
        r, _ = models.dense_ids(r, "l_partkey", "item")
        r = sinks.cut_lineage(r)  # fit and predictions read the numbered ratings
    train, test = relational.hash_split(r, ["o_custkey", "l_partkey"], [0.9, 0.1])
    return models.als(train), train, test


@query("als_factors")
def q_als_factors(spark, sf_dir):
    """User factor table sorted by id, under the users' keys."""
    model, train, _ = _als(spark, sf_dir)
    keys = train.select("o_custkey", F.col("user").alias("id")).distinct()
    return (models.factors(model, "user").join(keys, "id")
            .select("o_custkey", F.size("features").alias("factors"),
                    (~F.exists("features", F.isnan)).alias("finite")))


@query("als_fit")
def q_als_fit(spark, sf_dir):
    """I8: the fitted model's shape: rank and factor rows per side."""
    model, _, _ = _als(spark, sf_dir)
    n_users = model.userFactors.agg(F.count(F.lit(1)).alias("num_users"))
    n_items = model.itemFactors.agg(F.count(F.lit(1)).alias("num_items"))
    return n_users.select(F.lit(model.rank).alias("rank"), "num_users",
                          n_items.scalar().alias("num_items"))


@query("als_predict")
def q_als_predict(spark, sf_dir):
    """Ratings of held-out (user, item) pairs: a prediction is the dot
    product of the factors, NaN exactly when a key was not trained on."""
    model, _, test = _als(spark, sf_dir)
    pred = model.transform(test)
    users = model.userFactors.toDF("user", "uf")
    items = model.itemFactors.toDF("item", "vf")
    dot = F.aggregate(F.zip_with("uf", "vf", lambda a, b: a.cast("double") * b),
                      F.lit(0.0), lambda a, x: a + x)
    both = pred.join(users, "user", "left").join(items, "item", "left")
    unseen = F.col("uf").isNull() | F.col("vf").isNull()
    fits = F.when(unseen, F.isnan("prediction")).otherwise(F.abs(dot - F.col("prediction")) < 1e-3)
    return both.select("o_custkey", "l_partkey", F.col("rating").cast("double").alias("rating"),
                       unseen.alias("unseen"), fits.alias("fits"))


# ---------------------------------------------------------------- evaluation

def _rule_predictions(spark, sf_dir):
    d = T(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = T(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id")
    return j.select(F.col("quality").cast("double").alias("label"),
                    F.when(F.col("n_chars") >= LONG_DOC_CHARS, 1.0).otherwise(0.0)
                    .alias("prediction"))


@query("accuracy")
def q_accuracy(spark, sf_dir):
    """Accuracy of the long-document rule against the quality label."""
    a = evaluate.accuracy(_rule_predictions(spark, sf_dir))
    return a.select(parse.round_half_away("accuracy", 10).alias("accuracy"))


@query("confusion")
def q_confusion(spark, sf_dir):
    """Confusion counts of the same rule."""
    return evaluate.confusion(_rule_predictions(spark, sf_dir))


# ---------------------------------------------------------------- streaming

def _stream_counts(spark, feed_lines: DataFrame, col: str) -> DataFrame:
    """Replay lines as files, run the per-batch word count to the end of the
    files, and sum the per-batch counts per token."""
    feed = scratch_path(spark, "stream_feed")
    streaming.replay_as_files(feed_lines, feed, col=col)
    sink = scratch_path(spark, "stream_sink")
    ckpt = scratch_path(spark, "stream_ckpt")
    lines = streaming.file_lines(spark, feed)
    q = streaming.per_batch_word_count(lines, sink, ckpt, available_now=True)
    q.awaitTermination()
    per_batch = streaming.read_batches(spark, sink)
    return per_batch.groupBy(F.col("word").alias("token")).agg(
        F.sum("n").cast("bigint").alias("n"))


@query("stream_word_count")
def q_stream_word_count(spark, sf_dir):
    """Documents replayed as files, per-batch counts, summed."""
    return _stream_counts(spark, T(spark, sf_dir, "documents", heavy=True), "text")


@query("stream_interval_count")
def q_stream_interval_count(spark, sf_dir):
    """K2 K3: batches at a fixed interval, run until the feed is used up and then
    stopped within a bounded time."""
    feed = scratch_path(spark, "stream_feed")
    streaming.replay_as_files(T(spark, sf_dir, "conversations"), feed, col="text")
    sink = scratch_path(spark, "stream_sink")
    q = streaming.per_batch_word_count(streaming.file_lines(spark, feed), sink,
                                       scratch_path(spark, "stream_ckpt"), processing_time="1 second")
    try:
        q.processAllAvailable()
    finally:
        streaming.run_for(q, 0.1)
    return streaming.read_batches(spark, sink).groupBy(F.col("word").alias("token")).agg(
        F.sum("n").cast("bigint").alias("n"))


@query("stream_book_feed")
def q_stream_book_feed(spark, sf_dir):
    """The book-server feed (punctuation stripped, empty lines dropped)
    streamed and counted per batch."""
    return _stream_counts(spark, textf.normalize_lines(doc_lines(spark, sf_dir)), "value")


@query("stream_dictionary_feed")
def q_stream_dictionary_feed(spark, sf_dir):
    """The dictionary-server feed (first 1000 lines) streamed and counted."""
    first = text.first_n_lines(doc_lines(spark, sf_dir), 1000, ["doc_id", "line_no"])
    return _stream_counts(spark, first, "value")


# ---------------------------------------------------------------- user code

def _price_band(price):
    import numpy as np
    return np.floor(price / 50000.0).astype("int64")


@query("udf_scalar")
def q_udf_scalar(spark, sf_dir):
    """L1: vectorised row function."""
    band = udfs.scalar_udf(_price_band, "bigint")
    o = T(spark, sf_dir, "orders")
    return o.select("o_orderkey", band("o_totalprice").alias("price_band"))


def _is_high_priority(p):
    return p.str.startswith("1-") | p.str.startswith("2-")


@query("udf_predicate")
def q_udf_predicate(spark, sf_dir):
    """L2: vectorised row predicate."""
    pred = udfs.predicate_udf(_is_high_priority)
    o = T(spark, sf_dir, "orders")
    return o.where(pred("o_orderpriority")).select("o_orderkey", "o_orderpriority")


def _priority_parts(pdf):
    import pandas as pd
    parts = pdf["o_orderpriority"].str.split("-", regex=False)
    out = pd.DataFrame({"o_orderkey": pdf["o_orderkey"], "part": parts}).explode("part")
    out["pos"] = out.groupby(level=0).cumcount().astype("int32") + 1
    return out[["o_orderkey", "pos", "part"]].reset_index(drop=True)


@query("udf_explode")
def q_udf_explode(spark, sf_dir):
    """L3: one-to-many user function over Arrow batches."""
    o = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return udfs.flat_map(o, _priority_parts, "o_orderkey bigint, pos int, part string")


def _series_sum(v):
    return float(v.sum())


@query("udf_agg")
def q_udf_agg(spark, sf_dir):
    """L4: user fold per key with a map-side combine."""
    o = T(spark, sf_dir, "orders")
    s = udfs.fold_by_key(o, "o_orderstatus", "o_totalprice", _series_sum, out="total")
    return s.select("o_orderstatus", parse.round_half_away("total", 2).alias("total"))


def _text_set(v):
    return ",".join(sorted({x for part in v.dropna() for x in part.split(",")}))


@query("udf_agg_text")
def q_udf_agg_text(spark, sf_dir):
    """A fold of text to text: the set of priorities per status."""
    o = T(spark, sf_dir, "orders")
    return udfs.fold_by_key(o, "o_orderstatus", "o_orderpriority", _text_set, out="priorities",
                            result_type="string")


@query("udf_agg_long")
def q_udf_agg_long(spark, sf_dir):
    """L4: 64-bit integers stay exact (values near 2^53 and beyond)."""
    o = T(spark, sf_dir, "orders").select("o_orderstatus", (F.col("o_orderkey") + F.lit(2**53)).alias("k"))
    return udfs.fold_by_key(o, "o_orderstatus", "k", lambda v: int(v.max()), out="largest",
                            result_type="bigint")


def queries() -> dict[str, QueryFn]:
    return dict(REGISTRY)
