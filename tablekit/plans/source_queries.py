"""Queries over sources and sinks: line positions, split sizes, staged replacement,
JSON read once, batch ledgers, functions in SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import sinks, streaming
from ..operators import relational, sql_functions
from ..session import scratch_path
from ..sinks import staged
from ..sources import json as jsonsrc, literal, positions, splits, tables, text, variant
from ..streaming import ledger as batches
from .oracles import JSON_DATE, WORD_COUNT, ORACLES as ORACLES_BASE
from .queries import ORDERS_JSON_COLS, T, _documents_as_text_files, _own_name, q_word_count, query

#: Folders of the numbered text files, bytes of a split in these scans. Each split is a task
#: whose result the driver keeps, so beyond as many splits grow, up to those of any scan.
FOLDERS, SPLIT_BYTES, MOST_SPLITS = 4, 64 << 10, 1000
#: Bytes of text that one task writes into these folders.
PART_BYTES, MOST_PARTS = 32 << 20, 99_999  # part numbers of five digits: by path is by number
FIRST_LINES = 1000

_FILE_LINES = ("(SELECT file, doc_id, generate_subscripts(parts, 1) AS k, unnest(parts) AS value FROM "
               f"(SELECT doc_id % {FOLDERS} AS file, doc_id, string_split(text, chr(10)) AS parts FROM documents))")
_PLACES = (f"(SELECT file, row_number() OVER (PARTITION BY file ORDER BY doc_id, k) AS line_no, "
           f"row_number() OVER (ORDER BY file, doc_id, k) AS position, value FROM {_FILE_LINES})")


# ---------------------------------------------------------------- lines by position

def _folders_of_lines(spark, sf_dir) -> str:
    """Documents as text in folders, a folder's part files and their lines by ascending ids.

    Documents are dealt by ranges of folder and id, as many as their bytes need: a task
    writes a bounded part of a folder, and the order of the paths is that of the ids.
    """
    out = scratch_path(spark, "numbered_files")
    docs = T(spark, sf_dir, "documents").select((F.col("doc_id") % FOLDERS).alias("file"), "doc_id",
                                                F.col("text").alias("value"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("value")), F.lit(0))).first()[0]
    parts = min(MOST_PARTS, max(FOLDERS, -(-size // PART_BYTES)))
    (docs.repartitionByRange(parts, "file", "doc_id").sortWithinPartitions("file", "doc_id").drop("doc_id")
         .write.partitionBy("file").text(out))
    return out


def _small_splits(spark, path):
    """A session that cuts the files into several splits, about ``MOST_SPLITS`` at most unless
    that takes splits larger than the session's own."""
    size = min(splits.total_bytes(spark, path) // MOST_SPLITS, tables.split_bytes(spark))
    return splits.split_session(spark, max(SPLIT_BYTES, size))


@query("file_positions")
def q_file_positions(spark, sf_dir):
    """Every line of a folder of files, read in splits, with its line number in
    the file (a folder of part files) and its place over all files."""
    path = _folders_of_lines(spark, sf_dir)
    lines = positions.positioned_lines(_small_splits(spark, path), path, parts=True)
    file = F.regexp_extract("file", r"/file=(\d+)/", 1).cast("bigint")
    return lines.select(file.alias("file"), "line_no", "position", "value")


@query("file_first_lines")
def q_file_first_lines(spark, sf_dir):
    """The first 1000 lines of the folder by place."""
    path = _folders_of_lines(spark, sf_dir)
    return positions.first_lines_of_files(_small_splits(spark, path), path, FIRST_LINES)


@query("file_drop_header")
def q_file_drop_header(spark, sf_dir):
    """A3: all lines of the folder that differ from its first line."""
    path = _folders_of_lines(spark, sf_dir)
    session = _small_splits(spark, path)
    return text.drop_lines_equal(session.read.text(path).select("value"), positions.first_line_of_files(session, path))


@query("min_partition_scan")
def q_min_partition_scan(spark, sf_dir):
    """A2: text scan in at least 16 splits, its lines dealt over 16 partitions; every
    line is read once, and all partitions hold lines (there are more lines than partitions)."""
    lines = text.read_lines(spark, _documents_as_text_files(spark, sf_dir), min_partitions=16).repartition(16)
    parts = lines.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return parts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("partitions"))


# ---------------------------------------------------------------- replacement

@query("staged_table")
def q_staged_table(spark, sf_dir):
    """A declared table, loaded twice by switching its location; the second load replaces the first."""
    name, folder = _own_name("nation"), scratch_path(spark, "nation_versions")
    nation = T(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    staged.replace_table(nation, name, folder)
    staged.replace_table(nation.where("n_regionkey < 3"), name, folder)
    return spark.table(name)


@query("staged_key_value")
def q_staged_key_value(spark, sf_dir):
    """Word counts as sorted key<TAB>value text that replaces an older output."""
    path = scratch_path(spark, "word_count_versions")
    staged.replace_key_value_text(relational.count_by_key(T(spark, sf_dir, "orders"), "o_orderpriority"), path,
                                  "o_orderpriority", "n")
    staged.replace_key_value_text(q_word_count(spark, sf_dir), path, "word", "n")
    return sinks.read_key_value_text(spark, staged.current_folder(spark, path), "word", "n")


@query("sink_order")
def q_sink_order(spark, sf_dir):
    """The order of the written files themselves: words that are smaller than the
    word on the line before, in a file and from one file to the next."""
    path = scratch_path(spark, "word_count_order")
    folder = staged.replace_key_value_text(q_word_count(spark, sf_dir), path, "word", "n")
    lines = positions.positioned_lines(spark, folder).withColumn("word", F.regexp_extract("value", r"(?s)^(.*)\t", 1))
    before = F.lag("word").over(Window.partitionBy("file").orderBy("line_no"))
    files = lines.withColumn("down", (before > F.col("word")).cast("int")).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("down"), F.lit(0)).alias("down"), F.min("position").alias("at"),
        F.min_by("word", "line_no").alias("first"), F.max_by("word", "line_no").alias("last"))
    # A row per file from here on.
    falls = (F.lag("last").over(Window.orderBy("at")) > F.col("first")).cast("bigint")
    return files.withColumn("falls", falls).agg(
        F.sum("n").alias("n"), F.sum("down").alias("inversions_within"),
        F.coalesce(F.sum("falls"), F.lit(0).cast("bigint")).alias("inversions_between"))


# ---------------------------------------------------------------- JSON read once

def _json_with_bad_lines(spark, sf_dir) -> str:
    """Orders as JSON lines; the lines of some orders are cut or hold no object."""
    out = scratch_path(spark, "orders_json")
    line = F.to_json(F.struct(*ORDERS_JSON_COLS))
    bad = F.when(F.col("o_orderkey") % 97 == 0, F.substring(line, 1, 20)).when(F.col("o_orderkey") % 89 == 0, F.lit("[1]"))
    T(spark, sf_dir, "orders").select(F.coalesce(bad, line).alias("value")).write.text(out)
    return out


@query("json_once")
def q_json_once(spark, sf_dir):
    """JSON lines with the schema found in the same scan; bad lines keep their text."""
    found = variant.read_json_once(spark, _json_with_bad_lines(spark, sf_dir))
    return found.select(*ORDERS_JSON_COLS, F.col(variant.BAD).alias("bad"))


@query("json_once_schema")
def q_json_once_schema(spark, sf_dir):
    """The schema found so, as a table: as inference finds it."""
    found = variant.read_json_once(spark, _json_with_bad_lines(spark, sf_dir), keep_bad=False)
    return jsonsrc.schema_rows(spark, found)


# ---------------------------------------------------------------- previews

@query("preview_text")
def q_preview_text(spark, sf_dir):
    """The console preview of the ten largest orders, line by line."""
    orders = T(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    lines = sinks.preview_lines(orders.orderBy("o_orderkey"), 10)
    return literal.literal_table(spark, list(enumerate(lines, 1)), "line_no int, line string")


@query("bounded_fetch")
def q_bounded_fetch(spark, sf_dir):
    """Five rows brought to the driver, as a table of literals."""
    parts = T(spark, sf_dir, "part").select("p_partkey", "p_name").orderBy("p_partkey")
    return literal.literal_table(spark, [tuple(r) for r in sinks.take_bounded(parts, 5)], "p_partkey bigint, p_name string")


# ---------------------------------------------------------------- batches

INTERVAL, RUN_BOUND, FEEDS = 2, 60, 4


def _feed(spark, sf_dir) -> tuple[str, DataFrame]:
    """Conversations replayed as files, one per feed; ``(folder, talks)``."""
    folder = scratch_path(spark, "feed")
    talks = T(spark, sf_dir, "conversations").select((F.col("conv_id") % FEEDS).alias("feed"), F.col("text").alias("value"))
    talks.repartition(1, "feed").write.partitionBy("feed").text(folder)
    return folder, talks


@query("stream_ledger")
def q_stream_ledger(spark, sf_dir):
    """K2 K3: one file per batch every two seconds, stopped once all files are used or a
    minute is over: lines and whether the interval was kept, over the batches' ledger,
    and that a file that comes after the stop is not read."""
    folder, talks = _feed(spark, sf_dir)
    name, sink = _own_name("ledger"), scratch_path(spark, "batches")
    book = batches.BatchLedger(name)
    spark.streams.addListener(book)
    try:
        lines = (spark.readStream.format("text").schema("value string, feed int")
                 .option("maxFilesPerTrigger", 1).load(folder))
        q = batches.per_batch_rows(lines, lambda b: b.agg(F.count(F.lit(1)).alias("lines")), sink,
                                   scratch_path(spark, "stream_ckpt"), name, f"{INTERVAL} seconds")
        ran = batches.run_bounded(q, RUN_BOUND, lambda: len(book.rows) >= FEEDS)
        talks.limit(5).select("value").write.text(f"{folder}/feed={FEEDS}")
    finally:
        spark.streams.removeListener(book)
    report = batches.interval_report(book.table(spark), INTERVAL)
    written = spark.read.parquet(sink).select("batch_id", "lines")
    return report.join(written, "batch_id", "full").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), F.sum("lines").alias("lines"),
        F.every("on_time").alias("on_time"),
        F.lit((FEEDS - 2) * INTERVAL <= ran <= RUN_BOUND + 5).alias("bounded"), F.lit(not q.isActive).alias("stopped"))


@query("stream_first_rows")
def q_stream_first_rows(spark, sf_dir):
    """The first ten words of every batch with their counts, as rows."""
    folder, _ = _feed(spark, sf_dir)
    name, sink = _own_name("first"), scratch_path(spark, "batches")

    def first(batch: DataFrame) -> DataFrame:
        feed = F.lit(batch.agg(F.max("feed")).first()[0])  # one file, one feed
        counts = streaming.batch_word_count(batch.where("value is not null")).where("word <> ''")
        return counts.orderBy("word").limit(streaming.FIRST_ROWS).withColumn("feed", feed)
    lines = (spark.readStream.format("text").schema("value string, feed int")
             .option("maxFilesPerTrigger", 1).load(folder))
    q = batches.per_batch_rows(lines, first, sink, scratch_path(spark, "stream_ckpt"), name, "0 seconds")
    q.processAllAvailable()
    q.stop()
    return spark.read.parquet(sink).select("feed", "word", "n")


# ---------------------------------------------------------------- functions in SQL text

@query("sql_udf_scalar")
def q_sql_udf_scalar(spark, sf_dir):
    """L1: a row function written in SQL: the optimizer puts its body into the plan."""
    band = sql_functions.sql_function(spark, _own_name("band"), "price double, width double", "bigint",
                                      "CAST(floor(price / width) AS bigint)")
    return spark.sql(f"SELECT o_orderkey, {band}(o_totalprice, 50000.0D) AS price_band FROM {{orders}}",
                     orders=T(spark, sf_dir, "orders"))


@query("sql_udf_predicate")
def q_sql_udf_predicate(spark, sf_dir):
    """L2: a row predicate written in SQL, which is pushed into the scan as its body is."""
    high = sql_functions.sql_function(spark, _own_name("high"), "priority string", "boolean",
                                      "startswith(priority, '1-') OR startswith(priority, '2-')")
    return spark.sql(f"SELECT o_orderkey, o_orderpriority FROM {{orders}} WHERE {high}(o_orderpriority)",
                     orders=T(spark, sf_dir, "orders"))


class PriorityParts:
    """The parts of a priority, one row each."""

    def eval(self, priority: str):
        for pos, part in enumerate(priority.split("-"), 1):
            yield pos, part


@query("udtf_lateral")
def q_udtf_lateral(spark, sf_dir):
    """L3: a one-to-many function called per row in SQL (lateral join)."""
    parts = sql_functions.table_function(spark, _own_name("parts"), PriorityParts, "pos int, part string")
    return spark.sql(f"SELECT o.o_orderkey, p.pos, p.part FROM {{orders}} o, LATERAL {parts}(o.o_orderpriority) p",
                     orders=T(spark, sf_dir, "orders"))


class Runs:
    """Runs of equal event types in one user's events, in order of time: a row each."""

    def __init__(self):
        self.user, self.kind, self.n = None, None, 0

    def eval(self, row):
        if self.n and row["event_type"] != self.kind:
            yield self.user, self.kind, self.n
            self.n = 0
        self.user, self.kind, self.n = row["user_id"], row["event_type"], self.n + 1

    def terminate(self):
        if self.n:
            yield self.user, self.kind, self.n


@query("udtf_table")
def q_udtf_table(spark, sf_dir):
    """L3 L4: a table function over a table dealt by user and ordered by time: it sees
    a user's rows as a stream and gives a row per run of equal event types."""
    runs = sql_functions.table_function(spark, _own_name("runs"), Runs, "user_id bigint, event_type string, n int")
    view = _own_name("events")
    T(spark, sf_dir, "events").select(F.col("user_id").cast("bigint").alias("user_id"), "event_type", "ts", "event_id") \
        .createOrReplaceTempView(view)
    return spark.sql(f"SELECT * FROM {runs}(TABLE({view}) PARTITION BY user_id ORDER BY (ts, event_id))")


def _preview_sql(n: int) -> str:
    """The console table of two columns: numbers and texts to the right."""
    return f"""
WITH r AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS i, o_orderkey::VARCHAR AS a, o_orderpriority AS b
           FROM orders ORDER BY o_orderkey LIMIT {n}),
w AS (SELECT greatest(max(length(a)), 10)::INTEGER AS x, greatest(max(length(b)), 15)::INTEGER AS y FROM r),
bar AS (SELECT '+' || repeat('-', x) || '+' || repeat('-', y) || '+' AS line FROM w)
SELECT 1::INTEGER AS line_no, line FROM bar
UNION ALL SELECT 2, '|' || lpad('o_orderkey', x, ' ') || '|' || lpad('o_orderpriority', y, ' ') || '|' FROM w
UNION ALL SELECT 3, line FROM bar
UNION ALL SELECT (3 + i)::INTEGER, '|' || lpad(a, x, ' ') || '|' || lpad(b, y, ' ') || '|' FROM r, w
UNION ALL SELECT {n + 4}, line FROM bar
UNION ALL SELECT {n + 5}, 'only showing top {n} rows'"""


_JSON_LINE = ("'{\"o_orderkey\":' || o_orderkey || ',\"o_custkey\":' || o_custkey || ',\"o_orderstatus\":\"' || "
              "o_orderstatus || '\"'")
ORACLES: dict[str, str] = {
    "file_positions": f"SELECT * FROM {_PLACES}",
    "file_first_lines": f"SELECT position, value FROM {_PLACES} WHERE position <= {FIRST_LINES}",
    "file_drop_header": f"WITH p AS {_PLACES} SELECT value FROM p WHERE value <> (SELECT value FROM p WHERE position = 1)",
    "min_partition_scan": "SELECT CAST(count(*) AS BIGINT) AS n, CAST(16 AS BIGINT) AS partitions FROM "
                          "(SELECT unnest(string_split(text, chr(10))) AS value FROM documents)",
    "staged_table": "SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_regionkey < 3",
    "staged_key_value": WORD_COUNT,
    "sink_order": "SELECT CAST(count(*) AS BIGINT) AS n, CAST(0 AS BIGINT) AS inversions_within, "
                  f"CAST(0 AS BIGINT) AS inversions_between FROM ({WORD_COUNT})",
    "json_once": (
        "SELECT " + ", ".join(f"CASE WHEN bad IS NULL THEN {c} END AS {c}" for c in (
            "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")) + ", CASE WHEN bad IS NULL THEN "
        + JSON_DATE.replace(" AS o_orderdate", "") + " END AS o_orderdate, CASE WHEN bad IS NULL THEN o_orderpriority END "
        "AS o_orderpriority, bad FROM (SELECT *, CASE WHEN o_orderkey % 97 = 0 THEN substr(" + _JSON_LINE + ", 1, 20) "
        "WHEN o_orderkey % 89 = 0 THEN '[1]' END AS bad FROM orders)"),
    "json_once_schema": ORACLES_BASE["json_schema"],
    "preview_text": _preview_sql(10),
    "bounded_fetch": "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5",
    "stream_ledger": f"SELECT CAST({FEEDS} AS BIGINT) AS batches, n AS rows, n AS lines, true AS on_time, "
                     "true AS bounded, true AS stopped FROM (SELECT CAST(count(*) AS BIGINT) AS n FROM "
                     "(SELECT unnest(string_split(text, chr(10))) FROM conversations))",
    "stream_first_rows": (
        "SELECT feed, word, n FROM (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY word) AS r FROM "
        f"(SELECT CAST(conv_id % {FEEDS} AS INTEGER) AS feed, word, CAST(count(*) AS BIGINT) AS n FROM "
        "(SELECT conv_id, unnest(string_split(line, ' ')) AS word FROM "
        "(SELECT conv_id, unnest(string_split(text, chr(10))) AS line FROM conversations)) "
        "WHERE word <> '' GROUP BY ALL)) WHERE r <= 10"),
    "sql_udf_scalar": "SELECT o_orderkey, CAST(floor(o_totalprice / 50000.0) AS BIGINT) AS price_band FROM orders",
    "sql_udf_predicate": "SELECT o_orderkey, o_orderpriority FROM orders WHERE starts_with(o_orderpriority, '1-') "
                         "OR starts_with(o_orderpriority, '2-')",
    "udtf_lateral": "SELECT o_orderkey, CAST(generate_subscripts(p, 1) AS INTEGER) AS pos, unnest(p) AS part FROM "
                    "(SELECT o_orderkey, string_split(o_orderpriority, '-') AS p FROM orders)",
    "udtf_table": (
        "SELECT user_id, event_type, CAST(count(*) AS INTEGER) AS n FROM (SELECT CAST(user_id AS BIGINT) AS user_id, event_type, "
        "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - "
        "row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS run FROM events) "
        "GROUP BY user_id, event_type, run"),
}
