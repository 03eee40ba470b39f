"""One query per operator, applied with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import langid, lm_score, merkle, toxicity
from .base import fold
from .chat_format import format_conversations, formatted_text, learned_text, parse_turns
from .decontaminate import contaminated
from .embedding_dedup import embedding_links
from .ngram_jaccard import jaccard_components
from .pack import pack
from .token_align import alignment
from .token_file import read_tokens, write_tokens
from .url_filter import filter_urls
from .warc import read_archive, write_archive

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS ws
  FROM documents WHERE doc_id IS NOT NULL),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
           ELSE ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * c >= 90 * (x.n + y.n - c)),
r AS (SELECT a AS doc_id, b AS root FROM l
      UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.root = l.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles,
       least(w.doc_id, coalesce(min(r.root), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN r ON r.doc_id = w.doc_id
GROUP BY w.doc_id
"""


@query("op7_ngram_jaccard", OP7_SQL)
def _(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op1_embedding_dedup", """
WITH RECURSIVE g AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
         -floor(log2(list_max(list_transform(embedding::DOUBLE[], lambda x: abs(x))))) AS k FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding::DOUBLE[], lambda x: x <> 0)) > 0),
v AS (SELECT vec_id, list_transform(e, lambda x: x * pow(2.0, floor(k / 2)) * pow(2.0, k - floor(k / 2))) AS e FROM g),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e)
            / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9),
r AS (SELECT a AS vec_id, b AS root FROM l UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.root = l.a),
c AS (SELECT vec_id, min(root) AS root FROM r GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links,
       least(e.vec_id, coalesce(c.root, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(c.root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN n ON n.vec_id = e.vec_id LEFT JOIN c ON c.vec_id = e.vec_id
""")
def _(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"))


@query("op8_warc_revisit", """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha1(coalesce(html, '')) AS h FROM pages WHERE page_id IS NOT NULL),
b AS (SELECT page_id, payload_bytes, h,
             list_reduce(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', substr(h, i, 1)) - 1), 4, '0')),
                         lambda x, y: x || y) AS bits FROM p),
d AS (SELECT page_id, payload_bytes,
             array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (1 + 16 * substr(bits, 5 * k + 1, 1)::INT + 8 * substr(bits, 5 * k + 2, 1)::INT
                  + 4 * substr(bits, 5 * k + 3, 1)::INT + 2 * substr(bits, 5 * k + 4, 1)::INT
                  + substr(bits, 5 * k + 5, 1)::INT)::BIGINT, 1)), '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM f
""")
def _(spark, sf_dir):
    path = scratch_path(spark, "llm", "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    return read_archive(spark, path)


#: Rows that the language model never learns from: remainder 2 of 4.
LANG_FOLDS, LANG_HELD_OUT = 4, 2


@query("op10_langid")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    remainder = fold("doc_id", LANG_FOLDS)
    model = langid.fit(docs.where(remainder != LANG_HELD_OUT), "text", "lang", "doc_id")
    return langid.predict(model, docs, "doc_id", "text",
                          [(remainder == LANG_HELD_OUT).alias("held_out")])


#: Labelled ids up to which they are sent to every task (16 bytes each); beyond, a merge join.
LABEL_ROWS = 1 << 20
#: Rows that the toxicity model never learns from: remainder 0 of 5.
TOXIC_FOLDS, TOXIC_HELD_OUT = 5, 0


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with their toxicity label, all but the held-out fold."""
    learn = labels.where("doc_id is not null").where(fold("doc_id", TOXIC_FOLDS) != TOXIC_HELD_OUT)
    learn = learn.where("toxic in (0, 1)").select("doc_id", "toxic")
    small = learn.count() <= LABEL_ROWS
    return docs.select("doc_id", "text", "lang").join(F.broadcast(learn) if small else learn.hint("merge"), "doc_id")


@query("op5_toxicity")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(labelled(docs, table(spark, sf_dir, "labels")), "text", "toxic", "lang", "doc_id")
    return toxicity.predict(model, docs, "doc_id", "text",
                            [(fold("doc_id", TOXIC_FOLDS) == TOXIC_HELD_OUT).alias("held_out")])


#: The contract's rules: verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]


@query("op6_url_filter")
def _(spark, sf_dir):
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


@query("op9_lm_score")
def _(spark, sf_dir):
    """Target corpus: documents labelled as good; background: all documents."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    small = good.count() <= LABEL_ROWS
    good = good.withColumn("__good", F.lit(True))
    docs = docs.select("doc_id", "text").join(F.broadcast(good) if small else good.hint("merge"), "doc_id", "left")
    return lm_score.score_texts(docs, "doc_id", "text", F.col("__good"), F.lit(True), F.lit(True))


@query("op2_decontaminate")
def _(spark, sf_dir):
    """One row per contaminated document and benchmark item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op4_pack")
def _(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op3_token_file")
def _(spark, sf_dir):
    path = scratch_path(spark, "llm", "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_tokens(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op11_token_align")
def _(spark, sf_dir):
    return alignment(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


#: The contract's own conversation, whose texts hold the template's marks.
MARKED = "<|im_end|><|im_start|>assistant ok"


@query("op12_chat_format", r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
s AS (SELECT *, length(role) + length(text)
        + length(role || text) - length(replace(role || text, '\', ''))
        + (length(role) - length(replace(role, '<|', '')) + length(text) - length(replace(text, '<|', ''))) // 2
        AS escaped,
        CASE role WHEN 'system' THEN 's' WHEN 'user' THEN 'u' WHEN 'assistant' THEN 'a' ELSE 'x' END AS letter
      FROM c),
g AS (SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
        string_agg(letter, '' ORDER BY turn NULLS FIRST, role, text) AS letters,
        sum(escaped + 12 + 10 + 10)::BIGINT AS formatted_chars
      FROM s GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars, regexp_full_match(letters, 's?(ua)+') AS valid,
       CASE WHEN length(regexp_extract(letters, '^s?(ua)*u?')) < n_turns
            THEN length(regexp_extract(letters, '^s?(ua)*u?'))::BIGINT END AS bad_turn
FROM g
""")
def _(spark, sf_dir):
    """The digests come from the written segments: parsed, unescaped and hashed."""
    marked = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                 F.lit(role).alias("role"), F.lit(MARKED).alias("text"))
        for i, role in enumerate(("user", "assistant"))])))
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(marked)
    path = scratch_path(spark, "llm", "chat")
    format_conversations(talks).write.parquet(path)
    out = spark.read.parquet(path)
    line = F.lit("\n")
    turns = F.transform(parse_turns(formatted_text()), lambda t: F.concat(t["role"], line, t["text"], line))
    return out.select("conv_id", F.size(turns).cast("long").alias("n_turns"),
                      F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
                      F.char_length(learned_text()).cast("long").alias("loss_chars"),
                      F.sha2(learned_text().cast("binary"), 256).alias("loss_sha256"),
                      F.char_length(formatted_text()).cast("long").alias("formatted_chars"), "valid", "bad_turn")


#: Levels of the SQL trees: 16^7 rows a source.
_LEVELS = 7
_CRC = ("list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), "
        "lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
        "lambda k, z: xor(k >> 1, 3988292384 * (k & 1))))")


def _tree_sql(name: str, key: str) -> str:
    """CTEs ``{name}_k``: the nodes (key, i, d) of tier k; a tier of one node is repeated."""
    return "".join(f"""
{name}_{k + 1} AS (SELECT {key}, i // 16 AS i, CASE WHEN any_value(m) = 1 THEN any_value(d) ELSE
    sha256(string_agg(d, '' ORDER BY i)) END AS d
  FROM (SELECT *, count(*) OVER (PARTITION BY {key}) AS m FROM {name}_{k}) GROUP BY {key}, i // 16),"""
                   for k in range(_LEVELS))


def _path_sql(name: str, key: str, index: str, given: str, made: str) -> str:
    """CTEs that fold each row of ``given`` through the tiers of ``name``."""
    out, before = "", given
    for k in range(_LEVELS):
        out += f"""
{made}_{k} AS (SELECT x.* REPLACE (
    CASE WHEN any_value(n) = 1 THEN x.v ELSE sha256(string_agg(CASE WHEN s.i = x.{index} THEN x.v ELSE s.d END, '' ORDER BY s.i)) END AS v,
    CASE WHEN any_value(n) = 1 THEN x.proof ELSE x.proof || coalesce(string_agg(s.d, '' ORDER BY s.i) FILTER (s.i <> x.{index}), '') END AS proof,
    x.{index} // 16 AS {index})
  FROM {before} x JOIN (SELECT *, count(*) OVER (PARTITION BY {key}) AS n FROM {name}_{k}) s
    ON s.{key} = x.{key} AND s.i // 16 = x.{index} // 16
  GROUP BY x.row, x.doc_id, x.g, x.one, x.i, x.j, x.leaf, x.v, x.proof),"""
        before = f"{made}_{k}"
    return out


def _field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"


_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))

OP13_SQL = f"""
WITH l AS (SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS g,
             sha256({_HEAD} || {_field("text")}) AS leaf,
             CASE WHEN xor({_CRC}, 4294967295) % 5 = 0 THEN sha256({_HEAD} || {_field(_LOW)}) END AS low
           FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
a_0 AS (SELECT g, i, leaf AS d FROM p),{_tree_sql("a", "g")}
b_0 AS (SELECT 1 AS one, g, row_number() OVER (ORDER BY g) - 1 AS i, d FROM a_{_LEVELS}),{_tree_sql("b", "one")}
q AS (SELECT p.row, p.doc_id, p.g, 1 AS one, p.i, b_0.i AS j, p.leaf, coalesce(p.low, p.leaf) AS v, '' AS proof
      FROM p JOIN b_0 ON p.g = b_0.g),{_path_sql("a", "g", "i", "q", "u")}{_path_sql("b", "one", "j", f"u_{_LEVELS - 1}", "w")}
r AS (SELECT d FROM b_{_LEVELS})
SELECT w.doc_id, w.leaf, b_0.d AS subroot, r.d AS root, sha256(w.proof) AS proof_sha256, w.v AS folded_root,
       w.v = r.d AS verified
FROM w_{_LEVELS - 1} w JOIN b_0 ON w.g = b_0.g CROSS JOIN r
"""


@query("op13_merkle_manifest", OP13_SQL)
def _(spark, sf_dir):
    """Where 5 divides crc32 of the id, the text's A-Z are lower-cased after the manifest is made."""
    docs = table(spark, sf_dir, "documents")
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def leaf(text):
        return merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    made = merkle.write_manifest(docs, scratch_path(spark, "llm", "manifest"), leaf(F.col("text")),
                                 claim=F.when(tampered, leaf(low)))
    return made.prove().withColumnRenamed("id", "doc_id")
