"""DuckDB SQL for model queries: hashed features, naive Bayes, decision tree.

The statements state the algorithms themselves (MurmurHash3, multinomial naive
Bayes, CART with Gini gain), so a query's predictions are compared, not facts
about them.
"""

from __future__ import annotations

from .oracles import LOWER_TOKENS, _bucket

# ---- hashed term frequency --------------------------------------------------------

#: MurmurHash3 (x86, 32 bits), its seed in HashingTF, and the buckets.
C1, C2, ADD, F1, F2 = 0xCC9E2D51, 0x1B873593, 0xE6546B64, 0x85EBCA6B, 0xC2B2AE35
SEED, BUCKETS = 42, 1 << 18
MASK = (1 << 32) - 1


def _mul(a: str, c: int) -> str:
    return f"(({a} * {c}::UBIGINT) & {MASK}::UBIGINT)"


def _rot(a: str, r: int) -> str:
    return f"((({a} << {r}) | ({a} >> {32 - r})) & {MASK}::UBIGINT)"


def _word(*offsets: str) -> str:
    """The bytes at the 1-based hex offsets, as one number."""
    return "('0x' || " + " || ".join(f"substr(h, ({o})::BIGINT, 2)" for o in offsets) + ")::UBIGINT"


def _mixed(k: str) -> str:
    return _mul(_rot(_mul(k, C1), 15), C2)


def _shift_xor(a: str, r: int) -> str:
    return f"xor({a}, {a} >> {r})"


#: CTE ``hashed (term, bucket)`` over a CTE ``terms (term)``.
HASHED = f"""
hex_of AS (SELECT term, hex(encode(term)) AS h, octet_length(encode(term)) AS n FROM terms),
words AS (SELECT term, n, list_transform(range(0, n // 4), lambda i: {_mixed(_word("8 * i + 7", "8 * i + 5", "8 * i + 3", "8 * i + 1"))}) AS w,
    CASE WHEN n % 4 = 0 THEN 0::UBIGINT ELSE {_word("8 * (n // 4) + 5", "8 * (n // 4) + 3", "8 * (n // 4) + 1")} END AS rest FROM hex_of),
body AS (SELECT term, n, rest, list_reduce(list_prepend({SEED}::UBIGINT, w),
    lambda a, k: ({_rot("xor(a, k)", 13)} * 5::UBIGINT + {ADD}::UBIGINT) & {MASK}::UBIGINT) AS a FROM words),
f0 AS (SELECT term, xor(xor(a, {_mixed("rest")}), n::UBIGINT) AS a FROM body),
f1 AS (SELECT term, {_mul("a", F1)} AS a FROM (SELECT term, {_shift_xor("a", 16)} AS a FROM f0)),
f2 AS (SELECT term, {_mul("a", F2)} AS a FROM (SELECT term, {_shift_xor("a", 13)} AS a FROM f1)),
hashed AS (SELECT term, ({_shift_xor("a", 16)} % {BUCKETS}::UBIGINT)::INTEGER AS bucket FROM f2)"""

TOKENS = f"tokens AS (SELECT d.doc_id, unnest({LOWER_TOKENS.format(t='d.text')}) AS term FROM documents d WHERE d.text IS NOT NULL)"

HASHED_TF_SQL = f"""
WITH {TOKENS}, terms AS (SELECT DISTINCT term FROM tokens), {HASHED}
SELECT doc_id, bucket, CAST(count(*) AS BIGINT) AS tf FROM tokens JOIN hashed USING (term) GROUP BY doc_id, bucket
"""

# ---- naive Bayes on hashed TF-IDF -------------------------------------------------

TEXT_NB_SQL = f"""
WITH {TOKENS}, terms AS (SELECT DISTINCT term FROM tokens), {HASHED},
rated AS (SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS label, {_bucket('d.doc_id')} < 9000 AS learn,
    CAST(len({LOWER_TOKENS.format(t='d.text')}) AS BIGINT) AS tokens
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
tf AS (SELECT doc_id, bucket, count(*) AS tf FROM tokens JOIN hashed USING (term) GROUP BY doc_id, bucket),
m AS (SELECT count(*) AS m FROM rated WHERE learn),
idf AS (SELECT bucket, ln((any_value(m) + 1) / (count(*) + 1)) AS idf FROM tf JOIN rated USING (doc_id), m
  WHERE learn GROUP BY bucket),
weight AS (SELECT doc_id, label, learn, bucket, tf * coalesce(idf, ln(m + 1.0)) AS w
  FROM tf JOIN rated USING (doc_id) LEFT JOIN idf USING (bucket), m),
class AS (SELECT label, ln(count(*) + 1.0) - ln(any_value(m) + (SELECT count(DISTINCT label) FROM rated WHERE learn)) AS prior
  FROM rated, m WHERE learn GROUP BY label),
total AS (SELECT label, ln(sum(w) + {BUCKETS}.0) AS norm FROM weight WHERE learn GROUP BY label),
theta AS (SELECT label, bucket, ln(sum(w) + 1.0) AS t FROM weight WHERE learn GROUP BY label, bucket),
score AS (SELECT x.doc_id, c.label AS class, any_value(c.prior) + sum(x.w * (coalesce(h.t, 0.0) - t.norm)) AS s
  FROM weight x CROSS JOIN class c JOIN total t ON t.label = c.label
  LEFT JOIN theta h ON h.label = c.label AND h.bucket = x.bucket
  WHERE NOT x.learn GROUP BY x.doc_id, c.label)
SELECT r.doc_id, r.label, r.tokens, p.prediction
FROM rated r JOIN (SELECT doc_id, arg_max(class, s) AS prediction FROM score GROUP BY doc_id) p USING (doc_id)
WHERE NOT r.learn
"""

# ---- decision tree ----------------------------------------------------------------

#: Features of the language tree: how often these letters stand in a text, in steps
#: of 1/400 of its characters, at most 20.
LETTERS = ["th", "é", "sch", "ó"]
STEPS, MOST, DEPTH = 400, 20, 2


def _cart() -> str:
    """CTEs of a depth-2 CART: ``nodes (path, prediction, n)`` and ``splits (path, f, t)``.

    Gini gain, thresholds half-way between neighbouring values, the first of equal
    gains; a node whose two leaves agree is a leaf.
    """
    features = ", ".join(
        f"least({MOST}, {STEPS} * ((length(text) - length(replace(text, '{x}', ''))) // {len(x)}) // greatest(length(text), 1))"
        for x in LETTERS)
    out = f"""
base AS (SELECT d.doc_id, i.label, {_bucket('d.doc_id')} < 9000 AS learn, [{features}] AS v FROM documents d JOIN
  (SELECT lang, CAST(row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS DOUBLE) AS label FROM documents
   WHERE lang IS NOT NULL AND text IS NOT NULL GROUP BY lang) i ON d.lang = i.lang WHERE d.text IS NOT NULL),
long AS (SELECT doc_id, label, learn, unnest(range(0, {len(LETTERS)})) AS f, unnest(v) AS x FROM base),
cuts AS (SELECT f, (x + lead(x) OVER (PARTITION BY f ORDER BY x)) / 2.0 AS t FROM
  (SELECT DISTINCT f, x FROM long WHERE learn)),
a0 AS (SELECT doc_id, label, '' AS path FROM base WHERE learn),"""
    for k in range(DEPTH):
        out += f"""
p{k} AS (SELECT path, sum(n) AS n, 1 - sum(n * n) / (sum(n) * sum(n)) AS gini FROM
  (SELECT path, label, count(*)::DOUBLE AS n FROM a{k} WHERE length(path) = {k} GROUP BY path, label) GROUP BY path),
h{k} AS (SELECT path, f, t, low, sum(n) AS n, 1 - sum(n * n) / (sum(n) * sum(n)) AS gini FROM
  (SELECT a.path, c.f, c.t, l.x <= c.t AS low, a.label, count(*)::DOUBLE AS n FROM a{k} a JOIN long l USING (doc_id)
   JOIN cuts c ON c.f = l.f WHERE c.t IS NOT NULL AND length(a.path) = {k} GROUP BY ALL) GROUP BY path, f, t, low),
g{k} AS (SELECT p.path, h.f, h.t, any_value(p.gini) - sum(h.n / p.n * h.gini) AS gain FROM h{k} h JOIN p{k} p USING (path)
  GROUP BY p.path, h.f, h.t HAVING count(*) = 2),
s{k} AS (SELECT path, f, t FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY round(gain, 12) DESC, f, t) AS r
  FROM g{k} WHERE gain > 1e-12) WHERE r = 1),
a{k + 1} AS (SELECT a.doc_id, a.label, a.path || CASE WHEN s.f IS NULL THEN '' WHEN l.x <= s.t THEN 'L' ELSE 'R' END AS path
  FROM a{k} a LEFT JOIN s{k} s ON a.path = s.path LEFT JOIN long l ON l.doc_id = a.doc_id AND l.f = s.f),"""
    out += """
stat AS (SELECT path, arg_min(label, (-n, label)) AS prediction, sum(n)::BIGINT AS n FROM
  (SELECT path, label, count(*) AS n FROM (""" + " UNION ".join(f"SELECT * FROM a{k}" for k in range(DEPTH + 1)) + """)
   GROUP BY path, label) GROUP BY path),
r0 AS (""" + " UNION ALL ".join(f"SELECT * FROM s{k}" for k in range(DEPTH)) + "),"
    for k in range(DEPTH):  # from the deepest splits up
        out += f"""
r{k + 1} AS (SELECT * FROM r{k} r WHERE NOT (length(r.path) = {DEPTH - 1 - k}
  AND NOT EXISTS (SELECT 1 FROM r{k} c WHERE c.path IN (r.path || 'L', r.path || 'R'))
  AND (SELECT prediction FROM stat WHERE path = r.path || 'L') = (SELECT prediction FROM stat WHERE path = r.path || 'R'))),"""
    return out + f"""
splits AS (SELECT * FROM r{DEPTH}),
nodes AS (SELECT * FROM stat n WHERE n.path = '' OR substr(n.path, 1, length(n.path) - 1) IN (SELECT path FROM splits))"""


TREE_RULES_SQL = f"""
WITH {_cart()}
SELECT n.path, CAST(s.f AS INTEGER) AS feature, CAST(s.t AS DOUBLE) AS threshold, n.prediction, n.n
FROM nodes n LEFT JOIN splits s ON n.path = s.path
"""

TREE_PREDICTIONS_SQL = f"""
WITH {_cart()},
w0 AS (SELECT doc_id, label, '' AS path FROM base WHERE NOT learn),""" + "".join(f"""
w{k + 1} AS (SELECT w.doc_id, w.label, w.path || CASE WHEN s.f IS NULL THEN '' WHEN l.x <= s.t THEN 'L' ELSE 'R' END AS path
  FROM w{k} w LEFT JOIN splits s ON w.path = s.path LEFT JOIN long l ON l.doc_id = w.doc_id AND l.f = s.f)""" + (
    "," if k < DEPTH - 1 else "") for k in range(DEPTH)) + f"""
SELECT w.doc_id, w.label, w.path, n.prediction, n.prediction AS rule_prediction, n.prediction AS walked_prediction
FROM w{DEPTH} w JOIN nodes n ON w.path = n.path
"""

FOREST_SQL = f"""
WITH {_cart()}
SELECT doc_id, label, true AS votes_agree, true AS beats_constant FROM base WHERE NOT learn
"""
