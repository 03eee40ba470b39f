"""URL filter: rules first, else a character language-model ratio.

URLs that a rule accepts or rejects train one character model per class. Each
is a variable-order Markov model with Witten-Bell smoothing: the estimate of a
character after three characters falls back to two, one and none in proportion
to how many different characters followed the context. Of other URLs the
log-likelihood difference per character decides, against a threshold that
balances both error rates on rule-decided URLs kept out of training.

Characters are mapped to ``SYMBOLS`` classes, so a model has at most
``SYMBOLS ** 4`` entries whatever the number of URLs; counts cover all URLs.

Defined results: a URL that is null or has no ``://`` has empty host and path;
a null URL is scored as an empty one. Without rule-decided URLs of both classes
the method allows. Every input row gives one row; repeated rows are judged
alike. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import arrow_map, slices

ALLOW, BLOCK = "allow", "block"
ORDER = 3
#: Character classes: 0 marks both ends, letters, one class for digits, signs, 39 anything else.
SIGNS = "./-_?=&%#:~"
SYMBOLS = 40
#: One in this many rule-decided URLs sets the threshold instead of the counts.
CALIBRATION = 5
#: Resolution of the threshold, in log-likelihood per character.
STEP = 0.01

_CLASS = np.full(256, SYMBOLS - 1, np.int32)
for _c in range(26):
    _CLASS[97 + _c] = _CLASS[65 + _c] = 1 + _c
_CLASS[48:58] = 27
for _k, _s in enumerate(SIGNS):
    _CLASS[ord(_s)] = 28 + _k

Rule = tuple[str, str, str]  # verdict, host, path


def split_url(url: Column) -> tuple[Column, Column]:
    """``(host, path)``: host up to ``/ ? #``, A-Z lower-cased; path up to ``? #``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def match_rules(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is tested first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def grams(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all ``ORDER + 1``-grams, an end mark included, and where each URL's begin."""
    n, size = len(offs) - 1, np.diff(offs)
    sym = np.zeros(len(data) + n * (ORDER + 1), np.int32)
    at = np.arange(len(data)) + ORDER + (ORDER + 1) * np.repeat(np.arange(n), size)
    sym[at] = _CLASS[data]
    code = np.zeros(len(sym) - ORDER, np.int32)
    for k in range(ORDER + 1):
        code = code * SYMBOLS + sym[k:len(sym) - ORDER + k]
    begin = offs[:-1] + (ORDER + 1) * np.arange(n)
    keep = np.ones(len(code), bool)  # windows that end in the marks before a URL
    for k in range(ORDER):
        keep[begin[1:] - ORDER + k] = False
    return code[keep], offs[:-1] + np.arange(n)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """Witten-Bell log-probabilities of all grams from the counts of the longest."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for k in range(ORDER + 1):
        n = counts.reshape(-1, SYMBOLS ** k, SYMBOLS).sum(0)
        total, kinds = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
        lower = p if k == 0 else np.tile(p.reshape(-1, SYMBOLS), (SYMBOLS, 1)).reshape(n.shape)
        p = np.where(total > 0, (n + kinds * lower) / np.maximum(total + kinds, 1), lower)
    return np.log(p).ravel()


def _score(urls: DataFrame, ratio: np.ndarray, names: list[str]) -> DataFrame:
    """Adds ``score``: the mean log-likelihood difference; first column is the URL."""
    fields = urls.schema.fields
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)

    def make():
        def batch(rows: pa.RecordBatch):
            for part in slices(rows.column(0)):
                code, begin = grams(part.data, part.offs)
                s = np.add.reduceat(ratio[code].astype(np.float64), begin) / (np.diff(part.offs) + 1)
                yield pa.RecordBatch.from_arrays([*(c[part.rows] for c in rows.columns), pa.array(s)],
                                                 [*names, "score"])
        return batch
    return arrow_map(urls, make, f"{schema}, score double")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``(id_col, host, path, rule, verdict, score)`` per row."""
    host, path = split_url(F.col("url"))
    rows = (pages.select(F.col(url_col).cast("string").alias("url"), F.col(id_col).alias("id"))
            .withColumns({"host": host, "path": path}))
    rule, decided = match_rules(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "decided": decided})
    known = rows.where("decided is not null").select("url", "id", "decided").withColumn(
        "calibrates", F.pmod(F.xxhash64("id", F.lit("url")), F.lit(CALIBRATION)) == 0)

    def make():
        def batch(part: pa.RecordBatch):
            verdict = np.array(part.column(1).to_pylist(), object)
            for v in (ALLOW, BLOCK):
                for run in slices(part.column(0).filter(pa.array(verdict == v))):
                    code, n = np.unique(grams(run.data, run.offs)[0], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v] * len(code), pa.string()), pa.array(code), pa.array(n.astype(np.int64))],
                        ["verdict", "code", "n"])
        return batch
    counted = (arrow_map(known.where("not calibrates").select("url", "decided"), make,
                         "verdict string, code int, n long")
               .groupBy("verdict", "code").agg(F.sum("n").alias("n")).toPandas())
    logp, seen = {}, {}
    for v in (ALLOW, BLOCK):
        own = counted[counted["verdict"] == v]
        counts = np.zeros(SYMBOLS ** (ORDER + 1))
        counts[own["code"].to_numpy(np.int64)] = own["n"].to_numpy(np.float64)
        seen[v], logp[v] = len(own), log_probabilities(counts)
    both = bool(seen[ALLOW] and seen[BLOCK])
    ratio = (logp[ALLOW] - logp[BLOCK] if both else np.zeros(SYMBOLS ** (ORDER + 1))).astype(np.float32)

    test = _score(known.where("calibrates").select("url", "decided"), ratio, ["url", "decided"])
    bins = (test.groupBy("decided", F.floor(F.col("score") / STEP).alias("bin")).count().toPandas()
            if both else None)
    cut = 0.0
    if both and len(bins) and bins["decided"].nunique() == 2:
        table = bins.pivot_table(index="bin", columns="decided", values="count", fill_value=0).sort_index()
        lost = (table[ALLOW].cumsum() / table[ALLOW].sum()).to_numpy()          # allowed at or below the bin
        passed = 1 - (table[BLOCK].cumsum() / table[BLOCK].sum()).to_numpy()    # blocked above it
        edges, error = table.index.to_numpy(), lost + passed
        best = np.flatnonzero(error == error.min())
        k = best[len(best) // 2]
        upper = edges[k + 1] if k + 1 < len(edges) else edges[k] + 1
        cut = float((edges[k] + 1 + upper) / 2 * STEP)
    names = ["url", "id", "host", "path", "rule", "decided"]
    scored = _score(rows.select(*names), ratio, names)
    return scored.select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("decided", F.when(F.lit(both) & (F.col("score") < cut), BLOCK).otherwise(ALLOW)).alias("verdict"),
        "score")
