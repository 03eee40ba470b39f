"""Corpus pipeline: five stages over ``documents``, each one of the llm operators.

1. language ID: documents without a dominant language, or without a letter, go;
2. toxicity: documents predicted toxic go;
3. n-gram Jaccard join (five words, 0.8): of each group of near copies the
   smallest id stays;
4. benchmark decontamination: documents that hold a benchmark item go;
5. packing: what is left becomes sequences of at most 2048 token ids.

Every stage works on all that the stage before kept and, but for the last,
returns the columns of ``documents``. Null and empty texts have no letter and
go in stage 1 (if stages are called alone: they are no duplicates and hold no
item). Rows with a null id can't be told apart and go in stage 1. Repeated rows
of an id are one document and go or stay together. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import langid, toxicity
from tablekit.llm.base import fold, materialize
from tablekit.llm.decontaminate import contaminated
from tablekit.llm.ngram_jaccard import jaccard_components
from tablekit.llm.pack import pack
from tablekit.llm.queries import LANG_FOLDS, LANG_HELD_OUT, labelled, table, tokenizer_path

#: Words of a shingle and threshold of near copies (the op7 query has its own).
DEDUP_WORDS, DEDUP_NUM, DEDUP_DEN = 5, 80, 100

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = docs.where("doc_id is not null")
    model = langid.fit(docs.where(fold("doc_id", LANG_FOLDS) != LANG_HELD_OUT), "text", "lang", "doc_id")
    kept = langid.predict(model, docs, "doc_id", "text", _carried(docs), with_text=True).where("not rejected")
    return _columns(kept, docs)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(labelled(docs, table(spark, sf_dir, "labels")), "text", "toxic", "lang", "doc_id")
    kept = toxicity.predict(model, docs, "doc_id", "text", _carried(docs), with_text=True).where("predicted = 0")
    return _columns(kept, docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    comps = jaccard_components(docs, width=DEDUP_WORDS, num=DEDUP_NUM, den=DEDUP_DEN)
    gone = comps.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*_named(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*_named(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, tokenizer_path()).withColumn("ids_crc32", F.crc32("ids"))


def _named(docs: DataFrame) -> list:
    """All columns by their names as they are, dots and backticks included."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _carried(docs: DataFrame) -> list:
    """All columns but id and text under names that no operator's output has."""
    return [c.alias(f"__in_{i}") for i, (name, c) in enumerate(zip(docs.columns, _named(docs)))
            if name not in ("doc_id", "text")]


def _columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    own = {"doc_id": "doc_id", "text": "__text"}
    return out.select(*(F.col(own.get(c, f"__in_{i}")).alias(c) for i, c in enumerate(docs.columns)))


STAGES: list[tuple[str, Stage]] = [("language_id", language), ("toxicity", toxic), ("ngram_jaccard", dedup),
                                   ("decontamination", decontaminate), ("packing", packed)]

#: Trained models and packing have no SQL form; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written as Parquet and read as the next input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
