"""Five stages from raw documents to packed training sequences.

Each stage reads what its predecessor wrote and works on all of it:

1. quality    documents whose compression score is under the threshold go;
2. language   documents without a letter, or like no language learnt, go;
3. near_dedup one document of each group of near copies stays;
4. decontaminate  documents that hold a window of a benchmark item go;
5. pack       the rest is dealt into sequences of fixed size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmark.llm import decontam, langid, packing, quality, simhash
from trailmark.llm.common import table
from trailmark.plans.shared import forget, stored

#: A language score under this is like no language learnt.
LEAST_LANGUAGE = 0.2
#: Words of a shingle of the near-duplicate stage, and how alike the sets of shingles of copies are at least.
SHINGLE, ALIKE = 5, 0.8
#: Differing bits at which the SimHash operator links two fingerprints.
RADIUS = 4


def _aside(docs: DataFrame, *needed: str) -> tuple[DataFrame, list[str]]:
    """``docs`` under names that no operator makes, beside the columns an operator reads; and those names."""
    names = [f"_kept{i}_" for i in range(len(docs.columns))]
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)], *needed), names


def _back(found: DataFrame, docs: DataFrame, names: list[str]) -> DataFrame:
    return found.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the compression classifier does not reject.

    A null text is scored as empty, long texts whole; repeated rows share their
    fate.  Without labels every score is 0.5 and all stay.  All columns are handed
    on as they are, whatever they are called; an empty table stays empty.
    """
    rows, names = _aside(docs, "doc_id", "text")
    return _back(quality.classify(rows, quality.train(docs, table(spark, sf_dir, "labels")), names).where("predicted = 1"), docs, names)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that have a letter and are like a language learnt.

    Null and empty texts have no letter and go; long texts are read whole; repeated
    rows share their fate.  Where no row names a language, nothing is learnt and
    all go.  Columns are handed on as they are; an empty table stays empty.
    """
    rows, names = _aside(docs, "doc_id", "text")
    found = langid.identify(rows, langid.train(docs), names)
    return _back(found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)), docs, names)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: what the SimHash operator links, sets of five-word shingles that are 0.8 alike, and chains of such.

    Equal, empty and null texts are copies; long texts are read whole.  Columns
    are handed on as they are; an empty table stays empty.
    """
    return simhash.one_of_each(docs, SHINGLE, ALIKE, radius=RADIUS)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a window of a benchmark item.

    Null and empty texts have none and stay; long texts are read whole; repeated
    rows share their fate; an empty benchmark rejects nothing.  Columns are
    handed on as they are; an empty table stays empty.
    """
    rows, names = _aside(docs, "text")
    return _back(decontam.decontaminate(spark, rows, table(spark, sf_dir, "benchmark"), keep=tuple(names)).where("NOT contaminated"), docs, names)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of fixed size: one row per piece of a document, as of ``packing.pack``.

    Null and empty texts take no room and get no bin, long texts are cut into
    pieces, repeated rows are packed each, ties go by row.  Columns of the
    documents other than doc_id, text and source are not read; an empty table
    gives an empty result.
    """
    return packing.pack(packing.measured(docs.select("doc_id", "text", "source")))


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontamination_stage),
    ("pack", packing_stage),
]

#: Compression and fitted models are beyond SQL; tests/llm/test_pipeline.py holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage wrote goes once the next one has written its own."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
        forget(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
