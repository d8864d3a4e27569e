"""Pipeline stages: each takes ``(spark, docs, sf_dir)`` and calls one operator on all of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelayers.llm import decontamination as phrases
from lakelayers.llm import language_id as languages
from lakelayers.llm import line_dedup as lines
from lakelayers.llm import mixing as mixture
from lakelayers.llm import simhash
from lakelayers.llm.common import held_out, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the models know go, and so do null texts and texts without a letter.

    The models learn from rows with a language whose id is not held out; a null id counts as empty text there. Repeated rows share
    their verdict. Without such rows no language is known and all documents go; an empty table gives an empty table.
    """
    labelled = docs.filter(~held_out(F.col("doc_id"), 5, 0))
    return languages.known_language(docs, languages.train(labelled))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shared lines stay in one document; no document goes, a text whose lines all go is empty.

    A null text stays null, a null id is the smallest. Repeated rows count as one document and lose the same lines. An empty
    table gives an empty table.
    """
    return lines.dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Null, empty and wordless texts have one fingerprint and are one group, of which one stays. A null id is the largest. Of
    repeated rows one stays. An empty table gives an empty table.
    """
    return simhash.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null and wordless texts hold none and stay, as do all documents if the benchmark is empty; null and wordless items have no
    window. Repeated rows share their verdict. An empty table gives an empty table.
    """
    return phrases.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, in its order; one that is taken twice is there twice.

    A null source is a source, the last. Null and wordless texts have no words and are not taken. Repeated rows are copies
    that are taken one by one. An empty table gives an empty table.
    """
    return mixture.mixed_documents(docs)
