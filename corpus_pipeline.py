"""The corpus pipeline: documents in, a deduplicated, filtered and weighted corpus out.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. Every stage works on
all rows its predecessor kept, is written as Parquet to the shared folder and read again. All but the last return the columns
of documents; the last adds each document's tokens, domain posteriors and rate.

Defined results, by stage. Quality: null and empty texts score as the classifier's calibration says; rows without an id are scored and
not learned from; without labels of both classes all score alike and stay. Language: null texts and texts without a letter go, and all go where nothing can
be learned. Near duplicates: rows without an id stay; of rows that repeat an id the one with the smallest text stays; empty and
null texts are copies of nothing. Decontamination: texts without words stay; without a benchmark all stay. Mixture: every row stays and has a rate,
also without an id or tokens. Columns beyond those of documents are not carried; an empty table stays empty; ties go to the smallest id.

No stage's result is expressible in SQL as a whole (the filters and the rates come from trained models), so ORACLE_SQL is None;
tests/llm compares each stage with a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import decontamination, language_id, mixing, ngram_jaccard, quality_classifier
from helixframe.llm.common import Scratch, crc_bucket, table
from helixframe.llm.queries import TARGET_SHARES, labelled_domains

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the compression classifier, fitted on the labels of its training fold, rejects."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"), crc_bucket(F.col("doc_id"), 5) != 0)
    return quality_classifier.score(docs, model, carry=True).where("predicted = 1").select(*COLUMNS)


#: A text stays if one language stands out, and if that language's automaton needs at most half as many phrases again as its
#: text usually does (and three standard deviations of a count of that size).
LEAST_LANGUAGE_SCORE, MOST_PHRASES, DEVIATIONS = 0.5, 1.5, 3.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which the cross-parse finds no language, none that stands out, or none that explains the text."""
    model = language_id.fit(docs, crc_bucket(F.col("doc_id"), 4) != 2)
    found = language_id.predict(docs, model, carry=True).where((F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return found.where(F.col("ratio") <= MOST_PHRASES + DEVIATIONS / F.sqrt("expected")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return ngram_jaccard.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark window."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"), mode="drop")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rates that mix the kept documents to the target shares of tokens."""
    return mixing.mix(docs, labelled_domains(spark, sf_dir), TARGET_SHARES)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mixture),
]

ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; every stage's result is written to the shared folder and reread."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir))
    return docs
