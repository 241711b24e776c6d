"""From raw documents to packed training sequences, stage by stage.

Every stage reads what its predecessor has written and returns the columns of ``documents``; the last returns a row
per piece of a sequence.  ``run`` writes each stage's result to the folder all executors share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelcast.llm import exact_dedup, packing, quality, secrets, simhash
from panelcast.llm.common import stored, table, text_session
from panelcast.llm.queries import WORD_BPE, vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; NULL text is judged as empty text is, repeated rows alike."""
    model = quality.train(docs, table(text_session(spark), sf_dir, "labels"))
    return quality.keep_good(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for the case of A-Z (NULL: empty), the one with the largest id stays; NULL is the least id."""
    text_session(spark)
    return exact_dedup.keep_last_of_each(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by SimHash (three words, at most 3 differing bits), the one with the smallest id stays.

    Texts without words, NULL among them, have the same fingerprint and are linked; NULL is the largest id.
    """
    text_session(spark)
    return simhash.keep_one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, repeated rows and NULL texts too; secrets in their text are replaced."""
    text_session(spark)
    return secrets.redact(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as token sequences: a row per piece; NULL text is one piece of one token."""
    text_session(spark)
    return packing.pack_documents(docs, vocabulary(WORD_BPE))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_copies),
    ("simhash_near_dedup", near_copies),
    ("secret_scans", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Training and tokenising have no form in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(text_session(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
