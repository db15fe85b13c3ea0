"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before it wrote and decides about all of it;
every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.llm import mixing, neartexts, packing, pii, quality
from tablegate.llm.queries import TOKENIZER
from tablegate.llm.storage import stored
from tablegate.plans.registry import given


def _free_name(docs: DataFrame, name: str) -> str:
    """A working name like ``name`` that no column of ``docs`` has, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def _columns(docs: DataFrame) -> list[str]:
    return ["`" + c.replace("`", "``") + "`" for c in docs.columns]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labels of those given."""
    model = quality.fit(docs, given(spark, sf_dir, "labels", "doc_id", "quality"))
    name = _free_name(docs, "__quality")
    scored = quality.with_score(docs, model, name=name)
    return scored.where(F.col(name) >= quality.THRESHOLD).drop(name)


def simhash_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more.

    Fingerprints are searched by the Gray-order index in groups that min-hashes
    choose; every link is then compared by its whole shingle sets. A chain of
    links counts as one group.
    """
    return neartexts.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; ``n_chars`` counts the new text."""
    name = _free_name(docs, "__pii")
    redacted = pii.redact(pii.find_personal(docs, name=name), name=name)
    chars = F.coalesce(F.char_length("text").cast("long"), F.col("n_chars"))
    return redacted.withColumn("n_chars", chars).select(*_columns(docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its source's target weight takes it."""
    name = _free_name(docs, "__mix")
    return mixing.emit_copies(mixing.mix_sources(docs, name=name), name).select(*_columns(docs))


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, copies included, in training sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_duplicates),
    ("personal data", personal_data),
    ("source mixing", source_mixing),
    ("packing", sequence_packing),
]

# learned scores, Hamming components and packing are beyond SQL; tests/llm holds the operators against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole of ``documents``, each stage's result written and read again."""
    docs = given(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
