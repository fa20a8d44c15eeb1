"""Corpus pipeline: documents through the training-data operators, stage by stage."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentlens.llm.common import column, free_name, table
from rentlens.llm.decontaminate import decontaminate, is_contaminated, result_names, span_words
from rentlens.llm.packing import pack_documents
from rentlens.llm.simhash_dedup import keep_one_per_component
from rentlens.llm.suffix_dedup import remove_duplicates
from rentlens.llm.toxicity import score_documents, train, training_rows
from rentlens.session import scratch_path

TOXIC_FROM = 0.3
# Bytes of documents a Python task takes in at once. Executors serve all stages,
# and neither their JVM nor their workers give back what one stage has taken.
BATCH = "4m"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the limit. Trained on the labelled rows of the stage's input."""
    model = train(**training_rows(docs, table(spark, sf_dir, "labels")))
    names = docs.columns
    score = free_name(names, "_score")
    scored = score_documents(docs, model, names, score)
    return scored.filter(F.col(score) < TOXIC_FROM).select(*map(column, names))


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest doc_id."""
    return keep_one_per_component(docs, shingle=3, radius=2)


def suffix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that a document with a smaller id holds."""
    return remove_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a telling share of benchmark words."""
    names = docs.columns
    out = decontaminate(docs, table(spark, sf_dir, "benchmark"), names)
    n_words, spans, _ = result_names(names)
    return out.filter(~is_contaminated(F.col(n_words), span_words(spans))).select(*map(column, names))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2048 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def _in_batches(stage):
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)
        return stage(spark, docs, sf_dir)
    return run


STAGES = [(stage.__name__, _in_batches(stage)) for stage in (toxicity, simhash, suffix, decontamination, packing)]

# Training, tokenising and suffix matching have no SQL form; tests hold each
# stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
