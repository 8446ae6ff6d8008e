"""The corpus pipeline: documents in, packed training sequences out, in five stages.

Every stage reads all that the one before it kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbwatch.llm.common import read_table
from ebbwatch.llm.decontamination import contamination
from ebbwatch.llm.language_id import UNKNOWN, language_id
from ebbwatch.llm.packing import pack_documents
from ebbwatch.llm.pseudonyms import pseudonymised
from ebbwatch.llm.similarity_join import similarity_components, text_classes
from ebbwatch.session import scratch_path, write_table

SENT_IDS = 1_000_000  # ids of documents to leave out that are sent to every task; more of them are joined
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"  # of rows that a Python worker gets at once
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """Rows are whole texts, of which Spark's 10,000 would take a worker and its executor any memory. Stays set in the
    session, which may bring a size of its own."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return bounded


@in_small_batches
def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is null or has no letter go. Without labels to learn from, no language is known, and the others stay."""
    found = language_id(docs, docs, keep=COLUMNS)
    return found.where((F.col("lang_pred") != UNKNOWN) | F.col("text").rlike(r"\p{L}")).select(*COLUMNS)


@in_small_batches
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays, once. Documents without words
    or without an id are in no group and stay. Different texts under one id are different documents."""
    found = write_table(similarity_components(docs, with_classes=True), "components")
    docs = docs.select(*COLUMNS)
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = write_table(repeated, "repeated")
    gone = found.where("component_id != doc_id").select("doc_id").union(repeated).distinct()
    rest = docs.join(_sent(gone), "doc_id", "left_anti").select(*COLUMNS)
    if repeated.isEmpty():
        return rest
    # Rows that repeat an id are told apart by their texts.
    stay = found.where("component_id = doc_id").join(repeated, "doc_id").groupBy("doc_id", "root").agg(F.min("class").alias("kept"))
    stay = stay.select(F.col("doc_id").alias("kept_id"), "kept")
    rows = text_classes(docs.join(_sent(repeated), "doc_id").select(*COLUMNS))
    rows = rows.join(stay, (F.col("doc_id") == F.col("kept_id")) & F.col("class").eqNullSafe(F.col("kept")))
    rows = rows.withColumn("wordless", F.when(F.col("class").isNull(), F.col("text")))
    return rest.union(rows.dropDuplicates(["doc_id", "class", "wordless"]).select(*COLUMNS))


def _sent(ids: DataFrame) -> DataFrame:
    """Sent to every task if they are few, which spares the texts a shuffle."""
    return F.broadcast(ids) if ids.count() <= SENT_IDS else ids


@in_small_batches
def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    found = contamination(docs, read_table(spark, sf_dir, "benchmark"), keep=COLUMNS)
    return found.where("n_items = 0").select(*COLUMNS)


@in_small_batches
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by pseudonyms in the text."""
    found = pseudonymised(docs, keep=COLUMNS).withColumn("n_chars", F.char_length("text").cast("long"))
    return found.select(*COLUMNS)


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in the training sequences."""
    return pack_documents(docs)


STAGES = [
    ("language", languages),
    ("near_duplicates", near_duplicates),
    ("benchmarks", clean_of_benchmarks),
    ("personal_data", without_personal_data),
    ("packing", packed),
]

# Neither the shingle components of a corpus of any size nor the tokenizer can be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
