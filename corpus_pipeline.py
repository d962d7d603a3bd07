"""A corpus pipeline of five operators: quality, near copies, leaks, mixing, token ids.

Every stage takes what its predecessor kept, written to Parquet and read again. All but the last
return the columns of ``documents``. Tables other than the documents come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidecube.llm.decontamination import decontaminated
from tidecube.llm.jaccard import deduplicated
from tidecube.llm.mixing import mixed_documents
from tidecube.llm.packing import packed
from tidecube.llm.quality import accepted
from tidecube.llm.tables import table, written

#: Fewer than ``op7_packed_ids`` keeps, as workers hold what earlier stages took as well.
CACHED_CHUNKS = 200_000


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier rejects go."""
    return accepted(docs, table(spark, sf_dir, "labels"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents, the one with the smallest doc_id stays."""
    return deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def at_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in its order: a row for each time a document is taken, with the words taken."""
    return mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids are written as packed bits and read back: doc_id, start, n_tokens, ids_crc32.

    They lie in the order of the mix, which is that of the rows in the stage's files; documents that
    do not come from files are packed by doc_id.
    """
    try:
        placed = docs.select(
            "*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
        )
    except AnalysisException as error:
        if error.getCondition() != "UNRESOLVED_COLUMN.WITH_SUGGESTION":
            raise
        return packed(docs, cached_chunks=CACHED_CHUNKS)
    return packed(placed, order=["_file", "_row"], cached_chunks=CACHED_CHUNKS)


STAGES = [
    ("quality_classifier", good_quality),
    ("jaccard_join", one_of_each_group),
    ("decontamination", without_benchmark),
    ("fair_mix", at_target_weights),
    ("token_ids", token_ids),
]

#: The first stage is a learned model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
