"""Documents to packed training sequences: five stages, each one operator.

Near duplicates are found by five-word shingles at a similarity of 0.8. Quality and
decontamination drop documents, the join keeps one of each group, substring dedup takes
repeated passages out of texts, and packing places what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fleetloom.llm import decontaminate, jaccard_join, packing, quality_votes, substrings
from fleetloom.llm.queries import table, tokenizer_file
from fleetloom.session import release, scratch_scope, scratch_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the votes reject."""
    return quality_votes.kept_documents(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest doc_id of every group of near duplicates."""
    return jaccard_join.one_of_each(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts; documents left without a word go."""
    return substrings.without_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a passage of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document: where it lies in which sequence."""
    return packing.packed_pieces(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# The rows depend on estimated accuracies and on byte-level tokens, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; then what it was made of is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = []
    for name, stage in STAGES:
        with scratch_scope(spark) as scope:
            docs = scope.keep(scratch_table(stage(spark, docs, sf_dir), name.replace(" ", "-")))
        release(*before)
        before = [docs]
    return docs
