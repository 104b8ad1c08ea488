"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next.

Quality rules and benchmark decontamination leave out rows, near-deduplication keeps one of each group,
the mix puts all that is kept into the order of the target weights, and the token files hold them in
that order. Every stage but the last returns the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from logquarry.llm.common import stored, table, unused
from logquarry.llm.decontaminate import decontaminate
from logquarry.llm.mixing import mixed_rows
from logquarry.llm.near_dedup import near_duplicates
from logquarry.llm.quality_rules import quality
from logquarry.llm.queries import WEIGHTS
from logquarry.llm.token_files import token_digests, write_token_files


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base nor the learned list rejects. Null texts fail the base; repeated rows stay or
    go together, since all that counts is the text. Columns of any name stay as they are."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return quality(docs.select(row, "doc_id", "text"), table(spark, sf_dir, "labels")).where("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of least ``doc_id`` (with all rows that share it). Null
    and empty texts are in no group and stay."""
    kept = near_duplicates(docs).where("kept").select("doc_id").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark. Null texts have none and stay, each row is judged by itself."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix. A null source counts as an empty one; repeated rows stay."""
    return mixed_rows(docs, WEIGHTS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all rows, in the order in which ``docs`` is stored; returns what was read back of
    each: ``doc_id, start, n_tokens, ids_crc32``. A null or empty text is its end id alone; each repeated row
    is encoded."""
    order = None
    if docs.inputFiles():
        # Part files are numbered in the order of the mix, rows follow each other inside.
        number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1)
        number = F.when(number == "", 0).otherwise(number.cast("long"))
        file, row = unused("file", docs.columns), unused("row", docs.columns)
        docs = docs.select("*", number.alias(file), F.col("_metadata.row_index").alias(row))
        order = [F.col(file), F.col(row)]
    return token_digests(spark, write_token_files(docs, order=order))


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mix", source_mix),
    ("token output", token_output),
]

#: Learned rules, MinHash, LSH and a schedule are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what the last returns."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
