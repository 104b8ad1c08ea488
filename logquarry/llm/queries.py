"""The registered queries of the operators. Each applies its operator, with production parameters, to
a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table
from .decontaminate import contaminated
from .hard_negatives import hard_negatives
from .html_text import extract
from .licenses import licenses
from .mixing import mix
from .near_dedup import near_duplicates
from .personal_data import personal_data
from .quality_rules import quality
from .secrets import scan
from .token_counts import count_tokens
from .token_files import token_digests, write_token_files
from .url_filter import url_verdicts
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(spark, write_token_files(table(spark, sf_dir, "documents")))


@query
def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).drop("found")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return scored.select("doc_id", *base, "base_failed", "kept")


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses(table(spark, sf_dir, "documents")).drop("found")


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.withColumn("secret_sha256", F.sha2("secret", 256)).drop("secret")


@query
def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


#: Target weights of the mix; sources that aren't named weigh as their mean.
WEIGHTS = {f"src{i}": 1.0 + i % 4 for i in range(20)}


@query
def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(documents, WEIGHTS, order=["doc_id"])


@query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label=moved)


ORACLES["op12_hard_negatives"] = """
WITH valid AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS k,
        list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scores AS (
    SELECT a.k, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
        CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
    FROM valid a JOIN valid b ON a.vec_id % 100 = 0 AND a.k <> b.k AND len(a.x) = len(b.x)
), positives AS (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, other) AS place
    FROM scores WHERE same QUALIFY place <= 5
)
SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.k, p.place ORDER BY s.score DESC, s.other) AS INTEGER) AS rank
FROM positives p JOIN scores s ON p.k = s.k AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""


@query
def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages")).drop("blocked_probability")
