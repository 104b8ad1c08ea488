"""Secret scans: a pattern finds candidates, a random forest sorts out the false positives.

The forest is trained here on labelled findings. It sees the candidate's length, its character
transitions, how much of it dictionary-like pieces cover, the path (the name it is assigned to) and the
words beside it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

SECRET_WORDS = r"(?i)(token|secret|passw|api.?key|access.?key|private|credential|auth(?!or(?!i))|bearer|login|pwd)"
HARMLESS_WORDS = r"(?i)(sha1|sha256|md5|checksum|commit|revision|uuid|guid|etag|digest|example|sample|dummy)"
# Repeated groups are of one character each: Java matches those in a loop, any others by recursion.
_KEY, _NAME = "A-Za-z0-9_+/=~-", "A-Za-z0-9_.-"
_SIGN = r"[\"'`]?[ \t]*(?:=>|:=|={1,3}|:)[ \t]*(?:(?i:bearer|basic|token)[ \t]+)?"
_SECRET_NAME = rf"(?=[{_NAME}]*?{SECRET_WORDS.replace('(?i)(', '(?i:').replace('.?', '[_.-]?')})[{_NAME}]++"
#: What ends an unquoted value: the next assignment, a closing quote, punctuation at the end of a word.
_ENDS = rf"[,;?&][{_NAME}]{{1,64}}+=|[\"'`][,;:)\]}}]|[,;:.)\]}}>\"'`]{{1,8}}+(?:\s|$)|</"
_VALUE = "|".join([rf"{q}(?:(?!(?<!\\){q})[^\r\n])++(?={q})" for q in "\"'`"] + [rf"[\"'`]?(?:(?!{_ENDS})\S)++"])
#: A candidate: the whole value assigned to the name of a secret, of any length and characters ...
ASSIGNED = rf"(?<![{_NAME}]){_SECRET_NAME}{_SIGN}(?:{_VALUE})"
#: ... or a whole run of the characters keys are written in, with a digit. Dots join runs; one of 16 or more
#: must be among them, else it is the name of a host or file.
_INSIDE = rf"(?!\.(?![{_KEY}]))"
RUN = (
    rf"(?<![{_KEY}])(?<![{_KEY}]\.)(?=(?:{_INSIDE}[A-Za-z_+/=~.-])*+[0-9])"
    rf"(?=(?:(?![{_KEY}]{{16}}){_INSIDE}[.{_KEY}])*+[{_KEY}]{{16}})"
    rf"(?![.{_KEY}]*?[/+~=]{_SECRET_NAME}=[^=\s])(?=[{_KEY}])(?:{_INSIDE}[.{_KEY}])++"
)
CANDIDATE = f"{ASSIGNED}|{RUN}"
#: The name a candidate is assigned to, at the end of what stands before it.
PATH = r"([A-Za-z_][A-Za-z0-9_.-]*)[\"']?\s*(?:=|:|=>|:=)\s*[\"']?$"
#: A name that is part of a candidate, up to its value; what ends a run is padding.
LEADING = rf"^(?:[^=:\"'\s]*/)?([{_NAME}]+){_SIGN}[\"'`]?(?=.)(?!=*$)"
#: Characters kept on each side of a candidate.
CONTEXT = 64
#: Pieces that ordinary words are made of: a vowel between consonants.
PIECES = r"(?i)[bcdfghjklmnpqrstvwxyz]?[aeiou][bcdfghjklmnpqrstvwxyz]"
FEATURES = (
    "length",
    "digit_share",
    "capital_share",
    "hex_share",
    "transition_share",
    "dictionary_share",
    "assigned",
    "secret_path",
    "secret_beside",
    "harmless_beside",
    "words_beside",
)
#: Left out where the forest labels its findings itself: what the labels are made of, or follows from it.
LABELLING = ("digit_share", "assigned", "secret_path", "harmless_beside")
#: Values that stand for a secret, and such of plain words, which may be one.
PLACEHOLDER = (
    r"(?i)^(?:[*x.]+|true|false|null|none|nil|undefined|string|str|required|optional|redacted|[<$%{\[(].*|"
    r".*(?:your|change.?me|placeholder|example|sample|dummy|insert|replace|to.?do).*)$"
)
PLAIN = r"^(?!.*\p{L}\p{Lu})[\p{L}_. -]+$"


@dataclass(frozen=True)
class Forest:
    """``sample_rows`` bounds the labelled findings it is trained on, those of least hash."""

    trees: int = 20
    depth: int = 5
    seed: int = 17
    sample_rows: int = 20_000
    threshold: float = 0.5


def candidates(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, row, start, stop, secret, before, after, path`` of every candidate of every whole text,
    places in code points. Null and empty texts have none; rows of one ``doc_id`` are each searched.

    A text is split at its candidates; the pieces between them, summed up in order, give the places.
    """
    given = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), F.col(f"`{text}`").alias("t"))
    cut = given.where(F.col("t").rlike(CANDIDATE)).select(
        "doc_id", "row", F.split("t", CANDIDATE).alias("gap"), F.regexp_extract_all("t", F.lit(CANDIDATE), F.lit(0)).alias("run")
    )
    pieces = cut.select("doc_id", "row", F.posexplode(F.arrays_zip("gap", "run")).alias("i", "piece")).select(
        "doc_id",
        "row",
        "i",
        F.col("piece.run").alias("secret"),
        F.length("piece.gap").alias("gap"),
        F.expr(f"right(piece.gap, {CONTEXT})").alias("before"),
        F.expr(f"left(piece.gap, {CONTEXT})").alias("next"),
    )
    # One text's candidates; texts without any are gone by now.
    along = Window.partitionBy("row").orderBy("i")
    length = F.coalesce(F.length("secret"), F.lit(0))
    placed = pieces.select(
        "doc_id",
        "row",
        "secret",
        "before",
        F.lead("next").over(along).alias("after"),
        F.sum(F.col("gap") + length).over(along).alias("stop"),
    ).where("secret is not null")
    # NAME=value without blanks is one run: the name is no part of the secret.
    leading = F.regexp_extract("secret", LEADING, 0)
    named = placed.withColumns({"name": F.regexp_extract("secret", LEADING, 1), "leading": leading}).withColumns(
        {
            "secret": F.expr("substring(secret, length(leading) + 1)"),
            "before": F.expr(f"right(concat(before, leading), {CONTEXT})"),
        }
    )
    return named.select(
        "doc_id",
        "row",
        (F.col("stop") - F.length("secret")).alias("start"),
        "stop",
        "secret",
        "before",
        "after",
        F.when(F.col("name") != "", F.col("name")).otherwise(F.regexp_extract("before", PATH, 1)).alias("path"),
    )


def features(found: DataFrame) -> DataFrame:
    """The candidates with ``FEATURES``."""

    def share(removed: str) -> Column:
        return F.length(F.regexp_replace("secret", removed, "")) / F.length("secret")

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    beside = F.concat_ws(" ", "before", "after")
    # The name it is assigned to is no word beside it.
    around = F.concat_ws(" ", F.regexp_replace("before", PATH, ""), "after")
    # Where a letter meets a digit, or lower case meets upper case: one sign between both.
    marked = F.regexp_replace("secret", r"(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[a-z])(?=[A-Z])", "\u0001")
    return found.select(
        "*",
        F.length("secret").cast("double").alias("length"),
        share("[^0-9]").alias("digit_share"),
        share("[^A-Z]").alias("capital_share"),
        share("[^0-9a-f]").alias("hex_share"),
        (F.length(marked) / F.length("secret") - 1).alias("transition_share"),
        (1 - share(PIECES)).alias("dictionary_share"),
        flag(F.col("path") != "").alias("assigned"),
        flag(F.col("path").rlike(SECRET_WORDS)).alias("secret_path"),
        flag(around.rlike(SECRET_WORDS)).alias("secret_beside"),
        flag(beside.rlike(HARMLESS_WORDS)).alias("harmless_beside"),
        F.size(F.regexp_extract_all(around, F.lit(r"\p{L}{3,}"), F.lit(0))).cast("double").alias("words_beside"),
    )


def labelled_findings(found: DataFrame) -> DataFrame:
    """Candidates with a ``label`` that needs no model: assigned to the name of a secret (1), but a placeholder
    (0) or a plain word (none); digits alone, or named as a checksum or example, and assigned to no such name
    (0). Others have no label."""
    return found.withColumn("label", _label()).where("label is not null")


def _label() -> Column:
    named = F.col("secret_path") == 1
    stands_for_one = named & F.col("secret").rlike(PLACEHOLDER)
    secret = named & (F.col("harmless_beside") == 0) & ~F.col("secret").rlike(PLAIN)
    harmless = ~named & ((F.col("digit_share") == 1) | (F.col("harmless_beside") == 1))
    return F.when(stands_for_one, 0.0).when(secret, 1.0).when(harmless, 0.0)


def _vectors(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="vector").transform(found)


def train(
    labelled: DataFrame, forest: Forest = Forest(), columns: Sequence[str] = FEATURES
) -> RandomForestClassificationModel | None:
    """The forest, or None where the labelled findings are not of both kinds. Each split sees a third of the
    ``columns``, so that no single one decides all trees."""
    chosen = labelled.select(*FEATURES, "label").orderBy(F.xxhash64(*FEATURES, "label")).limit(forest.sample_rows)
    # Bounded by sample_rows: a table of the driver, so that each tree's passes don't search the texts anew.
    rows = chosen.collect()
    if len({row.label for row in rows}) < 2:
        return None
    sample = labelled.sparkSession.createDataFrame(rows, chosen.schema)
    learner = RandomForestClassifier(
        featuresCol="vector", numTrees=forest.trees, maxDepth=forest.depth, seed=forest.seed, featureSubsetStrategy="onethird"
    )
    return learner.fit(_vectors(sample, columns).coalesce(2))


def scan(
    documents: DataFrame, labelled: DataFrame | None = None, forest: Forest = Forest(), text: str = "text"
) -> DataFrame:
    """Every candidate: ``doc_id, start, stop, path, secret, score`` (share of the forest for a secret) and
    ``is_secret``. ``labelled`` has ``FEATURES`` and ``label``; by default the findings of the documents
    themselves that ``labelled_findings`` labels. That forest goes by the value and the words beside it, not by
    what made the labels (``LABELLING``); findings labelled as no secrets stay that. With findings of one
    kind only no forest is trained, and a candidate is a secret if it is assigned to the name of one."""
    # Searched once: both the training and the scoring read what is stored.
    found = stored(features(candidates(documents, text)), "candidates")
    columns = FEATURES if labelled is not None else [c for c in FEATURES if c not in LABELLING]
    model = train(labelled_findings(found) if labelled is None else labelled, forest, columns)
    if model is None:
        scored = found.withColumn("score", F.col("secret_path"))
    else:
        scored = model.transform(_vectors(found, columns)).withColumn("score", vector_to_array("probability")[1])
    if labelled is None:
        scored = scored.withColumn("score", F.when(_label() == 0, 0.0).otherwise(F.col("score")))
    return scored.select(
        "doc_id", "start", "stop", "path", "secret", "score", (F.col("score") >= forest.threshold).alias("is_secret")
    )
