"""Quality rules: text statistics as Spark expressions, and a decision list learned from labelled rows.

The list is grown by sequential covering. Each rule is a conjunction of thresholds on the statistics: it
grows by the threshold of greatest gain on two thirds of the labelled rows, is pruned on the rest, and
the rows it covers are taken out before the next. What comes out is one ordered Spark conditional.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, functions as F

from .common import unused

#: The white space that ends words, and the characters that count as symbols.
SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"
FEATURES = ("word_length", "symbol_share", "duplicate_line_share", "repeat_share", "capital_share", "digit_share")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def holds(self, row) -> bool:
        return (row[self.feature] > self.threshold) == self.above


Rule = tuple[Condition, ...]


def statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """Each row with the counts of its whole text: ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words``, and ``FEATURES``. A null text has no word.

    A repeated window of three words is found by sorting: every window is one long, its hash above its
    place, so equal windows are neighbours; their words are compared before they count.
    """
    keep = [f"`{c}`" for c in documents.columns if c != text]
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    split = documents.select(
        *keep,
        F.filter(F.split(value, SPACE + "+"), lambda word: word != "").alias("__w"),
        F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("__l"),
        F.length(F.regexp_replace(value, SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(value, "[^A-Z]+", "")).alias("__capitals"),
        F.length(F.regexp_replace(value, "[^0-9]+", "")).alias("__digits"),
    )
    counted = split.select(
        *keep,
        "__w",
        "n_symbols",
        "__capitals",
        "__digits",
        F.size("__w").cast("long").alias("n_words"),
        F.aggregate("__w", F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias("word_chars"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size("__l").alias("__lines"),
        # As many bits as places need.
        F.length(F.bin(F.size("__w"))).alias("__bits"),
    )
    windows = counted.withColumn(
        "__t",
        F.expr(
            "CASE WHEN n_words < 3 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, size(__w) - 3),"
            " i -> shiftleft(xxhash64(__w[i], __w[i + 1], __w[i + 2]), __bits) | i) END"
        ),
    ).withColumn("__t", F.sort_array("__t"))
    place = "CAST({0} & (shiftleft(1L, __bits) - 1) AS int)"
    mask = place.format("x")

    def same(neighbour: str) -> str:
        other = place.format(f"__t[{neighbour}]")
        words = " AND ".join(f"__w[{mask} + {k}] = __w[{other} + {k}]" for k in range(3))
        return f"(shiftright(x, __bits) = shiftright(__t[{neighbour}], __bits) AND {words})"

    repeated = windows.withColumn(
        "__r",
        F.expr(
            f"sort_array(transform(filter(__t, (x, j) -> (j > 0 AND {same('j - 1')})"
            f" OR (j < size(__t) - 1 AND {same('j + 1')})), x -> {mask}))"
        ),
    )
    # Places p1 < p2 < ...: each window counts up to three words, fewer where the next overlaps it.
    covered = repeated.withColumn(
        "n_repeat_words",
        F.expr(
            "aggregate(__r, named_struct('n', 0L, 'end', 0), (a, p) -> named_struct("
            "'n', a.n + p + 3 - greatest(p, a.end), 'end', p + 3), a -> a.n)"
        ),
    )
    # A filter on a statistic must not be pushed below: it would compute the arrays anew for every word.
    # The optimizer pushes none past a column that isn't deterministic.
    covered = covered.withColumn("__row", F.monotonically_increasing_id())

    def share(part, whole: str):
        return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))

    return covered.select(
        *keep,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.when(F.col("__row") >= 0, F.col("n_repeat_words")).alias("n_repeat_words"),
        share("word_chars", "n_words").alias("word_length"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "__lines").alias("duplicate_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("__capitals", "word_chars").alias("capital_share"),
        share("__digits", "word_chars").alias("digit_share"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def labelled_statistics(documents: DataFrame, labels: DataFrame, sample_rows: int) -> list:
    """Statistics and label of at most ``sample_rows`` labelled rows, those of least hash."""
    labels = labels.where("doc_id is not null and quality is not null").select("doc_id", "quality")
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    # Bounded by sample_rows, whatever the size of the tables.
    own = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    half = F.pmod(F.xxhash64(F.lit("prune"), "doc_id"), F.lit(3)) == 0
    rows = statistics(own).where(~base_failed()).select("doc_id", *FEATURES, (F.col("quality") == 0).alias("bad"), half.alias("prune"))
    return rows.orderBy("doc_id", *FEATURES).limit(sample_rows).collect()


def learn(rows: list, least_precision: float = 0.95, least_rows: int = 5, cuts: int = 64) -> list[Rule]:
    """An ordered list of rules for bad rows (``row.bad``). A rule is kept if at least ``least_rows`` bad
    rows are under it and ``least_precision`` of all under it are bad; with none such the list ends."""
    grow, prune = [r for r in rows if not r["prune"]], [r for r in rows if r["prune"]]
    rules: list[Rule] = []
    while any(r["bad"] for r in grow):
        rule = _grown(grow, cuts)
        rule = _pruned(rule, prune)
        under = [r for r in grow + prune if rule and all(c.holds(r) for c in rule)]
        bad = sum(r["bad"] for r in under)
        if bad < least_rows or bad < least_precision * len(under):
            break
        rules.append(rule)
        grow, prune = ([r for r in part if not all(c.holds(r) for c in rule)] for part in (grow, prune))
    return rules


def _grown(rows: list, cuts: int) -> Rule:
    rule: list[Condition] = []
    bad, all_ = sum(r["bad"] for r in rows), len(rows)
    while 0 < bad < all_ and len(rule) < 4:
        best, best_gain = None, 1e-9
        for feature in FEATURES:
            ordered = sorted(rows, key=lambda r: r[feature])
            values = [r[feature] for r in ordered]
            sums = [0]
            for r in ordered:
                sums.append(sums[-1] + r["bad"])
            places = {len(values) * k // cuts for k in range(1, cuts)} | {1, 2, 4, len(values) - 4, len(values) - 2, len(values) - 1}
            for at in sorted(p for p in places if 0 < p < len(values)):
                while at < len(values) and values[at] == values[at - 1]:
                    at += 1  # a threshold lies between different values
                if at == len(values):
                    continue
                middle = (values[at - 1] + values[at]) / 2
                for above, p, n in ((False, sums[at], at), (True, bad - sums[at], len(values) - at)):
                    if p:
                        gain = p * (log2(p / n) - log2(bad / all_))
                        if gain > best_gain:
                            best, best_gain = Condition(feature, above, middle), gain
        if best is None:
            break
        rule.append(best)
        rows = [r for r in rows if best.holds(r)]
        bad, all_ = sum(r["bad"] for r in rows), len(rows)
    return tuple(rule)


def _pruned(rule: Rule, rows: list) -> Rule:
    """The beginning of the rule that is worth most on the rows it was not grown on."""

    def worth(part: Rule) -> float:
        under = [r["bad"] for r in rows if all(c.holds(r) for c in part)]
        return (2 * sum(under) - len(under)) / len(under) if under else -1.0

    return max((rule[:n] for n in range(len(rule), 0, -1)), key=worth, default=())


def verdict(rules: list[Rule]) -> Column:
    """False by the first rule that holds, else true."""
    decided = None
    for rule in rules:
        holds = rule[0].column()
        for condition in rule[1:]:
            holds = holds & condition.column()
        decided = F.when(holds, False) if decided is None else decided.when(holds, False)
    return F.lit(True) if decided is None else decided.otherwise(True)


def quality(documents: DataFrame, labels: DataFrame, sample_rows: int = 4096) -> DataFrame:
    """All columns but ``text``, the statistics, ``base_failed`` and ``kept``.

    ``kept`` is false if the base fails (fewer than 50 words, or more than half of them in repeated
    windows), else the verdict of the list learned from ``labels`` (``doc_id``, ``quality`` 0 or 1) of at
    most ``sample_rows`` rows. Without labels no rule is learned. Null texts fail the base. Repeated rows are judged
    each, a null ``doc_id`` stays; columns named as the added ones are replaced, all others stay.
    """
    rules = learn(labelled_statistics(documents, labels, sample_rows))
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES]
    rest = [c for c in documents.columns if c not in (*measures, "base_failed", "kept", "text")]
    # The other columns travel as one, so that no name of theirs meets one of the statistics.
    own = F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(None).cast("int").alias(unused("nothing", rest)))
    scored = statistics(documents.select(own.alias("given"), "text")).withColumn("base_failed", base_failed())
    scored = scored.withColumn("kept", ~F.col("base_failed") & verdict(rules))
    return scored.select(*[F.col("given")[c].alias(c) for c in rest], *measures, "base_failed", "kept")
