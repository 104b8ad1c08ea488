"""Mixing sources to target weights by Pfair scheduling.

Every source is a row of blocks. With a share ``w`` of the slots, its block ``j`` may not run before
``floor(j / w)`` and must by ``ceil((j + 1) / w)``; running the released block of earliest deadline in each
slot keeps every source within one block of its share at every slot. Shares are exact fractions. Where all
are whole parts of a cycle that is short enough, the schedule repeats after it: one cycle is scheduled,
whatever the number of documents. Otherwise every slot is: the driver walks through them and keeps where
each source stands from time to time, tasks write down the slots from there.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from fractions import Fraction
from itertools import islice
from math import gcd, lcm

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

#: Documents of a block, slots of a cycle at most, and rows that are numbered together.
BLOCK_DOCUMENTS = 32
CYCLE = 2_520
BUCKET_ROWS = 2_000
#: Slots that one row of the plan stands for where the schedule doesn't repeat.
SEGMENT = 20_000
#: Sources at most. It bounds what is scheduled on the driver and broadcast: a cycle for each source that ends.
MAX_SOURCES = 500


def shares(weights: dict[str, float], cycle: int = CYCLE) -> dict[str, int]:
    """Slots of each source in a cycle: in proportion to its weight, by largest remainders, one at least."""
    total = sum(map(Fraction, weights.values()))
    exact = {s: Fraction(w) * cycle / total for s, w in weights.items()}
    given = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (given[s] - exact[s], s))
    while sum(given.values()) < cycle:
        for s in order[: cycle - sum(given.values())]:
            given[s] += 1
    while sum(given.values()) > cycle:
        largest = max(given, key=lambda s: (given[s] - exact[s], given[s], s))
        given[largest] -= 1
    return given


def whole_parts(weights: dict[str, Fraction]) -> dict[str, int]:
    """The least whole numbers in the proportion of ``weights``. Their sum is the shortest exact cycle."""
    scale = lcm(*(w.denominator for w in weights.values()))
    parts = {s: int(w * scale) for s, w in weights.items()}
    least = gcd(*parts.values())
    return {s: n // least for s, n in parts.items()}


def slots_from(parts: dict[str, int], ran: dict[str, int], slot: int) -> Iterator[tuple[str, int, int, int, int]]:
    """``source, block, release, deadline, slot`` of every slot from ``slot`` on, where ``ran`` blocks of each
    source went before it. Of equal deadlines the block goes first whose window overlaps the next (it leaves
    its source less room), then the larger share."""
    cycle = sum(parts.values())
    waiting = [(ran[s] * cycle // n, s, ran[s]) for s, n in parts.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, bool, int, str, int]] = []
    while True:
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            deadline = -(-(j + 1) * cycle // parts[s])
            heapq.heappush(ready, (deadline, (j + 1) * cycle % parts[s] == 0, -parts[s], s, j))
        deadline, _, _, s, j = heapq.heappop(ready)
        yield s, j, j * cycle // parts[s], deadline, slot
        slot += 1
        heapq.heappush(waiting, ((j + 1) * cycle // parts[s], s, j + 1))


def schedule(parts: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One cycle of ``sum(parts)`` slots."""
    return list(islice(slots_from(parts, dict.fromkeys(parts, 0), 0), sum(parts.values())))


def numbered(documents: DataFrame, counts: dict[str, int], order: list[Column]) -> DataFrame:
    """Adds ``n``: the place of each row in its ``source``, from 0, in an order drawn by hash.

    A source is numbered in buckets of about ``BUCKET_ROWS`` rows, as many as its own ``counts`` ask for; the
    buckets' sizes are summed up. So a source with most rows has most buckets, and no task more of one than another.
    """
    spark = documents.sparkSession
    rows = [(s, -(-n // BUCKET_ROWS)) for s, n in counts.items()]
    # Bounded by MAX_SOURCES rows.
    buckets = F.broadcast(spark.createDataFrame(rows, "source string, buckets long"))
    keyed = documents.join(buckets, "source").withColumn("bucket", F.pmod(F.xxhash64(F.lit("mix"), *order), F.col("buckets")))
    sizes = keyed.groupBy("source", "bucket").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("source").orderBy("bucket")) - F.col("size")
    sizes = sizes.select("source", "bucket", before.alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy(F.xxhash64(*order), *order)
    ranked = keyed.withColumn("inside", F.row_number().over(inside) - 1)
    return ranked.join(sizes, ["source", "bucket"]).withColumn("n", F.col("before") + F.col("inside"))


def phases(blocks: dict[str, int], target: dict[str, Fraction], cycle: int):
    """Rows ``(source, phase, from_block, to_block, parts, first_slot, cycle)`` and ``(phase, source, k, release,
    deadline, slot)``, the latter within a cycle. A phase ends with the last block of the source that ends first; the
    next goes without that source. None if the exact cycle of a phase has more than ``cycle`` slots."""
    runs, plans = [], []
    done, first, phase = dict.fromkeys(blocks, 0), 0, 0
    while left := {s: blocks[s] - done[s] for s in sorted(blocks) if blocks[s] > done[s]}:
        parts = whole_parts({s: target[s] for s in left})
        slots = sum(parts.values())
        if slots > cycle:
            return None
        plan = schedule(parts)
        at = {(s, k): slot for s, k, _, _, slot in plan}
        end = 1 + min((n - 1) // parts[s] * slots + at[s, (n - 1) % parts[s]] for s, n in left.items())
        whole, rest = divmod(end, slots)
        ran = {s: whole * n for s, n in parts.items()}
        for s, _, _, _, slot in plan:
            ran[s] += slot < rest
        for s in left:
            runs.append((s, phase, done[s], done[s] + ran[s], parts[s], first, slots))
            done[s] += ran[s]
        plans += [(phase, *x) for x in plan]
        first += end
        phase += 1
    return runs, plans


def stands(blocks: dict[str, int], target: dict[str, Fraction], every: int) -> Iterator[tuple]:
    """``(first_slot, slot, slots, sources, done, ran)``: where the sources of a phase stand (blocks before
    the phase and in it) at its ``slot``, for each ``every`` slots. A phase ends with the last block of the
    source that ends first."""
    done, first = dict.fromkeys(blocks, 0), 0
    while left := {s: blocks[s] - done[s] for s in sorted(blocks) if blocks[s] > done[s]}:
        ran, began, at = dict.fromkeys(left, 0), list(left), 0
        before = [0] * len(left)
        for s, j, _, _, slot in slots_from(whole_parts({s: target[s] for s in left}), ran, 0):
            ran[s] = j + 1
            ends = ran[s] == left[s]
            if ends or slot + 1 - at == every:
                yield first, at, slot + 1 - at, began, [done[x] for x in began], before
                at, before = slot + 1, [ran[x] for x in began]
            if ends:
                break
        first += at
        for s in left:
            done[s] += ran[s]


def every_slot(spark: SparkSession, blocks: dict[str, int], target: dict[str, Fraction], every: int) -> DataFrame:
    """``source, block, r, d, t`` of all slots, for shares of any cycle. Tasks write them from where
    the sources stand each ``every`` slots; the driver keeps no more than that."""

    def run(batches):
        for batch in batches:
            for first, at, slots, sources, done, ran in zip(*(c.to_pylist() for c in batch.columns)):
                before = dict(zip(sources, done))
                parts = whole_parts({s: target[s] for s in sources})
                rows = islice(slots_from(parts, dict(zip(sources, ran)), at), slots)
                rows = [(s, before[s] + j, first + r, first + d, first + t) for s, j, r, d, t in rows]
                columns = [pa.array(x, kind) for x, kind in zip(zip(*rows), [pa.string(), *[pa.int64()] * 4])]
                yield pa.RecordBatch.from_arrays(columns, ["source", "block", "r", "d", "t"])

    schema = "first long, at long, slots long, sources array<string>, done array<long>, ran array<long>"
    given = spark.createDataFrame(list(stands(blocks, target, every)), schema)
    return given.repartition(spark.sparkContext.defaultParallelism).mapInArrow(
        run, "source string, block long, r long, d long, t long"
    )


def mix(
    documents: DataFrame,
    weights: dict[str, float] | None = None,
    source: str = "source",
    order: list[str] | None = None,
    block_documents: int = BLOCK_DOCUMENTS,
    cycle: int = CYCLE,
) -> DataFrame:
    """Every row with ``block`` (of its source), ``release``, ``deadline``, ``slot`` and ``place`` (in the
    block). The mix is read by ``slot`` and ``place``; no slot is empty.

    ``weights`` are by source; a source that isn't named has the mean of those that are, and without any
    all have the same. A null source counts as an empty one. No row is left out or repeated: where a
    source ends the mix goes on by the weights of the others, and while none ends each has its
    share of the slots to within one block. ``order`` are the columns that tell rows apart; equal rows stand next to
    each other in an order of their own. An empty table gives no rows. Other columns stay, whatever their
    names, but for those named as the added ones.
    """
    placed = _placed(documents, weights, source, order, block_documents, cycle)
    added = ("block", "release", "deadline", "slot", "place")
    rest = [F.col("row")[c].alias(c) for c in documents.columns if c not in added]
    return placed.select(*rest, *added)


def _placed(documents, weights, source, order, block_documents, cycle) -> DataFrame:
    """``row`` (all columns of the documents) and the added ones."""
    keys = [c for c in order or ["doc_id", "text"] if c in documents.columns]
    given = documents.select(
        F.struct(*[f"`{c}`" for c in documents.columns]).alias("row"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"),
    )
    counts = {r["source"]: r["count"] for r in given.groupBy("source").count().limit(MAX_SOURCES + 1).collect()}
    if len(counts) > min(MAX_SOURCES, cycle):
        raise ValueError(f"more than {min(MAX_SOURCES, cycle)} sources")
    # A weight is the number as it is written: 0.1 is a tenth.
    named = {s: Fraction(str(w)) for s, w in (weights or {}).items() if w > 0}
    mean = sum(named.values()) / len(named) if named else Fraction(1)
    blocks = {s: -(-n // block_documents) for s, n in counts.items()}
    target = {s: named.get(s, mean) for s in counts}
    spark = documents.sparkSession
    placed = numbered(given, counts, [F.col("row")[c] for c in keys]).withColumn("block", F.expr(f"n div {block_documents}"))
    if (repeated := phases(blocks, target, cycle)) is None:
        placed = placed.join(every_slot(spark, blocks, target, SEGMENT), ["source", "block"])
        base = F.lit(0)
    else:
        runs, plans = repeated
        # Bounded by MAX_SOURCES: a row for each source and phase, and for each phase and slot of a cycle.
        run = spark.createDataFrame(
            runs, "source string, phase int, first_block long, end_block long, parts int, first_slot long, cycle int"
        )
        plan = spark.createDataFrame(plans, "phase int, source string, k long, r long, d long, t long")
        placed = placed.join(F.broadcast(run), "source").where("block >= first_block and block < end_block")
        placed = placed.withColumn("k", F.expr("(block - first_block) % parts"))
        placed = placed.join(F.broadcast(plan), ["phase", "source", "k"])
        base = F.expr("first_slot + (block - first_block) div parts * cycle")
    return placed.select(
        "row",
        "block",
        (base + F.col("r")).alias("release"),
        (base + F.col("d")).alias("deadline"),
        (base + F.col("t")).alias("slot"),
        (F.col("n") % block_documents).alias("place"),
    )


def mixed_rows(documents: DataFrame, weights: dict[str, float] | None = None, source: str = "source") -> DataFrame:
    """The rows of ``documents``, all columns as they are, stored in the order of the mix: sorted over the
    whole result, so that files written from it follow each other."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = _placed(documents, weights, source, None, BLOCK_DOCUMENTS, CYCLE).repartitionByRange(parts, "slot", "place")
    return placed.sortWithinPartitions("slot", "place").select("row.*")
