"""Hard negatives of anchors, by segment summaries of vectors.

Every vector is cut into segments, and mean and deviation of each are stored with it. By Cauchy and Schwarz
the inner product of two segments of length L lies within ``L * (m * m' - d * d')`` and
``L * (m * m' + d * d')``, and the sum over the segments bounds the score of two vectors. A search
drops pairs by the bounds of few long segments, then by those of more and shorter ones, and scores what
is left exactly, in integers.

Rows are packed into blocks; each block of anchors meets each block of rows through an equi-join on the stripe of
the row block. No task holds more than a few blocks and the best rows of some thousand anchors.
"""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

#: Rows and anchors in a block, and segments of the two levels (the second refines the first).
ROWS, ANCHORS = 2048, 512
LEVELS = (4, 16)
#: Blocks of anchors of which a task holds the best rows before it hands them on.
HELD = 256
#: Below this share of pairs left, only those are scored; else whole blocks.
SPARSE = 0.05
#: Integers up to here are exact in a double.
EXACT = 1 << 53
NONE = np.iinfo(np.int64).min


# -- blocks --------------------------------------------------------------------------------------------------


def summaries(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment of the finest level, each times the root of its length."""
    edges = _edges(x.shape[1], LEVELS[-1])
    lengths = np.diff(edges)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / lengths
    spread = np.square(x - np.repeat(mean, lengths, axis=1))
    return mean * np.sqrt(lengths), np.sqrt(np.add.reduceat(spread, edges[:-1], axis=1))


def _edges(dims: int, segments: int) -> np.ndarray:
    return np.unique(np.linspace(0, dims, segments + 1).astype(int))


def coarser(means: np.ndarray, deviations: np.ndarray, dims: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The summaries of fewer, longer segments, from those of the finest level."""
    fine, edges = _edges(dims, LEVELS[-1]), _edges(dims, segments)
    first = np.searchsorted(fine, edges[:-1])
    sums = np.add.reduceat(means * np.sqrt(np.diff(fine)), first, axis=1)
    squares = np.add.reduceat(np.square(means) + np.square(deviations), first, axis=1)
    mean = sums / np.sqrt(np.diff(edges))
    return mean, np.sqrt(np.maximum(squares - np.square(mean), 0))


BLOCK = "dims int, stripe int, n int, rows binary, ids binary, labels array<string>, x binary, means binary, deviations binary"


def packed(frame: DataFrame, size: int, stripes: int, limits: bool = False) -> DataFrame:
    """Blocks of up to ``size`` rows of equal vector length, as numpy bytes, numbered round over ``stripes``."""
    schema = BLOCK + (", limits binary" if limits else "")

    def pack(batches):
        number = TaskContext.get().partitionId()
        held: dict[int, list] = {}
        for batch in batches:
            table = pa.table(batch)
            lengths = pc.list_value_length(table["x"]).to_numpy()
            for dims in np.unique(lengths).tolist():
                mine = table.filter(pa.array(lengths == dims))
                parts = held.setdefault(dims, [])
                parts.append(mine)
                count = sum(p.num_rows for p in parts)
                if count >= size:
                    whole, at = pa.concat_tables(parts), 0
                    while count - at >= size:
                        yield block(whole.slice(at, size), dims, number % stripes)
                        number, at = number + 1, at + size
                    held[dims] = [whole.slice(at)] if at < count else []
            # With many lengths of vectors no block may fill; none of them waits for long.
            if sum(p.num_rows for parts in held.values() for p in parts) > 4 * size:
                for dims, parts in held.items():
                    if parts:
                        yield block(pa.concat_tables(parts), dims, number % stripes)
                        number += 1
                held.clear()
        for dims, parts in held.items():
            if parts:
                yield block(pa.concat_tables(parts), dims, number % stripes)
                number += 1

    def block(table, dims, stripe):
        table = table.combine_chunks()
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, dims)
        means, deviations = summaries(x.astype(float)) if dims else (np.zeros((len(x), 0)),) * 2
        row = {
            "dims": dims,
            "stripe": stripe,
            "n": table.num_rows,
            "rows": table["row"].to_numpy().tobytes(),
            "ids": table["id"].to_numpy().tobytes(),
            "labels": table["label"].to_pylist(),
            "x": np.ascontiguousarray(x).tobytes(),
            "means": means.tobytes(),
            "deviations": deviations.tobytes(),
        }
        if limits:
            scores = table["limits"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            row["limits"] = scores.astype(np.int64).tobytes()
        return pa.RecordBatch.from_pylist([row], schema=kinds)

    kinds = pa.schema(
        [("dims", pa.int32()), ("stripe", pa.int32()), ("n", pa.int32()), ("rows", pa.binary()), ("ids", pa.binary())]
        + [("labels", pa.list_(pa.string()))]
        + [(name, pa.binary()) for name in ("x", "means", "deviations") + (("limits",) if limits else ())]
    )
    return frame.mapInArrow(pack, schema)


class Block:
    def __init__(self, batch: pa.RecordBatch, i: int, prefix: str):
        def get(name):
            return batch.column(prefix + name)[i].as_py()

        self.dims, self.n = get("dims"), get("n")
        self.rows, self.ids = (np.frombuffer(get(name), np.int64) for name in ("rows", "ids"))
        self.labels = np.array(get("labels"), dtype=object)
        self.x = np.frombuffer(get("x"), np.int64).reshape(self.n, self.dims)
        self.largest = max(int(self.x.max(initial=0)), -int(self.x.min(initial=0)))
        means, deviations = (np.frombuffer(get(name)).reshape(self.n, -1) for name in ("means", "deviations"))
        self.levels = [
            coarser(means, deviations, self.dims, s) if s != LEVELS[-1] else (means, deviations) for s in LEVELS if self.dims
        ]
        self.norm = np.sqrt((np.square(means) + np.square(deviations)).sum(axis=1))


def exact(a: Block, r: Block) -> bool:
    """Whether doubles hold all sums of products of the two exactly."""
    return a.dims * a.largest * r.largest < EXACT


def scored(a: Block, r: Block, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and exact score of the pairs in ``alive``."""
    i, j = np.nonzero(alive)
    if not exact(a, r):
        scores = [sum(p * q for p, q in zip(a.x[m].tolist(), r.x[n].tolist())) for m, n in zip(i, j)]
        return i, j, np.array(scores, dtype=np.int64)
    if len(i) < SPARSE * alive.size:
        step = max((8 << 20) // max(a.dims, 1), 1)
        parts = [
            np.einsum("ij,ij->i", a.x[i[at : at + step]], r.x[j[at : at + step]]) for at in range(0, len(i), step)
        ]
        return i, j, np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return i, j, (a.x.astype(float) @ r.x.astype(float).T)[i, j].astype(np.int64)


def filtered(a: Block, r: Block, alive: np.ndarray, wanted) -> np.ndarray:
    """Pairs of ``alive`` that the bounds of no level rule out. ``wanted(lower, upper, alive)`` tells which may
    still be results by their bounds; a level is left out where nothing is alive."""
    if not exact(a, r):
        return alive
    slack = 1e-6 * (np.outer(a.norm, r.norm) + 1)  # far above what rounding adds to a bound
    for (am, ad), (rm, rd) in zip(a.levels, r.levels):
        if not alive.any():
            break
        middle, width = am @ rm.T, ad @ rd.T + slack
        alive = alive & wanted(middle - width, middle + width, alive)
    return alive


def at_least(lower: np.ndarray, count: int) -> np.ndarray:
    """For each anchor a score that ``count`` rows reach surely; -inf where there are fewer rows."""
    if lower.shape[1] < count:
        return np.full(len(lower), -np.inf)
    return np.partition(lower, -count, axis=1)[:, -count]


# -- searches ------------------------------------------------------------------------------------------------


def best(anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` entries of each anchor, higher scores first, then smaller ids."""
    order = np.lexsort((ids, -scores, anchors))
    sorted_anchors = anchors[order]
    start = np.searchsorted(sorted_anchors, sorted_anchors)
    return order[np.arange(len(order)) - start < count]


class Held:
    """Best rows so far, of some blocks of anchors. What is handed on early only costs more rows later."""

    def __init__(self, count: int):
        self.count, self.blocks = count, OrderedDict()

    def of(self, key: bytes) -> tuple:
        """anchor (place in the block and window), score, id."""
        return self.blocks.get(key, (np.zeros(0, np.int64),) * 3)

    def put(self, key: bytes, *found):
        merged = [np.concatenate(both) for both in zip(self.of(key), found)]
        keep = best(merged[0], merged[1], merged[2], self.count)
        self.blocks[key] = tuple(m[keep] for m in merged)
        self.blocks.move_to_end(key)


def searched(pairs: DataFrame, count: int, windows: int, find) -> DataFrame:
    """Rows ``row`` (of the anchor), ``place`` (window), ``score``, ``id``: the best of each task."""

    def run(batches):
        held = Held(count)

        def handed(key):
            slots, scores, ids = held.blocks.pop(key)
            rows = np.frombuffer(key, np.int64)
            columns = [rows[slots // windows], (slots % windows).astype(np.int32), scores, ids]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "place", "score", "id"])

        for batch in batches:
            for i in range(batch.num_rows):
                a, r = Block(batch, i, "a_"), Block(batch, i, "r_")
                key = a.rows.tobytes()
                limits = None
                if windows > 1:
                    limits = np.frombuffer(batch.column("a_limits")[i].as_py(), np.int64).reshape(a.n, windows)
                held.put(key, *find(a, r, held.of(key), limits))
                while len(held.blocks) > HELD:
                    yield handed(next(iter(held.blocks)))
        while held.blocks:
            yield handed(next(iter(held.blocks)))

    return pairs.mapInArrow(run, "row long, place int, score long, id long")


def same_label(count: int):
    """Finds the ``count`` highest scores of each anchor among other rows of its label."""

    def find(a, r, known, _):
        found = [(np.zeros(0, np.int64),) * 3]
        floor = np.full(a.n, -np.inf)  # what the rows seen so far reach
        slots, scores, _ids = known
        full = np.bincount(slots, minlength=a.n) >= count
        np.minimum.at(least := np.full(a.n, np.inf), slots, scores.astype(float))
        floor[full] = least[full]
        for label in set(a.labels) & set(r.labels):
            mine, theirs = np.flatnonzero(a.labels == label), np.flatnonzero(r.labels == label)
            sa, sr = _part(a, mine), _part(r, theirs)
            others = sa.rows[:, None] != sr.rows[None, :]

            def wanted(lower, upper, alive, mine=mine):
                sure = at_least(np.where(alive, lower, -np.inf), count)
                return upper >= np.maximum(floor[mine], sure)[:, None]

            i, j, s = scored(sa, sr, filtered(sa, sr, others, wanted))
            keep = best(i, s, sr.ids[j], count)
            found.append((mine[i[keep]], s[keep], sr.ids[j[keep]]))
        return [np.concatenate(part) for part in zip(*found)]

    return find


def _part(block: Block, places: np.ndarray) -> Block:
    part = object.__new__(Block)
    part.dims, part.n, part.largest = block.dims, len(places), block.largest
    part.rows, part.ids, part.x, part.norm = (v[places] for v in (block.rows, block.ids, block.x, block.norm))
    part.levels = [(m[places], d[places]) for m, d in block.levels]
    return part


def other_label(count: int, windows: int, least: int, most: int):
    """Finds, for each positive of an anchor, the ``count`` highest scores among rows of other labels
    with ``least * positive <= 100 * score <= most * positive``."""

    def find(a, r, known, limits):
        scores = limits.astype(object)  # a multiple may be beyond a long
        low = np.where(limits == NONE, -NONE - 1, -(-scores * least // 100)).astype(np.int64)
        high = np.where(limits == NONE, NONE, scores * most // 100).astype(np.int64)
        held_slots, held_scores, _ids = known
        full = (np.bincount(held_slots, minlength=a.n * windows) >= count).reshape(a.n, windows)
        np.minimum.at(worst := np.full(a.n * windows, np.inf), held_slots, held_scores.astype(float))
        floor = np.where(full, np.maximum(worst.reshape(a.n, windows), low), low).astype(float)
        different = _codes(a.labels, r.labels)

        def wanted(lower, upper, alive):
            may = np.zeros(alive.shape, bool)
            for w in range(windows):
                sure = alive & (lower >= low[:, w, None]) & (upper <= high[:, w, None])
                reached = np.maximum(floor[:, w], at_least(np.where(sure, lower, -np.inf), count))
                may |= (upper >= reached[:, None]) & (lower <= high[:, w, None])
            return may

        i, j, s = scored(a, r, filtered(a, r, different, wanted))
        found = [(np.zeros(0, np.int64),) * 3]
        for w in range(windows):
            inside = np.flatnonzero((s >= low[i, w]) & (s <= high[i, w]))
            keep = inside[best(i[inside], s[inside], r.ids[j[inside]], count)]
            found.append((i[keep] * windows + w, s[keep], r.ids[j[keep]]))
        return [np.concatenate(part) for part in zip(*found)]

    return find


def _codes(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Whether labels differ, for each pair."""
    codes: dict = {}
    left, right = (np.array([codes.setdefault(v, len(codes)) for v in side], dtype=np.int64) for side in (a, r))
    return left[:, None] != right[None, :]


# -- the operator --------------------------------------------------------------------------------------------


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    label: str | Column = "label",
    vector: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
) -> DataFrame:
    """For each anchor and each of its positives, rows of other labels that score nearly as high.

    A component c becomes ``floor(scale * c)``; scores are inner products of those, exact. ``anchors`` is a
    condition on the rows. The positives of an anchor are the ``positives`` other rows of its label that score highest, its
    negatives for one of them the ``negatives`` highest with ``least * p <= 100 * score <= most * p``. Equal
    scores go by id. Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows whose id, label or vector is null, and those with a null or non-finite component, take no part, and
    a condition that is null makes no anchor. Rows are told apart, not ids: a repeated row is another row, may be
    a positive of the first, and is an anchor of its own. Vectors of different lengths have no score with each
    other; empty ones score 0. An empty table, or one without anchors, gives no rows. Other columns of
    any name are left out. A score beyond a long is an error.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    label = F.col(f"`{label}`") if isinstance(label, str) else label
    entries = F.col(f"`{vector}`")
    broken = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = (
        vectors.select(
            F.col(f"`{id_column}`").cast("long").alias("id"),
            label.cast("string").alias("label"),
            F.when(~broken, F.transform(entries, lambda c: F.floor(c.cast("double") * scale))).alias("x"),
            F.coalesce(anchors, F.lit(False)).alias("anchor"),
        )
        .where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
        .withColumn("row", F.monotonically_increasing_id())
    )
    rows = stored(rows, "vectors")  # from here on a row keeps its number
    stripes = min(2 * parts, rows.count() // ROWS + 1)
    blocks = packed(rows.select("row", "id", "label", "x"), ROWS, stripes)
    blocks = blocks.repartition(parts, "dims", "stripe").select(*[F.col(c).alias(f"r_{c}") for c in blocks.columns])

    def meet(chosen: DataFrame, limits: bool) -> DataFrame:
        chosen = packed(chosen.orderBy("label", "row"), ANCHORS, stripes, limits)
        copies = chosen.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
        copies = copies.repartition(parts, "dims", "stripe").select(*[F.col(c).alias(f"a_{c}") for c in copies.columns])
        # Two shuffled sides of packed blocks: whichever is small, neither is sent whole to every task.
        return blocks.hint("merge").join(copies, (F.col("r_dims") == F.col("a_dims")) & (F.col("r_stripe") == F.col("a_stripe")))

    chosen = rows.where("anchor").select("row", "id", "label", "x")
    order = [F.desc("score"), F.asc("id")]
    near = searched(meet(chosen, False), positives, 1, same_label(positives))
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("row").orderBy(*order)))
    near = stored(near.where(F.col("place") <= positives), "positives")

    # Scores by place; an anchor with fewer positives has NONE in the rest.
    by_place = F.map_from_entries(F.collect_list(F.struct("place", "score")))
    limits = near.groupBy(F.col("row").alias("of")).agg(by_place.alias("scores"))
    limits = limits.select(
        "of", F.array(*[F.coalesce(F.col("scores")[k + 1], F.lit(NONE)) for k in range(positives)]).alias("limits")
    )
    if positives == 1:  # one window is told from none by a second, empty one
        limits = limits.withColumn("limits", F.concat("limits", F.array(F.lit(NONE))))
    windows = max(positives, 2)
    limited = chosen.join(limits, F.col("row") == F.col("of")).drop("of")
    far = searched(meet(limited, True), negatives, windows, other_label(negatives, windows, least, most))
    far = far.withColumn("rank", F.row_number().over(Window.partitionBy("row", "place").orderBy(*order)))
    far = far.where(F.col("rank") <= negatives).select(
        "row", (F.col("place") + 1).alias("place"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    near = near.select("row", "place", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = chosen.select("row", F.col("id").alias("anchor_id"))
    return far.join(near, ["row", "place"]).join(named, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
