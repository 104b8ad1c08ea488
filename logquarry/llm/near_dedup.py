"""Near-duplicate documents: MinHash bands find candidates, full sets confirm links, stars join groups.

No step lists all pairs of a group. In each band bucket a pivot is compared with the members of other
groups, the confirmed links are merged into groups, and only members of different groups are compared
again. Once few such pairs are left, all of them are compared, so that no link is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import split_words, stored, text_slices, worker_state

WORDS = 5
BANDS, ROWS = 45, 5  # at a similarity of 0.75 one link in 190,000 is in no common bucket
HASHES = BANDS * ROWS
PERCENT = 75
#: Signatures that agree in fewer of the minima cannot be of linked sets (chance below 1e-12 at 0.75).
LEAST_AGREEING = 120
#: Rounds of pivots end when the pairs left are at most so many for each document, or hardly fewer than
#: before: what is left then are chance meetings, no groups.
PAIRS_PER_DOCUMENT = 4
LEAST_DROP = 0.1

_SEED = np.random.Generator(np.random.PCG64(9_241_755))
_A = _SEED.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)
_B = _SEED.integers(0, 1 << 32, HASHES, np.uint32)
_BAND = _SEED.integers(0, 1 << 63, (BANDS, ROWS), np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)

MARKS = ("size", "common", "bits")
#: Members of a block that are compared at once.
BLOCK = 256
SIGNED = "doc_id long, n_shingles long, set_key binary, minima binary, bands array<long>"


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finish)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles. Words are the runs of characters other than
    white space, A-Z lower-cased. Fewer than ``WORDS`` words are one shingle; without words: empty."""
    import xxhash

    split = split_words(texts, lower=True)
    words = np.fromiter(
        (xxhash.xxh3_64_intdigest(word) for word in split.distinct), np.uint64, len(split.distinct)
    )[split.ids] if len(split.ids) else np.zeros(0, np.uint64)
    sets = []
    for a, b in zip(split.bounds[:-1].tolist(), split.bounds[1:].tolist()):
        own = words[a:b]
        if len(own) >= WORDS:
            n = len(own) - WORDS + 1
            total = np.full(n, WORDS, np.uint64)
            for k in range(WORDS):
                total = mixed(total * _STEP + own[k : k + n])
        else:
            total = np.zeros(min(1, len(own)), np.uint64) + np.uint64(len(own))
            for word in own:
                total = mixed(total * _STEP + word)
        sets.append(np.unique(total))
    return sets


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each universal hash function (a x + b mod 2**32) over the set."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 512):
        np.minimum(least, (short[at : at + 512, None] * _A + _B).min(axis=0), out=least)
    return least


def signatures(documents: DataFrame, text: str = "text") -> DataFrame:
    """``SIGNED``: ``set_key`` names the exact set; ``bands`` is empty for an empty set."""
    import hashlib

    def sign(batches):
        worker_state("near-duplicates")
        for part in text_slices(batches):
            n, keys, least, bands = [], [], [], []
            for hashes in shingle_sets(part.column("text")):
                n.append(len(hashes))
                keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                low = minima(hashes)
                least.append((mixed(low.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8).tobytes())
                mix = mixed((low.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64))
                bands.append(mix.view(np.int64).tolist() if len(hashes) else [])
            columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys, pa.binary())]
            columns += [pa.array(least, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "set_key", "minima", "bands"])

    return documents.select("doc_id", F.col(text).alias("text")).mapInArrow(sign, SIGNED)


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its least node) of every node in ``edges(a, b)``, by alternating large
    and small stars until all are stars. Links are spread by node; hubs only ever keep their
    least neighbour, and skewed joins are split by the adaptive planner."""
    edges = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while unsettled(edges):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: each larger neighbour to the least of the neighbourhood.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: each smaller neighbour, and the node, to the least smaller neighbour.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = stored(small.where("a <> b").distinct(), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())


def unsettled(edges: DataFrame) -> int:
    """Nodes that have two links, or one while others have theirs to them: no stars yet."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("b", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or up = 1 and down = 1").count()


def marked(hashes: np.ndarray) -> bytes:
    """A bit for each low end of a hash of the set, 8 to 16 times as many bits as hashes."""
    size = max(64, 1 << (8 * len(hashes) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[hashes & np.uint64(size - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(x: bytes, nx: int, y: bytes, ny: int) -> bool:
    """Whether two sets of nx and ny hashes with these bits can be linked. Exact: a hash whose bit the other
    set lacks is not in the other set, so an intersection is at most what is left."""
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(x) > len(y):  # fewer low bits: the halves fall together
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    common = min(nx - int(np.bitwise_count(x & ~y).sum()), ny - int(np.bitwise_count(y & ~x).sum()))
    return 100 * common >= PERCENT * (nx + ny - common)


def confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are linked: 100 |intersection| >= 75 |union|."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("hashes").alias("ha"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("hashes").alias("hb"))

    def linked(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= PERCENT * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "ha", "hb").mapInArrow(linked, "a long, b long")
    )


def near_duplicates(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Documents with 100 |intersection| >= 75 |union| of their sets are linked; a component is named by
    its least ``doc_id``. Rows without words are linked with nothing. Of rows with one ``doc_id`` each
    is returned; a row without ``doc_id`` is a component of its own, named null and kept.
    """
    signed = stored(signatures(documents, text), "signatures")
    # One document stands for all with exactly its set.
    usable = signed.where("n_shingles > 0 and doc_id is not null")
    exact = usable.groupBy("set_key", "n_shingles").agg(
        F.min("doc_id").alias("rep"), F.min_by("minima", "doc_id").alias("minima"), F.min_by("bands", "doc_id").alias("bands")
    )
    exact = stored(exact, "sets")
    member = exact.select("rep", F.posexplode("bands").alias("band", "bucket"))
    shared = member.groupBy("band", "bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    member = stored(member.join(shared, ["band", "bucket"]), "members")
    candidates = stored(member.select(F.col("rep").alias("doc_id")).distinct(), "candidates")
    sets = stored(full_sets(documents, candidates, text), "hashes")
    # Rows of one doc_id may have several sets; no bits speak for all of them.
    bits = sets.groupBy("doc_id").agg(F.when(F.count("*") == 1, F.first("bits")).alias("bits"))
    least = exact.join(bits, F.col("rep") == F.col("doc_id"))
    least = stored(least.select("rep", "minima", F.col("n_shingles").alias("n"), "bits"), "verify")
    common = stored(commons(sets), "commons")
    member = stored(linkable(member, common), "members")
    marks = common.join(bits, F.col("rep") == F.col("doc_id")).select("rep", *MARKS)

    links = group = before = None
    n, round_, last = candidates.count(), 0, False
    while not last:
        placed = member.withColumn("g", F.col("rep")) if group is None else grouped(member, group)
        left = pairs_left(placed)
        if not left:
            break
        last = left <= PAIRS_PER_DOCUMENT * n or (before is not None and left > (1 - LEAST_DROP) * before)
        pairs = cross_pairs(placed, marks) if last else pivot_pairs(placed, round_)
        found = stored(confirm(agreeing(pairs.distinct(), least), sets), "links")
        links = found if links is None else links.unionByName(found)
        group = stored(components(links), "groups")
        before, round_ = left, round_ + 1
    rep = exact.select("set_key", F.col("rep").alias("node"))
    if group is not None:
        rep = rep.join(group, "node", "left")
    else:
        rep = rep.withColumn("component", F.col("node"))
    rep = rep.select("set_key", F.coalesce("component", "node").alias("component"))
    return (
        signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_key")).alias("set_key"))
        .join(rep, "set_key", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def commons(sets: DataFrame) -> DataFrame:
    """``rep``, the ``size`` of its set and how many of it are ``common``: in another candidate's set too.
    All hashes are counted. A ``doc_id`` with several sets counts as common throughout."""
    alone = sets.select("doc_id", F.explode("hashes").alias("h")).groupBy("h")
    alone = alone.agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1")
    alone = alone.groupBy("doc_id").agg(F.count("*").alias("alone"))
    own = sets.groupBy("doc_id").agg(F.min(F.size("hashes")).alias("size"), F.count("*").alias("sets"))
    common = F.when(F.col("sets") == 1, F.col("size") - F.coalesce("alone", F.lit(0)))
    return own.join(alone, "doc_id", "left").select(F.col("doc_id").alias("rep"), "size", common.alias("common"))


def linkable(member: DataFrame, common: DataFrame) -> DataFrame:
    """The members that can have a link in their bucket, exactly: an intersection is at most what a set has
    in common with any other, and a union at least the rest of it and the smallest set it could meet."""
    placed = member.join(common, "rep")
    smallest = placed.groupBy("band", "bucket").agg(F.min("size").alias("m"))
    met = F.greatest("m", F.ceil(F.col("size") * (PERCENT / 100)))
    possible = F.col("common").isNull() | (100 * F.col("common") >= PERCENT * (F.col("size") + met - F.col("common")))
    placed = placed.join(smallest, ["band", "bucket"]).where(possible)
    return placed.select("band", "bucket", "rep", (1 - F.coalesce(F.col("common") / F.col("size"), F.lit(1.0))).alias("alone"))


def pairs_left(placed: DataFrame) -> int:
    """Pairs in one bucket and different groups, counted by bucket, not listed."""
    own = placed.groupBy("band", "bucket", "g").agg(F.count("*").cast("decimal(38,0)").alias("n"))
    own = own.groupBy("band", "bucket").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("p"))
    return int(own.agg(F.sum("p")).first()[0] or 0)


def pivot_pairs(placed: DataFrame, round_: int) -> DataFrame:
    """One pair for each member: with the pivot that comes first among those of its buckets, of another
    group. First come, in all buckets, those with least of their own, the middle of a group of copies;
    later the order is drawn anew each round."""
    first = F.col("alone") if round_ == 0 else F.xxhash64(F.lit(round_), "g").cast("double")
    draw = F.struct(first, F.xxhash64(F.lit(round_), "rep"), "rep", "g")
    pivot = placed.groupBy("band", "bucket").agg(F.min(draw).alias("p"))
    pairs = placed.join(pivot, ["band", "bucket"]).where("g <> p.g").groupBy("rep").agg(F.min("p").alias("p"))
    return pairs.select(F.col("rep").alias("a"), F.col("p.rep").alias("b"))


def cross_pairs(placed: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs of a bucket whose members are in different groups and can be linked by their sizes and bits.

    Members outside the bucket's largest group meet all of it. They do so in blocks of about ``BLOCK``: near
    misses of a large group are many, and only what may be a link becomes a row.
    """
    bucket = ["band", "bucket"]
    largest = placed.groupBy(*bucket, "g").agg(F.count("*").alias("n"))
    largest = largest.groupBy(*bucket).agg(
        F.max(F.struct("n", "g")).alias("top"), F.sum("n").alias("n"), F.count("*").alias("groups")
    )
    # Only what stands in a bucket of several groups is compared.
    marked = placed.join(largest.where("groups > 1"), bucket).join(marks, "rep")
    chunk = F.pmod(F.xxhash64("rep"), F.ceil(F.col("n") / BLOCK))
    member = F.struct("rep", "g", *MARKS)
    blocks = marked.groupBy(*bucket, (F.col("g") != F.col("top.g")).alias("minor"), chunk.alias("chunk"))
    blocks = blocks.agg(F.collect_list(member).alias("members"))
    x = blocks.where("minor").select(*bucket, F.col("members").alias("x"))
    y = blocks.select(*bucket, "minor", F.col("members").alias("y"))

    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                xs, ys = (Members(batch.column(c)[row].values) for c in ("x", "y"))
                pairs = [xs.possible(i, ys, batch.column("minor")[row].as_py()) for i in range(len(xs.reps))]
                left = np.repeat(xs.reps, [len(p) for p in pairs])
                right = np.concatenate(pairs) if pairs else left
                columns = [np.minimum(left, right), np.maximum(left, right)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return x.join(y, bucket).select("x", "minor", "y").mapInArrow(compare, "a long, b long")


class Members:
    """A block of a bucket's members. Bits of equal number are rows of one matrix."""

    def __init__(self, rows: pa.StructArray):
        def numbers(name: str, absent: int = 0) -> np.ndarray:
            return rows.field(name).fill_null(absent).to_numpy(zero_copy_only=False)

        self.reps, self.groups, self.sizes = numbers("rep"), numbers("g"), numbers("size")
        self.commons = numbers("common", -1)  # -1: not known
        held = rows.field("bits")
        lengths = held.fill_null(b"").to_pylist()
        self.words = np.array([len(b) // 8 for b in lengths])  # 0: none
        self.place = np.zeros(len(lengths), np.int64)
        self.matrices: dict[int, np.ndarray] = {}
        for words in set(self.words.tolist()) - {0}:
            own = np.flatnonzero(self.words == words)
            self.place[own] = np.arange(len(own))
            self.matrices[words] = np.frombuffer(b"".join(lengths[i] for i in own), np.uint64).reshape(len(own), words)
        self.folds: dict[tuple[int, int], np.ndarray] = {}

    def folded(self, words: int, fewer: int) -> np.ndarray:
        if (words, fewer) not in self.folds:
            matrix = self.matrices[words]
            while matrix.shape[1] > fewer:
                half = matrix.shape[1] // 2
                matrix = matrix[:, :half] | matrix[:, half:]
            self.folds[words, fewer] = matrix
        return self.folds[words, fewer]

    def possible(self, i: int, others: Members, minor: bool) -> np.ndarray:
        """The reps of ``others`` that member i may be linked with. Two minor members meet once."""
        common = np.minimum(self.commons[i], others.commons)
        sizes = self.sizes[i] + others.sizes
        open_ = (others.groups != self.groups[i]) & ((common < 0) | (100 * common >= PERCENT * (sizes - common)))
        if minor:
            open_ &= self.reps[i] < others.reps
        if self.words[i]:
            for words in others.matrices:
                theirs = np.flatnonzero(open_ & (others.words == words))
                if len(theirs):
                    fewer = min(words, int(self.words[i]))
                    mine = self.folded(int(self.words[i]), fewer)[self.place[i]]
                    rows = others.folded(words, fewer)[others.place[theirs]]
                    lacking = np.bitwise_count(mine & ~rows).sum(axis=1, dtype=np.int64)
                    beside = np.bitwise_count(rows & ~mine).sum(axis=1, dtype=np.int64)
                    shared = np.minimum(self.sizes[i] - lacking, others.sizes[theirs] - beside)
                    open_[theirs] = 100 * shared >= PERCENT * (sizes[theirs] - shared)
        return others.reps[open_]


def grouped(member: DataFrame, group: DataFrame) -> DataFrame:
    return (
        member.join(group.withColumnRenamed("node", "rep"), "rep", "left")
        .select("band", "bucket", "rep", "alone", F.coalesce("component", "rep").alias("g"))
    )


def agreeing(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """Signature verification: pairs with enough equal minima whose bits allow a link. Near misses of a dense
    group share most minima and end at the bits, so hardly more than the links leave this step."""

    def check(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, HASHES) for c in ("ma", "mb"))
            keep = (x == y).sum(axis=1) >= LEAST_AGREEING
            columns = [batch.column(c) for c in ("bx", "na", "by", "nb")]
            for row in np.flatnonzero(keep).tolist():
                bx, na, by, nb = (c[row].as_py() for c in columns)
                keep[row] = bx is None or by is None or may_link(bx, na, by, nb)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = least.select(F.col("rep").alias("a"), F.col("minima").alias("ma"), F.col("n").alias("na"), F.col("bits").alias("bx"))
    right = least.select(F.col("rep").alias("b"), F.col("minima").alias("mb"), F.col("n").alias("nb"), F.col("bits").alias("by"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb", "na", "nb", "bx", "by")
    return joined.mapInArrow(check, "a long, b long")


def full_sets(documents: DataFrame, candidates: DataFrame, text: str) -> DataFrame:
    """``doc_id``, the ``hashes`` of the full set and its ``bits``, of the candidates only."""

    def hashes(batches):
        worker_state("near-duplicates")
        for part in text_slices(batches):
            sets = shingle_sets(part.column("text"))
            bits = pa.array([marked(x) for x in sets], pa.binary())
            sets = [x.view(np.int64) for x in sets]
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(sets)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, bits], ["doc_id", "hashes", "bits"])

    wanted = documents.select("doc_id", F.col(text).alias("text")).join(candidates, "doc_id", "left_semi")
    return wanted.mapInArrow(hashes, "doc_id long, hashes array<long>, bits binary")
