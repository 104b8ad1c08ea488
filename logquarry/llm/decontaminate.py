"""Benchmark passages in documents: CGK embedding, bit-sampling LSH over item-sized windows, exact edits.

Words are compared, not characters: lower-cased, punctuation left out. The CGK walk embeds a word string
into a longer one: it copies the word it stands on and a random bit of that word says whether to step
on. Strings within k edits differ in O(k^2) places of their embeddings, and equal places of two
embeddings are found by sampling: windows that agree in all sampled places of one table are candidates.
A table always samples the first place, which is the window's first word, so windows are taken up by
that word; several starts within each item, each with several walks and samples, make up for edits.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import split_words, text_slices, worker_state
from .near_dedup import mixed

#: Items that one pass over the documents takes, and characters of their texts: what a worker holds.
ITEMS, ITEM_CHARS = 20_000, 32 << 20
CACHE_SIZE = 300_000
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """``edits`` of a passage's words may differ (rounded down). Items of fewer than ``least_words`` words
    identify nothing and are passed over. An item is looked for from ``starts`` places, each with ``walks``
    embeddings, of each of which ``tables`` samples of ``places`` places are drawn."""

    edits: float = 0.2
    least_words: int = 5
    starts: int = 6
    walks: int = 3
    tables: int = 4
    places: int = 3


def normal_word(word: str) -> str:
    return "".join(filter(str.isalnum, word.lower()))


def word_hashes(distinct: list[str]) -> np.ndarray:
    """Hash of each word without its punctuation; 0 for one of punctuation alone."""
    import xxhash

    known = worker_state("decontamination").setdefault("words", {})
    if len(known) > CACHE_SIZE:
        known.clear()
    for word in distinct:
        if word not in known:
            bare = normal_word(word)
            known[word] = xxhash.xxh3_64_intdigest(bare) | 1 if bare else 0
    return np.fromiter((known[word] for word in distinct), np.uint64, len(distinct))


def cgk(windows: np.ndarray, walk: int) -> np.ndarray:
    """Embeddings of equally long windows (rows of word hashes) in twice their length. Past its end a
    window has zeros."""
    n, length = windows.shape
    rows, at = np.arange(n), np.zeros(n, np.int64)
    out = np.zeros((n, 2 * length), np.uint64)
    for step in range(2 * length):
        here = np.where(at < length, windows[rows, np.minimum(at, length - 1)], np.uint64(0))
        out[:, step] = here
        salt = np.uint64((walk * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        at += (mixed(here ^ salt) & np.uint64(1)).astype(np.int64)
    return out


def samples(length: int, settings: Settings) -> list[tuple[int, np.ndarray]]:
    """For windows of ``length`` words: the walk and the sampled places of each table."""
    draw = np.random.Generator(np.random.PCG64(length))
    found = []
    for walk in range(settings.walks):
        for _ in range(settings.tables):
            found.append((walk, np.sort(draw.choice(np.arange(1, 2 * length), settings.places, replace=False))))
    return found


def signature(embedded: np.ndarray, places: np.ndarray) -> np.ndarray:
    total = embedded[:, 0]
    for place in places:
        total = mixed(total * _GOLDEN + embedded[:, place])
    return total


def infix_distance(item: list[int], words: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to any run of ``words``, and that run's end (bit-parallel)."""
    masks: dict[int, int] = {}
    for i, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << i
    top, every = 1 << len(item) - 1, (1 << len(item)) - 1
    plus, minus, score = every, 0, len(item)
    best, end = score, 0
    for j, word in enumerate(words):
        equal = masks.get(word, 0)
        vertical = equal | minus
        diagonal = (((equal & plus) + plus) ^ plus) | equal
        up = (minus | ~(diagonal | plus)) & every
        down = plus & diagonal
        score += bool(up & top) - bool(down & top)
        up, down = up << 1 & every, down << 1 & every
        plus = (down | ~(vertical | up)) & every
        minus = up & vertical
        if score < best:
            best, end = score, j + 1
    return best, end


class Index:
    """Tables of some items' windows."""

    def __init__(self, items: list[tuple[int, np.ndarray, list[int]]], settings: Settings):
        self.settings = settings
        self.items = [(i, words.tolist()) for i, words, _ in items]
        by_length: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for k, (_, words, lengths) in enumerate(items):
            for start in self.starts(lengths):
                tail = words[start:]
                length = self.window(len(tail))
                by_length.setdefault(length, []).append((k, start, tail[:length]))
        #: First words, and for each window length: tables of signature -> [(item, start)].
        self.lengths = {}
        for length, found in sorted(by_length.items()):
            windows = np.stack([x for _, _, x in found])
            embedded = {w: cgk(windows, w) for w in range(settings.walks)}
            tables = []
            for walk, places in samples(length, settings):
                table: dict[int, list[tuple[int, int]]] = {}
                for (k, start, _), sign in zip(found, signature(embedded[walk], places).tolist()):
                    table.setdefault(sign, []).append((k, start))
                tables.append((walk, places, np.array(sorted(table), np.uint64), table))
            self.lengths[length] = (np.unique(windows[:, 0]), tables)

    def starts(self, lengths: list[int]) -> list[int]:
        """The longest words of the first three quarters, which few texts have: windows of a copy start at
        the same words."""
        last = max(1, min(len(lengths) * 3 // 4, len(lengths) - 3))
        return sorted(sorted(range(last), key=lambda i: (-lengths[i], i))[: self.settings.starts])

    @staticmethod
    def window(length: int) -> int:
        """Lengths in steps of a third, so that there are few."""
        size = 3
        while size + max(1, size // 3) <= length:
            size += max(1, size // 3)
        return min(size, length)

    def classes(self, distinct: np.ndarray) -> np.ndarray:
        """For each of the words a bit for each window length that some window of it begins with."""
        found = np.zeros(len(distinct), np.uint64)
        for bit, (firsts, _) in enumerate(self.lengths.values()):
            found |= np.isin(distinct, firsts).astype(np.uint64) << np.uint64(bit)
        return found

    def search(self, words: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """Verified passages in texts ``words[bounds[i]:bounds[i + 1]]``: text, item, first word, word
        after the last, edits. ``classes`` are those of ``words``."""
        candidates: set[tuple[int, int, int]] = set()
        begun = np.flatnonzero(classes)
        for bit, (length, (_, tables)) in enumerate(self.lengths.items()):
            at = begun[(classes[begun] >> np.uint64(bit) & np.uint64(1)).astype(bool)]
            ends = bounds[np.searchsorted(bounds, at, "right")]
            for part in range(0, len(at), 8192):
                rows = at[part : part + 8192]
                place = rows[:, None] + np.arange(length)
                inside = place < ends[part : part + 8192, None]
                windows = np.where(inside, words[np.where(inside, place, 0)], np.uint64(0))
                embedded = {}
                for walk, places, known, table in tables:
                    if walk not in embedded:
                        embedded[walk] = cgk(windows, walk)
                    signs = signature(embedded[walk], places)
                    same = known[np.minimum(np.searchsorted(known, signs), len(known) - 1)] == signs
                    for row, sign in zip(rows[same].tolist(), signs[same].tolist()):
                        candidates.update((k, row, start) for k, start in table[sign])
        found: dict[tuple[int, int, int], tuple[int, int, int, int, int]] = {}
        checked: set[tuple[int, int, int]] = set()
        for k, row, start in sorted(candidates):
            text = int(np.searchsorted(bounds, row, "right")) - 1
            first, last = int(bounds[text]), int(bounds[text + 1])
            item = self.items[k][1]
            begin, allowed = row - start, int(self.settings.edits * len(item))
            if (k, text, begin) in checked:
                continue
            checked.add((k, text, begin))
            low, high = max(first, begin - allowed), min(last, begin + len(item) + allowed)
            near = words[low:high].tolist()
            edits, end = infix_distance(item, near)
            if edits > allowed:
                continue
            length = infix_distance(item[::-1], near[:end][::-1])[1]
            hit = (text, self.items[k][0], low + end - length - first, low + end - first, edits)
            key = (text, hit[1], hit[3])
            found[key] = min(found.get(key, hit), hit, key=lambda x: (x[4], x[2]))
        return sorted(found.values(), key=lambda x: (x[0], x[2], x[1], x[3]))


def item_words(text: str) -> tuple[np.ndarray, list[int]]:
    """Hashes and lengths of an item's words."""
    split = split_words(pa.array([text]))
    words = [word for i in split.ids.tolist() if (word := normal_word(split.distinct[i]))]
    return word_hashes(words), list(map(len, words))


def item_blocks(benchmark: DataFrame, settings: Settings):
    """Broadcast items of one block after another, each within ``ITEMS`` and ``ITEM_CHARS``."""
    items = benchmark.select(F.col("item_id").cast("long"), "text").where("item_id is not null and text is not null")
    n, chars = items.agg(F.count("*"), F.sum(F.length("text"))).first()
    blocks = max(1, -(-n // ITEMS), -(-(chars or 0) // ITEM_CHARS))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text")
        words = [(row.item_id, *item_words(row.text)) for row in own.collect()]
        words = [x for x in words if len(x[1]) >= settings.least_words]
        yield benchmark.sparkSession.sparkContext.broadcast(words), f"index {uuid.uuid4().hex}"


def index_of(key: str, given, settings: Settings) -> Index:
    """The worker's index of a block of items; it holds one."""
    state = worker_state("decontamination")
    if state.get("key") != key:
        state["key"], state["index"] = key, Index(given.value, settings)
    return state["index"]


def hits_of(texts: pa.Array, index: Index) -> list[tuple[int, int, int, int, int]]:
    split = split_words(texts)
    if not len(split.ids):
        return []
    hashes = word_hashes(split.distinct)
    split.keep(hashes != 0)
    return index.search(hashes[split.ids], split.bounds, index.classes(hashes)[split.ids])


def passages(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, item_id, first_word, end_word, edits, item_words``: every passage of ``documents`` within
    the allowed edits of an item that the tables find. The items are taken in blocks of bounded size, each
    in a pass over all documents. Empty texts, null texts and null items have no passage."""
    names = ["doc_id", "item_id", "first_word", "end_word", "edits", "item_words"]
    found = None
    for given, key in item_blocks(benchmark, settings):

        def search(batches, given=given, key=key):
            index = index_of(key, given, settings)
            sizes = {i: len(w) for i, w in index.items}
            for part in text_slices(batches):
                ids = part.column("doc_id")
                rows = [(ids[x[0]].as_py(), *x[1:], sizes[x[1]]) for x in hits_of(part.column("text"), index)]
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], pa.int64()) for i in range(6)], names)

        hits = documents.select("doc_id", "text").mapInArrow(search, ", ".join(f"{x} long" for x in names))
        found = hits if found is None else found.unionByName(hits)
    return found


def contaminated(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each document with a passage: ``doc_id``, ``items`` (distinct, ascending),
    ``n_passages`` and the least ``edits``."""
    return (
        passages(documents, benchmark, settings)
        .groupBy("doc_id")
        .agg(
            F.sort_array(F.collect_set("item_id")).alias("items"),
            F.count("*").alias("n_passages"),
            F.min("edits").alias("edits"),
        )
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows whose ``text`` has no passage of any item, all columns as they are; without a shuffle."""
    for given, key in item_blocks(benchmark, settings):

        def clean(batches, given=given, key=key):
            index = index_of(key, given, settings)
            for part in text_slices(batches):
                keep = np.ones(part.num_rows, bool)
                keep[[x[0] for x in hits_of(part.column("text"), index)]] = False
                yield part.filter(pa.array(keep))

        documents = documents.mapInArrow(clean, documents.schema)
    return documents
