"""Token ids in files: frequency-ranked ids in byte-aligned codes of one to four bytes.

A file set is a folder with two Parquet tables. ``ranks`` has the token id of each rank, the most
frequent id first. ``blocks`` has a row for each run of documents: their ids and token counts, the
control bytes (two bits a token: bytes of its code less one, four tokens a byte, lowest bits first)
and the code bytes (little-endian ranks without leading zero bytes). Blocks are ordered by ``file``
and ``block``; tokens run on from one to the next.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import gather, per_text, shared_folder, split_words, stored, text_slices, worker_state

CACHE_SIZE = 1_000_000
BLOCKS = (
    "file int, block int, first_token long, doc_ids array<bigint>, n_tokens array<bigint>, control binary, codes binary"
)
#: Code lengths of the four tokens of each control byte.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.int64) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and code bytes."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    fours = np.zeros((-(-len(ranks) // 4), 4), np.uint8)
    fours.reshape(-1)[: len(ranks)] = extra
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    used = np.arange(4) <= extra[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, codes: bytes, count: int) -> np.ndarray:
    """The ranks again: code lengths by table lookup, places by their running sum."""
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:count]
    starts = np.cumsum(lengths) - lengths
    data = np.frombuffer(codes + b"\0\0\0", np.uint8)
    ranks = data[starts].astype(np.uint32)
    for byte in (1, 2, 3):
        longer = np.flatnonzero(lengths > byte)
        ranks[longer] |= data[starts[longer] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


#: Lower-case letters, and signs after them that are tokens of their own (no apostrophe: it may begin one
#: with letters).
PLAIN_WORD = re.compile(r"([a-z]+)([!-&(-/:-@\[-`{-~]*)")


def letters_alone(path: str) -> bool:
    """Whether the tokenizer lowers A-Z first and makes every run of letters a token source of its own, so that
    its model alone encodes plain words."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    kinds = {
        key: [step["type"] for step in (parts[key] or {}).get(steps, [parts[key]]) if step]
        for key, steps in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))
    }
    if "Lowercase" not in kinds["normalizer"] or not {"NFC", "Replace", "Lowercase"}.issuperset(kinds["normalizer"]):
        return False
    if kinds["pre_tokenizer"] != ["Split", "ByteLevel"]:
        return False
    pattern = parts["pre_tokenizer"]["pretokenizers"][0]["pattern"].get("Regex", "")
    return "[\\p{L}]+" in pattern.split("|") and "[^\\s\\p{L}\\p{N}]+" in pattern.split("|")


class Encoder:
    """Encodes texts word by word: white space ends every token, so words can be encoded alone. The ids
    of each word are kept from task to task in ``flat[starts[i]:starts[i] + lengths[i]]``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.lower = self.tokenizer.model, letters_alone(path)
        self.signs: dict[str, list[int]] = {"": []}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def words(self, distinct: list[str]) -> np.ndarray:
        """Index of each word in ``starts`` and ``lengths``."""
        if len(self.known) > CACHE_SIZE:
            self.clear()
        found = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            missing = [distinct[i] for i in unknown.tolist()]
            ids = self.ids_of(missing)
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            starts = len(self.flat) + np.cumsum(lengths) - lengths
            found[unknown] = np.arange(len(self.starts), len(self.starts) + len(missing))
            self.known.update(zip(missing, found[unknown].tolist()))
            inner = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
            self.flat = np.concatenate([self.flat, inner])
            self.starts, self.lengths = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths])
        return found

    def ids_of(self, words: list[str]) -> list[list[int]]:
        """The ids of each word. Plain ones need neither normalizer nor pattern, which take most of the time."""
        found = [PLAIN_WORD.fullmatch(word) if self.lower else None for word in words]
        if len(self.signs) > CACHE_SIZE:
            self.signs = {"": []}
        odd = [word for word, plain in zip(words, found) if plain is None]
        new = list({plain[2] for plain in found if plain is not None} - self.signs.keys())
        ids = [x.ids for x in self.tokenizer.encode_batch_fast(odd + new, add_special_tokens=False)]
        self.signs.update(zip(new, ids[len(odd) :]))
        others, tokenize = iter(ids), self.model.tokenize
        result = [
            next(others) if plain is None else [token.id for token in tokenize(plain[1])] + self.signs[plain[2]]
            for plain in found
        ]
        return result

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with ``end_id`` after it, and their numbers."""
        split = split_words(texts, lower=self.lower)
        index = self.words(split.distinct)[split.ids] if len(split.ids) else np.zeros(0, np.int64)
        counts = per_text(self.lengths[index], split.bounds)
        inner = gather(self.flat, self.starts[index], self.lengths[index])
        return np.insert(inner, np.cumsum(counts), np.uint32(end_id)), counts + 1


def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    state = worker_state("token files")
    if path not in state:
        state[path] = Encoder(path)
    return state[path]


def encoded(documents: DataFrame, path: str, size: int, end_id: int, order: list[Column]) -> DataFrame:
    """``doc_id``, the keys of ``order`` and the ids of every row, as short as the vocabulary allows."""
    kind = short(size)

    def encode(batches):
        own = encoder(path)
        for part in text_slices(batches):
            ids, counts = own.encode(part.column("text"), end_id)
            ends = np.concatenate(([0], np.cumsum(counts))) * np.dtype(kind).itemsize
            offsets = pa.py_buffer(ends.astype(np.int32))
            binary = pa.Array.from_buffers(pa.binary(), len(counts), [None, offsets, pa.py_buffer(ids.astype(kind))])
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], binary], [*part.schema.names[:-1], "ids"])

    keys = [key.alias(f"__key{i}") for i, key in enumerate(order)]
    given = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *keys, "text")
    return given.mapInArrow(encode, given.drop("text").schema.add("ids", "binary"))


def short(size: int) -> str:
    return "<u2" if size <= 1 << 16 else "<u4"


def id_counts(coded: DataFrame, size: int) -> DataFrame:
    """How often each token id stands in all rows of ``ids``."""

    def count(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column(0).to_pylist()), short(size))
            total += np.bincount(ids, minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return coded.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


@dataclass
class TokenFiles:
    folder: str
    tokenizer: str

    def blocks(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(BLOCKS).parquet(f"{self.folder}/blocks")

    def ranks(self, spark: SparkSession) -> np.ndarray:
        """Token id of each rank; as many as the vocabulary has."""
        rows = spark.read.schema("rank int, id int").parquet(f"{self.folder}/ranks").collect()
        ids = np.zeros(len(rows), np.uint32)
        for row in rows:
            ids[row["rank"]] = row["id"]
        return ids


def write_token_files(
    documents: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 2,
    order: list[Column] | None = None,
    block_tokens: int = 1 << 18,
) -> TokenFiles:
    """Encodes ``text`` of every row, ``end_id`` after each, and writes a file set in shared storage.

    Rows stand in ``order``, else by ``doc_id`` (nulls first; equal ones by their ids). The vocabulary's
    frequencies are counted over all rows. A null or empty text is its end id alone.
    """
    from tokenizers import Tokenizer

    spark = documents.sparkSession
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    folder = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    size = max(Tokenizer.from_file(path).get_vocab_size(), end_id + 1)
    order = order or [F.col("doc_id")]
    coded = stored(encoded(documents, path, size, end_id, order), "encoded", "zstd")
    counted = {row.id: row.n for row in id_counts(coded, size).collect()}
    by_rank = sorted(range(size), key=lambda i: (-counted.get(i, 0), i))
    spark.createDataFrame(list(enumerate(by_rank)), "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.empty(size, np.uint32)
    rank_of[by_rank] = np.arange(size, dtype=np.uint32)
    ranks = spark.sparkContext.broadcast(rank_of)

    def write(batches):
        file, first, block = TaskContext.get().partitionId(), 0, 0
        for doc_ids, lists in blocks_of(batches, block_tokens):
            joined = np.frombuffer(b"".join(lists), short(size))
            counts = [len(x) // joined.itemsize for x in lists]
            values = [file, block, first, doc_ids, counts, *encode_ranks(ranks.value[joined])]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)
            first, block = first + len(joined), block + 1

    def blocks_of(batches, tokens):
        doc_ids, lists, held = [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and held + len(ids) > 2 * tokens:
                    yield doc_ids, lists
                    doc_ids, lists, held = [], [], 0
                doc_ids.append(doc_id)
                lists.append(ids)
                held += len(ids)
        if lists:
            yield doc_ids, lists

    longs = pa.list_(pa.int64())
    types = [pa.int32(), pa.int32(), pa.int64(), longs, longs, pa.binary(), pa.binary()]
    names = ["file", "block", "first_token", "doc_ids", "n_tokens", "control", "codes"]
    by = [f"__key{i}" for i in range(len(order))]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        coded.repartitionByRange(parts, *by, F.xxhash64("ids"))
        .sortWithinPartitions(*by, F.xxhash64("ids"), "ids")
        .select("doc_id", "ids")
        .mapInArrow(write, BLOCKS)
        .write.option("compression", "uncompressed")
        .parquet(f"{folder}/blocks")
    )
    return TokenFiles(folder, path)


def read_token_files(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """One row per document, decoded from the files: ``doc_id``, ``start`` (ids of all documents before
    it), ``n_tokens``, ``ids_crc32`` (of all ids as little-endian unsigned 32-bit integers), ``ids``."""
    return _decoded(spark, files, True)


def token_digests(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """As ``read_token_files``, without the ids themselves."""
    return _decoded(spark, files, False)


def _decoded(spark: SparkSession, files: TokenFiles, with_ids: bool) -> DataFrame:
    by_rank = spark.sparkContext.broadcast(files.ranks(spark))

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.array(row["n_tokens"], np.int64)
                bounds = np.concatenate(([0], np.cumsum(counts)))
                ids = by_rank.value[decode_ranks(row["control"], row["codes"], int(bounds[-1]))].astype("<u4")
                raw = ids.tobytes()
                crc = [zlib.crc32(memoryview(raw)[4 * a : 4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(np.full(len(counts), row["file"], np.int32)),
                    pa.array(bounds[:-1] + row["first_token"]),
                    pa.array(counts),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "file", "__first", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = "doc_id long, file int, __first long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    blocks = files.blocks(spark)
    # One row a file: the running sum over files is small, whatever the number of documents.
    before = (
        blocks.select("file", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
        .groupBy("file")
        .agg(F.sum("n").alias("n"))
        .select("file", (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("__before"))
    )
    return (
        blocks.drop("block")
        .mapInArrow(decode, schema)
        .join(before, "file")
        .select(
            "doc_id",
            (F.col("__before") + F.col("__first")).alias("start"),
            "n_tokens",
            "ids_crc32",
            *["ids"] * with_ids,
        )
    )
