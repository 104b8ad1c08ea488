"""What the operators share: tables, stored intermediates and splitting of whole texts inside tasks."""

from __future__ import annotations

import gc
import sys
import tempfile
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that a task splits at once. A longer text is split alone.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns) -> str:
    """A column name that none of ``columns`` has, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local session may go without: it gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", f"file://{folder}")
    return f"file://{folder}"


def stored(frame: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Writes the rows to shared storage and reads them again: lost executors cost no recomputation."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    frame.write.option("compression", compression).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def worker_state(operator: str) -> dict:
    """What an operator keeps in a Python worker from task to task. It only saves time. Another operator's
    state is dropped, so a worker never holds the caches of two."""
    held = sys.modules.setdefault("llm_worker_state", types.ModuleType("llm_worker_state")).__dict__
    if held.get("operator") != operator:
        held["operator"], held["state"] = operator, {}
        gc.collect()
    return held["state"]


def text_slices(batches, column: str = "text"):
    """Record batches in slices of about ``SLICE_BYTES`` of text. Null texts stay null."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes.tolist()):
            if held and held + size > SLICE_BYTES:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


class Split:
    """Words of a slice of texts: ``ids[bounds[i]:bounds[i + 1]]`` index ``distinct`` for text ``i``."""

    def __init__(self, lists: pa.Array):
        lists = lists.fill_null([]) if lists.null_count else lists
        encoded = lists.flatten().dictionary_encode()
        ids = encoded.indices.to_numpy(zero_copy_only=False)
        self.dictionary: pa.Array = encoded.dictionary
        self.distinct: list[str] = self.dictionary.to_pylist()
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        self.ids, self.bounds = ids, np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))

    def keep(self, wanted: np.ndarray) -> None:
        """Leaves out the words whose entry in ``wanted`` (by index in ``distinct``) is false."""
        if not wanted.all():
            mask = wanted[self.ids]
            self.bounds = np.concatenate(([0], np.cumsum(mask)))[self.bounds]
            self.ids = self.ids[mask]


def split_words(texts: pa.Array, lower: bool = False) -> Split:
    """Words ``[^\\x20\\x09-\\x0D]+``. ``lower`` turns A-Z into a-z. A null text has none."""
    if lower:
        texts = pc.ascii_lower(texts)
    split = Split(pc.ascii_split_whitespace(texts))
    empty = pc.index(split.dictionary, "").as_py()
    if empty >= 0:
        wanted = np.ones(len(split.distinct), bool)
        wanted[empty] = False
        split.keep(wanted)
    return split


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenates ``values[starts[i]:starts[i] + lengths[i]]``."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return values[shift + np.arange(total)]


def per_text(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between ``bounds``; empty texts give 0."""
    return np.diff(np.concatenate(([0], np.cumsum(values, dtype=np.int64)))[bounds])
