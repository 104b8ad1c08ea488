"""Token counts by a two-tier lookup of pre-token lengths, without a shuffle of texts or pre-tokens."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import Split, per_text, text_slices, unused, worker_state

#: Entries of the broadcast table, and of the summary each task gives towards it.
TABLE_SIZE = 32_768
SUMMARY_SIZE = 2_048
#: Entries a worker caches beside the table before it starts afresh.
CACHE_SIZE = 1_000_000


def _processor(path: str):
    import sentencepiece

    state = worker_state("token counts")
    if path not in state:
        state[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return state[path]


def _whole(texts: pa.Array) -> np.ndarray:
    """Texts that must be encoded as a whole: blanks stand at an edge, beside another or before a line
    end, or the text has the library's own sign for a blank."""
    return pc.match_substring_regex(texts, "^[ \\n]|  | \\n| $|▁|\\x00").to_numpy(zero_copy_only=False)


def _pre_tokens(texts: pa.Array) -> Split:
    """Pieces between blanks; a line end begins a new piece. No entry of the vocabulary has a blank
    after another character or a line end beside any, so tokens never reach across pieces."""
    return Split(pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " "))


def _lengths(processor, pieces: list[str]) -> list[int]:
    """The library puts a blank before each piece, as before the first piece of a text and where a
    blank was; before a line end it is a token of its own that the text doesn't have."""
    return [len(ids) - piece.startswith("\n") for ids, piece in zip(processor.encode(pieces, num_threads=1), pieces)]


def frequent_lengths(documents: DataFrame, model_path: str, text: str = "text") -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens of all documents, at most ``TABLE_SIZE``.

    Each task counts all pre-tokens it reads and passes on its ``SUMMARY_SIZE`` most frequent; those
    bounded summaries are summed. Ties are broken by the pre-token itself.
    """

    def summaries(batches):
        counts: dict[str, int] = {}
        for part in text_slices(batches):
            texts = part.column("text").fill_null("")
            split = _pre_tokens(texts.filter(pa.array(~_whole(texts))))
            for piece, n in zip(split.distinct, np.bincount(split.ids, minlength=len(split.distinct)).tolist()):
                counts[piece] = counts.get(piece, 0) + n
            if len(counts) > CACHE_SIZE:
                counts = dict(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: CACHE_SIZE // 4])
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:SUMMARY_SIZE]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in best], pa.string()), pa.array([x[1] for x in best], pa.int64())], ["piece", "n"]
        )

    frequent = (
        documents.select(F.col(f"`{text}`").alias("text"))
        .mapInArrow(summaries, "piece string, n long")
        .groupBy("piece")
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "piece")
        .limit(TABLE_SIZE)
    )
    pieces = [row.piece for row in frequent.collect()]
    return dict(zip(pieces, _lengths(_processor(model_path), pieces)))


def count_tokens(
    documents: DataFrame, model_path: str | None = None, limit: int = 4096, text: str = "text"
) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to every document; all else stays but ``text``.

    The table of frequent pre-tokens is broadcast; it is bounded, and only speeds things up. What it
    lacks is encoded by the library and kept in a cache of the worker. Texts with runs of blanks are
    encoded whole. A null or empty text has 0 bytes and 0 tokens; repeated rows are counted each.
    """
    path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    table = documents.sparkSession.sparkContext.broadcast(frequent_lengths(documents, path, text))
    rest = [c for c in documents.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    held = unused("text", rest)

    def count(batches):
        processor, first, second = _processor(path), table.value, worker_state("token counts").setdefault(f"lengths {path}", {})
        for part in text_slices(batches, held):
            texts = part.column(held).fill_null("")
            whole = _whole(texts)
            split = _pre_tokens(pc.if_else(pa.array(whole), "", texts))
            if len(second) > CACHE_SIZE:
                second.clear()
            missing = [x for x in split.distinct if x not in first and x not in second]
            for at in range(0, len(missing), 4096):
                pieces = missing[at : at + 4096]
                second.update(zip(pieces, _lengths(processor, pieces)))
            lengths = np.fromiter(
                (first[x] if x in first else second[x] for x in split.distinct), np.int64, len(split.distinct)
            )
            n = per_text(lengths[split.ids], split.bounds) if len(split.ids) else np.zeros(part.num_rows, np.int64)
            for row in np.flatnonzero(whole):
                n[row] = len(processor.encode(texts[int(row)].as_py()))
            n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
            columns = [part.column(c) for c in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*columns, n_bytes, pa.array(n), pa.array(n > limit)],
                [*part.schema.names[:-1], "n_bytes", "n_tokens", "over_limit"],
            )

    given = documents.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(held))
    schema = given.drop(held).schema.add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")
    return given.mapInArrow(count, schema)
