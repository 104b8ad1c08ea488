"""Small logs built by hand."""

from __future__ import annotations

from logquarry.testing.writer import ChunkWriter, El, evtx_file, text

FILETIME = 133_514_430_235_959_706
LOGS = "/C/Windows/System32/winevt/Logs"


def event(channel: str, *more: El, code: str = "7", level: str = "4") -> El:
    return El(
        "Event",
        El(
            "System",
            El("Provider", Name=text("P")),
            El("EventID", text(code)),
            El("Channel", text(channel)),
            El("Computer", text("HOST")),
            El("Level", text(level)),
        ),
        *more,
    )


def chunk_of(*records, first_id: int = 1, bad_checksum: bool = False) -> bytes:
    """A chunk with one record per element or per function that writes the record's content."""
    writer = ChunkWriter()
    for number, record in enumerate(records):
        write = record if callable(record) else (lambda w, root=record: w.fragment(root))
        writer.record(first_id + number, FILETIME, write)
    return writer.finish(bad_checksum=bad_checksum)


def log_of(*records, **options) -> bytes:
    return evtx_file([chunk_of(*records, **options)], len(records) + 1)


def raw(data: bytes):
    """Record content given as token bytes."""

    def write(writer: ChunkWriter):
        writer.buf += data

    return write


UNDECODABLE = raw(b"\x0f\x01\x01\x00\x04\x00")


def decode(chunk: bytes):
    """[(record id, error, nodes)] of one chunk, without Spark."""
    from logquarry.functions.binxml import ChunkDecoder, frame_records

    nodes: list = []
    decoder, found = ChunkDecoder(chunk, nodes), []
    for record_id, _, start, end in frame_records(chunk):
        first = len(nodes)
        error = decoder.decode(start, end)
        found.append((record_id, error, nodes[first:]))
    return found


def files(spark, contents: dict[str, bytes]):
    rows = [(path, len(data), bytearray(data)) for path, data in contents.items()]
    return spark.createDataFrame(rows, "path string, length bigint, content binary")
