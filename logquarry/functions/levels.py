"""Level and event id normalisation, and lookups in small fixed tables. Inputs are SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Level names by id, and the two legacy event types with a level of their own.
LEVELS = {1: "Critical", 2: "Error", 3: "Warning", 4: "Information", 5: "Verbose"}
EVT_LEVELS = {1: "Error", 2: "Warning"}
DEFAULT_LEVEL = "Information"


def lookup_sql(key: str, table: dict) -> str:
    """Value of ``key`` in the table, NULL if it has none. The table becomes a constant map."""
    pairs = ", ".join(f"{k!r}, '{v}'" for k, v in table.items())
    return f"map({pairs})[{key}]"


def parse_unsigned_sql(text: str, largest: int) -> str:
    """Text as an unsigned number, white space around it allowed; NULL if it is none."""
    number = rf"try_cast(regexp_extract({text}, r'(?U)^\s*\+?([0-9]+)\s*\z', 1) as bigint)"
    return f"if({number} <= {largest}, {number}, null)"


def level_sql(level: str, fmt: str = "evtx") -> str:
    if fmt == "evtx":
        level, table = f"cast({parse_unsigned_sql(level, 255)} as int)", LEVELS
    else:
        table = EVT_LEVELS
    return f"coalesce({lookup_sql(level, table)}, '{DEFAULT_LEVEL}')"


def normalise_level(level: str, fmt: str = "evtx") -> Column:
    """Level name from the level text of a modern record or the event type of a legacy record."""
    return F.expr(level_sql(level, fmt))


def display_event_id(raw: str) -> Column:
    """The id shown for a legacy record: the low 16 bits, without facility and severity."""
    return F.expr(f"({raw}) & 65535")
