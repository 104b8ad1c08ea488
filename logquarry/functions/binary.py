"""Column expressions for fixed binary layouts. Everything here runs in the JVM.

Inputs named ``data``, ``bits`` and so on are SQL expressions, mostly just a column name.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FILETIME_EPOCH_MICROS = 11_644_473_600_000_000  # 1601-01-01 to 1970-01-01


def _unsigned(data: str, offset: int | str, width: int, kind: str) -> str:
    digits = f"hex(substring({data}, {offset} + 1, {width}))"
    # Byte order is swapped on the hex text: reverse() on BINARY would corrupt the bytes.
    swapped = ", ".join(f"substring({digits}, {2 * i + 1}, 2)" for i in reversed(range(width)))
    return f"cast(conv(concat({swapped}), 16, 10) as {kind})"


def u32_sql(data: str, offset: int | str) -> str:
    return _unsigned(data, offset, 4, "bigint")


def u16(data: str, offset: int | str) -> Column:
    return F.expr(_unsigned(data, offset, 2, "int"))


def u32(data: str, offset: int | str) -> Column:
    return F.expr(u32_sql(data, offset))


def u64(data: str, offset: int | str) -> Column:
    return F.expr(_unsigned(data, offset, 8, "decimal(20,0)"))


def u32_array(data: str, offset: int, count: int) -> Column:
    return F.expr(f"transform(sequence(0, {count - 1}), i -> {u32_sql(data, f'{offset} + 4 * i')})")


def flag(bits: str, mask: int) -> Column:
    return F.expr(f"({bits} & {mask}) != 0")


def hex_encode(data: str, prefix: str = "0x") -> Column:
    """Lower-case hex; modern logs prefix it with ``0x``, legacy logs do not."""
    return F.expr(f"concat('{prefix}', lower(hex({data})))")


def filetime_to_timestamp(ticks: str) -> Column:
    """100 ns ticks since 1601 to TIMESTAMP. Dividing first keeps dates before 1970 right."""
    return F.expr(f"timestamp_micros({ticks} div 10 - {FILETIME_EPOCH_MICROS})")


def timestamp_to_filetime(instant: str) -> Column:
    return F.expr(f"(unix_micros({instant}) + {FILETIME_EPOCH_MICROS}) * 10")


def unix_seconds_to_timestamp(seconds: str) -> Column:
    return F.expr(f"timestamp_seconds({seconds})")
