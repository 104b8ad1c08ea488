import struct

import pytest

from logquarry.functions import values as v


def read(kind, data, size=None, limit=None):
    return v.read_value(data, 0, kind, size, len(data) if limit is None else limit)


def text(s):
    return s.encode("utf-16-le")


@pytest.mark.parametrize(
    "number, shown",
    [
        (struct.unpack("<f", struct.pack("<f", 0.1))[0], "0.10000000149011612"),
        (1e21, "1000000000000000000000"),
        (1e-7, "0.0000001"),
        (3.0, "3"),
        (-0.0, "-0"),
        (2.5, "2.5"),
        (float("nan"), "NaN"),
        (float("inf"), "inf"),
        (float("-inf"), "-inf"),
    ],
)
def test_floats_show_shortest_digits_without_exponent(number, shown):
    assert v.float_text(number) == shown


@pytest.mark.parametrize(
    "kind, data, size, shown",
    [
        (v.WSTRING, text("hi"), 4, "hi"),
        (v.WSTRING, b"\x02\x00" + text("hi"), None, "hi"),
        (v.WSTRING, b"", 0, ""),
        (v.STRING, b"ab\xff", 3, "ab�"),
        (v.STRING, b"\x02\x00ab", None, "ab"),
        (v.INT8, b"\xff", 1, "-1"),
        (v.UINT8, b"\xff", 1, "255"),
        (v.INT16, b"\xfe\xff", 2, "-2"),
        (v.UINT32, struct.pack("<I", 0xDEADBEEF), 4, "3735928559"),
        (v.INT64, struct.pack("<q", -5), None, "-5"),
        (v.UINT64, b"\xff" * 8, 8, "18446744073709551615"),
        (v.BOOL, struct.pack("<I", 7), 4, "true"),
        (v.BOOL, bytes(4), 4, "false"),
        (v.BINARY, b"\x00\xab", 2, "0x00ab"),
        (v.BINARY, struct.pack("<I", 2) + b"\x00\xab", None, "0x00ab"),
        (v.GUID, bytes.fromhex("33221100554477668899aabbccddeeff"), 16, "{00112233-4455-6677-8899-aabbccddeeff}"),
        (v.SIZE, struct.pack("<I", 9), 4, "9"),
        (v.SIZE, struct.pack("<Q", 9), 8, "9"),
        (v.FILETIME, struct.pack("<Q", 133514430235959706), 8, "2024-02-03T14:10:23.5959706Z"),
        (v.SYSTIME, struct.pack("<8H", 2024, 2, 6, 3, 14, 10, 23, 595), 16, "2024-02-03T14:10:23.5950000Z"),
        (v.SID, bytes.fromhex("010100000000000513000000"), 12, "S-1-5-19"),
        (v.SID, bytes.fromhex("010100000000000513000000"), None, "S-1-5-19"),
        (v.SID, b"\x01\x05\x00", 3, "0x010500"),
        (v.HEX32, struct.pack("<I", 255), 4, "0x000000ff"),
        (v.HEX64, struct.pack("<Q", 255), 8, "0x00000000000000ff"),
        (v.UINT32 | v.ARRAY_FLAG, struct.pack("<3I", 1, 2, 3), 12, "1,2,3"),
        (v.WSTRING | v.ARRAY_FLAG, text("ab\0cd\0"), 12, "ab,cd"),
        (v.STRING | v.ARRAY_FLAG, b"ab\0\0cd\0", 7, "ab,,cd"),
        (v.WSTRING | v.ARRAY_FLAG, b"", 0, ""),
    ],
)
def test_display_text(kind, data, size, shown):
    value, after = read(kind, data, size)
    assert value == shown
    assert after == len(data)


def test_null_takes_its_declared_bytes_only():
    assert read(v.NULL, bytes(20), 16) == (None, 16)
    assert read(v.NULL, bytes(4)) == (None, 0)


def test_a_declared_size_says_where_the_next_value_starts():
    assert read(v.UINT8, b"\x07\0\0\0", 4) == ("7", 4)


def test_a_nested_fragment_is_a_span():
    assert read(v.BINXML, bytes(8), 8) == ((0, 8), 8)
    assert read(v.BINXML, b"\x02\x00ab") == ((2, 4), 4)


@pytest.mark.parametrize(
    "kind, data, size",
    [
        (0x7E, bytes(8), 1),
        (v.WSTRING, bytes(3), 3),
        (v.UINT32, bytes(3), None),
        (v.WSTRING, b"\x09\x00ab", None),
        (v.UINT32 | v.ARRAY_FLAG, bytes(8), None),
        (v.NULL | v.ARRAY_FLAG, bytes(4), 4),
        (v.SYSTIME, struct.pack("<8H", 2024, 13, 0, 1, 0, 0, 0, 0), 16),
        (v.BINARY, bytes(2), 5),
    ],
)
def test_what_is_no_value_is_an_error(kind, data, size):
    with pytest.raises(v.BadRecord):
        read(kind, data, size)
