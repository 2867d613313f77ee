"""Pieces of DuckDB SQL that several twins of this subpackage share."""

from __future__ import annotations

_STEP = 0xEDB88320      # fixed value: the reversed polynomial of CRC-32


def _entry(v: int) -> int:
    for _ in range(4):
        v = v >> 1 ^ (_STEP if v & 1 else 0)
    return v


# the remainder of four bits at a time, low half of a byte first
_TABLE = "[" + ", ".join(f"{_entry(v)}::BIGINT" for v in range(16)) + "]"


def crc32(x: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text."""
    nibble = "instr('0123456789ABCDEF', substr(h, {}, 1)) - 1"
    half = "xor(c >> 4, {t}[1 + (xor(c, v) & 15)])".replace("{t}", _TABLE)
    both = (f"list_transform(range(1, length(h) + 1), lambda i: "
            f"CASE WHEN i % 2 = 1 THEN {nibble.format('i + 1')} ELSE {nibble.format('i - 1')} END)")
    return (f"(SELECT xor(list_reduce(list_prepend(4294967295::BIGINT, {both}), lambda c, v: {half}), 4294967295::BIGINT) "
            f"FROM (SELECT hex(encode({x})) AS h))")
