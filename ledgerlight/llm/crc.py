"""CRC-32 of a sequence from the CRC-32s of its parts (arithmetic modulo the CRC's polynomial)."""
from __future__ import annotations

_POLY = 0xEDB88320  # fixed value: the reflected polynomial of zlib.crc32


def _times(a: int, b: int) -> int:
    """Product modulo the polynomial; the highest bit is the constant term."""
    out = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            out ^= b
        b = b >> 1 ^ (_POLY if b & 1 else 0)
    return out


def joined_crc(first: int, second: int, second_len: int) -> int:
    """CRC of two byte strings, one after the other."""
    shift, square, n = 1 << 31, 1 << 23, second_len  # x^0, x^8
    while n:
        if n & 1:
            shift = _times(shift, square)
        square = _times(square, square)
        n >>= 1
    return _times(shift, first) ^ second


def crc_of_parts(parts: list[tuple[int, int]]) -> int:
    """``parts``: (crc, length in bytes), in order."""
    out = 0
    for i, (crc, n) in enumerate(parts):
        out = crc if not i else joined_crc(out, crc, n)
    return out
