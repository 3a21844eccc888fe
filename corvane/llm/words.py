"""Word splitting and hashing shared by the text operators.

All functions work on UTF-8 bytes: every delimiter is ASCII, so cutting bytes cuts code points in
the same places, and bytes.translate / bytes.split run in C.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

UPPER = bytes(range(0x41, 0x5B))
LOWER = bytes(range(0x61, 0x7B))
#: Rows of a batch that maps of whole documents hand back at once.
ROWS_OUT = 500
SPACES = b" \t\n\x0b\x0c\r"

#: A-Z to a-z, every ASCII byte but digits and letters to a blank, all else kept.
_ALNUM = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256)
)
_ASCII_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def alnum_words(data: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`."""
    return data.translate(_ALNUM).split()


def blank_words(data: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`."""
    return data.split()


def ascii_lower(data: bytes) -> bytes:
    return data.translate(_ASCII_LOWER)


class WordHash(dict):
    """word -> crc32, remembered; cleared when it has grown beyond `limit` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = self[word] = zlib.crc32(word)
        return value

    def ids(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def pair_hash(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit mix of two hash columns; the high bits are the good ones."""
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(salt)
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)


def spread(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The top `bits` bits, after one multiplication."""
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def binary_column(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The column's values as UTF-8 bytes, nulls as b''."""
    for value in batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()):
        yield value.as_py() or b""
