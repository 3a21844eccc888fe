"""Sparse maps, dense arrays and MinHash signatures."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

PERMUTATIONS, BANDS, ROWS = 64, 16, 4
EMPTY_HASH = 2**32 - 1


def _dot(left: Column, right: Column) -> Column:
    pairs = F.map_zip_with(left, right, lambda _, a, b: F.coalesce(a.cast("double"), F.lit(0.0)) * F.coalesce(b.cast("double"), F.lit(0.0)))
    return F.aggregate(F.map_values(pairs), F.lit(0.0), lambda total, x: total + x)


def _norm(values: Column) -> Column:
    return F.sqrt(F.aggregate(F.map_values(values), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def map_cosine(left: Column, right: Column) -> Column:
    """Cosine of two count maps; 1 if both are empty, 0 if one is."""
    empty = (F.size(left) == 0, F.size(right) == 0)
    return (
        F.when(empty[0] & empty[1], 1.0)
        .when(empty[0] | empty[1], 0.0)
        .otherwise(_dot(left, right) / (_norm(left) * _norm(right)))
    )


def map_difference(left: Column, right: Column) -> Column:
    """What the left count map has beyond the right one, as a multiset."""
    rest = F.map_zip_with(left, right, lambda _, a, b: F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))
    return F.map_filter(rest, lambda _, n: n > 0)


def dot(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda total, x: total + x)


def unit(values: Column) -> Column:
    """The array scaled to length 1; an array of zeros stays."""
    length = F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))
    return F.when(length > 0, F.transform(values, lambda x: x.cast("double") / length)).otherwise(F.transform(values, lambda x: x.cast("double")))


def minhash(keys: Column, permutations: int = PERMUTATIONS) -> Column:
    """Least of the first 32 bits of sha256('<i>:<key>') over the keys, for each i; all ones if there are none."""

    def least(i: Column) -> Column:
        hashes = F.transform(keys, lambda k: F.conv(F.substring(F.sha2(F.concat(i.cast("string"), F.lit(":"), k).cast("binary"), 256), 1, 8), 16, 10).cast("long"))
        return F.coalesce(F.array_min(hashes), F.lit(EMPTY_HASH).cast("long"))

    return F.transform(F.sequence(F.lit(0), F.lit(permutations - 1)), least)


#: Keys that are hashed at once: fewer cost calls, more leave the processor's cache.
LANES = 32_768


def _cube_root(n: int) -> int:
    low, high = 0, 1 << 40
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= n else (low, middle - 1)
    return low


# sha256's constants: the first 32 bits of the fractions of the roots of primes.
_PRIMES = [p for p in range(2, 312) if all(p % q for q in range(2, p))]
_START = [math.isqrt(p << 64) & 0xFFFFFFFF for p in _PRIMES[:8]]
_ROUND = [_cube_root(p << 96) & 0xFFFFFFFF for p in _PRIMES]
_HEX = np.array([int.from_bytes(b"%04x" % i) for i in range(1 << 16)], np.uint32)
_WORD = [np.array(i, np.uint32) for i in range(33)]


def _turned(x, out, other, turns: tuple[int, int, int], whole: bool):
    """xor of x turned right by each number of bits; the last is a shift if not `whole`."""
    left, right = np.left_shift, np.right_shift
    one, two, three = turns
    right(x, _WORD[one], out)
    for shift, by in ((left, 32 - one), (right, two), (left, 32 - two), (right, three), *([(left, 32 - three)] if whole else [])):
        np.bitwise_xor(out, shift(x, _WORD[by], other), out)
    return out


def _turned_word(x: int, turns: tuple[int, int, int]) -> int:
    once = np.array([x], np.uint32)
    return int(_turned(once, np.empty_like(once), np.empty_like(once), turns, False)[0])


def hash_words(keys: np.ndarray, prefixes: list[bytes]):
    """For each prefix the first 32 bits of sha256(prefix + key as 8 hex digits), of all keys (uint32) at once.

    One message is one block of sha256, so its rounds run on whole arrays; a hash by hashlib takes twice as long, most of it
    for the call. Words of the message that are the same for all keys stay numbers.
    """
    lanes = min(LANES, len(keys))
    rows = np.empty((28, lanes), np.uint32)
    for prefix in prefixes:
        out = np.empty(len(keys), np.uint32)
        for first in range(0, len(keys), LANES):
            part = keys[first : first + LANES]
            out[first : first + LANES] = _hash_words(part, prefix, rows[:, : len(part)])
        yield out


def _message(keys: np.ndarray, prefix: bytes) -> list:
    """The 16 words of the block: numbers, or arrays where the key shows."""
    high, low = _HEX[keys >> _WORD[16]], _HEX[keys & np.uint32(0xFFFF)]
    whole, rest = divmod(len(prefix), 4)
    words: list = [int.from_bytes(prefix[at : at + 4].ljust(4, b"\0")) for at in range(0, 4 * whole + 4, 4)] + [0] * (15 - whole)
    right, left = _WORD[8 * rest], _WORD[32 - 8 * rest]
    if rest:
        words[whole] = high >> right | np.uint32(words[whole])
        words[whole + 1] = high << left | low >> right
        words[whole + 2] = low << left | np.uint32(0x80 << 24 - 8 * rest)
    else:
        words[whole : whole + 3] = high, low, 0x80 << 24
    words[15] = 8 * (len(prefix) + 8)
    return words


def _hash_words(keys: np.ndarray, prefix: bytes, rows: np.ndarray) -> np.ndarray:
    add, xor, both = np.add, np.bitwise_xor, np.bitwise_and
    a, b, c, d, e, f, g, h = state = list(rows[:8])
    kept, (t, u, v, last) = rows[8:24], rows[24:]
    for row, start in zip(state, _START, strict=True):
        row.fill(start)
    xor(b, c, last)
    words = _message(keys, prefix)
    for at in range(64):
        if at >= 16:
            own, number, parts = kept[at % 16], 0, []
            for word in (words[at % 16], words[(at - 7) % 16]):
                number, parts = (number + word, parts) if isinstance(word, int) else (number, [*parts, word])
            for word, turns, into in ((words[(at - 15) % 16], (7, 18, 3), t), (words[(at - 2) % 16], (17, 19, 10), u)):
                if isinstance(word, int):
                    number += _turned_word(word, turns) if word else 0
                else:
                    parts.append(_turned(word, into, v, turns, False))
            number &= 0xFFFFFFFF
            if parts:
                total = parts[0]
                for part in parts[1:]:
                    total = add(total, part, own)
                if number or total is not own:
                    add(total, np.array(number, np.uint32), own)
            words[at % 16] = own if parts else number
        word = words[at % 16]
        if isinstance(word, int):
            add(h, np.array(word + _ROUND[at] & 0xFFFFFFFF, np.uint32), h)
        else:
            add(add(h, word, h), np.array(_ROUND[at], np.uint32), h)
        add(h, _turned(e, t, u, (6, 11, 25), True), h)
        add(h, xor(both(xor(f, g, u), e, u), g, u), h)
        add(d, h, d)
        add(h, _turned(a, t, u, (2, 13, 22), True), h)
        add(h, xor(both(xor(a, b, v), last, last), b, last), h)  # a ^ b of this round is b ^ c of the next
        v, last = last, v
        a, b, c, d, e, f, g, h = h, a, b, c, d, e, f, g
    return a + np.uint32(_START[0])


def estimated_jaccard(left: Column, right: Column) -> Column:
    """Share of equal places of two signatures of one length; null if the lengths differ or are 0."""
    same = F.size(F.filter(F.zip_with(left, right, lambda a, b: a == b), lambda x: x))
    return F.when((F.size(left) == F.size(right)) & (F.size(left) > 0), same / F.size(left))


def band_keys(signature: Column, bands: int = BANDS, rows: int = ROWS) -> Column:
    """The signature's bands as an array of arrays."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda b: F.slice(signature, b * rows + 1, F.lit(rows)))


def k_grams(tokens: Column, k: int = 3, joint: str = "\x1f") -> Column:
    """Map from the first 8 hex digits of each window's sha256 to its count; fewer tokens make one window."""
    starts = F.when(F.size(tokens) >= k, F.sequence(F.lit(1), F.size(tokens) - k + 1)).otherwise(F.array(F.lit(1)))
    windows = F.transform(starts, lambda i: F.substring(F.sha2(F.array_join(F.slice(tokens, i, F.lit(k)), joint).cast("binary"), 256), 1, 8))

    def counted(ordered: Column) -> Column:
        """Each run of the sorted windows ends where the next window differs; one pass over the places."""
        ends = F.filter(F.sequence(F.lit(1), F.size(ordered)), lambda i: (i == F.size(ordered)) | (F.get(ordered, i - 1) != F.get(ordered, i)))
        # bound once as a lambda variable: an inlined expression would run again per element
        return F.transform(F.array(ends), lambda e: F.map_from_arrays(
            F.transform(e, lambda i: F.get(ordered, i - 1)),
            F.transform(e, lambda i, k: i - F.when(k > 0, F.get(e, k - 1)).otherwise(0)),
        ))[0]

    found = F.transform(F.array(F.array_sort(windows)), counted)[0]
    return F.when(F.size(tokens) > 0, found).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>")))


TRIGRAM_DIMENSIONS = 384


def _trigram_vector(text: str | None, places: dict[str, tuple[int, float]]) -> np.ndarray | None:
    padded = (text or "").strip(" ").lower()
    if not padded:
        return None
    out = np.zeros(TRIGRAM_DIMENSIONS)
    for start in range(max(1, len(padded) - 2)):
        gram = padded[start : start + 3]
        if gram not in places:
            if len(places) > 300_000:
                places.clear()
            value = int.from_bytes(hashlib.sha256(gram.encode("utf-8", "replace")).digest())
            places[gram] = value % TRIGRAM_DIMENSIONS, 1.0 if value % 2 == 0 else -1.0
        at, sign = places[gram]
        out[at] += sign
    length = np.sqrt((out * out).sum())
    return out / length if length > 0 else out


@F.pandas_udf(ArrayType(DoubleType()))
def trigram_embedding(texts: pd.Series) -> pd.Series:
    """Unit vector of signed hashed character trigrams of a non-blank text; null for a blank one.

    sha256 of the trigram, as a number, gives the place by its remainder and the sign by its parity.
    One pass over each text, in Arrow batches: no built-in adds to a place of an array.
    """
    places: dict[str, tuple[int, float]] = {}
    return texts.map(lambda t: _trigram_vector(t, places))
