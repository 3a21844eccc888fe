"""Finding the rows of a wide table whose id is in a set of any size, moving hardly any others.

A filter of 2**24 bits, a table of at most 2**18 words that is built by a map-side combined
aggregation, is broadcast: its size does not depend on the set. Rows that it clears are surely not
in the set and stay where they are; the suspects, members and a share of others that grows with
the set, are shuffled and looked up exactly by whoever asks. The plan is the same at every size: a set far
beyond 2**24 ids fills the filter, and then every row is a suspect and moves once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: 64-bit words of the filter, as a power of two.
WORD_BITS = 18


def free_name(frame: DataFrame, name: str) -> str:
    """`name` behind one underscore more than any column of `frame` begins with."""
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in frame.columns), default=0)) + name


def suspects(frame: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose id may be in the one column of `ids`, rows whose id surely is not).

    Ids are compared as longs; rows with a null id are surely not in the set, null members of it are ignored.
    """
    place = "xxhash64(cast(`{0}` as long))"
    word, bit = f"shiftrightunsigned({place}, {64 - WORD_BITS})", f"shiftleft(1L, cast({place} & 63 as int))"
    member, own, bits = ids.columns[0], free_name(frame, "word"), free_name(frame, "bits")
    words = (
        ids.where(F.col(f"`{member}`").isNotNull())
        .select(F.expr(word.format(member)).alias(own), F.expr(bit.format(member)).alias(bits))
        .groupBy(own)
        .agg(F.bit_or(bits).alias(bits))
    )
    marked = frame.join(F.broadcast(words), F.expr(word.format(column)) == F.col(own), "left")  # 2**WORD_BITS rows at most
    hit = F.coalesce(F.col(f"`{column}`").isNotNull() & F.expr(f"`{bits}` & {bit.format(column)} <> 0"), F.lit(False))
    return tuple(marked.where(test).select(*(f"`{c}`" for c in frame.columns)) for test in (hit, ~hit))
