"""A Bloom filter of keys as a Column, to leave out rows before they shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of one word, bits for each key, and the bounds of all bits (1 MB of words at most).
WORD, BITS_PER_KEY, LEAST_BITS, MOST_BITS = 62, 16, 1 << 10, 1 << 23
PROBES = 3


def key_filter(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """``test(column)``: false only if ``column`` equals none of ``keys`` (a
    written table).

    The words of the filter are one aggregate over the keys and one array of
    bounded size, a scalar subquery that each task gets as a constant: testing a
    row needs no join and no shuffle.  Beyond the bound the filter grows no
    more; more rows pass it, none is lost.  NULL equals no key.
    """
    bits = LEAST_BITS
    wanted = keys.count() * BITS_PER_KEY
    while bits < min(wanted, MOST_BITS):
        bits *= 2
    cells = lambda c: [F.pmod(F.xxhash64(F.lit(i), c.cast("string")), F.lit(bits)) for i in range(PROBES)]
    mark = F.expr(f"bit_or(shiftleft(cast(1 as bigint), cast(cell % {WORD} as int)))")
    marked = keys.select(F.explode(F.array(*cells(F.col(key)))).alias("cell")).groupBy(F.expr(f"cell div {WORD}").alias("id")).agg(mark.alias("word"))
    every = keys.sparkSession.range(-(-bits // WORD)).join(marked, "id", "left")
    at = F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))))
    words = every.agg(F.transform(at, lambda x: x["word"]).alias("words")).scalar()

    def test(column: Column) -> Column:
        found = column.isNotNull()
        for cell in cells(column):
            word = F.get(words, F.floor(cell / WORD).cast("int"))
            found = found & (F.getbit(word, (cell % WORD).cast("int")) == 1)
        return F.coalesce(found, F.lit(False))

    return test
