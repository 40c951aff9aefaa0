"""Words, shingles and small expression helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[^\p{L}\p{N}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words between ASCII white space, unchanged; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; none for null."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), "")


def gram_hashes(w: Column, n: Column, width: int) -> Column:
    """One 64-bit hash per run of ``width`` words, in order; empty below that length.

    The hash of a run is the exclusive or of its words' hashes, each shifted left by its place,
    built up by doubling: three passes over the words serve a run of eight.
    """
    def shifted(a: Column, b: Column, gap: int) -> Column:
        return F.transform(a, lambda x, i: x.bitwiseXOR(F.shiftleft(F.get(b, i + gap), gap)))

    def build(run: Column, size: int, whole: Column | None, done: int) -> Column:
        # run: hashes of ``size`` words; whole: of the ``done`` words gathered so far
        if width & size:
            if whole is None:
                whole, done = run, size
            else:
                return let(shifted(whole, run, done),
                           lambda x: double(run, size, x, done + size))
        return double(run, size, whole, done)

    def double(run: Column, size: int, whole: Column | None, done: int) -> Column:
        if done == width:
            return F.slice(whole, F.lit(1), n - (width - 1))
        return let(shifted(run, run, size), lambda x: build(x, 2 * size, whole, done))

    base = F.transform(w, lambda x: F.xxhash64(x))
    return F.when(n >= width, let(base, lambda h: build(h, 1, None, 0))).otherwise(
        F.array().cast("array<bigint>"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def spare(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not hold."""
    taken = {c.lower() for c in df.columns}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name
