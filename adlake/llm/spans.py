"""Positions of regular-expression matches, and running sums and maxima of arrays, as SQL expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int,size:int>>"
#: Elements that one fold goes over; above, blocks of so many are folded alone and then moved by what stands before them.
FOLD, LEVELS = 64, 2


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """*f* of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def once(value: Column) -> Column:
    """*value* behind a generator: later filters and columns take its result and never repeat its work."""
    return F.explode(F.array(value))


def running(values: Column, merge: Callable[[Column, Column], Column], levels: int = LEVELS) -> Column:
    """The merged value of each place and all before it, for an array of ints and an associative *merge*.

    A fold that grows an array copies it at each step, so it takes at most FOLD elements; the work is FOLD for each element.
    """
    empty = F.array().cast("array<int>")

    def fold(block: Column) -> Column:
        first = lambda acc, x: F.concat(acc, F.array(F.when(F.size(acc) == 0, x).otherwise(merge(F.try_element_at(acc, F.lit(-1)), x))))
        return F.aggregate(block, empty, first)

    if not levels:
        return fold(values)

    def dealt(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / FOLD).cast("int")), lambda b: fold(F.slice(v, b * FOLD + 1, F.lit(FOLD))))
        return let(blocks, lambda r: let(running(F.transform(r, lambda x: F.element_at(x, -1)), merge, levels - 1), lambda before: joined(r, before)))

    def joined(r: Column, before: Column) -> Column:
        moved = F.transform(r, lambda x, k: F.when(k == 0, x).otherwise(F.transform(x, lambda y: merge(F.get(before, k - 1), y))))
        return F.flatten(moved)

    return let(values, lambda v: F.when(F.size(v) <= FOLD, fold(v)).otherwise(dealt(v)))


def spans(searches: Sequence[tuple[Column, str, int]]) -> Column:
    """For each (text, pattern, group): the leftmost non-overlapping matches as array of (start, end, size), code points, end exclusive; size is the length of the group.

    Splitting at the matches gives the pieces between them, so positions are running sums of lengths.  A null text has no
    matches.  All searches share one expression for the sums, as its size counts in planning.
    """
    length = lambda x: F.length(x)

    def found(text: Column, pattern: str, group: int) -> Column:
        matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        # a group of a match is found in the match alone
        size = (lambda x: F.length(F.regexp_extract(x, pattern, group))) if group else length
        fields = (F.transform(F.split(text, pattern, -1), length).alias("gaps"), F.transform(matches, length).alias("lengths"), F.transform(matches, size).alias("sizes"))
        return F.when(text.rlike(pattern), F.struct(*fields))

    def placed(m: Column) -> Column:
        ends = running(F.zip_with(F.slice(m["gaps"], 1, F.size(m["lengths"])), m["lengths"], lambda g, n: g + n), lambda a, b: a + b)
        rows = F.arrays_zip(ends.alias("end"), m["lengths"].alias("length"), m["sizes"].alias("size"))
        return F.transform(rows, lambda x: F.struct((x["end"] - x["length"]).alias("start"), x["end"].alias("end"), x["size"].alias("size")))

    return F.transform(F.array(*[found(*s) for s in searches]), lambda m: F.when(m.isNotNull(), placed(m)).otherwise(F.array().cast(SPAN)))
