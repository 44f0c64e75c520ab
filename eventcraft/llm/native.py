"""Span finding with built-in expressions only, in time proportional to a text and its spans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: values that one inner step of ``running`` adds up
BLOCK = 128
#: code points of a piece of ``chunks``
CHUNK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where lambdas inside ``body`` use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def part(values: Column, first: Column, last: Column) -> Column:
    """The values from place ``first`` to ``last`` (from 0); ``F.slice`` would copy them all first."""
    return F.transform(F.sequence(first, last), lambda i: F.get(values, i))


def running(values: Column, plus: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running sums (by ``plus``, with 0 to start from) of a non-empty array of ints.

    Blocks run on their own and then take over what stands before them, so no step
    copies more than a block or one number a block.
    """
    def start(empty: str) -> Column:
        return F.struct(F.lit(0).alias("at"), F.array().cast(empty).alias("out"))

    def inner(block: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            now = plus(acc["at"], x)
            return F.struct(now.alias("at"), F.concat(acc["out"], F.array(now)).alias("out"))
        return F.aggregate(block, start("array<int>"), step, lambda a: a["out"])

    def carry(blocks: Column) -> Column:
        def step(acc: Column, block: Column) -> Column:
            return F.struct(plus(acc["at"], F.element_at(block, -1)).alias("at"), F.concat(
                acc["out"], F.array(acc["at"])).alias("out"))
        return F.zip_with(blocks, F.aggregate(
            blocks, start("array<int>"), step, lambda a: a["out"]),
            lambda block, at: F.transform(block, lambda x: plus(at, x)))

    return let(values, lambda v: F.flatten(let(F.transform(
        F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")),
        lambda k: inner(part(v, k * BLOCK, F.least(k * BLOCK + BLOCK, F.size(v)) - 1))), carry)))


def total(a: Column, b: Column) -> Column:
    return a + b


def with_spans(df: DataFrame, text: str, pattern: str, name: str,
               needs: tuple[str, ...] = ()) -> DataFrame:
    """Add ``name``: array of (start, end, hit) of a pattern's leftmost non-overlapping matches.

    Places count code points from 0, ends are exclusive. Pieces between the
    matches give the places. Texts that hold none of the strings of ``needs``, if
    there are any, skip the search. Null texts have no spans.
    """
    hits, gaps = f"__{name}_hits", f"__{name}_gaps"
    none = F.array().cast("array<string>")
    ok = F.col(text).isNotNull()
    if needs:
        some = F.lit(False)
        for s in needs:
            some = some | F.col(text).contains(s)
        ok = ok & some
    df = df.withColumn(hits, F.when(ok, F.regexp_extract_all(
        F.col(text), F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(gaps, F.when(F.size(hits) > 0, F.split(F.col(text), pattern, -1))
                       .otherwise(none))
    kind = "array<struct<start:int,end:int,hit:string>>"
    sizes = F.zip_with(F.slice(gaps, 1, F.size(hits)), F.col(hits),
                       lambda g, h: F.length(g) + F.length(h))
    found = F.when(F.size(hits) > 0, F.zip_with(
        running(sizes, total), F.col(hits), lambda end, hit: F.struct(
            (end - F.length(hit)).alias("start"), end.alias("end"), hit.alias("hit")))).otherwise(
        F.array().cast(kind))
    return df.withColumn(name, found).drop(hits, gaps)


def chunks(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points, from which ``between`` takes parts."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0))


def between(pieces: Column, start: Column, end: Column) -> Column:
    """The code points from ``start`` to ``end`` (exclusive) of a text given by its ``chunks``."""
    first, last = (F.floor(x / CHUNK).cast("int") for x in (start, end))
    return F.substring(F.array_join(part(pieces, first, last), ""),
                       start - first * CHUNK + 1, F.greatest(end - start, F.lit(0)))


def before(pieces: Column, start: Column, chars: int) -> Column:
    """Up to ``chars`` characters in front of a place of a text given by its ``chunks``."""
    return between(pieces, F.greatest(start - chars, F.lit(0)), start)


def after(pieces: Column, end: Column, chars: int) -> Column:
    """Up to ``chars`` characters from a place on of a text given by its ``chunks``."""
    return between(pieces, end, end + chars)
