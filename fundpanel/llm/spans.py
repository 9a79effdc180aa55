"""Spans of regular expressions as native column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPANS = "array<struct<s:int,e:int,v:string>>"
#: Code points in a piece of a text, see pieces().
PIECE = 2000


def matches(text: Column, pattern: str) -> Column:
    """All leftmost non-overlapping matches, in order, as strings."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def with_spans(rows: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """rows, in which each column of `patterns`, the matches of its pattern, becomes array<struct<s int, e int, v string>>.

    Positions are in code points, ends exclusive.  What a split by the same pattern leaves are the gaps between the matches; running
    sums of both lengths are the positions.  They are summed up in chunks of about the square root of the number of matches, so that a
    text with very many takes little more time than its length.  Each step is a column of its own, read twice or more by the next: an
    expression inside a lambda would be evaluated again for every element.  Texts without a match aren't split.
    """
    none = F.array().cast(_SPANS)
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    rest = [c for c in rows.columns if c not in patterns]

    def step(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.length(x["v"])
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v")))).alias("out"))

    def pairs(kind: str, pattern: str) -> Column:
        gaps = F.slice(F.split(F.col(text), pattern, -1), F.lit(1), F.size(kind))
        both = F.zip_with(gaps, F.col(kind), lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("v")))
        return F.when(F.size(kind) > 0, both).otherwise(F.array().cast("array<struct<gap:int,v:string>>"))

    def chunks(kind: str) -> Column:
        size = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(kind)))).cast("int")
        found = F.transform(F.sequence(F.lit(0), F.size(kind) - 1, size), lambda at: F.aggregate(F.slice(F.col(kind), at + 1, size), start, step))
        return F.when(F.size(kind) > 0, found).otherwise(F.array().cast(f"array<struct<at:int,out:{_SPANS}>>"))

    def spans(kind: str) -> Column:
        before = F.aggregate(F.transform(kind, lambda x: x["at"]), F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
        moved = F.zip_with(F.col(kind), F.slice(before, F.lit(1), F.size(kind)), lambda x, by: F.transform(x["out"], lambda y: F.struct((y["s"] + by).alias("s"), (y["e"] + by).alias("e"), y["v"].alias("v"))))
        return F.when(F.size(kind) > 0, F.flatten(moved)).otherwise(none)

    rows = rows.select(*rest, *(pairs(kind, pattern).alias(kind) for kind, pattern in patterns.items()))
    rows = rows.select(*rest, *(chunks(kind).alias(kind) for kind in patterns))
    return rows.select(*rest, *(spans(kind).alias(kind) for kind in patterns))


def pieces(text: Column) -> Column:
    """The text cut into pieces of PIECE code points; a place in a long text is found without reading what is before it."""
    return F.split(text, rf"(?s)(?<=\G.{{{PIECE}}})", -1)


def around(cut: Column, start: Column, end: Column, width: int) -> Column:
    """`width` code points before start, a space, and those from end on, of a text in pieces."""

    def part(a: Column, b: Column) -> Column:
        k = F.floor(a / PIECE).cast("int")
        two = F.concat_ws("", F.slice(cut, k + 1, F.lit(2)))
        return F.substring(two, a - k * PIECE + 1, b - a)

    return F.concat(part(F.greatest(start - width, F.lit(0)), start), F.lit(" "), F.coalesce(part(end, end + width), F.lit("")))


def text_of(spans: Column) -> Column:
    """kind:start:end of each element (fields name, s, e), joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["name"], x["s"].cast("string"), x["e"].cast("string"))), ",")
