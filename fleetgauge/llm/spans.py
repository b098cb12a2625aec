"""Spans of pattern matches in DataFrame functions: positions in code points, digests, joined text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches whose positions are added up at a time, so that thousands in one text stay cheap.
BLOCK = 128
SPAN = "array<struct<start:int,order:int,end:int,value:string,part:string,left:string>>"


def matches(text: Column, pattern: str, when: Column, order: int, part: int = 0) -> Column:
    """Leftmost non-overlapping matches as array of (start, order, end, value, part, left).

    part: the group of that number; left: what stands between the match before and this one. Only
    looked for where `when` holds. Positions are running sums of lengths, in blocks of BLOCK.
    """
    regex = F.lit(pattern)
    empty = F.array().cast(SPAN)
    kind = "struct<at:int,out:" + SPAN + ">"

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["left"])
        end = start + F.length(x["value"])
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), x["value"].alias("value"),
                        x["part"].alias("part"), x["left"].alias("left"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def placed(items: Column) -> Column:
        n = F.ceil(F.size(items) / F.lit(BLOCK)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), n - 1), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK)))
        width = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + F.length(x["left"]) + F.length(x["value"])))
        begins = F.aggregate(width, F.array(F.lit(0)), lambda s, w: F.concat(s, F.array(F.element_at(s, -1) + w)))

        def block(b: Column, i: Column, at: Column) -> Column:
            zero = F.struct(F.element_at(at, i + 1).alias("at"), empty.alias("out")).cast(kind)
            return F.aggregate(b, zero, add, lambda s: s["out"])

        return F.flatten(let(begins, lambda at: F.transform(blocks, lambda b, i: block(b, i, at))))

    value = F.regexp_extract_all(text, regex, F.lit(0))
    parts = F.regexp_extract_all(text, regex, F.lit(part)) if part else value
    items = F.zip_with(F.zip_with(value, parts, lambda v, p: F.struct(v.alias("value"), p.alias("part"))),
                       F.slice(F.split(text, pattern, -1), F.lit(1), F.greatest(F.size(value), F.lit(0))),
                       lambda x, left: F.struct(x["value"].alias("value"), x["part"].alias("part"), left.alias("left")))
    found = let(items, lambda x: F.when(F.size(x) > 0, placed(x)).otherwise(empty))
    return F.when(when, found).otherwise(empty)


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def slim(spans: Column) -> Column:
    """(start, order, end, value) only."""
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["value"].alias("value")))


def joined(spans: Column, kinds: list[str]) -> Column:
    """kind:start:end of all spans by start, then kind, joined by commas."""
    names = F.array(*(F.lit(k) for k in kinds))
    text = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(names, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def merged(parts: list[Column]) -> Column:
    return reduce(lambda a, b: F.concat(a, b), parts)


def counted(spans: Column, order: int) -> Column:
    """Number of spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["order"] == order)).cast("long")
