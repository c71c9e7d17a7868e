"""Positions of regular-expression matches with built-in functions only.

``split`` and ``regexp_extract_all`` walk a text the same way (leftmost, not
overlapping), so the lengths of the pieces between matches and of the matches
themselves add up to the positions.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Matches walked together.
BLOCK = 256
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,value:string>>"


def spans(text: Column, pattern: Column | str, kind: str, rank: int, value_group: int = 0) -> Column:
    """Array of (start, rank, kind, end, value) of every match; ``rank`` is the
    kind's place in the listed order, ``value`` the match or one of its groups.
    A null text has none."""
    p = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.regexp_extract_all(text, p, F.lit(0))
    value = F.regexp_extract_all(text, p, F.lit(value_group)) if value_group else found
    # length of the text before match i: all pieces up to i and all matches before it
    zipped = F.arrays_zip(F.split(text, p, -1).alias("gap"), found.alias("hit"), value.alias("value"))
    def step(acc, x):
        a = acc["at"] + F.length(x["gap"])
        b = a + F.length(x["hit"])
        one = F.struct(a.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                       b.alias("end"), x["value"].alias("value"))
        return F.when(x["hit"].isNull(), acc).otherwise(
            F.struct(b.alias("at"), F.concat(acc["out"], F.array(one)).alias("out")))

    def walk(part, at):
        return F.aggregate(part, F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")), step, lambda acc: acc["out"])

    def width(part):
        return F.aggregate(part, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.coalesce(F.length(x["hit"]), F.lit(0)))

    def walked(z):
        return F.when(F.size(z) <= BLOCK, walk(z, F.lit(0))).otherwise(F.flatten(in_blocks(z, F.lit(0), lambda at, part: (
            at + width(part)), walk)))

    return F.when(F.rlike(text, p), bound(zipped, walked)).otherwise(F.array().cast(SPAN))


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def in_blocks(items: Column, start: Column, after, use) -> Column:
    """Array of ``use(block, state before it)`` over blocks of ``BLOCK`` items;
    ``after(state, block)`` gives the state behind a block.  What grows by
    appending is then as long as a block, or has one entry a block, so a text of
    very many matches does not cost the square of their number."""
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")),
                        lambda b: F.slice(items, b * BLOCK + 1, BLOCK))

    def run(blocks):
        states = F.aggregate(blocks, F.array(start), lambda acc, part: F.concat(
            acc, F.array(after(F.element_at(acc, -1), part))))
        return bound(states, lambda at: F.transform(blocks, lambda part, i: use(part, at[i])))

    return bound(parts, run)


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined, in the array's order."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def of_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda x: x["kind"] == kind)).cast("long")


def replaced(text: Column, found: Column, label) -> Column:
    """``text`` with every span replaced by ``label(span)``; spans come in order
    of start, and one that begins inside its predecessor only extends it."""
    def fill(body, part, from_at):
        """The text from ``from_at`` to the end of the block's spans."""
        to = ends(from_at, part)

        def step(acc, x, t):
            gap = F.substring(t, acc["at"] - from_at + 1, x["start"] - acc["at"])
            return F.when(x["start"] >= acc["at"], F.struct(
                x["end"].alias("at"), F.concat(acc["out"], gap, label(x)).alias("out"))).otherwise(
                F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out")))

        return bound(F.substring(body, from_at + 1, to - from_at), lambda t: F.aggregate(
            part, F.struct(from_at.alias("at"), F.lit("").alias("out")), lambda acc, x: step(acc, x, t),
            lambda acc: acc["out"]))

    def ends(at, part):
        return F.aggregate(part, at, lambda n, x: F.greatest(n, x["end"]))

    def done(body, spans_):
        tail = F.substring(body, ends(F.lit(0), spans_) + 1, F.length(body))
        return F.concat(F.array_join(in_blocks(spans_, F.lit(0), ends, lambda part, at: fill(body, part, at)), ""), tail)

    # the columns stand outside the lambdas: inside, a select that renames its
    # result to the text's name would read the new text (a lateral alias)
    return F.when(F.size(found) == 0, text).otherwise(
        bound(F.struct(text.alias("t"), found.alias("f")), lambda v: done(v["t"], v["f"])))
