"""Positions of pattern matches as array expressions: the texts between matches tell where each match begins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Type of found(): positions in code points, the end exclusive.
SPANS = "array<struct<start:int,end:int,found:string>>"


def found(text: Column, pattern: str | Column) -> Column:
    """All leftmost non-overlapping matches of a text: array of (start, end, found). The text must not be null."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    steps = F.arrays_zip(gaps.alias("gap"), matches.alias("found"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        end = start + F.length(x["found"])
        return F.when(x["found"].isNull(), so_far).otherwise(F.struct(end.alias("at"), F.concat(
            so_far["spans"], F.array(F.struct(start.alias("start"), end.alias("end"), x["found"].alias("found"))))
            .alias("spans")))

    return F.aggregate(steps, empty, step, lambda so_far: so_far["spans"])


def found_if(condition: Column, text: Column, pattern: str) -> Column:
    """found() where a cheap test says that there may be a match, nothing elsewhere."""
    return F.when(condition, found(text, pattern)).otherwise(F.array().cast(SPANS))


def described(spans: Column) -> Column:
    """Comma-joined kind:start:end of an array of structs with these fields, in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")
