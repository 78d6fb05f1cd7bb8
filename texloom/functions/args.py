"""List operations on a command's arguments, arrays of struct<kind, text>."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def argument(text: str, kind: str = "group") -> Column:
    return F.struct(F.lit(kind).alias("kind"), F.lit(text).alias("text"))


def appended(args: Column, new: Column) -> Column:
    return F.array_append(args, new)


def extended(args: Column, more: Column) -> Column:
    return F.concat(args, more)


def inserted(args: Column, place: int, new: Column) -> Column:
    """new before the argument at place (from 0)."""
    return F.concat(F.slice(args, F.lit(1), F.lit(place)), F.array(new), F.slice(args, F.lit(place + 1), F.size(args)))


def removed(args: Column, text: str) -> Column:
    """args without the first of this text."""
    at = F.array_position(F.transform(args, lambda x: x["text"]), text)
    return F.when(at == 0, args).otherwise(F.filter(args, lambda x, i: i != at - 1))


def popped(args: Column, place: int) -> tuple[Column, Column]:
    """(the argument at place, the others)."""
    return F.get(args, F.lit(place)), F.filter(args, lambda x, i: i != place)


def reversed_(args: Column) -> Column:
    return F.reverse(args)


def cleared(args: Column) -> Column:
    """No arguments, in the type of args."""
    return F.slice(args, F.lit(1), F.lit(0))


def sliced(args: Column, start: int | None = None, stop: int | None = None) -> Column:
    """args from start to before stop; negative places count from the end, and either may be None."""
    n = F.size(args)
    at = lambda k, default: default if k is None else F.lit(k) if k >= 0 else F.greatest(n + k, F.lit(0))
    a = at(start, F.lit(0))
    return F.slice(args, a + 1, F.greatest(F.least(at(stop, n), n) - a, F.lit(0)))


def contains(args: Column, text: str) -> Column:
    return F.array_contains(F.transform(args, lambda x: x["text"]), text)


def written(args: Column) -> Column:
    """The source text of arguments."""
    return F.array_join(F.transform(args, lambda x: F.when(x["kind"] == "bracket", F.concat(F.lit("["), x["text"], F.lit("]"))).otherwise(F.concat(F.lit("{"), x["text"], F.lit("}")))), "")
