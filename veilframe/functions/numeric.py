"""Rounding rules, kept apart by name because formulas mix them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def num(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def half_even(x: Column) -> Column:
    """Nearest integer, halves to the even one."""
    return F.rint(num(x)).cast("int")


def toward_zero(x: Column) -> Column:
    """Integer part; a Spark cast drops the fraction."""
    return num(x).cast("double").cast("int")


def floor_to(x: Column, step) -> Column:
    return (F.floor(num(x) / num(step)) * num(step)).cast("int")


def ceil_to(x: Column, step) -> Column:
    return (F.ceil(num(x) / num(step)) * num(step)).cast("int")


def draw(seed: int, salt: str, key: Column, n: int) -> Column:
    """A number from 0 to n - 1 that seed, salt and key decide, the same in every engine: 60 bits of an MD5 digest, by remainder."""
    said = F.concat_ws("|", F.lit(str(seed)), F.lit(salt), key.cast("string"))
    return F.conv(F.substring(F.md5(said), 1, 15), 16, 10).cast("long") % n


def clamp(x: Column, lo, hi) -> Column:
    """Between lo and hi; null stays null, which least and greatest would skip."""
    return F.when(num(x).isNotNull(), F.least(F.greatest(num(x), num(lo)), num(hi)))
