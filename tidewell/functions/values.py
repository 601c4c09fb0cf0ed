"""Typed values out of source text: casts that give null on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters, besides blanks, after which a title-cased word starts.
WORD_BREAKS = "[\\t\\n\\r!?@\"^#$&~_,.:;+\\-*%/|\\\\\\[\\](){}<>]"

# Fixed value: end of an interval that is still open.
OPEN_END = "9999-12-31 00:00:00"


def open_end() -> Column:
    return F.lit(OPEN_END).cast("timestamp")


def upper_trim(c: Column) -> Column:
    return F.upper(F.trim(c))


def title_case(c: Column) -> Column:
    """First letter of each word upper, the rest lower.

    Spark's `initcap` knows only blanks as word breaks, so every other break gets
    a blank behind it first and loses it again afterwards.
    """
    spaced = F.initcap(F.regexp_replace(c, f"({WORD_BREAKS})", "$1 "))
    return F.when(c.rlike(WORD_BREAKS), F.regexp_replace(spaced, f"({WORD_BREAKS}) ", "$1")).otherwise(F.initcap(c))


def title_trim(c: Column) -> Column:
    return title_case(F.trim(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def to_time(c: Column) -> Column:
    return F.try_to_timestamp(c)


def to_day(c: Column) -> Column:
    return F.to_date(F.try_to_timestamp(c))


def to_money(c: Column) -> Column:
    return c.try_cast("decimal(12,2)")


def to_whole(c: Column) -> Column:
    """Whole number, rounding half up; a direct cast would turn '4.5' into null."""
    return c.try_cast("decimal(38,0)").try_cast("int")


def to_flag(c: Column, default: bool = True) -> Column:
    return F.coalesce(c.try_cast("boolean"), F.lit(default))


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def attribute_hash(columns: list[Column]) -> Column:
    """SHA-256 over the values joined by `|`.

    `concat_ws` leaves nulls out, which would make different rows collide, so a
    null enters as a marker that no source text holds.
    """
    return sha256(F.concat_ws("|", *[F.coalesce(c, F.lit("\u0000")) for c in columns]))


def date_key(c: Column) -> Column:
    """Date as the number yyyymmdd."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, so 10:00:59 to 10:01:01 is one minute."""
    seconds = F.unix_timestamp(F.date_trunc("minute", end)) - F.unix_timestamp(F.date_trunc("minute", start))
    return (seconds / 60).cast("int")


def ratio(part: Column, whole: Column) -> Column:
    return part / F.nullif(whole, F.lit(0))


def rate(part: Column, whole: Column) -> Column:
    return F.round(ratio(part, whole), 4)


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)
