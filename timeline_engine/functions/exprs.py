"""Column expressions: parsing, rounding, predicates. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds(ts: Column) -> Column:
    """Seconds since 1970 of a zone-less timestamp, as DOUBLE."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", zero, ts.cast("timestamp_ntz")).cast("double") / F.lit(1e6)


def clock_seconds(clock: Column) -> Column:
    """Seconds of 'M:SS' (two digits) or 'SS.T' (one digit); else null."""
    minutes = F.regexp_extract(clock, r"^([0-9]+):([0-9]{2})$", 1)
    rest = F.regexp_extract(clock, r"^([0-9]+):([0-9]{2})$", 2)
    whole = F.regexp_extract(clock, r"^([0-9]+)\.([0-9])$", 1)
    tenth = F.regexp_extract(clock, r"^([0-9]+)\.([0-9])$", 2)
    as_double = lambda c: c.try_cast("double")
    return F.when(minutes != "", as_double(minutes) * 60 + as_double(rest)).when(whole != "", as_double(whole) + as_double(tenth) / 10)


def ratio_parts(text: Column) -> tuple[Column, Column]:
    """(a, b) of 'a/b' where both are digits around exactly one slash; else
    nulls."""
    ok = text.rlike(r"^[0-9]+/[0-9]+$")
    part = lambda k: F.when(ok, F.split_part(text, F.lit("/"), F.lit(k)).try_cast("bigint"))
    return part(1), part(2)


def numeric_cell(text: Column) -> Column:
    """Whether a table cell is a number: digits with at most one '/', or one
    ':', or one '.' and '%' signs at the end."""
    return text.rlike(r"^([0-9]+/?[0-9]*|[0-9]*/?[0-9]+|[0-9]+:?[0-9]*|[0-9]*:?[0-9]+|[0-9]+\.?[0-9]*%*|[0-9]*\.?[0-9]+%*)$")


def half_even(x: Column) -> Column:
    """Rounding of halves to the even neighbour, as BIGINT."""
    return F.bround(x).cast("bigint")


def screen_state(columns: Column, tag: Column, chrome: Column, orange: Column, orange_floor: float = 0.15) -> Column:
    """The state that a frame's probes imply, by precedence."""
    return (
        F.when(columns.isNotNull(), "boxscore").when(tag.isNotNull(), "replay").when(chrome, "live").when(orange > orange_floor, "series").otherwise("other")
    )


def is_drop(before: Column, after: Column, to_zero: bool = True, least: float = 0) -> Column:
    """A counter fell: to zero, or by at least ``least`` while staying above."""
    fell = after == 0 if to_zero else (after > 0) & (before - after >= least)
    return F.coalesce(fell, F.lit(False))


def within(t: Column, start: Column, end: Column, closed: bool = True) -> Column:
    return (t >= start) & ((t <= end) if closed else (t < end))


def overlaps(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Closed intervals share an instant."""
    return (a0 <= b1) & (b0 <= a1)


def same_side(a: Column, b: Column) -> Column:
    """Both names resolved and on the same side; two unknown sides are equal."""
    return a.eqNullSafe(b)


def long_enough(value: Column, start: Column, end: Column, least: float = 0.5) -> Column:
    """Runs that last; readings with tenths change too fast to be held to it."""
    return F.coalesce(F.contains(value, F.lit(".")), F.lit(False)) | (end - start >= least)


def bar_side(level: Column) -> Column:
    return F.when(level > 200, "right").when((level > 100) & (level < 170), "left")


def ratio_text(a: Column, b: Column) -> Column:
    """'a/b', null if either is."""
    return F.concat(a.cast("string"), F.lit("/"), b.cast("string"))
