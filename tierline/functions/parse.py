"""Tolerant text parsers, as Column expressions.

All of them are built from Spark's own expressions (``try_cast``,
``regexp_extract``, ``try_to_timestamp``), so they stay inside whole-stage
codegen and need no Python worker.  Bad text becomes NULL; nothing raises
under ANSI mode.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Column

ColumnOrName = Column | str

# --- fixed values (must equal the reference's behaviour) -------------------
# Range text: a leading number, and a second number after an EN DASH, a
# hyphen or the word "to", anchored at the end of the trimmed text.
RANGE_MIN_PATTERN = r"^(\d+(?:\.\d+)?)"
RANGE_MAX_PATTERN = r"(?:[–-]|to)\s*(\d+(?:\.\d+)?)$"
# Money text: rupee sign, thousands commas and whitespace are removed first;
# then the first number (with optional k/K multiplier) is the minimum and the
# first number that follows a dash or "to" is the maximum (unanchored).
MONEY_STRIP_PATTERN = r"[₹,\s]"
MONEY_MIN_PATTERN = r"(\d+(?:\.\d+)?)([kK]?)"
MONEY_MAX_PATTERN = r"(?:[–-]|to)(\d+(?:\.\d+)?)([kK]?)"
# Hourly weather timestamps: local wall clock to the minute.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
# ---------------------------------------------------------------------------


def _col(c: ColumnOrName) -> Column:
    return c if isinstance(c, _Column) else F.col(c)


def coerce_numeric(
    c: ColumnOrName,
    to: str = "double",
    sentinels: Iterable[str] | None = None,
) -> Column:
    """``try_cast`` to ``to``: unparsable text (e.g. ``needs_verification``)
    becomes NULL instead of failing the job.

    ``sentinels`` are values nulled before the cast; they matter only for
    text that *would* parse (a sentinel like ``-1`` or ``0``).
    """
    src = _col(c)
    if sentinels:
        src = F.when(src.cast("string").isin(list(sentinels)), F.lit(None)).otherwise(src)
    return src.try_cast(to)


def null_sentinels(c: ColumnOrName, sentinels: Iterable[str]) -> Column:
    """Turn sentinel strings into NULL in a text column, keep everything else."""
    src = _col(c)
    return F.when(src.isin(list(sentinels)), F.lit(None).cast("string")).otherwise(src)


def parse_range(c: ColumnOrName) -> Column:
    """Parse ``"5"``, ``"5–6"``, ``"5-6"``, ``"10 to 12"`` into
    ``struct<min double, max double, avg double>``.

    A single value gives ``max = min``; a trailing suffix (``"5–6 days"``)
    defeats the end anchor, so that also gives ``max = min``.  Unparsable or
    NULL text gives NULLs.
    """
    text = F.trim(_col(c).cast("string"))
    lo_raw = F.regexp_extract(text, RANGE_MIN_PATTERN, 1)
    hi_raw = F.regexp_extract(text, RANGE_MAX_PATTERN, 1)
    lo = lo_raw.try_cast("double")
    hi = F.when(hi_raw == "", lo).otherwise(hi_raw.try_cast("double"))
    return F.struct(lo.alias("min"), hi.alias("max"), ((lo + hi) / 2).alias("avg"))


def _money_side(clean: Column, pattern: str) -> Column:
    raw = F.regexp_extract(clean, pattern, 1)
    unit = F.regexp_extract(clean, pattern, 2)
    value = raw.try_cast("double")
    return (
        F.when(raw == "", F.lit(None).cast("double"))
        .when(F.lower(unit) == "k", value * 1000)
        .otherwise(value)
    )


def parse_money_range(c: ColumnOrName) -> Column:
    """Parse ``"₹2,500–₹4,000"``, ``"₹5k–₹8k"``, ``"₹5–8k"`` into
    ``struct<min double, max double>``.

    The ``k`` multiplier applies per side only.  A single amount gives a NULL
    maximum (unlike :func:`parse_range`).
    """
    clean = F.regexp_replace(_col(c).cast("string"), MONEY_STRIP_PATTERN, "")
    return F.struct(
        _money_side(clean, MONEY_MIN_PATTERN).alias("min"),
        _money_side(clean, MONEY_MAX_PATTERN).alias("max"),
    )


def parse_event_time(c: ColumnOrName, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Parse zone-less local time text into ``timestamp_ntz``; bad text → NULL.

    The values are wall-clock readings with no zone, so the zone-less type is
    the faithful one; parsing goes through the session zone and back, which
    is exact because :func:`tierline.session.get_session` pins UTC.
    """
    return F.try_to_timestamp(_col(c).cast("string"), F.lit(fmt)).cast("timestamp_ntz")


# A double is taken apart before it is added up: its integer part, its
# fraction in units of 1e-8 (both 64-bit integers, so their sums are exact
# whatever the order), and what is left (below 5e-9).  From 1e7 on a double
# does not tell 8 places apart, so its units are hundredths; values of 9e9 and
# up, NaN and infinite ones are left whole.
PLACES = 8
UNITS = 10**PLACES
FINE_BELOW = 1e7
COARSE_BELOW = 9e9


def exact_steps(c: ColumnOrName) -> tuple[Column, Column]:
    """Integer part of a value, and the value as a number of units.  Both are
    used several times by :func:`exact_parts`; where that matters for speed
    they can be columns of their own."""
    x = _col(c).cast("double")
    size = F.abs(x)
    units = F.when(size < FINE_BELOW, F.floor(x * float(UNITS) + 0.5)).when(size < COARSE_BELOW, F.floor(x * 100.0 + 0.5))
    return F.floor(x), units


def exact_parts(c: ColumnOrName, steps: tuple[Column, Column] | None = None) -> dict[str, Column]:
    """``whole, frac, rest`` of a value; add each up and hand the sums to
    :func:`exact_total`.  The parts of several sets of rows can be added up in
    any grouping and order."""
    x = _col(c).cast("double")
    whole, units = steps or exact_steps(c)
    fine, coarse = F.abs(x) < FINE_BELOW, F.abs(x) < COARSE_BELOW
    return {
        "whole": F.when(coarse, whole),
        "frac": F.when(fine, units - whole * UNITS).when(coarse, (units - whole * 100) * (UNITS // 100)),
        "rest": F.when(fine, x - units / float(UNITS)).when(coarse, x - units / 100.0).otherwise(x),
    }


def exact_total(whole: Column, frac: Column, rest: Column, scale: int, count: Column | None = None) -> Column:
    """The rounded total (or, with ``count``, average) of summed parts.  What
    is left is rounded to 8 places before it is added, so that noise in the
    last bits of values does not tip a rounding; where it has no exact form
    (NaN, infinite, 1e18 and up) the result is a rounded double."""
    zero = F.lit(0).cast("long")
    exact = F.coalesce(whole, zero).cast("decimal(20,0)") + F.coalesce(frac, zero).cast("decimal(20,0)") * F.lit(
        Decimal(1).scaleb(-PLACES)
    )
    exact = exact.cast(f"decimal(30,{PLACES})")
    left = F.round(rest, PLACES).try_cast(f"decimal(28,{PLACES})")
    total, loose = exact + left, exact.cast("double") + rest
    if count is not None:
        total, loose = F.try_divide(total, count), F.try_divide(loose, count)
    return F.when(left.isNull(), F.round(loose, scale)).otherwise(F.round(total, scale).cast("double"))


def rounded_sum(c: ColumnOrName, scale: int = 2) -> Column:
    """Aggregate: the sum of doubles, added up exactly and rounded once.

    Sums of doubles differ in the last bits with summation order, and the
    order changes with partitioning and with task retries; a sum of exact
    parts does not.  A group with NaN, infinite or huge values gets the
    rounded double sum.  A sum of integer parts beyond 64 bits raises (ANSI).
    """
    return exact_total(*[F.sum(p) for p in exact_parts(c).values()], scale)


def rounded_avg(c: ColumnOrName, scale: int = 2) -> Column:
    """Aggregate: like :func:`rounded_sum`, for the average."""
    return exact_total(*[F.sum(p) for p in exact_parts(c).values()], scale, F.count(_col(c)))
