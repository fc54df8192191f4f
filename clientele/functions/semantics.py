"""Value rules that every operator shares, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; also for timestamps without a zone."""
    return F.unix_micros(ts.cast("timestamp"))


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two instants, rounded towards minus infinity."""
    gap = micros(later) - micros(earlier)
    return ((gap - F.pmod(gap, F.lit(DAY_MICROS))) / DAY_MICROS).cast("long")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; a zero or missing denominator gives null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def exact_stddev(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation from count, sum and sum of squares of *integers*.

    The sums are exact decimals. They are centred on the integer mean before
    going to double, so values that are all equal give exactly zero and large
    means lose no digits. One value or none gives null.
    """
    count = n.cast("decimal(20,0)")
    s1 = total.cast("decimal(38,0)")
    s2 = squares.cast("decimal(38,0)")
    mean = F.floor(F.try_divide(s1, count)).cast("decimal(20,0)")
    centred = (s2 - F.lit(2) * mean * s1 + count * mean * mean).cast("double")
    rest = (s1 - count * mean).cast("double")
    variance = (centred - ratio(rest * rest, n)) / F.nullif(n.cast("double") - 1, F.lit(0.0))
    return F.when(n > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))


def smallest_mode(value: Column, count: Column) -> Column:
    """Aggregate over (value, count) rows: most frequent, smallest on ties."""
    return F.min_by(value, F.when(value.isNotNull(), F.struct(-count, value)))


def first_peak(counts: list[Column], labels: list[Column]) -> Column:
    """Label of the first largest count; null when all counts are zero."""
    peak = F.greatest(*counts) if len(counts) > 1 else counts[0]
    chosen = F.coalesce(*[F.when(count == peak, label) for count, label in zip(counts, labels)])
    return F.when(peak > 0, chosen)


def clip_upper(value: Column, bound) -> Column:
    return F.when(value.isNotNull(), F.least(value, F.lit(bound)))


def contains_ci(text: Column, part: Column) -> Column:
    """Case-insensitive literal containment."""
    return F.contains(F.lower(text), F.lower(part))
