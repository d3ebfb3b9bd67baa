"""Column expressions over one curve: an array of doubles in a row. Nothing here shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def finite(v: Column) -> Column:
    """v, or null where it is NaN or infinite: aggregates then skip it."""
    return F.when(~F.isnan(v) & (F.abs(v) < float("inf")), v)


def finite_values(a: Column) -> Column:
    return F.filter(a, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, v: s + v)


def mean(a: Column) -> Column:
    return F.when(F.size(a) > 0, total(a) / F.size(a))


def std_pop(a: Column) -> Column:
    return let(a, lambda x: let(mean(x), lambda m: F.sqrt(mean(F.transform(x, lambda v: (v - m) * (v - m))))))


def quantile(a: Column, q: float) -> Column:
    """Linear interpolation between order statistics; null for an empty array."""

    def of(s: Column) -> Column:
        at = (F.size(s) - 1) * F.lit(float(q))
        lo = F.floor(at).cast("int")
        hi = F.ceil(at).cast("int")
        return F.when(F.size(s) > 0, F.get(s, lo) + (F.get(s, hi) - F.get(s, lo)) * (at - lo))

    return let(F.array_sort(a), of)


def median(a: Column) -> Column:
    return quantile(a, 0.5)


def span(a: Column, start: int, stop: int | Column) -> Column:
    """a[start:stop] with 0-based bounds."""
    stop = F.lit(stop) if isinstance(stop, int) else stop
    return F.slice(a, F.lit(start + 1), F.greatest(stop - start, F.lit(0)))


def argmax(a: Column) -> Column:
    """Index of the first largest value."""
    return F.array_position(a, F.array_max(a)).cast("int") - 1


def argmin(a: Column) -> Column:
    return F.array_position(a, F.array_min(a)).cast("int") - 1


def first_index(a: Column, test: Callable[[Column], Column]) -> Column:
    """Index of the first value that passes, else null."""
    at = F.array_position(F.transform(a, lambda v: F.coalesce(test(v), F.lit(False))), F.lit(True)).cast("int")
    return F.when(at > 0, at - 1)


def smooth3(a: Column) -> Column:
    """Centred mean of three with zeros beyond the ends."""
    zero = F.array(F.lit(0.0))
    n = F.greatest(F.size(a) - 1, F.lit(0))
    before, after = F.concat(zero, F.slice(a, F.lit(1), n)), F.concat(F.slice(a, F.lit(2), n), zero)
    return F.when(F.size(a) == 0, a).otherwise(F.zip_with(F.zip_with(a, before, lambda v, b: v + b), after, lambda v, c: (v + c) / 3))


def differences(a: Column) -> Column:
    n = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(2), n), F.slice(a, F.lit(1), n), lambda b, x: b - x)


def clip(v: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(v, F.lit(lo)), F.lit(hi))


def nan_to_zero(a: Column) -> Column:
    return F.transform(a, lambda v: F.coalesce(finite(v), F.lit(0.0)))
