"""Exact numeric expressions. All are built-in columns, so they stay inside whole-stage codegen."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.schemas import METRIC_DECIMALS


def decimal_text(x: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, correctly rounded from the binary value, ties to even."""
    return F.call_function("format_number", x, F.lit("0." + "0" * digits))


def _settled(x: Column, nearest: Column, digits: int) -> Column:
    """``x`` rounded, given the whole number ``nearest`` to ``x * 10^digits``.

    Away from a tie, and while the scaled value is small enough for its own rounding error not to
    matter, ``nearest / 10^digits`` is the correctly rounded double; only the remaining rows pay for
    decimal formatting. Adding 0.0 turns -0.0 into 0.0.
    """
    unit = F.lit(float(10**digits))
    plain = (F.abs(x * unit - nearest) < 0.4999) & (F.abs(nearest) < 1e9)
    return F.when(plain, nearest / unit).otherwise(decimal_text(x, digits).cast("double")) + F.lit(0.0)


def round_exact(x: Column, digits: int = METRIC_DECIMALS) -> Column:
    """Round the exact binary value of a double to ``digits`` decimals, ties to even.

    ``F.round`` rounds the shortest decimal text instead, so it is off by one unit near ties
    (580/1600000 must give 0.000362, not 0.000363), and costs more.
    """
    return _settled(x, F.rint(x * F.lit(float(10**digits))), digits)


def _guarded(numerator: Column, denominator: Column) -> Column:
    empty = denominator.isNull() | (denominator == 0)
    return F.when(empty, F.lit(0.0)).otherwise(numerator / denominator)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` to metric precision; 0.0 on a zero or null denominator."""
    return round_exact(_guarded(numerator, denominator))


def with_ratios(df: DataFrame, ratios: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Add a :func:`ratio` per name.

    The quotient and its nearest whole number are columns of their own on the way. They are used
    several times, so the optimizer keeps them apart instead of repeating them, and the generated
    method stays under the 8000 bytes above which the JVM would not compile it.
    """
    kept = df.columns
    quotients = df.withColumns({f"__q_{n}": _guarded(*parts) for n, parts in ratios.items()})
    unit = F.lit(float(10**METRIC_DECIMALS))
    nearest = quotients.withColumns({f"__n_{n}": F.rint(F.col(f"__q_{n}") * unit) for n in ratios})
    return nearest.select(
        *kept,
        *[_settled(F.col(f"__q_{n}"), F.col(f"__n_{n}"), METRIC_DECIMALS).alias(n) for n in ratios],
    )


def half_up(x: Column, digits: int) -> Column:
    """``floor(x * 10^digits + 0.5) / 10^digits``, the dashboard's rounding (1.005 -> 1.0)."""
    unit = float(10**digits)
    return F.floor(x * F.lit(unit) + F.lit(0.5)) / F.lit(unit)


def micros(x: Column) -> Column:
    """A metric-precision double as a whole number of 1e-6 units: sums do not depend on order."""
    return F.floor(x * F.lit(1e6) + F.lit(0.5))


def mean_of_metric(x: Column) -> Column:
    """Mean over all rows of a metric-precision double, the same under any partitioning and row order. A
    null adds nothing, but its row counts."""
    return F.sum(micros(x)) / F.lit(1e6) / F.count("*")


def fixed_text(x: Column, digits: int) -> Column:
    """Text with ``digits`` decimals, halves of the exact binary value away from zero.

    A double is an exact half at ``digits`` decimals only if it is an odd multiple of
    2^-(digits+1); every other value is already formatted right by ``format_number``.
    """
    unit = float(10**digits)
    doublings = x * F.lit(float(2 ** (digits + 1)))
    is_half = (F.abs(doublings) < 1e15) & (F.abs(doublings) % 2 == 1)
    away = F.signum(x) * (F.floor(F.abs(x) * F.lit(unit)) + 1) / F.lit(unit)
    return decimal_text(F.when(is_half, away).otherwise(x), digits)
