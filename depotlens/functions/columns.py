"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c) -> Column:
    """Numeric coercion: unparsable, NaN and infinite values -> NULL (never raises under ANSI mode)."""
    x = F.expr(f"try_cast(`{c}` AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def to_date_col(c) -> Column:
    """Date coercion: DATE/TIMESTAMP/ISO string -> DATE, unparsable -> NULL.

    Time of day is dropped, so an order at 14:00 on the cut-off day counts
    for that day.
    """
    return F.expr(f"try_cast(`{c}` AS DATE)") if isinstance(c, str) else c.try_cast("date")


def clip(c, lo, hi) -> Column:
    """``least(greatest(c, lo), hi)``; NULL stays NULL."""
    return F.least(F.greatest(col(c), F.lit(lo)), F.lit(hi))


def safe_div(num, den) -> Column:
    """``num / den`` when ``den != 0`` else NULL (no ANSI divide-by-zero error)."""
    return F.when(col(den) != 0, col(num) / col(den))


def epoch_day(c) -> Column:
    """Days since 1970-01-01 as INT (a total order usable in range frames)."""
    return F.datediff(col(c), F.lit("1970-01-01").cast("date"))


def month_index(c) -> Column:
    """Calendar month as a dense integer: year*12 + month-1."""
    return F.year(col(c)) * 12 + F.month(col(c)) - 1


MONEY_SCALE = 10000  # amounts are summed in exact 1/10000 units


def money_units(c) -> Column:
    """Amount as an exact integer count of 1/10000 units.

    Sums of these are exact and independent of the order in which partitions
    are combined, so a re-run yields bit-identical sums, means and ratios.
    """
    # rint (Math.rint) instead of round: same result for amounts with up to
    # four decimals, without a BigDecimal per value.
    return F.rint(col(c) * MONEY_SCALE).cast("bigint")


def from_units(c) -> Column:
    return col(c).cast("double") / MONEY_SCALE


def half_up_decimal(c, scale: int, precision: int = 18) -> Column:
    """Round half-up to ``scale`` places as DECIMAL; NaN/inf/NULL -> 0.

    Spark rounds a double by its shortest decimal representation, i.e. like
    ``Decimal(str(x)).quantize(..., ROUND_HALF_UP)``.
    """
    x = col(c)
    ok = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.when(ok, F.round(x, scale)).otherwise(F.lit(0.0)).cast(f"decimal({precision},{scale})")


def parse_localized_number(c) -> Column:
    """``'1.234,56'`` -> 1234.56: drop spaces and thousands dots, comma -> dot.

    Values that still do not parse become NULL.
    """
    s = F.trim(col(c).cast("string"))
    s = F.regexp_replace(s, r"\s+", "")
    s = F.regexp_replace(s, r"\.", "")
    s = F.translate(s, ",", ".")
    return s.try_cast("double")


def contains_any(c, words) -> Column:
    expr = None
    for w in words:
        e = col(c).contains(w)
        expr = e if expr is None else (expr | e)
    return expr if expr is not None else F.lit(False)
