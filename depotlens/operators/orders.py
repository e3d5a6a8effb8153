"""Order activity per depot: recency, frequency, volume, active months.

Two physical strategies produce the same base columns:

* ``order_base_at`` — one cut-off date. Two-level aggregation
  (depot, month) -> depot with conditional aggregates; partial aggregation
  runs map-side, so a depot with a huge share of the orders is combined
  before the shuffle.
* ``order_day_rows`` — many cut-off dates in one job. Orders are reduced to one
  row per (depot, day) for the depot timeline (``operators.timeline``).

Volumes are sums of ``money_units`` (exact 1/10000 units).
Base columns (NULL when the depot has no order up to the cut-off):
``o_last_buy, o_last_trade`` (DATE), ``o_n, o_vol, o_n30, o_vol30, o_n90,
o_vol90, o_months, o_act6``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import money_units, month_index

BASE_COLUMNS = ("o_last_buy", "o_last_trade", "o_n", "o_vol", "o_n30", "o_vol30",
                "o_n90", "o_vol90", "o_months", "o_act6")


def is_buy(type_col: str = "Ordertyp") -> Column:
    """Order type contains "ankauf" (case-insensitive)."""
    return F.lower(F.coalesce(F.col(type_col), F.lit(""))).contains(P.ORDER_TYPE_BUY.lower())


def order_base_at(orders: DataFrame, as_of: Column) -> DataFrame:
    """Base order columns at one cut-off date (``as_of`` is a DATE column/literal)."""
    d = F.col("Orderdatum")
    vol = money_units(F.abs(F.col("Cashflow")))
    in30 = d >= F.date_sub(as_of, 30)
    in90 = d >= F.date_sub(as_of, 90)
    in6m = d >= F.add_months(as_of, -6)
    per_month = (orders.where(d <= as_of)
                 .groupBy("Depotnummer", month_index(d).alias("m"))
                 .agg(F.max(F.when(is_buy(), d)).alias("last_buy"),
                      F.max(d).alias("last_trade"),
                      F.count(F.lit(1)).alias("n"),
                      F.sum(vol).alias("vol"),
                      F.count(F.when(in30, 1)).alias("n30"),
                      F.sum(F.when(in30, vol)).alias("vol30"),
                      F.count(F.when(in90, 1)).alias("n90"),
                      F.sum(F.when(in90, vol)).alias("vol90"),
                      F.max(in6m).alias("act6")))
    return (per_month.groupBy("Depotnummer")
            .agg(F.max("last_buy").alias("o_last_buy"),
                 F.max("last_trade").alias("o_last_trade"),
                 F.sum("n").alias("o_n"),
                 F.sum("vol").alias("o_vol"),
                 F.sum("n30").alias("o_n30"),
                 F.sum("vol30").alias("o_vol30"),
                 F.sum("n90").alias("o_n90"),
                 F.sum("vol90").alias("o_vol90"),
                 F.count(F.lit(1)).alias("o_months"),
                 F.count_if(F.col("act6")).alias("o_act6")))


def order_day_rows(orders: DataFrame) -> DataFrame:
    """One row per (depot, order day) for the multi-date window stage; if the
    orders carry the day from which they are known (``Bekannt_ab``), one row
    per (depot, order day, known day) with it as ``s``."""
    d = F.col("Orderdatum")
    known = [F.col("Bekannt_ab").alias("s")] if "Bekannt_ab" in orders.columns else []
    return (orders.groupBy(F.col("Depotnummer"), d.alias("d"), *known)
            .agg(F.count(F.lit(1)).alias("ev_o_n"),
                 F.sum(money_units(F.abs(F.col("Cashflow")))).alias("ev_o_vol"),
                 F.max(is_buy()).alias("ev_o_buy")))
