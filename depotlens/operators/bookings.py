"""Money flows per account: deposits/withdrawals, savings plans, deposit
volatility, last cash flow.

Bookings whose remark marks an internal transfer are excluded from flows,
savings plan and volatility, but still count for the savings-plan strength
and the last cash flow (which use every booking).

Base columns: ``b_in30, b_out30, b_in90, b_out90`` (sums in 1/10000 units), ``b_plan_months``
(months among the last four calendar months with a small deposit),
``b_strength`` (months of the last six with any booking 0 < amount < 1000),
``b_dep_vol`` (sample std-dev of monthly deposit sums, 180 days; NULL if fewer
than two months), ``b_last_cf`` (DATE of the last booking with a non-zero
amount).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import from_units, money_units, month_index
from depotlens.functions.text import flow_class, is_internal

BASE_COLUMNS = ("b_in30", "b_out30", "b_in90", "b_out90", "b_plan_months", "b_strength",
                "b_dep_vol", "b_last_cf")


def classified(bookings: DataFrame, vocab: P.Vocabulary) -> DataFrame:
    """Add ``klasse`` (flow class) and ``internal`` (transfer remark) columns."""
    return (bookings
            .withColumn("klasse", flow_class("Buchungtyp"))
            .withColumn("internal", is_internal("Bemerkung", vocab.internal_remark_pattern)))


def _flags(small_max: float):
    amt = F.col("Betrag")
    units = money_units(amt)
    ext = ~F.col("internal")
    is_in = ext & F.col("klasse").isin(*P.INFLOW_CLASSES)
    is_out = ext & F.col("klasse").isin(*P.OUTFLOW_CLASSES)
    small = (amt > 0) & (amt < small_max)
    return amt, units, is_in, is_out, small


def booking_base_at(bookings: DataFrame, as_of: Column, fp: P.FeatureParams) -> DataFrame:
    """Base booking columns at one cut-off date; two-level (account, month) -> account."""
    b = classified(bookings, fp.vocab)
    v = F.col("Valutadatum")
    amt, units, is_in, is_out, small = _flags(fp.small_saving_max)
    in30 = v >= F.date_sub(as_of, 30)
    in90 = v >= F.date_sub(as_of, 90)
    in180 = v >= F.date_sub(as_of, 180)
    in6m = v >= F.add_months(as_of, -6)
    m = month_index(v)
    last4 = m >= month_index(as_of) - 3
    per_month = (b.where(v <= as_of)
                 .groupBy("Kontoreferenz", m.alias("m"))
                 .agg(F.sum(F.when(is_in & in30, units)).alias("in30"),
                      F.sum(F.when(is_out & in30, units)).alias("out30"),
                      F.sum(F.when(is_in & in90, units)).alias("in90"),
                      F.sum(F.when(is_out & in90, units)).alias("out90"),
                      F.max(is_in & in180 & small & last4).alias("plan"),
                      F.max(small & in6m).alias("strength"),
                      F.sum(F.when(is_in & in180, units)).alias("dep"),
                      F.max(F.when(amt != 0, v)).alias("last_cf")))
    return (per_month.groupBy(F.col("Kontoreferenz").alias("Depotnummer"))
            .agg(F.sum("in30").alias("b_in30"), F.sum("out30").alias("b_out30"),
                 F.sum("in90").alias("b_in90"), F.sum("out90").alias("b_out90"),
                 F.count_if(F.col("plan")).alias("b_plan_months"),
                 F.count_if(F.col("strength")).alias("b_strength"),
                 F.stddev_samp(from_units("dep")).alias("b_dep_vol"),
                 F.max("last_cf").alias("b_last_cf")))


def booking_day_rows(bookings: DataFrame, fp: P.FeatureParams) -> DataFrame:
    """One row per (account, value day) for the multi-date window stage."""
    b = classified(bookings, fp.vocab)
    amt, units, is_in, is_out, small = _flags(fp.small_saving_max)
    return (b.groupBy(F.col("Kontoreferenz").alias("Depotnummer"), F.col("Valutadatum").alias("d"))
            .agg(F.sum(F.when(is_in, units)).alias("ev_b_in"),
                 F.sum(F.when(is_out, units)).alias("ev_b_out"),
                 F.max(is_in).alias("ev_b_has_in"),
                 F.max(is_in & small).alias("ev_b_small_in"),
                 F.max(small).alias("ev_b_small"),
                 F.max(amt != 0).alias("ev_b_nz")))
