"""Portfolio snapshot measures per depot: value, positions, worthless
positions, concentration, losses, tech and stock shares.

``position_snapshots`` aggregates every snapshot (depot, Datum) once, in two
levels: (depot, Datum, security) -> (depot, Datum). The Herfindahl index is
``sum(v_s^2) / T^2`` over the security totals ``v_s`` of one snapshot, so no
window over a depot's positions is needed. The positions are shuffled once, by
snapshot, and both levels are added up where they lie: a security seldom comes
twice in a snapshot, so sums made before the shuffle would be wider than the
rows. A depot's positions are spread over as many tasks as it has snapshots.

Value sums (``p_sum``, ``p_tech_sum``, ...) are in exact 1/10000 units.

Picking the snapshot valid at a cut-off date ("last snapshot <= as_of") is done
on these small per-snapshot rows: ``max_by`` for one date, a running ``last``
in the multi-date window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from depotlens import params as P
from depotlens.functions.columns import from_units, money_units
from depotlens.functions.text import tech_hit

SNAPSHOT_FIELDS = ("p_cnt", "p_zero", "p_sum", "p_tech_cnt", "p_tech_sum", "p_aktie_sum", "p_aktie_exact",
                   "p_hhi", "p_tot_e", "p_deep", "p_win", "p_loss")


def position_snapshots(positions: DataFrame, vocab: P.Vocabulary) -> DataFrame:
    """One row per (Depotnummer, Datum) with the snapshot measures."""
    k = F.col("Kurswert")
    e = F.col("Einstandswerte")
    cost = e > 0
    pnl = k - e
    # Row flags are computed once in a projection (the security-name regex runs
    # once per row), then aggregated.
    flagged = positions.select(
        F.col("Depotreferenz").alias("Depotnummer"), "Datum", "Wertpapierreferenz",
        money_units(k).alias("ku"), (k <= 0).alias("is_zero"),
        tech_hit("Wertpapiername", vocab).alias("is_tech"),
        (F.upper(F.col("Wertpapiertyp")) == vocab.stock_type.upper()).alias("is_aktie"),
        (F.col("Wertpapiertyp") == vocab.stock_type).alias("is_aktie_exact"),
        F.coalesce(cost, F.lit(False)).alias("has_cost"),
        F.coalesce(cost & (F.try_divide(pnl, e) <= -0.5), F.lit(False)).alias("is_deep"),
        F.coalesce(cost & (pnl > 0), F.lit(False)).alias("is_win"),
        F.coalesce(cost & (pnl <= 0), F.lit(False)).alias("is_loss"))
    ku = F.col("ku")

    def usum(flag):
        return F.sum(F.when(F.col(flag), ku))

    per_security = (flagged.repartition("Depotnummer", "Datum")
                    .groupBy("Depotnummer", "Datum", "Wertpapierreferenz")
                    .agg(F.count(F.lit(1)).alias("cnt"),
                         F.count_if(F.col("is_zero")).alias("zero"),
                         F.sum(ku).alias("val"),
                         F.count_if(F.col("is_tech")).alias("tech_cnt"),
                         usum("is_tech").alias("tech_sum"),
                         usum("is_aktie").alias("aktie_sum"),
                         usum("is_aktie_exact").alias("aktie_exact"),
                         usum("has_cost").alias("tot_e"),
                         usum("is_deep").alias("deep"),
                         usum("is_win").alias("win"),
                         usum("is_loss").alias("loss")))
    has_ref = F.col("Wertpapierreferenz").isNotNull()
    v = from_units("val")
    t_ref = F.sum(F.when(has_ref, v))
    ss_ref = F.sum(F.when(has_ref, v * v))
    return (per_security.groupBy("Depotnummer", "Datum")
            .agg(F.sum("cnt").alias("p_cnt"),
                 F.sum("zero").alias("p_zero"),
                 F.sum("val").alias("p_sum"),
                 F.sum("tech_cnt").alias("p_tech_cnt"),
                 F.sum("tech_sum").alias("p_tech_sum"),
                 F.sum("aktie_sum").alias("p_aktie_sum"),
                 F.sum("aktie_exact").alias("p_aktie_exact"),
                 F.when(F.count_if(has_ref) > 0,
                        F.when(t_ref > 0, ss_ref / (t_ref * t_ref)).otherwise(F.lit(0.0))).alias("p_hhi"),
                 F.sum("tot_e").alias("p_tot_e"),
                 F.sum("deep").alias("p_deep"),
                 F.sum("win").alias("p_win"),
                 F.sum("loss").alias("p_loss")))


def snapshot_struct() -> Column:
    return F.struct(*[F.col(c) for c in SNAPSHOT_FIELDS])


def position_base_at(snapshots: DataFrame, as_of: Column) -> DataFrame:
    """Measures of the last snapshot on or before ``as_of`` per depot."""
    return (snapshots.where(F.col("Datum") <= as_of)
            .groupBy("Depotnummer")
            .agg(F.max_by(snapshot_struct(), F.col("Datum")).alias("p"))
            .select("Depotnummer", *[F.col("p")[c].alias(c) for c in SNAPSHOT_FIELDS]))
