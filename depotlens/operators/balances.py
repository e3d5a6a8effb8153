"""Cash balance per account as of a cut-off date (last snapshot <= as_of).

Several balance rows of one account on one date are resolved
deterministically: the larger amount wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def balance_days(balances: DataFrame) -> DataFrame:
    """One balance per (account, date)."""
    return (balances.groupBy(F.col("Kontoreferenz").alias("Depotnummer"), F.col("Datum").alias("d"))
            .agg(F.max("Saldosollwert").alias("ev_s")))


def balance_base_at(balances: DataFrame, as_of: Column) -> DataFrame:
    """``s_saldo``: the balance of the last snapshot on or before ``as_of``."""
    return (balances.where(F.col("Datum") <= as_of)
            .groupBy(F.col("Kontoreferenz").alias("Depotnummer"))
            .agg(F.max_by(F.col("Saldosollwert"),
                          F.struct(F.col("Datum"), F.col("Saldosollwert"))).alias("s_saldo")))
