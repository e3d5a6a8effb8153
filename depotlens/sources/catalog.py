"""Source tables of the depot book and their typed loaders.

A ``SourceTables`` bundle holds the five inputs as DataFrames:

* ``orders``   (cd_order):  Depotnummer, Orderdatum, Ordertyp, Cashflow, ISIN,
                            Transaktionsnummer, Bemerkung, Datei_ID
* ``balances`` (cd_saldo):  Kontoreferenz, Datum, Saldosollwert, Datei_ID
* ``positions``(cd_bestand): Depotreferenz, Datum, Wertpapierreferenz,
                            Wertpapiername, Wertpapiertyp, Kurswert, Einstandswerte, Datei_ID
* ``bookings`` (cd_buchung): Kontoreferenz, Valutadatum, Buchungdatum, Betrag,
                            Buchungtyp, Bemerkung   (optional: may be None)
* ``files``    (cd_datei):  DateiID, Datum, DateiName, Pruefziffer

Depot number, account reference and depot reference are the same key.
The loaders type the columns once (keys as strings, dates as DATE, amounts
as DOUBLE with unparsable values -> 0) and drop rows without a key, so every
operator downstream can rely on clean inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.functions.columns import to_double, to_date_col


@dataclass
class SourceTables:
    orders: DataFrame
    balances: DataFrame
    positions: DataFrame
    bookings: DataFrame | None
    files: DataFrame | None = None

    def typed(self) -> "SourceTables":
        return SourceTables(
            orders=typed_orders(self.orders),
            balances=typed_balances(self.balances),
            positions=typed_positions(self.positions),
            bookings=None if self.bookings is None else typed_bookings(self.bookings),
            files=self.files,
        )


def _with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Create optional columns that a source may lack (typed NULL/default)."""
    for name, value in defaults.items():
        if name not in df.columns:
            df = df.withColumn(name, value)
    return df


def typed_orders(df: DataFrame) -> DataFrame:
    df = _with_defaults(df, {
        "Ordertyp": F.lit(None).cast("string"),
        "Cashflow": F.lit(None).cast("double"),
        "ISIN": F.lit(None).cast("string"),
        "Transaktionsnummer": F.lit(None).cast("string"),
        "Bemerkung": F.lit(None).cast("string"),
        "Datei_ID": F.lit(None).cast("bigint"),
    })
    return (df.select(
        F.col("Depotnummer").cast("string").alias("Depotnummer"),
        to_date_col("Orderdatum").alias("Orderdatum"),
        F.col("Ordertyp").cast("string").alias("Ordertyp"),
        F.coalesce(to_double("Cashflow"), F.lit(0.0)).alias("Cashflow"),
        F.col("ISIN").cast("string").alias("ISIN"),
        F.col("Transaktionsnummer").cast("string").alias("Transaktionsnummer"),
        F.col("Bemerkung").cast("string").alias("Bemerkung"),
        F.col("Datei_ID").cast("bigint").alias("Datei_ID"),
    ).where(F.col("Depotnummer").isNotNull() & F.col("Orderdatum").isNotNull()))


def typed_balances(df: DataFrame) -> DataFrame:
    df = _with_defaults(df, {"Datei_ID": F.lit(None).cast("bigint")})
    return (df.select(
        F.col("Kontoreferenz").cast("string").alias("Kontoreferenz"),
        to_date_col("Datum").alias("Datum"),
        F.coalesce(to_double("Saldosollwert"), F.lit(0.0)).alias("Saldosollwert"),
        F.col("Datei_ID").cast("bigint").alias("Datei_ID"),
    ).where(F.col("Kontoreferenz").isNotNull() & F.col("Datum").isNotNull()))


def typed_positions(df: DataFrame) -> DataFrame:
    df = _with_defaults(df, {
        "Wertpapierreferenz": F.lit(None).cast("string"),
        "Wertpapiername": F.lit(None).cast("string"),
        "Wertpapiertyp": F.lit(None).cast("string"),
        "Einstandswerte": F.lit(None).cast("double"),
        "Datei_ID": F.lit(None).cast("bigint"),
    })
    return (df.select(
        F.col("Depotreferenz").cast("string").alias("Depotreferenz"),
        to_date_col("Datum").alias("Datum"),
        F.col("Wertpapierreferenz").cast("string").alias("Wertpapierreferenz"),
        F.coalesce(F.col("Wertpapiername").cast("string"), F.lit("")).alias("Wertpapiername"),
        F.coalesce(F.col("Wertpapiertyp").cast("string"), F.lit("")).alias("Wertpapiertyp"),
        F.coalesce(to_double("Kurswert"), F.lit(0.0)).alias("Kurswert"),
        to_double("Einstandswerte").alias("Einstandswerte"),
        F.col("Datei_ID").cast("bigint").alias("Datei_ID"),
    ).where(F.col("Depotreferenz").isNotNull() & F.col("Datum").isNotNull()))


def booking_type_column(df: DataFrame) -> str:
    """Bookings carry the type as ``Buchungtyp`` or, in older extracts, ``Buchungstyp``."""
    if "Buchungtyp" in df.columns:
        return "Buchungtyp"
    if "Buchungstyp" in df.columns:
        return "Buchungstyp"
    return ""


def typed_bookings(df: DataFrame) -> DataFrame:
    type_col = booking_type_column(df)
    typ = F.col(type_col).cast("string") if type_col else F.lit(None).cast("string")
    df = _with_defaults(df, {
        "Bemerkung": F.lit(None).cast("string"),
        "Buchungdatum": F.col("Valutadatum"),
    })
    return (df.select(
        F.col("Kontoreferenz").cast("string").alias("Kontoreferenz"),
        to_date_col("Valutadatum").alias("Valutadatum"),
        to_date_col("Buchungdatum").alias("Buchungdatum"),
        F.coalesce(to_double("Betrag"), F.lit(0.0)).alias("Betrag"),
        F.coalesce(typ, F.lit("")).alias("Buchungtyp"),
        F.coalesce(F.col("Bemerkung").cast("string"), F.lit("")).alias("Bemerkung"),
    ).where(F.col("Kontoreferenz").isNotNull()))


def read_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> SourceTables:
    """Read the five source tables stored as ``<base>/<name>`` (parquet by default;
    ``csv`` by ``sources.csv_files``, which also reports the rows it rejects).

    The bookings table and the file catalog are optional: where their path
    does not exist the features are computed without money flows, or without
    a catalog. Any other failure (a damaged file, no access) is raised.
    """
    if fmt == "csv":
        from depotlens.sources.csv_files import read_csv_tables
        return read_csv_tables(spark, base)[0]

    def load(name: str) -> DataFrame:
        return spark.read.format(fmt).load(f"{base}/{name}")

    def optional(name: str) -> DataFrame | None:
        return load(name) if path_exists(spark, f"{base}/{name}") else None

    return SourceTables(load("cd_order"), load("cd_saldo"), load("cd_bestand"), optional("cd_buchung"),
                        optional("cd_datei"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists in its (Hadoop) file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def day_load(tables: SourceTables, day, require_checked: bool = False) -> SourceTables:
    """The tables as loaded on one file day.

    With U and B the day's order and snapshot file: orders with
    ``Datei_ID <= U``, balances and positions with ``Datei_ID = B`` only, so a
    depot that is no longer in the snapshot file has an empty portfolio. If
    either file is missing, nothing is loaded. Bookings carry no file id and
    stay as they are. The ids are scalar subqueries over the catalog and reach
    the scans as literals.
    """
    from depotlens.operators.files import complete_days

    if tables.files is None:
        raise ValueError("a day load needs the file catalog")
    files = complete_days(tables.files, require_checked).where(F.col("Datum") == F.lit(str(day)).cast("date"))
    u = files.select(F.max("DateiID_U")).scalar()
    b = files.select(F.max("DateiID_B")).scalar()
    return SourceTables(
        orders=tables.orders.where(F.col("Datei_ID") <= u),
        balances=tables.balances.where(F.col("Datei_ID") == b),
        positions=tables.positions.where(F.col("Datei_ID") == b),
        bookings=tables.bookings,
        files=tables.files,
    )


def read_jdbc_tables(spark: SparkSession, url: str, properties: dict, schema: str = "dbo") -> SourceTables:
    """Same bundle read through JDBC (connection options come from the caller)."""
    def load(name: str) -> DataFrame:
        return spark.read.jdbc(url, f"{schema}.{name}", properties=properties)

    return SourceTables(load("cd_Order"), load("cd_Saldo"), load("cd_Bestand"),
                        load("cd_Buchung"), load("cd_Datei"))
