"""Source tables from CSV files with a header; rows that do not fit are kept apart.

Every known column has a declared type, other columns are text, so nothing is
guessed from the data. The columns may stand in any order, but all files of a
table must have the same header. A line that has too few or too many fields, or
a field that is no number or date where one is declared, is rejected as
``malformed``; a row without its key or its date is rejected as ``no key`` or
``no date``. Rejected rows come back in a second table with the reason, so a
damaged delivery is seen instead of read as empty values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.sources.catalog import SourceTables, path_exists

_LINE = "_corrupt_record"

#: Declared types by table; the first column named is the key, the first date the row's date. Other columns are text.
TYPES = {
    "cd_order": {"Depotnummer": "string", "Orderdatum": "date", "Cashflow": "double", "Datei_ID": "bigint"},
    "cd_saldo": {"Kontoreferenz": "string", "Datum": "date", "Saldosollwert": "double", "Datei_ID": "bigint"},
    "cd_bestand": {"Depotreferenz": "string", "Datum": "date", "Kurswert": "double", "Einstandswerte": "double", "Datei_ID": "bigint"},
    "cd_buchung": {"Kontoreferenz": "string", "Valutadatum": "date", "Buchungdatum": "date", "Betrag": "double"},
    "cd_datei": {"DateiID": "bigint", "Datum": "date", "Pruefziffer": "int"},
}


def read_csv(spark: SparkSession, path: str, table: str, sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of one table. rejected: table_name, reason, line (the row as text)."""
    declared = TYPES[table]
    names = spark.read.option("header", True).option("sep", sep).csv(path).columns  # reads a header
    key = next(iter(declared))
    date = next(c for c, t in declared.items() if t == "date")
    missing = [c for c in (key, date) if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = ", ".join(f"`{c}` string" for c in names) + f", {_LINE} string"
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("sep", sep).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _LINE).option("columnPruning", False).csv(path))
    # Lines are always parsed whole, fields are read as text and cast here: what is malformed must not depend on the columns a query needs.
    typed = {c: F.col(f"`{c}`").try_cast(t) for c, t in declared.items() if c in names and t != "string"}
    unfit = F.lit(False)
    for c, value in typed.items():
        unfit = unfit | (F.col(f"`{c}`").isNotNull() & value.isNull())
    reason = (F.when(F.col(_LINE).isNotNull() | unfit, "malformed").when(F.col(f"`{key}`").isNull(), "no key")
              .when(F.col(f"`{date}`").isNull(), "no date"))
    line = F.coalesce(F.col(_LINE), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]), {"sep": sep}))
    rejected = rows.where(reason.isNotNull()).select(F.lit(table).alias("table_name"), reason.alias("reason"), line.alias("line"))
    return rows.where(reason.isNull()).select(*[typed.get(c, F.col(f"`{c}`")).alias(c) for c in names]), rejected


def read_csv_tables(spark: SparkSession, base: str, sep: str = ",") -> tuple[SourceTables, DataFrame]:
    """The source tables stored as CSV folders ``<base>/<name>``, and the rejected rows of all of them.

    Bookings and the file catalog may be absent, as with ``read_tables``.
    """
    found = {}
    for name in TYPES:
        if name in ("cd_buchung", "cd_datei") and not path_exists(spark, f"{base}/{name}"):
            continue
        found[name] = read_csv(spark, f"{base}/{name}", name, sep)
    rows = {name: pair[0] for name, pair in found.items()}
    rejected = reduce(DataFrame.unionByName, [pair[1] for pair in found.values()])
    tables = SourceTables(rows["cd_order"], rows["cd_saldo"], rows["cd_bestand"], rows.get("cd_buchung"), rows.get("cd_datei"))
    return tables, rejected


def rejected_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows by table and reason."""
    return rejected.groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n"))
