"""Source tables: typed loaders, file catalog and derived test-data views."""

from depotlens.sources.catalog import SourceTables, read_tables  # noqa: F401
