"""DuckDB SQL oracles for the registered queries (independent of the Spark code)."""
