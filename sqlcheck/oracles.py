"""Oracle SQL per registered query name (DuckDB dialect)."""

from __future__ import annotations

from sqlcheck.features_sql import BACKFILL_DATES, building_block_oracles, features_sql
from sqlcheck.labels_sql import label_oracles
from sqlcheck.metrics_sql import metric_oracles
from sqlcheck.ml_sql import ml_oracles
from sqlcheck.quality_sql import quality_oracles
from sqlcheck.rules_sql import rule_oracles
from sqlcheck.stores_sql import store_oracles

ORACLES: dict[str, str] = {
    "depot_features": features_sql(),
    "depot_features_backfill": features_sql(BACKFILL_DATES),
}
ORACLES.update(building_block_oracles())
ORACLES.update(rule_oracles())
ORACLES.update(label_oracles())
ORACLES.update(metric_oracles())
ORACLES.update(quality_oracles())
ORACLES.update(ml_oracles())
ORACLES.update(store_oracles())
