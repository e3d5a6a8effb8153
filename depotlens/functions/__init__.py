"""Scalar column functions of the engine (pure ``pyspark.sql.functions``)."""

from depotlens.functions.columns import (  # noqa: F401
    clip, epoch_day, half_up_decimal, month_index, parse_localized_number, safe_div, to_date_col, to_double,
)
from depotlens.functions.text import flow_class, flow_class_alt, is_internal, tech_hit  # noqa: F401
