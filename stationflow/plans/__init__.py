from stationflow.plans.reports import (
    VARIANTS,
    ordered,
    original_layout,
    top_connections,
    top_connections_time,
    top_times,
    total_connections_report,
    total_times_report,
    variant_reports,
)
from stationflow.plans.run import materialized_stats, run_variant

__all__ = [
    "VARIANTS",
    "materialized_stats",
    "ordered",
    "original_layout",
    "run_variant",
    "top_connections",
    "top_connections_time",
    "top_times",
    "total_connections_report",
    "total_times_report",
    "variant_reports",
]
