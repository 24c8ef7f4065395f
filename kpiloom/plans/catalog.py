"""Import every query module so that the registry is complete."""

from kpiloom.plans import registry
from kpiloom.plans import q_analytics, q_climate_exports, q_core, q_custom, q_demo, q_derive, q_event_exports, q_exports, q_jobs, q_long, q_normalize, q_quality, q_series, q_sources, q_stream  # noqa: F401


def queries():
    return dict(registry.QUERIES)


def oracles():
    return dict(registry.ORACLES)
