"""Loads and reports composed from the operators."""

from starloom.plans.loads import (
    Layout,
    StepReport,
    build_fact,
    clean_step,
    full_load,
    ingest,
    open_mart,
    publish_views,
    report_frame,
    transform,
    upsert_dimensions,
)

__all__ = [
    "Layout",
    "StepReport",
    "build_fact",
    "clean_step",
    "full_load",
    "ingest",
    "open_mart",
    "publish_views",
    "report_frame",
    "transform",
    "upsert_dimensions",
]
