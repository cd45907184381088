"""Registered queries over the given tables, each with an independent SQL oracle."""

from tierline.suite import (  # noqa: F401
    survey_queries,
    shape_queries,
    step_queries,
    source_queries,
    table_queries,
    publish_queries,
    incremental_queries,
    run_queries,
)
from tierline.suite.registry import ENTRIES

__all__ = ["ENTRIES"]
