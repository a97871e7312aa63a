"""Importing this module registers every query."""

from portolan.plans import (  # noqa: F401
    governance,
    incremental,
    ingest,
    messages,
    metrics,
    notes,
    sales,
    trade,
    versions,
)
from portolan.plans.registry import REGISTRY  # noqa: F401
