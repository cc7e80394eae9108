"""Queries over the test tables that exercise every operator."""

from shelfmark.workload import (  # noqa: F401
    checks,
    ingestion,
    searching,
    shredding,
    state,
    stored,
    upserts,
)
from shelfmark.workload.registry import ORACLES, QUERIES  # noqa: F401
