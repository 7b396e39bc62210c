"""Registered queries: operators bound to tables, each beside its SQL."""

from ledgerforge.plans import browse, coverage, documents, quality, reports, usage, views, weekly  # noqa: F401
from ledgerforge.plans.registry import ORACLES, QUERIES  # noqa: F401
