"""Audits of partitioned parquet lakes as Spark jobs."""

from .plans.audit import Audit, audit
from .plans.baseline import Snapshots
from .plans.datasets import CONTRACT, REQUIRED_DATASETS
from .plans.rules import RULES
from .session import build_session
from .sinks.report import write_report
from .sources.manifest import build_manifest, discover_days
from .streaming.runner import Step, drain, review_next

__all__ = [
    "Audit",
    "CONTRACT",
    "REQUIRED_DATASETS",
    "RULES",
    "Step",
    "Snapshots",
    "audit",
    "build_manifest",
    "build_session",
    "discover_days",
    "drain",
    "review_next",
    "write_report",
]
