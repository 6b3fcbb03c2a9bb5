"""All checked queries."""

from auditloom.plans import (  # noqa: F401
    checks_config,
    checks_events,
    checks_jobs,
    checks_responses,
    checks_streams,
    checks_tables,
    checks_work,
)
from auditloom.plans.registry import ORACLES, QUERIES  # noqa: F401
