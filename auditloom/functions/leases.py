"""Lease predicates and decisions over job columns.

Every function takes columns (or structs with the job fields) and a `now`
column, so a whole table is decided in one projection.
"""

from pyspark.sql import functions as F

from auditloom import fixed


def within(ts, window, default, now):
    """`now - ts <= window`, inclusive; `default` where there is no time."""
    return F.coalesce(ts >= now - F.expr(f"interval {window}"), F.lit(default))


def _is(status, *values):
    return F.coalesce(status.isin(*values), F.lit(False))


def retry_active(job, now):
    """A failed job whose queue still has attempts left to make."""
    left = F.coalesce(job["attempts"].between(1, fixed.MAX_ATTEMPTS - 1), F.lit(False))
    return (
        _is(job["status"], fixed.FAILED_RETRY, fixed.FAILED_PERMANENT)
        & left
        & within(job["last_processed_at"], fixed.RETRY_WINDOW, False, now)
    )


def in_flight(job, now):
    status = job["status"]
    return (
        (_is(status, fixed.QUEUED) & within(job["queued_at"], fixed.IN_FLIGHT_WINDOW, True, now))
        | (
            _is(status, fixed.PROCESSING)
            & within(job["last_processed_at"], fixed.IN_FLIGHT_WINDOW, True, now)
        )
        | retry_active(job, now)
    )


def deleting_active(job, now):
    return _is(job["status"], fixed.DELETING) & within(
        job["deleting_at"], fixed.DELETE_WINDOW, True, now
    )


def active(job, now):
    return _is(job["status"], fixed.PROCESSED) | in_flight(job, now)


def reconcile(job, exists, event_generation, now):
    """(outcome, delete_superseded_rows) of one event against one job."""
    busy = in_flight(job, now) | deleting_active(job, now)
    covered = active(job, now)
    known, stored = event_generation, job["generation"]
    skip, queue, defer = (
        F.lit(fixed.OUTCOME_SKIPPED),
        F.lit(fixed.OUTCOME_QUEUED),
        F.lit(fixed.OUTCOME_DEFERRED),
    )
    outcome = (
        F.when(~exists, queue)
        .when(known.isNull() & deleting_active(job, now), defer)
        .when(known.isNull(), F.when(covered, skip).otherwise(queue))
        .when(known < stored, skip)
        .when(
            known == stored,
            F.when(covered | deleting_active(job, now), skip).otherwise(queue),
        )
        .when(busy, defer)
        .otherwise(queue)
    )
    newer = F.coalesce(known > stored, F.lit(True))
    return outcome, exists & known.isNotNull() & newer & ~busy
