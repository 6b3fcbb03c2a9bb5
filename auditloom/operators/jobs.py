"""Job state: reconcile, delete plans, claims, transitions and reports.

A job is one row per (gcs_uri, prompt_version_id). `now` is always given as a
column, so a run is repeatable.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions import leases, objects
from auditloom.operators.events import fan_out, version_list
from auditloom.operators.joins import folded, unique
from auditloom.session import shared_dir

KEY = ["gcs_uri", "prompt_version_id"]
FIELDS = [
    "status",
    "queued_at",
    "generation",
    "attempts",
    "last_processed_at",
    "error_message",
    "deleting_at",
]


def _fields():
    return F.struct(*FIELDS)


def _null(field):
    kinds = {"status": "string", "error_message": "string", "generation": "bigint", "attempts": "bigint"}
    return F.lit(None).cast(kinds.get(field, "timestamp"))


def with_job_id(df):
    return df.withColumn(
        "job_id", objects.job_id(F.col("gcs_uri"), F.col("prompt_version_id"))
    )


def with_job_state(df, jobs):
    """Each row with the struct `job` of its own job, NULL when there is none."""
    state = jobs.select(*KEY, _fields().alias("job"))
    return df.join(state, KEY, "left")


def _with_object_jobs(events, versions, jobs):
    """Each event with `job_map`: version -> job of its object.

    The jobs of one object are folded into one row first (at most one per
    configured version), so events are shuffled once and not once per version,
    and the join stays a plain two-sided one that AQE can split when an object
    is hot.
    """
    current = jobs.join(versions.select("prompt_version_id"), "prompt_version_id", "left_semi")
    # Of repeated rows of one job the last in sorted order stays, as the session is set to.
    entries = F.array_sort(F.collect_list(F.struct("prompt_version_id", _fields().alias("job"))))
    per_object = folded(current, "gcs_uri", F.map_from_entries(entries).alias("job_map"))
    return events.join(per_object, "gcs_uri", "left")


def reconcile(events, versions, jobs, now):
    """One decision per event and configured version.

    Adds prompt_version_id, `job` (previous state or NULL), outcome and
    delete_superseded_rows.
    """
    rows = (
        fan_out(_with_object_jobs(events, versions, jobs), versions)
        .withColumn("job", F.try_element_at("job_map", F.col("prompt_version_id")))
        .drop("job_map")
    )
    job = F.col("job")
    outcome, superseded = leases.reconcile(job, job.isNotNull(), F.col("generation"), now)
    return rows.withColumn("outcome", outcome).withColumn("delete_superseded_rows", superseded)


def event_summary(events, versions, jobs, now, failed=None):
    """One row per event: tasks created, deferred and failed versions, status.

    All versions of an event are decided inside its row, so the summary costs
    no shuffle beyond the look-up of the object's jobs, and equal events stay
    rows of their own. `failed` is an array column of versions whose dispatch
    broke.
    """
    failed = F.array().cast("array<string>") if failed is None else failed
    kept = list(events.columns)
    wide = _with_object_jobs(events, versions, jobs).withColumn("versions", version_list(versions))

    def decide(version):
        job = F.try_element_at("job_map", version)
        outcome, _ = leases.reconcile(job, job.isNotNull(), F.col("generation"), now)
        return F.struct(version.alias("version"), outcome.alias("outcome"))

    decided = wide.withColumn("decisions", F.transform("versions", decide))

    def pick(outcome):
        chosen = F.filter("decisions", lambda d: d["outcome"] == F.lit(outcome))
        return F.transform(chosen, lambda d: d["version"])

    queued = pick(fixed.OUTCOME_QUEUED)
    deferred, broken = F.col("deferred_versions"), F.col("failed_versions")
    return (
        decided.withColumn("deferred_versions", pick(fixed.OUTCOME_DEFERRED))
        .withColumn("failed_versions", F.array_sort(F.array_intersect(queued, failed)))
        .withColumn("tasks_created", (F.size(queued) - F.size(broken)).cast("bigint"))
        .withColumn(
            "status",
            F.when(F.size(broken) > 0, "error")
            .when(F.size(deferred) > 0, "deferred")
            .otherwise("success"),
        )
        .select(*kept, "tasks_created", "deferred_versions", "failed_versions", "status")
    )


def delete_plan(deletes, jobs, now):
    """What each delete event does to its object's jobs.

    A stored generation newer than the event wins over everything, then any
    busy job defers. Both tests only need a maximum and an OR over the jobs,
    which are reduced to one row per object before the join.
    """
    job = {f: F.col(f) for f in FIELDS}
    per_object = folded(
        jobs,
        "gcs_uri",
        F.max("generation").alias("newest"),
        F.bool_or(leases.in_flight(job, now) | leases.deleting_active(job, now)).alias("busy"),
        F.count("*").alias("jobs"),
    )
    skip = F.coalesce(F.col("newest") > F.col("generation"), F.lit(False))
    action = (
        F.when(skip, fixed.ACTION_SKIP)
        .when(F.coalesce("busy", F.lit(False)), fixed.ACTION_DEFER)
        .otherwise(fixed.ACTION_DELETE)
    )
    return (
        deletes.join(per_object, "gcs_uri", "left")
        .withColumn("action", action)
        .withColumn(
            "target_jobs",
            F.when(F.col("action") == fixed.ACTION_DELETE, F.coalesce("jobs", F.lit(0))).otherwise(
                F.lit(0)
            ).cast("bigint"),
        )
        .drop("newest", "busy", "jobs")
    )


def _deleted_objects(plan):
    return unique(plan.where(F.col("action") == fixed.ACTION_DELETE), "gcs_uri")


def lease_delete(jobs, plan, now):
    """Jobs of deleted objects, marked DELETING; `before` keeps the old fields."""
    return (
        jobs.join(_deleted_objects(plan), "gcs_uri", "left_semi")
        .withColumn("before", F.struct("status", "deleting_at"))
        .withColumn("status", F.lit(fixed.DELETING))
        .withColumn("deleting_at", now)
    )


def rollback_delete(leased, rows_deleted):
    """Undo a delete lease.

    `rows_deleted` is a boolean column: where the result rows are gone the job
    becomes retryable at once, elsewhere the old status and lease come back.
    """
    return (
        leased.withColumn(
            "attempts",
            F.when(rows_deleted, F.lit(fixed.MAX_ATTEMPTS).cast("bigint")).otherwise(F.col("attempts")),
        )
        .withColumn(
            "status", F.when(rows_deleted, fixed.FAILED_RETRY).otherwise(F.col("before.status"))
        )
        .withColumn("deleting_at", F.when(~rows_deleted, F.col("before.deleting_at")))
        .drop("before")
    )


def purge_jobs(jobs, plan):
    """Job table without the jobs of deleted objects."""
    return jobs.join(_deleted_objects(plan), "gcs_uri", "left_anti")


def claim(decisions, now):
    """QUEUED rows for decisions to queue, next to the state they replace.

    Expects one event per object (see `latest_generation`). Retry fields and,
    for an event without one, the generation are cleared. `before` is NULL for
    a fresh job.
    """
    written = {
        "status": F.lit(fixed.QUEUED),
        "queued_at": now,
        "generation": F.col("generation"),
    }
    return decisions.where(F.col("outcome") == fixed.OUTCOME_QUEUED).select(
        *KEY,
        *[written.get(f, _null(f)).alias(f) for f in FIELDS],
        F.col("job").alias("before"),
        "delete_superseded_rows",
    )


def rollback(claims, broken, rows_deleted):
    """Claimed jobs after some dispatches failed.

    `broken` and `rows_deleted` are boolean columns. A fresh broken claim is
    removed; one whose result rows are already gone becomes retryable at once;
    any other gets its previous fields back.
    """
    undo = broken & ~rows_deleted
    retry = {
        "status": F.lit(fixed.FAILED_RETRY),
        "attempts": F.lit(fixed.MAX_ATTEMPTS).cast("bigint"),
    }
    return claims.where(~(broken & F.col("before").isNull())).select(
        *KEY,
        *[
            F.when(undo, F.col("before")[f])
            .when(broken, retry.get(f, F.col(f)))
            .otherwise(F.col(f))
            .alias(f)
            for f in FIELDS
        ],
    )


def collapse_changes(changes, order_col):
    """Many partial changes of a job to one: the last value of every field.

    One maximum per field, so the changes of a hot job are merged before the
    shuffle.
    """
    return changes.groupBy(*KEY).agg(
        *[
            F.max_by(F.col(f), F.when(F.col(f).isNotNull(), F.col(order_col))).alias(f)
            for f in FIELDS
        ]
    )


def upsert_jobs(jobs, changes):
    """Merge changes by field: a NULL in a change leaves the stored value."""
    old, new = jobs.alias("o"), changes.alias("n")
    on = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in KEY]
    return old.join(new, on, "full_outer").select(
        *[F.coalesce(f"n.{c}", f"o.{c}").alias(c) for c in KEY + FIELDS]
    )


def replace_jobs(jobs, rows):
    """Job table with whole rows put in place of those of the same key."""
    return jobs.select(*KEY, *FIELDS).join(rows.select(*KEY), KEY, "left_anti").unionByName(
        rows.select(*KEY, *FIELDS)
    )


def start(jobs, tasks, now):
    """Job table with the jobs of `tasks` (with attempt) marked as being processed."""
    attempt = folded(tasks, KEY, F.max("attempt").cast("bigint").alias("attempts"))
    written = {"status": F.lit(fixed.PROCESSING), "attempts": F.col("attempts"), "last_processed_at": now}
    return upsert_jobs(jobs, attempt.select(*KEY, *[written.get(f, _null(f)).alias(f) for f in FIELDS]))


def advance(jobs, results, now):
    """Job table after worker results.

    `results` has one row per job: attempt, ok, error_message and configured
    (whether the version is known). The error text of an earlier attempt stays
    until a later one writes its own.
    """
    status = (
        F.when(~F.col("configured"), fixed.FAILED_PERMANENT)
        .when(F.col("ok"), fixed.PROCESSED)
        .otherwise(fixed.FAILED_RETRY)
    )
    changes = results.select(
        *KEY,
        status.alias("status"),
        _null("queued_at").alias("queued_at"),
        _null("generation").alias("generation"),
        F.col("attempt").cast("bigint").alias("attempts"),
        now.alias("last_processed_at"),
        F.when(~(F.col("ok") & F.col("configured")), F.nullif("error_message", F.lit(""))).alias(
            "error_message"
        ),
        _null("deleting_at").alias("deleting_at"),
    )
    return upsert_jobs(jobs, changes)


def expired_leases(jobs, now):
    """Jobs that hold a state past its lease and can be taken over."""
    job = {f: F.col(f) for f in FIELDS}
    held = F.col("status").isin(
        fixed.QUEUED, fixed.PROCESSING, fixed.DELETING
    )
    return jobs.where(held & ~leases.in_flight(job, now) & ~leases.deleting_active(job, now))


def attempt_numbers(errors, time_col, tie_col):
    """Number the attempts of each job by time, from 1.

    A job may own a large part of the table, in a burst even of one instant, so
    it is never ranked in one task. Rows are range-partitioned by (job, time,
    tie), which cuts a hot job into even parts whatever its times are, and
    written to the shared folder so that the parts stay as they are. Ranking
    then runs inside (job, part), and each part adds the counts of the earlier
    parts of its job, of which there are at most as many as partitions.
    """
    path = shared_dir(errors.sparkSession, "ranked")
    parts = errors.repartitionByRange(*KEY, time_col, tie_col)
    parts.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    rows = errors.sparkSession.read.parquet(path)

    group = [*KEY, "_part"]
    counts = rows.groupBy(*group).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*KEY).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group).orderBy(time_col, tie_col)
    return (
        rows.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, group)
        .withColumn("attempt", (F.col("_rank") + F.col("_before")).cast("bigint"))
        .drop("_part", "_rank", "_before")
    )
