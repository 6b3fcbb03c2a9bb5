"""Checked queries: job state."""

from pyspark.sql import functions as F

from auditloom.operators import events, jobs
from auditloom.plans import standins as S
from auditloom.plans.registry import query

DECISIONS = """
, finalized as (select * from object_events where kind = 'finalize'
  and (lower(gcs_uri) like '%.jpg' or lower(gcs_uri) like '%.jpeg' or lower(gcs_uri) like '%.png')),
latest as (
  select gcs_uri, generation, event_id from (select *, row_number() over
    (partition by gcs_uri order by generation desc, event_id desc) as rn
  from finalized where generation is not null) t where rn = 1),
j as (select *,
  coalesce((status = 'QUEUED' and age_min <= 120) or (status = 'PROCESSING' and age_min <= 120)
    or (status in ('FAILED_RETRY', 'FAILED_PERMANENT') and attempts between 1 and 4 and age_min <= 10), false) as busy,
  (status = 'DELETING' and age_min <= 10) as leased from jobs_by_age),
decided as (
  select e.event_id, e.gcs_uri, p.prompt_version_id, e.generation as g, j.generation as sg, j.status, j.attempts,
    j.age_min, j.error_message, j.gcs_uri is null as fresh,
    case when j.gcs_uri is null then 'queued'
      when e.generation is null then case when leased then 'deferred_in_flight'
        when status = 'PROCESSED' or busy then 'skipped' else 'queued' end
      when j.generation is not null and e.generation < j.generation then 'skipped'
      when j.generation is not null and e.generation = j.generation
        then case when status = 'PROCESSED' or busy or leased then 'skipped' else 'queued' end
      when busy or leased then 'deferred_in_flight' else 'queued' end as outcome,
    coalesce(j.gcs_uri is not null and e.generation is not null
      and (j.generation is null or e.generation > j.generation) and not (busy or leased), false) as delete_superseded_rows
  from {source} e cross join versions p
  left join j on j.gcs_uri = e.gcs_uri and j.prompt_version_id = p.prompt_version_id)
"""
ALL_EVENTS = DECISIONS.format(source="finalized")
NEWEST = DECISIONS.format(source="latest")
VIEWS = "object_events versions jobs_by_age"


def arrivals(spark, sf_dir):
    return events.supported_images(S.finalize_events(spark, sf_dir), "gcs_uri")


def decisions(spark, sf_dir, newest=False):
    rows = arrivals(spark, sf_dir)
    if newest:
        rows = events.latest_generation(rows)
    return jobs.reconcile(rows, S.view(spark, sf_dir, "versions"), S.jobs(spark, sf_dir), S.now())


@query(
    "reconcile",
    S.with_views(
        VIEWS,
        ALL_EVENTS + "select event_id, prompt_version_id, outcome, delete_superseded_rows from decided",
    ),
)
def reconcile(spark, sf_dir):
    return decisions(spark, sf_dir).select(
        "event_id", "prompt_version_id", "outcome", "delete_superseded_rows"
    )


@query(
    "event_summary",
    S.with_views(
        VIEWS,
        ALL_EVENTS
        + """
        , d as (select *, outcome = 'queued' and (event_id + cast(substr(prompt_version_id, 2) as bigint)) % 19 = 0
            as failed from decided),
        g as (select event_id, cast(sum(case when outcome = 'queued' and not failed then 1 else 0 end) as bigint)
            as tasks_created,
          coalesce(string_agg(case when outcome = 'deferred_in_flight' then prompt_version_id end, ','
            order by prompt_version_id), '') as deferred_versions,
          coalesce(string_agg(case when failed then prompt_version_id end, ',' order by prompt_version_id), '')
            as failed_versions from d group by event_id)
        select *, case when failed_versions <> '' then 'error' when deferred_versions <> '' then 'deferred'
          else 'success' end as status from g""",
    ),
)
def event_summary(spark, sf_dir):
    broken = F.filter(
        F.array(F.lit("v1"), F.lit("v2")),
        lambda v: (F.col("event_id") + F.substr(v, F.lit(2)).cast("bigint")) % 19 == 0,
    )
    summary = jobs.event_summary(
        arrivals(spark, sf_dir),
        S.view(spark, sf_dir, "versions"),
        S.jobs(spark, sf_dir),
        S.now(),
        failed=broken,
    )
    return summary.select(
        "event_id",
        "tasks_created",
        F.array_join("deferred_versions", ",").alias("deferred_versions"),
        F.array_join("failed_versions", ",").alias("failed_versions"),
        "status",
    )


@query(
    "job_state",
    S.with_views(
        VIEWS,
        """select e.event_id, p.prompt_version_id, j.status, sha256(e.gcs_uri || ':' || p.prompt_version_id) as job_id
           from object_events e cross join versions p left join jobs_by_age j
             on j.gcs_uri = e.gcs_uri and j.prompt_version_id = p.prompt_version_id
           where e.kind = 'finalize'""",
    ),
)
def job_state(spark, sf_dir):
    rows = events.fan_out(S.finalize_events(spark, sf_dir), S.view(spark, sf_dir, "versions"))
    joined = jobs.with_job_state(jobs.with_job_id(rows), S.jobs(spark, sf_dir))
    return joined.select(
        "event_id", "prompt_version_id", F.col("job.status").alias("status"), "job_id"
    )


PLAN = """
, j as (select *,
  coalesce((status = 'QUEUED' and age_min <= 120) or (status = 'PROCESSING' and age_min <= 120)
    or (status in ('FAILED_RETRY', 'FAILED_PERMANENT') and attempts between 1 and 4 and age_min <= 10)
    or (status = 'DELETING' and age_min <= 10), false) as busy from jobs_by_age),
plan as (
  select e.event_id, e.gcs_uri,
    case when bool_or(coalesce(j.generation > e.generation, false)) then 'skip_stale_generation'
      when bool_or(coalesce(busy, false)) then 'defer_in_flight' else 'delete' end as action,
    count(j.gcs_uri) as n
  from object_events e left join j on j.gcs_uri = e.gcs_uri where e.kind = 'delete'
  group by e.event_id, e.gcs_uri)
"""
PLAN_VIEWS = "object_events jobs_by_age"


def plan(spark, sf_dir):
    return jobs.delete_plan(S.delete_events(spark, sf_dir), S.jobs(spark, sf_dir), S.now())


@query(
    "delete_plan",
    S.with_views(
        PLAN_VIEWS,
        PLAN
        + "select event_id, action, cast(case when action = 'delete' then n else 0 end as bigint) as target_jobs from plan",
    ),
)
def delete_plan(spark, sf_dir):
    return plan(spark, sf_dir).select("event_id", "action", "target_jobs")


GONE = "(select gcs_uri from plan where action = 'delete')"


@query(
    "delete_lease",
    S.with_views(
        PLAN_VIEWS,
        PLAN
        + f"""select gcs_uri, prompt_version_id, 'DELETING' as status, status as status_before, attempts
              from jobs_by_age where gcs_uri in {GONE}""",
    ),
)
def delete_lease(spark, sf_dir):
    leased = jobs.lease_delete(S.jobs(spark, sf_dir), plan(spark, sf_dir), S.now())
    return leased.select(
        "gcs_uri", "prompt_version_id", "status", F.col("before.status").alias("status_before"), "attempts"
    )


@query(
    "delete_rollback",
    S.with_views(
        PLAN_VIEWS,
        PLAN
        + f"""select gcs_uri, prompt_version_id,
                case when gcs_uri like '%.JPEG' then 'FAILED_RETRY' else status end as status,
                case when gcs_uri like '%.JPEG' then 5 else attempts end as attempts,
                gcs_uri not like '%.JPEG' and status = 'DELETING' as leased
              from jobs_by_age where gcs_uri in {GONE}""",
    ),
)
def delete_rollback(spark, sf_dir):
    leased = jobs.lease_delete(S.jobs(spark, sf_dir), plan(spark, sf_dir), S.now())
    undone = jobs.rollback_delete(leased, F.col("gcs_uri").endswith(".JPEG"))
    return undone.select(
        "gcs_uri", "prompt_version_id", "status", "attempts", F.col("deleting_at").isNotNull().alias("leased")
    )


@query(
    "job_purge",
    S.with_views(
        PLAN_VIEWS,
        PLAN + f"select gcs_uri, prompt_version_id, status from jobs_by_age where gcs_uri not in {GONE}",
    ),
)
def job_purge(spark, sf_dir):
    kept = jobs.purge_jobs(S.jobs(spark, sf_dir), plan(spark, sf_dir))
    return kept.select("gcs_uri", "prompt_version_id", "status")


@query(
    "job_claim",
    S.with_views(
        VIEWS,
        NEWEST
        + """select gcs_uri, prompt_version_id, 'QUEUED' as status, g as generation, cast(null as bigint) as attempts,
               status as status_before, delete_superseded_rows
             from decided where outcome = 'queued'""",
    ),
)
def job_claim(spark, sf_dir):
    claimed = jobs.claim(decisions(spark, sf_dir, newest=True), S.now())
    return claimed.select(
        "gcs_uri", "prompt_version_id", "status", "generation", "attempts",
        F.col("before.status").alias("status_before"), "delete_superseded_rows",
    )


# A dispatch breaks where the new generation divides by 3.
@query(
    "claim_rollback",
    S.with_views(
        VIEWS,
        NEWEST
        + """
        , c as (select *, g % 3 = 0 as broken from decided where outcome = 'queued')
        select gcs_uri, prompt_version_id,
          case when broken and delete_superseded_rows then 'FAILED_RETRY' when broken then status else 'QUEUED' end as status,
          case when broken and not delete_superseded_rows then sg else g end as generation,
          cast(case when broken and delete_superseded_rows then 5 when broken then attempts end as bigint) as attempts,
          case when broken and not delete_superseded_rows then error_message end as error_message
        from c where not (broken and fresh)""",
    ),
)
def claim_rollback(spark, sf_dir):
    claimed = jobs.claim(decisions(spark, sf_dir, newest=True), S.now())
    undone = jobs.rollback(claimed, F.col("generation") % 3 == 0, F.col("delete_superseded_rows"))
    return undone.select(
        "gcs_uri", "prompt_version_id", "status", "generation", "attempts", "error_message"
    )


# Partial changes: each event sets the attempts, every third one also the status.
S.SQL["changes"] = f"""
select {S.uri_sql('user_id')} as gcs_uri, 'v' || cast(1 + event_id % 3 as string) as prompt_version_id,
  case when event_id % 3 = 0 then 'PROCESSED' when event_id % 7 = 0 then 'FAILED_RETRY' end as status,
  case when event_id % 5 = 0 then event_id end as generation, event_id % 6 as attempts,
  case when event_id % 4 = 0 then 'note ' || cast(event_id as string) end as error_message, event_id as seq
from $events"""


@query(
    "job_upsert",
    S.with_views(
        "jobs_by_age changes",
        """
        , c as (select gcs_uri, prompt_version_id, arg_max(status, case when status is not null then seq end) as status,
          arg_max(generation, case when generation is not null then seq end) as generation,
          arg_max(attempts, seq) as attempts,
          arg_max(error_message, case when error_message is not null then seq end) as error_message
          from changes group by gcs_uri, prompt_version_id)
        select coalesce(c.gcs_uri, j.gcs_uri) as gcs_uri,
          coalesce(c.prompt_version_id, j.prompt_version_id) as prompt_version_id,
          coalesce(c.status, j.status) as status, coalesce(c.generation, j.generation) as generation,
          coalesce(c.attempts, j.attempts) as attempts, coalesce(c.error_message, j.error_message) as error_message
        from jobs_by_age j full outer join c
          on c.gcs_uri = j.gcs_uri and c.prompt_version_id = j.prompt_version_id""",
    ),
)
def job_upsert(spark, sf_dir):
    raw = S.view(spark, sf_dir, "changes")
    empty = F.lit(None).cast("timestamp")
    changes = raw.select(
        "*", *[empty.alias(c) for c in ("queued_at", "last_processed_at", "deleting_at")]
    )
    merged = jobs.upsert_jobs(S.jobs(spark, sf_dir), jobs.collapse_changes(changes, "seq"))
    return merged.select(
        "gcs_uri", "prompt_version_id", "status", "generation", "attempts", "error_message"
    )


S.SQL["outcomes"] = """
select gcs_uri, prompt_version_id, 1 + u % 5 as attempt, u % 3 <> 0 as ok,
  case when u % 3 = 0 then 'late failure' when u % 8 = 0 then 'unknown version' end as error_message, u % 8 <> 0 as configured
from (select * from $jobs where status <> 'DELETING') t"""
S.SQL["outcomes"] = S.SQL["outcomes"].replace("$jobs", f"({S.SQL['jobs_by_age']}) a", 1)


@query(
    "job_advance",
    S.with_views(
        "jobs_by_age outcomes",
        """
        select j.gcs_uri, j.prompt_version_id,
          case when r.gcs_uri is null then j.status when not configured then 'FAILED_PERMANENT'
            when ok then 'PROCESSED' else 'FAILED_RETRY' end as status,
          coalesce(r.attempt, j.attempts) as attempts,
          case when r.gcs_uri is not null and not (ok and configured)
            then coalesce(r.error_message, j.error_message) else j.error_message end as error_message
        from jobs_by_age j left join outcomes r
          on r.gcs_uri = j.gcs_uri and r.prompt_version_id = j.prompt_version_id""",
    ),
)
def job_advance(spark, sf_dir):
    after = jobs.advance(S.jobs(spark, sf_dir), S.view(spark, sf_dir, "outcomes"), S.now())
    return after.select("gcs_uri", "prompt_version_id", "status", "attempts", "error_message")


@query(
    "expired_leases",
    S.with_views(
        "jobs_by_age",
        """select gcs_uri, prompt_version_id, status from jobs_by_age
           where (status in ('QUEUED', 'PROCESSING') and age_min > 120) or (status = 'DELETING' and age_min > 10)""",
    ),
)
def expired_leases(spark, sf_dir):
    return jobs.expired_leases(S.jobs(spark, sf_dir), S.now()).select(
        "gcs_uri", "prompt_version_id", "status"
    )


@query(
    "attempt_numbers",
    f"""
    select event_id, row_number() over (partition by user_id, event_id % 2 order by ts, event_id) as attempt
    from events""",
)
def attempt_numbers(spark, sf_dir):
    errors = S.table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        F.concat(F.lit("gs://audit/img"), F.col("user_id").cast("string")).alias("gcs_uri"),
        F.concat(F.lit("v"), (F.col("event_id") % 2).cast("string")).alias("prompt_version_id"),
    )
    return jobs.attempt_numbers(errors, "ts", "event_id").select("event_id", "attempt")
