"""Checked queries: Structured Streaming jobs run to the end of their input."""

import json

from pyspark.sql import functions as F

from auditloom.operators import events
from auditloom.plans import checks_responses
from auditloom.plans import standins as S
from auditloom.plans.registry import query
from auditloom.session import shared_dir
from auditloom.sources import tables
from auditloom.streaming import act, arrivals, ingest, reconcile, work


def event_stream(spark, sf_dir):
    """The driver's events as a stream of object events."""
    schema = S.table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    shaped = raw.selectExpr("cast(ts as timestamp) as ts", *S.OBJECT_EVENT)
    return events.supported_images(shaped, "gcs_uri")


FINALIZED = """
, fin as (select * from object_events where kind = 'finalize'
  and regexp_matches(lower(gcs_uri), '\\.(jpg|jpeg|png)$'))
"""


@query(
    "stream_reconcile",
    S.with_views(
        "object_events versions",
        FINALIZED
        + """select gcs_uri, prompt_version_id, max(generation) as generation from fin cross join versions
             group by gcs_uri, prompt_version_id""",
    ),
)
def stream_reconcile(spark, sf_dir):
    arrivals = event_stream(spark, sf_dir).where("kind = 'finalize'")
    decisions = reconcile.reconcile_stream(arrivals, ["v1", "v2"], settled=True)
    path = shared_dir(spark, "decisions")
    reconcile.start_decisions(decisions, path, shared_dir(spark, "state")).awaitTermination()
    queued = spark.read.parquet(path).where("outcome = 'queued'")
    return queued.groupBy("gcs_uri", "prompt_version_id").agg(F.max("generation").alias("generation"))


@query(
    "stream_decisions",
    S.with_views(
        "object_events versions",
        FINALIZED
        + """select gcs_uri, prompt_version_id, generation, count(*) as decisions from fin cross join versions
             group by gcs_uri, prompt_version_id, generation""",
    ),
)
def stream_decisions(spark, sf_dir):
    """Every arrival is decided once for each version, whatever is newer."""
    arrivals = event_stream(spark, sf_dir).where("kind = 'finalize'")
    decisions = reconcile.reconcile_stream(arrivals, ["v1", "v2"], settled=True)
    path = shared_dir(spark, "decisions")
    reconcile.start_decisions(decisions, path, shared_dir(spark, "state")).awaitTermination()
    made = spark.read.parquet(path).groupBy("gcs_uri", "prompt_version_id", "generation")
    return made.agg(F.count("*").alias("decisions"))


@query(
    "stream_delete",
    S.with_views(
        "object_events versions",
        """
        , e as (select * from object_events where regexp_matches(lower(gcs_uri), '\\.(jpg|jpeg|png)$')),
        newest as (select gcs_uri, max(generation) as g from e where kind = 'finalize' group by gcs_uri)
        select d.gcs_uri, bool_or(n.gcs_uri is null or d.generation is null or n.g is null or d.generation >= n.g) as deleted
        from e d left join newest n on n.gcs_uri = d.gcs_uri where d.kind = 'delete' group by d.gcs_uri""",
    ),
)
def stream_delete(spark, sf_dir):
    """Arrivals and deletes of one batch; a newer arrival protects its object."""
    decisions = reconcile.reconcile_stream(event_stream(spark, sf_dir), ["v1", "v2"], settled=True)
    path = shared_dir(spark, "decisions")
    reconcile.start_decisions(decisions, path, shared_dir(spark, "state")).awaitTermination()
    deletes = spark.read.parquet(path).where("kind = 'delete'")
    return deletes.groupBy("gcs_uri").agg(F.bool_or(F.col("outcome") == "delete").alias("deleted"))


@query(
    "stream_latest",
    S.with_views(
        "object_events versions",
        FINALIZED
        + "select gcs_uri, max(generation) as generation from fin where generation is not null group by gcs_uri",
    ),
)
def stream_latest(spark, sf_dir):
    arrivals = event_stream(spark, sf_dir).where("kind = 'finalize'")
    path = shared_dir(spark, "latest")
    reconcile.start_latest(arrivals, path, shared_dir(spark, "state")).awaitTermination()
    return spark.read.parquet(path).groupBy("gcs_uri").agg(F.max("generation").alias("generation"))


@query(
    "stream_dedupe",
    S.with_views(
        "object_events versions",
        """
        , e as (select * from object_events where regexp_matches(lower(gcs_uri), '\\.(jpg|jpeg|png)$'))
        select kind, (select count(distinct (x.gcs_uri, x.generation)) from e x where x.kind = k.kind
            and x.generation is not null)
          + (select count(*) from e x where x.kind = k.kind and x.generation is null) as events
        from (select distinct kind from e) k""",
    ),
)
def stream_dedupe(spark, sf_dir):
    """Each event delivered twice; repeats of a known generation are dropped."""
    once = event_stream(spark, sf_dir)
    known = F.col("generation").isNotNull()
    copies = F.when(known, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    twice = once.withColumn("copy", F.explode(copies))
    path = shared_dir(spark, "deduped")
    kept = reconcile.drop_repeats(twice.drop("copy"), "ts", "60 days")
    reconcile.start_decisions(kept, path, shared_dir(spark, "state")).awaitTermination()
    return spark.read.parquet(path).groupBy("kind").agg(F.count("*").alias("events"))


@query("stream_ingest", checks_responses.AUDIT_ORACLE)
def stream_ingest(spark, sf_dir):
    source = shared_dir(spark, "responses")
    S.responses(spark, sf_dir).write.parquet(source)
    stream = spark.readStream.schema("audit_id bigint, response string").parquet(source)
    rows = shared_dir(spark, "rows")
    ingest.start_ingest(
        stream, rows, shared_dir(spark, "errors"), shared_dir(spark, "state")
    ).awaitTermination()
    return checks_responses.rounded(ingest.read_rows(spark, rows, ["audit_id"]), "audit_id")


def scorer():
    """Answers with one material, whose weight follows from the object's name; it fails on some objects."""

    def score(content, prompt, model, settings):
        if content.rpartition(b".")[0].endswith(b"7"):
            raise RuntimeError("model is down")
        return json.dumps({"TotalWeightLbs": len(content), "Paper": {"Boxes": 0.25}})

    return score


def catalogue(spark):
    """The two versions of the stand-ins with a prompt each."""
    rows = S.view(spark, "", "versions").withColumn("model_name", F.concat(F.lit("model "), "prompt_version_id"))
    return rows.select(
        "*", F.lit("look").alias("prompt_text"), F.lit("be exact").alias("system_instruction"),
        F.lit("HIGH").alias("thinking_level"), F.lit(False).alias("code_execution"),
    )


def run_live(spark, sf_dir, paths):
    """The live audit over all events, batch by batch until nothing is left to do."""
    check = shared_dir(spark, "live-check")
    tables.write_jobs(S.jobs(spark, sf_dir), paths.jobs)

    def listing():
        return S.view(spark, sf_dir, "inventory")

    def reconciled():
        arrivals = event_stream(spark, sf_dir).select("gcs_uri", "kind", "generation")
        act.start(arrivals, ["v1", "v2"], paths, listing, f"{check}/act", trigger={"once": True}).awaitTermination()

    reconciled()
    # One batch of tasks: those that fail are handed over again, but not worked here.
    work.start_work(
        spark, catalogue(spark), scorer, paths, f"{check}/work", trigger={"once": True}, fetch=lambda uri: uri.encode()
    ).awaitTermination()
    # Results release waiting deletes; each delete ends in the batch after its own, at most two wait for one another.
    for _ in range(4):
        reconciled()


# What the stand-in jobs and events come to. No lease of the stored jobs still runs, as their times are long past.
LIVE = """
, e as (select * from object_events where regexp_matches(lower(gcs_uri), '\\.(jpg|jpeg|png)$')),
fin as (select gcs_uri, max(generation) as g, bool_or(generation is null) as bare
  from e where kind = 'finalize' group by gcs_uri),
pairs as (select gcs_uri, prompt_version_id from fin cross join versions
  union select gcs_uri, prompt_version_id from jobs_by_age),
state as (
  select p.gcs_uri, p.prompt_version_id, j.status, j.generation as stored, j.attempts, j.gcs_uri is not null as known,
    f.g, coalesce(f.bare, false) as bare, f.gcs_uri is not null as arrived
  from pairs p left join jobs_by_age j on j.gcs_uri = p.gcs_uri and j.prompt_version_id = p.prompt_version_id
  left join fin f on f.gcs_uri = p.gcs_uri),
decided as (
  select *, arrived and (not known or coalesce(g > stored, g is not null) or (g = stored and status <> 'PROCESSED'))
      as by_generation,
    arrived and known and bare and status <> 'PROCESSED' as without from state),
queued as (
  select gcs_uri, prompt_version_id, by_generation or without as queued,
    (by_generation or without) and regexp_matches(gcs_uri, '7\\.[A-Za-z]+$') as broken,
    case when by_generation then g when without then null else stored end as generation, status, attempts
  from decided),
newest as (select gcs_uri, max(coalesce(generation, 0)) as g from queued group by gcs_uri),
deletes as (
  select d.gcs_uri, bool_or(d.generation is null) as bare, max(d.generation) as g
  from e d left join newest n on n.gcs_uri = d.gcs_uri
  where d.kind = 'delete' and (d.generation is null or d.generation >= coalesce(n.g, 0)) group by d.gcs_uri),
-- A failed job is retried for a while, and a delete waits for that long.
gone as (
  select d.gcs_uri from deletes d left join (select gcs_uri, max(generation) as live from inventory group by gcs_uri) i
    on i.gcs_uri = d.gcs_uri where (d.bare or i.live is null or i.live <= d.g) and d.gcs_uri not in (select gcs_uri from queued where broken))
"""


@query(
    "stream_audit",
    S.with_views(
        "object_events versions jobs_by_age inventory",
        LIVE
        + """
        select gcs_uri, prompt_version_id, generation, case when queued then 1 else attempts end as attempts,
          case when broken then 'FAILED_RETRY' when queued then 'PROCESSED' else status end as status,
          case when queued and not broken then 2 else 0 end as result_rows, case when broken then 1 else 0 end as error_rows
        from queued where gcs_uri not in (select gcs_uri from gone)""",
    ),
)
def stream_audit(spark, sf_dir):
    """Job, result and error tables after the live audit of all events, begun with the stored jobs."""
    paths = act.Paths.under(shared_dir(spark, "live"))
    run_live(spark, sf_dir, paths)
    key = ["gcs_uri", "prompt_version_id"]
    rows = tables.read_results(spark, paths.results).groupBy(*key).agg(F.count("*").alias("result_rows"))
    errors = tables.read_errors(spark, paths.errors).groupBy(*key).agg(F.count("*").alias("error_rows"))
    return tables.read_jobs(spark, paths.jobs).join(rows, key, "left").join(errors, key, "left").select(
        *key, "status", "generation", "attempts",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("result_rows", "error_rows")],
    )


@query(
    "stream_arrivals",
    """
    with v as (select event_id % 24 as k, case when event_type = 'error' then 'delete' else 'finalize' end as kind from events),
    r as (select kind, case when k in (10, 11) then 'not_an_object' when k in (0, 1, 2, 3, 16, 17) then 'bad_bucket'
      when k in (4, 5, 18) then 'bad_name' when k in (6, 7, 8, 9, 19) then 'bad_generation' end as reason from v)
    select kind, reason, count(*) as lines from r group by kind, reason""",
)
def stream_arrivals(spark, sf_dir):
    """Lines of both routes by reason, read in batches of one file, with a restart in between."""
    paths = {name: shared_dir(spark, name) for name in ("finalize", "delete", "accepted", "rejected", "check")}
    events_ = S.table(spark, sf_dir, "events").select("event_id", "event_type")
    lines = S.view(spark, sf_dir, "event_lines").join(events_, "event_id")
    for half in range(2):
        some = lines.where(F.col("event_id") % 2 == half)
        for kind, wanted in (("delete", F.col("event_type") == "error"), ("finalize", F.col("event_type") != "error")):
            some.where(wanted).select("value").repartition(3).write.mode("append").text(paths[kind])
        routes = arrivals.read_routes(spark, paths["finalize"], paths["delete"], files=1)
        started = arrivals.start_arrivals(routes, paths["accepted"], paths["rejected"], paths["check"])
        started.awaitTermination()
    good = spark.read.schema(arrivals.ACCEPTED).parquet(paths["accepted"]).withColumn("reason", F.lit(None).cast("string"))
    bad = spark.read.schema(arrivals.REJECTED).parquet(paths["rejected"])
    both = good.select("kind", "reason").union(bad.select("kind", "reason"))
    return both.groupBy("kind", "reason").agg(F.count("*").alias("lines"))
