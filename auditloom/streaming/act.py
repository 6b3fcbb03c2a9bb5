"""Carry out the decisions of the live reconcile.

One query owns the job table. Each of its batches writes the decisions down
first and acts on what was written, in an order that can be repeated from the
start: worker results, ends of deletes, claims, superseded rows, tasks, and the
first step of deletes. Everything is keyed by the batch or by the job, and the
times come from the decisions, so a batch that is run again after a failure
leaves the tables as one run does.

A delete takes two steps. Its batch marks the jobs DELETING, reads the listing of
live objects again, removes the result rows of objects that are still gone, and
writes an event that a later batch of the same query reads: `deleted` purges
the jobs, `restored` gives them their state back. The result table is shared
with the query that appends rows; changes to it exclude one another within
the application.
"""

from typing import NamedTuple

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import jobs, mutate
from auditloom.operators.joins import unique
from auditloom.session import shared_dir
from auditloom.sources import tables
from auditloom.streaming import reconcile

TASK = "gcs_uri string, prompt_version_id string, generation bigint, attempt int"


class Paths(NamedTuple):
    """Where the live audit keeps its tables."""

    events: str
    jobs: str
    results: str
    errors: str
    tasks: str
    states: str
    ends: str
    decisions: str

    @classmethod
    def under(cls, root):
        return cls(*[f"{root}/{name}" for name in cls._fields])


def _folder(spark, path, schema, files):
    """The files that batches leave in their own folders of `path`, as a stream."""
    fs, place = tables.file_system(spark, path)
    fs.mkdirs(place)
    reader = spark.readStream.schema(f"{schema}, batch_id string")
    reader = reader.option("maxFilesPerTrigger", files) if files else reader
    return reader.parquet(path).drop("batch_id")


def live_events(spark, paths, events, files=None):
    """`events` (gcs_uri, kind, generation) with worker results and the ends of deletes."""
    states = _folder(spark, paths.states, reconcile.INPUT, files)
    ends = _folder(spark, paths.ends, reconcile.INPUT, files)
    return reconcile._shape(events).unionByName(states).unionByName(ends)


def _kept(df, purpose):
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _stored(spark, paths, keys, on=jobs.KEY):
    on = [on] if isinstance(on, str) else on
    return tables.read_jobs(spark, paths.jobs).join(unique(keys, on), on, "left_semi")


def _record(spark, paths, results):
    """Worker results into the job table."""
    done = results.select(
        *jobs.KEY,
        F.col("attempts").alias("attempt"),
        (F.col("status") == fixed.PROCESSED).alias("ok"),
        "error_message",
        (F.col("status") != fixed.FAILED_PERMANENT).alias("configured"),
        "decided_at",
    )
    last = F.max_by(F.struct("ok", "error_message", "configured", "decided_at"), "attempt").alias("last")
    done = done.groupBy(*jobs.KEY).agg(F.max("attempt").alias("attempt"), last).select(*jobs.KEY, "attempt", "last.*")
    moved = jobs.advance(_stored(spark, paths, done), done, F.col("decided_at"))
    tables.change_jobs(spark, paths.jobs, _kept(moved, "recorded"))


def _end_deletes(spark, paths, made):
    """Jobs of finished deletes go; those of deletes that were called off get their state back."""
    back = made.where(F.col("outcome") == reconcile.RESTORED).select(*jobs.KEY, F.col("status").alias("_was"))
    old = tables.read_jobs(spark, paths.jobs).join(back.dropDuplicates(jobs.KEY), jobs.KEY)
    restored = old.withColumn("status", F.col("_was")).withColumn("deleting_at", F.lit(None).cast("timestamp")).drop("_was")
    gone = made.where(F.col("outcome") == reconcile.PURGED).select(*jobs.KEY)
    tables.change_jobs(spark, paths.jobs, _kept(restored, "restored"), gone=gone)


def _claim(spark, paths, queued, number):
    """Claim jobs, delete the rows they supersede, then hand over their tasks."""
    claims = queued.withColumn("job", F.lit(None).cast("string"))
    claims = jobs.claim(claims, F.col("decided_at")).dropDuplicates(jobs.KEY)
    tables.change_jobs(spark, paths.jobs, claims)
    superseded = queued.where("delete_superseded_rows")
    if not superseded.isEmpty():
        tables.apply_delete(spark, paths.results, decisions=superseded)
    tasks = claims.select(*jobs.KEY, "generation", F.lit(1).alias("attempt"))
    tables.write_batch(tasks, paths.tasks, number)


def _lease(spark, paths, leased, list_objects, number):
    """Mark jobs DELETING, look at the live objects again, and remove the rows of those that are gone."""
    events = leased.select("gcs_uri", "generation", "decided_at")
    times = events.groupBy("gcs_uri").agg(F.max("decided_at").alias("_at"))
    marked = tables.read_jobs(spark, paths.jobs).join(times, "gcs_uri")
    marked = marked.withColumn("status", F.lit(fixed.DELETING)).withColumn("deleting_at", F.col("_at")).drop("_at")
    tables.change_jobs(spark, paths.jobs, _kept(marked, "leased"))
    live = list_objects()
    still = _kept(mutate.fresh_deletes(events, live).withColumn("kind", F.lit("deleted")), "still")
    tables.apply_delete(spark, paths.results, uris=still)
    back = events.join(unique(still, "gcs_uri"), "gcs_uri", "left_anti").withColumn("kind", F.lit("restored"))
    ends = still.unionByName(back).withColumn("status", F.unix_millis("decided_at").cast("string"))
    tables.write_batch(reconcile._shape(ends), paths.ends, number)


def act(spark, batch, number, paths, list_objects):
    """Carry out one batch of decisions; the same batch again changes nothing more."""
    tables.write_batch(batch, paths.decisions, number)
    made = spark.read.schema(batch.schema).parquet(f"{paths.decisions}/batch_id={number}")
    # A handful of rows: the outcomes there are.
    met = {r.outcome for r in made.select("outcome").distinct().collect()}
    if reconcile.RECORDED in met:
        _record(spark, paths, made.where(F.col("outcome") == reconcile.RECORDED))
    if met & {reconcile.PURGED, reconcile.RESTORED}:
        _end_deletes(spark, paths, made)
    if fixed.OUTCOME_QUEUED in met:
        _claim(spark, paths, made.where(F.col("outcome") == fixed.OUTCOME_QUEUED), number)
    if reconcile.LEASED in met:
        _lease(spark, paths, made.where(F.col("outcome") == reconcile.LEASED), list_objects, number)


def _begun(spark, paths, checkpoint):
    """The job table as it was when `checkpoint` was new, in a copy that no batch changes."""
    copy = f"{checkpoint.rstrip('/')}-jobs"
    if not tables.path_exists(spark, f"{copy}/_begun"):
        tables.write_jobs(tables.read_jobs(spark, paths.jobs), copy)
        # Written last: an unfinished copy is made anew, as no batch has run on it.
        spark.range(1).write.mode("overwrite").parquet(f"{copy}/_begun")
    return tables.read_jobs(spark, copy)


def start(events, versions, paths, list_objects, checkpoint, trigger=None, files=None):
    """Reconcile `events` live and carry the decisions out.

    The state starts from the stored job table as it is when the checkpoint is new.
    `list_objects()` gives the live inventory whenever a delete is about to remove
    rows.
    """
    spark = events.sparkSession
    decisions = reconcile.reconcile_stream(
        live_events(spark, paths, events, files), versions, leased=True, jobs=_begun(spark, paths, checkpoint)
    )
    return (
        decisions.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: act(batch.sparkSession, batch, number, paths, list_objects))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
