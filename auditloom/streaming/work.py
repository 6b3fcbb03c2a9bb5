"""Tasks as a stream: score, then rows, errors and job states per batch.

Each batch owns a run of the result table, a run of the error table and a
folder of worker results, which are the events that the live reconcile takes
up. A batch that is run again replaces all of them, so it changes nothing. A
failed task is handed over again, with the next attempt, until its attempts are
used up.
"""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.plans import jobs as plans
from auditloom.sources import tables
from auditloom.streaming.act import TASK, _folder


def states(outcome, tasks):
    """Outcomes of tasks as events of the live reconcile."""
    status = (
        F.when(~F.col("configured"), fixed.FAILED_PERMANENT)
        .when(F.col("ok"), fixed.PROCESSED)
        .otherwise(fixed.FAILED_RETRY)
    )
    known = tasks.select("gcs_uri", "prompt_version_id", "attempt", "generation").dropDuplicates(
        ["gcs_uri", "prompt_version_id", "attempt"]
    )
    return outcome.join(known, ["gcs_uri", "prompt_version_id", "attempt"], "left").select(
        "gcs_uri",
        F.lit("result").alias("kind"),
        "generation",
        "prompt_version_id",
        status.alias("status"),
        F.col("attempt").cast("int").alias("attempts"),
        "error_message",
    )


def work_batch(spark, batch, number, rendered, make_scorer, paths, now, **options):
    """Work one batch of tasks; the same batch again replaces what it wrote."""
    tasks = plans.kept(batch, "batch")
    outcome = plans.process(
        spark, tasks, rendered, make_scorer, paths.results, paths.errors, now, run=f"batch-{number:012d}", **options
    )
    done = plans.kept(states(outcome, tasks), "states")
    tables.write_batch(done, paths.states, number)
    left = done.where((F.col("status") != fixed.PROCESSED) & (F.col("attempts") < fixed.MAX_ATTEMPTS))
    again = left.select("gcs_uri", "prompt_version_id", "generation", (F.col("attempts") + 1).cast("int").alias("attempt"))
    # A folder name of its own, beside those of the claims.
    tables.write_batch(again, paths.tasks, f"again-{number}")


def start_work(spark, rendered, make_scorer, paths, checkpoint, trigger=None, files=None, now=None, **options):
    """Work the tasks of the live audit as they come.

    `now()` gives the time column of a batch; `options` are those of
    `plans.jobs.process`, such as `fetch`, `images`, `sign` and `partitions`.
    """
    now = now or F.current_timestamp
    return (
        _folder(spark, paths.tasks, TASK, files)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(
            lambda batch, number: work_batch(
                batch.sparkSession, batch, number, rendered, make_scorer, paths, now(), **options
            )
        )
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
