"""The four jobs of the audit: ingest, work, delete and refresh.

Each one reads and writes stored tables. A stage that several later ones need
is written once to the shared folder, so that nothing costly is run twice and a
lost executor does not send the job back to its inputs.
"""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions import objects
from auditloom.operators import catalogue, conform, events, jobs, mutate, refresh, responses, scoring
from auditloom.operators.joins import unique
from auditloom.session import shared_dir
from auditloom.sources import tables


def kept(df, purpose):
    """`df` written to the shared folder and read back."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def one_per_object(arrivals):
    """The newest event of each object; one without a generation only alone."""
    return arrivals.groupBy("gcs_uri").agg(F.max("generation").alias("generation"))


def one_delete_per_object(deletes):
    """The event that decides each object's delete: one without a generation is
    unconditional and wins, else the newest."""
    always = F.bool_or(F.col("generation").isNull())
    newest = F.when(~always, F.max("generation"))
    return deletes.groupBy("gcs_uri").agg(newest.alias("generation"))


def ingest(spark, raw_events, versions, jobs_path, results_path, tasks_path, now, dispatch=None):
    """Arrived objects to tasks.

    `raw_events` is the output of `read_object_events`. The order is claim,
    delete superseded rows, hand over tasks. `dispatch(tasks)` may refuse some
    and returns their (gcs_uri, prompt_version_id); their claims are undone.
    Returns the rejected events and the decisions.
    """
    checked = kept(events.validate_events(raw_events), "events")
    valid, rejected = events.quarantine(checked)
    newest = one_per_object(events.supported_images(valid))
    state = tables.read_jobs(spark, jobs_path)
    decisions = kept(jobs.reconcile(newest, versions, state, now), "decisions")

    claims = jobs.claim(decisions, now)
    tables.change_jobs(spark, jobs_path, claims)

    superseded, removed = decisions.where("delete_superseded_rows"), F.lit(False)
    tasks = claims.select(*jobs.KEY)
    try:
        if not superseded.isEmpty():
            tables.apply_delete(spark, results_path, decisions=superseded)
            removed = F.lit(True)
        refused = dispatch(tasks) if dispatch is not None else None
    except Exception as problem:
        # Nothing was handed over: all claims are undone before the failure goes on.
        gone = _marked(claims, superseded, problem, results_path, jobs.KEY)
        _undo(gone, F.lit(True), F.col("delete_superseded_rows") & (removed | F.col("_gone")), jobs_path)
        raise
    if refused is not None and not refused.isEmpty():
        broken = claims.join(unique(refused, jobs.KEY), jobs.KEY, "left_semi")
        _undo(broken, F.lit(True), F.col("delete_superseded_rows"), jobs_path)
        tasks = tasks.join(refused, jobs.KEY, "left_anti")
    tables.append_table(tasks, tasks_path)
    return rejected, decisions


def _marked(rows, keys, problem, results_path, on):
    """`rows` with `_gone`: whether a delete that broke off has removed their results.

    Unless it broke off while the table was changed, nothing is gone.
    """
    if not isinstance(problem, tables.PartlyDone):
        return rows.withColumn("_gone", F.lit(False))
    left = tables.still_there(rows.sparkSession, results_path, keys, on).withColumn("_left", F.lit(True))
    return rows.join(left, on, "left").withColumn("_gone", F.col("_left").isNull()).drop("_left")


def _undo(claims, broken, rows_deleted, jobs_path):
    """Roll the broken ones among `claims` back in the job table."""
    settled = kept(jobs.rollback(claims, broken, rows_deleted), "undone")
    tables.change_jobs(claims.sparkSession, jobs_path, settled, gone=claims.select(*jobs.KEY))


def _touched(spark, jobs_path, keys):
    """The stored jobs of these keys."""
    return tables.read_jobs(spark, jobs_path).join(unique(keys, jobs.KEY), jobs.KEY, "left_semi")


def work(spark, tasks, rendered, make_scorer, jobs_path, results_path, errors_path, now, run=None, **options):
    """Tasks to result rows, error rows and job states; `options` are those of `process`.

    A repeated call with the same `run` replaces the rows and errors of the first
    one; without a name each call is a run of its own, and readers take the last
    one of an object and version.
    """
    tasks = kept(events.validate_tasks(tasks), "tasks")
    tables.change_jobs(spark, jobs_path, kept(jobs.start(_touched(spark, jobs_path, tasks), tasks, now), "started"))
    outcome = process(spark, tasks, rendered, make_scorer, results_path, errors_path, now, run, **options)
    last = catalogue.last_wins(outcome, jobs.KEY, "attempt")
    tables.change_jobs(spark, jobs_path, kept(jobs.advance(_touched(spark, jobs_path, last), last, now), "advanced"))
    return outcome


def _most_bytes(texts, rendered):
    """No less than the bytes of any result row of an audit, without looking at its rows.

    The image is a part of the object's name, class and material are keys of the
    response, and 1024 bytes are more than numbers, tags and lengths take.
    """
    model = rendered.agg(F.max(F.octet_length("model_name"))).scalar()
    total = 3 * F.octet_length("model_result").cast("bigint") + 2 * F.octet_length("gcs_uri") + 1024
    for text in texts:
        total = total + F.coalesce(F.octet_length(text), F.lit(0))
    return total + F.coalesce(model, F.lit(0))


def process(
    spark, tasks, rendered, make_scorer, results_path, errors_path, now, run=None,
    images=None, fetch=None, thumbs=True, sign=None, partitions=None, listing=None,
):
    """Tasks to result rows and error rows of the run `run`; returns one outcome a task.

    `tasks` carries gcs_uri, prompt_version_id and attempt. Bytes come from
    the `images` frame or from `fetch(uri)`. With a `listing` (gcs_uri, length)
    each object is fetched once for all its versions, in partitions
    of about equal bytes. Scoring is the costly step, so it is spread over
    `partitions`, as many as a shuffle has unless given, however few files the tasks
    lie in; its output is written before anything else reads it, and so is what is
    parsed from it.
    """
    run = run or tables.new_run()
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = events.validate_tasks(tasks)
    unknown = events.missing_versions(tasks, rendered).withColumn(
        "error_message",
        F.concat(F.lit("Prompt version '"), F.col("prompt_version_id"), F.lit("' not found.")),
    )
    known = catalogue.with_prompts(tasks, rendered)
    if listing is not None:
        whole = scoring.balanced(scoring.image_tasks(known, listing), partitions)
        scored = kept(scoring.score_images(whole, make_scorer, fetch), "scored")
    else:
        known = scoring.spread(known, partitions)
        known = scoring.with_content(known, images) if images is not None else known
        scored = kept(scoring.score(known, make_scorer, fetch=fetch), "scored")

    parsed = responses.score_rows(responses.parse_responses(scored))
    full = responses.with_payload(parsed).withColumn(
        "error_message", F.coalesce("error_message", "reason")
    )
    # URLs once an audit, not once a row.
    bucket, name = objects.split_uri(F.col("gcs_uri"), strict=True)
    is_sound, urls = F.col("error_message").isNull(), []
    if sign is not None:
        full = full.withColumn("raw_signed_url", F.when(is_sound, sign(F.col("gcs_uri"))))
        urls.append("raw_signed_url")
    if thumbs:
        full = full.withColumn("gcs_thumb_uri", objects.written_thumb_uri(bucket, name))
        urls.append("gcs_thumb_uri")
        if sign is not None:
            full = full.withColumn("thumb_signed_url", F.when(is_sound, sign(F.col("gcs_thumb_uri"))))
            urls.append("thumb_signed_url")
    full = full.withColumn("_most", _most_bytes(["prompt_version_id", *urls], rendered))
    full = kept(full.select(*jobs.KEY, "attempt", "error_message", "model_result", "rows", *urls, "_most"), "parsed")
    sound = full.where("error_message is null")

    def as_rows(audits):
        rows = responses.explode_rows(audits.select(*jobs.KEY, "model_result", *urls, "rows"))
        return mutate.result_rows(rows, rendered, now)

    # One refused row refuses its audit, before anything is appended. Rows are measured where one can be too large.
    fitted = as_rows(sound.where(F.col("_most") > fixed.MAX_ROW_BYTES))
    sized = fitted.withColumn(
        "reason", F.when(conform.row_bytes(fitted) > fixed.MAX_ROW_BYTES, "row_too_large")
    )
    _, refused = events.quarantine(conform.fail_whole(sized, jobs.KEY))
    too_large = kept(refused.groupBy(*jobs.KEY).agg(F.min("reason").alias("_large")), "too-large")
    good = as_rows(sound.join(too_large, jobs.KEY, "left_anti"))
    tables.write_results(good, results_path, run, image_from_uri=True)

    outcome = (
        full.select(*jobs.KEY, "attempt", "error_message")
        .join(too_large, jobs.KEY, "left")
        .withColumn("error_message", F.coalesce("error_message", "_large"))
        .withColumn("configured", F.lit(True))
        .drop("_large")
        .unionByName(
            unknown.select(*jobs.KEY, "attempt", "error_message", F.lit(False).alias("configured"))
        )
        .withColumn("ok", F.col("error_message").isNull())
    )
    outcome = kept(outcome, "outcomes")
    failed = outcome.where("not ok")
    tables.write_errors(mutate.error_rows(failed, rendered, now), errors_path, run)
    return outcome


def delete(spark, raw_events, jobs_path, results_path, list_objects, now):
    """Deleted objects out of the results and the job table.

    `list_objects()` gives the live inventory; it is read again after the lease
    because a newer object may have arrived meanwhile. Returns the plan and the
    number of deleted result rows.
    """
    checked = kept(events.validate_events(raw_events), "events")
    valid, _ = events.quarantine(checked)
    newest = one_delete_per_object(events.supported_images(valid))
    wanted = mutate.fresh_deletes(newest, list_objects())
    state = tables.read_jobs(spark, jobs_path)
    plan = kept(jobs.delete_plan(wanted, state, now), "plan")
    leased = kept(jobs.lease_delete(state, plan, now), "leases")
    tables.change_jobs(spark, jobs_path, leased)

    removed, done = 0, F.lit(False)
    gone = plan.where(F.col("action") == fixed.ACTION_DELETE)
    try:
        still = kept(mutate.fresh_deletes(plan, list_objects()), "deletes")
        back = leased.join(unique(still, "gcs_uri"), "gcs_uri", "left_anti")
        restored = kept(jobs.rollback_delete(back, F.lit(False)), "restored")
        gone = still.where(F.col("action") == fixed.ACTION_DELETE)
        removed = 0 if gone.isEmpty() else tables.apply_delete(spark, results_path, uris=gone)
        done = F.lit(True)
        tables.change_jobs(spark, jobs_path, restored, gone=gone, on=["gcs_uri"])
    except Exception as problem:
        # The leases are given back, or made retryable where the rows are gone.
        marked = _marked(leased, gone, problem, results_path, "gcs_uri")
        restored = kept(jobs.rollback_delete(marked, done | F.col("_gone")), "restored")
        tables.change_jobs(spark, jobs_path, restored)
        raise
    return plan, removed


def refresh_urls(spark, results_path, thumbs, sign, now, due_only=False):
    """New URLs for all active images, or only for those about to expire.

    Meant to be run by an outside scheduler. Returns the number of updates and
    the backlog of missing thumbnails.
    """
    table = tables.read_results(spark, results_path)
    source = refresh.rows_of_due_images(table, now) if due_only else table
    first = kept(refresh.first_per_image(refresh.active_records(source)), "active")
    updates = kept(refresh.url_payload(first, thumbs, sign), "updates")
    tables.apply_merge(spark, results_path, updates)
    return updates.count(), refresh.thumb_backlog(first, thumbs)


def follow_signed(spark, results_path, signed_path, checkpoint):
    """Note when the URLs of newly appended images were made, from the appended rows only.

    A stream over the result folders that ends with its input. Folders that a
    change has put in place are read again; their older times do no harm, since
    the latest time of an image counts.
    """
    rows = (
        spark.readStream.schema("image_id string, processing_timestamp timestamp, run string, part int")
        .option("ignoreMissingFiles", "true")
        .parquet(results_path)
    )

    def note(batch, number):
        made = batch.where("image_id is not null").groupBy("image_id")
        tables.write_batch(made.agg(F.max("processing_timestamp").alias("signed_at")), signed_path, number)

    started = rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(note)
    started.trigger(availableNow=True).start().awaitTermination()


def due_images(spark, signed_path, now, slack="2 days"):
    """Images whose URLs expire within `slack`, by the side table of `follow_signed`."""
    if not tables.path_exists(spark, signed_path):
        return spark.createDataFrame([], "image_id string")
    signed = spark.read.schema("image_id string, signed_at timestamp, batch_id string").parquet(signed_path)
    bound = now + F.expr(f"interval {slack}") - F.expr(f"interval {fixed.URL_LIFETIME}")
    return signed.groupBy("image_id").agg(F.max("signed_at").alias("at")).where(F.col("at") <= bound).select("image_id")


def refresh_due(spark, results_path, signed_path, checkpoint, thumbs, sign, now, slack="2 days"):
    """New URLs for the images about to expire, without a scan of the results.

    The due images come from a side table (image, time signed), which a stream
    fills from appended rows and each refresh adds to. Only the parts of the
    result table that hold due images are read and changed. Returns the due
    images and the number of updated rows. A refresh that breaks off before its
    note is repeated by the next one.
    """
    follow_signed(spark, results_path, signed_path, checkpoint)
    due = kept(due_images(spark, signed_path, now, slack), "due")
    if due.isEmpty():
        return due, 0
    table = tables.ResultTable(spark, results_path)
    rows = table.rows(table.parts_of(due, "image_id")).join(unique(due, "image_id"), "image_id", "left_semi")
    first = kept(refresh.first_per_image(refresh.active_records(rows)), "first")
    # Few images are due, so the listing is cut to their thumbnails before it is shuffled.
    expected = refresh.with_thumb_location(first).select("thumb_uri")
    listed = thumbs.join(expected, "thumb_uri", "left_semi")
    updates = kept(refresh.url_payload(first, listed, sign), "updates")
    updated = tables.apply_merge(spark, results_path, updates)
    tables.write_batch(due.withColumn("signed_at", now), signed_path, f"refresh-{tables.new_run()}")
    return due, updated
