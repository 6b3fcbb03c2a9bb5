"""Hot keys, empty inputs and the shape of plans."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import conform, events, jobs, mutate, refresh
from auditloom.plans import standins as S
from auditloom.session import shared_dir
from auditloom.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """Rows of which one key owns a third."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 101)
    return spark.range(6000).select(
        F.concat(F.lit("u"), hot.cast("string")).alias("gcs_uri"),
        F.lit("v1").alias("prompt_version_id"),
        F.col("id").alias("event_id"),
        F.timestamp_seconds((F.col("id") * 7919) % 60000).alias("ts"),
        ((F.col("id") * 31) % 6007 + 1).alias("generation"),
    )


def test_attempt_numbers_on_a_hot_job(spark, skewed):
    got = jobs.attempt_numbers(skewed, "ts", "event_id").toPandas()
    pdf = skewed.toPandas().sort_values(["gcs_uri", "ts", "event_id"])
    pdf["attempt"] = pdf.groupby("gcs_uri").cumcount() + 1
    left = got.set_index("event_id").attempt.sort_index()
    pd.testing.assert_series_equal(left, pdf.set_index("event_id").attempt.sort_index(), check_dtype=False)


def test_hot_object_reconciles_whole(spark, skewed):
    versions = spark.createDataFrame([("v1",), ("v2",)], "prompt_version_id string")
    state = spark.createDataFrame([("u0", "v1", "PROCESSED", None, 3000, 1, None, None, None)], fixed.JOB_SCHEMA)
    now = F.lit("2026-01-01").cast("timestamp")
    got = jobs.reconcile(skewed.drop("prompt_version_id"), versions, state, now)
    hot = {(r.prompt_version_id, r.outcome): r["count"] for r in got.where("gcs_uri = 'u0'").groupBy("prompt_version_id", "outcome").count().collect()}
    pdf = skewed.where("gcs_uri = 'u0'").toPandas()
    older = int((pdf.generation <= 3000).sum())
    assert hot == {("v1", "skipped"): older, ("v1", "queued"): len(pdf) - older, ("v2", "queued"): len(pdf)}


def test_reconcile_shuffles_events_once(spark, skewed, tmp_path):
    path = str(tmp_path / "e")
    skewed.drop("prompt_version_id").write.parquet(path)
    versions = spark.createDataFrame([("v1",), ("v2",)], "prompt_version_id string")
    state = S.jobs(spark, "/root/testdata/sf0.001")
    now = S.now()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = jobs.event_summary(spark.read.parquet(path), versions, state, now)
        plan = plan_of(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The side with the events: one exchange between the scan and the join.
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
    left_key = plan.split("SortMergeJoin [")[1].split("]")[0]
    assert plan.count(f"hashpartitioning({left_key},") == 1


def test_reductions_run_before_the_shuffle(spark, skewed):
    for df in (events.latest_generation(skewed),
               refresh.first_per_image(refresh.active_records(skewed.select(
                   F.lit("i").alias("image_id"), F.concat(F.lit("gs://b/"), "gcs_uri").alias("gcs_uri"),
                   F.lit(None).cast("string").alias("gcs_thumb_uri"))))):
        plan = plan_of(df)
        assert "partial_" in plan and "Window" not in plan


def test_refresh_reads_three_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "results")
    spark.createDataFrame([], fixed.RESULT_SCHEMA).write.parquet(path)
    table = spark.read.parquet(path)
    plan = plan_of(refresh.active_records(table))
    schema = plan[plan.index("ReadSchema: "):].splitlines()[0]
    assert schema.count(":string") == 3 and "model_result" not in schema
    assert "IsNotNull(gcs_uri)" in plan and "IsNotNull(image_id)" in plan
    now = F.lit("2026-01-01").cast("timestamp")
    assert "LessThanOrEqual(processing_timestamp" in plan_of(refresh.urls_due(table, now))


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "gcs_uri string, generation bigint, event_id bigint")
    state = spark.createDataFrame([], fixed.JOB_SCHEMA)
    versions = spark.createDataFrame([("v1",)], "prompt_version_id string")
    now = F.lit("2026-01-01").cast("timestamp")
    assert jobs.reconcile(none, versions, state, now).count() == 0
    assert jobs.event_summary(none, versions, state, now).count() == 0
    assert jobs.delete_plan(none, state, now).count() == 0
    assert events.latest_generation(none).count() == 0
    results = spark.createDataFrame([], fixed.RESULT_SCHEMA)
    updates = spark.createDataFrame([], "image_id string, raw_signed_url string, thumb_signed_url string, gcs_thumb_uri string")
    counts = mutate.change_counts(results, none, updates).first()
    assert tuple(counts) == (0, 0)


def test_null_keys_survive_deletes(spark):
    rows = spark.createDataFrame([(None, "v1"), ("u", "v1")], "gcs_uri string, prompt_version_id string")
    gone = spark.createDataFrame([("u",), (None,)], "gcs_uri string")
    assert [r.gcs_uri for r in mutate.delete_object(rows, gone).collect()] == [None]


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_are_split_by_the_join(spark, tmp_path):
    """The joins keep both inputs splittable: AQE marks them as skewed."""
    path = str(tmp_path / "hot")
    pad = F.repeat(F.lit("x"), F.lit(200))
    hot = F.concat(F.lit("u"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).cast("string"))
    spark.range(40000).select(
        hot.alias("gcs_uri"), F.lit("v1").alias("prompt_version_id"), F.col("id").alias("generation"),
        F.concat(pad, F.col("id").cast("string")).alias("pad"), F.lit(True).alias("delete_superseded_rows"),
    ).repartition(8).write.parquet(path)
    hot_rows = spark.read.parquet(path)
    keys = spark.range(20000).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("gcs_uri"), F.lit("v1").alias("prompt_version_id"),
        F.lit("PROCESSED").alias("status"), F.col("id").alias("generation"), F.col("id").alias("attempts"),
        F.lit(True).alias("delete_superseded_rows"),
        *[F.lit(None).cast("timestamp").alias(c) for c in ("queued_at", "last_processed_at", "deleting_at")],
        F.lit(None).cast("string").alias("error_message"),
    )
    versions = spark.createDataFrame([("v1",)], "prompt_version_id string")
    now = F.lit("2026-01-01").cast("timestamp")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        plans = {
            "reconcile": final_plan(jobs.reconcile(hot_rows.drop("prompt_version_id"), versions, keys, now)),
            "delete_plan": final_plan(jobs.delete_plan(hot_rows, keys, now)),
            "delete_superseded": final_plan(mutate.delete_superseded(hot_rows, keys)),
            "delete_object": final_plan(mutate.delete_object(hot_rows, keys)),
            "fresh_deletes": final_plan(mutate.fresh_deletes(hot_rows, keys)),
        }
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert {k: "skew=true" in p for k, p in plans.items()} == dict.fromkeys(plans, True)


def test_attempts_in_one_instant(spark):
    """A burst of one job at one time is still ranked in parts."""
    rows = spark.range(5000).select(
        F.lit("u").alias("gcs_uri"), F.lit("v").alias("prompt_version_id"),
        F.timestamp_seconds(F.lit(0)).alias("ts"), ((F.col("id") * 7919) % 5003).alias("event_id"))
    got = jobs.attempt_numbers(rows, "ts", "event_id").orderBy("event_id").collect()
    assert [r.attempt for r in got] == list(range(1, 5001))


class FakeSession:
    def __init__(self, **settings):
        self.conf = self
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder():
    named = shared_dir(FakeSession(spark_checkpoint_dir="hdfs://x/shared/", spark_master="yarn"), "a")
    assert named.startswith("hdfs://x/shared/a-")
    assert shared_dir(FakeSession(spark_master="local[2]"), "a").startswith("/tmp/run-")
    with pytest.raises(ValueError):
        shared_dir(FakeSession(spark_master="spark://host:7077"), "a")


def test_tasks_of_one_file_are_scored_by_many_tasks(spark, tmp_path):
    """Small rows of costly work: their file is no measure of how far they are spread."""
    from pyspark import TaskContext

    from auditloom.plans import jobs as plans

    def scorer():
        def score(content, prompt, model, settings):
            raise RuntimeError(f"task {TaskContext.get().partitionId()}")

        return score

    tasks = spark.range(200).coalesce(1).selectExpr(
        "concat('gs://b/o', id, '.jpg') as gcs_uri", "'v1' as prompt_version_id", "1 as attempt")
    rendered = spark.createDataFrame(
        [("v1", "m", "look", "be exact", "HIGH", False)],
        "prompt_version_id string, model_name string, prompt_text string, system_instruction string, "
        "thinking_level string, code_execution boolean")
    paths = [str(tmp_path / n) for n in ("results", "errors")]
    outcome = plans.process(spark, tasks, rendered, scorer, *paths, F.current_timestamp(), fetch=lambda uri: b"x")
    assert outcome.count() == 200
    assert outcome.select("error_message").distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_sizes_of_numbers_at_their_bounds(spark):
    bounds = [n for bits in range(7, 63, 7) for n in (2**bits - 1, 2**bits)] + [-1, 0, 2**63 - 1, -(2**63)]
    numbers = spark.createDataFrame([(n,) for n in bounds], "n bigint")
    for n, size in numbers.select("n", conform.row_bytes(numbers)).collect():
        assert size == 1 + (10 if n < 0 else max(1, -(-n.bit_length() // 7)))


def _process(spark, tmp_path, uris, answer, **options):
    from auditloom.plans import jobs as plans

    tasks = spark.createDataFrame([(u, "v1", 1) for u in uris], "gcs_uri string, prompt_version_id string, attempt int")
    rendered = spark.createDataFrame(
        [("v1", "m", "look", "be exact", "HIGH", False)],
        "prompt_version_id string, model_name string, prompt_text string, system_instruction string, "
        "thinking_level string, code_execution boolean")
    paths = [str(tmp_path / n) for n in ("results", "errors")]
    outcome = plans.process(
        spark, tasks, rendered, lambda: lambda content, *rest: answer(content.decode()), *paths, F.current_timestamp(),
        fetch=lambda uri: uri.encode(), **options)
    return outcome, tables.read_results(spark, paths[0])


def test_urls_are_signed_once_an_audit(spark, tmp_path):
    """Not once a row, and not again for each look at the rows."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def sign(uri):
        made.add(1)
        return f"signed {uri}"

    uris = [f"gs://b/o{i}.jpg" for i in range(20)]
    outcome, results = _process(
        spark, tmp_path, uris, lambda uri: '{"TotalWeightLbs": 4, "Paper": {"Boxes": 0.25, "Bags": 0.5}}', sign=sign)
    assert outcome.where("ok").count() == 20 and results.count() == 60
    assert made.value == 40
    assert {r.thumb_signed_url for r in results.where("gcs_uri like '%o7.jpg'").collect()} == {
        "signed gs://b-thumbnails/thumbnails/o7_thumb.webp"}


def test_one_row_too_large_refuses_its_audit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fixed, "MAX_ROW_BYTES", 4000)
    uris = ["gs://b/small.jpg", "gs://b/large.jpg", "gs://b/near.jpg", "gs://b/large.jpg"]

    def answer(uri):
        # The text around the JSON is not stored; the row of `near` is under the limit, though three times its text is not.
        more = {"large": 4000, "near": 3000}.get(uri[7:-4], 0)
        return '{"TotalWeightLbs": 4, "Paper": {"Boxes": 0.25}, "note": "%s"}' % ("x" * more)

    outcome, results = _process(spark, tmp_path, uris, answer)
    assert sorted((r.gcs_uri, r.ok, r.error_message) for r in outcome.collect()) == [
        ("gs://b/large.jpg", False, "row_too_large"), ("gs://b/large.jpg", False, "row_too_large"),
        ("gs://b/near.jpg", True, None), ("gs://b/small.jpg", True, None)]
    assert {r.gcs_uri for r in results.collect()} == {"gs://b/near.jpg", "gs://b/small.jpg"} and results.count() == 4
