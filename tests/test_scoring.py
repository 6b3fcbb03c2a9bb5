"""Scoring object by object: one read each, even partitions, no bytes in a shuffle."""

import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from auditloom.operators import scoring
from auditloom.sources import images

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def scorer():
    def score(content, prompt, model, settings):
        if content == b"bad":
            raise RuntimeError("model is down")
        return f'{{"prompt": "{prompt}", "model": "{model}", "size": {len(content)}, "level": "{settings["thinking_level"]}"}}'

    return score


def tasks(spark, uris, versions=("v1", "v2", "v3")):
    rows = [(u, v, 1, f"look {v}", f"model {v}", "HIGH") for u in uris for v in versions]
    return spark.createDataFrame(
        rows, "gcs_uri string, prompt_version_id string, attempt int, prompt_text string, model_name string, thinking_level string")


def test_same_result_as_task_by_task_with_one_read_each(spark, tmp_path):
    log = str(tmp_path / "reads")

    def fetch(uri):
        with open(log, "a") as file:
            file.write(uri + "\n")
        return {"u1": b"abc", "u2": b"bad"}.get(uri)

    given = tasks(spark, ["u1", "u2", "gone"])
    listing = spark.createDataFrame([("u1", 3), ("u1", 3), ("u2", 3), ("other", 9)], "gcs_uri string, length bigint")
    whole = scoring.balanced(scoring.image_tasks(given, listing), 3)
    columns = sorted([*given.columns, "response", "error_message", "tries"])
    mine = scoring.score_images(whole, scorer, fetch).select(*columns).collect()
    assert sorted(open(log).read().split()) == ["gone", "u1", "u2"]
    theirs = scoring.score(given, scorer, fetch=fetch).select(*columns).collect()
    assert sorted(map(str, mine)) == sorted(map(str, theirs)) and len(mine) == 9


def test_partitions_hold_even_bytes(spark):
    """A folder in which a few objects hold most of the bytes, side by side in the order of names."""
    rows = spark.range(2000).select(
        F.concat(F.lit("gs://b/"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("gcs_uri"),
        F.when(F.col("id").between(300, 339), 200_000).when(F.col("id") % 7 == 0, 0).otherwise(F.col("id") % 900).alias("length"))
    placed = scoring.balanced(rows, 16).withColumn("p", F.spark_partition_id())
    sums = [r.n for r in placed.groupBy("p").agg(F.sum("length").alias("n")).collect()]
    assert len(sums) == 16 and sum(sums) == rows.agg(F.sum("length")).first()[0]
    assert max(sums) <= 2 * sum(sums) / 16
    small = scoring.balanced(rows.withColumn("length", F.lit(0)), 8).withColumn("p", F.spark_partition_id())
    assert max(r["count"] for r in small.groupBy("p").count().collect()) <= 2 * 2000 / 8
    assert scoring.balanced(rows.limit(0), 4).count() == 0


def test_no_bytes_are_scanned_or_shuffled(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    for name in "abc":
        (tmp_path / "raw" / f"{name}.jpg").write_bytes(name.encode() * 10)
    seen = images.scan_images(spark, "*", str(tmp_path))
    whole = scoring.image_tasks(tasks(spark, [f"gs://raw/{n}.jpg" for n in "abc"]), seen)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert {r.length for r in whole.collect()} == {10}
