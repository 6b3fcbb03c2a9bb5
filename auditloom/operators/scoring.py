"""Scoring of objects with a pluggable function."""

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators.joins import folded
from auditloom.session import shared_dir

#: Columns of a task, beside its prompt and model, that a scorer is told.
SETTINGS = ("system_instruction", "thinking_level", "code_execution")

SCORED = "response string, error_message string, tries int"
_SCORED_TYPES = (pa.string(), pa.string(), pa.int32())


def usable(text):
    """Whether a response holds JSON where `extract_json` looks for it."""
    text = text or ""
    _, fence, after = text.partition(fixed.FENCE_OPEN)
    body, closed, _ = after.partition(fixed.FENCE_CLOSE)
    if not (fence and closed):
        body = text[text.find("{") : text.rfind("}") + 1] if "{" in text else ""
    try:
        json.loads(body)
    except ValueError:
        return False
    return True


def _answer(scorer, attempts, content, uri, prompt, model, settings):
    """(response, error_message, tries) of one task."""
    if not content:
        return None, f"No content: {uri}", 0
    answer = error = None
    for attempt in range(1, attempts + 1):
        try:
            answer, error = scorer(bytes(content), prompt, model, settings), None
        except Exception as problem:  # pylint: disable=broad-except
            answer, error = None, str(problem) or type(problem).__name__
        if usable(answer):
            break
    return answer, error, attempt


def score(tasks, make_scorer, fetch=None, attempts=fixed.SCORE_ATTEMPTS):
    """Run a scorer over tasks and add response, error_message and tries.

    `make_scorer()` is called once per partition and returns
    `(bytes, prompt, model, settings) -> text`; `settings` holds the task's
    system instruction, thinking level and code switch by name, as far as the
    tasks have these columns. The bytes are the `content` column, or
    what `fetch(uri)` reads inside the task, which keeps them out of any
    shuffle. A scorer that raises or answers without usable JSON is tried
    `attempts` times; after that the row gets the error, or the last answer if
    that did not raise. Without bytes the row gets an error at once.
    """
    keep = [f for f in tasks.schema.fields if f.name != "content"]

    def run(batches):
        scorer = make_scorer()
        for batch in batches:
            names = batch.schema.names

            def values(name):
                return batch.column(names.index(name)).to_pylist()

            uris = values("gcs_uri")
            content = map(fetch, uris) if fetch is not None else values("content") if "content" in names else [None] * len(uris)
            known = [c for c in SETTINGS if c in names]
            told = (dict(zip(known, row)) for row in zip(*map(values, known))) if known else ({} for _ in uris)
            rows = zip(content, uris, values("prompt_text"), values("model_name"), told)
            done = [_answer(scorer, attempts, *row) for row in rows]
            # All other columns go on as they came.
            out = [(f.name, batch.column(names.index(f.name))) for f in keep]
            for place, (name, kind) in enumerate(zip(("response", "error_message", "tries"), _SCORED_TYPES)):
                out.append((name, pa.array([d[place] for d in done], kind)))
            yield pa.RecordBatch.from_arrays([column for _, column in out], names=[name for name, _ in out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return tasks.mapInArrow(run, f"{schema}, {SCORED}")


def with_content(tasks, images):
    """Tasks with the bytes of their object, NULL when it is missing."""
    return tasks.join(images.select("gcs_uri", "content"), "gcs_uri", "left")


def spread(tasks, partitions):
    """Even partitions for slow scoring, made before any bytes are attached."""
    return tasks.repartition(partitions, F.xxhash64("gcs_uri", "prompt_version_id"))


def image_tasks(tasks, listing):
    """One row an object: `gcs_uri`, its `length` by the listing and `tasks`, an array with all its tasks.

    An object has as many tasks as there are versions. One that is not listed
    has the length 0. Only names and lengths of the listing are read, no bytes.
    """
    rest = [c for c in tasks.columns if c != "gcs_uri"]
    whole = tasks.groupBy("gcs_uri").agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("tasks"))
    sizes = folded(listing, "gcs_uri", F.max("length").alias("length"))
    return whole.join(sizes, "gcs_uri", "left").withColumn("length", F.coalesce("length", F.lit(0)))


def balanced(images, partitions):
    """`images` in that many partitions of about as many bytes each.

    An object belongs to the partition in which the bytes before it end, when all
    objects are lined up. The sum of the bytes before is carried from part to part:
    rows are summed inside even parts, which are written so that they stay as they
    are, and the parts' totals are as many as there are partitions. An object
    counts one byte more than it has, so that many small ones are spread too.
    """
    spark = images.sparkSession
    path = shared_dir(spark, "lined-up")
    parts = images.repartitionByRange(partitions, "gcs_uri")
    parts.withColumn("_part", F.spark_partition_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    size = F.col("length") + 1
    totals = rows.groupBy("_part").agg(F.sum(size).alias("_bytes"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row a partition.
    offsets = totals.select("_part", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_offset"))
    whole = totals.agg(F.sum("_bytes")).scalar()
    inside = Window.partitionBy("_part").orderBy("gcs_uri").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_offset") + F.coalesce(F.sum(size).over(inside), F.lit(0))
    slot = F.least(F.floor(before * partitions / whole), F.lit(partitions - 1)).cast("int")
    placed = rows.join(offsets, "_part").withColumn("_slot", slot)
    return placed.repartitionById(partitions, "_slot").drop("_part", "_offset", "_slot")


def score_images(images, make_scorer, fetch, attempts=fixed.SCORE_ATTEMPTS):
    """Score all tasks of each object of `image_tasks`; the result is that of `score`.

    `fetch(uri)` reads the bytes inside the task, once an object whatever its
    tasks are, so that they never pass a shuffle.
    """
    task = images.schema["tasks"].dataType.elementType
    names = [f.name for f in task.fields]

    def run(batches):
        scorer = make_scorer()
        for pdf in batches:
            made = []
            for uri, tasks in zip(pdf["gcs_uri"], pdf["tasks"]):
                content = fetch(uri)
                for row in tasks:
                    told = {c: row[c] for c in SETTINGS if c in names}
                    done = _answer(scorer, attempts, content, uri, row["prompt_text"], row["model_name"], told)
                    made.append((uri, *[row[c] for c in names], *done))
            yield pd.DataFrame(made, columns=["gcs_uri", *names, "response", "error_message", "tries"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in task.fields)
    return images.mapInPandas(run, f"gcs_uri string, {kinds}, {SCORED}")
