"""Scoring and the four jobs over stored tables."""

import json
import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import catalogue, refresh, scoring
from auditloom.plans import jobs as plans
from auditloom.sources import config, images, tables
from auditloom.sources.events import read_object_events

CONFIG = __file__.rsplit("/", 1)[0] + "/data/config"
NOW = datetime(2026, 11, 5, 14)

# The scorers below run in Python workers, which cannot import a test file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def at(spark, moment):
    return spark.createDataFrame([(moment,)], "n timestamp").scalar()


def scorer():
    def score(content, prompt, model, settings):
        assert settings["system_instruction"] if "system_instruction" in settings else not settings
        if content == b"bad":
            raise RuntimeError("model is down")
        if content == b"prose":
            return "I see nothing."
        body = json.dumps({"TotalWeightLbs": len(content), "Paper": {"Boxes": 0.25, "Sheets": 0.75}})
        return f"{prompt} {model}\n```json\n{body}\n```"

    return score


def counting_scorer():
    calls = {}

    def score(content, prompt, model, settings):
        assert settings == {}
        calls[content] = calls.get(content, 0) + 1
        if calls[content] <= int(content):
            raise ValueError("not yet")
        return "{}"

    return score


def test_retries_are_bounded(spark):
    rows = [(str(n), f"u{n}", str(n).encode(), "p", "m") for n in range(6)]
    tasks = spark.createDataFrame(
        rows, "prompt_version_id string, gcs_uri string, content binary, prompt_text string, model_name string"
    ).coalesce(1)
    got = {r.gcs_uri: r for r in scoring.score(tasks, counting_scorer).collect()}
    assert [got[f"u{n}"].tries for n in range(6)] == [1, 2, 3, 4, 4, 4]
    assert [got[f"u{n}"].response for n in range(6)] == ["{}"] * 4 + [None] * 2
    assert got["u5"].error_message == "not yet"


def test_unusable_answers_are_retried(spark):
    answers = ["", "prose", '{"a": oops}', "```json\n[1]\n``` {"]

    def make():
        given = iter(answers)
        return lambda content, prompt, model, settings: next(given)

    rows = spark.createDataFrame(
        [("u", b"x", "p", "m")], "gcs_uri string, content binary, prompt_text string, model_name string")
    got = scoring.score(rows, make).first()
    assert (got.response, got.error_message, got.tries) == (answers[3], None, 4)
    last = scoring.score(rows, make, attempts=2).first()
    assert (last.response, last.error_message, last.tries) == ("prose", None, 2)


def test_failures_undo_claims_and_leases(spark, tmp_path, monkeypatch):
    versions = spark.createDataFrame([("v1",)], "prompt_version_id string")
    jobs_path, results_path, tasks_path = (str(tmp_path / n) for n in ("jobs", "results", "tasks"))
    fresh = write_events(tmp_path / "in", [event("new.jpg", 2), event("old.jpg", 2)])
    old = ("gs://raw/old.jpg", "v1", "PROCESSED", None, 1, 1, NOW, None, None)
    before = spark.createDataFrame([old], fixed.JOB_SCHEMA)
    tables.write_jobs(before, jobs_path)
    stored = lambda: sorted(map(tuple, tables.read_jobs(spark, jobs_path).collect()))
    first = stored()

    def fail(*_, **__):
        raise RuntimeError("down")

    raw = read_object_events(spark, fresh)
    args = (spark, raw, versions, jobs_path, results_path, tasks_path, at(spark, NOW))
    with monkeypatch.context() as patched:
        patched.setattr(tables, "apply_delete", fail)
        with pytest.raises(RuntimeError):
            plans.ingest(*args)
    assert stored() == first
    with pytest.raises(RuntimeError):
        plans.ingest(*args, dispatch=fail)
    # The rows of the old object are gone by now: it is to be retried at once.
    assert [(r[0], r[2], r[5]) for r in stored()] == [("gs://raw/old.jpg", "FAILED_RETRY", 5)]

    tables.write_jobs(before, jobs_path)
    listing = lambda: spark.createDataFrame([], "gcs_uri string, generation bigint")
    with monkeypatch.context() as patched:
        patched.setattr(tables, "apply_delete", fail)
        with pytest.raises(RuntimeError):
            plans.delete(spark, raw, jobs_path, results_path, listing, at(spark, NOW))
    assert stored() == first
    plans.delete(spark, raw, jobs_path, results_path, listing, at(spark, NOW))
    assert stored() == []


def test_a_delete_without_generation_wins(spark):
    rows = [("a", 5), ("a", None), ("b", 1), ("b", 3), ("c", None)]
    deletes = spark.createDataFrame(rows, "gcs_uri string, generation bigint")
    got = {r.gcs_uri: r.generation for r in plans.one_delete_per_object(deletes).collect()}
    assert got == {"a": None, "b": 3, "c": None}


def test_due_images_keep_their_first_row(spark):
    rows = [("i", "gs://a/i.jpg", NOW), ("i", "gs://b/i.jpg", NOW - timedelta(days=30)), ("j", "gs://a/j.jpg", NOW)]
    table = spark.createDataFrame(rows, "image_id string, gcs_uri string, processing_timestamp timestamp")
    due = refresh.rows_of_due_images(table.withColumn("gcs_thumb_uri", F.lit(None).cast("string")), at(spark, NOW))
    first = refresh.first_per_image(refresh.active_records(due)).collect()
    assert [(r.image_id, r.gcs_uri) for r in first] == [("i", "gs://a/i.jpg")]


def test_fetch_reads_inside_the_task(spark):
    tasks = spark.createDataFrame(
        [("u1", "p", "m"), ("gone", "p", "m")], "gcs_uri string, prompt_text string, model_name string")
    scored = scoring.score(tasks, scorer, fetch=lambda uri: None if uri == "gone" else uri.encode())
    got = {r.gcs_uri: (r.response is not None, r.error_message) for r in scored.collect()}
    assert got == {"u1": (True, None), "gone": (False, "No content: gone")}


def write_events(folder, rows):
    folder.mkdir()
    (folder / "part.json").write_text("\n".join(json.dumps(r) for r in rows))
    return str(folder)


def event(name, generation, bucket="raw"):
    return {"bucket": bucket, "name": name, "generation": generation}


def test_whole_audit(spark, tmp_path):
    root = tmp_path / "objects"
    (root / "raw" / "d").mkdir(parents=True)
    for name, content in {"a.jpg": b"abcd", "d/b.jpg": b"bad", "c.png": b"prose", "e.jpg": b"efghij"}.items():
        (root / "raw" / name).write_bytes(content)
    seen = images.scan_images(spark, "*", str(root))
    assert {r.gcs_uri: r.length for r in seen.collect()}["gs://raw/d/b.jpg"] == 3
    rooted = images.scan_images(spark, "*", f"file://{root}/")
    assert {r.gcs_uri for r in rooted.collect()} == {r.gcs_uri for r in seen.collect()}

    jobs_path, results_path, errors_path, tasks_path = (
        str(tmp_path / n) for n in ("jobs", "results", "errors", "tasks"))
    general, models, materials = config.read_config(spark, CONFIG)
    rendered = catalogue.render_prompts(catalogue.config_versions(models, general), materials)

    first = write_events(tmp_path / "in1", [
        event("a.jpg", 1), event("a.jpg", 2), event("d/b.jpg", 1), event("c.png", None), event("gone.jpg", 5),
        event("notes.txt", 1), event("", 1), event("x.jpg", -1)])
    rejected, decisions = plans.ingest(
        spark, read_object_events(spark, first), rendered, jobs_path, results_path, tasks_path, at(spark, NOW))
    assert rejected.count() == 2
    assert {r.outcome for r in decisions.collect()} == {"queued"} and decisions.count() == 8
    tasks = tables.read_table(spark, tasks_path, "gcs_uri string, prompt_version_id string")
    assert tasks.count() == 8

    extra = spark.createDataFrame([("gs://raw/a.jpg", "nope")], "gcs_uri string, prompt_version_id string")
    attempt = tasks.unionByName(extra).withColumn("attempt", F.lit(1))
    sign = lambda c: F.concat(F.lit("https://s/"), c)
    outcome = plans.work(spark, attempt, rendered, scorer, jobs_path, results_path, errors_path,
                         at(spark, NOW + timedelta(minutes=5)), images=seen, sign=sign)
    assert outcome.where("ok").count() == 2
    rows = tables.read_results(spark, results_path)
    assert rows.columns == [c.split()[0] for c in fixed.RESULT_SCHEMA.split(", ")]
    got = sorted((r.prompt_version_id, r["class"], r.material, r.estimated_percentage, r.scaled_weight) for r in rows.collect())
    want = [(v, *r) for v in ("a1", "a2") for r in (
        ("Class", "Paper", 1.0, 4.0), ("Paper", "Boxes", 0.25, 1.0), ("Paper", "Sheets", 0.75, 3.0))]
    assert got == want
    row = rows.where("material = 'Boxes' and prompt_version_id = 'a1'").first()
    assert (row.image_id, row.model_name, row.gcs_thumb_uri) == (
        "a", "scorer-one", "gs://raw-thumbnails/thumbnails/a_thumb.webp")
    assert json.loads(row.model_result)["TotalWeightLbs"] == 4
    errors = {(r.image_id, r.prompt_version_id): (r.model_name, r.error_message)
              for r in tables.read_errors(spark, errors_path).collect()}
    assert errors[("b", "a1")] == ("scorer-one", "model is down")
    assert errors[("c", "a2")] == ("scorer-two-b", "no_json")
    assert errors[("gone", "a1")][1] == "No content: gs://raw/gone.jpg"
    assert errors[("a", "nope")] == ("unknown", "Prompt version 'nope' not found.")
    state = {(r.gcs_uri, r.prompt_version_id): r.status for r in tables.read_jobs(spark, jobs_path).collect()}
    assert state[("gs://raw/a.jpg", "a1")] == "PROCESSED" and state[("gs://raw/d/b.jpg", "a1")] == "FAILED_RETRY"
    assert state[("gs://raw/a.jpg", "nope")] == "FAILED_PERMANENT"

    # A newer object replaces rows; the same generation is skipped; one dispatch is refused.
    later = NOW + timedelta(minutes=30)
    second = write_events(tmp_path / "in2", [event("a.jpg", 3), event("gone.jpg", 4), event("e.jpg", 1)])
    refuse = lambda t: t.where("gcs_uri like '%e.jpg' or (gcs_uri like '%a.jpg' and prompt_version_id = 'a2')")
    _, decisions = plans.ingest(
        spark, read_object_events(spark, second), rendered, jobs_path, results_path, tasks_path,
        at(spark, later), dispatch=refuse)
    outcomes = {(r.gcs_uri[-6:], r.outcome, r.delete_superseded_rows) for r in decisions.collect()}
    assert outcomes == {("/a.jpg", "queued", True), ("ne.jpg", "skipped", False), ("/e.jpg", "queued", False)}
    assert tables.read_results(spark, results_path).count() == 0
    assert tables.read_table(spark, tasks_path, "gcs_uri string, prompt_version_id string").count() == 9
    state = {(r.gcs_uri, r.prompt_version_id): (r.status, r.attempts) for r in tables.read_jobs(spark, jobs_path).collect()}
    assert state[("gs://raw/a.jpg", "a1")] == ("QUEUED", None)
    assert state[("gs://raw/a.jpg", "a2")] == ("FAILED_RETRY", 5)
    assert ("gs://raw/e.jpg", "a1") not in state

    todo = spark.createDataFrame([("gs://raw/a.jpg", "a1", 1)], "gcs_uri string, prompt_version_id string, attempt int")
    plans.work(spark, todo, rendered, scorer, jobs_path, results_path, errors_path,
               at(spark, later), fetch=lambda uri: b"xyz", sign=sign, partitions=2)
    assert tables.read_results(spark, results_path).count() == 3

    thumbs = spark.createDataFrame([("gs://raw-thumbnails/thumbnails/a_thumb.webp",)], "thumb_uri string")
    new = lambda c: F.concat(F.lit("https://new/"), c)
    count, backlog = plans.refresh_urls(spark, results_path, thumbs, new, at(spark, later), due_only=True)
    assert count == 0
    count, backlog = plans.refresh_urls(spark, results_path, thumbs, new, at(spark, later))
    assert count == 1 and backlog.count() == 0
    assert {r.raw_signed_url for r in tables.read_results(spark, results_path).collect()} == {"https://new/gs://raw/a.jpg"}

    # A stale delete, one whose object returns during the lease, and a real one.
    def listing(rows):
        return spark.createDataFrame(rows, "gcs_uri string, generation bigint")

    third = write_events(tmp_path / "in3", [event("a.jpg", 3), event("d/b.jpg", 1), event("c.png", 1)])
    views = iter([listing([("gs://raw/c.png", 2)]), listing([("gs://raw/c.png", 2), ("gs://raw/d/b.jpg", 9)])])
    much_later = later + timedelta(hours=3)
    plan, removed = plans.delete(spark, read_object_events(spark, third), jobs_path, results_path,
                                 lambda: next(views), at(spark, much_later))
    assert {(r.gcs_uri, r.action) for r in plan.collect()} == {("gs://raw/a.jpg", "delete"), ("gs://raw/d/b.jpg", "delete")}
    assert removed == 3 and tables.read_results(spark, results_path).count() == 0
    left = {(r.gcs_uri, r.status) for r in tables.read_jobs(spark, jobs_path).collect()}
    assert ("gs://raw/d/b.jpg", "FAILED_RETRY") in left and not any("a.jpg" in u for u, _ in left)
