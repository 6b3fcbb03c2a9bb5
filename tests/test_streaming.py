"""Streaming jobs and the keyed state processor."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from auditloom.streaming import ingest, reconcile
from auditloom.streaming.reconcile import MINUTE, NONE, ObjectProcessor


class FakeMap:
    def __init__(self):
        self.data = {}

    def iterator(self):
        return iter([(k, v) for k, v in self.data.items()])

    def containsKey(self, key):
        return key in self.data

    def getValue(self, key):
        return self.data[key]

    def updateValue(self, key, value):
        self.data[key] = value

    def removeKey(self, key):
        del self.data[key]

    def clear(self):
        self.data = {}


class FakeHandle:
    def __init__(self):
        self.maps, self.timers = {}, []

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, FakeMap())

    def registerTimer(self, at):
        self.timers.append(at)


class Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


class Driver:
    """Feeds one object's processor and collects what it decides."""

    def __init__(self, versions=("v1",), leased=False):
        self.handle, self.processor = FakeHandle(), ObjectProcessor(versions, leased=leased)
        self.processor.init(self.handle)

    @property
    def jobs(self):
        return {k[0]: v for k, v in self.handle.maps["jobs"].data.items()}

    def feed(self, now, *rows):
        columns = ["kind", "generation", "prompt_version_id", "status", "attempts", "error_message"]
        frame = pd.DataFrame([(*r, *("", "", 0, "")[len(r) - 2 :]) for r in rows], columns=columns)
        (out,) = self.processor.handleInputRows(("u",), iter([frame]), Clock(now))
        return [(r.kind, r.outcome, r.generation, r.delete_superseded_rows) for r in out.itertuples()]

    def fire(self, now):
        (out,) = self.processor.handleExpiredTimer(("u",), Clock(now), None)
        return [(r.kind, r.outcome, r.generation, r.delete_superseded_rows) for r in out.itertuples()]


def test_newer_object_waits_for_the_lease():
    d = Driver()
    assert d.feed(0, ("finalize", 5)) == [("finalize", "queued", 5, False)]
    assert d.feed(MINUTE, ("finalize", 4)) == [("finalize", "skipped", 4, False)]
    assert d.feed(MINUTE, ("finalize", 5)) == [("finalize", "skipped", 5, False)]
    assert d.feed(MINUTE, ("finalize", 7)) == [("finalize", "deferred_in_flight", 7, False)]
    assert d.handle.timers == [120 * MINUTE + 1]
    assert d.feed(2 * MINUTE, ("finalize", 6)) == [("finalize", "deferred_in_flight", 6, False)]
    assert d.fire(120 * MINUTE + 1) == [("finalize", "queued", 7, True)]
    assert d.jobs["v1"][1] == 7


def test_result_releases_the_waiting_event():
    d = Driver(("v1", "v2"))
    d.feed(0, ("finalize", 5))
    d.feed(1, ("finalize", 7))
    done = d.feed(2, ("result", NONE, "v1", "PROCESSED", 1))
    assert done == [("finalize", "queued", 7, True), ("finalize", "deferred_in_flight", 7, False)]
    done = d.feed(3, ("result", NONE, "v2", "FAILED_RETRY", 5))
    assert ("finalize", "queued", 7, True) in done


def test_delete_needs_all_versions_settled():
    d = Driver(("v1", "v2"))
    d.feed(0, ("finalize", 5))
    assert d.feed(1, ("delete", 4)) == [("delete", "skip_stale_generation", 4, False)]
    assert d.feed(1, ("delete", 5)) == [("delete", "defer_in_flight", 5, False)]
    d.feed(2, ("result", NONE, "v1", "PROCESSED", 1))
    assert d.jobs
    assert ("delete", "delete", 5, False) in d.feed(3, ("result", NONE, "v2", "PROCESSED", 1))
    assert d.jobs == {}
    assert d.feed(4, ("finalize", 6))[0] == ("finalize", "queued", 6, False)


def test_unknown_generation_is_covered_by_a_known_one():
    d = Driver()
    assert d.feed(0, ("finalize", NONE), ("finalize", 3)) == [
        ("finalize", "queued", 3, False), ("finalize", "skipped", NONE, False)]


@pytest.fixture()
def event_files(spark, tmp_path):
    """Four files of events in which one object owns a third of the rows."""
    rows = spark.range(3000).select(
        F.concat(F.lit("gs://b/o"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 57).cast("string"), F.lit(".jpg")).alias("gcs_uri"),
        F.lit("finalize").alias("kind"),
        F.when(F.col("id") % 13 == 0, None).otherwise((F.col("id") * 7919) % 3001 + 1).alias("generation"),
    )
    path = str(tmp_path / "events")
    rows.repartition(4).write.parquet(path)
    return path, rows


def stream(spark, path, rows):
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_over_split_files_ends_where_the_batch_does(spark, tmp_path, event_files):
    path, rows = event_files
    decisions = reconcile.reconcile_stream(stream(spark, path, rows), ["v1", "v2"], settled=True)
    out = str(tmp_path / "out")
    reconcile.start_decisions(decisions, out, str(tmp_path / "check")).awaitTermination(120)
    got = spark.read.parquet(out).where("outcome = 'queued'").groupBy("gcs_uri", "prompt_version_id").agg(
        F.max("generation").alias("g"))
    want = rows.groupBy("gcs_uri").agg(F.max("generation").alias("g"))
    assert sorted((r.gcs_uri, r.g) for r in got.where("prompt_version_id = 'v2'").collect()) == sorted(
        map(tuple, want.collect()))


def test_latest_ignores_arrival_order(spark, tmp_path, event_files):
    path, rows = event_files
    out = str(tmp_path / "out")
    reconcile.start_latest(stream(spark, path, rows), out, str(tmp_path / "check")).awaitTermination(120)
    got = spark.read.parquet(out).groupBy("gcs_uri").agg(F.max("generation").alias("g"))
    want = rows.groupBy("gcs_uri").agg(F.max("generation").alias("g"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ingest_is_idempotent(spark, tmp_path):
    good = '{"TotalWeightLbs": 2, "A": {"x": 0.5}}'
    first = spark.createDataFrame([("u1", good), ("u2", "prose")], "uri string, response string")
    again = spark.createDataFrame([("u1", good.replace("0.5", "0.25")), ("u3", good)], "uri string, response string")
    source, rows, errors, check = (str(tmp_path / n) for n in ("in", "rows", "errors", "check"))
    first.coalesce(1).write.parquet(source)
    for batch in (None, again):
        if batch is not None:
            batch.coalesce(1).write.mode("append").parquet(source)
        live = spark.readStream.schema("uri string, response string").parquet(source)
        ingest.start_ingest(live, rows, errors, check).awaitTermination(120)
    got = ingest.read_rows(spark, rows, ["uri"]).where("class = 'A'")
    assert sorted((r.uri, r.scaled_weight) for r in got.collect()) == [("u1", 0.5), ("u3", 1.0)]
    assert [r.reason for r in spark.read.parquet(errors).collect()] == ["no_json"]


def test_live_state_survives_between_runs(spark, tmp_path):
    """The form with timers, one batch per run on one checkpoint."""
    columns = "gcs_uri string, kind string, generation bigint, prompt_version_id string, status string, attempts int"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    big = 2**62 + 1
    batches = [
        [("u", "finalize", 5, None, None, None), ("w", "finalize", None, None, None, None)],
        [("u", "finalize", big, None, None, None), ("u", "finalize", big - 1, None, None, None),
         ("w", "delete", 3, None, None, None)],
        [("u", "result", None, "v1", "PROCESSED", 1), ("w", "result", None, "v1", "FAILED_RETRY", 5)],
    ]
    seen = []
    for batch in batches:
        spark.createDataFrame(batch, columns).coalesce(1).write.mode("append").parquet(source)
        live = spark.readStream.schema(columns).parquet(source)
        decisions = reconcile.reconcile_stream(live, ["v1"])
        query = reconcile.start_decisions(decisions, out, check, trigger={"once": True})
        assert query.awaitTermination(120)
        rows = {(r.gcs_uri, r.kind, r.generation, r.outcome) for r in spark.read.parquet(out).collect()}
        seen.append(rows - set().union(*seen))
    assert seen == [
        {("u", "finalize", 5, "queued"), ("w", "finalize", None, "queued")},
        {("u", "finalize", big, "deferred_in_flight"), ("u", "finalize", big - 1, "deferred_in_flight"),
         ("w", "delete", 3, "defer_in_flight")},
        {("u", "finalize", big, "queued"), ("w", "delete", 3, "delete")},
    ]


def test_every_arrival_is_decided_whatever_the_batch_size(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = spark.range(200).selectExpr(
        "'u' as gcs_uri", "'finalize' as kind", "nullif(id % 150, 7) as generation")
    rows.coalesce(1).write.parquet(source)
    made, size = [], "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(size)
    for records in ("10", "10000"):
        spark.conf.set(size, records)
        live = spark.readStream.schema(rows.schema).parquet(source)
        out = str(tmp_path / f"out{records}")
        decisions = reconcile.reconcile_stream(live, ["v1", "v2"], settled=True)
        reconcile.start_decisions(decisions, out, f"{out}-state").awaitTermination()
        made.append(sorted(map(str, spark.read.parquet(out).collect())))
    spark.conf.set(size, usual)
    assert made[0] == made[1] and len(made[0]) == 400


def test_state_is_read_and_written_once_whatever_arrives():
    class Counted(FakeMap):
        calls = 0

        def iterator(self):
            Counted.calls += 1
            return super().iterator()

        def updateValue(self, key, value):
            Counted.calls += 1
            super().updateValue(key, value)

        def containsKey(self, key):
            Counted.calls += 1
            return super().containsKey(key)

        def getValue(self, key):
            Counted.calls += 1
            return super().getValue(key)

    class Handle(FakeHandle):
        def getMapState(self, name, *_):
            return self.maps.setdefault(name, Counted())

    d = Driver(("v1", "v2"))
    d.handle = Handle()
    d.processor.init(d.handle)
    d.feed(0, *[("finalize", g) for g in range(1, 101)])
    few = Counted.calls
    d.feed(1, *[("delete", g) for g in range(1, 101)])
    assert few <= 10 and Counted.calls <= 20


def test_stored_jobs_of_objects_without_events_take_no_state(spark, tmp_path):
    from auditloom import fixed

    columns = "gcs_uri string, kind string, generation bigint"
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([("u3", "finalize", 5), ("u99", "finalize", 5)], columns).coalesce(1).write.parquet(source)
    stored = spark.range(40).selectExpr(
        "concat('u', id) as gcs_uri", "'v1' as prompt_version_id", "'PROCESSED' as status", "null as queued_at",
        "cast(5 as bigint) as generation", "1 as attempts", "null as last_processed_at", "null as error_message",
        "null as deleting_at")
    jobs = spark.createDataFrame([tuple(r) for r in stored.collect()], fixed.JOB_SCHEMA)
    live = spark.readStream.schema(columns).parquet(source)
    query = reconcile.start_decisions(reconcile.reconcile_stream(live, ["v1"], settled=True, jobs=jobs), out, check)
    query.awaitTermination(120)
    assert {(r.gcs_uri, r.outcome) for r in spark.read.parquet(out).collect()} == {("u3", "skipped"), ("u99", "queued")}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) < 10


def test_ingest_keeps_only_what_it_writes(spark, tmp_path, monkeypatch):
    kept, frame = [], type(spark.range(1))
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: kept.append(self.columns) or real(self, *a))
    source = str(tmp_path / "in")
    spark.createDataFrame([("u1", "prose")], "uri string, response string").coalesce(1).write.parquet(source)
    live = spark.readStream.schema("uri string, response string").parquet(source)
    ingest.start_ingest(live, *(str(tmp_path / n) for n in ("rows", "errors", "check"))).awaitTermination(120)
    assert kept == [["uri", "reason", "rows"]]
