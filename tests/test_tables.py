"""The partitioned result table and the bucketed job table."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import jobs as operators
from auditloom.sources import tables
from auditloom.sources.jobtable import JobTable
from auditloom.sources.results import PartlyDone, ResultTable

NOW = datetime(2026, 11, 5, 14)


def rows(spark, numbers, value="r"):
    made = [(f"i{n}", f"gs://b/i{n}.jpg", f"v{n % 2}", value) for n in numbers]
    return spark.createDataFrame(made, "image_id string, gcs_uri string, prompt_version_id string, raw_signed_url string")


def uris(spark, *numbers):
    return spark.createDataFrame([(f"gs://b/i{n}.jpg",) for n in numbers], "gcs_uri string")


def files(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def held(spark, path):
    return sorted(r.image_id for r in tables.read_results(spark, path).collect())


@pytest.mark.parametrize("by_uri", [True, False])
def test_changes_touch_only_their_parts(spark, tmp_path, by_uri):
    path = tmp_path / "results"
    tables.write_results(rows(spark, range(40)), str(path), "r1", image_from_uri=by_uri)
    before = files(path)
    assert tables.apply_delete(spark, str(path), uris=uris(spark, 7, 99)) == 1
    after = files(path)
    gone = {p.parent for p in before if p not in after}
    assert len(gone) == 1 and all(before[p] == after[p] for p in before if p.parent not in gone)
    assert held(spark, str(path)) == sorted(f"i{n}" for n in range(40) if n != 7)
    assert tables.apply_delete(spark, str(path), uris=uris(spark, 99)) == 0 and files(path) == after


def test_only_row_of_a_part(spark, tmp_path):
    """The change that leaves a folder without rows returns its count and removes them."""
    path = str(tmp_path / "results")
    tables.write_results(rows(spark, [1]), path, "r1", image_from_uri=True)
    assert tables.apply_delete(spark, path, uris=uris(spark, 1)) == 1
    assert held(spark, path) == [] and tables.apply_delete(spark, path, uris=uris(spark, 1)) == 0
    tables.write_results(rows(spark, [2]), path, "r2")
    assert held(spark, path) == ["i2"]


def test_no_scan_beyond_the_parts(spark, tmp_path):
    path = str(tmp_path / "results")
    tables.write_results(rows(spark, range(40)), path, "r1", image_from_uri=True)
    table = ResultTable(spark, path)
    parts = table.parts_of(uris(spark, 7), "gcs_uri")
    assert len(parts) == 1
    plan = table.rows(parts)._jdf.queryExecution().executedPlan().toString()
    assert f"(part#" in plan and "PartitionFilters: [isnotnull(part" in plan
    keys = table.parts_of(uris(spark, 7), "gcs_uri")
    assert keys == table.parts_of(spark.createDataFrame([("i7",)], "image_id string"), "image_id")


def test_repeated_run_and_newest_run(spark, tmp_path):
    path = str(tmp_path / "results")
    tables.write_results(rows(spark, range(5)), path, "r1")
    tables.write_results(rows(spark, range(5)), path, "r1")
    assert held(spark, path) == [f"i{n}" for n in range(5)]
    # An object and version of a later run replaces the earlier one for readers.
    tables.write_results(rows(spark, [3, 3, 8], "later"), path, "r2")
    got = sorted((r.image_id, r.raw_signed_url) for r in tables.read_results(spark, path).collect())
    assert got == [("i0", "r"), ("i1", "r"), ("i2", "r"), ("i3", "later"), ("i3", "later"), ("i4", "r"), ("i8", "later")]
    # A delete reaches all runs.
    tables.apply_delete(spark, path, uris=uris(spark, 3))
    assert held(spark, path) == ["i0", "i1", "i2", "i4", "i8"]


def test_appends_are_refused_whole(spark, tmp_path):
    path = tmp_path / "results"
    good = rows(spark, range(3))
    tables.write_results(good, str(path), "r1", image_from_uri=True)
    before = files(path)
    with pytest.raises(ValueError, match="Unknown column: other"):
        tables.write_results(good.withColumn("other", F.lit(1)), str(path))
    with pytest.raises(ValueError, match="estimated_percentage is int, not double"):
        tables.write_results(good.withColumn("estimated_percentage", F.lit(1)), str(path))
    with pytest.raises(Exception, match="Row too large"):
        big = F.when(F.col("image_id") == "i2", F.repeat(F.lit("x"), fixed.MAX_ROW_BYTES)).otherwise(F.lit("{}"))
        tables.write_results(good.withColumn("model_result", big), str(path))
    with pytest.raises(Exception, match="Image id is not that of gs://b/i2.jpg"):
        tables.write_results(good.withColumn("image_id", F.nullif("image_id", F.lit("i2"))), str(path))
    assert files(path) == before and held(spark, str(path)) == ["i0", "i1", "i2"]


def test_a_change_that_breaks_off_is_completed_by_repeating_it(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "results")
    tables.write_results(rows(spark, range(40)), path, "r1", image_from_uri=True)
    from auditloom.sources import results

    real = results.file_system

    def broken(spark, path):
        if "/part=" in path:
            raise OSError("down")
        return real(spark, path)

    wanted = uris(spark, *range(40))
    with monkeypatch.context() as patched:
        patched.setattr(results, "file_system", broken)
        with pytest.raises(PartlyDone):
            tables.apply_delete(spark, path, uris=wanted)
    assert tables.still_there(spark, path, wanted, "gcs_uri").count() == 40
    assert tables.apply_delete(spark, path, uris=wanted) == 40
    assert tables.still_there(spark, path, wanted, "gcs_uri").count() == 0


def url_updates(spark, *keys):
    made = [(k, f"new {n}", None, "t") for n, k in enumerate(keys)]
    return spark.createDataFrame(made, "image_id string, raw_signed_url string, thumb_signed_url string, gcs_thumb_uri string")


def test_a_change_writes_rows_once_and_shuffles_none(spark, tmp_path, monkeypatch):
    path, written = str(tmp_path / "results"), []
    tables.write_results(rows(spark, range(400)), path, "r1")
    writer = type(spark.range(1).write)
    real = writer.parquet

    def noted(self, path, *args, **named):
        if "model_result" in self._df.columns:
            written.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, path, *args, **named)

    monkeypatch.setattr(writer, "parquet", noted)
    assert tables.apply_merge(spark, path, url_updates(spark, *[f"i{n}" for n in range(0, 400, 9)])) == 45
    assert tables.apply_delete(spark, path, uris=uris(spark, *range(0, 400, 7))) == 58
    assert len(written) == 2
    assert all("BroadcastHashJoin" in p and "Exchange" not in p.replace("BroadcastExchange", "") for p in written)
    assert not [p.name for p in (tmp_path / "results").iterdir() if p.name.startswith("_staged")]


@pytest.mark.parametrize("most", [1, 5, 100_000])
@pytest.mark.parametrize("by_uri", [True, False])
def test_keys_in_turns(spark, tmp_path, monkeypatch, most, by_uri):
    """Keys broadcast some parts at a time, or joined by a shuffle where a part has too many."""
    from auditloom.sources import results

    monkeypatch.setattr(results, "BROADCAST_KEYS", most)
    path = str(tmp_path / "results")
    made = rows(spark, [*range(30), 3])
    if not by_uri:
        lost = F.when(F.col("image_id") != "i5", F.col("image_id"))
        moved = F.when(F.col("image_id") == "i6", "gs://b/i4.jpg").otherwise(F.col("gcs_uri"))
        made = made.select(lost.alias("image_id"), moved.alias("gcs_uri"), "prompt_version_id", "raw_signed_url")
    ResultTable(spark, path, parts=4, image_from_uri=by_uri).append(made, "r1")
    assert tables.apply_merge(spark, path, url_updates(spark, "i1", "i2", "i3", "i8", "i9", "none", None)) == 6
    got = sorted((r.image_id, r.raw_signed_url) for r in tables.read_results(spark, path).where("image_id is not null").collect())
    fresh = {"i1": "new 0", "i2": "new 1", "i3": "new 2", "i8": "new 3", "i9": "new 4"}
    ids = [f"i{n}" for n in [*range(30), 3] if by_uri or n != 5]
    assert got == sorted((i, fresh.get(i, "r")) for i in ids)
    # One object may have rows of several images.
    gone = uris(spark, 4, 4, 3, 99).union(spark.createDataFrame([(None,)], "gcs_uri string"))
    assert tables.apply_delete(spark, path, uris=gone) == (3 if by_uri else 4)
    left = {i for i in ids if i not in ("i3", "i4") and (by_uri or i != "i6")}
    assert {r.image_id for r in tables.read_results(spark, path).collect()} - {None} == left


def test_a_folder_that_cannot_be_renamed_keeps_its_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "results")
    ResultTable(spark, path, parts=1).append(rows(spark, range(9)), "r1")

    real = ResultTable._put

    def broken(self, new, folder, beside):
        real(self, new + "-missing", folder, beside)

    with monkeypatch.context() as patched:
        patched.setattr(ResultTable, "_put", broken)
        with pytest.raises(PartlyDone):
            tables.apply_merge(spark, path, url_updates(spark, "i1"))
    assert held(spark, path) == [f"i{n}" for n in range(9)]
    assert tables.apply_merge(spark, path, url_updates(spark, "i1")) == 1
    assert held(spark, path) == [f"i{n}" for n in range(9)]


# --- job table --------------------------------------------------------------


def jobs(spark, numbers, status="QUEUED", version="v1"):
    made = [(f"gs://b/o{n}.jpg", version, status, NOW, n, None, None, None, None) for n in numbers]
    return spark.createDataFrame(made, fixed.JOB_SCHEMA)


def states(spark, path):
    return sorted((r.gcs_uri, r.prompt_version_id, r.status) for r in tables.read_jobs(spark, path).collect())


def test_job_changes_touch_only_their_partitions(spark, tmp_path):
    path = tmp_path / "jobs"
    assert tables.read_jobs(spark, str(path)).count() == 0
    tables.write_jobs(jobs(spark, range(60)), str(path))
    before = files(path)
    fresh = jobs(spark, [3], "PROCESSED").unionByName(jobs(spark, [3], "QUEUED", "v2"))
    tables.change_jobs(spark, str(path), fresh)
    after = files(path)
    changed = {p.parent for p in before.keys() ^ after.keys()}
    assert len(changed) == 1 and all(before[p] == after[p] for p in before.keys() & after.keys())
    got = states(spark, str(path))
    assert len(got) == 61 and [s for u, _, s in got if u.endswith("o3.jpg")] == ["PROCESSED", "QUEUED"]


def test_jobs_of_a_partition_all_go(spark, tmp_path):
    path = str(tmp_path / "jobs")
    tables.write_jobs(jobs(spark, [1, 2]), path)
    gone = jobs(spark, [1]).select("gcs_uri")
    tables.change_jobs(spark, path, gone=gone, on=["gcs_uri"])
    assert [u for u, _, _ in states(spark, path)] == ["gs://b/o2.jpg"]
    tables.change_jobs(spark, path, jobs(spark, [5]), gone=jobs(spark, [2]))
    assert [u for u, _, _ in states(spark, path)] == ["gs://b/o5.jpg"]
    tables.change_jobs(spark, path, jobs(spark, []))
    tables.write_jobs(jobs(spark, [9]), path)
    assert [u for u, _, _ in states(spark, path)] == ["gs://b/o9.jpg"]


def test_another_session_sees_the_table(spark, tmp_path):
    path = str(tmp_path / "jobs")
    tables.write_jobs(jobs(spark, range(10)), path)
    name = JobTable(spark, path).name
    spark.sql(f"drop table {name}")
    assert len(states(spark, path)) == 10


def job_side_exchanges(df, name):
    """Exchanges between the scan of the table and the join."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    scan = next(i for i, line in enumerate(lines) if name in line)
    depth, found = lines[scan].index("FileScan"), []
    for line in reversed(lines[:scan]):
        at = len(line) - len(line.lstrip(" :+-"))
        if at < depth:
            depth = at
            if "Join" in line:
                break
            found += ["Exchange"] if line.lstrip(" :+-").startswith("Exchange") else []
    return found, "Bucketed: true" in lines[scan]


def test_look_up_and_upsert_do_not_exchange_the_table(spark, tmp_path):
    path = str(tmp_path / "jobs")
    tables.write_jobs(jobs(spark, range(200)), path)
    table, name = tables.read_jobs(spark, path), JobTable(spark, path).name
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        events = spark.createDataFrame([("gs://b/o1.jpg", 5)], "gcs_uri string, generation bigint")
        versions = spark.createDataFrame([("v1",)], "prompt_version_id string")
        looked = operators.with_job_state(events.withColumn("prompt_version_id", F.lit("v1")), table)
        merged = operators.upsert_jobs(table, jobs(spark, [1], "PROCESSED"))
        for df in (looked, merged):
            assert job_side_exchanges(df, name) == ([], True)
        folded = operators._with_object_jobs(events, versions, table)
        assert folded.count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keys_of_a_delete_are_worked_out_once(spark, tmp_path):
    path, seen = str(tmp_path / "t"), tmp_path / "seen"
    seen.mkdir()
    row = spark.range(4).selectExpr("concat('gs://b/o', id, '.jpg') as gcs_uri", "concat('i', id) as image_id")
    ResultTable(spark, path).append(row, "r")

    def note(batches):
        import uuid

        (seen / uuid.uuid4().hex).touch()
        yield from batches

    keys = row.select("gcs_uri").where("image_id = 'i2'").coalesce(1).mapInPandas(note, "gcs_uri string")
    assert tables.apply_delete(spark, path, uris=keys) == 1
    assert len(list(seen.iterdir())) == 1
