"""Jobs, tables, configuration, conversion and refresh operators."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import catalogue, conform, events, jobs, mutate, refresh
from auditloom.sources import config, tables
from auditloom.sources.events import read_object_events

NOW = datetime(2026, 11, 5, 14)


def make_jobs(spark, rows):
    return spark.createDataFrame(rows, fixed.JOB_SCHEMA)


def one(uri, version, status, generation=None, age=None, attempts=None, error=None):
    at = None if age is None else NOW - age
    return (uri, version, status, at, generation, attempts, at, error, at)


def now(spark):
    return spark.createDataFrame([(NOW,)], "n timestamp").scalar()


# --- events -----------------------------------------------------------------


def test_event_lines(spark, tmp_path):
    lines = {
        '{"bucket": "b1", "name": "a.jpg", "generation": "7"}': (None, 7),
        '{"bucket": "b1", "name": "a.jpg", "generation": 7}': (None, 7),
        '{"bucket": "b1", "name": "a.jpg", "generation": "  "}': (None, None),
        '{"bucket": "b1", "name": "a.jpg"}': (None, None),
        '{"bucket": "b1", "name": "a.jpg", "generation": null}': (None, None),
        '{"bucket": 1, "name": "a.jpg"}': ("bad_bucket", None),
        '{"bucket": "b 1", "name": "a.jpg"}': ("bad_bucket", None),
        '{"bucket": "b1/", "name": "a.jpg"}': ("bad_bucket", None),
        '{"name": "a.jpg"}': ("bad_bucket", None),
        '{"bucket": "b1", "name": 123}': ("bad_name", None),
        '{"bucket": "b1", "name": " "}': ("bad_name", None),
        '{"bucket": "b1", "name": "a.jpg", "generation": true}': ("bad_generation", None),
        '{"bucket": "b1", "name": "a.jpg", "generation": 0}': ("bad_generation", None),
        '{"bucket": "b1", "name": "a.jpg", "generation": -3}': ("bad_generation", None),
        '{"bucket": "b1", "name": "a.jpg", "generation": "9223372036854775808"}': ("bad_generation", None),
        '{"bucket": "b1", "name": "a.jpg", "generation": 1.5}': ("bad_generation", None),
        '{"bucket": "b1", "name": "a.jpg", "generation": []}': ("bad_generation", None),
        "[1]": ("not_an_object", None),
        "null": ("not_an_object", None),
        "nonsense": ("not_an_object", None),
    }
    (tmp_path / "lines.txt").write_text("\n".join(lines))
    checked = events.validate_events(read_object_events(spark, str(tmp_path)))
    got = sorted((r.reason or "", r.generation or 0) for r in checked.collect())
    assert got == sorted((a or "", b or 0) for a, b in lines.values())
    valid, rejected = events.quarantine(checked)
    assert valid.count() == 5 and rejected.count() == 15
    assert {r.gcs_uri for r in valid.collect()} == {"gs://b1/a.jpg"}


def test_fan_out_needs_no_join(spark):
    rows = spark.range(20).withColumnRenamed("id", "e")
    versions = spark.range(7).select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("prompt_version_id"))
    whole = events.fan_out(rows, versions)
    assert "Join" not in whole._jdf.queryExecution().executedPlan().toString()
    assert whole.distinct().count() == 140


def test_equal_events_and_repeated_jobs(spark):
    """Equal events stay rows of their own; repeated rows of a job count once."""
    versions = spark.createDataFrame([("v1",), ("v2",), ("v3",)], "prompt_version_id string")
    rows = spark.createDataFrame([("u", 5), ("u", 5)], "gcs_uri string, generation bigint")
    job = ("u", "v1", "PROCESSED", None, 3, 1, None, None, None)
    state = spark.createDataFrame([job, job], fixed.JOB_SCHEMA)
    now = F.lit("2026-01-01").cast("timestamp")
    assert [r.tasks_created for r in jobs.event_summary(rows, versions, state, now).collect()] == [3, 3]
    assert jobs.reconcile(rows, versions, state, now).count() == 6


def test_fan_out_without_versions_or_events(spark):
    rows = spark.range(3)
    none = spark.createDataFrame([], "prompt_version_id string")
    assert events.fan_out(rows, none).count() == 0


# --- jobs -------------------------------------------------------------------


def test_delete_plan_table(spark):
    old, fresh = timedelta(hours=3), timedelta(minutes=10)
    state = make_jobs(spark, [
        one("settled", "v1", "PROCESSED", 100), one("settled", "v2", "DELETING", 100, old),
        one("newer", "v1", "PROCESSING", 100, fresh), one("newer", "v2", "PROCESSED", 200),
        one("queued", "v1", "PROCESSED", 100), one("queued", "v2", "QUEUED", 100, timedelta(hours=2)),
        one("retry", "v1", "PROCESSED", 100), one("retry", "v2", "FAILED_RETRY", 100, fresh, 2),
        one("leased", "v1", "PROCESSED", 100), one("leased", "v2", "DELETING", 100, fresh),
    ])
    deletes = spark.createDataFrame(
        [("settled", 100), ("settled", 200), ("settled", None), ("newer", 100), ("newer", 200),
         ("queued", 100), ("retry", 100), ("leased", 100), ("absent", None)],
        "gcs_uri string, generation bigint",
    )
    plan = jobs.delete_plan(deletes, state, now(spark))
    got = {(r.gcs_uri, r.generation): (r.action, r.target_jobs) for r in plan.collect()}
    assert got == {
        ("settled", 100): ("delete", 2), ("settled", 200): ("delete", 2), ("settled", None): ("delete", 2),
        ("newer", 100): ("skip_stale_generation", 0), ("newer", 200): ("defer_in_flight", 0),
        ("queued", 100): ("defer_in_flight", 0), ("retry", 100): ("defer_in_flight", 0),
        ("leased", 100): ("defer_in_flight", 0), ("absent", None): ("delete", 0),
    }


def test_claim_and_rollback(spark):
    state = make_jobs(spark, [
        one("a", "v1", "PROCESSED", 1, timedelta(hours=5), 3, "old error"),
        one("b", "v1", "FAILED_RETRY", 1, timedelta(hours=5), 5, "old error"),
    ])
    arrivals = spark.createDataFrame([("a", 2), ("b", None), ("c", 9)], "gcs_uri string, generation bigint")
    versions = spark.createDataFrame([("v1",)], "prompt_version_id string")
    decisions = jobs.reconcile(arrivals, versions, state, now(spark))
    claims = jobs.claim(decisions, now(spark)).cache()
    got = {r.gcs_uri: r for r in claims.collect()}
    assert {k: (r.status, r.generation, r.attempts, r.error_message, r.deleting_at, r.last_processed_at)
            for k, r in got.items()} == {
        "a": ("QUEUED", 2, None, None, None, None),
        "b": ("QUEUED", None, None, None, None, None),
        "c": ("QUEUED", 9, None, None, None, None),
    }
    assert got["c"].before is None and got["a"].delete_superseded_rows and not got["b"].delete_superseded_rows

    undone = jobs.rollback(claims, F.lit(True), F.col("delete_superseded_rows"))
    back = {r.gcs_uri: r for r in undone.collect()}
    assert set(back) == {"a", "b"}
    assert (back["a"].status, back["a"].attempts, back["a"].generation, back["a"].error_message) == (
        "FAILED_RETRY", 5, 2, None)
    before = state.where("gcs_uri = 'b'").first()
    assert back["b"].asDict() == before.asDict()
    assert jobs.rollback(claims, F.lit(False), F.lit(False)).count() == 3


def test_upsert_keeps_untouched_fields(spark):
    state = make_jobs(spark, [one("a", "v1", "PROCESSING", 4, timedelta(minutes=1), 1, "kept")])
    results = spark.createDataFrame(
        [("a", "v1", 2, True, None, True), ("n", "v1", 1, False, "boom", True), ("x", "v9", 1, True, "gone", False)],
        "gcs_uri string, prompt_version_id string, attempt int, ok boolean, error_message string, configured boolean",
    )
    got = {r.gcs_uri: r for r in jobs.advance(state, results, now(spark)).collect()}
    assert (got["a"].status, got["a"].attempts, got["a"].generation, got["a"].error_message) == (
        "PROCESSED", 2, 4, "kept")
    assert (got["n"].status, got["n"].error_message) == ("FAILED_RETRY", "boom")
    assert (got["x"].status, got["x"].error_message) == ("FAILED_PERMANENT", "gone")


def test_changes_collapse_to_last_value_per_field(spark):
    blank = [None] * 3
    rows = [("a", "v", "QUEUED", 5, 1, None, 1, *blank), ("a", "v", None, None, 2, "x", 2, *blank),
            ("a", "v", "PROCESSED", None, None, None, 3, *blank)]
    changes = spark.createDataFrame(
        rows, "gcs_uri string, prompt_version_id string, status string, generation bigint, attempts bigint, "
        "error_message string, seq int, queued_at timestamp, last_processed_at timestamp, deleting_at timestamp")
    got = jobs.collapse_changes(changes, "seq").first()
    assert (got.status, got.generation, got.attempts, got.error_message) == ("PROCESSED", 5, 2, "x")


def test_rollback_delete(spark):
    state = make_jobs(spark, [one("a", "v1", "PROCESSED", 1), one("b", "v1", "PROCESSED", 1)])
    plan = spark.createDataFrame([("a", "delete"), ("b", "delete")], "gcs_uri string, action string")
    leased = jobs.lease_delete(state, plan, now(spark))
    assert {r.status for r in leased.collect()} == {"DELETING"}
    got = {r.gcs_uri: r for r in jobs.rollback_delete(leased, F.col("gcs_uri") == "a").collect()}
    assert (got["a"].status, got["a"].attempts, got["a"].deleting_at) == ("FAILED_RETRY", 5, None)
    assert (got["b"].status, got["b"].attempts, got["b"].deleting_at) == ("PROCESSED", None, None)


# --- tables -----------------------------------------------------------------


def results(spark, rows):
    df = spark.createDataFrame(rows, "image_id string, gcs_uri string, prompt_version_id string, raw_signed_url string")
    order = [c.split()[0] for c in fixed.RESULT_SCHEMA.split(", ")]
    return mutate.evolve(df, fixed.RESULT_SCHEMA).select(*order)


def test_snapshots_delete_and_merge(spark, tmp_path):
    path = str(tmp_path / "results")
    assert tables.read_results(spark, path).count() == 0
    rows = results(spark, [("i1", "u1", "v1", "r"), ("i1", "u2", "v1", "r"), ("i2", "u3", "v1", "r"), ("i2", "u3", "v2", "r")])
    tables.write_results(rows, path)
    gone = spark.createDataFrame([("u3", "v2", True), ("u1", "v1", False)],
                                 "gcs_uri string, prompt_version_id string, delete_superseded_rows boolean")
    # The only row of version v2 goes: its partition must not survive.
    assert tables.apply_delete(spark, path, decisions=gone) == 1
    assert tables.read_results(spark, path).where("prompt_version_id = 'v2'").count() == 0
    updates = spark.createDataFrame([("i1", "new", "", None)],
                                    "image_id string, raw_signed_url string, thumb_signed_url string, gcs_thumb_uri string")
    assert tables.apply_merge(spark, path, updates) == 2
    got = {r.gcs_uri: (r.raw_signed_url, r.thumb_signed_url) for r in tables.read_results(spark, path).collect()}
    assert got == {"u1": ("new", ""), "u2": ("new", ""), "u3": ("r", None)}
    assert tables.apply_merge(spark, path, updates.limit(0)) == 0
    assert tables.apply_delete(spark, path, uris=spark.createDataFrame([("u1",), ("u1",)], "gcs_uri string")) == 1
    tables.write_results(results(spark, [("i9", "u9", "v3", "r")]), path)
    assert tables.read_results(spark, path).count() == 3


def test_unfinished_snapshot_is_ignored(spark, tmp_path):
    path = str(tmp_path / "table")
    read = lambda: tables.read_table(spark, path, fixed.JOB_SCHEMA)
    tables.write_snapshot(make_jobs(spark, [one("a", "v1", "QUEUED", 1)]), path)
    (tmp_path / "table" / "snapshot=00000002").mkdir()
    assert read().count() == 1
    tables.write_snapshot(make_jobs(spark, [one("a", "v1", "PROCESSED", 1)]), path)
    assert read().first().status == "PROCESSED"


def test_newest_batch_wins(spark, tmp_path):
    path = str(tmp_path / "batches")
    for number, rows in enumerate([[("a", 1), ("a", 2), ("b", 1)], [("a", 3)]]):
        for _ in range(2):  # a batch written twice counts once
            tables.write_batch(spark.createDataFrame(rows, "k string, v int"), path, number)
    df = spark.read.parquet(path)
    assert sorted((r.k, r.v) for r in tables.newest_batches(df, ["k"]).collect()) == [("a", 3), ("b", 1)]


def test_stale_deletes(spark, tmp_path):
    path = str(tmp_path / "live")
    spark.createDataFrame([("u", 10, "x"), ("w", None, "y")], "gcs_uri string, generation bigint, other string").write.parquet(path)
    live = tables.read_inventory(spark, path)
    assert live.columns == ["gcs_uri", "generation"]
    deletes = spark.createDataFrame([("u", 9), ("u", 10), ("u", 11), ("u", None), ("w", 1), ("x", 1)],
                                    "gcs_uri string, generation bigint")
    assert [tuple(r) for r in mutate.stale_deletes(deletes, live).collect()] == [("u", 9)]
    assert mutate.fresh_deletes(deletes, live).count() == 5


# --- refresh ----------------------------------------------------------------


def test_refresh_rows(spark):
    rows = spark.createDataFrame(
        [("i1", "gs://raw/a/i1.jpg", "gs://t/old.webp"), ("i1", "gs://raw/b/i1.jpg", None), (None, "gs://raw/x", None),
         ("i2", None, None), ("", "gs://raw/y", None), ("i3", "gs://raw", None), ("i4", "gs://raw/i4.jpg", None),
         ("i5", "gs://raw/i5.jpg", "gs://t/i5.webp")],
        "image_id string, gcs_uri string, gcs_thumb_uri string",
    )
    first = refresh.first_per_image(refresh.active_records(rows))
    thumbs = spark.createDataFrame([("gs://raw-thumbnails/thumbnails/i4_thumb.webp",)], "thumb_uri string")
    payload = refresh.url_payload(first, thumbs, lambda c: F.concat(F.lit("s:"), c))
    got = {r.image_id: tuple(r)[1:] for r in payload.collect()}
    t4 = "gs://raw-thumbnails/thumbnails/i4_thumb.webp"
    assert got == {
        "i1": ("s:gs://raw/a/i1.jpg", "s:gs://raw/a/i1.jpg", "gs://t/old.webp"),
        "i4": ("s:gs://raw/i4.jpg", f"s:{t4}", t4),
        "i5": ("s:gs://raw/i5.jpg", "s:gs://raw/i5.jpg", "gs://t/i5.webp"),
    }
    assert sorted(r.image_id for r in refresh.thumb_backlog(first, thumbs).collect()) == ["i1", "i5"]


# --- configuration ----------------------------------------------------------


def test_config_from_csv(spark, tmp_path):
    folder = __file__.rsplit("/", 1)[0] + "/data/config"
    general, models, materials = config.read_config(spark, folder)
    assert [r.material for r in catalogue.valid_materials(materials).orderBy("ord").collect()] == [
        "Boxes", "Sheets", "Cans", "Boxes"]
    reasons = {(r.prompt_version_id, r.model_name): r.reason for r in catalogue.resolve_prompts(models, general).collect()}
    assert reasons == {
        ("a1", "scorer-one"): None, ("a2", "scorer-two"): None, ("a2", "scorer-two-b"): None,
        ("a3", "scorer-three"): "missing_placeholder {material_densities_class}",
        ("a4", "scorer-four"): "unknown_system_key", ("a5", "scorer-five"): "unknown_prompt_key",
    }
    versions = catalogue.config_versions(models, general)
    rendered = {r.prompt_version_id: r for r in catalogue.render_prompts(versions, materials).collect()}
    assert set(rendered) == {"a1", "a2"}
    assert (rendered["a1"].thinking_level, rendered["a1"].code_execution) == ("LOW", True)
    assert (rendered["a2"].model_name, rendered["a2"].thinking_level, rendered["a2"].code_execution) == (
        "scorer-two-b", "MEDIUM", True)
    assert rendered["a1"].prompt_text == "Weigh the picture."
    details = (
        '{\n  "Paper": {\n    "Boxes": {\n      "Density": 106,\n      "Description": "Boxes again"\n    },\n'
        '    "Sheets": {\n      "Density": 150,\n      "Description": "Loose sheets"\n    }\n  },\n'
        '  "Metal": {\n    "Cans": {\n      "Density": 45,\n      "Description": "Drink cans"\n    }\n  }\n}'
    )
    want = (
        f"Sort the pile.\nKnown kinds: {details}\n"
        f"{fixed.DENSITIES_HEADER}    Paper: Dict[str, Material]\n    Metal: Dict[str, Material]\n"
        f"{fixed.DETECTED_HEADER}    Paper: Dict[str, float]\n    Metal: Dict[str, float]\n"
        'Answer like {"TotalWeightLbs": 1}, please.'
    )
    assert rendered["a1"].system_instruction == want
    with pytest.raises(FileNotFoundError):
        config.read_config(spark, str(tmp_path))
    assert config.read_config(spark, str(tmp_path), fallback=folder)[0].count() == 5


def test_missing_keys_and_default_taxonomy(spark):
    df = spark.createDataFrame([("c1", "system_instruction_template"), ("c2", "user_prompt"),
                                ("c2", "system_instruction_template"), ("c3", "other")], "id string, key string")
    got = sorted(map(tuple, catalogue.missing_keys(df, "id", "key", fixed.GENERAL_KEYS).collect()))
    assert got == [("c1", "user_prompt"), ("c3", "system_instruction_template"), ("c3", "user_prompt")]
    sums = config.default_materials(spark).groupBy("class").agg(F.count("*").alias("n"), F.sum("density").alias("d"))
    assert {r["class"]: (r.n, r.d) for r in sums.collect()} == {
        "Paper": (5, 698), "Plastic": (8, 259), "Metal": (2, 271), "Glass": (2, 1379), "Organics": (2, 621),
        "Other": (4, 2661)}


# --- conversion -------------------------------------------------------------

MICROS = 1793048400000000
TYPED = [
    ("BOOL", "string", {"false": False, "1": True, " True ": True, "0": False}, ["maybe", "2", "", "yes", "t"]),
    ("BOOLEAN", "int", {0: False, 1: True}, [2, -1]),
    ("BOOL", "boolean", {True: True, False: False}, []),
    ("BOOL", "double", {}, [1.0]),
    ("INT64", "string", {"3": 3, " 42 ": 42, "-7": -7, "1_000": 1000, "+5": 5},
     ["1.5", "abc", "", str(2**63), "1__0", "_1"]),
    ("INTEGER", "double", {3.9: 3, -3.9: -3}, [float("nan"), float("inf"), 1e30]),
    ("INT64", "boolean", {}, [True]),
    ("FLOAT", "string", {"0.75": 0.75, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, " -2 ": -2.0},
     ["NaN", "inf", "1d", "0x1p3", "", "1e999", "."]),
    ("FLOAT64", "double", {0.5: 0.5}, [float("nan"), float("-inf")]),
    ("FLOAT64", "boolean", {}, [True]),
    ("BYTES", "string", {}, ["text"]),
    ("BYTES", "binary", {b"ab": bytearray(b"ab")}, []),
    ("STRING", "int", {7: "7"}, []),
    ("TIMESTAMP", "string",
     {"2026-10-26T21:00:00Z": MICROS, "2026-10-26 21:00:00 UTC": MICROS, "2026-10-26 21:00:00": MICROS,
      "20261026T210000": MICROS, "2026-10-26T23:00:00.250+02:00": MICROS + 250000, "2026-10-26T21:00": MICROS,
      "2026-10-26T23+0200": MICROS, "2026-10-26": MICROS - 21 * 3600 * 10**6, "20261026": MICROS - 21 * 3600 * 10**6},
     ["not-a-date", "2026", "", "2026-13-01", "2026-10", "tomorrow", "21:00"]),
    ("TIMESTAMP", "double", {1700000000.123: 1700000000123000, 1700000000123.0: 1700000000123000,
                             1700000000123456.0: 1700000000123456, 0.0: 0}, [float("nan"), float("inf")]),
    ("TIMESTAMP", "boolean", {}, [True]),
]


@pytest.mark.parametrize("declared,source,good,bad", TYPED)
def test_conversion(spark, declared, source, good, bad):
    values = list(good) + bad + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {source}")
    out = conform.conform(df, {"v": declared}, keys=["i"]).orderBy("i")
    if declared == "TIMESTAMP":
        out = out.withColumn("v", F.unix_micros("v"))
    rows = out.collect()
    assert [r.v for r in rows] == list(good.values()) + [None] * (len(bad) + 1)
    want = [None] * len(good) + [f"Invalid {declared} value: v"] * len(bad) + [None]
    assert [r.reason for r in rows] == want


def test_nested_values_become_json_and_nested_targets_are_refused(spark):
    df = spark.createDataFrame([Row(a=Row(b=1), c=[1, 2])])
    row = conform.conform(df, {"a": "JSON", "c": "STRING"}).first()
    assert (row.a, row.c) == ('{"b":1}', "[1,2]")
    nested = "a struct<x:double,y:array<double>,z:map<string,double>>, i int"
    odd = [(1.0, None, {"k": None}), (float("nan"), [], {}), (0.0, [1.0, float("inf")], {}), (0.0, [], {"k": float("-inf")}), None]
    rows = conform.conform(spark.createDataFrame([(o, i) for i, o in enumerate(odd)], nested), {"a": "JSON"}, keys=["i"])
    got = [(r.a, r.reason) for r in rows.orderBy("i").collect()]
    assert got == [('{"x":1.0,"y":null,"z":{"k":null}}', None)] + [(None, "Invalid JSON value: a")] * 3 + [(None, None)]
    with pytest.raises(ValueError, match="Unknown column: c"):
        conform.conform(df, {"a": "JSON"})
    with pytest.raises(ValueError, match="Unsupported column c"):
        conform.conform(df, {"a": "JSON", "c": "RECORD"})


def test_first_bad_column_is_named_and_the_audit_fails_whole(spark):
    df = spark.createDataFrame([("x", "1", "z"), ("x", "2", "3"), ("y", "4", "5")], "k string, a string, b string")
    typed = conform.conform(df, {"a": "INT64", "b": "INT64"}, keys=["k"])
    whole = conform.fail_whole(typed, ["k"])
    assert sorted((r.k, r.reason) for r in whole.where("reason is not null").collect()) == [
        ("x", "Invalid INT64 value: b")] * 2


def test_row_bytes(spark):
    long = "é" * 100
    df = spark.createDataFrame(
        [("ab", 1, 0.5, True), (long, 300, None, None), ("", -1, None, None)], "s string, n bigint, d double, b boolean")
    sized = [r[0] for r in df.select(conform.row_bytes(df)).collect()]
    assert sized == [4 + 2 + 9 + 2, 1 + 2 + 200 + 3, 2 + 11]
    fits, large = conform.oversize_split(df, limit=20)
    assert fits.count() == 2 and large.first().row_bytes == 206


def test_micros_are_utc(spark):
    df = spark.createDataFrame([("2026-10-26T21:00:00Z",)], "v string")
    got = conform.conform(df, {"v": "TIMESTAMP"}).select(F.unix_micros("v")).first()[0]
    assert got == int(datetime(2026, 10, 26, 21, tzinfo=timezone.utc).timestamp()) * 10**6


def test_configuration_is_chosen_by_rule(spark, tmp_path):
    """Folders without a sheet or with a broken one are passed over; the last one stands in."""
    import shutil

    sound = __file__.rsplit("/", 1)[0] + "/data/config"
    folders = {n: str(tmp_path / n) for n in ("no_sheet", "no_key", "no_material")}
    for path in folders.values():
        shutil.copytree(sound, path)
    (tmp_path / "no_sheet" / "Materials.csv").unlink()
    (tmp_path / "no_key" / "GeneralConfig.csv").write_text("Key,Value,Description\nother,x,y\n")
    (tmp_path / "no_material" / "Materials.csv").write_text("Class,Material,Density,Description\nPaper,Boxes,much,x\n")

    general, models, materials = config.read_config(spark, sound)
    keys = [r.key for r in general.select("key").where("key is not null").distinct().collect()][:1]
    known = {n: catalogue.refusals(*config.read_config(spark, folders[n]), keys).first().reasons for n in ("no_key", "no_material")}
    assert known == {"no_key": [f"missing_key {keys[0]}", "no_usable_version"], "no_material": ["no_valid_material"]}
    assert catalogue.refusals(general, models, materials, keys).first().reasons == []
    for order, want in (([*folders.values(), sound], sound), ([folders["no_key"], sound, folders["no_material"]], sound),
                        ([folders["no_sheet"], folders["no_material"]], folders["no_material"])):
        source, *sheets = config.choose_config(spark, order, keys)
        assert source.first().source == want
        assert sheets[0].count() == config.read_config(spark, want)[0].count()


def test_built_in_taxonomy_is_a_sheet(spark):
    classes = catalogue.taxonomy(config.default_materials(spark))
    assert {r["class"]: len(r.materials) for r in classes.collect()} == {
        "Paper": 5, "Plastic": 8, "Metal": 2, "Glass": 2, "Organics": 2, "Other": 4}
