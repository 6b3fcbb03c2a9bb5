"""Column expressions against the parameter tables."""

import hashlib
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions import leases, objects, text
from auditloom.streaming import reconcile as stream

NOW = datetime(2026, 11, 5, 14)
BIG = 2**63 - 1


def column(spark, values, fn, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    made = fn(F.col("v"))
    made = made if isinstance(made, tuple) else (made,)
    out = df.select("i", *[m.alias(f"c{n}") for n, m in enumerate(made)]).orderBy("i").collect()
    return [tuple(r)[1:] if len(made) > 1 else r[1] for r in out]


def test_parse_generation(spark):
    cases = {
        "100": 100, "1": 1, str(BIG): BIG, str(BIG + 1): None, "  250 ": 250, "000250": 250,
        "9" * 5000: None, "0" * 5000: None, "0": None, "-5": None, " ": None, "": None, "abc": None,
        "١٢": None, " 7 ": 7, "+5": None, "true": None,
    }
    assert column(spark, list(cases), objects.parse_generation) == list(cases.values())
    assert column(spark, [None], objects.parse_generation) == [None]


def test_bucket_and_name(spark):
    good = ["a", "ab", "a.b-c_d", "été", "1x9"]
    bad = ["", "-a", "a-", "a b", " a", "a/b", "a\tb", ".", "a b", None]
    assert column(spark, good + bad, objects.valid_bucket) == [True] * len(good) + [False] * len(bad)
    assert column(spark, ["x", " ", "", " ", None], objects.valid_name) == [True] + [False] * 4


def test_images(spark):
    names = ["a.jpg", "A.JPEG", "b.PnG", "c.txt", "jpg", "d.jpg.gz", "e.jpg\n"]
    assert column(spark, names, objects.is_supported_image) == [True] * 3 + [False] * 4


def test_image_id(spark):
    cases = {
        "gs://b/d/photo.final.jpg": "photo.final", "gs://b/.hidden": ".hidden", "gs://b/..x.jpg": "..x",
        "gs://b/noext": "noext", "gs://b/d.d/plain": "plain", "gs://b/end.": "end", "gs://b/": "", "...": "...",
    }
    assert column(spark, list(cases), objects.image_id) == list(cases.values())


def test_stem_keeps_folders(spark):
    cases = {"d.x/a.jpg": "d.x/a", "d.x/a": "d.x/a", "a/.b": "a/.b", "a.b.c": "a.b", "x/..y.z": "x/..y"}
    assert column(spark, list(cases), objects.stem) == list(cases.values())


def test_split_uri(spark):
    cases = {
        "gs://raw/photos/p1.jpg": ("raw", "photos/p1.jpg"), "gs://raw": ("raw", ""), "raw": ("raw", ""),
        "raw/a/b/c": ("raw", "a/b/c"), "gs://raw/": ("raw", ""), "gs:///x": ("", "x"), "gs://r//x": ("r", "/x"),
    }
    assert column(spark, list(cases), objects.split_uri) == list(cases.values())
    strict = [v if k.startswith("gs://") and all(v) else (None, None) for k, v in cases.items()]
    assert column(spark, list(cases), lambda c: objects.split_uri(c, strict=True)) == strict


def test_thumbs(spark):
    stored = ["gs://t/x.webp", "gs://t", "", None]
    place = column(spark, stored, lambda c: objects.thumb_location(F.lit("raw"), F.lit("p1"), c))
    assert place == [("t", "x.webp")] + [("raw-thumbnails", "thumbnails/p1_thumb.webp")] * 3
    written = column(spark, ["d/p1.jpg"], lambda c: objects.written_thumb_uri(F.lit("raw"), c))
    assert written == ["gs://raw-thumbnails/thumbnails/d/p1_thumb.webp"]


def test_thumb_size(spark):
    sizes = [(2000, 2000), (400, 200), (100, 300), (50, 40), (200, 200), (1, 4000), (4000, 3), (1000, 333)]
    df = spark.createDataFrame(sizes, "w bigint, h bigint")
    w, h = objects.thumb_size(F.col("w"), F.col("h"))
    got = {(r.w, r.h): (r.tw, r.th) for r in df.select("w", "h", w.alias("tw"), h.alias("th")).collect()}
    assert got == {
        (2000, 2000): (200, 200), (400, 200): (200, 100), (100, 300): (67, 200), (50, 40): (50, 40),
        (200, 200): (200, 200), (1, 4000): (1, 200), (4000, 3): (200, 1), (1000, 333): (200, 67),
    }


def test_job_id(spark):
    want = hashlib.sha256("gs://b/o.jpg:v1".encode()).hexdigest()
    assert column(spark, ["gs://b/o.jpg"], lambda c: objects.job_id(c, F.lit("v1"))) == [want]


EXTRACT = {
    '```json\n{"a": 1}\n```': '{"a": 1}',
    'Why\n```json\n{"a": 1}\n```\nend': '{"a": 1}',
    '```json   {"a": 1}   ```': '{"a": 1}',
    '{"a": 1}': '{"a": 1}',
    'x {"a": 1} y': '{"a": 1}',
    '{"a": {"b": 2}}': '{"a": {"b": 2}}',
    "none": None,
    "": None,
    "only {": None,
    "only }": None,
    "} {": "",
    "```json```{\"a\": 1}": "",
    '```json {"a": 1}': '{"a": 1}',
    '```json {"a": 1}``` ```json {"b": 2}```': '{"a": 1}',
    '{\n"a":\n1}': '{\n"a":\n1}',
}


def test_extract_json(spark):
    assert column(spark, list(EXTRACT), text.extract_json) == list(EXTRACT.values())


def job(status=None, generation=None, queued=None, processed=None, deleting=None, attempts=None):
    def at(age):
        return None if age is None else NOW - age

    return (status, at(queued), generation, attempts, at(processed), None, at(deleting))


M, H, US = timedelta(minutes=1), timedelta(hours=2), timedelta(microseconds=1)
Q, S, D = "queued", "skipped", "deferred_in_flight"
TRUTH = [
    (job("PROCESSED", 100), None, S, False),
    (job("QUEUED"), None, S, False),
    (job("FAILED_RETRY", 100, attempts=5), 99, S, False),
    (job("PROCESSED", 100), 100, S, False),
    (job("PROCESSING", 100), 100, S, False),
    (job("DELETING", 100), 100, S, False),
    (job("FAILED_RETRY", 100, processed=5 * M, attempts=2), 100, S, False),
    (job("FAILED_PERMANENT", 100, processed=5 * M, attempts=2), 100, S, False),
    (job("DELETING", 100, deleting=5 * M), 100, S, False),
    (job("QUEUED", 100, queued=H), 200, D, False),
    (job("PROCESSING", 100, processed=H), 200, D, False),
    (job("FAILED_RETRY", 100, processed=10 * M, attempts=4), 200, D, False),
    (job("FAILED_PERMANENT", 100, processed=M, attempts=1), 200, D, False),
    (job("DELETING", 100, deleting=10 * M), 200, D, False),
    (job("DELETING", 100, deleting=5 * M), None, D, False),
    (job("FAILED_RETRY", None, attempts=5), None, Q, False),
    (job("FAILED_RETRY", 100, attempts=5), 100, Q, False),
    (job("FAILED_RETRY", 100, attempts=2), 100, Q, False),
    (job("PROCESSED", 100), 200, Q, True),
    (job("PROCESSED", None), 200, Q, True),
    (job("FAILED_RETRY", 100, attempts=5), 200, Q, True),
    (job("FAILED_RETRY", 100, processed=M, attempts=0), 200, Q, True),
    (job("FAILED_PERMANENT", 100, attempts=5), 200, Q, True),
    (job("QUEUED", 100, queued=H + US), 200, Q, True),
    (job("PROCESSING", 100, processed=H + US), 200, Q, True),
    (job("FAILED_RETRY", 100, processed=10 * M + US, attempts=2), 200, Q, True),
    (job("DELETING", 100, deleting=10 * M + US), 200, Q, True),
    (None, 5, Q, False),
    (None, None, Q, False),
]
JOB = (
    "struct<status:string,queued_at:timestamp,generation:bigint,attempts:bigint,"
    "last_processed_at:timestamp,error_message:string,deleting_at:timestamp>"
)


def test_reconcile_truth_table(spark):
    rows = [(i, j, g) for i, (j, g, _, _) in enumerate(TRUTH)]
    df = spark.createDataFrame(rows, f"i int, job {JOB}, g bigint")
    # NOW is a naive local value on the Python side; bring both to one zone.
    now = spark.createDataFrame([(NOW,)], "n timestamp").scalar()
    outcome, gone = leases.reconcile(F.col("job"), F.col("job").isNotNull(), F.col("g"), now)
    got = df.select("i", outcome.alias("o"), gone.alias("d")).orderBy("i").collect()
    assert [(r.o, r.d) for r in got] == [(o, d) for _, _, o, d in TRUTH]


@pytest.mark.parametrize("case", range(len(TRUTH)))
def test_stream_decision_follows_the_same_table(case):
    fields, generation, outcome, gone = TRUTH[case]
    state = None
    if fields is not None:
        status, queued, stored, attempts, processed, _, deleting = fields
        since = {"QUEUED": queued, "DELETING": deleting}.get(status, processed)
        if since is None and status in ("FAILED_RETRY", "FAILED_PERMANENT"):
            since = datetime(2000, 1, 1)
        ms = 10**13 if since is None else 10**13 - -(-((NOW - since) // US) // 1000)
        state = stream.Job(status, stored or stream.NONE, ms, attempts or 0)
    assert stream.decide(state, generation or stream.NONE, 10**13) == (outcome, gone)


def test_fixed_windows_agree():
    assert fixed.IN_FLIGHT_WINDOW == "2 hours" and stream.lease(stream.Job("QUEUED", 0, 0, 0)) == 2 * 3600_000
    assert fixed.RETRY_WINDOW == "10 minutes" and stream.lease(stream.Job("FAILED_RETRY", 0, 0, 1)) == 600_000
    assert fixed.DELETE_WINDOW == "10 minutes" and stream.lease(stream.Job("DELETING", 0, 0, 0)) == 600_000
