"""No caps, no size switches in results: many languages, hot ids, hash clashes, rows without ids."""

import random

import pytest
from pyspark.sql import functions as F

from auditloom.llm import language_evidence, near_duplicates, quality_model, quality_rules, toxicity, training
from auditloom.llm.common import held_out, ready


def letters(seed):
    """A made-up language: words over its own few letters."""
    picked = random.Random(seed)
    own = picked.sample("abcdefghijklmnopqrstuvwxyzäöüßéèñçåøæ", 6)
    return " ".join("".join(picked.choice(own) for _ in range(picked.randint(3, 8))) for _ in range(120))


def test_seventy_languages(spark):
    rows = [(n, f"l{n:02d}", letters(n)) for n in range(70)]
    ready(spark)
    documents = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    languages, model = language_evidence.trained(documents)
    assert languages == [f"l{n:02d}" for n in range(70)] and model.shape[0] == 70
    pages = spark.createDataFrame(
        [(n, f"https://h{n}.org/", f"<p>{t[: len(t) // 2]}</p>") for n, _, t in rows], "page_id long, url string, html string")
    found = language_evidence.identify(pages, languages, model)
    assert all(r.text_lang == f"l{r.page_id:02d}" for r in found.collect())


def test_a_hot_labelled_id_is_one_row(spark):
    ready(spark)
    ids = [i for i in range(40) if not spark.range(1).select(held_out(F.lit(i), 3, 1)).first()[0]]
    hot = ids[0]
    rows = [(i, f"text of {i} in its own words") for i in ids] + [(hot, f"copy {n}") for n in range(500)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(
        [(i, i % 2) for i in ids] + [(hot, 1), (hot, 7), (ids[1], None), (None, 1)], "doc_id long, quality int")
    sample = training.labelled_sample(documents, labels, "quality", 3, 1).collect()
    assert sorted(r.doc_id for r in sample) == ids and {r.label for r in sample} == {0, 1}
    assert len(training.labelled_sample(documents, labels, "quality", 3, 1, rows=1).collect()) == 1
    assert training.labelled_sample(documents.limit(0), labels, "quality", 3, 1).isEmpty()


def test_models_of_odd_labels(spark):
    ready(spark)
    documents = spark.createDataFrame([(1, "a"), (2, None), (None, "b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 5), (2, -1)], "doc_id long, quality int").withColumn("toxic", F.col("quality"))
    assert quality_model.scored(documents, quality_model.trained(documents, labels)).count() == 3
    assert {r.score for r in toxicity.scored(documents, toxicity.trained(documents, labels)).collect()} == {0.5}


def brute_repeats(words):
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i : i + 3]), []).append(i)
    return len({i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)})


@pytest.mark.parametrize("spread", [1, 3])
def test_repeats_are_exact_when_windows_share_hashes(spark, monkeypatch, spread):
    monkeypatch.setattr(quality_rules, "window_hash", lambda window: F.xxhash64(*window) % spread)
    ready(spark)
    picked = random.Random(spread)
    texts = [" ".join(picked.choice("ab c d e".split()) for _ in range(n)) for n in (0, 1, 2, 3, 4, 10, 60, 200)]
    texts += ["a b c x a b c y a b c", "a b c d e f a b c d e f"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.clean(df).collect()}
    assert got == {i: brute_repeats(t.split()) for i, t in enumerate(texts)}


def test_one_row_of_a_group_stays_whatever_its_ids(spark):
    ready(spark)
    picked = random.Random(1)
    words = [f"w{picked.randrange(10**6)}" for _ in range(200)]
    near = [" ".join([*words[:i], f"x{i}", *words[i + 1 :]]) for i in (5, 195)]
    other = " ".join(f"z{picked.randrange(10**6)}" for _ in range(200))
    schema = "doc_id long, text string"
    for ids in ([None, None], [4, 4], [None, 4], [4, None]):
        df = spark.createDataFrame([*zip(ids, near), (4, other), (None, other), (None, other), (None, None), (4, "")], schema)
        rows = [tuple(r) for r in near_duplicates.without_near_duplicates(df, 80).collect()]
        kept = [r for r in rows if r[1] in near]
        assert len(kept) == 1 and kept[0][0] == (4 if 4 in ids else None)
        assert [r for r in rows if r[1] == other] == [(4, other)]
        assert sorted(r[0] or 0 for r in rows if not r[1]) == [0, 4]
