"""Operators across documents against brute force, with odd texts, ties and repeats."""

import random
import re

import pytest

import corpus_pipeline
from auditloom.llm import decontaminate, language_evidence, line_chunks, near_duplicates, quality_model, toxicity

RNG = random.Random(5)
VOCABULARY = [f"w{i}" for i in range(400)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def edited(text, edits, seed):
    words, rng = text.split(" "), random.Random(seed)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return " ".join(words)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return {d: min(rows[j][0] for j in range(len(rows)) if group[j] == group[i]) for i, (d, _) in enumerate(rows)}


@pytest.fixture(scope="module")
def documents():
    rows = []
    for base in range(12):
        text = prose(RNG.choice([8, 60, 150, 400]), base)
        rows += [edited(text, RNG.choice([0, 0, 1, 2, 3, 6, 10]), base * 100 + k) for k in range(9)]
    rows += ["", None, " \n", "a b", "A B", "a  b ", "one two three four five", "Ünder a É", prose(6000, 99)]
    rows += [prose(6000, 99).upper()]
    RNG.shuffle(rows)
    return list(enumerate(rows))


def test_near_duplicates(spark, documents):
    df = spark.createDataFrame([(d, t, "x") for d, t in documents], "doc_id long, text string, component_id string")
    got = {r.doc_id: r for r in near_duplicates.near_duplicates(df).collect()}
    wanted = brute_components(documents)
    assert {d: r.component_id for d, r in got.items()} == wanted
    assert all(r.kept == (d == wanted[d]) for d, r in got.items())
    assert all(r.n_shingles == len(shingles(t)) for (d, t), r in ((x, got[x[0]]) for x in documents))
    stay = near_duplicates.without_near_duplicates(df)
    assert stay.columns == df.columns and {r.doc_id for r in stay.collect()} == set(wanted.values())


def test_near_duplicates_of_repeats_and_nothing(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(1, "same words here"), (1, "same words here"), (None, "SAME words here"), (3, None)], schema)
    rows = near_duplicates.near_duplicates(df).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in rows) == [(0, 1), (1, 1), (1, 1), (3, 3)]
    assert sorted(r.doc_id for r in near_duplicates.without_near_duplicates(df).collect()) == [1, 3]
    empty = spark.createDataFrame([], schema)
    assert near_duplicates.near_duplicates(empty).collect() == []


def test_links_across_components_are_found(spark):
    """Nodes that the bucket's head does not reach are joined by the prefix filter."""
    base = prose(120, 7)
    rows = [(i, edited(base, 1 + i % 4, 500 + i)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(df).collect()}
    assert got == brute_components(rows)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, item_text in items:
        own = words_of(item_text)
        size = min(len(own), 10)
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if size and tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


def test_stage_links_from_four_fifths_on(spark):
    words = [f"n{i}" for i in range(204)]
    # 200 shingles; n scattered edits change 5 n of them: 180 / 220 and 175 / 225 are equal.
    texts = [" ".join(w if k % 40 != 20 or k > 40 * n else f"x{k}" for k, w in enumerate(words)) for n in (0, 4, 5)]
    df = spark.createDataFrame([(i, texts[k]) for i, k in ((1, 0), (2, 1))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_dedup(spark, df, None).collect()] == [1]
    assert near_duplicates.near_duplicates(df).filter("kept").count() == 2
    df = spark.createDataFrame([(i, texts[k]) for i, k in ((1, 0), (2, 2))], "doc_id long, text string")
    assert corpus_pipeline.near_dedup(spark, df, None).count() == 2


@pytest.mark.parametrize("short", [False, True])
def test_contamination(spark, short):
    items = [(i, prose(30, 1000 + i)) for i in range(6)] + [(6, prose(10, 1006)), (7, None), (8, "--"), (6, prose(10, 1006))]
    if short:
        items += [(20 + n, " ".join(f"s{n}x{k}" for k in range(n))) for n in range(1, 10)] + [(40, "w1 w2")]
    texts = ["", None, "--", prose(50, 1), prose(9, 1000)]
    for i in range(6):
        own = prose(30, 1000 + i).split(" ")
        for n in (9, 10, 11, 17, 30):
            start = RNG.randrange(len(own) - n + 1)
            texts.append(f"{prose(20, i)} {'-'.join(own[start : start + n]).upper()}, {prose(15, 50 + i)}")
    texts.append(prose(10, 1006))
    texts.append(f"{prose(30, 1000)} x {prose(30, 1001)} {prose(30, 1000)}")
    texts += [f"a {' '.join(f's{n}x{k}' for k in range(n))} b" for n in range(1, 10)]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, items string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(df, benchmark)
    got = got.select("doc_id", "n_words", decontaminate.words_hit("hit_starts").alias("n_hit"), "items").collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_hit, r["items"]) == brute_contamination(texts[r.doc_id], items)
    clean = decontaminate.without_contaminated(df, benchmark)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in got if not r.n_hit}


def test_rows_without_id_are_judged_by_their_text(spark):
    shared = prose(12, 1)
    rows = [(None, f"x {shared}"), (None, "clean"), (1, f"y {shared}"), (1, "clean too")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clean = decontaminate.without_contaminated(df, spark.createDataFrame([(None, shared)], "item_id long, text string"))
    assert sorted(r.text for r in clean.collect()) == ["clean", "clean too"]


def test_contamination_without_items(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = decontaminate.contamination(df, spark.createDataFrame([(1, None)], "item_id long, text string")).first()
    assert (row.n_words, row.hit_starts, row["items"]) == (2, [], [])


def test_line_chunks(spark):
    passage = "\n".join(prose(14, 300 + k) for k in range(9))
    long_line = prose(60, 400)
    texts = [
        f"{prose(12, 1)}\n{passage}\n{prose(12, 2)}",
        f"{prose(12, 3)}\n{prose(9, 4)}\n{passage}\n{prose(12, 5)}",
        f"{prose(12, 6)}\n{long_line}\n{prose(12, 7)}",
        f"{long_line}\n{prose(12, 8)}",
        prose(40, 9),
        f"{prose(12, 1)}\n{passage}\n{prose(12, 2)}",
        None,
        "",
        "\n\n",
        "short\nlines",
        "short\nlines",
    ]
    rows = [(i, t, 7, len(t or "")) for i, t in enumerate(texts)] + [(4, prose(40, 9), 7, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, gone int, n_chars long")
    out = line_chunks.deduplicated(df)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == df.columns and out.count() == len(rows) - 1 and 5 not in got  # a repeated passage only
    assert got[0].text == texts[0] and got[2].text == texts[2] and got[9].text == got[10].text == "short\nlines"
    assert got[3].text == prose(12, 8) and got[3].n_chars == len(got[3].text)
    left = got[1].text.split("\n")
    assert prose(12, 3) in left and prose(12, 5) in left and len(left) <= 8
    assert got[4].text == prose(40, 9) and got[6].text is None
    assert "".join(x for t in texts[:3] for x in t.split("\n")) and line_chunks.deduplicated(df.limit(0)).count() == 0


def without_repeated_runs(texts):
    """`texts` without the runs of lines that stand earlier too, by comparing all places with each other."""
    worded = [(d, i, line) for d, t in enumerate(texts) for i, line in enumerate(t.split("\n")) if line.split()]
    gone = set()
    for b, two in enumerate(worded):
        for a, one in enumerate(worded[:b]):
            n, words, longest = 0, 0, 0
            while b + n < len(worded) and worded[a + n][0] == one[0] and worded[b + n][0] == two[0]:
                if worded[a + n][2] != worded[b + n][2]:
                    break
                size = len(worded[b + n][2].split())
                n, words, longest = n + 1, words + size, max(longest, size)
            if longest >= 50 or n >= 2 and words >= 20:
                gone |= {place[:2] for place in worded[b : b + n]}
    for (d, i, _), (e, j, _) in zip(worded, worded[1:]):
        if d == e and {(d, i), (e, j)} <= gone:
            gone |= {(d, k) for k in range(i, j)}
    return [
        "\n".join(line for i, line in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in enumerate(texts)
    ]


def runs_left(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_chunks.deduplicated(df, drop_empty=False).collect()}
    return [out[d] for d in range(len(texts))]


def test_whole_repeated_runs_go_wherever_they_stand(spark):
    rng, texts = random.Random(8), []

    def line(n):
        return " ".join(f"r{rng.randrange(10**9)}" for _ in range(n))

    def around():
        return [line(rng.randrange(0, 46)) for _ in range(rng.randrange(7))]

    for size in [*range(2, 13)] * 2:
        passage = [line(rng.choice([0, 4, 9, 25, 45, 60])) for _ in range(size)]
        for _ in range(3):
            begin = rng.choice([0, 0, rng.randrange(size)])
            texts.append("\n".join([*around(), *passage[begin:], *around(), *passage[: rng.randrange(size + 1)], *around()]))
    wanted = without_repeated_runs(texts)
    assert sum(len(t) for t in wanted) < 0.8 * sum(len(t) for t in texts)
    assert runs_left(spark, texts) == wanted


@pytest.mark.parametrize("words", [1, 4, 6, 8])
def test_passages_of_short_lines_go_whole(spark, words):
    verse = "\n".join(prose(words, 10_000 * words + k) + f" v{k}" for k in range(100))
    texts = [f"{prose(12, 7 * n)}\n{verse}\n{prose(15, 7 * n + 1)}" for n in range(3)]
    assert runs_left(spark, texts) == [texts[0], *(f"{prose(12, 7 * n)}\n{prose(15, 7 * n + 1)}" for n in (1, 2))]


def test_a_line_said_over_and_over_is_kept_as_one_passage(spark):
    assert runs_left(spark, ["\n".join([prose(12, 1)] * 9)]) == ["\n".join([prose(12, 1)] * 2)]


def test_chunks_cover_all_lines():
    text = "\n".join(prose(RNG.choice([0, 1, 8, 55]), k) for k in range(80))
    made = line_chunks.chunks(text)
    assert [c[0] for c in made] == [0, *[c[0] + c[1] for c in made[:-1]]] and made[-1][0] + made[-1][1] == 80


def test_quality_model(spark):
    clean = [(i, " ".join(f"Word{k} is here." for k in range(i % 7 + 3)) + "\n" + prose(50, i) + ".") for i in range(60)]
    noisy = [(100 + i, " ".join(w + "###" for w in prose(40, i).split(" "))) for i in range(60)]
    odd = [(900, None), (901, ""), (902, "\n"), (903, "w " * 20000), (900, None)]
    documents = spark.createDataFrame([(d, t, 1) for d, t in clean + noisy + odd], "doc_id long, text string, label int")
    labels = [(d, 1) for d, _ in clean] + [(d, 0) for d, _ in noisy] + [(0, None), (None, 1), (1, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality_model.trained(documents, labels)
    scores = {r.doc_id: r.score for r in quality_model.scored(documents, model).collect()}
    assert all(scores[d] > 0.5 for d, _ in clean) and all(scores[d] < 0.5 for d, _ in noisy)
    assert all(0 <= s <= 1 for s in scores.values())
    kept = quality_model.accepted(documents, model)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, s in scores.items() if s >= 0.5}
    blank = quality_model.trained(documents, labels.filter("false"))
    assert {r.score for r in quality_model.scored(documents, blank).collect()} == {0.5}


def test_pairs_are_learned():
    rows = [[a, b] for a in range(10) for b in range(10)] * 5
    labels = [int((a < 5) != (b < 5)) for a, b in rows]
    import numpy as np

    model = quality_model.fit(np.array(rows, float), labels, pairs=1)
    assert ((model.score(np.array(rows, float)) > 0.5) == np.array(labels)).mean() > 0.95


def test_toxicity(spark):
    def text(i, bad):
        words = prose(40, 2000 + i).replace("w", "v").split(" ")
        words = ["".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words]
        for k in range(2 * bad):
            words.insert(RNG.randrange(len(words)), RNG.choice(["zonk", f"blurf{chr(97 + (i + k) % 9)}"]))
        return " ".join(words) + "."

    rows = [(i, text(i, i % 3 == 0)) for i in range(150)] + [(900, None), (901, ""), (902, "zonk " * 5000)]
    documents = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(150)], "doc_id long, toxic int")
    grammar = toxicity.trained(documents, labels)
    assert "zonk" in grammar.words and any("blurfa".startswith(s) for s in grammar.stems)
    scores = {r.doc_id: r.score for r in toxicity.scored(documents, grammar).collect()}
    assert all((scores[i] >= 0.5) == (i % 3 == 0) for i in range(150))
    assert scores[900] < 0.5 and scores[901] < 0.5 and scores[902] >= 0.5
    blank = toxicity.trained(documents, labels.filter("false"))
    assert {round(r.score, 6) for r in toxicity.scored(documents, blank).collect()} == {0.5}


def test_path_labels():
    grammar = toxicity.Grammar(words=frozenset(["moron"]))
    insult = toxicity.INSULT
    assert grammar.labels("you are a moron".split()) == [(insult, True, False, False)]
    assert grammar.labels("you are not a moron".split()) == [(insult, True, True, False)]
    assert grammar.labels("they said that one is a moron".split()) == [(insult, False, False, True)]
    assert grammar.labels("a moron".split()) == [(insult, False, False, False)]
    assert grammar.labels("i will kill you".split()) == [(toxicity.THREAT, False, False, False)]


def test_language(spark):
    en = "the quick brown fox jumps over the lazy dog and then they all went home together "
    de = "der schnelle braune fuchs springt und dann sind alle zusammen nach hause gegangen "
    documents = spark.createDataFrame(
        [(i, (en if i % 2 else de) * 5, "en" if i % 2 else "de") for i in range(40)] + [(99, None, "en"), (98, "x", None)],
        "doc_id long, text string, lang string",
    )
    pages = [
        (1, "https://a.example.de/x", f"<html lang='de'><p>{de}</p></html>"),
        (2, "https://a.example.de/y", f"<html><script>{en * 3}</script><p>{de}</p></html>"),
        (3, "https://b.example.com/", f"<html lang=en-GB><p>{en}</p><!-- {de * 4} --></html>"),
        (4, "https://b.example.com/", None),
        (5, None, ""),
        (6, "no address", "<html lang='xx'></html>"),
        (7, "https://a.example.de/z", "<html></html>"),
        (7, "https://a.example.de/z", "<html></html>"),
    ] + [(100 + i, f"https://a.example.de/{i}", f"<p>{de}</p>") for i in range(20)]
    frame = spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, lang string")
    languages, model = language_evidence.trained(documents)
    rows = language_evidence.identify(frame, languages, model).collect()
    got = {r.page_id: r for r in rows}
    assert languages == ["de", "en"] and len(rows) == len(pages)
    assert [got[i].lang for i in (1, 2, 3)] == ["de", "de", "en"]
    assert got[7].lang == "de"  # nothing but its host to go by
    assert [got[i].declared for i in (1, 2, 3, 6)] == ["de", "none", "en", "other"]
    assert got[1].host == "a.example.de" and got[5].host == "" and all(0 <= r.confidence <= 1 for r in rows)
    assert language_evidence.identify(frame, [], model[:0]).filter("lang is not null").count() == 0
