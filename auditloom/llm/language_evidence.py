"""Language of pages by Bayesian fusion of evidence.

Three independent kinds of evidence are multiplied: the likelihood of the
visible text under character trigrams of each language, learned from
`documents.lang`; the likelihood of the language that the markup declares, from
how often text of each language is so declared; and a prior of the page's host.

Priors are hierarchical: languages found on a host are smoothed towards those of
its domain, those towards its address suffix's, and those towards all pages'.
Each level is a grouped sum of text posteriors. A page's own posterior is taken
out of its host's sum, so that no page is evidence for itself.

Defined cases: null or empty markup has no text evidence; a null or odd address
has an empty host, a group of its own; a declared language outside the learned
ones counts as "other", none as "none"; repeated rows are pages of their own.
Other input columns are ignored. Without labelled documents there is no answer:
the language is null and the confidence 0.
"""

import html
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import query, table
from auditloom.llm.components import stored
from auditloom.operators.joins import folded

#: Documents of each language that trigrams are counted on, at most.
LANGUAGE_ROWS = 1_000
#: Trigrams fall into that many bins.
BINS = 1 << 14
#: A longer text counts as so many independent trigrams.
EFFECTIVE = 200
#: Pages that a level's parent weighs, and of each declared value.
PARENT_PAGES, DECLARED_PAGES = 10.0, 1.0

_HIDDEN = re.compile(r"<(script|style|template|noscript)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b"
_HOST = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"


def visible(markup):
    """The text of markup, without scripts, styles, comments and tags."""
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", markup or "")))


def trigrams(text):
    """Counts of a text's lower-case trigrams by bin."""
    codes = np.frombuffer(" ".join(text.lower().split()).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    if len(codes) < 3:
        return np.zeros(BINS, np.int64)
    hashed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    hashed = (hashed + codes[2:] * np.uint64(0x165667B19E3779F9)) * np.uint64(0xD6E8FEB86659FD93)
    return np.bincount((hashed >> np.uint64(50)).astype(np.int64), minlength=BINS)


def trained(documents):
    """(languages, log-probability of each bin in each language) of all languages of `documents`.

    Each language is learned from at most `LANGUAGE_ROWS` documents, chosen by a
    hash of their ids and texts. The table has `BINS` numbers a language.
    """
    named = documents.filter("lang is not null and text is not null").select("lang", "text")
    named = named.withColumn("place", F.xxhash64("text"))
    order = Window.partitionBy("lang").orderBy("place")
    # Copies of a text stand for one document. Only languages and hashes are ranked.
    ranked = named.select("lang", "place").distinct().withColumn("rank", F.row_number().over(order))
    last = ranked.filter(F.col("rank") <= LANGUAGE_ROWS).groupBy("lang").agg(F.max("place").alias("last"))
    # One row a language, written so that its size is known: texts are not shuffled to meet it.
    last = stored(last, "language-rows")
    sample = named.join(last, "lang").filter(F.col("place") <= F.col("last")).dropDuplicates(["lang", "place"])

    def run(batches):
        for batch in batches:
            counts = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in counts:
                    counts[lang] = np.zeros(BINS, np.int64)
                counts[lang] += trigrams(text)
            for lang, row in counts.items():
                at = np.flatnonzero(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(row[at])], names=["lang", "bin", "n"]
                )

    counted = sample.select("lang", "text").mapInArrow(run, "lang string, bin long, n long")
    counted = counted.groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    counted = stored(counted, "trigrams")
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    place = {lang: i for i, lang in enumerate(languages)}
    table_ = np.full((len(languages), BINS), 0.5)
    for r in counted.toLocalIterator():  # at most BINS numbers a language
        table_[place[r.lang], r.bin] += r.n
    return languages, np.log(table_ / table_.sum(axis=1, keepdims=True)).astype(np.float32)


def _texts(pages, model, id_col, html_col):
    """(id, address, declared, evidence) of each page; `evidence` is a log-likelihood by language."""

    def run(batches):
        for batch in batches:
            made = []
            for markup in batch.column(3).to_pylist():
                counts = trigrams(visible(markup))
                size = int(counts.sum())
                row = model @ counts.astype(np.float32) if size else np.zeros(len(model))
                made.append((row * (min(size, EFFECTIVE) / max(1, size))).tolist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(3)], pa.array(made, pa.list_(pa.float64()))],
                names=["id", "host", "declared", "evidence"],
            )

    kind = pages.schema["id"].dataType.simpleString()
    return pages.mapInArrow(run, f"id {kind}, host string, declared string, evidence array<double>")


def _softmax(scores):
    top = F.array_max(scores)
    raised = F.transform(scores, lambda x: F.exp(x - top))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def _sums(column, size):
    """The element-wise sum of an array column, as an aggregate."""
    return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(size)])


def _toward(counts, n, parent):
    """Shares of `counts` smoothed towards those of `parent`."""
    return F.zip_with(counts, parent, lambda c, p: (c + PARENT_PAGES * p) / (n + PARENT_PAGES))


def identify(pages, languages, model, id_col="page_id", url_col="url", html_col="html"):
    """`id_col`, `lang`, `confidence`, `text_lang`, `declared` and `host` of each page."""
    size = len(languages)
    host = F.lower(F.regexp_extract(F.coalesce(url_col, F.lit("")), _HOST, 1))
    said = F.lower(F.regexp_extract(F.coalesce(html_col, F.lit("")), _DECLARED, 1))
    said = F.when(said == "", "none").when(said.isin(languages), said).otherwise("other")
    narrow = pages.select(
        F.col(id_col).alias("id"), host.alias("host"), said.alias("declared"), F.col(html_col).alias("html")
    )
    if not size:
        return narrow.select(
            F.col("id").alias(id_col),
            F.lit(None).cast("string").alias("lang"),
            F.lit(0.0).alias("confidence"),
            F.lit(None).cast("string").alias("text_lang"),
            "declared",
            "host",
        )
    seen = _texts(narrow, model, id_col, html_col)
    seen = stored(seen.withColumn("text", _softmax(F.col("evidence"))), "pages-seen")

    # Declared values are the languages and two more: a bounded table.
    said_sums = seen.groupBy("declared").agg(_sums("text", size).alias("c")).collect()
    values = [*languages, "none", "other"]
    table_ = np.full((len(values), size), DECLARED_PAGES)
    for r in said_sums:
        table_[values.index(r.declared)] += r.c
    table_ = np.log(table_ / table_.sum(axis=0))
    declared = F.lit(None)
    for value, row in zip(values, table_):
        declared = F.when(F.col("declared") == value, F.array(*[F.lit(float(x)) for x in row])).otherwise(declared)

    hosts = folded(seen, "host", _sums("text", size).alias("c"), F.count("*").alias("n"))
    labels = F.split("host", r"\.")
    domain = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    hosts = stored(
        hosts.withColumns({"domain": domain, "suffix": F.element_at(labels, -1)}), "hosts"
    )
    domains = folded(hosts, ["suffix", "domain"], _sums("c", size).alias("dc"), F.sum("n").alias("dn"))
    suffixes = folded(domains, "suffix", _sums("dc", size).alias("sc"), F.sum("dn").alias("sn"))
    everything = suffixes.agg(_sums("sc", size).alias("c"), F.sum("sn").alias("n")).first()
    whole = np.array([x or 0.0 for x in everything.c]) + 1.0
    whole = F.array(*[F.lit(float(x)) for x in whole / whole.sum()])
    suffixes = suffixes.withColumn("sp", _toward(F.col("sc"), F.col("sn"), whole)).select("suffix", "sp")
    domains = domains.join(suffixes, "suffix").withColumn("dp", _toward(F.col("dc"), F.col("dn"), F.col("sp")))
    hosts = hosts.join(domains.select("suffix", "domain", "dp"), ["suffix", "domain"])
    hosts = stored(hosts.select("host", "c", "n", "dp"), "host-priors")

    joined = seen.join(hosts, "host")
    others = F.zip_with("c", "text", lambda c, own: F.greatest(c - own, F.lit(0.0)))
    prior = _toward(others, F.col("n") - 1, F.col("dp"))
    fused = F.zip_with(F.zip_with("evidence", prior, lambda e, p: e + F.log(p)), declared, lambda e, d: e + d)
    names = F.array(*[F.lit(x) for x in languages])

    def best(scores):
        return F.get(names, F.array_position(scores, F.array_max(scores)).cast("int") - 1)

    judged = joined.withColumn("fused", _softmax(fused))
    return judged.select(
        F.col("id").alias(id_col),
        best(F.col("fused")).alias("lang"),
        F.array_max("fused").alias("confidence"),
        best(F.col("text")).alias("text_lang"),
        "declared",
        "host",
    )


@query("op3_language")
def op3_language(spark, sf_dir):
    """Languages of all pages."""
    languages, model = trained(table(spark, sf_dir, "documents"))
    found = identify(table(spark, sf_dir, "pages"), languages, model)
    return found.select("page_id", "lang", "confidence", "text_lang", "declared", "host")
