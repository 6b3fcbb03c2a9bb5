r"""Benchmark decontamination by winnowing.

A window is 10 consecutive words of a benchmark item (all of a shorter item).
Of a text's hashed 5-word grams the smallest of each 6 in a row is kept as a
fingerprint: any 10 words that two texts share have a fingerprint in common,
since the smallest gram of those 10 words is the same in both. Fingerprints of
documents are joined with those of items; a document with common ones is read
again, its hits are extended to every 10-word window around them, and windows
are compared word by word. For items of t < 10 words the same is done with
(t + 1) // 2 words a gram and as many grams a window as make t words.

All is built-in functions. Document rows travel as (key, fingerprint) only; the
text of a document is read again for the few that have hits. Item fingerprints
and windows are written to the shared folder first, so Spark knows their size
and joins them by broadcast only where its threshold allows.

Defined cases: null texts and texts without words have no windows and no hits;
repeated items count once; an item without id marks words but is not listed;
rows that repeat a document each get their own result.
"""

from pyspark.sql import functions as F

from auditloom.llm.common import let, lower_ascii, query, table
from auditloom.llm.components import stored
from auditloom.operators.joins import folded

NOT_A_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window.
WINDOW = 10


def words(text):
    """Lower-cased words of a text; none of a null one."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_A_WORD)
    return F.array_remove(parts, "")


def gram_words(window):
    """Words of a gram and grams of a winnowing window that make `window` words."""
    gram = (window + 1) // 2
    return gram, window - gram + 1


def _grams(w, window):
    """Hash of each gram of the words `w`, which are at least `window`."""
    gram, _ = gram_words(window)
    starts = F.sequence(F.lit(1), F.size(w) - gram + 1)
    return F.transform(starts, lambda i: F.xxhash64(F.lit(window), F.slice(w, i, gram)))


def fingerprints(w, window):
    """The winnowed grams of the words `w`, each once; none of fewer than `window` words."""
    _, together = gram_words(window)

    def smallest(grams):
        starts = F.sequence(F.lit(1), F.size(grams) - together + 1)
        return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(grams, i, together))))

    made = let(_grams(w, window), smallest)
    return F.when(F.size(w) >= window, made).otherwise(F.array().cast("array<bigint>"))


def _window_at(w, start, window):
    return F.array_join(F.slice(w, start, window), " ")


def _windows_around(w, hits, window):
    """(start, window text) of each window of `w` that holds a gram among `hits`."""
    gram, together = gram_words(window)

    def near(grams):
        places = F.filter(F.sequence(F.lit(1), F.size(grams)), lambda i: F.array_contains(hits, F.get(grams, i - 1)))
        starts = F.flatten(F.transform(places, lambda p: F.sequence(p - (together - 1), p)))
        starts = F.array_distinct(F.filter(starts, lambda s: (s >= 1) & (s <= F.size(w) - window + 1)))
        return F.transform(
            starts, lambda s: F.struct(s.alias("start"), F.lit(window).alias("size"), _window_at(w, s, window).alias("window"))
        )

    none = F.array().cast("array<struct<start:int,size:int,window:string>>")
    return F.when(F.size(w) >= window, let(_grams(w, window), near)).otherwise(none)


def item_windows(benchmark, id_col="item_id", text_col="text"):
    """(item_id, words `w`, words of its windows `size`) of each item that has words."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("w"))
    items = items.select("item_id", F.explode(F.array("w")).alias("w")).filter(F.size("w") > 0)
    return items.withColumn("size", F.least(F.size("w"), F.lit(WINDOW)))


def contamination(documents, benchmark, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"):
    """One row for each row of `documents` and its hits.

    Columns: `id_col`, `n_words`, `hit_starts` (array of (start, size) of each
    window of the document, from word 1, that an item holds), `items` (ids of
    those items as text, sorted, each once), and `k1` and `k2`, a key of the
    row's id and text.
    """
    spark = documents.sparkSession
    items = item_windows(benchmark, item_col, item_text_col)
    sizes = [r.size for r in items.select("size").distinct().collect()]  # at most 10 values
    narrow = documents.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.lit(1), id_col, text_col).alias("k1"),
        F.xxhash64(F.lit(2), text_col, id_col).alias("k2"),
    )
    keys = ["k1", "k2"]
    counted = narrow.select("id", *keys, F.size(words(F.col("text"))).cast("long").alias("n_words"))
    hit_type = "array<struct<start:int,size:int>>"
    if not sizes:
        none = [F.array().cast(hit_type).alias("hit_starts"), F.array().cast("array<string>").alias("items")]
        return counted.select(F.col("id").alias(id_col), "n_words", *none, *keys)

    def by_size(of):
        """`of(w, size)` for the rows' own size among those that occur."""
        made = F.lit(None)
        for size in sizes:
            made = F.when(F.col("size") == size, of(F.col("w"), size)).otherwise(made)
        return made

    def all_windows(w, size):
        return F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda s: _window_at(w, s, size))

    item_prints = stored(items.select(F.explode(by_size(fingerprints)).alias("h")).distinct(), "item-prints")
    windows = stored(
        items.select("item_id", "size", F.explode(by_size(all_windows)).alias("window")).distinct(), "item-windows"
    )

    prints = let(
        words(F.col("text")), lambda w: F.concat(*[fingerprints(w, size) for size in sizes])
    )
    hits = narrow.select(*keys, F.explode(prints).alias("h")).join(item_prints, "h")
    hits = stored(folded(hits, keys, F.collect_set("h").alias("hits")), "hits")

    read = narrow.join(hits.select(*keys), keys, "left_semi").join(hits, keys)
    near = let(
        words(F.col("text")), lambda w: F.concat(*[_windows_around(w, F.col("hits"), size) for size in sizes])
    )
    tried = read.dropDuplicates(keys).select(*keys, F.inline(near))
    held = tried.join(windows, ["size", "window"])
    found = folded(
        held,
        keys,
        F.sort_array(F.collect_set(F.struct("start", "size"))).alias("hit_starts"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
    )
    return counted.join(found, keys, "left").select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("hit_starts", F.array().cast(hit_type)).alias("hit_starts"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        *keys,
    )


def words_hit(starts):
    """Words in the union of windows given as sorted (start, size)."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))

    def add(a, x):
        end = F.greatest(a["end"], x["start"] + x["size"])
        return F.struct(end.alias("end"), (a["n"] + end - F.greatest(a["end"], x["start"])).cast("long").alias("n"))

    return F.aggregate(starts, zero, add, lambda a: a["n"])


def without_contaminated(documents, benchmark):
    """The rows of `documents` in which no benchmark window occurs, all columns kept."""
    found = contamination(documents, benchmark).filter(F.size("hit_starts") > 0)
    found = found.select(F.col("k1").alias("_hit_k1"), F.col("k2").alias("_hit_k2")).distinct()
    keyed = documents.withColumns(
        {
            "_hit_k1": F.xxhash64(F.lit(1), "doc_id", "text"),
            "_hit_k2": F.xxhash64(F.lit(2), "text", "doc_id"),
        }
    )
    return keyed.join(found, ["_hit_k1", "_hit_k2"], "left_anti").select(*documents.columns)


ORACLE = r"""
    with lowered as (
      select 'd' as kind, row_number() over () as r, doc_id, null as item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
      union all select 'b', row_number() over (), null, item_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') from benchmark),
    items as (select item_id, w, least(len(w), 10) as m from lowered where kind = 'b' and len(w) > 0),
    windows as (select distinct item_id, m, array_to_string(w[i : i + m - 1], ' ') as t
      from (select item_id, m, w, unnest(range(1, len(w) - m + 2)) as i from items)),
    places as (select r, m, i, array_to_string(w[i : i + m - 1], ' ') as t
      from (select r, m, w, unnest(range(1, len(w) - m + 2)) as i
            from lowered, (select distinct m from items) where kind = 'd')),
    held as (select r, p.m, i, item_id from places p join windows v on p.m = v.m and p.t = v.t),
    hit as (select r, count(distinct j) as n from (select r, unnest(range(i, i + m)) as j from held) group by r),
    named as (select r, count(*) as n, string_agg(id, ',' order by id) as ids
      from (select distinct r, cast(item_id as varchar) as id from held) group by r)
    select doc_id, len(w)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit,
      coalesce(named.n, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
      coalesce(hit.n, 0) > 0 as contaminated
    from lowered left join hit using (r) left join named using (r) where kind = 'd'"""


@query("op8_decontaminate", ORACLE)
def op8_decontaminate(spark, sf_dir):
    """Words of all documents that lie in windows of the benchmark."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = words_hit(F.col("hit_starts"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_starts") > 0).alias("contaminated"),
    )
