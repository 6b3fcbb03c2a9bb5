r"""MinHash near-duplicate groups with tensored banding.

A text's set is its distinct 5-word shingles. Two small collections of
half-keys are made from its MinHashes, `HALVES` in each and `ROWS` MinHashes in
a half-key; every pair of a half-key of the first with one of the second is a
table key. So `HALVES`^2 tables cost 2 * `HALVES` * `ROWS` MinHashes, a table of
2 * `ROWS` each. At the threshold of 0.85 a pair shares a key with probability
0.99993 ((1 - (1 - 0.85^2)^8)^2), at the 0.80 of the pipeline's stage 0.9994.

Texts of one set are one node. Candidates are then confirmed on full sets:

1. Each member of a bucket is compared with the bucket's head, the node whose
   shingles are the most common ones: in a group of copies that is the text
   they were made from. That is as many pairs as members, however large the
   bucket.
2. Links give components. Nodes of buckets that hold several components are
   joined across components by a prefix filter: of two sets with the wanted
   overlap the rarest shingles, as many as may be missing, have one in common.
   Each pair's own prefix lengths are checked within the join, and what is
   left is confirmed on full sets. That
   finds every link between those nodes, so none is lost by comparing with one
   member only, and members of one component are never paired.

Nodes, buckets and links are tables in the shared folder; nothing is gathered
by the driver or capped.

Defined cases: null texts and texts without words have empty sets and are
linked with nothing; rows that repeat a document are in its component; a
component whose ids are all null has a null id.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from auditloom.llm.common import query, table
from auditloom.llm.components import components, stored
from auditloom.llm.shingles import mixed, shingle_sets
from auditloom.operators.joins import folded

#: Half-keys of a collection and MinHashes of a half-key.
HALVES, ROWS = 8, 2
#: Least similarity, as a percentage.
PERCENT = 85


def _key(df, id_col, text_col):
    """(id, text) and a 128-bit key of both."""
    return df.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.lit(1), id_col, text_col).alias("k1"),
        F.xxhash64(F.lit(2), text_col, id_col).alias("k2"),
    )


def _lists(values, sizes):
    """An Arrow list array of int64 from flat unsigned values."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _half_keys(sets, halves, rows):
    """`halves` numbers for each of the non-empty `sets`, in two collections."""
    flat, starts = np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets])[:-1]
    seeds = mixed(np.arange(1, 4 * halves * rows + 1, dtype=np.uint64))
    collections = []
    for side in range(2):
        made = np.empty((len(sets), halves), np.uint64)
        for half in range(halves):
            key = np.full(len(sets), np.uint64(half + 1))
            for row in range(rows):
                at = 2 * ((side * halves + half) * rows + row)
                hashed = flat ^ seeds[at]
                hashed *= seeds[at + 1] | np.uint64(1)
                key = mixed(key * np.uint64(3) + np.minimum.reduceat(hashed, starts))
            made[:, half] = key
        collections.append(made.ravel())
    return collections


def _digests(sets):
    """Two 64-bit numbers for each of `sets` that tell sets apart."""
    salts = (np.uint64(0x51ED270B9F652295), np.uint64(0xD6E8FEB86659FD93))
    made = np.array([[mixed(s ^ salt).sum(dtype=np.uint64) for salt in salts] for s in sets], np.uint64)
    return made.reshape(-1, 2).view(np.int64)


def signatures(df, halves=HALVES, rows=ROWS):
    """(id, k1, k2, n, d1, d2, first, second) of each row of `df` (id, text, k1, k2)."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1))
            sizes = np.array([len(s) for s in sets], np.int64)
            full = [s for s in sets if len(s)]
            digests = _digests(sets)
            none = np.empty(0, np.uint64)
            both = _half_keys(full, halves, rows) if full else [none, none]
            lists = [_lists(side, np.where(sizes > 0, halves, 0)) for side in both]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array(sizes),
                    pa.array(digests[:, 0]),
                    pa.array(digests[:, 1]),
                    *lists,
                ],
                names=["id", "k1", "k2", "n", "d1", "d2", "first", "second"],
            )

    key = df.schema["id"].dataType.simpleString()
    return df.mapInArrow(
        run, f"id {key}, k1 long, k2 long, n long, d1 long, d2 long, first array<long>, second array<long>"
    )


def _sets_of(df):
    """(node, n, shingles) of `df` (node, text)."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets(batch.column(1))
            sizes = [len(s) for s in sets]
            flat = np.concatenate([*sets, np.empty(0, np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), _lists(flat, sizes)], names=["node", "n", "shingles"]
            )

    return df.select("node", "text").mapInArrow(run, "node long, n long, shingles array<long>")


def confirmed(pairs, sets, percent=PERCENT):
    """The `pairs` (x, y) of nodes whose full sets are similar enough."""

    def run(batches):
        for batch in batches:
            sides = []
            for column in (batch.column(2), batch.column(3)):
                flat, offsets = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
                sides.append((flat, offsets))
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = (flat[offsets[i] : offsets[i + 1]] for flat, offsets in sides)
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    one = sets.select(F.col("node").alias("x"), F.col("n").alias("nx"), F.col("shingles").alias("sx"))
    two = sets.select(F.col("node").alias("y"), F.col("n").alias("ny"), F.col("shingles").alias("sy"))
    fits = 100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny")
    joined = pairs.join(one, "x").join(two, "y").filter(fits)
    return joined.select("x", "y", "sx", "sy").mapInArrow(run, "x long, y long")


def _ranked(sets, percent):
    """(node, n, weight, prefix): the rarest shingles of each set and how common all are.

    Rarity is counted over `sets`. The prefix has as many shingles as a set of
    at least `percent` similarity may miss, and one more.
    """
    shingles = sets.select("node", F.explode("shingles").alias("h"))
    counted = shingles.join(folded(shingles, "h", F.count("*").alias("f")), "h")
    ordered = counted.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("f", "h"))).alias("order"), F.avg("f").alias("weight")
    )
    size = F.size("order")
    longest = (size - F.ceil(size * percent / 100) + 1).cast("int")
    prefix = F.transform(F.slice("order", F.lit(1), longest), lambda x: x["h"])
    return ordered.select("node", size.cast("long").alias("n"), "weight", prefix.alias("prefix"))


def _across(nodes, ranked, percent):
    """Pairs (x, y) of different components that may be similar enough.

    `nodes` is (node, label). No pair of these that is similar enough is missing.
    """
    prefixes = ranked.join(nodes, "node").select("node", "label", "n", F.posexplode("prefix").alias("i", "h"))
    prefixes = stored(prefixes, "prefixes")
    a, b = prefixes.alias("a"), prefixes.alias("b")
    overlap = F.ceil((F.col("a.n") + F.col("b.n")) * percent / (100 + percent))
    near = (
        (F.col("a.h") == F.col("b.h"))
        & (F.col("a.node") < F.col("b.node"))
        & (F.col("a.label") != F.col("b.label"))
        & (F.col("a.i") <= F.col("a.n") - overlap)
        & (F.col("b.i") <= F.col("b.n") - overlap)
    )
    return a.join(b, near).select(F.col("a.node").alias("x"), F.col("b.node").alias("y")).distinct()


def near_duplicates(documents, id_col="doc_id", text_col="text", percent=PERCENT, halves=HALVES, rows=ROWS):
    """One row for each row of `documents`: `id_col`, `n_shingles`, `component_id`, `kept`, `k1`, `k2`.

    `component_id` is the smallest id of the component; `k1` and `k2` are a key
    of the row's id and text.
    """
    keyed = _key(documents, id_col, text_col)
    signed = stored(signatures(keyed, halves, rows), "signatures")
    full = signed.filter("n > 0")
    nodes = folded(
        full,
        ["d1", "d2"],
        F.min("id").alias("low"),
        *[F.first(c).alias(c) for c in ("n", "k1", "k2", "first", "second")],
    )
    # The number is fixed once the table is written.
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    combined = F.flatten(
        F.transform("first", lambda a, i: F.transform("second", lambda b, j: F.xxhash64(i, j, a, b)))
    )
    entries = nodes.select("node", F.explode(combined).alias("key"))
    shared = folded(entries, "key", F.count("*").alias("members")).filter("members > 1").select("key")
    buckets = stored(entries.join(shared, "key"), "buckets")
    active = buckets.select("node").distinct()
    keys = nodes.join(active, "node", "left_semi").select("node", "k1", "k2")
    texts = keyed.select("text", "k1", "k2").join(keys, ["k1", "k2"]).dropDuplicates(["node"])
    sets = stored(_sets_of(texts), "sets")
    ranked = stored(_ranked(sets, percent), "ranked")

    weighed = buckets.join(ranked.select("node", "weight"), "node")
    heads = folded(weighed, "key", F.max(F.struct("weight", "node")).alias("head"))
    pairs = buckets.join(heads.select("key", F.col("head.node").alias("head")), "key")
    pairs = pairs.filter("head <> node").select(F.col("head").alias("x"), F.col("node").alias("y")).distinct()
    links = stored(confirmed(pairs, sets, percent), "links")
    labels = components(links)
    labelled = buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_keys = folded(labelled, "key", F.min("label").alias("a"), F.max("label").alias("b")).filter("a <> b")
    unresolved = stored(labelled.join(open_keys.select("key"), "key", "left_semi").select("node", "label").distinct(), "open")
    more = stored(confirmed(_across(unresolved, ranked, percent), sets, percent), "links")
    chain = labels.select(F.col("node").alias("x"), F.col("label").alias("y")).filter("x <> y")
    labels = components(chain.union(more))

    members = nodes.select("node", "d1", "d2", "low").join(labels, "node", "left")
    members = members.withColumn("label", F.coalesce("label", "node"))
    lowest = folded(members, "label", F.min("low").alias("component_id"))
    members = members.join(lowest, "label").select("d1", "d2", "component_id", "label", F.lit(True).alias("full"))
    rows_ = signed.join(members, ["d1", "d2"], "left")
    component = F.when(F.col("full"), F.col("component_id")).otherwise(F.col("id"))
    return rows_.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.col("id").isNull() & component.isNull()).alias("kept"),
        "k1",
        "k2",
        F.col("label").alias("group"),
    )


def without_near_duplicates(documents, percent=PERCENT):
    """The rows of `documents` of which one stays in each group, all columns kept.

    A group keeps its row of the smallest id, nulls last, whatever ids its rows
    share; rows without words form no groups, and of equal ones one stays.
    """
    found = near_duplicates(documents, percent=percent).withColumnRenamed("doc_id", "id")
    rank = F.struct(F.col("id").isNull(), "id", "k1", "k2")
    first = found.filter("group is not null").groupBy("group").agg(F.min(rank).alias("first"))
    alone = found.filter("group is null").select("k1", "k2")
    kept = first.select("first.k1", "first.k2").union(alone).distinct()
    keyed = documents.withColumns(
        {
            "_near_k1": F.xxhash64(F.lit(1), "doc_id", "text"),
            "_near_k2": F.xxhash64(F.lit(2), "text", "doc_id"),
        }
    )
    kept = kept.select(F.col("k1").alias("_near_k1"), F.col("k2").alias("_near_k2"))
    keys = ["_near_k1", "_near_k2"]
    return keyed.join(kept, keys, "left_semi").dropDuplicates(keys).select(*documents.columns)


ORACLE = r"""
    with recursive words as (select doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x20\x09-\x0D]+') as w from documents),
    sets as (select distinct doc_id, array_to_string(w[i : i + 4], ' ') as t
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0)),
    sizes as (select doc_id, count(*) as n from sets group by doc_id),
    pairs as (select a.doc_id as x, b.doc_id as y, count(*) as common
      from sets a join sets b on a.t = b.t and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
    linked as (select x, y from pairs join sizes a on a.doc_id = x join sizes b on b.doc_id = y
      where 100 * common >= 85 * (a.n + b.n - common)),
    ways as (select x, y from linked union all select y, x from linked),
    reached as (select doc_id as d, doc_id as r from documents
      union select d, y from reached join ways on r = x)
    select d.doc_id, coalesce(n, 0)::bigint as n_shingles, c.component_id, d.doc_id = c.component_id as kept
    from documents d join (select d, min(r) as component_id from reached group by d) c on c.d = d.doc_id
    left join sizes using (doc_id)"""


@query("op10_near_duplicates", ORACLE)
def op10_near_duplicates(spark, sf_dir):
    """Components of near-duplicate documents."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("k1", "k2", "group")
