"""Hard negatives by segment summary filtering.

A vector is cut into segments, and each segment's mean and deviation are stored
with it. The inner product of two segments of length m lies within
m * (mean * mean -+ deviation * deviation), so the sum of these over all
segments bounds a score without touching the components. Pairs that the bounds
of few long segments leave open are bounded again by more and shorter segments,
and what then can still enter a result is scored exactly. The least score that
can still enter rises as a block is worked through.

Rows and anchors are dealt into blocks of bounded size and each block of
anchors meets each block of rows in a task of its own, so that no side is ever
collected or broadcast. Each task returns at most a few rows an anchor.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from auditloom.llm.common import query, table
from auditloom.llm.components import stored

#: Segments of a stored summary, and summaries that one of the first, coarser test joins.
SEGMENTS = 16
JOINED = 4
#: Most rows and anchors of a block, as dealt by hash.
ROW_BLOCK = 32_768
ANCHOR_BLOCK = 8_192
#: Rows and anchors that are compared at a time inside a task.
ROWS_AT_ONCE = 4_096
ANCHORS_AT_ONCE = 256
#: From this share of open pairs on, all pairs of a step are multiplied out at once.
DENSE = 0.05


def segment_summaries(vectors, segments=SEGMENTS):
    """Means and deviations (rows, segments) of the segments; the last one is filled up with zeros.

    Both are multiplied by the root of the segment's length, so that a score is
    bounded by their plain inner products.
    """
    rows, dim = vectors.shape
    length = max(1, -(-dim // segments))
    filled = np.zeros((rows, segments * length))
    filled[:, :dim] = vectors
    parts = filled.reshape(rows, segments, length)
    return parts.mean(axis=2) * length**0.5, parts.std(axis=2) * length**0.5


def joined_summaries(means, deviations, joined=JOINED):
    """The summaries of segments that are `joined` times as long."""
    rows, segments = means.shape
    means, deviations = means.reshape(rows, -1, joined), deviations.reshape(rows, -1, joined)
    spread = (deviations**2).sum(axis=2) + means.var(axis=2) * joined
    return means.mean(axis=2) * joined**0.5, np.sqrt(spread)


class Block:
    """Vectors of one length with ids, labels, numbers and summaries of two levels."""

    def __init__(self, rows, vectors):
        self.number, self.id, self.label, self.vectors = rows["number"], rows["id"], rows["label"], vectors
        fine = rows["means"], rows["deviations"]
        self.levels = [joined_summaries(*fine), fine]
        self.norms = np.sqrt((vectors**2).sum(axis=1))

    @classmethod
    def of(cls, rows):
        """The block of an Arrow table."""
        size = rows.num_rows

        def matrix(name):
            flat = rows.column(name).combine_chunks()
            values = flat.flatten() if isinstance(flat, pa.ListArray) else pa.array([], pa.float64())
            return values.to_numpy(zero_copy_only=False).reshape(size, -1) if len(values) else np.zeros((size, 0))

        plain = {name: rows.column(name).to_numpy() for name in ("number", "id", "label")}
        plain |= {name: matrix(name) for name in ("means", "deviations")}
        return cls(plain, matrix("vector"))

    def part(self, start, size):
        """Rows from `start` on."""
        some, cut = object.__new__(Block), slice(start, start + size)
        some.number, some.id, some.label = self.number[cut], self.id[cut], self.label[cut]
        some.vectors, some.norms = self.vectors[cut], self.norms[cut]
        some.levels = [(m[cut], d[cut]) for m, d in self.levels]
        return some


def _exact_kind(left, right):
    """The type in which all inner products of two sets of integer vectors are exact."""
    largest = [np.abs(v).max(initial=0.0) for v in (left, right)]
    size = largest[0] * largest[1] * max(1, left.shape[1])
    if size >= 2.0**62:
        raise ValueError("Components are too large for 64-bit scores.")
    return np.float64 if size < 2.0**52 else np.int64


def open_scores(anchors, rows, allowed, least, most):
    """(anchor, row, score) of all `allowed` pairs that score from `least` to `most`, both per anchor.

    Each level of summaries is asked only where an earlier one left pairs open.
    """
    # Bounds are rounded sums of floating-point products, scores are whole numbers.
    slack = 0.5 + 1e-9 * anchors.norms.max(initial=0) * rows.norms.max(initial=0)
    low, high = least - slack, most + slack
    left = allowed & (low <= high)[:, None]
    for (a_mean, a_dev), (r_mean, r_dev) in zip(anchors.levels, rows.levels):
        if left.mean() >= DENSE:
            middle, width = a_mean @ r_mean.T, a_dev @ r_dev.T
            left &= (middle + width >= low[:, None]) & (middle - width <= high[:, None])
        else:
            a, r = np.nonzero(left)
            middle = np.einsum("ij,ij->i", a_mean[a], r_mean[r])
            width = np.einsum("ij,ij->i", a_dev[a], r_dev[r])
            shut = (middle + width < low[a]) | (middle - width > high[a])
            left[a[shut], r[shut]] = False
    kind = _exact_kind(anchors.vectors, rows.vectors)
    if left.mean() >= DENSE:
        scores = anchors.vectors.astype(kind) @ rows.vectors.astype(kind).T
        a, r = np.nonzero(left & (scores >= least[:, None]) & (scores <= most[:, None]))
        return a, r, scores[a, r].astype(np.int64)
    a, r = np.nonzero(left)
    scores = np.einsum("ij,ij->i", anchors.vectors.astype(kind)[a], rows.vectors.astype(kind)[r]).astype(np.int64)
    inside = (scores >= least[a]) & (scores <= most[a])
    return a[inside], r[inside], scores[inside]


class Best:
    """The first `size` (score down, id up) of each of `groups` groups."""

    def __init__(self, groups, size):
        self.size = size
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.last = np.full(groups, np.iinfo(np.int64).min)

    def add(self, group, score, ids):
        """Take in more; `last` then is the score that a full group's next one must reach."""
        new = score >= self.last[group]
        group, score, ids = (
            np.concatenate([old, more[new]])
            for old, more in ((self.group, group), (self.score, score), (self.id, ids))
        )
        order = np.lexsort((ids, -score, group))
        group, score, ids = group[order], score[order], ids[order]
        place = np.arange(len(group)) - np.searchsorted(group, group)
        kept = place < self.size
        full = place == self.size - 1
        self.last[group[full]] = score[full]
        self.group, self.score, self.id = group[kept], score[kept], ids[kept]


def nearest(anchors, rows, size):
    """(anchor, id, score) of the `size` best other rows of each anchor's label, in these blocks."""
    best = Best(len(anchors.id), size)
    no_most = np.full(len(anchors.id), np.inf)
    for start in range(0, len(rows.id), ROWS_AT_ONCE):
        some = rows.part(start, ROWS_AT_ONCE)
        allowed = (anchors.label[:, None] == some.label) & (anchors.number[:, None] != some.number)
        a, r, score = open_scores(anchors, some, allowed, best.last.astype(float), no_most)
        best.add(a, score, some.id[r])
    return best.group, best.id, best.score


def in_bands(anchors, rows, owner, least, most, size):
    """(band, id, score) of the `size` best rows of other labels in each band, in these blocks.

    Band i reaches from `least[i]` to `most[i]` and belongs to the anchor `owner[i]`.
    """
    best = Best(len(owner), size)
    groups = len(anchors.id)
    most_of = np.full(groups, -np.inf)
    np.maximum.at(most_of, owner, most.astype(float))
    # The bands of an anchor, one column each.
    order = np.argsort(owner, kind="stable")
    place = np.arange(len(owner)) - np.searchsorted(owner[order], owner[order])
    bands = np.full((groups, place.max(initial=-1) + 1), -1)
    bands[owner[order], place] = order
    for start in range(0, len(rows.id), ROWS_AT_ONCE):
        some = rows.part(start, ROWS_AT_ONCE)
        least_of = np.full(groups, np.inf)
        np.minimum.at(least_of, owner, np.maximum(least, best.last).astype(float))
        allowed = anchors.label[:, None] != some.label
        a, r, score = open_scores(anchors, some, allowed, least_of, most_of)
        for column in bands.T:
            band = column[a]
            fits = (band >= 0) & (score >= least[band]) & (score <= most[band])
            best.add(band[fits], score[fits], some.id[r[fits]])
    return best.group, best.id, best.score


SUMMARY = "number long, id long, label long, dim int, vector array<double>, means array<double>, deviations array<double>"


def summarised(df, id_col, vector_col, label_col, scale):
    """Rows that take part, numbered, with whole components and their segment summaries."""
    value = F.col(vector_col).cast("array<double>")
    finite = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    usable = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(finite, F.lit(False))
    rows = df.where(usable).select(
        F.monotonically_increasing_id().alias("number"),
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("long").alias("label"),
        value.alias("vector"),
    )

    def lists(values, rows):
        offsets = np.arange(rows + 1, dtype=np.int32) * values.shape[1]
        return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1), pa.float64()))

    def run(batches):
        for batch in batches:
            sizes = batch.column(3).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                some = batch.take(pa.array(np.nonzero(sizes == dim)[0]))
                rows = some.num_rows
                flat = some.column(3).flatten().to_numpy(zero_copy_only=False)
                vectors = np.floor(flat.reshape(rows, dim) * float(scale))
                means, deviations = segment_summaries(vectors)
                columns = [*some.columns[:3], pa.array(np.full(rows, dim, np.int32))]
                columns += [lists(v, rows) for v in (vectors, means, deviations)]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SUMMARY.split(", ")])

    return rows.mapInArrow(run, SUMMARY)


def _dealt(rows, anchors, blocks, anchor_blocks):
    """Rows and anchors, grouped so that each block of one meets each block of the other."""
    mine = F.pmod(F.xxhash64("number"), F.lit(blocks)).alias("block")
    theirs = F.pmod(F.xxhash64("number"), F.lit(anchor_blocks)).alias("anchor_block")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("block")
    every_other = F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)).cast("array<long>")).alias("anchor_block")
    key = ["block", "anchor_block", "dim"]
    left = anchors.select("*", every, theirs).groupBy(*key)
    return left.cogroup(rows.select("*", mine, every_other).groupBy(*key))


def _compared(dealt, find):
    """Results (number, band, other_id, score) of `find(anchors, rows, table of anchors)` over all block pairs."""

    def run(anchor_rows, rows):
        found = []
        if anchor_rows.num_rows and rows.num_rows:
            block = Block.of(rows)
            for start in range(0, anchor_rows.num_rows, ANCHORS_AT_ONCE):
                some = anchor_rows.slice(start, ANCHORS_AT_ONCE)
                found.append(find(Block.of(some), block, some))
        columns = [np.concatenate(c) if found else np.zeros(0, np.int64) for c in (list(zip(*found)) or [()] * 4)]
        return pa.table(dict(zip(("number", "band", "other_id", "score"), (pa.array(c, pa.int64()) for c in columns))))

    return dealt.applyInArrow(run, "number long, band long, other_id long, score long")


def _first(found, size):
    """The first `size` of each (number, band), with their rank."""
    order = Window.partitionBy("number", "band").orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(
    df, is_anchor, positives=5, negatives=3, low=50, high=95, scale=256,
    id_col="vec_id", vector_col="embedding", label_col="label",
):
    """Per anchor and positive its hard negatives: anchor_id, positive_id, rank, negative_id, both scores.

    `is_anchor` is a condition on the column `id`. Components become
    floor(scale * x) and a score is the inner product. An anchor's positives are
    its `positives` best other rows of the same label; their negatives the
    `negatives` best rows of other labels scoring from `low` to `high` percent
    of the positive; ties go to the smaller id. A positive score below zero has
    no negatives, one of zero only those of zero.

    Rows without id or label, or with a vector that is null or holds a null or
    non-finite component, take no part. Vectors are compared with those of the
    same length; empty ones score zero. Rows that share an id are rows of their
    own, as anchors too, also where they are equal. Components whose scores
    could pass 62 bits are an error. Other columns are left out.
    """
    rows = stored(summarised(df, id_col, vector_col, label_col, scale), "segments")
    anchors = stored(rows.where(is_anchor), "anchors")  # a table of its own, so that the join is no self-join
    spark = df.sparkSession
    total, asking = rows.count(), anchors.count()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-total // ROW_BLOCK), min(tasks, total // ROWS_AT_ONCE))
    anchor_blocks = max(1, -(-asking // ANCHOR_BLOCK))

    def near(block, rows, _):
        a, ids, score = nearest(block, rows, positives)
        return block.number[a], np.zeros(len(a), np.int64), ids, score

    found = stored(_first(_compared(_dealt(rows, anchors, blocks, anchor_blocks), near), positives), "positives")
    found = found.select("number", F.col("rank").alias("band"), F.col("other_id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    # At most `positives` an anchor.
    bands = found.where("positive_score >= 0").groupBy("number").agg(
        F.collect_list(F.struct("band", "positive_score")).alias("bands")
    )
    asking_rows = anchors.join(bands, "number").select(
        *anchors.columns, F.col("bands.band").alias("band"), F.col("bands.positive_score").alias("positive_score")
    )

    def hard(block, rows, some):
        lists = some.column("band").combine_chunks()
        owner = np.repeat(np.arange(some.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
        band = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        wanted = some.column("positive_score").combine_chunks().flatten().to_pylist()
        least = np.array([-(-low * p // 100) for p in wanted], np.int64)
        most = np.array([high * p // 100 for p in wanted], np.int64)
        group, ids, score = in_bands(block, rows, owner, least, most, negatives)
        return block.number[owner[group]], band[group], ids, score

    best = _first(_compared(_dealt(rows, asking_rows, blocks, anchor_blocks), hard), negatives)
    ids = anchors.select("number", F.col("id").alias("anchor_id"))
    return best.join(found, ["number", "band"]).join(ids, "number").select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


ORACLE = """
with r as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as a, r.vec_id as b, a.label = r.label as same,
    coalesce(list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2])), 0)::bigint as s
  from r a, r where a.vec_id % 50 = 0 and a.vec_id <> r.vec_id and len(a.v) = len(r.v)),
pos as (
  select * from scored where same
  qualify row_number() over (partition by a order by s desc, b) <= 5)
select p.a as anchor_id, p.b as positive_id,
  (row_number() over (partition by p.a, p.b order by n.s desc, n.b))::int as rank,
  n.b as negative_id, p.s as positive_score, n.s as negative_score
from pos p join scored n on n.a = p.a and not n.same and 50 * p.s <= 100 * n.s and 100 * n.s <= 95 * p.s
qualify row_number() over (partition by p.a, p.b order by n.s desc, n.b) <= 3
"""


@query("op13_hard_negatives", ORACLE)
def op13_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector against all vectors."""
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("id") % 50 == 0)
