"""Quality classifier: an additive model with pairwise interactions.

Each text is described by a dozen counts and shares. Every feature is cut into
bins at quantiles and has a lookup table over its bins; boosting goes round the
features in turn and adds to each table a shallow tree of two cuts fitted on
the gradients of the logistic loss, shrunk. Then the pairs of features that
explain most of what is left get tables over both their bins, boosted in turn
by trees with a cut on either axis. A score is a sum of table entries.

The model is fitted by the driver on the features of at most `FIT_ROWS`
labelled documents; scoring is one pass over the documents without a shuffle.

Defined cases: null texts count as empty and are scored; repeated rows are
scored one by one; without any labelled row every score is 0.5.
"""

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from auditloom.llm.common import held_out, query, table
from auditloom.llm.training import labelled_sample

FEATURES = (
    "log_words",
    "word_length",
    "distinct_words",
    "repeated_neighbours",
    "upper_letters",
    "symbols",
    "exclamations",
    "bars",
    "digits",
    "non_ascii",
    "ended_lines",
    "repeated_lines",
    "line_words",
)
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_ENDS = tuple(".!?:;…»”\"'")


def describe(text):
    """The features of one text."""
    data = (text or "").encode()
    words = text.split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    ended = sum(line.rstrip().endswith(_ENDS) for line in lines)
    repeats = sum(map(str.__eq__, words, words[1:]))
    return [
        float(np.log1p(n)),
        len(data) / n,
        len(set(words)) / n**0.8,
        repeats / n,
        upper / max(1, upper + lower),
        int(seen[_SYMBOLS].sum()) / n,
        int(seen[33]) / n,
        int(seen[124]) / n,
        int(seen[48:58].sum()) / n,
        int(seen[128:].sum()) / len(data),
        ended / len(lines),
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
    ]


@dataclass
class Additive:
    """Lookup tables over feature bins, to be summed."""

    intercept: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: dict = field(default_factory=dict)

    def bins(self, rows):
        """Bin of each feature of each row."""
        return [np.searchsorted(e, rows[:, k], side="right") for k, e in enumerate(self.edges)]

    def score(self, rows):
        """Probability of label 1 of each row of features."""
        total, bins = np.full(len(rows), self.intercept), self.bins(rows) if self.edges else []
        for b, lookup in zip(bins, self.tables):
            total += lookup[b]
        for (i, j), lookup in self.pairs.items():
            total += lookup[bins[i], bins[j]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _leaf(gradient, weight, ridge):
    return gradient / (weight + ridge)


def _gain(gradient, weight, ridge):
    return gradient * gradient / (weight + ridge)


def _tree(gradient, weight, ridge, cuts=2):
    """A tree of `cuts` cuts over the bins of one feature: what to add to each bin."""
    spans = [(0, len(gradient))]
    g, w = np.append(0, np.cumsum(gradient)), np.append(0, np.cumsum(weight))
    for _ in range(cuts):
        best = (1e-12, None, None)
        for span in spans:
            a, b = span
            if b - a < 2:
                continue
            at = np.arange(a + 1, b)
            left = _gain(g[at] - g[a], w[at] - w[a], ridge)
            right = _gain(g[b] - g[at], w[b] - w[at], ridge)
            gains = left + right - _gain(g[b] - g[a], w[b] - w[a], ridge)
            k = int(np.argmax(gains))
            if gains[k] > best[0]:
                best = (gains[k], span, int(at[k]))
        if best[1] is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(gradient))
    for a, b in spans:
        out[a:b] = _leaf(g[b] - g[a], w[b] - w[a], ridge)
    return out


def _quadrants(gradient, weight, ridge):
    """The best tree with one cut on each axis of a pair's bins: (gain, what to add)."""
    g, w = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, weight))
    top_g, top_w = g[1:-1, 1:-1], w[1:-1, 1:-1]
    if top_g.size == 0:
        return 0.0, np.zeros(gradient.shape)
    parts = []
    for x, t in ((g, top_g), (w, top_w)):
        above, beside, all_ = x[1:-1, -1:], x[-1:, 1:-1], x[-1, -1]
        parts.append((t, above - t, beside - t, all_ - above - beside + t))
    gains = sum(_gain(a, b, ridge) for a, b in zip(*parts)) - _gain(g[-1, -1], w[-1, -1], ridge)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    leaf = [_leaf(a[i, j], b[i, j], ridge) for a, b in zip(*parts)]
    out = np.empty(gradient.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :] = leaf[0], leaf[1]
    out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = leaf[2], leaf[3]
    return float(gains[i, j]), out


def fit(rows, labels, bins=32, pair_bins=12, rounds=200, pair_rounds=60, pairs=6, rate=0.1, ridge=2.0):
    """An `Additive` model of 0/1 `labels` from features, a row each."""
    model = Additive()
    if len(rows) == 0:
        return model
    labels = np.asarray(labels, float)
    rate_of_one = (labels.sum() + 1) / (len(labels) + 2)
    model.intercept = float(np.log(rate_of_one / (1 - rate_of_one)))
    quantiles = np.linspace(0, 1, bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(rows[:, k], quantiles)) for k in range(rows.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    placed = model.bins(rows)
    total = np.full(len(rows), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for k, lookup in enumerate(model.tables):
            gradient, weight = slopes()
            size = len(lookup)
            step = rate * _tree(
                np.bincount(placed[k], gradient, size), np.bincount(placed[k], weight, size), ridge
            )
            lookup += step
            total += step[placed[k]]

    # Pairs are cut more coarsely; their tables are kept over the features' own bins.
    coarse = [np.minimum(b * pair_bins // len(t), pair_bins - 1) for b, t in zip(placed, model.tables)]

    def sums(i, j, values):
        flat = np.bincount(coarse[i] * pair_bins + coarse[j], values, pair_bins * pair_bins)
        return flat.reshape(pair_bins, pair_bins)

    gradient, weight = slopes()
    worth = {
        (i, j): _quadrants(sums(i, j, gradient), sums(i, j, weight), ridge)[0]
        for i, j in combinations(range(rows.shape[1]), 2)
    }
    small = {pair: np.zeros((pair_bins, pair_bins)) for pair in sorted(worth, key=lambda p: (-worth[p], p))[:pairs]}
    for _ in range(pair_rounds):
        for (i, j), lookup in small.items():
            gradient, weight = slopes()
            step = rate * _quadrants(sums(i, j, gradient), sums(i, j, weight), ridge)[1]
            lookup += step
            total += step[coarse[i], coarse[j]]
    for (i, j), lookup in small.items():
        wide = [np.minimum(np.arange(len(model.tables[k])) * pair_bins // len(model.tables[k]), pair_bins - 1) for k in (i, j)]
        model.pairs[i, j] = lookup[np.ix_(*wide)]
    return model


def described(df, extra=()):
    """The columns `extra` of `df` and the `features` of its `text`."""
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in extra)

    def run(batches):
        for batch in batches:
            made = [describe(t) for t in batch.column(len(extra)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(len(extra))], pa.array(made, pa.list_(pa.float64()))],
                names=[*extra, "features"],
            )

    return df.select(*extra, "text").mapInArrow(run, f"{kinds}, features array<double>")


def trained(documents, labels):
    """The model of `labels.quality`, fitted without held-out rows."""
    sample = described(labelled_sample(documents, labels, "quality", 3, 1), ("doc_id", "label"))
    fetched = sample.select("doc_id", "label", "features").collect()  # at most FIT_ROWS rows
    fetched.sort(key=lambda r: (r.doc_id, r.label, r.features))
    rows = np.array([r.features for r in fetched], float).reshape(len(fetched), len(FEATURES))
    return fit(rows, [r.label for r in fetched])


def scored(df, model, id_col="doc_id", text_col="text"):
    """`id_col` and `score` of each row."""

    def run(batches):
        for batch in batches:
            made = np.array([describe(t) for t in batch.column(1).to_pylist()], float)
            score = model.score(made.reshape(batch.num_rows, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["key", "score"])

    key = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"key {key}, score double").withColumnRenamed("key", id_col)


def accepted(df, model, text_col="text", threshold=0.5):
    """The rows of `df` that score at least `threshold`, all columns kept, without a join."""
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            made = np.array([describe(t) for t in batch.column(at).to_pylist()], float)
            score = model.score(made.reshape(batch.num_rows, len(FEATURES)))
            yield batch.filter(pa.array(score >= threshold))

    return df.mapInArrow(run, df.schema)


@query("op1_quality_classifier")
def op1_quality_classifier(spark, sf_dir):
    """Quality of all documents."""
    documents = table(spark, sf_dir, "documents")
    made = scored(documents, trained(documents, table(spark, sf_dir, "labels")))
    return made.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
