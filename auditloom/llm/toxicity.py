"""Toxicity by a weighted finite-state pattern grammar.

The terms of insults are learned from labelled documents: words and word stems
that stand in many different contexts of toxic documents and hardly in others.
Contexts are counted, not documents, so that copies of a toxic document do not
make its words toxic.

A clause is a list of word classes. Three transducers read it side by side: the
target one marks a term said within a few words of a person, the negation one a
term within a few words behind a negation, the reported-speech one a term behind
a verb of saying. Composed into one automaton they give each insult or threat of
a clause a path label. A text's score is the logistic of the weights of what
its matched clauses hold: how many clauses there are, how many terms by path
label, and how long the text is. A ridge regression learns the weights from the
same documents.

A stem is learned only if several words share its contexts; of stems within one
another the longest that keeps nearly all contexts is taken.

Defined cases: null texts count as empty and score as texts without a match;
repeated rows are scored one by one; without labelled rows there are no learned
terms and every score is 0.5.
"""

import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from auditloom.llm.common import held_out, let, query, table
from auditloom.llm.training import labelled_sample

#: Lengths of stems that may be learned.
STEMS = (4, 5, 6, 7, 8)
#: A term needs as many contexts in toxic documents, and that share of all its contexts.
LEAST_CONTEXTS, LEAST_SHARE = 12, 0.8
#: A stem's most frequent word has that share of its contexts at most.
MOST_ONE_WORD = 0.7
#: A longer stem replaces a shorter one if it keeps that share of its contexts.
KEPT_CONTEXTS = 0.9
#: Words that a target or negation reaches.
TARGET_REACH, NEGATION_REACH = 4, 3

TARGETS = frozenset(
    "you your youre he she they him them du dich ihr sie er tu te vous il elle ils usted ustedes ellos él ella".split()
)
NEGATIONS = frozenset("not never no isnt arent dont nicht kein keine nie pas jamais ni nunca jamás tampoco".split())
REPORTS = frozenset("said says say told wrote claimed quoted sagte sagt schrieb dit disait écrit dijo dice escribió".split())
THREATS = frozenset("kill murder hurt destroy attack töten umbringen tuer frapper matar golpear".split())

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:,()\n…]+")

OTHER, TARGET, NEGATION, REPORT, INSULT, THREAT = range(6)
LABELS = list(product((INSULT, THREAT), (False, True), (False, True), (False, True)))


def _countdown(marker, reach):
    """A transducer that marks terms up to `reach` words behind `marker`: (state, class) to (state, mark)."""
    return {
        (state, kind): (reach if kind == marker else max(0, state - 1), state > 0)
        for state in range(reach + 1)
        for kind in range(6)
    }


def _latch(marker):
    """A transducer that marks all terms behind `marker`."""
    return {(state, kind): (state or int(kind == marker), state > 0) for state in range(2) for kind in range(6)}


def composed(*transducers):
    """The automaton that runs `transducers` side by side: (states, class) to (states, marks)."""
    spaces = [sorted({state for state, _ in t}) for t in transducers]
    return {
        (states, kind): tuple(zip(*[t[state, kind] for t, state in zip(transducers, states)]))
        for states in product(*spaces)
        for kind in range(6)
    }


AUTOMATON = composed(
    _countdown(TARGET, TARGET_REACH), _countdown(NEGATION, NEGATION_REACH), _latch(REPORT)
)


@dataclass
class Grammar:
    """Learned terms and the weights of path labels."""

    words: frozenset = frozenset()
    stems: frozenset = frozenset()
    bias: float = 0.0
    weights: list = field(default_factory=lambda: [0.0] * (len(LABELS) + 3))

    def kind(self, word):
        """The class of a lower-case word."""
        if word in self.words or any(word[:n] in self.stems for n in STEMS if len(word) >= n):
            return INSULT
        if word in THREATS:
            return THREAT
        if word in TARGETS:
            return TARGET
        if word in NEGATIONS:
            return NEGATION
        return REPORT if word in REPORTS else OTHER

    def labels(self, clause):
        """The path label of each term in a clause, given as lower-case words."""
        states, found = (0, 0, 0), []
        for word in clause:
            kind = self.kind(word)
            states, marks = AUTOMATON[states, kind]
            if kind >= INSULT:
                found.append((kind, *marks))
        return found

    def matches(self, text):
        """Terms of a text's matched clauses by path label, the clauses, and all words."""
        low = (text or "").lower()
        # Most texts have no term at all: their distinct words tell.
        all_words = _WORD.findall(low)
        terms = {w for w in set(all_words) if self.kind(w) >= INSULT}
        counts, clauses = Counter(), 0
        if terms:
            for clause in _CLAUSE.split(low):
                words = _WORD.findall(clause)
                if not terms.isdisjoint(words):
                    clauses += 1
                    counts.update(self.labels(words))
        return counts, clauses, len(all_words)

    def row(self, text):
        """What the weights are applied to."""
        counts, clauses, size = self.matches(text)
        terms = sum(counts.values())
        by_label = [float(np.log1p(counts[label])) for label in LABELS]
        # Length matters only where something matched.
        return [float(np.log1p(clauses)), float(np.log1p(terms)), float(np.log1p(size)) * (terms > 0), *by_label]

    def score(self, rows):
        total = self.bias + np.asarray(rows, float).reshape(-1, len(LABELS) + 3) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def term_counts(sample):
    """(term, stem, toxic, clean, top): contexts of words and stems in labelled documents.

    A context is the word with its two neighbours, counted once for each label;
    `top` is the toxic contexts of the term's most frequent word.
    """
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: w != "")
    around = let(
        words,
        lambda w: F.transform(
            w,
            lambda x, i: F.struct(
                x.alias("word"), F.xxhash64(F.get(w, i - F.lit(1)), F.lit(0), F.get(w, i + F.lit(1))).alias("around")
            ),
        ),
    )
    contexts = sample.select("label", F.inline(around)).distinct()
    counts = contexts.groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")
    )
    forms = F.array(
        F.struct(F.col("word").alias("term"), F.lit(False).alias("stem")),
        *[
            F.struct(
                F.when(F.char_length("word") >= n, F.substring("word", 1, n)).alias("term"), F.lit(True).alias("stem")
            )
            for n in STEMS
        ],
    )
    spread = counts.select("toxic", "clean", F.inline(forms)).filter("term is not null")
    return spread.groupBy("term", "stem").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.max("toxic").alias("top")
    )


def learned_terms(sample):
    """(words, stems) that mark toxic documents.

    Each needs its own contexts in the sample, whose size bounds their number.
    """
    share = F.col("toxic") / (F.col("toxic") + F.col("clean") + 1)
    strong = term_counts(sample).filter((F.col("toxic") >= LEAST_CONTEXTS) & (share >= LEAST_SHARE))
    productive = ~F.col("stem") | (F.col("top") <= MOST_ONE_WORD * F.col("toxic"))
    best = strong.filter(productive).collect()
    stems = {r.term: r.toxic for r in best if r.stem}
    for stem in sorted(stems, key=len, reverse=True):
        longer = [t for t in stems if len(t) > len(stem) and t.startswith(stem)]
        if any(stems[t] >= KEPT_CONTEXTS * stems[stem] for t in longer):
            del stems[stem]
    shortest = {s for s in stems if not any(s[:n] in stems for n in STEMS if n < len(s))}
    covered = lambda w: any(w[:n] in shortest for n in STEMS if len(w) >= n)
    return frozenset(r.term for r in best if not r.stem and not covered(r.term)), frozenset(shortest)


def _ridge_logistic(rows, labels, ridge=1.0, steps=50):
    """(bias, weights) by Newton's method."""
    x = np.column_stack([np.ones(len(rows)), rows])
    beta, penalty = np.zeros(x.shape[1]), np.eye(x.shape[1]) * ridge
    penalty[0, 0] = 1e-3
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (labels - p) - penalty @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), beta[1:].tolist()


def _rows(df, grammar, columns):
    """The columns of `df` and `row` for its `text`."""
    kinds = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in columns)

    def run(batches):
        for batch in batches:
            made = [grammar.row(t) for t in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k) for k in range(len(columns))], pa.array(made, pa.list_(pa.float64()))],
                names=[*columns, "row"],
            )

    return df.select(*columns, "text").mapInArrow(run, f"{kinds}, row array<double>")


def trained(documents, labels):
    """The grammar of `labels.toxic`, learned without held-out rows."""
    sample = labelled_sample(documents, labels, "toxic", 5, 0)
    words, stems = learned_terms(sample)
    grammar = Grammar(words, stems)
    fetched = _rows(sample, grammar, ["doc_id", "label"]).collect()  # at most FIT_ROWS rows
    if fetched:
        fetched.sort(key=lambda r: (r.doc_id, r.label, r.row))
        rows, labels_ = np.array([r.row for r in fetched]), np.array([r.label for r in fetched], float)
        grammar.bias, grammar.weights = _ridge_logistic(rows, labels_)
    return grammar


def scored(df, grammar, id_col="doc_id", text_col="text"):
    """`id_col`, `score` and `n_clauses` (matched clauses) of each row."""

    def run(batches):
        for batch in batches:
            rows = [grammar.row(t) for t in batch.column(1).to_pylist()]
            score = grammar.score(rows)
            clauses = [round(np.expm1(r[0])) for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array(clauses, pa.int64())], names=["key", "score", "n_clauses"]
            )

    key = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    return narrow.mapInArrow(run, f"key {key}, score double, n_clauses long").withColumnRenamed("key", id_col)


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """Toxicity of all documents."""
    documents = table(spark, sf_dir, "documents")
    made = scored(documents, trained(documents, table(spark, sf_dir, "labels")))
    return made.select(
        "doc_id",
        held_out(F.col("doc_id"), 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_clauses",
    )
