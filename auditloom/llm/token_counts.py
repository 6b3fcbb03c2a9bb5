"""Token counts by heap-and-linked-list byte-pair merging.

A text starts as a linked list of characters, a character outside the
vocabulary standing for its bytes. A heap holds the adjacent pairs whose
concatenation is a piece, lowest rank first and leftmost among equals; popping
and merging goes on until it is empty. The count is the initial symbols minus
the merges; no identifier is ever made.

Where no piece reaches across a space, a text is cut before each run of spaces
and the counts of the cut pieces are remembered within a task, so that a word
is merged once. The memory is emptied when it reaches `REMEMBERED` words.
"""

import re
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from auditloom.llm import model_file
from auditloom.llm.common import query, table

#: Words whose counts a task remembers at a time.
REMEMBERED = 400_000
#: Longer words are rare and not remembered.
REMEMBERED_CHARS = 64


class PairMerger:
    """Counts tokens under a byte-pair model of the SentencePiece format."""

    def __init__(self, model):
        if model.kind != model_file.BPE:
            raise ValueError("Merging needs a byte-pair model.")
        if model.charsmap or model.trim or not model.escape:
            raise ValueError("Only the identity normaliser without trimming is supported.")
        if model_file.USER_DEFINED in model.types or model_file.UNUSED in model.types:
            raise ValueError("User-defined and unused pieces are not supported.")
        self.prefix = model_file.SPACE if model.dummy_prefix else ""
        pieces = model.mergeable()
        self.rank = {p: -s for p, s in pieces.items() if len(p) > 1}
        self.known = {p for p in pieces if len(p) == 1}
        self.byte_fallback = model.byte_fallback
        space = model_file.SPACE
        self.cut = re.compile(f"{space}*[^{space}]+|{space}+") if model_file.splits_at_spaces(model) else None
        self.counts = {}

    def symbols(self, text):
        """Symbols that stand for `text` before any merge."""
        if not self.byte_fallback:
            return len(text)
        return len(text) + sum(len(c.encode()) - 1 for c in text if c not in self.known)

    def merges(self, text):
        """Merges that are made in `text`."""
        rank, size, done = self.rank, len(text), 0
        heap = []
        for i in range(size - 1):
            pair = text[i : i + 2]
            if pair in rank:
                heap.append((rank[pair], i, pair))
        heapify(heap)
        held, after, before = list(text), list(range(1, size + 1)), list(range(-1, size))
        while heap:
            _, left, pair = heappop(heap)
            right = after[left]
            if held[left] is None or right >= size or held[left] + held[right] != pair:
                continue  # one of the two has been merged since
            held[left], held[right] = pair, None
            done += 1
            after[left] = follows = after[right]
            if follows < size:
                before[follows] = left
                joined = pair + held[follows]
                if joined in rank:
                    heappush(heap, (rank[joined], left, joined))
            leads = before[left]
            if leads >= 0:
                joined = held[leads] + pair
                if joined in rank:
                    heappush(heap, (rank[joined], leads, joined))
        return done

    def count(self, text):
        """Tokens of a whole text; 0 for an empty one."""
        if not text:
            return 0
        text = self.prefix + text.replace(" ", model_file.SPACE)
        if self.cut is None:
            return self.symbols(text) - self.merges(text)
        counts, total = self.counts, 0
        for word in self.cut.findall(text):
            known = counts.get(word)
            if known is None:
                known = self.symbols(word) - self.merges(word)
                if len(word) <= REMEMBERED_CHARS:
                    if len(counts) >= REMEMBERED:
                        counts.clear()
                    counts[word] = known
            total += known
        return total


def count_tokens(df, model, id_col="doc_id", text_col="text"):
    """`id_col` and `n_tokens` (long) of each row of `df`; a null text counts as empty.

    `model` holds the bytes of the model file; they travel with the tasks, which
    read no local file. Rows are kept one to one, repeated rows too; other
    columns of `df` are left out, whatever their names.
    """
    PairMerger(model_file.parse(model))  # refuse an unsuitable model before the job runs

    def run(batches):
        merger = PairMerger(model_file.parse(model))
        for batch in batches:
            counts = [merger.count(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["key", "n_bytes", "n_tokens"]
            )

    key = df.schema[id_col].dataType
    narrow = df.select(
        F.col(id_col).alias("key"),
        F.col(text_col).alias("text"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
    )
    counted = narrow.mapInArrow(run, f"key {key.simpleString()}, n_bytes long, n_tokens long")
    return counted.withColumnRenamed("key", id_col)


@query("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    """Token counts of all documents under the public 32k byte-pair model."""
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        model = file.read()
    counted = count_tokens(table(spark, sf_dir, "documents"), model)
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)
