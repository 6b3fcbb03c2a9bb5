"""Line deduplication by content-defined chunks that start at every line.

A repeated passage is a run of lines that stands anywhere else too, in the same
or another document, and has at least two lines with words and `LEAST_WORDS`
words, or a line of `LONG_WORDS` words or more. Lines without words are skipped
over when runs are compared, and go where the lines around them both go.

From each line on, the shortest chunk that is long enough to be such a passage
is hashed, and up to each line the shortest one that ends there, by a rolling
hash over line hashes. Both depend on nothing outside the chunk. The chunks that
start or end within a repeated passage of any length cover just its lines, so
the lines of repeated chunks are those of the longest repeated runs, whatever
stands around them. Chunks with the same hash are compared byte by byte; all but
the first, in the order of document ids and then of places, are removed. Of a
chunk that overlaps the first one, the lines that both share stay.

Chunks travel as hashes; only texts of chunks whose hash repeats are compared,
folded to the smallest and the largest text of a hash before they are shuffled.

Defined cases: null texts stay null; a document that has words and keeps none
was made of repeated chunks only and gets an empty text (`deduplicated` drops
it); rows that repeat both id and text are one document and are treated alike.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditloom.llm.common import query, table
from auditloom.llm.components import stored
from auditloom.operators.joins import folded

#: A rolling hash ends a chunk with a chance of one in `SPACING`.
SPACING = 2
#: Lines of a chunk.
LEAST_LINES, MOST_LINES = 2, 16
#: Words of a line that is a passage by itself, and of a passage of several lines.
LONG_WORDS, LEAST_WORDS = 50, 20

_ROLL = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def windows(text):
    """(worded lines, places, first, last, hash): the chunks of a text that may be removed.

    `places` are the line numbers of the worded lines; `first` and `last` count
    worded lines. No chunk is given twice.
    """
    split = [(i, line, n) for i, line in enumerate(text.split("\n")) if (n := len(line.split()))]
    lines = [line for _, line, _ in split]
    places = np.array([i for i, _, _ in split], np.int32)
    sizes = np.array([n for _, _, n in split], np.int64)
    count = len(lines)
    at, sums = np.arange(count), np.concatenate([[0], np.cumsum(sizes)])
    ends = np.maximum(np.searchsorted(sums, sums[:-1] + LEAST_WORDS) - 1, at + LEAST_LINES - 1)
    ends = np.where(sizes >= LONG_WORDS, at, ends)
    begins = np.minimum(np.searchsorted(sums, sums[1:] - LEAST_WORDS, "right") - 1, at - LEAST_LINES + 1)
    begins = np.where(sizes >= LONG_WORDS, at, begins)
    other = begins >= 0
    other[other] = ends[begins[other]] != at[other]
    first = np.concatenate([at[ends < count], begins[other]])
    last = np.concatenate([ends[ends < count], at[other]])
    # The sum of hash * roll^place from first to last, over roll^first; modulo 2^64.
    hashes = np.array([xxhash.xxh3_64_intdigest(line) for line in lines], np.uint64)
    powers = np.cumprod(np.full(count, _ROLL, np.uint64), dtype=np.uint64)
    inverse = np.cumprod(np.full(count, pow(_ROLL, -1, 1 << 64), np.uint64), dtype=np.uint64)
    rolled = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)])
    h = (rolled[last + 1] - rolled[first]) * inverse[first]
    return lines, places, first, last, h.view(np.int64)


def chunks(text):
    """(first line, lines, hash, whether it is long enough) of the chunks that a text's lines are cut into.

    What is removed does not depend on these cuts but on `windows`.
    """
    lines = text.split("\n")
    sizes = [len(line.split()) for line in lines]
    hashes = [xxhash.xxh3_64_intdigest(line) for line in lines]
    out, first, before = [], 0, 0

    def close(end):
        nonlocal first
        if end > first:
            worded = sum(n > 0 for n in sizes[first:end])
            words = sum(sizes[first:end])
            whole = "\n".join(lines[first:end])
            usable = words >= LONG_WORDS and worded == 1 or worded >= LEAST_LINES and words >= LEAST_WORDS
            out.append((first, end - first, xxhash.xxh3_64_intdigest(whole) - (1 << 63), usable))
            first = end

    for i, (size, line) in enumerate(zip(sizes, hashes)):
        if size >= LONG_WORDS:
            close(i)
            close(i + 1)
        else:
            rolled = (before * _ROLL + line) & _MASK
            ends = (rolled >> 32) % SPACING == 0 and i + 1 - first >= LEAST_LINES
            if ends or i + 1 - first >= MOST_LINES:
                close(i + 1)
        before = line
    close(len(lines))
    return out


def _keyed(df, id_col, text_col):
    return df.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.lit(1), id_col, text_col).alias("k1"),
        F.xxhash64(F.lit(2), text_col, id_col).alias("k2"),
    )


def _chunk_rows(keyed):
    """(id, k1, k2, first, last, h) of each chunk that may be removed, places as line numbers."""

    def run(batches):
        for batch in batches:
            at, parts = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                if text:
                    _, places, first, last, h = windows(text)
                    at.append(np.full(len(h), i))
                    parts.append((places[first], places[last], h))
            none = (np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.int64))
            first, last, h = (np.concatenate(column) for column in zip(none, *parts))
            at = pa.array(np.concatenate([np.empty(0, np.int64), *at]))
            taken = [batch.column(k).take(at) for k in (0, 2, 3)]
            yield pa.RecordBatch.from_arrays(
                [*taken, pa.array(first), pa.array(last), pa.array(h)], names=["id", "k1", "k2", "first", "last", "h"]
            )

    kind = keyed.schema["id"].dataType.simpleString()
    return keyed.mapInArrow(run, f"id {kind}, k1 long, k2 long, first int, last int, h long")


def _chunk_texts(keyed):
    """(h, chunk) of the chunks of `keyed` (text, wanted: hashes) that are wanted."""

    def run(batches):
        for batch in batches:
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines, _, first, last, h = windows(text)
                at = np.flatnonzero(np.isin(h, wanted))
                out = ["\n".join(lines[first[i] : last[i] + 1]) for i in at]
                yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(out, pa.string())], names=["h", "chunk"])

    return keyed.select("text", "wanted").mapInArrow(run, "h long, chunk string")


def repeated_chunks(documents, id_col="doc_id", text_col="text"):
    """(k1, k2, gone): the (first, last) lines of what is to be removed from a document.

    `k1` and `k2` are a key of a row's id and text.
    """
    keyed = _keyed(documents, id_col, text_col)
    rows = stored(_chunk_rows(keyed), "chunks")
    # Rows that repeat id and text are counted too; their chunks have one place.
    often = folded(rows, "h", F.count("*").alias("n")).filter("n > 1").select("h")
    often = stored(rows.join(often, "h"), "repeats")
    wanted = folded(often, ["k1", "k2"], F.collect_set("h").alias("wanted"))
    # A merge join at every size: what it needs on disk grows as the texts do.
    wanted = keyed.join(stored(wanted, "wanted").hint("merge"), ["k1", "k2"])
    # Equal bytes: the smallest and the largest text of a hash are the same.
    same = folded(_chunk_texts(wanted), "h", F.min("chunk").alias("a"), F.max("chunk").alias("b"))
    same = same.filter("a = b").select("h")
    place = F.struct("id", "k1", "k2", "first", "last")
    keepers = folded(often.join(same, "h"), "h", F.min(place).alias("kept"))
    gone = often.join(keepers, "h").filter(~place.eqNullSafe(F.col("kept")))
    here = F.col("kept.id").eqNullSafe(F.col("id")) & (F.col("kept.k1") == F.col("k1")) & (F.col("kept.k2") == F.col("k2"))
    begin = F.when(here, F.greatest("first", F.col("kept.last") + 1)).otherwise(F.col("first"))
    return folded(gone, ["k1", "k2"], F.collect_set(F.struct(begin.alias("first"), "last")).alias("gone"))


def deduplicated(documents, id_col="doc_id", text_col="text", drop_empty=True):
    """`documents` without repeated chunks, all columns kept; `n_chars` is counted anew if there is one.

    With `drop_empty` documents go that had words and keep none.
    """
    return _cleaned(documents, id_col, text_col, drop_empty).drop("_chunks_removed")


def _cleaned(documents, id_col, text_col, drop_empty):
    gone = stored(repeated_chunks(documents, id_col, text_col), "gone").select(
        F.col("k1").alias("_chunks_k1"), F.col("k2").alias("_chunks_k2"), F.col("gone").alias("_chunks_gone")
    )
    keyed = documents.withColumns(
        {
            "_chunks_k1": F.xxhash64(F.lit(1), id_col, text_col),
            "_chunks_k2": F.xxhash64(F.lit(2), text_col, id_col),
        }
    )
    joined = keyed.join(gone.hint("merge"), ["_chunks_k1", "_chunks_k2"], "left").select(*documents.columns, "_chunks_gone")
    at, last = documents.columns.index(text_col), len(documents.columns)
    counted = documents.columns.index("n_chars") if "n_chars" in documents.columns else None
    schema = T.StructType([*documents.schema.fields, T.StructField("_chunks_removed", T.IntegerType())])

    def run(batches):
        for batch in batches:
            texts, removed, keep = batch.column(at).to_pylist(), [], []
            plan = batch.column(last).to_pylist()
            for i, spans in enumerate(plan):
                out = 0
                if spans:
                    lines = texts[i].split("\n")
                    lost = {k for span in spans for k in range(span["first"], span["last"] + 1)}
                    blank = []
                    for k, line in enumerate(lines):
                        if not line.split():
                            blank.append(k)
                        else:
                            if k in lost and blank and blank[0] - 1 in lost:
                                lost.update(blank)
                            blank = []
                    lines, out = [line for k, line in enumerate(lines) if k not in lost], len(lost)
                    had = bool(texts[i].strip())
                    texts[i] = "\n".join(lines)
                    keep.append(not (drop_empty and had and not texts[i].strip()))
                else:
                    keep.append(True)
                removed.append(out)
            columns = [batch.column(k) for k in range(last)]
            columns[at] = pa.array(texts, batch.column(at).type)
            if counted is not None:
                touched = np.array(removed) > 0
                sizes = pa.array([len(t) if t else 0 for t in texts], batch.column(counted).type)
                columns[counted] = pc.if_else(pa.array(touched), sizes, batch.column(counted))
            columns.append(pa.array(removed, pa.int32()))
            names = [*batch.schema.names[:last], "_chunks_removed"]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(run, schema)


@query("op2_line_chunks")
def op2_line_chunks(spark, sf_dir):
    """All documents after repeated chunks are removed."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _cleaned(documents, "doc_id", "text", False).select(
        "doc_id",
        F.col("_chunks_removed").cast("long").alias("n_removed_lines"),
        F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars_kept"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )
