"""A bounded sample of labelled documents to fit a model on."""

from pyspark.sql import functions as F

from auditloom.llm.common import held_out

#: Most labelled documents that a model is fitted on.
FIT_ROWS = 20_000


def labelled_sample(documents, labels, label_col, modulus, remainder, rows=FIT_ROWS):
    """(doc_id, text, label) of at most `rows` labelled documents, one for each id.

    Rows whose id's crc32 leaves `remainder` are held out. Which ids are taken
    follows from a hash of the id, so that the sample does not depend on order.
    Of repeated labels of a document the smallest counts, of documents that share
    an id the one whose text has the smallest hash; labels other than 0 and 1 and
    null ids are left out.
    """
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col("doc_id").isNotNull())
    usable = usable.filter(~held_out(F.col("doc_id"), modulus, remainder))
    usable = usable.groupBy("doc_id").agg(F.min(label_col).cast("int").alias("label"))
    chosen = usable.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    # At most `rows` ids and labels are broadcast.
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # One text a group and task is carried, however many rows share the id.
    found = found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text"))
    return found.select("doc_id", "text", "label")
