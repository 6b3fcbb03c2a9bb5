"""A training corpus from `documents`: five filters and an encoding, each a stage.

A stage takes (spark, docs, sf_dir) and returns a table. Each stage's table is
written as Parquet and read again as the next one's documents.
"""

from auditloom.llm import decontaminate, line_chunks, near_duplicates, quality_model, sentence_pieces
from auditloom.llm.common import ready, table
from auditloom.llm.components import stored


def quality(spark, docs, sf_dir):
    """Documents that the quality classifier accepts."""
    ready(spark)
    return quality_model.accepted(docs, quality_model.trained(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark, docs, sf_dir):
    """Documents without chunks of lines that stand elsewhere too; those of nothing else go."""
    ready(spark)
    return line_chunks.deduplicated(docs)


#: Least similarity of near duplicates, as a percentage.
NEAR_PERCENT = 80


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates."""
    ready(spark)
    return near_duplicates.without_near_duplicates(docs, NEAR_PERCENT)


def decontamination(spark, docs, sf_dir):
    """Documents in which no benchmark window occurs."""
    ready(spark)
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark, docs, sf_dir):
    """Count and digest of each document's ids, and whether they decode to it."""
    ready(spark)
    return sentence_pieces.encoded_digest(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: The classifier is fitted by boosting, which SQL does not express.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of `sf_dir`."""
    ready(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
