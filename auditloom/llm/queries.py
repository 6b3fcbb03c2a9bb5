"""All queries of this subpackage."""

from auditloom.llm import (  # noqa: F401
    byte_pairs,
    chat_format,
    collocations,
    decontaminate,
    hard_negatives,
    language_evidence,
    line_chunks,
    near_duplicates,
    quality_model,
    quality_rules,
    sentence_pieces,
    token_counts,
    toxicity,
)
from auditloom.llm.common import ORACLES, QUERIES  # noqa: F401
