"""Model response text: finding, parsing and classifying its JSON."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions.objects import strip


def extract_json(text):
    """JSON part of free text, or NULL.

    The first closed ```json fence wins, even when it is empty. Otherwise the
    text from the first `{` to the last `}` is taken ('' when they are crossed).
    """
    opened = F.instr(text, fixed.FENCE_OPEN)
    after = F.substr(text, opened + len(fixed.FENCE_OPEN))
    closed = F.instr(after, fixed.FENCE_CLOSE)
    braces = F.when(
        text.contains("{") & text.contains("}"),
        F.regexp_extract(text, r"(?s)\{.*\}", 0),
    )
    return F.when(
        (opened > 0) & (closed > 0), strip(F.substr(after, F.lit(1), closed - 1))
    ).otherwise(braces)


def as_object(variant):
    """A variant object as map<string, variant>; NULL for anything else."""
    return variant.try_cast("map<string,variant>")


def kind(variant):
    return F.schema_of_variant(variant)


def is_number_kind(name):
    """Numbers and booleans, as the two are one family in the response format."""
    return F.coalesce(
        name.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | name.startswith("DECIMAL"),
        F.lit(False),
    )


def failure_reason(text, extracted, parsed, root):
    """Why a response cannot be used; NULL when it can.

    `root` is the parsed document as a map, NULL when it is not an object.
    """
    scalar = F.coalesce(parsed.try_cast("string"), F.lit(""))
    return (
        F.when(text.isNull() | (text == ""), "empty_response")
        .when(extracted.isNull() | (extracted == ""), "no_json")
        .when(parsed.isNull(), "invalid_json")
        .when(root.isNotNull(), F.when(F.size(root) == 0, "empty_result"))
        .when(scalar.isin("", "[]", "0", "0.0", "false"), "empty_result")
        .otherwise("not_an_object")
    )
