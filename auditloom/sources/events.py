"""Object events as JSON lines."""

from pyspark.sql import functions as F

from auditloom.functions.text import kind
from auditloom.operators.once import computed


def parse_events(lines, value_col="value"):
    """JSON text to event fields, keeping the JSON type of each one.

    A schema on the reader would turn a number into text silently, so lines
    are parsed as variants and the types are kept for `validate_events`.
    """
    doc = F.try_parse_json(F.col(value_col))
    parsed = computed(lines.withColumn("_doc", doc), "_doc")

    def field(name):
        value = F.try_variant_get("_doc", f"$.{name}", "variant")
        return [
            F.try_variant_get("_doc", f"$.{name}", "string").alias(name),
            kind(value).alias(f"{name}_type"),
        ]

    return parsed.select(
        *[c for c in lines.columns if c != value_col],
        F.coalesce(kind(F.col("_doc")).startswith("OBJECT"), F.lit(False)).alias("is_object"),
        *field("bucket"),
        *field("name"),
        *field("generation"),
    )


def read_object_events(spark, path, kind_name="finalize", streaming=False):
    """Scan event lines; the kind of a whole folder is given by its route."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.text(path)
    return parse_events(lines).withColumn("kind", F.lit(kind_name))
