"""Table changes expressed as joins; `sources.tables` publishes the outcome."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditloom import fixed
from auditloom.functions import objects
from auditloom.operators.events import with_model_name
from auditloom.operators.joins import folded, unique


def stale_deletes(deletes, inventory):
    """Deletes that a newer live object of the same URI makes obsolete.

    The listing is reduced to its newest generation per URI; an event without
    a generation is never stale.
    """
    live = folded(inventory, "gcs_uri", F.max("generation").alias("live_generation"))
    newer = F.col("live_generation") > F.col("generation")
    return deletes.join(live, "gcs_uri", "inner").where(newer).drop("live_generation")


def fresh_deletes(deletes, inventory):
    """The other deletes."""
    live = folded(inventory, "gcs_uri", F.max("generation").alias("live_generation"))
    stale = F.coalesce(F.col("live_generation") > F.col("generation"), F.lit(False))
    return deletes.join(live, "gcs_uri", "left").where(~stale).drop("live_generation")


def delete_superseded(results, decisions):
    """Results without the rows of (object, version) pairs being replaced."""
    keys = ["gcs_uri", "prompt_version_id"]
    return results.join(unique(decisions.where("delete_superseded_rows"), keys), keys, "left_anti")


def delete_object(results, uris):
    """Results without any row of the given objects."""
    return results.join(unique(uris, "gcs_uri"), "gcs_uri", "left_anti")


def inline_updates(df, array_col):
    """An array-of-struct column as rows."""
    return df.select(F.inline(array_col))


URL_COLUMNS = ("raw_signed_url", "thumb_signed_url", "gcs_thumb_uri")


def merge_urls(results, updates, key="image_id"):
    """Results with new URL columns where the key (one column or a list) is in `updates`.

    A matched row takes the new value even when that is '' or NULL. Updates
    are unique by key, so a hot key only multiplies on the result side, which
    AQE splits.
    """
    keys = [key] if isinstance(key, str) else key
    new = updates.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in URL_COLUMNS]
    )
    joined = results.join(new, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
            if c in URL_COLUMNS
            else F.col(c)
            for c in results.columns
        ]
    )


def change_counts(results, gone_uris, updates, key="image_id"):
    """How many rows a delete by object and a URL merge would touch."""
    gone = unique(gone_uris, "gcs_uri").withColumn("_gone", F.lit(True))
    hit = unique(updates, key).withColumn("_hit", F.lit(True))
    # The keys are nearly unique, so grouping first would shuffle all and save nothing.
    return (
        results.select("gcs_uri", key)
        .join(gone, "gcs_uri", "left")
        .join(hit, key, "left")
        .agg(
            F.count(F.when(F.col("_gone"), 1)).alias("rows_deleted"),
            F.count(F.when(F.col("_gone").isNull() & F.col("_hit"), 1)).alias("rows_updated"),
        )
    )


def evolve(df, schema):
    """Add the columns of a DDL schema that are missing, as NULLs."""
    want = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    have = {c.lower() for c in df.columns}
    return df.select(
        "*",
        *[
            F.lit(None).cast(f.dataType).alias(f.name)
            for f in want.fields
            if f.name.lower() not in have
        ],
    )


def error_rows(failed, models, now):
    """Error-table rows of failed attempts; the model is looked up per version."""
    return with_model_name(failed, models).select(
        objects.image_id(F.col("gcs_uri")).alias("image_id"),
        "model_name",
        "prompt_version_id",
        now.alias("error_timestamp"),
        "error_message",
        "gcs_uri",
    )


def result_rows(rows, models, now, payload="model_result"):
    """Material rows with the metadata columns of the result table."""
    named = evolve(with_model_name(rows, models), fixed.RESULT_SCHEMA.replace("model_result", payload))
    meta = {
        "image_id": objects.image_id(F.col("gcs_uri")),
        "processing_timestamp": now,
    }
    order = [c.split()[0] for c in fixed.RESULT_SCHEMA.replace("model_result", payload).split(", ")]
    return named.select(*[meta.get(c, F.col(c)).alias(c) for c in order])
