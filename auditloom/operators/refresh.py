"""URL refresh: which images are due and what they get."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions import objects
from auditloom.operators.joins import unique


def active_records(results):
    """One row per (image_id, gcs_uri) with its greatest thumbnail URI.

    Rows without ids, with empty ids, or whose URI has no bucket or object are
    left out. The filter sits on the three scanned columns.
    """
    usable = (F.col("image_id") != "") & objects.names_object(F.col("gcs_uri"))
    return (
        results.where(usable)
        .groupBy("image_id", "gcs_uri")
        .agg(F.max("gcs_thumb_uri").alias("gcs_thumb_uri"))
    )


def first_per_image(active):
    """The row of each image with the smallest URI.

    A minimum instead of a ranked window: an image id shared by very many
    objects is reduced on the map side.
    """
    return (
        active.groupBy("image_id")
        .agg(F.min(F.struct("gcs_uri", "gcs_thumb_uri")).alias("first"))
        .select("image_id", "first.gcs_uri", "first.gcs_thumb_uri")
    )


def with_thumb_location(active):
    """Add the expected thumbnail as `thumb_uri`."""
    bucket, _ = objects.split_uri(F.col("gcs_uri"))
    thumb_bucket, thumb_name = objects.thumb_location(
        bucket, F.col("image_id"), F.col("gcs_thumb_uri")
    )
    return active.withColumn("thumb_uri", objects.object_uri(thumb_bucket, thumb_name))


def thumb_backlog(active, thumbs):
    """Images whose expected thumbnail is not in the listing."""
    return with_thumb_location(active).join(
        unique(thumbs, "thumb_uri"), "thumb_uri", "left_anti"
    )


def url_payload(active, thumbs, sign):
    """Update rows: fresh URLs, with the raw URL standing in for a missing thumbnail.

    `thumbs` lists existing thumbnails by `thumb_uri`; `sign` makes a URL
    column from a URI column.
    """
    listed = unique(thumbs, "thumb_uri").withColumn("_exists", F.lit(True))
    exists = F.coalesce("_exists", F.lit(False))
    raw = sign(F.col("gcs_uri"))
    return (
        with_thumb_location(active)
        .join(listed, "thumb_uri", "left")
        .select(
            "image_id",
            raw.alias("raw_signed_url"),
            F.when(exists, sign(F.col("thumb_uri"))).otherwise(raw).alias("thumb_signed_url"),
            F.when(exists, F.col("thumb_uri"))
            .otherwise(F.coalesce("gcs_thumb_uri", F.lit("")))
            .alias("gcs_thumb_uri"),
        )
    )


def rows_of_due_images(results, now, slack="2 days"):
    """All rows of the images that have a row due, so that each image keeps its first row."""
    return results.join(unique(urls_due(results, now, slack), "image_id"), "image_id", "left_semi")


def urls_due(results, now, slack="2 days"):
    """Rows whose URLs expire within `slack`."""
    # The bound is a constant, so it reaches the scan as a pushed filter.
    bound = now + F.expr(f"interval {slack}") - F.expr(f"interval {fixed.URL_LIFETIME}")
    return results.where(F.col("processing_timestamp") <= bound)
