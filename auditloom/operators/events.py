"""Event validation, filtering and fan-out."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions import objects
from auditloom.operators.joins import folded
from auditloom.operators.once import computed


def validate_events(df):
    """Add `reason`, `uri` and a parsed `generation` to scanned events.

    Input is the output of `read_object_events`: the fields as text plus the
    JSON type each one had. `reason` is NULL for valid events.
    """
    bucket, name, generation = F.col("bucket"), F.col("name"), F.col("generation")
    unset = generation.isNull() | (F.col("generation_type") == "VOID") | (
        (F.col("generation_type") == "STRING") & objects.is_blank(generation)
    )
    parsed = F.when(
        F.col("generation_type").isin("STRING", "BIGINT"), objects.parse_generation(generation)
    )
    text = F.lit("STRING")
    reason = (
        F.when(~F.coalesce(F.col("is_object"), F.lit(False)), "not_an_object")
        .when(~F.col("bucket_type").eqNullSafe(text) | ~objects.valid_bucket(bucket), "bad_bucket")
        .when(~F.col("name_type").eqNullSafe(text) | ~objects.valid_name(name), "bad_name")
        .when(~unset & parsed.isNull(), "bad_generation")
    )
    checked = df.withColumn("reason", reason).withColumn("generation", parsed)
    checked = computed(checked.drop("is_object", "bucket_type", "name_type", "generation_type"), "reason", "generation")
    return checked.withColumn("gcs_uri", F.when(F.col("reason").isNull(), objects.object_uri(bucket, name)))


def quarantine(df, reason_col="reason"):
    """(good, bad) halves of a frame that carries a reason column.

    Both halves re-read `df`; persist it first where it is costly to make.
    """
    return (
        df.where(F.col(reason_col).isNull()).drop(reason_col),
        df.where(F.col(reason_col).isNotNull()),
    )


def supported_images(df, name_col="name"):
    return df.where(objects.is_supported_image(F.col(name_col)))


def validate_tasks(df):
    """Tasks that name both the object and the version."""
    return df.where("gcs_uri is not null and prompt_version_id is not null")


def version_list(versions):
    """The configured version ids as one sorted array, a scalar subquery.

    The catalogue is configuration, so it fits one value whatever the events are.
    """
    ids = versions.select("prompt_version_id").where("prompt_version_id is not null").distinct()
    return ids.agg(F.array_sort(F.collect_list("prompt_version_id"))).scalar()


def fan_out(events, versions):
    """Every event once per configured version, without a join.

    Events are multiplied in place and are never shuffled.
    """
    return events.withColumn("prompt_version_id", F.explode(version_list(versions)))


def with_model_name(df, models):
    """Model name of each row's version, `unknown` where it is not configured.

    Of a repeated version the last row counts where the rows have an order (`ord`).
    """
    name = F.max_by("model_name", "ord") if "ord" in models.columns else F.max("model_name")
    names = folded(models, "prompt_version_id", name.alias("model_name"))
    return df.join(names, "prompt_version_id", "left").withColumn(
        "model_name", F.coalesce("model_name", F.lit(fixed.UNKNOWN_MODEL))
    )


def missing_versions(tasks, models):
    """Tasks whose version is not configured."""
    return tasks.join(models.select("prompt_version_id"), "prompt_version_id", "left_anti")


def latest_generation(events):
    """The newest generation of each object; older arrivals are dropped.

    A plain maximum, so a hot object is reduced before it is shuffled.
    """
    newest = F.struct(F.col("generation"), F.col("event_id"))
    return (
        events.where("generation is not null")
        .groupBy("gcs_uri")
        .agg(F.max(newest).alias("n"))
        .select("gcs_uri", "n.generation", "n.event_id")
    )
