"""Checked queries: table changes and the URL refresh."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditloom import fixed
from auditloom.operators import mutate, refresh
from auditloom.plans import checks_jobs
from auditloom.plans import standins as S
from auditloom.plans.registry import query
from auditloom.session import shared_dir
from auditloom.sources import tables

ROW = ["row_id", "line_no", "prompt_version_id", "gcs_uri"]


@query(
    "stale_deletes",
    S.with_views(
        "object_events inventory",
        """select event_id from object_events e where kind = 'delete' and exists
           (select 1 from inventory i where i.gcs_uri = e.gcs_uri and i.generation > e.generation)""",
    ),
)
def stale_deletes(spark, sf_dir):
    deletes = S.delete_events(spark, sf_dir)
    return mutate.stale_deletes(deletes, S.view(spark, sf_dir, "inventory")).select("event_id")


@query(
    "fresh_deletes",
    S.with_views(
        "object_events inventory",
        """select event_id from object_events e where kind = 'delete' and not exists
           (select 1 from inventory i where i.gcs_uri = e.gcs_uri and i.generation > e.generation)""",
    ),
)
def fresh_deletes(spark, sf_dir):
    deletes = S.delete_events(spark, sf_dir)
    return mutate.fresh_deletes(deletes, S.view(spark, sf_dir, "inventory")).select("event_id")


@query(
    "delete_superseded",
    S.with_views(
        checks_jobs.VIEWS + " results",
        checks_jobs.ALL_EVENTS
        + """
        select row_id, line_no, prompt_version_id, gcs_uri from results r where not exists
          (select 1 from decided d where d.delete_superseded_rows and d.gcs_uri = r.gcs_uri
             and d.prompt_version_id = r.prompt_version_id)""",
    ),
)
def delete_superseded(spark, sf_dir):
    rows = S.view(spark, sf_dir, "results")
    return mutate.delete_superseded(rows, checks_jobs.decisions(spark, sf_dir)).select(*ROW)


@query(
    "delete_object",
    S.with_views(
        checks_jobs.PLAN_VIEWS + " results",
        checks_jobs.PLAN
        + f"""select row_id, line_no, prompt_version_id, gcs_uri from results
              where gcs_uri is null or gcs_uri not in {checks_jobs.GONE}""",
    ),
)
def delete_object(spark, sf_dir):
    gone = checks_jobs.plan(spark, sf_dir).where(F.col("action") == fixed.ACTION_DELETE)
    return mutate.delete_object(S.view(spark, sf_dir, "results"), gone).select(*ROW)


@query(
    "merge_urls",
    S.with_views(
        "results updates",
        """
        select row_id, line_no, r.image_id,
          case when u.image_id is null then r.raw_signed_url else u.raw_signed_url end as raw_signed_url,
          case when u.image_id is null then r.thumb_signed_url else u.thumb_signed_url end as thumb_signed_url,
          case when u.image_id is null then r.gcs_thumb_uri else u.gcs_thumb_uri end as gcs_thumb_uri
        from results r left join updates u on u.image_id = r.image_id""",
    ),
)
def merge_urls(spark, sf_dir):
    merged = mutate.merge_urls(S.view(spark, sf_dir, "results"), S.view(spark, sf_dir, "updates"))
    return merged.select("row_id", "line_no", "image_id", *mutate.URL_COLUMNS)


@query(
    "inline_updates",
    S.with_views("all_updates", "select * from all_updates"),
)
def inline_updates(spark, sf_dir):
    """Updates arriving as arrays of structs, a thousand ids to an array."""
    row = F.struct("image_id", *mutate.URL_COLUMNS)
    updates = S.view(spark, sf_dir, "all_updates")
    block = F.expr("cast(substr(image_id, 4) as bigint) div 1000")
    packed = updates.groupBy(block.alias("block")).agg(F.collect_list(row).alias("updates"))
    return mutate.inline_updates(packed, "updates")


@query(
    "dml_counts",
    S.with_views(
        checks_jobs.PLAN_VIEWS + " results updates",
        checks_jobs.PLAN
        + f"""
        , m as (select coalesce(r.gcs_uri in {checks_jobs.GONE}, false) as gone,
            coalesce(r.image_id in (select image_id from updates), false) as hit from results r)
        select cast(sum(case when gone then 1 else 0 end) as bigint) as rows_deleted,
          cast(sum(case when not gone and hit then 1 else 0 end) as bigint) as rows_updated from m""",
    ),
)
def dml_counts(spark, sf_dir):
    gone = checks_jobs.plan(spark, sf_dir).where(F.col("action") == fixed.ACTION_DELETE)
    return mutate.change_counts(
        S.view(spark, sf_dir, "results"), gone, S.view(spark, sf_dir, "updates")
    )


@query(
    "schema_evolve",
    S.with_views(
        "results",
        """select row_id, line_no, image_id, cast(null as varchar) as class, cast(null as double) as scaled_weight
           from results""",
    ),
)
def schema_evolve(spark, sf_dir):
    rows = S.view(spark, sf_dir, "results").select("row_id", "line_no", "image_id")
    return mutate.evolve(rows, "image_id string, class string, scaled_weight double")


def stored_results(spark, sf_dir):
    """The stand-in results written as a table in the shared folder."""
    path = shared_dir(spark, "results")
    rows = S.view(spark, sf_dir, "results").withColumn("material", F.col("line_no").cast("string"))
    declared = StructType.fromDDL(fixed.RESULT_SCHEMA).fields
    whole = mutate.evolve(rows, fixed.RESULT_SCHEMA)
    tables.write_results(whole.select(*[F.col(f.name).cast(f.dataType) for f in declared]), path)
    return path


@query(
    "table_changes",
    S.with_views(
        checks_jobs.PLAN_VIEWS + " results updates",
        checks_jobs.PLAN
        + f"""
        , kept as (select * from results where gcs_uri is null or gcs_uri not in {checks_jobs.GONE}),
        m as (select k.prompt_version_id, u.image_id is not null as hit,
          case when u.image_id is null then k.raw_signed_url else u.raw_signed_url end as url
          from kept k left join updates u on u.image_id = k.image_id)
        select prompt_version_id, count(*) as table_rows,
          cast(sum(case when url like 'https://new%' then 1 else 0 end) as bigint) as new_urls,
          (select count(*) from results) - (select count(*) from kept) as rows_deleted,
          (select count(*) from m where hit) as rows_updated
        from m group by prompt_version_id""",
    ),
)
def table_changes(spark, sf_dir):
    """Append, delete and merge on a stored table, then read it back."""
    path = stored_results(spark, sf_dir)
    gone = checks_jobs.plan(spark, sf_dir).where(F.col("action") == fixed.ACTION_DELETE)
    deleted = tables.apply_delete(spark, path, uris=gone)
    updated = tables.apply_merge(spark, path, S.view(spark, sf_dir, "updates"))
    new = F.col("raw_signed_url").startswith("https://new")
    return (
        tables.read_results(spark, path)
        .groupBy("prompt_version_id")
        .agg(F.count("*").alias("table_rows"), F.count_if(new).alias("new_urls"))
        .withColumn("rows_deleted", F.lit(deleted).cast("bigint"))
        .withColumn("rows_updated", F.lit(updated).cast("bigint"))
    )


@query(
    "error_rows",
    """
    with e as (select event_id, user_id, case when event_id % 3 = 0 then 'v' || (event_id % 30) else 'v1' end as v
      from events where event_type = 'error')
    select event_id, 'img' || user_id as image_id, coalesce(m.model_name, 'unknown') as model_name,
      e.v as prompt_version_id, 'failed ' || event_id as error_message, 'gs://audit/img' || user_id || '.jpg' as gcs_uri
    from e left join (select 'v' || n_nationkey as v, lower(n_name) as model_name from nation
      where n_regionkey <> 1) m on m.v = e.v""",
)
def error_rows(spark, sf_dir):
    """Error rows appended to a stored table and read back."""
    failed = (
        S.table(spark, sf_dir, "events")
        .where("event_type = 'error'")
        .selectExpr(
            "'gs://audit/img' || user_id || '.jpg' as gcs_uri",
            "case when event_id % 3 = 0 then 'v' || (event_id % 30) else 'v1' end as prompt_version_id",
            "'failed ' || event_id as error_message",
        )
    )
    path = shared_dir(spark, "errors")
    tables.write_errors(mutate.error_rows(failed, S.view(spark, sf_dir, "catalogue"), S.now()), path)
    return tables.read_errors(spark, path).select(
        F.substring_index("error_message", " ", -1).cast("bigint").alias("event_id"),
        "image_id", "model_name", "prompt_version_id", "error_message", "gcs_uri",
    )


ACTIVE = r"""
, a as (select image_id, gcs_uri, max(gcs_thumb_uri) as gcs_thumb_uri from results
  where image_id <> '' and regexp_matches(gcs_uri, '^gs://[^/]+/.+') group by image_id, gcs_uri),
f as (select image_id, gcs_uri, gcs_thumb_uri from
  (select *, row_number() over (partition by image_id order by gcs_uri) as rn from a) t where rn = 1),
loc as (select *, case when gcs_thumb_uri like 'gs://thumbs/_%' then gcs_thumb_uri
  else 'gs://' || split_part(gcs_uri, '/', 3) || '-thumbnails/thumbnails/' || image_id || '_thumb.webp' end as thumb_uri
  from f)
"""


@query("active_records", S.with_views("results", ACTIVE + "select * from a"))
def active_records(spark, sf_dir):
    return refresh.active_records(S.view(spark, sf_dir, "results"))


def first(spark, sf_dir):
    return refresh.first_per_image(refresh.active_records(S.view(spark, sf_dir, "results")))


@query("first_per_image", S.with_views("results", ACTIVE + "select * from f"))
def first_per_image(spark, sf_dir):
    return first(spark, sf_dir)


@query(
    "thumb_backlog",
    S.with_views(
        "results thumbs",
        ACTIVE
        + "select image_id, gcs_uri, thumb_uri from loc where thumb_uri not in (select thumb_uri from thumbs)",
    ),
)
def thumb_backlog(spark, sf_dir):
    thumbs = S.view(spark, sf_dir, "thumbs")
    return refresh.thumb_backlog(first(spark, sf_dir), thumbs).select("image_id", "gcs_uri", "thumb_uri")


def sign(uri):
    return F.concat(F.lit("https://signed.example/"), F.substr(uri, F.lit(6)))


@query(
    "url_payload",
    S.with_views(
        "results thumbs",
        ACTIVE
        + """
        , x as (select *, thumb_uri in (select thumb_uri from thumbs) as has from loc)
        select image_id, 'https://signed.example/' || substr(gcs_uri, 6) as raw_signed_url,
          'https://signed.example/' || substr(case when has then thumb_uri else gcs_uri end, 6) as thumb_signed_url,
          case when has then thumb_uri else coalesce(gcs_thumb_uri, '') end as gcs_thumb_uri
        from x""",
    ),
)
def url_payload(spark, sf_dir):
    return refresh.url_payload(first(spark, sf_dir), S.view(spark, sf_dir, "thumbs"), sign)


@query(
    "urls_due",
    S.with_views(
        "results",
        """select row_id, line_no from results
           where processing_timestamp + interval 7 day <= timestamp '1999-06-01 00:00:00' + interval 2 day""",
    ),
)
def urls_due(spark, sf_dir):
    now = F.lit("1999-06-01 00:00:00").cast("timestamp")
    return refresh.urls_due(S.view(spark, sf_dir, "results"), now).select("row_id", "line_no")
