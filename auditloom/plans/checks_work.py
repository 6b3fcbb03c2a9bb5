"""Checked queries: whole jobs over stored tables."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.plans import jobs as plans
from auditloom.plans import standins as S
from auditloom.plans.checks_streams import catalogue, scorer
from auditloom.plans.checks_tables import sign, stored_results
from auditloom.plans.registry import query
from auditloom.session import shared_dir
from auditloom.sources import tables

TASKS = f"""
with t as (select {S.uri_sql('o_orderkey')} as gcs_uri, o_orderkey as k from orders),
v as (select 'v1' as prompt_version_id union all select 'v2' as prompt_version_id),
sound as (select *, 0.25 * length(gcs_uri) as weight, split_part(gcs_uri, '/', 3) as bucket, split_part(gcs_uri, '/', 4) as folder
  from t cross join v where k % 10 <> 7)
"""


@query(
    "work_results",
    TASKS
    + f"""
    , rows as (select *, 'Paper' as class, 'Boxes' as material from sound
      union all select *, 'Class' as class, 'Paper' as material from sound),
    named as (select *, 'gs://' || bucket || '-thumbnails/thumbnails/' || folder || '/img' || k || '_thumb.webp' as thumb from rows)
    select 'img' || k as image_id, 'model ' || prompt_version_id as model_name, prompt_version_id,
      timestamp '{S.NOW}' as processing_timestamp,
      '{{"Paper":{{"Boxes":0.25}},"TotalWeightLbs":' || length(gcs_uri) || '}}' as model_result,
      class, material, 0.25::double as estimated_percentage, weight::double as scaled_weight, gcs_uri,
      thumb as gcs_thumb_uri, 'https://signed.example/' || substr(gcs_uri, 6) as raw_signed_url,
      'https://signed.example/' || substr(thumb, 6) as thumb_signed_url
    from named""",
)
def work_results(spark, sf_dir):
    """All columns of the result table after a job of many tasks, run twice under one name."""
    orders = S.table(spark, sf_dir, "orders").select(F.expr(S.uri_sql("o_orderkey")).alias("gcs_uri"))
    versions = F.explode(F.array(F.lit("v1"), F.lit("v2"))).alias("prompt_version_id")
    tasks = orders.select("gcs_uri", versions, F.lit(1).alias("attempt"))
    jobs_path, results, errors = (shared_dir(spark, name) for name in ("jobs", "results", "errors"))
    for _ in range(2):
        plans.work(
            spark, tasks, catalogue(spark), scorer, jobs_path, results, errors, S.now(), run="first",
            fetch=lambda uri: uri.encode(), sign=sign,
        )
    return tables.read_results(spark, results)


FIRST, LATER = "1996-06-01 00:00:00", "1996-06-08 00:00:00"


@query(
    "refresh_due",
    S.with_views(
        "results",
        f"""
        , i as (select image_id, max(processing_timestamp) as made, count(*) as table_rows,
            count(*) filter (image_id in (select r.image_id from results r
              where r.image_id <> '' and regexp_matches(r.gcs_uri, '^gs://[^/]+/.+'))) as usable
          from results where image_id is not null group by image_id),
        due as (
          select 1 as round, * from i where made + interval 5 day <= timestamp '{FIRST}'
          union all
          select 3 as round, * from i where made + interval 5 day <= timestamp '{LATER}')
        select round, image_id, (select cast(sum(usable) as bigint) from due d where d.round = due.round) as rows_updated
        from due""",
    ),
)
def refresh_due(spark, sf_dir):
    """Due images and updated rows of three refreshes: one, one right after it, and one a week later."""
    path, signed, check = stored_results(spark, sf_dir), shared_dir(spark, "signed"), shared_dir(spark, "check")
    thumbs, found = S.view(spark, sf_dir, "thumbs"), []
    for number, moment in enumerate((FIRST, FIRST, LATER), 1):
        now = F.lit(moment).cast("timestamp")
        due, updated = plans.refresh_due(spark, path, signed, check, thumbs, sign, now)
        row = due.select(F.lit(number).alias("round"), "image_id", F.lit(updated).cast("bigint").alias("rows_updated"))
        found.append(row)
    return found[0].union(found[1]).union(found[2])


@query(
    "work_errors",
    TASKS
    + f"""
    select 'img' || k as image_id, 'model ' || prompt_version_id as model_name, prompt_version_id,
      timestamp '{S.NOW}' as error_timestamp, 'model is down' as error_message, gcs_uri
    from t cross join v where k % 10 = 7""",
)
def work_errors(spark, sf_dir):
    """The error table after tasks of which some fail, worked twice under one name."""
    orders = S.table(spark, sf_dir, "orders").select(F.expr(S.uri_sql("o_orderkey")).alias("gcs_uri"))
    versions = F.explode(F.array(F.lit("v1"), F.lit("v2"))).alias("prompt_version_id")
    tasks = orders.select("gcs_uri", versions, F.lit(1).alias("attempt"))
    results, errors = shared_dir(spark, "results"), shared_dir(spark, "errors")
    for _ in range(2):
        plans.process(
            spark, tasks, catalogue(spark), scorer, results, errors, S.now(), run="first", fetch=lambda uri: uri.encode()
        )
    return tables.read_errors(spark, errors).select(*[c.split()[0] for c in fixed.ERROR_SCHEMA.split(", ")])
