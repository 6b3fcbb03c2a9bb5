"""Checked queries: events, names and fan-out."""

from pyspark.sql import functions as F

from auditloom.functions import objects
from auditloom.operators import events
from auditloom.plans import standins as S
from auditloom.plans.registry import query
from auditloom.sources.events import parse_events

# Event lines; most are sound, the others break one rule each.
S.SQL["event_lines"] = """
select event_id, case event_id % 24
  when 0 then '{"bucket": "a/b", "name": "x.jpg", "generation": 1}'
  when 1 then '{"bucket": "-ab", "name": "x.jpg", "generation": 1}'
  when 2 then '{"bucket": " ab ", "name": "x.jpg", "generation": 1}'
  when 3 then '{"bucket": "a b", "name": "x.jpg", "generation": 1}'
  when 4 then '{"bucket": "ab", "name": "   ", "generation": 1}'
  when 5 then '{"bucket": "ab", "name": ' || cast(event_id as string) || ', "generation": 1}'
  when 6 then '{"bucket": "ab", "name": "x.jpg", "generation": true}'
  when 7 then '{"bucket": "ab", "name": "x.jpg", "generation": 0}'
  when 8 then '{"bucket": "ab", "name": "x.jpg", "generation": "9223372036854775808"}'
  when 9 then '{"bucket": "ab", "name": "x.jpg", "generation": "abc"}'
  when 10 then '[' || cast(event_id as string) || ']'
  when 11 then 'not json ' || cast(event_id as string)
  when 12 then '{"bucket": "ab", "name": "x.jpg", "generation": "  000' || cast(event_id as string) || ' "}'
  when 13 then '{"bucket": "ab", "name": "x.jpg", "generation": " "}'
  when 14 then '{"bucket": "ab", "name": "x.jpg"}'
  when 15 then '{"bucket": "ab", "name": "x.jpg", "generation": null}'
  when 16 then '{"bucket": "", "name": "x.jpg"}'
  when 17 then '{"name": "x.jpg"}'
  when 18 then '{"bucket": "ab"}'
  when 19 then '{"bucket": "ab", "name": "x.jpg", "generation": 2.5}'
  else '{"bucket": "audit-' || cast(user_id % 3 as string) || '", "name": "img' || cast(user_id as string)
    || '.jpg", "generation": ' || cast(event_id + 1 as string) || '}' end as value
from $events"""


@query(
    "event_validation",
    """
    with v as (select event_id, user_id, event_id % 24 as k from events),
    r as (select *, case when k in (10, 11) then 'not_an_object' when k in (0, 1, 2, 3, 16, 17) then 'bad_bucket'
      when k in (4, 5, 18) then 'bad_name' when k in (6, 7, 8, 9, 19) then 'bad_generation' end as reason from v)
    select event_id, reason,
      case when reason is null then case when k >= 20
        then 'gs://audit-' || (user_id % 3) || '/img' || user_id || '.jpg' else 'gs://ab/x.jpg' end end as gcs_uri,
      case when reason is null then case when k >= 20 then event_id + 1 when k = 12 and event_id > 0 then event_id end
        when k between 0 and 5 or k in (18) then case when k = 18 then null else 1 end end as generation
    from r""",
)
def event_validation(spark, sf_dir):
    lines = S.view(spark, sf_dir, "event_lines")
    checked = events.validate_events(parse_events(lines))
    return checked.select("event_id", "reason", "gcs_uri", "generation")


@query(
    "parse_generation",
    """
    with t as (select event_id, case event_id % 7 when 0 then '  ' || event_id || ' ' when 1 then '000' || event_id
      when 2 then '-' || event_id when 3 then cast(event_id as varchar) || '.0' when 4 then ''
      when 5 then '922337203685477' || (1000 + event_id % 9000) else cast(event_id as varchar) end as g from events)
    select event_id, cast(case when regexp_matches(trim(g), '^[0-9]+$') and try_cast(trim(g) as bigint) > 0
      then try_cast(trim(g) as bigint) end as varchar) as generation from t""",
)
def parse_generation(spark, sf_dir):
    raw = S.table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(
            """case event_id % 7 when 0 then '  ' || event_id || ' ' when 1 then '000' || event_id
               when 2 then '-' || event_id when 3 then event_id || '.0' when 4 then ''
               when 5 then '922337203685477' || (1000 + event_id % 9000) else cast(event_id as string) end"""
        ).alias("g"),
    )
    return raw.select("event_id", objects.parse_generation(F.col("g")).cast("string").alias("generation"))


S.SQL["odd_names"] = """
select page_id, url || case page_id % 8 when 0 then '/a.tar.gz' when 1 then '/.hidden' when 2 then '/..x.JPG'
  when 3 then '/photo.jpeg' when 4 then '/v1.2/plain' when 5 then '/b.PNG' when 6 then '/trailing.' else '' end as name
from $pages"""


@query(
    "image_filter",
    S.with_views(
        "odd_names",
        "select page_id, name from odd_names where regexp_matches(lower(name), '\\.(jpg|jpeg|png)$')",
    ),
)
def image_filter(spark, sf_dir):
    return events.supported_images(S.view(spark, sf_dir, "odd_names"))


@query(
    "uri_split",
    S.with_views(
        "odd_names",
        """
        , u as (select page_id, case page_id % 3 when 0 then name
            when 1 then 'gs://' || regexp_replace(name, '^https?://', '')
            else 'gs://' || page_id end as uri from odd_names),
        b as (select *, regexp_replace(uri, '^gs://', '') as body from u),
        p as (select *, split_part(body, '/', 1) as bucket,
          case when contains(body, '/') then substr(body, strpos(body, '/') + 1) else '' end as object from b)
        select page_id, bucket, object,
          case when starts_with(uri, 'gs://') and bucket <> '' and object <> '' then bucket end as strict_bucket,
          case when starts_with(uri, 'gs://') and bucket <> '' and object <> '' then object end as strict_object
        from p""",
    ),
)
def uri_split(spark, sf_dir):
    uris = S.view(spark, sf_dir, "odd_names").select(
        "page_id",
        F.expr(
            """case page_id % 3 when 0 then name when 1 then 'gs://' || regexp_replace(name, '^https?://', '')
               else 'gs://' || page_id end"""
        ).alias("uri"),
    )
    bucket, name = objects.split_uri(F.col("uri"))
    strict_bucket, strict_name = objects.split_uri(F.col("uri"), strict=True)
    return uris.select(
        "page_id",
        bucket.alias("bucket"),
        name.alias("object"),
        strict_bucket.alias("strict_bucket"),
        strict_name.alias("strict_object"),
    )


@query(
    "image_id",
    S.with_views(
        "odd_names",
        r"""
        , b as (select page_id, regexp_extract(name, '([^/]*)$', 1) as base from odd_names)
        select page_id, case when regexp_matches(base, '^\.*[^.].*\.[^.]*$')
          then regexp_extract(base, '^(\.*[^.].*)\.[^.]*$', 1) else base end as image_id from b""",
    ),
)
def image_id(spark, sf_dir):
    names = S.view(spark, sf_dir, "odd_names")
    return names.select("page_id", objects.image_id(F.col("name")).alias("image_id"))


@query(
    "thumb_location",
    """
    with u as (
      select o_orderkey, 'audit-' || (o_orderkey % 3) as bucket, 'img' || o_orderkey as image,
        'site' || (o_orderkey % 10) || '/img' || o_orderkey || '.v2.jpg' as name,
        case o_orderkey % 5 when 0 then 'gs://stored/t' || o_orderkey when 1 then 'gs://bare' when 2 then ''
          when 3 then 'noscheme/t' || o_orderkey end as stored
      from orders)
    select o_orderkey,
      case when stored like '%/t%' then case when o_orderkey % 5 = 0 then 'stored' else 'noscheme' end
        else bucket || '-thumbnails' end as thumb_bucket,
      case when stored like '%/t%' then 't' || o_orderkey else 'thumbnails/' || image || '_thumb.webp' end as thumb_object,
      'gs://' || bucket || '-thumbnails/thumbnails/' || replace(name, '.jpg', '') || '_thumb.webp' as written_uri
    from u""",
)
def thumb_location(spark, sf_dir):
    orders = S.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "'audit-' || (o_orderkey % 3) as bucket",
        "'img' || o_orderkey as image",
        "'site' || (o_orderkey % 10) || '/img' || o_orderkey || '.v2.jpg' as name",
        """case o_orderkey % 5 when 0 then 'gs://stored/t' || o_orderkey when 1 then 'gs://bare' when 2 then ''
           when 3 then 'noscheme/t' || o_orderkey end as stored""",
    )
    bucket, name = objects.thumb_location(F.col("bucket"), F.col("image"), F.col("stored"))
    return orders.select(
        "o_orderkey",
        bucket.alias("thumb_bucket"),
        name.alias("thumb_object"),
        objects.written_thumb_uri(F.col("bucket"), F.col("name")).alias("written_uri"),
    )


@query(
    "job_id",
    S.with_views(
        "object_events",
        "select event_id, sha256(gcs_uri || ':' || 'v' || (event_id % 3)) as job_id from object_events",
    ),
)
def job_id(spark, sf_dir):
    version = F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string"))
    rows = S.view(spark, sf_dir, "object_events")
    return rows.select("event_id", objects.job_id(F.col("gcs_uri"), version).alias("job_id"))


@query(
    "thumb_plan",
    """
    with d as (select p_partkey, 1 + p_partkey * 37 % 4001 as w, 1 + p_partkey * 91 % 3001 as h from part),
    r as (select *, w / h as a, 200.0 * (w / h) as x, 200.0 / (w / h) as y from d),
    s as (select *,
      greatest(case when abs(a - floor(x) / 200.0) <= abs(a - ceil(x) / 200.0) then floor(x) else ceil(x) end, 1) as nw,
      greatest(case when floor(y) = 0 then 0 when abs(a - 200.0 / floor(y)) <= abs(a - 200.0 / ceil(y))
        then floor(y) else ceil(y) end, 1) as nh from r)
    select p_partkey,
      cast(case when w <= 200 and h <= 200 then w when a <= 1 then nw else 200 end as bigint) as thumb_width,
      cast(case when w <= 200 and h <= 200 then h when a <= 1 then 200 else nh end as bigint) as thumb_height
    from s""",
)
def thumb_plan(spark, sf_dir):
    sizes = S.table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "1 + p_partkey * 37 % 4001 as w", "1 + p_partkey * 91 % 3001 as h"
    )
    width, height = objects.thumb_size(F.col("w"), F.col("h"))
    return sizes.select("p_partkey", width.alias("thumb_width"), height.alias("thumb_height"))


S.SQL["catalogue"] = """
select 'v' || cast(n_nationkey as string) as prompt_version_id, lower(n_name) as model_name
from $nation where n_regionkey <> 1"""


@query(
    "fan_out",
    S.with_views(
        "object_events catalogue",
        "select event_id, prompt_version_id from object_events cross join catalogue where kind = 'finalize'",
    ),
)
def fan_out(spark, sf_dir):
    rows = S.finalize_events(spark, sf_dir).select("event_id")
    return events.fan_out(rows, S.view(spark, sf_dir, "catalogue"))


S.SQL["tasks"] = f"""
select event_id, case when event_id % 41 = 0 then null else {S.uri_sql('user_id')} end as gcs_uri,
  case when event_id % 43 = 0 then null else 'v' || cast(event_id % 30 as string) end as prompt_version_id
from $events"""


@query(
    "validate_tasks",
    S.with_views(
        "tasks", "select * from tasks where gcs_uri is not null and prompt_version_id is not null"
    ),
)
def validate_tasks(spark, sf_dir):
    return events.validate_tasks(S.view(spark, sf_dir, "tasks"))


@query(
    "model_lookup",
    S.with_views(
        "tasks catalogue",
        """select event_id, t.prompt_version_id, coalesce(model_name, 'unknown') as model_name
           from tasks t left join catalogue c on c.prompt_version_id = t.prompt_version_id""",
    ),
)
def model_lookup(spark, sf_dir):
    tasks = S.view(spark, sf_dir, "tasks").select("event_id", "prompt_version_id")
    return events.with_model_name(tasks, S.view(spark, sf_dir, "catalogue"))


@query(
    "missing_versions",
    S.with_views(
        "tasks catalogue",
        """select event_id, prompt_version_id from tasks t where not exists
           (select 1 from catalogue c where c.prompt_version_id = t.prompt_version_id)""",
    ),
)
def missing_versions(spark, sf_dir):
    tasks = S.view(spark, sf_dir, "tasks").select("event_id", "prompt_version_id")
    return events.missing_versions(tasks, S.view(spark, sf_dir, "catalogue"))


@query(
    "latest_generation",
    S.with_views(
        "object_events",
        """select gcs_uri, generation, event_id from (select *, row_number() over
             (partition by gcs_uri order by generation desc, event_id desc) as rn
           from object_events where generation is not null) t where rn = 1""",
    ),
)
def latest_generation(spark, sf_dir):
    return events.latest_generation(S.view(spark, sf_dir, "object_events"))
