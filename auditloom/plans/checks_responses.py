"""Checked queries: responses, roll-ups and their quality."""

from pyspark.sql import functions as F

from auditloom.functions import text
from auditloom.operators import conform, quality, responses, scoring
from auditloom.operators.events import quarantine
from auditloom.plans import standins as S
from auditloom.plans.registry import query

HALF_EVEN = "cast(round_even(cast({} as decimal(18,9)), 2) as double)"

SOUND_ROWS = f"""
sound as (select * from fractions where {S.fault_sql()} is null),
audit_rows as (
  select audit_id, class, material, round(estimated_percentage, 6) as estimated_percentage,
    round(scaled_weight, 6) as scaled_weight from sound
  union all
  select audit_id, 'Class' as class, class as material,
    {HALF_EVEN.format('sum(scaled_weight) / any_value(total)')} as estimated_percentage,
    round(sum(scaled_weight), 6) as scaled_weight
  from sound group by audit_id, class)
select * from audit_rows"""

AUDIT_ORACLE = S.with_views("fractions", f",{SOUND_ROWS}")


def rounded(rows, *keys):
    return rows.select(
        *keys,
        "class",
        "material",
        F.round("estimated_percentage", 6).alias("estimated_percentage"),
        F.round("scaled_weight", 6).alias("scaled_weight"),
    )


@query("audit_flatten", AUDIT_ORACLE)
def audit_flatten(spark, sf_dir):
    return rounded(responses.flatten_with_rollup(S.responses(spark, sf_dir)), "audit_id")


@query(
    "class_rollup",
    S.with_views(
        "fractions",
        f"""
        select audit_id, 'Class' as class, class as material,
          {HALF_EVEN.format('sum(estimated_percentage)')} as estimated_percentage,
          round(sum(scaled_weight), 6) as scaled_weight
        from fractions group by audit_id, class""",
    ),
)
def class_rollup(spark, sf_dir):
    rows = S.view(spark, sf_dir, "fractions")
    return rounded(responses.class_rollup(rows, ["audit_id"]), "audit_id")


# Document text with a response of every shape around it.
WRAPPED_SQL = """
select doc_id, case doc_id % 9
  when 0 then text || '```json  {"id": ' || cast(doc_id as string) || '}  ``` end'
  when 1 then text || ' {"id": ' || cast(doc_id as string) || '} ' || lang
  when 2 then '```json``` then {"a": 1}'
  when 3 then text || '```json {"open": ' || cast(doc_id as string) || '}'
  when 4 then text || ' } then { '
  when 5 then '```json {"one": 1} ``` and ```json {"two": 2} ```' || text
  when 6 then text || ' { only'
  when 7 then ''
  else text end as response
from $documents"""
S.SQL["wrapped"] = WRAPPED_SQL


@query(
    "extract_json",
    S.with_views(
        "wrapped",
        r"""
        , cut as (
          select doc_id, response as t, strpos(response, '```json') as f,
            substr(response, strpos(response, '```json') + 7) as rest
          from wrapped)
        select doc_id, case
          when f > 0 and strpos(rest, '```') > 0
            then regexp_replace(substr(rest, 1, strpos(rest, '```') - 1), '^\s+|\s+$', '', 'g')
          when contains(t, '{') and contains(t, '}') then regexp_extract(t, '(?s)\{.*\}', 0)
          end as extracted
        from cut""",
    ),
)
def extract_json(spark, sf_dir):
    wrapped = S.view(spark, sf_dir, "wrapped")
    return wrapped.select("doc_id", text.extract_json(F.col("response")).alias("extracted"))


@query(
    "parse_reasons",
    S.with_views(
        "fractions",
        f"""
        select distinct audit_id, case {S.fault_sql()} when 'no_total' then 'ok' else
          coalesce({S.fault_sql()}, 'ok') end as reason
        from fractions""",
    ),
)
def parse_reasons(spark, sf_dir):
    scored = responses.score_rows(responses.parse_responses(S.responses(spark, sf_dir)))
    return scored.select("audit_id", F.coalesce("reason", F.lit("ok")).alias("reason"))


@query(
    "quarantine",
    S.with_views(
        "fractions",
        f"""
        select f as reason, count(*) as audits from
          (select distinct audit_id, {S.fault_sql()} as f from fractions) t
        where f is not null and f <> 'no_total' group by f""",
    ),
)
def quarantine_counts(spark, sf_dir):
    scored = responses.score_rows(responses.parse_responses(S.responses(spark, sf_dir)))
    _, bad = quarantine(scored.select("audit_id", "reason"))
    return bad.groupBy("reason").agg(F.count("*").alias("audits"))


TAXONOMY_SQL = """
select distinct p_type as class, p_brand as material, p_size as density
from $part where p_type <> 'PROMO' and p_brand not like '%3'"""
S.SQL["known_materials"] = TAXONOMY_SQL


@query(
    "off_taxonomy",
    S.with_views(
        "fractions known_materials",
        """
        select audit_id, class, material from fractions f where not exists
          (select 1 from known_materials k where k.class = f.class and k.material = f.material)""",
    ),
)
def off_taxonomy(spark, sf_dir):
    rows = S.view(spark, sf_dir, "fractions")
    known = S.view(spark, sf_dir, "known_materials")
    return quality.off_taxonomy(rows, known).select("audit_id", "class", "material")


# One class is left out, so that not every audit sums to one.
S.SQL["partial"] = S.SQL["fractions"] + """
        where g.class <> 'PROMO'"""


@query(
    "fraction_check",
    S.with_views(
        "partial",
        """
        select audit_id, round(sum(estimated_percentage), 6) as fraction_sum,
          round(abs(sum(estimated_percentage) - 1), 6) <= 0.01 as ok
        from partial group by audit_id""",
    ),
)
def fraction_check(spark, sf_dir):
    checked = quality.fraction_check(S.view(spark, sf_dir, "partial"), ["audit_id"])
    return checked.withColumn("fraction_sum", F.round("fraction_sum", 6))


@query(
    "weight_check",
    S.with_views(
        "fractions known_materials",
        """
        , d as (select material, max(density) as density from known_materials group by material)
        select audit_id, round(sum(estimated_percentage * coalesce(density, 0)), 6) as expected_weight,
          round(sum(scaled_weight), 6) as reported_weight,
          round(abs(sum(estimated_percentage * coalesce(density, 0)) - sum(scaled_weight)), 6)
            <= round(abs(sum(estimated_percentage * coalesce(density, 0))) * 0.3713, 6) as ok
        from fractions f left join d on d.material = f.material group by audit_id""",
    ),
)
def weight_check(spark, sf_dir):
    rows = S.view(spark, sf_dir, "fractions")
    known = S.view(spark, sf_dir, "known_materials")
    checked = quality.weight_check(rows, known, ["audit_id"], tolerance=0.3713)
    return checked.select(
        "audit_id",
        F.round("expected_weight", 6).alias("expected_weight"),
        F.round("reported_weight", 6).alias("reported_weight"),
        "ok",
    )


def bytes_scorer():
    """A repeatable scorer: the byte count decides the answer.

    Sizes divisible by 7 always raise, those divisible by 5 answer in prose at
    first; the others answer with one material.
    """
    told = set()

    def score(content, prompt, model, settings):
        size = len(content)
        if size % 7 == 0:
            raise ValueError(f"cannot score {size} bytes")
        if size % 5 == 0 and content not in told:
            told.add(content)
            return "I have to look again."
        told.discard(content)
        return f'{prompt} {model}\n```json\n{{"TotalWeightLbs": {size}, "Text": {{"bytes": 0.5}}}}\n```'

    return score


@query(
    "score_batch",
    """
    with d as (select doc_id, octet_length(encode(text)) as n, lang from documents)
    select doc_id, case when n = 0 then 'No content: gs://docs/' || doc_id
        when n % 7 = 0 then 'cannot score ' || n || ' bytes' end as error_message,
      cast(case when n = 0 then 0 when n % 7 = 0 then 4 when n % 5 = 0 then 2 else 1 end as bigint) as tries,
      cast(case when n % 7 <> 0 then round(n * 0.5, 6) end as double) as weight
    from d""",
)
def score_batch(spark, sf_dir):
    documents = S.table(spark, sf_dir, "documents")
    tasks = documents.select(
        "doc_id",
        F.concat(F.lit("gs://docs/"), F.col("doc_id").cast("string")).alias("gcs_uri"),
        F.encode("text", "UTF-8").alias("content"),
        F.lit("Weigh this.").alias("prompt_text"),
        F.col("lang").alias("model_name"),
    )
    scored = scoring.score(tasks, bytes_scorer)
    rows = responses.score_rows(responses.parse_responses(scored))
    weight = F.element_at(
        F.transform(F.filter("rows", lambda r: r["class"] == "Text"), lambda r: r["scaled_weight"]), 1
    )
    return rows.select(
        "doc_id",
        "error_message",
        F.col("tries").cast("bigint").alias("tries"),
        F.round(F.when(F.size("rows") > 0, weight), 6).alias("weight"),
    )


S.SQL["typed_text"] = """
select event_id,
  case event_id % 10 when 0 then 'true' when 1 then ' TRUE ' when 2 then '1' when 3 then '0'
    when 4 then 'false' when 5 then 'yes' when 6 then 't' when 7 then '2' when 8 then '' end as flag,
  case event_id % 9 when 0 then '3' when 1 then ' 42 ' when 2 then '-7' when 3 then '1.5' when 4 then 'abc'
    when 5 then '9223372036854775808' when 6 then '+5' when 7 then '1_000' end as amount,
  case event_id % 11 when 0 then '0.75' when 1 then '1e3' when 2 then 'NaN' when 3 then 'Infinity'
    when 4 then '-2.5' when 5 then 'x' when 6 then '1d' when 7 then '.5' when 8 then '0x1p3'
    when 9 then cast(event_id as string) end as ratio,
  case event_id % 8 when 0 then '2026-10-26T21:00:00Z' when 1 then '2026-10-26 21:00:00 UTC'
    when 2 then '2026-10-26 21:00:00' when 3 then 'not-a-date' when 4 then '2026' when 5 then '2026-10-26'
    when 6 then '2026-10-26T23:00:00.250+02:00' end as seen_at,
  case event_id % 4 when 0 then 1700000000.125 when 1 then 1700000000123.0
    when 2 then 1700000000123456.0 end as epoch
from $events"""

CONFORM_SCHEMA = {
    "flag": "BOOL",
    "amount": "INT64",
    "ratio": "FLOAT64",
    "seen_at": "TIMESTAMP",
    "epoch": "TIMESTAMP",
}


@query(
    "conform_types",
    """
    with v as (
      select event_id,
        case event_id % 10 when 0 then true when 1 then true when 2 then true when 3 then false
          when 4 then false end as flag,
        event_id % 10 between 5 and 8 as flag_bad,
        cast(case event_id % 9 when 0 then 3 when 1 then 42 when 2 then -7 when 6 then 5 when 7 then 1000 end
          as bigint) as amount,
        event_id % 9 between 3 and 5 as amount_bad,
        cast(case event_id % 11 when 0 then 0.75 when 1 then 1000 when 4 then -2.5 when 7 then 0.5
          when 9 then event_id end as double) as ratio,
        event_id % 11 in (2, 3, 5, 6, 8) as ratio_bad,
        cast(case event_id % 8 when 0 then 1793048400000000 when 1 then 1793048400000000
          when 2 then 1793048400000000 when 5 then 1792972800000000 when 6 then 1793048400250000 end as bigint)
          as seen_us,
        event_id % 8 in (3, 4) as seen_bad,
        cast(case event_id % 4 when 0 then 1700000000125000 when 1 then 1700000000123000
          when 2 then 1700000000123456 end as bigint) as epoch_us
      from events)
    select event_id, flag, amount, ratio, seen_us, epoch_us,
      case when flag_bad then 'Invalid BOOL value: flag' when amount_bad then 'Invalid INT64 value: amount'
        when ratio_bad then 'Invalid FLOAT64 value: ratio'
        when seen_bad then 'Invalid TIMESTAMP value: seen_at' end as reason
    from v""",
)
def conform_types(spark, sf_dir):
    raw = S.view(spark, sf_dir, "typed_text").withColumn("epoch", F.col("epoch").cast("double"))
    typed = conform.conform(raw, CONFORM_SCHEMA, keys=["event_id"])
    return typed.select(
        "event_id", "flag", "amount", "ratio",
        F.unix_micros("seen_at").alias("seen_us"),
        F.unix_micros("epoch").alias("epoch_us"),
        "reason",
    )


@query(
    "fail_whole",
    """
    with v as (select user_id, event_id, event_id % 9 between 3 and 5 and event_id % 31 = 0 as bad from events)
    select user_id, count(*) as refused_rows from v
    where user_id in (select user_id from v where bad) group by user_id""",
)
def fail_whole(spark, sf_dir):
    raw = S.view(spark, sf_dir, "typed_text").join(
        S.table(spark, sf_dir, "events").select("event_id", "user_id"), "event_id"
    )
    picked = raw.select(
        "user_id", "event_id", F.when(F.col("event_id") % 31 == 0, F.col("amount")).alias("amount")
    )
    typed = conform.conform(picked, {"amount": "INT64"}, keys=["user_id", "event_id"])
    spread = conform.fail_whole(typed, ["user_id"])
    return spread.where("reason is not null").groupBy("user_id").agg(F.count("*").alias("refused_rows"))


@query(
    "oversize_rows",
    """
    with s as (
      select doc_id, octet_length(encode(text)) as a, octet_length(encode(lang)) as b from documents),
    z as (
      select doc_id, cast(
        1 + case when doc_id < 128 then 1 when doc_id < 16384 then 2 when doc_id < 2097152 then 3 else 4 end
        + 1 + case when a < 128 then 1 when a < 16384 then 2 when a < 2097152 then 3 else 4 end + a
        + 1 + case when b < 128 then 1 else 2 end + b as bigint) as row_bytes from s)
    select doc_id, row_bytes from z where row_bytes > 4096""",
)
def oversize_rows(spark, sf_dir):
    rows = S.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    _, large = conform.oversize_split(rows, limit=4096)
    return large.select("doc_id", F.col("row_bytes").cast("bigint").alias("row_bytes"))
