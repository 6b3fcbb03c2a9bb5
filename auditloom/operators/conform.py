"""Strict conversion of columns to the types of a declared table."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from auditloom import fixed
from auditloom.functions.objects import strip
from auditloom.operators.joins import folded
from auditloom.operators.once import computed

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = (T.FloatType, T.DoubleType, T.DecimalType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)

# Accepted texts.
TRUE_TEXT = ("true", "1")
FALSE_TEXT = ("false", "0")
INT_TEXT = r"\A[+-]?[0-9]+(_[0-9]+)*\z"
FLOAT_TEXT = (
    r"\A[+-]?([0-9]+(_[0-9]+)*(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)"
    r"([eE][+-]?[0-9]+(_[0-9]+)*)?\z"
)
COMMON_ISO = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([+-][0-9]{2}:[0-9]{2})?)?\z"
)
ISO_TEXT = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"([T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?([+-][0-9]{2}(:[0-9]{2}(:[0-9]{2})?)?)?)?\z"
)
MICROS_FROM, MILLIS_FROM = 1e14, 1e11


def whole_number(text):
    """Text to a whole number; underscores may stand between digits."""
    text = strip(text)
    return F.when(text.rlike(INT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))


def _to_bool(col, kind):
    if isinstance(kind, T.BooleanType):
        return col
    if isinstance(kind, _INTEGRAL):
        return F.when(col.isin(0, 1), col == 1)
    if isinstance(kind, T.StringType):
        text = F.lower(strip(col))
        return F.when(text.isin(*TRUE_TEXT), True).when(text.isin(*FALSE_TEXT), False)
    return F.lit(None).cast("boolean")


def _to_int(col, kind):
    if isinstance(kind, _INTEGRAL):
        return col.cast("bigint")
    if isinstance(kind, _FRACTION):
        return col.try_cast("bigint")
    if isinstance(kind, T.StringType):
        return whole_number(col)
    return F.lit(None).cast("bigint")


def _finite(number):
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def _to_float(col, kind):
    if isinstance(kind, _INTEGRAL + _FRACTION):
        return _finite(col.cast("double"))
    if isinstance(kind, T.StringType):
        text = strip(col)
        return F.when(
            text.rlike(FLOAT_TEXT), _finite(F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
        )
    return F.lit(None).cast("double")


def _iso(col):
    """ISO text to a timestamp.

    The usual spelling is cast as it is; rarer ones (compact dates and times,
    missing minutes or seconds, short offsets) are completed first.
    """
    zoned = F.regexp_replace(strip(col), r"(Z| UTC)\z", "+00:00")
    text = F.regexp_replace(zoned, r"\A([0-9]{4})([0-9]{2})([0-9]{2})(?=\z|[T ])", "$1-$2-$3")
    text = F.regexp_replace(text, r"([T ][0-9]{2})([0-9]{2})([0-9]{2})?(?=\z|[+.,-])", "$1:$2:$3")
    text = F.regexp_replace(text, r"([+-][0-9]{2})([0-9]{2})\z", "$1:$2")
    text = F.regexp_replace(text, r"([T ][0-9]{2})(?=\z|[+-])", "$1:00")
    text = F.regexp_replace(text, r"([T ][0-9]{2}:[0-9]{2}):?(?=\z|[+-])", "$1:00")
    text = F.replace(text, F.lit(","), F.lit("."))
    return F.when(zoned.rlike(COMMON_ISO), zoned.try_cast("timestamp")).otherwise(
        F.nullif(F.regexp_extract(text, ISO_TEXT, 0), F.lit("")).try_cast("timestamp")
    )


def _to_timestamp(col, kind):
    if isinstance(kind, T.TimestampType):
        return col
    if isinstance(kind, T.TimestampNTZType):
        return col.cast("timestamp")
    if isinstance(kind, _INTEGRAL + _FRACTION):
        epoch = _finite(col.cast("double"))
        size = F.abs(epoch)
        scale = F.when(size >= MICROS_FROM, 1.0).when(size >= MILLIS_FROM, 1e3).otherwise(1e6)
        return F.timestamp_micros(F.bround(epoch * scale, 0).try_cast("bigint"))
    if isinstance(kind, T.StringType):
        return _iso(col)
    return F.lit(None).cast("timestamp")


def _to_bytes(col, kind):
    return col if isinstance(kind, T.BinaryType) else F.lit(None).cast("binary")


def _not_finite(col, kind):
    """Whether a value is, or holds anywhere, a NaN or an infinity; never null."""
    if isinstance(kind, _FRACTION):
        number = col.cast("double")
        return F.coalesce(F.isnan(number) | (F.abs(number) == float("inf")), F.lit(False))
    if isinstance(kind, T.StructType):
        found = F.lit(False)
        for field in kind.fields:
            found = found | _not_finite(col[field.name], field.dataType)
        return found
    if isinstance(kind, T.ArrayType):
        return F.coalesce(F.exists(col, lambda x: _not_finite(x, kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        return F.coalesce(F.exists(F.map_values(col), lambda x: _not_finite(x, kind.valueType)), F.lit(False))
    return F.lit(False)


def _to_text(col, kind):
    if isinstance(kind, T.VariantType):
        return F.to_json(col)
    if isinstance(kind, _NESTED):
        # Null fields are written; a nested NaN or infinity is refused.
        return F.when(~_not_finite(col, kind), F.to_json(col, {"ignoreNullFields": "false"}))
    return col.cast("string")


CONVERTERS = {
    "BOOL": _to_bool,
    "BOOLEAN": _to_bool,
    "INT64": _to_int,
    "INTEGER": _to_int,
    "FLOAT": _to_float,
    "FLOAT64": _to_float,
    "TIMESTAMP": _to_timestamp,
    "BYTES": _to_bytes,
}


def check_columns(df, schema):
    """Refuse unknown columns and nested or repeated targets before any row is read."""
    for name, kind in schema.items():
        if kind.upper() in ("RECORD", "STRUCT", "ARRAY", "MAP", "REPEATED"):
            raise ValueError(f"Unsupported column {name}: {kind}")
    unknown = [c for c in df.columns if c not in schema]
    if unknown:
        raise ValueError(f"Unknown column: {unknown[0]}")


def conform(df, schema, keys=()):
    """Convert `df` to `schema` (column -> declared type) and add `reason`.

    Columns in `keys` are carried along as they are. NULL means the field is
    not set and is always fine; a value that does not convert gives
    `Invalid TYPE value: column`, naming the first such column.
    """
    check_columns(df.drop(*keys), schema)
    fields = [f for f in df.schema.fields if f.name not in keys]
    made = {
        f.name: CONVERTERS.get(schema[f.name].upper(), _to_text)(F.col(f.name), f.dataType)
        for f in fields
    }
    # Converted once here; the second projection only compares and picks.
    both = df
    for f in fields:
        name = f"_to_{f.name}"
        both = computed(both.withColumn(name, made[f.name]), name)
    reason = F.lit(None).cast("string")
    for f in reversed(fields):
        bad = F.col(f.name).isNotNull() & F.col(f"_to_{f.name}").isNull()
        message = f"Invalid {schema[f.name].upper()} value: {f.name}"
        reason = F.when(bad, message).otherwise(reason)
    return both.select(
        *keys, *[F.col(f"_to_{f.name}").alias(f.name) for f in fields], reason.alias("reason")
    )


def fail_whole(df, audit_keys, reason_col="reason"):
    """Spread a reason over its audit: one refused row refuses all of them.

    Only the keys of failed audits are shuffled against the table, not every
    audit.
    """
    failed = df.where(F.col(reason_col).isNotNull())
    bad = folded(failed, audit_keys, F.min(reason_col).alias("_why"))
    return (
        df.join(bad, list(audit_keys), "left")
        .withColumn(reason_col, F.col("_why"))
        .drop("_why")
    )


def _varint(number):
    """Bytes of a base-128 number; negative ones always take ten."""
    # Seven bits a byte; a negative number has 64. Short code, as one method holds that of all columns.
    return ((F.octet_length(F.bin(number)) + 6) / 7).cast("int")


def row_bytes(df):
    """Serialised size of a row: field tags, lengths and contents."""
    total = F.lit(0).cast("bigint")
    for place, field in enumerate(df.schema.fields, start=1):
        col, kind = F.col(field.name), field.dataType
        tag = 1 if place < 16 else 2
        if isinstance(kind, (T.StringType, T.BinaryType)):
            length = F.octet_length(col).cast("bigint")
            size = _varint(length) + length
        elif isinstance(kind, T.BooleanType):
            size = F.lit(1)
        elif isinstance(kind, _FRACTION):
            size = F.lit(8)
        elif isinstance(kind, T.TimestampType):
            size = _varint(F.unix_micros(col))
        else:
            size = _varint(col.cast("bigint"))
        total = total + F.when(col.isNull(), 0).otherwise(size + tag)
    return total


def oversize_split(df, limit=fixed.MAX_ROW_BYTES):
    """(fitting, too large) rows; the latter carry `row_bytes`."""
    sized = df.withColumn("row_bytes", row_bytes(df))
    return (
        sized.where(F.col("row_bytes") <= limit).drop("row_bytes"),
        sized.where(F.col("row_bytes") > limit),
    )
