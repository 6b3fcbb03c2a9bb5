"""Helpers that several operators share."""

from pyspark.sql import functions as F

from auditloom.session import prepare

#: Rows of an Arrow batch: texts may be long, so that batches are kept short.
BATCH_ROWS = 512

QUERIES = {}
ORACLES = {}


def query(name, oracle=None):
    """Register `fn(spark, sf_dir)` under `name`, with its SQL if there is one."""

    def add(fn):
        def run(spark, sf_dir):
            return fn(ready(spark), sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


def ready(spark):
    """The session with the settings these operators rely on."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark, sf_dir, name):
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text):
    """`text` with A-Z lowered and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id, modulus, remainder):
    """Whether the crc32 of the id as text leaves `remainder`."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def let(value, body):
    """`body` over the single value of the expression `value`, evaluated once.

    An expression that is used inside a lambda would be evaluated anew for each
    element; bound as the element of a one-element array it is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df, *names):
    """Compute the columns `names` once, whatever is done with them later.

    Catalyst copies expressions into the projections and filters above, but not
    through a generator, so the columns leave through a one-row array.
    """
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.inline(F.array(F.struct(*names))))
