"""Columns that are computed once, whatever is done with them later."""

from pyspark.sql import functions as F


def computed(df, *names):
    """`df` with the columns `names` behind a barrier, last in this order.

    Catalyst moves filters below projections, and projections into one another,
    by copying expressions, which would parse or convert a value again for each
    use. It does not move anything below a generator, so the columns leave here
    through a one-row array.
    """
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.inline(F.array(F.struct(*names))))
