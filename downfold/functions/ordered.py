"""Ordered per-key operators that do not put a whole key into one task.

A window over ``partitionBy(key).orderBy(seq)`` sends every row of a key to one task,
so a key that holds a third of the data makes one task sort a third of the data. The
functions here cut each key's history into slices of a fixed span of the leading order
column. Rows are shuffled by (key, slice); what has to cross a slice boundary is one row
per (key, slice), found by a partially aggregated group-by, shifted along the key in a
second and far smaller window, and joined back on the partitioning the rows already have.

With a unique integral order column a slice holds at most ``span`` rows of any key,
whatever the skew. For times and sparse numbers, ``measured_span`` finds a span from the
data. Results equal those of the plain window for every span.
"""

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE = "_slice"


def slice_column(order: str, span: int) -> Column:
    """Slice number of a long column; order preserving, also below zero."""
    return F.expr(f"`{order}` div {int(span)}")


def measured_span(df: DataFrame, order: str, rows: int = 1 << 22) -> int:
    """Span at which a slice of the whole table holds about ``rows`` rows.

    Runs one small aggregate over the order column. It assumes that rows come steadily.
    """
    low, high, n = df.agg(F.min(order), F.max(order), F.count(order)).first()
    if not n:
        return 1
    return max(1, (high - low + 1) * rows // n)


def _position(order: Sequence[str]) -> Column:
    """One comparable column for an order of one or two long columns.

    Numbers keep ``max_by`` a hash aggregate; over a struct it would sort its input first.
    """
    if len(order) == 1:
        return F.col(order[0])
    if len(order) > 2:
        raise ValueError("at most two order columns")
    high, low = (F.col(name).cast("decimal(18,0)") for name in order)
    return high * F.lit(Decimal(2**63)) + low


def lag_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    into: str,
    span: int | None,
) -> DataFrame:
    """Add struct column ``into`` with the payload of the preceding row of the same key.

    It is null for the first row of a key. ``order`` is one or two long columns. With
    ``span=None`` the plain window is used, for inputs whose keys are known to be small.
    ``df`` is read twice, so an input that is costly to derive should be a written table.
    """
    keys, order = list(keys), list(order)

    def shifted(along, prefix: str) -> dict[str, Column]:
        # Column by column: a lag over a struct would shuffle the struct beside its parts.
        lagged = {f"{prefix}{name}": F.lag(name).over(along) for name in payload}
        return {**lagged, f"{prefix}any": F.lag(F.lit(True)).over(along)}

    def packed(prefix: str) -> Column:
        parts = [F.col(f"{prefix}{name}").alias(name) for name in payload]
        return F.when(F.col(f"{prefix}any"), F.struct(*parts))

    if span is None:
        plain = df.withColumns(shifted(Window.partitionBy(*keys).orderBy(*order), "_lag_"))
        return plain.withColumn(into, packed("_lag_")).select(*df.columns, into)

    sliced = df.withColumn(SLICE, slice_column(order[0], span))
    last_of_slice = sliced.groupBy(*keys, SLICE).agg(
        *[F.max_by(name, _position(order)).alias(name) for name in payload]
    )
    carry = (
        last_of_slice.withColumns(shifted(Window.partitionBy(*keys).orderBy(SLICE), "_carry_"))
        .where("_carry_any")
        .select(*keys, SLICE, packed("_carry_").alias("_carry"))
    )
    return (
        sliced.withColumns(shifted(Window.partitionBy(*keys, SLICE).orderBy(*order), "_lag_"))
        .join(carry, [*keys, SLICE], "left")
        .withColumn(into, F.coalesce(packed("_lag_"), F.col("_carry")))
        .select(*df.columns, into)
    )


def running_max_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    into: str,
    span: int,
) -> DataFrame:
    """Add ``into``: the maximum of ``value`` over this and all earlier rows of the key.

    Rows with the same ``order`` value in a key are peers and see each other.
    """
    return _running(df, keys, order, value, into, span, F.max, lambda a, b: F.greatest(a, b))


def running_sum_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    into: str,
    span: int,
    next_into: str | None = None,
) -> DataFrame:
    """Add ``into``: the sum of ``value`` over this and all earlier rows of the key.

    With ``next_into`` also the order value of the key's next row within the same slice,
    null for the slice's last row.
    """

    def combine(a, b):
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))

    return _running(df, keys, order, value, into, span, F.sum, combine, next_into)


def _running(df, keys, order, value, into, span, total, combine, next_into=None):
    keys = list(keys)
    sliced = df.withColumn(SLICE, slice_column(order, span))
    along = Window.partitionBy(*keys, SLICE).orderBy(order)
    so_far = along.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        sliced.groupBy(*keys, SLICE)
        .agg(total(value).alias("_total"))
        .select(*keys, SLICE, total("_total").over(earlier).alias("_carry"))
        .where(F.col("_carry").isNotNull())
    )
    added = {into: total(value).over(so_far)}
    if next_into is not None:
        added[next_into] = F.lead(order).over(along)
    return (
        sliced.withColumns(added)
        .join(carry, [*keys, SLICE], "left")
        .withColumn(into, combine(F.col(into), F.col("_carry")))
        .select(*df.columns, *added)
    )
