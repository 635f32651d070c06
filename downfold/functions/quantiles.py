"""Histograms, quantiles read from them, and exact quantiles."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def bucket_histogram(
    df: DataFrame,
    value: str,
    bounds: Sequence[float],
    by: Sequence[str] = (),
    unit: float = 1.0,
) -> DataFrame:
    """Cumulative counts of ``value <= le * unit`` per bound and for +Inf, with sum and count.

    One pass of conditional counts; only the finished aggregate row is unfolded to one row
    per bound. Pass integer values and their ``unit`` (1000 for ms) to keep sums exact.
    """
    by = list(by)
    counts = [
        F.count_if(F.col(value) <= bound * unit).alias(f"_le{i}") for i, bound in enumerate(bounds)
    ]
    wide = df.groupBy(*by).agg(
        *counts, F.count(value).alias("count"), (F.sum(value) / unit).alias("sum")
    )
    rows = [
        F.struct(F.lit(float(bound)).alias("le"), F.col(f"_le{i}").alias("cumulative"))
        for i, bound in enumerate(bounds)
    ]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("count").alias("cumulative")))
    return wide.withColumn("_b", F.explode(F.array(*rows))).select(
        *by, F.col("_b.le").alias("le"), F.col("_b.cumulative").alias("cumulative"), "sum", "count"
    )


def _each(qs: Sequence[float]):
    """One row per quantile. Never in one select with a window: it would unfold first."""
    return F.explode(F.array(*[F.lit(float(q)) for q in qs]))


def histogram_quantile(buckets: DataFrame, qs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Quantiles by linear interpolation inside the bucket that reaches the rank.

    The lowest bucket starts at 0, the +Inf bucket answers with the highest finite bound,
    and an empty histogram answers NaN. The windows run over one group's bounds only.
    """
    by = list(by)
    keys = by or [F.lit(0)]
    along = Window.partitionBy(*keys).orderBy("le")
    whole = Window.partitionBy(*keys)
    infinite = F.col("le") == float("inf")
    steps = buckets.select(
        *by,
        "le",
        "cumulative",
        F.coalesce(F.lag("le").over(along), F.lit(0.0)).alias("_low"),
        F.coalesce(F.lag("cumulative").over(along), F.lit(0)).alias("_below"),
        F.max("cumulative").over(whole).alias("_total"),
        F.max(F.when(~infinite, F.col("le"))).over(whole).alias("_top"),
    ).withColumn("q", _each(qs))
    rank = F.col("q") * F.col("_total")
    reached = F.col("cumulative") >= rank
    inside = F.col("_low") + (F.col("le") - F.col("_low")) * (
        (rank - F.col("_below")) / F.nullif(F.col("cumulative") - F.col("_below"), F.lit(0))
    )
    answer = (
        F.when(F.col("_total") == 0, float("nan"))
        .when(infinite, F.col("_top"))
        .otherwise(F.coalesce(inside, F.col("_low")))
    )
    # Every bound above the rank's bucket reaches the rank too; the lowest is the answer.
    return (
        steps.where(reached)
        .groupBy(*by, "q")
        .agg(F.min_by(answer, "le").alias("value"))
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    qs: Sequence[float],
    by: Sequence[str] = (),
    width: int = 1 << 16,
) -> DataFrame:
    """Exact interpolated quantiles of a long column, without one task seeing a whole group.

    ``percentile`` keeps every distinct value of a group in one aggregation buffer. Here
    values are counted first, the counts are summed into value slices of ``width``, the
    slice holding each wanted rank is found on that small table, and only the values of
    those slices (at most ``width`` distinct ones each) are ranked.
    """
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_slice", F.floor(F.col("_v") / width))
    )
    keys = by or [F.lit(0)]
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = counts.groupBy(*by, "_slice").agg(F.sum("_n").alias("_n")).select(
        *by,
        "_slice",
        F.col("_n"),
        (F.sum("_n").over(running) - F.col("_n")).alias("_before"),
        F.sum("_n").over(whole).alias("_total"),
    ).withColumn("q", _each(qs))
    place = F.col("q") * (F.col("_total") - 1)
    ends = F.array(
        F.struct(F.lit(0).alias("end"), F.floor(place).alias("rank")),
        F.struct(F.lit(1).alias("end"), F.ceil(place).alias("rank")),
    )
    wanted = (
        slices.withColumn("_frac", place - F.floor(place))
        .withColumn("_e", F.explode(ends))
        .where((F.col("_e.rank") >= F.col("_before")) & (F.col("_e.rank") < F.col("_before") + F.col("_n")))
        .select(
            *by,
            "_slice",
            "q",
            "_frac",
            F.col("_e.end").alias("_end"),
            (F.col("_e.rank") - F.col("_before")).alias("_rank"),
        )
    )
    inside = Window.partitionBy(*by, "_slice").orderBy("_v")
    join_keys = [*by, "_slice"]
    ranked = counts.join(wanted.select(*join_keys).distinct(), join_keys, "left_semi").withColumn(
        "_upto", F.sum("_n").over(inside)
    )
    hit = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n"))
    return (
        ranked.join(wanted, join_keys)
        .where(hit)
        .groupBy(*by, "q")
        .agg(
            F.max(F.when(F.col("_end") == 0, F.col("_v"))).alias("_lo"),
            F.max(F.when(F.col("_end") == 1, F.col("_v"))).alias("_hi"),
            F.max("_frac").alias("_frac"),
        )
        .select(*by, "q", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias("value"))
    )
