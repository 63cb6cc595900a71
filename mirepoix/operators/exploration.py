"""Exploratory statistics of a cleaned recipe table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mirepoix.operators.ordering import with_row_index
from mirepoix.session import store


def value_counts(df: DataFrame, column: str, top: int | None = 10) -> DataFrame:
    """Frequency of each value, most frequent first; NULLs are left out."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("count")
    )
    ordered = counts.orderBy(F.desc("count"), column)
    return ordered.limit(top) if top else ordered


def mean_by_group(
    df: DataFrame, group: str, columns: Sequence[str], prefix: str = "mean_",
    order: str | None = None, descending: bool = False,
) -> DataFrame:
    """Means per group; rows without a group are left out."""
    means = df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        *[F.avg(c).alias(prefix + c) for c in columns]
    )
    if order is None:
        return means
    return means.orderBy(F.desc(order) if descending else F.asc(order), group)


def std_by_group(df: DataFrame, group: str, columns: Sequence[str], prefix: str = "std_") -> DataFrame:
    """Sample standard deviations per group."""
    return df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        *[F.stddev_samp(c).alias(prefix + c) for c in columns]
    )


def boxplot_stats(df: DataFrame, group: str, value: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers and outlier count per group, exact.

    Rows are first counted per (group, value), so the ranking sees distinct
    values, not rows; the counts are stored, as they are read several times. The
    ranking runs over range partitions and bounded blocks of values.
    """
    known = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    counts = store(
        known.groupBy(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n")),
        "value-counts",
    )
    ranked = _running_count(counts)
    totals = counts.groupBy("g").agg(F.sum("n").alias("total"))
    placed = ranked.join(totals, "g")

    def at(position: Column) -> Column:
        inside = (F.col("upto") > position) & (F.col("upto") - F.col("n") <= position)
        return F.max(F.when(inside, F.col("v")))

    picks = []
    for name, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
        place = (F.col("total") - 1) * q
        picks += [at(F.floor(place)).alias(f"{name}_lo"), at(F.ceil(place)).alias(f"{name}_hi"),
                  F.max(place - F.floor(place)).alias(f"{name}_share")]
    edges = placed.groupBy("g").agg(*picks, F.max("total").alias("total")).select(
        "g", "total",
        *[(F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_share")).alias(n)
          for n in ("q1", "median", "q3")],
    )
    spread = (F.col("q3") - F.col("q1")) * reach
    inner = F.col("v").between(F.col("q1") - spread, F.col("q3") + spread)
    return counts.join(edges, "g").groupBy("g", "total", "q1", "median", "q3").agg(
        F.min(F.when(inner, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inner, F.col("v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inner, F.col("n"))), F.lit(0)).alias("n_outliers"),
    ).withColumnsRenamed({"g": group, "total": "n_rows"})


_STRIDE = 100_000


def _running_count(counts: DataFrame) -> DataFrame:
    """Running sum of ``n`` per ``g`` in ``v`` order, over bounded blocks of values."""
    blocks = with_row_index(counts, ["v"], "at", ["g"]).withColumn(
        "block", F.floor(F.col("at") / _STRIDE)
    )
    block_sums = blocks.groupBy("g", "block").agg(F.sum("n").alias("s"))
    earlier = Window.partitionBy("g").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = block_sums.select(
        "g", "block", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("g", "block").orderBy("v").rowsBetween(
        Window.unboundedPreceding, 0)
    return (
        blocks.withColumn("inner", F.sum("n").over(inside))
        .join(before, ["g", "block"])
        .select("g", "v", "n", (F.col("before") + F.col("inner")).alias("upto"))
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in ``bins`` equal bins from minimum to maximum, empty bins included."""
    values = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    edge = ends.select(F.struct("lo", "hi", ((F.col("hi") - F.col("lo")) / bins).alias("width"))).scalar()

    # one column in each of its two places, so that the plan holds it twice, not once a use
    e = F.col("edge")
    at = F.least(F.floor((F.col("v") - e["lo"]) / e["width"]), F.lit(bins - 1))
    placed = values.select("v", edge.alias("edge")).select(
        F.when(e["hi"] == e["lo"], F.lit(0)).otherwise(at).cast("long").alias("bin")
    ).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select("id", edge.alias("edge")).select(
        F.col("id").alias("b"), (e["lo"] + F.col("id") * e["width"]).alias("bin_start")
    )
    return frame.join(placed, F.col("b") == F.col("bin"), "left").select(
        F.col("b").alias("bin"), "bin_start", F.coalesce("n", F.lit(0)).alias("n")
    )


def density_curve(df: DataFrame, column: str, points: int = 200) -> DataFrame:
    """A Gaussian density estimate on ``points`` even places from minimum to maximum, as drawn over a histogram.

    Values are dealt linearly to their two neighbouring places and the weights smoothed; the
    bandwidth is the standard deviation times n**(-1/5). The input is read twice: for the moments
    and for the weights, of which there are ``points``. NULL and NaN values are left out; fewer than
    two different values have no density and give no rows.
    """
    values = df.select(F.col(column).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    moments = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("n"), F.stddev_samp("v").alias("s"))
    step, width = (F.col("hi") - F.col("lo")) / (points - 1), F.col("s") * F.pow(F.col("n"), F.lit(-0.2))
    shape = moments.select(F.struct("lo", "hi", "n", step.alias("step"), width.alias("width"))).scalar()
    e = F.col("e")
    at = (F.col("v") - e["lo"]) / e["step"]
    left = F.least(F.floor(at), F.lit(points - 2))
    dealt = values.select("v", shape.alias("e")).filter(e["hi"] > e["lo"]).select(
        F.inline(F.array(
            F.struct(left.alias("k"), (1 - (at - left)).alias("w")), F.struct((left + 1).alias("k"), (at - left).alias("w")))))
    weights = dealt.groupBy("k").agg(F.sum("w").alias("w"))
    spread = weights.select("w", "k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))).alias("point"), shape.alias("e"))
    z = (F.col("point") - F.col("k")) * e["step"] / e["width"]
    summed = spread.select("point", "e", (F.col("w") * F.exp(-0.5 * z * z)).alias("y")).groupBy("point", "e").agg(F.sum("y").alias("y"))
    return summed.select(
        "point", (e["lo"] + F.col("point") * e["step"]).alias("x"),
        (F.col("y") / (e["n"] * e["width"] * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"))


def explode_counts(df: DataFrame, column: str, output: str) -> DataFrame:
    """Count every label of an array column, most frequent first."""
    return (
        df.select(F.explode(column).alias(output)).groupBy(output)
        .agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), output)
    )


def swap_columns(df: DataFrame, larger: str = "total_fat", smaller: str = "saturated_fat") -> DataFrame:
    """Exchange the two values where the part exceeds the whole."""
    wrong = F.col(smaller) > F.col(larger)
    return df.withColumns({
        larger: F.when(wrong, F.col(smaller)).otherwise(F.col(larger)),
        smaller: F.when(wrong, F.col(larger)).otherwise(F.col(smaller)),
    })


RATIOS = (
    ("saturated_fat", "calories"),
    ("total_fat", "calories"),
    ("sugar", "calories"),
    ("sodium", "calories"),
    ("protein", "calories"),
    ("carbohydrates", "calories"),
    ("calories", "saturated_fat"),
)


def ratio_columns(df: DataFrame, ratios: Sequence[tuple[str, str]] = RATIOS) -> DataFrame:
    """Add ``a_to_b`` columns; a zero divisor gives NULL."""
    return df.withColumns({f"{a}_to_{b}": F.try_divide(a, b) for a, b in ratios})


def is_finite(column: str) -> Column:
    value = F.col(column)
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))


def finite_only(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(reduce(lambda a, b: a & b, [is_finite(c) for c in columns]))


def ratio_by_group(df: DataFrame, group: str, ratios: Sequence[str]) -> DataFrame:
    """Mean of the finite values of each ratio per group: one pass, rows (group, ratio)."""
    means = df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        *[F.avg(F.when(is_finite(r), F.col(r))).alias(r) for r in ratios]
    )
    return (
        means.unpivot([group], list(ratios), "ratio", "mean_ratio")
        .filter(F.col("mean_ratio").isNotNull())
        .orderBy("ratio", "mean_ratio", group)
    )


def outlier_rows(df: DataFrame, column: str = "calories", above: float = 2000) -> DataFrame:
    return df.filter(F.col(column) > above)


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr"),
                  F.count_if(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("n"))


def grid_counts(df: DataFrame, a: str, b: str, a_step: int, b_step: int) -> DataFrame:
    """Counts on a grid of two columns: what a scatter plot shows, in bounded size."""
    return df.groupBy(
        F.floor(F.col(a) / a_step).alias(f"{a}_bin"), F.floor(F.col(b) / b_step).alias(f"{b}_bin")
    ).agg(F.count(F.lit(1)).alias("n"))


def align_columns(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Put the columns of two tables side by side by key."""
    return left.join(right, key)


def preview(df: DataFrame, key: str, rows: int = 5, chars: int = 100, columns: Sequence[str] = ()) -> DataFrame:
    """First rows by key, texts cut to the first characters."""
    first = df.orderBy(key).limit(rows)
    return first.withColumns({c: F.substring(c, 1, chars) for c in columns}) if columns else first
