"""Counts, summaries, distributions and the tables behind each chart."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import DAY_NAMES, TIER_QUANTILES
from ..functions.numbers import log_plus_one, weekday_name
from .ordered import exact_quantiles


# --- counts ---------------------------------------------------------------------------------


def group_counts(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key combination, null keys left out."""
    return df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def value_counts(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """``group_counts``, most frequent first, ties by key."""
    return group_counts(df, *keys, name=name).orderBy(F.desc(name), *keys)


def top_groups(df: DataFrame, key: str, k: int, name: str = "count") -> DataFrame:
    """The k most frequent values of ``key``."""
    return value_counts(df, key, name=name).limit(k)


def share_of_all(df: DataFrame, key: str, k: int | None = None) -> DataFrame:
    """Counts with their percentage of all rows, optionally only the k largest groups."""
    counts = value_counts(df, key) if k is None else top_groups(df, key, k)
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", F.col("count") / total * 100)


def share_of_shown(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k largest groups with their percentage of the rows shown."""
    counts = top_groups(df, key, k)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("pct", F.col("count") / total * 100)


def peak_group(df: DataFrame, key: str) -> DataFrame:
    """Key and size of the largest group, the smallest key on ties."""
    return top_groups(df, key, 1)


def counts_by_key(df: DataFrame, key: str) -> DataFrame:
    """Counts in key order."""
    return group_counts(df, key).orderBy(key)


def counts_by_weekday(df: DataFrame, weekday: str) -> DataFrame:
    return counts_by_key(df, weekday).withColumn("day_name", weekday_name(F.col(weekday)))


def counts_by_year(df: DataFrame, year: str, first: int, last: int) -> DataFrame:
    return counts_by_key(df.where(F.col(year).between(first, last)), year)


def hierarchy(df: DataFrame, key: str, root: str, k: int = 20) -> DataFrame:
    """Root-to-group size list of the k largest groups."""
    return top_groups(df, key, k, name="size").select(
        F.col(key).alias("name"), F.lit(root).alias("parent"), "size"
    )


def token_frequency(df: DataFrame, tokens: Column, k: int | None = None) -> DataFrame:
    """Corpus frequency of every token; counts are combined before the shuffle."""
    exploded = df.select(F.explode(tokens).alias("token"))
    return top_groups(exploded, "token", k) if k else group_counts(exploded, "token")


# --- summaries ------------------------------------------------------------------------------


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(metric, value) pairs, one per row and column."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    return df.select(F.inline(pairs))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles and max of each column, one row per column."""
    long = _long(df, cols).where(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = long.groupBy("metric").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", (0.25, 0.5, 0.75), by=["metric"], few_groups=True)
    q = F.col("quantiles")
    return moments.join(quartiles.drop("n"), "metric").select(
        "metric", "count", "mean", "std", "min",
        q[0].alias("q25"), q[1].alias("median"), q[2].alias("q75"), "max",
    )


def quantile_cutoffs(
    df: DataFrame, value: str, probs: Sequence[float] = TIER_QUANTILES
) -> DataFrame:
    """One row of exact cutoffs named p33, p66, ..."""
    cut = exact_quantiles(df, value, probs)
    return cut.select(
        *[F.col("quantiles")[i].alias(f"p{round(p * 100)}") for i, p in enumerate(probs)]
    )


def tier_by_quantile(
    df: DataFrame,
    value: str,
    out: str,
    names: tuple[str, str, str] = ("low", "medium", "high"),
    probs: tuple[float, float] = TIER_QUANTILES,
) -> DataFrame:
    """Three classes cut at two quantiles of the whole input.

    At or above the upper cutoff is high, below the lower one is low, everything else,
    missing values included, is the middle class. The cutoffs reach the rows as a scalar
    subquery, so the rows are not moved.
    """
    return tiers_by_quantile(df, {out: (value, names)}, probs)


def tiers_by_quantile(
    df: DataFrame, tiers: dict[str, tuple[str, tuple[str, str, str]]],
    probs: tuple[float, float] = TIER_QUANTILES,
) -> DataFrame:
    """Several ``tier_by_quantile`` columns, {out: (value, (low, mid, high))}, in one pass.

    All cutoffs are taken from ``df`` itself, so the plans stand side by side, not nested.
    """
    cuts = {out: exact_quantiles(df, value, probs).select("quantiles").scalar().alias(f"_cut_{out}")
            for out, (value, _) in tiers.items()}
    labelled = df.select("*", *cuts.values())
    for out, (value, (low, mid, high)) in tiers.items():
        cut = F.col(f"_cut_{out}")
        seen = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
        labelled = labelled.withColumn(
            out,
            F.when(seen & (F.col(value) >= cut[1]), high)
            .when(seen & (F.col(value) < cut[0]), low)
            .otherwise(mid),
        )
    return labelled.drop(*[f"_cut_{out}" for out in tiers])


# Class names of the label and of the tier.
SENTIMENTS = ("negative", "neutral", "positive")
TIERS = ("low", "medium", "high")


def engagement_label(df: DataFrame, ratio: str, out: str = "sentiment_label") -> DataFrame:
    """Label derived from the like ratio: it tells engagement apart, not opinion."""
    return tier_by_quantile(df, ratio, out, SENTIMENTS)


def group_means(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=[key]).groupBy(key).agg(*[F.avg(c).alias(c) for c in cols])


def group_overview(df: DataFrame, key: str, first: str, second: str, counted: str) -> DataFrame:
    """Two means and a count of non-null values per group."""
    return df.na.drop(subset=[key]).groupBy(key).agg(
        F.avg(first).alias("avg_first"),
        F.avg(second).alias("avg_second"),
        F.count(counted).alias("row_count"),
    )


def group_medians(df: DataFrame, key: str, value: str) -> DataFrame:
    found = exact_quantiles(df.na.drop(subset=[key]), value, (0.5,), by=[key])
    return found.select(key, F.col("quantiles")[0].alias("median"))


def crosstab_pct(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Percentages of ``col`` inside each ``row``; absent cells are 0, rows sum to 100."""
    wide = count_pivot(df, row, col, values)
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return wide.where(total > 0).select(
        row, *[(F.col(f"`{v}`") / total * 100).alias(str(v)) for v in values]
    )


def count_pivot(df: DataFrame, row: str, col: str, values: Sequence) -> DataFrame:
    """Dense two-key counts, one column per listed value in the listed order."""
    return (
        df.na.drop(subset=[row, col])
        .groupBy(row)
        .agg(*[F.count_if(F.col(col) == v).alias(str(v)) for v in values])
    )


def hour_by_weekday(df: DataFrame, hour: str, weekday: str) -> DataFrame:
    named = df.withColumn("_day", weekday_name(F.col(weekday)))
    return count_pivot(named, hour, "_day", DAY_NAMES).orderBy(hour)


# --- correlation ----------------------------------------------------------------------------


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson r in long form (left, right, r); absent columns are skipped.

    All pairs come from one aggregate over one scan.
    """
    cols = [c for c in cols if c in df.columns]
    upper = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    x = {c: F.col(c).cast("double") for c in cols}
    wide = df.agg(
        *[F.corr(x[cols[i]], x[cols[j]]).alias(f"r_{i}_{j}") for i, j in upper]
    )
    cells = [
        F.struct(
            F.lit(cols[i]).alias("left"), F.lit(cols[j]).alias("right"),
            F.lit(i).alias("i"), F.lit(j).alias("j"),
            F.col(f"r_{min(i, j)}_{max(i, j)}").alias("r"),
        )
        for i in range(len(cols)) for j in range(len(cols))
    ]
    return wide.select(F.inline(F.array(*cells)))


def lower_triangle(matrix: DataFrame) -> DataFrame:
    return matrix.where(F.col("i") > F.col("j"))


def strongest_partners(matrix: DataFrame, col: str, k: int = 5) -> DataFrame:
    """Columns most correlated with ``col`` by |r|, the signed value shown."""
    return (
        matrix.where((F.col("left") == col) & (F.col("right") != col))
        .select(F.col("right").alias("partner"), "r")
        .orderBy(F.desc(F.abs("r")), "partner")
        .limit(k)
    )


# --- table profile --------------------------------------------------------------------------


def null_report(df: DataFrame) -> DataFrame:
    """Columns holding nulls: count and percentage, most nulls first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in df.columns]
    )
    return (
        counts.select("_n", F.inline(cells))
        .where(F.col("nulls") > 0)
        .select("column", "nulls", (F.col("nulls") / F.col("_n") * 100).alias("pct"))
        .orderBy(F.desc("nulls"), "column")
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("cols"))


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, exact."""
    return df.agg(F.count_distinct(col).alias("n_distinct"))


def approx_distinct_count(df: DataFrame, col: str, rsd: float = 0.01) -> DataFrame:
    return df.agg(F.approx_count_distinct(col, rsd).alias("n_distinct"))


def domain(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).na.drop().distinct().orderBy(col)


def extremes(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("min"), F.max(col).alias("max"))


def content_stats(
    df: DataFrame, means: dict[str, str], shares: dict[str, str]
) -> DataFrame:
    """Long (metric, value) block: the row count, means of columns, percentages of flags."""
    wanted = [("count", F.count(F.lit(1)).cast("double"))]
    wanted += [(name, F.avg(col)) for name, col in means.items()]
    wanted += [(name, F.avg(col) * 100) for name, col in shares.items()]
    block = df.agg(*[expr.alias(name) for name, expr in wanted])
    cells = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").alias("value")) for n, _ in wanted]
    )
    return block.select(F.inline(cells))


def kpi_block(
    df: DataFrame, *, category: str, views: str, likes: str, score: str, label: str,
    positive: str, negative: str, flags: Sequence[str] = (),
) -> DataFrame:
    """The headline numbers of a selection in one row."""

    def pct(condition: Column) -> Column:
        return F.avg(F.coalesce(condition, F.lit(False)).cast("int")) * 100

    median = exact_quantiles(df, score, (0.5,)).select("quantiles").scalar()[0]
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(category).alias("categories"),
        F.sum(views).alias("views_sum"),
        F.avg(views).alias("views_mean"),
        F.sum(likes).alias("likes_sum"),
        F.avg(likes).alias("likes_mean"),
        F.avg(score).alias("score_mean"),
        pct(F.col(label) == positive).alias("positive_pct"),
        pct(F.col(label) == negative).alias("negative_pct"),
        *[(F.avg(f) * 100).alias(f"{f}_pct") for f in flags],
    ).withColumn("score_median", median)


# --- distributions --------------------------------------------------------------------------


def histogram(
    df: DataFrame, value: str, bins: int = 60, by: Sequence[str] = (), log: bool = False
) -> DataFrame:
    """Equal-width counts over the range of the whole column, the last bin closed.

    With ``by`` the same bins are counted per group. Empty bins are not listed.
    """
    x = F.col(value).cast("double")
    x = log_plus_one(x) if log else x
    src = df.select(*by, x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    low, high = F.min("_x"), F.max("_x")
    ends = src.agg(F.struct(low.alias("low"), ((high - low) / bins).alias("width"))).scalar()
    width = F.col("_e.width")
    cell = F.floor((F.col("_x") - F.col("_e.low")) / F.when(width > 0, width))
    cell = F.least(F.coalesce(cell, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = (
        src.withColumn("_e", ends)
        .select(*by, cell.alias("bin"), "_e")
        .groupBy(*by, "bin", "_e")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counts.select(
        *by, "bin",
        (F.col("_e.low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_e.low") + (F.col("bin") + 1) * width).alias("bin_end"),
        "count",
    )


def log_mean(df: DataFrame, value: str) -> DataFrame:
    """The marker drawn over a log histogram: mean of log1p and of the plain values."""
    return df.agg(
        F.avg(log_plus_one(F.col(value))).alias("log_mean"), F.avg(value).alias("mean")
    )


def box_stats(df: DataFrame, group: str, value: str, k: int = 10) -> DataFrame:
    """Quartiles, whisker ends inside 1.5 IQR and outlier count of the k largest groups."""
    tops = F.broadcast(top_groups(df, group, k).select(group))
    kept = df.select(group, F.col(value).cast("double").alias("_v")).join(tops, group, "left_semi")
    kept = kept.where(F.col("_v").isNotNull())
    q = exact_quantiles(kept, "_v", (0.25, 0.5, 0.75), by=[group], few_groups=True).select(
        group, F.col("quantiles")[0].alias("q1"), F.col("quantiles")[1].alias("median"),
        F.col("quantiles")[2].alias("q3"),
    )
    q = q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn(
        "_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    )
    inside = F.col("_v").between(F.col("_lo"), F.col("_hi"))
    return (
        kept.join(F.broadcast(q), group)  # k rows
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def density(df: DataFrame, group: str, value: str, k: int = 10, points: int = 64) -> DataFrame:
    """Gaussian kernel density of the k largest groups on a grid between their extremes.

    Bandwidth is std * n^(-1/5). Equal values are counted first, and every kernel sum is
    combined before the shuffle, which carries at most k * points rows per task.
    """
    tops = F.broadcast(top_groups(df, group, k).select(group))
    kept = df.select(group, F.col(value).cast("double").alias("_v")).join(tops, group, "left_semi")
    counted = kept.na.drop().groupBy(group, "_v").agg(F.count(F.lit(1)).alias("_c"))
    n = F.sum("_c")
    mean = F.sum(F.col("_v") * F.col("_c")) / n
    spread = kept.na.drop().groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"),
        F.stddev_samp("_v").alias("_std"),
    )
    spread = spread.where(F.col("_std") > 0).withColumn(
        "_h", F.col("_std") * F.pow(F.col("_n"), F.lit(-0.2))
    )
    step = (F.col("_high") - F.col("_low")) / (points - 1)
    at = F.col("_low") + F.col("point") * step
    z = (F.col("_v") - at) / F.col("_h")
    scale = F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi)
    return (
        counted.join(F.broadcast(spread), group)  # k rows
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .select(group, "point", at.alias("at"), (F.col("_c") * F.exp(-0.5 * z * z) / scale).alias("_d"))
        .groupBy(group, "point", "at")
        .agg(F.sum("_d").alias("density"))
    )


# --- time series ----------------------------------------------------------------------------


def monthly_counts(
    df: DataFrame, moment: str, label: str, since_year: int, densify: Sequence[str] | None = None
) -> DataFrame:
    """Rows per month and label from a year on.

    ``densify`` names the label domain: every month between the first and the last then gets
    one row per label, 0 where nothing was seen.
    """
    month = F.to_date(F.trunc(F.col(moment).cast("date"), "month"))
    since = F.lit(f"{since_year}-01-01 00:00:00").cast(df.schema[moment].dataType)
    seen = (
        df.where(F.col(moment) >= since)  # on the stored column, so it reaches the scan
        .select(month.alias("month"), F.col(label))
        .na.drop()
        .groupBy("month", label)
        .agg(F.count(F.lit(1)).alias("count"))
    )
    if densify is None:
        return seen
    frame = seen.agg(F.min("month").alias("a"), F.max("month").alias("b")).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month")
    )
    frame = frame.withColumn(label, F.explode(F.array(*[F.lit(v) for v in densify])))
    return frame.join(seen, ["month", label], "left").select(
        "month", label, F.coalesce("count", F.lit(0).cast("bigint")).alias("count")
    )
