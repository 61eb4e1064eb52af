"""Exact order statistics without gathering a group in one task.

Ranks are found in levels: a bounded histogram, finer where values are dense, says which bucket
holds a rank, and only that bucket's distinct values are ordered. A hot group or a hot value therefore never has to
be sorted whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HASH_PREFIX = 4  # hex digits: 65536 buckets


def _squash(value: Column) -> Column:
    """A monotone log scale, so that heavy tails spread over the buckets."""
    return F.signum(value) * F.log1p(F.abs(value))


def with_buckets(df: DataFrame, value: str, buckets: int) -> DataFrame:
    """Add ``_bucket``: order-preserving cells, narrow where the values are dense.

    Equal-width cells of a log scale between the finite extremes are counted first. Each is then
    cut, between its own extremes, into as many equal parts as its share of the rows calls for,
    so neither a far outlier nor a narrow range fills one cell; infinities have cells of their
    own. There are at most ``2 * buckets + 2`` cells, which bounds the broadcast table of cells.
    Groups share one scale, so no row has to meet its group's extremes in a join. The scale is
    named through one column: repeating a scalar subquery in an expression would plan its
    whole input again each time.
    """
    finite = F.when(F.abs(value) < F.lit(float("inf")), F.col(value))
    low, high = _squash(F.min(finite)), _squash(F.max(finite))
    per = (buckets / F.when(high > low, high - low)).alias("per")
    scale = df.agg(F.struct(low.alias("low"), per)).scalar()
    place = F.floor((_squash(F.col(value)) - F.col("_scale.low")) * F.col("_scale.per"))
    coarse = (
        F.when(F.col(value) == float("inf"), buckets).when(F.col(value) == float("-inf"), -1)
        .otherwise(F.least(F.coalesce(place, F.lit(0)), F.lit(buckets - 1)).cast("int"))
    )
    scaled = df.withColumn("_scale", scale).withColumn("_coarse", coarse).drop("_scale")
    counted = scaled.groupBy("_coarse").agg(
        F.count(F.lit(1)).alias("_rows"), F.min(value).cast("double").alias("_from"), F.max(value).cast("double").alias("_to")
    )
    share = F.col("_rows") * F.lit(float(buckets)) / F.sum("_rows").over(W.partitionBy())
    split = F.when(F.col("_to") > F.col("_from"), F.ceil(share)).otherwise(1)
    split = F.when(F.abs("_to") < F.lit(float("inf")), split).otherwise(1)
    before = W.orderBy("_coarse").rowsBetween(W.unboundedPreceding, -1)
    cells = counted.withColumn("_parts", split).withColumn("_first", F.coalesce(F.sum("_parts").over(before), F.lit(0)))
    cells = cells.select(F.col("_coarse").alias("_cell"), "_from", "_parts", "_first", (F.col("_to") - F.col("_from")).alias("_span"))
    joined = scaled.join(F.broadcast(cells), F.col("_coarse") == F.col("_cell"), "left")
    part = F.floor((F.col(value) - F.col("_from")) / F.col("_span") * F.col("_parts"))
    part = F.when(F.col("_parts") > 1, F.least(F.coalesce(part, F.lit(0)), F.col("_parts") - 1)).otherwise(0)
    return joined.withColumn("_bucket", F.col("_first") + part).select(*df.columns, "_bucket")


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    buckets: int = 65536,
    few_groups: bool = False,
) -> DataFrame:
    """Linearly interpolated exact quantiles, per group when ``by`` is given.

    Returns the ``by`` columns, ``n`` (non-null values) and ``quantiles``, an array aligned
    with ``probs``. NaN counts as missing. The input is scanned three times, each time only
    for the key and value columns; every shuffle carries pre-aggregated cells.

    ``few_groups`` promises a bounded number of groups (columns of a report, the top k): the
    wanted cells are then broadcast and rows outside them never leave their task. Otherwise
    equal values are counted first, so that a hot group or value collapses before it moves.
    """
    by = list(by)
    clean = F.col(value).cast("double")
    src = (
        df.select(*by, clean.alias("_v"))
        .where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    )
    cells = with_buckets(src, "_v", buckets)

    hist = cells.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    ordered = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*by)
    position = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(
        F.concat(
            F.array(*[F.floor(x) for x in position]), F.array(*[F.ceil(x) for x in position])
        )
    )
    picked = (
        hist.withColumn("_n", F.sum("_c").over(whole))
        .withColumn("_before", F.sum("_c").over(ordered) - F.col("_c"))
        .withColumn(
            "_wanted",
            F.filter(
                ranks,
                lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_c")),
            ),
        )
        .where(F.size("_wanted") > 0)
        .select(*by, "_bucket", "_n", "_before", "_wanted")
    )
    bounded = few_groups or not by  # at most two cells per group and quantile
    wanted = picked.select(
        *[F.col(c).alias(f"_k_{c}") for c in by],
        F.col("_bucket").alias("_kb"), "_n", "_before", "_wanted",
    )
    values = cells if bounded else cells.groupBy(*by, "_bucket", "_v").agg(
        F.count(F.lit(1)).alias("_c")
    )
    on = values["_bucket"] == wanted["_kb"]
    for c in by:  # null-safe, so a null group keeps its rows
        on = on & values[c].eqNullSafe(wanted[f"_k_{c}"])
    if bounded:
        counted = (
            values.join(F.broadcast(wanted), on)
            .groupBy(*by, "_bucket", "_v", "_n", "_before", "_wanted")
            .agg(F.count(F.lit(1)).alias("_c"))
        )
    else:
        counted = values.join(wanted, on)
    inside = (
        W.partitionBy(*by, "_bucket").orderBy("_v")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    upto = F.col("_before") + F.sum("_c").over(inside)
    hits = (
        counted.withColumn("_upto", upto)
        .withColumn("_from", F.col("_upto") - F.col("_c"))
        .withColumn(
            "_rank",
            F.explode(
                F.filter("_wanted", lambda r: (r >= F.col("_from")) & (r < F.col("_upto")))
            ),
        )
    )
    table = hits.groupBy(*by).agg(
        F.first("_n").alias("n"),
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"),
    )

    def interpolated(p: float) -> Column:
        x = (F.col("n") - 1) * F.lit(float(p))
        low = F.try_element_at("_at", F.floor(x))
        high = F.try_element_at("_at", F.ceil(x))
        return low + (high - low) * (x - F.floor(x))

    return table.select(
        *by, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        F.array(*[interpolated(p) for p in probs]).alias("quantiles"),
    )


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), buckets: int = 4096
) -> DataFrame:
    """Add ``<c>_before`` for each of ``sums``: its total over strictly smaller ``order`` values.

    ``df`` must hold one row per group and order value. Bucket totals carry the sum from
    bucket to bucket, so only one bucket is ever ordered in one task.
    """
    by = list(by)
    cells = with_buckets(df, order, buckets)
    keys = [*by, "_bucket"]
    totals = cells.groupBy(*keys).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        *keys, *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in sums]
    )
    within = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return (
        cells.join(totals, keys)
        .select(
            *df.columns,
            *[
                (F.col(f"_b_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0))).alias(f"{c}_before")
                for c in sums
            ],
        )
    )


def sample_key(id_col: str, seed: int) -> Column:
    """A pseudo-random, engine-independent ordering of rows."""
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def _hash_thresholds(keyed: DataFrame, by: list[str], take: Column) -> DataFrame:
    """Per group, the hash of the ``take``-th smallest row; ``take`` may use the group size ``_n``."""
    prefix = F.substring("_h", 1, HASH_PREFIX)
    hist = keyed.groupBy(*by, prefix.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    running = W.partitionBy(*by).orderBy("_p").rowsBetween(W.unboundedPreceding, W.currentRow)
    edge = (
        hist.withColumn("_n", F.sum("_c").over(W.partitionBy(*by)))
        .withColumn("_take", take)
        .withColumn("_before", F.sum("_c").over(running) - F.col("_c"))
        .where((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_c")))
        .select(*by, "_p", (F.col("_take") - F.col("_before")).alias("_nth"))
    )
    if not by:
        edge = F.broadcast(edge)  # one row
    rows = keyed.withColumn("_p", prefix).join(edge, [*by, "_p"])
    nth = F.row_number().over(W.partitionBy(*by, "_p").orderBy("_h"))
    return rows.withColumn("_r", nth).where(F.col("_r") == F.col("_nth")).select(*by, "_h")


def exact_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` random rows without replacement, the whole input if it is smaller.

    The hash of the n-th row is found from a histogram of hash prefixes; the sample is then a
    plain filter, so no task ever gathers the rows.
    """
    keyed = df.select(sample_key(id_col, seed).alias("_h"))
    edge = _hash_thresholds(keyed, [], F.lit(n)).agg(F.max("_h")).scalar()
    return df.where(sample_key(id_col, seed) <= F.coalesce(edge, F.lit("g")))


def stratified_split(
    df: DataFrame, id_col: str, label: str, test_share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: in every label exactly round(share * size) rows, picked by hash."""
    keyed = df.select(label, sample_key(id_col, seed).alias("_h"))
    take = F.round(F.lit(test_share) * F.col("_n")).cast("bigint")
    edges = _hash_thresholds(keyed, [label], take).select(F.col(label).alias("_class"), F.col("_h").alias("_edge"))
    chosen = F.coalesce(sample_key(id_col, seed) <= F.col("_edge"), F.lit(False))
    split = df.join(edges, F.col(label) == F.col("_class"), "left")
    return split.withColumn("is_test", chosen.cast("int")).drop("_class", "_edge")
