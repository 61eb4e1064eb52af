"""Projection, neighbour graphs and layout quality."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .features import l2_normalise
from .ordered import exact_sample
from .wide_pca import fit_wide_pca

#: Columns up to which the covariance is formed on the driver (8 MB).
MOST_COVARIANCE = 1024

# --- principal components -------------------------------------------------------------------


class Projection:
    """A fitted projection: centring, components with a fixed sign, variance shares."""

    def __init__(self, scaler, model, signs: Sequence[float], vec: str):
        self._scaler, self._model, self._signs, self._vec = scaler, model, signs, vec
        self.explained = list(model.explainedVariance.toArray())

    def transform(self, df: DataFrame, out: str = "coords") -> DataFrame:
        moved = self._model.transform(self._scaler.transform(df))
        signs = F.array(*[F.lit(s) for s in self._signs])
        coords = F.zip_with(vector_to_array("_pc"), signs, lambda v, s: v * s)
        return moved.withColumn(out, coords).drop("_centred", "_pc")


def fit_pca(df: DataFrame, vec: str, k: int = 2) -> Projection:
    """PCA of a vector column. The covariance is width x width on the driver: ``fit_wide_pca``
    takes wide sparse vectors. Each component's largest loading is made positive."""
    scaler = StandardScaler(withMean=True, withStd=False, inputCol=vec, outputCol="_centred").fit(df)
    model = PCA(k=k, inputCol="_centred", outputCol="_pc").fit(scaler.transform(df))
    loadings = model.pc.toArray()
    peaks = np.abs(loadings).argmax(axis=0)
    signs = [1.0 if loadings[row, col] >= 0 else -1.0 for col, row in enumerate(peaks)]
    return Projection(scaler, model, signs, vec)


def as_unit_vectors(df: DataFrame, array_col: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(l2_normalise(F.col(array_col))))


def pre_reduce(df: DataFrame, vec: str, width: int, k: int = 50, out: str = "reduced") -> DataFrame:
    """PCA to k dimensions when the vectors are wider; otherwise they pass through. Wide vectors
    stay sparse and need no covariance."""
    if width <= k:
        return df.withColumn(out, vector_to_array(vec))
    fitted = fit_wide_pca(df, vec, k) if width > MOST_COVARIANCE else fit_pca(df, vec, k)
    return fitted.transform(df, out)


# --- silhouette -----------------------------------------------------------------------------


def silhouette(
    df: DataFrame, id_col: str, coords: str, label: str, sample: int = 2000, seed: int = 42,
) -> DataFrame:
    """Mean Euclidean silhouette of a sample of at most ``sample`` points, as one row, over
    all their coordinates.

    The sampled points travel as one bounded array per label and every sampled row measures
    itself against them in place: no pairs are shuffled.
    """
    drawn = exact_sample(df.select(id_col, coords, label), id_col, sample, seed)
    points = cut_lineage(drawn.where(F.col(label).isNotNull()))
    dims = points.agg(F.max(F.size(coords))).first()[0] or 0
    clusters = points.groupBy(label).agg(F.collect_list(coords).alias("members"))
    table = clusters.agg(
        F.collect_list(F.struct(F.col(label).alias("label"), "members"))
    ).scalar()

    def distance(a: Column, b: Column) -> Column:
        squares = [(a[i] - b[i]) * (a[i] - b[i]) for i in range(dims)]
        return F.sqrt(reduce(add, squares, F.lit(0.0)))

    def spread(cluster: Column) -> Column:
        total = F.aggregate(
            cluster["members"], F.lit(0.0), lambda acc, m: acc + distance(F.col(coords), m)
        )
        return F.struct(
            cluster["label"].alias("label"), total.alias("total"),
            F.size(cluster["members"]).alias("size"),
        )

    carried = points.select(F.col(label).alias("_own"), coords, table.alias("_table"))
    measured = carried.select("_own", F.transform("_table", spread).alias("_d"))
    own = F.element_at(F.filter("_d", lambda s: s["label"] == F.col("_own")), 1)
    others = F.transform(
        F.filter("_d", lambda s: s["label"] != F.col("_own")), lambda s: s["total"] / s["size"]
    )
    a = own["total"] / F.nullif(own["size"] - 1, F.lit(0))
    b = F.array_min(others)
    value = F.when(own["size"] > 1, (b - a) / F.nullif(F.greatest(a, b), F.lit(0.0))).otherwise(0.0)
    return measured.select(F.coalesce(value, F.lit(0.0)).alias("_s")).agg(
        F.avg("_s").alias("silhouette"), F.count(F.lit(1)).alias("points")
    )


def silhouette_squared(df: DataFrame, vec: str, label: str) -> float:
    """Silhouette over squared distances, linear in the rows, for whole tables."""
    return ClusteringEvaluator(
        predictionCol=label, featuresCol=vec, metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    ).evaluate(df)


# --- neighbour graph ------------------------------------------------------------------------


def knn_graph(
    df: DataFrame, id_col: str, vec: str, k: int = 15, block_rows: int = 4096
) -> DataFrame:
    """Exact cosine neighbours: (id, neighbour, similarity, place), k per row, ties by id.

    Rows are hashed into blocks of about ``block_rows``; each pair of blocks is one small
    matrix product that hands on only its k best per row, so memory per task is bounded by
    the block size whatever the data look like, and no row pairs are ever emitted.
    """
    unit = df.select(F.col(id_col).alias("id"), l2_normalise(F.col(vec)).alias("u"))
    blocks = max(1, math.ceil(unit.count() / block_rows))
    placed = unit.withColumn("_b", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = placed.select("id", "u", F.col("_b").alias("qb"), every.alias("cb"))
    candidates = placed.select("id", "u", F.col("_b").alias("cb"), every.alias("qb"))

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = {"id": [], "neighbour": [], "similarity": []}
        if len(q) and len(c):
            c = c.sort_values("id", ignore_index=True)
            left, right = np.stack(q["u"].to_numpy()), np.stack(c["u"].to_numpy())
            ids, mine = c["id"].to_numpy(), q["id"].to_numpy()
            for start in range(0, len(q), 512):
                sims = left[start:start + 512] @ right.T
                sims[mine[start:start + 512, None] == ids[None, :]] = -np.inf
                order = np.argsort(-sims, axis=1, kind="stable")[:, :k]
                found = np.take_along_axis(sims, order, axis=1)
                keep = np.isfinite(found)
                out["id"].append(np.repeat(mine[start:start + 512], keep.sum(axis=1)))
                out["neighbour"].append(ids[order[keep]])
                out["similarity"].append(found[keep])
        return pd.DataFrame({name: np.concatenate(part) if part else [] for name, part in out.items()})

    kind = unit.schema["id"].dataType.simpleString()
    nearest = (
        queries.groupBy("qb", "cb")
        .cogroup(candidates.groupBy("qb", "cb"))
        .applyInPandas(best, f"id {kind}, neighbour {kind}, similarity double")
    )
    place = F.row_number().over(W.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    return nearest.withColumn("place", place).where(F.col("place") <= k)


def spectral_layout(edges: DataFrame, rounds: int = 5, steps: int = 3) -> DataFrame:
    """Two coordinates per node: the slowest modes of a lazy random walk on the symmetrised
    graph, by power iteration. The constant mode is deflated and the two are kept orthogonal
    after every ``rounds``; lineage is cut there.
    """
    weight = F.greatest(F.col("similarity"), F.lit(0.0)).alias("w")
    both = edges.select("id", "neighbour", weight).unionByName(
        edges.select(F.col("neighbour").alias("id"), F.col("id").alias("neighbour"), weight)
    )
    links = cut_lineage(both.groupBy("id", "neighbour").agg(F.max("w").alias("w")))

    def start(seed: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1000003)) / 1000003.0

    state = links.groupBy("id").agg(F.sum("w").alias("deg")).select(
        "id", "deg", start(1).alias("a"), start(2).alias("b")
    )
    for _ in range(rounds):
        for _ in range(steps):
            pulled = (
                links.join(state.select(F.col("id").alias("neighbour"), "a", "b"), "neighbour")
                .groupBy("id")
                .agg(F.sum(F.col("w") * F.col("a")).alias("_a"), F.sum(F.col("w") * F.col("b")).alias("_b"))
            )
            walk = [
                ((F.col(c) + F.col(f"_{c}") / F.nullif("deg", F.lit(0.0))) / 2).alias(c) for c in ("a", "b")
            ]
            state = state.join(pulled, "id").select("id", "deg", *walk)
        state = _orthonormal(cut_lineage(state))
    return state.select("id", F.col("a").alias("x"), F.col("b").alias("y"))


def _orthonormal(state: DataFrame) -> DataFrame:
    d, a, b = F.col("deg"), F.col("a"), F.col("b")
    sums = state.agg(
        F.struct(
            F.sum(d).alias("n"), F.sum(d * a).alias("a"), F.sum(d * b).alias("b"),
            F.sum(d * a * a).alias("aa"), F.sum(d * a * b).alias("ab"), F.sum(d * b * b).alias("bb"),
        )
    ).scalar()
    moments = F.col("_m")
    mean_a, mean_b = moments["a"] / moments["n"], moments["b"] / moments["n"]
    aa = moments["aa"] - moments["a"] * mean_a
    ab = moments["ab"] - moments["a"] * mean_b
    bb = moments["bb"] - moments["b"] * mean_b
    lean = ab / F.nullif(aa, F.lit(0.0))
    rest = F.sqrt(F.greatest(bb - ab * lean, F.lit(1e-300)))
    first = (a - mean_a) / F.sqrt(F.greatest(aa, F.lit(1e-300)))
    second = ((b - mean_b) - lean * (a - mean_a)) / rest
    return state.withColumn("_m", sums).select("id", "deg", first.alias("a"), second.alias("b"))


def labelled_coordinates(
    coords: DataFrame, labels: DataFrame, id_col: str, name: str
) -> DataFrame:
    """Coordinates with the display label of each point."""
    return coords.join(labels.select(id_col, name), id_col)
