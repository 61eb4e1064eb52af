"""Nearest neighbours over whole tables: an inverted index of cells, and the exact search."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows a cell should hold, cells at most (16 MB of 64-wide centroids), rows they are learnt from.
CELL_ROWS, MOST_CELLS, TRAINING_ROWS = 256, 1 << 16, 1 << 17
#: Cells of the first level, rows of it are learnt from.
COARSE, COARSE_ROWS = 256, 1 << 14
#: Stored rows and queries that meet in one task, and similarities held at once (32 MB). A query's
#: best are handed on once for each shard it goes to, so shards are as large as memory allows.
SHARD_ROWS, QUERY_ROWS, HELD = 1 << 16, 1 << 14, 1 << 22
#: Cells looked at, at the least, and rows whose true neighbours tell how many it takes.
LEAST_PROBES, TUNING_ROWS = 16, 256
#: A vector that more than one row in so many has is joined by broadcast.
HOT_SHARE = 1000


# --- within a task ----------------------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    """Rows of an Arrow or pandas column of number lists as doubles."""
    if isinstance(column, (pa.Array, pa.ChunkedArray)):
        column = column.to_numpy(zero_copy_only=False)
    return np.stack([np.asarray(v, dtype=np.float64) for v in column]) if len(column) else np.zeros((0, 0))


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best(similarity: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the k largest finite values of each row, largest first; of equal ones
    the first places."""
    if similarity.shape[1] > k:
        least = np.partition(similarity, -k, axis=1)[:, -k, None]
        row, place = np.nonzero((similarity >= least) & np.isfinite(similarity))
    else:
        row, place = np.nonzero(np.isfinite(similarity))
    order = np.lexsort((place, -similarity[row, place], row))
    row, place = row[order], place[order]
    keep = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[keep], place[keep]


def _search(q: pd.DataFrame, c: pd.DataFrame, k: int, probed: bool) -> pd.DataFrame:
    """The k best stored rows of each query, of the cells it asks for where ``probed``."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(q) and len(c):
        c = c.sort_values("id", ignore_index=True)
        left, right = _unit(_matrix(q["v"])), _unit(_matrix(c["v"]))
        mine, ids = q["id"].to_numpy(), c["id"].to_numpy()
        if probed:
            local, cells = pd.factorize(c["cell"])
            place = {cell: i for i, cell in enumerate(cells)}
        size = max(1, min(512, HELD // len(c)))
        for start in range(0, len(q), size):
            part = slice(start, start + size)
            sims = left[part] @ right.T
            sims[mine[part, None] == ids[None, :]] = -np.inf
            if probed:
                asked = np.zeros((len(sims), len(place)), bool)
                for row, wanted in enumerate(q["cells"].iloc[part]):
                    asked[row, [place[x] for x in wanted if x in place]] = True
                sims[~asked[:, local]] = -np.inf
            row, at = _best(sims, k)
            out.append((mine[part][row], ids[at], sims[row, at]))
    parts = [np.concatenate(x) for x in zip(*out)] if out else [[], [], []]
    return pd.DataFrame(dict(zip(("id", "neighbour", "similarity"), parts)))


# --- cells --------------------------------------------------------------------------------------


def _pieces(rows: int, width: int) -> Iterator[slice]:
    """Cuts of so many rows that HELD numbers or fewer, a row's at least, are held at once."""
    step = max(1, min(rows, HELD // max(width, 1)))
    return (slice(start, start + step) for start in range(0, rows, step))


def _nearest(unit: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and the cosine to it."""
    home, best = np.zeros(len(unit), np.int64), np.zeros(len(unit))
    for part in _pieces(len(unit), len(centroids)):
        sims = unit[part] @ centroids.T
        home[part], best[part] = sims.argmax(axis=1), sims.max(axis=1)
    return home, best


def spherical_means(unit: np.ndarray, cells: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Unit centroids by Lloyd's rounds; a cell that loses its rows takes over the worst-held row."""
    rng = np.random.default_rng(seed)
    cells = min(cells, len(unit))
    centroids = unit[rng.choice(len(unit), cells, replace=False)]
    for _ in range(rounds):
        home, best = _nearest(unit, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, unit)
        empty = np.flatnonzero(np.bincount(home, minlength=cells) == 0)
        sums[empty] = unit[np.argsort(best, kind="stable")[: len(empty)]]
        centroids = _unit(sums)
    return centroids


@dataclass
class Cells:
    """An index over vectors: centroids, the shards their rows lie in, the cells to look at."""

    centroids: np.ndarray
    shards: list[list[int]] | None = None
    probes: int = LEAST_PROBES

    def ranked(self, vectors: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` nearest cells of each row, nearest first."""
        unit = _unit(vectors)
        if most == 1:
            return _nearest(unit, self.centroids)[0][:, None]
        out = np.empty((len(unit), min(most, len(self.centroids))), np.int64)
        for part in _pieces(len(unit), len(self.centroids)):
            out[part] = np.argsort(-(unit[part] @ self.centroids.T), axis=1, kind="stable")[:, :most]
        return out


def fit_cells(rows: DataFrame, n: int, seed: int = 42) -> Cells:
    """Cells of about CELL_ROWS rows, learnt in two levels from a sample of TRAINING_ROWS rows: few
    coarse cells, then each split according to its share of the rows, so full ones split most."""
    wanted = max(1, min(MOST_CELLS, math.ceil(n / CELL_ROWS)))
    share = min(1.0, 1.2 * TRAINING_ROWS / max(n, 1))
    sample = rows.sample(share, seed=seed).limit(TRAINING_ROWS).select("id", "v")
    if wanted <= COARSE:
        drawn = _matrix(sample.limit(COARSE_ROWS).select("v").toArrow().column("v"))
        return Cells(spherical_means(_unit(drawn), wanted, seed=seed))
    sample = cut_lineage(sample)
    top = spherical_means(_unit(_matrix(sample.limit(COARSE_ROWS).select("v").toArrow().column("v"))), COARSE, seed=seed)
    total = sample.count()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = Cells(top).ranked(_matrix(batch.column("v")), 1)[:, 0]
            yield pa.record_batch([pa.array(home), batch.column("v")], ["coarse", "v"])

    def split(group: pd.DataFrame) -> pd.DataFrame:
        parts = max(1, round(wanted * len(group) / total))
        found = spherical_means(_unit(_matrix(group["v"])), parts, seed=seed)
        return pd.DataFrame({"c": list(found)})

    kind = rows.schema["v"].dataType.simpleString()
    fine = sample.mapInArrow(placed, f"coarse long, v {kind}").groupBy("coarse").applyInPandas(split, "c array<double>")
    return Cells(_matrix(fine.toArrow().column("c")))


def _homes(rows: DataFrame, cells: Cells) -> DataFrame:
    """``id, v, cell``: each row's nearest cell."""
    shared = rows.sparkSession.sparkContext.broadcast(cells.centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                home = Cells(shared.value).ranked(_matrix(part.column("v")), 1)[:, 0]
                yield pa.record_batch([*part.columns, pa.array(home.astype(np.int32))], ["id", "v", "cell"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "v").mapInArrow(run, f"id {kinds['id']}, v {kinds['v']}, cell int")


def _shards(sizes: dict[int, int], centroids: np.ndarray) -> list[list[int]]:
    """For each cell the shards its rows are dealt to: near cells share one, a cell larger than
    a shard has several. At most MOST_CELLS entries, whatever the rows."""
    coarse = spherical_means(centroids, max(1, math.isqrt(len(centroids))))
    order = np.argsort((centroids @ coarse.T).argmax(axis=1), kind="stable").tolist()
    shards: list[list[int]] = [[] for _ in centroids]
    current, held = 0, 0
    for cell in order:
        size = sizes.get(cell, 0)
        if size > SHARD_ROWS:
            many = math.ceil(size / SHARD_ROWS)
            current += 1 if held else 0
            shards[cell] = list(range(current, current + many))
            current, held = current + many, 0
            continue
        if held + size > SHARD_ROWS:
            current, held = current + 1, 0
        shards[cell], held = [current], held + size
    return shards


def _tuned(rows: DataFrame, homes: DataFrame, cells: Cells, k: int, recall: float) -> int:
    """How many nearest cells hold ``recall`` of the true neighbours of TUNING_ROWS rows."""
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(TUNING_ROWS)
    truth = exact_neighbours(drawn, rows, k)
    near = truth.join(homes.select(F.col("id").alias("neighbour"), "cell"), "neighbour").select("id", "cell").toPandas()
    if near.empty:
        return LEAST_PROBES
    vectors = drawn.toPandas()
    ranked = cells.ranked(_matrix(vectors["v"]), len(cells.centroids))
    place = np.empty_like(ranked)
    np.put_along_axis(place, ranked, np.arange(ranked.shape[1])[None, :].repeat(len(ranked), 0), axis=1)
    row = {x: i for i, x in enumerate(vectors["id"])}
    needed = np.sort(place[[row[x] for x in near["id"]], near["cell"]])
    return max(LEAST_PROBES, int(needed[min(len(needed) - 1, math.ceil(recall * len(needed)))]) + 1)


# --- searches -------------------------------------------------------------------------------------


def _top(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def _schema(rows: DataFrame) -> str:
    kind = rows.schema["id"].dataType.simpleString()
    return f"id {kind}, neighbour {kind}, similarity double"


def _each(count: Column) -> Column:
    """A row for each number below ``count``."""
    return F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1))


def exact_neighbours(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """``id, neighbour, similarity, place``: the k rows of largest cosine for a stated set of
    queries (``id, v`` both). Each block of queries meets each block of rows in one product,
    which hands on its k best per query."""
    blocks = max(1, math.ceil(rows.count() / SHARD_ROWS))
    parts = max(1, math.ceil(queries.count() / QUERY_ROWS))
    asked = queries.select(
        "id", "v", F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"),
        _each(F.lit(blocks)).alias("shard"),
    )
    stored = rows.select(
        "id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("shard"),
        _each(F.lit(parts)).alias("part"),
    )
    found = asked.groupBy("shard", "part").cogroup(stored.groupBy("shard", "part")).applyInPandas(
        lambda q, c: _search(q, c, k, False), _schema(rows)
    )
    return _top(found, k)


def _asked(rows: DataFrame, cells: Cells) -> DataFrame:
    """``id, v, shard, cells``: a query goes once to each shard that holds a cell it looks at."""
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        step = max(1, min(1024, HELD // (8 * index.probes)))  # lists of numbers take more than arrays
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                who, shard, wanted = [], [], []
                for row, near in enumerate(index.ranked(_matrix(part.column("v")), index.probes).tolist()):
                    by_shard: dict[int, list[int]] = {}
                    for cell in near:
                        for s in index.shards[cell]:
                            by_shard.setdefault(s, []).append(cell)
                    for s, asked in by_shard.items():
                        who.append(row)
                        shard.append(s)
                        wanted.append(asked)
                taken = pa.array(who, pa.int64())
                yield pa.record_batch([
                    part.column("id").take(taken), part.column("v").take(taken), pa.array(shard, pa.int64()),
                    pa.array(wanted, pa.list_(pa.int32())),
                ], ["id", "v", "shard", "cells"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("id", "v").mapInArrow(run, f"id {kinds['id']}, v {kinds['v']}, shard long, cells array<int>")


def indexed_neighbours(queries: DataFrame, rows: DataFrame, k: int, recall: float = 0.95, seed: int = 42) -> DataFrame:
    """As ``exact_neighbours``, but each query only looks into the cells nearest to it.

    Every row is stored in its nearest cell. How many cells are looked at is read off the true
    neighbours of TUNING_ROWS rows, so that ``recall`` of them are found. Queries of a shard are
    split into parts, so a task holds SHARD_ROWS stored rows and QUERY_ROWS queries or so. The
    driver holds MOST_CELLS centroids and a number for each shard, which is a row in SHARD_ROWS.
    """
    n = rows.count()
    if not n:
        return _top(rows.sparkSession.createDataFrame([], _schema(rows)), k)
    cells = fit_cells(rows, n, seed)
    homes = cut_lineage(_homes(rows, cells))
    cells.probes = min(len(cells.centroids), _tuned(rows, homes, cells, k, recall))
    sizes = {r.cell: r["count"] for r in homes.groupBy("cell").count().collect()}  # MOST_CELLS rows at most
    cells.shards = _shards(sizes, cells.centroids)
    asked = cut_lineage(_asked(queries, cells))
    crowd = {r.shard: r["count"] for r in asked.groupBy("shard").count().collect()}
    parts = {s: math.ceil(c / QUERY_ROWS) for s, c in crowd.items()}
    plan = [(cell, len(s), s[0], [parts.get(x, 0) for x in s]) for cell, s in enumerate(cells.shards) if s]
    table = F.broadcast(rows.sparkSession.createDataFrame(plan, "cell int, many int, first long, parts array<int>"))
    stored = homes.join(table, "cell").withColumn("_at", F.pmod(F.xxhash64("id"), F.col("many")))
    stored = stored.withColumn("_parts", F.get("parts", F.col("_at").cast("int"))).where("_parts > 0")
    stored = stored.select(
        "id", "v", "cell", (F.col("first") + F.col("_at")).alias("shard"),
        _each(F.col("_parts")).alias("part"),
    )
    many = F.broadcast(rows.sparkSession.createDataFrame([(s, p) for s, p in parts.items()], "shard long, many int"))
    asked = asked.join(many, "shard").withColumn("part", F.pmod(F.xxhash64("id", F.lit(7)), F.col("many")))
    found = asked.groupBy("shard", "part").cogroup(stored.groupBy("shard", "part")).applyInPandas(
        lambda q, c: _search(q, c, k, True), _schema(rows)
    )
    return _top(found, k)


def neighbour_graph(df: DataFrame, id_col: str, vec: str, k: int = 15, recall: float = 0.95, seed: int = 42) -> DataFrame:
    """``id, neighbour, similarity, place``: about the k rows of largest cosine for every row of
    ``df``, of equal ones the smallest ids, over all rows.

    Rows with the same vector are searched once: a class of equal vectors stands for its k + 1
    smallest ids, which is as many as any row can need, so no number of copies makes pairs. A
    zero vector is alike to nothing (0); rows without a vector or id have no neighbours.
    """
    rows = df.select(F.col(id_col).alias("row"), F.col(vec).alias("v")).where("row is not null and v is not null")
    first = F.row_number().over(W.partitionBy("v").orderBy("row"))
    few = rows.withColumn("_n", first).where(F.col("_n") <= k + 1)
    classes = cut_lineage(few.groupBy("v").agg(F.min("row").alias("id"), F.sort_array(F.collect_list("row")).alias("members")))
    found = indexed_neighbours(classes.select("id", "v"), classes.select("id", "v"), k, recall, seed)
    # a class is its own nearest one
    length = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x * x)
    own = classes.select("id", F.col("id").alias("neighbour"), F.when(length > 0, 1.0).otherwise(0.0).alias("similarity"))
    near = found.select("id", "neighbour", "similarity").union(own)
    near = near.join(classes.select(F.col("id").alias("neighbour"), "members"), "neighbour")
    offered = near.select("id", "similarity", F.explode("members").alias("neighbour"))
    best = F.row_number().over(W.partitionBy("id").orderBy(F.desc("similarity"), "neighbour"))
    offered = offered.withColumn("_n", best).where(F.col("_n") <= k + 1)
    lists = offered.groupBy("id").agg(F.sort_array(F.collect_list(F.struct((-F.col("similarity")).alias("s"), "neighbour"))).alias("near"))
    heads = cut_lineage(classes.select("id", "v").join(lists, "id").select("v", "near"))
    # every copy takes its class's list without itself; classes of one row in HOT_SHARE or more,
    # of which there can't be many, come by broadcast, so their copies stay where they are
    sizes = rows.groupBy("v").agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(heads.join(sizes, "v").where(F.col("_n") > rows.count() / HOT_SHARE).select("v", "near"))
    listed = rows.join(hot, "v").unionByName(rows.join(hot.select("v"), "v", "left_anti").join(heads, "v"))
    linked = listed.select(F.col("row").alias("id"), F.slice(F.filter("near", lambda x: x["neighbour"] != F.col("row")), 1, k).alias("near"))
    out = linked.select("id", F.posexplode("near").alias("place", "x"))
    return out.select("id", F.col("x.neighbour").alias("neighbour"), (-F.col("x.s")).alias("similarity"), (F.col("place") + 1).alias("place"))


def recall_of(graph: DataFrame, truth: DataFrame) -> DataFrame:
    """``queries, pairs, recall``: the share of the true neighbours that the graph has."""
    pairs = truth.select("id", "neighbour")
    met = pairs.join(graph.select("id", "neighbour", F.lit(1).alias("_hit")), ["id", "neighbour"], "left")
    return met.agg(F.count_distinct("id").alias("queries"), F.count(F.lit(1)).alias("pairs"), F.avg(F.coalesce("_hit", F.lit(0))).alias("recall"))
