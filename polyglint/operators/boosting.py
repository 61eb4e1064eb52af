"""Softmax gradient boosting over binned features: one Spark job adds up the histograms of all
nodes that grow at once, of all classes' trees."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir

#: Values that bin edges are read from, bytes of binned rows in a block, and of the histograms
#: that one job adds up. None grows with the rows.
SAMPLE_VALUES, BLOCK_BYTES, HISTOGRAM_BYTES = 1 << 22, 1 << 22, 1 << 28
#: Features whose histograms travel together, and rounds between checkpoints.
CHUNK, KEEP_ROUNDS = 512, 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Tree:
    """Nodes in order of making: leaves have feature -1. Rows go left up to and with ``bin``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, at: int, values: tuple[float, float]) -> int:
        """The right child stands behind the left one."""
        self.feature[node], self.bin[node], self.left[node] = feature, at, len(self.value)
        for v in values:
            self.feature.append(-1)
            self.bin.append(0)
            self.left.append(0)
            self.value.append(v)
        return self.left[node]

    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)

    def places(self, binned: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        feature, at, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        node = np.zeros(len(binned), np.int64)
        moving = np.arange(len(binned)) if feature[0] >= 0 else np.zeros(0, np.int64)
        while len(moving):
            here = node[moving]
            node[moving] = left[here] + (binned[moving, feature[here]] > at[here])
            moving = moving[feature[node[moving]] >= 0]
        return node


@dataclass(frozen=True)
class Split:
    """The best cut of a node: gain, feature, bin, and the values its halves would have."""

    gain: float
    feature: int
    bin: int
    values: tuple[float, float]


def _softmax(margins: np.ndarray) -> np.ndarray:
    powers = np.exp(margins - margins.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _drawn(keys: np.ndarray, turn: int, share: float) -> np.ndarray:
    """A share of the rows, another one each round, the same wherever a row lies."""
    if share >= 1:
        return np.ones(len(keys), bool)
    x = (keys ^ np.uint64(turn + 1)) * _MIX
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return (x >> np.uint64(40)).astype(np.float64) / (1 << 24) < share


# --- what a task does with a block (keys, binned, labels, counts, margins) -------------------------


def _advanced(block, trees: list[Tree]):
    """The block with the margins that a round's trees add."""
    *rest, margins = block
    binned, margins = rest[1], margins.copy()
    for c, tree in enumerate(trees):
        margins[:, c] += np.array(tree.value)[tree.places(binned)]
    return *rest, margins


def _histograms(block, plan: list[tuple[int, Tree, list[int], np.ndarray]], turn: int, bins: int, share: float, first: bool):
    """((class, chunk), sums of gradients and curvatures by node, feature and bin)."""
    keys, binned, labels, counts, margins = block
    chances = _softmax(margins)
    if first:
        own = np.maximum(chances[np.arange(len(labels)), labels], 1e-300)
        yield ("loss", 0), np.array([-(counts * np.log(own)).sum(), counts.sum()])
    taken = _drawn(keys, turn, share)
    for c, tree, nodes, features in plan:
        place = np.full(len(tree.value), -1)
        place[nodes] = np.arange(len(nodes))
        slot = place[tree.places(binned)]
        rows = np.flatnonzero(taken & (slot >= 0))
        p = chances[rows, c]
        gradient, curvature = counts[rows] * (p - (labels[rows] == c)), counts[rows] * np.maximum(2 * p * (1 - p), 1e-16)
        for chunk in range(0, len(features), CHUNK):
            part = features[chunk : chunk + CHUNK]
            cells = (slot[rows, None] * len(part) + np.arange(len(part))) * bins + binned[np.ix_(rows, part)]
            shape = (2, len(nodes), len(part), bins)
            sums = np.empty(shape)
            for i, weight in enumerate((gradient, curvature)):
                sums[i] = np.bincount(cells.ravel(), np.repeat(weight, len(part)), minlength=sums[i].size).reshape(shape[1:])
            yield (c, chunk), sums


def _best_splits(sums: np.ndarray, features: np.ndarray, rate: float, l2: float, least: float):
    """For each node the best cut within a chunk of features, and the node's own value."""
    g, h = sums
    left_g, left_h = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
    total_g, total_h = g[:, 0].sum(axis=1), h[:, 0].sum(axis=1)
    right_g, right_h = total_g[:, None, None] - left_g, total_h[:, None, None] - left_h
    gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - (total_g**2 / (total_h + l2))[:, None, None]
    gain[(left_h < least) | (right_h < least)] = -np.inf
    found = []
    for node in range(len(g)):
        at = int(np.argmax(gain[node]))
        f, b = divmod(at, gain.shape[2])
        values = (
            -rate * left_g[node, f, b] / (left_h[node, f, b] + l2), -rate * right_g[node, f, b] / (right_h[node, f, b] + l2),
        )
        found.append(Split(float(gain[node, f, b]), int(features[f]), b, (float(values[0]), float(values[1]))))
    return found


# --- growth -----------------------------------------------------------------------------------------


@dataclass
class HistogramBoosting:
    """Boosted trees for classes 0 to n - 1, a tree for each class in each round.

    Without ``leaves`` trees grow level by level to ``depth``; with it they grow best first: the
    leaf of largest gain is cut next, until there are ``leaves`` of them, at any depth. Each
    round sees a share ``rows`` of the rows, each tree a share ``cols`` of the features.
    """

    rounds: int = 300
    depth: int = 6
    rate: float = 0.1
    rows: float = 0.8
    cols: float = 0.8
    leaves: int | None = None
    bins: int = 64
    l2: float = 1.0
    least: float = 1.0  # curvature either half of a cut must have
    seed: int = 42
    #: best-first: leaves whose halves are summed up beforehand, as they may be cut next
    ahead: int = 32
    features: str = "features"
    label: str = "label"

    def fit(self, df: DataFrame) -> BoostedModel:
        """Rows without a label or features aren't learnt from; no rows are an error."""
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        rows = self._rows(df).where("x is not null and label is not null")
        head = rows.agg(F.max("label"), F.max(F.size("x")), F.count(F.lit(1))).first()
        if not head[2]:
            raise ValueError("no rows to learn from")
        classes, width = int(head[0]) + 1, int(head[1])
        edges = self._edges(rows, width, head[2])
        blocks = self._blocks(rows, edges, classes).persist(StorageLevel.MEMORY_AND_DISK)
        rng = np.random.default_rng(self.seed)
        model = BoostedModel(self, edges, classes)
        older = []
        for turn in range(self.rounds):
            wanted = max(1, round(self.cols * width))
            features = [np.sort(rng.choice(width, wanted, replace=False)) for _ in range(classes)]
            trees, loss = self._grow(blocks, turn, features)
            model.losses.append(loss)
            model.trees.append(trees)
            if all(t.leaves() == 1 for t in trees):
                break  # nothing is left to cut
            older.append(blocks)
            blocks = blocks.map(lambda b, trees=trees: _advanced(b, trees)).persist(StorageLevel.MEMORY_AND_DISK)
            if turn % KEEP_ROUNDS == KEEP_ROUNDS - 1:
                blocks.checkpoint()
            # a round's first job writes its margins from the last ones, then those can go
            for done in older[:-1]:
                done.unpersist()
            older = older[-1:]
        for done in (*older, blocks):
            done.unpersist()
        return model

    def _rows(self, df: DataFrame) -> DataFrame:
        kind = df.schema[self.features].dataType.typeName()
        x = F.col(self.features) if kind == "array" else vector_to_array(self.features)
        label = F.col(self.label).cast("int") if self.label in df.columns else F.lit(None).cast("int")
        return df.select(F.transform(x, lambda v: v.cast("double")).alias("x"), label.alias("label"))

    def _edges(self, rows: DataFrame, width: int, n: int) -> list[np.ndarray]:
        """Up to bins - 1 cuts for each feature, between values of a bounded sample."""
        most = max(256, SAMPLE_VALUES // max(width, 1))
        drawn = rows.sample(min(1.0, 1.2 * most / n), seed=self.seed).limit(most) if n > most else rows
        x = np.stack(drawn.select("x").toArrow().column("x").to_numpy(zero_copy_only=False))
        edges = []
        for column in x.T:
            values = np.unique(column[~np.isnan(column)])
            if len(values) > self.bins:
                values = np.unique(np.quantile(column[~np.isnan(column)], np.linspace(0, 1, self.bins), method="nearest"))
            edges.append((values[:-1] + values[1:]) / 2)
        return edges

    def _blocks(self, rows: DataFrame, edges: list[np.ndarray], classes: int):
        """Rows of equal features and label are drawn together and get the same margins, so they
        are one row with a count; what is left lies in a partition for every BLOCK_BYTES or so."""
        width = len(edges)
        most = max(256, BLOCK_BYTES // max(width, 1))

        def bin_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, most):
                    part = batch.slice(start, most)
                    binned = pa.py_buffer(binned_by(edges, part.column("x")).tobytes())
                    binned = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(part), [None, binned])
                    yield pa.record_batch([part.column("key"), binned.cast(pa.binary()), part.column("label")], ["key", "binned", "label"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, most):
                    part = batch.slice(start, most)
                    binned = b"".join(part.column("binned").to_pylist())
                    numbers = [part.column(c).to_numpy().astype(np.int64).tobytes() for c in ("key", "label", "count")]
                    yield pa.record_batch([pa.array([x], pa.binary()) for x in (binned, *numbers)], ["binned", "keys", "labels", "counts"])

        def opened(row):
            keys, labels, counts = (np.frombuffer(x, np.int64) for x in row[1:])
            binned = np.frombuffer(row[0], np.uint8).reshape(len(labels), -1)
            return keys.view(np.uint64), binned, labels, counts.astype(np.float64), np.zeros((len(labels), classes))

        keyed = rows.select(F.xxhash64("x", "label").alias("key"), "x", "label")
        kinds = keyed.mapInArrow(bin_, "key long, binned binary, label int").groupBy("key", "binned", "label").count()
        kinds = cut_lineage(kinds)
        parts = math.ceil(kinds.count() * (width + 8 * classes + 24) / BLOCK_BYTES)
        # the arrays stay whole from round to round, so they are kept as they are, not as rows
        return kinds.coalesce(max(1, parts)).mapInArrow(run, "binned binary, keys binary, labels binary, counts binary").rdd.map(opened)

    def _evaluate(self, blocks, plan, turn: int, first: bool):
        """The best split of each (class, node) in ``plan``, and the loss where ``first``."""
        bins, share, rate, l2, least = self.bins, self.rows, self.rate, self.l2, self.least
        wide = {c: features for c, _, _, features in plan}

        def count(part):
            sums = {}
            for block in part:
                for key, value in _histograms(block, plan, turn, bins, share, first):
                    sums[key] = sums[key] + value if key in sums else value
            return sums.items()

        def best(item):
            (c, chunk), sums = item
            if c == "loss":
                return "loss", sums[0] / sums[1]
            return c, _best_splits(sums, wide[c][chunk : chunk + CHUNK], rate, l2, least)

        parts = max(1, min(blocks.getNumPartitions(), len(plan)))
        sums = blocks.mapPartitions(count)
        # the sums of a lone partition are whole, so they needn't be shuffled
        sums = sums if blocks.getNumPartitions() == 1 else sums.reduceByKey(np.add, parts)
        found = sums.map(best).collect()
        splits: dict[tuple[int, int], Split] = {}
        loss = None
        nodes = {c: n for c, _, n, _ in plan}
        for c, value in sorted(found, key=lambda x: str(x[0])):
            if c == "loss":
                loss = float(value)
                continue
            for node, split in zip(nodes[c], value):
                known = splits.get((c, node))
                if known is None or (split.gain, -split.feature) > (known.gain, -known.feature):
                    splits[c, node] = split
        return splits, loss

    def _batched(self, blocks, trees, wanted: dict[int, list[int]], features, turn: int, first: bool):
        """As ``_evaluate``, in as many jobs as the bound on histograms asks for."""
        each = 16 * self.bins * len(features[0])
        most = max(1, HISTOGRAM_BYTES // each)
        asked = [(c, node) for c, nodes in wanted.items() for node in nodes]
        splits, loss = {}, None
        for at in range(0, len(asked), most):
            by_class: dict[int, list[int]] = {}
            for c, node in asked[at : at + most]:
                by_class.setdefault(c, []).append(node)
            plan = [(c, trees[c], nodes, features[c]) for c, nodes in by_class.items()]
            found, told = self._evaluate(blocks, plan, turn, first and at == 0)
            splits |= found
            loss = told if loss is None else loss
        return splits, loss

    def _grow(self, blocks, turn: int, features) -> tuple[list[Tree], float]:
        trees = [Tree() for _ in features]
        splits, loss = self._batched(blocks, trees, {c: [0] for c in range(len(trees))}, features, turn, True)
        if self.leaves is None:
            for level in range(self.depth):
                wanted = {}
                for (c, node), split in splits.items():
                    if split.gain > 0:
                        left = trees[c].split(node, split.feature, split.bin, split.values)
                        wanted.setdefault(c, []).extend((left, left + 1))
                if not wanted or level == self.depth - 1:
                    break
                splits, _ = self._batched(blocks, trees, wanted, features, turn, False)
            return trees, loss
        return self._grow_best_first(blocks, turn, features, splits), loss

    def _grow_best_first(self, blocks, turn: int, features, splits) -> list[Tree]:
        """Drafts are cut ahead of need: one job sums up the halves of the draft's leaves of largest
        gain, and the trees take cuts strictly in order of gain as long as the next is known."""
        drafts = [Tree() for _ in features]
        queues = [[(-splits[c, 0].gain, 0)] if splits[c, 0].gain > 0 else [] for c in range(len(drafts))]
        chosen: list[list[int]] = [[] for _ in drafts]
        while True:
            wanted: dict[int, list[int]] = {}
            for c, queue in enumerate(queues):
                while queue and len(chosen[c]) < self.leaves - 1:
                    node = queue[0][1]
                    if drafts[c].feature[node] < 0:
                        break  # its halves aren't known yet
                    heapq.heappop(queue)
                    chosen[c].append(node)
                    left = drafts[c].left[node]
                    for half in (left, left + 1):
                        if splits[c, half].gain > 0:
                            heapq.heappush(queue, (-splits[c, half].gain, half))
                if len(chosen[c]) >= self.leaves - 1:
                    continue
                for node in _next_cuts(drafts[c], {n: splits[c, n].gain for n in range(len(drafts[c].value))}, set(chosen[c]), self.ahead):
                    s = splits[c, node]
                    left = drafts[c].split(node, s.feature, s.bin, s.values)
                    wanted.setdefault(c, []).extend((left, left + 1))
            if not wanted:
                return [_taken(d, set(nodes)) for d, nodes in zip(drafts, chosen)]
            found, _ = self._batched(blocks, drafts, wanted, features, turn, False)
            splits |= found


def _next_cuts(draft: Tree, gains: dict[int, float], cut: set[int], most: int) -> list[int]:
    """Leaves of the draft that may be cut soonest. A leaf's turn comes no sooner than that of the
    nodes above it, so the least gain on the way down from the cut ones decides."""
    reach = {0: gains[0]}
    for node, left in enumerate(draft.left):
        if draft.feature[node] >= 0:
            above = math.inf if node in cut else reach[node]
            for half in (left, left + 1):
                reach[half] = min(above, gains[half])
    able = [n for n, f in enumerate(draft.feature) if f < 0 and gains[n] > 0]
    return heapq.nsmallest(most, able, key=lambda n: (-reach[n], n))


def _taken(draft: Tree, cut: set[int]) -> Tree:
    """The draft with those cuts only."""
    tree, todo = Tree(), [(0, 0)]
    tree.value[0] = draft.value[0]
    while todo:
        old, new = todo.pop()
        if old in cut:
            left = draft.left[old]
            at = tree.split(new, draft.feature[old], draft.bin[old], (draft.value[left], draft.value[left + 1]))
            todo += [(left, at), (left + 1, at + 1)]
    return tree


def binned_by(edges: list[np.ndarray], column: pa.Array) -> np.ndarray:
    """A byte for each value: how many cuts lie below it. Missing values go right."""
    x = np.stack(column.to_numpy(zero_copy_only=False))
    out = np.empty((len(x), len(edges)), np.uint8)
    for f, cuts in enumerate(edges):
        out[:, f] = np.searchsorted(cuts, x[:, f], "left")
    return out


@dataclass
class BoostedModel:
    settings: HistogramBoosting
    edges: list[np.ndarray]
    classes: int
    trees: list[list[Tree]] = field(default_factory=list)
    #: mean loss of the rows learnt from, before each round
    losses: list[float] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction`` and ``probability``; rows without features get nulls."""
        shared = df.sparkSession.sparkContext.broadcast((self.edges, self.trees, self.classes))

        @F.pandas_udf("array<double>")
        def chances(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            edges, rounds, classes = shared.value
            for column in batches:
                known = column.notna().to_numpy()
                out = pd.Series([None] * len(column), dtype=object)
                if known.any():
                    binned = binned_by(edges, pa.array(column[known]))
                    margins = np.zeros((len(binned), classes))
                    for trees in rounds:
                        for c, tree in enumerate(trees):
                            margins[:, c] += np.array(tree.value)[tree.places(binned)]
                    out[known] = pd.Series(list(_softmax(margins)), index=np.flatnonzero(known))
                yield out

        kind = df.schema[self.settings.features].dataType.typeName()
        x = F.col(self.settings.features) if kind == "array" else vector_to_array(self.settings.features)
        p = chances(F.transform(x, lambda v: v.cast("double")))
        out = df.withColumn("_p", p)
        best = F.array_position("_p", F.array_max("_p")) - 1
        known = F.when(F.col("_p").isNotNull(), array_to_vector(F.coalesce("_p", F.array(F.lit(0.0)))))
        return out.withColumn("prediction", best.cast("double")).withColumn("probability", known).drop("_p")
