"""Near-duplicate documents by an LSH forest over MinHash signatures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import release, settle, slices
from .components import components
from .shingles import mixed, shingle_sets

#: Sorted orders, the signature values that make a region of an order, and those that order it.
TREES, ROOT, DEEP = 32, 5, 3
#: Following rows of a region that a row is compared with; larger regions are looked at again.
NEIGHBOURS = 8
#: Bits of the coarse signature in which linked sets may differ: at the least similarity of 0.8
#: more than this many of 128 differ in less than one pair of a million.
MOST_BITS = 33
#: By how much the pairs that a component may confirm in a round grow from round to round.
GROWTH = 64
_SEEDS = mixed(np.arange(1, TREES * ROOT + 129, dtype=np.uint64)) | np.uint64(1)
_SKETCH = (
    "doc_id long, n long, set_a long, set_b long, bits_a long, bits_b long, roots array<long>, deep array<long>"
)


def _sketches(column: pa.Array, width: int) -> list[pa.Array]:
    """Set size, set fingerprint, 128 one-bit minima, and each tree's region and order."""
    codes, offsets = shingle_sets(column, width)
    sizes = np.diff(offsets)
    some = np.flatnonzero(sizes)
    minima = np.zeros((len(sizes), len(_SEEDS)), np.uint64)
    prints = np.zeros((len(sizes), 2), np.uint64)
    if len(some):
        starts = offsets[:-1][some]
        for k, seed in enumerate(_SEEDS):
            minima[some, k] = np.minimum.reduceat(codes * seed, starts)
        prints[some, 0] = np.add.reduceat(mixed(codes), starts)
        prints[some, 1] = np.add.reduceat(mixed(codes + np.uint64(0x632BE59BD9B4E019)), starts)
    used = minima[:, : TREES * ROOT].reshape(-1, TREES, ROOT)
    root = np.broadcast_to(np.arange(TREES, dtype=np.uint64), used.shape[:2]).copy()
    for k in range(ROOT):
        root = mixed(root * np.uint64(0xD6E8FEB86659FD93) + used[:, :, k])
    following = np.roll(used, -1, axis=1)  # the next values of a tree's order
    deep = np.zeros(root.shape, np.uint64)
    for k in range(DEEP):
        deep = (deep << np.uint64(20)) | (mixed(following[:, :, k]) >> np.uint64(44))
    bits = mixed(minima[:, TREES * ROOT :]) & np.uint64(1)
    weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
    halves = [(bits[:, i : i + 64] * weights).sum(axis=1, dtype=np.uint64) for i in (0, 64)]

    def lists(x: np.ndarray) -> pa.Array:
        flat = pa.array(x.ravel().view(np.int64))
        return pa.FixedSizeListArray.from_arrays(flat, TREES).cast(pa.list_(pa.int64()))

    longs = [sizes.astype(np.int64), *[np.ascontiguousarray(x).view(np.int64) for x in (prints[:, 0], prints[:, 1], *halves)]]
    return [*[pa.array(x) for x in longs], lists(root), lists(deep)]


def sketch(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    names = [part.split()[0] for part in _SKETCH.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            yield pa.record_batch([batch.column("doc_id"), *_sketches(batch.column("text"), width)], names)

    return _rows(docs, doc_id, text).mapInArrow(run, _SKETCH)


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


_BESIDE = "a long, b long, gap int, own long, other long"
_PLACED = "root long, deep long, id long, n long, bits_a long, bits_b long, component long"


def _gap(bits_a, other_a, bits_b, other_b):
    return F.bit_count(bits_a.bitwiseXOR(other_a)) + F.bit_count(bits_b.bitwiseXOR(other_b))


def _met(row: list[np.ndarray], fresh: int, percent: int) -> list[np.ndarray]:
    """``a, b, gap, own, other`` of rows that stand at most NEIGHBOURS apart in one region, the
    later one at ``fresh`` or behind, whose sizes and coarse signatures may belong to a link."""
    root, _, ids, n, bits_a, bits_b, component = row
    found = []
    for step in range(1, min(NEIGHBOURS, len(ids) - 1) + 1):
        j = np.arange(max(step, fresh), len(ids))
        i = j - step
        some = (root[i] == root[j]) & (component[i] != component[j])
        some &= np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * percent
        i, j = i[some], j[some]
        gap = np.bitwise_count((bits_a[i] ^ bits_a[j]).view(np.uint64)).astype(np.int32)
        gap += np.bitwise_count((bits_b[i] ^ bits_b[j]).view(np.uint64))
        i, j, gap = (x[gap <= MOST_BITS] for x in (i, j, gap))
        low, high = np.where(ids[i] < ids[j], i, j), np.where(ids[i] < ids[j], j, i)
        found.append([ids[low], ids[high], gap, component[low], component[high]])
    kinds = (np.int64, np.int64, np.int32, np.int64, np.int64)
    return [np.concatenate([f[k] for f in found]) if found else np.zeros(0, kind) for k, kind in enumerate(kinds)]


def _closest(pairs: list[np.ndarray]) -> list[np.ndarray]:
    """Of a batch's pairs those that are the closest of one of their rows."""
    a, b, gap = pairs[:3]
    end, place = np.concatenate([a, b]), np.tile(np.arange(len(a)), 2)
    order = np.lexsort((place, gap[place], end))
    first = np.ones(len(order), bool)
    first[1:] = end[order][1:] != end[order][:-1]
    keep = np.unique(place[order[first]])
    return [x[keep] for x in pairs]


def neighbours(forest: DataFrame, percent: int, closest: bool = False) -> DataFrame:
    """``a, b, gap, own, other``: rows of different components that stand next to each other in a
    region's order, the differing bits of their coarse signatures, and their components.

    In the order of the deeper values the rows that follow have the longest common prefixes, so
    the depth at which rows meet adapts to how full a region is. Rows are dealt by ranges of that
    order, so a region that a huge group of copies shares lies in many tasks; the NEIGHBOURS
    first and last rows of each task are looked at together afterwards. With ``closest`` only
    the closest pairs of each row are handed on.
    """
    names = [part.split()[0] for part in _PLACED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, head = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            row = [np.asarray(batch.column(name)) for name in names]
            edge = [x[: max(0, NEIGHBOURS - head)] for x in row]
            head += len(edge[0])
            if len(edge[0]):
                yield out(None, edge)
            fresh = 0
            if carried is not None:
                fresh = len(carried[0])
                row = [np.concatenate(both) for both in zip(carried, row)]
            pairs = _met(row, fresh, percent)
            if len(pairs[0]):
                yield out(_closest(pairs) if closest else pairs, None)
            carried = [x[-NEIGHBOURS:] for x in row]
        if carried is not None:
            yield out(None, carried)

    def out(pairs: list[np.ndarray] | None, edge: list[np.ndarray] | None) -> pa.RecordBatch:
        rows = len((pairs or edge)[0])
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        left = [pa.array(x) for x in pairs] if pairs else [pa.nulls(rows, kind) for kind in kinds]
        right = [pa.array(x) for x in edge] if edge else [pa.nulls(rows, pa.int64())] * len(names)
        return pa.record_batch([*left, *right], ["a", "b", "gap", "own", "other", *names])

    order = ["root", "deep", "id"]
    dealt = forest.select(*names).repartitionByRange(*order).sortWithinPartitions(*order)
    found = settle(dealt.mapInArrow(run, f"{_BESIDE}, {_PLACED}"), "near-rows")
    inside = found.where("a is not null").select("a", "b", "gap", "own", "other")
    edges = found.where("id is not null").select(*names).distinct()
    following = Window.partitionBy("root").orderBy("deep", "id").rowsBetween(1, NEIGHBOURS)
    met = edges.withColumn("near", F.collect_list(F.struct("id", "n", "bits_a", "bits_b", "component")).over(following))
    met = met.select("id", "n", "bits_a", "bits_b", "component", F.explode("near").alias("x"))
    gap = _gap(F.col("bits_a"), F.col("x.bits_a"), F.col("bits_b"), F.col("x.bits_b"))
    met = met.withColumn("gap", gap).where(
        (F.col("component") != F.col("x.component")) & (F.col("gap") <= MOST_BITS)
        & (F.least("n", "x.n") * 100 >= F.greatest("n", "x.n") * percent)
    )
    forth = F.col("id") < F.col("x.id")
    across = met.select(
        F.least("id", "x.id").alias("a"), F.greatest("id", "x.id").alias("b"), F.col("gap").cast("int").alias("gap"),
        F.when(forth, F.col("component")).otherwise(F.col("x.component")).alias("own"),
        F.when(forth, F.col("x.component")).otherwise(F.col("component")).alias("other"),
    )
    return inside.union(across)


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets share ``percent`` of their union or more."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    names = pairs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", 1_000_000):
            x, at_x = shingle_sets(batch.column("text_a"), width)
            y, at_y = shingle_sets(batch.column("text_b"), width)
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                one, two = x[at_x[i] : at_x[i + 1]], y[at_y[i] : at_y[i + 1]]
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep[i] = shared > 0 and 100 * shared >= percent * (len(one) + len(two) - shared)
            yield batch.select(names).filter(pa.array(keep))

    both = pairs.join(left, "a").join(right, "b").select(*names, "text_a", "text_b")
    return both.mapInArrow(run, pairs.schema)


def _chosen(pairs: DataFrame, each: int) -> DataFrame:
    """Each component's closest pair of every one of ``each`` shares of its pairs."""
    share = F.pmod(F.xxhash64("a", "b"), F.lit(each)).alias("share")
    whole = F.struct("gap", "a", "b", "own", "other")
    sides = [pairs.groupBy(F.col(side).alias("end"), share).agg(F.min(whole).alias("best")) for side in ("own", "other")]
    best = sides[0].union(sides[1]).groupBy("end", "share").agg(F.min("best").alias("best"))
    return best.select("best.*").distinct()


def _untried(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    """The pairs that aren't among those ``tried``."""
    return pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti").select(pairs.columns)


def _renamed(rows: DataFrame, merged: DataFrame, column: str) -> DataFrame:
    """``column`` by what its component has been merged into."""
    joined = rows.join(merged.toDF(column, "_merged"), column, "left")
    return joined.withColumn(column, F.coalesce("_merged", column)).drop("_merged").select(rows.columns)


def unite(pairs: DataFrame, labels: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``labels`` (``id, component``) after all components that a pair links are merged.

    A round confirms each component's closest pair, merges what is linked, and drops the pairs
    that failed or now lie within one component, so of a group of copies about one pair a copy is
    ever looked at. Components left over may confirm GROWTH times as many pairs in each round, so
    many failing pairs between two of them take few rounds; none is left out.
    """
    each = 1
    while not pairs.isEmpty():
        chosen = settle(_chosen(pairs, each), "chosen-pairs")
        links = settle(confirm(chosen, texts, width, percent).select(F.col("own").alias("a"), F.col("other").alias("b")).distinct(), "links")
        if not links.isEmpty():
            merged = components(links)
            labels = settle(_renamed(labels, merged, "component"), "labels")
            pairs = _renamed(_renamed(pairs, merged, "own"), merged, "other").where("own <> other")
        pairs = settle(_untried(pairs, chosen), "open-pairs")
        each *= GROWTH
    return labels


def _crowded(forest: DataFrame) -> DataFrame:
    """``root`` of the regions that hold more rows than a row is compared with."""
    sizes = forest.groupBy("root").agg(F.count("*").alias("size"))
    return sizes.where(F.col("size") > NEIGHBOURS + 1).select("root")


def _left_over(crowded: DataFrame, labels: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of different components inside crowded regions that may still be linked.

    The rows of a region's largest component are linked already; all others meet every row with
    which they share a rare shingle. With shingles in order of rising frequency, two sets that
    share ``percent`` of their union have their first common shingle at places behind which
    enough of both sets follows, so shingles further back needn't be joined. That is exact, and
    shingles that a whole group of copies has stand too far back to pair all of them.
    """
    named = crowded.select("root", "id").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = settle(named, "crowded-rows")
    sizes = named.groupBy("root", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("root").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
    largest = settle(largest.where("parts > 1").select("root", "main"), "main-components")
    members = named.join(largest, "root").groupBy("id").agg(
        F.first("component").alias("component"), F.bool_or(F.col("component") != F.col("main")).alias("minor")
    )
    members = settle(members, "split-members")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1_000_000):
            codes, offsets = shingle_sets(batch.column("text"), width)
            sizes = np.diff(offsets)
            ids = batch.column("id").take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            yield pa.record_batch([ids, pa.array(np.repeat(sizes, sizes)), pa.array(codes.view(np.int64))], ["id", "n", "code"])

    spelt = texts.join(members, texts["doc_id"] == members["id"]).select("id", "text").mapInArrow(spell, "id long, n long, code long")
    spelt = settle(spelt, "member-shingles")
    common = settle(spelt.groupBy("code").agg(F.count("*").alias("common")), "shingle-counts")
    rising = Window.partitionBy("id").orderBy("common", "code")
    placed = spelt.join(common, "code").withColumn("left", F.col("n") - F.row_number().over(rising) + 1)
    placed = placed.where(F.col("left") * 100 >= F.col("n") * percent).join(members, "id")
    placed = settle(placed.select("id", "n", "code", "left", "component", "minor"), "rare-shingles")
    minor = placed.where("minor").select("code", *[F.col(c).alias(f"{c}_m") for c in ("id", "n", "left", "component")])
    met = minor.join(placed, "code").where(
        (F.col("component") != F.col("component_m"))
        & (F.least("left", "left_m") * (100 + percent) >= (F.col("n") + F.col("n_m")) * percent)
    )
    forth = F.col("id") < F.col("id_m")
    return met.select(
        F.least("id", "id_m").alias("a"), F.greatest("id", "id_m").alias("b"), F.lit(0).alias("gap"),
        F.when(forth, F.col("component")).otherwise(F.col("component_m")).alias("own"),
        F.when(forth, F.col("component_m")).otherwise(F.col("component")).alias("other"),
    ).distinct()


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents whose sets of distinct ``width``-word shingles share ``percent`` of their union
    are linked; ``component_id`` is the smallest id reachable. Equal sets are one class. Each
    class has a row in every tree of the forest; a tree sorts its rows by signature, and rows
    with a common prefix of ``ROOT`` values meet their next neighbours in that order. Pairs are
    confirmed on the full sets: first the closest of each class, whose links make components;
    then regions in which every row meets every other are read again for pairs of different
    components, and ``unite`` merges those that are linked; in regions with more rows than that,
    every row outside the largest component meets all rows that share a rare shingle, so their
    other neighbours, most of which would fail, needn't be looked at. So no number of copies makes
    all pairs, and no link between components is left out for the size of a region.

    A text without words or a null one is an empty set, linked with nothing; a null id is never
    linked and always kept; rows that share an id are one document with several texts, and only
    confirmed by one of them; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    sketches = settle(sketch(docs, doc_id, text, width), "sketches")
    some = sketches.where("n > 0 and doc_id is not null")
    classes = settle(some.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("id")), "classes")
    heads = some.join(classes, ["set_a", "set_b"]).where("doc_id = id").dropDuplicates(["id", "set_a", "set_b"])
    heads = settle(heads.select("id", "n", "bits_a", "bits_b", "roots", "deep"), "heads")
    tree = F.arrays_zip("roots", "deep").alias("trees")
    forest = heads.select("id", "n", "bits_a", "bits_b", F.inline(tree)).withColumnRenamed("roots", "root")
    near = neighbours(forest.withColumn("component", F.col("id")), percent, closest=True)
    near = settle(near.distinct(), "closest-pairs")
    first = settle(_chosen(near, 1), "first-pairs")
    release(spark)
    regions = settle(_crowded(forest.select("root")), "crowded-regions")
    crowded = settle(forest.select("root", "id").join(regions, "root"), "crowded")
    ids = first.select(F.col("a").alias("id")).union(first.select("b")).union(crowded.select("id"))
    labels = settle(ids.distinct().withColumn("component", F.col("id")), "labels")
    texts = settle(_rows(docs, doc_id, text).join(labels.select(F.col("id").alias("doc_id")), "doc_id").dropDuplicates(["doc_id"]), "near-texts")
    release(spark)
    links = settle(confirm(first.select("a", "b"), texts, width, percent), "links")
    merged = components(links)
    labels = settle(_renamed(labels, merged, "component"), "labels")
    close = _renamed(_renamed(near, merged, "own"), merged, "other").where("own <> other")
    labels = unite(settle(_untried(close, first), "open-pairs"), labels, texts, width, percent)
    tried = near.select("a", "b")
    again = forest.join(regions, "root", "left_anti").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rest = _untried(neighbours(again, percent).distinct(), tried)
    labels = unite(settle(rest, "open-pairs"), labels, texts, width, percent)
    release(spark)
    over = _untried(_left_over(crowded, labels, texts, width, percent), tried)
    labels = unite(settle(over, "open-pairs"), labels, texts, width, percent)
    named = classes.join(labels, "id", "left").select("set_a", "set_b", F.coalesce("component", "id").alias("component"))
    named = settle(named, "class-components")
    out = sketches.select("doc_id", "n", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    component = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
