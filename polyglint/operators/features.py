"""Term weighting, embeddings, label encoding and vector shaping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import char_ngrams, let, uni_and_bigrams, vector_tokens
from ..session import cut_lineage
from .aggregates import top_groups
from .word_vectors import run_sums, token_lines, train_tables

# --- TF-IDF ---------------------------------------------------------------------------------

#: Characters of text whose terms a task counts, about (table sizes: see README).
TASK_CHARS = 1 << 22


def term_counts(df: DataFrame, id_col: str, terms: Column) -> DataFrame:
    """(id, term, tf). A row's terms are sorted and counted in place, so nothing is shuffled or
    hashed by (id, term), and rows placed by id stay so. Ids must be unique."""
    ordered = let(F.array_sort(terms), lambda ts: F.struct(ts.alias("ts"), _run_starts(ts).alias("at")))
    runs = let(ordered, lambda o: F.transform(o["at"], lambda i, k: F.struct(
        F.get(o["ts"], i).alias("term"),
        (F.coalesce(F.get(o["at"], k + 1), F.size(o["ts"])) - i).cast("long").alias("tf"),
    )))
    return df.select(id_col, F.inline(runs))


def _run_starts(ordered: Column) -> Column:
    """0-based places at which a sorted array's next value begins."""
    places = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1))
    begins = F.filter(places, lambda i: (i == 0) | ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)))
    return F.coalesce(begins, F.array().cast("array<int>"))


def text_tasks(df: DataFrame, text: str) -> int:
    """Tasks that leave each about TASK_CHARS of text, however large a scan's splits are; reads
    the column once for its length."""
    chars = df.agg(F.sum(F.length(text).cast("long"))).first()[0] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, 1 + chars // TASK_CHARS)


def placed_by(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Rows dealt by id to tasks of bounded text; what groups by id afterwards stays there."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, text_tasks(df, text)), id_col)


def term_totals(df: DataFrame, id_col: str, text: str, terms: Column) -> DataFrame:
    """(term, df, total) of the terms of a text column; ids must be unique.

    Rows are dealt by id to tasks of bounded text, whose terms are added up there, and the sums by
    term to a quarter as many tasks. So no task's table of terms grows with the input or with a
    scan's splits, and a frequent term comes once from each task.
    """
    tasks = text_tasks(df, text)
    part = F.pmod(F.xxhash64(id_col), F.lit(tasks)).cast("int")
    dealt = df.select(part.alias("_part"), text).repartitionById(tasks, "_part")
    sums = term_counts(dealt, "_part", terms).groupBy("_part", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")
    )
    least = df.sparkSession.sparkContext.defaultParallelism
    by_term = sums.repartition(max(least, tasks // 4), "term").groupBy("term")
    return by_term.agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def vocabulary(
    totals: DataFrame, n_docs: Column, max_features: int = 8000, min_df: int = 2, max_df: float = 0.95
) -> DataFrame:
    """(term, df, total): terms inside the document-frequency limits, cut to the most frequent."""
    kept = totals.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs))
    return kept.orderBy(F.desc("total"), "term").limit(max_features)


def tfidf_vocabulary(
    df: DataFrame, id_col: str, text: str, max_features: int = 8000, min_df: int = 2,
    max_df: float = 0.95, ngrams: bool = True,
) -> DataFrame:
    """The vocabulary that ``tfidf_long`` weighs: max_features rows at most."""
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    totals = term_totals(df, id_col, text, _vector_terms(text, ngrams))
    return vocabulary(totals, n_docs, max_features, min_df, max_df)


def _vector_terms(text: str, ngrams: bool) -> Column:
    tokens = vector_tokens(F.col(text))
    return uni_and_bigrams(tokens) if ngrams else tokens


def tfidf_long(
    df: DataFrame, id_col: str, text: str, max_features: int = 8000, min_df: int = 2,
    max_df: float = 0.95, ngrams: bool = True, vocab: DataFrame | None = None,
) -> DataFrame:
    """(id, term, weight): (1 + ln tf) * (ln((n + 1) / (df + 1)) + 1), unit length per document.

    ``vocab`` is the table's ``tfidf_vocabulary`` where the caller has it already.
    """
    if vocab is None:
        vocab = tfidf_vocabulary(df, id_col, text, max_features, min_df, max_df, ngrams)
    n_docs = df.agg(F.count(F.lit(1))).scalar()
    counts = term_counts(placed_by(df.select(id_col, text), id_col, text), id_col, _vector_terms(text, ngrams))
    idf = F.log((n_docs + 1) / (F.col("df") + 1)) + 1
    raw = counts.join(F.broadcast(vocab.select("term", "df")), "term").select(  # max_features rows
        id_col, "term", ((1 + F.log("tf")) * idf).alias("_w")
    )
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))
    return raw.select(id_col, "term", (F.col("_w") / norm).alias("weight"))


def term_index(vocab: DataFrame) -> DataFrame:
    """Vocabulary with a 0-based column index in term order; at most max_features rows."""
    return vocab.withColumn("index", F.row_number().over(W.orderBy("term")) - 1)


def sparse_vectors(
    long: DataFrame, ids: DataFrame, id_col: str, index: DataFrame, size: int, out: str = "features"
) -> DataFrame:
    """Long weights to one sparse vector per row of ``ids``; a document without terms gets zeros."""

    @F.udf(VectorUDT())
    def assemble(cells):
        return SparseVector(size, {c["index"]: c["weight"] for c in cells or ()})

    placed = long.join(F.broadcast(index.select("term", "index")), "term")
    cells = placed.groupBy(id_col).agg(F.collect_list(F.struct("index", "weight")).alias("_cells"))
    joined = ids.select(id_col).join(cells, id_col, "left")
    return joined.select(id_col, assemble("_cells").alias(out))


def density_report(long: DataFrame, id_col: str, n_docs: Column) -> DataFrame:
    """Shape and fill of the document-term matrix."""
    block = long.agg(
        F.count_distinct("term").alias("terms"), F.count(F.lit(1)).alias("nonzero")
    )
    return block.select(
        n_docs.alias("docs"), "terms", "nonzero",
        (F.col("nonzero") / (n_docs * F.col("terms"))).alias("density"),
    )


def vocabulary_size(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select(F.explode(tokens).alias("token")).agg(
        F.count_distinct("token").alias("vocabulary")
    )


# --- word and subword vectors ---------------------------------------------------------------


def train_word2vec(
    df: DataFrame, tokens: str, size: int = 128, window: int = 5, min_count: int = 1,
    epochs: int = 10, seed: int = 42, partitions: int = 1,
):
    """Skip-gram word vectors. The model, vocabulary x size, lives on the driver: raise
    ``min_count`` with the corpus, and give rarer words their vectors by ``subword_pool``."""
    return Word2Vec(
        vectorSize=size, windowSize=window, minCount=min_count, maxIter=epochs, seed=seed,
        numPartitions=partitions, inputCol=tokens, outputCol="features",
    ).fit(df)


def mean_pool(
    df: DataFrame, id_col: str, tokens: Column, vectors: DataFrame, size: int,
    out: str = "features", hot: int = 1000,
) -> DataFrame:
    """Mean of the known tokens' vectors per document, the zero vector when none is known.

    ``vectors`` holds (word, vector). The vectors of the ``hot`` most frequent tokens, which
    appear in most documents, are broadcast and added up where the documents lie; the rest meet
    theirs by a join. Both sums are brought together by id, one row after another.
    """
    counts = term_counts(df, id_col, tokens).withColumnRenamed("term", "word")
    frequent = cut_lineage(top_groups(counts, "word", hot).select("word"))
    table = vectors.join(F.broadcast(frequent), "word").select("word", vector_to_array("vector").alias("v")).toArrow()
    known = table.column("word").combine_chunks()
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((known, matrix(table.column("v"), size)))
    kind = df.schema[id_col].dataType.simpleString()
    sums = f"{id_col} {kind}, n double, v array<double>"

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, rows = shared.value
        for batch in batches:
            at, flat = list_parts(batch.column("tokens"))
            found = np.asarray(pc.fill_null(pc.index_in(flat, value_set=words), -1))
            yield sum_batch(batch.column(0), id_col, *weighted_sums(at, found, np.ones(len(found)), rows))

    def run_total(batches: Iterator[pa.RecordBatch], weigh: bool = False) -> Iterator[pa.RecordBatch]:
        for piece in whole_groups(batches, id_col):
            ids = piece.column(id_col).combine_chunks()
            starts = group_starts(ids)
            n = np.asarray(piece.column("n"))
            total = run_sums(matrix(piece.column("v"), size), starts, len(n), weights=n if weigh else None)
            yield sum_batch(ids.take(pa.array(starts)), id_col, np.add.reduceat(n, starts), total)

    here = df.select(id_col, tokens.alias("tokens")).where("tokens is not null").mapInArrow(near, sums)
    far = counts.join(F.broadcast(frequent), "word", "left_anti").join(vectors, "word").select(
        id_col, F.col("tf").cast("double").alias("n"), vector_to_array("vector").alias("v")
    )
    # a document's words that met their vectors in one task are added up there, before they move
    far = far.sortWithinPartitions(id_col).mapInArrow(lambda batches: run_total(batches, weigh=True), sums)
    both = here.where("n > 0").unionByName(far).repartition(id_col).sortWithinPartitions(id_col)
    pooled = both.mapInArrow(run_total, sums)
    pooled = pooled.select(id_col, array_to_vector(F.transform("v", lambda x: x / F.col("n"))).alias(out))
    return _zero_filled(df.select(id_col), pooled, id_col, size, out)


def matrix(column: pa.ChunkedArray | pa.Array, size: int) -> np.ndarray:
    """Lists of ``size`` numbers as the rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(list_parts(column)[1], dtype=np.float64).reshape(-1, size)


def list_parts(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and the values, end to end, of a list column; a null list is empty."""
    at = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(column), 0), dtype=np.int64))])
    return at, column.flatten()


def weighted_sums(at: np.ndarray, rows: np.ndarray, weights: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weight and weighted sum of table rows (-1: none) of each run of ``rows`` that ``at`` cuts."""
    held = np.flatnonzero(rows >= 0)
    known = np.searchsorted(held, at)
    some = np.flatnonzero(np.diff(known))
    n, total = np.zeros(len(at) - 1), np.zeros((len(at) - 1, table.shape[1]))
    if len(some):
        w = weights[held].astype(table.dtype)
        total[some] = run_sums(table, known[some], len(held), rows[held], w)
        n[some] = np.add.reduceat(weights[held], known[some])
    return n, total


def sum_batch(keys: pa.Array, name: str, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    cells = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), total.shape[1]).cast(pa.list_(pa.float64()))
    return pa.record_batch([keys, pa.array(n), cells], [name, "n", "v"])


def group_starts(keys: pa.Array) -> np.ndarray:
    """Where each key begins in a sorted, non-empty column."""
    same = pc.equal(keys.slice(1), keys.slice(0, len(keys) - 1))
    both = pc.and_(pc.is_null(keys.slice(1)), pc.is_null(keys.slice(0, len(keys) - 1)))
    return np.concatenate([[0], np.flatnonzero(~np.asarray(pc.or_(pc.fill_null(same, False), both))) + 1])


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, most: int = 50_000) -> Iterator[pa.Table]:
    """Sorted rows in tables that end where a key ends, of ``most`` rows or a key's and more."""
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= most:
            whole = pa.Table.from_batches(held)
            last = int(group_starts(whole.column(key).combine_chunks())[-1])  # the last key may go on
            if last:
                yield whole.slice(0, last)
            held, count = whole.slice(last).to_batches(), whole.num_rows - last
    if count:
        yield pa.Table.from_batches(held)


def _zero_filled(ids: DataFrame, pooled: DataFrame, id_col: str, size: int, out: str) -> DataFrame:
    zero = array_to_vector(F.array_repeat(F.lit(0.0), size))
    joined = ids.join(pooled, id_col, "left")
    return joined.select(id_col, F.coalesce(F.col(out), zero).alias(out))


def subword_buckets(token: Column, low: int, high: int, buckets: int) -> Column:
    """Hash buckets of the token's boundary-marked character n-grams."""
    return F.transform(
        char_ngrams(token, low, high),
        lambda g: F.pmod(F.xxhash64(g), F.lit(buckets)).cast("int"),
    )


def subword_vectors(
    words: DataFrame, low: int = 3, high: int = 6, buckets: int = 1 << 16
) -> DataFrame:
    """(bucket, vector): each n-gram bucket is the mean vector of the trained words holding it.

    ``words`` holds (word, vector). The result has at most ``buckets`` rows whatever the corpus.
    """
    grams = words.select("vector", F.explode(subword_buckets(F.col("word"), low, high, buckets)).alias("bucket"))
    return grams.groupBy("bucket").agg(Summarizer.mean(F.col("vector")).alias("vector"))


def subword_sequences(
    df: DataFrame, id_col: str, tokens: Column, low: int = 3, high: int = 6, buckets: int = 1 << 16
) -> DataFrame:
    """(id, turn, grams): n-gram buckets to train on, each bucket of each token exactly once.

    A turn takes one n-gram of every token that has so many, in the order of the tokens, so the
    neighbours of an n-gram come from the words around its own, not from its own. Which n-gram
    meets which is drawn by a hash of the document and the place. Ids must be unique. A null
    or empty token list, and a token without n-grams, adds nothing.
    """
    words = df.select(id_col, F.posexplode(tokens).alias("_at", "_word"))
    drawn = F.transform(
        subword_buckets(F.col("_word"), low, high, buckets),
        lambda b: F.struct(F.xxhash64(b, F.col(id_col), F.col("_at")).alias("key"), b.alias("gram")),
    )
    cells = words.select(id_col, "_at", F.posexplode(F.array_sort(drawn)["gram"]).alias("_turn", "_gram"))
    line = F.array_sort(F.collect_list(F.struct("_at", F.col("_gram").cast("string").alias("gram"))))
    return cells.groupBy(id_col, F.col("_turn").alias("turn")).agg(line["gram"].alias("grams"))


def train_subword_vectors(
    df: DataFrame, id_col: str, tokens: Column, size: int = 128, window: int = 5, epochs: int = 10,
    low: int = 3, high: int = 6, buckets: int = 1 << 16, seed: int = 42,
) -> DataFrame:
    """(bucket, vector): skip-gram vectors of the n-gram buckets themselves.

    A token is the mean of its n-grams and is trained against the words around it, which share
    as many buckets. The model has at most ``buckets`` rows, however many words the corpus has.
    A corpus without n-grams, or without two words side by side, has no vectors.
    """
    words = F.filter(tokens, lambda w: w.isNotNull())
    grams = F.transform(words, lambda w: subword_buckets(w, low, high, buckets))
    tables = train_tables(token_lines(df, words, grams, buckets), size, window, epochs, buckets, seed)
    met = np.flatnonzero(tables.met[0])
    rows = pa.table({"bucket": pa.array(met, pa.int32()), "v": pa.array(list(tables.parts[met].astype(np.float64)), pa.list_(pa.float64()))})
    return df.sparkSession.createDataFrame(rows).select("bucket", array_to_vector("v").alias("vector"))


def _gram_means(rows: DataFrame, key: str, grams: Column, vectors: DataFrame, size: int) -> DataFrame:
    """(key, n, v): weight and sum of the vectors of a row's n-grams, ``grams`` an array of buckets
    for each token, which weighs one. Added up where the rows lie: nothing is shuffled."""
    table = vectors.select("bucket", vector_to_array("vector").alias("v")).toArrow()  # at most ``buckets`` rows
    buckets = table.column("bucket").combine_chunks()
    shared = rows.sparkSession.sparkContext.broadcast((buckets, matrix(table.column("v"), size).astype(np.float32)))
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cells = shared.value
        for batch in batches:
            at, tokens = list_parts(batch.column("grams"))
            ends, flat = list_parts(tokens)
            found = np.asarray(pc.fill_null(pc.index_in(flat, value_set=known), -1))
            lens = np.diff(ends)
            weights = np.repeat(1 / np.maximum(lens, 1), lens)
            yield sum_batch(batch.column(0), key, *weighted_sums(ends[at], found, weights, cells))

    return rows.select(key, grams.alias("grams")).mapInArrow(run, f"{key} {kind}, n double, v array<double>")


def _mean_of_sums(out: str) -> Column:
    return array_to_vector(F.transform("v", lambda x: x / F.col("n"))).alias(out)


def subword_word_vectors(
    words: DataFrame, word: str, vectors: DataFrame, low: int = 3, high: int = 6, buckets: int = 1 << 16
) -> DataFrame:
    """(word, vector) of distinct words, met in training or not: the mean of their n-grams'
    vectors. A word none of whose n-grams was met is left out."""
    known = words.select(F.col(word).alias("word")).where("word is not null").distinct()
    first = vectors.select(F.size(vector_to_array("vector"))).first()
    grams = F.array(subword_buckets(F.col("word"), low, high, buckets))
    summed = _gram_means(known, "word", grams, vectors, first[0] if first else 1)
    return summed.where("n > 0").select("word", _mean_of_sums("vector"))


def subword_pool(
    df: DataFrame, id_col: str, tokens: Column, vectors: DataFrame, size: int, low: int = 3,
    high: int = 6, buckets: int = 1 << 16, out: str = "features",
) -> DataFrame:
    """Document mean of token vectors, each the mean of its n-grams, so unseen words count too."""
    words = F.filter(F.coalesce(tokens, F.array().cast("array<string>")), lambda w: w.isNotNull())
    grams = F.transform(words, lambda w: subword_buckets(w, low, high, buckets))
    summed = _gram_means(df, id_col, grams, vectors, size)
    zero = array_to_vector(F.array_repeat(F.lit(0.0), size))
    return summed.select(id_col, F.when(F.col("n") > 0, _mean_of_sums("_m")).otherwise(zero).alias(out))


def similar_words(model, word: str, k: int = 10) -> DataFrame:
    """The k nearest words by cosine; an unknown word gives an empty frame."""
    vectors = model.getVectors()
    if vectors.where(F.col("word") == word).isEmpty():
        return vectors.sparkSession.createDataFrame([], "word string, similarity double")
    return model.findSynonyms(word, k)


def word_similarities(vectors: DataFrame, word: str) -> DataFrame:
    """(word, similarity): cosine of every other word of a table (word, vector) of any size. An
    unknown word has none; a zero vector is at 0 from every other."""
    unit = vectors.select("word", l2_normalise(vector_to_array("vector")).alias("_u"))
    asked = unit.where(F.col("word") == word).limit(1).select("_u").scalar()
    products = F.zip_with("_u", "_asked", lambda a, b: a * b)
    cosine = F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)
    others = unit.where(F.col("word") != word).withColumn("_asked", asked).where("_asked is not null")
    return others.select("word", cosine.alias("similarity"))


def nearest_words(vectors: DataFrame, word: str, k: int = 10) -> DataFrame:
    """(word, similarity): the k nearest other words by cosine; ties by word."""
    return word_similarities(vectors, word).orderBy(F.desc("similarity"), "word").limit(k)


# --- labels and vectors ---------------------------------------------------------------------


def label_table(df: DataFrame, label: str, fill: str = "neutral") -> DataFrame:
    """(label, index): classes in alphabetical order, nulls counted as ``fill``."""
    classes = df.select(F.coalesce(F.col(label), F.lit(fill)).alias("label")).distinct()
    return classes.withColumn("index", F.row_number().over(W.orderBy("label")) - 1)


def encode_labels(df: DataFrame, label: str, out: str, fill: str = "neutral") -> DataFrame:
    """Add the 0-based class index."""
    filled = F.coalesce(F.col(label), F.lit(fill))
    classes = label_table(df, label, fill).select(F.col("label").alias("_class"), F.col("index").alias(out))
    return df.drop(out).join(classes, filled == F.col("_class"), "left").drop("_class")


def l2_normalise(vector: Column) -> Column:
    """Array scaled to unit length; the zero array stays zero."""

    def norm(values: Column) -> Column:
        return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v))

    def scaled(values: Column) -> Column:
        return let(
            norm(values), lambda n: F.transform(values, lambda v: F.when(n > 0, v / n).otherwise(v))
        )

    return let(F.transform(vector, lambda v: v.cast("double")), scaled)


def pick_embedding(df: DataFrame, preferred: str = "dense", fallback: str = "tfidf") -> str:
    """Name of the embedding column to use."""
    return preferred if preferred in df.columns else fallback


def softmax(margins: Column) -> Column:
    """Max-shifted softmax of an array of margins."""

    def shares(weights: Column) -> Column:
        total = F.aggregate(weights, F.lit(0.0), lambda acc, v: acc + v)
        return let(total, lambda n: F.transform(weights, lambda v: v / n))

    def powers(ms: Column) -> Column:
        return let(F.array_max(ms), lambda top: F.transform(ms, lambda v: F.exp(v - top)))

    return let(let(margins, powers), shares)


def argmax(scores: Column) -> Column:
    """0-based position of the largest score, the first on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


