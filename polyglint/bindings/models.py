"""Embeddings, projection, training and evaluation on the sample tables."""

from functools import reduce

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.fixed_values import STOPWORDS
from ..operators import classify as cl
from ..operators import evaluate as ev
from ..operators import features as ft
from ..operators import fuzzy_graph as fz
from ..operators import joins as jn
from ..operators import neighbours as nb
from ..operators import ordered as od
from ..operators import projection as pj
from ..operators import ranking as rk
from ..operators.wide_pca import fit_wide_pca
from ..operators.word_vectors import train_word_vectors
from ..session import cut_lineage, dealt, scratch_path
from ..sources import bundles
from .aggregates import rounded
from .registry import Tables, query
from .scalars import r6
from .texts import _TFIDF_SQL, _list_sql, chain_sql, vec_tokens_sql

# --- labels and vectors ---------------------------------------------------------------------


@query(
    "e4_encode_labels",
    """WITH f AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'neutral' ELSE event_type END AS label FROM events)
       SELECT event_id, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_index FROM f""",
)
def _(t: Tables):
    rows = t.events.select("event_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("l"))
    return ft.encode_labels(rows, "l", "label_index").select("event_id", "label_index")


@query(
    "e5_l2_normalise",
    """WITH s AS (SELECT vec_id, [x::DOUBLE * (vec_id % 4) for x in embedding] AS v FROM embeddings),
       n AS (SELECT vec_id, v, sqrt(list_sum([x * x for x in v])) AS norm FROM s)
       SELECT vec_id, CAST(unnest(range(64)) AS INTEGER) AS pos,
         round(unnest([CASE WHEN norm > 0 THEN x / norm ELSE x END for x in v]), 6) AS u FROM n""",
)
def _(t: Tables):
    scaled = F.transform("embedding", lambda v: v.cast("double") * (F.col("vec_id") % 4))
    units = t.embeddings.select("vec_id", ft.l2_normalise(scaled).alias("u"))
    return units.select("vec_id", F.posexplode("u").alias("pos", "u")).withColumn("u", r6(F.col("u")))


@query("e7_pick_embedding", "SELECT vec_id, 'embedding' AS source, CAST(len(embedding) AS INTEGER) AS width FROM embeddings")
def _(t: Tables):
    name = ft.pick_embedding(t.embeddings, "embedding", "tfidf")
    return t.embeddings.select("vec_id", F.lit(name).alias("source"), F.size(name).alias("width"))


@query(
    "m1_stratified_split",
    """WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42')) AS rn,
         count(*) OVER (PARTITION BY label) AS n FROM embeddings)
       SELECT vec_id, label, CASE WHEN rn <= round(0.2 * n) THEN 1 ELSE 0 END AS is_test FROM r""",
)
def _(t: Tables):
    return od.stratified_split(t.embeddings.select("vec_id", "label"), "vec_id", "label")


@query(
    "m4_softmax",
    """WITH m AS (SELECT vec_id, [x::DOUBLE * 10 for x in embedding[1:5]] AS v FROM embeddings),
       e AS (SELECT vec_id, [exp(x - list_max(v)) for x in v] AS e FROM m)
       SELECT vec_id, CAST(unnest(range(5)) AS INTEGER) AS cls, round(unnest([x / list_sum(e) for x in e]), 6) AS p FROM e""",
)
def _(t: Tables):
    margins = F.transform(F.slice("embedding", 1, 5), lambda v: v.cast("double") * 10)
    probs = t.embeddings.select("vec_id", ft.softmax(margins).alias("p"))
    return probs.select("vec_id", F.posexplode("p").alias("cls", "p")).withColumn("p", r6(F.col("p")))


# --- evaluation -----------------------------------------------------------------------------

_LANGS = ["de", "en", "es", "fr"]


def _votes(t: Tables):
    """Language voted by the share of each language's stopwords in the text."""
    def shares(tokens):
        return F.array(F.struct(*[_hits(tokens, c).alias(f"s_{c}") for c in _LANGS]))

    tokens = tx.vector_tokens(F.col("text"))
    scored = t.documents.select("doc_id", "lang", F.inline(tx.let(tokens, shares)))
    best = F.greatest(*[F.struct(F.col(f"s_{c}").alias("s"), F.lit(-i).alias("o"), F.lit(c).alias("c"))
                        for i, c in enumerate(_LANGS)])
    return scored.withColumn("predicted", best["c"])


def _hits(tokens, code):
    found = F.size(F.filter(tokens, lambda w: w.isin(STOPWORDS[code])))
    return F.when(F.size(tokens) > 0, found / F.size(tokens)).otherwise(0.0)


_VOTES_SQL = f"""WITH k AS (SELECT doc_id, lang, {vec_tokens_sql('text')} AS toks FROM documents),
  s AS (SELECT doc_id, lang, {', '.join(
      f"CASE WHEN len(toks) > 0 THEN len([w for w in toks if list_contains({_list_sql(STOPWORDS[c])}, w)]) / len(toks) ELSE 0 END AS s_{c}"
      for c in _LANGS)} FROM k),
  p AS (SELECT *, CASE {' '.join(f"WHEN s_{c} = greatest({', '.join('s_' + d for d in _LANGS)}) THEN '{c}'" for c in _LANGS)} END
        AS predicted FROM s)"""

_REPORT_SQL = """c AS (SELECT lang AS class FROM p UNION SELECT predicted FROM p),
  r AS (SELECT class, (SELECT count(*) FROM p WHERE lang = class) AS support,
    (SELECT count(*) FROM p WHERE predicted = class) AS said,
    (SELECT count(*) FROM p WHERE predicted = class AND lang = class) AS hit FROM c),
  q AS (SELECT *, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN hit / support ELSE 0 END AS recall FROM r),
  f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1 FROM q)"""


@query(
    "m8_most_likely",
    f"{_VOTES_SQL} SELECT doc_id, CAST(list_position(['de', 'en', 'es', 'fr'], predicted) - 1 AS INTEGER) AS prediction FROM p",
)
def _(t: Tables):
    scores = _votes(t).select("doc_id", F.array(*[f"s_{c}" for c in _LANGS]).alias("probability"))
    return cl.most_likely(scores).select("doc_id", "prediction")


@query(
    "m9_weighted_metrics",
    f"""{_VOTES_SQL}, {_REPORT_SQL} SELECT round(sum(hit) / sum(support), 6) AS accuracy,
        round(sum(f1 * support) / sum(support), 6) AS f1, round(sum(precision * support) / sum(support), 6) AS precision,
        round(sum(recall * support) / sum(support), 6) AS recall, CAST(sum(support) AS BIGINT) AS support FROM f""",
)
def _(t: Tables):
    return rounded(ev.weighted_metrics(_votes(t), "lang", "predicted"), *ev.METRICS)


@query(
    "m10_confusion_matrix",
    f"{_VOTES_SQL} SELECT lang AS actual, "
    + ", ".join(f"count(*) FILTER (predicted = '{c}') AS pred_{c}" for c in [*_LANGS, "zz"])
    + " FROM p GROUP BY lang",
)
def _(t: Tables):
    return ev.confusion_matrix(_votes(t), "lang", "predicted", [*_LANGS, "zz"])


@query(
    "m11_full_report",
    f"""{_VOTES_SQL}, {_REPORT_SQL}, n AS (SELECT CAST(sum(support) AS BIGINT) AS n FROM f)
      SELECT class AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM f
      UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6),
        round(sum(hit) / sum(support), 6), any_value(n) FROM f, n
      UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), any_value(n) FROM f, n
      UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
        round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), any_value(n) FROM f, n""",
)
def _(t: Tables):
    return rounded(ev.full_report(_votes(t), "lang", "predicted"), "precision", "recall", "f1")


def auc_sql(rows, by=""):
    """AUC by mid-ranks over (by, positive, score) rows."""
    part = f"PARTITION BY {by}" if by else ""
    tie = f"PARTITION BY {by + ', ' if by else ''}score"
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""(SELECT {keys}CASE WHEN sum(positive) > 0 AND sum(1 - positive) > 0 THEN
      (sum(positive * mid) - sum(positive) * (sum(positive) + 1) / 2) / (sum(positive) * sum(1 - positive))
      ELSE 'NaN'::DOUBLE END AS auc, CAST(sum(positive) AS BIGINT) AS support FROM (
      SELECT *, rank() OVER ({part} ORDER BY score) + (count(*) OVER ({tie}) - 1) / 2 AS mid FROM {rows}) {group})"""


@query(
    "m12_auc_binary",
    f"SELECT round(auc, 6) AS auc, support FROM {auc_sql('(SELECT toxic AS positive, n_chars AS score FROM documents JOIN labels USING (doc_id))')}",
)
def _(t: Tables):
    both = t.documents.join(t.labels, "doc_id")
    return rounded(ev.roc_auc(both, "toxic", "n_chars"), "auc")


@query(
    "m12_auc_weighted_ovr",
    f"""{_VOTES_SQL}, l AS ({' UNION ALL '.join(f"SELECT '{c}' AS class, (lang = '{c}')::INT AS positive, s_{c} AS score FROM p" for c in _LANGS)})
        SELECT round(sum(auc * support) / sum(support), 6) AS auc FROM {auc_sql('l', 'class')}""",
)
def _(t: Tables):
    return rounded(ev.roc_auc_ovr(_votes(t), "lang", {c: f"s_{c}" for c in _LANGS}), "auc")


# A results table made of the data: every language is a block, every rule a model that
# predicts the quality label.
_RULES = {
    "length": ("n_chars >= 500", "n_chars"),
    "source": ("source < 'src5'", "0"),
    "mention": ("NOT contains(text, '@')", "CASE WHEN contains(text, '@') THEN 0 ELSE 1 END"),
    "always": ("true", "1"),
}

_RULE_ROWS_SQL = "WITH d AS (SELECT * FROM documents JOIN labels USING (doc_id)), p AS (" + " UNION ALL ".join(
    f"SELECT lang AS embedding, '{m}' AS model, quality AS actual, ({rule})::INT AS predicted, CAST({score} AS DOUBLE) AS score FROM d"
    for m, (rule, score) in _RULES.items()
) + ")"

_RESULTS_SQL = f"""{_RULE_ROWS_SQL},
  k AS (SELECT DISTINCT embedding, model, unnest([0, 1]) AS class FROM p),
  r AS (SELECT k.embedding, k.model, class, count(*) FILTER (actual = class) AS support,
    count(*) FILTER (predicted = class) AS said, count(*) FILTER (actual = class AND predicted = class) AS hit
    FROM k JOIN p ON k.embedding = p.embedding AND k.model = p.model GROUP BY ALL),
  q AS (SELECT *, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS pr, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS rc FROM r),
  f AS (SELECT *, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0 END AS f FROM q),
  m AS (SELECT embedding, model, sum(hit) / sum(support) AS accuracy, sum(f * support) / sum(support) AS f1,
    sum(pr * support) / sum(support) AS precision, sum(rc * support) / sum(support) AS recall FROM f GROUP BY ALL),
  a AS (SELECT * FROM {auc_sql('(SELECT embedding, model, actual AS positive, score FROM p)', 'embedding, model')}),
  results AS (SELECT embedding, model, round(accuracy, 6) AS accuracy, round(f1, 6) AS f1, round(precision, 6) AS precision,
    round(recall, 6) AS recall, round(auc, 6) AS auc FROM m JOIN a USING (embedding, model))"""


def _rule_results(t: Tables):
    both = t.documents.join(t.labels, "doc_id")
    cells = F.array(
        *[
            F.struct(
                F.lit(m).alias("model"), F.expr(rule).cast("int").alias("predicted"),
                F.expr(score).cast("double").alias("score"),
            )
            for m, (rule, score) in _RULES.items()
        ]
    )
    rows = both.select(F.col("lang").alias("embedding"), F.col("quality").alias("actual"), F.inline(cells))
    keys = ["embedding", "model"]
    metrics = ev.weighted_metrics(rows, "actual", "predicted", keys).drop("support")
    auc = ev.roc_auc(rows, "actual", "score", keys).drop("support")
    return rounded(metrics.join(auc, keys), *ev.METRICS, "auc")


_LIST = "embedding, model, accuracy, f1, precision, recall, auc"


@query("m14_results", f"{_RESULTS_SQL} SELECT {_LIST} FROM results")
def _(t: Tables):
    return _rule_results(t)


@query("w2_leaderboard", f"{_RESULTS_SQL} SELECT {_LIST}, CAST(row_number() OVER (ORDER BY f1 DESC, embedding, model) AS INTEGER) AS rank FROM results")
def _(t: Tables):
    return rk.leaderboard(_rule_results(t))


@query("t6_sorted_by_f1", f"{_RESULTS_SQL} SELECT {_LIST} FROM results ORDER BY f1 DESC, embedding, model")
def _(t: Tables):
    return _rule_results(t).orderBy(F.desc("f1"), "embedding", "model")


@query(
    "w3_best_per_group",
    f"""{_RESULTS_SQL} SELECT {_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY embedding ORDER BY f1 DESC, model) AS rn
        FROM results) WHERE rn = 1""",
)
def _(t: Tables):
    return rk.best_per_group(_rule_results(t), ["embedding"], "f1", ["model"])


@query(
    "w3_best_line_per_flag",
    """SELECT l_returnflag, l_linestatus, l_extendedprice, l_orderkey FROM (SELECT *, row_number() OVER (
       PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(t: Tables):
    rows = t.lineitem.select("l_returnflag", "l_linestatus", "l_extendedprice", "l_orderkey", "l_linenumber")
    best = rk.best_per_group(rows, ["l_returnflag"], "l_extendedprice", ["l_orderkey", "l_linenumber"])
    return best.drop("l_linenumber")


@query(
    "m14_displayed",
    f"""{_RESULTS_SQL} SELECT embedding, model, embedding || ' + ' || model AS name, round(accuracy, 4) AS accuracy,
        round(f1, 4) AS f1, round(precision, 4) AS precision, round(recall, 4) AS recall,
        round(CASE WHEN isnan(auc) THEN 0 ELSE auc END, 4) AS auc FROM results""",
)
def _(t: Tables):
    return ev.displayed(_rule_results(t))


@query(
    "m15_metric_long",
    f"""{_RESULTS_SQL} SELECT embedding, model, 'accuracy' AS metric, accuracy AS value FROM results
        UNION ALL SELECT embedding, model, 'f1', f1 FROM results UNION ALL SELECT embedding, model, 'precision', precision FROM results
        UNION ALL SELECT embedding, model, 'recall', recall FROM results""",
)
def _(t: Tables):
    return ev.metric_long(_rule_results(t), ["embedding", "model"])


@query("x3_stacked_results", f"{_RESULTS_SQL} SELECT {_LIST} FROM results WHERE embedding IN ('en', 'fr')")
def _(t: Tables):
    results = _rule_results(t)
    return jn.union_blocks([results.where(F.col("embedding") == e) for e in ("en", "fr")])


# --- projection and neighbours --------------------------------------------------------------


def _units(t: Tables):
    return pj.as_unit_vectors(t.embeddings, "embedding")


@query("d1_pca_2d")
def _(t: Tables):
    units = _units(t)
    out = pj.fit_pca(units, "features", 2).transform(units)
    c = F.col("coords")
    return out.select("vec_id", "label", r6(c[0]).alias("pc1"), r6(c[1]).alias("pc2"))


@query(
    "d1_explained_variance",
    """WITH n AS (SELECT vec_id, [x::DOUBLE for x in embedding] AS v FROM embeddings),
       u AS (SELECT vec_id, [x / sqrt(list_sum([y * y for y in v])) for x in v] AS v FROM n),
       c AS (SELECT i, var_samp(v[i]) AS var FROM u, range(1, 65) r(i) GROUP BY i)
       SELECT (SELECT count(*) FROM u) AS points, round(sum(var), 6) AS variance, true AS falling, true AS kept_is_explained FROM c""",
)
def _(t: Tables):
    """The variance of the coordinates is the explained share of the whole."""
    units = _units(t)
    fitted = pj.fit_pca(units, "features", 2)
    coords = fitted.transform(units).select("coords")
    one, two = fitted.explained
    whole = units.select(F.posexplode(vector_to_array("features")).alias("i", "v")).groupBy("i").agg(F.var_samp("v").alias("var"))
    whole = whole.agg(F.sum("var").alias("variance"))
    found = coords.agg(
        F.count(F.lit(1)).alias("points"), F.var_samp(F.col("coords")[0]).alias("a"), F.var_samp(F.col("coords")[1]).alias("b")
    )
    near = lambda v, share: F.abs(v - share * F.col("variance")) < 1e-6
    return found.withColumn("variance", whole.scalar()).select(
        "points", r6(F.col("variance")).alias("variance"), (F.col("a") >= F.col("b")).alias("falling"),
        (near(F.col("a"), one) & near(F.col("b"), two)).alias("kept_is_explained"),
    )


@query("d2_pre_reduction", "SELECT vec_id, CAST(50 AS INTEGER) AS width, true AS shorter FROM embeddings")
def _(t: Tables):
    """Projected on fewer orthogonal axes, no centred vector gets longer than it can have been."""
    reduced = pj.pre_reduce(_units(t), "features", width=64, k=50)
    square = F.aggregate("reduced", F.lit(0.0), lambda acc, v: acc + v * v)
    return reduced.select("vec_id", F.size("reduced").alias("width"), (square <= 4).alias("shorter"))


@query(
    "d2_wide_reduction",
    f"""WITH l AS ({_TFIDF_SQL}), n AS (SELECT count(*) AS n FROM documents),
        c AS (SELECT term, (sum(weight * weight) - sum(weight) * sum(weight) / any_value(n)) / (any_value(n) - 1) AS var FROM l, n GROUP BY term)
        SELECT n AS docs, CAST(50 AS INTEGER) AS width, (SELECT round(sum(var), 4) FROM c) AS variance,
          (SELECT round(sum(var), 4) FROM (SELECT var FROM c ORDER BY var DESC LIMIT 50)) AS best_columns,
          true AS centred, true AS uncorrelated, true AS kept_is_explained, true AS falling, true AS beats_columns FROM n""",
)
def _(t: Tables):
    """The 8000-wide term weights on 50 components. Their variance is what the fit says, no two
    vary together, and they hold more than the 50 columns that vary most, as the leading
    components of any matrix do."""
    vectors = cut_lineage(_tfidf(t))
    fitted = fit_wide_pca(vectors, "features", 50)
    coords = fitted.transform(vectors)
    found = coords.agg(
        F.count(F.lit(1)).alias("docs"), F.max(F.size("coords")).alias("width"),
        Summarizer.mean(array_to_vector("coords")).alias("mean"),
        Summarizer.variance(array_to_vector("coords")).alias("var"),
        F.greatest(*[F.abs(F.corr(F.col("coords")[i], F.col("coords")[j])) for i, j in ((0, 1), (1, 2), (0, 49), (48, 49))]).alias("lean"),
    )
    columns = vectors.agg(Summarizer.variance(F.col("features")).alias("v")).select(vector_to_array("v").alias("v"))
    columns = columns.select(F.reverse(F.array_sort("v")).alias("v")).scalar()
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    means, kept = vector_to_array("mean"), vector_to_array("var")
    said = F.array(*[F.lit(float(v)) for v in fitted.variances])
    near = lambda a, b: F.abs(a - b) < 1e-9
    best = total(F.slice("columns", 1, 50))
    return found.withColumn("columns", columns).select(
        "docs", "width", F.round(total("columns"), 4).alias("variance"), F.round(best, 4).alias("best_columns"),
        F.forall(means, lambda v: F.abs(v) < 1e-9).alias("centred"), (F.col("lean") < 1e-6).alias("uncorrelated"),
        F.forall(F.zip_with(kept, said, near), lambda v: v).alias("kept_is_explained"),
        F.forall(F.sequence(F.lit(1), F.lit(49)), lambda i: F.get(said, i - 1) >= F.get(said, i)).alias("falling"),
        (total(kept) > best).alias("beats_columns"),
    )


@query(
    "d1_wide_against_exact",
    """SELECT count(*) AS points, CAST(2 AS INTEGER) AS width, true AS holds_as_much, true AS holds_no_more, true AS same_rows FROM embeddings""",
)
def _(t: Tables):
    """Two components of the same narrow vectors by both ways: the variances held, and how far
    each row lies from the centre on them."""
    units = _units(t)
    exact, ours = pj.fit_pca(units, "features", 2), fit_wide_pca(units, "features", 2, extra=60, tol=1e-12)
    both = exact.transform(ours.transform(units, "b"), "a")
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, v: acc + v * v))
    a, b = sum(exact.explained), sum(ours.explained)
    return both.agg(
        F.count(F.lit(1)).alias("points"), F.max(F.size("b")).alias("width"), F.lit(b >= a * (1 - 1e-6)).alias("holds_as_much"),
        F.lit(b <= a * (1 + 1e-6)).alias("holds_no_more"), (F.max(F.abs(size("a") - size("b"))) < 1e-4).alias("same_rows"),
    )


_PLANE = "[embedding[1]::DOUBLE, embedding[2]::DOUBLE]"


@query(
    "d3_silhouette",
    """WITH p AS (SELECT vec_id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings
         ORDER BY md5(CAST(vec_id AS VARCHAR) || ':42') LIMIT 2000),
       d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS total,
         count(*) AS n FROM p a, p b GROUP BY ALL),
       s AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
         min(CASE WHEN own <> other THEN total / n END) AS b FROM d GROUP BY vec_id)
       SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, count(*) AS points FROM s""",
)
def _(t: Tables):
    plane = t.embeddings.select(
        "vec_id", "label", F.transform(F.slice("embedding", 1, 2), lambda v: v.cast("double")).alias("xy")
    )
    return rounded(pj.silhouette(plane, "vec_id", "xy", "label"), "silhouette")


@query(
    "d3_silhouette_squared",
    """WITH n AS (SELECT vec_id, label, [x::DOUBLE for x in embedding] AS v FROM embeddings),
       u AS (SELECT vec_id, label, [x / sqrt(list_sum([y * y for y in v])) for x in v] AS v FROM n),
       d AS (SELECT a.vec_id, a.label AS own, b.label AS other, count(*) AS n, sum(pow(list_distance(a.v, b.v), 2)) AS total
         FROM u a JOIN u b ON true GROUP BY ALL),
       s AS (SELECT vec_id, max(CASE WHEN own = other AND n > 1 THEN total / (n - 1) END) AS a,
         min(CASE WHEN own <> other THEN total / n END) AS b FROM d GROUP BY vec_id)
       SELECT count(*) AS points, round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""",
)
def _(t: Tables):
    value = pj.silhouette_squared(_units(t), "features", "label")
    counted = t.embeddings.agg(F.count(F.lit(1)).alias("points"))
    return counted.select("points", F.round(F.lit(value), 6).alias("silhouette"))


def _graph(t: Tables, k: int = 15):
    """Membership weights between all rows, as links for the layout."""
    weights = fz.fuzzy_graph(nb.neighbour_graph(t.embeddings, "vec_id", "embedding", k))
    return weights.select(F.col("source").alias("id"), F.col("target").alias("neighbour"), F.col("weight").alias("similarity"))


_EXACT_SQL = """WITH n AS (SELECT vec_id, [x::DOUBLE for x in embedding] AS v FROM embeddings),
       u AS (SELECT vec_id, [x / sqrt(list_sum([y * y for y in v])) for x in v] AS v FROM n),
       s AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, list_dot_product(a.v, b.v) AS sim FROM u a JOIN u b ON a.vec_id <> b.vec_id {where}),
       r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY sim DESC, neighbour) AS place FROM s)
       SELECT id, neighbour, round(sim, 6) AS similarity, CAST(place AS INTEGER) AS place{more} FROM r WHERE place <= 15"""


@query("d4_knn_graph", _EXACT_SQL.format(where="", more=""))
def _(t: Tables):
    """Neighbours of every row. Up to LEAST_PROBES cells every cell is looked at, so small tables
    are exact; larger ones are held to the exact lists by d4_knn_recall."""
    return rounded(nb.neighbour_graph(t.embeddings, "vec_id", "embedding"), "similarity")


@query("d4_knn_recall", _EXACT_SQL.format(where="WHERE a.vec_id % 50 = 0", more=", true AS recalled"))
def _(t: Tables):
    """Exact neighbours of the rows whose id 50 divides, against all rows, and whether the graph
    has nine in ten of them."""
    rows = t.embeddings.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v")).where("id is not null and v is not null")
    truth = cut_lineage(nb.exact_neighbours(rows.where("id % 50 = 0"), rows, 15))
    recall = nb.recall_of(nb.neighbour_graph(t.embeddings, "vec_id", "embedding"), truth)
    return rounded(truth, "similarity").withColumn("recalled", recall.select(F.col("recall") >= 0.9).scalar())


_FUZZY_SQL = f"""WITH RECURSIVE e AS (SELECT id, neighbour, greatest(1 - sim, 0) AS d FROM ({_EXACT_SQL.format(where="", more=", sim")})),
  m AS (SELECT id, coalesce(min(d) FILTER (WHERE d > 0), 0) AS rho, avg(d) AS mean, count(*) AS n, max(d) AS far FROM e GROUP BY id),
  l AS (SELECT id, m.rho, m.mean, m.n, greatest(m.far - m.rho, 0) AS far, list(greatest(d - m.rho, 0)) AS ex FROM e JOIN m USING (id) GROUP BY ALL),
  h AS (SELECT id, ex, n, 0::DOUBLE AS lo, CASE WHEN n > 1 THEN far / ln(n / log2(n)) ELSE 0 END AS hi, 0 AS step FROM l
    UNION ALL SELECT id, ex, n, CASE WHEN over THEN lo ELSE mid END, CASE WHEN over THEN mid ELSE hi END, step + 1 FROM (
      SELECT *, (lo + hi) / 2 AS mid, list_sum([CASE WHEN x <= 0 THEN 1 ELSE exp(-x / ((lo + hi) / 2)) END for x in ex]) > log2(n) AS over
      FROM h WHERE step < 50)),
  s AS (SELECT id, rho, greatest((lo + hi) / 2, 0.001 * mean) AS sigma FROM h JOIN m USING (id) WHERE step = 50),
  w AS (SELECT id, neighbour, CASE WHEN d <= rho THEN 1 ELSE exp(-(d - rho) / sigma) END AS a FROM e JOIN s USING (id))
  SELECT least(id, neighbour) AS source, greatest(id, neighbour) AS target,
    round(sum(a) - CASE WHEN count(*) > 1 THEN max(a) * min(a) ELSE 0 END, 6) AS weight FROM w GROUP BY ALL"""


@query("d5_fuzzy_graph", _FUZZY_SQL)
def _(t: Tables):
    """Each row's neighbours weighed by a bandwidth of its own, both directions united."""
    return rounded(_graph(t).toDF("source", "target", "weight"), "weight")


@query("d5_spectral_layout")
def _(t: Tables):
    return pj.spectral_layout(_graph(t))


@query("d6_method_comparison")
def _(t: Tables):
    units = _units(t)
    two = pj.fit_pca(units, "features", 2).transform(units).select("vec_id", "label", "coords")
    layout = pj.spectral_layout(_graph(t), rounds=2).withColumnRenamed("id", "vec_id")
    drawn = t.embeddings.select("vec_id", "label").join(layout, "vec_id").select(
        "vec_id", "label", F.array("x", "y").alias("coords")
    )
    scores = [
        pj.silhouette(df, "vec_id", "coords", "label").withColumn("method", F.lit(name))
        for name, df in (("PCA", two), ("Spectral", drawn))
    ]
    return rk.leaderboard(jn.union_blocks(scores), "silhouette", ["method"])


@query(
    "d7_labelled_coordinates",
    "SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS x, round(embedding[2]::DOUBLE, 6) AS y, 'group ' || label AS name FROM embeddings",
)
def _(t: Tables):
    coords = t.embeddings.select(
        "vec_id", r6(F.col("embedding")[0].cast("double")).alias("x"),
        r6(F.col("embedding")[1].cast("double")).alias("y"),
    )
    names = t.embeddings.select("vec_id", F.concat(F.lit("group "), F.col("label")).alias("name"))
    return pj.labelled_coordinates(coords, names, "vec_id", "name")


# --- embeddings and classifiers -------------------------------------------------------------

#: Width of word vectors, and words whose vectors are broadcast (16 MB).
_WIDTH, _HOT = 128, 1 << 14
_fitted: dict[tuple[str, str], tuple] = {}

# A document has a vector exactly when cleaning leaves it a token, as no word is too rare.
_WIDE_SQL = f"SELECT doc_id, {_WIDTH} AS width, len({chain_sql('text')}) > 0 AS has_vector FROM documents"


def _word2vec(t: Tables):
    """Tokens and the word vectors fitted on them, once for each session and folder."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _fitted:
        docs = dealt(t.documents).select(
            "doc_id", "lang", "text", tx.clean_tokens(tx.nfc(F.col("text")), F.col("lang")).alias("tokens")
        )
        docs = cut_lineage(docs)
        _fitted[key] = docs, train_word_vectors(docs, "doc_id", "tokens", _WIDTH)
    return _fitted[key]


def _pooled(docs, words):
    return ft.mean_pool(docs, "doc_id", F.col("tokens"), words, _WIDTH, hot=_HOT)


def _vector_digest(df, vec):
    values = vector_to_array(vec)
    norm = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v * v)
    return df.select("doc_id", F.size(values).alias("width"), (norm > 0).alias("has_vector"))


@query(
    "e1_tfidf_vectors",
    f"""WITH l AS ({_TFIDF_SQL}), v AS (SELECT doc_id, count(*) AS nonzero FROM l GROUP BY doc_id)
        SELECT doc_id, 8000 AS width, coalesce(nonzero, 0) AS nonzero,
        CAST(CASE WHEN nonzero > 0 THEN 1 ELSE 0 END AS DOUBLE) AS norm FROM documents LEFT JOIN v USING (doc_id)""",
)
def _(t: Tables):
    held = F.unwrap_udt(F.col("features"))  # a sparse vector's own cells: no zero is filled in
    long = _tfidf(t).select("doc_id", held["size"].alias("width"), F.filter(held["values"], lambda v: v != 0).alias("cells"))
    square = F.aggregate("cells", F.lit(0.0), lambda acc, v: acc + v * v)
    return long.select(
        "doc_id", "width", F.size("cells").cast("long").alias("nonzero"), r6(F.sqrt(square)).alias("norm")
    )


def _tfidf(t: Tables, size: int = 8000):
    vocab = cut_lineage(ft.tfidf_vocabulary(t.documents, "doc_id", "text", max_features=size))  # read twice
    long = ft.tfidf_long(t.documents, "doc_id", "text", vocab=vocab)
    return ft.sparse_vectors(long, t.documents, "doc_id", ft.term_index(vocab), size)


@query("e2_word2vec", _WIDE_SQL)
def _(t: Tables):
    return _vector_digest(_pooled(*_word2vec(t)), "features")


@query("e3_subword_embedding", _WIDE_SQL)
def _(t: Tables):
    docs, grams = _subwords(t)
    return _vector_digest(ft.subword_pool(docs, "doc_id", F.col("tokens"), grams, _WIDTH), "features")


def _subwords(t: Tables):
    """Tokens and the n-gram vectors trained on them, once for each session and folder."""
    key = (t.spark.sparkContext.applicationId, t.folder, "grams")
    if key not in _fitted:
        docs = dealt(t.documents).select(
            "doc_id", "lang", "text", tx.clean_tokens(tx.nfc(F.col("text")), F.col("lang")).alias("tokens")
        )
        docs = cut_lineage(docs)
        grams = ft.train_subword_vectors(docs, "doc_id", F.col("tokens"), _WIDTH)
        _fitted[key] = docs, cut_lineage(grams)
    return _fitted[key]


_TOP_WORD_SQL = f"""WITH w AS (SELECT unnest({chain_sql('text')}) AS w FROM documents), c AS (SELECT w, count(*) AS n FROM w GROUP BY w)
  SELECT (SELECT w FROM c ORDER BY n DESC, w LIMIT 1) AS word, least(10, (SELECT count(*) FROM c) - 1) AS neighbours, """


@query("e3_similar_words", _TOP_WORD_SQL + "true AS falling, true AS nearer_than_most, true AS unseen_has_vector")
def _(t: Tables):
    """The nearest words of the most frequent one by its n-grams. They are ordered and nearer than
    the words' average, and a word that is in no document has a vector that isn't zero."""
    docs, grams = _subwords(t)
    counts = docs.select(F.explode("tokens").alias("w")).groupBy("w").count()
    word = counts.orderBy(F.desc("count"), "w").first().w
    unseen = F.concat(F.lit(word), F.lit(word), F.lit("x"))
    words = cut_lineage(ft.subword_word_vectors(counts.unionByName(counts.where(F.col("w") == word).select(unseen.alias("w"), "count")), "w", grams))
    made = F.col("word") == unseen
    everyone = words.where(~made)
    found = [r.similarity for r in ft.nearest_words(everyone, word, 10).collect()]  # ten rows
    mean = ft.word_similarities(everyone, word).agg(F.avg("similarity")).first()[0]
    square = F.aggregate(vector_to_array("vector"), F.lit(0.0), lambda acc, v: acc + v * v)
    return words.where(made).agg(
        F.lit(word).alias("word"), F.lit(len(found)).cast("long").alias("neighbours"),
        F.lit(all(a >= b for a, b in zip(found, found[1:]))).alias("falling"),
        F.lit(min(found) > mean).alias("nearer_than_most"), (F.max(square) > 0).alias("unseen_has_vector"),
    )


@query("j4_mean_pool", _WIDE_SQL)
def _(t: Tables):
    docs, words = _word2vec(t)
    return _vector_digest(ft.mean_pool(docs, "doc_id", F.col("tokens"), words, _WIDTH), "features")


_HASHED_SQL = f"""WITH w AS (SELECT doc_id, unnest({chain_sql('text')}) AS word FROM documents),
  h AS (SELECT doc_id, list_transform(range(8), lambda i: ascii(substr(md5(word), CAST(i + 1 AS INTEGER), 1))::DOUBLE) AS v FROM w),
  m AS (SELECT doc_id, i, avg(v[i + 1]) AS x FROM h, range(8) r(i) GROUP BY doc_id, i)"""


@query(
    "j4_mean_pool_of_hash_vectors",
    f"{_HASHED_SQL} SELECT d.doc_id, CAST(i AS INTEGER) AS pos, round(coalesce(x, 0), 9) AS x FROM documents d CROSS JOIN range(8) r(i) LEFT JOIN m USING (doc_id, i)",
)
def _(t: Tables):
    """Vectors derived from the words themselves, so that pooling is checked number by number."""
    docs = t.documents.select("doc_id", tx.clean_tokens(tx.nfc(F.col("text")), F.col("lang")).alias("tokens"))
    docs = cut_lineage(docs)  # read six times
    digits = F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.ascii(F.substring(F.md5("word"), i, F.lit(1))).cast("double"))
    words = docs.select(F.explode("tokens").alias("word")).distinct().select("word", array_to_vector(digits).alias("vector"))
    pooled = ft.mean_pool(docs, "doc_id", F.col("tokens"), words, 8, hot=50)
    return pooled.select("doc_id", F.posexplode(vector_to_array("features")).alias("pos", "x")).withColumn("x", F.round("x", 9))


@query(
    "t8_similar_words",
    f"""WITH w AS (SELECT unnest({chain_sql('text')}) AS w FROM documents), c AS (SELECT w, count(*) AS n FROM w GROUP BY w)
        SELECT (SELECT w FROM c ORDER BY n DESC, w LIMIT 1) AS word, least(10, (SELECT count(*) FROM c) - 1) AS neighbours,
        true AS known, true AS falling""",
)
def _(t: Tables):
    """The nearest words of the most frequent one: how many, all known, none itself, and no word
    left out is nearer."""
    docs, vectors = _word2vec(t)
    counts = docs.select(F.explode("tokens").alias("w")).groupBy("w").count()
    word = counts.orderBy(F.desc("count"), "w").first().w
    near = cut_lineage(ft.nearest_words(vectors, word, 10))
    left = ft.word_similarities(vectors, word).join(F.broadcast(near.select("word")), "word", "left_anti")
    near = near.join(counts.select(F.col("w").alias("word"), F.lit(True).alias("_known")), "word", "left")
    near = near.withColumn("_left", left.agg(F.max("similarity")).scalar())
    return near.agg(
        F.lit(word).alias("word"), F.count(F.lit(1)).alias("neighbours"),
        F.bool_and(F.coalesce("_known", F.lit(False)) & (F.col("word") != word)).alias("known"),
        F.coalesce(F.min("similarity") >= F.coalesce(F.first("_left"), F.lit(-2.0)), F.lit(False)),
    ).toDF("word", "neighbours", "known", "falling")


@query("s7_saved_bundle", _WIDE_SQL)
def _(t: Tables):
    """The word vectors are too many for a model on the driver, so they are a table as well."""
    docs, words = _word2vec(t)
    path = scratch_path(t.spark, "bundle")
    bundles.save_bundle(path, {"documents": docs, "word2vec": words})
    documents, again = (bundles.load_table(t.spark, path, name) for name in ("documents", "word2vec"))
    return _vector_digest(_pooled(documents, again), "features")


def _dataset(t: Tables, vectors):
    """doc_id, features, label index of the language, split column."""
    langs = ft.encode_labels(t.documents.select("doc_id", "lang"), "lang", cl.LABEL)
    rows = vectors.join(langs, "doc_id").withColumn(cl.LABEL, F.col(cl.LABEL).cast("double"))
    return cl.with_split(rows, "doc_id")


# The classes are the languages in alphabetical order; the test rows are those of the split.
_TEST_SQL = """WITH r AS (SELECT doc_id, dense_rank() OVER (ORDER BY lang) - 1 AS label,
    row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42')) AS rn,
    count(*) OVER (PARTITION BY lang) AS n FROM documents)
  SELECT doc_id, CAST(label AS INTEGER) AS actual, true AS class_valid, true AS sums_to_one, true AS agrees
  FROM r WHERE rn <= round(0.2 * n)"""


def _fit_one(t: Tables, build):
    """Predictions of the test rows, judged: the class is one of those learnt, probabilities sum
    to one, and the class is a most likely one."""
    data = _dataset(t, _pooled(*_word2vec(t))).persist()
    train = data.where("is_test = 0")
    fitted = build(train.count()).fit(train)
    preds = cut_lineage(cl.predict(fitted, data.where("is_test = 1"), "doc_id"))
    data.unpersist()
    p = F.col("probability")
    total = F.aggregate(p, F.lit(0.0), lambda acc, v: acc + v)
    return preds.select(
        "doc_id", F.col(cl.LABEL).cast("int").alias("actual"), F.col("prediction").between(0, F.size(p) - 1).alias("class_valid"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"),
        (F.get(p, F.col("prediction")) >= F.array_max(p) - 1e-9).alias("agrees"),
    )


@query("m2_logistic_regression", _TEST_SQL)
def _(t: Tables):
    return _fit_one(t, lambda n: cl.logistic(n))


@query(
    "m3_linear_svm",
    """WITH r AS (SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY l_returnflag, l_linestatus) - 1 AS INTEGER) AS actual FROM lineitem)
       SELECT l_orderkey, l_linenumber, actual, actual AS prediction, true AS gap_closed FROM r WHERE l_orderkey % 5 = 0""",
)
def _(t: Tables):
    """The flags, which can be told apart by planes, among columns that say nothing."""
    flags = [(F.col(c) == v).cast("double") for c, v in (("l_returnflag", "A"), ("l_returnflag", "N"), ("l_returnflag", "R"), ("l_linestatus", "F"))]
    noise = [F.col("l_quantity").cast("double") / 50, F.col("l_discount").cast("double"), F.col("l_tax").cast("double")]
    line = t.lineitem.withColumn("_both", F.concat_ws(" ", "l_returnflag", "l_linestatus"))
    line = ft.encode_labels(line, "_both", cl.LABEL).select("l_orderkey", "l_linenumber", F.array(*flags, *noise).alias(cl.FEATURES), cl.LABEL)
    model = cl.linear_svm(0).fit(line.where("l_orderkey % 5 <> 0"))
    return model.transform(line.where("l_orderkey % 5 = 0")).select(
        "l_orderkey", "l_linenumber", F.col(cl.LABEL).alias("actual"), F.col("prediction").cast("int").alias("prediction"),
        F.lit(model.gaps[-1] < 1e-3).alias("gap_closed"),
    )


# Trees learn a rule of two columns among four from four fifths of the orders; the rule itself
# is what they must say of the rest.
_RULE_SQL = """WITH r AS (SELECT l_orderkey, l_linenumber,
    CAST((l_quantity >= 25)::INT + (round(l_discount * 100) >= 5)::INT AS INTEGER) AS actual FROM lineitem WHERE l_orderkey % 5 = 0)
  SELECT l_orderkey, l_linenumber, actual, actual AS prediction, true AS confident, true AS loss_falls, true AS bounded FROM r"""


def _rule_learnt(t: Tables, build, most_leaves: int):
    line = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.array(*[F.col(c).cast("double") for c in ("l_quantity", "l_discount", "l_tax", "l_linenumber")]).alias(cl.FEATURES),
        ((F.col("l_quantity") >= 25).cast("int") + (F.round(F.col("l_discount") * 100) >= 5).cast("int")).alias(cl.LABEL),
    )
    model = build.fit(line.where("l_orderkey % 5 <> 0"))
    falls = all(b < a for a, b in zip(model.losses, model.losses[1:]))
    bounded = all(tree.leaves() <= most_leaves for trees in model.trees for tree in trees)
    said = model.transform(line.where("l_orderkey % 5 = 0"))
    return said.select(
        "l_orderkey", "l_linenumber", F.col(cl.LABEL).alias("actual"), F.col("prediction").cast("int").alias("prediction"),
        (F.array_max(vector_to_array("probability")) > 0.5).alias("confident"), F.lit(falls).alias("loss_falls"),
        F.lit(bounded).alias("bounded"),
    )


@query("m5_boosted_trees", _RULE_SQL)
def _(t: Tables):
    return _rule_learnt(t, cl.boosted_trees(), 64)


@query("m6_boosted_trees_full_rows", _RULE_SQL)
def _(t: Tables):
    # a round is ten jobs or more, one after another: see the README
    return _rule_learnt(t, cl.boosted_trees_best_first(rounds=30), 63)


@query("m7_perceptron", _TEST_SQL)
def _(t: Tables):
    return _fit_one(t, lambda n: cl.perceptron(_WIDTH, 4))


@query("m13_experiment_grid")
def _(t: Tables):
    docs, vectors = _word2vec(t)
    words, grams = _subwords(t)
    blocks = {
        "TF-IDF": (_tfidf(t), 8000),
        "Word2Vec": (_pooled(docs, vectors), _WIDTH),
        "Subword": (ft.subword_pool(words, "doc_id", F.col("tokens"), grams, _WIDTH), _WIDTH),
    }
    n_train = int(t.documents.count() * 0.8)
    results = []
    for name, (vectors, width) in blocks.items():
        models = cl.standard_models(width, 4, n_train)
        results.append(cl.run_block(name, _dataset(t, vectors), "doc_id", models, 4))
    return reduce(lambda a, b: a.unionByName(b), results)
