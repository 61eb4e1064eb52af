"""Aggregates, distributions, growth and dashboard blocks on the sample tables."""

from pyspark.sql import functions as F

from ..functions import numbers as num
from ..functions import text as tx
from ..operators import aggregates as agg
from ..operators import joins as jn
from ..operators import ordered as od
from ..operators import ranking as rk
from .registry import Tables, query
from .scalars import _WORDS_SQL, r6

METRIC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def rounded(df, *cols, places=6):
    return df.select(*[F.round(c, places).alias(c) if c in cols else F.col(c) for c in df.columns])


@query("a1_value_counts", "SELECT lang, count(*) AS count FROM documents GROUP BY lang ORDER BY 2 DESC, 1")
def _(t: Tables):
    return agg.value_counts(t.documents, "lang")


@query(
    "a2_share_of_all",
    "SELECT lang, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM documents), 6) AS pct FROM documents GROUP BY lang",
)
def _(t: Tables):
    return rounded(agg.share_of_all(t.documents, "lang"), "pct")


_TOP15 = "SELECT source, count(*) AS count FROM documents GROUP BY source ORDER BY 2 DESC, 1 LIMIT 15"


@query(
    "w4_share_of_shown",
    f"WITH c AS ({_TOP15}) SELECT source, count, round(100.0 * count / (SELECT sum(count) FROM c), 6) AS pct FROM c",
)
def _(t: Tables):
    return rounded(agg.share_of_shown(t.documents, "source", 15), "pct")


@query(
    "a3_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS metric, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
        round(quantile_cont({c}, 0.5), 4) AS median, round(quantile_cont({c}, 0.75), 4) AS q75,
        CAST(max({c}) AS DOUBLE) AS max FROM lineitem"""
        for c in METRIC_COLS
    ),
)
def _(t: Tables):
    return rounded(agg.describe(t.lineitem, METRIC_COLS), "mean", "std", "q25", "median", "q75", places=4)


@query(
    "a4_quantile_cutoffs",
    """SELECT round(quantile_cont(l_extendedprice, 0.33), 4) AS p33,
       round(quantile_cont(l_extendedprice, 0.66), 4) AS p66 FROM lineitem""",
)
def _(t: Tables):
    return rounded(agg.quantile_cutoffs(t.lineitem, "l_extendedprice"), "p33", "p66", places=4)


def tier_sql(col, names, table="lineitem"):
    low, mid, high = names
    return f"""CASE WHEN {col} >= (SELECT quantile_cont({col}, 0.66) FROM {table}) THEN '{high}'
      WHEN {col} < (SELECT quantile_cont({col}, 0.33) FROM {table}) THEN '{low}' ELSE '{mid}' END"""


_SENT = ("negative", "neutral", "positive")
_TIER = ("low", "medium", "high")


@query(
    "a5_engagement_label",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {tier_sql('l_discount', _SENT)} AS sentiment_label FROM lineitem",
)
def _(t: Tables):
    labelled = agg.engagement_label(t.lineitem, "l_discount")
    return labelled.select("l_orderkey", "l_linenumber", "l_partkey", "sentiment_label")


@query(
    "a6_engagement_tier",
    f"""SELECT tier, count(*) AS count FROM (SELECT {tier_sql('l_extendedprice', _TIER)} AS tier FROM lineitem)
        GROUP BY tier""",
)
def _(t: Tables):
    return agg.group_counts(agg.tier_by_quantile(t.lineitem, "l_extendedprice", "tier"), "tier")


@query(
    "a7_group_means",
    """SELECT c_mktsegment, round(avg(o_totalprice), 4) AS o_totalprice, round(avg(c_acctbal), 4) AS c_acctbal
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment ORDER BY 2""",
)
def _(t: Tables):
    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    means = agg.group_means(both, "c_mktsegment", ["o_totalprice", "c_acctbal"])
    return rounded(means, "o_totalprice", "c_acctbal", places=4).orderBy("o_totalprice")


@query(
    "a8_group_overview",
    """SELECT c_mktsegment, round(avg(o_totalprice), 4) AS avg_first, round(avg(c_acctbal), 4) AS avg_second,
       count(o_orderkey) AS row_count FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment""",
)
def _(t: Tables):
    both = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    out = agg.group_overview(both, "c_mktsegment", "o_totalprice", "c_acctbal", "o_orderkey")
    return rounded(out, "avg_first", "avg_second", places=4)


@query("a9_group_medians", "SELECT source, quantile_cont(n_chars, 0.5) AS median FROM documents GROUP BY source")
def _(t: Tables):
    return agg.group_medians(t.documents, "source", "n_chars")


_PRIORITY3 = "SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3"


@query(
    "a10_crosstab_pct",
    f"""WITH l AS (SELECT l_orderkey, {tier_sql('l_extendedprice', _TIER)} AS tier FROM lineitem),
      j AS (SELECT o_orderpriority, tier FROM l JOIN orders ON l_orderkey = o_orderkey),
      k AS (SELECT * FROM j WHERE o_orderpriority IN (
        SELECT o_orderpriority FROM j GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 3))
      SELECT o_orderpriority, round(100.0 * count(*) FILTER (tier = 'low') / count(*), 6) AS low,
        round(100.0 * count(*) FILTER (tier = 'medium') / count(*), 6) AS medium,
        round(100.0 * count(*) FILTER (tier = 'high') / count(*), 6) AS high
      FROM k GROUP BY o_orderpriority""",
)
def _(t: Tables):
    tiers = agg.tier_by_quantile(t.lineitem, "l_extendedprice", "tier").select("l_orderkey", "tier")
    orders = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    joined = tiers.join(orders, "l_orderkey").groupBy("o_orderpriority", "tier").agg(
        F.count(F.lit(1)).alias("n")
    )
    sizes = joined.groupBy("o_orderpriority").agg(F.sum("n").alias("size"))
    top = sizes.orderBy(F.desc("size"), "o_orderpriority").limit(3)
    cells = joined.join(F.broadcast(top), "o_orderpriority")
    return cells.groupBy("o_orderpriority").agg(
        *[
            r6(F.sum(F.when(F.col("tier") == v, F.col("n")).otherwise(0)) / F.sum("n") * 100).alias(v)
            for v in _TIER
        ]
    )


@query(
    "a10_lang_label_crosstab",
    """SELECT lang, round(100.0 * count(*) FILTER (quality = 0) / count(*), 6) AS "0",
       round(100.0 * count(*) FILTER (quality = 1) / count(*), 6) AS "1"
       FROM documents JOIN labels USING (doc_id) GROUP BY lang""",
)
def _(t: Tables):
    both = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    return rounded(agg.crosstab_pct(both, "lang", "quality", [0, 1]), "0", "1")


_DAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


@query(
    "a11_hour_by_weekday",
    "SELECT CAST(hour(ts) AS INTEGER) AS h, "
    + ", ".join(f'count(*) FILTER (isodow(ts) = {i + 1}) AS "{d}"' for i, d in enumerate(_DAYS))
    + " FROM events GROUP BY 1",
)
def _(t: Tables):
    e = t.events.select(F.hour("ts").alias("h"), num.weekday_number(F.col("ts")).alias("wd"))
    return agg.hour_by_weekday(e, "h", "wd")


def corr_sql(where="true"):
    cells = [
        f"""SELECT '{a}' AS "left", '{b}' AS "right", {i} AS i, {j} AS j, round(corr({a}, {b}), 6) AS r FROM lineitem"""
        for i, a in enumerate(METRIC_COLS) for j, b in enumerate(METRIC_COLS)
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(cells)}) WHERE {where}"


@query("a12_correlation_matrix", corr_sql())
def _(t: Tables):
    return rounded(agg.correlation_matrix(t.lineitem, [*METRIC_COLS, "absent"]), "r")


@query("a13_lower_triangle", corr_sql("i > j"))
def _(t: Tables):
    return rounded(agg.lower_triangle(agg.correlation_matrix(t.lineitem, METRIC_COLS)), "r")


@query(
    "t5_strongest_partners",
    f"""SELECT "right" AS partner, r FROM ({corr_sql()}) WHERE "left" = 'l_quantity' AND "right" <> 'l_quantity'
        ORDER BY abs(r) DESC, partner LIMIT 5""",
)
def _(t: Tables):
    matrix = agg.correlation_matrix(t.lineitem, METRIC_COLS)
    return rounded(agg.strongest_partners(matrix, "l_quantity"), "r")


@query(
    "a14_null_report",
    """WITH b AS (SELECT d.doc_id, lang, quality, toxic, CASE WHEN lang = 'en' THEN source END AS en_source
         FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
       c AS (SELECT 'quality' AS "column", count(*) - count(quality) AS nulls, count(*) AS n FROM b UNION ALL
         SELECT 'toxic', count(*) - count(toxic), count(*) FROM b UNION ALL
         SELECT 'en_source', count(*) - count(en_source), count(*) FROM b UNION ALL
         SELECT 'lang', count(*) - count(lang), count(*) FROM b)
       SELECT "column", nulls, round(100.0 * nulls / n, 6) AS pct FROM c WHERE nulls > 0""",
)
def _(t: Tables):
    both = t.documents.join(t.labels, "doc_id", "left").select(
        "doc_id", "lang", "quality", "toxic",
        F.when(F.col("lang") == "en", F.col("source")).alias("en_source"),
    )
    return rounded(agg.null_report(both), "pct")


@query("a15_distinct_count", "SELECT count(DISTINCT source) AS n_distinct FROM documents")
def _(t: Tables):
    return agg.distinct_count(t.documents, "source")


@query(
    "a15_approx_distinct_count",
    "SELECT count(DISTINCT l_partkey) AS n_distinct, true AS within FROM lineitem",
)
def _(t: Tables):
    """The exact count, and whether the estimate is within four times its standard error of it."""
    exact = agg.distinct_count(t.lineitem, "l_partkey")
    estimate = agg.approx_distinct_count(t.lineitem, "l_partkey").scalar()
    return exact.withColumn("_estimate", estimate).select(
        "n_distinct", (F.abs(F.col("_estimate") - F.col("n_distinct")) <= 0.04 * F.col("n_distinct")).alias("within")
    )


@query(
    "a16_domain",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders ORDER BY 1",
)
def _(t: Tables):
    return agg.domain(t.orders.select(F.year("o_orderdate").alias("y")), "y")


@query("a16_extremes", "SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS min, CAST(max(year(o_orderdate)) AS INTEGER) AS max FROM orders")
def _(t: Tables):
    return agg.extremes(t.orders.select(F.year("o_orderdate").alias("y")), "y")


_KPI_SQL = f"""
WITH b AS (SELECT *, {tier_sql('l_discount', _SENT)} AS label,
  CASE WHEN l_tax > 0 THEN 1 ELSE 0 END AS has_tax FROM lineitem)
SELECT count(*) AS total, count(DISTINCT l_returnflag) AS categories,
  round(sum(l_extendedprice), 2) AS views_sum, round(avg(l_extendedprice), 4) AS views_mean,
  sum(l_quantity) AS likes_sum, round(avg(l_quantity), 6) AS likes_mean,
  round(avg(l_discount), 6) AS score_mean, round(quantile_cont(l_discount, 0.5), 6) AS score_median,
  round(100.0 * avg((label = 'positive')::INT), 6) AS positive_pct,
  round(100.0 * avg((label = 'negative')::INT), 6) AS negative_pct,
  round(100.0 * avg(has_tax), 6) AS has_tax_pct FROM b"""


@query("a17_kpi_block", _KPI_SQL)
def _(t: Tables):
    rows = agg.engagement_label(t.lineitem, "l_discount", "label").withColumn(
        "has_tax", (F.col("l_tax") > 0).cast("int")
    )
    block = agg.kpi_block(
        rows, category="l_returnflag", views="l_extendedprice", likes="l_quantity",
        score="l_discount", label="label", positive="positive", negative="negative", flags=["has_tax"],
    )
    block = rounded(block, "views_sum", places=2)
    block = rounded(block, "views_mean", places=4)
    return rounded(block, "likes_mean", "score_mean", "score_median", "positive_pct", "negative_pct", "has_tax_pct")


@query(
    "a18_content_stats",
    f"""WITH b AS (SELECT n_chars, {_WORDS_SQL.format('text')} AS words, (lang = 'en')::INT AS english,
         (contains(text, '@'))::INT AS mention FROM documents),
       s AS (SELECT CAST(count(*) AS DOUBLE) AS a, avg(n_chars) AS b, avg(words) AS c, 100 * avg(english) AS d,
         100 * avg(mention) AS e FROM b)
       SELECT 'count' AS metric, a AS value FROM s UNION ALL SELECT 'avg_chars', round(b, 6) FROM s
       UNION ALL SELECT 'avg_words', round(c, 6) FROM s UNION ALL SELECT 'english_pct', round(d, 6) FROM s
       UNION ALL SELECT 'mention_pct', round(e, 6) FROM s""",
)
def _(t: Tables):
    rows = t.documents.select(
        "n_chars", tx.word_count(F.col("text")).alias("words"),
        (F.col("lang") == "en").cast("int").alias("english"),
        F.col("text").contains("@").cast("int").alias("mention"),
    )
    block = agg.content_stats(
        rows, means={"avg_chars": "n_chars", "avg_words": "words"},
        shares={"english_pct": "english", "mention_pct": "mention"},
    )
    return rounded(block, "value")


@query(
    "a19_peak_group",
    "SELECT CAST(hour(ts) AS INTEGER) AS h, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1",
)
def _(t: Tables):
    return agg.peak_group(t.events.select(F.hour("ts").alias("h")), "h")


def hist_sql(value, table, bins, by=""):
    cols = f"{by}, " if by else ""
    group = f"{cols}bin"
    return f"""WITH x AS (SELECT {cols}{value} AS x FROM {table}), e AS (SELECT min(x) AS lo, max(x) AS hi FROM x),
      b AS (SELECT {cols}CAST(least(floor((x - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER) AS bin, lo, (hi - lo) / {bins} AS w
            FROM x, e)
      SELECT {cols}bin, round(min(lo) + bin * min(w), 6) AS bin_start, round(min(lo) + (bin + 1) * min(w), 6) AS bin_end,
      count(*) AS count FROM b GROUP BY {group}"""


@query("a20_log_histogram", hist_sql("ln(1 + l_extendedprice)", "lineitem", 60))
def _(t: Tables):
    return rounded(agg.histogram(t.lineitem, "l_extendedprice", 60, log=True), "bin_start", "bin_end")


@query(
    "a20_log_mean",
    "SELECT round(avg(ln(1 + l_extendedprice)), 6) AS log_mean, round(avg(l_extendedprice), 4) AS mean FROM lineitem",
)
def _(t: Tables):
    out = agg.log_mean(t.lineitem, "l_extendedprice")
    return out.select(r6(F.col("log_mean")).alias("log_mean"), F.round("mean", 4).alias("mean"))


@query("a21_split_histogram", hist_sql("CAST(n_chars AS DOUBLE)", "documents JOIN labels USING (doc_id)", 50, "quality"))
def _(t: Tables):
    both = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return rounded(agg.histogram(both, "n_chars", 50, by=["quality"]), "bin_start", "bin_end")


_TOP10 = "SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 10"


@query(
    "a22_box_stats",
    f"""WITH d AS (SELECT source, CAST(n_chars AS DOUBLE) AS v FROM documents WHERE source IN ({_TOP10})),
      q AS (SELECT source, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
            FROM d GROUP BY source)
      SELECT source, q1, median, q3,
        min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
        max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
        count(*) FILTER (v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers,
        count(*) AS n FROM d JOIN q USING (source) GROUP BY source, q1, median, q3""",
)
def _(t: Tables):
    return agg.box_stats(t.documents, "source", "n_chars")


def density_sql(value, group, table, points, tops):
    return f"""WITH d AS (SELECT {group} AS g, CAST({value} AS DOUBLE) AS v FROM {table} WHERE {group} IN ({tops})),
      c AS (SELECT g, v, count(*) AS c FROM d GROUP BY g, v),
      s AS (SELECT g, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h FROM d GROUP BY g)
      SELECT g AS {group}, CAST(p.range AS INTEGER) AS point, round(any_value(lo + p.range * (hi - lo) / {points - 1}), 6) AS at,
      round(sum(c * exp(-0.5 * pow((v - (lo + p.range * (hi - lo) / {points - 1})) / h, 2))) / any_value(n * h * sqrt(2 * pi())), 9) AS density
      FROM c JOIN s USING (g), range({points}) p GROUP BY g, p.range"""


def _density(df, group, value, points):
    d = agg.density(df, group, value, points=points)
    return d.select(group, "point", r6(F.col("at")).alias("at"), F.round("density", 9).alias("density"))


@query("a23_density", density_sql("n_chars", "source", "documents", 64, _TOP10))
def _(t: Tables):
    return _density(t.documents, "source", "n_chars", 64)


@query(
    "a24_monthly_counts",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus, count(*) AS count FROM orders
       WHERE year(o_orderdate) >= 1997 GROUP BY 1, 2""",
)
def _(t: Tables):
    return agg.monthly_counts(t.orders, "o_orderdate", "o_orderstatus", 1997)


@query(
    "a24_monthly_counts_dense",
    """WITH c AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderstatus, count(*) AS n FROM orders
         WHERE year(o_orderdate) >= 1997 GROUP BY 1, 2),
       m AS (SELECT CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM c),
       s AS (SELECT unnest(['F', 'O', 'P', 'X']) AS o_orderstatus)
       SELECT m.month, s.o_orderstatus, coalesce(n, 0) AS count FROM m CROSS JOIN s LEFT JOIN c
       ON c.month = m.month AND c.o_orderstatus = s.o_orderstatus""",
)
def _(t: Tables):
    return agg.monthly_counts(t.orders, "o_orderdate", "o_orderstatus", 1997, densify=["F", "O", "P", "X"])


@query("a25_counts_by_hour", "SELECT CAST(hour(ts) AS INTEGER) AS h, count(*) AS count FROM events GROUP BY 1 ORDER BY 1")
def _(t: Tables):
    return agg.counts_by_key(t.events.select(F.hour("ts").alias("h")), "h")


@query(
    "a26_counts_by_weekday",
    """SELECT CAST(isodow(ts) - 1 AS INTEGER) AS wd, count(*) AS count,
       (['Mon','Tue','Wed','Thu','Fri','Sat','Sun'])[isodow(ts)] AS day_name FROM events GROUP BY ALL""",
)
def _(t: Tables):
    return agg.counts_by_weekday(t.events.select(num.weekday_number(F.col("ts")).alias("wd")), "wd")


@query(
    "a27_counts_by_year",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS count FROM orders
       WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1""",
)
def _(t: Tables):
    return agg.counts_by_year(t.orders.select(F.year("o_orderdate").alias("y")), "y", 1996, 2000)


@query(
    "a28_token_frequency",
    r"""WITH w AS (SELECT unnest(regexp_split_to_array(text, '\s+')) AS token FROM documents)
       SELECT token, count(*) AS count FROM w WHERE token <> '' GROUP BY token ORDER BY 2 DESC, 1 LIMIT 30""",
)
def _(t: Tables):
    return agg.token_frequency(t.documents, tx.words(F.col("text")), 30)


@query(
    "a29_label_distribution",
    "SELECT toxic, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM labels), 6) AS pct FROM labels GROUP BY toxic",
)
def _(t: Tables):
    return rounded(agg.share_of_all(t.labels, "toxic"), "pct")


@query(
    "a30_hierarchy",
    """SELECT source AS name, 'Sources' AS parent, count(*) AS size FROM documents
       GROUP BY source ORDER BY 3 DESC, 1 LIMIT 20""",
)
def _(t: Tables):
    return agg.hierarchy(t.documents, "source", "Sources")


@query(
    "w1_growth",
    """WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS count FROM orders GROUP BY 1)
       SELECT y, count, round((count / lag(count) OVER (ORDER BY y) - 1) * 100, 6) AS growth FROM c""",
)
def _(t: Tables):
    counts = agg.group_counts(t.orders.select(F.year("o_orderdate").alias("y")), "y")
    return rounded(rk.growth(counts, "y"), "growth")


@query(
    "q1_top_channels",
    """SELECT c_custkey, round(sum(o_totalprice), 2) AS total, count(*) AS orders FROM orders
       JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(t: Tables):
    both = t.orders.join(t.customer.select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"))
    sums = both.groupBy("c_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("orders")
    )
    return rk.top_rows(sums, "total", 10, ["c_custkey"])


@query(
    "q1_top_uploaders",
    "SELECT o_custkey, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
)
def _(t: Tables):
    return agg.top_groups(t.orders, "o_custkey", 15)


@query("q2_duration_histogram", hist_sql("CAST(l_quantity AS DOUBLE)", "lineitem", 50))
def _(t: Tables):
    return rounded(agg.histogram(t.lineitem, "l_quantity", 50), "bin_start", "bin_end")


@query("q2_score_density", density_sql("l_discount", "l_returnflag", "lineitem", 64, "SELECT DISTINCT l_returnflag FROM lineitem"))
def _(t: Tables):
    return _density(t.lineitem, "l_returnflag", "l_discount", 64)


@query("x3_union_blocks", "SELECT 'orders' AS block, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events")
def _(t: Tables):
    def block(name, df):
        return df.agg(F.count(F.lit(1)).alias("n")).withColumn("block", F.lit(name))

    return jn.union_blocks([block("orders", t.orders), block("events", t.events)])
