"""Sources, derivations, filters, samples and column-level joins on the sample tables."""

from pyspark.sql import functions as F

from ..functions import numbers as num
from ..functions import text as tx
from ..operators import aggregates as agg
from ..operators import filters as flt
from ..operators import joins as jn
from ..operators import ordered as od
from ..operators import ranking as rk
from ..session import scratch_path
from ..sources import files, payload
from ..sources.schemas import VIDEO_RECORD
from .registry import Tables, query


def r6(col):
    return F.round(col, 6)


# --- sources and sinks ----------------------------------------------------------------------


@query("s1_read_csv_fixed_schema", "SELECT doc_id, lang, source, n_chars, md5(text) AS text_hash FROM documents")
def _(t: Tables):
    path = scratch_path(t.spark, "documents-csv")
    files.write_csv(t.documents.select("doc_id", "text", "lang", "source", "n_chars"), path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    back = files.read_csv(t.spark, path, schema)
    return back.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("text_hash"))


@query("s2_read_stage_parquet", "SELECT doc_id, lang, n_chars FROM documents")
def _(t: Tables):
    return files.read_parquet(t.spark, t.path("documents"), ["doc_id", "lang", "n_chars", "absent"])


@query("s3_write_read_round_trip", "SELECT doc_id, lang, source, n_chars FROM documents")
def _(t: Tables):
    path = scratch_path(t.spark, "documents-stage")
    files.write_parquet(t.documents, path, partition_by=["lang"])
    return files.read_parquet(t.spark, path, ["doc_id", "lang", "source", "n_chars"])


@query(
    "s4_append_batches",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type",
)
def _(t: Tables):
    path = scratch_path(t.spark, "events-log")
    events = t.events.select("event_id", "event_type", "value")
    for part in (F.col("event_type") == "view", F.col("event_type") != "view"):
        files.append_csv(events.where(part), path)
    log = files.read_csv(t.spark, path, "event_id long, event_type string, value double")
    return log.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query("s5_pruned_scan", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def _(t: Tables):
    keep = ["o_orderkey", "o_orderpriority", "o_totalprice", "not_there"]
    return files.read_parquet(t.spark, t.path("orders"), keep)


@query(
    "s6_json_items",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def _(t: Tables):
    wrapped = t.events.select(
        F.concat(
            F.lit('{"items":[{"id":"'), F.col("event_id"), F.lit('","more":'), F.col("props"), F.lit("}]}")
        ).alias("payload")
    )
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string("items array<struct<id: string, more: struct<k: bigint>>>")
    items = payload.parse_items(wrapped, "payload", schema)
    return items.select(F.col("item.id").cast("bigint").alias("event_id"), F.col("item.more.k").alias("k"))


@query(
    "s8_cached_reuse",
    "SELECT label, count(*) AS n FROM embeddings GROUP BY label",
)
def _(t: Tables):
    kept = t.embeddings.select("vec_id", "label").persist()
    return kept.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("s9_shape_report", 'SELECT count(*) AS "rows", 5 AS cols FROM documents')
def _(t: Tables):
    return agg.shape(t.documents)


@query(
    "s10_preview",
    "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 5",
)
def _(t: Tables):
    return files.preview(t.documents, ["doc_id", "lang", "source", "n_chars"], ["doc_id"], 5)


# --- derivations ----------------------------------------------------------------------------


@query("p1_drop_columns", "SELECT doc_id, text, lang FROM documents")
def _(t: Tables):
    return t.documents.drop("source", "n_chars", "not_there")


_RECORD_SQL = """
WITH e AS (
  SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
)
SELECT CAST(event_id AS VARCHAR) AS video_id, CAST(user_id AS VARCHAR) AS channel_id,
  event_type AS title, '' AS description, event_type || ',' || CAST(k AS VARCHAR) AS tags,
  CAST(hour(ts) AS INTEGER) AS upload_hour, CAST(isodow(ts) - 1 AS INTEGER) AS upload_day_of_week,
  CAST(k * 60 + 5 AS DOUBLE) AS duration, k AS view_count, CAST(floor(value) AS BIGINT) AS like_count,
  CAST(0 AS BIGINT) AS comment_count,
  CASE WHEN k > 0 THEN round(floor(value) / k, 6) ELSE 0 END AS like_view_ratio,
  CASE WHEN k > 0 THEN round(floor(value) / k, 6) ELSE 0 END AS engagement_score,
  coalesce(c_mktsegment, '') AS channel_country, CAST(c_nationkey AS BIGINT) AS subscriber_count,
  round((epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts))) / 3600.0, 6) AS video_age_hours,
  false AS licensed_content, CAST(NULL AS DOUBLE) AS toxic_ratio,
  '2024-02-01T00:00:00Z' AS collected_at
FROM e LEFT JOIN customer ON user_id = c_custkey
"""


@query("p2_flat_record", _RECORD_SQL)
def _(t: Tables):
    k = F.get_json_object("props", "$.k")
    item = F.struct(
        F.col("event_id").cast("string").alias("id"),
        F.struct(
            F.col("user_id").cast("string").alias("channelId"),
            F.col("event_type").alias("title"),
            F.array("event_type", k).alias("tags"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        ).alias("snippet"),
        F.struct(F.concat(F.lit("PT"), k, F.lit("M5S")).alias("duration")).alias("contentDetails"),
        F.struct(
            k.alias("viewCount"), F.floor("value").cast("string").alias("likeCount")
        ).alias("statistics"),
    )
    responses = t.events.select(F.to_json(F.struct(F.array(item).alias("items"))).alias("payload"))
    channel = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.col("c_mktsegment").alias("country")).alias("snippet"),
        F.struct(F.col("c_nationkey").cast("string").alias("subscriberCount")).alias("statistics"),
    )
    channels = t.customer.select(F.to_json(F.struct(F.array(channel).alias("items"))).alias("payload"))
    records = payload.video_records(
        responses, "payload", payload.channel_attributes(channels, "payload"),
        F.to_timestamp(F.lit("2024-02-01 00:00:00")),
    )
    assert records.columns == VIDEO_RECORD.names
    return records.select(
        "video_id", "channel_id", "title", "description", "tags", "upload_hour",
        "upload_day_of_week", "duration", "view_count", "like_count", "comment_count",
        r6(F.col("like_view_ratio")).alias("like_view_ratio"),
        r6(F.col("engagement_score")).alias("engagement_score"),
        "channel_country", "subscriber_count", r6(F.col("video_age_hours")).alias("video_age_hours"),
        "licensed_content", "toxic_ratio", "collected_at",
    )


@query(
    "p3_null_defaults",
    """SELECT d.doc_id, coalesce(CAST(toxic AS VARCHAR), 'neutral') AS toxic_label,
       coalesce(quality, 0) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t: Tables):
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return both.select(
        "doc_id", F.coalesce(F.col("toxic").cast("string"), F.lit("neutral")).alias("toxic_label"),
        F.coalesce("quality", F.lit(0)).alias("quality"),
    )


@query("p4_text_length", "SELECT doc_id, CAST(length(text) AS INTEGER) AS chars FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.char_count(F.col("text")).alias("chars"))


_WORDS_SQL = r"len([x for x in regexp_split_to_array({0}, '\s+') if x <> ''])"


@query("p5_word_count", f"SELECT doc_id, CAST({_WORDS_SQL.format('text')} AS INTEGER) AS words FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.word_count(F.col("text")).alias("words"))


@query(
    "p6_presence_flag",
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 0 ELSE 1 END AS has_label
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t: Tables):
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return both.select("doc_id", tx.presence_flag(F.col("quality")).alias("has_label"))


@query(
    "p7_delimited_count",
    """SELECT doc_id, CAST(len(string_split(text, ',')) AS INTEGER) AS items,
       CAST(CASE WHEN lang = 'en' THEN len(string_split(text, ',')) ELSE 0 END AS INTEGER) AS english_items
       FROM documents""",
)
def _(t: Tables):
    english = F.when(F.col("lang") == "en", F.col("text"))
    return t.documents.select(
        "doc_id", tx.delimited_count(F.col("text")).alias("items"),
        tx.delimited_count(english).alias("english_items"),
    )


@query(
    "p8_joined_fields",
    """SELECT p_partkey, trim(p_name || ' ' || CASE WHEN p_size > 25 THEN '' ELSE p_brand END || ' ' || p_type)
       AS combined FROM part""",
)
def _(t: Tables):
    brand = F.when(F.col("p_size") <= 25, F.col("p_brand"))
    return t.part.select(
        "p_partkey", tx.join_fields(F.col("p_name"), brand, F.col("p_type")).alias("combined")
    )


@query(
    "p9_language_label",
    """SELECT d.doc_id, CASE WHEN toxic IS NULL AND lang = 'en' THEN 'unknown' ELSE lang END AS language
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t: Tables):
    both = t.documents.join(t.labels, "doc_id", "left")
    first = F.when(F.col("toxic").isNotNull(), F.concat(F.lit(" \t"), F.upper("lang"), F.lit("\n")))
    second = F.when(F.col("lang") != "en", F.col("lang"))
    return both.select("doc_id", tx.language_label(first, second).alias("language"))


@query(
    "p10_year_month",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m
       FROM orders""",
)
def _(t: Tables):
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))


@query(
    "p11_guarded_ratios",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       round(CASE WHEN l_tax > 0 THEN l_discount / l_tax ELSE 0 END, 6) AS ratio,
       round(CASE WHEN l_extendedprice > 0 THEN (l_quantity + l_tax) / l_extendedprice ELSE 0 END, 6) AS score
       FROM lineitem""",
)
def _(t: Tables):
    c = F.col
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        r6(num.guarded_ratio(c("l_discount"), c("l_tax"))).alias("ratio"),
        r6(num.guarded_ratio(c("l_quantity") + c("l_tax"), c("l_extendedprice"))).alias("score"),
    )


@query(
    "p12_hour_weekday_age",
    """SELECT event_id, CAST(hour(ts) AS INTEGER) AS h, CAST(isodow(ts) - 1 AS INTEGER) AS wd,
       round((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 1e6 / 3600.0, 6) AS age_hours FROM events""",
)
def _(t: Tables):
    now = F.to_timestamp(F.lit("2024-02-01 00:00:00"))
    return t.events.select(
        "event_id", F.hour("ts").alias("h"), num.weekday_number(F.col("ts")).alias("wd"),
        r6(num.age_hours(F.col("ts"), now)).alias("age_hours"),
    )


@query(
    "p13_age_days",
    """SELECT o_orderkey, (epoch(TIMESTAMP '2002-01-01') - epoch(o_orderdate)) / 86400.0 AS age_days
       FROM orders""",
)
def _(t: Tables):
    now = F.to_timestamp(F.lit("2002-01-01 00:00:00"))
    return t.orders.select("o_orderkey", num.age_days(F.col("o_orderdate"), now).alias("age_days"))


@query(
    "p14_iso_duration",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag
         WHEN 'A' THEN CAST(l_quantity AS INTEGER) * 60e0 + l_linenumber
         WHEN 'R' THEN l_linenumber * 86400e0 + CAST(l_quantity AS INTEGER) * 3600e0 END AS seconds
       FROM lineitem""",
)
def _(t: Tables):
    q, n = F.col("l_quantity").cast("int"), F.col("l_linenumber")
    text = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("PT"), q, F.lit("M"), n, F.lit("S")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("P"), n, F.lit("DT"), q, F.lit("H")))
        .otherwise(F.concat(F.lit("P"), n, F.lit("M")))
    )
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", num.iso_duration_seconds(text).alias("seconds")
    )


@query(
    "p15_text_to_count",
    """SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k,
       CASE WHEN event_type = 'view' THEN event_id ELSE 0 END AS views FROM events""",
)
def _(t: Tables):
    views = F.when(F.col("event_type") == "view", F.col("event_id").cast("string")).when(
        F.col("event_type") == "click", F.lit("")
    )
    return t.events.select(
        "event_id", num.to_count(F.get_json_object("props", "$.k")).alias("k"),
        num.to_count(views).alias("views"),
    )


@query(
    "p16_list_to_string",
    """WITH u AS (SELECT DISTINCT user_id, event_type FROM events)
       SELECT c_custkey, coalesce(string_agg(event_type, ',' ORDER BY event_type), '') AS kinds
       FROM customer LEFT JOIN u ON c_custkey = user_id GROUP BY c_custkey""",
)
def _(t: Tables):
    kinds = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("k"))
    both = t.customer.select("c_custkey").join(kinds, F.col("c_custkey") == F.col("user_id"), "left")
    return both.select("c_custkey", tx.join_list(F.col("k")).alias("kinds"))


@query(
    "p17_constants",
    """SELECT o_orderkey, CAST(NULL AS DOUBLE) AS positive_ratio, 0 AS num_related,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM orders""",
)
def _(t: Tables):
    return t.orders.select(
        "o_orderkey", F.lit(None).cast("double").alias("positive_ratio"), F.lit(0).alias("num_related"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("stamp"),
    )


@query(
    "p18_parse_timestamp",
    """SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL
       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed FROM events""",
)
def _(t: Tables):
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("x"), F.col("event_id"))).when(
        F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    parsed = num.parse_timestamp(text)
    return t.events.select("event_id", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query(
    "p19_downcast",
    """SELECT l_orderkey, l_linenumber, l_partkey, TRY_CAST(l_partkey AS SMALLINT) AS part_small,
       CAST(l_discount AS FLOAT) AS discount_small FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_partkey").try_cast("smallint").alias("part_small"),
        F.col("l_discount").try_cast("float").alias("discount_small"),
    )


@query(
    "p20_coalesce_chain",
    """SELECT d.doc_id, coalesce(CASE WHEN quality = 1 THEN source END, CASE WHEN lang <> 'en' THEN lang END,
       'unknown') AS lang_clean FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t: Tables):
    both = t.documents.join(t.labels, "doc_id", "left")
    return both.select(
        "doc_id",
        F.coalesce(
            F.when(F.col("quality") == 1, F.col("source")),
            F.when(F.col("lang") != "en", F.col("lang")), F.lit("unknown"),
        ).alias("lang_clean"),
    )


@query(
    "p21_log_transforms",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(ln(1 + l_extendedprice), 6) AS log1p_price,
       round(log10(greatest(l_discount * 100, 1)), 6) AS log10_discount FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        r6(num.log_plus_one(F.col("l_extendedprice"))).alias("log1p_price"),
        r6(num.log_ten(F.col("l_discount") * 100)).alias("log10_discount"),
    )


def human_sql(v):
    return f"""CASE WHEN {v} >= 1e9 THEN printf('%.1fB', round({v} / 1e9, 1))
      WHEN {v} >= 1e6 THEN printf('%.1fM', round({v} / 1e6, 1))
      WHEN {v} >= 1e3 THEN printf('%.1fK', round({v} / 1e3, 1))
      ELSE CAST(CAST(trunc({v}) AS BIGINT) AS VARCHAR) END"""


@query(
    "p22_human_number",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {human_sql('(l_quantity * l_quantity * l_quantity)')} AS small,
        {human_sql('(l_extendedprice * 100)')} AS mid, {human_sql('(l_extendedprice * l_extendedprice)')} AS big
        FROM lineitem""",
)
def _(t: Tables):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", num.human_number(q * q * q).alias("small"),
        num.human_number(p * 100).alias("mid"), num.human_number(p * p).alias("big"),
    )


@query(
    "p23_display_case",
    """SELECT doc_id, upper(lang[1]) || lang[2:] AS title_case, upper(source) AS upper_case FROM documents""",
)
def _(t: Tables):
    return t.documents.select(
        "doc_id", tx.display_title(F.col("lang")).alias("title_case"), F.upper("source").alias("upper_case")
    )


@query("p24_shorten", "SELECT doc_id, substring(text, 1, 60) AS short FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.shorten(F.col("text"), 60).alias("short"))


@query(
    "p25_ascii_only",
    r"SELECT doc_id, md5(regexp_replace(text, '[^\x00-\x7F]', '?', 'g')) AS ascii_hash FROM documents",
)
def _(t: Tables):
    return t.documents.select("doc_id", F.md5(tx.ascii_only(F.col("text"))).alias("ascii_hash"))


@query(
    "p26_weekday_name",
    """SELECT event_id, (['Mon','Tue','Wed','Thu','Fri','Sat','Sun'])[isodow(ts)] AS day_name FROM events""",
)
def _(t: Tables):
    return t.events.select("event_id", num.weekday_name(num.weekday_number(F.col("ts"))).alias("day_name"))


@query(
    "p27_rounding",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice, 1) AS price1,
       round(l_extendedprice / 7, 4) AS price4 FROM lineitem""",
)
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round("l_extendedprice", 1).alias("price1"),
        F.round(F.col("l_extendedprice") / 7, 4).alias("price4"),
    )


@query(
    "p28_display_name",
    """SELECT o_orderkey, o_orderstatus || ' + ' || o_orderpriority AS "Model" FROM orders""",
)
def _(t: Tables):
    name = num.display_name(F.col("o_orderstatus"), F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", name.alias("name")).withColumnRenamed("name", "Model")


_LINE_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _scatter(t: Tables, y: str):
    rows = t.lineitem.withColumn("id", F.expr(_LINE_ID))
    picked = od.exact_sample(rows, "id", 8000)
    return picked.select(
        "id", r6(num.log_ten(F.col("l_extendedprice"))).alias("x_log"),
        r6(num.log_ten(F.col(y))).alias("y_log"), "l_returnflag", "l_extendedprice", y,
    )


def _scatter_sql(y: str) -> str:
    return f"""SELECT {_LINE_ID} AS id, round(log10(greatest(l_extendedprice, 1)), 6) AS x_log,
      round(log10(greatest({y}, 1)), 6) AS y_log, l_returnflag, l_extendedprice, {y}
      FROM lineitem ORDER BY md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) || ':42') LIMIT 8000"""


@query("p29_log_scatter", _scatter_sql("l_quantity"))
def _(t: Tables):
    return _scatter(t, "l_quantity")


@query("q3_views_comments_scatter", _scatter_sql("l_linenumber"))
def _(t: Tables):
    return _scatter(t, "l_linenumber")


# --- filters --------------------------------------------------------------------------------


@query("f1_keep_nonblank", r"SELECT doc_id FROM documents WHERE regexp_matches(text, '\S')")
def _(t: Tables):
    return flt.keep_nonblank(t.documents, "text").select("doc_id")


@query(
    "f2_min_tokens_report",
    f"""SELECT count(*) AS before, count(*) FILTER ({_WORDS_SQL.format('text')} >= 40) AS kept,
        count(*) - count(*) FILTER ({_WORDS_SQL.format('text')} >= 40) AS removed FROM documents""",
)
def _(t: Tables):
    counted = t.documents.select(tx.word_count(F.col("text")).alias("n"))
    return flt.min_tokens_report(counted, "n", 40)


@query(
    "f3_year_range",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998",
)
def _(t: Tables):
    years = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"))
    return flt.between(years, "y", 1996, 1998)


@query(
    "f4_facet_filter",
    """SELECT o_orderkey, c_mktsegment, o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE c_mktsegment = 'MACHINERY' AND o_orderstatus IN ('F', 'O')
       AND year(o_orderdate) BETWEEN 1996 AND 1999""",
)
def _(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).withColumn(
        "y", F.year("o_orderdate")
    )
    kept = flt.facet_filter(
        rows, equal={"c_mktsegment": "MACHINERY", "o_orderpriority": flt.ALL},
        one_of={"o_orderstatus": ["F", "O"]}, ranges={"y": (1996, 1999)},
    )
    return kept.select("o_orderkey", "c_mktsegment", "o_orderstatus")


@query(
    "f5_drop_missing",
    """SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE quality IS NOT NULL""",
)
def _(t: Tables):
    both = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return flt.drop_missing(both, "quality").select("doc_id", "quality")


@query(
    "f6_first_seen",
    """SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id,
       arg_min(event_type, (ts, event_id)) AS event_type
       FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL GROUP BY user_id""",
)
def _(t: Tables):
    first = flt.first_seen(
        t.events.select("user_id", "event_id", "ts", "event_type"), ["user_id", "event_id"], ["ts", "event_id"]
    )
    return first.select("user_id", "event_id", "event_type")


@query(
    "f7_empty_guard",
    "SELECT count(*) = 0 AS no_data FROM orders WHERE o_orderpriority = 'NONE SUCH'",
)
def _(t: Tables):
    return flt.emptiness(flt.facet_filter(t.orders, equal={"o_orderpriority": "NONE SUCH"}))


@query(
    "f8_exact_sample",
    "SELECT doc_id, lang FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':42') LIMIT 500",
)
def _(t: Tables):
    return od.exact_sample(t.documents.select("doc_id", "lang"), "doc_id", 500)


# --- joins ----------------------------------------------------------------------------------


@query(
    "j1_lookup_left",
    """SELECT o_orderkey, coalesce(c_mktsegment, '') AS segment, coalesce(c_acctbal, 0) AS balance
       FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""",
)
def _(t: Tables):
    dim = t.customer.where("c_acctbal > 0").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )
    facts = t.orders.select("o_orderkey", "o_custkey")
    return jn.lookup_left(facts, dim, "o_custkey", {"segment": "", "balance": 0.0}).drop("o_custkey")


@query(
    "j2_keep_top_groups",
    """SELECT doc_id, source FROM documents WHERE source IN (
       SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 10)""",
)
def _(t: Tables):
    return jn.keep_top_groups(t.documents.select("doc_id", "source"), "source", 10)


@query(
    "j5_decode_labels",
    """WITH t AS (SELECT label, 'group ' || CAST(dense_rank() OVER (ORDER BY label) - 1 AS VARCHAR) AS label_name
       FROM (SELECT DISTINCT label FROM embeddings))
       SELECT vec_id, label, label_name FROM embeddings JOIN t USING (label)""",
)
def _(t: Tables):
    table = t.embeddings.select("label").distinct().withColumn(
        "label_name", F.concat(F.lit("group "), F.col("label"))
    )
    return jn.decode_labels(t.embeddings.select("vec_id", "label"), "label", table, "label_name")


@query(
    "j6_by_group_size",
    """SELECT lang, round(100.0 * count(*) FILTER (toxic = 1) / count(*), 6) AS toxic_pct,
       round(100.0 * count(*) FILTER (toxic = 0) / count(*), 6) AS clean_pct,
       count(*) AS group_size FROM documents JOIN labels USING (doc_id)
       GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 3""",
)
def _(t: Tables):
    both = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    table = agg.crosstab_pct(both, "lang", "toxic", [0, 1])
    ordered = jn.by_group_size(table, both, "lang", 3)
    return ordered.select("lang", r6(F.col("1")).alias("toxic_pct"), r6(F.col("0")).alias("clean_pct"), "group_size")


@query(
    "j7_remove_seen",
    """SELECT event_id, event_type FROM events WHERE user_id NOT IN
       (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 60)""",
)
def _(t: Tables):
    landed = t.events.where("event_type = 'signup' AND value > 60").select("user_id").distinct()
    return jn.remove_seen(t.events, landed, "user_id").select("event_id", "event_type")


@query(
    "j8_global_cutoffs",
    """WITH c AS (SELECT quantile_cont(l_extendedprice, 0.33) AS a, quantile_cont(l_extendedprice, 0.66) AS b
       FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice - a, 4) AS over_p33,
       round(l_extendedprice - b, 4) AS over_p66 FROM lineitem, c""",
)
def _(t: Tables):
    cut = od.exact_quantiles(t.lineitem, "l_extendedprice", (0.33, 0.66)).select("quantiles").scalar()
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.col("l_extendedprice") - cut[0], 4).alias("over_p33"),
        F.round(F.col("l_extendedprice") - cut[1], 4).alias("over_p66"),
    )


@query("x4_shared_columns", "SELECT o_orderkey, o_totalprice FROM orders")
def _(t: Tables):
    return t.orders.select(*jn.shared_columns(t.orders, ["o_orderkey", "absent", "o_totalprice"]))


# --- sorted reports -------------------------------------------------------------------------


@query(
    "t1_top_groups",
    "SELECT source, count(*) AS count FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 20",
)
def _(t: Tables):
    return agg.top_groups(t.documents, "source", 20)


@query(
    "t2_top_rows",
    f"""SELECT substring(o_orderpriority, 1, 60) AS "Title", o_orderkey, {human_sql('o_totalprice')} AS "View Count",
        upper(o_orderstatus) AS "Sentiment" FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
)
def _(t: Tables):
    top = rk.top_rows(t.orders, "o_totalprice", 10, ["o_orderkey"])
    return top.select(
        tx.shorten(F.col("o_orderpriority"), 60).alias("Title"), "o_orderkey",
        num.human_number(F.col("o_totalprice")).alias("View Count"),
        tx.display_title(F.col("o_orderstatus")).alias("Sentiment"),
    )


@query("t3_sort_by_value", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def _(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query(
    "t4_sort_by_key",
    "SELECT user_id, count(*) AS count FROM events GROUP BY user_id ORDER BY user_id",
)
def _(t: Tables):
    return agg.counts_by_key(t.events, "user_id")
