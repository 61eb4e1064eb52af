"""Tag graph and incremental ingest on the sample tables."""

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import graph as gr
from ..session import scratch_path
from ..streaming import ingest
from .registry import Tables, query
from .scalars import r6
from .texts import vec_tokens_sql

_NODES_SQL = f"""WITH w AS (SELECT doc_id, unnest({vec_tokens_sql('text')}) AS token FROM documents),
  nodes AS (SELECT token, count(*) AS count FROM w GROUP BY token ORDER BY 2 DESC, 1 LIMIT 150),
  m AS (SELECT DISTINCT doc_id, token FROM w JOIN nodes USING (token)),
  edges AS (SELECT a.token AS source, b.token AS target, count(*) AS weight FROM m a JOIN m b
    ON a.doc_id = b.doc_id AND a.token < b.token GROUP BY ALL)"""


def _tags():
    return tx.vector_tokens(F.col("text"))


def _graph(t: Tables):
    nodes = gr.tag_nodes(t.documents, _tags())
    return nodes, gr.cooccurrence(t.documents, _tags(), nodes)


@query("q4_tag_nodes", f"{_NODES_SQL} SELECT token, count FROM nodes")
def _(t: Tables):
    return gr.tag_nodes(t.documents, _tags())


@query("q5_cooccurrence", f"{_NODES_SQL} SELECT source, target, weight FROM edges")
def _(t: Tables):
    return _graph(t)[1]


@query(
    "q6_degree_centrality",
    f"""{_NODES_SQL}, b AS (SELECT source AS token FROM edges UNION ALL SELECT target FROM edges),
        d AS (SELECT token, count(*) AS degree FROM b GROUP BY token)
        SELECT nodes.token, coalesce(degree, 0) AS degree, round(coalesce(degree, 0) / ((SELECT count(*) FROM nodes) - 1), 6) AS centrality
        FROM nodes LEFT JOIN d USING (token)""",
)
def _(t: Tables):
    nodes, edges = _graph(t)
    return gr.degree_centrality(edges, nodes).withColumn("centrality", r6(F.col("centrality")))


@query(
    "q7_modularity",
    f"""{_NODES_SQL}, l AS (SELECT source AS s, target AS t, weight FROM edges UNION ALL SELECT target, source, weight FROM edges),
        c AS (SELECT left(s, 1) AS community, sum(weight) AS strength, sum(CASE WHEN left(s, 1) = left(t, 1) THEN weight ELSE 0 END) AS inside
          FROM l GROUP BY 1), n AS (SELECT sum(strength) AS total FROM c)
        SELECT round(sum(inside / total - pow(strength / total, 2)), 6) AS modularity, count(*) AS communities FROM c, n""",
)
def _(t: Tables):
    nodes, edges = _graph(t)
    by_initial = nodes.select("token", F.substring("token", 1, 1).alias("community"))
    return gr.modularity(edges, by_initial).withColumn("modularity", r6(F.col("modularity")))


@query("q7_communities")
def _(t: Tables):
    _, edges = _graph(t)
    return gr.communities(edges)


# --- streaming ------------------------------------------------------------------------------


def _arrivals(t: Tables):
    """The events twice over as files in a folder of their own, as a collector re-delivers them."""
    folder = scratch_path(t.spark, "arrivals")
    t.events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(folder)
    t.events.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(folder)
    return ingest.file_stream(t.spark, folder, t.spark.read.parquet(folder).schema)


@query(
    "st1_incremental_ingest",
    """SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(hour(ts) AS INTEGER) AS upload_hour, CAST(isodow(ts) - 1 AS INTEGER) AS upload_day_of_week,
       CASE WHEN CAST(json_extract(props, '$.k') AS BIGINT) > 0 THEN value / CAST(json_extract(props, '$.k') AS BIGINT) ELSE 0 END
       AS value_ratio FROM events""",
)
def _(t: Tables):
    rows = ingest.derive_events(ingest.new_rows(_arrivals(t), "event_id", "ts", "40 days"))
    out, state = scratch_path(t.spark, "landed"), scratch_path(t.spark, "landed-state")
    ingest.append_available(rows, out, state)
    landed = t.spark.read.parquet(out)
    return landed.select(
        "event_id", "user_id", "event_type", "k", "upload_hour", "upload_day_of_week",
        "value_ratio",
    )


@query(
    "st1_land_new_rows",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type",
)
def _(t: Tables):
    out = scratch_path(t.spark, "landed")
    events = t.events.withColumn("ts", F.col("ts").cast("timestamp"))
    # three runs with checkpoints of their own: one half, the other half, and all of it again
    for part in ("event_id % 2 = 0", "event_id % 2 = 1", "true"):
        folder = scratch_path(t.spark, "arrivals")
        events.where(part).write.parquet(folder)
        stream = ingest.file_stream(t.spark, folder, events.schema)
        ingest.land_new_rows(stream, "event_id", out, scratch_path(t.spark, "landed-state"))
    landed = t.spark.read.parquet(out)
    return landed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "st2_static_attributes",
    """SELECT event_id, event_type, coalesce(c_mktsegment, '') AS segment FROM events LEFT JOIN customer ON user_id = c_custkey""",
)
def _(t: Tables):
    rows = ingest.new_rows(_arrivals(t), "event_id", "ts", "40 days")
    dim = t.customer.select("c_custkey", "c_mktsegment")
    joined = ingest.with_attributes(rows, dim, "user_id", "c_custkey").select(
        "event_id", "event_type", F.coalesce("c_mktsegment", F.lit("")).alias("segment")
    )
    out, state = scratch_path(t.spark, "landed"), scratch_path(t.spark, "landed-state")
    ingest.append_available(joined, out, state)
    return t.spark.read.parquet(out).select("event_id", "event_type", "segment")
