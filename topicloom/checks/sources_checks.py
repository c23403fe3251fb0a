"""Scans, sinks, contract checks and streaming on the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from topicloom.checks.tables import ORDER_POSTS, TEXT_POSTS, VECTORS, Tables, centroids_sql, check
from topicloom.contract import DataContract
from topicloom.functions.dates import coerce_dates, parse_date
from topicloom.functions.text import numeric_score
from topicloom.operators.centroids import nearest_topic, topic_centroids
from topicloom.operators.embed import embed_with_model, text_table
from topicloom.operators.growth import summary
from topicloom.operators.quality import align_columns, apply_mapping, canonical, stringify_extras, validation_metrics, violations
from topicloom.operators.ranking import largest_topics
from topicloom.plans.canonical import canonicalize, export_canonical
from topicloom.sources.readers import project_existing, read_labels, read_raw_folder, read_tabular
from topicloom.sources.sinks import append_new, load_centroids, save_centroids, write_csv, write_jsonl, write_stage
from topicloom.streaming.jobs import stream_canonical, stream_embeddings, stream_metrics

SEGMENTS = "SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS total, min(c_custkey) AS first_key FROM customer GROUP BY 1"


def _segments(df):
    return df.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total"), F.min("c_custkey").alias("first_key")
    )


@check("scan_csv", SEGMENTS)
def _(t: Tables):
    path = t.scratch("customer.csv")
    write_csv(t.read("customer"), path)
    return _segments(read_tabular(t.spark, path))


@check("scan_jsonl", SEGMENTS)
def _(t: Tables):
    path = t.scratch("customer.jsonl")
    write_jsonl(t.read("customer"), path)
    return _segments(read_tabular(t.spark, path))


@check("stage_roundtrip", SEGMENTS)
def _(t: Tables):
    path = t.scratch("customer.pq")
    write_stage(t.read("customer"), path)
    return _segments(read_tabular(t.spark, path))


@check(
    "scan_parquet_pruned",
    """SELECT l_returnflag, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem
       WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' GROUP BY 1""",
)
def _(t: Tables):
    rows = read_tabular(t.spark, f"{t.folder.rstrip('/')}/lineitem.parquet").where(F.col("l_shipdate") >= F.expr("timestamp_ntz'1997-01-01 00:00:00'"))
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@check("combine_raw_files", "SELECT source AS subreddit, count(*) AS n, count(*) AS with_file FROM documents GROUP BY 1")
def _(t: Tables):
    path = t.scratch("raw")
    t.several_files(t.read("documents").select("doc_id", "source", "text")).write.json(path)
    rows = read_raw_folder(t.spark, path)
    return rows.groupBy(F.col("source").alias("subreddit")).agg(F.count(F.lit(1)).alias("n"), F.count("source_file").alias("with_file"))


@check(
    "label_csv_scan",
    """SELECT doc_id AS topic, CAST(length(text) AS INTEGER) AS summary_chars, md5(text) AS summary_hash FROM documents""",
)
def _(t: Tables):
    path = t.scratch("labels.csv")
    write_csv(t.read("documents").select(F.col("doc_id").alias("topic"), F.col("text").alias("summary")), path)
    rows = read_labels(t.spark, path, "topic bigint, summary string")
    return rows.select("topic", F.char_length("summary").alias("summary_chars"), F.md5("summary").alias("summary_hash"))


@check(
    "append_with_resume",
    """SELECT backend, count(*) AS n, CAST(sum(topic) AS BIGINT) AS topics FROM (
         SELECT doc_id AS topic, 'stored' AS backend FROM labels
         UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) GROUP BY 1""",
)
def _(t: Tables):
    path = t.scratch("labels")
    keys = ["topic", "sample_size"]
    rows = lambda name, tag: t.read(name).select(F.col("doc_id").alias("topic"), F.lit(20).alias("sample_size"), F.lit(tag).alias("backend"))
    append_new(rows("labels", "stored"), path, keys)
    append_new(rows("documents", "new"), path, keys)
    return t.spark.read.parquet(path).groupBy("backend").agg(F.count(F.lit(1)).alias("n"), F.sum("topic").alias("topics"))


NEAREST = f"""WITH {VECTORS}, {centroids_sql('vectors')}, s AS (
  SELECT post_id, c.topic, list_cosine_similarity(v.embedding, c.centroid) AS sim FROM vectors v CROSS JOIN centroids c)
SELECT post_id, topic AS topic_near, round(sim, 4) + 0 AS score_near FROM (
  SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY sim DESC, topic) AS r FROM s) WHERE r = 1"""


@check("saved_model_assignment", NEAREST)
def _(t: Tables):
    path = t.scratch("model")
    save_centroids(topic_centroids(t.vectors()), path)
    near = nearest_topic(t.vectors(), load_centroids(t.spark, path))
    return near.withColumn("score_near", F.round("score_near", 4))


MAPPING = DataContract(required_columns=(), column_mapping={"c_custkey": "post_id", "c_name": "title", "absent": "nowhere"})


@check("column_mapping", "SELECT c_custkey AS post_id, c_name AS title, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _(t: Tables):
    return apply_mapping(t.read("customer"), MAPPING)


@check(
    "parse_epoch_dates",
    """SELECT CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, count(*) AS n FROM (
         SELECT CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS d FROM orders)
       WHERE d IS NOT NULL GROUP BY 1, 2 UNION ALL
       SELECT -1, -1, count(*) FROM orders WHERE o_orderkey % 10 = 0""",
)
def _(t: Tables):
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(o_orderdate as timestamp_ntz))")
    raw = t.read("orders").select(F.when(F.col("o_orderkey") % 10 == 0, F.lit("bad")).otherwise(seconds.cast("string")).alias("date"))
    rows = parse_date(raw, "date", date_unit="s")
    return rows.groupBy(
        F.coalesce(F.year("date"), F.lit(-1)).alias("y"), F.coalesce(F.month("date"), F.lit(-1)).alias("m")
    ).agg(F.count(F.lit(1)).alias("n"))


@check(
    "parse_formatted_dates",
    """SELECT strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d') AS day, count(*) AS n FROM orders
       WHERE o_orderkey % 10 <> 0 GROUP BY 1 UNION ALL SELECT 'none', count(*) FROM orders WHERE o_orderkey % 10 = 0""",
)
def _(t: Tables):
    text = F.date_format("o_orderdate", "dd/MM/yyyy")
    raw = t.read("orders").select(F.when(F.col("o_orderkey") % 10 == 0, F.lit("soon")).otherwise(text).alias("date"))
    rows = parse_date(raw, "date", date_format="%d/%m/%Y")
    return rows.groupBy(F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit("none")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@check(
    "coerce_dates",
    """SELECT unit, strftime(min(d), '%Y-%m-%d %H:%M:%S') AS first_date, strftime(max(d), '%Y-%m-%d %H:%M:%S') AS last_date, count(*) AS n
       FROM (SELECT unnest(['s', 'ms', 'text']) AS unit, date_trunc('second', CAST(ts AS TIMESTAMP)) AS d FROM events) GROUP BY 1""",
)
def _(t: Tables):
    base = t.read("events").select(F.date_trunc("second", F.col("ts").cast("timestamp_ntz")).cast("timestamp_ntz").alias("d"))
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', d)")
    shapes = {"s": seconds, "ms": seconds * 1000, "text": F.col("d").cast("string")}
    out = None
    for unit, shape in shapes.items():
        one = coerce_dates(base.select(shape.alias("date")), "date").select(F.lit(unit).alias("unit"), "date")
        out = one if out is None else out.unionByName(one)
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return out.groupBy("unit").agg(show(F.min("date")).alias("first_date"), show(F.max("date")).alias("last_date"), F.count("date").alias("n"))


QUALITY = DataContract(required_columns=("post_id", "date", "quality", "author"), max_null_count=10, max_invalid_date_count=5)
QUALITY_SQL = """base AS (
  SELECT d.doc_id AS post_id, l.quality, CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE d.doc_id END AS date
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
metrics AS (
  SELECT 'total_rows' AS metric, '' AS column_name, count(*) AS value FROM base
  UNION ALL SELECT 'null_count', 'post_id', count(*) FILTER (post_id IS NULL) FROM base
  UNION ALL SELECT 'null_count', 'date', count(*) FILTER (date IS NULL) FROM base
  UNION ALL SELECT 'null_count', 'quality', count(*) FILTER (quality IS NULL) FROM base
  UNION ALL SELECT 'missing_column', 'author', 1
  UNION ALL SELECT 'invalid_dates', 'date', count(*) FILTER (date IS NULL) FROM base)"""


def _quality_rows(t: Tables):
    labels = t.read("labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    rows = t.read("documents").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("post_id"),
        F.coalesce("quality", F.lit(float("nan"))).alias("quality"),
        F.when(F.col("doc_id") % 7 != 0, F.col("doc_id")).alias("date"),
    )
    return parse_date(rows, "date", date_unit="s")


@check("validation_metrics", f"WITH {QUALITY_SQL} SELECT * FROM metrics")
def _(t: Tables):
    return validation_metrics(_quality_rows(t), QUALITY)


@check(
    "validation_violations",
    f"""WITH {QUALITY_SQL} SELECT metric, column_name, value, CASE metric
         WHEN 'missing_column' THEN 'Missing required columns: ' || column_name
         WHEN 'null_count' THEN 'Null counts exceed limit (max 10): ' || column_name || '=' || value
         ELSE 'Invalid date count exceeds limit (max 5): ' || value END AS message
       FROM metrics WHERE metric = 'missing_column' OR (metric = 'null_count' AND value > 10)
         OR (metric = 'invalid_dates' AND value > 5)""",
)
def _(t: Tables):
    return violations(validation_metrics(_quality_rows(t), QUALITY), QUALITY)


EVENT_CONTRACT = DataContract(
    required_columns=("post_id", "date", "value"), column_mapping={"event_id": "post_id", "created": "date"}, date_unit="s",
    max_null_count=10**12, max_invalid_date_count=10**12,
)
EVENT_SCHEMA = "event_id bigint, created string, value double, user_id bigint, event_type string, props struct<k:bigint>, gap double"
EVENT_EXPORT_SQL = """SELECT post_id, CASE WHEN post_id % 50 = 0 THEN 'none' ELSE strftime(d, '%Y-%m-%d %H:%M:%S') END AS date, value,
    user_id, event_type, props, CAST(NULL AS VARCHAR) AS gap FROM (
  SELECT event_id AS post_id, date_trunc('second', CAST(ts AS TIMESTAMP)) AS d, value, CAST(user_id AS VARCHAR) AS user_id,
         event_type, replace(props, ' ', '') AS props FROM events)"""


def _raw_events(t: Tables):
    seconds = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    created = F.when(F.col("event_id") % 50 == 0, F.lit("unknown")).otherwise(seconds.cast("string"))
    props = F.from_json("props", "k bigint")
    return t.read("events").select(
        "event_id", created.alias("created"), "value", "user_id", "event_type", props.alias("props"), F.lit(float("nan")).alias("gap")
    )


def _shown_export(rows):
    return rows.withColumn("date", F.coalesce(F.date_format("date", "yyyy-MM-dd HH:mm:ss"), F.lit("none")))


@check("stringify_extras", EVENT_EXPORT_SQL)
def _(t: Tables):
    return _shown_export(stringify_extras(canonical(_raw_events(t), EVENT_CONTRACT), EVENT_CONTRACT))


@check("export_canonical", EVENT_EXPORT_SQL)
def _(t: Tables):
    raw, out = t.scratch("events.jsonl"), t.scratch("canonical")
    write_jsonl(_raw_events(t), raw)
    export_canonical(t.spark, raw, out, EVENT_CONTRACT, schema=EVENT_SCHEMA)
    return _shown_export(t.spark.read.parquet(out))


def _raw_event_files(t: Tables) -> str:
    raw = t.scratch("events")
    _raw_events(t).repartition(6).write.json(raw)
    return raw


@check("stream_canonical_export", EVENT_EXPORT_SQL)
def _(t: Tables):
    out = t.scratch("canonical")
    stream_canonical(t.spark, _raw_event_files(t), EVENT_SCHEMA, EVENT_CONTRACT, out, t.scratch("progress"), files_per_trigger=2)
    return _shown_export(t.spark.read.parquet(out))


@check(
    "stream_validation_metrics",
    """SELECT 'total_rows' AS metric, '' AS column_name, count(*) AS value FROM events
       UNION ALL SELECT 'null_count', 'post_id', 0 UNION ALL SELECT 'null_count', 'value', 0
       UNION ALL SELECT 'null_count', 'date', count(*) FROM events WHERE event_id % 50 = 0
       UNION ALL SELECT 'invalid_dates', 'date', count(*) FROM events WHERE event_id % 50 = 0""",
)
def _(t: Tables):
    return stream_metrics(
        t.spark, _raw_event_files(t), EVENT_SCHEMA, EVENT_CONTRACT, t.scratch("metrics"), t.scratch("progress"), files_per_trigger=2
    )


@check(
    "stream_missing_column",
    """SELECT 'total_rows' AS metric, '' AS column_name, count(*) AS value FROM events
       UNION ALL SELECT 'null_count', 'post_id', 0 UNION ALL SELECT 'null_count', 'author', count(*) FROM events
       UNION ALL SELECT 'missing_column', 'author', 1 UNION ALL SELECT 'invalid_dates', 'date', count(*) FROM events WHERE event_id % 50 = 0""",
)
def _(t: Tables):
    contract = replace(EVENT_CONTRACT, required_columns=("post_id", "author"))
    return stream_metrics(t.spark, _raw_event_files(t), EVENT_SCHEMA, contract, t.scratch("metrics"), t.scratch("progress"), files_per_trigger=2)


def length_model():
    """A stand-in for a user model: letter statistics of the whole text."""
    import numpy as np

    def embed(texts: list[str]) -> np.ndarray:
        return np.array([[len(x), x.count(" "), x.count("e"), x.count("\n")] for x in texts], dtype=np.float32).reshape(-1, 4)

    return embed


MODEL_SQL = f"""WITH {TEXT_POSTS}, x AS (SELECT post_id, coalesce(title, '') || chr(10) || chr(10) || coalesce(body, '') AS text FROM text_posts)
SELECT post_id, md5(text) AS text_hash, CAST(length(text) AS INTEGER) AS v0, CAST(length(text) - length(replace(text, ' ', '')) AS INTEGER) AS v1,
  CAST(length(text) - length(replace(text, 'e', '')) AS INTEGER) AS v2, CAST(length(text) - length(replace(text, chr(10), '')) AS INTEGER) AS v3 FROM x"""


def _shown_vectors(rows):
    parts = [F.col("embedding")[i].cast("int").alias(f"v{i}") for i in range(4)]
    return rows.select("post_id", F.md5("text").alias("text_hash"), *parts)


@check("embed_with_user_model", MODEL_SQL)
def _(t: Tables):
    return _shown_vectors(embed_with_model(text_table(t.text_posts()), length_model))


@check("stream_embeddings", MODEL_SQL)
def _(t: Tables):
    source, out = t.scratch("posts"), t.scratch("embeddings")
    posts = t.text_posts().select("post_id", "title", "body")
    t.several_files(posts).write.parquet(source)
    stream_embeddings(t.spark, source, posts.schema, length_model, out, t.scratch("progress"), files_per_trigger=1)
    return _shown_vectors(t.spark.read.parquet(out))


@check(
    "canonical_from_csv",
    """SELECT count(*) AS rows, strftime(CAST(min(o_orderdate) AS TIMESTAMP), '%Y-%m-%d') AS min_date,
         strftime(CAST(max(o_orderdate) AS TIMESTAMP), '%Y-%m-%d') AS max_date, round(sum(o_totalprice), 2) AS total_value FROM orders""",
)
def _(t: Tables):
    path = t.scratch("orders.csv")
    write_csv(t.read("orders").select(F.col("o_orderdate").cast("string").alias("Date"), F.col("o_totalprice").alias("Amount")), path)
    contract = DataContract(("date", "value"), {"Date": "date", "Amount": "value"})
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return summary(canonicalize(t.spark, path, contract)).select(
        "rows", day("min_date").alias("min_date"), day("max_date").alias("max_date"), F.round("total_value", 2).alias("total_value")
    )


@check(
    "aligned_columns",
    """SELECT doc_id, lang, CAST(-1 AS INTEGER) AS quality, CAST(NULL AS VARCHAR) AS nothing FROM documents
       UNION ALL SELECT doc_id, NULL, quality, NULL FROM labels""",
)
def _(t: Tables):
    left = t.read("documents").select("doc_id", "lang", F.lit(None).alias("nothing"))
    whole = align_columns([left, t.read("labels").select("doc_id", "quality")])
    return whole.withColumn("quality", F.coalesce("quality", F.lit(-1)))


@check(
    "cleaned_scores",
    f"""WITH {ORDER_POSTS} SELECT topic, count(*) AS n, round(sum(CASE WHEN post_id % 4 = 0 THEN 0 ELSE score END), 2) AS total
        FROM order_posts WHERE topic <> -1 AND date IS NOT NULL GROUP BY 1""",
)
def _(t: Tables):
    messy = F.when(F.col("post_id") % 4 == 0, F.lit("n/a")).otherwise(F.col("score").cast("string"))
    rows = t.order_posts().withColumn("score", numeric_score(messy)).where((F.col("topic") != -1) & F.col("date").isNotNull())
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("score"), 2).alias("total"))


@check(
    "topic_size_threshold",
    f"""WITH {ORDER_POSTS}, big AS (SELECT topic FROM order_posts WHERE topic <> -1 GROUP BY 1 HAVING count(*) >=
          (SELECT count(*) / 12.0 FROM order_posts))
        SELECT topic, count(*) AS n, min(post_id) AS first_post FROM order_posts WHERE topic IN (SELECT topic FROM big) GROUP BY 1""",
)
def _(t: Tables):
    posts = t.order_posts()
    floor = -(-posts.count() // 12)
    big = largest_topics(posts, min_size=floor).select("topic")
    rows = posts.join(big, "topic", "left_semi")
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"), F.min("post_id").alias("first_post"))


@check("existing_columns", "SELECT doc_id, lang FROM documents")
def _(t: Tables):
    return project_existing(t.read("documents"), ["doc_id", "lang", "created", "votes"])
