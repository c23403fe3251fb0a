"""Joins, counts, growth, ranking and text expressions on the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from topicloom.checks.tables import EVENT_POSTS, ORDER_POSTS, TEXT_POSTS, VECTOR_POSTS, Tables, check
from topicloom.functions import text as X
from topicloom.functions.vectors import cosine
from topicloom.operators.embed import embedding_costs, estimate_tokens, text_table
from topicloom.operators.examples import scored_examples, top_scored_posts
from topicloom.operators.growth import (
    dated_topics,
    growth_by_outer_join,
    growth_counts,
    monthly_series,
    ranked_growth,
    summary,
    topic_growth,
    value_series,
)
from topicloom.operators.labels import default_label, first_of, last_labels, review_labels, widest_labels
from topicloom.operators.ranking import dense_ids, largest_topics, next_topic_id, sample_exact, topic_sizes
from topicloom.plans.labelling import anchor_posts, anchor_prompts, keyword_prompts, parent_mode
from topicloom.plans.review import growing_posts, growth_review, keyword_growth, label_review, ordered_hierarchy, prepare_posts

def rows_n():
    """Row count as ``n``."""
    return F.count(F.lit(1)).alias("n")


def growth_sql(source: str, windows: str, select: str) -> str:
    return f"""last AS (SELECT max(date) AS m FROM {source}),
w AS (SELECT unnest([{windows}]) AS window_days),
counted AS (
  SELECT window_days, topic, count(*) FILTER (date >= m - to_days(window_days)) AS recent_count,
         count(*) FILTER (date < m - to_days(window_days)) AS prior_count
  FROM {source}, last, w WHERE topic IS NOT NULL AND date IS NOT NULL AND date >= m - to_days(2 * window_days) GROUP BY 1, 2),
growth AS (
  SELECT *, recent_count - prior_count AS growth_abs,
         CASE WHEN prior_count > 0 THEN round((recent_count - prior_count) / prior_count, 6) END AS growth_pct FROM counted)
{select}"""


def _rounded(df):
    return df.withColumn("growth_pct", F.round("growth_pct", 6))


@check(
    "growth_ranking",
    f"WITH {EVENT_POSTS}, clean AS (SELECT * FROM event_posts WHERE topic <> -1 AND date IS NOT NULL), "
    + growth_sql("clean", "3, 7, 14", """SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY window_days ORDER BY growth_abs DESC, topic) AS INTEGER)
       AS rank FROM growth) WHERE rank <= 200"""),
)
def _(t: Tables):
    posts = t.event_posts().where((F.col("topic") != -1) & F.col("date").isNotNull())
    return _rounded(ranked_growth(growth_counts(posts, [3, 7, 14])))


@check("topic_growth", f"WITH {ORDER_POSTS}, " + growth_sql("order_posts", "90", "SELECT * EXCLUDE (window_days) FROM growth"))
def _(t: Tables):
    return _rounded(topic_growth(t.order_posts(), 90))


@check(
    "growth_outer_join",
    f"WITH {ORDER_POSTS}, " + growth_sql("order_posts", "180", "SELECT topic, recent_count, prior_count FROM growth"),
)
def _(t: Tables):
    return growth_by_outer_join(t.order_posts(), 180)


@check(
    "monthly_series",
    f"""WITH {ORDER_POSTS} SELECT topic, parent_topic, strftime(date_trunc('month', date), '%Y-%m-%d') AS month, count(*) AS post_count
        FROM order_posts WHERE topic <> -1 GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    series = monthly_series(t.order_posts().where(F.col("topic") != -1))
    return series.withColumn("month", F.date_format("month", "yyyy-MM-dd"))


@check(
    "basic_summary",
    """SELECT count(*) AS rows, strftime(CAST(min(ts) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS min_date,
         strftime(CAST(max(ts) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS max_date, round(sum(value), 2) AS total_value FROM events""",
)
def _(t: Tables):
    one = summary(t.event_posts().withColumnRenamed("score", "value"))
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return one.select("rows", show("min_date"), show("max_date"), F.round("total_value", 2).alias("total_value"))


@check("value_series", "SELECT strftime(CAST(ts AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS date, value FROM events WHERE value IS NOT NULL AND ts IS NOT NULL")
def _(t: Tables):
    rows = value_series(t.event_posts().withColumnRenamed("score", "value"))
    return rows.select(F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("date"), "value")


SIZES = "sizes AS (SELECT topic, count(*) AS size FROM order_posts WHERE topic <> -1 GROUP BY 1)"


@check("topic_sizes", f"WITH {ORDER_POSTS}, {SIZES} SELECT * FROM sizes")
def _(t: Tables):
    return topic_sizes(t.order_posts())


@check("largest_topics", f"WITH {ORDER_POSTS}, {SIZES} SELECT * FROM sizes ORDER BY size DESC, topic LIMIT 5")
def _(t: Tables):
    return largest_topics(t.order_posts(), 5)


@check("next_topic_id", f"WITH {ORDER_POSTS} SELECT CAST(max(topic) + 1 AS INTEGER) AS next_id FROM order_posts WHERE topic <> -1")
def _(t: Tables):
    return next_topic_id(t.order_posts())


@check(
    "dense_topic_ids",
    """SELECT o_orderpriority, min(o_orderkey) AS first_post, CAST(row_number() OVER (ORDER BY min(o_orderkey)) - 1 AS INTEGER) AS new_id
       FROM orders GROUP BY 1""",
)
def _(t: Tables):
    keys = t.read("orders").groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("first_post"))
    return dense_ids(keys, ["first_post"])


@check(
    "parent_mode",
    """WITH c AS (SELECT CAST(o_custkey % 12 AS INTEGER) AS topic, CAST(o_orderkey % 3 AS INTEGER) AS parent_topic, count(*) AS n FROM orders GROUP BY 1, 2)
       SELECT topic, parent_topic FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY n DESC, parent_topic) AS r FROM c) WHERE r = 1""",
)
def _(t: Tables):
    rows = t.read("orders").select((F.col("o_custkey") % 12).cast("int").alias("topic"), (F.col("o_orderkey") % 3).cast("int").alias("parent_topic"))
    return parent_mode(rows)


@check(
    "clusters_with_vectors",
    f"WITH {VECTOR_POSTS} SELECT topic, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM vector_posts GROUP BY 1",
)
def _(t: Tables):
    return t.vector_posts().groupBy("topic").agg(rows_n(), F.sum(F.char_length("text")).alias("chars"))


@check(
    "left_join_canonical",
    """SELECT CAST(coalesce(l.quality, -1) AS INTEGER) AS quality, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
)
def _(t: Tables):
    joined = t.read("documents").join(t.read("labels"), "doc_id", "left")
    return joined.groupBy(F.coalesce("quality", F.lit(-1)).alias("quality")).agg(rows_n())


@check(
    "dated_topics",
    f"""WITH {ORDER_POSTS}, c AS (SELECT vec_id AS post_id, CASE WHEN label = 9 THEN -1 ELSE label END AS topic FROM embeddings)
        SELECT c.topic, count(*) AS n, strftime(min(date), '%Y-%m-%d') AS first_day FROM c JOIN order_posts o ON c.post_id = o.post_id
        WHERE c.topic <> -1 GROUP BY 1""",
)
def _(t: Tables):
    rows = dated_topics(t.vectors().select("post_id", "topic"), t.order_posts().select("post_id", "date"))
    return rows.groupBy("topic").agg(rows_n(), F.date_format(F.min("date"), "yyyy-MM-dd").alias("first_day"))


@check(
    "member_topics",
    f"""WITH {ORDER_POSTS} SELECT topic, count(*) AS n FROM order_posts WHERE topic IN
        (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA') GROUP BY 1""",
)
def _(t: Tables):
    chosen = t.read("nation").join(t.read("region"), F.col("n_regionkey") == F.col("r_regionkey")).where(F.col("r_name") == "ASIA")
    return t.order_posts().join(chosen.select(F.col("n_nationkey").alias("topic")), "topic", "left_semi").groupBy("topic").agg(rows_n())


@check(
    "dictionary_lookup",
    """SELECT r_name AS l1_label, n_name AS label, count(*) AS n, round(sum(c_acctbal), 2) AS total
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""",
)
def _(t: Tables):
    nation = t.read("nation").withColumnRenamed("n_nationkey", "c_nationkey")
    region = t.read("region").withColumnRenamed("r_regionkey", "n_regionkey")
    rows = t.read("customer").join(nation, "c_nationkey", "left").join(region, "n_regionkey", "left")
    return rows.groupBy(F.col("r_name").alias("l1_label"), F.col("n_name").alias("label")).agg(rows_n(), F.round(F.sum("c_acctbal"), 2).alias("total"))


@check(
    "group_rollup",
    """SELECT coalesce(r_name, 'all') AS l1, coalesce(n_name, 'all') AS l2, count(*) AS size
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""",
)
def _(t: Tables):
    rows = t.read("customer").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    counted = rows.rollup("r_name", "n_name").agg(F.count(F.lit(1)).alias("size"))
    return counted.select(F.coalesce("r_name", F.lit("all")).alias("l1"), F.coalesce("n_name", F.lit("all")).alias("l2"), "size")


KEYWORDS_SQL = """keywords AS (SELECT n_nationkey AS l3_topic, n_name AS keywords FROM nation WHERE n_nationkey % 2 = 0)"""


@check(
    "keyword_growth",
    f"WITH {ORDER_POSTS}, clean AS (SELECT * FROM order_posts WHERE topic <> -1), {KEYWORDS_SQL}, "
    + growth_sql(
        "clean",
        "90",
        """SELECT g.topic AS l3_topic, recent_count, prior_count, growth_abs, growth_pct, keywords
           FROM growth g LEFT JOIN keywords k ON g.topic = k.l3_topic""",
    ),
)
def _(t: Tables):
    keywords = t.read("nation").where(F.col("n_nationkey") % 2 == 0).select(F.col("n_nationkey").alias("l3_topic"), F.col("n_name").alias("keywords"))
    posts = t.order_posts()
    return _rounded(keyword_growth(posts.select("post_id", "date"), posts.select("post_id", "topic", "parent_topic"), keywords)[1])


@check(
    "keyword_timeseries",
    f"""WITH {ORDER_POSTS} SELECT topic, parent_topic, strftime(date_trunc('month', date), '%Y-%m') AS month, count(*) AS post_count
        FROM order_posts WHERE topic <> -1 GROUP BY 1, 2, 3""",
)
def _(t: Tables):
    posts = t.order_posts()
    keywords = t.read("nation").select(F.col("n_nationkey").alias("l3_topic"), F.col("n_name").alias("keywords"))
    series = keyword_growth(posts.select("post_id", "date"), posts.select("post_id", "topic", "parent_topic"), keywords)[0]
    return series.withColumn("month", F.date_format("month", "yyyy-MM"))


@check(
    "estimated_tokens",
    f"""WITH {TEXT_POSTS} SELECT count(*) AS rows, round(sum(length(coalesce(title, '') || chr(10) || chr(10) || coalesce(body, ''))) / 4.0, 2) AS tokens FROM text_posts""",
)
def _(t: Tables):
    return estimate_tokens(text_table(t.text_posts())).withColumn("tokens", F.round("tokens", 2))


@check(
    "embedding_costs",
    f"""WITH {TEXT_POSTS}, x AS (SELECT count(*) AS n, sum(length(title || chr(10) || chr(10) || body)) / 4.0 AS tokens FROM text_posts)
        SELECT 'local' AS option, 'sentence-transformers/all-MiniLM-L6-v2' AS model, n AS rows_total, n AS sample_rows,
          CAST(round(tokens) AS BIGINT) AS est_total_tokens, round(n / 145.0 / 3600, 2) AS est_time_hours, CAST(0 AS DOUBLE) AS est_cost_usd,
          'estimated from sample run' AS notes FROM x
        UNION ALL SELECT 'openai', 'text-embedding-3-small', n, n, CAST(round(tokens) AS BIGINT), round(tokens / 4000 / 3600, 2),
          round(tokens / 1000000 * 0.02, 2), 'assumes 4000 tokens/sec and $0.02/1M tokens' FROM x""",
)
def _(t: Tables):
    return embedding_costs(text_table(t.text_posts()), sample_rows=1_000_000_000, local_rows_per_second=145.0)


@check(
    "embedding_costs_sampled",
    """SELECT o AS option, count(*) AS rows_total, CAST(400 AS BIGINT) AS sample_rows, true AS near_enough, true AS scaled
       FROM documents, (SELECT unnest(['local', 'openai']) AS o) GROUP BY o""",
)
def _(t: Tables):
    # A real sample: its tokens scaled up come near those of all texts, and cost and time follow from the estimate.
    texts = text_table(t.text_posts())
    costs = embedding_costs(texts, sample_rows=400, local_rows_per_second=145.0)
    whole = estimate_tokens(texts).select(F.col("tokens").alias("true_tokens"))
    near = F.abs(F.col("est_total_tokens") - F.col("true_tokens")) < 0.25 * F.col("true_tokens")
    cost = F.when(F.col("option") == "local", F.lit(0.0)).otherwise(F.round(F.col("est_total_tokens") / 1e6 * 0.02, 2))
    return costs.join(F.broadcast(whole)).select("option", "rows_total", "sample_rows", near.alias("near_enough"), (F.abs(F.col("est_cost_usd") - cost) < 0.011).alias("scaled"))


@check("sampled_posts", "SELECT count(*) AS n, count(*) AS known FROM (SELECT doc_id FROM documents LIMIT 100)")
def _(t: Tables):
    sample = sample_exact(t.text_posts().select("post_id"), 100, 7)
    known = sample.join(t.read("documents").select(F.col("doc_id").alias("post_id")), "post_id", "left_semi")
    return sample.agg(rows_n()).join(F.broadcast(known.agg(F.count(F.lit(1)).alias("known"))))


@check(
    "top_posts_by_score",
    f"""WITH {EVENT_POSTS}, r AS (SELECT topic, post_id, score, CAST(row_number() OVER (PARTITION BY topic ORDER BY score DESC, post_id) AS INTEGER) AS rank FROM event_posts)
        SELECT * FROM r WHERE rank <= 20""",
)
def _(t: Tables):
    return top_scored_posts(t.event_posts().select("topic", "post_id", "score"), 20)


# The white space of the trimming functions, as an SQL pattern.
SP = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def trimmed(expression: str) -> str:
    """SQL that trims white space at both ends."""
    return f"regexp_replace({expression}, '^{SP}+|{SP}+$', '', 'g')"


TB_SQL = f"""tb AS (SELECT *, concat_ws(' - ', nullif({trimmed('title')}, ''), nullif({trimmed('body')}, '')) AS t FROM text_posts)"""
EXAMPLES_SQL = f"""{TEXT_POSTS}, {TB_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, post_id) AS r FROM tb WHERE topic <> -1),
examples AS (SELECT topic, string_agg(nullif(left(t, 400), ''), chr(10) || '---' || chr(10) ORDER BY r) AS ex FROM ranked WHERE r <= 30 GROUP BY 1)"""


@check("scored_examples", f"WITH {EXAMPLES_SQL} SELECT topic, md5(ex) AS hash, CAST(length(ex) AS INTEGER) AS chars FROM examples")
def _(t: Tables):
    rows = scored_examples(t.text_posts().where(F.col("topic") != -1), 30, 400)
    joined = X.join_examples(F.col("examples"))
    return rows.select("topic", F.md5(joined).alias("hash"), F.char_length(joined).alias("chars"))


@check(
    "keyword_prompts",
    f"""WITH {EXAMPLES_SQL}, s AS (SELECT topic, count(*) AS n FROM text_posts WHERE topic <> -1 GROUP BY 1)
        SELECT CAST((topic + 1) % 3 AS INTEGER) AS l2_topic, topic AS l3_topic, CAST(30 AS INTEGER) AS sample_size, n AS post_count,
          'You are creating Google search keyword ideas from Reddit posts.' || chr(10) || 'L2 theme: L2 ' || ((topic + 1) % 3) || chr(10)
          || 'L3 theme: L3 ' || topic || chr(10) || 'Return JSON with key: keywords (list of 8-12 phrases).' || chr(10) || 'Examples:' || chr(10)
          || ex || chr(10) AS prompt FROM examples JOIN s USING (topic) WHERE n >= 20""",
)
def _(t: Tables):
    return keyword_prompts(t.text_posts(), min_size=20).drop("l2_label", "l3_label")


@check(
    "anchor_prompts",
    f"""WITH {EXAMPLES_SQL}, s AS (SELECT topic, count(*) AS n FROM text_posts WHERE topic <> -1 GROUP BY 1)
        SELECT topic AS l2_topic, CAST(row_number() OVER (ORDER BY n DESC, topic) AS INTEGER) AS l2_rank, 'L2 ' || topic AS l2_label, n AS post_count,
          'You are defining subtopics for a large Reddit topic cluster.' || chr(10) || 'Parent L2 label: L2 ' || topic || chr(10)
          || 'Create 8 or fewer L3 anchors that capture distinct intents.' || chr(10)
          || 'Return JSON with key: anchors (list of objects with keys label, keywords).' || chr(10)
          || 'Each keywords value should be a list of 3-6 search phrases.' || chr(10) || 'Examples:' || chr(10) || ex || chr(10) AS prompt
        FROM examples JOIN s USING (topic) WHERE n >= 20""",
)
def _(t: Tables):
    return anchor_prompts(t.text_posts(), min_size=20)


@check(
    "anchor_posts",
    f"""WITH {TEXT_POSTS}, v AS (SELECT vec_id AS post_id, CASE WHEN label = 9 THEN -1 ELSE label END AS topic FROM embeddings)
        SELECT v.topic, count(*) AS n, round(sum(coalesce(CAST(p.score AS DOUBLE), 0)), 2) AS total, count(p.title) AS titled
        FROM v LEFT JOIN (SELECT * FROM text_posts WHERE post_id % 5 <> 0) p USING (post_id) GROUP BY 1""",
)
def _(t: Tables):
    some = t.text_posts().where(F.col("post_id") % 5 != 0)
    rows = anchor_posts(t.vectors(), t.vectors(), some)
    return rows.groupBy("topic").agg(rows_n(), F.round(F.sum("score"), 2).alias("total"), F.count("title").alias("titled"))


@check(
    "build_text",
    f"WITH {TEXT_POSTS} SELECT post_id, md5(coalesce(title, '') || chr(10) || chr(10) || coalesce(CASE WHEN post_id % 3 = 0 THEN NULL ELSE body END, '')) AS hash FROM text_posts",
)
def _(t: Tables):
    body = F.when(F.col("post_id") % 3 != 0, F.col("body"))
    return t.text_posts().select("post_id", F.md5(X.build_text(F.col("title"), body)).alias("hash"))


EXCERPT_SQL = f"CASE WHEN length(t) <= 280 THEN t ELSE regexp_replace(left(t, 280), '{SP}+$', '') || '...' END"


@check("excerpts", f"WITH {TEXT_POSTS}, {TB_SQL} SELECT post_id, {EXCERPT_SQL} AS excerpt FROM tb")
def _(t: Tables):
    return t.text_posts().select("post_id", X.make_excerpt(F.col("title"), F.col("body")).alias("excerpt"))


@check(
    "permalinks",
    """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '' WHEN page_id % 2 = 0 THEN url
         ELSE 'https://www.reddit.com' || regexp_replace(url, '^https?://[^/]*', '') END AS link FROM pages""",
)
def _(t: Tables):
    path = F.regexp_replace("url", "^https?://[^/]*", "")
    link = F.when(F.col("page_id") % 5 == 0, F.lit(None)).when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(path)
    return t.read("pages").select("page_id", X.build_permalink(link.cast("string")).alias("link"))


# Replies in the shapes models give, around whole texts: fenced JSON, JSON behind quotes, broken JSON, plain text, with
# blanks and line ends around them. ``j`` is the text as it stands between the quotes of a JSON string.
REPLY_SQL = r"""texts AS (SELECT doc_id, text AS w,
  replace(replace(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), chr(13), '\r'), chr(9), '\t') AS j FROM documents),
replies AS (SELECT doc_id, w, j, CASE CAST(doc_id % 6 AS INTEGER)
  WHEN 0 THEN '```json' || chr(10) || '{"label": "' || j || '", "summary": null}' || chr(10) || '```' || chr(10)
  WHEN 1 THEN repeat(chr(39), 3) || 'json {"label": "' || j || '"}' || chr(10)
  WHEN 2 THEN '{"label": "' || j || '", broken}'
  WHEN 3 THEN '  JSON  "' || w || '"'
  WHEN 4 THEN chr(10) || '{"title": 3}' || chr(10) ELSE w END AS reply FROM texts)"""


def _json_text(text):
    """The text as it stands between the quotes of a JSON string."""
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def _replies(t: Tables):
    w, j, kind = F.col("text"), _json_text(F.col("text")), F.col("doc_id") % 6
    reply = (
        F.when(kind == 0, F.concat(F.lit('```json\n{"label": "'), j, F.lit('", "summary": null}\n```\n')))
        .when(kind == 1, F.concat(F.lit("'''json {\"label\": \""), j, F.lit('"}\n')))
        .when(kind == 2, F.concat(F.lit('{"label": "'), j, F.lit('", broken}')))
        .when(kind == 3, F.concat(F.lit('  JSON  "'), w, F.lit('"')))
        .when(kind == 4, F.lit('\n{"title": 3}\n'))
        .otherwise(w)
    )
    return t.read("documents").select("doc_id", reply.alias("reply"))


W_SQL = trimmed("w")


def bare_sql(expression: str) -> str:
    """SQL that trims quotes and blanks at both ends."""
    return f"""regexp_replace({expression}, '^["'' ]+|["'' ]+$', '', 'g')"""


@check(
    "reply_values",
    f"""WITH {REPLY_SQL} SELECT doc_id, CASE CAST(doc_id % 6 AS INTEGER) WHEN 0 THEN {W_SQL} WHEN 1 THEN {W_SQL} WHEN 2 THEN reply
          WHEN 3 THEN regexp_replace(w, '^{SP}+', '') || '"' WHEN 4 THEN '' ELSE {W_SQL} END AS label FROM replies""",
)
def _(t: Tables):
    return _replies(t).select("doc_id", X.reply_value(F.col("reply"), "label").alias("label"))


@check(
    "clean_labels",
    f"""WITH {REPLY_SQL} SELECT doc_id, CASE CAST(doc_id % 6 AS INTEGER)
          WHEN 0 THEN '{{"label": "' || j || '", "summary": null}}'
          WHEN 1 THEN 'json {{"label": "' || j || '"}}'
          WHEN 2 THEN reply WHEN 3 THEN {bare_sql("w")} WHEN 4 THEN '{{"title": 3}}'
          ELSE {bare_sql(W_SQL)} END AS label FROM replies""",
)
def _(t: Tables):
    return _replies(t).select("doc_id", X.clean_label(F.col("reply")).alias("label"))


@check(
    "reply_fallbacks",
    f"""WITH {REPLY_SQL} SELECT doc_id, CASE WHEN doc_id % 6 = 4 THEN '' ELSE left({trimmed('reply')}, 120) END AS label,
          CASE WHEN doc_id % 6 = 4 THEN '' ELSE {trimmed('reply')} END AS summary FROM replies""",
)
def _(t: Tables):
    return _replies(t).select("doc_id", X.reply_label(F.col("reply")).alias("label"), X.reply_summary(F.col("reply")).alias("summary"))


@check(
    "json_blocks",
    rf"""WITH {REPLY_SQL} SELECT doc_id, CASE WHEN regexp_matches(reply, '\{{.*\}}', 's') THEN regexp_extract(reply, '\{{.*\}}', 0, 's')
          WHEN doc_id % 6 = 3 THEN '"' || w || '"' ELSE {W_SQL} END AS block FROM replies""",
)
def _(t: Tables):
    return _replies(t).select("doc_id", X.json_block(F.col("reply")).alias("block"))


# Whole texts as comma-separated keywords, and as the first keyword of fenced, plain and broken JSON.
@check(
    "parsed_keywords",
    f"""WITH {REPLY_SQL}, listed AS (SELECT doc_id, CASE CAST(doc_id % 4 AS INTEGER)
          WHEN 0 THEN list_filter(list_transform(string_split({W_SQL}, ','), lambda x: {trimmed('x')}), lambda x: x <> '')[1:12]
          WHEN 3 THEN [] ELSE list_filter([{W_SQL}, 'two'], lambda x: x <> '') END AS k FROM replies)
        SELECT doc_id, CAST(len(k) AS INTEGER) AS n, array_to_string(k, '; ') AS keywords FROM listed""",
)
def _(t: Tables):
    j, kind = _json_text(F.col("text")), F.col("doc_id") % 4
    listed = F.concat(F.lit('{"keywords": ["'), j, F.lit('", "", "two "]}'))
    reply = (
        F.when(kind == 0, F.col("text"))
        .when(kind == 1, F.concat(F.lit("```json\n"), listed, F.lit("\n```\n")))
        .when(kind == 2, F.concat(F.lit(" "), listed, F.lit("\n")))
        .otherwise(F.concat(F.lit('{"keywords": ["'), j, F.lit('", broken')))
    )
    parsed = X.parse_keywords(reply)
    return t.read("documents").select("doc_id", F.size(parsed).alias("n"), X.keyword_list(parsed).alias("keywords"))


def _anchor_reply():
    return F.concat(
        F.lit('```json\n{"anchors": [{"label": "'), F.col("source"), F.lit('", "keywords": ["one '), F.col("lang"),
        F.lit('", "two"]}, {"label": "all '), F.col("lang"), F.lit('"}]}\n```'),
    )


@check(
    "parsed_anchors",
    """SELECT doc_id, CAST(0 AS INTEGER) AS anchor_no, source AS label, source || '. Keywords: one ' || lang || ', two' AS text FROM documents
       UNION ALL SELECT doc_id, 1, 'all ' || lang, 'all ' || lang || '. Keywords: ' FROM documents""",
)
def _(t: Tables):
    reply = _anchor_reply()
    raw = F.when(F.col("doc_id") % 2 == 0, reply).otherwise(F.to_json(F.struct(reply.alias("raw"))))
    rows = t.read("documents").select("doc_id", F.posexplode(X.parse_anchors(raw)).alias("anchor_no", "a"))
    words = F.coalesce(F.col("a.keywords"), F.array().cast("array<string>"))
    return rows.select("doc_id", "anchor_no", F.col("a.label").alias("label"), X.anchor_text(F.col("a.label"), words).alias("text"))


@check(
    "decision_parsing",
    """SELECT doc_id, lower(coalesce(CASE WHEN doc_id % 3 = 0 THEN 'SPLIT' WHEN doc_id % 3 = 1 THEN 'Keep' END, 'keep')) AS action,
         doc_id % 4 = 0 AS merge FROM documents""",
)
def _(t: Tables):
    action = F.when(F.col("doc_id") % 3 == 0, "SPLIT").when(F.col("doc_id") % 3 == 1, "Keep")
    merge = F.when(F.col("doc_id") % 4 == 0, " True ").when(F.col("doc_id") % 4 == 1, "false").when(F.col("doc_id") % 4 == 2, "yes")
    return t.read("documents").select("doc_id", X.split_decision(action).alias("action"), X.merge_decision(merge).alias("merge"))


@check(
    "cosine_pairs",
    """SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4) AS sim
       FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
)
def _(t: Tables):
    a = t.read("embeddings").select("vec_id", "embedding")
    b = t.read("embeddings").select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return a.join(b, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("next")), 4).alias("sim"))


# Label rows as a job would append them, several per topic.
LABEL_SQL = """label_rows AS (SELECT CAST(doc_id % 40 AS INTEGER) AS topic, doc_id AS label_no,
  CASE WHEN doc_id % 3 = 0 THEN 'local' ELSE 'openai' END AS backend, CAST(10 * (doc_id % 2 + 1) AS INTEGER) AS sample_size,
  CASE WHEN doc_id % 5 = 0 THEN NULL ELSE '{"label": "' || source || ' ' || doc_id || '"}' END AS label, lang AS summary FROM documents)"""


def _label_rows(t: Tables):
    d = F.col("doc_id")
    return t.read("documents").select(
        (d % 40).cast("int").alias("topic"),
        d.alias("label_no"),
        F.when(d % 3 == 0, "local").otherwise("openai").alias("backend"),
        (10 * (d % 2 + 1)).cast("int").alias("sample_size"),
        F.when(d % 5 != 0, F.concat(F.lit('{"label": "'), "source", F.lit(" "), d, F.lit('"}'))).alias("label"),
        F.col("lang").alias("summary"),
    )


VALUE_SQL = "coalesce(json_extract_string(label, '$.label'), '') AS label"


@check(
    "review_labels",
    f"""WITH {LABEL_SQL} SELECT topic, {VALUE_SQL}, summary FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY label_no DESC) AS r
        FROM label_rows WHERE backend = 'openai' AND sample_size = 20) WHERE r = 1""",
)
def _(t: Tables):
    return review_labels(_label_rows(t))


@check(
    "widest_labels",
    f"""WITH {LABEL_SQL} SELECT topic, {VALUE_SQL}, summary FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY sample_size DESC, label_no) AS r
        FROM label_rows WHERE backend = 'openai') WHERE r = 1""",
)
def _(t: Tables):
    return widest_labels(_label_rows(t))


@check(
    "last_labels",
    f"""WITH {LABEL_SQL} SELECT topic, label FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY label_no DESC) AS r
        FROM label_rows WHERE label IS NOT NULL) WHERE r = 1""",
)
def _(t: Tables):
    return last_labels(_label_rows(t), "label_no")


@check(
    "label_precedence",
    f"""WITH {LABEL_SQL}, own AS (SELECT topic, max(label) AS own FROM label_rows WHERE backend = 'local' AND topic % 4 = 0 GROUP BY 1),
        tree AS (SELECT topic, CASE WHEN topic % 3 = 0 THEN '' ELSE min(summary) END AS known FROM label_rows GROUP BY 1)
        SELECT topic, coalesce(nullif(own, ''), nullif(known, ''), 'Topic ' || topic) AS label FROM tree LEFT JOIN own USING (topic)""",
)
def _(t: Tables):
    rows = _label_rows(t)
    own = rows.where((F.col("backend") == "local") & (F.col("topic") % 4 == 0)).groupBy("topic").agg(F.max("label").alias("own"))
    tree = rows.groupBy("topic").agg(F.min("summary").alias("known"))
    tree = tree.withColumn("known", F.when(F.col("topic") % 3 == 0, "").otherwise(F.col("known")))
    joined = tree.join(own, "topic", "left")
    return joined.select("topic", first_of(F.col("own"), F.col("known"), default_label("Topic", F.col("topic"))).alias("label"))


# A hierarchy over the topics of the text posts: three groups, one topic left unmapped.
TREE_SQL = """sizes AS (SELECT topic, count(*) AS size FROM text_posts WHERE topic <> -1 GROUP BY 1),
tree AS (
  SELECT 'L1' AS level, CAST(topic % 3 AS INTEGER) AS l1_id, CAST(NULL AS INTEGER) AS l2_topic, CAST(sum(size) AS BIGINT) AS size,
         CASE WHEN topic % 3 = 0 THEN '' ELSE 'Group ' || topic % 3 END AS label, '' AS summary FROM sizes GROUP BY topic % 3
  UNION ALL SELECT 'L2', CAST(topic % 3 AS INTEGER), topic, size, CASE WHEN topic % 2 = 0 THEN '' ELSE 'Theme ' || topic END, '' FROM sizes WHERE topic <> 5),
l1 AS (SELECT l1_id, CAST(row_number() OVER (ORDER BY size DESC, l1_id) AS INTEGER) AS l1_rank, size, coalesce(nullif(label, ''), 'L1 ' || l1_id) AS label
       FROM tree WHERE level = 'L1'),
l2 AS (SELECT t.l1_id, l1_rank, l2_topic, t.size, CAST(row_number() OVER (PARTITION BY t.l1_id ORDER BY t.size DESC, l2_topic) AS INTEGER) AS l2_rank,
       coalesce(nullif(t.label, ''), 'Topic ' || l2_topic) AS label FROM tree t JOIN l1 USING (l1_id) WHERE level = 'L2')"""


def _tree(t: Tables):
    sizes = topic_sizes(t.text_posts())
    g = (F.col("topic") % 3).cast("int")
    l1 = sizes.groupBy(g.alias("l1_id")).agg(F.sum("size").alias("size")).select(
        F.lit("L1").alias("level"), "l1_id", F.lit(None).cast("int").alias("l2_topic"), "size",
        F.when(F.col("l1_id") == 0, "").otherwise(F.concat(F.lit("Group "), F.col("l1_id"))).alias("label"), F.lit("").alias("summary"),
    )
    l2 = sizes.where(F.col("topic") != 5).select(
        F.lit("L2").alias("level"), g.alias("l1_id"), F.col("topic").alias("l2_topic"), "size",
        F.when(F.col("topic") % 2 == 0, "").otherwise(F.concat(F.lit('```json {"label": "Theme '), F.col("topic"), F.lit('"} ```'))).alias("label"),
        F.lit(None).cast("string").alias("summary"),
    )
    return l1.unionByName(l2)


@check(
    "hierarchy_order",
    f"""WITH {TEXT_POSTS}, {TREE_SQL} SELECT 'L1' AS level, l1_rank, CAST(0 AS INTEGER) AS l2_rank, l1_id, CAST(-1 AS INTEGER) AS l2_topic, size, label FROM l1
        UNION ALL SELECT 'L2', l1_rank, l2_rank, l1_id, l2_topic, size, label FROM l2""",
)
def _(t: Tables):
    from topicloom.plans.review import clean_hierarchy

    rows = ordered_hierarchy(clean_hierarchy(_tree(t))).withColumn("l2_topic", F.coalesce("l2_topic", F.lit(-1)))
    return rows.select("level", "l1_rank", "l2_rank", "l1_id", "l2_topic", "size", "label").orderBy("l1_rank", "l2_rank")


@check(
    "prepared_posts",
    f"""WITH {TEXT_POSTS}, {TB_SQL} SELECT post_id, topic, CAST(topic % 3 AS INTEGER) AS l1_id, CAST(score AS DOUBLE) AS score, subreddit,
          'https://www.reddit.com' || permalink AS permalink, {EXCERPT_SQL} AS excerpt FROM tb WHERE topic NOT IN (-1, 5)""",
)
def _(t: Tables):
    posts = t.text_posts()
    mapping = _tree(t).where(F.col("level") == "L2").select("l2_topic", "l1_id")
    rows = prepare_posts(posts.drop("topic", "parent_topic"), posts.select("post_id", "topic"), mapping)
    return rows.select("post_id", "topic", "l1_id", "score", "subreddit", "permalink", "excerpt")


REVIEW_SQL = f"""{TEXT_POSTS}, {TB_SQL}, {TREE_SQL},
posts AS (SELECT *, topic % 3 AS l1_id, {EXCERPT_SQL} AS excerpt FROM tb WHERE topic NOT IN (-1, 5)),
l3 AS (SELECT *, CAST(post_id % 4 AS INTEGER) AS l3_topic FROM posts),
l3_size AS (SELECT CAST(post_id % 4 AS INTEGER) AS l3_topic, count(*) AS n FROM tb GROUP BY 1),
p1 AS (SELECT *, row_number() OVER (PARTITION BY l1_id ORDER BY score DESC, post_id) AS r FROM posts),
p2 AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, post_id) AS r FROM posts),
p3 AS (SELECT *, row_number() OVER (PARTITION BY topic, l3_topic ORDER BY score DESC, post_id) AS r FROM l3)
SELECT 'L1' AS level, l1_rank, CAST(0 AS INTEGER) AS l2_rank, CAST(l1.l1_id AS INTEGER) AS l1_id, CAST(-1 AS INTEGER) AS l2_topic, CAST(-1 AS INTEGER) AS l3_topic,
  l1.size, l1.label, CAST(r AS INTEGER) AS rank, post_id, CAST(score AS DOUBLE) AS score, excerpt FROM l1 JOIN p1 USING (l1_id) WHERE r <= 20
UNION ALL SELECT 'L2', l1_rank, l2_rank, l2.l1_id, l2_topic, -1, l2.size, l2.label, CAST(r AS INTEGER), post_id, score, excerpt FROM l2 JOIN p2 ON l2_topic = topic WHERE r <= 20
UNION ALL SELECT 'L3', l1_rank, l2_rank, l2.l1_id, l2_topic, p3.l3_topic, n, 'L3 ' || p3.l3_topic, CAST(r AS INTEGER), post_id, score, excerpt
  FROM l2 JOIN p3 ON l2_topic = topic JOIN l3_size s ON s.l3_topic = p3.l3_topic WHERE r <= 20"""


@check("label_review", f"WITH {REVIEW_SQL}")
def _(t: Tables):
    posts = t.text_posts()
    l3 = posts.select("post_id", (F.col("post_id") % 4).cast("int").alias("topic"), F.col("topic").alias("parent_topic"))
    rows = label_review(posts.drop("topic", "parent_topic"), posts.select("post_id", "topic"), _tree(t), l3_clusters=l3)
    minus = lambda c: F.coalesce(c, F.lit(-1)).alias(c)
    return rows.select(
        "level", "l1_rank", "l2_rank", "l1_id", minus("l2_topic"), minus("l3_topic"), "size", "label", "rank", "post_id", "score", "excerpt"
    )


@check(
    "growth_review",
    f"WITH {ORDER_POSTS}, clean AS (SELECT * FROM order_posts WHERE topic <> -1), "
    + growth_sql(
        "clean",
        "90, 180, 360",
        """SELECT * FROM (SELECT g.*, CAST(row_number() OVER (PARTITION BY window_days ORDER BY growth_abs DESC, topic) AS INTEGER) AS rank,
             coalesce(n_name, 'L3 ' || topic) AS label FROM growth g LEFT JOIN nation ON n_nationkey = topic AND n_nationkey % 2 = 0) WHERE rank <= 200""",
    ),
)
def _(t: Tables):
    posts = t.order_posts()
    labels = t.read("nation").where(F.col("n_nationkey") % 2 == 0).select(F.col("n_nationkey").alias("topic"), F.col("n_name").alias("label"))
    return _rounded(growth_review(posts.drop("topic", "parent_topic"), posts.select("post_id", "topic"), labels))


@check(
    "growing_topic_posts",
    f"WITH {ORDER_POSTS}, clean AS (SELECT * FROM order_posts WHERE topic <> -1), "
    + growth_sql(
        "clean",
        "90",
        """, best AS (SELECT topic FROM growth ORDER BY growth_abs DESC, topic LIMIT 2)
           SELECT topic, CAST(r AS INTEGER) AS rank, post_id, score FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, post_id) AS r
           FROM clean WHERE topic IN (SELECT topic FROM best)) WHERE r <= 20""",
    ).replace(")\n,", "),"),
)
def _(t: Tables):
    posts = t.order_posts()
    canonical, clusters = posts.drop("topic", "parent_topic"), posts.select("post_id", "topic")
    best = ranked_growth(growth_counts(dated_topics(clusters, canonical.select("post_id", "date")), [90]), 2)
    return growing_posts(canonical, clusters, best).select("topic", "rank", "post_id", "score")


@check(
    "drill_down_order",
    """WITH s AS (SELECT r_name, n_name, count(*) AS size FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
       g AS (SELECT r_name, sum(size) AS total FROM s GROUP BY 1)
       SELECT r_name, n_name, size, CAST(dense_rank() OVER (ORDER BY total DESC, r_name) AS INTEGER) AS l1_rank,
         CAST(row_number() OVER (PARTITION BY r_name ORDER BY size DESC, n_name) AS INTEGER) AS l2_rank FROM s JOIN g USING (r_name)""",
)
def _(t: Tables):
    rows = t.read("customer").join(t.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.read("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    sizes = rows.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("size"))
    totals = sizes.groupBy("r_name").agg(F.sum("size").alias("total"))
    totals = totals.withColumn("l1_rank", F.dense_rank().over(Window.orderBy(F.desc("total"), "r_name")))
    inside = F.row_number().over(Window.partitionBy("r_name").orderBy(F.desc("size"), "n_name"))
    return sizes.join(totals.drop("total"), "r_name").withColumn("l2_rank", inside).orderBy("l1_rank", "l2_rank")
