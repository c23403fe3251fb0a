"""Similarity, clustering and comparison on the given vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from topicloom.checks.tables import VECTOR_POSTS, VECTORS, Tables, centroids_sql, check, other_run_sql
from topicloom.functions.text import join_examples
from topicloom.functions.vectors import cosine
from topicloom.operators.agreement import (
    clustering_metrics,
    compare_clusterings,
    consensus,
    contingency,
    map_to_base,
    pair_scores,
    side_by_side,
)
from topicloom.operators.anchors import assign_anchors
from topicloom.operators.centroids import nearest_topic, reassign_noise, topic_centroids, top_n_topics, with_assignments
from topicloom.operators.communities import communities, modularity, multi_graph, simple_graph
from topicloom.operators.components import connected_components
from topicloom.operators.density import DensitySetting, density_cluster_labels, threshold_links
from topicloom.operators.density_tree import mutual_reachability
from topicloom.operators.descent import descended_neighbors
from topicloom.operators.embed import embed_hashed, text_table
from topicloom.operators.examples import central_examples, central_posts
from topicloom.operators.forest import spanning_forest
from topicloom.operators.labels import term_labels, topic_terms
from topicloom.operators.neighbors import nearest_neighbors, similar_pairs
from topicloom.operators.ranking import dense_ids, topic_sizes
from topicloom.operators.reduce import fit_components, reduce_dimensions
from topicloom.operators.split import split_topics
from topicloom.operators.ward import ward_groups
from topicloom.plans.clustering import (
    combine_runs,
    density_cluster,
    graph_cluster,
    stability_cluster,
    sub_topics,
    tune,
    two_stage_cluster,
)
from topicloom.plans.hierarchy import build_hierarchy, group_sizes, hierarchy_levels, hierarchy_prompts
from topicloom.plans.labelling import group_by_anchors, keyword_ideas, label_topics, topic_prompts
from topicloom.plans.refinement import refine
from topicloom.session import materialize

CENTROIDS = f"{VECTORS}, {centroids_sql('vectors')}"
SIMS = f"""{CENTROIDS}, sims AS (
  SELECT v.post_id, c.topic, list_cosine_similarity(v.embedding, c.centroid) AS sim FROM vectors v CROSS JOIN centroids c)"""
RANKED = f"""{SIMS}, ranked AS (
  SELECT post_id, topic, sim, CAST(row_number() OVER (PARTITION BY post_id ORDER BY sim DESC, topic) AS INTEGER) AS rank FROM sims)"""


def long_assignments(df, keep=("post_id",)):
    """One row per entry of the top lists, for comparison."""
    packed = F.arrays_zip(F.col("top_n_topics").alias("t"), F.col("top_n_scores").alias("s"))
    rows = df.select(*keep, F.posexplode(packed).alias("p", "e"))
    return rows.select(*keep, (F.col("p") + 1).alias("rank"), F.col("e.t").alias("near"), F.round("e.s", 4).alias("score"))


@check(
    "topic_centroids",
    f"WITH {CENTROIDS} SELECT topic, CAST(d - 1 AS INTEGER) AS dim, round(centroid[d], 6) + 0 AS x, size FROM centroids, (SELECT unnest(range(1, 65)) AS d)",
)
def _(t: Tables):
    rows = topic_centroids(t.vectors())
    return rows.select("topic", "size", F.posexplode("centroid").alias("dim", "x")).withColumn("x", F.round("x", 6))


@check("top_n_topics", f"WITH {RANKED} SELECT post_id, rank, topic AS near, round(sim, 4) + 0 AS score FROM ranked WHERE rank <= 3")
def _(t: Tables):
    return long_assignments(top_n_topics(t.vectors(), topic_centroids(t.vectors()), 3))


@check("nearest_topic", f"WITH {RANKED} SELECT post_id, topic AS topic_near, round(sim, 4) + 0 AS score_near FROM ranked WHERE rank = 1")
def _(t: Tables):
    return nearest_topic(t.vectors(), topic_centroids(t.vectors())).withColumn("score_near", F.round("score_near", 4))


@check(
    "reassigned_noise",
    f"""WITH {RANKED} SELECT v.post_id, CASE WHEN v.topic = -1 AND sim >= 0.15 THEN r.topic ELSE v.topic END AS topic
        FROM vectors v JOIN ranked r ON v.post_id = r.post_id AND rank = 1""",
)
def _(t: Tables):
    return reassign_noise(t.vectors(), topic_centroids(t.vectors()), 0.15)


PAIRS = f"""{CENTROIDS}, pairs AS (SELECT a.topic AS a, b.topic AS b, list_cosine_similarity(a.centroid, b.centroid) AS sim
  FROM centroids a JOIN centroids b ON a.topic < b.topic)"""


@check("similar_topics", f"WITH {PAIRS} SELECT a, b, round(sim, 4) + 0 AS sim FROM pairs WHERE sim >= 0.1")
def _(t: Tables):
    return similar_pairs(topic_centroids(t.vectors()), 0.1).withColumn("sim", F.round("sim", 4))


@check("most_similar_topics", f"WITH {PAIRS} SELECT a, b, round(sim, 4) + 0 AS sim FROM pairs WHERE sim >= -1 ORDER BY pairs.sim DESC, a, b LIMIT 7")
def _(t: Tables):
    return similar_pairs(topic_centroids(t.vectors()), -1.0, 7).withColumn("sim", F.round("sim", 4))


CENTRAL = f"""{VECTOR_POSTS}, {centroids_sql('vector_posts')}, central AS (
  SELECT v.topic, post_id, text, sim, row_number() OVER (PARTITION BY v.topic ORDER BY sim DESC, post_id) AS r FROM (
    SELECT v.*, list_cosine_similarity(v.embedding, c.centroid) AS sim FROM vector_posts v JOIN centroids c USING (topic)) v)"""


@check(
    "central_examples",
    f"""WITH {CENTRAL} SELECT topic, md5(string_agg(left(text, 400), chr(10) || '---' || chr(10) ORDER BY r)) AS hash,
          CAST(count(*) AS INTEGER) AS n FROM central WHERE r <= 30 GROUP BY 1""",
)
def _(t: Tables):
    rows = central_examples(t.vector_posts(), 30, 400)
    return rows.select("topic", F.md5(join_examples(F.col("examples"))).alias("hash"), F.size("examples").alias("n"))


@check(
    "topic_prompts",
    f"""WITH {CENTRAL}, s AS (SELECT unnest([10, 20]) AS sample_size)
        SELECT topic, CAST(sample_size AS INTEGER) AS sample_size, md5('You are labeling a topic cluster from Reddit posts.' || chr(10) || 'Topic id: ' || topic
          || chr(10) || 'Provide a concise topic label (5-8 words) and a 1-2 sentence summary.' || chr(10) || 'Examples:' || chr(10)
          || string_agg(left(text, 400), chr(10) || '---' || chr(10) ORDER BY r) || chr(10) || 'Return JSON with keys: label, summary.') AS hash
        FROM central, s WHERE r <= sample_size GROUP BY topic, sample_size""",
)
def _(t: Tables):
    return topic_prompts(t.vector_posts(), [10, 20]).select("topic", "sample_size", F.md5("prompt").alias("hash"))


def echo_model(prompts: list[str]) -> list[str]:
    """A stand-in for a hosted model: replies depend only on the prompt."""
    return [f'{{"label": "{len(p)}", "summary": "s", "keywords": ["{len(p)}", " two "]}}' if len(p) % 2 else f"len {len(p)}" for p in prompts]


@check(
    "label_topics",
    f"""WITH {CENTRAL}, s AS (SELECT unnest([10, 20]) AS sample_size), p AS (
          SELECT topic, sample_size, CAST(length('You are labeling a topic cluster from Reddit posts.' || 'Topic id: ' || topic
            || 'Provide a concise topic label (5-8 words) and a 1-2 sentence summary.' || 'Examples:'
            || string_agg(left(text, 400), chr(10) || '---' || chr(10) ORDER BY r) || 'Return JSON with keys: label, summary.') + 5 AS BIGINT) AS n
          FROM central, s WHERE r <= sample_size GROUP BY topic, sample_size)
        SELECT topic, CAST(sample_size AS INTEGER) AS sample_size, 'local' AS backend, 'echo' AS model,
          CASE WHEN n % 2 = 1 THEN '' || n ELSE 'len ' || n END AS label, CASE WHEN n % 2 = 1 THEN 's' ELSE 'len ' || n END AS summary
        FROM p WHERE NOT (sample_size = 10 AND topic % 2 = 0)""",
)
def _(t: Tables):
    posts = t.vector_posts()
    stored = topic_sizes(posts).where(F.col("topic") % 2 == 0).select("topic", F.lit(10).alias("sample_size"), F.lit("local").alias("backend"))
    return label_topics(posts, {"local": ("echo", echo_model)}, [10, 20], existing=stored)


@check(
    "keyword_ideas",
    """SELECT CAST(doc_id % 9 % 3 AS INTEGER) AS l2_topic, CAST(doc_id % 9 - 1 AS INTEGER) AS l3_topic, count(*) AS post_count, 2 AS keyword_count
       FROM documents WHERE doc_id % 9 <> 0 GROUP BY 1, 2""",
)
def _(t: Tables):
    reply = lambda prompts: ['{"keywords": ["' + p.split("L3 theme: ")[1].split("\n")[0] + '", "", "two "]}' for p in prompts]
    rows = keyword_ideas(t.text_posts(), reply, min_size=1)
    return rows.select("l2_topic", "l3_topic", "post_count", F.size(F.split("keywords", "; ")).alias("keyword_count"))


TERMS = r"""words AS (SELECT CAST(doc_id % 9 - 1 AS INTEGER) AS topic, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents WHERE doc_id % 9 <> 0),
counts AS (SELECT topic, term, count(*) AS n FROM words GROUP BY 1, 2),
per_topic AS (SELECT topic, sum(n) AS topic_words FROM counts GROUP BY 1), per_term AS (SELECT term, sum(n) AS uses FROM counts GROUP BY 1),
scored AS (SELECT topic, term, n / topic_words * ln(1 + (SELECT avg(topic_words) FROM per_topic) / uses) AS weight
  FROM counts JOIN per_topic USING (topic) JOIN per_term USING (term)),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS INTEGER) AS rank FROM scored)"""


@check("topic_terms", f"WITH {TERMS} SELECT topic, rank, term, round(weight, 6) AS weight FROM ranked WHERE rank <= 10")
def _(t: Tables):
    return topic_terms(t.text_posts().withColumnRenamed("body", "text"), 10).withColumn("weight", F.round("weight", 6))


@check(
    "term_labels",
    f"""WITH {TERMS} SELECT topic, string_agg(term, ' ' ORDER BY rank) AS label, string_agg(term, ', ' ORDER BY rank) AS summary FROM ranked WHERE rank <= 6 GROUP BY 1""",
)
def _(t: Tables):
    return term_labels(t.text_posts().withColumnRenamed("body", "text"))


@check(
    "assigned_anchors",
    f"""WITH {CENTRAL}, anchors AS (SELECT topic AS l2_topic, CAST(row_number() OVER (ORDER BY topic, r) - 1 AS INTEGER) AS l3_topic, post_id AS anchor_post FROM central WHERE r <= 5),
        s AS (SELECT v.post_id, v.topic AS parent_topic, l3_topic, list_cosine_similarity(v.embedding, e.embedding) AS sim
              FROM vectors v JOIN anchors a ON v.topic = a.l2_topic JOIN vectors e ON e.post_id = a.anchor_post),
        b AS (SELECT post_id, parent_topic, l3_topic, sim, row_number() OVER (PARTITION BY post_id ORDER BY sim DESC, l3_topic) AS r,
              round(sum(sim) OVER (PARTITION BY post_id), 4) AS total FROM s)
        SELECT post_id, parent_topic, CASE WHEN sim < 0.2 THEN -1 ELSE l3_topic END AS topic, total FROM b WHERE r = 1""",
)
def _(t: Tables):
    best = materialize(central_posts(t.vector_posts(), 5), "anchors")
    ids = dense_ids(best.select("topic", "rank", "post_id"), ["topic", "rank"], "l3_topic")
    anchors = ids.join(t.vectors().select("post_id", "embedding"), "post_id").select(F.col("topic").alias("l2_topic"), "l3_topic", "embedding")
    rows = assign_anchors(t.vectors(), anchors)
    total = F.aggregate("top_n_scores", F.lit(0.0), lambda a, x: a + x)
    return rows.select("post_id", "parent_topic", "topic", F.round(total, 4).alias("total"))


def anchor_model(prompts: list[str]) -> list[str]:
    """A stand-in that proposes two anchors per topic."""
    return ['```json\n{"anchors": [{"label": "first", "keywords": ["a", "b"]}, {"label": "second"}]}\n```' for _ in prompts]


@check(
    "anchor_tables",
    f"""WITH {VECTOR_POSTS}, s AS (SELECT topic, count(*) AS n FROM vector_posts WHERE topic <> -1 GROUP BY 1 HAVING count(*) >= 5),
        r AS (SELECT *, CAST(row_number() OVER (ORDER BY n DESC, topic) - 1 AS INTEGER) AS k FROM s)
        SELECT topic AS l2_topic, 2 * k AS l3_topic, 'L2 ' || topic AS l2_label, 'first' AS l3_label, 'a; b' AS keywords, CAST(30 AS INTEGER) AS sample_size,
          n AS post_count, true AS within FROM r
        UNION ALL SELECT topic, 2 * k + 1, 'L2 ' || topic, 'second', '', 30, n, true FROM r""",
)
def _(t: Tables):
    def model():
        import numpy as np

        return lambda texts: np.array([[1.0 if "first" in x else -1.0] + [0.5] * 63 for x in texts])

    posts = t.vector_posts().select("post_id", "topic", "embedding", F.col("text").alias("body"), F.lit("").alias("title"), F.col("post_id").alias("score"))
    tables = group_by_anchors(posts, anchor_model, model, "local", "stand-in", min_size=5, min_similarity=-1.0)
    assigned = topic_sizes(tables.clusters).select(F.col("topic").alias("l3_topic"), F.col("size").alias("own"))
    rows = tables.keywords.join(assigned, "l3_topic", "left")
    fits = (F.coalesce("own", F.lit(0)) == F.col("assigned_count")) & (F.col("assigned_count") <= F.col("post_count"))
    return rows.select("l2_topic", "l3_topic", "l2_label", "l3_label", "keywords", "sample_size", "post_count", fits.alias("within"))


# Comparison and consensus.
RUNS = f"{VECTORS}, {other_run_sql('run_a', 7)}, {other_run_sql('run_b', 11)}"
TABLE = "ct AS (SELECT v.topic AS topic_left, a.topic AS topic_right, count(*) AS n FROM vectors v JOIN run_a a USING (post_id) WHERE v.topic <> -1 AND a.topic <> -1 GROUP BY 1, 2)"
SCORES = """ra AS (SELECT topic_left, CAST(sum(n) AS DOUBLE) AS a FROM ct GROUP BY 1), rb AS (SELECT topic_right, CAST(sum(n) AS DOUBLE) AS b FROM ct GROUP BY 1),
tot AS (SELECT CAST(sum(n) AS DOUBLE) AS t FROM ct),
p AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM ct) AS ab, (SELECT sum(a * (a - 1) / 2) FROM ra) AS pa, (SELECT sum(b * (b - 1) / 2) FROM rb) AS pb, t,
  (SELECT -sum(a / t * ln(a / t)) FROM ra, tot) AS ha, (SELECT -sum(b / t * ln(b / t)) FROM rb, tot) AS hb,
  (SELECT sum(n / t * ln(n * t / (a * b))) FROM ct JOIN ra USING (topic_left) JOIN rb USING (topic_right), tot) AS mi FROM tot),
scores AS (SELECT (ab - pa * pb / (t * (t - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (t * (t - 1) / 2)) AS ari, mi / ((ha + hb) / 2) AS nmi FROM p)"""


@check("side_by_side", f"WITH {RUNS} SELECT v.post_id, v.topic AS topic_left, a.topic AS topic_right FROM vectors v JOIN run_a a USING (post_id)")
def _(t: Tables):
    return side_by_side(t.vectors().select("post_id", "topic"), t.other_run(7))


@check("contingency", f"WITH {RUNS}, {TABLE} SELECT * FROM ct")
def _(t: Tables):
    return contingency(side_by_side(t.vectors().select("post_id", "topic"), t.other_run(7)))


@check("pair_scores", f"WITH {RUNS}, {TABLE}, {SCORES} SELECT round(ari, 6) AS ari, round(nmi, 6) AS nmi FROM scores")
def _(t: Tables):
    table = contingency(side_by_side(t.vectors().select("post_id", "topic"), t.other_run(7)))
    return pair_scores(table).select(F.round("ari", 6).alias("ari"), F.round("nmi", 6).alias("nmi"))


def top_lists_sql(labels: str, name: str, shift: int = 0) -> str:
    """Top three topics per post for a clustering held in ``labels``."""
    joined = f"{name}_rows AS (SELECT v.post_id, v.embedding, l.topic FROM vectors v JOIN {labels} l USING (post_id))"
    return f"""{joined}, {centroids_sql(f'{name}_rows', f'{name}_c')}, {name} AS (
  SELECT post_id, list(topic - {shift} ORDER BY rank) AS lst FROM (
    SELECT r.post_id, c.topic, row_number() OVER (PARTITION BY r.post_id ORDER BY list_cosine_similarity(r.embedding, c.centroid) DESC, c.topic) AS rank
    FROM {name}_rows r CROSS JOIN {name}_c c) WHERE rank <= 3 GROUP BY 1)"""


@check(
    "compare_clusterings",
    f"""WITH {RUNS}, {TABLE}, {SCORES}, {top_lists_sql('vectors', 'l')}, {top_lists_sql('run_a', 'q', 100)},
        j AS (SELECT len(list_intersect(l.lst, q.lst)) / CAST(len(list_distinct(list_concat(l.lst, q.lst))) AS DOUBLE) AS jac,
                CASE WHEN list_contains(q.lst, l.lst[1]) THEN 1.0 ELSE 0.0 END AS hit FROM l JOIN q USING (post_id))
        SELECT (SELECT count(*) FROM j) AS rows_compared, round(ari, 4) AS ari_no_neg1, round(nmi, 4) AS nmi_no_neg1,
          (SELECT round(avg(jac), 4) FROM j) AS avg_topn_jaccard, (SELECT round(avg(hit) * 100, 2) FROM j) AS top1_in_other_topn_pct FROM scores""",
)
def _(t: Tables):
    left = with_assignments(t.vectors(), t.vectors().select("post_id", "topic"), 3)
    right = with_assignments(t.vectors(), t.other_run(7), 3)
    shifted = right.withColumns(
        {
            "topic": F.when(F.col("topic") == -1, -1).otherwise(F.col("topic") - 100),
            "top_n_topics": F.transform("top_n_topics", lambda x: x - 100),
        }
    ).select(*left.columns)
    return compare_clusterings(left, shifted)


def metrics_sql(source: str, by: str = "") -> str:
    group = f"{by}, " if by else ""
    tail = f"GROUP BY {by}" if by else ""
    return f"""SELECT {group}count(CASE WHEN topic <> -1 THEN 1 END) AS topics,
      round(100.0 * sum(CASE WHEN topic = -1 THEN n ELSE 0 END) / sum(n), 2) AS noise_pct,
      coalesce(round(avg(CASE WHEN topic <> -1 THEN n END), 2), 0) AS avg_cluster_size,
      coalesce(round(median(CASE WHEN topic <> -1 THEN n END), 2), 0) AS median_cluster_size
    FROM (SELECT {group}topic, count(*) AS n FROM {source} GROUP BY {group}topic) {tail}"""


@check("clustering_metrics", f"WITH {VECTORS} {metrics_sql('vectors')}")
def _(t: Tables):
    return clustering_metrics(t.vectors())


MAPPED = """runs AS (SELECT CAST(1 AS INTEGER) AS run, * FROM run_a UNION ALL SELECT 2, * FROM run_b),
overlap AS (SELECT run, r.topic, v.topic AS base_topic, count(*) AS n, min(post_id) AS first_id FROM runs r JOIN vectors v USING (post_id)
  WHERE r.topic <> -1 AND v.topic <> -1 GROUP BY 1, 2, 3),
run_size AS (SELECT run, topic, count(*) AS s FROM runs WHERE topic <> -1 GROUP BY 1, 2),
base_size AS (SELECT topic AS base_topic, count(*) AS b FROM vectors WHERE topic <> -1 GROUP BY 1),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run, topic ORDER BY n DESC, first_id) AS r FROM overlap) WHERE r = 1),
mapping AS (SELECT run, topic, CASE WHEN n / CAST(s + b - n AS DOUBLE) >= 0.6 THEN base_topic ELSE -1 END AS base_topic
  FROM run_size LEFT JOIN best USING (run, topic) LEFT JOIN base_size USING (base_topic))"""


def _runs(t: Tables):
    return t.other_run(7).withColumn("run", F.lit(1)).unionByName(t.other_run(11).withColumn("run", F.lit(2)))


@check("clusters_mapped_to_base", f"WITH {RUNS}, {MAPPED} SELECT run, topic, base_topic FROM mapping")
def _(t: Tables):
    return map_to_base(t.vectors().select("post_id", "topic"), _runs(t), 0.6)


def consensus_sql(votes: str, k: int) -> str:
    return f"""counted AS (SELECT post_id, topic, count(*) AS n, min(run) AS first_run FROM ({votes}) WHERE topic <> -1 GROUP BY 1, 2),
won AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY n DESC, first_run) AS r FROM counted) WHERE r = 1)
SELECT v.post_id, CAST(CASE WHEN n >= {k} THEN w.topic ELSE -1 END AS INTEGER) AS topic FROM vectors v LEFT JOIN won w USING (post_id)"""


@check("majority_vote", f"WITH {RUNS}, " + consensus_sql(
    "SELECT post_id, 0 AS run, topic FROM vectors UNION ALL SELECT post_id, 1, CASE WHEN topic = -1 THEN -1 ELSE topic - 100 END FROM run_a "
    "UNION ALL SELECT post_id, 2, CASE WHEN topic = -1 THEN -1 ELSE topic - 100 END FROM run_b", 3))
def _(t: Tables):
    shifted = _runs(t).withColumn("topic", F.when(F.col("topic") == -1, -1).otherwise(F.col("topic") - 100))
    return consensus(t.vectors().select("post_id", "topic"), shifted, 3)


@check("combined_runs", f"WITH {RUNS}, {MAPPED}, " + consensus_sql(
    "SELECT post_id, 0 AS run, topic FROM vectors UNION ALL SELECT post_id, run, coalesce(base_topic, -1) FROM runs LEFT JOIN mapping USING (run, topic)", 2))
def _(t: Tables):
    base = t.vectors().select("post_id", "topic", F.lit(0).alias("run"))
    return combine_runs(base.unionByName(_runs(t)), 0.6, 2)


# Neighbours, graphs and density.
ALL_SIMS = f"""{VECTORS}, near AS MATERIALIZED (
  SELECT a.post_id AS src, b.post_id AS dst, list_cosine_similarity(a.embedding, b.embedding) AS sim FROM vectors a JOIN vectors b ON a.post_id <> b.post_id)"""
KNN = f"""{ALL_SIMS}, knn AS (SELECT * FROM (
  SELECT src, dst, sim, CAST(row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS INTEGER) AS rank FROM near) WHERE rank <= 9)"""


@check("nearest_neighbors", f"WITH {KNN} SELECT src, dst, rank, round(sim, 4) + 0 AS sim FROM knn")
def _(t: Tables):
    return nearest_neighbors(t.vectors(), 10).withColumn("sim", F.round("sim", 4))


@check("nearest_neighbors_pruned", f"WITH {KNN} SELECT src, dst, rank, round(sim, 4) + 0 AS sim FROM knn")
def _(t: Tables):
    return nearest_neighbors(t.vectors(), 10, block_rows=256).withColumn("sim", F.round("sim", 4))


@check(
    "descended_neighbors",
    f"WITH {KNN} SELECT count(*) AS links, true AS most_found, CAST(0 AS BIGINT) AS wrong FROM knn",
)
def _(t: Tables):
    # Nine in ten of the true neighbours, and every similarity given is that of its pair.
    got = materialize(descended_neighbors(t.vectors(), 10), "descended")
    true = nearest_neighbors(t.vectors(), 10).select("src", "dst", F.lit(1).alias("hit"))
    vec = t.vectors().select("post_id", "embedding")
    pairs = got.join(vec.withColumnsRenamed({"post_id": "src", "embedding": "x"}), "src").join(vec.withColumnsRenamed({"post_id": "dst", "embedding": "y"}), "dst").join(true, ["src", "dst"], "left")
    off = (F.abs(F.col("sim") - cosine(F.col("x"), F.col("y"))) > 1e-6) | (F.col("src") == F.col("dst"))
    return pairs.agg(F.count(F.lit(1)).alias("links"), (F.sum("hit") >= 0.9 * F.count(F.lit(1))).alias("most_found"), F.count_if(off).alias("wrong"))


@check(
    "neighbor_graphs",
    f"""WITH {KNN}, e AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, max(sim) AS w, count(*) AS m FROM knn GROUP BY 1, 2)
        SELECT count(*) AS edges, round(sum(w), 3) AS weight, CAST(sum(m) AS DOUBLE) AS multiplicity FROM e WHERE w > 0""",
)
def _(t: Tables):
    near = materialize(nearest_neighbors(t.vectors(), 10), "near")
    edges = simple_graph(near).join(multi_graph(near).withColumnRenamed("w", "m"), ["a", "b"])
    return edges.agg(F.count(F.lit(1)).alias("edges"), F.round(F.sum("w"), 3).alias("weight"), F.sum("m").alias("multiplicity"))


COMPONENTS = """RECURSIVE {head}, e AS (SELECT src AS a, dst AS b FROM near WHERE sim >= 0.4 UNION SELECT dst, src FROM near WHERE sim >= 0.4),
reach(id, root) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.id)"""


@check("connected_components", f"WITH {COMPONENTS.format(head=ALL_SIMS)} SELECT id, min(root) AS root FROM reach GROUP BY 1")
def _(t: Tables):
    points = t.vectors().select(F.lit(0).alias("grp"), F.col("post_id").alias("id"), "embedding")
    return connected_components(threshold_links(points, 0.4)).select("id", "root")


# Modularity of the labels that come with the vectors, which the communities found have to beat, on the graph in ``g``.
LABEL_Q = """m AS (SELECT sum(w) AS m FROM g), l AS (SELECT vec_id, label FROM embeddings),
inside AS (SELECT sum(w) AS w FROM g JOIN l x ON x.vec_id = a JOIN l y ON y.vec_id = b WHERE x.label = y.label),
ends AS (SELECT label, sum(w) AS tot FROM (SELECT a AS id, w FROM g UNION ALL SELECT b, w FROM g) JOIN l ON vec_id = id GROUP BY 1),
q AS (SELECT round((SELECT w FROM inside) / (SELECT m FROM m) - sum(tot * tot) / (4 * (SELECT m * m FROM m)), 5) AS label_q FROM ends)"""
SIMPLE_GRAPH = f"{KNN}, g AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, max(sim) AS w FROM knn GROUP BY 1, 2 HAVING max(sim) > 0)"
MULTI_GRAPH = f"{KNN}, g AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, CAST(count(*) AS DOUBLE) AS w FROM knn GROUP BY 1, 2)"
FOUND = "(SELECT count(*) FROM embeddings) AS posts, (SELECT count(*) FROM embeddings) AS labelled, CAST(0 AS INTEGER) AS first_topic, true AS structured"


def _community_report(t: Tables, clusters, edges, connected: bool):
    members = clusters.select(F.col("post_id").alias("id"), F.col("topic").alias("comm"))
    labels = t.read("embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("comm"))
    edges = materialize(edges, "edges")
    base = modularity(edges, labels).select(F.round("q", 5).alias("label_q"))
    # Better than the given labels, and by no less than a search that was not cut short reaches on these tables.
    q = modularity(edges, members).join(F.broadcast(base)).select("label_q", ((F.col("q") > F.col("label_q")) & (F.col("q") > 0.3)).alias("structured"))
    sizes = members.agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("id").alias("labelled"), F.min("comm").alias("first_topic"))
    if not connected:
        return sizes.join(F.broadcast(q))
    ends = edges.join(members.select(F.col("id").alias("a"), F.col("comm").alias("part")), "a").join(
        members.select(F.col("id").alias("b"), F.col("comm").alias("other")), "b"
    )
    roots = connected_components(ends.where(F.col("part") == F.col("other")).select("part", F.col("a").alias("src"), F.col("b").alias("dst")))
    split = members.join(roots.select("id", "root"), "id", "left").groupBy("comm").agg(F.count_distinct(F.coalesce("root", "id")).alias("pieces"))
    return sizes.join(F.broadcast(q)).join(F.broadcast(split.agg(F.max("pieces").alias("most_pieces"))))


@check("louvain_communities", f"WITH {SIMPLE_GRAPH}, {LABEL_Q} SELECT label_q, {FOUND} FROM q")
def _(t: Tables):
    clusters = materialize(graph_cluster(t.vectors(), 10, "louvain"), "graph")
    return _community_report(t, clusters, simple_graph(nearest_neighbors(t.vectors(), 10)), False)


@check(
    "leiden_communities",
    f"WITH {MULTI_GRAPH}, {LABEL_Q} SELECT label_q, {FOUND}, CAST(1 AS BIGINT) AS most_pieces FROM q",
)
def _(t: Tables):
    clusters = materialize(graph_cluster(t.vectors(), 10, "leiden"), "graph")
    return _community_report(t, clusters, multi_graph(nearest_neighbors(t.vectors(), 10)), True)


def density_sql(name: str, source: str, min_sim: float, min_samples: int, min_size: int) -> str:
    """CTEs ending in ``{name}``: ``grp, post_id, sub`` of density clusters within the groups of ``source``."""
    return f"""{name}_e AS MATERIALIZED (SELECT a.grp, a.post_id AS src, b.post_id AS dst, list_cosine_similarity(a.embedding, b.embedding) AS sim
  FROM {source} a JOIN {source} b ON a.grp = b.grp AND a.post_id <> b.post_id WHERE list_cosine_similarity(a.embedding, b.embedding) >= {min_sim}),
{name}_core AS MATERIALIZED (SELECT grp, src AS id FROM {name}_e GROUP BY 1, 2 HAVING count(*) >= {min_samples}),
{name}_ce AS MATERIALIZED (SELECT e.src, e.dst FROM {name}_e e WHERE src IN (SELECT id FROM {name}_core) AND dst IN (SELECT id FROM {name}_core)),
{name}_reach(id, root) AS (SELECT id, id FROM {name}_core UNION SELECT e.dst, r.root FROM {name}_reach r JOIN {name}_ce e ON e.src = r.id),
{name}_rooted AS (SELECT c.grp, c.id, min(root) AS root FROM {name}_reach r JOIN {name}_core c USING (id) GROUP BY 1, 2),
{name}_border AS (SELECT grp, src AS id, dst AS core FROM (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS r FROM {name}_e
  WHERE src NOT IN (SELECT id FROM {name}_core) AND dst IN (SELECT id FROM {name}_core)) WHERE r = 1),
{name}_all AS (SELECT * FROM {name}_rooted UNION ALL SELECT b.grp, b.id, c.root FROM {name}_border b JOIN {name}_rooted c ON c.id = b.core),
{name}_sizes AS (SELECT grp, root, count(*) AS n FROM {name}_all GROUP BY 1, 2 HAVING count(*) >= {min_size}),
{name}_ids AS (SELECT grp, root, CAST(row_number() OVER (PARTITION BY grp ORDER BY n DESC, root) - 1 AS INTEGER) AS sub FROM {name}_sizes),
{name} AS (SELECT a.grp, a.id AS post_id, sub FROM {name}_all a JOIN {name}_ids i ON a.grp = i.grp AND a.root = i.root)"""


# The edges one after the other, from short to long: each that joins two groups of posts is in the forest.
FOREST = f"""RECURSIVE {KNN}, d AS (SELECT src, dst, rank, round(sqrt(greatest(0.0, 2 - 2 * sim)), 9) AS d FROM knn),
core AS (SELECT src AS id, max(d) AS core FROM d WHERE rank <= 5 GROUP BY 1),
pairs AS (SELECT least(src, dst) AS a, greatest(src, dst) AS b, min(greatest(d, x.core, y.core)) AS w FROM d JOIN core x ON x.id = src JOIN core y ON y.id = dst GROUP BY 1, 2),
place AS (SELECT post_id, row_number() OVER (ORDER BY post_id) AS p FROM vectors),
lined AS MATERIALIZED (SELECT row_number() OVER (ORDER BY w, a, b) AS i, a, b, w, x.p AS pa, y.p AS pb FROM pairs JOIN place x ON x.post_id = a JOIN place y ON y.post_id = b),
taken(i, a, b, w, joined, groups) AS (SELECT 0::BIGINT, NULL::BIGINT, NULL::BIGINT, NULL::DOUBLE, false, (SELECT list(p ORDER BY p) FROM place)
  UNION ALL SELECT l.i, l.a, l.b, l.w, groups[pa] <> groups[pb], CASE WHEN groups[pa] <> groups[pb] THEN list_transform(groups, lambda g: CASE WHEN g = groups[pb] THEN groups[pa] ELSE g END) ELSE groups END
  FROM taken t JOIN lined l ON l.i = t.i + 1)"""


@check("density_forest", f"WITH {FOREST} SELECT a, b, round(w, 6) AS w FROM taken WHERE joined")
def _(t: Tables):
    return spanning_forest(mutual_reachability(nearest_neighbors(t.vectors(), 10), 5)).withColumn("w", F.round("w", 6))


@check(
    "density_tree_clusters",
    "SELECT count(*) AS posts, count(DISTINCT vec_id) AS labelled, true AS large_enough, true AS dense_ids FROM embeddings",
)
def _(t: Tables):
    # The tests hold the tree to brute force; here every post has one label, and topics are numbered by size.
    found = materialize(density_cluster(t.vectors(), DensitySetting(0, None, 4, 8, 12)), "tree")
    sizes = topic_sizes(found).agg(F.coalesce(F.min("size"), F.lit(8)).alias("least"), F.count(F.lit(1)).alias("topics"))
    sums = found.agg(F.count(F.lit(1)).alias("posts"), F.count_distinct("post_id").alias("labelled"), F.max("topic").alias("top"))
    return sums.join(F.broadcast(sizes)).select("posts", "labelled", (F.col("least") >= 8).alias("large_enough"), (F.col("top") == F.col("topics") - 1).alias("dense_ids"))


FLAT = f"{VECTORS}, flat AS (SELECT 0 AS grp, post_id, embedding FROM vectors)"
ONE = DensitySetting(0, 0.33, 5, 3)


@check(
    "density_labels",
    f"WITH RECURSIVE {FLAT}, {density_sql('d', 'flat', 0.33, 5, 3)} SELECT v.post_id, coalesce(sub, -1) AS topic FROM vectors v LEFT JOIN d USING (post_id)",
)
def _(t: Tables):
    return density_cluster_labels(t.vectors(), [ONE]).select("post_id", "topic")


DENSE_ROWS = "labelled AS MATERIALIZED (SELECT v.post_id, v.embedding, coalesce(sub, -1) AS topic FROM vectors v LEFT JOIN d USING (post_id))"


def assignment_sql(rows: str, extra: str = "") -> str:
    """Top three topics per post of ``rows`` (``post_id, topic, embedding``), one row each."""
    return f"""{centroids_sql(rows, 'final_c')}, final_s AS (
  SELECT r.post_id, r.topic{extra}, c.topic AS near, list_cosine_similarity(r.embedding, c.centroid) AS sim FROM {rows} r CROSS JOIN final_c c),
final_r AS (SELECT *, CAST(row_number() OVER (PARTITION BY post_id ORDER BY sim DESC, near) AS INTEGER) AS rank FROM final_s)
SELECT post_id, topic{extra}, rank, near, round(sim, 4) + 0 AS score FROM final_r WHERE rank <= 3"""


@check("density_clusters", f"WITH RECURSIVE {FLAT}, {density_sql('d', 'flat', 0.33, 5, 3)}, {DENSE_ROWS}, {assignment_sql('labelled')}")
def _(t: Tables):
    return long_assignments(density_cluster(t.vectors(), ONE), ["post_id", "topic"])


REASSIGNED = f"""{centroids_sql('labelled', 'first_c')}, moved AS MATERIALIZED (
  SELECT l.post_id, l.embedding, CASE WHEN l.topic = -1 AND s.sim >= 0.45 THEN s.near ELSE l.topic END AS topic FROM labelled l JOIN (
    SELECT r.post_id, c.topic AS near, list_cosine_similarity(r.embedding, c.centroid) AS sim,
      row_number() OVER (PARTITION BY r.post_id ORDER BY list_cosine_similarity(r.embedding, c.centroid) DESC, c.topic) AS k
    FROM labelled r CROSS JOIN first_c c) s ON s.post_id = l.post_id AND s.k = 1)"""


@check(
    "density_clusters_reassigned",
    f"WITH RECURSIVE {FLAT}, {density_sql('d', 'flat', 0.33, 5, 3)}, {DENSE_ROWS}, {REASSIGNED}, {assignment_sql('moved')}",
)
def _(t: Tables):
    return long_assignments(density_cluster(t.vectors(), ONE, reassign_threshold=0.45, recompute_centroids=True), ["post_id", "topic"])


BLOB = DensitySetting(0, 0.30, 5, 1)
INNER = DensitySetting(0, 0.34, 4, 3)
BLOBS = f"""{FLAT}, {density_sql('d', 'flat', 0.30, 5, 1)}, {DENSE_ROWS},
large AS (SELECT topic AS grp, row_number() OVER (ORDER BY count(*) DESC, topic) AS rank FROM labelled WHERE topic <> -1 GROUP BY 1 HAVING count(*) >= 5),
inside AS MATERIALIZED (SELECT topic AS grp, post_id, embedding FROM labelled WHERE topic IN (SELECT grp FROM large)),
{density_sql('s', 'inside', 0.34, 4, 3)}, several AS (SELECT grp FROM s GROUP BY 1 HAVING max(sub) > 0)"""


@check(
    "two_stage_clusters",
    f"""WITH RECURSIVE {BLOBS}, ids AS (SELECT grp, sub, (SELECT max(topic) + 1 FROM labelled) + row_number() OVER (ORDER BY rank, sub) - 1 AS new_topic
          FROM (SELECT DISTINCT s.grp, sub, rank FROM s JOIN several USING (grp) JOIN large USING (grp))),
        final AS MATERIALIZED (SELECT l.post_id, l.embedding, CAST(CASE WHEN l.topic IN (SELECT grp FROM several) THEN coalesce(new_topic, -1) ELSE l.topic END AS INTEGER) AS topic
          FROM labelled l LEFT JOIN s ON s.post_id = l.post_id LEFT JOIN ids ON ids.grp = s.grp AND ids.sub = s.sub),
        {assignment_sql('final')}""",
)
def _(t: Tables):
    return long_assignments(two_stage_cluster(t.vectors(), BLOB, INNER, 5), ["post_id", "topic"])


@check(
    "sub_topic_clusters",
    f"""WITH RECURSIVE {BLOBS}, ids AS (SELECT grp, sub, row_number() OVER (ORDER BY rank, sub) - 1 AS l3
          FROM (SELECT DISTINCT s.grp, sub, rank FROM s JOIN several USING (grp) JOIN large USING (grp))),
        final AS MATERIALIZED (SELECT l.post_id, l.embedding, l.topic AS parent_topic, CAST(coalesce(l3, -1) AS INTEGER) AS topic
          FROM labelled l LEFT JOIN s ON s.post_id = l.post_id LEFT JOIN ids ON ids.grp = s.grp AND ids.sub = s.sub),
        {assignment_sql('final', ', r.parent_topic').replace('SELECT post_id, topic, r.parent_topic', 'SELECT post_id, topic, parent_topic')}""",
)
def _(t: Tables):
    first = materialize(density_cluster_labels(t.vectors(), [BLOB]).select("post_id", "topic"), "first")
    return long_assignments(sub_topics(t.vectors(), first, INNER, 5), ["post_id", "topic", "parent_topic"])


GRID = [DensitySetting(i, s, m, c) for i, (s, m, c) in enumerate([(0.33, 5, 3), (0.33, 4, 3), (0.35, 4, 3), (0.35, 4, 5)])]


def _grid_sql() -> str:
    parts = [density_sql(f"g{g.run}", "flat", g.min_sim, g.min_samples, g.min_cluster_size) for g in GRID]
    labels = " UNION ALL ".join(f"SELECT {g.run} AS run, v.post_id, coalesce(sub, -1) AS topic FROM vectors v LEFT JOIN g{g.run} USING (post_id)" for g in GRID)
    names = " ".join(f"WHEN {g.run} THEN {g.min_cluster_size}" for g in GRID), " ".join(f"WHEN {g.run} THEN {g.min_samples}" for g in GRID)
    sims = " ".join(f"WHEN {g.run} THEN {g.min_sim}" for g in GRID)
    return f"""WITH RECURSIVE {FLAT}, {', '.join(parts)}, grid AS ({labels}), m AS ({metrics_sql('grid', 'run')})
SELECT CAST(CASE run {names[0]} END AS INTEGER) AS min_cluster_size, CAST(CASE run {names[1]} END AS INTEGER) AS min_samples,
  CAST(CASE run {sims} END AS DOUBLE) AS min_sim, * EXCLUDE (run) FROM m"""


@check("tuning_grid", _grid_sql())
def _(t: Tables):
    return tune(t.vectors(), GRID)


STABLE = [DensitySetting(0, 0.33, 5, 3), DensitySetting(1, 0.34, 5, 3), DensitySetting(2, 0.33, 4, 3)]


def _stability_sql() -> str:
    parts = [density_sql(f"g{s.run}", "flat", s.min_sim, s.min_samples, s.min_cluster_size) for s in STABLE]
    label = lambda r: f"SELECT v.post_id, coalesce(sub, -1) AS topic FROM vectors v LEFT JOIN g{r} USING (post_id)"
    mapped = MAPPED.replace("FROM runs r JOIN vectors v", "FROM runs r JOIN base v").replace("FROM vectors WHERE", "FROM base WHERE")
    votes = "SELECT post_id, 0 AS run, topic FROM base UNION ALL SELECT post_id, run, coalesce(base_topic, -1) FROM runs LEFT JOIN mapping USING (run, topic)"
    return f"""WITH RECURSIVE {FLAT}, {', '.join(parts)}, base AS MATERIALIZED ({label(0)}), run_a AS MATERIALIZED ({label(1)}), run_b AS MATERIALIZED ({label(2)}),
{mapped}, {consensus_sql(votes, 2)}"""


@check("stability_clusters", _stability_sql())
def _(t: Tables):
    return stability_cluster(t.vectors(), STABLE).select("post_id", "topic")


# Splits, groups and refinement.
@check(
    "split_topics",
    f"WITH {VECTORS} SELECT topic, count(*) AS posts, CAST(2 AS BIGINT) AS sides, true AS tighter FROM vectors WHERE topic <> -1 GROUP BY 1 HAVING count(*) >= 4",
)
def _(t: Tables):
    posts = t.vectors().where(F.col("topic") != -1)
    sides = materialize(split_topics(posts, posts.select("topic")), "sides")
    square = lambda v, c: F.aggregate(F.zip_with(v, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
    rows = sides.join(posts.select("post_id", "embedding"), "post_id")
    whole = rows.join(topic_centroids(rows).select("topic", "centroid"), "topic").groupBy("topic").agg(F.sum(square("embedding", "centroid")).alias("before"))
    halves = topic_centroids(rows, ["topic", "side"]).select("topic", "side", "centroid")
    after = rows.join(halves, ["topic", "side"]).groupBy("topic").agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("side").alias("sides"), F.sum(square("embedding", "centroid")).alias("after")
    )
    return after.join(whole, "topic").select("topic", "posts", "sides", (F.col("after") <= F.col("before")).alias("tighter"))


@check(
    "topic_groups",
    f"WITH {VECTORS} SELECT count(DISTINCT topic) AS topics, CAST(4 AS BIGINT) AS groups, CAST(0 AS INTEGER) AS first_group FROM vectors WHERE topic <> -1",
)
def _(t: Tables):
    rows = ward_groups(topic_centroids(t.vectors()), 4)
    return rows.agg(F.count_distinct("topic").alias("topics"), F.count_distinct("l1_id").alias("groups"), F.min("l1_id").alias("first_group"))


NATION_GROUPS = """sizes AS (SELECT c_nationkey AS topic, count(*) AS size FROM customer GROUP BY 1),
groups AS (SELECT n_nationkey AS topic, n_regionkey AS l1_id FROM nation),
top AS (SELECT * FROM sizes JOIN groups USING (topic) ORDER BY size DESC, topic LIMIT 6),
l1 AS (SELECT l1_id, CAST(sum(size) AS BIGINT) AS size FROM sizes JOIN groups USING (topic) GROUP BY 1)"""


def _nation_groups(t: Tables):
    sizes = topic_sizes(t.read("customer").select(F.col("c_nationkey").alias("topic")))
    return sizes, t.read("nation").select(F.col("n_nationkey").alias("topic"), F.col("n_regionkey").alias("l1_id"))


@check("group_sizes", f"WITH {NATION_GROUPS} SELECT * FROM l1")
def _(t: Tables):
    return group_sizes(*_nation_groups(t))


@check(
    "hierarchy_levels",
    f"""WITH {NATION_GROUPS} SELECT 'L1' AS level, l1_id, CAST(-1 AS INTEGER) AS l2_topic, size FROM (SELECT * FROM l1 ORDER BY size DESC, l1_id LIMIT 4)
        WHERE l1_id IN (SELECT l1_id FROM top) UNION ALL SELECT 'L2', l1_id, topic, size FROM top""",
)
def _(t: Tables):
    return hierarchy_levels(*_nation_groups(t), l1_limit=4, l2_limit=6).withColumn("l2_topic", F.coalesce("l2_topic", F.lit(-1)))


HIERARCHY = f"""{VECTOR_POSTS}, grouped AS (SELECT *, CAST(topic % 3 AS INTEGER) AS g FROM vector_posts WHERE topic <> -1),
{centroids_sql('grouped', 'l1_c', 'g')}, {centroids_sql('grouped', 'l2_c')},
ex1 AS (SELECT g, string_agg(left(text, 400), chr(10) || '---' || chr(10) ORDER BY r) AS ex FROM (
  SELECT p.g, text, row_number() OVER (PARTITION BY p.g ORDER BY list_cosine_similarity(embedding, centroid) DESC, post_id) AS r
  FROM grouped p JOIN l1_c USING (g)) WHERE r <= 30 GROUP BY 1),
ex2 AS (SELECT topic, string_agg(left(text, 400), chr(10) || '---' || chr(10) ORDER BY r) AS ex FROM (
  SELECT p.topic, text, row_number() OVER (PARTITION BY p.topic ORDER BY list_cosine_similarity(embedding, centroid) DESC, post_id) AS r
  FROM grouped p JOIN l2_c USING (topic)) WHERE r <= 30 GROUP BY 1),
texts AS (SELECT 'L1' AS level, g AS l1_id, CAST(-1 AS INTEGER) AS l2_topic, (SELECT count(*) FROM grouped x WHERE x.g = ex1.g) AS size, 'L1 ' || g AS known, ex FROM ex1
  UNION ALL SELECT 'L2', CAST(topic % 3 AS INTEGER), topic, (SELECT count(*) FROM grouped x WHERE x.topic = ex2.topic), 'Topic ' || topic, ex FROM ex2)"""


@check(
    "hierarchy_prompts",
    f"""WITH {HIERARCHY} SELECT level, l1_id, l2_topic, size, md5('You are labeling a ' || level || ' topic group.' || chr(10) || 'Existing label/keywords: ' || known || chr(10)
          || 'Provide a concise label (5-8 words) and a 1-2 sentence summary.' || chr(10) || 'Examples:' || chr(10) || ex || chr(10)
          || 'Return JSON with keys: label, summary.') AS hash FROM texts""",
)
def _(t: Tables):
    posts = t.vector_posts()
    sizes = topic_sizes(posts)
    levels = hierarchy_levels(sizes, sizes.select("topic", (F.col("topic") % 3).cast("int").alias("l1_id")))
    rows = hierarchy_prompts(posts, materialize(levels, "levels"))
    return rows.select("level", "l1_id", F.coalesce("l2_topic", F.lit(-1)).alias("l2_topic"), "size", F.md5("prompt").alias("hash"))


@check(
    "hierarchy_table",
    f"""WITH {VECTOR_POSTS}, s AS (SELECT topic, count(*) AS size FROM vector_posts WHERE topic <> -1 GROUP BY 1)
        SELECT 'L2' AS level, count(*) AS n, CAST(sum(size) AS BIGINT) AS posts, count(*) AS labelled FROM s
        UNION ALL SELECT 'L1', 4, CAST(sum(size) AS BIGINT), 4 FROM s""",
)
def _(t: Tables):
    rows = build_hierarchy(t.vector_posts(), t.vectors().select("post_id", "topic"), echo_model, l1_count=4)
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("posts"), F.count_if(F.col("label") != "").alias("labelled"))


MERGED = f"""{VECTOR_POSTS}, {centroids_sql('vector_posts')}, pairs AS (
  SELECT a.topic AS a, b.topic AS b, list_cosine_similarity(a.centroid, b.centroid) AS sim FROM centroids a JOIN centroids b ON a.topic < b.topic),
cand AS (SELECT * FROM pairs WHERE sim >= 0.1 ORDER BY sim DESC, a, b LIMIT 30), ok AS (SELECT a, b FROM cand WHERE (a + b) % 2 = 1),
e AS (SELECT a, b FROM ok UNION SELECT b, a FROM ok), reach(id, root) AS (SELECT DISTINCT topic, topic FROM centroids UNION SELECT e.b, r.root FROM reach r JOIN e ON e.a = r.id),
roots AS (SELECT id AS topic, min(root) AS root FROM reach GROUP BY 1),
renamed AS (SELECT v.post_id, v.embedding, coalesce(root, -1) AS root FROM vector_posts v LEFT JOIN roots USING (topic)),
ids AS (SELECT root, CAST(row_number() OVER (ORDER BY min(post_id)) - 1 AS INTEGER) AS topic FROM renamed WHERE root <> -1 GROUP BY 1),
final AS MATERIALIZED (SELECT post_id, embedding, coalesce(ids.topic, -1) AS topic FROM renamed LEFT JOIN ids USING (root))"""


def _odd_pairs(prompts):
    odd = (F.col("topic_a") + F.col("topic_b")) % 2 == 1
    return prompts.select("topic_a", "topic_b", odd.alias("merge"), F.lit("by parity").alias("reason"))


@check("refined_by_merges", f"WITH RECURSIVE {MERGED}, {assignment_sql('final')}")
def _(t: Tables):
    keep = lambda prompts: prompts.select("topic", F.lit("keep").alias("action"), F.lit("").alias("reason"))
    done = refine(t.vector_posts(), t.vectors().select("post_id", "topic"), keep, _odd_pairs, split_min_size=1, merge_similarity=0.1)
    return long_assignments(done.clusters, ["post_id", "topic"])


@check(
    "refined_by_splits",
    f"""WITH {VECTOR_POSTS}, s AS (SELECT topic, count(*) AS n FROM vector_posts WHERE topic <> -1 GROUP BY 1),
        asked AS (SELECT * FROM s WHERE n >= 4 ORDER BY n DESC, topic LIMIT 20)
        SELECT (SELECT count(*) FROM vector_posts) AS posts, (SELECT count(*) FROM s) + (SELECT count(*) FROM asked WHERE topic % 2 = 0) AS topics,
          (SELECT count(*) FROM vector_posts WHERE topic = -1) AS noise""",
)
def _(t: Tables):
    even = lambda prompts: prompts.select("topic", F.when(F.col("topic") % 2 == 0, "Split").otherwise("keep").alias("action"), F.lit("").alias("reason"))
    done = refine(t.vector_posts(), t.vectors().select("post_id", "topic"), even, _odd_pairs, split_min_size=4, merge_similarity=0.999)
    rows = done.clusters
    return rows.agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_distinct(F.when(F.col("topic") != -1, F.col("topic"))).alias("topics"),
        F.count_if(F.col("topic") == -1).alias("noise"),
    )


@check(
    "refinement_report",
    f"""WITH RECURSIVE {MERGED}, s AS (SELECT topic, count(*) AS n FROM vector_posts WHERE topic <> -1 GROUP BY 1),
        asked AS (SELECT * FROM s WHERE n >= 4 ORDER BY n DESC, topic LIMIT 20)
        SELECT 'split_check' AS action, 'keep' AS decision, count(*) AS n FROM asked
        UNION ALL SELECT 'merge_apply', 'none', 1 UNION ALL SELECT 'merge_check', 'true', (SELECT count(*) - count(DISTINCT root) FROM roots)""",
)
def _(t: Tables):
    keep = lambda prompts: prompts.select("topic", F.lit("keep").alias("action"), F.lit("").alias("reason"))
    done = refine(t.vector_posts(), t.vectors().select("post_id", "topic"), keep, _odd_pairs, split_min_size=4, merge_similarity=0.1)
    # Refused pairs depend on the order of questions; approved ones that were asked are exactly the links of a spanning forest.
    rows = done.report.where((F.col("action") != "merge_check") | (F.col("decision") == "true"))
    return rows.groupBy("action", F.coalesce("decision", F.lit("none")).alias("decision")).agg(F.count(F.lit(1)).alias("n"))


# Vectors from text, and fewer dimensions.
@check(
    "hashed_embeddings",
    r"""SELECT count(*) AS posts, CAST(64 AS INTEGER) AS dims, count(*) FILTER (regexp_matches(text, '[\p{L}\p{N}]')) AS unit_length, CAST(0 AS BIGINT) AS disagreeing FROM documents""",
)
def _(t: Tables):
    rows = materialize(embed_hashed(text_table(t.text_posts()), 64), "hashed")
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    per_text = rows.groupBy(F.xxhash64("text")).agg(F.count_distinct("embedding").alias("kinds"))
    shape = rows.agg(
        F.count(F.lit(1)).alias("posts"), F.max(F.size("embedding")).alias("dims"), F.count_if(F.abs(length - 1) < 1e-4).alias("unit_length")
    )
    return shape.join(F.broadcast(per_text.agg(F.count_if(F.col("kinds") > 1).alias("disagreeing"))))


@check("reduced_dimensions", "SELECT count(*) AS posts, CAST(5 AS INTEGER) AS dims, true AS falling FROM embeddings")
def _(t: Tables):
    model = fit_components(t.vectors(), 5)
    share = model.explainedVariance.toArray().tolist()
    rows = reduce_dimensions(t.vectors(), model)
    return rows.agg(
        F.count(F.lit(1)).alias("posts"), F.max(F.size("embedding")).alias("dims"), F.lit(share == sorted(share, reverse=True)).alias("falling")
    )
