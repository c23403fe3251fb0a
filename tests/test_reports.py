"""Growth, examples, ranking and cost estimates on literal inputs."""

import datetime as dt

from pyspark.sql import functions as F

from topicloom.operators.embed import embed_hashed, embedding_costs, text_table
from topicloom.operators.examples import central_examples, scored_examples
from topicloom.operators.growth import growth_counts, monthly_series, ranked_growth, summary, topic_growth
from topicloom.operators.ranking import next_topic_id, sample_exact, top_per_group
from topicloom.plans.labelling import keyword_ideas
from topicloom.plans.review import growth_review


def day(*parts):
    return dt.datetime(*parts)


def test_growth_windows(spark):
    dates = [day(2024, 1, 1), day(2024, 1, 5), day(2024, 2, 1), day(2023, 10, 1), day(2023, 10, 5), None]
    df = spark.createDataFrame([(1, d) for d in dates] + [(None, day(2024, 1, 2))], "topic int, date timestamp_ntz")
    row = topic_growth(df, 60).collect()
    assert [tuple(r) for r in row] == [(1, 3, 1, 2, 2.0)]


def test_growth_edges(spark):
    # The recent window holds both of its ends; the prior one only its first.
    rows = [(1, day(2024, 1, 31)), (1, day(2024, 1, 21)), (2, day(2024, 1, 20, 23)), (2, day(2024, 1, 11)), (3, day(2024, 1, 10, 23))]
    got = {r["topic"]: (r["recent_count"], r["prior_count"], r["growth_pct"]) for r in topic_growth(spark.createDataFrame(rows, "topic int, date timestamp_ntz"), 10).collect()}
    assert got == {1: (2, 0, None), 2: (0, 2, -1.0)}


def test_growth_of_nothing(spark):
    empty = spark.createDataFrame([], "topic int, date timestamp_ntz")
    out = topic_growth(empty, 60)
    assert out.columns == ["topic", "recent_count", "prior_count", "growth_abs", "growth_pct"] and out.count() == 0


def test_growth_does_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("cast(id % 7 as int) as topic", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 100 as int)) as date")
    a, b = (sorted(map(tuple, ranked_growth(growth_counts(df.repartition(n), [10, 30]), 3).collect())) for n in (1, 8))
    assert a == b and len(a) == 6


def test_growth_review_labels(spark):
    posts = spark.createDataFrame([(i, 1700000000 + i * 86400) for i in range(10)], "post_id long, date long")
    clusters = spark.createDataFrame([(i, i % 3 - 1) for i in range(10)], "post_id long, topic int")
    labels = spark.createDataFrame([(0, "zero")], "topic int, label string")
    rows = growth_review(posts, clusters, labels, windows=[4]).collect()
    assert {(r["topic"], r["label"]) for r in rows} == {(0, "zero"), (1, "L3 1")}


def test_summary_of_absent_columns(spark):
    assert tuple(summary(spark.range(3)).first()) == (3, None, None, None)
    assert summary(spark.createDataFrame([(None,)], "value double")).first()["total_value"] == 0


def test_monthly_series_drops_missing_parents(spark):
    rows = [(1, 2, day(2024, 1, 31)), (1, 2, day(2024, 1, 1)), (1, None, day(2024, 1, 1)), (1, 2, None)]
    got = monthly_series(spark.createDataFrame(rows, "topic int, parent_topic int, date timestamp_ntz")).collect()
    assert [tuple(r) for r in got] == [(1, 2, day(2024, 1, 1), 2)]


def test_top_per_group_with_a_hot_group(spark):
    df = spark.range(20000).selectExpr("if(id % 3 = 0, 0, cast(id % 50 as int)) as g", "id as post_id", "(id * 7919) % 1000 as score")
    got = sorted((r["g"], r["rank"], r["post_id"]) for r in top_per_group(df, ["g"], [F.desc("score"), F.asc("post_id")], 5).collect())
    want = []
    rows = [(0 if i % 3 == 0 else i % 50, -((i * 7919) % 1000), i) for i in range(20000)]
    for g in sorted({r[0] for r in rows}):
        want += [(g, k + 1, r[2]) for k, r in enumerate(sorted(r for r in rows if r[0] == g)[:5])]
    assert got == sorted(want)


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(3000).withColumnRenamed("id", "post_id")
    small = {r[0] for r in sample_exact(df, 500, 7).collect()}
    assert {r[0] for r in sample_exact(df.repartition(7), 500, 7).collect()} == small and len(small) == 500
    assert sample_exact(df, 5000, 7).count() == 3000
    assert {r[0] for r in sample_exact(df, 500, 8).collect()} != small


def test_next_id(spark):
    t = lambda xs: spark.createDataFrame([(x,) for x in xs], "topic int")
    assert next_topic_id(t([-1])).first()[0] == 1 and next_topic_id(t([-1, 4])).first()[0] == 5
    assert next_topic_id(t([-1]), empty=0).first()[0] == 0


def test_examples_by_score(spark):
    rows = [(1, 1, "A", "Body A", "5"), (2, 1, "B", "Body B", "10")]
    df = spark.createDataFrame(rows, "post_id int, topic int, title string, body string, score string")
    assert scored_examples(df, 1, 50).first()["examples"] == ["B - Body B"]
    # Posts without text are dropped after the cut, so fewer can come back.
    more = df.union(spark.createDataFrame([(3, 1, " ", None, "99")], df.schema))
    assert scored_examples(more, 2, 3).first()["examples"] == ["B -"]


def test_examples_by_centroid_tie(spark):
    df = spark.createDataFrame([(1, 1, "A", [1.0, 0.0]), (2, 1, "B", [0.0, 1.0])], "post_id int, topic int, text string, embedding array<double>")
    assert central_examples(df, 1, 10).first()["examples"] == ["A"]


def test_keyword_ideas(spark):
    rows = [(i, 5, i % 2, f"t{i}", "", i) for i in range(4)] + [(9, -1, 0, "n", "", 1), (10, 6, 0, "x", "", 1)]
    df = spark.createDataFrame(rows, "post_id int, topic int, parent_topic int, title string, body string, score int")
    got = keyword_ideas(df, lambda prompts: ["one, two"] * len(prompts), min_size=2, sample_size=2).collect()
    assert [(r["l2_topic"], r["l3_topic"], r["l2_label"], r["keywords"], r["post_count"]) for r in got] == [(0, 5, "L2 0", "one; two", 4)]


def test_costs(spark):
    df = spark.createDataFrame([(1, "One", "Alpha"), (2, "Two", "Beta")], "post_id int, title string, body string")
    rows = embedding_costs(text_table(df), 2, 7, 10.0, 1000.0, 1.0).collect()
    assert [r["option"] for r in rows] == ["local", "openai"]
    assert all(isinstance(r["est_time_hours"], float) and isinstance(r["est_cost_usd"], float) for r in rows)
    assert rows[0]["est_total_tokens"] == 5
    assert embedding_costs(text_table(df)).first()["est_time_hours"] is None


def test_hashed_vectors(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "b a"), (3, "c"), (4, "...")], "post_id int, text string")
    got = {r["post_id"]: r["embedding"] for r in embed_hashed(df, 16, inverse_frequency=False).collect()}
    assert got[1] == got[2] and abs(sum(x * x for x in got[1]) - 1) < 1e-6 and not any(got[4])
