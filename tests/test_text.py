"""Text, reply and prompt expressions on literal inputs."""

import json

import pytest
from pyspark.sql import functions as F

from topicloom.functions import text as X
from topicloom.operators.labels import last_labels


def one(spark, expression, **values):
    names = list(values)
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(values.values())], schema).select(expression(*[F.col(n) for n in names]).alias("x")).first()["x"]


FENCED = '```json\n{"label": "Fährplan Änderungen", "summary": "Züge und Busse"}\n```'


@pytest.mark.parametrize(
    "reply, key, want",
    [
        (FENCED, "label", "Fährplan Änderungen"),
        (FENCED + "\n", "summary", "Züge und Busse"),
        (" \n plain words \t", "label", "plain words"),
        (chr(39) * 3 + 'json ' + json.dumps({"label": 'a "b"'}) + "\n", "label", 'a "b"'),
        ('{"label": null}', "label", ""),
        ('{"summary": 1}', "label", ""),
        ("{label: none", "label", "{label: none"),
        ('{"label": [1, 2]}', "label", "[1,2]"),
        ("```\ninside\n```", "label", "inside"),
        ("JSON rest", "label", "rest"),
        ("", "label", ""),
        (None, "label", ""),
        ('{"n": 5}', None, '{"n": 5}'),
    ],
)
def test_reply_value(spark, reply, key, want):
    assert one(spark, lambda r: X.reply_value(r, key), r=reply) == want


@pytest.mark.parametrize("text, want", [('```json\n"Ponts et chaussées"\n```\n', "Ponts et chaussées"), ("\"'x' ", "x"), ("json: y", ": y"), ("```json z```", "z"), ("as is", "as is")])
def test_clean_label(spark, text, want):
    assert one(spark, X.clean_label, t=text) == want


def test_parse_keywords(spark):
    listed = '{"keywords": [" puente viejo", "", "río, ancho", null]}'
    for reply in (listed, listed + "\n", " " + listed, "```json\n" + listed + "\n```", "```\n" + listed + "```\n"):
        assert one(spark, X.parse_keywords, t=reply) == ["puente viejo", "río, ancho"]
    assert one(spark, X.parse_keywords, t=" uno,dos ,, tres\n") == ["uno", "dos", "tres"]
    for none in ('{"other": ["a", "b"]}', '{"keywords": "a, b"}', '{"keywords": ["a", "b"', "", None):
        assert one(spark, X.parse_keywords, t=none) == []
    many = ",".join(str(n) for n in range(20))
    assert len(one(spark, X.parse_keywords, t=many)) == 12
    assert one(spark, lambda t: X.parse_keywords(t, 3), t=many) == ["0", "1", "2"]


def test_parse_anchors(spark):
    two = {"anchors": [{"label": "Nordufer", "keywords": ["steg", "boot"]}, {"label": "Südufer"}]}
    text = json.dumps(two, ensure_ascii=False)
    label = lambda t: [a["label"] for a in one(spark, X.parse_anchors, t=t)]
    for reply in (text, f"```json\n{text}\n```", json.dumps({"raw": f"```json\n{text}\n```"}), f"Here it is: {text} Done."):
        assert label(reply) == ["Nordufer", "Südufer"]
    for bad in ("{", '{"anchors": 3}', "nothing", '{"raw": "nothing"}'):
        assert label(bad) == []


def test_excerpt_limits(spark):
    cut = lambda t, b: X.make_excerpt(t, b, 10)
    assert one(spark, cut, t=" ab ", b="  ") == "ab"
    assert one(spark, cut, t="abcdef", b="x") == "abcdef - x"
    assert one(spark, cut, t="abcdefgh", b="xyz") == "abcdefgh -..."
    assert one(spark, cut, t=None, b=None) == ""


def test_permalink(spark):
    assert one(spark, X.build_permalink, p=None) == ""
    assert one(spark, X.build_permalink, p="https://a/b") == "https://a/b"
    assert one(spark, X.build_permalink, p="/r/x") == "https://www.reddit.com/r/x"


def test_build_text_and_prompts(spark):
    assert one(spark, X.build_text, t="T", b=None) == "T\n\n"
    prompt = spark.createDataFrame([(41, ["erster Beitrag", "zweiter"])], "topic int, ex array<string>").select(
        X.fill_prompt(X.TOPIC_PROMPT, topic=F.col("topic"), examples=X.join_examples(F.col("ex"))).alias("p")
    ).first()["p"]
    assert "Topic id: 41\n" in prompt and "erster Beitrag\n---\nzweiter\n" in prompt


def test_reply_fallback_and_decisions(spark):
    assert one(spark, X.reply_label, r="x" * 200) == "x" * 120
    assert one(spark, X.reply_summary, r="x" * 200) == "x" * 200
    assert one(spark, X.reply_label, r='{"label": "L"}') == "L"
    assert one(spark, X.reply_or_raw, r="hi") == '{"raw":"hi"}'
    assert one(spark, X.split_decision, a="SPLIT") == "split"
    assert one(spark, X.split_decision, a=None) == "keep"
    assert [one(spark, X.merge_decision, m=m) for m in ("true", "False", "yes", None)] == [True, False, False, False]
    assert one(spark, X.numeric_score, s="n/a") == 0.0 and one(spark, X.numeric_score, s="2.5") == 2.5


def test_last_label_wins_and_missing_is_skipped(spark):
    rows = spark.createDataFrame([(1, 0, "A"), (1, 1, '"B"'), (1, 2, None), (2, 3, ""), (None, 4, "Z")], "topic int, no int, label string")
    assert [tuple(r) for r in last_labels(rows, "no").collect()] == [(1, "B")]
