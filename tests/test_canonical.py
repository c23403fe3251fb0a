"""Contract, scans, validation and export on small literal inputs."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from topicloom.contract import POST_CONTRACT, VALUE_CONTRACT, DataContract
from topicloom.functions.dates import coerce_dates, parse_date, spark_pattern
from topicloom.operators.quality import align_columns, canonical, enforce, missing_columns, require_columns, stringify_extras, validation_metrics, violations
from topicloom.plans.canonical import canonicalize, export_canonical
from topicloom.sources.readers import read_labels, read_raw_folder, read_tabular
from topicloom.sources.sinks import append_new, write_csv
from topicloom.streaming.jobs import check_stream, stream_canonical, stream_metrics


def lines(path, rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n", encoding="utf-8")
    return str(path)


def test_csv_to_canonical(spark, tmp_path):
    path = lines(tmp_path / "till.csv", ["Amount,Date", "2.5,2019-07-30", "NA,2019-06-01", "4,2020-02-29"])
    for whole_file in (True, False):
        rows = canonicalize(spark, path, VALUE_CONTRACT) if whole_file else require_columns(canonical(read_tabular(spark, path, multi_line=False), VALUE_CONTRACT), VALUE_CONTRACT)
        assert sorted(rows.columns) == ["date", "value"]
        assert rows.agg(F.sum("value"), F.min("date"), F.max("date")).first()[:] == (6.5, dt.datetime(2019, 6, 1), dt.datetime(2020, 2, 29))


def test_jsonl_to_canonical(spark, tmp_path):
    names = {new: old for old, new in POST_CONTRACT.column_mapping.items()}
    post = {names.get(c, c): f"value of {c}" for c in POST_CONTRACT.required_columns} | {names["date"]: 1234567890, "extra": [1]}
    rows = canonicalize(spark, lines(tmp_path / "p.jsonl", [post]), POST_CONTRACT)
    assert set(POST_CONTRACT.required_columns) <= set(rows.columns)
    row = rows.first()
    assert (row["post_id"], row["body"]) == ("value of post_id", "value of body")
    assert row["date"] == dt.datetime(2009, 2, 13, 23, 31, 30)


def test_missing_columns_are_named(spark, tmp_path):
    path = lines(tmp_path / "p.jsonl", [{"id": "a"}])
    with pytest.raises(ValueError, match="Missing required columns: \\['date', 'subreddit'"):
        canonicalize(spark, path, POST_CONTRACT)
    assert missing_columns(["a"], ["b", "a", "c"]) == ["b", "c"]
    with pytest.raises(ValueError):
        require_columns(spark.range(1), VALUE_CONTRACT)


def test_unknown_suffix(spark):
    with pytest.raises(ValueError, match="Unsupported file type: .xlsx"):
        read_tabular(spark, "/nowhere/data.XLSX")


def test_csv_null_spellings_and_types(spark, tmp_path):
    path = lines(tmp_path / "x.CSV", ["a,b,c,d", "1,NA,x,0012", "2,2.5,null,0013", ",nan,y,"])
    rows = read_tabular(spark, path)
    assert [f.dataType.simpleString() for f in rows.schema] == ["bigint", "double", "string", "bigint"]
    assert [tuple(r) for r in rows.orderBy(F.col("a").asc_nulls_last()).collect()] == [(1, None, "x", 12), (2, 2.5, None, 13), (None, None, "y", None)]


def test_padded_text_is_no_missing_value(spark, tmp_path):
    path = lines(tmp_path / "x.csv", ["n,t", '1," "', "2, NA ", "3,NA", '4,""', " 5 ,x"])
    got = {r["n"]: r["t"] for r in read_tabular(spark, path, "n long, t string").collect()}
    assert got == {1: " ", 2: " NA ", 3: None, 4: None, 5: "x"}


def test_large_plain_csv_is_split(spark, tmp_path):
    path = lines(tmp_path / "x.csv", ["n,t", *(f"{i},{'word ' * 20}" for i in range(4000))])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        assert read_tabular(spark, path, "n long, t string", multi_line=False).rdd.getNumPartitions() > 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert read_tabular(spark, path, "n long, t string", multi_line=False).agg(F.sum("n")).first()[0] == sum(range(4000))


def test_csv_in_one_file_keeps_the_order(spark, tmp_path):
    write_csv(spark.range(50).repartition(5), str(tmp_path / "out"), order=["id"], files=1)
    (part,) = (tmp_path / "out").glob("part-*")
    assert part.read_text().split() == ["id", *map(str, range(50))]


def test_label_csv_with_newlines(spark, tmp_path):
    df = spark.createDataFrame([(1, 'two\nlines, "quoted"'), (2, " padded ")], "topic long, summary string")
    write_csv(df, str(tmp_path / "labels.csv"))
    back = read_labels(spark, str(tmp_path / "labels.csv"), "topic long, summary string")
    assert sorted(map(tuple, back.collect())) == [(1, 'two\nlines, "quoted"'), (2, " padded ")]


def test_raw_folder_prefers_jsonl_and_keeps_lineage(spark, tmp_path):
    lines(tmp_path / "b.jsonl", [{"id": "b"}])
    lines(tmp_path / "a.jsonl", [{"id": "a"}])
    lines(tmp_path / "c.json", [{"id": "c"}])
    rows = read_raw_folder(spark, str(tmp_path))
    assert sorted((r["id"], r["source_file"]) for r in rows.collect()) == [("a", "a.jsonl"), ("b", "b.jsonl")]
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(FileNotFoundError):
        read_raw_folder(spark, str(empty))


def test_mixed_json_column_becomes_text(spark, tmp_path):
    rows = [{"key": 8, "when": 60, "tags": {"k": [1]}}, {"key": 9, "when": 120, "tags": True}]
    contract = DataContract(("post_id", "date"), {"key": "post_id", "when": "date"}, date_unit="s")
    export_canonical(spark, lines(tmp_path / "m.jsonl", rows), str(tmp_path / "out"), contract)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["post_id"], r["tags"].lower().replace(" ", ""), r["date"].minute) for r in back.collect()) == [(8, '{"k":[1]}', 1), (9, "true", 2)]


def test_export_writes_nothing_when_a_limit_is_broken(spark, tmp_path):
    path = lines(tmp_path / "m.jsonl", [{"id": "a1", "created_utc": "soon"}, {"id": None, "created_utc": "1700000000"}])
    contract = DataContract(("post_id", "date"), {"id": "post_id", "created_utc": "date"}, date_unit="s")
    with pytest.raises(ValueError, match="Null counts exceed limit") as error:
        export_canonical(spark, path, str(tmp_path / "out"), contract)
    assert "Invalid date count exceeds limit (max 0): 1" in str(error.value)
    assert not (tmp_path / "out").exists()


DATED = DataContract(("post_id", "date"))


def test_validation_metrics(spark):
    when = [dt.datetime(2021, 3, d) for d in (1, 2)] + [None] * 3
    df = spark.createDataFrame([(None if i == 4 else f"p{i}", d) for i, d in enumerate(when)], "post_id string, date timestamp_ntz")
    got = {(r["metric"], r["column_name"]): r["value"] for r in validation_metrics(df, DATED).collect()}
    assert got == {("total_rows", ""): 5, ("null_count", "post_id"): 1, ("null_count", "date"): 3, ("invalid_dates", "date"): 3}
    loose = DataContract(("post_id", "date"), max_null_count=3, max_invalid_date_count=2)
    (message,) = [r["message"] for r in violations(validation_metrics(df, loose), loose).collect()]
    assert message == "Invalid date count exceeds limit (max 2): 3"
    with pytest.raises(ValueError, match="Null counts exceed limit"):
        enforce(validation_metrics(df, DATED), DATED)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    got = {r["metric"]: r["value"] for r in validation_metrics(df, DataContract(("v",))).collect()}
    assert got["null_count"] == 2


def test_parse_date_shapes(spark):
    df = spark.createDataFrame([("86400",), ("x",), (None,), ("99999999999999",)], "date string")
    got = [r[0] for r in parse_date(df, "date", date_unit="s").collect()]
    assert got == [dt.datetime(1970, 1, 2), None, None, None]
    text = spark.createDataFrame([("31/12/2023",), ("2023-12-31",)], "date string")
    assert [r[0] for r in parse_date(text, "date", date_format="%d/%m/%Y").collect()] == [dt.datetime(2023, 12, 31), None]
    assert [r[0] for r in parse_date(text, "date").collect()] == [None, dt.datetime(2023, 12, 31)]
    with pytest.raises(ValueError):
        parse_date(spark.range(1).withColumnRenamed("id", "date"), "date")
    assert parse_date(spark.range(1), "date").columns == ["id"]
    assert spark_pattern("%Y-%m-%dT%H:%M") == "yyyy-MM-dd'T'HH:mm"


def test_coerce_dates_guesses_the_unit(spark):
    seconds = spark.createDataFrame([(1234567890,), (951782400,), (None,)], "date long")
    assert {r[0].year for r in coerce_dates(seconds, "date").collect() if r[0]} == {2009, 2000}
    millis = spark.createDataFrame([(1234567890123,), (5,)], "date long")
    assert sorted(r[0] for r in coerce_dates(millis, "date").collect()) == [dt.datetime(1970, 1, 1, 0, 0, 0, 5000), dt.datetime(2009, 2, 13, 23, 31, 30, 123000)]


def test_stringify_and_align(spark):
    df = spark.sql("select 1L as post_id, true as flag, double('nan') as gap, array(1, 2) as xs, named_struct('k', 1) as s, null as nothing")
    row = stringify_extras(df, DataContract(("post_id",))).first()
    assert tuple(row) == (1, "true", None, "[1,2]", '{"k":1}', None)
    whole = align_columns([spark.sql("select 1 as a, null as b"), spark.sql("select 2 as a, 'x' as c")])
    assert sorted(map(tuple, whole.collect())) == [(1, None, None), (2, None, "x")]
    assert whole.schema["b"].dataType.simpleString() == "string"


def test_append_with_resume(spark, tmp_path):
    path = str(tmp_path / "labels")
    first = spark.createDataFrame([(1, 10, "local"), (2, 10, "local")], "topic int, sample_size int, backend string")
    append_new(first, path)
    append_new(first.union(spark.createDataFrame([(3, 10, "local")], first.schema)), path)
    assert sorted(r["topic"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    append_new(first, path, resume=False)
    assert spark.read.parquet(path).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines(raw / "1.json", [{"k": 1, "at": "0"}])
    lines(raw / "2.json", [{"k": 2, "at": "3600"}, {"k": 3, "at": "noon"}])
    contract = DataContract(("post_id", "date"), {"k": "post_id", "at": "date"}, date_unit="s")
    schema = "k long, at string, title string"
    with pytest.raises(ValueError, match="Invalid date count exceeds limit"):
        stream_canonical(spark, str(raw), schema, contract, str(tmp_path / "out"), str(tmp_path / "cp1"), files_per_trigger=1)
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["post_id"] for r in rows.collect()) == [1, 2, 3]
    run = lambda: stream_metrics(spark, str(raw), schema, contract, str(tmp_path / "m"), str(tmp_path / "cp2"), files_per_trigger=1)
    batch = sorted(map(tuple, validation_metrics(rows, contract).collect()))
    assert sorted(map(tuple, run().collect())) == batch
    # A second start finds nothing new and changes nothing; a new file is added to the totals.
    assert sorted(map(tuple, run().collect())) == batch
    with pytest.raises(ValueError, match="Invalid date"):
        check_stream(spark, str(tmp_path / "m"), contract)
    lines(raw / "3.json", [{"k": 4, "at": "7200"}])
    assert {r["metric"]: r["value"] for r in run().collect()}["total_rows"] == 4


def test_stream_export_enforces_the_contract(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    lines(raw / "1.json", [{"k": 1, "at": "0"}, {"k": 2, "at": "60"}])
    schema, loose = "k long, at string", {"max_null_count": 9, "max_invalid_date_count": 9}
    names = {"k": "post_id", "at": "date"}
    run = lambda required, n: stream_canonical(
        spark, str(raw), schema, DataContract(required, names, date_unit="s", **loose), str(tmp_path / f"out{n}"), str(tmp_path / f"cp{n}")
    )
    assert {(r["metric"], r["column_name"]): r["value"] for r in run(("post_id", "date"), 1).collect()}["total_rows", ""] == 2
    with pytest.raises(ValueError, match="Missing required columns: author"):
        run(("post_id", "author"), 2)


def test_absent_columns_count_as_null(spark):
    got = validation_metrics(spark.range(3), DataContract(("id", "author")), absent_is_null=True).collect()
    assert {(r["metric"], r["column_name"]): r["value"] for r in got} == {
        ("total_rows", ""): 3, ("null_count", "id"): 0, ("null_count", "author"): 3, ("missing_column", "author"): 1, ("invalid_dates", "date"): 0,
    }
