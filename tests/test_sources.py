import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import types as T

from reviewsieve.plans import catalog
from reviewsieve.sources import (
    RAW_REVIEW_SCHEMA,
    append_clean,
    csv_records,
    detect_file_format,
    json_records,
    read_clean,
    read_csv,
    read_json_document,
    read_jsonl,
    read_reviews,
    read_reviews_stream,
    read_uploaded_data,
    save_dataframe,
    with_ingest_seq,
)

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("t", T.StringType())])


def put(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content, encoding="utf-8")
    return str(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_formats():
    assert detect_file_format("/x/Reviews.JSONL") == "jsonl"
    assert detect_file_format("/x/r.csv") == "csv"
    with pytest.raises(ValueError, match="jsonl"):
        detect_file_format("/x/r.xlsx")


def test_jsonl_skips_blank_lines(spark, tmp_path):
    path = put(tmp_path, "r.jsonl", '{"a": 1, "t": "x"}\n\n   \n{"a": 2}\n')
    assert rows(read_jsonl(spark, path, SCHEMA)) == [(1, "x"), (2, None)]
    assert {r.a for r in read_reviews(spark, path).collect()} == {1, 2}


@pytest.mark.parametrize("bad", ["{bad", "[1]", '"x"', '[{"a": 2}, {"a": 3}]', '{"a": 1} {"a": 2}', '{"a": "no number"}', '{"a": 1} rubbish'])
def test_strict_jsonl_fails_on_bad_lines(spark, tmp_path, bad):
    path = put(tmp_path, "bad.jsonl", '{"a": 1, "t": "x"}\n' + bad + "\n")
    with pytest.raises(PySparkException, match="Bad JSON record in .*bad.jsonl"):
        read_jsonl(spark, path, SCHEMA).collect()
    with pytest.raises(PySparkException, match="Bad JSON record"):
        read_jsonl(spark, path, SCHEMA).count()
    if "no number" not in bad:
        with pytest.raises(PySparkException, match="Bad JSON record"):
            read_jsonl(spark, path).collect()
    dropped = Observation()
    assert rows(read_jsonl(spark, path, SCHEMA, strict=False, dropped=dropped)) == [(1, "x")]
    assert dropped.get == {"dropped": 1}


def test_jsonl_without_any_object(spark, tmp_path):
    with pytest.raises(ValueError):
        read_jsonl(spark, put(tmp_path, "none.jsonl", "nope\n"))


@pytest.mark.parametrize(
    "content, want",
    [
        ('[{"a": 1},\n {"a": 2}]', [(1,), (2,)]),
        ('{"reviews": [\n{"a": 1}, {"a": 2}]}', [(1,), (2,)]),
        ('{"a": 1}', [(1,)]),
        ('[{"images": [{"u": "x"}]}]', [([("x",)],)]),
    ],
)
def test_json_documents(spark, tmp_path, content, want):
    path = put(tmp_path, "d.json", content)
    got = [tuple(r) for r in read_json_document(spark, path).collect()]
    assert json.dumps(sorted(got)) == json.dumps(want)


def test_object_with_two_lists_is_one_row(spark, tmp_path):
    path = put(tmp_path, "d.json", '{"x": [{"a": 1}], "y": [{"b": 2}]}')
    assert read_json_document(spark, path).count() == 1
    path = put(tmp_path, "e.json", '{"tags": ["p", "q"], "a": 1}')
    assert read_json_document(spark, path).count() == 1


def test_documents_of_both_kinds_and_schema(spark, tmp_path):
    put(tmp_path, "d1.json", '[{"a": 1, "t": "x"}]')
    put(tmp_path, "d2.json", '{"reviews": [{"a": 2, "t": "y"}, {"a": 3}]}')
    got = read_json_document(spark, str(tmp_path), SCHEMA)
    assert rows(got) == [(1, "x"), (2, "y"), (3, None)]


@pytest.mark.parametrize("content", ["5", '"text"', "[1, 2]"])
def test_other_roots_fail(spark, tmp_path, content):
    with pytest.raises(Exception, match="JSON"):
        read_json_document(spark, put(tmp_path, "s.json", content)).collect()


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = put(tmp_path, "r.csv", 'rating,text\n5,"two\nlines, ""quoted"""\n,plain\n')
    got = [tuple(r) for r in read_csv(spark, path).collect()]
    assert sorted(got, key=str) == sorted([("5", 'two\nlines, "quoted"'), (None, "plain")], key=str)


def test_upload(spark, tmp_path):
    lines = put(tmp_path, "lines.json", '{"a": 1}\n{"a": 2}\n')
    document = put(tmp_path, "doc.json", '[{"a": 1}, {"a": 2}]')
    pretty = put(tmp_path, "pretty.json", '{\n"reviews": [\n{"a": 1},\n{"a": 2}\n]\n}')
    single = put(tmp_path, "single.json", '{"reviews": [{"a": 1}, {"a": 2}]}')
    for path in (lines, document, pretty, single):
        assert rows(read_uploaded_data(spark, path).select("a")) == [(1,), (2,)]
    assert rows(read_uploaded_data(spark, lines, layout="lines")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no rows"):
        read_uploaded_data(spark, put(tmp_path, "empty.csv", "a,t\n"))
    with pytest.raises(ValueError, match="layout"):
        read_uploaded_data(spark, lines, layout="other")


@pytest.mark.parametrize("name", ["out.csv", "out.json", "out.jsonl"])
def test_save_and_read_back(spark, tmp_path, name):
    df = spark.createDataFrame([(1, '  "a",\nb '), (2, "é日")], SCHEMA)
    path = f"{tmp_path}/{name}"
    save_dataframe(df, path)
    back = read_uploaded_data(spark, path, SCHEMA)
    assert rows(back) == rows(df)
    save_dataframe(df.limit(1), f"{tmp_path}/other", "jsonl")
    assert spark.read.schema(SCHEMA).json(f"{tmp_path}/other").count() == 1
    with pytest.raises(ValueError):
        save_dataframe(df, f"{tmp_path}/x.xlsx")


def test_append_clean_replaces_only_its_batch(spark, tmp_path):
    out = f"{tmp_path}/clean"
    df = spark.createDataFrame([(1577836800000, "é", None)], "timestamp long, text string, n int")
    append_clean(df, out, "r1", 0)
    append_clean(df, out, "r1", 1)
    append_clean(df, out, "r1", 1)
    append_clean(df, out, "r2", 0)
    schema = T.StructType.fromDDL("timestamp string, text string, n int")
    assert read_clean(spark, out, schema, "r1").count() == 2
    assert read_clean(spark, out, schema).count() == 3
    written = spark.read.text(f"{out}/run_id=r1/batch_id=0").first().value
    assert json.loads(written) == {"timestamp": "2020-01-01T00:00:00.000", "text": "é", "n": None}
    assert "é" in written


def test_ingest_order_follows_files_and_lines(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for f in range(3):
        put(folder, f"part{f}.jsonl", "".join(f'{{"a": {f * 100 + i}}}\n' for i in range(50 - f)))
    df = with_ingest_seq(spark.read.schema(SCHEMA).json(str(folder)))
    got = [r.a for r in df.orderBy("ingest_seq").collect()]
    assert got == [f * 100 + i for f in range(3) for i in range(50 - f)]
    assert df.select("ingest_seq").distinct().count() == len(got)


def test_raw_schema_keeps_bad_ratings_and_images(spark, tmp_path):
    path = put(
        tmp_path,
        "raw.jsonl",
        '{"rating": true, "images": []}\n{"rating": 5.0, "images": [{"large": "u"}]}\n{"rating": "x"}\n',
    )
    got = read_jsonl(spark, path, RAW_REVIEW_SCHEMA).collect()
    assert sorted(r.rating for r in got) == ["5.0", "true", "x"]
    assert [r.images for r in got if r.rating == "5.0"] == [[{"large": "u"}]]


def test_layout_is_taken_file_by_file(spark, tmp_path):
    """Lines, one-line parts, arrays and different wrappers side by side; nothing is lost."""
    folder = tmp_path / "mixed.json"
    folder.mkdir()
    put(folder, "lines.json", '{"a": 1}\n{"a": 2}\n\n{"a": 3}\n')
    put(folder, "one.json", '{"a": 4}\n')
    put(folder, "array.json", '[{"a": 5},\n {"a": 6}]')
    put(folder, "wrapped.json", '{\n"items": [{"a": 7}, {"a": 8}], "n": 1}')
    put(folder, "other.json", '{\n"reviews": [{"a": 9}]}')
    put(folder, "none.json", '{\n"reviews": []}')
    for df in (read_reviews(spark, str(folder), SCHEMA), read_uploaded_data(spark, str(folder))):
        assert sorted(r.a for r in df.collect()) == list(range(1, 10))


def test_one_line_files_are_judged_by_their_own_object(spark, tmp_path):
    """A wrapper on one line keeps its rows beside files of lines, and a lone review with images stays a review."""
    folder = tmp_path / "mixed.json"
    folder.mkdir()
    put(folder, "wrapped.json", '{"reviews": [{"a": 1, "t": "x"}, {"a": 2}], "n": 2}')
    put(folder, "none.json", '{"reviews": []}')
    put(folder, "images.json", '{"a": 3, "images": [{"u": "x"}]}\n')
    put(folder, "tags.json", '{"a": 4, "tags": ["x"]}')
    for lines in (False, True):
        want = [1, 2, 3, 4, 5, 6] if lines else [1, 2, 3, 4]
        if lines:
            put(folder, "lines.json", '{"a": 5, "images": []}\n{"a": 6, "t": "y"}\n')
            # Without a schema nothing tells a record with images from a document; other files do not decide it.
            with pytest.raises(ValueError, match="schema or a layout"):
                read_uploaded_data(spark, str(folder))
        assert sorted(r.a for r in read_reviews(spark, str(folder), SCHEMA).collect()) == want


def test_files_beside_a_document_do_not_change_its_rows(spark, tmp_path):
    """A wrapper that shares a field with the lines beside it."""
    folder = tmp_path / "mixed.json"
    folder.mkdir()
    put(folder, "wrapped.json", '{"data": [{"body": "a"}, {"body": "b"}], "text": "note"}')
    assert sorted(r.body for r in read_uploaded_data(spark, str(folder)).collect()) == ["a", "b"]
    put(folder, "lines.json", '{"text": "c"}\n{"text": "d"}\n')
    with pytest.raises(ValueError, match="wrapped.json"):
        read_uploaded_data(spark, str(folder))
    both = spark.createDataFrame([], "body string, text string").schema
    got = read_reviews(spark, str(folder), both).collect()
    assert sorted(map(str, (r.body or r.text for r in got))) == ["a", "b", "c", "d"]


CSV_FIELDS = ["plain", "", " two words ", 'say ""hi""', "a,b", "line one\nline two", "\n\n", "end\r\nof", '""', "é漢", 'x\n""y"",\nz', 'height 5" or so']


def csv_text(rng, rows):
    quoted = lambda f: f'"{f}"' if any(c in f for c in ',\n') or '""' in f else f
    return "a,b,c\n" + "".join(",".join(quoted(rng.choice(CSV_FIELDS)) for _ in range(3)) + "\n" for _ in range(rows))


@pytest.mark.parametrize(("size", "limit"), [(7, 1000), (64, 0), (1 << 20, 1000)])
def test_quoted_csv_in_ranges_smaller_than_a_record(spark, tmp_path, monkeypatch, size, limit):
    """Beside Spark's reader of whole files; ranges cut records, lines and quotes at all places."""
    folder = tmp_path / "in"
    folder.mkdir()
    rng = random.Random(size)
    for name in ("one", "two"):
        put(folder, f"{name}.csv", csv_text(rng, 25))
    put(folder, "open.csv", 'a,b,c\n1,"' + "inside\n" * 60 + '",3\n4,5,6')
    put(folder, "bom.csv", '\ufeff"a",B,c\r\n7,8,"9"\r\n\r\n')
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv([str(folder / f"{n}.csv") for n in ("one", "two", "open")])
    want = sorted([tuple(r) for r in whole.collect()] + [("7", "8", "9")], key=str)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(csv_records, "BROADCAST_ROWS", limit)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        df = read_csv(spark, str(folder))
        assert sorted(map(tuple, df.collect()), key=str) == want
        if size == 64:
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 20
            ordered = with_ingest_seq(read_csv(spark, str(folder / "one.csv"), place=True)).orderBy("ingest_seq")
            in_file = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(folder / "one.csv"))
            assert [tuple(r)[:3] for r in ordered.collect()] == [tuple(r) for r in in_file.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")


def json_value(rng, depth=0):
    kind = rng.randrange(7 if depth < 3 else 4)
    text = "".join(rng.choice(['a', '}', '{', '[', ']', '"', "\\", ",", "\n", "é", " "]) for _ in range(rng.randrange(6)))
    if kind > 4:
        return {text + str(i): json_value(rng, depth + 1) for i in range(rng.randrange(3))}
    return [text, rng.randrange(9), None, True, [json_value(rng, depth + 1) for _ in range(rng.randrange(3))]][kind if depth < 3 else kind % 4]


@pytest.mark.parametrize(("size", "limit"), [(9, 1000), (64, 0), (1 << 20, 1000)])
def test_documents_in_ranges_smaller_than_a_record(spark, tmp_path, monkeypatch, size, limit):
    """Brackets and escapes in strings, nested items, wrappers with other fields, documents that are records."""
    rng = random.Random(size)
    record = lambda i: {"a": i, "t": json.dumps(json_value(rng)), "more": json_value(rng)}
    items = [record(i) for i in range(40)]
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "array.json", "\ufeff" + json.dumps(items[:12]))
    put(folder, "pretty.json", json.dumps({"x": {"y": [{"a": 99}]}, "tags": "]}", "rows": items[12:25], "n": {"}": 1}}, indent=2, ensure_ascii=False) + "\n")
    put(folder, "single.json", json.dumps(items[25] | {"p": [{"a": 98}], "q": [{"a": 97}]}))
    put(folder, "mixed.json", json.dumps(items[26] | {"p": [{"a": 96}, 1]}) + "  ")
    put(folder, "none.json", json.dumps({"rows": []}))
    put(folder, "empty.json", "")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    monkeypatch.setattr(json_records, "BROADCAST_ROWS", limit)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        got = read_json_document(spark, str(folder), SCHEMA).collect()
        assert sorted(map(tuple, got)) == [(i["a"], i["t"]) for i in items[:27]]
        for content in () if size == 9 else ("[{}]}", "[{} {}]", '{"a": [{}}', "[{}, 1]", "[[{}]]", '[{"a": 1}', '{"a": 1} {"a": 2}', " ", "[{},]"):
            with pytest.raises(Exception, match="JSON|parse|cast|MALFORMED|Malformed"):
                read_json_document(spark, put(tmp_path, "bad.json", content), SCHEMA).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_csv_headers_must_agree(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a.csv", "x,x,\n1,2,3\n")
    assert read_csv(spark, str(folder)).columns == ["x0", "x1", "_c2"]
    put(folder, "b.csv", "x,y,\n1,2,3\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(folder)).collect()
    put(tmp_path, "more.csv", "a,t,u\n1,x,y\n")
    with pytest.raises(Exception, match="CSV header"):
        read_csv(spark, str(tmp_path / "more.csv"), SCHEMA).collect()


def test_document_wrappers_are_judged_file_by_file(spark, tmp_path):
    put(tmp_path, "a.json", '{"reviews": [{"a": 1}, {"a": 2}]}')
    put(tmp_path, "b.json", '{"a": 3}')
    put(tmp_path, "c.json", '{"items": [{"a": 4}]}')
    put(tmp_path, "d.json", '{"tags": ["x"], "a": 5}')
    assert sorted(r.a for r in read_json_document(spark, str(tmp_path), SCHEMA).collect()) == [1, 2, 3, 4, 5]
    assert sorted(r.a for r in read_json_document(spark, str(tmp_path)).collect()) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("content", ['{"a": 1}\n{"a": 2}', '[{"a": 1}] x', '{"a": 1}, {"a": 2}', '[{"a": "x"}]'])
def test_document_with_more_or_less_than_a_value_fails(spark, tmp_path, content):
    with pytest.raises(Exception, match="JSON|parse|cast|MALFORMED|Malformed"):
        read_json_document(spark, put(tmp_path, "d.json", content), SCHEMA).collect()


@pytest.mark.parametrize("row", ["2,y,extra", "bad,y", "3"])
def test_csv_rows_that_do_not_fit_fail(spark, tmp_path, row):
    path = put(tmp_path, "r.csv", f"a,t\n1,x\n{row}\n")
    with pytest.raises(Exception, match="FAILFAST|Malformed|FAILED_READ_FILE"):
        read_csv(spark, path, SCHEMA).collect()
    assert rows(read_csv(spark, path, SCHEMA, strict=False)) == [(1, "x")]
    if row != "bad,y":
        with pytest.raises(Exception, match="FAILFAST|Malformed|FAILED_READ_FILE"):
            read_csv(spark, path).collect()


@pytest.mark.parametrize("bad", ["{bad", '[{"a": 1}]'])
def test_bad_streamed_lines_stop_the_stream(spark, tmp_path, bad):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "r.jsonl", '{"a": 1, "t": "x"}\n' + bad + "\n")
    stream = read_reviews_stream(spark, str(folder), SCHEMA)
    query = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="Bad JSON record"):
        query.awaitTermination()


def test_streamed_csv(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "r.csv", 'a,t\n1,"x\ny"\n2,z\n')
    stream = read_reviews_stream(spark, str(folder), SCHEMA, file_format="csv")
    query = stream.drop("_file_place").writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(1, "x\ny"), (2, "z")]


def test_plain_documents_are_not_read_by_name(spark, tmp_path):
    """A document out of which no item was cut is taken from its outline; only one with a list of objects is read again."""
    folders = [tmp_path / name for name in ("arrays", "plain", "lists")]
    for folder in folders:
        folder.mkdir()
        put(folder, "a.json", '[{"a": 1, "t": "x"}, {"a": 2, "t": "}{"}]')
    put(folders[1], "b.json", '\ufeff{"a": 3, "t": "y", "n": [1, 2], "o": {"p": {}}}\n')
    put(folders[1], "c.json", '{"a": 4, "t": "{\\"}"}')
    put(folders[2], "d.json", '{"a": 5, "t": "z", "n": [{"q": 1}], "m": [1]}')
    frames = [read_json_document(spark, str(folder), SCHEMA) for folder in folders]
    scans = [df._jdf.queryExecution().optimizedPlan().toString().count("] text") for df in frames]
    assert scans[0] == scans[1] == scans[2] - 1
    assert [sorted(r.a for r in df.collect()) for df in frames] == [[1, 2], [1, 2, 3, 4], [1, 2, 5]]
    assert {r.a: r.t for r in frames[1].collect()} == {1: "x", 2: "}{", 3: "y", 4: '{"}'}


def test_document_query_writes_a_file_for_many_documents(spark, monkeypatch):
    paths = []
    monkeypatch.setattr(catalog, "read_json_document", lambda spark, path, schema: paths.append(path) or read_json_document(spark, path, schema))
    found = catalog.read_json_document_query(spark, "/root/testdata/sf0.01")
    files = spark.read.text(paths[0]).select("_metadata.file_path").distinct().count()
    assert files <= 4 * (found.count() // (4 * catalog.RECORDS_IN_FILE) + 1)
