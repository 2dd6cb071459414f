import json
import random

import pytest
from pyspark.sql import functions as F

from sluice.plans.corpus import run_corpus
from sluice.sources import files, pages, sinks
from sluice.streaming import incremental


def write(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def test_text_files(spark, tmp_path):
    write(tmp_path, "a.txt", "  长江流域的水文监测数据  \n")
    write(tmp_path, "b.TXT", "latin café au lait", "latin-1")
    write(tmp_path, "c.txt", "tiny")
    write(tmp_path, "sub/d.txt", "the text in a folder")
    write(tmp_path, "e.log", "not an accepted file")
    rows = {r["source"]["file_name"]: r for r in files.read_text(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a.txt", "b.TXT", "d.txt"}
    assert rows["a.txt"]["content"] == "长江流域的水文监测数据" and rows["a.txt"]["language"] == "zh"
    assert rows["b.TXT"]["content"] == "latin café au lait" and rows["b.TXT"]["source"]["file_type"] == ".txt"
    assert files.read_text(spark, str(tmp_path), recursive=False).count() == 2
    again = {r["chunk_id"] for r in files.read_text(spark, str(tmp_path)).collect()}
    assert again == {r["chunk_id"] for r in rows.values()}


def test_gbk_is_read_and_named(spark, tmp_path):
    write(tmp_path, "g.txt", "水文监测数据显示水位上升", "gbk")
    write(tmp_path, "u.txt", "水文监测数据显示水位下降")
    rows = {r["source"]["file_name"]: r for r in files.read_text(spark, str(tmp_path)).collect()}
    assert rows["g.txt"]["content"] == "水文监测数据显示水位上升" and rows["g.txt"]["source"]["encoding"] == "gbk"
    assert rows["u.txt"]["content"] == "水文监测数据显示水位下降" and rows["u.txt"]["source"]["encoding"] == "utf-8"


def test_long_files_are_read_in_pieces(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    lines = ["".join(rng.choice("ab é水\t\r") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts = {
        "a.txt": "\n".join(lines).encode(), "b.txt": ("\ufeff" + "\n".join(lines) + "\n\n").encode(), "c.txt": ("x" * 40_000).encode(),
        "d.txt": (" \u3000\n" * 9000 + "the middle of it" + "\x85\t" * 9000).encode(), "e e.txt": ("水文监测数据\n" * 3000).encode("gbk"),
        "f.txt": ("caf\xe9 au lait\n" * 3000).encode("latin-1"), "g.txt": b"\n" * 30_000, "h.txt": b"\n\n" + b"small one\n", "i.txt": b"",
        "j.txt": ("\ufeff" + "z" * 30_000).encode(),
    }
    for name, data in texts.items():
        (tmp_path / name).write_bytes(data)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    try:
        want = {r["chunk_id"]: r for r in files.read_text(spark, str(tmp_path), min_length=0).collect()}
        monkeypatch.setattr(files, "LONG_FILE", 20_000)
        monkeypatch.setattr(files, "PIECE", 500)
        found = files.read_text(spark, str(tmp_path), min_length=0)
        got = {r["chunk_id"]: r for r in found.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    # Files without a byte are not read.
    assert len(want) == len(texts) - 1 and got == want
    # A long text is neither queued beside a Python step nor stripped with an array of its places.
    plan = files._long_texts(spark, str(tmp_path), ["txt"], True)._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" not in plan and "trim(" not in plan


def test_csv_with_different_headers(spark, tmp_path):
    write(tmp_path, "a.csv", 'name,note\nx,"one, two"\ny,\n,\nz,"line\nbreak"\n')
    write(tmp_path, "b.csv", "note,size,name\nhello,NA,q\n")
    rows = files.read_csv_rows(spark, str(tmp_path)).orderBy("source.file_name", "row_number").collect()
    assert [(r["row_number"], r["content"]) for r in rows] == [
        (0, "name: x | note: one, two"), (1, "name: y"), (3, "name: z | note: line\nbreak"), (0, "note: hello | name: q")]


def test_csv_without_line_breaks_and_many_headers(spark, tmp_path):
    write(tmp_path, "a.csv", 'name,note,,"a ""b"""\nx,"one, ""two""",3,4,5\n\n,,\n"","",,z\n')
    for i in range(150):
        write(tmp_path, f"many/f{i}.csv", f"h{i},k\nv{i},\n")
    want = [(0, 'name: x | note: one, "two" | _c2: 3 | a "b": 4'), (2, 'a "b": z')]
    for multi_line in (True, False):
        rows = files.read_csv_rows(spark, str(tmp_path), multi_line=multi_line)
        got = rows.filter("source.file_name = 'a.csv'").orderBy("row_number").collect()
        assert [(r["row_number"], r["content"]) for r in got] == want
        many = {r["content"] for r in rows.filter("source.file_name != 'a.csv'").collect()}
        assert many == {f"h{i}: v{i}" for i in range(150)}
    (tmp_path / "none").mkdir()
    assert files.read_csv_rows(spark, str(tmp_path / "none")).count() == files.read_csv_rows(spark, str(tmp_path / "none"), multi_line=False).count() == 0


def test_csv_row_numbers_across_splits(spark, tmp_path):
    write(tmp_path, "big.csv", "id,text\n" + "".join(f"{i},some words {i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10k")
    try:
        rows = files.read_csv_rows(spark, str(tmp_path), multi_line=False)
        assert rows.count() == 3000
        assert rows.filter(F.col("content") != F.concat(F.lit("id: "), F.col("row_number").cast("string"), F.lit(" | text: some words "), F.col("row_number").cast("string"))).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")


def test_json_leaves(spark, tmp_path):
    doc = {"a": {"b": ["short", {"c": "a long enough leaf"}], "n": 12345678901, "none": None, "empty": {}}, "t": " the top level text "}
    write(tmp_path, "x.json", json.dumps(doc))
    write(tmp_path, "bad.json", "{not json")
    rows = {r["json_path"]: r["content"] for r in files.read_json_leaves(spark, str(tmp_path)).collect()}
    assert rows == {"a.b[1].c": "a long enough leaf", "t": "the top level text"}
    deep = "0123456789"
    for i in range(40):
        deep = [deep] if i % 2 else {"k": deep}
    df = spark.createDataFrame([(1, json.dumps(deep)), (2, "{bad"), (3, None), (4, '"a top level string"')], "id int, j string")
    assert {(r["id"], r["content"]) for r in files.json_leaves(df, "j").collect()} == {(1, "0123456789"), (4, "a top level string")}
    assert [r["id"] for r in files.unparsed_json(df, "j").collect()] == [2]


def test_directory_and_formats(spark, tmp_path):
    assert set(files.formats()) == {"txt", "text", "md", "markdown", "csv", "json"}
    with pytest.raises(ValueError):
        files.read_directory(spark, str(tmp_path))
    write(tmp_path, "a.md", "# A heading and text")
    write(tmp_path, "b.csv", "a\nsome value\n")
    kinds = {r["data_type"] for r in files.read_directory(spark, str(tmp_path)).collect()}
    assert kinds == {"markdown", "csv"}


def test_records_and_empty_input(spark, tmp_path):
    write(tmp_path, "a.json", json.dumps([{"score": 0.7}, {"score": None}]))
    write(tmp_path, "e.json", "[]")
    assert files.read_records(spark, str(tmp_path / "a.json"), "score double").count() == 2
    assert files.read_records(spark, str(tmp_path / "e.json"), "score double").count() == 0


def test_html(spark):
    html = "<html><head><title>t</title></head><body><h2>Head</h2><p>A &lt;b&gt; &#27700;&#x6587; &amp;lt;</p><ul><li>x<li>y</ul><script>1</script></body>"
    got = pages.html_to_text(spark.createDataFrame([(html,)], "html string")).first()["content"]
    assert got == "## Head\n\nA <b> 水文 &lt;\n\n- x\n- y"


def test_table_to_text(spark):
    df = spark.createDataFrame([([["a", None], [None], ["b", "c"]],)], "t array<array<string>>")
    assert df.select(files.table_to_text(F.col("t")).alias("x")).first()["x"] == "a | \nb | c"


def test_quarantine(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "bad")], "id int, s string")
    failure = F.when(F.col("s") == "bad", F.lit("no good"))
    good, bad = sinks.quarantine(df, failure)
    assert [r["id"] for r in good.collect()] == [1] and bad.first()["error"] == "no good"
    with pytest.raises(Exception, match="no good"):
        sinks.quarantine(df, failure, "stop")[0].collect()


def test_incremental_seen_texts_survive_runs(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id bigint, text string"

    def run(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        incremental.run_available(incremental.stream_exact_dedup(incremental.stream_text(spark, source, schema), "text"), out, state)
        return sorted(r["text"] for r in spark.read.parquet(out).collect())

    assert run([(1, "a"), (2, "b"), (3, "a")]) == ["a", "b"]
    assert run([(4, "b"), (5, "c")]) == ["a", "b", "c"]


def test_whole_run(spark, tmp_path):
    text = "长江流域水文监测系统显示，汛期降雨量达到120mm，水库调度和防洪措施有效。" * 40
    write(tmp_path, "in/a.txt", text)
    write(tmp_path, "in/b.txt", text)
    write(tmp_path, "in/c.csv", "站点,水位\n宜昌站水文数据,45.2m\n")
    stats = run_corpus(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    chunks = spark.read.parquet(str(tmp_path / "out/chunks"))
    assert stats["total_chunks"] == chunks.count() and stats["type_csv"] == 1 and stats["total_qa_pairs"] > 0
    assert chunks.filter("status = 'skipped'").count() > 0
    assert chunks.filter("quality.overall is null").count() == 0
    assert chunks.select("chunk_id").distinct().count() == chunks.count()
