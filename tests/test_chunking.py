import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.operators import chunking as C


def pieces(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    out = {}
    for r in C.chunk_text(df, **options).orderBy("id", "chunk_number").collect():
        out.setdefault(r["id"], []).append(r)
    return out


def test_short_text_is_one_piece(spark):
    got = pieces(spark, ["x" * 1000, " " + "y" * 500 + "\n", "short", "   "])
    assert [len(got.get(i, [])) for i in range(4)] == [1, 1, 0, 0]
    assert got[1][0]["content"] == "y" * 500 and got[1][0]["total_chunks"] == 1


def test_cut_at_separator_with_overlap(spark):
    text = "a" * 600 + "。" + "b" * 700
    first, second = pieces(spark, [text])[0]
    assert first["content"] == "a" * 600 + "。"
    assert second["start"] == 501 and second["content"].endswith("b" * 700)
    assert second["total_chunks"] == 2


def test_separator_inside_overlap_terminates(spark):
    got = pieces(spark, ["aa\n" + "b" * 3000])[0]
    # The first piece is too short to stay, but it is counted.
    assert [(p["chunk_number"], p["start"]) for p in got][:2] == [(1, 3), (2, 903)]
    assert got[-1]["content"][-1] == "b"


def test_priority_of_separators(spark):
    text = "a" * 300 + "\n\n" + "b" * 300 + "。" + "c" * 600
    assert pieces(spark, [text])[0][0]["content"] == "a" * 300


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="ab \n。.！? ", min_size=0, max_size=400), min_size=1, max_size=8))
def test_pieces_cover_text(spark, texts):
    size, overlap = 50, 10
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    rows = df.select("id", "content", F.inline(C.chunk_pieces(F.col("content"), size, overlap))).collect()
    for i, text in enumerate(texts):
        mine = sorted((r for r in rows if r["id"] == i), key=lambda r: r["chunk_number"])
        end = 0
        for r in mine:
            assert len(r["text"]) <= size and r["text"] == text[r["start"] : r["start"] + len(r["text"])]
            assert r["start"] <= end and end - r["start"] <= overlap
            assert r["start"] + len(r["text"]) > end
            end = r["start"] + len(r["text"])
        assert end == len(text)


def test_fixed_stride_tail(spark):
    rng = random.Random(1)
    texts = ["x" * n for n in (1, 99, 100, 101, 900, 999, 1000, 1001, 1900, 1901, rng.randint(2000, 5000))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    rows = C.chunk_fixed(df).collect()
    for i, text in enumerate(texts):
        expected, start = [], 0
        while start < len(text):
            expected.append(start)
            if start + 1000 >= len(text):
                break
            start += 900
        assert sorted(r["start"] for r in rows if r["id"] == i) == expected


def test_token_chunks(spark):
    df = spark.createDataFrame([(1, "one two, three 水文。"), (2, "")], "id int, content string")
    got = [r["content"] for r in C.chunk_tokens(df, n=3).orderBy("chunk_number").collect()]
    assert got == ["one two ,", "three 水文 。"]
