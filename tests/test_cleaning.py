from pyspark.sql import functions as F

from sluice.functions.language import detect_language, language_tag
from sluice.functions.text import format_size, truncate
from sluice.operators import cleaning as C


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "content string").select(column(F.col("content")).alias("x")).first()["x"]


def test_basic_rules(spark):
    assert one(spark, "a\r\nb\rc", C.normalize_newlines) == "a\nb\nc"
    assert one(spark, "see <b>x</b> https://a.b/c?d=1 mail me@x.org now", C.strip_markup) == "see x  mail  now"
    assert one(spark, "wait!!!! 100mm H2O", C.collapse_marks) == "wait... 100 mm H2 O"
    assert one(spark, "水，火。（土）", C.ascii_punct) == "水,火.(土)"
    assert one(spark, "no cjk，here。", C.ascii_punct) == "no cjk，here。"
    assert one(spark, "a , b ;c  d ( x ) 1,234,567", C.fix_common) == "a, b;c  d (x) 1234,567"
    assert one(spark, "a　 b", C.collapse_blanks) == "a b"
    assert one(spark, "a \n\n b", lambda c: C.collapse_blanks(c, keep_newlines=True)) == "a \n b"
    assert one(spark, "水“引”", lambda c: C.ascii_punct(c, normalize_quotes=True)) == '水"引"'


def test_gate(spark):
    cases = {
        "水文水文水": False,  # too short
        "水水水水水水水水水水水水水水水水水水水水水": False,  # 21 letters, one kind
        "这是关于水文监测的一段文字": True,
        "plain text without any topic": False,
        "The quick brown fox jumps over the lazy dog; PACK MY BOX WITH FIVE DOZEN JUGS 0123456789 and then some more words": True,
        "": False,
    }
    for text, expected in cases.items():
        assert one(spark, text, C.quality_gate) is expected, text


def test_token_filters(spark):
    assert one(spark, "水库，调度a 年", lambda c: C.filter_cjk_tokens(c)) == "水库调度"
    assert one(spark, "The river and the dam!", lambda c: C.filter_en_tokens(c, ["the", "and"])) == "river dam"


def test_clean_keeps_blank_rows_and_marks(spark):
    rows = [(1, "   "), (2, None), (3, "水文监测数据显示 水位 上升"), (4, "水文监测数据显示 水位 上升")]
    df = C.clean(spark.createDataFrame(rows, "id int, content string"))
    df = df.withColumn("dup", F.col("id") == 4)
    got = {r["id"]: r for r in C.final_content(C.mark_status(df, "dup")).collect()}
    assert got[1]["content"] == "   " and got[1]["passed_gate"] is False
    assert got[2]["content"] is None
    assert got[3]["status"] == "completed" and got[4]["status"] == "skipped" and got[4]["skip_reason"]
    assert C.drop_skipped(C.mark_status(df, "dup")).count() == 3


def test_language(spark):
    cases = {"这是一段中文文字": "zh", "the cat and the dog": "en", "der Hund und die Katze": "de",
             "le chat et les chiens": "fr", "el perro y los gatos": "es", "12345": "unknown", "": "unknown"}
    for text, label in cases.items():
        assert one(spark, text, detect_language) == label
    assert one(spark, "der Hund und die Katze", language_tag) == "auto"


def test_small_helpers(spark):
    assert one(spark, "x" * 101, truncate) == "x" * 97 + "..."
    sizes = {0: "0B", 1: "1.0B", 1023: "1023.0B", 1024: "1.0KB", 2304: "2.2KB", 5 * 1024**4: "5.0TB", 3 * 1024**5: "3072.0TB"}
    for n, text in sizes.items():
        got = spark.createDataFrame([(n,)], "n bigint").select(format_size(F.col("n")).alias("x")).first()["x"]
        assert got == text
