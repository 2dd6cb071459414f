import re

import pyarrow as pa
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.operators import enhance as E
from sluice.operators import dictionary as D
from sluice.operators import quality as Q
from sluice.operators.cleaning import segment_marked
from sluice.operators.dictionary import candidates, dictionary_table, extract_terms_by_table, word_bits
from sluice.plans.queries.registry import WORDS, derived_texts

HIGH = ("长江流域水文监测系统包括水文站和雨量站。由于2023年汛期降雨量达到1200mm，水库调度采用新的技术方法，因此防洪效果明显。"
        "首先，监测数据显示水位上升2.5m；其次，径流增加15%。最后，生态保护和水质治理措施得到应用，大坝运行稳定！工程管理制度和规划正在完善？")
MEDIUM = "水库的水位今年有所上升。管理部门加强了监测。"
LOW = "今天天气很好，我们去公园玩。"


def frame(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "id int, content string")


def test_order_of_quality(spark):
    df = Q.evaluate(E.extract_terms(frame(spark, HIGH, MEDIUM, LOW)))
    got = [r["quality"]["overall"] for r in df.orderBy("id").collect()]
    assert got[0] > got[1] > got[2] and all(0 <= s <= 1 for s in got)
    row = df.orderBy(F.desc("id")).first()
    assert row["quality_warning"] and V.SUGGESTIONS["short"] in row["improvement_suggestions"]


def test_terms(spark):
    df = E.extract_terms(frame(spark, "长江的水文站和水库水文", "river Water waters water quality"))
    zh, en = [[(t["term"], t["type"]) for t in r["extracted_terms"]] for r in df.orderBy("id").collect()]
    assert zh == [("长江", "实体"), ("水文", "专业术语"), ("站和水库", "疑似专业术语")]
    assert [t for t, _ in en] == ["river", "water"]


def test_answer_window_prefers_longest_then_first(spark):
    text = "水位" + "a" * 150 + "水位" + "b" * 300 + "水位"
    got = frame(spark, text).select(E.answer_window(F.col("content"), F.lit("水位"), F.lit("-")).alias("x")).first()["x"]
    assert got == "水位"[:0] + text[52:254] and len(got) == 202
    short = frame(spark, "水位").select(E.answer_window(F.col("content"), F.lit("水位"), F.lit("-")).alias("x")).first()["x"]
    assert short == "-"


def test_windows_leave_a_worker_in_small_batches(spark):
    texts = ["水位" + "上升了" * i if i % 7 else None for i in range(300)]
    words = [["水位", "了", "无", None] if i % 5 else None for i in range(300)]
    found = list(E.window_batches(iter([(pa.array(texts), pa.array(words))]), 3, None))
    assert max(map(len, found)) <= 64 and sum(map(len, found)) == 300
    df = spark.createDataFrame(list(zip(range(300), texts, words)), "id long, t string, w array<string>").coalesce(1)
    got = [r.x for r in df.select("id", E.windows_around(F.col("t"), F.col("w"), 3).alias("x")).orderBy("id").collect()]
    assert got == [x for batch in found for x in batch.to_pylist()]
    assert got[0] is None and got[5] is None and got[1] == ["水位上升了", "位上升了", None, None]


def test_overlapping_positions(spark):
    got = frame(spark, "x水水水y").select(E.find_positions(F.col("content"), F.lit("水水")).alias("x")).first()["x"]
    assert got == [1, 2]


def test_qa(spark):
    terms = E.extract_terms(frame(spark, HIGH, "水文"))
    whole = E.generate_qa(terms, "id").orderBy("id").first()
    # Without limits every term and every measurement gives a pair, with the whole text as its context.
    methods = [q["method"] for q in whole["generated_qa"]]
    assert methods.count("template") == len(whole["extracted_terms"]) > 3 and len(methods) == 11
    assert {q["context"] for q in whole["generated_qa"] if q["method"] == "template"} == {HIGH}
    df = E.generate_qa(terms, "id", limits=E.SHORT)
    first, second = [r["generated_qa"] for r in df.orderBy("id").collect()]
    assert len(first) == 5 and [q["method"] for q in first] == ["template"] * 3 + ["content"] * 2
    assert first[3]["question"] == "文中提到的1200mm这个数据代表什么含义？" and first[3]["domain"] == "数据"
    # One term only: never the comparison type, so no open place is left.
    assert len(second) == 1 and "{" not in second[0]["question"] and second[0]["domain"] == "水文学"


def test_enrich_is_idempotent(spark):
    df = E.extract_terms(frame(spark, "水文与水文，防洪"))
    once = df.withColumn("content", E.enrich(F.col("content"), F.col("extracted_terms")))
    text = once.first()["content"]
    assert text == "水文（研究水的各种现象和规律）与水文（研究水的各种现象和规律），防洪（防止洪水灾害的各种措施）"
    assert once.withColumn("content", E.enrich(F.col("content"), F.col("extracted_terms"))).first()["content"] == text


def test_whole_stage_and_kb_update(spark):
    kb = E.Knowledge().updated(terms={"鱼道": ["过鱼设施"]})
    row = E.enhance(frame(spark, "鱼道和水质保护"), "id", kb=kb).first()
    assert row["extracted_terms"][0]["term"] == "鱼道" and row["extracted_terms"][0]["aliases"] == ["过鱼设施"]
    assert row["domain_tags"] == ["水环境"] and row["knowledge_enriched"] is False
    terms, entities, relations = kb.frames(spark)
    assert (terms.count(), entities.count(), relations.count()) == (21, 4, 4)


def test_blank_text_has_no_score(spark):
    df = Q.evaluate(frame(spark, HIGH, "  ", None))
    assert [r["quality"] is None for r in df.orderBy("id").collect()] == [False, True, True]
    assert Q.evaluation_report(df).first()["total_evaluated"] == 1 and Q.filter_by_quality(df, 0.0).count() == 1


def test_switched_off_metric(spark):
    row = Q.evaluate(frame(spark, HIGH), metrics=["relevance"]).first()["quality"]
    assert row["overall"] == row["relevance"] and row["diversity"] == 0.0


def test_qa_score_without_confidence(spark):
    schema = "question string, answer string, context string, confidence double"
    rows = [("什么是水文？", "水文" * 15, "什么是水文", None), ("什么是水文？", "水文" * 15, "什么是水文", 0.5)]
    a, b = [r["qa_quality"] for r in Q.qa_score(spark.createDataFrame(rows, schema)).orderBy(F.col("confidence").isNotNull()).collect()]
    assert abs(a - 2 * b) < 1e-12


def test_median_by_histogram_equals_percentile(spark):
    values = spark.range(1001).select(F.lit("m").alias("metric"), (F.pmod(F.xxhash64("id"), F.lit(397)) / 1000.0).alias("score"))
    counts = values.groupBy("metric", "score").agg(F.count(F.lit(1)).alias("n"))
    exact = values.agg(F.percentile("score", F.lit(0.5)).alias("x")).first()["x"]
    assert Q.exact_median(counts).first()["median"] == exact
    even = spark.createDataFrame([("m", 0.1, 1), ("m", 0.2, 1), ("m", 0.4, 1), ("m", 0.9, 1)], "metric string, score double, n bigint")
    assert abs(Q.exact_median(even).first()["median"] - 0.3) < 1e-12


def test_dictionary_table_gives_the_same_terms(spark):
    kb = E.Knowledge().updated(terms={"水文监测": ["甲"], "水文监": ["乙"], "测系": [], "the": [], "三峡": ["丙"]}, entities={"三峡": {"a": "b"}, "预警系统": {"k": "v"}})
    texts = [HIGH, "水文监测系统与水文监", "", None, "the 三峡预警系统 the", "测系测系统", HIGH]
    df = spark.createDataFrame([(i % 5, t) for i, t in enumerate(texts)], "id int, content string").repartition(3)
    want = df.select("id", "content", E.chinese_terms(F.coalesce("content", F.lit("")), kb).alias("extracted_terms"))
    got = extract_terms_by_table(df, dictionary_table(spark, kb).unionByName(dictionary_table(spark, kb).limit(2)))
    assert got.columns == want.columns

    def plain(df):
        return sorted(str((r.id, r.content, [(t.term, t.type, t.confidence, t.aliases, sorted((t.entity_info or {}).items())) for t in r.extracted_terms])) for r in df.collect())

    assert plain(got) == plain(want)
    assert extract_terms_by_table(df.limit(0), dictionary_table(spark, kb)).count() == 0
    more = spark.range(100_000).selectExpr("concat('词', id) as term", "'term' as kind", "array('x') as aliases", "cast(null as map<string,string>) as entity_info")
    (row,) = extract_terms_by_table(df.limit(1).withColumn("content", F.lit("有词777和词99999")), more).collect()
    assert [t["term"] for t in row["extracted_terms"]] == []


def test_a_worker_holds_few_rows_of_pieces(spark):
    bits = word_bits(dictionary_table(spark, E.Knowledge().updated(terms={"水文": []})))
    rows = pa.table({"_row": range(1000), "_text": ["水文" * 5] * 1000}).to_batches()
    found = list(D.found_pieces(iter(rows), [2], bits))
    assert sum(b.num_rows for b in found) == 1000 and max(len(set(b.column("_row").to_pylist())) for b in found) <= D.SOME_ROWS
    words = pa.array([[{"term": "水文", "places": [0, 2]}], None] * 500)
    texts = list(D.marked([(rows[0].column("_text"), words)]))
    assert max(map(len, texts)) <= D.SOME_ROWS
    assert pa.concat_arrays(texts).to_pylist() == ["\x01水文\x01" * 2 + "水文" * 3, "水文" * 5] * 500


def test_only_likely_words_leave_a_text(spark):
    words = dictionary_table(spark, E.Knowledge()).unionByName(
        spark.range(50_000).selectExpr("concat('零件', id) as term", "'term' as kind", "array('x') as aliases", "cast(null as map<string,string>) as entity_info"))
    known = {r.term for r in words.select("term").collect()}
    sizes = sorted({len(w) for w in known})
    texts = [(0, "零件" * 3000 + "零件49999和大坝水库"), (1, ""), (2, "水"), (3, "𠀀三峡" * 50)]
    rows = spark.createDataFrame(texts, "_row long, _text string")
    found = {(r._row, r.term): list(r.places) for r in candidates(rows, sizes, word_bits(words)).collect()}
    want = {}
    for row, text in texts:
        for size in sizes:
            for at in range(len(text) - size + 1):
                if text[at : at + size] in known:
                    want.setdefault((row, text[at : at + size]), []).append(at)
    assert want.items() <= found.items() and len(found) <= len(want) + 5


def test_words_are_marked_where_one_may_begin(spark):
    words = ["水文", "水文站", "pH值", "大坝", "]水", "^a", "-b", "H2O", "𝒳y", "&&c", "\\d"]
    texts = ["水文站和水文，大坝大坝 pH值高H2O水位]水^a-b&&c\\d𝒳y", "", None, "没有词的 text", "水文水文站x水位"]
    got = frame(spark, *texts).select("id", segment_marked(F.col("content"), words).alias("m")).orderBy("id")
    plain = re.compile("(" + "|".join(map(re.escape, sorted(words, key=lambda w: (-len(w), w)))) + ")")
    assert [r.m for r in got.collect()] == [t and plain.sub("\x01\\1\x01", t) for t in texts]
    pattern = got._jdf.queryExecution().optimizedPlan().toString()
    assert "(?=[" in pattern
    assert frame(spark, "水ab").select(segment_marked(F.col("content"), ["水", ""]).alias("m")).first().m.startswith("\x01水\x01")


def test_pairs_and_explanations_take_few_workers(spark):
    # Windows of terms and measurements by one worker, explanations by another; texts leave in small batches.
    df = E.enhance(frame(spark, HIGH, "水文"), "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2
    texts = pa.array(["水文站12mm" * (i % 9) if i % 7 else None for i in range(300)])
    terms = pa.array([["水文"] if i % 5 else None for i in range(300)])
    facts = pa.array([["12mm"] * (i % 9) for i in range(300)])
    pairs = list(E.pair_window_batches(iter([(texts, terms, facts)])))
    for found in (pairs, list(E.explained_batches(iter([(texts, terms)]), V.EXPLANATIONS))):
        sizes = list(map(len, found))
        assert max(sizes) <= 64 and sum(sizes) == 300
    rows = [x for a in pairs for x in a.to_pylist()]
    assert [r["terms"] for r in rows] == [x for a in E.window_batches(iter([(texts, terms)]), 100, 20) for x in a.to_pylist()]
    assert [r["facts"] for r in rows] == [x for a in E.window_batches(iter([(texts, facts)]), 50, None) for x in a.to_pylist()]


def test_derived_texts_follow_the_words(spark):
    texts = ["", None, " ", "é. 𝒳a ,\n é", "\n", "  a", "词 ßx 𝒳 ퟿.,"] + [f"w{i} é{i}, 中{i}.\n" for i in range(300)]

    def word(w):
        at = (len(w) * 7 + (ord(w[0]) * 3 + ord(w[-1]) if w else 0)) % len(WORDS)
        return WORDS[at] + ("。" if "." in w else "，" if "," in w else "") + ("\n" if "\n" in w else "")

    want = [None if t is None else "".join(map(word, t.split(" "))) for t in texts]
    batches = [pa.array(texts, pa.string()), pa.array([], pa.string()), pa.array([None], pa.string()), pa.array(texts, pa.string()).slice(3)]
    got = [list(derived_texts(iter([b]))) for b in batches]
    assert [[x for a in g for x in a.to_pylist()] for g in got] == [want, [], [None], want[3:]]
    assert max(len(a) for g in got for a in g) <= 256
