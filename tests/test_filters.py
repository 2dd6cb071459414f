import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import filters_code as G
from sluice.operators import filters_text as T
from sluice.plans import recipes

CASES = [
    (T.blocklist, (["bad", "worse"],), "Bad day", True), (T.blocklist, (["bad", "worse"],), "bad and WORSE", False),
    (T.word_number, (2, 4), "a b", True), (T.word_number, (2, 4), "a b c d", False),
    (T.colon_end, (), "as follows: ", False), (T.colon_end, (), "a:b", True),
    (T.sentence_number, (2, 3), "a. b!", True), (T.sentence_number, (2, 3), "a...", False),
    (T.line_end_with_ellipsis, (0.3,), "a...\nb\nc", False), (T.line_end_with_ellipsis, (0.3,), "a…\nb\nc\nd", True),
    (T.content_null, (), " 　", False), (T.content_null, (), "x", True),
    (T.mean_word_length, (3, 10), "abc abc", True), (T.mean_word_length, (3, 10), "ab abc", False),
    (T.symbol_word_ratio, (0.4,), "# a b", True), (T.symbol_word_ratio, (0.4,), "# # a b", False),
    (T.html_entity, (), "a&nbsp;b", False), (T.html_entity, (), "a & b", True),
    (T.no_punc, (3,), "a b c. d", True), (T.no_punc, (3,), "a b c d", False),
    (T.special_character, (), "a​b", False), (T.special_character, (), "a\tb\n", True),
    (T.watermark, (), "Copyright 2020", False), (T.watermark, (), "copyright", True),
    (T.curly_bracket, (0.5,), "{}", False), (T.curly_bracket, (0.5,), "{abc", True),
    (T.capital_words, (0.5,), "AB cd", True), (T.capital_words, (0.4,), "AB cd", False),
    (T.lorem_ipsum, (), "Lorem Ipsum dolor", False), (T.lorem_ipsum, (), "lorem", True),
    (T.unique_words, (0.5,), "a A a", False), (T.unique_words, (0.5,), "a b", True),
    (T.char_number, (3,), " a b ", False), (T.char_number, (3,), "a b c", True),
    (T.line_start_with_bullet, (0.5,), "- a\n• b", False), (T.line_start_with_bullet, (0.5,), "- a\nb", True),
    (T.line_with_javascript, (1,), "enable JavaScript", False), (T.line_with_javascript, (1,), "x", True),
    (T.id_card, (1,), "no 12345678901234567X", False), (T.id_card, (1,), "123-45-678", True),
    (T.language, (["en"],), "the end of the day", True), (T.language, (["en"],), "le et les", False),
]


@pytest.mark.parametrize("make,args,text,kept", CASES)
def test_text_filter(spark, make, args, text, kept):
    df = spark.createDataFrame([(text,)], "text string")
    assert (T.keep(df, "text", make(*args)).count() == 1) is kept


def test_null_text_is_dropped_by_any_filter(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert T.keep(df, "text", T.colon_end()).count() == 0


def test_recipe_is_one_scan_without_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    kept = recipes.pretrain_text(docs, "text", "doc_id", near_dup=False)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and plan.count("FileScan") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    # The barrier keeps the refining expression single.
    assert plan.count("1F300") == 1


def test_stage_counts_fall(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [r["rows"] for r in recipes.pretrain_stage_counts(docs, "text").orderBy("step").collect()]
    assert rows == sorted(rows, reverse=True) and len(rows) == len(recipes.PRETRAIN_FILTERS) + 1


CODE = [
    ("good", "def f(x):\n" + "\n".join(f"    value_{i} = compute(x, {i}) + other_{i * 7}" for i in range(12)), {}),
    ("generated", "# Auto-generated file\n" + "\n".join(f"name_{i} = {i}" for i in range(20)), {"autogen_label": 0}),
    ("long line", "x" * 1002, {"length_label": 0, "quality_label": 0}),
    ("tiny", "a=1", {"quality_label": 0}),
    ("encoded", "data = '" + "QUJD" * 300 + "'", {"encoded_label": 0}),
    ("repeated", "same line here\n" * 20, {"quality_label": 0}),
    ("symbols", "{}[]();;" * 20, {"composition_label": 0}),
]


def test_code_labels(spark):
    df = spark.createDataFrame([(n, t) for n, t, _ in CODE], "name string, text string")
    got = {r["name"]: r.asDict() for r in G.code_labels(df, lines_col=None).collect()}
    for name, _, zeros in CODE:
        for label, value in zeros.items():
            assert got[name][label] == value, (name, label)
    assert all(v == 1 for k, v in got["good"].items() if k.endswith("_label"))


def test_comparison_names(spark):
    df = spark.createDataFrame([(7.0,), (8.0,), (None,)], "s double")
    assert G.generic_score(df, "s", 8).count() == 1
    with pytest.raises(ValueError):
        G.generic_score(df, "s", 8, "1=1 or")


def test_cheap_forms_of_filters_equal_the_plain_ones(spark):
    from sluice.functions.text import BLANK, SENTENCE_MARK, WORD, count_of, find_all
    rng = random.Random(6)
    parts = ["a", "Bc", "\u00e9\u4e2d", " ", "  ", "\t", "\n", "\u3000", "\x1c", "\x85", ".", "...", "!?", "\u3002", "\u2026", "#", "{", "}", "&nbsp;", "amp;", ";",
             "\U0001F600", "\u2600", "\uFE0F", "\uFFFD", "\x00", "\x7f", "\u200b", "lorem "]
    texts = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(1500)] + ["", " ", "x " * 112, "x " * 113, "x." * 113, None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    t = F.col("text")
    words = find_all(t, WORD)
    plain = {
        "spaces": T.strip(F.regexp_replace(t, f"[{BLANK}]+", " ")),
        "emoji": F.regexp_replace(t, T.EMOJI, ""),
        "symbols": T.ratio(count_of(t, r"#|\.\.\.|\u2026"), F.size(words)) < 0.4,
        "entity": ~t.rlike(T.HTML_ENTITY),
        "punc": F.coalesce(F.array_max(F.transform(F.split(t, SENTENCE_MARK), lambda s: count_of(s, WORD))), F.lit(0)) <= 112,
        "punc2": F.coalesce(F.array_max(F.transform(F.split(t, SENTENCE_MARK), lambda s: count_of(s, WORD))), F.lit(0)) <= 2,
        "brackets": T.ratio(count_of(t, r"[{}]"), F.length(t)) < 0.025,
        "chars": F.length(F.regexp_replace(t, f"[{BLANK}]+", "")) >= 20,
        "sentences": count_of(t, SENTENCE_MARK).between(3, 7),
        "odd": ~t.rlike(T.ODD_CHARACTER),
    }
    view = T.view_of(t)
    cheap = {
        "spaces": T.remove_extra_spaces(t), "emoji": T.remove_emoji(t), "symbols": T.symbol_word_ratio(0.4)(view), "entity": T.html_entity()(view),
        "punc": T.no_punc(112)(view), "punc2": T.no_punc(2)(view), "brackets": T.curly_bracket(0.025)(view), "chars": T.char_number(20)(view),
        "sentences": T.sentence_number(3, 7)(view), "odd": T.special_character()(view),
    }
    unlike = df.select(*[F.count_if(~plain[n].eqNullSafe(cheap[n])).alias(n) for n in plain]).first().asDict()
    assert not any(unlike.values()), unlike


def test_a_single_blank_is_not_replaced():
    # A plain blank between words is no match, so texts of words are not built anew.
    pattern = str(T.remove_extra_spaces(F.col("text")))
    assert "&&[^ ]" in pattern
