"""Cleaning and scores that look only where something can be found give what the plain patterns give."""

from __future__ import annotations

import random
import re
import unicodedata

from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import BLANK, BLANKS, is_blank, strip
from sluice.operators import cleaning as C
from sluice.operators import quality as Q
from sluice.operators.contamination import contamination

ALPHABET = " \t\n\r  .,;:!?()1234ab\xa0　 水文库。，地下位\x01\x85"


def _rows(spark, n=600, seed=5, letters=ALPHABET, most=40):
    pick = random.Random(seed)
    texts = ["".join(pick.choices(letters, k=pick.randrange(most))) for _ in range(n)]
    texts += [None, "", " ", "　\n", "a", "x" * 9, "x" * 10, " " + "x" * 9 + " " * 50, "ab " * 900, "".join(map(chr, range(33, 64))) * 90]
    texts += ["z" * 3000 + "".join(map(chr, range(97, 97 + k))) for k in (3, 4, 5, 26)]
    texts += ["z" * 3000 + "".join(map(chr, range(0x3B1, 0x3B1 + k))) for k in (28, 29, 30, 31)]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")


def _same(df, made, plain):
    bad = df.withColumn("made", made).withColumn("plain", plain).filter(~F.col("made").eqNullSafe(F.col("plain"))).collect()
    assert not bad, bad[:3]


def _replaced(text, rules):
    for pattern, new in rules:
        text = F.regexp_replace(text, pattern, new)
    return text


def test_steps_equal_the_plain_patterns(spark):
    df, t = _rows(spark).repartition(2), F.col("t")
    ends = rf"\A[{BLANK}]+|[{BLANK}]+\z"
    _same(df, strip(t), F.regexp_replace(t, ends, ""))
    _same(df, is_blank(t), F.regexp_replace(t, ends, "") == "")
    _same(df, C.normalize_newlines(t), F.regexp_replace(t, "\r\n?", "\n"))
    _same(df, C.collapse_blanks(t, True), _replaced(t, [(r"[ \t]+", " "), (r"\n+", "\n")]))
    _same(df, C.collapse_marks(t), _replaced(t, C.TAIL))
    _same(df, C.trim_ws(t), _replaced(t, [(r"[ \t]+", " "), (r"\n[ \t]+", "\n"), (r"[ \t]+\n", "\n"), (ends, "")]))
    _same(df, C.fix_common(t), _replaced(t, [
        (r" +([.,;:!?])", "$1"), (r"([.,;:!?]) +", "$1 "), (r"(\p{Nd}),(\p{Nd}{3})", "$1$2"),
        (rf"\([{BLANK}]*", "("), (rf"[{BLANK}]*\)", ")"),
    ]))


def test_all_blanks_are_listed():
    blank = {c for c in map(chr, range(0x110000)) if unicodedata.category(c)[0] == "Z"} | set("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85")
    assert set(BLANKS) == blank


def test_gate_equals_counts_of_all_characters(spark):
    df, t = _rows(spark), F.col("t")
    distinct = F.size(F.array_distinct(F.split(t, "")))
    short = F.length(F.regexp_replace(t, rf"\A[{BLANK}]+|[{BLANK}]+\z", "")) < 10
    rich = (F.length(t) > 100) & (distinct > 30)
    plain = ~short & ~((distinct < 5) & (F.length(t) > 20)) & (t.rlike(f"[{V.GATE_CHARACTERS}]") | rich)
    _same(df, C.quality_gate(t), plain)


def test_domain_counts_equal_the_loop_over_the_list(spark):
    vocabulary = [*V.DOMAIN_VOCABULARY, "Flow", "ab"]
    df = _rows(spark, letters="水文库地下位流量表枯期丰aBFlow 。1\x01\n", most=30)
    for r in df.select("t", Q.domain_counts(F.col("t"), vocabulary).alias("n")).collect():
        if r.t is None:
            assert r.n is None
            continue
        words, low = re.findall("[一-鿿]+|[a-zA-Z]+", r.t), [v.lower() for v in vocabulary]
        good = sum(any(v in w.lower() or w.lower() in v for v in low) for w in words)
        assert tuple(r.n) == (sum(v in r.t.lower() for v in low), len(words), good), r


def test_relevance_asks_no_pattern_of_the_whole_list(spark):
    plan = _rows(spark).select(Q.relevance(F.col("t")))._jdf.queryExecution().toString()
    assert "|".join(V.DOMAIN_VOCABULARY[:3]) not in plan


def test_grams_are_worked_out_once_when_items_are_joined(spark, monkeypatch):
    from sluice.operators import contamination as module

    seen = []
    keys = module.hot_keys
    monkeypatch.setattr(module, "hot_keys", lambda df, *a, **k: seen.append(df) or keys(df, *a, **k))
    docs = spark.createDataFrame([(1, "a b c d"), (2, "b c d e"), (3, None), (1, "a b c d")], "d int, text string")
    items = spark.createDataFrame([(7, "a b c d e")], "k int, text string")
    found = contamination(docs, items, "d", "k", n=3, broadcast_grams=0)
    assert {(r.d, r.k, r.shared) for r in found.collect()} == {(1, 7, 2), (2, 7, 2)}
    assert "regexp_extract_all" not in seen[0]._jdf.queryExecution().toString()
