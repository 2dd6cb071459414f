import random
import re
from collections import Counter

import numpy as np

from sluice.llm import repetition


def brute(text, lengths):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    out = {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "line_chars": sum(map(len, lines)),
        "dup_line_chars": sum(map(len, lines)) - sum(map(len, set(lines))),
    }
    for n in {3, *lengths}:
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        times, seen, inside, again = Counter(grams), set(), set(), set()
        for i, g in enumerate(grams):
            if times[g] > 1:
                inside |= set(range(i, i + n))
            if g in seen:
                again |= set(range(i, i + n))
            seen.add(g)
        if n == 3:
            out["n_repeat_words"] = len(inside)
        if n in lengths:
            out[f"dup_chars_{n}"] = sum(len(words[i]) for i in again)
    return out


def test_counts_match_brute_force(texts):
    rng = random.Random(2)
    some = [t or "" for _, t in texts if len(t or "") < 10_000]
    some += [" ".join(rng.choice("aé b\nc #d e$".split(" ")) for _ in range(rng.randrange(80))) for _ in range(200)]
    got = repetition.measure(some, [4, 5, 7])
    for i, text in enumerate(some):
        assert {k: int(v[i]) for k, v in got.items()} == brute(text, [4, 5, 7]), text


def test_colliding_hashes_mark_nothing(monkeypatch):
    monkeypatch.setattr(repetition, "_BASE", np.uint64(0))
    got = repetition.measure(["a b c d e f g h a b c x", "a b c d"], [5])
    assert got["n_repeat_words"].tolist() == [6, 0]


def test_verdicts(spark, docs, texts, nothing):
    clean = " ".join(f"w{i}" for i in range(200))
    rows = [(1, clean), (2, "same words again and again " * 40), (3, "short"), (4, None), (5, (clean + "\n") * 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in repetition.repetition(df, "text", "doc_id").collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (True, False), 4: (True, False), 5: (True, False)}
    found = repetition.repetition(docs, "text", "doc_id")
    assert found.count() == len(texts)
    kept = repetition.keep_good(docs, "text")
    assert kept.columns == docs.columns
    assert kept.count() == found.filter("kept").count()
    assert repetition.repetition(nothing, "text", "doc_id").count() == repetition.keep_good(nothing, "text").count() == 0
