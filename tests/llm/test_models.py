import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import cotraining, maskedlm


def sentences(n, rng):
    """A language with strong order: each word allows few successors."""
    after = {w: [f"w{(w * 7 + k) % 50}" for k in (1, 2)] for w in range(50)}
    out = []
    for _ in range(n):
        word, words = rng.randrange(50), []
        for _ in range(60):
            words.append(f"w{word}")
            word = int(rng.choice(after[word])[1:])
        out.append(" ".join(words))
    return out


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(1)
    context = rng.integers(0, maskedlm.CLASSES + 1, (4, 30)).astype(np.int16)
    target = rng.integers(0, maskedlm.CLASSES, 30).astype(np.int16)
    network = maskedlm.Network()
    exact = network.gradient(context, target)
    for at in [*rng.integers(0, len(network.values), 40), *np.flatnonzero(exact)[:: len(np.flatnonzero(exact)) // 40]]:
        step = []
        for d in (1e-2, -1e-2):
            values = network.values.copy()
            values[at] += d
            step.append(-maskedlm.Network(values).log_probabilities(context, target).mean())
        assert abs((step[0] - step[1]) / 2e-2 - exact[at]) < 3e-4


def test_learns_from_both_sides(spark):
    # The constants of production.
    rng = random.Random(3)
    rows = list(enumerate(sentences(6000, rng)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    classes, network = maskedlm.fit(df, "text", "doc_id")
    fresh = sentences(50, rng)
    mixed = [" ".join(rng.sample(t.split(), 60)) for t in fresh]
    test = spark.createDataFrame(list(enumerate(fresh + mixed)), "doc_id long, text string")
    got = {r.doc_id: r.mean_log_likelihood for r in maskedlm.score(test, "text", "doc_id", classes, network).collect()}
    ordered, shuffled = np.mean([got[i] for i in range(50)]), np.mean([got[i] for i in range(50, 100)])
    # Without context a word of 50 has log-probability -3.9.
    assert ordered > -2.5 and ordered > shuffled + 1


def test_layout_does_not_matter_and_training_gains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    means = []
    for parts in (4, 64):
        classes, network = maskedlm.fit(docs.repartition(parts), "text", "doc_id")
        rows = maskedlm.score(docs, "text", "doc_id", classes, network).collect()
        means.append({r.doc_id: r.mean_log_likelihood for r in rows if r.n_tokens})
    assert max(abs(means[0][i] - means[1][i]) for i in means[0]) < 0.05
    raw = maskedlm.Network.of_shares(classes.of.totals)
    rows = maskedlm.score(docs, "text", "doc_id", classes, raw).agg(F.sum("log_likelihood"), F.sum("n_tokens")).first()
    fitted = maskedlm.score(docs, "text", "doc_id", classes, network).agg(F.sum("log_likelihood")).first()[0]
    assert (fitted - rows[0]) / rows[1] > 0.5


def test_sum_over_all_tokens(docs, texts, nothing):
    classes, network = maskedlm.fit(docs, "text", "doc_id")
    counts = {r.word: r.n for r in classes.table.collect()}
    got = sorted((str(r.doc_id), r.n_tokens, r.log_likelihood, r.mean_log_likelihood) for r in
                 maskedlm.score(docs, "text", "doc_id", classes, network).collect() if r.n_tokens < 1000)
    want = []
    for i, t in texts:
        words, sizes = maskedlm.tokens([t or ""])
        if len(words) >= 1000:
            continue
        around = maskedlm.contexts(classes.of[words], sizes)
        shares = classes.of.shares(words, np.array([counts[int(w)] for w in words], dtype=float))
        total = float((network.log_probabilities(around, classes.of[words]) + shares).sum()) if len(words) else 0.0
        want.append((str(i), len(words), total, total / len(words) if len(words) else None))
    for a, b in zip(got, sorted(want, key=lambda r: (r[0], r[1]))):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-4)
        assert (a[3] is None) == (b[3] is None)
    assert sum(counts.values()) == classes.tokens
    for k in range(1, 5):
        assert maskedlm.contexts(np.arange(k), np.array([k])).shape == (4, k)
    classes, network = maskedlm.fit(nothing, "text", "doc_id")
    assert maskedlm.score(nothing, "text", "doc_id", classes, network).count() == 0


def corpus(rng, n):
    rows = []
    for i in range(n):
        bad = rng.random() < 0.3
        words = [f"w{rng.randrange(300)}" for _ in range(40)] + ([rng.choice(["spam", "junk", "fake"])] * 2 if bad else [])
        # The source tells as much as the words, on other rows.
        source = rng.choice(["dump", "dump", "news"]) if bad else "news"
        if bad and source == "dump" and rng.random() < 0.5:
            words = words[:40]
        rows.append((i, " ".join(words), source, len(words), int(not bad)))
    return rows


def test_cotraining_held_out(spark):
    rng = random.Random(5)
    rows = corpus(rng, 1500)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, good int")
    labels = df.filter("doc_id < 500").select("doc_id", "good")
    columns = cotraining.Columns("text", "doc_id", ["source"], ["size"])
    got = {r.doc_id: r for r in cotraining.cotrain(df.drop("good"), labels, columns, ["good"]).collect()}
    unseen = rows[500:]
    right = np.mean([(got[i].good_score >= 0.5) == bool(g) for i, *_, g in unseen])
    text = np.mean([(got[i].good_text >= 0.5) == bool(g) for i, *_, g in unseen])
    assert len(got) == 1500 and right > 0.93 and right > text


def test_cotraining_edges(spark, docs, texts, nothing):
    columns = cotraining.Columns("text", "doc_id", ["path"], ["n"])
    empty = spark.createDataFrame([], "doc_id long, good int")
    got = cotraining.cotrain(docs, empty, columns, ["good"]).collect()
    assert len(got) == len(texts) and all(0 <= r.good_score <= 1 for r in got)
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, 0), (None, 1), (7, None), (99, 0)], "doc_id long, good int")
    assert cotraining.cotrain(docs, labels, columns, ["good"]).count() == len(texts)
    assert cotraining.cotrain(nothing, labels, columns, ["good"]).count() == 0
    bare = docs.select(F.col("doc_id"), F.col("text"))
    assert cotraining.cotrain(bare, labels, cotraining.Columns("text", "doc_id", [], []), ["good"]).count() == len(texts)


def test_every_token_trains_and_every_word_counts(spark):
    rows = [(i, " ".join(f"v{i * 1000 + k}" for k in range(1000)) + " common" * 9) for i in range(300)] + [(300, "v7 " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    table = maskedlm.word_counts(df.select(F.col("text").alias("_text")))
    assert table.count() == 300_001 and table.agg(F.sum("n")).first()[0] == 300 * 1009 + 5
    assert {r.n for r in table.filter(F.col("word").isin([int(w) for w in maskedlm.tokens(["common v7"])[0]])).collect()} == {2700, 6}
    classes = maskedlm.classes_of(df, "text")
    # More words than tasks hold: some counts are joined.
    assert len(classes.of.words) < 300_001
    # Every token lies in one shard, and every shard in one round.
    documents = maskedlm.coded(df, "text", "doc_id", classes)
    shards = maskedlm.sharded(documents, 20 * maskedlm.SHARD_TOKENS).collect()
    assert {r.round for r in shards} == set(range(maskedlm.ROUNDS)) and len({r.shard for r in shards}) == len(shards)
    assert sum(map(sum, (r.sizes for r in shards))) == sum(len(r.classes) // 2 for r in shards) == classes.tokens == 300 * 1009 + 5
    network = maskedlm.learn(documents, classes)
    got = {r.doc_id: r.log_likelihood for r in maskedlm.score(df, "text", "doc_id", classes, network).collect()}
    for i in (0, 299, 300):
        words, sizes = maskedlm.tokens([rows[i][1]])
        around = maskedlm.contexts(classes.of[words], sizes)
        counts = {r.word: r.n for r in classes.table.filter(F.col("word").isin([int(w) for w in words])).collect()}
        shares = classes.of.shares(words, np.array([counts[int(w)] for w in words], dtype=float))
        want = (network.log_probabilities(around, classes.of[words]) + shares).sum()
        assert got[i] == pytest.approx(float(want), rel=1e-4)


def test_every_sure_document_teaches(spark):
    # 1,200 rows of each label that metadata is sure of; one word of each label stands in few of them, none labelled.
    rows = []
    for i in range(2600):
        good = i % 2
        words = [f"w{(i * 31 + k * 17) % 200}" for k in range(30)] + ([["late0", "late1"][good]] if i >= 200 and i % 20 < 2 else [])
        rows.append((i, " ".join(words), ["dump", "news"][good], 1, good))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, good int")
    columns = cotraining.Columns("text", "doc_id", ["source"], ["size"])
    width = [(1 << cotraining.TEXT_BITS) + cotraining.SHAPES, 1 << cotraining.META_BITS]
    table = columns.select(df.filter("doc_id >= 200"))
    weights = {("good", v): np.zeros(width[v], dtype=np.float32) for v in (0, 1)}
    news = cotraining.meta_features([["news"]], np.zeros((0, 1)))[1][0]
    weights["good", 1][news] = 20
    told = cotraining.lessons(table, columns, weights, {("good", 0): (1.0, 0.0), ("good", 1): (1.0, -10.0)})
    late = [cotraining.text_features([w])[1][0] for w in ("late0", "late1")]
    # 120 of 1,200 rows of one label and none of the other: all of them count, not the first 200.
    assert told["good", 0][late[1]] == pytest.approx(np.log(121 / 1)) and told["good", 0][late[0]] == pytest.approx(-np.log(121 / 1))
    # The text view is sure of nothing and teaches nothing.
    assert not told["good", 1].any()
    # And the whole: documents with these words get a view of their own by text alone.
    labels = df.filter("doc_id < 200").select("doc_id", "good")
    got = {r.doc_id: r.good_score for r in cotraining.cotrain(df.drop("good"), labels, columns, ["good"]).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(i % 2) for i in range(200, 2600)]) > 0.99


def test_a_row_may_have_labels_for_some_targets(spark):
    rng = random.Random(8)
    rows = corpus(rng, 900)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, good int")
    # No row has labels for both targets.
    good = F.when(F.col("doc_id") % 2 == 0, F.col("good"))
    bad = F.when(F.col("doc_id") % 2 == 1, 1 - F.col("good"))
    labels = df.filter("doc_id < 600").select("doc_id", good.alias("good"), bad.alias("bad"))
    columns = cotraining.Columns("text", "doc_id", ["source"], ["size"])
    got = {r.doc_id: r for r in cotraining.cotrain(df.drop("good"), labels, columns, ["good", "bad"]).collect()}
    for i, *_, g in rows:
        assert 0 <= got[i].good_score <= 1
    assert np.mean([(got[i].good_score >= 0.5) == bool(g) for i, *_, g in rows[600:]]) > 0.85
    assert np.mean([(got[i].bad_score < 0.5) == bool(g) for i, *_, g in rows[600:]]) > 0.85


def test_words_of_one_length_are_hashed_at_once(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh\u00e9\u4e2d.") for _ in range(rng.randrange(45))) for _ in range(4000)]
    want = [[cotraining.xxhash.xxh64_intdigest(w, seed) for w in words] for seed in (0, 1)]
    asked = []
    digest = cotraining.xxhash.xxh64_intdigest
    monkeypatch.setattr(cotraining.xxhash, "xxh64_intdigest", lambda w, seed=0: asked.append(w) or digest(w, seed))
    for seed in (0, 1):
        assert cotraining.hashes(cotraining.pa.array(words), seed).tolist() == want[seed]
        assert cotraining.hashes(cotraining.pa.array(words).slice(7), seed).tolist() == want[seed][7:]
    assert cotraining.hashes(cotraining.pa.array([], "string"), 0).tolist() == []
    # Only long words are asked for one by one.
    assert asked and all(len(w.encode()) >= 32 for w in asked)


def test_features_of_a_text_by_counting():
    texts = ["", " ", "One two. TWO, twofold\nOne two. \x1cx\u3000y\u0130", "a http://b.c 12\n\n{}", "....", "\n a b\t"]
    row, feature, value = cotraining.text_features(texts)
    width = 1 << cotraining.TEXT_BITS
    for i, text in enumerate(texts):
        counts, words = {}, text.lower().encode().split()
        for w in words:
            for h in (cotraining.xxhash.xxh64_intdigest(w.strip(b".,!?;:")), cotraining.xxhash.xxh64_intdigest(w.decode()[:5], 1)):
                counts[h % width] = counts.get(h % width, 0) + 1
        norm = np.sqrt(sum(np.log1p(c) ** 2 for c in counts.values()))
        own = (row == i) & (feature < width)
        assert dict(zip(feature[own].tolist(), value[own])) == pytest.approx({f: np.log1p(c) / norm for f, c in counts.items()})
        n, w, lines = max(len(text), 1), max(len(words), 1), text.split("\n")
        assert value[(row == i) & (feature >= width)] == pytest.approx([
            1, np.log1p(len(words)) / 5, len(set(words)) / w, n / w / 10, sum(c in "#*$%&|<>{}[]@\\~^=_" for c in text) / n * 10,
            sum(c in "0123456789" for c in text) / n * 5, sum(c in ".,!?" for c in text) / w, len(set(lines)) / len(lines),
            text.count("http") / w * 10,
        ])
