import random

from pyspark.sql import functions as F

from sluice.operators import dedup as D
from sluice.operators.skew import hot_keys, skew_join


def grams(text, n=5):
    w = text.lower().split()
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or {text.lower()}


def brute(rows, threshold):
    out = []
    for i, (key, text) in enumerate(rows):
        mine = grams(text)
        for _, earlier in rows[:i]:
            theirs = grams(earlier)
            if len(mine & theirs) / len(mine | theirs) >= threshold:
                out.append(key)
                break
    return sorted(out)


def corpus(seed=3, families=6, size=25):
    """Families of near copies at very different distances, plus exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += ["", "", "short text", "short text", "Short  Text"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_minhash_equals_brute_force_under_skew(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, "id bigint, text string")
    for threshold in (0.9, 0.6):
        # One row per band makes nearly everything a candidate.
        got = D.minhash_duplicates(df, "text", "id", threshold=threshold, bands=128)
        assert sorted(r["id"] for r in got.collect()) == brute(rows, threshold)


def test_minhash_default_finds_close_copies(spark):
    rows = corpus(seed=5)
    df = spark.createDataFrame(rows, "id bigint, text string")
    got = {r["id"] for r in D.minhash_duplicates(df, "text", "id").collect()}
    expected = set(brute(rows, 0.9))
    assert got <= expected and len(expected - got) <= 1
    again = D.minhash_dedup(df, "text", "id")
    assert D.minhash_duplicates(again, "text", "id").count() == 0


def test_bucket_of_unlike_rows_takes_a_fixed_number_of_jobs(spark, monkeypatch):
    """Rows that share a long phrase, and so bands, but not enough to be copies."""
    written = []
    keep = D.durable
    monkeypatch.setattr(D, "durable", lambda df: written.append(1) or keep(df))
    counts = []
    for n in (200, 4000):
        phrase = F.concat_ws(" ", *[F.lit(f"p{i}") for i in range(30)])
        own = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.concat(F.lit("w"), F.xxhash64("id", i).cast("string"))), " ")
        df = spark.range(n).select("id", F.concat_ws(" ", phrase, own).alias("text"))
        written.clear()
        # One row per band: the phrase makes all rows share bands.
        assert D.minhash_duplicates(df, "text", "id", num_perm=32, bands=32).count() == 0
        counts.append(len(written))
    assert counts[0] == counts[1]


def test_exact(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, "a")], "id int, t string")
    assert sorted(r["id"] for r in D.exact_dedup(df, "t", "id").collect()) == [1, 2, 4]
    marked = {r["id"]: r["is_duplicate"] for r in D.exact_duplicates(df, "t", "id").collect()}
    assert marked == {1: False, 2: False, 3: True, 4: False, 5: True}


def greedy(rows, threshold):
    kept = []
    for key, text in rows:
        letters = set(text.lower())
        if not text or not any(len(letters & k) / len(letters | k) > threshold for _, k in kept if k):
            kept.append((key, letters))
    return [k for k, _ in kept]


def test_charset_greedy_over_many_blocks(spark):
    rng = random.Random(11)
    rows = [(i, "".join(rng.sample("abcdefghijklmnopqrstuvwxyz水文雨河", rng.randint(5, 28)))) for i in range(300)]
    df = spark.createDataFrame(rows, "id bigint, t string")
    for block in (7, 1024):
        got = D.charset_dedup(df, "t", "id", threshold=0.7, block=block)
        assert sorted(r["id"] for r in got.collect()) == greedy(rows, 0.7)


def test_skew_join_spreads_hot_key(spark):
    left = spark.range(10_000).select(F.when(F.col("id") < 6000, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    hot = hot_keys(left, ["k"], floor=100)
    assert [r["k"] for r in hot.collect()] == [0]
    joined = skew_join(left, right, ["k"], hot=hot, salts=8)
    assert joined.count() == 10_000 and joined.filter("w <> k * 2").count() == 0
