import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sluice.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = set()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in set(ids):
            out.add((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return out


def test_matches_brute_force(docs, texts):
    got = exact_dedup.exact_groups(docs, "text", "doc_id")
    assert {tuple(r) for r in got.collect()} == brute(texts)


@pytest.mark.parametrize("share", [1, 10**6])
def test_hot_and_cold_digests_agree(spark, monkeypatch, share):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", share)
    rows = [(i, f"text {i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = exact_dedup.exact_groups(df, "text", "doc_id", salts=4)
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_dedup_keeps_rows_whole(docs, nothing):
    kept = exact_dedup.exact_dedup(docs, "text", "doc_id")
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {2, 3, 5, 6, 7, 8, 9, 10, 11, 12}
    assert exact_dedup.exact_dedup(nothing, "text", "doc_id").count() == 0
    assert exact_dedup.exact_groups(nothing, "text", "doc_id").count() == 0


def test_two_texts_under_one_digest_stop_the_job(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("same"))
    with pytest.raises(Exception, match="share a digest"):
        exact_dedup.distinct_texts(docs, "text", "doc_id").collect()
