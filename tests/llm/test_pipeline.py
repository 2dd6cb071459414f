import random

from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tools.compare import compare

SF = "/root/testdata/sf0.001"
WORDS = [f"term{i}" for i in range(400)]


def test_names():
    found = queries()
    assert [n for n in found if n.startswith("op")] and "pipeline" in found
    assert len({n.split("_")[0] for n in found if n.startswith("op")}) == 13


def test_queries_with_a_twin(spark):
    for name in ("op1_quotation_linking", "op7_exact_dedup", "op12_threshold_sketch"):
        verdict, _, _ = compare(spark, name, queries()[name], oracle_sql()[name], SF)
        assert verdict.startswith("ok"), verdict


def document(seed, n=120):
    return " ".join(random.Random(seed).sample(WORDS, n))


def test_stages_take_effect(spark):
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [
        (1, document(1)), (2, document(2)), (3, document(2)), (4, document(4) + " extra"), (5, document(4) + " extra word"),
        (6, "too short"), (7, "same line of words again\n" * 60), (8, document(8) + " " + passage),
        (9, document(9) + " " + passage), (10, None), (11, ""),
    ]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = df
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == df.columns and dict(left.dtypes) == dict(df.dtypes)
        kept.append({r.doc_id: r for r in left.collect()})
    assert set(kept[0]) == {1, 2, 3, 4, 5, 8, 9}
    assert set(kept[1]) == {1, 3, 4, 5, 8, 9}
    assert {1, 3, 8, 9} <= set(kept[2]) and 4 in kept[2]
    assert passage in kept[3][8].text and passage not in kept[3][9].text
    assert all(r.n_chars == len(r.text) for r in kept[3].values())
    places = corpus_pipeline.STAGES[-1][1](spark, left, SF).collect()
    assert {r.doc_id for r in places} == set(kept[3])
    nothing = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).count() == 0


def test_odd_rows_pass_every_stage(spark):
    """Null and repeated ids, repeated rows, long texts and clashing columns: nothing clean is lost."""
    long = " ".join(f"long{i}" for i in range(30_000))
    rows = [
        (None, document(21)), (None, document(22)), (1, document(23)), (2, long), (3, document(24)), (3, document(25)),
        (4, document(26)), (4, document(26)), (None, document(23)), (5, "ünï ☃ " + document(27)), (6, None), (7, ""),
    ]
    clash = ["kept", "removed", "n_bytes", "_id", "_text", "fp", "digest", "rank", "id", "chunk", "rows", "sequence_id", "offset", "_bin"]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df = df.select("*", *[F.lit(f"own {c}").alias(c) for c in clash])
    left = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == df.columns
    found = left.collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(
        [(i, t) for i, t in rows if t and (i, t) != (None, document(23))], key=str
    )
    assert all(r[c] == f"own {c}" for r in found for c in clash)
    places = corpus_pipeline.STAGES[-1][1](spark, left, SF).collect()
    assert len({(r.sequence_id, r.offset) for r in places}) == len(places) and sum(r.piece == 0 for r in places) == len(found)


def test_near_copies_by_row(spark):
    near = document(31, 200)
    rows = [(5, near), (3, near + " more"), (None, near + " else"), (3, document(32, 200)), (None, document(33, 200))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in corpus_pipeline.near_copies(spark, df, SF).collect()}
    assert len(got) == len(simhash_groups(rows)) and (3, near + " more") in got and (None, document(33, 200)) in got


def simhash_groups(rows):
    from sluice.llm import simhash

    found = [simhash.fingerprint(t.encode()) for _, t in rows]
    groups = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (found[i] ^ found[j]).bit_count() <= 2:
                groups = [groups[j] if g == groups[i] else g for g in groups]
    return set(groups)


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert 0 < out.count() and {"doc_id", "sequence_id", "offset"} <= set(out.columns)
