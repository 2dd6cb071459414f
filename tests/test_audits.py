import random

import numpy as np
from pyspark.sql import functions as F

from sluice.operators import contamination as C
from sluice.operators import neighbours as N
from sluice.operators import relational as R
from sluice.operators import relations, reports, scorer
from sluice.plans.queries import all_queries
from sluice.streaming import counters
from sluice.streaming.incremental import run_available, stream_text


def test_contamination_forms_agree(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 8, 20])))) for i in range(12)] + [(12, None), (13, "  ")]
    # One passage stands in two thirds of all documents.
    docs = [(i, " ".join(rng.choice(words) for _ in range(30)) + (" " + items[1][1].upper() if i % 3 else "") + " " + items[i % 12][1]) for i in range(90)]
    docs += [(90, None), (91, ""), (None, items[2][1])]

    def grams(text):
        found = (text or "").lower().split()
        return {tuple(found[i : i + 8]) for i in range(max(len(found) - 7, 1))} if found else set()

    want = {}
    for i, text in docs:
        for j, passage in items:
            both = len(grams(text) & grams(passage))
            if both:
                want[i, j] = (both, both / len(grams(passage)))
    d, t = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for limit in (0, 10_000):
        got = C.contamination(d, t, "doc_id", "item_id", broadcast_grams=limit)
        assert {(r.doc_id, r.item_id): (r.shared, r.share) for r in got.collect()} == want
    left = C.clean_documents(d, C.contamination(d, t, "doc_id", "item_id"), "doc_id").collect()
    assert {r.doc_id for r in left} == {i for i, _ in docs} - {i for (i, _), (_, s) in want.items() if s > 0.5 and i is not None}


def vectors(rng, rows, width=12):
    centres = rng.normal(size=(6, width))
    v = centres[rng.integers(0, 6, rows)] + 0.3 * rng.normal(size=(rows, width))
    return v / np.sqrt((v * v).sum(axis=1))[:, None]


def test_top_k_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "ROW_FLOATS", 400)
    monkeypatch.setattr(N, "QUERY_FLOATS", 100)
    monkeypatch.setattr(N, "RUN_BLOCKS", 3)
    v = vectors(np.random.default_rng(2), 300)
    v[50:60] = v[49]
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(300, None), (None, v[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {}
    for r in N.top_k_neighbours(df, "vec_id", "embedding", 5, F.col("vec_id") % 7 == 0).collect():
        got.setdefault(r.vec_id, {})[r["rank"]] = r.neighbour
    want = {}
    for i in range(0, 300, 7):
        scores = np.round(v @ v[i], N.DIGITS)
        order = sorted((j for j in range(300) if j != i), key=lambda j: (-scores[j], j))[:5]
        want[i] = dict(enumerate(order, 1))
    assert got == want
    assert N.top_k_neighbours(df.limit(0), "vec_id", "embedding").count() == 0
    few = N.top_k_neighbours(df.filter("vec_id < 3"), "vec_id", "embedding", 5)
    assert sorted((r.vec_id, r["rank"]) for r in few.collect()) == [(i, n) for i in range(3) for n in (1, 2)]


def test_hash_tables_reach_their_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = F.col("vec_id") % 50 == 0
    exact = N.top_k_neighbours(df, "vec_id", "embedding", 10, asked)
    found = N.approximate_neighbours(df, "vec_id", "embedding", 10, asked)
    assert N.recall(found, exact, "vec_id") >= 0.9
    # A third of all rows is one vector: as many results, all of them its copies.
    v = df.filter("vec_id = 0").first()["embedding"]
    copies = df.withColumn("embedding", F.when(F.col("vec_id") % 3 == 0, F.array(*[F.lit(x).cast("float") for x in v])).otherwise(F.col("embedding")))
    near = N.approximate_neighbours(copies, "vec_id", "embedding", 10, F.col("vec_id") == 3).orderBy("rank").collect()
    assert [r.neighbour for r in near] == [0, 6, 9, 12, 15, 18, 21, 24, 27, 30]
    assert N.approximate_neighbours(df.limit(0), "vec_id", "embedding").count() == 0


def test_hash_tables_shuffle_no_pairs(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 16)))]
    # Ids and vectors that come twice, a vector under two ids, and rows that neither ask nor answer.
    rows += rows[:40] + [(600, rows[3][1]), (None, rows[5][1]), (601, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = N.approximate_neighbours(df, "vec_id", "embedding", 4, F.col("vec_id") % 50 == 0, flips=6)
    # Vectors and lists of results are dealt, candidate pairs are not.
    made = found._jdf.queryExecution().optimizedPlan().toString()
    assert made.count("Join ") == 1 and "CoGroupsInPandas" in made
    exact = N.top_k_neighbours(df, "vec_id", "embedding", 4, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, exact.collect()))


def test_every_row_asks_for_its_neighbours(spark, tmp_path):
    v = vectors(np.random.default_rng(6), 130)
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(130, v[7].tolist()), (None, v[8].tolist()), (131, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    found = all_queries()["approximate_neighbours"](spark, str(tmp_path)).collect()
    ranks = {}
    for r in found:
        ranks.setdefault(r.vec_id, []).append(r["rank"])
    assert {i: sorted(r) for i, r in ranks.items()} == {i: list(range(1, 11)) for i in range(131)}
    assert all(r.neighbour != r.vec_id for r in found)


def test_scorer_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    assert scorer.held_out_auc(docs, labels, "doc_id", "text", "quality") > 0.9
    few = labels.unionByName(labels.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(1).alias("quality"), F.lit(None).cast("int").alias("toxic")).select(labels.columns))
    # A session that has observed something can't be sent along with a model.
    reports.watch(few, "labels seen")[0].count()
    model = scorer.train_scorer(docs, few, "doc_id", "text", "quality", iterations=5)
    odd = spark.createDataFrame([(1, None, 5), (2, "", 6)], "doc_id long, text string, label int")
    got = scorer.score_texts(model, odd, "text").collect()
    assert len(got) == 2 and all(0 <= r.score <= 1 for r in got) and [r.label for r in got] == [5, 6]


def test_rollup_tells_null_from_total(spark):
    df = spark.createDataFrame([("a", "x", "12345"), ("a", None, "1"), (None, "x", None)], "source string, lang string, text string")
    got = {(r.source, r.lang, r.grouping): (r.rows, r.characters) for r in reports.rollups(df, ["source", "lang"]).collect()}
    assert got == {
        ("a", "x", 0): (1, 5), ("a", None, 0): (1, 1), (None, "x", 0): (1, 0), ("a", None, 1): (2, 6), (None, None, 1): (1, 0),
        (None, None, 3): (3, 6),
    }
    bands = df.select(reports.length_band(F.col("text"), [2, 5]).alias("b")).collect()
    assert [r.b for r in bands] == [2, 0, None]


def test_sketches_unite(spark):
    rows = [(f"s{i % 3}", " ".join(f"w{(i * 37 + j) % 5000}" for j in range(40))) for i in range(500)]
    df = spark.createDataFrame(rows, "source string, text string")
    parts = reports.vocabulary_sketches(df, "source", "text", r"\w+")
    together = reports.vocabulary_sketches(df.withColumn("source", F.lit("all")), "source", "text", r"\w+")
    one, whole = reports.estimated(reports.united(parts)).first(), reports.estimated(together).first()
    assert one.words == whole.words == 20_000 and abs(one.distinct_words - whole.distinct_words) <= 1
    exact = len({w for _, t in rows for w in t.split()})
    assert abs(one.distinct_words / exact - 1) < 0.03


def test_split_audit_counts_copies(spark):
    whole = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "text string")
    parts = {"train": spark.createDataFrame([("a",), (None,)], "text string"), "test": spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "text string")}
    got = {r.finding: r.rows for r in R.audit_split(whole, parts, ["text"]).collect()}
    assert got == {"lost": 0, "added": 1, "leaked test train": 2}
    parts["test"] = parts["test"].filter("text = 'b'")
    got = {r.finding: r.rows for r in R.audit_split(whole, parts, ["text"]).collect()}
    assert got == {"lost": 2, "added": 0, "leaked test train": 0}


def test_relations_in_circles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("a", "b"), (None, "x"), ("d", None)], "subject string, object string")
    starts = spark.createDataFrame([("a",), ("d",), (None,), ("q",), ("a",)], "start string")
    got = sorted((r.start, r.entity, r.hops) for r in relations.related_entities(starts, edges).collect())
    assert got == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("a", "d", 3), ("d", "d", 0), ("q", "q", 0)]
    near = relations.related_entities(starts, edges, hops=1).collect()
    assert sorted((r.start, r.entity) for r in near) == [("a", "a"), ("a", "b"), ("d", "d"), ("q", "q")]


def test_late_rows_and_streamed_sessions(spark, tmp_path):
    def rows(*found):
        return spark.createDataFrame([(u, f"2024-01-01 {t}") for u, t in found], "user_id long, t string").select(
            "user_id", F.to_timestamp("t").alias("ts"))

    def deliver(part):
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream_text(spark, f"{tmp_path}/in", part.schema)
        counters.split_late(stream, "ts", f"{tmp_path}/out", f"{tmp_path}/late", f"{tmp_path}/state")

    deliver(rows((1, "10:00:00"), (1, "09:00:00"), (2, "10:00:00")))
    deliver(rows((1, "09:49:59"), (1, "09:50:00"), (1, "10:29:59"), (2, "10:30:00"), (2, "11:00:01")))
    late = [str(r.ts)[11:] for r in spark.read.parquet(f"{tmp_path}/late").collect()]
    assert late == ["09:49:59"]
    found = spark.read.parquet(f"{tmp_path}/out")
    got = sorted((r.user_id, str(r.start)[11:], r.rows) for r in counters.sessions(found, "ts", "user_id").collect())
    assert got == [(1, "09:00:00", 1), (1, "09:50:00", 3), (2, "10:00:00", 2), (2, "11:00:01", 1)]
    # As a stream: sessions come out once the watermark has passed their end.
    found.select("user_id", "ts").coalesce(1).write.parquet(f"{tmp_path}/in2/a")
    rows((9, "23:00:00")).write.parquet(f"{tmp_path}/in2/b")
    stream = stream_text(spark, f"{tmp_path}/in2/*", found.select("user_id", "ts").schema, files_per_batch=1)
    run_available(counters.sessions(stream, "ts", "user_id"), f"{tmp_path}/closed", f"{tmp_path}/state2")
    closed = sorted((r.user_id, str(r.start)[11:], r.rows) for r in spark.read.parquet(f"{tmp_path}/closed").collect())
    assert closed == got
