import numpy as np
from pyspark.sql import functions as F

from sluice.operators import modelstage as M
from sluice.operators import reasoning as A
from sluice.operators import similarity as N
from sluice.plans import recipes
from sluice.plans.queries import all_queries


def value(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first()["x"]


def test_scores_and_keys(spark):
    for text, score in {" 4\n": 4, "4": 4, "7": None, "four": None, "4.5": None, "": None}.items():
        assert value(spark, text, M.parse_int_score) == score
    keys = lambda c: M.has_keys(c, ["a", "b"])
    assert value(spark, '```json\n{"a": 1, "b": null}\n```', keys) is True
    assert value(spark, '{"a": 1}', keys) is False and value(spark, "[1]", keys) is False
    assert value(spark, "__import__('os')", keys) is False and value(spark, None, keys) is False


def test_failing_batch_marks_its_rows(spark):
    def model(prompts):
        if any("bad" in p for p in prompts):
            raise RuntimeError("no answer")
        return [p.upper() for p in prompts]

    df = M.render(spark.createDataFrame([("good",), ("bad",), ("good",)], "w string"), "say {w}", ["w"])
    requests = M.pending(df)
    assert requests.count() == 2
    got = {r["response"]: (r["ok"], r["error"]) for r in M.apply_model(requests, model, batch=1).collect()}
    assert got == {"SAY GOOD": (True, None), None: (False, "no answer")}


def test_chained_steps_send_each_request_once(spark, tmp_path):
    log = str(tmp_path / "sent")

    def model(prompts):
        with open(log, "a") as out:
            out.write("".join(p + "\n" for p in prompts))
        return [p + "!" for p in prompts]

    df = spark.createDataFrame([("a",), ("b",), ("a",)], "w string")
    for step in ("x", "y", "z"):
        df = M.model_step(df, f"{step} {{w}}", ["w"], model, step)
    assert df.count() == 3 and df.count() == 3
    assert sorted(open(log).read().split("\n")[:-1]) == ["x a", "x b", "y a", "y b", "z a", "z b"]


def test_stored_responses_are_not_sent_again(spark):
    def model(prompts):
        assert "say a" not in prompts
        return ["new"] * len(prompts)

    df = spark.createDataFrame([("a",), ("b",)], "w string")
    stored = M.render(df.filter("w = 'a'"), "say {w}", ["w"]).select("request_id", F.lit("old").alias("response"))
    got = M.model_step(df, "say {w}", ["w"], model, "out", responses=stored)
    assert {r["w"]: r["out"] for r in got.collect()} == {"a": "old", "b": "new"}


def test_rework_with_few_rows_uses_both_branches(spark):
    import json

    def scorer(prompts):
        return ["4" if json.loads(p).get("q", "").startswith(("n", "r")) else "2" for p in prompts]

    def refiner(prompts):
        return [json.dumps({"q": "r" + json.loads(p)["q"]}) for p in prompts]

    df = spark.createDataFrame([("n1",), ("x1",)], "q string")
    rows = sorted(r["q"] for r in recipes.score_and_rework(df, ["q"], scorer, refiner, refiner).collect())
    assert rows == ["n1", "rn1", "rx1"]
    assert [r["q"] for r in recipes.score_and_rework(df, ["q"], scorer, refiner, refiner, target=1).collect()] == ["rx1"]


def test_answers(spark):
    def check(fn, a, b):
        return spark.createDataFrame([(a, b)], "a string, b string").select(fn(F.col("a"), F.col("b")).alias("x")).first()["x"]

    assert check(A.ground_truth, r"so \boxed{1} or \boxed{ 0.50 }.", "0.5") is True
    assert check(A.ground_truth, "x", "y") is False and check(A.ground_truth, None, "y") is False
    assert check(A.match_answer, "I think $42$.", "42") is True and check(A.match_answer, "a", "") is False
    assert check(A.token_f1, "the cat sat sat", "a cat sat") == 2 * 2 / 5
    assert check(A.token_f1, "", "") == 0.0
    assert check(A.ngram_score, "a b", "c") == 1.0


def test_most_similar_blocks_equal_full_product(spark):
    rng = np.random.RandomState(5)
    centers = rng.randn(6, 16) * 3
    v = np.concatenate([c + rng.randn(60, 16) * 0.3 for c in centers]).astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id bigint, v array<float>")
    scores = v @ v.T
    np.fill_diagonal(scores, -np.inf)
    for rows in (20, 10_000):
        got = {r["id"]: r["similar_id"] for r in N.most_similar(df, "id", "v", block_rows=rows).collect()}
        assert [got[i] for i in range(len(v))] == scores.argmax(axis=1).tolist()


def test_blocks_travel_in_bundles(spark, monkeypatch):
    rng = np.random.RandomState(6)
    v = rng.randint(-3, 4, (900, 8)).astype(np.float32)
    v[500:600] = v[7]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(900, None)], "id bigint, v array<float>")
    written, write = [], N.durable
    monkeypatch.setattr(N, "durable", lambda t: written.append(write(t)) or written[-1])
    found = N.most_similar(df, "id", "v", block_rows=4)
    scores = v @ v.T
    np.fill_diagonal(scores, -np.inf)
    assert {r["id"]: r["similar_id"] for r in found.collect()} == dict(enumerate(scores.argmax(axis=1).tolist()))
    # All pairs of some hundred blocks are compared, but a block is sent to few places.
    sent = written[-1].selectExpr("count(*) as blocks", "max(size(targets)) as most").first()
    assert sent["blocks"] > 200 and sent["most"] <= N.LEAST_BUNDLES


def test_answers_of_single_prompts_leave_together(spark):
    requests = spark.range(500).selectExpr("string(id) as request_id", "string(id % 9) as prompt").coalesce(1)

    def model(prompts):
        if prompts == ["4"]:
            raise RuntimeError("none")
        return [p + "!" for p in prompts]

    out = M.apply_model(requests, model, batch=1)
    got = {(r.request_id, r.response, r.ok, r.error) for r in out.collect()}
    assert got == {(str(i), None, False, "none") if i % 9 == 4 else (str(i), f"{i % 9}!", True, None) for i in range(500)}


def test_k_center(spark):
    df = spark.createDataFrame([(0, [0.0]), (1, [10.0]), (2, [4.0]), (3, [10.0])], "id bigint, v array<float>")
    assert [r["id"] for r in N.k_center(df, "id", "v", 3).orderBy("rank").collect()] == [0, 1, 2]
    assert N.k_center(df, "id", "v", 9).count() == 4


def test_failed_requests_are_sent_once(spark):
    out = all_queries()["model_failed_requests"](spark, "/root/testdata/sf0.001")
    # The answers are stored before they are read twice.
    assert "MapInPandas" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert out.filter("answered").count() + out.filter("why = 'no answer'").count() == out.count()
