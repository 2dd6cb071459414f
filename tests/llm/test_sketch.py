import hashlib
import re

from pyspark.sql import functions as F

from sluice.llm import queries, sketch


def shingles(text, words=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {" ".join(found[i : i + words]) for i in range(max(len(found) - words + 1, 1))} if found else set()


def brute(text, fraction=0.125):
    hashes = sorted(hashlib.md5(s.encode()).hexdigest() for s in shingles(text))
    below = [h for h in hashes if int(h, 16) < fraction * 16**32]
    return sorted({h[:16] for h in below or hashes[:1]})


def digest(i, text):
    return hashlib.md5(f"{'' if i is None else i}|{text}".encode()).hexdigest()


def like(a, b):
    least = min(len(a), len(b))
    return len(set(a) & set(b)) / least if least else float(len(a) == len(b))


def test_query_against_brute_force(spark, docs, texts, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted({(i, t or "") for i, t in texts}, key=lambda r: (r[0] is not None, r[0], digest(*r)))
    want = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, other, following = brute(text), brute(edited), brute(after)
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), "".join(own), "".join(other), like(own, other), like(own, following)))
    got = [tuple(r) for r in queries.QUERIES["op12_threshold_sketch"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_sketches_merge_and_estimate_containment(spark):
    part = " ".join(f"w{i}" for i in range(2000))
    rows = [(part, part + " " + " ".join(f"v{i}" for i in range(30_000))), (part, " ".join(f"v{i}" for i in range(3000)))]
    df = spark.createDataFrame(rows, "a string, b string")
    a, b = sketch.sketch(F.col("a")), sketch.sketch(F.col("b"))
    inside, outside = df.select(sketch.contained(a, b).alias("c"), sketch.contained(b, a).alias("r"), sketch.likeness(a, b).alias("l")).collect()
    assert (inside.c, inside.l) == (1.0, 1.0) and 0.04 < inside.r < 0.09
    assert (outside.c, outside.l) == (0.0, 0.0)
    # The sketch of a whole is the union of its parts' sketches and of the shingles across the seam.
    both = df.select(a.alias("a"), b.alias("b"), sketch.sketch(F.concat_ws(" ", "a", "b")).alias("w"), sketch.merged(a, b).alias("m")).collect()
    for r in both:
        assert set(r.m) <= set(r.w) and len(r.w) - len(r.m) <= 4 and r.m == sorted(set(r.a) | set(r.b))


def test_one_and_no_document(spark, nothing):
    one = spark.createDataFrame([(7, "a b c d e f g h")], "doc_id long, text string")
    (row,) = sketch.edited_pairs(one, "text", "doc_id").collect()
    assert row.edited == "a b c d a b c d"[:8] + "a b c d" and row.next_hashes == row.hashes
    assert sketch.edited_pairs(nothing, "text", "doc_id").count() == 0
    assert sketch.fingerprints(nothing, "text", "doc_id").count() == 0


def test_no_python_in_the_plan(spark, docs):
    plan = sketch.edited_pairs(docs, "text", "doc_id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
