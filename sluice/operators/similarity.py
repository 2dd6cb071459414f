"""Vectors: most similar row, diverse choice, group representative, hashed embedding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import WORD_CHARS, find_all, let
from sluice.session import durable

BLOCK_FLOATS = 1 << 20
# Blocks travel in bundles of at most so many floats; of few rows, too, there are bundles enough for many tasks.
BUNDLE_FLOATS, LEAST_BUNDLES = 1 << 22, 4
# Scores that a task holds at once.
SCORES = 1 << 21
MAX_SUMMARY_FLOATS = 1 << 24


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def squared_distance(a: Column, b: Column) -> Column:
    diffs = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x * x)


def most_similar(df: DataFrame, id_col: str, vector_col: str, block_rows: int | None = None) -> DataFrame:
    """For every row the other row with the largest dot product; exact.

    Rows are grouped with their nearest pivot and cut into blocks of a few
    megabytes. Each block finds its own best matches first, which gives a lower
    bound; a pair of blocks is compared only if centre and radius of the two
    allow a better match. Blocks travel in bundles of some megabytes: a task
    meets two bundles and compares those of their blocks that need it, so what
    is shuffled grows with the number of bundles, not of pairs of blocks.
    Comparisons are matrix products inside tasks and only the best match per
    row leaves a task. Ties go to the smaller id.
    """
    rows = df.filter(F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>").alias("v")
    )
    rows = durable(rows)
    total = rows.count()
    head = rows.first()
    if head is None:
        return rows.select(F.col("id").alias(id_col), F.col("id").alias("similar_id"), F.lit(0.0).alias("score"))
    width = len(head["v"])
    # The block table is read whole by each task, so its size is held below a limit.
    most_blocks = max(1, MAX_SUMMARY_FLOATS // (width + 4))
    size = max(block_rows or max(1, BLOCK_FLOATS // width), -(-total // most_blocks))
    wanted = max(1, min(256, total // size))
    pivots = [r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(wanted).select("v").collect()]
    placed = rows.withColumn("cluster", _nearest(pivots)(F.col("v")))
    counts = placed.groupBy("cluster").count()  # at most 256 rows
    splits = F.broadcast(counts.select("cluster", F.ceil(F.col("count") / size).cast("int").alias("parts")))
    placed = placed.join(splits, "cluster").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    packed = durable(
        placed.groupBy("cluster", "part").applyInPandas(
            _pack(), "block string, cluster int, part int, ids array<long>, flat array<float>, center array<float>, radius float, "
                     "best array<float>, best_id array<long>"
        )
    )
    own = packed.select(F.inline(F.arrays_zip(
        F.col("ids").alias("id"), F.col("best").alias("score"), F.col("best_id").alias("other"))))
    own = own.toDF("id", "score", "other").filter("other is not null")
    summary = packed.select("block", "cluster", "part", "center", "radius").toPandas()
    if len(summary) > 1:
        # Blocks of a cluster stay together, so that bundles far apart need not meet.
        summary = summary.sort_values(["cluster", "part"], ignore_index=True)
        bundles = min(len(summary), max(LEAST_BUNDLES, -(-total * width // BUNDLE_FLOATS)))
        summary["bundle"] = summary.index * bundles // len(summary)
        links = durable(packed.mapInPandas(_links(summary), "block string, bundle int, targets array<int>"))
        met = links.select("bundle", F.explode("targets").alias("target")).distinct()
        blocks = packed.join(links.select("block", "bundle"), "block").select("block", "bundle", "ids", "flat", "best", "center", "radius")
        left = blocks.join(met, "bundle")
        met = met.select(F.col("bundle").alias("bundle_t"), F.col("target").alias("target_t"))
        right = blocks.select(F.col("bundle").alias("target_t"), *[F.col(c).alias(f"{c}_t") for c in ("block", "ids", "flat", "center", "radius")])
        right = right.join(met, "target_t")
        crossed = left.groupBy("bundle", "target").cogroup(right.groupBy("bundle_t", "target_t")).applyInPandas(_compare(), "id long, score float, other long")
        own = own.unionByName(crossed)
    best = own.groupBy("id").agg(F.max(F.struct(F.col("score"), (-F.col("other")).alias("neg"))).alias("b"))
    return best.select(
        F.col("id").alias(id_col), (-F.col("b.neg")).alias("similar_id"), F.col("b.score").cast("double").alias("score")
    )


def _nearest(pivots: list):
    table = np.asarray(pivots, dtype=np.float32)
    norms = (table * table).sum(axis=1)

    @F.pandas_udf("int")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            v = np.stack(batch.to_numpy()).astype(np.float32)
            yield pd.Series((norms[None, :] - 2 * v @ table.T).argmin(axis=1).astype(np.int32))

    return nearest


def _pack():
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        ids = frame["id"].to_numpy()
        v = np.stack(frame["v"].to_numpy()).astype(np.float32)
        center = v.mean(axis=0)
        radius = float(np.sqrt(((v - center) ** 2).sum(axis=1)).max())
        best = np.full(len(ids), -np.inf, dtype=np.float32)
        other: list = [None] * len(ids)
        if len(ids) > 1:
            for at in range(0, len(ids), 1024):
                scores = v[at : at + 1024] @ v.T
                scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
                top = scores.argmax(axis=1)
                best[at : at + 1024] = scores[np.arange(len(scores)), top]
                other[at : at + 1024] = [int(ids[t]) for t in top]
        cluster, part = frame["cluster"].iloc[0], frame["part"].iloc[0]
        return pd.DataFrame({"block": [f"{cluster}-{part}"], "cluster": [cluster], "part": [part], "ids": [ids], "flat": [v.ravel()], "center": [center],
                             "radius": [radius], "best": [best], "best_id": [other]})

    return pack


def _allowed(center, radius: float, best, centers: np.ndarray, radii: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Which blocks may hold a better match for a row of the block given first."""
    c = np.asarray(center, dtype=np.float64)
    bound = centers @ c + np.sqrt((c**2).sum()) * radii + lengths * radius + radii * radius
    return bound * (1 + 1e-4) + 1e-4 >= np.min(best)


def _links(summary: pd.DataFrame):
    names, bundles = summary["block"].to_numpy(), summary["bundle"].to_numpy()
    bundle_of = dict(zip(names, bundles))
    centers = np.stack(summary["center"].to_numpy()).astype(np.float64)
    radii = summary["radius"].to_numpy(dtype=np.float64)
    lengths = np.sqrt((centers**2).sum(axis=1))

    def links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, center, radius, best in zip(frame["block"], frame["center"], frame["radius"], frame["best"]):
                need = _allowed(center, radius, best, centers, radii, lengths) & (names != name)
                yield pd.DataFrame({"block": [name], "bundle": [bundle_of[name]], "targets": [np.unique(bundles[need])]})

    return links


def _compare():
    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        sizes = [len(ids) for ids in right["ids_t"]]
        ids_t, number = np.concatenate(right["ids_t"].to_list()), np.repeat(np.arange(len(right)), sizes)
        # In the order of ids, so that of equal scores the first counts.
        order = np.argsort(ids_t, kind="stable")
        t = np.concatenate(right["flat_t"].to_list()).astype(np.float32, copy=False).reshape(len(ids_t), -1)[order]
        ids_t, number = ids_t[order], number[order]
        centers, radii = np.stack(right["center_t"].to_list()).astype(np.float64), right["radius_t"].to_numpy(dtype=np.float64)
        lengths, names = np.sqrt((centers**2).sum(axis=1)), right["block_t"].to_numpy()
        for name, ids, flat, floor, center, radius in zip(*(left[c] for c in ("block", "ids", "flat", "best", "center", "radius"))):
            ids, floor = np.asarray(ids), np.asarray(floor, dtype=np.float32)
            v = np.asarray(flat, dtype=np.float32).reshape(len(ids), -1)
            # A block was compared with itself before.
            need = _allowed(center, radius, floor, centers, radii, lengths) & (names != name)
            places = np.flatnonzero(need[number])
            for at in range(0, len(v), 1024):
                rows = v[at : at + 1024]
                score, other = np.full(len(rows), -np.inf, dtype=np.float32), np.zeros(len(rows), dtype=np.int64)
                step = max(1, SCORES // len(rows))
                for begin in range(0, len(places), step):
                    here = places[begin : begin + step]
                    scores = rows @ t[here].T
                    top = scores.argmax(axis=1)
                    found = scores[np.arange(len(rows)), top]
                    better = found > score
                    score[better], other[better] = found[better], ids_t[here][top[better]]
                good = (score >= floor[at : at + 1024]) & (score > -np.inf)
                out.append(pd.DataFrame({"id": ids[at : at + 1024][good], "score": score[good], "other": other[good]}))
        return pd.concat(out, ignore_index=True)

    return compare


def with_most_similar_text(df: DataFrame, id_col: str, vector_col: str, text_col: str,
                           output: str = "most_similar_problem", **options) -> DataFrame:
    """The text of the most similar row next to each row; rows without a vector go."""
    pairs = most_similar(df, id_col, vector_col, **options).select(id_col, "similar_id")
    texts = df.select(F.col(id_col).alias("similar_id"), F.col(text_col).alias(output))
    return df.join(pairs, id_col).join(texts, "similar_id").drop("similar_id")


def k_center(df: DataFrame, id_col: str, vector_col: str, k: int = 5, start=None) -> DataFrame:
    """``k`` ids chosen greedily, each farthest from those before; starts at the smallest id.

    A round is one job over the stored vectors: one aggregate finds the farthest
    row, the smaller id on ties, and brings its vector along. The running
    distance to the nearest centre is written out now and then to keep the plan short.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    open_rows = durable(rows.filter("id is not null and v is not null")).withColumn("near", F.lit(float("inf")))
    begin = open_rows if start is None else open_rows.filter(F.col("id") == start)
    farthest = F.min(F.struct((-F.col("near")).alias("far"), "id", "v")).alias("row")
    chosen: list[tuple] = []
    current = begin.agg(farthest).first()["row"]
    while current is not None:
        chosen.append((len(chosen), current["id"]))
        if len(chosen) == k:
            break
        center = F.array(*[F.lit(float(x)) for x in current["v"]])
        open_rows = open_rows.filter(F.col("id") != current["id"]).withColumn(
            "near", F.least("near", squared_distance(F.col("v"), center))
        )
        if len(chosen) % 8 == 0:
            open_rows = durable(open_rows)
        current = open_rows.agg(farthest).first()["row"]
    return df.sparkSession.createDataFrame(chosen, f"rank int, {id_col} {df.schema[id_col].dataType.simpleString()}")


def group_centroids(df: DataFrame, group_col: str, vector_col: str) -> DataFrame:
    """Mean vector per group, of any width; partial sums of each place combine before the shuffle."""
    places = df.select(group_col, F.posexplode(vector_col).alias("_at", "_x"))
    means = places.groupBy(group_col, "_at").agg(F.avg(F.col("_x").cast("double")).alias("_mean"))
    # A group has as many rows here as its vectors are wide.
    packed = means.groupBy(group_col).agg(F.array_sort(F.collect_list(F.struct("_at", "_mean"))).alias("_m"))
    return packed.select(group_col, F.col("_m._mean").alias("centroid"))


def best_of_group(df: DataFrame, group_col: str, id_col: str, vector_col: str) -> DataFrame:
    """The candidate closest to its group's mean by cosine; smaller id on ties."""
    joined = df.join(group_centroids(df, group_col, vector_col), group_col)
    v, c = F.col(vector_col), F.col("centroid")
    norm = F.sqrt(dot(v, v) * dot(c, c))
    cosine = F.round(F.when(norm > 0, dot(v, c) / norm).otherwise(0.0), 9)
    best = joined.groupBy(group_col).agg(F.max(F.struct(cosine.alias("cosine"), (-F.col(id_col)).alias("neg"))).alias("b"))
    return best.select(group_col, (-F.col("b.neg")).alias(id_col), F.col("b.cosine").alias("cosine"))


def hashed_embedding(df: DataFrame, text_col: str, output: str = "embedding", width: int = 256) -> DataFrame:
    """Normalised TF-IDF vector of a text over ``width`` buckets of words.

    A word's bucket comes from its MD5, so any engine can build the vector. In
    how many texts a bucket occurs is counted over all rows, which gives one
    bounded array of weights. A text without words gets zeros.
    """
    words = F.coalesce(find_all(F.lower(text_col), WORD_CHARS), F.array().cast("array<string>"))
    buckets = F.transform(words, lambda w: F.conv(F.left(F.md5(w), F.lit(6)), 16, 10).cast("int") % width)

    @F.pandas_udf("array<float>")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda b: np.bincount(np.asarray(b, dtype=np.int64), minlength=width).astype(np.float32))

    counted = durable(df.withColumn(output, counts(buckets)))
    met = counted.select(F.posexplode(output).alias("at", "n")).filter("n > 0").groupBy("at").agg(F.count(F.lit(1)).alias("texts"))
    texts = dict(met.collect())
    total = counted.count()
    idf = F.array(*[F.lit(float(np.log((total + 1) / (texts.get(i, 0) + 1)))) for i in range(width)])
    weighted = counted.withColumn(output, F.zip_with(output, idf, lambda n, w: n * w))
    length = F.sqrt(dot(F.col(output), F.col(output)))
    unit = let(F.struct(F.col(output).alias("v"), length.alias("n")), lambda x: F.transform(
        x["v"], lambda y: F.when(x["n"] > 0, y / x["n"]).otherwise(F.lit(0.0))))
    return weighted.withColumn(output, unit)
