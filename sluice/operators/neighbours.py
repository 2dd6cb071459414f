"""Nearest rows by dot product: exact, in blocks, and through hash tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import durable

# Floats of one block of queries and of one block of rows.
QUERY_FLOATS, ROW_FLOATS = 1 << 21, 1 << 20
# Floats of a block of rows that has hash tables: larger, as each query is looked up anew in each block.
HASH_FLOATS = 1 << 21
# Blocks of rows that one task meets with a block of queries before it lets its best matches go.
RUN_BLOCKS = 8
# Queries multiplied with a block of rows at once.
SLICE = 512
# Queries looked up in the hash tables of a block at once, a bit of a word each; blocks that many queries are dealt to at
# least, and pairs of blocks there are at least.
HASH_SLICE, QUERY_BLOCKS, LEAST_BLOCKS = 64, 8, 16
# From this share of candidates on, one matrix product costs less than products with the candidates alone.
DENSE = 0.15
# Scores are compared to so many digits, so that ties do not hang on the order of additions.
DIGITS = 9
# Scores that are equal in so many digits lie no farther apart.
NEAR = 2 * 10.0**-DIGITS


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    usable = F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()
    return df.filter(usable).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))


def _blocks(rows: DataFrame, width: int, floats: int, total: int) -> DataFrame:
    """``rows`` packed into blocks of about ``floats`` numbers: ``block``, ``ids``, ``flat``."""
    count = max(1, -(-total * width // floats))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(count)))
    return dealt.groupBy("block").agg(F.collect_list("id").alias("ids"), F.flatten(F.collect_list("v")).alias("flat"))


def _best(k: int):
    """The ``k`` best of several partial lists, smaller id on ties."""

    def best(ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort([ids, -scores])[:k]
        return ids[order], scores[order]

    return best


def _floor(scores: np.ndarray, k: int) -> float:
    """A number that at least ``k`` of the scores reach, found from the best of each 64."""
    if len(scores) > 64 * k:
        whole = scores[: len(scores) // 64 * 64].reshape(-1, 64).max(axis=1)
        return np.partition(whole, len(whole) - k)[len(whole) - k]
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) > k else -np.inf


def top_k_neighbours(
    df: DataFrame, id_col: str, vector_col: str, k: int = 10, queries: Column | None = None
) -> DataFrame:
    """``id_col``, ``rank`` (from 1), ``neighbour`` and ``score`` of the ``k`` other rows with the largest dot products; exact.

    Only rows for which ``queries`` is true ask; all rows answer. Queries and
    rows are packed in blocks of fixed size. A task takes a run of row blocks
    through one block of queries and keeps the best ``k`` of each query, so one
    short list per query and run leaves it; lists are merged in two levels.
    Rows without id or vector neither ask nor answer; ties go to the smaller id.
    """
    asked = df if queries is None else df.filter(queries)
    rows, asking = durable(_vectors(df, id_col, vector_col)), durable(_vectors(asked, id_col, vector_col))
    head, total, wanted = rows.first(), rows.count(), asking.count()
    width = len(head["v"]) if head else 1
    base = _blocks(rows, width, ROW_FLOATS, total)
    return _met(base, _blocks(asking, width, QUERY_FLOATS, wanted), -(-total * width // ROW_FLOATS), RUN_BLOCKS, k, id_col)


Candidates = Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]]


def _met(
    base: DataFrame, ask: DataFrame, blocks: int, run_blocks: int, k: int, id_col: str, candidates: Candidates | None = None
) -> DataFrame:
    """Every block of queries through every run of row blocks, and the best ``k`` of the lists that come of it.

    ``candidates`` takes the rows of a block and gives a function from some
    queries to a table of truth values, which row is to be compared with which
    query; without it all are.
    """
    schema = "id long, run long, ids array<long>, scores array<double>"
    best = _best(k)
    ask = ask.select(F.col("block").alias("query_block"), F.col("ids").alias("query_ids"), F.col("flat").alias("query_flat"))
    runs = max(1, -(-blocks // run_blocks))
    base = base.withColumn("run", F.floor(F.col("block") / run_blocks))
    ask = ask.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(runs - 1).cast("long"))))

    def compared(own: np.ndarray, own_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Number of a query, rows it is compared with, and their scores; its own rows are left out."""
        chosen = candidates(rows) if candidates else None
        lengths, step = np.sqrt(np.einsum("ij,ij->i", rows, rows)), SLICE if chosen is None else HASH_SLICE
        for at in range(0, len(own), step):
            part = own[at : at + step]
            if chosen is None:
                for i, scores in enumerate(part @ rows.T, at):
                    met = np.flatnonzero(ids != own_ids[i])
                    yield i, met, scores[met]
                continue
            table, size = chosen(part), np.sqrt(np.einsum("ij,ij->i", part, part)) * lengths.max()
            if dense := table.mean() > DENSE:
                # Rough scores tell which rows are far from the best; the others are scored exactly.
                kind = np.float32 if size.max() < 1e30 else np.float64
                rough, slack = part.astype(kind) @ rows.astype(kind).T, 2 * (rows.shape[1] + 2) * np.finfo(kind).eps * size + NEAR
            for i, met in enumerate(table):
                met = np.flatnonzero(met)
                met = met[ids[met] != own_ids[at + i]]
                if dense:
                    scores = rough[i, met]
                    met = met[scores >= _floor(scores, k) - slack[i]]
                yield at + i, met, rows[met] @ part[i]

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"id": [], "run": [], "ids": [], "scores": []}
        for own_ids, own_flat in zip(left["query_ids"], left["query_flat"]):
            own_ids, own = np.asarray(own_ids), np.asarray(own_flat, dtype=np.float64).reshape(len(own_ids), -1)
            lists = [(np.zeros(0, np.int64), np.zeros(0))] * len(own_ids)
            for ids, flat in zip(right["ids"], right["flat"]):
                ids, rows = np.asarray(ids), np.asarray(flat, dtype=np.float64).reshape(len(ids), -1)
                for i, met, scores in compared(own, own_ids, rows, ids):
                    # Everything that is at least as good as the k-th best when rounded, so that ties are settled by id.
                    near = np.flatnonzero(scores >= _floor(scores, k) - NEAR)
                    near = near[np.isfinite(scores[near])]
                    lists[i] = best(np.append(lists[i][0], ids[met[near]]), np.append(lists[i][1], np.round(scores[near], DIGITS)))
            out["id"] += own_ids.tolist()
            out["run"] += [int(left["run"].iloc[0])] * len(own_ids)
            out["ids"] += [found for found, _ in lists]
            out["scores"] += [score for _, score in lists]
        return pd.DataFrame(out)

    # A block of queries and a run of row blocks meet in one task.
    pairs = ask.select(F.col("run").alias("run_met"), F.col("query_block").alias("block_met"))
    spread = base.join(pairs, F.col("run") == F.col("run_met")).drop("run")
    partial = ask.groupBy("run", "query_block").cogroup(spread.groupBy("run_met", "block_met")).applyInPandas(search, schema)
    listed = partial.select("id", "run", F.arrays_zip(F.col("scores").alias("score"), F.col("ids").alias("neighbour")).alias("near"))
    for keys in (["id", F.floor(F.col("run") / RUN_BLOCKS).alias("run")], ["id", F.lit(0).cast("long").alias("run")]):
        merged = listed.groupBy(*keys).agg(F.flatten(F.collect_list("near")).alias("near"))
        ordered = F.array_sort(F.transform("near", lambda x: F.struct((-x["score"]).alias("low"), x["neighbour"].alias("neighbour"))))
        kept = F.transform(F.slice(ordered, 1, k), lambda x: F.struct((-x["low"]).alias("score"), x["neighbour"].alias("neighbour")))
        listed = merged.select("id", "run", kept.alias("near"))
    return listed.select(F.col("id").alias(id_col), F.posexplode("near").alias("at", "near")).select(
        id_col, (F.col("at") + 1).alias("rank"), "near.neighbour", "near.score"
    )


def hash_planes(width: int, tables: int, bits: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables, bits, width))


def approximate_neighbours(
    df: DataFrame, id_col: str, vector_col: str, k: int = 10, queries: Column | None = None,
    tables: int = 16, bits: int | None = None, flips: int = 2,
) -> DataFrame:
    """Columns of ``top_k_neighbours``, found through random-projection hash tables.

    A vector's key in a table is the signs of its dot products with the
    table's planes. All rows are entered once per table; a query also looks
    under the keys that flip up to ``flips`` of the planes it lies nearest to.
    Candidates are verified by their exact dot product. Rows with one vector
    are entered once, under their smallest ids, ``k`` and one at most: no
    result can name more of them. ``bits`` follows the number of rows.

    Rows and queries are dealt in blocks as for the exact search, by a hash of
    the id, so a key that holds very many rows is spread over all tasks. A task
    enters its rows in the tables and looks its queries up there: keys, probes
    and candidate pairs are made where they are used and never shuffled, only
    vectors and short lists are. No bucket is cut.
    """
    kind = "float" if df.schema[vector_col].dataType.simpleString() == "array<float>" else "double"

    def vectors(rows: DataFrame) -> DataFrame:
        return _vectors(rows, id_col, vector_col).withColumn("v", F.col("v").cast(f"array<{kind}>"))

    asking = durable(vectors(df if queries is None else df.filter(queries)))
    # Of equal vectors the smallest ids stand for all.
    groups = vectors(df).groupBy("v").agg(F.slice(F.array_sort(F.collect_list("id")), 1, k + 1).alias("ids"), F.count(F.lit(1)).alias("rows"))
    groups = durable(groups)
    total, kept = groups.agg(F.sum("rows"), F.sum(F.size("ids"))).first()
    total, kept, wanted, head = total or 0, kept or 0, asking.count(), groups.first()
    width = len(head["v"]) if head else 1
    bits = bits or max(4, int(np.log2(max(total, 2) / 64)))
    planes = hash_planes(width, tables, bits)
    masks = [sum(1 << i for i in c) for r in range(flips + 1) for c in combinations(range(min(bits, 6)), r)]

    def homes(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key of every vector in every table, and the sides of the planes it follows from."""
        sides = np.einsum("tbw,nw->ntb", planes, v, optimize=True)
        return ((sides > 0) << np.arange(bits)).sum(axis=2), sides

    def probes(v: np.ndarray) -> np.ndarray:
        home, sides = homes(v)
        # Bit i of a mask flips the plane that is i-th nearest.
        near = np.argsort(np.abs(sides), axis=2)[:, :, : min(bits, 6)]
        turned = np.zeros(home.shape + (len(masks),), dtype=np.int64)
        for m, mask in enumerate(masks):
            for i in range(near.shape[2]):
                if mask >> i & 1:
                    turned[:, :, m] ^= 1 << near[:, :, i]
        return home[:, :, None] ^ turned

    def entered(rows: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """The hash tables of a block of rows."""
        home = np.concatenate([homes(rows[at : at + SLICE])[0] for at in range(0, len(rows), SLICE)])
        # The different keys of each table in order, and the place of each row's key among them.
        keys, places = zip(*(np.unique(home[:, t], return_inverse=True) for t in range(tables)))

        def looked(own: np.ndarray) -> np.ndarray:
            asked = probes(own)
            # A bit of each row tells whether a query meets it in some table.
            met = np.zeros(len(rows), dtype=np.uint64)
            bit = np.uint64(1) << np.arange(len(own), dtype=np.uint64)
            for t in range(tables):
                at = np.minimum(np.searchsorted(keys[t], asked[:, t]), len(keys[t]) - 1)
                there = keys[t][at] == asked[:, t]
                asking = np.zeros(len(keys[t]), dtype=np.uint64)
                np.bitwise_or.at(asking, at[there], np.broadcast_to(bit[:, None], at.shape)[there])
                met |= asking[places[t]]
            bits_of = np.unpackbits(met.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            return bits_of[:, : len(own)].T.astype(bool)

        return looked

    # Of few rows, too, there are blocks enough for many tasks. Many queries are cut first, as each costs its lookups again
    # in every block of rows; runs of row blocks keep the copies of the queries few.
    query_floats = min(QUERY_FLOATS, max(HASH_SLICE * width, -(-wanted * width // QUERY_BLOCKS)))
    query_blocks = max(1, -(-wanted * width // query_floats))
    floats = max(1, min(HASH_FLOATS, -(-kept * width // -(-LEAST_BLOCKS // query_blocks))))
    blocks = -(-kept * width // floats)
    run_blocks = max(1, min(RUN_BLOCKS, blocks * query_blocks // (4 * LEAST_BLOCKS)))
    base = _blocks(groups.select(F.explode("ids").alias("id"), "v"), width, floats, kept)
    return _met(base, _blocks(asking, width, query_floats, wanted), blocks, run_blocks, k, id_col, entered)


def recall(found: DataFrame, exact: DataFrame, id_col: str) -> float:
    """Share of the exact neighbours that were found, by score: equal scores count as one another."""
    worst = exact.groupBy(id_col).agg(F.min("score").alias("worst"), F.count(F.lit(1)).alias("wanted"))
    good = found.join(worst, id_col).filter(F.col("score") >= F.col("worst")).groupBy(id_col).agg(F.count(F.lit(1)).alias("hits"))
    row = worst.join(good, id_col, "left").agg(F.sum(F.least(F.coalesce("hits", F.lit(0)), F.col("wanted"))).alias("h"), F.sum("wanted").alias("w")).first()
    return row["h"] / row["w"] if row["w"] else 1.0
