"""SimHash near duplicates, compared through distances to reference fingerprints.

By the triangle inequality two fingerprints that differ in at most ``d`` bits
have distances to any third one that differ by at most ``d``. So each
fingerprint gets a table of distances to many fixed references, pairs are
discarded by their largest difference in any column, and only what is left
is compared bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.components import components
from sluice.llm.workers import steps
from sluice.session import durable

REFERENCES = 24


def references(count: int = REFERENCES) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 64, count, dtype=np.uint64)


def fingerprint(text: bytes, n: int = 3) -> int:
    """64 bits: each set if it is set in over half the hashes of word ``n``-grams."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > n:
        starts, ends = starts[: len(words) - n + 1], ends[n - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], 42) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts)
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text_col: str, id_col: str, n: int = 3) -> DataFrame:
    """``id_col`` and ``fp`` (64 bits as a signed long) of every row; null texts are empty."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_text"):
            texts = part.column("_text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t, n) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(found)], names=["_id", "fp"])

    return rows.mapInArrow(run, f"_id {kind}, fp long").withColumnRenamed("_id", id_col)


def link_run(found: np.ndarray, table: np.ndarray, most: int) -> np.ndarray:
    """For fingerprints of one cell, the first of each one's chain of links, as positions.

    Rows are sorted by their first distance, so that partners lie in a narrow
    band of rows; the band is taken block by block.
    """
    order = np.argsort(table[:, 0], kind="stable")
    found, table = found[order], table[order]
    first = table[:, 0]
    label = np.arange(len(found))
    links = []
    for at in range(0, len(found), 256):
        rows = np.arange(at, min(at + 256, len(found)))
        until = int(np.searchsorted(first, first[rows[-1]] + most, side="right"))
        near = np.abs(table[rows, None, 1] - table[None, at:until, 1]) <= most
        a, b = np.nonzero(near)
        a, b = a + at, b + at
        keep = a < b
        a, b = a[keep], b[keep]
        for column in table.T:
            keep = np.abs(column[a] - column[b]) <= most
            a, b = a[keep], b[keep]
        keep = np.bitwise_count(found[a] ^ found[b]) <= most
        links.append((a[keep], b[keep]))
    a, b = (np.concatenate(x) for x in zip(*links))
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    out = np.empty(len(order), dtype=np.int64)
    out[order] = order[label]
    return out


def links(distinct: DataFrame, most: int = 2) -> DataFrame:
    """Edges ``a``, ``b`` that join all fingerprints (column ``fp``, no repeats) within ``most`` bits.

    Each link lies on a path of edges; not every link is an edge itself.

    Two fingerprints within ``most`` bits agree on two of ``most + 2`` blocks of
    bits, so they are laid out once per pair of blocks. Within a pair of blocks
    they are laid out by their first two distances in cells of ``most + 1``,
    with those near the upper border also in the next cell, so that partners
    share a cell. That keeps a family of near copies, which agrees on most
    blocks, from meeting in one task. A cell's distance table is worked through
    in blocks of rows and gives at most one edge per row.
    """
    blocks = most + 2
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]

    def block(i: int) -> Column:
        return F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))

    keys = [F.xxhash64(F.lit(k), block(i), block(j)) for k, (i, j) in enumerate(combinations(range(blocks), 2))]
    laid = distinct.select("fp", F.explode(F.array(*keys)).alias("key"))
    shared = laid.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key")
    laid = laid.join(shared, "key", "left_semi")
    far = references()
    for c, reference in zip(("c0", "c1"), far.view(np.int64).tolist()):
        distance = F.bit_count(F.col("fp").bitwiseXOR(F.lit(reference)))
        cell = [F.floor(distance / (most + 1)), F.floor((distance + most) / (most + 1))]
        laid = laid.withColumn(c, F.explode(F.array_distinct(F.array(*cell))))
    cells = ["key", "c0", "c1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, runs in _runs(batches):
            table = np.bitwise_count(found[:, None] ^ far[None, :]).astype(np.int16)
            a, b = [], []
            for start, end in runs:
                if end - start > 1:
                    to = link_run(found[start:end], table[start:end], most) + start
                    here = np.arange(start, end)
                    a.append(found[to[to != here]])
                    b.append(found[here[to != here]])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"]
                )

    sorted_cells = laid.select("fp", F.xxhash64(*cells).alias("cell"))
    partitions = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_cells = sorted_cells.repartition(partitions, "cell").sortWithinPartitions("cell", "fp")
    return sorted_cells.mapInArrow(run, "a long, b long").distinct()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[tuple[int, int]]]]:
    """Fingerprints with the limits of each cell's rows; a cell that spans batches is put together."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def limits(cells: np.ndarray) -> list[tuple[int, int]]:
        cuts = np.flatnonzero(np.diff(cells)) + 1
        return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)]))

    for batch in batches:
        found = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
        cells = batch.column("cell").to_numpy(zero_copy_only=False)
        if not len(cells):
            continue
        tail = int(np.searchsorted(cells, cells[-1]))
        if tail == 0 and held and held[-1][1][-1] == cells[0]:
            held.append((found, cells))
            continue
        held.append((found[:tail], cells[:tail]))
        whole = [np.concatenate(x) for x in zip(*held)]
        if len(whole[0]):
            yield whole[0], limits(whole[1])
        held = [(found[tail:], cells[tail:])]
    if held:
        whole = [np.concatenate(x) for x in zip(*held)]
        yield whole[0], limits(whole[1])


def near_duplicates(df: DataFrame, text_col: str, id_col: str, *, n: int = 3, most: int = 2) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row.

    The component is the smallest id reachable over links of at most ``most``
    differing bits. Null, empty and blank texts have fingerprint zero, linked
    like any other; texts under ``n`` words are hashed whole. Repeated rows and
    ties share a fingerprint and so a component. Null ids are never smallest: a
    component of them alone has a null id. An empty table gives no rows. Equal
    fingerprints meet in an aggregate before anything is compared, so groups
    of copies cost one row. Only the two named columns are read.
    """
    rows = durable(fingerprints(df, text_col, id_col, n))
    distinct = durable(rows.groupBy("fp").agg(F.min(id_col).alias("low")))
    roots = durable(components(links(distinct.select("fp"), most)))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = joined.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = joined.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(ids, "fp").select(rows[id_col], digits, "component_id")


def drop_near_duplicates(df: DataFrame, text_col: str, id_col: str, *, n: int = 3, most: int = 2) -> DataFrame:
    """The rows of ``df`` without near duplicates: of every component the row with the smallest id stays.

    A row without id loses to any other; of rows with one id the one with the
    smallest digest of its text stays, so that ids may repeat. Rows repeated with
    one id and text are one document and stay together. Null, empty and blank
    texts are one group. All columns come back as they are, whatever their names.
    """
    digest = F.sha2(F.coalesce(df[text_col], F.lit("")), 256)
    rank = F.struct(df[id_col].isNull().alias("none"), df[id_col].alias("id"), digest.alias("digest"))
    groups = near_duplicates(df.select(rank.alias("rank"), df[text_col].alias("text")), "text", "rank", n=n, most=most)
    stays = groups.filter(F.col("rank") == F.col("component_id")).select("rank.*").distinct().toDF("_none", "_stays", "_digest")
    return df.join(stays, df[id_col].eqNullSafe(F.col("_stays")) & (digest == F.col("_digest")), "left_semi")
