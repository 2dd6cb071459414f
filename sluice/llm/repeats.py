"""Removal of repeated passages, found by the interval tree of a suffix array.

A suffix array of everything would not fit a task, so equal passages are first
brought together by content. Every window of ``size`` bytes names one anchor
inside it, the ``GRAM`` bytes with the smallest hash; equal windows name equal
anchors. The windows that name one anchor make a *context*: a short run of
bytes that is cut out of its text by content alone, so copies of a passage fall
into equal contexts. Contexts whose anchor occurs in one document only are
dropped, equal ones become one with its smallest document, and the rest meet
in buckets by anchor. A bucket builds the suffix array of its contexts with the
common prefixes of neighbours, and a scan with a stack walks the tree of
intervals: an interval of ``size`` bytes or more whose suffixes are preceded by
different bytes is a maximal repeat, with all its occurrences.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, StructType

from sluice.session import durable

GRAM = 24
# Text of one stored chunk of rows, and suffixes of one suffix array, both about. Windows whose anchors are found at once:
# few, as their arrays then stay in a cache.
CHUNK_BYTES = 6_000_000
SUFFIXES = 300_000
BLOCK = 1 << 14
# Anchors are told apart by this many bits.
KEY_BITS = 48
# An anchor with more contexts than this, over all chunks, is split into single windows.
HOT_CONTEXTS = 1024
NO_DOC = np.iinfo(np.int64).max
_MIX = np.uint64(0xD6E8FEB86659FD93)


# ---- anchors ----------------------------------------------------------------


def gram_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` bytes, rolled by doubling the length."""
    base = 0x9E3779B97F4A7C15
    by_size = {1: (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)}
    size = 1
    while 2 * size <= n:
        half = by_size[size]
        by_size[2 * size] = half[:-size] * np.uint64(pow(base, size, 1 << 64)) + half[size:]
        size *= 2
    out = by_size[size]
    for more in sorted(by_size, reverse=True):
        if size + more <= n and more < size:
            tail = by_size[more][size:]
            out = out[: len(tail)] * np.uint64(pow(base, more, 1 << 64)) + tail
            size += more
    out = out[: len(data) - n + 1]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def lowest_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest of each ``width`` values in a row, by all but their last bits, the leftmost of equals."""
    bits = np.uint64(len(values).bit_length())
    # The position stands in for the last bits, so that one minimum finds both.
    packed = values >> bits << bits | np.arange(len(values), dtype=np.uint64)
    size = 1
    while size < width:
        step = min(size, width - size)
        packed = np.minimum(packed[:-step], packed[step:])
        size += step
    return (packed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def contexts(data: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor key, first window and number of windows of every context.

    ``data`` are texts laid end to end, ``ends`` where they end. Windows that
    cross an end belong to no context.
    """
    windows = len(data) - size + 1
    if windows < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    # Runs of windows that name one anchor.
    runs, keys, last = [], [], -1
    for at in range(0, windows, BLOCK):
        hashes = gram_hashes(data[at : at + BLOCK + size - 1], GRAM)
        low = lowest_in_window(hashes, size - GRAM + 1)
        head = np.flatnonzero(np.diff(low, prepend=last - at))
        runs.append(head + at)
        # The smallest of many hashes is small; mixed again, anchors spread evenly.
        keys.append(hashes[low[head]] * _MIX >> np.uint64(64 - KEY_BITS))
        last = int(low[-1]) + at
    first, key = np.concatenate(runs), np.concatenate(keys)
    # Windows of which some begin or end to cross an end of a text; a run is cut there.
    edges = [np.clip(ends[:-1] - by, 0, windows) for by in (size - 1, 0)]
    more = np.unique(np.concatenate(edges))
    more = more[more < windows]
    at = np.searchsorted(first, more, side="right")
    fresh = first[at - 1] != more
    first, key = np.insert(first, at[fresh], more[fresh]), np.insert(key, at[fresh], key[at[fresh] - 1])
    count = np.diff(np.append(first, windows))
    crossing = np.zeros(len(first) + 1, dtype=np.int64)
    for edge, step in zip(edges, (1, -1)):
        np.add.at(crossing, np.searchsorted(first, edge), step)
    inside = np.cumsum(crossing[:-1]) == 0
    return key[inside], first[inside], count[inside]


def slice_hashes(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A hash of each slice of ``length`` bytes from ``first`` (ascending) on."""
    out, step = np.zeros(len(first), dtype=np.uint64), 1 << 20
    room = step + int(length.max(initial=0))
    powers = np.cumprod(np.full(room + 1, 0x9E3779B97F4A7C15, dtype=np.uint64))
    for at in range(0, len(data), step):
        a, b = np.searchsorted(first, [at, at + step])
        if a == b:
            continue
        start = first[a:b] - at
        part = data[at : at + room].astype(np.uint64) + np.uint64(1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(part * powers[: len(part)])])
        out[a:b] = (sums[start + length[a:b]] - sums[start]) * powers[room - start]
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


# ---- the interval tree ------------------------------------------------------


def maximal_repeats(texts: list[bytes], counts: np.ndarray, size: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Suffixes in order, as (text, start) rows, and maximal repeats as (first, last, length).

    Suffixes start at the ``counts`` window starts of each text. ``first`` and
    ``last`` limit a repeat's occurrences among the sorted suffixes.
    """
    longest = max(map(len, texts))
    width = -(-longest // 8) * 8
    flat = np.frombuffer(b"".join(t.ljust(longest + width, b"\0") for t in texts), np.uint8)
    text = np.repeat(np.arange(len(texts)), counts)
    start = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = np.array([len(t) for t in texts])[text] - start
    rows = np.lib.stride_tricks.sliding_window_view(flat, width)[text * (longest + width) + start]
    words = rows.view(">u8").astype(np.uint64)
    order = np.lexsort([left, *words.T[::-1]])
    text, start, left, rows = text[order], start[order], left[order], rows[order]
    before = np.where(start > 0, flat[text * (longest + width) + start - 1].astype(np.int64), -1 - np.arange(len(text)))
    # Common prefix of each suffix with the one before it.
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    common = np.concatenate([[0], np.minimum(np.minimum(common, left[1:]), left[:-1])])
    # Runs of suffixes that share a window; only where what precedes them differs can a repeat be maximal.
    run = np.cumsum(common < size) - 1
    heads = np.flatnonzero(common < size)
    ends = np.append(heads[1:], len(text))
    varied = np.zeros(len(heads), dtype=bool)
    np.logical_or.at(varied, run[1:], (common[1:] >= size) & (before[1:] != before[:-1]))
    found: list[tuple[int, int, int]] = []
    changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
    for r in np.flatnonzero(varied):
        lo, hi = int(heads[r]), int(ends[r])
        if hi - lo == 2:
            found.append((lo, hi - 1, int(common[lo + 1])))
            continue
        depth, change = common[lo:hi].tolist(), changes[lo:hi].tolist()
        # Open intervals, by common prefix: (length, first suffix).
        stack: list[tuple[int, int]] = []
        for i in range(1, hi - lo + 1):
            here = depth[i] if i < hi - lo else 0
            begin = i - 1
            while stack and stack[-1][0] > here:
                length, begin = stack.pop()
                if change[i - 1] > change[begin]:
                    found.append((lo + begin, lo + i - 1, length))
            if here and (not stack or stack[-1][0] < here):
                stack.append((here, begin))
    return np.stack([text, start], axis=1), found


def lowest_documents(texts: list[bytes], counts: np.ndarray, docs: np.ndarray, size: int) -> np.ndarray:
    """Smallest document that holds each window of each context, a row per context."""
    low = np.repeat(docs[:, None], int(counts.max(initial=1)), axis=1)
    suffixes, found = maximal_repeats(texts, counts, size)
    if not found:
        return low
    first, last, length = np.array(found, dtype=np.int64).T
    of = docs[suffixes[:, 0]]
    members = last - first + 1
    at = np.repeat(first - (np.cumsum(members) - members), members) + np.arange(members.sum())
    lowest = np.minimum.reduceat(of[at], np.cumsum(members) - members)
    # All windows that start inside an occurrence and end inside it.
    spans = np.minimum(np.repeat(length - size + 1, members), counts[suffixes[at, 0]] - suffixes[at, 1])
    each = np.repeat(np.arange(len(at)), spans)
    shift = np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
    cell = (suffixes[at[each], 0], suffixes[at[each], 1] + shift)
    np.minimum.at(low, cell, np.repeat(lowest, members)[each])
    return low


# ---- stored chunks and what travels between them and the buckets --------------


@functools.cache
def _codec() -> tuple[Callable[[bytes], bytes], Callable[[bytes], bytes]]:
    """What compresses and what restores; kept, as many short pieces go through it."""
    return zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress


def packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return _codec()[0](planes.tobytes())


def unpacked(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(_codec()[1](data), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def chunked(df: DataFrame) -> DataFrame:
    """Rows of ``df`` as stored chunks: ``chunk`` and ``rows``, a compressed Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, number = TaskContext.get().partitionId() << 32, 0
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                # Halve until a piece fits what is open; a row is never cut.
                take = batch.num_rows - at
                while take > 1 and size + batch.slice(at, take).nbytes > CHUNK_BYTES:
                    take = take // 2
                held.append(batch.slice(at, take))
                size += batch.slice(at, take).nbytes
                at += take
                if size >= CHUNK_BYTES // 2:
                    yield _chunk(base + number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield _chunk(base + number, held)

    return durable(df.mapInArrow(run, "chunk long, rows binary"))


def _chunk(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(pa.Table.from_batches(held).combine_chunks())
    return pa.RecordBatch.from_arrays(
        [pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "rows"]
    )


class Chunk:
    """Rows of a stored chunk with the contexts of their texts."""

    def __init__(self, rows: bytes, text_at: int, id_at: int, size: int, bits: int):
        self.rows = pa.ipc.open_stream(rows).read_all()
        texts = [t or b"" for t in self.rows.column(text_at).cast(pa.binary()).to_pylist()]
        self.text = b"".join(texts)
        self.ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        self.docs = self.rows.column(id_at).cast(pa.int64()).fill_null(NO_DOC).to_numpy()
        self.size, self.bits = size, bits
        key, self.first, self.count = contexts(np.frombuffer(self.text, np.uint8), self.ends, size)
        self.doc = self.docs[np.searchsorted(self.ends, self.first, side="right")]
        self.keys, self.of_key = np.unique(key, return_inverse=True)

    def buckets(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Buckets of sorted keys with their places."""
        bucket = (keys >> np.uint64(KEY_BITS - self.bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if b > a:
                yield int(bucket[a]), slice(a, b)

    def key_rows(self, number: int) -> pa.Table:
        """Per bucket the anchors of the chunk, marked where two documents have one."""
        low = np.full(len(self.keys), NO_DOC)
        high = np.full(len(self.keys), np.iinfo(np.int64).min)
        np.minimum.at(low, self.of_key, self.doc)
        np.maximum.at(high, self.of_key, self.doc)
        # Different contexts of each anchor, and the lowest bit set where two documents have it.
        different = np.bincount(self.of_key, minlength=len(self.keys))
        some = np.flatnonzero(different[self.of_key] > 1)
        hashes = slice_hashes(np.frombuffer(self.text, np.uint8), self.first[some], self.count[some] + self.size - 1)
        _, once = np.unique(hashes ^ (self.of_key[some].astype(np.uint64) * _MIX), return_index=True)
        different[different > 1] = 0
        different += np.bincount(self.of_key[some][once], minlength=len(self.keys))
        marks = different.astype(np.uint32) << 1 | (low < high)
        rows = [
            (bucket, number, packed(np.diff(self.keys[s], prepend=np.uint64(0))), packed(marks[s].astype(np.uint32)))
            for bucket, s in self.buckets(self.keys)
        ]
        return table(rows, KEY_ROWS)

    def shared(self, flags: dict[int, bytes]) -> None:
        """Keep the contexts whose anchor other documents have, equal ones as one.

        Contexts of a hot anchor are cut into their windows, each under a key of
        its own bytes: equal windows still meet, and nothing else does.
        """
        marks = np.zeros(len(self.keys), dtype=np.uint8)
        for bucket, s in self.buckets(self.keys):
            if bucket in flags:
                marks[s] = unpacked(flags[bucket], np.uint8)
        mark, text = marks[self.of_key], self.text
        cold, hot = np.flatnonzero(mark == 1), np.flatnonzero(mark == 2)
        each = np.repeat(hot, self.count[hot])
        shift = np.arange(len(each)) - np.repeat(np.cumsum(self.count[hot]) - self.count[hot], self.count[hot])
        windows = self.first[each] + shift
        own = slice_hashes(np.frombuffer(text, np.uint8), windows, np.full(len(windows), self.size)) >> np.uint64(64 - KEY_BITS)
        keys = np.concatenate([self.keys[self.of_key[cold]], own])
        # In order of keys, so that buckets are slices.
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.concatenate([self.first[cold], windows])[order]
        count = np.concatenate([self.count[cold], np.ones(len(windows), np.int64)])[order]
        doc = np.concatenate([self.doc[cold], self.doc[each]])[order]
        self.chosen_first, self.chosen_count, self.chosen_doc = first, count, doc
        number: dict[bytes, int] = {}
        stops = (first + count + self.size - 1).tolist()
        self.local = np.fromiter(
            (number.setdefault(text[a:b], len(number)) for a, b in zip(first.tolist(), stops)), np.int64, len(first)
        )
        self.texts = list(number)
        self.low = np.full(len(number), NO_DOC)
        np.minimum.at(self.low, self.local, doc)
        self.counts, self.text_keys = np.zeros(len(number), np.int64), np.zeros(len(number), np.uint64)
        self.counts[self.local] = count
        self.text_keys[self.local] = keys

    def context_rows(self, number: int) -> pa.Table:
        """Per bucket the different contexts with their smallest document here."""
        rows = [
            (
                bucket, number, packed(np.diff(self.text_keys[s], prepend=np.uint64(0))),
                packed(self.counts[s].astype(np.uint8)), packed(self.low[s]),
                _codec()[0](b"".join(self.texts[s])),
            )
            for bucket, s in self.buckets(self.text_keys)
        ]
        return table(rows, CONTEXT_ROWS)

    def removed(self, marks: dict[int, bytes]) -> np.ndarray:
        """Which bytes of the chunk go."""
        bits = np.zeros(len(self.texts), dtype=np.uint32)
        for bucket, s in self.buckets(self.text_keys):
            bits[s] = unpacked(marks[bucket], np.uint32)
        first, doc, count = self.chosen_first, self.chosen_doc, self.chosen_count
        # A context that a smaller document of the chunk also has goes whole.
        gone = np.where(doc > self.low[self.local], np.uint32(0xFFFFFFFF), bits[self.local])
        # No two windows begin at one byte, and no more than ``size`` cover one.
        edges = np.zeros(len(self.text) + 1, dtype=np.int8)
        for shift in range(int(count.max(initial=0))):
            hit = (shift < count) & ((gone >> np.uint32(shift)) & np.uint32(1)).astype(bool)
            start = first[hit] + shift
            np.add.at(edges, start, 1)
            np.add.at(edges, start + self.size, -1)
        return np.cumsum(edges[:-1], dtype=np.int8) > 0


KEY_ROWS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("marks", pa.binary())])
CONTEXT_ROWS = pa.schema([
    ("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("docs", pa.binary()),
    ("texts", pa.binary()),
])
MARK_ROWS = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()), ("marks", pa.binary())])
MARK_DDL = "chunk long, bucket long, kind int, marks binary"


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def repeated_anchors(group: pa.Table) -> pa.Table:
    """One bucket: which anchors of each chunk occur in another document (1), and which of them are hot (2)."""
    chunks, keys = group.column("chunk").to_pylist(), []
    for data in group.column("keys").to_pylist():
        keys.append(np.cumsum(unpacked(data, np.uint64), dtype=np.uint64))
    marks = np.concatenate([unpacked(m, np.uint32) for m in group.column("marks").to_pylist()])
    _, of, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    known = np.zeros(len(times), dtype=bool)
    np.logical_or.at(known, of, (marks & 1) > 0)
    hot = np.bincount(of, marks >> 1, len(times)) > HOT_CONTEXTS
    flags = ((known | (times > 1)) * (1 + hot))[of].astype(np.uint8)
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    bucket = group.column("bucket")[0].as_py()
    return table([(c, bucket, 0, packed(f)) for c, f in zip(chunks, np.split(flags, cuts))], MARK_ROWS)


def resolve(group: pa.Table, size: int) -> pa.Table:
    """One bucket: which windows of each chunk's contexts a smaller document has."""
    chunks, keys, counts, docs, texts, number = group.column("chunk").to_pylist(), [], [], [], [], {}
    for row in group.to_pylist():
        keys.append(np.cumsum(unpacked(row["keys"], np.uint64), dtype=np.uint64))
        counts.append(unpacked(row["counts"], np.uint8).astype(np.int64))
        docs.append(unpacked(row["docs"], np.int64))
        data = _codec()[1](row["texts"])
        stops = np.cumsum(counts[-1] + size - 1).tolist()
        texts.append([number.setdefault(data[a:b], len(number)) for a, b in zip([0, *stops], stops)])
    cuts = np.cumsum([len(k) for k in keys])[:-1]
    key, count, doc = (np.concatenate(x) for x in (keys, counts, docs))
    of = np.concatenate([np.array(t, dtype=np.int64) for t in texts])
    # The different contexts of the bucket, in order of their anchors.
    _, pick = np.unique(of, return_index=True)
    low = np.full(len(pick), NO_DOC)
    np.minimum.at(low, of, doc)
    windows = np.repeat(low[:, None], int(count.max()), axis=1)
    order = np.argsort(key[pick], kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], np.diff(key[pick][order]) > 0]))
    sizes = np.diff(np.append(heads, len(order)))
    several = sizes > 1
    names = list(number)
    # Anchors with one context have nothing to compare it with. The others go a share at a time, an anchor in one of them.
    members = order[np.repeat(several, sizes)]
    share = (np.cumsum(sizes[several]) - 1) * (size - GRAM) // (2 * SUFFIXES)
    for part in np.split(members, np.cumsum(np.bincount(share, sizes[several]).astype(np.int64))[:-1]):
        if len(part):
            found = lowest_documents([names[i] for i in part.tolist()], count[pick][part], low[part], size)
            windows[part, : found.shape[1]] = found
    shift = np.arange(windows.shape[1])
    gone = (windows[of] < doc[:, None]) & (shift < count[:, None])
    bits = (gone.astype(np.uint32) << shift.astype(np.uint32)).sum(axis=1, dtype=np.uint32)
    bucket = group.column("bucket")[0].as_py()
    return table([(c, bucket, 1, packed(b)) for c, b in zip(chunks, np.split(bits, cuts))], MARK_ROWS)


ADDED = ("n_bytes", "removed", "kept")


def remove_repeats(
    df: DataFrame, text_col: str, id_col: str, *, size: int = 50, whole_chars: bool = False, added: tuple[str, str, str] = ADDED
) -> DataFrame:
    """``df`` with ``n_bytes``, ``removed`` (spans of ``start`` and ``length``) and ``kept`` (bytes).

    Texts are UTF-8 bytes. A byte goes if a string of ``size`` bytes that covers
    it also starts in a row with a smaller id; strings are judged on the input,
    and overlaps count. With ``whole_chars`` a character that is not wholly
    covered stays whole. Null and empty texts have no bytes. Rows with equal ids
    never remove from each other, so repeated rows stay alike; a null id is
    larger than any other. ``added`` names the new columns; a column of ``df``
    with such a name is replaced. An empty table gives no rows.

    Texts are stored once in chunks of rows. A passage that many documents share
    leaves a chunk once, whatever their number. The number of buckets follows
    that of chunks. An anchor with over ``HOT_CONTEXTS`` contexts is split into
    its windows, which spread over the buckets by their own bytes.
    """
    if not 2 * GRAM < size + 1 or size - GRAM + 1 > 32:
        raise ValueError(f"size must lie between {2 * GRAM} and {GRAM + 31}")
    chunks = chunked(df)
    # A chunk leaves a row for each bucket, so few large chunks and buckets keep these rows from growing as their product.
    bits = min(KEY_BITS, max(3, chunks.count().bit_length()))
    text_at, id_at = df.columns.index(text_col), df.columns.index(id_col)
    stay = [i for i, c in enumerate(df.columns) if c not in added]

    def load(rows: bytes) -> Chunk:
        return Chunk(rows, text_at, id_at, size, bits)

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from load(row["rows"]).key_rows(row["chunk"]).to_batches()

    def flags_of(marks: pa.Table, kind: int) -> dict[int, bytes]:
        return {r["bucket"]: r["marks"] for r in marks.to_pylist() if r["kind"] == kind}

    def contexts_of(chunk: pa.Table, marks: pa.Table) -> pa.Table:
        if not chunk.num_rows or not marks.num_rows:
            return table([], CONTEXT_ROWS)
        row = chunk.to_pylist()[0]
        open_chunk = load(row["rows"])
        open_chunk.shared(flags_of(marks, 0))
        return open_chunk.context_rows(row["chunk"])

    def cut(chunk: pa.Table, marks: pa.Table) -> pa.Table:
        open_chunk = load(chunk.column("rows")[0].as_py())
        open_chunk.shared(flags_of(marks, 0))
        gone = open_chunk.removed(flags_of(marks, 1))
        return _cut_rows(open_chunk, gone, whole_chars, stay, added)

    anchors = chunks.mapInArrow(keys_of, "bucket long, chunk long, keys binary, marks binary")
    flags = durable(anchors.groupBy("bucket").applyInArrow(repeated_anchors, MARK_DDL))
    found = chunks.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(
        contexts_of, "bucket long, chunk long, keys binary, counts binary, docs binary, texts binary"
    )
    marks = durable(found.groupBy("bucket").applyInArrow(lambda group: resolve(group, size), MARK_DDL))
    span = StructType().add("start", "long").add("length", "long")
    schema = StructType([df.schema.fields[i] for i in stay])
    schema = schema.add(added[0], "long").add(added[1], ArrayType(span)).add(added[2], "binary")
    return chunks.groupBy("chunk").cogroup(flags.union(marks).groupBy("chunk")).applyInArrow(cut, schema)


def _cut_rows(chunk: Chunk, gone: np.ndarray, whole_chars: bool, stay: list[int], added: tuple[str, ...]) -> pa.Table:
    data = np.frombuffer(chunk.text, np.uint8)
    if whole_chars and len(data):
        # A character goes only if all its bytes do; those of several bytes are the ones to look at.
        inner = (data & 0xC0) == 0x80
        flips = np.flatnonzero(inner[1:] != inner[:-1])[int(inner[0]) :] + 1
        flips = np.append(flips, len(data)) if len(flips) % 2 else flips
        bounds = np.stack([flips[::2] - 1, flips[1::2]], axis=1)
        if len(bounds):
            each = np.append(gone, False)
            some, every = (f.reduceat(each, bounds.ravel())[::2] for f in (np.logical_or, np.logical_and))
            for a, b in bounds[some & ~every].tolist():
                gone[a:b] = False
    starts = chunk.ends - np.diff(chunk.ends, prepend=0)
    # Rows in which some byte goes: one that the first byte of a row is, or that follows one which stays.
    flips = np.flatnonzero(gone[1:] != gone[:-1]) + 1
    cuts = np.append(gone, False)[starts] | (np.searchsorted(flips, chunk.ends) > np.searchsorted(flips, starts, side="right"))
    sizes, spans, kept = [], [], []
    for a, b, cut in zip(starts.tolist(), chunk.ends.tolist(), cuts.tolist()):
        sizes.append(b - a)
        if cut:
            part = gone[a:b]
            edge = np.flatnonzero(np.diff(part.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            spans.append([{"start": s, "length": e - s} for s, e in edge.tolist()])
            kept.append(data[a:b][~part].tobytes())
        else:
            spans.append([])
            kept.append(chunk.text[a:b])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
    new = [pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
    names = [*(chunk.rows.column_names[i] for i in stay), *added]
    return pa.Table.from_arrays([*(chunk.rows.columns[i] for i in stay), *new], names=names)
