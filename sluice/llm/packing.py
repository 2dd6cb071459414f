"""Sequences of a fixed length packed by the sum-of-squares rule.

A document goes where the sum, over residual gaps, of the squared number of
open sequences with that gap becomes smallest. Keeping those counts level
keeps a fitting partner open for whatever comes next.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tokenizers import Tokenizer, normalizers, pre_tokenizers

from sluice.llm.workers import once, steps
from sluice.session import durable

# Spellings of one generation that a worker remembers.
REMEMBERED_IDS = 400_000
# Texts of one step, in characters: the more, the fewer spellings are looked up twice.
STEP = 4_000_000
# Pieces that one task packs on average.
PIECES_PER_TASK = 25_000


class SumOfSquares:
    """Open sequences of one task, by gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        # Open sequences per gap; a full one is closed and counts for nothing.
        self.counts = np.zeros(capacity, dtype=np.int64)
        self.open: dict[int, list[int]] = {}
        self.used = 0

    def place(self, size: int) -> tuple[int, int]:
        """Sequence and offset for a piece of ``size`` tokens, 0 < size <= capacity."""
        counts, capacity = self.counts, self.capacity
        # What a piece adds to half the sum: the gap it leaves gains one, the gap it takes loses one.
        gained = counts[: capacity - size].astype(np.float64)
        gained[:1] = -0.5
        taken = counts[size:]
        change = np.where(taken > 0, gained - taken, np.inf)
        fresh = counts[capacity - size] - 0.5 if size < capacity else -1.0
        at = int(change.argmin()) if len(change) else -1
        if at >= 0 and change[at] <= fresh:
            gap = at + size
            sequence = self.open[gap].pop()
            counts[gap] -= 1
        else:
            gap, sequence = capacity, self.used
            self.used += 1
        if left := gap - size:
            counts[left] += 1
            self.open.setdefault(left, []).append(sequence)
        return sequence, capacity - gap

    def leftovers(self) -> list[int]:
        """Sequences that are not full."""
        return [s for found in self.open.values() for s in found]


# Latin letters that the tokenizer, case apart, takes as they are, and marks that it takes as one word if they stand in a row.
_LETTERS = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)])).translate({0xD7: None, 0xF7: None, 0x130: None})
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class Ids:
    """Ids that the tokenizers library gives, each white-space free spelling asked for once in a while.

    The tokenizer's words never cross white space, so a text's ids are those of
    its spellings in a row. A spelling of Latin letters with marks behind them
    has the ids of the letters, in lower case, and of the marks. Texts that may
    hold special tokens go whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # A digit is always a word, and so a token, of its own.
        (self.between,) = self.tokenizer.encode("0", add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # The same model for words that need no pattern to be cut, and the tokens that end a word.
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        suffix, vocabulary = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True

    def _ask(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn_words(self, new: list[str]) -> None:
        """Ask for many words of Latin letters in lower case at once; their ids part at tokens that end a word."""
        if new and self.ends.any():
            (encoding,) = self.plain.encode_batch_fast([" ".join(new)], add_special_tokens=False)
            ids = np.array(encoding.ids, dtype=np.uint32)
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(cuts) == len(new):
                data = ids.tobytes()
                self.known |= {s: data[a:b] for s, a, b in zip(new, [0, *cuts], cuts)}
                return
        self._learn(new)

    def _learn(self, new: list[str]) -> None:
        """Ask for many spellings at once, told apart by a digit that none of them has, put between them."""
        odd = [s for s in new if "0" in s]
        self.known |= zip(odd, self._ask(odd))
        plain = [s for s in new if "0" not in s]
        if plain:
            ids = self._ask([" 0 ".join(plain)])[0]
            at = (4 * np.flatnonzero(np.frombuffer(ids, np.uint32) == self.between)).tolist()
            self.known |= {s: ids[a:b] for s, a, b in zip(plain, [0, *[x + 4 for x in at]], [*at, len(ids)], strict=True)}

    def _lists(self, words: list[str], others: list[str]) -> pa.ListArray:
        """Ids of distinct words of Latin letters in lower case, then of other distinct spellings."""
        known, older = self.known, self.older
        for spellings, learn in ((words, self._learn_words), (others, self._learn)):
            new = [s for s in spellings if s not in known]
            known |= {s: older[s] for s in new if s in older}
            learn([s for s in new if s not in older])
        found = list(map(known.__getitem__, chain(words, others)))
        if len(known) > REMEMBERED_IDS:
            self.known, self.older = {}, known
        return _listed(found)

    def _spelled(self, spellings: pa.Array) -> pa.ListArray:
        """Ids of distinct spellings without ASCII white space."""
        words, marks = pc.utf8_rtrim(spellings, characters=_MARKS), pc.utf8_ltrim(spellings, characters=_LETTERS)
        # Only where letters are followed by marks do both together have the length of the whole.
        length = pc.add(pc.binary_length(words), pc.binary_length(marks))
        plain = pc.and_(pc.equal(length, pc.binary_length(spellings)), pc.greater(pc.binary_length(words), 0))
        rest = pc.filter(spellings, pc.invert(plain))
        words = pc.utf8_lower(pc.filter(words, plain)).dictionary_encode()
        others = pa.concat_arrays([pc.filter(marks, plain), rest]).dictionary_encode()
        lists = self._lists(words.dictionary.to_pylist(), others.dictionary.to_pylist())
        # Two lists for each spelling: letters and marks, or nothing and the whole.
        is_plain = plain.to_numpy(zero_copy_only=False)
        first, second = np.full(len(spellings), len(lists)), np.empty(len(spellings), dtype=np.int64)
        other = others.indices.to_numpy() + len(words.dictionary)
        first[is_plain] = words.indices.to_numpy()
        second[is_plain], second[~is_plain] = np.split(other, [len(words)])
        lists = pa.concat_arrays([lists, _listed([b""])])
        parts = lists.take(pa.array(np.stack([first, second], axis=1).ravel()))
        return pa.ListArray.from_arrays(parts.offsets.to_numpy()[::2], parts.values)

    def column(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text, none of them null."""
        marked = pc.match_substring(texts, "<|")
        if pc.any(marked).as_py():
            whole = iter(self._ask(pc.filter(texts, marked).to_pylist()))
            rest = self.column(pc.if_else(marked, "", texts))
            return _listed([next(whole) if m else ids.values.to_numpy().tobytes() for m, ids in zip(marked.to_pylist(), rest)])
        cut = pc.ascii_split_whitespace(texts)
        met = cut.values.dictionary_encode()
        ids = self._spelled(met.dictionary).take(met.indices)
        return pa.ListArray.from_arrays(ids.offsets.take(cut.offsets), ids.values)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit numbers in the machine's order."""
        ids = self.column(pa.array(texts, pa.string()))
        offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
        return [values[a:b].tobytes() for a, b in zip(offsets, offsets[1:])]


def _listed(ids: list[bytes]) -> pa.ListArray:
    """An Arrow list for each of ``ids``."""
    offsets = np.cumsum([0, *map(len, ids)]) // 4
    return pa.ListArray.from_arrays(offsets.astype(np.int32), np.frombuffer(b"".join(ids), np.uint32))


def pieces(df: DataFrame, text_col: str, id_col: str, path: str, end_id: int = 0, capacity: int = 2048) -> DataFrame:
    """Documents as pieces of at most ``capacity`` tokens.

    Columns: ``id_col``, ``piece`` (from 0), ``start`` (ids of the document
    before it), ``length``, ``ids`` (little-endian unsigned 32-bit numbers).
    Every document ends with ``end_id``, so null and empty texts are one piece
    of one token. Only documents longer than ``capacity`` are cut. Repeated rows
    and null ids are packed like any other row.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = once(("ids", path), lambda: Ids(path))
        # What a task remembers is given back with it.
        library.known, library.older = {}, {}
        for part in steps(batches, "_text", STEP):
            ids = library.column(part.column("_text"))
            offsets = ids.offsets.to_numpy().astype(np.int64)
            # Behind each document its end.
            data = np.insert(ids.values.to_numpy(), offsets[1:], np.uint32(end_id)).astype("<u4", copy=False)
            sizes = np.diff(offsets) + 1
            count = -(-sizes // capacity)
            of = np.repeat(np.arange(len(sizes)), count)
            number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
            length = np.minimum(sizes[of] - number * capacity, capacity)
            bounds = np.cumsum([0, *4 * length]).astype(np.int32)
            cut = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [part.column("_id").take(pa.array(of)), pa.array(number.astype(np.int32)), pa.array(number * capacity), pa.array(length), cut],
                names=["_id", "piece", "start", "length", "ids"],
            )
        library.known, library.older = {}, {}

    cut = rows.mapInArrow(run, f"_id {kind}, piece int, start long, length long, ids binary")
    return cut.withColumnRenamed("_id", id_col)


def pack(df: DataFrame, size_col: str, key_cols: list[str], capacity: int = 2048) -> DataFrame:
    """``df`` with ``sequence_id`` and ``offset``: places in sequences of ``capacity`` tokens.

    Sizes lie between 1 and ``capacity``. Pieces are dealt to tasks by a hash of
    ``key_cols``, an even number to each. In a task they come in hash order,
    but pieces up to a sixteenth of a sequence last, largest first: they fill
    what gaps are left. Sequences that are not full then are opened again, and
    their pieces packed once more by the same rule, largest first. A task holds
    counts per gap and its open sequences. Pieces with equal keys and sizes may
    change places between runs. Columns of ``df`` named like the two added ones
    are replaced, others of any name come back. An empty table gives no rows.
    """
    row, size, key = F.struct(*df.columns), F.col(size_col).cast("long"), F.xxhash64(*key_cols)
    items = durable(df.select(row.alias("row"), size.alias("size"), key.alias("key")))
    small = F.col("size") <= capacity // 16
    order = [F.when(small, -F.col("size")), F.col("key"), F.col("size")]
    first = durable(_placed(items, items.count(), order, capacity))
    is_open = first.filter("open").select("bin")
    placed = first.filter("not open")
    loose = durable(placed.join(is_open, "bin", "left_semi").select(*items.columns))
    again = _placed(loose, loose.count(), [-F.col("size"), F.col("key")], capacity).filter("not open")
    # Sequences of the second pass are told apart by their sign.
    again = again.withColumn("bin", -1 - F.col("bin"))
    done = placed.join(is_open, "bin", "left_anti").select(*placed.columns).unionByName(again)
    stay = [F.col("row").getField(c).alias(c) for c in df.columns if c not in ("sequence_id", "offset")]
    return done.select(*stay, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))


def _placed(df: DataFrame, rows: int, order: list[Column], capacity: int) -> DataFrame:
    """``df`` (``row``, ``size``, ``key``) with its ``bin`` and ``at``; then a row for each bin that is ``open``."""
    tasks = max(1, -(-rows // PIECES_PER_TASK))
    schema = StructType([StructField(f.name, f.dataType) for f in df.schema]).add("bin", "long").add("at", "long").add("open", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base, kinds = SumOfSquares(capacity), TaskContext.get().partitionId() << 40, []

        def rows(columns: list, bins, starts, is_open: bool) -> pa.RecordBatch:
            flags = pa.array(np.full(len(bins), is_open))
            return pa.RecordBatch.from_arrays([*columns, pa.array(bins + base), starts, flags], names=schema.names)

        for batch in batches:
            kinds = batch.schema.types
            places = np.array([packer.place(n) for n in batch.column(1).to_pylist()], dtype=np.int64).reshape(-1, 2)
            yield rows(batch.columns, places[:, 0], pa.array(places[:, 1]), False)
        left = np.array(packer.leftovers(), dtype=np.int64)
        if len(left):
            yield rows([pa.nulls(len(left), k) for k in kinds], left, pa.nulls(len(left), pa.int64()), True)

    dealt = df.repartition(tasks, "key").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, schema)
