"""BPE encoding by a depth-first walk over a trie of distinct words, and decoding.

Every prefix of a word has one last token in its encoding, and that token does
not depend on what follows. So the distinct words of a batch go into a trie,
a depth-first walk finds the last token of every node from the states of its
ancestors, and words that share a prefix share its encoding. A token ``t`` may
end a prefix if the shorter prefix before it ends in a token ``p`` such that
the merges leave ``p t`` as it is.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from sluice.llm.workers import lists, once, steps

# Spellings of one generation that a worker remembers.
REMEMBERED = 250_000


# Latin letters in lower case with at most one mark behind them.
_LATIN = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u012f\u0131-\u024f]+)([!-/:-@\[-`{-~]?)").fullmatch


class TrieEncoder:
    """Encodes texts with the vocabulary and merges of a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        vocab = self.vocab
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        self.ranks = {(a, b): r for r, (a, b, _) in enumerate(merges)}
        # The merge that makes each token: rank, left and right part.
        self.made = {new: (r, a, b) for r, (a, b, new) in enumerate(merges)}
        if len(self.made) < len(merges):
            raise ValueError("two merges make one token")
        self.sizes = _sizes_by_tail(vocab, self.end)
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        # How Latin letters are written in byte-level words.
        bytes_of = ByteLevel(add_prefix_space=False, use_regex=False)
        self.latin = {c: bytes_of.pre_tokenize_str(chr(c))[0][0] for c in range(0xC0, 0x250)}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.single: dict[int, bool] = {}
        # Of each spelling its ids, as 32-bit numbers.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    # ---- which tokens may stand side by side

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """Do the merges before ``limit`` leave the seam between two tokens open?

        The last merge next to the seam is undone again and again. A pair that
        meets at the seam would have been merged if its rank comes before that
        of the merge undone last; of equal ranks the left one goes first.
        """
        ranks, made = self.ranks, self.made
        while ranks.get((left, right), limit) >= limit:
            before, after = made.get(left), made.get(right)
            if before and (not after or before[0] > after[0]):
                limit, _, left = before
            elif after:
                limit, right, _ = after
                limit += 1
            else:
                return True
        return False

    def _stands(self, token: int) -> bool:
        """Is the encoding of a token's own text that token?"""
        found = self.single.get(token)
        if found is None:
            rank, left, right = self.made.get(token, (0, None, None))
            found = left is None or (self._stands(left) and self._stands(right) and self._apart(left, right, rank))
            self.single[token] = found
        return found

    def _follows(self, before: int, token: int) -> bool:
        """May ``token`` come after ``before``, the last token of a prefix?"""
        found = self.pairs.get((before, token))
        if found is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            found = self._stands(token) and self._apart(before, token, len(self.ranks))
            self.pairs[before, token] = found
        return found

    # ---- the trie

    def words(self, words: Iterable[str]) -> dict[str, tuple[int, ...]]:
        """Encodings of distinct byte-level words, each prefix worked out once at most.

        Sorted words are the leaves of their trie in depth-first order: the path
        to a word goes on from the path to the word before where they part.
        States stay on the path until it leaves their node. A state is worked
        out when a longer prefix asks for it.
        """
        found: dict[str, tuple[int, ...]] = {}
        vocab, end, sizes = self.vocab, self.end, self.sizes
        pairs, follows, stands = self.pairs, self._follows, self._stands
        # Of each prefix on the path: its last token (0 unknown) with one added, and where that token starts.
        tokens, starts = [0], [0]
        word = ""

        def last(depth: int, mark: str) -> tuple[int, int]:
            for size in sizes.get(word[depth - 3 : depth] + mark, (2, 1)) if depth > 2 else (2, 1):
                start = depth - size
                token = vocab.get(word[start:depth] + mark) if start >= 0 else None
                if token is None:
                    continue
                if start == 0:
                    if stands(token):
                        return token, 0
                    continue
                if not tokens[start]:
                    settle(start)
                before = tokens[start] - 1
                fits = pairs.get((before, token))
                if fits or (fits is None and follows(before, token)):
                    return token, start
            raise ValueError(f"no token ends {word[:depth]!r}")

        def settle(depth: int) -> None:
            token, starts[depth] = last(depth, "")
            tokens[depth] = token + 1

        for next_word in sorted(words):
            shared = _shared(word, next_word)
            word, size = next_word, len(next_word)
            del tokens[shared + 1 :], starts[shared + 1 :]
            tokens += [0] * (size - len(tokens))
            starts += [0] * (size - len(starts))
            if size > 200:
                # In order, so that asking for a state never goes deep.
                for depth in range(1, size):
                    if not tokens[depth]:
                        settle(depth)
            token, start = last(size, end)
            ids = [token]
            while start:
                ids.append(tokens[start] - 1)
                start = starts[start]
            found[word] = tuple(reversed(ids))
        return found

    # ---- texts

    def _parts(self, spellings: list[str]) -> Iterator[list[str]]:
        """Byte-level words of each white-space free piece of text."""
        normal = self.normalizer.normalize_str(" ".join(spellings)).split(" ")
        if len(normal) != len(spellings):
            normal = [self.normalizer.normalize_str(s) for s in spellings]
        for text in normal:
            # Letters with at most one mark behind them need no pattern.
            if text.isascii():
                if text.isalpha():
                    yield [text]
                    continue
                if text[:-1].isalpha() and text[-1].isprintable() and not text[-1].isdigit():
                    yield [text[:-1], text[-1]]
                    continue
            elif found := _LATIN(text):
                letters = found[1].translate(self.latin)
                yield [letters, found[2]] if found[2] else [letters]
                continue
            yield [w for w, _ in self.pre_tokenizer.pre_tokenize_str(text)]

    def _learn(self, spellings: list[str]) -> dict[str, bytes]:
        """Encodings of pieces of text that are not remembered."""
        cut = dict(zip(spellings, self._parts(spellings)))
        words = {w: array("i", ids).tobytes() for w, ids in self.words(set(chain.from_iterable(cut.values()))).items()}
        return {s: words[p[0]] if len(p) == 1 else b"".join([words[w] for w in p]) for s, p in cut.items()}

    def _segments(self, text: str) -> list[list[str] | int]:
        """Spellings between white space, and ids of special tokens written in the text."""
        if "<|" not in text:
            return [spellings(text)]
        parts: list[list[str] | int] = []
        rest = text
        while rest:
            at, mark = min(((rest.find(m), m) for m in self.special if m in rest), default=(len(rest), ""))
            parts.append(spellings(rest[:at]))
            if mark:
                parts.append(self.special[mark])
            rest = rest[at + len(mark) :]
        return parts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the tokenizer gives them without added special tokens.

        Spellings are remembered in two generations of bounded size, so that
        frequent ones stay.
        """
        cut = [self._segments(t) for t in texts]
        met = set(chain.from_iterable(p for parts in cut for p in parts if isinstance(p, list)))
        known, old = self.known, self.older
        fresh = [s for s in met if s not in known]
        known |= {s: old[s] for s in fresh if s in old}
        known |= self._learn([s for s in fresh if s not in old])
        find = known.__getitem__
        out = [
            b"".join([b"".join(map(find, p)) if isinstance(p, list) else array("i", [p]).tobytes() for p in parts]) for parts in cut
        ]
        if len(known) > REMEMBERED:
            self.known, self.older = {}, known
        return [np.frombuffer(ids, np.int32) for ids in out]

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by one space: the tokenizer names no decoder."""
        return " ".join(map(self.tokens.__getitem__, ids))


def _sizes_by_tail(vocab: Iterable[str], end: str) -> dict[str, tuple[int, ...]]:
    """Lengths that tokens have, longest first, by their last three characters with the mark of a word's end if they have one."""
    sizes: dict[str, set[int]] = {}
    for token in vocab:
        for text, mark in ((token, ""), (token.removesuffix(end), end))[: 1 + token.endswith(end)]:
            if len(text) > 2:
                sizes.setdefault(text[-3:] + mark, {1, 2}).add(len(text))
    return {tail: tuple(sorted(found, reverse=True)) for tail, found in sizes.items()}


def _shared(one: str, other: str) -> int:
    """Length of the common prefix."""
    size = 0
    for a, b in zip(one, other):
        if a != b:
            break
        size += 1
    return size


def spellings(text: str) -> list[str]:
    """The text split at white space as the tokenizer knows it.

    ``str.split`` also splits at four separators that the tokenizer keeps.
    """
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        import regex

        return [s for s in regex.split(r"[\t-\r \x85\xa0  -     　]+", text) if s]
    return text.split()


def encode(df: DataFrame, text_col: str, id_col: str, path: str, *, round_trip: bool = False) -> DataFrame:
    """``id_col`` and ``token_ids`` of every row.

    Null and empty texts give no ids. Rows are independent: repeated rows and
    null ids come back as they are. Memory per task is bounded by the longest
    text plus a fixed number of remembered spellings. Only the two named
    columns are read. With ``round_trip`` the ids are decoded at once, in the
    same worker, to a column ``decoded``.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = df.schema[id_col].dataType.simpleString()
    names = ["_id", "token_ids", *["decoded"] * round_trip]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(("bpe", path), lambda: TrieEncoder(path))
        for part in steps(batches, "_text"):
            ids = encoder.encode(part.column("_text").to_pylist())
            columns = [part.column("_id"), lists(ids, np.int32)]
            if round_trip:
                columns.append(pa.array([encoder.decode(i.tolist()) for i in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"_id {kind}, token_ids array<int>" + ", decoded string" * round_trip
    return rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def decode(df: DataFrame, ids_col: str, path: str, out_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its token ids; null ids give an empty text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = once(("bpe", path), lambda: TrieEncoder(path))
        for batch in batches:
            yield batch.map(lambda ids: "" if ids is None else encoder.decode(ids.tolist()))

    return df.withColumn(out_col, run(F.col(ids_col)))
