import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import bpe, packing


@pytest.fixture(scope="module")
def library(path):
    return Tokenizer.from_file(path)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_every_token_spells_itself(path):
    encoder = bpe.TrieEncoder(path)
    assert all(encoder._stands(t) for t in encoder.vocab.values())


def test_random_words(path, library):
    rng = random.Random(3)
    alphabet = "aaabcdeeeinorst'.,!0189éßñÇ☃́中\x1c\x85 \n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    got = bpe.TrieEncoder(path).encode(texts)
    assert [g.tolist() for g in got] == [ids_of(library, t) for t in texts]
    asked = packing.Ids(path).encode(texts)
    assert [np.frombuffer(g, np.uint32).tolist() for g in asked] == [ids_of(library, t) for t in texts]


def test_forgetting_changes_nothing(path, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 5)
    monkeypatch.setattr(packing, "REMEMBERED_IDS", 5)
    encoder, ids = bpe.TrieEncoder(path), packing.Ids(path)
    for text in ("one two three four", "five six seven one", "two three nine ten eleven twelve", "one nine"):
        assert encoder.encode([text])[0].tolist() == ids_of(library, text)
        assert np.frombuffer(ids.encode([text])[0], np.uint32).tolist() == ids_of(library, text)


def test_round_trip(docs, texts, nothing, path, library):
    coded = bpe.encode(docs, "text", "doc_id", path, round_trip=True)
    coded = bpe.decode(coded, "token_ids", path, "again")
    got = sorted((str(r.doc_id), r.token_ids, r.decoded, r.again) for r in coded.collect())
    want = []
    for i, t in texts:
        ids = ids_of(library, t)
        text = library.decode(ids, skip_special_tokens=False)
        want.append((str(i), ids, text, text))
    assert got == sorted(want)
    assert bpe.encode(nothing, "text", "doc_id", path).count() == 0


def check_places(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pieces_and_places(docs, texts, nothing, path, library):
    cut = packing.pieces(docs, "text", "doc_id", path)
    rows = packing.pack(cut, "length", ["doc_id", "piece"]).collect()
    want = defaultdict(int)
    for i, t in texts:
        ids = [*ids_of(library, t), 0]
        for n, start in enumerate(range(0, len(ids), 2048)):
            want[i, n, start, np.array(ids[start : start + 2048], "<u4").tobytes()] += 1
    got = defaultdict(int)
    for r in rows:
        got[r.doc_id, r.piece, r.start, bytes(r.ids)] += 1
    assert got == want
    assert check_places(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 2
    assert packing.pack(packing.pieces(nothing, "text", "doc_id", path), "length", ["doc_id"]).count() == 0


def test_rule_takes_the_smallest_sum_of_squares():
    rng, packer = random.Random(1), packing.SumOfSquares(20)
    gaps = []
    for _ in range(500):
        size = rng.randrange(1, 21)

        def cost(after):
            counts = np.bincount([g for g in after if g], minlength=21)
            return int((counts**2).sum())

        options = [gaps[:i] + [g - size] + gaps[i + 1 :] for i, g in enumerate(gaps) if g >= size] + [gaps + [20 - size]]
        sequence, offset = packer.place(size)
        if sequence == len(gaps):
            assert offset == 0
            gaps.append(20 - size)
        else:
            assert offset == 20 - gaps[sequence]
            gaps[sequence] -= size
        assert cost(gaps) == min(map(cost, options))


def test_many_tasks_stay_dense(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_TASK", 400)
    rng = random.Random(5)
    rows = [(i, rng.randrange(1, 2049)) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, length long")
    packed = packing.pack(df, "length", ["doc_id"]).collect()
    assert sorted((r.doc_id, r.length) for r in packed) == rows
    bound = -(-sum(n for _, n in rows) // 2048)
    assert check_places(packed, 2048) <= 1.05 * bound


def test_spellings_cut_here_have_the_ids_of_the_library(path, library):
    rng = random.Random(8)
    letters = "abcXYZäöÜßéÀÿŁİıǅɏ×÷µªʰж中'-,.!?`{0٣́­"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 9))) + rng.choice(["", ",", "'", "s'", "..", "'s"]) for _ in range(400)) for _ in range(40)]
    ids, own = packing.Ids(path), bpe.TrieEncoder(path)
    for text, data, found in zip(texts, ids.encode(texts), own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(data, np.uint32).tolist() == found.tolist() == want


def test_a_word_is_asked_for_once_whatever_marks_follow(path, library):
    ids, asked = packing.Ids(path), []
    learn = ids._learn_words
    ids._learn_words = lambda new: (asked.extend(new), learn(new))
    texts = ["Straße straße, STRASSE? (straße)", " straße!? Straße... straße\u3000straße", "", "<|endoftext|> Straße"]
    got = ids.encode(texts)
    assert [np.frombuffer(g, np.uint32).tolist() for g in got] == [ids_of(library, t) for t in texts]
    assert sorted(asked) == ["strasse", "straße"]


def test_every_plain_letter_has_the_ids_of_the_library(path, library):
    text = " ".join(f"{c} x{c}y{m}{m}" for c in map(chr, range(0x250)) for m in "!'|~" if c.isprintable())
    assert np.frombuffer(packing.Ids(path).encode([text])[0], np.uint32).tolist() == ids_of(library, text)


def test_names_of_columns_do_not_clash(spark):
    names = ["size", "row", "key", "bin", "at", "open", "_bin", "_at", "_open", "sequence_id", "offset"]
    df = spark.range(50).select("id", (F.col("id") % 7 + 1).alias("length"), *[F.lit(f"own {c}").alias(c) for c in names])
    got = packing.pack(df, "length", ["id"], 16)
    assert got.columns == ["id", "length", *names]
    rows = got.collect()
    assert len(rows) == 50 and all(r[c] == f"own {c}" for r in rows for c in names[:-2])
    assert len({(r.sequence_id, r.offset) for r in rows}) == 50
