"""Masked pseudo-likelihood: every token predicted from the words on both sides.

A small network sees two words to the left and two to the right of a place and
predicts the class of the word that stands there: common words are classes of
their own, rare words share classes. The share of a word in its class comes from
the counts of all words of the corpus, a table that grows with it. The logarithms
of these conditional probabilities, summed over all tokens, score a document.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.workers import steps
from sluice.session import durable

# Words that are classes of their own; all classes, as groups of members.
SINGLE, GROUPS, MEMBERS, HIDDEN = 3072, 64, 64, 16
CLASSES = GROUPS * MEMBERS
# Common words whose counts every task holds; the counts of all others are joined.
KNOWN = 1 << 18
# Places seen: offsets from the masked word.
AROUND = (-2, -1, 1, 2)
# Tokens of one shard of documents, which one network sees between two averages. A shard depends on ids and texts
# alone, so files and partitions do not change what is learnt.
SHARD_TOKENS = 1 << 18
# A round trains on one shard in ``ROUNDS``, the next round on others: every token trains once.
ROUNDS, BATCH, RATE = 4, 8192, 0.03
# Parts in which networks are averaged, and shards that one task trains on.
PARTS, SHARDS_PER_TASK = 64, 4


def vocabulary(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different words of texts as 64-bit hashes, the place of each token's word in them, and the tokens of each text."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    words = [t.lower().encode().split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    return np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number)).view(np.int64), ids, sizes


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words of texts laid end to end, as 64-bit hashes, and the tokens of each text."""
    words, ids, sizes = vocabulary(texts)
    return words[ids], sizes


@dataclass
class Known:
    """What every task holds of the vocabulary: common words in order, with class and count; words of each shared class."""

    words: np.ndarray
    classes: np.ndarray
    counts: np.ndarray
    totals: np.ndarray

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of words among the common ones, and whether they are there."""
        at = np.minimum(np.searchsorted(self.words, words), max(len(self.words) - 1, 0))
        return at, self.words[at] == words if len(self.words) else np.zeros(len(words), dtype=bool)

    def __getitem__(self, words: np.ndarray) -> np.ndarray:
        """Classes of words: that of a common word, or one by hash."""
        at, met = self.find(words)
        of = SINGLE + words % (CLASSES - SINGLE)
        of[met] = self.classes[at[met]]
        return of.astype(np.int16)

    def shares(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Logarithm of the share of words in their classes, given how often they occur.

        One added to every count: a word never met still has a probability.
        """
        of = self[words]
        return np.where(of < SINGLE, 0.0, np.log(counts + 1.0) - np.log(self.totals[of]))


@dataclass
class Classes:
    """Words in classes: the most frequent alone, the rest by hash. ``table`` has the count of every word."""

    of: Known
    table: DataFrame
    tokens: int

    @classmethod
    def from_counts(cls, table: DataFrame) -> Classes:
        # Words by size of count, in sixteenths of an octave: a few hundred rows.
        level = F.floor(16 * F.log2("n"))
        sizes = table.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
        common, above = F.lit(True), 0
        for size, n in sizes:
            if above + n > KNOWN:
                # Of the words at the limit as many as have room; words are hashes, so any range of them is a sample.
                cut = int(-(2**63) + (KNOWN - above) / n * 2**64)
                common = (level > size) | ((level == size) & (F.col("word") < F.lit(min(cut, 2**63 - 1))))
                break
            above += n
        found = table.filter(common).toPandas()
        words, counts = found["word"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
        shared = CLASSES - SINGLE
        of = SINGLE + words % shared
        single = np.lexsort([words, -counts])[:SINGLE]
        totals = np.ones(CLASSES)
        tokens = 0
        for residue, total, words_met in table.groupBy(F.pmod("word", F.lit(shared))).agg(F.sum("n"), F.count("n")).collect():
            totals[SINGLE + residue] += total + words_met
            tokens += total
        np.subtract.at(totals, of[single], counts[single] + 1)
        of[single] = np.arange(len(single))
        totals[: len(single)] = counts[single] + 1
        order = np.argsort(words)
        known = Known(words[order], of[order].astype(np.int16), counts[order], totals)
        return cls(known, table, tokens)


class Network:
    """Tables of what each class adds at each place, one hidden layer, a softmax over groups of classes and one over
    the members of the group."""

    def __init__(self, values: np.ndarray | None = None):
        self.shapes = [
            (len(AROUND), CLASSES + 1, HIDDEN), (HIDDEN,), (HIDDEN, GROUPS), (GROUPS,), (GROUPS, HIDDEN, MEMBERS), (GROUPS, MEMBERS)
        ]
        size = sum(int(np.prod(s)) for s in self.shapes)
        if values is None:
            values = np.random.default_rng(5).normal(0, 0.1, size)
        self.values = np.array(values, dtype=np.float32)
        self.cuts = np.cumsum([int(np.prod(s)) for s in self.shapes])[:-1]
        self.parts = self.split(self.values)

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        return [p.reshape(s) for p, s in zip(np.split(values, self.cuts), self.shapes)]

    @classmethod
    def of_shares(cls, totals: np.ndarray) -> Network:
        """A network that starts from the share of each class, whatever stands around."""
        own = cls()
        mass = totals.reshape(GROUPS, MEMBERS)
        own.parts[3][:] = np.log(mass.sum(axis=1) / mass.sum())
        own.parts[5][:] = np.log(mass / mass.sum(axis=1, keepdims=True))
        return own

    def hidden(self, context: np.ndarray) -> np.ndarray:
        places, bias = self.parts[:2]
        total = bias + places[0][context[0]]
        for place, classes in zip(places[1:], context[1:]):
            total += place[classes]
        return np.tanh(total, out=total)

    def members(self, hidden: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """What the layer of each row's group gives; rows are ordered by group. And the rows of each group."""
        ends = np.searchsorted(group, np.arange(GROUPS + 1))
        runs = [(g, slice(ends[g], ends[g + 1])) for g in np.flatnonzero(np.diff(ends))]
        out = self.parts[5][group]
        for g, run in runs:
            out[run] += hidden[run] @ self.parts[4][g]
        return out, runs

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        order = np.argsort(target, kind="stable")
        group, member = np.divmod(target[order], MEMBERS)
        hidden = self.hidden(context[:, order])
        found, rows = np.empty(len(target)), np.arange(len(target))
        total = 0
        for out, at in ((hidden @ self.parts[2] + self.parts[3], group), (self.members(hidden, group)[0], member)):
            own = out[rows, at]
            total = total + own - np.log(np.exp(out, out=out).sum(axis=1))
        found[order] = total
        return found

    def gradient(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Of the mean loss, by all parameters."""
        order = np.argsort(target, kind="stable")
        context, target = context[:, order], target[order]
        group, member = np.divmod(target, MEMBERS)
        hidden, rows = self.hidden(context), np.arange(len(target))
        first = hidden @ self.parts[2] + self.parts[3]
        second, runs = self.members(hidden, group)
        share = np.float32(1 / len(target))
        for out, at in ((first, group), (second, member)):
            # Hidden values lie between -1 and 1, so no weight that learning gives makes this overflow.
            np.exp(out, out=out)
            out *= (share / out.sum(axis=1))[:, None]
            out[rows, at] -= share
        gradient = np.zeros(len(self.values), dtype=np.float32)
        tables, bias, groups, group_bias, layers, layer_bias = self.split(gradient)
        back = first @ self.parts[2].T
        for g, run in runs:
            back[run] += second[run] @ self.parts[4][g].T
            layers[g] = hidden[run].T @ second[run]
            layer_bias[g] = second[run].sum(axis=0)
        groups[:], group_bias[:] = hidden.T @ first, first.sum(axis=0)
        back *= 1 - hidden**2
        bias[:] = back.sum(axis=0)
        flat, columns = back.ravel(), np.arange(HIDDEN)
        for table, classes in zip(tables, context):
            at = classes.astype(np.int64)[:, None] * HIDDEN + columns
            table.ravel()[:] = np.bincount(at.ravel(), flat, minlength=table.size)
        return gradient


class Adam:
    """Steps by running means of gradients and of their squares."""

    def __init__(self, network: Network):
        self.network, self.time = network, 0
        self.mean, self.square, self.room = (np.zeros_like(network.values) for _ in range(3))

    def step(self, gradient: np.ndarray, rate: float) -> None:
        self.time += 1
        rate *= np.sqrt(1 - 0.99**self.time) / (1 - 0.9**self.time)
        room = self.room
        self.mean *= 0.9
        self.mean += np.multiply(gradient, np.float32(0.1), out=room)
        self.square *= 0.99
        gradient *= gradient
        self.square += np.multiply(gradient, np.float32(0.01), out=room)
        np.sqrt(self.square, out=room)
        room += 1e-6
        np.divide(self.mean, room, out=room)
        room *= rate
        self.network.values -= room


def contexts(classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Classes at each place around every token; ``CLASSES`` beyond the ends of a text."""
    start = np.repeat(np.cumsum(sizes) - sizes, sizes)
    stop = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(len(classes))
    out = np.full((len(AROUND), len(classes)), CLASSES, dtype=np.int16)
    for row, offset in zip(out, AROUND):
        inside = (at + offset >= start) & (at + offset < stop)
        row[inside] = classes[at[inside] + offset]
    return out


def word_counts(rows: DataFrame) -> DataFrame:
    """How often each word occurs, over all documents: a table of ``word`` and ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_text"):
            words, ids, _ = vocabulary(part.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(np.bincount(ids, minlength=len(words)))], names=["word", "n"])

    counted = rows.select("_text").mapInArrow(run, "word long, n long")
    return durable(counted.groupBy("word").agg(F.sum("n").alias("n")))


def coded(df: DataFrame, text_col: str, id_col: str, classes: Classes) -> DataFrame:
    """The documents as class numbers, two bytes a token, so that texts are cut into words once more only.

    Columns: ``_id``, ``order`` (a hash of id and text), ``n_tokens``, ``classes``,
    ``common`` (logarithms of the shares that the task knows) and ``rare`` (words
    whose counts are joined).
    """
    kind = df.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = F.xxhash64(F.col(id_col).cast("string"), text)
    rows = df.select(F.col(id_col).alias("_id"), order.alias("order"), text.alias("_text"))
    known = classes.of
    names = ["_id", "order", "n_tokens", "classes", "common", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in steps(batches, "_text"):
            words, ids, sizes = vocabulary(part.column("_text").to_pylist())
            at, met = known.find(words)
            counts = np.zeros(len(words))
            counts[met] = known.counts[at[met]]
            row = np.repeat(np.arange(len(sizes)), sizes)
            common = np.bincount(row, known.shares(words, counts)[ids], minlength=len(sizes))
            open_ = ~met[ids]
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[open_], minlength=len(sizes)))]).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(ends), pa.array(words[ids[open_]]))
            data, stops = known[words][ids].tobytes(), (2 * np.cumsum(sizes)).tolist()
            found = [data[a:b] for a, b in zip([0, *stops], stops)]
            yield pa.RecordBatch.from_arrays(
                [part.column("_id"), part.column("order"), pa.array(sizes), pa.array(found, pa.binary()), pa.array(common), rare], names=names
            )

    return durable(rows.mapInArrow(run, f"_id {kind}, order long, n_tokens long, classes binary, common double, rare array<long>"))


def sharded(documents: DataFrame, tokens: int) -> DataFrame:
    """Shards of about ``SHARD_TOKENS`` tokens: ``round``, ``classes`` and ``sizes``, documents in order of their hash."""
    count = max(ROUNDS, -(-tokens // SHARD_TOKENS))

    def pack(group: pa.Table) -> pa.Table:
        order = np.lexsort([group.column("n_tokens").to_numpy(), group.column("order").to_numpy()])
        group = group.take(pa.array(order))
        data = b"".join(group.column("classes").to_pylist())
        return pa.table({"shard": group.column("shard")[:1], "classes": pa.array([data], pa.binary()), "sizes": pa.array([group.column("n_tokens").to_pylist()], pa.list_(pa.int64()))})

    rows = documents.filter("n_tokens > 0").select(F.pmod("order", F.lit(count)).alias("shard"), "order", "n_tokens", "classes")
    found = rows.groupBy("shard").applyInArrow(pack, "shard long, classes binary, sizes array<long>")
    return durable(found.withColumn("round", (F.col("shard") % ROUNDS).cast("int")))


def train(shards: DataFrame, network: Network, number: int) -> Network:
    """One round: for every shard of it a network goes on from ``network``; their mean by tokens is the result.

    Networks are summed in tasks and averaged in parts, so the driver gets one
    network, whatever the number of shards.
    """
    start, size, rate = network.values, BATCH, RATE / (1 + number / 2)

    def learn(classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        own = Network(start)
        adam, around = Adam(own), contexts(classes, sizes)
        chosen = np.random.default_rng(len(classes)).permutation(len(classes))
        around, target = around[:, chosen], classes[chosen]
        steps_ = range(0, len(target), size)
        for done, at in enumerate(steps_):
            adam.step(own.gradient(around[:, at : at + size], target[at : at + size]), rate * (1 - 0.9 * done / len(steps_)))
        return own.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(start)), 0
        for batch in batches:
            for data, sizes in zip(batch.column("classes"), batch.column("sizes")):
                classes = np.frombuffer(data.as_py(), np.int16)
                total += learn(classes, sizes.values.to_numpy()) * float(len(classes))
                seen += len(classes)
        if seen:
            parts = [p.tobytes() for p in np.array_split(total, PARTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary()), pa.array([float(seen)] * PARTS)],
                names=["at", "own", "seen"],
            )

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for at, own, seen in zip(*(c.to_pylist() for c in batch.columns)):
                total = sums.setdefault(at, [0.0, 0.0])
                total[0] = total[0] + np.frombuffer(own)
                total[1] += seen
        means = [(v / n).astype(np.float32).tobytes() for v, n in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(means, pa.binary())], names=["at", "own"])

    # A shard is half a megabyte, so files are cut finer than for a scan.
    own = shards.filter(F.col("round") == number).select("shard", "classes", "sizes")
    dealt = own.repartition(max(1, own.count() // SHARDS_PER_TASK), "shard")
    trained = dealt.select("classes", "sizes").mapInArrow(run, "at int, own binary, seen double")
    found = trained.repartition("at").mapInArrow(mean, "at int, own binary").collect()
    parts = np.array_split(start, PARTS)
    for at, values in found:
        parts[at] = np.frombuffer(values, np.float32)
    return Network(np.concatenate(parts))


def learn(documents: DataFrame, classes: Classes) -> Network:
    """The network of a corpus, from all tokens of its coded documents; it is of fixed size."""
    network, shards = Network.of_shares(classes.of.totals), sharded(documents, classes.tokens)
    for number in range(ROUNDS):
        network = train(shards, network, number)
    return network


def classes_of(df: DataFrame, text_col: str) -> Classes:
    return Classes.from_counts(word_counts(df.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))))


def fit(df: DataFrame, text_col: str, id_col: str) -> tuple[Classes, Network]:
    """Classes and network of a corpus."""
    classes = classes_of(df, text_col)
    return classes, learn(coded(df, text_col, id_col, classes), classes)


def score(df: DataFrame, text_col: str, id_col: str, classes: Classes, network: Network) -> DataFrame:
    """``id_col``, ``n_tokens``, ``log_likelihood`` and ``mean_log_likelihood`` of every row.

    Tokens are lower-case words between white space; all of them are predicted.
    Null, empty and blank texts have no tokens, a sum of 0 and no mean. Rows are
    scored one by one, so repeated rows have one score. Only two columns are read.
    Counts of words that are not common are joined from the table of words.
    """
    return scored(coded(df, text_col, id_col, classes), id_col, classes, network)


def fit_and_score(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """Columns of ``score`` for the corpus that the network learns from; its texts are coded once."""
    classes = classes_of(df, text_col)
    documents = coded(df, text_col, id_col, classes)
    return scored(documents, id_col, classes, learn(documents, classes))


def scored(documents: DataFrame, id_col: str, classes: Classes, network: Network) -> DataFrame:
    kind, values = documents.schema["_id"].dataType.simpleString(), network.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network(values)
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            target = np.frombuffer(b"".join(batch.column("classes").to_pylist()), np.int16)
            around = contexts(target, sizes)
            found = np.zeros(len(target))
            for at in range(0, len(target), BATCH):
                found[at : at + BATCH] = own.log_probabilities(around[:, at : at + BATCH], target[at : at + BATCH])
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), found, minlength=len(sizes)) + batch.column("common").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("n_tokens"), pa.array(total), batch.column("rare")], names=["_id", "n_tokens", "common", "rare"]
            )

    found = documents.select("_id", "n_tokens", "classes", "common", "rare")
    found = found.mapInArrow(run, f"_id {kind}, n_tokens long, common double, rare array<long>")
    found = durable(found.withColumn("row", F.monotonically_increasing_id()))
    # A common word is known to the tasks, so no word here has more than a small share of the rows.
    rare = found.select("row", F.explode("rare").alias("word")).join(classes.table, "word")
    rare = rare.groupBy("row").agg(F.sum(F.log(F.col("n") + 1.0)).alias("rare_sum"))
    total = F.col("common") + F.coalesce("rare_sum", F.lit(0.0))
    return found.select("_id", "row", "n_tokens", "common").join(rare, "row", "left").select(
        F.col("_id").alias(id_col), "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"),
    )
