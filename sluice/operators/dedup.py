"""Duplicate removal: exact, character-set and MinHash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import WORD, barrier, chars_of, find_all, hashed_ngrams, let
from sluice.session import durable


def content_key(text: Column) -> Column:
    """16-byte fingerprint; shuffled in place of the text."""
    return F.unhex(F.md5(text))


def first_of_copies(df: DataFrame, text_col: str, order: str) -> DataFrame:
    """Fingerprint and smallest ``order`` value of every distinct text.

    A plain aggregate, so a text that makes up a third of the table is reduced
    to one row per input partition before anything is shuffled.
    """
    return df.groupBy(content_key(F.col(text_col)).alias("_key")).agg(F.min(order).alias("_first"))


def exact_duplicates(df: DataFrame, text_col: str, order: str) -> DataFrame:
    """``df`` with ``is_duplicate``: true for all but the earliest copy.

    ``order`` must be unique. Only winners are joined back, on the unique
    order column, so copies of one text never meet in one task.
    """
    winners = first_of_copies(df, text_col, order).select(F.col("_first").alias(order), F.lit(True).alias("_kept"))
    return df.join(winners, order, "left").withColumn("is_duplicate", F.col("_kept").isNull()).drop("_kept")


def exact_dedup(df: DataFrame, text_col: str, order: str) -> DataFrame:
    """The earliest copy of every text.

    Only fingerprints and orders are aggregated, in hash tables; the rows that
    lose are few as a rule, and are taken out by their unique ``order``. Texts
    are neither sorted nor part of an aggregate.
    """
    key = content_key(F.col(text_col))
    first = first_of_copies(df, text_col, order).withColumnRenamed("_key", "_first_key")
    losers = df.select(key.alias("_key"), F.col(order).alias("_order"))
    losers = losers.join(first, F.col("_key").eqNullSafe(F.col("_first_key")) & (F.col("_order") > F.col("_first"))).select("_order")
    return df.join(losers, df[order] == losers["_order"], "left_anti")


def distinct_values(df: DataFrame, columns: list[str], value_name: str = "value") -> DataFrame:
    """Melt the columns into one, drop nulls, keep each value once."""
    long = df.select(F.explode(F.array(*columns)).alias(value_name))
    return long.dropna().dropDuplicates([value_name])


# ---- character-set near duplicates ------------------------------------------


def charset_signature(text: Column) -> Column:
    return F.array_sort(F.array_distinct(chars_of(F.lower(text))))


def charset_dedup(
    df: DataFrame, text_col: str, order: str, threshold: float = 0.85, block: int = 1024
) -> DataFrame:
    """Keep-first near-duplicate removal over sets of characters.

    A text goes if its character set has a Jaccard score above ``threshold``
    with that of an earlier text that stayed. Texts with one set collapse first.
    Then the earliest ``block`` open sets are settled among themselves, and the
    ones that stay are compared with all later open sets in parallel; this
    repeats until no set is open. Each round sends at most ``block`` sets out,
    and rows that find a match leave at once, so the work is (sets) x (sets
    that stay), never all pairs. Every set is compared with every earlier one
    that stayed: no candidate is skipped.
    """
    sets = (
        df.filter(F.length(text_col) > 0)
        .groupBy(F.array_join(charset_signature(F.col(text_col)), "").alias("_set"))
        .agg(F.min(order).alias("_first"))
    )
    open_sets = durable(sets)
    kept: DataFrame | None = None
    while True:
        head = open_sets.orderBy("_first").limit(block).collect()
        if not head:
            break
        stay = _settle([(r["_first"], r["_set"]) for r in head], threshold)
        last = head[-1]["_first"]
        settled = open_sets.filter(F.col("_first").isin([first for first, _ in stay])).select("_first")
        kept = settled if kept is None else kept.unionByName(settled)
        if len(head) < block:
            break
        later = open_sets.filter(F.col("_first") > last)
        near = _near_any([chars for _, chars in stay], threshold)
        open_sets = durable(later.filter(~near(F.col("_set"))))
    empties = df.filter(F.coalesce(F.length(text_col), F.lit(0)) == 0)
    if kept is None:
        return empties
    return df.join(kept.withColumnRenamed("_first", order), order, "left_semi").unionByName(empties)


def _settle(rows: list[tuple], threshold: float) -> list[tuple]:
    """Keep-first rule inside one bounded block."""
    stay: list[tuple] = []
    seen: list[frozenset] = []
    for first, chars in rows:
        letters = frozenset(chars)
        if not any(len(letters & s) / len(letters | s) > threshold for s in seen):
            stay.append((first, chars))
            seen.append(letters)
    return stay


def _near_any(pivots: list[str], threshold: float):
    """Arrow predicate: is a set within ``threshold`` of one of the pivots?"""
    alphabet = {c: i for i, c in enumerate(sorted(set("".join(pivots))))}
    matrix = np.zeros((len(alphabet), len(pivots)), dtype=np.float32)
    for j, chars in enumerate(pivots):
        for c in chars:
            matrix[alphabet[c], j] = 1.0
    sizes = np.array([len(p) for p in pivots], dtype=np.float32)

    @F.pandas_udf("boolean")
    def near(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = np.zeros(len(batch), dtype=bool)
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at : at + 1024]
                rows = np.zeros((len(part), len(alphabet)), dtype=np.float32)
                for i, chars in enumerate(part):
                    rows[i, [alphabet[c] for c in chars if c in alphabet]] = 1.0
                shared = (rows @ matrix).astype(np.float64)
                union = part.str.len().to_numpy()[:, None] + sizes[None, :] - shared
                found[at : at + 1024] = (shared / union > threshold).any(axis=1)
            yield pd.Series(found)

    return near


# ---- MinHash near duplicates ------------------------------------------------


def shingles(text: Column, n: int = 5) -> Column:
    """Hashes of the distinct word ``n``-grams; shorter texts are one shingle."""
    grams = F.array_distinct(hashed_ngrams(find_all(F.lower(text), WORD), n))
    whole = F.array(F.xxhash64(F.lower(text)))
    return let(grams, lambda g: F.when(F.size(g) > 0, g).otherwise(whole))


def band_keys(hashes: Column, num_perm: int, bands: int) -> Column:
    """MinHash signature of an array of hashes, folded to one key per band."""
    rows = num_perm // bands
    rng = np.random.RandomState(17)
    multipliers = (rng.randint(1, 2**62, num_perm).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
    offsets = rng.randint(0, 2**62, num_perm).astype(np.uint64)
    folds = (rng.randint(1, 2**62, rows).astype(np.uint64) << np.uint64(1)) | np.uint64(1)

    @F.pandas_udf("array<bigint>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            keys = []
            for values in batch:
                h = np.asarray(values, dtype=np.int64).view(np.uint64)
                lowest = np.full(num_perm, np.iinfo(np.uint64).max, dtype=np.uint64)
                for at in range(0, len(h), 4096):
                    mixed = h[at : at + 4096, None] * multipliers[None, :] + offsets[None, :]
                    mixed ^= mixed >> np.uint64(29)
                    np.minimum(lowest, mixed.min(axis=0), out=lowest)
                folded = (lowest.reshape(bands, rows) * folds[None, :]).sum(axis=1, dtype=np.uint64)
                keys.append(folded.view(np.int64))
            yield pd.Series(keys)

    return run(hashes)


def minhash_duplicates(
    df: DataFrame,
    text_col: str,
    order: str,
    *,
    num_perm: int = 128,
    threshold: float = 0.9,
    ngram: int = 5,
    bands: int = 16,
) -> DataFrame:
    """``order`` values of the rows to drop.

    A row is dropped if an earlier row of the rows that share a band has an
    exact shingle Jaccard score of ``threshold`` with it. At 0.9 a pair shares
    one of 16 bands of 8 with a probability of 0.9999; a band alone drops nothing.

    The number of jobs is fixed. Exact copies collapse by an aggregate. Every
    row of a shared band meets the band's earliest row, found by ``min``; most
    near copies leave here. What is left meets earlier rows through its rarest
    shingles: sets with the score share one of each other's ``n - ceil(t n) + 1``
    rarest, so rows that only share a frequent phrase never meet, and no pair
    is lost. Pairs whose sizes alone rule the score out are left before any
    shingles move. Shingles are worked out for rows in shared bands only.
    """
    text = F.col(text_col)
    grams = shingles(text, ngram)
    rows = df.select(F.col(order).alias("id"), content_key(text).alias("copy"), grams.alias("grams"))
    # Bands and sizes stay, the shingles do not: they are longer than the text.
    rows = barrier(rows, bands=band_keys(F.col("grams"), num_perm, bands), n=F.size("grams")).drop("grams")
    docs = durable(rows)
    first = docs.groupBy("copy").agg(F.min("id").alias("id"), F.min_by("bands", "id").alias("bands"), F.first("n").alias("n"))
    members = durable(first.select("id", "n", F.posexplode("bands").alias("band", "key")))
    copies = docs.select("id").join(members.filter("band = 0").select("id"), "id", "left_anti")
    shared = members.groupBy("band", "key").agg(
        F.min_by(F.struct("id", "n"), "id").alias("low"), F.count(F.lit(1)).alias("rows")
    ).filter("rows > 1")
    crowded = durable(members.join(shared.select("band", "key", "low"), ["band", "key"]))
    ids = crowded.select("id").distinct()
    sets = durable(df.select(F.col(order).alias("id"), text.alias("_t")).join(ids, "id", "left_semi").select(
        "id", shingles(F.col("_t"), ngram).alias("grams")
    ))
    star = crowded.filter("id > low.id").select("id", "n", F.col("low.id").alias("target"), F.col("low.n").alias("target_n"))
    found = durable(_matching(star, sets, threshold))
    waiting = durable(crowded.filter("id > low.id").select("id", "band", "key").join(found, "id", "left_anti"))
    # Rows of bands that hold a waiting row, with their rarest shingles among these rows.
    near = crowded.join(waiting.select("band", "key").distinct(), ["band", "key"], "left_semi").select("id", "n").distinct()
    each = durable(near.join(sets, "id").select("id", "n", F.explode("grams").alias("gram")))
    times = each.groupBy("gram").agg(F.count(F.lit(1)).alias("times"))
    rare = each.join(times.filter("times > 1"), "gram", "left").groupBy("id", "n").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("times", F.lit(1)).alias("times"), "gram"))).alias("sorted")
    )
    length = F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int") + 1
    # A shingle of one row only meets nobody.
    rare = durable(rare.select("id", "n", F.explode(F.slice("sorted", F.lit(1), length)).alias("g")).filter("g.times > 1").select("id", "n", "g.gram"))
    left = rare.join(waiting.select("id").distinct(), "id", "left_semi")
    right = rare.select(F.col("id").alias("target"), F.col("n").alias("target_n"), "gram")
    pairs = left.join(right, "gram").filter("id > target").select("id", "n", "target", "target_n")
    late = _matching(pairs, sets, threshold)
    return copies.unionByName(found).unionByName(late).withColumnRenamed("id", order)


def _matching(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Ids with at least one listed target whose exact Jaccard score is enough."""
    fit = F.least("n", "target_n") >= threshold * F.greatest("n", "target_n")
    pairs = pairs.filter(fit).select("id", "target").distinct()
    theirs = sets.select(F.col("id").alias("target"), F.col("grams").alias("theirs"))
    both = pairs.join(theirs, "target").join(sets, "id")
    common = F.size(F.array_intersect("grams", "theirs"))
    score = common / (F.size("grams") + F.size("theirs") - common)
    return both.filter(score >= threshold).select("id").distinct()


def minhash_dedup(df: DataFrame, text_col: str, order: str, **options) -> DataFrame:
    """Rows that stay after MinHash near-duplicate removal."""
    return df.join(minhash_duplicates(df, text_col, order, **options), order, "left_anti")


def minhash_label(df: DataFrame, text_col: str, order: str, label: str = "minhash_label", **options) -> DataFrame:
    """All rows, with 1 for those that stay and 0 for near duplicates."""
    drops = minhash_duplicates(df, text_col, order, **options).withColumn(label, F.lit(0))
    return df.join(drops, order, "left").withColumn(label, F.coalesce(F.col(label), F.lit(1)))
