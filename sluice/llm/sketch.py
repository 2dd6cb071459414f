"""Document fingerprints: every shingle hash below a fixed fraction of the hash range.

Whether a hash is kept depends on the hash alone, so the fingerprint of a
union is the union of fingerprints and the kept hashes of a short text are
among those of any text that holds it, however long. Only DataFrame functions
are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.text import barrier, let
from sluice.session import durable

WORDS = 5
# Share of shingle hashes that stay.
FRACTION = 0.125
SPACE = r"[\x20\x09-\x0D]+"


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """MD5 of every run of ``words`` words; of the whole sequence if there are fewer, none without a word."""

    def of(found: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(found) - (words - 1), F.lit(1)))
        return F.when(
            F.size(found) > 0, F.transform(starts, lambda i: F.md5(F.array_join(F.slice(found, i, words), " ")))
        ).otherwise(F.array().cast("array<string>"))

    return let(F.array_remove(F.split(text, SPACE), ""), of)


def sketch(text: Column, words: int = WORDS, fraction: float = FRACTION) -> Column:
    """The kept hashes of a text, sorted, as the first 16 hex digits of each.

    A text whose hashes all lie above the fraction keeps its smallest one, so
    that only texts without a word have an empty sketch.
    """
    below = format(min(round(fraction * 16**8), 16**8 - 1), "08x")

    def of(found: Column) -> Column:
        kept = F.filter(found, lambda h: h < below)
        least = F.filter(F.array(F.array_min(found)), lambda h: h.isNotNull())
        return F.array_sort(F.array_distinct(F.transform(F.when(F.size(kept) > 0, kept).otherwise(least), lambda h: h.substr(1, 16))))

    return let(shingle_hashes(text, words), of)


def packed(hashes: Column) -> Column:
    """A sketch as 8 bytes a hash, for the way through an exchange."""
    return F.unhex(F.array_join(hashes, ""))


def unpacked(data: Column) -> Column:
    digits = F.lower(F.hex(data))
    places = F.sequence(F.lit(0), F.length(data) - 8, F.lit(8))
    return let(digits, lambda d: F.when(F.length(data) > 0, F.transform(places, lambda i: F.substring(d, 2 * i + 1, F.lit(16)))).otherwise(
        F.array().cast("array<string>")))


def merged(one: Column, other: Column) -> Column:
    """Sketch of two texts taken together, but for shingles across their seam."""
    return F.array_sort(F.array_union(one, other))


def contained(part: Column, whole: Column) -> Column:
    """Estimated share of the shingles of ``part`` that ``whole`` has; null for a text without a word."""
    return F.try_divide(F.size(F.array_intersect(part, whole)), F.size(part))


def likeness(one: Column, other: Column) -> Column:
    """Containment of the smaller of two sketches, 0 to 1; two empty ones are alike, an empty and another are not."""
    least = F.least(F.size(one), F.size(other))
    both_empty = (F.size(one) == F.size(other)).cast("double")
    return F.when(least == 0, both_empty).otherwise(F.size(F.array_intersect(one, other)) / least)


def fingerprints(df: DataFrame, text_col: str, id_col: str, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """``id_col``, ``n_chars`` and ``hashes`` of every row, in one pass without an exchange.

    Null texts are empty; texts without a word have no hashes, equal texts equal
    ones. Rows are independent: ties, repeated rows and null ids come back as
    they are. An empty table gives no rows, and further columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(
        F.col(id_col), F.length(text).cast("long").alias("n_chars"), sketch(text, words, fraction).alias("hashes")
    )


def successors(keys: DataFrame, order: list[str]) -> DataFrame:
    """``keys`` (rows differ in ``order``) with ``next``, a struct of the following row; after the last comes the first.

    Rows are dealt by ranges; the last of each range sees the first of the next
    through a table of one row per range.
    """
    dealt = durable(keys.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    row, rank = F.struct(*keys.columns), F.struct(*order)
    low = dealt.groupBy("_part").agg(F.min_by(row, rank).alias("_low"))
    parts = Window.orderBy("_part")
    low = low.select("_part", F.coalesce(F.lead("_low").over(parts), F.first("_low").over(parts)).alias("_low"))
    inside = Window.partitionBy("_part").orderBy(*order)
    seen = dealt.withColumn("next", F.lead(row).over(inside)).join(low, "_part")
    return seen.select(*keys.columns, F.coalesce("next", "_low").alias("next"))


def edited_pairs(df: DataFrame, text_col: str, id_col: str, words: int = WORDS, fraction: float = FRACTION) -> DataFrame:
    """Each document beside an edited form of itself and beside the document after it.

    Documents follow each other by ascending id (null ids first), those of one
    id by a digest that includes their text; after the last comes the first. The edited
    text is the document with the last half of its characters, rounded down,
    replaced by as many first characters of the next document, or by all it
    has. Columns: ``id_col``, ``n_chars``, ``edited`` (text), ``hashes``,
    ``edited_hashes``, ``next_hashes``. Null texts are empty. Rows repeated with
    one id and text are one document, returned once; a document that is alone is
    its own next. An empty table gives no rows; further columns are not read.

    Ids and digests alone settle the order. Each text crosses the network once
    under its own key, and the head that its predecessor takes once more, so a
    hot id spreads by its texts and no window holds a text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    # One column that is never null is the key of a document, so that both joins take the texts from one exchange.
    mark = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"), text)
    rows = df.select(F.col(id_col).alias("_id"), F.md5(mark).alias("_key"), text.alias("_text"))
    keys = durable(rows.select("_id", "_key", F.length("_text").alias("_n")).distinct())
    wants = successors(keys, ["_id", "_key"]).select(
        F.col("next._key").alias("_key"), F.col("_id").alias("_before_id"), F.col("_key").alias("_before"), F.floor(F.col("_n") / 2).cast("int").alias("_half")
    )
    texts = rows.select("_key", "_text").dropDuplicates(["_key"])
    own = sketch(F.col("_text"), words, fraction)
    heads = texts.join(wants, "_key").select(
        F.col("_before").alias("_key"), F.col("_before_id").alias("_id"), "_half", F.expr("substring(_text, 1, _half)").alias("_head"), packed(own).alias("_next")
    )
    n = F.length("_text")
    met = texts.join(heads, "_key")
    met = met.select(
        F.col("_id").alias(id_col), n.cast("long").alias("n_chars"), "_text", "_next",
        F.concat(F.substring("_text", F.lit(1), n - F.col("_half")), F.col("_head")).alias("edited"),
    )
    # Bound, so that no reader of a column has it worked out again.
    met = barrier(
        met, hashes=own, edited_hashes=sketch(F.col("edited"), words, fraction), next_hashes=unpacked(F.col("_next"))
    )
    return met.select(id_col, "n_chars", "edited", "hashes", "edited_hashes", "next_hashes")
