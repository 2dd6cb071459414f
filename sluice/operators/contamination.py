"""Which benchmark items stand in which documents, by shared word n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import WORD, let
from sluice.operators.skew import hot_keys, skew_join
from sluice.session import durable

# An item table up to this many grams is sent to every task; a larger one is joined by a shuffle.
BROADCAST_GRAMS = 200_000


def word_grams(text: Column, n: int) -> Column:
    """Runs of ``n`` lower-case words, as pairs of hashes; the whole text if it has fewer words."""

    def of(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        # Two hashes of the words as a list: 96 bits tell grams apart without moving their text.
        gram = F.transform(starts, lambda i: let(F.slice(words, i, n), lambda g: F.struct(F.xxhash64(g).alias("h"), F.hash(g).alias("g"))))
        return F.when(F.size(words) > 0, gram)

    return let(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), of)


def _grams(df: DataFrame, id_col: str, text_col: str, n: int, name: str) -> DataFrame:
    rows = df.select(F.col(id_col).alias(name), F.explode(word_grams(F.col(text_col), n)).alias("gram"))
    return rows.select(name, "gram.h", "gram.g")


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text_col: str = "text", n: int = 8,
    item_text: str | None = None, broadcast_grams: int = BROADCAST_GRAMS,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``shared`` and ``share`` for every pair with a common gram.

    ``share`` is the part of the item's different grams that the document has.
    Nothing is dropped, however many documents hold a gram. A small item table
    is broadcast after its size has been counted, so documents are not moved
    at all; a larger one is joined by gram, and grams that very many documents
    hold are spread over tasks. Texts without a word have no grams.
    """
    wanted = durable(_grams(items, item_id, item_text or text_col, n, "_item").distinct())
    sizes = wanted.groupBy("_item").agg(F.count(F.lit(1)).alias("_grams"))
    have = _grams(docs, doc_id, text_col, n, "_doc")
    if wanted.limit(broadcast_grams + 1).count() <= broadcast_grams:
        met = have.join(F.broadcast(wanted), ["h", "g"])
        sizes = F.broadcast(sizes)
    else:
        # Grams are worked out and dealt once; few are left after this.
        have = durable(have.join(wanted.select("h", "g").distinct(), ["h", "g"], "left_semi"))
        met = skew_join(have, wanted, ["h", "g"], hot=hot_keys(have, ["h", "g"]))
    # What a document says twice counts once; few of its grams are left here.
    shared = met.distinct().groupBy("_doc", "_item").agg(F.count(F.lit(1)).alias("shared"))
    return shared.join(sizes, "_item").select(
        F.col("_doc").alias(doc_id), F.col("_item").alias(item_id), "shared", (F.col("shared") / F.col("_grams")).alias("share")
    )


def clean_documents(docs: DataFrame, found: DataFrame, doc_id: str, most: float = 0.5) -> DataFrame:
    """Documents that hold no item by more than ``most`` of its grams; documents without id stay."""
    return docs.join(found.filter(F.col("share") > most).select(doc_id).distinct(), doc_id, "left_anti").select(*docs.columns)
