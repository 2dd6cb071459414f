"""Answer checks for reasoning data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import BLANK, WORD_CHARS, barrier, find_all, hashed_ngrams, let, numbered, ratio, strip
from sluice.operators.chunking import token_count
from sluice.operators.skew import hot_keys, skew_join

FINAL_PHRASE = r"(?i)final answer|the answer is|答案"
BOX = r"\\boxed\{([^{}]*)\}"


def boxed(text: Column) -> Column:
    """Content of the last box, or the whole text."""
    # All boxes in one pass: a greedy prefix up to the last one would rescan
    # texts without a box from every position.
    boxes = F.regexp_extract_all(text, F.lit(BOX), F.lit(1))
    return let(boxes, lambda b: F.when(F.size(b) > 0, F.element_at(b, -1)).otherwise(text))


def normalize_answer(text: Column) -> Column:
    """Lower case, no blanks, no dollar signs, no closing full stop."""
    bare = F.regexp_replace(F.lower(boxed(text)), rf"[{BLANK}$]+", "")
    return F.regexp_replace(bare, r"\.+\z", "")


def match_answer(prediction: Column, gold: Column) -> Column:
    """Does the normalised answer contain the normalised gold?"""
    found = let(normalize_answer(gold), lambda g: (g != "") & F.contains(normalize_answer(prediction), g))
    return F.coalesce(found, F.lit(False))


def accuracy(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(flag)).alias("matched"),
        F.coalesce(F.avg(F.col(flag).cast("double")), F.lit(0.0)).alias("accuracy"),
    )


def semantic_match(df: DataFrame, verdicts: DataFrame, question: str, answer: str, output: str = "matched") -> DataFrame:
    """``df`` with a judge's verdict on each pair of question and answer, and whether there is one (``judged``).

    ``verdicts`` has the same two columns and a boolean ``verdict``, one row per
    pair. Pairs meet by a hash, so long texts are not sorted; a pair without a
    verdict does not match.
    """
    def pair(frame: DataFrame) -> Column:
        blank = F.lit("")
        return F.sha2(F.concat_ws("\u0001", F.coalesce(frame[question], blank), F.coalesce(frame[answer], blank)), 256)

    said = verdicts.select(pair(verdicts).alias("_pair"), F.col("verdict").alias("_said"))
    marked = df.withColumn("_pair", pair(df))
    out = skew_join(marked, said, ["_pair"], "left", hot=hot_keys(marked, ["_pair"]))
    return out.withColumn(output, F.coalesce("_said", F.lit(False))).withColumn("judged", F.col("_said").isNotNull()).drop("_pair", "_said")


def ground_truth(prediction: Column, gold: Column, tolerance: float = 1e-6) -> Column:
    """Equal after normalising, as text or as numbers."""

    def same(pair: Column) -> Column:
        a, b = pair["a"], pair["b"]
        close = F.abs(a.try_cast("double") - b.try_cast("double")) <= tolerance
        return (a == b) | F.coalesce(close, F.lit(False))

    pair = F.struct(normalize_answer(prediction).alias("a"), normalize_answer(gold).alias("b"))
    return F.coalesce(let(pair, same), F.lit(False))


def answer_format(answer: Column) -> Column:
    usable = answer.isNotNull() & (strip(answer) != "")
    return usable & (F.contains(answer, F.lit("\\boxed{")) | answer.rlike(FINAL_PHRASE))


def ngram_score(question: Column, answer: Column, n: int = 5) -> Column:
    """Distinct share of the word n-grams of question and answer; 1 if there are none."""
    words = find_all(F.lower(F.concat_ws(" ", question, answer)), WORD_CHARS)
    return let(
        hashed_ngrams(words, n),
        lambda g: F.when(F.size(g) == 0, F.lit(1.0)).otherwise(ratio(F.size(F.array_distinct(g)), F.size(g))),
    )


def ngram_filter(df: DataFrame, question: str, answer: str, low: float = 0.1, high: float = 1.0, n: int = 5) -> DataFrame:
    scored = barrier(df, _score=ngram_score(F.col(question), F.col(answer), n))
    return scored.filter(F.col("_score").between(low, high)).drop("_score")


def token_length_filter(df: DataFrame, text_col: str, limit: int = 8192) -> DataFrame:
    return df.filter(token_count(F.col(text_col)) <= limit)


def split_roots(df: DataFrame, answer: str, gold: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable answer or gold, and rows with neither."""
    usable = F.coalesce(strip(F.col(answer)) != "", F.lit(False)) | F.coalesce(strip(F.col(gold)) != "", F.lit(False))
    return df.filter(usable), df.filter(~usable)


def to_pretrain_text(question: Column, answer: Column) -> Column:
    return F.concat_ws("\n", question, answer)


def answer_tokens(text: Column) -> Column:
    """Lower-cased words without punctuation and articles."""
    return F.filter(find_all(F.lower(text), WORD_CHARS), lambda w: ~w.isin("a", "an", "the"))


def token_f1(prediction: Column, gold: Column) -> Column:
    """Multiset token F1; copies are numbered so that a set intersection counts them."""
    p, g = answer_tokens(prediction), answer_tokens(gold)

    def score(both: Column) -> Column:
        common = F.size(F.array_intersect(both["p"], both["g"]))
        total = F.size(both["p"]) + F.size(both["g"])
        return ratio(common * 2, total)

    pair = F.struct(numbered(p).alias("p"), numbered(g).alias("g"))
    return F.coalesce(let(pair, score), F.lit(0.0))
