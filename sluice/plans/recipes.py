"""Ready-made step orders: text, code, reasoning and instruction recipes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import barrier
from sluice.operators import filters_text as T
from sluice.operators import modelstage as M
from sluice.operators import reasoning, relational
from sluice.operators.chunking import chunk_tokens
from sluice.operators.dedup import minhash_dedup
from sluice.operators.similarity import hashed_embedding, with_most_similar_text
from sluice.session import durable

PRETRAIN_FILTERS: dict[str, T.Predicate] = {
    "word_number": T.word_number(20, 100_000),
    "colon_end": T.colon_end(),
    "sentence_number": T.sentence_number(3, 7500),
    "line_end_with_ellipsis": T.line_end_with_ellipsis(0.3),
    "content_null": T.content_null(),
    "mean_word_length": T.mean_word_length(3, 10),
    "symbol_word_ratio": T.symbol_word_ratio(0.4),
    "html_entity": T.html_entity(),
    "no_punc": T.no_punc(112),
    "special_character": T.special_character(),
    "watermark": T.watermark(),
    "curly_bracket": T.curly_bracket(0.025),
    "capital_words": T.capital_words(0.2),
    "lorem_ipsum": T.lorem_ipsum(3e-8),
    "unique_words": T.unique_words(0.1),
    "char_number": T.char_number(100),
    "line_start_with_bullet": T.line_start_with_bullet(0.9),
    "line_with_javascript": T.line_with_javascript(3),
}


def refine_text(df: DataFrame, text_col: str) -> DataFrame:
    """Emoji, links and tags, then blanks; evaluated once per row."""
    text = T.remove_extra_spaces(T.remove_html_url(T.remove_emoji(F.col(text_col))))
    order = df.columns
    return barrier(df, **{text_col: text}).select(*order)


def pretrain_text(df: DataFrame, text_col: str, id_col: str, blocked: list[str] | None = None,
                  extra: dict[str, T.Predicate] | None = None, near_dup: bool = True, dedup_first: bool = False,
                  **minhash) -> DataFrame:
    """Refiners, all heuristic filters in one scan, then near-duplicate removal.

    Both orders are in use. With duplicates last, as by default, only rows
    worth keeping are compared. With ``dedup_first`` a row also goes if its
    earlier near copy fails a filter afterwards.
    """
    tests = dict(PRETRAIN_FILTERS, **(extra or {}))
    if blocked:
        tests["blocklist"] = T.blocklist(blocked)
    out = refine_text(df, text_col)
    if near_dup and dedup_first:
        out = minhash_dedup(durable(out), text_col, id_col, **minhash)
    out = T.keep(out, text_col, *tests.values())
    return out if not near_dup or dedup_first else minhash_dedup(durable(out), text_col, id_col, **minhash)


def pretrain_stage_counts(df: DataFrame, text_col: str) -> DataFrame:
    """Rows left after each filter of the recipe, in its order, in one scan."""
    flags = T.label(refine_text(df, text_col), text_col, **PRETRAIN_FILTERS)
    counts, passed = [F.count(F.lit(1)).alias("start")], F.lit(True)
    for name in PRETRAIN_FILTERS:
        passed = passed & F.col(name)
        counts.append(F.count_if(passed).alias(name))
    wide = flags.agg(*counts)
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(n).alias("rows"))
                     for i, n in enumerate(["start", *PRETRAIN_FILTERS])])
    return wide.select(F.inline(rows))


def sft_text(df: DataFrame, output_col: str = "output", low: int = 20, high: int = 1000) -> DataFrame:
    """Instruction rows with an answer of usable length."""
    return T.keep(df, output_col, T.word_number(low, high))


def reasoning_answers(df: DataFrame, question: str, answer: str, gold: str, max_tokens: int = 8192) -> DataFrame:
    """Format, gold comparison, repetition and length of answers."""
    a, g = F.col(answer), F.col(gold)
    out = df.filter(reasoning.answer_format(a)).filter(reasoning.ground_truth(a, g))
    out = reasoning.ngram_filter(out, question, answer)
    return reasoning.token_length_filter(out, answer, max_tokens)


def score_and_rework(df: DataFrame, keys: list[str], scorer: Callable, refiner: Callable, rewriter: Callable,
                     target: int | None = None) -> DataFrame:
    """Score, route to refine or rewrite, score again, collect valid samples.

    With a ``target`` rows are rewritten only while fewer rows are scored; by
    default they always are.
    """
    packed = relational.pack_row(df.select(*keys), "sample")
    packed = packed.withColumn("sample_json", F.to_json("sample"))
    scored = M.model_step(packed, "{sample_json}", ["sample_json"], scorer, "init_response")
    scored = scored.withColumn("init_score", M.parse_int_score(F.col("init_response")))
    scored = durable(relational.general_filter(scored, F.col("init_score") > 1))
    refine, rewrite = relational.route_bands(scored, "init_score")

    def rework(part: DataFrame, fn: Callable, name: str) -> DataFrame:
        out = M.model_step(part, "{sample_json}", ["sample_json"], fn, name)
        out = M.model_step(out, "{" + name + "}", [name], scorer, "final_response")
        out = out.withColumn("final_score", M.parse_int_score(F.col("final_response")))
        return relational.general_filter(out, F.col("final_score") >= 4)

    refined = rework(refine, refiner, "refine")
    if target is None or relational.below_target(scored, target):
        done = relational.concat_tables(refined, rework(rewrite, rewriter, "rewrite"))
    else:
        done = refined.withColumn("rewrite", F.lit(None).cast("string"))
    return M.collect_samples(done, "sample", keys)


def fuse_questions(df: DataFrame, id_col: str, question: str, fuse: dict[str, Callable], judge: Callable) -> DataFrame:
    """Pair each question with its most similar one, fuse, melt, judge, extract."""
    embedded = durable(hashed_embedding(df, question, "embeddings"))
    paired = with_most_similar_text(embedded, id_col, "embeddings", question)
    paired = relational.drop_matching(paired, "embeddings").withColumnRenamed(question, "question")
    for name, fn in fuse.items():
        paired = M.model_step(paired, "{question}\n{most_similar_problem}", ["question", "most_similar_problem"],
                              fn, f"{name}_question_0")
    melted = relational.melt_questions(paired)
    judged = M.model_step(melted, "{questions}", ["questions"], judge, "question_solvability")
    return relational.extract_after(judged)


def knowledge_questions(df: DataFrame, text_col: str, id_col: str, cleaner: Callable, asker: Callable,
                        tokens: int = 512, schema: str = "array<struct<question:string,answer:string>>") -> DataFrame:
    """Token chunks, cleaned by a model, turned into several questions each."""
    chunks = chunk_tokens(df.select(id_col, text_col), text_col, tokens)
    cleaned = M.model_step(chunks, "{" + text_col + "}", [text_col], cleaner, "cleaned")
    asked = M.model_step(cleaned, "{cleaned}", ["cleaned"], asker, "response")
    return asked.select(id_col, "chunk_number", F.inline(M.parse_json(F.col("response"), schema)))
