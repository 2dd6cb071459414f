"""Batch pattern around a model call: render, dedupe, apply, attach, parse, filter.

The call itself belongs to the caller. Requests are keyed by the hash of their
prompt, so equal prompts are sent once and answers survive a rerun.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import let, strip
from sluice.operators.skew import hot_keys, skew_join
from sluice.session import durable


def render(df: DataFrame, template: str, columns: list[str], system: str = "", output: str = "prompt") -> DataFrame:
    """``prompt`` with ``{column}`` places filled, and its ``request_id``."""
    prompt = F.lit(template)
    for name in columns:
        prompt = F.replace(prompt, F.lit("{" + name + "}"), F.coalesce(F.col(name).cast("string"), F.lit("")))
    if system:
        prompt = F.concat(F.lit(system + "\n\n"), prompt)
    return df.withColumn(output, prompt).withColumn("request_id", F.sha2(F.col(output), 256))


def fan_out(df: DataFrame, n: int, name: str = "candidate") -> DataFrame:
    """``n`` numbered copies of every row."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def pending(requests: DataFrame, responses: DataFrame | None = None) -> DataFrame:
    """Distinct requests without a stored response.

    Grouping combines before the shuffle, so one prompt shared by a third of
    the rows costs one row per input partition.
    """
    unique = requests.groupBy("request_id").agg(F.any_value("prompt").alias("prompt"))
    return unique if responses is None else unique.join(responses, "request_id", "left_anti")


def apply_model(requests: DataFrame, fn: Callable[[list[str]], list[str]], batch: int = 100,
                concurrency: int | None = None) -> DataFrame:
    """Responses of the caller's batch function; a failing batch marks its rows.

    Partitions are the unit of concurrency: ``concurrency`` deals the requests
    to so many. Without it they stay as they come, which may be few.
    """
    if concurrency:
        requests = requests.repartition(concurrency, "request_id")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answered: list[str | None] = []
            failed: list[str | None] = []
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                try:
                    answers, errors = fn(part["prompt"].tolist()), None
                    if len(answers) != len(part):
                        raise ValueError("the function must return one response per prompt")
                except Exception as error:
                    answers, errors = [None] * len(part), str(error)
                answered += answers
                failed += [errors] * len(part)
            yield pd.DataFrame(
                {"request_id": frame["request_id"], "response": pd.Series(answered, frame.index, object),
                 "ok": [e is None for e in failed], "error": pd.Series(failed, frame.index, object)}
            )

    schema = "request_id string, response string, ok boolean, error string"
    return requests.select("request_id", "prompt").mapInPandas(run, schema)


def attach(df: DataFrame, responses: DataFrame, output: str = "response", hot: DataFrame | None = None) -> DataFrame:
    """Put each row's response next to it; rows without one keep null."""
    answers = responses.select("request_id", F.col("response").alias(output))
    return skew_join(df, answers, ["request_id"], "left", hot=hot)


def attach_balanced(df: DataFrame, responses: DataFrame, output: str = "response") -> DataFrame:
    """``attach`` with prompts shared by very many rows found first and salted."""
    return attach(df, responses, output, hot=hot_keys(df, ["request_id"]))


def unfence(text: Column) -> Column:
    """Response without a code fence around it."""
    return strip(F.regexp_replace(text, r"```(?:json)?", ""))


def parse_json(text: Column, schema: str) -> Column:
    """Struct parsed from a response; null if it is not such an object."""
    return F.from_json(unfence(text), schema, {"mode": "PERMISSIVE"})


def parse_int_score(text: Column, low: int = 1, high: int = 5) -> Column:
    """The response as one integer of the scale, else null."""
    number = strip(text).try_cast("int")
    return F.when(number.between(low, high), number)


def dimension_scores(text: Column, names: list[str], low: float = 1, high: float = 5) -> Column:
    """A struct with the response's score for each named dimension and ``overall``, the mean of those given.

    The response is a JSON object of numbers. A score that is missing or out of
    scale is null; without any score ``overall`` is null.
    """
    given = F.from_json(unfence(text), "map<string,string>", {"mode": "PERMISSIVE"})

    def scores(found: Column) -> Column:
        each = [F.try_element_at(found, F.lit(n)).try_cast("double") for n in names]
        each = [F.when(x.between(low, high), x) for x in each]
        known = F.array_compact(F.array(*each))
        mean = F.aggregate(known, F.lit(0.0), lambda a, b: a + b) / F.nullif(F.size(known), F.lit(0))
        return F.struct(*[x.alias(n) for x, n in zip(each, names)], mean.alias("overall"))

    return let(given, scores)


def has_keys(text: Column, keys: list[str]) -> Column:
    """Is the response a JSON object with all the keys?"""
    found = F.json_object_keys(unfence(text))
    plain = F.coalesce(found, F.array().cast("array<string>"))
    return F.forall(F.array(*[F.lit(k) for k in keys]), lambda k: F.array_contains(plain, k))


def count_invalid(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """How many non-blank responses lack the required keys, per response column."""
    tests = []
    for name in columns:
        present = F.col(name).isNotNull() & (strip(F.col(name)) != "")
        tests.append(F.count_if(present & ~has_keys(F.col(name), keys)).alias(f"invalid_{name}"))
    return df.agg(*tests)


def collect_samples(df: DataFrame, original: str, keys: list[str],
                    rewrite: str = "rewrite", refine: str = "refine") -> DataFrame:
    """Final rows: valid rewrites and refinements, and the original of each rewrite."""
    schema = ", ".join(f"`{k}` string" for k in keys)
    packed = F.struct(*[F.col(f"{original}.{k}").cast("string").alias(k) for k in keys])

    def sample(name: str) -> Column:
        return F.when(has_keys(F.col(name), keys), parse_json(F.col(name), schema))

    def present(name: str) -> Column:
        return F.coalesce(strip(F.col(name)) != "", F.lit(False))

    rows = F.array(
        F.when(present(rewrite), sample(rewrite)),
        F.when(present(rewrite), packed),
        F.when(present(refine), sample(refine)),
    )
    return df.select(F.explode(F.array_compact(rows)).alias("s")).select("s.*")


def verdict_filter(df: DataFrame, score: Column, low: float, high: float, keep_all: bool = False,
                   label: str = "verdict") -> DataFrame:
    """Keep rows whose parsed value lies in the band, or only label them."""
    good = F.coalesce(score.between(low, high), F.lit(False))
    return df.withColumn(label, good.cast("int")) if keep_all else df.filter(good)


def turns_of(df: DataFrame, conversation: str = "conversations", id_col: str = "id") -> DataFrame:
    """One row per turn of an array of turns."""
    rows = df.select(id_col, F.posexplode(conversation).alias("turn", "t"))
    return rows.select(id_col, "turn", "t.*")


def conversation_of(turns: DataFrame, id_col: str, turn_col: str = "turn",
                    fields: tuple[str, ...] = ("role", "text")) -> DataFrame:
    """Turns back to one ordered array per conversation.

    A conversation becomes one cell, so its size is bounded by what a cell may
    hold; that is the shape the caller asks for.
    """
    item = F.struct(turn_col, *fields)
    packed = turns.groupBy(id_col).agg(F.array_sort(F.collect_list(item)).alias("_turns"))
    body = F.transform("_turns", lambda t: F.struct(*[t[f].alias(f) for f in fields]))
    return packed.select(id_col, body.alias("conversations"))


def model_step(df: DataFrame, template: str, columns: list[str], fn: Callable[[list[str]], list[str]],
               output: str, system: str = "", responses: DataFrame | None = None, *, concurrency: int | None = None,
               errors: str | None = None) -> DataFrame:
    """Render, send what is new, attach: the whole generator step.

    Responses are written before they are used, so no later step, retry or
    lost executor sends a request again; the joined table is written too, so a
    chain of steps does not repeat its joins. ``concurrency`` batches run at a
    time. Failed requests leave a null; with ``errors`` that column says why.
    """
    asked = durable(render(df, template, columns, system))
    fresh = durable(apply_model(pending(asked, responses), fn, concurrency=concurrency))
    known = fresh.filter("ok").select("request_id", "response")
    known = known if responses is None else known.unionByName(responses.select("request_id", "response"))
    out = attach_balanced(asked, known, output)
    if errors:
        failed = fresh.filter("not ok").select("request_id", F.col("error").alias(errors))
        out = skew_join(out, failed, ["request_id"], "left", hot=hot_keys(asked, ["request_id"]))
    return durable(out.drop("prompt", "request_id"))
