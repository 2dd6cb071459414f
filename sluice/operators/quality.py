"""Quality scores of chunks and of question-answer pairs, and their reports."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import (
    CJK,
    CJK_OR_LATIN,
    DIGIT,
    WORD_CHARS,
    barrier,
    contains_any,
    count_of,
    find_all,
    let,
    quote,
    ratio,
    size_where,
    strip,
)
from sluice.operators.chunking import is_valid
from sluice.session import durable

METRICS = list(V.METRIC_WEIGHTS)
# Words of at most so many characters whose test a Python worker remembers, and how many of them.
SEEN_LENGTH, SEEN_WORDS = 64, 200_000
GRADES = {"excellent": (0.8, None), "good": (0.6, 0.8), "fair": (0.4, 0.6), "poor": (None, 0.4)}


def _points(test: Column, points: float) -> Column:
    return F.when(test, F.lit(points)).otherwise(F.lit(0.0))


def _add(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def completeness(text: Column, n_terms: Column) -> Column:
    length = F.least(F.lit(1.0), F.length(text) / F.lit(200.0))
    structure = _add([
        _points(text.rlike(DIGIT), 0.2),
        _points(n_terms >= 2, 0.3),
        _points(contains_any(text, V.CAUSE_WORDS), 0.2),
        _points(contains_any(text, V.APPLICATION_WORDS), 0.3),
    ])
    density = F.least(F.lit(1.0), count_of(text, WORD_CHARS) / F.lit(50.0))
    return F.least(F.lit(1.0), length * 0.3 + structure * 0.4 + density * 0.3)


def is_domain_word(word: Column, vocabulary: list[str] = V.DOMAIN_VOCABULARY) -> Column:
    """Some vocabulary word lies in ``word``, or ``word`` lies in one of them.

    One alternation and one substring test stand for the loop over the list:
    the joined list holds a word exactly if some entry does, as ``|`` cannot
    occur inside a word.
    """
    lowered = [v.lower() for v in vocabulary]
    inside = F.lower(word).rlike("|".join(map(quote, lowered)))
    return F.contains(F.lit("|".join(lowered)), F.lower(word)) | inside


def domain_counts(text: Column, vocabulary: list[str]) -> Column:
    """``held`` (vocabulary words in the text), ``words`` and ``domain`` (words, and domain words among them).

    The same tests as ``contains`` and ``is_domain_word``. An alternation of so
    many words costs the JVM's patterns all of them at each character, so they
    are made on Arrow batches, a word that came before is not tested again.
    """
    lowered = [v.lower() for v in vocabulary]
    cased = any(v != v.upper() for v in lowered)

    @F.arrow_udf("struct<held:int,words:int,domain:int>")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        word_of, inside = re.compile("[\u4e00-\u9fff]+|[a-zA-Z]+").findall, re.compile("|".join(map(re.escape, lowered))).search
        parts = {v[i:j] for v in lowered for i in range(len(v)) for j in range(i + 1, len(v) + 1)}
        seen: dict[str, bool] = {}

        def test(word: str) -> bool:
            low = word.lower()
            found = low in parts or inside(low) is not None
            if len(seen) < SEEN_WORDS and len(word) <= SEEN_LENGTH:
                seen[word] = found
            return found

        def of(text: str | None) -> dict[str, int] | None:
            if text is None:
                return None
            words, low = word_of(text), text.lower() if cased else text
            good = sum(test(w) if (known := seen.get(w)) is None else known for w in words)
            return {"held": sum(v in low for v in lowered), "words": len(words), "domain": good}

        kind = pa.struct([("held", pa.int32()), ("words", pa.int32()), ("domain", pa.int32())])
        for texts in batches:
            yield pa.array([of(t) for at in range(0, len(texts), 64) for t in texts.slice(at, 64).to_pylist()], kind)

    return count(text)


def relevance(text: Column, vocabulary: list[str] = V.DOMAIN_VOCABULARY) -> Column:
    areas = _add([_points(contains_any(text, words), 0.25) for words in V.RELEVANCE_AREAS.values()])

    def score(n: Column) -> Column:
        term_score = F.least(F.lit(1.0), ratio(n["domain"], n["words"]) * 5)
        return F.least(F.lit(1.0), n["held"] / F.lit(float(len(vocabulary))) * 0.4 + term_score * 0.3 + areas * 0.3)

    return let(domain_counts(text, vocabulary), score)


def has_variation(term: Column, text: Column) -> Column:
    """Does the text hold another form of ``term``?

    A short form (first and last character) has to occur; a listed synonym of
    a main term has to occur; a term that is itself a synonym always counts.
    """
    short = F.concat(F.left(term, F.lit(1)), F.right(term, F.lit(1)))
    found = (F.length(term) > 2) & F.contains(text, short) & (short != term)
    for main, synonyms in V.SYNONYMS.items():
        found = found | ((term == main) & contains_any(text, synonyms)) | term.isin(synonyms)
    return found


def consistency(text: Column) -> Column:
    chinese, latin = count_of(text, f"[{CJK}]"), count_of(text, "[a-zA-Z]")

    def points(share: Column) -> Column:
        return (
            F.when((share > 0.2) & (share < 0.8), 0.1)
            .when((share > 0.9) | (share < 0.1), 0.05)
            .otherwise(0.0)
        )

    # Null share: no letters of either kind.
    bonus = let(let(F.struct(chinese.alias("zh"), latin.alias("en")), lambda n: F.try_divide(n["zh"], n["zh"] + n["en"])), points)

    def repeated(terms: Column) -> Column:
        # Neighbours in sorted order: linear, and no shuffle by (chunk, term).
        return F.array_distinct(
            F.filter(terms, lambda t, i: (i > 0) & (t == F.get(terms, F.greatest(i - 1, F.lit(0)))))
        )

    terms = F.array_sort(find_all(text, f"[{CJK}]{{2,}}|[a-zA-Z]{{2,}}"))
    odd = size_where(let(terms, repeated), lambda t: has_variation(t, text))
    penalty = F.least(F.lit(0.3), odd * 0.1)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.lit(0.8) + bonus - penalty))


def diversity(text: Column) -> Column:
    vocabulary = let(find_all(F.lower(text), CJK_OR_LATIN), lambda w: ratio(F.size(F.array_distinct(w)), F.size(w)))
    sentences = F.filter(F.transform(F.split(text, "[。！？.!?]+"), strip), lambda s: s != "")

    def variance(lengths: Column) -> Column:
        n = F.size(lengths).cast("double")
        total = F.aggregate(lengths, F.lit(0.0), lambda acc, x: acc + x)
        squares = F.aggregate(lengths, F.lit(0.0), lambda acc, x: acc + x * x)
        top = F.array_max(lengths)
        mean = total / F.nullif(n, F.lit(0.0))
        spread = (squares / F.nullif(n, F.lit(0.0)) - mean * mean) / (top * top)
        return F.when(F.size(lengths) > 1, F.least(F.lit(1.0), spread * 10)).otherwise(0.0)

    form = let(F.transform(sentences, lambda s: F.length(s).cast("double")), variance)
    topics = _add([_points(contains_any(text, words), 1.0) for words in V.TOPICS.values()]) / len(V.TOPICS)
    kinds = _add([
        _points(text.rlike(DIGIT), 0.25),
        _points(text.rlike("[" + "".join(map(quote, V.DESCRIPTION_MARKS)) + "]"), 0.25),
        _points(contains_any(text, V.CAUSAL_LINKS), 0.25),
        _points(contains_any(text, V.ORDER_LINKS), 0.25),
    ])
    return F.least(F.lit(1.0), vocabulary * 0.3 + form * 0.2 + topics * 0.3 + kinds * 0.2)


def overall(scores: dict[str, Column]) -> Column:
    """Weighted mean over the metrics that were computed."""
    weights = {m: V.METRIC_WEIGHTS.get(m, 0.25) for m in scores}
    total = sum(weights.values())
    if not total:
        return F.lit(0.0)
    return _add([scores[m] * w for m, w in weights.items()]) / total


def suggestions(text: Column, quality: Column, n_terms: Column) -> Column:
    low = quality["completeness"] < 0.7
    rules = [
        (low & (F.length(text) < 100), "short"),
        (low & ~text.rlike(DIGIT), "no_number"),
        (low & (n_terms == 0), "no_term"),
        (quality["relevance"] < 0.6, "weak_relevance"),
        (quality["relevance"] < 0.4, "no_relevance"),
        (quality["consistency"] < 0.7, "inconsistent"),
        (quality["diversity"] < 0.6, "plain"),
        (quality["diversity"] < 0.4, "flat"),
    ]
    return F.array_compact(F.array(*[F.when(test, F.lit(V.SUGGESTIONS[name])) for test, name in rules]))


def evaluate(
    df: DataFrame, text_col: str = "content", metrics: list[str] | None = None, min_score: float = 0.7
) -> DataFrame:
    """``quality`` struct, ``quality_warning`` and ``improvement_suggestions``.

    A metric that is switched off reads 0.0 and is left out of the mean. Blank
    texts get no score.
    """
    metrics = METRICS if metrics is None else metrics
    text = F.col(text_col)
    n_terms = F.coalesce(F.size("extracted_terms"), F.lit(0)) if "extracted_terms" in df.columns else F.lit(0)
    made = {
        "completeness": lambda: completeness(text, n_terms),
        "relevance": lambda: relevance(text),
        "consistency": lambda: consistency(text),
        "diversity": lambda: diversity(text),
    }
    parts = {f"_{m}": made[m]() for m in metrics}
    df = barrier(df, **parts) if parts else df
    scores = {m: F.col(f"_{m}") for m in metrics}
    quality = F.struct(
        overall(scores).alias("overall"),
        *[(scores[m] if m in scores else F.lit(0.0)).alias(m) for m in METRICS],
    )
    df = df.withColumn("quality", F.when(is_valid(text), quality)).drop(*parts)
    df = df.withColumn("quality_warning", F.col("quality.overall") < min_score)
    advice = F.when(F.col("quality").isNotNull(), suggestions(text, F.col("quality"), n_terms))
    return df.withColumn("improvement_suggestions", advice)


def filter_by_quality(df: DataFrame, min_score: float = 0.7) -> DataFrame:
    return df.filter(F.col("quality.overall") >= min_score)


def qa_score(df: DataFrame, name: str = "qa_quality") -> DataFrame:
    """Score of one pair from lengths, wording, facts, overlap and confidence."""
    question, answer = F.col("question"), F.col("answer")

    def length_points(text: Column, low: int, high: int) -> Column:
        n = F.length(text)
        return F.when(n.between(low, high), 0.2).when(n < low, 0.1).otherwise(0.15)

    def overlap(words: Column) -> Column:
        context = F.array_distinct(find_all(F.lower(F.col("context")), CJK_OR_LATIN))
        return ratio(F.size(F.array_intersect(words, context)), F.size(words))

    relevant = let(F.array_distinct(find_all(F.lower(question), CJK_OR_LATIN)), overlap)
    usable = (F.col("context") != "") & (question != "")
    score = _add([
        length_points(question, 10, 50),
        _points(contains_any(question, V.QUESTION_WORDS), 0.2),
        length_points(answer, 20, 200),
        _points(answer.rlike(DIGIT), 0.1),
        _points(is_domain_word(answer), 0.1),
        F.when(usable, F.least(F.lit(0.2), relevant)).otherwise(0.0),
    ])
    trust = F.when(F.col("confidence").isNull() | (F.col("confidence") == 0), 1.0).otherwise(F.col("confidence"))
    return df.withColumn(name, F.least(F.lit(1.0), score * trust))


def _grade_counts(score: Column) -> list[Column]:
    out = []
    for grade, (low, high) in GRADES.items():
        test = F.lit(True)
        test = test & (score >= low) if low is not None else test
        test = test & (score < high) if high is not None else test
        out.append(F.count_if(test).alias(grade))
    return out


def qa_report(df: DataFrame, score: str = "qa_quality") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_pairs"),
        F.coalesce(F.avg(score), F.lit(0.0)).alias("average_quality"),
        *_grade_counts(F.col(score)),
    )


def score_history(df: DataFrame, id_col: str) -> DataFrame:
    """One row per chunk and metric."""
    wide = df.select(id_col, *[F.col(f"quality.{m}").alias(m) for m in ["overall", *METRICS]])
    return wide.unpivot([id_col], ["overall", *METRICS], "metric", "score")


def metric_summary(df: DataFrame, id_col: str) -> DataFrame:
    """Mean, population deviation, range and exact median per metric.

    All but the median come from one aggregate over the scores side by side; no
    score is shuffled.
    """
    names = ["overall", *METRICS]
    wide = durable(df.select(*[F.col(f"quality.{m}").cast("double").alias(m) for m in names]))
    measures = {"mean": F.avg, "std": F.stddev_pop, "min": F.min, "max": F.max}
    one = wide.agg(*[fn(m).alias(f"{m}_{n}") for m in names for n, fn in measures.items()])
    rows = F.array(*[
        F.struct(F.lit(m).alias("metric"), *[F.col(f"{m}_{n}").alias(n) for n in measures]) for m in names
    ])
    scores = wide.unpivot([], names, "metric", "score").filter("score is not null")
    stats = one.select(F.inline(rows)).filter("mean is not null")
    return stats.join(exact_median(scores.withColumn("n", F.lit(1))), "metric")


def exact_median(counts: DataFrame) -> DataFrame:
    """Median per ``metric`` of values (``score``) with their counts (``n``).

    Values are narrowed by histograms of 1024 bins around the wanted rank until
    one is left, so a round moves a bounded table, whatever their number.
    """
    spark, bins = counts.sparkSession, 1024
    ends = counts.groupBy("metric").agg(F.sum("n").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    open_ranks = [
        {"metric": r["metric"], "side": side, "lo": r["lo"], "hi": r["hi"], "rank": (r["n"] - 1 + side) // 2}
        for r in ends.collect() for side in (0, 1)
    ]
    done: list[tuple[str, float]] = []
    while open_ranks:
        schema = "metric string, side int, lo double, hi double, rank bigint"
        # Two rows per metric.
        wanted = F.broadcast(spark.createDataFrame([tuple(r.values()) for r in open_ranks], schema))
        width = F.col("hi") - F.col("lo")
        place = F.when(width > 0, F.least(F.floor((F.col("score") - F.col("lo")) / F.nullif(width, F.lit(0.0)) * bins), F.lit(bins - 1))).otherwise(0)
        near = counts.join(wanted, "metric").filter((F.col("score") >= F.col("lo")) & (F.col("score") <= F.col("hi")))
        rows = near.groupBy("metric", "side", place.alias("bin")).agg(
            F.sum("n").alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")
        ).orderBy("metric", "side", "bin").collect()
        following = []
        for r in open_ranks:
            before = 0
            for b in (b for b in rows if b["metric"] == r["metric"] and b["side"] == r["side"]):
                if before + b["n"] > r["rank"]:
                    if b["lo"] == b["hi"]:
                        done.append((r["metric"], b["lo"]))
                    else:
                        following.append({**r, "lo": b["lo"], "hi": b["hi"], "rank": r["rank"] - before})
                    break
                before += b["n"]
        open_ranks = following
    found = spark.createDataFrame(done, "metric string, score double")
    return found.groupBy("metric").agg(F.avg("score").alias("median"))


def evaluation_report(df: DataFrame, min_score: float = 0.7) -> DataFrame:
    """Grade counts and threshold compliance, in one row."""
    score = F.col("quality.overall")
    return df.agg(
        F.count(score).alias("total_evaluated"),
        *_grade_counts(score),
        F.lit(min_score).alias("threshold"),
        F.count_if(score >= min_score).alias("qualified"),
        F.coalesce(F.avg((score >= min_score).cast("double")), F.lit(0.0)).alias("qualified_rate"),
    )
