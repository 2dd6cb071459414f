"""Quality scores and reports on the derived domain texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import CJK, CJK_OR_LATIN, DIGIT, WORD_CHARS, find_all
from sluice.operators import quality as Q
from sluice.operators import reports as R
from sluice.plans.queries.enhance import ALL_QA, TERMS, with_terms
from sluice.operators import enhance as E
from sluice.plans.queries.registry import ZH, query, r6, s_count, s_ratio, s_str, s_strip, table, zh_documents
from sluice.session import durable


def s_any(x: str, words) -> str:
    return f"regexp_matches({x}, '{'|'.join(words)}')"


def s_points(test: str, points: float) -> str:
    return f"(case when {test} then {points}::double else 0.0::double end)"


def s_sum(parts) -> str:
    return "(" + " + ".join(parts) + ")"


def s_completeness(x: str, n_terms: str) -> str:
    structure = s_sum([s_points(f"regexp_matches({x}, '{DIGIT}')", 0.2), s_points(f"{n_terms} >= 2", 0.3),
                       s_points(s_any(x, V.CAUSE_WORDS), 0.2), s_points(s_any(x, V.APPLICATION_WORDS), 0.3)])
    return (f"least(1.0::double, least(1.0::double, length({x}) / 200.0::double) * 0.3::double + {structure} * 0.4::double"
            f" + least(1.0::double, {s_count(x, WORD_CHARS)} / 50.0::double) * 0.3::double)")


JOINED = "|".join(V.DOMAIN_VOCABULARY)


def s_domain_word(w: str) -> str:
    """Stated as the loop over the vocabulary."""
    words = "[" + ", ".join(s_str(v) for v in V.DOMAIN_VOCABULARY) + "]"
    return f"(len(list_filter({words}, lambda k: contains(lower({w}), k) or contains(k, lower({w})))) > 0)"


def s_relevance(x: str) -> str:
    matched = s_sum([f"contains(lower({x}), '{v}')::int" for v in V.DOMAIN_VOCABULARY])
    words = f"regexp_extract_all({x}, '{CJK_OR_LATIN}')"
    share = s_ratio(f"len(list_filter({words}, lambda w: {s_domain_word('w')}))", f"len({words})")
    areas = s_sum([s_points(s_any(x, w), 0.25) for w in V.RELEVANCE_AREAS.values()])
    return (f"least(1.0::double, {matched} / {len(V.DOMAIN_VOCABULARY)}.0::double * 0.4::double "
            f"+ least(1.0::double, {share} * 5) * 0.3::double + {areas} * 0.3::double)")


def s_variation(t: str, x: str) -> str:
    short = f"(left({t}, 1) || right({t}, 1))"
    tests = [f"(length({t}) > 2 and contains({x}, {short}) and {short} <> {t})"]
    for main, synonyms in V.SYNONYMS.items():
        tests.append(f"({t} = '{main}' and {s_any(x, synonyms)})")
        tests.append(f"({t} in ({', '.join(s_str(s) for s in synonyms)}))")
    return "(" + " or ".join(tests) + ")"


def s_repeated(x: str) -> str:
    """Terms that occur at least twice, from a count per term."""
    found = f"regexp_extract_all({x}, '[{CJK}]{{2,}}|[a-zA-Z]{{2,}}')"
    return f"map_keys(map_from_entries(list_filter(map_entries(list_histogram({found})), lambda e: e.value >= 2)))"


def s_consistency(x: str) -> str:
    zh, en = s_count(x, f"[{CJK}]"), s_count(x, "[a-zA-Z]")
    share = s_ratio(zh, f"({zh} + {en})")
    bonus = (f"(case when {zh} + {en} = 0 then 0.0::double when {share} > 0.2 and {share} < 0.8 then 0.1::double "
             f"when {share} > 0.9 or {share} < 0.1 then 0.05::double else 0.0::double end)")
    odd = f"len(list_filter({s_repeated(x)}, lambda t: {s_variation('t', x)}))"
    return f"greatest(0.0::double, least(1.0::double, 0.8::double + {bonus} - least(0.3::double, {odd} * 0.1::double)))"


def s_diversity(x: str) -> str:
    words = f"regexp_extract_all(lower({x}), '{CJK_OR_LATIN}')"
    vocabulary = s_ratio(f"len(list_distinct({words}))", f"len({words})")
    lengths = (f"list_transform(list_filter(list_transform(regexp_split_to_array({x}, '[。！？.!?]+'), lambda s: {s_strip('s')}), "
               f"lambda s: s <> ''), lambda s: length(s))")
    form = (f"(case when len({lengths}) > 1 then least(1.0::double, list_var_pop({lengths}) / (list_max({lengths}) * list_max({lengths})) * 10) else 0.0::double end)")
    topics = s_sum([s_points(s_any(x, w), 1.0) for w in V.TOPICS.values()])
    kinds = s_sum([s_points(f"regexp_matches({x}, '{DIGIT}')", 0.25), s_points(f"regexp_matches({x}, '[{V.DESCRIPTION_MARKS}]')", 0.25),
                   s_points(s_any(x, V.CAUSAL_LINKS), 0.25), s_points(s_any(x, V.ORDER_LINKS), 0.25)])
    return f"least(1.0::double, {vocabulary} * 0.3::double + {form} * 0.2::double + {topics} / 5 * 0.3::double + {kinds} * 0.2::double)"


@query("quality_completeness", f"with {TERMS} select doc_id, round({s_completeness('content', 'len(names)')}, 6) as score from named")
def _(spark, sf):
    return with_terms(spark, sf).select("doc_id", r6(Q.completeness(F.col("content"), F.size("extracted_terms")), "score"))


@query("quality_relevance", f"with {ZH} select doc_id, round({s_relevance('content')}, 6) as score from zh")
def _(spark, sf):
    return zh_documents(spark, sf).select("doc_id", r6(Q.relevance(F.col("content")), "score"))


@query("quality_domain_words", f"""
with {ZH}, w as (select distinct unnest(regexp_extract_all(content, '{CJK_OR_LATIN}')) as word from zh)
select word, {s_domain_word('word')}::int as on_topic from w""")
def _(spark, sf):
    words = zh_documents(spark, sf).select(F.explode(find_all(F.col("content"), CJK_OR_LATIN)).alias("word")).distinct()
    return words.select("word", Q.is_domain_word(F.col("word")).cast("int").alias("on_topic"))


BOTH = f"""{ZH}, b as (select doc_id, content from zh union all select -1 - doc_id, text from documents)"""


def both(spark, sf):
    docs = table(spark, sf, "documents").select((F.lit(-1) - F.col("doc_id")).alias("doc_id"), F.col("text").alias("content"))
    return zh_documents(spark, sf).select("doc_id", "content").unionByName(docs)


@query("quality_consistency", f"with {BOTH} select doc_id, round({s_consistency('content')}, 6) as score from b")
def _(spark, sf):
    return both(spark, sf).select("doc_id", r6(Q.consistency(F.col("content")), "score"))


@query("quality_term_variation", f"""
with {ZH}, t as (select doc_id, content, unnest({s_repeated('content')}) as term from zh)
select doc_id, term, {s_variation('term', 'content')}::int as varies from t""")
def _(spark, sf):
    zh = zh_documents(spark, sf)
    terms = zh.select("doc_id", F.explode(find_all(F.col("content"), f"[{CJK}]{{2,}}|[a-zA-Z]{{2,}}")).alias("term"))
    twice = terms.groupBy("doc_id", "term").count().filter("count >= 2").drop("count")
    return twice.join(zh, "doc_id").select("doc_id", "term", Q.has_variation(F.col("term"), F.col("content")).cast("int").alias("varies"))


@query("quality_diversity", f"with {BOTH} select doc_id, round({s_diversity('content')}, 6) as score from b")
def _(spark, sf):
    return both(spark, sf).select("doc_id", r6(Q.diversity(F.col("content")), "score"))


# Scores of the derived texts, stated once for all reports below.
SCORED = f"""{TERMS}, parts as (select doc_id, content, len(names) as n_terms, {s_completeness('content', 'len(names)')} as completeness,
  {s_relevance('content')} as relevance, {s_consistency('content')} as consistency, {s_diversity('content')} as diversity from named),
scored as (select *, completeness * 0.25::double + relevance * 0.3::double + consistency * 0.2::double + diversity * 0.25::double as overall from parts)"""


def scored(spark, sf, **options):
    return Q.evaluate(with_terms(spark, sf), **options)


def _flat(df):
    return df.select("*", *[F.col(f"quality.{m}").alias(m) for m in ["overall", *Q.METRICS]])


@query("quality_overall", f"""
with {SCORED} select doc_id, round(overall, 6) as overall, round((completeness * 0.25::double + diversity * 0.25::double) / 0.5::double, 6) as two_metrics from scored""")
def _(spark, sf):
    # Both means in one pass over the texts; only the scores are joined.
    two = scored(spark, sf, metrics=["completeness", "diversity"]).withColumn("two", F.col("quality.overall"))
    both_means = durable(_flat(Q.evaluate(two)).select("doc_id", "two", "overall"))
    means = both_means.select("doc_id", r6(F.col("overall"), "overall"))
    return means.join(both_means.select("doc_id", r6(F.col("two"), "two_metrics")), "doc_id")


@query("quality_warning", f"with {SCORED} select doc_id, (overall < 0.7)::int as warning from scored")
def _(spark, sf):
    return scored(spark, sf).select("doc_id", F.col("quality_warning").cast("int").alias("warning"))


def _rule(test: str, name: str) -> str:
    return f"case when {test} then '{V.SUGGESTIONS[name]}' end"


SUGGESTED = "array_to_string(list_filter([" + ", ".join([
    _rule("completeness < 0.7 and length(content) < 100", "short"),
    _rule(f"completeness < 0.7 and not regexp_matches(content, '{DIGIT}')", "no_number"),
    _rule("completeness < 0.7 and n_terms = 0", "no_term"),
    _rule("relevance < 0.6", "weak_relevance"), _rule("relevance < 0.4", "no_relevance"),
    _rule("consistency < 0.7", "inconsistent"), _rule("diversity < 0.6", "plain"), _rule("diversity < 0.4", "flat"),
]) + "], lambda s: s is not null), '|')"


@query("quality_suggestions", f"with {SCORED} select doc_id, {SUGGESTED} as suggestions from scored")
def _(spark, sf):
    return scored(spark, sf).select("doc_id", F.array_join("improvement_suggestions", "|").alias("suggestions"))


@query("quality_filter", f"with {SCORED} select doc_id, round(overall, 6) as overall from scored where overall >= 0.6")
def _(spark, sf):
    return _flat(Q.filter_by_quality(scored(spark, sf), 0.6)).select("doc_id", r6(F.col("overall"), "overall"))


S_QA = f"""(case when length(question) between 10 and 50 then 0.2::double when length(question) < 10 then 0.1::double else 0.15::double end
  + {s_points(s_any('question', V.QUESTION_WORDS), 0.2)}
  + case when length(answer) between 20 and 200 then 0.2::double when length(answer) < 20 then 0.1::double else 0.15::double end
  + {s_points(f"regexp_matches(answer, '{DIGIT}')", 0.1)} + {s_points(s_domain_word('answer'), 0.1)}
  + case when context <> '' and question <> '' then least(0.2::double, {s_ratio(
      f"len(list_intersect(list_distinct(regexp_extract_all(lower(question), '{CJK_OR_LATIN}')), regexp_extract_all(lower(context), '{CJK_OR_LATIN}')))",
      f"len(list_distinct(regexp_extract_all(lower(question), '{CJK_OR_LATIN}')))")}) else 0.0::double end)"""
QA_SCORED = f"{ALL_QA}, qa_scored as (select doc_id, position, least(1.0::double, {S_QA} * confidence) as q from all_qa)"


def qa_scored(spark, sf):
    return Q.qa_score(E.explode_qa(E.generate_qa(with_terms(spark, sf), "doc_id", limits=E.SHORT), "doc_id"))


@query("quality_qa_pairs", f"with {QA_SCORED} select doc_id, position, round(q, 6) as qa_quality from qa_scored")
def _(spark, sf):
    return qa_scored(spark, sf).select("doc_id", "position", r6(F.col("qa_quality"), "qa_quality"))


GRADES = """count(*) filter ({x} >= 0.8) as excellent, count(*) filter ({x} >= 0.6 and {x} < 0.8) as good,
  count(*) filter ({x} >= 0.4 and {x} < 0.6) as fair, count(*) filter ({x} < 0.4) as poor"""


@query("quality_qa_report", f"""
with {QA_SCORED} select count(*) as total_pairs, round(avg(q), 6) as average_quality, {GRADES.format(x='q')} from qa_scored""")
def _(spark, sf):
    return Q.qa_report(qa_scored(spark, sf)).withColumn("average_quality", F.round("average_quality", 6))


HISTORY = "history as (select doc_id, metric, score from (select doc_id, overall, completeness, relevance, consistency, diversity from scored) unpivot (score for metric in (overall, completeness, relevance, consistency, diversity)))"


@query("quality_history", f"with {SCORED}, {HISTORY} select doc_id, metric, round(score, 6) as score from history")
def _(spark, sf):
    return Q.score_history(scored(spark, sf), "doc_id").withColumn("score", F.round("score", 6))


@query("quality_metric_summary", f"""
with {SCORED}, {HISTORY} select metric, round(avg(score), 6) as mean, round(stddev_pop(score), 6) as std, round(min(score), 6) as min,
  round(max(score), 6) as max, round(median(score), 6) as median from history group by metric""")
def _(spark, sf):
    out = Q.metric_summary(scored(spark, sf), "doc_id")
    return out.select("metric", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "max", "median")])


@query("quality_report", f"""
with {SCORED} select count(*) as total_evaluated, {GRADES.format(x='overall')}, 0.7::double as threshold, count(*) filter (overall >= 0.7) as qualified,
  round(count(*) filter (overall >= 0.7) / count(*)::double, 6) as qualified_rate from scored""")
def _(spark, sf):
    return Q.evaluation_report(scored(spark, sf)).withColumn("qualified_rate", F.round("qualified_rate", 6))


@query("quality_whole", f"""
with {SCORED} select doc_id, round(overall, 6) as overall, round(completeness, 6) as completeness, round(relevance, 6) as relevance,
  round(consistency, 6) as consistency, round(diversity, 6) as diversity, (overall < 0.7)::int as warning, {SUGGESTED} as suggestions from scored""")
def _(spark, sf):
    out = _flat(scored(spark, sf))
    return out.select("doc_id", *[F.round(m, 6).alias(m) for m in ["overall", *Q.METRICS]],
                      F.col("quality_warning").cast("int").alias("warning"), F.array_join("improvement_suggestions", "|").alias("suggestions"))


# ---- dataset reports --------------------------------------------------------

ENUMS = "case lang when 'en' then 'en' else 'auto' end as language, case when text like '%|%' then 'table' else 'text' end as data_type"


@query("report_dataset_statistics", f"""
with c as (select text, {ENUMS} from documents)
select count(*) as total_chunks, {', '.join(f"count(*) filter (data_type = '{t}') as type_{t}" for t in V.DATA_TYPES)},
  {', '.join(f"count(*) filter (language = '{g}') as language_{g}" for g in V.LANGUAGES)},
  cast(sum(length(text)) as bigint) as total_characters, round(avg(length(text)), 6) as average_chunk_length from c""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.col("text").alias("content"), F.when(F.col("lang") == "en", "en").otherwise("auto").alias("language"),
        F.when(F.contains("text", F.lit("|")), "table").otherwise("text").alias("data_type"))
    return R.dataset_statistics(docs).withColumn("average_chunk_length", F.round("average_chunk_length", 6))


STATUS = "case when length(text) < 100 then 'failed' else 'completed' end"


@query("report_stage_summary", f"""
select count(*) as processed_count, count(*) filter (s = 'failed') as failed_count,
  round((count(*) - count(*) filter (s = 'failed')) / count(*)::double * 100, 6) as success_rate from (select {STATUS} as s from documents)""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.when(F.length("text") < 100, "failed").otherwise("completed").alias("status"))
    return R.stage_summary(docs).withColumn("success_rate", F.round("success_rate", 6))


@query("report_run", f"""
select 'clean' as stage, 'processed' as figure, count(*)::double as value from documents
union all select 'clean', 'failed', count(*) filter ({STATUS} = 'failed')::double from documents
union all select 'dataset', 'total_characters', sum(length(text))::double from documents
union all select 'dataset', 'total_chunks', count(*)::double from documents""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("text").alias("content"))
    watched, seen = R.watch(docs, "clean", F.length("content") < 100)
    stats = watched.agg(F.count(F.lit(1)).alias("total_chunks"), F.sum(F.length("content").cast("long")).alias("total_characters"))
    return R.run_report(spark, stats, {"clean": seen})


@query("report_per_source", f"""
with {SCORED} select source, count(*) as chunks, cast(sum(length(scored.content)) as bigint) as characters, round(avg(overall), 6) as average_quality
from scored join zh using (doc_id) group by source""")
def _(spark, sf):
    out = R.per_source(scored(spark, sf), "source")
    return out.withColumn("average_quality", F.round("average_quality", 6))
