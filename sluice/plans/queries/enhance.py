"""Terms, question-answer pairs, enrichment and tags on the derived domain texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import CJK, CJK_RUN, barrier
from sluice.operators import enhance as E
from sluice.operators.reports import category_counts
from sluice.plans.queries.clean import s_marked
from sluice.operators.dictionary import dictionary_table, extract_terms_by_table
from sluice.plans.queries.registry import (
    ZH, query, s_list, s_pick, s_str, s_strip, table, zh_documents,
)

KB = E.Knowledge()
NAMES = [*KB.terms, *KB.entities]


def s_in(words) -> str:
    return "(" + ", ".join(s_str(w) for w in words) + ")"


# Distinct useful pieces in text order: first positions, then names.
TERMS = f"""{ZH}, cut as (select doc_id, content, regexp_extract_all({s_marked('content', NAMES)}, '{CJK_RUN}') as p from zh),
named as (select doc_id, content, list_filter(p, lambda w, i: list_position(p, w) = i and length(w) > 1 and (w in {s_in(NAMES)}
  or (length(w) between 2 and 4 and regexp_matches(w, '[{V.TERM_INDICATORS}]')))) as names from cut)"""
KIND = f"""case when w in {s_in(KB.terms)} then '{V.TERM_TYPES['term']}' when w in {s_in(KB.entities)} then '{V.TERM_TYPES['entity']}' else '{V.TERM_TYPES['suspected']}' end"""
TRUST = f"""case when w in {s_in(KB.terms)} then 0.9::double when w in {s_in(KB.entities)} then 0.95::double else 0.7::double end"""


def with_terms(spark, sf):
    return E.extract_terms(zh_documents(spark, sf), "content", "language", KB)


def _map_text(column):
    """A map as one sorted text, so that it can be compared."""
    entries = F.transform(F.map_entries(column), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.array_join(F.array_sort(entries), ";")


ALIASES = "case w " + " ".join(f"when {s_str(t)} then {s_str('|'.join(a))}" for t, a in KB.terms.items()) + " end"
FACTS = "case w " + " ".join(
    f"when {s_str(e)} then {s_str(';'.join(sorted(f'{k}={v}' for k, v in i.items())))}" for e, i in KB.entities.items()
) + " end"


@query("terms_chinese", f"""
with {TERMS}, flat as (select doc_id, names, unnest(names) as w from named)
select doc_id, list_position(names, w) - 1 as ordinal, w as term, {KIND} as type, {TRUST} as confidence, {ALIASES} as aliases, {FACTS} as facts from flat""")
def _(spark, sf):
    rows = E.term_rows(with_terms(spark, sf), "doc_id")
    return rows.select("doc_id", "ordinal", "term", "type", "confidence",
                       F.when(F.col("aliases").isNotNull(), F.array_join("aliases", "|")).alias("aliases"),
                       F.when(F.col("entity_info").isNotNull(), _map_text(F.col("entity_info"))).alias("facts"))


@query("terms_from_dictionary_table", f"""
with {TERMS}, flat as (select doc_id, names, unnest(names) as w from named)
select doc_id, list_position(names, w) - 1 as ordinal, w as term, {KIND} as type, {TRUST} as confidence, {ALIASES} as aliases, {FACTS} as facts from flat""")
def _(spark, sf):
    # The knowledge base among a word for every part, which no text holds.
    parts = table(spark, sf, "part").select(F.concat(F.lit("零件"), "p_partkey").alias("term"), F.lit("term").alias("kind"), F.array("p_brand").alias("aliases"))
    words = dictionary_table(spark, KB).unionByName(parts, allowMissingColumns=True)
    rows = E.term_rows(extract_terms_by_table(zh_documents(spark, sf), words), "doc_id")
    return rows.select("doc_id", "ordinal", "term", "type", "confidence",
                       F.when(F.col("aliases").isNotNull(), F.array_join("aliases", "|")).alias("aliases"),
                       F.when(F.col("entity_info").isNotNull(), _map_text(F.col("entity_info"))).alias("facts"))


ENGLISH = ["the", "and", "with", "this", "water", "river", "for", "that", "water quality", "from"]


@query("terms_english", f"""
with t as (select doc_id, regexp_extract_all(lower(text), '\\b[a-z]+\\b') as p from documents),
n as (select doc_id, list_filter(p, lambda w, i: list_position(p, w) = i and length(w) > 1 and w in {s_in(ENGLISH)}) as names from t)
select doc_id, list_position(names, w) - 1 as ordinal, w as term, '{V.TERM_TYPES['english']}' as type, 0.8::double as confidence
from (select doc_id, names, unnest(names) as w from n)""")
def _(spark, sf):
    docs = table(spark, sf, "documents").withColumn("tag", F.lit("en"))
    rows = E.term_rows(E.extract_terms(docs, "text", "tag", KB, ENGLISH), "doc_id")
    return rows.select("doc_id", "ordinal", "term", "type", "confidence")


@query("terms_routed", f"""
with {TERMS}, en as (select doc_id, regexp_extract_all(lower(content), '\\b[a-z]+\\b') as q from zh),
e as (select doc_id, list_filter(q, lambda w, i: list_position(q, w) = i and length(w) > 1 and w in {s_in(V.ENGLISH_TERMS)}) as more from en)
select doc_id, case doc_id % 4 when 0 then 'zh' when 1 then 'en' when 2 then 'auto' else 'other' end as tag,
  array_to_string(case doc_id % 4 when 1 then more when 3 then list_concat(names, more)
    else case when doc_id % 4 = 0 or regexp_matches(content, '[{CJK}]') then names else list_concat(names, more) end end, '|') as names
from named join e using (doc_id)""")
def _(spark, sf):
    tag = F.element_at(F.array(*[F.lit(x) for x in ("zh", "en", "auto", "other")]), (F.col("doc_id") % 4 + 1).cast("int"))
    docs = zh_documents(spark, sf).withColumn("tag", tag)
    out = E.extract_terms(docs, "content", "tag", KB)
    return out.select("doc_id", "tag", F.array_join(F.transform("extracted_terms", lambda t: t["term"]), "|").alias("names"))


def s_positions(text: str, term: str) -> str:
    """Offsets (from 0) of all occurrences; by splitting, or letter by letter if the term can overlap itself."""
    split = (f"list_transform(range(1, len(string_split({text}, {term}))), lambda k: cast(list_sum(list_transform("
             f"string_split({text}, {term})[1:k], lambda x: length(x))) as bigint) + (k - 1) * length({term}))")
    each = f"list_filter(range(0, length({text})), lambda p: substr({text}, p + 1, length({term})) = {term})"
    overlaps = f"(left({term}, 1) = right({term}, 1) or left({term}, 2) = right({term}, 2) and length({term}) > 2)"
    return f"(case when {overlaps} then {each} else {split} end)"


def s_answer(text: str, term: str, default: str) -> str:
    windows = (f"list_transform({s_positions(text, term)}, lambda pos: "
               + s_strip(f"substr({text}, greatest(pos - 100, 0) + 1, pos - greatest(pos - 100, 0) + length({term}) + 100)") + ")")
    good = f"list_filter({windows}, lambda x: length(x) > 20)"
    longest = f"list_reduce({good}, lambda a, b: case when length(b) > length(a) then b else a end, '')"
    return f"coalesce(nullif({longest}, ''), {default})"


KINDS = list(V.QA_TEMPLATES)
TEMPLATES = "[" + ", ".join(s_list(V.QA_TEMPLATES[k]) for k in KINDS) + "]"
DEFAULTS = s_list(V.DEFAULT_ANSWERS[k] for k in KINDS)
DOMAIN = "case w " + " ".join(f"when {s_str(k)} then {s_str(v)}" for k, v in V.TERM_DOMAINS.items()) + f" else {s_str(V.DEFAULT_DOMAIN)} end"
TEMPLATE_QA = f"""{TERMS}, top as (select doc_id, content, names, unnest(range(1, least(len(names), 3) + 1)) as i from named),
seeded as (select *, names[i] as w, doc_id || '|' || names[i] as seed from top),
others as (select *, list_filter(names, lambda n: n <> w) as partners from seeded),
kinds as (select *, {s_pick('seed', 'case when len(partners) > 0 then 5 else 4 end')} as k from others),
filled as (select *, ({TEMPLATES})[k + 1][{s_pick("seed || '|t'", '3')} + 1] as template,
  partners[{s_pick("seed || '|o'", 'greatest(len(partners), 1)')} + 1] as other from kinds),
template_qa as (select doc_id, i - 1 as ordinal, replace(replace(template, '{{term}}', w), '{{other}}', coalesce(other, '')) as question,
  {s_answer('content', 'w', f"replace(({DEFAULTS})[k + 1], '{{term}}', w)")} as answer,
  case when length(content) > 200 then left(content, 200) || '...' else content end as context,
  {DOMAIN} as domain, 0.8::double as confidence, 'template' as method from filled)"""
FACT = E.fact_pattern()
NUMERIC_QA = f"""facts as (select doc_id, content, regexp_extract_all(content, '{FACT}')[1:2] as f from zh),
fact_rows as (select doc_id, content, f[i] as fact, i - 1 as ordinal, strpos(content, f[i]) - 1 as pos from (select *, unnest(range(1, len(f) + 1)) as i from facts)),
sentences as (select *, {s_strip('substr(content, greatest(pos - 50, 0) + 1, pos - greatest(pos - 50, 0) + length(fact) + 50)')} as sentence from fact_rows),
numeric_qa as (select doc_id, ordinal, replace('{V.FACT_QUESTION}', '{{fact}}', fact) as question,
  replace('{V.FACT_ANSWER}', '{{sentence}}', sentence) as answer, sentence as context, '{V.FACT_DOMAIN}' as domain,
  0.7::double as confidence, 'content' as method from sentences)"""
ALL_QA = f"""{TEMPLATE_QA}, {NUMERIC_QA}, all_qa as (select * from (select *, row_number() over (partition by doc_id
  order by case method when 'template' then 0 else 2 end, ordinal) - 1 as position
  from (select * from template_qa union all select * from numeric_qa)) where position < 5)"""
# The same without limits.
ALL_TERMS_QA = TEMPLATE_QA.replace("least(len(names), 3)", "len(names)").replace(
    "case when length(content) > 200 then left(content, 200) || '...' else content end", "content")
ALL_NUMBERS_QA = NUMERIC_QA.replace("')[1:2] as f", "') as f")
QA_COLUMNS = ["doc_id", "ordinal", "question", "answer", "context", "domain", "confidence", "method"]


def _qa_rows(df, pairs):
    rows = df.select("doc_id", F.explode(pairs).alias("q"))
    return rows.select("doc_id", "q.*").select(*QA_COLUMNS)


def _names():
    return F.transform("extracted_terms", lambda t: t["term"])


@query("qa_from_templates", f"with {TEMPLATE_QA} select {', '.join(QA_COLUMNS)} from template_qa")
def _(spark, sf):
    df = with_terms(spark, sf).withColumn("names", _names())
    key = F.col("doc_id").cast("string")
    return _qa_rows(df, E.template_qa(F.col("content"), F.col("names"), key, E.SHORT.terms, E.SHORT.context))


@query("qa_from_all_terms", f"with {ALL_TERMS_QA} select {', '.join(QA_COLUMNS)} from template_qa")
def _(spark, sf):
    df = with_terms(spark, sf).withColumn("names", _names())
    return _qa_rows(df, E.template_qa(F.col("content"), F.col("names"), F.col("doc_id").cast("string")))


@query("qa_comparison_partner", f"with {TEMPLATE_QA} select doc_id, w as term, other as partner from filled where k = 4")
def _(spark, sf):
    from sluice.functions.text import hash_pick

    df = with_terms(spark, sf).withColumn("names", _names())
    rows = df.select("doc_id", "names", F.explode(F.slice("names", 1, 3)).alias("term"))
    seed = F.concat_ws("|", F.col("doc_id").cast("string"), "term")
    rows = rows.withColumn("partners", F.filter("names", lambda n: n != F.col("term")))
    rows = rows.filter(hash_pick(seed, F.when(F.size("partners") > 0, 5).otherwise(4)) == 4)
    pick = hash_pick(F.concat(seed, F.lit("|o")), F.greatest(F.size("partners"), F.lit(1)))
    return rows.select("doc_id", "term", F.get("partners", pick).alias("partner"))


PROBE = "水位"


@query("answer_window", f"with {ZH} select doc_id, {s_answer('content', s_str(PROBE), s_str('-'))} as answer from zh")
def _(spark, sf):
    return zh_documents(spark, sf).select("doc_id", E.answer_window(F.col("content"), F.lit(PROBE), F.lit("-")).alias("answer"))


@query("qa_from_numbers", f"with {ZH}, {NUMERIC_QA} select {', '.join(QA_COLUMNS)} from numeric_qa")
def _(spark, sf):
    return _qa_rows(zh_documents(spark, sf), E.numeric_qa(F.col("content"), E.SHORT.facts))


@query("qa_from_all_numbers", f"with {ZH}, {ALL_NUMBERS_QA} select {', '.join(QA_COLUMNS)} from numeric_qa")
def _(spark, sf):
    return _qa_rows(zh_documents(spark, sf), E.numeric_qa(F.col("content")))


@query("qa_limit_per_chunk", f"with {ALL_QA} select doc_id, ordinal, method, question from all_qa where position < 4")
def _(spark, sf):
    df = with_terms(spark, sf).withColumn("names", _names())
    key = F.col("doc_id").cast("string")
    pairs = F.concat(
        E.template_qa(F.col("content"), F.col("names"), key, E.SHORT.terms, E.SHORT.context),
        E.numeric_qa(F.col("content"), E.SHORT.facts),
    )
    return E.limit_per_chunk(_qa_rows(df, pairs), "doc_id", 4).select("doc_id", "ordinal", "method", "question")


@query("qa_flattened", f"""
with {ALL_QA} select doc_id, position, question, answer, context, domain, confidence, method from all_qa""")
def _(spark, sf):
    return E.explode_qa(E.generate_qa(with_terms(spark, sf), "doc_id", limits=E.SHORT), "doc_id")


# All pairs without any limit.
WHOLE_QA = f"{ALL_TERMS_QA}, {ALL_NUMBERS_QA}, {ALL_QA.split(NUMERIC_QA + ', ')[1].replace(' where position < 5', '')}"


@query("qa_flattened_whole", f"""
with {WHOLE_QA}
select doc_id, position, question, answer, context, domain, confidence, method from all_qa""")
def _(spark, sf):
    return E.explode_qa(E.generate_qa(with_terms(spark, sf), "doc_id"), "doc_id")


def s_enriched(text: str, names: str) -> str:
    x = text
    for term, explanation in V.EXPLANATIONS.items():
        full = f"{term}（{explanation}）"
        # Mark, explain, then undo where a bracket already followed.
        done = f"replace(replace({{x}}, '{term}', '{full}'), '{full}（', '{term}（')"
        x = (f"list_transform([{x}], lambda x: case when list_contains({names}, '{term}') and not contains(x, '{term}{explanation}') "
             f"then {done.format(x='x')} else x end)[1]")
    return x


@query("enrich_with_explanations", f"""
with {TERMS} select doc_id, {s_enriched('content', 'names')} as content, ({s_enriched('content', 'names')} <> content)::int as knowledge_enriched from named""")
def _(spark, sf):
    df = with_terms(spark, sf)
    out = barrier(df, e=E.enrich(F.col("content"), F.col("extracted_terms")))
    return out.select("doc_id", F.col("e").alias("content"), (F.col("e") != F.col("content")).cast("int").alias("knowledge_enriched"))


def s_tags(text: str) -> str:
    rules = ", ".join(f"case when regexp_matches({text}, '{'|'.join(w)}') then '{d}' end" for d, w in V.DOMAIN_KEYWORDS.items())
    return f"array_to_string(list_filter([{rules}], lambda t: t is not null), '|')"


@query("domain_tags", f"with {ZH} select doc_id, {s_tags('content')} as tags from zh")
def _(spark, sf):
    return zh_documents(spark, sf).select("doc_id", F.array_join(E.domain_tags(F.col("content")), "|").alias("tags"))


@query("term_domains", f"""
with {TERMS}, flat as (select unnest(names) as w from named) select {DOMAIN} as domain, count(*) as rows from flat group by 1""")
def _(spark, sf):
    rows = E.term_rows(with_terms(spark, sf), "doc_id").select(E.domain_of(F.col("term")).alias("domain"))
    return category_counts(rows, "domain")


@query("knowledge_update", """
with kb as (select p_name as term, string_agg(distinct p_brand, '|' order by p_brand) as aliases from part where p_size < 25 group by 1),
new as (select p_name as term, string_agg(distinct p_type, '|' order by p_type) as aliases from part where p_size >= 40 group by 1)
select * from new union all select * from kb where term not in (select term from new)""")
def _(spark, sf):
    part = table(spark, sf, "part")

    def terms(df, column):
        return df.groupBy(F.col("p_name").alias("term")).agg(F.array_join(F.array_sort(F.collect_set(column)), "|").alias("aliases"))

    return E.update_kb(terms(part.filter("p_size < 25"), "p_brand"), terms(part.filter("p_size >= 40"), "p_type"), "term")


@query("enhance_statistics", f"""
with {ALL_QA} select (select count(*) from all_qa) as generated_qa_count, (select cast(sum(len(names)) as bigint) from named) as extracted_terms_count,
  {len(KB.terms)} as knowledge_base_terms, {len(KB.entities)} as knowledge_base_entities""")
def _(spark, sf):
    return E.enhance_stats(E.generate_qa(with_terms(spark, sf), "doc_id", limits=E.SHORT), KB)


@query("enhance_whole", f"""
with {WHOLE_QA}, e as (select doc_id, names, content as original, {s_enriched('content', 'names')} as content from named),
n as (select doc_id, count(*) as pairs, string_agg(question, '|' order by position) as questions from all_qa group by doc_id)
select doc_id, content, array_to_string(names, '|') as names, coalesce(pairs, 0) as pairs, coalesce(questions, '') as questions,
  {s_tags('content')} as tags, (content <> original)::int as knowledge_enriched from e left join n using (doc_id)""")
def _(spark, sf):
    out = E.enhance(zh_documents(spark, sf), "doc_id", language_col="language", kb=KB)
    return out.select(
        "doc_id", "content", F.array_join(_names(), "|").alias("names"), F.size("generated_qa").alias("pairs"),
        F.array_join(F.transform("generated_qa", lambda q: q["question"]), "|").alias("questions"),
        F.array_join("domain_tags", "|").alias("tags"), F.col("knowledge_enriched").cast("int").alias("knowledge_enriched"),
    )
