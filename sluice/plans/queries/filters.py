"""Text and code filters, one query per filter and the recipes that chain them."""

from __future__ import annotations


from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.text import BLANK, SENTENCE_MARK, WORD, WORD_CHARS
from sluice.operators import filters_code as G
from sluice.operators import filters_text as T
from sluice.plans import recipes
from sluice.plans.queries.clean import SHINGLES
from sluice.plans.queries.parse import _language_sql
from sluice.plans.queries.registry import (
    query, r6, s_count, s_list, s_ratio, s_str, s_strip, s_words, table,
)

# ---- refiners ---------------------------------------------------------------


def s_spaces(x: str) -> str:
    return s_strip(f"regexp_replace({x}, '[{BLANK}]+', ' ', 'g')")


def s_emoji(x: str) -> str:
    return f"regexp_replace({x}, '{T.EMOJI}', '', 'g')"


def s_html_url(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, 'https?://[^{BLANK}<>\"]+', '', 'g'), '<[^<>]+>', '', 'g')"


@query("refine_extra_spaces", f"select doc_id, {s_spaces('text')} as refined from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.remove_extra_spaces(F.col("text")).alias("refined"))


FACES = "['😀', '☀', '🚀', '✔', '🇫🇷', 'x']"


@query("refine_emoji", f"""
select doc_id, {s_emoji("replace(text, ' the ', ({FACES})[1 + doc_id % 6])").replace('{FACES}', FACES)} as refined from documents""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    face = F.element_at(F.array(*[F.lit(c) for c in ("😀", "☀", "🚀", "✔", "🇫🇷", "x")]), (F.col("doc_id") % 6 + 1).cast("int"))
    return docs.select("doc_id", T.remove_emoji(F.replace("text", F.lit(" the "), face)).alias("refined"))


@query("refine_html_url", f"select page_id, {s_html_url('''url || ' ' || html''')} as refined from pages")
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.remove_html_url(F.concat_ws(" ", "url", "html")).alias("refined"))


# ---- heuristic filters ------------------------------------------------------
# (predicate, SQL test over a row with the columns t, w and l)

BLOCKED = ["lorem", "casino", "the", "und", "que", "pour", "viagra"]
S_LOW = f"regexp_extract_all(lower(t), '{WORD_CHARS}')"
FILTERS = {
    "blocklist": (lambda: T.blocklist(BLOCKED), f"len(list_intersect(list_distinct({S_LOW}), {s_list(BLOCKED)})) <= 1"),
    "word_number": (lambda: T.word_number(20, 100_000), "len(w) >= 20 and len(w) < 100000"),
    "word_number_sft": (lambda: T.word_number(20, 1000), "len(w) >= 20 and len(w) < 1000"),
    "colon_end": (lambda: T.colon_end(), rf"not regexp_matches(t, '[:：][{BLANK}]*\z')"),
    "sentence_number": (lambda: T.sentence_number(3, 7500), f"{s_count('t', SENTENCE_MARK)} between 3 and 7500"),
    "line_end_with_ellipsis": (lambda: T.line_end_with_ellipsis(0.3), rf"{s_ratio(f'len(list_filter(l, lambda s: regexp_matches(s, ' + chr(39) + r'(?:\.\.\.|…)[' + BLANK + r']*\z' + chr(39) + ')))', 'len(l)')} <= 0.3::double"),
    "content_null": (lambda: T.content_null(), f"t is not null and {s_strip('t')} <> ''"),
    "mean_word_length": (lambda: T.mean_word_length(3, 10), f"{s_ratio('coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)', 'len(w)')} >= 3 and {s_ratio('coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)', 'len(w)')} < 10"),
    "symbol_word_ratio": (lambda: T.symbol_word_ratio(0.4), f"{s_ratio(s_count('t', chr(35) + '|' + r'\.\.\.|…'), 'len(w)')} < 0.4::double"),
    "html_entity": (lambda: T.html_entity(), f"not regexp_matches(t, '{T.HTML_ENTITY}')"),
    "no_punc": (lambda: T.no_punc(112), f"list_max(list_transform(regexp_split_to_array(t, '{SENTENCE_MARK}'), lambda s: {s_count('s', WORD)})) <= 112"),
    "special_character": (lambda: T.special_character(), f"not regexp_matches(t, '{T.ODD_CHARACTER}')"),
    "watermark": (lambda: T.watermark(), f"not regexp_matches(t, '{'|'.join(V.WATERMARKS)}')"),
    "curly_bracket": (lambda: T.curly_bracket(0.025), f"{s_ratio(s_count('t', '[{}]'), 'length(t)')} < 0.025::double"),
    "capital_words": (lambda: T.capital_words(0.2), f"{s_ratio('len(list_filter(w, lambda x: x = upper(x) and x <> lower(x)))', 'len(w)')} <= 0.2::double"),
    "lorem_ipsum": (lambda: T.lorem_ipsum(3e-8), f"{s_ratio(s_count('t', '(?i)lorem ipsum'), 'length(t)')} <= 3e-8::double"),
    "unique_words": (lambda: T.unique_words(0.1), f"{s_ratio('len(list_distinct(list_transform(w, lambda x: lower(x))))', 'len(w)')} > 0.1::double"),
    "char_number": (lambda: T.char_number(100), f"length(regexp_replace(t, '[{BLANK}]+', '', 'g')) >= 100"),
    "line_start_with_bullet": (lambda: T.line_start_with_bullet(0.9), f"{s_ratio(f'len(list_filter(l, lambda s: regexp_matches(s, ' + chr(39) + T.BULLET_LINE + chr(39) + ')))', 'len(l)')} <= 0.9::double"),
    "line_with_javascript": (lambda: T.line_with_javascript(3), "len(list_filter(l, lambda s: contains(lower(s), 'javascript'))) < 3"),
    "id_card": (lambda: T.id_card(3), f"{s_count('t', T.ID_NUMBER)} < 3"),
}
# What a third of the documents is turned into, for tests that none of them would fail; read alike by both engines.
TRIPS = {
    "colon_end": "text || ': '",
    "line_end_with_ellipsis": "replace(text, chr(10), '...' || chr(10)) || '...'",
    "content_null": "nullif(text, text)",
    "mean_word_length": "replace(text, ' ', '')",
    "html_entity": "text || ' &nbsp; '",
    "special_character": "text || chr(7)",
    "watermark": "text || ' Confidential'",
    "curly_bracket": "replace(text, ' ', '{}')",
    "lorem_ipsum": "text || ' Lorem ipsum'",
    "line_start_with_bullet": "'- ' || replace(text, chr(10), chr(10) || '- ')",
    "line_with_javascript": "text || repeat(chr(10) || 'enable JavaScript', 3)",
    "id_card": "text || repeat(' 123-45-6789', 3)",
}


def _tripped(name: str) -> str:
    return f"case when doc_id % 3 = 0 then {TRIPS[name]} else text end" if name in TRIPS else "text"


def _base(name: str) -> str:
    return f"""docs as (select doc_id, lang, source, {_tripped(name)} as t from documents),
base as (select *, {s_words('t')} as w, string_split(t, chr(10)) as l from docs)"""


def _register(name, make, test):
    @query(f"filter_{name}", f"with {_base(name)} select doc_id, lang, source from base where {test}")
    def _(spark, sf):
        docs = table(spark, sf, "documents").withColumn("text", F.expr(_tripped(name)))
        return T.keep(docs, "text", make()).select("doc_id", "lang", "source")


for _name, (_make, _test) in FILTERS.items():
    _register(_name, _make, _test)


@query("filter_blocklist_table", f"""
with b as (select distinct lower(p_name) as word from (select unnest(string_split(p_name, ' ')) as p_name from part) union select unnest(['the', 'und', 'que', 'de'])),
t as (select doc_id, unnest(list_distinct({S_LOW.replace('(t)', '(text)')})) as word from documents),
bad as (select doc_id from t join b using (word) group by doc_id having count(*) > 1)
select doc_id, lang from documents where doc_id not in (select doc_id from bad)""")
def _(spark, sf):
    part = table(spark, sf, "part")
    words = part.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()
    words = words.unionByName(spark.createDataFrame([(w,) for w in ("the", "und", "que", "de")], "word string"))
    return T.blocklist_join(table(spark, sf, "documents"), "doc_id", "text", words).select("doc_id", "lang")


@query("filter_language", f"""
with base as (select doc_id, lang, text from documents) select doc_id, lang from {_language_sql('text')} where detected = 'en'""")
def _(spark, sf):
    return T.keep(table(spark, sf, "documents"), "text", T.language(["en"])).select("doc_id", "lang")


@query("filter_score_band", """
select doc_id, lang from documents join labels using (doc_id) where quality between 1 and 9 and toxic between 0 and 0""")
def _(spark, sf):
    labels = T.score_band(table(spark, sf, "labels"), "toxic", 0, 0)
    return T.join_score_band(table(spark, sf, "documents"), labels, "doc_id", "quality", 1, 9).select("doc_id", "lang")


# ---- recipes over texts -----------------------------------------------------

S_REFINED = s_spaces(s_html_url(s_emoji("text")))
RBASE = f"r as (select doc_id, lang, source, {S_REFINED} as t from documents), base as (select *, {s_words('t')} as w, string_split(t, chr(10)) as l from r)"
TESTS = [FILTERS[n][1] for n in recipes.PRETRAIN_FILTERS]
NEAR = SHINGLES.replace("text, ", "t, ").replace("lower(text)", "lower(t)").replace("from documents", "from kept")


@query("recipe_pretrain_text", f"""
with {RBASE}, kept as (select doc_id, lang, t from base where {' and '.join(f'({x})' for x in TESTS)}), {NEAR}
select doc_id, lang, md5(t) as text_hash from kept where doc_id not in (select doc_id from pairs)""")
def _(spark, sf):
    out = recipes.pretrain_text(table(spark, sf, "documents"), "text", "doc_id")
    return out.select("doc_id", "lang", F.md5("text").alias("text_hash"))


NEAR_FIRST = SHINGLES.replace("text, ", "t, ").replace("lower(text)", "lower(t)").replace("from documents", "from r")


@query("recipe_pretrain_text_dedup_first", f"""
with {RBASE}, kept as (select doc_id, lang, t from base where {' and '.join(f'({x})' for x in TESTS)}), {NEAR_FIRST}
select doc_id, lang, md5(t) as text_hash from kept where doc_id not in (select doc_id from pairs)""")
def _(spark, sf):
    out = recipes.pretrain_text(table(spark, sf, "documents"), "text", "doc_id", dedup_first=True)
    return out.select("doc_id", "lang", F.md5("text").alias("text_hash"))


def _stage_sql() -> str:
    parts = ["select 0 as step, 'start' as name, count(*) as rows from base"]
    for i, name in enumerate(recipes.PRETRAIN_FILTERS):
        parts.append(f"select {i + 1}, '{name}', count(*) filter ({' and '.join(f'({x})' for x in TESTS[: i + 1])}) from base")
    return f"with {RBASE} " + " union all ".join(parts)


@query("recipe_pretrain_stages", _stage_sql())
def _(spark, sf):
    return recipes.pretrain_stage_counts(table(spark, sf, "documents"), "text")


@query("recipe_sft_text", f"""
with t as (select conv_id, turn, {s_words('text')} as w from conversations where role = 'assistant')
select conv_id, turn from t where len(w) >= 20 and len(w) < 1000""")
def _(spark, sf):
    turns = table(spark, sf, "conversations").filter("role = 'assistant'")
    return recipes.sft_text(turns, "text").select("conv_id", "turn")


@query("documents_surviving_filters", f"""
with r as (select doc_id, lang, source, {s_spaces('text')} as t from documents),
base as (select *, {s_words('t')} as w, string_split(t, chr(10)) as l from r),
kept as (select * from base where {' and '.join(f'({FILTERS[n][1]})' for n in ('word_number', 'sentence_number', 'mean_word_length', 'unique_words', 'char_number'))}),
firsts as (select min(doc_id) as doc_id from kept group by md5(t))
select lang, source, count(*) as documents, round(avg(length(t)), 6) as mean_length from kept where doc_id in (select doc_id from firsts) group by 1, 2""")
def _(spark, sf):
    from sluice.functions.text import barrier

    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    docs = barrier(docs, text=T.remove_extra_spaces(F.col("text")))
    kept = T.keep(docs, "text", T.word_number(), T.sentence_number(), T.mean_word_length(), T.unique_words(), T.char_number())
    # Copies leave by their fingerprint; only length travels further than that.
    slim = kept.select("doc_id", "lang", "source", F.length("text").alias("n"), F.unhex(F.md5("text")).alias("k"))
    first = slim.groupBy("k").agg(F.min(F.struct("doc_id", "lang", "source", "n")).alias("d")).select("d.*")
    return first.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("documents"), r6(F.avg("n"), "mean_length"))


# ---- code filters -----------------------------------------------------------
# Pages stand in for code records: their markup is the text, their lines the lines.

# Some carry a generator's notice, a long encoded run or mostly marks.
S_CODE = """case page_id % 7 when 1 then 'auto-generated ' || html when 2 then repeat('QUJD', 3000) || html
  when 3 then html || repeat('#|', length(html) * 2) else html end"""
CODE = f"""p as (select page_id, url, {S_CODE} as html from pages),
c as (select page_id, html as t, string_split(html, '<') as l, {s_words('html')} as w, lower(split_part(url, '.', -1)) as ext, url,
  length(regexp_replace(html, '<[^>]+>', '', 'g')) as visible, length(html) as total from p)"""


def code_records(spark, sf):
    pages = table(spark, sf, "pages").withColumn("html", F.expr(S_CODE))
    kind = F.element_at(F.array(*[F.lit(k) for k in ("html", "text", "python", "md")]), (F.col("page_id") % 4 + 1).cast("int"))
    name = F.element_at(F.array(*[F.lit(k) for k in ("readme.md", "main.py", "x.html", "notes.txt", "data.md")]), (F.col("page_id") % 5 + 1).cast("int"))
    return pages.select(
        "page_id", F.col("html").alias("text"), F.split("html", "<").alias("lines"), kind.alias("filetype"), name.alias("filename"),
        F.length(F.regexp_replace("html", "<[^>]+>", "")).alias("visible_text_length"), F.length("html").alias("total_code_length"),
    )


S_GEN = f"not (len(list_filter(l[1:5], lambda s: regexp_matches(s, '{G.GENERATED_MARKS}'))) > 0)"
S_LINES = "list_transform(l, lambda s: length(s))"
S_LEN = f"len(l) <= 100000 and {s_ratio(f'list_sum({S_LINES})', 'len(l)')} <= 100 and list_max({S_LINES}) <= 1000"
S_COMP = rf"{s_ratio(s_count('t', r'[\p{L}\p{N}]'), 'length(t)')} >= 0.25::double and not contains(t, chr(0))"
S_ENC = " and ".join(
    f"(coalesce(list_max(list_transform(regexp_extract_all(t, '{p}'), lambda s: length(s))), 0) <= 1024 and "
    + s_ratio(f"coalesce(list_sum(list_transform(regexp_extract_all(t, '{p}'), lambda s: length(s))), 0)", "length(t)") + " < 0.5::double)"
    for p in G.ENCODED.values()
)


def s_grams(n: int) -> str:
    return ("list_transform(range(1, greatest(len(w) - " + str(n - 2) + ", 1)), lambda i: "
            + " || ' ' || ".join(f"w[i + {k}]" for k in range(n)) + ")")


def s_dup(x: str) -> str:
    return f"(case when len({x}) = 0 then 0.0::double else 1.0::double - len(list_distinct({x}))::double / len({x}) end)"


S_ENTROPY = ("(case when len(w) = 0 then 0.0::double else ln(len(w)) - list_sum(list_transform(map_values(list_histogram(w)), "
             "lambda c: c * ln(c)))::double / len(w) end)")
S_QUALITY = " and ".join([
    "length(t) between 100 and 100000", "len(w) between 10 and 50000", f"{s_dup('l')} <= 0.3::double",
    f"{s_ratio(s_count('t', '[{}]'), 'length(t)')} <= 0.1::double",
    f"{s_ratio('len(list_filter(w, lambda x: x = upper(x) and x <> lower(x)))', 'len(w)')} <= 0.3::double",
    *[f"{s_dup(s_grams(n))} <= 0.3::double" for n in (2, 3, 4, 5)], f"{S_ENTROPY} >= 2.0::double",
])
NAMES = s_list(["readme.md", "main.py", "x.html", "notes.txt", "data.md"])
S_TYPE = (f"case (['html', 'text', 'python', 'md'])[1 + page_id % 4] when 'html' then visible >= 100 and {s_ratio('visible', 'total')} >= 0.2::double "
          rf"when 'python' then true else regexp_replace(({NAMES})[1 + page_id % 5], '\.[^.]*\z', '') in ({', '.join(s_str(n) for n in G.TEXT_NAMES)}) end")
CODE_TESTS = {"autogen": S_GEN, "length": S_LEN, "composition": S_COMP, "encoded": S_ENC, "quality": S_QUALITY, "filetype": S_TYPE}


def _register_code(name, test):
    @query(f"code_{name}", f"with {CODE} select page_id, ({test})::int as {name}_label from c")
    def _(spark, sf):
        return G.code_labels(code_records(spark, sf)).select("page_id", f"{name}_label")


for _name, _test in CODE_TESTS.items():
    _register_code(_name, _test)


@query("code_document_entropy", f"""
with b as (select doc_id, {s_words('text')} as w from documents)
select doc_id, round({S_ENTROPY}, 6) as entropy, round({s_dup(s_grams(2))}, 6) as repeated_pairs from b""")
def _(spark, sf):
    from sluice.functions.text import barrier, ngrams, words_of

    docs = barrier(table(spark, sf, "documents").select("doc_id", "text"), w=words_of(F.col("text")))
    return docs.select("doc_id", r6(G.unigram_entropy(F.col("w")), "entropy"), r6(G.duplicate_or_empty(ngrams(F.col("w"), 2)), "repeated_pairs"))


@query("code_generic_score", "select doc_id, quality from labels where quality >= 1")
def _(spark, sf):
    return G.generic_score(table(spark, sf, "labels"), "quality", 1).select("doc_id", "quality")


@query("code_quality_score_band", "select doc_id, quality from labels where quality between 1 and 10")
def _(spark, sf):
    return G.quality_score_band(table(spark, sf, "labels"), "quality", 1, 10).select("doc_id", "quality")


@query("recipe_code", f"with {CODE} select page_id, visible as visible_text_length from c where {' and '.join(f'({t})' for t in CODE_TESTS.values())}")
def _(spark, sf):
    return G.code_filters(code_records(spark, sf)).select("page_id", "visible_text_length")
