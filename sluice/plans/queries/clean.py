"""Cleaning and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions import values as V
from sluice.functions.language import STOP_WORDS
from sluice.functions.text import BLANK, CJK, DIGIT
from sluice.operators import cleaning as C
from sluice.operators import dedup
from sluice.plans.queries.registry import (
    ZH, query, r6, s_ratio, s_strip, s_words, table, zh_documents,
)
from sluice.session import durable


def s_rules(x: str, rules) -> str:
    for pattern, replacement in rules:
        replacement = replacement.replace("$1", r"\1").replace("$2", r"\2")
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')"
    return x


def s_blanks(x: str) -> str:
    return f"regexp_replace({x}, '[{BLANK}]+', ' ', 'g')"


def s_newlines(x: str) -> str:
    return rf"regexp_replace({x}, '\r\n?', chr(10), 'g')"


def s_ascii(x: str) -> str:
    return f"case when regexp_matches({x}, '[{CJK}]') then translate({x}, '{V.FULL_WIDTH}', '{V.ASCII_FORM}') else {x} end"


def s_trim(x: str) -> str:
    x = rf"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = rf"regexp_replace({x}, '\n[ \t]+', chr(10), 'g')"
    return s_strip(rf"regexp_replace({x}, '[ \t]+\n', chr(10), 'g')")


def s_basic(x: str) -> str:
    """Subquery-free basic cleaning; ``x`` is repeated only inside cheap tests."""
    y = s_rules(s_rules(s_blanks(s_newlines(x)), C.MARKUP), C.TAIL)
    # The punctuation step looks at its input twice: bind it through a list.
    return s_trim(f"list_transform([{y}], lambda t: {s_ascii('t')})[1]")


FIXES = [
    (r" +([.,;:!?])", "$1"), (r"([.,;:!?]) +", "$1 "), (rf"({DIGIT}),({DIGIT}{{3}})", "$1$2"),
    (rf"\([{BLANK}]*", "("), (rf"[{BLANK}]*\)", ")"),
]


def s_fix(x: str) -> str:
    return s_rules(x, FIXES)


def s_gate(x: str) -> str:
    d = f"len(list_distinct(string_split({x}, '')))"
    return (f"(length({s_strip(x)}) >= 10 and not ({d} < 5 and length({x}) > 20) and "
            f"(regexp_matches({x}, '[{V.GATE_CHARACTERS}]') or (length({x}) > 100 and {d} > 30)))")


BOTH = f"""{ZH}, both_texts as (select doc_id, content from zh union all select -1 - doc_id, text from documents)"""


def both(spark, sf):
    docs = table(spark, sf, "documents").select((F.lit(-1) - F.col("doc_id")).alias("doc_id"), F.col("text").alias("content"))
    return zh_documents(spark, sf).select("doc_id", "content").unionByName(docs)


@query("clean_newlines", f"select doc_id, {s_newlines('replace(text, chr(10), chr(13) || chr(10))')} as cleaned from documents")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", C.normalize_newlines(F.regexp_replace("text", "\n", "\r\n")).alias("cleaned"))


@query("clean_strip_markup", f"""
select page_id, {s_rules('html', C.MARKUP)} as cleaned, {s_rules("url || ' a.b@' || regexp_extract(url, '//([^/]+)', 1) || ' x'", C.MARKUP)} as link_cleaned from pages""")
def _(spark, sf):
    p = table(spark, sf, "pages")
    link = F.concat("url", F.lit(" a.b@"), F.regexp_extract("url", "//([^/]+)", 1), F.lit(" x"))
    return p.select("page_id", C.strip_markup(F.col("html")).alias("cleaned"), C.strip_markup(link).alias("link_cleaned"))


@query("clean_collapse", f"with {BOTH} select doc_id, {s_rules(s_blanks('content'), C.TAIL)} as cleaned from both_texts")
def _(spark, sf):
    return both(spark, sf).select("doc_id", C.collapse_marks(C.collapse_blanks(F.col("content"))).alias("cleaned"))


@query("clean_ascii_punctuation", f"with {BOTH} select doc_id, {s_ascii('content')} as cleaned from both_texts")
def _(spark, sf):
    return both(spark, sf).select("doc_id", C.ascii_punct(F.col("content")).alias("cleaned"))


@query("clean_trim_blanks", f"with {BOTH} select doc_id, {s_trim('content')} as cleaned from both_texts")
def _(spark, sf):
    return both(spark, sf).select("doc_id", C.trim_ws(F.col("content")).alias("cleaned"))


def _longest_first(words):
    return sorted(words, key=lambda w: (-len(w), w))


def s_marked(x: str, words) -> str:
    return rf"regexp_replace({x}, '({'|'.join(_longest_first(words))})', chr(1) || '\1' || chr(1), 'g')"


def s_cjk_tokens(x: str) -> str:
    pieces = f"regexp_extract_all({s_marked(x, V.PROTECTED_TERMS)}, '[{CJK}]+|[a-zA-Z]+|{DIGIT}+|[^\\x{{01}}]')"
    kept = ", ".join(f"'{w}'" for w in [*V.PROTECTED_TERMS, *V.KEPT_MARKS])
    return f"array_to_string(list_filter({pieces}, lambda w: length(w) > 1 or w in ({kept})), '')"


@query("clean_cjk_tokens", f"with {ZH} select doc_id, {s_cjk_tokens('content')} as cleaned from zh")
def _(spark, sf):
    return zh_documents(spark, sf).select("doc_id", C.filter_cjk_tokens(F.col("content")).alias("cleaned"))


def s_en_tokens(x: str) -> str:
    stops = ", ".join(f"'{w}'" for w in STOP_WORDS["en"])
    return (rf"array_to_string(list_filter(regexp_extract_all({x}, '[\p{{L}}\p{{N}}_'']+'), "
            f"lambda w: lower(w) not in ({stops})), ' ')")


@query("clean_stop_words", f"select doc_id, {s_en_tokens('text')} as cleaned from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", C.filter_en_tokens(F.col("text"), STOP_WORDS["en"]).alias("cleaned"))


@query("clean_special_characters", rf"""
with {BOTH} select doc_id, regexp_replace(content, '[^{CJK}\x{{3400}}-\x{{4DBF}}\p{{L}}\p{{N}}_{BLANK}.,;:!?()\[\]{{}}"''-]', '', 'g') as cleaned from both_texts""")
def _(spark, sf):
    return both(spark, sf).select("doc_id", C.strip_special(F.col("content")).alias("cleaned"))


@query("clean_common_errors", f"with {BOTH} select doc_id, {s_fix('content')} as cleaned from both_texts")
def _(spark, sf):
    return both(spark, sf).select("doc_id", C.fix_common(F.col("content")).alias("cleaned"))


@query("clean_quality_gate", f"with {BOTH} select doc_id, {s_gate('content')}::int as passed from both_texts")
def _(spark, sf):
    return both(spark, sf).select("doc_id", C.quality_gate(F.col("content")).cast("int").alias("passed"))


CLEANED = f"""{BOTH}, cleaned as (select doc_id, content, case when {s_strip('content')} = '' then content else {s_fix(s_basic('content'))} end as cleaned from both_texts),
gated as (select *, {s_gate('cleaned')} as passed from cleaned)"""


@query("clean_whole", f"""
with {CLEANED} select doc_id, cleaned, passed::int as passed_gate, length(content) as original_length, length(cleaned) as cleaned_length,
  round({s_ratio('length(cleaned)', 'length(content)')}, 6) as cleaning_ratio from gated""")
def _(spark, sf):
    out = C.clean(both(spark, sf), "content")
    return out.select("doc_id", "cleaned", F.col("passed_gate").cast("int").alias("passed_gate"),
                      "original_length", "cleaned_length", r6(F.col("cleaning_ratio"), "cleaning_ratio"))


@query("clean_routed_tokens", f"""
with {BOTH}, b as (select doc_id, {s_basic('content')} as t, content from both_texts)
select doc_id, case when {s_strip('content')} = '' then content else {s_fix(f"case when regexp_matches(t, '[{CJK}]') then {s_cjk_tokens('t')} else {s_en_tokens('t')} end")} end as cleaned from b""")
def _(spark, sf):
    out = C.clean(both(spark, sf), "content", protected=V.PROTECTED_TERMS, stop_words=STOP_WORDS["en"])
    return out.select("doc_id", "cleaned")


def _marked(spark, sf):
    out = durable(C.clean(both(spark, sf), "content"))
    good = out.filter("passed_gate")
    copies = dedup.exact_duplicates(good, "cleaned", "doc_id").filter("is_duplicate").select("doc_id", F.lit(True).alias("is_duplicate"))
    out = out.join(copies, "doc_id", "left").withColumn("is_duplicate", F.coalesce("is_duplicate", F.lit(False)))
    return C.mark_status(out, "is_duplicate")


MARKED = f"""{CLEANED}, marked as (select *, case when passed and row_number() over (partition by passed, md5(cleaned) order by doc_id) > 1
  then 'skipped' else 'completed' end as status from gated)"""


@query("clean_status", f"""
with {MARKED} select doc_id, status, case when status = 'skipped' then '{V.DUPLICATE_REASON}' end as skip_reason,
  md5(case when passed and status = 'completed' then cleaned else content end) as content_hash from marked""")
def _(spark, sf):
    out = C.final_content(_marked(spark, sf))
    return out.select("doc_id", "status", "skip_reason", F.md5("content").alias("content_hash"))


@query("clean_statistics", f"""
with {MARKED} select count(distinct md5(cleaned)) as duplicate_hashes, count(*) filter (status = 'completed') as contents_stored,
  {len(V.PROTECTED_TERMS)} as protected_terms from marked""")
def _(spark, sf):
    return C.cleaning_stats(_marked(spark, sf))


@query("clean_extend_protected", """
select distinct w as term from (select p_brand as w from part union all select unnest(string_split(p_name, ' ')) from part)""")
def _(spark, sf):
    part = table(spark, sf, "part")
    new = part.select(F.explode(F.split("p_name", " ")).alias("term"))
    return C.extend_protected(part.select(F.col("p_brand").alias("term")).distinct(), new)


# ---- duplicates -------------------------------------------------------------


@query("dedup_exact", "select min(doc_id) as doc_id, md5(text) as text_hash from documents group by md5(text)")
def _(spark, sf):
    return dedup.exact_dedup(table(spark, sf, "documents"), "text", "doc_id").select("doc_id", F.md5("text").alias("text_hash"))


@query("dedup_charset", """
with recursive s as (select row_number() over (order by doc_id) as i, doc_id, lang, source,
    list_distinct(string_split(lower(text), '')) as c from documents where length(text) > 0),
walk as (
  select 0::bigint as i, []::varchar[][] as kept, null::bigint as doc_id, null::varchar as lang, null::varchar as source, false as stays
  union all
  select i, case when near then kept else list_append(kept, c) end, doc_id, lang, source, not near from (
    select s.*, w.kept, len(list_filter(w.kept, lambda k: len(list_intersect(k, s.c))::double
      / (len(k) + len(s.c) - len(list_intersect(k, s.c))) > 0.85::double)) > 0 as near
    from walk w join s on s.i = w.i + 1))
select doc_id, lang, source from walk where stays""")
def _(spark, sf):
    return dedup.charset_dedup(table(spark, sf, "documents"), "text", "doc_id").select("doc_id", "lang", "source")


SHINGLES = f"""words as (select doc_id, text, {s_words('lower(text)')} as w from documents),
grams as (select doc_id, list_distinct(case when len(w) < 5 then [lower(text)]
  else list_transform(range(1, len(w) - 3), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4]) end) as g from words),
flat as (select doc_id, len(g) as n, unnest(g) as k from grams),
pairs as (select a.doc_id, b.doc_id as earlier from flat a join flat b on a.k = b.k and b.doc_id < a.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having count(*)::double / (a.n + b.n - count(*)) >= 0.9)"""


@query("dedup_minhash", f"""
with {SHINGLES} select doc_id, lang, source from documents where doc_id not in (select doc_id from pairs)""")
def _(spark, sf):
    return dedup.minhash_dedup(table(spark, sf, "documents"), "text", "doc_id").select("doc_id", "lang", "source")


@query("dedup_minhash_label", f"""
with {SHINGLES} select doc_id, (doc_id not in (select doc_id from pairs))::int as minhash_label from documents""")
def _(spark, sf):
    return dedup.minhash_label(table(spark, sf, "documents"), "text", "doc_id").select("doc_id", "minhash_label")


@query("distinct_melted_values", """
select distinct v as value from (select p_brand as v from part union all select p_type from part union all
  select case when p_size > 10 then p_name end from part) where v is not null""")
def _(spark, sf):
    part = table(spark, sf, "part").withColumn("big", F.when(F.col("p_size") > 10, F.col("p_name")))
    return dedup.distinct_values(part, ["p_brand", "p_type", "big"])
