"""Sources, sinks and the parse stage."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.language import CJK_SHARE, STOP_WORDS, detect_language, language_tag
from sluice.functions.text import CJK, TOKEN, contains_cjk, format_size, truncate
from sluice.operators import chunking
from sluice.plans.queries.registry import (
    ZH, query, rename_files, s_count, s_ratio, s_strip, scratch, table, zh_documents,
)
from sluice.sources import files, pages, sinks
from sluice.streaming import incremental

PART = """select p_partkey, p_name, case when p_size % 7 = 0 then null else p_brand end as p_brand, p_type, p_size from part"""


def _parts(spark, sf):
    part = table(spark, sf, "part")
    brand = F.when(F.col("p_size") % 7 != 0, F.col("p_brand"))
    return part.select("p_partkey", "p_name", brand.alias("p_brand"), "p_type", "p_size")


@query("source_csv_row_text", f"""
select p_partkey, concat_ws(' | ', 'p_name: ' || p_name, 'p_brand: ' || p_brand, 'p_type: ' || p_type,
  'p_size: ' || p_size) as content from ({PART})""")
def _(spark, sf):
    return files.table_rows(_parts(spark, sf), "p_partkey")


@query("source_csv_files", f"""
select concat_ws(' | ', 'p_partkey: ' || p_partkey, 'p_name: ' || p_name, 'p_brand: ' || p_brand, 'p_type: ' || p_type,
  'p_size: ' || p_size) as content, 'csv' as data_type from ({PART})""")
def _(spark, sf):
    folder = scratch(spark)
    _parts(spark, sf).write.csv(folder, header=True)
    return files.read_csv_rows(spark, folder).select("content", "data_type")


@query("source_csv_split_files", f"""
select concat_ws(' | ', 'p_partkey: ' || p_partkey, 'p_name: ' || p_name, 'p_brand: ' || p_brand, 'p_type: ' || p_type,
  'p_size: ' || p_size) as content, 'csv' as data_type from ({PART})""")
def _(spark, sf):
    folder = scratch(spark)
    _parts(spark, sf).write.csv(folder, header=True)
    return files.read_csv_rows(spark, folder, multi_line=False).select("content", "data_type")


TEXTS = """texts as (select source, string_agg(text, chr(10) order by doc_id) || chr(10) as body from documents group by source)"""


def _text_folder(spark, sf):
    folder = scratch(spark)
    docs = table(spark, sf, "documents").select("source", "doc_id", F.col("text").alias("value"))
    docs = docs.repartition("source").sortWithinPartitions("source", "doc_id")
    docs.select("source", "value").write.partitionBy("source").text(folder)
    return folder


def _folder_source(df):
    return df.withColumn("folder", F.regexp_extract("source.file_path", r"source=([^/]+)/", 1))


@query("source_text_files", f"""
with {TEXTS} select source as folder, md5({s_strip('body')}) as text_hash, length({s_strip('body')}) as n, 'text' as data_type
from texts where length({s_strip('body')}) >= 10""")
def _(spark, sf):
    df = _folder_source(files.read_text(spark, _text_folder(spark, sf)))
    return df.select("folder", F.md5("content").alias("text_hash"), F.length("content").alias("n"), "data_type")


@query("source_markdown_files", f"""
with {TEXTS} select source as folder, md5({s_strip('body')}) as text_hash, 'markdown' as data_type, '.md' as file_type
from texts where length({s_strip('body')}) >= 10""")
def _(spark, sf):
    folder = _text_folder(spark, sf)
    rename_files(spark, f"{folder}/*/*.txt", ".txt", ".md")
    df = _folder_source(files.read_markdown(spark, folder))
    return df.select("folder", F.md5("content").alias("text_hash"), "data_type", "source.file_type")


@query("source_accepted_formats", f"""
with {TEXTS} select source as folder, case when source in ('src2', 'src3', 'src4') then 'markdown' else 'text' end as data_type
from texts where length({s_strip('body')}) >= 10 and not starts_with(source, 'src1')""")
def _(spark, sf):
    """Files of accepted extensions only: those of some sources get one that no reader knows."""
    folder = _text_folder(spark, sf)
    rename_files(spark, f"{folder}/source=src1*/*.txt", ".txt", ".log")
    rename_files(spark, f"{folder}/source=src[2-4]/*.txt", ".txt", ".MD")
    return _folder_source(files.read_directory(spark, folder)).select("folder", "data_type")


@query("source_metadata", f"""
with {TEXTS} select source as folder, strlen(body) as file_size, '.txt' as file_type, md5(body) as hash_value, 'utf-8' as encoding from texts""")
def _(spark, sf):
    df = _folder_source(files.read_text(spark, _text_folder(spark, sf), min_length=0))
    return df.select("folder", "source.file_size", "source.file_type", "source.hash_value", "source.encoding")


@query("source_directory", f"""
with {TEXTS} select 'text' as data_type, count(*) as chunks from texts where length({s_strip('body')}) >= 10
union all select 'csv', count(*) from part""")
def _(spark, sf):
    folder = scratch(spark)
    docs = table(spark, sf, "documents").select("source", "doc_id", F.col("text").alias("value"))
    docs = docs.repartition("source").sortWithinPartitions("source", "doc_id")
    docs.select("source", "value").write.partitionBy("source").text(f"{folder}/a")
    _parts(spark, sf).write.csv(f"{folder}/b", header=True)
    return files.read_directory(spark, folder).groupBy("data_type").agg(F.count(F.lit(1)).alias("chunks"))


JSON_DOC = """named_struct('title', source, 'body', named_struct('text', text, 'tags', array(lang, md5(text))), 'n', n_chars)"""


@query("source_json_leaves", f"""
select doc_id, 'body.text' as json_path, md5({s_strip('text')}) as text_hash from documents where length({s_strip('text')}) >= 10
union all select doc_id, 'body.tags[1]', md5(md5(text)) from documents
union all select doc_id, 'title', md5(source) from documents where length(source) >= 10""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.expr(f"to_json({JSON_DOC})").alias("j"))
    out = files.json_leaves(docs, "j")
    return out.select("doc_id", "json_path", F.md5("content").alias("text_hash"))


@query("records_round_trip", "select doc_id, lang, md5(text) as text_hash, n_chars from documents")
def _(spark, sf):
    folder = scratch(spark)
    sinks.write_records(table(spark, sf, "documents"), folder, "jsonl")
    back = files.read_records(spark, folder, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return back.select("doc_id", "lang", F.md5("text").alias("text_hash"), "n_chars")


@query("source_json_array", "select doc_id, lang, md5(text) as text_hash from documents")
def _(spark, sf):
    """A hundred documents per file, each file one array."""
    folder = scratch(spark)
    docs = table(spark, sf, "documents").withColumn("part", F.floor(F.col("doc_id") / 100))
    arrays = docs.groupBy("part").agg(F.to_json(F.collect_list(F.struct("doc_id", "text", "lang"))).alias("value"))
    arrays.repartition("part").write.partitionBy("part").text(folder)
    back = files.read_records(spark, folder, "doc_id bigint, text string, lang string", fmt="json")
    return back.select("doc_id", "lang", F.md5("text").alias("text_hash"))


@query("stage_round_trip", "select doc_id, lang, source, md5(text) as text_hash from documents")
def _(spark, sf):
    kept = sinks.stage(table(spark, sf, "documents"), "documents", scratch(spark))
    return kept.select("doc_id", "lang", "source", F.md5("text").alias("text_hash"))


@query("sink_dataset", f"""
with {ZH} select count(*) as total_chunks, cast(sum(length(content)) as bigint) as total_characters,
  round(avg(length(content)), 6) as average_chunk_length, count(*) as type_text, 0 as type_pdf, count(*) as language_zh,
  0 as language_en, (select count(*) from conversations) as total_qa_pairs from zh""")
def _(spark, sf):
    chunks = zh_documents(spark, sf).withColumn("data_type", F.lit("text"))
    qa = table(spark, sf, "conversations")
    stats = sinks.write_dataset(chunks, qa, scratch(spark))
    return stats.select(
        "total_chunks", "total_characters", F.round("average_chunk_length", 6).alias("average_chunk_length"),
        "type_text", "type_pdf", "language_zh", "language_en", "total_qa_pairs",
    )


@query("quarantine_rows", f"""
select doc_id, case when length({s_strip('text')}) < 100 then 'failed' else 'good' end as route from documents""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    failure = F.when(~chunking.is_valid(F.col("text")) | (F.length(files.strip(F.col("text"))) < 100), "too short")
    good, bad = sinks.quarantine(docs, failure)
    return good.select("doc_id", F.lit("good").alias("route")).unionByName(bad.select("doc_id", F.lit("failed").alias("route")))


def _html_sql() -> str:
    x = "html"
    for pattern, replacement in pages.BLOCKS:
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')".replace("\n", "' || chr(10) || '")
    for name, char in {**pages.NAMED, "&amp;": "&"}.items():
        x = f"replace({x}, '{name}', '{char}')" if char != "'" else f"replace({x}, '{name}', '''')"
    for pattern, replacement in pages.TIDY:
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')".replace("\n", "' || chr(10) || '")
    return s_strip(x)


@query("source_html_pages", f"select page_id, url, {_html_sql()} as content from pages")
def _(spark, sf):
    return pages.html_to_text(table(spark, sf, "pages"))


@query("table_cells_text", f"""
with r as (select doc_id, list_transform(string_split(text, chr(10)), lambda l: array_to_string(string_split(l, ' '), ' | ')) as lines from documents)
select doc_id, array_to_string(list_filter(lines, lambda s: {s_strip('s')} <> ''), chr(10)) as content from r""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    cells = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    return docs.select("doc_id", files.table_to_text(cells).alias("content"))


@query("incremental_exact_dedup", "select distinct md5(text) as text_hash from documents")
def _(spark, sf):
    source, out, state = scratch(spark), scratch(spark), scratch(spark)
    docs = table(spark, sf, "documents")
    # Written as several files, so that copies arrive in different batches.
    docs.repartition(4, "doc_id").write.parquet(source)
    stream = incremental.stream_text(spark, source, docs.schema, files_per_batch=2)
    incremental.run_available(incremental.stream_exact_dedup(stream, "text"), out, state)
    return spark.read.schema(docs.schema).parquet(out).select(F.md5("text").alias("text_hash"))


# ---- parse stage ------------------------------------------------------------


@query("parse_min_length", f"select doc_id, n_chars from documents where length({s_strip('text')}) >= 10")
def _(spark, sf):
    return chunking.min_length(table(spark, sf, "documents"), "text").select("doc_id", "n_chars")


def _last(sep: str) -> str:
    n = len(sep)
    lit = sep.replace("\n", "' || chr(10) || '")
    rev = sep[::-1].replace("\n", "' || chr(10) || '")
    # Offset just behind the last separator that starts after the window start.
    return (f"case when strpos(reverse(w), '{rev}') > 0 and length(w) - strpos(reverse(w), '{rev}') - {n} + 1 > 0 "
            f"then length(w) - strpos(reverse(w), '{rev}') + 1 end")


_CUTS = ", ".join(_last(s) for s in chunking.SEPARATORS)


def _chunk_sql(size: int, overlap: int, base: str) -> str:
    return f"""
with recursive {base}, src as (select doc_id, {s_strip('content')} as t from base),
walk as (
  select doc_id, t, 0 as chunk_number, 0 as start,
    case when length(t) <= {size} then length(t) else (select coalesce({_CUTS}, {size}) from (select substr(t, 1, {size}) as w)) end as fin
  from src where length(t) > 0
  union all
  select doc_id, t, chunk_number + 1, nxt,
    case when length(t) <= nxt + {size} then length(t) else nxt + (select coalesce({_CUTS}, {size}) from (select substr(t, nxt + 1, {size}) as w)) end
  from (select *, case when fin - {overlap} > start then fin - {overlap} else fin end as nxt from walk where fin < length(t))
)
select doc_id, chunk_number, start, content, count(*) over (partition by doc_id) as total_chunks from (
  select doc_id, chunk_number, start, {s_strip('substr(t, start + 1, fin - start)')} as content from walk)
where length(content) >= 10"""


@query("chunk_overlapping", _chunk_sql(1000, 100, "base as (select doc_id, text as content from documents)"))
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    return chunking.chunk_text(docs)


@query("chunk_overlapping_zh", _chunk_sql(300, 50, f"{ZH}, base as (select doc_id, content from zh)"))
def _(spark, sf):
    docs = zh_documents(spark, sf).select("doc_id", "content")
    return chunking.chunk_text(docs, size=300, overlap=50)


@query("chunk_fixed_stride", """
with c as (select doc_id, text, unnest(range(0, greatest(length(text), 1), 900)) as start from documents where length(text) > 0)
select doc_id, cast(start / 900 as int) as chunk_number, start, substr(text, start + 1, 1000) as content
from c where start = 0 or start < length(text) - 100""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    return chunking.chunk_fixed(docs)


@query("chunk_numbering", f"""
with t as (select doc_id, len(regexp_extract_all(text, '{TOKEN}')) as k from documents)
select doc_id, unnest(range(0, cast(ceil(k / 128.0) as int))) as chunk_number, cast(ceil(k / 128.0) as int) as total_chunks from t where k > 0""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    pieces = chunking.chunk_tokens(docs, n=128).select("doc_id", "chunk_number")
    return chunking.number_chunks(pieces, "doc_id")


@query("chunk_by_tokens", f"""
with t as (select doc_id, regexp_extract_all(text, '{TOKEN}') as k from documents),
c as (select doc_id, k, unnest(range(0, greatest(len(k), 1), 512)) as p from t)
select doc_id, cast(p / 512 as int) as chunk_number, array_to_string(k[p + 1 : p + 512], ' ') as content from c
where array_to_string(k[p + 1 : p + 512], ' ') <> ''""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("content"))
    return chunking.chunk_tokens(docs)


def _language_sql(text: str) -> str:
    hits = {k: f"len(list_filter(words, lambda w: w in ({', '.join(repr(s) for s in stops)})))" for k, stops in STOP_WORDS.items()}
    top = f"greatest({', '.join(f'h_{k}' for k in hits)})"
    cases = " ".join(f"when h_{k} = {top} then '{k}'" for k in hits)
    return f"""(select *, case when share >= {CJK_SHARE} then 'zh' when {top} = 0 then 'unknown' {cases} end as detected from (
      select *, {', '.join(f'{h} as h_{k}' for k, h in hits.items())} from (
      select *, {s_ratio(s_count(text, f'[{CJK}]'), s_count(text, chr(92) + 'p{L}'))} as share,
        regexp_extract_all(lower({text}), '[{chr(92)}p{{L}}{chr(92)}p{{N}}_]+') as words from base)))"""


@query("language_detect", f"""
with base as (select doc_id, lang, text from documents)
select doc_id, lang, detected from {_language_sql('text')}""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", "lang", detect_language(F.col("text")).alias("detected"))


@query("language_tag", f"""
with {ZH}, base as (select doc_id, content from zh union all select -1 - doc_id, text from documents)
select doc_id, case when detected in ('zh', 'en') then detected else 'auto' end as language from {_language_sql('content')}""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select((F.lit(-1) - F.col("doc_id")).alias("doc_id"), F.col("text").alias("content"))
    both = zh_documents(spark, sf).select("doc_id", "content").unionByName(docs)
    return both.select("doc_id", language_tag(F.col("content")).alias("language"))


@query("contains_cjk", f"""
with {ZH} select doc_id, regexp_matches(content, '[{CJK}]')::int as derived, (doc_id % 3 = 0)::int as original from zh""")
def _(spark, sf):
    zh = zh_documents(spark, sf).select("doc_id", contains_cjk(F.col("content")).cast("int").alias("derived"))
    docs = table(spark, sf, "documents").select("doc_id", contains_cjk(F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("文"))).otherwise(F.col("text"))).cast("int").alias("original"))
    return zh.join(docs, "doc_id")


@query("non_empty_rows", f"select page_id, coalesce({s_strip('title')} <> '', false)::int as valid from (select page_id, case when page_id % 3 = 0 then chr(9) || ' ' when page_id % 3 = 1 then regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) end as title from pages)")
def _(spark, sf):
    title = F.when(F.col("page_id") % 3 == 0, "\t ").when(F.col("page_id") % 3 == 1, F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1))
    return table(spark, sf, "pages").select("page_id", chunking.is_valid(title).cast("int").alias("valid"))


@query("truncate_text", "select doc_id, case when length(text) > 100 then left(text, 97) || '...' else text end as short from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", truncate(F.col("text")).alias("short"))


@query("format_size", """
select l_orderkey, l_linenumber, l_partkey, case when s = 0 then '0B' when s < 1024 then printf('%.1f', s::double) || 'B'
  when s < 1048576 then printf('%.1f', s / 1024.0::double) || 'KB' when s < 1073741824 then printf('%.1f', s / 1048576.0::double) || 'MB'
  when s < 1099511627776 then printf('%.1f', s / 1073741824.0::double) || 'GB' else printf('%.1f', s / 1099511627776.0::double) || 'TB' end as size
from (select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as bigint) * l_partkey * l_partkey * l_suppkey as s from lineitem)""")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    size = F.col("l_quantity").cast("bigint") * F.col("l_partkey") * F.col("l_partkey") * F.col("l_suppkey")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", format_size(size).alias("size"))
