"""Registered queries of the corpus operators, with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.functions.text import let
from sluice.llm import bpe, cotraining, exact_dedup, maskedlm, packing, pages, quotes, repeats, repetition, runs, simhash
from sluice.llm import sketch, spectrum
from sluice.session import durable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def vocabulary() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_exact_dedup", """
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from (
  select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
         sha256(coalesce(text, '')) as text_sha256
  from documents window same as (partition by coalesce(text, '')))""")
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), "text", "doc_id")


@query("op4_bpe_trie")
def op4_bpe_trie(spark, sf_dir):
    coded = bpe.encode(table(spark, sf_dir, "documents"), "text", "doc_id", vocabulary(), round_trip=True)
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_sum_of_squares_packing")
def op6_sum_of_squares_packing(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Documents packed into sequences of 2048 tokens, with a checksum of each piece's ids."""
    cut = packing.pieces(docs, "text", "doc_id", vocabulary())
    cut = cut.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(cut, "length", ["doc_id", "piece"])


@query("op2_repetition_coverage")
def op2_repetition_coverage(spark, sf_dir):
    return repetition.repetition(table(spark, sf_dir, "documents"), "text", "doc_id")


@query("op10_simhash_near_duplicates")
def op10_simhash_near_duplicates(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), "text", "doc_id")


@query("op8_interval_tree_repeats")
def op8_interval_tree_repeats(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs, "text", "doc_id").select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op9_nearest_url_differencing")
def op9_nearest_url_differencing(spark, sf_dir):
    found = pages.main_text(table(spark, sf_dir, "pages"), "html", "url", "page_id")
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_shared")


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn as a mail that answers the turn before and quotes it, with what that one quoted."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    before = Window.partitionBy("conv_id").orderBy("turn")

    def quote(text, mark: str):
        return F.concat(F.lit(mark), F.regexp_replace(text, "\n", f"\n{mark}"))

    one, two = F.lag("text", 1).over(before), F.lag("text", 2).over(before)
    quoted = F.concat(F.lit("\n\nOn that turn they wrote:\n"), quote(one, "> "))
    older = F.concat(F.lit("\n> On that turn they wrote:\n"), quote(two, "> > "))
    text = F.concat("text", F.coalesce(quoted, F.lit("")), F.coalesce(older, F.lit("")))
    return turns.select("conv_id", "turn", text.alias("mail"))


@query("op1_quotation_linking", r"""
with recursive turns as (
  select conv_id, turn, trim(coalesce(text, ''), chr(10) || chr(13) || chr(9) || ' ') as text,
         lag(coalesce(text, '')) over (partition by conv_id order by turn) as quoted,
         lag(coalesce(text, ''), 2) over (partition by conv_id order by turn) as older
  from conversations),
says as (
  select distinct conv_id, turn, trim(regexp_replace(lower(part), '\s+', ' ', 'g')) as said
  from turns, unnest(list_concat([text], regexp_split_to_array(text, '
\s*
'))) as t(part)),
quotes as (
  select conv_id, turn, 1 as level, quoted as body from turns where quoted is not null
  union all select conv_id, turn, 2, older from turns where older is not null),
parts as (
  select conv_id, turn, level, 0 as rank, trim(regexp_replace(lower(body), '\s+', ' ', 'g')) as said from quotes
  union all
  select conv_id, turn, level, 1, trim(regexp_replace(lower(part), '\s+', ' ', 'g'))
  from quotes, unnest(regexp_split_to_array(body, '
\s*
')) as t(part)),
sayers as (
  select p.conv_id, p.turn, level, rank, max(s.turn) as sayer
  from parts p join says s on p.conv_id = s.conv_id and p.said = s.said and p.said <> '' and s.turn < p.turn
  group by p.conv_id, p.turn, level, rank, p.said),
linked as (
  select conv_id, turn, min((level, rank, -sayer)) as best, count(distinct level) as n_linked from sayers group by all),
mail as (
  select t.conv_id, t.turn, t.text, -l.best[3] as parent, coalesce(n_linked, 0) as n_linked,
         (trim(coalesce(quoted, ''), chr(10) || chr(13) || chr(9) || ' ') <> '')::bigint
           + (trim(coalesce(older, ''), chr(10) || chr(13) || chr(9) || ' ') <> '')::bigint as n_quotes
  from turns t left join linked l using (conv_id, turn)),
chain as (
  select conv_id, turn as leaf, turn, parent, text, n_quotes, n_linked from mail m
  where not exists (select 1 from mail c where c.conv_id = m.conv_id and c.parent = m.turn)
  union all
  select c.conv_id, c.leaf, m.turn, m.parent, m.text, m.n_quotes, m.n_linked
  from chain c join mail m on m.conv_id = c.conv_id and m.turn = c.parent)
select conv_id, leaf as leaf_id, min(turn) as root_id, count(*) as n_messages,
       sum(n_quotes)::bigint as n_quotes, sum(n_linked)::bigint as n_linked,
       string_agg(text, chr(10) || chr(10) order by turn) as conversation
from chain group by conv_id, leaf""")
def op1_quotation_linking(spark, sf_dir):
    linked = durable(quotes.link_quotes(mails(spark, sf_dir), "mail", "turn", ["conv_id"]))
    said = quotes.conversation_rows(linked, "turn", ["conv_id"])
    # The whole text of a conversation is one cell, because that cell is the result.
    built = said.groupBy("conv_id", "leaf_id").agg(
        F.min("turn").alias("root_id"), F.count("*").alias("n_messages"),
        F.sum("n_quotes").alias("n_quotes"), F.sum("n_linked").alias("n_linked"),
        F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("messages"),
    )
    return built.select(
        "conv_id", "leaf_id", "root_id", "n_messages", "n_quotes", "n_linked",
        F.array_join("messages.text", "\n\n").alias("conversation"),
    )


@query("op5_masked_pseudo_likelihood")
def op5_masked_pseudo_likelihood(spark, sf_dir):
    return maskedlm.fit_and_score(table(spark, sf_dir, "documents"), "text", "doc_id")


@query("op3_cotraining_quality")
def op3_cotraining_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    columns = cotraining.Columns("text", "doc_id", ["lang", "source"], ["n_chars"])
    scores = cotraining.cotrain(docs, labels, columns, ["quality", "toxic"])
    return scores.withColumn("kept", (F.col("quality_score") >= 0.5) & (F.col("toxic_score") < 0.5))


def with_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents; in one of ten, picked by the checksum of its id, a tail of words repeats its first few."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # A null id has no checksum and keeps its text.
    h = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))

    def changed(words: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (F.floor((n - a) / (3 + g % 8)) + 1).cast("int")
        tail = F.transform(F.sequence(a, n - 1), lambda i: F.get(words, a + (i - a) % p))
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, 1, a), tail), " ")).otherwise("")

    periodic = let(F.array_remove(F.split("text", sketch.SPACE), ""), changed)
    return docs.select("doc_id", F.when(h % 10 == 0, periodic).otherwise(F.col("text")).alias("text"))


@query("op11_block_convolution_runs")
def op11_block_convolution_runs(spark, sf_dir):
    found = runs.periodic_runs(with_periods(spark, sf_dir), "text", "doc_id")
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    # Lengths in periods are compared as fractions; of equal ones the first in order stays.
    best = F.reduce(
        "runs", nothing,
        lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b),
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


@query("op12_threshold_sketch", r"""
with docs as (select distinct doc_id, coalesce(text, '') as text from documents),
follow as (
  select doc_id, text, coalesce(lead(text) over in_order, first_value(text) over in_order) as after
  from docs window in_order as (order by doc_id nulls first, md5(coalesce(doc_id::varchar, '') || '|' || text) rows between unbounded preceding and unbounded following)),
edit as (
  select doc_id, text, after,
         left(text, (length(text) - length(text) // 2)::int) || left(after, (length(text) // 2)::int) as edited
  from follow),
words as (
  select doc_id, text, edited, regexp_extract_all(text, '[^ 	-
]+') as w,
         regexp_extract_all(edited, '[^ 	-
]+') as e, regexp_extract_all(after, '[^ 	-
]+') as a
  from edit),
hashes as (
  select doc_id, text, edited,
         list_transform(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1), lambda i: md5(array_to_string(w[i:i+4], ' '))) as w,
         list_transform(range(1, greatest(len(e) - 4, least(len(e), 1)) + 1), lambda i: md5(array_to_string(e[i:i+4], ' '))) as e,
         list_transform(range(1, greatest(len(a) - 4, least(len(a), 1)) + 1), lambda i: md5(array_to_string(a[i:i+4], ' '))) as a
  from words),
kept as (
  select doc_id, text, edited,
         case when list_min(w) < '2' then list_filter(w, lambda h: h < '2') else list_sort(w)[1:1] end as w,
         case when list_min(e) < '2' then list_filter(e, lambda h: h < '2') else list_sort(e)[1:1] end as e,
         case when list_min(a) < '2' then list_filter(a, lambda h: h < '2') else list_sort(a)[1:1] end as a
  from hashes),
sketches as (
  select doc_id, text, edited,
         list_sort(list_distinct(list_transform(w, lambda h: left(h, 16)))) as w,
         list_sort(list_distinct(list_transform(e, lambda h: left(h, 16)))) as e,
         list_sort(list_distinct(list_transform(a, lambda h: left(h, 16)))) as a
  from kept)
select doc_id, length(text) as n_chars, sha256(edited) as edited_sha256,
       array_to_string(w, '') as fingerprint, array_to_string(e, '') as edited_fingerprint,
       case when least(len(w), len(e)) > 0 then len(list_intersect(w, e)) / least(len(w), len(e))
            else (len(w) = len(e))::int::double end as near_edited,
       case when least(len(w), len(a)) > 0 then len(list_intersect(w, a)) / least(len(w), len(a))
            else (len(w) = len(a))::int::double end as near_next
from sketches""")
def op12_threshold_sketch(spark, sf_dir):
    found = sketch.edited_pairs(table(spark, sf_dir, "documents"), "text", "doc_id")
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("hashes", "").alias("fingerprint"), F.array_join("edited_hashes", "").alias("edited_fingerprint"),
        sketch.likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        sketch.likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
    )


@query("op13_incremental_whitening")
def op13_incremental_whitening(spark, sf_dir):
    found = spectrum.whiten(table(spark, sf_dir, "embeddings"), "embedding", "vec_id")
    # A sum beyond a long has no place in this result.
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
