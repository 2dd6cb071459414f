"""Contamination, neighbours, trained scores, rollups, sketches, set audits, relations, and the event stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.text import WORD
from sluice.operators import contamination as C
from sluice.operators import neighbours as N
from sluice.operators import relational as R
from sluice.operators import relations, reports, scorer
from sluice.plans.queries.registry import query, r6, s_words, scratch, table
from sluice.streaming import counters
from sluice.streaming.incremental import stream_text

# ---- benchmark passages in documents ---------------------------------------------


def s_grams(table: str, key: str) -> str:
    words = f"select {key}, {s_words('lower(text)')} as w from {table}"
    grams = "list_transform(range(1, greatest(len(w) - 7, least(len(w), 1)) + 1), lambda i: array_to_string(w[i:i+7], ' '))"
    return f"select {key}, unnest(list_distinct({grams})) as gram from ({words})"


CONTAMINATION = f"""dg as ({s_grams('documents', 'doc_id')}), ig as ({s_grams('benchmark', 'item_id')}),
sizes as (select item_id, count(*) as grams from ig group by 1),
found as (select doc_id, item_id, count(*) as shared, count(*) / any_value(grams) as share
  from dg join ig using (gram) join sizes using (item_id) group by 1, 2)"""


def _contamination(spark, sf, **options):
    return C.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "item_id", **options)


@query("benchmark_contamination", f"with {CONTAMINATION} select doc_id, item_id, shared, round(share, 6) as share from found")
def _(spark, sf):
    return _contamination(spark, sf).select("doc_id", "item_id", "shared", r6(F.col("share"), "share"))


@query("benchmark_contamination_by_shuffle", f"with {CONTAMINATION} select doc_id, item_id, shared, round(share, 6) as share from found")
def _(spark, sf):
    # The form for item tables of any size.
    return _contamination(spark, sf, broadcast_grams=0).select("doc_id", "item_id", "shared", r6(F.col("share"), "share"))


@query("documents_without_benchmark", f"""
with {CONTAMINATION} select doc_id, lang, source from documents where doc_id not in (select doc_id from found where share > 0.5)""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return C.clean_documents(docs, _contamination(spark, sf), "doc_id").select("doc_id", "lang", "source")


# ---- neighbours ------------------------------------------------------------------


@query("top_k_neighbours", """
with q as (select vec_id, embedding::double[] as v from embeddings where vec_id % 50 = 0),
s as (select q.vec_id, e.vec_id as neighbour, round(list_inner_product(q.v, e.embedding::double[]), 9) as score
  from q join embeddings e on e.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by vec_id order by score desc, neighbour) as rank from s)
select vec_id, rank, neighbour, round(score, 6) as score from r where rank <= 10""")
def _(spark, sf):
    # Every fiftieth row asks, all rows answer.
    out = N.top_k_neighbours(table(spark, sf, "embeddings"), "vec_id", "embedding", 10, F.col("vec_id") % 50 == 0)
    return out.select("vec_id", "rank", "neighbour", r6(F.col("score"), "score"))


@query("approximate_neighbours")
def _(spark, sf):
    # All rows ask, all rows answer.
    out = N.approximate_neighbours(table(spark, sf, "embeddings"), "vec_id", "embedding", 10)
    return out.select("vec_id", "rank", "neighbour", r6(F.col("score"), "score"))


# ---- trained scores --------------------------------------------------------------


@query("trained_quality_score")
def _(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = scorer.train_scorer(docs, labels, "doc_id", "text", "quality")
    return scorer.score_texts(model, docs.select("doc_id", "text"), "text", "quality").select("doc_id", "quality")


# ---- rollups, sketches, set audits -----------------------------------------------

EDGES = [100, 1000, 10_000]
BAND_SQL = " + ".join(f"(length(text) >= {e})::int" for e in EDGES)


@query("rollup_source_language_band", f"""
with d as (select source, lang, {BAND_SQL} as band, length(text) as n from documents)
select source, lang, band, grouping(source, lang, band)::int as grouping, count(*) as rows, coalesce(sum(n), 0)::bigint as characters,
  round(avg(n), 6) as mean_length
from d group by grouping sets ((source, lang, band), (source, lang), (source), (lang), ())""")
def _(spark, sf):
    docs = table(spark, sf, "documents").withColumn("band", reports.length_band(F.col("text"), EDGES))
    keys = ["source", "lang", "band"]
    out = reports.rollups(docs, keys, [keys, keys[:2], keys[:1], ["lang"], []])
    return out.withColumn("mean_length", F.round("mean_length", 6))


@query("vocabulary_within_error", f"""
with w as (select source, unnest({s_words('lower(text)')}) as w from documents)
select source, count(*) as words, true as within from w group by 1
union all select 'all', count(*), true from w""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    sketches = reports.vocabulary_sketches(docs, "source", "text", WORD)
    whole = reports.united(sketches).withColumn("source", F.lit("all"))
    found = reports.estimated(sketches.unionByName(whole))
    # The exact numbers, to hold the estimates against: four standard errors.
    words = docs.select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))).alias("w")).distinct()
    exact = words.groupBy("source").agg(F.count(F.lit(1)).alias("exact")).unionByName(
        words.agg(F.count_distinct("w").alias("exact")).withColumn("source", F.lit("all"))
    )
    error = F.abs(F.col("distinct_words") / F.col("exact") - 1)
    return found.join(exact, "source").select("source", "words", (error < 4 * 1.04 / 2**7).alias("within"))


@query("split_audit", """
with whole as (select text, lang, source from documents union all select text, lang, source from documents where n_chars > 500),
train as (select distinct text, lang, source from (select * from documents where doc_id % 2 = 0
  union all select * from documents where doc_id % 2 = 0 and n_chars > 500)),
test as (select text, lang, source from documents where doc_id % 2 = 1
  union all select text, lang, source from documents where doc_id % 2 = 1 and n_chars > 500),
parts as (select * from train union all select * from test)
select 'lost' as finding, count(*) as rows from (select * from whole except all select * from parts)
union all select 'added', count(*) from (select * from parts except all select * from whole)
union all select 'leaked test train', count(*) from (select * from test intersect all select * from train)""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    columns = ["text", "lang", "source"]
    # Long documents come twice, and one part of the split has lost its copies.
    whole = docs.unionAll(docs.filter("n_chars > 500"))
    parts = {"train": whole.filter("doc_id % 2 = 0").select(*columns).distinct(), "test": whole.filter("doc_id % 2 = 1")}
    return R.audit_split(whole, parts, columns)


# ---- relations -------------------------------------------------------------------

RELATIONS = """edges as (
  select 'S' || s_suppkey as subject, 'N' || s_nationkey as object from supplier
  union all select 'C' || c_custkey, 'N' || c_nationkey from customer
  union all select 'N' || n_nationkey, 'R' || n_regionkey from nation
  union all select 'R' || n_regionkey, 'N' || n_nationkey from nation)"""


@query("related_entities", f"""
with recursive {RELATIONS},
walk as (select distinct subject as start, subject as entity, 0 as hops from edges where subject[1] in ('S', 'C')
  union select w.start, e.object, w.hops + 1 from walk w join edges e on e.subject = w.entity where w.hops < 6)
select start, entity, min(hops)::int as hops from walk group by 1, 2""")
def _(spark, sf):
    def edge(name, a, left, b, right):
        return table(spark, sf, name).select(F.concat(F.lit(a), left).alias("subject"), F.concat(F.lit(b), right).alias("object"))

    # Nations and their regions point at each other, so walks run in circles.
    edges = R.concat_tables(
        edge("supplier", "S", "s_suppkey", "N", "s_nationkey"), edge("customer", "C", "c_custkey", "N", "c_nationkey"),
        edge("nation", "N", "n_nationkey", "R", "n_regionkey"), edge("nation", "R", "n_regionkey", "N", "n_nationkey"),
    )
    starts = edges.filter(F.substring("subject", 1, 1).isin("S", "C")).select(F.col("subject").alias("start"))
    return relations.related_entities(starts, edges)


# ---- the event stream ------------------------------------------------------------

STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
S_STAMP = "%Y-%m-%d %H:%M:%S.%f"


def arrive(spark, sf, parts):
    """Folders for a stream, and the parts of ``events`` to put there one after the other."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    folder = scratch(spark)
    return events, folder, [events.filter(p) for p in parts]


@query("stage_counters", f"""
select strftime(time_bucket(interval 1 hour, ts), '{S_STAMP}') as start, event_type, count(*) as rows, round(sum(value), 6) as total,
  min(value) as least, max(value) as most from events group by 1, 2""")
def _(spark, sf):
    days = [F.dayofmonth("ts") <= 10, F.dayofmonth("ts").between(11, 20), F.dayofmonth("ts") > 20]
    events, folder, parts = arrive(spark, sf, days)
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = stream_text(spark, f"{folder}/in", events.schema)
        counters.run_counters(counters.stage_counters(stream, "ts", "event_type", "value"), f"{folder}/out", f"{folder}/state")
    out = counters.latest_counters(spark, f"{folder}/out", ["start", "end", "event_type"])
    return out.select(F.date_format("start", STAMP).alias("start"), "event_type", "rows", r6(F.col("total"), "total"), "least", "most")


LATE = """seen as (select *, event_id % 10 = 0 and ts < (select max(ts) from events where event_id % 10 <> 0) - interval 10 minute as late from events)"""


def _delivered(spark, sf):
    """Nine events of ten first, the rest after them: most of those come too late."""
    events, folder, parts = arrive(spark, sf, [F.col("event_id") % 10 != 0, F.col("event_id") % 10 == 0])
    for part in parts:
        part.write.mode("append").parquet(f"{folder}/in")
        stream = stream_text(spark, f"{folder}/in", events.schema)
        counters.split_late(stream, "ts", f"{folder}/out", f"{folder}/late", f"{folder}/state")
    return spark.read.parquet(f"{folder}/out"), spark.read.parquet(f"{folder}/late")


@query("late_events", f"""
with {LATE} select event_type, count(*) filter (not late) as in_time, count(*) filter (late) as late from seen group by 1""")
def _(spark, sf):
    found, late = _delivered(spark, sf)
    rows = found.withColumn("late", F.lit(False)).unionByName(late.withColumn("late", F.lit(True)))
    return rows.groupBy("event_type").agg(F.count_if(~F.col("late")).alias("in_time"), F.count_if(F.col("late")).alias("late"))


@query("event_sessions", f"""
with {LATE}, steps as (select user_id, ts, coalesce(ts > lag(ts) over same + interval 30 minute, true)::int as begins
  from seen where not late window same as (partition by user_id order by ts)),
numbered as (select *, sum(begins) over (partition by user_id order by ts rows unbounded preceding) as session from steps)
select user_id, strftime(min(ts), '{S_STAMP}') as start, strftime(max(ts), '{S_STAMP}') as last, count(*) as rows
from numbered group by user_id, session""")
def _(spark, sf):
    found, _ = _delivered(spark, sf)
    out = counters.sessions(found, "ts", "user_id")
    return out.select("user_id", F.date_format("start", STAMP).alias("start"), F.date_format("last", STAMP).alias("last"), "rows")
