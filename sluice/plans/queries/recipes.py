"""Table steps, similarity, answer checks, SQL corpora and the model-call pattern.

A model is stood in for by a deterministic function of the prompt, so that the
data work around the call can be compared with SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.text import BLANK, TOKEN, WORD_CHARS
from sluice.operators import modelstage as M
from sluice.operators import reasoning as A
from sluice.operators import relational as R
from sluice.operators import reports
from sluice.operators import similarity as N
from sluice.operators import sqlcorpus as Q
from sluice.plans import recipes
from sluice.plans.queries.registry import query, r6, s_count, s_strip, table
from sluice.session import durable

# ---- relational steps -------------------------------------------------------


@query("general_filter", "select doc_id, quality, toxic from labels where quality > 0 and toxic < 1")
def _(spark, sf):
    return R.general_filter(table(spark, sf, "labels"), F.col("quality") > 0, F.col("toxic") < 1)


@query("table_steps", """
select lang, count(*) as n, max(n_chars) as longest from (select lang, n_chars from documents where n_chars > 500) group by lang""")
def _(spark, sf):
    return R.table_steps(
        table(spark, sf, "documents"), lambda d: d.filter("n_chars > 500"),
        lambda d: d.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.max("n_chars").alias("longest")))


@query("pack_row", "select n_nationkey, n_name || '#' || n_regionkey as packed from nation")
def _(spark, sf):
    packed = R.pack_row(table(spark, sf, "nation"), "row")
    return packed.select("row.n_nationkey", F.concat_ws("#", "row.n_name", F.col("row.n_regionkey").cast("string")).alias("packed"))


SCORE = "n_chars % 6"


@query("route_bands", f"""
select doc_id, case when {SCORE} > 3 then 'rewrite' else 'refine' end as route from documents where {SCORE} > 1""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", (F.col("n_chars") % 6).alias("score"))
    refine, rewrite = R.route_bands(docs, "score")
    return refine.select("doc_id", F.lit("refine").alias("route")).unionByName(rewrite.select("doc_id", F.lit("rewrite").alias("route")))


@query("concat_unlike_tables", """
select doc_id, lang, null::int as quality from documents union all select doc_id, null, quality from labels""")
def _(spark, sf):
    return R.concat_tables(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels").select("doc_id", "quality"))


MELT = """q as (select 'Q ' || lang as question, case when doc_id % 3 = 0 then 'A ' || source end as seq_question_0, 'B ' || lang as par_question_1, doc_id from documents)"""


@query("melt_questions", f"""
with {MELT} select distinct v as questions from (select question as v from q union all select seq_question_0 from q union all select par_question_1 from q) where v is not null""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    wide = docs.select(
        F.concat(F.lit("Q "), "lang").alias("question"),
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("A "), "source")).alias("seq_question_0"),
        F.concat(F.lit("B "), "lang").alias("par_question_1"), "doc_id")
    return R.melt_questions(wide)


@query("extract_after_marker", f"""
select doc_id, {s_strip("substr(q, strpos(q, '#New Problem#') + 13)")} as refined_question
from (select doc_id, case when doc_id % 2 = 0 then 'old #New Problem# ' || text else text end as q from documents) where contains(q, '#New Problem#')""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    marked = docs.withColumn("questions", F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("old #New Problem# "), "text")).otherwise(F.col("text")))
    return R.extract_after(marked).select("doc_id", "refined_question")


@query("drop_matching_columns", "select vec_id, label from embeddings")
def _(spark, sf):
    return R.drop_matching(table(spark, sf, "embeddings").withColumn("raw_embedding", F.lit(1)), "embedding")


@query("drop_null_rows", "select doc_id, lang, quality from documents join labels using (doc_id)")
def _(spark, sf):
    wide = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return R.drop_nulls(wide, ["quality"]).select("doc_id", "lang", "quality")


@query("choose_rows", "select doc_id, lang from documents order by md5(doc_id || '|0'), doc_id limit 5")
def _(spark, sf):
    return R.choose_rows(table(spark, sf, "documents"), "doc_id", 5).select("doc_id", "lang")


@query("rows_per_domain_key", "select source, unnest(range(0, 3)) as seed from (select distinct source from documents)")
def _(spark, sf):
    return R.rows_per_key(spark, table(spark, sf, "documents"), "source", 3)


# ---- vectors ----------------------------------------------------------------


@query("most_similar_row", """
with s as (select a.vec_id, b.vec_id as similar_id, list_dot_product(a.embedding::double[], b.embedding::double[]) as d from embeddings a join embeddings b on a.vec_id <> b.vec_id)
select vec_id, similar_id, round(d::double, 4) as score from (select *, row_number() over (partition by vec_id order by d desc, similar_id) as n from s) where n = 1""")
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    pairs = N.most_similar(vectors, "vec_id", "embedding", block_rows=128).select("vec_id", "similar_id")
    others = vectors.select(F.col("vec_id").alias("similar_id"), F.col("embedding").alias("other"))
    both = pairs.join(vectors, "vec_id").join(others, "similar_id")
    # The search runs in single precision; the reported score does not.
    return both.select("vec_id", "similar_id", F.round(N.dot(F.col("embedding"), F.col("other")), 4).alias("score"))


def _center_sql(k: int) -> str:
    parts = ["e as (select vec_id, embedding::double[] as v from embeddings)", "c0 as (select vec_id, v from e order by vec_id limit 1)"]
    for i in range(1, k):
        near = "least(" + ", ".join(
            f"list_sum(list_transform(e.v, lambda x, j: (x - c{c}.v[j]) * (x - c{c}.v[j])))" for c in range(i)) + ", 1e300::double)"
        joins = " ".join(f"cross join c{c}" for c in range(i))
        others = " and ".join(f"e.vec_id <> c{c}.vec_id" for c in range(i))
        parts.append(f"c{i} as (select e.vec_id, e.v from e {joins} where {others} order by {near} desc, e.vec_id limit 1)")
    return f"with {', '.join(parts)} " + " union all ".join(f"select {i} as rank, vec_id from c{i}" for i in range(k))


@query("k_center_choice", _center_sql(5))
def _(spark, sf):
    return N.k_center(table(spark, sf, "embeddings"), "vec_id", "embedding", 5)


@query("best_candidate_of_group", """
with flat as (select label, vec_id, unnest(embedding)::double as x, unnest(range(1, len(embedding) + 1)) as i from embeddings),
c as (select label, i, avg(x) as m from flat group by label, i),
s as (select label, vec_id, round(sum(x * m) / sqrt(sum(x * x) * sum(m * m)), 9) as cosine from flat join c using (label, i) group by label, vec_id)
select label, vec_id, round(cosine, 6) as cosine from (select *, row_number() over (partition by label order by cosine desc, vec_id) as n from s) where n = 1""")
def _(spark, sf):
    out = N.best_of_group(table(spark, sf, "embeddings"), "label", "vec_id", "embedding")
    return out.select("label", "vec_id", F.round("cosine", 6).alias("cosine"))


@query("hashed_text_embedding", f"""
with t as (select doc_id, unnest(regexp_extract_all(lower(text), '{WORD_CHARS}')) as w from documents),
b as (select doc_id, ('0x' || left(md5(w), 6))::int % 256 as bucket, count(*) as n from t group by all),
d as (select bucket, count(*) as texts from b group by 1),
v as (select doc_id, bucket, n * ln(((select count(*) from documents) + 1.0::double) / (texts + 1)) as x from b join d using (bucket)),
u as (select doc_id, bucket, x / nullif(sqrt(sum(x * x) over (partition by doc_id)), 0) as x from v)
select doc_id, bucket, round(x, 4) as weight from u where round(x, 4) > 0""")
def _(spark, sf):
    out = N.hashed_embedding(table(spark, sf, "documents").select("doc_id", "text"), "text")
    places = out.select("doc_id", F.posexplode("embedding").alias("bucket", "x"))
    return places.select("doc_id", "bucket", F.round(F.col("x").cast("double"), 4).alias("weight")).filter("weight > 0")


# ---- answers ----------------------------------------------------------------
# Answers derived from documents: the gold value is the length of the text.

QA_ROWS = r"""qa as (select doc_id, text as question, cast(n_chars as varchar) as gold, case doc_id % 5
  when 0 then 'The answer is \boxed{' || n_chars || '}' when 1 then 'So $ ' || n_chars || '.0 $.' when 2 then text
  when 3 then 'final answer: ' || (n_chars + 1) else '' end as answer from documents)"""
BOX_SQL = r"case when regexp_matches({x}, '(?s).*\\boxed\{([^{}]*)\}') then regexp_extract({x}, '(?s).*\\boxed\{([^{}]*)\}', 1) else {x} end"


def s_norm(x: str) -> str:
    return rf"regexp_replace(regexp_replace(lower({BOX_SQL.replace('{x}', x)}), '[{BLANK}$]+', '', 'g'), '\.+\z', '')"


def qa_rows(spark, sf):
    docs = table(spark, sf, "documents")
    n = F.col("n_chars").cast("string")
    answer = (
        F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit("The answer is \\boxed{"), n, F.lit("}")))
        .when(F.col("doc_id") % 5 == 1, F.concat(F.lit("So $ "), n, F.lit(".0 $.")))
        .when(F.col("doc_id") % 5 == 2, F.col("text"))
        .when(F.col("doc_id") % 5 == 3, F.concat(F.lit("final answer: "), (F.col("n_chars") + 1).cast("string")))
        .otherwise("")
    )
    return docs.select("doc_id", F.col("text").alias("question"), n.alias("gold"), answer.alias("answer"))


S_MATCH = f"({s_norm('gold')} <> '' and contains({s_norm('answer')}, {s_norm('gold')}))"


@query("answer_match", f"with {QA_ROWS} select doc_id, {S_MATCH}::int as matched from qa")
def _(spark, sf):
    return qa_rows(spark, sf).select("doc_id", A.match_answer(F.col("answer"), F.col("gold")).cast("int").alias("matched"))


@query("answer_match_accuracy", f"""
with {QA_ROWS} select count(*) as total, count(*) filter ({S_MATCH}) as matched, round(avg({S_MATCH}::int), 6) as accuracy from qa""")
def _(spark, sf):
    rows = qa_rows(spark, sf).withColumn("hit", A.match_answer(F.col("answer"), F.col("gold")))
    return A.accuracy(rows, "hit").withColumn("accuracy", F.round("accuracy", 6))


VERDICTS = """judged as (select text as question, source as answer, max(quality) = 1 as verdict
  from documents join labels using (doc_id) group by 1, 2)"""


def judged_rows(spark, sf):
    """Documents as questions with their source as answer, next to what a judge said of some of them."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("text").alias("question"), F.col("source").alias("answer"))
    verdicts = docs.join(table(spark, sf, "labels"), "doc_id").groupBy("question", "answer").agg((F.max("quality") == 1).alias("verdict"))
    return A.semantic_match(docs, verdicts, "question", "answer")


@query("semantic_match", f"""
with {VERDICTS} select doc_id, coalesce(verdict, false) as matched, verdict is not null as judged
from documents d left join judged j on d.text = j.question and d.source = j.answer""")
def _(spark, sf):
    return judged_rows(spark, sf).select("doc_id", "matched", "judged")


@query("semantic_match_accuracy", f"""
with {VERDICTS} select count(*) as total, count(*) filter (v) as matched, round(avg(v::int), 6) as accuracy
from (select coalesce(verdict, false) as v from documents d left join judged j on d.text = j.question and d.source = j.answer)""")
def _(spark, sf):
    return A.accuracy(judged_rows(spark, sf), "matched").withColumn("accuracy", F.round("accuracy", 6))


S_TOKENS = "list_filter(regexp_extract_all(lower({x}), '" + WORD_CHARS + "'), lambda w: w not in ('a', 'an', 'the'))"


@query("answer_token_f1", f"""
with p as (select a.conv_id, a.turn, {S_TOKENS.replace('{x}', 'a.text')} as u, {S_TOKENS.replace('{x}', 'b.text')} as s
  from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1),
uc as (select conv_id, turn, w, count(*) as n from (select conv_id, turn, unnest(u) as w from p) group by 1, 2, 3),
sc as (select conv_id, turn, w, count(*) as n from (select conv_id, turn, unnest(s) as w from p) group by 1, 2, 3),
c as (select conv_id, turn, sum(least(uc.n, sc.n)) as k from uc join sc using (conv_id, turn, w) group by 1, 2)
select conv_id, turn, round(case when len(u) + len(s) = 0 then 0::double else coalesce(k, 0)::double * 2 / (len(u) + len(s)) end, 6) as f1
from p left join c using (conv_id, turn)""")
def _(spark, sf):
    turns = table(spark, sf, "conversations")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("gold"))
    pairs = turns.join(following, ["conv_id", "turn"])
    return pairs.select("conv_id", "turn", r6(A.token_f1(F.col("text"), F.col("gold")), "f1"))


S_FORMAT = r"({strip} <> '' and (contains(answer, '\boxed{') or regexp_matches(answer, '{phrase}')))".replace(
    "{strip}", s_strip("answer")).replace("{phrase}", A.FINAL_PHRASE)


@query("answer_format", f"with {QA_ROWS} select doc_id from qa where {S_FORMAT}")
def _(spark, sf):
    return qa_rows(spark, sf).filter(A.answer_format(F.col("answer"))).select("doc_id")


S_TRUTH = f"({s_norm('answer')} = {s_norm('gold')} or coalesce(abs(try_cast({s_norm('answer')} as double) - try_cast({s_norm('gold')} as double)) <= 1e-6::double, false))"


@query("answer_ground_truth", f"with {QA_ROWS} select doc_id, {S_TRUTH}::int as correct from qa")
def _(spark, sf):
    return qa_rows(spark, sf).select("doc_id", A.ground_truth(F.col("answer"), F.col("gold")).cast("int").alias("correct"))


S_QWORDS = f"regexp_extract_all(lower(concat_ws(' ', question, answer)), '{WORD_CHARS}')"
S_GRAMS = "list_transform(range(1, greatest(len(w) - 3, 1)), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4])"
S_NGRAM = f"(case when len(w) < 5 then 1.0::double else len(list_distinct({S_GRAMS}))::double / len({S_GRAMS}) end)"


@query("answer_ngram_repetition", f"""
with {QA_ROWS}, t as (select doc_id, {S_QWORDS} as w from qa), s as (select doc_id, {S_NGRAM} as score from t)
select doc_id, round(score, 6) as score from s where score between 0.1::double and 1.0::double""")
def _(spark, sf):
    kept = A.ngram_filter(qa_rows(spark, sf), "question", "answer")
    return kept.select("doc_id", r6(A.ngram_score(F.col("question"), F.col("answer")), "score"))


@query("answer_token_length", f"select doc_id from documents where {s_count('text', TOKEN)} <= 512")
def _(spark, sf):
    return A.token_length_filter(table(spark, sf, "documents"), "text", 512).select("doc_id")


@query("answer_root_split", f"""
with {QA_ROWS} select doc_id, ({s_strip('answer')} <> '' or {s_strip("case when doc_id % 2 = 0 then gold else '' end")} <> '')::int as has_root from qa""")
def _(spark, sf):
    rows = qa_rows(spark, sf).withColumn("gold", F.when(F.col("doc_id") % 2 == 0, F.col("gold")).otherwise(""))
    have, lack = A.split_roots(rows, "answer", "gold")
    return have.select("doc_id", F.lit(1).alias("has_root")).unionByName(lack.select("doc_id", F.lit(0).alias("has_root")))


@query("answer_to_pretrain_text", f"with {QA_ROWS} select doc_id, concat_ws(chr(10), question, answer) as text from qa")
def _(spark, sf):
    return qa_rows(spark, sf).select("doc_id", A.to_pretrain_text(F.col("question"), F.col("answer")).alias("text"))


@query("recipe_reasoning_answers", f"""
with {QA_ROWS}, t as (select *, {S_QWORDS} as w from qa where {S_FORMAT} and {S_TRUTH})
select doc_id, answer from t where {S_NGRAM} between 0.1::double and 1.0::double and {s_count('answer', TOKEN)} <= 8192""")
def _(spark, sf):
    return recipes.reasoning_answers(qa_rows(spark, sf), "question", "answer", "gold").select("doc_id", "answer")


# ---- SQL corpora ------------------------------------------------------------

STATEMENTS = """st as (select doc_id, 'SELECT ' || lang || ' FROM t' || repeat(' JOIN u ON t.k = u.k', cast(doc_id % 3 as int))
  || case when n_chars % 2 = 0 then ' WHERE a > 1 OR b LIKE ''x%''' else '' end
  || case when n_chars % 3 = 0 then ' AND c IN (SELECT c FROM v)' else '' end
  || case when n_chars % 5 = 0 then ' GROUP BY a HAVING count(*) > 1 ORDER BY a LIMIT 5' else '' end as stmt from documents)"""


def statements(spark, sf):
    docs = table(spark, sf, "documents")
    n = F.col("n_chars")
    stmt = F.concat(
        F.lit("SELECT "), "lang", F.lit(" FROM t"), F.repeat(F.lit(" JOIN u ON t.k = u.k"), (F.col("doc_id") % 3).cast("int")),
        F.when(n % 2 == 0, " WHERE a > 1 OR b LIKE 'x%'").otherwise(""),
        F.when(n % 3 == 0, " AND c IN (SELECT c FROM v)").otherwise(""),
        F.when(n % 5 == 0, " GROUP BY a HAVING count(*) > 1 ORDER BY a LIMIT 5").otherwise(""))
    return docs.select("doc_id", stmt.alias("stmt"))


S_COMPONENTS = "(" + " + ".join(s_count("stmt", p) for p in Q.COMPONENTS) + ")"


@query("sql_component_difficulty", f"""
with {STATEMENTS}, c as (select doc_id, {S_COMPONENTS} as n from st)
select doc_id, n as components, case when n <= 2 then 'easy' when n <= 4 then 'medium' when n <= 6 then 'hard' else 'extra' end as difficulty from c""")
def _(spark, sf):
    st = statements(spark, sf)
    return st.select("doc_id", Q.component_count(F.col("stmt")).alias("components"), Q.component_difficulty(F.col("stmt")).alias("difficulty"))


@query("sql_execution_difficulty", """
select user_id, n as passes, case when n <= 2 then 'extra' when n <= 5 then 'hard' when n <= 9 then 'medium' else 'easy' end as difficulty
from (select user_id, count(*) filter (event_type = 'error') as n from events group by user_id)""")
def _(spark, sf):
    runs = table(spark, sf, "events").select("user_id", (F.col("event_type") == "error").alias("ok"))
    return Q.execution_difficulty(runs, "user_id")


@query("sql_execution_filter", f"""
with {STATEMENTS} select doc_id, stmt from st where doc_id in (select user_id from events where event_type = 'purchase')""")
def _(spark, sf):
    runs = table(spark, sf, "events").select(F.col("user_id").alias("doc_id"), (F.col("event_type") == "purchase").alias("ok"))
    return Q.execution_filter(statements(spark, sf), runs, ["doc_id"])


PROMPT = "Schema:\n{schema}\nQuestion: {question}"


@query("sql_schema_prompt", """
with s as (select n_regionkey as db_id, string_agg('TABLE ' || n_name, chr(10) order by n_name) as ddl from nation group by 1)
select doc_id, 'Schema:' || chr(10) || ddl || chr(10) || 'Question: ' || text as prompt from documents join s on db_id = doc_id % 5""")
def _(spark, sf):
    ddl = table(spark, sf, "nation").select(F.col("n_regionkey").alias("db_id"), "n_name", F.concat(F.lit("TABLE "), "n_name").alias("ddl"))
    questions = table(spark, sf, "documents").withColumn("db_id", (F.col("doc_id") % 5).cast("int"))
    return Q.schema_prompt(questions, Q.schema_texts(ddl, "db_id", "n_name", "ddl"), "db_id", "text", PROMPT).select("doc_id", "prompt")


GOLD_PRED = """r as (select p_partkey, [{'a': p_brand, 'c': p_type}, {'a': p_name, 'c': cast(p_size as varchar)}] as gold,
  [{'a': p_brand, 'c': case when p_size % 2 = 0 then p_type else 'other' end}, {'a': case when p_size % 3 = 0 then p_name else 'extra' end, 'c': cast(p_size as varchar)}] as pred from part),
g as (select p_partkey, unnest(gold) as x from r), p as (select p_partkey, unnest(pred) as y from r),
pairs as (select coalesce(g.p_partkey, p.p_partkey) as p_partkey, coalesce(x.a, y.a) as abbreviation, x.c as gold, y.c as predicted
  from g full join p on g.p_partkey = p.p_partkey and x.a = y.a)"""


def structure_rows(spark, sf):
    part, size = table(spark, sf, "part"), F.col("p_size")

    def item(name, key):
        return F.struct(name.alias("abbreviation"), key.alias("canonical"))

    gold = F.array(item(F.col("p_brand"), F.col("p_type")), item(F.col("p_name"), size.cast("string")))
    pred = F.array(item(F.col("p_brand"), F.when(size % 2 == 0, F.col("p_type")).otherwise("other")),
                   item(F.when(size % 3 == 0, F.col("p_name")).otherwise("extra"), size.cast("string")))
    return Q.structure_pairs(part.select("p_partkey", gold.alias("gold_list"), pred.alias("pred_list")), "p_partkey", "pred_list", "gold_list")


@query("structure_pairs", f"with {GOLD_PRED} select p_partkey, abbreviation, gold, predicted, coalesce(gold = predicted, false)::int as equal from pairs")
def _(spark, sf):
    return structure_rows(spark, sf).withColumn("equal", F.col("equal").cast("int"))


@query("structure_accuracy", f"""
with {GOLD_PRED} select count(gold) as gold_total, count(*) filter (gold = predicted) as equal_total,
  round(count(*) filter (gold = predicted)::double / count(gold), 6) as accuracy from pairs""")
def _(spark, sf):
    return Q.structure_accuracy(structure_rows(spark, sf)).withColumn("accuracy", F.round("accuracy", 6))


# ---- model-call pattern -----------------------------------------------------

TEMPLATE = "Rate the text from {source} in {lang}: {text}"


def asked(spark, sf):
    return M.render(table(spark, sf, "documents"), TEMPLATE, ["source", "lang", "text"], "You are a judge.")


S_PROMPT = "'You are a judge.' || chr(10) || chr(10) || 'Rate the text from ' || source || ' in ' || lang || ': ' || text"
ASKED = f"asked as (select *, {S_PROMPT} as prompt, sha256({S_PROMPT}) as request_id from documents)"
SCORE_SQL = "(1 + ('0x' || substr(md5(prompt), 1, 2))::int % 6)"


def score_model():
    """The stand-in, as a local function so that it travels by value."""

    def score(prompts: list[str]) -> list[str]:
        import hashlib

        return [f" {1 + int(hashlib.md5(p.encode()).hexdigest()[:2], 16) % 6}\n" for p in prompts]

    return score


@query("model_render_prompts", f"with {ASKED} select doc_id, prompt, request_id from asked")
def _(spark, sf):
    return asked(spark, sf).select("doc_id", "prompt", "request_id")


@query("model_pending_requests", f"""
with {ASKED} select distinct request_id, prompt from asked where request_id not in (select request_id from asked where lang = 'en')""")
def _(spark, sf):
    requests = asked(spark, sf)
    stored = requests.filter("lang = 'en'").select("request_id").distinct()
    return M.pending(requests, stored)


@query("model_apply_function", f"with {ASKED} select distinct request_id, ' ' || {SCORE_SQL} || chr(10) as response, 1 as ok from asked")
def _(spark, sf):
    out = M.apply_model(M.pending(asked(spark, sf)), score_model())
    return out.select("request_id", "response", F.col("ok").cast("int").alias("ok"))


@query("model_attach_responses", f"with {ASKED} select doc_id, ' ' || {SCORE_SQL} || chr(10) as response from asked")
def _(spark, sf):
    requests = asked(spark, sf)
    answers = M.apply_model(M.pending(requests), score_model())
    return M.attach_balanced(requests, answers).select("doc_id", "response")


JSON_TEXT = """case doc_id % 4 when 0 then '```json' || chr(10) || '{"question": "' || source || '", "answer": "' || lang || '"}' || chr(10) || '```'
  when 1 then '{"question": "' || source || '"}' when 2 then 'no json' else '{"question": "' || source || '", "answer": "' || lang || '", "more": 1}' end"""


def json_responses(spark, sf):
    docs = table(spark, sf, "documents")
    body = F.concat(F.lit('{"question": "'), "source", F.lit('"'))
    both = F.concat(body, F.lit(', "answer": "'), "lang", F.lit('"'))
    kind = F.col("doc_id") % 4
    text = (F.when(kind == 0, F.concat(F.lit("```json\n"), both, F.lit("}\n```"))).when(kind == 1, F.concat(body, F.lit("}")))
            .when(kind == 2, "no json").otherwise(F.concat(both, F.lit(', "more": 1}'))))
    return docs.select("doc_id", "lang", "source", text.alias("response"))


@query("model_parse_json", """
select doc_id, case when doc_id % 4 <> 2 then source end as question, case when doc_id % 4 in (0, 3) then lang end as answer from documents""")
def _(spark, sf):
    parsed = json_responses(spark, sf).withColumn("p", M.parse_json(F.col("response"), "question string, answer string"))
    return parsed.select("doc_id", "p.question", "p.answer")


@query("model_parse_score", f"with {ASKED} select doc_id, case when {SCORE_SQL} between 1 and 5 then {SCORE_SQL} end as score from asked")
def _(spark, sf):
    step = M.model_step(table(spark, sf, "documents"), TEMPLATE, ["source", "lang", "text"], score_model(), "response", "You are a judge.")
    return step.select("doc_id", M.parse_int_score(F.col("response")).alias("score"))


DIMENSIONS = ["correctness", "clarity", "depth", "safety", "format", "style"]
S_SCORES = " || ', ' || ".join(f"""'"{n}": ' || cast((doc_id + {3 * i}) % 7 as varchar(9))""" for i, n in enumerate(DIMENSIONS))
S_RATED = f"""case doc_id % 5 when 0 then 'no json' when 1 then '```json' || chr(10) || '{{' || {S_SCORES} || '}}' || chr(10) || '```'
  when 2 then '{{"clarity": 4}}' else '{{' || {S_SCORES} || '}}' end"""


def _s_dimension(i: int, name: str) -> str:
    value = f"(doc_id + {3 * i}) % 7"
    whole = f"case when doc_id % 5 in (1, 3, 4) and {value} between 1 and 5 then ({value})::double end"
    return f"case when doc_id % 5 = 2 then {'4.0::double' if name == 'clarity' else 'null'} else {whole} end"


S_EACH = ", ".join(f"{_s_dimension(i, n)} as {n}" for i, n in enumerate(DIMENSIONS))


@query("model_dimension_scores", f"""
with s as (select doc_id, {S_EACH} from documents)
select *, round(list_avg(list_filter([{', '.join(DIMENSIONS)}], lambda x: x is not null)), 6) as overall from s""")
def _(spark, sf):
    rated = table(spark, sf, "documents").select("doc_id", F.expr(S_RATED).alias("response"))
    scores = rated.select("doc_id", F.inline(F.array(M.dimension_scores(F.col("response"), DIMENSIONS))))
    return scores.withColumn("overall", F.round("overall", 6))


@query("model_invalid_formats", "select count(*) filter (doc_id % 4 in (1, 2)) as invalid_response from documents")
def _(spark, sf):
    return M.count_invalid(json_responses(spark, sf), ["response"], ["question", "answer"])


@query("model_collect_samples", """
select source as question, lang as answer from documents where doc_id % 2 = 0 and doc_id % 4 in (0, 3)
union all select 'o' || doc_id, source from documents where doc_id % 2 = 0
union all select source, lang from documents where doc_id % 2 = 1 and doc_id % 4 in (0, 3)""")
def _(spark, sf):
    rows = json_responses(spark, sf)
    original = F.struct(F.concat(F.lit("o"), F.col("doc_id").cast("string")).alias("question"), F.col("source").alias("answer"))
    rows = rows.select(original.alias("sample"), F.when(F.col("doc_id") % 2 == 0, F.col("response")).alias("rewrite"),
                       F.when(F.col("doc_id") % 2 == 1, F.col("response")).alias("refine"))
    return M.collect_samples(rows, "sample", ["question", "answer"])


@query("model_fan_out", "select doc_id, unnest(range(0, 3)) as candidate from documents")
def _(spark, sf):
    return M.fan_out(table(spark, sf, "documents"), 3).select("doc_id", "candidate")


@query("model_verdict_filter", f"with {ASKED} select doc_id, {SCORE_SQL} as score from asked where {SCORE_SQL} between 3 and 5")
def _(spark, sf):
    step = M.model_step(table(spark, sf, "documents"), TEMPLATE, ["source", "lang", "text"], score_model(), "response", "You are a judge.")
    step = step.select("doc_id", M.parse_int_score(F.col("response")).alias("score"))
    return M.verdict_filter(step, F.col("score"), 3, 5)


@query("model_failed_requests", f"""
with {ASKED} select doc_id, ('0x' || substr(md5(prompt), 1, 1))::int % 4 <> 0 as answered,
  case when ('0x' || substr(md5(prompt), 1, 1))::int % 4 = 0 then 'no answer' end as why from asked""")
def _(spark, sf):
    def careful(prompts: list[str]) -> list[str]:
        import hashlib

        if any(int(hashlib.md5(p.encode()).hexdigest()[0], 16) % 4 == 0 for p in prompts):
            raise RuntimeError("no answer")
        return ["fine"] * len(prompts)

    # Rendered once and sent once, though both are read several times.
    requests = durable(asked(spark, sf))
    answers = durable(M.apply_model(M.pending(requests), careful, batch=1, concurrency=16))
    out = M.attach_balanced(requests, answers).join(answers.select("request_id", "error"), "request_id", "left")
    return out.select("doc_id", F.col("response").isNotNull().alias("answered"), F.col("error").alias("why"))


@query("model_verdict_label", f"with {ASKED} select doc_id, ({SCORE_SQL} between 3 and 5)::int as verdict from asked")
def _(spark, sf):
    step = M.model_step(table(spark, sf, "documents"), TEMPLATE, ["source", "lang", "text"], score_model(), "response", "You are a judge.")
    step = step.select("doc_id", M.parse_int_score(F.col("response")).alias("score"))
    return M.verdict_filter(step, F.col("score"), 3, 5, keep_all=True).select("doc_id", "verdict")


@query("model_category_counts", f"with {ASKED} select {SCORE_SQL} as score, count(*) as rows from asked group by 1")
def _(spark, sf):
    step = M.model_step(table(spark, sf, "documents"), TEMPLATE, ["source", "lang", "text"], score_model(), "response", "You are a judge.")
    return reports.category_counts(step.select(M.parse_int_score(F.col("response"), 1, 6).alias("score")), "score")


@query("conversation_to_turns", "select conv_id, cast(row_number() over (partition by conv_id order by turn) - 1 as bigint) as turn, role, text from conversations")
def _(spark, sf):
    packed = M.conversation_of(table(spark, sf, "conversations"), "conv_id")
    return M.turns_of(packed, "conversations", "conv_id")


@query("turns_to_conversation", """
select conv_id, string_agg(role || ':' || text, '|' order by turn) as joined, count(*) as turns from conversations group by conv_id""")
def _(spark, sf):
    packed = M.conversation_of(table(spark, sf, "conversations"), "conv_id")
    text = F.array_join(F.transform("conversations", lambda t: F.concat_ws(":", t["role"], t["text"])), "|")
    return packed.select("conv_id", text.alias("joined"), F.size("conversations").alias("turns"))


# ---- branching recipes ------------------------------------------------------


def _json_score():
    def score(prompts: list[str]) -> list[str]:
        import hashlib

        return [str(1 + int(hashlib.md5(p.encode()).hexdigest()[:2], 16) % 5) for p in prompts]

    return score


def _rework(word: str):
    def rework(prompts: list[str]) -> list[str]:
        import json

        return [json.dumps({**json.loads(p), "source": word}, ensure_ascii=False) for p in prompts]

    return rework


def _s_score(x: str) -> str:
    return f"(1 + ('0x' || substr(md5({x}), 1, 2))::int % 5)"


REWORK = "'{{\"doc_id\": \"' || doc_id || '\", \"source\": \"{word}\"}}'"


@query("recipe_score_and_rework", f"""
with d as (select '{{"doc_id":"' || doc_id || '","source":"' || source || '"}}' as j, {REWORK.format(word='refined')} as refined,
  {REWORK.format(word='rewritten')} as rewritten, cast(doc_id as varchar) as doc_id, source from documents),
s as (select *, {_s_score('j')} as first_score from d),
w as (select * from s where first_score > 3 and {_s_score('rewritten')} >= 4)
select doc_id, 'refined' as source from s where first_score between 2 and 3 and {_s_score('refined')} >= 4
union all select doc_id, 'rewritten' from w union all select doc_id, source from w""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "source")
    return recipes.score_and_rework(docs, ["doc_id", "source"], _json_score(), _rework("refined"), _rework("rewritten"))


def _fuse(word: str):
    def fuse(prompts: list[str]) -> list[str]:
        return [f"{word} #New Problem#: {p.split(chr(10))[0]}" for p in prompts]

    return fuse


def _always(word: str):
    def answer(prompts: list[str]) -> list[str]:
        return [word] * len(prompts)

    return answer


@query("recipe_fuse_questions", f"""
with q as (select item_id, {s_strip("string_split(text, chr(10))[1]")} as t from benchmark)
select distinct 'seq #New Problem#: ' || t as questions, t as refined_question from q
union select distinct 'par #New Problem#: ' || t, t from q""")
def _(spark, sf):
    bench = table(spark, sf, "benchmark")
    out = recipes.fuse_questions(bench, "item_id", "text", {"seq": _fuse("seq"), "par": _fuse("par")}, _always("yes"))
    return out.select("questions", "refined_question")


def _ask():
    def ask(prompts: list[str]) -> list[str]:
        import hashlib
        import json

        return [json.dumps([{"question": f"q{i}", "answer": hashlib.md5(p.encode()).hexdigest()} for i in range(2)]) for p in prompts]

    return ask


@query("recipe_knowledge_questions", f"""
with t as (select doc_id, regexp_extract_all(text, '{TOKEN}') as k from documents),
c as (select doc_id, k, unnest(range(0, greatest(len(k), 1), 512)) as p from t),
x as (select doc_id, cast(p / 512 as int) as chunk_number, array_to_string(k[p + 1 : p + 512], ' ') as body from c where array_to_string(k[p + 1 : p + 512], ' ') <> '')
select doc_id, chunk_number, 'q' || unnest(range(0, 2)) as question, md5('clean ' || md5(body)) as answer from x""")
def _(spark, sf):
    def cleaner(prompts: list[str]) -> list[str]:
        import hashlib

        return ["clean " + hashlib.md5(p.encode()).hexdigest() for p in prompts]

    return recipes.knowledge_questions(table(spark, sf, "documents"), "text", "doc_id", cleaner, _ask())
