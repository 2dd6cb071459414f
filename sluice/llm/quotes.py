"""Conversations rebuilt from messages that quote each other.

Quote levels are read line by line, quoted passages are normalised and hashed,
and the hashes are joined to the messages that last said the same before. The quotes
then say who answers whom; conversations come out in reply order without them.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import durable

WROTE = r"(?i)^\s*(on|am|el|le)\s.*(wrote|schrieb|escribió|a écrit)\s*:\s*$"


def quoted_runs(text: Column) -> Column:
    """Runs of lines of one quote level, as an array of ``level`` and ``body``.

    The level is the number of ``>`` before a line, white space between them
    allowed; one space after the last is dropped. A line that says who wrote
    the quote below it belongs to no run.
    """
    marks = r"^((?:[ \t]*>)+)[ \t]?"
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\r?\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, marks, 1), "[^>]", "")).alias("level"),
            F.regexp_replace(line, marks, "").alias("body"),
        ),
    )
    return _with(lines, _unsigned, _runs)


def _with(value: Column, *steps) -> Column:
    """Each step applied to a value worked out once."""
    for step in steps:
        value = F.element_at(F.transform(F.array(value), step), 1)
    return value


def _unsigned(lines: Column) -> Column:
    def names_author(line: Column, at: Column) -> Column:
        below = F.get(lines, at + 1)
        return ~((below["level"] > line["level"]) & line["body"].rlike(WROTE))

    return F.filter(lines, names_author)


def _runs(lines: Column) -> Column:
    starts = F.filter(
        F.transform(lines, lambda line, at: F.when((at == 0) | (F.get(lines, at - 1)["level"] != line["level"]), at)),
        lambda at: at.isNotNull(),
    )

    def cut(starts: Column) -> Column:
        def run(start: Column, number: Column) -> Column:
            stop = F.coalesce(F.get(starts, number + 1), F.size(lines))
            bodies = F.transform(F.slice(lines, start + 1, stop - start), lambda line: line["body"])
            return F.struct(F.get(lines, start)["level"].alias("level"), F.array_join(bodies, "\n").alias("body"))

        return F.transform(starts, run)

    return _with(starts, cut)


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(text: Column) -> Column:
    """Hashes of a whole text (``rank`` 0) and of its paragraphs (``rank`` 1), blank ones left out."""
    def entry(part: Column, rank: int) -> Column:
        return F.struct(F.lit(rank).alias("rank"), F.sha2(normal(part), 256).alias("hash"), (normal(part) != "").alias("said"))

    whole = F.array(entry(text, 0))
    parts = F.transform(F.split(text, r"\n\s*\n"), lambda part: entry(part, 1))
    return F.filter(F.array_distinct(F.concat(whole, parts)), lambda e: e["said"])


def _pair(one: Column, other: Column) -> Column:
    """Hash of a passage together with the one that it answers."""
    return F.sha2(F.concat(F.sha2(normal(one), 256), F.sha2(normal(other), 256)), 256)


def _answered(runs: Column, level: Column) -> Column:
    """Body of the first run one level deeper, null without one."""
    return F.get(F.filter(runs, lambda r: (r["level"] == level + 1) & (normal(r["body"]) != "")), F.lit(0))["body"]


def last_sayers(said: DataFrame, quoted: DataFrame, key: list[str]) -> DataFrame:
    """``quoted`` (``key``, ``hash``, ``_id``, ...) with ``_sayer``: the last message before that said the passage.

    Sayers and quoting messages are dealt by ranges of scope, hash and id, so a
    phrase that everybody uses spreads over many ranges. Inside a range the last
    sayer runs along; what ranges before it found comes from a table with a row
    for each range and hash. Quotes that nobody said before are left out.
    """
    own = [c for c in quoted.columns if c not in (*key, "hash", "_id")]
    events = said.select(*key, "hash", "_id", F.col("_id").alias("_said")).unionByName(quoted, allowMissingColumns=True)
    dealt = durable(events.repartitionByRange(*key, "hash", "_id").withColumn("_part", F.spark_partition_id()))
    group = [*key, "hash"]
    ends = dealt.groupBy("_part", *group).agg(F.max("_said").alias("_end"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_part", *group, F.max("_end").over(earlier).alias("_before")).filter("_before is not null")
    # Of rows with one id the quoting ones come first, so a message never answers itself.
    running = Window.partitionBy("_part", *group).orderBy("_id", F.col("_said").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    seen = dealt.withColumn("_here", F.max("_said").over(running)).filter("_said is null")
    a, b = seen.alias("a"), ends.alias("b")
    same = F.col("a._part") == F.col("b._part")
    for c in group:
        same &= F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    met = a.join(b, same, "left").select(*[F.col(f"a.{c}").alias(c) for c in (*group, "_id", *own)], F.coalesce("_here", "_before").alias("_sayer"))
    return met.filter("_sayer is not null and _sayer < _id")


def link_quotes(df: DataFrame, text_col: str, id_col: str, scope: list[str] | None = None) -> DataFrame:
    """``scope``, ``id_col``, ``parent_id``, ``n_quotes``, ``n_linked`` and ``text`` (without quotes) per message.

    Ids give the order in which messages were sent. A quoted passage belongs to
    the last message (of its ``scope``, such as a mailing list; null scopes
    are one) that said it itself, whole or as a paragraph, before it was quoted.
    If the passage comes with a deeper quote, a message that said the one in
    answer to the other goes before those that only said it. The parent is the
    author of the passage quoted at the lowest level, whole passages before
    paragraphs, upper ones before lower ones. Texts are matched without case and
    white space. Null and empty texts have neither quotes nor text; a message
    without id links nowhere and is nobody's parent. Repeated rows come back
    once. Other columns, whatever their names, are not read; ``scope`` columns
    may have any name but those of the result.
    """
    scope = scope or []
    if taken := {"parent_id", "n_quotes", "n_linked", "text", id_col} & set(scope):
        raise ValueError(f"names of the result: {sorted(taken)}")
    scopes = [F.col(c).alias(f"_s{i}") for i, c in enumerate(scope)]
    key = [f"_s{i}" for i in range(len(scope))]
    rows = df.select(*scopes, F.col(id_col).alias("_id"), quoted_runs(F.col(text_col)).alias("_runs")).distinct()
    own = F.filter("_runs", lambda r: r["level"] == 0)
    rows = durable(rows.select(
        *key, "_id", F.regexp_replace(F.array_join(F.transform(own, lambda r: r["body"]), "\n"), r"^\s+|\s+$", "").alias("text"),
        F.filter("_runs", lambda r: (r["level"] > 0) & (normal(r["body"]) != "")).alias("_quotes"),
    ))
    sent = rows.filter("_id is not null")
    # What is said as an answer has a hash with what it answers, ranked before the rest.
    answer = _answered(F.col("_quotes"), F.lit(0))
    says = sent.select(*key, "_id", F.explode(passages(F.col("text"))["hash"]).alias("hash")).unionByName(
        sent.filter(answer.isNotNull() & (normal(F.col("text")) != "")).select(*key, "_id", _pair(F.col("text"), answer).alias("hash"))
    ).distinct()
    quotes = sent.select(*key, "_id", "_quotes", F.posexplode("_quotes").alias("at", "q"))
    deeper = _answered(F.slice("_quotes", F.col("at") + 1, F.size("_quotes")), F.col("q.level"))
    quotes = quotes.select(*key, "_id", "at", "q.level", "q.body", deeper.alias("deeper"))
    pair = F.struct(F.lit(-1).alias("rank"), _pair(F.col("body"), F.col("deeper")).alias("hash"), F.lit(True).alias("said"))
    found = F.concat(passages(F.col("body")), F.when(F.col("deeper").isNotNull(), F.array(pair)).otherwise(F.array().cast("array<struct<rank:int,hash:string,said:boolean>>")))
    quotes = quotes.select(*key, "_id", "at", "level", F.posexplode(found).alias("place", "p"))
    quotes = quotes.select(*key, "_id", "at", "level", "place", "p.rank", "p.hash")
    linked = last_sayers(says, quotes, key)
    best = linked.groupBy(*key, "_id").agg(
        F.min_by("_sayer", F.struct("level", "rank", "at", "place")).alias("_parent"), F.count_distinct("at").alias("n_linked")
    ).alias("b")
    mine = F.col("m._id") == F.col("b._id")
    for k in key:
        mine &= F.col(f"m.{k}").eqNullSafe(F.col(f"b.{k}"))
    return rows.alias("m").join(best, mine, "left").select(
        *[F.col(f"m.{k}").alias(c) for k, c in zip(key, scope)],
        F.col("m._id").alias(id_col),
        F.col("_parent").alias("parent_id"),
        F.size("_quotes").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        "text",
    )


def conversation_rows(linked: DataFrame, id_col: str, scope: list[str] | None = None) -> DataFrame:
    """The conversations as rows: ``linked`` with ``leaf_id`` and ``back``, the replies from a message down to the leaf.

    No message holds a path and no conversation has to fit one cell. Jumps of
    one message up are doubled, a pair of ids each; every round takes what a
    leaf has found up by the jump, so each row of the result is found once.
    Ids grow along a chain, so sorting by id is reply order.
    """
    scope = scope or []
    key = [f"_s{i}" for i in range(len(scope))]

    def meet(left: DataFrame, right: DataFrame, kind: str = "inner") -> DataFrame:
        """Rows of ``left`` whose ``_id`` is ``_aid`` of ``right``, in the same scope."""
        right = right.withColumnsRenamed({k: f"_a{k}" for k in key})
        same = F.col("_id").eqNullSafe(F.col("_aid"))
        for k in key:
            same &= F.col(k).eqNullSafe(F.col(f"_a{k}"))
        return left.join(right, same, kind)

    nodes = linked.select(*[F.col(c).alias(k) for c, k in zip(scope, key)], F.col(id_col).alias("_id"), F.col("parent_id").alias("_up"))
    jump = nodes.filter("_up is not null").select(*key, F.col("_id").alias("_aid"), "_up").distinct()
    jump, far = durable(jump), 1
    leaves = meet(nodes, jump.select(*key, F.col("_up").alias("_aid")).distinct(), "left_anti")
    found = durable(leaves.select(*key, F.col("_id").alias("_leaf"), "_id", F.lit(0).cast("long").alias("_back")).distinct())
    while not jump.isEmpty():
        more = meet(found, jump).select(*key, "_leaf", F.col("_up").alias("_id"), (F.col("_back") + far).alias("_back"))
        found = found.unionByName(durable(more))
        lower = jump.select(*key, F.col("_aid").alias("_from"), F.col("_up").alias("_id"))
        jump, far = durable(meet(lower, jump).select(*key, F.col("_from").alias("_aid"), "_up")), far * 2
    same = F.col(id_col).eqNullSafe(F.col("_id"))
    for c, k in zip(scope, key):
        same &= F.col(c).eqNullSafe(F.col(k))
    return linked.join(found, same).select(*linked.columns, F.col("_leaf").alias("leaf_id"), F.col("_back").alias("back"))
