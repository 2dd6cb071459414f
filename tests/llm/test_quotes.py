from pyspark.sql import functions as F

from sluice.llm import quotes


def runs(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(quotes.quoted_runs(F.col("t")).alias("r"))
    return [tuple(r) for r in df.first().r]


def test_levels(spark):
    text = "top\nOn Monday she wrote:\n> a\n>b\n> > c\n>> d\n>\n> e\nend"
    assert runs(spark, text) == [(0, "top"), (1, "a\nb"), (2, "c\nd"), (1, "\ne"), (0, "end")]
    assert runs(spark, None) == [(0, "")] and runs(spark, "") == [(0, "")]


MAILS = [
    (1, "l", "Shall we meet?\n\nI am free on Friday."),
    (2, "l", "Yes!\n\n> SHALL   we\n> meet?"),
    (3, "l", "Good.\n\nOn Friday B wrote:\n> Yes!\n>\n> > Shall we meet?"),
    (4, "l", "No.\n> I am free on Friday."),
    (5, "m", "> Yes!\nother list"),
    (6, "l", None), (7, "l", ""), (8, None, "> Shall we meet?"), (9, "l", "> never said\nnew"),
    (2, "l", "Yes!\n\n> SHALL   we\n> meet?"), (None, "l", "> Yes!"),
]


def test_links_paths_and_conversations(spark):
    df = spark.createDataFrame(MAILS, "id long, list string, body string").selectExpr("*", "1 as text", "2 as hash", "3 as _id")
    linked = quotes.link_quotes(df, "body", "id", ["list"])
    got = {(r.id, r.list): (r.parent_id, r.n_quotes, r.n_linked, r.text) for r in linked.collect()}
    assert got == {
        (1, "l"): (None, 0, 0, "Shall we meet?\n\nI am free on Friday."), (2, "l"): (1, 1, 1, "Yes!"),
        (3, "l"): (2, 2, 2, "Good."), (4, "l"): (1, 1, 1, "No."), (5, "m"): (None, 1, 0, "other list"),
        (6, "l"): (None, 0, 0, ""), (7, "l"): (None, 0, 0, ""), (8, None): (None, 1, 0, ""),
        (9, "l"): (None, 1, 0, "new"), (None, "l"): (None, 1, 0, ""),
    }
    built = conversations(quotes.conversation_rows(linked, "id", ["list"]), "list")
    assert [i for i, _ in built["l", 3]] == [1, 2, 3] and built["l", 4] == [(1, MAILS[0][2]), (4, "No.")]
    assert ("l", 1) not in built and built["m", 5] == [(5, "other list")]


def conversations(rows, scope=None):
    """Messages of each conversation in reply order."""
    found = {}
    for r in sorted(rows.collect(), key=lambda r: -r.back):
        found.setdefault((r[scope] if scope else None, r.leaf_id), []).append((r.id, r.text))
    return found


def parents(spark, rows):
    df = spark.createDataFrame(rows, "id long, body string").repartition(3)
    return {r.id: r.parent_id for r in quotes.link_quotes(df, "body", "id").collect()}


def test_last_sayer_before_the_quote(spark):
    rows = [(1, "Hello all"), (2, "Yes."), (3, "Why?"), (4, "Yes."), (5, "So\n> Yes.\n> > Why?"), (6, "Yes."), (7, "> yes."), (2, "Late")]
    assert parents(spark, rows) == {1: None, 2: None, 3: None, 4: None, 5: 4, 6: None, 7: 6}
    # The deeper quote tells which of two that said the same is meant.
    rows = [(1, "Hello all"), (2, "Yes.\n> Hello all"), (3, "Why?"), (4, "Yes.\n> Why?"), (5, "A\n> Yes.\n> > Hello all"), (6, "B\n> Yes.\n> > Why?"), (7, "C\n> Yes.")]
    assert parents(spark, rows) == {1: None, 2: 1, 3: None, 4: 3, 5: 2, 6: 4, 7: 4}


def test_phrase_of_everybody_spreads(spark, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(i, "Yes." if i % 3 else "Other\n> Yes.") for i in range(600)]
        got = parents(spark, rows)
        assert got == {i: (i - 1 if i and i % 3 == 0 else None) for i in range(600)}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_chain_and_no_scope(spark):
    rows = [(0, "message 0")] + [(i, f"message {i}\n> message {i - 1}") for i in range(1, 40)]
    linked = quotes.link_quotes(spark.createDataFrame(rows, "id long, body string"), "body", "id")
    assert {r.id: r.parent_id for r in linked.collect()} == {i: i - 1 if i else None for i in range(40)}
    assert conversations(quotes.conversation_rows(linked, "id")) == {(None, 39): [(i, f"message {i}") for i in range(40)]}


def test_empty(spark):
    df = spark.createDataFrame([], "id long, body string")
    linked = quotes.link_quotes(df, "body", "id")
    assert linked.count() == quotes.conversation_rows(linked, "id").count() == 0


def test_conversations_as_rows(spark, monkeypatch):
    # Intermediate tables of a chain of n turns hold one id a row, 2 n rows of jumps for each round, and no lists.
    kept, wide = [], quotes.durable
    monkeypatch.setattr(quotes, "durable", lambda t: kept.append(wide(t)) or kept[-1])
    chain = spark.range(300).selectExpr("id", "nullif(id - 1, -1) as parent_id", "'t' as text")
    kept.clear()
    rows = quotes.conversation_rows(chain, "id").collect()
    assert sorted((r.leaf_id, r.back, r.id) for r in rows) == [(299, k, 299 - k) for k in range(300)]
    assert not any("array" in kind for t in kept for _, kind in t.dtypes)
    assert sum(t.count() for t in kept if "_leaf" in t.columns) == 300
