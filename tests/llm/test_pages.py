import os
import random
import re

import numpy as np
import pytest
import xxhash

from sluice.llm import pages

FRAME = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<nav><ul><li><a>Home</a></li><li>News</li></ul></nav><div class="cookie-notice">We use cookies</div>"""
END = "<aside>Also read</aside><section id=comments><p>First!</p></section><footer>&copy; 2020 Me</footer></body></html>"


def text(body):
    return [t for t, place in pages.page_lines(body) if place == pages.ARTICLE]


def test_article_only():
    body = FRAME + "<article><header><h1>Head</h1></header><p><b>One\n two<br>three &amp; four<p>Next</p>" \
        "<div class='ad'>Buy</div><form><label>Mail</label></form><ul><li>a<li>b</ul><footer>tags</footer></article>" + END
    assert text(body) == ["Head", "One two three & four", "Next", "a", "b"]


def test_article_before_main_and_no_comments():
    body = "<main><p>intro</p><article class='post has-sidebar'><p>Body</p></article><p>Related</p>" \
        "<section id=comments><article><p>First!</p></article></section></main><article class=comment><p>Me too</p></article>"
    assert text(body) == ["Body"]
    assert text("<header><h1>Site</h1></header><main><h1>T</h1><p>x</p></main><div>y</div>") == ["T", "x"]


def test_unclosed_frame_ends_at_the_article():
    assert text("<nav><a>menu<article><p>Body</p></article>") == ["Body"]


@pytest.mark.parametrize("body, want", [("", []), ("plain text", ["plain text"]), ("<p>a</p></p></div>b", ["a", "b"]), ("<table><tr><td>x<td>y<tr><td>z</table>", ["x y", "z"])])
def test_open_lines(body, want):
    assert [t for t, place in pages.page_lines(body) if place == pages.OPEN] == want


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequence(monkeypatch):
    rng = random.Random(8)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(14))] for _ in range(2))
        marks = pages.common(a, b)
        rest = iter(b)
        assert marks.sum() == lcs(a, b) and all(x in rest for x, m in zip(a, marks) if m)
    long = [rng.randrange(40) for _ in range(20_000)]
    other = [x for x in long if rng.random() < 0.9]
    assert pages.common(long, other).sum() == len(other)


def test_nearest_page_of_the_host(spark):
    paths = [("h", f"/a/{i:03}") for i in range(40)] + [("h", "/b/x"), ("h", "/b/xy"), ("g", "/only")]
    df = spark.createDataFrame([(h, p, [i]) for i, (h, p) in enumerate(paths)], "host string, path string, lines array<bigint>")
    got = {(r.host, r.path): r.near for r in pages.neighbours(df).collect()}
    assert len(got) == len(paths)
    assert got["g", "/only"] is None
    assert got["h", "/b/x"] == [41] and got["h", "/b/xy"] == [40]
    assert got["h", "/a/000"] == [1] and got["h", "/a/039"] == [38] and got["h", "/a/020"] in ([19], [21])


def brute(rows):
    """Texts by comparing every page with the page next to its path, lines aligned by a plain table."""
    lines = {i: pages.page_lines(html or "") for i, (_, _, html) in enumerate(rows)}

    def address(url):
        found = re.match(r"[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)", url or "")
        return (found[1].lower(), found[2].rstrip("/")) if found else ("", "")

    top = {}
    for i, (_, url, _) in enumerate(rows):
        own = [t for t, _ in lines[i]]
        key = address(url)
        if key not in top or (len(own), own_hashes(own)) > (len(top[key]), own_hashes(top[key])):
            top[key] = own
    order = sorted(top)

    def near(key):
        at = order.index(key)
        shared = lambda k: len(os.path.commonprefix([k[1], key[1]])) if k[0] == key[0] else -1
        before, after = (order[at - 1] if at else (None, "")), (order[at + 1] if at + 1 < len(order) else (None, ""))
        pick = after if shared(after) > shared(before) else before
        return top[pick] if pick[0] == key[0] else []

    out = []
    for i, (page, url, _) in enumerate(rows):
        own, theirs = [t for t, _ in lines[i]], near(address(url))
        marks = aligned(own, theirs)
        if all(marks) and len(own) == len(theirs):
            marks = [False] * len(own)
        keep = [place == pages.ARTICLE or (place == pages.OPEN and not m) for (_, place), m in zip(lines[i], marks)]
        out.append((page, url, "\n\n".join(t for t, k in zip(own, keep) if k)))
    return out


def own_hashes(own):
    return [int(np.uint64(xxhash.xxh64_intdigest(t)).view(np.int64)) for t in own]


def aligned(a, b):
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            table[i + 1][j + 1] = table[i][j] + 1 if a[i] == b[j] else max(table[i][j + 1], table[i + 1][j])
    marks, i, j = [False] * len(a), len(a), len(b)
    while i and j:
        if a[i - 1] == b[j - 1]:
            i, j = i - 1, j - 1
            marks[i] = True
        elif table[i][j - 1] >= table[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return marks


@pytest.mark.parametrize("hot", [2, 1000])
def test_whole_result_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(pages, "HOT_PAGES", hot)
    rng = random.Random(4)
    rows = []
    for i in range(120):
        host = rng.choice(["x.org", "y.org", "Z.org"])
        frame = [f"<div>{host} {w}</div>" for w in ("menu", "top", "legal")]
        body = [f"<p>line {rng.randrange(10**6)}</p>" for _ in range(rng.randrange(4))]
        url = f"https://{host}/{rng.choice('abc')}/{rng.randrange(60)}" if i % 4 else f"https://{host}/index.php?id={i}"
        rows.append((i, url, "<body>" + frame[0] + frame[1] + "".join(body) + frame[2] + ("<article><p>own</p></article>" if i % 11 == 0 else "") + "</body>"))
    rows += [(200, None, "<p>a"), (201, "https://x.org/", None), (None, "no url", "<p>b")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = [(r.page_id, r.url, r.text) for r in pages.main_text(df, "html", "url", "page_id").collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_shared_lines_go_where_structure_is_silent(spark):
    page = "<html><body><div>Site name</div><div>Menu</div><p>{}</p><div>All rights reserved</div></body></html>"
    rows = [
        (1, "http://x.org/a/1?q=1", page.format("First story")), (2, "https://x.org/a/2", page.format("Second story")),
        (3, "https://x.org/a/2#top", page.format("Second story")), (4, "https://y.org/1", page.format("Alone")),
        (5, None, None), (6, "not a url", "<article>kept &nbsp; text</article>"), (None, "https://x.org/a/1", ""),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as host", "2 as path", "3 as near")
    got = {(r.page_id, r.url): r.text for r in pages.main_text(df, "html", "url", "page_id").collect()}
    frame = "Site name\n\nMenu\n\nAlone\n\nAll rights reserved"
    assert got == {
        (1, rows[0][1]): "First story", (2, rows[1][1]): "Second story", (3, rows[2][1]): "Second story",
        (4, rows[3][1]): frame, (5, None): "", (6, "not a url"): "kept text", (None, rows[6][1]): "",
    }
    assert pages.main_text(df.limit(0), "html", "url", "page_id").count() == 0


def test_names_that_only_contain_a_mark_lose_nothing():
    body = "<article><h2 id='search-engines'>Search engines</h2><section id='share-buybacks'><p>Bought</p></section>" \
        "<h2 id=search>Search</h2><div class='share-buttons'>Tweet</div><div id='ad-1'>Buy</div></article>"
    want = ["Search engines", "Bought", "Search"]
    assert text(body) == want
    for wrap in ("<div class='content with-sidebar'>", "<div id=page class='site no-sidebar'>", "<div class=sidebar>", "<div id=banner>"):
        assert text(f"<body>{wrap}{body}<p>beside</p></div></body>") == want, wrap
    # An article elsewhere stands before one inside layout, and comments are none of the page's.
    assert text("<div id=sidebar><article>Recent</article></div><main>intro<article>Body</article></main>") == ["Body"]
    assert text("<div id=sidebar><article>Recent</article></div><main>Text</main>") == ["Text"]
    assert text("<main>intro<div class=sidebar><article>Body</article></div></main>") == ["Body"]
    assert text("<div class=comments><article>First!</article></div><article>Body</article>") == ["Body"]


def test_a_page_of_frame_is_aligned(spark):
    page = "<nav>Home</nav><div class=promo><p>Shop</p><article><p>{}</p></article><form>Mail</form></div>"
    rows = [(i, f"https://x.org/{i}", page.format(f"Story {i}")) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in pages.main_text(df, "html", "url", "page_id").collect()} == {i: f"Story {i}" for i in range(3)}


def test_lines_beside_an_article_are_aligned(spark):
    page = "<nav>Home</nav><div>Site</div><main><p>{}</p><article><h1>Story</h1><p>{}</p></article><p>More of it</p></main>" \
        "<div class=ad>Buy {}</div><div id=sidebar><article>Recent {}</article></div><div>Legal</div>"
    rows = [(i, f"https://x.org/{i}", page.format(f"Intro {i}", f"Body {i}", i, i)) for i in range(3)]
    # Nothing to compare with: no other path, or a copy.
    rows += [(10, "https://y.org/1", rows[0][2]), (20, "https://z.org/1", rows[0][2]), (21, "https://z.org/2", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(df, "html", "url", "page_id").collect()}
    # What an article shares with its neighbour stays, and what frame does not share goes.
    assert got == {i: f"Intro {i}\n\nStory\n\nBody {i}" for i in range(3)} | dict.fromkeys((10, 20, 21), "Story\n\nBody 0")


def test_pages_with_an_article_are_aligned_too(spark):
    page = "<nav>Home</nav><article><p>{}</p><p>Said by all</p></article><footer>Legal</footer>"
    rows = [(i, f"https://x.org/{i}", page.format(f"Story {i}")) for i in range(3)]
    rows += [(10, "https://y.org/1", rows[0][2]), (20, "https://z.org/1", rows[0][2]), (21, "https://z.org/2", rows[0][2]), (30, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.text, r.n_shared) for r in pages.main_text(df, "html", "url", "page_id").collect()}
    # The nearest page has all lines but one; a page alone is compared with nothing, and a copy has all lines.
    assert got == {i: (f"Story {i}\n\nSaid by all", 3) for i in range(3)} | {
        10: ("Story 0\n\nSaid by all", 0), 20: ("Story 0\n\nSaid by all", 4), 21: ("Story 0\n\nSaid by all", 4), 30: ("", 0)}
