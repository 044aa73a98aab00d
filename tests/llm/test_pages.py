"""Main text of pages: marks of the page, differencing of neighbours, alignment against plain dynamic programming."""

import random
import re
from html import unescape

import pytest
from pyspark.sql import functions as F

from rowharbor.llm import pages


def texts(html):
    return [line.text for line in pages.read_lines(html)]


def test_given_pages_keep_their_article(spark, sf_dir):
    """The given pages mark their articles, so a plain cut at tags gives the same text."""
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r for r in pages.extract(table).collect()}
    assert len(got) == table.count()
    for page in table.collect():
        article = re.search(r"<article>(.*?)</article>", page["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " " if "br" in b else "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        row = got[page["page_id"]]
        assert row["text"] == "\n\n".join(b for b in blocks if b)
        assert row["n_chars"] == len(row["text"]) and row["url"] == page["url"]


def test_marks_of_the_page():
    page = """<html><head><title>no</title><style>p{}</style></head><body class="has-sidebar"><header><a>Site</a></header>
    <nav><ul><li>Home</ul></nav><form><input><p>Search</form><div id="cookie-banner"><p>We use cookies</div>
    <script>if (a < b) document.write("<p>no</p>")</script><!-- <p>no</p> -->
    <article><header><h1>A &lt;title&gt;</h1><p>by somebody</p></header><p>One  &amp;&nbsp;<b>two</b><br>three<p>fo<i>ur</i>
    <div class="share"><a>Share</a></div><ul><li>first<li>second</ul><table><tr><td>a<td>b</table>&#x41;&eacute;
    <aside><p>Related</p></aside><pre> kept
     code </pre><section class="comments"><article><p>Nice!</p></article></section></article>
    <div class="adText"><p>Buy</div><div role="contentinfo">no</div><p hidden>no<footer><p>&copy; x</footer>"""
    assert texts(page) == ["A <title>", "One & two three", "four", "first", "second", "a b", "Aé", "kept code"]
    assert texts("<form><main><p>Inside a form</main></form>") == ["Inside a form"]
    assert texts("<nav><li>Menu<article><p>Text</article>") == ["Text"]
    assert texts("plain < text & more &amp") == ["plain < text & more &"]
    assert texts("<p>cut off <a href=\"x") == ["cut off"]
    assert texts("<p>a</div></span></p><p>b</b> c") == ["a", "b c"]
    assert texts("") == [] and texts("<script>never closed <p>x") == [] and texts("<!-- open <p>x") == []


def site(host, n, notice="We may send you letters."):
    """Pages without marks: the same links, notice and closing line around an article of their own."""
    rows = []
    for i in range(n):
        own = "".join(f"<p>Story {i} part {k} of {host}.</p>" for k in range(4))
        rows.append((f"https://{host}/a/{i:04}?q=1#top", f"<div>All stories</div><div>{notice}</div><p>Story {i}</p>{own}<div>Made in {host}</div>",
                     "\n\n".join([f"Story {i}", *[f"Story {i} part {k} of {host}." for k in range(4)]])))
    return rows


def run(spark, rows):
    table = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], "page_id bigint, url string, html string")
    table = table.withColumn("key", F.lit(1)).withColumn("cut", F.lit("x")).withColumn("host", F.lit("y"))
    got = {r["page_id"]: r["text"] for r in pages.extract(table).collect()}
    assert len(got) == len(rows)
    for i, (url, _, expected) in enumerate(rows):
        assert got[i] == expected, url


def test_shared_lines_go_where_nothing_is_marked(spark):
    """One host with most pages, more than a block; small hosts beside it; a host of one page."""
    rows = site("big.example", 600) + site("two.example", 2) + site("other.example", 30, "Another notice.")
    rows.append(("https://lone.example/x", "<div>All stories</div><p>Alone</p>", "All stories\n\nAlone"))
    random.Random(1).shuffle(rows)
    run(spark, rows)


def test_copies_tell_nothing(spark):
    """An article at two URLs stays whole in both: the next neighbour is compared."""
    rows = site("copy.example", 12)
    url, html, text = rows[5]
    rows.append(("https://copy.example/a/0005/print", html.replace("<p>Story 5</p>", "<p>Story 5</p> "), text))
    rows.append((url, html, text))
    run(spark, rows)


def test_quotes_in_marked_articles_stay(spark):
    """Prose of a marked article stays though a neighbour has it too; other shared lines inside go."""
    rows = [(f"http://news.example/{i}", f"<div>Top</div><article><div>Print this page</div><h1>T{i}</h1><p>Shared quote of all.</p><p>Own {i} text "
             f"that is long enough {i}.</p></article>", f"T{i}\n\nShared quote of all.\n\nOwn {i} text that is long enough {i}.") for i in range(5)]
    run(spark, rows)


def test_odd_rows(spark):
    rows = [(None, None), (None, "<p>no url</p>"), ("", ""), ("not a url", "<p>x"), ("http://h.example", None),
            ("http://h.example", "<p>same"), ("http://h.example", "<p>same"), ("HTTP://H.example:80//", "<p>" + "long " * 300_000)]
    table = spark.createDataFrame([(None if i == 3 else i % 3, u, h) for i, (u, h) in enumerate(rows)], "page_id bigint, url string, html string")
    got = pages.extract(table.unionAll(table)).collect()
    assert len(got) == 2 * len(rows)
    assert {r["text"] for r in got} == {"", "no url", "x", "same", ("long " * 300_000).strip()}
    assert pages.extract(table.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_alignment_is_a_longest_common_subsequence(seed, monkeypatch):
    rng = random.Random(seed)
    a, b = ([rng.randrange(6) for _ in range(rng.randrange(40))] for _ in range(2))
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    for bits in (1 << 28, 8):
        monkeypatch.setattr(pages, "HELD_BITS", bits)
        places = pages.common_lines(a, b)
        assert len(places) == table[-1][-1] and places == sorted(set(places))
        rest = iter(b)
        assert all(a[i] in rest for i in places)
