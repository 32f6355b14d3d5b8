"""Main text: planted articles, the scan against brute force, markup and odd pages."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from leadline.llm import main_text
from leadline.llm.main_text import blocks_of, extract_text, fit, main_blocks, region_of, standard_weights, train

SCHEMA = "page_id long, url string, html string, text string, _page string"


def _text(count, stop="."):
    return " ".join(["lorem"] * count) + stop


# Layouts of their own: ``A`` lines belong to the article, ``N`` lines do not.
PLANTED = {
    "semantic": [
        ("", "<header><div class='logo'>"), ("N", _text(2, "")), ("", "</div><nav><a href=/x>"), ("N", "Home"), ("", "</a></nav></header>"),
        ("", "<div class='cookie-banner'>"), ("N", _text(12)), ("", "</div><main><article><h1>"), ("A", _text(5, "")), ("", "</h1><p>"),
        ("A", _text(30)), ("", "<p>"), ("A", "So."), ("", "</article><section id='comments'><div class='comment'><p>"), ("N", _text(30)),
        ("", "</div></section></main><aside class='sidebar'>"), ("N", _text(14)), ("", "</aside><footer>"), ("N", _text(9)), ("", "</footer>"),
    ],
    "old": [
        ("", "<div id=wrapper><div id=nav><ul><li><a href=1>"), ("N", "One"), ("", "</a><li><a href=2>"), ("N", "Two"), ("", "</a></ul></div><div id=content><h1>"),
        ("A", _text(4, "")), ("", "</h1><p>"), ("A", _text(50)), ("", "<p>"), ("A", _text(1)), ("", "</p><div class=ads>"), ("N", _text(20)),
        ("", "</div><p>"), ("A", _text(30)), ("", "</p></div><div id=comments><div>"), ("N", _text(20)), ("", "</div><div>"), ("N", _text(44)),
        ("", "</div></div><form><p>"), ("N", _text(7)), ("", "<input></form><div id=footer>"), ("N", _text(10)), ("", "</div></div>"),
    ],
    "notice": [
        ("", "<div class='notice'>"), ("N", _text(14)), ("", "</div><article><h2>"), ("A", _text(4, "")), ("", "</h2><p>"), ("A", _text(15)),
        ("", "</p><p class='notice'>"), ("N", _text(11)), ("", "</p><ul><li>"), ("A", _text(5)), ("", "<li>"), ("A", _text(2, "")),
        ("", "</ul></article><div class='comment-section'><p>"), ("N", _text(50)), ("", "</p></div>"),
    ],
}


@pytest.mark.parametrize("name", PLANTED)
def test_planted_articles(name):
    page = "<!doctype html><html><body>" + "".join(part for _, part in PLANTED[name])
    assert main_blocks(page, standard_weights()) == [part for kind, part in PLANTED[name] if kind == "A"]


def test_region_against_all_runs():
    rng = random.Random(2)
    for _ in range(300):
        count = rng.randint(0, 9)
        gains = [rng.choice([0.0, 0.5, 1.0, 3.0]) for _ in range(count)]
        costs = [rng.choice([0.0, 0.5, 2.0, 4.0]) for _ in range(count)]
        total = lambda a, b: sum(gains[a:b]) - sum(costs[a + 1 : b])
        best = max([total(a, b) for a in range(count) for b in range(a + 1, count + 1)], default=0.0)
        first, last = region_of(gains, costs)
        assert (total(first, last) if last > first else 0.0) == max(best, 0.0)


def test_markup():
    page = (
        "<p title=\"a > b\">One&nbsp;&amp\n two<br>three</p><script>if (a</b/) '<p>x</p>'</script><!-- <p>no</p> --><p>Fo<b>u</b>r &lt;p&gt;"
        "<p>5 < 6<ul><li>a<li>b</ul><style>p{}</style><textarea><p>typed</textarea>tail &am<"
    )
    assert [block.text for block in blocks_of(page)] == [
        "One & two three", "Four <p>", "5 < 6", "a", "b", "tail &am<"
    ]
    assert blocks_of("") == blocks_of("<p></p> \n<!-- never closed <p>x") == []
    assert [block.text for block in blocks_of("<p>kept</p><p class='cut")] == ["kept"]
    assert [block.text for block in blocks_of("a</p></div></b>b<b><p>c</b>d")] == ["a", "b", "cd"]


def test_deep_and_long_pages_take_linear_time():
    deep = "<div>" * 20_000 + "<p>word here." + "</b></i></div>" * 20_000
    assert [block.text for block in blocks_of(deep)] == ["word here."]
    long = "<article>" + "<p>some words here.</p>" * 50_000 + "</article>"
    assert len(main_blocks(long, standard_weights())) == 50_000
    assert [block.text for block in blocks_of("<a b='" * 20_000 + "text")] in ([], ["text"])


def test_extract(spark):
    page = "<nav><a>Menu</a></nav><article><h1>Title</h1><p>" + _text(20) + "</p></article><footer>" + _text(8) + "</footer>"
    rows = [(1, "u", page, "clash", "clash"), (1, "u", page, "x", "y"), (None, None, None, None, None), (3, "w", "", "a", "b"),
            (4, "v", "<nav>only menu</nav>", "a", "b")]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = extract_text(frame, "html", "page_id", "url")
    assert found.columns == ["page_id", "url", "text", "n_blocks", "n_chars"]
    text = "Title\n\n" + _text(20)
    wanted = [(1, "u", text, 2, len(text))] * 2 + [(None, None, "", 0, 0), (3, "w", "", 0, 0), (4, "v", "", 0, 0)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    assert extract_text(frame.limit(0), "html", "page_id").collect() == []


def test_training(spark):
    """Labelled pages of a site whose class names mean nothing elsewhere."""
    site = "<div class='zorg'><p>{}</p></div><div class='blip'><p>{}</p></div>"
    rows = [(site.format(_text(30) + str(i), _text(25) + str(i)), _text(30) + str(i)) for i in range(40)] + [(None, "x"), ("<p>y", None)]
    weights = train(spark.createDataFrame(rows, "html string, content string"))
    assert main_blocks(site.format("Kept words stand here.", "Other words stand here."), weights) == ["Kept words stand here."]
    assert main_blocks("<p>anything", fit([])) == ["anything"] and main_text.TAG_SCALE > 0


def test_given_pages(spark):
    """Every page of the smallest table: the blocks of its article element, and nothing else."""
    frame = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for row in extract_text(frame, "html", "html").collect():
        inner = row.html.split("<article>")[1].split("</article>")[0]
        assert row.text == "\n\n".join(block.text for block in blocks_of(inner))
    assert frame.where(F.col("html").contains("<article>")).count() == frame.count()
