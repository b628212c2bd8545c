"""Reading broken and deep pages in linear time, and labelling pages that name nothing."""

from __future__ import annotations

import time

import numpy as np
import pytest

from gridmetrics.llm import html_blocks

HOSTILE = {
    "unclosed tags": "<a " * 350_000,
    "unclosed quotes": '<a "' * 250_000,
    "mixed quotes": "<a '\"" * 200_000 + ">",
    "unclosed names": "<a" * 500_000,
    "unclosed declarations": "<!" * 500_000,
    "deep": "<div>" * 100_000 + "x" + "</div>" * 100_000,
    "deep with text": "<div>x" * 100_000,
    "end tags of nothing": "<div>" * 1000 + "</x>" * 200_000,
    "open inline elements": "<b>" * 100_000 + "<hr>" * 100_000,
    "inline end tags over blocks": "<b>" + "<div>" * 50_000 + "</b>" * 100_000,
}


@pytest.mark.parametrize("kind", HOSTILE)
def test_hostile_pages_take_linear_time(kind):
    def seconds(html):
        start = time.process_time()
        html_blocks.vectors(html_blocks.blocks_of(html))
        return time.process_time() - start

    whole, quarter = HOSTILE[kind], HOSTILE[kind][: len(HOSTILE[kind]) // 4]
    small, large = min(seconds(quarter) for _ in range(2)), seconds(whole)
    assert large < 10 * small + 1.0, "four times the length: four times the time, not sixteen"
    assert large < 30


def test_blocks_of_broken_markup():
    read = lambda html: [(b.path, b.text, b.linked) for b in html_blocks.blocks_of(html)]
    assert read('<p>a</p><script>if (a<b) "x </script><p>c"d</p>e') == [
        ([["p"]], "a", 0), ([["p"]], 'c"d', 0), ([], "e", 0),
    ]
    assert read("1 < 2 <b>and</b> 3 &lt; 4") == [([], "1 < 2 and 3 < 4", 0)]
    assert read('<div class="x>y" id=z>in <a href="?a>b">link</a></div>') == [([["div", "x", "y", "z"]], "in link", 4)]
    assert read("<ul><li>a<li>b</ul><p>c<div>d</div><!-- <p>no --> <!doctype x> e") == [
        ([["ul"], ["li"]], "a", 0), ([["ul"], ["li"]], "b", 0), ([["p"]], "c", 0), ([["div"]], "d", 0), ([], "e", 0),
    ]
    assert read("<b>x<div>y</b>z</div>w") == [([], "x", 0), ([["div"]], "yz", 0), ([], "w", 0)]
    assert read("") == read("<p> </p>") == read("<a ") [:0] == []


def test_pages_that_name_no_part(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect() if r.html]
    model = html_blocks.train(pages[:150])
    for names in (True, False):
        blocks = [html_blocks.blocks_of(html) for html in pages[150:]]
        wanted = [html_blocks.weak_labels(b) for b in blocks]
        seen = [b if names else html_blocks.bare(b) for b in blocks]
        got = model.label([html_blocks.vectors(b) for b in seen])
        pairs = [(g, w) for g, w in zip(got, wanted) if w is not None]
        overlap = np.mean([2 * (g & w).sum() / (g.sum() + w.sum()) for g, w in pairs])
        assert len(pairs) > 50 and overlap > (0.99 if names else 0.95), (names, overlap)


def test_odd_tables(spark):
    schema = "page_id long, url string, html string, text string, n_blocks int"
    model = html_blocks.train([])
    empty = spark.createDataFrame([], schema)
    assert html_blocks.extract(empty, model).count() == 0 and html_blocks.learned(empty) is not None
    rows = [(1, None, None, "t", 1), (2, "u", "", "t", 1), (2, "u", "", "t", 1), (3, "u", "<p>x" * 50_000, "t", 1)]
    got = html_blocks.extract(spark.createDataFrame(rows, schema), model).collect()
    assert sorted((r.page_id, r.n_blocks) for r in got) == [(1, 0), (2, 0), (2, 0), (3, 50_000)]
