from itertools import product

import numpy as np
import pytest

from binlens.llm import html_extraction as H


@pytest.fixture(scope="module")
def field():
    return H.train(H.labelled_pages())


def test_labelled_pages_not_seen_in_training(field):
    wrong = total = 0
    for page in H.labelled_pages(200, seed=1234):
        found, labels = H.read_labels(page)
        wrong += sum(a != b for a, b in zip(field.decode(found, {}), labels))
        total += len(labels)
    assert wrong / total < 0.01


def test_viterbi_is_the_best_path(field):
    for page in H.labelled_pages(30, seed=77):
        found = H.read_labels(page)[0][:7]
        e = [field.emission(b, {}) for b in found]

        def value(path):
            v = field.start[path[0]] + sum(x for x, y in zip(e, path) if y)
            return v + sum(field.transitions[a, b] for a, b in zip(path, path[1:]))
        best = max(product((0, 1), repeat=len(found)), key=value)
        assert abs(value(best) - value(field.decode(found, {}))) < 1e-9


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Site name</a></header><nav><ul><li><a href=a>Home</a><li><a href=b>News</a></ul></nav>
<div class="cookie-banner"><p>We use cookies on this page. Accept?</p></div><!-- <p>hidden</p> -->
<article><h1>Title &amp;  more</h1><p>First&nbsp;paragraph of the
  article, with a <a href="x">link</a>.<br>Same paragraph.<p>Second one &lt;b&gt; &eacute;&#233; a < b.
<div class="ad">Buy now.</div><ul><li>One point.</li><li>Another point.</li></ul></article>
<aside><h3>Related</h3><ul><li><a href=c>Other story</a></li></ul></aside>
<form><label>Search</label><input><button>Go</button></form>
<section id="comments"><h3>Comments</h3><div class="comment"><p>I like this article very much. Thank you.</p></div></section>
<footer>&copy; Site. All rights reserved.</footer></body></html>"""


def test_page(field):
    assert H.main_text(PAGE, field, {}) == "\n".join([
        "Title & more", "First paragraph of the article, with a link. Same paragraph.", "Second one <b> éé a < b.", "One point.",
        "Another point."])


@pytest.mark.parametrize("page", ["", None, "<", "<p", "text only", "<!-- open", "<script>x", "<p>a<p", "</div></p>x", "<a href='", "&#xD800; &bogus;",
                                  "<div " * 2000, "<p>" * 5000 + "x", "<a b=\"" * 300, "<![CDATA[x]]>", "\x00<p>\x00"])
def test_broken_pages(field, page):
    assert isinstance(H.main_text(page, field, {}), str)


def test_cut_pages_keep_their_beginning(field):
    whole = H.main_text(PAGE, field, {})
    for n in range(0, len(PAGE), 97):
        H.main_text(PAGE[:n], field, {})
    assert H.main_text(PAGE[:PAGE.index("<aside>")], field, {}) == whole


def test_pages_table(spark, field):
    rows = [(1, "u", PAGE, "x", "y"), (2, None, None, "x", "y"), (None, "u", "", "x", "y"), (1, "u", PAGE, "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    got = H.extract(df, field).collect()
    assert [r.n_chars for r in got] == [len(r.text) for r in got] and sum(r.n_chars > 0 for r in got) == 2
    assert H.extract(df.where("false"), field).count() == 0


def test_given_pages_give_their_article(spark, field):
    import html
    import re

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in H.extract(rows, field, passthrough=("page_id", "html")).limit(100).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(p for p in parts if p)


def test_training_gains(field):
    pages = [H.read_labels(p) for p in H.labelled_pages(40, seed=5)]
    flat = H.Field({}, 0.0, np.zeros((2, 2)), np.zeros(2))
    right = [sum(a == b for f, y in pages for a, b in zip(m.decode(f, {}), y)) for m in (flat, field)]
    assert right[1] > right[0]


def test_deep_pages_take_linear_memory_and_time():
    import time
    import tracemalloc
    from binlens.llm import html_extraction as H
    page = "<div class='nav'>" * 60_000 + "<p>end of the line.</p>" + "</div>" * 60_000 + "<p>after</p>"
    tracemalloc.start()
    start = time.time()
    found = H.blocks(page)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [b.text for b in found] == ["end of the line.", "after"]
    assert found[0].path == (("t=div", "g=nav", "t=p"), "o=p") and found[1].path == (("t=p",), "o=p")
    assert peak < 64 << 20 and time.time() - start < 20


def test_words_anywhere_in_a_block_are_seen():
    from binlens.llm import html_extraction as H
    far = H.Block(((), None), "word " * 2_000 + "all rights reserved", 0)
    assert "x=rights" in H.text_features(far)
