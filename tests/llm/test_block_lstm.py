import random
import re
from html import escape, unescape
from html.parser import HTMLParser

import numpy as np
import pytest

from flowtide.llm import block_lstm
from flowtide.llm.html_blocks import BLOCK_TAGS, blocks
from flowtide.llm.page_templates import MARK, Material, Page
from flowtide.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


class Reference(HTMLParser):
    """Blocks by the library's parser, for well-formed pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.now, self.skip = [], [], 0

    def cut(self):
        text = " ".join("".join(self.now).split())
        self.out += [text] if text else []
        self.now = []

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "title")
        if tag in BLOCK_TAGS:
            self.cut()
        elif tag == "br":
            self.now.append(" ")

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "title")
        if tag in BLOCK_TAGS:
            self.cut()

    def handle_data(self, data):
        if not self.skip:
            self.now.append(data)


def material(pick, n=8):
    word = lambda: "".join(pick.choice("abdeghiklmnorstuéü") for _ in range(pick.randrange(2, 9)))
    text = lambda low, high: " ".join(word() for _ in range(pick.randrange(low, high))).capitalize() + pick.choice([".", ".", "!", " & <more>"])
    return Material(text(2, 8), [text(1, 60) for _ in range(n)])


def test_blocks_equal_the_library_on_rendered_pages():
    pick = random.Random(4)
    for _ in range(60):
        html = Page(pick, material(pick), [material(pick)]).html()
        reference = Reference()
        reference.feed(html)
        reference.close()
        reference.cut()
        assert [b.text for b in blocks(html)] == reference.out


@pytest.mark.parametrize(
    "html,want",
    [
        ("<p>one<p>two", ["one", "two"]),
        ("a &amp;amp; b&nbsp;\n\tc&copy;&#x41;&lt;", ["a &amp; b c©A<"]),
        ("3 < 4 and 5 > 2<3", ["3 < 4 and 5 > 2<3"]),
        ("<p title='a > b' class=\"x>y\">in</p>out", ["in", "out"]),
        ("<!-- <p>no</p> -->yes<!-- open", ["yes"]),
        ("<!-->kept<!--->too", ["kepttoo"]),
        ("<script>var a='</p>'+\"<p>\"</script>x<style>p{}</style>y<SCRIPT>z", ["xy"]),
        ("<b>bo<i>ld</b> te</i>xt<br>line", ["bold text line"]),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", ["a", "b", "c", "d", "e"]),
        ("<p>end of <a href='x", ["end of"]),
        ("<p data-x=\"open>text</p>", ["text"]),
        ("", []),
        (None, []),
        ("</p></div><br/>text</body></html>", ["text"]),
        ("<textarea><b>x</b></textarea>", ["<b>x</b>"]),
    ],
)
def test_blocks_of_broken_pages(html, want):
    assert [b.text for b in blocks(html)] == want


def test_paths_and_links():
    found = blocks('<body><div class="post-body siteMain" id=c><p>x<p>y <a href=1>zz</a></div><td>q')
    assert found[0].path == ("body", "div", ".post", ".body", ".site", ".main", ".c", "p") and found[1].path == found[0].path
    assert found[1].link_chars == 2 and found[2].path == ("body", "td")
    assert [b.path for b in blocks("<table><tr><td>a<tr><td>b")] == [("table", "tr", "td")] * 2


def test_gradients_equal_differences():
    pick = np.random.default_rng(0)
    hasher = block_lstm.Hasher()
    pages = [block_lstm.sequence(blocks(h), hasher) for h in ("<p>a<p>b c<div class=x>d</div>", "<h1>q</h1>", "<li>r<li>s.")]
    labels = np.array([1, 0, 1, 0, 1, 1], np.float32)
    model = block_lstm.Model(*[v.astype(np.float64) for v in block_lstm.initial_model(3, hidden=4)])
    _, found = block_lstm.gradients(model, pages, labels)

    def loss():
        return block_lstm.gradients(model, pages, labels)[0]

    for name in ("forward", "backward", "out", "inputs"):
        values = getattr(model, name)
        for _ in range(8):
            if name == "inputs":
                k = pick.integers(len(found["seen"]))
                at, slot = (found["seen"][k], pick.integers(values.shape[1])), None
                slot = (k, at[1])
            else:
                at = slot = tuple(pick.integers(n) for n in values.shape)
            old = values[at]
            values[at] = old + 1e-3
            high = loss()
            values[at] = old - 1e-3
            low = loss()
            values[at] = old
            assert abs((high - low) / 2e-3 - found[name][slot]) < 2e-3


def test_batches_and_lengths_do_not_change_scores():
    pick, hasher = random.Random(2), block_lstm.Hasher()
    model = block_lstm.initial_model(1)
    pages = [block_lstm.sequence(blocks(Page(pick, material(pick), [material(pick)]).html()), hasher) for _ in range(9)]
    together = block_lstm.scores(model, pages)
    alone = np.concatenate([block_lstm.scores(model, [p]) for p in pages])
    assert np.allclose(together, alone, atol=1e-5)
    # one step at a time, with nothing padded
    page, states = pages[0], []
    gates = block_lstm.Batch([page]).gates(model)
    half = gates.shape[1] // 2
    for part, weights, turn in ((gates[:, :half], model.forward, 1), (gates[::-1, half:], model.backward, -1)):
        h = c = np.zeros(block_lstm.HIDDEN)
        rows = []
        for z in part:
            i, f, o, g = np.split(z + h @ weights, 4)
            sig = lambda x: 1 / (1 + np.exp(-x))
            c = sig(f) * c + sig(i) * np.tanh(g)
            h = sig(o) * np.tanh(c)
            rows.append(h)
        states.append(np.array(rows)[::turn])
    want = 1 / (1 + np.exp(-(np.concatenate(states, 1) @ model.out[:-1] + model.out[-1])))
    assert np.allclose(alone[: len(want)], want, atol=1e-4)


@pytest.fixture(scope="module")
def model(spark):
    return block_lstm.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_unseen_layouts_and_text(model):
    pick = random.Random(77)
    others = [material(pick) for _ in range(30)]
    right = total = 0
    for page, labels in block_lstm.rendered(others, 300, seed=5):
        found = block_lstm.article_blocks([page], model, block_lstm.Hasher())[0]
        right += int((found == (labels > 0)).sum())
        total += len(labels)
    assert right > 0.985 * total


HAND = """<!doctype html><html><head><title>T</title></head><body>
<header><h1>The Site</h1><nav><a href=/>Home</a> <a href=/n>News</a></nav></header>
<div class="cookie-bar"><p>We store cookies on your device to make this site work better for you.</p></div>
<div id="content"><div class="article-body"><h1>Real title</h1><p>First paragraph of the story, with some words in it.</p>
<div class="ad-box">Buy these shoes today, they are better than all the others.</div>
<p>Second paragraph, which goes on for a while &amp; says more.</p><ul><li>A point that matters.</li><li>Another point.</li></ul><p>Short end.</p></div></div>
<aside class="sidebar"><h3>More</h3><ul><li><a href=/1>Other story</a></li></ul><p>A teaser text for another story that one could read.</p></aside>
<section id="comments"><h2>2 comments</h2><div class="comment"><b>Ann</b><p>I liked the story very much, it reminds me of my own.</p></div>
<div class="comment"><p>Not so sure about that, the second paragraph is wrong.</p></div></section>
<form class="newsletter"><label>Your mail</label><input><button>Go</button></form>
<footer><p>Copyright 2020, all rights reserved.</p></footer></body></html>"""
ARTICLE = [
    "Real title", "First paragraph of the story, with some words in it.", "Second paragraph, which goes on for a while & says more.",
    "A point that matters.", "Another point.", "Short end.",
]


def test_a_page_written_by_hand(spark, model):
    frame = spark.createDataFrame([(1, "u", HAND, "x", 3), (2, None, None, "x", 3), (None, "v", "", "x", 3), (1, "u", HAND, "x", 3)],
                                  "page_id bigint, url string, html string, text string, `a.b` int")
    rows = block_lstm.extract(frame, model).collect()
    assert [r.text for r in rows] == ["\n\n".join(ARTICLE), "", "", "\n\n".join(ARTICLE)]
    assert all(r.n_chars == len(r.text) for r in rows) and [r.page_id for r in rows] == [1, 2, None, 1]
    assert block_lstm.extract(frame.limit(0), model).count() == 0


def test_query_gives_the_articles(spark):
    rows = QUERIES["op11_recurrent_extraction"](spark, FOLDER).collect()
    html = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    assert len(rows) == len(html)
    for r in rows:
        inside = re.search(r"<article>(.*?)</article>", html[r.page_id], re.DOTALL).group(1)
        parts = [" ".join(unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n\n".join(p for p in parts if p)


def test_training_without_pages_or_prose(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    made = block_lstm.train(empty, count=40, epochs=1)
    assert block_lstm.extract(spark.createDataFrame([(1, "u", "<p>x</p>")], empty.schema), made).count() == 1


def test_a_long_page_is_read_whole(model):
    words = " ".join(f"word{i}" for i in range(200_000))
    many = "".join(f"<p>Sentence number {i} of a very long article.</p>" for i in range(4000))
    page = blocks(f"<body><nav><a href=x>Home</a></nav><article><p>{words}.</p>{many}</article><footer>Imprint</footer></body>")
    kept = block_lstm.article_blocks([page], model, block_lstm.Hasher())[0]
    assert len(page) == 4003 and kept[1:-1].mean() > 0.999 and not kept[0] and not kept[-1]
    assert MARK not in escape(page[1].text)
