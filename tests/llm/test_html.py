"""The block labeller: gradients, held-out layouts, the corpus's pages, odd markup."""

import time
from html.parser import HTMLParser

import numpy as np
import pytest

from quillspark.llm import html


@pytest.fixture(scope="module")
def net():
    return html.trained()


def test_gradients_match_differences():
    net = html.BiLstm(3, inputs=5, hidden=4)
    rng = np.random.default_rng(0)
    seqs = [rng.standard_normal((n, 5)).astype(np.float32) for n in (4, 2)]
    x, mask = html.padded(seqs)
    y = (rng.random(mask.shape) < 0.5).astype(np.float32)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    _, g = net.gradients(x, mask, y)
    for k in ("Wf", "Ub", "cf", "V", "v"):
        flat = net.p[k].reshape(-1)
        for i in range(0, flat.size, max(1, flat.size // 5)):
            was = flat[i]
            flat[i] = was + 1e-3
            up, _ = net.gradients(x, mask, y)
            flat[i] = was - 1e-3
            down, _ = net.gradients(x, mask, y)
            flat[i] = was
            assert abs((up - down) / 2e-3 - g[k].reshape(-1)[i]) < 2e-3


def test_held_out_layouts(net):
    right = []
    for x, y in html.lesson(4321, 250):
        right.append(((net.logits(x[:, None, :], np.ones((len(x), 1), bool))[:, 0] > 0) == (y > 0)).mean())
    assert np.mean(right) > 0.98


def test_long_pages_are_read_in_chunks(net):
    seq = html.blocks("<article>" + "<p>some words here.</p>" * 300 + "</article><footer>© all rights reserved</footer>")
    whole = net.logits(html.vectors(seq)[:, None, :], np.ones((len(seq), 1), bool))[:, 0]
    assert np.allclose(net.logits_long(seq, chunk=37), whole, atol=1e-4)


class Reader(HTMLParser):
    """Blocks of an article by the standard library's parser, apart from the operator's own tokenizer."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.inside, self.hidden, self.held, self.blocks = False, 0, [], []

    def cut(self) -> None:
        body = " ".join("".join(self.held).split())
        self.blocks += [body] if body else []
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        elif tag in ("script", "style"):
            self.hidden += 1
        elif tag == "br":
            self.held.append(" ")
        elif tag not in ("a", "b", "em", "i", "span", "strong"):
            self.cut()

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden -= 1
        elif tag not in ("a", "b", "em", "i", "span", "strong", "br"):
            self.cut()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.held.append(data)


def test_corpus_pages(spark, net):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    got = html.extract([r["html"] for r in rows], net)
    same = []
    for r, text in zip(rows, got, strict=True):
        reader = Reader()
        reader.feed(r["html"])
        same.append(text == "\n\n".join(reader.blocks))
    assert np.mean(same) > 0.99


#: Pages in layouts of other kinds, labelled by hand: the page, its main text.
FOREIGN = {
 "table": ('<html><body><table><tr><td colspan=2><a href=/>Home</a> <a href=/about>About</a> <a href=/c>Contact</a></td></tr><tr><td width=150><a href=1>Products</a><br><a href=2>Services</a></td><td><h1>Our new mill</h1><p>The mill was built by the river in the spring of last year, and it has been grinding flour for the whole valley since then.</p><p>It is open to visitors on most days.</p></td></tr><tr><td colspan=2>Copyright 2011 Foo Inc.</td></tr></table></body></html>',
  "Our new mill\n\nThe mill was built by the river in the spring of last year, and it has been grinding flour for the whole valley since then.\n\nIt is open to visitors on most days."),
 "divs": ('<body><div><a href=a>Start</a><a href=b>Archive</a><a href=c>Login</a></div><div><h1>Bread without kneading</h1><p>Mix the flour, the water and a little yeast in the evening and leave the bowl covered until the morning.</p><p>Then bake it in a hot pot for forty minutes.</p></div><div>© 2019 The Bakery Blog</div></body>',
  "Bread without kneading\n\nMix the flour, the water and a little yeast in the evening and leave the bowl covered until the morning.\n\nThen bake it in a hot pot for forty minutes."),
 "german": ('<html><body><nav><ul><li><a href=/>Startseite</a></li><li><a href=/k>Kontakt</a></li></ul></nav><main><h1>Die Mühle am Fluss</h1><p>Seit dem Frühjahr mahlt die neue Mühle Mehl für das ganze Tal, und an den meisten Tagen steht sie Besuchern offen.</p></main><footer>Impressum Datenschutz</footer></body></html>',
  "Die Mühle am Fluss\n\nSeit dem Frühjahr mahlt die neue Mühle Mehl für das ganze Tal, und an den meisten Tagen steht sie Besuchern offen."),
 "japanese": ('<html><body><div class="menu"><a href=/>ホーム</a> <a href=/k>お問い合わせ</a></div><div class="article"><h1>川のそばの水車小屋</h1><p>新しい水車小屋は去年の春に建てられ、それ以来、谷全体のために小麦粉を挽いています。ほとんどの日に見学できます。</p></div><div class="footer">© 2020 谷の会社</div></body></html>',
  "川のそばの水車小屋\n\n新しい水車小屋は去年の春に建てられ、それ以来、谷全体のために小麦粉を挽いています。ほとんどの日に見学できます。"),
 "brs": ('<center><a href=x>Back</a> | <a href=y>Next</a></center><hr><h2>How to sharpen a knife</h2>Hold the blade at a small angle to the stone and draw it towards you with even pressure, ten times on each side.<br><br>Wipe it dry afterwards and never leave it in water.<hr><small>Copyright 1999 J. Doe</small>',
  "How to sharpen a knife\n\nHold the blade at a small angle to the stone and draw it towards you with even pressure, ten times on each side. Wipe it dry afterwards and never leave it in water."),
}


@pytest.mark.parametrize("name", FOREIGN)
def test_foreign_layouts(net, name):
    page, text = FOREIGN[name]
    assert html.extract([page], net) == [text]


@pytest.mark.parametrize("page", [
    "<a " * 333_333, "<!" * 500_000, '<p class="x' * 100_000, "<a b='" * 100_000 + ">", "<" * 1_000_000, "</" * 500_000, "&#" + "9" * 1_000_000 + ";",
    "<li><ul>" + "<div>" * 50_000 + "<li></li>" * 50_000, "<p>" + "<b>" * 300_000, "<!-- " * 200_000, '<p class="x' * 50_000 + ">" + '<p class="x' * 50_000,
], ids=range(11))
def test_broken_pages_of_a_megabyte_take_linear_time(page):
    start = time.perf_counter()
    html.blocks(page)
    assert time.perf_counter() - start < 2


def test_implied_ends_reach_any_depth():
    assert [b.text for b in html.blocks("<ul><li>" + "<span>" * 500 + "one<li>two</ul>three")] == ["one", "two", "three"]
    seq = html.blocks("<ul><li>" + "<span>" * 500 + "one<li>two</ul>")
    assert not seq[1].path >> html._TAG_BIT["span"] & 1


def test_blocks_of_odd_markup():
    text = lambda p: [b.text for b in html.blocks(p)]
    assert text("") == [] and text("   ") == [] and text("plain &amp; bare") == ["plain & bare"]
    assert text("<p>a<b>b</b> c<br>d\n\te</p>") == ["ab c d e"]
    assert text("<p>one<p>two<div>three") == ["one", "two", "three"]
    assert text('<script>var t="</p>";</script><style>p{}</style><p>x</p>') == ["x"]
    assert text("<!-- <p>no</p> --><p>yes</p><!-- open") == ["yes"]
    assert text("<head><title>t</title></head><body>b</body>") == ["b"]
    assert text("<ul><li>1<li>2</ul>after") == ["1", "2", "after"]
    assert text("a < b and <p>c</p></div></nope>") == ["a < b and", "c"]
    assert text("<div " * 200 + "><p>deep</p>")[-1] == "deep"
    assert text("<script>never closed <p>x</p>") == []
    assert text("<div>" * 5000 + "x") == ["x"]
    assert text("&#x41;&#66;&nbsp;c &copy;") == ["AB c ©"]


def test_table_of_pages(spark, net):
    rows = [(1, "u", None, 1), (2, None, "", 2), (3, "u", "<nav><a href=x>home</a></nav><article><h1>T</h1><p>Some text of the article.</p></article><footer>&copy; x</footer>", 3), (3, "u", None, 3)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    out = sorted(tuple(r) for r in html.main_text(table).fillna("", ["url"]).collect())
    assert out == [(1, "u", "", 0), (2, "", "", 0), (3, "u", "", 0), (3, "u", "T\n\nSome text of the article.", 28)]
    assert html.main_text(table.limit(0)).count() == 0
