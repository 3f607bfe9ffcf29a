"""Main text of web pages by a recurrent block labeller.

A tolerant tokenizer cuts a page into leaf blocks. Each block becomes a vector: its tag path (tags and hashed class words
of all open elements), its own tag, its hashed words and a few measures. A bidirectional LSTM in numpy reads the whole
sequence of a page's blocks and labels each as main text or not, so that every decision sees the whole page. The network
is trained here, on pages that a seeded generator writes in many layouts; no page of the corpus is needed for it.
"""

from __future__ import annotations

import bisect
import functools
import html as _html
import re
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import batches_of_bytes, ship, tune

#: Tags with a place of their own in the path vector (fixed values); others share one.
TAGS = (
    "other html body p div h1 h2 h3 h4 h5 h6 li ul ol table tr td th section article nav header footer aside main blockquote "
    "pre form figure figcaption dl dt dd address details summary fieldset legend label a span b i em strong center"
).split()
_TAG_BIT = {t: i for i, t in enumerate(TAGS)}
BLOCKS = frozenset(
    "html body p div h1 h2 h3 h4 h5 h6 li ul ol table thead tbody tfoot tr td th caption section article nav header footer aside main blockquote "
    "pre form figure figcaption dl dt dd address details summary fieldset legend hr center".split()
)
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
#: Elements whose content is raw text, and elements that show none of their content as text.
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style title template textarea select button svg iframe object noscript math canvas audio video".split())
#: An opening tag of the key closes an open element of the value, up to the barrier.
_CLOSES = {"li": ({"li"}, {"ul", "ol"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"})}

PATH_BITS, WORD_BITS, MEASURES = 128, 64, 6
CLASS_BITS = PATH_BITS - len(TAGS)
INPUTS = PATH_BITS + len(TAGS) + WORD_BITS + MEASURES
HIDDEN_UNITS = 24

#: A tag without a "<" in it: whatever it matches or misses ends at the next "<".
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/><]*+)((?:[^'"<>]++|"[^"<]*"|'[^'<]*')*+)>""")
_NAME = re.compile(r"</?([a-zA-Z][^\s/><]*+)")
#: Numeric references with more digits than any code point has.
_HUGE = re.compile(r"&#(?:0*+[0-9]{8,}+|[xX]0*+[0-9a-fA-F]{7,}+);?")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")


def _class_mask(attributes: str) -> int:
    mask = 0
    for m in _NAMES.finditer(attributes):
        for w in _WORDS.findall((m[1] or m[2] or m[3] or "").lower()):
            mask |= 1 << (len(TAGS) + zlib.crc32(w.encode()) % CLASS_BITS)
    return mask


class Block:
    __slots__ = ("linked", "path", "tag", "text")

    def __init__(self, text: str, path: int, tag: int, linked: float) -> None:
        self.text, self.path, self.tag, self.linked = text, path, tag, linked


def decoded(text: str) -> str:
    """Character references decoded, white space single, trimmed."""
    if "&" in text:
        text = _html.unescape(_HUGE.sub("\ufffd", text) if "&#" in text else text)
    return " ".join(text.split())


class _TagEnds:
    """Where a tag that starts at a place ends: the first ">" outside quotes from there on. One pass over the page, made when
    the first odd tag asks; a quote that nothing closes is a sign like any other."""

    def __init__(self, page: str) -> None:
        self.page, self.at, self.end = page, [], []

    def __call__(self, start: int) -> int:
        """The place of the ">", or -1."""
        if not self.at:
            found = [(m.start(), m[0]) for m in re.finditer("[\"'>]", self.page)]
            self.at, ends = [k for k, _ in found], [-1] * (len(found) + 1)
            later = {'"': -1, "'": -1}
            for i in range(len(found) - 1, -1, -1):
                place, sign = found[i]
                if sign == ">":
                    ends[i] = place
                else:
                    ends[i] = ends[later[sign] + 1] if later[sign] >= 0 else ends[i + 1]
                    later[sign] = i
            self.end = ends
        return self.end[bisect.bisect_left(self.at, start)]


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name or text, attributes) in page order; kind is "text", "open" or "close". Comments and declarations are left
    out. Every sign is passed a bounded number of times, whatever is left open."""
    at, n, last = 0, len(page), page.rfind(">")
    ends = _TagEnds(page)
    while at < n:
        lt = page.find("<", at)
        if lt != at:
            yield "text", page[at : lt if lt >= 0 else n], ""
            if lt < 0:
                return
            at = lt
        m = _TAG.match(page, at)
        if m:
            at = m.end()
            yield "close" if m[1] else "open", m[2].lower(), m[3]
            if not m[1] and (name := m[2].lower()) in RAW:
                close = re.compile(f"</{name}\\b", re.I).search(page, at)
                at = close.start() if close else n
            continue
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            at = close + 3 if close >= 0 else n
            continue
        name = _NAME.match(page, at)
        if at < last and (name or page[at + 1] in "!?/"):
            close = ends(name.end()) if name else -1
            if close < 0:
                close = page.find(">", at)
            if name:
                yield "close" if page[at + 1] == "/" else "open", name[1].lower(), page[name.end() : close]
            at = close + 1
            if name and page[name.start() + 1] != "/" and name[1].lower() in RAW:
                found = re.compile(f"</{name[1]}\\b", re.I).search(page, at)
                at = found.start() if found else n
            continue
        yield "text", "<", ""
        at += 1


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order, references decoded, white space single. Linear in the page, whatever its faults."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, int, int]] = []  # name, path, hidden, tag bit and place of the nearest block
    where: dict[str, list[int]] = {}  # places in the stack by name
    text: list[str] = []
    linked = 0
    root = ("", 0, False, 0, -1)

    def flush() -> None:
        nonlocal linked
        if text:
            body = decoded("".join(text))
            if body:
                top = stack[-1] if stack else root
                out.append(Block(body, top[1], top[3], min(1.0, linked / max(1, sum(map(len, text))))))
            text.clear()
        linked = 0

    def last(names) -> int:
        return max((where[x][-1] for x in names if where.get(x)), default=-1)

    def cut(place: int) -> None:
        while len(stack) > place:
            where[stack.pop()[0]].pop()

    for kind, name, attributes in tokens(page):
        top = stack[-1] if stack else root
        if kind == "text":
            if not top[2]:
                text.append(name)
                if where.get("a"):
                    linked += len(name)
            continue
        if kind == "close":
            if name == "br":
                text.append(" ")
            elif name in BLOCKS:
                flush()
            if where.get(name):
                cut(where[name][-1])
            continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name in ("br", "img") and not top[2]:
                text.append(" ")
            continue
        if name in BLOCKS:
            flush()
            if where.get("head") and last(("script", "style", "title")) < 0:
                cut(where["head"][-1])
            top = stack[-1] if stack else root
            if top[4] >= 0 and stack[top[4]][0] == "p":
                cut(top[4])
        if name in _CLOSES:
            own, barrier = _CLOSES[name]
            place = last(own)
            if place > last(barrier):
                cut(place)
        if name in RAW or (attributes.endswith("/") and name not in BLOCKS):
            continue
        top = stack[-1] if stack else root
        bit = _TAG_BIT.get(name, 0)
        path = top[1] | (1 << bit) | (_class_mask(attributes) if "=" in attributes else 0)
        place = len(stack)
        where.setdefault(name, []).append(place)
        stack.append((name, path, top[2] or name in HIDDEN, *((bit, place) if name in BLOCKS else top[3:])))
    flush()
    return out


_word_memo: dict[str, int] = {}


def _word(w: str) -> int:
    k = _word_memo.get(w)
    if k is None:
        if len(_word_memo) > 200_000:
            _word_memo.clear()
        k = _word_memo[w] = zlib.crc32(w.lower().strip(".,;:!?()\"'").encode()) % WORD_BITS
    return k


def vectors(seq: list[Block], lo: int = 0, hi: int | None = None) -> np.ndarray:
    """Rows lo..hi of a page's input to the network."""
    part = seq[lo:hi]
    x = np.zeros((len(part), INPUTS), dtype=np.float32)
    raw = np.frombuffer(b"".join(b.path.to_bytes(16, "little") for b in part), dtype=np.uint8).reshape(len(part), 16)
    x[:, :PATH_BITS] = np.unpackbits(raw, axis=1, bitorder="little")[:, :PATH_BITS]
    for i, b in enumerate(part):
        x[i, PATH_BITS + b.tag] = 1
        words = b.text.split()
        counts = np.bincount([_word(w) for w in words], minlength=WORD_BITS)
        x[i, PATH_BITS + len(TAGS) : PATH_BITS + len(TAGS) + WORD_BITS] = counts / len(words)
        size = len(b.text)
        x[i, -MEASURES:] = (np.log1p(size) / 8, b.linked, min(1.0, len(words) / 100), (lo + i) / max(1, len(seq) - 1), b.text[-1] in ".!?:", np.log1p(len(seq)) / 8)
    return x


# the network ---------------------------------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BiLstm:
    """One layer of LSTM in either direction and a logistic output, in float32."""

    def __init__(self, seed: int = 0, inputs: int = INPUTS, hidden: int = HIDDEN_UNITS) -> None:
        rng = np.random.default_rng(seed)
        self.h = hidden
        init = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {"W" + d: init(inputs, 4 * hidden), "U" + d: init(hidden, 4 * hidden), "c" + d: np.zeros(4 * hidden, np.float32)}
            self.p["c" + d][hidden : 2 * hidden] = 1  # forget gates open
        self.p |= {"V": init(2 * hidden, 1), "v": np.zeros(1, np.float32)}

    def _steps(self, d: str, x: np.ndarray, mask: np.ndarray, h: np.ndarray, c: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """x (time, batch, inputs) in reading order of this direction -> states (time, batch, hidden) and the last h, c."""
        H, U = self.h, self.p["U" + d]
        z = x @ self.p["W" + d] + self.p["c" + d]
        out = np.empty((len(x), x.shape[1], H), np.float32)
        for t in range(len(x)):
            a = z[t] + h @ U
            s = _sigmoid(a[:, : 3 * H])
            i, f, o, g = s[:, :H], s[:, H : 2 * H], s[:, 2 * H :], np.tanh(a[:, 3 * H :])
            c2 = f * c + i * g
            tc = np.tanh(c2)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((i, f, o, g, c, tc, h, m))
            h, c = np.where(m, o * tc, h), np.where(m, c2, c)
            out[t] = h
        return out, h, c

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        zero = np.zeros((x.shape[1], self.h), np.float32)
        f, _, _ = self._steps("f", x, mask, zero, zero)
        b, _, _ = self._steps("b", x[::-1], mask[::-1], zero, zero)
        return np.concatenate([f, b[::-1]], axis=2) @ self.p["V"][:, 0] + self.p["v"][0]

    def logits_long(self, seq: list[Block], chunk: int = 2048) -> np.ndarray:
        """Of one long page, with the inputs of one chunk at a time in memory."""
        n, states = len(seq), {}
        for d in "fb":
            h = c = np.zeros((1, self.h), np.float32)
            own = np.empty((n, self.h), np.float32)
            edges = list(range(0, n, chunk))
            for lo in edges if d == "f" else edges[::-1]:
                x = vectors(seq, lo, min(n, lo + chunk))[:, None, :]
                out, h, c = self._steps(d, x if d == "f" else x[::-1], np.ones((len(x), 1), bool), h, c)
                own[lo : lo + len(x)] = (out if d == "f" else out[::-1])[:, 0]
            states[d] = own
        return np.concatenate([states["f"], states["b"]], axis=1) @ self.p["V"][:, 0] + self.p["v"][0]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over the masked cells, and its gradients by back-propagation through time."""
        H, zero = self.h, np.zeros((x.shape[1], self.h), np.float32)
        keeps, outs = {"f": [], "b": []}, {}
        for d in "fb":
            outs[d] = self._steps(d, x if d == "f" else x[::-1], mask if d == "f" else mask[::-1], zero, zero, keeps[d])[0]
        both = np.concatenate([outs["f"], outs["b"][::-1]], axis=2)
        p = _sigmoid(both @ self.p["V"][:, 0] + self.p["v"][0])
        cells = mask.sum()
        loss = -float((mask * (y * np.log(p + 1e-7) + (1 - y) * np.log(1 - p + 1e-7))).sum() / cells)
        dl = (mask * (p - y) / cells).astype(np.float32)
        g = {"V": np.einsum("tbh,tb->h", both, dl)[:, None], "v": np.array([dl.sum()], np.float32)}
        for d in "fb":
            part = self.p["V"][:H, 0] if d == "f" else self.p["V"][H:, 0]
            dout, xs = dl[:, :, None] * part, x
            if d == "b":
                dout, xs = dout[::-1], x[::-1]
            U, dh, dc = self.p["U" + d], zero.copy(), zero.copy()
            da_all, gU = np.empty((len(x), x.shape[1], 4 * H), np.float32), np.zeros_like(U)
            for t in range(len(x) - 1, -1, -1):
                i, f, o, gg, c0, tc, h0, m = keeps[d][t]
                dh = dh + dout[t]
                dhm, dcm = np.where(m, dh, 0), np.where(m, dc, 0)
                do, dc2 = dhm * tc, dcm + dhm * o * (1 - tc * tc)
                da = np.concatenate([dc2 * gg * i * (1 - i), dc2 * c0 * f * (1 - f), do * o * (1 - o), dc2 * i * (1 - gg * gg)], axis=1)
                da_all[t] = da
                gU += h0.T @ da
                dh = np.where(m, da @ U.T, dh)
                dc = np.where(m, dc2 * f, dc)
            g["W" + d] = xs.reshape(-1, xs.shape[2]).T @ da_all.reshape(-1, 4 * H)
            g["U" + d], g["c" + d] = gU, da_all.sum((0, 1))
        return loss, g


def padded(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    top = max(len(s) for s in seqs)
    x, mask = np.zeros((top, len(seqs), seqs[0].shape[1]), np.float32), np.zeros((top, len(seqs)), bool)
    for k, s in enumerate(seqs):
        x[: len(s), k], mask[: len(s), k] = s, True
    return x, mask


# pages to learn from -------------------------------------------------------------------------------------------------

#: Marks main text in generated pages; stripped before the network sees it.
MAIN = "\ue000"
#: Words and class names of the generated layouts (fixed values).
_CLASS = {
    "nav": "nav menu navigation navbar breadcrumb breadcrumbs topnav links site-nav main-menu".split(),
    "header": "header masthead banner top site-header page-header logo branding".split(),
    "ad": "ad ads advert advertisement sponsored promo banner-ad ad-slot adbox sponsor".split(),
    "notice": "cookie cookie-notice consent gdpr alert notice newsletter popup subscribe cookie-banner privacy-notice modal".split(),
    "main": "content post article article-body entry-content story main-content text body-text page-content article post-body entry main".split(),
    "side": "sidebar related widget trending recommended most-read side rail more popular related-posts social share sharing tags".split(),
    "comments": "comments comment-list responses discussion disqus replies comment-section user-comments".split(),
    "footer": "footer site-footer bottom copyright legal page-footer foot colophon".split(),
}
_SAYS = {
    "notice": "we use cookies to improve your experience accept all subscribe to our newsletter sign up privacy policy".split(),
    "footer": "© copyright all rights reserved privacy terms contact imprint 2024 about".split(),
    "comments": "reply said wrote posted ago like report great thanks agree".split(),
    "ad": "buy now sale off discount offer sponsored click here free shop".split(),
    "side": "related read more popular latest trending share follow us".split(),
}
#: Consonants and vowels of the alphabets that invented words are spelled in (fixed values), and a script without spaces.
_LETTERS = (("bcdfghjklmnprstvwz", "aeiouy"), ("bcdfglmnpqrst", "aàeéèioôu"), ("bdfgklmnrstwz", "aäeioöuü"), ("cdglmnrstñz", "aáeéiíoóu"), ("бвгдзклмнпрст", "аеиоуы"), ("βγδκλμνπρστ", "αεηιου"))
_IDEOGRAPHS = [chr(0x4E00 + 37 * k) for k in range(200)]


class PageWriter:
    """Writes pages in random layouts, main text marked; the same seed writes the same pages. Words are spelled at random."""

    def __init__(self, seed: int) -> None:
        self.r = np.random.default_rng(seed)
        self.spelled = [[self.spell(c, v) for _ in range(300)] for c, v in _LETTERS]

    def pick(self, xs):
        return xs[int(self.r.integers(len(xs)))]

    def chance(self, p: float) -> bool:
        return self.r.random() < p

    def spell(self, consonants: str, vowels: str) -> str:
        return "".join(self.pick(consonants) * self.chance(0.8) + self.pick(vowels) + self.pick(consonants) * self.chance(0.4) for _ in range(int(self.r.integers(1, 5))))

    def words(self, lo: int, hi: int, kind: str | None = None) -> str:
        n, style = int(self.r.integers(lo, hi + 1)), self.r.random()
        known = self.spelled[0] if self.chance(0.5) else self.pick(self.spelled)
        if style > 0.97:  # no spaces
            return "".join(self.pick(_IDEOGRAPHS) for _ in range(3 * n)) + "。"
        if style > 0.91:  # one word again and again
            return " ".join([self.pick(known)] * n)
        noise = "".join(self.pick(string.punctuation.replace("<", "").replace("&", "")) * int(self.r.integers(1, 4)) for _ in range(int(self.r.integers(1, 3))))
        out = []
        for _ in range(n):
            w = self.pick(known)
            if kind in _SAYS and self.chance(0.35):
                w = self.pick(_SAYS[kind])
            if style < 0.08:
                w = w.upper() + noise
            elif style < 0.16:
                w += noise
            out.append(w)
        text = " ".join(out)
        return text[:1].upper() + text[1:] + (self.pick([".", ".", "", "!", "?"]))

    def attr(self, kind: str) -> str:
        name = self.pick(_CLASS[kind])
        if self.chance(0.3):
            name += " " + self.pick(["col", "row", "wide", "clearfix", "inner", "box", "x1"])
        return f' {self.pick(["class", "class", "id"])}="{name}"'

    def links(self, n: int, wrap: bool) -> str:
        items = [f'<a href="/{k}">{self.words(1, 4)}</a>' for k in range(n)]
        return "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>" if wrap else " | ".join(items) if self.chance(0.5) else "".join(f"<div>{a}</div>" for a in items)

    def nav(self) -> str:
        tag, a = self.pick([("nav", ""), ("nav", self.attr("nav")), ("div", self.attr("nav")), ("ul", self.attr("nav"))])
        inner = self.links(int(self.r.integers(2, 9)), self.chance(0.7))
        return f"<{tag}{a}>{inner}</{tag}>"

    def header(self) -> str:
        tag, a = self.pick([("header", ""), ("header", self.attr("header")), ("div", self.attr("header"))])
        inner = self.pick([f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.words(1, 8)}</p>", f'<a href="/">{self.words(1, 3)}</a>', f"<h2>{self.words(1, 3)}</h2><p>{self.words(3, 9)}</p>"])
        return f"<{tag}{a}>{inner}{self.nav() if self.chance(0.4) else ''}</{tag}>"

    def ad(self) -> str:
        tag = self.pick(["div", "div", "aside", "section", "p", "span"])
        kind = None if self.chance(0.5) else "ad"
        return f"<{tag}{self.attr('ad')}>{self.words(2, 25, kind)}</{tag}>"

    def notice(self) -> str:
        tag = self.pick(["div", "section", "aside"])
        inner = self.words(4, 30, "notice" if self.chance(0.7) else None)
        return f"<{tag}{self.attr('notice')}>{self.pick([inner, f'<p>{inner}</p>', f'<p>{inner}</p><a href=x>{self.words(1, 2)}</a>'])}</{tag}>"

    def form(self) -> str:
        inner = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in range(int(self.r.integers(1, 4))))
        return f"<form action=x>{self.pick(['', f'<p>{self.words(2, 10)}</p>', f'<h3>{self.words(1, 4)}</h3>'])}{inner}<button>{self.words(1, 1)}</button></form>"

    def side(self) -> str:
        tag, a = self.pick([("aside", ""), ("aside", self.attr("side")), ("div", self.attr("side")), ("section", self.attr("side"))])
        inner = f"<h3>{self.words(1, 4, 'side')}</h3>" * self.chance(0.7)
        inner += self.links(int(self.r.integers(2, 7)), True) if self.chance(0.6) else "".join(f"<p>{self.words(3, 25, 'side')}</p>" for _ in range(int(self.r.integers(1, 4))))
        return f"<{tag}{a}>{inner}</{tag}>"

    def comments(self) -> str:
        tag = self.pick(["section", "div", "ol", "ul"])
        one = lambda: f'<{"li" if tag in ("ol", "ul") else "div"} class="{self.pick(["comment", "reply", "response"])}"><p class="{self.pick(["author", "meta", "user"])}">{self.words(1, 3, "comments")}</p><p>{self.words(2, 40, "comments" if self.chance(0.6) else None)}</p></{"li" if tag in ("ol", "ul") else "div"}>'
        return f"<{tag}{self.attr('comments')}>{'<h3>' + self.words(1, 3, 'comments') + '</h3>' if self.chance(0.7) else ''}{''.join(one() for _ in range(int(self.r.integers(1, 6))))}{self.form() if self.chance(0.2) else ''}</{tag}>"

    def footer(self) -> str:
        tag, a = self.pick([("footer", ""), ("footer", self.attr("footer")), ("div", self.attr("footer"))])
        inner = self.words(2, 20, "footer" if self.chance(0.7) else None)
        return f"<{tag}{a}>{self.pick(['&copy; ', '', ''])}{self.pick([inner, f'<p>{inner}</p>', inner + self.links(3, True)])}</{tag}>"

    def inline(self, text: str) -> str:
        if self.chance(0.3):
            cut = text.split(" ")
            k = int(self.r.integers(len(cut)))
            cut[k] = self.pick([f"<b>{cut[k]}</b>", f'<a href="/x">{cut[k]}</a>', f"<em>{cut[k]}</em>", cut[k] + "<br>"])
            text = " ".join(cut)
        return text

    def main(self) -> str:
        tag, a = self.pick([("article", ""), ("article", ""), ("article", self.attr("main")), ("main", ""), ("div", self.attr("main")), ("div", self.attr("main")), ("section", self.attr("main"))])
        parts = [f"<h1>{MAIN}{self.words(1, 10)}</h1>"] if self.chance(0.8) else []
        for _ in range(int(self.r.integers(1, 13))):
            u = self.r.random()
            text = MAIN + self.inline(self.words(1, self.pick([4, 30, 120])))
            if u < 0.62:
                parts.append(f"<p>{text}</p>" if self.chance(0.8) else f"<p><b>{text}<br>")
            elif u < 0.72:
                parts.append(f"<h{self.pick('234')}>{MAIN}{self.words(1, 8)}</h{self.pick('234')}>")
            elif u < 0.80:
                parts.append("<ul>" + "".join(f"<li>{MAIN}{self.inline(self.words(1, 15))}</li>" for _ in range(int(self.r.integers(1, 5)))) + "</ul>")
            elif u < 0.84:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif u < 0.87:
                parts.append("<table>" + "".join(f"<tr><td>{MAIN}{self.words(1, 3)}</td><td>{MAIN}{self.words(1, 4)}</td></tr>" for _ in range(int(self.r.integers(1, 4)))) + "</table>")
            elif u < 0.90:
                parts.append(f"<div>{text}</div>")
            elif u < 0.92:
                parts.append(f"<pre>{text}</pre>")
            else:
                parts.append(self.pick([self.ad, self.ad, self.notice, self.side])())
        return f"<{tag}{a}>{''.join(parts)}</{tag}>"

    def bare(self) -> str:
        """An article in plain blocks: paragraphs, or lines between breaks, with headings and lists."""
        parts = [f"<{(h := self.pick(['h1', 'h2', 'b', 'div']))}>{MAIN}{self.words(2, 10)}</{h}>"] if self.chance(0.7) else []
        for _ in range(int(self.r.integers(1, 9))):
            text, u = MAIN + self.inline(self.words(6, self.pick([20, 60, 120]))), self.r.random()
            if u < 0.6:
                parts.append(self.pick([f"<p>{text}</p>", f"<p>{text}", f"<div>{text}</div>", f"{text}<br><br>"]))
            elif u < 0.75:
                parts.append(f"<h3>{MAIN}{self.words(1, 7)}</h3><p>{text}</p>")
            elif u < 0.88:
                parts.append("<ul>" + "".join(f"<li>{MAIN}{self.inline(self.words(2, 15))}</li>" for _ in range(int(self.r.integers(2, 5)))) + "</ul>")
            else:
                parts.append(f"<blockquote>{text}</blockquote>")
        return "".join(parts)

    def menu(self) -> str:
        """Links without a name: side by side, or one below the other."""
        items = [f'<a href="/{k}">{self.words(1, 3)}</a>' for k in range(int(self.r.integers(2, 8)))]
        return self.pick([" | ".join(items), " ".join(items), "<br>".join(items), "".join(f"<p>{a}</p>" for a in items), "".join(f"<div>{a}</div>" for a in items), "<ul>" + "".join(f"<li>{a}</li>" for a in items) + "</ul>"])

    def notes(self) -> str:
        """The last lines of a page."""
        sign = self.pick(["&copy; ", "Copyright ", "(c) ", "© "])
        return f"{sign}{int(self.r.integers(1996, 2026))} {self.words(1, 5, 'footer' if self.chance(0.4) else None)}"

    def tabled(self) -> str:
        """A page laid out by tables."""
        font = lambda x: f'<font size="{int(self.r.integers(1, 4))}">{x}</font>' if self.chance(0.3) else x
        top = f'<tr><td colspan="{int(self.r.integers(2, 4))}">{self.pick([font(self.words(1, 4)), self.menu(), "<img src=x>" + self.menu()])}</td></tr>' * self.chance(0.8)
        cells = [f'<td valign="top">{self.bare()}</td>']
        if self.chance(0.8):
            cells.insert(int(self.r.integers(2)), f'<td width="{int(self.r.integers(90, 200))}">{self.menu()}{f"<p>{self.words(2, 8, 'side')}</p>" * self.chance(0.3)}</td>')
        foot = f'<tr><td colspan="2">{self.pick(["", "<hr>", "<center>"])}{font(self.notes())}{" " + self.menu() if self.chance(0.3) else ""}</td></tr>' * self.chance(0.8)
        return f'<table width="100%">{top}<tr>{"".join(cells)}</tr>{foot}</table>'

    def nameless(self) -> str:
        """A page of blocks without classes."""
        wrap = lambda x: f"<div>{x}</div>" if self.chance(0.8) else x
        top = wrap(self.pick([self.menu(), f"<h2>{self.words(1, 4)}</h2>" + self.menu(), self.menu() + f"<form><input><button>{self.words(1, 1)}</button></form>"])) * self.chance(0.85)
        side = wrap(f"<h4>{self.words(1, 4, 'side')}</h4>" * self.chance(0.5) + self.menu()) * self.chance(0.4)
        tail = wrap(self.pick([self.notes(), f"<p>{self.notes()}</p>", f"<small>{self.notes()}</small>", self.menu() + f"<p>{self.notes()}</p>"])) * self.chance(0.85)
        return top + (side if self.chance(0.5) else "") + wrap(self.bare()) + (side if self.chance(0.5) else "") + tail

    def page(self) -> str:
        kind = self.r.random()
        if kind < 0.24:
            body = self.tabled() if kind < 0.11 else self.nameless()
            return f"<html><head><title>{self.words(1, 5)}</title></head><body>{body}</body></html>"
        top = [f() for f, p in ((self.header, 0.5), (self.nav, 0.7), (self.notice, 0.3), (self.ad, 0.5)) if self.chance(p)]
        middle = [self.main()] if self.chance(0.97) else []
        if self.chance(0.35):
            middle.insert(int(self.r.integers(len(middle) + 1)), self.side())
        tail = [f() for f, p in ((self.ad, 0.2), (self.side, 0.3), (self.comments, 0.4), (self.form, 0.25), (self.notice, 0.15), (self.footer, 0.8)) if self.chance(p)]
        body = "".join(middle)
        if self.chance(0.4):
            body = f'<div class="{self.pick(["wrapper", "container", "page", "layout", "row"])}">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title><style>p{{}}</style></head><body>{''.join(top)}{body}{''.join(tail)}</body></html>"


def lesson(seed: int, pages: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(vectors, labels) of generated pages."""
    writer, out = PageWriter(seed), []
    while len(out) < pages:
        seq = blocks(writer.page())
        y = np.array([MAIN in b.text for b in seq], dtype=np.float32)
        for b in seq:
            b.text = b.text.replace(MAIN, "").strip() or "."
        if seq:
            out.append((vectors(seq), y))
    return out


@functools.lru_cache(maxsize=2)
def trained(seed: int = 7, pages: int = 3200, epochs: int = 10, batch: int = 32) -> BiLstm:
    """The labeller, trained with Adam on generated pages: the same in every process."""
    data, net, rng = lesson(seed, pages), BiLstm(seed), np.random.default_rng(seed)
    data.sort(key=lambda d: len(d[0]))
    groups = [data[i : i + batch] for i in range(0, len(data), batch)]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    s, step = {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    for epoch in range(epochs):
        for g in rng.permutation(len(groups)):
            x, mask = padded([d[0] for d in groups[g]])
            y, _ = padded([d[1][:, None] for d in groups[g]])
            _, grads = net.gradients(x, mask, y[:, :, 0])
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 0.001
            for k, d in grads.items():
                d = np.clip(d, -1, 1)
                m[k] += 0.1 * (d - m[k])
                s[k] += 0.01 * (d * d - s[k])
                net.p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-8)
    return net


def label(net: BiLstm, pages: list[list[Block]], cells: int = 8192) -> list[np.ndarray]:
    """True for each block that is main text, page by page; batches of like length, of at most `cells` padded blocks."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    at = 0
    while at < len(order):
        if len(pages[order[at]]) > 2048:
            out[order[at]] = net.logits_long(pages[order[at]]) > 0
            at += 1
            continue
        group = [order[at]]
        while at + len(group) < len(order) and len(pages[order[at + len(group)]]) * (len(group) + 1) <= cells:
            group.append(order[at + len(group)])
        x, mask = padded([vectors(pages[k]) for k in group])
        scores = net.logits(x, mask)
        for j, k in enumerate(group):
            out[k] = scores[: len(pages[k]), j] > 0
        at += len(group)
    return out


def extract(pages: list[str | None], net: BiLstm | None = None) -> list[str]:
    """The main text of each page: its main blocks, in page order, joined by blank lines."""
    net = net or trained()
    cut = [blocks(p or "") for p in pages]
    return ["\n\n".join(b.text for b, keep in zip(seq, good, strict=True) if keep) for seq, good in zip(cut, label(net, cut), strict=True)]


def main_text(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html, ...): page_id, url, text, n_chars, one row for each row of pages.

    Null, empty and tag-free html: null and empty give an empty text, bare text is one block that the network judges.
    Repeated rows are extracted each; an empty table gives no rows; other columns are not read.
    """
    ship(pages.sparkSession)
    weights = pages.sparkSession.sparkContext.broadcast(trained().p)
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = BiLstm()
        net.p = weights.value
        for batch in batches:
            for part in batches_of_bytes(batch, 128):
                texts = extract(part.column(2).to_pylist(), net)
                yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op1_html(spark, sf_dir: str) -> DataFrame:
    """All pages."""
    tune(spark)
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))
