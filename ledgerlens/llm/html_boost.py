"""Gradient-boosted trees for block labels, and the labelled pages they learn.

The training pages are written by rule from a seed: articles in many page
layouts (semantic tags, class names or neither) among menus, headers,
footers, sidebars, notices, adverts, forms and reader comments, each block
marked as main text or not. Their number is a parameter.
"""

from __future__ import annotations

import random

import numpy as np

BINS = 32


class Boosted:
    """Logistic gradient boosting of depth-limited trees on binned features."""

    def __init__(self, rounds: int = 80, depth: int = 5, rate: float = 0.2, smooth: float = 1.0,
                 share: float = 0.5, seed: int = 1):
        self.rounds, self.depth, self.rate, self.smooth = rounds, depth, rate, smooth
        self.share, self.seed = share, seed  # each tree sees a share of the features

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], 1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, width = x.shape
        draw, part = np.random.default_rng(self.seed), max(1, int(self.share * width))
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1])) for f in range(width)]
        binned = self._bin(x)
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score = np.full(n, self.base)
        inner = 2 ** self.depth - 1
        self.feature = np.zeros((self.rounds, inner), np.int64)
        self.cut = np.full((self.rounds, inner), BINS, np.int64)
        self.value = np.zeros((self.rounds, inner + 1))
        for t in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            place, known = np.zeros(n, np.int64), np.sort(draw.choice(width, part, replace=False))
            flat, gr, hr = binned[:, known] + np.arange(part) * BINS, np.repeat(g, part), np.repeat(h, part)
            for level in range(self.depth):
                count = 2 ** level
                at = (place[:, None] * (part * BINS) + flat).ravel()
                shape = (count, part, BINS)
                gs = np.bincount(at, gr, count * part * BINS).reshape(shape).cumsum(2)
                hs = np.bincount(at, hr, count * part * BINS).reshape(shape).cumsum(2)
                gt, ht = gs[:, :, -1:], hs[:, :, -1:]
                gain = (gs ** 2 / (hs + self.smooth) + (gt - gs) ** 2 / (ht - hs + self.smooth)
                        - gt ** 2 / (ht + self.smooth))
                gain[(hs < 1) | (ht - hs < 1)] = 0
                best = gain.reshape(count, -1).argmax(1)
                for k in range(count):
                    if gain.reshape(count, -1)[k, best[k]] > 1e-6:
                        f, self.cut[t, count - 1 + k] = divmod(best[k], BINS)
                        self.feature[t, count - 1 + k] = known[f]
                node = count - 1 + place
                right = binned[np.arange(n), self.feature[t, node]] > self.cut[t, node]
                place = 2 * place + right
            gs = np.bincount(place, g, inner + 1)
            hs = np.bincount(place, h, inner + 1)
            self.value[t] = self.rate * gs / (hs + self.smooth)
            score += self.value[t, place]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the positive label."""
        binned, rows = self._bin(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for t in range(self.rounds):
            place = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2 ** level - 1 + place
                place = 2 * place + (binned[rows, self.feature[t, node]] > self.cut[t, node])
            out += self.value[t, place]
        return out


_LETTERS = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti",
            "to", "it", "st", "io", "le", "is", "ou", "ar", "as", "de", "rt", "ve", "é", "ü", "ch", "qu"]


class _Writer:
    """Writes one labelled page."""

    def __init__(self, r: random.Random):
        self.r = r

    def word(self) -> str:
        return "".join(self.r.choice(_LETTERS) for _ in range(self.r.randint(1, 4)))

    def phrase(self, a: int, b: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(a, b)))

    def sentence(self, a: int = 3, b: int = 22) -> str:
        return self.phrase(a, b).capitalize() + self.r.choice(".....!?")

    def prose(self, most: int = 9) -> str:
        r, n = self.r, self.r.randint(1, most)
        out = []
        for _ in range(n):
            s = self.sentence()
            if r.random() < 0.08:
                s = f'<a href="/{self.word()}">{s}</a>'
            elif r.random() < 0.08:
                s = f"<{(t := r.choice(['b', 'em', 'strong', 'i', 'span', 'code']))}>{s}</{t}>"
            out.append(s)
        return r.choice([" ", " ", "\n"]).join(out)

    def tag(self, name: str, inner: str, words: list[str] | None = None, main: bool = False) -> str:
        r, attributes = self.r, ""
        if words and r.random() < 0.9:
            w = r.choice(words)
            kind = r.choice(["class", "class", "class", "id", "class"])
            if r.random() < 0.2:
                w += r.choice([" ", "-", "_"]) + r.choice(["box", "wrap", "block", "inner", "1", "area", "list", "item"])
            attributes = f' {kind}="{w}"'
        return f"<{name}{attributes}{' data-main' if main else ''}>{inner}</{name}>"

    def main_block(self, first: bool) -> str:
        r, k = self.r, self.r.random()
        m = " data-main"
        if first and r.random() < 0.9:
            return f"<h1{m}>{self.phrase(2, 12)}</h1>"
        if k < 0.70:
            lead = r.random()
            text = self.prose() if lead < 0.8 else self.sentence(1, 6)
            if r.random() < 0.1:
                text = f"<b>{text}<br>"  # left open on purpose
            return f"<p{m}>{text}" + ("</p>" if r.random() < 0.85 else "")
        if k < 0.78:
            return f"<h{(n := r.randint(2, 4))}{m}>{self.phrase(1, 9)}</h{n}>"
        if k < 0.86:
            items = "".join(f"<li{m}>{self.sentence(2, 14) if r.random() < 0.7 else self.phrase(1, 5)}</li>"
                            for _ in range(r.randint(2, 7)))
            return r.choice(["<ul>{}</ul>", "<ol>{}</ol>"]).format(items)
        if k < 0.90:
            return f"<blockquote{m}>{self.prose(3)}</blockquote>" if r.random() < 0.5 else \
                f"<blockquote><p{m}>{self.prose(3)}</p></blockquote>"
        if k < 0.93:
            return f"<pre{m}>{self.phrase(4, 20)}</pre>"
        if k < 0.96:
            rows = "".join("<tr>" + "".join(f"<td{m}>{self.phrase(1, 4)}</td>" for _ in range(3)) + "</tr>"
                           for _ in range(r.randint(2, 5)))
            return f"<table>{rows}</table>"
        if k < 0.98:
            return f"<div{m}>{self.prose()}</div>"
        return f'<figure><img src="x.png"><figcaption{m}>{self.sentence(3, 12)}</figcaption></figure>'

    def links(self, n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{self.word()}">{self.phrase(1, 4)}</a></{tag}>' for _ in range(n))

    def menu(self) -> str:
        r = self.r
        inner = r.choice([lambda: f"<ul>{self.links(r.randint(2, 9))}</ul>",
                          lambda: " ".join(f'<a href="#">{self.phrase(1, 2)}</a>' for _ in range(r.randint(2, 8))),
                          lambda: self.links(r.randint(2, 6), "div")])()
        return self.tag(r.choice(["nav", "nav", "div", "ul" if inner.startswith("<li") else "div"]), inner,
                        ["nav", "menu", "navbar", "main-menu", "navigation", "topNav", "site-nav"])

    def header(self) -> str:
        r = self.r
        inner = r.choice([f"<h1>{self.phrase(1, 4)}</h1>", f"<p>{self.phrase(2, 8)}</p>", f'<a href="/">{self.word()}</a>',
                          f"<div>{self.phrase(1, 6)}</div>"]) + (self.menu() if r.random() < 0.6 else "")
        return self.tag(r.choice(["header", "header", "div"]), inner, ["header", "masthead", "site-header", "topbar", "banner"])

    def footer(self) -> str:
        r = self.r
        inner = r.choice([f"&copy; {self.word()}.example.com &middot; {self.sentence()}", f"<p>{self.prose(3)}</p>",
                          f"<p>&copy; 2024 {self.phrase(1, 4)}</p>" + self.links(3, "span"), f"<ul>{self.links(4)}</ul>"])
        return self.tag(r.choice(["footer", "footer", "div"]), inner, ["footer", "site-footer", "colophon", "foot", "copyright"])

    def button(self) -> str:
        return f"<button>{self.phrase(1, 3)}" + ("</button>" if self.r.random() < 0.7 else "")  # else its parent closes it

    def choice(self) -> str:
        options = "".join(f"<option>{self.phrase(1, 2)}" for _ in range(self.r.randint(2, 5)))
        return f"<select>{options}" + ("</select>" if self.r.random() < 0.8 else "")

    def embedded(self) -> str:
        """Controls, which are no main text, or fallback contents, which are."""
        if self.r.random() < 0.6:
            return self.r.choice([self.button, self.choice])()
        name = self.r.choice(["noscript", "object", "canvas", "audio", "video"])
        return f"<{name}><p data-main>{self.sentence()}</p></{name}>" if self.r.random() < 0.4 else \
            f"<{name} data-main>{self.sentence()}</{name}>"

    def notice(self) -> str:
        r = self.r
        inner = r.choice([self.prose(2), f"<p>{self.prose(3)}</p>", f"<p>{self.sentence()}</p>{self.button()}"])
        return self.tag(r.choice(["div", "div", "section", "aside", "p"]) if "<p>" not in inner else "div", inner,
                        ["cookie", "cookie-banner", "consent", "notice", "gdpr", "popup", "alert", "modal", "notification"])

    def advert(self) -> str:
        r = self.r
        inner = r.choice([self.prose(2), f"<p>{self.prose(3)}</p>", f'<a href="#">{self.sentence()}</a>',
                          f"<h3>{self.phrase(2, 5)}</h3><p>{self.sentence()}</p>"])
        return self.tag(r.choice(["div", "aside", "section", "div"]), inner,
                        ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "adsbox", "ad-banner", "banner-ad"])

    def sidebar(self) -> str:
        r = self.r
        inner = r.choice([lambda: f"<h3>{self.phrase(1, 3)}</h3><ul>{self.links(r.randint(2, 7))}</ul>",
                          lambda: f"<p>{self.prose(4)}</p>", lambda: f"<h4>{self.phrase(1, 3)}</h4><p>{self.prose(3)}</p>",
                          lambda: self.prose(3)])()
        return self.tag(r.choice(["aside", "aside", "div", "section"]), inner,
                        ["sidebar", "side", "widget", "related", "rail", "recommended", "popular", "trending"])

    def form(self) -> str:
        r = self.r
        inner = f"<label>{self.phrase(1, 4)}</label><input>{self.button()}"
        if r.random() < 0.2:
            inner = self.choice() + inner
        if r.random() < 0.5:
            inner = f"<p>{self.sentence()}</p>" + inner
        out = f"<form>{inner}</form>"
        return self.tag("div", out, ["newsletter", "subscribe", "search", "signup", "login"]) if r.random() < 0.5 else out

    def comments(self) -> str:
        r, out = self.r, []
        kind = r.choice(["div", "li", "article", "p", "section"])
        for _ in range(r.randint(1, 6)):
            inner = self.prose(4) if kind == "p" or r.random() < 0.4 else \
                r.choice([f"<b>{self.word()}</b>", f"<h4>{self.word()}</h4>", f"<span>{self.word()}</span>", ""]) + f"<p>{self.prose(4)}</p>"
            out.append(self.tag(kind, inner, ["comment", "reply", "comment-body", "response", "post-comment"]))
        inner = "".join(out)
        if kind == "li":
            inner = f"<{(t := r.choice(['ul', 'ol']))}>{inner}</{t}>"
        if r.random() < 0.6:
            inner = f"<h{(n := r.randint(2, 4))}>{self.phrase(1, 3)}</h{n}>" + inner
        return self.tag(r.choice(["section", "div", "div", "aside"]), inner,
                        ["comments", "comment-list", "responses", "discussion", "disqus", "replies", "comments-area", "feedback"])

    def extra(self) -> str:
        return self.r.choice([self.advert, self.advert, self.notice, self.sidebar, self.form, self.menu])()

    def bare(self) -> str:
        """A page of blocks alone, or with a footer or menu around them."""
        r = self.r
        blocks = [self.main_block(k == 0 and r.random() < 0.5) for k in range(r.choice([1, 2, 3, 6]))]
        if r.random() < 0.4:
            blocks = [f"<article>{''.join(blocks)}</article>"]
        if r.random() < 0.5:
            blocks = [self.menu(), *blocks] if r.random() < 0.5 else [self.header(), *blocks]
        if r.random() < 0.6:
            blocks.append(self.footer())
        body = "".join(blocks)
        return f"<html><body>{body}</body></html>" if r.random() < 0.6 else body

    def soup(self) -> str:
        """A page of nothing but div elements with class names."""
        r, m = self.r, " data-main"
        title = f'<div class="{r.choice(["title", "headline", "post-title", "entry-title"])}"{m}>{self.phrase(2, 10)}</div>'
        blocks = [title] + [f"<div{m}>{self.prose()}</div>" for _ in range(r.choice([1, 2, 4, 8]))]
        main = f'<div class="{r.choice(["content", "article", "post", "story", "main", "text", "entry"])}">{"".join(blocks)}</div>'
        around = []
        for words in (["menu", "nav", "topnav"], ["sidebar", "side", "widget"], ["notice", "cookie", "alert"],
                      ["ad", "banner", "promo", "sponsored"], ["comments", "replies", "discussion"], ["footer", "copyright"]):
            if r.random() < 0.6:
                inner = self.links(3, "span") if words[0] == "menu" else r.choice(
                    [self.sentence(), self.prose(3), f"<div>{self.prose(3)}</div>"])
                around.append((r.choice([0, 1, 1]), f'<div class="{r.choice(words)}">{inner}</div>'))
        return ("<body>" + "".join(x for after, x in around if not after) + main
                + "".join(x for after, x in around if after) + "</body>")

    def page(self) -> str:
        r = self.r
        if (kind := r.random()) < 0.1:
            return self.bare()
        if kind < 0.2:
            return self.soup()
        blocks = [self.main_block(k == 0) for k in range(r.choice([1, 1, 2, 2, 3, 4, 6, 9, 14, 25]))]
        for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
            blocks.insert(r.randint(1, len(blocks)), self.extra())
        if r.random() < 0.2:
            blocks.insert(r.randint(1, len(blocks)), self.embedded())
        if r.random() < 0.25:
            blocks.append(self.tag("div", self.links(3, "span"), ["share", "tags", "social", "related", "breadcrumb"]))
        body, name = "\n".join(blocks), r.choice(["article"] * 4 + ["main", "div", "div", "div", "section", ""])
        words = ["article", "content", "post", "entry-content", "story", "article-body", "main-content", "text", "post-body", "prose"]
        inside = self.comments() if r.random() < 0.12 else ""
        if name == "article" or not name:
            body = f"<article>{body}{inside}</article>" if name else body
        else:
            body = self.tag(name, body + inside, words)
        for _ in range(r.randint(0, 2)):
            body = self.tag(r.choice(["div", "main", "section", "div"]), body, ["wrap", "container", "page", "layout", "content", "col", "row"])
        before = [f() for f in (self.header, self.menu, self.advert, self.notice, self.sidebar, self.form) if r.random() < 0.4]
        after = [f() for f in (self.comments, self.comments, self.sidebar, self.advert, self.form, self.notice, self.menu) if r.random() < 0.35]
        if r.random() < 0.1:
            before.append(f"<noscript>{self.sentence()}" + ("</noscript>" if r.random() < 0.8 else ""))
        if r.random() < 0.3:
            r.shuffle(before)
        after.append(self.footer() if r.random() < 0.8 else "")
        page = "\n".join(before) + body + "\n".join(after)
        if r.random() < 0.3:
            page = f'<div class="{r.choice(["page", "site", "wrapper", "container"])}">{page}</div>'
        return (f'<!DOCTYPE html><html><head><title>{self.phrase(2, 8)}</title><style>p{{margin:0}}</style></head>'
                f"<body>{page}" + ("</body></html>" if r.random() < 0.85 else ""))


def labelled_pages(n: int, seed: int = 7) -> list[str]:
    """``n`` pages whose blocks of main text carry the attribute data-main."""
    r = random.Random(seed)
    return [_Writer(r).page() for _ in range(n)]
