"""A recurrent block labeller in numpy: a bidirectional LSTM over a page's leaf blocks.

It reads each block's tag path and hashed words, and the blocks before and
after it, so a paragraph among reader comments and a paragraph of the article
differ by what surrounds them.  ``trained`` fits it to pages that are made up
here, with a known label for every block; the number of pages is a parameter.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np

from .blocks import SIZE, Vectors, leaf_blocks

HIDDEN = 24
#: Made-up pages that the labeller is fitted to, passes over them, and seed.
TRAINING_PAGES, EPOCHS, SEED = 1600, 8, 41


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    def __init__(self, seed: int = SEED, hidden: int = HIDDEN):
        rng = np.random.default_rng(seed)
        self.hidden = hidden

        def init(*shape):
            return (rng.standard_normal(shape) * np.sqrt(1 / shape[0])).astype(np.float32)

        self.w = {}
        for d in ("f", "b"):
            self.w[f"x{d}"], self.w[f"h{d}"], self.w[f"c{d}"] = init(SIZE, 4 * hidden), init(hidden, 4 * hidden), np.zeros(4 * hidden, np.float32)
            self.w[f"c{d}"][hidden : 2 * hidden] = 1.0  # remember, at first
            self.w[f"o{d}"] = init(hidden, 1)[:, 0]
        self.w["skip"], self.w["bias"] = np.zeros(SIZE, np.float32), np.zeros(1, np.float32)

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """Hidden states of one direction, (T, B, H); with ``keep``, what the gradient needs."""
        steps, batch, _ = x.shape
        n, w = self.hidden, self.w
        z = x @ w[f"x{d}"] + w[f"c{d}"]
        h, c = np.zeros((batch, n), np.float32), np.zeros((batch, n), np.float32)
        out, saved = np.zeros((steps, batch, n), np.float32), {}
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            a = z[t] + h @ w[f"h{d}"]
            gates, g = _sigmoid(a[:, : 3 * n]), np.tanh(a[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            m = mask[t][:, None]
            if keep:
                saved[t] = (h, c, i, f, o, g, tanh_c, m)
            h, c = np.where(m, o * tanh_c, h), np.where(m, new_c, c)
            out[t] = h
        return out, saved

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        """Log odds of being main text, (T, B)."""
        w = self.w
        return self._pass("f", x, mask, False)[0] @ w["of"] + self._pass("b", x, mask, False)[0] @ w["ob"] + x @ w["skip"] + w["bias"]

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss (mean cross entropy) and its gradient by backpropagation through time."""
        w, n = self.w, self.hidden
        states = {d: self._pass(d, x, mask, True) for d in ("f", "b")}
        logits = states["f"][0] @ w["of"] + states["b"][0] @ w["ob"] + x @ w["skip"] + w["bias"]
        p, total = _sigmoid(logits), mask.sum()
        loss = -(np.where(y, np.log(p + 1e-7), np.log(1 - p + 1e-7)) * mask).sum() / total
        delta = ((p - y) * mask / total).astype(np.float32)
        g = {"skip": np.einsum("tb,tbk->k", delta, x), "bias": delta.sum(keepdims=True)[0]}
        for d in ("f", "b"):
            out, saved = states[d]
            g[f"o{d}"] = np.einsum("tb,tbh->h", delta, out)
            dz = np.zeros((*x.shape[:2], 4 * n), np.float32)
            dh, dc = np.zeros_like(out[0]), np.zeros_like(out[0])
            g[f"h{d}"] = np.zeros_like(w[f"h{d}"])
            for t in range(len(x) - 1, -1, -1) if d == "f" else range(len(x)):
                h, c, i, f, o, gate, tanh_c, m = saved[t]
                dh = dh + delta[t][:, None] * w[f"o{d}"]
                own_h, own_c = np.where(m, dh, 0), np.where(m, dc, 0)
                own_c = own_c + own_h * o * (1 - tanh_c**2)
                a = np.concatenate([own_c * gate * i * (1 - i), own_c * c * f * (1 - f), own_h * tanh_c * o * (1 - o), own_c * i * (1 - gate**2)], axis=1)
                dz[t] = a
                g[f"h{d}"] += h.T @ a
                dh, dc = np.where(m, a @ w[f"h{d}"].T, dh), np.where(m, own_c * f, dc)
            g[f"x{d}"], g[f"c{d}"] = np.einsum("tbk,tbz->kz", x, dz, optimize=True), dz.sum(axis=(0, 1))
        return float(loss), g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS, batch: int = 24, rate: float = 0.006, seed: int = SEED) -> float:
        """Adam over batches of pages of like length; returns the last epoch's mean loss."""
        rng = random.Random(seed)
        order = sorted(range(len(pages)), key=lambda k: len(pages[k][1]))
        batches = [order[k : k + batch] for k in range(0, len(order), batch)]
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        step, losses = 0, [0.0]
        for epoch in range(epochs):
            rng.shuffle(batches)
            losses = []
            for chosen in batches:
                x, mask = padded([pages[k][0] for k in chosen])
                y = np.zeros(mask.shape, bool)
                for b, k in enumerate(chosen):
                    y[: len(pages[k][1]), b] = pages[k][1]
                loss, g = self.gradient(x, mask, y)
                losses.append(loss)
                step += 1
                norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
                now = rate * (1 - epoch / epochs)
                for k, v in g.items():
                    v = v * min(1.0, 2.0 / max(norm, 1e-6))
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.99 * second[k] + 0.01 * v * v
                    self.w[k] = self.w[k] - (now * first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
        return float(np.mean(losses))

    def label(self, pages: list[np.ndarray], cells: int = 1 << 14) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length share a batch of about ``cells`` blocks."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        while order:
            longest, take = len(pages[order[-1]]), 1
            take = max(1, min(len(order), cells // longest))
            chosen, order = order[-take:], order[:-take]
            x, mask = padded([pages[k] for k in chosen])
            found = self.scores(x, mask) > 0
            for b, k in enumerate(chosen):
                out[k] = found[: len(pages[k]), b]
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(map(len, pages))
    x, mask = np.zeros((longest, len(pages), SIZE), np.float32), np.zeros((longest, len(pages)), bool)
    for b, page in enumerate(pages):
        x[: len(page), b], mask[: len(page), b] = page, True
    return x, mask


# Made-up pages -----------------------------------------------------------------------------------------------------

#: Names that pages give their parts.
NAMES = {
    "nav": "nav menu navbar topnav navigation mainmenu links breadcrumb breadcrumbs tabs",
    "header": "header masthead top banner site-header branding logo",
    "footer": "footer bottom site-footer copyright legal colophon",
    "aside": "sidebar side widget related aside rail trending popular recommended more-stories",
    "notice": "notice cookie cookies consent alert banner gdpr modal popup overlay message warning",
    "ad": "ad ads advert advertisement sponsor sponsored promo adbox banner",
    "form": "form signup newsletter subscribe search login contact",
    "comments": "comments comment replies responses discussion disqus reader-comments thread",
    "share": "share social follow toolbar buttons tags pagination pager",
    "article": "article content post entry story body main article-body post-content text page",
}
#: Words that menus and notices use.
SHORT = "Home About Contact Login Register News Sports Blog Shop Privacy Terms Help Search Next Previous Share Tweet Subscribe Submit Send Reply Like Follow Archive Sitemap Careers Menu More Name Email".split()
NOTICES = "we use cookies to improve your experience accept all privacy policy terms apply sign up for our newsletter sponsored offer buy now read more all rights reserved copyright log in to comment posted by".split()

#: Lines that articles hold and footers, too.
LINES = [
    "All rights reserved.", "Licensed under the Apache License, Version 2.0.", "Copyright 2019 the authors.", "Permission is hereby granted, free of charge.",
    "Write to someone@example.com or call 555 0100.", "Read more below.", "Please subscribe!", "Accept no substitutes.",
]


class PageMaker:
    """Writes pages and says which of their blocks are main text: main blocks carry a mark that is taken off again."""

    MARK = "\ue000"

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.junk = ""
        syllables = [self.r.choice("bcdfghklmnprstvwz") + self.r.choice("aeiouéö") for _ in range(60)]
        self.words = ["".join(self.r.choice(syllables) for _ in range(self.r.randint(1, 4))) for _ in range(3000)]

    def sentence(self, low: int = 3, high: int = 22) -> str:
        words = [self.r.choice(self.words) for _ in range(self.r.randint(low, high))]
        for k in range(len(words)):
            if self.r.random() < 0.06:
                words[k] += ","
            if self.r.random() < 0.01:
                words[k] = self.r.choice(["&amp;", "&copy;", "12", "1999", "&eacute;"])
        if self.junk and self.r.random() < 0.8:  # main text need not be good text
            if self.junk == "again":
                words = [w for w in words[:6] for _ in range(self.r.randint(3, 30))]
            words = words if self.junk == "again" else [w.upper() + "!!" if self.junk == "!" else f"{w} {self.junk}" if self.junk == "|" else w + 3 * self.junk for w in words]
        return " ".join(words).capitalize() + self.r.choice([".", ".", ".", "!", "?", ""])

    def paragraph(self, most: int = 7) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def named(self, kind: str, tags: list[str]) -> tuple[str, str]:
        """Opening and closing tag of a part."""
        tag = self.r.choice(tags)
        words = NAMES[kind].split()
        plain = tag != "div" and self.r.random() < 0.5
        attribute = "" if plain else f' {self.r.choice(["class", "class", "id"])}="{self.r.choice(words)}{self.r.choice(["", "", "-1", " wide", " box"])}"'
        return f"<{tag}{attribute}>", f"</{tag}>"

    def link(self) -> str:
        text = self.r.choice(SHORT) if self.r.random() < 0.4 else " ".join(self.r.choice(self.words) for _ in range(self.r.randint(1, 4)))
        return f'<a href="/{self.r.randint(1, 999)}">{text.capitalize() if self.r.random() < 0.7 else text}</a>'

    def links(self, kind: str, tags: list[str]) -> str:
        a, b = self.named(kind, tags)
        many = [self.link() for _ in range(self.r.randint(2, 9))]
        form = self.r.random()
        if form < 0.6:
            return a + "<ul>" + "".join(f"<li>{x}</li>" for x in many) + "</ul>" + b
        if form < 0.8:
            return a + " | ".join(many) + b
        return a + "".join(f"<div>{x}</div>" for x in many) + b

    def boilerplate(self, kind: str) -> str:
        r = self.r
        if kind in ("nav", "share"):
            return self.links(kind, ["nav", "div", "ul"] if kind == "nav" else ["div"])
        if kind == "header":
            a, b = self.named(kind, ["header", "div"])
            title = " ".join(r.choice(self.words) for _ in range(r.randint(1, 3))).title()
            return a + r.choice([f"<h1>{title}</h1>", f"<div>{title}</div>", f"<p>{self.sentence(2, 8)}</p>", f'<a href="/">{title}</a><p>{self.sentence(3, 8)}</p>']) + (self.links("nav", ["nav", "div"]) if r.random() < 0.4 else "") + b
        if kind == "footer":
            a, b = self.named(kind, ["footer", "div"])
            line = r.choice(["&copy; ", "&copy; 2024 ", "Copyright ", ""]) + r.choice([self.sentence(2, 12), f"{r.choice(self.words)}.example.com &middot; {self.sentence(2, 12)}", " ".join(r.choice(NOTICES) for _ in range(6))])
            return a + r.choice([line, f"<p>{line}</p>", f"<div>{line}</div>"]) + (self.links("footer", ["div", "ul"]) if r.random() < 0.5 else "") + b
        if kind == "aside":
            a, b = self.named(kind, ["aside", "div", "section"])
            inner = f"<h3>{self.sentence(1, 4)}</h3>" if r.random() < 0.6 else ""
            return a + inner + "".join(r.choice([f"<p>{self.paragraph(3)}</p>", f"<ul><li>{self.link()}</li><li>{self.link()}</li></ul>", f"<div>{self.sentence()}</div>"]) for _ in range(r.randint(1, 4))) + b
        if kind == "notice":
            a, b = self.named(kind, ["div", "div", "section"])
            text = " ".join(r.choice(NOTICES) for _ in range(r.randint(4, 14))).capitalize() + "." if r.random() < 0.6 else self.paragraph(3)
            return a + r.choice([text, f"<p>{text}</p>"]) + r.choice(["", "<button>Accept</button>", self.link()]) + b
        if kind == "ad":
            a, b = self.named(kind, ["div", "div", "aside", "ins"])
            return a + r.choice([self.sentence(), f"<p>{self.paragraph(3)}</p>", self.link()]) + b
        if kind == "form":
            a, b = self.named(kind, ["form", "form", "div"])
            if not a.startswith("<form"):
                a, b = a + "<form>", "</form>" + b
            return a + f"<label>{r.choice(SHORT)}</label><input type=text>" + r.choice(["", f"<p>{self.paragraph(2)}</p>", "<select><option>One<option>Two</select>", f"<textarea>{self.sentence()}</textarea>"]) + f"<button>{r.choice(SHORT)}</button>" + b
        a, b = self.named("comments", ["section", "div", "div", "ol"])
        one = lambda: r.choice(["<div class=comment>{}</div>", "<li>{}</li>", "<article class='comment'>{}</article>", "<div>{}</div>"]).format(
            r.choice(["", f"<b>{r.choice(self.words)}</b> says:<br>", f"<div class=author>{r.choice(self.words).title()}</div>", f"<h4>{r.choice(self.words)}</h4>"]) + "".join(f"<p>{self.paragraph(4)}</p>" for _ in range(r.randint(1, 3)))
        )
        return a + r.choice(["", "<h2>Comments</h2>", f"<h3>{r.randint(1, 99)} {r.choice(['comments', 'replies'])}</h3>"]) + "".join(one() for _ in range(r.randint(1, 6))) + b

    def article(self) -> str:
        r, mark = self.r, self.MARK
        parts = []
        self.junk = r.choice(["|", "*", "#", "%", "&amp;", "!", "again", "again"]) if r.random() < 0.16 else ""
        if r.random() < 0.85:
            parts.append(f"<h1>{mark}{self.sentence(2, 12)}</h1>")
        for _ in range(r.choice([1, 2, 3, 5, 8, 14, 25])):
            form = r.random()
            if form < 0.06:
                parts.append(f"<p>{mark}{r.choice([*LINES, *[self.sentence(1, 2).strip('.!?') for _ in LINES]])}</p>")
            elif form < 0.70:
                parts.append(f"<p>{mark}{self.paragraph()}</p>")
            elif form < 0.76:
                parts.append(f"<p><b>{mark}{self.paragraph(3)}<br><p>{mark}{self.paragraph()}</p>")
            elif form < 0.82:
                parts.append(f"<h2>{mark}{self.sentence(1, 7)}</h2>")
            elif form < 0.87:
                parts.append(f"<{(t := r.choice(['ul', 'ol']))}>" + "".join(f"<li>{mark}{self.sentence(1, 12)}</li>" for _ in range(r.randint(2, 6))) + f"</{t}>")
            elif form < 0.91:
                parts.append(f"<blockquote>{r.choice([mark + self.sentence(), f'<p>{mark}{self.paragraph(3)}</p>'])}</blockquote>")
            elif form < 0.94:
                parts.append("<table>" + "".join("<tr>" + "".join(f"<td>{mark}{self.sentence(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif form < 0.97:
                parts.append(f"<div>{mark}{self.paragraph(4)}</div>")
            else:
                parts.append(r.choice([f"<pre>{mark}{self.sentence()}</pre>", f"<figure><img src=x><figcaption>{mark}{self.sentence(2, 9)}</figcaption></figure>", f"<p>{mark}{self.sentence(1, 2)}</p>"]))
        self.junk = ""
        for kind in ("ad", "form", "aside", "share", "notice"):
            if len(parts) > 2 and r.random() < 0.06:
                parts.insert(r.randint(1, len(parts)), self.boilerplate(kind))
        a, b = self.named("article", ["article", "article", "article", "main", "div", "section"])
        if r.random() < 0.2:
            c, d = self.named("article", ["main", "div"])
            a, b = c + a, b + d
        return a + "".join(parts) + b

    def page(self) -> tuple[str, list[bool]]:
        r = self.r
        before = [k for k in ("notice", "header", "nav", "ad", "aside", "form", "share") if r.random() < {"nav": 0.75, "ad": 0.4, "header": 0.4}.get(k, 0.2)]
        after = [k for k in ("share", "ad", "comments", "form", "aside", "notice", "nav", "footer") if r.random() < {"footer": 0.8, "comments": 0.4, "aside": 0.3}.get(k, 0.2)]
        if r.random() < 0.3:
            r.shuffle(before)
            r.shuffle(after)
        body = "".join(map(self.boilerplate, before)) + (self.article() if r.random() < 0.96 else "") + "".join(map(self.boilerplate, after))
        if r.random() < 0.3:
            body = f"<div class={r.choice(['page', 'wrapper', 'container', 'site'])}>{body}</div>"
        html = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{self.sentence(2, 6)}</title><style>p{{margin:0}}</style></head><body>{body}</body></html>"
        return html, [self.MARK in text for _, text, _ in leaf_blocks(html)]


def made_up(count: int, seed: int) -> list[tuple[list, np.ndarray, str]]:
    """Blocks, labels and html (without marks) of ``count`` pages."""
    maker, out = PageMaker(seed), []
    while len(out) < count:
        html, labels = maker.page()
        html = html.replace(PageMaker.MARK, "")
        blocks = leaf_blocks(html)
        if blocks and len(blocks) == len(labels):
            out.append((blocks, np.array(labels), html))
    return out


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES, epochs: int = EPOCHS, seed: int = SEED) -> Labeller:
    """The labeller, fitted once a process; the same arguments give the same weights."""
    vectors = Vectors()
    model = Labeller(seed)
    model.fit([(vectors.of(blocks), labels) for blocks, labels, _ in made_up(pages, seed)], epochs, seed=seed)
    return model
