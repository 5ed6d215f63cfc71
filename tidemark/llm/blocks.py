"""Leaf blocks of an HTML page with their tag paths, and the vectors the block labeller reads."""

from __future__ import annotations

import re
from html import unescape
from math import log1p
from zlib import crc32

import numpy as np

#: Elements of a formula; their text is text of the page.
MATH = frozenset(
    "math maction maligngroup malignmark menclose merror mfenced mfrac mglyph mi mlabeledtr mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics annotation annotation-xml".split()
)
#: Elements that do not end a block.
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
HIDDEN = "script|style|noscript|template|title|svg|iframe|object|canvas|audio|video|head"
#: An opening tag on the left ends open elements on the right, up to the nearest element of the last column.
IMPLIED_END = {
    "p": ({"p"}, None), "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<svg(?=[\s/])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>"  # has no content
    rf"|<(?P<hidden>(?:{HIDDEN.replace('|head', '')}))(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=hidden)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
PIECES = re.compile(r"[a-z]+|[0-9]+")

PATH_SIZE, WORD_SIZE, SCALARS = 160, 32, 12
SIZE = PATH_SIZE + WORD_SIZE + SCALARS


def leaf_blocks(html: str) -> list[tuple[tuple[str, ...], str, int]]:
    """Path (tags, and class, id and role words as ``.word``), text and characters inside links of each non-empty leaf block."""
    out: list[tuple[tuple[str, ...], str, int]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    linked = links = in_head = 0

    def end_block() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append((tuple(w for _, own in stack if own for w in own), text, min(linked, len(text))))
            held.clear()
        linked = 0

    for m in TOKEN.finditer(html):
        text = m["text"]
        if text is not None:
            if not in_head:
                piece = unescape(text) if "&" in text else text
                held.append(piece)
                if links:
                    linked += len(piece.strip())
            continue
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "head":
            in_head = 0 if m["close"] else 1
            continue
        if name in ("body", "html"):
            in_head = 0 if name == "body" else in_head
        if in_head and name not in ("meta", "link", "base"):
            in_head = 0 if name != "html" else in_head
        if m["close"]:
            if name in INLINE:
                if name == "a":
                    links = max(0, links - 1)
                continue
            end_block()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in INLINE:
            if name == "a":
                links += 1
            continue
        end_block()
        links = 0
        if name in VOID:
            continue
        ends, fence = IMPLIED_END.get(name, (set(), None))
        if name in ENDS_P:
            ends = ends | {"p"}
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ends:
                del stack[k:]
                break
            if fence and stack[k][0] in fence or k < len(stack) - 3:
                break
        rest = m["rest"]
        words: list[str] = []
        if "=" in rest:
            for found in NAMES.finditer(rest):
                words += ["." + w for w in PIECES.findall(unescape(found[1] or found[2] or found[3] or "").lower()) if not w.isdigit()]
        if not m["rest"].endswith("/"):
            stack.append((name, (name, *words)))
    end_block()
    return out


class Vectors:
    """Turns leaf blocks into vectors; remembers the part that depends on the path."""

    def __init__(self):
        self.places: dict[tuple[str, ...], int] = {}
        self.rows: list[np.ndarray] = []

    def _path(self, path: tuple[str, ...]) -> int:
        at = self.places.get(path)
        if at is None:
            if len(self.rows) > 50_000:
                self.places.clear()
                self.rows.clear()
            row = np.zeros(PATH_SIZE, np.float32)
            tags = [w for w in path if w[0] != "."]
            for w in path:  # where in the path, in short: anywhere, and as the last two tags
                row[crc32(w.encode()) % 128] = 1.0
            for depth, w in enumerate(tags[-2:]):
                row[128 + crc32(f"{depth}{w}".encode()) % 32] = 1.0
            at = self.places[path] = len(self.rows)
            self.rows.append(row)
        return at

    def of(self, blocks: list[tuple[tuple[str, ...], str, int]]) -> np.ndarray:
        n = len(blocks)
        out = np.zeros((n, SIZE), np.float32)
        cells: list[int] = []
        for k, (path, text, linked) in enumerate(blocks):
            at = self._path(path)
            out[k, :PATH_SIZE] = self.rows[at]
            words = text.lower().encode().split()
            cells += [k * WORD_SIZE + crc32(w) % WORD_SIZE for w in words]
            size = len(text)
            out[k, PATH_SIZE + WORD_SIZE :] = (
                log1p(size) / 5, log1p(len(words)) / 4, linked / size, (text.count(".") + text.count("!") + text.count("?")) / (len(words) + 1),
                text.count(",") / (len(words) + 1), text[-1] in ".!?…\"”", size < 25, size > 120, k / n, (n - k) / n, "©" in text, text[0].isdigit(),
            )
        counts = np.bincount(np.array(cells, np.int64), minlength=n * WORD_SIZE) if n else np.zeros(0)
        out[:, PATH_SIZE : PATH_SIZE + WORD_SIZE] = np.log1p(counts.reshape(n, WORD_SIZE)) / 3
        return out
