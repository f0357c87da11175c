"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page becomes the sequence of its leaf blocks: stretches of text between block-level tags. A block is described by its ancestor
tags, words in their class and id attributes, and figures of its text; the field scores every block and every pair of neighbours, and a
Viterbi pass finds the likeliest sequence of labels. Blocks labelled as content are the main text.

It is trained on labelled pages: at most ``SAMPLE`` pages that name their article in markup. Their blocks are labelled by it, and for a
part of the training the markup is hidden and known clutter (sidebars, notices, comments, forms, adverts made of other pages'
text) is put in, so that the field learns what the table's own pages show too rarely.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import pieces, stored

SAMPLE = 300
# Characters of a page that the field is trained on, at most.
LONGEST = 300_000
ROUNDS, RATE, DECAY = 300, 0.15, 1e-5
# Blocks in one training sequence.
SPAN = 100

# HTML's elements by kind.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page: the first run to the page's end if none closes them, the others only count if closed.
RAW = "script|style"
UNSEEN = "noscript|template|textarea|svg|iframe|object|audio|video|canvas|title"
ANCESTORS = (
    "article main section aside nav header footer form ul ol li table td th p h1 h2 h3 h4 h5 h6 blockquote pre figure figcaption "
    "button label select option a dl dd dt details summary fieldset address dialog menu div body".split()
)
# Words in class, id and role attributes, by what they hint at.
HINTS = {
    "advert": "ad ads adv advert advertisement adsense banner sponsor sponsored promo promoted promotion",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar topbar tabs skip",
    "side": "sidebar side aside widget rail related recommended popular trending tags toc",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay subscribe newsletter signup paywall disclaimer",
    "comment": "comment comments commentlist reply replies discussion disqus respond reviews",
    "share": "share sharing social follow byline author meta",
    "edge": "header footer masthead copyright legal bottom top contentinfo complementary",
    "body": "article content post entry story main text body prose",
}
_HINT_OF = {w: k for k, words in HINTS.items() for w in words.split()}
# What may stand beside a hint in one name without a change of its sense.
_PARTS = frozenset(
    "list box block wrapper wrap container area section group bar link links item items inner outer left right main primary secondary "
    "unit slot panel column col row holder form button title head body content page site global the".split()
)
# Elements above a block, without an article around it, whose names count.
NEAR = 5
# Elements of running text, whose own names say little: a paragraph of class "legal" may be about law.
_TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote li dd dt pre td th figcaption".split())

_REST = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<!\[CDATA\[|\]\]>|<[!?][^>]*>"
    rf"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>{_REST})(?:>|\Z)",
    re.S | re.I,
)
_UNSEEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})(?=[\s/>])[^>]*>|<(?P<close>/?)(?P<tag>{UNSEEN})(?=[\s/>])(?P<rest>{_REST})>", re.S | re.I
)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
_ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_ANY_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_LIST_ITEM = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table", "tbody", "thead", "tfoot"), "td": ("tr",), "th": ("tr",), "option": ("select",)}


class Block:
    """A leaf block: its text, the open tags and hints above it, hints of its own element alone, and its characters in links."""

    __slots__ = ("text", "tags", "hints", "linked", "own")

    def __init__(self, text: str, tags: tuple[str, ...], hints: frozenset[str], linked: int, own: frozenset[str] = frozenset()):
        self.text, self.tags, self.hints, self.linked, self.own = text, tags, hints, linked, own


def unseen(page: str) -> dict[int, int]:
    """Where closed elements that hold no text of the page start and end; an end tag closes the last one open, ``/>`` an svg."""
    ends: dict[int, int] = {}
    open_at: dict[str, list[int]] = {name: [] for name in UNSEEN.split("|")}
    at = 0
    while m := _UNSEEN.search(page, at):
        at = m.end()
        if raw := m.group("raw"):
            if open_at["svg"] and m.group().endswith("/>"):
                continue
            end = _RAW_END[raw.lower()].search(page, at)
            at = end.end() if end else len(page)
        elif tag := m.group("tag"):
            tag = tag.lower()
            if m.group("close"):
                if open_at[tag]:
                    ends[open_at[tag].pop()] = at
            elif tag != "svg" or not m.group("rest").endswith("/"):
                open_at[tag].append(m.start())
    return ends


def leaf_blocks(page: str) -> list[Block]:
    """The page's leaf blocks in order. Markup left open, or cut off, is closed where HTML would close it."""
    out: list[Block] = []
    stack = _Open()
    parts: list[str] = []
    linked = 0
    none: frozenset[str] = frozenset()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(text, *stack.above(), linked, stack.own()))
            parts.clear()
            linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if stack.count["a"]:
            linked += len(text)

    ends = unseen(page)
    at = 0
    while m := _MARKUP.search(page, at):
        if m.start() > at:
            add(page[at : m.start()])
        if m.start() in ends:
            at = ends[m.start()]
            continue
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        block = tag in BLOCK_TAGS
        if block:
            flush()
        if tag in VOID_TAGS:
            continue
        if m.group("close"):
            stack.close(tag, block)
        else:
            if block:
                _close_before(stack, tag)
            rest = m.group("rest")
            if rest.endswith("/") and not block:
                continue
            # names of the whole page say nothing about a part of it
            stack.open(tag, _hints(rest) if rest and tag not in ("html", "body") else none)
    if at < len(page):
        add(page[at:])
    flush()
    return out


class _Open:
    """The open elements. Tags are counted, and those that say something of a block are listed apart, so that unclosed inline
    elements cost nothing each time."""

    def __init__(self):
        self.tags: list[str] = []
        self.count: Counter[str] = Counter()
        self.listed: list[tuple[int, str, frozenset[str]]] = []

    def open(self, tag: str, hints: frozenset[str]) -> None:
        if hints or tag in BLOCK_TAGS or tag in _ANCESTOR:
            self.listed.append((len(self.tags), tag, hints))
        self.tags.append(tag)
        self.count[tag] += 1

    def cut(self, k: int) -> None:
        self.count.subtract(self.tags[k:])
        del self.tags[k:]
        while self.listed and self.listed[-1][0] >= k:
            self.listed.pop()

    def close(self, tag: str, block: bool) -> None:
        if not self.count[tag]:
            return
        if not block:
            # no further down than the block-level element it is in
            for k in range(len(self.tags) - 1, -1, -1):
                if self.tags[k] == tag:
                    self.cut(k)
                    return
                if self.tags[k] in BLOCK_TAGS:
                    return
            return
        self.cut(next(i for i, t, _ in reversed(self.listed) if t == tag))

    def above(self) -> tuple[tuple[str, ...], frozenset[str]]:
        """Listed tags, and hints: of elements below the outermost article, or else of the nearest; of others only that they are comments or hidden."""
        root = next((n for n, (_, t, _) in enumerate(self.listed) if t in ("article", "main")), len(self.listed) - 1 - NEAR)
        found = set()
        for n, (_, _, hints) in enumerate(self.listed):
            found |= hints if n > root else hints & _FAR_HINTS
        return tuple(t for _, t, _ in self.listed), frozenset(found)

    def own(self) -> frozenset[str]:
        """Hints of the innermost listed element that no other element has."""
        if not self.listed or self.listed[-1][1] in ("article", "main"):
            return frozenset()
        return self.listed[-1][2].difference(*(h for _, _, h in self.listed[:-1]))


_ANCESTOR = frozenset(ANCESTORS)
_FAR_HINTS = frozenset(("comment", "hidden"))


def _close_before(stack: _Open, tag: str) -> None:
    """What the start of a block-level element closes: an open paragraph, or the list item or cell before it."""
    for k, name, _ in reversed(stack.listed):
        if name == "p":
            stack.cut(k)
            return
        if tag in _LIST_ITEM and (name == tag or {name, tag} <= {"dt", "dd"} or {name, tag} <= {"td", "th"}):
            stack.cut(k)
            return
        if tag in _LIST_ITEM and name in _LIST_ITEM[tag]:
            return
        if name in BLOCK_TAGS and tag not in _LIST_ITEM:
            return


def _hints(rest: str) -> frozenset[str]:
    """What the names in class, id and role hint at. A name counts if all its words are known; its last hint counts."""
    found = set()
    for m in _ATTRIBUTE.finditer(rest):
        for name in (m.group(1) or m.group(2) or m.group(3) or "").split():
            words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]
            hints = [_HINT_OF[w] for w in words if w in _HINT_OF]
            if hints and all(w in _HINT_OF or w in _PARTS for w in words):
                found.add(hints[-1])
    if _is_hidden(rest):
        found.add("hidden")
    return frozenset(found)


def _is_hidden(rest: str) -> bool:
    """Whether a ``hidden`` attribute, ``aria-hidden=true`` or a style without display hides the element."""
    lowered = rest.lower()
    if "hidden" not in lowered and "none" not in lowered:
        return False
    for m in _ANY_ATTRIBUTE.finditer(rest):
        name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


_NAMES = (
    [f"in {t}" for t in ANCESTORS]
    + [f"hint {h}" for h in (*HINTS, "hidden")]
    + [f"own {h}" for h in HINTS]
    + ["own hint in text", "own hint in sentences"]
    + [f"words {k}" for k in range(8)]
    + [f"links {k}" for k in range(4)]
    + ["ends", "mark ©", "digits", "upper", "short", "first", "last", "after heading", "no block above", "bias"]
)
_INDEX = {n: i for i, n in enumerate(_NAMES)}
N_FEATURES = len(_NAMES)


def active(blocks: list[Block]) -> list[list[int]]:
    """The features that hold, block by block."""
    out = []
    heading = False
    for k, b in enumerate(blocks):
        text, words = b.text, b.text.count(" ") + 1
        found = {_INDEX[f"in {t}"] for t in b.tags if f"in {t}" in _INDEX}
        own = b.own - {"hidden"}
        found.update(_INDEX[f"hint {h}"] for h in b.hints - own)
        found.update(_INDEX[f"own {h}"] for h in own)
        if own & _CLUTTER_HINTS and _is_text(b):
            found.add(_INDEX["own hint in text"])
            if words > 5 and text[-1] in ".!?…。":
                found.add(_INDEX["own hint in sentences"])
        found.add(_INDEX[f"words {min(7, words.bit_length() - 1)}"])
        share = b.linked / max(1, len(text))
        found.add(_INDEX[f"links {0 if not b.linked else 1 if share < 0.3 else 2 if share < 0.8 else 3}"])
        if text[-1] in ".!?…。":
            found.add(_INDEX["ends"])
        if "©" in text:
            found.add(_INDEX["mark ©"])
        if sum(c.isdigit() for c in text[:200]) > 0.2 * min(200, len(text)):
            found.add(_INDEX["digits"])
        if text.isupper():
            found.add(_INDEX["upper"])
        if words < 4:
            found.add(_INDEX["short"])
        if k == 0:
            found.add(_INDEX["first"])
        if k == len(blocks) - 1:
            found.add(_INDEX["last"])
        if heading:
            found.add(_INDEX["after heading"])
        if not any(t in BLOCK_TAGS and t not in ("html", "body") for t in b.tags):
            found.add(_INDEX["no block above"])
        heading = any(t in ("h1", "h2", "h3") for t in b.tags)
        found.add(_INDEX["bias"])
        out.append(sorted(found))
    return out


_CLUTTER_ABOVE = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset"}
_CLUTTER_HINTS = {"advert", "menu", "side", "notice", "comment", "share", "hidden"}


def _is_text(b: Block) -> bool:
    """Whether the block's own element is one of running text."""
    return bool(b.tags) and b.tags[-1] in _TEXT_TAGS


def _plain_in_article(b: Block) -> bool:
    """Inside an article or main element, without a sign of clutter above; names of a sentence's own element are no sign."""
    hints = b.hints - (b.own - {"hidden"}) if _is_text(b) and b.text[-1] in ".!?…。" else b.hints
    return bool({"article", "main"} & set(b.tags)) and not _CLUTTER_ABOVE & set(b.tags) and not _CLUTTER_HINTS & hints


class Field:
    """A linear-chain conditional random field with the labels clutter (0) and content (1)."""

    def __init__(self, weights: np.ndarray | None = None, steps: np.ndarray | None = None):
        self.weights = np.zeros((N_FEATURES, 2)) if weights is None else weights
        self.steps = np.zeros((2, 2)) if steps is None else steps
        self._margin = (self.weights[:, 1] - self.weights[:, 0]).tolist()

    def fit(self, pages: list[tuple[list[list[int]], list[int]]]) -> Field:
        """Maximum likelihood by Adam, with the forward-backward recursion over all sequences side by side.

        Sequences of more than ``SPAN`` blocks are cut into several, so one long page does not set the number of steps.
        """
        parts = [(x[k : k + SPAN], y[k : k + SPAN]) for x, y in pages for k in range(0, len(y), SPAN)]
        parts.sort(key=lambda p: -len(p[1]))  # at each step the sequences that go on come first
        if not parts:
            return self
        sizes = np.array([len(y) for _, y in parts])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        total, longest = int(sizes.sum()), int(sizes[0])
        going = [int((sizes > t).sum()) for t in range(longest)]
        at = [starts[: going[t]] + t for t in range(longest)]
        x = np.zeros((total, N_FEATURES))
        for r, found in enumerate(f for rows, _ in parts for f in rows):
            x[r, found] = 1
        y = np.concatenate([y for _, y in parts]).astype(int)
        truth = np.eye(2)[y]
        true_steps = np.zeros((2, 2))
        joined = np.ones(total, bool)
        joined[starts] = False
        np.add.at(true_steps, (y[:-1][joined[1:]], y[1:][joined[1:]]), 1)
        w, s = self.weights.copy(), self.steps.copy()
        m, v = [np.zeros_like(w), np.zeros_like(s)], [np.zeros_like(w), np.zeros_like(s)]
        for step in range(1, ROUNDS + 1):
            e = x @ w
            e = np.exp(e - e.max(axis=1, keepdims=True))
            move = np.exp(s)
            forward, backward, scale = np.empty((total, 2)), np.ones((total, 2)), np.empty(total)
            f = e[at[0]]
            for t in range(longest):
                if t:
                    f = (f[: going[t]] @ move) * e[at[t]]
                c = f.sum(axis=1)
                f = f / c[:, None]
                forward[at[t]], scale[at[t]] = f, c
            for t in range(longest - 2, -1, -1):
                nxt = at[t + 1]
                backward[nxt - 1] = ((e[nxt] * backward[nxt]) @ move.T) / scale[nxt][:, None]
            p = forward * backward
            p /= p.sum(axis=1, keepdims=True)
            nxt = np.flatnonzero(joined)
            pair = (forward[nxt - 1].T @ (e[nxt] * backward[nxt] / scale[nxt][:, None])) * move
            g = [x.T @ (p - truth) / total + DECAY * w, (pair - true_steps) / total + DECAY * s]
            for k, q in enumerate((w, s)):
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                q -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return Field(w, s)

    def labels(self, rows: list[list[int]]) -> list[int]:
        """The likeliest sequence of labels (Viterbi)."""
        if not rows:
            return []
        margin = self._margin
        (s00, s01), (s10, s11) = self.steps.tolist()
        a, b = 0.0, sum(margin[f] for f in rows[0])
        back = []
        for found in rows[1:]:
            e = sum(margin[f] for f in found)
            from_clutter, from_content = a + s00 >= b + s10, a + s01 >= b + s11
            a, b = max(a + s00, b + s10), max(a + s01, b + s11) + e
            back.append((from_clutter, from_content))
        label = int(b > a)
        out = [label]
        for from_clutter, from_content in reversed(back):
            label = 0 if (from_content if label else from_clutter) else 1
            out.append(label)
        return out[::-1]

    def extract(self, page: str) -> str:
        """The main text: content blocks in page order, two line ends between them."""
        blocks = leaf_blocks(page)
        return "\n\n".join(b.text for b, label in zip(blocks, self.labels(active(blocks)), strict=True) if label)


def marked_labels(blocks: list[Block]) -> list[int] | None:
    """Labels from markup: content is what stands plainly in an article or main element; None where nothing does."""
    labels = [int(_plain_in_article(b)) for b in blocks]
    return labels if any(labels) else None


def _clutter(rng: np.random.Generator, texts: list[str]) -> list[Block]:
    """A piece of clutter made of other blocks' text, as pages have it."""

    def text(least: int, most: int) -> str:
        words = texts[rng.integers(len(texts))].split()
        return " ".join(words[: rng.integers(least, most + 1)]) or "more"

    kinds = [
        (("aside", "p"), (), 5, 30), (("div", "p"), ("side",), 4, 30), (("aside", "ul", "li", "a"), (), 1, 6), (("div", "ul", "li"), ("side",), 1, 8),
        (("section", "h2"), ("comment",), 1, 3), (("section", "p"), ("comment",), 4, 40), (("div", "p"), ("comment",), 4, 40), (("ol", "li", "p"), ("comment",), 4, 40),
        (("div", "p"), ("notice",), 5, 25), (("div",), ("notice",), 4, 20), (("form", "label"), (), 1, 4), (("form", "button"), (), 1, 3), (("form", "p"), (), 3, 12),
        (("div",), ("advert",), 3, 15), (("div", "p"), ("advert",), 3, 20), (("header", "p"), (), 2, 10), (("header", "h1"), (), 1, 6), (("header", "nav", "a"), (), 1, 3),
        (("footer", "p"), (), 3, 20), (("div", "p"), ("edge",), 3, 20), (("div", "a"), ("share",), 1, 3), (("div",), ("share",), 1, 5), (("nav", "ol", "li"), ("menu",), 1, 4),
        (("div", "a"), ("menu",), 1, 3), (("dialog", "p"), (), 4, 20), (("div", "p"), ("hidden",), 3, 20),
    ]
    tags, hints, least, most = kinds[rng.integers(len(kinds))]
    out = []
    for _ in range(rng.integers(1, 4)):
        t = text(least, most)
        # a container has the name, or the element itself
        own = frozenset(hints) if len(tags) == 1 else frozenset()
        out.append(Block(t, tags, frozenset(hints), len(t) if tags[-1] == "a" else 0, own))
    return out


_UNLUCKY = sorted(_CLUTTER_HINTS - {"hidden"})
_CONTENT = (("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("table", "tr", "td"), ("h2",), ("h3",), ("pre",), ("figure", "figcaption"), ("section", "p"), ("div",), ("dl", "dd"))


def training_pages(pages: list[str], seed: int = 11) -> list[tuple[list[list[int]], list[int]]]:
    """Features and labels of the pages as they are, with clutter put in, and with the article's tag hidden as well."""
    rng = np.random.default_rng(seed)
    parsed = [(b, marked_labels(b)) for b in map(leaf_blocks, pages)]
    parsed = [(b, y) for b, y in parsed if y is not None]
    texts = [b.text for blocks, _ in parsed for b in blocks if " " in b.text]
    out = []
    for blocks, y in parsed:
        out.append((active(blocks), y))
        if not texts:
            continue
        for hide in (False, True):
            inside = blocks[[k for k, label in enumerate(y) if label][0]].tags
            above = inside[: next(i for i, t in enumerate(inside) if t in ("article", "main")) + 1]
            mixed, labels = [], []
            for b, label in zip(blocks, y, strict=True):
                if rng.random() < 0.12:
                    for c in _clutter(rng, texts):
                        # clutter stands beside the article or inside it
                        within = above if label else ("html", "body")
                        mixed.append(Block(c.text, (*within, *c.tags), c.hints, c.linked, c.own))
                        labels.append(0)
                if label and _is_text(b) and b.text[-1] in ".!?…。" and rng.random() < 0.08:
                    unlucky = frozenset((_UNLUCKY[rng.integers(len(_UNLUCKY))],))
                    b = Block(b.text, b.tags, b.hints | unlucky, b.linked, b.own | unlucky)
                mixed.append(b)
                labels.append(label)
                if label and rng.random() < 0.05:
                    # forms of content that the pages at hand may lack
                    form = _CONTENT[rng.integers(len(_CONTENT))]
                    for _ in range(rng.integers(1, 4)):
                        words = texts[rng.integers(len(texts))].split()
                        mixed.append(Block(" ".join(words[: rng.integers(2, 30)]), (*above, *form), frozenset(), 0))
                        labels.append(1)
            if hide:
                mixed = [Block(b.text, tuple("div" if t in ("article", "main") else t for t in b.tags), b.hints, b.linked, b.own) for b in mixed]
            out.append((active(mixed), labels))
    return out


def fit(pages: DataFrame, sample: int = SAMPLE) -> Field:
    """A field from at most ``sample`` pages with an article element, those with the smallest url and id hashes.

    Pages beyond ``LONGEST`` characters are extracted like all others, but not trained on.
    """
    marked = pages.where((F.length("html") <= LONGEST) & F.col("html").rlike("(?i)<(article|main)[ >]")).select(F.xxhash64("page_id", "url").alias("k"), "html")
    # the hashes first: no task gives out more than the pages that are chosen in the end
    keys = stored(marked.select("k").distinct().orderBy("k").limit(sample), "page-keys")
    chosen = marked.join(F.broadcast(keys), "k").groupBy("k").agg(F.min("html").alias("html"))  # at most `sample` numbers
    return Field().fit(training_pages([r["html"] for r in chosen.orderBy("k").collect()]))


def main_text(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text, n_chars for every page; null or empty pages, and pages without content, give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            texts = [field.extract(h or "") for h in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def extracted(pages: DataFrame) -> DataFrame:
    """Fit on the table's own marked pages, then extract every page."""
    return main_text(pages, fit(pages))
