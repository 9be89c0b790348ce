"""HTML extraction: a linear-chain CRF over the leaf blocks of a page.

A page is cut into leaf blocks, the stretches of text between the tags
that break a line. Each block is described by its ancestors (tag names,
and the words of their class, id and role), by its own text (length, link
share, end mark, typical words) and by its place. A linear-chain
conditional random field labels the blocks as main text or boilerplate:
weights per feature and label plus a weight per pair of neighbouring
labels, trained with forward-backward gradients on labelled pages and
decoded by Viterbi.

The labelled pages come from ``labelled_pages``: layouts (article, main,
plain divisions with telling or with neutral class names; menus, banners,
notices, adverts, sidebars, forms, related links, comments, footers around
and inside), with made-up words, whose blocks are labelled as they are
put together. Trained once on the driver; the weights have the size of the
features seen in training.

Scripts, styles, templates, comments and the document head are not text
and never become blocks. Character references are decoded, white space in
a block becomes one space, and kept blocks are joined in page order by one
space; nothing is cut off.

Defined cases: a null or empty page, or one without text, gives an empty
text; broken markup is read as far as it goes (a tag that never closes
ends with its parent, a bare ``<`` is text); very long and very deeply nested
pages are read whole, in time linear in their tags; rows are independent, so
repeated rows and extra columns do not matter; an empty table gives an empty
result.
"""

from __future__ import annotations

import html
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import share_code, text_slices

# --- Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NOT_TEXT = frozenset("script style template noscript title textarea iframe object svg".split())
INLINE = frozenset("""a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s
samp small span strike strong sub sup time tt u var wbr""".split())
# A new one of these ends an open one of the same set (up to the given borders).
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "option": ({"option"}, {"select"}),
          "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"})}
ENDS_PARAGRAPH = frozenset("""address article aside blockquote details div dl fieldset figure
footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
_PARAGRAPH_BORDERS = {"td", "th", "li"} | (ENDS_PARAGRAPH - {"p"})

_TAG_START = re.compile(r"<[a-zA-Z/!]")
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>"
                  r"|<[!?/][^>]*(?:>|\Z)", re.DOTALL)
_NAMED = re.compile(r"""(?:\b(class|id|role))\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""",
                    re.IGNORECASE)
_NAME_PART = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_SENTENCE_END = re.compile(r"[.!?…:»\"”')\]]\Z")
_LEGAL = re.compile(r"©|\(c\)|copyright|rights reserved|cookie|privacy|subscribe|newsletter|"
                    r"sign up|log in|advert|sponsor", re.IGNORECASE)


@dataclass
class Block:
    text: str
    features: list[str]


def _flags(tag: str, attrs: str, known: dict) -> tuple[str, ...]:
    key = (tag, attrs)
    have = known.get(key)
    if have is None:
        names = [f"<{tag}>"]
        for m in _NAMED.finditer(attrs):
            value = (m.group(2) or m.group(3) or m.group(4) or "").lower()
            names += [f".{w}" for w in _NAME_PART.findall(value)]
        have = tuple(dict.fromkeys(names))
        if len(known) < 20_000:
            known[key] = have
    return have


class _OpenTags:
    """The open elements around a place of a page. What a block needs to know
    of all of them is kept with the innermost one, and the places of every
    name are listed, so no step walks the stack (but to pop it)."""

    def __init__(self, keep):
        self.keep = keep
        self.names: list[str] = []
        self.places: dict[str, list[int]] = {}
        # Per element: distinct flags from the outermost on, the last two
        # flags, and the nearest name that is not an inline one.
        self.known: list[tuple[tuple, tuple, str]] = [((), (), "")]

    def push(self, name: str, flags: tuple[str, ...]) -> None:
        seen, last, above = self.known[-1]
        new = [f for f in flags if f not in seen and (self.keep is None or f in self.keep)]
        self.known.append((seen + tuple(new) if new else seen, (last + flags)[-2:],
                           above if name in INLINE else name))
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)

    def innermost(self, names) -> int:
        return max((own[-1] for own in map(self.places.get, names) if own), default=-1)

    def close(self, place: int) -> None:
        """Closes the element at this place and all inside it."""
        while len(self.names) > place:
            self.places[self.names.pop()].pop()
            self.known.pop()


def leaf_blocks(page: str | None, known: dict | None = None, keep=None) -> list[Block]:
    """Leaf blocks of a page, in page order, with their features. ``keep``:
    the ancestors' features of interest (all, if not given), which bounds the
    work on pages of very deep nesting."""
    if not page:
        return []
    known = {} if known is None else known
    stack = _OpenTags(keep)
    blocks: list[tuple] = []      # text, link share, ancestors' flags, last two, tag
    parts: list[str] = []
    linked = 0
    at, skip_to = 0, -1

    def flush() -> None:
        nonlocal linked
        if parts:
            text = _SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                blocks.append((text, min(1.0, linked / max(1, sum(map(len, parts)))),
                               *stack.known[-1]))
        parts.clear()
        linked = 0

    def text(piece: str) -> None:
        nonlocal linked
        if piece:
            parts.append(piece)
            if stack.places.get("a"):
                linked += len(piece)

    for m in _TAG.finditer(page):
        if m.start() < skip_to:
            continue
        text(page[max(at, skip_to):m.start()])
        at = m.end()
        name = (m.group(2) or "").lower()
        if not name:
            continue
        if name not in INLINE:
            flush()
        if m.group(1):
            if stack.places.get(name):
                stack.close(stack.places[name][-1])
            continue
        if name in NOT_TEXT:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.IGNORECASE).search(page, at)
            at = skip_to = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        if name in ENDS_PARAGRAPH:
            _close(stack, {"p"}, _PARAGRAPH_BORDERS)
        if name in CLOSES:
            _close(stack, *CLOSES[name])
        if not m.group(3).endswith("/") or name in INLINE or name in ENDS_PARAGRAPH:
            stack.push(name, _flags(name, m.group(3), known))
    rest = page[max(at, skip_to):]
    if rest:
        # A tag that the page's end cuts off is markup; other text is text.
        cut = _TAG_START.search(rest, rest.rfind(">") + 1)
        text(rest[:cut.start()] if cut else rest)
    flush()
    return [_described(b, i, len(blocks)) for i, b in enumerate(blocks)]


def _close(stack: _OpenTags, which: set, borders: set) -> None:
    place = stack.innermost(which)
    if place >= 0 and place > stack.innermost(borders):
        stack.close(place)


def _described(block: tuple, i: int, n: int) -> Block:
    text, links, above, last, tag = block
    words = text.count(" ") + 1
    features = list(above)
    features += ["|".join(last), f"own{tag}", f"words{min(8, words.bit_length())}",
                 f"links{int(links * 4)}", "bias"]
    if _SENTENCE_END.search(text):
        features.append("ends")
        if words > 6:
            features.append("sentence")
    if len(text) < 200 and _LEGAL.search(text):
        features.append("legal")
    if i == 0:
        features.append("first")
    if i == n - 1:
        features.append("last")
    return Block(text, features)


# -------------------------------------------------------------------- CRF

@dataclass
class ChainModel:
    """Weights of the two labels (0 boilerplate, 1 main text)."""
    weights: dict[str, tuple[float, float]]
    pairs: np.ndarray           # [from label, to label]

    def scores(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), 2))
        get, none = self.weights.get, (0.0, 0.0)
        for i, b in enumerate(blocks):
            w = [get(f, none) for f in b.features]
            out[i] = sum(x for x, _ in w), sum(y for _, y in w)
        return out

    def labels(self, blocks: list[Block]) -> list[int]:
        """Viterbi."""
        if not blocks:
            return []
        s = self.scores(blocks).tolist()
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b = s[0]
        back = []
        for x, y in s[1:]:
            back.append((a + p00 < b + p10, a + p01 < b + p11))
            a, b = max(a + p00, b + p10) + x, max(a + p01, b + p11) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[Block], list[int]]], epochs: int = 10, rate: float = 0.3,
          decay: float = 1e-4, seed: int = 5) -> ChainModel:
    """Conditional likelihood by stochastic gradient steps of adaptive size
    with a little decay; expectations come from forward-backward."""
    names = {f: k for k, f in enumerate(sorted({f for bs, _ in pages for b in bs
                                                for f in b.features}))}
    weights, pairs = np.zeros((len(names), 2)), np.zeros((2, 2))
    seen, seen_pairs = np.full((len(names), 2), 1e-2), np.full((2, 2), 1e-2)
    coded = [([np.array([names[f] for f in b.features]) for b in bs], np.array(ys))
             for bs, ys in pages if bs]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(coded)).tolist():
            feats, ys = coded[k]
            n = len(feats)
            emit = np.array([weights[f].sum(axis=0) for f in feats])
            fwd, bwd = np.zeros((n, 2)), np.zeros((n, 2))
            fwd[0] = emit[0]
            for i in range(1, n):
                fwd[i] = emit[i] + np.logaddexp(fwd[i - 1, 0] + pairs[0], fwd[i - 1, 1] + pairs[1])
            for i in range(n - 2, -1, -1):
                after = emit[i + 1] + bwd[i + 1]
                bwd[i] = np.logaddexp(pairs[:, 0] + after[0], pairs[:, 1] + after[1])
            total = np.logaddexp(*fwd[-1])
            single = np.exp(fwd + bwd - total)
            single[np.arange(n), ys] -= 1
            grad = np.zeros_like(pairs)
            for i in range(1, n):
                grad += np.exp(fwd[i - 1][:, None] + pairs + (emit[i] + bwd[i])[None, :] - total)
                grad[ys[i - 1], ys[i]] -= 1
            for i, f in enumerate(feats):
                step = single[i] + decay * weights[f]
                seen[f] += step ** 2
                weights[f] -= rate * step / np.sqrt(seen[f])
            grad += decay * pairs
            seen_pairs += grad ** 2
            pairs -= rate * grad / np.sqrt(seen_pairs)
    return ChainModel({f: (float(weights[k, 0]), float(weights[k, 1]))
                       for f, k in names.items()}, pairs)


# ---------------------------------------------------------- labelled pages

_MAIN = ("article", "article", "article class=post", "main", "section itemprop=articleBody", "div class=article-body",
         "div class=post-content", "div class=entry", "div id=content", "div class=story",
         "div class=x1", "div role=main")
_ASIDE = (("nav", "links"), ("div class=menu", "links"), ("ul class=navbar", "links"),
          ("header", "banner"), ("div class=header", "banner"), ("div id=masthead", "banner"),
          ("div class=ad", "line"), ("div class=advert banner", "line"),
          ("div class=sponsored", "line"), ("aside", "mixed"), ("div class=sidebar", "mixed"),
          ("div class=widget", "mixed"), ("div class=cookie-notice", "notice"),
          ("div class=notice", "notice"), ("div role=alert", "notice"),
          ("div class=popup consent", "notice"), ("form", "form"), ("div class=newsletter", "form"),
          ("div class=search", "form"), ("div class=related", "links"),
          ("div class=share social", "links"), ("div class=breadcrumb", "links"),
          ("div class=promo", "line"), ("div class=tags", "links"))
_AFTER = (("footer", "legal"), ("div class=footer", "legal"), ("div id=comments", "comments"),
          ("section class=comments", "comments"), ("div class=disqus-thread", "comments"),
          ("div class=copyright", "legal"), ("div class=pagination", "links"))


def labelled_pages(n: int = 600, seed: int = 17) -> list[tuple[str, list[str]]]:
    """Made-up pages ``(html, main blocks)``."""
    rnd = random.Random(seed)
    syllables = [a + b for a in "b c d f g l m n p r s t v th st ch".split()
                 for b in "a e i o u an er in on é ü".split()]

    def word() -> str:
        return "".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4)))

    def line(low: int, high: int, end: str = ".") -> str:
        return (" ".join(word() for _ in range(rnd.randint(low, high)))).capitalize() + end

    def open_(tag: str) -> tuple[str, str]:
        name, _, attrs = tag.partition(" ")
        key, _, value = attrs.partition("=")
        return (f'<{name} {key}="{value}">' if attrs else f"<{name}>"), f"</{name}>"

    def links(k: int) -> str:
        own = "".join(f'<li><a href="/{word()}">{line(1, 3, "")}</a></li>' for _ in range(k))
        return f"<ul>{own}</ul>" if rnd.random() < 0.7 else " | ".join(
            f'<a href="#">{line(1, 2, "")}</a>' for _ in range(k))

    def filler(kind: str) -> str:
        if kind == "links":
            return links(rnd.randint(2, 8))
        if kind == "banner":
            return rnd.choice([f"<h1>{line(1, 4, '')}</h1>", f"<p>{line(2, 8, '')}</p>", ""]) \
                + rnd.choice([links(4), f"<span>{line(1, 4, '')}</span>"])
        if kind == "line":
            return rnd.choice(["{}", "<p>{}</p>", "<a href='#'>{}</a>"]).format(line(3, 14))
        if kind == "notice":
            return f"<p>{rnd.choice(['We use cookies. ', '', 'Notice: '])}{line(4, 20)}</p>" \
                + rnd.choice(["<button>OK</button>", ""])
        if kind == "form":
            return (f"<label>{line(1, 3, '')}</label><input type=text>"
                    f"<button>{word()}</button><p>{line(3, 10)}</p>")
        if kind == "legal":
            return rnd.choice(["&copy; 2020 {}", "Copyright {} All rights reserved.",
                               "&copy; {} &middot; " + line(3, 12)]).format(line(1, 4, ""))
        if kind == "comments":
            return "".join(f"<div class='comment'><b>{word()}</b><p>{line(3, 30)}</p></div>"
                           for _ in range(rnd.randint(1, 5)))
        return f"<h3>{line(1, 4, '')}</h3><p>{line(4, 20)}</p>" + rnd.choice([links(3), ""])

    def article() -> tuple[str, list[str]]:
        out, kept = [], []

        def put(tag: str, text: str) -> None:
            kept.append(text)
            a, b = open_(tag)
            end = b if rnd.random() < 0.9 or tag != "p" else ""
            out.append(a + text + end)

        if rnd.random() < 0.7:
            put("h1", line(2, 9, rnd.choice(["", "."])))
        for _ in range(rnd.choice([1, 1, 2, 3, 4, 6, 9])):
            kind = rnd.random()
            if kind < 0.7:
                put("p", " ".join(line(2, 25) for _ in range(rnd.randint(1, 5))))
            elif kind < 0.78:
                put(rnd.choice(["h2", "h3"]), line(1, 6, ""))
            elif kind < 0.84:
                put("blockquote", line(4, 25))
            elif kind < 0.9:
                items = [line(1, 12, rnd.choice([".", ""])) for _ in range(rnd.randint(1, 4))]
                kept.extend(items)
                out.append("<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>")
            elif kind < 0.93:
                put("p", line(1, 3))
            elif kind < 0.96:       # an article may speak of such things
                put("p", rnd.choice(["All rights reserved.", "Copyright " + line(1, 3),
                                     line(2, 6, " cookie.") + " Log in.", "Subscribe."]))
            else:
                a, b = open_(rnd.choice(_ASIDE)[0])
                out.append(a + filler(rnd.choice(["line", "links", "mixed", "form"])) + b)
        return "".join(out), kept

    pages = []
    for _ in range(n):
        head = f"<html><head><title>{line(2, 6, '')}</title></head><body>"
        before = [rnd.choice(_ASIDE) for _ in range(rnd.randint(0, 5))]
        after = [rnd.choice(_ASIDE + _AFTER * 3) for _ in range(rnd.randint(0, 4))]

        def around(chosen) -> str:
            return "".join(open_(t)[0] + filler(k) + open_(t)[1] for t, k in chosen)

        body, kept = article()
        a, b = open_(rnd.choice(_MAIN))
        wrap = rnd.choice([("", ""), ("<div class='wrap'>", "</div>"), ("<div>", "</div>")])
        pages.append((head + wrap[0] + around(before) + a + body + b + around(after) + wrap[1]
                      + "</body></html>", kept))
    return pages


def default_model(n: int = 600, seed: int = 17) -> ChainModel:
    """The CRF trained on the made-up pages."""
    data = []
    for page, kept in labelled_pages(n, seed):
        blocks = leaf_blocks(page)
        left = [_SPACE.sub(" ", k).strip() for k in kept]
        labels = []
        for b in blocks:        # kept blocks come in page order
            here = bool(left) and b.text == left[0]
            labels.append(int(here))
            if here:
                left.pop(0)
        data.append((blocks, labels))
    return train(data)


def main_text(page: str | None, model: ChainModel, known: dict | None = None) -> str:
    blocks = leaf_blocks(page, known, model.weights)
    return " ".join(b.text for b, y in zip(blocks, model.labels(blocks)) if y)


def extract(pages: DataFrame, model: ChainModel | None = None, id_col: str = "page_id",
            url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``id_col, url, text``."""
    spark = pages.sparkSession
    share_code(spark)
    shared = spark.sparkContext.broadcast(model or default_model())
    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                          F.col(html_col).alias("html"))

    def run(batches):
        known: dict = {}
        for batch in batches:
            for part in text_slices(batch, "html"):
                own = [main_text(x, shared.value, known)
                       for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("url"), pa.array(own, pa.string())],
                    ["id", "url", "text"])

    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"id {kind}, url string, text string") \
        .withColumnRenamed("id", id_col)
