"""Main text of web pages: flat blocks, told apart by a decision tree.

A page is read once, tag by tag, into blocks of text in page order. A block is described
by its words and the share of them inside links, the same of the blocks before and after
it, and by where it stands: inside a container that is named as boilerplate, inside an
article, in a heading. A decision tree, trained on the small labelled table of
``html_examples``, keeps or drops it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetgauge.llm.html_examples import PAGES

# Elements of the markup language by what they are for.
# Only the first run to their end tag or the end of the page, whatever is inside; the next hide what is before their end tag.
RAW = "script style textarea title".split()
HIDES = "noscript template iframe svg select button object canvas audio video".split()
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr "
    "math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle "
    "msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BOILERPLATE = "nav header footer aside form menu dialog".split()
ARTICLE = "article main".split()
HEADINGS = "h1 h2 h3 h4 h5 h6".split()
# Words of class, id and role that name boilerplate, alone or beside layout words.
NAMED = (
    "ad ads adbox adslot adsense advert adverts advertisement advertising advertorial sponsor sponsored promo promotion "
    "cookie cookies consent gdpr popup modal sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead topbar "
    "comment comments commentlist disqus respond replies related recommended share sharing social newsletter subscribe "
    "subscription signup login pagination pager copyright contentinfo complementary"
).split()
# Those that name it alone, on an element that holds others, or beside a word for the whole page.
NAMED_ALONE = "banner notice notification alert overlay dialog aside header footer toolbar search form widget legal disclaimer skip".split()
OF_PAGE = "site page main global top bottom".split()
LAYOUT = (
    "left right primary secondary sticky fixed box block blocks wrapper wrap container inner outer area section list item items "
    "link links button buttons bar icon icons text title content unit slot label post posts article articles entry entries "
    "thread count group panel body desktop mobile js"
).split()
READERS = "comment comments commentlist disqus respond replies".split()
HOLDERS = "article center div main ol section table td th tr ul".split()

_HIDES, _INLINE, _VOID = frozenset(HIDES), frozenset(INLINE), frozenset(VOID)
_BOILERPLATE, _ARTICLE, _HEADINGS = frozenset(BOILERPLATE), frozenset(ARTICLE), frozenset(HEADINGS)
_NAMED, _NAMED_ALONE, _OF_PAGE, _READERS = map(frozenset, (NAMED, NAMED_ALONE, OF_PAGE, READERS))
_BESIDE, _HOLDERS = frozenset([*NAMED, *NAMED_ALONE, *OF_PAGE, *LAYOUT]), frozenset(HOLDERS)
# Elements that are open side by side, never one in the other.
_SIBLINGS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<title\s*+/>"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*+>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE)
_WORDS = re.compile(r"[^\W_]+|[^\w\s]+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    boilerplate: bool
    article: bool
    heading: bool


@lru_cache(maxsize=1 << 14)
def _names_boilerplate(name: str, holds: bool) -> bool:
    """Whether one class, id or role says boilerplate, as a whole: ``ad-slot`` does, ``social-science`` does not."""
    parts = [p.rstrip("0123456789") for p in re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())]
    parts = [p for p in parts if p and not re.fullmatch(r"\d+x", p)]
    if not parts or not _BESIDE.issuperset(parts):
        return False
    if _NAMED.intersection(parts):
        return True
    return holds and bool(_NAMED_ALONE.intersection(parts)) and (len(parts) == 1 or bool(_OF_PAGE.intersection(parts)))


def _is_named(tag: str, rest: str) -> tuple[bool, bool]:
    """Whether an element is hidden or its names say boilerplate, and whether they say readers' comments.

    Headings get names from their words, so theirs say nothing.
    """
    if "=" not in rest and "hidden" not in rest:
        return False, False
    if _HIDDEN.search(rest):
        return True, False
    if tag in _HEADINGS:
        return False, False
    for found in _NAMES.finditer(rest):
        for name in (found[1] or found[2] or found[3] or "").split():
            if len(name) < 64 and _names_boilerplate(name, tag in _HOLDERS):
                words = re.split(r"[_-]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower())
                return True, bool(_READERS.intersection(words))
    return False, False


def _hidden_to(tokens: Sequence[re.Match]) -> dict[int, int]:
    """The end tag of each element that hides its content; one without end tag hides nothing."""
    out, open_ = {}, {}
    for k, token in enumerate(tokens):
        tag = token["tag"] or token["tag2"]
        tag = tag and tag.lower()
        if tag not in _HIDES:
            continue
        if token["close"] or token["close2"]:
            if open_.get(tag):
                out[open_[tag].pop()] = k
        elif tag != "svg" or not (token["rest"] or token["rest2"] or token[0][:-1]).endswith("/"):
            open_.setdefault(tag, []).append(k)
    return out


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order; scripts, styles, comments and markup are left out."""
    out: list[Block] = []
    # Open elements: tag, boilerplate, readers' comments, article, heading.
    stack: list[tuple[str, bool, bool, bool, bool]] = [("", False, False, False, False)]
    # How many of each are open: an end tag without one looks for none.
    is_open: Counter[str] = Counter()
    pieces: list[str] = []
    links: list[str] = []
    linked = False

    def end_block() -> None:
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                _, boilerplate, _, article, heading = stack[-1]
                inside = len(unescape(" ".join(links)).split()) if links else 0
                out.append(Block(text, text.count(" ") + 1, inside, boilerplate, article, heading))
            pieces.clear()
            links.clear()

    at = 0
    tokens = list(_TOKEN.finditer(page))
    ends, skipped = _hidden_to(tokens), -1
    for k, token in enumerate(tokens):
        if k <= skipped:
            continue
        if token.start() > at:
            pieces.append(page[at : token.start()])
            if linked:
                links.append(pieces[-1])
        at = token.end()
        tag = token["tag"] or token["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        closing = bool(token["close"] or token["close2"])
        if k in ends:
            skipped = ends[k]
            at = tokens[skipped].end()
            continue
        if tag == "svg":
            continue
        if tag in _INLINE:
            if tag == "a":
                linked = not closing
            continue
        if tag == "br":
            pieces.append("\n")
            continue
        end_block()
        linked = False
        if tag in _VOID:
            continue
        if closing:
            while is_open[tag]:
                last = stack.pop()[0]
                is_open[last] -= 1
                if last == tag:
                    break
            continue
        if tag in _SIBLINGS and stack[-1][0] in _SIBLINGS[tag]:
            is_open[stack.pop()[0]] -= 1
        _, boilerplate, readers, article, heading = stack[-1]
        named, by_readers = (False, False) if tag in ("html", "head", "body") else _is_named(tag, token["rest"] or token["rest2"] or "")
        if tag in _ARTICLE and not named and not readers:
            # What wraps a whole article, such as a form, does not make it boilerplate.
            boilerplate, article = False, True
        heading = tag in _HEADINGS
        # A header inside an article may hold its title, which is a heading.
        boxed = tag in _BOILERPLATE and not (tag == "header" and article)
        is_open[tag] += 1
        stack.append((tag, boilerplate or boxed or named, readers or by_readers, article, heading))
    if at < len(page):
        pieces.append(page[at:])
    end_block()
    return out


def describe(page: Sequence[Block]) -> np.ndarray:
    """Features of each block: words and link density of it, of the one before and of the next; where it stands."""
    out = np.zeros((len(page), 9))
    if not len(page):
        return out
    own = np.array([(b.words, min(b.linked / b.words, 1.0)) for b in page])
    out[:, 0:2] = own
    out[1:, 2:4] = own[:-1]
    out[:-1, 4:6] = own[1:]
    out[:, 6:9] = [(b.boilerplate, b.article, b.heading) for b in page]
    return out


class DecisionTree:
    """Binary splits of one feature each, chosen by the Gini impurity they leave."""

    def __init__(self, depth: int = 6, least: int = 2):
        self.depth, self.least = depth, least
        self.nodes: list[tuple[int, float, int, int, int]] = []  # feature, bound, below, above, label

    def fit(self, x: np.ndarray, y: np.ndarray) -> DecisionTree:
        self._grow(x, y, 0)
        return self

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        here = len(self.nodes)
        self.nodes.append((-1, 0.0, -1, -1, int(2 * y.sum() >= len(y))))
        split = self._best(x, y) if depth < self.depth and 0 < y.sum() < len(y) else None
        if split is not None:
            feature, bound = split
            low = x[:, feature] <= bound
            below = self._grow(x[low], y[low], depth + 1)
            above = self._grow(x[~low], y[~low], depth + 1)
            leaves = [self.nodes[side] for side in (below, above)]
            if all(leaf[0] < 0 for leaf in leaves) and leaves[0][4] == leaves[1][4]:
                # Leaves that agree tell nothing apart.
                del self.nodes[here + 1 :]
            else:
                self.nodes[here] = (feature, bound, below, above, self.nodes[here][4])
        return here

    def _best(self, x: np.ndarray, y: np.ndarray) -> tuple[int, float] | None:
        best = None
        for feature in range(x.shape[1]):
            values = np.unique(x[:, feature])
            for bound in (values[1:] + values[:-1]) / 2:
                low = x[:, feature] <= bound
                sides = [y[low], y[~low]]
                if min(map(len, sides)) < self.least:
                    continue
                left = sum(len(s) * s.mean() * (1 - s.mean()) for s in sides)
                if best is None or left < best[0] - 1e-12:
                    best = left, feature, float(bound)
        return best and best[1:]

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        table = np.array([n[:4] for n in self.nodes])
        for _ in range(self.depth):
            feature = table[at, 0].astype(np.int64)
            value = x[np.arange(len(x)), np.maximum(feature, 0)]
            step = np.where(value <= table[at, 1], table[at, 2], table[at, 3]).astype(np.int64)
            at = np.where(feature >= 0, step, at)
        return np.array([n[4] for n in self.nodes])[at]


def labelled_blocks() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the example pages."""
    features, labels = [], []
    for page in PAGES:
        html = "".join(re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), piece) for _, piece in page)
        known = [label for label, _ in page if label is not None]
        found = blocks(f"<html><body>{html}</body></html>")
        if len(found) != len(known):
            raise ValueError("an example has not one block for each label")
        features.append(describe(found))
        labels += known
    return np.concatenate(features), np.array(labels)


@lru_cache(maxsize=1)
def trained() -> DecisionTree:
    return DecisionTree().fit(*labelled_blocks())


def main_texts(pages: Sequence[str]) -> list[str]:
    """The kept blocks of each page, joined by line breaks."""
    cut = [blocks(page) for page in pages]
    kept = trained().predict(np.concatenate([describe(page) for page in cut] or [np.zeros((0, 9))]))
    keep = iter(kept.tolist())
    return ["\n".join([b.text for b in page if next(keep)]) for page in cut]


def _extracted(names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                texts = main_texts([page or "" for page in part.column(2).to_pylist()])
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), sizes], names=names)

    return run


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key``, ``url``, ``text`` and ``n_chars`` of every row's whole page.

    Character references are decoded, white space inside a block is one blank, blocks
    follow each other in page order, one line each. A null page is empty; a page without
    article text has an empty text. One row for each row, repeated ones included; null
    keys and addresses stay null, and other columns are not read.
    """
    schema = T.StructType(
        [
            T.StructField("key", pages.schema[key].dataType),
            T.StructField("url", pages.schema[url].dataType),
            *T.StructType.fromDDL("text string, n_chars long").fields,
        ]
    )
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    rows = rows.mapInArrow(_extracted(schema.names), schema)
    return rows.select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
