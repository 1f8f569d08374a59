"""Main text of web pages by gradient-boosted trees over DOM nodes, decoded from the top down.

Every element that shapes a page (inline ones belong to their parent) becomes a row of features: its subtree's text, link and
element counts and their ratios, its own and its ancestors' attribute tokens and names, depth, place among its siblings and
what those are like. Boosted trees give each the chance of being main text. The decoding then chooses, for every subtree at
once, whether it is all main text, all something else, or mixed, in which case its children are decided in the same way;
the choice with the largest joint likelihood counts, so no element is main text inside one that is not.

The trees learn on the driver from a fixed number of made pages (`pages_made`), so nothing is gathered from the corpus; the
model is a few kilobytes. Extraction is one pass, page by page, without a shuffle.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.llm import ragged as R
from turnweave.llm.boosting import Trees, fit
from turnweave.llm.dom import Page, parse
from turnweave.llm.pages_made import made
from turnweave.llm.toxicity import _sigmoid

MADE_PAGES = 600
TREES, DEPTH = 50, 4
MIXED = float(np.log(0.5))  # of an element that holds both; the document, html and body mostly do, at no cost
TEXT_BYTES = 1 << 20

# Element names and attribute tokens by group.
_TAG_GROUPS = {
    "p": "p", "heading": "h1 h2 h3 h4 h5 h6 hgroup", "div": "div center", "section": "section", "article": "article", "main": "main", "nav": "nav menu", "header": "header", "footer": "footer",
    "aside": "aside", "list": "ul ol dl", "item": "li dt dd", "table": "table tbody thead tfoot tr td th caption", "form": "form fieldset button select option optgroup legend datalist dialog", "figure": "figure figcaption", "quote": "blockquote pre address details summary", "body": "html body",
}
_TOKEN_GROUPS = {
    "main": "article content main post entry body story text page blog news prose",
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs toc topnav pagination pager tabs",
    "header": "header masthead banner logo branding top topbar",
    "footer": "footer colophon copyright bottom legal imprint",
    "side": "sidebar side aside widget related recommended rail secondary read complementary",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsbox dfp taboola outbrain slot",
    "notice": "notice cookie cookies consent gdpr alert popup modal newsletter paywall overlay toast banner",
    "comments": "comment comments disqus responses reply replies discussion respond reader",
    "form": "form search login signup subscribe contact register",
    "share": "share social sharing follow buttons",
    "hidden": "hidden none invisible",
}
_TAG = {name: k for k, names in enumerate(_TAG_GROUPS.values()) for name in names.split()}
_OTHER = len(_TAG_GROUPS)
_GROUPS = list(_TOKEN_GROUPS)
_TOKENS: dict[str, list[int]] = {}
for _k, _names in enumerate(_TOKEN_GROUPS.values()):
    for _name in _names.split():
        _TOKENS.setdefault(_name, []).append(_k)
_ABOVE = [list(_TAG_GROUPS).index(x) for x in ("article", "main", "nav", "header", "footer", "aside", "form")]
_ATTR = re.compile(r"(?i)\b(?:class|id|role|aria-label|style|hidden|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PUNCT = frozenset(".,;:!?")


@functools.lru_cache(10_000)
def _tokens(attrs: str) -> tuple[float, ...]:
    """How many of an element's attribute tokens are of each group."""
    out = [0.0] * len(_GROUPS)
    for m in _ATTR.finditer(attrs):
        value = next((x for x in m.groups() if x is not None), None)
        for word in _WORD.findall(value) if value is not None else ("hidden",):
            for k in _TOKENS.get(word.lower(), ()):
                out[k] += 1
    return tuple(out)


def features(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A row for each element of all pages, in order; and each element's parent and end as rows (-1 above a document)."""
    sizes = np.array([len(p.tag) for p in pages], np.int64)
    base = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    page = np.repeat(np.arange(len(pages)), sizes)
    flat = lambda name: np.array([x for p in pages for x in getattr(p, name)], np.int64)
    parent, end = flat("parent"), flat("end") + base[page]
    root = parent < 0
    parent = np.where(root, -1, parent + base[page])
    links, n_links = flat("links"), flat("n_links")
    group = np.array([_TAG.get(x, _OTHER) for p in pages for x in p.tag], np.int64)
    attr = np.array([_tokens(x) for p in pages for x in p.attrs], np.float32).reshape(n, len(_GROUPS))

    own = np.zeros((4, n))  # characters, words, punctuation marks, blocks
    owner = np.array([o + b for p, b in zip(pages, base.tolist(), strict=True) for o in p.owner], np.int64)
    blocks = [x for p in pages for x in p.block]
    if blocks:
        for k, values in enumerate(([len(x) for x in blocks], [x.count(" ") + 1 for x in blocks], [x.count(".") + x.count(",") + x.count(";") for x in blocks], [1] * len(blocks))):
            own[k] = np.bincount(owner, values, minlength=n)
    above = np.zeros((n, len(_GROUPS) + len(_ABOVE)), np.float32)
    mine = np.concatenate([attr > 0, group[:, None] == np.array(_ABOVE)], axis=1).astype(np.float32)
    depth = np.zeros(n, np.int64)
    for k, up in enumerate(parent.tolist()):  # parents come first
        if up >= 0:
            depth[k] = depth[up] + 1
    level = np.argsort(depth, kind="stable")
    cuts = np.searchsorted(depth[level], np.arange(1, int(depth.max(initial=0)) + 2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        at = level[a:b]
        above[at] = np.maximum(above[parent[at]], mine[parent[at]])

    def under(x: np.ndarray) -> np.ndarray:
        c = np.append(0, np.cumsum(x))
        return c[end] - c[:n]

    here = np.arange(n)
    chars, words, marks, parts = (under(x) for x in own)
    link_chars, link_count, count = under(links.astype(float)), under(n_links.astype(float)), (end - here).astype(float)
    whole = np.maximum(chars[base[page]], 1)
    up = np.where(root, here, parent)
    kids = np.bincount(up[~root], minlength=n)
    order = np.flatnonzero(~root)[np.argsort(up[~root], kind="stable")]
    place = np.zeros(n, np.int64)
    place[order] = np.arange(len(order)) - np.searchsorted(up[order], up[order])
    siblings = np.where(root, 1, kids[up])
    key = np.where(root, n + here, up) * (_OTHER + 1) + group
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    same = counts[inverse] / siblings
    beside = np.where(root, chars, np.bincount(up[~root], chars[~root], minlength=n)[up])
    before = np.append(0, np.cumsum(own[0]))[:n] - np.append(0, np.cumsum(own[0]))[base[page]]
    numbers = [
        np.log1p(chars), np.log1p(own[0]), np.log1p(words), marks / np.maximum(words, 1), chars / np.maximum(words, 1), link_chars / np.maximum(chars, 1), np.log1p(link_count),
        chars / np.maximum(count, 1), np.log1p(count), parts / count, chars / whole, before / whole, depth, place / siblings, np.log1p(place), np.log1p(siblings - place - 1), np.log1p(siblings), same,
        np.log1p((beside - chars) / np.maximum(siblings - 1, 1)), chars / np.maximum(beside, 1), chars[up] / whole, link_chars[up] / np.maximum(chars[up], 1), np.log1p(words / np.maximum(parts, 1)),
    ]
    one = np.eye(_OTHER + 1, dtype=np.float32)
    return np.concatenate([np.column_stack(numbers).astype(np.float32), one[group], attr, above, one[group[up]]], axis=1), parent, end


_TRUTH = re.compile(r'\s*data-truth="(.)"')


@functools.lru_cache(1)
def learned(n: int = MADE_PAGES) -> Trees:
    """Trees fitted on n made pages; elements that hold both kinds of text teach nothing."""
    pages = [parse(x) for x in made(n)]
    truth = []
    for p in pages:
        own: list[str] = []
        for k, attrs in enumerate(p.attrs):
            m = _TRUTH.search(attrs)
            own.append(m[1] if m else own[p.parent[k]] if k else "m")
            p.attrs[k] = _TRUTH.sub("", attrs)
        truth += own
    x, _, _ = features(pages)
    known = np.array([t != "m" for t in truth])
    y = np.array([t == "1" for t in truth], np.float64)
    return fit(x[known], y[known], TREES, DEPTH)


def decode(logit: np.ndarray, parent: np.ndarray, end: np.ndarray, frame: np.ndarray) -> np.ndarray:
    """Which elements are main text: the likeliest labels where a subtree is uniform or its top is mixed. A mixed element's own
    text goes by its own chance. `frame`: elements that are mixed unless they have no children."""
    yes, no = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    n = len(logit)
    sums = np.append(0, np.cumsum(yes)), np.append(0, np.cumsum(no))
    whole = (sums[0][end] - sums[0][:n]).tolist(), (sums[1][end] - sums[1][:n]).tolist()
    split = np.where(frame, 0, MIXED).tolist()
    framed = frame.tolist()
    pick = [0] * n
    up = parent.tolist()
    stops = end.tolist()
    for k in range(n - 1, -1, -1):
        best = max(whole[0][k], whole[1][k])
        if stops[k] == k + 1 or (best >= split[k] and not framed[k]):
            pick[k] = 1 if whole[0][k] >= whole[1][k] else 2
        else:
            best = split[k]
        if up[k] >= 0:
            split[up[k]] += best
    main = np.zeros(n, bool)
    k = 0
    while k < n:
        if pick[k]:
            main[k : stops[k]] = pick[k] == 1
            k = stops[k]
        else:
            main[k] = logit[k] > 0
            k += 1
    return main


def main_texts(sources: list[str | None], trees: Trees) -> list[list[str]]:
    """The main text blocks of each page, in page order."""
    pages = [parse(x or "") for x in sources]
    if not pages:
        return []
    x, parent, end = features(pages)
    frame = np.array([t in ("", "html", "body") for p in pages for t in p.tag])
    main = decode(trees.logits(x), parent, end, frame)
    out, base = [], 0
    for p in pages:
        out.append([text for o, text in zip(p.owner, p.block, strict=True) if main[base + o] or len(p.tag) == 1])
        base += len(p.tag)
    return out


def _extracted(trees: Trees) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in R.chunks(batches, "html", TEXT_BYTES):
            texts = ["\n\n".join(blocks) for blocks in main_texts(batch.column("html").to_pylist(), trees)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text (blocks joined by an empty line; empty if there is none) and n_chars.

    Null and empty pages have empty text; one without any element is plain text, all of it main.
    Broken markup never fails. Null ids and urls stay; repeated rows give equal texts; other columns are not carried.
    """
    kinds = dict(pages.dtypes)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extracted(learned()), f"page_id {kinds[id_col]}, url {kinds[url_col]}, text string, n_chars bigint")
