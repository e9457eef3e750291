"""Main text of web pages by a maximum-scoring subsequence (operator 1).

A page is a sequence of words and tags. Words score by the container that they
stand in, tags score below zero, both with weights that are log odds counted on
labelled pages; one linear scan finds the contiguous stretch with the highest
sum, and its blocks are the text.

Labelled pages are those that mark their content themselves, with one
``<article>`` or ``<main>``: words and tags inside are content, others are not.
Weights come from ``LABELLED_PAGES`` of them at most, chosen by a hash of the
page. Subtrees that are never content (navigation, forms, scripts, adverts,
comments ..., by element, role, or class) leave a negative mark and are not
scored, so that an advert within an article does not split it.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsift.llm.common import small_batches

#: Labelled pages that the weights are counted on.
LABELLED_PAGES = 2000
#: Bound of a weight, and the weight of a tag that content is full of.
MOST, TAG = 3.0, -0.05
#: Weight of words in a container that no labelled page has.
UNKNOWN = 1.0
#: What a left-out subtree costs.
GAP = -0.1

# Elements of HTML by their part in a page.
DROPPED = set(
    "nav footer aside form script style noscript template iframe object embed svg canvas audio video map menu "
    "button input select textarea label fieldset legend datalist dialog head title".split()
)
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = {"article", "main"}
ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar toolbar".split())
#: Words in class and id that mark what is not content.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promos "
    "promotion sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer masthead topbar "
    "comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices "
    "notification notifications alert alerts popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations trending widget widgets toolbar pagination pager "
    "copyright disclaimer form forms search".split()
)
#: Marks that are content's own within an article.
OWN = {"header", "hgroup"}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe|noembed|noframes|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<odd>/?)(?P<name>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _names(attrs: str) -> tuple[frozenset, bool]:
    """Words of class and id; whether the attributes hide the element or give
    it a role that is not content's."""
    if not attrs or attrs.isspace():
        return frozenset(), False
    names, off = set(), False
    for m in ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id"):
            names.update(w.lower() for w in WORD.findall(value))
        elif key == "role":
            off |= not ROLES.isdisjoint(value.lower().split())
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            off = True
        elif key == "style":
            off |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
    return frozenset(names), off


def tokens(page: str):
    """(kind, value, container) of a page: text nodes, and tags by name with /
    for closing ones; ``gap`` stands for a subtree that is left out. The
    container is the nearest element with a part in the page's structure."""
    stack: list[tuple[str, str, bool]] = []  # element, container, inside content
    dropped: str | None = None  # the open element that is being left out
    depth = at = 0
    for m in TOKEN.finditer(page):
        text, at = page[at : m.start()], m.end()
        if text and dropped is None:
            yield "text", text, stack[-1][1] if stack else "body"
        if m["raw"]:
            continue
        tag = m["tag"] or m["name"]
        if not tag:
            continue
        tag, closing, attrs = tag.lower(), bool(m["close"] or m["odd"]), m["attrs"] or ""
        if dropped is not None:
            # Left out to its end, or to the end of what it stands in.
            if closing and tag == dropped:
                depth -= 1
                dropped = None if depth == 0 else dropped
                continue
            if tag == dropped and not attrs.rstrip().endswith("/"):
                depth += 1
                continue
            ends = closing and (tag in ("body", "html") or tag in CONTENT and any(e[0] == tag for e in stack))
            ends |= dropped == "head" and tag == "body" or dropped == "p" and not closing and tag in BLOCKS
            if not ends:
                continue
            dropped = None
        if closing:
            if any(e[0] == tag for e in stack):
                while stack.pop()[0] != tag:
                    pass
            yield "tag", "/" + tag, stack[-1][1] if stack else "body"
            continue
        if tag in BLOCKS and stack and stack[-1][0] == "p":
            stack.pop()
        container, inside = (stack[-1][1], stack[-1][2]) if stack else ("body", False)
        names, off = _names(attrs)
        void = tag in VOID or attrs.rstrip().endswith("/")
        unwanted = tag in DROPPED or off or not names.isdisjoint(MARKS) and tag not in CONTENT | {"body", "html"}
        unwanted |= tag in CONTENT and not names.isdisjoint({"comment", "comments"})
        unwanted |= not inside and (tag == "header" or not names.isdisjoint(OWN))
        if unwanted:
            yield "gap", tag, container
            if not void:
                dropped, depth = tag, 1
            continue
        if tag in CONTENT:
            container, inside = tag, True
        elif not inside and tag in BLOCKS and names:
            container = f"{tag} {' '.join(sorted(names))}"
        yield "tag", tag, container
        if not void:
            stack.append((tag, container, inside))
    if at < len(page) and dropped is None:
        yield "text", page[at:], stack[-1][1] if stack else "body"


def count_odds(page: str) -> Counter:
    """Of a labelled page: words by container and tags by name, inside content
    and outside."""
    found: Counter = Counter()
    inside = 0
    for kind, value, container in tokens(page):
        if kind == "tag" and value.lstrip("/") in CONTENT:
            inside += -1 if value[0] == "/" else 1
        elif kind == "text":
            found["word", container, inside > 0] += len(value.split())
        else:
            found["tag", value, inside > 0] += 1
    return found


def weights(pages: DataFrame) -> dict:
    """Log odds by (kind, name) from the labelled pages of ``pages``."""
    marked = F.regexp_count("html", F.lit(r"(?i)<(article|main)[\s>]")) == 1
    labelled = pages.where(marked).select("html", F.xxhash64("page_id", "html").alias("h"))
    # Only hashes are sorted; pages move once the highest wanted hash is known.
    highest = labelled.select("h").orderBy("h").limit(LABELLED_PAGES).agg(F.max("h")).first()[0]
    wanted = F.col("h") <= F.lit(highest).cast("long")
    sample = labelled.where(wanted).groupBy("h").agg(F.first("html").alias("html"))

    def run(batches):
        for b in batches:
            found: Counter = Counter()
            for page in b.column("html").to_pylist():
                found.update(count_odds(page))
            rows = [(k, n, c if i else 0, 0 if i else c) for (k, n, i), c in found.items()]
            cols = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            arrays = [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["kind", "name", "inside", "outside"])

    counts = sample.select("html").mapInArrow(run, "kind string, name string, inside long, outside long")
    # As many rows as the sampled pages have different tags and containers.
    rows = counts.groupBy("kind", "name").agg(F.sum("inside"), F.sum("outside")).collect()
    odds = {(k, n): max(-MOST, min(MOST, math.log((i + 1) / (o + 1)))) for k, n, i, o in rows}
    return {key: v if key[0] == "word" else TAG + min(0.0, v) for key, v in odds.items()}


def extract(page: str | None, odds: dict) -> str:
    """The main text: blocks of the best stretch, joined by line ends."""
    if not page:
        return ""
    found = list(tokens(page))
    # Where a page marks its content, what stands outside of it is none.
    marked = any(kind == "text" and container in CONTENT and value.strip() for kind, value, container in found)
    best = score = 0.0
    begin, span = 0, (0, 0)
    for k, (kind, value, container) in enumerate(found):
        if kind == "text":
            n = len(value.split())
            if marked:
                score += n * (odds.get(("word", container), UNKNOWN) if container in CONTENT else -MOST)
            else:
                score += n * odds.get(("word", container), UNKNOWN)
        else:
            score += odds.get(("tag", value), TAG) if kind == "tag" else GAP
        if score <= 0:
            score, begin = 0.0, k + 1
        elif score > best:
            best, span = score, (begin, k + 1)
    blocks, held = [], []
    for kind, value, _ in found[slice(*span)]:
        if kind == "text":
            held.append(entities.unescape(value))
        elif value == "br":
            held.append(" ")
        elif value.lstrip("/") in BLOCKS:
            blocks.append("".join(held))
            held = []
    blocks.append("".join(held))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``.

    A null or empty html, or one without a stretch that scores above zero, has
    an empty text. Repeated rows come out repeated; other columns are ignored;
    an empty table gives an empty result. The whole html is read.
    """
    small_batches(pages.sparkSession)
    odds = weights(pages)

    def run(batches):
        for b in batches:
            texts = [extract(p, odds) for p in b.column("html").to_pylist()]
            arrays = [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
