"""HTML extraction by the maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags.  A word scores positive, a tag negative, and the
contiguous run with the largest sum is the content region; one linear scan finds it.  The
weights are log-odds from labelled pages: those that mark their content with exactly one
``article`` or ``main`` element say for each kind of token how often it stands inside and
outside.  At most about ``SAMPLE_PAGES`` pages are used, chosen by a hash of the id.  Words
of scripts, styles and of containers that name themselves as menus, adverts, comments and
the like (``BOILERPLATE``) are no part of the text; such a container scores nothing, tags
and all, so the region runs over it.  A ``form`` or ``fieldset`` is such a container if it holds
fields and neither an article nor ``FORM_SHARE`` of the page's words: a page-wide form, or one
around the article, holds the text and is kept.

Text of the region: character references decoded, white space inside a block made one space,
blocks trimmed, empty ones left out, the rest joined by two line feeds in page order.

Cases: null or empty html gives an empty text; unclosed tags, comments and scripts run to the
end of what can close them; without any labelled page the weights are ``DEFAULT``.  Pages are
handled one by one, so ties, repeated rows and empty tables need no care.  Columns other than
``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlane.llm.common import small_batches

SAMPLE_PAGES, MAX_KINDS = 2000, 500
#: Scores without labelled pages; of words, of some tags, of other tags.
DEFAULT = {"word": 1.0, "p": -0.1, "/p": -0.1, "br": -0.1, "h1": -0.1, "/h1": -0.1}
TAG = -1.0
#: Starts the kind of a tag of, or in, a container that is left out.
CUT = "!"
#: Least and largest size of a weight.
WEAKEST, STRONGEST = 0.02, 4.0

RAW = "script|style|noscript|template|textarea|title|svg|iframe|object|select|math|canvas|audio|video"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})\b[^>]*(?<!/)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<rest>(?:[^>"']|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<close2>/?)(?P<name2>[a-z][^\s/>]*+)(?P<rest2>[^>]*)>""", re.I | re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search
    section summary table tbody td tfoot th thead tr ul""".split())
#: Elements and names (words of class, id or role) of what is not content.
BOILERPLATE_TAGS = set("nav footer aside button dialog menu label head".split())
#: Elements judged by what they hold, and the elements that make them one to fill in.
FORMS, FIELDS = {"form", "fieldset"}, {"input", "button", "select", "textarea"}
#: Share of a page's words that a form's text is no mere form with.
FORM_SHARE = 0.5
BOILERPLATE = set("""ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs byline
    comment comments commentlist comment-list disqus consent cookie cookies gdpr contentinfo complementary dialog
    footer footnav form header masthead topbar menu navbar navigation nav newsletter notice notices notification
    alert overlay pager pagination paywall popup modal promo promotion promoted recommended related replies reply
    respond search share sharing sidebar side-bar skip skyscraper social sponsor sponsored subscribe subscription
    signup login tags toc toolbar widget widgets discussion reviews reader-comments outbrain taboola""".split())
CONTENT_TAGS = {"article", "main", "body", "html"}
#: Names that say a container holds content.
CONTENT = set("article content main post entry body story text".split())
#: Last parts of a name that leave it to the part before them what the container is.
PART_OF = set("body content main text".split())
#: A name with one of these only speaks of what follows it; beside a content name also these.
SPEAKS_OF, LABELS = set("has no with without".split()), set("category tag topic type format status".split())
#: Also names of headings, wrappers and parts of an article.
WEAK = {"header", "widget", "widgets", "tags"}
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())


def names_of(rest: str) -> list[str]:
    """Names in class, id and role; none if the role is that of a content element."""
    out: list[str] = []
    for key, *values in ATTRIBUTE.findall(rest):
        if key.lower() == "hidden":
            out.append("dialog")
        spaced = re.sub(r"([a-z])([A-Z])", r"\1-\2", "".join(values)).lower().split()
        if key.lower() == "role" and not CONTENT_TAGS.isdisjoint(spaced):
            return []
        out += spaced
    return out


def names_boilerplate(name: str, bad: set[str], beside_content: bool) -> bool:
    """Whether the last part of a name that says something is one of ``bad``.  Parts in
    ``PART_OF`` say nothing, nor do unknown ones (``share-buttons``), but beside a name of
    content an unknown one keeps the container (``post ad-supported``)."""
    if name in bad:
        return True
    parts = [x for x in re.split(r"[^a-z]+", name) if x]
    for k in range(len(parts) - 1, -1, -1):
        if parts[k] in bad:
            return not (SPEAKS_OF | LABELS if beside_content else SPEAKS_OF) & set(parts[:k])
        if parts[k] not in PART_OF and (parts[k] in CONTENT or beside_content):
            return False
    return False


def is_boilerplate(name: str, rest: str, inside: bool) -> bool:
    """``inside``: within an article or main element, where a header holds the title."""
    if name in ("header", "label"):
        return not inside
    if name in BOILERPLATE_TAGS:
        return True
    if name in CONTENT_TAGS or not rest.strip():
        return False
    names = names_of(rest)
    bad = BOILERPLATE - WEAK if inside or name in HEADINGS else BOILERPLATE
    if name in FORMS:
        bad = bad - FORMS  # what such an element is, its content says
    return any(names_boilerplate(x, bad, any(y != x and not CONTENT.isdisjoint(re.split(r"[^a-z]+", y)) for y in names))
               for x in names)


def tokens(page: str) -> list[tuple[str, str, bool]]:
    """(kind, text, in labelled content) in page order: kind ``word`` or ``boilerplate`` with
    a piece of text, or a tag's name (with a slash if it closes, after ``CUT`` if it is left
    out) with an empty text."""
    out: list[tuple[str, str, bool]] = []
    open_: list[tuple[str, bool, int]] = []  # name, boilerplate, first token
    forms: list[tuple[int, int]] = []  # first token and last + 1
    boilerplate = content = at = 0

    def close(to: int) -> None:
        nonlocal boilerplate, content
        for name, bad, first in reversed(open_[to:]):
            boilerplate -= bad
            content -= name in ("article", "main")
            if name in FORMS and not boilerplate:
                forms.append((first, len(out)))
        del open_[to:]

    def last(name: str, stop: set[str]) -> int | None:
        for k in range(len(open_) - 1, -1, -1):
            if open_[k][0] == name:
                return k
            if open_[k][0] in stop:
                return None
        return None

    def tag(kind: str, cut: bool, inside: bool) -> None:
        out.append((CUT + kind if cut else kind, "", inside))

    for m in TOKEN.finditer(page):
        if m.start() > at:
            out.append(("boilerplate" if boilerplate else "word", page[at:m.start()], content > 0))
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            if m["raw"]:
                tag(m["raw"].lower(), boilerplate > 0, content > 0)
            continue
        rest = m["rest"] or m["rest2"] or ""
        if m["close"] or m["close2"]:
            if (k := last(name, set())) is not None:
                inside = content > 0 and name not in ("article", "main")
                close(k + 1)
                tag(f"/{name}", boilerplate > 0, inside)
                close(k)
            else:
                tag(f"/{name}", boilerplate > 0, content > 0)
            continue
        if name in BLOCK and (k := last("p", BLOCK - {"p"})) is not None:
            close(k)
        if name in ("li", "dd", "dt", "td", "th", "tr", "option") and (
                k := last(name, {"ul", "ol", "dl", "table", "menu", "article", "main"})) is not None:
            close(k)
        opens = name not in VOID and not rest.endswith("/")
        bad = opens and is_boilerplate(name, rest, content > 0)
        tag(name, boilerplate > 0 or bad, content > 0)
        if opens:
            open_.append((name, bad, len(out) - 1))
            boilerplate += bad
            content += name in ("article", "main")
    if at < len(page):
        out.append(("boilerplate" if boilerplate else "word", page[at:], content > 0))
    close(0)
    return without_forms(out, forms) if forms else out


def without_forms(items: list[tuple[str, str, bool]], forms: list[tuple[int, int]]) -> list[tuple[str, str, bool]]:
    """The tokens with those of forms to fill in (``forms``: first token, last + 1) left out."""
    words = list(accumulate((len(text.split()) if kind == "word" else 0 for kind, text, _ in items), initial=0))
    fields = list(accumulate((kind.lstrip(CUT) in FIELDS for kind, _, _ in items), initial=0))
    articles = list(accumulate((kind in ("article", "main") for kind, _, _ in items), initial=0))
    for first, end in forms:
        holds_text = articles[end] > articles[first] or words[end] - words[first] >= FORM_SHARE * words[-1]
        if fields[end] > fields[first] and not (holds_text and words[end] > words[first]):
            items[first:end] = [("boilerplate" if kind == "word" else kind if text or kind[0] == CUT else CUT + kind, text, inside)
                                for kind, text, inside in items[first:end]]
    return items


def region(items: list[tuple[str, str, bool]], weights: dict[str, float]) -> tuple[int, int]:
    """First and last+1 token of the maximum-scoring run (the first of equals; empty if no
    token scores positive).  What is left out anyway scores nothing."""
    best = here = 0.0
    span, start = (0, 0), 0
    for i, (kind, text, _) in enumerate(items):
        if kind == "boilerplate" or kind[0] == CUT:
            continue
        score = weights.get(kind, TAG) * len(text.split()) if text else weights.get(kind, TAG)
        here += score
        if here <= 0:
            here, start = 0.0, i + 1
        elif here > best:
            best, span = here, (start, i + 1)
    return span


def main_text(page: str | None, weights: dict[str, float]) -> str:
    items = tokens(page or "")
    first, end = region(items, weights)
    blocks, block = [], []
    for kind, text, _ in items[first:end]:
        if kind == "word":
            block.append(html.unescape(text))
        elif kind == "br":
            block.append(" ")
        elif kind.lstrip(CUT + "/") in BLOCK and block:
            blocks.append(block)
            block = []
    lines = (" ".join("".join(b).split()) for b in [*blocks, block])
    return "\n\n".join(x for x in lines if x)


def token_counts(page: str) -> Counter:
    """(kind, inside) counts of a labelled page; empty for a page without one label."""
    items = [(kind.removeprefix(CUT), text, inside) for kind, text, inside in tokens(page)]
    if sum(kind in ("article", "main") for kind, _, _ in items) != 1:
        return Counter()
    out: Counter = Counter()
    for kind, text, inside in items:
        out[kind, inside] += len(text.split()) if text else 1
    return out


def train(pages: DataFrame, sample: int = SAMPLE_PAGES) -> dict[str, float]:
    """Weights of the kinds of tokens from about ``sample`` pages."""
    small_batches(pages.sparkSession)
    size = max(1, pages.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch["html"].to_pylist():
                total.update(token_counts(page or ""))
        rows = list(total.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for (k, _), _ in rows], pa.string()), pa.array([i for (_, i), _ in rows], pa.bool_()),
             pa.array([n for _, n in rows], pa.int64())], ["kind", "inside", "n"])

    chosen = pages.filter(F.pmod(F.xxhash64("page_id"), F.lit(size)) < sample).select("html")
    kinds = (chosen.mapInArrow(run, "kind string, inside boolean, n long").groupBy("kind")
             .agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("inside"),
                  F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("outside"))
             .orderBy(F.desc(F.col("inside") + F.col("outside")), "kind").limit(MAX_KINDS).collect())
    if not kinds:
        return dict(DEFAULT)
    all_in, all_out = (1 + sum(r[c] for r in kinds) for c in ("inside", "outside"))
    weights = dict(DEFAULT)
    for kind, n_in, n_out in kinds:
        odds = math.log((n_in + 0.5) / all_in) - math.log((n_out + 0.5) / all_out)
        # a word is worth something and a tag costs something, however the odds are
        least, most = (WEAKEST, STRONGEST) if kind == "word" else (-STRONGEST, -WEAKEST)
        weights[kind] = min(most, max(least, odds))
    return weights


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    small_batches(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
