"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. Pass one decides blocks from
their own features: markup that names a menu, advert, comment list and so on,
link density, length and stop-word density. Pass two gives every block that is
too short to tell the label of its nearest decided neighbours.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Frequent words of four languages.
STOP_WORDS = frozenset("""
a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their
they this to was we were which will with you
au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous ou par pas pour que qui sa se
ses son sur un une vous
aber als auch auf aus bei das dem den der des die ein eine einen er es für ich im ist mit nach nicht oder sich sie
sind so und von vor war wie wir zu zum zur
al como con del el ella ellos en es esta este la las lo los más me mi no nos o para pero por que se si sin su sus
también un una y ya
""".split())

#: Elements whose content is never the article.
DROPPED = frozenset("""head script style noscript template nav footer aside form button select textarea iframe svg
canvas object audio video dialog menu datalist map""".split())
RAW = ("script", "style", "noscript", "template", "textarea", "title", "svg", "iframe")
#: Words of class, id or role that name such content.
AWAY = frozenset("""ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs complementary
contentinfo consent cookie cookies dialog footer gdpr login menu modal nav navbar navigation newsletter notice notices
outbrain overlay pager pagination paywall popup promo promoted promotion recommended related search share sharing
sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar widget alert disclaimer
footnav sidenav topbar""".split())
COMMENTS = frozenset("comment comments commentlist discussion disqus replies reply respond responses".split())
HEADERS = frozenset("header masthead topbar".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table
tbody tfoot thead title tr ul caption""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span
strike strong sub sup time tt u var""".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+(?:/>|>.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-zA-Z][^>]*>|<[!?][^>]*>", re.S | re.I)
NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
ARTICLE = re.compile(r"(?:^|\s)(?:role\s*=\s*[\"']?main\b|itemprop\s*=\s*[\"']?articleBody\b)", re.I)
WORDS = re.compile(r"[^a-z]+")

GOOD, BAD, UNSURE, MARKUP = 1, 0, None, -1

#: Production rules: shortest text that decides by itself (characters), least
#: share of stop words in it, largest share of linked characters, and the
#: number of neighbouring linked blocks that make a menu.
LONG, STOP_SHARE, LINK_SHARE, MENU = 70, 0.12, 0.5, 3


def _dropped(name: str, attrs: str, in_article: bool) -> int:
    """1: not the article; 2: reader comments, even if they hold articles."""
    if name in DROPPED:
        return 2
    if name == "header":
        return 0 if in_article else 1
    if not attrs or name in ("html", "body", "main"):
        return 0
    if HIDDEN.search(attrs):
        return 2
    words = {w for m in NAMES.finditer(attrs) for w in WORDS.split((m[1] or m[2] or m[3] or "").lower())}
    if words & COMMENTS:
        return 2
    if name == "article":
        return 0
    if words & AWAY or words & HEADERS and not in_article:
        return 1
    return 0


def blocks(page: str) -> list[tuple[str, float, bool, bool]]:
    """(text, share of linked characters, inside article or main, dropped by
    markup) in page order; empty blocks are left out."""
    out: list[tuple[str, float, bool, bool]] = []
    stack: list[tuple[str, int, bool]] = []  # name, dropped, inside the article
    parts: list[str] = []
    linked, links, at = 0, 0, 0

    def close() -> None:
        nonlocal linked
        text = " ".join(_html.unescape("".join(parts)).split())
        if text:
            _, gone, inside = stack[-1] if stack else ("", 0, False)
            out.append((text, min(1.0, linked / len(text)), inside, gone > 0))
        parts.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        if links:
            linked += len(piece.strip())

    for m in TOKEN.finditer(page):
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if name == "a":
            links = 0 if m["end"] else 1
        if name in BLOCKS:
            close()
        elif name in ("br", "td", "th"):
            parts.append(" ")
        if name in VOID:
            continue
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in BLOCKS and stack and stack[-1][0] == "p":
            stack.pop()
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            stack.pop()
        _, gone, inside = stack[-1] if stack else ("", 0, False)
        own = _dropped(name, m["attrs"], inside)
        if name in INLINE and not own:
            continue
        if own and name in INLINE:
            close()
        if name in ("article", "main") or m["attrs"] and ARTICLE.search(m["attrs"]):
            inside, gone = True, 0 if gone < 2 else gone
        if not (m["attrs"] or "").endswith("/"):
            stack.append((name, max(gone, own), inside))
    add(page[at:])
    close()
    return out


def main_text(page: str | None) -> str:
    """The article's blocks joined by line breaks."""
    if not page:
        return ""
    found = blocks(page)
    zoned = any(inside and not gone for _, _, inside, gone in found)
    stops = [sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in t.split()) / (t.count(" ") + 1)
             for t, *_ in found]
    # Stop words decide only where the page's long plain blocks are mostly in a
    # language with listed ones; a few hits in a footer do not count.
    plain = [(len(t), s) for (t, link, _, gone), s in zip(found, stops)
             if not gone and link <= LINK_SHARE and len(t) >= LONG]
    covered = 2 * sum(n for n, s in plain if s >= STOP_SHARE) >= sum(n for n, _ in plain)

    # Pass one: what a block's own features decide.
    labels: list[int | None] = []
    for (text, link, inside, gone), stop in zip(found, stops):
        if gone or zoned and not inside:
            labels.append(MARKUP)
        elif link > LINK_SHARE:
            labels.append(UNSURE if zoned else BAD)
        elif len(text) >= LONG:
            # Inside a marked article nothing but linked lists is left out.
            labels.append(GOOD if zoned or stop >= STOP_SHARE or not covered else BAD)
        else:
            labels.append(UNSURE)
    run: list[int] = []
    for i in [*range(len(found)), None]:
        if i is not None and labels[i] != MARKUP and found[i][1] > LINK_SHARE:
            run.append(i)
            continue
        if len(run) >= MENU:
            for k in run:
                labels[k] = BAD
        run = []

    # Pass two: the nearest decided blocks on both sides; a tie is kept.
    before: list[tuple[int, int] | None] = []
    near = None
    for i, x in enumerate(labels):
        if x in (GOOD, BAD):
            near = (i, x)
        before.append(near)
    near, keep = None, []
    for i in range(len(labels) - 1, -1, -1):
        x = labels[i]
        if x in (GOOD, BAD):
            near = (i, x)
        if x is UNSURE:
            sides = [s for s in (before[i], near) if s]
            least = min((abs(s[0] - i) for s in sides), default=0)
            x = max((s[1] for s in sides if abs(s[0] - i) == least), default=GOOD)
        if x == GOOD:
            keep.append(found[i][0])
    return "\n".join(reversed(keep))


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    Null and empty html give an empty text of no characters; html of any length
    is read whole; repeated rows and ids are rows of their own; null ids and
    urls stay null. An empty table gives no rows; other columns are ignored.
    """
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, url_col)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [main_text(p) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(id_col, url_col, html_col).mapInArrow(
        work, f"page_id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
