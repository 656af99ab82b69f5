"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped and the page becomes a list of lines, one for each block
element. Lines in menus, forms, adverts, comments and the like are set apart:
they are never kept and neither make nor end a run of text. What marks such a part
is weighed against what it holds: a form, or an element marked by its class or id
and not one of reader comments, that holds most of the page's text, be it an
article or several long lines, is a wrapper and not set apart; parts within it may
be. Lines that are mostly links count as empty. The text lengths of the rest are summed over a sliding
window of lines: where the sum rises over a threshold the main text surges,
where it falls to nothing it dives, and all lines between are kept, short ones
and links too. An article or main element is one weight: where such elements hold most of a
page's text, their lines count double, those of links too, and a surge in them
reaches back to where the element begins. It excludes no line.

Null and empty pages give an empty text, an empty table no rows. Repeated rows are
read one by one. Whole pages are read, nothing is capped, and time grows with a
page's length, also for tags that never end: a tag has TAG_PARTS characters and
quoted values at most, else its `<` is text. The markup column may have any name;
other columns go along as they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from settle.llm.common import texts_of

WINDOW = 3
SURGE = 80  # characters in a window where the main text begins
MARKED_WEIGHT = 2  # of lines in article or main, where these hold most of the text
LINK_SHARE = 0.6  # a line with more of its characters in links counts as empty where the text surges and dives

# Elements whose content is never text of the page. Without an end tag, RAW ones run to the end of the page, a title
# to the next tag, a select to the first tag that is not of its options; of the others only the tag is skipped.
RAW = {"script", "style", "textarea"}
HIDDEN = RAW | {"template", "noscript", "iframe", "svg", "select", "title", "object", "canvas"}
# Elements that hold no part of an article.
APART = {"nav", "footer", "aside", "form", "dialog", "menu", "button", "header"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "menu", "menubar"}
# Words of class and id that mark such parts: by themselves, or with others of them and with COMPANIONS.
MARKS = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination"
    " popup promo promoted related reply replies share sharing sidebar signup social sponsor sponsored subscribe toolbar"
    " widget".split()
)
COMPANIONS = set(
    "site page main global top bottom left right upper lower primary secondary first last list lists box boxes bar bars area"
    " section container wrapper wrap inner outer block group row col column panel links link item items slot unit units"
    " buttons button icons icon form search posts post articles stories news media post content body text title module"
    " mobile desktop sticky fixed".split()
)
COMMENTS = {"comment", "comments", "disqus", "reply", "replies"}
ARTICLE = {"article", "main"}
LONG_LINES = 3  # lines of SURGE characters that tell a wrapper from a notice
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr"
    " ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())

TAG_PARTS = 400
ATTRIBUTES = rf"""(?:"[^"]*"|'[^']*'|[^'">]){{0,{TAG_PARTS}}}+"""
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>{ATTRIBUTES})>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
# What drops the rest of a page where no tag ends any more.
ENDLESS = re.compile(r"<[!?/]")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.IGNORECASE) for name in RAW}
PAIRED = re.compile(
    rf"<(?P<end>/?)(?P<name>{'|'.join(sorted(HIDDEN - RAW))})(?=[\s/>])(?P<attributes>{ATTRIBUTES})>", re.IGNORECASE
)
UNCLOSED = {
    "title": re.compile(r"[^<]*"),
    "select": re.compile(r"(?:[^<]|</?(?:option|optgroup|hr)(?=[\s/>])[^>]*>)*", re.IGNORECASE),
}
MARKED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)


def marked(token: str) -> bool:
    """Whether a class or id names a part: `site-footer` does, `no-sidebar` and `ad-hoc` do not."""
    words = [w for w in re.split(r"[-_]+|(?<=[a-z])(?=\d)", token) if w and not w.isdigit()]
    return any(w in MARKS for w in words) and words[0] != "content" and all(w in MARKS or w in COMPANIONS for w in words)


def set_apart(name: str, attributes: str, in_article: bool) -> str | None:
    """Why an element holds something other than the article: by its `tag`, its `mark`, or as `comments`; None if it does not."""
    if name in APART:
        # The header of the article itself has its title.
        return None if name == "header" and in_article else "mark" if name == "form" else "tag"
    if name in ("html", "body", "article", "main") or not attributes:
        return None
    for key, value in MARKED.findall(attributes):
        words = value.strip("\"'").lower()
        if key.lower() == "role":
            if words.strip() in ROLES:
                return "tag"
        elif any(map(marked, words.split())):
            parts = set(re.split(r"[-_\s]+", words))
            if not (in_article and "header" in parts):
                return "comments" if parts & COMMENTS else "mark"
    return None


def ends(page: str) -> dict[int, int]:
    """Where hidden elements that have an end tag begin, and where that tag ends; each end tag closes the last open one."""
    found: dict[int, int] = {}
    begun: dict[str, list[int]] = {}
    for tag in PAIRED.finditer(page, 0, page.rfind(">") + 1):
        starts = begun.setdefault(tag["name"].lower(), [])
        if not tag["end"]:
            if not tag["attributes"].endswith("/"):
                starts.append(tag.start())
        elif starts:
            found[starts.pop()] = tag.end()
    return found


class Lines:
    """Lines of a page: text, characters in links, the marked elements around it, whether in the article."""

    def __init__(self, page: str):
        self.lines: list[tuple[str, int, tuple[int, ...], bool]] = []
        self.reasons: list[str] = []  # of the marked elements
        self.open: list[tuple[str, tuple[int, ...], bool]] = []  # name, marked elements and article around its content
        self.at: dict[str, list[int]] = {}  # places in `open` by name
        self.pieces: list[str] = []
        self.linked = self.links = 0
        at, closed = 0, ends(page)
        last = page.rfind(">") + 1  # no tag ends after this
        while token := TOKEN.search(page, at, last):
            self.text(page[at : token.start()])
            at = token.end()
            if at == last and token[0].startswith("<!--") and not token[0].endswith(("-->", "--!>")):
                at = len(page)
                break
            if not (name := (token["name"] or "").lower()):
                continue
            if name not in HIDDEN or token["end"] or token["attributes"].endswith("/"):
                self.tag(name, bool(token["end"]), token["attributes"])
            elif name in RAW:
                end = RAW_END[name].search(page, at, last)
                at = end.end() if end else len(page)
            elif token.start() in closed:
                at = closed[token.start()]
            elif name in UNCLOSED:
                at = UNCLOSED[name].match(page, at, max(last, at)).end()
        cut = ENDLESS.search(page, at)
        self.text(page[at : cut.start() if cut else len(page)])
        self.line()

    def state(self) -> tuple[tuple[int, ...], bool]:
        return self.open[-1][1:] if self.open else ((), False)

    def text(self, raw: str) -> None:
        if raw:
            self.pieces.append(raw)
            if self.links:
                self.linked += len(raw.strip())

    def line(self) -> None:
        if self.pieces:
            text = " ".join(html.unescape("".join(self.pieces)).split())
            if text:
                self.lines.append((text, self.linked, *self.state()))
        self.pieces, self.linked = [], 0

    def close(self, names: set[str], within: set[str]) -> None:
        """Close the innermost open element of these names, unless one of `within` is around it."""
        inner = max((self.at[n][-1] for n in names if self.at.get(n)), default=-1)
        if inner < 0 or any(self.at[n][-1] > inner for n in within if self.at.get(n)):
            return
        for name, *_ in self.open[inner:]:
            self.at[name].pop()
        del self.open[inner:]

    def tag(self, name: str, end: bool, attributes: str) -> None:
        if name == "br":
            self.pieces.append(" ")
        if name == "a":
            self.links = 0 if end else 1
        block = name in BLOCK
        if block:
            self.line()
            self.links = 0
        if end:
            self.close({name}, set() if block else BLOCK)
            return
        if block:  # a paragraph or an item ends where the next one begins
            self.close({"p"}, BLOCK - {"p"})
            if name == "li":
                self.close({"li"}, {"ul", "ol", "menu"})
        if name in VOID or attributes.endswith("/"):
            return
        around, in_article = self.state()
        # Within a menu or comments nothing is weighed any more.
        settled = bool(around) and self.reasons[around[-1]] != "mark"
        if not settled and (reason := set_apart(name, attributes, in_article)):
            around = (*around, len(self.reasons))
            self.reasons.append(reason)
        self.at.setdefault(name, []).append(len(self.open))
        self.open.append((name, around, in_article or name in ARTICLE))


def of_page(page: str) -> list[tuple[str, int, bool]]:
    """Lines that are not set apart: text, characters in links, whether in the article."""
    found = Lines(page)
    held, long_lines, articles = ([0] * len(found.reasons) for _ in range(3))
    for text, linked, around, in_article in found.lines:
        for element in around:
            held[element] += len(text)
            long_lines[element] += len(text) >= SURGE and linked <= LINK_SHARE * len(text)
            articles[element] += in_article
    every = sum(len(text) for text, *_ in found.lines)
    apart = [
        reason != "mark" or 2 * held[i] <= every or not (articles[i] or long_lines[i] >= LONG_LINES)
        for i, reason in enumerate(found.reasons)
    ]
    return [(text, linked, in_article) for text, linked, around, in_article in found.lines if not any(apart[i] for i in around)]


def main_text(page: str) -> str:
    lines = of_page(page)
    in_articles = sum(len(text) for text, _, in_article in lines if in_article)
    trusted = 2 * in_articles > sum(len(text) for text, _, _ in lines)
    weights = []
    for text, linked, in_article in lines:
        if trusted and in_article:
            weights.append(MARKED_WEIGHT * len(text))
        else:
            weights.append(0 if linked > LINK_SHARE * len(text) else len(text))
    sums = [sum(weights[i : i + WINDOW]) for i in range(len(weights))]
    # On a page with little text the fullest window is where it surges.
    threshold = min(SURGE, max(sums, default=0))
    kept, between, dived = [], False, 0
    for i, (weight, ahead) in enumerate(zip(weights, sums, strict=True)):
        if not between and weight and ahead >= threshold:
            between, start = True, i  # surge
            while trusted and start > dived and lines[start - 1][2]:
                start -= 1
            kept += [lines[j][0] for j in range(start, i)]
        elif between and not ahead:
            between, dived = False, i  # dive
        if between:
            kept.append(lines[i][0])
    return "\n".join(kept)


def extract(pages: DataFrame, columns: list[str], markup: str = "html", text: str = "text") -> DataFrame:
    """`columns` of every page and its main text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [main_text(page) if page else "" for page in texts_of(batch.column(len(columns)))]
            arrays = [*batch.columns[: len(columns)], pa.array(made, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, text])

    schema = pages.select(*columns).schema.add(text, "string")
    sent = pages.select(*columns, F.col(markup)).toDF(*columns, "_markup")
    return sent.mapInArrow(run, schema)
