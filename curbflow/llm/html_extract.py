"""Operator 4: main text of web pages, by deducing the template of each host."""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import map_slices, stored
from curbflow.llm.url_filter import url_host

# Hosts with fewer pages take the template of all pages together.
LEAST_PAGES = 8
# Elements nested deeper than this belong to the element at this depth.
MAX_DEPTH = 256
# The template's texts leave a page only if at least this part of its text (one in so many characters) remains.
LEAST_PART = 4

# Elements that hold no main text, that are empty by definition, and that begin a new block of text.
_DROPPED = frozenset(
    (
        "script", "style", "noscript", "template", "nav", "header", "footer", "aside", "form", "button", "select", "textarea", "iframe", "svg", "head",
        "title", "menu", "dialog",
    )
)
_RAW = ("script", "style", "textarea", "title", "noscript")
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_ITEMS = frozenset(("li", "dt", "dd", "td", "th", "caption", "figcaption", "pre", "blockquote"))
_BLOCKS = (
    frozenset(
        (
            "address", "article", "body", "details", "div", "dl", "fieldset", "figure", "hr", "html", "main", "ol", "option", "p", "section", "summary",
            "table", "tbody", "tfoot", "thead", "tr", "ul",
        )
    )
    | _DROPPED
    | _HEADINGS
    | _ITEMS
)
# A start tag ends an open element of the first kind unless one of the second kind lies between.
_IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
# Class names and ids of boilerplate, and words that may stand beside them, as in `site-footer` or `ad_slot`.
_NOISE = frozenset(
    (
        "ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie", "cookies", "disqus", "footer",
        "header", "menu", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "popup", "promo", "related", "share", "sharing", "sidebar", "social",
        "sponsored", "subscribe", "widget", "widgets",
    )
)
_BESIDE = frozenset(
    (
        "area", "bar", "block", "bottom", "box", "buttons", "consent", "container", "form", "global", "item", "items", "left", "links", "list", "main", "page",
        "post", "posts", "primary", "reader", "right", "secondary", "section", "signup", "site", "slot", "thread", "top", "user", "wrap", "wrapper",
    )
)
_TAG = re.compile(r"<(?:(!--)|(!\[CDATA\[)|[!?]|(/?)([a-zA-Z][a-zA-Z0-9:-]*))")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in _RAW}
_LABEL = re.compile(r"\b(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")


def _is_noise(label: str) -> bool:
    """Whether a class name or id as a whole names boilerplate; `with-sidebar` or `notice-of-appeal` does not."""
    for name in label.lower().split():
        parts = {part for part in re.split(r"[-_]+", name) if part}
        if parts & _NOISE and parts <= _NOISE | _BESIDE:
            return True
    return False


def _key(*parts) -> int:
    value = xxhash.xxh64_intdigest("\n".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


class Page:
    """Elements and blocks of text of a page, in page order, read in one pass; unclosed and stray tags are tolerated."""

    def __init__(self, page: str):
        # By element: enclosing element, name, key with and without class names, boilerplate by name (2), by class name (1) or not.
        self.parent, self.names, self.roles, self.paths, self.noise = [-1], [""], [_key("")], [_key("")], [0]
        self.open, self.counts, self.beyond = [0], Counter(), Counter()
        self.blocks: list[tuple[str, int]] = []
        self._keys: dict[tuple, int] = {}
        parts: list[str] = []
        at, end_of = 0, {"-->": 0, "]]>": 0, ">": 0}
        size, quoted = len(page), True

        def after(mark: str, start: int) -> int:
            """The place behind the next mark, or -1; a search that found none is not repeated."""
            if end_of[mark] >= 0:
                end_of[mark] = page.find(mark, start)
            return end_of[mark] + len(mark) if end_of[mark] >= 0 else -1

        while match := _TAG.search(page, at):
            start, name = match.end(), (match[4] or "").lower()
            if match[1]:
                end = after("-->", start)
                end = size if end < 0 else end
            elif match[2]:
                end = after("]]>", start)
                end = after(">", start) if end < 0 else end
            elif name and quoted:
                rest = _REST.match(page, start)
                quoted = rest is not None
                end = rest.end() if rest else after(">", start)
            else:
                end = after(">", start)
            if end < 0:
                break
            parts.append(page[at : match.start()])
            at = end
            if name == "br":
                parts.append(" ")
            if name in _BLOCKS:
                self._flush(parts)
                self._close((name,)) if match[3] else self._open(name, page[start : end - 1])
            if name in _RAW_END and not match[3]:
                last = _RAW_END[name].search(page, at)
                at = after(">", last.end()) if last else size
                at = size if at < 0 else at
                self._close((name,))
        parts.append(page[at:])
        self._flush(parts)

    def _flush(self, parts: list[str]) -> None:
        text = _SPACE.sub(" ", entities.unescape("".join(parts))).strip()
        parts.clear()
        if text:
            self.blocks.append((text, self.open[-1]))

    def _child(self, *parts) -> int:
        key = self._keys.get(parts)
        if key is None:
            key = self._keys[parts] = _key(*parts)
        return key

    def _open(self, name: str, rest: str) -> None:
        if name in _VOID:
            return
        if self.names[self.open[-1]] == "p" and name == "p":
            self._close(("p",))
        if name in _IMPLIED:
            self._close(*_IMPLIED[name])
        if len(self.open) > MAX_DEPTH:
            self.beyond[name] += 1
            return
        label = " ".join(a or b or c for a, b, c in _LABEL.findall(rest)) if "=" in rest else ""
        top = self.open[-1]
        self.open.append(len(self.names))
        self.parent.append(top)
        self.names.append(name)
        self.paths.append(self._child(self.paths[top], name))
        self.roles.append(self._child(self.paths[top], name, label) if label else self.paths[-1])
        plain = name in ("html", "body", "main") or name in _HEADINGS
        self.noise.append(2 if name in _DROPPED and name != "form" else int(name == "form" or (bool(label) and not plain and _is_noise(label))))
        self.counts[name] += 1

    def _close(self, names: tuple[str, ...], until: tuple[str, ...] = ()) -> None:
        """End the innermost open element of the names, and all inside it, unless one of `until` lies between."""
        if len(names) == 1 and not until and self.beyond[names[0]]:
            self.beyond[names[0]] -= 1
            return
        if not any(self.counts[name] for name in names):
            return
        for k in range(len(self.open) - 1, 0, -1):
            name = self.names[self.open[k]]
            if name in names:
                for element in self.open[k:]:
                    self.counts[self.names[element]] -= 1
                del self.open[k:]
                self.beyond.clear()
                return
            if name in until:
                return

    def tokens(self) -> dict[int, tuple[int, int]]:
        """Tokens of the page by key: how often each occurs, and the key of the element that holds the first one.

        Tokens are the elements, with and without their class names, and the texts of blocks with their path of element names.
        """
        found: dict[int, list[int]] = {}
        for k, up in enumerate(self.parent):
            held = self.paths[max(up, 0)]
            for key in {self.roles[k], self.paths[k]}:
                found.setdefault(key, [0, held])[0] += 1
        for text, element in self.blocks:
            found.setdefault(self.text_key(text, element), [0, self.paths[element]])[0] += 1
        return {key: (count, held) for key, (count, held) in found.items()}

    def text_key(self, text: str, element: int) -> int:
        return _key(self.paths[element], "text", text)

    def clean(self) -> list[tuple[str, int, bool, bool]]:
        """The blocks outside boilerplate elements: text, element, whether inside an article, whether inside a main element.

        A form, or an element with a class name of boilerplate, stays if it holds the page's largest article or main element, on pages without
        one if it holds more than half of the text.
        """
        count = len(self.names)
        hard, inside, chars = [False] * count, [[False, False] for _ in range(count)], [0] * count
        for k in range(1, count):
            up = self.parent[k]
            hard[k] = hard[up] or self.noise[k] == 2
            inside[k] = [inside[up][0] or self.names[k] == "article", inside[up][1] or self.names[k] == "main"]
        for text, element in self.blocks:
            if not hard[element]:
                chars[element] += len(text)
        for k in range(count - 1, 0, -1):
            chars[self.parent[k]] += chars[k]
        named = [k for k in range(1, count) if self.names[k] in ("article", "main") and not hard[k] and not self.noise[k] and chars[k]]
        holds = set()
        if named:
            focus = max(named, key=lambda k: (chars[k], -k))
            while focus > 0:
                holds.add(focus)
                focus = self.parent[focus]
        gone = [False] * count
        for k in range(1, count):
            large = k in holds if named else 2 * chars[k] > chars[0]
            gone[k] = gone[self.parent[k]] or self.noise[k] == 2 or (self.noise[k] == 1 and not large)
        return [(text, element, *inside[element]) for text, element in self.blocks if not gone[element]]


def template_tokens(pages: DataFrame) -> DataFrame:
    """host, key, held, vector, pages, least, most: how the tokens of pages occur over each host.

    vector is a hash of the occurrence vector (count by page), built so that workers combine it before the shuffle: equal
    vectors have equal hashes. held is the least key of an element that holds the token. least and most differ if pages with different texts have it.
    """

    def run(batch: pa.RecordBatch) -> dict:
        seen: dict[tuple[str, int], list[int]] = {}
        ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
        for page_id, url, host, page in zip(ids, urls, batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            parsed = Page(page or "")
            content = _key(*(text for text, _ in parsed.blocks))
            for key, (count, held) in parsed.tokens().items():
                own = seen.setdefault((host, key), [held, 0, 0, content, content])
                own[0] = min(own[0], held)
                own[1] ^= _key(page_id, url, count)
                own[2] += 1
                own[3], own[4] = min(own[3], content), max(own[4], content)
        columns = list(zip(*seen.values())) if seen else [[]] * 5
        names = ("held", "vector", "pages", "least", "most")
        return {"host": [h for h, _ in seen], "key": [k for _, k in seen], **{name: list(column) for name, column in zip(names, columns)}}

    counted = map_slices(pages, run, "host string, key long, held long, vector long, pages long, least long, most long", "html")
    return _merged(counted, "host", "key")


def _merged(tokens: DataFrame, *by: str) -> DataFrame:
    return tokens.groupBy(*by).agg(
        F.min("held").alias("held"), F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.min("least").alias("least"), F.max("most").alias("most")
    )


def templates(tokens: DataFrame) -> DataFrame:
    """host, classes: the template of each host, as the token keys of its valid equivalence classes.

    Tokens with the same occurrence vector are one class. A class is valid if it has two tokens or more, stands on at least half of
    the host's pages and on pages with different texts, and nests: the elements that hold its tokens stand on at least half of the pages too.
    No host has more such tokens than two pages of it have on average.
    """
    total = tokens.filter(F.col("key") == _key("")).select("host", F.col("pages").alias("host_pages"))
    frequent = tokens.join(total, "host").filter("2 * pages >= host_pages")
    holders = frequent.select("host", F.col("key").alias("held"), F.lit(1).alias("nests"))
    nested = frequent.join(holders, ["host", "held"], "left")
    classes = nested.groupBy("host", "vector", "pages").agg(
        F.sort_array(F.collect_list("key")).alias("keys"), F.count("nests").alias("nests"), F.min("least").alias("least"), F.max("most").alias("most")
    )
    valid = classes.filter("size(keys) >= 2 AND nests = size(keys) AND least <> most")
    return valid.groupBy("host").agg(F.sort_array(F.collect_list("keys")).alias("classes"))


def main_text(page: str | None, classes: list[list[int]] | None) -> str:
    """The text in the slots that the template leaves, one block per line.

    Blocks that are tokens of a class that stands whole on the page go, unless less than a quarter of the text would remain;
    headings, list items and table cells inside articles stay. If articles (else main elements) hold half of the rest or more, it's the rest.
    """
    parsed = Page(page or "")
    blocks = parsed.clean()
    if classes and blocks:
        there = parsed.tokens()
        fixed = {key for keys in classes if all(key in there for key in keys) for key in keys}
        rest = [b for b in blocks if (b[2] and parsed.names[b[1]] in _HEADINGS | _ITEMS) or parsed.text_key(b[0], b[1]) not in fixed]
        if LEAST_PART * sum(len(b[0]) for b in rest) >= sum(len(b[0]) for b in blocks):
            blocks = rest
    size = sum(len(b[0]) for b in blocks)
    for kind in (2, 3):
        inside = [b for b in blocks if b[kind]]
        if inside and 2 * sum(len(b[0]) for b in inside) >= size:
            blocks = inside
            break
    return "\n".join(b[0] for b in blocks)


def extract_text(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """page_id, url, text: the main text of every row of pages, from the whole html.

    Hosts with at least least_pages pages have a template of their own, all others share that of all pages. Character references are decoded, white
    space within a block becomes one space, blocks are joined by line breaks. NULL and empty html give an empty text; a NULL
    url has the empty host; repeated rows are extracted one by one; other columns are not read.

    The stored templates are joined by host: Spark broadcasts them only if their files lie below its threshold, and adaptive execution splits a
    host with a large part of all pages otherwise.
    """
    rows = pages.select("page_id", "url", "html").withColumn("host", url_host(F.col("url")))
    tokens = stored(template_tokens(rows))
    own_hosts = tokens.filter((F.col("key") == _key("")) & (F.col("pages") >= least_pages)).select("host")
    # Stored, so that the host is a column like any other and not a constant on which a join has no key.
    common = templates(stored(_merged(tokens, "key").withColumn("host", F.lit("")))).first()
    shared = common["classes"] if common else None
    # A host of its own without any valid class has an empty template, not the shared one.
    found = templates(tokens.join(own_hosts, "host", "left_semi"))
    own = stored(own_hosts.join(found, "host", "left").select("host", F.coalesce("classes", F.expr("array()")).alias("classes")))
    joined = rows.join(own, "host", "left")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        classes = batch.column("classes").to_pylist()
        out = [main_text(page, shared if own is None else own) for page, own in zip(batch.column("html").to_pylist(), classes)]
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": out}

    return map_slices(joined.select("page_id", "url", "html", "classes"), run, f"page_id {kind}, url string, text string", "html")
