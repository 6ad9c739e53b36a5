"""Main text of web pages: site templates are found by subtrees that recur within a host.

Each page is parsed once into a tree of elements; inline markup and elements that hold no text
to read (scripts, styles, media, hidden ones) are left out. Every subtree with text is hashed:
menus, adverts and footers as well as sections, lists and paragraphs. Spark counts per host the
distinct contents a subtree stands in, so that copies of one page count once. What is removed,
in this order of evidence:

1. Subtrees that recur in ``min_pages`` distinct contents of their host, or in ``min_texts`` of
   them for a single text block (headings and lines of a list or table go only with the element
   around them). Text blocks of a declared article stay, so that a passage which articles share
   is kept. Both counts are absolute: they ask the same of a large host as of a small one.
2. Elements that say by their tag or role that they are no content: menus, headers and footers
   outside an article, sidebars, forms, dialogs.
3. Elements whose class or id says so. In an article a text block is never judged by its name,
   and another element only if all words of its class are of that kind or about layout. An
   element that holds most of a page's text is not judged by its name either.
4. If declared articles hold at least half of the text that is left, or most of its blocks,
   the rest goes; failing that, the same for ``main``.

Templates are not collected anywhere: subtrees are joined with them by (host, hash) and brought
back by row number, by broadcast if what is sent is counted to fit, else by a shuffle.

Defined results: null or empty html has the text ""; a url without a host counts under the
empty host; equal rows are pages of their own; broken markup is read as browsers roughly do. A
menu, header, footer, sidebar or form that is never closed ends where an article begins.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from labelwright.llm.rows import small_side
from labelwright.sources.scratch import store

MIN_PAGES = 5
MIN_TEXTS = 20

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style title textarea xmp iframe noembed noframes plaintext".split())
_SILENT = set(
    "head script style noscript template iframe object embed svg math canvas audio video map"
    " select textarea xmp noembed noframes title button input".split()
)
_FURNITURE = set("nav footer aside form fieldset dialog menu label".split())
_NEVER_CLOSED = set("nav header footer aside form".split())
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var wbr br".split()
)
_TEXT_BLOCKS = set("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre table thead tbody tfoot tr td th caption figcaption address".split())
# Text blocks that are not templates on their own.
_LINES = set("h1 h2 h3 h4 h5 h6 li dt dd thead tbody tfoot tr td th caption figcaption".split())
_ENDS_P = set(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split()
)
_SCOPE = set("html body table td th caption button object template article section main".split())
_SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
}
_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed|s)?|promos?|promotions?|banners?|cookies?"
    r"|consent|gdpr|notices?|notifications?|alerts?|popups?|modal|newsletter|subscribe|sidebars?|menus?|nav|navbar"
    r"|navigation|breadcrumbs?|pagination|pager|footer|masthead|comments?|disqus|replies|respond|share|sharing"
    r"|social|related|recommended|recommendations|widgets?|toolbar|login|signup|searchform|searchbox)(?:$|[\s_-])",
    re.I,
)
# Words of a class that are about layout and say nothing about the content.
_LAYOUT = set(
    "bar block body bottom box boxes btn button buttons card center col column container content count counts fixed flex float"
    " full grid group hidden holder icon icons inline inner item items left line link links list lists main media mobile modal"
    " module outer panel row section side small sticky tab table tabs text title top unit wrap wrapper xs sm md lg xl".split()
)
_PART = re.compile(r"[A-Za-z]+")
_HEADER = re.compile(r"(?:^|[\s_-])(?:header|topbar)(?:$|[\s_-])", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)


class _Page:
    """Elements in page order (parents first) with their evidence, and the text blocks under them.

    ``rule`` is 0, 1 for an element that is no content by tag or role, 2 by its name. ``home`` is
    1 inside an article, 2 inside main only.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.parts = ["#root"], [-1], [["#root"]]
        self.rule, self.home = [0], [0]
        self.blocks: list[tuple[int, str]] = []
        self.stack: list[tuple[str, int]] = [("#root", 0)]
        self.open_text: list[str] = []
        self.node = 0
        self.dropped = 0
        self.source, self.place = source, 0
        self.ends: dict[str, int] = {}
        self.read(source)
        self.flush()

    def flush(self) -> None:
        if self.open_text:
            words = " ".join("".join(self.open_text).split())
            if words:
                self.blocks.append((self.node, words))
                self.parts[self.node].append(words)
            self.open_text = []

    def text(self, raw: str) -> None:
        if raw and not self.dropped:
            self.open_text.append(html.unescape(raw) if "&" in raw else raw)

    def silent(self, tag: str, attributes: dict) -> bool:
        """Nothing of it is read."""
        if tag in _SILENT or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
            return True
        return bool(_HIDDEN.search(attributes.get("style", "")))

    def named(self, tag: str, attributes: dict) -> bool:
        """Whether class and id say that it is no content."""
        if tag in ("html", "body", "main"):
            return False
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
        if not self.home[self.node]:
            return bool(_NOISE.search(names) or _HEADER.search(names))
        if tag in _TEXT_BLOCKS or not _NOISE.search(names):
            return False
        words = _PART.findall(names.lower())
        return all(w in _LAYOUT or _NOISE.search(w) for w in words)

    def evidence(self, tag: str, attributes: dict) -> int:
        if tag in _FURNITURE or attributes.get("role", "").lower() in _ROLES or tag == "header" and not self.home[self.node]:
            return 1
        return 2 * self.named(tag, attributes)

    def pop(self) -> None:
        tag, node = self.stack.pop()
        if node < 0:
            self.dropped -= 1
        elif tag not in _INLINE:
            if not self.dropped:
                self.flush()
            self.node = self.parent[node]

    def closes_later(self, tag: str) -> bool:
        """Whether an end tag follows; the place found is kept for the next question."""
        at = self.ends.get(tag, -1)
        if at < self.place and at != len(self.source):
            found = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(self.source, self.place)
            self.ends[tag] = at = found.start() if found else len(self.source)
        return at < len(self.source)

    def end_open_furniture(self) -> None:
        for tag in {t for t, _ in self.stack} & _NEVER_CLOSED:
            if not self.closes_later(tag):
                self.pop_to({tag}, {"#root"})

    def pop_to(self, wanted: set, stops: set) -> None:
        """Close the nearest of the wanted elements, unless one of the stops is nearer."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k][0] in wanted:
                while len(self.stack) > k:
                    self.pop()
                return
            if self.stack[k][0] in stops:
                return

    def start(self, tag: str, raw: str) -> None:
        if tag in _ENDS_P:
            self.pop_to({"p"}, _SCOPE)
        if tag in _SIBLINGS:
            self.pop_to(*_SIBLINGS[tag])
        if tag in ("article", "main"):
            self.end_open_furniture()
        void = tag in _VOID
        if self.dropped:
            if not void:
                self.stack.append((tag, -1))
                self.dropped += 1
            return
        attributes = {}
        if raw and not raw.isspace():
            for name, value in _ATTRIBUTE.findall(raw):
                attributes.setdefault(name.lower(), html.unescape(value.strip("\"'")))
        if void:
            if tag == "br":
                self.open_text.append(" ")
            elif tag == "hr":
                self.flush()
            return
        if self.silent(tag, attributes) or tag in _INLINE and self.evidence(tag, attributes):
            if tag not in _INLINE:
                self.flush()
            self.stack.append((tag, -1))
            self.dropped += 1
            return
        if tag in _INLINE:
            self.stack.append((tag, self.node))
            return
        self.flush()
        node = len(self.tag)
        self.rule.append(self.evidence(tag, attributes))
        self.home.append(1 if tag == "article" else self.home[self.node] or 2 * (tag == "main"))
        self.tag.append(tag)
        self.parent.append(self.node)
        self.parts.append([f"<{tag} {attributes.get('class', '')}#{attributes.get('id', '')}>"])
        self.stack.append((tag, node))
        self.node = node

    def read(self, source: str) -> None:
        place, end = 0, len(source)
        while place < end:
            found = _TOKEN.search(source, place)
            if not found:
                self.text(source[place:])
                return
            self.text(source[place : found.start()])
            self.place = place = found.end()
            tag = found[2] or found[5]
            if not tag:
                continue
            tag = tag.lower()
            if found[1] or found[4]:
                if tag == "p" and not any(t == "p" for t, _ in self.stack):
                    self.flush()
                self.pop_to({tag}, _SCOPE - {tag} if tag in _INLINE or tag == "p" or tag in _SIBLINGS else {"#root"})
                continue
            raw = found[3] if found[2] else found[6]
            if tag in _RAW:
                close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|</{tag}\Z", re.I).search(source, place)
                if tag not in _INLINE and tag in _ENDS_P:
                    self.flush()
                place = close.end() if close else end
                continue
            self.start(tag, raw)

    def result(self) -> dict:
        """Per element: hash (0: never deleted, odd: a single text block), parent, rule and home; blocks; content hash."""
        n = len(self.tag)
        hashes, below = [0] * n, [0] * n
        for b, t in self.blocks:
            below[b] += len(t)
        # Parents come before children; texts and subtrees are hashed from the last one back.
        for k in range(n - 1, 0, -1):
            hashes[k] = xxhash.xxh64_intdigest("\x1f".join(self.parts[k])) - (1 << 63)
            self.parts[self.parent[k]].append(f"{hashes[k]:x}")
            below[self.parent[k]] += below[k]
        for k in range(1, n):
            tag, single = self.tag[k], self.tag[k] in _TEXT_BLOCKS
            never = tag in ("html", "body", "main", "article") or tag in _LINES or single and self.home[k] == 1 or not below[k]
            hashes[k] = 0 if never else hashes[k] & ~1 | single
            if self.rule[k] == 2 and not self.home[self.parent[k]] and 2 * below[k] > below[0]:
                self.rule[k] = 0
        hashes[0] = 0
        texts = [t for _, t in self.blocks]
        content = xxhash.xxh64_intdigest("\n".join(t for b, t in self.blocks if not self.ruled(b))) - (1 << 63)
        return {"hashes": hashes, "parents": self.parent, "rules": self.rule, "homes": self.home, "where": [b for b, _ in self.blocks], "texts": texts, "content": content}

    def ruled(self, k: int) -> bool:
        while k > 0:
            if self.rule[k]:
                return True
            k = self.parent[k]
        return False


def parse(source: str | None) -> dict:
    return _Page(source or "").result()


def remaining(page: dict, gone: set[int]) -> tuple[list[str], int, int]:
    """Blocks left when the subtrees with these hashes go; subtrees removed by recurrence and by markup."""
    hashes, parents, rules, homes = page["hashes"], page["parents"], page["rules"], page["homes"]
    lost = [False] * len(hashes)
    n_templates = n_rules = 0
    for k in range(1, len(hashes)):
        if lost[parents[k]]:
            lost[k] = True
        elif hashes[k] in gone:
            lost[k] = True
            n_templates += 1
        elif rules[k]:
            lost[k] = True
            n_rules += 1
    left = [(homes[b], t) for b, t in zip(page["where"], page["texts"]) if not lost[b]]
    whole = sum(len(t) for _, t in left)
    for wanted in ((1,), (1, 2)):
        own = [(h, t) for h, t in left if h in wanted]
        if own and (2 * sum(len(t) for _, t in own) >= whole or 2 * len(own) > len(left)):
            left = own
            break
    return [t for _, t in left], n_templates, n_rules


_COLUMNS = {"hashes": pa.list_(pa.int64()), "parents": pa.list_(pa.int32()), "rules": pa.list_(pa.int32()), "homes": pa.list_(pa.int32()), "where": pa.list_(pa.int32()), "texts": pa.list_(pa.string()), "content": pa.int64()}


def _parsed(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    source = pages.select("html", F.struct("page_id", "url").alias("_row"), host.alias("_host"))
    kind = source.schema["_row"].dataType.simpleString()

    def parsed(batches):
        for batch in batches:
            for part in range(0, len(batch), 64):
                rows = batch.slice(part, 64)
                done = [parse(x.as_py()) for x in rows.column(0)]
                columns = [pa.array([d[name] for d in done], type_) for name, type_ in _COLUMNS.items()]
                yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), *columns], ["_row", "_host", *(f"_{n}" for n in _COLUMNS)])

    schema = (
        f"_row {kind}, _host string, _hashes array<long>, _parents array<int>, _rules array<int>, _homes array<int>,"
        " _where array<int>, _texts array<string>, _content long"
    )
    return store(source.mapInArrow(parsed, schema).withColumn("_at", F.monotonically_increasing_id()), "pages")


def templates(parsed: DataFrame, min_pages: int = MIN_PAGES, min_texts: int = MIN_TEXTS) -> DataFrame:
    """(_h host, _t subtree) that recur in enough distinct contents of the host."""
    each = parsed.select("_host", "_content", F.explode(F.array_distinct("_hashes")).alias("_hash")).where("_hash != 0")
    counted = each.distinct().groupBy("_host", "_hash").agg(F.count(F.lit(1)).alias("_n"))
    needed = F.when(F.col("_hash") % 2 == 0, min_pages).otherwise(min_texts)
    return counted.where(F.col("_n") >= needed).select(F.col("_host").alias("_h"), F.col("_hash").alias("_t"))


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_texts: int = MIN_TEXTS) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, and the subtrees removed by recurrence and by markup."""
    rows = _parsed(pages)
    each = rows.select("_at", "_host", F.explode(F.array_distinct("_hashes")).alias("_hash")).where("_hash != 0")
    common = small_side(store(templates(rows, min_pages, min_texts), "templates"), 64)
    found = each.join(common, (F.col("_host") == F.col("_h")) & (F.col("_hash") == F.col("_t")))
    gone = store(found.groupBy(F.col("_at").alias("_a")).agg(F.collect_set("_hash").alias("_gone")), "gone")
    n_gone = gone.agg(F.avg(32 + 8 * F.size("_gone"))).first()[0] or 0
    gone = small_side(gone, int(n_gone))
    parts = [f"_{n}" for n in _COLUMNS if n != "content"]
    out = rows.select("_at", "_row", *parts).join(gone, F.col("_at") == F.col("_a"), "left")
    source = out.select("_row", *parts, F.coalesce("_gone", F.array().cast("array<long>")).alias("_gone"))
    kind = source.schema["_row"].dataType.simpleString()

    def cut(batches):
        for batch in batches:
            for part in range(0, len(batch), 256):
                held = batch.slice(part, 256)
                done = []
                for *values, gone in zip(*[held.column(i).to_pylist() for i in range(1, len(parts) + 2)]):
                    blocks, n_templates, n_rules = remaining(dict(zip((p[1:] for p in parts), values)), set(gone))
                    done.append(("\n".join(blocks), n_templates, n_rules))
                texts, by_count, by_rule = zip(*done)
                yield pa.RecordBatch.from_arrays(
                    [held.column(0), pa.array(texts, pa.string()), pa.array(by_count, pa.int64()), pa.array(by_rule, pa.int64())],
                    ["_row", "text", "n_templates", "n_rules"],
                )

    done = source.mapInArrow(cut, f"_row {kind}, text string, n_templates long, n_rules long")
    return done.select("_row.page_id", "_row.url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_templates", "n_rules")
