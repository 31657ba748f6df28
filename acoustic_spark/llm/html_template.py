"""Main text of web pages by equivalence classes of template tokens.

A page's tokens are its block elements, each named by its path with class and role words, and its runs of
text words between block borders, each with the path it stands in (the words of a run stay together: one that the template
has shares its vector with all others of the run). Tokens that occur equally often in every page of a host share an
occurrence vector and form an equivalence class. Classes that enough pages have, whose elements occur once a page and lie within
elements of classes already taken, nest into the host's template: its elements are the frame, its runs are template text. The slot is the
frame element that holds the text that varies; the template text within it goes. Lists of words only decide between elements of that kind:
what is marked as an article goes first, what is marked as a menu, notice or advert goes, unless it wraps nearly all text of the host.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from acoustic_spark.llm.common import fresh, join_counted, text_or_empty, written

# Kinds of elements.
RAW = frozenset("script style noscript template iframe svg math textarea title select option object canvas video audio".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body article main section div nav header footer aside form fieldset p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption address details summary menu dialog button hr hgroup search center".split()
)
CLOSES_P = BLOCK - frozenset(["html", "head", "body", "button", "caption", "td", "th", "tr", "tbody", "thead", "tfoot"])
NOT_TEXT_TAGS = frozenset("head nav header footer aside form menu button dialog search".split())
#: A class, id or role whose head word is one of these marks what is not article text.
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements sponsor sponsored sponsors promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs header masthead footer sidebar aside rail widget notice notices alert cookie cookies consent gdpr popup modal newsletter subscribe signup login search share sharing social related recommended comment comments commentlist disqus replies reply respond pagination pager toolbar complementary contentinfo dialog".split()
)
#: Words that only say that something contains; the word before them is the head word.
CONTAINER_WORDS = frozenset("area articles bar block body box buttons container content form group holder icons inner item items links list panel posts row section slot stories text title unit wrap wrapper zone".split())
ARTICLE_WORDS = frozenset("article main content post entry story".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][A-Za-z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
NAMES = re.compile(r"""(?:^|\s)(class|id|role|itemprop|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
WORDS = re.compile(r"[A-Za-z][A-Za-z0-9]*")
RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}
#: Elements that an element of the tag ends where its own end is missing.
ENDS = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p")}
#: Share of a host's pages that a class needs to belong to the template.
SUPPORT = 0.5
#: So many elements make a class large enough for its runs to be template text.
CLASS_LEAST = 2
#: Share of a host's text that an element holds if it wraps all of it.
WRAPS = 0.9


class Name(NamedTuple):
    """What an element's tag and attributes say."""

    path: str  # its part of the path
    hard: bool  # never shown, or marked by its tag as no article text
    soft: bool  # marked so by a word
    mark: int  # 3 for an article element, 2 for main, 1 for an element named like an article, else 0


def is_aside(name: str) -> bool:
    """Whether the head word of a class, id or role is of those that are no article text: `ad-slot`, not `share-price`."""
    words = [w.lower().rstrip("0123456789") for w in WORDS.findall(name)]
    while len(words) > 1 and words[-1] in CONTAINER_WORDS:
        words.pop()
    return bool(words) and words[-1] in NOT_TEXT_WORDS


@lru_cache(4096)
def name_of(tag: str, attrs: str) -> Name:
    names: list[str] = []
    hidden = False
    for key, value in NAMES.findall(attrs) if attrs else ():
        key, value = key.lower(), value.strip("\"'")
        if key in ("hidden", "aria-hidden"):
            hidden |= key == "hidden" or value.lower() == "true"
        else:
            names += value.split()
    words = {w.lower() for n in names for w in WORDS.findall(n)}
    hard = hidden or tag in NOT_TEXT_TAGS
    soft = not hard and tag not in ("html", "body") and any(map(is_aside, names)) and not any(n.lower() in ARTICLE_WORDS for n in names)
    named = tag in ("div", "section", "td") and not ARTICLE_WORDS.isdisjoint(words)
    mark = 0 if hard or soft else 3 if tag == "article" else 2 if tag == "main" else int(named)
    return Name(".".join([tag, *sorted(words), *(["hidden"] if hidden else [])]), hard, soft, mark)


def digest(text: str, seed: int) -> int:
    """A 64-bit hash as a signed number, never 0."""
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed & 0xFFFFFFFFFFFFFFFF) or 1
    return value - (1 << 64) if value >> 63 else value


class Element:
    """A block element. `token` is a hash of its path; `all` and `own` are characters of its text without hard parts, `own` without soft ones too."""

    __slots__ = ("tag", "name", "parent", "depth", "token", "hard", "all", "own", "single")

    def __init__(self, tag: str, name: Name, parent: Element | None):
        self.tag, self.name, self.parent = tag, name, parent
        self.depth = parent.depth + 1 if parent else 0
        self.token = digest(name.path, parent.token if parent else 0)
        self.hard = name.hard or bool(parent and parent.hard)
        self.all = self.own = 0
        self.single = False


def parse(html: str) -> tuple[list[Element], list[tuple[Element | None, str]]]:
    """The page's block elements as they open, and its runs of text with the element each stands in, in page order."""
    elements: list[Element] = []
    runs: list[tuple[Element | None, str]] = []
    stack: list[Element] = []
    open_tags: Counter = Counter()
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            line = " ".join(entities.unescape("".join(pieces)).split())
            pieces.clear()
            if line:
                runs.append((stack[-1] if stack else None, line))

    def close() -> str:
        flush()
        tag = stack.pop().tag
        open_tags[tag] -= 1
        return tag

    at, end = 0, len(html)
    while at < end:
        m = TOKEN.match(html, at)
        if m is None:  # a tag that never ends: the rest is text
            pieces.append(html[at:])
            break
        at = m.end()
        if m["text"] is not None:
            pieces.append(m["text"])
            continue
        if m["tag"] is None:
            continue
        tag, attrs = m["tag"].lower(), m["attrs"]
        if m["close"]:
            if tag in BLOCK and open_tags[tag]:
                while close() != tag:
                    pass
        elif tag in RAW:
            if not attrs.endswith("/"):
                ending = RAW_END[tag].search(html, at)
                at = ending.end() if ending else end
            pieces.append(" ")
        elif tag not in BLOCK:
            if tag in VOID:
                pieces.append(" ")
        else:
            if tag in CLOSES_P or tag in ENDS:
                # Unclosed p, li and table cells end where the next one begins.
                ends = ENDS.get(tag, ("p",))
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in ends:
                        while len(stack) > i:
                            close()
                    elif stack[i].tag not in ("p", "li", "dt", "dd", "td", "th", "tr"):
                        break
            flush()
            elements.append(Element(tag, name_of(tag, attrs), stack[-1] if stack else None))
            if tag != "hr" and not attrs.endswith("/"):
                stack.append(elements[-1])
                open_tags[tag] += 1
    flush()
    return elements, runs


def letters(line: str) -> int:
    return len(line) - line.count(" ")


#: kind 0 is an element, 1 a run. `up` is the nearest element above that the page has once (0: none).
TOKENS = "kind int, token long, n int, single boolean, up long, depth int, mark int, soft boolean, chars long, own long"


def page_tokens(html: str) -> list[tuple]:
    """The tokens of a page, a row each as in TOKENS; `chars` and `own` are the text below an element, and that of a run that counts."""
    elements, runs = parse(html)
    for element, line in runs:
        if element and not element.hard:
            element.all += letters(line)
            element.own += letters(line)
    counts = Counter(e.token for e in elements)
    for e in elements:
        e.single = counts[e.token] == 1 and (e.parent is None or e.parent.single)
    for e in reversed(elements):
        if e.parent:
            e.parent.all += e.all
            e.parent.own += 0 if e.name.soft else e.own
    found = {e.token: (0, e.token, counts[e.token], e.single, e.parent.token if e.parent else 0, e.depth, e.name.mark, e.name.soft, e.all, e.own) for e in elements}
    times = Counter(digest(line, e.token if e else 0) for e, line in runs)
    above: dict[int, tuple[int, bool]] = {0: (0, True)}  # nearest single element, and whether nothing soft lies between
    for e in elements:
        up, clear = above[id(e.parent) if e.parent else 0]
        above[id(e)] = (e.token, True) if e.single else (up, clear and not e.name.soft)
    for e, line in runs:
        token = digest(line, e.token if e else 0)
        up, clear = above[id(e) if e else 0]
        own = letters(line) if clear and not (e and e.hard) else 0
        found[token] = (1, token, times[token], times[token] == 1, up, 0, 0, False, own, own)
    return list(found.values())


class Part(NamedTuple):
    """A token of a class, with its text summed over the host's pages."""

    kind: int
    token: int
    up: int
    depth: int
    mark: int
    soft: bool
    chars: int
    own: int
    varied: bool  # on pages that differ


class Template(NamedTuple):
    slot: int | None
    wrappers: list[int]  # elements marked as no article text that wrap nearly all text
    runs: list[int]  # template text


def nest(classes: Sequence[Sequence[Part]]) -> Template:
    """A host's template from its classes, those of most pages first.

    A class is valid as a whole: the elements that hold its elements are of the class or of one taken before.
    """
    frame: dict[int, Part] = {}
    runs: dict[int, Part] = {}
    for parts in classes:
        elements = {p.token: p for p in parts if p.kind == 0}
        if all(p.up == 0 or p.up in frame or p.up in elements for p in elements.values()):
            frame |= elements
            if len(elements) >= CLASS_LEAST:
                runs |= {p.token: p for p in parts if p.kind == 1 and p.varied}
    if not frame:
        return Template(None, [], [])
    ordered = sorted(frame.values(), key=lambda p: (p.depth, p.token))
    most = max(p.chars for p in ordered)
    wrappers = {p.token for p in ordered if p.soft and p.chars >= most * WRAPS}
    allowed = {0}
    for p in ordered:
        if p.up in allowed and (not p.soft or p.token in wrappers):
            allowed.add(p.token)
    fixed: Counter = Counter()
    for p in runs.values():
        fixed[p.up] += p.own
    varying = {}
    for p in reversed(ordered):
        varying[p.token] = p.own - fixed[p.token]
        if not p.soft:
            fixed[p.up] += fixed[p.token]
    if not any(varying[t] > 0 for t in allowed if t):
        varying = {t: p.own for t, p in frame.items()}
    held = [p for p in ordered if p.token in allowed and varying[p.token] > 0]
    if not held:
        return Template(None, sorted(wrappers), sorted(runs))
    whole = max(varying[p.token] for p in held)
    marked = [p for p in held if p.mark > 1 or p.mark and varying[p.token] * 2 >= whole]
    if marked:
        slot = max(marked, key=lambda p: (p.mark, -p.depth, varying[p.token], p.token))
    else:
        slot = max((p for p in held if varying[p.token] >= whole * WRAPS), key=lambda p: (p.depth, varying[p.token], p.token))
    return Template(slot.token, sorted(wrappers), sorted(runs))


def main_text(html: str, template: Template) -> str:
    """The page's text blocks in its slot, in page order, joined by a newline, without template text and parts that are no article text.

    A page without the slot gives what its own article element has, or else all its text that counts. Where half of the
    text or more would go as template text (copies of one article, say), it stays.
    """
    elements, runs = parse(html)
    wrappers, fixed = set(template.wrappers), set(template.runs)
    gone: dict[int, bool] = {}
    for e in elements:
        gone[id(e)] = e.hard or bool(e.parent and gone[id(e.parent)]) or e.name.soft and e.token not in wrappers
    shown = [(e, line) for e, line in runs if not (e and gone[id(e)])]
    slot = template.slot
    if not any(e.token == slot for e in elements):
        with_text = set()
        for e, _ in shown:
            while e and id(e) not in with_text:
                with_text.add(id(e))
                e = e.parent
        marked = [e for e in elements if e.name.mark and id(e) in with_text]
        slot = max(marked, key=lambda e: (e.name.mark, -e.depth, e.token)).token if marked else None
    if slot is not None:
        inside: dict[int, bool] = {}
        for e in elements:
            inside[id(e)] = e.token == slot or bool(e.parent and inside[id(e.parent)])
        shown = [(e, line) for e, line in shown if e and inside[id(e)]]
    varying = [line for e, line in shown if digest(line, e.token if e else 0) not in fixed]
    kept = varying if 2 * sum(map(letters, varying)) > sum(letters(line) for _, line in shown) else [line for _, line in shown]
    return "\n".join(kept)


def host_of(url: str | Column) -> Column:
    """Host of a URL, lower case without port; empty for null."""
    url = F.col(url) if isinstance(url, str) else url
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def occurrences(pages: DataFrame) -> DataFrame:
    """host, page and TOKENS for each token of each page of (host, page, html)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["host", "page", *(column.split()[0] for column in TOKENS.split(", "))]
        for batch in batches:
            rows: list[tuple] = []
            for host, page, html in zip(batch["host"], batch["page"], batch["html"]):
                rows += [(host, page, *token) for token in page_tokens(html)]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return pages.select("host", "page", "html").mapInPandas(run, f"host string, page long, {TOKENS}")


def vectors(tokens: DataFrame) -> DataFrame:
    """Each token's occurrence vector, support (pages) and text, without runs that one page alone has.

    A vector is held as two sums of hashes of (page, occurrences), so its parts are added up before the shuffle and no host
    meets in one task.
    """
    seen = F.xxhash64("page", "n")
    each = tokens.groupBy("host", "kind", "token").agg(
        F.bit_xor(seen).alias("mixed"), F.sum(seen.bitwiseAND(F.lit((1 << 30) - 1))).alias("added"), F.count(F.lit(1)).alias("support"),
        F.min("single").alias("single"), (F.min("page") != F.max("page")).alias("varied"), F.max("up").alias("up"), F.max("depth").alias("depth"),
        F.max("mark").alias("mark"), F.max("soft").alias("soft"), F.sum("chars").alias("chars"), F.sum("own").alias("own"),
    )
    return each.where("kind = 0 OR support > 1").withColumn("vector", F.struct("mixed", "added")).drop("mixed", "added")


def classes(found: DataFrame) -> DataFrame:
    """Equivalence classes of `vectors` with the host's pages in `n`: host, support, parts, for those of enough pages.

    Only tokens that no page has twice take part, so a class is no larger than a page.
    """
    valid = found.where(F.col("single") & (F.col("support") >= F.col("n") * SUPPORT))
    return valid.groupBy("host", "vector", "support").agg(F.collect_list(F.struct(*Part._fields)).alias("parts"))


def templates(tokens: DataFrame, hosts: DataFrame, total: int) -> DataFrame:
    """host, slot, wrappers, runs: the template of each host. `hosts` has host and n, its pages; `total` is the number of all pages.

    The classes of a host that half of its pages have hold no more than twice a page's tokens.
    """
    found = join_counted(written(vectors(tokens), "vectors"), hosts, "host", "n", total)
    of_host = classes(found).groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("support")).alias("order"), F.array_sort("parts").alias("parts")))).alias("classes"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, found in zip(batch["host"], batch["classes"]):
                rows.append((host, *nest([[Part(**p) for p in c["parts"]] for c in found])))
            # As objects: a column of numbers and nulls would be rounded to floats.
            yield pd.DataFrame({c: pd.Series(list(v), dtype=object) for c, v in zip(["host", *Template._fields], zip(*rows))})

    return of_host.mapInPandas(run, "host string, slot long, wrappers array<long>, runs array<long>")


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """`pages` with text (empty if none) and n_chars (its code points); all rows and columns stay.

    A null or empty html gives an empty text. Pages without a host share one template, as
    do those of a null url. Repeated rows count as pages of their host and get equal texts; text that only equal pages repeat is no
    template text. A page that lacks the slot of its host's template gives all its text that is not menu,
    notice, advert and the like. Memory is in proportion to a page, however deep its elements lie. An empty table gives an
    empty result. Columns named text and n_chars are replaced. Hosts with a thousandth of all pages or more get their template
    by broadcast, no more than a thousand of them; the pages of the others are joined by host.
    """
    host, slot, wrappers, runs, n = fresh(pages, "host", "slot", "wrappers", "runs", "n")
    keep = [c for c in pages.columns if c not in ("text", "n_chars")]
    rows = pages.select(*keep).withColumn(host, host_of(url))
    seen = rows.select(F.col(host).alias("host"), F.xxhash64(html).alias("page"), text_or_empty(html).alias("html"))
    hosts = written(seen.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "hosts")
    total = hosts.agg(F.sum("n")).first()[0] or 0
    found = hosts.join(templates(occurrences(seen.where("html <> ''")), hosts, total), "host", "left")
    found = written(found.withColumnsRenamed({"host": host, "slot": slot, "wrappers": wrappers, "runs": runs, "n": n}), "templates")

    @F.pandas_udf("string")
    def text_of(texts: pd.Series, slots: pd.Series, wrapping: pd.Series, fixed: pd.Series) -> pd.Series:
        def some(values) -> list[int]:
            return [] if values is None else list(values)

        made = [main_text(t, Template(None if pd.isna(s) else int(s), some(w), some(f))) for t, s, w, f in zip(texts, slots, wrapping, fixed)]
        return pd.Series(made, dtype=object)

    out = join_counted(rows, found, host, n, total)
    # Slots are hashes: as texts they pass pandas unrounded where some are null.
    out = out.withColumn("text", text_of(text_or_empty(html), F.col(slot).cast("string"), wrappers, runs))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*keep, "text", "n_chars")
