"""Main text of web pages by deducing each host's template.

A page is a sequence of element paths (structural elements with their classes)
and of blocks of text under them.  A path's occurrence vector is how often each
page of the host has it; paths of one vector form an equivalence class.  Spark
compares vectors by a checksum of (page, count), which partial aggregates
combine, so a host's pages never meet in one task.  Classes that are frequent
are the template; nested by path they form a tree whose inner elements are the
slots.  From the page's root the tree is followed to the slot that holds most
of the text that differs from page to page: the article.  What is fixed within
it, or marked as a menu, form, advert and the like, is left out; a mark on an
element that holds nearly all text, or on one around the slot, does not count.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.store import materialise

#: A class belongs to the template if at least this share of the host's pages has it.
FREQUENT = 0.5
#: Paths rarer than this on a host are not looked at when its template is deduced.
RARE = 0.02
#: A slot is entered if it holds this share of the text around it.
HOLDS = 0.6
#: An element with this share of the text is no menu, form or the like, whatever its name.
WHOLE = 0.8
#: Pages that must agree before a text counts as fixed.
FIXED_PAGES = 4
#: Levels of nesting that paths tell apart; deeper elements belong to their holder's path.
DEPTH = 64
#: Bytes of templates that are sent to every task; beyond, pages are joined to them by host.
SMALL = 32 << 20
SALTS = 64

# HTML element names.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = "script|style|noscript|template|iframe|svg|math|object|canvas|textarea|title|select"
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dd dt td th figcaption".split())
ITEMS = frozenset("li dt dd tr td th option".split())
HOLDERS = frozenset("ul ol dl table".split())
OUTSIDE = frozenset("nav footer aside form menu dialog button fieldset head".split())
# Words in class or id that mark what is not the article.
MARKS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus footer "
    "header masthead menu modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related "
    "respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/a-zA-Z][^>]*(?:>|\Z)|([^<]+|<)",
    re.S | re.I,
)
_CLASS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_DIGITS = re.compile(r"\d{3,}")
_WORDS = re.compile(r"[a-z]+")


def _element(tag: str, attributes: str) -> str:
    """The element's name in paths: tag, then classes and ids with long numbers folded."""
    if not attributes or "=" not in attributes:
        return tag
    names = " ".join(x for m in _CLASS.findall(attributes) for x in m if x).lower()
    names = sorted(set(_DIGITS.sub("0", names).replace("/", "_").split()))
    return ".".join([tag, *names])


def blocks(page: str) -> Iterator[tuple[str, str | None, int]]:
    """(path, text, characters within links) of each block, and (path, None, 0) for each element opened."""
    stack: list[tuple[str, str]] = []  # tag, path
    opened: Counter[str] = Counter()
    text: list[str] = []
    linked = links = 0

    def path() -> str:
        return stack[-1][1] if stack else ""

    def flush() -> tuple[str, str, int] | None:
        nonlocal linked
        if not text:
            return None
        whole = " ".join(entities.unescape("".join(text)).split())
        text.clear()
        size, linked = linked, 0
        return (path(), whole, size) if whole else None

    def pop(tag: str) -> None:
        while opened[tag]:
            last, _ = stack.pop()
            opened[last] -= 1
            if last == tag:
                return

    for m in _TOKEN.finditer(page):
        if m.group(5) is not None:
            text.append(m.group(5))
            if links:
                linked += len(m.group(5))
            continue
        tag = m.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in VOID:
            text.append(" ")
            continue
        inline = tag in INLINE
        if not inline and (found := flush()):
            yield found
        if m.group(2):
            if tag == "a":
                links = max(0, links - 1)
            pop(tag)
            continue
        if not inline:
            # what an opening tag ends without saying so
            pop("p")
            if tag in ITEMS and opened[tag]:
                nearest = next(t for t, _ in reversed(stack) if t == tag or t in HOLDERS)
                if nearest == tag:
                    pop(tag)
            if tag == "body":
                pop("head")
        elif tag == "a":
            links += 1
        if m.group(4).endswith("/"):
            continue
        holder = path()
        if not inline and holder.count("/") < DEPTH:
            holder = f"{holder}/{_element(tag, m.group(4))}" if holder else _element(tag, m.group(4))
        stack.append((tag, holder))
        opened[tag] += 1
        if not inline:
            yield path(), None, 0
    if found := flush():
        yield found


def outside(path: str, around: str = "") -> bool:
    """Whether a path is marked as something other than the article; marks on ``around`` and what holds it do not count."""
    article = False
    inner = not around
    upto = around.split("/")
    for k, name in enumerate(path.split("/")):
        tag, *marks = name.split(".")
        if not inner and (k >= len(upto) or name != upto[k]):
            inner = True
        if inner and (tag in OUTSIDE or (tag == "header" and not article)):
            return True
        if tag in ("article", "main"):
            article = True
        elif inner and tag not in ("html", "body"):
            words = {w for mark in marks for w in _WORDS.findall(mark)} & MARKS
            if words - {"header"} or (words and tag != "header"):  # a header in an article may be called one
                return True
    return False


def holder_of(chars: dict[str, int]) -> str:
    """The innermost element that holds at least ``WHOLE`` of the text; chars: characters of each path's own blocks."""
    held: dict[str, int] = {}
    for path, n in chars.items():
        name = path
        while name:
            held[name] = held.get(name, 0) + n
            name = name.rpartition("/")[0]
    least = WHOLE * sum(chars.values())
    return max((p for p, n in held.items() if n and n >= least), key=lambda p: (p.count("/"), held[p], p), default="")


def _stat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and path, of the batch's pages: what the template is deduced from."""
    for batch in batches:
        stats: dict[tuple[str, str], list[int]] = {}
        for host, key, html in zip(
            batch.column("host").to_pylist(), batch.column("page_key").to_pylist(), batch.column("html"), strict=True
        ):
            own: dict[str, list] = {}
            for path, text, _ in blocks(html.as_py() or ""):
                x = own.setdefault(path, [0, 0, []])
                if text is None:
                    x[0] += 1
                else:
                    x[1] += len(text)
                    x[2].append(text)
            own.setdefault("", [1, 0, []])  # the page itself
            for path, (count, chars, texts) in own.items():
                mark = xxhash.xxh64_intdigest(f"{key}:{count}") - (1 << 63)
                same = xxhash.xxh64_intdigest("\n".join(texts)) - (1 << 63)
                if (s := stats.get((host, path))) is None:
                    stats[host, path] = [1, count, mark, chars, same, same]
                else:
                    s[0] += 1
                    s[1] += count
                    s[2] ^= mark
                    s[3] += chars
                    s[4], s[5] = min(s[4], same), max(s[5], same)
        hosts, paths = zip(*stats, strict=True) if stats else ((), ())
        columns = list(zip(*stats.values(), strict=True)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
            ["host", "path", "pages", "occurrences", "vector", "chars", "same_low", "same_high"],
        )


def deduce_template(stats: pd.DataFrame) -> tuple[str, list[str]]:
    """(path of the article's slot, paths fixed within it) from one host's path statistics."""
    pages = int(stats["pages"].max())
    rows = {r.path: r for r in stats.itertuples(index=False)}
    # equivalence classes: paths of one occurrence vector
    classes: dict[tuple[int, int, int], list[str]] = {}
    for r in rows.values():
        classes.setdefault((r.vector, r.pages, r.occurrences), []).append(r.path)
    fixed = {
        r.path for r in rows.values() if r.pages >= max(FIXED_PAGES, FREQUENT * pages) and r.same_low == r.same_high and r.occurrences == r.pages
    }
    around = holder_of({r.path: r.chars for r in rows.values() if r.path and r.path not in fixed})
    template = {
        path
        for (_, seen, occurrences), paths in classes.items()
        if seen >= FREQUENT * pages and occurrences == seen  # once on each page that has it
        for path in paths
        if path and not outside(path, around) and path.rpartition("/")[2].split(".")[0] not in PARAGRAPHS
    }
    varying: dict[str, int] = {}
    for r in rows.values():
        if r.path and r.path not in fixed and not outside(r.path, around):
            name = r.path
            while name:
                varying[name] = varying.get(name, 0) + r.chars
                name = name.rpartition("/")[0]
    # nest the template's elements by path and follow the slot that holds most varying text
    inner: dict[str, list[str]] = {}
    for path in sorted(template, key=lambda p: p.count("/")):
        holder = path.rpartition("/")[0]
        while holder and holder not in template:
            holder = holder.rpartition("/")[0]
        inner.setdefault(holder, []).append(path)
    at = ""
    total = sum(n for p, n in varying.items() if "/" not in p)
    while True:
        whole = varying.get(at, total)
        best = max(inner.get(at, []), key=lambda p: (varying.get(p, 0), p), default=None)
        if best is None or varying.get(best, 0) < HOLDS * whole or not varying.get(best):
            break
        at = best
    kept = [
        p for p in fixed if p.startswith(f"{at}/") and p.rpartition("/")[2].split(".")[0] not in PARAGRAPHS and rows[p].chars
    ]
    return at, sorted(kept) if varying.get(at) else []


def _deduce(pdf: pd.DataFrame) -> pd.DataFrame:
    slot, fixed = deduce_template(pdf)
    return pd.DataFrame({"template_host": [pdf["host"].iloc[0]], "slot": [slot], "fixed": [fixed]})


def main_text(page: str, slot: str, fixed: list[str]) -> str:
    """Blocks of the slot, joined by empty lines; pages without the slot give what is not marked otherwise."""
    every = [(path, text) for path, text, _ in blocks(page) if text is not None]
    within = [(p, t) for p, t in every if (p == slot or p.startswith(f"{slot}/")) and not outside(p, slot)] if slot else []
    if not within:  # no slot, or another layout
        chars: Counter[str] = Counter()
        for p, t in every:
            chars[p] += len(t)
        found = [(p, t) for p, t in every if not outside(p)]
        if sum(len(t) for _, t in found) < (1.0 - WHOLE) * sum(chars.values()):  # marks on what holds the page's text
            around = holder_of(chars)
            found = [(p, t) for p, t in every if not outside(p, around)]
        within = ([(p, t) for p, t in found if re.search(r"(?:^|/)(?:article|main)(?:[./]|$)", p)] if slot else []) or found
    dropped = tuple(fixed)
    return "\n\n".join(t for p, t in within if not any(p == d or p.startswith(f"{d}/") for d in dropped))


def _text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fixed = batch.column("fixed").to_pylist()
        texts = [
            main_text(html.as_py() or "", slot or "", own or [])
            for html, slot, own in zip(batch.column("html"), batch.column("slot").to_pylist(), fixed, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, without user and port; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def host_templates(pages: DataFrame) -> DataFrame:
    """(template_host, slot, fixed): one row a host of ``pages`` (url, html)."""
    keyed = pages.select(host_of(F.col("url")).alias("host"), F.xxhash64("page_id", "url", "html").alias("page_key"), "html")
    stats = (
        keyed.mapInArrow(
            _stat_rows, "host string, path string, pages long, occurrences long, vector long, chars long, same_low long, same_high long"
        )
        .groupBy("host", "path")
        .agg(
            F.sum("pages").alias("pages"),
            F.sum("occurrences").alias("occurrences"),
            F.bit_xor("vector").alias("vector"),
            F.sum("chars").alias("chars"),
            F.min("same_low").alias("same_low"),
            F.max("same_high").alias("same_high"),
        )
    )
    stats = materialise(stats, "template-stats")
    hosts = stats.where("path = ''").select("host", F.col("pages").alias("host_pages"))
    # at most 50 times the paths of an average page are left of a host
    frequent = stats.join(hosts, "host").where(F.col("pages") >= F.col("host_pages") * RARE).drop("host_pages")
    return frequent.groupBy("host").applyInPandas(_deduce, "template_host string, slot string, fixed array<string>")


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null html: an empty text.  Null or unreadable url: a host of its own (the
    empty name).  Repeated rows count as pages each and give the same text.  A
    host of few pages is deduced from those.  Empty table: empty result.  Extra
    columns are not looked at.
    """
    templates = materialise(host_templates(pages), "templates")
    own = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    size = templates.agg(F.sum(F.length("slot") + F.length(F.concat_ws("", "fixed")) + F.length("template_host") + 64)).first()[0] or 0
    if size <= SMALL:
        joined = own.join(F.broadcast(templates), F.col("host") == F.col("template_host"), "left")
    else:  # a hot host's pages spread over salted copies of its template
        copies = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = own.withColumn("own_salt", F.pmod(F.xxhash64("page_id", "html"), F.lit(SALTS)).cast("int"))
        joined = salted.join(copies, (F.col("host") == F.col("template_host")) & (F.col("own_salt") == F.col("salt")), "left")
    return joined.select("page_id", "url", "html", "slot", "fixed").mapInArrow(
        _text_rows, "page_id long, url string, text string, n_chars long"
    )
