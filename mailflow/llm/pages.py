"""Main text of web pages by template deduction over pages of one host."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from mailflow.llm.store import stored

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[a-zA-Z/!?][^<>]*(?:>|\Z)", re.S
)
NAMES = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg textarea iframe title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong"
    " sub sup time tt u var wbr".split()
)
# what an article does not consist of, by tag and by a word of class, id or role
BOILER_TAGS = frozenset("nav aside footer form button select head menu dialog".split()) | RAW
BOILER_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies disqus footer header login"
    " masthead menu nav navbar navigation newsletter notice notices pagination popup promo promoted related search share sharing"
    " sidebar signup social sponsor sponsored subscribe complementary contentinfo alert".split()
)
MAIN_TAGS = frozenset(["article", "main"])
MAIN_NAMES = frozenset("main article articlebody content entry post story".split())
CLOSED_BY_BLOCK = "p"
SAME_CLOSES = frozenset("li dt dd tr td th option p".split())


class Node:
    __slots__ = ("tag", "path", "boiler", "main")

    def __init__(self, tag: str, attributes: str, parent: Node | None):
        words: list[str] = []
        if attributes:
            for match in NAMES.finditer(attributes):
                words += re.findall(r"[a-z]+", (match[2] or match[3] or match[4] or "").lower())
        self.tag = tag
        self.path = (parent.path if parent else "") + "/" + ".".join([tag, *sorted(set(words))])
        own = tag in BOILER_TAGS or not BOILER_NAMES.isdisjoint(words) and tag not in ("body", "html")
        own = own or tag == "header"
        self.boiler = bool(parent and parent.boiler) or own
        self.main = tag in MAIN_TAGS or not MAIN_NAMES.isdisjoint(words)


def events(page: str) -> Iterator[tuple[str, object]]:
    """("open", node), ("text", (text, nodes)), ("break", None) of a page.  Tags left open
    end with what holds them; text of scripts, styles and the like is not there."""
    stack: list[Node] = []
    at, skip = 0, ""
    for match in TOKEN.finditer(page):
        if not skip and match.start() > at:
            yield "text", (page[at : match.start()], stack)
        at = match.end()
        tag = (match[2] or "").lower()
        if skip:
            if match[1] and tag == skip:
                skip = ""
            continue
        if not tag:
            continue
        if tag not in INLINE:
            yield "break", None
        elif tag == "br":
            yield "text", (" ", stack)
        if match[1]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in RAW:
            if not match[3].endswith("/"):
                skip = tag
            continue
        if tag not in INLINE and any(n.tag == CLOSED_BY_BLOCK for n in stack):
            i = max(j for j, n in enumerate(stack) if n.tag == CLOSED_BY_BLOCK)
            if all(n.tag in INLINE for n in stack[i + 1 :]):
                del stack[i:]
        if stack and tag in SAME_CLOSES and stack[-1].tag == tag:
            stack.pop()
        node = Node(tag, match[3], stack[-1] if stack else None)
        yield "open", node
        if tag not in VOID and not match[3].endswith("/"):
            stack.append(node)
    if not skip and at < len(page):
        yield "text", (page[at:], stack)


def profile(page: str) -> dict[str, list]:
    """Per path: occurrences, code points of text below it that may be article, depth, role."""
    seen: dict[str, list] = {}
    for kind, value in events(page):
        if kind == "open":
            if not value.boiler and value.tag not in INLINE:
                row = seen.setdefault(value.path, [0, 0, value.path.count("/"), 0 if value.main else 1, 0])
                row[0] += 1
        elif kind == "text":
            text, stack = value
            if stack and not stack[-1].boiler:
                size, mark = len(text.strip()), hash_text(text)
                for node in stack:
                    if node.path in seen:
                        seen[node.path][1] += size
                        seen[node.path][4] = (seen[node.path][4] * 31 + mark) % (1 << 61)
    return seen


def hash_text(text: str) -> int:
    import zlib

    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def main_path(seen: dict[str, list]) -> str:
    """The same choice as ``templates`` makes, from one page alone."""
    once = {p: r for p, r in seen.items() if r[0] == 1 and r[1] > 0}
    if not once:
        return ""
    role = min(r[3] for r in once.values())
    of_role = {p: r for p, r in once.items() if r[3] == role}
    if role:
        return max((r[1], r[2], p) for p, r in of_role.items())[2]
    most = max(r[1] for r in of_role.values())
    return max((-r[2], r[1], p) for p, r in of_role.items() if r[1] >= 0.7 * most)[2]


def extract(page: str, path: str, constant: frozenset[str] = frozenset(), once: bool = False) -> str:
    """Text blocks below ``path`` and not below one of ``constant``, each with single spaces,
    joined by a newline.  With ``once`` only of a page that has the path exactly once."""
    found = 0
    blocks: list[str] = []
    parts: list[str] = []

    def close() -> None:
        block = " ".join("".join(parts).split())
        parts.clear()
        if block:
            blocks.append(block)

    heading = re.compile(r"/header[^/]*/(?:[^/]+/)*h[1-6](?:[./]|\Z)")
    for kind, value in events(page):
        if kind == "break":
            close()
        elif kind == "open":
            found += value.path == path
        elif kind == "text":
            text, stack = value
            if not stack or not (stack[-1].path == path or stack[-1].path.startswith(path + "/")):
                continue
            if constant and any(n.path in constant for n in stack):
                continue
            last = stack[-1]
            if last.boiler:
                # headings of the article's own header belong to it
                inside = last.path[len(path) :]
                outer = [n for n in stack if len(n.path) > len(path)]
                own = [n for n in outer if n.tag in BOILER_TAGS or n.boiler and n.tag not in ("header", "h1", "h2", "h3", "h4", "h5", "h6")]
                if any(n.boiler and len(n.path) <= len(path) for n in stack) or own and not heading.search(inside) or not heading.search(inside):
                    continue
            parts.append(html.unescape(text))
    close()
    return "" if once and found != 1 else "\n".join(blocks)


def profiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, number, page in zip(batch["host"], batch["number"], batch["html"], strict=True):
            seen = profile(page)
            whole = sum(row[4] for row in seen.values() if row[2] == 1) % (1 << 61)
            rows += [(host, path, number, *row, whole) for path, row in seen.items()]
        yield pd.DataFrame(rows, columns=["host", "path", "number", "n", "chars", "depth", "role", "mark", "whole"])


def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for page, path, paths in zip(batch["html"], batch["main"], batch["constant"], strict=True):
            constant = frozenset() if paths is None else frozenset(paths)
            text = extract(page, path, constant, once=True) if path else ""
            if not text:
                own = main_path(profile(page))
                text = extract(page, own, constant) if own else ""
            out.append(text)
        yield pd.DataFrame(
            {"page_id": batch["page_id"], "url": batch["url"], "text": out, "n_chars": [len(t) for t in out]}
        ).astype({"page_id": "Int64"})


def templates(found: DataFrame) -> DataFrame:
    """(host, main, constant) from (host, path, number, n, chars, depth, role, mark, whole).

    A path's occurrence vector over the pages of its host is summed to a fingerprint; paths
    with equal vectors are an equivalence class.  Valid are the classes all of whose paths occur exactly
    once on more than half of the pages, whatever the others hold, and of these the paths whose parents
    are of a valid class; nested they are the template.  Its slots are those whose text differs between pages.
    Main is the slot with an article's name nearest the root that holds 70 % of the text of
    the widest so named.  Where none has such a name it is the widest, so all slots in page
    order, without ``constant``: the template's paths whose text is the same on all pages
    that have it, three of different text at least, so that copies of a page say nothing."""
    pages = found.groupBy("host").agg(F.count_distinct("number").alias("pages"))
    stats = found.groupBy("host", "path").agg(
        F.count_if(F.col("n") == 1).alias("once"), F.sum(F.xxhash64("number", "n").cast("decimal(38,0)")).alias("vector"),
        F.sum("chars").alias("chars"), F.max("depth").alias("depth"), F.max("role").alias("role"),
        (F.min("mark") != F.max("mark")).alias("varies"), F.approx_count_distinct("whole").alias("unlike"),
    )
    # a row a path of a host: written once, else each step below would parse all pages again
    stats = stored(stats.join(pages, "host"), "path-statistics")
    classes = stats.groupBy("host", "vector").agg(F.min("once").alias("often"), F.max("pages").alias("of"))
    valid = stats.join(classes.where("often * 2 > of").select("host", "vector"), ["host", "vector"], "left_semi")
    parent = F.regexp_replace("path", r"/[^/]*\z", "")
    known = valid.select("host", F.col("path").alias("parent")).unionByName(valid.select("host", F.lit("").alias("parent"))).distinct()
    nested = valid.withColumn("parent", parent).join(known, ["host", "parent"], "left_semi")
    slots = nested.where((F.col("varies") | (F.col("pages") == 1)) & (F.col("chars") > 0))
    least = slots.withColumn("least", F.min("role").over(Window.partitionBy("host"))).where("role = least")
    widest = least.withColumn("widest", F.max("chars").over(Window.partitionBy("host"))).where("chars >= 0.7 * widest")
    named = F.col("role") == 0
    rank = F.struct(F.when(named, -F.col("depth")).otherwise(F.col("chars")), F.when(named, F.col("chars")).otherwise(F.col("depth")), "path")
    mains = widest.groupBy("host").agg(F.max_by("path", rank).alias("main"), F.min("role").alias("role"))
    fixed = nested.where(~F.col("varies") & (F.col("unlike") >= 3) & (F.col("chars") > 0))
    fixed = fixed.groupBy("host").agg(F.collect_list("path").alias("fixed"))
    return mains.join(fixed, "host", "left").select("host", "main", F.when(F.col("role") == 1, F.col("fixed")).alias("constant"))


def main_texts(rows: DataFrame, key: str, url: str, page: str) -> DataFrame:
    """The article of each page, from whole pages.

    Pages are read twice: for statistics of their tags, and for the text.  The templates,
    a row a host, are written out first, so that Spark knows whether they are small enough
    to send; else it joins by host and splits hot hosts.

    Returns page_id, url, text, n_chars.  A null or empty page has an empty text, so has
    one without text.  Pages without a URL or host form one group; a page that lacks its
    host's slot or has it more than once is judged by itself.  Null keys and repeated rows are pages like others.
    Other columns of ``rows`` are not looked at.
    """
    host = F.lower(F.coalesce(F.try_parse_url(F.col(url), F.lit("HOST")), F.lit("")))
    given = rows.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), host.alias("host"),
        F.coalesce(F.col(page), F.lit("")).alias("html"),
    )
    numbered = given.select("host", F.xxhash64("page_id", "url", "html").alias("number"), "html")
    schema = "host string, path string, number long, n long, chars long, depth long, role long, mark long, whole long"
    known = stored(templates(numbered.mapInPandas(profiles, schema)), "templates")
    joined = given.join(known, "host", "left").select("page_id", "url", "html", F.coalesce("main", F.lit("")).alias("main"), "constant")
    return joined.mapInPandas(texts, "page_id long, url string, text string, n_chars long")
