"""Main text of web pages by removal of site templates.

Pass 1 parses every page into its block elements, hashes each element's subtree (tags and text) and counts,
for each host, on how many different pages a subtree occurs; copies of a page count once. Pass 2 parses
again and deletes, besides elements that are boilerplate by name, subtrees that occur on at least
``MIN_PAGES`` and a ``MIN_SHARE`` of the different pages of that host, or on ``MANY_PAGES`` of a large host. A page with articles consists of these, one
with a <main> of that, any other of its body. Subtrees inside an <article> are counted apart, on how many
different articles they occur, and deleted if these are ``OWN_PAGES`` and an ``OWN_SHARE`` of the host's pages;
a page whose article would lose more than half of its text by that, a near copy of others, keeps it whole.

Only counts are shuffled, summed per task before; a hot host is spread by subtree. The deleted
hashes are broadcast if they are within BROADCAST_BYTES, and else joined to the pages' own subtrees.

Recurrence alone can't give the text where a site's menus and adverts have other words on every page, so names
and kinds of elements decide besides it.

Defined cases: null html is an empty text; a null or unreadable url is a host of its own, with all others
of the kind; repeated rows are extracted each; other columns are not read. Unclosed tags, stray end tags
and cut pages are read as far as they go. Pages are parsed whole.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, bounded_batches, saved, slices

MIN_PAGES, MIN_SHARE, MANY_PAGES, OWN_PAGES, OWN_SHARE = 3, 0.2, 100, 5, 0.5
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PARTS = re.compile(r"[a-z0-9]+")
#: HTML's element kinds, and the names that sites give to what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select option canvas audio video noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul caption".split()
)
DROPPED = frozenset("nav footer aside form head menu dialog button fieldset".split())
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice notices popup modal overlay "
    "sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs footer topbar comment comments reply replies disqus "
    "share sharing social related recommended newsletter subscribe subscription widget toolbar pagination pager search login signup contentinfo complementary".split()
)

#: Parts of longer names, names of a page's head, and words that make a name tell of a layout and not of the element.
STEMS = re.compile("comment|cookie|advert|sidebar|breadcrumb|newsletter|navbar|navigation|sponsor")
HEADS = frozenset("header masthead siteheader pageheader".split())
LAYOUT = frozenset("has with no without".split())


def names_of(attributes: str) -> set[str]:
    """Parts of an element's class, id and role; not those that follow a word of LAYOUT."""
    out: set[str] = set()
    for x in _NAMES.findall(attributes):
        for name in "".join(x).lower().split():
            parts = _PARTS.findall(name)
            out.update(p for i, p in enumerate(parts) if i == 0 or parts[i - 1] not in LAYOUT)
    return out


class Page:
    """Elements and text blocks of a page; text in boilerplate elements is left out while parsing."""

    def __init__(self, source: str | None):
        self.parent: list[int] = [-1]
        self.hash: list[int] = [0]
        self.kind: list[str] = [""]
        self.blocks: list[tuple[int, str]] = []
        self._parse(source or "")

    def _parse(self, s: str) -> None:
        # a stack entry: tag, element (-1: no element of its own), whether text in it is left out
        stack: list[tuple[str, int, bool]] = [("", 0, False)]
        inside: list[list] = [[]]
        buffer: list[str] = []
        at, main = 0, 0

        def flush() -> None:
            if buffer:
                text = " ".join("".join(buffer).split())
                buffer.clear()
                if text:
                    self.blocks.append((stack[-1][1], text))
                    inside[-1].append(text)

        def close(depth: int) -> None:
            nonlocal main
            while len(stack) > depth:
                tag, element, _ = stack[-1]
                if element != stack[-2][1]:
                    flush()
                    self.hash[element] = h = xxhash.xxh64_intdigest("\0".join([tag, *map(str, inside.pop())])) >> 1
                    inside[-1].append(h)
                    main -= self.kind[element] != ""
                stack.pop()

        end = len(s)
        while at < end:
            m = _TAG.search(s, at)
            if m is None:
                if not stack[-1][2]:
                    buffer.append(entities.unescape(s[at:]))
                break
            if m.start() > at and not stack[-1][2]:
                text = s[at : m.start()]
                buffer.append(entities.unescape(text) if "&" in text else text)
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                if tag in BLOCK or tag in ("td", "th"):
                    buffer.append(" ") if tag in ("td", "th") else flush()
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                continue
            if tag in RAW:
                if not m[3].endswith("/"):
                    after = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(s, at)
                    at = after.end() if after else end
                buffer.append(" ") if tag == "textarea" else None
                continue
            if tag in ("br", "td", "th"):
                buffer.append(" ")
            if tag in BLOCK:
                flush()
                if stack[-1][0] == "p":
                    close(len(stack) - 1)
                if tag in ("li", "tr", "dd", "dt"):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] in ("ul", "ol", "table", "tbody", "dl", "menu"):
                            break
                        if stack[k][0] == tag:
                            close(k)
                            break
            if tag in VOID or m[3].endswith("/") and tag not in BLOCK:
                continue
            names = names_of(m[3]) if m[3] else set()
            named = bool(names & NAMED) or any(map(STEMS.search, names)) or (bool(names & HEADS) and not main)
            own = tag in ("article", "main") and not any("comment" in x or x == "reply" for x in names)
            gone = not own and (stack[-1][2] or tag in DROPPED or (tag == "header" and not main) or (named and tag not in ("body", "html")))
            if tag in BLOCK:
                self.parent.append(stack[-1][1])
                self.hash.append(0)
                self.kind.append(tag if own else "")
                main += own
                inside.append([])
                stack.append((tag, len(self.parent) - 1, gone))
            else:
                stack.append((tag, stack[-1][1], gone))
        close(1)
        flush()

    def elements(self) -> tuple[set[int], set[int]]:
        """Hashes of the subtrees that can be a template: with text, in no article; and the complements of those in one, without the article's own."""
        own, filled = self._marked(("article",)), self._with_text()
        return {self.hash[e] for e in filled if not own[e]}, {~self.hash[e] for e in filled if own[e] and self.kind[e] != "article"}

    def _marked(self, kinds: tuple[str, ...]) -> list[bool]:
        """Whether each element is, or lies in, one of kinds; elements come after their parents."""
        out = [False] * len(self.parent)
        for e in range(1, len(out)):
            out[e] = out[self.parent[e]] or self.kind[e] in kinds
        return out

    def text(self, templates) -> str:
        filled = self._with_text()
        root = next((k for k in ("article", "main") if any(self.kind[e] == k for e in filled)), "")
        inside, own, gone = self._marked((root,)) if root else [True] * len(self.parent), self._marked(("article",)), [False] * len(self.parent)
        shared = [False] * len(self.parent)
        for e in range(1, len(gone)):
            gone[e] = gone[self.parent[e]] or (not own[e] and self.hash[e] in templates)
            shared[e] = shared[self.parent[e]] or (own[e] and self.kind[e] != "article" and ~self.hash[e] in templates)
        kept = [(e, text) for e, text in self.blocks if inside[e] and not gone[e]]
        rest = [text for e, text in kept if not shared[e]]
        whole = 2 * sum(map(len, rest)) < sum(len(text) for _, text in kept)
        return "\n".join(text for _, text in kept) if whole else "\n".join(rest)

    def _with_text(self) -> set[int]:
        out: set[int] = set()
        for e, _ in self.blocks:
            while e > 0 and e not in out:
                out.add(e)
                e = self.parent[e]
        return out


def host_of(url: Column) -> Column:
    """Host of a url, lower-cased, without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def _count(batches):
    """(host, hash, page) of each subtree; hash 0 counts pages, hashes below 0 are of subtrees in articles, and page tells copies apart."""
    for batch in slices(batches):
        hosts, hashes, pages = [], [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(source)
            body = xxhash.xxh64_intdigest("\n".join(t for _, t in page.blocks)) >> 1
            own = page._marked(("article",))
            article = xxhash.xxh64_intdigest("\n".join(t for e, t in page.blocks if own[e])) >> 1
            found, inner = page.elements()
            hosts += [host] * (len(found) + len(inner) + 1)
            hashes += [0, *found, *inner]
            pages += [body] * (len(found) + 1) + [article] * len(inner)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(pages, pa.int64())], ["host", "hash", "page"])


def _subtrees(batches):
    """(host, source, hash) of each subtree of pages that can be a template."""
    for batch in slices(batches):
        found = [list(set().union(*Page(x).elements())) for x in batch.column(2).to_pylist()]
        sizes = [len(x) for x in found]
        at = pa.array([i for i, n in enumerate(sizes) for _ in range(n)], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array([x for y in found for x in y], pa.int64())], ["host", "source", "hash"])


def templates(pages: DataFrame) -> DataFrame:
    """host and hash of the subtrees to delete."""
    seen = pages.select(host_of(F.col("url")).alias("host"), F.col("html").cast("string")).mapInArrow(_count, "host string, hash bigint, page bigint")
    counts = seen.distinct().groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n"))
    counts = saved(counts.where((F.col("n") >= MIN_PAGES) | (F.col("hash") == 0)), "subtrees", small=True)
    total = counts.where("hash = 0").select("host", F.col("n").alias("pages"))
    outside = (F.col("hash") > 0) & ((F.col("n") >= MIN_SHARE * F.col("pages")) | (F.col("n") >= MANY_PAGES))
    inside = (F.col("hash") < 0) & (F.col("n") >= OWN_PAGES) & (F.col("n") >= OWN_SHARE * F.col("pages"))
    return counts.where("hash <> 0").join(total, "host").where(outside | inside).select("host", "hash")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages (page_id, url, html)."""
    bounded_batches(pages.sparkSession)
    found = saved(templates(pages), "templates", small=True)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host_of(F.col("url")).alias("host"))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars bigint"
    if found.count() * 64 <= BROADCAST_BYTES:
        by_host: dict[str, set[int]] = {}
        for r in found.collect():
            by_host.setdefault(r.host, set()).add(r.hash)
        sent = pages.sparkSession.sparkContext.broadcast(by_host)
    else:  # each page's own subtrees meet the templates, so that a hot host is spread by subtree and by page
        rows, sent = rows.withColumn("source", F.md5(F.coalesce("html", F.lit("")))), None
        own = rows.select("host", "source", "html").mapInArrow(_subtrees, "host string, source string, hash bigint").distinct()
        gone = own.join(found, ["host", "hash"]).groupBy("host", "source").agg(F.collect_set("hash").alias("gone"))
        rows = rows.join(gone, ["host", "source"], "left").select("page_id", "url", "html", "host", "gone")

    def main(batches):
        for batch in slices(batches):
            gone = [sent.value.get(h, ()) for h in batch.column(3).to_pylist()] if sent else [set(x or ()) for x in batch.column(4).to_pylist()]
            texts = [Page(s).text(g) for s, g in zip(batch.column(2).to_pylist(), gone, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(main, schema)
