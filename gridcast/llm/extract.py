"""Main text of HTML pages by consensus host paths.

1. A page is read tag by tag into blocks, each under a chain of containers. A container's path is the chain of
   tags with their classes and ids, digits generalised to `#` (`body/div.post-#/article`). Parts that are never
   article text (menus, site headers, footers, sidebars, notices, adverts, forms, comments, scripts, styles) are
   recognised by tag, role or class and left out.
   A class that only sounds like such a part (`social-history`, `related-content`) takes a container out if that
   holds less than half of the page's unlinked text.
2. A page votes for the path of its best container: from the body inwards, the container that still holds SHARE of
   the unlinked text of the one around it; not into an article, nor past text that lies directly in a container.
3. Spark sums the votes per host and path. The path with most votes wins the host, and so does, for hosts with
   several templates, every path with REPEATED votes and LEAST_VOTES of the host's.
4. Pages are read again: the text is that of all blocks under the host's paths, the first of them that holds a third of
   what the page has under any of them; or, on a page that has text under none, under the page's own best container.

Defined cases. Null, empty or textless html: empty text. Null url, or one without a host: the host is empty.
Cut or badly nested pages: open elements end with their parents, or the page; a cut tag is dropped. Equal
votes: the larger summed score, then the smaller path. Repeated rows: each votes and is extracted. Empty table:
empty result. Pages of any length are read whole. Columns other than id, url and html are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gridcast.llm.tables import stage

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
_CUT = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe template svg math object select".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
                   "strike strong sub sup time tt u var".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
                     "hr main menu nav ol p pre section table ul".split())
#: An element of the first set ends an open one of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
OUTSIDE = frozenset("nav footer aside form button dialog menu".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words in classes and ids of parts that are not the article.
NOT_ARTICLE = frozenset("ad ads advert adverts advertisement adsense banner breadcrumb breadcrumbs comment comments consent cookie cookies "
                        "disqus footer gdpr login menu modal nav navbar navigation newsletter notice pager pagination popup promo promotion "
                        "recommended related reply replies respond share sharing sidebar signup social sponsor sponsored subscribe toolbar "
                        "topbar widget widgets".split())
#: Of these words, those that stories have in their class names too.
SOFT = frozenset("ad banner notice promo promotion recommended related share sharing social sponsor sponsored widget widgets".split())
#: Share of the text around it that a container needs to stand for it.
SHARE = 0.7
#: Votes, and share of the host's votes, of a host's further paths.
REPEATED, LEAST_VOTES = 2, 0.05
CONTAINERS = frozenset("article body center content dd div main section table tbody td th tr".split())


class _Page:
    """The blocks of a page: text, unlinked characters, and the container each lies in."""

    def __init__(self, text: str) -> None:
        self.blocks: list[tuple[str, int, int]] = []
        self.paths, self.parents = ["body"], [-1]
        self._stack: list[tuple[str, int, bool]] = []  # tag, container, left out
        self._text: list[str] = []
        self._linked, self._in_link, self._here, self._out = 0, False, 0, False
        self._soft: list[int] = []
        self._read(text)
        total = self._totals()
        gone = [total[c] < total[0] / 2 if c in self._soft else False for c in range(len(self.paths))]
        for c, parent in enumerate(self.parents):  # parents come first
            gone[c] = gone[c] or parent >= 0 and gone[parent]
        self.blocks = [b for b in self.blocks if not gone[b[2]]]

    def _totals(self) -> list[int]:
        """Unlinked characters in each container and all inside it."""
        total = [0] * len(self.paths)
        for _, size, container in self.blocks:
            total[container] += size
        for c in range(len(total) - 1, 0, -1):
            total[self.parents[c]] += total[c]
        return total

    def _end_block(self) -> None:
        if self._text:
            line = " ".join(entities.unescape("".join(self._text)).split())
            if line:
                self.blocks.append((line, max(0, len(line) - self._linked), self._here))
            self._text, self._linked = [], 0
        self._in_link = False

    def _pop(self, to: int) -> None:
        del self._stack[to:]
        _, self._here, self._out = self._stack[-1] if self._stack else ("", 0, False)

    def _close(self, tag: str) -> None:
        for at in range(len(self._stack) - 1, -1, -1):
            if self._stack[at][0] == tag:
                self._pop(at)
                return

    def _open(self, tag: str, attributes: str) -> None:
        if tag in CLOSES_P:
            for at in range(len(self._stack) - 1, -1, -1):
                if self._stack[at][0] == "p":
                    self._pop(at)
                    break
                if self._stack[at][0] not in INLINE:
                    break
        if tag in ENDS:
            for at in range(len(self._stack) - 1, -1, -1):
                if self._stack[at][0] in ENDS[tag]:
                    self._pop(at)
                    break
                if self._stack[at][0] in ("ul", "ol", "dl", "table"):
                    break
        found = {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
        here = self._here
        names = [found[k] for k in ("class", "id") if found.get(k)]
        out = self._left_out(tag, found, names)
        if tag in CONTAINERS and tag != "body":
            label = ".".join([tag, *sorted(re.sub(r"\d+", "#", n) for n in " ".join(names).split())])
            self.paths.append(f"{self.paths[here]}/{label}")
            self.parents.append(here)
            here = len(self.paths) - 1
            if out == "soft":
                self._soft.append(here)
                out = False
        self._stack.append((tag, here, self._out or bool(out)))
        _, self._here, self._out = self._stack[-1]

    def _left_out(self, tag: str, found: dict[str, str], names: list[str]) -> bool | str:
        if tag in OUTSIDE or tag == "header" and not any(t in ("article", "main") for t, _, _ in self._stack):
            return True
        if "hidden" in found or found.get("aria-hidden") == "true" or found.get("role", "").lower() in ROLES or \
                re.search(r"display\s*:\s*none", found.get("style", "")):
            return True
        if tag in ("html", "body", "article", "main"):
            return False
        kinds: set[bool] = set()
        for name in " ".join(names).split():
            parts = [p.lower() for p in _WORDS.findall(name)]
            if (words := NOT_ARTICLE.intersection(parts)) and parts[0] not in ("has", "with", "no", "without"):
                kinds.add(words <= SOFT and len(parts) > 1)
            elif "header" in parts and not any(t in ("article", "main") for t, _, _ in self._stack):
                return True
        return "soft" if kinds == {True} else bool(kinds)

    def _read(self, text: str) -> None:
        at = 0
        while True:
            m = _TAG.search(text, at)
            plain = text[at:m.start()] if m else _CUT.sub("", text[at:])
            if plain and not self._out:
                self._text.append(plain)
                if self._in_link:
                    self._linked += len(plain)
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if tag == "a":
                self._in_link = not m[1]
            inline = tag in INLINE
            if not inline:
                self._end_block()
            if m[1]:
                self._close(tag)
            elif tag in RAW:
                if not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(text, at)
                    at = end.end() if end else len(text)
            elif tag not in VOID and (not inline or m[3].strip()):
                # Inline elements count only if they can be left out.
                if not inline or self._left_out(tag, {k.lower(): (v or "").strip("\"'") for k, v in _ATTRIBUTE.findall(m[3])}, []) or "class" in m[3]:
                    self._open(tag, m[3])
        self._end_block()

    def best(self) -> tuple[int, float]:
        """The container that holds the article, and its unlinked text; -1 without text."""
        if not self.blocks:
            return -1, 0.0
        total, children, own = self._totals(), defaultdict(list), defaultdict(int)
        for c, parent in enumerate(self.parents):
            children[parent].append(c)
        for _, size, c in self.blocks:
            own[c] += size

        def is_(c: int, *tags: str) -> bool:
            return self.paths[c].rsplit("/", 1)[-1].split(".")[0] in tags

        at = 0
        while not is_(at, "article") and children[at]:
            # article and main are what their names say.
            next_ = max(children[at], key=lambda c: (total[c] * (2 if is_(c, "article", "main") else 1), -c))
            if total[next_] < SHARE * total[at] and not is_(next_, "article", "main") or total[next_] * 2 < total[at] or \
                    at and own[at] or is_(at, "main") and not is_(next_, "article"):
                break
            at = next_
        return at, float(total[at])

    def text(self, paths: list[str]) -> str:
        """The text under the first of the paths that holds a third of what any of them does, else under the best container."""
        total = self._totals()
        held = {path: sum(n for n, p in zip(total, self.paths) if p == path) for path in paths}
        path = next((p for p in paths if held[p] and held[p] * 3 >= max(held.values())), None)
        inside = [p == path for p in self.paths]
        if path is None:
            at = self.best()[0]
            inside = [c == at for c in range(len(self.paths))]
        for c, parent in enumerate(self.parents):  # parents come first
            inside[c] = inside[c] or parent >= 0 and inside[parent]
        return " ".join(line for line, _, c in self.blocks if inside[c])


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        votes: dict[tuple[str, str], list[float]] = defaultdict(lambda: [0, 0.0])
        for name, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            page = _Page(text or "")
            at, score = page.best()
            if at >= 0:
                entry = votes[name, page.paths[at]]
                entry[0] += 1
                entry[1] += score
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in votes], pa.string()), pa.array([k[1] for k in votes], pa.string()),
             pa.array([int(v[0]) for v in votes.values()], pa.int64()), pa.array([v[1] for v in votes.values()], pa.float64())],
            names=["host", "path", "votes", "score"])


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [_Page(text or "").text(paths or []) for text, paths in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), b.column(3)],
                                         names=["id", "url", "text", "paths"])


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns host and paths: the container paths that the host's pages vote for, most votes first (at most 1 / LEAST_VOTES)."""
    votes = pages.select(host(pages[url_col]).alias("host"), pages[html_col].alias("html")).mapInArrow(
        _votes, "host string, path string, votes long, score double")
    sums = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))
    best = F.struct(-F.col("votes"), -F.round("score"), F.col("path"))
    whole = Window.partitionBy("host")
    ranked = sums.select("host", "path", "votes", best.alias("place"), F.sum("votes").over(whole).alias("all"), F.min(best).over(whole).alias("first"))
    won = ranked.where((F.col("place") == F.col("first")) | (F.col("votes") >= REPEATED) & (F.col("votes") >= LEAST_VOTES * F.col("all")))
    return won.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "path")))["path"].alias("paths"))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns id, url, text and paths (the host's)."""
    winners = stage(host_paths(pages, url_col, html_col), "host-paths")
    plain = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"),
                         host(pages[url_col]).alias("host"))
    kind = plain.schema["id"].dataType.simpleString()
    return (plain.join(winners, "host", "left").select("id", "url", "html", "paths")
            .mapInArrow(_texts, f"id {kind}, url string, text string, paths array<string>"))
