"""Main text of web pages by consensus host paths.

1. Each page is cut into blocks of text and its containers are scored by all text below
   them, less twice the characters in links.  Menus, headers, footers, sidebars, notices,
   adverts, forms, scripts, styles and comments don't count (by tag, role, or the words
   of the class or id).  The page votes for the generalised path (tags with classes,
   digits as ``#``) of its best container: a sole ``article``, else ``main``, else the
   lowest container that holds nearly all of the page's score and its ``h1``.
2. Votes are summed per host and path in Spark; a host's paths with the most votes win.
3. Each page is extracted again with the first winning path of its host that it
   has.  A page with none of them falls back to its own best container, then to
   all that isn't boilerplate.

Blocks are runs of text between block-level tags, with character references
decoded and white space as one space; they are joined by newlines in page order.

Defined cases: null or empty html gives the empty text; so does a page with
nothing but boilerplate.  A null url counts as one host.  A name test is not used
on an element with more than ``MOST`` of the page's text.  Unclosed and stray tags
are repaired as far as needed to keep blocks apart.  Only a script or style without
an end tag takes the rest of the page; of other elements that are left out (``RAW``)
an unclosed one loses its title, text field or options, and the page goes on.  Math
and the text of objects count.  Rows that repeat vote each.
Very long pages are read whole.  An empty table gives no rows.  Columns other than
page_id, url and html are not read.
"""

from __future__ import annotations

import html as _html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inspecta.llm.base import map_rows, stored

PATHS = 3               # paths that a host keeps
HALF = 0.5              # of the page's text: an element with more, around an article, is a wrapper
NEARLY = 0.8            # of a container's score: the part below that has so much is chosen
MAX_HOSTS = 500_000     # winners are broadcast up to so many hosts, else joined by a shuffle
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?(?=[\s/]|\Z)""", re.I)
# fixed lists of html tags and of words that name parts of a page
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter nobr
output picture progress q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr
object math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle
msub msubsup msup mtable mtd mtext mtr munder munderover semantics""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg select xmp noframes annotation annotation-xml".split())
RAW_TAGS = re.compile(rf"""<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>])[^>]*(?<!/)>.*?(?:</\1|\Z)|<(/?)({"|".join(sorted(RAW, key=len, reverse=True))})(?=[\s/>])(?:(?:[^>"']|"[^"]*"|'[^']*')*+>|[^>]*>)""", re.S | re.I)
BAD_TAGS = frozenset("nav header footer aside form button menu dialog fieldset head".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu".split())
BAD_WORDS = frozenset("""ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments
consent cookie cookies copyright disqus footer form gdpr header login masthead menu menus modal nav navbar navigation newsletter
notice notices notification outbrain pager pagination popup promo promotion related replies reply respond search share sharing
sidebar signup skip social sponsor sponsored subscribe subscription taboola toolbar topbar widget alert""".split())
ALWAYS_BAD = frozenset("comment comments disqus replies reply respond".split())
# words that say nothing of a part's content, behind one that does: share-buttons, but not share-price
PLAIN_WORDS = frozenset("""area bar block body bottom box button buttons center col column container content entry form group holder
icon icons inner item items label left line link links list listing main module outer overlay page pane panel post posts right row
section site slot small sticky text thread title top unit wrap wrapper""".split())
CONTAINERS = frozenset("article body center dd div html main section table tbody td tr ul ol dl details figure".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
DIGITS = re.compile(r"\d+")


class Page:
    """Blocks of text and the block-level elements they stand in."""

    def __init__(self, text: str):
        self.tag, self.parent, self.label, self.bad = ["html"], [-1], ["html"], [0]
        self.blocks: list[tuple[int, str, int]] = []      # element, text, characters in links
        self._parse(text)
        n = len(self.tag)
        size = [0] * n
        for node, s, _ in self.blocks:
            size[node] += len(s)
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
        # what an element holds of article, main and h1 elements
        body = [t in ("article", "main", "h1") for t in self.tag]
        title = [0] * n
        for node, s, _ in self.blocks:
            if self.tag[node] == "h1":
                title[node] += len(s)
        for i in range(n - 1, 0, -1):
            body[self.parent[i]] |= body[i]
            title[self.parent[i]] += title[i]
        self.off = [False] * n
        for i in range(1, n):
            wrapper = body[i] and size[i] > HALF * size[0] or title[i] and title[i] == size[i]
            self.off[i] = self.off[self.parent[i]] or self.bad[i] == 3 or self.bad[i] > 0 and not wrapper
        # the text below each element, less what is linked; all of it in an article
        self.score = [0] * n
        inside = [False] * n
        for i in range(1, n):
            inside[i] = inside[self.parent[i]] or self.tag[i] in ("article", "main")
        for node, s, linked in self.blocks:
            if not self.off[node]:
                self.score[node] += len(s) if inside[node] else max(0, len(s) - 2 * linked)
        for i in range(n - 1, 0, -1):
            self.score[self.parent[i]] += self.score[i]

    def _parse(self, text: str) -> None:
        stack, buf, link, linked, pos, n = [0], [], False, 0, 0, len(text)
        low = ends = None
        unclosed = set()

        def flush() -> None:
            nonlocal linked
            if buf:
                s = " ".join("".join(buf).split())
                if s:
                    self.blocks.append((stack[-1], s, min(linked, len(s))))
                buf.clear()
            linked = 0

        def add(piece: str) -> None:
            nonlocal linked
            if "&" in piece:
                piece = _html.unescape(piece)
            buf.append(piece)
            if link:
                linked += len(piece.strip())
        while pos < n:
            m = TAG.search(text, pos)
            if m is None:
                add(text[pos:])
                break
            if m.start() > pos:
                add(text[pos:m.start()])
            pos = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name, closing, attrs = name.lower(), m[1] or m[4], m[3] or m[6] or ""
            if name == "a":
                link = not closing
            elif name == "br":
                buf.append(" ")
            elif name in RAW and not closing:
                if attrs.endswith("/"):
                    continue
                if name not in ("script", "style"):
                    if ends is None:
                        ends = _ends(text)
                    if m.start() in ends:
                        pos = ends[m.start()]
                        continue
                    unclosed.add(name)
                    if name in ("title", "textarea"):
                        pos = text.find("<", pos)
                        pos = n if pos < 0 else pos
                else:
                    if low is None:
                        low = text.lower()
                        if len(low) != n:          # a letter whose lower case is longer
                            low = "".join(c.lower() if c.isascii() else c for c in text)
                    end = low.find("</" + name, pos)
                    pos = n if end < 0 else end
            elif name in INLINE or name in RAW:
                continue
            elif closing:
                flush()
                link = False
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == name:
                        del stack[k:]
                        break
            else:
                flush()
                link = False
                self._close_before(stack, name)
                if name == "html":
                    continue
                self.tag.append(name)
                self.parent.append(stack[-1])
                label, bad = self._about(name, attrs)
                if name in ("option", "optgroup") and "select" in unclosed:
                    bad = 2
                self.label.append(label)
                self.bad.append(bad)
                if name not in VOID and not attrs.endswith("/"):
                    stack.append(len(self.tag) - 1)
        flush()

    def _close_before(self, stack: list[int], name: str) -> None:
        """End the elements that can't hold a new ``name``."""
        if len(stack) > 1 and self.tag[stack[-1]] == "p":
            stack.pop()
        while len(stack) > 1 and self.tag[stack[-1]] in ("option", "optgroup") and self.bad[stack[-1]] == 2:
            stack.pop()
        ends = {"li": ("ul", "ol", "menu"), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",),
                "dt": ("dl",), "dd": ("dl",), "body": ("html",)}.get(name)
        if ends:
            same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "body": ("head",)}.get(name, ("td", "th") if name != "tr" else ("tr",))
            for k in range(len(stack) - 1, 0, -1):
                if self.tag[stack[k]] in ends:
                    break
                if self.tag[stack[k]] in same:
                    del stack[k:]
                    break

    @staticmethod
    def _about(name: str, attrs: str) -> tuple[str, int]:
        """Generalised label, and 1 or 2 for boilerplate by name or tag, 3 for what always goes."""
        label, bad = name, 2 * (name in BAD_TAGS)
        if attrs.strip():
            for key, value in ATTR.findall(attrs):
                key, value = key.lower(), value.strip("\"'")
                if key == "class":
                    label += "".join("." + c for c in sorted({DIGITS.sub("#", c) for c in value.lower().split()}))
                if key in ("class", "id") and name not in ("body", "main", "article"):
                    for token in value.split():
                        words = [w.lower() for w in WORDS.findall(token) if not w.isdigit()]
                        if words and words[-1] in BAD_WORDS or words and words[0] in BAD_WORDS and all(
                                w in BAD_WORDS or w in PLAIN_WORDS for w in words):
                            bad = max(bad, 3 if any(w in ALWAYS_BAD for w in words) else 1)
                elif key == "role" and value.lower() in BAD_ROLES:
                    bad = max(bad, 2)
                elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or \
                        key == "style" and "display:none" in value.lower().replace(" ", ""):
                    bad = 3
        return label, bad

    def path(self, node: int) -> str:
        out = []
        while node > 0:
            out.append(self.label[node])
            node = self.parent[node]
        return "/".join(reversed(out))

    def _common(self, nodes: list[int]) -> int:
        """The lowest element around all of ``nodes``."""
        def line(k: int) -> list[int]:
            out = [k]
            while k > 0:
                k = self.parent[k]
                out.append(k)
            return out[::-1]
        lines = [line(k) for k in nodes]
        out = 0
        for step in zip(*lines):
            if len(set(step)) > 1:
                break
            out = step[0]
        return out

    def best(self) -> int:
        """The element that holds the main text; -1 if no text counts."""
        if not self.score[0]:
            return -1
        live = [i for i in range(len(self.tag)) if not self.off[i] and self.score[i] > 0]
        mains = [i for i in live if self.tag[i] == "main"]
        scope = mains[0] if len(mains) == 1 else 0
        within = {scope}
        tops: list[int] = []                    # articles that stand in no other
        nested = set()
        for i in live:
            if i != scope and self.parent[i] in within:
                within.add(i)
            if i in within and self.tag[i] == "article" and i not in nested and self.parent[i] not in nested:
                tops.append(i)
                nested.add(i)
            elif self.parent[i] in nested:
                nested.add(i)
        titles = [i for i in live if self.tag[i] == "h1" and i in within]
        if tops:
            got = self._common(tops) if len(tops) > 1 else tops[0]
            # a title that stands in front of the article, with nothing much beside them
            outside = [i for i in titles if i not in nested]
            if len(tops) == 1 and outside:
                both = self._common([got, outside[0]])
                if self.score[got] + self.score[outside[0]] >= NEARLY * self.score[both]:
                    got = both
            return got
        if scope:
            return scope
        got = 0
        children: dict[int, list[int]] = {}
        for i in live:
            if i:
                children.setdefault(self.parent[i], []).append(i)
        holds = {}
        for t in titles:
            k = t
            while k > 0:
                holds[k] = True
                k = self.parent[k]
        while True:
            down = [c for c in children.get(got, []) if self.tag[c] in CONTAINERS and self.score[c] >= NEARLY * self.score[got]
                    and (not titles or c in holds)]
            if not down:
                return got
            got = down[0]

    def text(self, chosen: set[int]) -> str:
        """Blocks in the ``chosen`` elements, in page order, without boilerplate."""
        inside = [False] * len(self.tag)
        inside[0] = 0 in chosen
        for i in range(1, len(inside)):
            inside[i] = inside[self.parent[i]] or i in chosen
        return "\n".join(s for node, s, _ in self.blocks if inside[node] and not self.off[node])


def _ends(text: str) -> dict[int, int]:
    """Where each closed element of ``RAW`` starts, and where its end tag does."""
    out, starts = {}, {}
    for m in RAW_TAGS.finditer(text):
        if m[3]:
            own = starts.setdefault(m[3].lower(), [])
            if not m[2]:
                if not m[0].endswith("/>"):
                    own.append(m.start())
            elif own:
                out[own.pop()] = m.start()
    return out


def votes(html: str | None) -> list[tuple[str, float]]:
    """(generalised path, 1) of a page's best container, if any text counts."""
    page = Page(html or "")
    best = page.best()
    return [] if best < 0 else [(page.path(best), 1.0)]


def main_text(html: str | None, paths: list[str] | None) -> str:
    """The page's text by the first of ``paths`` it has, or by its own best container."""
    if not html:
        return ""
    page = Page(html)
    if paths:
        at: dict[str, set[int]] = {p: set() for p in paths}
        ends = {p.rsplit("/", 1)[-1] for p in paths}
        for i, label in enumerate(page.label):
            if (label in ends or i == 0) and not page.off[i]:
                got = page.path(i)
                if got in at:
                    at[got].add(i)
        for p in paths:
            out = page.text(at[p]) if at[p] else ""
            if out:
                return out
    return page.text({max(0, page.best())})


def host_of(url: Column) -> Column:
    """Lower-case host of a url without user and port; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html", paths: int = PATHS) -> DataFrame:
    """(host, paths): the winning generalised paths of each host, most votes first."""
    def run(batch: pa.RecordBatch) -> dict:
        host, path, share = [], [], []
        for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for p, v in votes(text):
                host.append(h)
                path.append(p)
                share.append(v)
        return {"host": host, "path": path, "share": share}
    cast = map_rows(pages.select(host_of(pages[url_col]).alias("host"), pages[html_col].alias("html")), run,
                    "host string, path string, share double", max_rows=2000)
    summed = cast.groupBy("host", "path").agg(F.round(F.sum("share"), 6).alias("votes"))
    # the rank limit is applied in each task before the shuffle by host
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    won = summed.withColumn("rank", rank).where(F.col("rank") <= paths)
    return won.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x.path).alias("paths"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            max_hosts: int = MAX_HOSTS) -> DataFrame:
    """page_id, url, text and n_chars (code points) per row of ``pages``."""
    winners = stored(host_paths(pages, url_col, html_col).withColumnRenamed("host", "won_host"), "host-paths")
    if winners.count() <= max_hosts:
        winners = F.broadcast(winners)
    rows = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"), pages[html_col].alias("html"),
                        host_of(pages[url_col]).alias("host"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    both = rows.join(winners, rows.host == winners.won_host, "left").select("page_id", "url", "html", "paths")

    def run(batch: pa.RecordBatch) -> dict:
        text = [main_text(h, p) for h, p in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": text, "n_chars": [len(t) for t in text]}
    return map_rows(both, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long", max_rows=2000)
