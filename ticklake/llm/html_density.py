"""Main text of web pages by composite text density (operator 6).

Per page a small DOM is built from the whole html. Every block node gets a
composite text density: characters per tag, adjusted by the characters and
tags inside links (after Sun, Song and Liao, SIGIR 2011). A node's density sum
adds up the densities of its children; the node with the largest density sum
is the core. The article or main around the core belongs to the text as a whole.
Outside it, a subtree that hangs off the path from body to the core does, if its
density reaches the smallest one on the path or it is an article itself; on a
page without article or main around the core, every such subtree whose text is
not mostly links. Text that stands directly in the path belongs to it, too.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are cut from the tree before it is measured, by element and by
the words of class, id and role. Words do not cut what wraps the page's text:
main, or a block outside of which there are next to no paragraphs. Text of an
unclosed tag or comment at the end of a page is markup, as in browsers.

A plain map over whole pages: no shuffle, nothing kept between rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticklake.llm.common import map_rows

# Element names and attribute words.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CUT = frozenset("""
    head title script style noscript template iframe object svg math canvas audio video nav footer aside form
    button select textarea dialog menu
""".split())
BLOCK = frozenset("""
    html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption
    blockquote pre figure figcaption address header footer nav aside form fieldset details summary hr center
""".split())
CUT_WORDS = frozenset("""
    ad ads adbox adslot advert adverts advertisement advertising sponsor sponsored promo promotion banner masthead
    nav navbar navigation menu menubar breadcrumb breadcrumbs header topbar footer sidebar sidenav rail aside
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup
    login share sharing social related recommended recommendations widget widgets toolbar pagination pager search
    complementary contentinfo skip
""".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
ELSEWHERE_WORDS = frozenset("""
    ad ads advert adverts advertisement advertising sponsor sponsored promo promotion related recommended recommendations
""".split())
PARAGRAPH = frozenset("p li dd td blockquote pre".split())
COMMENTS = 2
NEVER_CUT = frozenset(("html", "body", "main", "article"))
UNNAMED = frozenset(("html", "body", "main"))
# An open element that a new one of the listed kind ends.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
_SPLIT = re.compile(r"[^a-z0-9]+")
_EMPTY_COMMENT, _COMMENT_END = re.compile("<!---?>"), re.compile("--!?>")


class _Dom(HTMLParser):
    """Block nodes in page order: parent, and a stream of (node, text, in link)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tag, self.parent, self.cut = ["#root"], [-1], [False]
        self.named = [0]  # to be cut by its words, unless it wraps the text
        self.last_end: int | None = None  # the last > of the page
        self.inline = [False]
        self.tags, self.link_tags = [0], [0]  # of the node itself, inline ones included
        self.text: list[tuple[int, str, bool]] = []
        self.open: list[tuple[str, int, bool]] = [("#root", 0, False)]  # element, its block node, inline and cut
        self.opened: Counter[str] = Counter()
        self.inline_cut = 0

    def _pop(self, to: int) -> None:
        for tag, _, bad in self.open[to:]:
            self.opened[tag] -= 1
            self.inline_cut -= bad
        del self.open[to:]

    def _end(self, tag: str) -> None:
        """Close the innermost open ``tag`` and what it holds."""
        self._pop(next(k for k in range(len(self.open) - 1, 0, -1) if self.open[k][0] == tag))

    def _end_siblings(self, tag: str) -> None:
        """Elements that a new ``tag`` ends, up to the list or table around it."""
        k = len(self.open) - 1
        while k > 0 and self.open[k][0] not in FENCE[tag]:
            if self.open[k][0] in ENDS[tag]:
                self._pop(k)
            k -= 1

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK and self.opened["head"] and tag != "html":
            self._end("head")
        if tag in BLOCK and self.opened["p"]:
            self._end("p")
        if tag in ENDS:
            self._end_siblings(tag)
        if tag == "a" and self.opened["a"]:
            self._end("a")
        top = self.open[-1][1]
        if tag in VOID:
            self.tags[top] += 1
            # a line break is white space, a rule ends the block
            self.text.append((0, "", False) if tag == "hr" else (top, " " if tag == "br" else "", False))
            return
        bad = self._is_cut(tag, attrs)
        named = 0 if bad or tag in UNNAMED else self._is_named(tag, attrs)
        node = top
        if tag in BLOCK or tag in CUT or named:
            node = len(self.tag)
            self.tag.append(tag)
            self.parent.append(top)
            self.cut.append(bad or self.cut[top] or self.inline_cut > 0)
            self.named.append(named)
            self.inline.append(tag not in BLOCK and tag not in CUT)
            self.tags.append(1)
            self.link_tags.append(tag == "a")
            self.text.append((node, "", False))
            bad = False
        else:
            self.tags[top] += 1
            self.link_tags[top] += tag == "a"
            self.inline_cut += bad
        self.opened[tag] += 1
        self.open.append((tag, node, bad))

    def _is_cut(self, tag, attrs) -> bool:
        if tag in NEVER_CUT:
            return False
        if tag in CUT or (tag == "header" and not self.opened["article"] and not self.opened["main"]):
            return True
        for name, value in attrs:
            value = (value or "").lower()
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and "display:none" in value.replace(" ", ""):
                return True
        return False

    def _is_named(self, tag, attrs) -> int:
        """COMMENTS, 1 for other words that cut, else 0; of an article, comments and
        what points elsewhere only."""
        words = {w for name, value in attrs if name in ("class", "id", "role") for w in _SPLIT.split((value or "").lower())}
        if not words.isdisjoint(COMMENT_WORDS):
            return COMMENTS
        return int(not words.isdisjoint(ELSEWHERE_WORDS if tag == "article" else CUT_WORDS))

    def cut_named(self) -> None:
        """Cut the subtrees named by class, id or role that do not wrap the text.

        A named block stays only if the paragraphs outside all named blocks are
        few against it: under a quarter for a block around an article, a
        twentieth for one with most of the page, none for reader comments. A
        block around main always stays. What stays counts as outside for the
        named blocks in it.
        """
        n = len(self.tag)
        chars, blocks, free, main, article, para = [0] * n, [0] * n, [0] * n, [False] * n, [False] * n, [False] * n
        for i in range(1, n):
            para[i] = self.tag[i] in PARAGRAPH or para[self.parent[i]]
        for node, text, in_link in self.text:
            k = len("".join(text.split()))
            chars[node] += k
            free[node] += k * (para[node] and not in_link)
        for i in range(n - 1, 0, -1):
            if self.cut[i] or not chars[i]:
                continue
            p, tag, named = self.parent[i], self.tag[i], self.named[i]
            chars[p] += chars[i]
            blocks[p] += 1
            main[p] |= main[i] or tag == "main"
            article[p] |= named != COMMENTS and (article[i] or tag == "article" and not named)
            free[p] += 0 if named else free[i]
        body = chars[next((i for i in range(n) if self.tag[i] == "body"), 0)] or chars[0]
        outside = [free[0]] * n
        for i in range(1, n):
            p = self.parent[i]
            rest = outside[i] = outside[p]
            if self.named[i] and not self.cut[i] and not self.cut[p]:
                most = 2 * chars[i] > body and blocks[i] > 0
                if self.named[i] == COMMENTS:
                    wraps = main[i] or not rest and (article[i] or most)
                else:
                    wraps = main[i] or article[i] and 4 * rest < chars[i] or most and 20 * rest < chars[i]
                self.cut[i] = not wraps
                outside[i] = rest + free[i]
            self.cut[i] = self.cut[i] or self.cut[p]
        off = [False] * n  # cut inside a line: does not end the block around it
        for i in range(1, n):
            off[i] = off[self.parent[i]] or self.cut[i] and self.inline[i]
        self.text = [t for t in self.text if not off[t[0]] and (not self.cut[t[0]] or not t[1])]

    # Tags, comments and declarations that nothing ends run to the end of the
    # page, as in browsers; looking for their end once keeps parsing linear.

    def _unended(self, i: int) -> bool:
        if self.last_end is None:
            self.last_end = self.rawdata.rfind(">")
        return i > self.last_end

    def parse_starttag(self, i):
        return len(self.rawdata) if self._unended(i) else super().parse_starttag(i)

    def parse_endtag(self, i):
        return len(self.rawdata) if self._unended(i) else super().parse_endtag(i)

    def parse_comment(self, i, report=1):
        if m := _EMPTY_COMMENT.match(self.rawdata, i) or _COMMENT_END.search(self.rawdata, i + 4):
            return m.end()
        return len(self.rawdata)

    def parse_pi(self, i):
        end = self.rawdata.find(">", i + 2)
        return len(self.rawdata) if end < 0 else end + 1

    def parse_html_declaration(self, i):
        return self.parse_comment(i) if self.rawdata.startswith("<!--", i) else self.parse_pi(i)

    def handle_endtag(self, tag):
        if not self.opened[tag] or tag in ("body", "html"):
            return
        inline = tag not in BLOCK and tag not in CUT
        for k in range(len(self.open) - 1, 0, -1):
            name = self.open[k][0]
            if name == tag:
                self._pop(k)
                return
            if inline and (name in BLOCK or name in CUT):
                return  # an inline end tag does not close the blocks around it

    def handle_data(self, data):
        top = self.open[-1][1]
        if self.inline_cut == 0 and not self.cut[top]:
            self.text.append((top, data, self.opened["a"] > 0))


def _density(chars: int, tags: int, link_chars: int, link_tags: int, body_ratio: float) -> float:
    """Composite text density; body_ratio: link characters per character of body."""
    if not chars:
        return 0.0
    tags, link_tags = max(tags, 1), max(link_tags, 1)
    linked = max(chars / max(link_chars, 1) * tags / link_tags, 1.0)
    base = math.log(chars / max(chars - link_chars, 1) * link_chars + body_ratio * chars + math.e)
    return chars / tags * math.log(linked) / max(math.log(base), 1.0)


def main_text(html: str | None) -> str:
    """Blocks of the main text joined by ``\\n``; empty without any text."""
    if not html:
        return ""
    dom = _Dom()
    dom.feed(html)
    dom.close()
    dom.cut_named()
    n = len(dom.tag)
    own = [0] * n
    link = [0] * n
    for node, text, in_link in dom.text:
        k = len("".join(text.split()))
        own[node] += k
        link[node] += k * in_link
    chars, links = own[:], link[:]
    tags, link_tags = dom.tags[:], dom.link_tags[:]
    kids: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):  # children come after their parents
        if not dom.cut[i]:
            p = dom.parent[i]
            chars[p] += chars[i]
            links[p] += links[i]
            tags[p] += tags[i]
            link_tags[p] += link_tags[i]
            kids[p].append(i)
    body = next((i for i in range(n) if dom.tag[i] == "body"), 0)
    if not chars[body]:
        body = 0
    ratio = links[body] / max(chars[body], 1)
    density = [_density(chars[i], tags[i], links[i], link_tags[i], ratio) for i in range(n)]
    total = [sum(density[k] for k in kids[i]) for i in range(n)]
    live = [False] * n
    live[body] = True
    core = body
    for i in range(body + 1, n):
        live[i] = not dom.cut[i] and live[dom.parent[i]]
        if live[i] and total[i] > total[core]:
            core = i
    path = [core]
    while path[-1] != body:
        path.append(dom.parent[path[-1]])
    least = min(density[i] for i in path)
    holder = next((i for i in reversed(path) if dom.tag[i] in ("main", "article")), None)  # the outermost one
    top = core if holder is None else holder
    whole = [False] * n
    whole[top] = True
    # text that stands directly in the path, as long as it is not mostly links
    taken = [False] * n
    on_path = set(path)
    for i in path:
        taken[i] = 2 * link[i] <= own[i]
    for i in range(n):
        p = dom.parent[i]
        if i and live[i]:
            whole[i] = whole[i] or whole[p]
            if i not in on_path and p in on_path and not whole[i]:
                text = 2 * links[i] <= chars[i]
                whole[i] = density[i] >= least or text and (holder is None or dom.tag[i] in ("main", "article"))
        taken[i] = taken[i] or whole[i]
    return "\n".join(_blocks(dom, taken))


def _blocks(dom: _Dom, taken: list[bool]):
    """Runs of text of one node without a block between, white space folded."""
    run, at = [], -1
    for node, text, _ in dom.text:
        if node != at and run:
            if block := " ".join("".join(run).split()):
                yield block
            run = []
        at = node
        if taken[node]:
            run.append(text)
    if block := " ".join("".join(run).split()):
        yield block


def extract(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` per row of ``pages``.

    Null and empty html give an empty text; repeated rows are extracted each;
    extra columns are ignored.
    """

    def one(page_id, url, html):
        text = main_text(html)
        return page_id, url, text, len(text)

    return map_rows(pages.select("page_id", "url", "html"), lambda: one, "page_id long, url string, text string, n_chars long")


def op6_html_density(spark, sf_dir):
    """Main text of every page."""
    from ticklake.llm.common import table

    return extract(table(spark, sf_dir, "pages"))
