"""Pages as trees of block elements, and the features of their nodes."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np

# fixed values: element names of HTML by the role they have here
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT = set("head script style noscript template svg annotation annotation-xml iframe object select option "
             "button canvas audio video textarea title".split())
IN_HEAD = set("html head base basefont bgsound link meta title style script noscript template noframes".split())
BLOCK = set("html body article main section div nav header footer aside form p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd "
            "table thead tbody tfoot tr td th caption pre blockquote figure figcaption address details summary "
            "fieldset legend hgroup menu dialog center".split())
CLOSES_P = BLOCK - {"html", "body", "caption", "legend"}
# an opening tag of the key ends an open tag of the values
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"},
        "tfoot": {"thead", "tbody", "tr", "td", "th"}}
BOUNDARY = {"ul": {"li"}, "ol": {"li"}, "dl": {"dt", "dd"}, "table": {"tr", "td", "th", "thead", "tbody", "tfoot"}}

#: roles that an element's name gives, and roles that words of class, id, role and
#: itemprop give; each is a feature of the node itself and of its ancestors
TAG_ROLES = [{"nav", "menu"}, {"footer"}, {"header", "hgroup"}, {"aside"},
             {"form", "fieldset", "legend", "dialog"}, {"article", "main"}]
TAG_KINDS = [{"p", "pre", "blockquote"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "li", "dt", "dd"},
             {"div", "section", "center", "details"},
             {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"},
             {"figure", "figcaption"}, {"body", "html"}]
WORD_ROLES = ["nav|navbar|navigation|menu|breadcrumb|breadcrumbs|crumbs|toc|pager|pagination|tabs|skip",
              "footer|foot|bottom|copyright|legal|colophon|contentinfo",
              "header|head|masthead|logo|brand|topbar|top|hero|banner",
              "aside|sidebar|side|rail|widget|widgets|related|recommended|popular|trending|more|complementary|tags",
              "ad|ads|advert|adverts|advertisement|sponsor|sponsored|promo|promotion|dfp|adsense|banner",
              "notice|cookie|cookies|consent|gdpr|alert|popup|modal|overlay|message|warning|disclaimer",
              "comment|comments|reply|replies|respond|disqus|discussion|responses|feedback|reader",
              "form|search|login|signup|subscribe|newsletter|register|contact",
              "share|sharing|social|follow|toolbar|buttons|meta|byline|author",
              "article|articlebody|content|main|post|entry|story|body|text|page|prose|blog"]
WORD_ROLE = {w: 1 << i for i, ws in reversed(list(enumerate(WORD_ROLES))) for w in ws.split("|")}
SENTENCE = re.compile(r"[.!?,;:]")
BUTTON = re.compile(r"<(/?)button[\s/>]", re.I)


class Page(HTMLParser):
    """Block elements in page order, and the runs of text that each holds itself."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.tags, self.parents, self.words = ["body"], [-1], [0]
        self.runs: list[tuple[int, str, int]] = []  # node, text, characters inside links
        self.stack: list[tuple[str, int]] = [("body", 0)]  # open tag, its block node
        self.silent = 0
        self.loose = 0  # where the stack has a button without an end tag; 0: none
        self.at = 0  # where the start tag at hand begins
        self.links = 0
        self.held: list[str] = []
        self.held_link = 0
        html = html or ""
        cut = html.rfind("<")  # a tag that the end of the page cuts off is dropped
        if cut > html.rfind(">") and re.match(r"<[a-zA-Z/]", html[cut:cut + 2]):
            html = html[:cut]
        self.feed(html)
        self.close()
        self._end_run()

    def parse_starttag(self, i):
        self.at = i
        return super().parse_starttag(i)

    def parse_comment(self, i, report=1):
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 else end  # unclosed: to the end of the page

    def parse_marked_section(self, i, report=1):
        end = self.rawdata.find(">", i)  # "<![" outside foreign content is a comment
        return len(self.rawdata) if end < 0 else end + 1

    def _end_run(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                self.runs.append((self.stack[-1][1], text, min(self.held_link, len(text))))
            self.held, self.held_link = [], 0

    def _pop_to(self, at: int) -> None:
        if any(t in BLOCK for t, _ in self.stack[at:]):
            self._end_run()
        for t, _ in self.stack[at:]:
            if t in SILENT:
                self.silent -= 1
            elif t == "a":
                self.links -= 1
        if at <= self.loose:
            self.loose = 0
        del self.stack[at:]

    def _close(self, ends: set[str], boundary: set[str]) -> None:
        for at in range(len(self.stack) - 1, 0, -1):
            t = self.stack[at][0]
            if t in ends:
                self._pop_to(at)
                return
            if t in boundary or t in BOUNDARY:
                return

    def _end_head(self) -> None:
        """An end tag of the head may be left out: what cannot stand in it ends it."""
        if self.stack[-1][0] == "head":
            self._pop_to(len(self.stack) - 1)

    def handle_starttag(self, tag, attrs):
        if tag == "body" and self.silent:  # ends the head with all that is open in it
            names = [t for t, _ in self.stack]
            if "head" in names and "template" not in names:
                self._pop_to(names.index("head"))
        if tag in ("html", "body") or tag == "head" and self.stack[-1][0] == "head":
            return
        if tag not in IN_HEAD:
            self._end_head()
        if self.loose and (tag == "button" or tag in BLOCK and self.silent == 1):
            self._pop_to(self.loose)
        if tag == "br" or tag == "img":
            self.held.append(" ")
            return
        if tag in VOID:
            if tag == "hr":
                self._end_run()
            return
        if self.silent == 0 and tag in BLOCK:
            if tag in CLOSES_P:
                self._close({"p"}, {"table", "td", "th", "li", "div", "section", "article", "body"})
            if tag in ENDS:
                self._close(ENDS[tag], set())
            self._end_run()
            word = 0
            for name, value in attrs:
                if name in ("class", "id", "role", "itemprop") and value:
                    for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower()):
                        word |= WORD_ROLE.get(w, 0)
            self.tags.append(tag)
            self.parents.append(self.stack[-1][1])
            self.words.append(word)
            self.stack.append((tag, len(self.tags) - 1))
            return
        self.stack.append((tag, self.stack[-1][1]))
        if tag in SILENT:
            self.silent += 1
            if tag == "button" and self.silent == 1:
                following = BUTTON.search(self.rawdata, self.at + 1)
                if not (following and following[1]):
                    self.loose = len(self.stack) - 1
        elif tag == "a":
            self.links += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in ("html", "body"):
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at][0] == tag:
                self._pop_to(at)
                return
        # an end tag without its start is passed over

    def handle_data(self, data):
        if self.silent and data.strip(" \t\n\f\r"):
            self._end_head()
        if not self.silent:
            self.held.append(data)
            if self.links:
                self.held_link += len(data.strip())


def _bits(codes: np.ndarray, n: int) -> np.ndarray:
    return (codes[:, None] >> np.arange(n)) & 1


def _roles(groups: list[set[str]]) -> dict[str, int]:
    return {t: sum(1 << i for i, g in enumerate(groups) if t in g) for t in BLOCK}


def features(pages: list[Page]) -> np.ndarray:
    """A row per node of the pages, in order: roles by name and attribute words (own
    and of ancestors), subtree sizes and densities, depth, and where the node stands
    among its siblings. All pages are worked on at once, level by level."""
    counts = np.array([len(p.tags) for p in pages])
    offsets = np.cumsum(counts) - counts
    n = int(counts.sum())
    page_of = np.repeat(np.arange(len(pages)), counts)
    parent = np.concatenate([np.array(p.parents) for p in pages]) + offsets[page_of]
    root = offsets[np.arange(len(pages))]
    parent[root] = root
    tags = [t for p in pages for t in p.tags]
    tag_roles, tag_kinds = _roles(TAG_ROLES), _roles(TAG_KINDS)
    own_role = np.array([tag_roles[t] for t in tags])
    kind = np.array([tag_kinds[t] for t in tags])
    words = np.concatenate([np.array(p.words) for p in pages])

    # runs: sums of what each node holds itself
    at = np.array([o + node for o, p in zip(offsets, pages, strict=True) for node, _, _ in p.runs], np.int64)
    sizes = np.array([len(t) for p in pages for _, t, _ in p.runs], float)
    run_page = page_of[at] if len(at) else at
    place = np.cumsum(sizes) - sizes
    totals = np.bincount(run_page, sizes, minlength=len(pages)) if len(at) else np.zeros(len(pages))
    place = place - (np.cumsum(totals) - totals)[run_page] if len(at) else place
    in_links = np.array([k for p in pages for _, _, k in p.runs], float)
    stops = np.array([len(SENTENCE.findall(t)) for p in pages for _, t, _ in p.runs], float)
    own, link, marks, runs = (np.bincount(at, w, minlength=n).astype(float)  # whole numbers if there are no runs
                              for w in (sizes, in_links, stops, np.ones(len(at))))
    first = np.full(n, np.inf)
    np.minimum.at(first, at, place)
    paras = (np.array([t == "p" for t in tags]) & (own >= 40)).astype(float)
    text, longest, nodes = own.copy(), own.copy(), np.ones(n)

    depth = np.zeros(n, np.int64)
    up_role, up_words = np.zeros(n, np.int64), np.zeros(n, np.int64)
    levels, here = [], np.flatnonzero(parent != np.arange(n))
    is_here = parent == np.arange(n)
    while len(here):  # top down
        now = here[is_here[parent[here]]]
        depth[now] = depth[parent[now]] + 1
        up_role[now] = up_role[parent[now]] | own_role[parent[now]]
        up_words[now] = up_words[parent[now]] | words[parent[now]]
        levels.append(now)
        here = here[~is_here[parent[here]]]
        is_here[:] = False
        is_here[now] = True
    for now in levels[::-1]:  # bottom up
        for a in (text, link, marks, runs, paras, nodes):
            a += np.bincount(parent[now], a[now], minlength=n)
        np.maximum.at(longest, parent[now], longest[now])
        np.minimum.at(first, parent[now], first[now])
    child = np.flatnonzero(parent != np.arange(n))
    kids = np.bincount(parent[child], minlength=n).astype(float)
    before = np.zeros(n)
    order = child[np.argsort(parent[child], kind="stable")]
    starts = np.flatnonzero(np.diff(parent[order], prepend=-1))
    before[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))

    total = np.maximum(totals, 1)[page_of]
    some, around = np.maximum(text, 1), np.maximum(text[parent], 1)
    return np.concatenate([
        _bits(own_role, len(TAG_ROLES)), _bits(up_role, len(TAG_ROLES)), _bits(kind, len(TAG_KINDS)),
        _bits(words, len(WORD_ROLES)), _bits(up_words, len(WORD_ROLES)),
        np.stack([np.log1p(text), np.log1p(own), link / some, marks / some,
                  np.log1p(text / np.maximum(runs, 1)), np.log1p(paras), nodes / some, np.log1p(longest),
                  depth, before, kids[parent], text / around, text / total,
                  np.where(np.isfinite(first), first, 0) / total, paras[parent], link[parent] / around], axis=1),
    ], axis=1).astype(np.float32)


def decoded(page: Page, p: np.ndarray) -> np.ndarray:
    """Which nodes stay: the most probable choice in which no node stays whose parent
    goes. A node that goes takes all below it along."""
    parents, n = page.parents, len(page.tags)
    p = np.clip(p, 1e-4, 1 - 1e-4)
    stay, go = np.log(p).tolist(), np.log1p(-p).tolist()
    for i in range(n - 1, 0, -1):
        stay[parents[i]] += max(stay[i], go[i])
        go[parents[i]] += go[i]
    kept = np.zeros(n, bool)
    kept[0] = n == 1 or stay[0] >= go[0]
    for i in range(1, n):
        kept[i] = kept[parents[i]] and stay[i] >= go[i]
    return kept
