"""Main text of pages by wrapper induction.

A page becomes a tree of its block elements. The pages of a host share a
template: their trees are aligned by simple tree matching (equal labels, the
largest order-keeping match of the children), runs of like siblings count as
one repeated node, and each node notes in how many pages it occurs and how
much text it holds. Then all pages are aligned with the template of their host
and the texts of each slot counted by a groupBy; a node that the template has
no slot for counts by the labels of its path, so no text goes uncounted,
however long the page or rare the layout. Nodes whose text is the same on nearly
all pages belong to the template; all varying slots are content. The slot that
gathers most of the varying text, an article or main element if there is one
on the way, is the core of the host's content; outside of it half as many
pages tell that a text is template.

Every distinct page takes part in its host's template, once: each of n equal
pages of a host weighs 1/n, so all counts are counts of different pages. Tasks fold the pages they
read into partial templates, partial templates merge by host and salt, then
by host, each time folding a sorted stream, so no host gathers anywhere.
Elements that by name are menus, headers, footers, asides, forms or scripts
never count as content. Nor do those that a class, id or role marks as menu,
advert, notice, comments and so on by a whole token, unless an article or main
element or half of the host's varying text is inside. On an inline element, and
on a heading or paragraph inside an article or main element, only the marks of
adverts and reader comments count: the others are there names of styles.

Any text parses, in time in proportion to its length: each unclosed tag, quote
or element is looked at a bounded number of times. Elements nested deeper than
``DEEPEST`` hang side by side, in page order, on the element at that depth, as
browsers also do; their text and their marks stay.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_or_empty

SCHEMA = "page_id long, url string, text string, n_chars long"

#: Element names by their role (fixed values of the HTML standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                     "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
FENCE = frozenset("table ul ol dl td th div section article body html".split())
#: Elements that are never content.
DROPPED = frozenset("nav footer aside form script style noscript template button select textarea title head iframe object "
                    "svg canvas audio video dialog menu input datalist".split())
#: Words in a class, id or role that mark an element as no content.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar aside "
                  "menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies "
                  "responses cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
                  "signup login share sharing social related recommended widget widgets search searchbox pagination pager toolbar "
                  "complementary contentinfo dialog form skip hidden".split())

#: Of these, the marks of adverts and reader comments.
ALWAYS_MARKS = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion comment comments "
                         "disqus reply replies responses".split())

#: Elements deeper than this hang on the one at this depth.
DEEPEST = 200

#: Start of a tag, to its end if no quoted value holds an angle bracket, or of other markup.
_MARKUP = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*+)([^>\"']*+(?:(?:\"[^\"<>]*\"|'[^'<>]*')[^>\"']*+)*+>)?|[!?])")
_PLAIN = re.compile(r"[^>\"']*")
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_MARK_WORD = re.compile(r"[a-z]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset(("article", "main"))
TEXT_BLOCKS = HEADINGS | {"p", "pre", "blockquote"}
_LONG_NUMBER = re.compile(r"&#[0-9]{20,};?")


class Node:
    """dropped: never content; marked: no content by a class, id or role,
    unless an article or main element inside (``holds``) or the host's
    template says otherwise."""

    __slots__ = ("tag", "label", "dropped", "marked", "holds", "children")

    def __init__(self, tag: str, label: str, dropped: bool, marked: bool = False):
        self.tag, self.label, self.dropped, self.marked, self.holds, self.children = tag, label, dropped, marked, False, []

    def own_chars(self) -> int:
        return len(clean("".join(c for c in self.children if type(c) is str)))

    def runs(self) -> list[tuple[str, list["Node"]]]:
        """Element children, like siblings in a row together."""
        out: list = []
        for c in self.children:
            if type(c) is not str and not c.dropped:
                if out and out[-1][0] == c.label:
                    out[-1][1].append(c)
                else:
                    out.append((c.label, [c]))
        return out


def clean(raw: str) -> str:
    """Character references decoded, white space turned into one space."""
    if "&" in raw:
        raw = html.unescape(_LONG_NUMBER.sub(_shortened, raw))
    return " ".join(raw.split())


def _shortened(number: re.Match) -> str:
    """A numeric reference with leading zeros left out; a number that is still
    long is no character."""
    digits = number.group().strip("&#;").lstrip("0") or "0"
    return f"&#{digits};" if len(digits) < 20 else "\ufffd"


def _is_mark(token: str, always: bool) -> bool:
    """Whether a class, id or role is made of nothing but words in MARKS, with
    ``always`` one in ALWAYS_MARKS among them."""
    words = _MARK_WORD.findall(token)
    return bool(words) and MARKS.issuperset(words) and not (always and ALWAYS_MARKS.isdisjoint(words))


def _label(tag: str, attributes: str, in_article: bool, in_content: bool) -> tuple[str, bool, bool]:
    """Label of an element, whether it is dropped, and whether it is marked."""
    always = tag in INLINE or in_content and tag in TEXT_BLOCKS
    dropped, marked = tag in DROPPED or tag == "header" and not in_article, False
    if len(attributes) < 4:
        return tag, dropped, marked
    names = []
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            dropped = dropped or name == "hidden"
        elif name != "aria-hidden":
            if name != "id":
                names += _MARK_WORD.findall(value)
            if tag not in ("html", "body", "main") and not (name == "id" and tag in HEADINGS):
                marked = marked or any(_is_mark(token, always) for token in value.split())
    label = tag + "." + ".".join(names) if names else tag
    return label + "!" if marked else label, dropped, marked


class Markup:
    """The markup of a text, from left to right. What is known to be missing
    from some place on is not looked for again."""

    def __init__(self, text: str):
        self.text, self.last = text, text.rfind(">")
        self.unclosed: set[int] = set()  # quotes after which no tag ends
        self.cdata = True
        self.ends: dict[str, dict[int, int]] = {}

    def next(self, at: int) -> tuple[int, int, str | None, bool, str]:
        """Start and end of the next piece of markup, and of a tag its name,
        whether it closes, and its attributes; a CDATA section has the name
        ``![``, other markup none. At the end both places are the text's end."""
        text = self.text
        found = _MARKUP.search(text, at)
        start = found.start() if found else len(text)
        if start > self.last:  # no tag can end here, only a comment runs on
            start = text.find("<!--", start)
            return (start if start >= 0 else len(text)), len(text), None, False, ""
        if found.group(3) is not None:
            return start, found.end(), found.group(2).lower(), found.group(1) == "/", found.group(3)
        if found.group(2) is not None:
            end = self._tag_end(found.end(2))
            return start, end, found.group(2).lower(), found.group(1) == "/", text[found.end(2):end]
        if text.startswith("<!--", start):
            end = text.find("-->", start + 4)
            return start, (end + 3 if end >= 0 else len(text)), None, False, ""
        if self.cdata and text.startswith("<![CDATA[", start):
            end = text.find("]]>", start + 9)
            if end >= 0:
                return start, end + 3, "![", False, text[start + 9:end]
            self.cdata = False
        return start, text.index(">", start) + 1, None, False, ""

    def _tag_end(self, at: int) -> int:
        """Where a tag ends: at the first > outside quotes, or if there is
        none at the first one."""
        text, seen, i = self.text, [], at
        while True:
            i = _PLAIN.match(text, i).end()
            if i < len(text) and text[i] == ">":
                return i + 1
            if i == len(text) or i in self.unclosed:
                break
            seen.append(i)
            i = text.find(text[i], i + 1) + 1
            if not i:
                break
        self.unclosed.update(seen)
        return text.index(">", at) + 1

    def after(self, start: int, at: int, tag: str) -> int:
        """Where the element of an inline tag at ``start`` ends; ``at``, the
        end of the tag, if it is never closed."""
        if tag not in self.ends:
            ends = self.ends[tag] = {}
            opened, close = [], -1
            for m in re.compile(rf"<(/?){tag}\b", re.I).finditer(self.text):
                if m.end() > self.last:
                    break
                if not m.group(1):
                    opened.append(m.start())
                elif opened:
                    close = close if close >= m.end() else self.text.index(">", m.end())
                    ends[opened.pop()] = close + 1
        return max(self.ends[tag].get(start, at), at)


class Open:
    """The open elements of a page that is being read."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.at: dict[str, list[int]] = {}  # depths of the open elements of a name
        self.fences: list[int] = []
        self.dropped = 0

    def inside(self, tag: str) -> bool:
        return bool(self.at.get(tag))

    def push(self, node: Node) -> None:
        depth = len(self.stack)
        self.at.setdefault(node.tag, []).append(depth)
        if node.tag in FENCE:
            self.fences.append(depth)
        self.dropped += node.dropped
        self.stack.append(node)

    def add(self, node: Node) -> None:
        """Hang a node on the innermost open element; past DEEPEST on the one
        there, as part of what is dropped or marked around it."""
        if len(self.stack) > DEEPEST:
            inner = self.stack[-1]
            node.dropped = node.dropped or inner.dropped
            if inner.marked and not node.marked and node.tag not in CONTENT:
                node.marked, node.label = True, node.label + "!"
        self.stack[min(len(self.stack), DEEPEST) - 1].children.append(node)

    def close(self, depth: int) -> None:
        for node in reversed(self.stack[depth:]):
            self.at[node.tag].pop()
            if node.tag in FENCE:
                self.fences.pop()
            self.dropped -= node.dropped
        del self.stack[depth:]
        self.resume()

    def resume(self) -> None:
        """After an element past DEEPEST: what follows in the element around
        it goes to a new node beside it, so that the order stays."""
        if len(self.stack) > DEEPEST:
            was = self.stack[-1]
            rest = self.stack[-1] = Node(was.tag, was.label, was.dropped, was.marked)
            rest.holds = was.holds
            self.stack[DEEPEST - 1].children.append(rest)

    def innermost(self, tags: set[str]) -> int:
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=0)

    def fence(self) -> int:
        return self.fences[-1] if self.fences else 0

    def hold(self) -> None:
        """The open elements have an article or main element inside."""
        for node in reversed(self.stack):
            if node.holds:
                break
            node.holds = True


def parse(text: str) -> Node:
    """The tree of block elements. Inline elements are see-through, a br is
    white space; unclosed elements end where the standard implies it."""
    root = Node("#root", "#root", False)
    markup, opened, at, end = Markup(text), Open(root), 0, len(text)
    while at < end:
        start, upto, tag, closes, attributes = markup.next(at)
        if start > at:
            opened.stack[-1].children.append(text[at:start])
        before, at = start, upto
        if tag is None:
            continue
        if tag == "![":
            opened.stack[-1].children.append(html.escape(attributes))
        elif closes:
            depth = 0 if tag in INLINE else opened.innermost({tag})
            if depth and (tag != "p" or depth > opened.fence()):
                opened.close(depth)
        elif tag in INLINE:
            if tag == "br" or tag == "img":
                opened.stack[-1].children.append(" ")
            elif len(attributes) > 3:
                _, dropped, marked = _label(tag, attributes, opened.inside("article"), True)
                if dropped or marked:
                    at = markup.after(before, at, tag)
        else:
            closing = {"p"} if tag in CLOSES_P else CLOSES.get(tag)
            if closing:
                depth = opened.innermost(closing)
                if depth and depth >= opened.fence():
                    opened.close(depth)
            in_article = opened.inside("article")
            label, dropped, marked = _label(tag, attributes, in_article, in_article or opened.inside("main"))
            if tag in CONTENT:
                if not (marked or dropped or opened.dropped):
                    opened.hold()
                marked = False
            node = Node(tag, label, dropped, marked)
            opened.add(node)
            if tag in RAW:
                close = re.compile(rf"</{tag}\b", re.I).search(text, at) if tag != "plaintext" else None
                at = text.find(">", close.end()) + 1 or end if close else end
                opened.resume()
            elif tag in VOID:
                opened.resume()
            else:
                opened.push(node)
    return root


class Slot:
    """A node of a template."""

    __slots__ = ("label", "tag", "pages", "chars", "kids", "mark", "root", "keep", "no")

    def __init__(self, label: str, tag: str):
        self.label, self.tag, self.pages, self.chars = label, tag, 0, 0
        self.kids: list[Slot] = []
        self.mark, self.root, self.no = None, False, 0
        self.keep = not label.endswith("!") or tag == "article"

    def number(self, no: int = 0) -> int:
        """Numbers the slots from the top down; the next number."""
        self.no = no
        no += 1
        for k in self.kids:
            no = k.number(no)
        return no

    def size(self) -> int:
        return 1 + sum(k.size() for k in self.kids)


def key_of(text: str) -> int:
    """Checksum and, in the high bits, length of a text."""
    return zlib.crc32(text.encode("utf-8", "replace")) | len(text) << 32


def tree_match(slot: Slot, node, memo: dict) -> int:
    """Size of the largest match of two trees with equal roots, else 0. node
    is a Node or a Slot."""
    if slot.label != node.label:
        return 0
    key = id(slot), id(node)
    if key not in memo:
        memo[key] = 1 + _children_match(slot.kids, _parts(node), memo)[0][-1][-1]
    return memo[key]


def _parts(node) -> list[tuple]:
    return [(k.label, [k]) for k in node.kids] if type(node) is Slot else node.runs()


def _children_match(kids: list[Slot], parts: list[tuple], memo: dict) -> tuple[list, list]:
    best = [[0] * (len(parts) + 1) for _ in range(len(kids) + 1)]
    pair = [[0] * len(parts) for _ in kids]
    for i, k in enumerate(kids):
        for j, (label, members) in enumerate(parts):
            w = pair[i][j] = tree_match(k, members[0], memo) if label == k.label else 0
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + w)
    return best, pair


def aligned(kids: list[Slot], parts: list[tuple], memo: dict) -> list[tuple[Slot | None, tuple | None]]:
    """Kids and parts in order, matched ones together."""
    if [k.label for k in kids] == [p[0] for p in parts]:
        return list(zip(kids, parts))
    best, pair = _children_match(kids, parts, memo)
    i, j, out = len(kids), len(parts), []
    while i and j:
        if pair[i - 1][j - 1] and best[i][j] == best[i - 1][j - 1] + pair[i - 1][j - 1]:
            i, j = i - 1, j - 1
            out.append((kids[i], parts[j]))
        elif best[i][j] == best[i - 1][j]:
            i -= 1
            out.append((kids[i], None))
        else:
            j -= 1
            out.append((None, parts[j]))
    out += [(k, None) for k in reversed(kids[:i])] + [(None, p) for p in reversed(parts[:j])]
    return out[::-1]


def fold_page(slot: Slot, nodes: list[Node], page: object, weight: float = 1) -> None:
    """Add a page's run of like nodes to the slot aligned with them."""
    if slot.mark is not page:
        slot.mark, slot.pages = page, slot.pages + weight
    slot.chars += sum(n.own_chars() for n in nodes) * weight
    for node in nodes:
        parts, kids = node.runs(), []
        if not parts:
            continue
        for kid, part in aligned(slot.kids, parts, {}):
            if kid is None:
                kid = Slot(part[0], part[1][0].tag)
            if part is not None:
                fold_page(kid, part[1], page, weight)
            kids.append(kid)
        slot.kids = kids


def merge(a: Slot, b: Slot) -> Slot:
    """Two templates of one host as one."""
    a.pages, a.chars, a.mark = a.pages + b.pages, a.chars + b.chars, None
    a.kids = [merge(k, p[1][0]) if k and p else k or p[1][0] for k, p in aligned(a.kids, _parts(b), {})]
    return a


def prune(slot: Slot, limit: int) -> Slot:
    """Drop the rarest slots of a template that has grown over ``limit``; their
    nodes count by the labels of their paths."""
    least = 1
    while slot.size() > limit:
        least *= 2
        def thin(s: Slot) -> None:
            s.kids = [k for k in s.kids if k.pages >= least]
            for k in s.kids:
                thin(k)
        thin(slot)
    return slot


def find_root(top: Slot, fixed: list, pages: int) -> Slot:
    """Marks and returns the core of the content: from the top down, the child with
    nearly all varying text, as far as an article or main element. A marked
    slot with half of the host's varying text is no menu or the like and kept."""
    same: dict[int, float] = {}
    for place, text, n, on in fixed:
        if on > pages - 1e-6:
            same[place] = same.get(place, 0) + (text >> 32) * n

    def varying(s: Slot) -> float:
        if not s.keep:
            return 0
        return max(s.chars - same.get(s.no, 0), 0) + sum(map(varying, s.kids))

    def marked(s: Slot) -> list[Slot]:
        return [s] * (not s.keep) + [m for k in s.kids for m in marked(k)]

    some = marked(top)
    for m in some:
        m.keep = True
    total = varying(top)
    hold = [total > 0 and varying(m) >= 0.5 * total for m in some]
    for m, keep in zip(some, hold):
        m.keep = keep
    at = top
    while at.tag not in ("article", "main") and at.kids:
        total, kid = varying(at), max(at.kids, key=varying)
        if not total or varying(kid) < 0.8 * total or kid.tag in ("p", "li", "pre", "td"):
            break
        at = kid
    if at.tag == "main":
        at = next((k for k in at.kids if k.tag == "article" and varying(k) >= 0.8 * varying(at)), at)
    at.root = True
    return at


@lru_cache(1 << 16)
def _path(above: int, label: str) -> int:
    """Number, under 0, of a place that no slot stands for."""
    return -2 - (int.from_bytes(blake2b(f"{above} {label}".encode("utf-8", "replace"), digest_size=8).digest()) >> 2)


def placed(page: Node, top: Slot | None) -> dict[int, Slot]:
    """The slots of a page's nodes, by id of the node."""
    slots: dict[int, Slot] = {}

    def place(slot: Slot, nodes: list[Node]) -> None:
        for n in nodes:
            slots[id(n)] = slot
            if (parts := n.runs()) and slot.kids:
                for kid, part in aligned(slot.kids, parts, {}):
                    if kid is not None and part is not None:
                        place(kid, part[1])

    if top is not None:
        place(top, [page])
    return slots


def blocks_in(roots: list[Node], slots: dict[int, Slot], every: bool = False) -> tuple[list[tuple[int, bool, str]], set[int]]:
    """Place of each block of text, whether it is inside the core, and its
    text; and all places there are. ``every`` also goes into marked nodes."""
    blocks: list[tuple[int, bool, str]] = []
    places: set[int] = set()

    def walk(node: Node, core: bool, place: int) -> None:
        buffer: list[str] = []

        def flush() -> None:
            text = clean("".join(buffer))
            buffer.clear()
            if text:
                blocks.append((place, core, text))
        slot = slots.get(id(node))
        place = _path(place, node.label) if slot is None else slot.no
        core = core or slot is not None and slot.root
        places.add(place)
        for c in node.children:
            if type(c) is str:
                buffer.append(c)
            else:
                flush()
                if not c.dropped and (every or not c.marked or c.holds or id(c) in slots and slots[id(c)].keep):
                    walk(c, core, place)
        flush()

    for r in roots:
        walk(r, False, -1)
    return blocks, places


def main_text(page: Node, top: Slot | None, fixed: dict[tuple[int, int], float] | None = None, pages: int = 10) -> str:
    """Text of all blocks, without template text; ``fixed`` has, by place and
    text, on how many pages the place is of which nearly all have the text.
    Where a host has too few pages for a template, its article and main
    elements and top headings, if there are any, stand for the content."""
    roots = [page] if top is not None and top.pages > pages - 1e-6 else _semantic_roots(page)
    if all(r.tag == "h1" for r in roots):
        roots = [page]
    blocks, _ = blocks_in(roots, placed(page, top))
    return "\n".join(text for place, core, text in blocks
                     if not fixed or fixed.get((place, key_of(text)), 0) < (pages if core else pages // 2) - 1e-6)


def _semantic_roots(node: Node) -> list[Node]:
    found = [] if node.dropped or node.marked and not node.holds else [node] if node.tag in ("article", "main", "h1") else \
        [r for c in node.children if type(c) is not str for r in _semantic_roots(c)]
    return found


def host_of(url: str) -> Column:
    """Host of a URL in lower case, without user and port; empty if none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def weighed(pages: DataFrame, broadcast_rows: int = 500_000) -> DataFrame:
    """``(host, html, weight)``: each of n equal pages of a host weighs 1/n.
    Only the digests of pages with copies are joined back, by broadcast up to
    ``broadcast_rows`` of them."""
    digests = pages.select("host", "html", F.md5("html").alias("digest"))
    copies = materialize(digests.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "page-copies")
    if copies.count() <= broadcast_rows:
        copies = F.broadcast(copies)
    return digests.join(copies, ["host", "digest"], "left") \
        .select("host", "html", (F.lit(1.0) / F.coalesce("n", F.lit(1))).alias("weight"))


def host_templates(pages: DataFrame, limit: int, hosts: int = 2000, salts: int = 32) -> DataFrame:
    """``(host, template)``, one row per host; ``pages`` is weighed. A
    task holds at most ``hosts`` partial templates at a time."""
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Slot] = {}
        for batch in batches:
            for host, text, weight in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if host not in held and len(held) >= hosts:
                    yield _templates(held)
                    held = {}
                top = held.setdefault(host, Slot("#root", "#root"))
                fold_page(top, [parse(text.as_py())], object(), weight)
                if top.pages // 64 > (top.pages - weight) // 64:
                    prune(top, limit)
        if held:
            yield _templates(held)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, top = None, None
        for batch in batches:
            for host, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                slot = pickle.loads(blob.as_py())
                if host == now:
                    top = prune(merge(top, slot), limit)
                else:
                    if now is not None:
                        yield _templates({now: top})
                    now, top = host, slot
        if now is not None:
            yield _templates({now: top})

    schema = "host string, template binary"
    parts = materialize(pages.mapInArrow(fold, schema), "page-templates")
    salted = parts.withColumn("salt", F.pmod(F.xxhash64("template"), F.lit(salts)))
    some = salted.repartition("host", "salt").sortWithinPartitions("host", "salt") \
        .select("host", "template").mapInArrow(join, schema)
    return some.repartition("host").sortWithinPartitions("host").mapInArrow(join, schema)


def _templates(held: dict[str, Slot]) -> pa.RecordBatch:
    for top in held.values():
        _unmark(top)
    return pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([pickle.dumps(t) for t in held.values()], pa.binary())],
                                      ["host", "template"])


def _unmark(slot: Slot) -> None:
    slot.mark = None
    for k in slot.kids:
        _unmark(k)


def _dealt(rows: DataFrame, templates: DataFrame, broadcast_bytes: int):
    """The templates by broadcast, if they are small, else None, and the rows,
    else joined with their host's template."""
    n = [F.octet_length("template")] + [24 * F.coalesce(F.size("fixed"), F.lit(0)) for c in templates.columns if c == "fixed"]
    total = templates.agg(F.sum(sum(n[1:], n[0]))).first()[0] or 0
    if total > broadcast_bytes:
        return None, rows.join(templates, "host").sortWithinPartitions("host")
    held = {r[0]: (bytes(r[1]), [tuple(f) for f in r[2] or ()] if len(r) > 2 else []) for r in templates.collect()}
    return rows.sparkSession.sparkContext.broadcast(held), rows


def _opened(batch: pa.RecordBatch, row: int, column: int, tops: dict, known, pages: int) -> tuple[Slot, dict]:
    """Template and fixed texts of a row's host, from the broadcast or, if
    there is none, from ``column`` on."""
    host = batch.column(0)[row].as_py()
    if host not in tops:
        if len(tops) >= 2000 or known is None:
            tops.clear()
        if known is not None:
            blob, fixed = known.value[host]
        else:
            found = [c[row].as_py() for c in batch.columns[column:]]
            blob, fixed = found[0], [tuple(f.values()) for f in found[1] or ()] if len(found) > 1 else []
        top = pickle.loads(blob)
        top.number()
        find_root(top, fixed, pages)
        tops[host] = top, {(place, text): on for place, text, _, on in fixed}
    return tops[host]


def fixed_texts(pages: DataFrame, templates: DataFrame, least: int, share: float, broadcast_bytes: int,
                held: int = 200_000) -> DataFrame:
    """``(host, fixed)``: by host, each place and text on ``share`` of at least
    half of ``least`` pages that have the place, with both numbers of pages;
    ``pages`` is weighed. All blocks of all pages are counted."""
    known, rows = _dealt(pages, templates, broadcast_bytes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[str, tuple] = {}
        counts: Counter = Counter()
        for batch in batches:
            for i, (html, weight) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
                top, _ = _opened(batch, i, 3, tops, known, least)
                page, host = parse(html.as_py()), batch.column(0)[i].as_py()
                blocks, places = blocks_in([page], placed(page, top), every=True)
                for key in {(host, place, key_of(text)) for place, _, text in blocks}:
                    counts[key] += weight
                for place in places:
                    counts[host, place, -1] += weight
                if len(counts) >= held:
                    yield _counted(counts)
                    counts = Counter()
        yield _counted(counts)

    few = least // 2
    columns = ["host", "html", "weight"] + ([] if known else ["template"])
    sums = rows.select(*columns).mapInArrow(count, "host string, place long, text long, n double") \
        .groupBy("host", "place", "text").agg(F.sum("n").alias("n")).filter(F.col("n") > share * few - 1e-6)
    sums = materialize(sums, "text-counts")  # places under so many pages have no fixed text
    on = sums.filter("text = -1").select("host", "place", F.col("n").alias("on"))
    return sums.filter("text <> -1").join(on, ["host", "place"]) \
        .filter((F.col("on") > few - 1e-6) & (F.col("n") > share * F.col("on") - 1e-6)) \
        .groupBy("host").agg(F.collect_list(F.struct("place", "text", "n", "on")).alias("fixed"))


def _counted(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
         pa.array([k[2] for k in keys], pa.int64()), pa.array(map(float, counts.values()), pa.float64())],
        ["host", "place", "text", "n"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                      least_pages: int = 10, share: float = 0.95, limit: int = 1000,
                      broadcast_bytes: int = 32_000_000) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text (empty if none),
    n_chars (its code points).

    Text counts as template if it stands in the same slot on ``share`` of at
    least ``least_pages`` different pages; copies of a page count once. NULL html counts as empty; pages with a NULL
    or odd URL share one template; NULL ids stay; repeated rows are extracted
    alike; other columns are ignored; empty in, empty out. Templates go to
    the tasks by broadcast up to ``broadcast_bytes`` in all, else by a join
    on the host."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        text_or_empty(html_col).alias("html"), host_of(url_col).alias("host"))
    weights = weighed(rows)
    templates = materialize(host_templates(weights, limit), "host-templates")
    fixed = materialize(fixed_texts(weights, templates, least_pages, share, broadcast_bytes), "template-texts")
    templates = templates.join(fixed, "host", "left")
    known, rows = _dealt(rows, templates, broadcast_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[str, tuple] = {}
        for batch in batches:
            texts = []
            for i, page in enumerate(batch.column(1)):
                top, same = _opened(batch, i, 4, tops, known, least_pages)
                texts.append(main_text(parse(page.as_py()), top, same, least_pages))
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    columns = ["host", "html", "page_id", "url"] + ([] if known else ["template", "fixed"])
    return rows.select(*columns).mapInArrow(run, SCHEMA)
