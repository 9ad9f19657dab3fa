"""Main text of web pages, with site templates removed.

A page is parsed into a tree of elements.  On every page each block element outside article and main
is hashed with all it holds, and so is the text that the page has beside it.  Spark counts for
each host and subtree the distinct texts beside it: a subtree that stands beside many different
texts is a part of the site's template and is deleted.  Copies of a page have one text beside
each of their parts, so a page that recurs is no template, however often it does; if nothing of a
page would remain, or none of its articles, nothing is deleted.

What remains is narrowed to the article element (or main, or the body where there is neither)
without the elements that are never article text: by tag (nav, footer, aside, form, script,
...), by whole tokens of class and id (advert, sidebar, comments, cookie-banner, ...), by role and
by the attribute hidden.  An element that holds an article or main stays; comments, cards and
what is hidden or an aside stay only if the page has no other article or main.  Recurrence deletes
nothing inside an article or main: paragraphs, licence lines and whole copies recur there.
List items and table cells are judged with their list or table only.

Defined cases: null or empty html gives an empty text; unclosed and misnested elements are
closed as browsers do for p, li, table parts and options, others at their parent's end; text
outside any element counts as the body's; a null or odd url is a host of its own; repeated
page_ids and repeated pages are pages of their own; a very long or malformed page is read once from left to right;
empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm import common as C

#: A subtree is template when it stands beside at least this many different texts on pages of the host.
LEAST_PAGES = 5
#: Rows of template hashes that may be broadcast (24 bytes each); more are joined by shuffle.
BROADCAST_ROWS = 200_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())  # their content is text up to the end tag
DROP = frozenset(
    "head title script style noscript template nav footer aside form button select textarea input iframe object svg "
    "canvas audio video dialog menu fieldset label".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
#: Elements that are no subtree of their own for the counts: the page's frame, and parts of menus and heads.
NEVER = frozenset("html head body article main li td th tr title script style meta link option".split())
#: An opening tag closes these open elements, if one is the nearest of its kind.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
#: A class or id token is boilerplate if all its parts between hyphens and underscores are of these words, or of NEUTRAL
#: beside one of these.  So "site-footer" is, "has-sidebar" and "no-sidebar" are not.
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer masthead menu nav navbar navigation newsletter notice popup promo related replies share sharing sidebar social "
    "sponsor sponsored subscribe toolbar widget".split()
)
NEUTRAL = frozenset("site page main top bottom left right primary secondary global list bar box area block item items link links button buttons slot posts form".split())
PARTS = re.compile(r"[-_]+")
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
SKIP = re.compile(r"[\s/]*")
ATTR_NAME = re.compile(r"=?[^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
UNQUOTED = re.compile(r"[^\s>]*")
#: Why an element is dropped: by its tag for good; by attributes or as a frame, unless it holds an article or main; as one
#: that may hold articles of its own (comments, cards), unless the page has no article or main elsewhere.
HARD, SOFT, LISTING = 1, 2, 3
FRAMES = frozenset("form fieldset label header".split())
LISTINGS = frozenset("nav footer aside dialog menu".split())
LISTING_WORDS = frozenset("comment comments disqus replies related".split())
SPACE = re.compile(r"\s+")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class Node:
    """holds: an article or main lies below, and what it means for the elements above is done.  block: the nearest element
    from here upwards that is not inline."""

    __slots__ = ("tag", "drop", "kids", "parent", "holds", "block")

    def __init__(self, tag, drop=0, parent=None):
        self.tag, self.drop, self.kids, self.parent, self.holds = tag, drop, [], parent, False
        self.block = parent.block if tag in INLINE and parent is not None else self


def _boilerplate(value: str) -> int:
    """SOFT or LISTING if a token of a class or id is boilerplate, else 0."""
    found = 0
    for token in value.lower().split():
        parts = [x for x in PARTS.split(token) if x]
        if any(x in BOILERPLATE for x in parts) and all(x in BOILERPLATE or x in NEUTRAL for x in parts):
            if not LISTING_WORDS.isdisjoint(parts):
                return LISTING
            found = SOFT
    return found


def _dropped(tag: str, attrs: list[tuple[str, str]]) -> int:
    if tag in DROP:
        return SOFT if tag in FRAMES else LISTING if tag in LISTINGS else HARD
    if not attrs or tag in ("body", "html", "article", "main"):
        return 0
    found = 0
    for name, value in attrs:
        name = name.lower()
        if name == "hidden":
            return LISTING
        if name == "role" and value.lower() in ROLES:
            found = found or SOFT
        elif name in ("class", "id"):
            found = max(found, _boilerplate(html.unescape(value)))
    return found


class Tags:
    """The tags of a page from left to right, each character being looked at a bounded number of times.

    A quote opens a value only after an equals sign, and only if its like follows somewhere;
    a comment or declaration without an end takes the rest, as does a tag without one.
    """

    def __init__(self, page: str):
        self.page, self.last = page, {}

    def find(self, mark: str, at: int) -> int:
        """page.find(), or the page's length; that a mark does not come again is looked up once."""
        if at > self.last.get(mark, at):
            return len(self.page)
        to = self.page.find(mark, at)
        if to < 0:
            self.last[mark] = at - 1
            return len(self.page)
        return to

    def next(self, at: int) -> tuple[int, int, str, bool, list, bool]:
        """(begin, end, name, is it an end tag, attributes, does it close itself) of the next tag or comment; a comment has
        no name.  At the page's end begin is its length."""
        page = self.page
        while True:
            at = self.find("<", at)
            if at >= len(page):
                return len(page), len(page), "", False, [], False
            if page.startswith("<!--", at):
                return at, min(self.find("-->", at + 4) + 3, len(page)), "", False, [], False
            if page.startswith("<![CDATA[", at):
                return at, min(self.find("]]>", at) + 3, len(page)), "", False, [], False
            if page[at + 1 : at + 2] in ("!", "?"):
                return at, min(self.find(">", at) + 1, len(page)), "", False, [], False
            end = page[at + 1 : at + 2] == "/"
            m = NAME.match(page, at + 1 + end)
            if m:
                break
            at += 1
        attrs, i = [], m.end()
        if page.startswith(">", i):  # most tags
            return at, i + 1, m[0].lower(), end, attrs, False
        while True:
            begin = i
            i = SKIP.match(page, i).end()
            if i >= len(page) or page[i] == ">":
                closes = page[begin:i].endswith("/")
                return at, min(i + 1, len(page)), m[0].lower(), end, attrs, closes
            name = ATTR_NAME.match(page, i)
            i, value = name.end(), ""
            equals = EQUALS.match(page, i)
            if equals:
                i = equals.end()
                quote = page[i : i + 1]
                if quote in ("'", '"') and quote and (to := self.find(quote, i + 1)) < len(page):
                    value, i = page[i + 1 : to], to + 1
                else:
                    value = UNQUOTED.match(page, i)[0]
                    i += len(value)
            attrs.append((name[0], value))


def parse(page: str) -> Node:
    """The tree; kids are nodes and strings (character references decoded).  Work is linear in the page."""
    root = node = Node("html")
    tags, at, listings, open_now = Tags(page), 0, [], {}

    def leave(to: Node) -> Node:
        """Closes what is open below to."""
        up = node
        while up is not to:
            open_now[up.tag] -= 1
            up = up.parent
        return to

    while at < len(page):
        begin, end, tag, closing, attrs, closes = tags.next(at)
        if begin > at:
            node.kids.append(html.unescape(page[at:begin]))
        at = end
        if not tag:
            continue
        if closing:
            if open_now.get(tag):
                up = node
                while up.tag != tag:
                    up = up.parent
                node = leave(up.parent)
            continue
        if tag in CLOSES_P or tag in CLOSES:
            want = CLOSES.get(tag, ()) or ("p",)
            if any(map(open_now.get, want)):
                up = node.block
                while up.parent is not None and up.tag in want:
                    node = leave(up.parent)
                    if tag != "tr":
                        break
                    up = node.block
        within = open_now.get("article") or open_now.get("main")
        new = Node(tag, _dropped(tag, attrs) or (SOFT if tag == "header" and not within else 0), node)
        node.kids.append(new)
        if tag in ("article", "main"):
            up = node
            while up is not None and not up.holds:
                up.holds = True
                if up.drop == SOFT:
                    up.drop = 0
                elif up.drop == LISTING:
                    listings.append(up)
                up = up.parent
        if tag in VOID or closes:
            continue
        if tag in RAW:
            to, shut = _raw_end(tags, tag, at)
            new.kids.append(page[at:to])
            at = shut
            continue
        node = new
        open_now[tag] = open_now.get(tag, 0) + 1
    if listings and not _find(root, "article", []) and not _find(root, "main", []):
        for x in listings:
            x.drop = 0
    return root


def _raw_end(tags: Tags, tag: str, at: int) -> tuple[int, int]:
    """Where the raw text of an element ends, and where its end tag does."""
    page = tags.page
    while (to := tags.find("</", at)) < len(page):
        i = to + 2 + len(tag)
        if page[to + 2 : i].lower() == tag and page[i : i + 1] in ("", ">", "/", " ", "\t", "\n", "\r", "\f"):
            return to, min(tags.find(">", i) + 1, len(page))
        at = to + 2
    return len(page), len(page)


def _find(node: Node, tag: str, out: list) -> list:
    """The outermost elements of a tag that lie in nothing dropped."""
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str) or x.drop:
            continue
        if x.tag == tag:
            out.append(x)
        else:
            stack += reversed(x.kids)
    return out


def main_parts(root: Node) -> list[Node]:
    for tag in ("article", "main"):
        if found := _find(root, tag, []):
            return found
    return [root]


U64 = (1 << 64) - 1


def _subtree_hashes(root: Node) -> list[tuple[int, int, Node]]:
    """(hash over tag and all content, hash of the text beside it, subtree) of what may be template: blocks outside article and main."""
    order, inside = [root], set()
    for node in order:  # grows as it is read: parents before their kids
        kids = [k for k in node.kids if not isinstance(k, str) and not k.drop]
        if node.tag in ("article", "main") or id(node) in inside:
            inside.update(map(id, kids))
        order += kids
    of: dict[int, bytes] = {}
    text: dict[int, int] = {}  # sums, so that what is beside a subtree is one subtraction
    found = []
    for node in reversed(order):
        parts, own = [node.tag.encode()], 0
        for k in node.kids:
            if isinstance(k, str):
                parts.append(SPACE.sub(" ", k).encode("utf-8", "surrogatepass"))
                if not k.isspace():
                    own += xxhash.xxh3_64_intdigest(parts[-1].strip())
            elif not k.drop:
                parts.append(of[id(k)])
                own += text[id(k)]
        h = xxhash.xxh3_64_intdigest(b"\0".join(parts))
        of[id(node)], text[id(node)] = h.to_bytes(8, "little"), own & U64
        if node.parent is not None and node.tag not in INLINE and node.tag not in NEVER and id(node) not in inside:
            found.append((h, node))
    whole = text[id(root)]
    return [(h - (1 << 63), ((whole - text[id(n)]) & U64) - (1 << 63), n) for h, n in found]


def _blank(node: Node) -> bool:
    stack = [node]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            if x and not x.isspace():
                return False
        elif not x.drop:
            stack += x.kids
    return True


def _remove(root: Node, found: list[Node]) -> None:
    """Drop the template subtrees found, unless nothing of the page would remain or, of a page with articles, none of them."""
    plain = main_parts(root) == [root]
    for n in found:
        n.drop = HARD
    parts = main_parts(root)
    if all(map(_blank, parts)) or (parts == [root] and not plain):
        for n in found:
            n.drop = 0


def subtree_hashes(page: str | None) -> dict[int, int]:
    """The distinct hashes of a page's candidates, and that of the text beside each."""
    return {h: beside for h, beside, _ in _subtree_hashes(parse(page or ""))}


def extract(page: str | None, template: frozenset = frozenset()) -> str:
    root = parse(page or "")
    if template:
        _remove(root, [n for h, _, n in _subtree_hashes(root) if h in template])
    parts = main_parts(root)
    blocks, now = [], []

    def close():
        if text := SPACE.sub(" ", "".join(now)).strip():
            blocks.append(text)
        now.clear()

    def walk(top: Node):
        stack: list = [(top, False)]
        while stack:
            x, done = stack.pop()
            if isinstance(x, str):
                now.append(x)
            elif done:
                close()
            elif x.drop:
                if x.tag not in INLINE:
                    close()
            elif x.tag in INLINE:
                if x.tag in ("br", "wbr", "img"):
                    now.append(" " if x.tag == "br" else "")
                stack += [(k, False) for k in reversed(x.kids)]
            else:
                close()
                stack.append((x, True))
                stack += [(k, False) for k in reversed(x.kids)]

    for part in parts:
        walk(part)
        close()
    return " ".join(blocks)


def _host():
    return F.coalesce(F.nullif(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)), F.lit("")), F.coalesce("url", F.lit("")))


def _subtrees(batches):
    for batch in batches:
        hosts, found = batch.column("host").to_pylist(), [subtree_hashes(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([h for h, f in zip(hosts, found) for _ in f], pa.string()), pa.array([x for f in found for x in f], pa.int64()), pa.array([x for f in found for x in f.values()], pa.int64())],
            ["host", "subtree", "beside"])


def templates(pages: DataFrame) -> DataFrame:
    """(host, subtree): hashes that stand beside many different texts on pages of the host."""
    seen = pages.select(_host().alias("host"), "html").mapInArrow(_subtrees, "host string, subtree long, beside long").distinct()
    return seen.groupBy("host", "subtree").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_PAGES).select("host", "subtree")


def _texts(by_host: bool):
    """by_host: all pages of a host have one list."""

    def run(batches):
        for batch in batches:
            hosts, lists, known = batch.column("host").to_pylist(), batch.column("template"), {}
            if not by_host:
                hosts = range(len(hosts))
            for i, h in enumerate(hosts):
                if h not in known:
                    known[h] = frozenset(lists[i].as_py() or ())
            text = [extract(p, known[h]) for p, h in zip(batch.column("html").to_pylist(), hosts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id").cast(pa.int64()), batch.column("url").cast(pa.string()), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    return run


def main_text(pages: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """pages(page_id, url, html) -> page_id, url, text, n_chars.

    The template hashes of a host go to its pages: by a broadcast join if a count shows them
    few, else each page is sent only those that it holds, by a join on (host, subtree).
    """
    found = C.materialize(templates(pages))
    rows = pages.select("page_id", "url", "html", _host().alias("host"))
    few = found.count() <= broadcast_rows
    if few:
        lists = found.groupBy("host").agg(F.collect_list("subtree").alias("template"))
        joined = rows.join(F.broadcast(lists), "host", "left")
    else:
        keyed = rows.withColumn("row", F.xxhash64("page_id", "url", "html"))
        own = keyed.select("row", "host", "html").mapInArrow(_own_subtrees, "row long, host string, subtree long")
        held = own.join(found, ["host", "subtree"]).groupBy("row").agg(F.collect_set("subtree").alias("template"))  # at most a page's elements
        joined = keyed.join(held, "row", "left")
    return joined.select("page_id", "url", "html", "host", "template").mapInArrow(_texts(few), "page_id long, url string, text string, n_chars long")


def _own_subtrees(batches):
    for batch in batches:
        rows = [(r, h, x) for r, h, p in zip(*(batch.column(c).to_pylist() for c in ("row", "host", "html"))) for x in subtree_hashes(p)]
        cols = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())], ["row", "host", "subtree"])
