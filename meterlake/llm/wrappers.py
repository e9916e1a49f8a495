"""Main text of web pages by wrappers inferred from the pages of a host.

A wrapper is a union-free regular expression over the token stream of a
host's pages: elements in order, each required, optional (``?``) or repeated
(``+``), with text slots. It is inferred by aligning pages one after another:
an element that only one side has becomes optional; equal neighbours become
a repeated group; elements that come back after others make their sequence
a repeated group of optional members; a text that differs between pages is
a slot, one that never does is part of the template. An element's name is
its tag with those words of its class, id and role that stand on half of the
host's pages or more; of other words only what the name lists know is kept
(``post`` of ``post-812``), and html and body go by their tags.

Alignment is associative up to the order of optional members, so every task
aligns its own pages first, and only wrappers are shuffled: first by host and
a salt, then by host. A wrapper has each name once below its parent; its size
follows the template, not the number or length of pages, as a page has few
words that half of the pages have.

What is template is counted first, over all pages of a host: a block's whole
text that stands on nine pages of ten (hosts of ``FEW`` pages or more) is no
part of an article, wherever it stands and whatever its class, unless it is a
heading with a text of the article right behind it, or the page's article has
nothing else. The rest is the varying text, and the wrapper names the region
that holds it: an ``article`` or ``main`` element or one named like one, else
the deepest element that holds most of the varying text outside links. Lists
of names (menus, headers, footers, sidebars, notices, adverts, forms,
comments) decide on varying text only, and never on an element that holds
most of it (for a single page, nine tenths of its text). Every page of the
host is read from the region's path; pages without it, and hosts of one page,
are judged by their own wrapper.

Defined cases: null and empty html give the empty text; a null or malformed
address is the host ""; unclosed elements end where HTML has them end, and a
truncated page ends all; rows may repeat, and each counts as a page.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.words import add_columns
from meterlake.session import checkpoint_root

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?=[a-zA-Z/!])[^<>]*\Z", re.S)
_NAMED = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Elements by how HTML treats them.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Left out: elements whose content is no markup, and ones with elements inside.
_RAW = frozenset("script style textarea title iframe".split())
_HIDDEN = frozenset("noscript template svg math object canvas audio video select button".split())
_NESTED = frozenset("template svg math object".split())  # may hold their like
_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW | _NESTED}
_NEXT = {t: re.compile(rf"<(/?){t}(?=[\s/>])", re.I) for t in _HIDDEN - _NESTED}
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_ENDS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_NO_P = frozenset(_BLOCK - {"body", "html", "head"})
_HOLDS = frozenset("table ul ol dl div article section main body blockquote td th aside nav header footer form".split())
_OUT = frozenset("nav header footer aside form menu dialog head".split())
_OUT_NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|menus|header|masthead|footer|sidebar|side|aside|ad|ads|advert|adverts|advertisement|banner|promo|sponsor|sponsored|cookie|cookies|"
    r"consent|gdpr|notice|notices|popup|modal|overlay|alert|comment|comments|commentlist|reply|replies|respond|discussion|disqus|share|sharing|social|related|recommended|breadcrumb|"
    r"breadcrumbs|newsletter|subscribe|subscription|signup|login|search|widget|widgets|pagination|pager|toolbar|skip|complementary|contentinfo|form)(?:$|[\s_-])",
    re.I,
)
_IN_NAMES = re.compile(r"(?:^|[\s_-])(?:article|articlebody|content|post|entry|story|main|maintext|text|body)(?:$|[\s_-])", re.I)


#: Elements nested deeper belong to the slot of the one at this depth; texts
#: are read at any depth.
DEPTH = 60
#: Pages of a host from which on a text that nine of ten have is template.
FEW = 5
#: Longer words name no element. Bytes of a table of hosts that is sent to
#: every task; a larger one is joined by a shuffle, with the same result.
WORD, SENT = 64, 16 << 20
_HEADS = frozenset("h1 h2 h3 h4 h5 h6 dt th".split())


class Known(NamedTuple):
    """What all pages of a host tell: the words that name elements (None: any
    word does), and hashes of the texts of its template."""

    words: frozenset[str] | None = None
    texts: frozenset[int] = frozenset()


NOTHING = Known()


@lru_cache(maxsize=1 << 14)
def short(name: str, words: frozenset[str] | None) -> str:
    """An element's name, of words that are known or listed."""
    tag, *own = name.split()
    if tag in ("html", "body"):
        return tag
    if words is not None:
        listed = ((w, w in words or _OUT_NAMES.search(w) or _IN_NAMES.search(w)) for w in own)
        own = list(dict.fromkeys(w if m is True else m[0].strip(" _-") for w, m in listed if m))
    return " ".join([tag, *own])


def digest(pieces: list[str]) -> int | None:
    """Hash of a block's whole text, None if it has none."""
    whole = " ".join(entities.unescape("".join(pieces)).split())
    return int.from_bytes(blake2b(whole.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True) if whole else None


def words_and_texts(html: str) -> tuple[set[str], set[int]]:
    """Words that name the blocks of a page, and hashes of their texts."""
    words: set[str] = set()
    texts: set[int | None] = set()
    pieces: list[str] = []
    for kind, value, name in events(html):
        if kind == "text":
            pieces.append(value)
        elif value in _BLOCK:
            texts.add(digest(pieces))
            pieces.clear()
            words.update(w for w in name.split()[1:] if len(w) <= WORD)
        elif value == "br" and kind == "open":
            pieces.append(" ")
    texts.add(digest(pieces))
    return words, texts - {None}


class Node:
    """An element of a page or of a wrapper."""

    __slots__ = ("name", "kids", "text", "links", "fixed", "pages", "optional", "repeated", "looped", "sample", "varies")

    def __init__(self, name: str):
        self.name, self.kids = name, {}
        self.text = self.links = self.fixed = 0  # characters of its own text, of those inside links, and of others that are template
        self.pages, self.optional, self.repeated, self.looped = 1, False, False, False
        self.sample: str | None = None
        self.varies = False

    def tag(self) -> str:
        return self.name.split(" ", 1)[0]

    def out(self) -> bool:
        return self.tag() in _OUT or bool(_OUT_NAMES.search(self.name.partition(" ")[2]))


def events(html: str) -> Iterator[tuple[str, str, str]]:
    """``("open", tag, name)``, ``("close", tag, "")`` and ``("text", text, "")``
    of a page, with implied ends; raw and hidden elements are left out. Raw
    ones (scripts) end at their end tag, whatever stands before it. Hidden
    ones (buttons, drawings) end with their parent at the latest, and one
    that the page does not close at the next block."""
    stack: list[str] = []
    at, hidden, closed = 0, -1, True  # place in the stack of the outermost hidden element, and whether it has an end
    ends: dict[str, tuple[int, bool]] = {}

    def has_end(tag: str) -> bool:
        """Whether an element opened before ``at`` has its own end tag."""
        if tag not in ends or ends[tag][0] < at:
            m = (_END if tag in _NESTED else _NEXT)[tag].search(html, at)
            ends[tag] = (m.start(), tag in _NESTED or m[1] == "/") if m else (len(html), False)
        return ends[tag][1]

    def shut(to: int) -> Iterator[tuple[str, str, str]]:
        """Close all elements from place ``to`` on."""
        nonlocal hidden
        while len(stack) > to:
            last = stack.pop()
            if hidden < 0:
                yield "close", last, ""
            elif len(stack) == hidden:
                hidden = -1

    while m := _TOKEN.search(html, at):
        if m.start() > at and hidden < 0:
            yield "text", html[at : m.start()], ""
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag in stack:
                yield from shut(len(stack) - 1 - stack[::-1].index(tag))
            continue
        if hidden >= 0 and tag in _BLOCK and (not closed or (stack[hidden] in ("svg", "math") and "foreignobject" not in stack[hidden:])):
            yield from shut(hidden)
        if tag in _NO_P and "p" in stack:
            yield from shut(_place(stack, {"p"}, _HOLDS | _HIDDEN))
        if tag in _ENDS:
            yield from shut(_place(stack, _ENDS[tag], (_HOLDS - {"tr"} if tag in ("td", "th", "tr") else _HOLDS) | _HIDDEN))
        empty = tag in _VOID or m[3].endswith("/")
        if tag in _RAW:
            if not empty:
                end = _END[tag].search(html, at)
                at = end.start() if end else len(html)
            continue
        if hidden >= 0 or tag in _HIDDEN:
            if not empty:
                if hidden < 0:
                    hidden, closed = len(stack), has_end(tag)
                stack.append(tag)
            continue
        found = sorted((k.lower(), " ".join((a or b or c).split())) for k, a, b, c in _NAMED.findall(m[3])) if m[3] else ()
        yield "open", tag, " ".join([tag, *(v for _, v in found)])
        if empty:
            yield "close", tag, ""
        else:
            stack.append(tag)
    if hidden < 0 and at < len(html):
        yield "text", html[at:], ""
    yield from shut(0)


def _place(stack: list[str], ends: set[str], holds: frozenset[str]) -> int:
    """Place of the open element of ``ends`` that no holder stands above, or
    the length of the stack."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] in ends:
            return i
        if stack[i] in holds:
            break
    return len(stack)


def wrapper_of(html: str, known: Known = NOTHING) -> Node:
    """The wrapper of one page."""
    root = Node("#")
    path, inline, below = [root], [], 0
    pieces: list[str] = []
    plain = 0  # characters outside links of the block's text so far
    for kind, value, name in events(html):
        top = path[-1]
        if kind == "text":
            if known.texts:
                pieces.append(value)
            n = len(value.split())
            if n:
                size = len(" ".join(value.split()))
                top.text += size
                if "a" in inline:
                    top.links += size
                else:
                    plain += size
                if top.sample is None:
                    top.sample = value.strip()[:40]
                elif top.sample != value.strip()[:40]:
                    top.varies = True
            continue
        if value not in _BLOCK:
            if kind == "open":
                inline.append(value)
                if value == "br":
                    pieces.append(" ")
            elif value in inline:
                inline.remove(value)
            continue
        if plain and known.texts and digest(pieces) in known.texts:
            top.fixed += plain
        pieces.clear()
        plain = 0
        if kind == "open":
            if len(path) > DEPTH:
                below += 1
            else:
                path.append(Node(short(name, known.words)))
        elif below:
            below -= 1
        else:
            done = path.pop()
            _add(path[-1], done)
    if plain and known.texts and digest(pieces) in known.texts:
        path[-1].fixed += plain
    return root


def _add(parent: Node, kid: Node) -> None:
    """Append an element: a neighbour of the same name makes both a repeated
    group, one further back makes the sequence a repeated one."""
    known = parent.kids.get(kid.name)
    if known is None:
        parent.kids[kid.name] = kid
        return
    if next(reversed(parent.kids)) == kid.name:
        known.repeated = True
    else:
        parent.looped = True
        del parent.kids[kid.name]
        parent.kids[kid.name] = known
    pages = known.pages
    _merge(known, kid)
    known.pages = pages


def _merge(a: Node, b: Node) -> Node:
    """Align ``b`` with ``a``."""
    a.text += b.text
    a.links += b.links
    a.fixed += b.fixed
    a.pages += b.pages
    a.optional |= b.optional
    a.repeated |= b.repeated
    a.looped |= b.looped
    a.varies |= b.varies or (a.sample is not None and b.sample is not None and a.sample != b.sample)
    a.sample = a.sample if a.sample is not None else b.sample
    if not b.kids:
        for kid in a.kids.values():
            kid.optional = True
        return a
    mine, theirs = list(a.kids), list(b.kids)
    shared = [n for n in mine if n in b.kids]
    if shared != [n for n in theirs if n in a.kids]:
        a.looped = True  # the order differs: any member may come next
    merged: dict[str, Node] = {}
    left = iter(mine)
    pending = list(left)
    for name in theirs:
        if name in a.kids:
            while pending and pending[0] != name and pending[0] not in b.kids:
                only = pending.pop(0)
                a.kids[only].optional = True
                merged[only] = a.kids[only]
            if name in pending:
                pending.remove(name)
            merged[name] = _merge(a.kids[name], b.kids[name])
        else:
            b.kids[name].optional = True
            merged[name] = b.kids[name]
    for only in pending:
        a.kids[only].optional = True
        merged[only] = a.kids[only]
    a.kids = merged
    return a


def merge(a: Node | None, b: Node) -> Node:
    return b if a is None else _merge(a, b)


def dump(n: Node) -> list:
    return [n.name, n.text, n.links, n.fixed, n.pages, n.optional, n.repeated, n.looped, n.sample, n.varies, [dump(k) for k in n.kids.values()]]


def load(x: list) -> Node:
    n = Node(x[0])
    n.text, n.links, n.fixed, n.pages, n.optional, n.repeated, n.looped, n.sample, n.varies = x[1:10]
    n.kids = {k[0]: load(k) for k in x[10]}
    return n


def expression(n: Node) -> str:
    """The wrapper as a union-free regular expression."""
    slot = ["#text" if n.varies else json.dumps(n.sample, ensure_ascii=False)] if n.sample is not None else []

    def counted(k: Node) -> str:
        mark = "*" if k.optional and k.repeated else "+" if k.repeated else "?" if k.optional or n.looped else ""
        return f"({expression(k)}){mark}" if mark else expression(k)

    inner = " ".join([*slot, *map(counted, n.kids.values())])
    if n.looped:
        inner = f"({inner})+"
    return f"<{n.name}> {inner} </>" if inner else f"<{n.name}/>"


def varying(root: Node) -> dict[int, int]:
    """Characters of varying text outside links below each node, by its id;
    of all text outside links where nothing varies."""
    size: dict[int, int] = {}

    def total(n: Node, all_text: bool) -> int:
        size[id(n)] = n.text - n.links - (0 if all_text else n.fixed) + sum(total(k, all_text) for k in n.kids.values())
        return size[id(n)]

    if not total(root, False):
        total(root, True)
    return size


def held(root: Node) -> dict[int, str]:
    """Elements that the name lists would leave out but that hold most of the
    varying text: their paths by their ids."""
    size = varying(root)
    found: dict[int, str] = {}
    share = 5 if root.pages > 1 else 9  # one page does not show what varies

    def visit(n: Node, path: str) -> None:
        for k in n.kids.values():
            if 10 * size[id(k)] > share * size[id(root)] and k.tag() != "head":
                own = f"{path}\x1f{k.name}"
                if k.out():
                    found[id(k)] = own
                visit(k, own)

    visit(root, "")
    return found


def region(root: Node) -> list[str]:
    """Path of names to the element that holds the article."""
    best: tuple[tuple, list[str]] | None = None
    size: dict[int, int] = {}
    kept, whole = held(root), varying(root)

    def left_out(k: Node) -> bool:
        return k.out() and id(k) not in kept

    def total(n: Node) -> int:
        size[id(n)] = whole[id(n)] - sum(whole[id(k)] for k in n.kids.values()) + sum(total(k) for k in n.kids.values() if not left_out(k))
        return size[id(n)]

    total(root)

    def visit(n: Node, path: list[str]) -> None:
        nonlocal best
        for k in n.kids.values():
            if left_out(k):
                continue
            own = [*path, k.name]
            rank = 4 if k.tag() == "article" else 3 if k.tag() == "main" or re.search(r"(?:^|\s)(?:main|articleBody)(?:$|\s)", k.name.partition(" ")[2]) else 0
            if not rank and k.tag() in ("div", "section", "td") and _IN_NAMES.search(k.name.partition(" ")[2]):
                rank = 2
            if rank and size[id(k)] and (best is None or (rank, size[id(k)]) > best[0]):
                best = (rank, size[id(k)]), own
            visit(k, own)

    visit(root, [])
    if best is not None:
        return best[1]
    path, n = [], root
    while True:  # down as long as one element holds most of the text
        inner = [k for k in n.kids.values() if not left_out(k) and k.tag() in _HOLDS | {"html"}]
        top = max(inner, key=lambda k: size[id(k)], default=None)
        if top is None or 10 * size[id(top)] < 8 * size[id(n)] or not size[id(n)]:
            return path
        path.append(top.name)
        n = top


def blocks(html: str, path: list[str], known: Known = NOTHING, kept: frozenset[str] = frozenset()) -> list[str] | None:
    """Texts of the blocks inside every element at ``path``, in page order,
    without left-out elements (but with those of ``kept``) and template texts;
    None if the page has no such element."""
    out: list[tuple[str, bool, bool]] = []  # text, whether of the template, whether a heading
    text: list[str] = []
    stack: list[tuple[str, bool, int, str]] = [("", False, 0, "")]  # name, left out, length of path matched, own path
    found = not path

    def flush() -> None:
        whole = " ".join(entities.unescape("".join(text)).split())
        if whole:
            out.append((whole, bool(known.texts) and digest(text) in known.texts, stack[-1][0].split(" ", 1)[0] in _HEADS))
        text.clear()

    for kind, value, name in events(html):
        _, hidden, depth, at = stack[-1]
        inside = depth == len(path) and not hidden
        if kind == "text":
            if inside:
                text.append(value)
        elif value not in _BLOCK:
            if value == "br" and kind == "open" and inside:
                text.append(" ")
        else:
            if inside:
                flush()
            if kind == "open":
                # a path is matched from the top, element by element
                level = len(stack) - 1
                name = short(name, known.words)
                own = f"{at}\x1f{name}" if kept and level < DEPTH else ""
                if depth == len(path):
                    stack.append((name, hidden or (Node(name).out() and own not in kept), depth, own))
                elif depth == level and name == path[depth]:
                    stack.append((name, hidden, depth + 1, own))
                    found |= depth + 1 == len(path)
                else:
                    stack.append((name, hidden, -1, own))
            elif len(stack) > 1:
                stack.pop()
    flush()
    if not found:
        return None
    behind = [*(fixed for _, fixed, _ in out[1:]), True]
    own = [t for (t, fixed, head), last in zip(out, behind) if not fixed or (head and not last)]
    return own or [t for t, _, _ in out]


def main_text(html: str | None, path: list[str] | None, known: Known = NOTHING, kept: frozenset[str] = frozenset()) -> str:
    """The article of a page, read from ``path`` or from its own wrapper."""
    if not html:
        return ""
    got = blocks(html, path, known, kept) if path is not None else None
    if got is None:
        page = wrapper_of(html, known)
        got = blocks(html, region(page), known, frozenset(held(page).values())) or []
    return "\n\n".join(got)


_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def _host(url_col: str) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), _HOST, 1))


def _beside(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """``rows`` left joined with ``hosts`` on ``host``: without a shuffle of
    rows where the table of hosts is small."""
    size = hosts.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    return rows.join(F.broadcast(hosts) if size <= SENT else hosts, "host", "left")


@lru_cache(maxsize=256)
def _known(told: str | None) -> Known:
    x = json.loads(told) if told else None
    return Known(frozenset(x["words"]), frozenset(x["texts"])) if x else NOTHING


@lru_cache(maxsize=256)
def _plan(told: str | None) -> tuple[list[str] | None, Known, frozenset[str]]:
    x = json.loads(told) if told else {}
    return x.get("path"), _known(x.get("known")), frozenset(x.get("held", ()))


def _rows(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    return pages.select(_host(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html")).where("html != ''")


def known_of_hosts(pages: DataFrame, *, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host`` and ``known`` (JSON) of every host with two pages or more: the
    words and texts that enough of its pages have, counted over all of them."""

    def count(batches):
        seen: Counter[tuple] = Counter()

        def done():
            hosts, words, texts = zip(*seen)
            return pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(words, pa.string()), pa.array(texts, pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["host", "word", "text", "n"])

        for batch in batches:
            for h, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                words, texts = words_and_texts(page)
                seen[h, None, None] += 1
                seen.update((h, w, None) for w in words)
                seen.update((h, None, t) for t in texts)
                if len(seen) > 100_000:
                    yield done()
                    seen.clear()
        if seen:
            yield done()

    local = _rows(pages, url_col, html_col).mapInArrow(count, "host string, word string, text long, n long")
    counts = local.groupBy("host", "word", "text").agg(F.sum("n").alias("n")).where("n > 1").checkpoint()
    of_host = counts.where("word is null and text is null").select("host", F.col("n").alias("pages"))
    enough = "(word is null and text is null) or (word is not null and 2 * n >= pages) or (text is not null and 10 * n >= 9 * pages and pages >= " + str(FEW) + ")"
    known = _beside(counts, of_host).where(enough).groupBy("host").agg(F.sort_array(F.collect_set("word")).alias("words"), F.sort_array(F.collect_set("text")).alias("texts"))
    return known.select("host", F.to_json(F.struct("words", "texts")).alias("known"))


def infer_wrappers(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", salts: int = 256) -> DataFrame:
    """``host``, ``wrapper`` (JSON), ``expression``, ``path``, ``held``,
    ``pages`` and ``known`` (JSON) of every host, over all of its pages."""
    checkpoint_root(pages.sparkSession)
    known = known_of_hosts(pages, url_col=url_col, html_col=html_col).checkpoint()
    rows = _beside(_rows(pages, url_col, html_col), known)

    def align(batches):
        salt = TaskContext.get().partitionId() % salts
        for batch in batches:
            own: dict[str, Node] = {}
            for h, page, told in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "known"))):
                own[h] = merge(own.get(h), wrapper_of(page, _known(told)))
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.string()), pa.array([salt] * len(own), pa.int32()), pa.array([json.dumps(dump(n)) for n in own.values()], pa.string())], names=["host", "salt", "wrapper"])

    def join(table: pa.Table) -> Node:
        whole = None
        for x in sorted(table["wrapper"].to_pylist()):  # one order, whatever arrives first
            whole = merge(whole, load(json.loads(x)))
        return whole

    def some(table: pa.Table) -> pa.Table:
        return pa.table({"host": [table["host"][0].as_py()], "wrapper": [json.dumps(dump(join(table)))]})

    def all_of(table: pa.Table) -> pa.Table:
        n = join(table)
        return pa.table({"host": [table["host"][0].as_py()], "wrapper": [json.dumps(dump(n))], "expression": [expression(n)], "path": pa.array([region(n)], pa.list_(pa.string())), "held": pa.array([sorted(held(n).values())], pa.list_(pa.string())), "pages": pa.array([n.pages], pa.int64())})

    local = rows.mapInArrow(align, "host string, salt int, wrapper string")
    salted = local.groupBy("host", "salt").applyInArrow(some, "host string, wrapper string")
    whole = salted.groupBy("host").applyInArrow(all_of, "host string, wrapper string, expression string, path array<string>, held array<string>, pages long")
    return _beside(whole, known)


def extract_main_text(pages: DataFrame, *, url_col: str = "url", html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``pages`` (or its columns ``keep``) with ``text`` and ``n_chars`` of
    the article. Pages meet their host's path in a join that Spark may
    broadcast where the paths are small, and split where a host is hot."""
    kept = [c for c in (keep or pages.columns) if c not in ("text", "n_chars")]
    paths = infer_wrappers(pages, url_col=url_col, html_col=html_col).select("host", F.to_json(F.struct("path", "held", "known")).alias("__plan")).checkpoint()
    rows = pages.select(*(F.col(f"`{c}`").alias(f"__{c}") for c in kept if c != html_col), F.col(html_col).alias("___html"), _host(url_col).alias("host"))
    joined = _beside(rows, paths).select(*(F.col(f"`__{c}`").alias(c) for c in kept if c != html_col), F.col("___html").alias("__html"), *([F.col("___html").alias(html_col)] if html_col in kept else []), "__plan")

    def run(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = [main_text(h, *_plan(p)) for h, p in zip(batch.column("__html").to_pylist(), batch.column("__plan").to_pylist())]
        return {"text": pa.array(texts, pa.string()), "n_chars": pa.array([len(t) for t in texts], pa.int64())}

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return add_columns(joined, "__html", fields, run).drop("__html", "__plan")
