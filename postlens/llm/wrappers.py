"""Main text of web pages, by wrappers inferred per host.

A page is a stream of block tags and text.  The pages of a host are aligned element by
element: neighbouring repetitions of a tag, or of a short group of tags, become a repeated
group; what only some pages have becomes optional; text becomes a slot that is constant or
varies.  The result is a union-free regular expression, the host's *wrapper*.  Aligning two
wrappers works as aligning two pages, so every task reduces its pages to one wrapper per
host, and those are merged path by path in two steps (salted, then by host and path): no task
sees all pages of a large host, no row holds a whole wrapper.

The main part is chosen per page, since a host can have several templates: the articles if
they have text, else the main element, else the element whose paragraphs vary over the host
and hold most text on a mean page that has it and no article or main.  That root is found
once per host and set of paths, and pages are matched to it by a digest of their paths.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments
are left out by their tags, by the words of their class and role, and by ids made of such words
only.  A page's text is what it has in the slots kept.  Where that leaves no page of a host with
text, its paths count unfiltered.

Defined results: null html is empty and gives an empty text; pages without a host share the
empty host; repeated rows are extracted each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
import zlib
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.batches import bounded, slices
from postlens.sources.staging import stage, staging_path

# Wrappers of one task are first merged in so many parts per host.
SALTS = 32

# Paths of wrappers and of pages' shapes that a task holds at a time.
PATHS = 50_000

# Parts of one element in a wrapper's expression; where classes differ by page, the expression
# has their tags only.  Texts do not depend on it.
CHILDREN = 200

# Longest group of tags that is recognized as repeated.
GROUP = 3

# Elements of HTML by their role here.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img".split()
)
_DROPPED = frozenset(
    "head script style noscript template nav footer aside form button select option textarea input iframe svg canvas audio "
    "video object embed map menu dialog title meta link base".split()
)
_RAW = frozenset("script style textarea title noscript template xmp iframe".split())
_CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section summary table ul".split()
)
_CLOSED_BY = {
    "li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
    "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",)),
}
# Words in class, id or role that mark what is no part of an article.
_OTHER_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising adbox banner promo promotion sponsor sponsored nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar aside complementary footer contentinfo masthead cookie cookies consent gdpr notice "
    "notices alert disclaimer copyright legal share sharing social related recommended recommendations newsletter subscribe "
    "subscription signup login comment comments commentlist disqus reply replies respond discussion widget popup modal overlay "
    "pager pagination search toolbar skip tooltip hidden".split()
)
_HEADER_WORDS = frozenset("header heading topbar top".split())
_MAIN_WORDS = frozenset(["main", "article"])
# Words of ids of what is no part of an article even within it, and of ids of main parts.
_SECTION_IDS = frozenset(
    "ad ads adsense advert adverts advertisement adbox comments commentlist disqus respond replies sidebar navbar breadcrumb "
    "breadcrumbs newsletter pagination cookie cookies".split()
)
_MAIN_IDS = _MAIN_WORDS | frozenset("content body text wrap wrapper container area column col inner".split())
# Classes of article elements that are comments or teasers.
_NO_ARTICLE = frozenset(
    "ad ads advert advertisement promo promotion sponsored sidebar related recommended comment comments reply replies widget".split()
)
_PAGE = frozenset(["html", "body"])
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 blockquote pre ul ol table".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_TEXT = "#text"


def _signature(tag: str, text: str) -> str:
    """A step of a path: the tag, the marks that its attributes give, and ``!`` if it is hidden.

    Marks are the words of class and role.  Ids are often unique to a page, so of them only
    ``#id`` (a whole name made of words of what is no article) and ``#ids`` (also inside of one,
    where sections have ids as anchors) are kept.  Page and main elements state layout and topics
    in their classes; of them only ``#all`` is kept, if all of an article's classes say it is none.
    """
    if tag in _PAGE:
        return tag
    names: dict[str, str] = {}
    hidden = False
    for name, *values in _ATTR.findall(text):
        value = values[0] or values[1] or values[2]
        name = name.lower()
        if name in ("class", "id", "role"):
            names.setdefault(name, value)
        elif name == "hidden" or (name == "aria-hidden" and value == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            hidden = True
    words, own, role = (set(map(str.lower, _WORD.findall(names.get(n, "")))) for n in ("class", "id", "role"))
    if tag in _MAIN_WORDS or role & _MAIN_WORDS:
        marks = set() if tag in _MAIN_WORDS else role & _MAIN_WORDS
        if words and words <= _NO_ARTICLE:
            marks = marks | {"#all"}
    else:
        marks = words | role
        if own and tag not in _HEADINGS:
            if own <= _SECTION_IDS:
                marks.add("#ids")
            elif own <= _OTHER_WORDS | _HEADER_WORDS:
                marks.add("#id")
            elif own <= _MAIN_IDS:
                marks |= own & _MAIN_WORDS
    return tag + "".join("." + m for m in sorted(marks)) + ("!" if hidden else "")


def blocks(page: str) -> Iterator[tuple[str, str | None]]:
    """A page as a stream: ``(path, None)`` where an element begins, ``(path, text)`` for its text.

    A path is made of the open block elements, see :func:`_signature`.  Text comes as raw pieces;
    inline tags do not separate them, a break is a space.  Inline elements that are hidden or no
    part of an article by their class are passed over.
    """
    stack: list[tuple[str, str]] = []  # tag, path
    path, at, size = "", 0, len(page)
    signatures: dict[tuple[str, str], str] = {}
    muted = size  # place in the stack of an open inline element that is passed over
    while at < size:
        match = _TOKEN.search(page, at)
        if match is None:
            if muted == size:
                yield path, html.unescape(page[at:])
            return
        if match.start() > at and muted == size:
            yield path, html.unescape(page[at : match.start()])
        at = match.end()
        tag = match["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["end"]:
            for depth in range(len(stack) - 1, -1, -1):
                if tag in _INLINE and depth < muted:
                    break
                if stack[depth][0] == tag:
                    if tag in _INLINE:
                        del stack[depth]
                        muted = size if depth == muted else muted
                    else:
                        del stack[depth:]
                        muted = size if len(stack) <= muted else muted
                    path = stack[-1][1] if stack else ""
                    break
            if tag not in _INLINE and muted == size:
                yield path, " "
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = close.end() if close else size
            if muted == size:
                yield path, " "
            continue
        if tag in _INLINE:
            if tag not in _VOID and (muted < size or match["attrs"] and _inline_other(tag, match["attrs"], signatures)):
                muted = min(muted, len(stack))
                stack.append((tag, path))
            continue
        if tag in _VOID:
            if muted == size:
                yield path, " "
            continue
        if tag in _CLOSES_P:
            _close(stack, ("p",), ("div", "article", "section", "td", "li", "blockquote", "body"))
        elif tag in _CLOSED_BY:
            _close(stack, _CLOSED_BY[tag][0].split(), _CLOSED_BY[tag][1])
        muted = size if len(stack) <= muted else muted
        key = (tag, match["attrs"])
        signature = signatures.get(key)
        if signature is None:
            signature = signatures[key] = _signature(tag, key[1]) if key[1] else tag
        path = (stack[-1][1] if stack else "") + "/" + signature
        stack.append((tag, path))
        if muted == size:
            yield path, " "
        yield path, None


def _inline_other(tag: str, attrs: str, signatures: dict[tuple[str, str], str]) -> bool:
    key = (tag, attrs)
    if key not in signatures:
        signatures[key] = _signature(tag, attrs)
    name = signatures[key]
    return name.endswith("!") or bool(_parts(name)[1] & _OTHER_WORDS)


def _close(stack: list[tuple[str, str]], tags, walls) -> None:
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth][0] in tags:
            del stack[depth:]
            return
        if stack[depth][0] in walls:
            return


# --- wrappers ----------------------------------------------------------------
#
# A wrapper is {path: [pages, characters, constant text's CRC or None, children, plain pages, their
# characters]}; plain pages have no article or main element.  A child is [names, optional,
# repeated], where names are the tags (or _TEXT) of a group.


def _folded(names: list[str]) -> list[list]:
    """Children of one element with neighbouring repetitions folded into groups."""
    items = [[(n,), False, False] for n in names]
    for width in range(1, GROUP + 1):
        out: list[list] = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * width:
                tail, before = out[-width:], out[-2 * width : -width]
                if [i[0] for i in tail] != [i[0] for i in before]:
                    # A group that was folded already goes on.
                    break
                del out[-width:]
                if width == 1:
                    out[-1] = [out[-1][0], False, True]
                else:
                    out[-width:] = [[tuple(n for i in before for n in i[0]), False, True]]
            if width > 1 and len(out) > width and out[-width - 1][2]:
                if out[-width - 1][0] == tuple(n for i in out[-width:] for n in i[0]):
                    del out[-width:]
        items = out
    return items


def page_wrapper(page: str, stream: list | None = None, plain: bool = False) -> dict:
    """The wrapper of a single page; ``plain`` if it has no article or main element with text."""
    current: dict[str, list[str]] = {"": []}  # children of the last element with a path
    lists: dict[str, list[list[str]]] = {"": [current[""]]}  # and of all elements with it
    texts: dict[str, list[str]] = {}
    open_text = None
    for path, text in blocks(page) if stream is None else stream:
        if text is None:
            parent, _, name = path.rpartition("/")
            current.setdefault(parent, []).append(name)
            current[path] = []
            lists.setdefault(path, []).append(current[path])
            open_text = None
        elif not text.isspace() and text:
            if open_text != path:
                current.setdefault(path, []).append(_TEXT)
                open_text = path
            texts.setdefault(path, []).append(text)
    out = {}
    for path, every in lists.items():
        own = None
        for names in every:
            folded = _folded(names)
            own = folded if own is None else _aligned(own, folded)
        text = " ".join(" ".join(texts.get(path, [])).split())
        out[path] = [1, len(text), zlib.crc32(text.encode("utf-8", "replace")), own, int(plain), len(text) if plain else 0]
    return out


def _aligned(one: list[list], two: list[list]) -> list[list]:
    """Two child sequences as one: what only one has becomes optional."""
    if len(one) == len(two) and all(a[0] == b[0] for a, b in zip(one, two, strict=True)):
        return [[a[0], a[1] or b[1], a[2] or b[2]] for a, b in zip(one, two, strict=True)]
    out: list[list] = []
    left, right = [tuple(a[0]) for a in one], [tuple(b[0]) for b in two]
    for kind, a, b, c, d in SequenceMatcher(None, left, right, autojunk=False).get_opcodes():
        if kind == "equal":
            out += [[x[0], x[1] or y[1], x[2] or y[2]] for x, y in zip(one[a:b], two[c:d], strict=True)]
        else:
            known = {tuple(x[0]) for x in out}
            out += [[x[0], True, x[2]] for x in one[a:b]]
            out += [[y[0], True, y[2]] for y in two[c:d] if tuple(y[0]) not in known]
    return out


def merge(one: dict, two: dict) -> dict:
    """The wrapper of the pages of both."""
    out = dict(one)
    for path, own in two.items():
        out[path] = _joined(out[path], own) if path in out else own
    return out


def _joined(one: list, two: list) -> list:
    """What two wrappers have of one path."""
    (n, c, r, children, m, d), (pages, chars, crc, own, plain_pages, plain_chars) = one, two
    aligned = _general(_aligned(_general(children), _general(own)))
    return [n + pages, c + chars, r if r == crc else None, aligned, m + plain_pages, d + plain_chars]


def _general(children: list[list]) -> list[list]:
    """Children as they are, or, if they are too many for a template, one repeated group per tag of any marks."""
    if len(children) <= CHILDREN:
        return children
    names = sorted({_TEXT if n == _TEXT else _parts(n)[0] for c in children for n in c[0]})
    return [[(n,), True, True] for n in names]


def expression(wrapper: dict, path: str = "") -> str:
    """The wrapper as a union-free regular expression: ``(...)?`` optional, ``(...)+`` repeated, ``#`` a text slot."""
    out = []
    for names, optional, repeated in wrapper[path][3]:
        inner = []
        for name in names:
            below = f"{path}/{name}"
            inner.append("#" if name == _TEXT else f"<{name}>{expression(wrapper, below) if below in wrapper else ''}</>")
        text = "".join(inner)
        mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[optional, repeated]
        out.append(f"({text}){mark}" if mark else text)
    return "".join(out)


def _parts(name: str) -> tuple[str, set[str]]:
    tag, _, marks = name.rstrip("!").partition(".")
    return tag, set(marks.split("."))


def _is_other(name: str, inside_main: bool) -> bool:
    tag, words = _parts(name)
    if name.endswith("!") or tag in _DROPPED or words & _OTHER_WORDS or words & {"#all", "#ids"}:
        return True
    return not inside_main and (tag == "header" or "#id" in words or bool(words & _HEADER_WORDS))


class Standing(NamedTuple):
    """What the steps of a path say: is its text kept by an article, a main, an element marked so, or at all."""

    article: bool
    main: bool
    marked: bool
    clean: bool
    last_other: int  # number of the last step that is left out inside of a main part


@lru_cache(maxsize=1 << 16)
def standing(path: str) -> Standing:
    steps = path.split("/")[1:]
    outside = next((i for i, name in enumerate(steps, 1) if _is_other(name, False)), len(steps) + 1)
    last = max((i for i, name in enumerate(steps, 1) if _is_other(name, True)), default=0)

    def kept(fits) -> bool:
        root = next((i for i, name in enumerate(steps, 1) if fits(*_parts(name))), len(steps) + 1)
        return root < outside and root <= len(steps) and last <= root

    return Standing(
        kept(lambda tag, _: tag == "article"),
        kept(lambda tag, _: tag == "main"),
        kept(lambda tag, words: tag not in _PAGE and bool(words & _MAIN_WORDS)),
        outside > len(steps),
        last,
    )


def _credited(path: str) -> str | None:
    """The element that a paragraph's text counts for besides the paragraph."""
    parent, _, name = path.rpartition("/")
    return parent if path and _parts(name)[0] in _PARAGRAPHS else None


def page_rule(chars: dict[str, int]) -> tuple[int | None, list[str]]:
    """How the main part of a page is found, by its characters per path.

    ``(0, 1 or 2, [])``: by its articles, its main or elements marked so.  ``(3, paths)``: these
    may be the root, all clean; ``(4, paths)``: no path is clean.  ``(None, [])``: no text.
    """
    full = [p for p, n in chars.items() if n]
    for kind in range(3):
        if any(standing(p)[kind] for p in full):
            return kind, []
    clean = [p for p in full if standing(p).clean]
    if not full:
        return None, []
    paths = set(clean or full)
    paths.update(up for up in map(_credited, clean or full) if up is not None)
    return (3 if clean else 4), sorted(paths)


def shape_of(kind: int, paths: list[str]) -> str:
    return f"{kind}{hashlib.md5(chr(10).join(paths).encode('utf-8', 'replace')).hexdigest()}"


def heaviest(paths: list[tuple[str, float, float]]) -> str:
    """The root among ``(path, varying characters, all characters)`` of a mean page of the host.

    An element around the heaviest one that holds a good part as much itself is the root of both.
    """
    at = 1 if any(p[1] for p in paths) else 2
    root = min(paths, key=lambda p: (-p[at], len(p[0]), p[0]))
    around = [p[0] for p in paths if _under(root[0], p[0]) and p[at] >= root[at] / 4]
    return min(around, key=len)


def _under(path: str, root: str) -> bool:
    return path == root or path.startswith(root + "/")


def is_content(path: str, kind: int, root: str | None) -> bool:
    """Whether the text of a path belongs to the main part of a page with this rule."""
    own = standing(path)
    if kind < 3:
        return own[kind]
    if root is None or not _under(path, root):
        return False
    return kind == 4 or (own.last_other <= root.count("/") if root else own.clean)


def text_of(stream: list[tuple[str, str | None]], kind: int, root: str | None = None) -> str:
    """The main text of a page: white space is one space, blocks are joined by one."""
    kept: dict[str, bool] = {}
    out = []
    for path, text in stream:
        if text is not None:
            if path not in kept:
                kept[path] = is_content(path, kind, root)
            # A space from the element around separates blocks also where that element itself is left out.
            out.append(text if kept[path] else " ")
    return " ".join("".join(out).split())


def _chars(stream: list[tuple[str, str | None]]) -> dict[str, int]:
    chars: dict[str, int] = {}
    for path, text in stream:
        if text is not None and text and not text.isspace():
            chars[path] = chars.get(path, 0) + len(text)
    return chars


# --- tables ------------------------------------------------------------------


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


_ROWS = "h string, salt int, path string, pages long, chars long, crc long, children string, plain_pages long, plain_chars long"
_PARTS = pa.schema(
    [("h", pa.string()), ("salt", pa.int32()), ("path", pa.string())]
    + [(c, pa.int64()) for c in ("pages", "chars", "crc")]
    + [("children", pa.string())]
    + [(c, pa.int64()) for c in ("plain_pages", "plain_chars")]
)
_SHAPED = "shape string, paths array<string>"
_SHAPES = pa.schema([("shape", pa.string()), ("paths", pa.list_(pa.string()))])


def _row(part: dict) -> list:
    return [part[0], part[1], part[2], json.dumps(part[3]), part[4], part[5]]


def _merged(batches: Iterator[pa.RecordBatch], keep_salt: bool) -> Iterator[pa.RecordBatch]:
    """Rows of one host and path (and salt), which follow each other, as one."""
    schema = _PARTS if keep_salt else _PARTS.remove(1)
    key, whole, out, size = None, None, [], 0

    def flush():
        names = [f.name for f in schema]
        rows = [dict(zip([f.name for f in _PARTS], [*k, *_row(w)], strict=True)) for k, w in out]
        return pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema)

    for batch in batches:
        columns = [batch.column(f.name).to_pylist() for f in _PARTS]
        for h, salt, path, pages, chars, crc, children, plain_pages, plain_chars in zip(*columns, strict=True):
            new = [pages, chars, crc, json.loads(children), plain_pages, plain_chars]
            if (h, salt if keep_salt else 0, path) == key:
                whole = _joined(whole, new)
                continue
            if key is not None:
                out.append((key, whole))
                size += 1
            key, whole = (h, salt if keep_salt else 0, path), new
            if size >= 4096:
                yield flush()
                out, size = [], 0
    if key is not None:
        out.append((key, whole))
    if out:
        yield flush()


def wrapper_rows(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """The wrappers of all hosts, a row per host and path, and ``(h, shape, paths)`` of pages without a main element; stored."""
    source = bounded(pages).select(host_of(F.col(url_col)).alias("h"), F.coalesce(F.col(html_col), F.lit("")).alias("v"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % SALTS
        own: dict[str, dict] = {}
        shapes: dict[tuple[str, str], list[str]] = {}

        def out():
            rows = [[h, salt, path, *_row(w), None, None] for h, wrapper in own.items() for path, w in wrapper.items()]
            rows += [[h, salt, *[None] * 7, shape, paths] for (h, shape), paths in shapes.items()]
            names = [f.name for f in (*_PARTS, *_SHAPES)]
            for lo in range(0, len(rows), 4096):
                columns = zip(*rows[lo : lo + 4096], strict=True)
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, columns), strict=True)), pa.schema([*_PARTS, *_SHAPES]))

        held = 0
        for batch in batches:
            for part in slices(batch):
                for host, page in zip(part.column("h").to_pylist(), part.column("v").to_pylist(), strict=True):
                    stream = list(blocks(page))
                    kind, paths = page_rule(_chars(stream))
                    plain = bool(paths)
                    if plain and (host, shape_of(kind, paths)) not in shapes:
                        shapes[host, shape_of(kind, paths)] = paths
                        held += len(paths)
                    new = page_wrapper(page, stream, plain)
                    before = own.get(host, {})
                    held -= len(before)
                    own[host] = merge(before, new)
                    held += len(own[host])
                    if held > PATHS:
                        yield from out()
                        own.clear()
                        shapes.clear()
                        held = 0
        yield from out()

    spark = pages.sparkSession
    parts = stage(source.mapInArrow(work, f"{_ROWS}, {_SHAPED}"), staging_path(spark, "wrapper-parts"))
    rows = parts.where("path is not null").drop("shape", "paths")
    salted = rows.repartition("h", "path", "salt").sortWithinPartitions("h", "path", "salt")
    salted = salted.mapInArrow(lambda batches: _merged(batches, True), _ROWS)
    whole = salted.repartition("h", "path").sortWithinPartitions("h", "path")
    whole = whole.mapInArrow(lambda batches: _merged(batches, False), _ROWS.replace("salt int, ", ""))
    shapes = parts.where("shape is not null").select("h", "shape", "paths").dropDuplicates(["h", "shape"])
    return stage(whole, staging_path(spark, "wrappers")), shapes


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(host, pages, expression)`` per host."""
    rows, _ = wrapper_rows(pages, url_col, html_col)
    # What a single page of a host has is no part of its template; all of it stays in the rows.
    total = rows.where("path = ''").select("h", F.col("pages").alias("total"))
    rows = rows.join(total, "h").where("pages > 1 or total = 1").select("h", "path", "pages", "children")

    def work(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("path", "pages", "children")]
        wrapper = {path: [n, 0, None, json.loads(children)] for path, n, children in zip(*columns, strict=True)}
        return pa.table({"host": table.column("h")[:1], "pages": [wrapper[""][0]], "expression": [expression(wrapper)]})

    return rows.groupBy("h").applyInArrow(work, "host string, pages long, expression string")


def root_rules(rows: DataFrame, shapes: DataFrame) -> DataFrame:
    """``(h, shape, root)``: the root of the main part of all pages of a host with these paths."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("h", "path", "plain_pages", "plain_chars", "varies")),
                    pa.array([_credited(p) for p in paths], pa.string()),
                    pa.array([standing(p).clean for p in paths], pa.bool_()),
                ],
                ["h", "path", "plain_pages", "plain_chars", "varies", "up", "clean"],
            )

    kind = "h string, path string, plain_pages long, plain_chars long, varies boolean, up string, clean boolean"
    varies = (F.col("pages") == 1) | F.col("crc").isNull()
    known = rows.select("h", "path", "plain_pages", "plain_chars", varies.alias("varies"), "chars").where("plain_pages > 0")
    known = known.mapInArrow(described, kind)
    to = F.explode(F.expr("filter(array(struct(path AS p, plain_pages AS n), struct(up AS p, 0L AS n)), x -> x.p is not null)"))
    credit = known.select("h", "plain_chars", "varies", "clean", to.alias("to"), (F.col("to.p") == F.col("path")).alias("own"))
    mass = credit.groupBy("h", F.col("to.p").alias("path")).agg(
        F.max("to.n").alias("n"),
        *(
            F.sum(F.when(F.expr(c), F.col("plain_chars")).otherwise(0)).alias(name)
            for name, c in (("clean_varying", "clean and varies"), ("clean_all", "clean"), ("varying", "varies"), ("every", "true"))
        ),
    )
    salts = F.explode(F.array(*(F.lit(i) for i in range(SALTS))))
    mass = mass.select("*", salts.alias("salt"))
    asked = shapes.select("h", "shape", F.pmod(F.hash("shape"), F.lit(SALTS)).alias("salt"), F.explode("paths").alias("path"))
    # Paths that are left out elsewhere count for a host whose pages have no others.
    bare = rows.mapInArrow(_clean_chars, "h string, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n = 0").select("h")
    odd = asked.where("shape like '4%'").join(bare, "h", "left_semi")
    asked = asked.where("shape like '3%'").unionByName(odd.select(*asked.columns))
    first = F.col("shape").startswith("3")
    one = F.greatest(F.col("n"), F.lit(1))
    found = asked.join(mass, ["h", "path", "salt"]).groupBy("h", "shape").agg(
        F.collect_list(F.struct(
            "path",
            (F.when(first, F.col("clean_varying")).otherwise(F.col("varying")) / one).alias("varying"),
            (F.when(first, F.col("clean_all")).otherwise(F.col("every")) / one).alias("every"),
        )).alias("paths")
    )

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots = [heaviest([tuple(p.values()) for p in paths]) for paths in batch.column("paths").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("shape"), pa.array(roots, pa.string())], ["h", "shape", "root"])

    return stage(found.mapInArrow(choose, "h string, shape string, root string"), staging_path(rows.sparkSession, "roots"))


def _clean_chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(batch.column("path").to_pylist(), batch.column("chars").to_pylist(), strict=True)
        own = [n if any(standing(p)[:4]) else 0 for p, n in rows]
        yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array(own, pa.int64())], ["h", "n"])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text)`` of every page, by its own main element or the root that its host's wrapper gives for its paths."""
    rules = root_rules(*wrapper_rows(pages, url_col, html_col))
    source = bounded(pages).select(
        F.col(id_col).alias("k"), F.col(url_col).alias("u"), F.coalesce(F.col(html_col), F.lit("")).alias("v"),
        host_of(F.col(url_col)).alias("h"),
    )
    key = source.schema["k"].dataType.simpleString()

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of pages that need no rule, and the shape of the others."""
        for batch in batches:
            for part in slices(batch):
                texts, left, shapes, salts = [], [], [], []
                for page in part.column("v").to_pylist():
                    stream = list(blocks(page))
                    kind, paths = page_rule(_chars(stream))
                    crc = zlib.crc32(page.encode("utf-8", "replace"))
                    texts.append(None if paths else "" if kind is None else text_of(stream, kind))
                    left.append(page if paths else None)
                    shapes.append(shape_of(kind, paths) if paths else f"-{crc}")
                    salts.append(crc % SALTS)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(c) for c in "kuh"), pa.array(left, pa.string()), pa.array(shapes, pa.string()),
                        pa.array(salts, pa.int32()), pa.array(texts, pa.string()),
                    ],
                    ["k", "u", "h", "v", "shape", "salt", "text"],
                )

    def ruled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = []
                rows = zip(*(part.column(c).to_pylist() for c in ("v", "shape", "root", "text")), strict=True)
                for page, shape, root, text in rows:
                    texts.append(text if page is None else text_of(list(blocks(page)), int(shape[0]), root))
                yield pa.RecordBatch.from_arrays([part.column("k"), part.column("u"), pa.array(texts, pa.string())], ["k", "u", "text"])

    judged = source.mapInArrow(own, f"k {key}, u string, h string, v string, shape string, salt int, text string")
    salts = F.explode(F.array(*(F.lit(i) for i in range(SALTS))))
    joined = judged.join(rules.select("*", salts.alias("salt")), ["h", "shape", "salt"], "left").select("k", "u", "v", "shape", "root", "text")
    return joined.mapInArrow(ruled, f"k {key}, u string, text string").withColumnsRenamed({"k": id_col, "u": url_col})
