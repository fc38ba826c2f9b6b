"""HTML extraction with wrappers inferred from pages of one host.

A page becomes a stream of block tags and texts, properly nested. Per host, the streams of all pages are
aligned into a union-free regular expression, in groups dealt by hash whose wrappers are then aligned with one another: equal parts stay as they are, tags that only some pages
have become optional, adjacent repetitions (of one element or of a short series) become repeated groups, and texts that
differ become slots. The content element of the host is then the lowest one that holds all of the slots' text, outside
of parts marked as navigation, adverts, forms, comments and the like.

Every page is extracted whole with its host's content element; a page that lacks it is read by a wrapper of its own. Nesting may be of any depth, and reading takes time in proportion to the
page, also where tags, quotes or comments are never closed.
"""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections.abc import Callable, Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import small_side, stored
from .url_filter import host_of

#: Pages of a host that are aligned in one group, about, and wrappers of groups that are aligned together.
GROUP, MERGED = 256, 64
#: Pages a task aligns, as long as there are no more than so many tasks.
TASK_PAGES, TASKS = 4_000, 50_000
PERIOD = 4
#: Two series of siblings are aligned by their longest common series up to so many cells of its table; beyond it the n-th
#: item of a key on one side can only meet the n-th of that key on the other.
CELLS = 1 << 18

# Names of HTML elements by how they behave, and words that mark page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "canvas", "xmp")
BLOCKS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead "
    "tr caption ul").split())
FURNITURE_TAGS = frozenset(
    "aside button datalist dialog fieldset footer form head input label legend menu nav object option select".split())
FURNITURE_WORDS = frozenset((
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup "
    "promo promoted related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget").split())
FURNITURE_ROLES = frozenset("alert banner complementary contentinfo dialog form navigation search".split())
#: Elements that can be the content as a whole.
CONTAINERS = frozenset("html body main article div section table tbody tr center".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "tbody", "thead", "tfoot", "tr", "caption", "legend", "summary"}
#: Opening one of these ends an open one of the same set within the nearest list or table.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "tbody": {"tbody", "thead", "tr"},
            "tfoot": {"tbody", "thead", "tr"}, "option": {"option"}}
BARRIERS = frozenset("ul ol dl table menu".split())
#: What a paragraph that is left open can't be closed across.
HOLDS_P = BARRIERS | {"li", "div", "article", "section"}

_NAME_END, _STOP = re.compile(r"[\s/>]"), re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_PART = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    """A block element of a page or of a wrapper. ``items``: elements and texts (str; None is a slot) in order."""

    __slots__ = ("key", "tag", "furniture", "items", "link", "optional", "repeated", "mass")

    def __init__(self, key: str, tag: str, furniture: bool = False):
        self.key, self.tag, self.furniture = key, tag, furniture
        self.items: list = []
        self.link = 0  # characters of text within links
        self.optional = self.repeated = False
        self.mass = 0  # characters seen in slots directly within


def _opened(tag: str, attributes: str, inside_article: bool) -> Element:
    key, furniture = tag, tag in FURNITURE_TAGS or tag == "header" and not inside_article
    if attributes and "=" in attributes or "hidden" in attributes:
        for name, *values in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name not in ("class", "id", "role", "hidden"):
                continue
            value = html.unescape("".join(values))
            if name == "hidden":
                furniture = furniture or not value
            elif name == "role":
                furniture = furniture or value.lower() in FURNITURE_ROLES
            else:
                words = _PART.split(_CAMEL.sub(" ", value).lower())
                if tag not in ("html", "body", "article", "main") or "comment" in words:
                    furniture = furniture or not FURNITURE_WORDS.isdisjoint(words)
                if name == "class" and value.strip():
                    key = tag + "." + value.split()[0]
    return Element(key, tag, furniture)


def _finder(page: str, pattern: str | re.Pattern) -> Callable[[int], int]:
    """Where the pattern is next from a place on (the page's length: nowhere). Asked for rising places, it reads the page
    once in all."""
    since = found = -1

    def find(at: int) -> int:
        nonlocal since, found
        if not since <= at <= found or since < 0:
            if isinstance(pattern, str):
                hit = page.find(pattern, at)
            else:
                hit = match.start() if (match := pattern.search(page, at)) else -1
            since, found = at, hit if hit >= 0 else len(page)
        return found

    return find


def _tags(page: str) -> Generator[tuple[int, int, bool, str, str], int | None, None]:
    """Start, end, whether it closes, lower-case name and attributes of each tag; comments and declarations have no name.
    A ``<`` that begins none of them, or whose tag never ends, is text. Sending a place goes on from there."""
    size, at = len(page), 0
    opening, name_end, angle = _finder(page, "<"), _finder(page, _NAME_END), _finder(page, ">")
    stop, quotes = _finder(page, _STOP), {q: _finder(page, q) for q in "\"'"}
    endless: set[int] = set()  # quotes after which no tag that is open there ends
    while (start := opening(at)) < size:
        at = start + 1
        close = page.startswith("/", at)
        first = page[at + close:at + close + 1]
        found = None
        if page.startswith("!--", at):
            end = page.find("-->", at + 3)
            found = start, end + 3 if end >= 0 else size, False, "", ""
        elif first.isascii() and first.isalpha():
            place = begin = name_end(at + close)
            seen = []
            while (place := stop(place)) < size and page[place] != ">":
                if place in endless:
                    place = size
                    break
                seen.append(place)
                place = quotes[page[place]](place + 1) + 1
            if place < size:
                found = start, place + 1, close, page[at + close:begin].lower(), page[begin:place]
            else:
                endless.update(seen)
        elif first in ("!", "?") and not close and (end := angle(at)) < size:
            found = start, end + 1, False, "", ""
        if found:
            further = yield found
            at = found[1] if further is None else further


def parse(page: str) -> Element:
    """The nested blocks of a page; inline tags vanish, scripts, styles and comments with their content."""
    root = Element("#", "#")
    stack, text, links, articles = [root], [], 0, 0
    places: dict[str, list[int]] = {}  # where each tag stands in the stack
    at = 0

    def flush() -> None:
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            text.clear()
            if joined:
                stack[-1].items.append(joined)

    def deepest(names) -> int:
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    def close(upto: int) -> None:
        nonlocal articles
        flush()
        while len(stack) > upto:
            gone = stack.pop().tag
            places[gone].pop()
            articles -= gone == "article"

    tags = _tags(page)
    found = next(tags, None)
    while found:
        start, end, closes, name, attributes = found
        if start > at:
            piece = page[at:start]
            text.append(piece)
            if links:
                stack[-1].link += len(piece)
        at, further = end, None
        if not name:
            pass  # comment or declaration
        elif closes:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCKS or name in FURNITURE_TAGS:
                depth, barrier = deepest((name,)), deepest(BARRIERS) if name in SIBLINGS else 0
                if depth > barrier:
                    close(depth)
                elif not barrier:
                    flush()
        elif name in RAW:
            if not attributes.endswith("/"):
                ending = _RAW_END[name].search(page, at)
                at = further = ending.end() if ending else len(page)
        elif name == "a":
            links += 1
        elif name in VOID:
            if name == "hr":
                flush()
            else:
                text.append(" ")
        elif name in BLOCKS or name in FURNITURE_TAGS:
            if name in CLOSES_P and (depth := deepest("p")) > deepest(HOLDS_P):
                close(depth)
            if name in SIBLINGS and (depth := deepest(SIBLINGS[name])) > deepest(BARRIERS):
                close(depth)
            flush()
            element = _opened(name, attributes, articles > 0)
            articles += name == "article"
            stack[-1].items.append(element)
            places.setdefault(name, []).append(len(stack))
            stack.append(element)
            links = 0
        elif name in ("td", "th"):
            text.append(" ")
        try:
            found = tags.send(further)
        except StopIteration:
            found = None
    text.append(page[at:])
    flush()
    return root


def _down(element: Element, into: Callable[[Element], bool] = lambda element: True) -> list[Element]:
    """An element and all below it, parents first; ``into`` says which elements below count, with all that they hold."""
    out, waiting = [], [element]
    while waiting:
        out.append(waiting.pop())
        waiting += [i for i in out[-1].items if isinstance(i, Element) and into(i)]
    return out


def _result(call: Generator):
    """What a generator returns that yields its inner calls: recursion of any depth."""
    calls, value = [call], None
    while calls:
        try:
            calls.append(calls[-1].send(value))
            value = None
        except StopIteration as done:
            calls.pop()
            value = done.value
    return value


def _key(item) -> str:
    return item.key if isinstance(item, Element) else "#text"


def _matches(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common series of two series of keys, both rising."""
    rows, columns = len(a), len(b)
    if rows * columns > CELLS:
        at: dict[tuple[str, int], int] = {}
        count: dict[str, int] = {}
        for j, key in enumerate(b):
            count[key] = count.get(key, 0) + 1
            at[key, count[key]] = j
        count, ends, last, back = {}, [], [], {}
        for i, key in enumerate(a):  # the longest rising series
            count[key] = count.get(key, 0) + 1
            j = at.get((key, count[key]))
            if j is not None:
                k = bisect_left(ends, j)
                ends[k:k + 1], last[k:k + 1] = [j], [(i, j)]
                back[i, j] = last[k - 1] if k else None
        out, pair = [], last[-1] if last else None
        while pair:
            out.append(pair)
            pair = back[pair]
        return out[::-1]
    best = [[0] * (columns + 1) for _ in range(rows + 1)]
    for i in range(rows - 1, -1, -1):
        for j in range(columns - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < rows and j < columns:
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def _align_items(left: list, right: list) -> Generator:
    """Merge two series of items: matches by key in order (longest common series), the rest becomes optional."""
    a, b = [_key(i) for i in left], [_key(i) for i in right]
    least, begin, end = min(len(a), len(b)), 0, 0
    while begin < least and a[begin] == b[begin]:
        begin += 1
    while end < least - begin and a[-1 - end] == b[-1 - end]:
        end += 1
    inner = _matches(a[begin:len(a) - end], b[begin:len(b) - end])
    pairs = [(k, k) for k in range(begin)] + [(begin + i, begin + j) for i, j in inner]
    pairs += [(len(a) - k, len(b) - k) for k in range(end, 0, -1)]
    out, i, j = [], 0, 0
    for x, y in pairs:
        out += [_maybe(item) for item in left[i:x] + right[j:y]]
        out.append((yield _align(left[x], right[y])))
        i, j = x + 1, y + 1
    out += [_maybe(item) for item in left[i:] + right[j:]]
    return (yield _folded(out))


def _maybe(item):
    if isinstance(item, Element):
        item.optional = True
        return item
    return None  # a text that some pages lack is a slot that may be empty


def _align(left, right) -> Generator:
    """One wrapper item from two with the same key."""
    if not isinstance(left, Element):
        return left if left == right else None
    texts = [[i for i in side.items if isinstance(i, str)] for side in (left, right)]
    left.mass += right.mass + sum(
        len(i) for own, other in (texts, texts[::-1]) for known in (set(other),) for i in own if i not in known)
    left.link += right.link
    left.optional |= right.optional
    left.repeated |= right.repeated
    left.items = yield _align_items(left.items, right.items)
    return left


def _folded(items: list) -> Generator:
    """Adjacent repetitions of up to ``PERIOD`` elements become one repeated element or group."""
    for period in range(1, PERIOD + 1):
        out: list = []
        for item in items:
            out.append(item)
            while len(out) >= 2 * period:
                first, second = out[-2 * period:-period], out[-period:]
                if [_key(i) for i in first] != [_key(i) for i in second] or not all(
                        isinstance(i, Element) for i in first + second):
                    break
                merged = []
                for x, y in zip(first, second):
                    merged.append((yield _align(x, y)))
                for element in merged:
                    element.repeated = True
                out[-2 * period:] = merged
        items = out
    return items


def _wrapper(root: Element) -> Element:
    """A page as a first wrapper: repetitions folded, from the leaves up."""
    for element in reversed(_down(root)):
        element.items = _result(_folded(element.items))
    return root


def infer(pages: list[str]) -> Element:
    """The wrapper of some pages."""
    wrapper = _wrapper(parse(pages[0]))
    for page in pages[1:]:
        wrapper = _result(_align(wrapper, _wrapper(parse(page))))
    return wrapper


def expression(item) -> str:
    """The wrapper as a regular expression: ``?`` optional, ``+`` repeated, ``_`` a slot."""

    def written(item) -> Generator:
        if not isinstance(item, Element):
            return "_" if item is None else re.escape(item)
        parts = []
        for inner in item.items:
            parts.append((yield written(inner)))
        sign = ("*" if item.optional else "+") if item.repeated else "?" if item.optional else ""
        whole = f"<{item.key}> {' '.join(parts)} </{item.tag}>"
        return f"({whole}){sign}" if sign else whole

    return _result(written(item))


def content_path(wrapper: Element, pages: int) -> list[str]:
    """Keys from the root to the lowest element that holds all text of slots outside furniture (all texts, where there is
    but one page). Elements whose own text is in links don't count, as long as there are others."""

    def weighed(links: bool) -> int:
        for element in reversed(_down(wrapper, lambda e: not e.furniture)):
            own = element.mass + sum(len(i) for i in element.items if isinstance(i, str)) * (pages == 1)
            weights[id(element)] = (own if links or own > element.link else 0) + sum(
                weights[id(i)] for i in element.items if isinstance(i, Element) and not i.furniture)
        return weights[id(wrapper)]

    weights: dict[int, int] = {}
    whole = weighed(False) or weighed(True)
    path, element = [], wrapper
    while True:
        inner = [i for i in element.items if isinstance(i, Element) and not i.furniture and i.tag in CONTAINERS]
        found = next((i for i in inner if whole and weights[id(i)] == whole), None)
        if found is None:
            return path
        path.append(found.key)
        element = found


def _blocks(element: Element) -> Iterator[str]:
    waiting = [element]
    while waiting:
        item = waiting.pop()
        if isinstance(item, str):
            yield item
        else:
            waiting += reversed([i for i in item.items if isinstance(i, str) or not i.furniture])


def _at(element: Element, path: list[str]) -> list[Element]:
    found = [element]
    for key in path:
        found = [i for e in found for i in e.items if isinstance(i, Element) and i.key == key and not i.furniture]
    return found


def extract(page: str, path: list[str] | None) -> str:
    """Blocks of the content element, joined by an empty line. Without one at ``path``, by the page's own wrapper."""
    tree = parse(page)
    found = _at(tree, path) if path is not None else []
    if not found:
        found = _at(tree, content_path(_wrapper(parse(page)), 1))
    return "\n\n".join(block for element in found for block in _blocks(element))


def packed(wrapper: Element) -> str:
    """A wrapper as text: its items, parents first, each element with the number of items it holds."""
    out, waiting = [], [wrapper]
    while waiting:
        item = waiting.pop()
        if isinstance(item, Element):
            out.append([item.key, item.tag, item.furniture, item.link, item.optional, item.repeated, item.mass, len(item.items)])
            waiting += reversed(item.items)
        else:
            out.append(item)
    return json.dumps(out)


def unpacked(text: str) -> Element:
    root, stack = None, []  # elements whose items are not complete, with how many they lack
    for item in json.loads(text):
        lacks = 0
        if isinstance(item, list):
            *own, link, optional, repeated, mass, lacks = item
            item = Element(*own)
            item.link, item.optional, item.repeated, item.mass = link, optional, repeated, mass
        if stack:
            stack[-1][0].items.append(item)
            stack[-1][1] -= 1
        root = root or item
        if lacks:
            stack.append([item, lacks])
        while stack and not stack[-1][1]:
            stack.pop()
    return root


def _aligned(rows: DataFrame, tasks: int, single: bool) -> DataFrame:
    """``rows`` (host, part, place, pages, body) as wrappers (host, part, pages, body), one for each host and part, whose
    rows are aligned in order of ``place``. ``single``: bodies are pages, else packed wrappers; equal pages, which have
    one place, count once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, wrapper, pages, place = None, None, 0, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([last[0]]), pa.array([last[1]], pa.int64()), pa.array([pages], pa.int64()),
                 pa.array([packed(wrapper)])], ["host", "part", "pages", "body"])

        for batch in batches:
            for host, part, at, n, body in zip(*(c.to_pylist() for c in batch.columns)):
                if (host, part) == last and at == place:
                    continue
                own = _wrapper(parse(body)) if single else unpacked(body)
                if (host, part) == last:
                    wrapper, pages = _result(_align(wrapper, own)), pages + n
                else:
                    if last:
                        yield done()
                    last, wrapper, pages = (host, part), own, n
                place = at
        if last:
            yield done()

    return rows.select("host", "part", "place", "pages", "body").repartition(tasks, "host", "part").sortWithinPartitions(
        "host", "part", "place").mapInArrow(run, "host string, part long, pages long, body string")


def _paths(wrappers: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in wrappers:
        found = [json.dumps(content_path(unpacked(body), n)) for n, body in zip(
            batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["host", "path"])


def infer_hosts(named: DataFrame) -> DataFrame:
    """From all pages (host, html, mark: hash of the html) the path of each host's content element (host, path). A page's
    hash says which group it is in and where, so the result doesn't depend on how rows are dealt."""
    pages = named.where("length(html) > 0")
    counts = stored(pages.groupBy("host").agg(F.count("*").alias("n")).withColumn(
        "groups", F.ceil(F.col("n") / GROUP)), "host-pages")
    total, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("groups"), F.lit(0))).first()
    tasks = lambda n: min(TASKS, max(8, n // TASK_PAGES))
    rows = pages.join(small_side(counts.select("host", "groups"), 256), "host").select(
        "host", F.pmod("mark", "groups").alias("part"), F.col("mark").alias("place"), F.lit(1).cast("long").alias("pages"),
        F.col("html").alias("body"))
    found = stored(_aligned(rows, tasks(total), True), "wrappers")
    while most > 1:
        most, total = -(-most // MERGED), total // MERGED
        rows = found.select("host", F.floor(F.col("part") / MERGED).alias("part"), F.col("part").alias("place"), "pages", "body")
        found = stored(_aligned(rows, tasks(total), False), "wrappers")
    return stored(found.mapInArrow(_paths, "host string, path string"), "paths")


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Per page: page_id, url, text (main text, empty if none), n_chars.

    Null and empty html give an empty text. Pages with a null url are one host. Very long pages are read whole; copies
    and repeated rows are extracted alike; an empty table gives no rows; other columns are ignored.
    """
    named = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                         host_of(F.col(url_col)).alias("host"))
    paths = infer_hosts(named.select("host", "html", F.xxhash64("html").alias("mark")))
    joined = named.join(small_side(paths, 256), "host", "left").select("page_id", "url", "html", "path")
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                texts = []
                for page, path in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    if path is not None and path not in known:
                        known[path] = json.loads(path)
                    texts.append(extract(page, known.get(path)) if page else "")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
