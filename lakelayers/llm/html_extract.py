"""HTML extraction with wrappers: union-free regular expressions inferred from the pages of a host."""

from __future__ import annotations

import html
import json
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import map_arrow, stored
from lakelayers.llm.url_filter import host_of

# Different signatures of one host that are aligned in one group; the wrappers of the groups are aligned in turn.
FAN = 32
LONGEST_GROUP = 12
# Cells of one table of alignment; longer streams are cut at items that both have once.
CELLS = 1 << 20
# Text at one place of a host's pages is the template's if this share of the different pages have it, and so many.
TEMPLATE_SHARE = 0.8
TEMPLATE_PAGES = 4

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/a-zA-Z][^>]*\Z|([^<]+|<)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
NAMING = set("class id role itemprop".split())
WORDS = re.compile(r"[a-z0-9]+")

BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
# Left out with the elements in them.
SKIPPED = set("template object svg math".split())
RAW_ENDS = {tag: re.compile(rf"</{tag}(?![^\s/>])", re.I) for tag in RAW}
# Never part of the article, and what class or id names tell the same.
APART = set("nav header footer aside form menu dialog select button fieldset".split())
APART_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "overlay pagination pager paywall popup promo promoted promotion recommended related replies reply respond search "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split()
)
MAIN_NAMES = set("article articlebody content entry main maincontent post story".split())
# Parts behind which a name stays what it is, and parts that make it tell of something else (``has-sidebar``).
BOXES = set("area block box body container content inner item items link links list section slot text unit wrapper".split())
STATES = set("has have hide is no non not show with without".split())
# Their classes tell of the page or of its state.
NEVER_APART = set("html body main article".split())
# An open element of the first kind ends where one of the second begins.
ENDS = {
    "p": BLOCK, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"}, "option": {"option"},
}

Item = str | tuple[str, tuple]


def _named(tag: str, attributes: str) -> tuple[str, bool]:
    """The element's telling name as a suffix, and whether it is apart from the article.

    A word of class or id tells by the whole of it or by its last part, a ``sidebar-box`` is a ``sidebar``.
    """
    words: set[str] = set()
    given: dict[str, str] = {}
    for name, value in ATTRIBUTE.findall(attributes):
        given.setdefault(name.lower(), value.strip("\"'").lower())
    if "hidden" in given or given.get("aria-hidden") == "true":
        return ".hidden", True
    if tag in ("html", "body"):
        return "", False
    for name in NAMING & given.keys():
        for word in given[name].split():
            parts = WORDS.findall(word)
            if not parts or STATES.intersection(parts):
                continue
            words.add("".join(parts))
            while len(parts) > 1 and parts[-1] in BOXES:
                parts.pop()
            words.add(parts[-1])
    apart = sorted(words & APART_NAMES)
    if apart and tag not in NEVER_APART:
        return f".{apart[0]}", True
    main = sorted(words & MAIN_NAMES)
    return (f".{main[0]}", False) if main else ("", False)


def _tokens(page: str) -> Iterator[re.Match]:
    """The tokens of the page; what stands in a raw element is none, up to its literal end tag."""
    at: int | None = 0
    while at is not None:
        start, at = at, None
        for match in TOKEN.finditer(page, start):
            yield match
            end, tag, attributes = (match[1], match[2], match[3]) if match[2] else match.group(4, 5, 6)
            if tag is not None and not end and not attributes.endswith("/") and tag.lower() in RAW:
                closed = RAW_ENDS[tag.lower()].search(page, match.end())
                at = closed.start() if closed else None
                break


def events(page: str) -> Iterator[tuple[str, str]]:
    """``("open", name)``, ``("close", name)`` of block elements and ``("text", text)``, nested properly.

    A name is the tag with a telling class or id behind a dot, and ``!`` before it if the element is apart from
    any article. Inline elements are no events, their text goes on; a line break is a blank.
    """
    stack: list[str] = []
    tags: list[str] = []
    skip_to, nested = "", 0
    for match in _tokens(page):
        text = match[7]
        if text is not None:
            if not skip_to:
                yield "text", text
            continue
        end, tag = (match[1], match[2]) if match[2] else (match[4], match[5])
        if tag is None:
            continue
        tag = tag.lower()
        if skip_to:
            if tag == skip_to:
                nested += -1 if end else 1
                skip_to = skip_to if nested > 0 else ""
            continue
        attributes = match[3] or match[6] or ""
        # A head needs no end tag: what may stand in it has no text, so text or a block is the body's.
        if tag in RAW or tag == "head":
            continue
        if tag in SKIPPED:
            if not end and not attributes.endswith("/"):
                skip_to, nested = tag, 1
            continue
        if tag == "br":
            yield "text", " "
            continue
        if tag not in BLOCK and (end or not _named(tag, attributes)[1] or tag in VOID):
            if end and tag in tags[-1:]:
                tags.pop()
                yield "close", stack.pop()
            continue
        if end:
            if tag in tags:
                while tags:
                    last = tags.pop()
                    yield "close", stack.pop()
                    if last == tag:
                        break
            continue
        while tags and tag in ENDS.get(tags[-1], ()):
            tags.pop()
            yield "close", stack.pop()
        if tag == "hr":
            yield "open", "hr"
            yield "close", "hr"
            continue
        suffix, apart = _named(tag, attributes)
        name = f"{'!' if apart or tag in APART else ''}{tag}{suffix}"
        stack.append(name)
        tags.append(tag)
        yield "open", name
    while stack:
        yield "close", stack.pop()


def blocks(page: str) -> Iterator[tuple[tuple[str, ...], str]]:
    """The path of names and the text of every block that has text, in page order."""
    path: list[str] = []
    parts: list[str] = []
    for kind, value in events(page):
        if kind == "text":
            parts.append(value)
            continue
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            parts = []
            if text:
                yield tuple(path), text
        if kind == "open":
            path.append(value)
        else:
            path.pop()
    text = " ".join(html.unescape("".join(parts)).split())
    if text:
        yield tuple(path), text


def signature(page: str) -> tuple[Item, ...]:
    """The page's tokens (elements opened and closed, ``#`` for text) with repetitions folded into groups."""
    stream: list[Item] = []
    for kind, value in events(page):
        if kind == "text":
            if value.strip() and (not stream or stream[-1] != "#"):
                stream.append("#")
        else:
            stream.append(value if kind == "open" else f"/{value}")
    return folded(stream)


def folded(stream: Iterable[Item]) -> tuple[Item, ...]:
    """Adjacent repetitions as ``("+", body)``, the shortest bodies first, until nothing repeats."""
    codes: dict[Item, str] = {}
    items: list[Item] = []

    def code(item: Item) -> str:
        if item not in codes:
            codes[item] = chr(0xE000 + len(items)) if len(items) < 0x1000 else chr(0xF0000 + len(items))
            items.append(item)
        return codes[item]

    def group(match: re.Match) -> str:
        return code(("+", tuple(_item(c) for c in match[1])))

    def _item(char: str) -> Item:
        at = ord(char)
        return items[at - 0xE000 if at < 0xF0000 else at - 0xF0000]

    text = "".join(map(code, stream))
    for _ in range(8):
        shorter = re.sub(rf"(.{{1,{LONGEST_GROUP}}}?)\1+", group, text, flags=re.S)
        # An occurrence next to its own group joins it.
        for item in list(items):
            if isinstance(item, tuple) and item[0] == "+":
                body, own = "".join(map(code, item[1])), codes[item]
                shorter = re.sub(rf"(?:{re.escape(body)})*(?:{own}(?:{re.escape(body)})*)+", own, shorter)
        if shorter == text:
            break
        text = shorter
    return tuple(_item(c) for c in text)


def _unified(a: Item, b: Item) -> Item | None:
    """One item for both: equal, a group or option of aligned bodies; None if there is none."""
    if a == b:
        return a
    if isinstance(a, tuple) and isinstance(b, tuple) and a[0] == b[0]:
        return (a[0], aligned(a[1], b[1])) if _head(a[1]) == _head(b[1]) else None
    for one, other in ((a, b), (b, a)):
        if isinstance(one, tuple) and len(one[1]) == 1:
            both = _unified(one[1][0], other)
            if both is not None:
                return one[0], (both,)
    return None


def _matches(a: tuple[Item, ...], b: tuple[Item, ...], i: int, j: int) -> tuple[Item, int, int] | None:
    """What ``a`` from ``i`` and ``b`` from ``j`` have in common, and how many items of each it takes."""
    both = _unified(a[i], b[j])
    if both is not None:
        return both, 1, 1
    # A group or option meets its own body written out.
    if isinstance(a[i], tuple) and a[i][1] == b[j : j + len(a[i][1])]:
        return a[i], 1, len(a[i][1])
    if isinstance(b[j], tuple) and b[j][1] == a[i : i + len(b[j][1])]:
        return b[j], len(b[j][1]), 1
    return None


def _head(body: tuple[Item, ...]) -> str:
    first = body[0]
    return _head(first[1]) if isinstance(first, tuple) else first


def aligned(a: tuple[Item, ...], b: tuple[Item, ...]) -> tuple[Item, ...]:
    """The wrapper of both: items that match in order stay, what only one side has becomes optional."""
    if a == b:
        return a
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    stop = 0
    while stop < min(len(a), len(b)) - start and a[-1 - stop] == b[-1 - stop]:
        stop += 1
    left, right = a[start : len(a) - stop], b[start : len(b) - stop]
    if len(left) * len(right) > CELLS:
        return (*a[:start], *_cut(left, right), *a[len(a) - stop :])
    # Longest common subsequence of items that match.
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    match: dict[tuple[int, int], tuple[Item, int, int]] = {}
    for i in range(len(left) - 1, -1, -1):
        for j in range(len(right) - 1, -1, -1):
            both = _matches(left, right, i, j)
            best[i][j] = max(best[i + 1][j], best[i][j + 1])
            if both is not None:
                match[i, j] = both
                best[i][j] = max(best[i][j], max(both[1:]) + best[i + both[1]][j + both[2]])
    out: list[Item] = list(a[:start])
    i = j = 0
    only: tuple[list[Item], list[Item]] = ([], [])

    def flush() -> None:
        for side in only:
            if side:
                whole = len(side) == 1 and isinstance(side[0], tuple) and side[0][0] == "?"
                out.append(side[0] if whole else ("?", tuple(side)))
                side.clear()

    while i < len(left) or j < len(right):
        both = match.get((i, j))
        if both and best[i][j] == max(both[1:]) + best[i + both[1]][j + both[2]]:
            flush()
            out.append(both[0])
            i, j = i + both[1], j + both[2]
        elif j == len(right) or i < len(left) and best[i][j] == best[i + 1][j]:
            only[0].append(left[i])
            i += 1
        else:
            only[1].append(right[j])
            j += 1
    flush()
    out += a[len(a) - stop :]
    return tuple(out)


def _cut(left: tuple[Item, ...], right: tuple[Item, ...]) -> tuple[Item, ...]:
    """Both aligned between the items that either has once and in the same order; without any, each is optional."""
    once = [{x for x, n in Counter(side).items() if n == 1} for side in (left, right)]
    place = {x: j for j, x in enumerate(right) if x in once[0] & once[1]}
    # Longest rising run of places: patience sorting, with the pile below for each item.
    tops: list[int] = []
    kept: list[tuple[int, int, int]] = []
    ends: list[int] = []
    for i, x in enumerate(left):
        if x in place:
            pile = bisect_left(tops, place[x])
            tops[pile : pile + 1] = [place[x]]
            ends[pile : pile + 1] = [len(kept)]
            kept.append((i, place[x], ends[pile - 1] if pile else -1))
    anchors: list[tuple[int, int]] = []
    at = ends[-1] if ends else -1
    while at >= 0:
        anchors.append(kept[at][:2])
        at = kept[at][2]
    if not anchors:
        return ("?", left), ("?", right)
    out: list[Item] = []
    i = j = 0
    for x, y in [*anchors[::-1], (len(left), len(right))]:
        out += aligned(left[i:x], right[j:y])
        out += left[x : x + 1]
        i, j = x + 1, y + 1
    return tuple(out)


def slots(wrapper: tuple[Item, ...], path: tuple[str, ...] = (), repeated: bool = False) -> Iterator[tuple[tuple[str, ...], bool]]:
    """Path of every text slot of the wrapper, and whether it lies in a repeated group."""
    open_: list[str] = list(path)
    for item in wrapper:
        if isinstance(item, tuple):
            yield from slots(item[1], tuple(open_), repeated or item[0] == "+")
        elif item == "#":
            yield tuple(open_), repeated
        elif item.startswith("/"):
            if item[1:] in open_:
                while open_.pop() != item[1:]:
                    pass
        else:
            open_.append(item)


def _by_tag(name: str) -> bool:
    return name.startswith("!") and name[1:].split(".")[0] in APART - {"form"}


def _aparts(path: tuple[str, ...]) -> int:
    return sum(x.startswith("!") for x in path)


def _last_apart(path: tuple[str, ...]) -> int:
    return max((i for i, x in enumerate(path) if x.startswith("!")), default=-1)


def main_container(wrapper: tuple[Item, ...], weights: dict[tuple[str, ...], int]) -> tuple[str, ...]:
    """Path of the element whose text slots are the article.

    The outermost article or main element, by tag or by class or id; without one, the element whose own slots and
    paragraphs hold the most text on the host's pages, those in repeated groups before others. Slots apart from
    articles do not count. If there are no others, those in the fewest elements that only their class or id, or a
    form around the whole page, sets apart do.
    """
    every = [(p, r) for p, r in slots(wrapper) if not any(map(_by_tag, p))]
    fewest = min((_aparts(p) for p, _ in every), default=0)
    free = [(p, r) for p, r in every if _aparts(p) == fewest]
    for wanted in (lambda x: x.split(".")[0] in ("article", "main"), lambda x: "." in x):
        found: Counter[tuple[str, ...]] = Counter()
        for path, _ in free:
            at = next((i for i, x in enumerate(path) if wanted(x)), None)
            if at is not None:
                at = max(at, _last_apart(path))
                found[path[: at + 1]] += weights.get(path, 0) + 1
        if found:
            return max(sorted(found), key=lambda p: found[p])
    found = Counter()
    for path, repeated in free:
        container = path
        while len(container) > _last_apart(path) + 1 and container[-1].split(".")[0] not in ("div", "section", "td", "body", "center"):
            container = container[:-1]
        found[container] += (weights.get(path, 0) + 1) * (2 if repeated else 1)
    return max(sorted(found), key=lambda p: found[p]) if found else ()


def place_of(path: tuple[str, ...], text: str) -> int:
    """What tells a text at its place in a page, as a signed long."""
    found = xxhash.xxh64_intdigest("\t".join((*path, "", text)).encode("utf-8", "surrogatepass"))
    return found - (1 << 64) if found >> 63 else found


def article(page: str, container: tuple[str, ...] | None, template: frozenset[int] = frozenset()) -> str:
    """The text under the container, without what is apart and without the template's text.

    A page that lacks the container is judged by its own wrapper. A page whose whole text is the template's keeps it.
    """
    found = list(blocks(page))
    if template:
        found = [block for block in found if place_of(*block) not in template] or found

    def under(top: tuple[str, ...]) -> list[str]:
        return [text for path, text in found if path[: len(top)] == top and not _aparts(path[len(top) :])]

    texts = [] if container is None else under(container)
    if found and not texts:
        weights: Counter[tuple[str, ...]] = Counter()
        for path, text in found:
            weights[path] += len(text)
        texts = under(main_container(signature(page), weights))
    return "\n\n".join(texts)


def _decoded(value: object) -> Item:
    return value if isinstance(value, str) else (value[0], tuple(map(_decoded, value[1])))


def _read(text: str) -> tuple[Item, ...]:
    return tuple(map(_decoded, json.loads(text)))


def wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host, wrapper, container, pages, template``: the expression of each host's pages, where in it the article is, and
    which text is not a slot but part of the template.

    Pages send their signature and the text length under each path, and a hash of each text at its place. Equal
    signatures are summed before they are shuffled. The different signatures of a host are aligned as a tree: groups of about ``FAN`` of
    them, then the wrappers of the groups, until one is left, so that a host with a third of the pages is as many
    tasks as its signatures ask for. Text that most different pages of a host have at the same place is equal in the
    alignment and belongs to the template; what differs is a slot.
    """

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, str], list] = {}
            texts: list[tuple] = []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kept = found.setdefault((host, json.dumps(signature(page or ""), ensure_ascii=False)), [0, Counter()])
                kept[0] += 1
                places = set()
                for path, text in blocks(page or ""):
                    kept[1]["\t".join(path)] += len(text)
                    places.add(place_of(path, text))
                whole = place_of((), page or "")
                texts += [(host, None, None, None, place, whole) for place in places]
            rows = [(*k, n, json.dumps(w, ensure_ascii=False), None, None) for k, (n, w) in found.items()]
            yield _rows(rows + texts, [*columns, "place", "page"])

    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, wrapper, n, weights = None, (), 0, Counter()
        seen: set[str] = set()
        for batch in batches:
            for host, branch, text, pages_, weighed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (host, branch) != group:
                    if group is not None:
                        yield _rows([(group[0], json.dumps(wrapper), n, json.dumps(weights))], columns)
                    group, wrapper, n, weights = (host, branch), _read(text), 0, Counter()
                    seen.clear()
                elif text not in seen:
                    wrapper = aligned(wrapper, _read(text))
                seen.add(text)
                n += pages_
                weights.update(json.loads(weighed))
        if group is not None:
            yield _rows([(group[0], json.dumps(wrapper), n, json.dumps(weights))], columns)

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in merged(batches):
            host, wrapper, n, weights = (c[0].as_py() for c in part.columns)
            weights = {tuple(k.split("\t")) if k else (): v for k, v in json.loads(weights).items()}
            container = main_container(_read(wrapper), weights)
            yield _rows([(host, wrapper, json.dumps(container, ensure_ascii=False), n)], ["host", "wrapper", "container", "pages"])

    columns = ["host", "wrapper", "n", "weights"]
    schema = "host string, wrapper string, n long, weights string"
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    parts = stored(map_arrow(rows, signed, f"{schema}, place long, page long"), "signed")
    level = parts.filter("wrapper IS NOT NULL").select(*columns)
    while True:
        widths = level.groupBy("host").agg(F.ceil(F.count_distinct("wrapper") / FAN).cast("int").alias("width"))
        widths = stored(widths, "widths")
        if widths.filter("width > 1").isEmpty():
            break
        # One row per host: sent along if it is small, else a hot host's signatures are split.
        branch = F.pmod(F.xxhash64("wrapper"), F.col("width")).cast("int").alias("branch")
        widths = widths.withColumnRenamed("host", "_host")
        dealt = level.join(widths, F.col("host").eqNullSafe(F.col("_host"))).select("host", branch, "wrapper", "n", "weights")
        dealt = dealt.repartition("host", "branch").sortWithinPartitions("host", "branch", "wrapper", "weights")
        level = stored(map_arrow(dealt, merged, schema), "merged")
    last = level.select("host", F.lit(0).alias("branch"), "wrapper", "n", "weights")
    last = last.repartition("host").sortWithinPartitions("host", "wrapper", "weights")
    found = map_arrow(last, chosen, "host string, wrapper string, container string, pages long")
    template = _template(parts.filter("wrapper IS NULL"))
    return found.join(template, found["host"].eqNullSafe(template["_host"]), "left").drop("_host")


def _template(texts: DataFrame) -> DataFrame:
    """``_host, template``: the texts by place that most different pages of a host have, not many more than a page has.

    Counts of different pages go over ``(host, place, page)`` first, so a text that is on every page of a hot host is many tasks'.
    """
    pages = texts.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("whole"))
    counted = texts.groupBy("host", "place").agg(F.count_distinct("page").alias("n")).filter(F.col("n") >= TEMPLATE_PAGES)
    pages = pages.withColumnRenamed("host", "_host")
    common = counted.join(pages, F.col("host").eqNullSafe(F.col("_host"))).filter(F.col("n") >= TEMPLATE_SHARE * F.col("whole"))
    return common.groupBy("_host").agg(F.collect_list("place").alias("template"))


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = dict.fromkeys(("n", "pages", "place", "page"), pa.int64())
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for c, n in zip(columns, names, strict=True)], names)


def main_texts(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id, url, text`` of every page: the article's blocks, joined by two line feeds.

    A block is the text between block elements, with character references decoded and white space made one
    blank. Text that at least ``TEMPLATE_SHARE`` of the different pages of a host have at the same place, and ``TEMPLATE_PAGES``
    of them, is no article. Memory for a page follows its blocks and their depth. A null or empty html has an empty text. Pages without host (null url) are one host. Repeated rows
    get the same result, an empty table gives an empty table.
    """
    learned = stored(wrappers(pages, url_col, html_col), "wrappers")

    def extracted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            templates: dict[tuple, frozenset[int]] = {}
            for page, container, template in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                own = tuple(template or ())
                known = templates.setdefault(own, frozenset(own))
                found.append(article(page or "", None if container is None else tuple(json.loads(container)), known))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names)

    names = ["page_id", "url", "text"]
    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    joined = rows.join(learned.select("host", "container", "template"), "host", "left")
    kind = rows.schema["page_id"].dataType.simpleString()
    return map_arrow(
        joined.select("page_id", "url", "html", "container", "template"), extracted, f"page_id {kind}, url string, text string"
    )
