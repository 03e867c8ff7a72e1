"""Main text of web pages through wrappers inferred per host.

A wrapper is a union-free regular expression over a page's tokens: a sequence of elements and text
slots, of which some are optional and some repeat.  A page is first folded by itself: siblings of one
kind become a repeated item, and so do groups of siblings that follow each other.  The folded pages of
a host are then aligned one after the other; where they differ, items become optional, and elements
that match are aligned inside.  Equal folded pages are counted, not kept, so a host costs as much as
it has different layouts; the layouts of a host are aligned in parts, and their wrappers again, until one is left.

The wrapper's article or main element is its main region; a wrapper without one takes the whole body.
A slot is template, and left out inside the region too, if it says the same on all pages of the host
that have it, these are three different pages at least, and the wrapper has it as a part that is never
missing from the region.  Inside an article or main element that holds only for text that stands in no
paragraph, heading, list item, quotation, table cell or the like: those are the article, however often they
repeat.  Pages with the same text in their regions are one page, under whatever URL.
Where the rest of a page is under a quarter of its template, nothing says which of the two is the
article, so both stay.  A page without a main element loses its link lists: linked elements at a path
that holds mostly links on that very page.  Menus, headers, footers, sidebars, notices, adverts, forms,
comments, scripts and styles are left out everywhere, by their element, role or class.  A class counts if it is one
of the known words, ends with one (``cookie-notice``) or is made of known words and names of boxes
(``ad-slot``), not if it merely holds one (``notice-to-mariners``).

Pages nest as deep as they like: trees are walked without recursion.

Defined results: null html is an empty page, with an empty text; pages without a host are a host of
their own; open elements are closed as browsers do; text outside any known item of the wrapper is
judged by its own elements; an empty table gives an empty result; rows that repeat are extracted each;
other columns are not read.
"""

import difflib
import html as entities
import json
import re
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, tidy

FAN = 64          # layouts that one task aligns
STEADY = 3        # different pages from which on a slot that always says the same is part of the template
REST = 0.25       # least text beside the template, as a share of it, for the template to be left out
LONGEST_GROUP = 4  # siblings in a repeated group, at most
CELLS = 250_000   # of a table by which sequences are aligned; longer ones are aligned by their matching blocks
LONG_PATH = 400   # characters from which on a path is shortened to its hash

# Fixed values of HTML and of what is not article text.
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table "
             "tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = set("aside button datalist dialog footer form head iframe input label menu nav noscript object option select "
              "svg template".split())
RAW = set("script style textarea title xmp".split())
MAIN = {"article", "main"}
OFF_WORDS = set("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie "
                "cookies footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
                "popup promo promoted related reply replies respond share sharing sidebar social sponsor sponsored "
                "subscribe toolbar".split())
OFF_ROLES = set("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# Parts of class names that say what a box is, not what is in it.
BOX_WORDS = set("area bar block bottom box button buttons center col column container content grid group inner item items "
                "left link links list main outer panel right row section side slot text top unit widget wrap wrapper".split())
# Elements that are the article's own text where they stand in it.
TEXT_TAGS = set("blockquote caption dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre td th".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "option": {"option"}, "body": {"head"}}
WALLS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "tbody": {"table"}}

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*>|<(/?)([a-zA-Z][^\s/>]*)"
                   r"((?>=\s*+(?:\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*+)?+|[^=>])*+)>", re.S)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*))", re.I)
CUT_OFF = re.compile(r"<[a-zA-Z/!][^>]*\Z")  # a tag that the end of the page cuts
PARTS_OF_NAME = re.compile(r"[a-z]+")


class Node:
    """An element: its signature, whether it is left out, whether it stands in a main element or is one."""
    __slots__ = ("sig", "tag", "off", "main", "kids")

    def __init__(self, sig, tag, off, main):
        self.sig, self.tag, self.off, self.main, self.kids = sig, tag, off, main, []


def _names_boilerplate(name: str) -> bool:
    parts = PARTS_OF_NAME.findall(name)
    return bool(parts) and (parts[-1] in OFF_WORDS or all(p in OFF_WORDS | BOX_WORDS for p in parts) and
                            any(p in OFF_WORDS for p in parts))


@lru_cache(maxsize=4096)
def _kind(tag: str, attributes: str):
    """Signature of an element, whether it is left out, whether it is a main element."""
    found = {}
    for name, *values in ATTRIBUTE.findall(attributes) if attributes else ():
        found.setdefault(name.lower(), entities.unescape("".join(values)).lower())
    classes = sorted({re.sub(r"\d+", "", c) for c in found.get("class", "").split()})
    names = [*found.get("class", "").split(), *found.get("id", "").split()]
    role = found.get("role", "")
    main = tag in MAIN or role == "main"
    off = tag in DROPPED or role in OFF_ROLES or any(map(_names_boilerplate, names))
    if tag in ("html", "body") or main and not any(n in ("comment", "comments", "reply", "ad") for n in names):
        off = False
    return ".".join(["main" if role == "main" else tag, *classes]), off, main and not off


def parse(html: str) -> Node:
    """The tree of the structural elements; text is (characters, linked) among the children."""
    root = Node("html", "html", False, False)
    stack, at, linked = [root], 0, False
    tags, mains = Counter(), 0   # elements on the stack
    text = []

    def flush():
        if text:
            if whole := "".join(text):
                stack[-1].kids.append((whole, linked))
            text.clear()

    def shorten(length):
        nonlocal mains
        for node in stack[length:]:
            tags[node.tag] -= 1
            mains -= node.sig.split(".")[0] in MAIN
        del stack[length:]

    match = TOKEN.search(html)
    while match:
        if match.start() > at:
            # Character references end where the text does: none is put together over a tag.
            text.append(entities.unescape(html[at:match.start()]))
        at = match.end()
        closing, tag, attributes = match.group(1), (match.group(2) or "").lower(), match.group(3)
        if tag in RAW and not closing:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif tag == "br":
            text.append(" ")
        elif tag == "a":
            flush()
            linked = not closing
        elif tag and closing:
            if tags[tag]:
                flush()
                shorten(next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag))
            elif tag in BLOCKS:
                flush()
        elif tag and tag != "html":
            sig, off, main = _kind(tag, attributes)
            if off and tag in TEXT_TAGS and stack[-1].main:
                off = False
            if tag in BLOCKS or off:
                flush()
                linked = False
                if main and not mains:
                    while len(stack) > 1 and (stack[-1].off or stack[-1].tag == "p"):
                        shorten(len(stack) - 1)
                ends, walls = CLOSES.get(tag, ()), WALLS.get(tag, ())
                if tag in BLOCKS and tags["p"] or any(tags[t] for t in ends):
                    for i in range(len(stack) - 1, 0, -1):
                        if stack[i].tag in walls:
                            break
                        if stack[i].tag in ends or stack[i].tag == "p" and tag in BLOCKS:
                            shorten(i)
                            if not tags["p"] and not any(tags[t] for t in ends):
                                break
                node = Node(sig, tag, off, stack[-1].main or main)
                stack[-1].kids.append(node)
                if tag not in VOID and not attributes.endswith("/"):
                    stack.append(node)
                    tags[tag] += 1
                    mains += sig.split(".")[0] in MAIN
        match = TOKEN.search(html, at)
    text.append(entities.unescape(CUT_OFF.sub("", html[at:])))
    flush()
    return root


def _run(step):
    """The result of a generator that yields further ones where a function would call itself."""
    stack, value = [step], None
    while stack:
        try:
            step = stack[-1].send(value)
        except StopIteration as done:
            stack.pop()
            value = done.value
        else:
            stack.append(step)
            value = None
    return value


# A wrapper node is [signature, optional, repeated, items]; a slot has the signature "#", a repeated
# group of siblings the signature "()".

def _merged(a, b):
    return [a[0], a[1] or b[1], a[2] or b[2], (yield _aligned(a[3], b[3]))]


def _common(left: list, right: list):
    """Pairs of places of equal signatures, in order: a longest common subsequence."""
    n, m, first = len(left), len(right), 0
    while first < min(n, m) and left[first] == right[first]:
        first += 1
    while n > first and m > first and left[n - 1] == right[m - 1]:
        n, m = n - 1, m - 1
    pairs = [(i, i) for i in range(first)]
    a, b = left[first:n], right[first:m]
    if len(a) * len(b) > CELLS:
        matcher = difflib.SequenceMatcher(None, a, b, autojunk=False)
        pairs += [(first + x + i, first + y + i) for x, y, size in matcher.get_matching_blocks() for i in range(size)]
    elif a and b:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a) - 1, -1, -1):
            for j in range(len(b) - 1, -1, -1):
                best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + 1 if a[i] == b[j] else 0)
        i = j = 0
        while i < len(a) and j < len(b):
            if a[i] == b[j] and best[i][j] == best[i + 1][j + 1] + 1:
                pairs.append((first + i, first + j))
                i, j = i + 1, j + 1
            elif best[i + 1][j] >= best[i][j + 1]:
                i += 1
            else:
                j += 1
    return pairs + [(n + i, m + i) for i in range(len(left) - n)]


def _aligned(left: list, right: list):
    out, i, j = [], 0, 0
    same = len(left) == len(right) and all(a[0] == b[0] for a, b in zip(left, right))
    for x, y in [*_common([a[0] for a in left], [b[0] for b in right]), (len(left), len(right))]:
        out += [[a[0], True, a[2], a[3]] for a in left[i:x]] + [[b[0], True, b[2], b[3]] for b in right[j:y]]
        if x < len(left):
            out.append((yield _merged(left[x], right[y])))
        i, j = x + 1, y + 1
    return out if same else (yield _repeated(out))


def _repeated(items: list):
    out = []
    for item in items:
        if out and out[-1][0] == item[0]:
            out[-1] = [item[0], out[-1][1] and item[1], True, (yield _aligned(out[-1][3], item[3]))]
        else:
            out.append(item)
    for size in range(2, LONGEST_GROUP + 1):
        done, at = [], 0
        while at < len(out):
            sigs = [x[0] for x in out[at:at + size]]
            if "()" in sigs or [x[0] for x in out[at + size:at + 2 * size]] != sigs:
                done.append(out[at])
                at += 1
                continue
            group, at = out[at:at + size], at + size
            while [x[0] for x in out[at:at + size]] == sigs:
                for i in range(size):
                    group[i] = yield _merged(group[i], out[at + i])
                at += size
            done.append(["()", False, True, group])
        out = done
    return out


def align(left: list, right: list) -> list:
    """Items of both sequences in order; what one of them lacks becomes optional."""
    return _run(_aligned(left, right))


def repeats(items: list) -> list:
    """Neighbours of one kind become one repeated item, and so do groups of neighbours."""
    return _run(_repeated(items))


def _is_slot(kid):
    return isinstance(kid, tuple) and not kid[0].isspace()


def _folded(node: Node):
    items = []
    for kid in node.kids:
        if _is_slot(kid):
            items.append(["#", False, False, []])
        elif not isinstance(kid, tuple) and not kid.off:
            items.append([kid.sig, False, False, (yield _folded(kid))])
    return (yield _repeated(items))


def fold(node: Node) -> list:
    """The page's own items."""
    return _run(_folded(node))


def dump(items: list) -> str:
    """A layout as text: signature, flags and number of items of each node, before its items."""
    out, stack = [len(items)], items[::-1]
    while stack:
        sig, optional, repeated, kids = stack.pop()
        out += [sig, 2 * optional + repeated, len(kids)]
        stack += kids[::-1]
    return json.dumps(out, separators=(",", ":"))


def load(layout: str) -> list:
    flat = iter(json.loads(layout))
    top = []
    stack = [(top, next(flat))]
    while stack:
        items, left = stack.pop()
        if left:
            kids = []
            items.append([next(flat), *map(bool, divmod(next(flat), 2)), kids])
            stack += [(items, left - 1), (kids, next(flat))]
    return top


def _below(path: str, sig: str) -> str:
    """The path of an element; very long ones by their hash."""
    path = f"{path}/{sig}"
    return path if len(path) < LONG_PATH else "~" + xxhash.xxh3_128_hexdigest(path)


def _slots(node: Node, only_main: bool) -> dict:
    """Per path of a slot: words, linked words, its texts, whether it is the article's own text."""
    out, stack = {}, [(node, "")]
    while stack:
        node, path = stack.pop()
        for kid in node.kids:
            if not isinstance(kid, tuple):
                continue
            if not kid[0].isspace() and (node.main or not only_main):
                words, linked, texts, _ = out.get(path, (0, 0, [], None))
                n = len(kid[0].split())
                out[path] = (words + n, linked + n * kid[1], [*texts, kid[0].strip()], node.main and node.tag in TEXT_TAGS)
        stack += [(kid, _below(path, kid.sig)) for kid in reversed(node.kids) if not isinstance(kid, tuple) and not kid.off]
    return out


def _page_has_main(node):
    stack = [node]
    while stack:
        node = stack.pop()
        if node.main:
            return True
        stack += [k for k in node.kids if not isinstance(k, tuple) and not k.off]
    return False


def _host(url):
    match = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", url or "")
    return match.group(1).rpartition("@")[2].lower() if match else ""


SEEN = "host string, layout string, path string, pages long, low long, high long, marks array<long>"


def _mark(texts):
    return xxhash.xxh3_64_intdigest("\0".join(" ".join(t.split()) for t in texts)) >> 1


def _layouts(batches):
    """Folded pages and slots of each host, counted; of the different pages that have a slot, a few marks."""
    for batch in batches:
        folds, slots = {}, {}
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            host, tree = _host(url), parse(html or "")
            key = (host, dump(fold(tree)))
            folds[key] = folds.get(key, 0) + 1
            region = _slots(tree, _page_has_main(tree))
            marks = {path: _mark(texts) for path, (_, _, texts, own) in region.items()}
            page = _mark([f"{path} {mark}" for path, mark in sorted(marks.items())])
            for path, mark in marks.items():
                if region[path][3]:
                    continue
                low, high, pages = slots.get((host, path), (mark, mark, ()))
                if len(pages) < STEADY and page not in pages:
                    pages += (page,)
                slots[host, path] = min(low, mark), max(high, mark), pages
        rows = [(h, x, None, n, None, None, None) for (h, x), n in folds.items()]
        rows += [(h, None, p, None, low, high, list(pages)) for (h, p), (low, high, pages) in slots.items()]
        columns = list(zip(*rows)) or [[]] * 7
        kinds = [pa.string()] * 3 + [pa.int64()] * 3 + [pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         ["host", "layout", "path", "pages", "low", "high", "marks"])


def _infer(batch: pa.Table) -> pa.Table:
    """One wrapper for some layouts of a host, the most frequent first."""
    rows = sorted(batch.to_pylist(), key=lambda r: (-r["pages"], r["layout"]))
    wrapper = load(rows[0]["layout"])
    for row in rows[1:]:
        wrapper = align(wrapper, load(row["layout"]))
    return pa.table({"host": [rows[0]["host"]], "layout": [dump(wrapper)],
                     "pages": pa.array([sum(r["pages"] for r in rows)], pa.int64())})


def _one_per_host(layouts: DataFrame) -> DataFrame:
    """Layouts (host, layout, pages) aligned in parts of about ``FAN``, round by round, until a host has one."""
    while True:
        held = layouts.groupBy("host").agg(F.count("*").alias("held"))
        if not (held.agg(F.max("held")).first()[0] or 1) > 1:
            return layouts
        part = F.pmod(F.xxhash64("layout"), F.ceil(F.col("held") / FAN).cast("long"))
        parts = layouts.join(held, "host").withColumn("part", part)
        layouts = stored(parts.select("host", "layout", "pages", "part").groupBy("host", "part").applyInArrow(
            _infer, "host string, layout string, pages long"), "wrapper-parts")


def wrappers(pages: DataFrame, url="url", html="html") -> DataFrame:
    """host, layout (the wrapper), and idle: slots that say the same on all of several different pages."""
    ship(pages.sparkSession)
    seen = stored(pages.select(F.col(url), F.col(html)).mapInArrow(tidy(_layouts), SEEN), "wrapper-layouts")
    layouts = stored(seen.filter("layout is not null").groupBy("host", "layout").agg(F.sum("pages").alias("pages")),
                     "wrapper-folds")
    same = seen.filter("path is not null").groupBy("host", "path").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).filter("low = high")
    marks = seen.select("host", "path", F.explode("marks").alias("mark")).distinct().groupBy("host", "path").agg(
        F.count("*").alias("different")).filter(F.col("different") >= STEADY)
    idle = same.join(marks, ["host", "path"]).groupBy("host").agg(F.array_sort(F.collect_set("path")).alias("idle"))
    return stored(_one_per_host(layouts).join(idle, "host", "left").select("host", "layout", F.coalesce(
        "idle", F.array().cast("array<string>")).alias("idle")), "wrappers")


def _is_main(sig):
    return sig.split(".")[0] in MAIN


def _has_main(items):
    stack = list(items)
    while stack:
        sig, _, _, kids = stack.pop()
        if _is_main(sig):
            return True
        stack += kids
    return False


def _required(items):
    """Paths of the slots that are never missing from the wrapper's region."""
    holds = {}   # which optional elements have the region within

    def mark(node):
        for kid in node[3]:
            yield mark(kid)
        holds[id(node)] = any(_is_main(k[0]) or holds[id(k)] for k in node[3])
    _run(mark(["", False, False, items]))
    out, stack = set(), [(item, "", False, False) for item in items]
    while stack:
        (sig, optional, _, kids), path, main, only_main = stack.pop()
        if sig == "#":
            if not optional and (main or not only_main):
                out.add(path)
        elif sig == "()":
            if not optional:
                stack += [(kid, path, main, only_main) for kid in kids]
        elif not optional or _is_main(sig) or sig.split(".")[0] == "body":
            stack += [(kid, _below(path, sig), main or _is_main(sig), only_main) for kid in kids]
        elif any(_is_main(k[0]) or holds[id(k)] for k in kids):
            stack += [(kid, _below(path, sig), main, True) for kid in kids]
    return out


def _template(tree, named, wrapper, idle):
    """Paths that are left out of this page: its host's template, and its own paths that hold mostly links."""
    slots = _slots(tree, named)
    links = set() if named else {path for path, (words, linked, *_) in slots.items() if linked * 2 > words}
    fixed = {path for path in idle & wrapper & slots.keys() if not slots[path][3]} if idle else ()
    if fixed:
        rest = sum(words for path, (words, *_) in slots.items() if path not in fixed and path not in links)
        if rest < REST * sum(slots[path][0] for path in fixed - links) or not rest:
            fixed = ()
    return fixed, links


def extract(html: str, wrapper: list, idle=frozenset()) -> str:
    """Main text of a page by its host's wrapper."""
    return _main_of(html, _has_main(wrapper), _required(wrapper) if idle else frozenset(), idle)


def _main_of(html: str, has_main: bool, required, idle) -> str:
    tree = parse(html)
    named = has_main and _page_has_main(tree)
    fixed, links = _template(tree, named, required, idle) if idle or not named else ((), ())
    out, block = [], []

    def flush():
        words = " ".join("".join(block).split())
        if words:
            out.append(words)
        block.clear()

    def mostly_links(node):
        return sum(len(k[0].split()) * (2 * k[1] - 1) for k in node.kids if isinstance(k, tuple)) > 0

    stack = [(tree, "")]   # None ends a block
    while stack:
        item = stack.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            block.append(item)
        else:
            node, path = item
            told = (node.main or not named) and path not in fixed and not (path in links and mostly_links(node))
            inner = []
            for kid in node.kids:
                if isinstance(kid, tuple):
                    if told:
                        inner.append(kid[0])
                elif not kid.off:
                    inner += [None, (kid, _below(path, kid.sig))]
                elif kid.tag in BLOCKS:
                    inner.append(None)
            stack += [None, *reversed(inner)]
    flush()
    return "\n".join(out)


@lru_cache(maxsize=256)
def _loaded(layout):
    wrapper = load(layout)
    return _has_main(wrapper), _required(wrapper)


def _extract(batches):
    for batch in batches:
        texts = [_main_of(html, *_loaded(layout), frozenset(idle or ())) if html else ""
                 for html, layout, idle in zip(*(batch.column(c).to_pylist() for c in ("html", "layout", "idle")))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, page_id="page_id", url="url", html="html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    known = wrappers(pages, url, html)
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(host, "^.*@", ""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"), host.alias("host"))
    rows = rows.join(known, "host", "left").select("page_id", "url", "html", F.coalesce("layout", F.lit("[0]")).alias("layout"), "idle")
    kind = pages.schema[page_id].dataType.simpleString()
    return rows.mapInArrow(tidy(_extract), f"page_id {kind}, url string, text string, n_chars long")
