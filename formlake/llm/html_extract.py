"""Main text of web pages by equivalence classes of template tokens.

Tokens are opening tags with their place (the path of open elements, with class and id words) and
text blocks with their place. A token's occurrence vector (its count on every page of a host) is
folded into an order-free hash, so tokens of equal vectors meet by aggregates and a host with a
third of all pages ships partial rows only. Tokens of equal vectors are a class; it needs
``SIZE`` tokens and at least three and ``SUPPORT`` of the host's pages. A second pass checks it on every page: its
occurrences must repeat one tuple in one order, and it must stand in one gap of one enclosing class
(or in none) without crossing another; ``AGREE`` of its pages must show the same. What remains is the host's template,
a tree of classes and gaps. Hosts with fewer than ``LEAST`` unlike pages share the template of all such hosts.

Text outside the template's tokens is slot text. The main slot is the innermost template element that
holds nearly all of the host's slot text outside links (an article or main element, if one
does). A page's text is the slot text in the main slot: template text goes, inside articles too,
and so do template elements with little but links. A page with more template text than own text
in its main slot is a copy of other pages and keeps it. Pages without the main slot use their article or main
elements, else the whole body. Menus, headers, footers, sidebars, notices, adverts, forms and reader comments that
say so by element name, role or class word are no slots.

Defined results: null or empty html gives an empty text; a page cut short ends its open elements; a
null url is a host of its own (the empty one); repeated rows repeat their result, and pages with equal
blocks count once for a template; ties between elements go to the smaller hash. Extra columns play no part.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formlake.llm.common import staged
from formlake.llm.suffix_dedup import _packed, _unpack
from formlake.llm.textkit import small_batches

SUPPORT = 0.5
SIZE = 2
AGREE = 0.9
LEAST = 5
NEARLY = 0.8
SALTS = 32
POOL = "*"
_CROSSED = -1
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe xmp".split())
_SKIP = frozenset("head nav footer aside form select button svg canvas object audio video dialog menu".split()) | _RAW
_BLOCK = frozenset(
    "p h1 h2 h3 h4 h5 h6 div li ul ol dl dt dd table caption thead tbody tfoot tr blockquote pre section article main figure figcaption hr address details summary header body html center fieldset".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu menubar toolbar".split())
_OTHER = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe "
    "sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus replies share sharing social related recommended widget login signup search pagination".split()
)
_OPENS_P = _BLOCK - {"p"}
_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'/]++|\"[^\"]*\"|'[^']*'|/(?!>))*+)(/?)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^<>]*\Z|</[^a-zA-Z>][^>]*>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b")
_WORD = re.compile(r"[a-z0-9]+")


class _Element:
    __slots__ = ("name", "key", "skip", "main", "head", "link")

    def __init__(self, name, key, skip, main, head, link):
        self.name, self.key, self.skip, self.main, self.head, self.link = name, key, skip, main, head, link


_TOP = _Element("", "", False, False, False, False)
_KEPT, _LONG = 1 << 12, 200  # entries of a cache, longest text in one
_HASHES: dict = {}
_MARKS: dict = {}
_ELEMENTS: dict = {}


def _kept(cache: dict, make: Callable, *key):
    """``make(*key)``, kept: pages of a host share their tags and places. A full cache starts again."""
    value = cache.get(key)
    if value is None:
        if len(cache) >= _KEPT:
            cache.clear()
        value = cache[key] = make(*key)
    return value


def _hash(text: str) -> int:
    return _kept(_HASHES, _new_hash, text) if len(text) <= _LONG else _new_hash(text)


def _new_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _marks(name: str, raw: str) -> tuple[bool, str, frozenset[str]]:
    """What a tag says of itself: whether its text doesn't belong to the page's, its role, and its class and id words."""
    role, words, hidden = "", [], False
    if raw:
        for key, a, b, c, bare in _ATTR.findall(raw):
            key, value = key.lower(), (a or b or c).lower()
            if key in ("class", "id"):
                words += _WORD.findall(value)
            elif key == "role":
                role = value
            elif key == "style":
                hidden = hidden or "display:none" in value.replace(" ", "")
            elif bare or key == "hidden" or key == "aria-hidden" and value == "true":
                hidden = True
    skip = name in _SKIP or hidden or role in _ROLES or (name not in ("html", "body") and not _OTHER.isdisjoint(words))
    return skip, role, frozenset(words)


def _opened(name: str, marks: tuple[bool, str, frozenset[str]], above: _Element) -> _Element:
    """The element of a tag in ``above``; elements never change, so equal ones may be one."""
    own, role, words = marks
    skip = above.skip or own
    # a header outside an article goes; of one inside only headings stay
    head = above.head or name == "header" or "header" in words and name not in _HEADING
    main = above.main or not skip and (name in ("article", "main") or role in ("main", "article"))
    return _Element(name, f"{above.key}/{name}" + "".join(f".{w}" for w in sorted(set(words)) if not w.isdigit()), skip, main, head and not (name in _HEADING and main), above.link or name == "a")


def blocks(html: str) -> tuple[list[tuple[str, _Element, list[_Element], int]], list[str]]:
    """Text blocks as (text, nearest element, open elements, characters in links), and the page's tokens in order."""
    out, tokens, stack, parts, linked = [], [], [_TOP], [], 0
    owner = stack[0]

    def close_block() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((text, owner, stack[1:], linked))
            tokens.append(f"{owner.key}\n{text}")
        parts.clear()
        linked = 0

    def put(text: str) -> None:
        nonlocal owner, linked
        top = stack[-1]
        if top.skip and not parts and not text.strip():
            return
        if parts and (top.skip, top.head) != (owner.skip, owner.head):
            if top.skip or top.head:
                return  # an inline part of a block that doesn't belong to the text
            close_block()
        if not parts:
            owner = top
        parts.append(text)
        if top.link:
            linked += len(text)

    at, end = 0, len(html)
    while at < end:
        found = _TAG.search(html, at)
        if not found:
            put(html[at:])
            break
        if found.start() > at:
            put(html[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if name in _BLOCK:
                close_block()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
            continue
        if name == "br":
            put(" ")
            continue
        if name in _BLOCK or name in _SKIP:
            close_block()
        if name in _OPENS_P or name == "p":  # these end an open paragraph, li an open li
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p" or stack[k].name == name == "li":
                    del stack[k:]
                    break
                if stack[k].name in _OPENS_P:
                    break
        if name in ("td", "th"):
            put(" ")
        raw = found[3] or ""
        if len(name) + len(raw) + len(stack[-1].key) <= 4 * _LONG:
            element = _kept(_ELEMENTS, _opened, name, _kept(_MARKS, _marks, name, raw), stack[-1])
        else:
            element = _opened(name, _marks(name, raw), stack[-1])
        tokens.append(element.key)
        if name in _RAW:
            stop = re.compile(rf"</{name}\s*>", re.I).search(html, at)
            at = stop.end() if stop else end
        elif name not in _VOID and not found[4]:
            stack.append(element)
    close_block()
    return out, tokens


def host_of(url: str | None) -> str:
    found = re.search(r"://([^/?#]*)", url or "")
    return found[1].lower() if found else ""


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _tokens(pages: DataFrame) -> DataFrame:
    """(host, token, page, n): occurrences of every token on every page; token 0 stands once on each."""
    schema = pa.schema([("host", pa.string()), ("token", pa.int64()), ("page", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            rows = []
            for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                found, tokens = blocks(html or "")
                host, page = host_of(url), _hash("\n\n".join(b[0] for b in found if not b[1].skip))
                rows += [(host, token, page, n) for token, n in Counter(map(_hash, tokens)).items()]
                rows.append((host, 0, page, 1))
            yield _rows(schema, rows)

    return pages.select("url", "html").mapInArrow(run, "host string, token long, page long, n int")


def classes_of(pages: DataFrame, label: str) -> DataFrame:
    """(grp, classes): tokens of equal occurrence vectors, per host and for the pool of small hosts.

    A group lists tokens of at least ``SUPPORT`` of its pages, so at most twice as many as a mean page has.
    """
    once = _tokens(pages).groupBy("host", "token", "page").agg(F.max("n").alias("n"))
    # the hash of an occurrence vector: exclusive or over its pages, for which order plays no part
    vectors = once.groupBy("host", "token").agg(F.count(F.lit(1)).alias("pages"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.max("n").alias("most"))
    vectors = staged(vectors, f"{label}-vectors")
    hosts = vectors.filter("token = 0").select("host", F.col("pages").alias("all"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    sized = vectors.withColumn("salt", F.pmod("token", F.lit(SALTS).cast("long"))).join(hosts, ["host", "salt"]).drop("salt")
    own = sized.filter(F.col("all") >= LEAST).withColumn("grp", F.concat(F.lit("h"), "host")).drop("host")
    # vectors of several hosts merge as those of one do
    small = sized.filter(F.col("all") < LEAST).groupBy("token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"), F.max("most").alias("most"))
    whole = vectors.filter((F.col("token") == 0) & (F.col("pages") < LEAST)).agg(F.sum("pages")).first()[0] or 0
    pool = small.withColumns({"grp": F.lit(POOL), "all": F.lit(whole).cast("long")})
    used = own.unionByName(pool).filter((F.col("token") != 0) & (F.col("pages") >= 3) & (F.col("pages") >= SUPPORT * F.col("all")))
    grouped = used.groupBy("grp", "vector", "pages").agg(F.sort_array(F.collect_list(F.struct("token", "most"))).alias("members")).filter(F.size("members") >= SIZE)
    return grouped.groupBy("grp").agg(F.collect_list(F.struct(F.xxhash64("vector", "pages").alias("id"), "members")).alias("classes"))


def _tuples(tokens: list[int], classes: dict[int, list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Of every class on a page: the hash of its order (0 if its occurrences repeat no one tuple), and their places."""
    of = {token: c for c, members in classes.items() for token in members}
    places: dict[int, list[int]] = {}
    for k, token in enumerate(tokens):
        if token in of:
            places.setdefault(of[token], []).append(k)
    out = {}
    for c, at in places.items():
        size = len(classes[c])
        seen = [tokens[k] for k in at]
        ordered = len(seen) % size == 0 and len(set(seen[:size])) == size and seen == seen[:size] * (len(seen) // size)
        out[c] = (_hash(",".join(map(str, seen[:size]))) or 1 if ordered else 0, at)
    return out


def _gap(inner: list[int], size: int, outer: list[int], outer_size: int) -> int | None:
    """The gap of the outer class's tuple that all tuples of the inner one stand in (0: between tuples), None if there is no such."""
    gaps = set()
    for k in range(0, len(inner), size):
        at = bisect_left(outer, inner[k])
        if at != bisect_left(outer, inner[k + size - 1]):
            return None
        gaps.add(at % outer_size)
    return gaps.pop() if len(gaps) == 1 else None


def nesting(found: dict[int, tuple[int, list[int]]], classes: dict[int, list[int]]) -> dict[int, tuple[int, int]]:
    """Of every ordered class on a page: the innermost class around it and the gap there; (0, 0) if none, ``_CROSSED`` if it crosses one."""
    out = {}
    ordered = [c for c in found if found[c][0]]
    for c in ordered:
        at, size, best = found[c][1], len(classes[c]), (0, 0)
        near = -1
        for d in ordered:
            if d == c:
                continue
            other, length = found[d][1], len(classes[d])
            gap = _gap(at, size, other, length)
            if gap is None and _gap(other, length, at, size) is None and len(at) <= len(other):
                best = (_CROSSED, 0)  # of two that cross, the one that occurs less often
                break
            if gap:
                start = other[bisect_left(other, at[0]) - 1]
                if start > near:
                    near, best = start, (d, gap)
        out[c] = best
    return out


def _slot_blocks(found: list) -> list:
    return [b for b in found if not b[1].skip and not b[1].head]


def _checked(placed: DataFrame, pooled: dict, label: str) -> DataFrame:
    """(grp, template, holders): classes found ordered and nested, and the slot text in their elements.

    Every page gives one row per class (its order and its place in the tree) and per element that
    stands once; both merge by partial counts.
    """
    schema = pa.schema([(n, pa.string() if n == "grp" else pa.int64()) for n in ("grp", "id", "order", "parent", "gap", "chars", "linked", "depth", "article")])

    def of_page(grp: str, kinds: dict, html: str) -> list[tuple]:
        classes = {c: [m["token"] for m in members] for c, members in kinds.items()}
        found, tokens = blocks(html)
        places = _tuples(list(map(_hash, tokens)), classes)
        tree = nesting(places, classes)
        rows = [(grp, c, order, *tree.get(c, (0, 0)), None, None, None, None) for c, (order, _) in places.items()]
        texts = {t for members in classes.values() for t in members}
        single = {m["token"] for members in kinds.values() for m in members if m["most"] == 1}
        sums: dict[int, list[int]] = {}
        for text, owner, path, linked in _slot_blocks(found):
            if _hash(f"{owner.key}\n{text}") in texts:
                continue
            linked = min(linked, len(text))
            for depth, element in enumerate(path):
                token = _hash(element.key)
                if token in single:
                    entry = sums.setdefault(token, [0, 0, depth, int(element.name in ("article", "main"))])
                    entry[0] += len(text) - linked
                    entry[1] += linked
        return rows + [(grp, token, None, None, None, *entry) for token, entry in sums.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in small_batches(batches, "packed", 1 << 20):
            rows = []
            for grp, own, html in _grouped(batch, ["classes"], lambda classes: {c["id"]: c["members"] for c in classes}, cache):
                rows += of_page(grp if own else POOL, own or pooled, html)
            yield _rows(schema, rows)

    seen = placed.mapInArrow(run, ", ".join(f"`{f.name}` {'string' if f.name == 'grp' else 'long'}" for f in schema))
    seen = seen.groupBy("grp", "id", "order", "parent", "gap", F.col("order").isNull().alias("element")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.min("depth").alias("depth"), F.max("article").alias("article")
    )
    seen = staged(seen, f"{label}-checks")
    ranked = seen.filter("not element").groupBy("grp", "id").agg(F.sum("n").alias("all"), F.max(F.struct("n", "order", "parent", "gap")).alias("best"))
    valid = ranked.filter((F.col("best.order") != 0) & (F.col("best.parent") != _CROSSED) & (F.col("best.n") >= AGREE * F.col("all")))
    valid = valid.groupBy("grp").agg(F.collect_list(F.struct("id", "best.order", "best.parent", "best.gap")).alias("valid"))
    holders = seen.filter("element").groupBy("grp").agg(F.collect_list(F.struct(F.col("id").alias("token"), "chars", "linked", "depth", "article")).alias("holders"))
    return valid.join(holders, "grp", "left")


def _grouped(batch: pa.RecordBatch, columns: list[str], made: Callable, cache: dict) -> Iterator[tuple]:
    """(group, what ``made`` makes of its columns or None, html) of every page; made once for pages near each other."""
    for k, grp in enumerate(batch.column("grp").to_pylist()):
        if grp not in cache:
            if len(cache) >= 32:
                cache.clear()
            values = [batch.column(c)[k].as_py() for c in columns]
            cache[grp] = None if values[0] is None else made(*values)
        yield grp, cache[grp], _unpack(batch.column("packed")[k].as_py()).decode("utf-8", "replace")


class Template:
    """A host's template: its classes in their order, the element of the main slot, and elements of links."""

    def __init__(self, classes: list, valid: list, holders: list):
        orders = {v["id"]: v["order"] for v in valid or []}
        self.classes = {c["id"]: [m["token"] for m in c["members"]] for c in classes or [] if c["id"] in orders}
        self.orders = orders
        tokens = {t for members in self.classes.values() for t in members}
        held = [h for h in holders or [] if h["token"] in tokens]
        top = max((h["chars"] for h in held), default=0)
        near = [h for h in held if top and h["chars"] >= NEARLY * top]
        near = [h for h in near if h["article"]] or near
        self.main = max(near, key=lambda h: (h["depth"], -h["token"]))["token"] if near else None
        self.links = {h["token"] for h in held if h["linked"] and h["linked"] >= NEARLY * (h["chars"] + h["linked"])}


def main_text(html: str | None, template: Template | None = None) -> str:
    """The main text of one page under its host's template."""
    found, tokens = blocks(html or "")
    found = _slot_blocks(found)
    inside = found
    if template:
        places = _tuples(list(map(_hash, tokens)), template.classes)
        # a class counts where the page shows it in the template's order
        known = {t for c, (order, _) in places.items() if order == template.orders[c] for t in template.classes[c]}
        if template.main in known:
            inside = [b for b in found if any(_hash(e.key) == template.main for e in b[2])]
    articles = [b for b in inside if b[1].main] or [b for b in found if b[1].main]
    inside = articles or inside
    if template:
        shared = [_hash(f"{b[1].key}\n{b[0]}") in known for b in inside]
        if 2 * sum(len(b[0]) for b, s in zip(inside, shared) if s) <= sum(len(b[0]) for b in inside):
            inside = [b for b, s in zip(inside, shared) if not s]
        links = template.links & known
        inside = [b for b in inside if not links or links.isdisjoint(_hash(e.key) for e in b[2])]
    return "\n\n".join(b[0] for b in inside)


def extract(pages: DataFrame, label: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    grp = F.concat(F.lit("h"), F.coalesce(F.lower(F.regexp_extract("url", r"://([^/?#]*)", 1)), F.lit("")))
    rows = pages.select(F.struct(F.col("page_id").cast("long").alias("page_id"), F.col("url")).alias("rest"), grp.alias("grp"), F.col("html").alias("text"))
    packed = _packed(rows.select(F.lit(0).cast("long").alias("key"), F.struct("rest", "grp").alias("rest"), "text")).select("rest.rest", "rest.grp", "packed")
    # the templates are a table of their own, so the pages of a hot host can be split; that of the
    # pool is one row of at most twice a mean page's tokens, which tasks are given as it is
    classes = staged(classes_of(pages, label), f"{label}-classes")
    pooled = classes.filter(F.col("grp") == POOL).select("classes").collect()
    pooled = {c["id"]: [m.asDict() for m in c["members"]] for row in pooled for c in row["classes"]}
    checked = _checked(packed.join(classes, "grp", "left").select("grp", "classes", "packed"), pooled, label)
    whole = staged(classes.join(checked, "grp", "left"), f"{label}-templates")
    rest = [row.asDict(recursive=True) for row in whole.filter(F.col("grp") == POOL).collect()]
    shared = Template(rest[0]["classes"], rest[0]["valid"], rest[0]["holders"]) if rest else None
    placed = packed.join(whole, "grp", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in small_batches(batches, "packed", 1 << 20):
            out = [main_text(html, own or shared) for _, own, html in _grouped(batch, ["classes", "valid", "holders"], Template, cache)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest").field("page_id"), batch.column("rest").field("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return placed.select("rest", "grp", "packed", "classes", "valid", "holders").mapInArrow(run, "page_id long, url string, text string, n_chars long")
