"""Main text of web pages by wrappers inferred from pages of one host.

Every page is read once, into nodes (block elements) and blocks of text. A node is known by its path: the
elements from the root down, each with its role, classes and id (digits left out); an element without these
is told from its like by the elements in it. Pages of a host are aligned path by path, and what is found
makes the host's wrapper, a union-free regular expression over elements: a node that some pages lack is
optional, one that stands several times in a page is repeated, and its text is a constant of the template
where all pages agree, else a slot. The alignment is a grouped aggregation over (host, path) that no order of
pages changes and that Spark sums before it shuffles; only nodes of two different pages at least are kept, so
a wrapper is as large as its host's template, whatever the number of pages.

The wrapper decides what is main text: the region is the smallest element around all slots that are in no
article or main element; article and main elements are places of their own; constants in either are none (headings
are, paragraphs of an article, and articles that are the same on all pages), as long as slots hold `SLOTS` of
the text. Elements of menus, footers, forms and the like are
out by name. Classes that say the same count unless the wrapper shows that hardly any text stands outside of
them (`REST`), and never on html, body, main, article or the region. On a page with a main element, text
outside its main and article elements does not count.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import new_dir, store

#: Pages (at least two different ones) that a constant of the template stands on.
AGREE = 3
#: Share of a host's text that slots hold, where constants are furniture; below it pages are copies of each other.
SLOTS = 0.2
#: Share of a host's text that stands outside marked elements, below which the marks mean something else.
REST = 0.1

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z](?:[^>"']|"[^"]*"|'[^']*')*+(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)""",
    re.S,
)
NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?""")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noframes".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of text, too small for a content element.
SMALL = frozenset("p li ul ol dl dt dd h1 h2 h3 h4 h5 h6 pre blockquote tr td th tbody thead tfoot".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that never hold main text (a header may), and classes, ids and roles that tell the same of others.
APART = frozenset("nav footer aside form script style noscript template iframe object svg math button select textarea dialog menu title head".split())
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent notice notification alert popup modal nav navbar navigation menu breadcrumb breadcrumbs header masthead footer "
    "sidebar aside widget related recommended share sharing social newsletter subscribe signup login search comment comments comment-list disqus respond replies reply contentinfo complementary".split()
)
#: With these before or after it, one of MARKS tells the same still; other compounds (no-sidebar, notice-period) tell nothing.
BEFORE = frozenset("site global top bottom left right primary secondary main page sub mobile sticky floating google footer header sidebar nav social cookie newsletter comment comments share".split())
AFTER = frozenset("container wrapper wrap box list bar area block inner outer slot unit links link buttons button items item form toggle overlay posts articles stories content icons signup consent notice banner menu top bottom left right".split())
#: Marks that are words of texts too, or name a part of an article: alone they tell, in compounds they don't.
ALONE = frozenset("notice notification alert search header widget banner replies reply respond share sharing login contentinfo complementary".split())
COMPOUNDS = frozenset(
    "site-header global-header top-header search-form search-box search-bar share-buttons share-links share-bar share-box sharing-buttons social-share cookie-banner cookie-notice cookie-consent cookie-alert "
    "consent-banner site-banner ad-banner banner-ad widget-area sidebar-widget footer-widget login-form login-box login-link login-links reply-form reply-link".split()
)
#: An element that the start of another one ends.
ENDS = {"p": frozenset("p div ul ol dl table h1 h2 h3 h4 h5 h6 article section footer header nav aside form pre blockquote hr main figure address details fieldset".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}


def attributes(tag: str) -> dict[str, str]:
    body = NAME.sub("", tag, count=1).rstrip(">").rstrip("/")
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(body)}


def events(page: str) -> Iterator[tuple[str, str, dict[str, str]]]:
    """('open', name, attributes), ('close', name, {}) and ('text', text as written, {}) in page order."""
    at, raw = 0, None
    while at < len(page):
        if raw:
            end = re.compile(rf"</{re.escape(raw)}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else len(page)
            if stop > at:
                yield "text", page[at:stop], {}
            at, raw = stop, None
            continue
        m = TOKEN.search(page, at)
        if not m:
            yield "text", page[at:], {}
            return
        if m.start() > at:
            yield "text", page[at : m.start()], {}
        at, token = m.end(), m[0]
        if token.startswith("<![CDATA["):
            yield "text", token[9:].removesuffix("]]>"), {}
        elif not token.startswith(("<!", "<?")):
            name = NAME.match(token)[1].lower()
            if token[1] == "/":
                yield "close", name, {}
            else:
                yield "open", name, attributes(token) if " " in token or "\n" in token else {}
                if name in RAW:
                    raw = name


def marked(word: str) -> bool:
    """Whether a class, id or role names no main text: as a whole, or as a known compound."""
    word = re.sub("[-_]+", "-", word)
    if word in MARKS or word in COMPOUNDS:
        return True
    first, _, last = word.partition("-")
    return (first in MARKS - ALONE and last in AFTER) or (last in MARKS - ALONE and first in BEFORE)


def mark(name: str, attrs: dict[str, str]) -> bool:
    """Whether class, id or role say that the element is no main text; asked of no page, place or heading's id."""
    if not attrs or name in ("html", "body") or place(name, attrs):
        return False
    names = "" if name in HEADINGS else attrs.get("id", "")
    return any(map(marked, f"{attrs.get('class', '')} {names} {attrs.get('role', '')}".lower().split()))


def gone(name: str, attrs: dict[str, str]) -> bool:
    """Whether the element is out, whatever the wrapper says: by its name, or as it isn't shown."""
    if name in ("html", "body"):
        return False
    return name in APART or (bool(attrs) and ("hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "")))


def place(name: str, attrs: dict[str, str]) -> int:
    """3 for a main element, 2 for an article, by name or role; else 0."""
    if name in ("html", "body"):
        return 0
    return 3 if name == "main" or attrs.get("role", "").strip().lower() == "main" else 2 if name == "article" else 0


def key(name: str, attrs: dict[str, str]) -> str:
    """An element as wrappers know it: its name, role, classes and id, digits left out; html and body by name alone."""
    if name in ("html", "body") or not attrs:
        return name
    extra = sorted(re.sub(r"\d+", "", attrs.get("class", "")).lower().split())
    names = "".join(f"#{re.sub(r'[0-9]+', '', attrs[x])}" for x in ("id",) if attrs.get(x))
    return ".".join([name, *(["=" + attrs["role"]] if attrs.get("role") else []), *extra]) + names


def _hash(*parts: object) -> int:
    return int.from_bytes(blake2b("\0".join(map(str, parts)).encode(errors="replace"), digest_size=8).digest(), signed=True)


MARKED, HEADER, HEADING, INNER, PAGE = 1, 2, 4, 8, 16
_NODE = pa.struct([(x, pa.int64()) for x in ("path", "up", "parent", "place", "bits", "times", "n", "text", "n_all", "all")] + [("k", pa.string())])
_BLOCK = pa.struct([("node", pa.int32()), ("text", pa.string())])
NODE = "struct<path:long,up:long,parent:long,place:long,bits:long,times:long,n:long,text:long,n_all:long,all:long,k:string>"


def read(page: str) -> tuple[list[dict], list[dict]]:
    """Nodes and blocks of a page.

    Nodes, each behind its parent: path, parent's path, parent (its place in the list), place, bits, times (in this
    page), n characters of its own text and their digest, the same of all text below it that is in no article,
    main or marked element, k (its key). Blocks in page order: node, text. What is `gone` is in neither.
    """
    names, ups, keys, kinds = [""], [-1], [""], [(0, PAGE)]
    inner: defaultdict[int, set[str]] = defaultdict(set)
    raw: list[tuple[int, str]] = []
    held: list[str] = []
    stack: list[tuple[str, int, bool]] = [("", 0, False)]

    def close() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            raw.append((at, text))

    at = 0
    for kind, value, attrs in events(page):
        if kind == "text":
            _, node, out = stack[-1]
            if not out:
                if node != at:
                    close()
                    at = node
                held.append(html.unescape(value))
        elif kind == "open":
            while len(stack) > 1 and value in ENDS.get(stack[-1][0], ()):
                stack.pop()
            _, node, out = stack[-1]
            if value in INLINE:
                if value not in VOID:
                    stack.append((value, node, out or gone(value, attrs) or mark(value, attrs)))
                continue
            if value == "br":
                held.append(" ")
                continue
            close()
            if value in VOID:
                continue
            out = out or gone(value, attrs)
            if not out:
                inner[node].add(value)
                names.append(value)
                ups.append(node)
                keys.append(key(value, attrs))
                bits = MARKED * mark(value, attrs) | HEADER * (value == "header") | HEADING * (value in HEADINGS) | INNER * (value in SMALL) | PAGE * (value in ("html", "body"))
                kinds.append((place(value, attrs), bits))
                node = len(names) - 1
            stack.append((value, node, out))
        else:
            if value not in INLINE:
                close()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == value:
                    del stack[i:]
                    break
    close()

    # Equal elements of one parent are one node, found several times.
    known: dict[tuple[int, str], int] = {}
    nodes: list[dict] = []
    to = [0] * len(names)
    for i, k in enumerate(keys):
        if k == names[i] and k not in SMALL and not kinds[i][1] & PAGE and not kinds[i][0]:
            k += "{" + ",".join(sorted(inner[i])) + "}"
        up = to[ups[i]] if i else -1
        j = known.setdefault((up, k), len(nodes))
        if j == len(nodes):
            above = nodes[up]["path"] if i else 0
            nodes.append({"path": _hash(above, k), "up": above, "parent": up, "place": kinds[i][0], "bits": kinds[i][1], "times": 0, "n": 0, "text": 0, "n_all": 0, "all": 0, "k": k})
        nodes[j]["times"] += 1
        to[i] = j
    texts: defaultdict[int, list[str]] = defaultdict(list)
    blocks = [{"node": to[i], "text": text} for i, text in raw]
    for b in blocks:
        texts[b["node"]].append(b["text"])
    for j, some in texts.items():
        nodes[j]["n"], nodes[j]["text"] = sum(map(len, some)), _hash(*some)
    in_main = any(_above(nodes, j, lambda x: x["place"] == 3) for j in texts)
    for j in range(len(nodes) - 1, -1, -1):
        x = nodes[j]
        if not in_main or _above(nodes, j, lambda x: x["place"] > 0):
            x["n_all"], x["all"] = x["n_all"] + x["n"], _hash(x["all"], x["text"])
        if j and not x["place"] and not (x["bits"] & MARKED and not _title(nodes, j)):
            up = nodes[x["parent"]]
            up["n_all"], up["all"] = up["n_all"] + x["n_all"], _hash(up["all"], x["path"], x["all"]) if x["n_all"] else up["all"]
    return nodes, blocks


def _title(nodes: list[dict], j: int) -> bool:
    """Whether a node is a header of a part of the page, not of the page."""
    return bool(nodes[j]["bits"] & HEADER) and not nodes[nodes[j]["parent"]]["bits"] & PAGE


def _above(nodes: list[dict], j: int, what) -> bool:
    """Whether a node or one it is in is such."""
    while j >= 0:
        if what(nodes[j]):
            return True
        j = nodes[j]["parent"]
    return False


def main_text(nodes: list[dict], blocks: list[dict], region: int | None, constant: set[int], trusted: set[int]) -> str:
    """Main text of a page of a host with this content element, constants of the template, and marks that don't hold."""
    inside, out = [0] * len(nodes), [False] * len(nodes)
    for j, x in enumerate(nodes):
        up = x["parent"]
        own = max(x["place"], int(x["path"] == region))
        inside[j] = max(inside[up] if j else 0, own)
        title = x["bits"] & HEADER and (inside[j] == 2 or inside[j] == 3 or (inside[j] == 1 and not _page(nodes, j, region)))
        lost = (x["bits"] & HEADER and not inside[j]) or (x["bits"] & MARKED and not own and not title and x["path"] not in trusted)
        out[j] = (out[up] if j else False) or bool(lost)
    found = [(inside[b["node"]], b["text"]) for b in blocks if not out[b["node"]] and not (inside[b["node"]] and nodes[b["node"]]["path"] in constant)]
    marks = {x["path"] for x in nodes if x["bits"] & MARKED} - trusted
    if not found and marks:  # the page has no other text
        return main_text(nodes, blocks, region, constant, trusted | marks)
    best = max((p for p, _ in found), default=0)
    return "\n".join(text for p, text in found if p >= (2 if best == 3 else min(best, 1)))


def _page(nodes: list[dict], j: int, region: int | None) -> bool:
    """Whether the content element around a node is the whole page, so that headers are the site's too."""
    return _above(nodes, j, lambda x: x["path"] == region and x["bits"] & PAGE)


def host(url: F.Column) -> F.Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


WRAPPER = "host string, region long, constant array<long>, trusted array<long>, wrapper string"


def _wrap(table: pa.Table) -> pa.Table:
    """One host's wrapper and what it decides, from its nodes that several pages have."""
    rows = {r["path"]: r for r in table.to_pylist()}
    kids: defaultdict[int, list[dict]] = defaultdict(list)
    for r in sorted(rows.values(), key=lambda r: (r["pos"], r["k"])):
        kids[r["up"]].append(r)
    top = kids[0][0]
    total = top["shown"] or 1
    # Marked text that nothing else stands beside.
    trusted = [p for p, r in rows.items() if r["bits"] & MARKED] if top["plain"] < REST * total else []
    region, node = None, top
    if node["n_all"] and not node["all_same"]:
        while node["same"] or not node["n"]:
            below = [r for r in kids[node["path"]] if r["n_all"] and not r["place"] and not (r["bits"] & MARKED and not (r["bits"] & HEADER and not node["bits"] & PAGE))]
            several = [r for r in below if not r["all_same"]]
            alone = node["n_all"] > (node["n"] + sum(r["n_all"] for r in below))
            if alone or len(several) != 1 or several[0]["times"] > several[0]["pages"] or several[0]["bits"] & INNER:
                break
            node = several[0]
        region = top["path"] if node["bits"] & PAGE else node["path"]

    def whole(r: dict) -> bool:
        """Whether a node is a paragraph or the like of an article or main element, or lies in one that is the same on all pages."""
        if r["bits"] & INNER and r["up"] in rows and rows[r["up"]]["place"]:
            return True
        while r["up"] in rows and not r["place"]:
            r = rows[r["up"]]
        return r["place"] > 0 and r["all_same"]

    fixed = [r for r in rows.values() if r["n"] and r["same"] and r["pages"] >= AGREE and not r["bits"] & HEADING]
    constant = [r["path"] for r in fixed if not whole(r)] if total - sum(r["n"] for r in fixed) >= SLOTS * total else []

    parts: list[str] = []
    todo: list = [top]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            parts.append(r)
            continue
        pages = rows[r["up"]]["pages"] if r["up"] in rows else r["pages"]
        tail = ("+" if r["times"] > r["pages"] else "") + ("?" if r["pages"] < pages else "")
        parts.append(f"{r['k']}(" + ("#" if r["n"] and not r["same"] else "'" if r["n"] else ""))
        todo += [")" + tail, *reversed(kids[r["path"]])]
    return pa.table({"host": [table.column("host")[0].as_py()], "region": pa.array([region], pa.int64()), "constant": pa.array([constant], pa.list_(pa.int64())), "trusted": pa.array([trusted], pa.list_(pa.int64())), "wrapper": ["".join(parts)]})


def read_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, host, page (digest), nodes, blocks, shown and plain (characters, and such in no marked element) of each row of pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(x or "", *read(x or "")) for x in batch.column(3).to_pylist()]
            plain = [sum(len(b["text"]) for b in blocks if not _above(nodes, b["node"], lambda x: x["bits"] & MARKED)) for _, nodes, blocks in got]
            cols = [pa.array([_hash(x) for x, _, _ in got], pa.int64()), pa.array([n for _, n, _ in got], pa.list_(_NODE)), pa.array([b for _, _, b in got], pa.list_(_BLOCK))]
            cols += [pa.array([sum(x["n"] for x in n) for _, n, _ in got], pa.int64()), pa.array(plain, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *cols], names=["page_id", "url", "host", "page", "nodes", "blocks", "shown", "plain"])

    rows = pages.select("page_id", F.col("url").cast("string"), host(F.col("url")).alias("host"), F.col("html").cast("string"))
    schema = f"page_id {dict(pages.dtypes)['page_id']}, url string, host string, page long, nodes array<{NODE}>, blocks array<struct<node:int,text:string>>, shown long, plain long"
    return rows.mapInArrow(run, schema)


def infer_wrappers(parsed: DataFrame) -> DataFrame:
    """host, region, constant, trusted, wrapper (as text: `#` slot, `'` constant, `+` repeated, `?` optional) of each host with two different pages at least.

    A page without url belongs to host ''. Sums over (host, path) are formed before the shuffle, so a host of any
    number of pages is a small row for each of its paths and task.
    """
    nodes = parsed.where("shown > 0").select("host", "page", "shown", "plain", F.posexplode("nodes").alias("pos", "x")).select("host", "page", "shown", "plain", "pos", "x.*")
    same = lambda x: F.min(x).eqNullSafe(F.max(x))
    found = nodes.groupBy("host", "path").agg(
        *(F.first(x).alias(x) for x in ("up", "k", "place")), F.bit_or("bits").alias("bits"), F.count("*").alias("pages"), *(F.sum(x).alias(x) for x in ("times", "n", "n_all", "shown", "plain")),
        F.min("pos").alias("pos"), same("text").alias("same"), same("all").alias("all_same"), same("page").alias("one"),
    )
    return found.where("NOT one").drop("one").groupBy("host").applyInArrow(_wrap, WRAPPER)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of pages (page_id, url, html).

    Null and empty pages give an empty text. Repeated rows are kept; null ids and urls stay null; other columns are
    ignored. The wrappers joined to the pages are a short row a host; Spark broadcasts them while they are small and
    else joins by host, splitting a host that holds too many pages.
    """
    folder = new_dir(pages.sparkSession, "pages")
    parsed = store(read_pages(pages), folder, "parsed")
    wrappers = store(infer_wrappers(parsed), folder, "wrappers").drop("wrapper")
    slim = F.transform("nodes", lambda x: F.struct(*(x[c].alias(c) for c in ("path", "parent", "place", "bits"))))
    rows = parsed.select("page_id", "url", "host", slim.alias("nodes"), "blocks").join(wrappers, "host", "left").drop("host")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(2, 7)]
            texts = [main_text(n, b, r, set(c or ()), set(t or ())) for n, b, r, c, t in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")
