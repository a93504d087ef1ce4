"""HTML extraction by wrappers: union-free regular expressions inferred from the pages of a host.

Pages become streams of block tags and texts. The streams of a bounded sample of a host's pages are
aligned one after another: repeated siblings become repeated groups, what one stream lacks becomes
optional, texts that differ become slots. Counts over all pages of a host confirm the texts that the wrapper
has as fixed, or in a repeated group: these are the host's own, inside containers too. A page that the wrapper
doesn't match is aligned with it first. Each page's own elements say which container holds its article.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from difflib import SequenceMatcher

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.store import join_small, stored

PAGES_PER_HOST = 12
CONSTANT_PAGES = 4
CONSTANT_SHARE = 0.9
MOST_DEPTH = 150
TEXT = "#text"

# Element names of HTML and usual names of page parts.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr
    math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup
    msup mtable mtd mtext mtr munder munderover semantics""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "select", "object", "annotation-xml", "annotation")
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()
)
CLOSES_SAME = frozenset("li dt dd tr td th option thead tbody tfoot".split())
OTHER_PARTS = frozenset("nav footer aside form button dialog menu head title".split())
OTHER_NAMES = frozenset(
    """ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer
    form masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related respond
    share sharing sidebar social sponsor sponsored subscribe toolbar widget""".split()
)
# Those of them that name nothing else when they stand alone.
PART_NAMES = frozenset(
    """ad ads advert advertisement adverts breadcrumb breadcrumbs comments cookie cookies disqus footer masthead menu nav navbar
    navigation newsletter pagination promo sidebar sponsored toolbar""".split()
)
CONTAINERS = ("article", "main", "content", "post", "entry", "story")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + "|".join(RAW) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_DIGIT = re.compile(r"\d")
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def parse(page: str) -> list:
    """The page as a tree of [symbol, children]; a text is [TEXT, string, whether all of it is links]. Symbols hold name, class, id and role,
    without the words that hold a digit: those number a page or an element and differ where the template is one.

    Comments, scripts and other raw elements are gone, inline tags too; a line break is white space.
    Missing closing tags are supplied as browsers do.
    """
    root: list = ["#root", []]
    stack = [root]
    text: list[str] = []
    link, linked = False, True
    unseen: list[str] = []  # open elements within another part that lies too deep for the tree

    def flush() -> None:
        nonlocal linked
        own = " ".join(entities.unescape("".join(text)).split())
        if own:
            stack[-1][1].append([TEXT, own, linked])
        text.clear()
        linked = True

    for m in _TOKEN.finditer(page):
        if m["text"] is not None and unseen:
            continue
        if m["text"] is not None:
            text.append(m["text"])
            linked = linked and (link or not m["text"].strip())
            continue
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name in INLINE or name == "br":
            if name == "br":
                text.append(" ")
            if name == "a":
                link = not m["close"]
            continue
        if unseen or (len(stack) >= MOST_DEPTH and name in OTHER_PARTS and not m["close"]):
            flush()
            if not m["close"]:
                unseen += [name] if name not in VOID else []
            elif name in unseen:
                del unseen[len(unseen) - 1 - unseen[::-1].index(name) :]
            continue
        flush()
        if m["close"]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0].split(" ")[0] == name:
                    del stack[depth:]
                    break
            continue
        names = " ".join(w for x in _NAMED.findall(m["rest"] or "") for w in "".join(x).split() if not _DIGIT.search(w))
        if name in CLOSES_P and stack[-1][0].split(" ")[0] == "p" or name in CLOSES_SAME and stack[-1][0].split(" ")[0] == name:
            stack.pop()
        node = [f"{name} {names.lower()}".strip(), []]
        stack[-1][1].append(node)
        # Deeper elements stand side by side in the deepest one; their texts stay, but for those of other parts.
        if name not in VOID and not (m["rest"] or "").endswith("/") and len(stack) < MOST_DEPTH:
            stack.append(node)
    flush()
    return root


def generalised(node: list) -> list:
    """A page's tree as a wrapper: [symbol, optional, repeated, children]; a text is [TEXT, optional, False, string or None]."""
    if node[0] == TEXT:
        return [TEXT, False, False, node[1]]
    return [node[0], False, False, _folded([generalised(c) for c in node[1]])]


def _folded(items: list) -> list:
    """Neighbours of one symbol as one repeated group."""
    out: list = []
    for x in items:
        if out and x[0] != TEXT and out[-1][0] == x[0]:
            both = _aligned(out[-1], x)
            out[-1] = [both[0], out[-1][1] and x[1], True, both[3]]
        else:
            out.append(x)
    return out


def _aligned(a: list, b: list) -> list:
    """One wrapper element that covers both."""
    if a[0] == TEXT:
        return [TEXT, a[1] or b[1], False, a[3] if a[3] == b[3] else None]
    out = []
    left, right = a[3], b[3]
    for op, i, k, j, m in SequenceMatcher(None, [x[0] for x in left], [x[0] for x in right], autojunk=False).get_opcodes():
        if op == "equal":
            out += [_aligned(x, y) for x, y in zip(left[i:k], right[j:m])]
        else:
            out += [[x[0], True, *x[2:]] for x in [*left[i:k], *right[j:m]]]
    return [a[0], a[1] or b[1], a[2] or b[2], _folded(out)]


def infer(pages: list[str]) -> list:
    """The wrapper of a host's pages, aligned in the given order."""
    wrapper = None
    for page in pages:
        own = generalised(parse(page))
        wrapper = own if wrapper is None else _aligned(wrapper, own)
    return wrapper if wrapper is not None else ["#root", False, False, []]


def covers(wrapper: list, page: list) -> bool:
    """Whether the wrapper, as a regular expression over symbols, matches the whole page.

    Both trees are walked together. The children of an element are read once, with the set of places that the wrapper's
    children may have reached, and each pair of a wrapper's and a page's element is compared at most once.
    """
    known: dict[tuple[int, int], bool] = {}

    def skipped(items: list, places: set[int]) -> set[int]:
        for i in sorted(places):
            while i < len(items) and items[i][1]:
                i += 1
                places.add(i)
        return places

    def fits(own: list, x: list) -> bool:
        if own[0] != x[0] or own[0] == TEXT:
            return own[0] == x[0]
        if (id(own), id(x)) not in known:
            items, places = own[3], skipped(own[3], {0})
            for child in x[1]:
                found = {i for i in places if i < len(items) and fits(items[i], child)}
                places = skipped(items, {i + 1 for i in found} | {i for i in found if items[i][2]})
            known[id(own), id(x)] = len(items) in places
        return known[id(own), id(x)]

    return fits(wrapper, page)


def _names(symbol: str) -> list[str]:
    return re.split(r"[^a-z0-9]+", symbol)


def _other(node: list, path: str, inside: bool, own: frozenset[tuple[str, str]]) -> bool:
    """Whether an element is a part of the page rather than of its article.

    By its tag, or by a class, id or role that names such a part. A name that only may tell of one, as related-work
    or has-sidebar, counts if nothing but links and the host's own texts (paths and texts) stand in the element.
    """
    name, *named = node[0].split()
    if name in OTHER_PARTS or (name == "header" and not inside):
        return True
    if name in ("html", "body"):
        return False
    if not PART_NAMES.isdisjoint(named):
        return True
    return not OTHER_NAMES.isdisjoint(_names(" ".join(named))) and _only_own(node, path, own)


def _only_own(node: list, path: str, own: frozenset[tuple[str, str]]) -> bool:
    stack = [(node, path)]
    while stack:
        x, path = stack.pop()
        for child in x[1]:
            if child[0] != TEXT:
                stack.append((child, f"{path}/{child[0]}"))
            elif not child[2] and (path, child[1]) not in own:
                return False
    return True


def _kinds(symbol: str) -> set[str]:
    """The kinds of container that the element's tag or one of its class, id and role names tells."""
    told = [x for x in map(_names, symbol.split()) if OTHER_NAMES.isdisjoint(x)]
    return {c for c in CONTAINERS if any(c in x for x in told)}


def containers(page: list, own: frozenset[tuple[str, str]] = frozenset()) -> dict[str, set[int]]:
    """The elements (by ``id``) that may hold the article of this page, by kind, the best kind first.

    Those in or named as other parts only where the page has no better one.
    """
    for named in (False, True):
        found: dict[str, set[int]] = {}
        stack = [(page, page[0])]
        while stack:
            x, path = stack.pop()
            for child in x[1]:
                tag = child[0].split()[0]
                if child[0] == TEXT or tag == "header" or (tag in OTHER_PARTS and not (named and tag == "form")):
                    continue
                below = f"{path}/{child[0]}"
                if named or not _other(child, below, False, own):
                    for c in _kinds(child[0]):
                        found.setdefault(c, set()).add(id(child))
                    stack.append((child, below))
        if found:
            break
    return {c: found[c] for c in CONTAINERS if c in found}


def constants(wrapper: list) -> tuple[frozenset[tuple[str, str]], frozenset[str]]:
    """Paths and texts that every aligned page had in the same place, and the paths of texts in repeated groups."""
    fixed, repeated, stack = set(), set(), [(wrapper, wrapper[0], False)]
    while stack:
        x, path, group = stack.pop()
        for child in x[3]:
            if child[0] != TEXT:
                stack.append((child, f"{path}/{child[0]}", group or child[2]))
            elif group:
                repeated.add(path)
            elif child[3] is not None and not child[1]:
                fixed.add((path, child[3]))
    return frozenset(fixed), frozenset(repeated)


def places(page: list) -> list[tuple[str, str, str]]:
    """Place, path and text of each text; the place is the path of its container, or its own path outside one."""
    best = next(iter(containers(page).values()), set())
    out, stack = [], [(page, page[0], None)]
    while stack:
        x, path, place = stack.pop()
        for child in x[1]:
            if child[0] == TEXT:
                out.append((place or path, path, child[1]))
            else:
                below = f"{path}/{child[0]}"
                stack.append((child, below, place or (below if id(child) in best else None)))
    return out


def _key(*parts: str) -> int:
    raw = hashlib.blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(raw, "little", signed=True)


def own_texts(page: list, counted: frozenset[int], fixed: frozenset[tuple[str, str]], repeated: frozenset[str]) -> frozenset[tuple[str, str]]:
    """Paths and texts of the page that are its host's: of the wrapper, and confirmed by the counts."""
    if not counted:
        return frozenset()
    return frozenset(
        (path, text) for place, path, text in places(page)
        if ((path, text) in fixed or path in repeated) and _key(place, path, text) in counted
    )


def main_text(page: list, own: frozenset[tuple[str, str]]) -> str:
    """The article's blocks without the host's own texts: those of the page's best container that has any, else of the whole page.

    A container of nothing but the host's own texts is taken whole: its pages are near copies of one article.
    """
    for held in containers(page, own).values():
        if text := _blocks(page, held, own) or _blocks(page, held, frozenset()):
            return text
    return _blocks(page, None, own)


def _blocks(page: list, held: set[int] | None, own: frozenset[tuple[str, str]]) -> str:
    """Texts inside the containers, or on the whole page, without other parts and the host's own texts."""
    out: list[str] = []

    def walk(node: list, path: str, inside: bool) -> None:
        for child in node[1]:
            below = f"{path}/{child[0]}"
            if child[0] == TEXT:
                if inside and (path, child[1]) not in own:
                    out.append(child[1])
            elif held is not None and (not inside or id(child) in held):
                walk(child, below, inside or id(child) in held)
            elif not _other(child, below, held is not None, own):
                walk(child, below, True)

    walk(page, page[0], held is None)
    return "\n\n".join(out)


def extract(pages: DataFrame, html: str = "html", url: str = "url", per_host: int = PAGES_PER_HOST) -> DataFrame:
    """``pages`` with ``text``, the article's blocks joined by an empty line, and ``n_chars``.

    A host's wrapper is inferred from at most ``per_host`` of its different pages, chosen by hash; all its different
    pages are counted for the texts they share, and every page is extracted whole. Null html is empty and gives an
    empty text; pages with a null or odd url share the empty host; repeated rows give equal texts; columns named like
    the new ones are replaced; an empty input gives no rows.
    """
    from pyspark.sql import types as T

    pages = pages.drop("text", "n_chars")
    names = pages.columns
    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    given = pages.select(host.alias("host"), F.col(html).alias("page"), F.xxhash64(html).alias("print")).where("page is not null")
    order = Window.partitionBy("host").orderBy("print")
    sample = given.select("host", "print").distinct().withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= per_host)
    chosen = join_small(given, stored(sample, "sample"), ["host", "print"]).groupBy("host", "nth").agg(F.first("page").alias("page"))

    def learn(frame):
        import pandas as pd

        wrapper = infer(frame.sort_values("nth")["page"].tolist())
        return pd.DataFrame({"host": [frame["host"].iloc[0]], "_wrapper": [json.dumps(wrapper)]})

    learned = chosen.groupBy("host").applyInPandas(learn, "host string, _wrapper string")
    learned = learned.join(_shared_texts(given), F.xxhash64("host") == F.col("id"), "left")
    learned = stored(learned.select(F.col("host").alias("_host"), "_wrapper", "_counted"), "wrappers")
    known = join_small(pages.withColumn("_host", host), learned, ["_host"], "left")

    def apply(batches):
        import pyarrow as pa

        compiled: dict[str, tuple] = {}
        for batch in batches:
            columns = {n: batch.column(batch.schema.get_field_index(n)).to_pylist() for n in (html, "_host", "_wrapper", "_counted")}
            texts = []
            for page, host_name, raw, counted in zip(*columns.values()):
                tree = parse(page or "")
                if host_name not in compiled:
                    wrapper = json.loads(raw) if raw else infer([])
                    compiled[host_name] = (wrapper, frozenset(counted or ()), constants(wrapper))
                wrapper, shared, roles = compiled[host_name]
                if not covers(wrapper, tree):
                    roles = constants(_aligned(wrapper, generalised(tree)))
                texts.append(main_text(tree, own_texts(tree, shared, *roles)))
            kept = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], schema.names)

    return known.mapInArrow(apply, schema)


def _shared_texts(given: DataFrame) -> DataFrame:
    """Per hash of a host the keys of texts on nearly all of its different pages that have their place.

    At least ``CONSTANT_PAGES`` pages; a key is a hash of place, path and text, so a place has few of them.
    """

    def texts(batches):
        import pyarrow as pa

        for batch in batches:
            rows: set[tuple[int, int, int, int]] = set()
            seen: set[tuple[int, int]] = set()
            for id_, page, print_ in zip(*(c.to_pylist() for c in batch.columns)):
                if (id_, print_) in seen:
                    continue
                seen.add((id_, print_))
                known: dict[str, int] = {}
                for place, path, text in places(parse(page)):
                    if place not in known:
                        known[place] = _key(place)
                        rows.add((id_, known[place], known[place], print_))
                    rows.add((id_, known[place], _key(place, path, text), print_))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["id", "place", "key", "print"])

    found = given.select(F.xxhash64("host").alias("id"), "page", "print").mapInArrow(texts, "id long, place long, key long, print long")
    counts = found.distinct().groupBy("id", "place", "key").count().where(F.col("count") >= CONSTANT_PAGES)
    counts = stored(counts, "shared-texts")
    having = counts.where("key = place").select("id", "place", F.col("count").alias("having"))
    shared = counts.where("key <> place").join(having, ["id", "place"]).where(F.col("count") >= CONSTANT_SHARE * F.col("having"))
    return shared.groupBy("id").agg(F.collect_list("key").alias("_counted"))
