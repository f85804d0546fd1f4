"""Main text of web pages by wrapper induction: the pages of a host are aligned, and what differs between them is content.

Each page is parsed into a tree of block elements, in which runs of like siblings (paragraphs, list items) are one
node. The distinct trees of a host are folded into its wrapper by simple tree matching, an ordered alignment of
children by dynamic programming. Over all articles of the host each wrapper node is then either template (one text
nearly everywhere, or a few in rotation) or a slot; the region that holds the slots' text is the article, less what its
elements or names mark as menu, advert, form, comments and the like. In runs of like siblings an element with one text
nearly everywhere is template on its own. An ``article`` or ``main`` element tells the region, not what is template.

Copies of an article count once: pages are told apart by their text in the slot that varies most, by characters times
entropy, so that neither a date nor an advert tells copies apart.
"""

from __future__ import annotations

import functools
import html
import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import land, table

TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?/][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?<![\w-])(hidden)(?![\w-])")
#: An unquoted value at the end, to which a slash there belongs.
UNQUOTED_END = re.compile(r"=\s*[^\s\"'>=]+\Z")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object select canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
REPEATED = frozenset("p li tr td th dt dd h1 h2 h3 h4 h5 h6 blockquote pre hr figure".split())
#: What an opening tag closes, up to one of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
CLOSE_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
DEPTH = 64
BOILER_TAG = frozenset("nav header footer aside form menu dialog button fieldset head".split())
BOILER_NAME = re.compile(
    r"(?:^|[\s_-])(?:nav|navbar|navigation|menu|breadcrumbs?|header|masthead|footer|sidebar|aside|ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|alert|gdpr|"
    r"popup|modal|overlay|share|sharing|social|related|recommend\w*|comments?|replies|reply|respond|disqus|newsletter|subscri\w*|signup|login|search|pagination|pager|widget|toolbar|copyright|disclaimer|skip|complementary|contentinfo|hidden)(?=$|[\s_-])"
)


def _self_closing(attributes: str) -> bool:
    return attributes.endswith("/") and UNQUOTED_END.search(attributes) is None


DROPPED = -2  # the element of what is too deep in the page to be one of its own and is in a menu or the like


class Page:
    """Block elements (tag, label, parent) in page order and the pieces of text, each with its element."""

    def __init__(self, source: str) -> None:
        self.tags, self.labels, self.parents, self.children = ["#root"], ["#root"], [-1], [[]]
        self.pieces: list[tuple[int, str, bool]] = []  # element, text, within a link
        stack: list[tuple[str, int]] = [("#root", 0)]  # open elements, and the block they belong to
        links = at = 0
        source = source.replace("\0", "")
        n = len(source)
        while at < n:
            m = TOKEN.search(source, at)
            if m is None:
                self.text(stack[-1][1], source[at:], links > 0)
                break
            if m.start() > at:
                self.text(stack[-1][1], source[at : m.start()], links > 0)
            at = m.end()
            if m[2] is None:
                continue
            tag, end = m[2].lower(), m[1] == "/"
            if end:
                if any(t == tag for t, _ in stack[1:]):
                    while stack[-1][0] != tag:
                        links -= stack.pop()[0] == "a"
                    links -= stack.pop()[0] == "a"
                if tag == "p" or tag not in INLINE:
                    self.pieces.append((-1, " ", False))
                continue
            if tag in RAW:
                if not _self_closing(m[3]):
                    close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                    at = close.end() if close else n
                continue
            if tag in VOID:
                if tag in ("br", "hr"):
                    self.pieces.append((-1, " ", False))
                continue
            if tag in INLINE:
                if not _self_closing(m[3]):
                    links += tag == "a"
                    stack.append((tag, stack[-1][1]))
                continue
            targets, stops = CLOSES.get(tag, (None, None))
            if tag in CLOSE_P:
                targets, stops = {"p"}, {"article", "blockquote", "body", "div", "li", "main", "section", "table", "td", "th"}
            if targets:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in targets:
                        while len(stack) > k:
                            links -= stack.pop()[0] == "a"
                        break
                    if stack[k][0] in stops:
                        break
            self.pieces.append((-1, " ", False))
            if len(stack) > DEPTH:  # deeper elements count as part of their ancestor
                stack.append((tag, DROPPED if tag in BOILER_TAG else stack[-1][1]))
                continue
            self.tags.append(tag)
            self.labels.append(self.label(tag, m[3]))
            self.parents.append(stack[-1][1])
            self.children.append([])
            self.children[stack[-1][1]].append(len(self.tags) - 1)
            stack.append((tag, len(self.tags) - 1))

    def text(self, block: int, raw: str, linked: bool) -> None:
        if block != DROPPED:
            self.pieces.append((block, html.unescape(raw) if "&" in raw else raw, linked))

    @staticmethod
    def label(tag: str, attributes: str) -> str:
        names = []
        if "=" in attributes or "hidden" in attributes:
            for m in ATTRIBUTE.finditer(attributes):
                if m[5] or m[1].lower() in ("class", "id", "role"):
                    names += (m[5] or m[2] or m[3] or m[4] or "").lower().split()
        return f"{tag} {' '.join(dict.fromkeys(re.sub(r'[0-9]+', '', x) for x in names))}".rstrip()

    def skeleton(self) -> tuple[list, list[int]]:
        """The tree with runs of like siblings merged, as [label, children], and the preorder number of each element."""
        number = [0] * len(self.tags)
        count = 0

        def build(label: str, members: list[int]) -> list:
            nonlocal count
            for e in members:
                number[e] = count
            count += 1
            groups: list[tuple[str, list[int]]] = []
            for e in members:
                for c in self.children[e]:
                    x = self.labels[c]
                    if groups and groups[-1][0] == x and (self.tags[c] in REPEATED or " " in x):
                        groups[-1][1].append(c)
                    elif len(members) > 1 and any(g[0] == x for g in groups):
                        next(g for g in groups if g[0] == x)[1].append(c)
                    else:
                        groups.append((x, [c]))
            return [label, [build(x, g) for x, g in groups]]

        return build("#root", [0]), number


def match(a: list, b: list, memo: dict) -> int:
    """Simple tree matching: the size of the largest ordered matching of two trees whose roots correspond."""
    if a[0] != b[0]:
        return 0
    key = id(a), id(b)
    if key not in memo:
        memo[key] = 1 + _table(a[1], b[1], memo)[-1][-1]
    return memo[key]


def _table(xs: list, ys: list, memo: dict) -> list[list[int]]:
    w = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
    for i, x in enumerate(xs):
        for j, y in enumerate(ys):
            w[i + 1][j + 1] = max(w[i][j + 1], w[i + 1][j], w[i][j] + match(x, y, memo))
    return w


def aligned(xs: list, ys: list, memo: dict) -> list[tuple[int, int]]:
    """The pairs of children that a largest matching puts together, in order."""
    w, i, j, out = _table(xs, ys, memo), len(xs), len(ys), []
    while i and j:
        m = match(xs[i - 1], ys[j - 1], memo)
        if m and w[i][j] == w[i - 1][j - 1] + m:
            out.append((i - 1, j - 1))
            i, j = i - 1, j - 1
        elif w[i][j] == w[i - 1][j]:
            i -= 1
        else:
            j -= 1
    return out[::-1]


def merged(a: list, b: list, memo: dict) -> list:
    """The wrapper ``a`` widened by what ``b`` has more, at its place among the siblings."""
    children, i, j = [], 0, 0
    for x, y in [*aligned(a[1], b[1], memo), (len(a[1]), len(b[1]))]:
        children += a[1][i:x] + b[1][j:y]
        if x < len(a[1]):
            children.append(merged(a[1][x], b[1][y], memo))
        i, j = x + 1, y + 1
    return [a[0], children]


def fold(trees: list[list]) -> list:
    wrapper = trees[0]
    for t in trees[1:]:
        wrapper = merged(wrapper, t, {})
    return wrapper


def placed(wrapper: list, tree: list) -> list[int]:
    """For each node of ``tree`` in preorder, its wrapper node's preorder number, or -1."""
    memo: dict = {}
    out: list[int] = []

    def nodes(t: list) -> int:
        return 1 + sum(nodes(c) for c in t[1])

    def walk(w: list | None, number: int, t: list) -> None:
        out.append(number)
        pairs = {y: x for x, y in aligned(w[1], t[1], memo)} if w else {}
        starts, at = [], number + 1
        for c in w[1] if w else []:
            starts.append(at)
            at += nodes(c)
        for y, c in enumerate(t[1]):
            walk(w[1][pairs[y]], starts[pairs[y]], c) if y in pairs else walk(None, -1, c)

    walk(wrapper, 0, tree)
    return out


NODE = pa.struct([("node", pa.int32()), ("text", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64()), ("words", pa.int64()), ("parts", pa.list_(pa.int64()))])
NODES = "host string, tree bigint, code string, texts array<struct<node:int,text:bigint,chars:bigint,linked:bigint,words:bigint,parts:array<bigint>>>"


def _hash(s: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _joined(pieces: list[str]) -> str:
    return " ".join(" ".join(pieces).split())


def _page_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page a row with its tree and its nodes with text; parts are the texts of their elements, short ones left out."""
    for batch in batches:
        rows: list[tuple] = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = Page(source)
            tree, number = page.skeleton()
            code = json.dumps(tree, ensure_ascii=False, separators=(",", ":"))
            texts: dict[int, list] = {}
            for e, text, linked in page.pieces:
                if e >= 0 and text and not text.isspace():
                    x = texts.setdefault(number[e], [[], 0, 0, {}])
                    x[0].append(text)
                    x[1] += len(text)
                    x[2] += len(text) * linked
                    x[3].setdefault(e, []).append(text)
            nodes = []
            for k, (pieces, chars, in_links, elements) in texts.items():
                whole = _joined(pieces)
                parts = {_hash(t) for t in map(_joined, elements.values()) if t.count(" ") + 1 >= WORDS}
                nodes.append((k, _hash(whole), chars, in_links, whole.count(" ") + 1, list(parts)))
            rows.append((host, _hash(code), code, nodes))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        types = (pa.string(), pa.int64(), pa.string(), pa.list_(NODE))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["host", "tree", "code", "texts"])


def _fold_group(df: pd.DataFrame) -> pd.DataFrame:
    df = df.sort_values(["pages", "code"], ascending=[False, True])
    return pd.DataFrame({"host": [df["host"].iloc[0]], "code": [json.dumps(fold([json.loads(c) for c in df["code"]]), ensure_ascii=False)], "pages": [int(df["pages"].sum())]})


def _place_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in frames:
        slots = [placed(json.loads(wrapper), json.loads(code)) for code, wrapper in df[["code", "wrapper"]].itertuples(index=False)]
        yield pd.DataFrame({"host": df["host"], "tree": df["tree"], "slots": slots})


#: Template: a text in this share of the articles, of FEW at least, or texts that are in ten each on average. Where an
#: element is marked as the article, only texts of so many words: shorter ones recur in articles of their own accord.
CONSTANT, ROTATING, FEW, WORDS = 0.9, 0.1, 5, 3


LEAST_OUTSIDE = 0.1


def _named(wrapper: list, varying: dict[int, float]) -> tuple[list[str], list[str], list[int], list[bool]]:
    """Of each wrapper node its tag, its names, its parent and whether it is in an element of menus, adverts and the like.

    A name can be wrong where a tag is not: if the elements so named leave less than ``LEAST_OUTSIDE`` of the ``varying`` text (by
    node) to the others, the name of the one with most of it does not count, and so on until they leave as much.
    """
    labels, parents = [], []

    def walk(t: list, parent: int) -> None:
        me = len(labels)
        labels.append(t[0])
        parents.append(parent)
        for c in t[1]:
            walk(c, me)

    walk(wrapper, -1)
    n = len(labels)
    tags = [x.split(" ", 1)[0] for x in labels]
    named = [x.split(" ", 1)[1] if " " in x else "" for x in labels]
    by_tag = [t in BOILER_TAG for t in tags]
    by_name = [not by_tag[i] and tags[i] not in ("body", "html", "main", "article") and BOILER_NAME.search(named[i]) is not None for i in range(n)]
    text = [0.0] * n  # of each subtree, without what tags exclude
    for i in range(n - 1, -1, -1):
        text[i] = 0.0 if by_tag[i] and i else text[i] + varying.get(i, 0.0)
        if i:
            text[parents[i]] += text[i]
    while True:
        boiler = [False] * n
        left = varying.get(0, 0.0)
        for i in range(1, n):
            boiler[i] = boiler[parents[i]] or by_tag[i] or by_name[i]
            left += 0.0 if boiler[i] else varying.get(i, 0.0)
        wrong = max((i for i in range(1, n) if by_name[i] and text[i] > 0), key=lambda i: text[i], default=None)
        if wrong is None or left >= LEAST_OUTSIDE * text[0]:
            break
        by_name[wrong] = False
    return tags, named, parents, boiler


def content_nodes(wrapper: list, stats: dict[int, tuple[int, int, int, int, int, int, int]]) -> list[bool]:
    """Which wrapper nodes are content.

    ``stats``: articles with text, pairs of article and text, distinct texts, articles of the commonest, and of the pairs
    the characters, those in links and the words.
    """
    is_fixed = {i: articles >= FEW and (top >= CONSTANT * articles or distinct <= ROTATING * pairs) for i, (articles, pairs, distinct, top, *_) in stats.items()}
    unlinked = {i: float(x[4] - x[5]) for i, x in stats.items() if not is_fixed[i] and x[5] <= 0.5 * x[4]}
    tags, named, parents, boiler = _named(wrapper, unlinked)
    n = len(tags)
    mass, fixed = [0.0] * n, [is_fixed.get(i, False) for i in range(n)]
    for i, (_, _, _, _, chars, linked, _) in stats.items():
        if not boiler[i] and linked <= 0.5 * chars:
            mass[i] = (chars - linked) * (0.05 if fixed[i] else 1.0)
    total = mass[:]
    for i in range(n - 1, 0, -1):
        total[parents[i]] += total[i]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(1, n):
        children[parents[i]].append(i)
    # the region: an article or main element with text, else down as long as one child has most of the text
    marked = [i for i in range(n) if not boiler[i] and total[i] > 0 and (tags[i] in ("article", "main") or re.search(r"(?:^| )(?:main|article|article-body|post-content|entry-content)(?: |$)", named[i]))]
    if marked:
        inner = [i for i in marked if tags[i] == "article" or not any(parents[j] == i or _under(parents, j, i) for j in marked)]
        regions = inner
    else:
        at = 0
        while (best := max(children[at], key=lambda c: total[c], default=None)) is not None and total[best] > 0.7 * total[at] > 0 and tags[best] not in REPEATED:
            at = best
        regions = [at]
    keep = [False] * n
    varied = any(mass[i] > 0 and not fixed[i] for i in range(n))
    for i in range(n):
        inside = any(i == r or _under(parents, i, r) for r in regions)
        menu = i in stats and stats[i][5] > 0.5 * stats[i][4] and fixed[i]
        template = varied and fixed[i] and (not marked or stats[i][6] >= WORDS * stats[i][1])
        keep[i] = inside and not boiler[i] and not menu and not template
    return keep


def _under(parents: list[int], i: int, ancestor: int) -> bool:
    while i >= 0:
        i = parents[i]
        if i == ancestor:
            return True
    return False


def _rank(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The slots of each host by which its pages are told apart, the best first."""
    for df in frames:
        orders = []
        for code, stats in df[["code", "stats"]].itertuples(index=False):
            boiler = _named(json.loads(code), {int(s["slot"]): max(0.0, float(s["weight"])) for s in stats})[3]
            orders.append([int(s["slot"]) for s in sorted(stats, key=lambda s: (-s["weight"], s["slot"])) if s["weight"] > 0 and not boiler[s["slot"]]])
        yield pd.DataFrame({"host": df["host"], "ranks": orders})


STATS = ("articles", "pairs", "distinct", "top", "chars", "linked", "words")


def _decide(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for df in frames:
        keep, common = [], []
        for code, stats in df[["code", "stats"]].itertuples(index=False):
            stats = stats if stats is not None else []
            nodes = content_nodes(json.loads(code), {int(s["slot"]): tuple(s[c] for c in STATS) for s in stats})
            keep.append([int(x) for x in nodes])
            common.append([{"slot": int(s["slot"]), "parts": [int(x) for x in s["parts"]]} for s in stats if nodes[s["slot"]] and len(s["parts"]) and s["top"] < CONSTANT * s["articles"]])
        yield pd.DataFrame({"host": df["host"], "wrapper": df["code"], "keep": keep, "common": common})


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    wrappers: dict[str, list] = {}
    places: dict[tuple[str, str], list[int]] = {}
    for batch in batches:
        out = []
        for source, wrapper, keep, common in zip(*[batch.column(c).to_pylist() for c in ("_html", "_wrapper", "_keep", "_common")], strict=True):
            page = Page(source)
            tree, number = page.skeleton()
            key = wrapper, json.dumps(tree, ensure_ascii=False)
            if key not in places:
                if len(places) > 5000:
                    wrappers.clear()
                    places.clear()
                if wrapper not in wrappers:
                    wrappers[wrapper] = json.loads(wrapper)
                places[key] = placed(wrappers[wrapper], tree)
            place, text, last = places[key], [], -1
            template = {x["slot"]: set(x["parts"]) for x in common}
            elements: dict[int, list[str]] = {}
            for e, piece, _ in page.pieces:
                if e >= 0 and place[number[e]] in template and piece and not piece.isspace():
                    elements.setdefault(e, []).append(piece)
            out_of = {e for e, x in elements.items() if _hash(_joined(x)) in template[place[number[e]]]}
            for e, piece, _ in page.pieces:
                if e < 0:
                    text.append(" ")
                elif place[number[e]] >= 0 and keep[place[number[e]]] and e not in out_of:
                    text.append(piece if e == last else " " + piece)
                    last = e
            out.append(" ".join("".join(text).split()))
        rest = [c for c in batch.schema.names if c not in ("_html", "_wrapper", "_keep", "_common")]
        yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.names.index(c)) for c in rest], pa.array(out, pa.string())], names=[*rest, "_main"])


SALTS = 64


def main_text(pages: DataFrame, text: str = "text") -> DataFrame:
    """``pages`` (with ``url`` and ``html``) without the html and with the main text of each, empty where there is none.

    Pages are grouped by the host of the url in lower case; those without one are a group. A null html is empty. Rows
    are kept as they are, repeated ones too; a column called like the text is replaced. Names with an underscore in
    front are reserved. A host with fewer than five distinct articles is cut by element names alone.
    """
    host = F.lower(F.coalesce(F.regexp_extract("url", "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    source = F.coalesce(F.col("html").cast("string"), F.lit(""))
    nodes = land(pages.select(host.alias("host"), source.alias("html")).mapInArrow(_page_nodes, NODES), "page-nodes")
    trees = nodes.groupBy("host", "tree").agg(F.first("code").alias("code"), F.count("*").alias("pages"))
    one = "host string, code string, pages bigint"
    partial = trees.withColumn("salt", F.pmod("tree", F.lit(SALTS))).groupBy("host", "salt").applyInPandas(lambda df: _fold_group(df), one)
    wrappers = land(partial.groupBy("host").applyInPandas(lambda df: _fold_group(df), one), "wrappers")
    places = land(trees.join(wrappers.select("host", F.col("code").alias("wrapper")), "host").mapInPandas(_place_rows, "host string, tree bigint, slots array<int>"), "places")
    within = "transform(texts, x -> named_struct('slot', slots[x.node], 'text', x.text, 'chars', x.chars, 'linked', x.linked, 'words', x.words, 'parts', x.parts))"
    slotted = nodes.where("size(texts) > 0").drop("code").join(places, ["host", "tree"]).select("host", F.expr(f"filter({within}, x -> x.slot >= 0)").alias("texts"))
    # by what the pages of a host are told apart: characters out of links times entropy
    texts = slotted.select("host", F.expr("inline(texts)")).groupBy("host", "slot", "text").agg(F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    varies = F.log(F.sum("n")) - F.sum(F.col("n") * F.log("n")) / F.sum("n")
    weights = texts.groupBy("host", "slot").agg(F.when(F.sum("linked") <= 0.5 * F.sum("chars"), (F.sum("chars") - F.sum("linked")) * F.round(varies, 9)).otherwise(0.0).alias("weight"))
    # a row per host, of the size of its wrapper
    weighed = weights.groupBy("host").agg(F.collect_list(F.struct("slot", "weight")).alias("stats"))
    ranks = land(wrappers.select("host", "code").join(weighed, "host").mapInPandas(_rank, "host string, ranks array<int>"), "ranks")
    best = "array_min(transform(filter(texts, x -> array_contains(ranks, x.slot)), x -> named_struct('at', array_position(ranks, x.slot), 'text', x.text))).text"
    articles = slotted.join(ranks, "host").select("host", F.expr(f"coalesce({best}, xxhash64(transform(texts, x -> x.text)))").alias("article"), F.expr("inline(texts)"))
    # each article once: with each slot (0), with each text there (1), with the text of each element (2)
    whole = F.array(*[F.struct(F.lit(k).alias("kind"), u.alias("unit")) for k, u in ((0, F.lit(0).cast("bigint")), (1, F.col("text")))])
    parts = F.transform("parts", lambda x: F.struct(F.lit(2).alias("kind"), x.alias("unit")))
    once = articles.select("host", "slot", "article", "chars", "linked", "words", F.inline(F.concat(whole, parts))).groupBy("host", "slot", "kind", "unit", "article").agg(*[F.max(c).alias(c) for c in ("chars", "linked", "words")])
    units = once.groupBy("host", "slot", "kind", "unit").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in ("chars", "linked", "words")])
    units = land(units.where(f"kind < 2 OR n >= {FEW}"), "units")
    is_text = F.col("kind") == 1
    slots = units.where("kind < 2").groupBy("host", "slot").agg(
        F.max(F.when(~is_text, F.col("n"))).alias("articles"), F.sum(F.when(is_text, F.col("n"))).alias("pairs"), F.count(F.when(is_text, 1)).alias("distinct"), F.max(F.when(is_text, F.col("n"))).alias("top"),
        *[F.sum(F.when(is_text, F.col(c))).alias(c) for c in ("chars", "linked", "words")],
    )
    constant = units.where("kind = 2").select("host", "slot", "unit", "n").join(slots.select("host", "slot", "articles"), ["host", "slot"]).where(f"n >= {CONSTANT} * articles")
    # at most as many as a page has elements
    constant = constant.groupBy("host", "slot").agg(F.collect_list("unit").alias("parts"))
    told = slots.join(constant, ["host", "slot"], "left").withColumn("parts", F.coalesce("parts", F.expr("cast(array() as array<bigint>)")))
    stats = told.groupBy("host").agg(F.collect_list(F.struct("slot", *STATS, "parts")).alias("stats"))
    decided = land(wrappers.select("host", "code").join(stats, "host", "left").mapInPandas(_decide, "host string, wrapper string, keep array<int>, common array<struct<slot:int,parts:array<bigint>>>"), "decided")
    named = decided.select(F.col("host").alias("_h"), F.col("wrapper").alias("_wrapper"), F.col("keep").alias("_keep"), F.col("common").alias("_common"))
    rest = pages.drop("html", text)
    rows = pages.select(*[pages[c] for c in rest.columns], source.alias("_html"), host.alias("_host")).join(named, F.col("_host") == F.col("_h")).drop("_host", "_h")
    types = T.StructType([*rest.schema.fields, T.StructField("_main", T.StringType())])
    return rows.mapInArrow(_extract, types).withColumnRenamed("_main", text)


def op4_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
