"""Main text of pages by wrapper induction.

Pages of one host share a template.  A wrapper is induced per host that has two or
more distinct pages: the trees of all of them are aligned with that of one by simple
tree matching, and what stands at aligned nodes is counted in Spark.  A text that
nearly all pages have is template.  So is a node whose other texts are rotated (most
also stand on other pages) or are mostly links: menus and adverts that vary go
by their structure, without a name.  The nodes left are slots; the wrapper's region
is the smallest part of the tree with nearly all text of the slots and the main
heading.  A page's text is that of the slots inside the region; a node the template
does not know is judged by the nearest node above that it knows.

What the page says of itself is a prior: inside the region, elements that are
menus, headers, footers, sidebars, notices, adverts, forms or reader comments by tag,
role or name are left out, and where a page marks its article, what is outside it.
Where a host has no wrapper, or the wrapper finds nothing on a page (one that copies
others), the prior alone decides.  A class or id is a name of noise if its parts are,
or only say how it is framed (``ad-slot``, ``site-footer``, but not ``how-to-share``);
those of ``html``, ``body``, ``main`` and an outer ``article`` never count, and those
of elements around the article only where another one is left.

Siblings with the same label are one node of the tree, a list of texts; so a
tree has the size of the template, not of the text.

Pages for which the prior takes the same text count once, as copies of one article
agree without being template.  As a few articles may share a heading or a passage, below
``SURE_PAGES`` pages no main heading, no text of ``PASSAGE`` characters and nothing at a
node with mostly varying text is template; such text outside the region goes all the same.

Defined results: a null or empty page has the empty text; repeated rows get the
same text, and null ids and URLs pass through (they share the host ``""``); an
empty table gives an empty result.  Only ``page_id``, ``url`` and
``html`` are read; other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructType

from brightweir.llm.common import staged
from brightweir.llm.url_filter import host_and_path
from brightweir.operators.lookup import key_counts, small_or_shuffled, spread_lookup

# Distinct pages of a host that are needed, the share of them in which a text must
# stand at the same place to be template, the pages needed for
# any text, and the characters a text must not reach with fewer.
LEAST_PAGES = 2
CONSTANT = 0.8
SURE_PAGES = 8
PASSAGE = 100
# Pages that a rotated text stands on, at least.
ROTATES = 3
# Shares of a node's text that make it rotated or a list of links, and of the text of
# all slots that a part of the tree must hold for the wrapper to step into it.
ROTATED = 0.5
LINKED = 0.5
REGION = 0.75
# Wrappers, or the pages that others are aligned with, up to this size in all are
# sent to every executor.
BROADCAST_BYTES = 16 << 20

# Trees that pages are aligned with, held by a worker at once.
TREES = 256

# What elements are, by the HTML standard and common class names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split()
)
NEVER = frozenset(
    "script style noscript template head title nav aside footer form button input select option textarea iframe object embed svg "
    "canvas audio video map dialog menu".split()
)
UNSEEN = frozenset("script style noscript template head title".split())
HEAD = frozenset("base link meta noscript script style template title".split())
ARTICLE = frozenset(("article",))
MAIN = frozenset(("main",))
NOISE = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo cookie cookies consent notice notices alert popup modal "
    "newsletter subscribe sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead toolbar share sharing social "
    "related recommended comment comments respond disqus widget pagination pager login signup".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
# A start tag ends an open element of the second set, up to one of the third.
_TABLE_CELL = frozenset(("td", "th"))
ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol"))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "tr": (frozenset(("tr",)), frozenset(("table",))),
    "td": (_TABLE_CELL, frozenset(("tr", "table"))),
    "th": (_TABLE_CELL, frozenset(("tr", "table"))),
}

# Their names say how the page is laid out, not what they are.
LAID_OUT = frozenset(("html", "body", "main"))
# Parts of names that say how or where noise is framed.
FRAME = frozenset(
    "area article articles bar block body bottom box btn button buttons center column container content entry fixed float form global "
    "header head icon icons image inline inner item items left link links list main middle mobile outer overlay page panel post posts "
    "primary reader region right row secondary section site slot small space sticky stories story text thread title top unit user "
    "wrap wrapper zone".split()
)

_PART = re.compile(r"[a-z]+")


def _names_noise(names: str) -> bool:
    """Whether a class or id is a name of noise: some parts are, and the others frame it."""
    for name in names.split():
        parts = set(_PART.findall(name))
        if parts & NOISE and parts <= NOISE | FRAME:
            return True
    return False


class Node:
    """A node of the reduced tree: a label, the nodes above and below, the blocks in it."""

    __slots__ = ("label", "path", "above", "below", "blocks")

    def __init__(self, label: str, above: Node | None = None) -> None:
        self.label, self.above = label, above
        self.path = xxhash.xxh32_intdigest(label.encode("utf-8", "replace"), above.path if above else 0)
        self.below: list[Node] = []
        self.blocks: list[Block] = []


class Block(NamedTuple):
    """A text, its node, the characters of it in links, and what the page says of it.

    ``noise`` names what is not article, ``sure`` the same if the names around an
    outer article or main are left out, ``unseen`` what no reader sees.
    """

    text: str
    node: Node
    linked: int
    noise: bool
    article: bool
    main: bool
    sure: bool
    unseen: bool


class _Open(NamedTuple):
    """An open element: its name, node, and what it makes of the text inside it."""

    name: str
    node: Node
    noise: bool = False
    article: bool = False
    main: bool = False
    sure: bool = False
    unseen: bool = False


class Page(HTMLParser):
    """Blocks and reduced tree of a page.

    A block is the text between two boundaries of elements that are not inline.
    """

    def __init__(self, html: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#")
        self.nodes = {}
        self.open = [_Open("#", self.root)]
        self.blocks: list[Block] = []
        self.text: list[str] = []
        self.link, self.linked = False, 0
        self.feed(html)
        self.close()
        self._end_block()

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """``<![...`` is a comment up to the next ``>``."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _end_block(self) -> None:
        if self.text:
            words = "".join(self.text).split()
            text, top = " ".join(words), self.open[-1]
            if words:
                block = Block(text, top.node, min(self.linked, len(text)), top.noise, top.article, top.main, top.sure, top.unseen)
                top.node.blocks.append(block)
                self.blocks.append(block)
            self.text, self.linked = [], 0

    def _close_to(self, depth: int) -> None:
        self._end_block()
        del self.open[depth:]

    def _find(self, names: frozenset, stops: frozenset = frozenset()) -> int:
        """Depth of the nearest open element of some names, 0 if there is none before a stop."""
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].name in names:
                return depth
            if self.open[depth].name in stops:
                return 0
        return 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in INLINE:
            if tag == "br":
                self.text.append(" ")
            self.link = self.link or tag == "a"
            if not any(name in ("class", "id", "role", "hidden") for name, _ in attrs):
                return
        else:
            self._end_block()
            if tag in ENDS:
                depth = self._find(*ENDS[tag])
            elif tag not in HEAD and self.open[-1].name == "head":
                depth = len(self.open) - 1
            else:
                depth = self._find(frozenset(("p",)), frozenset(("td", "th", "button", "object")))
            if depth:
                self._close_to(depth)
        if tag in VOID:
            return
        values = {name: value or "" for name, value in attrs}
        names = " ".join(sorted(values.get("class", "").lower().split()))
        top = self.open[-1]
        main = tag in MAIN or values.get("role", "").lower() == "main"
        outer = not (top.article or top.main and main) and (main or tag in ARTICLE)
        own = (
            tag in NEVER
            or (tag == "header" and not top.article)
            or values.get("role", "").lower() in NOISE_ROLES
            or "hidden" in values
        )
        named = not (outer or tag in LAID_OUT) and _names_noise(names + " " + values.get("id", "").lower())
        noise = top.noise or own or named
        # Names count within an article or main, not around it.
        sure = top.sure or own or (named and (top.article or top.main))
        if tag in INLINE and not noise:
            return
        if tag in INLINE:
            self._end_block()
        label = f"{tag}.{names}" if names else tag
        node = self.nodes.get((id(top.node), label))
        if node is None:
            node = self.nodes[id(top.node), label] = Node(label, top.node)
            top.node.below.append(node)
        unseen = top.unseen or tag in UNSEEN or "hidden" in values
        self.open.append(_Open(tag, node, noise, top.article or tag in ARTICLE, top.main or main, sure, unseen))

    def handle_endtag(self, tag: str) -> None:
        # A link that is left open ends with the element around it.
        self.link = self.link and tag in INLINE and tag != "a"
        depth = self._find(frozenset((tag,)))
        # The end of an inline element does not close a block around which it stands.
        if depth and not (tag in INLINE and any(e.name not in INLINE for e in self.open[depth + 1 :])):
            self._close_to(depth)
        elif tag not in INLINE:
            self._end_block()

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.link:
            self.linked += len(data)


def _heaviest(pairs: dict[int, list[tuple[int, int]]], width: int) -> list[tuple[int, int]]:
    """Pairs ``(i, j)``, rising in both, of the largest weight; ``pairs`` lists j and weight per i, rising."""
    # Per j the best chain that ends at or before it, in a tree of prefix maxima.
    best: list[tuple[int, tuple | None]] = [(0, None)] * (width + 1)

    def up_to(j: int) -> tuple[int, tuple | None]:
        found = best[0]
        while j:
            if best[j][0] > found[0]:
                found = best[j]
            j &= j - 1
        return found

    for i, choices in pairs.items():
        for j, weight in reversed(choices):
            before, chain = up_to(j)
            made = (before + weight, (i, j, chain))
            k = j + 1
            while k <= width:
                if made[0] > best[k][0]:
                    best[k] = made
                k += k & -k
    out, chain = [], up_to(width)[1]
    while chain:
        i, j, chain = chain
        out.append((i, j))
    return out[::-1]


def matched(a: Node, b: Node) -> list[tuple[Node, Node]]:
    """The largest set of pairs of nodes that keeps labels, ancestors and order (simple tree matching).

    Only children with equal labels are paired, each pair of nodes once; trees may be of any depth.
    """
    if a.label != b.label:
        return []
    waiting = [(a, b)]
    choices: list[dict[int, list[tuple[int, int]]]] = []
    # Pairs above come before pairs below; a choice holds j and the place of its pair.
    for x, y in waiting:
        places: dict[str, list[int]] = {}
        for j, node in enumerate(y.below):
            places.setdefault(node.label, []).append(j)
        mine: dict[int, list[tuple[int, int]]] = {}
        for i, node in enumerate(x.below):
            for j in places.get(node.label, ()):
                mine.setdefault(i, []).append((j, len(waiting)))
                waiting.append((node, y.below[j]))
        choices.append(mine)
    sizes, kept = [1] * len(waiting), [[]] * len(waiting)
    for n in range(len(waiting) - 1, -1, -1):
        mine = choices[n]
        if mine:
            weighed = {i: [(j, sizes[m]) for j, m in of] for i, of in mine.items()}
            kept[n] = [dict(mine[i])[j] for i, j in _heaviest(weighed, len(waiting[n][1].below))]
            sizes[n] += sum(sizes[m] for m in kept[n])
    out, stack = [], [0]
    while stack:
        n = stack.pop()
        out.append(waiting[n])
        stack += reversed(kept[n])
    return out


def text_key(path: int, text: str) -> int:
    """A place and the text there, as one signed number."""
    return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "replace"), path), "big", signed=True)


# A text at an aligned node: its key, the node, its characters, those in links.
Found = tuple[int, int, int, int]


def aligned(reference: Node, tree: Node) -> list[Found]:
    """The distinct texts that a page has at nodes aligned with the reference."""
    found = {}
    for a, b in matched(reference, tree):
        for block in b.blocks:
            if not block.unseen:
                key = text_key(a.path, block.text)
                found[key] = (key, a.path, len(block.text), block.linked)
    return sorted(found.values())


def digest_of(page: Page) -> bytes:
    """What copies of an article share: the text that the prior alone takes."""
    text = "\n".join(block.text for block in by_prior(page.blocks))
    return xxhash.xxh3_128_digest(text.encode("utf-8", "replace"))


class Wrapper(NamedTuple):
    """Of a host: keys of template texts, the nodes it knows, and those that are slots of its region."""

    template: frozenset[int]
    known: frozenset[int]
    slots: frozenset[int]


class Sums(NamedTuple):
    """Of a node over all pages: characters of constant, varying, rotated and linked texts; keys of the constant ones."""

    constant: int
    varying: int
    rotated: int
    linked: int
    keys: list[int]


def _tree(root: Node) -> list[Node]:
    """All nodes, those above first."""
    nodes = [root]
    for node in nodes:
        nodes += node.below
    return nodes


def judged(reference: Node, sums: dict[int, Sums], n_pages: int) -> Wrapper:
    """The wrapper of a host from what its pages hold at the nodes of the reference."""
    nodes = _tree(reference)
    headings = {node.path for node in nodes if node.label.split(".")[0] == "h1"}
    unlinked = {path: max(0, of.varying - of.linked) for path, of in sums.items()}
    whole = sum(unlinked.values())
    template, noise = set(), set()
    for path, of in sums.items():
        if n_pages >= SURE_PAGES or (of.constant >= of.varying and path not in headings):
            template.update(of.keys)
        # Articles and their headings may be repeated: what holds most of the host's own text is no rotated slot.
        turning = of.varying and of.rotated >= ROTATED * of.varying and 2 * unlinked[path] < whole and path not in headings
        if turning or of.linked >= LINKED * (of.constant + of.varying):
            noise.add(path)
    prose = {node.path: 0 if node.path in noise else unlinked.get(node.path, 0) for node in nodes}
    below = dict(prose)
    for node in reversed(nodes[1:]):
        below[node.above.path] += below[node.path]
    known = {node.path for node in nodes}
    if not below[reference.path]:
        return Wrapper(frozenset(template), frozenset(known), frozenset())
    region = reference
    while True:
        inner = [n for n in region.below if n.below and below[n.path] >= REGION * below[region.path]]
        if not inner:
            break
        region = inner[0]
    # The main heading belongs to the text, also where it stands before it.
    inside = {n.path for n in _tree(region)}
    for node in nodes:
        if node.path in headings and prose[node.path] and node.path not in inside:
            around = set()
            while node is not None:
                around.add(node.path)
                node = node.above
            while region.path not in around:
                region = region.above
            inside = {n.path for n in _tree(region)}
    dropped = set(noise)
    for node in nodes[1:]:
        if node.above.path in dropped:
            dropped.add(node.path)
    return Wrapper(frozenset(template), frozenset(known), frozenset(inside - dropped))


def induced(pages: list[str]) -> Wrapper | None:
    """The wrapper of some pages of a host, as ``wrappers`` makes it for all hosts; None for too few pages."""
    found: dict[bytes, list[Found]] = {}
    reference = Page(pages[0]).root
    for html in pages:
        page = Page(html)
        mine = aligned(reference, page.root)
        digest = digest_of(page)
        found[digest] = min(found.get(digest, mine), mine)
    if len(found) < LEAST_PAGES:
        return None
    counts = Counter(one for mine in found.values() for one in mine)
    sums: dict[int, Sums] = {}
    for (key, path, chars, linked), n in counts.items():
        old = sums.get(path, Sums(0, 0, 0, 0, []))
        size, constant = n * chars, n >= CONSTANT * len(found)
        rotated = size * (not constant and n >= ROTATES)
        new = (old.constant + size * constant, old.varying + size * (not constant), old.rotated + rotated, old.linked + n * linked)
        sums[path] = Sums(*new, old.keys + [key] * (constant and (len(found) >= SURE_PAGES or chars < PASSAGE)))
    return judged(reference, sums, len(found))


def by_prior(blocks: list[Block]) -> list[Block]:
    """The blocks that are main text by what the page says of itself."""
    for wanted in ("article", "main"):
        if any(getattr(block, wanted) for block in blocks):
            blocks = [block for block in blocks if getattr(block, wanted)]
            if all(block.noise for block in blocks):
                return [block for block in blocks if not block.sure]
            break
    return [block for block in blocks if not block.noise]


def by_wrapper(blocks: list[Block], wrapper: Wrapper) -> list[Block]:
    """The blocks that the wrapper takes, whatever their elements are called."""

    def takes(block: Block) -> bool:
        node = block.node
        while node.path not in wrapper.known and node.above:
            node = node.above
        return node.path in wrapper.slots and text_key(block.node.path, block.text) not in wrapper.template

    return [block for block in blocks if not block.unseen and takes(block)]


def main_text(html: str, wrapper: Wrapper | None = None, prior: bool = True) -> str:
    """The main text of a page, one line per block; without ``prior``, by the wrapper alone."""
    blocks = Page(html).blocks
    taken = by_wrapper(blocks, wrapper) if wrapper else []
    if prior or not taken:
        taken = by_prior(taken) or by_prior(blocks)
    return "\n".join(block.text for block in taken)


WRAPPER = StructType().add("template", ArrayType(LongType())).add("known", ArrayType(LongType())).add("slots", ArrayType(LongType()))
_FOUND = StructType().add("key", LongType()).add("path", LongType()).add("chars", LongType()).add("linked", LongType())


@F.arrow_udf(StringType())
def _main_texts(pages: pa.Array, wrappers: pa.Array) -> pa.Array:
    rows = zip(pages.to_pylist(), wrappers.to_pylist())
    return pa.array([main_text(html or "", _wrapper(made)) for html, made in rows], pa.string())


def _wrapper(made: dict | None) -> Wrapper | None:
    return made and Wrapper(*(frozenset(made[name]) for name in Wrapper._fields))


@lru_cache(TREES)
def _reference(html: str) -> Node:
    """The tree of a page, without its texts."""
    page = Page(html)
    for node in _tree(page.root):
        node.blocks = []
    return page.root


@F.arrow_udf(StructType().add("digest", BinaryType()).add("found", ArrayType(_FOUND)))
def _aligned(pages: pa.Array, references: pa.Array) -> pa.Array:
    digests, found = [], []
    for html, reference in zip(pages.to_pylist(), references.to_pylist()):
        page = Page(html or "")
        digests.append(digest_of(page))
        found.append([dict(zip(("key", "path", "chars", "linked"), one)) for one in aligned(_reference(reference), page.root)])
    kind = pa.struct([(name, pa.int64()) for name in ("key", "path", "chars", "linked")])
    return pa.StructArray.from_arrays([pa.array(digests, pa.binary()), pa.array(found, pa.list_(kind))], ["digest", "found"])


@F.arrow_udf(WRAPPER)
def _judged(references: pa.Array, sums: pa.Array, n_pages: pa.Array) -> pa.Array:
    out = []
    for html, nodes, n in zip(references.to_pylist(), sums.to_pylist(), n_pages.to_pylist()):
        table = {node["path"]: Sums(*(node[name] for name in Sums._fields)) for node in nodes}
        made = judged(_reference(html), table, n)
        out.append({name: sorted(values) for name, values in made._asdict().items()})
    kind = pa.list_(pa.int64())
    return pa.array(out, pa.struct([(name, kind) for name in Wrapper._fields]))


def _with_host(rows: DataFrame, dimension: DataFrame, size: Column) -> DataFrame:
    """Left join on the host: a broadcast up to ``BROADCAST_BYTES``, else spread."""
    if (dimension.agg(F.sum(size + F.length("host"))).first()[0] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(dimension), "host", "left")
    return spread_lookup(rows, dimension.join(key_counts(rows, "host"), "host"), "host", ["page_id", "url"])


def references(pages: DataFrame) -> DataFrame:
    """Per host with rows enough for a template, the page that the others are aligned with."""
    drawn = pages.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("page_id").alias("draw"), "page_id")).alias("first")
    )
    drawn = drawn.where(F.col("n") >= LEAST_PAGES).select(F.col("host").alias("of_host"), F.col("first.page_id").alias("drawn_id"))
    drawn = staged(drawn, "drawn")
    here = F.col("page_id").eqNullSafe(F.col("drawn_id")) & (F.col("host") == F.col("of_host"))
    chosen = pages.join(small_or_shuffled(drawn), here)
    return staged(chosen.groupBy("host").agg(F.min(F.coalesce("html", F.lit(""))).alias("reference")), "references")


def wrappers(pages: DataFrame) -> DataFrame:
    """Per host with two distinct pages, its wrapper.  ``pages`` has host, page_id, url and html."""
    chosen = references(pages)
    rows = _with_host(pages, chosen, F.length("reference")).where(F.col("reference").isNotNull())
    made = rows.select("host", _aligned.asNondeterministic()("html", "reference").alias("made")).select("host", "made.*")
    # Copies of an article are one page, also where their trees differ.
    distinct = staged(made.groupBy("host", "digest").agg(F.min("found").alias("found")), "aligned")
    n_pages = distinct.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages")).where(F.col("n_pages") >= LEAST_PAGES)
    counts = distinct.select("host", F.inline("found")).groupBy("host", "key", "path", "chars")
    counts = staged(counts.agg(F.count(F.lit(1)).alias("n"), F.sum("linked").alias("linked")), "counts")
    counts = spread_lookup(counts, n_pages.join(key_counts(counts, "host"), "host"), "host", ["key"]).where("n_pages is not null")
    constant = F.col("n") >= CONSTANT * F.col("n_pages")
    size = F.col("n") * F.col("chars")
    nodes = counts.groupBy("host", "path").agg(
        F.sum(F.when(constant, size).otherwise(0)).alias("constant"),
        F.sum(F.when(constant, 0).otherwise(size)).alias("varying"),
        F.sum(F.when(constant | (F.col("n") < ROTATES), 0).otherwise(size)).alias("rotated"),
        F.sum("linked").alias("linked"),
        # At most 1 / CONSTANT times the texts of a page are constant.
        F.collect_list(F.when(constant & ((F.col("n_pages") >= SURE_PAGES) | (F.col("chars") < PASSAGE)), F.col("key"))).alias("keys"),
        F.first("n_pages").alias("n_pages"),
    )
    # A host has no more nodes than its reference.
    hosts = nodes.groupBy("host").agg(F.collect_list(F.struct("path", *Sums._fields)).alias("sums"), F.first("n_pages").alias("n_pages"))
    made = hosts.join(chosen, "host").select("host", _judged.asNondeterministic()("reference", "sums", "n_pages").alias("wrapper"))
    return staged(made, "wrappers")


def extracted(pages: DataFrame) -> DataFrame:
    """Per page its main text and the number of its code points."""
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    size = F.size("wrapper.template") + F.size("wrapper.known") + F.size("wrapper.slots")
    joined = _with_host(rows, wrappers(rows), 8 * size)
    made = joined.select("page_id", "url", _main_texts.asNondeterministic()("html", "wrapper").alias("text"))
    return made.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
