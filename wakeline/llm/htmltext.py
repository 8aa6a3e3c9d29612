"""Main text of HTML pages by a site style tree.

The DOMs of one host are merged: elements of the same path (tags with their classes and ids, digits
left out) are one node of the host's tree. Over all pages a node has as many presentations as
different rows of child tags, and as many contents as different texts below it; the entropy of both,
as a share of the greatest possible, is its importance. What a host repeats (notices, share bars,
teasers) has next to none and its branches are cut from every page. A node of few pages tells nothing, and
copies of a page are one page. A page that would be left without text keeps its repeated branches.

Menus and adverts may well differ on every page, so the roles that tags, classes and ids state count as
well: branches of a noise role go whatever their entropy; where a page marks its article, what is
outside goes. Inside the article the tree decides too, with the role as a prior: a branch must be a box of
its own (no bare paragraph, heading, item, cell or word of a sentence) and have half the importance.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from wakeline.llm.urls import host
from wakeline.sources.scratch import materialise

#: Weight of the contents' entropy beside that of the presentations.
CONTENT_SHARE = 0.9
LEAST_IMPORTANCE = 0.2
#: The same for a box inside a marked article.
LEAST_INSIDE = 0.1
#: Different pages of a host from which on a node's entropy is judged.
LEAST_COUNT = 8
#: Groups of copies up to which they are broadcast; they are counted first.
BROADCAST_ROWS = 50_000
#: The same for cut branches of all hosts (8 bytes each, twice at most).
BROADCAST_NODES = 1_000_000

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"<]*+"|'[^'<]*+')*+)>|<[!?/][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_WORD_RUNS = re.compile(r"[a-z]+")
_RAW = {t: re.compile(rf"</{t}\b", re.I) for t in ("script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "xmp")}

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag of the key closes an open element of these, unless one of the barriers lies between.
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
_BARRIERS = frozenset("ul ol dl table select article section div body html".split())
_CLOSES_P = _BLOCK - {"br", "body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "legend"}

#: Parts of the text they stand in, never boxes of their own inside an article; those of _FLOW unless they are named.
_PIECES = frozenset("html body article main h1 h2 h3 h4 h5 h6 li dt dd option legend caption tr td th tbody thead tfoot br hr".split())
_FLOW = frozenset("p pre blockquote".split())

_NOISE_TAGS = frozenset("nav footer aside form button select menu dialog head object".split())
_NOISE_NAMES = frozenset(
    "nav navigation navbar menu footer contentinfo sidebar aside complementary banner notice cookie cookies consent ad ads advert "
    "adverts advertisement sponsor sponsored promo form search comment comments disqus share sharing social related breadcrumb "
    "breadcrumbs popup modal newsletter subscribe".split()
)
_HEAD_NAMES = frozenset("header masthead topbar".split())
#: Names that say nothing at the end of a longer one (content-form, post-social): the tree decides on those.
_DOUBTFUL = frozenset("form search social related comment promo share sharing ad complementary consent".split())
#: Last words that make a box of what the first word names (comments-area, share-buttons, related-posts).
_CONTAINERS = frozenset(
    "area list box bar wrapper wrap container buttons icons links posts widget widgets section block panel items strip tray".split()
)
#: First words of names that state a page's layout or topic, not what the element is (has-sidebar, no-cookie, tag-menu).
_STATES = frozenset("has have no not without with is category tag topic type format term tax layout".split())
_ARTICLE = frozenset(("article", "main"))
#: Elements that names do not make noise.
_UNNAMED = _ARTICLE | {"html", "body"}

KEPT, INSIDE, NOISE, HEAD = 0, 1, 2, 3


@lru_cache(maxsize=10_000)
def _says(names: str) -> int:
    """Role that class tokens, id and role state by a whole token, by its last word, or by its first word where the last
    one is a container: NOISE, HEAD or KEPT."""
    head = False
    for token in names.split():
        words = _WORD_RUNS.findall(token)
        if not words:
            continue
        first, last = words[0], words[-1]
        if len(words) > 1 and first in _STATES:
            continue
        if len(words) > 1 and last in _CONTAINERS:
            last = first
        elif len(words) > 1 and last in _DOUBTFUL:
            continue
        if last in _NOISE_NAMES:
            return NOISE
        head = head or last in _HEAD_NAMES
    return HEAD if head else KEPT


def _with_roles(
    nodes: list[tuple[int, int, int, str, bool]], spared: frozenset[int] | set[int] = frozenset(), noisy: frozenset[int] | set[int] = frozenset()
) -> list[tuple[int, int, int, str, bool]]:
    """``nodes`` with roles in place of what their names say; names of ``spared`` nodes say nothing, ``noisy`` nodes are noise."""
    out = nodes[:1]
    for i in range(1, len(nodes)):
        parent, sign, says, tag, named = nodes[i]
        if i in noisy:
            says = NOISE
        elif i in spared or tag in _UNNAMED:
            says = KEPT
        role = out[parent][2]
        if role == NOISE or tag in _NOISE_TAGS or says == NOISE:
            role = NOISE
        elif role != INSIDE and (tag == "header" or says == HEAD):
            role = NOISE
        elif tag in _ARTICLE:
            role = INSIDE
        out.append((parent, sign, role, tag, named))
    return out


def _lesser_articles(nodes: list[tuple[int, int, int, str, bool]], texts: list[tuple[int, str, bool]]) -> set[int]:
    """Articles named as noise (a comment, a related story) that hold no more than half of the text outside of noise."""
    named = [i for i, n in enumerate(nodes) if n[3] == "article" and n[2] == NOISE]
    if not named:
        return set()
    found = _with_roles(nodes)
    below = [0] * len(nodes)
    for node, text, _ in texts:
        if found[node][2] != NOISE:
            below[node] += len(text.strip())
    for i in range(len(nodes) - 1, 0, -1):
        below[nodes[i][0]] += below[i]
    return {i for i in named if 2 * below[i] <= below[0]}


def _roles(nodes: list[tuple[int, int, int, str, bool]], texts: list[tuple[int, str, bool]]) -> list[tuple[int, int, int, str, bool]]:
    """``nodes`` with roles. Where noise names leave no article with text, the names of the ancestors of an article
    say nothing, if ``main`` or what articles not named as noise hold is longer than the rest that is kept."""
    noisy = _lesser_articles(nodes, texts)
    found = _with_roles(nodes, noisy=noisy)
    if not any(n[3] in _ARTICLE and i not in noisy for i, n in enumerate(nodes)):
        return found
    size = [0] * len(nodes)
    kept = 0
    for node, text, _ in texts:
        n = len(text.strip())
        size[node] += n
        if found[node][2] == INSIDE and n:
            return found
        kept += n if found[node][2] == KEPT else 0
    spared: set[int] = set()
    for i in range(1, len(nodes)):
        if nodes[i][3] == "main" or (nodes[i][3] == "article" and nodes[i][2] == KEPT):
            up = nodes[i][0]
            while up > 0 and up not in spared:
                spared.add(up)
                up = nodes[up][0]
    if not spared:
        return found
    freed = _with_roles(nodes, spared, noisy)
    inside = sum(n for n, node in zip(size, freed) if node[2] == INSIDE)
    in_main = [False] * len(nodes)
    for i in range(1, len(nodes)):
        in_main[i] = in_main[nodes[i][0]] or nodes[i][3] == "main"
    whole = any(n and m and node[2] == INSIDE for n, m, node in zip(size, in_main, freed))
    return freed if inside > kept or whole else found


def parse(page: str) -> tuple[list[tuple[int, int, int, str, bool]], list[tuple[int, str, bool]]]:
    """Nodes (parent, signature, role, tag, whether it is named) in page order, and texts (node, text, whether a block ends before it)."""
    nodes: list[tuple[int, int, int, str, bool]] = [(-1, 0, KEPT, "", False)]
    texts: list[tuple[int, str, bool]] = []
    stack = [0]
    at, broken = 0, True
    while True:
        m = _TAG.search(page, at)
        piece = page[at : m.start() if m else len(page)]
        if piece:
            texts.append((stack[-1], piece, broken))
            broken = False
        if m is None:
            return _roles(nodes, texts), texts
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[5] and not m[0].endswith(">"):
            continue  # a tag that the page's end cuts off
        if tag in _BLOCK:
            broken = True
        if m[1] or m[4]:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]][3] == tag:
                    del stack[depth:]
                    break
            continue
        closes = _CLOSES.get(tag)
        if closes or tag in _CLOSES_P:
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]][3]
                if (closes and open_tag in closes) or (tag in _CLOSES_P and open_tag == "p"):
                    del stack[depth:]
                    break
                if open_tag in _BARRIERS:
                    break
        parent = stack[-1]
        names = " ".join(v.strip("\"'").lower() for _, v in _NAMED.findall(m[3] or m[6] or ""))
        sign = xxh64_intdigest(f"{nodes[parent][1]}>{tag}.{_DIGITS.sub('', names)}") >> 1
        if tag in _RAW:
            end = _RAW[tag].search(page, at)
            at = end.start() if end else len(page)
            continue
        nodes.append((parent, sign, _says(names) if names else KEPT, tag, bool(names)))
        if tag not in _VOID and not m[0].endswith("/>"):
            stack.append(len(nodes) - 1)


def _is_box(tag: str, named: bool, in_text: bool) -> bool:
    """Whether an element of an article stands for itself; ``in_text``: its parent has text of its own."""
    if tag in _PIECES or (tag in _FLOW and not named):
        return False
    return tag in _BLOCK or (named and not in_text)


def main_text(
    page: str | None, cut: set[int] | frozenset[int] = frozenset(), inside: set[int] | frozenset[int] = frozenset()
) -> str:
    """Text of the page without noise roles, the branches whose signature is in ``cut``, and the article's boxes whose
    signature is in ``inside``; with these if there is no other text."""
    if not page:
        return ""
    nodes, texts = parse(page)
    return _left(nodes, texts, cut, inside) or (_left(nodes, texts, frozenset(), frozenset()) if cut or inside else "")


def _left(nodes, texts, cut, inside) -> str:
    marked = any(n[2] == INSIDE for n in nodes)
    speaks = {node for node, text, _ in texts if text.strip()} if inside else set()
    gone = [False] * len(nodes)
    for i, (parent, sign, role, tag, named) in enumerate(nodes):
        if i:
            gone[i] = (
                gone[parent]
                or role == NOISE
                or (role == KEPT and sign in cut)
                or (role == INSIDE and sign in inside and _is_box(tag, named, parent in speaks))
            )
    blocks: list[list[str]] = []
    fresh = True
    for node, text, broken in texts:
        fresh = fresh or broken
        if gone[node] or (marked and nodes[node][2] != INSIDE):
            fresh = True
            continue
        if fresh:
            blocks.append([])
            fresh = False
        blocks[-1].append(text)
    joined = (_SPACE.sub(" ", "".join(map(entities.unescape, b))).strip() for b in blocks)
    return " ".join(b for b in joined if b)


def observations(page: str | None) -> Iterator[tuple[int, int, int]]:
    """(signature, 0 for a presentation or 1 for a content, which one) of each node without a noise role, and
    (signature, 2, 0) once for each different one."""
    if not page:
        return
    nodes, texts = parse(page)
    below: list[list[int]] = [[] for _ in nodes]
    tags: list[list[str]] = [[] for _ in nodes]
    shown: set[int] = set()
    for node, text, _ in texts:
        flat = _SPACE.sub(" ", text).strip()
        if flat:
            below[node].append(xxh64_intdigest(flat))
    for i in range(len(nodes) - 1, 0, -1):
        parent, sign, role, tag, _ = nodes[i]
        content = xxh64_intdigest(repr(below[i]))
        below[parent].append(content)
        tags[parent].append(tag)
        if role != NOISE and below[i]:
            yield sign, 0, xxh64_intdigest("+".join(tags[i])) >> 1
            yield sign, 1, content >> 1
            shown.add(sign)
    for sign in shown:
        yield sign, 2, 0


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for name, page, copies in zip(batch.column("host").to_pylist(), batch.column("html"), batch.column("copies").to_pylist()):
            for item in observations(page.as_py()):
                seen[(name, *item)] += 1 / copies
        columns = list(zip(*seen)) or [[], [], [], []]
        kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, k) for c, k in zip(columns, kinds)), pa.array(list(seen.values()), pa.float64())],
            names=["host", "node", "kind", "which", "n"],
        )


def importance(pages: DataFrame) -> DataFrame:
    """host, node, count (of pages), importance (0 to 1) over the different ``pages`` (host, html): the merged tree's nodes.

    Each of n copies counts as the n-th part of a page, so that no text but that of copies is joined."""
    key = [F.xxhash64("html").alias("print"), F.char_length("html").alias("size")]
    known = pages.where(F.col("html").isNotNull()).select("host", "html", *key)
    copied = materialise(
        known.groupBy("host", "print", "size").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "copies"
    )
    right = F.broadcast(copied) if copied.count() <= BROADCAST_ROWS else copied
    counts = (
        known.join(right, ["host", "print", "size"], "left")
        .select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))
        .mapInArrow(_observed, "host string, node long, kind int, which long, n double")
        .groupBy("host", "node", "kind", "which")
        # The shares of copies make whole numbers up to rounding.
        .agg(F.round(F.sum("n")).alias("n"))
    )
    n = F.col("n")
    shares = counts.groupBy("host", "node", "kind").agg(F.sum("n").alias("count"), F.sum(n * F.log(n)).alias("s"))
    spread = F.when(F.col("count") > 1, 1 - F.col("s") / (F.col("count") * F.log("count"))).otherwise(1.0)
    weight = F.when(F.col("kind") == 1, CONTENT_SHARE).when(F.col("kind") == 0, 1 - CONTENT_SHARE).otherwise(0.0)
    shown = F.max(F.when(F.col("kind") == 2, F.col("count")))
    return shares.groupBy("host", "node").agg(shown.alias("count"), F.sum(spread * weight).alias("importance"))


def extract(pages: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text for each row of ``pages``.

    The whole page is read. Null and empty pages give an empty text; pages without host share one tree.
    Text in a block has its references decoded, white space turned into one space and its ends trimmed; blocks
    are joined in page order by one space. Repeated rows come back as often and count once. Other
    columns are not read. An empty table gives no rows.
    """
    named = pages.select(
        F.col(f"`{id_col}`").alias("page_id"),
        F.col(f"`{url}`").alias("url"),
        host(F.col(f"`{url}`").cast("string")).alias("host"),
        F.col(f"`{html}`").cast("string").alias("html"),
    )
    low = importance(named).where((F.col("count") >= LEAST_COUNT) & (F.col("importance") < LEAST_IMPORTANCE))
    strict = F.when(F.col("importance") < LEAST_INSIDE, F.col("node"))
    cut = materialise(low.groupBy("host").agg(F.collect_list("node").alias("cut"), F.collect_list(strict).alias("inside")), "branches")

    @F.pandas_udf("string")
    def text_of(page: pd.Series, branches: pd.Series, boxes: pd.Series) -> pd.Series:
        sets = ((p, *(frozenset(x) if x is not None else frozenset() for x in (b, i))) for p, b, i in zip(page, branches, boxes))
        return pd.Series([main_text(*s) for s in sets], dtype=object)

    nodes = cut.agg(F.sum(F.size("cut") + F.size("inside"))).first()[0] or 0
    right = F.broadcast(cut) if nodes <= BROADCAST_NODES else cut
    return named.join(right, "host", "left").select("page_id", "url", text_of("html", "cut", "inside").alias("text"))
