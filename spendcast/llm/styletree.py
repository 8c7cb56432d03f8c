"""Main text of web pages by site style trees.

The element trees of all pages of a host are merged: elements with the same
path of labels (tag, classes, id) are one node of the host's style tree. A node
has two kinds of importance. Its presentation counts by the entropy of the
child sequences that its pages show, to the base of the number of pages: a node
that looks the same everywhere has 0. Its content counts by 1 less the mean
entropy of its text blocks: a block on every page has entropy 1, one on a
single page 0. With c children on average, the two are weighed 1 - 0.9^c and
0.9^c. Branches under the threshold are removed from each page.

Importance alone cannot tell an advert whose text is new on each page from an
article, nor judge a host with few pages. Elements whose tag, class or role says
what they are (menus, footers, adverts, comments, ...) are therefore removed by
that. Words that name content as well (widget, related, form, ...) do so only
where they hold at most half of the page's words, and names remove nothing where
no other text is left; what they leave is judged by the style tree. Branches inside an element that is marked as the article or main element
are judged like all others; the marked element and what is around it are not
removed, and where nothing of the marked elements would be left, they stay as
they are.

Text blocks are cut at block elements; references are decoded, white space
becomes one space, and blocks are joined by a line feed. Where articles hold at
least half of the words that a page has left, only they count, with the title
of a main element around them; else only main elements, where those hold half;
else the whole page.

Defined results: null and empty pages have an empty text; a null url is a host
of its own that is never judged by entropy; repeated rows count as pages of
their own in the entropy and are all returned; broken markup is read as far as
it goes; an empty table gives an empty result; other columns stay. A page of
any length is read whole.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendcast.llm.common import stored

# Elements without content of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page.
SKIPPED = frozenset(
    "head script style noscript template iframe object svg math canvas audio video select option button textarea input"
    " nav footer aside dialog".split()
)
# Elements that end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select"
    " summary table tbody td tfoot th thead title tr ul".split()
)
# Elements that end an open paragraph.
ENDS_P = BLOCKS - frozenset("body caption html legend li dd dt option optgroup summary tbody td tfoot th thead title tr".split()) - {"li"}
# An open element that ends where one of these begins.
SIBLINGS = {
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr", "td", "th"}),
    "td": frozenset({"td", "th"}), "th": frozenset({"td", "th"}), "option": frozenset({"option"}),
}
# Words in class, id or role that say what an element is.
NOISE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising alert alertdialog banner breadcrumb breadcrumbs comment comments"
    " complementary consent contentinfo cookie cookies copyright dialog discussion discussions disqus footer form gdpr header"
    " login masthead menu modal nav navbar navigation newsletter notice notices outbrain pager pagination popup promo promotion"
    " recommended related replies reply respond responses search share sharing sidebar signup social sponsor sponsored subscribe"
    " taboola teaser teasers toolbar topbar widget widgets".split()
)
# Those of them that name content too, and the form element. They remove at most half of a page's words.
LOOSE_WORDS = frozenset(
    "alert discussion discussions form notice notices related replies reply respond response responses search teaser teasers"
    " widget widgets".split()
)
# Words that make such a name one of the page around it (has-sidebar, sidebar-layout).
AROUND_WORDS = frozenset("has no not with without".split())
AROUND_LAST = frozenset("layout page site template".split())
IN_ARTICLE_KEPT = frozenset("alert banner header notice notices teaser teasers".split())
# Elements that are no box around text but text; inside an article loose words say nothing of them.
TEXT_TAGS = frozenset("blockquote h1 h2 h3 h4 h5 h6 p".split())
# What stands in an open head; all else ends it.
HEAD_TAGS = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())

# Reasons to remove an element, beside the loose words themselves.
UNSEEN, NAMED = "", "*"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(
    r"""(?<![\w-])(class|id|role|hidden|aria-hidden|style|itemprop)(?![\w-])(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I
)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_RAW = {tag: re.compile(rf"</{tag}\b", re.I) for tag in ("script", "style", "textarea", "title", "noscript", "iframe")}
_OPENED = re.compile(r"</?[a-zA-Z]")
_DIGITS = re.compile(r"\d+")
_SPLIT = re.compile(r"[^a-z]+")
# A word, or a letter of a script that leaves no space between words.
_CLOSE = "\\u0e00-\\u0eff\\u1000-\\u109f\\u1780-\\u17ff\\u3040-\\u30ff\\u3400-\\u9fff\\U00020000-\\U0003ffff"
_WORD = re.compile(rf"[{_CLOSE}]|[^\W{_CLOSE}]+")

# Bits of a block's place.
IN_MAIN, IN_ARTICLE, TITLE = 1, 2, 4

PARSED = (
    "blocks array<struct<text string, chain array<bigint>, place int, words int>>,"
    " nodes array<struct<path bigint, style bigint, children int>>,"
    " features array<struct<path bigint, block bigint>>"
)


def _hash(text: str, seed: int = 0) -> int:
    value = xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), seed & (1 << 64) - 1)
    return value - (1 << 64) if value >= 1 << 63 else value


class _Element:
    __slots__ = ("tag", "path", "reasons", "article", "main", "children", "listed", "outer", "chain")

    def __init__(
        self, tag: str, path: int, reasons: frozenset, article: bool, main: bool, listed: bool, outer: tuple, chain: tuple
    ) -> None:
        self.tag, self.path, self.reasons, self.article, self.main = tag, path, reasons, article, main
        self.children: list[str] = []
        self.listed = listed  # counts as a node of the style tree
        self.outer = outer  # paths of the nodes around, itself included
        self.chain = chain  # those of them whose removal removes its text


def _reasons(tag: str, names: list[str], hidden: bool, inside: bool) -> set[str]:
    """Why the element may be no text of the page: ``UNSEEN``, ``NAMED`` or loose words."""
    if tag in SKIPPED or hidden or (tag == "header" and not inside):
        return {UNSEEN}
    if tag in ("html", "body"):  # their classes speak of the page
        return set()
    out = {"form"} if tag == "form" else set()
    for name in names:
        words = [w for w in _SPLIT.split(_HUMP.sub("-", name).lower()) if w]
        found = NOISE_WORDS.intersection([*words, *(a + b for a, b in zip(words, words[1:]))])  # also side-bar
        if inside:
            found = found - IN_ARTICLE_KEPT
            if tag in TEXT_TAGS:
                found = found - LOOSE_WORDS
        if found and words[-1] not in AROUND_LAST and not AROUND_WORDS.intersection(words):
            out.update(word if word in LOOSE_WORDS else NAMED for word in found)
    return out


def choose(blocks: list[dict]) -> list[dict]:
    """The blocks in articles, in main elements, or all: the first that has at least half of the words. ``CHOSEN`` is the same rule."""
    for counted, taken in ((IN_ARTICLE, IN_ARTICLE | TITLE), (IN_MAIN, IN_MAIN)):
        if 2 * sum(b["words"] for b in blocks if b["place"] & counted) >= sum(b["words"] for b in blocks):
            return [b for b in blocks if b["place"] & taken]
    return blocks


def _words(of: str) -> str:
    return f"aggregate(left, 0L, (n, b) -> n + if({of}, b.words, 0))"


# The chosen blocks of the column left.
CHOSEN = (
    f"case when 2 * {_words(f'b.place & {IN_ARTICLE} <> 0')} >= {_words('true')} then filter(left, b -> b.place & {IN_ARTICLE | TITLE} <> 0)"
    f" when 2 * {_words(f'b.place & {IN_MAIN} <> 0')} >= {_words('true')} then filter(left, b -> b.place & {IN_MAIN} <> 0) else left end"
)


def parse(page: str | None) -> tuple[list, list, list]:
    """``read_page`` with the blocks that count where no node is removed."""
    blocks, nodes, features = read_page(page)
    return choose(blocks), nodes, features


def read_page(page: str | None) -> tuple[list, list, list]:
    """Of one page: text blocks with the nodes that can remove them, nodes with their child sequence, blocks of nodes."""
    page = page or ""
    root = _Element("", 0, frozenset(), False, False, False, (), ())
    stack = [root]
    blocks: list[tuple[frozenset, dict]] = []
    shares: Counter[str] = Counter()  # words by reason
    total = 0
    styles: dict[int, list[str]] = {}
    counts: dict[int, list[int]] = {}
    features: set[tuple[int, int]] = set()
    words: list[str] = []

    def end_block() -> None:
        nonlocal total
        if not words:
            return
        text = " ".join("".join(words).split())
        words.clear()
        if text:
            top = stack[-1]
            block = _hash(text)
            features.update((path, block) for path in top.outer)
            count = max(1, len(_WORD.findall(text)))
            total += count
            for reason in top.reasons:
                shares[reason] += count
            if UNSEEN not in top.reasons:
                place = IN_MAIN * top.main | IN_ARTICLE * top.article | TITLE * (top.main and not top.article and top.tag == "h1")
                blocks.append((top.reasons, {"text": text, "chain": list(top.chain), "place": place, "words": count}))

    def close(size: int) -> None:
        while len(stack) > size:
            done = stack[-1]
            if done.tag in BLOCKS:
                end_block()
            stack.pop()
            if done.listed:
                styles.setdefault(done.path, []).append(",".join(done.children))
                counts.setdefault(done.path, []).append(len(done.children))

    def open_tag(tag: str, raw: str) -> None:
        if stack[-1].tag == "head" and tag not in HEAD_TAGS:
            close(len(stack) - 1)
        if tag in BLOCKS:
            end_block()
        if tag in ENDS_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCKS and stack[i].tag != "p":
                    break
        if tag in SIBLINGS:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SIBLINGS[tag]:
                    close(i)
                    break
                if stack[i].tag in ("ul", "ol", "dl", "table", "select", "div", "article", "section"):
                    break
        top = stack[-1]
        names: list[str] = []
        label, hidden, marked = tag, False, tag in ("article", "main")
        if raw and raw != "/":
            for name, a, b, c in _ATTRIBUTE.findall(raw):
                value, name = a or b or c, name.lower()
                if name in ("hidden", "aria-hidden"):
                    hidden = hidden or (value.lower() != "false" if name == "hidden" else value.lower() == "true")
                elif name == "style":
                    hidden = hidden or _UNSEEN.search(value) is not None
                elif name == "itemprop":
                    marked = marked or value == "articleBody"
                elif name == "role":
                    marked = marked or value == "main"
                    names.append(value)
                else:
                    names.extend(value.split() if name == "class" else [value])
                    label += ("." if name == "class" else "#") + _DIGITS.sub("", value)
        top.children.append(label)
        if tag in VOID or raw.endswith("/"):
            if tag == "br":
                words.append(" ")
            return
        inside = top.article or top.main
        reasons = top.reasons if UNSEEN in top.reasons else top.reasons.union(_reasons(tag, names, hidden, inside))
        noise = UNSEEN in reasons or NAMED in reasons
        article = not noise and (top.article or (marked and tag != "main" and "main" not in names))
        main = not noise and (top.main or (marked and not article))
        # Below an element that is no text there are no more nodes; the text belongs to that element.
        marks = (article and not top.article) or (main and not top.main)  # protects itself and what is around it
        listed = UNSEEN not in top.reasons and not marks and tag not in ("html", "body") and tag in BLOCKS
        path = _hash(label, top.path)
        own = (path,) if listed else ()
        stack.append(_Element(tag, path, reasons, article, main, listed, (*top.outer, *own), () if marks else (*top.chain, *own)))

    at = 0
    while at < len(page):
        found = _TOKEN.search(page, at)
        stop = found.start() if found else len(page)
        if stop > at:
            piece = page[at:stop]
            if (broken := _OPENED.search(piece)) is not None:  # a tag that never ends
                piece = piece[: broken.start()]
            if stack[-1].tag == "head" and not piece.isspace():
                close(len(stack) - 1)
            words.append(html.unescape(piece) if "&" in piece else piece)
        if not found:
            break
        at = max(found.end(), stop + 1)
        tag = found[2]
        if not tag:
            continue
        tag = tag.lower()
        if found[1]:
            if tag in BLOCKS:
                end_block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        open_tag(tag, found[3].rstrip())
        if tag in _RAW and stack[-1].tag == tag:
            end = _RAW[tag].search(page, at)
            at = end.start() if end else len(page)
    end_block()
    close(1)
    nodes = [{"path": p, "style": _hash("|".join(s)), "children": sum(counts[p]) // len(counts[p])} for p, s in styles.items()]
    excused = {reason for reason in LOOSE_WORDS if 2 * shares[reason] > total}
    kept = [block for reasons, block in blocks if reasons <= excused] or [block for _, block in blocks]
    return kept, nodes, [{"path": p, "block": b} for p, b in features]


def _parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = {
        "blocks": pa.list_(
            pa.struct([("text", pa.string()), ("chain", pa.list_(pa.int64())), ("place", pa.int32()), ("words", pa.int32())])
        ),
        "nodes": pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64()), ("children", pa.int32())])),
        "features": pa.list_(pa.struct([("path", pa.int64()), ("block", pa.int64())])),
    }
    for batch in batches:
        html_at, row_at = batch.schema.get_field_index("tree_html"), batch.schema.get_field_index("tree_row")
        for start in range(0, batch.num_rows, 500):  # small portions: what a page parses to is larger than the page
            part = batch.slice(start, 500)
            parsed = list(zip(*(read_page(v.as_py()) for v in part.column(html_at))))
            arrays = [pa.array(list(column), kind) for column, kind in zip(parsed, types.values())]
            host = part.column(batch.schema.get_field_index("tree_host"))
            yield pa.RecordBatch.from_arrays([part.column(row_at), host, *arrays], names=["tree_row", "tree_host", *types])


def importance(parsed: DataFrame) -> DataFrame:
    """(tree_host, path, pages, importance) of every node of every host's style tree.

    Every sum has one row for each host, node and task before the shuffle, so
    a host with a third of all pages is no large group.
    """
    nodes = parsed.where("tree_host is not null").select("tree_host", F.explode("nodes").alias("n")).select("tree_host", "n.*")
    shown = nodes.groupBy("tree_host", "path", "style").agg(F.count("*").alias("c"), F.sum("children").alias("children"))
    looks = shown.groupBy("tree_host", "path").agg(
        F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("clogc"), F.sum("children").alias("children")
    )
    blocks = parsed.where("tree_host is not null").select("tree_host", F.explode("features").alias("f")).select("tree_host", "f.*")
    texts = (
        blocks.groupBy("tree_host", "path", "block")
        .agg(F.count("*").alias("c"))
        .groupBy("tree_host", "path")
        .agg(F.avg(F.log("c")).alias("logc"))
    )
    log_m = F.log("pages")
    look = F.when(F.col("pages") > 1, (log_m - F.col("clogc") / F.col("pages")) / log_m).otherwise(1.0)
    text = F.when(F.col("pages") > 1, 1 - F.coalesce("logc", F.lit(0.0)) / log_m).otherwise(1.0)
    weight = F.pow(F.lit(0.9), F.col("children") / F.col("pages"))
    return looks.join(texts, ["tree_host", "path"], "left").select(
        "tree_host", "path", "pages", ((1 - weight) * look + weight * text).alias("importance")
    )


# Nodes to remove up to which they are sent to every executor; some 16 bytes each.
BROADCAST_ROWS = 1_000_000


def extract_text(pages: DataFrame, *, min_importance: float = 0.3, min_pages: int = 5, out: str = "text") -> DataFrame:
    """The given columns but html, and the main text of each page. Hosts' nodes on fewer than ``min_pages`` pages stay."""
    kept = [c for c in pages.columns if c not in ("html", out)]
    rows = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("tree_row"),
        F.lower(F.regexp_extract("url", "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("tree_host"),
        F.col("html").alias("tree_html"),
    )
    schema = f"tree_row {rows.schema['tree_row'].dataType.simpleString()}, tree_host string, {PARSED}"
    parsed = stored(rows.mapInArrow(_parse_all, schema), "pages-parsed")
    low = stored(
        importance(parsed.where("tree_host != ''"))
        .where((F.col("importance") < min_importance) & (F.col("pages") >= min_pages))
        .select("tree_host", "path"),
        "pages-removed",
    )
    few = low.count() <= BROADCAST_ROWS
    removed = low.groupBy("tree_host").agg(F.collect_set("path").alias("removed"))
    joined = parsed.drop("nodes", "features").join(F.broadcast(removed) if few else removed, "tree_host", "left")
    left = joined.withColumn("left", F.expr("filter(blocks, b -> removed is null or not arrays_overlap(b.chain, removed))"))
    lost = "exists(blocks, b -> b.place <> 0) and not exists(left, b -> b.place <> 0)"  # nothing is left of the marked elements
    whole = "filter(blocks, b -> b.place <> 0 or removed is null or not arrays_overlap(b.chain, removed))"
    left = left.withColumn("left", F.expr(f"if({lost}, {whole}, left)"))
    text = F.expr(f"({CHOSEN}).text")
    return left.select(*(F.col(f"tree_row.`{c}`").alias(c) for c in kept), F.array_join(text, "\n").alias(out))
