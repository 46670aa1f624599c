"""Main text of web pages from flat text blocks, classified by a decision tree."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tags that end a text block.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html"
    " legend li main menu nav noframes ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements whose content is never text, read up to their end tag.
RAW_TAGS = ("script", "style", "noscript", "template", "textarea", "svg", "iframe", "title", "xmp")
#: Elements outside the article, and words in class, id or role that mark such an element.
CHROME_TAGS = frozenset("nav footer aside form header menu button select dialog head".split())
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner promo sponsor sponsored sidebar sidenav nav navbar navigation menu breadcrumb breadcrumbs footer masthead topbar toolbar comment comments"
    " reply replies disqus cookie cookies consent notice notices gdpr popup modal newsletter subscribe subscription signup login share sharing social related recommended widget pagination pager copyright legal"
    " search searchbox complementary contentinfo alert dialog".split()
)
MAIN_TAGS = frozenset(("article", "main"))
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)", re.S)
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
#: One attribute: its name and, where it has one, its value.
_NAMED = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_MAYBE_HIDDEN = re.compile(r"hidden|display", re.I)
_NO_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*none", re.I)
#: A word after one of these in a class tells of the layout around, such as has-sidebar.
_LAYOUT = re.compile(r"\b(?:has|with|no|without)[-_]+[a-z0-9]+")
#: A marked element that isn't chrome by its tag and holds this share of a page's words is a wrapper of the page.
WRAPPER_SHARE = 0.9
_SEPARATOR = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW_TAGS}

FEATURES = ("words", "link_density", "before_words", "before_link_density", "after_words", "after_link_density", "chrome", "main", "heading")
#: The labelled table, fixed values: the features in order, then 1 for main text. Blocks of news pages, blogs,
#: shops and forums as they look with and without structural tags.
LABELLED = (
    # inside an article: headings, quotes with links, lists of links
    (8, 0.0, 12, 0.0, 0, 0.0, 0, 1, 1, 1), (5, 0.0, 8, 0.0, 40, 0.0, 0, 1, 1, 1), (14, 0.3, 50, 0.0, 60, 0.1, 0, 1, 0, 1), (3, 1.0, 40, 0.0, 30, 0.0, 0, 1, 0, 1),
    (4, 0.5, 6, 0.5, 5, 0.4, 0, 1, 0, 1), (2, 0.0, 1, 1.0, 70, 0.0, 0, 1, 1, 1), (2, 1.0, 2, 1.0, 3, 1.0, 0, 1, 0, 0), (3, 1.0, 3, 1.0, 2, 1.0, 0, 1, 0, 0),
    # menus, headers, footers, sidebars, adverts, forms, comments, notices
    (1, 1.0, 1, 1.0, 1, 1.0, 1, 0, 0, 0), (8, 0.0, 1, 1.0, 8, 0.0, 1, 0, 0, 0), (12, 0.1, 60, 0.0, 0, 0.0, 1, 0, 0, 0), (45, 0.0, 5, 0.0, 40, 0.0, 1, 0, 0, 0),
    (20, 0.2, 30, 0.1, 25, 0.0, 1, 1, 0, 0), (3, 0.0, 2, 0.0, 2, 0.0, 1, 1, 1, 0), (5, 0.0, 0, 0.0, 1, 1.0, 1, 0, 1, 0), (120, 0.0, 60, 0.0, 50, 0.0, 1, 0, 0, 0),
    # pages without structural tags: length and links decide
    (55, 0.0, 8, 0.0, 70, 0.0, 0, 0, 0, 1), (70, 0.05, 55, 0.0, 40, 0.0, 0, 0, 0, 1), (24, 0.0, 60, 0.0, 50, 0.1, 0, 0, 0, 1), (18, 0.0, 70, 0.0, 45, 0.0, 0, 0, 0, 1),
    (6, 0.0, 60, 0.0, 55, 0.0, 0, 0, 0, 1), (12, 0.0, 45, 0.0, 62, 0.0, 0, 0, 0, 1), (90, 0.1, 2, 0.0, 80, 0.0, 0, 0, 0, 1), (40, 0.0, 50, 0.0, 4, 0.5, 0, 0, 0, 1),
    (9, 0.0, 3, 0.5, 60, 0.0, 0, 0, 1, 1), (7, 0.0, 2, 1.0, 45, 0.0, 0, 0, 1, 1), (150, 0.0, 9, 0.0, 3, 1.0, 0, 0, 0, 1), (33, 0.0, 0, 0.0, 0, 0.0, 0, 0, 0, 1),
    (2, 1.0, 1, 1.0, 2, 1.0, 0, 0, 0, 0), (3, 1.0, 2, 1.0, 60, 0.0, 0, 0, 0, 0), (4, 0.8, 3, 1.0, 3, 0.7, 0, 0, 0, 0), (3, 0.0, 2, 1.0, 2, 1.0, 0, 0, 0, 0),
    (5, 0.0, 4, 0.5, 3, 0.6, 0, 0, 0, 0), (6, 0.2, 1, 1.0, 2, 0.0, 0, 0, 0, 0), (12, 0.9, 10, 0.8, 11, 0.9, 0, 0, 0, 0), (20, 0.8, 15, 0.9, 2, 1.0, 0, 0, 0, 0),
    (9, 0.3, 50, 0.0, 3, 1.0, 0, 0, 0, 0), (7, 0.0, 4, 0.0, 3, 0.0, 0, 0, 0, 0), (4, 0.0, 6, 0.4, 0, 0.0, 0, 0, 0, 0), (2, 0.0, 3, 0.0, 2, 0.0, 0, 0, 1, 0),
    # paragraphs inside an article, and blocks outside it, may have any length beside blocks of any length
    *((words, 0.0, before, 0.0, after, 0.0, chrome, main, 0, 1 - chrome) for words in (1, 4, 9, 30, 120) for before in (1, 6, 50) for after in (1, 6, 50) for chrome, main in ((0, 1), (1, 0), (1, 1))),
)


def _hidden(attributes: str) -> bool:
    if not _MAYBE_HIDDEN.search(attributes):
        return False
    for name, value in _NAMED.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            return True
    return False


class _TagEnds:
    """Ends of tags of a page. A quote that leads to one that never closes is remembered, so a page is read once however many tags stay open."""

    def __init__(self, page: str):
        self.page, self.dead = page, set()
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.seen = (0, -1)  # nothing special lies between the two

    def special(self, at: int) -> int:
        """The next quote or end of a tag from ``at``; the page's length if there is none."""
        start, found = self.seen
        if not start <= at <= found:
            m = _SPECIAL.search(self.page, at)
            self.seen = start, found = at, m.start() if m else len(self.page)
        return found

    def end(self, at: int) -> int | None:
        """Where the attributes from ``at`` end, None if one of their quotes never closes."""
        quotes = []
        at = self.special(at)
        while at < len(self.page) and self.page[at] != ">":
            quotes.append(at)
            if at in self.dead or at == self.last[self.page[at]]:
                self.dead.update(quotes)
                return None
            at = self.special(self.page.index(self.page[at], at + 1) + 1)
        return at


def blocks_of(page: str | None) -> list[tuple[str, int, int, int, int, int]]:
    """Flat text blocks in page order: text, words, words in links, whether outside the article, inside one, a heading.

    A block ends at every tag that breaks a line. Comments, scripts, styles, titles, templates and hidden elements have no text; an end tag
    closes what is open inside its element; a tag or comment that never ends runs to the end of the page.

    A form, or an element marked by class, id or role only, is no chrome if it holds nearly all words of the page, and an article or main inside
    one stands by itself.
    """
    out: list[tuple[str, int, int, int, int, int]] = []
    stack: list[tuple[str, int, int, int, int, int, int]] = []  # tag, and its chrome by tag, main, heading, link, hidden, innermost marked element
    open_tags: Counter[str] = Counter()
    state = (0, 0, 0, 0, 0, 0)
    marked: list[int] = []  # per block the innermost marked element around it
    around, held = [0], [0]  # per marked element the one around it and its own words; 0 is the page
    texts: list[str] = []
    linked: list[str] = []
    mark = state

    def flush() -> None:
        words = " ".join(html.unescape("".join(texts)).split())
        if words:
            links = len(html.unescape("".join(linked)).split())
            n = words.count(" ") + 1
            out.append((words, n, min(links, n), mark[0], mark[1], mark[2]))
            marked.append(mark[5])
            if not mark[0]:
                held[mark[5]] += n
        texts.clear()
        linked.clear()

    def take(text: str) -> None:
        nonlocal mark
        if text and not state[4]:
            if not texts:
                if text.isspace():
                    return
                mark = state
            texts.append(text)
            if state[3]:
                linked.append(text + " ")

    def close() -> str:
        nonlocal state
        tag = stack.pop()[0]
        open_tags[tag] -= 1
        state = stack[-1][1:] if stack else (0, 0, 0, 0, 0, 0)
        return tag

    page = page or ""
    at = look = 0
    ends = _TagEnds(page)
    while (m := _TOKEN.search(page, look)) is not None:
        look = m.end()
        end = look if m[2] is None else ends.end(look)
        if end is None:
            continue
        take(page[at : m.start()])
        at = look = end if m[2] is None else min(end + 1, len(page))
        if m[2] is None:
            if m[0].startswith("<![CDATA["):
                take(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag, attributes = m[2].lower(), page[m.end() : end]
        if tag in BLOCK_TAGS:
            flush()
        if m[1]:
            if open_tags[tag]:
                while close() != tag:
                    pass
            continue
        if tag in _RAW_END:
            if not attributes.rstrip().endswith("/"):
                raw_end = _RAW_END[tag].search(page, at)
                at = look = raw_end.end() if raw_end else len(page)
            continue
        if tag in VOID_TAGS or attributes.rstrip().endswith("/"):
            continue
        if tag == "p" and stack and stack[-1][0] == "p" or tag == "li" and stack and stack[-1][0] == "li":
            close()
        names = {w for _, v in _ATTRIBUTE.findall(attributes) for w in _SEPARATOR.split(_LAYOUT.sub(" ", v.strip("\"'").lower()))} if "=" in attributes else ()
        heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6")
        chrome = tag in CHROME_TAGS and tag != "form" and not (tag == "header" and state[1])
        within = state[5]
        if tag in MAIN_TAGS:
            if not state[1] and CHROME_WORDS.isdisjoint(names):
                within = 0
        elif tag not in ("html", "body") and not chrome and (tag == "form" or not CHROME_WORDS.isdisjoint(names)):
            around.append(within)
            held.append(0)
            within = len(around) - 1
        state = (
            int(state[0] or chrome), int(state[1] or tag in MAIN_TAGS), int(state[2] or heading), int(state[3] or tag == "a"),
            int(state[4] or bool(attributes) and _hidden(attributes)), within,
        )
        stack.append((tag, *state))
        open_tags[tag] += 1
    take(page[at:])
    flush()
    least = WRAPPER_SHARE * sum(b[1] for b in out if not b[3])
    for k in range(len(held) - 1, 0, -1):
        held[around[k]] += held[k]
    outside = [False]  # whether an element or one around it is marked and no wrapper of the page
    for k in range(1, len(held)):
        outside.append(outside[around[k]] or held[k] < least)
    return [(*b[:3], int(b[3] or outside[k]), *b[4:]) for b, k in zip(out, marked)]


_BLOCK = pa.struct([("text", pa.string()), ("words", pa.int32()), ("links", pa.int32()), ("chrome", pa.int32()), ("main", pa.int32()), ("heading", pa.int32())])
_BLOCK_SQL = "array<struct<text:string,words:int,links:int,chrome:int,main:int,heading:int>>"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in _BLOCK]
    for batch in batches:
        found = [[dict(zip(names, b)) for b in blocks_of(page)] for page in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.list_(_BLOCK))], ["page_id", "url", "blocks"])


def fit_tree(spark: SparkSession, depth: int = 6):
    """A decision tree fitted to the labelled table (some two hundred rows)."""
    rows = spark.createDataFrame([tuple(map(float, r)) for r in LABELLED], [*FEATURES, "label"])
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).coalesce(1)
    return DecisionTreeClassifier(maxDepth=depth, minInstancesPerNode=1, seed=7).fit(rows)


def _node(node, values: dict[str, Column]) -> Column:
    """The subtree as one SQL expression."""
    if node.getClass().getSimpleName() == "LeafNode":
        return F.lit(node.prediction() > 0.5)
    split = node.split()
    return F.when(values[FEATURES[split.featureIndex()]] <= split.threshold(), _node(node.leftChild(), values)).otherwise(_node(node.rightChild(), values))


def extract(pages: DataFrame) -> DataFrame:
    """The main text of pages.

    Takes ``page_id``, ``url``, ``html``; returns per row ``page_id``, ``url``, ``text``, ``n_chars`` (code points), ``n_blocks``
    and ``n_main`` (blocks that are main text). A page becomes flat text blocks; each has its words, its link density,
    those of the block before and after, whether it stands in a menu, footer, advert, form or comment, in an
    article, or is a heading. A decision tree fitted to ``LABELLED`` keeps or drops each; kept blocks are joined
    by a line break. The tree runs as an SQL expression on the array of blocks, so no row is shuffled.

    Null, empty and text-free pages give an empty text. Repeated rows come back as often; extra columns are ignored.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), "html")
    kind = dict(rows.dtypes)["page_id"]
    rows = rows.mapInArrow(_blocks, f"page_id {kind}, url string, blocks {_BLOCK_SQL}")
    root = fit_tree(pages.sparkSession)._java_obj.rootNode()

    def density(b: Column) -> Column:
        return F.coalesce(b["links"] / b["words"], F.lit(0.0))

    def kept(b: Column, k: Column) -> Column:
        before, after = F.get("blocks", k - 1), F.get("blocks", k + 1)
        return _node(root, {
            "words": b["words"], "link_density": density(b), "before_words": F.coalesce(before["words"], F.lit(0)), "before_link_density": density(before),
            "after_words": F.coalesce(after["words"], F.lit(0)), "after_link_density": density(after), "chrome": b["chrome"], "main": b["main"], "heading": b["heading"],
        })

    rows = rows.withColumn("main", F.filter("blocks", kept))
    text = F.array_join(F.transform("main", lambda b: b["text"]), "\n")
    return rows.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"), F.size("blocks").alias("n_blocks"), F.size("main").alias("n_main"))
