"""Main text of web pages: boosted trees over block features, decoded down the tree.

A page becomes a tree of block elements; inline elements belong to their block. Each block has
features: subtree density (text, links, tags, blocks), attribute tokens, depth, place among
its siblings. Trees give a block's log-odds of holding main text, and the decoder picks the
set of kept blocks with the largest sum in which a block is kept only if all its ancestors
are: a dropped block takes its subtree along, so no choice contradicts another.

Pages carry no labels. The trees learn from a bounded, hash-chosen sample of pages whose own
markup tells the article apart (``article`` or ``main`` against the rest), each taken twice
more with other wrappings: the same blocks under neutral tags and class names drawn from the
vocabulary below, with comments, notices, forms and side columns made of other blocks' words.
A page that names no article lends its paragraph runs to such wrappings; of its own layout
only the runs and what is named like boilerplate are learned from. If no sampled page has
either, the density rule that finds those runs (``dense``) takes the trees' place.
The last share of sampled pages is not learned from and measures the fit (``agreement``).

A form is left out with all it holds, unless it holds most of the page's paragraphs and no
article stands outside: such a form wraps the page, and only its controls are left out.

Cases: a null or empty page, or one without main text, has the text ''; repeated rows are
extracted alike; null urls and ids stay; unclosed and stray tags, unclosed comments and
unknown entities are read as browsers do, roughly; a page of any length is read whole; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm import boosting
from panelcast.llm.tables import Written

# Expected number of pages that the fit reads at most.
TRAIN_PAGES = 1_500
TEST_SHARE = 0.2
# A paragraph has so many words, a sentence's end, and at most this share of its text in links.
DENSE_WORDS = 8
DENSE_LINKS = 1 / 3
# A page that names no article is learned from if a run of neighbours has so many paragraphs.
RUN_LENGTH = 3
# Pages are scored together up to so many blocks, to bound memory.
GROUP_BLOCKS = 8_000

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*)>""", re.S)
ATTRIBUTE = re.compile(r"""(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
NAME = re.compile(r"[a-z]+")
WORD = re.compile(r"\w+")

# Element names of HTML and what they are to a page.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg math object title select button canvas".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var".split())
BREAKS = frozenset("br hr img".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split())
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table tr td th div article section main body aside nav header footer form".split())
ALWAYS_OUT = frozenset("head form nav script style".split())
LANDMARKS_OUT = frozenset("aside footer header nav".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td dd dt figcaption".split())
GOOD_NAMES = frozenset(
    "article content main post story entry body text page maincontent blog prose copy articlebody paragraph".split())
BAD_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs byline combx comment comments consent cookie "
    "cookies copyright disqus feedback foot footer form gdpr header login masthead menu meta nav navbar navigation "
    "newsletter notice outbrain pager pagination popup privacy promo promoted recommend recommended related replies "
    "reply reader readers response responses search share sharing shoutbox sidebar side signup skyscraper social "
    "sponsor sponsored subscribe subscription tags teaser toolbar top widget widgets warning alert disclaimer discussion".split())

KINDS = ["p", "heading", "list", "item", "div", "section", "article", "main", "header", "footer", "aside", "table", "quote"]
KIND_OF = {"p": "p", "ul": "list", "ol": "list", "dl": "list", "li": "item", "dd": "item", "dt": "item", "div": "div",
           "section": "section", "article": "article", "main": "main", "header": "header", "footer": "footer",
           "aside": "aside", "table": "table", "td": "table", "tr": "table", "blockquote": "quote", "pre": "quote"} | {
    f"h{k}": "heading" for k in range(1, 7)}
FEATURES = [f"is_{k}" for k in KINDS] + [
    "depth", "sibling", "siblings", "same_before", "same_after", "children", "text_children",
    "good_own", "bad_own", "good_above", "bad_above", "landmark_above",
    "own_chars", "chars", "share", "start", "link_share", "words_per_block", "blocks", "tags_per_char",
    "stop_marks", "digits", "capitals", "before_chars", "after_chars", "bad_below", "copyright",
]


class Block:
    """A block element: its place in the tree and the text that stands directly in it."""

    __slots__ = ("tag", "parent", "children", "names", "runs", "links", "tags", "out", "source")

    def __init__(self, tag: str, parent: Block | None, names: list[str] = (), out: bool = False):
        self.tag, self.parent, self.names, self.out = tag, parent, list(names), out
        self.children: list[Block] = []
        # Runs of text between child blocks: (number of children before it, text).
        self.runs: list[list] = []
        self.links = self.tags = 0
        self.source: bool | None = None
        if parent is not None:
            parent.children.append(self)

    def add(self, text: str, link: bool) -> None:
        if self.runs and self.runs[-1][0] == len(self.children):
            self.runs[-1][1].append(text)
        else:
            self.runs.append([len(self.children), [text]])
        if link:
            self.links += len(text.strip())


def parse(page: str) -> Block:
    """Tree of the page's block elements under a root."""
    root = Block("root", None)
    at, link, place, end = root, 0, 0, len(page)
    while place < end:
        found = TAG.search(page, place)
        stop = found.start() if found else end
        if stop > place:
            at.add(html.unescape(page[place:stop]), link > 0)
        if not found:
            break
        place = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if name == "a":
                link = max(link - 1, 0)
            elif name not in INLINE and name not in VOID:
                up = at
                while up is not root and up.tag != name:
                    up = up.parent
                if up is not root:
                    at, link = up.parent, 0
            continue
        at.tags += 1
        if name in RAW:
            closing = re.compile(f"</{name}\\s*>", re.I).search(page, place)
            place = closing.end() if closing else end
            at.add(" ", False)
            continue
        if name in INLINE:
            link += name == "a" and not found[3].endswith("/")
            continue
        if name in VOID:
            if name in BREAKS:
                at.add(" ", False)
            continue
        link = 0
        if at.tag == "head":  # what follows an unclosed head is not part of it
            at = at.parent
        if name in CLOSES_P:
            up = at
            while up is not root and up.tag != "p" and up.tag not in SCOPES:
                up = up.parent
            if up.tag == "p":
                at = up.parent
        if name in SELF_CLOSING:
            up = at
            while up is not root and up.tag not in SELF_CLOSING[name] and up.tag not in SCOPES - SELF_CLOSING[name]:
                up = up.parent
            if up.tag in SELF_CLOSING[name]:
                at = up.parent
        names = [n for value in ATTRIBUTE.findall(found[3]) for n in NAME.findall(split_camel(value))]
        at = Block(name, at, names, at.out or name in ALWAYS_OUT)
    open_forms(root)
    return root


def open_forms(root: Block) -> None:
    """Take back ``out`` from a form that wraps the page: see the module's first lines."""
    blocks = in_order(root)
    forms = [b for b in blocks if b.tag == "form" and not b.parent.out]
    if not forms:
        return
    chars = {id(b): sum(len(t) for _, t in texts_of(b)) for b in blocks if is_paragraph(b)}
    total = sum(chars.values())
    for form in forms:
        inside = in_order(form)
        held = {id(b) for b in inside}
        named = any(b.tag in ("article", "main") and id(b) not in held and any(texts_of(x) for x in in_order(b)) for b in blocks)
        if named or 2 * sum(chars.get(i, 0) for i in held) <= total:
            continue
        form.out = False
        for b in inside[1:]:
            b.out = b.parent.out or b.tag in ALWAYS_OUT


def split_camel(value: str) -> str:
    return re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()


def in_order(root: Block) -> list[Block]:
    """Blocks from the root down, parents before children, in page order."""
    found, todo = [], [root]
    while todo:
        block = todo.pop()
        found.append(block)
        todo.extend(reversed(block.children))
    return found


def flat(text: str) -> str:
    return " ".join(text.split())


def texts_of(block: Block) -> list[tuple[int, str]]:
    """(children before it, text) of the runs of text that are not blank."""
    joined = ((k, flat("".join(parts))) for k, parts in block.runs)
    return [(k, t) for k, t in joined if t]


def is_paragraph(block: Block) -> bool:
    """Running text: enough words, the end of a sentence, few links."""
    text = " ".join(t for _, t in texts_of(block))
    return text.count(" ") + 1 >= DENSE_WORDS and any(c in text for c in ".?!") and block.links <= DENSE_LINKS * len(text)


def side_blocks(blocks: list[Block]) -> set[int]:
    """Ids of side elements, of what is named like boilerplate, and of all within."""
    side: set[int] = set()
    for b in blocks:
        if b.out or b.tag in LANDMARKS_OUT or any(n in BAD_NAMES for n in b.names) or (b.parent is not None and id(b.parent) in side):
            side.add(id(b))
    return side


def dense(blocks: list[Block]) -> list[bool]:
    """Blocks of main text by a rule: paragraphs, and headings right before one, not at the side."""
    side = side_blocks(blocks)
    found = [id(b) not in side and is_paragraph(b) for b in blocks]
    paragraphs = {id(b) for b, f in zip(blocks, found) if f}
    for b in reversed(blocks):
        for heading, after in zip(b.children[-2::-1], b.children[:0:-1]):
            if KIND_OF.get(heading.tag) == "heading" and id(heading) not in side and id(after) in paragraphs and texts_of(heading):
                paragraphs.add(id(heading))
    return [id(b) in paragraphs for b in blocks]


def rule_odds(blocks: list[Block]) -> np.ndarray:
    """Log-odds of the blocks by ``dense`` alone; a block without text follows those below it."""
    return np.array([1.0 if d else -1.0 if texts_of(b) else -0.01 for b, d in zip(blocks, dense(blocks))])


def measure(blocks: list[Block]) -> np.ndarray:
    """Features of the blocks of one page, in the order of ``in_order``."""
    n = len(blocks)
    place = {id(b): i for i, b in enumerate(blocks)}
    parent = [place[id(b.parent)] if b.parent is not None else -1 for b in blocks]
    own = [" ".join(t for _, t in texts_of(b)) for b in blocks]
    own_chars = np.array([len(t) for t in own], dtype=float)
    start = np.concatenate([[0.0], np.cumsum(own_chars)[:-1]])
    below = {k: np.zeros(n) for k in ("chars", "links", "blocks", "tags", "words", "marks", "digits", "capitals", "bad")}
    below["chars"] += own_chars
    for i, (b, t) in enumerate(zip(blocks, own)):
        below["links"][i] = b.links
        below["blocks"][i] = bool(t)
        below["tags"][i] = b.tags
        below["bad"][i] = any(x in BAD_NAMES for x in b.names)
        if t:
            below["words"][i] = t.count(" ") + 1
            below["marks"][i] = t.count(".") + t.count("?") + t.count("!")
            below["digits"][i] = sum(map(str.isdigit, t))
            below["capitals"][i] = sum(map(str.isupper, t))
    for i in range(n - 1, 0, -1):
        for sums in below.values():
            sums[parent[i]] += sums[i]
    depth, good_above, bad_above, landmark = [0.0] * n, [0.0] * n, [0.0] * n, [0.0] * n
    rows = np.zeros((n, len(FEATURES)))
    total = max(below["chars"][0], 1.0)
    for i, b in enumerate(blocks):
        good = float(sum(x in GOOD_NAMES for x in b.names))
        bad = float(sum(x in BAD_NAMES for x in b.names))
        p = parent[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            above = rows[p]
            good_above[i] = good_above[p] + above[GOOD_AT]
            bad_above[i] = bad_above[p] + above[BAD_AT]
            landmark[i] = 1.0 if blocks[p].tag in ("article", "main") else -1.0 if blocks[p].tag in (
                "aside", "footer", "header", "nav") else landmark[p]
            around = b.parent.children
        else:
            around = [b]
        chars, words, blocks_below = below["chars"][i], below["words"][i], below["blocks"][i]
        kind = KIND_OF.get(b.tag)
        if kind:
            rows[i, KINDS.index(kind)] = 1.0
        rows[i, len(KINDS):] = [
            depth[i], 0.0, float(len(around)), 0.0, 0.0,
            float(len(b.children)), float(sum(c.tag in TEXT_TAGS for c in b.children)),
            good, bad, good_above[i], bad_above[i], landmark[i],
            math.log1p(own_chars[i]), math.log1p(chars), chars / total, start[i] / total, below["links"][i] / max(chars, 1.0),
            words / max(blocks_below, 1.0), math.log1p(blocks_below), below["tags"][i] / max(chars, 1.0),
            below["marks"][i] / max(words, 1.0), below["digits"][i] / max(chars, 1.0),
            below["capitals"][i] / max(chars, 1.0), 0.0, 0.0, below["bad"][i],
            float("©" in own[i] or "all rights reserved" in own[i].lower()),
        ]
    for b in blocks:  # sibling statistics
        kids = [place[id(c)] for c in b.children]
        for k, i in enumerate(kids):
            rows[i, SIBLING_AT] = k
            if k:
                rows[i, SAME_AT] = blocks[kids[k - 1]].tag == blocks[i].tag
                rows[i, AROUND_AT] = math.log1p(below["chars"][kids[k - 1]])
            if k + 1 < len(kids):
                rows[i, SAME_AT + 1] = blocks[kids[k + 1]].tag == blocks[i].tag
                rows[i, AROUND_AT + 1] = math.log1p(below["chars"][kids[k + 1]])
    return rows


GOOD_AT, BAD_AT = FEATURES.index("good_own"), FEATURES.index("bad_own")
SIBLING_AT, SAME_AT, AROUND_AT = (FEATURES.index(f) for f in ("sibling", "same_before", "before_chars"))


def decode(blocks: list[Block], odds: np.ndarray) -> list[bool]:
    """Kept blocks: the choice of largest summed log-odds in which ancestors of kept ones are kept."""
    n = len(blocks)
    place = {id(b): i for i, b in enumerate(blocks)}
    gain = np.array(odds, dtype=float)
    for i in range(n - 1, -1, -1):
        if blocks[i].out:
            gain[i] = 0.0
        if i:
            gain[place[id(blocks[i].parent)]] += max(gain[i], 0.0)
    keep = [True] + [False] * (n - 1)  # the root is no element of the page
    for i in range(1, n):
        keep[i] = keep[place[id(blocks[i].parent)]] and gain[i] > 0 and not blocks[i].out
    return keep


def text_of(root: Block, kept: set[int]) -> str:
    """Texts of the kept blocks in page order, joined by one space."""
    found: list[str] = []
    todo: list = [root]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            found.append(item)
        elif id(item) in kept:
            parts: list = []
            runs = texts_of(item)
            k = 0
            for at, text in runs:
                parts += [*item.children[k:at], text]
                k = at
            todo.extend(reversed(parts + item.children[k:]))
    return " ".join(found)


# --- training pages ----------------------------------------------------------------------


def mark(root: Block) -> bool:
    """Set ``source`` of every block by the page's own markup; False if it has no article."""
    blocks = in_order(root)
    core = [b for b in blocks if b.tag in ("article", "main")]
    inside: set[int] = set()
    for b in core:
        inside.update(id(x) for x in in_order(b) if not x.out and x.tag not in ("nav", "aside", "footer", "header"))
    for b in reversed(blocks):
        b.source = id(b) in inside and (bool(texts_of(b)) or any(c.source for c in b.children)) or any(
            c.source for c in b.children)
    return any(b.source for b in blocks)


def mark_run(root: Block) -> bool:
    """Set ``source`` of a page that names no article: runs of paragraphs against side blocks, the
    rest unknown; False if it has no run."""
    blocks = in_order(root)
    side = side_blocks(blocks)
    found = {id(b) for b, d in zip(blocks, dense(blocks)) if d}
    runs = {id(c) for b in blocks for c in b.children
            if id(c) in found and sum(id(x) in found for x in b.children) >= RUN_LENGTH}
    for b in reversed(blocks):
        known = id(b) in runs or any(c.source for c in b.children)
        b.source = True if known else False if id(b) in side else None
    return bool(runs)


def rewrapped(root: Block, draw: random.Random) -> Block:
    """The page's article blocks in another wrapping, among boilerplate made of its words."""
    article = [b for b in in_order(root) if b.source and texts_of(b)]
    words = [w for b in article for _, t in texts_of(b) for w in t.split()] or ["text"]

    def some(low: int, high: int) -> str:
        k = draw.randrange(max(1, len(words) - high))
        return " ".join(words[k:k + draw.randint(low, high)])

    def junk(parent: Block, tag: str, names: list[str], blocks: int, low: int, high: int, links: float) -> None:
        box = Block(tag, parent, names)
        box.source = False
        for _ in range(blocks):
            inner = Block(draw.choice(["p", "div", "li", "p"]), box, draw.choice([[], [], names[:1]]))
            inner.source = False
            if draw.random() < 0.25:
                inner = Block("p", inner)
                inner.source = False
            inner.add(some(low, high), draw.random() < links)
            inner.tags += 1

    bad = sorted(BAD_NAMES)
    new = Block("root", None)
    body = Block("body", Block("html", new))
    page = Block("div", body, draw.choice([["wrapper"], ["page"], [], ["container"]])) if draw.random() < 0.6 else body

    def some_junk(parent: Block, comments: bool) -> None:
        for _ in range(draw.randint(0, 3)):
            tag = draw.choice(["div", "div", "section", "aside", "footer", "header", "ul"])
            names = draw.sample(bad, draw.randint(1, 2)) if tag in ("div", "section", "ul") or draw.random() < 0.5 else []
            style = draw.random()
            if comments and style < 0.5:
                junk(parent, draw.choice(["div", "section", "ul", "ol"]), [draw.choice(["comments", "comment", "replies",
                     "responses", "discussion", "reader"])], draw.randint(1, 8), 5, 60, 0.05)
            elif style < 0.75:
                junk(parent, tag, names, draw.randint(1, 6), 1, 6, 0.8)
            else:
                junk(parent, tag, names, draw.randint(1, 3), 4, 30, 0.15)

    some_junk(page, False)
    for _ in range(draw.randint(0, 2)):
        page = Block(draw.choice(["div", "div", "section", "main"]), page, draw.choice([[], ["content"], ["main"], ["row"], ["col"]]))
    some_junk(page, False)
    tag = draw.choice(["article", "div", "div", "section", "main", "td"])
    names = draw.choice([["article"], ["post"], ["content"], ["entry", "content"], ["story"], ["text"], [], []])
    box = Block(tag, page, names if tag in ("div", "section", "td") else draw.choice([[], names]))
    for k, b in enumerate(article):
        copy = Block(draw.choice(["p", "div", "blockquote", "li"]) if draw.random() < 0.15 and b.tag == "p" else b.tag
                     if b.tag in TEXT_TAGS else "p", box)
        copy.runs, copy.links, copy.tags, copy.source = [[0, [t]] for _, t in texts_of(b)][:1], b.links, b.tags, True
        if k and draw.random() < 0.06:
            junk(box, draw.choice(["div", "aside", "div"]), draw.sample(bad, 1), draw.randint(1, 3), 2, 25, 0.4)
    if draw.random() < 0.5:
        some_junk(box, True)
    some_junk(page, True)
    some_junk(body, True)
    for b in reversed(in_order(new)):
        b.source = bool(b.source) or any(c.source for c in b.children)
    return new


def examples(page: str, seed: int) -> list[Block]:
    """Trees with known blocks: the page as it is and two other wrappings; none without main text."""
    root = parse(page)
    if not mark(root) and not mark_run(root):
        return []
    draw = random.Random(seed)
    return [root, rewrapped(root, draw), rewrapped(root, draw)]


def training_blocks(pages: DataFrame, text: str, train_pages: int) -> Written:
    """(label, test, features) of the blocks of the sampled pages."""
    rows = pages.select(F.col(f"`{text}`").alias("html")).where("html is not null and html <> ''")
    total = rows.count()
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    sample = rows.where(place < (min(1.0, train_pages / total) if total else 1.0))

    def run(batches):
        for batch in batches:
            for page in batch.column(0):
                seed = zlib.crc32(page.as_py().encode("utf-8", "replace"))
                for root in examples(page.as_py(), seed):
                    blocks = in_order(root)
                    use = [i for i, b in enumerate(blocks) if i and not b.out and b.source is not None]
                    x = measure(blocks)[use]
                    label = [float(bool(blocks[i].source)) for i in use]
                    test = [seed % 1000 < 1000 * TEST_SHARE] * len(use)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(label), pa.array(test), *[pa.array(c) for c in x.T]], names=["label", "test", *FEATURES])

    fields = ", ".join(f"{f} double" for f in FEATURES)
    found = sample.mapInArrow(run, f"label double, test boolean, {fields}")
    return Written(found.repartition(8), "page_blocks")


def fit(pages: DataFrame, text: str = "html", train_pages: int = TRAIN_PAGES) -> list[dict]:
    table = training_blocks(pages, text, train_pages)
    trees = boosting.fit(table.df.where("not test"), FEATURES, "label")
    table.drop()
    return trees


def agreement(pages: DataFrame, trees: list[dict], text: str = "html", train_pages: int = TRAIN_PAGES) -> float:
    """Share of the unlearned sampled blocks that the trees put on the right side."""
    rows = training_blocks(pages, text, train_pages).df.where("test").toPandas()
    return float(((boosting.margin(trees, rows[FEATURES].to_numpy()) > 0) == (rows["label"] > 0)).mean())


def extract(pages: DataFrame, trees: list[dict], page_id: str = "page_id", url: str = "url", text: str = "html") -> DataFrame:
    """(page_id, url, text) of every row of ``pages``; without trees, by the density rule."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def group(roots: list[list[Block]]) -> list[str]:
        if shared.value:
            odds = 2 * boosting.margin(shared.value, np.concatenate([measure(blocks) for blocks in roots]))
        else:
            odds = np.concatenate([rule_odds(blocks) for blocks in roots])
        out, at = [], 0
        for blocks in roots:
            keep = decode(blocks, odds[at:at + len(blocks)])
            at += len(blocks)
            out.append(text_of(blocks[0], {id(b) for b, k in zip(blocks, keep) if k}))
        return out

    def run(batches):
        for batch in batches:
            texts, waiting, size = [], [], 0
            for value in batch.column(2):
                waiting.append(in_order(parse(value.as_py() or "")))
                size += len(waiting[-1])
                if size > GROUP_BLOCKS:
                    texts += group(waiting)
                    waiting, size = [], 0
            if waiting:
                texts += group(waiting)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                                             names=["page_id", "url", "text"])

    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{text}`").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string")
