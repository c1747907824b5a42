"""HTML extraction: boosted trees over DOM nodes, decoded down the tree.

Each block-level node of a page gets features: its tag, tokens of class, id and
role, depth, text and link density of its subtree, and how it compares with its
siblings and the page. Gradient-boosted trees give the odds that its text is main
text. Decoding then picks the likeliest labels of all nodes under one rule: below
a dropped node everything is dropped. So no node is kept inside a dropped one.

The trees are fitted on at most ``TRAINING_PAGES`` pages that mark their article,
in the order of a hash of the url and html. Pages like these seldom show every
kind of surrounding, so each also appears in variants whose article is wrapped
otherwise and which carry notices, sidebars, forms, comments and the like, filled
with text of other pages. All pages are then extracted whole, row by row.

Defined cases: null or empty html gives an empty text; broken markup is read as
far as it goes (open elements end where an outer one ends), in time that grows with
its length; without a page to learn from, tags and attribute tokens alone decide;
repeated rows are extracted each; an empty table gives an empty result. A line break
inside a block is white space like any other. Other columns are not read.
"""

from __future__ import annotations

import html
import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import staged

TRAINING_PAGES, VARIANTS = 240, 4
TREES, DEPTH, STEP = 24, 4, 0.25

PLAIN = re.compile(r"""<(/?)([a-zA-Z][^\s/>"'<]*+)(?=[\s/>])([^>"'<]*+(?:"[^"<>]*+"[^>"'<]*+|'[^'<>]*+'[^>"'<]*+)*+)>""")
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
SPECIAL = re.compile("""[>"']""")
LONG_NUMBER = re.compile(r"&#[0-9]{8,};?")
ATTRIBUTE = re.compile(r"""(class|id|role|data-gold)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

INLINE = set("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub "
             "sup time tt u var acronym".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style template noscript title svg math iframe object canvas audio video textarea".split())
RAW = set("script style textarea title iframe noscript".split())
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}
CLOSE_LIKE = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
              "option": {"option"}}
SCOPES = set("ul ol dl table tbody thead tfoot select html body article section div main".split())
GROUPS = [{"nav", "menu"}, {"header"}, {"footer"}, {"aside"}, {"form", "button", "select", "option", "fieldset", "dialog"},
          {"article", "main"}, {"section", "div", "center"}, {"p", "blockquote", "pre"}, {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"},
          {"ul", "ol", "li", "dl", "dt", "dd"}, {"table", "tbody", "thead", "tr", "td", "th", "caption"}, {"html", "body"}]
GROUP_OF = {tag: k for k, tags in enumerate(GROUPS) for tag in tags}
AROUND, CENTRE = {"nav", "menu", "header", "footer", "aside", "form", "dialog"}, {"article", "main"}
AVOID = set("ad ads advert advertisement adverts sponsor sponsored promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs header "
            "masthead footer foot sidebar side aside widget related recommended comment comments reply replies discussion disqus respond "
            "cookie cookies consent notice notices alert warning gdpr popup modal overlay form login signup signin register subscribe "
            "newsletter search share sharing social toolbar pager pagination skip complementary contentinfo dialog legal copyright".split())
SEEK = set("article content main body post entry story text hentry prose page blog news".split())
N_FEATURES = 20 + len(GROUPS)


class Tags:
    """Tags, comments and declarations of a page, found in time that grows with its length however broken it is.

    A tag ends at the first ``>`` outside quotes or, where a quote is never closed, at the
    first ``>``. Quotes that led to no end are remembered, so no later tag follows them again.
    """

    __slots__ = ("source", "last", "dead")

    def __init__(self, source: str):
        self.source, self.last, self.dead = source, source.rfind(">"), set()

    def after(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start, end, slash, name (empty: not a tag) and attributes of the next one from ``at`` on."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            if start > self.last:  # nothing ends any more; a comment takes all that is left
                start = source.find("<!--", start)
                return None if start < 0 else (start, len(source), "", "", "")
            if m := PLAIN.match(source, start):
                return start, m.end(), m[1], m[2], m[3]
            if source.startswith("<!--", start):
                end = source.find("-->", start + 2)
                return start, len(source) if end < 0 else end + 3, "", "", ""
            if source[start + 1] in "!?":
                return start, source.find(">", start) + 1, "", "", ""
            if m := NAME.match(source, start):
                end = self._end(m.end())
                return start, end + 1, m[1], m[2], source[m.end():end]
            at = start + 1
        return None

    def _end(self, at: int) -> int:
        source, quotes, place = self.source, [], at
        while m := SPECIAL.search(source, place):
            if m[0] == ">":
                return m.start()
            if m.start() in self.dead:
                break
            quotes.append(m.start())
            place = source.find(m[0], m.end()) + 1
            if not place:
                break
        self.dead.update(quotes)
        return source.find(">", at)

    def raw_end(self, name: str, at: int) -> int:
        """Where the content of a raw element and its end tag are over."""
        m = RAW_END[name].search(self.source, at)
        return self.source.find(">", m.end()) + 1 if m and m.end() <= self.last else len(self.source)


def decoded(text: str) -> str:
    """``text`` without character references; numbers beyond all characters give the replacement character."""
    return html.unescape(LONG_NUMBER.sub(_in_range, text) if "&#" in text else text)


def _in_range(m: re.Match) -> str:
    digits = m[0][2:].rstrip(";").lstrip("0")
    return f"&#{digits or 0};" if len(digits) < 8 else "\ufffd"


class Page:
    """Block-level nodes of a page in document order, and its runs of text.

    ``runs`` holds [node, text, characters inside links]; a run ends where a block
    starts or ends, and ``node`` is the block it lies in.
    """

    __slots__ = ("parent", "tag", "tokens", "gold", "runs")

    def __init__(self, source: str):
        self.parent, self.tag, self.tokens, self.gold, self.runs = [-1], ["html"], [()], [None], []
        # Open elements; for each name the levels it is open at: the number of open blocks
        # for inline names, of open scopes for blocks. So no search passes what stays open.
        stack: list[tuple[str, int | None]] = []
        levels: dict[str, list[int]] = {}
        blocks, scopes = [0], 0
        node, links, at, fresh = 0, 0, 0, True
        hidden: str | None = None
        depth = 0

        def add(text):
            nonlocal fresh
            if not text or hidden:
                return
            if fresh or not self.runs:
                self.runs.append([node, [], 0])
                fresh = False
            self.runs[-1][1].append(decoded(text) if "&" in text else text)
            if links:
                self.runs[-1][2] += len(text)

        def leave():
            nonlocal links, scopes
            name, block = stack.pop()
            levels[name].pop()
            if block is None:
                links -= name == "a"
            else:
                blocks.pop()
                scopes -= name in SCOPES
            return name

        def is_open(name, level=None):
            found = levels.get(name)
            return bool(found) and (level is None or found[-1] == level)

        tags = Tags(source)
        while tag := tags.after(at):
            start, end, closing, name, rest = tag
            if start > at:
                add(source[at:start])
            at = end
            if not name:
                continue
            name = name.lower()
            if name in RAW and not closing:
                if not rest.endswith("/"):  # nothing but its own end tag counts
                    at = tags.raw_end(name, at)
                continue
            if hidden:
                if name == hidden:
                    depth += -1 if closing else (0 if rest.endswith("/") else 1)
                    if depth == 0:
                        hidden = None
                continue
            if closing:
                if name in INLINE:
                    if is_open(name, len(blocks)):
                        while leave() != name:
                            pass
                elif is_open(name):
                    while leave() != name:
                        pass
                    node, fresh = blocks[-1], True
                continue
            if name in VOID:
                add(" ")
                if name == "hr":
                    fresh = True
                continue
            if name in HIDDEN:
                if not rest.endswith("/"):
                    hidden, depth = name, 1
                continue
            if name in INLINE:
                stack.append((name, None))
                levels.setdefault(name, []).append(len(blocks))
                links += name == "a"
                continue
            if name in ("html", "head", "body"):  # what a head may hold is hidden or void, so its end need not be found
                continue
            likes = CLOSE_LIKE.get(name, ())  # a block ends an open paragraph; an item ends the items before
            if likes:
                while any(is_open(x, scopes) for x in ("p", *likes)):
                    leave()
            elif is_open("p", scopes):
                while leave() != "p":
                    pass
            above = blocks[-1]
            found = {key.lower(): value.strip("\"'") for key, value in ATTRIBUTE.findall(rest)} if "=" in rest else {}
            self.parent.append(above)
            self.tag.append(name)
            gold = found.pop("data-gold", None)
            self.gold.append(self.gold[above] if gold is None else gold == "1")
            self.tokens.append(tuple(x.lower() for value in found.values() for x in PART.findall(value)))
            node, fresh = len(self.tag) - 1, True
            if rest.endswith("/"):
                node = above
            else:
                stack.append((name, node))
                blocks.append(node)
                scopes += name in SCOPES
                levels.setdefault(name, []).append(scopes)
        add(source[at:])
        for run in self.runs:
            run[1] = " ".join("".join(run[1]).split())

    def features(self) -> list[list[float]]:
        """One row for each node."""
        n, parent = len(self.tag), self.parent
        chars, link, marks, segments, own, tags, paragraphs = ([0.0] * n for _ in range(7))
        for node, text, linked in self.runs:
            size = len(text)
            own[node] += size
            chars[node] += size
            link[node] += min(size, linked)
            marks[node] += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            segments[node] += size > 0
        children: list[list[int]] = [[] for _ in range(n)]
        for k in range(n - 1, 0, -1):
            up = parent[k]
            for total in (chars, link, marks, segments):
                total[up] += total[k]
            tags[up] += tags[k] + 1
            paragraphs[up] += paragraphs[k] + (self.tag[k] == "p")
            children[up].append(k)
        rows, depth, avoid_above, seek_above, around, centre = [], [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
        place, count = [0] * n, [1] * n
        beside = [(0.0, 0.0)] * n
        for own_children in children:
            own_children.reverse()
            for i, k in enumerate(own_children):
                place[k], count[k] = i, len(own_children)
                before, after = own_children[i - 1] if i else k, own_children[i + 1] if i + 1 < len(own_children) else k
                beside[k] = (link[before] / (chars[before] + 1), link[after] / (chars[after] + 1))
        page = chars[0] + 1
        for k in range(n):
            up = parent[k]
            avoid, seek = sum(t in AVOID for t in self.tokens[k]), sum(t in SEEK for t in self.tokens[k])
            if k:
                depth[k] = depth[up] + 1
                avoid_above[k], seek_above[k] = avoid_above[up] + avoid, seek_above[up] + seek
                around[k], centre[k] = around[up] + (self.tag[k] in AROUND), centre[up] + (self.tag[k] in CENTRE)
            size = chars[k]
            group = [0.0] * len(GROUPS)
            if self.tag[k] in GROUP_OF:
                group[GROUP_OF[self.tag[k]]] = 1.0
            rows.append([
                depth[k], math.log1p(size), link[k] / (size + 1), math.log1p(size / (tags[k] + 1)), own[k] / (size + 1),
                math.log1p(paragraphs[k]), marks[k] / (size + 1), avoid, avoid_above[k], seek, seek_above[k],
                size / (chars[up] + 1) if k else 1.0, place[k] / count[k], math.log(count[k]), size / page, around[k], centre[k],
                *beside[k], size / (segments[k] + 1), *group])
        return rows

    def labels(self) -> list[bool | None]:
        """Whether most of each node's text is main text; None without text."""
        n = len(self.tag)
        good, total = [0] * n, [0] * n
        for node, text, _ in self.runs:
            total[node] += len(text)
            good[node] += len(text) * bool(self.gold[node])
        for k in range(n - 1, 0, -1):
            total[self.parent[k]] += total[k]
            good[self.parent[k]] += good[k]
        return [2 * g >= t if t else None for g, t in zip(good, total)]

    def text(self, odds: list[float]) -> str:
        """Main text under the likeliest labels; ``odds`` are log odds of the nodes.

        Keeping a node gains its log odds against dropping it. A node is kept if its
        gain and the best its children can add are positive together.
        """
        n = len(self.tag)
        gain = [min(8.0, max(-8.0, x)) for x in odds]
        sized = [0] * n
        for node, text, _ in self.runs:
            sized[node] += len(text)
        total = sized[:]
        for k in range(n - 1, 0, -1):
            total[self.parent[k]] += total[k]
        for k in range(n - 1, 0, -1):
            if not total[k]:
                gain[k] = 0.0
            gain[self.parent[k]] += max(0.0, gain[k])
        kept = [gain[0] > 0] + [False] * (n - 1)
        for k in range(1, n):
            kept[k] = kept[self.parent[k]] and gain[k] > 0
        return "\n".join(text for node, text, _ in self.runs if text and kept[node])


def rule_odds(page: Page) -> list[float]:
    """Log odds from tags and tokens alone."""
    return [-4.0 if tag in AROUND or any(t in AVOID for t in tokens) else 1.0 for tag, tokens in zip(page.tag, page.tokens)]


WRAPPERS = [("<article data-gold=1>", "</article>"), ("<main data-gold=1>", "</main>"), ('<div class="post-content" data-gold=1>', "</div>"),
            ('<div id="content" data-gold=1>', "</div>"), ('<section class="entry" data-gold=1>', "</section>"), ("<div data-gold=1>", "</div>"),
            ('<div class="story" data-gold=1><div>', "</div></div>"), ('<main><article class="hentry" data-gold=1>', "</article></main>")]
SURROUND = [  # {0} and {1} are filled with sentences, {2} with links
    "<header><h1>{0}</h1><p>{1}</p></header>", '<div class="header">{0}</div>', "<aside><h2>{0}</h2><p>{1}</p></aside>",
    '<div class="sidebar"><h3>{0}</h3><p>{1}</p><ul>{2}</ul></div>', '<div class="cookie-notice"><p>{0} {1}</p><button>{0}</button></div>',
    '<div id="notice">{0}</div>', '<div role="alert" class="alert">{0} {1}</div>', '<div class="ad">{0}</div>', '<div class="advert"><p>{0}</p></div>',
    '<div class="promo-banner"><a href="/x">{0}</a></div>', "<form><p>{0}</p><label>{0}</label><input name=q><button>{0}</button></form>",
    '<div class="newsletter signup"><form action="/s"><p>{1}</p></form></div>',
    '<section class="comments"><h2>{0}</h2><div class="comment"><p>{1}</p></div><div class="comment"><p>{0} {1}</p></div></section>',
    '<div id="comments"><p>{1}</p><p>{0}</p><p>{1}</p></div>', '<ol class="comment-list"><li><p>{1}</p></li><li><p>{0}</p></li></ol>',
    '<div class="related"><ul>{2}</ul></div>', '<ul class="menu">{2}</ul>', "<nav>{2}</nav>", "<footer><p>{0}</p><p>{1}</p></footer>",
    '<div class="footer">{0}</div>', '<div class="share">{2}</div>', '<p class="notice">{0}</p>']


def training_variants(source: str, other: str, seed: int) -> list[str]:
    """The page with its article marked, and variants of it with text of another page around and inside the article."""
    opening = re.search(r"<(article|main)\b[^>]*>", source, re.I)
    if not opening:
        return []
    closing = source.lower().rfind(f"</{opening[1].lower()}>")
    closing = closing if closing > opening.end() else len(source)
    before, inner, after = source[:opening.start()], source[opening.end():closing], source[closing:]
    after = re.sub(rf"^</{opening[1]}\s*>", "", after, flags=re.I)
    sentences = [x for x in re.split(r"(?<=[.!?])\s+|<[^>]*>", other) if x and len(x) > 12 and "<" not in x] or ["Other text."]
    out = []
    for variant in range(VARIANTS):
        rng = random.Random(seed * VARIANTS + variant)

        def block():
            def said(most):
                return html.escape(" ".join(rng.choice(sentences) for _ in range(rng.randint(1, most))), quote=False)
            links = "".join(f'<li><a href="/l{k}">{said(1)[:30]}</a></li>' for k in range(rng.randint(2, 7)))
            return rng.choice(SURROUND).format(said(1)[:rng.randint(20, 120)], said(rng.choice([1, 3, 8])), links)

        if not variant:
            out.append(f"{before}<{opening[1]} data-gold=1>{inner}</{opening[1]}>{after}")
            continue
        start, end = rng.choice(WRAPPERS)
        parts = re.split(r"(?=<p[ >])", inner)
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randint(1, len(parts)), re.sub(r"^<(\w+)", r"<\1 data-gold=0", block()))
        head = "".join(block() for _ in range(rng.randint(0, 3)))
        foot = "".join(block() for _ in range(rng.randint(0, 3)))
        out.append(before + head + start + "".join(parts) + end + foot + after)
    return out


def training_rows(pages: DataFrame) -> DataFrame:
    """(features, label) of the nodes of the training pages and their variants."""
    marked = pages.filter(F.col("html").rlike(r"(?i)<(article|main)\b")).select("url", "html")
    # Bounded by TRAINING_PAGES, of which each task sends its first; repeated pages among them count once.
    first = marked.orderBy(F.xxhash64("url", "html"), "url", "html").limit(TRAINING_PAGES).distinct()
    # The first page stands next to the last, so that each has another's text.
    chosen = staged(first.orderBy(F.xxhash64("url", "html"), "url", "html").coalesce(1).select("html"), "training-pages")

    def run(batches):
        for batch in batches:
            sources = batch.column(0).to_pylist()
            rows, marks = [], []
            for k, source in enumerate(sources):
                for text in training_variants(source, sources[k - 1], k):
                    page = Page(text)
                    for row, label in zip(page.features(), page.labels()):
                        if label is not None:
                            rows.append(row)
                            marks.append(float(label))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), pa.array(marks, pa.float64())], ["row", "label"])

    return chosen.coalesce(1).mapInArrow(run, "row array<double>, label double")


class Trees:
    """Boosted trees as arrays, for vectorised scoring inside tasks."""

    def __init__(self, model):
        self.trees = []
        for tree, weight in zip(model.trees, model.treeWeights):
            nodes: list[list[float]] = []

            def add(node):
                k = len(nodes)
                nodes.append([0, math.inf, k, k, node.prediction()])
                if node.getClass().getSimpleName() == "InternalNode":
                    split = node.split()
                    nodes[k][:2] = split.featureIndex(), split.threshold()
                    nodes[k][2] = add(node.leftChild())
                    nodes[k][3] = add(node.rightChild())
                return k

            add(tree._java_obj.rootNode())
            table = np.array(nodes)
            self.trees.append((table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), weight * table[:, 4]))

    def odds(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        total, every = np.zeros(len(rows)), np.arange(len(rows))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(rows), int)
            for _ in range(DEPTH):
                at = np.where(rows[every, feature[at]] <= threshold[at], left[at], right[at])
            total += value[at]
        return 2 * total


def fit_trees(pages: DataFrame) -> Trees | None:
    rows = staged(training_rows(pages), "nodes")
    if len(rows.select("label").distinct().take(2)) < 2:
        return None
    data = rows.select(array_to_vector("row").alias("features"), "label")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=5, seed=1).fit(data)
    return Trees(model)


def extract_texts(pages: DataFrame, trees: Trees | None = None) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = pages.select("page_id", "url", "html")
    trees = trees or fit_trees(pages)

    def run(batches):
        for whole in batches:
            for low in range(0, whole.num_rows, 256):  # each part is sent on before the next is parsed
                batch = whole.slice(low, 256)
                parsed = [Page(x or "") for x in batch.column(2).to_pylist()]
                texts: list[str] = []
                if trees is None:
                    texts = [p.text(rule_odds(p)) for p in parsed]
                else:
                    rows = np.array([row for p in parsed for row in p.features()]).reshape(-1, N_FEATURES)
                    odds, at = trees.odds(rows).tolist(), 0
                    for p in parsed:
                        texts.append(p.text(odds[at:at + len(p.tag)]))
                        at += len(p.tag)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    return pages.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
