"""Main-text extraction by minimum-cut labelling of text blocks.

A page is read tag by tag into text blocks, each with its chain of open
elements. A linear classifier over cues of the block (the elements around it,
words of their class and id, link share, length, punctuation) gives a cost for
either label; the costs are terminal capacities. Smoothness edges join blocks
next to each other and consecutive blocks of one parent; the nearer two blocks
are in the tree, the dearer it is to part them, and an edge across a region
that only one of them is in (menu, footer, advert, comments) is weak. The
minimum cut, found by max-flow, separates content from boilerplate.

A boilerplate word or a form condemns all it holds, unless it wraps the page:
:func:`lift_wrappers` takes the mark off what holds the main text. Layout words
(``has-sidebar``, ``header-fixed``) only make the blocks outside content dearer.
Inside an article or main element a class condemns only if all its words are
boilerplate (``share-buttons``, not ``share-price``), and an id, which pages make
from headings, only by advert and comment words. Text of hidden or advert inline elements goes.

Nodes whose terminal capacity is at least the sum of their edges keep their
label in some minimum cut, so they are fixed first and only the doubtful rest
is cut by augmenting paths; the flow graph stays small on long pages.

Output: character references decoded, white space inside a block turned into
one space, blocks trimmed and joined by one line break in page order. Defined
cases: null, empty or text-free pages give an empty text; unclosed and stray
tags close as browsers close them; unclosed comments, scripts and styles reach
to the end; repeated rows are extracted alike; input columns that clash with
``main_text`` get underscores added. Each page is one row: no shuffle.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import table

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
RAW = {"script", "style", "noscript", "textarea", "iframe", "title", "xmp", "noembed", "noframes"}
RAW_END = {tag: re.compile(rf"</{tag}(?:[\s/][^>]*)?(?:>|\Z)", re.I) for tag in RAW}
DROPPED = {"template", "svg", "canvas", "select", "audio", "video", "annotation", "annotation-xml"}  # markup like any other, but left out
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
          "math", "mi", "mn", "mo", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror",
          "mpadded", "mphantom", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts",
          "mprescripts", "menclose", "mfenced", "maction", "semantics"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
         "th": {"table", "tr"}, "option": {"select"}, "thead": {"table"}, "tbody": {"table"}}
BOILER_TAGS = {"nav", "footer", "aside", "button", "menu", "dialog", "head"}
WRAPPER_TAGS = {"form", "fieldset"}
BOILER_WORDS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar
    side aside menu nav navbar navigation breadcrumb breadcrumbs footer header masthead topbar comment comments reply
    replies disqus respond cookie cookies consent gdpr notice notices notification alert newsletter subscribe
    subscription signup signin login register share sharing social related recommended recommendations widget popup
    modal overlay toolbar pagination pager tags tagcloud copyright legal disclaimer skip search outbrain taboola
    contentinfo complementary commentlist commentform kommentar kommentare werbung anzeige commentaire commentaires
    publicite comentario comentarios publicidad""".split())
# inside the article, a class only condemns if all its words are boilerplate or name a mere part of the layout
PART_WORDS = set("""area bar block box button buttons col container content form group header heading icons inner item items
    links list listing main panel posts row section stories title wrap wrapper articles""".split())
STRONG_WORDS = set("""ad ads adv advert adverts advertisement comment comments commentlist commentform kommentar kommentare werbung
    anzeige commentaire commentaires publicite comentario comentarios publicidad""".split())
READER_WORDS = set("comment comments reply replies disqus respond cookie cookies consent gdpr".split())
LAYOUT_BEFORE = {"has", "no", "with", "without"}
LAYOUT_AFTER = {"fixed", "sticky", "page", "layout", "enabled", "disabled", "open", "closed"}
CONTENT_TAGS = {"article", "main"}
CONTENT_WORDS = set("article content main post entry story body text maintext prose".split())
NEAR, FAR, ACROSS = 1.0, 0.4, 0.05
VERDICT, LIFTABLE = 2, 1


class Element:
    __slots__ = ("tag", "up", "depth", "own", "boiler", "weak", "reader", "content", "anchor", "link", "region", "article", "unseen")

    def __init__(self, tag: str, up: Element | None, attrs: str):
        words, hidden, weak, role = set(), False, False, ""
        in_article = up is not None and up.article
        if attrs:
            for name, value in ATTRIBUTE.findall(attrs):
                name, value = name.lower(), value.strip("\"'")
                if name in ("class", "id", "role"):
                    for one in value.split():
                        parts = re.findall(r"[a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", one).lower())
                        if in_article and not (set(parts) <= (STRONG_WORDS | PART_WORDS if name == "id" else BOILER_WORDS | PART_WORDS)):
                            parts = [x for x in parts if x not in BOILER_WORDS]  # a topic's name, as in a heading's id
                        for i, word in enumerate(parts):
                            if word in BOILER_WORDS and ((i and parts[i - 1] in LAYOUT_BEFORE)
                                                         or (i + 1 < len(parts) and parts[i + 1] in LAYOUT_AFTER)):
                                weak = True
                            else:
                                words.add(word)
                    role = value.lower() if name == "role" else role
                elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                    hidden = True
                elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
                    hidden = True
        self.tag, self.up = tag, up
        self.depth = up.depth + 1 if up is not None else 0
        inside = up is not None and up.content
        main = tag in CONTENT_TAGS or (tag not in ("body", "html") and bool(words & CONTENT_WORDS))
        named = bool(words & BOILER_WORDS)
        # a header inside the article holds its heading; one outside belongs to the site
        verdict = hidden or tag in BOILER_TAGS or (tag == "header" and not inside)
        own = verdict or tag in WRAPPER_TAGS or (
            tag not in ("body", "html", "article", "main") and named
            and not (inside and tag in ("header", "h1", "h2") and not words & {"ad", "ads", "comment", "comments"}))
        self.own = VERDICT if verdict else LIFTABLE if own else 0
        self.reader = bool(words & READER_WORDS)
        self.anchor = (tag in CONTENT_TAGS or role == "main") and not named
        self.weak = (weak and tag not in ("body", "html")) or (up is not None and up.weak)
        self.content = inside or main
        self.article = in_article or tag in CONTENT_TAGS
        # of an inline element, all that hides its text for sure
        self.unseen = tag in INLINE and (hidden or bool(words & STRONG_WORDS) or (up is not None and up.unseen))
        self.link = tag == "a" or (up is not None and up.link)
        self.inherit()

    def inherit(self) -> None:
        up = self.up
        self.boiler = self.own > 0 or (up is not None and up.boiler)
        self.region = self if self.own or self.tag in CONTENT_TAGS else (up.region if up is not None else None)


class Block:
    __slots__ = ("element", "parts", "linked", "size", "text")

    def __init__(self, element: Element):
        self.element, self.parts, self.linked, self.size = element, [], 0, 0


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order."""
    root = Element("html", None, "")
    here, out, block = root, [], None
    dropped = None
    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        closing, tag, attrs, text = m.groups()
        if tag is not None and not closing and not attrs.rstrip().endswith("/"):
            raw = tag.lower()
            if raw in RAW and (dropped is None or raw in ("script", "style")):
                end = RAW_END[raw].search(page, at)  # the body is no markup: only its own end tag ends it
                at = end.end() if end else len(page)
                continue
        if dropped is not None:
            if closing and tag.lower() == dropped:
                dropped = None
            continue
        if text is not None:
            if here.unseen:
                continue
            if block is None:
                holder = here
                while holder.tag in INLINE and holder.up is not None:
                    holder = holder.up
                block = Block(holder)
                out.append(block)
            text = html_lib.unescape(text)
            block.parts.append(text)
            n = len(text.strip())
            block.size += n
            if here.link:
                block.linked += n
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if not closing:
            if tag in DROPPED and not attrs.rstrip().endswith("/"):
                dropped = tag
                continue
            if tag == "br":
                if block is not None:
                    block.parts.append(" ")
                continue
            if tag not in INLINE:
                block = None
                e = here
                while e is not None and e.tag in INLINE:
                    e = e.up
                if e is not None and e.tag == "p" and tag not in VOID:
                    here = e.up or root  # a block ends an open paragraph
            if tag in CLOSES:
                e, scope = here, SCOPE[tag]
                last = None
                while e is not None and e.tag not in scope:
                    if e.tag in CLOSES[tag]:
                        last = e
                    e = e.up
                if last is not None:
                    here = last.up or root
            if tag not in VOID and not attrs.rstrip().endswith("/"):
                here = Element(tag, here, attrs)
        else:
            if tag not in INLINE:
                block = None
            e = here
            while e is not None and e.tag != tag:
                if tag in INLINE and e.tag not in INLINE:
                    e = None  # an inline end tag closes nothing outside its block
                    break
                e = e.up
            if e is not None and e.up is not None:
                here = e.up
    kept = []
    for b in out:
        b.text = " ".join("".join(b.parts).split())
        if b.text:
            kept.append(b)
    return kept


def lift_wrappers(blocks: list[Block]) -> None:
    """Take the mark off elements that wrap the page's main text. Elements with
    a word or form mark (not hidden ones, menus, asides, footers) lose it if

    * a main element is inside, or articles with more plain text than all
      unmarked blocks of the page and than the rest of every marked element
      around them, and no other kind of mark is above these, or
    * they hold most of the page's plain text themselves, no unmarked article
      has text, and the other unmarked content has less than a tenth of theirs;
      what readers wrote and consent boxes never do.
    """
    seen: dict[int, Element] = {}
    for b in blocks:
        e = b.element
        while e is not None and id(e) not in seen:
            seen[id(e)] = e
            e = e.up
    order = sorted(seen.values(), key=lambda e: e.depth)
    if not any(e.own == LIFTABLE for e in order):
        return
    plain = dict.fromkeys(seen, 0)
    for b in blocks:
        plain[id(b.element)] += max(0, b.size - b.linked)
    total = sum(plain.values())
    while True:
        # text below an element that is under no further mark, and the marks above: how many, and whether all may go
        clear, above = dict(plain), {}
        for e in reversed(order):
            if e.up is not None and not e.own:
                clear[id(e.up)] += clear[id(e)]
        for e in order:
            n, may = above[id(e.up)] if e.up is not None else (0, True)
            above[id(e)] = (n + (e.own > 0), may and e.own != VERDICT)
        free = clear[id(order[0])]
        anchors = [e for e in order if e.anchor and clear[id(e)]]
        held = [e for e in anchors if above[id(e)][0] and above[id(e)][1]]
        mains = [e for e in held if e.tag != "article"]
        # articles by the mark they stand under, nested ones once: all together against what else each mark holds
        under: dict[int, list[Element]] = {}
        for e in held:
            up, mark = e.up, None
            while up is not None and not up.anchor and mark is None:
                mark = up if up.own else None
                up = up.up
            if mark is not None:
                under.setdefault(id(mark), []).append(e)
        articles = []
        for k, group in under.items():
            n = sum(clear[id(e)] for e in group)
            marks, e = [], seen[k]
            while e is not None:
                marks += [e] if e.own else []
                e = e.up
            if n > free and clear[k] <= 2 * n and all(clear[id(m)] <= n for m in marks[1:]):
                articles.append((above[k][0], -n, group[0]))
        if mains:
            lift = mains
        elif articles:
            lift = [min(articles, key=lambda a: a[:2])[2]]
        elif any(not above[id(e)][0] for e in anchors):
            break
        else:
            kept = sum(b.size - b.linked for b in blocks if not b.element.boiler and content_score(b) > 0)
            lift = [e for e in order if e.own == LIFTABLE and not e.reader and above[id(e)][1]
                    and clear[id(e)] > total / 2 and kept < clear[id(e)] / 10]
        if not lift:
            break
        for e in lift:
            while e is not None and e.boiler:
                e.own = 0
                e = e.up
        for e in order:
            e.inherit()


def content_score(b: Block) -> float:
    """Log odds that the block is content."""
    e, n = b.element, len(b.text)
    links = b.linked / max(1, b.size)
    s = -0.6
    s += -8.0 if e.boiler else -1.5 if e.weak and not e.content else 0.0
    s += 4.0 if e.content else 0.0
    s += 1.2 if e.tag in ("p", "blockquote", "pre") else 0.6 if e.tag in ("h1", "h2", "h3") else 0.0
    s += min(n, 240) / 120.0
    s += 0.5 if b.text[-1] in ".!?:;\"'”…" else 0.0
    s -= 3.0 * links if links > 0.5 else 0.5 * links
    return s


def edges_of(blocks: list[Block]) -> list[tuple[int, int, float]]:
    edges, last = [], {}
    for i, b in enumerate(blocks):
        e = b.element
        if i:
            f = blocks[i - 1].element
            w = ACROSS if e.region is not f.region else NEAR if e.up is f.up or e is f else FAR
            edges.append((i - 1, i, w))
        j = last.get(id(e.up))
        if j is not None and j != i - 1:
            edges.append((j, i, FAR if blocks[j].element.region is e.region else ACROSS))
        last[id(e.up)] = i
    return edges


def min_cut(score: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of a minimum cut: source side (content) True."""
    n, score = len(score), list(score)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        if w > 0 and i != j:
            near[i][j] = near[i].get(j, 0.0) + w
            near[j][i] = near[j].get(i, 0.0) + w
    # fixed labels: no set of neighbours can pay for flipping the node
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:
        i = todo.popleft()
        if label[i] is None and abs(score[i]) >= sum(near[i].values()):
            label[i] = score[i] > 0
            for j, w in near[i].items():  # the edge becomes a terminal capacity of the neighbour
                del near[j][i]
                score[j] += w if label[i] else -w
                todo.append(j)
            near[i] = {}
    open_ = [i for i in range(n) if label[i] is None]
    if not open_:
        return [bool(x) for x in label]
    s, t = n, n + 1
    cap: list[dict[int, float]] = [dict(x) for x in near] + [{}, {}]
    for i in open_:
        if score[i] > 0:
            cap[s][i], cap[i][s] = score[i], 0.0
        elif score[i] < 0:
            cap[i][t], cap[t][i] = -score[i], 0.0
    while True:
        back, queue = {s: s}, deque([s])
        while queue and t not in back:
            u = queue.popleft()
            for v, c in cap[u].items():
                if c > 1e-9 and v not in back:
                    back[v] = u
                    queue.append(v)
        if t not in back:
            break
        path, v = [], t
        while v != s:
            path.append((back[v], v))
            v = back[v]
        f = min(cap[u][v] for u, v in path)
        for u, v in path:
            cap[u][v] -= f
            cap[v][u] = cap[v].get(u, 0.0) + f
    return [bool(x) if x is not None else i in back for i, x in enumerate(label)]


def main_text(page: str | None) -> str:
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    lift_wrappers(blocks)
    keep = min_cut([content_score(b) for b in blocks], edges_of(blocks))
    return "\n".join(b.text for b, k in zip(blocks, keep, strict=True) if k)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` plus ``main_text``."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h) for h in batch], dtype=object)

    base = pages.select(*[F.col(f"`{c}`").alias(c + "_" if c.lower() == "main_text" else c) for c in pages.columns])
    return base.withColumn("main_text", run(F.col(f"`{html_col}`")))


def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    e = extract(table(spark, sf_dir, "pages"))
    return e.select("page_id", "url", F.col("main_text").alias("text"),
                    F.char_length("main_text").cast("long").alias("n_chars"))
