"""Main text of web pages by a tree-structured graphical model over the DOM."""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlight.llm.common import small_batches, text_of

BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html label legend li main menu nav ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Elements whose content is never shown as text.
UNSEEN = frozenset("script style title textarea iframe noscript noembed noframes template svg".split())
#: Elements that may be in a head; any other, or a text, ends it, whether or not it is closed.
IN_HEAD = frozenset("head title base basefont bgsound link meta noframes noscript script style template html".split())
#: Elements that set parts of a page apart, and those of them that could hold an article.
PARTS = frozenset("article aside div footer form header main nav section table".split())
HOLDERS = frozenset("article div main section table".split())
#: An element of the left kind ends an open one of the right kinds.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
#: Ends of open elements do not reach beyond these.
SCOPES = frozenset(("table", "td", "th", "ul", "ol", "dl", "select", "button"))
INLINE_IN_P = frozenset(("button", "label", "option", "optgroup"))

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|k)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++))""", re.I)
WORD = re.compile(r"[a-z]+")
CUT = re.compile(r"<[a-zA-Z/!?].*\Z", re.S)


class Tree:
    """Block elements and runs of text, parents before children. Runs have a text."""

    def __init__(self, page: str) -> None:
        self.parent: list[int] = []
        self.features: list[list[str]] = []
        self.text: list[str | None] = []
        self.mark: list[str] = []
        self._tags: list[str] = []
        self._open: list[int] = []
        self._run: list[str] = []
        self._links = 0
        self._in_link = False
        self._add("html", "")
        self._parse(page)
        self._flush()
        if self._plain():
            self.features[0].append("page:plain")

    def _plain(self) -> bool:
        """Whether the page has no parts beside each other: at most one element in another that could hold an article."""
        within = 0
        for n, tag in enumerate(self._tags):
            if tag in PARTS:
                at = n
                while at > within:
                    at = self.parent[at]
                if tag not in HOLDERS or at != within:
                    return False
                within = n
        return True

    def _add(self, tag: str, attributes: str) -> None:
        found = {a.lower(): b or c or d for a, b, c, d in ATTRIBUTE.findall(attributes)} if attributes else {}
        words = set(WORD.findall(" ".join(found.get(a, "") for a in ("class", "id", "role")).lower()))
        self.parent.append(self._open[-1] if self._open else -1)
        self.features.append([f"tag:{tag}", *sorted(f"name:{w}" for w in words)])
        self.text.append(None)
        self.mark.append(found.get("k", self.mark[self._open[-1]] if self._open else ""))
        self._tags.append(tag)
        self._open.append(len(self.parent) - 1)

    def _flush(self) -> None:
        if not self._run:
            return
        whole = "".join(self._run)
        text, links = " ".join(whole.split()), self._links
        self._run, self._links = [], 0
        if not text:
            return
        size = 0 if len(text) < 25 else 1 if len(text) < 100 else 2
        linked = 0 if links * 4 < len(text) else 1 if links * 4 < 3 * len(text) else 2
        self.parent.append(self._open[-1])
        self.features.append([f"size:{size}", f"linked:{linked}"])
        self.text.append(text)
        self.mark.append(self.mark[self._open[-1]])
        self._tags.append("")

    def _say(self, text: str) -> None:
        if text:
            text = entities.unescape(text) if "&" in text else text
            self._run.append(text)
            if self._in_link:
                self._links += len(text)

    def _close(self, tags: tuple[str, ...], scope: frozenset) -> None:
        """Closes the open elements up to the outermost of ``tags`` that no element of ``scope`` encloses."""
        found = None
        for depth in range(len(self._open) - 1, 0, -1):
            tag = self._tags[self._open[depth]]
            if tag in tags:
                found = depth
            elif tag in scope:
                break
        if found is not None:
            self._flush()
            del self._open[found:]

    def _parse(self, page: str) -> None:
        at, head = 0, False
        while True:
            m = TAG.search(page, at)
            if not m:
                self._say(CUT.sub("", page[at:]))  # a tag cut off at the end of the page is no text
                return
            said = page[at : m.start()]
            head = head and not said.strip()
            if not head:
                self._say(said)
            at = m.end()
            end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not tag:
                continue
            tag = tag.lower()
            if tag in UNSEEN and not end:
                if not attributes.endswith("/") or tag != "svg":
                    close = re.compile(rf"</{tag}\s*+>|</{tag}\s", re.I).search(page, at)
                    at = close.end() if close else len(page)
                continue
            if tag == "head":
                head = not end
            elif not end and tag not in IN_HEAD:
                head = False
            if head:
                continue
            if tag == "a":
                self._in_link = not end
            elif tag == "br":
                self._run.append("\n")
            if tag == "html" and "k=" in attributes:
                self.mark[0] = "1"
            if tag not in BLOCKS or tag in ("html", "body"):
                if tag == "body" and not end and attributes:
                    self._flush()
                    self._add("body", attributes)
                continue
            if end:
                self._close_one(tag)
                continue
            self._flush()
            if tag not in INLINE_IN_P:
                self._close(("p",), SCOPES)
            if tag in ENDS:
                self._close(ENDS[tag], SCOPES - set(ENDS[tag]))
            if tag in VOID:
                continue
            self._add(tag, attributes)

    def _close_one(self, tag: str) -> None:
        for depth in range(len(self._open) - 1, 0, -1):
            if self._tags[self._open[depth]] == tag:
                self._flush()
                del self._open[depth:]
                return


def labelled_pages() -> list[str]:
    """Pages whose elements are marked as content (k=1) or not (k=0); marks hold for what is inside.

    They are put together from common ways to name the parts of a page; the words carry no meaning.
    """
    long = "Lorem ipsum dolor sit amet consectetur, adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore. " * 2
    mid, short = "Ut enim ad minim veniam quis nostrud exercitation ullamco.", "Duis aute."
    links = "".join(f"<li><a href=#>{w}</a></li>" for w in ("home", "about us", "contact", "world news"))
    bodies = [
        f"<h1>{mid}</h1><p>{long}</p><p>{short}</p><p>{long}<p>{mid}",
        f"<h1>{short}</h1><p>{short}</p>",
        f"<header><h1>{mid}</h1><p>{mid}</p></header><p>{long}</p><h2>{short}</h2><p>{mid}</p><blockquote><p>{long}</p></blockquote>",
        f"<h2>{mid}</h2><p>{long}</p><ul><li>{mid}</li><li>{short}</li></ul><figure><figcaption>{mid}</figcaption></figure><p>{long}</p>",
        f"<p>{mid}</p><table><tr><th>{short}</th><td>{short}</td></tr><tr><td>{mid}</td><td>{short}</td></tr></table><pre>{long}</pre>",
        f"<h1>{short}</h1><h3>{short}</h3><p>{mid} <a href=#>{short}</a></p><ol><li>{long}</li></ol><p>{short}</p>",
    ]
    holders = [
        ("<article k=1>", "</article>"), ("<main k=1><article>", "</article></main>"), ("<main k=1>", "</main>"), ('<main k=1 id="content">', "</main>"),
        ('<div id="main"><div k=1 class="post-content entry">', "</div></div>"), ('<div k=1 class="article-body story">', "</div>"),
        ('<section k=1 class="article text">', "</section>"), ('<div k=1 role="main">', "</div>"), ("<article k=1>", "</article>"),
        ("<div k=1>", "</div>"), ('<div k=1 class="zq">', "</div>"), ("<div><section k=1>", "</section></div>"), ('<div class="zr"><div k=1 id="zs">', "</div></div>"),
        ("", ""),
    ]
    before = [
        f"<nav k=0><ul>{links}</ul></nav>", f"<header k=0><h1>{short}</h1><p>{mid}</p></header>", f"<header k=0><div>{short}</div><nav><ul>{links}</ul></nav></header>",
        f'<div k=0 class="header top-bar"><p>{short}</p><ul class="menu">{links}</ul></div>', f'<div k=0 id="nav"><ul>{links}</ul></div>',
        f'<div k=0 class="breadcrumb breadcrumbs"><a href=#>{short}</a></div>', f'<div k=0 class="ad">{mid}</div>',
        f'<div k=0 class="cookie notice consent banner"><p>{mid}</p><button>{short}</button></div>', f'<div k=0 role="navigation" class="navbar"><ul>{links}</ul></div>',
        f'<div k=0 class="alert message popup modal"><p>{long}</p></div>', f'<div k=0 class="ads advert advertisement sponsored">{long}</div>',
    ]
    after = [
        f"<footer k=0>{mid}</footer>", f"<footer k=0><p>{short}</p><ul>{links}</ul></footer>", f"<aside k=0><h3>{short}</h3><p>{long}</p></aside>",
        f'<aside k=0 class="sidebar widget"><ul>{links}</ul></aside>', f'<div k=0 class="sidebar side"><h3>{short}</h3><p>{mid}</p></div>',
        f'<section k=0 class="comments" id="comments"><h2>{short}</h2><div class="comment"><p>{long}</p></div><div class="comment"><p>{short}</p></div></section>',
        f'<div k=0 class="comment comment-list responses reply"><p>{mid}</p><p>{long}</p></div>', f'<ol k=0 class="commentlist"><li><p>{long}</p></li></ol>',
        f"<form k=0><label>{short}</label><select><option>{short}</option></select><button>{short}</button></form>",
        f'<form k=0 class="newsletter subscribe signup"><p>{mid}</p><label>{short}</label></form>', f'<div k=0 class="related recommended more-stories"><h3>{short}</h3><ul>{links}</ul></div>',
        f'<div k=0 class="share social tags meta"><a href=#>{short}</a></div>', f'<div k=0 class="footer copyright legal"><p>{mid}</p></div>',
        f'<div k=0 class="promo promotion teaser"><p>{long}</p></div>', f'<div k=0 class="disqus discussion"><p>{long}</p></div>', f"<footer k=0>{long}</footer>",
    ]
    names = (
        "ads advert advertisement sponsored promo banner cookie notice consent alert popup modal newsletter subscribe signup login search share "
        "social breadcrumbs menu nav navbar sidebar widget comments comment reply responses discussion footer copyright header related recommended"
    ).split()
    inner = [f"<p>{mid}</p>", f"<ul><li>{long}</li><li>{short}</li></ul>", f"<h3>{short}</h3><p>{long}</p>", mid, f"<ol><li>{mid}</li></ol>"]
    inside = ["", "", "", f'<div k=0 class="ad">{long}</div>', f'<aside k=0 class="related"><p>{mid}</p></aside>', f"<footer k=0><p>{short}</p></footer>",
              f'<section k=0 class="comments"><p>{long}</p></section>', f"<form k=0><p>{mid}</p></form>", f'<nav k=0><ul>{links}</ul></nav>']
    pages = []
    for n in range(392):
        opened, closed = holders[n % len(holders)]
        tops = before[n % len(before)] + (before[(n * 7 + 3) % len(before)] if n % 3 else "")
        ends = after[n % len(after)] + (after[(n * 5 + 2) % len(after)] if n % 4 else "")
        article = bodies[n // 3 % len(bodies)]
        # Without a holder the article's blocks are marked one by one.
        body = f"{opened}{article if opened else re.sub('<([a-z0-9]+)>', r'<\1 k=1>', article)}{inside[n // 2 % len(inside)]}{closed}"
        kind, name = ("div", "section", "div")[n % 3], names[n % len(names)]
        ends += f'<{kind} k=0 class="{name}">{inner[n % len(inner)]}</{kind}>'
        tops += f"<header k=0><h1>{short}</h1></header>" if n % 6 == 0 else ""
        page = f"{tops}{body}{ends}"
        if n % 5 == 0:
            page = f'<div class="page wrapper container">{page}</div>'
        pages.append(f"<html><body k=0>{page}</body></html>")
    # Pages that are an article and nothing else.
    bare = [*bodies, f"<p>{long}<p>{long}", f"<p>{long}", f"<p>{mid}</p><p>{long}"]
    held = [*bare, *[f"<div class=zq>{b}</div>" for b in bare[-3:]], *[f"<div><section>{b}</section></div>" for b in bare[:2]]]
    return pages + [f"<html k=1>{b}</html>" for b in held if "<header>" not in b] * 3


class Model:
    """Potentials of features and of parent and child, trained on labelled pages.

    Those of parent and child are counted. The weights of features maximise the likelihood of the labels given the
    pages, by gradient steps: the gradient of a weight is what the labels of the nodes with the feature exceed their
    marginals by. Features that no labelled page has weigh nothing.
    """

    def __init__(self, pages: list[str], steps: int = 120, decay: float = 0.05) -> None:
        trees = [Tree(page) for page in pages]
        labels = [[int(mark == "1") for mark in tree.mark] for tree in trees]
        pairs = Counter((y[p], y[n]) for tree, y in zip(trees, labels, strict=True) for n, p in enumerate(tree.parent) if p >= 0)
        self.pair = [[(pairs[a, b] + 1) / (pairs[a, 0] + pairs[a, 1] + 2) for b in (0, 1)] for a in (0, 1)]
        self.root = -4.0  # a page as a whole is not content
        self.unary = dict.fromkeys((f for tree in trees for features in tree.features for f in features), 0.0)
        squares = dict.fromkeys(self.unary, 1e-3)
        for _ in range(steps):
            slope = {f: -decay * w for f, w in self.unary.items()}
            for tree, y in zip(trees, labels, strict=True):
                for features, label, odds in zip(tree.features, y, self.marginals(tree), strict=True):
                    over = label - 1 / (1 + math.exp(max(-30.0, min(30.0, -odds))))
                    for f in features:
                        slope[f] += over
            for f, g in slope.items():
                squares[f] += g * g
                self.unary[f] += 0.6 * g / math.sqrt(squares[f])

    def marginals(self, tree: Tree) -> list[float]:
        """The log odds of being content, for each node, by one sum-product pass up the tree and one down."""
        (t00, t01), (t10, t11) = self.pair
        unary, parent = self.unary, tree.parent
        up = [sum([unary.get(f, 0.0) for f in features]) for features in tree.features]
        up[0] += self.root
        sent = [0.0] * len(up)
        for n in range(len(up) - 1, 0, -1):
            odds = math.exp(max(-30.0, min(30.0, up[n])))
            sent[n] = math.log((t10 + t11 * odds) / (t00 + t01 * odds))
            up[parent[n]] += sent[n]
        whole = up[:]
        for n in range(1, len(up)):
            odds = math.exp(max(-30.0, min(30.0, whole[parent[n]] - sent[n])))
            whole[n] = up[n] + math.log((t01 + t11 * odds) / (t00 + t10 * odds))
        return whole

    def extract(self, page: str) -> str:
        tree = Tree(page)
        odds = self.marginals(tree)
        return "\n".join([text for text, x in zip(tree.text, odds, strict=True) if text is not None and x > 0])


_model: list[Model] = []


def model() -> Model:
    """The model trained on the labelled pages, once for each driver."""
    if not _model:
        _model.append(Model(labelled_pages()))
    return _model[0]


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``; ``text`` is the main text of the whole html.

    A block is a run of text between the borders of block elements, with character references decoded and white
    space turned into single spaces. Blocks whose content marginal is above one half are kept, in page order, joined
    by line breaks. Null and empty pages, and pages without content, have an empty text. Broken markup is read like
    a browser does, as far as blocks go. Repeated rows are repeated; other columns are ignored.
    """
    small_batches(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model())
    rows = pages.select("page_id", "url", text_of("html").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = shared.value
        for batch in batches:
            texts = [trained.extract(page) for page in batch.column(2).to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            names = ["page_id", "url", "text", "n_chars"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), sizes], names)

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
