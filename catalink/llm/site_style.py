"""Main text of web pages with a site style tree.

The pages of a host are merged into one tree of style nodes. A style node is
the path of tags (with class and id) from the root. Over the host's pages with
distinct texts each node gets an importance:

* presentation: the entropy of the sequences of child tags that its elements
  show, normalised by the number of pages;
* content: for a node whose elements hold text blocks, the entropy of their
  texts, normalised likewise.

The importance is the larger of the two. A node whose text repeats on nearly
all pages of a host (menus, notices, share lines) comes near 0, and its own
blocks are removed from every page of that host. The nodes below it are judged
by themselves, so a wrapper with a fixed line keeps the article that it holds.
A node needs ``LEAST_PAGES`` such pages to be judged. The body, article and main
elements are never judged as nodes, so a host of copies keeps its articles.

Elements with one path on a page are one node, whose text is all of theirs. A
line that repeats between siblings of its own kind would hide in it, so every block of
a path is judged alone too, in any element: by the importance that the node
would have if it held this block on the pages that do, and on each other page a
text of its own. Where pages of a host are near copies of one article, what they
share is therefore removed like any other repeated block.

Entropy alone can't tell boilerplate that differs from page to page (adverts
and footers with changing texts) from an article. Branches whose element says
what it is (nav, footer, aside, form, script ..., or a class or id such as
``ad``, ``sidebar``, ``comments``) therefore have importance 0 from the start,
and where a page has an article or main element, text outside it is removed.
A class or id says nothing of an element that holds a main element, or an article
that stands in no other article: ``has-sidebar`` is a wrapper. Only where such an
article stands elsewhere outside of all boilerplate, a whole class or id such as
``comments`` or ``related`` still names the branch, with the articles in it.
A class counts as a whole: ``site-footer`` is a noise word among plain ones, ``footer-theory`` is not, and the id of a heading, paragraph or
section never counts. If such names leave no text of a page, those but of adverts, comments and the like are set aside, and the tree judges.
Inside an article or main element only the words of adverts, comments and the like (``INNER_NOISE_WORDS``) say
something: a ``post-header`` or ``notice`` is part of the article there, unless the tree finds that it repeats.

Result: blocks in page order, character references decoded, white space inside
a block made one space, blocks joined by one space.

Time and memory of a page grow in proportion to its html, however deep the elements nest: an element
keeps its parent and a hash of its style path.

Defined cases: null, empty or unmarked html (plain text counts as one block);
unclosed elements end with the element around them; a truncated tag at the end
is dropped. A null url belongs to the host ''. Repeated rows stay repeated, but
count once in the tree. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as html_module
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow, saved, sliced
from .url_rules import url_host

LEAST_PAGES = 8
LEAST_IMPORTANCE = 0.1
SALTS = 16

#: Fixed values of HTML: elements without content, with raw text, and with text that is not a part of a sentence's flow.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that close an open one of the same kind, and what bounds the search for it.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BOUNDS = {"p": {"article", "section", "div", "body", "td", "li", "blockquote"}, "li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ENDS_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())

#: Elements, roles and class or id words that name boilerplate.
NOISE_TAGS = frozenset("head nav footer aside form script style noscript template iframe button select textarea input svg canvas object embed dialog menu title".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies cookiebar disqus footer "
    "header login masthead menu menubar modal nav navbar navigation newsletter notice notices pagination pager popup promo promoted promotion related respond "
    "share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: The words that name boilerplate inside an article or main element too.
INNER_NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments disqus newsletter promo promoted promotion related respond "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription".split()
)
#: Words that stand beside those in a name and say nothing else: ``site-footer``, but not ``footer-theory``.
PLAIN_WORDS = frozenset("area bar block bottom box button buttons container global inner item items left links list main page post posts primary right secondary section site slot thread top unit wrap wrapper".split())
#: Elements whose id may name boilerplate; that of a heading, paragraph or section is a place to link to.
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NAMED_BY_ID = frozenset("div ul ol aside nav table".split())
MAIN_TAGS = frozenset({"article", "main"})

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?P<close>>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.S)
NAME_WORD = re.compile(r"[a-z]+")


def _names(token: str, noise_words: frozenset[str]) -> bool:
    """Whether a whole class or id names boilerplate: a noise word, with nothing beside it but plain words."""
    words = NAME_WORD.findall(token)
    return not noise_words.isdisjoint(words) and all(w in noise_words or w in PLAIN_WORDS for w in words)


def _named(tag: str, rest: str, noise_words: frozenset[str]) -> tuple[str, bool, bool, bool]:
    """The style name that class and id give, whether they name boilerplate, whether adverts, comments and the like, and whether the role or a hiding attribute names some."""
    if "=" not in rest:
        return "", False, False, False
    values = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(rest)}
    shown = " ".join(values.get(k, "") for k in ("class", "id")).strip().lower()
    said = [] if tag in HEADINGS else values.get("class", "").lower().split() + ([values["id"].lower()] if "id" in values and tag in NAMED_BY_ID else [])
    hard = values.get("role", "").lower() in NOISE_ROLES or values.get("hidden") == "hidden" or values.get("aria-hidden") == "true"
    return re.sub(r"\d+", "0", shown), any(_names(t, noise_words) for t in said), any(_names(t, INNER_NOISE_WORDS) for t in said), hard


class Page:
    """The elements of a page in order and its text blocks, without a tree of objects.

    ``paths``: hash of the style path of each element; ``children``: tags of the children; ``blocks``: (element, text).
    ``noise``, ``sure`` and ``inside``: whether an element lies in a boilerplate branch, in one by more than a vague class or id, in an article or main element.
    """

    def __init__(self, source: str):
        self._parse(source, frozenset())
        wrappers = self._wrappers()
        if wrappers:
            self._parse(source, wrappers)
        if not any(not self.noise[i] for i, _ in self.blocks):
            # what names say would leave nothing of the page: it is left to the tree
            self.noise = self.sure

    def _parse(self, source: str, wrappers: frozenset[int]) -> None:
        """``wrappers``: elements whose class or id doesn't make them boilerplate."""
        self._exempt = wrappers
        # elements whose class or id names boilerplate, and whether a whole class or id does; articles that stand in no other, main elements
        self._worded: dict[int, bool] = {}
        self._articles: list[int] = []
        self._mains: list[int] = []
        self._in_article = [False]
        self.paths, self.children, self.parents = [path_hash("")], [[]], [0]
        self._below: dict[tuple[int, str], int] = {}
        self.noise, self.sure, self.inside, self.judged = [False], [False], [False], [False]
        self.blocks: list[tuple[int, str]] = []
        self._text: list[str] = []
        self._owner = 0
        stack: list[tuple[str, int]] = [("", 0)]
        # the places in the stack of the open elements of each tag
        self._open_at: dict[str, list[int]] = {}
        at, n = 0, len(source)
        while at < n:
            cut = source.find("<", at)
            if cut < 0:
                cut = n
            if cut > at:
                self._add(stack[-1][1], source[at:cut])
            if cut == n:
                break
            match = TOKEN.match(source, cut)
            if not match:
                self._add(stack[-1][1], "<")
                at = cut + 1
                continue
            at = match.end()
            if not match["tag"]:
                continue
            tag = match["tag"].lower()
            if match["end"]:
                if self._open_at.get(tag):
                    self._close(stack, self._open_at[tag][-1])
                elif tag == "p":
                    self._flush(tag)
                continue
            if not match["close"]:
                break
            self._imply(stack, tag)
            self._flush(tag)
            element = self._open(stack[-1][1], tag, match["rest"])
            if tag in VOID or match["rest"].endswith("/") and tag not in INLINE and tag in ("svg", "path"):
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                if tag == "textarea" or tag == "title":
                    self._add(element, source[at : end.start() if end else n])
                    self._flush("")
                at = end.start() if end else n
                if end:
                    at = source.find(">", at) + 1 or n
                continue
            self._open_at.setdefault(tag, []).append(len(stack))
            stack.append((tag, element))
        self._flush("")

    def _close(self, stack: list[tuple[str, int]], depth: int) -> None:
        """Closes the element at this place in the stack, and those in it."""
        while len(stack) > depth:
            tag = stack.pop()[0]
            self._open_at[tag].pop()
            self._flush(tag)

    def _open(self, parent: int, tag: str, rest: str) -> int:
        name, worded, clear, hard = _named(tag, rest, INNER_NOISE_WORDS if self.inside[parent] else NOISE_WORDS)
        place = len(self.paths)
        label = f"{tag}.{name}" if name else tag
        self.children[parent].append(label)
        step = (self.paths[parent], label)
        if step not in self._below:
            self._below[step] = path_hash(f"{step[0]}/{label}")
        self.paths.append(self._below[step])
        self.children.append([])
        self.parents.append(parent)
        outer = tag == "header" and not self.inside[parent]
        noise = hard
        if worded and tag not in ("html", "body", "article", "main"):
            self._worded[place] = not NOISE_WORDS.isdisjoint(name.split())
            noise = hard or place not in self._exempt
        by_name = noise and tag not in ("html", "body", "article", "main")
        self.noise.append(self.noise[parent] or tag in NOISE_TAGS or outer or by_name)
        self.sure.append(self.sure[parent] or tag in NOISE_TAGS or outer or (hard or clear) and by_name)
        if tag == "main":
            self._mains.append(place)
        elif tag == "article" and not self._in_article[parent]:
            self._articles.append(place)
        self._in_article.append(self._in_article[parent] or tag == "article")
        self.inside.append(self.inside[parent] or tag in MAIN_TAGS)
        self.judged.append(tag not in ("html", "body", "article", "main"))
        return place

    def _wrappers(self) -> frozenset[int]:
        """The elements that hold the article or main element, so that a class or id doesn't make them boilerplate."""
        if not self._worded:
            return frozenset()
        free = any(not self.noise[i] for i in self._articles)
        out: set[int] = set()
        for held, exact_too in ((self._mains, True), (self._articles, not free)):
            passed: set[int] = set()
            for i in held:
                while i and i not in passed:
                    passed.add(i)
                    i = self.parents[i]
                    if i in self._worded and (exact_too or not self._worded[i]):
                        out.add(i)
        return frozenset(out)

    def _imply(self, stack: list[tuple[str, int]], tag: str) -> None:
        """Closes what the new element ends without an end tag."""
        for closed, bounds in ((CLOSES.get(tag), BOUNDS.get(tag)), ({"p"} if tag in ENDS_P else None, BOUNDS["p"])):
            if not closed:
                continue
            while (depth := self._deepest(closed)) > self._deepest(bounds):
                self._close(stack, depth)
                if tag != "tr":
                    break

    def _deepest(self, tags: Iterable[str]) -> int:
        """The place in the stack of the innermost open element with one of the tags, 0 without one."""
        return max((self._open_at[t][-1] for t in tags if self._open_at.get(t)), default=0)

    def _add(self, element: int, text: str) -> None:
        if not self._text:
            self._owner = element
        elif self.noise[element] != self.noise[self._owner]:
            self._flush("")
            self._owner = element
        self._text.append(text)

    def _flush(self, tag: str) -> None:
        """Ends the block unless the tag stands inside a line of text."""
        if tag in INLINE or not self._text:
            return
        text = " ".join(html_module.unescape("".join(self._text)).split())
        self._text = []
        if text:
            self.blocks.append((self._owner, text))

    def main_text(self, removed: frozenset[int] = frozenset()) -> str:
        """The blocks that stay when those of the style nodes with these hashes, and blocks with these hashes, are removed."""
        within = any(self.inside[i] and not self.noise[i] for i, _ in self.blocks)
        kept = [(i, text) for i, text in self.blocks if not self.noise[i] and (self.inside[i] or not within)]
        if removed:
            kept = [(i, text) for i, text in kept if not (self.judged[i] and self.paths[i] in removed or block_hash(self.paths[i], text) in removed)]
        return " ".join(text for _, text in kept)

    def style_rows(self) -> Iterator[tuple[int, str, int]]:
        """(hash of the style path, kind, hash) of what each node shows on this page: the children ('p') and texts ('c')
        of nodes that may be judged; of all nodes with text outside boilerplate, each block ('b') and once null ('n')."""
        shown: dict[int, list[str]] = {}
        texts: dict[int, list[str]] = {}
        for i, path in enumerate(self.paths):
            if self.judged[i] and not self.noise[i]:
                shown.setdefault(path, []).append(",".join(self.children[i]))
        judged = set(shown)
        for i, text in self.blocks:
            if not self.noise[i]:
                texts.setdefault(self.paths[i], []).append(text)
        for key in judged.union(texts):
            if key in judged:
                yield key, "p", path_hash("|".join(shown[key]))
                if key in texts:
                    yield key, "c", path_hash("\n".join(texts[key]))
            if key in texts:
                yield key, "n", 0
                for text in set(texts[key]):
                    yield key, "b", block_hash(key, text)


def path_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def block_hash(node: int, text: str) -> int:
    return path_hash(f"{node}\n{text}")


def style_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) to (host, page, node, kind, value): what each style node shows on each page."""
    for batch in sliced(batches):
        rows: list[tuple] = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            page = Page(source or "")
            key = path_hash(page.main_text())
            rows += [(host, key, *row) for row in page.style_rows()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["host", "page", "node", "kind", "value"])


def low_importance_nodes(pages: DataFrame) -> DataFrame:
    """(host, nodes) of the style nodes and blocks to remove on each host that has some. ``pages``: host, html.

    The entropy of n pages with counts c of their values is ln n - sum(c ln c) / n. Pages with distinct
    main texts are counted, so that copies of an article don't make it look like boilerplate. All steps combine before they shuffle."""
    rows = in_arrow(pages, style_batches, "host string, page long, node long, kind string, value long").distinct()
    values = rows.groupBy("host", "node", "kind", "value").agg(F.count(F.lit(1)).alias("c"))
    # a block is a row of its own; nothing on fewer pages than LEAST_PAGES can be removed
    block = F.when(F.col("kind") == "b", F.col("value")).alias("block")
    entropy = values.groupBy("host", "node", "kind", block).agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.ln("c")).alias("s"))
    often = saved(entropy.filter(F.col("n") >= LEAST_PAGES), "site-style-counts")
    share = often.filter(F.col("kind").isin("p", "c")).withColumn("importance", (F.ln("n") - F.col("s") / F.col("n")) / F.ln("n"))
    judged = share.groupBy("host", "node").agg(F.max("importance").alias("importance"), F.count_if(F.col("kind") == "c").alias("has_text"))
    low = judged.filter((F.col("importance") < LEAST_IMPORTANCE) & (F.col("has_text") > 0)).select("host", "node")
    # the pages of a node meet its blocks, which are spread over salts; other pages add nothing to the sum, as ln 1 = 0
    blocks = often.filter(F.col("kind") == "b").select("host", "node", "block", "s", F.pmod("block", F.lit(SALTS)).alias("salt"))
    on = often.filter(F.col("kind") == "n").select("host", "node", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))).alias("salt"))
    met = blocks.join(on, ["host", "node", "salt"])
    repeated = met.filter((F.ln("n") - F.col("s") / F.col("n")) / F.ln("n") < LEAST_IMPORTANCE)
    return low.union(repeated.select("host", "block")).groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("nodes"))


def text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(page_id, url, html, nodes) to (page_id, url, text)."""
    known: dict[tuple, frozenset[int]] = {}
    for batch in sliced(batches):
        texts = []
        for source, nodes in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            key = tuple(nodes or ())
            texts.append(Page(source or "").main_text(known.setdefault(key, frozenset(key))))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", "html", url_host(F.col("url")).alias("host"))
    removed = saved(low_importance_nodes(rows.select("host", "html")), "site-style-nodes")
    # the rows of a large host are spread over salts, for each of which its nodes are repeated
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    repeated = removed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = salted.join(repeated, ["host", "salt"], "left").select("page_id", "url", "html", "nodes")
    texts = in_arrow(joined, text_batches, "page_id long, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
