"""Main text of web pages from flat text blocks.

A page is cut at block tags into flat blocks.  Each block carries its word count and link density, those of its
neighbours, and what its containers are; a decision tree, grown by CART on the small labelled table of page shapes
below, keeps or drops it.  Where it keeps nothing because a class name or a form encloses the whole text, the blocks are
judged once more without these two.
"""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voxloom.llm.common import grown, only_new, slices, table

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Containers that hold page furniture wherever they stand, and those that an article opened later overrides.
FURNITURE = frozenset("aside footer dialog menu".split())
LEADING = frozenset("nav header".split())
CONTENT = frozenset("article main".split())
#: Elements whose text is no text of the page; they end at a block tag, closed or not.
MUTE = frozenset("select button object math canvas audio video svg".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table td th tr ul".split())
#: Words of class and id names of page furniture; those that may stand beside them in one name without changing its sense.
HINTS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr masthead "
    "menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion related replies reply respond share sharing sidebar signup "
    "social sponsor sponsored subscribe subscription toolbar widget widgets disclaimer login".split()
)
BESIDE = frozenset(
    "a an and area article articles aside bar block body bottom box btn button buttons col column container content entries entry footer form global group header holder icons inner item items "
    "left link links list main mobile outer page post posts primary right row secondary section side site slot stories story tags text the thread top unit user wrap wrapper x".split()
)
CONTENT_HINTS = frozenset("article content entry post story main body text".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())

_RAW = "script|style|noscript|template|textarea|iframe|title"
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({_RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?:/>|>.*?(?:</\1\s*>|\Z))"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>|<[!?/][^>]*>|</?[a-zA-Z][^>]*\Z",
    re.S | re.I,
)
_HINT = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPLIT = re.compile(r"[^a-z]+")

#: The labelled table: page shapes.  +12 stands for a run of twelve words of the main text, -12 for twelve words of furniture.
LABELLED = [
    "<header>-2</header><nav><ul><li><a>-1</a><li><a>-2</a><li><a>-1</a></ul></nav><div class=ad>-9</div><article><h1>+7</h1><p>+60<p>+35 <a>+2</a> +20<p>+4</article><aside>-12<p>-40</aside><footer>-6</footer>",
    "<nav><a>-1</a> <a>-1</a></nav><article><h1>+9</h1><p><b>+1</b><br>+150<p>+2<p>+90</article><footer>-12 <a>-2</a></footer>",
    "<body><p>+30</body>",
    "<body><p>+80<p>+80</body>",
    "<body><h1>+5</h1><p>+80<p>+25<p>+2</body>",
    "<body><p>+30<p>+2<p>+45<p>+6</body>",
    "<p>+8",
    "<h1>+4</h1><p>+12",
    "<div>+14</div><div>+22</div><div>+9</div>",
    "<div><a>-1</a> <a>-1</a> <a>-2</a></div><div><h2>+6</h2><div>+40</div><div>+25</div><div>+3</div><div>+70</div></div><div><a>-4</a></div><div><a>-5</a> <a>-3</a></div><div>-4 <a>-2</a></div>",
    "<div><a>-2</a></div><div><a>-1</a> -1 <a>-1</a> -1 <a>-1</a></div><div>+90</div><div>+18</div><div><a>-6</a></div><div><a>-7</a></div><div>-5</div>",
    "<table><tr><td><a>-1</a><td><a>-2</a><td><a>-1</a></table><table><tr><td>+120<tr><td>+60 <a>+3</a> +9</table><table><tr><td>-3 <a>-2</a></table>",
    "<ul><li><a>-2</a><li><a>-1</a><li><a>-3</a></ul><h2>+5</h2><p>+45<ul><li>+6<li>+11<li>+2</ul><p>+50<h3>-2</h3><ul><li><a>-7</a><li><a>-9</a><li><a>-6</a></ul><p>-4",
    "<ul><li><a>-1</a><li><a>-1</a></ul><p>+33<p>+27<h3>+3</h3><p>+64<p>+5<ul><li><a>-5</a><li><a>-4</a></ul>",
    "<main><h1>+8</h1><ul><li>+2<li>+9<li><a>+3</a> +12<li>+1</ul><p><a>+4</a><p>+20<h2>+3</h2><table><tr><td>+3<td>+2<td>+1</table></main><footer><p>-30<a>-1</a></footer>",
    "<article><p>+30<p><a>+1</a><p>+44<ul><li><a>+3</a><li><a>+2</a><li><a>+6</a></ul><p>+5</article>",
    "<main><p><a>+1</a><p><a>+2</a><p>+9<p><a>+12</a><table><tr><td><a>+2</a><td>+1 <a>+1</a></table></main>",
    "<main><p>+1<p>+3<blockquote>+17</blockquote><pre>+40</pre><p>+2 <a>+1</a></main>",
    "<article><header><h1>+8</h1><p>+4</header><nav><a>-1</a> <a>-1</a></nav><p>+80<figure><figcaption>+9</figcaption></figure><p>+14<footer>-8</footer></article>",
    "<article><p>+70<div class=comments><h3>-2</h3><p>-30<p>-60<p>-8</div><p class=advert>-12<p>+25</article>",
    "<article><p>+45<p class=comment>-20<p>+15<div class='share-buttons'><a>-1</a> <a>-1</a></div><form>-3 -2</form></article>",
    "<article><p>+130<section class=comment-list><div class=comment><p>-45<p>-150<a>-1</a></div><div class=comment><p>-9</div></section></article>",
    "<div class='post-content'><p>+50<p>+3<p>+90</div><div class='related-posts'><h3>-2</h3><p>-14<p>-18</div><div id=comments><p>-40<p>-2<p>-75</div>",
    "<div id=content><h1>+6</h1><p>+24<p>+110</div><div id=sidebar><h4>-2</h4><p>-35<ul><li><a>-4</a></ul></div>",
    "<div class='cookie-notice'>-25 <a>-2</a></div><div role=dialog>-30<p>-6</div><div class='entry'><p>+65<p>+40</div><form><p>-12<p>-3</form>",
    "<div class=banner>-8</div><p>+75<p>+38<div class=notice>-22</div><p>+52<div class=widget>-6<p>-28</div>",
    "<div class=ad>-50</div><article><p>+20<div class=ads>-16</div><p>+19</article><div class=sponsored><p>-80</div>",
    "<header><h1>-3</h1><p>-9</header><p>+41<p>+7<p>+28<footer><p>-16<p>-45</footer>",
    "<aside><p>-90<p>-40</aside><section><h2>+4</h2><p>+85<p>+6</section><div hidden>-30</div>",
    "<main><article><h1>+6</h1><p>+48<aside><p>-18</aside><p>+55<div class=promo>-11</div></article><section class=comments><p>-33</section></main>",
    "<div><p>+22 <a>+4</a> +30<p>+16 <a>+9</a> +5<p><a>+2</a> +44</div><div><a>-3</a> <a>-4</a> -1</div>",
    "<div>-2 <a>-1</a> -1 <a>-1</a></div><h1>+7</h1><div>-3</div><div>+58</div><div>+49</div><div><a>-2</a></div>",
]


class Tree:
    """CART: binary splits by Gini impurity on numeric columns, grown until leaves are pure or `depth` is reached."""

    def __init__(self, rows: list[tuple], depth: int = 12, least: int = 4):
        data = np.array(rows, float)
        self.least = least
        self.root = self._grow(data[:, :-1], data[:, -1], depth)

    def _grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> tuple:
        if depth == 0 or y.min() == y.max():
            return (y.mean(),)
        best = (np.inf,)
        for column in range(x.shape[1]):
            values = np.unique(x[:, column])
            for cut in (values[1:] + values[:-1]) / 2:
                left = x[:, column] < cut
                if min(left.sum(), (~left).sum()) < self.least:
                    continue
                gini = sum(len(part) * part.mean() * (1 - part.mean()) for part in (y[left], y[~left]))
                if gini < best[0] - 1e-12:
                    best = (gini, column, cut)
        if len(best) == 1:
            return (y.mean(),)
        left = x[:, best[1]] < best[2]
        return best[1], best[2], self._grow(x[left], y[left], depth - 1), self._grow(x[~left], y[~left], depth - 1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)

        def down(node: tuple, at: np.ndarray) -> None:
            if len(node) == 1:
                out[at] = node[0] >= 0.5
            elif len(at):
                left = x[at, node[0]] < node[1]
                down(node[2], at[left])
                down(node[3], at[~left])

        down(self.root, np.arange(len(x)))
        return out


def _kind(tag: str, attributes: str) -> tuple[bool, bool, bool, bool]:
    """(furniture anywhere, furniture by its name, furniture until content opens, content) of a container."""
    furniture, hinted, leading, content = tag in FURNITURE, False, tag in LEADING, tag in CONTENT
    if attributes.strip():
        for m in _HINT.finditer(attributes):
            name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if name in ("class", "id"):
                for token in value.split():
                    parts = {x for x in _SPLIT.split(token) if x}
                    if parts & HINTS and parts <= HINTS | BESIDE:
                        hinted = True
                    elif parts & CONTENT_HINTS and parts <= CONTENT_HINTS | BESIDE:
                        content = True
            elif name == "role":
                furniture |= value in ROLES
                content |= value in CONTENT
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", "")):
                furniture = True
    return furniture, hinted, leading, content and not (furniture or hinted)


class Block(NamedTuple):
    text: str
    words: int
    linked: int
    furniture: bool
    hinted: bool
    form: bool
    content: bool
    heading: bool


def blocks(page: str) -> list[Block]:
    """The blocks with text, in page order."""
    out: list[Block] = []
    # tag, furniture anywhere, by its name, until content opens, in a form, content
    stack: list[tuple[str, bool, bool, bool, bool, bool]] = [("", False, False, False, False, False)]
    parts: list[str] = []
    linked: list[str] = []
    in_link, heading, mute = False, False, ""
    paragraph = (False, False)

    def end() -> None:
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                _, furniture, hinted, leading, form, content = stack[-1]
                words = text.count(" ") + 1
                out.append(Block(text, words, min(words, len("".join(linked).split())), furniture or leading or paragraph[0], hinted or paragraph[1], form, content, heading))
            parts.clear()
        linked.clear()

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at and not mute:
            parts.append(page[at : m.start()])
            if in_link:
                linked.append(page[at : m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if mute:
            if tag not in BLOCKS:
                mute = "" if m[2] and tag == mute else mute
                continue
            mute = ""
        if tag == "a":
            in_link = not m[2]
            if linked:
                linked.append(" ")
        elif tag in MUTE:
            mute = "" if m[2] or m[4].endswith("/") else tag
        elif tag not in INLINE:
            end()
            if tag in VOID:
                continue
            paragraph = (False, False)
            if m[2]:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i][0] == tag:
                        del stack[i:]
                        break
                if tag[0] == "h" and tag[1:].isdigit():
                    heading = False
            elif tag == "p":
                paragraph = _kind(tag, m[4])[:2] if m[4] else paragraph
            elif tag[0] == "h" and tag[1:].isdigit():
                heading = True
                paragraph = _kind(tag, m[4])[:2] if m[4] else paragraph
            elif not m[4].endswith("/"):
                heading = False
                furniture, hinted, leading, content = _kind(tag, m[4])
                _, above, named, before, form, inside = stack[-1]
                stack.append((tag, above or furniture, named or hinted, (before and not content) or (leading and (tag == "nav" or not inside)), form or tag == "form", inside or content))
    if at < len(page) and not mute:
        parts.append(page[at:])
    end()
    return out


def features(found: list[Block], names: bool = True) -> np.ndarray:
    """Words and link density of each block, its predecessor and its successor; in furniture (by name or form only if `names`), in content, heading."""
    x = np.zeros((len(found), 9))
    for i, b in enumerate(found):
        x[i, 0], x[i, 1], x[i, 6:] = b.words, b.linked / b.words, (b.furniture or (names and (b.hinted or b.form)), b.content, b.heading)
    x[1:, 2:4], x[:-1, 4:6] = x[:-1, 0:2], x[1:, 0:2]
    return x


@functools.cache
def trained() -> Tree:
    """The tree of the labelled table: each shape as it stands, and with shorter and with longer paragraphs."""
    rows = []
    for shape in LABELLED:
        for times in (1.0, 0.4, 3.0):

            def words(m: re.Match, times: float = times) -> str:
                n = int(m[2])
                return " ".join([f"{m[1]}w"] * (max(1, round(n * times)) if n >= 8 and m[1] == "+" else n))

            found = blocks(re.sub(r"([+-])(\d+)", words, shape))
            rows += [(*x, b.text[0] == "+") for x, b in zip(features(found).tolist(), found, strict=True)]
    return Tree(rows)


#: Words that the second look must find, so that a lone form or a list of names is not taken for an article.
SECOND_LOOK = 25


def main_text(page: str | None, tree: Tree) -> tuple[str, int, int]:
    """(text, blocks, blocks kept); a null or empty page has no text."""
    found = blocks(page or "")
    if not found:
        return "", 0, 0
    kept = [b for b, good in zip(found, tree.predict(features(found)), strict=True) if good]
    if not kept and any((b.hinted or b.form) and not b.furniture for b in found):
        again = [b for b, good in zip(found, tree.predict(features(found, names=False)), strict=True) if good]
        kept = again if sum(b.words - b.linked for b in again) >= SECOND_LOOK else []
    return " ".join(b.text for b in kept), len(found), len(kept)


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """All columns of `pages` but the html, and text string (empty if none), n_chars long (code points), n_blocks and n_kept int.

    A null or empty page has an empty text.  Works row by row, so repeated rows and ties get the same text each, an empty
    table gives an empty one, and a very long page is read whole, alone in its slice.  Input columns named like the new
    ones are replaced; all others stay.
    """
    kept = only_new(pages, "text", "n_chars", "n_blocks", "n_kept")
    rest = [c for c in kept.columns if c != column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = trained()
        for whole in batches:
            for batch in slices(whole, column, 8_000_000):
                found = [main_text(page, tree) for page in batch.column(column).to_pylist()]
                new = [pa.array([f[0] for f in found], pa.string()), pa.array([len(f[0]) for f in found], pa.int64()), *(pa.array([f[i] for f in found], pa.int32()) for i in (1, 2))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *new], [*rest, "text", "n_chars", "n_blocks", "n_kept"])

    schema = grown(kept.select(*rest), text="string", n_chars="long", n_blocks="integer", n_kept="integer")
    return kept.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: the main text of every page."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars", "n_blocks", "n_kept")
