"""Main text of web pages by two passes of block rules.

A page is cut into blocks at its block-level tags. The first pass judges each block by itself: its length, the share of its
characters that are links, the share of its words that are stop words, and what the elements around it say of themselves (a menu, a footer, an
advert). Long running text is good, link lists and elements that are no text are bad; short blocks stay undecided. The
second pass lets an undecided block inherit the label of the nearest decided ones: if both sides agree, theirs; a heading or a line that
ends with a colon takes the one that follows; else it is good inside an article, and as the nearer one outside.

If the page marks its article (``article``, ``main``) and most of its good text lies there, only blocks inside count, and stop words are
not asked for: what an article holds is text unless it is links or marked as something else. Without such marks stop words decide. A
page in a language without stop words here is judged by length and links.

Defined cases: a null or empty page has an empty text; markup that is never closed ends with its parent, a comment, script or tag without end at
the page's end; elements nested deeper than ``DEEPEST`` are read as part of their parent; a null identifier or address stays null; repeated rows are told each; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import few_rows, table

#: Characters from which a block can be decided, and from which stop words alone make it good.
SHORT, LONG = 70, 200
#: Shares of stop words for nearly good and good blocks, and of characters in links for bad ones: of any block, of one in an article.
STOP_LOW, STOP_HIGH = 0.15, 0.25
LINKS, LINKS_IN_ARTICLE = 0.25, 0.6

STOP_WORDS = frozenset(
    """
    a about after all also an and are as at be been but by can could did do for from had has have he her his how i if in into is it its
    more my no not of on one or our out she so some than that the their them then there they this to up was we were what when which who will
    with would you your
    aber als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach
    nicht noch nur oder sich sie sind so über um und von vor war was wenn wie wird zu zum zur
    au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur lui mais ne nous on ou où par pas plus pour que qui sa se
    ses son sur un une vous
    al como con de del el ella en entre era es esta este la las lo los más me muy no o para pero por que se si sin sobre su sus un una y ya
    che da di e gli ha il le nel non per più sono una em do dos não os um uma het een van niet op te
    """.split()
)

#: Elements whose content is never text of a page.
NO_TEXT = frozenset(
    "script style noscript template head title iframe object embed svg math canvas audio video select option optgroup datalist textarea button "
    "input label legend".split()
)
#: Elements that hold something else than the article.
OTHER = frozenset("nav menu footer aside dialog fieldset".split())
#: Elements that begin and end a block.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
#: Words of class names and identifiers that mark something else than the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion banner cookie cookies consent gdpr notice "
    "notices comment comments disqus respond replies sidebar sidebars related recommended recommendations share sharing social "
    "alert alerts responses reactions nav navbar navigation navi menu menus breadcrumb breadcrumbs pagination pager footer masthead subscribe subscription newsletter signup "
    "login popup modal overlay toolbar copyright disclaimer outbrain taboola teaser teasers".split()
)
#: As a mark it counts alone only: an article's header holds its title.
HEADER = frozenset(["header", "topbar", "siteheader"])
OF_ARTICLE = frozenset("article entry post story content main".split())
#: Before a mark they say that the element has such a part, not that it is one.
HAVING = frozenset("has have with no without hide show is".split())
#: Open elements beyond which no further one is told from its parent, as browsers do.
DEEPEST = 512

_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_WORD = re.compile(r"[^\W\d_]+")


def marked(names: str) -> bool:
    """Whether class names or an identifier name something else than the article."""
    for name in names.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        own = [p for p, before in zip(parts, ["", *parts]) if before not in HAVING]
        if not MARKS.isdisjoint(own) or not HEADER.isdisjoint(own) and OF_ARTICLE.isdisjoint(own):
            return True
    return False


# ---- blocks ----------------------------------------------------------------------------------------------------------


class Block(NamedTuple):
    text: str
    links: int  # characters in links
    heading: bool
    article: int  # the marked article around it, 0 if there is none
    other: bool  # whether an element around it marks it as something else


class _Open(NamedTuple):
    tag: str
    article: int
    other: bool
    form: bool
    silent: bool  # its text is left out altogether
    link: bool
    heading: bool


_ROOT = _Open("", 0, False, False, False, False, False)
#: A new one of the first ends an open one of the second, unless one of the third lies between.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
}


#: Elements whose content is not read as markup, and where it ends.
_RAW = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in "script style iframe noembed noframes xmp textarea title".split()}
_NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]*)")
_SPACE = re.compile(r"[\s/]*")
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")


class Blocks:
    """Blocks of one page, in order. Reads a page once from start to end, whatever it holds."""

    def __init__(self):
        self.found: list[Block] = []
        self.open: list[_Open] = [_ROOT]
        self.text: list[str] = []
        self.links = self.articles = self.breaks = 0

    def read(self, html: str) -> list[Block]:
        at, size = 0, len(html)
        while at < size:
            sign = html.find("<", at)
            # A sign that begins no markup is text.
            while sign >= 0 and not (html[sign + 1 : sign + 2].isalpha() and html[sign + 1].isascii() or html[sign + 1 : sign + 2] in ("/", "!", "?")):
                sign = html.find("<", sign + 1)
            if sign != at:
                self.characters(unescape(html[at : sign if sign >= 0 else size]))
            if sign < 0:
                break
            at = self.markup(html, sign)
        self.flush()
        return self.found

    def markup(self, html: str, at: int) -> int:
        """Read a tag, comment or declaration; where it ends, which is the page's end if it does not."""
        name = _NAME.match(html, at)
        if not name:
            sign = "-->" if html.startswith("<!--", at) else ">"
            end = html.find(sign, at + 2)
            return end + len(sign) if end >= 0 else len(html)
        tag, given = name[2].lower(), {}
        at = _SPACE.match(html, name.end()).end()
        while at < len(html) and html[at] != ">":
            found = _ATTRIBUTE.match(html, at)
            given.setdefault(found[1].lower(), next((unescape(v) for v in found.groups()[1:] if v is not None), ""))
            at = _SPACE.match(html, found.end()).end()
        if at >= len(html):
            return at
        if name[1]:
            self.ended(tag)
            return at + 1
        self.started(tag, given)
        if tag not in _RAW:
            return at + 1
        end = _RAW[tag].search(html, at)
        return end.start() if end else len(html)

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            now = self.open[-1]
            heading = any(o.heading for o in self.open[-4:])
            self.found.append(Block(text, self.links, heading, now.article, now.other or now.form))
        self.text, self.links, self.breaks = [], 0, 0

    def started(self, tag: str, given: dict[str, str]):
        if tag == "br":
            self.breaks += 1
            if self.breaks > 1:
                self.flush()
            else:
                self.text.append("\n")
            return
        if tag in BLOCKS:
            self.flush()
        if tag in VOID:
            return
        if tag == "p" or tag in HEADINGS or tag in ("div", "ul", "ol", "table", "section", "blockquote", "pre"):
            self._end({"p"}, BLOCKS - {"p"})
        elif tag in _ENDS:
            self._end(*_ENDS[tag])
        if len(self.open) > DEEPEST:
            return
        up = self.open[-1]
        names = f"{given.get('class') or ''} {given.get('id') or ''}"
        article, other, form = up.article, up.other, up.form or tag == "form"
        if tag in ("article", "main") or given.get("role") in ("article", "main") or given.get("itemprop") == "articleBody":
            own = marked(names)
            # An article is a part of its own, unless it lies in a comment, an advert or another article; a form may be around all.
            if not article and not other and not own:
                self.articles += 1
                article, form = self.articles, False
            other = other or own
        elif tag not in ("html", "body"):
            other = other or tag in OTHER or tag == "header" and not article or given.get("role") in ROLES or marked(names)
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or bool(_HIDDEN.search(given.get("style") or ""))
        silent = up.silent or tag in NO_TEXT or hidden
        self.open.append(_Open(tag, article, other, form, silent, up.link or tag == "a", tag in HEADINGS))

    def _end(self, tags, border):
        """Close the innermost open one of ``tags`` that no element of ``border`` encloses."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in tags:
                self.flush()
                del self.open[i:]
                return
            if self.open[i].tag in border:
                return

    def ended(self, tag: str):
        if tag in BLOCKS:
            self.flush()
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            # The end of a phrase does not end a block around it.
            if tag not in BLOCKS and tag not in NO_TEXT and self.open[i].tag in BLOCKS:
                return

    def characters(self, data: str):
        if self.open[-1].silent:
            return
        if not data.isspace():
            self.breaks = 0
        self.text.append(data)
        if self.open[-1].link:
            self.links += len("".join(data.split()))


def blocks_of(html: str) -> list[Block]:
    return Blocks().read(html)


# ---- labels ----------------------------------------------------------------------------------------------------------

GOOD, BAD, OPEN = 1, -1, 0


def stop_share(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def link_share(block: Block) -> float:
    return block.links / max(1, len(block.text) - block.text.count(" "))


def first_pass(block: Block, in_article: bool, by_stop_words: bool = True) -> int:
    """A block's label by itself."""
    if block.other or link_share(block) > (LINKS_IN_ARTICLE if in_article else LINKS):
        return BAD
    if in_article:
        return GOOD if len(block.text) >= SHORT and not block.heading else OPEN
    if "©" in block.text and len(block.text) < LONG:
        return BAD
    if block.heading or len(block.text) < SHORT:
        return OPEN
    if not by_stop_words:
        return GOOD
    stop = stop_share(block.text)
    if stop >= STOP_HIGH or stop >= STOP_LOW and len(block.text) > LONG:
        return GOOD
    return OPEN if stop >= STOP_LOW else BAD


def second_pass(blocks: list[Block], labels: list[int], alone: int) -> list[int]:
    """Undecided blocks inherit; ``alone`` is the label of one that finds no decided block, and what doubt is decided for."""
    decided = [i for i, label in enumerate(labels) if label != OPEN]
    found, after = list(labels), 0
    for i, label in enumerate(labels):
        while after < len(decided) and decided[after] < i:
            after += 1
        if label != OPEN:
            continue
        before = decided[after - 1] if after else None
        following = decided[after] if after < len(decided) else None
        sides = {labels[j] for j in (before, following) if j is not None}
        if len(sides) < 2:
            found[i] = sides.pop() if sides else alone
        elif blocks[i].heading or blocks[i].text.endswith(":"):  # announces what follows
            found[i] = labels[following]
        elif alone == GOOD or i - before == following - i:
            found[i] = alone
        else:
            found[i] = labels[before] if i - before < following - i else labels[following]
    return found


def main_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks that are the page's article."""
    inside = [b for b in blocks if b.article and not b.other]
    by_itself = [first_pass(b, False) == GOOD for b in blocks]
    outside = sum(len(b.text) for b, good in zip(blocks, by_itself) if good and not b.article)
    if sum(len(b.text) for b in inside if link_share(b) <= LINKS_IN_ARTICLE) > outside:
        labels = [first_pass(b, True) for b in inside]
        return [b for b, label in zip(inside, second_pass(inside, labels, GOOD)) if label == GOOD]
    known = any(by_itself)
    # What says itself that it is something else is no neighbour of text.
    rest = [b for b in blocks if not b.other]
    labels = [first_pass(b, False, known) for b in rest]
    return [b for b, label in zip(rest, second_pass(rest, labels, BAD)) if label == GOOD]


def main_text(html: str | None) -> str:
    """Text of a page's article, one block a line."""
    return "\n".join(b.text for b in main_blocks(blocks_of(html or "")))


# ---- the operator ----------------------------------------------------------------------------------------------------


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def extracted(batches):
        for batch in few_rows(batches, 64):
            found = [main_text(html) for html in batch.column("html").to_pylist()]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    narrow = pages.select(F.col("page_id"), F.col("url"), F.col("html"))
    return narrow.mapInArrow(extracted, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of all pages."""
    return extract(table(spark, sf_dir, "pages"))
