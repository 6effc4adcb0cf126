"""Main text of web pages by two-pass block rules.

The page is cut into blocks at block tags; what stands in scripts, styles, menus, headers, footers,
sidebars, notices, adverts and comments is left out by its tag, role or class name. The first pass
judges every other block by its length, link density and share of stop words: good, bad, or too
short to say. The second pass gives ambiguous blocks the label of the nearest decided blocks before
and after them: the label of both, or that of the nearer where they differ. Where a page marks its
article the same rules judge, with a lower bar within it and a higher one beside it.

Class names tell of layout as well as of content, and some pages are one form. So an element that
its name or a form makes suspect is let off if all that the page marks as article stands in it with
more than half of the text, or nearly all text where nothing is marked; readers' comments never are.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from matchloom.llm.common import quoted
from matchloom.session import ship

# fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = frozenset(
    """a an and are as at be been but by can could did do for from had has have he her his i if in into is it its more no not of on or our she so
    than that the their them then there these they this to up was we were what when which who will with would you your
    aber als am auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich ihr im ist mit nach
    nicht noch nur oder sein sich sie sind über um und uns unter vom von vor war wie wir zu zum zur
    au aux avec ce ces dans de du elle en est et il ils je la le les leur lui mais ne nous ont ou par pas plus pour que qui sa se ses son sont sur une un vous
    al como con del el ella entre era este esta fue hay las lo los más muy o para pero por porque sin sobre su sus también tiene una uno y ya""".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
SKIPPED = frozenset("head title script style noscript template iframe object embed svg math canvas audio video button select label textarea input option nav header footer aside menu dialog noframes map".split())
#: elements whose content is no markup up to their own end tag
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: signs that do the work of stop words where words are not parted
SIGNS = frozenset("的了是在和有不我他这の は が を に で と た し も な だ の".replace(" ", ""))
#: class names that say what is not there
WITHOUT = re.compile(r"\b(?:no|without|hide|hidden|has|with)-[\w-]+", re.I)
#: words in class, id and role that name no article
JUNK = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|banner|breadcrumbs?|captcha|comments?|commentlist|consent|cookies?|disclaimer|disqus|footer|foot|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|notification|overlay|pager|pagination|paywall|popup|privacy|promo|promoted|related|recommended|replies|reply|respond|search|share|sharing|sidebar|sidebars?|skip|social|sponsor|sponsored|subscribe|subscription|tags|toolbar|tooltip|widgets?|alert|toast|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
#: those of readers' comments, which may well be longer than the article
SAID = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|reply|respond)(?:$|[\s_-])", re.I)
#: of elements within a line, only names of adverts count
INLINE = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|adsbygoogle|sponsored)(?:$|[\s_-])", re.I)
#: how much of the page's text an element holds that is let off
HALF, NEARLY_ALL = 0.5, 0.8
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
ARTICLE = re.compile(r"(?:^|\s)(?:article|articlebody|article-body|article-content|entry-content|post-content|post-body|main-content|story-body)(?:$|\s)", re.I)
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</?([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
LOOSE = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)")
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: an empty element in the older way; a value without quotes may end in / too
ENDED = re.compile(r"(?:^|[\s\"'])/\s*$")
SPACES = re.compile(r"\s+")
WORD = re.compile(r"[぀-ヿ㐀-鿿]|[^\W\d_]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: least length of a block that decides, most link density, and share of stop words of good and of bad blocks
LONG, LINKED, STOPPED, FEW = 60, 0.4, 0.2, 0.1
#: how often a page has a word of up to so many letters that counts as one of its own stop words
OWN, SHORT = 4, 4


@dataclass
class Block:
    text: str
    linked: int
    in_article: bool
    heading: bool
    suspects: tuple[int, ...] = ()


#: what an element's markup says: nothing, suspect, or out for good
FINE, SUSPECT, OUT = range(3)


def _judge(name: str, attributes: dict[str, str], in_code: bool) -> int:
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return OUT
    if name in ("html", "body", "article", "main"):
        return FINE
    if name == "form":
        return SUSPECT
    named = WITHOUT.sub(" ", " ".join(CAMEL.sub("-", attributes.get(k, "")) for k in ("class", "id", "role")))
    if not named.strip() or in_code:
        return FINE
    if name not in BLOCKS:
        return OUT if INLINE.search(named) else FINE
    return OUT if SAID.search(named) else SUSPECT if JUNK.search(named) else FINE


class _Open:
    """The tags that are open. Each is put on and taken off once, so a page costs as much as it is long."""

    def __init__(self) -> None:
        self.tags: list[tuple[str, int, bool]] = []  # name, verdict, article
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.suspects: list[int] = []  # numbers of the open ones
        self.out = self.article = self.anchors = self.headings = self.code = self.numbered = 0

    def _count(self, name: str, verdict: int, is_article: bool, by: int) -> None:
        self.out += by * (verdict == OUT)
        self.article += by * is_article
        self.anchors += by * (name == "a")
        self.headings += by * (name in HEADINGS)
        self.code += by * (name in ("code", "pre"))

    def push(self, name: str, verdict: int, is_article: bool) -> None:
        self.places.setdefault(name, []).append(len(self.tags))
        if name in BLOCKS:
            self.blocks.append(len(self.tags))
        if verdict == SUSPECT:
            self.suspects.append(self.numbered)
            self.numbered += 1
        self.tags.append((name, verdict, is_article))
        self._count(name, verdict, is_article, 1)

    def close(self, name: str) -> None:
        """End the last open tag of this name and all within it; without one, nothing."""
        if not self.places.get(name):
            return
        place = self.places[name][-1]
        while len(self.tags) > place:
            tag = self.tags.pop()
            self.places[tag[0]].pop()
            if tag[0] in BLOCKS:
                self.blocks.pop()
            if tag[1] == SUSPECT:
                self.suspects.pop()
            self._count(*tag, -1)

    def start_block(self) -> None:
        """A block tag ends the paragraph it stands in."""
        if self.blocks and self.tags[self.blocks[-1]][0] == "p":
            self.close("p")


def blocks(page: str) -> list[Block]:
    """The page's blocks outside of what its markup says to be no article, in page order."""
    return _let_off(_blocks(page))


def _let_off(found: list[Block]) -> list[Block]:
    """Blocks without suspects around them but such as hold what the page is about."""
    held: Counter = Counter()
    marked: Counter = Counter()
    for b in found:
        held.update({k: len(b.text) for k in b.suspects})
        marked.update(b.suspects if b.in_article else ())
    if not held:
        return found
    of = sum(len(b.text) for b in found)
    articles = sum(b.in_article for b in found)
    free = {k for k, n in held.items() if (marked[k] == articles and n > HALF * of if articles else n > NEARLY_ALL * of)}
    return [b for b in found if free.issuperset(b.suspects)]


def _blocks(page: str) -> list[Block]:
    out: list[Block] = []
    now = _Open()
    parts: list[str] = []
    links: list[str] = []

    def flush() -> None:
        if parts:
            text = SPACES.sub(" ", html.unescape("".join(parts))).strip()
            if text:
                linked = len(SPACES.sub(" ", html.unescape("".join(links))).strip())
                out.append(Block(text, linked, now.article > 0, now.headings > 0, tuple(now.suspects)))
            parts.clear()
            links.clear()

    def say(text: str) -> None:
        if not now.out and text:
            parts.append(text)
            if now.anchors:
                links.append(text)

    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        say(page[at:lt])
        m = TAG.match(page, lt) or LOOSE.match(page, lt)
        if not m:
            say("<")
            at = lt + 1
            continue
        at = m.end()
        name = (m[1] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            flush()
        if name == "br":
            say(" ")
        if page[lt + 1] == "/":
            now.close(name)
            continue
        if name in VOID or m[2] and ENDED.search(m[2]) and name not in BLOCKS:
            continue
        attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(m[2] or "")}
        if name in BLOCKS:
            now.start_block()
        is_article = name in ("article", "main") or attributes.get("itemprop") == "articleBody" or bool(ARTICLE.search(attributes.get("class", "") + " " + attributes.get("id", "")))
        # within an article its own header and class names still count, but its heading is text
        skipped = name in SKIPPED and not (name == "header" and now.article)
        verdict = OUT if skipped else _judge(name, attributes, now.code > 0)
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.end() if end else size
            continue
        now.push(name, verdict, is_article)
    flush()
    return out


def stop_share(words: list[str], own: frozenset[str] = frozenset()) -> float:
    """The share of stop words, known ones and the page's own."""
    return sum(w in STOP_WORDS or w in SIGNS or w in own for w in words) / max(1, len(words))


def first_pass(b: Block, own: frozenset[str], marked: bool) -> str:
    """good, bad, near (long, but of few stop words; without any links it may have none) or short.

    In a marked article a block needs half the length and stop words; beside one, twice the length.
    """
    words = WORD.findall(b.text.lower())
    if b.linked > LINKED * len(b.text):
        return "bad"
    bar = 0.5 if b.in_article else 2.0 if marked else 1.0
    wide = 2 if SIGNS.intersection(b.text) else 1  # a sign that is a word takes the room of some letters
    if b.heading or wide * len(b.text) < bar * LONG:
        return "short" if b.heading or not b.linked else "bad"
    share = stop_share(words, own)
    if share >= min(bar, 1.0) * STOPPED:
        return "good"
    return "near" if share >= min(bar, 1.0) * FEW or not b.linked and bar <= 1 else "bad"


def second_pass(found: list[Block], labels: list[str]) -> list[str]:
    """Labels in which every block is good or bad."""
    before, after, last = [], [None] * len(labels), None
    for k, label in enumerate(labels):
        before.append(last)
        last = k if label in ("good", "bad") else last
    last = None
    for k in range(len(labels) - 1, -1, -1):
        after[k] = last
        last = k if labels[k] in ("good", "bad") else last
    out = []
    for k, (b, label) in enumerate(zip(found, labels)):
        if label in ("short", "near"):
            sides = {labels[d] for d in (before[k], after[k]) if d is not None}
            if not sides:  # nothing on the page says more
                label = "good" if label == "near" or b.in_article else "bad"
            elif b.heading and after[k] is not None:  # a heading belongs to what it stands over
                label = labels[after[k]]
            elif len(sides) == 1:
                label = sides.pop()
            else:
                label = labels[before[k] if k - before[k] <= after[k] - k else after[k]]
        out.append(label)
    return out


def keep(found: list[Block]) -> list[Block]:
    """The blocks that are main text."""
    marked = any(b.in_article for b in found)
    counts = Counter(w for b in found for w in WORD.findall(b.text.lower()) if len(w) <= SHORT)
    own = frozenset(w for w, n in counts.items() if n >= OWN)
    return [b for b, label in zip(found, second_pass(found, [first_pass(b, own, marked) for b in found])) if label == "good"]


def main_text(page: str | None) -> str:
    """The page's main text, a block a line; '' for null, empty pages and pages without any."""
    return "\n".join(b.text for b in keep(blocks(page or "")))


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """pages without ``column`` but with text and n_chars, its code points.

    Every row stays. Other columns stay, but for those named text and n_chars, which are replaced.
    Null and empty pages have the text ''. A page is read as a whole, however long. Broken markup
    is read as far as it goes. An empty table gives an empty result.
    """
    ship(pages.sparkSession)
    names = [c for c in pages.columns if c.lower() not in (column.lower(), "text", "n_chars")]
    schema = StructType([*[pages.schema[n] for n in names], StructField("text", StringType()), StructField("n_chars", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(len(names)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=[*names, "text", "n_chars"])

    return pages.select(*quoted(*names), F.col(column)).mapInArrow(run, schema)
