"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides on each block by itself: share of its text in links,
length and density of stop words; what the page marks as navigation, header, footer, sidebar, notice, advert, form, script,
or readers' comments is out at once, and inside an element that the page declares to be its article a length suffices.
Short blocks and those of middling density stay open. The second pass gives an open block the label of its nearest decided
neighbours; headings go with what follows them.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Collection
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    "a about all also an and any are as at be been but by can could do for from had has have he her his i if in into is it "
    "its more my no not of on one or our out she so than that the their them then there they this to up was we were what when "
    "which who will with would you your "
    "aber als am auch auf aus bei bin bis das dass dem den der des die du durch ein eine einem einen einer er es für hat ich "
    "im ist mit nach nicht noch nur oder sich sie sind so über und uns von vor war wenn werden wie wir wird zu zum zur "
    "au aux avec ce ces cette dans de du elle en est et il ils je la le les leur lui mais ne nous ou par pas pour qu que qui "
    "sa se ses son sont sur un une vous "
    "al como con del ella era esta este fue hay las lo los más me muy o para pero por ser si sin sobre su sus también una y ya"
    .split()
)

# Names of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul".split()
)
HOLDERS = frozenset(("article", "div", "main", "section", "td"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
HEAD_ONLY = frozenset("meta link title script style base noscript template".split())
#: Never part of a text, whatever is inside.
NEVER = frozenset(
    "aside audio button canvas datalist dialog head noscript object script select style svg template textarea title video "
    "xmp noembed noframes iframe".split()
)
#: Not part of a text, but an article inside still counts: pages forget end tags, or wrap everything in a form.
APART = frozenset("footer form header menu nav".split())
#: An open element of the second name ends where one of the first begins, unless the third lies between.
ENDS = {
    "li": (("li",), ("ul", "ol", "menu")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}

# Words in class names, ids and roles by which pages mark what is not their text.
READERS = re.compile(r"comments?|commentlist|disqus|respond|repl(?:y|ies)|discussion|responses?")
BESIDE = re.compile(r"aside|sidebars?|complementary|related|recommend(?:ed|ations?)?|teasers?|widgets?")
AROUND = re.compile(
    r"ads?|ad(?:box|slot|unit|sense)|advert(?:s|ising|isements?)?|sponsor(?:ed|s)?|promo(?:s|tions?|ted)?|banners?|cookies?|"
    r"consent|gdpr|notices?|announcements?|alerts?|alertdialog|dialog|popups?|modal|overlay|paywall|menus?|menubar|"
    r"(?:side|top|main|sub)?nav(?:bar|igation)?|breadcrumbs?|pagination|pager|footer|contentinfo|masthead|topbar|toolbar|"
    r"share|sharing|social|newsletter|subscribe|subscription|signup|login|search|form|copyright|disclaimer|skip"
)
HEADER = re.compile(r"header")
OWN = re.compile(r"article|entry|post|story|section|content|has|with|no")
BODY = re.compile(r"(?:(?:main|article|post|entry|story|page|blog)[-_]?)?(?:content|body|text|article|main|post|entry|story)", re.I)

TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)"
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)(?:>|\Z)""",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LETTERS = re.compile(r"[^\W\d_]+")
_RAW_END = {name: re.compile(rf"</{name}[\s/>]", re.I) for name in RAW}

#: Ranks of what a page declares to be its text.
LOOSE, MAIN, ARTICLE = 1, 2, 3


@dataclass(frozen=True)
class Rules:
    short: int = 80            # characters below which a block is not decided by itself
    long: int = 200            # characters from which a lower density suffices
    dense: float = 0.2         # share of stop words that decides for a block
    thin: float = 0.1          # share below which it is decided against
    linked: float = 0.33       # share of linked text that decides against a block
    linked_inside: float = 0.5   # the same inside what the page declares to be its text
    stop_words: frozenset[str] = STOP_WORDS


class Block(NamedTuple):
    text: str
    linked: int       # characters inside links
    heading: bool
    rank: int         # of the declaration around it, 0: none


class _Open(NamedTuple):
    name: str
    out: int          # 0: text, 1: out unless an article begins, 2: out
    rank: int
    titles: bool      # header of an article: only its headings count
    link: bool


def _marks(attributes: str, name: str, rank: int, code: bool) -> tuple[int, int]:
    """(out, rank) that an element's attributes ask for; class names within program code mean something else."""
    out = own = 0
    for key, double, single, bare in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), double or single or bare
        if key in ("class", "id", "role"):
            for token in () if code or name in ("html", "body") else value.split():
                words = [w.lower() for w in WORD.findall(token)]
                if key != "role" and BODY.fullmatch(token):
                    own = max(own, LOOSE if name in HOLDERS else 0)
                    continue
                if key == "role" and token.lower() in ("main", "article"):
                    own = max(own, MAIN if token.lower() == "main" else ARTICLE)
                    continue
                if not {"has", "with", "no", "without"}.isdisjoint(words):
                    continue
                for word in words:
                    if READERS.fullmatch(word) or BESIDE.fullmatch(word):
                        out = 2
                    elif AROUND.fullmatch(word):
                        out = max(out, 1)
                    elif HEADER.fullmatch(word) and not rank and not any(OWN.fullmatch(w) for w in words):
                        out = max(out, 1)
                if key == "role" and token.lower() == "banner":
                    out = max(out, 1)
        elif key == "itemprop" and value.lower() == "articlebody":
            own = ARTICLE
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            out = 2
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            out = 2
    return out, own


def blocks_of(page: str) -> list[Block]:
    """The blocks that are not marked as something else, in page order."""
    found: list[Block] = []
    stack = [_Open("", 0, 0, False, False)]
    parts: list[str] = []
    linked, breaks = 0, 0
    open_names: Counter[str] = Counter()

    def flush() -> None:
        nonlocal parts, linked, breaks
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                found.append(Block(text, linked, any(open_names[h] for h in HEADINGS), stack[-1].rank))
            parts, linked = [], 0
        breaks = 0

    def close(names: Collection[str], fence: Collection[str] = ()) -> bool:
        """Ends the innermost open element of these names, and all inside it, unless a fence lies between."""
        if not any(open_names[name] for name in names):
            return False
        at = len(stack) - 1
        while stack[at].name not in names:
            if stack[at].name in fence:
                return False
            at -= 1
        if any(e.name in BLOCK for e in stack[at:]):
            flush()
        open_names.subtract(e.name for e in stack[at:])
        del stack[at:]
        return True

    def add(chunk: str) -> None:
        nonlocal linked, breaks
        top = stack[-1]
        if top.out or not chunk:
            return
        text = references.unescape(chunk) if "&" in chunk else chunk
        parts.append(text)
        bare = text.strip()
        if bare:
            breaks = 0
            if top.link:
                linked += len(bare)

    at = 0
    while match := TAG.search(page, at):
        if match.start() > at:
            add(page[at : match.start()])
        at = match.end()
        end, name, attributes = match.groups()
        if name is None:
            continue
        name = name.lower()
        if end:
            if not close((name,)) and name in BLOCK:
                flush()
            continue
        if name not in HEAD_ONLY and open_names["head"]:
            close(("head",))
        if name == "br":
            add(" ")
            breaks += 1
            if breaks > 1:
                flush()
            continue
        if name in BLOCK:
            flush()
            close(("p",), BLOCK - {"p"})
        if name in ENDS:
            while close(*ENDS[name]) and name == "tr":
                pass
        elif name == "a":
            close(("a",))
        if name in VOID:
            continue
        parent = stack[-1]
        code = bool(open_names["pre"] or open_names["code"])
        marked, own = _marks(attributes, name, parent.rank, code) if attributes else (0, 0)
        if name == "article":
            own = ARTICLE
        elif name == "main":
            own = max(own, MAIN)
        out, rank, titles = parent.out, max(parent.rank, own), parent.titles
        if name in NEVER or out == 2 or marked == 2 and name != "main":
            out = 2
        elif own >= MAIN and not (marked and name != "main"):
            if out:
                out, rank = 0, own
            titles = False
        elif name == "header" and parent.rank and not out:
            out, titles = 1, True
        elif name in HEADINGS and titles and out == 1:
            out = 0
        elif name in APART or marked:
            out = 1
            titles = False
        if not attributes.endswith("/") or name not in ("svg", "path"):
            stack.append(_Open(name, out, rank, titles, parent.link or name == "a"))
            open_names[name] += 1
        if name in RAW:
            ending = _RAW_END[name].search(page, at)
            at = ending.start() if ending else len(page)
    add(page[at:])
    flush()
    return found


def _first(block: Block, declared: bool, rules: Rules) -> bool | None:
    """Whether a block is text; None: open."""
    size = len(block.text)
    share = block.linked / size
    if declared:
        if share > rules.linked_inside:
            return False
        return True if size >= rules.short else None
    if share > rules.linked or "©" in block.text:
        return False
    if size < rules.short:
        return False if block.linked else None
    words = LETTERS.findall(block.text.lower())
    density = sum(w in rules.stop_words for w in words) / len(words) if words else 0.0
    if density < rules.thin:
        return False
    return True if size >= rules.long or density >= rules.dense else None


def labels(blocks: list[Block], rules: Rules = Rules()) -> list[bool]:
    """Which blocks are text: first pass, then the open ones by their neighbours."""
    free: dict[int, bool | None] = {}

    def undeclared(i: int) -> bool | None:
        if i not in free:
            free[i] = _first(blocks[i], False, rules)
        return free[i]

    n, ranks = len(blocks), {b.rank for b in blocks if b.rank}
    level = 0
    for rank in sorted(ranks, reverse=True):
        inside = sum(len(b.text) for b in blocks if b.rank == rank)
        outside = sum(len(b.text) for i, b in enumerate(blocks) if b.rank < rank and undeclared(i))
        # A declaration that holds far less text than lies beside it is that of a teaser.
        if 3 * inside >= outside:
            level = rank
            break
    declared = [bool(level) and b.rank == level for b in blocks]
    # Beside a declared text only other declarations can hold more of it, and a title that stands right before it.
    title = [b.heading and i + 1 < n and declared[i + 1] for i, b in enumerate(blocks)]
    first = [
        _first(b, True, rules) if declared[i] else undeclared(i) if b.rank or not level else None if title[i] else False
        for i, b in enumerate(blocks)
    ]
    before: list[tuple[bool, int] | None] = [None] * n      # nearest decided block, and how far away
    after: list[tuple[bool, int] | None] = [None] * n
    for order, step, table in ((range(n), -1, before), (range(n - 1, -1, -1), 1, after)):
        for i in order:
            k = i + step
            if declared[i] and not (0 <= k < n and declared[k]):
                table[i] = (True, 1)                        # the edge of what the page declares
            elif 0 <= k < n:
                if first[k] is not None:
                    table[i] = (first[k], 1)
                elif table[k] is not None:
                    table[i] = (table[k][0], table[k][1] + 1)
    out = []
    for i, known in enumerate(first):
        if known is None:
            near = [x for x in (before[i], after[i]) if x is not None]
            if not near or all(x[0] for x in near):
                known = True
            elif not any(x[0] for x in near):
                known = False
            elif declared[i]:
                known = True
            elif blocks[i].heading:
                known = after[i][0]
            else:
                known = before[i][0] if before[i][1] < after[i][1] else after[i][0] if after[i][1] < before[i][1] else False
        out.append(known)
    return out


def main_text(page: str | None, rules: Rules = Rules()) -> str:
    """The text of one page, its blocks joined by line ends."""
    blocks = blocks_of(page or "")
    return "\n".join(b.text for b, kept in zip(blocks, labels(blocks, rules)) if kept)


def extract(
    pages: DataFrame, id_column: str = "page_id", html: str = "html", url: str = "url", rules: Rules = Rules()
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row.

    ``text`` holds the blocks of the main text in page order, each on a line of its own, with character references decoded
    and runs of white space (line breaks and no-break spaces included) made one space; a null or empty page, and one without
    text, has an empty one. One ``br`` is white space, two in a row part blocks. Ids and urls may be null or recur; every
    row is judged by itself, other columns are not read. No row moves between tasks, and memory follows the longest page.
    """

    def run(batches):
        for batch in batches:
            texts = [main_text(page.as_py(), rules) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema[id_column].dataType.simpleString()
    found = pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")).mapInArrow(
        run, f"page_id {kind}, url string, text string"
    )
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
