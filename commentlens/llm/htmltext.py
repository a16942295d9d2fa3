"""Main text of web pages, by block rules in two passes.

The first pass cuts a page into blocks and decides those that are clear by
link density, length and stop-word density; blocks of menus, forms, notices,
comments and the like are never candidates. In the second pass each undecided
block takes the label of its nearest decided neighbour.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from commentlens.llm.shared import small_batches

SHORT_WORDS = 10
LONG_WORDS = 25
MOST_LINKS = 0.5
STOP_SHARE = 0.25
FEW_STOPS = 0.05

# Frequent function words of the languages served.
STOP_WORDS = frozenset(
    (
        "the of and to in a is that for it was on are as with at by be this from or an not have "
        "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch "
        "de la le les et des en un une du que est pour dans par sur pas qui au plus avec "
        "de la que el en y los del se las por un para con no una su al lo como"
    ).split()
)
# Elements whose content is no text of the page.
RAW = ("script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "select", "title", "head")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("nav footer aside form menu dialog button fieldset".split())
MAIN = frozenset("article main".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SKIP_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
SKIP_NAMES = frozenset(
    "ad ads advert adverts advertisement banner promo promotion sponsor sponsored cookie cookies consent notice notification "
    "alert popup modal overlay newsletter subscribe subscription signup share sharing social related recommended sidebar widget "
    "menu nav navbar navigation breadcrumb breadcrumbs pagination pager footer comment comments reply replies respond disqus "
    "login search toolbar masthead".split()
)

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_PIECE = re.compile(
    r"<!--(?:.*?-->|.*)|<(?P<close>/?)(?P<name>[A-Za-z][A-Za-z0-9:-]*)(?P<rest>(?:[^<>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}


@dataclass
class Block:
    text: str
    linked: int
    main: bool


@dataclass
class _Cutter:
    """Blocks of a page as its pieces come."""

    blocks: list[Block] = field(default_factory=list)
    open: list[tuple[str, bool, bool]] = field(default_factory=list)  # name, skipped, main
    parts: list[tuple[str, bool]] = field(default_factory=list)
    link: int = 0

    def end(self) -> None:
        """Close the block under way."""
        if self.parts:
            words = _SPACE.sub(" ", "".join(t for t, _ in self.parts)).strip(" ")
            if words:
                linked = sum(len(_SPACE.sub("", t)) for t, in_link in self.parts if in_link)
                self.blocks.append(Block(words, linked, self.main))
        self.parts, self.link = [], 0

    @property
    def skipped(self) -> bool:
        return bool(self.open) and self.open[-1][1]

    @property
    def main(self) -> bool:
        return bool(self.open) and self.open[-1][2]

    def text(self, piece: str) -> None:
        if not self.skipped:
            self.parts.append((html.unescape(piece), self.link > 0))

    def start(self, name: str, rest: str) -> None:
        if name == "a":
            self.link = 1
        if name == "br":
            self.text(" ")
        if name not in BLOCKS:
            return
        self.end()
        if self.open and self.open[-1][0] == "p":
            self.open.pop()
        if name not in VOID and not rest.endswith("/"):
            self.open.append((name, self.skipped or self._unwanted(name, rest), self.main or name in MAIN or 'role="main"' in rest))

    def stop(self, name: str) -> None:
        if name == "a":
            self.link = 0
        if name in BLOCKS:
            self.end()
            for k in range(len(self.open) - 1, -1, -1):
                if self.open[k][0] == name:
                    del self.open[k:]
                    break

    def _unwanted(self, name: str, rest: str) -> bool:
        if name in SKIPPED or name == "header" and not self.main:
            return True
        if name in ("html", "body", *MAIN):
            return False
        for key, value in _ATTRIBUTE.findall(rest):
            names = set(re.split(r"[\s_-]+", value.strip("\"'").lower()))
            if names & (SKIP_ROLES if key.lower() == "role" else SKIP_NAMES) or "header" in names and not self.main:
                return True
        return False


def cut(page: str | None) -> list[Block]:
    """Candidate blocks of a whole page, in its order."""
    cutter, at, page = _Cutter(), 0, page or ""
    while at < len(page):
        piece = _PIECE.match(page, at)
        at = piece.end()
        name = (piece["name"] or "").lower()
        if not name:
            if page[piece.start()] != "<" or piece.group() == "<":
                cutter.text(piece.group())
        elif piece["close"]:
            cutter.stop(name)
        elif name in _RAW_END:
            if not piece["rest"].endswith("/"):
                found = _RAW_END[name].search(page, at)
                at = found.end() if found else len(page)
        else:
            cutter.start(name, piece["rest"])
    cutter.end()
    return cutter.blocks


def first_label(block: Block) -> bool | None:
    """Whether a block is text, or None while only its neighbours can tell."""
    words = block.text.split(" ")
    letters = sum(map(len, words))
    if block.linked > MOST_LINKS * letters:
        return False
    stops = sum(w.strip(".,;:!?\"'()").lower() in STOP_WORDS for w in words) / len(words)
    if len(words) >= SHORT_WORDS and stops >= STOP_SHARE:
        return True
    if len(words) >= LONG_WORDS and stops < FEW_STOPS and not block.main:
        return False
    return None


def spread_labels(labels: list[bool | None], otherwise: bool) -> list[bool]:
    """Each undecided label from the nearest decided one, text first at equal distance."""
    decided = [i for i, label in enumerate(labels) if label is not None]
    if not decided:
        return [otherwise] * len(labels)
    found, k = [], 0
    for i, label in enumerate(labels):
        while k + 1 < len(decided) and decided[k + 1] <= i:
            k += 1
        near = decided[k : k + 2]
        found.append(label if label is not None else max((-abs(j - i), labels[j]) for j in near)[1])
    return found


def main_text(page: str | None) -> str:
    """Main text of a whole page; empty if none.

    Where the page marks an article, only its blocks can be text. If no block
    passes, as in a language without known stop words, all but lists of links do.
    """
    blocks = cut(page)
    inside = [b for b in blocks if b.main]
    blocks = inside or blocks
    labels = spread_labels([first_label(b) for b in blocks], otherwise=True)
    if not any(labels):
        labels = [b.linked <= MOST_LINKS * len(b.text.replace(" ", "")) for b in blocks]
    return "\n".join(b.text for b, label in zip(blocks, labels, strict=True) if label)


def extract(pages: DataFrame, page: str = "html", text: str = "text", length: str = "n_chars") -> DataFrame:
    """The pages with ``text`` and ``n_chars`` in place of their html.

    Each page is read where it lies, in one pass without a shuffle. Null and
    empty pages give an empty text; tags and quotes left open, stray brackets
    and any length are read as far as they go. Repeated rows give equal rows,
    and columns that have the new names are replaced.
    """
    small_batches(pages.sparkSession)
    kept = [c for c in pages.columns if c not in (page, text, length)]
    schema = pages.select(*kept, page).withColumnRenamed(page, text).schema
    schema = schema.add(length, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v) for v in batch.column(page).to_pylist()]
            columns = [batch.column(c) for c in kept] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, text, length])

    return pages.select(*kept, page).mapInArrow(run, schema)
