"""Main text of web pages by consensus paths of their hosts.

Every container of a page has a path of generalised tags and classes. Each page scores its
containers by the text they hold in paragraphs, less what is in links, and votes for the path of the
best. The votes are summed per host, and every page of the host is read again from the containers on
the winning path; a page that has none of them falls back on its own best.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridweave.llm.common import written

Batches = Iterator[pa.RecordBatch]

# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style noscript template textarea svg math iframe object title".split())
DROPPED = frozenset("nav header footer aside form button select dialog menu head".split()) | RAW
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure"
    " h1 h2 h3 h4 h5 h6 hr html li main ol p pre section summary table tbody td tfoot th thead tr ul"
    .split()
) | frozenset("nav header footer aside form dialog menu".split())
CONTAINERS = frozenset("page article main section div body td html".split())
# Words in class, id or role that mark what is not the article.
UNWANTED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promoted banner"
    " cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup"
    " nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar aside widget"
    " header masthead footer foot copyright legal comment comments disqus reply replies respond"
    " share sharing social related recommended search login form toolbar skip".split()
)
# of these, words that say what the text is and not where it stands: what readers wrote, and notices
_READERS = frozenset("comment comments disqus reply replies respond".split())
_NEVER = _READERS | frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr"
    .split()
)
# words beside `header` that make it the article's own head
_OWN = frozenset("entry post article story".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: what the tag alone says for a container
_WORTH = {"article": 1.5, "main": 1.2}
_CLOSED_BY = {
    "p": BLOCKS, "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]), "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"]),
}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/<>]*+)",
    re.DOTALL,
)
#: what ends a run outside of quoted values; a quote opens a value only after `=`
_SPECIAL = re.compile(r"[<>]|=\s*+([\"'])")
_BRACKET = re.compile(r"[<>]")
_RAW_END = {name: re.compile(rf"(?i)</{name}\s*(?:>|\Z)") for name in RAW}
# whole attributes: what a quoted value holds is no attribute
_ATTRIBUTE = re.compile(
    r"(?<![^\s\"'/])([^\s=\"'<>/]++)\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++))"
)
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


class _Tags:
    """Finds the ends of tags. Every quoted value is searched at most once without success."""

    def __init__(self, source: str):
        self.source = source
        self.broken: set[int] = set()  # opening quotes from which no tag ends
        self.unclosed: dict[str, int] = {}  # per kind, from where on no further quote follows

    def _quoted_end(self, at: int) -> int:
        """Where the tag's `>` lies, read from `at` with quoted values as wholes; -1 if nowhere."""
        passed = []
        while found := _SPECIAL.search(self.source, at):
            quote = found[1]
            if quote is None:
                if found[0] == ">":
                    return found.start()
                break
            opened = found.end() - 1
            if opened in self.broken:
                break
            passed.append(opened)
            if opened >= self.unclosed.get(quote, len(self.source)):
                break
            closed = self.source.find(quote, opened + 1)
            if closed < 0:
                self.unclosed[quote] = opened
                break
            at = closed + 1
        self.broken.update(passed)
        return -1

    def end(self, at: int) -> int | None:
        """Index of the `>` of the tag whose name ends at `at`: outside of quoted values, or else the
        first. The source's size if it is cut off in the tag, None if this is no tag."""
        end = self._quoted_end(at)
        if end >= 0:
            return end
        found = _BRACKET.search(self.source, at)
        if found is None:
            return len(self.source)
        return found.start() if found[0] == ">" else None


class Page:
    """Blocks of text of one page, with the containers each lies in.

    `paths[c]` is the generalised path of container c; `blocks` are (containers, text, in links,
    in a paragraph, marked elements, in a heading). Elements marked by their words are read like
    others; `unwanted` are those that turn out not to be wrappers of the article.
    """

    def __init__(self, source: str):
        self.paths: list[str] = []
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.marks_of: list[tuple[int, ...]] = []  # marked elements a container is or lies in
        self.blocks: list[tuple[tuple[int, ...], str, int, bool, tuple[int, ...], bool]] = []
        # open elements: name, generalised step, dropped, container number, number of the mark
        self.open: list[tuple[str, str, bool, int, int]] = []
        # per marked element its words, the articles it lies in and whether it holds one
        self.marks: list[tuple[set[str], tuple[int, ...], list[bool]]] = []
        self.open_marks: list[int] = []
        self.text: list[str] = []
        self.linked = 0
        self.dropped = 0
        self.links = 0
        self._push("page", "")
        self._read(source)
        self.unwanted = self._unwanted()

    def _flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", entities.unescape("".join(self.text))).strip()
            if text:
                inside = tuple(o[3] for o in self.open if o[3] >= 0)
                prose = any(o[0] in ("p", "blockquote", "pre") for o in self.open)
                marks = tuple(self.open_marks)
                heading = any(o[0] in _HEADINGS for o in self.open)
                self.blocks.append((inside, text, self.linked, prose, marks, heading))
            self.text, self.linked = [], 0

    def _push(self, name: str, attributes: str) -> None:
        marks, words = [], set()
        if "=" in attributes:
            for key, *values in _ATTRIBUTE.findall(attributes):
                if key.lower() not in ("class", "id", "role"):
                    continue
                value = "".join(values).lower()
                for v in value.split():
                    own = _WORDS.findall(v)
                    if not own or own[0] in ("has", "with", "without", "no"):
                        continue
                    if not _OWN.isdisjoint(own) and UNWANTED.intersection(own) == {"header"}:
                        continue
                    words.update(own)
                if key.lower() == "class":
                    marks = sorted({re.sub(r"\d+", "0", v) for v in value.split()})
        dropped = name in DROPPED
        if name == "header" and any(o[0] == "article" for o in self.open):
            dropped = False  # the article's own head
        marked = -1
        if name not in ("body", "html", "main", "article") and not words.isdisjoint(UNWANTED):
            if dropped or self.dropped or not (name in BLOCKS or "-" in name):
                dropped = True
            else:
                self._flush()
                marked = len(self.marks)
                articles = tuple(o[3] for o in self.open if o[0] in ("article", "main"))
                self.marks.append((words & UNWANTED, articles, [False]))
                self.open_marks.append(marked)
        step = ".".join([name, *marks])
        number = -1
        if name in CONTAINERS and not dropped and not self.dropped:
            number = len(self.paths)
            self.paths.append("/".join([o[1] for o in self.open if o[3] >= 0] + [step]))
            self.parents.append(next((o[3] for o in reversed(self.open) if o[3] >= 0), -1))
            self.tags.append(name)
            above = tuple(self.open_marks)
            self.marks_of.append(above)
            if name in ("article", "main") and all(_READERS.isdisjoint(self.marks[m][0]) for m in above):
                for m in above:
                    self.marks[m][2][0] = True
        self.open.append((name, step, dropped, number, marked))
        self.dropped += dropped
        self.links += name == "a"

    def _pop(self) -> None:
        if self.open[-1][4] >= 0:
            self._flush()
            self.open_marks.pop()
        name, _, dropped, _, _ = self.open.pop()
        self.dropped -= dropped
        self.links -= name == "a"

    def _add(self, text: str) -> None:
        if not self.dropped and text:
            self.text.append(text)
            if self.links:
                self.linked += len(text)

    def _read(self, source: str) -> None:
        at, size = 0, len(source)
        tags = _Tags(source)
        while at < size:
            found = _TOKEN.search(source, at)
            if found is None:
                self._add(source[at:])
                break
            ends, name = found[1], found[2]
            end = found.end() - 1 if name is None else tags.end(found.end())
            if end is None:  # no tag, but text
                self._add(source[at : found.end()])
                at = found.end()
                continue
            self._add(source[at : found.start()])
            at = end + 1
            if name is None or end == size:  # comment, declaration or cut-off tag
                continue
            name, attributes = name.lower(), source[found.end() : end]
            if ends:
                self._close(name)
                continue
            if name in BLOCKS:
                self._flush()
            elif name in ("br", "wbr", "td", "th"):
                self._add(" " if name != "wbr" else "")
            for parent, ends in _CLOSED_BY.items():
                if name in ends and any(o[0] == parent for o in self.open[-6:]):
                    self._end_implied(parent, name)
            if name in VOID:
                continue
            if name in RAW:
                end = _RAW_END[name].search(source, at)
                at = end.end() if end else size if name in ("script", "style") else at
                continue
            if not attributes.endswith("/") or name in CONTAINERS:
                self._push(name, attributes)
        self._flush()

    def _end_implied(self, parent: str, name: str) -> None:
        """An open p, li, cell and so on ends where the next begins, unless a container lies between."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == parent:
                self._flush()
                while len(self.open) > i:
                    self._pop()
                return
            if self.open[i][0] in BLOCKS:
                return

    def _close(self, name: str) -> None:
        if name in BLOCKS:
            self._flush()
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == name and i:
                while len(self.open) > i:
                    self._pop()
                return

    def _unwanted(self) -> frozenset[int]:
        """Marked elements without those that hold an article, or most of the page's paragraphs.

        An article elsewhere with paragraphs of its own leaves no doubt: then all others are unwanted.
        """
        if not self.marks:
            return frozenset()
        held, total = [0] * len(self.marks), 0
        told: set[int] = set()  # articles with paragraphs that no marked element holds
        for inside, text, linked, prose, marks, _ in self.blocks:
            if not prose or any(not _NEVER.isdisjoint(self.marks[m][0]) for m in marks):
                continue
            worth = max(len(text) - 2 * linked, 0)
            total += worth
            for m in marks:
                held[m] += worth
            if not marks:
                told.update(c for c in inside if self.tags[c] in ("article", "main"))
        out = set()
        for m, (words, articles, holds) in enumerate(self.marks):
            elsewhere = not told.issubset(articles)
            wrapper = holds[0] and words.isdisjoint(_READERS)
            wrapper = wrapper or 2 * held[m] > total and words.isdisjoint(_NEVER)
            if elsewhere or not wrapper:
                out.add(m)
        return frozenset(out)

    def best(self) -> str | None:
        """The path of the container with the best score; of equal ones the innermost, then the first."""
        score = np.zeros(len(self.paths))
        for inside, text, linked, prose, marks, _ in self.blocks:
            if not self.unwanted.isdisjoint(marks):
                continue
            worth = (len(text) - 2 * linked) * (1.0 if prose else 0.5)
            for depth, c in enumerate(reversed(inside)):
                score[c] += worth * 0.85**depth
        score *= [_WORTH.get(p.rpartition("/")[2].partition(".")[0], 1.0) for p in self.paths]
        if not len(score) or score.max() <= 0:
            return None
        top = score.max()
        return max(
            (p for p, s in zip(self.paths, score, strict=True) if s >= top * (1 - 1e-9)),
            key=lambda p: p.count("/"),
        )

    def on(self, path: str | None) -> str:
        """The blocks inside containers on the path, each once, joined by line ends, and the headings
        and paragraphs beside them.

        Where all containers on the path lie in unwanted elements, the path stands against the marks,
        but not against those of what readers wrote, adverts and notices.
        """
        named = [c for c, p in enumerate(self.paths) if p == path]
        chosen = [c for c in named if self.unwanted.isdisjoint(self.marks_of[c])]
        bad = self.unwanted
        if named and not chosen:
            never = {m for m in bad if not _NEVER.isdisjoint(self.marks[m][0])}
            chosen = [c for c in named if never.isdisjoint(self.marks_of[c])]
            bad = bad.difference(*(self.marks_of[c] for c in chosen))
        inside = set(chosen)
        own = {i for i, b in enumerate(self.blocks) if not inside.isdisjoint(b[0]) and bad.isdisjoint(b[4])}
        if own:
            own |= self._beside(inside, min(own), bad)
        return "\n".join(self.blocks[i][1] for i in sorted(own))

    def _beside(self, inside: set[int], first: int, bad: frozenset[int]) -> set[int]:
        """Headings before the first block and paragraphs right in the parent, going up until a parent
        holds paragraphs in other containers; an article is whole by itself."""
        out: set[int] = set()
        above = {self.parents[c] for c in inside}
        if len(above) != 1 or any(self.tags[c] in ("article", "main") for c in inside):
            return out
        chain, parent = [], above.pop()
        while parent >= 0 and self.tags[parent] not in ("page", "html"):
            chain.append(parent)
            if self.tags[parent] in ("article", "main"):
                break
            parent = self.parents[parent]
        at = {c: level for level, c in enumerate(chain)}
        good: list[list[int]] = [[] for _ in chain]
        end = len(chain)
        for i, (within, text, linked, prose, marks, heading) in enumerate(self.blocks):
            if 3 * linked > len(text) or not inside.isdisjoint(within) or not bad.isdisjoint(marks):
                continue
            level = next((at[c] for c in reversed(within) if c in at), end)
            if level >= end:
                continue
            if prose and within[-1] != chain[level]:
                end = level
            elif prose or heading and i < first:
                good[level].append(i)
        return out.union(*good[:end])

    def main_text(self, path: str | None) -> str:
        got = self.on(path) if path else ""
        if not got:
            got = self.on(self.best())
        return got or "\n".join(b[1] for b in self.blocks if self.unwanted.isdisjoint(b[4]))


def _votes(batches: Batches) -> Batches:
    for batch in batches:
        best = [Page(h).best() if h else None for h in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["host"], pa.array(best, pa.string())], ["host", "path"])


def _extract(batches: Batches) -> Batches:
    for batch in batches:
        texts = [
            Page(h).main_text(p) if h else ""
            for h, p in zip(batch["html"].to_pylist(), batch["path"].to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string())], ["page_id", "url", "text"]
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """host, path: the path with most votes of each host; of equal ones the first by name."""
    votes = (
        pages.select("host", "html")
        .mapInArrow(_votes, "host string, path string")
        .filter("path is not null")
        .groupBy("host", "path")
        .count()
    )
    order = Window.partitionBy("host").orderBy(F.desc("count"), "path")
    return votes.withColumn("turn", F.row_number().over(order)).filter("turn = 1").select("host", "path")


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row: the article's blocks joined by line ends.

    A block is the text of a block element with character references decoded and white space turned
    into one space; a line break is white space. Left out are menus, headers, footers, sidebars,
    forms, scripts, styles, and elements whose class, id or role says notice, advert, comment and
    the like, unless they wrap the article. Headings and paragraphs beside the winning container
    belong to it. A null or empty html gives an empty text; pages with no host share one set of votes.
    Cut-off pages are read as far as they go.
    Repeated rows get a row each; other columns are ignored.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "://([^/?#]*)", 1))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.col("html"), host.alias("host")
    )
    # written, so that its exact size tells Spark whether the pages need a shuffle to meet it
    paths = written(host_paths(rows), "paths")
    texts = (
        rows.join(paths, "host", "left")
        .select("page_id", "url", "html", "path")
        .mapInArrow(_extract, "page_id long, url string, text string")
    )
    return texts.withColumn("n_chars", F.length("text").cast("long"))
