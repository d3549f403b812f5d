"""Spelling variants: frequent words grouped by one-error search in bidirectional FM-indexes.

An index holds a part of the vocabulary as one text of words between delimiters, with suffix ranks of
the text and of its reverse. An interval of ranks stands for all places where a string occurs. The
one direction lengthens strings to the left, the other to the right, by one binary search per letter.

A word with at most one error has its first half or its second half free of errors. So two searches
find all near words: delimiter and first half exactly, then to the right over the second half with
one error allowed; or second half and delimiter exactly, then to the left. A whole word between
delimiters is one suffix, whose rank names it. Letters are only tried that occur in the interval.

Index and searches are spread over shards. Words that share an exact half of the lengths in question
lie in one shard, so a word searches two shards. A shard that is too large, as one of a very common
half, is dealt in pieces by a hash of the word, and its searches go to all of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridweave.llm.common import written
from gridweave.llm.vectors import by_shard

Batches = Iterator[pa.RecordBatch]

_RUN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++")
_ASCII_RUN = re.compile(rb"[a-z]++")
_CUT = re.compile(rb"[\x00-\x60\x7b-\x7f]")  # a byte that no run holds
SLICE = 1 << 20  # bytes of a text whose words are counted at a time
HELD = 200_000  # words a task counts before it sends them
HELD_BYTES = 1 << 24
SHARD = 1 << 19  # code points of a shard's words
SEARCHED = 1 << 19  # code points of the words searched at a time


def _slices(text: bytes) -> Iterator[bytes]:
    """A text in parts that no run crosses."""
    lo = 0
    while len(text) - lo > SLICE:
        cut = _CUT.search(text, lo + SLICE)
        if cut is None:
            break
        yield text[lo : cut.start()]
        lo = cut.start()
    yield text[lo:]


def without(word: bytes, at: int) -> bytes:
    """A word without one of its code points."""
    if word.isascii():
        return word[:at] + word[at + 1 :]
    text = word.decode()
    return (text[:at] + text[at + 1 :]).encode()


def _length(word: bytes) -> int:
    return len(word) - word.count(b"\xc3")


def _counts(drop: int) -> Callable[[Batches], Batches]:
    """Words and how often a task met them; one of every `drop` runs of a document loses a letter."""

    def rows(total: Counter[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array(list(total.keys()), pa.binary()).cast(pa.string()),
                pa.array(list(total.values()), pa.int64()),
            ],
            ["word", "n"],
        )

    def run(batches: Batches) -> Batches:
        total: Counter[bytes] = Counter()
        size = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                text = text.as_py()
                if not text:
                    continue
                doc_id = doc_id.as_py()
                start = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
                for part in _slices(text.lower()):
                    found = Counter((_ASCII_RUN if part.isascii() else _RUN).findall(part))
                    for word, n in found.items():
                        h = zlib.crc32(word, start)
                        if h % drop == 0:
                            word = without(word, h % _length(word))
                        if word not in total:
                            size += len(word)
                        total[word] += n
                    if len(total) > HELD or size > HELD_BYTES:
                        yield rows(total)
                        total, size = Counter(), 0
        if total:
            yield rows(total)

    return run


def vocabulary(docs: DataFrame, length: int = 6, least: int = 5, drop: int = 199) -> DataFrame:
    """word, n: words of at least `length` code points that occur at least `least` times.

    Words are runs of letters of `docs` (doc_id, text), A-Z lower-cased; see `variants` for the
    letter that some lose. Null and empty texts have none; a null doc_id counts as an empty one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    counted = rows.mapInArrow(_counts(drop), "word string, n long")
    return (
        counted.filter(F.length("word") >= length)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
    )


class Ranks:
    """Suffix ranks of a text of numbers (0 the delimiter), and steps from a string to that string
    with one more letter in front."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        rank = text.astype(np.int64)
        step = 1
        while True:
            key = rank * (n + 1 + rank.max())
            key[: n - step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.concatenate(([0], np.cumsum(sorted_key[1:] != sorted_key[:-1])))
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1 or step >= n:
                break
            step *= 2
        self.n = n
        self.suffixes = order
        self.before = text[order - 1].astype(np.int64)  # the letter before each suffix, by rank
        # ranks by letter before: the place of (letter, rank) is the rank with that letter in front
        self.places = np.sort(self.before * (n + 1) + np.arange(n))

    def step(self, letters: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = letters * (self.n + 1)
        return np.searchsorted(self.places, at + low), np.searchsorted(self.places, at + high)

    def in_front(self, low: np.ndarray, high: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of the interval, and letter, for every letter (no delimiter) that occurs before it."""
        wide = high - low > letters
        slim = np.flatnonzero(~wide)
        sizes = (high - low)[slim]
        of = np.repeat(slim, sizes)
        ranks = np.repeat(low[slim], sizes) + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        found = np.unique(of * (letters + 1) + self.before[ranks])
        of, letter = found // (letters + 1), found % (letters + 1)
        broad = np.flatnonzero(wide)
        if len(broad):
            many, each = np.repeat(broad, letters), np.tile(np.arange(1, letters + 1), len(broad))
            lows, highs = self.step(each, low[many], high[many])
            of, letter = np.append(of, many[lows < highs]), np.append(letter, each[lows < highs])
        return of[letter > 0], letter[letter > 0]


class Index:
    """The vocabulary of a shard, its letters as numbers, and the ranks of both directions."""

    def __init__(self, words: list[str], counts: np.ndarray):
        order = sorted(range(len(words)), key=words.__getitem__)
        self.words = [words[i] for i in order]
        self.counts = counts[order]
        codes = np.frombuffer("".join(self.words).encode("utf-32-le"), np.uint32)
        self.letters = np.unique(codes)
        lengths = np.array([len(w) for w in self.words])
        text = np.zeros(len(codes) + len(words) + 1, np.int64)
        starts = np.cumsum(lengths + 1) - lengths
        inside = np.ones(len(text), bool)
        inside[np.concatenate(([0], starts + lengths))] = False
        text[inside] = np.searchsorted(self.letters, codes) + 1
        self.number = np.cumsum(~inside) - 1  # of the word at a place of the text
        # a text read backwards grows to the right when letters are put in front
        self.leftward, self.rightward = Ranks(text), Ranks(text[::-1].copy())

    def numbers(self, words: list[str]) -> list[np.ndarray]:
        """Letters of words as numbers; one that the shard lacks is a number of no letter."""
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        known = np.where(self.letters[at] == codes, at + 1, len(self.letters) + 1)
        return np.split(known.astype(np.int64), np.cumsum([len(w) for w in words])[:-1])

    def near(self, words: list[str], rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (number of the searched word, number of the index's word) with exactly one error in
        the half that the search ends with: the second one if `rightward`, else the first."""
        halves = self.numbers(words)
        exact = [len(w) // 2 for w in words]
        if rightward:
            ranks, read = self.rightward, halves
        else:
            ranks, read = self.leftward, [h[::-1] for h in halves]
            exact = [len(w) - e for w, e in zip(words, exact, strict=True)]
        n, sizes, exact = len(words), np.array([len(r) for r in read]), np.array(exact)
        letters = np.zeros((n, sizes.max()), np.int64)
        letters[np.arange(letters.shape[1]) < sizes[:, None]] = np.concatenate(read)
        zero = np.zeros(n, np.int64)
        # the delimiter first: ranks of all that begins after one
        low, high = ranks.step(zero, zero, zero + ranks.n)
        # states with the error behind them: word, ranks
        who, lows, highs = zero[:0], zero[:0], zero[:0]
        for j in range(letters.shape[1] + 1):
            # errors at place j: another letter instead of the word's, one more before it, or none there
            live = np.flatnonzero((j >= exact) & (j <= sizes) & (low < high))
            of, letter = ranks.in_front(low[live], high[live], len(self.letters))
            of = live[of]
            more_low, more_high = ranks.step(letter, low[of], high[of])
            inside = live[j < sizes[live]]
            here = letters[:, j] if j < letters.shape[1] else zero
            # one letter more: letter j is still to be read
            extra = (of, more_low, more_high)
            # states that have read up to j read letter j
            going = j < sizes[who]
            done = [(who[~going], lows[~going], highs[~going])]
            who, lows, highs = (np.append(x[going], y) for x, y in zip((who, lows, highs), extra, strict=True))
            ended = j >= sizes[who]
            done.append((who[ended], lows[ended], highs[ended]))
            who, lows, highs = who[~ended], lows[~ended], highs[~ended]
            lows, highs = ranks.step(here[who], lows, highs)
            # another letter, or letter j left out: letter j is read
            instead = (letter != here[of]) & (j < sizes[of])
            who = np.concatenate((who, of[instead], inside))
            lows = np.concatenate((lows, more_low[instead], low[inside]))
            highs = np.concatenate((highs, more_high[instead], high[inside]))
            kept = lows < highs
            who, lows, highs = who[kept], lows[kept], highs[kept]
            # finished states wait until all are ended by the delimiter
            finished = [np.concatenate(x) for x in zip(*done, strict=True)]
            if j == 0:
                whole = finished
            else:
                whole = [np.append(x, y) for x, y in zip(whole, finished, strict=True)]
            reading = np.flatnonzero((j < sizes) & (low < high))
            low[reading], high[reading] = ranks.step(here[reading], low[reading], high[reading])
        who, lows, highs = (np.append(x, y) for x, y in zip(whole, (who, lows, highs), strict=True))
        lows, highs = ranks.step(np.zeros(len(who), np.int64), lows, highs)
        who, lows = who[lows < highs], lows[lows < highs]
        place = ranks.suffixes[lows] + 1
        if rightward:
            place = ranks.n - 1 - place
        pairs = np.unique(who * np.int64(len(self.words)) + self.number[place])
        return pairs // len(self.words), pairs % len(self.words)


def _halves(length: int) -> tuple[int, int]:
    return length // 2, length - length // 2


def _shards(shards: int) -> Callable[[Batches], Batches]:
    """Where a word is searched (kind 1), and where it lies to be found (kind 0).

    Its near words are as long, or one longer or shorter; it lies in the shards of the halves that
    words of these lengths search with.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out: list[tuple[int, int, bool, int]] = []
            words = batch["word"].to_pylist()
            for i, word in enumerate(words):
                size = len(word)
                kept = set()
                for other in (size - 1, size, size + 1):
                    head, tail = _halves(other)
                    first, last = word[:head], word[size - tail :]
                    places = (
                        (zlib.crc32(b"<" + first.encode()) % shards, True),
                        (zlib.crc32(b">" + last.encode()) % shards, False),
                    )
                    kept |= {(0, p) for p, _ in places}
                    if other == size:
                        kept |= {(1, p, r) for p, r in places}
                out += [(i, x[1], x[2] if x[0] else False, x[0]) for x in kept]
            at = pa.array([x[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[1] for x in out], pa.int32()),
                    pa.array([x[3] for x in out], pa.int32()),
                    pa.array([x[2] for x in out], pa.bool_()),
                    batch["word"].take(at),
                    batch["n"].take(at),
                ],
                ["place", "kind", "rightward", "word", "n"],
            )

    return run


def _search(index: Index, rows: pa.RecordBatch) -> Batches:
    """Per searched word how many near words this index holds, and the most frequent of them."""
    for rightward in (True, False):
        some = rows.filter(pa.array(rows["rightward"].to_numpy(zero_copy_only=False) == rightward))
        words = some["word"].to_pylist()
        lo = 0
        while lo < len(words):
            hi, longest = lo, 0
            while hi < len(words) and (hi == lo or (hi - lo + 1) * max(longest, len(words[hi])) <= SEARCHED):
                longest = max(longest, len(words[hi]))
                hi += 1
            part = words[lo:hi]
            who, what = index.near(part, rightward)
            if not rightward:  # those of an equal first half are found by the other search
                apart = [not index.words[w].startswith(part[i][: len(part[i]) // 2]) for i, w in zip(who, what, strict=True)]
                who, what = who[apart], what[apart]
            # the most frequent first, then the first in code-point order, as the index is sorted
            order = np.lexsort((what, -index.counts[what], who))
            who, what = who[order], what[order]
            first = np.flatnonzero(np.diff(who, prepend=-1))
            if len(first):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part[i] for i in who[first]]),
                        pa.array(np.diff(np.append(first, len(who)))),
                        pa.array([index.words[w] for w in what[first]]),
                        pa.array(index.counts[what[first]]),
                    ],
                    ["word", "n_near", "near", "near_n"],
                )
            lo = hi


def _indexed(table: pa.Table) -> Index:
    return Index(table["word"].to_pylist(), table["n"].to_numpy())


def near_words(words: DataFrame, shard: int = SHARD) -> DataFrame:
    """word, n_near, near, near_n for every word of `words` (word, n; words distinct, of at least four
    code points) that has near words: how many, and the most frequent of them (ties: the first in
    code-point order)."""
    spark = words.sparkSession
    size = words.agg(F.sum(F.length("word")).alias("size")).first()["size"] or 0
    # a word lies in about four shards
    shards = max(1, min(1 << 20, -(-4 * size // shard)))
    dealt = written(
        words.mapInArrow(_shards(shards), "place int, kind int, rightward boolean, word string, n long"),
        "dealt",
    )
    sizes = (
        dealt.filter("kind = 0").groupBy("place").agg(F.sum(F.length("word")).alias("size"))
        .filter(F.col("size") > 2 * shard)
        .select("place", F.ceil(F.col("size") / shard).cast("int").alias("pieces"))
    )
    # only shards of common halves, each with more than two shards' worth of words
    hot = written(sizes, "hot-shards")
    pieces = F.coalesce("pieces", F.lit(1))
    piece = F.when(
        F.col("kind") == 0, F.array(F.pmod(F.xxhash64("word"), pieces).cast("int"))
    ).otherwise(F.sequence(F.lit(0), pieces - 1))
    rows = (
        dealt.join(hot, "place", "left")
        .withColumn("piece", F.explode(piece))
        .select(
            (F.col("place").cast("long") * (1 << 32) + F.col("piece")).alias("shard"),
            "kind", "rightward", "word", "n",
        )
        .repartition("shard")
        # long words come last, so that words searched together are of like length
        .sortWithinPartitions("shard", "kind", F.length("word"))
    )
    found = rows.mapInArrow(
        by_shard(_indexed, _search), "word string, n_near long, near string, near_n long"
    )
    best = F.min_by("near", F.struct(-F.col("near_n"), F.col("near")))
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), best.alias("near"), F.max("near_n").alias("near_n")
    )


def variants(
    docs: DataFrame, length: int = 6, least: int = 5, share: int = 5, drop: int = 199, shard: int = SHARD
) -> DataFrame:
    """word, form, root, n, n_near, form_n: the vocabulary of `docs` (doc_id, text) grouped by spelling.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased, of at least `length`
    code points and `least` occurrences (n). Where `drop` divides h = crc32("doc_id:run"), the run has
    lost its code point h % length. Two words are near if they differ by one inserted, deleted or
    replaced code point. A word's form is its most frequent near word (ties: the first in code-point
    order) if that occurs `share` times as often; root is where the forms lead to.

    Null and empty texts have no words; whole texts of any length are read, in slices that no run
    crosses. A null doc_id counts as an empty one. Repeated rows count as often as they occur. An
    empty table gives no rows; other columns are ignored.
    """
    words = written(vocabulary(docs, length, least, drop), "words")
    near = near_words(words, shard)
    found = written(
        words.join(near, "word", "left").select(
            "word",
            F.when(F.col("near_n") >= share * F.col("n"), F.col("near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("near_n") >= share * F.col("n"), F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    # forms lead to ever more frequent words, so chains are short; each round doubles their reach
    roots = found.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        roots = written(roots, "roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(further, "root", "left_semi").isEmpty():
            break
        roots = roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
