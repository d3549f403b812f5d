"""Encoding texts into pieces of a given vocabulary, and decoding, by shared-prefix Viterbi.

A text is cut before each run of spaces, and spaces are marked. The distinct marked words of many
texts are sorted, which is the order of a depth-first walk of their trie: the best scores up to each
character of a common prefix are taken from the word before. A word's pieces have the largest sum of
scores; of equal sums the one with the longer last piece. Characters outside the vocabulary become
their UTF-8 bytes. Decoding gives back every text exactly.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: characters of text encoded at a time, and words remembered between
SLICE = 400_000
REMEMBERED = 400_000
REMEMBERED_CHARACTERS = 8_000_000

# a run of spaces with the word after it; line ends and literal marks stand alone
_UNITS = re.compile(f" +[^ \n{MARK}]*|[^ \n{MARK}]+|\n+|{MARK}+")

Batches = Iterator[pa.RecordBatch]


@dataclass
class Vocabulary:
    """Pieces with scores, and the ids of the 256 byte pieces. Its size is that of the model file."""

    pieces: dict[str, tuple[int, float]]
    bytes_: list[int]
    size: int

    @cached_property
    def endings(self) -> dict:
        """Trie of the pieces read backwards: by character, the node's children and, where a piece
        begins there, its id and score."""
        root: dict = {}
        for p, hit in self.pieces.items():
            children = root
            for c in p[:0:-1]:
                children = children.setdefault(c, ({}, None))[0]
            children[p[0]] = (children.get(p[0], ({}, None))[0], hit)
        return root

    @cached_property
    def penalty(self) -> float:
        """Score of a byte, below that of every piece in use."""
        return min((s for _, s in self.pieces.values() if s > -1e8), default=0.0) - 10.0

    @cached_property
    def spellings(self) -> Strings:
        """The bytes that each id stands for."""
        out = [b""] * self.size
        for p, (i, _) in self.pieces.items():
            out[i] = p.replace(MARK, " ").encode()
        for b, i in enumerate(self.bytes_):
            out[i] = bytes([b])
        return Strings(np.frombuffer(b"".join(out), np.uint8), np.array([len(x) for x in out]))

    def __getstate__(self) -> dict:
        return {"pieces": self.pieces, "bytes_": self.bytes_, "size": self.size}


def load(path: str = DEFAULT_MODEL) -> Vocabulary:
    """The vocabulary of a model file; it must hold a piece for every byte."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, raw = {}, {}
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            raw[int(model.id_to_piece(i)[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = (i, model.get_score(i))
    if len(raw) != 256:
        raise ValueError(f"{path} has no piece for every byte")
    return Vocabulary(pieces, [raw[b] for b in range(256)], model.get_piece_size())


def viterbi(units: list[str], vocabulary: Vocabulary) -> dict[str, tuple[int, ...]]:
    """Piece ids of distinct units, walking their sorted marked forms."""
    get, raw, penalty = vocabulary.endings.get, vocabulary.bytes_, vocabulary.penalty
    out: dict[str, tuple[int, ...]] = {}
    marked = sorted(
        (u.replace(" ", MARK), u) for u in units if not u.startswith(MARK)
    )
    for u in units:
        if u.startswith(MARK):  # a literal mark is not a space: spell it
            out[u] = tuple(raw[b] for b in u.encode())
    before = ""
    # by number of characters: the best score, and the last piece's start and id (None: spelled)
    best: list[float] = [0.0]
    starts: list[int] = [0]
    last: list[int | None] = [None]
    for word, unit in marked:
        shared = 0
        for x, y in zip(before, word, strict=False):
            if x != y:
                break
            shared += 1
        del best[shared + 1 :], starts[shared + 1 :], last[shared + 1 :]
        for j in range(shared + 1, len(word) + 1):
            start = i = j - 1
            node = get(word[i])
            if node and (hit := node[1]):
                piece, score = hit
                top = best[i] + score
            else:
                piece, top = None, best[i] + penalty * len(word[i].encode())
            while node and i:
                i -= 1
                node = node[0].get(word[i])
                if node and (hit := node[1]) and (score := best[i] + hit[1]) >= top:
                    top, start, piece = score, i, hit[0]
            best.append(top)
            starts.append(start)
            last.append(piece)
        before = word
        found: list[int] = []
        j = len(word)
        while j:
            piece = last[j]
            if piece is None:
                found.extend(raw[b] for b in reversed(word[j - 1].encode()))
            else:
                found.append(piece)
            j = starts[j]
        found.reverse()
        out[unit] = tuple(found)
    return out


def _parts(text: str) -> Iterator[str]:
    """A long text in slices, cut where a unit ends."""
    lo = 0
    while len(text) - lo > SLICE:
        hi = lo + SLICE
        while hi < len(text) and not (text[hi] in " \n" and text[hi - 1] not in " \n"):
            hi += 1
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


@dataclass
class Strings:
    """Strings of numbers, one after the other."""

    flat: np.ndarray
    sizes: np.ndarray

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def joined(self, which: np.ndarray) -> np.ndarray:
        """The numbers of the named strings in a row."""
        sizes = self.sizes[which]
        at = np.repeat(self.starts[which] - (np.cumsum(sizes) - sizes), sizes)
        return self.flat[at + np.arange(len(at))]


class Encoder:
    """Encodes lists of texts; remembers words between calls, up to a bound."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.words = Strings(np.zeros(0, np.int32), np.zeros(0, np.int64))
        self.characters = 0

    def _learn(self, units: set[str]) -> None:
        """Encodes those units that are not known yet."""
        if len(self.known) > REMEMBERED or self.characters > REMEMBERED_CHARACTERS:
            self._forget()
        new = viterbi(list(units - self.known.keys()), self.vocabulary)
        if not new:
            return
        self.characters += sum(map(len, new))
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        flat = np.fromiter(chain.from_iterable(new.values()), np.int32)
        sizes = np.fromiter(map(len, new.values()), np.int64, len(new))
        self.words = Strings(np.append(self.words.flat, flat), np.append(self.words.sizes, sizes))

    def _ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of units in a row, and their number per unit."""
        which = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        return self.words.joined(which), self.words.sizes[which]

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts in a row, and where each text's begin and the last one's end."""
        cut = [_UNITS.findall(" " + t) if t else [] for t in texts]
        units = list(chain.from_iterable(cut))
        self._learn(set(units))
        ids, sizes = self._ids(units)
        ends = np.cumsum(sizes)
        counts = np.cumsum([0] + [len(c) for c in cut])
        return ids, np.append(0, ends)[counts]

    def long(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The same of one text of any length, a slice at a time."""
        ids = []
        for n, part in enumerate(_parts(text)):
            units = _UNITS.findall(part if n else " " + part)
            self._learn(set(units))
            ids.append(self._ids(units)[0])
        ids = np.concatenate(ids)
        return ids, np.array([0, len(ids)])


def decoded(ids: np.ndarray, bounds: np.ndarray, spellings: Strings) -> list[str]:
    """Texts of rows of ids, the n-th between the n-th bound and the next."""
    ends = np.append(0, np.cumsum(spellings.sizes[ids]))[bounds].tolist()
    raw = spellings.joined(ids).tobytes()
    texts = [raw[lo:hi].decode("utf-8", "replace") for lo, hi in zip(ends, ends[1:], strict=False)]
    return [t[1:] if t.startswith(" ") else t for t in texts]


def _encode(vocabulary: Vocabulary, check: bool) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encoder = Encoder(vocabulary)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at)
            lo = 0
            while lo < batch.num_rows:
                hi, size, some = lo, 0, []
                while hi < batch.num_rows and (not some or size < SLICE):
                    some.append(texts[hi].as_py())
                    size += len(some[-1] or "")
                    hi += 1
                ids, bounds = encoder.long(some[0]) if len(some) == 1 and size > SLICE else encoder(some)
                columns = [c for i, c in enumerate(batch.slice(lo, hi - lo).columns) if i != at]
                names = [n for n in batch.schema.names if n != "text"]
                columns += [
                    pa.array(np.diff(bounds), pa.int32()),
                    pa.ListArray.from_arrays(
                        pa.array(bounds.astype(np.int32)), pa.array(ids), mask=pa.array([t is None for t in some])
                    ),
                ]
                names += ["n_tokens", "token_ids"]
                if check:
                    back = decoded(ids, bounds, vocabulary.spellings)
                    same = [None if t is None else t == b for t, b in zip(some, back, strict=True)]
                    columns.append(pa.array(same, pa.bool_()))
                    names.append("round_trip")
                yield pa.RecordBatch.from_arrays(columns, names)
                lo = hi

    return run


def encode(docs: DataFrame, model: str = DEFAULT_MODEL, check: bool = True) -> DataFrame:
    """doc_id, n_tokens, token_ids of every row, and whether decoding gives the text back.

    A null text has null ids, no tokens and a null check; an empty one no tokens. Every other text
    begins with a marked space, which decoding takes away. Other columns are ignored.
    """
    schema = "doc_id long, n_tokens int, token_ids array<int>" + ", round_trip boolean" * check
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_encode(load(model), check), schema)


def decode(tokens: DataFrame, model: str = DEFAULT_MODEL) -> DataFrame:
    """doc_id and text of rows of doc_id and token_ids; null ids give a null text.

    Ids outside the vocabulary and control pieces spell nothing; bytes that are no UTF-8 become
    replacement characters.
    """
    vocabulary = load(model)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = [
                [i for i in ids or [] if i is not None and 0 <= i < vocabulary.size]
                for ids in batch["token_ids"].to_pylist()
            ]
            bounds = np.cumsum([0] + [len(r) for r in rows])
            ids = np.fromiter(chain.from_iterable(rows), np.int64, bounds[-1])
            texts = [
                t if ids.is_valid else None
                for t, ids in zip(decoded(ids, bounds, vocabulary.spellings), batch["token_ids"], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    rows = tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "token_ids")
    return rows.mapInArrow(run, "doc_id long, text string")
