"""Harmonic packing of tokenised documents into sequences of a fixed capacity."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces of words that one worker remembers the ids of, in each of two generations.
CACHE_PIECES = 170_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: Texts that the tokenizer's own rule would cut the same way once they are in lower case: ASCII and the letters of Latin-1.
SIMPLE = re.compile("[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
#: The tokenizer's rule, for such texts in lower case; white space is dropped.
PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ\t-\r ]+")
#: Words end at white space of ASCII alone.
WORD = re.compile("[^\t-\r ]+")


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level tokenizers write for each byte: itself, or the next free one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in plain}
    return table | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in table)}


class Remembered(dict):
    """Ids by piece, as little-endian bytes, in two generations of bounded size: a piece in use moves to the young one, so memory doesn't grow with the vocabulary."""

    def __init__(self, ids: Callable[[str], Iterable[int]], most: int):
        self.ids, self.most, self.old = ids, most, {}

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = b"".join([i.to_bytes(4, "little") for i in self.ids(piece)])
        self[piece] = found
        return found

    def age(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


class WordTokenizer:
    """Ids of whole texts for a tokenizer whose tokens never span ASCII white space and that drops it.

    Simple texts are cut into pieces by the tokenizer's rule, and its model is asked for
    each piece once (Remembered). Of other texts, the words that aren't simple or could hold a
    special token go through the whole tokenizer; both give its ids.
    """

    def __init__(self, path: str, most: int = CACHE_PIECES):
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.model, self.letters = self.encoder.model, byte_letters()
        self.known = Remembered(self.ids, most)

    def ids(self, piece: str) -> Iterable[int]:
        """The ids of a piece, or of a word that isn't simple."""
        if not simple(piece):
            return self.encoder.encode(piece, add_special_tokens=False).ids
        spelt = piece if piece.isalpha() and piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(spelt)]

    def encode(self, text: str, end: int) -> np.ndarray:
        """The ids of a text, then ``end``."""
        if simple(text):
            pieces = PIECE.findall(text.lower())
        else:
            pieces = [p for w in WORD.findall(text) for p in (PIECE.findall(w.lower()) if simple(w) else (w,))]
        found = list(map(self.known.__getitem__, pieces))
        self.known.age()
        found.append(end.to_bytes(4, "little"))
        return np.frombuffer(b"".join(found), dtype="<u4")


def simple(text: str) -> bool:
    return (text.isascii() or SIMPLE.fullmatch(text) is not None) and "<|" not in text


@lru_cache(1)
def tokenizer(path: str) -> WordTokenizer:
    """One a worker process, so that later tasks know the pieces of earlier ones."""
    return WordTokenizer(path)


class HarmonicBins:
    """Open bins of one worker.

    Class k takes documents of capacity/(k + 1) to capacity/k tokens, k to a bin, whole:
    any k of them fit. What a bin of k has left, under capacity/(k + 1), is its gap. A
    document fills the smallest gap that holds it whole; only where ``waiting`` bins have
    gaps is the next document cut, into the smallest of them first. Of documents longer
    than the capacity, full sequences are cut off first. Documents shorter than
    capacity/``classes`` are one class, whose bins close when the next doesn't fit.
    """

    def __init__(self, capacity: int, classes: int, waiting: int, first_id: int):
        self.capacity, self.classes, self.waiting, self.next_id = capacity, classes, waiting, first_id
        self.open: dict[int, list[tuple]] = {}
        #: Bins with gaps, smallest gap first: (gap, number, pieces). The number breaks ties by age.
        self.gaps: list[tuple[int, int, list[tuple]]] = []
        self.made = 0

    def place(self, pieces: list[tuple]) -> Iterator[tuple]:
        """A closed sequence: each piece with its sequence and offset."""
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids), zlib.crc32(ids), total, self.next_id, offset
            offset += len(ids)
        self.next_id += 1

    def shelve(self, gap: int, pieces: list[tuple]) -> Iterator[tuple]:
        if gap:
            self.made += 1
            insort(self.gaps, (gap, self.made, pieces))
        else:
            yield from self.place(pieces)

    def add(self, doc: int, ids: np.ndarray) -> Iterator[tuple]:
        start, total, capacity = 0, len(ids), self.capacity
        while total - start >= capacity:
            yield from self.place([(doc, start, ids[start : start + capacity], total)])
            start += capacity
        while start < total:
            n = total - start
            at = bisect_left(self.gaps, (n,))
            if at < len(self.gaps) or len(self.gaps) >= self.waiting:
                # whole into the smallest gap that holds it, or cut into the smallest of many
                gap, _, pieces = self.gaps.pop(at if at < len(self.gaps) else 0)
                n = min(n, gap)
                pieces.append((doc, start, ids[start : start + n], total))
                start += n
                yield from self.shelve(gap - n, pieces)
                continue
            k = min(capacity // n, self.classes)
            pieces = self.open.setdefault(k, [])
            used = sum(len(p[2]) for p in pieces)
            if used + n > capacity:
                yield from self.shelve(capacity - used, pieces)
                pieces, used = [], 0
                self.open[k] = pieces
            pieces.append((doc, start, ids[start:], total))
            start = total
            if k < self.classes and len(pieces) == k or used + n == capacity:
                yield from self.shelve(capacity - used - n, self.open.pop(k))

    def close(self) -> Iterator[tuple]:
        """What is open in the end: full sequences, then such whose lengths are powers of two, which need no padding."""
        left = [p for _, _, pieces in self.gaps for p in pieces] + [p for k in sorted(self.open) for p in self.open[k]]
        rest = sum(len(p[2]) for p in left)
        left.reverse()
        while left:
            room = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
            rest -= room
            now = []
            while room:
                doc, start, ids, total = left.pop()
                now.append((doc, start, ids[:room], total))
                if len(ids) > room:
                    left.append((doc, start + room, ids[room:], total))
                room -= len(now[-1][2])
            yield from self.place(now)


def pack(docs: DataFrame, path: str, capacity: int = 2048, classes: int = 64, waiting: int = 64, end: int = 1) -> DataFrame:
    """Packs every document of ``docs(doc_id, text)`` into sequences of at most ``capacity`` tokens.

    One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset``. Each worker fills bins of its own while it reads, so nothing is
    shuffled and its memory is bounded: a bin a class, and ``waiting`` more. All sequences
    are full, but for a few at a worker's end whose lengths are powers of two. Ids of
    sequences hold the partition's number and are unique.

    ``capacity`` is a power of two. A null or empty text has the end token alone; a null
    doc_id stays null; repeated rows are packed as often as they stand there; other
    columns are ignored; an empty table gives no rows. A text of any length is cut into as
    many pieces as it needs.
    """
    if capacity < 1 or capacity & (capacity - 1) or classes < 1 or waiting < 1:
        raise ValueError("capacity is a power of two, classes and waiting are 1 or more")
    names = [x.split()[0] for x in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = tokenizer(path)
        bins = HarmonicBins(capacity, classes, waiting, TaskContext.get().partitionId() << 40)
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(names))], names=names)
            rows.clear()
            return batch

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows.extend(bins.add(doc, encoder.encode(text.as_py() or "", end)))
                if len(rows) >= 8192:
                    yield flush()
        rows.extend(bins.close())
        if rows:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA)
