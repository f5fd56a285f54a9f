"""Token counts under a unigram model, by dynamic programming shared along a trie of pre-tokens."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens that one worker remembers, in each of two generations.
CACHE_WORDS = 400_000
#: Ranks by which the most frequent pieces lie above what a pure power law gives.
OFFSET = 200.0
#: What stands for the space before each word.
MARK = "▁"


class Unigram:
    """Best segmentations under scores of pieces: the highest sum, and of equal sums the one with fewest tokens.

    A character outside the pieces costs the least score less ``penalty`` and counts as
    its UTF-8 bytes, the tokens of byte fallback.
    """

    def __init__(self, scores: dict[str, float], penalty: float = 10.0):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - penalty
        #: For each last character, the lengths that pieces with that end have.
        ends: dict[str, set[int]] = {}
        for p in scores:
            ends.setdefault(p[-1], set()).add(len(p))
        self.ends = {c: sorted(n) for c, n in ends.items()}

    def counts(self, words: list[str]) -> list[int]:
        """Numbers of tokens of distinct words.

        Sorted, the words are a depth-first walk of their trie, and the walk's stack holds
        the forward scores of the prefix that a word shares with the one before: they are
        computed once a node. The count at a word's last node is its own.
        """
        order = sorted(range(len(words)), key=words.__getitem__)
        out = [0] * len(words)
        best, tokens, before = [0.0], [0], ""
        scores, ends, unknown = self.scores, self.ends, self.unknown
        for i in order:
            word = words[i]
            shared, most = 0, min(len(before), len(word))
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :]
            for at in range(shared + 1, len(word) + 1):
                last = word[at - 1]
                top, count = best[at - 1] + unknown, tokens[at - 1] + len(last.encode("utf-8", "replace"))
                for n in ends.get(last, ()):
                    if n > at:
                        break
                    s = scores.get(word[at - n : at])
                    if s is not None:
                        s += best[at - n]
                        t = tokens[at - n] + 1
                        if s > top or s == top and t < count:
                            top, count = s, t
                best.append(top)
                tokens.append(count)
            out[i] = tokens[-1]
            before = word
        return out


def zipf(ranks: dict[str, float], offset: float = OFFSET) -> dict[str, float]:
    """Log frequencies, up to a constant, of pieces by their ranks: -ln(rank + offset), the law of Zipf and Mandelbrot.

    ``ranks`` are a merge table's, 0 the first merge and lower the later ones; single
    characters, which it lists after all merges, are ranked among themselves.
    """
    merges = max((-r for p, r in ranks.items() if len(p) > 1), default=0.0)
    return {p: -log(-r + offset if len(p) > 1 else max(-r - merges, 0.0) + offset) for p, r in ranks.items()}


@lru_cache(1)
def model(path: str) -> Unigram:
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    # scores of -1e9 mark runs of spaces, which no word holds
    plain = [i for i in range(p.get_piece_size()) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i)) and p.get_score(i) > -1e8]
    return Unigram(zipf({p.id_to_piece(i): p.get_score(i) for i in plain}))


class Counter:
    """Counts of words, remembered in two generations of bounded size."""

    def __init__(self, unigram: Unigram, most: int = CACHE_WORDS):
        self.unigram, self.most, self.young, self.old = unigram, most, {}, {}

    def learn(self, words: set[bytes]) -> None:
        fresh = []
        for w in words:
            if w not in self.young:
                n = self.old.get(w)
                if n is None:
                    fresh.append(w)
                else:
                    self.young[w] = n
        self.young.update(zip(fresh, self.unigram.counts([MARK + w.decode("utf-8", "replace") for w in fresh]), strict=True))

    def total(self, words: list[bytes]) -> int:
        return sum(map(self.young.__getitem__, words))

    def turn(self) -> None:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}


@lru_cache(1)
def counter(path: str) -> Counter:
    """One a worker process, so that later tasks know the words of earlier ones."""
    return Counter(model(path))


def runs(texts: list[bytes], most: int = 1 << 22) -> Iterator[list[list[bytes]]]:
    """The words of the texts, in runs of texts of about ``most`` bytes."""
    run, size = [], 0
    for t in texts:
        run.append(t.split())
        size += len(t)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def count_tokens(docs: DataFrame, path: str) -> DataFrame:
    """Tokens of every row of ``docs(doc_id, text)``: doc_id, n_words, n_tokens.

    A pre-token is a word of the whole text (ASCII white space separates) after the
    space mark. Each worker collects the distinct pre-tokens of a run of texts, scores
    the new ones on their trie and sums up; nothing is shuffled, and what it remembers
    is bounded. The pieces are those of the sentencepiece model at ``path``, a merge table
    without log probabilities; a unigram model needs such, and none is trained here, so
    scores follow from the pieces' ranks (zipf()). Counts are of the best segmentation under
    these scores, near those of the model's own merges but not equal to them.

    A null or empty text has none. Rows that repeat count each for themselves; a null
    doc_id stays null; an empty table gives no rows. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            texts = [(t.as_py() or "").encode("utf-8", "replace") for t in batch.column(1)]
            n_words, n_tokens = [], []
            for lists in runs(texts):
                known.learn(set().union(*lists))
                n_words += map(len, lists)
                n_tokens += map(known.total, lists)
                known.turn()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")
