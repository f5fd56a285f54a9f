"""Repeated passages by sparse suffix arrays: suffixes at minimiser positions, sorted, compared with their neighbours, extended left and right."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import delete, n_words, stash
from .textkernel import U, Words, list_array, mix, pieces

#: Words of the k-gram by which positions are selected.
GRAM = 24
#: Suffixes with a common k-gram that one task sorts at most; more frequent ones are counted window by window.
GROUP = 2048
#: Repeated windows of more frequent k-grams that workers look up in a copy of their own; beyond it they are joined.
LOOKUP = 300_000


def anchors_of(w: Words, grams: np.ndarray, lo: int, hi: int, length: int) -> np.ndarray:
    """Positions, from the text's first word, of the least k-gram in each run of ``length`` words, leftmost if equal."""
    if hi - lo < length:
        return np.zeros(0, dtype=np.int64)
    g = grams[lo : hi - GRAM + 1]
    wide = length - GRAM + 1
    least = sliding_window_view(g, wide).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def _slim(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text")).withColumn("th", F.xxhash64("text"))


def anchors(slim: DataFrame, length: int) -> DataFrame:
    """(id, th, pos, gram): the selected positions of each text and their k-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                ids, hashes = batch.column(0), batch.column(1)
                for at, texts in pieces(batch):
                    w = Words(texts, lower=True)
                    grams = w.grams(GRAM)
                    found = [anchors_of(w, grams, lo, hi, length) for lo, hi in zip(w.lo.tolist(), w.hi.tolist(), strict=True)]
                    row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
                    pos = np.concatenate(found)
                    take = pa.array(at + row)
                    yield pa.RecordBatch.from_arrays([ids.take(take), hashes.take(take), pa.array(pos, pa.int32()), pa.array(grams[w.lo[row] + pos].view(np.int64))], names=["id", "th", "pos", "gram"])

    return slim.select("id", "th", "text").mapInArrow(run, "id long, th long, pos int, gram long")


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """(gram, id, th, pos, around) for ``texts(id, th, text, at)``: 32-bit hashes of the words around each position in at.

    First come the ``length - GRAM`` words left of the k-gram, the nearest first, then as
    many right of it; beyond the text's ends stand numbers that depend on the text and place.
    """
    side = length - GRAM

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                ids, hashes, places = batch.column(0), batch.column(1), batch.column(3)
                for start, texts in pieces(batch):
                    w = Words(texts, lower=True)
                    at = places.slice(start, len(texts))
                    pos = at.flatten().to_numpy().astype(np.int64)
                    row = np.repeat(np.arange(len(texts)), at.value_lengths().to_numpy())
                    lo, hi = w.lo[row], w.hi[row]
                    index = (lo + pos)[:, None] + np.concatenate([-1 - np.arange(side), GRAM + np.arange(side)])
                    inside = (index >= lo[:, None]) & (index < hi[:, None])
                    own = hashes.slice(start, len(texts)).to_numpy().view(U)[row] + pos.astype(U)
                    alone = mix(mix(own)[:, None] + np.arange(2 * side, dtype=U))
                    around = np.where(inside, w.hash[np.clip(index, 0, max(len(w.hash) - 1, 0))], alone) if len(pos) else np.zeros((0, 2 * side), dtype=U)
                    flat = (around & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32).ravel()
                    take = pa.array(start + row)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(w.grams(GRAM)[lo + pos].view(np.int64)), ids.take(take), hashes.take(take), pa.array(pos, pa.int32()), list_array(flat, np.full(len(pos), 2 * side), pa.int32())],
                        names=["gram", "id", "th", "pos", "around"],
                    )

    return texts.select("id", "th", "text", "at").mapInArrow(run, "gram long, id long, th long, pos int, around array<int>")


def windows_at(w: Words, at: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, window, fits) of the windows of ``length`` words that hold the k-gram at each of the texts' positions, a line of them a position."""
    pos = at.flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(at)), at.value_lengths().to_numpy())
    begin = pos[:, None] - np.arange(length - GRAM + 1)
    fits = (begin >= 0) & ((w.lo[row][:, None] + begin + length) <= w.hi[row][:, None])
    windows = w.grams(length)
    held = windows[np.clip(w.lo[row][:, None] + begin, 0, max(len(windows) - 1, 0))].view(np.int64) if len(windows) else np.zeros(begin.shape, dtype=np.int64)
    return row, begin, held, fits


def held_windows(texts: DataFrame, length: int) -> DataFrame:
    """(id, th, start, window) for ``texts(id, th, text, at)``: hashes of all windows of ``length`` words that hold the k-gram at a position in at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for start, texts in pieces(batch):
                    row, begin, held, fits = windows_at(Words(texts, lower=True), batch.column(3).slice(start, len(texts)), length)
                    rows, begin, held = np.broadcast_to(row[:, None], begin.shape)[fits], begin[fits], held[fits]
                    _, one = np.unique(np.stack([rows, begin]), axis=1, return_index=True)
                    take = pa.array(start + rows[one])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(begin[one]), pa.array(held[one])], names=["id", "th", "start", "window"])

    return texts.select("id", "th", "text", "at").mapInArrow(run, "id long, th long, start long, window long")


def looked_up(texts: DataFrame, twice: DataFrame, length: int) -> DataFrame:
    """(id, th, start, end, first) for ``texts(id, th, text, at)``: what windows in ``twice(window, first)``, a table of checked size, repeat around each position."""
    table = twice.orderBy("window").toArrow()
    known = texts.sparkSession.sparkContext.broadcast((table["window"].to_numpy(), table["first"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, firsts = known.value
        with np.errstate(over="ignore"):
            for batch in batches:
                for start, texts in pieces(batch):
                    row, begin, held, fits = windows_at(Words(texts, lower=True), batch.column(3).slice(start, len(texts)), length)
                    place = np.minimum(np.searchsorted(windows, held), len(windows) - 1)
                    hit = fits & (windows[place] == held)
                    some = hit.any(axis=1)
                    # windows around one position overlap: together they are one passage
                    low = np.where(hit, begin, np.iinfo(np.int64).max).min(axis=1)[some]
                    high = np.where(hit, begin, -1).max(axis=1)[some]
                    first = np.where(hit, firsts[place], np.iinfo(np.int64).max).min(axis=1)[some]
                    take = pa.array(start + row[some])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), pa.array(low), pa.array(high + length), pa.array(first)], names=["id", "th", "start", "end", "first"])

    return texts.select("id", "th", "text", "at").mapInArrow(run, "id long, th long, start long, end long, first long")


def neighbours(gram: np.ndarray, ids: np.ndarray, th: np.ndarray, pos: np.ndarray, around: np.ndarray, length: int) -> list[np.ndarray]:
    """Sorts the suffixes of each k-gram and finds, with what stands left of them, the windows that occur twice.

    In sorted order all suffixes that agree in their next r words are neighbours. So for
    each t, the ones that agree in length - t words are runs between neighbours that
    don't, and those of a run that also agree in the t words before are repeats: each
    run of t gives the match [pos - t, pos - t + length). Gives ids, th, starts, ends
    and the smallest id of each match.
    """
    side = length - GRAM
    left, right = around[:, :side], around[:, side:]
    order = np.lexsort([*right.T[::-1], gram])
    gram, ids, th, pos, left, right = gram[order], ids[order], th[order], pos[order].astype(np.int64), left[order], right[order]
    same = right[1:] == right[:-1]
    lcp = np.where(same.all(axis=1), side, same.argmin(axis=1))
    lcp = np.concatenate([[-1], np.where(gram[1:] == gram[:-1], lcp, -1)])
    before, at = np.zeros(len(ids), dtype=U), np.arange(len(ids))
    # windows of one suffix overlap, so what it repeats is one passage: from its largest t to its smallest
    low, high, least = np.full(len(ids), -1), np.full(len(ids), -1), np.full(len(ids), np.iinfo(np.int64).max)
    for t in range(side + 1):
        if t:
            before = mix(before * U(0xD6E8FEB86659FD93) + left[:, t - 1])
        runs = np.cumsum(lcp < side - t)
        # only runs of two or more can hold a repeat
        many = np.bincount(runs)[runs] > 1
        if not many.any():
            continue
        row = at[many]
        _, group, count = np.unique(mix(before[many] + runs[many].astype(U) * U(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
        hit = count[group] > 1
        if hit.any():
            first = np.full(len(count), np.iinfo(np.int64).max)
            np.minimum.at(first, group, ids[row])
            row, group = row[hit], group[hit]
            low[row] = np.where(low[row] < 0, t, low[row])
            high[row] = t
            least[row] = np.minimum(least[row], first[group])
    found = np.flatnonzero(high >= 0)
    return [ids[found], th[found], pos[found] - high[found], pos[found] - low[found] + length, least[found]]


def sorted_suffixes(around: DataFrame, length: int) -> DataFrame:
    """(id, th, start, end, first) of the matches among ``around``: suffixes dealt and sorted by k-gram, some thousand at a time, none of whose k-grams is cut."""
    names = ["id", "th", "start", "end", "first"]

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        gram, ids, th, pos = (np.concatenate([p.column(i).to_numpy() for p in parts]) for i in range(4))
        flat = np.concatenate([p.column(4).flatten().to_numpy() for p in parts]).view(np.uint32).astype(U)
        with np.errstate(over="ignore"):
            found = neighbours(gram, ids, th, pos, flat.reshape(len(ids), -1), length)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4 * GROUP):
                part = batch.slice(at, 4 * GROUP)
                gram = part.column(0).to_numpy()
                cut = int(np.searchsorted(gram, gram[-1]))
                held.append(part.slice(0, cut))
                rows += cut
                # the last k-gram goes on; before it stand whole ones, unless all is one
                if rows >= GROUP and cut:
                    yield solve(held)
                    held, rows = [], 0
                held.append(part.slice(cut))
                rows += part.num_rows - cut
        if rows:
            yield solve(held)

    dealt = around.select("gram", "id", "th", "pos", "around").repartition("gram").sortWithinPartitions("gram")
    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def merged(windows: DataFrame, keys: list[str]) -> DataFrame:
    """Windows (keys, start, end, first) of a text that overlap or touch become one passage."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    upto = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = windows.withColumn("new", F.when(F.col("start") <= upto, 0).otherwise(1))
    marked = marked.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("first").alias("first")).drop("part")


def repeated_passages(docs: DataFrame, length: int = 50) -> DataFrame:
    """Passages of at least ``length`` words of ``docs(doc_id, text)`` that stand in two places: doc_id, start, end, n_words, first_doc_id.

    One row a passage: a longest run of words (A-Z lower-cased, places counted from 0,
    end exclusive) each of which lies in a window of ``length`` words found again in
    another document or elsewhere in the same. first_doc_id is the smallest doc_id that
    holds one of its windows.

    Equal texts are searched once. Each run of ``length`` words has a selected position,
    so a match of that length has one, with its k-gram, in both places. Positions whose
    k-gram is the only one of its kind are left out before any context is read.

    Documents of fewer words, null or empty texts have no rows. Rows that repeat a
    doc_id are documents of their own under one id; a null doc_id has no rows and counts
    as no place. An empty table gives no rows. Other columns are ignored.
    """
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    slim = _slim(docs).filter("id IS NOT NULL")
    # equal texts: 64 bits and the length tell them apart
    classes = stash(slim.groupBy("th", F.length("text").alias("size")).agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "suffix-classes")
    found = stash(anchors(slim, length), "suffix-anchors")
    # a k-gram of one place in one text, or its copies, has no repeat
    least_most = [f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("th", "pos")]
    shared = found.groupBy("gram").agg(F.count("*").alias("n"), *least_most).filter("min_th <> max_th OR min_pos <> max_pos").select("gram", (F.col("n") > GROUP).alias("hot"))
    # written, so that the join deals both sides anew and Spark can split a frequent k-gram
    shared = stash(shared, "suffix-grams")
    reps = classes.select(F.col("rep").alias("id"), "th")
    kept = found.join(shared, "gram").groupBy("id", "th").agg(F.collect_list(F.struct("hot", "pos")).alias("at"))
    kept = kept.join(reps, ["id", "th"], "left_semi")
    texts = stash(slim.join(kept, ["id", "th"]).dropDuplicates(["id", "th"]), "suffix-texts")
    delete(found)

    def places(hot: bool) -> DataFrame:
        at = F.transform(F.filter("at", lambda x: x["hot"] == hot), lambda x: x["pos"])
        return texts.withColumn("at", at).filter(F.size("at") > 0)

    some = sorted_suffixes(contexts(places(False), length), length)
    windows = held_windows(places(True), length)
    twice = stash(windows.groupBy("window").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter("n > 1").drop("n"), "suffix-windows")
    size = twice.count()
    if 0 < size <= LOOKUP:
        many = looked_up(places(True), twice, length)
    else:
        many = windows.join(twice, "window").select("id", "th", "start", (F.col("start") + length).alias("end"), "first")
    both = some.union(many).groupBy("id", "th", "start", "end").agg(F.min("first").alias("first"))
    passages = stash(merged(both, ["id", "th"]), "suffix-passages")

    rows = slim.select("id", "th", F.length("text").alias("size"), n_words(F.col("text")).alias("words"))
    rows = rows.join(classes, ["th", "size"])
    firsts = passages.groupBy(F.col("id").alias("rep"), "th").agg(F.min("first").alias("first"))
    whole = rows.filter((F.col("copies") > 1) & (F.col("words") >= length)).join(firsts, ["rep", "th"], "left")
    whole = whole.select("id", F.lit(0).cast("long").alias("start"), F.col("words").alias("end"), F.least("rep", "first").alias("first"))
    single = rows.filter("copies = 1").join(passages, ["id", "th"]).select("id", "start", "end", "first")
    return whole.union(single).select(F.col("id").alias("doc_id"), "start", "end", (F.col("end") - F.col("start")).alias("n_words"), F.col("first").alias("first_doc_id"))
