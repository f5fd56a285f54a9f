"""An inverted index of records in files of the shared folder, and the exact search of each query's best records in it.

A file holds a block of records of one country: hashes of features, for each the places of its
records, the records' ids in order, and once all blocks are there the records' norms and places
among the country's ids. A task keeps a chunk of queries and reads the blocks of their country one
by one, so pairs of queries and records are never shuffled and memory is bounded by a block and a
chunk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow.fs import LocalFileSystem

from ..settings import Settings
from ..sources.shared import locate

#: Records and features of a block at most (places are 16 bits), and queries and their features of a chunk.
ROWS, ENTRIES = 60_000, 6_000_000
QUERIES, QUERY_ENTRIES = 1024, 400_000
#: A feature of more than one in so many of a block's records is a column of flags besides its places, and bytes of such columns.
DENSE, FLAGS = 64, 64 << 20
LISTED = "country string, path string, n long"
FINISHED = "country string, path string, beside string, n long"
FOUND = "country string, s1_id string, cand_id string, cos_name double, cos_addr double, score double, rank int"


class Chunk:
    """Records of one country, ids in order and distinct: their hashes (``hashes``, records at ``rows``, ``name`` where of the name)."""

    def __init__(self, country: str, pieces: list[tuple]):
        self.country, self.n = country, sum(len(p[0]) for p in pieces)
        ids, of = np.unique(np.array([x.encode() for p in pieces for x in p[0]], dtype=object), return_inverse=True)
        sizes = [np.concatenate([p[k] for p in pieces]) for k in (1, 3)]
        self.ids = ids.astype("S")
        self.rows = np.concatenate([np.repeat(of, n) for n in sizes])
        self.hashes = np.concatenate([p[k] for k in (2, 4) for p in pieces])
        self.name = np.arange(len(self.rows)) < sizes[0].sum()


def chunks(batches: Iterator[pa.RecordBatch], rows: int, entries: int) -> Iterator[Chunk]:
    """Cuts batches of (country, id, name, addr), sorted by country and id, into chunks; rows of an id stay together."""
    pieces, country, n, size, last = [], None, 0, 0, None
    for batch in batches:
        names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        begins, values = zip(*((c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False)) for c in (batch.column(2), batch.column(3))), strict=True)
        weight = begins[0] - begins[0][0] + begins[1] - begins[1][0]
        i = 0
        while i < len(ids):
            full = n >= rows or size >= entries
            if pieces and (names[i] != country or full and ids[i] != last):
                yield Chunk(country, pieces)
                pieces, n, size, full = [], 0, 0, False
            country = names[i]
            end = i + 1
            while end < len(ids) and not full and names[end] == country and n + end - i < rows and size + weight[end] - weight[i] < entries:
                end += 1
            cut = [(np.diff(b[i : end + 1]), v[b[i] : b[end]].copy()) for b, v in zip(begins, values, strict=True)]
            pieces.append((ids[i:end], *cut[0], *cut[1]))
            n, size, last = n + end - i, size + int(weight[end] - weight[i]), ids[end - 1]
            i = end
    if pieces:
        yield Chunk(country, pieces)


def write(path: str, arrays: list[np.ndarray]) -> None:
    """The arrays' types and lengths, then their bytes; wider types first keeps them aligned."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    head += b" " * (-len(head) % 64)
    store, name = locate(path)
    with store.open_output_stream(name, compression=None) as out:
        out.write(len(head).to_bytes(64, "little"))
        out.write(head)
        for a in arrays:
            out.write(np.ascontiguousarray(a).view(np.uint8) if a.size else b"")


def read(path: str, only: int | None = None) -> list[np.ndarray]:
    """What write() wrote, the first ``only`` arrays of it."""
    store, name = locate(path)
    out = []
    with pa.memory_map(name) if isinstance(store, LocalFileSystem) else store.open_input_file(name) as f:
        head = f.read(int.from_bytes(f.read(64), "little")).decode().strip()
        for kind, n in (x.split(",") for x in head.split(";")[:only]):
            size = np.dtype(kind).itemsize * int(n)
            out.append(np.frombuffer(f.read_buffer(size), dtype=kind) if size else np.zeros(0, kind))
    return out


def build(folder: str):
    """Writes blocks of sorted records and lists them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, name = locate(folder)
        store.create_dir(name, recursive=True)
        for c in chunks(batches, ROWS, ENTRIES):
            order = np.lexsort((c.rows, c.hashes))
            hashes, rows, name = c.hashes[order], c.rows[order].astype(np.int64), c.name[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
            hashes, rows, name = hashes[new], rows[new], name[new]
            first = np.flatnonzero(np.concatenate([np.ones(min(len(hashes), 1), bool), hashes[1:] != hashes[:-1]]))
            kind = np.uint16 if len(c.ids) <= 1 << 16 else np.uint32
            path = f"{folder}/{uuid.uuid4().hex}"
            write(path, [hashes[first], np.append(first, len(hashes)).astype(np.int64), c.ids, rows.astype(kind), name[first].astype(np.uint8)])
            yield pa.RecordBatch.from_pydict({"country": [c.country], "path": [path], "n": pa.array([c.n], pa.int64())})

    return run


def find(hashes: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Where each of the sorted ``asked`` is in the sorted ``hashes``; -1 if nowhere."""
    if not len(hashes):
        return np.full(len(asked), -1)
    at = np.searchsorted(hashes, asked).clip(max=len(hashes) - 1)
    return np.where(hashes[at] == asked, at, -1)


def frequencies(asked: np.ndarray, paths: list[str]) -> np.ndarray:
    """In how many records of the blocks each of the sorted features is."""
    df = np.zeros(len(asked), np.int64)
    for path in paths:
        hashes, begins = read(path, 2)
        at = find(hashes, asked)
        hit = at >= 0
        df[hit] += np.diff(begins)[at[hit]]
    return df


def weigh(df: np.ndarray, n: int) -> np.ndarray:
    return np.log1p(n / np.maximum(df, 1)) ** 2


def finish(index: dict[str, tuple[int, list[str]]]):
    """Writes, beside each block, its records' norms of name and address and their places among the ids of the country."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for country, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, paths = index[country]
                hashes, begins, ids, places, name = read(path)
                w = weigh(frequencies(hashes, paths), n)
                norms = []
                for side in (name == 1, name == 0):
                    norms.append(np.sqrt(np.bincount(places, np.repeat(np.where(side, w, 0.0), np.diff(begins)), len(ids))))
                place = np.zeros(len(ids), np.int64)
                for other in paths:
                    place += np.searchsorted(read(other, 3)[2], ids)
                write(beside := f"{path}-{uuid.uuid4().hex}", [*norms, place])
                yield pa.RecordBatch.from_pydict({"country": [country], "path": [path], "beside": [beside], "n": pa.array([n], pa.int64())})

    return run


def best(key: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest keys, ties by the lower ``tie``."""
    if len(key) <= k:
        return np.arange(len(key))
    cut = np.partition(key, len(key) - k)[len(key) - k]
    above, same = np.flatnonzero(key > cut), np.flatnonzero(key == cut)
    return np.concatenate([above, same[np.argsort(tie[same], kind="stable")[: k - len(above)]]])


def having(places: np.ndarray, begins: np.ndarray, at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The records of each of the features ``at``, one feature after the other, and the features' weights beside them."""
    starts, ends = begins[at], begins[at + 1]
    return np.concatenate([places[:0], *(places[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True))]), np.repeat(w, ends - starts)


def summed(who: np.ndarray, w: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct records of ``who`` and the sums of their weights; ``slot`` is room for a number a record, so that the time is that of ``who`` alone."""
    at = np.arange(len(who), dtype=slot.dtype)
    slot[who] = at
    hit = who[slot[who] == at]
    slot[hit] = at[: len(hit)]
    return hit, np.bincount(slot[who], w, len(hit))


def search(index: dict[str, tuple[int, list[tuple[str, str]]]], settings: Settings):
    """The best ``top_k`` of the ``rerank`` records that share most probes with a query, by their cosines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, QUERIES, QUERY_ENTRIES):
            if c.country in index:
                yield from answers(c, *index[c.country], settings)

    return run


def answers(c: Chunk, n: int, blocks: list[tuple[str, str]], settings: Settings) -> Iterator[pa.RecordBatch]:
    asked, of = np.unique(c.hashes, return_inverse=True)
    df = frequencies(asked, [path for path, _ in blocks])
    w = weigh(df, n)
    by_row = np.argsort(c.rows, kind="stable")  # of a row, the name's first, each side by group and feature
    bounds = np.searchsorted(c.rows[by_row], np.arange(len(c.ids) + 1))
    queries = []
    for i in range(len(c.ids)):
        mine = by_row[bounds[i] : bounds[i + 1]]
        mine = mine[df[of[mine]] > 0]
        sides = [of[mine[c.name[mine] == x]] for x in (True, False)]
        sides = [x[np.sort(np.unique(x, return_index=True)[1])] for x in sides]
        probes = [p[np.argsort(df[p], kind="stable")][:k] for x, k in zip(sides, (settings.probes_name, settings.probes_addr), strict=True) for p in [x[df[x] <= settings.max_df]]]
        queries.append((np.concatenate(probes), *sides, *[np.sqrt(w[x].sum()) for x in sides]))
    # which records share most weight of probes with each query
    kept: list[list[tuple]] = [[] for _ in queries]
    for b, (path, beside) in enumerate(blocks):
        hashes, begins, ids, places, _ = read(path)
        order = read(beside)[2]
        local = find(hashes, asked)
        slot = np.zeros(len(ids), np.int32)
        for i, (probe, *_) in enumerate(queries):
            at = local[probe]
            if len(probe := probe[at >= 0]):
                hit, acc = summed(*having(places, begins, at[at >= 0], w[probe]), slot)
                key = np.round(acc, 9)
                few = best(key, hit, settings.rerank)
                kept[i].append((key[few], order[hit[few]], np.full(len(few), b, np.int32), hit[few].astype(np.int32)))
                if sum(len(x[0]) for x in kept[i]) > settings.rerank:
                    key, tie, *rest = (np.concatenate(x) for x in zip(*kept[i], strict=True))
                    few = best(key, tie, settings.rerank)
                    kept[i] = [(key[few], tie[few], *[x[few] for x in rest])]
    pairs = [tuple(np.concatenate(x) for x in zip(*k, strict=True))[1:] if k else None for k in kept]
    del kept
    # their cosines over all features
    found: list[list[tuple]] = [[] for _ in queries]
    for b, (path, beside) in enumerate(blocks):
        hashes, begins, ids, places, _ = read(path)
        norms = read(beside)[:2]
        local = find(hashes, asked)
        slot = np.full(len(ids), -1, np.int32)
        count = np.where(local >= 0, np.diff(begins, append=begins[-1])[local], 0)
        dense = np.flatnonzero(count * DENSE > len(ids))
        dense = dense[np.argsort(-count[dense], kind="stable")[: FLAGS // max(len(ids), 1)]]
        flag = np.full(len(asked), -1)
        flag[dense] = np.arange(len(dense))
        flags = np.zeros((len(dense), len(ids)), np.uint8)
        for j, at in enumerate(local[dense].tolist()):
            flags[j, places[begins[at] : begins[at + 1]]] = 1
        for i, (_, name, addr, *own) in enumerate(queries):
            if pairs[i] is None or not len(mine := np.flatnonzero(pairs[i][1] == b)):
                continue
            d = pairs[i][2][mine]
            slot[d] = np.arange(len(d))
            cos = []
            for side, q_norm, d_norm in zip((name, addr), own, norms, strict=True):
                often = side[flag[side] >= 0]
                rare = side[(flag[side] < 0) & (local[side] >= 0)]
                who, weight = having(places, begins, local[rare], w[rare])
                known = (to := slot[who]) >= 0
                total = np.bincount(to[known], weight[known], len(d))
                if len(often):
                    total = total + w[often] @ flags[np.ix_(flag[often], d)]
                product = q_norm * d_norm[d]
                cos.append(np.divide(total, product, out=np.zeros(len(d)), where=product > 0))
            slot[d] = -1
            score = cos[0] + settings.addr_weight * cos[1]
            tie = pairs[i][0][mine]
            few = best(np.round(score, 9), tie, settings.top_k)
            found[i].append((score[few], tie[few], cos[0][few], cos[1][few], ids[d[few]]))
    out = []
    for i, x in enumerate(found):
        if x:
            score, tie, name, addr = (np.concatenate([y[k] for y in x]) for k in range(4))
            ids = [v for y in x for v in y[4].tolist()]
            few = np.lexsort((tie, -np.round(score, 9)))[: settings.top_k]
            out.append((np.full(len(few), i), [ids[j] for j in few.tolist()], name[few], addr[few], score[few], np.arange(len(few), dtype=np.int32)))
    if out:
        who, _, name, addr, score, rank = (np.concatenate(x) if k != 1 else x for k, x in enumerate(zip(*out, strict=True)))
        cand = [v.decode() for x in out for v in x[1]]
        own = [v.decode() for v in c.ids[who].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array([c.country] * len(own)), pa.array(own), pa.array(cand), *map(pa.array, (name, addr, score, rank))], names=[x.split(" ")[0] for x in FOUND.split(", ")])
