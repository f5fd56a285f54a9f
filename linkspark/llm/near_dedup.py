"""MinHash near-duplicates by a multi-index Hamming join over b-bit signatures.

A signature has 32 symbols of 16 bits in 8 chunks of 4. Two documents whose signatures
differ in at most 15 symbols have, by the pigeonhole principle, a chunk with at most one
differing symbol. So each chunk is indexed four times, each time with one symbol left
out: the allowed error is enumerated, and equal keys find every pair within the
threshold. At a similarity of 0.85 more than 15 of 32 symbols differ once in about
290,000 pairs. Pairs that meet are refuted on their signatures beyond as many symbols as
pass that rate at the threshold (18 at 0.8), and links are confirmed on full sets of
shingles. A pair at 0.8 shares no key with a chance of 1.1e-6, one at 0.7 of 2.2e-4.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, delete, stash
from .textkernel import U, Words, list_array, mix, pieces

SYMBOLS, CHUNKS, LANES, BITS = 32, 8, 4, 16
#: Signatures that differ in up to so many symbols meet for certain.
DISTANCE = 15
#: Share of pairs at the threshold that may differ in more symbols than are compared further.
MISS = 3.6e-6
#: Documents that share a key and are still apart are paired up to this number, and beyond it block by block.
SMALL = 24
#: Documents and shingles of a block; pairs of one document that one task compares.
BLOCK, MASS, PLACE = 256, 1 << 19, 1024
SEEDS = mix(np.arange(1, SYMBOLS + 1, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
CHUNK_COLUMNS = [f"c{i}" for i in range(CHUNKS)]
SIGNATURE_SCHEMA = "n_shingles long, h1 long, h2 long, " + ", ".join(f"{c} long" for c in CHUNK_COLUMNS)


def shingle_sets(w: Words, size: int) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, sorted; with fewer words than ``size``, the whole sequence is one."""
    grams = w.grams(size)
    for lo, hi in zip(w.lo.tolist(), w.hi.tolist(), strict=True):
        if hi - lo >= size:
            yield np.unique(grams[lo : hi - size + 1])
        elif hi > lo:
            h = U(hi - lo)
            for x in w.hash[lo:hi]:
                h = mix((h + x) * U(0xD6E8FEB86659FD93))
            yield np.array([h], dtype=U)
        else:
            yield np.zeros(0, dtype=U)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of CHUNKS 64-bit words a set, each of LANES symbols; zeros for an empty set."""
    out = np.zeros((len(sets), CHUNKS), dtype=U)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out
    flat = np.concatenate([sets[i] for i in full])
    at = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    for j in range(SYMBOLS):
        least = np.minimum.reduceat((flat ^ SEEDS[-1 - j]) * SEEDS[j], at)
        out[full, j // LANES] |= (mix(least) & U(0xFFFF)) << U(BITS * (j % LANES))
    return out


def _texts(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias(key), F.col("text").cast("string").alias("text"))


def sketch(docs: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """(key, n_shingles, h1, h2, c0..c7) a row: set size, a 128-bit hash of the set, and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at, texts in pieces(batch):
                    sets = list(shingle_sets(Words(texts, lower=True), size))
                    sig = signatures(sets).view(np.int64)
                    sums = np.array([[mix(s ^ U(1)).sum(dtype=U), mix(s ^ U(2)).sum(dtype=U)] if len(s) else [0, 0] for s in sets], dtype=U).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(at, len(sets)), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(np.ascontiguousarray(sums[:, i])) for i in (0, 1)), *(pa.array(np.ascontiguousarray(sig[:, i])) for i in range(CHUNKS))],
                        names=[key, "n_shingles", "h1", "h2", *CHUNK_COLUMNS],
                    )

    return _texts(docs, key).mapInArrow(run, f"{key} long, {SIGNATURE_SCHEMA}")


def shingles(docs: DataFrame, size: int, key: str) -> DataFrame:
    """(key, set): the full shingle sets, for documents that have candidates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                for at, texts in pieces(batch):
                    sets = list(shingle_sets(Words(texts, lower=True), size))
                    flat = np.concatenate(sets).view(np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(sets)), list_array(flat, np.array([len(s) for s in sets]), pa.int64())], names=[key, "set"])

    return _texts(docs, key).mapInArrow(run, f"{key} long, set array<long>")


def index_keys() -> Column:
    """The keys of a signature: each chunk with each of its symbols left out."""
    keys = []
    for i, c in enumerate(CHUNK_COLUMNS):
        for lane in range(LANES):
            mask = ((1 << 64) - 1) ^ (0xFFFF << (BITS * lane))
            mask -= (1 << 64) if mask >> 63 else 0
            keys.append(F.xxhash64(F.lit(i * LANES + lane), F.col(c).bitwiseAND(F.lit(mask))))
    return F.array(*keys)


def distance(a: str, b: str) -> Column:
    """Number of symbols in which two signatures differ."""
    total = None
    for c in CHUNK_COLUMNS:
        x = F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))
        for lane in range(LANES):
            differs = F.when(F.shiftrightunsigned(x, BITS * lane).bitwiseAND(F.lit(0xFFFF)) != 0, 1).otherwise(0)
            total = differs if total is None else total + differs
    return total


def farthest(percent: int) -> int:
    """The number of differing symbols up to which a pair is compared on full sets, DISTANCE at least."""
    p = 1 - percent / 100
    beyond = lambda d: sum(comb(SYMBOLS, k) * p**k * (1 - p) ** (SYMBOLS - k) for k in range(d + 1, SYMBOLS + 1))
    return next(d for d in range(DISTANCE, SYMBOLS + 1) if beyond(d) <= MISS)


def linked(n_a: Column, n_b: Column, both: Column, percent: int) -> Column:
    return 100 * both >= percent * (n_a + n_b - both)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are linked.

    A document of very many pairs has its set sent to as many places as PLACE pairs each
    need, so that no task has more of them.
    """
    many = stash(pairs.groupBy("a").agg(F.ceil(F.count("*") / PLACE).cast("int").alias("places")), "near-places")
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), "places").cast("int").alias("place"))
    one = sets.join(many, F.col("id") == F.col("a")).select("a", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.col("set").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("set").alias("y"))
    # merged at every size: sets are never broadcast
    both = dealt.join(two.hint("merge"), "b").join(one.hint("merge"), ["a", "place"])
    both = both.select("a", "b", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("both"))
    return both.filter(linked(F.col("n"), F.col("m"), F.col("both"), percent)).select("a", "b")


def own_shingles(reps: DataFrame, sets: DataFrame) -> DataFrame:
    """``reps`` with ``own``, the number of a document's shingles that no other set of ``sets(id, set)`` holds; 0 where an id has several sets.

    A link needs shared shingles, so own ones bound it from above, whatever the partner.
    Shingles are counted by hash with partial sums.
    """
    alone = sets.select("id", F.explode("set").alias("s")).groupBy("s").agg(F.min("id").alias("id"), F.count("*").alias("n")).filter("n = 1")
    once = sets.groupBy("id").agg(F.count("*").alias("rows")).filter("rows = 1").select("id")
    counts = alone.groupBy("id").agg(F.count("*").cast("int").alias("own")).join(once, "id", "left_semi")
    return reps.join(counts, "id", "left").withColumn("own", F.coalesce("own", F.lit(0)))


def alike(x: str, y: str, percent: int) -> Column:
    """Whether sizes, own shingles and signatures of two documents allow a link."""
    n, m = F.col(f"{x}.n_shingles"), F.col(f"{y}.n_shingles")
    most = F.least(n - F.col(f"{x}.own"), m - F.col(f"{y}.own"))
    return linked(n, m, most, percent) & (distance(x, y) <= farthest(percent))


def compare_blocks(percent: int):
    """For two blocks of documents, the links between their components: signatures first, full sets where they allow, none inside a part already joined.

    A document that shares too few shingles with all of a block together is linked with
    none of it: one look instead of one a document.
    """
    most = farthest(percent)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ids, side = pdf["id"].to_numpy(), pdf["side"].to_numpy()
        order = np.lexsort((ids, side))
        ids, side = ids[order], side[order]
        # in the order in which they were sorted
        sets = [pdf["set"].iloc[i].view(U) for i in order]
        sizes = np.array([len(s) for s in sets])
        _, label = np.unique(pdf["c"].to_numpy()[order], return_inverse=True)
        lanes = np.stack([pdf[c].to_numpy()[order] for c in CHUNK_COLUMNS], axis=1).view(np.uint16).reshape(len(ids), SYMBOLS)
        parent = list(range(label.max() + 1))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        first = np.flatnonzero(side == 0)
        two = bool((side == 1).any())
        second = np.flatnonzero(side == 1) if two else first
        together = np.unique(np.concatenate([sets[j] for j in second])) if two else None
        out = []
        for i in first:
            if two:
                at = np.minimum(np.searchsorted(together, sets[i]), len(together) - 1)
                if 100 * int((together[at] == sets[i]).sum()) < percent * sizes[i]:
                    continue
            near = second[(second > i) & (label[second] != label[i])]
            near = near[(lanes[near] != lanes[i]).sum(axis=1) <= most]
            near = near[100 * np.minimum(sizes[near], sizes[i]) >= percent * np.maximum(sizes[near], sizes[i])]
            near = [j for j in near.tolist() if root(label[j]) != root(label[i])]
            if not near:
                continue
            flat, starts = np.concatenate([sets[j] for j in near]), np.cumsum([0] + [len(sets[j]) for j in near[:-1]])
            at = np.minimum(np.searchsorted(sets[i], flat), len(sets[i]) - 1)
            common = np.add.reduceat((sets[i][at] == flat).astype(np.int64), starts)
            for j, both in zip(near, common.tolist(), strict=True):
                if 100 * both >= percent * (sizes[i] + sizes[j] - both) and root(label[j]) != root(label[i]):
                    parent[root(label[j])] = root(label[i])
                    out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def left_over(members: DataFrame, joined: DataFrame, sets: DataFrame, sig: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of ``joined(node, component)`` among documents that share a key.

    A key whose documents, but for the leader that all were compared with, are in one
    component needs no more. Under the others those of up to SMALL documents pair them;
    the documents of larger ones go to blocks of about BLOCK documents or MASS shingles,
    formed by the largest key of each, and two blocks are compared once if any key is
    common to them, in one task of bounded size.
    """
    state = members.filter("id <> leader").join(joined, F.col("id") == F.col("node"), "left").select("key", "id", F.coalesce("component", "id").alias("c"))
    state = state.join(sig, "id")
    keys = state.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("s.n_shingles").cast("long")).alias("mass"), F.min("c").alias("low"), F.max("c").alias("high")).filter("low <> high")
    state = stash(state.join(keys.select("key", "n", "mass"), "key"), "near-state")

    few = state.filter(F.col("n") <= SMALL).select("key", F.struct("id", "c", "s.*").alias("x"))
    pairs = few.join(few.withColumnRenamed("x", "y"), "key").filter("x.id < y.id AND x.c <> y.c").filter(alike("x", "y", percent))
    pairs = stash(pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "near-pairs")

    hot = state.filter(F.col("n") > SMALL)
    home = hot.groupBy("id", "c").agg(F.max(F.struct("n", "mass", "key")).alias("h"), F.first("s").alias("s"))
    parts = F.greatest(F.ceil(F.col("h.n") / BLOCK), F.ceil(F.col("h.mass") / MASS))
    home = stash(home.select("id", "c", "s", F.xxhash64(F.col("h.key"), F.pmod(F.xxhash64("id"), parts)).alias("block")), "near-home")
    met = stash(hot.select("key", "id").join(home.select("id", "block"), "id").select("key", "block").distinct(), "near-met")
    meet = met.join(met.withColumnRenamed("block", "other"), "key").filter("block <= other").select("block", "other").distinct()
    meet = stash(meet, "near-meet")
    facts = home.select("block", "id", "c", *[F.col(f"s.{x}").alias(x) for x in CHUNK_COLUMNS]).join(sets.select("id", "set"), "id")
    columns = ["id", "c", "set", *CHUNK_COLUMNS]
    first = meet.join(facts, "block").select("block", "other", F.lit(0).alias("side"), *columns)
    second = meet.filter("block <> other").join(facts.withColumnRenamed("block", "other"), "other").select("block", "other", F.lit(1).alias("side"), *columns)
    far = first.union(second).groupBy("block", "other").applyInPandas(compare_blocks(percent), "a long, b long")
    out = stash(confirmed(pairs, sets, percent).union(far), "near-more")
    for table in (state, pairs, home, met, meet):
        delete(table)
    return out


def links(reps: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(node, component) of what is linked among ``reps(id, n_shingles, c0..c7)``, one for each distinct set; ``docs(id, text)`` has their texts.

    Shingles that only one document has tell what it can be linked with at most. One that
    has too many of them for any link is left out: most copies that differ too much are.
    Of the others under a key, that with the least share of own ones, the middle of a group
    of copies, is the leader, and the rest are first compared with it alone: work linear in
    the documents of a key, after which groups of near copies hang together. Only documents
    under a key that are still apart are then compared with each other (left_over), so that
    no link between components is lost; links within one would add nothing.
    """
    keys = stash(reps.select("id", F.explode(index_keys()).alias("key")), "near-keys")
    shared = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    found = stash(keys.join(shared, "key"), "near-shared")
    delete(keys)
    # texts are dealt by id once, for the join and for repeated rows alike
    wanted = found.select("id").distinct()
    texts = docs.join(wanted.hint("merge"), "id", "left_semi").withColumn("h", F.xxhash64("text")).dropDuplicates(["id", "h"])
    sets = stash(shingles(texts, size, "id"), "near-sets")
    facts = own_shingles(reps.join(wanted, "id", "left_semi"), sets)
    facts = stash(facts.filter(100 * (F.col("n_shingles") - F.col("own")) >= percent * F.col("n_shingles")), "near-facts")
    sig = facts.select("id", F.struct(*CHUNK_COLUMNS, "n_shingles", "own").alias("s"))
    held = found.join(facts.select("id", (F.col("own") / F.col("n_shingles")).alias("share")), "id")
    leaders = held.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("share", "id")).alias("first")).filter("n > 1").select("key", F.col("first.id").alias("leader"))
    members = stash(held.join(leaders, "key").select("key", "id", "leader"), "near-members")
    delete(found)

    star = members.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    star = star.join(sig.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(sig.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")
    star = stash(star.filter(alike("x", "y", percent)).select("a", "b"), "near-star")
    near = stash(confirmed(star, sets, percent), "near-links")
    first = components(near)
    more = left_over(members, first, sets, sig, percent)
    joined = first if more.isEmpty() else components(first.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    for table in (members, sets, facts, star, near, more):
        delete(table)
    return joined


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Near-duplicate classes of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Two rows are linked if their sets of ``size``-word shingles (words of whole texts,
    A-Z lower-cased) have a Jaccard similarity of at least ``percent`` percent.
    component_id is the smallest doc_id that links reach, kept says that it is the own.

    A null or empty text, or one without words, has no shingles and is linked with
    nothing. Rows that repeat a doc_id are rows of their own, each in the class of its
    text; classes with the same smallest doc_id are one. A null doc_id takes part in no
    class and has a null component_id and kept. Other columns are ignored. An empty
    table gives no rows.
    """
    slim = _texts(docs, "doc_id")
    sketches = stash(sketch(slim, size), "near-sketch")
    same = ["n_shingles", "h1", "h2"]
    # equal sets are one class, named by its smallest doc_id; only its representative is compared
    reps = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*same).agg(F.min("doc_id").alias("id"), *[F.first(c).alias(c) for c in CHUNK_COLUMNS])
    reps = stash(reps, "near-reps")
    joined = links(reps.drop("h1", "h2"), slim.withColumnRenamed("doc_id", "id"), size, percent)
    classes = reps.select(*same, "id").join(joined, F.col("id") == F.col("node"), "left").select(*same, F.coalesce("component", "id").alias("component_id"))
    out = sketches.select("doc_id", *same).join(classes, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).cast("long")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each class of linked rows, that with the smallest doc_id, with its columns; rows without shingles or doc_id all stay.

    Classes are those of near_duplicates(), but where a doc_id stands in several rows each
    of its texts is in a class of its own, told apart by a hash of doc_id and text.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL")
    if slim.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        gone = near_duplicates(docs, size, percent).filter(~F.col("kept")).select("doc_id")
        return docs.join(stash(gone, "near-gone"), "doc_id", "left_anti").select(*docs.columns)
    number = F.col("doc_id").cast("long")
    keyed = docs.withColumn("_key", F.when(number.isNotNull(), F.xxhash64(number, F.col("text").cast("string"))))
    ids = keyed.filter("_key IS NOT NULL").select("_key", number.alias("doc_id")).distinct()
    found = near_duplicates(keyed.filter("_key IS NOT NULL").select(F.col("_key").alias("doc_id"), "text"), size, percent)
    found = stash(found.filter("n_shingles > 0").select(F.col("doc_id").alias("_key"), "component_id").distinct(), "near-found")
    first = found.join(ids, "_key").groupBy("component_id").agg(F.min(F.struct("doc_id", "_key")).alias("m")).select("m._key")
    once = keyed.join(stash(first, "near-first"), "_key", "left_semi").dropDuplicates(["_key"])
    return keyed.join(found, "_key", "left_anti").select(*docs.columns).unionByName(once.select(*docs.columns))
