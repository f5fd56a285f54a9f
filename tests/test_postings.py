"""The inverted index and the search in it."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from linkspark.operators import blocking, postings
from linkspark.settings import Settings

SCHEMA = "entity_id string, country string, name_core string, name_alias string, addr_clean string, addr_first_num string, addr_postcode string"


def batch(rows):
    kinds = [pa.string(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["country", "id", "name", "addr"])


@pytest.mark.parametrize(("rows", "dense", "rerank"), [(7, 2, 3000), (7, 64, 9), (60_000, 3, 9)])
def test_search_by_all_pairs_over_any_blocks(tmp_path, monkeypatch, rows, dense, rerank):
    monkeypatch.setattr(postings, "ROWS", rows)
    monkeypatch.setattr(postings, "QUERIES", 5)
    monkeypatch.setattr(postings, "DENSE", dense)
    rng = random.Random(4)
    some = lambda a, b, n: sorted(rng.sample(range(a, b), n))
    make = lambda p, n: sorted((c, f"{p}-{i}", some(0, 30, rng.randrange(5)), some(100, 140, rng.randrange(9))) for i in range(n) for c in "xy"[i % 2])
    targets, queries = make("S2", 90), make("S1", 30)
    split = lambda rs: [batch(rs[i : i + 11]) for i in range(0, len(rs), 11)]
    listed = [(b.column(0)[0].as_py(), b.column(1)[0].as_py(), b.column(2)[0].as_py()) for b in postings.build(f"file://{tmp_path}/index")(iter(split(targets)))]
    assert len(listed) == (14 if rows == 7 else 2) and sum(n for *_, n in listed) == 90
    index = {c: (45, [p for k, p, _ in listed if k == c]) for c in "xy"}
    done = postings.finish(index)(iter([pa.RecordBatch.from_pydict({"country": [c], "path": [p]}) for c, p, _ in listed]))
    beside = {b.column(1)[0].as_py(): b.column(2)[0].as_py() for b in done}
    setting = Settings(probes_name=2, probes_addr=3, max_df=12, rerank=rerank, top_k=4)
    got = {}
    for b in postings.search({c: (n, [(p, beside[p]) for p in ps]) for c, (n, ps) in index.items()}, setting)(iter(split(queries))):
        for r in b.to_pylist():
            got.setdefault(r["s1_id"], []).append((r["cand_id"], round(r["score"], 7), r["rank"]))
    want = {}
    for c, q, *sides in queries:
        mine = [t for t in targets if t[0] == c]
        df = {f: sum(f in t[2] + t[3] for t in mine) for f in sides[0] + sides[1]}
        w = lambda f, mine=mine: math.log1p(45 / n) ** 2 if (n := sum(f in t[2] + t[3] for t in mine)) else 0
        probes = [f for s, k in zip(sides, (2, 3), strict=True) for f in sorted((f for f in s if 0 < df[f] <= 12), key=lambda f: df[f])[:k]]
        touched = sorted((-round(acc, 9), t[1], t) for t in mine if (acc := sum(w(f) for f in probes if f in t[2] + t[3])))[:rerank]
        scored = []
        for *_, t in touched:
            cos = [sum(w(f) for f in s if f in d) / (math.sqrt(sum(map(w, s)) * sum(map(w, d))) or 1) for s, d in zip(sides, t[2:], strict=True)]
            scored.append((-round(cos[0] + 1.3 * cos[1], 9), t[1]))
        if scored:
            want[q] = [(d, round(-s, 7), r) for r, (s, d) in enumerate(sorted(scored)[:4])]
    assert want and {k: [(d, r) for d, _, r in v] for k, v in got.items()} == {k: [(d, r) for d, _, r in v] for k, v in want.items()}
    assert all(np.allclose([x[1] for x in got[k]], [x[1] for x in want[k]], atol=1e-6) for k in want)


def test_search_takes_the_time_of_what_a_query_touches(tmp_path, monkeypatch):
    """A query that shares features with 3 of 2,000 records sums over these, not over the block."""
    targets = sorted(("x", f"S2-{i}", [i % 700], [1000 + i]) for i in range(2000))
    (listed,) = postings.build(f"file://{tmp_path}/index")(iter([batch(targets)]))
    path = listed.column(1)[0].as_py()
    (done,) = postings.finish({"x": (2000, [path])})(iter([listed]))
    sizes, count = [], np.bincount
    monkeypatch.setattr(postings.np, "bincount", lambda x, w=None, n=0: sizes.append(n) or count(x, w, n))
    found = list(postings.search({"x": (2000, [(path, done.column(2)[0].as_py())])}, Settings())(iter([batch([("x", "S1-1", [5], [1705])])])))
    assert sorted(found[0].column(2).to_pylist()) == ["S2-1405", "S2-5", "S2-705"]
    assert sizes and max(sizes) < 10


def written(spark) -> dict[int, int]:
    """Rows that each stage so far has written for others to read."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}


def test_pairs_are_not_shuffled(spark):
    """400 queries that share a probe with each of 400 targets: 160,000 pairs, of which 8,000 are kept."""
    make = lambda p: spark.createDataFrame([(f"{p}-{i}", "x", f"same own{i}", "", f"road {i}", "", "") for i in range(400)], SCHEMA)
    before = written(spark)
    assert blocking.block(make("S1"), make("S2")).count() == 8_000
    assert sum(n for k, n in written(spark).items() if k not in before) < 20_000


def test_features_are_hashed_once_in_order(spark):
    """Both sides' hashes are those of features(), by group and feature; repeated words count once."""
    rows = spark.createDataFrame([("1", "x", "ganesh textiles ganesh", "old | name", "12/3-b 004 mg road mg", "012", "560"), ("2", "x", "", "", "", "", ""), ("3", "x", None, "", "road", "", "")], SCHEMA)
    got = {r.id: (r["name"], r["addr"]) for r in blocking.hashed(rows).collect()}
    want = {"1": ([], []), "2": ([], []), "3": ([], [])}
    for r in blocking.features(rows).selectExpr("id", "grp", "feat", "xxhash64(grp, feat) h").orderBy("grp", "feat").collect():
        want[r.id][r.grp not in blocking.NAME_GROUPS].append(r.h)
    assert got == want and len(want["1"][0]) > 8
