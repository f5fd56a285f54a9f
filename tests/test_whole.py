"""The record view over whole texts."""

import random

import pytest

from linkspark import queries as own
from linkspark.operators import blocking


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(3)
    sf = str(tmp_path_factory.mktemp("whole"))
    start, tail = [f"same{i}" for i in range(18)], [f"rare{i}" for i in range(300)]
    rows = [(0, start + ["one"] + tail), (1, [f"other{i}" for i in range(18)] + tail), (2, start + ["two", "ends"]), (3, ["short", "text"]), (4, []), (5, ["a"] * 20_000 + ["last"])]
    rows += [(i, [f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 60))]) for i in range(6, 60)]
    spark.createDataFrame([(i, " ".join(w), "en") for i, w in rows], "doc_id long, text string, lang string").write.parquet(f"{sf}/documents.parquet")
    return sf, {f"S{1 + i % 3}-{i}": w for i, w in rows}


def test_records_hold_every_word(spark, tables):
    sf, words = tables
    got = {r.entity_id: r for r in own.scan_whole(spark, sf).collect()}
    assert got.keys() == words.keys()
    for i, w in words.items():
        assert got[i].business_name == " ".join(w[:6])
        assert got[i].business_address == ", ".join(" ".join(w[k : k + 3]) for k in range(6, len(w), 3))
    clean = {r.entity_id: r.addr_clean.split() for r in own.clean_whole(spark, sf).collect()}
    assert clean["S1-0"][-1] == "rare299" and clean["S3-2"][-1] == "ends" and clean["S3-5"][-1] == "last"


def test_features_and_candidates_of_whole_texts(spark, tables):
    sf, words = tables
    feats = {}
    for r in blocking.features(own.view(spark, sf, whole=True)).filter("grp = 'a'").collect():
        feats.setdefault(r.id, set()).add(r.feat)
    assert feats == {i: set(w[6:]) for i, w in words.items() if len(w) > 6}
    # texts that differ in their first 18 words alone meet, before the one that shares no more than these
    best = {r.s1_id: r for r in own.block_whole(spark, sf).filter("rank = 0").collect()}
    assert best["S1-0"].cand_id == "S2-1" and best["S1-0"].cos_addr > 0.8
