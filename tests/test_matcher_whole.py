"""The matcher's pairs over whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from linkspark import queries as own
from linkspark.functions import similarity as S
from linkspark.functions import strings
from linkspark.operators import longtexts
from linkspark.operators.pairs import FEATURES, labelled, pair_features, placed_pair_features
from linkspark.sources import tsv
from linkspark.sources.tsv import truth_pairs


class Seen(Exception):
    pass


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """Texts that part only behind their first 18 words, some of them equal, and one of no more than its name."""
    rng = random.Random(5)
    folder = str(tmp_path_factory.mktemp("matcher"))
    start = " ".join(f"same{i}" for i in range(18))
    tails = [" ".join(rng.choice(["rare", "12", "№", "stone"]) + str(rng.randrange(90)) for _ in range(rng.randrange(1, 400))) for _ in range(20)]
    rows = [(i, f"{start} {tails[rng.randrange(20)]}", "en") for i in range(240)] + [(240, "only a name", "en"), (241, "only a name", "en"), (242, None, "en"), (243, "", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_pairs_hold_whole_texts(spark, sf, monkeypatch):
    kept = []

    def look(rows, *_):
        kept.extend(rows.collect())
        raise Seen

    monkeypatch.setattr(tsv, "write_stage", look)
    with pytest.raises(Seen):
        own.queries()["gbt_matcher"](spark, sf)
    clean = {r.entity_id: r.addr_clean for r in own.view(spark, sf, whole=True).collect()}
    assert len(kept) > 300 and {r.label for r in kept} == {0, 1}
    assert max(len(x.split()) for x in clean.values() if x) > 300
    for r in kept:
        a, b = clean[r.s1_id], clean[r.cand_id]
        assert (r.a_len_l, r.a_len_r, r.a_ratio) == (len(a), len(b), int(S.ratio(a, b) + 0.5))
        assert r.label == (a == b)


def test_features_by_place_are_those_of_the_records(spark, sf, monkeypatch, tmp_path):
    monkeypatch.setattr(longtexts, "BYTES", 900)
    rows = own.full_view(spark, sf, whole=True)
    marked = F.concat(F.lit("near "), F.substring("addr_clean", -9, 9))
    rows = rows.withColumn("addr_landmark", F.when(F.col("entity_id").rlike("[0-4]$"), marked).otherwise(F.lit(""))).withColumn("name_alias", F.when(F.col("entity_id").rlike("[3-7]$"), "near | name").otherwise(""))
    rows = rows.fillna("").localCheckpoint()
    found = labelled(own.rounded(own.candidates(spark, sf, whole=True)), truth_pairs(own.truth_table(spark, sf)))
    stored = longtexts.put(rows, str(tmp_path)).localCheckpoint()
    assert not {*longtexts.LONG} & {*stored.columns}
    got = placed_pair_features(found, stored, stored, str(tmp_path), 3, also=("label",))
    want = pair_features(found, rows, rows, also=("label",))
    assert got.dtypes == want.dtypes and got.columns == ["s1_id", "cand_id", *FEATURES, "label"]
    got, want = ({(r.s1_id, r.cand_id): tuple(r) for r in x.collect()} for x in (got, want))
    assert got == want and len(got) > 300
    assert {r[2 + FEATURES.index("lm_sim")] for r in got.values()} > {255}


def test_scores_of_all_pairs(spark, sf):
    pairs = own.candidates(spark, sf, whole=True)
    assert own.queries()["gbt_matcher"](spark, sf).count() == pairs.count()


def test_common_subsequences_of_long_strings():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh शक्ति😀") for _ in range(n))
    left = [text(rng.choice([1, 62, 63, 64, 126, 127, 500, 2000])) for _ in range(150)] + ["a" * 127, "x" * 64, text(5000)]
    right = [text(rng.choice([1, 63, 64, 130, 700, 2100])) for _ in range(150)] + ["a" * 300, "y" * 700, text(9000)]
    want = [S.lcs(a, b) for a, b in zip(left, right, strict=True)]
    assert strings.lcs(left, right).tolist() == want
    order = sorted(range(len(left)), key=lambda i: -max(len(left[i]), len(right[i])))
    short, long = zip(*(sorted((left[i], right[i]), key=len) for i in order), strict=True)
    assert strings.bit_lcs(short, long).tolist() == [want[i] for i in order]
