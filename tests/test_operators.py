import math
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkspark.functions import similarity as S
from linkspark.functions import text as T
from linkspark.operators import blocking, decision, folds, mining, report, sample, validate
from linkspark.operators.competition import competition
from linkspark.settings import Settings
from linkspark.sources import tsv

words = st.lists(st.text("abc", min_size=1, max_size=4), max_size=4).map(" ".join)


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_similarities_are_symmetric_and_bounded(a, b):
    for f in (S.ratio, S.token_set, S.token_sort, S.partial, S.partial_token_set):
        assert f(a, b) == pytest.approx(f(b, a)) and 0 <= f(a, b) <= 100
    assert S.jaro_winkler(a, b) == pytest.approx(S.jaro_winkler(b, a)) and 0 <= S.jaro_winkler(a, b) <= 1
    assert S.partial(a, b) >= S.ratio(a, b) - 1e-9 or len(a) != len(b)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=9), st.text("ab", max_size=9))
def test_lcs_by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0, *row]
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j + 1] + 1 if x == y else max(new[-1], row[j + 2]))
        row = new
    assert S.lcs(a, b) == row[-1]


def test_edge_rules():
    assert S.ratio("", "") == 100 and S.token_set("", "") == 0 and S.token_sort("", "") == 100 and S.jaro_winkler("", "") == 1
    assert S.partial("", "a") == 0 and S.ratio("kitten", "sitting") == pytest.approx(800 / 13)
    assert S.token_set("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4) and S.partial("abc", "xxabcxx") == 100


def test_similarity_columns(spark):
    rows = spark.createDataFrame([("a b", "b c"), ("", "x"), ("12", "12")], "a string, b string")
    got = rows.select(S.set_jaccard(F.col("a"), F.col("b")).alias("j"), S.agree(F.col("a"), F.col("b")).alias("g"), S.indel_ratio("a", "b").alias("r")).collect()
    assert [(round(r.j, 3), r.g, r.r) for r in got] == [(0.333, -1, 33), (0.0, 0, 0), (1.0, 1, 100)]
    cases = [("abc", "axbxc", True), ("cb", "axbxc", False), ("", "a", True)]
    got = spark.createDataFrame(cases, "a string, b string, w boolean").select(S.is_subsequence(F.col("a"), F.col("b")).alias("s"), "w").collect()
    assert all(r.s == r.w for r in got)


def test_romanisation():
    assert T.romanised("भारत") == "bharat" and T.romanised("Привет") == "privet" and T.romanised("é12/3") == "e12/3" and T.romanised("४२") == "42"


def test_folds(spark):
    ids = [f"S1-{i:05d}" for i in range(1, 9)]
    got = spark.createDataFrame([(i,) for i in ids], "e string").select("e", folds.crc(F.col("e")).alias("a"), folds.crc(F.col("e"), "fit:").alias("b"), folds.crc(F.col("e"), "stop:").alias("c"), folds.crc(F.col("e"), "s1:").alias("d")).collect()
    assert [(r.a % 5, r.b % 5, r.c % 4, r.d % 1_000_000) for r in got][:3] == [(4, 3, 0, 336001), (3, 1, 2, 117947), (3, 3, 0, 444269)]
    assert all(r.a == zlib.crc32(r.e.encode()) for r in got)


def test_features_of_a_record(spark):
    clean = spark.createDataFrame([("1", "in", "ganesh textiles", "", "12/3-b 004 mg road", "12", "")], "entity_id string, country string, name_core string, name_alias string, addr_clean string, addr_first_num string, addr_postcode string")
    got = {}
    for r in blocking.features(clean).collect():
        got.setdefault(r.grp, set()).add(r.feat)
    assert got == {"n": {"ganesh", "textiles"}, "p": {"<gane", ">nesh", "<text", ">iles"}, "c": {"ganeshtextiles", "c<ganes", "c>tiles"}, "a": {"12/3-b", "004", "mg", "road", "12", "3", "b", "4"}, "f": {"12"}}


def test_weights(spark):
    df = spark.createDataFrame([("x", "n", "a", 1), ("x", "n", "b", 2), ("x", "n", "c", 4)], "country string, grp string, feat string, df long")
    got = blocking.weights(df, spark.createDataFrame([("x", 4)], "country string, n long")).collect()
    assert {r.feat: round(r.w, 6) for r in got} == {"a": 2.590290, "b": 1.206949, "c": 0.480453}


def test_blocking_by_all_pairs(spark):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(40)]
    schema = "entity_id string, country string, name_core string, name_alias string, addr_clean string, addr_first_num string, addr_postcode string"
    make = lambda p, n: [(f"{p}-{i}", rng.choice("xy"), " ".join(rng.sample(vocabulary, 3)), "", " ".join(rng.sample(vocabulary, 4)), str(rng.randrange(9)), "") for i in range(n)]
    q, t = spark.createDataFrame(make("S1", 25), schema), spark.createDataFrame(make("S2", 60) + [("S3-z", "zz", "only here", "", "", "", "")], schema)
    got = blocking.block(q, t, Settings(probes_name=99, probes_addr=99, top_k=5)).collect()
    feats = {}
    for r in blocking.features(q.union(t)).collect():
        feats.setdefault((r.country, r.id), set()).add((r.grp, r.feat))
    targets = {k: v for k, v in feats.items() if not k[1].startswith("S1")}
    n, df = {}, {}
    for (c, _), fs in targets.items():
        n[c] = n.get(c, 0) + 1
        for f in fs:
            df[c, f] = df.get((c, f), 0) + 1
    weight = {(c, f): math.log1p(n[c] / d) ** 2 for (c, f), d in df.items()}
    is_name = lambda f: f[0] in blocking.NAME_GROUPS
    norm = lambda c, fs, name: math.sqrt(sum(weight.get((c, f), 0) for f in fs if is_name(f) == name))
    want = {}
    for (c, i), fs in feats.items():
        if i.startswith("S1"):
            scores = []
            for (d, j), gs in targets.items():
                if c == d and any((c, f) in weight for f in fs & gs):
                    cos = [sum(weight[c, f] for f in fs & gs if is_name(f) == name) / ((norm(c, fs, name) * norm(c, gs, name)) or 1) for name in (True, False)]
                    scores.append((-round(cos[0] + 1.3 * cos[1], 9), j))
            want[i] = [j for _, j in sorted(scores)[:5]]
    have = {}
    for r in sorted(got, key=lambda r: r.rank):
        have.setdefault(r.s1_id, []).append(r.cand_id)
        assert 0 <= r.cos_name <= 1 + 1e-9 and 0 <= r.cos_addr <= 1 + 1e-9
    assert have == {k: v for k, v in want.items() if v}


def test_competition(spark):
    rows = [("q", "S2-1", 0.9), ("q", "S3-2", 0.9), ("q", "S2-3", 0.5), ("r", "S2-3", 0.7)]
    got = {(r.s1_id, r.cand_id): r for r in competition(spark.createDataFrame([(*r, r[2], 0.0) for r in rows], "s1_id string, cand_id string, score double, cos_name double, cos_addr double")).collect()}
    a, c, only = got["q", "S2-1"], got["q", "S2-3"], got["r", "S2-3"]
    assert (a.q_gap, a.q_n, a.q_rank_src, a.q_margin, a.is_s3) == (0, 3, 0, 0, 0)
    assert c.q_gap == pytest.approx(0.4) and c.q_margin == pytest.approx(-0.4) and c.q_rank_src == 1 and c.c_rank == 1
    assert only.q_margin == pytest.approx(0.7) and only.c_margin == pytest.approx(0.2)


def test_macro_f05(spark):
    truth = spark.createDataFrame([("a", "47"), ("a", "812"), ("d", "4"), ("e", "4")], "s1_id string, cand_id string")
    predicted = spark.createDataFrame([("a", "47"), ("a", "193"), ("a", "812"), ("c", "4"), ("e", "4")], "s1_id string, cand_id string")
    entities = spark.createDataFrame([(x,) for x in "abcde"], "s1_id string")
    assert decision.macro_f05(entities, truth, predicted).first().f05 == pytest.approx((0.7142857 + 1 + 0 + 0 + 1) / 5, abs=1e-6)
    assert decision.macro_f05(entities, truth.limit(0), truth.limit(0)).first().f05 == 1


def test_mining(spark):
    def run(pairs):
        rows = [(str(i), "us", kind, side, p, t) for i, (kind, a, b) in enumerate(pairs) for side, s in ((1, a), (2, b)) for p, t in enumerate(s.split())]
        votes, insertions = mining.aligned(spark.createDataFrame(rows, "pair string, country string, kind string, side int, pos int, tok string"))
        return votes, insertions

    votes, insertions = run([("name", "main road", "main raod"), ("name", "a b", "a x y"), ("name", "acme", "acme services")])
    assert sorted((r.noisy, r.canon) for r in votes.collect()) == [("a", "a"), ("acme", "acme"), ("main", "main"), ("raod", "road")]
    assert [(r.place, r.tok, r.n) for r in insertions.collect()] == [("last", "services", 1)]
    votes, _ = run([("name", "main road", "main raod")] * 3 + [("name", "main road", "main raod2")] * 2)
    got = mining.dictionary(mining.vote_counts(votes)).collect()
    assert sorted((r.country, r.noisy, r.canon) for r in got) == [("_all", "raod", "road"), ("us", "raod", "road")]


def test_tsv(spark, tmp_path):
    path = tmp_path / "a.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"x\\y"\t\tUS\nS1-2\t a \tnull\t\nS1-3\té\tb,c\tIndia\n', "utf-8")
    got = [tuple(r) for r in tsv.read_tsv(spark, str(path)).collect()]
    assert got == [("S1-1", '"x\\y"', "", "US"), ("S1-2", " a ", "null", ""), ("S1-3", "é", "b,c", "India")]
    rows = spark.createDataFrame([("b", "x,y"), ("a", None)], "source1_entity_id string, matched_entity_ids string")
    tsv.write_tsv(rows, str(tmp_path / "out"), ["source1_entity_id"])
    assert (tmp_path / "out").read_text() == "source1_entity_id\tmatched_entity_ids\na\t\nb\tx,y\n" and not (tmp_path / "out.parts").exists()
    many = spark.range(1000).repartition(7).selectExpr("cast(id as string) AS a", "concat('é', id) AS b", "-id AS place")
    tsv.write_tsv(many, str(tmp_path / "out"), ["place"], ["a", "b"])
    assert (tmp_path / "out").read_text() == "a\tb\n" + "".join(f"{i}\té{i}\n" for i in reversed(range(1000)))
    ordered = tsv.read_tsv_in_order(spark, str(path)).orderBy("_place").collect()
    assert [r.entity_id for r in ordered] == ["S1-1", "S1-2", "S1-3"]
    rows.write.parquet(str(tmp_path / "t.parquet"))
    assert sorted(map(tuple, tsv.read_truth(spark, str(tmp_path / "t.parquet")).collect())) == [("a", ""), ("b", "x,y")]
    words = spark.createDataFrame([("name", "us", "é", "e"), ("addr", "_all", "a/b", "c")], "kind string, country string, noisy string, canon string")
    tsv.write_dictionary(words, str(tmp_path / "d"))
    assert sorted(map(tuple, tsv.read_dictionary(spark, str(tmp_path / "d")).collect())) == sorted(map(tuple, words.collect()))


def test_validator(spark, tmp_path):
    required = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1_id string")

    def run(text, candidates=None, known=None):
        (tmp_path / "m.tsv").write_text(text)
        other = None
        if candidates is not None:
            (tmp_path / "c.tsv").write_text(candidates)
            other = str(tmp_path / "c.tsv")
        found = validate.validate(spark, str(tmp_path / "m.tsv"), other, required, known)
        return {(r.rule, r.severity): (r.n, r.examples) for r in found.collect()}

    head, other = "source1_entity_id\tmatched_entity_ids\n", "source1_entity_id\tcandidate_entity_ids\n"
    good = head + "S1-1\tS2-1,S3-2\nS1-2\t\nS1-3\tS2-9\n"
    assert run(good, other + "S1-1\tS2-1,S3-2\nS1-2\t\nS1-3\tS2-9\n") == {}
    assert list(run(good)) == [("file_missing", "warning")]
    assert run("a,b\n") | {} == {("comma_separated", "error"): (1, []), ("file_missing", "warning"): (1, [])}
    assert ("header", "error") in run("x\ty\n") and ("empty", "error") in run("")
    bad = run(head + "S1-1\tS2-1,S2-1\nS1-1\tS1-2\nline\nS1-2\tX-1,\nS1-9\tS2-7\n")
    assert {k for k, s in bad if s == "error"} == {"repeated_id", "duplicate_row", "self_match", "malformed", "wrong_prefix", "missing", "extra"}
    assert bad["missing", "error"] == (1, ["S1-3"])
    again = run(good + head)
    assert again["extra", "error"] == (1, ["source1_entity_id"]) and again["wrong_prefix", "error"] == (1, ["matched_entity_ids"])
    assert run(good, other + "S1-1\tS2-1\nS1-2\t\nS1-3\tS2-9\n")["not_in_candidates", "warning"] == (1, ["S1-1 S3-2"])
    known = spark.createDataFrame([("S2-1",), ("S2-9",)], "id string")
    assert run(good, None, known)["unknown", "error"] == (1, ["S3-2"])


def test_samples_keep_true_matches(spark):
    one = spark.createDataFrame([(f"S1-{i}",) for i in range(200)], "entity_id string")
    two = spark.createDataFrame([(f"S2-{i}",) for i in range(200)], "entity_id string")
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(200)], "source1_entity_id string, matched_entity_ids string")
    got = sample.sample_train(one, two, two.limit(0), truth, 0.1)
    kept = {r.entity_id[3:] for r in got["s1"].collect()}
    assert 5 < len(kept) < 40 and kept <= {r.entity_id[3:] for r in got["s2"].collect()}
    assert got["truth"].count() == len(kept)


def test_rows_are_numbered_in_parts(spark):
    rows = [(f"k{i % 3}", i * 7919 % 1000, str(i)) for i in range(3000)]
    got = folds.numbered(spark.createDataFrame(rows, "k string, v long, t string"), ["k"], F.shiftright("v", 7), ["v", "t"]).collect()
    want = {}
    for k in ("k0", "k1", "k2"):
        want |= {t: n for n, (_, t) in enumerate(sorted((v, t) for x, v, t in rows if x == k), 1)}
    assert {r.t: r.rn for r in got} == want


def test_capped_rows_stay_spread(spark):
    rows = spark.range(5000, numPartitions=5).selectExpr("cast(id as string) AS a", "id % 10 AS b")
    order = sorted((zlib.crc32(f"0:{i}:{i % 10}".encode()), str(i)) for i in range(5000))
    for n in (0, 1, 777, 4999, 5000, 9000):
        got = folds.capped(rows, n, "a", "b")
        assert sorted(r.a for r in got.collect()) == sorted(x for _, x in order[:n])
    assert folds.capped(rows, 2500, "a", "b").select(F.spark_partition_id().alias("p")).distinct().count() > 3
    # rows that share their hash
    same = spark.createDataFrame([("x", i) for i in range(50)] + [("y", i) for i in range(50)], "a string, i int")
    assert folds.capped(same, 60, "a").count() == 60 and folds.capped(same.limit(0), 5, "a").count() == 0


def test_rivals_of_a_hot_candidate(spark):
    scores = [((i * 37) % 101) / 50 for i in range(600)]
    rows = spark.createDataFrame([(f"q{i:03d}", "S2-1", s, 0.0, 0.0) for i, s in enumerate(scores)], "s1_id string, cand_id string, score double, cos_name double, cos_addr double")
    order = sorted(range(600), key=lambda i: (-scores[i], i))
    got = {r.s1_id: r for r in competition(rows).collect()}
    for at, i in enumerate(order):
        r = got[f"q{i:03d}"]
        assert (r.c_n, r.c_rank) == (600, at) and r.c_gap == pytest.approx(scores[order[0]] - scores[i])
        assert r.c_margin == pytest.approx(scores[i] - (scores[order[1]] if scores[i] == scores[order[0]] else scores[order[0]]))


def test_alphabets():
    assert [T.romanised(x) for x in ("москва", "щука", "αθήνα", "שלום", "شركة", "पार्क", "東京")] == ["moskva", "shchuka", "athena", "shlvm", "shrkh", "park", ""]


def test_norm(spark):
    got = spark.createDataFrame([("Déjà—Vu, 2nd! ",), ("ＡＢＣ ﬁ",), ("",), (None,)], "t string").select(T.norm(F.col("t"))).collect()
    assert [r[0] for r in got] == ["deja vu 2nd", "abc fi", "", None]


def test_sequence_ratio(spark):
    from difflib import SequenceMatcher

    rows = [("small ring", "red widget"), ("abcd", "bcde"), ("", ""), ("a", "")]
    got = spark.createDataFrame(rows, "a string, b string").select(S.seq_ratio("a", "b")).collect()
    assert [r[0] for r in got] == pytest.approx([SequenceMatcher(None, a, b).ratio() for a, b in rows])


def test_reports_on_empty_tables(spark):
    empty = spark.createDataFrame([], "entity_id string, country string, text string")
    assert report.field_stats(empty, ["text"]).count() == 0 and report.value_counts(empty, "country").count() == 0
    assert report.random_negatives(empty, empty).count() == 0
