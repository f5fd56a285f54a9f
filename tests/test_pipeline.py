"""The staged pipeline and arrivals, end to end on small made-up sources."""

import random

from linkspark.operators.normalise import clean
from linkspark.plans.pipeline import Paths, Pipeline, main
from linkspark.settings import Settings
from linkspark.sources import tsv
from linkspark.streaming.arrivals import arriving, block_arrivals


def make(folder, split, rng, n):
    """Three sources of businesses; S2 and S3 hold noisy copies and strangers."""
    first, second, street = ["acme", "blue", "delta", "ganesh", "nova", "omega", "royal", "sun"], ["textiles", "foods", "motors", "pharma", "steel", "travel"], ["oak", "mg", "station", "park", "hill"]
    rows, truth = {1: [], 2: [], 3: []}, []
    for i in range(n):
        name, addr = f"{rng.choice(first)}{i} {rng.choice(second)} Private Limited", f"{rng.randrange(1, 99)} {rng.choice(street)} road, city {rng.randrange(500000, 500099)}"
        country, links = rng.choice(["India", "US"]), []
        rows[1].append((f"S1-{i}", name, addr, country))
        for s in (2, 3):
            if rng.random() < 0.6:
                noisy = name.replace("Private Limited", rng.choice(["Pvt Ltd", "Ltd", "pvt. ltd."]))
                rows[s].append((f"S{s}-{i}", noisy.upper() if rng.random() < 0.3 else noisy, addr.replace("road", "rd"), country))
                links.append(f"S{s}-{i}")
            rows[s].append((f"S{s}-x{i}", f"{rng.choice(first)} {rng.choice(second)}", f"{i} {rng.choice(street)} lane", country))
        truth.append((f"S1-{i}", ",".join(links)))
    for s, rs in rows.items():
        (folder / f"{split}_source{s}.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join("\t".join(r) + "\n" for r in rs))
    (folder / f"{split}_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join("\t".join(r) + "\n" for r in truth))


def test_end_to_end(spark, tmp_path):
    rng = random.Random(4)
    make(tmp_path, "train", rng, 150)
    make(tmp_path, "test", rng, 40)
    run = Pipeline(spark, Paths(str(tmp_path), str(tmp_path / "work"), str(tmp_path / "out")), Settings(fit_share=1, top_k=5), rounds=5)
    assert run.run()
    words = {(r.kind, r.noisy): r.canon for r in run.read("dictionary").filter("country = '_all'").collect()}
    assert words["addr", "rd"] == "road"
    rule = tsv.read_decision(spark, run.stage("decision"))
    assert rule["blocking_ceiling_f05"] > 0.95 and rule["f05"] > 0.8
    found = {r[0]: set(r[1].split(",")) - {""} for r in tsv.read_tsv(spark, str(tmp_path / "out" / "matching.tsv"), "a string, b string").collect()}
    want = {r[0]: set(r[1].split(",")) - {""} for r in tsv.read_tsv(spark, str(tmp_path / "test_ground_truth.tsv"), "a string, b string").collect()}
    assert found.keys() == want.keys()
    assert sum(found[k] == want[k] for k in want) > 0.8 * len(want)
    # the result is one file in the order of the references
    lines = (tmp_path / "out" / "matching.tsv").read_text().splitlines()
    assert [x.split("\t")[0] for x in lines] == ["source1_entity_id", *(f"S1-{i}" for i in range(40))]
    assert sorted(p.name for p in (tmp_path / "work" / "clean_train_1" / "data").glob("country=*")) == ["country=India", "country=US"]
    # nothing is written again while inputs and settings stand
    written = {p: p.stat().st_mtime_ns for p in (tmp_path / "work").rglob("*.parquet")}
    run.run(1, 5)
    assert written == {p: p.stat().st_mtime_ns for p in (tmp_path / "work").rglob("*.parquet")}
    # one country alone, in results of its own
    run.block(("test",), country="US")
    assert [r[0] for r in run.read("candidates_test_US").select("country").distinct().collect()] == ["US"]
    rows = run.report(50).collect()
    overall = {r.label: r for r in rows if r.country is None and r.source is None and r.native is None}
    assert overall[1].n == 50 and overall[1].clean_ratio > overall[0].clean_ratio
    base = ["--data", str(tmp_path), "--work", str(tmp_path / "work"), "--output", str(tmp_path / "out")]
    assert main(["validate", *base, "--check-ids"]) == 0
    assert main(["sample", *base, "--out", str(tmp_path / "small"), "--frac", "0.2"]) == 0
    kept = (tmp_path / "small" / "train_source1.tsv").read_text().splitlines()
    assert 5 < len(kept) < 80 and set(kept) <= set((tmp_path / "train_source1.tsv").read_text().splitlines())
    assert len((tmp_path / "small" / "train_ground_truth.tsv").read_text().splitlines()) == len(kept)


def test_stage_is_read_again_while_its_inputs_stand(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "i int, s string")
    tsv.write_stage(rows, str(tmp_path / "x"), stamp="1")
    other = spark.createDataFrame([(2, "b")], "i int, s string")
    assert tsv.write_stage(other, str(tmp_path / "x"), stamp="1").first().i == 1
    assert tsv.write_stage(other, str(tmp_path / "x"), stamp="2").first().i == 2
    assert tsv.fingerprint(rows) != tsv.fingerprint(other) and tsv.fingerprint(rows.union(other)) == tsv.fingerprint(other.union(rows))


def test_arrivals(spark, tmp_path):
    schema = "entity_id string, business_name string, business_address string, country string"
    targets = clean(spark.createDataFrame([("S2-1", "Acme Foods", "1 Oak Road", "US"), ("S2-2", "Nova Steel", "2 Hill Road", "US")], schema))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\tAcme Foods Ltd\t1 Oak Road\tUS\n")
    block_arrivals(arriving(spark, str(tmp_path / "in")), targets, str(tmp_path / "out"), str(tmp_path / "mark"), Settings(top_k=1)).awaitTermination()
    assert [r.cand_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["S2-1"]
