"""The staged pipeline: mine, clean, block, features, train, predict, write, validate.

    python -m linkspark.plans.pipeline [STEP or REPORT] --data DIR --work DIR --output DIR [options]

DIR holds {train,test}_source{1,2,3}.tsv and train_ground_truth.tsv. Each stage writes
Parquet to the work folder, clean records and candidates in a folder a country, beside a
stamp of its inputs and settings; a stage whose stamp hasn't changed is left as it is,
unless --force is given. Without a step all are run.
"""

from __future__ import annotations

import argparse
import hashlib
import os
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, decision, folds, matcher, mining, normalise, pairs, report, sample, validate
from ..schemas import TRUTH
from ..settings import DEFAULT, Settings
from ..sources import tsv

STEPS = ["mine", "clean", "block", "features", "train", "predict", "validate"]
SPLITS = ("train", "test")


@dataclass
class Paths:
    data: str
    work: str
    output: str

    @classmethod
    def from_environment(cls) -> Paths:
        """ER_DATA_DIR, ER_WORK_DIR and ER_OUTPUT_DIR."""
        get = os.environ.get
        return cls(get("ER_DATA_DIR", "data"), get("ER_WORK_DIR", "work"), get("ER_OUTPUT_DIR", "output"))


class Pipeline:
    def __init__(self, spark: SparkSession, paths: Paths, settings: Settings = DEFAULT, rounds: int = 60, force: bool = False):
        self.spark, self.paths, self.settings, self.rounds, self.force = spark, paths, settings, rounds, force

    def raw(self, split: str, n: int) -> DataFrame:
        return tsv.read_tsv(self.spark, f"{self.paths.data}/{split}_source{n}.tsv")

    def truth(self) -> DataFrame:
        return tsv.truth_pairs(tsv.read_truth(self.spark, f"{self.paths.data}/train_ground_truth.tsv"))

    def stage(self, name: str) -> str:
        return f"{self.paths.work}/{name}"

    def read(self, name: str) -> DataFrame:
        return tsv.read_stage(self.spark, self.stage(name))

    def stamp(self, *inputs: object) -> str:
        """One for the settings and the inputs: tables, whose rows are summed up, and names of stages, whose stamps count."""
        marks = [tsv.fingerprint(x) if isinstance(x, DataFrame) else tsv.read_stamp(self.spark, self.stage(x)) for x in inputs]
        return hashlib.sha256(repr((marks, self.settings, self.rounds)).encode()).hexdigest()

    def write(self, rows: DataFrame, name: str, stamp: str, parts: tuple[str, ...] = ()) -> None:
        if self.force or tsv.read_stamp(self.spark, self.stage(name)) != stamp:
            tsv.write_stage(rows, self.stage(name), parts)
            tsv.write_stamp(self.spark, self.stage(name), stamp)

    def mine(self) -> None:
        left, others = self.raw("train", 1), self.raw("train", 2).unionByName(self.raw("train", 3))
        stamp = self.stamp(left, others, self.truth())
        words, insertions = mining.mine(self.truth(), left, others, self.settings)
        self.write(words, "dictionary", stamp)
        self.write(insertions, "insertions", stamp)

    def clean(self, splits: tuple[str, ...] = SPLITS) -> None:
        words = self.read("dictionary")
        for split in splits:
            for n in (1, 2, 3):
                rows = self.raw(split, n)
                self.write(normalise.clean(rows, words), f"clean_{split}_{n}", self.stamp("dictionary", rows), ("country",))

    def sides(self, split: str, country: str | None = None) -> tuple[DataFrame, DataFrame]:
        """References and others of a split, of one country if it is named: then only its folders are read."""
        parts = [self.read(f"clean_{split}_{n}").filter(F.lit(country is None) | (F.col("country") == (country or ""))) for n in (1, 2, 3)]
        return parts[0], parts[1].unionByName(parts[2])

    def named(self, name: str, country: str | None) -> str:
        return name if country is None else f"{name}_{country}"

    def block(self, splits: tuple[str, ...] = SPLITS, mode: str | None = None, country: str | None = None) -> None:
        for split in splits:
            left, right = self.sides(split, country)
            asked = mode or ("fit" if split == "train" else "all")
            found = blocking.block(folds.query_filter(left, asked if split == "train" else "all", self.settings), right, self.settings)
            name = self.named(f"candidates_{split}", country)
            self.write(found, name, self.stamp(*(f"clean_{split}_{n}" for n in (1, 2, 3))) + asked, ("country",))

    def features(self, splits: tuple[str, ...] = SPLITS, country: str | None = None) -> None:
        for split in splits:
            left, right = self.sides(split, country)
            found = self.named(f"candidates_{split}", country)
            rows = self.read(found).drop("country")
            rows = pairs.labelled(rows, self.truth()) if split == "train" else rows
            rows = pairs.pair_features(rows, left, right, also=("label",) if split == "train" else ())
            inputs = [found, *(f"clean_{split}_{n}" for n in (1, 2, 3))]
            self.write(rows, self.named(f"pairs_{split}", country), self.stamp(*inputs, *([self.truth()] if split == "train" else [])))

    def train(self) -> None:
        stamp = self.stamp("pairs_train", self.truth())
        if not self.force and tsv.read_stamp(self.spark, self.stage("trained")) == stamp:
            return
        rows = self.read("pairs_train")
        model = matcher.train(rows, self.rounds, settings=self.settings)
        matcher.save(model, self.stage("model"))
        val = self.raw("train", 1).filter(folds.is_val(F.col("entity_id"))).select(F.col("entity_id").alias("s1_id"))
        # entities that stopped the boosting don't tune the rule
        val = val.filter(~folds.is_stop(F.col("s1_id")))
        truth = self.truth().join(val, "s1_id", "left_semi")
        scored = matcher.score(model, rows.join(val, "s1_id", "left_semi"))
        rule = decision.best_rule(decision.threshold_grid(val, truth, scored)).first()
        top = decision.ceiling(val, truth, scored).first()
        recall = [r.asDict() for r in blocking.recall(self.read("candidates_train"), truth).orderBy("k").collect()]
        tsv.write_decision({"f05": rule.f05, "threshold": rule.threshold, "assign_best": bool(rule.assign), "blocking_ceiling_f05": top.f05, "val_entities": top.entities, "recall": recall, "features": pairs.FEATURES, "importance": matcher.importance(model)}, self.spark, self.stage("decision"))
        tsv.write_stamp(self.spark, self.stage("trained"), stamp)

    def predict(self) -> None:
        """The result files, in the order of the test references."""
        rule = tsv.read_decision(self.spark, self.stage("decision"))
        scored = matcher.score(matcher.load(self.stage("model")), self.read("pairs_test"))
        places = tsv.read_tsv_in_order(self.spark, f"{self.paths.data}/test_source1.tsv").select(F.col("entity_id").alias("source1_entity_id"), "_place")
        entities = places.select(F.col("source1_entity_id").alias("s1_id"))
        taken = decision.decide(scored, rule["assign_best"], rule["threshold"])
        for name, rows, column in (("matching", taken, validate.MATCHED), ("candidates", scored, validate.CANDIDATES)):
            lists = decision.result_table(entities, decision.id_lists(rows, "prob"), column).join(places, "source1_entity_id")
            tsv.write_tsv(lists, f"{self.paths.output}/{name}.tsv", ["_place"], ["source1_entity_id", column])

    def sample(self, out: str, fraction: float) -> None:
        """A small consistent copy of the data set in ``out``, in the files' own order."""
        ordered = lambda split, n: tsv.read_tsv_in_order(self.spark, f"{self.paths.data}/{split}_source{n}.tsv")
        truth = tsv.read_tsv_in_order(self.spark, f"{self.paths.data}/train_ground_truth.tsv", TRUTH)
        kept = sample.sample_train(*(ordered("train", n) for n in (1, 2, 3)), truth, fraction)
        tables = {f"train_source{n}": kept[f"s{n}"] for n in (1, 2, 3)} | {"train_ground_truth": kept["truth"]}
        if exists(self.spark, f"{self.paths.data}/test_source1.tsv"):
            tests = sample.sample_test({f"ts{n}": ordered("test", n) for n in (1, 2, 3)}, fraction)
            tables |= {f"test_source{n}": tests[f"ts{n}"] for n in (1, 2, 3)}
        for name, rows in tables.items():
            tsv.write_tsv(rows, f"{out}/{name}.tsv", ["_place"], [c for c in rows.columns if c != "_place"])

    def report(self, n: int) -> DataFrame:
        """Similarities of ``n`` true and as many random pairs before and after cleaning, and the pairs themselves in the work folder."""
        left, right = self.sides("train")
        true = folds.capped(self.truth(), n, "s1_id", "cand_id")
        some = lambda rows: folds.capped(rows, n, "entity_id", seed=1)
        false = report.random_negatives(some(left), some(right)).select("s1_id", "cand_id")
        both = true.withColumn("label", F.lit(1)).unionByName(false.withColumn("label", F.lit(0)))
        rows = tsv.write_stage(report.measured(both, left, right), self.stage("pair_sample"))
        return report.cleaning_report(rows).orderBy(F.desc("label"), "country", "source", "native")

    def validate(self, matching: str | None = None, candidates: str | None = None, test: str | None = None, check_ids: bool = True) -> DataFrame:
        """Findings on the result files, those of the output folder unless others are named."""
        source = lambda n: tsv.read_tsv(self.spark, f"{test or self.paths.data}/test_source{n}.tsv")
        required = source(1).select(F.col("entity_id").alias("s1_id"))
        known = source(2).unionByName(source(3)).select(F.col("entity_id").alias("id")) if check_ids else None
        return validate.validate(self.spark, matching or f"{self.paths.output}/matching.tsv", candidates or f"{self.paths.output}/candidates.tsv", required, known)

    def run(self, first: int = 1, last: int = 99) -> bool:
        """Runs the steps from ``first`` to ``last``; whether the results, if validated, have no error."""
        ok = True
        for n, step in enumerate(STEPS, 1):
            if first <= n <= last:
                print(f"step {n}: {step}", flush=True)
                out = getattr(self, step)()
                if out is not None:
                    ok = passed(out)
        return ok


def passed(findings: DataFrame) -> bool:
    """Prints findings; whether none is an error."""
    rows = findings.collect()
    for r in rows:
        print(f"  {r.severity} {r.file} {r.rule}: {r.n} {r.examples}")
    ok = not any(r.severity == "error" for r in rows)
    print("PASS" if ok else "FAIL")
    return ok


def exists(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file)


def arguments() -> argparse.ArgumentParser:
    base = Paths.from_environment()
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", nargs="?", default="run", choices=["run", *STEPS, "sample", "report"])
    parser.add_argument("--data", default=base.data)
    parser.add_argument("--work", default=base.work)
    parser.add_argument("--output", default=base.output)
    parser.add_argument("--force", action="store_true", help="run stages whose inputs haven't changed too")
    parser.add_argument("--from-step", type=int, default=1, help="run: the first step")
    parser.add_argument("--to-step", type=int, default=99, help="run: the last step")
    parser.add_argument("--k", type=int, default=DEFAULT.top_k, help="block: candidates kept of a query")
    parser.add_argument("--rerank", type=int, default=DEFAULT.rerank, help="block: candidates scored of a query")
    parser.add_argument("--max-pairs", type=int, default=DEFAULT.max_pairs, help="mine: labelled pairs at most")
    parser.add_argument("--max-train-rows", type=int, default=DEFAULT.max_train_rows, help="train: rows at most")
    parser.add_argument("--rounds", type=int, default=60, help="train: trees at most")
    parser.add_argument("--only", choices=SPLITS, help="clean: this split alone")
    parser.add_argument("--split", choices=SPLITS, help="block, features: this split alone")
    parser.add_argument("--mode", choices=["val", "fit", "all"], help="block: the queries of the train split")
    parser.add_argument("--country", help="block, features: this country alone, in results of its own")
    parser.add_argument("--out", default="sample", help="sample: its folder")
    parser.add_argument("--frac", type=float, default=0.005, help="sample: its share")
    parser.add_argument("--n", type=int, default=200_000, help="report: true pairs, and random ones")
    parser.add_argument("--matching", help="validate: the file of matches")
    parser.add_argument("--candidate", help="validate: the file of candidates")
    parser.add_argument("--test-dir", help="validate: the folder of the test sources")
    parser.add_argument("--check-ids", action="store_true", help="validate: ids must be known")
    return parser


def main(args: list[str] | None = None) -> int:
    a = arguments().parse_args(args)
    settings = replace(DEFAULT, top_k=a.k, rerank=a.rerank, max_pairs=a.max_pairs, max_train_rows=a.max_train_rows)
    spark = SparkSession.builder.appName("linkspark").getOrCreate()
    line = Pipeline(spark, Paths(a.data, a.work, a.output), settings, a.rounds, a.force)
    splits = (a.split,) if a.split else SPLITS
    if a.command == "run":
        return int(not line.run(a.from_step, a.to_step))
    if a.command == "validate":
        return int(not passed(line.validate(a.matching, a.candidate, a.test_dir, a.check_ids)))
    if a.command == "report":
        for r in line.report(a.n).collect():
            print("\t".join("" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v) for v in r))
        return 0
    if a.command == "sample":
        line.sample(a.out, a.frac)
    elif a.command == "clean":
        line.clean((a.only,) if a.only else SPLITS)
    elif a.command == "block":
        line.block(splits, a.mode, a.country)
    elif a.command == "features":
        line.features(splits, a.country)
    else:
        getattr(line, a.command)()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
