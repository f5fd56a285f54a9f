"""Candidate generation: rare-feature probing of an inverted index, exact cosines, top k; statistics and probes as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..settings import DEFAULT, Settings
from ..sources.shared import delete, fresh_dir, remove, stash
from . import postings as P

#: Feature groups; the first three are of the name, the others of the address.
NAME_GROUPS = ["n", "p", "c"]
#: Tasks at most among which records are dealt out.
TASKS = 20_000


def words(text: Column) -> Column:
    return F.filter(F.split(text, "(?U)\\s+"), lambda x: x != "")


def one(text: Column) -> Column:
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(text))


def bases() -> tuple[Column, Column]:
    """Words of the names of clean records and of their addresses."""
    return F.filter(F.concat(words(F.col("name_core")), words(F.col("name_alias"))), lambda t: t != "|"), words(F.col("addr_clean"))


def grouped(names: Column, addr: Column) -> dict[str, Column]:
    """Distinct features of clean records by group.

    n: words of core and aliases; p: their 4-character ends from 5 characters on; c: the
    core without blanks and its 5-character ends from 7 on; a: address words and the
    parts of compound ones; f: house number without zeros; z: postcode.
    """
    compact = one(F.replace("name_core", F.lit(" "), F.lit("")))
    groups = {
        "n": names,
        "p": T.affixes(names, 4, 5, ""),
        "c": F.concat(compact, T.affixes(compact, 5, 7, "c")),
        "a": F.concat(addr, T.compound_parts(addr)),
        "f": one(F.ltrim(F.col("addr_first_num"), F.lit("0"))),
        "z": one(F.col("addr_postcode")),
    }
    return {g: F.array_distinct(v) for g, v in groups.items()}


def features(clean: DataFrame) -> DataFrame:
    """(country, id, grp, feat), distinct, of clean records."""
    tagged = [F.arrays_zip(F.array_repeat(F.lit(g), F.size(feats)).alias("grp"), feats.alias("feat")) for g, feats in grouped(*bases()).items()]
    rows = clean.select("country", F.col("entity_id").alias("id"), F.explode(F.concat(*tagged)).alias("x"))
    return rows.select("country", "id", "x.grp", "x.feat")


def hashed(clean: DataFrame) -> DataFrame:
    """One row a record: country, id and 64-bit hashes of its features of name and of address, each by group and feature."""
    names, addr = bases()
    clean = clean.filter("country is not null").select("country", "entity_id", "name_core", "addr_first_num", "addr_postcode", names.alias("names"), F.array_distinct(addr).alias("words"))
    groups = grouped(F.col("names"), F.col("words"))
    of = lambda g: F.transform(F.sort_array(groups[g]), lambda x: F.xxhash64(F.lit(g), x))
    side = lambda name: F.concat(*[of(g) for g in sorted(groups) if (g in NAME_GROUPS) == name])
    rows = clean.select("country", F.col("entity_id").alias("id"), side(True).alias("name"), side(False).alias("addr"))
    none, known = F.array().cast("array<bigint>"), F.col("name").isNotNull() & F.col("addr").isNotNull()
    return rows.select("country", "id", *[F.when(known, F.col(s)).otherwise(none).alias(s) for s in ("name", "addr")])


def document_frequency(targets: DataFrame) -> DataFrame:
    """(country, grp, feat, df) over distinct (record, feature) rows of the target side."""
    return targets.groupBy("country", "grp", "feat").agg(F.count("*").alias("df"))


def weights(df: DataFrame, counts: DataFrame) -> DataFrame:
    """df and w = ln(1 + N/df)^2, with N the target records of the country; ``counts(country, n)``."""
    w = F.pow(F.log1p(F.col("n") / F.greatest(F.col("df"), F.lit(1))), F.lit(2.0))
    return df.join(counts, "country").select("country", "grp", "feat", "df", w.alias("w"))


def is_name() -> Column:
    return F.col("grp").isin(NAME_GROUPS)


def norms(weighted: DataFrame) -> DataFrame:
    """(country, id, norm_name, norm_addr) of records' weighted features."""
    part = lambda name: F.sqrt(F.sum(F.when(is_name() if name else ~is_name(), F.col("w")).otherwise(0.0)))
    return weighted.groupBy("country", "id").agg(part(True).alias("norm_name"), part(False).alias("norm_addr"))


def probes(queries: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Each query's rarest name and address features within max_df; ties by group and feature."""
    order = Window.partitionBy("country", "id", is_name()).orderBy("df", "grp", "feat")
    most = F.when(is_name(), settings.probes_name).otherwise(settings.probes_addr)
    return queries.filter(F.col("df") <= settings.max_df).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= most).drop("r")


def touched(probe: DataFrame, targets: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(country, q, d, acc): targets that share a probe with a query, by summed weight, the best ``rerank``.

    The join on the feature is the inverted index; max_df bounds what a probe brings.
    """
    q = probe.select("country", F.col("id").alias("q"), "grp", "feat", "w")
    d = targets.select("country", F.col("id").alias("d"), "grp", "feat")
    acc = q.join(d, ["country", "grp", "feat"]).groupBy("country", "q", "d").agg(F.sum("w").alias("acc"))
    order = Window.partitionBy("country", "q").orderBy(F.round("acc", 9).desc(), "d")
    return acc.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= settings.rerank).drop("r")


def dealt(clean: DataFrame, rows: int, least: int) -> DataFrame:
    """hashed() records, sorted by country and id, dealt out so that a task has about ``rows`` of a country or several small countries."""
    counts = clean.groupBy("country").agg(F.ceil(F.count("*") / rows).alias("_parts"))
    total = counts.agg(F.sum("_parts")).first()[0] or 1
    part = F.pmod(F.xxhash64("id"), F.col("_parts"))
    both = hashed(clean).join(F.broadcast(counts), "country").withColumn("_part", part)
    return both.repartition(max(least, min(int(total), TASKS)), "country", "_part").sortWithinPartitions("country", "id").drop("_parts", "_part")


def block(queries: DataFrame, targets: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Candidates of clean ``queries`` among clean ``targets`` of equal country: (country, s1_id, cand_id, cos_name, cos_addr, score, rank).

    Statistics come from the targets; query features unknown to them are dropped. Of the
    targets that share a probe with a query the ``rerank`` best by summed weight (as in
    touched()) are scored by cosines over all features, and the ``top_k`` best are kept; rank
    from 0, ties by id. The targets lie in an index that each task of queries reads, so
    that no pair but the kept ones is ever written.
    """
    spark = queries.sparkSession
    folder = fresh_dir(spark, "index")
    cores = spark.sparkContext.defaultParallelism
    listed = stash(dealt(targets, P.ROWS, cores).mapInArrow(P.build(folder), P.LISTED), "blocks")
    index: dict[str, tuple[int, list]] = {}
    for r in listed.collect():
        n, paths = index.get(r.country, (0, []))
        index[r.country] = n + r.n, [*paths, r.path]
    done = stash(listed.repartition(max(cores, listed.count())).mapInArrow(P.finish(index), P.FINISHED), "index-blocks")
    index = {c: (n, []) for c, (n, _) in index.items()}
    for r in done.collect():
        index[r.country][1].append((r.path, r.beside))
    found = stash(dealt(queries, P.QUERIES, 2 * cores).mapInArrow(P.search(index, settings), P.FOUND), "candidates")
    remove(spark, folder)
    delete(listed)
    delete(done)
    return found


def recall(candidates: DataFrame, truth: DataFrame, ks: tuple[int, ...] = (1, 3, 5, 10, 15, 20, 30, 40)) -> DataFrame:
    """(k, recall, recall_covered): share of true pairs among the first k candidates, of all and of those whose query has candidates."""
    covered = candidates.select("s1_id").distinct().withColumn("has", F.lit(True))
    hits = truth.join(candidates.select("s1_id", "cand_id", "rank"), ["s1_id", "cand_id"], "left").join(covered, "s1_id", "left")
    hit = lambda k: F.coalesce((F.col("rank") < k).cast("int"), F.lit(0))
    # one aggregation of all cuts
    one = hits.agg(*[F.struct(F.lit(k).alias("k"), F.avg(hit(k)).alias("recall"), F.avg(F.when(F.col("has"), hit(k))).alias("recall_covered")).alias(f"k{k}") for k in ks])
    return one.select(F.explode(F.array(*[f"k{k}" for k in ks])).alias("x")).select("x.*")
