"""Reports on fields, scripts, blocking keys, cleaning and dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from .folds import crc, numbered


def field_stats(rows: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """(by, field, n, empty_pct, mean_len, mean_tokens) of string columns."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c), F.lit("")).alias("v")) for c in columns]))
    tall = rows.select(*([by] if by else []), cells.alias("x")).select(*([by] if by else []), "x.field", "x.v")
    tokens = F.size(F.filter(F.split("v", "\\s+"), lambda t: t != ""))
    return tall.groupBy(*([by] if by else []), "field").agg(F.count("*").alias("n"), (100 * F.avg((F.col("v") == "").cast("int"))).alias("empty_pct"), F.avg(F.length("v")).alias("mean_len"), F.avg(tokens).alias("mean_tokens"))


def value_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, n, share)."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def top_values(rows: DataFrame, key: str, n: int) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(n)


def script_pivot(rows: DataFrame, text: str, key: str, source: str, sources: list[str]) -> DataFrame:
    """Share of records of each key that hold a script, a column a source, 0 where none."""
    sizes = rows.groupBy(key, source).agg(F.count("*").alias("all"))
    found = rows.select(key, source, F.explode(T.scripts(F.col(text))).alias("script")).groupBy(key, source, "script").agg(F.count("*").alias("n"))
    share = found.join(sizes, [key, source]).withColumn("share", F.col("n") / F.col("all"))
    return share.groupBy(key, "script").pivot(source, sources).agg(F.first("share")).na.fill(0.0)


def pattern_share(rows: DataFrame, column: str, patterns: dict[str, str]) -> DataFrame:
    """(pattern, pct) of rows that match."""
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("pattern"), F.col(column).rlike(v).cast("int").alias("hit")) for k, v in patterns.items()]))
    return rows.select(cells.alias("x")).groupBy("x.pattern").agg((100 * F.avg("x.hit")).alias("pct"))


def histogram(rows: DataFrame, value: Column, low: float, high: float, bins: int, *by: str) -> DataFrame:
    """(by, bucket, n); bucket 0 is below the range and bins + 1 from its end on."""
    return rows.groupBy(*by, F.width_bucket(value.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).alias("bucket")).agg(F.count("*").alias("n"))


def block_sizes(rows: DataFrame, key: Column, by: str) -> DataFrame:
    """(by, blocks, p50, p99, largest) of the groups that share a key."""
    sizes = rows.groupBy(by, key.alias("key")).agg(F.count("*").alias("n"))
    return sizes.groupBy(by).agg(F.count("*").alias("blocks"), F.percentile("n", 0.5).alias("p50"), F.percentile("n", 0.99).alias("p99"), F.max("n").alias("largest"))


#: Words that are no key.
STOP = ["the", "sri", "shri", "dr", "m", "s", "mr", "smt"]


def first_word(text: Column) -> Column:
    return F.coalesce(F.get(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: (x != "") & ~x.isin(STOP)), F.lit(0)), F.lit(""))


def longest_word(text: Column) -> Column:
    ranked = F.transform(F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: (x != "") & ~x.isin(STOP)), lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("x")))
    return F.coalesce(F.array_max(ranked)["x"], F.lit(""))


def key_recall(pairs: DataFrame, keys: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(key, recall): share of true pairs whose sides agree in a non-empty key, of each key and of any."""
    hits = {k: ((a == b) & (a != "")) for k, (a, b) in keys.items()}
    union = None
    for h in hits.values():
        union = h if union is None else union | h
    hits["any"] = union
    one = pairs.agg(*[F.avg(h.cast("int")).alias(k) for k, h in hits.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(f"`{k}`").alias("recall")) for k in hits])).alias("x")).select("x.*")


def key_checks(references: DataFrame, truth: DataFrame, pairs: DataFrame) -> DataFrame:
    """(check, n): repeated ids, references without a truth row, truth rows without reference, candidates linked more than once."""
    spark = references.sparkSession
    checks = {
        "repeated_ids": references.groupBy("entity_id").agg(F.count("*").alias("c")).filter("c > 1"),
        "no_truth": references.select(F.col("entity_id").alias("i")).join(truth.select(F.col("source1_entity_id").alias("i")), "i", "left_anti"),
        "no_reference": truth.select(F.col("source1_entity_id").alias("i")).join(references.select(F.col("entity_id").alias("i")), "i", "left_anti"),
        "linked_twice": pairs.groupBy("cand_id").agg(F.count_distinct("s1_id").alias("c")).filter("c > 1"),
    }
    out = spark.createDataFrame([], "check string, n long")
    for name, rows in checks.items():
        out = out.unionByName(rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("check"), "n"))
    return out


def random_negatives(references: DataFrame, others: DataFrame, seed: int = 0) -> DataFrame:
    """(s1_id, cand_id): records of one country paired by their places in orders fixed by a hash."""

    def placed(rows: DataFrame, name: str) -> DataFrame:
        hashed = rows.select("country", F.col("entity_id").alias(name), crc(F.col("entity_id"), f"{seed}:{name}:").alias("h"))
        return numbered(hashed, ["country"], F.shiftright("h", 20), ["h", name]).drop("h")

    return placed(references, "s1_id").join(placed(others, "cand_id"), ["country", "rn"]).select("country", "s1_id", "cand_id")


#: Measures of the cleaning report: a column of each side, and how the two are compared.
MEASURES = {
    "raw_ratio": ("business_name", S.indel_ratio), "raw_tset": ("business_name", S.token_set_ratio), "clean_ratio": ("name_clean", S.indel_ratio),
    "clean_tset": ("name_clean", S.token_set_ratio), "core_tset": ("name_core", S.token_set_ratio), "raw_addr_tset": ("business_address", S.token_set_ratio),
    "clean_addr_tset": ("addr_clean", S.token_set_ratio),
}
#: Its breakdowns, beside all rows of a label.
BREAKDOWNS = (("country", "source"), ("native",), ("country",), ("country", "native"))


def measured(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """``pairs(s1_id, cand_id, label)`` of clean records with country, source, native (a side has a native name) and MEASURES, each 0 to 1."""
    columns = sorted({c for c, _ in MEASURES.values()} | {"f_name_native"})
    side = lambda rows, key, n, *more: rows.select(F.col("entity_id").alias(key), *more, *[F.col(c).alias(f"{c}{n}") for c in columns])
    rows = pairs.select("s1_id", "cand_id", "label").join(side(left, "s1_id", 1, "country"), "s1_id").join(side(right, "cand_id", 2), "cand_id")
    values = [(f(f"{c}1", f"{c}2") / 100).alias(k) for k, (c, f) in MEASURES.items()]
    return rows.select("s1_id", "cand_id", "label", "country", F.substring("cand_id", 1, 2).alias("source"), (F.col("f_name_native1") | F.col("f_name_native2")).alias("native"), *values)


def cleaning_report(rows: DataFrame) -> DataFrame:
    """Mean measures of measured() rows by label, and by label and each of BREAKDOWNS; keys outside a breakdown are null."""
    sets = [[F.col("label")], *[[F.col("label"), *map(F.col, b)] for b in BREAKDOWNS]]
    return rows.groupingSets(sets, "label", "country", "source", "native").agg(F.count("*").alias("n"), *[F.avg(m).alias(m) for m in MEASURES])


def worst_pairs(rows: DataFrame, measure: str, n: int) -> DataFrame:
    """The ``n`` true pairs of measured() rows that are least alike by a measure; ties go to the smaller ids."""
    return rows.filter("label = 1").orderBy(measure, "s1_id", "cand_id").limit(n)


def size_histogram(rows: DataFrame, key: Column, by: str, bins: int = 20, high: float = 6.0) -> DataFrame:
    """(by, bucket, n): how many blocks have a size in each of ``bins`` steps of its decimal logarithm up to ``high``."""
    sizes = rows.groupBy(by, key.alias("key")).agg(F.count("*").alias("n"))
    return histogram(sizes.select(by, F.log10("n").alias("v")), F.col("v"), 0, high, bins, by)


def dictionary_coverage(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(country, n, covered): non-ASCII words ``(country, tok)`` and the share that a dictionary holds."""
    native = tokens.filter(F.col("tok").rlike("[^\\x00-\\x7f]"))
    known = words.select("country", F.col("noisy").alias("tok")).distinct().withColumn("hit", F.lit(1.0))
    rows = native.join(known, ["country", "tok"], "left")
    return rows.groupBy("country").agg(F.count("*").alias("n"), F.avg(F.coalesce("hit", F.lit(0.0))).alias("covered"))
