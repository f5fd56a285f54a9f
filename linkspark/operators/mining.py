"""Dictionaries mined from labelled pairs: noisy words and the canonical ones that they stand for."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import text as T
from ..settings import DEFAULT, Settings
from .folds import capped, is_val


def training_pairs(pairs: DataFrame, references: DataFrame, others: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(pair, country, name1, addr1, name2, addr2) of at most max_pairs labelled pairs outside the validation fold."""
    kept = capped(pairs.filter(~is_val(F.col("s1_id"))), settings.max_pairs, "s1_id", "cand_id")
    side = lambda rows, key, n: rows.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"name{n}"), F.col("business_address").alias(f"addr{n}"))
    left = side(references, "s1_id", 1).join(references.select(F.col("entity_id").alias("s1_id"), F.lower(F.trim("country")).alias("country")), "s1_id")
    rows = kept.join(left, "s1_id").join(side(others, "cand_id", 2), "cand_id")
    return rows.select(F.concat_ws(" ", "s1_id", "cand_id").alias("pair"), "country", "name1", "addr1", "name2", "addr2")


def sequences(pairs: DataFrame) -> DataFrame:
    """(pair, country, kind, side, pos, tok): words of names and addresses and whole components; addresses only where the noisy one isn't blank."""
    out = pairs.filter("addr2 IS NOT NULL")
    name = lambda n: T.name_tokens(T.nfkc_casefold_twice(F.col(f"name{n}")))
    comps = lambda n: T.components(T.nfkc_casefold(F.replace(f"addr{n}", F.lit(","), F.lit(T.COMMA))))
    rows = out.select("pair", "country", (F.trim("addr2") != "").alias("has"), *[name(n).alias(f"n{n}") for n in (1, 2)], *[comps(n).alias(f"c{n}") for n in (1, 2)])
    none = F.array().cast("array<string>")
    lists = []
    for n in (1, 2):
        c = F.col(f"c{n}")
        lists += [
            F.struct(F.lit("name").alias("kind"), F.lit(n).alias("side"), F.col(f"n{n}").alias("toks")),
            F.struct(F.lit("addr").alias("kind"), F.lit(n).alias("side"), F.when(F.col("has"), F.flatten(c)).otherwise(none).alias("toks")),
            F.struct(F.lit("comp").alias("kind"), F.lit(n).alias("side"), F.when(F.col("has"), F.transform(c, lambda x: F.array_join(x, " "))).otherwise(none).alias("toks")),
        ]
    rows = rows.select("pair", "country", F.explode(F.array(*lists)).alias("x")).select("pair", "country", "x.kind", "x.side", F.posexplode("x.toks").alias("pos", "tok"))
    return rows


def aligned(tokens: DataFrame, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(votes, insertions) of ``tokens(pair, country, kind, side, pos, tok)``; side 1 is canonical, 2 noisy.

    Equal words match as multisets: the nth of one side with the nth of the other, which
    votes for itself. What is left on both sides is matched by place if it is as long on
    both, and not over max_residual. Votes are (country, kind, noisy, canon).
    insertions(place, tok) counts single noisy words left over in names that match otherwise.
    """
    key = ["pair", "country", "kind"]
    nth = tokens.withColumn("occ", F.row_number().over(Window.partitionBy(*key, "side", "tok").orderBy("pos")))
    one, two = nth.filter("side = 1").drop("side"), nth.filter("side = 2").drop("side")
    same = ["pair", "country", "kind", "tok", "occ"]
    equal = two.join(one.select(*same), same, "left_semi").select("country", "kind", F.col("tok").alias("noisy"), F.col("tok").alias("canon"))
    left = one.join(two.select(*same), same, "left_anti").withColumn("side", F.lit(1))
    right = two.join(one.select(*same), same, "left_anti").withColumn("side", F.lit(2))
    rest = left.unionByName(right).withColumn("i", F.row_number().over(Window.partitionBy(*key, "side").orderBy("pos")))
    sizes = rest.groupBy(*key).agg(F.count_if(F.col("side") == 1).alias("n1"), F.count_if(F.col("side") == 2).alias("n2"))
    fits = sizes.filter((F.col("n1") == F.col("n2")) & (F.col("n1") <= settings.max_residual)).select(*key)
    a = rest.filter("side = 1").select(*key, "i", F.col("tok").alias("canon"))
    b = rest.filter("side = 2").select(*key, "i", F.col("tok").alias("noisy"))
    placed = b.join(fits, key, "left_semi").join(a, [*key, "i"]).select("country", "kind", "noisy", "canon")
    single = sizes.filter("kind = 'name' AND n1 = 0 AND n2 = 1").select(*key)
    ends = two.filter("kind = 'name'").groupBy(*key).agg(F.min_by("tok", "pos").alias("first"), F.max_by("tok", "pos").alias("last"))
    lone = b.join(single, key, "left_semi").join(ends, key)
    place = F.when(F.col("noisy") == F.col("first"), "first").when(F.col("noisy") == F.col("last"), "last").otherwise("mid")
    insertions = lone.select(place.alias("place"), F.col("noisy").alias("tok")).groupBy("place", "tok").agg(F.count("*").alias("n"))
    return equal.unionByName(placed), insertions


def vote_counts(votes: DataFrame) -> DataFrame:
    """(country, kind, noisy, canon, n, total) by country and pooled as _all, in one aggregation by grouping sets."""
    keys = ["kind", "noisy", "canon"]
    sets = [[F.col(c) for c in ("country", *keys)], [F.col(c) for c in keys]]
    sums = votes.groupingSets(sets, "country", *keys).agg(F.count("*").alias("n"), F.grouping("country").alias("pooled"))
    sums = sums.select(F.when(F.col("pooled") == 1, "_all").otherwise(F.col("country")).alias("country"), *keys, "n")
    total = F.sum("n").over(Window.partitionBy("country", "kind", "noisy"))
    return sums.withColumn("total", total)


def dictionary(counts: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(kind, country, noisy, canon): for each noisy word the plausible canonical one with most votes; ties go to the smaller."""
    least = F.when(F.col("kind") == "name", settings.min_count_name).when(F.col("kind") == "addr", settings.min_count_addr).otherwise(settings.min_count_comp)
    rows = counts.filter("noisy <> canon").filter((F.col("n") >= least) & (F.col("n") >= settings.min_share * F.col("total")))
    rows = rows.filter(~((F.col("kind") == "name") & F.col("noisy").rlike("(?U)^\\d+$")))
    rows = rows.withColumn("ok", S.plausible(F.col("noisy"), F.col("canon"))).filter("ok")
    order = Window.partitionBy("kind", "country", "noisy").orderBy(F.desc("n"), "canon")
    return rows.withColumn("r", F.row_number().over(order)).filter("r = 1").select("kind", "country", "noisy", "canon")


def mine(pairs: DataFrame, references: DataFrame, others: DataFrame, settings: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(dictionary, insertions) of labelled pairs ``(s1_id, cand_id)``."""
    votes, insertions = aligned(sequences(training_pairs(pairs, references, others, settings)), settings)
    return dictionary(vote_counts(votes), settings), insertions
