"""Features and labels of candidate pairs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from . import longtexts
from .competition import competition

ATTRIBUTES = ["name_clean", "name_core", "name_alias", "name_legal", "addr_clean", "addr_comps", "addr_landmark", "addr_nums", "addr_first_num", "addr_postcode"]
FLAGS = ["f_name_domain", "f_name_alias", "f_name_native", "f_addr_native", "f_name_caps", "f_addr_caps", "f_addr_empty", "f_name_junk"]
#: The 50 inputs of the matcher, in order.
FEATURES = [
    "cos_name", "cos_addr", "score", "rank", "is_s3",
    "q_best", "q_gap", "q_n", "q_rank_src", "q_gap_src", "q_best_name", "q_best_addr", "c_n", "c_rank", "c_gap", "c_margin", "q_margin",
    "n_ratio", "n_tset", "nc_tsort", "nc_partial", "nc_jw", "nc_compact_ratio", "nc_equal", "nc_jacc", "n_tok_l", "n_tok_r", "n_len_diff",
    "legal_agree", "alias_sim", "a_ratio", "a_tset", "a_partial", "a_num_jacc", "a_num_both", "a_comp_jacc", "a_first_num", "a_postcode",
    "lm_sim", "a_len_l", "a_len_r", *[f"r_{f}" for f in FLAGS], "l_addr_empty",
]


def attached(candidates: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Candidates with both records' attributes, as l_ and r_."""
    side = lambda rows, key, tag, flags: rows.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{tag}_{c}") for c in [*ATTRIBUTES, *flags]])
    return candidates.join(side(left, "s1_id", "l", ["f_addr_empty"]), "s1_id").join(side(right, "cand_id", "r", FLAGS), "cand_id")


def native_short() -> dict[str, Column]:
    left, right = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))
    lc, rc = (F.replace(f"{s}_name_core", F.lit(" "), F.lit("")) for s in "lr")
    return {
        "nc_equal": ((lc == rc) & (lc != "")).cast("int"),
        "nc_jacc": S.set_jaccard(left("name_core"), right("name_core")),
        "n_tok_l": F.size(S.words(left("name_core"))), "n_tok_r": F.size(S.words(right("name_core"))),
        "n_len_diff": F.abs(F.length(lc) - F.length(rc)),
        "legal_agree": S.agree(left("name_legal"), right("name_legal")),
        "a_first_num": S.agree(left("addr_first_num"), right("addr_first_num")),
        "a_postcode": S.agree(left("addr_postcode"), right("addr_postcode")),
    }


def native_features(rows: DataFrame) -> DataFrame:
    """Set, length and agreement features, as column expressions."""
    left, right = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))
    both = lambda c: (left(c) != "") & (right(c) != "")
    return rows.withColumns({
        **native_short(),
        "a_num_jacc": S.set_jaccard(left("addr_nums"), right("addr_nums")), "a_num_both": both("addr_nums").cast("int"),
        "a_comp_jacc": S.set_jaccard(left("addr_comps"), right("addr_comps"), "\\|"),
        "a_len_l": F.length(left("addr_clean")), "a_len_r": F.length(right("addr_clean")),
    })


def edit_pair(f: Callable, c: str, d: str | None = None) -> Column:
    return f(F.col(f"l_{c}"), F.col(f"r_{d or c}"))


def edit_short() -> dict[str, Column]:
    lc, rc = (F.replace(f"{s}_name_core", F.lit(" "), F.lit("")) for s in "lr")
    return {
        "n_ratio": edit_pair(S.indel_ratio, "name_clean"), "n_tset": edit_pair(S.token_set_ratio, "name_clean"),
        "nc_tsort": edit_pair(S.token_sort_ratio, "name_core"), "nc_partial": edit_pair(S.partial_ratio, "name_core"),
        "nc_jw": S.jaro_winkler_similarity(lc, rc), "nc_compact_ratio": S.indel_ratio(lc, rc),
        "alias_sim": F.when(F.col("r_name_alias") != "", edit_pair(S.token_sort_ratio, "name_core", "name_alias")).otherwise(0),
    }


def edit_features(rows: DataFrame) -> DataFrame:
    """Edit-based features, by vectorised UDFs; lm_sim is 255 if a landmark is missing."""
    return rows.withColumns({
        **edit_short(),
        "a_ratio": edit_pair(S.indel_ratio, "addr_clean"), "a_tset": edit_pair(S.token_set_ratio, "addr_clean"), "a_partial": edit_pair(S.partial_token_set_ratio, "addr_clean"),
        "lm_sim": F.when((F.col("l_addr_landmark") != "") & (F.col("r_addr_landmark") != ""), edit_pair(S.token_set_ratio, "addr_landmark")).otherwise(255),
    })


def shown(rows: DataFrame, also: tuple[str, ...]) -> DataFrame:
    flags = [F.col(f"r_{f}").cast("int").alias(f"r_{f}") for f in FLAGS]
    plain = [F.col(c) for c in FEATURES if not c.startswith("r_f_") and c != "l_addr_empty"]
    return rows.select("s1_id", "cand_id", *plain, *flags, F.col("l_f_addr_empty").cast("int").alias("l_addr_empty"), *also)


def pair_features(candidates: DataFrame, left: DataFrame, right: DataFrame, keep: DataFrame | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """(s1_id, cand_id, FEATURES...): rivalry over all candidates first, then only those of queries in ``keep(s1_id)``. Columns ``also`` of the candidates follow."""
    rows = competition(candidates)
    if keep is not None:
        rows = rows.join(keep, "s1_id", "left_semi")
    return shown(edit_features(native_features(attached(rows, left, right))), also)


def placed_pair_features(candidates: DataFrame, left: DataFrame, right: DataFrame, folder: str, tasks: int, also: tuple[str, ...] = ()) -> DataFrame:
    """pair_features() of records whose long attributes lie in ``folder`` (longtexts.put()), measured by ``tasks`` tasks.

    Queries are dealt out whole, since a candidate can be one of very many queries.
    """
    short = [c for c in ATTRIBUTES if c not in longtexts.LONG]
    side = lambda rows, key, tag, flags: rows.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{tag}_{c}") for c in [*short, *flags]], *[F.col(c).alias(f"{tag}{c}") for c in longtexts.PLACE])
    rows = competition(candidates).join(side(right, "cand_id", "r", FLAGS), "cand_id").repartition(tasks, "s1_id")
    rows = rows.join(side(left, "s1_id", "l", ["f_addr_empty"]), "s1_id").withColumns(native_short()).withColumns(edit_short())
    rows = rows.drop(*[f"{s}_{c}" for s in "lr" for c in short])
    return shown(longtexts.with_features(rows, folder), also)


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with label 1 if they are in ``truth(s1_id, cand_id)``, else 0. The join deals out whole rows, so candidates are better labelled before they get features."""
    known = truth.select("s1_id", "cand_id").distinct().withColumn("_t", F.lit(1))
    return pairs.join(known, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("_t", F.lit(0))).drop("_t")
