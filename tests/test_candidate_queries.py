"""The queries that build on candidates write no pairs but the kept ones."""

import pytest

from linkspark import queries as own

from test_postings import written

QUERIES = ["block_topk", "pair_features_all", "competition_stats", "pair_sets", "assign_best", "recall_at_k", "threshold_grid", "result_table", "candidate_lists", "blocking_ceiling", "key_recall", "macro_f05", "decision_rule"]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """200 records of the first source, each of which shares a probe with all 400 others: 80,000 pairs, of which 4,000 are kept."""
    folder = str(tmp_path_factory.mktemp("pairs"))
    rows = [(i, f"same q{i - i % 2 if i < 60 else i}", "en") for i in range(600)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("name", QUERIES)
def test_only_kept_pairs_are_shuffled(spark, sf, name):
    before = written(spark)
    own.queries()[name](spark, sf).write.format("noop").mode("overwrite").save()
    rows = sum(n for k, n in written(spark).items() if k not in before)
    assert rows < 60_000, rows
