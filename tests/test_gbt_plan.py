"""The matcher's pairs get their labels while they are narrow: no join deals out rows that already have features."""

import pytest

from linkspark import queries as own
from linkspark.sources import tsv


class Seen(Exception):
    pass


def test_labels_come_before_features(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(i, f"same q{i - i % 2}", "en") for i in range(60)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")

    def look(rows, *_):
        raise Seen(rows._jdf.queryExecution().optimizedPlan().toString())

    monkeypatch.setattr(tsv, "write_stage", look)
    with pytest.raises(Seen) as seen:
        own.queries()["gbt_matcher"](spark, str(tmp_path))
    plan = str(seen.value)
    # a plan shows what comes last first
    assert 0 <= plan.index("ArrowEvalPython") < plan.index("Join LeftOuter")
