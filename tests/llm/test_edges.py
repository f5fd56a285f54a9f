"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

from linkspark.llm import host_rules, mixing, near_dedup, packing, pii, quality_fm, suffix_dedup, token_counts, topk, warc
from linkspark.llm.queries import tokenizer

LONG = " ".join(f"w{i}" for i in range(30_000)) + " " + "x" * 200_000
COPY = " ".join(f"c{i}" for i in range(80))
#: Names that the operators use inside.
CLASH = ["id", "key", "size", "n", "h1", "c0", "set", "gram", "at", "th", "base", "spans", "_row", "_s", "_text", "_spans", "cut", "lam", "host", "kept", "component_id", "score"]
ROWS = [
    (1, COPY, "en", "a", 5), (2, COPY, "en", "a", 5), (2, COPY, "en", "a", 5), (3, None, None, None, None), (4, "", "en", "a", 0), (5, " \t\n", "en", "b", 3),
    (6, LONG, "en", "b", 9), (None, COPY, "en", None, None), (None, None, None, None, None), (7, "one two", "en", "c", 1), (8, "One TWO", "en", "c", 1), (9, "é " * 60 + "a@b.cd +49 30 1234567", "de", "c", 2),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return rows.select("*", *[F.lit("clash").alias(c) for c in CLASH])


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(rows):
    return {r.doc_id: r for r in rows if r.doc_id is not None}


def test_near_duplicates(docs, empty):
    rows = near_dedup.near_duplicates(docs, 3, 85).collect()
    assert len(rows) == len(ROWS) and near_dedup.near_duplicates(empty, 3, 85).count() == 0
    got = by_id(rows)
    assert got[1].kept and not got[2].kept and got[2].component_id == 1
    assert got[7].component_id == got[8].component_id == 7 and got[7].n_shingles == 1
    assert all(got[i].kept and got[i].n_shingles == 0 for i in (3, 4, 5))
    assert all(r.component_id is None and r.kept is None for r in rows if r.doc_id is None)


def test_deduplicate(docs, empty):
    rows = near_dedup.deduplicate(docs, 3, 85)
    assert rows.columns == docs.columns
    assert sorted(r.doc_id for r in rows.collect() if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 9]
    repeated = docs.filter("doc_id = 2")
    assert near_dedup.deduplicate(repeated, 3, 85).count() == 1
    assert near_dedup.deduplicate(empty).count() == 0


def test_deduplicate_with_repeated_ids(spark):
    one, two, three = ("a b c d e f", "g h i j k l", "m n o p q r")
    rows = [(1, one), (2, one), (2, two), (2, two), (3, two), (4, three), (4, "s t u v w x"), (5, three), (6, ""), (6, ""), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in near_dedup.deduplicate(docs, 3, 85).collect()]
    assert sorted(got, key=str) == sorted([(1, one), (2, two), (4, three), (4, "s t u v w x"), (6, ""), (6, ""), (None, one)], key=str)


def test_mixing(docs, empty):
    rows = mixing.plan(docs).collect()
    assert len(rows) == len(ROWS) and mixing.plan(empty).count() == 0
    assert all(r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in rows)
    assert sum({(r.source_size, r.target): r.target for r in rows}.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(empty).count() == 0


def test_pii(docs, empty):
    rows = pii.digest(docs).collect()
    assert len(rows) == len(ROWS) and pii.digest(empty).count() == 0
    got = by_id(rows)
    assert got[9].spans == "email:120:126,phone:127:141" and got[3].spans == "" and got[9].n_phone == 1
    clean = pii.redact(docs)
    assert clean.columns == docs.columns
    clean = by_id(clean.collect())
    assert clean[9].text.endswith("[EMAIL] [PHONE]") and clean[9].n_chars == len(clean[9].text)
    assert clean[3].text is None and clean[6].text == LONG and clean[9]["spans"] == "clash"


def test_host_rules(docs, empty):
    rows = host_rules.judge(docs).collect()
    assert len(rows) == len(ROWS) and host_rules.judge(empty).count() == 0
    got = by_id(rows)
    assert got[3].base_failed and got[4].n_words == 0 and not got[6].base_failed and got[9].base_failed
    good = host_rules.keep_good(docs)
    assert good.columns == docs.columns and good.count() == sum(r.kept for r in rows)
    assert host_rules.keep_good(empty).count() == 0


def test_suffixes(docs, empty):
    rows = suffix_dedup.repeated_passages(docs).collect()
    assert {(r.doc_id, r.start, r.end, r.first_doc_id) for r in rows if r.doc_id != 9} == {(1, 0, 80, 1), (2, 0, 80, 1)}
    assert suffix_dedup.repeated_passages(empty).count() == 0


def test_packing(docs, empty):
    rows = packing.pack(docs, tokenizer()).collect()
    assert packing.pack(empty, tokenizer()).count() == 0
    assert {r.doc_tokens for r in rows if r.doc_id in (3, 4, 5)} == {1}
    assert sum(r.length for r in rows if r.doc_id == 6) == next(r.doc_tokens for r in rows if r.doc_id == 6)


def test_token_counts(docs, empty):
    path = tokenizer("piece_bpe_32k.model")
    rows = token_counts.count_tokens(docs, path).collect()
    assert len(rows) == len(ROWS) and token_counts.count_tokens(empty, path).count() == 0
    assert by_id(rows)[3].n_tokens == 0 and by_id(rows)[6].n_words == 30_001


def test_classifier(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (3, None), (None, 1), (7, 0), (6, 1), (9, 0)], "doc_id long, quality int")
    rows = quality_fm.classify(docs, labels).collect()
    assert len(rows) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert quality_fm.classify(empty, labels).count() == 0
    assert {r.score for r in quality_fm.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_top_k(spark):
    v = [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, []), (5, [float("nan"), 1.0]), (6, [None, 1.0]), (7, [float("inf"), 0.0]), (None, [1.0, 1.0]), (8, [1.0]), (40, [0.0, 0.0])]
    rows = topk.top_k(spark.createDataFrame(v, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("score", F.lit(2)), k=4)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows.collect())
    assert got == [(20, 1, 1, 4096), (20, 2, 2, 4096), (20, 3, 2, 4096), (20, 4, 40, 0), (40, 1, 1, 0), (40, 2, 2, 0), (40, 3, 2, 0), (40, 4, 20, 0)]
    assert [(r.query_id, r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame([(20, []), (3, []), (4, None)], "vec_id long, embedding array<double>")).collect()] == [(20, 3, 0)]
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_warc(spark):
    rows = [(1, "u", "x"), (2, None, "x"), (3, "a\r\nb", None), (4, "c", ""), (None, "d", "x"), (2, "e", "x"), (5, "f", "é" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(0)).withColumn("payload", F.lit(1))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(spark, pages).collect())
    assert got == [(0, 1, "revisit", 2), (1, 1, "revisit", 2), (2, 1, "response", None), (2, 1, "response", None), (3, 0, "revisit", 4), (4, 0, "response", None), (5, 600_000, "response", None)]
    assert warc.round_trip(spark, pages.limit(0)).count() == 0
