"""The pipeline's stages against plain versions on small documents."""

import collections
import itertools
import re

import corpus_pipeline as pipeline
import pytest
from test_methods import PII, is_valid, words

SF = "/root/testdata/sf0.001"


def good(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w) >= 50 and 100 * len(repeated) <= 50 * len(w)


def first_of_each(docs):
    sets = {}
    for i, t in docs.items():
        w = words(t)
        sets[i] = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} or ({tuple(w)} if w else set())
    least = {i: i for i in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            least[max(x, y)] = min(x, y)
    return {i: t for i, t in docs.items() if root(i) == i}


def redacted(text):
    spans = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PII.items()) for m in re.finditer(p, text) if is_valid(kind, m[0]))
    out, at = "", 0
    for start, k, end in spans:
        if start >= at:
            out += text[at:start] + f"[{list(PII)[k].upper()}]"
        at = max(at, end)
    return out + text[at:]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in pipeline.STAGES:
        docs = out[name] = pipeline.stash(stage(spark, docs, SF), "test")
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows.collect()}


def test_columns_stay(stages):
    for name in list(stages)[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_quality_rules(stages):
    assert texts(stages["quality_rules"]) == {i: t for i, t in texts(stages["documents"]).items() if good(t)}


def test_near_dedup(stages):
    assert texts(stages["near_dedup"]) == first_of_each(texts(stages["quality_rules"]))


def test_pii(stages):
    assert texts(stages["pii"]) == {i: redacted(t) for i, t in texts(stages["near_dedup"]).items()}
    assert all(r.n_chars == len(r.text) for r in stages["pii"].collect())


def test_mixing(stages):
    rows = stages["pii"].collect()
    size, source = {r.doc_id: len(words(r.text)) for r in rows}, {r.doc_id: r.source for r in rows}
    total = collections.Counter()
    for i, n in size.items():
        total[source[i]] += n
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total))}
    capped = set()
    while True:
        level = (1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        more = {s for s in weight if s not in capped and weight[s] * level > 2 * total[s]}
        if not more:
            break
        capped |= more
    taken, copies = collections.Counter(), collections.Counter(r.doc_id for r in stages["mixing"].select("doc_id").collect())
    for i, n in copies.items():
        taken[source[i]] += n * size[i]
    assert max(copies.values()) <= 2
    for s, w in weight.items():
        target = 2 * total[s] if s in capped else w * level
        # whole documents: off by half of the largest one at most
        assert abs(taken[s] - target) <= max(n for i, n in size.items() if source[i] == s)


def test_packing(stages):
    want = collections.Counter(r.doc_id for r in stages["mixing"].select("doc_id").collect())
    total = collections.Counter()
    for r in stages["packing"].collect():
        total[r.doc_id, r.doc_tokens] += r.length
    assert {i: n // t for (i, t), n in total.items()} == dict(want)


def test_run(spark, stages):
    assert pipeline.run(spark, SF).columns == stages["packing"].columns
