"""Operators against brute force on small tables."""

import base64
import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkspark.llm import common, host_rules, mixing, near_dedup, packing, pii, quality_fm, suffix_dedup, token_counts, topk, warc
from linkspark.llm.queries import tokenizer

RNG = random.Random(7)
VOCABULARY = [f"w{i}" for i in range(300)]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def text_of(n):
    return " ".join(RNG.choice(VOCABULARY) for _ in range(n))


def edited(text, n):
    w = text.split()
    for _ in range(n):
        w[RNG.randrange(len(w))] = RNG.choice(VOCABULARY)
    return " ".join(w)


@pytest.fixture(scope="module")
def corpus():
    """A large group of near copies of every closeness, small groups, and texts of their own."""
    base = text_of(120)
    rows = [edited(base, RNG.randrange(0, 14)) for _ in range(160)] + [text_of(RNG.randrange(1, 90)) for _ in range(100)]
    rows += [edited(RNG.choice(rows[160:]), 1) for _ in range(40)] + [RNG.choice(rows) for _ in range(20)]
    RNG.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_near_duplicates_find_every_link(spark, corpus, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    monkeypatch.setattr(near_dedup, "BLOCK", 32)
    monkeypatch.setattr(near_dedup, "PLACE", 16)
    sets = {}
    for i, t in corpus:
        w = words(t)
        sets[i] = {tuple(w[j : j + 3]) for j in range(len(w) - 2)} or ({tuple(w)} if w else set())
    least = {i: i for i in sets}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            least[max(x, y)] = min(x, y)
    got = near_dedup.near_duplicates(spark.createDataFrame(corpus, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), root(i)) for i, s in sets.items()}


def test_keys_meet_within_the_distance():
    """Signatures that differ in at most DISTANCE symbols share a key, wherever they differ."""
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near_dedup.SYMBOLS)
        b = a.copy()
        b[rng.permutation(near_dedup.SYMBOLS)[: near_dedup.DISTANCE]] ^= 1
        chunks = (a != b).reshape(near_dedup.CHUNKS, near_dedup.LANES).sum(axis=1)
        assert chunks.min() <= 1


def test_pairs_at_a_lower_threshold(spark):
    """Pairs at 0.8 whose signatures differ in more symbols than DISTANCE and that share a key."""
    texts = [[" ".join([f"p{i}x{k}" for k in range(8)] + [f"p{i}{side}"]) for side in "ab"] for i in range(40_000)]
    docs = []
    with np.errstate(over="ignore"):
        sig = [near_dedup.signatures(list(near_dedup.shingle_sets(near_dedup.Words([t[s].encode() for t in texts], lower=True), 1))) for s in (0, 1)]
    apart = sig[0].view(np.uint16) != sig[1].view(np.uint16)
    meets = (apart.reshape(-1, near_dedup.CHUNKS, near_dedup.LANES).sum(axis=2) <= 1).any(axis=1)
    for i in np.flatnonzero((apart.sum(axis=1) > near_dedup.DISTANCE) & (apart.sum(axis=1) <= 18) & meets).tolist():
        docs += [(2 * i, texts[i][0]), (2 * i + 1, texts[i][1])]
    assert docs and near_dedup.farthest(85) == 15 and near_dedup.farthest(80) == 18
    got = near_dedup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 1, 80).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i - i % 2 for i, _ in docs}


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 300), (300, 50_000)] + [(1000, i) for i in range(1001, 1100)]
    got = {r.node: r.component for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[50_000] == 100 and all(got[i] == 1000 for i in range(1000, 1100))


def test_targets_by_water_filling(spark):
    sizes = {"a": 10, "b": 500, "c": 30, "é": 70, "z": 0, None: 40}
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    order = sorted(k for k in sizes if k is not None) + [None]
    weight = {k: (5, 2, 1)[i % 3] for i, k in enumerate(order)}
    capped = set()
    while True:
        level = (1.5 * sum(sizes.values()) - sum(2 * sizes[k] for k in capped)) / sum(weight[k] for k in order if k not in capped)
        more = {k for k in order if k not in capped and weight[k] * level > 2 * sizes[k]}
        if not more:
            break
        capped |= more
    assert got == pytest.approx({k: 2 * sizes[k] if k in capped else weight[k] * level for k in order})


def test_mix_reaches_its_targets(spark):
    rows = [(i, text_of(RNG.randrange(1, 60)), "abcd"[min(3, i % 7)]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan(docs).collect()
    again = {r.doc_id: r.taken for r in mixing.plan(docs.repartition(3)).collect()}
    assert {r.doc_id: r.taken for r in got} == again
    source = {r[0]: r[2] for r in rows}
    taken, exact, target = collections.Counter(), collections.Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        exact[source[r.doc_id]] += r.rate * r.size
        target[source[r.doc_id]] = r.target
    for s, t in target.items():
        assert exact[s] == pytest.approx(t, rel=1e-6)
        assert abs(taken[s] - t) <= 30


def test_warc_ranges_cut_anywhere(spark):
    inner = warc.record("response", "urn:page:9", "u", None, "X", b"inside").decode("latin-1")
    rows = [(i, f"http://x/{i}", RNG.choice(["", "same", text_of(RNG.randrange(1, 400)), inner])) for i in range(120)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    written = warc.write(warc.page_records(pages), common.fresh_dir(spark, "warc")).collect()
    archives = spark.createDataFrame(written, warc.WRITTEN)
    for split in (313, 4096, 1 << 20):
        got = warc.read(archives, split).select("record_id").collect()
        assert sorted(r.record_id for r in got) == sorted(f"urn:page:{i}" for i, _, _ in rows)
    best = {}
    for i, _, h in rows:
        best[h] = max(best.get(h, -1), i)
    want = {i: (len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "response" if best[h] == i else "revisit", None if best[h] == i else best[h]) for i, _, h in rows}
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(spark, pages).collect()} == want


def covered(docs, length):
    """Maximal runs of words in windows that occur twice, and the smallest id of their windows."""
    places = collections.defaultdict(list)
    for i, t in docs:
        w = words(t)
        for s in range(len(w) - length + 1):
            places[tuple(w[s : s + length])].append((i, s))
    hits = collections.defaultdict(dict)
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                hits[i][s] = min(f[0] for f in found)
    out = []
    for i, starts in hits.items():
        spans = []
        for s in sorted(starts):
            if spans and s <= spans[-1][1]:
                spans[-1] = (spans[-1][0], s + length, min(spans[-1][2], starts[s]))
            else:
                spans.append((s, s + length, starts[s]))
        out += [(i, *x) for x in spans]
    return sorted(out)


def test_warc_is_read_by_as_many_tasks_as_ranges(spark):
    noise = random.Random(2)
    rows = [(i, "u", noise.randbytes(3000).hex()) for i in range(64)]
    archives = spark.createDataFrame(warc.write(warc.page_records(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)), common.fresh_dir(spark, "warc")).collect(), warc.WRITTEN)
    size = archives.first().bytes
    found = warc.read(archives, size // 16 + 1).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(found) == 16 and sum(r["count"] for r in found) == 64


def test_warc_loses_damaged_members_alone(tmp_path):
    members = [warc.record("response", f"urn:page:{i}", "u", None, "X", random.Random(i).randbytes(400).hex().encode()) for i in range(6)]
    path = tmp_path / "a.warc.gz"
    starts = np.cumsum([0] + [len(m) for m in members])
    for bad, where in itertools.product((0, 1, 3, 5), (0, 2, 60, -3)):
        data = bytearray(b"".join(members))
        data[starts[bad] + (where if where >= 0 else len(members[bad]) + where)] ^= 0xFF
        path.write_bytes(data)
        for split in (len(data), 100, 700):
            with pa.OSFile(str(path)) as handle:
                got = [head["warc-record-id"] for at in range(0, len(data), split) for _, head, _ in warc.records_in(handle, at, min(at + split, len(data)))]
            assert got == [f"<urn:page:{i}>" for i in range(6) if i != bad]


def test_warc_magic_across_the_buffer(tmp_path):
    noise = random.Random(5).randbytes(600_000).hex().encode()
    big, small = (warc.record("response", f"urn:page:{i}", "u", None, "X", p) for i, p in ((1, noise), (2, b"small")))
    assert len(big) > 2 * warc.CHUNK
    path = tmp_path / "a.warc.gz"
    path.write_bytes(big + big + small)
    for where in (len(big), 2 * len(big)):
        for back in range(5):
            start = where - warc.CHUNK + back
            with pa.OSFile(str(path)) as handle:
                got = list(warc.records_in(handle, start, 3 * len(big)))
            assert [at for at, _, _ in got] == [x for x in (len(big), 2 * len(big)) if x >= start]


def test_warc_heads_of_any_size(tmp_path):
    url = "http://x/" + "y" * (3 << 20)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(warc.record("response", "urn:page:1", url, None, "X", b"page") + warc.record("response", "urn:page:2", "u", None, "X", b"next"))
    with pa.OSFile(str(path)) as handle:
        got = list(warc.records_in(handle, 0, path.stat().st_size))
    assert [head["warc-target-uri"] for _, head, _ in got] == [url, "u"]
    assert got[0][2].endswith(b"\r\n\r\npage")


@pytest.mark.parametrize(("group", "lookup"), [(2048, 9), (3, 100_000), (3, 1)])
def test_repeated_passages(spark, monkeypatch, group, lookup):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "LOOKUP", lookup)
    passage, other = text_of(70), text_of(52)
    docs = []
    for i in range(60):
        cut = passage.split()[RNG.randrange(0, 15) : 70 - RNG.randrange(0, 15)]
        docs.append((i, " ".join([text_of(RNG.randrange(0, 40)), *cut, text_of(RNG.randrange(0, 40)), other if i % 9 == 0 else ""])))
    docs += [(100, "a b " * 60), (101, docs[3][1]), (102, docs[3][1])]
    got = suffix_dedup.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.start, r.end, r.first_doc_id) for r in got) == covered(docs, 50)


PII = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def is_valid(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        double = sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and double % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_spans(spark):
    bits = ["1", "22", "255", ".", "-", " ", "+", "@", "a", "b.c", "%", "\n", "é", "😀", "(", ")", "4111 1111 1111 1111", "1.2.3.4", "+49 30 1234567", "x@y.co"]
    rows = [(i, "".join(RNG.choice(bits) for _ in range(40))) for i in range(400)] + [(900, "1 " * 9000 + "1" * 20_000 + "a.b%" * 9000 + "+1" + "-" * 9000)]
    got = {r.doc_id: r.base_sha256 for r in pii.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        spans = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PII.items()) for m in re.finditer(p, t) if is_valid(kind, m[0]))
        line = ",".join(f"{list(PII)[k]}:{s}:{e}" for s, k, e in spans)
        assert got[i] == hashlib.sha256(line.encode()).hexdigest(), t


def planted_contexts():
    """(documents, what is to be found): known identifiers behind cues, unseen ones behind the same, and numbers that are none."""
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice(VOCABULARY).replace("w", "wo").translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(n))
    phone = lambda: f"({rng.randrange(200, 999)}) 555-{rng.randrange(10_000):04d}"
    card = lambda: f"4111 1111 {rng.randrange(10_000):04d} {rng.randrange(10_000):04d}"
    rows, want = [], {}
    known = [c for c in (card() for _ in range(2000)) if is_valid("card", c)][:50]
    rows += [f"{say(20)} cardno {c} {say(5)}" for c in known] + [f"{say(20)} Phone: +1 {phone()} {say(5)}" for _ in range(50)]
    for kind, cue, make in (("phone", "phone", phone), ("card", "Cardno:", card)):
        for _ in range(20):
            value = make()
            if kind == "phone" or not is_valid("card", value):
                want[len(rows)] = f"{kind}:{value}"
                rows.append(f"{say(10)} {cue} {value}. {say(5)}")
    rows += [f"{say(20)} order {rng.randrange(10**9, 10**10)} of {rng.randrange(1900, 2030)} {say(5)}" for _ in range(200)]
    return list(enumerate(rows)), want


def test_context_discovers_unseen_identifiers(spark):
    rows, want = planted_contexts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.find(docs).collect():
        new = [s for s in r.spans if s not in r.base]
        assert [f"{pii.KINDS[s.k]}:{rows[r.doc_id][1][s.start : s.end]}" for s in new] == ([want[r.doc_id]] if r.doc_id in want else []), rows[r.doc_id]
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    for i, found in want.items():
        kind, value = found.split(":")
        assert clean[i] == rows[i][1].replace(value, f"[{kind.upper()}]")


def test_redaction_by_runs_of_spans(spark):
    text = "".join(RNG.choice("abcé😀 ") for _ in range(9000))
    spans = []
    for _ in range(700):
        at = RNG.randrange(0, 8990)
        spans.append((at, RNG.randrange(4), at + RNG.randrange(1, 30)))
    spans = sorted({s for s in spans if s[2] <= 9000})
    out, at = "", 0
    for start, k, end in spans:
        if start >= at:
            out += text[at:start] + f"[{list(PII)[k].upper()}]"
        at = max(at, end)
    one = spark.createDataFrame([(text, spans), ("as it is", [])], f"text string, spans {pii.SPANS}")
    assert [r[0] for r in one.select(pii.replaced(F.col("text"), F.col("spans"))).collect()] == [out + text[at:], "as it is"]


def test_many_spans_take_time_in_proportion(spark):
    rows = [(1, " ".join(f"a{i}@b.co {10**8 + i}" for i in range(30_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    began = time.time()
    got = pii.digest(docs).first()
    assert got.n_email == 30_000 and pii.redact(docs).first().text.startswith("[EMAIL] 100000000 [EMAIL] 100000001")
    assert time.time() - began < 120


def test_pieces_and_padding(spark, corpus):
    from tokenizers import Tokenizer

    rows = [*corpus, (1000, "Ünïcode <|endoftext|> don't STOP 日本語 'll 12 ÿ"), (1001, text_of(9000))]
    ids = {i: [*e.ids, 1] for (i, _), e in zip(rows, Tokenizer.from_file(tokenizer()).encode_batch([t for _, t in rows], add_special_tokens=False), strict=True)}
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), tokenizer()).collect()
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, own in ids.items():
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(own)
            assert r.ids_crc32 == zlib.crc32(np.array(own[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(own)
    padding = total = 0
    assert len(got) < 1.6 * len(rows)
    for rs in by_sequence.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding == 0


@pytest.mark.parametrize("waiting", [1, 5, 64])
def test_harmonic_classes(waiting):
    """Documents of a class share bins of as many; all tokens are placed once, and only documents at gaps are cut."""
    bins = packing.HarmonicBins(64, 8, waiting, 0)
    lengths = [RNG.choice([1, 2, 9, 20, 21, 31, 32, 33, 63, 64, 65, 200]) for _ in range(500)]
    rows = [r for i, n in enumerate(lengths) for r in bins.add(i, np.arange(n, dtype="<u4"))] + list(bins.close())
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r[0]].append((r[1], r[2]))
    assert all(sum(n for _, n in pieces[i]) == want and len(set(pieces[i])) == len(pieces[i]) for i, want in enumerate(lengths))
    fill = collections.Counter()
    for r in rows:
        fill[r[5]] += r[2]
    assert all(n == 64 for n in list(fill.values())[:-8]) and all(n <= 64 and n & (n - 1) == 0 for n in fill.values())
    alone = packing.HarmonicBins(64, 8, 10**9, 0)
    assert all(len({d for d, *_ in alone.add(i, np.arange(21, dtype="<u4"))}) in (0, 3) for i in range(3)) and not alone.open


def test_factorisation_machine():
    texts = [text_of(40).encode() if i % 2 else (text_of(20) + " !!" * 20).upper().encode() for i in range(300)]
    parts = [quality_fm.features(texts[i : i + 90], [len(t) for t in texts[i : i + 90]]) for i in (0, 90)]
    model = quality_fm.fit(quality_fm.concatenated(parts), np.arange(180) % 2)
    ends, buckets, values, stats = quality_fm.features(texts, [len(t) for t in texts])
    logits = quality_fm.score(model, ends, buckets, values, stats)
    assert ((logits[200:] > 0) == (np.arange(200, 300) % 2 == 1)).mean() > 0.95
    # the identity against all pairs of features
    d = quality_fm.dense(stats, model.mean, model.scale)
    for i in range(3):
        lo, hi = (ends[i - 1] if i else 0), ends[i]
        x = np.zeros(quality_fm.DIMS)
        x[buckets[lo:hi]] = values[lo:hi]
        x[quality_fm.BUCKETS :] = d[i]
        on = np.flatnonzero(x)
        pairs = sum(x[a] * x[b] * (model.factors[a] @ model.factors[b]) for a, b in itertools.combinations(on, 2))
        assert logits[i] == pytest.approx(model.bias + x @ model.weights + pairs, abs=1e-4)


def test_quality_of_held_out_documents(spark):
    """The query's scores of rows that it hasn't learnt from order them by label, and don't depend on columns it may not use."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_fm.classify(docs, labels)
    rows = got.filter("held_out").join(labels.filter("quality IS NOT NULL"), "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert good and bad and sum((g > b) + (g == b) / 2 for g in good for b in bad) / len(good) / len(bad) > 0.85
    blind = quality_fm.classify(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}).repartition(3), labels)
    assert {r.doc_id: r.score for r in blind.collect()} == pytest.approx({r.doc_id: r.score for r in got.collect()}, abs=1e-6)


def test_held_out_rows_by_crc(spark):
    got = spark.range(50).select("id", quality_fm.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def nearest(data, ids, q, k):
    """The k best others of row q, in whole numbers of any size."""
    s = [sum(int(a) * int(b) for a, b in zip(data[q], row, strict=True)) for row in data]
    order = sorted((j for j in range(len(data)) if ids[j] != ids[q]), key=lambda j: (-s[j], ids[j]))[:k]
    return [(int(ids[q]), int(ids[j]), s[j]) for j in order]


def test_threshold_algorithm():
    rng = np.random.default_rng(3)
    rows = np.vstack([rng.integers(-40, 40, (700, 12)), np.repeat(rng.integers(-40, 40, (1, 12)), 90, axis=0)])
    ids = np.arange(len(rows)) * 5
    spiky = np.zeros((len(rows), 12), dtype=np.int64)
    spiky[np.arange(len(rows)), rng.integers(0, 12, len(rows))] = rng.integers(0, 1000, len(rows))
    huge = rng.integers(-(2**28), 2**28, (150, 12)) * 2
    for data, few in ((rows, False), (spiky, True), (huge, False)):
        q = np.arange(0, len(data), 20)
        got, scored = topk.Block(data, ids[: len(data)]).top(data[q], ids[q], 20)
        assert sorted(got) == sorted(x for i in q for x in nearest(data, ids, i, 20))
        if few:
            assert scored < len(q) * len(data)


def test_scores_beyond_64_bits_are_refused():
    with pytest.raises(OverflowError):
        topk.Block(np.full((3, 2), 2**31), np.arange(3)).top(np.full((1, 2), 2**31), np.array([0]), 1)


def test_top_k_over_many_blocks(spark):
    rng = np.random.default_rng(8)
    data = np.round(rng.normal(0, 1, (300, 6)), 3)
    vectors = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(data)], "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(vectors, k=7, rows=40).collect()
    whole = np.floor(64 * data).astype(np.int64)
    want = [(q, rank + 1, j, s) for q in range(0, 300, 20) for rank, (_, j, s) in enumerate(nearest(whole, np.arange(300), q, 7))]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == want


def test_trie_counts():
    scores = {"▁": -5.0, "a": -3.0, "b": -3.0, "ab": -4.0, "▁ab": -5.0, "abc": -20.0, "c": -6.0, "bc": -7.0}
    unigram = token_counts.Unigram(scores)

    def best(w):
        states = [(0.0, 0)]
        for i in range(1, len(w) + 1):
            options = [(states[i - 1][0] + unigram.unknown, states[i - 1][1] - len(w[i - 1].encode()))]
            options += [(states[j][0] + scores[w[j:i]], states[j][1] - 1) for j in range(i) if w[j:i] in scores]
            states.append(max(options))
        return -states[-1][1]

    everything = ["▁" + "".join(p) for n in range(5) for p in itertools.product("abcé", repeat=n)]
    RNG.shuffle(everything)
    assert unigram.counts(everything) == [best(w) for w in everything]


def test_token_counts_of_whole_texts(spark, corpus):
    """The query against segmentations that share nothing, and near the model's own merges."""
    import sentencepiece

    path = tokenizer("piece_bpe_32k.model")
    unigram, own = token_counts.model(path), sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [*corpus, (1000, "Déjà vu, 日本語 the reading of whole sentences!"), (1001, None)]
    got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()}
    assert got == {i: sum(unigram.counts([token_counts.MARK + w])[0] for w in (t or "").split()) for i, t in rows}
    text = "The engine reads the records of every source and counts what it has read before it writes the result"
    assert abs(sum(unigram.counts([token_counts.MARK + w for w in text.split()])) - len(own.encode(text))) <= 1


def test_host_verdicts_shrink(spark):
    rows = [("big", i < 90) for i in range(100)] + [("small", True)] + [(f"h{k}", i < 1) for k in range(10) for i in range(20)]
    got = {r.host: r for r in host_rules.host_verdicts(spark.createDataFrame(rows, "host string, failed boolean")).collect()}
    assert not got["big"].host_ok and got["h1"].host_ok
    assert got["h1"].host_rate > 1 / 20 and got["small"].host_rate < 1


def test_hosts_that_stand_out(spark):
    """A host that fails far more often than the others is bad below the absolute limit; none is where all are alike."""
    alike = [(f"h{k}", i < 5 + k % 3) for k in range(40) for i in range(100)]
    odd = [("odd", i < 40) for i in range(100)]
    verdicts = lambda rows: {r.host: r.host_ok for r in host_rules.host_verdicts(spark.createDataFrame(rows, "host string, failed boolean")).collect()}
    assert all(verdicts(alike).values())
    assert [h for h, ok in verdicts(alike + odd).items() if not ok] == ["odd"]
