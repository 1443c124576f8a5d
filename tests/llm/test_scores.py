"""Toxicity, personal data, nearest neighbours and token rollups."""

import hashlib
import math
import random
import re
import uuid
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import SF, rows, words
from lapworks.llm import neighbours, pii, rollup, tokens, toxicity
from lapworks.session import shared_dir


# ------------------------------------------------------------------ toxicity
def brute_segments(scores, n, drift):
    """Maximal scoring segments by their definition: the best segment, then the same on
    what is left and right of it."""
    v = [-drift] * n
    for i, s in scores:
        v[i] += s

    def best(lo, hi):
        top = None
        for a in range(lo, hi):
            t = 0.0
            for b in range(a, hi):
                t += v[b]
                if t > 1e-12 and (top is None or t > top[2] + 1e-9):
                    top = (a, b, t)
        if top is None:
            return []
        return best(lo, top[0]) + [top] + best(top[1] + 1, hi)
    return best(0, n)


def test_segments_by_definition():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randrange(1, 30)
        at = sorted(rnd.sample(range(n), rnd.randrange(0, n + 1)))
        scores = [(i, rnd.choice([-1, 1]) * rnd.random() * 3) for i in at]
        got = toxicity.segments(scores, 0.1)
        want = brute_segments(scores, n, 0.1)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])
    many = [(i, 1.0 if i % 3 else -1.5) for i in range(300_000)]
    assert toxicity.segments(many, 0.01)                                   # linear: at once


def test_evidence_falls_with_chance():
    one = [(0, 0, 8.0)]
    e, kept = toxicity.evidence(one, 100, 1.0, 0.1)
    assert kept and e == pytest.approx(-math.log(1 - math.exp(-0.1 * 100 * math.exp(-8))), rel=1e-6)
    assert toxicity.evidence(one, 10 ** 6, 1.0, 0.1)[0] < e
    assert toxicity.evidence([], 0, 1.0, 0.1) == (0.0, [])
    assert toxicity.evidence([(0, 0, 900.0)], 5, 1.0, 0.1)[0] == toxicity.MOST_EVIDENCE


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.1"), reason="test tables not present")
def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = toxicity.score(docs, labels)
    assert got.count() == docs.count()
    seen = rows(got.join(labels, "doc_id").filter("held_out").select("score", "predicted", "toxic"))
    hit = sum(r["predicted"] and r["toxic"] for r in seen)
    assert hit / sum(r["toxic"] for r in seen) > 0.75 and hit / sum(r["predicted"] for r in seen) > 0.85
    assert all(0 <= r["score"] <= 1 for r in seen)


def test_toxicity_tables(spark, odd, empty, docs):
    import zlib
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(14)] + [(5, None), (None, 1), (4, 7)],
                                   "doc_id long, toxic int")
    for lab in (labels, labels.limit(0)):
        got = rows(toxicity.score(odd, lab))
        assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
        for r in got:
            assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
            assert r["predicted"] == int(r["score"] >= 0.3)
    assert toxicity.score(empty, labels).count() == 0
    kept = toxicity.keep_clean(odd, labels)
    assert kept.columns == odd.columns and kept.count() <= odd.count()
    clean = toxicity.score(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 0").count()
    assert toxicity.keep_clean(docs, spark.read.parquet(f"{SF}/labels.parquet")).count() == clean


def test_toxic_passage_is_found(spark):
    rnd = random.Random(4)
    plain = [f"word{i}" for i in range(400)]
    data, labels = [], []
    for i in range(600):
        ws = [rnd.choice(plain) for _ in range(rnd.randrange(20, 200))]
        bad = i % 5 == 0
        if bad:
            at = rnd.randrange(len(ws))
            ws[at:at] = rnd.sample(["vile", "nasty", "cruel", "awful"], 3)
        data.append((i, " ".join(ws)))
        labels.append((i, int(bad)))
    docs, lab = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in rows(toxicity.score(docs, lab))}
    for (i, text), (_, bad) in zip(data, labels):
        assert got[i]["predicted"] == bad
        if bad:
            p = got[i]["passages"][0]
            assert {"vile", "nasty", "cruel", "awful"} & set(text.replace("word", " w").split()) and p["last"] - p["first"] >= 2


# ------------------------------------------------------------------ personal data
def brute_pii(text):
    text = text or ""
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def ok(kind, m):
        d = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            s = 0
            for i, c in enumerate(reversed(d)):
                x = int(c) * (1 + i % 2)
                s += x - 9 * (x > 9)
            return 16 <= len(d) <= 19 and s % 10 == 0
        if kind == "phone":
            return 8 <= len(d) <= 15
        return True
    return [(k, m.start(), m.end()) for k, p in kinds.items() for m in re.finditer(p, text) if ok(k, m.group())]


PII_TEXTS = [
    "mail a.b@c.d.e, x@y and @z.q p%+-_@q-r.s_t@u.v w@a..b a@b.c+d@e.f",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0255 0000000000000255.1.1.1 9.9.9 1.1.1.300 12.34.56.78.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 79927398713 5500 0000 0000 0004  1 2",
    "call +49 (0) 30 123456-78 or +1 or +12345 +1234567890123456 +1.2.3.4.5.6.7.8 ++1 234 567 89(",
    "GB82 WEST 1234 5698 7654 32 ok DE89370400440532013000 bad DE89370400440532013001 XGB82WEST12345698765432",
    "é漢😀 a@b.co 😀 +49 30 1234567 é 10.0.0.1", "9" * 5000, "a" * 40000 + "@", "1 " * 20000, "+" + "1-" * 9000 + "2",
    ("me@x.org 10.1.2.3 +44 20 7946 0958 " * 600), "",
]


def test_pii(spark, odd, docs, empty):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*PII_TEXTS, None])], "doc_id long, text string")
    for df in (frame, docs, odd):
        data = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        got = Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"] if s["kind"] in pii.BASE))
                      for r in rows(pii.find(df)))
        assert got == Counter((i, tuple(brute_pii(t))) for i, t in data)
        for r in rows(pii.find(df)):
            for s in r["spans"]:
                assert 0 < s["score"] <= 1
    assert pii.find(empty).count() == 0
    by = {r["doc_id"]: r["spans"] for r in rows(pii.find(frame))}
    assert [s["text"] for s in by[4] if s["kind"] == "iban"] == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    near = {s["text"]: s["score"] for s in rows(pii.find(spark.createDataFrame(
        [(1, "my phone +49 30 1234567" + " x" * 60 + " +49 30 7654321")], "doc_id long, text string")))[0]["spans"]}
    assert near["+49 30 1234567"] > near["+49 30 7654321"]


def test_pii_digest(spark):
    for r in rows(pii.query(spark, SF)):
        base = [s for s in r["spans"].split(",") if s and s.split(":")[0] in pii.BASE]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [sum(s.startswith(k) for s in base) for k in pii.BASE] == [r[f"n_{k}"] for k in pii.BASE]


# ------------------------------------------------------------------ nearest neighbours
def exact_neighbours(data, every, k):
    ids = np.array([i for i, _ in data])
    unit = neighbours._unit(np.array([v for _, v in data], dtype=float))
    out = {}
    for q in np.flatnonzero(ids % every == 0):
        s = (unit * unit[q]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -s)) if j != q][:k]
        out[int(ids[q])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    data = [(r.vec_id, r.embedding) for r in df.collect()]
    want = exact_neighbours(data, 50, 5)
    got = defaultdict(list)
    for r in rows(neighbours.nearest(df)):
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    hits = sum(len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    vec = dict(data)
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        s = [x for _, _, x in sorted(found)]
        assert s == sorted(s, reverse=True)
        for _, i, x in found:
            a, b = np.array(vec[q], float), np.array(vec[i], float)
            assert i != q and x == pytest.approx(a @ b / math.sqrt((a @ a) * (b @ b)), abs=1e-12)


def test_exact_on_little(spark):
    """Everything is reranked here: ties, copies, unusable vectors, several blocks."""
    rnd = np.random.default_rng(8)
    base = rnd.normal(size=(60, 6)).round(2)
    data = [(i, base[i % 40].tolist()) for i in range(200)] + [(1000 + i, [1.0] * 6) for i in range(300)]
    bad = [(2000, None), (2050, [0.0] * 6), (2100, [1.0, float("nan")] + [1.0] * 4), (2150, [None] * 6), (None, [1.0] * 6),
           (2200, [float("inf")] * 6), (2250, []), (2300, [1.0, 2.0]), (50, base[10].tolist())]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<double>") \
        .select("*", F.lit(1).alias("v"), F.lit(2).alias("_id"), F.lit(0).alias("rank"))
    want = exact_neighbours(data, 50, 5)
    for block in (64, 10_000):
        got = defaultdict(list)
        for r in rows(neighbours.nearest(df, block=block, query_block=3, pivots=20, prefix=8)):
            got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
        assert set(got) == set(want)
        for q in want:
            assert [x for _, _, x in sorted(got[q])] == pytest.approx([s for _, s in want[q]])
            ties = defaultdict(list)
            for _, i, x in sorted(got[q]):
                ties[round(x, 9)].append(i)
            assert all(v == sorted(v) for v in ties.values())
            assert [i for _, i, _ in sorted(got[q])] == [i for i, _ in want[q]]
    assert neighbours.nearest(df.limit(0)).count() == 0
    two = spark.createDataFrame([(50, [1.0, 0.0]), (51, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in rows(neighbours.nearest(two))] == [(50, 1, 51)]


# ------------------------------------------------------------------ token rollups
def brute_totals(changes):
    from tokenizers import Tokenizer
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    docs, total = Counter(), Counter()
    for sign, source, lang, text in changes:
        for v, n in ((rollup.WORDS, len(words(text))), (tokens.TOKENIZER, len(tok.encode(text or "", add_special_tokens=False).ids))):
            docs[source, lang, v] += sign
            total[source, lang, v] += sign * n
    return {(*k, docs[k], total[k]) for k in docs if docs[k] or total[k]}


def test_rollup(spark, docs, odd, empty):
    store = f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"
    done = []
    batches = [("a", rollup.signed(docs, 1)), ("b", rollup.signed(odd, 1)),
               ("c", rollup.signed(docs.filter("doc_id % 3 = 0"), -1)), ("d", rollup.signed(empty, 1)),
               ("e", rollup.signed(odd, -1))]
    for name, changes in batches:
        assert rollup.apply_batch(store, name, changes)
        assert not rollup.apply_batch(store, name, changes)               # sent again: no effect
        done += [tuple(r) for r in changes.collect()]
        assert {tuple(r) for r in rollup.totals(spark, store).collect()} == brute_totals(done)
    with pytest.raises(ValueError):
        rollup.apply_batch(store, "x/y", empty)


def test_segments_take_linear_time():
    """Isolated positive scores stay apart; a few million steps, not a trillion."""
    import time
    begun = time.process_time()
    found = toxicity.segments([(30 * i, 1.0) for i in range(300_000)])
    assert len(found) == 300_000 and time.process_time() - begun < 30


def test_rollup_counts_committed_batches_only(spark, docs):
    """A store without batches is empty; what a failed attempt has written never counts."""
    store = f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"
    assert rollup.totals(spark, store).count() == 0
    rollup.delta(rollup.signed(docs, 5)).write.parquet(f"{store}/data/attempt")      # written, never committed
    assert rollup.totals(spark, store).count() == 0
    assert rollup.apply_batch(store, "a", rollup.signed(docs, 1))
    want = brute_totals([tuple(r) for r in rollup.signed(docs, 1).collect()])
    assert {tuple(r) for r in rollup.totals(spark, store).collect()} == want
    rollup.delta(rollup.signed(docs, 3)).write.parquet(f"{store}/data/another")
    assert {tuple(r) for r in rollup.totals(spark, store).collect()} == want


def test_rollup_of_two_writers(spark, docs):
    """Both have written before either commits: one of them counts."""
    store = f"{shared_dir(spark)}/test-{uuid.uuid4().hex}"
    for folder in ("one", "two"):
        rollup.delta(rollup.signed(docs, 1)).write.parquet(f"{store}/data/{folder}")
    assert [rollup._commit(spark, store, "a", folder) for folder in ("one", "two")] == [True, False]
    assert not rollup.apply_batch(store, "a", rollup.signed(docs, 1))
    want = brute_totals([tuple(r) for r in rollup.signed(docs, 1).collect()])
    assert {tuple(r) for r in rollup.totals(spark, store).collect()} == want


def test_rollup_query(spark, docs):
    done = [tuple(r) for _, c in rollup.changes_of(docs) for r in c.collect()]
    assert {tuple(r) for r in rollup.query(spark, SF).collect()} == brute_totals(done)
