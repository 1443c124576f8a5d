"""Winnowing against its definition."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import ODD, rows
from lapworks.llm import fingerprints as fp


def brute(text, k=fp.K, window=fp.WINDOW):
    """Positions by the definition: of each window the least hash, the rightmost of equals."""
    if not text:
        return []
    if len(text) < k:
        return [0]
    value = {}
    grams = [text[i:i + k] for i in range(len(text) - k + 1)]
    for g in set(grams):
        value[g] = int(fp.winnow([g], k, 1)[0][0][0])
    h = [value[g] for g in grams]
    out = set()
    for s in range(max(len(h) - window + 1, 1)):
        part = h[s:s + window]
        out.add(s + max(i for i, v in enumerate(part) if v == min(part)))
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab é漢\U0001F642", max_size=90), max_size=6), st.integers(1, 9), st.integers(1, 9))
def test_winnow(texts, k, window):
    for t, (h, p) in zip(texts, fp.winnow(texts, k, window)):
        assert p.tolist() == brute(t, k, window)
        assert len(h) == len(p)


def test_blocks_change_nothing(monkeypatch):
    rng = np.random.default_rng(7)
    texts = ["".join(rng.choice(list("abc "), n)) for n in (0, 5, 19, 20, 21, 51, 52, 700, 5000)]
    whole = fp.winnow(texts)
    monkeypatch.setattr(fp, "BLOCK", 97)
    for (h, p), (g, q) in zip(whole, fp.winnow(texts)):
        assert np.array_equal(h, g) and np.array_equal(p, q)
    assert [p.tolist() for _, p in whole[:-2]] == [brute(t) for t in texts[:-2]]


def test_guarantee():
    """A shared passage of k + window - 1 code points shares a fingerprint at its place."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        passage = "".join(rng.choice(list("abcdefgh "), fp.K + fp.WINDOW - 1))
        left, right = ("".join(rng.choice(list("mnopqr"), int(rng.integers(0, 200)))) for _ in range(2))
        (a, p), (b, q) = fp.winnow([left + passage, passage + right])
        inside = {int(h): int(i) - len(left) for h, i in zip(a, p) if i >= len(left)}
        assert any(inside.get(int(h)) == int(j) for h, j in zip(b, q))


def expected(data):
    """Contract rows; ``data`` has unique ids."""
    data = sorted(data, key=lambda r: -r[0])
    out = {}
    for (i, t), (_, u) in zip(data, data[1:] + data[:1]):
        t, u = t or "", u or ""
        n = len(t) // 3
        e = t[:len(t) - n] + u[:n]
        (h, p), (g, q), (o, _) = fp.winnow([t, e, u])
        near = lambda a, b: 1.0 if not len(a) and not len(b) else len(set(a) & set(b)) / len(set(a) | set(b))
        out[i] = (len(t), hashlib.sha256(e.encode()).hexdigest(), fp.encoded(h, p), fp.encoded(g, q),
                  near(h.tolist(), g.tolist()), near(h.tolist(), o.tolist()))
    return out


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_edit_check(spark, docs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = {r[0]: tuple(r)[1:] for r in fp.edit_check(docs.repartition(5)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = expected([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert got == want
    for h, p in (fp.winnow([r[0]])[0] for r in docs.select("text").limit(5).collect()):
        x, y = fp.decoded(fp.encoded(h, p))
        assert np.array_equal(x, h) and np.array_equal(y, p)


def test_odd_tables(spark, odd, empty):
    assert fp.edit_check(empty).count() == 0 and fp.fingerprints(empty).count() == 0
    seen, data = set(), []
    for r in ODD:                                       # unique ids first
        if r[0] is not None and r[0] not in seen:
            seen.add(r[0])
            data.append(r[:2])
    unique = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    got = {r[0]: tuple(r)[1:] for r in fp.edit_check(unique).collect()}
    assert got == expected(data)
    a, b = (Counter(tuple(r) for r in fp.edit_check(odd.repartition(n)).collect()) for n in (1, 6))
    assert a == b and sum(a.values()) == len(ODD)       # repeats and null ids: the same each time
    one = rows(fp.edit_check(unique.filter("doc_id = 8")))[0]
    assert one["near_next"] == 1.0                      # a single row is its own next
    plain = {r["doc_id"]: r for r in rows(fp.fingerprints(unique))}
    for i, t in data:
        h, p = fp.winnow([t or ""])[0]
        assert plain[i]["hashes"] == h.view(np.int64).tolist() and plain[i]["positions"] == p.tolist()


def test_likeness_is_graded(spark, docs):
    """Two thirds kept: about half of the joint fingerprint; other texts far below."""
    got = [r for r in rows(fp.edit_check(docs)) if r["n_chars"] >= 1000]
    assert 0.35 < sum(r["near_edited"] for r in got) / len(got) < 0.65
    assert sum(r["near_next"] for r in got) / len(got) < 0.05
