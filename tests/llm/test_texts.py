"""Substring dedup, exact dedup, mixing, packing, sharding against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_llm import ODD, fold, rows, words
from lapworks.llm import exact_dedup, jaccard, mixing, packed, packing, sharding, substring, tokens
from lapworks.llm.common import components

LARGEST = 1 << 62


def _key(i):
    return LARGEST if i is None else i


# ------------------------------------------------------------------ substring dedup
def brute_substring(data, width=20):
    first, out = {}, []
    texts = {}
    for i, t in data:
        texts[_key(i), t] = words(t)
    for (i, t), ws in sorted(texts.items(), key=lambda x: x[0][0]):
        for p in range(len(ws) - width + 1):
            k = tuple(ws[p:p + width])
            first[k] = min(first.get(k, (i, p)), (i, p))
    for i, t in data:
        ws = words(t)
        gone = set()
        for p in range(len(ws) - width + 1):
            if first[tuple(ws[p:p + width])] != (_key(i), p):
                gone.update(range(p, p + width))
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def unique_ids(data):
    """Rows without the null ids but one (they count as one document)."""
    seen, out = set(), []
    for r in data:
        if r[0] is not None or None not in seen:
            out.append(r)
        seen.add(r[0])
    return out


def test_substring(spark, docs, odd, empty):
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))
    data = unique_ids([r[:2] for r in ODD])
    df = odd.filter("doc_id IS NOT NULL OR text LIKE 'no id%'")
    for frame, ref in ((docs, [tuple(r) for r in docs.select("doc_id", "text").collect()]), (df, data)):
        got = Counter(tuple(r) for r in substring.remove_repeats(frame.repartition(5)).drop("kept").collect())
        assert got == brute_substring(ref)
    assert substring.remove_repeats(odd).count() == len(ODD)
    assert substring.remove_repeats(empty).count() == 0


def test_substring_packing():
    import numpy as np
    key, _, ids, pos, state = substring._compare(*[np.array(x) for x in ([5, 5, 7, 5],)], None,
                                                 *[np.array(x) for x in ([2, 1, 3, 1], [0, 4, 9, 4])])
    assert ids.tolist() == [1, 2, 3] and state.tolist() == [substring.FIRST, substring.AGAIN, substring.ALONE]
    for v in ([-5, 3, 1 << 31], [-(1 << 63), (1 << 63) - 1], [7]):
        v = np.array(v, dtype=np.int64)
        assert packed.large(*packed.small(v), len(v)).tolist() == v.tolist()
    for v in ([0, 65535], [0, 65536]):
        assert packed.pos_in(packed.pos_out(np.array(v)), 2).tolist() == v


# ------------------------------------------------------------------ exact dedup
def brute_exact(data, keep):
    groups = defaultdict(list)
    for i, t in data:
        groups[fold(t)].append(i)
    out = []
    for i, t in data:
        g = groups[fold(t)]
        ids = [x for x in g if x is not None]
        stays = (max if keep == "largest" else min)(ids) if ids else None
        out.append((i, stays, len(g), i == stays, hashlib.sha256(fold(t).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("bits", [128, 2])
def test_exact(odd, docs, empty, keep, bits):
    """Two bits: nearly all texts collide, and the byte comparison alone tells them apart."""
    kw = {} if bits == 128 else {"hash_of": lambda sha: F.substring(F.hex(sha), 1, 1)}
    for frame in (odd, docs):
        data = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        got = Counter(tuple(r) for r in exact_dedup.exact_groups(frame, keep=keep, **kw).collect())
        assert got == brute_exact(data, keep)
    assert exact_dedup.exact_groups(empty, keep=keep, **kw).count() == 0


def test_drop_copies(odd, docs):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    texts = [fold(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({fold(r[1]) for r in ODD})
    assert exact_dedup.drop_copies(docs).count() == len({fold(r.text) for r in docs.select("text").collect()})


# ------------------------------------------------------------------ mixing
def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, out, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(out.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > most * sizes[s] + 1e-9}
        if not over:
            return out | share
        out |= {s: most * sizes[s] for s in over}
        free -= over
    return out


def test_mixing(odd, docs, empty):
    from lapworks.llm.common import prepare
    prepare(docs.sparkSession)
    for frame in (docs, odd, docs.withColumn("source", F.when(F.col("doc_id") < 150, F.lit("hot")).otherwise(F.col("source")))):
        data = [(r.doc_id, r.text, r.source) for r in frame.select("doc_id", "text", "source").collect()]
        sizes = Counter()
        for _, t, s in data:
            sizes[s] += len(words(t))
        want = brute_targets(dict(sizes))
        got = rows(mixing.mix(mixing.measure(frame)))
        assert Counter(r["doc_id"] for r in got) == Counter(d[0] for d in data)
        taken = Counter()
        for r in got:
            taken[r["source"]] += r["taken"]
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
            assert 0 <= r["taken"] <= 3 * r["size"]
            epochs = int(r["target"] / r["source_size"] + 1e-9) if r["source_size"] else 0
            assert r["taken"] >= epochs * r["size"]
        for s, t in want.items():
            assert abs(taken[s] - t) <= 1
        again = rows(mixing.mix(mixing.measure(frame.repartition(7))))
        order = lambda rs: sorted((str(r["doc_id"]), str(r["source"]), r["size"], r["taken"]) for r in rs)
        assert order(got) == order(again)
    assert mixing.mix(mixing.measure(empty)).count() == 0


def test_mixing_follows_the_weights(spark):
    """Documents of weight 1 are drawn before those of weight 0.1 far more often."""
    df = spark.range(4000).select(F.col("id").alias("_id"), F.lit("a").alias("source"), F.lit(10).cast("long").alias("size"),
                                  F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.1).alias("weight"))
    other = spark.range(4000, 4100).select(F.col("id").alias("_id"), F.lit("b").alias("source"),
                                           F.lit(150).cast("long").alias("size"), F.lit(1.0).alias("weight"))
    got = mixing.mix(df.unionByName(other), weights=(1.0, 3.0)).filter("source = 'a' AND taken > 0")
    n = got.groupBy((F.col("doc_id") % 2).alias("k")).count().collect()
    n = {r.k: r["count"] for r in n}
    assert n[0] > 3 * n.get(1, 0)


def test_mixed_documents(docs, odd):
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = mixing.mix(mixing.measure(docs)).agg(F.sum("taken")).first()[0]
    assert sum(len(words(r.text)) for r in out.collect()) == taken
    assert mixing.mixed_documents(odd).columns == odd.columns


# ------------------------------------------------------------------ packing
def test_packing(docs, odd, empty):
    from tokenizers import Tokenizer
    import numpy as np
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    for frame, capacity in ((docs, 4096), (odd, 4096), (docs, 100)):
        data = [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
        want = Counter()
        for i, t in data:
            ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 2], dtype="<u4")
            for s in range(0, len(ids), capacity):
                part = ids[s:s + capacity]
                want[i, s, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
        got = rows(packing.pack(frame, capacity=capacity))
        assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
        seqs = defaultdict(list)
        for r in got:
            seqs[r["sequence_id"]].append((r["offset"], r["length"]))
        for parts in seqs.values():
            at = 0
            for offset, n in sorted(parts):
                assert offset == at
                at += n
            assert at <= capacity
        total = sum(r["length"] for r in got)
        assert len(seqs) <= total / capacity * 1.15 + 2
        assert sorted(seqs) == list(range(len(seqs)))
    assert packing.pack(empty).count() == 0


def test_tokens_of_odd_words():
    from tokenizers import Tokenizer
    import numpy as np
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    for t in ["İstanbul ΑΣ straße ªº µ × 5×3 don't I'LL'd o'n x<|startoftext|>y", "ǅ ẞ \U0001d400 漢字 ١٢٣ ½ ﬁn ÀÉ÷ à",
              " \x1c\x85a", "a_b-c__ '''s 12ab34 ..;; \x7f \x01b", "<|endoftext|><|endoftext|>", "﻿x ​"]:
        got = np.frombuffer(tokens.encode_words([t.encode().split()])[0], "<u4").tolist()
        assert got == tok.encode(t, add_special_tokens=False).ids


# ------------------------------------------------------------------ sharding
def test_sharding(docs, odd, empty):
    for frame, shards in ((docs, 24), (odd, 24), (docs, 1), (docs, 2)):
        data = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        got = rows(sharding.shard(frame, shards))
        enc = lambda t: (t or "").encode()
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == \
            Counter((i, len(enc(t)) + 8, zlib.crc32(enc(t))) for i, t in data)
        by = defaultdict(list)
        for r in got:
            by[r["shard"]].append(r)
            assert 0 <= r["shard"] < shards and r["law"] == "bytes" and r["grown_shard"] is None
        for rs in by.values():
            assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
        homes = defaultdict(set)
        for r in got:
            homes[r["text_crc32"]].add(r["shard"])
        assert all(len(s) == 1 for s in homes.values())
        loads = [sum(r["size"] for r in rs) for rs in by.values()]
        biggest = max(Counter({t: sum(len(enc(x)) + 8 for _, x in data if x == t) for t in {t for _, t in data}}).values())
        assert max(loads) <= max(biggest, sum(loads) / shards * 1.05 + min(biggest, sum(loads) / shards / 10))
    assert sharding.shard(empty).count() == 0


def test_schedule_is_greedy():
    import heapq
    import random
    rnd = random.Random(3)
    bins = [(s, c, s * c) for s, c in {rnd.randrange(1, 3000): rnd.randrange(1, 40) for _ in range(60)}.items()]
    runs = sharding.schedule(bins, 7)
    loads = [0.0] * 7
    for size, rs in runs.items():
        for s, n in rs:
            loads[s] += size * n
    heap = [(0, s) for s in range(7)]
    for size, c, _ in sorted(bins, reverse=True):
        for _ in range(c):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + size, s))
    assert sorted(loads) == sorted(float(x) for x, _ in heap)
    hot = sharding.schedule([(10**12, 1, 10**12), (8, 10**9, 8 * 10**9)], 24)      # many groups: few steps
    assert sum(n for _, n in hot[8]) == 10**9


# ------------------------------------------------------------------ components
def test_components(spark):
    import random
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    alone = {a for a, b in edges if a == b}
    assert got == {x: find(x) for e in edges for x in e if x in got} and set(got) | alone == {x for e in edges for x in e}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def filled(histogram, capacity=packing.CAPACITY):
    plan = packing.patterns(histogram, capacity)
    placed = Counter()
    for lengths, packs in plan:
        assert packs > 0 and sum(lengths) <= capacity
        for n in lengths:
            placed[n] += packs
    assert placed == Counter({n: c for n, c in histogram.items() if c})
    return sum(n * c for n, c in histogram.items()) / (capacity * sum(packs for _, packs in plan))


def test_patterns_of_short_texts():
    """Equal short pieces are stacked: at least 98 % full."""
    assert filled({10: 100_000}) > 0.98 and filled({n: 2_000 for n in range(1, 51)}) > 0.98
    assert filled({7: 10**9, 4000: 10**6}) > 0.98 and filled({n: 10_000_000 // n for n in range(1, 4097)}) > 0.98
    assert sum(len(lengths) for lengths, _ in packing.patterns({n: 12_345 for n in range(1, 4097)})) < 200_000


def test_pack_one_line_texts(spark):
    """A table of one-line texts: gapless, nothing twice, at least 98 % full."""
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("one line"), F.col("id") % 7,
                                                                            F.repeat(F.lit("x "), (F.col("id") % 5).cast("int"))).alias("text"))
    got = packing.pack(df, capacity=512).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    assert len(got) == 6000 and sorted(by) == list(range(len(by)))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 512
    assert sum(r.length for r in got) / (512 * len(by)) > 0.98


def _thue_morse(n, one=b"a", other=b"b"):
    bits = [0]
    while len(bits) < n:
        bits += [1 - x for x in bits]
    return b"".join(one if x else other for x in bits)


def test_different_words_do_not_meet(spark):
    """A polynomial hash modulo 2**64 gives a Thue-Morse word and its mirror the same value."""
    from lapworks.llm import words as kernel

    def hashes(text, fold=False):
        buf = np.frombuffer(text, np.uint8)
        return kernel.word_hashes(buf, np.array([0, len(buf)]), fold)[0].tolist()
    x, y = _thue_morse(1024), _thue_morse(1024, b"b", b"a")
    assert x != y and hashes(x) != hashes(y)
    some = [b"abcdefgh", b"abcdefghi", b"a", b"aaaaaaaab", b"baaaaaaaa", b"aaaaaaaabaaaaaaaa", b"\xc3\xa9", x, y]
    assert len(set(hashes(b" ".join(some)))) == len(some)
    assert [h for w in some for h in hashes(w)] == hashes(b" ".join(some))          # whatever stands beside
    assert hashes(b"ABCdefghIJ a", True) == hashes(b"abcDEFGHij A", True)
    filler = " ".join(f"w{i}" for i in range(19))
    df = spark.createDataFrame([(1, f"{x.decode()} {filler}"), (2, f"{y.decode()} {filler}")], "doc_id long, text string")
    assert [r.n_removed for r in substring.remove_repeats(df).collect()] == [0, 0]
    two = spark.createDataFrame([(1, x.decode()), (2, y.decode()), (3, x.decode())], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(two).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_low_weights_spread_over_buckets(spark):
    """A source of low-weight rows is dealt into small buckets too (only one of them is ordered)."""
    n = 200_000
    rows = spark.range(n).select(F.col("id").alias("_id"), F.lit("figures").alias("source"), F.lit(3).cast("long").alias("size"),
                                 F.when(F.col("id") % 2 == 0, 0.1).otherwise(0.11).alias("weight"))
    rows = rows.unionByName(spark.range(n, n + 1000).select(F.col("id").alias("_id"), F.lit("prose").alias("source"),
                                                            F.lit(1000).cast("long").alias("size"), F.lit(1.0).alias("weight")))
    seen = []
    real = mixing.materialize

    def watched(df):
        out = real(df)
        if "_b" in out.columns:
            seen.append(out.groupBy("source", "_b").count().agg(F.max("count")).first()[0])
        return out
    mixing.materialize = watched
    try:
        got = mixing.mix(rows).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("want")).collect()
    finally:
        mixing.materialize = real
    assert seen and seen[0] < n / 100
    assert all(abs(r.t - r.want) <= 1 for r in got) and len(got) == 2


def test_columns_with_any_names(spark, docs):
    """Names that the operators use themselves are kept."""
    names = ("__k", "__sha", "_key", "_sha", "__id", "__source", "__size", "__taken", "__copy", "_doc", "_src", "_size", "_taken", "_copy")
    wide = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    kept = exact_dedup.drop_copies(wide)
    assert kept.columns == wide.columns and kept.count() == exact_dedup.drop_copies(docs).count()
    made = mixing.mixed_documents(wide)
    assert made.columns == wide.columns
    assert sorted(map(tuple, made.select(*docs.columns).collect()), key=str) == \
        sorted(map(tuple, mixing.mixed_documents(docs).collect()), key=str)
