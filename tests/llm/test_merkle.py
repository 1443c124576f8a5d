"""Merkle manifest against a manifest built by hand."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest_llm import ODD, SCHEMA, fold, rows
from lapworks.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, fanout):
    """The root of a list of digests, and for each of them its siblings by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, a in enumerate(at):
            run, slot = level[a - a % fanout:a - a % fanout + fanout], a % fanout
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        level = [h(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [a // fanout for a in at]
    return level[0], paths


def brute(data, fanout=16):
    """``data``: doc_id, source, lang, n_chars, text."""
    groups = defaultdict(list)
    for r in data:
        groups[r[1]].append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = climb([x[2] for x in groups[s]], fanout)
    root, tops = climb([trees[s][0] for s in names], fanout)
    out = []
    for s, top in zip(names, tops):
        for (_, _, own, r), path in zip(groups[s], trees[s][1]):
            path = path + top
            changed = own
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                changed = leaf((*r[:4], fold(r[4])))
            for left, right in path:
                changed = h(left, changed, right)
            out.append((r[0], own, trees[s][0], root, h(*[x for p in path for x in p]), changed, changed == root))
    return Counter(out)


def five(frame):
    return [tuple(r) for r in frame.select(*merkle.FIELDS).collect()]


@pytest.mark.parametrize("fanout", [16, 2])
def test_against_brute_force(spark, docs, odd, fanout):
    ref = [(i, s, lang, n, t) for i, t, lang, s, n in ODD]
    got = Counter(tuple(r) for r in merkle.tamper_check(odd.repartition(5), fanout=fanout).collect())
    assert got == brute(ref, fanout)
    if fanout == 16:
        got = [tuple(r) for r in merkle.tamper_check(docs).collect()]
        assert Counter(got) == brute(five(docs))
        assert 0 < sum(not r[-1] for r in got) < len(got)      # a tampered capital letter is noticed


def test_one_hot_source_and_lone_leaves(spark):
    """One source holds nearly all rows (three levels), others a single one."""
    data = [(i, f"Text {i}", "en", "hot", 6) for i in range(700)] + [(1000 + i, "x", "en", f"s{i:02d}", 1) for i in range(20)]
    data += [(2000, None, None, None, None)]
    df = spark.createDataFrame(data, SCHEMA).repartition(7)
    got = Counter(tuple(r) for r in merkle.tamper_check(df).collect())
    assert got == brute([(i, s, lang, n, t) for i, t, lang, s, n in data])


def test_one_row_no_row_and_any_change(spark, empty):
    assert merkle.tamper_check(empty).count() == 0
    one = merkle.tamper_check(spark.createDataFrame([(7, "Abc", "en", None, 3)], SCHEMA))
    r = rows(one)[0]
    assert r["leaf"] == r["subroot"] == r["root"] and r["proof_sha256"] == h()
    data = [(i, f"t{i}", "en", "ab"[i % 2], 2) for i in range(40)]
    made = merkle.manifest(
        spark.createDataFrame(data, SCHEMA).select("doc_id", "source", merkle.row_digest(
            [F.col(f) for f in merkle.FIELDS]).alias("leaf")), group="source", order=["doc_id"])
    other = F.lit(h("any other leaf"))
    assert made.filter(merkle.folded(F.col("path"), other) == F.lower(F.hex("root"))).count() == 0
    own = F.lower(F.hex("leaf"))
    assert made.filter(merkle.folded(F.col("path"), own) == F.lower(F.hex("root"))).count() == 40


def test_plan_has_no_python_and_no_single_task(spark, docs):
    plan = merkle.tamper_check(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "SinglePartition" not in plan
