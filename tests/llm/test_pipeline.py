"""The corpus pipeline, stage by stage, against brute force on what each stage reads."""

import zlib
from collections import Counter

import numpy as np
import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from conftest_llm import SF, fold, words
from lapworks.llm import mixing, registry, tokens, toxicity
from test_jaccard import brute


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    out, df = [spark.read.parquet(f"{SF}/documents.parquet")], None
    for i, (_, f) in enumerate(P.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        f(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(steps):
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard", "mixing", "packing"]
    for df in steps[1:5]:
        assert df.dtypes == steps[0].dtypes


def test_filters(spark, steps):
    docs, clean, exact, near, _, _ = steps
    bad = {r.doc_id for r in toxicity.score(docs, spark.read.parquet(f"{SF}/labels.parquet")).filter("predicted = 1").collect()}
    assert Counter(texts(clean)) == Counter(t for t in texts(docs) if t[0] not in bad)
    first = {}
    for i, t in texts(clean):
        first[fold(t)] = min(first.get(fold(t), i), i)
    assert sorted(i for i, _ in texts(exact)) == sorted(first.values())
    assert sorted(i for i, _ in texts(near)) == sorted({c for _, _, c in brute(texts(exact))})


def test_mix_and_pack(steps):
    from tokenizers import Tokenizer
    import public_tokenizers
    near, mixed, packed = steps[3:]
    taken = {r.doc_id: r.taken for r in mixing.mix(mixing.measure(near)).collect()}
    got = Counter()
    for i, t in texts(mixed):
        got[i] += len(words(t))
    assert got == Counter({i: n for i, n in taken.items() if n})
    tok = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    want = Counter()
    for i, t in texts(mixed):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        for s in range(0, len(ids), 4096):
            want[i, s, zlib.crc32(ids[s:s + 4096].tobytes())] += 1
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in packed.collect()) == want


def test_run(spark, steps):
    key = lambda df: Counter(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32").collect())
    assert key(P.run(spark, SF)) == key(steps[-1])


def test_odd_and_empty_tables(spark, odd, empty, tmp_path):
    """Nulls, repeats, extra columns of any name, no rows: no stage fails or loses a column."""
    for name, df in (("odd", odd.withColumn("__k", F.lit(1)).withColumn("__taken", F.lit(2))), ("none", empty)):
        docs = df
        for i, (_, stage) in enumerate(P.STAGES):
            path = str(tmp_path / f"{name}-{i}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            if i < 4:
                assert docs.columns == df.columns
        assert (docs.count() > 0) == (name == "odd")


def test_registry():
    import __spark_entry__ as E
    names = {n for n in E.queries() if n.startswith("op") or n == "pipeline"}
    assert names == {*registry.QUERIES, "pipeline"} and len(names) == 14
    assert set(registry.ORACLE) <= set(registry.QUERIES)
