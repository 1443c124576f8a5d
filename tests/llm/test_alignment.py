"""Cross-tokenizer alignment against plain loops over both token lists."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest_llm import ODD, SCHEMA, rows
from lapworks.llm import alignment

BYTES = {i: chr(i) for i in [*range(33, 127), *range(161, 173), *range(174, 256)]}
BYTES |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in BYTES)}
OF_CHAR = {c: b for b, c in BYTES.items()}


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return a, b


def tokens(tokenizers, text):
    """(id, bytes) of both, or nothing."""
    a, b = tokenizers
    if not text:
        return [], []
    xs = [(i, bytes(OF_CHAR[c] for c in a.id_to_token(i)))
          for i in a.encode(" " + text, add_special_tokens=False).ids]
    ys = []
    for i in b.encode(text):
        p = b.id_to_piece(i)
        ys.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
    want = (" " + text).encode()
    if b"".join(t for _, t in xs) != want or b"".join(t for _, t in ys) != want:
        return [], []
    return xs, ys


def ends(ts):
    out, at = [], 0
    for _, t in ts:
        at += len(t)
        out.append(at)
    return out


def brute(tokenizers, data):
    made, count = [], Counter()
    for i, t in data:
        xs, ys = tokens(tokenizers, t)
        ea, eb = ends(xs), ends(ys)
        links = [(xs[p][0], ys[q][0]) for p in range(len(xs)) for q in ([eb.index(ea[p])] if ea[p] in set(eb) else [])]
        common = sorted(set(ea) & set(eb))
        groups, lo = [], 0
        for hi in common:
            groups.append(",".join(str(x) for (x, _), e in zip(xs, ea) if lo < e <= hi) + "|"
                          + ",".join(str(y) for (y, _), e in zip(ys, eb) if lo < e <= hi))
            lo = hi
        count.update(links)
        made.append((i, len(xs), len(ys), common, links, ";".join(groups)))
    top = defaultdict(int)
    for (_, y), n in count.items():
        top[y] = max(top[y], n)
    return Counter((i, na, nb, len(c), len(ln), sum(count[p] == top[p[1]] for p in ln), sum(count[p] for p in ln),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, na, nb, c, ln, g in made)


EXTRA = [
    (50, "tabs\there\r\n and\r returns \r\n", "en", "a", 1), (51, "a piece mark ▁ here", "en", "a", 1),
    (52, "<|endoftext|> <s> </s> <unk> <0x41>", "en", "a", 1), (53, " leading  and trailing  \n\n ", "en", "a", 1),
    (54, "dash — and … dots。 全角　空白 x  y\x1c z\x85 w", "en", "a", 1), (55, "🙂 🙂🙂 é \U00010348", "en", "a", 1),
    (56, "don't we'll I'M 3.14 10,000 ++ --", "en", "a", 1), (57, " ", "en", "a", 1), (58, "\n", "en", "a", 1),
    (59, "\x00", "en", "a", 1), (60, "x" * 300 + " " + "ab " * 300, "en", "a", 1),
]


def test_against_loops(spark, tokenizers, docs, odd):
    some = docs.filter("n_chars < 6000")
    got = Counter(tuple(r) for r in alignment.linked_counts(some.repartition(3)).collect())
    assert got == brute(tokenizers, [tuple(r) for r in some.select("doc_id", "text").collect()])
    small = [r for r in ODD if r[1] is None or len(r[1]) < 5000] + EXTRA
    df = spark.createDataFrame(small, SCHEMA).repartition(4)
    got = Counter(tuple(r) for r in alignment.linked_counts(df).collect())
    assert got == brute(tokenizers, [r[:2] for r in small])
    assert alignment.linked_counts(odd).count() == len(ODD)


def test_small_chunks_and_table_agree(spark, docs, monkeypatch):
    """Many chunks and a table that is cleared again and again change nothing."""
    want = Counter(tuple(r) for r in alignment.linked_counts(docs).collect())
    texts = [r[0] for r in docs.select("text").collect()]
    loaded = alignment._load(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    plain = alignment._documents(texts, loaded)
    monkeypatch.setattr(alignment, "TABLE_WORDS", 50)
    monkeypatch.setattr(alignment, "CHUNK_LINKS", 100)
    loaded["table"].clear()
    assert [alignment._documents([t], loaded)[0] for t in texts] == plain
    assert Counter(tuple(r) for r in alignment.linked_counts(docs.repartition(6)).collect()) == want


def test_alignments_spell_the_text(spark, docs, empty, tokenizers):
    data = {r["doc_id"]: r["text"] for r in rows(docs.limit(20))}
    for r in alignment.alignments(docs.filter(docs.doc_id.isin(list(data)))).collect():
        raw = (" " + data[r.doc_id]).encode()
        xs, ys = tokens(tokenizers, data[r.doc_id])
        assert [i for g in r.groups for i in g.a] == [i for i, _ in xs]
        assert [i for g in r.groups for i in g.b] == [i for i, _ in ys]
        assert [g.start for g in r.groups] == [0, *[g.stop for g in r.groups][:-1]]
        assert r.groups[-1].stop == len(raw)
    assert alignment.alignments(empty).count() == 0 and alignment.linked_counts(empty).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)))
def test_gallop(a, b):
    x, y = np.array(sorted(a), dtype=np.int64), np.array(sorted(b), dtype=np.int64)
    assert alignment.gallop(x, y).tolist() == np.searchsorted(y, x).tolist()
    i, j = alignment.common_ends(x, y)
    assert x[i].tolist() == y[j].tolist() == sorted(a & b)


def test_gallop_far_from_the_finger():
    y = np.concatenate([np.arange(10), np.arange(10**6, 10**6 + 100_000)])
    x = np.concatenate([np.arange(5), [10**6 + 99_999, 10**7]])
    assert alignment.gallop(x, y).tolist() == np.searchsorted(y, x).tolist()
