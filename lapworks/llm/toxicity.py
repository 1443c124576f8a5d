"""Toxic passages as maximum-scoring segments of token log-odds.

*Tokens.*  On a bounded sample of labelled documents (near copies among them left out,
they would make their rare words look telling), each token and each stem of four letters
gets the log-odds of being in a toxic rather than a clean document, under a Dirichlet
prior of ``PRIOR`` documents spread by overall frequency; what counts is the end of the
confidence interval nearer to zero, so a token seen a few times says little.
*Segments.*  A document is the sequence of its tokens' scores, each less a small drift.
A linear-time scan finds all its maximal-scoring segments.
*Calibration.*  The best segment that chance gives a clean text of n tokens follows an
extreme-value law, ``P(best >= s) = 1 - exp(-K n exp(-lambda s))``; lambda and K come from
clean sample documents that the token counts have not seen.  A segment is significant if
this is below ``SIGNIFICANT``; the document's evidence is the sum of ``-ln P`` over these
(else that of its best one), turned into a probability by a logistic fit on the same
unseen documents.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapworks.llm import words
from lapworks.llm.common import prepare, table

SAMPLE_ROWS = 30_000      # labelled documents at most that the classifier is fitted on
FIT_PARTS = 3             # one in so many of them is kept for the calibration
VOCABULARY = 60_000       # scored tokens at most
LEAST_DOCS = 3            # documents of the sample that a scored token is in, at least
PRIOR = 20.0
CONFIDENCE = 1.645
STEM = 4
DRIFT = 0.08
MEMORY = 150_000          # words that a task remembers the scores of
SIGNIFICANT = 0.05
THRESHOLD = 0.3
MOST_EVIDENCE = 60.0      # beyond P = e**-60 texts are not told apart: their score is 1 to many digits

# a token is a run of letters, lower-cased: all other ASCII characters part tokens
_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def tokens(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def segments(scores: list[tuple[int, float]], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments ``(first, last, score)`` of a sequence that is 0 less
    ``drift`` everywhere but at the given ``(place, score)``, in order of place.

    One pass with a stack of disjoint candidates, each with the running sums before and
    after it; a new positive run is joined to the latest candidate that starts lower
    when it also ends higher.  Each candidate is linked to the latest earlier one that
    starts lower, so a search never passes the same candidate twice: the time is linear
    in the number of scores.
    """
    first, last, low, high, link = [], [], [], [], []      # of each candidate; sums before and after
    total, at = 0.0, -1
    for place, score in scores:
        total -= drift * (place - at - 1)
        at = place
        start, before = place, total
        total += score - drift
        if total <= before:
            continue
        while True:
            j = len(low) - 1
            while j >= 0 and low[j] >= before:
                j = link[j]
            if j < 0 or high[j] >= total:
                break
            start, before = first[j], low[j]
            del first[j:], last[j:], low[j:], high[j:], link[j:]
        for column, value in zip((first, last, low, high, link), (start, place, before, total, j)):
            column.append(value)
    return [(a, b, h - l) for a, b, l, h in zip(first, last, low, high)]


def evidence(found: list[tuple[int, int, float]], n: int, lam: float, k: float) -> tuple[float, list]:
    """Sum of ``-ln P`` over the significant segments, and these."""
    best, total, kept = 0.0, 0.0, []
    for a, b, s in found:
        x = k * max(n, 1) * math.exp(-lam * s)
        p = -math.expm1(-x)
        e = min(-math.log(p) if p > 0 else MOST_EVIDENCE, MOST_EVIDENCE)
        best = max(best, e)
        if p < SIGNIFICANT:
            total += e
            kept.append((a, b, s, p))
    return min(max(best, total), MOST_EVIDENCE), kept


def token_scores(rows: list[tuple[bytes, int, int]], toxic: int, clean: int) -> dict[bytes, float]:
    """``rows``: token, toxic and clean documents with it, of so many of either kind."""
    out = {}
    for w, t, c in rows:
        share = (t + c) / (toxic + clean)
        yt, yc = t + PRIOR * share + 1e-3, c + PRIOR * share + 1e-3
        nt, nc = toxic + PRIOR + 1, clean + PRIOR + 1
        odds = math.log(yt / (nt - yt)) - math.log(yc / (nc - yc))
        spread = CONFIDENCE * math.sqrt(1 / yt + 1 / yc)
        s = max(0.0, odds - spread) if odds > 0 else min(0.0, odds + spread)
        if s:
            out[w] = s
    most = sorted(out, key=lambda w: (-abs(out[w]), w))[:VOCABULARY]
    return {w: out[w] for w in most}


def stem(w: bytes) -> bytes | None:
    s = w.decode()
    return s[:STEM].encode() + b"*" if len(s) > STEM else None


class _Lookup(dict):
    """Word to score: its own or its stem's, the stronger; remembers a bounded number."""

    def __init__(self, scores):
        super().__init__()
        self.scores = scores

    def __missing__(self, w):
        own, other = self.scores.get(w, 0.0), self.scores.get(stem(w), 0.0)
        s = own if abs(own) >= abs(other) else other
        if len(self) < MEMORY:
            self[w] = s
        return s


def _found(look: _Lookup, text: str) -> tuple[np.ndarray, list[tuple[int, int, float]]]:
    """The scores of a text's tokens and its maximal-scoring segments."""
    v = np.array(list(map(look.__getitem__, tokens(text))), dtype=float)
    at = np.flatnonzero(v)
    return v, segments(list(zip(at.tolist(), v[at].tolist())))


def _texts(batch):
    buf, off = words.buffers(batch.column(1))
    raw = memoryview(buf)
    for k in range(batch.num_rows):
        yield bytes(raw[off[k]:off[k + 1]]).decode("utf-8", "replace")


def _sketches(batches):
    """``_id, text, toxic`` to four minima of hashes of the text's word 5-grams."""
    for b in batches:
        buf, off = words.buffers(b.column(1))
        out = []
        for k in range(b.num_rows):
            h, _ = words.word_hashes(buf, off[k:k + 2], fold=True)
            g = words.window_hashes(h, 5) if len(h) >= 5 else words.window_hashes(h, len(h)) if len(h) else h
            out.append([int(words.mix(g ^ np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64)).min() >> np.uint64(1))
                        if len(g) else None for i in range(4)])
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), *[pa.array([r[i] for r in out], pa.int64()) for i in range(4)]],
            ["_id", "toxic", "m0", "m1", "m2", "m3"])


def _count(part: dict):
    """Documents with each token: ``token, toxic documents, clean documents``."""
    def run(batches):
        t, c = Counter(), Counter()

        def flush():
            ws = list(t.keys() | c.keys())
            for i in range(0, len(ws), 50_000):
                w = ws[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(w, pa.binary()), pa.array([t[x] for x in w], pa.int64()),
                                                  pa.array([c[x] for x in w], pa.int64())], ["token", "t", "c"])
            t.clear()
            c.clear()

        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), _texts(b)):
                if i in part:
                    ws = set(tokens(text))
                    ws |= {s for s in map(stem, ws) if s}
                    (t if part[i] else c).update(ws)
            if len(t) + len(c) > 300_000:
                yield from flush()
        yield from flush()
        words.trim()
    return run


_LAMBDAS = np.round(np.geomspace(0.05, 10, 60), 6)


def _observe(part: dict, scores: dict):
    """Of the calibration documents: tokens, the best segment, and sums of exp(lambda s)."""
    def run(batches):
        look = _Lookup(scores)
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), _texts(b)):
                if i in part:
                    v, found = _found(look, text)
                    sums = [float(np.exp(x * (v - DRIFT)).sum()) for x in _LAMBDAS]
                    out.append((i, part[i], len(v), max((s for _, _, s in found), default=0.0), sums))
            if out:
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["_id", "toxic", "n", "best", "sums"])
    return run


def _weigh(part: dict, scores: dict, lam: float, k: float):
    """Of the calibration documents: the evidence."""
    def run(batches):
        look = _Lookup(scores)
        for b in batches:
            out = []
            for i, text in zip(b.column(0).to_pylist(), _texts(b)):
                if i in part:
                    v, found = _found(look, text)
                    out.append((i, part[i], evidence(found, len(v), lam, k)[0]))
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.float64()))],
                                                 ["_id", "toxic", "e"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept, by Newton steps with a light ridge; the slope is not negative."""
    base = (y.sum() + 0.5) / (len(y) + 1)
    w = np.array([0.1, math.log(base / (1 - base))])
    m = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
        grad = m.T @ (p - y) + 1e-3 * w
        hess = (m * (p * (1 - p))[:, None]).T @ m + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return max(float(w[0]), 0.0), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", label_col="toxic",
        sample_rows: int = SAMPLE_ROWS) -> dict | None:
    """The model, from the labelled documents whose ``crc32(id) mod 4`` is not 2, at most
    ``sample_rows`` of them (the first by a hash of the id); None if none is labelled.

    Everything collected is bounded by the sample or by ``VOCABULARY``; labels null or
    other than 0 and 1 are not used, of several labels of one id the larger is.
    """
    label = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(label_col).cast("int").alias("toxic")) \
        .filter(held_out(F.col("_id")) == F.lit(False))
    label = label.orderBy(F.xxhash64("_id"), "_id").limit(sample_rows)
    text = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"))
    sample = text.join(F.broadcast(label), "_id").select("_id", "_t", "toxic")       # bounded: the sample
    seen = [set() for _ in range(4)]
    parts: list[dict] = [{}, {}]
    rows = sample.mapInArrow(_sketches, "_id long, toxic int, m0 long, m1 long, m2 long, m3 long").collect()
    for r in sorted(rows, key=lambda r: (r["_id"], str(r["m0"]))):
        mins = [r[f"m{i}"] for i in range(4)]
        if mins[0] is None or any(m in s for m, s in zip(mins, seen)):
            continue
        for m, s in zip(mins, seen):
            s.add(m)
        which = zlib.crc32(b"part" + str(r["_id"]).encode()) % FIT_PARTS == 0
        parts[which][r["_id"]] = r["toxic"]
    counted, kept = parts
    toxic = sum(counted.values())
    if not toxic or toxic == len(counted):
        return None
    chosen = lambda ids: sample.join(F.broadcast(docs.sparkSession.createDataFrame(
        [(i,) for i in ids], "_id long")), "_id", "left_semi").select("_id", "_t")
    counts = chosen(counted).mapInArrow(_count(counted), "token binary, t long, c long") \
        .groupBy("token").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).filter(F.col("t") + F.col("c") >= LEAST_DOCS)
    counts = counts.orderBy(F.desc(F.col("t") + F.col("c")), "token").limit(5 * VOCABULARY).collect()
    scores = token_scores([(bytes(r["token"]), r["t"], r["c"]) for r in counts], toxic, len(counted) - toxic)
    # a few numbers for each document of the sample
    got = chosen(kept).mapInArrow(_observe(kept, scores), "_id long, toxic int, n long, best double, "
                                  "sums array<double>").collect() if kept else []
    got = sorted(got, key=lambda r: (r["_id"], r["n"], r["best"]))
    clean = [r for r in got if not r["toxic"] and r["n"]]
    if not clean:
        return {"scores": scores, "lam": 1.0, "k": 1.0, "slope": 1.0, "base": math.log(toxic / (len(counted) - toxic))}
    mean = np.sum([r["sums"] for r in clean], axis=0) / sum(r["n"] for r in clean)
    under = np.flatnonzero(mean <= 1.0)
    lam = float(_LAMBDAS[under[-1]]) if len(under) else 1.0
    best = np.array([r["best"] for r in clean])
    n = np.array([r["n"] for r in clean], dtype=float)
    k = len(clean) / float((n * np.exp(-lam * best)).sum())
    seen = chosen(kept).mapInArrow(_weigh(kept, scores, lam, k), "_id long, toxic int, e double").collect()
    seen = sorted((r["_id"], r["toxic"], r["e"]) for r in seen)
    slope, base = _logistic(np.array([e for _, _, e in seen]), np.array([t for _, t, _ in seen], dtype=float))
    return {"scores": scores, "lam": lam, "k": k, "slope": slope, "base": base}


def held_out(c):
    """Whether ``crc32`` of the id as text leaves 2 modulo 4 (null id: no)."""
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


_SCORED = "_id long, score double, passages array<struct<first:int,last:int,score:double,p:double>>"


def _score(model: dict):
    kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64()), ("p", pa.float64())]))

    def run(batches):
        look = _Lookup(model["scores"])
        for b in batches:
            score, passages = [], []
            for text in _texts(b):
                v, found = _found(look, text)
                e, kept = evidence(found, len(v), model["lam"], model["k"])
                score.append(1 / (1 + math.exp(-model["slope"] * e - model["base"])))
                passages.append([dict(zip(("first", "last", "score", "p"), s)) for s in kept])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score, pa.float64()), pa.array(passages, kind)],
                                             ["_id", "score", "passages"])
        words.trim()
    return run


def score(docs: DataFrame, labels: DataFrame, *, id_col="doc_id", text_col="text", label_col="toxic",
          threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, passages`` for each row.

    ``score``: the probability that the text is toxic; ``predicted``: 1 from
    ``threshold`` on; ``passages``: its significant segments, as places of tokens (runs of
    letters), with score and P.  Only the text is an input of a score.  Null and empty
    texts have the score of no evidence.  Without labels of both kinds all scores are 0.
    Repeated rows and null ids: rows as any other.  Other columns are not read.
    """
    prepare(docs.sparkSession)
    model = fit(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col, sample_rows=sample_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_t"))
    if model is None:
        out = rows.select("_id", F.lit(0.0).alias("score"), F.expr(
            "array()").cast("array<struct<first:int,last:int,score:double,p:double>>").alias("passages"))
    else:
        out = rows.mapInArrow(_score(model), _SCORED)
    return out.select(F.col("_id").alias("doc_id"), held_out(F.col("_id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def keep_clean(docs: DataFrame, labels: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    prepare(docs.sparkSession)
    model = fit(docs, labels, **kw)
    if model is None:
        return docs
    return docs.mapInArrow(_filter(model, docs.columns.index(kw.get("text_col", "text"))), docs.schema)


def _filter(model: dict, column: int, threshold: float = THRESHOLD):
    def run(batches):
        one = _score(model)
        for b in batches:
            narrow = pa.RecordBatch.from_arrays([pa.array(range(b.num_rows), pa.int64()), b.column(column)], ["_id", "_t"])
            got = next(one(iter([narrow])))
            keep = np.flatnonzero(got.column(1).to_numpy() < threshold)
            yield b.take(pa.array(keep))
        words.trim()
    return run


def query(spark, sf_dir):
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumn(
        "n_passages", F.size("passages")).drop("passages")
