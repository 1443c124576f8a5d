"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes; where a token of either ends at the same byte the text
falls into groups.  The shorter list of ends drives an exponential-plus-binary search into
the longer; the common ends' ranks slice both token lists, and the differences of ranks
say how many tokens of each tokenizer cover a group.

Neither tokenizer merges across a word's end before a space or a line feed, so such a place
is a common end and a word's alignment is the same wherever the word stands: each worker
aligns the words that it has not met, all together, and keeps a bounded table of them.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapworks.llm import words
from lapworks.llm.common import materialize, prepare, table

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
TABLE_WORDS = 150_000        # alignments that a worker keeps
LONG_WORD = 100              # longer ones are aligned each time
CHUNK_LINKS = 1 << 19        # links of one chunk of documents (a longer document is one)

# A word with the spaces and line feeds before it; what may stand before a cut for certain:
# neither tokenizer takes it for white space.
_WORDS = re.compile("[ \n]*[^ \n]+|[ \n]+")
_DOUBTFUL = re.compile("[^!-~\\w \n][ \n]")
_CERTAIN = re.compile("(?s:.*?[!-~\\w](?=[ \n])|.+)")

_state: dict = {}


def _path(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def _load(a: str, b: str) -> dict:
    """Both tokenizers, the bytes of their tokens, and an empty table."""
    if _state.get("names") != (a, b):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        from lapworks.llm.tokens import _bytes_of_chars
        first = Tokenizer.from_file(_path(a))
        first.encode_special_tokens = True                     # their strings are plain text
        byte = _bytes_of_chars()
        bytes_a = [b""] * first.get_vocab_size()
        for token, i in first.get_vocab().items():
            if all(c in byte for c in token):
                bytes_a[i] = bytes(byte[c] for c in token)
        second = sentencepiece.SentencePieceProcessor(model_file=_path(b))
        pieces = [second.id_to_piece(i) for i in range(second.vocab_size())]
        bytes_b = [bytes([int(p[3:5], 16)]) if second.is_byte(i) else b"" if second.is_control(i)
                   else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        spelt = [p.replace("▁", " ") for i, p in enumerate(pieces) if bytes_b[i]]
        whole = any(re.search("[^ \n][ \n]", p.lstrip(" \n")) for p in spelt if p.strip(" \n"))
        # ids as text with what may follow them: another token, the other tokenizer, another group
        texts = [f"{i}{c}" for i in range(max(len(bytes_a), len(bytes_b))) for c in ",|;"]
        _state.clear()
        _state.update(names=(a, b), a=first, b=second, bytes_a=bytes_a, bytes_b=bytes_b, table={}, whole=whole,
                      len_a=np.array([len(x) for x in bytes_a]), len_b=np.array([len(x) for x in bytes_b]),
                      spelt=texts, len_spelt=np.array([len(x) for x in texts]))
    return _state


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of ``short`` the index of the first element of ``long`` not below it; both
    ascending.  From a finger at the same relative rank, steps double until the element is
    bracketed, then the bracket is halved; all elements take their steps together."""
    n, m = len(short), len(long)
    if not n or not m:
        return np.zeros(n, dtype=np.int64)
    at = np.arange(n, dtype=np.int64) * m // n
    right = long[at] < short
    low = np.where(right, at, -1)                # long[low] < element
    high = np.where(right, m, at)                # long[high] >= element
    live, step = np.arange(n), 1
    while len(live):
        to = at[live] + np.where(right[live], step, -step)
        inside = (to >= 0) & (to < m)
        live, to = live[inside], to[inside]
        less = long[to] < short[live]
        low[live[less]] = to[less]
        high[live[~less]] = to[~less]
        live = live[less == right[live]]
        step *= 2
    live = np.flatnonzero(high - low > 1)
    while len(live):
        mid = (low[live] + high[live]) >> 1
        less = long[mid] < short[live]
        low[live[less]] = mid[less]
        high[live[~less]] = mid[~less]
        live = live[high[live] - low[live] > 1]
    return high


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks in ``a`` and in ``b`` (strictly ascending ends) of the ends they share."""
    if len(a) > len(b):
        return common_ends(b, a)[::-1]
    at = gallop(a, b)
    met = at < len(b)
    met[met] = b[at[met]] == a[met]
    return np.flatnonzero(met), at[met]


def _encode(st: dict, text: str):
    """Ids and ends of both tokenizers for ``text``, which begins with a space or a line
    feed; None where their tokens do not spell it."""
    raw = text.encode()
    # a word before it keeps the added space of the second tokenizer out of the way
    a = st["a"].encode_batch_fast([" a" + text], add_special_tokens=False)[0].ids
    b = st["b"].encode("a" + text)
    if b"".join(map(st["bytes_a"].__getitem__, a)) != b" a" + raw \
            or b"".join(map(st["bytes_b"].__getitem__, b)) != b" a" + raw:
        return None
    a, b = np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)
    ends_a, ends_b = np.cumsum(st["len_a"][a]) - 2, np.cumsum(st["len_b"][b]) - 2
    a, ends_a, b, ends_b = a[ends_a > 0], ends_a[ends_a > 0], b[ends_b > 0], ends_b[ends_b > 0]
    return a, ends_a, b, ends_b


def _aligned(st: dict, text: str):
    got = _encode(st, text)
    if got is None:
        return None
    a, ends_a, b, ends_b = got
    return (*got, *common_ends(ends_a, ends_b))


def _records(st: dict, units: list[str]) -> dict:
    """For each word: tokens of A, tokens of B, its groups as text, its links packed; None
    where the tokens do not spell it."""
    out = {}
    tail = [u for u in units if not u.strip(" \n")]            # blanks at a text's end: not before a word
    rest = [u for u in units if u.strip(" \n")]
    for some in [*([u] for u in tail), rest]:
        if not some:
            continue
        got = _aligned(st, "".join(some))
        if got is None:
            if len(some) == 1:
                out[some[0]] = None
            else:                                              # one of them is not spelt
                half = len(some) // 2
                out.update(_records(st, some[:half]))
                out.update(_records(st, some[half:]))
            continue
        a, ends_a, b, _, ia, ib = got
        bounds = np.cumsum([len(u.encode()) for u in some])
        last = np.searchsorted(ends_a[ia], bounds)             # each word's last group
        if not np.array_equal(ends_a[ia[last]], bounds):
            raise RuntimeError("a token crosses the end of a word")
        # groups as text, all words at once: tokens of A, then those of B, group by group
        of_a, of_b = np.searchsorted(ia, np.arange(len(a))), np.searchsorted(ib, np.arange(len(b)))
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        at_a = np.arange(len(a))
        codes[at_a + np.concatenate([[0], ib + 1])[of_a]] = 3 * a + (at_a == ia[of_a])
        at_b = np.arange(len(b))
        codes[at_b + ia[of_b] + 1] = 3 * b + 2 * (at_b == ib[of_b])
        text = "".join(map(st["spelt"].__getitem__, codes.tolist()))
        stop = np.cumsum(st["len_spelt"][codes])[ia[last] + ib[last] + 1].tolist()
        links = (a[ia] * len(st["bytes_b"]) + b[ib]).astype("<u8").tobytes()
        cut = (8 * (last + 1)).tolist()
        out.update(zip(some, zip(np.diff(ia[last] + 1, prepend=0).tolist(), np.diff(ib[last] + 1, prepend=0).tolist(),
                                 [text[i:j - 1] for i, j in zip([0, *stop], stop)],
                                 [links[i:j] for i, j in zip([0, *cut], cut)])))
    return out


def units_of(text: str, whole: bool = False) -> list[str]:
    """A space and ``text``, cut where both tokenizers certainly end a token."""
    text = " " + text
    if whole:
        return [text]
    if _DOUBTFUL.search(text):
        return _CERTAIN.findall(text)
    return _WORDS.findall(text)


def _documents(texts: list[str], st: dict) -> list:
    """For each text: tokens of A, of B, groups as text, packed links (0, 0, "", b"" where
    it has no tokens)."""
    none = (0, 0, "", b"")
    units = [units_of(t, st["whole"]) if t else [] for t in texts]
    known = st["table"]
    distinct = set()
    for us in units:
        distinct.update(us)
    missing = distinct.difference(known)
    if len(known) + len(missing) > TABLE_WORDS and 2 * len(missing) > len(distinct):
        known.clear()                                          # other words than before: start anew
        missing = distinct
    new = _records(st, list(missing)) if missing else {}
    keep = {u: r for u, r in new.items() if len(u) <= LONG_WORD}
    if len(known) + len(keep) <= TABLE_WORDS:
        known.update(keep)
        get = known.__getitem__ if len(keep) == len(new) else (known | new).__getitem__
    else:
        get = (known | new).__getitem__
    out = []
    for us in units:
        got = list(map(get, us))
        if not got or None in got:
            out.append(none)
            continue
        na, nb, groups, links = zip(*got)
        out.append((sum(na), sum(nb), ";".join(groups), b"".join(links)))
    return out


def _texts(col) -> list[str]:
    return [t or "" for t in col.to_pylist()]


def alignments(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", a: str = TOKENIZER_A,
               b: str = TOKENIZER_B) -> DataFrame:
    """``doc_id, groups``: each document's groups as ``start, stop`` (bytes of the space and
    the text), ``a``, ``b`` (token ids).

    Null and empty texts, and texts that one of the tokenizers does not spell, have no
    groups.  Null ids and repeated rows are rows like any other.  No rows: no rows.
    """
    prepare(docs.sparkSession)
    group = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("a", pa.list_(pa.int32())),
                       ("b", pa.list_(pa.int32()))])

    def one(st, text):
        got = _aligned(st, " " + text) if text else None
        if got is None:
            return []
        x, ends, y, _, ia, ib = got
        stops = ends[ia].tolist()
        return [{"start": p, "stop": q, "a": x[i:j].tolist(), "b": y[m:n].tolist()}
                for p, q, i, j, m, n in zip([0, *stops], stops, [0, *(ia + 1)], ia + 1, [0, *(ib + 1)], ib + 1)]

    def run(batches):
        st = _load(a, b)
        for batch in batches:
            for i, j in words.slices(words.buffers(batch.column(1))[1]):
                made = [one(st, t) for t in _texts(batch.column(1).slice(i, j - i))]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(made, pa.list_(group))],
                                                 ["doc_id", "groups"])
    narrow = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    return narrow.mapInArrow(run, "doc_id long, groups array<struct<start:long,stop:long,a:array<int>,b:array<int>>>")


_CHUNKED = ("chunk long, place int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary, "
            "pairs array<long>, counts array<long>")
_CODEC = "zstd"


def _packed(rank: np.ndarray) -> bytes:
    """Numbers that are mostly small: all lowest bytes, all second bytes, ..., compressed."""
    planes = rank.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.Codec(_CODEC, compression_level=1).compress(np.ascontiguousarray(planes).tobytes(), asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec(_CODEC).decompress(data, 4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _chunked(a: str, b: str):
    """Documents by chunk, and for each chunk a row with its distinct linked pairs, the most
    frequent first, their counts, and the links as ranks among them."""
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = [f.split()[0] for f in _CHUNKED.split(", ")]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def pairs_of(chunk, links):
        pairs, at, counts = np.unique(np.frombuffer(b"".join(links), "<u8").astype(np.int64),
                                      return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        return batch_of([(chunk, *[None] * 6, _packed(rank[at]), pairs[order], counts[order])])

    def run(batches):
        st = _load(a, b)
        chunk, held, size, place = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in batches:
            for i, j in words.slices(words.buffers(batch.column(1))[1]):
                ids = batch.column(0).slice(i, j - i).to_pylist()
                rows = []
                for d, (na, nb, groups, links) in zip(ids, _documents(_texts(batch.column(1).slice(i, j - i)), st)):
                    sha = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                    rows.append((chunk, place, d, na, nb, len(links) // 8, sha, None, None, None))
                    held.append(links)
                    size, place = size + len(links) // 8, place + 1
                    if size >= CHUNK_LINKS:
                        yield batch_of(rows)
                        yield pairs_of(chunk, held)
                        chunk, held, size, place, rows = chunk + 1, [], 0, 0, []
                if rows:
                    yield batch_of(rows)
        if size:
            yield pairs_of(chunk, held)
        words.trim()
    return run


def _score(chunk: pa.Table, pairs: pa.Table) -> pa.Table:
    """A chunk's documents with the corpus counts of its pairs."""
    is_doc = pc.is_valid(chunk["place"])
    docs = chunk.filter(is_doc).sort_by("place")
    n = docs["n_groups"].to_numpy()
    at = np.concatenate([[0], np.cumsum(n)])
    sums = np.zeros((2, at[-1] + 1), dtype=np.int64)          # prefix sums over the chunk's links
    if at[-1]:
        rank = _unpacked(chunk.filter(pc.invert(is_doc))["links"][0].as_py(), int(at[-1]))
        of_pair = np.zeros((2, pairs.num_rows), dtype=np.int64)
        where = pairs["rank"].to_numpy()
        of_pair[0, where] = pairs["best"].to_numpy(zero_copy_only=False)
        of_pair[1, where] = pairs["total"].to_numpy()
        np.cumsum(of_pair[:, rank], axis=1, out=sums[:, 1:])
    best, total = sums[:, at[1:]] - sums[:, at[:-1]]
    keep = docs.select(["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"])
    return keep.append_column("n_best", pa.array(best)).append_column("count_sum", pa.array(total))


def linked_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", a: str = TOKENIZER_A,
                  b: str = TOKENIZER_B) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row.

    A link is a token of ``a`` and one of ``b`` that end together (so a group has one); an
    id pair's count is the number of links of the whole table that hold it; a link is best
    if no other pair of its ``b`` id has a higher count.

    Documents are read and tokenized once, into chunks whose links are packed as ranks among
    the chunk's pairs.  What is shuffled for the counts is each chunk's distinct pairs: a pair that
    occurs everywhere has one row a chunk, and partial sums before that.  The counts come
    back to the chunks, so no task needs all pairs, nor a document a row for each link.

    Null and empty texts, and texts that a tokenizer does not spell: zeros and an empty
    ``groups_sha256``.  Null ids and repeated rows are rows (and count) like any other.
    Other columns of ``docs`` are not read.  No rows: no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    narrow = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    made = materialize(narrow.mapInArrow(_chunked(a, b), _CHUNKED))
    vocabulary = _vocabulary(b)
    uses = made.filter("pairs IS NOT NULL") \
        .select("chunk", F.posexplode(F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))).alias("rank", "u")) \
        .select("chunk", "rank", "u.pair", "u.n")
    totals = uses.groupBy("pair").agg(F.sum("n").alias("total"))
    # at most as many rows for an id of b as a has tokens
    of_b = Window.partitionBy(F.col("pair") % vocabulary)
    totals = totals.select(F.col("pair").alias("_pair"), "total", (F.col("total") == F.max("total").over(of_b)).alias("best"))
    back = uses.join(totals, F.col("pair") == F.col("_pair")).select(F.col("chunk").alias("_chunk"), "rank", "total", "best")
    rows = made.drop("pairs", "counts")
    scored = rows.groupBy("chunk").cogroup(back.groupBy("_chunk")).applyInArrow(
        _score, "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_best long, count_sum long")
    return scored.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best",
                         "count_sum", "groups_sha256")


def _vocabulary(b: str) -> int:
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=_path(b)).vocab_size()


def query(spark, sf_dir):
    return linked_counts(table(spark, sf_dir, "documents"))
