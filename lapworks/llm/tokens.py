"""Token ids of texts under ``word_bpe_49k``, a public tokenizer whose words are independent.

It drops white space and never merges across it, so a text's ids are the ids of its
white-space separated words, one after another.  Words repeat: each worker keeps a
bounded table from word to ids and encodes only the words that it does not have.

New words of ASCII and Latin-1 letters are cut into the tokenizer's pieces in one pass
and merged by tiktoken under the same merge ranks, a word end being one more byte.  That
merges any neighbours that spell a token, the original only the token's own pair; both
agree when a token's spelling, merged by itself, gives that token (then at its rank the
neighbours are its pair).  Tokens for which this does not hold can never come up and are
left out of the ranks.  All other words go through the tokenizer itself, one by one.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

TOKENIZER = "word_bpe_49k.json"
TABLE_WORDS = 200_000

# The tokenizer's own splitting pattern, for the letters of the plain path.
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 ]+")
_PLAIN = np.zeros(257, dtype=bool)      # by code point; 256: any other
_PLAIN[[*range(0x20, 0x7F), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]] = True
_SPECIAL = "<|"
_END = b"\n"          # stands for the word end; no word holds it

_state: dict = {}


def _bytes_of_chars() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for
    the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}


def _load(name: str) -> dict:
    if _state.get("name") != name:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer, models
        path = name
        if not os.path.isabs(name):
            import public_tokenizers
            path = public_tokenizers.path(name)
        full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, byte = model["vocab"], _bytes_of_chars()
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        inner = models.BPE(vocab=vocab, merges=merges)       # no word end: for tokens inside words
        ids, ranks = [], {}

        def add(token: str, raw: bytes) -> None:
            ranks[raw] = len(ids)
            ids.append(vocab.get(token, 0))

        chars = {b: c for c, b in byte.items()}
        for b in range(256):
            add(chars[b], bytes([b]))
        for b in range(256):
            if b != _END[0]:
                add(chars[b] + "</w>", bytes([b]) + _END)
        for a, b in merges:
            token = a + b
            end = token.endswith("</w>")
            spelt = token[:-4] if end else token
            alone = (full.model if end else inner).tokenize(spelt)
            raw = bytes(byte[c] for c in spelt) + (_END if end else b"")
            if len(alone) == 1 and alone[0].id == vocab[token] and raw not in ranks:
                add(token, raw)
        fast = tiktoken.Encoding("words", pat_str="[^\\n ]+\\n", mergeable_ranks=ranks, special_tokens={})
        ends = np.zeros(len(ids), dtype=bool)
        ends[[r for raw, r in ranks.items() if raw.endswith(_END)]] = True
        _state.clear()
        _state.update(name=name, full=full, fast=fast, ends=ends, ids=np.array(ids, dtype="<u4"), table={})
    return _state


def _encode_new(new: list[bytes], st: dict) -> dict[bytes, bytes]:
    out, plain = {}, new
    rest: list[bytes] = []
    text = b" ".join(new).decode("utf-8", "replace")
    cp = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    odd = ~_PLAIN[np.minimum(cp, 256)]
    if odd.any() or _SPECIAL in text:
        of = np.searchsorted(np.flatnonzero(cp == 32), np.flatnonzero(odd))
        rest = [new[j] for j in sorted(set(of.tolist()))]
        rest_set = set(rest)
        if _SPECIAL in text:
            rest_set.update(w for w in new if _SPECIAL.encode() in w)
            rest = list(rest_set)
        plain = [w for w in new if w not in rest_set]
        text = b" ".join(plain).decode()
    if plain:
        marked = _PIECES.sub("\\g<0>\n", text.lower())
        got = np.array(st["fast"].encode_ordinary(marked), dtype=np.int64)
        stops = np.concatenate([[0], np.flatnonzero(st["ends"][got]) + 1])
        raw = np.frombuffer(marked.encode(), dtype=np.uint8)
        pieces = np.cumsum(raw == _END[0])
        at = stops[np.concatenate([[0], pieces[raw == 32], pieces[-1:]])]
        if at[-1] != len(got) or len(at) != len(plain) + 1:
            raise RuntimeError("the tokenizer's word ends do not match the pieces")
        ids, at = st["ids"][got].tobytes(), (at * 4).tolist()
        out = {w: ids[i:j] for w, i, j in zip(plain, at, at[1:])}
    if rest:
        texts = [w.decode("utf-8", "replace") for w in rest]
        for w, e in zip(rest, st["full"].encode_batch_fast(texts, add_special_tokens=False)):
            out[w] = np.asarray(e.ids, dtype="<u4").tobytes()
    return out


def encode_words(texts: list[list[bytes]], name: str = TOKENIZER) -> list[bytes]:
    """For each text, given as its words, the little-endian 32-bit ids."""
    st = _load(name)
    table = st["table"]
    distinct = set()
    for ws in texts:
        distinct.update(ws)
    missing = distinct.difference(table)
    if not missing:
        return [b"".join(map(table.__getitem__, ws)) for ws in texts]
    if len(table) + len(missing) > TABLE_WORDS and 2 * len(missing) > len(distinct):
        table.clear()                   # other words than before: start anew
        missing = distinct
    new = _encode_new(list(missing), st)
    if len(table) + len(new) <= TABLE_WORDS:
        table.update(new)
        return [b"".join(map(table.__getitem__, ws)) for ws in texts]
    get = {**{w: table[w] for w in distinct if w in table}, **new}.__getitem__
    return [b"".join(map(get, ws)) for ws in texts]
