"""Byte-level BPE tables of a ``tokenizers`` JSON file, and merging by a pair occurrence index.

The vocabulary file is a parameter (a path readable on every executor); nothing is trained.
"""

from __future__ import annotations

import functools
import gc
import heapq
import json
import re
from dataclasses import dataclass

import numpy as np
import regex

from panelcast.llm.common import own_memory

# Fixed value: the published split rule of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPLIT = regex.compile(SPLIT)
#: Parts that a process remembers beside other work, and where encoding is all it does: a memory smaller than the
#: words of the texts starts anew again and again, and almost every word is then merged each time.
PARTS, PARTS_ALONE = 250_000, 600_000


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files, by rule: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class ByteBpe:
    token_bytes: tuple          # id -> bytes
    byte_id: np.ndarray         # byte -> id of its one-byte token
    ranks: dict                 # left * size + right -> rank
    merged: list                # rank -> id of the merged token
    left: list
    right: list
    size: int
    special: dict               # text of an added token -> id
    special_rule: object        # pattern that splits at added tokens, or None
    pair_keys: np.ndarray       # sorted pair keys and their ranks, for vectorised lookups
    pair_ranks: np.ndarray


@functools.lru_cache(maxsize=4)
def load(path: str) -> ByteBpe:
    """Read a byte-level BPE file; other kinds of tokenizer files raise ValueError."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") or spec["model"].get("unk_token"):
        raise ValueError(f"{path} is not a plain byte-level BPE file")
    letters, vocab = byte_letters(), spec["model"]["vocab"]
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *added.values()]) + 1
    token_bytes: list = [b""] * size
    for t, i in vocab.items():
        if t not in added:
            token_bytes[i] = bytes(letters[c] for c in t)
    for t, i in added.items():
        token_bytes[i] = t.encode()
    byte_id = np.zeros(256, np.int64)
    for c, b in letters.items():
        byte_id[b] = vocab[c]
    ranks, merged, left, right = {}, [], [], []
    for r, m in enumerate(spec["model"]["merges"]):
        a, b = m if isinstance(m, list) else m.split(" ")
        left.append(vocab[a])
        right.append(vocab[b])
        merged.append(vocab[a + b])
        ranks[vocab[a] * size + vocab[b]] = r
    keys = np.fromiter(ranks.keys(), np.int64, len(ranks))
    order = np.argsort(keys)
    rule = re.compile("(" + "|".join(re.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
    return ByteBpe(tuple(token_bytes), byte_id, ranks, merged, left, right, size, added, rule, keys[order], np.fromiter(ranks.values(), np.int64, len(ranks))[order])


def pretokens(text: str) -> list[str]:
    return _SPLIT.findall(text)


def uncollected(fn):
    """``fn`` without passes of the cyclic garbage collector: it makes hundreds of thousands of small lists, none
    in a cycle, that live until it returns."""
    @functools.wraps(fn)
    def run(*args):
        on = gc.isenabled()
        gc.disable()
        try:
            return fn(*args)
        finally:
            if on:
                gc.enable()

    return run


def merge_all(words: list[bytes], bpe: ByteBpe) -> list[bytes]:
    """Token ids (little-endian unsigned 32-bit) of each word, all words merged together.

    The words lie in one linked array of symbols.  An index maps every pair that can merge
    (named by its rank) to all positions where it occurs.  Ranks are taken in ascending
    order; a rank's merge is applied at all its positions, left to right, and only the lists
    of the neighbouring pairs are extended.  Positions that an earlier merge changed are
    recognised when they are visited.  Words never merge across their border.
    """
    if not words:
        return []
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    n = len(flat)
    if not n:
        return [b""] * len(words)
    first = np.cumsum(lengths) - lengths
    word_of = np.repeat(np.arange(len(words)), lengths)
    ids = bpe.byte_id[flat]
    # pairs at the start: rank of (i, i+1) inside one word
    key = ids[:-1] * bpe.size + ids[1:]
    at = np.minimum(np.searchsorted(bpe.pair_keys, key), len(bpe.pair_keys) - 1)
    found = np.flatnonzero((bpe.pair_keys[at] == key) & (word_of[:-1] == word_of[1:]))
    rank = bpe.pair_ranks[at[found]]
    order = np.argsort(rank, kind="stable")
    found, rank = found[order], rank[order]
    cuts = np.flatnonzero(np.diff(rank)) + 1
    ends, at = [*cuts.tolist(), len(found)], found.tolist()
    index = {r: at[lo:hi] for r, lo, hi in zip(rank[np.r_[0, cuts]].tolist(), [0, *ends], ends)} if len(rank) else {}

    sym = ids.tolist()
    nxt = np.arange(1, n + 1)
    nxt[(first + lengths - 1)[lengths > 0]] = -1
    prv = np.arange(-1, n - 1)
    prv[first[lengths > 0]] = -1
    nxt, prv = nxt.tolist(), prv.tolist()
    active = list(index)
    heapq.heapify(active)
    rank_of, listed, size = bpe.ranks.get, index.get, bpe.size
    while active:
        r = heapq.heappop(active)
        positions = index.pop(r)
        positions.sort()
        a, b, c = bpe.left[r], bpe.right[r], bpe.merged[r]
        row = c * size
        for i in positions:
            if sym[i] != a:
                continue
            j = nxt[i]
            if j < 0 or sym[j] != b:
                continue
            k, h = nxt[j], prv[i]
            sym[i] = c
            sym[j] = -1
            nxt[i] = k
            if k >= 0:
                prv[k] = i
                q = rank_of(row + sym[k])
                if q is not None:
                    held = listed(q)
                    if held is not None:
                        held.append(i)
                    else:
                        index[q] = [i]
                        heapq.heappush(active, q)
            if h >= 0:
                q = rank_of(sym[h] * size + c)
                if q is not None:
                    held = listed(q)
                    if held is not None:
                        held.append(h)
                    else:
                        index[q] = [h]
                        heapq.heappush(active, q)
    out = np.array(sym, np.int64)
    alive = out >= 0
    ends = np.cumsum(np.bincount(word_of[alive], minlength=len(words))) * 4
    buf = out[alive].astype("<u4").tobytes()
    lo, result = 0, []
    for hi in ends.tolist():
        result.append(buf[lo:hi])
        lo = hi
    return result


class Encoder:
    """Encodes texts with a memory of parts already merged (one per Python process).

    A text is cut at spaces.  A part that neither is empty nor starts or ends with white space
    splits into the same pre-tokens wherever it stands, so its ids are kept under the part.
    Texts with other parts are split as a whole.  The memory is bounded by ``limit`` parts;
    beyond that it starts anew, which costs time only.
    """

    def __init__(self, path: str, value, limit: int = PARTS):
        """``value(list of pre-token bytes) -> list`` gives what is kept for each pre-token;
        values of consecutive pre-tokens are added with ``+``."""
        self.bpe, self.value, self.limit = load(path), value, limit
        self.tokens: dict = {}   # pre-token -> value
        self.parts: dict = {}    # part after a space -> value, None if it must be seen in its text
        self.opaque = False      # whether some part has None

    def _learn(self, words: set[str]) -> None:
        new = list(words.difference(self.tokens))
        if new:
            if len(self.tokens) + len(new) > self.limit:
                self.tokens = {}
                new = list(words)
            self.tokens.update(zip(new, self.value([w.encode() for w in new])))

    def _joined(self, words: list[str], zero):
        tokens = self.tokens
        if len(words) == 1:
            return tokens[words[0]]
        out = zero
        for w in words:
            out = out + tokens[w]
        return out

    @uncollected
    def pieces(self, texts: list[str], zero, special) -> list[list]:
        """For each text the list of values whose sum (in order) is the value of the text.
        ``special(id)`` is the value of an added token that stands in a text."""
        rule, known = self.bpe.special_rule, self.bpe.special
        cut: list[list] = []
        for t in texts:
            if rule is not None and "<" in t and rule.search(t):
                cut.append([known[x] if x in known else x.split(" ") for x in rule.split(t) if x])
            else:
                cut.append([t.split(" ")] if t else [])
        if len(self.parts) > self.limit:
            self.parts, self.opaque = {}, False
        parts = self.parts
        new: set = set()
        for c in cut:
            for x in c:
                if not isinstance(x, int):
                    new.update(x[1:])
        new = new.difference(parts)
        words_of, heads = {}, {}
        for p in new:
            if p.isascii() and p.isalpha():
                words_of[p] = [" " + p]      # one run of letters
            elif not p or p[0].isspace() or p[-1].isspace():
                parts[p], self.opaque = None, True
            else:
                words_of[p] = _SPLIT.findall(" " + p)
        for c in cut:
            for x in c:
                if not isinstance(x, int):
                    heads[x[0]] = _SPLIT.findall(x[0])
        self._learn({w for d in (words_of, heads) for ws in d.values() for w in ws})
        for p, ws in words_of.items():
            parts[p] = self._joined(ws, zero)
        out = []
        for c in cut:
            got: list = []
            for x in c:
                if isinstance(x, int):
                    got.append(special(x))
                    continue
                tail = list(map(parts.__getitem__, x[1:]))
                if (self.opaque and None in tail) or (tail and (not x[0] or x[0][-1].isspace())):
                    words = _SPLIT.findall(" ".join(x))
                    self._learn(set(words))
                else:
                    words = heads[x[0]]
                    if not all(map(self.tokens.__contains__, words)):
                        self._learn(set(words))
                got.extend(map(self.tokens.__getitem__, words))
                if words is heads[x[0]]:
                    got.extend(tail)
            out.append(got)
        return out


_ENCODERS: dict = {}


def encoder(path: str, kind: str, value, limit: int = PARTS) -> Encoder:
    """The process-wide encoder for a file and a kind of value; ``limit`` bounds its memory from this call on."""
    own_memory("bytebpe", _ENCODERS.clear)
    if (path, kind) not in _ENCODERS:
        _ENCODERS[path, kind] = Encoder(path, value, limit)
    _ENCODERS[path, kind].limit = limit
    return _ENCODERS[path, kind]
