"""Operator 8: byte-level BPE by speculation and verification.

Texts are cut into words by the tokenizer's own pattern.  For the distinct new words of a
batch the greedy longest match through a byte trie proposes tokens, all words at once.  A
proposal equals the exact merge order's result if every two neighbours are compatible:
taking both apart again, latest merge first, no merge across their border would have come
earlier.  That test runs over all distinct neighbours as arrays.  Only words that fail it
are merged exactly, pair by pair in rank order.

The tokenizer file is a parameter (the usual JSON form: ``model.vocab``, ``model.merges``,
``added_tokens``); it travels to the tasks as one broadcast of a few MB and is never trained
or changed here.  Texts stay where they are: one pass, no shuffle.

Defined cases: null and empty texts have no ids and decode to the empty text; the string of
an added token becomes that token, as in the file's own library; a token that cannot be
reached by merges never passes verification; very long words are merged with a heap, so the
time stays near linear; repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pitchside.llm.common import text_rows

#: The pattern of the byte-level family (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words a worker remembers before it starts afresh.
CACHE_WORDS = 400_000
NEVER = np.iinfo(np.int32).max


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters stand for themselves, the other bytes for the letters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model, letters = spec["model"], _byte_letters()
        vocab = model["vocab"]
        added = {a["content"]: a["id"] for a in spec.get("added_tokens") or []}
        size = max([*vocab.values(), *added.values()]) + 1
        self.piece: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in added:
                self.piece[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.piece[i] = token.encode()
        self.length = np.array([len(p) for p in self.piece], np.int64)
        self.added = added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(PATTERN).findall
        self.byte_id = np.full(256, -1, np.int32)
        for i, p in enumerate(self.piece):
            if len(p) == 1:
                self.byte_id[p[0]] = i

        # merges: rank of each token, its two halves, and a sorted table of pairs
        self.rank = np.full(size, -1, np.int32)
        self.left, self.right = np.arange(size, dtype=np.int32), np.arange(size, dtype=np.int32)
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            t, a, b = vocab[a + b], vocab[a], vocab[b]
            self.merge[a, b] = (r, t)
            if self.rank[t] < 0:
                self.rank[t], self.left[t], self.right[t] = r, a, b
        self.span = size
        keys = np.fromiter((a * size + b for a, b in self.merge), np.int64, len(self.merge))
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_rank = np.fromiter((r for r, _ in self.merge.values()), np.int32, len(keys))[order]

        # a token is sound if its own merge is the one that the order of ranks leads to
        made = np.flatnonzero(self.rank >= 0)
        self.sound = np.zeros(size, bool)
        self.sound[self.byte_id[self.byte_id >= 0]] = True
        whole = self._compatible(self.left[made], self.right[made], self.rank[made])
        for t, fine in zip(made[np.argsort(self.rank[made])], whole[np.argsort(self.rank[made])]):
            self.sound[t] = fine and self.sound[self.left[t]] and self.sound[self.right[t]]
        self._trie()
        self.cache: dict[str, bytes] = {}

    # -- proposal -------------------------------------------------------------------

    def _trie(self) -> None:
        """Transitions as sorted keys state * 256 + byte; the root has a direct table."""
        states: dict[bytes, int] = {b"": 0}
        edges, token = [], [-1]
        for t in np.flatnonzero(self.sound):
            p = self.piece[t]
            for k in range(1, len(p) + 1):
                if p[:k] not in states:
                    states[p[:k]] = len(token)
                    edges.append((states[p[:k - 1]] * 256 + p[k - 1], len(token)))
                    token.append(-1)
            token[states[p]] = int(t)
        edges.sort()
        self.edge_keys = np.array([k for k, _ in edges], np.int64)
        self.edge_to = np.array([s for _, s in edges], np.int32)
        self.state_token = np.array(token, np.int32)
        self.first = np.full(256, -1, np.int32)
        for k, s in edges:
            if k < 256:
                self.first[k] = s

    def _propose(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words at once: (word, token) in order of word and place."""
        words, tokens = [], []
        word, at = np.arange(len(starts)), starts.copy()
        while len(word):
            best, size = np.full(len(word), -1, np.int32), np.ones(len(word), np.int64)
            live, state, step = np.arange(len(word)), np.zeros(len(word), np.int64), 0
            while len(live):
                byte = data[at[live] + step]
                if step == 0:
                    to = self.first[byte]
                else:
                    key = state * 256 + byte
                    k = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
                    to = np.where(self.edge_keys[k] == key, self.edge_to[k], -1)
                step += 1
                go = to >= 0
                live, state = live[go], to[go].astype(np.int64)
                t = self.state_token[state]
                hit = t >= 0
                best[live[hit]], size[live[hit]] = t[hit], step
                go = at[live] + step < ends[word[live]]
                live, state = live[go], state[go]
            words.append(word)
            tokens.append(best)
            at = at + size
            go = at < ends[word]
            word, at = word[go], at[go]
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")  # rounds come in order, so places stay in order
        return word[order], token[order]

    # -- verification ---------------------------------------------------------------

    def _compatible(self, a: np.ndarray, b: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge across the border of a and b comes before both are whole (or before ``before``)."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        limit = np.full(len(x), NEVER, np.int64) if before is None else before.astype(np.int64)
        ok, live = np.ones(len(x), bool), np.arange(len(x))
        while len(live):
            key = x[live] * self.span + y[live]
            k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            r = np.where(self.pair_keys[k] == key, self.pair_rank[k], NEVER)
            bad = r < limit[live]
            ok[live[bad]] = False
            live = live[~bad]
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            more = (rx >= 0) | (ry >= 0)
            live, rx, ry = live[more], rx[more], ry[more]
            # the half that was made later is taken apart first; of equal ranks the right one was
            from_x = rx > ry
            lx, ly = live[from_x], live[~from_x]
            limit[lx], x[lx] = rx[from_x], self.right[x[lx]]
            limit[ly], y[ly] = ry[~from_x] + 1, self.left[y[ly]]
        return ok

    # -- exact merging ----------------------------------------------------------------

    def merged(self, word: bytes) -> list[int]:
        """Merges in order of rank, leftmost first, with a heap of neighbouring pairs."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        nxt, prev = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m[0], i, ids[i], ids[i + 1], m[1]) for i in range(n - 1) if (m := self.merge.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, t = heapq.heappop(heap)
            j = nxt[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = t, -1
            nxt[i] = nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
                if m := self.merge.get((t, ids[nxt[j]])):
                    heapq.heappush(heap, (m[0], i, t, ids[nxt[j]], m[1]))
            if prev[i] >= 0 and (m := self.merge.get((ids[prev[i]], t))):
                heapq.heappush(heap, (m[0], prev[i], ids[prev[i]], t, m[1]))
        return [t for t in ids if t >= 0]

    def learn(self, new: list[str]) -> int:
        """Put the ids of new words into the cache; returns how many needed exact merging."""
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        ends = np.cumsum([len(w) for w in raw])
        starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
        word, token = self._propose(np.frombuffer(b"".join(raw), np.uint8), starts, ends)
        failed = np.zeros(len(raw), bool)
        failed[word[token < 0]] = True
        near = np.flatnonzero((word[1:] == word[:-1]) & (token[1:] >= 0) & (token[:-1] >= 0))
        pair, back = np.unique(token[near].astype(np.int64) * self.span + token[near + 1], return_inverse=True)
        ok = self._compatible(pair // self.span, pair % self.span)
        failed[word[near[~ok[back]]]] = True
        flat, cut = token.astype("<u4").tobytes(), np.searchsorted(word, np.arange(len(raw) + 1)) * 4
        for k, w in enumerate(new):
            self.cache[w] = flat[cut[k]:cut[k + 1]]
        for k in np.flatnonzero(failed):
            self.cache[new[k]] = np.array(self.merged(raw[k]), "<u4").tobytes()
        return int(failed.sum())

    # -- whole texts ------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        pieces = []
        for t in texts:
            parts = self.split_added.split(t) if self.split_added else [t]
            pieces.append([self.added[p] if k % 2 else self.words(p) for k, p in enumerate(parts)])
        new = {w for parts in pieces for p in parts if isinstance(p, list) for w in p} - self.cache.keys()
        if new:
            self.learn(list(new))
        get = self.cache.__getitem__
        return [b"".join(b"".join(map(get, p)) if isinstance(p, list) else p.to_bytes(4, "little") for p in parts) for parts in pieces]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.piece.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_LOADED: dict = {}


def _codec(token: str, source) -> Codec:
    if token not in _LOADED:
        _LOADED.clear()
        _LOADED[token] = Codec(source.value)
    return _LOADED[token]


def encode_documents(docs: DataFrame, tokenizer_path: str, outputs: tuple[str, ...] = ("ids", "decoded")) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_tokens, ids_sha256, decoded_sha256 and, as
    ``outputs`` says, ids (little-endian unsigned 32-bit integers) and the decoded text."""
    with open(tokenizer_path, encoding="utf-8") as f:  # a small local file of the driver
        source = docs.sparkSession.sparkContext.broadcast(f.read())
    token = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(token, source)
        for whole in batches:
            for k in range(0, whole.num_rows, 64):
                batch = whole.slice(k, 64)
                ids = codec.encode(batch["text"].to_pylist())
                texts = [codec.decode(i) for i in ids]
                cols = [batch["doc_id"], pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                more = {"ids": lambda: pa.array(ids, pa.binary()), "decoded": lambda: pa.array(texts)}
                yield pa.RecordBatch.from_arrays([*cols, *(more[o]() for o in outputs)], [*names, *outputs])

    kinds = {"ids": "binary", "decoded": "string"}
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return text_rows(docs).mapInArrow(run, ", ".join([schema, *(f"{o} {kinds[o]}" for o in outputs)]))
