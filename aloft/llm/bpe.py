"""Operator 9: byte-level BPE by corpus-level merge replay.

The distinct pieces of a whole batch of texts are laid out as one chain of byte
tokens, with the rank of the merge that each position and the next allow.  In a round every
piece replays its merge of lowest rank, all pieces at once in numpy arrays; only the two neighbours
of a joined pair get new ranks, and pieces without a merge leave the chain.  The few pieces of more than
:data:`LONG_PIECE` bytes, which would take as many rounds, are replayed in rank order over an inverted index
that maps each merge (named by its rank) to the positions where it applies.  Every text is then the
concatenation of its pieces' ids.  Pieces already replayed by a Python worker are kept
(bounded), so that a common word is replayed once, not once per batch.

Results equal those of ``tiktoken`` without special tokens: a piece that is itself in
the vocabulary is one id; otherwise the lowest rank in the piece is merged first, the
leftmost of equals first.  A merge may create a pair of lower or equal rank; such a
piece's remaining positions are put back into the index, so that the new pair's turn
comes first.

Nulls are encoded as the empty text (no ids); an empty table gives an empty result; repeated rows each get a
result.  A very long text is held whole by its task, as are its ids.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from itertools import chain

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from aloft.llm.common import per_text

#: most pieces a worker keeps between batches
KEEP_PIECES = 600_000
#: bytes of the longest piece that is replayed in rounds over all pieces
LONG_PIECE = 64
#: pieces in one chain of rounds
CHAIN_PIECES = 32_768
#: stands for the rank where no merge applies
NONE = np.iinfo(np.int64).max
_LOADED: dict = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, from a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class MergeReplay:
    """Encodes pieces by replaying merges over all pieces given at once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.vocab = {r: b for b, r in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.known: dict[str, bytes] = {}
        joined = sorted((ranks[b[:i]], ranks[b[i:]], r) for b, r in ranks.items() for i in range(1, len(b))
                        if b[:i] in ranks and b[i:] in ranks)
        left, right, made = np.array(joined, np.int64).reshape(-1, 3).T
        self.base = max(ranks.values()) + 1
        # sorted by pair, with one more at the end, so that a search always ends on an entry
        self.pairs = np.append(left * self.base + right, NONE)
        self.made = np.append(made, NONE)
        self.byte_tok = np.array(self.byte_ids, np.int64)
        self.byte_pair = self._ranks(np.repeat(self.byte_tok, 256), np.tile(self.byte_tok, 256))

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the tokens that each a+b make, or :data:`NONE`."""
        key = a * self.base + b
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.made[at], NONE)

    def replay_rounds(self, pieces: list[bytes]) -> list[bytes]:
        """Each (not empty) piece's ids as little-endian unsigned 32-bit integers."""
        out = [b""] * len(pieces)
        lens = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        tok, which, ends = self.byte_tok[raw], np.arange(len(pieces)), np.cumsum(lens)
        rank = np.full(len(raw), NONE)
        rank[:-1] = self.byte_pair[raw[:-1] * 256 + raw[1:]]
        rank[ends - 1] = NONE
        while len(which):
            least = np.minimum.reduceat(rank, ends - lens)
            done = least == NONE
            if done.any():
                leave = np.repeat(done, lens)
                ids = tok[leave].astype("<u4").tobytes()
                start = 0
                for w, end in zip(which[done].tolist(), (4 * np.cumsum(lens[done])).tolist()):
                    out[w] = ids[start:end]
                    start = end
                tok, rank = tok[~leave], rank[~leave]
                which, lens, least = which[~done], lens[~done], least[~done]
                ends = np.cumsum(lens)
            if not len(which):
                break
            first = ends - lens
            hits = np.flatnonzero(rank == np.repeat(least, lens))
            at = hits[np.searchsorted(hits, first)]  # the leftmost of a piece
            tok[at] = least
            rank[at] = NONE
            i = at[at + 2 < ends]
            rank[i] = self._ranks(tok[i], tok[i + 2])
            i = at[at > first]
            rank[i - 1] = self._ranks(tok[i - 1], tok[i])
            stay = np.ones(len(tok), bool)
            stay[at + 1] = False
            tok, rank, lens = tok[stay], rank[stay], lens - 1
            ends = np.cumsum(lens)
        return out

    def _rank(self, a: int, b: int) -> int:
        """Rank of the token that a+b make, or -1."""
        r = self.ranks.get(self.vocab[a] + self.vocab[b], -1)
        if len(self.pair_rank) > 2_000_000:
            self.pair_rank.clear()
        self.pair_rank[a, b] = r
        return r

    def replay(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece, of any length."""
        ids, out, pair_rank, rank = self.byte_ids, [], self.pair_rank, self._rank
        tok: list[int] = []
        ends: list[int] = []
        for p in pieces:
            tok.extend([ids[b] for b in p])
            ends.append(len(tok))
        n = len(tok)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        word = [0] * n
        start = 0
        for w, end in enumerate(ends):
            if end > start:
                nxt[end - 1] = -1
                prv[start] = -1
                word[start:end] = [w] * (end - start)
            start = end
        # the inverted index: rank of the joined token -> positions of its left part
        index: dict[int, list[int]] = {}
        for i in range(n - 1):
            if nxt[i] == i + 1:
                key = (tok[i], tok[i + 1])
                r = pair_rank.get(key)
                if r is None:
                    r = rank(*key)
                if r >= 0:
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r, None)
            if places is None:
                continue
            places.sort()
            put_off = -1
            for i in places:
                j = nxt[i]
                if j < 0 or tok[i] < 0:
                    continue
                if pair_rank.get((tok[i], tok[j]), -2) != r and rank(tok[i], tok[j]) != r:
                    continue
                if word[i] == put_off:
                    if r in index:
                        index[r].append(i)
                    else:
                        index[r] = [i]
                        heapq.heappush(heap, r)
                    continue
                tok[i] = r
                tok[j] = -1
                k = nxt[j]
                nxt[j] = -1
                nxt[i] = k
                if k >= 0:
                    prv[k] = i
                    key = (r, tok[k])
                    s = pair_rank.get(key)
                    if s is None:
                        s = rank(*key)
                    if s >= 0:
                        if s in index:
                            index[s].append(i)
                        else:
                            index[s] = [i]
                            heapq.heappush(heap, s)
                        if s <= r:
                            put_off = word[i]
                h = prv[i]
                if h >= 0:
                    key = (tok[h], r)
                    s = pair_rank.get(key)
                    if s is None:
                        s = rank(*key)
                    if s >= 0:
                        if s in index:
                            index[s].append(h)
                        else:
                            index[s] = [h]
                            heapq.heappush(heap, s)
                        if s <= r:
                            put_off = word[i]
        start = 0
        for end in ends:
            out.append([t for t in tok[start:end] if t >= 0])
            start = end
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.find(t) for t in texts]
        if len(self.known) > KEEP_PIECES:
            self.known = {}
        known = self.known
        new = [p for p in set(chain.from_iterable(split)) if p not in known]
        short, other = [], []
        for p in new:
            b = p.encode()
            r = self.ranks.get(b)
            if r is not None:
                known[p] = r.to_bytes(4, "little")
            elif 0 < len(b) <= LONG_PIECE:
                short.append((p, b))
            else:
                other.append((p, b))
        for k in range(0, len(short), CHAIN_PIECES):
            chain_of = short[k:k + CHAIN_PIECES]
            for (p, _), got in zip(chain_of, self.replay_rounds([b for _, b in chain_of])):
                known[p] = got
        if other:
            for (p, _), got in zip(other, self.replay([b for _, b in other])):
                known[p] = np.asarray(got, "<u4").tobytes()
        return [b"".join([known[p] for p in pieces]) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        vocab = self.vocab
        return b"".join([vocab[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _replay_for(path: str, pattern: str) -> MergeReplay:
    key = (path, pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = MergeReplay(load_ranks(path), pattern)
    return _LOADED[key]


def default_vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def encode_decode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  vocabulary: str | None = None, pattern: str | None = None,
                  ids: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids (binary, little-endian uint32),
    ids_sha256, decoded (binary), decoded_sha256.  ``ids=False`` leaves out the two
    binary columns.

    ``vocabulary`` is a rank file that exists on every executor, ``pattern`` the
    expression whose matches are encoded separately.
    """
    path = vocabulary or default_vocabulary()
    pat = pattern or public_tokenizers.PATTERN

    def work(texts: list[str]) -> dict:
        replay = _replay_for(path, pat)
        coded = replay.encode(texts)
        plain = [replay.decode(c) for c in coded]
        out = {"n_tokens": pa.array([len(c) // 4 for c in coded], pa.int64()),
               "ids_sha256": pa.array([hashlib.sha256(c).hexdigest() for c in coded], pa.string()),
               "decoded_sha256": pa.array([hashlib.sha256(p).hexdigest() for p in plain],
                                          pa.string())}
        if ids:
            out |= {"ids": pa.array(coded, pa.binary()), "decoded": pa.array(plain, pa.binary())}
        return out

    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return per_text(docs, work, schema + (", ids binary, decoded binary" if ids else ""),
                    id_col=id_col, text_col=text_col, out_id=id_col)
