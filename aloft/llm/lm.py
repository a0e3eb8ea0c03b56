"""Operator 3: language-model scoring by deleted interpolation.

Tokens: A-Z lower-cased, words are runs of anything but ASCII white space, then one end token per
text.  The model mixes, for a word w after v,

    P(w | v) = a(b) c(v w) / c(v) + u(b) c(w) / N + z(b) (c(w) + 1) / (N + V + 1)

with weights per bucket b, the binary order of magnitude of the context's frequency c(v) (a text
starts after an end token).  The weights are learned by expectation-maximisation on held-out
counts: of one training fold (``EM_FOLD`` of crc32(id) mod ``FOLDS``), each block of documents
is scored with its own counts deleted.

How it is spread: documents are dealt to blocks of some megabytes by a hash of id and text, the copies of a row
that outweighs a block's even share (fewer such rows than blocks) one by one over all blocks.  They are written once as
one compressed row per block and task.  A block counts its distinct words and word pairs (64-bit
hashes, strongly mixed; two of n distinct ones collide with probability n^2 / 2^65) and sends
them, sorted and delta-coded, to buckets that are ranges of the hash.  So no key is hot: a word
comes once per block, however frequent it is.  A bucket adds up the counts and returns to each
block the totals in the order of the block's keys, without the keys.  Blocks then score their
texts.  Nothing is pruned, capped or sampled; the driver receives N, V and a histogram of the
held-out events whose size is bounded by its bins (context bucket and the two likelihood
ratios in quarter powers of two).

A null text is the empty text (one end token).  Rows that share an id get a row each; counts and base scores do not
depend on where repeated rows go, the learned weights may in their last digits.  Without
training rows all counts are zero, and the score equals the base score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import fold, saved, share, ship, text_batches

#: bytes of text aimed at in a block, and bytes of text whose keys meet in one bucket: for small
#: inputs and at most
BLOCK_BYTES, BUCKET_BYTES = (8_000_000, 16_000_000), (16_000_000, 64_000_000)
#: what a row weighs beside its text
ROW_BYTES = 16
FOLDS, HELD_OUT, EM_FOLD = 7, 2, 3
CONTEXTS, STEPS, RANGE = 32, 4, 40  # histogram: bins per power of two, powers of two
END = np.uint64(0x9E3779B97F4A7C15)
_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _C1
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


def token_hashes(text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the concatenated texts (``sizes`` bytes each), end tokens
    included, and the number of tokens of each text."""
    # every text is followed by a space, so no word crosses texts
    ends = np.cumsum(sizes)
    raw = np.zeros(len(text) + len(sizes) + 8, np.uint8)
    at = np.arange(len(text)) + np.repeat(np.arange(len(sizes)), sizes)
    raw[at] = _LOWER[np.frombuffer(text, np.uint8)]
    close = ends + np.arange(len(sizes))
    raw[close] = 32
    raw[len(text) + len(sizes):] = 32
    space = _SPACE[raw]
    word = ~space
    start = np.flatnonzero(word & np.concatenate([[True], space[:-1]]))
    stop = np.flatnonzero(space & np.concatenate([[False], word[:-1]]))
    length = stop - start
    eight = np.ndarray((len(raw) - 7,), "<u8", raw.tobytes(), 0, (1,))
    h = _mix(length.astype(np.uint64) * _C2 + np.uint64(1))
    live = np.arange(len(start))
    offset = 0
    while len(live):
        part = eight[start[live] + offset] & _MASK[np.minimum(length[live] - offset, 8)]
        h[live] = _mix(h[live] ^ part) + _C1
        offset += 8
        live = live[length[live] > offset]
    words_before = np.searchsorted(start, close)
    n_words = np.diff(np.concatenate([[0], words_before]))
    out = np.empty(len(h) + len(sizes), np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(len(sizes)), n_words)] = h
    out[words_before + np.arange(len(sizes))] = END
    return out, n_words + 1


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; the first of a text follows an end."""
    before = np.concatenate([[END], h[:-1]]) if len(h) else h
    return _mix(before * _C1 + (h ^ (h >> np.uint64(31))) * _C2)


def pack(values: np.ndarray, sorted_keys: bool = False) -> bytes:
    """Unsigned integers as compressed byte planes; sorted keys as differences."""
    if sorted_keys and len(values):
        values = np.diff(values, prepend=np.uint64(0))
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, dtype, sorted_keys: bool = False) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    values = np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(dtype)
    return np.cumsum(values, dtype=dtype) if sorted_keys else values


class Block:
    """The texts of one block: tokens, their distinct keys and the block's training counts."""

    def __init__(self, table: pa.Table):
        text, sizes = [], []
        for blob, lens in zip(table["blob"].to_pylist(), table["sizes"].to_pylist()):
            text.append(zstandard.ZstdDecompressor().decompress(blob))
            sizes.append(np.frombuffer(lens, "<i4"))
        self.sizes = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        self.train = np.concatenate([np.array(t, bool) for t in table["train"].to_pylist()] or [[]])
        h, self.n_tokens = token_hashes(b"".join(text), self.sizes.astype(np.int64))
        learn = np.repeat(self.train, self.n_tokens).astype(bool)
        self.keys, self.of, self.own = [], [], []
        for values in (h, pair_hashes(h)):
            keys, of = np.unique(values, return_inverse=True)
            self.keys.append(keys)
            self.of.append(of)
            self.own.append(np.bincount(of[learn], minlength=len(keys)).astype(np.uint32))

    def events(self, totals: list[np.ndarray], delete: bool):
        """Per token: c(w), c(v), c(v w); with ``delete`` less the block's own counts."""
        word, pair = ((t - o if delete else t)[i]
                      for t, o, i in zip(totals, self.own, self.of))
        first = np.cumsum(self.n_tokens) - self.n_tokens
        context = np.roll(word, 1)
        if len(first):
            # every text has an end token: what follows one is a first token
            end = word[first[0] + self.n_tokens[0] - 1]
            context[first] = end
        return word, context, pair


def _context_bucket(c: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(c.astype(np.float64))[1], CONTEXTS - 1)


def _row_hash(id_col: str, text_col: str):
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))


def _weights(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h, weight): bytes of all rows of a row hash; a row counts even if its text is empty."""
    return docs.groupBy(_row_hash(id_col, text_col).alias("h")).agg(
        F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + ROW_BYTES).alias("weight"))


def _packed(docs: DataFrame, id_col: str, text_col: str, train, em, blocks: int, hot: DataFrame) -> DataFrame:
    """One row per block, task and Arrow batch: ids, flags and the compressed texts.  Rows whose hash is among
    ``hot`` go anywhere, so the result must be written before it is read twice."""
    rows = docs.select(
        _row_hash(id_col, text_col).alias("h"), F.col(id_col).alias("id"), train.alias("train"), em.alias("em"),
        F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    # fewer hashes than blocks, see score()
    rows = rows.join(F.broadcast(hot.select(F.col("h").alias("hot"))), F.col("h") == F.col("hot"), "left")
    part = F.pmod(F.when(F.col("hot").isNull(), F.col("h"))
                  .otherwise(F.xxhash64("h", F.monotonically_increasing_id())), F.lit(blocks))
    src = rows.select(
        # blocks of the fold that teaches the weights are apart, with odd numbers
        (part * 2 + F.col("em").cast("long")).alias("block"), "id", "train", "text")
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        for whole in batches:
            for batch in text_batches([whole], "text", 32_000_000):
                block = batch.column(0).to_numpy(zero_copy_only=False)
                order = np.argsort(block, kind="stable")
                cuts = np.flatnonzero(np.diff(block[order])) + 1
                rows = []
                for index in np.split(order, cuts):
                    own = batch.take(pa.array(index))
                    texts = own.column(3).to_pylist()
                    rows.append((int(block[index[0]]), own.column(1), own.column(2),
                                 np.array([len(t) for t in texts], "<i4").tobytes(),
                                 zstandard.ZstdCompressor(level=3).compress(b"".join(texts))))
                if rows:
                    def lists(k):
                        offsets = np.cumsum([0, *(len(r[k]) for r in rows)])
                        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()),
                                                        pa.concat_arrays([r[k] for r in rows]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int64()), lists(1), lists(2),
                         pa.array([r[3] for r in rows], pa.binary()),
                         pa.array([r[4] for r in rows], pa.binary())],
                        names=["block", "ids", "train", "sizes", "blob"])

    return src.mapInArrow(run, f"block long, ids array<{kind}>, train array<boolean>, "
                               "sizes binary, blob binary")


def _totals(packed: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, words, pairs, n, v): the rest of the corpus's counts (less the block's own)
    in the order of the block's keys; rows with block -1 carry the bucket's N and V."""
    def count(key, table):
        block = Block(table)
        edges = (np.arange(1, buckets, dtype=object) * 2 ** 64 // buckets).astype(np.uint64)
        cuts = [np.concatenate([[0], np.searchsorted(k, edges), [len(k)]]) for k in block.keys]
        rows = {"bucket": list(range(buckets)), "block": [key[0].as_py()] * buckets}
        for name, keys, own, cut in zip(("words", "pairs"), block.keys, block.own, cuts):
            rows[name] = [pack(keys[a:b], True) for a, b in zip(cut, cut[1:])]
            rows[f"{name}_own"] = [pack(own[a:b]) for a, b in zip(cut, cut[1:])]
        return pa.table(rows, schema=pa.schema([
            ("bucket", pa.int32()), ("block", pa.int64()), ("words", pa.binary()),
            ("pairs", pa.binary()), ("words_own", pa.binary()), ("pairs_own", pa.binary())]))

    def add(key, table):
        out = {"block": table["block"].to_pylist() + [-1],
               "bucket": [key[0].as_py()] * (table.num_rows + 1), "n": [None] * table.num_rows,
               "v": [None] * table.num_rows}
        for name in ("words", "pairs"):
            keys = [unpack(b, np.uint64, True) for b in table[name].to_pylist()]
            own = [unpack(b, np.uint32) for b in table[f"{name}_own"].to_pylist()]
            distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(of, np.concatenate(own), len(distinct)).astype(np.uint64)
            if name == "words":
                out["n"].append(int(total.sum()))
                out["v"].append(int((total > 0).sum()))
            rest, at = [], 0
            for k, o in zip(keys, own):
                rest.append(pack(total[of[at:at + len(k)]] - o))
                at += len(k)
            out[name] = [*rest, None]
        return pa.table(out, schema=pa.schema([
            ("block", pa.int64()), ("bucket", pa.int32()), ("n", pa.int64()), ("v", pa.int64()),
            ("words", pa.binary()), ("pairs", pa.binary())]))

    sent = packed.groupBy("block").applyInArrow(
        count, "bucket int, block long, words binary, pairs binary, words_own binary, pairs_own binary")
    return sent.groupBy("bucket").applyInArrow(
        add, "block long, bucket int, n long, v long, words binary, pairs binary")


def _with_totals(table: pa.Table, block: Block) -> list[np.ndarray]:
    """Corpus totals in the order of the block's keys."""
    rows = table.sort_by("bucket")
    out = []
    for name, own in zip(("words", "pairs"), block.own):
        rest = [unpack(b, np.uint64) for b in rows[name].to_pylist()]
        out.append((np.concatenate(rest) + own).astype(np.int64))
    return out


def learn_weights(histogram: list[tuple[int, int, int, float]], rounds: int = 50) -> np.ndarray:
    """(CONTEXTS, 3) weights of pair, word and base estimates by expectation-maximisation.
    Rows: context bucket, bin of pair / base and of word / base (-1: zero), events."""
    weights = np.tile([0.4, 0.5, 0.1], (CONTEXTS, 1))
    weights[0] = [0.0, 0.9, 0.1]  # unseen contexts have no pair estimate
    if not histogram:
        return weights
    b, x2, x1, n = (np.array(c) for c in zip(*histogram))
    ratio = np.stack([np.where(x >= 0, np.exp2((x + 0.5) / STEPS - RANGE / 2), 0.0) for x in (x2, x1)]
                     + [np.ones(len(b))], axis=1)
    for _ in range(rounds):
        joint = weights[b] * ratio
        share = joint / joint.sum(axis=1, keepdims=True) * n[:, None]
        for i in np.unique(b):
            got = share[b == i].sum(axis=0) + np.array([0.0 if i == 0 else 0.1, 0.1, 0.1])
            weights[i] = got / got.sum()
    return weights


def _estimates(word, context, pair, n, v):
    base = (word + 1.0) / (n + v + 1.0)
    return (np.where(context > 0, pair / np.maximum(context, 1), 0.0), word / max(n, 1), base)


def score(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    ship(spark)
    weights = saved(_weights(docs, id_col, text_col), "weights")
    size = weights.agg(F.sum("weight")).first()[0] or 0
    blocks, buckets = share(size, *BLOCK_BYTES), max(4, share(size, *BUCKET_BYTES))
    train, em = fold(id_col, FOLDS) != HELD_OUT, fold(id_col, FOLDS) == EM_FOLD
    hot = weights.where(F.col("weight") > max(size // blocks, 1))
    packed = saved(_packed(docs, id_col, text_col, train, em, blocks, hot), "packed")
    totals = saved(_totals(packed, buckets), "totals")
    row = totals.where("block = -1").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = int(row["n"] or 0), int(row["v"] or 0)
    rest = totals.where("block >= 0").select("block", "bucket", "words", "pairs")

    def tally(left, right):
        block = Block(right)
        word, context, pair = block.events(_with_totals(left, block), delete=True)
        own = int(block.n_tokens[block.train].sum())
        f2, f1, f0 = _estimates(word, context, pair, max(n - own, 0), v)
        with np.errstate(divide="ignore"):
            bins = [np.where(f > 0, np.clip((np.log2(f / f0) + RANGE / 2) * STEPS, 0,
                                            RANGE * STEPS - 1), -1).astype(np.int64) for f in (f2, f1)]
        code = (_context_bucket(context) * 1000 + bins[0] + 1) * 1000 + bins[1] + 1
        codes, events = np.unique(code, return_counts=True)
        return pa.table({"code": codes, "events": events})

    odd = F.col("block") % 2 == 1
    histogram = (rest.where(odd).groupBy("block").cogroup(packed.where(odd).groupBy("block"))
                 .applyInArrow(tally, "code long, events long")
                 .groupBy("code").agg(F.sum("events").alias("events")).collect())
    mixture = learn_weights([(c // 1_000_000, c // 1000 % 1000 - 1, c % 1000 - 1, float(e))
                             for c, e in histogram])
    kind = dict(docs.dtypes)[id_col]

    def rate(left, right):
        block = Block(right)
        word, context, pair = block.events(_with_totals(left, block), delete=False)
        f2, f1, f0 = _estimates(word, context, pair, n, v)
        w = mixture[_context_bucket(context)]
        logs = np.log10(w[:, 0] * f2 + w[:, 1] * f1 + w[:, 2] * f0) if n else np.log10(f0)
        first = np.cumsum(block.n_tokens) - block.n_tokens
        ids = pa.concat_arrays([c.values if isinstance(c, pa.ListArray) else c.flatten()
                                for c in right["ids"].chunks])
        return pa.table([ids, pa.array(~block.train.astype(bool)), pa.array(block.n_tokens),
                         pa.array(np.add.reduceat((word > 0).astype(np.int64), first)),
                         pa.array(np.add.reduceat(np.log10(f0), first)),
                         pa.array(np.add.reduceat(logs, first))],
                        names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    made = (rest.groupBy("block").cogroup(packed.groupBy("block"))
            .applyInArrow(rate, f"id {kind}, held_out boolean, n_tokens long, n_known long, "
                                "base_score double, score double"))
    return made.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                       F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
