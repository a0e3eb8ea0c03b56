"""Operator 2: removal of repeated byte strings by merging shard Burrows-Wheeler transforms.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a document with a
smaller id.  Matches never cross documents and are judged on the input.

1. Texts are dealt to blocks by content, equal texts collapsing to one with their smallest id.
2. Search space.  In every window of ``LENGTH`` bytes the ``SEED``-byte string of least hash is its
   minimiser; equal windows have equal minimisers.  Blocks send their distinct minimiser
   hashes, sorted and delta-coded, to ranges of the hash, and learn which of them occur in
   several texts.  Runs of windows with one such minimiser are pieces; all others
   cannot repeat and are left out, without loss.
3. Shards.  The distinct pieces that a block has for a range of minimisers are one shard.  The block
   builds its Burrows-Wheeler transform and sends that, not the pieces.
4. Merge.  The shards of a range are merged by iterative interleave refinement (Holt and
   McMillan 2014; blocks of equal prefixes as in Egidi and Manzini's LCP merge): the rows
   of all shards start as one interval; in every step each row gives its symbol (two symbols at
   a time, for speed), rows are dealt stably by symbol and move on by the LF mapping of their
   own shard.  After k symbols they are interleaved by their first k symbols, and the boundaries say whose
   common prefix is shorter.  Only rows that lead to a window after ``LENGTH`` symbols take
   part, and those alone in their interval leave, since nothing can repeat them.  No suffix is
   compared or sorted again.
5. The intervals left are the repeated strings.  Each shard gets one bit per window: whether a
   smaller id than that of its own piece occurs in the interval.  Blocks turn bits into
   removed bytes.

No group meets in one task: copies collapse per task and per block, identical pieces per block and
per range, and a minimiser with more than ``HOT`` different pieces is split by window content.

Null texts are empty, null ids come after all others; rows with one id never remove bytes of each
other unless a smaller id does; repeated rows get equal results.  Ids are integers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import saved, share, ship, shuffle_partitions, text_batches
from aloft.llm.lm import pack, unpack

LENGTH, SEED = 50, 20
#: bytes of text aimed at in a block, and bytes of text behind one range of minimisers: for small
#: inputs and at most
BLOCK_BYTES, BUCKET_BYTES = (8_000_000, 16_000_000), (4_000_000, 32_000_000)
#: windows hashed at a time, and bytes of text cut into pieces at a time
CHUNK, TEXTS_AT_ONCE = 1 << 15, 1 << 20
#: bytes of text packed at a time
PACKED_BYTES = 16_000_000
#: different pieces of one minimiser from which it is split by window content
HOT = 5_000
LAST = 2 ** 63 - 1  # the id of rows without one
_C1, _C2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _C1
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


def _eights(raw: bytes, order: str = "<") -> np.ndarray:
    """The eight bytes from every position, as numbers."""
    return np.ndarray((len(raw) - 7,), f"{order}u8", raw, 0, (1,))


def _string_hashes(eights: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    h = _mix(length.astype(np.uint64) + _C2)
    live, offset = np.arange(len(start)), 0
    while len(live):
        left = length[live] - offset
        part = eights[start[live] + offset]
        short = left < 8
        part[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        h[live] = _mix(h[live] ^ part) + _C1
        offset += 8
        live = live[length[live] > offset]
    return h


def _least_hashes(eights: np.ndarray, n: int) -> np.ndarray:
    """Least hash of the ``SEED``-byte strings in each of ``n`` windows."""
    m = n + LENGTH - SEED
    least = _mix(eights[:m] + _C1)
    for o in (*range(8, SEED - 7, 8), SEED - 8):
        least = _mix(least ^ eights[o:o + m])
    width, step = LENGTH - SEED + 1, 1
    while step * 2 <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:-(width - step)], least[width - step:])
    return least


def minimisers(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimiser: (hash, first window, number of windows).

    ``raw``: concatenated texts; ``ends``: their ends.  Runs stay within a text and hold
    ``LENGTH - SEED + 1`` windows at most.
    """
    n = len(raw) - LENGTH + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return np.empty(0, np.uint64), none, none
    least = np.empty(n, np.uint64)
    padded = raw.tobytes() + bytes(8)
    for at in range(0, n, CHUNK):  # parts whose arrays stay in the cache
        end = min(at + CHUNK, n)
        least[at:end] = _least_hashes(_eights(padded[at:end + LENGTH + 7]), end - at)
    width = LENGTH - SEED + 1
    starts = np.concatenate([[0], ends[:-1]])
    valid = np.zeros(n + 1, np.int32)
    room = ends - starts >= LENGTH
    np.add.at(valid, starts[room], 1)
    np.add.at(valid, ends[room] - LENGTH + 1, -1)
    valid = np.cumsum(valid[:n]) > 0
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[starts[room]] = True
    new[1:] |= valid[1:] != valid[:-1]
    first = np.flatnonzero(new)
    run = np.diff(np.append(first, n))
    keep = valid[first]
    first, run = first[keep], run[keep]
    if len(run) and run.max() > width:
        parts = -(-run // width)
        at = np.repeat(first, parts)
        k = np.arange(len(at)) - np.repeat(np.cumsum(parts) - parts, parts)
        run = np.minimum(np.repeat(run, parts) - k * width, width)
        first = at + k * width
    # least hashes are small numbers: mix them again, so that they spread over all ranges
    return _mix(least[first] + _C2), first, run


class Block:
    """The distinct texts of one block in the order of their digests, and their pieces."""

    def __init__(self, table: pa.Table):
        lowest: dict[bytes, int] = {}
        for blob, sizes, ids in zip(*(table[c].to_pylist() for c in ("blob", "sizes", "ids"))):
            whole, at = zstandard.ZstdDecompressor().decompress(blob), 0
            for size, i in zip(np.frombuffer(sizes, "<i4").tolist(), ids):
                text = whole[at:at + size]
                at += size
                lowest[text] = min(i, lowest.get(text, LAST))
        order = sorted((hashlib.sha256(t).digest(), t) for t in lowest)
        self.digests = [d for d, _ in order]
        self.ids = np.array([lowest[t] for _, t in order], np.int64)
        self.sizes = np.array([len(t) for _, t in order], np.int64)
        padded = b"".join([*(t for _, t in order), bytes(8)])
        del lowest, order  # the texts are held once from here on
        self.eights = _eights(padded)
        self.raw = np.frombuffer(padded, np.uint8)[:-8]
        self.ends = np.cumsum(self.sizes)
        self.fp, self.first, self.run = self._pieces()
        self.text_of = np.searchsorted(self.ends, self.first, side="right").astype(np.int32)

    def _pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """:func:`minimisers` of the block, some texts at a time, since its arrays are many times as large as
        the texts."""
        found, at, low = [], 0, 0
        while at < len(self.ends):
            end = max(at + 1, int(np.searchsorted(self.ends, low + TEXTS_AT_ONCE, side="right")))
            high = int(self.ends[end - 1])
            fp, first, run = minimisers(self.raw[low:high], self.ends[at:end] - low)
            found.append((fp, (first + low).astype(np.int32), run.astype(np.uint8)))
            at, low = end, high
        if not found:
            return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.uint8)
        return tuple(np.concatenate(x) for x in zip(*found))

    def hashes(self, first: np.ndarray, run: np.ndarray) -> np.ndarray:
        return _string_hashes(self.eights, first, run.astype(np.int32) + LENGTH - 1)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct minimisers, in how many texts each is, and in how many pieces."""
        order = np.argsort(self.fp, kind="stable")  # texts stay in order
        fp, text = self.fp[order], self.text_of[order]
        new = np.append(True, fp[1:] != fp[:-1])[:len(fp)]
        at = np.flatnonzero(new)
        other = new | np.append(True, text[1:] != text[:-1])[:len(fp)]
        texts = np.add.reduceat(other, at) if len(at) else at
        # only a minimiser of several runs can have several pieces
        size = np.diff(np.append(at, len(fp)))
        several = np.repeat(size > 1, size)
        pieces = np.ones(len(at), np.int64)
        if several.any():
            whole = self.hashes(self.first[order[several]], self.run[order[several]])
            group = np.repeat(np.arange(len(at)), size)[several]
            again = np.lexsort((whole, group))
            group, whole = group[again], whole[again]
            other = np.append(True, (group[1:] != group[:-1]) | (whole[1:] != whole[:-1]))
            pieces = np.maximum(np.bincount(group, other, len(at)).astype(np.int64), 1)
        return fp[at], texts.astype(np.uint32), pieces.astype(np.uint32)

    def shards(self, state: np.ndarray, buckets: int):
        """Distinct pieces by bucket, after the minimisers' ``state`` (0: in one text, 1: repeated,
        2: hot) in the order of :meth:`keys`.

        Returns per occurrence (first, run, text, piece number) and per distinct piece
        (first, run, smallest id, bucket, name); pieces are numbered bucket by bucket, and equal
        pieces of different blocks have equal names (a hash of minimiser and content).
        """
        keys = np.sort(self.fp)
        keys = keys[np.append(True, keys[1:] != keys[:-1])[:len(keys)]]
        of = state[np.searchsorted(keys, self.fp)] if len(keys) else np.empty(0, np.uint8)
        one, hot = np.flatnonzero(of == 1), np.flatnonzero(of == 2)
        wide = self.run[hot].astype(np.int64)
        first = np.concatenate([self.first[one], np.repeat(self.first[hot], wide)
                                + np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)])
        run = np.concatenate([self.run[one], np.ones(wide.sum(), np.uint8)]).astype(np.int64)
        text = np.concatenate([self.text_of[one], np.repeat(self.text_of[hot], wide)])
        h = self.hashes(first, run)
        # a hot minimiser's windows are dealt by their content
        key = np.concatenate([self.fp[one], h[len(one):]])
        order = np.lexsort((first, h, key))
        key, h = key[order], h[order]
        new = np.append(True, (key[1:] != key[:-1]) | (h[1:] != h[:-1]))[:len(key)]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        lead = order[new]
        ids = self.ids[text[order]]
        low = np.minimum.reduceat(ids, np.flatnonzero(new)) if len(ids) else ids
        edges = (np.arange(1, buckets, dtype=object) * 2 ** 64 // buckets).astype(np.uint64)
        bucket = np.searchsorted(edges, key[new], side="right")
        name = _mix(key[new] + h[new] * _C1)
        return (first, run, text, number), (first[lead], run[lead], low, bucket, name)


def transform(raw: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of the strings raw[first:first + length], each ended by a symbol 0
    of its own; bytes are shifted by one (UTF-8 has no byte above 0xF4)."""
    size = length + 1
    ends = np.cumsum(size)
    starts = ends - size
    total = int(ends[-1])
    stop = np.repeat(ends - 1, size)  # place of the end symbol of each position's string
    here = np.arange(total)
    text = np.zeros(total + 8, np.uint8)
    body = here < stop
    text[:total][body] = raw[(here + np.repeat(first - starts, size))[body]] + 1
    # ranks of the suffixes by their first bytes, then doubled; nothing is seen past an end
    span = 5 if total <= PACKED else 8
    key = _eights(text.tobytes(), ">")[:total] >> np.uint64(8 * (8 - span))
    short = np.flatnonzero(stop - here < span)
    past = (8 * (span - (stop - here)[short])).astype(np.uint64)
    key[short] = np.where(past < 64, key[short] >> (past % np.uint64(64)) << (past % np.uint64(64)), 0)
    order, rank = _ranked(key)
    while span < int(length.max()) and int(rank[order[-1]]) < total - 1:
        then = rank[np.minimum(here + span, stop)]
        order, rank = _ranked((rank << np.uint64(21 if total <= PACKED else 32)) | then)
        span *= 2
    text[1:total] = text[:total - 1]  # now each position's symbol on the left
    text[starts] = 0
    return text[order]


#: suffixes whose number fits beside two ranks in 64 bits; such keys can be sorted by value
PACKED = 1 << 21


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys, equal ones by position, and the dense rank of each."""
    n = len(key)
    if n <= PACKED:
        # 42 bits of key and 21 of position
        both = np.sort((key << np.uint64(21)) | np.arange(n, dtype=np.uint64))
        order, ordered = (both & np.uint64(PACKED - 1)).astype(np.int64), both >> np.uint64(21)
    else:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
    rank = np.empty(n, np.uint64)
    rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])).astype(np.uint64)
    return order, rank


def merge(shards: list[tuple[np.ndarray, ...]]) -> list[np.ndarray]:
    """Merge shard transforms (symbols, windows per piece, smallest id per piece, piece names) by
    interleave refinement.  Per shard: for every window whether a smaller id has the same string.

    A piece that several shards have takes part once, with the smallest of its ids.
    """
    sizes = [len(s[0]) for s in shards]
    symbols = np.concatenate([s[0] for s in shards])
    lf = np.empty(len(symbols), np.int32)
    base = 0
    ends = []
    for (own, run, _, _), size in zip(shards, sizes):
        lf[base + np.argsort(own, kind="stable")] = np.arange(base, base + size, dtype=np.int32)
        ends.append(np.arange(base, base + len(run), dtype=np.int32))  # rows of the empty suffixes
        base += size
    every_run = np.concatenate([s[1] for s in shards]).astype(np.int64)
    every_low = np.concatenate([s[2] for s in shards])
    name = np.concatenate([s[3] for s in shards])
    order = np.argsort(name, kind="stable")
    new = np.append(True, name[order][1:] != name[order][:-1])
    piece = np.empty(len(name), np.int64)  # which of the different pieces each one is
    piece[order] = np.cumsum(new) - 1
    run, low = every_run[order[new]], np.minimum.reduceat(every_low[order], np.flatnonzero(new))
    start = np.cumsum(run) - run
    windows = int(run.sum())
    # the row LENGTH symbols to the right of each window's start
    row = np.empty(windows, np.int32)
    at, live = np.concatenate(ends)[order[new]], np.arange(len(run))
    for t in range(int(run.max())):
        row[start[live] + run[live] - 1 - t] = at[live]
        live = live[run[live] > t + 1]
        at[live] = lf[at[live]]
    # two symbols an iteration, the one further left first
    pair = symbols[lf].astype(np.uint16) << 8 | symbols
    lf = lf[lf]
    who = np.arange(windows, dtype=np.int32)
    interval = np.zeros(windows, np.int32)
    for k in range(0, LENGTH, 2):
        symbol = pair[row]
        order = np.argsort(symbol, kind="stable")
        row, who, interval, symbol = lf[row[order]], who[order], interval[order], symbol[order]
        edge = np.empty(len(row), bool)
        edge[:1] = True
        np.not_equal(symbol[1:], symbol[:-1], out=edge[1:])
        edge[1:] |= interval[1:] != interval[:-1]
        if k % 6 == 4 or k == LENGTH - 2:
            stay = ~(edge & np.append(edge[1:], True))
            row, who, edge = row[stay], who[stay], edge[stay]
        interval = np.cumsum(edge, dtype=np.int32)
    least = np.repeat(low, run)  # the smallest id of each window's string
    if len(row):
        heads = np.flatnonzero(np.append(True, interval[1:] != interval[:-1]))
        sizes = np.diff(np.append(heads, len(row)))
        least[who] = np.repeat(np.minimum.reduceat(least[who], heads), sizes)
    total = int(every_run.sum())
    at = np.arange(total) + np.repeat(start[piece] - (np.cumsum(every_run) - every_run), every_run)
    smaller = least[at] < np.repeat(every_low, every_run)
    return np.split(smaller, np.cumsum([int(s[1].sum()) for s in shards])[:-1])


def _packed(docs: DataFrame, id_col: str, text_col: str, blocks: int) -> DataFrame:
    """One row per block, task and Arrow batch: distinct texts and the smallest id of each."""
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("id"),
                      F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))

    def run(batches):
        for whole in batches:
            for batch in text_batches([whole], "text", PACKED_BYTES):
                lowest: dict[bytes, int] = {}
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    lowest[t] = min(i, lowest.get(t, LAST))
                dealt: dict[int, list[bytes]] = {}
                for t in lowest:
                    block = int.from_bytes(hashlib.sha256(t).digest()[:8], "big") % blocks
                    dealt.setdefault(block, []).append(t)
                rows = sorted(dealt.items())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in rows], pa.int64()),
                     pa.array([[lowest[t] for t in own] for _, own in rows], pa.list_(pa.int64())),
                     pa.array([np.array([len(t) for t in own], "<i4").tobytes() for _, own in rows],
                              pa.binary()),
                     pa.array([zstandard.ZstdCompressor(level=1).compress(b"".join(own))
                               for _, own in rows], pa.binary())],
                    names=["block", "ids", "sizes", "blob"])

    return src.mapInArrow(run, "block long, ids array<long>, sizes binary, blob binary")


def _in_order(table: pa.Table, column: str) -> list:
    return table.sort_by("bucket")[column].to_pylist()


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    edges = (np.arange(1, buckets, dtype=object) * 2 ** 64 // buckets).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def deduplicate(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, n_bytes, n_removed, n_spans, kept_sha256."""
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    blocks, buckets = share(size, *BLOCK_BYTES), max(4, share(size, *BUCKET_BYTES))
    packed = saved(_packed(docs, id_col, text_col, blocks), "packed-texts")  # read three times
    # buckets are many bytes in few rows: keep their tasks apart, whatever the bytes shuffled
    parts = min(buckets, shuffle_partitions(spark))

    def send_keys(key, table):
        keys, texts, pieces = Block(table).keys()
        cut = _cuts(keys, buckets)
        parts = list(zip(cut, cut[1:]))
        return pa.table({"bucket": pa.array(range(buckets), pa.int32()),
                         "block": pa.array([key[0].as_py()] * buckets, pa.int64()),
                         "keys": pa.array([pack(keys[a:b], True) for a, b in parts], pa.binary()),
                         "texts": pa.array([pack(texts[a:b]) for a, b in parts], pa.binary()),
                         "pieces": pa.array([pack(pieces[a:b]) for a, b in parts], pa.binary())})

    def judge(key, table):
        keys = [unpack(b, np.uint64, True) for b in table["keys"].to_pylist()]
        distinct, of = np.unique(np.concatenate(keys), return_inverse=True)
        count = [np.bincount(of, np.concatenate([unpack(b, np.uint32) for b in table[c].to_pylist()]),
                             len(distinct)) for c in ("texts", "pieces")]
        state = np.where(count[0] < 2, 0, np.where(count[1] > HOT, 2, 1)).astype(np.uint8)[of]
        out = np.split(state, np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({"block": table["block"], "bucket": table["bucket"],
                         "state": pa.array([pack(s) for s in out], pa.binary())})

    states = saved(packed.groupBy("block").applyInArrow(
        send_keys, "bucket int, block long, keys binary, texts binary, pieces binary")
        .repartition(parts, "bucket").groupBy("bucket").applyInArrow(judge, "block long, bucket int, state binary"), "states")

    def state_of(table) -> np.ndarray:
        return np.concatenate([unpack(b, np.uint8) for b in _in_order(table, "state")])

    def send_shards(left, right):
        block = Block(right)
        _, (first, run, low, bucket, name) = block.shards(state_of(left), buckets)
        rows = {"bucket": [], "block": [], "bwt": [], "runs": [], "low": [], "names": []}
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        for b, (s, e) in enumerate(zip(cut, cut[1:])):
            if e > s:
                rows["bucket"].append(b)
                rows["block"].append(left["block"][0].as_py())
                rows["bwt"].append(zstandard.ZstdCompressor(level=1).compress(
                    transform(block.raw, first[s:e], run[s:e] + LENGTH - 1).tobytes()))
                rows["runs"].append(pack(run[s:e].astype(np.uint8)))
                rows["low"].append(pack(low[s:e].astype(np.uint64)))
                rows["names"].append(name[s:e].tobytes())
        return pa.table(rows, schema=pa.schema([
            ("bucket", pa.int32()), ("block", pa.int64()), ("bwt", pa.binary()),
            ("runs", pa.binary()), ("low", pa.binary()), ("names", pa.binary())]))

    def merge_bucket(key, table):
        shards = [(np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8),
                   unpack(r, np.uint8), unpack(low, np.uint64).astype(np.int64),
                   np.frombuffer(names, np.uint64))
                  for b, r, low, names in zip(*(table[c].to_pylist()
                                                for c in ("bwt", "runs", "low", "names")))]
        bits = [np.packbits(s).tobytes() for s in merge(shards)]
        return pa.table({"block": table["block"], "bucket": table["bucket"],
                         "bits": pa.array(bits, pa.binary())})

    bits = (states.groupBy("block").cogroup(packed.groupBy("block"))
            .applyInArrow(send_shards, "bucket int, block long, bwt binary, runs binary, low binary, "
                           "names binary")
            .repartition(parts, "bucket").groupBy("bucket").applyInArrow(merge_bucket, "block long, bucket int, bits binary"))
    # one table of both answers: a block meets its minimisers' states, its bits and its texts
    answers = (states.withColumn("bits", F.lit(None).cast("binary"))
               .unionByName(bits.withColumn("state", F.lit(None).cast("binary"))))

    def remove(left, right):
        block = Block(right)
        have = left.filter(pa.compute.is_valid(left["state"]))
        marks = left.filter(pa.compute.is_valid(left["bits"]))
        (first, run, text, number), (_, piece_run, low, bucket, _) = block.shards(state_of(have), buckets)
        smaller = np.zeros(int(piece_run.sum()), bool)
        at = np.cumsum(piece_run) - piece_run
        for b, mark in zip(marks["bucket"].to_pylist(), marks["bits"].to_pylist()):
            s, e = np.searchsorted(bucket, [b, b + 1])
            n = int(piece_run[s:e].sum())
            smaller[at[s]:at[s] + n] = np.unpackbits(np.frombuffer(mark, np.uint8), count=n)
        # a text other than the piece's smallest goes; that one goes where a smaller id has the string
        window = np.repeat(at[number] - (np.cumsum(run) - run), run) + np.arange(run.sum())
        gone = smaller[window] | np.repeat(block.ids[text] > low[number], run)
        place = np.repeat(first - (np.cumsum(run) - run), run) + np.arange(run.sum())
        cover = np.zeros(len(block.raw) + 1, np.int32)
        place = place[gone]
        cover[place] += 1  # every window is in one run only
        np.subtract.at(cover, place + LENGTH, 1)
        covered = np.cumsum(cover[:-1], dtype=np.int32, out=cover[:-1]) > 0
        rows = {"digest": block.digests, "low": block.ids, "n_removed": [], "n_spans": [], "kept": []}
        at = 0
        for size in block.sizes.tolist():
            own = covered[at:at + size]
            removed = int(own.sum())
            rows["n_removed"].append(removed)
            rows["n_spans"].append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
            body = block.raw[at:at + size]
            rows["kept"].append(hashlib.sha256((body[~own] if removed else body).tobytes()).hexdigest())
            at += size
        return pa.table(rows, schema=pa.schema([
            ("digest", pa.binary()), ("low", pa.int64()), ("n_removed", pa.int64()),
            ("n_spans", pa.int64()), ("kept", pa.string())]))

    contents = (answers.groupBy("block").cogroup(packed.groupBy("block"))
                .applyInArrow(remove, "digest binary, low long, n_removed long, n_spans long, kept string"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("__id"), F.unhex(F.sha2(text, 256)).alias("digest"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    copy = (F.coalesce(F.col("__id").cast("long"), F.lit(LAST)) > F.col("low")) & (F.col("n_bytes") >= LENGTH)
    empty = hashlib.sha256(b"").hexdigest()
    return rows.join(contents, "digest").select(
        F.col("__id").alias(id_col), "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.col("n_removed")).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.col("n_spans")).alias("n_spans"),
        F.when(copy, F.lit(empty)).otherwise(F.col("kept")).alias("kept_sha256"))


ORACLE = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, (length(h) // 2) - 49)) AS p FROM d)),
m AS (SELECT md5(s) AS k, min(doc_id) AS low FROM w GROUP BY 1),
r AS (SELECT w.doc_id, w.p FROM w JOIN m ON md5(w.s) = m.k WHERE w.doc_id > m.low),
-- runs of removed bytes: a window starts a run unless an earlier one of the text reaches it
e AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM r),
g AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END)
             OVER (PARTITION BY doc_id ORDER BY p) AS run FROM e),
s AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS b FROM g GROUP BY doc_id, run),
k AS (SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS prev FROM s),
kept AS (
  SELECT d.doc_id, string_agg(substr(h, 2 * prev + 1, 2 * (a - prev)), '' ORDER BY a) AS x,
         max(b) AS last, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans
  FROM k JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(x || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
