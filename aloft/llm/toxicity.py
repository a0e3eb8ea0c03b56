"""Operator 7: toxic spans by a linear-chain conditional random field.

Documents carry one label each, so token labels come first: a token of a toxic document is
labelled toxic if its word or a prefix of it occurs in significantly more different
contexts (previous and next word) of toxic than of clean documents.  Contexts are counted
instead of occurrences, because near copies of one toxic document repeat its harmless
words in the same context.  The field has two states; the emission of a word is a
linear function of hashed word, prefix and suffix features, and transitions are learned.
It is fitted on a bounded sample of labelled rows, taken by hash of the id whatever their length and
the table's size: of each class ``MOST`` rows, or fewer, still whole, if those taken already
hold ``CHARS`` characters.

Every whole text is then scored: forward-backward marginals p of all tokens aggregate to
-sum log(1 - p) and the largest logit, and a logistic function fitted on the sample maps
these to the score.  Tokens with p >= 0.5 are the offending spans.

Only ids and texts are inputs of a score.  Null and empty texts are scored as a text without
tokens.  Labels that are null, and labelled ids without a document, are not learned from;
if a class has no labelled row, all scores are the share of label 1 (0 without labels).  Repeated rows each get
a result, equal ones equal.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import per_text, ship, text_batches

#: by label: most sample rows, and characters after which no further row is taken
MOST = {1: 1_200, 0: 2_400}
CHARS = {1: 6_000_000, 0: 12_000_000}
#: tokens that a chain is stepped through at once, and tokens fitted on at once
BLOCK, TOKENS = 1_024, 500_000
BUCKETS = 1 << 20
ROUNDS = 40
BATCH = 6_000_000
_STRIP = ".,;:!?%$#&*|\"'()[]{}<>"


def tokens(text: str) -> list[str]:
    return [w.strip(_STRIP) for w in text.lower().split()]


def _features(word: str) -> list[str]:
    return ["w" + word, *("p" + word[:k] for k in (3, 4, 5, 6)), "s" + word[-3:]]


def _buckets(word: str) -> list[int]:
    return [zlib.crc32(f.encode()) % BUCKETS for f in _features(word)]


class Chains:
    """Token sequences laid end to end, stepped through side by side.

    Longer ones are stepped through as blocks of ``BLOCK`` tokens, also side by side, once the
    product of each block's transfer matrices has told what enters the block at either end.
    """

    def __init__(self, lengths):
        self.lengths = np.asarray(lengths, np.int64)
        n = -(-self.lengths // BLOCK)
        chain = np.repeat(np.arange(len(n)), n)
        # place of each block in its chain
        place = np.arange(len(chain)) - (np.cumsum(n) - n)[chain]
        size = np.minimum(BLOCK, self.lengths[chain] - place * BLOCK)
        start = (np.cumsum(self.lengths) - self.lengths)[chain] + place * BLOCK
        order = np.argsort(-size, kind="stable")
        self.start, self.size, self.head = start[order], size[order], place[order] == 0
        where = np.empty_like(order)
        where[order] = np.arange(len(order))
        # (blocks, their predecessors) for each place in a chain from the second on
        later = np.argsort(place, kind="stable")
        later = later[np.count_nonzero(place == 0):]
        cuts = np.flatnonzero(np.diff(place[later])) + 1
        self.links = [(where[b], where[b - 1]) for b in np.split(later, cuts) if len(b)]
        self.in_long = np.flatnonzero((n > 1)[chain[order]])
        top = int(self.size[0]) if len(order) else 0
        # how many blocks are longer than t
        self.active = np.searchsorted(-self.size, -np.arange(top), side="left")

    def left(self) -> np.ndarray:
        """Tokens that another one of their chain follows."""
        more = np.ones(int(self.lengths.sum()), bool)
        more[(np.cumsum(self.lengths) - 1)[self.lengths > 0]] = False
        return np.flatnonzero(more)

    def _entries(self, e: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward ratio of the token before each block, backward ratio of its last one."""
        into, after = np.ones(len(self.start)), np.ones(len(self.start))
        if not self.links:
            return into, after
        own, start, size = self.in_long, self.start[self.in_long], self.size[self.in_long]
        # entries of the product (last token ... first token) of each block
        w, x, y, z = np.ones(len(own)), np.zeros(len(own)), np.zeros(len(own)), np.ones(len(own))
        for t in range(int(size[0])):
            n = np.searchsorted(-size, -t, side="left")
            g = e[start[:n] + t]
            p, q, r, s = w[:n], x[:n], y[:n], z[:n]
            p, q, r, s = (g * (a[1, 1] * p + a[0, 1] * r), g * (a[1, 1] * q + a[0, 1] * s),
                          a[1, 0] * p + a[0, 0] * r, a[1, 0] * q + a[0, 0] * s)
            if t == 0:  # nothing comes before the first token of a chain
                first = self.head[own[:n]]
                p, q = np.where(first, g, p), np.where(first, 0.0, q)
                r, s = np.where(first, 0.0, r), np.where(first, 1.0, s)
            most = np.maximum(np.maximum(p, q), np.maximum(r, s))
            w[:n], x[:n], y[:n], z[:n] = p / most, q / most, r / most, s / most
        whole = np.zeros((4, len(self.start)))
        whole[:, own] = w, x, y, z
        w, x, y, z = whole
        for here, before in self.links:
            v = into[before]
            into[here] = (w[before] * v + x[before]) / (y[before] * v + z[before])
        for here, before in reversed(self.links):
            v = after[here]
            after[before] = (w[here] * v + y[here]) / (x[here] * v + z[here])
        return into, after

    def run(self, e: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ratios (state 1 over state 0) of forward and backward messages.

        ``e``: exp of each token's emission; ``a``: 2 x 2 exp of transitions.
        """
        r, b = np.empty(len(e)), np.ones(len(e))
        start = self.start
        into, after = self._entries(e, a)
        b[start + self.size - 1] = after
        for t, n in enumerate(self.active):
            at = start[:n] + t
            before = r[at - 1] if t else into
            r[at] = e[at] * (a[0, 1] + a[1, 1] * before) / (a[0, 0] + a[1, 0] * before)
            if t == 0:
                first = at[self.head]
                r[first] = e[first]
        for t in range(len(self.active) - 2, -1, -1):
            at = start[: self.active[t + 1]] + t
            x = e[at + 1] * b[at + 1]
            b[at] = (a[1, 0] + a[1, 1] * x) / (a[0, 0] + a[0, 1] * x)
        return r, b


@dataclass
class Tagger:
    """A fitted model: hashed emission weights, transitions, and the document calibration."""

    weights: np.ndarray
    bias: float
    trans: np.ndarray
    calibration: np.ndarray
    constant: float | None = None
    _seen: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_seen": {}}

    def emissions(self, words: list[str]) -> np.ndarray:
        seen, weights = self._seen, self.weights
        if len(seen) > 500_000:
            seen.clear()
        for w in set(words):
            if w not in seen:
                seen[w] = float(self.bias + weights[_buckets(w)].sum())
        return np.array([seen[w] for w in words])

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(p of every token of all texts, number of tokens of each text)."""
        words, lengths = [], []
        for t in texts:
            own = tokens(t)
            words += own
            lengths.append(len(own))
        e = np.exp(np.clip(self.emissions(words), -30, 30))
        r, b = Chains(lengths).run(e, np.exp(self.trans))
        odds = r * b
        return odds / (1 + odds), np.array(lengths, np.int64)

    def summary(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Per text: 1, log of -sum log(1 - p), largest logit."""
        p = np.clip(p, 1e-12, 1 - 1e-9)
        total, top = np.full(len(lengths), 1e-9), np.full(len(lengths), -20.0)
        some = lengths > 0
        if some.any():
            at = (np.cumsum(lengths) - lengths)[some]
            total[some] += np.add.reduceat(-np.log1p(-p), at)
            q = np.maximum.reduceat(p, at)
            top[some] = np.log(q / (1 - q))
        return np.stack([np.ones(len(lengths)), np.log(total), top], axis=1)

    def score(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(lengths), self.constant)
        z = self.summary(p, lengths) @ self.calibration
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _token_labels(ids: np.ndarray, lengths: np.ndarray, toxic: np.ndarray,
                  vocabulary: list[str]) -> np.ndarray:
    """1 for tokens of toxic texts whose word or prefix keeps toxic company."""
    last = np.cumsum(lengths) - 1
    before, after = np.roll(ids, 1), np.roll(ids, -1)
    full = lengths > 0
    before[(np.cumsum(lengths) - lengths)[full]] = -1
    after[last[full]] = -1
    context = (before.astype(np.int64) << 32) ^ (after.astype(np.int64) & 0xFFFFFFFF)
    is_toxic = np.repeat(toxic, lengths).astype(bool)
    marked = np.zeros(len(vocabulary), bool)
    for kind in (lambda w: w, lambda w: w[:4], lambda w: w[:5], lambda w: w[:6]):
        names: dict[str, int] = {}
        of_word = np.array([names.setdefault(kind(w), len(names)) for w in vocabulary])
        f = of_word[ids]
        counts = []
        for side in (is_toxic, ~is_toxic):
            # different contexts of each feature
            key = f[side].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ context[side].astype(
                np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
            _, first = np.unique(key, return_index=True)
            counts.append(np.bincount(f[side][first], minlength=len(names)).astype(float))
        a, c = counts
        share = a.sum() / max(1.0, a.sum() + c.sum())
        n = a + c
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = (np.where(a > 0, a * np.log(a / (n * share)), 0)
                    + np.where(c > 0, c * np.log(c / (n * (1 - share))), 0))
            strong = (a / np.maximum(n, 1) >= 0.8) & (gain >= np.log(len(names) + 1) + 4)
        marked |= strong[of_word] & np.array([len(w) >= 3 for w in vocabulary])
    return (marked[ids] & is_toxic).astype(float)


def fit(texts: list[str], toxic: list[int], prior: float) -> Tagger:
    """Fit on sample rows; ``prior`` is the share of label 1 among all learnable rows."""
    y = np.array(toxic, float)
    zero = Tagger(np.zeros(BUCKETS, np.float32), -6.0, np.zeros((2, 2)), np.zeros(3))
    if not len(y) or y.min() == y.max():
        zero.constant = float(prior)
        return zero
    vocabulary: dict[str, int] = {}
    ids, lengths = [], []
    for t in texts:
        own = tokens(t)
        ids += [vocabulary.setdefault(w, len(vocabulary)) for w in own]
        lengths.append(len(own))
    words, ids, lengths = list(vocabulary), np.array(ids, np.int32), np.array(lengths, np.int64)
    labels = _token_labels(ids, lengths, y, words)
    buckets = np.array([_buckets(w) for w in words])
    # whole texts, about TOKENS tokens at once: (texts, tokens, chains, tokens with a next one)
    end = np.cumsum(lengths)
    cuts = [0, *(np.flatnonzero(np.diff((end - lengths) // TOKENS)) + 1).tolist(), len(lengths)]
    parts = []
    for i, j in zip(cuts, cuts[1:]):
        chains = Chains(lengths[i:j])
        parts.append((slice(i, j), slice(end[i] - lengths[i], end[j - 1]), chains, chains.left()))
    seen_trans = np.zeros((2, 2))
    for _, own, _, left in parts:
        y01 = labels[own].astype(np.int64)
        seen_trans += np.bincount(2 * y01[left] + y01[left + 1], minlength=4).reshape(2, 2)
    rate = np.clip(labels.mean(), 1e-5, 0.5)
    per_word = np.bincount(ids, labels, len(words))
    weights, bias, trans = np.zeros(BUCKETS), float(np.log(rate / (1 - rate))), np.zeros((2, 2))
    m = [np.zeros(BUCKETS), np.zeros(5)]
    v = [np.zeros(BUCKETS), np.zeros(5)]
    for k in range(1, ROUNDS + 1):
        e_word = bias + weights[buckets].sum(axis=1)
        e_word = np.exp(np.clip(e_word, -30, 30))
        a = np.exp(trans)
        diff, want = per_word.copy(), np.zeros((2, 2))
        for _, own, chains, left in parts:
            e = e_word[ids[own]]
            r, b = chains.run(e, a)
            odds = r * b
            diff -= np.bincount(ids[own], odds / (1 + odds), len(words))
            # expected transitions
            f0, f1 = 1 / (1 + r[left]), r[left] / (1 + r[left])
            x = e[left + 1] * b[left + 1]
            pair = np.stack([f0 * a[0, 0], f0 * a[0, 1] * x, f1 * a[1, 0], f1 * a[1, 1] * x])
            want += (pair / pair.sum(axis=0)).sum(axis=1).reshape(2, 2)
        grad = np.bincount(buckets.ravel(), np.repeat(diff, buckets.shape[1]), BUCKETS) - 0.05 * weights
        rest = np.concatenate([[diff.sum()], (seen_trans - want).ravel() - 0.05 * trans.ravel()])
        for i, g in enumerate((grad, rest)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
        move = [0.3 * (m[i] / (1 - 0.9 ** k)) / (np.sqrt(v[i] / (1 - 0.99 ** k)) + 1e-3) for i in (0, 1)]
        weights += move[0]
        bias += 0.3 * move[1][0]
        trans += 0.3 * move[1][1:].reshape(2, 2)
    tagger = Tagger(weights.astype(np.float32), bias, trans, np.zeros(3))
    z = np.concatenate([tagger.summary(*tagger.marginals(texts[own])) for own, *_ in parts])
    c = np.zeros(3)
    ridge = np.diag([1e-3, 0.05, 0.05])
    # rows stand for their class's share of all learnable rows
    w = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
        h = (z * (w * q * (1 - q))[:, None]).T @ z + ridge
        c = c + np.clip(np.linalg.solve(h, z.T @ (w * (y - q)) - ridge @ c), -3, 3)
    tagger.calibration = c
    return tagger


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic") -> Tagger:
    """Fit on the bounded sample; only its keys and its texts reach the driver."""
    known = labels.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")) \
                  .where("__id IS NOT NULL AND __y IN (0, 1)").groupBy("__id").agg(F.max("__y").alias("__y"))
    count = {r["__y"]: r["n"] for r in known.groupBy("__y").agg(F.count("*").alias("n")).collect()}
    prior = count.get(1, 0) / max(1, sum(count.values()))
    texts = (docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
             .where("__text IS NOT NULL").withColumn("__hash", F.xxhash64("__text")))
    # labelled rows that have a text, equal ones once
    keys = (texts.select("__id", "__hash", F.length("__text").alias("__n")).distinct()
            .join(known, "__id"))
    chosen: list = []
    for label, most in MOST.items():
        held = 0
        for r in (keys.where(F.col("__y") == label).orderBy(F.xxhash64("__id"), "__id", "__hash", "__n")
                  .limit(most).collect()):
            if held < CHARS[label]:
                chosen.append((r["__id"], r["__hash"], r["__n"], label))
                held += r["__n"]
    if not chosen:
        return fit([], [], prior)
    schema = keys.select("__id", "__hash", "__n", "__y").schema
    wanted = docs.sparkSession.createDataFrame(chosen, schema).select("__id", "__hash")
    rows = {(r["__id"], r["__hash"], len(r["__text"])): r["__text"]
            for r in texts.join(F.broadcast(wanted), ["__id", "__hash"], "left_semi")
            .dropDuplicates(["__id", "__hash"]).collect()}
    sample = [(rows[row[:3]], row[3]) for row in chosen if row[:3] in rows]
    return fit([t for t, _ in sample], [y for _, y in sample], prior)


def score(docs: DataFrame, tagger: Tagger, *, id_col: str = "doc_id", text_col: str = "text",
          spans: bool = True) -> DataFrame:
    """One row per row: id, score, predicted, and spans array<struct<start,stop,p>> of the
    offending words (code points, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(tagger)  # about 4 MB whatever the input
    word = re.compile(r"\S+")
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())]))

    def work(texts: list[str]) -> dict:
        model = shared.value
        p, lengths = model.marginals(texts)
        s = model.score(p, lengths)
        out = {"score": pa.array(s), "predicted": pa.array((s >= 0.5).astype(np.int32))}
        if spans:
            found, end = [], np.cumsum(lengths)
            for t, n, stop in zip(texts, lengths, end):
                own = p[stop - n:stop]
                hit = np.flatnonzero(own >= 0.5)
                places = [m.span() for m in word.finditer(t)] if len(hit) else []
                found.append([{"start": places[i][0], "stop": places[i][1], "p": float(own[i])}
                              for i in hit])
            out["spans"] = pa.array(found, kind)
        return out

    schema = "score double, predicted int"
    if spans:
        schema += ", spans array<struct<start:int,stop:int,p:double>>"
    return per_text(docs, work, schema, id_col=id_col, text_col=text_col, out_id=id_col, most=BATCH)


def keep_clean(docs: DataFrame, tagger: Tagger, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with all their columns."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    index = docs.columns.index(text_col)

    def run(batches):
        model = shared.value
        for batch in batches:
            for part in text_batches([batch], batch.schema.names[index], BATCH):
                s = model.score(*model.marginals([t or "" for t in part.column(index).to_pylist()]))
                yield part.filter(pa.array(s < 0.5))

    return docs.mapInArrow(run, docs.schema)
