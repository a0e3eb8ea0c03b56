"""Operator 4: language identification by cross-parsing entropy.

Per language, a suffix automaton of a bounded sample of labelled text recognises exactly the
substrings of that sample.  A text is parsed greedily into the longest phrases that occur in
the sample; the language that needs the fewest phrases, normalised by the log2 of its
sample's length and by the text's length, wins (ties: the smaller name).

All pieces of a batch of texts step through all automata side by side, one array operation per
character position, so a character costs a few table look-ups and no Python code of its
own.  Texts are cut into pieces of ``PIECE`` characters for that; afterwards each piece is entered again in the state in
which the one before it was left, until this parse and the one from the piece's start are in one state.  So the
phrases are those of the whole text, whatever its length.

Letters are lower-cased; everything that is no letter counts as one space.  A null text and one
without letters are ``und`` with score 0, as is every text if no language was learned.
Rows whose language or text is null teach nothing, nor do sample rows that the rest of the
sample assigns to another language (:func:`agreed`).  Repeated rows each get a result, equal ones equal; of
languages with equal phrases the first by name wins.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aloft.llm.common import per_text

#: characters of a language's sample, which takes whole rows until it is full; a row of more characters than that
#: is drawn by stretches of that many, each like a row of its own
SAMPLE = 100_000
#: characters of all languages' samples together; with many languages each gets less
TOTAL = 1_200_000
#: candidates drawn by hash for a sample: characters as a multiple of the sample, and rows at least, about
DRAWN, DRAWN_ROWS = 3, 60
PIECE = 2_048
#: commonest letters whose transitions lie in a dense table; those of all others are searched
CLASSES = 64
_MODEL: dict = {}


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``codes``; state 0 is the start."""
    move: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(move)
        move.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in move[p]:
            move[p][c] = cur
            p = link[p]
        if p >= 0:
            q = move[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(move)
                move.append(dict(move[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and move[p].get(c) == q:
                    move[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return move


def lower(ch: str) -> str:
    """One character, whatever stands around it (unlike a final sigma) or follows (as in U+0130)."""
    return ch.lower()[0]


class CrossParser:
    """Automata of all languages side by side, over every letter of their samples.

    Transitions by the ``CLASSES`` commonest letters are a dense table, those by other letters a
    sorted array of state * alphabet + class."""

    def __init__(self, samples: dict[str, str]):
        self.langs = sorted(samples)
        letters: Counter = Counter()
        for ch, n in Counter("".join(samples.values())).items():
            if ch.isalpha():
                letters[lower(ch)] += n
        by_count = [c for c, _ in sorted(letters.items(), key=lambda x: (-x[1], x[0]))]
        # code point -> class; 0: a letter that no sample has, 1: no letter
        self.classes = np.ones(0x110000, np.int32)
        for cp in range(0x110000):
            ch = chr(cp)
            if ch.isalpha():
                self.classes[cp] = 0
        self.letter = self.classes == 0
        of = {c: i + 2 for i, c in enumerate(by_count)}
        for cp in np.flatnonzero(self.letter).tolist():
            self.classes[cp] = of.get(lower(chr(cp)), 0)
        self.alphabet = len(by_count) + 2
        self.width = width = min(len(by_count), CLASSES) + 2
        tables, root, base = [], [], 0
        self.first = np.full((len(self.langs), self.alphabet), -1, np.int32)
        keys, targets = [], []
        self.cost = []
        for k, lang in enumerate(self.langs):
            codes = self.codes(samples[lang])
            move = suffix_automaton(codes.tolist())
            table = np.full((len(move), width), -1, np.int32)
            for s, out in enumerate(move):
                for c, t in out.items():
                    if c < width:
                        table[s, c] = t + base
                    else:
                        keys.append((s + base) * self.alphabet + c)
                        targets.append(t + base)
            for c, t in move[0].items():
                self.first[k, c] = t + base
            tables.append(table)
            root.append(base)
            base += len(move)
            self.cost.append(np.log2(len(codes) + 2))
        self.table = np.concatenate(tables).ravel() if tables else np.empty(0, np.int32)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.targets = np.array(targets, np.int32)[order]
        self.root = np.array(root, np.int32)[:, None]
        self.cost = np.array(self.cost)

    def step(self, states: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Where classes ``c`` (n) lead from ``states`` (languages, n); -1: nowhere."""
        far = np.flatnonzero(c >= self.width)
        if not len(far):
            return self.table[states * self.width + c]
        to = self.table[states * self.width + np.where(c < self.width, c, 0)]
        key = states[:, far].astype(np.int64) * self.alphabet + c[far]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        to[:, far] = np.where(self.keys[at] == key, self.targets[at], -1)
        return to

    def codes(self, text: str) -> np.ndarray:
        """Classes of the text's characters, runs of non-letters as one."""
        cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        c = self.classes[cps]
        return c[(c != 1) | (np.roll(c, 1) != 1)] if len(c) else c

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """(languages, texts): number of phrases of each text."""
        pieces, owner = [], []
        for i, c in enumerate(texts):
            for s in range(0, len(c), PIECE):
                pieces.append(c[s:s + PIECE])
                owner.append(i)
        if not pieces:
            return np.zeros((len(self.langs), len(texts)), np.int64)
        n, left = self.closed(pieces)
        last = np.append(np.diff(owner) > 0, True)
        root = self.root[:, 0].tolist()
        for i in range(1, len(pieces)):
            if last[i - 1]:
                continue
            for k, start in enumerate(root):
                entered = int(left[k, i - 1])
                if entered != start:
                    more, left[k, i] = self.entered(k, pieces[i], entered, int(left[k, i]))
                    n[k, i] += more
        n[:, last] += left[:, last] != self.root  # the phrase that the text's end cuts off
        return np.stack([np.bincount(owner, row, len(texts)) for row in n]).astype(np.int64)

    def entered(self, k: int, piece: np.ndarray, state: int, left: int) -> tuple[int, int]:
        """What entering the piece in ``state`` of language ``k`` changes: phrases closed in addition to those of a
        parse from the piece's start, and the state at its end (``left`` if both parses meet)."""
        root = int(self.root[k, 0])
        there, more = root, 0
        for c in piece.tolist():
            state, closed = self.one(k, c, state, root)
            there, before = self.one(k, c, there, root)
            more += closed - before
            if state == there:
                return more, left
        return more, state

    def one(self, k: int, c: int, state: int, root: int) -> tuple[int, int]:
        """State after a character of class ``c`` and the phrases it closed."""
        to = self.to(state, c)
        if to >= 0:
            return to, 0
        closed = int(state != root)
        to = int(self.first[k, c])
        return (to, closed) if to >= 0 else (root, closed + 1)

    def to(self, state: int, c: int) -> int:
        if c < self.width:
            return self.table.item(state * self.width + c)
        key = state * self.alphabet + c
        at = int(np.searchsorted(self.keys, key))
        return self.targets.item(at) if at < len(self.keys) and self.keys.item(at) == key else -1

    def closed(self, pieces: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(languages, pieces) each: phrases that a parse from each piece's start closes in it, its state at the end."""
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(-lengths, kind="stable")
        flat = np.concatenate([pieces[i] for i in order]) if len(order) else np.empty(0, np.int32)
        sorted_ = lengths[order]
        start = np.cumsum(sorted_) - sorted_
        n_phrases = np.zeros((len(self.langs), len(order)), np.int64)
        state = np.repeat(self.root, len(order), axis=1)
        top = int(sorted_[0]) if len(order) else 0
        active = np.searchsorted(-sorted_, -np.arange(top), side="left")
        for t, n in enumerate(active):
            c = flat[start[:n] + t]
            now = state[:, :n]
            to = self.step(now, c)
            ended = to < 0
            # the phrase ends before c; c starts the next one, or is one if it is unknown
            again = self.first[:, c]
            n_phrases[:, :n] += ended & (now != self.root)
            to = np.where(ended, again, to)
            lost = to < 0
            n_phrases[:, :n] += lost
            state[:, :n] = np.where(lost, self.root, to)
        out, left = np.empty_like(n_phrases), np.empty_like(state)
        out[:, order], left[:, order] = n_phrases, state
        return out, left

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        langs, scores = ["und"] * len(texts), np.zeros(len(texts))
        codes, owner, size = [], [], np.zeros(len(texts))
        for i, t in enumerate(texts):
            if not self.langs or not t:
                continue
            cps = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), "<u4")
            if not self.letter[cps].any():
                continue
            c = self.codes(t)
            size[i] = len(c)
            codes.append(c)
            owner.append(i)
        if codes:
            total = np.zeros((len(self.langs), len(texts)))
            total[:, owner] = self.phrases(codes)
            bits = total * self.cost[:, None] / np.maximum(size, 1)
            best = bits.argmin(axis=0)
            weight = np.exp2(-8 * (bits - bits.min(axis=0)))
            share = 1 / weight.sum(axis=0)
            for i in np.flatnonzero(size > 0):
                langs[i], scores[i] = self.langs[best[i]], share[i]
        return langs, scores


def samples(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang") -> dict[str, str]:
    """Per language, whole texts of the rows with the smallest hash of their id, within the bounds
    above; very long rows by stretches.  A threshold on the hash, from the language's size, cuts the candidates before
    they are ordered."""
    spark = docs.sparkSession
    base = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(id_col).alias("h"),
                    F.col(text_col).alias("text"), F.length(text_col).cast("long").alias("n")))
    sizes = base.groupBy("lang").agg(F.sum("n").alias("chars"), F.count("*").alias("rows")).collect()
    most = min(SAMPLE, TOTAL // max(1, len(sizes)))
    below = [(r["lang"], min(1.0, max(DRAWN * most / max(1, r["chars"]), DRAWN_ROWS / r["rows"]))) for r in sizes]
    # a row for each language, all of which the driver holds: texts need not move to meet it
    with_bound = base.join(F.broadcast(spark.createDataFrame(below, "lang string, below double")), "lang")
    hit = F.pmod("h", F.lit(1 << 31)) < F.col("below") * float(1 << 31)
    short = with_bound.where((F.col("n") <= most) & hit).select("lang", "h", "text", "n")
    # few enough to be drawn by themselves; the texts are cut only where the hash of the stretch is drawn
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / most)))
    long = (with_bound.where(F.col("n") > most).withColumn("at", stretch)
            .withColumn("h", F.xxhash64("h", "at")).where(hit)
            .withColumn("text", F.substring("text", F.col("at").cast("int") * most + 1, F.lit(most)))
            .select("lang", "h", "text", F.length("text").cast("long").alias("n")))
    drawn = short.unionByName(long)
    order = Window.partitionBy("lang").orderBy("h", "text")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    rows = (drawn.withColumn("k", F.row_number().over(order)).withColumn("before", before)
            .where(F.col("before") < DRAWN * most).select("lang", "k", "text").collect())
    by: dict[str, list] = {r["lang"]: [] for r in rows}
    seen: set[str] = set()
    for r in sorted(rows, key=lambda r: (r["k"], r["lang"])):
        # near copies would vouch for each other's label
        words = r["text"].lower().split()
        grams = {" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))}
        if len(grams & seen) <= 0.3 * len(grams):
            by[r["lang"]].append(r["text"])
        seen |= grams
    return {k: filled(v, most) for k, v in agreed(by, most).items()}


def filled(texts: list[str], most: int) -> str:
    """Whole texts until they have ``most`` characters."""
    out, held = [], 0
    for t in texts:
        if held >= most:
            break
        out.append(t)
        held += len(t)
    return " ".join(out)


def agreed(rows: dict[str, list[str]], most: int) -> dict[str, list[str]]:
    """Sample rows without those whose label looks wrong: either half of the rows is parsed by
    the other half's automata, and rows of another verdict go (a language keeps its
    rows if none of them agrees)."""
    halves = [{k: v[h::2] for k, v in rows.items()} for h in (0, 1)]
    kept: dict[str, list[str]] = {k: [] for k in rows}
    for own, other in (halves, halves[::-1]):
        parser = CrossParser({k: filled(v, most // 2) for k, v in other.items() if v})
        for k, v in own.items():
            verdict, _ = parser.predict(v)
            kept[k] += [t for t, got in zip(v, verdict) if got == k]
    return {k: kept[k] or rows[k] for k in rows}


def identify(docs: DataFrame, samples: dict[str, str], *, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row per row: id, lang_pred, score (0 to 1).  ``samples``: language -> text."""
    key = hash(tuple(sorted(samples.items())))

    def work(texts: list[str]) -> dict:
        if key not in _MODEL:  # built once per Python worker
            _MODEL.clear()
            _MODEL[key] = CrossParser(samples)
        langs, scores = _MODEL[key].predict(texts)
        return {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores)}

    return per_text(docs, work, "lang_pred string, score double", id_col=id_col,
                    text_col=text_col, out_id=id_col)
