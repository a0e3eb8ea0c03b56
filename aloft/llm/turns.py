"""Operator 12: conversation structure repair by iterative-deepening A*.

Turns of a conversation are ordered by turn (nulls first; ties by role, then text).  The first fault
of a turn counts: ``blank`` (no character but white space), ``duplicate`` (role and text seen
earlier), ``truncated`` (does not end in one of ``.!?``).  The cheapest edits are sought that make the
role initials match ``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 3, Delete 4 (blank and duplicate
turns must go), Insert an empty turn 3, and 3 more for each truncated turn that stays.

:func:`search` goes depth first through the edits in ASCII order (D, I, K, R) below a bound on the cost,
which is raised to the least cost that exceeded it until a path is accepted; a state that failed
is kept with the least cost it would have needed, so it is not opened again below that.  The first
accepted path is the cheapest one and, of those, the least in ASCII order.

Conversations of any length are handled alike: turns are range-partitioned and sorted, and stretches
of at most :data:`STRETCH` turns of one conversation are searched, in different tasks.  A stretch that is
a whole conversation is searched from the empty repair to an accepted one, any other from each of the four
states that its role pattern may be in to each other, and a pass over the stretches of a
conversation, last to first, joins them (a cost for each state is all it holds besides 12 bytes a stretch).
Equal costs stay apart: repairs of one stretch from one state have equally many letters D, K, R and end in
one of these, so that none begins another, and the least whole is made of least parts.

Null roles and texts count as one space, null conversation ids are a conversation of their own, null
turns go first; repeated rows are duplicates.  An empty role or one with another initial than
s, u, a fits nowhere and is rerolled or deleted.  A conversation without turns needs no edit.  Very long texts are
read row by row.  An empty table gives empty ones.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aloft.llm.common import saved, ship, shuffle_partitions, text_batches
from aloft.llm.shards import crc32_sql

#: turns searched at once
STRETCH = 256
#: states of the role pattern: nothing yet, after s, after u, after a
START, S, U, A = range(4)
#: the state that inserting or rerolling leads to (user, user, assistant, user)
NEXT = (U, U, A, U)
ROLE = ("", "", "user", "assistant")
#: the states in which a turn of this initial may stay, and where that leads
KEEP = {"s": {START: S}, "u": {START: U, S: U, A: U}, "a": {U: A}, "-": {}}
LEGAL = ("su", "ua", "au")
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NEVER = 1 << 60
#: white space
BLANKS = " \t\n\x0b\x0c\r"
ANY = -1


@lru_cache(maxsize=20_000)
def search(codes: str, entry: int, goal: int) -> tuple[int, str] | None:
    """(cost, edits) of the cheapest repair from state ``entry`` to state ``goal`` (:data:`ANY`: to an accepted
    end, inserting after the last turn if need be), or None.

    ``codes`` has two characters a turn: its initial (``-``: any other) and its fault, ``x`` must go, ``t``
    truncated, ``.`` none."""
    n = len(codes) // 2
    # least cost from each (turn, state) to the end, as far as known
    low = [0] * (4 * n) + ([0, 6, 3, 0] if goal == ANY else [0 if q == goal else NEVER for q in range(4)])
    floor = 0
    for i in range(n - 1, -1, -1):
        floor += {"x": DELETE, "t": TRUNCATED, ".": 0}[codes[2 * i + 1]]
        low[4 * i:4 * i + 4] = [floor] * 4
        if goal in (START, S):  # no edit leads back there, however many turns are inserted
            low[4 * i + U] = low[4 * i + A] = NEVER
            if goal == START:
                low[4 * i + S] = NEVER

    def edits(i: int, q: int) -> Iterator[tuple[str, int, int, int]]:
        if i == n:
            return iter((("I", i, NEXT[q], INSERT),) if goal == ANY else ())
        fault = codes[2 * i + 1]
        out = [("D", i + 1, q, DELETE), ("I", i, NEXT[q], INSERT)]
        if fault != "x":
            more = TRUNCATED if fault == "t" else 0
            stay = KEEP[codes[2 * i]].get(q)
            if stay is not None:
                out.append(("K", i + 1, stay, more))
            out.append(("R", i + 1, NEXT[q], REROLE + more))
        return iter(out)

    done = (START, A) if goal == ANY else (goal,)
    while (bound := low[entry]) < NEVER:
        path: list[str] = []
        # turn, state, cost left, edits not tried yet, least cost that was too much
        stack = [[0, entry, bound, edits(0, entry), NEVER]]
        while stack:
            top = stack[-1]
            i, q, left, rest, _ = top
            if i == n and q in done:
                return bound, "".join(path)
            for letter, j, to, cost in rest:
                need = cost + low[4 * j + to]
                if need <= left:
                    path.append(letter)
                    stack.append([j, to, left - cost, edits(j, to), NEVER])
                    break
                top[4] = min(top[4], need)
            else:
                low[4 * i + q] = top[4]
                stack.pop()
                if stack:
                    path.pop()
                    above = stack[-1]
                    above[4] = min(above[4], above[2] - left + top[4])
    return None


def replay(audit: str, entry: int, codes: str) -> Iterator[tuple[str, int | None, str | None]]:
    """(edit, number of the turn or None, new role or None for the turn's own) for each edit."""
    i, q = 0, entry
    for letter in audit:
        if letter == "I":
            q = NEXT[q]
            yield letter, None, ROLE[q]
            continue
        role = None
        if letter == "R":
            q = NEXT[q]
            role = ROLE[q]
        elif letter == "K":
            q = KEEP[codes[2 * i]][q]
        yield letter, i, role
        i += 1


def illegal_pairs(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


def damage(rows: DataFrame) -> DataFrame:
    """The stated damage by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2
    removes its marks ``.!?``, 3 repeats it, 4 makes its role user.  Nulls count as one space."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(name.cast("binary")) % 20
    text, role = (F.coalesce(F.col(c), F.lit(" ")) for c in ("text", "role"))
    return (rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
            .where("kind <> 0")
            .select("conv_id", "turn",
                    F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", ""))
                    .otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1)))
                              .otherwise(F.array(F.lit(0)))).alias("copy"))
            .drop("copy"))


def _ordered(rows: DataFrame) -> DataFrame:
    """All turns with ``key``, ascending in (conversation, turn, role, text), written once.  Ranges also
    split equal rows, so neither a conversation nor a repeated row is kept in one task."""
    order = ["conv", F.asc_nulls_first("turn"), "role", "text", "salt"]
    src = (rows.select(F.col("conv_id").alias("conv"), "turn",
                       F.coalesce(F.col("role"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text"), F.lit(" ")).alias("text"))
           .withColumn("salt", F.monotonically_increasing_id()))
    ends = F.rtrim("text", F.lit(BLANKS))
    first = F.substring("role", 1, 1)
    return saved(src.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
                 .select(F.monotonically_increasing_id().alias("key"), "conv", "turn", "role", "text",
                         F.when(first.isin("s", "u", "a"), first).otherwise("-").alias("initial"),
                         (ends == "").alias("blank"), (~F.right(ends, F.lit(1)).isin(".", "!", "?")).alias("open"),
                         F.sha2("text", 256).alias("digest")), "turns")


FOUND = ("cid long, stretch long, first boolean, last boolean, codes string, illegal long, "
         "entries array<int>, exits array<int>, costs array<long>, audits array<string>")


def _search_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("illegal", pa.int64()), ("entries", pa.list_(pa.int32())), ("exits", pa.list_(pa.int32())),
                        ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
    for batch in batches:
        made: dict = {f.name: [] for f in schema}
        first, last, codes = (batch.column(i).to_pylist() for i in (2, 3, 4))
        for one, end, code in zip(first, last, codes, strict=True):
            ways = [(p, q, got) for p in ((START,) if one else range(4)) for q in ((ANY,) if end else range(4))
                    if (got := search(code, p, q))]
            made["illegal"].append(illegal_pairs(code[::2]))
            made["entries"].append([p for p, _, _ in ways])
            made["exits"].append([q for _, q, _ in ways])
            made["costs"].append([got[0] for _, _, got in ways])
            made["audits"].append([got[1] for _, _, got in ways])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(made[f.name], f.type) for f in schema)],
            names=[*batch.schema.names, *made])


def _join_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches come by conversation, the last one first; out goes which way each takes."""
    names = ["stretch", "pick", "border"]

    def walk() -> pa.RecordBatch:
        """First to last through the held choices (kept last to first)."""
        state, picks = START, []
        for k in range(len(stretches) - 1, -1, -1):
            pick = choices[4 * k + state]
            picks.append(pick)
            state = exits[16 * k + pick]
        return pa.RecordBatch.from_arrays([pa.array(list(reversed(stretches)), pa.int64()), pa.array(picks, pa.int32()),
                                           pa.array(list(reversed(borders)), pa.int64())], names=names)

    now, stretches, choices, exits, borders = None, array("q"), bytearray(), bytearray(), bytearray()
    worth, following = [], ""
    for batch in batches:
        for r in batch.to_pylist():
            if r["cid"] != now:
                if stretches:
                    yield walk()
                now, stretches, choices, exits, borders = r["cid"], array("q"), bytearray(), bytearray(), bytearray()
                worth, following = [0] * 4, ""
            best: list = [(NEVER, "", 0)] * 4
            for k, (p, q, cost, audit) in enumerate(zip(r["entries"], r["exits"], r["costs"], r["audits"], strict=True)):
                best[p] = min(best[p], (cost + (0 if q == ANY else worth[q]), audit, k))
            worth = [b[0] for b in best]
            stretches.append(r["stretch"])
            choices.extend(b[2] for b in best)
            exits.extend((r["exits"][k] if k < len(r["exits"]) else 0) % 4 for k in range(16))
            borders.append(illegal_pairs(r["codes"][-2] + following) if following else 0)
            following = r["codes"][0]
    if stretches:
        yield walk()


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: for each conversation of ``rows`` (conv_id, cid, gaps, blank, duplicate, truncated, illegal,
    cost, audit), and the repaired turns (cid, position, edit, role, text) in order within tasks."""
    ship(rows.sparkSession)
    turns = _ordered(rows)
    short = turns.drop("text")
    seen = (short.groupBy("conv", "role", "digest").agg(F.min("key").alias("seen_first"), F.count("*").alias("times"))
            .where("times > 1").select(F.col("conv").alias("__c"), F.col("role").alias("__r"),
                                       F.col("digest").alias("__d"), "seen_first"))
    flagged = (short.join(seen, F.col("conv").eqNullSafe(F.col("__c")) & (F.col("role") == F.col("__r"))
                          & (F.col("digest") == F.col("__d")), "left")
               .withColumn("duplicate", ~F.col("blank") & F.coalesce(F.col("key") > F.col("seen_first"), F.lit(False)))
               .withColumn("truncated", ~F.col("blank") & ~F.col("duplicate") & F.col("open"))
               .select("key", "conv", "turn", "initial", "blank", "duplicate", "truncated"))
    flagged = saved(flagged, "turn-faults")

    counts = (flagged.groupBy("conv", "turn")
              .agg(F.min("key").alias("cid"), *[F.sum(F.col(c).cast("long")).alias(c)
                                                for c in ("blank", "duplicate", "truncated")])
              .groupBy("conv")
              .agg(F.min("cid").alias("cid"), F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0))
                   .cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]))
    counts = saved(counts, "turn-counts")

    # stretches: consecutive turns of one conversation within one chunk of the order
    low_bits = F.col("key").bitwiseAND(F.lit((1 << 33) - 1))
    code = F.concat("initial", F.when(F.col("blank") | F.col("duplicate"), "x")
                    .when(F.col("truncated"), "t").otherwise("."))
    stretches = (flagged.groupBy("conv", (F.col("key") - low_bits % STRETCH).alias("chunk"))
                 .agg(F.min("key").alias("stretch"), F.sort_array(F.collect_list(F.struct("key", code.alias("c")))).alias("cs"))
                 .select("conv", "stretch", F.array_join(F.transform("cs", lambda x: x.c), "").alias("codes")))
    ends = (stretches.groupBy("conv").agg(F.min("stretch").alias("cid"), F.max("stretch").alias("end"))
            .select(F.col("conv").alias("__c"), "cid", "end"))
    src = (stretches.join(ends, F.col("conv").eqNullSafe(F.col("__c")))
           .select("cid", "stretch", (F.col("stretch") == F.col("cid")).alias("first"),
                   (F.col("stretch") == F.col("end")).alias("last"), "codes"))
    found = saved(src.mapInArrow(_search_all, FOUND), "turn-repairs")

    whole = found.where("first AND last").select("stretch", F.lit(0).alias("pick"), F.lit(0).cast("long").alias("border"))
    parts = (found.where("NOT (first AND last)").repartition("cid")
             .sortWithinPartitions("cid", F.desc("stretch"))
             .mapInArrow(_join_stretches, "stretch long, pick int, border long"))
    chosen = saved(found.join(whole.union(parts), "stretch")
                   .select("cid", "stretch", "first", "codes", (F.col("illegal") + F.col("border")).alias("illegal"),
                           F.col("entries")[F.col("pick")].alias("entry"), F.col("costs")[F.col("pick")].alias("cost"),
                           F.col("audits")[F.col("pick")].alias("audit")), "turn-edits")
    sums = (chosen.groupBy("cid").agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
                                      F.sort_array(F.collect_list(F.struct("stretch", "audit"))).alias("parts"))
            .select("cid", "illegal", "cost", F.array_join(F.transform("parts", lambda x: x.audit), "").alias("audit")))
    summary = counts.join(sums, "cid").select(F.col("conv").alias("conv_id"), "cid", "gaps", "blank", "duplicate",
                                              "truncated", "illegal", "cost", "audit")

    # edits go in front of their stretch's turns; both come in order to one task of their conversation
    plans = chosen.join(counts.select("conv", "cid"), "cid").select(
        "conv", F.col("stretch").alias("key"), "cid", "first", "codes", "entry", "audit",
        F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = turns.select("conv", "key", F.lit(None).cast("long").alias("cid"), F.lit(None).cast("boolean").alias("first"),
                         F.lit(None).cast("string").alias("codes"), F.lit(None).cast("int").alias("entry"),
                         F.lit(None).cast("string").alias("audit"), "role", "text")
    both = (plans.unionByName(texts).repartition("conv").sortWithinPartitions("key", F.asc_nulls_last("cid"))
            .drop("conv", "key"))
    return summary, both.mapInArrow(_apply_edits, "cid long, position long, edit string, role string, text string")


def _apply_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches come before their turns, both in order."""
    position, cid, plan, left = 0, None, iter(()), 0
    for batch in text_batches(batches, "text"):
        out: list[tuple] = []
        for r in batch.to_pylist():
            if r["cid"] is not None:
                cid, plan, left = r["cid"], replay(r["audit"], r["entry"], r["codes"]), len(r["codes"]) // 2
                position = 0 if r["first"] else position
                continue
            left -= 1
            for letter, i, role in plan:
                if letter != "D":
                    out.append((cid, position, letter, role or r["role"], "" if i is None else r["text"]))
                    position += 1
                if i is not None and left:  # this turn is done; after the last one inserted turns may follow
                    break
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)],
                                             names=["cid", "position", "edit", "role", "text"])


def digests(turns: DataFrame) -> DataFrame:
    """(cid, repaired_sha256) of ``role:text`` lines joined by newlines, hashed turn by turn as the repaired
    turns come, so that a conversation of any length takes no memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for cid, role, text in zip(*(batch.column(c).to_pylist() for c in ("cid", "role", "text")), strict=True):
                if cid != now:
                    if now is not None:
                        done.append((now, state.hexdigest()))
                    now, state = cid, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["cid", "repaired_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], names=["cid", "repaired_sha256"])

    return turns.select("cid", "role", "text").mapInArrow(run, "cid long, repaired_sha256 string")


def audit(conversations: DataFrame) -> DataFrame:
    """One row per conversation of the table: what the damage did to it and its cheapest repair."""
    summary, turns = repair(damage(conversations))
    made = summary.join(digests(turns), "cid", "left").withColumnRenamed("conv_id", "__c")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return (conversations.select("conv_id").distinct().join(made, F.col("conv_id").eqNullSafe(F.col("__c")), "left")
            .select("conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256")))


def _values(rows) -> str:
    return ", ".join(str(r) for r in rows)


#: inserted turns before an edit: (from, to, cost, letters, lines begun by |); more than two are never cheapest
_INSERTS = [(q, q, 0, "", "") for q in range(4)] + \
           [(q, NEXT[q], 3, "I", f"|{ROLE[NEXT[q]]}:") for q in range(4)] + \
           [(q, NEXT[NEXT[q]], 6, "II", f"|{ROLE[NEXT[q]]}:|{ROLE[NEXT[NEXT[q]]]}:") for q in range(4)]
#: (letter, initial or '' for all, must the turn go, from, to, cost, role or '' for its own)
_STEPS = [("D", "", True, q, q, 4, "") for q in range(4)] + [("D", "", False, q, q, 4, "") for q in range(4)] + \
         [("R", "", False, q, NEXT[q], 3, ROLE[NEXT[q]]) for q in range(4)] + \
         [("K", c, False, q, to, 0, "") for c, ways in KEEP.items() for q, to in ways.items()]

ORACLE = f"""
WITH RECURSIVE
ins(q, q2, cost, letters, lines) AS (VALUES {_values(_INSERTS)}),
steps(letter, initial, must_go, q, q2, cost, role) AS (VALUES {_values(_STEPS)}),
d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations),
x AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM d WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM x),
seen AS (
  SELECT *, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
         NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') AS cut,
         lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] AS pair FROM o),
f AS (
  SELECT conv_id, turn, i, role, text, pair, blank, again AND NOT blank AS duplicate,
         cut AND NOT blank AND NOT again AS truncated FROM seen),
ids AS (SELECT DISTINCT conv_id FROM conversations),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, 0 AS cost, '' AS audit, '' AS made FROM ids
  UNION ALL
  SELECT conv_id, i, q, cost, audit, made FROM (
    SELECT dp.conv_id, f.i, s.q2 AS q,
           dp.cost + ins.cost + s.cost + CASE WHEN truncated AND letter <> 'D' THEN 3 ELSE 0 END AS cost,
           dp.audit || ins.letters || letter AS audit,
           dp.made || replace(lines, '|', chr(10)) || CASE WHEN letter = 'D' THEN '' ELSE
             chr(10) || CASE WHEN s.role = '' THEN f.role ELSE s.role END || ':' || text END AS made,
           row_number() OVER (PARTITION BY dp.conv_id, s.q2 ORDER BY
             dp.cost + ins.cost + s.cost + CASE WHEN truncated AND letter <> 'D' THEN 3 ELSE 0 END,
             dp.audit || ins.letters || letter) AS best
    FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1
    JOIN ins ON ins.q = dp.q
    JOIN steps s ON s.q = ins.q2 AND s.must_go = (blank OR duplicate)
         AND (s.initial = '' OR s.initial = f.role[1]))
  WHERE best = 1),
n AS (SELECT ids.conv_id, count(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
             count(*) FILTER (truncated) AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM ids LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id GROUP BY ids.conv_id),
e AS (
  SELECT dp.conv_id, dp.cost + ins.cost AS cost, audit || letters AS audit,
         made || replace(lines, '|', chr(10)) AS made,
         row_number() OVER (PARTITION BY dp.conv_id ORDER BY dp.cost + ins.cost, audit || letters) AS best
  FROM dp JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id AND n.n = dp.i
  JOIN ins ON ins.q = dp.q AND ins.q2 IN (0, 3))
SELECT n.conv_id, gaps::BIGINT AS gaps, blank, duplicate, truncated, illegal, cost::BIGINT AS cost, audit,
       sha256(made[2:]) AS repaired_sha256
FROM n JOIN e ON e.conv_id IS NOT DISTINCT FROM n.conv_id AND best = 1
"""
