import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from aloft.llm import queries, turns
from tools.compare import rows_key, spark_rows, sql_rows, views

from .conftest import SF

SPACE = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(turns_):
    """Plain dynamic programming over (turns done, output initials' state): least (cost, audit) with the turns made."""
    after = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    name = {"u": "user", "a": "assistant"}
    now = {"": (0, "", ())}

    def insert(states):
        for _ in range(2):
            for q, (cost, audit, made) in list(states.items()):
                for c in "ua":
                    to = after[q].get(c)
                    if to:
                        way = (cost + 3, audit + "I", (*made, (name[c], "")))
                        if to not in states or way[:2] < states[to][:2]:
                            states[to] = way
        return states
    for role, text, fault in turns_:
        new = {}
        for q, (cost, audit, made) in insert(now).items():
            ways = [(q, 4, "D", ())]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                if role[:1] in after[q]:
                    ways.append((after[q][role[:1]], more, "K", ((role, text),)))
                ways += [(after[q][c], 3 + more, "R", ((name[c], text),)) for c in "ua" if c in after[q]]
            for to, more, letter, kept in ways:
                way = (cost + more, audit + letter, made + kept)
                if to not in new or way[:2] < new[to][:2]:
                    new[to] = way
        now = new
    return min((insert(now)[q] for q in ("", "a") if q in now), key=lambda w: w[:2])


def brute(rows):
    out = []
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r[1:] for r in after if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked = set(), []
        for _, role, text in mine:
            fault = "blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen else \
                "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, made = cheapest(marked)
        text = "\n".join(f"{r}:{t}" for r, t in made)
        out.append((str(conv), gaps, *(sum(f == k for _, _, f in marked) for k in ("blank", "duplicate", "truncated")),
                    illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def rows(df):
    return sorted((str(r.conv_id), r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit,
                   r.repaired_sha256) for r in df.collect())


def made_up(seed, convs, longest):
    r = random.Random(seed)
    out = []
    for conv in range(convs):
        for turn in range(r.randint(1, longest)):
            role = r.choice(["system"] * (turn == 0) + ["user", "assistant"] * 4 + ["tool", "", None, "Ämter"])
            text = r.choice(["yes.", "no", "Is it?", "well! ", " ", "", None, f"t{turn}.", "said\n"])
            out.append((conv if conv else None, r.choice([turn, turn, turn, None]), role, text))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


def test_equals_sql(spark, sf):
    con = duckdb.connect()
    views(con, SF)
    cols, got = spark_rows(queries.op12_conversation_repair(spark, sf))
    want_cols, want = sql_rows(con, turns.ORACLE)
    assert cols == want_cols and rows_key(got) == rows_key(want) and len(got) > 10


@pytest.mark.parametrize("stretch", [1, 3, 256])
def test_equals_brute_force(spark, monkeypatch, stretch):
    """Short stretches: most conversations are joined from several."""
    data = made_up(1, 60, 14) + [(99, t, "user", "same.") for t in (1, 1, 1, 2)] + [(98, None, None, None)]
    monkeypatch.setattr(turns, "STRETCH", stretch)
    df = spark.createDataFrame([(*r, "x", "x") for r in data], SCHEMA + ", key string, cid string").repartition(4)
    assert rows(turns.audit(df)) == brute(data)


def test_one_conversation_holds_a_third(spark, monkeypatch):
    monkeypatch.setattr(turns, "STRETCH", 40)
    r = random.Random(8)
    data = [(7, t, r.choice(["user", "assistant"]), r.choice(["a.", "b", f"{t}!"])) for t in range(700)]
    data += [(5, None, "user", "again.")] * 300 + made_up(3, 30, 8)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    assert rows(turns.audit(df)) == brute(data)
    stretches = turns._ordered(turns.damage(df)).where("conv = 7").selectExpr("shiftright(key, 33) AS part").distinct()
    assert stretches.count() > 1  # the long conversation is spread over tasks


def test_search_is_cheapest_and_least():
    r = random.Random(2)
    for _ in range(300):
        codes = "".join(r.choice("suua-a") + r.choice("...xt") for _ in range(r.randint(0, 9)))
        marked = [({"s": "system", "u": "user", "a": "assistant", "-": "tool"}[c], "t",
                   {"x": "blank", "t": "truncated", ".": ""}[f]) for c, f in zip(codes[::2], codes[1::2], strict=True)]
        assert turns.search(codes, turns.START, turns.ANY) == cheapest(marked)[:2]
    assert turns.search("s.", turns.A, turns.S) is None


def test_long_search_ends(spark):
    r = random.Random(3)
    codes = "".join(r.choice("ua") + r.choice("....xt") for _ in range(turns.STRETCH))
    cost, audit = turns.search(codes, turns.START, turns.ANY)
    assert cost > 200 and sum(c != "I" for c in audit) == turns.STRETCH


def test_repaired_turns_are_in_order(spark):
    data = [(1, t, role, text) for t, (role, text) in enumerate([("assistant", "a."), ("user", "b."), ("user", "c")])]
    summary, made = turns.repair(spark.createDataFrame(data, SCHEMA))
    got = sorted((x.position, x.edit, x.role, x.text) for x in made.collect())
    assert summary.first().audit == "".join(e for _, e, _, _ in got) or "D" in summary.first().audit
    assert [g[2] for g in got] == ["user", "assistant"] * (len(got) // 2)


def test_empty_table(spark):
    assert turns.audit(spark.createDataFrame([], SCHEMA)).count() == 0
