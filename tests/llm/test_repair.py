"""Conversation repair against plain recursion over whole audits, and on odd rows."""

import functools
import hashlib
import random
import re

import duckdb
import pyarrow as pa
import pytest

from sentilake.llm import conversation_repair as C, oracle, queries

SCHEMA = "conv_id long, turn long, role string, text string, key string, part string, row int"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
ROLE = {"u": "user", "a": "assistant"}


def brute(rows):
    """Counts, cost, audit and hash of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, md5(md5(r[1]) + md5(r[2]))))
    seen, marks = set(), []
    for _, role, text in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "b" if not plain else "d" if (role, text) in seen else "t" if plain[-1] not in ".!?" else ""
        seen.add((role, text))
        marks.append((role[:1], fault))

    @functools.cache
    def best(i, state, inserted=0):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        then = "a" if state == "u" else "u"
        if inserted < 2:
            c, e, out = best(i, then, inserted + 1)
            ways.append((c + 2, "I" + e, ((ROLE[then], ""), *out)))
        if i < len(rows):
            initial, fault = marks[i]
            _, role, text = rows[i]
            c, e, out = best(i + 1, state)
            ways.append((c + 3, "D" + e, out))
            if fault not in ("b", "d"):
                late = fault == "t"
                if (state, initial) in STEP:
                    c, e, out = best(i + 1, STEP[state, initial])
                    ways.append((c + late, "K" + e, ((role, text), *out)))
                c, e, out = best(i + 1, then)
                ways.append((c + 2 + late, "R" + e, ((ROLE[then], text), *out)))
        return min(ways, default=(10**6, "", ()))

    cost, audit, out = best(0, "")
    turns = {t for t, _, _ in rows if t is not None}
    faults = [f for _, f in marks]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest())


def repaired(df):
    found = C.repair(df)
    rows = found.summary.join(C.transcripts(found.blocks), "key").collect()
    return found, {r["id"]: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


def random_conversations(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for conv in range(n):
        for k in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", None, ""])
            text = rng.choice(["Yes.", "No.", f"row {k}.", f"cut {k}", "", " \t\n", None, f"really {k}?  \n"])
            out.append((conv, rng.choice([k, k, k, k // 2, None]), role, text))
    return out


@pytest.mark.parametrize("block_rows, longest", [(1024, 9), (3, 40), (1, 12)])
def test_against_recursion(spark, monkeypatch, block_rows, longest):
    monkeypatch.setattr(C, "BLOCK_ROWS", block_rows)
    rows = random_conversations(block_rows, 25, longest)
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA).repartition(5)
    found, got = repaired(df)
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = brute([r[1:] for r in rows if r[0] == conv])
    assert got == want
    lines = {}
    for r in C.repaired_rows(found.blocks).orderBy("part", "no", "place").collect():
        lines.setdefault(r["id"], []).append(f"{r.role}:{r.text}")
    for conv, w in want.items():
        assert hashlib.sha256("\n".join(lines.get(conv, [])).encode()).hexdigest() == w[-1]


def test_odd_rows(spark):
    long = "word " * 200000 + "end."
    rows = [(None, 0, "user", "Hi."), (None, 1, "assistant", "Hello."), (1, None, None, None), (1, 5, "user", "Same."), (1, 5, "user", "Same."),
            (1, 5, "user", "Same."), (2, 0, "user", long), (2, 1, "assistant", "Ok!")]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    _, got = repaired(df)
    assert got[None][6] == got[2][6] == "KK" and got[1][5] == 11  # three deleted, one kept, one inserted
    for conv in (None, 1, 2):
        assert got[conv] == brute([r[1:] for r in rows if r[0] == conv])
    assert got[1][0] == 0 and got[1][1:4] == (1, 2, 0)
    empty, none = repaired(df.limit(0))
    assert none == {} and C.repaired_rows(empty.blocks).count() == 0


def test_all_rows_of_a_conversation_lost(spark, tmp_path):
    """Every conversation comes back, also one whose rows are all dropped; SQL agrees."""
    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"Turn {t} of {i}.") for i in range(200) for t in range(i % 3 + 1)]
    rows += [(None, 0, "user", "Hm."), (7, None, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.op11_repair(spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(oracle.repair_sql())
    columns = sorted(got.columns)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    found = sorted((tuple(r) for r in got.select(*columns).collect()), key=key)
    assert found == sorted(want.select(*map(duckdb.ColumnExpression, columns)).fetchall(), key=key)
    assert len(found) == 201 and any(r[columns.index("audit")] == "" for r in found)


def test_shared_ends_are_one_node(monkeypatch):
    nodes, real = [], C.before

    def counting(symbol, after):
        nodes.append(symbol)
        return real(symbol, after)

    monkeypatch.setattr(C, "before", counting)
    ends = sorted(["ua", "sua", "Sua", "uaua", "suaua"], key=lambda s: s[::-1])
    list(C.solve(iter([pa.RecordBatch.from_pydict({"last": [True] * 5, "symbols": ends})])))
    # The ends: a, ua, sua, Sua, aua, uaua, suaua.
    assert len(nodes) == 7
