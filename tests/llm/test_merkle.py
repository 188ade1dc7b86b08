"""The Merkle manifest against plain lists."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from sentilake.llm import merkle, oracle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos int, path string, key string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text=...):
    cells = [*row[:4], row[4] if text is ... else text]
    return H(*["-" if c is None else f"{len(str(c).encode())}:{c}" for c in cells])


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def climb(levels, p, node):
    proof = []
    for level in levels[:-1]:
        run = p // 16 * 16
        left, right = level[run:p], level[p + 1 : run + 16]
        proof += left + right
        node, p = H(*left, node, *right), p // 16
    return proof, node


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for p, r in enumerate(by[s]):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            changed = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])) if tampered else leaf(r)
            proof, node = climb(trees[s], p, changed)
            above, root = climb(top, k, node)
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], H(*proof, *above), root, root == top[-1][0]))
    return sorted(out, key=str)


def rows_of(sizes):
    rng = random.Random(3)
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            text = rng.choice([None, "", "Große Worte", "plain", f"Row {n} ÄÖ", "X" * 5000])
            rows.append((rng.choice([n, n, n, None]), source, rng.choice(["en", None]), rng.choice([len(text or ""), None]), text))
            n += 1
    return rows + rows[:5]


@pytest.mark.parametrize("sizes", [
    {None: 3, "": 1, "a": 16, "b": 17, "Z": 1, "é": 40, "big": 600}, {f"s{k}": 1 + k % 3 for k in range(300)}, {"only": 1}, {"x": 33}])
def test_against_lists(spark, tmp_path, monkeypatch, sizes):
    monkeypatch.setattr(merkle, "STRETCH", 64)
    rows = rows_of(sizes)
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_merkle(spark, str(tmp_path))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.sql(oracle.merkle_sql(4)).select(*map(duckdb.ColumnExpression, got.columns))
    assert sorted(sql.fetchall(), key=str) == brute(rows)


def test_empty_and_unaltered(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(df).count() == 0
    one = spark.createDataFrame([(1, "s", None, 2, "Ab", 1, "x", "y")], SCHEMA)
    r = merkle.manifest(one).collect()[0]
    assert r.leaf == r.subroot == r.root == leaf((1, "s", None, 2, "Ab")) and r.path == [] and r.changed is None


def test_no_window_holds_a_source(spark, sf_dir):
    nodes = spark.range(100).select((F.col("id") % 3).cast("string").alias("key"), F.col("id").alias("pos"), F.lit(100).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    plan = merkle.siblings(nodes)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "SinglePartition" not in plan
