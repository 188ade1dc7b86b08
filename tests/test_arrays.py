import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from sentilake.plans.runs import build_dataset
from sentilake.sources import archives as RA, arrays, stores as R


@pytest.fixture
def small_splits(spark, monkeypatch):
    """Many blocks a file and many chunks a block."""
    monkeypatch.setattr(arrays, "CHUNK", 60)
    for name, value in (("maxPartitionBytes", "700"), ("openCostInBytes", "1"), ("minPartitionNum", "64")):
        spark.conf.set(f"spark.sql.files.{name}", value)
    yield
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def value(rng, depth=0):
    kind = rng.randrange(8 if depth < 3 else 5)
    if kind < 3:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", " ", "a", "é", "\n", "😀", ":"]) for _ in range(rng.randrange(12)))
    if kind < 5:
        return rng.choice([None, True, 3, -1.5, "x" * rng.randrange(300)])
    if kind < 6:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(4))}


def documents(seed):
    rng = random.Random(seed)
    docs = {"empty": "[]", "spaces": " [ \n ] ", "nothing": "", "blank": "  ", "number": "5", "object": json.dumps({"a": "}" * 900}),
            "data": json.dumps({"data": [value(rng) for _ in range(30)]}), "one": json.dumps([{"a": "b" * 2500}]), "brace": '{"a": {"b": {}}}'}
    for i in range(6):
        docs[f"list{i}"] = json.dumps([value(rng) for _ in range(40)], indent=rng.choice([None, 1]), ensure_ascii=rng.choice([True, False]))
    for i in range(12):
        text = json.dumps([value(rng) for _ in range(8)])
        at = rng.randrange(len(text))
        docs[f"broken{i}"] = rng.choice([text[:at], text[:at] + text[at + 1 :], text[:at] + rng.choice('",]}[{\\x') + text[at:], text + text, text + "x", "," + text])
    docs |= {"commas": "[1,,2]", "trailing": "[1,2,]", "leading": "[,1]", "mixed": "[1}", "swapped": '[{"a": [1}, 2]]', "cut": '[{"a": 1}, {"a": 1'}
    return docs


def rows(df):
    found = df.select(F.regexp_extract("file_path", "([a-z0-9]+)[.]json$", 1), "failed", F.to_json(F.col("record")))
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_split_reading_equals_whole_reading(spark, tmp_path, small_splits, seed):
    docs = documents(seed)
    for name, text in docs.items():
        (tmp_path / f"{name}.json").write_text(text)
    whole = rows(RA.read_records(spark, str(tmp_path)))
    assert rows(RA.read_records(spark, str(tmp_path), split_bytes=1)) == whole
    failed = {r[0] for r in whole if r[1]}
    for name, text in docs.items():
        try:
            ok = isinstance(json.loads(text), (list, dict))
        except ValueError:
            ok = False
        assert ok or name in failed or not text, name
    assert {"commas", "trailing", "leading", "mixed", "swapped", "cut", "number"} <= failed and not failed & {"empty", "spaces", "brace", "object"}


def test_one_array_is_read_by_many_tasks(spark, tmp_path, small_splits):
    records = [{"id": str(i), "text": f"a }} \"quoted\\\" [{i}" * 3} for i in range(400)]
    (tmp_path / "all.json").write_text(json.dumps(records))
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert pieces.select(F.spark_partition_id()).distinct().count() > 20
    found = RA.read_records(spark, str(tmp_path), split_bytes=1)
    got = sorted((json.loads(r[0]) for r in found.select(F.to_json("record")).collect()), key=lambda r: int(r["id"]))
    assert got == records


def test_compressed_files_are_read_whole(spark, tmp_path, small_splits):
    with gzip.open(tmp_path / "all.json.gz", "wt") as f:
        f.write(json.dumps([{"id": str(i)} for i in range(500)]))
    assert RA.read_records(spark, str(tmp_path), split_bytes=1).where("not failed").count() == 500


def test_dataset_build_over_a_large_array(spark, tmp_path, small_splits):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "big.json").write_text(json.dumps([{"id": str(i % 90), "text": "t" * 20, "score": i} for i in range(100)] + [7, {"text": "no id"}]))
    (tmp_path / "in" / "bad.json").write_text('[{"id": "x"}, {"id"' + " " * 100)
    (tmp_path / "in" / "small.json").write_text('{"id": "s"}')
    report = build_dataset(spark, str(tmp_path / "in"), str(tmp_path / "set"), "r1", split_bytes=50).first()
    assert (report.archives, report.failed, report.records, report.non_objects, report.quarantined, report.published, report["copies"]) == (3, 1, 103, 1, 1, 91, 10)
    assert {r.post_id for r in R.read_dataset(spark, str(tmp_path / "set"), "r1").collect()} == {*map(str, range(90)), "s"}


def test_effects_add_up():
    text = b'[{"a": "x}{\\"", "b": [1, 2]}, "}}", {"c": {}}]'
    for at in range(1, len(text)):
        if text[at - 1 : at] == b"}":
            assert arrays.after(arrays.effect(text[:at]), arrays.effect(text[at:])) == arrays.effect(text)
