"""Nothing is lost: broken archives, shared ids, short test items; and what hot keys must not do."""

import gzip
import random
import time

import numpy as np
from pyspark.sql import functions as F

from sentilake.llm import decontamination as D, language_id, near_duplicates, personal_data, sharding, warc


def record(i, body=b"some body"):
    return warc.to_bytes([("WARC-Type", "response"), ("WARC-Record-ID", f"<r{i}>"), ("Content-Length", str(len(body)))], body)


def test_records_after_a_broken_one():
    bad = record(2).replace(b"Content-Length: 9", b"Content-Length: x")
    rows = list(warc.parse(record(1) + bad + record(3)))
    assert [r[0] for r in rows] == ["<r1>", None, "<r3>"] and rows[1][1] == warc.BROKEN and b"<r2>" in rows[1][5]
    cut = list(warc.parse(record(1) + record(2)[:-20]))
    assert [r[1] for r in cut] == ["response", warc.BROKEN]
    noise = list(warc.parse(b"noise\r\n" + record(1) + b"WARC/9 no end"))
    assert [r[1] for r in noise] == [warc.BROKEN, "response", warc.BROKEN]
    inside = list(warc.parse(record(1, b"a\nWARC/1.1\r\nfoo: x\r\n\r\nbar") + record(2)))
    assert [r[0] for r in inside] == ["<r1>", "<r2>"]


def test_members_after_a_damaged_one():
    members = [gzip.compress(record(i), mtime=0) for i in range(5)]
    members[2] = members[2][:15] + bytes([members[2][15] ^ 255, members[2][16] ^ 255]) + members[2][17:]
    rows = list(warc.parse(b"".join(members)))
    assert [r[0] for r in rows if r[1] != warc.BROKEN] == ["<r0>", "<r1>", "<r3>", "<r4>"] and sum(r[1] == warc.BROKEN for r in rows) >= 1
    assert [r[0] for r in warc.parse(gzip.compress(record(0) + record(1)))] == ["<r0>", "<r1>"]
    padded = list(warc.parse(members[0] + b"\0" * 9 + members[1]))
    assert [r[0] for r in padded if r[1] != warc.BROKEN] == ["<r0>", "<r1>"]
    assert list(warc.parse(b"")) == []


def test_many_members_take_linear_time():
    def seconds(n):
        data = b"".join(gzip.compress(record(i, random.Random(i).randbytes(4000)), mtime=0) for i in range(n))
        start = time.perf_counter()
        assert len(list(warc.parse(data))) == n
        return time.perf_counter() - start

    seconds(200)
    assert seconds(4000) < 30 * max(seconds(400), 0.01)


def test_derived_records_name_each_other(spark):
    pages = spark.createDataFrame([("http://h/a", "<!-- " + "x" * 2000 + " --><html><body>text")], "url string, html string")
    rows = {r.type: r for r in warc.derive(warc.responses_from_pages(pages)).collect()}
    head = {t: {h.name: h.value for h in r.headers} for t, r in rows.items()}
    assert head["metadata"]["WARC-Concurrent-To"] == rows["conversion"].record_id
    assert head["conversion"]["WARC-Concurrent-To"] == rows["metadata"].record_id
    assert head["conversion"]["WARC-Source-Payload-Digest"] == rows["metadata"].source_digest
    untyped = warc.derive_one("<r>", "http://h", None, [], b"HTTP/1.1 200 OK\r\n\r\n<!-- " + b"x" * 2000 + b" -->\n<HTML><p>Words")
    assert [r[1] for r in untyped] == ["metadata", "conversion"] and untyped[1][5] == b"Words"


def test_documents_that_share_an_id(spark):
    prose = "the old river runs slowly past the quiet town and its grey stone bridge every single day"
    rows = [("1", "first text about a quite different matter than all others here", 1), ("1", "another story of wind and snow on the high hills far away", 2),
            ("2", prose, 3), ("2", prose, 4), (None, prose + " again", 5), (None, "words nobody else has ever put in this order before now", 6),
            (None, None, 7), (None, None, 8), ("x", "", 9)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, place int").repartition(3)
    kept = [r.place for r in near_duplicates.keep_one(docs).collect()]
    assert sorted(kept)[:2] == [1, 2] and len({3, 4} & set(kept)) == 1 and 5 not in kept and {6, 7, 8, 9} <= set(kept) and len(kept) == 7
    found = near_duplicates.near_duplicates(docs).collect()
    assert sum(r.copies for r in found) == len(rows)
    assert {r.component_id for r in found if r.id is None and r.n_shingles == 14} == {"2"}


def whole_alignment(items, numbers, share=0.4, least=8):
    return {i for i, w in enumerate(items.words) if len(w) >= D.GRAM
            and D.align(w, numbers)[0] >= max(share * len(w), min(least, len(w)))}


def test_every_copy_that_whole_alignment_finds(spark):
    """Items of 3 to 100 words, a word in ten to a word in three changed, left out or put in."""
    rng = random.Random(2)
    vocabulary = [f"w{k}" for k in range(400)]
    sizes = [3, 4, 5, 8, 10, 12, 16, 20, 30, 48, 60, 100]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in sizes for _ in range(6)]
    docs = []
    for i, t in enumerate(texts):
        for rate in (0.1, 0.2, 0.33):
            out = []
            for w in t.split():
                kind = rng.random()
                if kind >= rate:
                    out.append(w)
                elif kind < rate * 0.6:
                    out.append(rng.choice(vocabulary))
                elif kind < rate * 0.8:
                    out += [w, rng.choice(vocabulary)]
            noise = lambda: [rng.choice(vocabulary) for _ in range(40)]
            docs.append((len(docs), " ".join(noise() + out + noise())))
    items = D.Items(list(range(len(texts))), texts)
    want = {(d, i) for d, t in docs for i in whole_alignment(items, items.number(t))}
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    got = {(r.id, r.item_id) for r in D.leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got <= want and len(got) >= 0.99 * len(want) and len(want) > 120, (len(got), len(want))


def plain_kneser_ney(runs, n, run, letters):
    """Interpolated Kneser-Ney of one language, from its runs of four characters."""
    tables = {4: dict(zip(runs, n))}
    for k in (3, 2, 1):
        tables[k] = {}
        for r in tables[k + 1]:
            tables[k][r[1:]] = tables[k].get(r[1:], 0) + 1

    def p(r):
        if not r:
            return 1 / (letters + 1)
        table = tables[len(r)]
        once, twice = (sum(c == x for c in table.values()) for x in (1, 2))
        d = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
        own = {x: c for x, c in table.items() if x[:-1] == r[:-1]}
        if not own:
            return p(r[1:])
        total = sum(own.values())
        return max(own.get(r, 0) - d, 0) / total + d * len(own) / total * p(r[1:])

    return p(run)


def test_language_models_by_definition():
    pack = lambda r: sum(ord(c) << (16 * (len(r) - 1 - k)) for k, c in enumerate(r))
    by = {"en": {"   t": 3, "  th": 2, " the": 2, "  ta": 1, "the ": 2}, "fr": {"   l": 4, "  le": 3, " les": 1, "   t": 1}}
    models = language_id.Models({x: (np.array(sorted(map(pack, c)), np.uint64), np.array([n for _, n in sorted((pack(r), n) for r, n in c.items())])) for x, c in by.items()})
    letters = len({r[-1] for c in by.values() for r in c})
    own = language_id.Models.restored(models.state())
    for run in ["   t", "  th", " the", "  le", " tha", "zzzz", "  lt", "he t"]:
        chars = np.array([ord(c) for c in run], np.uint32)
        got = own.score(chars, np.array([3]))[0]
        want = [np.log(plain_kneser_ney(list(c), list(c.values()), run, letters)) for c in by.values()]
        assert np.allclose(got, want, rtol=1e-4), run


def test_combining_marks_stay_with_their_letters():
    table = language_id.folding()
    chars, starts = language_id.fold_texts(["हिन्दी में", "́ á́b ्", ""], table)
    texts = ["".join(map(chr, chars[a + 3 : b])) for a, b in zip(starts, starts[1:])]
    assert texts[0] == "हिन्दी में" and texts[1].strip() == "á́b" and texts[2] == ""


def test_no_text_is_shuffled_to_learn_languages(spark, sf_dir, monkeypatch):
    plans = []
    monkeypatch.setattr(language_id, "counts_of_runs", lambda rows: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or {})
    language_id.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert "hashpartitioning" not in plans[0]


def test_rows_without_id_and_text_are_scattered(spark):
    docs = spark.range(4000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), F.col("id").alias("n"))
    out = sharding.external_shuffle(docs, 4, bucket_bytes=800)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.count() == 4000 and (len(per_task) == 1 or max(per_task) < 3000)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_long_runs_are_decoded_within_bounds(monkeypatch):
    sizes = []
    real = personal_data.viterbi
    monkeypatch.setattr(personal_data, "viterbi", lambda rows, *a: sizes.append(len(rows) * max(map(len, rows))) or real(rows, *a))
    field = personal_data.train(list(personal_data.training_rows(personal_data.labelled_table())), rounds=2)
    texts = ["1 2 3 " * 9000, *["call 555 0100 now"] * 600]
    personal_data.field_spans(texts, field, 1.5)
    assert max(sizes) <= max(personal_data.CELLS, 27000) and len(sizes) >= 3
    assert personal_data.shape("a" * 100 + "1") == "aa9"
