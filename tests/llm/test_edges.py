"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sentilake.llm import context_tree, decontamination, embedding_near_dups, language_id, mixing, near_duplicates
from sentilake.llm import personal_data, sharding, token_counts, warc

PROSE = "the old river runs slowly past the quiet town and its grey stone bridge every single day"
SCHEMA = "doc_id long, text string, lang string, source string, size int, N_TOKENS string, spans string, shard string, score string, copies int"
ROWS = [
    (1, PROSE, "en"), (2, PROSE, "en"), (2, PROSE, "en"), (3, None, "en"), (4, "", "en"), (5, " \n\t ", None), (6, "one", "en"),
    (7, "der alte fluss fliesst langsam an der stillen stadt vorbei", "de"), (None, PROSE + " again", "en"), (None, None, None),
    (8, "word " * 40000, "en"), (9, "12 ?! 34", None), (10, "привет мир", "ru"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, lang, None if i in (3, 5) else f"s{(i or 0) % 3}", 1, "x", "x", "x", "x", 1) for i, t, lang in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def lower(df):
    return [c.lower() for c in df.columns]


def test_token_counts(docs, empty):
    out = token_counts.count_tokens(docs)
    assert lower(out).count("n_tokens") == 1
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in out.collect()}
    assert got[3] == got[4] == (0, 0) and got[5] == (4, 0) and got[8] == (200000, 40000)
    assert token_counts.count_tokens(empty).count() == 0


def test_language(docs, empty):
    models = language_id.train(docs)
    assert models.langs == ["de", "en", "ru"]
    out = language_id.identify(docs, models)
    assert lower(out).count("score") == 1 and out.count() == len(ROWS)
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 and not got[i].accepted for i in (3, 4, 5, 9))
    assert got[7].lang_pred == "de" and got[10].lang_pred == "ru" and all(0 <= r.score <= 1 for r in got.values())
    nothing = language_id.train(empty)
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(empty, models).count() == 0


def test_personal_data(docs, empty):
    out = personal_data.personal_data(docs)
    assert lower(out).count("spans") == 1 and out.count() == len(ROWS)
    assert all(r.spans == [] for r in out.collect())
    assert personal_data.personal_data(empty).count() == 0


def test_near_duplicates(docs, empty):
    got = {r.id: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(docs).collect()}
    assert got[1][1] == got[2][1] == 1 and got[1][0] == 13
    assert got[3] == (0, 3) and got[4] == (0, 4) and got[5] == (0, 5) and got[6] == (1, 6) and got[8] == (1, 8)
    kept = [r.doc_id for r in near_duplicates.keep_one(docs).select("doc_id").collect()]
    # The row without an id but with a near copy of text 1 goes, the one without a text stays.
    assert sorted(x for x in kept if x is not None) == [1, 3, 4, 5, 6, 7, 8, 9, 10] and kept.count(None) == 1
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_leaks(docs, empty, spark):
    items = spark.createDataFrame([(1, PROSE), (2, None), (3, ""), (4, "too short"), (5, PROSE)], "item_id long, text string")
    found = [(r.id, r.item_id) for r in decontamination.leaks(docs, items).collect()]
    assert sorted(found, key=str) == sorted([(i, k) for i in (1, 2, 2, None) for k in (1, 5)], key=str)
    assert decontamination.clean(docs, items).columns == docs.columns
    assert decontamination.clean(docs, items).count() == len(ROWS) - 4
    assert decontamination.leaks(empty, items).count() == 0
    assert decontamination.leaks(docs, items.limit(0)).count() == 0


def test_shards(docs, empty):
    out = sharding.external_shuffle(docs, 4, bucket_bytes=4096)
    assert lower(out).count("shard") == 1 and lower(out).count("size") == 1
    rows = out.select("doc_id", "shard", "slot", "size").collect()
    by = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(4)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(rows) == len(ROWS)
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, sharding.external_shuffle(
        docs.repartition(5), 4, bucket_bytes=4096).select("doc_id", "shard", "slot", "size").collect()), key=str)
    assert sharding.external_shuffle(empty, 4).count() == 0


def test_mix(docs, empty):
    out = mixing.fair_queue(docs, rows_per_block=2)
    assert lower(out).count("size") == 1 and lower(out).count("copies") == 1 and out.count() == len(ROWS)
    assert all(0 <= r["copies"] <= 2 for r in out.collect())
    mixed = mixing.mix(docs).collect()
    assert [r.virtual_finish for r in mixed] == sorted(r.virtual_finish for r in mixed)
    assert mixing.fair_queue(empty).count() == 0 and mixing.mix(empty).count() == 0


def test_context_tree(docs, empty):
    scored, values = context_tree.score_documents(docs)
    got = {r.id: r for r in context_tree.base_scores(scored, values).collect()}
    assert got[3].n_tokens == got[4].n_tokens == got[5].n_tokens == 1 and got[8].n_tokens == 40001
    assert all(r.score < 0 for r in got.values()) and scored.count() == len(ROWS)
    scored, values = context_tree.score_documents(empty)
    assert context_tree.base_scores(scored, values).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.001], 0), (4, [1.0, 0.0], 1), (5, [1.0, 0.0], None), (6, None, 0),
            (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (11, [], 0), (12, [1.0, 0.0, 0.0], 0),
            (2, [2.0, 0.0], 0), (None, [1.0, 0.0], 0), (13, [1e-300, 0.0], 0), (14, [-1.0, 0.0], 0)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, n_links string")
    got = [(r.id, r.n_links, r.component_id) for r in embedding_near_dups.near_vectors(table).collect()]
    assert Counter(got) == Counter([(i, 5, 1) for i in (1, 2, 2, 3, 13, None)] + [(i, 0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 14)])
    nameless = table.where("vec_id is null").union(table.where("vec_id is null")).union(table.where("vec_id = 14"))
    got = [(r.id, r.n_links, r.component_id) for r in embedding_near_dups.near_vectors(nameless).collect()]
    assert Counter(got) == Counter([(None, 1, None), (None, 1, None), (14, 0, 14)])
    assert embedding_near_dups.near_vectors(table.limit(0)).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([("http://h/a", "<p>x", 1), (None, "<b>y</b>", 2), ("http://h/b", None, 3), ("http://h/c", "", 4),
                                   ("http://h/a", "<p>x", 1)], "url string, html string, block int")
    out = warc.derive(warc.responses_from_pages(pages))
    kinds = {r[0]: r[1] for r in out.groupBy("type").agg(F.count("*")).collect()}
    assert kinds == {"metadata": 5, "conversion": 4}
    assert warc.derive(warc.responses_from_pages(pages.limit(0))).count() == 0
