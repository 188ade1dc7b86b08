"""The registered queries against brute force on a small table."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from sentilake.llm import context_tree, decontamination, embedding_near_dups, language_id, near_duplicates, personal_data, queries, warc

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}


def run(name, spark, sf_dir, key):
    rows = queries.registry()[name](spark, sf_dir).collect()
    return {r[key]: r for r in rows}, rows


def words(text):
    return WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))


def test_context_tree_base(spark, sf_dir, texts):
    got, _ = run("op1_context_tree", spark, sf_dir, "doc_id")
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = collections.Counter(w for i, t in texts.items() if not held[i] for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        own = [*words(t), None]
        assert got[i].held_out == held[i] and got[i].n_tokens == len(own) and got[i].train_tokens == n
        assert got[i].n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(got[i].base_score, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)


def plain_tree_score(train, text, depth):
    """Context-tree weighting written as the recursion over contexts, node by node."""
    counts = collections.defaultdict(lambda: [0, 0])

    def steps(data):
        padded = bytes(depth) + data
        for k in range(depth, len(padded)):
            byte = padded[k]
            for bit in range(8):
                yield padded[k - depth : k], (1 << bit) | (byte >> (8 - bit)), (byte >> (7 - bit)) & 1

    children = collections.defaultdict(set)
    for data in train:
        for context, node, bit in steps(data):
            for d in range(depth + 1):
                counts[context[depth - d :], node][bit] += 1
                if d:
                    children[context[depth - d + 1 :], node].add(context[depth - d :])
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)
    cache = {}

    def weighted(context, node):
        if (context, node) not in cache:
            own = kt(*counts[context, node])
            if len(context) == depth:
                cache[context, node] = own
            else:
                below = sum(weighted(c, node) for c in children[context, node])
                cache[context, node] = math.log(0.5) + float(np.logaddexp(own, below))
        return cache[context, node]

    total = 0.0
    for context, node, bit in steps(text):
        p = 0.5
        for d in range(depth, -1, -1):
            key = context[depth - d :], node
            if key in counts:
                a, b = counts[key]
                own = ((b if bit else a) + 0.5) / (a + b + 1)
                w = 1.0 if d == depth else math.exp(math.log(0.5) + kt(a, b) - weighted(*key))
                p = w * own + (1 - w) * p
        total += math.log10(p)
    return total


def test_context_tree_scores(spark):
    rows = [(i, t) for i, t in enumerate(["abra cadabra", "Abra abba", "cad bra", "", "abracadabra dab", "zebra"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    scored, _ = context_tree.score_documents(docs, depth=3, part_bytes=8, table_size=20)
    data = {i: b" ".join(words(t)) + b"\0" for i, t in rows}
    train = [d for i, d in data.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    for r in scored.collect():
        assert math.isclose(r.score, plain_tree_score(train, data[r.id], 3), abs_tol=1e-4), r


def test_derivatives(spark, sf_dir):
    pages = {r.url: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    records = warc.responses_from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    _, rows = run("op2_derivatives", spark, sf_dir, "record_id")
    source = {r.record_id: r for r in records.collect()}
    assert collections.Counter(r.type for r in rows) == {"metadata": len(source), "conversion": len(source)}
    for r in rows:
        assert r.refers_to in source and r.target_uri == source[r.refers_to].target_uri and r.digest_fits
        assert r.block_digest == warc.digest(r.content.encode()) and r.content_length == len(r.content.encode())
        if r.type == "conversion":
            assert "<" not in r.content or "&lt" in pages[r.target_uri]
            assert "track(" not in r.content and "margin:0" not in r.content


def test_warc_files_round_trip(spark, tmp_path, sf_dir):
    derived = warc.derive(warc.responses_from_pages(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    for r in warc.volumes(derived.coalesce(2), volume_bytes=20000).collect():
        (tmp_path / r.name).write_bytes(r.content)
    back = warc.read_warc(spark, str(tmp_path))
    key = lambda df: sorted((r.record_id, r.type, r.target_uri, bytes(r.block)) for r in df.select("record_id", "type", "target_uri", "block").collect())
    assert key(back) == key(derived)


def test_shards(spark, sf_dir, texts):
    _, rows = run("op3_shards", spark, sf_dir, "doc_id")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert set(by) == set(range(24)) and all(sorted(v) == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    ids = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert abs(np.corrcoef(ids, np.arange(len(ids)))[0, 1]) < 0.3


def test_languages_held_out(spark, sf_dir):
    got, rows = run("op4_language", spark, sf_dir, "doc_id")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held) and sum(r.accepted for r in rows) >= 0.98 * len(rows)


def test_kneser_ney_probabilities_sum_to_one():
    table = language_id.folding()
    counts = {}
    for lang, text in (("a", "abc abd abc"), ("b", "xyz abx")):
        chars, starts = language_id.fold_texts([text], table)
        runs, n = np.unique(language_id.run_keys(chars, 4)[language_id.own_places(chars, starts)[0]], return_counts=True)
        counts[lang] = runs, n
    models = language_id.Models.restored(language_id.Models(counts).state())
    for context in ("ab", "qq", " x"):
        letters = " abcdxyz"
        total = sum(np.exp(models.score(np.array([32, *map(ord, context + c)], np.uint32), np.array([3]))[0]) for c in letters)
        assert np.allclose(total + np.exp(models.score(np.array([32, *map(ord, context + "q")], np.uint32), np.array([3]))[0]), 1, atol=0.05)


@pytest.mark.parametrize("width, spread, lists", [(4, 0.06, 24), (64, 0.1, 16), (768, 0.1, 12)])
def test_vectors_recall(spark, sf_dir, width, spread, lists):
    """Every link and class that all pairs give, at both ends, for vectors on both sides of the limit."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rng = np.random.default_rng(width)
    base = rng.normal(size=(40, width))
    near = [(10_000 + i, (b + spread * rng.normal(size=width) * s).tolist(), i % 4) for i, (b, s) in enumerate(
        (base[k % 40], 1 + k % 3 * 0.4) for k in range(900))]
    both = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label").union(
        spark.createDataFrame(near, "vec_id long, embedding array<double>, label int"))
    got = {r.id: r for r in embedding_near_dups.near_vectors(both, lists=lists, block=64).collect()}
    rows = [r for r in both.collect() if len(r.embedding) == width]
    x = np.array([r.embedding for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = (x @ x.T >= 0.98) & (np.array([r.label for r in rows])[:, None] == np.array([r.label for r in rows])[None])
    np.fill_diagonal(same, False)
    ids = np.array([r.vec_id for r in rows])
    low = ids.copy()
    while True:
        lower = np.minimum(low, np.where(same, low[None], low.max()).min(1))
        if (lower == low).all():
            break
        low = lower
    assert [(got[i].n_links, got[i].component_id) for i in ids.tolist()] == list(zip(same.sum(1).tolist(), low.tolist()))
    assert 100 < same.sum() and len(got) == both.count()


def test_token_counts(spark, sf_dir, texts):
    got, _ = run("op6_tokens", spark, sf_dir, "doc_id")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in texts.items():
        assert got[i].n_tokens == len(library.encode(t, add_special_tokens=False).ids) and got[i].n_bytes == len(t.encode())


def test_token_counts_of_odd_texts(spark):
    from sentilake.llm import token_counts

    odd = ["it's  we'LL don't '' 's's", "<|endoftext|> a<|startoftext|>b", "é É İ ﬁ ß", "x y\x1cz\x85", "日本語 ½²٣", "á 👍🏽", "1234 5,6-7", "", None]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for size in (1 << 16, 0):
        for r in token_counts.count_tokens(docs, tier_one=size, cache_size=4, one_in=1).collect():
            assert r.n_tokens == len(library.encode(r.text or "", add_special_tokens=False).ids), r


def test_edited_leaks(spark):
    rng = np.random.default_rng(1)
    vocabulary = ["w%d" % i for i in range(3000)]
    items = [(k, " ".join(rng.choice(vocabulary, 30))) for k in range(20)]
    docs = [(1000 + i, " ".join(rng.choice(vocabulary, 300))) for i in range(50)]
    for k, text in items:
        out = []
        for w in text.split():
            u = rng.random()
            out += [] if u < 0.04 else [w, "extra"] if u < 0.08 else ["other"] if u < 0.2 else [w.upper() + ","]
        docs.append((k, docs[k][1] + " " + " ".join(out) + " " + docs[k + 1][1]))
    found = decontamination.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.id, r.item_id) for r in found) == [(k, k) for k in range(20)]


def brute_spans(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        yield "email", *m.span()
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 13 <= len(digits(m[0])) <= 19 and personal_data.luhn(digits(m[0])):
            yield "card", *m.span()
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m[0])) <= 15:
            yield "phone", *m.span()


def test_personal_data(spark, sf_dir, texts):
    got, _ = run("op8_personal_data", spark, sf_dir, "doc_id")
    for i, t in texts.items():
        spans = [f"{k}:{a}:{b}" for k, a, b in brute_spans(t)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(got[i].spans.split(",")) | {""}
        assert [got[i][f"n_{k}"] for k in personal_data.KINDS] == [sum(s.startswith(k) for s in spans) for k in personal_data.KINDS]


def test_pattern_spans_of_random_strings():
    rng = np.random.default_rng(4)
    for _ in range(4000):
        text = "".join(rng.choice(list("ab1234.@+-() 9.@1"), int(rng.integers(1, 60))))
        assert personal_data.pattern_spans(text) == list(brute_spans(text)), text


def test_field_finds_what_patterns_miss_and_leaves_prose_alone(spark):
    docs = spark.createDataFrame([(1, "please call (212) 555-0147 or ring 0171 2345678 today"), (2, "version 3.0 of 2024-05-01 costs $12.50, see #12345"),
                                  (3, "no numbers here at all")], "doc_id long, text string")
    got = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r.spans] for r in personal_data.personal_data(docs).collect()}
    assert got == {1: [("phone", "(212) 555-0147"), ("phone", "0171 2345678")], 2: [], 3: []}


def test_field_gradient_free_check_of_viterbi():
    rng = np.random.default_rng(2)
    steps, start = personal_data.allowed()
    steps = steps + rng.normal(size=steps.shape)
    rows = [rng.normal(size=(n, len(personal_data.LABELS))) for n in (1, 2, 3)]
    import itertools

    for row, path in zip(rows, personal_data.viterbi(rows, steps, start)[0]):
        score = lambda p: start[p[0]] + sum(row[t][p[t]] for t in range(len(p))) + sum(steps[a, b] for a, b in zip(p, p[1:]))
        assert max(itertools.product(range(len(start)), repeat=len(row)), key=score) == tuple(path)


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def classes(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        for j, n in collections.Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in sets}


def test_near_duplicates(spark, sf_dir, texts):
    got, _ = run("op9_near_duplicates", spark, sf_dir, "doc_id")
    sets = {i: shingles(t) for i, t in texts.items()}
    wanted = classes(sets, 85)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), c, c == i) for i, c in wanted.items()}


def test_near_duplicates_of_one_large_group(spark):
    rng = np.random.default_rng(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(int(rng.integers(0, 7))):
            w[int(rng.integers(120))] = f"x{int(rng.integers(50))}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = classes({i: shingles(t) for i, t in rows}, 85)
    assert {r.id: r.component_id for r in near_duplicates.near_duplicates(docs, percent=85).collect()} == wanted


def test_mix(spark, sf_dir, texts):
    got, rows = run("op10_mix", spark, sf_dir, "doc_id")
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    size = {i: len(words(t)) for i, t in texts.items()}
    total = collections.Counter()
    for i, n in size.items():
        total[source[i]] += n
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(total))}
    target, open_ = {}, set(total)
    budget = 1.5 * sum(total.values())
    while True:
        left = budget - sum(2 * total[s] for s in set(total) - open_)
        target = {s: left * weight[s] / sum(weight[x] for x in open_) if s in open_ else 2.0 * total[s] for s in total}
        over = {s for s in open_ if target[s] > 2 * total[s]}
        if not over:
            break
        open_ -= over
    taken = collections.Counter()
    for i, r in got.items():
        assert r["size"] == size[i] and r.source_size == total[source[i]] and math.isclose(r.target, target[source[i]])
        assert r.taken in (0, size[i], 2 * size[i])
        taken[source[i]] += r.taken
    largest = {s: max(size[i] for i in size if source[i] == s) for s in total}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in total)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.registry()["op10_mix"](spark, sf_dir).collect()))


def test_pipeline(spark, sf_dir, texts):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = table.columns
    docs = corpus_pipeline.languages(spark, table, sf_dir)
    assert docs.columns == columns and docs.count() >= 0.98 * len(texts)
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, table, sf_dir).collect()}
    assert kept == {i for i, c in classes({i: shingles(t) for i, t in texts.items()}, 80).items() if i == c}
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaks = {i for i, t in texts.items() if any(x in t for x in items)}
    clean = {r.doc_id for r in corpus_pipeline.decontaminate(spark, table, sf_dir).collect()}
    assert leaks and not clean & leaks and len(clean) >= len(texts) - len(leaks) - 2
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == [*columns, "size", "shard", "slot"]
    found = rows.select("doc_id", "shard", "slot").collect()
    assert {r.doc_id for r in found} <= kept & clean and max(collections.Counter(r.doc_id for r in found).values()) <= 2
    per = collections.Counter(r.shard for r in found)
    assert max(per.values()) - min(per.values()) <= 1 and len(set((r.shard, r.slot) for r in found)) == len(found)


def test_tokens_are_encoded_in_portions():
    from sentilake.llm.token_counts import portions

    texts = ["a" * 10, "", "b" * 50, "c", "d" * 3]
    assert list(portions(texts, 20)) == [["a" * 10, "", "b" * 50], ["c", "d" * 3]] and list(portions([], 20)) == []
    assert [len(p) for p in portions(["x" * 1000] * 100, 10_000)] == [10] * 10


def test_token_counts_send_a_kept_text_once(spark):
    """Texts across slices and portions; the kept text is the only text column that goes to Python."""
    from tokenizers import Tokenizer
    import public_tokenizers
    from sentilake.llm import token_counts

    texts = [None, "", "Ünïcode ½ ｶﾞ", "日本語 " * 30] + [f"Word{i} is, of course, {'longer ' * (i % 40)}!" for i in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    found = token_counts.count_tokens(docs, one_in=4)
    assert token_counts.OWN + "text" not in found._jdf.queryExecution().optimizedPlan().toString()
    library = Tokenizer.from_file(str(public_tokenizers.path(token_counts.VOCABULARY)))
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert [r["n_tokens"] for r in found.orderBy("doc_id").collect()] == want
    other = token_counts.count_tokens(docs.withColumnRenamed("text", "n_tokens"), text="n_tokens", one_in=4)
    assert other.columns == ["doc_id", "n_bytes", "n_tokens"] and [r["n_tokens"] for r in other.orderBy("doc_id").collect()] == want


def test_vectors_are_written_once_whatever_lists_they_go_to(spark, monkeypatch):
    import numpy as np
    from sentilake.llm import embedding_near_dups as E

    x = np.random.default_rng(0).normal(size=(300, 16))
    rows = [(i, [float(f) for f in v], 1) for i, v in enumerate(x)] + [(300, [float(f) * 3 for f in x[0]], 1)]
    table, written, real = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), {}, E.materialize

    def materialize(df, name):
        made = real(df, name)
        written[name] = made.count() if "v" in made.columns else 0
        return made

    monkeypatch.setattr(E, "materialize", materialize)
    links = {r["id"]: r["n_links"] for r in E.near_vectors(table, lists=8).collect()}
    assert {i for i, n in links.items() if n} == {0, 300} and max(written.values()) == 301


def test_vectors_go_to_their_lists_in_short(spark, monkeypatch):
    from sentilake.llm import embedding_near_dups as E

    x = np.random.default_rng(0).normal(size=(300, 16))
    rows = [(i, [float(f) for f in v], 1) for i, v in enumerate(x)] + [(300, [float(f) * 3 for f in x[0]], 1)]
    plans, real = [], E.materialize

    def materialize(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(E, "materialize", materialize)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    links = {r["id"]: r["n_links"] for r in E.near_vectors(table, lists=8).collect()}
    compared = [line for plan in plans for line in plan.splitlines() if "FlatMapGroupsInArrow" in line]
    assert compared and not any(re.search(r"\bv#", line) for line in compared)
    assert {i for i, n in links.items() if n} == {0, 300}


@pytest.mark.parametrize("kind", ["array<double>", "array<float>"])
def test_vectors_about_the_limit(spark, monkeypatch, kind):
    """Pairs too close to the limit for short vectors are decided in full, over several lists and blocks."""
    from sentilake.llm import embedding_near_dups as E

    rng, width = np.random.default_rng(5), 24
    made = []
    for _ in range(30):
        b, o = np.linalg.qr(rng.normal(size=(width, 2)))[0].T
        made.append(b)
        for by in (0, 1e-10, -1e-10, 1e-8, -1e-8, 1e-6, -1e-6, 1e-3, -1e-3):
            c = 0.98 + by if by else 1.0
            made.append((c * b + np.sqrt(1 - c * c) * o) * rng.uniform(1e-3, 1e3))
    rows = [(i, v.tolist(), i % 2) for i, v in enumerate(made)] + [(1000 + i, v.tolist(), i % 2) for i, v in enumerate(made[::3])]
    undecided, real = [], E.materialize

    def materialize(df, name):
        found = real(df, name)
        undecided.append(found.where("partners is null").count() if name == "pq_blocks" else 0)
        return found

    monkeypatch.setattr(E, "materialize", materialize)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("embedding", F.col("embedding").cast(kind))
    got = {r.id: (r.n_links, r.component_id) for r in E.near_vectors(table, lists=6, block=16).collect()}
    rows = table.collect()
    x = E.unit(np.array([r.embedding for r in rows], np.float64))
    ids, labels = (np.array([r[k] for r in rows]) for k in (0, 2))
    same = ((x[:, None] * x[None]).sum(2) >= 0.98) & (labels[:, None] == labels[None]) & (ids[:, None] != ids[None])
    low = ids.copy()
    while True:
        lower = np.minimum(low, np.where(same, low[None], low.max()).min(1))
        if (lower == low).all():
            break
        low = lower
    assert got == {i: (n, c) for i, n, c in zip(ids.tolist(), same.sum(1).tolist(), low.tolist())}
    assert sum(undecided) > 50 and 0 < same.sum()


def test_vectors_within_the_radius_share_the_list_nearest_to_their_middle():
    from sentilake.llm import embedding_near_dups as E

    rng = np.random.default_rng(6)
    for width in (3, 20):
        x = E.unit(rng.normal(size=(4000, width)))
        y = E.unit(x + rng.normal(size=x.shape) * 0.08 / np.sqrt(width))
        coarse = np.concatenate([E.unit(rng.normal(size=(60, width))) * 0.5, np.zeros((2, width))])
        coarse = np.concatenate([coarse, coarse[:3], coarse[:3] + 1e-9])
        lists = E.Quantiser(coarse, [])
        for reach in (0.05, 0.1):
            near = np.flatnonzero(np.sqrt(((x - y) ** 2).sum(1)) <= 2 * reach)
            middle = E.nearest((x + y)[near] / 2, coarse)
            assert len(near) > 100 and all(lists.probes(v, reach)[near, middle].all() for v in (x, y))
