"""Dedup, decontamination, mixing, sharding, templates, fingerprints and the pipeline."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from review_engine.llm import decontaminate, fingerprints, line_templates, mixing, order_minhash, sharding
from review_engine.llm.components import components


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def changed(rng, text, n):
    out = text.split(" ")
    for _ in range(n):
        out[rng.randrange(len(out))] = words(rng, 1)
    return " ".join(out)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(4)
    rows = []
    for g in range(12):
        base = words(rng, rng.randint(60, 300))
        rows += [base, base, *[changed(rng, base, k) for k in (1, 2, 4, 9)]]
    rows += [words(rng, n) for n in (1, 2, 5, 40, 200)] + ["", "..."]
    return [(i, t, "en", "s") for i, t in enumerate(rows)]


def brute_classes(rows):
    sets = {}
    for i, t, _, _ in rows:
        w = t.split()
        runs = ["|".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w and t != "..." else []
        sets[i] = collections.Counter(runs)
    name = {i: i for i in sets}

    def find(i):
        return i if name[i] == i else find(name[i])

    for a in sets:
        for b in sets:
            shared = sum((sets[a] & sets[b]).values())
            total = sum((sets[a] | sets[b]).values())
            if a < b and ((total and shared >= 0.8 * total) or rows[a][1] == rows[b][1]):
                x, y = sorted((find(a), find(b)))
                name[y] = x
    return {i: find(i) for i in sets}


def test_near_duplicates_equal_brute_force(small, copies, monkeypatch):
    expected = brute_classes(copies)
    for few in (order_minhash.FEW, 1):  # in the second run every bucket is compared in blocks
        monkeypatch.setattr(order_minhash, "FEW", few)
        found = order_minhash.near_duplicates(small(copies))
        assert {r.doc_id: r.class_id for r in found.collect()} == expected
    kept = order_minhash.one_of_each(found)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_blocks_find_links_between_blocks(small, copies, spark, monkeypatch):
    monkeypatch.setattr(order_minhash, "BLOCK", 4)
    texts = spark.createDataFrame([(i, t) for i, t, _, _ in copies[:12]], "node bigint, text string")
    members = texts.select(F.lit(1).alias("bucket"), F.lit(12).alias("n"), F.struct(
        "node", F.lit(1).alias("length"), F.col("node").alias("component")).alias("me"))
    links = {(r.a, r.b) for r in order_minhash._links_in_blocks(members, texts, 0.8).collect()}
    expected = brute_classes(copies[:12])
    joined = {r.node: r.component for r in components(order_minhash._links_in_blocks(members, texts, 0.8)).collect()}
    assert links and all(joined.get(i, i) == c for i, c in expected.items())


@pytest.mark.parametrize("n", [200, 400])
def test_links_of_a_large_group_are_fewer_than_its_members(spark, n):
    """Alike texts in two components: a task joins the two once, and no more."""
    rng = random.Random(n)
    base = words(rng, 120)
    texts = spark.createDataFrame([(i, changed(rng, base, 1)) for i in range(n)], "node bigint, text string")
    me = F.struct("node", F.lit(1).alias("length"), (F.col("node") % 2).alias("component"))
    links = order_minhash._links_in_blocks(texts.select(F.lit(1).alias("bucket"), F.lit(n).alias("n"), me.alias("me")), texts, 0.8).collect()
    assert 0 < len(links) <= 3 and all(a % 2 != b % 2 for a, b in links)

    prints = [fingerprints.as_text(x) for x in fingerprints.embed([r.text for r in texts.orderBy("node").collect()])]
    classes = spark.createDataFrame([(i, p) for i, p in enumerate(prints)], "id bigint, fingerprint string")
    members = classes.select(F.lit(1).alias("band"), F.lit(n).alias("n"), "id", (F.col("id") % 2).alias("component"))
    links = fingerprints._links_in_blocks(members, classes, 0.8).collect()
    assert 0 < len(links) <= 3 and all(r.left % 2 != r.right % 2 for r in links)


def test_links_of_near_copies_grow_with_them(spark, small):
    rng = random.Random(8)
    base = words(rng, 400)
    docs = small([(i, changed(rng, base, 1), "en", "s") for i in range(300)])
    marked = fingerprints.fingerprints(docs)
    links = fingerprints.near_duplicates(marked)
    joined = {r.node: r.component for r in components(links.selectExpr("left AS a", "right AS b")).collect()}
    prints = fingerprints.embed([r.text for r in docs.orderBy("doc_id").collect()])
    alike = [(i, int(j)) for i in range(300) for j in np.flatnonzero(fingerprints.likeness(prints[i], prints) >= 0.8) if i < j]
    every = {r.node: r.component for r in components(spark.createDataFrame(alike, "a bigint, b bigint")).collect()}
    stands = {i: int(np.flatnonzero((prints == prints[i]).all(axis=1))[0]) for i in every}  # equal fingerprints are one node
    assert joined == {i: c for i, c in every.items() if stands[i] == i} and len(alike) > 20_000 and links.count() < 3 * 300
    assert {r.class_id for r in order_minhash.near_duplicates(docs).collect()} == {0}


def test_components_of_new_links(spark):
    rng = random.Random(9)
    rows = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(0, k) for k in range(1000, 1400)]
    frame = lambda pairs: spark.createDataFrame(pairs, "a bigint, b bigint")
    whole = {r.node: r.component for r in components(frame(rows)).collect() if r.node != r.component}
    known = None
    for part in (rows[:100], rows[100:101], rows[101:], []):
        known = components(frame(part), known)
    assert {r.node: r.component for r in known.collect() if r.node != r.component} == whole


def test_alignment():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 9, 80).astype(np.uint64)
    y = np.delete(x, [5, 40]).copy()
    table = np.zeros((len(x) + 1, len(y) + 1), int)
    for i in range(len(x)):
        for j in range(len(y)):
            table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
    assert order_minhash.aligned(x, y, 80) == table[-1, -1] == decontaminate.common_subsequence(x, y)
    assert order_minhash.aligned(x, x, 1) == 80


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95)]
    found = {r.node: r.component for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}


def test_near_duplicates_of_odd_rows(small, odd_rows):
    clashing = small(odd_rows).withColumns({c: F.lit("clash") for c in ("class_id", "digest", "Digest_", "node")})
    rows = order_minhash.near_duplicates(clashing).collect()
    assert {(r.digest, r.Digest_, r.node) for r in rows} == {("clash",) * 3}
    classes = collections.defaultdict(set)
    for r in rows:
        classes[r.class_id].add(r.doc_id)
    assert len(rows) == len(odd_rows) and {6, 8} in classes.values() and {2, 3} in classes.values()
    assert order_minhash.one_of_each(order_minhash.near_duplicates(small(odd_rows))).count() == len(classes)
    assert order_minhash.near_duplicates(small(odd_rows).limit(0)).count() == 0


def test_decontamination(spark, small, odd_rows):
    rng = random.Random(5)
    items = [words(rng, n) for n in (15, 30, 55, 6)]
    bench = spark.createDataFrame([*enumerate(items), (9, None), (10, "")], "item_id bigint, text string")
    clean = [words(rng, 400) for _ in range(30)]
    put = lambda t, x, at: " ".join([*t.split()[:at], x, *t.split()[at:]])
    leaks = [(0, put(clean[0], items[0], 37)), (1, put(clean[1], items[1], 0)), (2, put(clean[2], changed(rng, items[2], 9), 333)),
             (3, items[3]), (1, put(clean[4], " ".join(w for k, w in enumerate(items[1].split()) if k % 6), 100))]
    rows = [(i, t, None, None) for i, t in enumerate(clean)] + [(100 + i, t, None, None) for i, (_, t) in enumerate(leaks)]
    df = small([*rows, *[(1000 + k, *r[1:]) for k, r in enumerate(odd_rows)]])
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect()}
    assert found == {(100 + i, item) for i, (item, _) in enumerate(leaks)}
    assert decontaminate.clean(df, bench).count() == df.count() - len(leaks)
    assert decontaminate.contaminated(df, bench.limit(0)).count() == 0 == decontaminate.contaminated(df.limit(0), bench).count()


def test_latent_space_holds_the_passages(spark):
    rng = random.Random(6)
    passages = spark.createDataFrame([(i, words(rng, 30)) for i in range(40)], "item_id bigint, text string")
    index = decontaminate.fit(np.ones(1 << decontaminate.IDF_BITS, np.float32), passages)
    assert np.allclose(np.linalg.norm(index.latent, axis=1), 1, atol=1e-2)


def prose(rng, n, vocabulary=tuple(words(random.Random(1), 3000).split())):
    """Words of uneven frequency: a few make up half of a text."""
    return " ".join(rng.choice(vocabulary[:40]) if rng.random() < 0.5 else rng.choice(vocabulary) for _ in range(n))


def search(spark, rows, items, small):
    bench = spark.createDataFrame([*enumerate(items)], "item_id bigint, text string")
    df = small([(i, t, None, None) for i, t in enumerate(rows)])
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(df, bench).collect()}


def within(rng, passage, n=120):
    return f"{prose(rng, n)} {passage} {prose(rng, n)}"


@pytest.mark.parametrize("share", [0.3, 0.38])
def test_passages_with_many_words_replaced(spark, small, share):
    rng = random.Random(int(100 * share))
    items = [prose(rng, rng.randint(15, 59)) for _ in range(60)]
    expected, rows = set(), []
    for i, item in enumerate(items):
        w = item.split()
        for k in rng.sample(range(len(w) - max(3, len(w) // 4)), int(share * len(w))):  # the closing words stay
            w[k] = f"unseen{i}x{k}"
        expected.add((len(rows), i))
        rows += [within(rng, " ".join(w)), prose(rng, 300)]
    assert search(spark, rows, items, small).keys() == expected


def test_every_one_of_many_passages_is_found(spark, small):
    rng = random.Random(12)
    items = [words(rng, rng.randint(20, 45)) for _ in range(2000)]
    rows = [" ".join(items[k : k + 20]) for k in range(0, 2000, 20)]
    assert search(spark, rows, items, small).keys() == {(i // 20, i) for i in range(2000)}
    bench = spark.createDataFrame([*enumerate(items[:600])], "item_id bigint, text string")
    index = decontaminate.fit(np.ones(1 << decontaminate.IDF_BITS, np.float32), bench)
    assert np.allclose(np.linalg.norm(index.latent, axis=1), 1, atol=1e-3)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 160, 250, 700])
def test_short_and_long_passages(spark, small, n):
    rng = random.Random(n)
    items = [words(rng, n) if n > 7 else " ".join(f"rare{i}x{k}" for k in range(n)) for i in range(5)]
    rows = [within(rng, item) for item in items]
    apart = [within(rng, item.replace(" ", " between ")) for item in items if 1 < n <= 7]  # these are not whole
    assert search(spark, rows + apart, items, small).keys() == {(i, i) for i in range(5)}


def test_repeated_passages_are_searched_once(spark, small, monkeypatch):
    rng = random.Random(13)
    items = [words(rng, 30), words(rng, 20)]
    bench = spark.createDataFrame([(0, items[0])] * 900 + [(1, items[1]), (None, items[1]), (None, items[1])], "item_id bigint, text string")
    sizes = []
    monkeypatch.setattr(decontaminate, "fit", lambda idf, passages, fit=decontaminate.fit: (sizes.append(passages.count()), fit(idf, passages))[1])
    df = small([(i, within(rng, item), None, None) for i, item in enumerate(items)])
    found = collections.Counter((r.doc_id, r.item_id) for r in decontaminate.contaminated(df, bench).collect())
    assert found == {(0, 0): 900, (1, 1): 1, (1, None): 2} and sum(sizes) == 3
    assert decontaminate.clean(df, bench).count() == 0


def test_shares_and_quotas():
    assert mixing.targets([100, 1, 50, 10]) == [32.0, 3.0, 96.0, 30.0] and mixing.targets([]) == [] and mixing.targets([0]) == [0.0]
    for seed in range(50):
        rng = random.Random(seed)
        shares = [rng.choice([0, 1, 5, 5, 70, 1000 * rng.random()]) for _ in range(rng.randint(1, 9))]
        limits, seats = [rng.randint(0, 20) for _ in shares], rng.randint(0, 60)
        got = [0] * len(shares)
        for _ in range(seats):
            free = [i for i in range(len(shares)) if shares[i] > 0 and got[i] < limits[i]]
            if free:
                got[max(free, key=lambda i: (shares[i] / (2 * got[i] + 1), -i))] += 1
        assert mixing.sainte_lague(shares, seats, limits) == got


@pytest.mark.parametrize("shard_words", [1 << 18, 50])
def test_mix(small, odd_rows, shard_words):
    rng = random.Random(7)
    rows = [(i, words(rng, rng.randint(0, 90)), None, rng.choice(["a", "a", "a", "b", "é", None])) for i in range(400)]
    df = small([*rows, *odd_rows])
    made = mixing.mix(df, shard_words=shard_words).collect()
    assert sorted(map(str, made)) == sorted(map(str, mixing.mix(df.repartition(5), shard_words=shard_words).collect()))
    assert len(made) == df.count() and all(0 <= r.taken <= 3 * r.size for r in made)
    by_target = collections.defaultdict(int)
    for r in made:
        by_target[r.source_size, r.target] += r.taken
    for (size, target), taken in by_target.items():
        assert abs(taken - target) <= mixing.BLOCK * (2 + size // shard_words + 1), (size, target, taken)
    assert mixing.mix(df.limit(0)).count() == 0
    copies = mixing.mixed_documents(df, shard_words=shard_words)
    assert copies.columns == df.columns and copies.count() > 0


@pytest.mark.parametrize("limit", [40, 300, 5000, 10**9])
def test_shards_fit(small, odd_rows, limit):
    rng = random.Random(8)
    rows = [(i, words(rng, rng.randint(0, 40)), None, None) for i in range(150)] + [(7, "the same row", None, None)] * 60
    df = small([*rows, *odd_rows]).withColumn("depth", F.lit("clash"))
    made = sharding.shard(df, limit=limit).collect()
    assert len(made) == df.count()
    size = collections.Counter()
    for r in made:
        size[r.shard] += r.n_bytes
    for r in made:
        assert size[r.shard] == r.shard_bytes and (size[r.shard] <= limit or r.n_bytes > limit)
    # Only oversized buckets were split: a shard and its sibling together do not fit.
    plain = {s for s in size if "-" not in s}
    for s in plain:
        if len(s) > 1:
            assert sum(n for t, n in size.items() if t.startswith(s[:-1])) > limit
    assert sharding.shard(df.limit(0), limit=limit).count() == 0


def test_recurring_lines_are_dropped(small, odd_rows):
    rng = random.Random(9)
    rows = [(i, f"{words(rng, 9)}\nVisit our page number {i} for news today\n{words(rng, 9)}\nshort one", None, None) for i in range(8)]
    copied = words(rng, 12)
    df = small([*rows, *[(50 + i, copied, None, None) for i in range(9)], *odd_rows]).withColumn("n_lines", F.lit("clash"))
    made = {(r.doc_id, r.n_dropped): r.text for r in line_templates.drop_recurring_lines(df).collect()}
    for i, text, _, _ in rows:
        kept = [x for x in text.split("\n") if not x.startswith("Visit")]
        assert made[i, 1] == "\n".join(kept)
    assert made[50, 0] == copied and made[3, 0] == "" and made[2, 0] is None and line_templates.drop_recurring_lines(df.limit(0)).count() == 0


def test_fingerprints(small, odd_rows):
    rng = random.Random(10)
    rows = [(i * 3, words(rng, rng.randint(0, 60)), None, None) for i in range(60)] + [r for r in odd_rows if r[0] not in (6,)]
    df = small(rows)
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for bucket_chars in (1 << 24, 900):
        made = fingerprints.fingerprints(df, bucket_chars=bucket_chars).collect()
        assert len(made) == len(rows)
        seen = {(r.doc_id, r.n_chars, r.edited_sha256) for r in made}
        for (key, text, _, _), after in zip(expected, [*expected[1:], expected[0]], strict=True):
            new = fingerprints.edited(text or "", after[1] or "")
            assert (key, len(text or ""), hashlib.sha256(new.encode()).hexdigest()) in seen
    assert fingerprints.fingerprints(df.limit(0)).count() == 0
    a, b, c = (fingerprints.embed([t])[0] for t in ("same text " * 50, "same text " * 49 + "same texts", words(rng, 100)))
    assert fingerprints.likeness(a, a) == 1 and fingerprints.likeness(a, b) > 0.9 and fingerprints.likeness(a, c) < 0.2


def test_fingerprint_links(small):
    rng = random.Random(11)
    base = [words(rng, 300) for _ in range(20)]
    rows = [(i, t, None, None) for i, t in enumerate([*base, *[t.replace(" ", "  ", 1) for t in base]])]
    links = {(r.left, r.right) for r in fingerprints.near_duplicates(fingerprints.fingerprints(small(rows))).collect()}
    made = fingerprints.embed([r[1] for r in rows])
    for i in range(20):
        near = fingerprints.likeness(made[i], made[i + 20])  # equal fingerprints are one class, which needs no link
        assert ((i, i + 20) in links) == (0.8 <= near < 1)
    assert len(links) <= 20


@pytest.mark.parametrize("block", [fingerprints.BLOCK, 8])
def test_fingerprint_links_between_others_than_the_head(spark, monkeypatch, block):
    monkeypatch.setattr(fingerprints, "BLOCK", block)
    rng = np.random.default_rng(14)
    family = rng.integers(0, 16, fingerprints.SAMPLES)
    rows = []
    for _ in range(30):  # pairs alike, of a family half alike; one band holds them all
        one = np.where(rng.random(fingerprints.SAMPLES) < 0.5, family, rng.integers(0, 16, fingerprints.SAMPLES))
        two = np.where(rng.random(fingerprints.SAMPLES) < 0.1, rng.integers(0, 16, fingerprints.SAMPLES), one)
        rows += [one, two]
    first = np.random.default_rng(fingerprints.SEED).permuted(np.arange(fingerprints.SAMPLES))[:6]
    for row in rows:
        row[first] = family[first]
    marked = spark.createDataFrame([(i, fingerprints.as_text(r.astype(np.uint8))) for i, r in enumerate(rows)], "doc_id bigint, fingerprint string")
    links = {(r.left, r.right) for r in fingerprints.near_duplicates(marked, bands=1).collect()}
    assert links == {(2 * i, 2 * i + 1) for i in range(30)}


def test_fingerprint_query_names_groups(spark, small, tmp_path, llm_runs):
    rng = random.Random(15)
    base = [words(rng, 300) for _ in range(3)]
    rows = [(i, t, None, None) for i, t in enumerate([*base, *base, words(rng, 300)])] + [(None, words(rng, 90), None, None)]
    small(rows).write.parquet(str(tmp_path / "documents.parquet"))
    made = {r.doc_id: r.class_id for r in llm_runs["op10_edit_fingerprints"](spark, str(tmp_path)).collect()}
    assert len(made) == 8 and [made[i] for i in range(7)] == [0, 1, 2, 0, 1, 2, 6] and made[None] is not None


def test_pipeline(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        before, docs = docs, stage(spark, docs, folder)
        assert docs.columns == before.columns
        assert docs.join(before, docs.columns, "left_anti").count() == 0
    final = corpus_pipeline.run(spark, folder)
    assert set(before.columns) < set(final.columns)
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    assert {r.doc_id for r in final.select("doc_id").collect()} <= kept
    assert final.groupBy("shard").agg(F.sum("n_bytes").alias("n"), F.max("shard_bytes").alias("m")).where("n <> m").count() == 0


def test_pipeline_of_nothing(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("n", [3, 50, 800])
def test_windows_that_are_added_up_equal_those_summed_one_by_one(spark, n):
    rng = random.Random(n)
    bench = spark.createDataFrame([(i, prose(rng, k)) for i, k in enumerate((3, 9, 15, 21, 30, 45, 59, 130))], "item_id bigint, text string")
    index = decontaminate.fit(np.ones(1 << decontaminate.IDF_BITS, np.float32), bench)
    (words_of_text,) = decontaminate._texts_words([prose(rng, n)])
    columns = decontaminate._columns(words_of_text, index.vocabulary)
    weight = index.idf[decontaminate._bucket(words_of_text)]
    expected, spans = set(), [s for some in index.spans for s in some]
    assert len({size for size, _, _ in spans}) > 4 and sum(last - first for _, first, last in spans) == 8
    segments = -(-n // decontaminate.SEGMENT)
    for size, first, last in spans:
        size = min(size, segments) * decontaminate.SEGMENT
        for at in range(0, max(1, segments * decontaminate.SEGMENT - size + 1), decontaminate.SEGMENT):
            some = columns[at : at + size]
            laid = weight[at : at + size][some >= 0] @ index.products[some[some >= 0]]
            expected |= {(at, i, size) for i in range(first, last) if laid[i] >= index.least[i]}
    assert {(w, i, size) for first, which, size in decontaminate.candidates(columns, weight, index)
            for w, i in zip(first.tolist(), which.tolist(), strict=True)} == expected
