"""The operators' own interfaces: ids, prefixes, files, components, the host prior, the pipeline."""

import collections
import random
import re
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hirelake.llm import bpe, components, counts, embeddings, minhash, quality, rules, scan, token_files, urls
from hirelake.llm.arrow import importable

BYTES, WORD = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(autouse=True)
def _paths(spark):
    importable(spark)


def texts_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_ids_round_trip(spark):
    docs = texts_of(spark, ["The rain.", None, "", "日本 😀\n\n x"])
    coded = bpe.encode_texts(docs, BYTES, public_tokenizers.PATTERN)
    decoded = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode_ids(coded, BYTES, public_tokenizers.PATTERN).collect()}
    assert decoded == {0: "The rain.", 1: "", 2: "", 3: "日本 😀\n\n x"}


def test_long_pieces_merge_as_short_ones():
    coder = bpe.load(BYTES, public_tokenizers.PATTERN)
    for piece in (b"abab" * 50, "日本".encode() * 30, b"thering" * 20):
        assert coder.merge_long(piece).tolist() == coder.merge_rows([piece], 256)[0].tolist()


def test_every_prefix_count(spark):
    coder = Tokenizer.from_file(WORD)
    pick = random.Random(5)
    parts = [" ", "\n", "'re", "'", "the", "ing", "É", "é", "日本", "12", "!?", "İ", "<|endoftext|>", "<|", "xyzzy"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(1, 12))) for _ in range(60)] + ["internationalization " * 3, "y" * 90]
    counted = counts.prefix_counts(texts_of(spark, texts), WORD).cache()
    steps = {r.doc_id: np.cumsum(np.frombuffer(r.steps, np.int8)) for r in counted.collect()}
    for k, text in enumerate(texts):
        text = unicodedata.normalize("NFC", text)
        assert steps[k].tolist() == [len(coder.encode(text[:n], add_special_tokens=False).ids) for n in range(1, len(text) + 1)]
    reach = {r.doc_id: r.prefix_characters for r in counts.longest_prefix(counted, "2").collect()}
    at = {r.doc_id: r.prefix_tokens for r in counts.tokens_of_prefix(counted, "5").collect()}
    for k, found in steps.items():
        assert reach[k] == max([n + 1 for n, x in enumerate(found) if x <= 2], default=0)
        assert at[k] == found[min(5, len(found)) - 1]


def test_token_files_of_some_documents(spark, tmp_path):
    docs = texts_of(spark, [f"document {k} of the " + "set " * k for k in range(50)])
    manifest = token_files.write_token_files(docs.repartition(4), str(tmp_path / "files"), WORD, end_id=2)
    every = {r.doc_id: r for r in token_files.read_token_files(manifest).collect()}
    assert sorted(every) == list(range(50))
    some = token_files.read_documents(manifest, docs.where("doc_id % 7 = 3").union(docs.limit(1)))
    assert {r.doc_id: (r.start, bytes(r.ids)) for r in some.collect()} == {
        k: (every[k].start, bytes(every[k].ids)) for k in [0, *range(3, 50, 7)]}
    name = manifest.orderBy("number").first()["file"]
    reader = token_files.TokenFileReader(name)
    assert all(len(raw) == size for (_, raw), size in zip(reader.frames(np.arange(len(reader.size))), reader.size))
    raw = bytearray(open(name, "rb").read())
    raw[reader.packed[0] - 1] ^= 255
    damaged = tmp_path / "damaged"
    damaged.write_bytes(raw)
    with pytest.raises(Exception):
        list(token_files.TokenFileReader(str(damaged)).frames(np.array([0])))


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(100, 130)] + [(1, k) for k in range(2, 60)] + [(7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(5))
    low = {r.node: r.low for r in found.collect()}
    assert low == {k: 100 for k in range(101, 131)} | {k: 1 for k in range(2, 60)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_signatures_are_alike_as_the_sets():
    numbers = np.random.default_rng(2).integers(0, 1 << 62, 1500, dtype=np.uint64)
    sets = [np.unique(numbers[:1000]), np.unique(numbers[200:1200]), np.unique(numbers[:3]), np.zeros(0, np.uint64)]
    rows = minhash.super_minhash(sets, 200)
    assert abs((rows[0] == rows[1]).mean() - 800 / 1200) < 0.1
    assert len(np.unique(rows[2] >> np.uint64(56))) <= 200 and (rows[3] == 2**64 - 1).all()
    parts = minhash.super_minhash([np.concatenate([np.unique(numbers)] * 1)], 64)
    old, minhash.BLOCK = minhash.BLOCK, 100
    try:
        assert (minhash.super_minhash([np.unique(numbers)], 64) == parts).all()
    finally:
        minhash.BLOCK = old


def test_buckets_that_a_leader_does_not_settle(spark, monkeypatch):
    """One place per band and few words: most texts share buckets with texts they are not like."""
    monkeypatch.setattr(minhash, "COMPARED", 3)
    base = [f"w{k}" for k in range(40)]
    texts = []
    for family in range(6):
        own = base[:12] + [f"f{family}x{k}" for k in range(40)]
        texts += [" ".join(own + [f"v{copy}"]) for copy in range(4)]
    found = minhash.near_duplicates(texts_of(spark, texts), minhash.Plan(bands=40, rows=1))
    assert {r.doc_id: r.component_id for r in found.collect()} == {k: k // 4 * 4 for k in range(24)}


def test_a_large_group_passes_by_its_strays_once(spark, monkeypatch):
    """Many near copies of one text, and strays that only share its first words: rows in proportion to the texts."""
    base = [f"w{k}" for k in range(30)]
    texts = [" ".join([*base, *[f"c{k}" for k in range(30)], f"v{copy}"]) for copy in range(900)]
    texts += [" ".join(base + [f"s{stray}x{k}" for k in range(30)]) for stray in range(20)]
    frame = texts_of(spark, texts)
    plan = minhash.Plan(bands=3, rows=1)
    sets = minhash.stage(minhash.shingle_sets(frame, plan), "sets")
    shared = minhash.stage(sets.selectExpr("doc_id AS text_id", "CAST(size(shingles) AS bigint) AS n_shingles", "explode(array(1L, 2L)) AS band")
                           .selectExpr("*", "0L AS leader", "920L AS size").where("band = 1 OR text_id != 7"), "shared")
    found = minhash.stage(sets.selectExpr("doc_id AS node", "0L AS low").where("doc_id BETWEEN 1 AND 899"), "found")
    assert minhash._within_buckets(shared, found, sets, plan).count() == 0
    monkeypatch.setattr(minhash, "_settle_sorted", lambda plan: lambda batches: (
        pa.record_batch([x.column(4), x.column(4)], ["a", "b"]) for x in batches))  # every row that is dealt
    assert 0 < minhash._within_buckets(shared, found, sets, plan).count() <= 3 * shared.count()


def test_strays_are_linked_across_blocks_and_slices(spark, monkeypatch):
    """Chains of texts, each like the next one only: small blocks and slices give the groups that all pairs give."""
    words = [f"w{k}" for k in range(90)]
    texts = [" ".join(words[at:at + 40]) for at in range(0, 48, 3)] + [" ".join(words[:40] + ["x"] * copy) for copy in range(1, 9)]
    sets = [{tuple(x.split()[k:k + 4]) for k in range(len(x.split()) - 3)} for x in texts]
    root = components.UnionFind()
    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root.join(a, b)
    for held, streamed in ((1, 4), (3, 2), (2000, 20_000)):
        monkeypatch.setattr(minhash, "COMPARED", held)
        monkeypatch.setattr(minhash, "SLICE", streamed)
        found = minhash.near_duplicates(texts_of(spark, texts), minhash.Plan(bands=40, rows=1))
        assert {r.doc_id: r.component_id for r in found.collect()} == {k: root.root(k) for k in range(len(texts))}


def test_cells_and_blocks_lose_no_link(spark, monkeypatch):
    random_rows = np.random.default_rng(4).normal(size=(300, 8)).astype(np.float32)
    rows = np.concatenate([random_rows, random_rows[:60] + np.float32(0.05)])
    monkeypatch.setattr(embeddings, "CELL", 30)
    monkeypatch.setattr(embeddings, "BLOCK", 20)
    df = spark.createDataFrame([(k, [float(x) for x in row]) for k, row in enumerate(rows)], "vec_id long, embedding array<float>")
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    expected = dict(enumerate((linked.sum(axis=1) - 1).tolist()))
    assert {r.vec_id: r.n_links for r in embeddings.near_duplicates(df).collect()} == expected


def test_pivots_prune_where_vectors_lie_in_clusters(spark, monkeypatch):
    """More vectors than a cell has: chains within families are found whole, and less than a quarter of the lower cells is reached."""
    monkeypatch.setattr(embeddings, "CELL", 100)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 32))
    rows = np.repeat(centres, 125, axis=0) + 0.4 * rng.normal(size=(5000, 32))
    rows = rows.astype(np.float32)
    ids = rng.permutation(5000)
    df = spark.createDataFrame([(int(k), [float(x) for x in row]) for k, row in zip(ids, rows)], "vec_id long, embedding array<float>").repartition(4)
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    groups = components.UnionFind()
    for a, b in zip(*np.nonzero(linked)):
        groups.join(int(ids[a]), int(ids[b]))
    expected = {int(k): (int(linked[at].sum()) - 1, groups.root(int(k))) for at, k in enumerate(ids)}
    assert sum(links for links, _ in expected.values()) > 1000
    members = []
    plain = embeddings._members
    monkeypatch.setattr(embeddings, "_members", lambda *given: members.append(plain(*given)) or members[0])
    found = embeddings.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected
    guests = members[0].where("guest").count()
    assert guests < 0.25 * 5000 * 49 / 2  # 50 pivots: a vector has some 24 lower cells on average


@pytest.mark.parametrize("block", [8192, 300])
def test_chains_over_many_chunks_stay_connected(spark, monkeypatch, block):
    """Families of vectors along arcs, where only neighbours are linked, in any order of ids; more rows than a chunk."""
    monkeypatch.setattr(embeddings, "BLOCK", block)
    angles = np.arange(15) * 0.4
    arcs = np.zeros((60, 15, 120), np.float32)
    for family, rows in enumerate(arcs):
        rows[:, 2 * family], rows[:, 2 * family + 1] = np.cos(angles), np.sin(angles)
    rows = arcs.reshape(-1, 120)
    ids = np.random.default_rng(3).permutation(len(rows)) + 7
    df = spark.createDataFrame([(int(k), [float(x) for x in row]) for k, row in zip(ids, rows)], "vec_id long, embedding array<float>")
    unit = rows.astype(float) / np.linalg.norm(rows.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    groups = components.UnionFind()
    for a, b in zip(*np.nonzero(linked)):
        groups.join(int(ids[a]), int(ids[b]))
    expected = {int(k): (int(linked[at].sum()) - 1, groups.root(int(k))) for at, k in enumerate(ids)}
    found = embeddings.near_duplicates(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == expected
    assert sum(r.kept for r in found) == len({low for _, low in expected.values()})


def test_hosts_shrink_towards_the_mean(spark):
    good = [(k, "good", "a b c d e f g h i j k l" + str(k)) for k in range(200)]
    bad = [(300 + k, "bad", "spam " * 30) for k in range(60)] + [(370, "bad", "one fine text of more than ten words that nobody has repeated")]
    small = [(400, "small", "short")] + [(401 + k, f"h{k}", f"a text number {k} with quite some words in it, all different ones") for k in range(30)]
    docs = spark.createDataFrame(good + bad + small, "doc_id long, source string, text string")
    measured = rules.measure(docs, host="source", doc_id=F.col("doc_id")).cache()
    hosts = {r.host: r for r in rules.host_verdicts(measured).collect()}
    assert not hosts["bad"].host_kept and hosts["good"].host_kept
    assert 0 < hosts["small"].failure_rate < 1
    kept = {r.doc_id: r.kept for r in rules.judge(measured).collect()}
    assert kept[0] and not kept[370] and not kept[400] and kept[401]


def test_kept_by_brute_force(spark):
    """Hosts of all kinds: the prior from all hosts, shares drawn towards the mean, verdicts joined back."""
    pick = random.Random(8)
    rows = []
    for host, (size, bad) in enumerate([(60, 0.0), (50, 0.1), (40, 0.95), (30, 0.5), (20, 0.05), (2, 1.0), (1, 1.0), (80, 0.02)]):
        for _ in range(size):
            text = "x " * 30 if pick.random() < bad else " ".join(f"w{pick.randrange(9999)}" for _ in range(30))
            rows.append((len(rows), f"h{host}", text))
    rows += [(len(rows), None, "x " * 30), (len(rows) + 1, None, " ".join(f"v{k}" for k in range(30))), (len(rows) + 2, "h2", None)]
    failed = {doc: (text or "").startswith("x") or not text for doc, _, text in rows}
    hosts = collections.defaultdict(list)
    for doc, host, _ in rows:
        if host:
            hosts[host].append(failed[doc])
    total = sum(map(len, hosts.values()))
    mean = sum(map(sum, hosts.values())) / total
    spread = sum(len(x) * (sum(x) / len(x)) ** 2 for x in hosts.values()) / total - mean ** 2 - mean * (1 - mean) * len(hosts) / total
    strength = max(1.0, mean * (1 - mean) / spread - 1)
    rate = {host: (sum(x) + mean * strength) / (len(x) + strength) for host, x in hosts.items()}
    rejected = {host for host, x in rate.items() if x > max(0.25, 2 * mean)}
    assert {"h2"} <= rejected < set(hosts)
    expected = {doc: not failed[doc] and host not in rejected for doc, host, _ in rows}
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    measured = rules.measure(docs, host="source", doc_id=F.col("doc_id")).cache()
    assert {r.doc_id: r.kept for r in rules.judge(measured).collect()} == expected
    assert any(expected[doc] != (not failed[doc]) for doc, _, _ in rows)
    found = {r.host: r.failure_rate for r in rules.host_verdicts(measured).collect()}
    assert found == pytest.approx(rate)


def test_hosts_that_chance_explains_are_pooled(spark):
    rows = [(k, f"h{k % 4}", "short" if k % 8 < 4 else " ".join(f"v{j}" for j in range(30))) for k in range(80)]
    measured = rules.measure(spark.createDataFrame(rows, "doc_id long, source string, text string"), host="source", doc_id=F.col("doc_id"))
    found = rules.host_verdicts(measured.cache()).collect()
    assert {r.failure_rate for r in found} == {0.5} and all(r.host_kept for r in found)


def test_other_languages_go(spark):
    known = ["the rain and the river under the stone light", "el rio y la piedra bajo la luz de la noche"]
    rows = [(k, known[k % 2] + f" {k}", ["en", "es"][k % 2], "s", 1) for k in range(40)]
    rows += [(100, "на берегу пустынных волн стоял он дум великих полн", None, "s", 1), (101, "12 34 ...", None, "s", 1), (102, None, None, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.known_language(spark, docs, "").collect()) == list(range(40))


def test_repeated_labels_and_documents_teach_once(spark):
    docs = spark.createDataFrame([(k % 5, f"text {k % 5} " * (k % 5 + 1)) for k in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(k % 5, k % 2 if k % 5 == 4 else (k % 5) % 2) for k in range(100)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    assert sorted(model.labels.tolist()) == [0.0, 0.0, 1.0, 1.0]  # the fifth id has both labels


def test_a_hot_url_teaches_once(spark):
    """Half of all rows are one URL; trees learn from distinct ones and tell the languages apart on URLs without a rule."""
    pages = [(k, "http://hot.com/de/x") for k in range(3000)]
    pages += [(5000 + k, f"http://site{k % 50}.{'com' if k % 2 else 'net'}/{'de' if k % 3 == 0 else 'fr'}/{'9' * (30 if k % 3 == 0 else 1)}{k}") for k in range(3000)]
    frame = spark.createDataFrame(pages, "page_id long, url string")
    found = urls.judge_urls(frame, [urls.Rule("allow", "com/fr/"), urls.Rule("block", "com/de/")], sample=500).where("rule is null").collect()
    wrong = sum(r.verdict != ("block" if r.path.startswith("/de/") else "allow") for r in found)
    assert len(found) == 1500 and wrong <= 15


def test_links_of_a_hub_are_joined_where_they_are(spark, monkeypatch):
    monkeypatch.setattr(components, "FEW", 5)
    links = [(0, k) for k in range(1, 400)] + [(500, k) for k in range(300, 420)] + [(k, k + 1) for k in range(600, 640)]
    found = components.components(spark.createDataFrame(links, "a long, b long").repartition(6))
    low = {r.node: r.low for r in found.collect()}
    assert low == {k: 0 for k in [*range(1, 420), 500]} | {k: 600 for k in range(601, 641)}


def test_rows_without_id_are_in_many_files(spark, tmp_path):
    docs = spark.createDataFrame([(None, f"text number {k}") for k in range(400)], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        manifest = token_files.write_token_files(docs.repartition(4), str(tmp_path / "files"), WORD, end_id=2)
        assert manifest.count() > 4 and token_files.read_token_files(manifest).count() == 400
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_votes_are_the_nearest(spark):
    model = quality.Neighbours(np.eye(quality.TERMS)[:, :3], np.eye(3), np.array([1.0, 0.0, 0.0]))
    rows = np.zeros((3, quality.TERMS), np.float32)
    rows[0, 0], rows[1, 1] = 1, 1
    assert quality.vote(rows, model, 1, 1.0).tolist() == [1.0, 0.0, 1 / 3]


def test_one_verdict_only(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://b.com/")], "page_id long, url string")
    for verdict in ("allow", "block"):
        found = urls.judge_urls(pages, [urls.Rule(verdict, "org/")])
        assert {r.page_id: r.verdict for r in found.collect()} == {1: verdict, 2: verdict}


def test_units_of_long_texts():
    text = ("word  of\n\nsome " * 300000) + "end"
    data, offsets = scan.text_bytes(pa.array(["a", text, None, ""]))
    assert b"".join(part.tobytes() for _, _, part in scan.slices(data, offsets)) == b"a" + text.encode()


@pytest.mark.parametrize("inner", ["\u3000", "\u00a0", "\u2003", "\u0085"])
def test_words_of_long_texts_hold_other_white_space(inner):
    """Around every megabyte the next white space is no ASCII one, and belongs to a word."""
    text = " ".join(f"w{k % 4000}{inner}" + "日" * 200 + f"{inner}v" for k in range(6000))
    assert len(text.encode()) > 3 << 20
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    inside = {k + j for k in range(len(words) - 4) if windows[tuple(words[k:k + 5])] > 1 for j in range(5)}
    found = dict(zip(rules.MEASURES, rules.measure_texts(pa.array(["a b", text]))[1].tolist()))
    assert found == {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": 0, "n_dup_lines": 0, "n_repeat_words": len(inside), "n_lines": 1}
    prints = minhash.word_prints(pa.array(["a b", text]))[1]
    assert prints.tolist() == np.concatenate(minhash.word_prints(pa.array(words))).tolist()


def test_no_python_for_urls(spark, odd):
    from hirelake.llm.queries import QUERIES

    plan = QUERIES["op8_urls"](spark, odd)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow") if x in plan]


def test_pipeline_on_odd_rows(spark, odd, empty):
    for folder in (odd, empty):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == columns, name
        corpus_pipeline.run(spark, folder).count()
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    left = corpus_pipeline.no_near_duplicates(spark, docs, odd).select("text").collect()
    words = [" ".join((r.text or "").lower().split()) for r in left]
    assert len([x for x in words if x]) == len({x for x in words if x})  # of the copies one stays, whatever their ids


def test_pipeline_is_its_operators(spark):
    """On a test table: each stage drops exactly what its operator rejects."""
    from hirelake.llm import language
    from tests.llm.conftest import REAL

    docs = spark.read.parquet(f"{REAL}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    predicted = language.predict(docs, language.fit(docs), doc_id=F.col("doc_id"))
    assert ids(corpus_pipeline.known_language(spark, docs, REAL)) == ids(predicted.where("lang_pred <> 'und' and score >= 0.1 and margin >= 0.005"))
    judged = rules.judge(rules.measure(docs, host="source", doc_id=F.col("doc_id")))
    assert ids(corpus_pipeline.good_quality(spark, docs, REAL)) == ids(judged.where("kept"))
    assert ids(corpus_pipeline.no_near_duplicates(spark, docs, REAL)) == ids(minhash.near_duplicates(docs, minhash.Plan(words=5)).where("kept"))
    packed = corpus_pipeline.run(spark, REAL)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_workers_let_go_of_the_last_tool(spark, monkeypatch):
    """A worker that served a tokenizer or trigrams keeps none of their tables while it sketches, verifies or measures texts."""
    caught = []
    for module in (minhash, rules):
        monkeypatch.setattr(module, "map_texts", lambda df, columns, schema, function: caught.append(function))
    docs = texts_of(spark, ["a b c"])
    minhash.sketch(docs, minhash.Plan())
    minhash.shingle_sets(docs, minhash.Plan())
    rules.measure(docs, doc_id=F.col("doc_id"))
    batch = pa.record_batch([pa.array([0]), pa.array(["x"]), pa.array(["a b c"])], ["doc_id", "host", "text"])
    plain = batch.select(["doc_id", "text"])
    for function, rows in zip([*caught, minhash._settle_sorted(minhash.Plan())], [[plain], [plain], [batch], []]):
        scan.tool(("test",), lambda: bytearray(10))
        list(function(iter(rows)))
        assert scan._tool == [None, None]


def test_language_looks_at_short_slices(monkeypatch):
    """The numbers made from a slice stay far below a worker's memory, and the vectors do not depend on where texts are cut."""
    import tracemalloc

    from hirelake.llm.language import TrigramVectors

    texts = pa.array(["The rain in Spain, 日本 и дождь. " * 30_000, *["no more rain today "] * 50, None, ""])
    vectors = TrigramVectors(64, 7)
    whole = vectors.texts(texts)
    tracemalloc.start()
    try:
        assert (vectors.texts(texts) == whole).all()
        assert tracemalloc.get_traced_memory()[1] < 45 << 20
    finally:
        tracemalloc.stop()
    monkeypatch.setattr("hirelake.llm.language.SLICE_BYTES", 100)
    assert (vectors.texts(texts) == whole).all()
