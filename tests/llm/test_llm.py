"""Operators of the llm subpackage against brute force on small tables with nulls, ties and repeats."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ticketlens.llm import bpe, chat, digests, lines, merges, packing, quality, queries, simhash, suffix_tree, token_counts, vectors
from ticketlens.llm.common import components, remainder

public_tokenizers = pytest.importorskip("public_tokenizers")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["the", "Über", "a", "ß", "don't", "  ", "x1", "</s>", "<|endoftext|>", "long" * 40]
    made = [" ".join(rng.choices(words, k=rng.randint(1, 60))) + rng.choice(["", "\n", "\n Shared LINE \n"]) for _ in range(40)]
    return [*made, None, "", "same text here ok", "same text here ok", "\n\n", "z" * 3000, "one"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, _kept_not string")


def groups(n, linked):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in linked:
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_simhash_equals_brute_force(docs, texts):
    def plain(text):
        words = (text or "").encode().lower().split()
        spans = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in spans]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    prints = [plain(t) for t in texts]
    close = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if (prints[i] ^ prints[j]).bit_count() <= 3]
    expected = {i: (p, c) for i, (p, c) in enumerate(zip(prints, groups(len(texts), close)))}
    for bucket in (8192, 1):  # directly, and through probes
        got = simhash.near_duplicates(docs, bucket=bucket).collect()
        assert {r["doc_id"]: (r["fp"] % (1 << 64), r["component_id"]) for r in got} == expected


def test_covering_masks_miss_no_pair():
    masks = [m % (1 << 64) for m in simhash.covering_masks(3)]
    for bits in itertools.combinations(range(64), 3):
        apart = sum(1 << b for b in bits)
        assert any(not apart & m for m in masks)


def test_large_buckets_link_as_small_ones(spark):
    rng = random.Random(3)
    prints = {rng.getrandbits(63)}
    while len(prints) < 60:
        prints.add(rng.choice(sorted(prints)) ^ 1 << rng.randrange(62) ^ 1 << rng.randrange(62))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = [{tuple(r) for r in components(simhash.links(df, 3, b)).collect()} for b in (8192, 1)]
    assert found[0] == found[1] and found[0]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 50), (60, 61)], "a long, b long")
    assert {r["node"]: r["root"] for r in components(edges).collect()} == {**dict.fromkeys(range(41), 0), 60: 60, 61: 60}


def clustered(seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, 8))
    x = [c + rng.normal(size=8) * s for c in centres for s in (0, 0, 0.05, 0.2, 0.3)]
    return [v.tolist() for v in x] + [None, [0.0] * 8, [float("nan")] + [1.0] * 7, [1.0, None] + [0.0] * 6, [1.0, 0.0], [2.0, 0.0], []]


@pytest.mark.parametrize("block", [2048, 16])
def test_vectors_equal_brute_force(spark, block):
    x = clustered()
    units = [vectors.unit(v) for v in x]
    close = [
        (i, j)
        for i, j in itertools.combinations(range(len(x)), 2)
        if units[i] is not None and units[j] is not None and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.95
    ]
    n = Counter(i for pair in close for i in pair)
    expected = [(i, n[i], c) for i, c in enumerate(groups(len(x), close))]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    found = vectors.near_duplicates(df, sample=20, centres=5, block=block)
    assert sorted(map(tuple, found.collect())) == expected


def test_boundaries_are_optimal():
    rng = random.Random(2)
    for _ in range(30):
        histogram = {n: rng.randint(1, 9) for n in rng.sample(range(1, 40), rng.randint(1, 8))}
        k, sizes = rng.randint(1, 4), sorted(histogram)

        def padding(bounds):
            return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in histogram.items())

        best = min(padding([*c, sizes[-1]]) for m in range(k) for c in itertools.combinations(sizes[:-1], m))
        bounds = packing.boundaries(histogram, k)
        assert len(bounds) <= k and padding(bounds) == best


def test_packing_keeps_every_token_once(docs, texts):
    rows = packing.pack(docs, packing.count_words("text"), max_len=16, buckets=3, budget=64).collect()
    pieces, batches = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        batches[r["batch_id"]].append(r)
    for i, text in enumerate(texts):
        n = len((text or "").encode().split()) + 1
        assert sorted(pieces[i]) == [(s, min(16, n - s)) for s in range(0, n, 16)]
    for held in batches.values():
        assert len({r["bucket"] for r in held}) == 1 and all(r["length"] <= r["bucket"] for r in held)
        assert len(held) <= max(1, 64 // held[0]["bucket"])
    assert sorted(batches) == list(range(len(batches)))


def test_chat_layouts_and_escapes(spark):
    records = [
        (1, '{"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b\\\\<|end|>\\n"}], "extra": 1}'),
        (2, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": null}]}'),
        (3, '{"instruction": "do", "input": "this", "output": "done"}'),
        (4, '{"prompt": "p", "response": "r", "system": "s"}'),
        (5, '{"what": 1}'),
        (6, None),
    ]
    turns = chat.canonical_turns(spark.createDataFrame(records, "conv_id long, payload string"), "conv_id")
    got = defaultdict(list)
    for r in chat.format_turns(turns).orderBy("conv_id", "turn").collect():
        assert chat.read_turn(r["formatted"]) == (r["role"], r["text"])
        body = r["formatted"][len(chat.OPEN) : -len(chat.CLOSE)]
        assert not any(c in body for c in chat.CONTROL)
        got[r["conv_id"]].append((r["role"], r["text"]))
    assert got[1] == [("user", "a"), ("assistant", "b\\<|end|>\n")]
    assert got[2] == [("user", "q"), ("assistant", "")]
    assert got[3] == [("user", "do\n\nthis"), ("assistant", "done")]
    assert got[4] == [("system", "s"), ("user", "p"), ("assistant", "r")]
    assert got[5] == [("unknown", '{"what": 1}')] and got[6] == [("unknown", "")]


def test_suffix_tree_is_a_distribution_and_base_is_exact(docs, texts):
    got = {r["doc_id"]: r for r in suffix_tree.score(docs, remainder("doc_id", 7) == 2).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    tokens = [suffix_tree.canonical((t or "").encode()).split() + [b"\n"] for t in texts]
    counts = Counter(w for i, ws in enumerate(tokens) if not held[i] for w in ws)
    n, v = sum(counts.values()), len(counts)
    for i, ws in enumerate(tokens):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r["score"] < 0
    model = suffix_tree.train(docs.select(F.coalesce("text", F.lit("")).cast("binary")))
    seen = len(model.logp[0]) - 1
    total = (10.0 ** model.logp[:, :-1].astype(float)).sum(axis=1) + 10.0 ** model.logp[:, -1].astype(float) * (suffix_tree.SYMBOLS - seen)
    assert np.allclose(total, 1, atol=1e-4)


def test_tokens_equal_the_libraries(spark, docs, texts):
    import tiktoken
    from tokenizers import Tokenizer

    ranks_path, json_path = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
    merged, tokens = merges.from_ranks(ranks_path)
    ranks = {t: i for i, t in enumerate(tokens)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(docs, ranks_path, chunk=64, overlap=16)
    for r in encoded.withColumn("back", bpe.decode(spark, "ids", ranks_path)).collect():
        text = texts[r["doc_id"]] or ""
        assert r["ids"] == plain.encode_ordinary(text) and bytes(r["back"]) == text.encode()
    known = Tokenizer.from_file(json_path)
    counted = docs.select("doc_id", token_counts.token_count(spark, "text", json_path).alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in counted} == {
        i: len(known.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)
    }


def test_digests_with_next(docs, texts):
    assert digests.likenesses([digests.digest(b"abcdefgh" * 9)], [digests.digest(b"abcdefgh" * 9)])[0] == 1
    follow = lambda triples: [[t[0] for t in triples], [t[2] for t in triples]]
    got = {r["a"]: r["b"] for r in digests.map_with_next(docs.repartition(5), follow, "a long, b string").collect()}
    assert got == {i: texts[(i + 1) % len(texts)] or "" for i in range(len(texts))}


@pytest.mark.parametrize("keep_first", [False, True])
def test_lines_equal_brute_force(docs, texts, keep_first):
    key = lambda line: line.strip("\t\n\x0b\f\r ").translate(str.maketrans(UPPER, LOWER))
    where = defaultdict(list)
    for i, text in enumerate(texts):
        for p, line in enumerate((text or "").split("\n")):
            if key(line):
                where[key(line)].append((i, p))
    gone = {k: sorted(v)[keep_first:] for k, v in where.items() if len({i for i, _ in v}) >= 3}
    lost = {at for v in gone.values() for at in v}
    got = {r["doc_id"]: (r["_n_lines"], r["_kept"]) for r in lines.dedup_lines(docs, min_docs=3, keep_first=keep_first).collect()}
    same = texts.index("same text here ok")
    for i, text in enumerate(texts):
        parts = (text or "").split("\n")
        if text != texts[same]:
            assert got[i] == (len(parts), "\n".join(x for p, x in enumerate(parts) if (i, p) not in lost))


def test_quality_learns_and_scores_all(spark):
    rng = random.Random(4)
    good = [" ".join(rng.choices(["the", "of", "word", "text"], k=40)) + "." for _ in range(60)]
    bad = ["$$$ ".join(rng.choices(["the", "of", "word"], k=40)) for _ in range(60)]
    rows = [(i, t, len(t)) for i, t in enumerate([*good, *bad])] + [(500, None, None), (501, "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(0, 120, 2)] + [(1, None)], "doc_id long, quality int")
    model = quality.train(docs, labels, metadata=("n_chars",))
    scored = {r["doc_id"]: r["s"] for r in docs.select("doc_id", quality.score(model, "text", "n_chars").alias("s")).collect()}
    assert all((scored[i] >= 0.5) == (i < 60) for i in range(120)) and all(0 <= scored[i] <= 1 for i in (500, 501))
    assert quality.train(docs, labels.limit(0)).w0 == 0.0


def test_queries_have_contract_columns():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(queries.oracle_sql()) <= names


def test_pipeline_keeps_one_of_each_group(spark):
    import corpus_pipeline

    docs = spark.createDataFrame(
        [(1, "a b c d e", "en", "s", 9), (2, "a b c d e", "en", "s", 9), (3, "other words are here", "en", "s", 20)] * 2,
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    kept = corpus_pipeline.keep_one_of_group(spark, docs, "")
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    assert simhash.near_duplicates(none).count() == 0
    assert packing.pack(none, packing.count_words("text")).count() == 0
    assert lines.dedup_lines(none).count() == 0
    assert digests.map_with_next(none, lambda t: [[x[0] for x in t]], "a long").count() == 0
    assert suffix_tree.score(none, F.lit(False)).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_packing_spreads_one_repeated_or_null_id(spark):
    from pyspark.sql import functions as F

    same = spark.range(300).select(F.when(F.col("id") % 2 == 0, F.lit(7)).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    rows = packing.pack(same, packing.count_words("text"), max_len=16, buckets=2, budget=8).collect()
    assert len(rows) == 300 and sorted(r["doc_id"] for r in rows if r["doc_id"] is not None) == [7] * 150
    batches = defaultdict(int)
    for r in rows:
        batches[r["batch_id"]] += 1
    assert sorted(batches) == list(range(len(batches))) and sorted(batches.values())[:-1] == [2] * (len(batches) - 1)


def near_and_far(seed=4, dims=64):
    """Unclustered vectors and chains around the threshold, most of whose length lies in few directions for some."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(400, dims)) * np.where(np.arange(400)[:, None] < 200, 1, 3.0 / np.arange(1, dims + 1))
    for k in range(160):
        v = x[k * 2] / np.linalg.norm(x[k * 2])
        side = rng.normal(size=dims)
        side -= (side @ v) * v
        turn = np.arccos(0.95) + rng.choice([-0.2, -1e-3, 1e-3, 0.1])
        x = np.vstack([x, np.cos(turn) * v + np.sin(turn) * side / np.linalg.norm(side)])
    return np.vstack([x, x[:20] * 2]).astype(np.float32)


def test_long_vectors_equal_brute_force_and_blocks_are_not_shuffled(spark, monkeypatch):
    x = near_and_far()
    units = np.stack([vectors.unit(v) for v in x])
    close = list(zip(*np.nonzero(np.triu(units @ units.T >= 0.95, 1))))
    n = Counter(int(i) for pair in close for i in pair)
    assert 100 < len(n) < len(x)
    plans, store = {}, vectors.store

    def told(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(vectors, "store", told)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = vectors.near_duplicates(df, sample=40, centres=5, block=16)
    assert sorted(map(tuple, found.collect())) == [(i, n[i], c) for i, c in enumerate(groups(len(x), close))]
    assert "Exchange" in plans["nodes"] and "Exchange" not in plans["links"]  # the vectors of a pair of blocks are read, not shuffled


def test_swept_shuffles_restores_the_setting(spark):
    from ticketlens.llm.common import swept_shuffles

    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    with swept_shuffles(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == before
