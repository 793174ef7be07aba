"""NULLs, empty and very long texts, ties, repeated rows, empty tables, clashing columns, and planted cases."""

import random
import struct
import tracemalloc
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import chat, codec, components, fingerprints as fpr, linededup, packing, quality, queries as q, sharding, simhash, tokencount, vectors

LINE = "the same line stands here"
ODD = {
    1: None, 2: "", 3: " \n\t ", 4: "one", 5: LINE, 6: f"  {LINE.upper()}\nother text of this document", 7: f"{LINE}\n{LINE}\nend\n",
    8: "x" * 9 + "\n" + "x" * 9, 9: "x" * 9, 10: "Straße ΣΑΣ İstanbul naïve café   \x1c!   don't <|endoftext|>x <|startoftext|>",
    11: "word " * 20_000 + "end", 12: "y" * 50_000, 13: "a  b\n c \r\n\td 👍🏽 日本語 ①½ é", 14: "alpha beta gamma delta epsilon zeta", 15: "alpha beta gamma delta epsilon zeta",
    -(2**63): "least id", 2**62: "large id",
}


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, "kept as it is", 7, 1.5) for d, t in ODD.items()]
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, n_lines int, th double").repartition(3)


@pytest.fixture(scope="module")
def doubled(spark):
    """Repeated rows, one id for two texts, NULL ids."""
    rows = [(1, LINE), (1, LINE), (2, "other " + LINE), (2, LINE), (None, LINE), (None, LINE), (None, None), (3, None)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def every(spark, docs):
    """Each document operator on ``docs``: name -> rows."""
    return {
        "fingerprints": fpr.edited_pairs(docs).collect(), "shards": sharding.shard_by_size(docs, 4).collect(),
        "lines": linededup.drop_repeated_lines(docs).collect(), "quality": quality.resample(docs, labels(spark)).collect(),
        "counts": tokencount.count_tokens(docs, q.WORD_BPE).collect(), "pieces": packing.pack(docs, q.WORD_BPE).collect(),
        "codec": codec.decode(codec.encode(docs, q.BYTE_BPE), q.BYTE_BPE).collect(), "simhash": simhash.near_duplicates(docs).collect(),
        "copies": simhash.drop_near_duplicates(docs).collect(),
    }


def test_empty_tables(spark, none):
    assert {k: len(v) for k, v in every(spark, none).items()} == dict.fromkeys(every(spark, none), 0)
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(empty)).count() == 0


def test_repeated_rows_stay(spark, doubled):
    got = every(spark, doubled)
    for name in ("fingerprints", "shards", "lines", "quality", "counts", "codec", "simhash"):
        assert len(got[name]) == 8, name
    assert len(got["pieces"]) == 8
    assert [r["text"] for r in got["lines"] if r["doc_id"] == 1] == [LINE, LINE]
    assert len(got["copies"]) == 3  # the line, the longer text, the empty text
    assert {r["component_id"] for r in got["simhash"] if r["doc_id"] == 1} == {1}


def test_odd_texts(spark, odd):
    docs = {d: t for d, t in ODD.items()}
    word, byte = Tokenizer.from_file(q.WORD_BPE), Tokenizer.from_file(q.BYTE_BPE)
    for r in tokencount.count_tokens(odd, q.WORD_BPE).collect():
        assert r["n_tokens"] == len(word.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids), r
    for r in codec.decode(codec.encode(odd, q.BYTE_BPE), q.BYTE_BPE).collect():
        ids = byte.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["ids"] == struct.pack(f"<{len(ids)}I", *ids) and r["text"] == (docs[r["doc_id"]] or "")
    pieces = {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packing.pack(odd, q.WORD_BPE).collect()}
    assert pieces == {(d, *p) for d, t in docs.items() for p in brute.pack_ids(word.encode(t or "", add_special_tokens=False).ids + [1])}
    lines = linededup.drop_repeated_lines(odd)
    assert lines.columns == [*odd.columns, "n_lines_", "n_dropped"]
    want = brute.line_dedup(docs)
    for r in lines.collect():
        assert (r["n_lines_"], r["n_dropped"], brute.sha(r["text"])) == want[r["doc_id"]] and r["shard"] == "kept as it is" and r["n_lines"] == 7
    edited = brute.edited_texts(docs)
    for r in fpr.edited_pairs(odd).collect():
        assert r["edited"] == edited[r["doc_id"]]
    fps = {d: brute.simhash(t) for d, t in docs.items()}
    comp = brute.roots(list(fps), [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    got = {r["doc_id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(odd).collect()}
    assert got == {d: (fps[d], comp[d]) for d in docs}
    shards = sharding.shard_by_size(odd, 4)
    assert set(odd.columns) < set(shards.columns) and shards.count() == len(ODD)


def test_random_texts_tokenize_like_the_library(spark):
    rng = random.Random(5)
    alphabet = list("aAbé ßΣ'sdl \n\t  .,!<|>09½́ 　日👍\x1c\x85")
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(1500)]
    texts += ["".join(rng.choices(["<|endoftext|>", "it's ", " don't", "  ", "\n", "WE'LL", "x"], k=6)) for _ in range(200)]
    word, byte = Tokenizer.from_file(q.WORD_BPE), Tokenizer.from_file(q.BYTE_BPE)
    counts, c, ids = tokencount.word_counts(q.WORD_BPE), codec.codec(q.BYTE_BPE), packing.piece_ids(q.WORD_BPE)
    for t in texts:
        want = word.encode(t, add_special_tokens=False).ids
        assert counts.text(t) == len(want), repr(t)
        assert ids.text(t) == struct.pack(f"<{len(want)}I", *want), repr(t)
        want = byte.encode(t, add_special_tokens=False).ids
        assert c.encode(t) == struct.pack(f"<{len(want)}I", *want), repr(t)
        assert c.decode(c.encode(t)) == byte.decode(want, skip_special_tokens=False)


def test_long_words_merge_alike():
    rng = random.Random(3)
    c, byte = codec.codec(q.BYTE_BPE), Tokenizer.from_file(q.BYTE_BPE)
    for text in ("ab" * 3000, "".join(rng.choices("etaoin", k=5000)), "a" * 3001):
        want = byte.encode(text, add_special_tokens=False).ids
        assert c.encode(text) == struct.pack(f"<{len(want)}I", *want)


def test_vectors_with_planted_links(spark, sf):
    base = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").limit(150).collect()]
    rng = np.random.default_rng(4)
    rows = list(base)
    for i, (_, v, lab) in enumerate(base[:60]):
        for j in range(1 + i % 4):
            noise = rng.normal(size=len(v)) * np.linalg.norm(v) / np.sqrt(len(v)) * rng.choice([0.05, 0.12, 0.2])
            rows.append((1000 + 10 * i + j, [float(np.float32(x)) for x in np.array(v) + noise], lab))
    hot = base[0]
    rows += [(5000 + i, [float(np.float32(x)) for x in np.array(hot[1]) + rng.normal(size=len(hot[1])) * 0.002], hot[2]) for i in range(700)]
    rows += [(7000 + i, hot[1], hot[2]) for i in range(40)]
    rows += [(8000, None, 1), (8001, [], 1), (8002, [0.0] * 64, 1), (8003, [float("nan")] * 64, 1), (8004, [None] * 64, 1), (8005, hot[1], None),
             (8006, [1.0], hot[2]), (8007, [2.0], hot[2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute.vector_links([(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vectors.near_duplicates(df, chunk=128).collect()}
    assert set(got) == set(want)
    assert all(got[i][0] <= want[i][0] for i in want)
    true = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.98 * true and true > 100_000
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)


@pytest.mark.parametrize("dim", [32, 64, 300, 768])
def test_recall_of_links_near_the_bound(spark, dim):
    rng = np.random.default_rng(dim)
    rows, pairs = [], 0
    for i in range(400):
        x = rng.normal(size=dim)
        x /= np.linalg.norm(x)
        y = rng.normal(size=dim)
        y -= (y @ x) * x
        y /= np.linalg.norm(y)
        cosine = [0.9801, 0.985, 0.99][i % 3]
        size = 10.0 ** rng.integers(-150, 150)
        rows += [(2 * i, (size * x).tolist(), 1), (2 * i + 1, (3 * size * (cosine * x + np.sqrt(1 - cosine ** 2) * y)).tolist(), 1)]
        pairs += 1
    rows += [(10_000, [1e200] * dim, 1), (10_001, [2e200] * dim, 1), (None, [1e-200] * dim, 1)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, rep string, n int")
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df).collect()}
    assert sum(got[2 * i + 1]["component_id"] == 2 * i for i in range(400)) >= 0.97 * pairs
    assert got[10_000]["n_links"] == got[10_001]["n_links"] == got[None]["n_links"] == 2 and got[None]["component_id"] == 10_000


def test_components_of_chains_and_stars(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 400)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000)]
    links += [(rng.randrange(6000, 6200), rng.randrange(6000, 6200)) for _ in range(120)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = brute.roots({x for l in links for x in l}, links)
    same = {}
    for n, r in got.items():
        assert same.setdefault(want[n], r) == r
    assert len(set(same.values())) == len(same)
    assert set(got) == {x for a, b in links if a != b for x in (a, b)}


def test_full_buckets_lose_no_link(spark):
    rng = random.Random(2)
    base = rng.getrandbits(63)
    fps = {base}
    while len(fps) < 400:
        f = rng.choice(sorted(fps)[:50])
        for _ in range(rng.choice([1, 2, 3])):
            f ^= 1 << rng.randrange(62)
        fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for distance in (1, 2):
        true = brute.roots(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= distance])
        for bucket in (4, 1000):
            found = [(r["a"], r["b"]) for r in simhash.links(df, distance, bucket).collect()]
            assert all((a ^ b).bit_count() <= distance for a, b in found)
            assert brute.roots(fps, found) == true
    found = [(r["a"], r["b"]) for r in simhash.wide_links(df, 3, 8, 5, bucket=8, chunk=50).collect()]
    assert brute.roots(fps, found) == brute.roots(fps, [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if (a ^ b).bit_count() <= 3])


def test_exploded_keys_are_not_broadcast(spark, monkeypatch):
    """Spark sizes exploded rows as the rows before, so even small fingerprints may not make it broadcast their keys."""
    plans, store = {}, simhash.materialize

    def caught(df, label):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, label)

    monkeypatch.setattr(simhash, "materialize", caught)
    fps = store(spark.range(300).select((F.col("id") % 150 * 3).alias("fp")).distinct(), "fps")
    assert simhash.links(fps).count() > 0 and simhash.wide_links(fps, 3, 8, 5).count() > 0
    for label in ("simhash-blocks", "wide-blocks"):
        assert "SortMergeJoin" in plans[label] and "Broadcast" not in plans[label], label


def test_pipeline_near_copies(spark):
    """Copies of a similarity of 0.8 or more go, others stay: exact groups by brute force, chunks of three texts included."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    sets = {d: brute.shingle_set(t or "") for d, t in docs.items()}
    by = {}
    for d, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(d)
    near = {(a, b) for ds in by.values() if len(ds) < 40 for a in ds for b in ds if a < b}
    links = [(a, b) for a, b in near if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    want = brute.roots(list(docs), links)
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    first = {d for d, c in want.items() if d == c}
    assert first <= kept
    assert len(kept - first) <= 0.1 * (len(docs) - len(first))


def test_pipeline_meets_cut_appended_and_short_copies(spark):
    """Planted copies at a similarity of 0.8 or more, cut or appended at their end or edited in one block: none is kept."""
    texts = [r["text"].split() for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r["text"]]
    texts = [w for w in texts if len(w) >= 8]
    shorter = [w[:8 + i % 43] for i, w in enumerate(texts[:300])]
    rng, rows, planted = random.Random(5), [], Counter()
    for i, w in enumerate([*texts, *shorter]):
        n = len(w) - 4
        one = [f"new{i}x{j}" for j in range(n // 4)]
        at = rng.randrange(1, max(2, len(w) - n // 12 - 1))
        copies = {"cut": w[:len(w) - n // 6], "appended": w + one[:n // 5], "edited": w[:at] + one[:max(1, n // 14)] + w[at + max(1, n // 14):]}
        source = brute.shingle_set(" ".join(w))
        rows.append((i, " ".join(w)))
        for k, (kind, copy) in enumerate(copies.items(), 1):
            other = brute.shingle_set(" ".join(copy))
            if copy != w and len(source & other) >= 0.8 * len(source | other):
                planted[kind, len(w) > 50] += 1
                rows.append((i + 1_000_000 * k, " ".join(copy)))
    assert len(planted) == 6 and min(planted.values()) > 5
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    assert kept.where("doc_id >= 1000000").count() == 0


def test_band_keys_are_even():
    """Single least hashes agree as often as the similarity says; equal texts share all keys, the fingerprint is the plain one."""
    words = [f"w{i}" for i in range(1000)]
    first = " ".join(words).encode()
    fp, keys = simhash.fingerprint_and_bands(first, 1)
    assert fp == simhash.simhash(first, 1, distinct=True) and len(set(keys)) == simhash.BANDS
    assert (simhash.fingerprint_and_bands(first.upper() + b" w3", 1)[1] == keys).all()
    hits = [
        (simhash.fingerprint_and_bands(" ".join(f"{i}-{w}" for w in words[:900]).encode(), 1)[1]
         == simhash.fingerprint_and_bands(" ".join(f"{i}-{w}" for w in words[100:]).encode(), 1)[1]).mean() for i in range(60)]
    assert abs(np.mean(hits) - 0.8**simhash.DEPTH) < 0.04


def test_histogram_sort_cuts_only_large_groups(spark):
    rows = [(i, f"text {i}" * (1 + i % 7)) for i in range(2000)] + [(5000 + i, "a copy that many rows share") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_by_size(df, 8, keep=0.1).collect()
    size = [sum(r["size"] for r in got if r["shard"] == s) for s in range(8)]
    assert max(size) - min(size) < 0.02 * sum(size) / 8 + 60
    by = {}
    for r in got:
        by.setdefault(r["text"], set()).add(r["shard"])
    assert sum(len(s) > 1 for s in by.values()) == 1  # only the hot group
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))


def test_gumbel_top_k(spark):
    df = spark.createDataFrame([(i, f"w{i % 50} x{i % 7}") for i in range(500)], "doc_id long, text string")
    got = quality.resample(df, labels(spark), k=100).collect()
    kept = sorted(r["sort_key"] for r in got if r["kept"])
    assert len(kept) == 100 and kept[0] >= max(r["sort_key"] for r in got if not r["kept"])


def test_sketches(spark):
    a, b = " ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(1500, 4500))
    df = spark.createDataFrame([(1, a), (1, b), (2, None)], "g int, text string").withColumn("fingerprint", fpr.fingerprint(F.coalesce("text", F.lit(""))))
    whole = spark.createDataFrame([(a,), (b,)], "text string").select(fpr.shingle_hashes(F.col("text")).alias("h"))
    least = sorted({h for r in whole.collect() for h in r["h"]})[:fpr.K]
    merged = {r["g"]: r["fingerprint"] for r in fpr.merge_fingerprints(df, ["g"]).collect()}
    assert merged[1] == least
    x, y = (r["fingerprint"] for r in df.where("g = 1").collect())
    one = spark.createDataFrame([(x, y)], "x array<bigint>, y array<bigint>").select(
        fpr.resemblance(F.col("x"), F.col("y")).alias("j"), fpr.containment(F.col("x"), F.col("y")).alias("c"),
        fpr.distinct_count(F.col("x")).alias("n"), fpr.merged(F.col("x"), F.col("y")).alias("m")).first()
    assert abs(one["j"] - 1 / 3) < 0.13 and abs(one["c"] - 0.5) < 0.17 and abs(one["n"] / 2996 - 1) < 0.25 and one["m"] == least


def test_chat_machine(spark):
    rows = [
        (1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", "a <|im_end|> <\\|x <\\\\| b"), (2, 0, "assistant", "first"),
        (3, 1, "user", "b"), (3, 1, "user", "a"), (3, None, "user", "c"), (4, 0, None, None), (None, 0, "user", "no id"), (5, 0, "us<|er", "x<"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("loss", F.lit("clash"))
    segments = chat.format_conversations(df)
    got = {r["conv_id"]: r for r in chat.read_back(segments).collect()}
    turns = {1: rows[0:3], 2: rows[3:4], 3: [rows[6], rows[5], rows[4]], 4: rows[7:8], None: rows[8:9], 5: rows[9:10]}
    for c, t in turns.items():
        assert tuple(got[c])[1:5] == brute.chat_digests([(r[2], r[3]) for r in t])
    assert {c: r["valid"] for c, r in got.items()} == {1: True, 2: False, 3: False, 4: False, None: True, 5: False}
    assert all("<|" not in chat.escape(t) and chat.unescape(chat.escape(t)) == t for t in ("<|", "<\\|", "<<|||", "<\\\\|<|", "|<", "\\|"))


@pytest.mark.parametrize("histogram", [{}, {1: 1}, {4096: 3}, {1: 5000}, {2049: 7, 2047: 6}, {n: n % 13 for n in range(1, 4097, 3) if n % 13}])
def test_plans_are_exact(histogram):
    plan = packing.plan_sequences(histogram)
    got = {}
    for config, m in plan:
        assert m > 0 and sum(n * c for n, c in config) <= 4096
        for n, c in config:
            got[n] = got.get(n, 0) + c * m
    assert got == histogram
    total = sum(n * c for n, c in histogram.items())
    assert sum(m for _, m in plan) <= -(-total // 4096) * 1.02 + 1


@pytest.mark.parametrize("times", [1, 27, 3000])
def test_linear_program_places_most_tokens(spark, times):
    """On the lengths of the tables; best fit alone is what the totals are held against."""
    cut = packing.pieces(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), q.WORD_BPE, with_ids=False) if not LENGTHS else None
    if cut is not None:
        LENGTHS.update({r["length"]: r["count"] for r in cut.groupBy("length").count().collect()})
    histogram = {n: c * times for n, c in LENGTHS.items()}
    tokens = sum(n * c for n, c in histogram.items())
    placed, _ = packing.planned(histogram, 4096)
    assert sum(m * sum(n * c for n, c in config) for config, m in placed) > 0.8 * tokens
    total = sum(m for _, m in packing.plan_sequences(histogram))
    assert total <= 1.0001 * sum(m for _, m in packing.best_fit(histogram, 4096)) + 1


LENGTHS: dict[int, int] = {}


def test_shifted_solution_covers_with_few_configurations():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.choice(np.arange(50, 3000), 40, replace=False))
    demand = rng.integers(20, 500, 40).astype(float)
    first = packing.configurations(demand, lengths, 4096)
    found = packing.few_configurations(first, demand, lengths, 4096)
    assert len(found) <= 40 and all((c * lengths).sum() <= 4096 and x > 0 for c, x in found)
    assert np.allclose(sum(x * c for c, x in found), demand, rtol=1e-6)
    covered = sum(a * np.bincount(np.frombuffer(r, np.int32), minlength=40) for r, a in first.items())
    assert sum(x for _, x in found) <= sum(first.values()) + (np.maximum(0, demand - covered) / (4096 // lengths)).sum() + 1e-6


def test_tables_of_seen_pieces_are_bounded():
    """Texts without blanks are one piece each: nothing of them may stay."""
    letters = [chr(0x4E00 + i) for i in range(3000)]
    rng = random.Random(9)
    for make in (lambda: tokencount.WordCounts(q.WORD_BPE), lambda: packing.PieceIds(q.WORD_BPE), lambda: codec.Codec(q.BYTE_BPE)):
        table = make()
        encode = table.encode if hasattr(table, "encode") else table.text
        encode("some words before")
        tracemalloc.start()
        for _ in range(300):
            encode("".join(rng.choices(letters, k=2000)) + " " + "%x" % rng.getrandbits(8000))
        grown = tracemalloc.get_traced_memory()[0]
        tracemalloc.stop()
        assert grown < 8 << 20 and max(map(len, table)) <= tokencount.KEPT_LETTERS


def test_full_tables_turn_over(monkeypatch):
    monkeypatch.setattr(tokencount, "KEPT_BYTES", 20_000)
    monkeypatch.setattr(codec, "KEPT_BYTES", 20_000)
    monkeypatch.setattr(packing, "KEPT_BYTES", 10_000)
    counts, ids, c = tokencount.WordCounts(q.WORD_BPE), packing.PieceIds(q.WORD_BPE), codec.Codec(q.BYTE_BPE)
    word, byte = Tokenizer.from_file(q.WORD_BPE), Tokenizer.from_file(q.BYTE_BPE)
    rng = random.Random(2)
    for _ in range(300):
        text = " ".join("".join(rng.choices("abcdefg", k=4)) for _ in range(12))
        want = word.encode(text, add_special_tokens=False).ids
        assert counts.text(text) == len(want) and ids.text(text) == struct.pack(f"<{len(want)}I", *want)
        want = byte.encode(text, add_special_tokens=False).ids
        assert c.encode(text) == struct.pack(f"<{len(want)}I", *want)
    assert max(len(counts), len(counts.old), len(ids), len(c), len(c.fragments)) <= 120


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
        docs = out
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert placed.select("doc_id").distinct().count() == docs.count()
