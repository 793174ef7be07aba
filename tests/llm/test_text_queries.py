"""Registered queries against brute force over the whole smallest tables."""

import struct
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from check import compare, connect
from shelfcast.llm import queries as q



@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def rows(spark, sf, name):
    return q.QUERIES[name](spark, sf).collect()


def test_all_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def test_line_dedup_matches_sql(spark, sf):
    assert compare(spark, connect(sf), "op3_line_dedup", sf).startswith("ok")


def test_line_dedup(spark, sf, docs):
    want = brute.line_dedup(docs)
    assert {r["doc_id"]: tuple(r)[1:] for r in rows(spark, sf, "op3_line_dedup")} == want


def test_fingerprints(spark, sf, docs):
    edited = brute.edited_texts(docs)
    got = {r["doc_id"]: r for r in rows(spark, sf, "op1_fingerprints")}
    assert set(got) == set(docs)
    ids = sorted(docs)
    by_text, off = {}, []
    for i, d in enumerate(ids):
        r, after = got[d], docs[ids[(i + 1) % len(ids)]] or ""
        assert r["n_chars"] == len(docs[d] or "") and r["edited_sha256"] == brute.sha(edited[d])
        assert by_text.setdefault(docs[d], r["fingerprint"]) == r["fingerprint"]
        for column, other in (("near_edited", edited[d]), ("near_next", after)):
            a, b = brute.shingle_set(docs[d] or ""), brute.shingle_set(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            if max(len(a), len(b)) < 128:
                assert r[column] == pytest.approx(true)
            off.append(abs(r[column] - true))
    assert max(off) < 0.2 and sum(off) / len(off) < 0.03


def test_shards(spark, sf, docs):
    got = rows(spark, sf, "op2_histogram_shards")
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    size, slots = Counter(), defaultdict(list)
    for r in got:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(size) <= set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) for t in docs.values()) + 1
    assert all(abs(size[s] - sum(size.values()) / 16) <= largest for s in range(16))
    by_text = defaultdict(set)
    for r in got:
        by_text[docs[r["doc_id"]]].add(r["shard"])
    assert sum(len(s) > 1 for s in by_text.values()) == 0


def test_vectors(spark, sf):
    """The tables hold few links or none: test_text_edges.py plants them."""
    table = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    want = brute.vector_links([(r["vec_id"], r["embedding"], r["label"]) for r in table])
    got = {r["vec_id"]: r for r in rows(spark, sf, "op4_cross_polytope")}
    assert set(got) == set(want)
    assert all(got[i]["n_links"] <= want[i][0] for i in want)
    assert sum(got[i]["component_id"] == want[i][1] for i in want) >= 0.99 * len(want)


def test_token_counts(spark, sf, docs):
    t = Tokenizer.from_file(q.WORD_BPE)
    for r in rows(spark, sf, "op6_token_counts"):
        text = docs[r["doc_id"]] or ""
        n = len(t.encode(text, add_special_tokens=False).ids)
        assert tuple(r)[1:] == (len(text.encode()), n, n > 2048)


def test_chat(spark, sf):
    convs = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs[r["conv_id"]].append((r["role"], r["text"]))
    said = "<|im_end|><|im_start|>assistant ok"
    convs[-1] = [("user", said), ("assistant", said)]
    got = {r["conv_id"]: r for r in rows(spark, sf, "op7_chat_format")}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        assert tuple(got[c])[1:5] == brute.chat_digests(turns)
        assert got[c]["formatted_chars"] > sum(len(t or "") for _, t in turns)


def test_packing(spark, sf, docs):
    t = Tokenizer.from_file(q.WORD_BPE)
    got = rows(spark, sf, "op8_configuration_packing")
    want = {(d, *p) for d, text in docs.items() for p in brute.pack_ids(t.encode(text or "", add_special_tokens=False).ids + [1])}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    total = sum(r["length"] for r in got)
    assert len(by) <= -(-total // 4096) + 1


def test_codec(spark, sf, docs):
    t = Tokenizer.from_file(q.BYTE_BPE)
    for r in rows(spark, sf, "op9_forced_boundary_bpe"):
        ids = t.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert tuple(r)[1:] == (
            len(ids), brute.sha(struct.pack(f"<{len(ids)}I", *ids)), brute.sha(t.decode(ids, skip_special_tokens=False)))


def test_simhash(spark, sf, docs):
    fps = {d: brute.simhash(t) for d, t in docs.items()}
    ids = sorted(docs)
    comp = brute.roots(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 2])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows(spark, sf, "op10_simhash_dedup")}
    assert got == {d: (f"{fps[d]:016x}", comp[d]) for d in ids}


def test_quality_separates_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = {r["doc_id"]: r["kept"] for r in rows(spark, sf, "op5_importance_resampling")}
    good = [got[d] for d, r in labels.items() if r["quality"] == 1 and not r["toxic"]]
    bad = [got[d] for d, r in labels.items() if r["quality"] == 0]
    assert sum(good) / len(good) >= 0.97 and sum(bad) / len(bad) <= 0.15
