"""Near-dedup by SimHash and embeddings, packing, archives and url filters on small fixtures."""

import random
import zlib

import numpy as np
import pytest
import xxhash

from gradeloom.llm import embedding_dedup, packing, simhash, url_filter, warc
from gradeloom.llm.common import components, fresh_path

public_tokenizers = pytest.importorskip("public_tokenizers")


def reach(links, nodes):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(frame).collect()}
    want = reach(links, {x for link in links for x in link})
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {n: c for n, c in want.items() if n in linked}
    assert components(frame.limit(0)).count() == 0


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    runs = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << k for k in range(64) if sum(v >> k & 1 for v in h) * 2 > len(h)) if h else 0


def test_simhash_against_brute_force(spark, monkeypatch, documents):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    base = [[rng.choice(words) for _ in range(250)] for _ in range(6)]
    texts = [None, "", "One", "one two", "ONE two", "\x0bone\ttwo "]
    for _ in range(200):
        text = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        texts.append(" ".join(text))
    rows = [(k, t, "a") for k, t in enumerate(texts)] + [(3, "one two", "a"), (None, texts[10], "a")]
    got = simhash.near_duplicates(documents(rows)).collect()
    prints = {t: brute_fingerprint(t) for _, t, _ in rows}
    codes = sorted(set(prints.values()))
    root = reach([(a, b) for i, a in enumerate(codes) for b in codes[i:] if (a ^ b).bit_count() <= 3], codes)
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[root[prints[t]]] = min(i, least.get(root[prints[t]], i))
    want = sorted((-1 if i is None else i, f"{prints[t]:016x}", least[root[prints[t]]]) for i, t, _ in rows)
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert simhash.near_duplicates(documents([])).count() == 0


def test_thresholds_add_up_and_find_all():
    rng = np.random.default_rng(0)
    blocks = [tuple(range(16 * k, 16 * k + 16)) for k in range(4)]
    shares = [np.full(17, 1 / 17) * w for w in (0.01, 1, 1, 1)]
    for n in (100, 10 ** 6, 10 ** 10):
        parts = simhash.allocated(n, 3, blocks, shares)
        assert sum(p.threshold + 1 for p in parts) > 3
        for _ in range(200):
            flips = set(rng.choice(64, 3, replace=False).tolist())
            assert any(len(flips.intersection(p.bits)) <= p.threshold for p in parts)


def jaccard(a, b):
    a, b = (({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}) for w in (a.split(), b.split()))
    return len(a & b) / len(a | b)


def test_one_of_each_group(spark, documents):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(3000)]
    rows, key = [], 0
    for _ in range(12):
        base = [rng.choice(words) for _ in range(200)]
        for _ in range(8):
            text = list(base)
            for _ in range(rng.randrange(4)):
                text[rng.randrange(200)] = rng.choice(words)
            rows.append((key, " ".join(text), "a"))
            key += 1
    rows += [(500, None, "a"), (501, None, "a"), (502, "", "a"), (503, "", "a"), (504, "alone here", "a"), (504, "alone here", "a"), (None, rows[0][1], "a"), (None, "no id", "a")]
    got = simhash.one_of_each_group(documents(rows))
    assert got.columns == documents([]).columns
    texts = {k: t for k, t, _ in rows if k is not None and k < 100}
    links = [(a, b) for a in texts for b in texts if a < b and jaccard(texts[a], texts[b]) >= 0.8]
    want = sorted({*reach(links, texts).values(), 500, 502, 504}) + [-1]
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in got.collect()) == sorted(want)


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    rows = [base[k % 60] + rng.normal(size=16) * rng.choice([0.02, 0.15, 0.3]) for k in range(400)]
    rows = [r.astype(np.float32) for r in rows]
    rows += [rows[0], rows[0], rows[7] * 2]
    data = [(k, r.tolist()) for k, r in enumerate(rows)]
    odd = [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, [1.0, 2.0]), (905, [float("inf")] * 16), (906, [])]
    frame = spark.createDataFrame([*data, *odd], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(frame, shard_rows=80, most_home=60).collect()}
    unit = np.stack(rows).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    root = reach(list(zip(*(x.tolist() for x in np.nonzero(close)), strict=True)), range(len(rows)))
    found = sum(got[k][0] for k in range(len(rows)))
    assert 0.98 * close.sum() <= found <= close.sum()
    assert sum(got[k][1] == root[k] for k in root) >= 0.98 * len(root)
    assert all(got[k] == (0, k, True) for k, _ in odd)
    assert embedding_dedup.near_duplicates(frame.limit(0)).count() == 0


def test_encoder_gives_the_ids_of_the_library():
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["", "a", " a", "a  b", "a \nb", "x\n y\n\n z", "don't I'll  we've", "日本 語", "<|endoftext|> a", "\xa0x \x1c y", "éa œuvre\n\tq  ", " \n"]:
        assert np.frombuffer(encode(text), "<u4").tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing(spark, documents):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choice(["tree", "house", "of", "x9"]) for _ in range(rng.randrange(1, 90))), "a") for k in range(300)]
    rows += [(900, None, "a"), (901, "", "a"), (902, "tree " * 400, "a"), (902, "tree " * 400, "a"), (None, "of", "a")]
    out = packing.pack_documents(documents(rows), path, capacity=128, chunk_items=120, generations=4).collect()
    encode = packing.encoder(path)
    for doc, text, _ in rows:
        ids = encode(text or "") + bytes(4)
        own = {(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out if r["doc_id"] == doc}
        assert sum(p[2] for p in own) == len(ids) // 4 and all(zlib.crc32(ids[4 * s:4 * (s + n)]) == c for _, s, n, c in own)
        assert all(n == 128 for p, _, n, _ in own if p > 0)
    by_sequence = {}
    for r in out:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 128
    assert len(by_sequence) <= 1.05 * sum(r["length"] for r in out) / 128 + 3
    assert packing.pack_documents(documents([]), path).count() == 0


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 100, 500).astype(np.int32)
    a, b = packing.packed(sizes, 128), packing.packed(sizes, 128, rng)
    for _ in range(20):
        child = packing.crossover(a, b, sizes, 128, rng)
        fill = np.bincount(child, weights=sizes)
        assert child.min() == 0 and fill.max() <= 128 and fill.min() > 0
        a, b = b, child


def test_archives(spark, tmp_path):
    long = "<p>" + "é" * 200
    pages = spark.createDataFrame([(5, "http://b.org/x y", long), (3, "http://a.org/", long), (4, None, None), (9, "http://c.org", "short"), (8, "u", "short"),
                                   (3, "http://a.org/", long), (None, "http://n.org/", long), (7, "http://d.org", "x" * 300_000)], "page_id long, url string, html string")
    folder = fresh_path(spark, "warc-test")
    files = warc.write(pages, folder, shard_bytes=100_000, roll_bytes=2_000)
    out = warc.read(spark, files).collect()
    assert len(out) == 8
    seen = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in out)
    assert seen == [(0, "revisit", 3), (3, "response", None), (3, "revisit", 3), (4, "response", None), (5, "revisit", 3), (7, "response", None), (8, "response", None), (9, "response", None)]
    assert all(r["payload_bytes"] == 403 for r in out if r["page_id"] == 5)
    assert {bytes(r["payload"]).decode() for r in out if r["page_id"] == 9} == {"short"}
    system, root = warc.filesystem(folder)
    names = sorted(f.base_name for f in system.get_file_info(warc.pafs.FileSelector(root)))
    assert "_MANIFEST.json" in names and "_temporary" not in names and len(names) == files.count() + 1
    again = warc.write(pages.repartition(5), fresh_path(spark, "warc-test"), shard_bytes=100_000, roll_bytes=2_000)
    assert {(r["name"], r["sha256"]) for r in again.collect()} == {(r["name"], r["sha256"]) for r in files.collect()}
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_url_filter(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    link = '<html><LINK href="{}" rel="canonical"><body>'.format
    pages = spark.createDataFrame([
        (1, "http://A.example.ORG/es/1?x", None), (2, "http://example.org", ""), (3, "https://x.com/de/1#f", ""), (4, None, ""), (5, "no scheme/de/", ""),
        (6, "http://mirror.net/1", link("https://x.com/de/1")), (7, "http://mirror.net/2", link("/1")), (8, "http://y.com/fr/1", link("https://x.com/de/1")),
        (9, "http://mirror.net/3", '<meta http-equiv="refresh" content="0; url=http://other.net/">'), (10, "http://notcom/de/", ""), (10, "http://notcom/de/", ""),
        (11, "http://?q", "")], "page_id long, url string, html string").withColumn("_key", url_filter.F.lit(1))
    out = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages, rules).collect()}
    assert out == {1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("example.org", "", None, "allow"), 3: ("x.com", "/de/1", "com/de/", "block"),
                   4: ("", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("mirror.net", "/1", None, "block"), 7: ("mirror.net", "/2", None, "block"),
                   8: ("y.com", "/fr/1", "com/fr/", "allow"), 9: ("mirror.net", "/3", None, "allow"), 10: ("notcom", "/de/", None, "allow"), 11: ("", "", None, "allow")}
    assert url_filter.judge(pages.limit(0), []).count() == 0
