"""The whole pipeline on a small corpus against a plain Python version of its stages."""

import random
import re
from collections import Counter

import pytest

import corpus_pipeline
from gradeloom.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(8)
    words, bad = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(400)], ["scum", "vile", "filth", "wretch"]
    item = " ".join(f"quiz{chr(97 + k)}" for k in range(20))

    def prose(n):
        return [rng.choice(words) for _ in range(n)]

    rows, labels = [], []
    for k in range(400):
        text = prose(70)
        if k % 8 == 0:
            for w in rng.sample(bad, 3):
                text.insert(rng.randrange(len(text)), w)
        body = " ".join(text)
        if k % 25 == 3:
            body += "\n" + item.upper() + "."
        rows.append([k, "shared footer line\n" + body if k % 3 else body])
        if k % 2 == 0:
            labels.append((k, 0, int(k % 8 == 0)))
    for k in range(60):  # copies, exact and with one word changed
        text = rows[10 + k][1]
        rows.append([1000 + k, text if k % 2 else text.replace(text.split()[40], "changed", 1)])
    rows.append([2000, None])
    rows.append([2001, ""])
    return rows, labels, item, bad


def words_of(text):
    return text.split()


def runs(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(rows, item, bad):
    """Kept documents after the four filtering stages."""
    kept = {k: t for k, t in rows if not (set((t or "").split()) & set(bad))}
    pages = {t for t in kept.values() if t is not None}
    count = Counter(line.strip(" \t\r") for t in pages for line in set(t.split("\n")))
    drop = {line for line, n in count.items() if line and n >= 3 and n > 0.05 * len(pages)}
    kept = {k: t if t is None else "\n".join(x for x in t.split("\n") if x.strip(" \t\r") not in drop) for k, t in kept.items()}
    root = {k: k for k in kept}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    sets, keys = {k: runs(t) for k, t in kept.items() if t}, sorted(kept)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            same = kept[a] == kept[b]
            if not same and a in sets and b in sets:
                shared = len(sets[a] & sets[b])
                same = shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared)
            if same:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = {k: kept[k] for k in keys if find(k) == k}
    wanted = re.findall(r"\w+", item.lower())
    return {k: t for k, t in kept.items() if " ".join(wanted) not in " ".join(re.findall(r"\w+", (t or "").lower()))}


def test_pipeline_against_plain_python(spark, tmp_path):
    rows, labels, item, bad = corpus()
    folder = str(tmp_path)
    spark.createDataFrame([(k, t, "en", "s", len(t or "")) for k, t in rows], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    want = plain([tuple(r) for r in rows], item, bad)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        docs = corpus_pipeline.written(docs, "test")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in docs.collect()}
    assert {k: t for k, (t, _) in got.items()} == want
    assert all(n == len(t or "") for t, n in got.values())
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    encode = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert {r["doc_id"] for r in out} == set(want)
    assert sum(r["length"] for r in out) == sum(len(encode(t or "")) // 4 + 1 for t in want.values())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]
