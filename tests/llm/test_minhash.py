import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from citeloom.llm import minhash
from citeloom.scratch import Scratch
from tests.llm.conftest import CLASHES, ODD_ROWS, frame, prose


def weighted(texts):
    """TF-IDF weights of the shingles of distinct texts."""
    sets = {}
    for text in texts:
        words = text.lower().split()
        size = min(5, len(words))
        sets[text] = Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()
    df = Counter(s for own in sets.values() for s in own)
    n = len(sets)
    return {
        t: {s: c * (1 + 0.1 * math.log((n + 1) / (df[s] + 1)) / math.log(n + 2)) for s, c in own.items()}
        for t, own in sets.items()
    }


def brute(rows):
    """Class of every row by comparing all pairs of texts."""
    weights = weighted({t or "" for _, t in rows})
    texts = list(weights)
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, t in enumerate(texts):
        for s in weights[t]:
            holders[s].append(i)
    total = [sum(weights[t].values()) for t in texts]
    for i, j in {(i, j) for own in holders.values() for i in own for j in own if i < j}:
        a, b = weights[texts[i]], weights[texts[j]]
        both = sum(min(w, b[s]) for s, w in a.items() if s in b)
        if both / (total[i] + total[j] - both) >= 0.8:
            parent[root(i)] = root(j)
    first = {}
    for doc_id, text in rows:
        c = root(texts.index(text or ""))
        if doc_id is not None:
            first[c] = min(first.get(c, doc_id), doc_id)
    return [(doc_id, first.get(root(texts.index(text or "")))) for doc_id, text in rows]


def edited(text, rng, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(["zzyzx", "qwop", "blorb"])
    return " ".join(words)


def family(seed, members, words=150, edits=1):
    rng = random.Random(seed)
    own = prose(seed, words)
    return [own] + [edited(own, rng, edits) for _ in range(members - 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, scratch, seed):
    rng = random.Random(seed)
    texts = [prose(1000 + i, rng.randint(1, 120)) for i in range(60)]
    for f in range(8):
        texts += family(f, rng.randint(2, 6), edits=rng.randint(1, 4))
    texts += family(77, 40) + family(78, 60, 100, 3)  # large buckets, the second of loose copies
    texts += [texts[3]] * 7
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = minhash.classes(frame(spark, rows), scratch).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == sorted(brute(rows))
    sizes = Counter(c for _, c in brute(rows))
    assert all(r["class_size"] == sizes[r["class_id"]] for r in got)


def test_several_classes_in_one_bucket(spark, scratch, monkeypatch):
    """Texts that share a bucket but not the leader's class are compared with all of it."""
    monkeypatch.setattr(minhash, "SMALL_BUCKET", 2)
    monkeypatch.setattr(minhash, "LEFT_BLOCK", 3)
    monkeypatch.setattr(minhash, "ALL_BLOCK", 7)
    monkeypatch.setattr(minhash, "BANDS", 1)
    families = [family(500 + f, 5) for f in range(6)]
    rows = list(enumerate(t for own in families for t in own))
    texts = {minhash_key(t): i for i, t in rows}
    weights = weighted([t for _, t in rows])
    vectors = []
    shingle = minhash.Shingler()
    for _, t in rows:
        h, _ = shingle(t)
        known = dict(zip(h.tolist(), [1.0] * len(h)))
        vectors.append(
            (minhash_key(t), float(len(known)), 1.0, h.tobytes(), np.ones(len(h), np.float32).tobytes(), [7])
        )
    table = spark.createDataFrame(vectors, "key string, total double, centre double, hashes binary, weights binary, bands array<long>")
    found = minhash.links(scratch.keep(table, "given"), scratch, 0.8).collect()
    joined = [{texts[r["a"]] // 5, texts[r["b"]] // 5} for r in found]
    assert weights and all(len(pair) == 1 for pair in joined)
    for f in range(6):
        reached, edges = {f * 5}, [(texts[r["a"]], texts[r["b"]]) for r in found]
        for _ in range(5):
            reached |= {b for a, b in edges if a in reached} | {a for a, b in edges if b in reached}
        assert reached == set(range(f * 5, f * 5 + 5))


def minhash_key(text):
    import hashlib

    return hashlib.md5(text.encode()).hexdigest()


def test_samples_agree_as_often_as_sets_do():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    a, b = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    a[250:], b[:40] = 1e-9, 1e-9
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sampler = minhash.Sampler(4000)
    same = (sampler(hashes, a) == sampler(hashes, b)).mean()
    assert abs(same - want) < 4 * math.sqrt(want * (1 - want) / 4000)
    long = rng.integers(0, 1 << 63, 10_000, dtype=np.uint64)
    order = rng.permutation(10_000)
    ones = np.ones(10_000)
    assert (minhash.Sampler(8)(long, ones) == minhash.Sampler(8)(long[order], ones)).all()


def test_odd_documents(odd, none, scratch):
    got = minhash.classes(odd, scratch).select("doc_id", "class_id").collect()
    rows = [r[:2] for r in ODD_ROWS]
    assert sorted(map(tuple, got), key=repr) == sorted(brute(rows), key=repr)
    assert minhash.classes(none, scratch).collect() == []


def test_one_of_each_class_stays(odd, none, spark, scratch):
    kept = minhash.keep_one(odd, scratch)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 3, 4, 7, 8, 9, 10, 11, None], key=repr)
    assert minhash.keep_one(none, Scratch(spark, "none")).collect() == []
    assert CLASHES[1] in kept.columns


def test_columns_of_any_name_are_kept(odd, scratch, tmp_path, spark):
    odd.withColumnsRenamed({"key": "_file", "part": "_row", "size": "one"}).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    kept = minhash.keep_one(docs, scratch)
    assert kept.columns == docs.columns and {r["_file"] for r in kept.collect()} == {"x"}
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([1, 3, 4, 7, 8, 9, 10, 11, None], key=repr)
