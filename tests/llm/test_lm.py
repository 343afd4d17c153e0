import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from citeloom.llm import lm
from tests.llm.conftest import ODD_ROWS, frame

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END, START = object(), object()


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), END]


def fold(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7


def counts(docs):
    single, pair, before = Counter(), Counter(), Counter()
    for own in docs:
        for a, b in zip([START, *own], own):
            single[b] += 1
            pair[a, b] += 1
            before[a] += 1
    return single, pair, before


def brute(rows):
    """Counts, expectation-maximisation and scores over dictionaries."""
    docs = [(doc_id, tokens(text)) for doc_id, text in rows]
    train = [t for i, t in docs if fold(i) != 2]
    kept, deleted = [t for i, t in docs if fold(i) not in (2, 3)], [t for i, t in docs if fold(i) == 3]
    bucket = lambda c: 0 if c == 0 else int(math.log2(c)) + 1
    single, pair, before = counts(kept)
    n, v = sum(single.values()), len(single)
    cells = []
    for own in deleted:
        for a, b in zip([START, *own], own):
            c = before[a]
            cells.append((bucket(c), 1, pair[a, b] / max(c, 1), single[b] / max(n, 1)))
    weights = lm.learn(np.array(cells, dtype=float).reshape(-1, 4), 1 / (v + 1))
    single, pair, before = counts(train)
    n, v = sum(single.values()), len(single)
    out = []
    for doc_id, own in docs:
        base = sum(math.log10((single[t] + 1) / (n + v + 1)) for t in own)
        score = 0.0
        for a, b in zip([START, *own], own):
            w = weights[bucket(before[a])]
            score += math.log10(
                w[0] * pair[a, b] / max(before[a], 1) + w[1] * single[b] / max(n, 1) + w[2] / (v + 1)
            )
        out.append((doc_id, fold(doc_id) == 2, len(own), sum(single[t] > 0 for t in own), n, base, score))
    return out


def corpus(n):
    """Text with a preference for what follows what."""
    rng = random.Random(6)
    words = [f"W{i}" for i in range(60)]
    follows = {w: rng.choices(words, k=4) for w in words}
    rows = []
    for i in range(n):
        own, w = [], rng.choice(words)
        for _ in range(rng.randint(0, 80)):
            own.append(w)
            w = rng.choice(follows[w]) if rng.random() < 0.8 else rng.choice(words)
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(own)))
    return rows


def compare(got, want):
    assert len(got) == len(want)
    key = lambda r: repr(r[:5])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert tuple(a[:5]) == b[:5]
        assert a[5] == pytest.approx(b[5], rel=1e-9)
        assert a[6] == pytest.approx(b[6], rel=2e-3)


def test_scores_equal_dictionaries(spark, scratch, monkeypatch):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 2000)  # many blocks and ranges
    rows = corpus(150)
    got = [tuple(r) for r in lm.scores(frame(spark, rows).repartition(3), scratch).collect()]
    want = brute(rows)
    compare(got, want)
    held = [(b, s, n) for _, out, n, _, _, b, s in want if out]
    assert sum(s for _, s, _ in held) > sum(b for b, _, _ in held)  # better than the base


def test_a_table_is_read_where_it_lies(spark, scratch, tmp_path):
    rows = corpus(60)
    frame(spark, rows).repartition(4).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    compare([tuple(r) for r in lm.scores(docs, scratch).collect()], brute(rows))
    assert "documents" not in scratch.tables()


def test_weights_are_those_of_the_data():
    rng = np.random.default_rng(2)
    p = np.column_stack((rng.uniform(0, 0.2, 4000), rng.uniform(0, 0.01, 4000)))
    cells = np.column_stack((np.full(4000, 3), np.ones(4000), p))
    w = lm.learn(cells, 1e-4)[3]
    assert w.sum() == pytest.approx(1) and w[0] > 0.9
    alike = lambda w: np.log(p[:, 0] * w[0] + p[:, 1] * w[1] + 1e-4 * w[2]).sum()
    for other in ([0.5, 0.4, 0.1], [0.9, 0.05, 0.05], [0.99, 0.005, 0.005]):
        assert alike(w) >= alike(other) - 1e-6


def test_odd_documents(odd, none, scratch, spark):
    rows = [r[:2] for r in ODD_ROWS]
    compare([tuple(r) for r in lm.scores(odd, scratch).collect()], brute(rows))
    assert lm.scores(none, scratch).collect() == []
    held_out = [(i, "a b") for i in range(40) if fold(i) == 2]
    only = lm.scores(frame(spark, held_out), scratch).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in only)


def test_hashes_alike_in_their_low_halves_stay_apart():
    hashes = np.arange(256, dtype=np.uint64) << np.uint64(32) | np.uint64(7)
    places = lm._places(hashes, 1)
    assert len(np.unique(places)) == 256
    kept = lm._from_low_bytes([np.frombuffer(lm._low_bytes(places), np.uint8).reshape(-1, lm.LOW_BITS // 8)])
    assert len(np.unique(kept)) == 256
    assert lm.STEPS_PER_OCTAVE >= 16


def test_blocks_get_back_no_more_bytes_than_tell_their_hashes_apart(spark):
    low = np.array([5, 5 + (1 << 8), 5 + (1 << 16), 5 + (1 << 39)], np.uint64)
    assert [lm._width(low[:n]) for n in (1, 2, 3, 4)] == [1, 2, 3, 5]
    codes, more = lm._pack(np.array([1, 2], np.uint32), np.array([0, 20], np.uint32))
    packs = [(1, [0, 1]), (1, [0, 2]), (2, [0, 3])]
    sent = [(7, block, bytearray(lm._low_bytes(low[i])), bytearray(codes), bytearray(more)) for block, i in packs]
    rows = lm._add_up(spark.createDataFrame(sent, lm.SENT)).collect()
    found = {r["block"]: r for r in rows}
    assert len(rows) == 2 and {b: (r["width"], len(r["hashes"])) for b, r in found.items()} == {1: (3, 9), 2: (5, 10)}
    counted, deleted = lm._unpack(*(pa.chunked_array([[bytes(found[1][c])]], pa.binary()) for c in ("codes", "more")))
    assert counted.tolist() == [3, 2, 2] and deleted.tolist() == [0, 20, 20]
