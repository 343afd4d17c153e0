import hashlib
import zlib

import pytest

from citeloom.llm import sharding
from tests.llm.conftest import ODD_ROWS, frame


def brute(rows, shards):
    """Smallest capacity by trying, then greedy cuts; the slot by order of digest and id."""
    digest = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode()) + 1
    groups = {}
    for _, text in rows:
        groups[digest(text)] = groups.get(digest(text), 0) + size(text)

    def cut(capacity):
        shard, held, out = 0, 0, {}
        for d in sorted(groups):
            if held + groups[d] > capacity:
                shard, held = shard + 1, 0
            out[d], held = shard, held + groups[d]
        return out

    low, high = max(groups.values()), sum(groups.values())
    while low < high:
        middle = (low + high) // 2
        if max(cut(middle).values()) < shards:
            high = middle
        else:
            low = middle + 1
    return low, cut(low), digest, size


@pytest.mark.parametrize("shards", [1, 2, 3, 8, 40])
def test_smallest_largest_shard(spark, scratch, shards):
    rows = [(i, "w" * (i * 7919 % 300)) for i in range(120)] + [(500 + i, "copy" * 30) for i in range(60)]
    capacity, where, digest, size = brute(rows, shards)
    got = sharding.minimax_shards(frame(spark, rows), shards, scratch).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    texts = dict(rows)
    held = {}
    for r in got:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (size(text), zlib.crc32(text.encode()))
        assert r["shard"] == where[digest(text)]
        held.setdefault(r["shard"], []).append((digest(text), r["doc_id"], r["slot"], r["size"]))
    assert max(sum(x[3] for x in own) for own in held.values()) == capacity
    for own in held.values():
        assert [x[2] for x in sorted(own)] == list(range(len(own)))


def test_odd_documents(odd, none, scratch):
    got = sharding.minimax_shards(odd, 4, scratch).collect()
    assert len(got) == len(ODD_ROWS)
    by_text = {}
    for r in got:
        by_text.setdefault((r["size"], r["text_crc32"]), set()).add(r["shard"])
        assert 0 <= r["shard"] < 4
    assert all(len(shards) == 1 for shards in by_text.values())
    for shard in range(4):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.minimax_shards(none, 4, scratch).collect() == []


def test_no_shards(none, scratch):
    with pytest.raises(ValueError):
        sharding.minimax_shards(none, 0, scratch)
