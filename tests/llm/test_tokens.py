"""Records, byte-level BPE and prefix counts against the public libraries."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from citeloom.llm import prefix_counts, records, transducer
from citeloom.llm.pieces import Memo, Pieces
from citeloom.llm.vocab import Vocabulary
from tests.llm.conftest import ODD_ROWS

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
PARTS = [
    "<|endoftext|>", " ", "\n", "'", "a", "b", "re", "ll", "L", "0", "19", ".", ",", "é", "  ",
    "ñ", "日", "😀", "-", "=", "\t", " the", "ing", "\x1c", "\x85", "\xa0", "<|", "|>", "Hello", "\r\n",
]


def mixed(n, seed, most=10):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def ranks():
    with open(RANKS, "rb") as handle:
        return Vocabulary.from_ranks(handle.read())


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as handle:
        rows = dict(line.split() for line in handle)
    own = {base64.b64decode(t): int(r) for t, r in rows.items()}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own, special_tokens={})


def test_transducer_equals_merging(ranks):
    machine = transducer.Transducer(ranks, kept=50)  # forgets often
    rng = random.Random(1)
    for _ in range(300):
        piece = bytes(rng.choices(b"aabcdehinorst \xc3\xa9", k=rng.randint(1, 20)))
        assert machine.encode(piece) == ranks.merge(piece)


def test_codec_equals_tiktoken(ranks, reference):
    codec = transducer.Codec(ranks, PATTERN)
    texts = [*mixed(2000, 2, 14), "a" * 3000, " " * 500 + "x", "-" * 700, "日" * 300, "the" * 400]
    for text in texts:
        ids = np.frombuffer(codec.encode(text), "<u4").tolist()
        assert ids == reference.encode_ordinary(text), repr(text)
        assert "".join(read for _, read in codec.decode(codec.encode(text))) == text


def test_stream_gives_whole_characters():
    data = "aé日😀z".encode()
    for cut in range(len(data) + 1):
        stream = transducer.Utf8Stream()
        first = stream.feed(data[:cut])
        assert "aé日😀z".startswith(first)
        assert first + stream.feed(data[cut:]) == "aé日😀z"
        stream.close()
    stream = transducer.Utf8Stream()
    stream.feed(b"\xf0\x9f")
    with pytest.raises(ValueError):
        stream.close()
    with pytest.raises(UnicodeDecodeError):
        transducer.Utf8Stream().feed(b"\xffab")


def test_round_trip_of_odd_documents(odd, none, reference):
    rows = transducer.round_trip(odd, RANKS, PATTERN).collect()
    want = []
    for row in ODD_ROWS:
        ids = np.array(reference.encode_ordinary(row[1] or ""), "<u4").tobytes()
        text = (row[1] or "").encode()
        want.append((row[0], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest(), True))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert transducer.round_trip(none, RANKS, PATTERN).collect() == []
    encoded = transducer.encode(odd, RANKS, PATTERN).where("doc_id = 4").first()
    assert np.frombuffer(encoded["ids"], "<u4").tolist() == reference.encode_ordinary(encoded["text"])


def test_counts_of_every_prefix(library):
    with open(JSON, "rb") as handle:
        counter = prefix_counts.PrefixCounter(Vocabulary.from_json(handle.read()), PATTERN)
    for text in mixed(700, 3):
        want = [
            len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)
        ]
        assert counter.counts(text).tolist() == want, repr(text)


def test_token_counts_of_odd_documents(odd, none, library):
    counted = prefix_counts.prefix_counts(odd, JSON, PATTERN, budgets=(5,), keep_counts=True).collect()
    want = []
    for row in ODD_ROWS:
        text = row[1] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        want.append((row[0], len(text.encode()), n))
    assert sorted((tuple(r)[:3] for r in counted), key=repr) == sorted(want, key=repr)
    for row in counted:
        fitting = [i + 1 for i, n in enumerate(row["counts"]) if n <= 5]
        assert row["fits_5"] == (max(fitting) if fitting else 0)
    assert prefix_counts.prefix_counts(none, JSON, PATTERN).collect() == []


def test_crc32c():
    crc = records.Crc32c()
    assert crc(b"123456789") == 0xE3069283  # the check value of the public definition
    assert crc(bytes(32)) == 0x8A9136AA
    rng = random.Random(4)
    for n in (4, 5, 511, 512, 513, 2000):
        data = rng.randbytes(n)
        want = 0xFFFFFFFF
        for byte in data:
            want ^= byte
            for _ in range(8):
                want = want >> 1 ^ (0x82F63B78 if want & 1 else 0)
        assert crc(data) == want ^ 0xFFFFFFFF


def test_frames_show_damage():
    crc = records.Crc32c()
    record = records.frame(b"payload", crc)
    assert struct.unpack_from("<Q", record)[0] == 7 and records.unframe(record, crc) == b"payload"
    for at in range(len(record)):
        hurt = bytearray(record)
        hurt[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.unframe(bytes(hurt), crc)


def test_encoder_equals_library(library):
    with open(JSON, "rb") as handle:
        data = handle.read()
    encoder = records.Encoder(data, "H")
    texts = mixed(1500, 5, 14)
    for at in range(0, len(texts), 100):
        few = texts[at : at + 100]
        got = [np.frombuffer(i, "<u2").tolist() for i in encoder.encode(few)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in few]


@pytest.mark.parametrize("size", [50_257, 70_000])
def test_records_of_odd_documents(odd, none, scratch, library, size):
    rows = records.token_records(odd, JSON, scratch, end_id=2, vocabulary_size=size).collect()
    want, start = [], 0
    for row in sorted(ODD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(row[1] or "", add_special_tokens=False).ids, 2]
        want.append((row[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    assert records.token_records(none, JSON, scratch, end_id=2, vocabulary_size=size).collect() == []


def test_records_read_in_any_order(odd, scratch):
    index = records.write_records(odd, JSON, scratch, end_id=2, vocabulary_size=50_257, name="shuffled")
    some = index.where("doc_id in (2, 5, 9)").repartition(2, "length")
    got = records.read_records(some, scratch, "shuffled").select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(
        map(tuple, some.select("doc_id", "n_tokens").collect())
    )


def test_stored_counts_answer_any_budget(odd, none, spark, tmp_path):
    path = str(tmp_path / "counts")
    prefix_counts.store_counts(odd, JSON, PATTERN, path)
    got = prefix_counts.answers(spark.read.parquet(path), budgets=(0, 3, 50, 10**6), cuts=(0, 1, 40, 10**6)).collect()
    counted = prefix_counts.prefix_counts(odd, JSON, PATTERN, budgets=(0, 3, 50, 10**6), keep_counts=True).collect()
    assert len(got) == len(counted)

    def wanted(r):
        at = lambda n: r["counts"][min(n, len(r["counts"])) - 1] if n and r["counts"] else 0
        fits = [r[f"fits_{b}"] for b in (0, 3, 50, 10**6)]
        return (r["doc_id"], r["n_bytes"], r["n_tokens"], *fits, *map(at, (0, 1, 40, 10**6)))

    assert sorted(map(tuple, got), key=repr) == sorted(map(wanted, counted), key=repr)
    prefix_counts.store_counts(none, JSON, PATTERN, path)
    assert prefix_counts.answers(spark.read.parquet(path), budgets=(5,)).collect() == []


@pytest.mark.parametrize("counts", [[], [1], [1, 2, 1, 200, 3], [1, 2, 90_000, 4], [0, 2**40]])
def test_packed_counts(counts):
    assert prefix_counts.unpack(prefix_counts.pack(np.array(counts, np.int64))).tolist() == counts


def test_frequent_words_outlive_two_generations():
    made = []
    memo = Memo(lambda w: made.append(w) or w, kept=8)
    for i in range(100):
        assert memo["often"] == "often" and memo[f"once {i}"]
        assert len(memo) + len(memo.old) <= 8
    assert made.count("often") == 1
    assert memo["x" * 1_000] and "x" * 1_000 not in memo


def test_new_words_are_looked_up_and_known_ones_not_gone_through():
    with open(JSON, "rb") as file:
        encoder = records.Encoder(file.read(), "H")
    encoder.words.keys = lambda: pytest.fail("all known words were gone through")
    texts = ["one two, three été naïve 12x", "two three\nfour one. été, été", "", "three four five"]
    library = Tokenizer.from_file(JSON)
    got = [np.frombuffer(ids, np.uint16).tolist() for ids in encoder.encode(texts) + encoder.encode(texts[::-1])]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts + texts[::-1]]


def test_checksums_of_few_bytes():
    crc = records.Crc32c()
    assert [crc(b""), crc(b"a"), crc(b"123456789")] == [0, 0xC1D04330, 0xE3069283]
    crc.SHORT = 3
    assert crc(b"123456789") == 0xE3069283


def test_words_with_marks_take_the_short_way(library):
    with open(JSON, "rb") as file:
        encoder = records.Encoder(file.read(), "H")
    texts = ["Que.*** été!! (one) don't\ndon't, one.'s two'\nQue.*** x_y_ 3.5; naïve_", "one.'s\n'one two's"]
    alone, asked = encoder._alone, []
    encoder._alone = lambda text: asked.append(text) or alone(text)
    encoder.marks = Memo(encoder._alone)
    got = [np.frombuffer(ids, np.uint16).tolist() for ids in encoder.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ".***" in asked and " Que.***" not in asked and "\nQue.***" not in asked


def test_rows_of_words():
    spaces = [" ", "\n", "  ", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u2028", "\u3000", "\r\n", " \n", "\n "]
    plain = ["a", "é", "\xad", "\u200b", "\x00", "日"]
    for x in ["", *spaces]:
        for middle in spaces:
            for y in ["", *spaces]:
                for a, b in zip(plain, plain[1:]):
                    text = f"{x}{a}{middle}{b}{y}"
                    row = records.row_of_words(text)
                    whole = Pieces("").words(text)
                    assert (row is None) == (whole is None), repr(text)
                    assert row is None or row == [
                        "\n" * (not i) + w for line in whole for i, w in enumerate(line)
                    ]
