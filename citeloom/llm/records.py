"""Token ids in files of length-delimited records, with an offset index for shuffled reads.

A record is framed as in the public TFRecord format: payload length (8 bytes), masked CRC-32C of
those 8 bytes, payload, masked CRC-32C of the payload; all numbers least byte first. The payload
is one flag byte, the document id (8 bytes) and the ids, two bytes each where the vocabulary
allows it. The index is a Parquet table of file, offset, length, document and token counts; a
reader takes any rows of it in any order and reads just those records.

Documents are range-partitioned and sorted by id before they are encoded, so a file holds a run
of ids and the files follow each other; one shuffle moves texts, and nothing else moves. A task
writes its file under a name of its own attempt and renames it when whole, so a task that runs
again after a lost executor replaces the file by the same bytes.

Cases: null text counts as empty, so its record holds the end id alone; a null document id comes
first and is marked in the flag byte; documents that share an id are ordered by their text; an
empty table gives no records; other columns are not read.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm.pieces import Memo
from citeloom.llm.session import file_bytes, folder_address, id_and_text, importable, in_worker
from citeloom.llm.vocab import byte_letters
from citeloom.scratch import Scratch

INDEX = "file string, offset long, length long, doc_id long, n_tokens long, before long"
HEAD = "<Bq"
NULL_ID, WIDE = 1, 2
# Bytes read from a record file at a time.
READ_STEP = 8 << 20
# Documents encoded at a time; words and runs of marks remembered by one Python worker.
ENCODE_STEP = 256
WORDS_KEPT, MARKS_KEPT = 1_000_000, 10_000
# Marks that the split keeps apart from letters before them and in one piece, when nothing follows;
# an apostrophe may open a piece of its own.
MARKS = string.punctuation.replace("'", "")
# What a model's file says besides tokens and merges.
MODEL_FIELDS = (
    "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk",
    "byte_fallback", "ignore_merges",
)


class Crc32c:
    """CRC-32C (Castagnoli) over numpy arrays.

    The checksum of a block is a sum (xor) over its bytes of what each byte gives at its place, so
    a block is one table look-up and one reduction; blocks are joined by shifting.
    """

    POLYNOMIAL = 0x82F63B78  # fixed value of the checksum, reflected
    BLOCK, SHORT = 512, 16

    def __init__(self) -> None:
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = (step >> 1) ^ np.where(step & 1, np.uint32(self.POLYNOMIAL), np.uint32(0))
        self.step, self.steps = step, step.tolist()
        places = np.empty((self.BLOCK, 256), dtype=np.uint32)
        places[-1] = step
        for i in range(self.BLOCK - 2, -1, -1):
            places[i] = self._zero(places[i + 1])
        shifted = [np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)]
        for _ in range(self.BLOCK):
            shifted = [self._zero(s) for s in shifted]
        self.shift = [s.tolist() for s in shifted]
        self.flat, self._at = places.reshape(-1), np.arange(self.BLOCK) * 256

    def _zero(self, crc: np.ndarray) -> np.ndarray:
        """The state after one more zero byte."""
        return (crc >> 8) ^ self.step[crc & 0xFF]

    def __call__(self, data: bytes) -> int:
        n = len(data)
        if n <= self.SHORT:
            crc, steps = 0xFFFFFFFF, self.steps
            for byte in data:
                crc = steps[(crc ^ byte) & 255] ^ crc >> 8
            return crc ^ 0xFFFFFFFF
        rows = -(-n // self.BLOCK)
        padded = np.zeros(rows * self.BLOCK, dtype=np.uint8)
        padded[-n:] = np.frombuffer(data, dtype=np.uint8)
        padded[-n : len(padded) - n + 4] ^= 0xFF  # the initial state
        blocks = self.flat.take(padded.reshape(rows, self.BLOCK) + self._at)
        crc, (s0, s1, s2, s3) = 0, self.shift
        for block in np.bitwise_xor.reduce(blocks, axis=1).tolist():
            crc = block ^ s0[crc & 255] ^ s1[crc >> 8 & 255] ^ s2[crc >> 16 & 255] ^ s3[crc >> 24]
        return crc ^ 0xFFFFFFFF

    def masked(self, data: bytes) -> int:
        crc = self(data)
        return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes, crc: Crc32c) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", crc.masked(length)), payload, struct.pack("<I", crc.masked(payload)))
    )


def unframe(record: bytes, crc: Crc32c) -> bytes:
    """The payload of a framed record; raises if a checksum or the length is wrong."""
    length, check = struct.unpack_from("<QI", record)
    if check != crc.masked(record[:8]) or len(record) != length + 16:
        raise ValueError("a record's length is damaged")
    payload = record[12:-4]
    if struct.unpack_from("<I", record, len(record) - 4)[0] != crc.masked(payload):
        raise ValueError("a record's payload is damaged")
    return payload


class Encoder:
    """Whole texts to ids with the tokenizers library.

    Words are encoded once each: a lone space or line break between words is a border that no
    token crosses. A word of letters is one piece of the split, and so is the run of marks after
    it; such letters go straight to the library's model, other words through the library, each when
    it is first met. Texts with other white space go through the library as they are.
    """

    def __init__(self, vocabulary: bytes, width: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary.decode())
        self.tokenize = _uncached(vocabulary).tokenize
        self.width = width
        self.space = self.library.pre_tokenizer.pre_tokenize_str(" ")[0][0]
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.marks = Memo(self._alone, kept=MARKS_KEPT)
        self.words = Memo(self._word, kept=WORDS_KEPT)  # a word after a line break with the break
        self.feed = self._alone("\n")

    def _alone(self, text: str) -> bytes:
        return array(self.width, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word after a space, or of one that has its line break in front."""
        before, shown, own = b"", self.space, word
        if word[0] == "\n":
            before, shown, own = self.feed, "", word[1:]
        if not own.isalpha():
            stem = own.rstrip(MARKS)
            if not stem.isalpha():
                return self._alone(word if before else " " + word)
            return self.words[word.rstrip(MARKS)] + self.marks[own[len(stem) :]]
        if own.isascii():  # such letters stand for themselves
            shown += own
        else:
            shown += own.encode().decode("latin-1").translate(self.letters)
        return before + array(self.width, [t.id for t in self.tokenize(shown)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text in the encoder's width."""
        ids, known, skipped = [], self.words.__getitem__, len(self.feed)
        for text in texts:
            words = None if any(s in text for s in self.special) else row_of_words(text)
            if words is None:
                ids.append(self._alone(text))
            else:
                ids.append(b"".join(map(known, words))[skipped:])
        return ids


def row_of_words(text: str) -> list[str] | None:
    """Words, the first of a line with a line break in front, also the first of all.

    None unless every border is a lone space or line break.
    """
    row = f"\n{text}\n".replace("\n", " \n")
    if text.replace("\n", "").isprintable():  # among white space, only the space is
        lone = "  " not in row and "\n " not in row
    else:
        lone = text.split() == text.replace("\n", " ").split(" ")
    return row[1:-2].split(" ") if lone else None


def _uncached(vocabulary: bytes):
    """The library's model without its own memory of words, since each is encoded once here."""
    from tokenizers import models

    parsed = json.loads(vocabulary)["model"]
    given = {k: parsed[k] for k in MODEL_FIELDS if parsed.get(k) is not None}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parsed["merges"]]
    return models.BPE(parsed["vocab"], merges, cache_capacity=0, **given)


def _encoder(data: Broadcast, width: str) -> Encoder:
    return in_worker("encoder", hash(data.value), width, make=lambda: Encoder(data.value, width))


def write_records(
    docs: DataFrame,
    vocabulary_path: str,
    scratch: Scratch,
    *,
    end_id: int,
    vocabulary_size: int,
    name: str = "records",
) -> DataFrame:
    """Write all documents in ascending id order; gives back the index, itself kept as a table."""
    spark = docs.sparkSession
    importable(spark)
    data = spark.sparkContext.broadcast(file_bytes(vocabulary_path))
    width = "H" if vocabulary_size <= 1 << 16 else "I"
    folder = folder_address(scratch, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, root = arrow_fs.FileSystem.from_uri(folder)
        file = f"part-{context.partitionId():06d}.rec"
        attempt = f"{root}/.{file}.{context.taskAttemptId()}"
        encoder, crc, end = _encoder(data, width), Crc32c(), array(width, [end_id]).tobytes()
        wide = WIDE if width == "I" else 0
        out, offset, before = None, 0, 0
        for batch in batches:
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(attempt)
            rows: list[tuple] = []
            for at in range(0, batch.num_rows, ENCODE_STEP):
                few = batch.slice(at, ENCODE_STEP)
                ids = encoder.encode(few.column("text").to_pylist())
                for doc_id, own in zip(few.column("doc_id").to_pylist(), ids):
                    flags = wide | (NULL_ID if doc_id is None else 0)
                    record = frame(struct.pack(HEAD, flags, doc_id or 0) + own + end, crc)
                    out.write(record)
                    n = len(own) // len(end) + 1
                    rows.append((file, offset, len(record), doc_id, n, before))
                    offset += len(record)
                    before += n
            if rows:
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.string(), *[pa.int64()] * 5])]
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in INDEX.split(", ")])
        if out is not None:
            out.close()
            store.move(attempt, f"{root}/{file}")

    order = ["doc_id", F.xxhash64("text")]
    ordered = id_and_text(docs).repartitionByRange(*order).sortWithinPartitions("doc_id", "text")
    return scratch.keep(ordered.mapInArrow(run, INDEX), f"{name}-index")


def read_records(index: DataFrame, scratch: Scratch, name: str = "records") -> DataFrame:
    """``file, doc_id, n_tokens, ids_crc32, before`` of the indexed records, read from the files.

    Checksums are verified. Index rows may come in any order and any selection.
    """
    folder = folder_address(scratch, name)
    importable(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = arrow_fs.FileSystem.from_uri(folder)
        crc = Crc32c()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length", "before"))))
            found: list[tuple] = []
            for file, offset, record, before in _read(store, root, rows):
                payload = unframe(record, crc)
                flags, doc_id = struct.unpack_from(HEAD, payload)
                ids = np.frombuffer(payload, "<u4" if flags & WIDE else "<u2", offset=struct.calcsize(HEAD))
                doc_id = None if flags & NULL_ID else doc_id
                found.append((file, doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), before))
            columns = [pa.array(c, k) for c, k in zip(zip(*found), [pa.string(), *[pa.int64()] * 4])]
            yield pa.RecordBatch.from_arrays(
                columns, names=["file", "doc_id", "n_tokens", "ids_crc32", "before"]
            )

    wanted = index.select("file", "offset", "length", "before")
    return wanted.mapInArrow(run, "file string, doc_id long, n_tokens long, ids_crc32 long, before long")


def _read(store: arrow_fs.FileSystem, root: str, rows: list[tuple]) -> Iterator[tuple]:
    """Records in file order; stretches that follow each other are read together."""
    at = 0
    while at < len(rows):
        file, start = rows[at][:2]
        last = at
        while (
            last + 1 < len(rows)
            and rows[last + 1][0] == file
            and rows[last + 1][1] == rows[last][1] + rows[last][2]
            and rows[last + 1][1] + rows[last + 1][2] - start <= READ_STEP
        ):
            last += 1
        with store.open_input_file(f"{root}/{file}") as handle:
            data = handle.read_at(rows[last][1] + rows[last][2] - start, start)
        for _, offset, length, before in rows[at : last + 1]:
            yield file, offset, data[offset - start : offset - start + length], before
        at = last + 1


def with_starts(spark: SparkSession, records: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``start``, the ids of all documents before: in the files before, and in the file.

    One row per file is gathered, as many as tasks wrote.
    """
    totals = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).orderBy("file").collect()
    starts, before = [], 0
    for row in totals:
        starts.append((row["file"], before))
        before += row["n"]
    files = spark.createDataFrame(starts, "file string, file_start long")
    return records.join(F.broadcast(files), "file").withColumn(
        "start", F.col("file_start") + F.col("before")
    )


def token_records(
    docs: DataFrame, vocabulary_path: str, scratch: Scratch, *, end_id: int, vocabulary_size: int
) -> DataFrame:
    """Write, read back and place: ``doc_id, start, n_tokens, ids_crc32``."""
    index = write_records(
        docs, vocabulary_path, scratch, end_id=end_id, vocabulary_size=vocabulary_size
    )
    records = read_records(index, scratch)
    placed = with_starts(docs.sparkSession, records, index)
    return placed.select("doc_id", "start", "n_tokens", "ids_crc32")
