"""Language-model scores by deleted interpolation of a bigram model.

The probability of a token after its context mixes the maximum-likelihood estimates of bigram and
unigram with the uniform distribution (Jelinek and Mercer 1980). The weights depend on how often
the context was seen (buckets by powers of two) and are learned by expectation-maximisation on
held-out counts: one part of the training documents is left out of the counts, the weights make
that part most likely, and then all training documents are counted.

Counts are of all training documents. Most bigrams are rare, so rows of single counts would be
many times the text: tasks pack the counts of a block of documents by ranges of the bigrams'
hashes, ranges add them up, and each block gets back the totals of the bigrams it holds, under as
many bytes of their hashes as it needs to tell them apart. A bigram
is known by its range and 40 more bits of its hash; ranges grow in number with the data, so the
chance that two share a count stays about one in a million. Where a document lies (file and row)
makes its block, so the text is read where it is each time and never shuffled.

Held-out likelihood is gathered by the two estimates' ratios to the uniform one, in steps of a
sixteenth of a power of two, with the mean estimates in each step: a table of bounded size.

Cases: null text counts as empty, which is its end alone; a null id counts as the empty string;
rows repeat as they come, and count as often; without training documents, counts are zero and all
scores come from the uniform part; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs as arrow_fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.pieces import Memo
from citeloom.llm.session import folder_address, importable, in_worker
from citeloom.scratch import Scratch

FOLDS, HELD_OUT, DELETED = 7, 2, 3
# Bytes of text in a block, about.
BLOCK_BYTES = 16 << 20
# Documents whose tokens are looked up at a time.
LOOKUP_STEP = 256
# Buckets by context count: unseen, 1, 2-3, 4-7, …
BUCKETS = 48
# Held-out tokens a bucket needs for weights of its own; else those of the bucket below.
ENOUGH = 100
EM_STEPS = 200
STEPS_PER_OCTAVE = 16
LOW_BITS = 40

_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # fixed values: constants of the splitmix64 generator
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class Tokens:
    """Tokens of texts as hashes: words in lower case (A-Z), then one end each."""

    def __init__(self) -> None:
        self.words = Memo(lambda w: xxhash.xxh64_intdigest(w))
        # No word holds white space.
        self.end, self.start = (np.uint64(xxhash.xxh64_intdigest(w)) for w in (b" end", b" start"))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All tokens, their contexts, and how many each text has."""
        lookup = self.words.__getitem__
        parts, lengths = [], []
        for text in texts:
            words = text.encode().lower().split()
            own = np.empty(len(words) + 1, np.uint64)
            own[:-1] = np.fromiter(map(lookup, words), np.uint64, len(words))
            own[-1] = self.end
            parts.append(own)
            lengths.append(len(own))
        tokens = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        contexts = np.empty_like(tokens)
        contexts[1:] = tokens[:-1]
        n = np.array(lengths, np.int64)
        contexts[np.cumsum(n) - n] = self.start
        return tokens, contexts, n


def tokenizer() -> Tokens:
    return in_worker("tokens", make=Tokens)


def _bigrams(tokens: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    return _mix(contexts * _FACTOR + tokens)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The range in the leading bits, then the low bits."""
    low = hashes & np.uint64((1 << LOW_BITS) - 1)
    if not bits:
        return low
    return (hashes >> np.uint64(64 - bits)) << np.uint64(LOW_BITS) | low


def _low_bytes(places: np.ndarray, width: int = LOW_BITS // 8) -> bytes:
    return places.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_low_bytes(parts: list[np.ndarray], width: int = LOW_BITS // 8) -> np.ndarray:
    wide = np.zeros((sum(map(len, parts)), 8), np.uint8)
    if parts:
        np.concatenate(parts, out=wide[:, :width])
    return wide.view(np.uint64).ravel()


def _rows_of(column: pa.ChunkedArray, width: int = LOW_BITS // 8) -> list[np.ndarray]:
    return [np.frombuffer(p.as_buffer(), np.uint8).reshape(-1, width) for p in column]


def _width(low: np.ndarray) -> int:
    """The fewest low bytes, beginning where it becomes likely, that tell all these hashes apart."""
    for width in range(min(LOW_BITS // 8, 1 + (2 * len(low).bit_length() - 2) // 8), LOW_BITS // 8):
        short = np.sort(low & np.uint64((1 << 8 * width) - 1))
        if (short[1:] != short[:-1]).all():
            return width
    return LOW_BITS // 8


def _pack(counted: np.ndarray, deleted: np.ndarray) -> tuple[bytes, bytes]:
    """Two small counts in a byte; where one is above 14, both follow apart."""
    large = (counted > 14) | (deleted > 14)
    codes = np.where(large, 255, counted << 4 | deleted).astype(np.uint8)
    return codes.tobytes(), np.column_stack((counted[large], deleted[large])).astype(np.uint32).tobytes()


def _unpack(codes: pa.ChunkedArray, more: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The counts of all rows, one after the other."""
    code = np.frombuffer(b"".join(c.as_py() for c in codes), np.uint8)
    large = np.frombuffer(b"".join(m.as_py() for m in more), np.uint32).reshape(-1, 2)
    counted, deleted = (code >> 4).astype(np.uint32), (code & 15).astype(np.uint32)
    counted[code == 255], deleted[code == 255] = large[:, 0], large[:, 1]
    return counted, deleted


def placed(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """``doc_id, text, part, block`` and the number of blocks.

    ``part`` is 2 for documents held out for testing, 1 for the deleted part of the training
    documents, else 0. A table is addressed where it lies; anything else is written first.
    """
    narrow = docs.select("doc_id", "text")
    try:
        addressed = docs.select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    except AnalysisException:
        narrow = scratch.keep(narrow, "documents")
        addressed = narrow.select("doc_id", "text", "_metadata.file_path", "_metadata.row_index")
    text = F.coalesce(F.col("text"), F.lit(""))
    size = narrow.agg(
        F.sum(F.octet_length(text)).alias("bytes"), F.count(F.lit(1)).alias("rows")
    ).first()
    total, rows = size["bytes"] or 0, size["rows"]
    per_block = max(1, int(rows * BLOCK_BYTES / total)) if total else max(1, rows)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    part = F.when(fold == HELD_OUT, 2).when(fold == DELETED, 1).otherwise(0)
    # Two stretches that share this hash would only be given each other's totals as well.
    block = F.xxhash64("file_path", F.floor(F.col("row_index") / per_block))
    return (
        addressed.select("doc_id", text.alias("text"), part.cast("int").alias("part"), block.alias("block")),
        max(1, -(-total // BLOCK_BYTES)),
    )


SENT = "range long, block long, hashes binary, codes binary, more binary"
TOTALS = "range long, block long, width int, hashes binary, codes binary, more binary, sums array<long>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Stretches of rows of one block."""
    for batch in batches:
        blocks = np.asarray(batch.column("block").to_numpy(zero_copy_only=False))
        edges = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))) if len(blocks) else []
        for a, b in zip(edges, [*edges[1:], len(blocks)]):
            yield int(blocks[a]), batch.slice(int(a), int(b - a))


def _few(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, rows.num_rows, LOOKUP_STEP):
        yield rows.slice(at, LOOKUP_STEP)


def _send(documents: DataFrame, bits: int) -> DataFrame:
    """Counts of a block's unigrams (even range numbers) and bigrams (odd), by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = tokenizer()
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        block, size = None, 0

        def packed() -> Iterator[pa.RecordBatch]:
            tokens, contexts, parts = (np.concatenate(c) for c in zip(*held))
            held.clear()
            for kind, hashes in enumerate((tokens, _bigrams(tokens, contexts))):
                places = _places(hashes, bits)
                order = np.argsort(places)
                places, part = places[order], parts[order]
                first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
                counted = np.add.reduceat((part == 0).astype(np.uint32), first, dtype=np.uint32)
                deleted = np.add.reduceat((part == 1).astype(np.uint32), first, dtype=np.uint32)
                places = places[first]
                ranges = places >> np.uint64(LOW_BITS)
                edges = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1]))).tolist()
                cuts = list(zip(edges, [*edges[1:], len(places)]))
                packs = [_pack(counted[a:b], deleted[a:b]) for a, b in cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ranges[edges].astype(np.int64) * 2 + kind),
                        pa.array([block] * len(cuts), pa.int64()),
                        pa.array([_low_bytes(places[a:b]) for a, b in cuts], pa.binary()),
                        pa.array([codes for codes, _ in packs], pa.binary()),
                        pa.array([more for _, more in packs], pa.binary()),
                    ],
                    names=["range", "block", "hashes", "codes", "more"],
                )

        for own, rows in _runs(batches):
            if held and (own != block or size >= 4 * BLOCK_BYTES):
                yield from packed()
                size = 0
            block = own
            for few in _few(rows):
                tokens, contexts, n = make(few.column("text").to_pylist())
                part = np.repeat(few.column("part").to_numpy(zero_copy_only=False).astype(np.int8), n)
                held.append((tokens, contexts, part))
                size += tokens.nbytes
        if held:
            yield from packed()

    return documents.select("block", "part", "text").mapInArrow(run, SENT)


def _add_up(sent: DataFrame) -> DataFrame:
    """Totals for each block's entries, and for unigrams the sums of the range: tokens and
    distinct ones, in the counted part and in all training documents.

    Counts are added by whole hashes. A block looks up nothing but its own entries, so it gets back
    as many low bytes of their hashes as tell those of one range apart.
    """

    def run(table: pa.Table) -> pa.Table:
        number = table.column("range")[0].as_py()
        parts = _rows_of(table.column("hashes"))
        values, where = np.unique(_from_low_bytes(parts), return_inverse=True)
        counted, deleted = _unpack(table.column("codes"), table.column("more"))
        counted = np.bincount(where, counted, len(values)).astype(np.uint32)
        deleted = np.bincount(where, deleted, len(values)).astype(np.uint32)
        held: dict[int, list[np.ndarray]] = {}
        ends = np.cumsum([len(p) for p in parts])
        for block, end, p in zip(table.column("block").to_pylist(), ends, parts):
            held.setdefault(block, []).append(where[end - len(p) : end])
        own = [rows[0] if len(rows) == 1 else np.unique(np.concatenate(rows)) for rows in held.values()]
        widths = [_width(values[i]) for i in own]
        sums = None
        if number % 2 == 0:
            both = counted.astype(np.int64) + deleted
            sums = [int(counted.sum(dtype=np.int64)), int((counted > 0).sum()), int(both.sum()), int((both > 0).sum())]
        packs = [_pack(counted[i], deleted[i]) for i in own]
        return pa.table(
            {
                "range": pa.array([number] * len(held), pa.int64()),
                "block": pa.array(list(held), pa.int64()),
                "width": pa.array(widths, pa.int32()),
                "hashes": pa.array([_low_bytes(values[i], w) for i, w in zip(own, widths)], pa.binary()),
                "codes": pa.array([codes for codes, _ in packs], pa.binary()),
                "more": pa.array([more for _, more in packs], pa.binary()),
                "sums": pa.array([sums] + [None] * (len(held) - 1), pa.list_(pa.int64())),
            }
        )

    return sent.groupBy("range").applyInArrow(run, TOTALS)


class Totals:
    """One block's totals, by place of the hash."""

    def __init__(self, store: arrow_fs.FileSystem, path: str, bits: int):
        self.bits = bits
        columns = ["range", "width", "hashes", "codes", "more"]
        table = pq.read_table(path, filesystem=store, partitioning=None, columns=columns)
        ranges, widths = table.column("range").to_numpy(), table.column("width").to_numpy()
        self.kinds = []
        for kind in (0, 1):
            masks = np.zeros(1 << bits, np.uint64)
            found = [(np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32))]
            for width in range(1, LOW_BITS // 8 + 1):
                chosen = (ranges % 2 == kind) & (widths == width)
                own, of = table.filter(pa.array(chosen)), ranges[chosen].astype(np.uint64) // np.uint64(2)
                masks[of] = (1 << 8 * width) - 1
                parts = _rows_of(own.column("hashes"), width)
                of = np.repeat(of, [len(p) for p in parts])
                places = _from_low_bytes(parts, width) | of << np.uint64(LOW_BITS)
                found.append((places, *_unpack(own.column("codes"), own.column("more"))))
            places, counted, deleted = (np.concatenate(c) for c in zip(*found))
            order = np.argsort(places)
            self.kinds.append((masks, places[order], counted[order], deleted[order]))

    def find(self, kind: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts in the counted part and in the deleted part."""
        masks, places, counted, deleted = self.kinds[kind]
        own = hashes >> np.uint64(64 - self.bits) if self.bits else np.zeros(len(hashes), np.uint64)
        at = np.searchsorted(places, own << np.uint64(LOW_BITS) | hashes & masks[own])
        return counted[at].astype(np.float64), deleted[at].astype(np.float64)


def _with_totals(batches, address: str, bits: int):
    """Stretches of rows with their block's totals; a block's are read once in a row."""
    store, root = arrow_fs.FileSystem.from_uri(address)
    last, totals = None, None
    for block, rows in _runs(batches):
        if block != last:
            last, totals = block, None
            totals = Totals(store, f"{root}/block={block}", bits)
        for few in _few(rows):
            yield few, totals


def _estimates(make: Tokens, totals: Totals, tokens, contexts, whole: bool):
    """Counts of context, token and pair, from all training documents or the counted part."""
    seen = [totals.find(0, tokens), totals.find(1, _bigrams(tokens, contexts))]
    # A text's start is a context as often as there are ends.
    before = totals.find(0, np.where(contexts == make.start, make.end, contexts))
    add = (lambda c: c[0] + c[1]) if whole else (lambda c: c[0])
    return add(before), add(seen[0]), add(seen[1])


def bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the power of two in its count."""
    return np.minimum(np.frexp(context)[1], BUCKETS - 1)


LIKELIHOOD = "bucket int, x int, y int, n long, pair double, single double"


def _held_out_counts(documents: DataFrame, address: str, bits: int, n: int, v: int) -> DataFrame:
    """How the deleted part's tokens fall on buckets and estimates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = tokenizer()
        for rows, totals in _with_totals(batches, address, bits):
            tokens, contexts, _ = make(rows.column("text").to_pylist())
            before, single, pair = _estimates(make, totals, tokens, contexts, whole=False)
            p_pair = pair / np.maximum(before, 1)
            p_single = single / max(n, 1)
            with np.errstate(divide="ignore"):
                x = np.maximum(np.round(STEPS_PER_OCTAVE * np.log2(p_pair * (v + 1))), -(1 << 15)).astype(np.int64)
                y = np.maximum(np.round(STEPS_PER_OCTAVE * np.log2(p_single * (v + 1))), -(1 << 15)).astype(np.int64)
            key = bucket(before).astype(np.int64) << 40 | (x + (1 << 15)) << 20 | (y + (1 << 15))
            cells, where = np.unique(key, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((cells >> 40).astype(np.int32)),
                    pa.array(((cells >> 20 & 0xFFFFF) - (1 << 15)).astype(np.int32)),
                    pa.array(((cells & 0xFFFFF) - (1 << 15)).astype(np.int32)),
                    pa.array(np.bincount(where, minlength=len(cells)).astype(np.int64)),
                    pa.array(np.bincount(where, p_pair, len(cells))),
                    pa.array(np.bincount(where, p_single, len(cells))),
                ],
                names=["bucket", "x", "y", "n", "pair", "single"],
            )

    rows = documents.where("part = 1").select("block", "text").mapInArrow(run, LIKELIHOOD)
    return rows.groupBy("bucket", "x", "y").agg(
        F.sum("n").alias("n"), F.sum("pair").alias("pair"), F.sum("single").alias("single")
    )


def learn(cells: np.ndarray, uniform: float) -> np.ndarray:
    """Weights ``(pair, single, uniform)`` per bucket by expectation-maximisation.

    ``cells`` has rows of bucket, tokens, and the sums of both estimates over them.
    """
    weights = np.zeros((BUCKETS, 3))
    last = np.array([0.0, 0.9, 0.1])
    for b in range(BUCKETS):
        own = cells[cells[:, 0] == b]
        n = own[:, 1]
        if n.sum() >= ENOUGH:
            p = np.column_stack((own[:, 2] / n, own[:, 3] / n, np.full(len(own), uniform)))
            mix = np.full(3, 1 / 3) if b else np.array([0.0, 0.5, 0.5])
            for _ in range(EM_STEPS):
                shares = p * mix
                shares /= shares.sum(axis=1, keepdims=True)
                mix = (shares * n[:, None]).sum(axis=0) / n.sum()
            # No estimate may rule a token out.
            last = (mix + 1e-9) / (mix + 1e-9).sum()
        weights[b] = last
        if not b:
            weights[0] = [0.0, *(last[1:] / last[1:].sum())]
    return weights


SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


def scores(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """Counts and log10 probabilities of every document's whole text."""
    spark = docs.sparkSession
    importable(spark)
    documents, blocks = placed(docs, scratch)
    bits = max(0, (2 * blocks - 1).bit_length())
    address = folder_address(scratch, "totals")
    _add_up(_send(documents, bits)).repartition("block").sortWithinPartitions("block").write.partitionBy("block").mode(
        "overwrite"
    ).parquet(f"{scratch.path}/totals")
    schema = "range long, sums array<long>, block long"
    sums = spark.read.schema(schema).parquet(f"{scratch.path}/totals").where(F.col("sums").isNotNull())
    row = sums.agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(4)]).first()
    n_counted, v_counted, n, v = (row[f"s{i}"] or 0 for i in range(4))
    cells = _held_out_counts(documents, address, bits, n_counted, v_counted)
    # The table is bounded by buckets and steps, not by the data.
    gathered = [(r["bucket"], r["n"], r["pair"], r["single"]) for r in cells.collect()]
    weights = learn(np.array(gathered, dtype=float).reshape(-1, 4), 1 / (v_counted + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = tokenizer()
        for rows, totals in _with_totals(batches, address, bits):
            tokens, contexts, lengths = make(rows.column("text").to_pylist())
            before, single, pair = _estimates(make, totals, tokens, contexts, whole=True)
            mix = weights[bucket(before)]
            p = mix[:, 0] * pair / np.maximum(before, 1) + mix[:, 1] * single / max(n, 1) + mix[:, 2] / (v + 1)
            starts = np.cumsum(lengths) - lengths
            base = np.log10((single + 1) / (n + v + 1))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id").cast(pa.int64()),
                    pa.array(rows.column("part").to_numpy(zero_copy_only=False) == 2),
                    pa.array(lengths),
                    pa.array(np.add.reduceat((single > 0).astype(np.int64), starts)),
                    pa.array(np.full(len(lengths), n, np.int64)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(np.log10(p), starts)),
                ],
                names=[f.split()[0] for f in SCORED.split(", ")],
            )

    return documents.mapInArrow(run, SCORED)
