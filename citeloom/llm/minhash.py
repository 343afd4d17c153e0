"""Near-duplicate classes by improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of shingles of five words (all words, if fewer), the weight being how
often it stands in the text times its inverse document frequency. Similarity is weighted Jaccard.

1. Equal texts become one, so the rest is about distinct texts; copies follow their text.
2. Document frequencies: tasks send each shingle once per block of texts, packed by ranges of the
   hash; what is in more than one text comes back to the blocks it came from. A shingle is known
   by its range and 40 more bits of its hash; ranges grow in number with the data, so the chance
   that two are taken for one stays about one in a million.
3. Similar texts share shingles, so a text whose shared shingles are less than the threshold of
   its weight has no near-duplicate; that is exact and leaves few texts to sample.
4. Samples (Ioffe 2010) are banded. In a small bucket all pairs are candidates; in a large one
   each member meets the leader, the member whose shingles are the most common, as the original
   of a group of copies is. Members that are not in the leader's class after that are few and
   are compared with all of the bucket, in blocks of bounded size.
5. Candidates are verified on their whole weighted sets, and verified pairs are links; classes are
   the connected components. Any two members of a bucket are compared or in its leader's class,
   so no class that the buckets can show is missed.

Inverse document frequency is scaled to lie between 1 and 1.1: copies of one text share shingles
that many texts have, and lose those by their edits that no other has. Unscaled, the rare ones
would weigh many times the common ones, and copies that share nine shingles in ten would fall
below a similarity of 0.8.

Cases: null text counts as empty; empty texts are copies of each other; texts are compared in
lower case; null ids belong to classes like others, and a class of null ids only has a null id;
an empty table gives an empty table; other columns are not read, and ``keep_one`` keeps them.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm.pieces import Memo
from citeloom.llm.session import addressed, importable, in_worker
from citeloom.operators.components import components
from citeloom.operators.lookup import hot_keys, lookup
from citeloom.scratch import Scratch

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 16, 3
# Bytes of text in a block, about; there are as many ranges of hashes, to a power of two.
BLOCK_BYTES = 16 << 20
# Members up to which a bucket's pairs are all compared.
SMALL_BUCKET = 8
# Members of a larger bucket in a block: of those left, and of all.
LEFT_BLOCK, ALL_BLOCK = 64, 256
LOW_BITS = 40
# How much more a shingle of one text weighs than one of all texts.
IDF_RANGE = 0.1
# Elements of a text sampled at a time.
SAMPLE_STEP = 4096

_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # fixed values: constants of the splitmix64 generator
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted distinct shingle hashes and their counts."""

    def __init__(self) -> None:
        self.words = Memo(lambda w: xxhash.xxh64_intdigest(w.encode()))

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.lower().split()
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        ids = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        size = min(SHINGLE, n)
        total = np.full(n - size + 1, size, np.uint64)
        for i in range(size):
            total = _mix(total * _FACTOR + ids[i : i + len(total)])
        return np.unique(total, return_counts=True)


class Sampler:
    """Improved consistent weighted samples: each is the element and level that come out least."""

    def __init__(self, n: int) -> None:
        self.seeds = _mix(np.arange(1, n + 1, dtype=np.uint64) * _FACTOR)

    def __call__(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        n = len(self.seeds)
        least = np.full(n, np.inf, np.float32)
        sample = np.zeros(n, np.uint64)
        column = np.arange(n)
        unit = np.float32(2.0**-24)
        low = np.uint64(0xFFFFFF)
        for at in range(0, len(hashes), SAMPLE_STEP):
            own = hashes[at : at + SAMPLE_STEP]
            log_weight = np.log(weights[at : at + SAMPLE_STEP]).astype(np.float32)[:, None]
            x = _mix(own[:, None] ^ self.seeds)
            y = _mix(x + _FACTOR)

            def uniform(bits: np.ndarray) -> np.ndarray:
                return ((bits & low).astype(np.uint32).astype(np.float32) + np.float32(0.5)) * unit

            # Two Gamma(2, 1) variables and a uniform one for each element and sample.
            r = -np.log(uniform(x >> np.uint64(40)) * uniform(x >> np.uint64(16)))
            log_c = np.log(-np.log(uniform(y >> np.uint64(40)) * uniform(y >> np.uint64(16))))
            beta = uniform((x << np.uint64(8)) ^ (y & np.uint64(0xFF)))
            level = np.floor(log_weight / r + beta)
            log_a = log_c - r * (level - beta) - r
            best = np.argmin(log_a, axis=0)
            value = log_a[best, column]
            better = value < least
            least = np.where(better, value, least)
            drawn = _mix(own[best] ^ (level[best, column].astype(np.int64).view(np.uint64) * _FACTOR))
            sample = np.where(better, drawn, sample)
        return sample


def idf(df: np.ndarray, n_texts: int) -> np.ndarray:
    """Between 1 (in all texts) and 1 + IDF_RANGE (in one of very many)."""
    return 1.0 + IDF_RANGE * np.log((n_texts + 1.0) / (df + 1.0)) / math.log(n_texts + 2.0)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def shingler() -> Shingler:
    return in_worker("shingler", make=Shingler)


def text_key(column: str = "text") -> Column:
    return F.md5(F.coalesce(F.col(column), F.lit("")).cast("binary"))


# ---- document frequencies ----

SENT = "range long, block int, hashes binary"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The range in the leading bits, then the low bits."""
    low = hashes & np.uint64((1 << LOW_BITS) - 1)
    if not bits:
        return low
    return (hashes >> np.uint64(64 - bits)) << np.uint64(LOW_BITS) | low


def _low_bytes(places: np.ndarray) -> bytes:
    return places.view(np.uint8).reshape(-1, 8)[:, : LOW_BITS // 8].tobytes()


def _from_low_bytes(column: pa.ChunkedArray) -> tuple[np.ndarray, list[int]]:
    """The low bits of all rows, one after the other, and how many each row has."""
    parts = [np.frombuffer(p.as_buffer(), np.uint8).reshape(-1, LOW_BITS // 8) for p in column]
    wide = np.zeros((sum(map(len, parts)), 8), np.uint8)
    if parts:
        np.concatenate(parts, out=wide[:, : LOW_BITS // 8])
    return wide.view(np.uint64).ravel(), list(map(len, parts))


def _send(texts: DataFrame, bits: int) -> DataFrame:
    """The distinct shingles of each text, a block's packed together by range of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = shingler()
        held: dict[int, list[np.ndarray]] = {}
        n_held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            for block, parts in held.items():
                places = np.concatenate(parts)
                places.sort()
                ranges = places >> np.uint64(LOW_BITS)
                starts = np.flatnonzero(np.concatenate(([True], ranges[1:] != ranges[:-1])))
                cuts = list(zip(starts.tolist(), [*starts[1:].tolist(), len(places)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ranges[starts].astype(np.int64)),
                        pa.array([block] * len(starts), pa.int32()),
                        pa.array([_low_bytes(places[a:b]) for a, b in cuts], pa.binary()),
                    ],
                    names=["range", "block", "hashes"],
                )
            held.clear()

        for batch in batches:
            for block, text in zip(batch.column("block").to_pylist(), batch.column("text")):
                hashes = make(text.as_py())[0]
                if len(hashes):
                    held.setdefault(block, []).append(_places(hashes, bits))
                    n_held += len(hashes)
            if n_held * 8 >= BLOCK_BYTES * 2:
                yield from packed()
                n_held = 0
        if held:
            yield from packed()

    return texts.select("block", "text").mapInArrow(run, SENT)


BACK = "block int, range long, hashes binary, df binary"


def _count(sent: DataFrame) -> DataFrame:
    """To each block, its shingles that stand in more than one text, with how many."""

    def run(table: pa.Table) -> pa.Table:
        blocks, number = table.column("block").to_pylist(), table.column("range")[0].as_py()
        values, lengths = _from_low_bytes(table.column("hashes"))
        distinct, counts = np.unique(values, return_counts=True)
        shared, df = distinct[counts > 1], counts[counts > 1].astype(np.uint32)
        out_blocks, out_hashes, out_df = [], [], []
        at = 0
        for block, length in zip(blocks, lengths):
            own = np.unique(values[at : at + length])
            at += length
            place = np.searchsorted(shared, own)
            place[place == len(shared)] = 0
            found = place[shared[place] == own] if len(shared) else place[:0]
            if len(found):
                out_blocks.append(block)
                out_hashes.append(_low_bytes(shared[found]))
                out_df.append(df[found].tobytes())
        return pa.table(
            {
                "block": pa.array(out_blocks, pa.int32()),
                "range": pa.array([number] * len(out_blocks), pa.int64()),
                "hashes": pa.array(out_hashes, pa.binary()),
                "df": pa.array(out_df, pa.binary()),
            }
        )

    return sent.groupBy("range").applyInArrow(run, BACK)


# ---- samples ----

VECTORS = (
    "key string, total double, centre double, hashes binary, weights binary, bands array<long>"
)


def _sample(texts: DataFrame, back: DataFrame, n_texts: int, bits: int, similar: float) -> DataFrame:
    """Of the texts that may have a near-duplicate: shared shingles with weights, total weight and
    band hashes, and how common its shingles are (``centre``)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        make, sampler = shingler(), Sampler(BANDS * ROWS)
        known = np.zeros(0, np.uint64)
        df = np.zeros(0, np.uint32)
        if right.num_rows:
            low, lengths = _from_low_bytes(right.column("hashes"))
            of = np.repeat(right.column("range").to_numpy().astype(np.uint64), lengths)
            known = low | of << np.uint64(LOW_BITS)
            df = np.concatenate([np.frombuffer(p.as_buffer(), np.uint32) for p in right.column("df")])
            known, first = np.unique(known, return_index=True)
            df = df[first]
        rows: list[list] = [[] for _ in range(6)]
        for key, text in zip(left.column("key"), left.column("text")):
            if not len(known):
                break
            hashes, counts = make(text.as_py())
            if not len(hashes):
                continue
            hashes = _places(hashes, bits)
            place = np.searchsorted(known, hashes)
            place[place == len(known)] = 0
            shared = known[place] == hashes
            frequency = np.where(shared, df[place], 1)
            weights = counts * idf(frequency, n_texts)
            total = float(weights.sum())
            if float(weights[shared].sum()) < similar * total * (1 - 1e-9):
                continue
            samples = sampler(hashes, weights).reshape(BANDS, ROWS)
            bands = np.arange(BANDS, dtype=np.uint64)
            for i in range(ROWS):
                bands = _mix(bands * _FACTOR + samples[:, i])
            hashes, weights = hashes[shared], weights[shared]
            order = np.argsort(hashes)
            rows[0].append(key.as_py())
            rows[1].append(total)
            rows[2].append(float(np.log(frequency).mean()))
            rows[3].append(hashes[order].tobytes())
            rows[4].append(weights[order].astype(np.float32).tobytes())
            rows[5].append(bands.view(np.int64))
        kinds = [pa.string(), pa.float64(), pa.float64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        names = ["key", "total", "centre", "hashes", "weights", "bands"]
        return pa.table({n: pa.array(r, k) for n, r, k in zip(names, rows, kinds)})

    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(run, VECTORS)


# ---- candidates and links ----


def _overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weight that two sets have in common; hashes are sorted."""
    place = np.searchsorted(b[0], a[0])
    place[place == len(b[0])] = 0
    both = b[0][place] == a[0]
    return float(np.minimum(a[1][both], b[1][place[both]]).sum(dtype=np.float64))


def _set(hashes: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(hashes, np.uint64), np.frombuffer(weights, np.float32)


def _alike(a, b, a_total: float, b_total: float, similar: float) -> bool:
    both = _overlap(a, b)
    return both >= (similar - 1e-6) * (a_total + b_total - both)


def _verified(pairs: DataFrame, vectors: DataFrame, similar: float) -> DataFrame:
    """The pairs ``a, b`` that are similar. A pair's sets meet by two joins on unique keys."""

    def judge(a_h, a_w, a_t, b_h, b_w, b_t):
        import pandas as pd

        rows = zip(a_h, a_w, a_t, b_h, b_w, b_t)
        return pd.Series([_alike(_set(ah, aw), _set(bh, bw), at, bt, similar) for ah, aw, at, bh, bw, bt in rows], dtype=bool)

    side = lambda p: vectors.select(
        F.col("key").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in ("hashes", "weights", "total")]
    )
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    alike = F.pandas_udf(judge, "boolean")
    return both.where(
        alike("a_hashes", "a_weights", "a_total", "b_hashes", "b_weights", "b_total")
    ).select("a", "b")


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _compare_left(cells: DataFrame, similar: float) -> DataFrame:
    """Links between a block of members left over and a block of all members of their bucket.

    Two texts that share several buckets are compared in the first of them.
    """

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        left, right = [r for r in rows if r["left"]], [r for r in rows if not r["left"]]
        found: list[tuple[str, str]] = []
        if left and right:
            band = left[0]["band"]
            bands = np.array([r["bands"] for r in right])
            sets = [_set(r["hashes"], r["weights"]) for r in right]
            for row in left:
                own = _set(row["hashes"], row["weights"])
                first = np.argmax(bands == np.array(row["bands"]), axis=1)
                for j in np.flatnonzero(first == band).tolist():
                    other = right[j]
                    # Two that are both left over are compared once.
                    if row["component"] == other["component"] or (other["is_left"] and other["key"] < row["key"]):
                        continue
                    if _alike(own, sets[j], row["total"], other["total"], similar):
                        found.append((min(row["key"], other["key"]), max(row["key"], other["key"])))
        return pa.table(
            {"a": pa.array([a for a, _ in found], pa.string()), "b": pa.array([b for _, b in found], pa.string())}
        )

    return cells.groupBy("band", "hash", "left_block", "all_block").applyInArrow(run, "a string, b string")


def links(vectors: DataFrame, scratch: Scratch, similar: float) -> DataFrame:
    """Verified pairs ``a, b`` of text keys, enough to connect every class."""
    rows = vectors.select("key", "centre", F.posexplode("bands").alias("band", "hash"))
    order = F.struct("centre", "key")
    counted = rows.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("n"), F.max(order)["key"].alias("leader")
    )
    members = scratch.keep(
        rows.join(counted.where(F.col("n") > 1), ["band", "hash"]).drop("centre"), "members"
    )
    small = members.where(F.col("n") <= SMALL_BUCKET).select("band", "hash", "key")
    near = (
        small.join(small.withColumnRenamed("key", "other"), ["band", "hash"])
        .where(F.col("key") < F.col("other"))
        .select(*_pair(F.col("key"), F.col("other")))
    )
    large = members.where(F.col("n") > SMALL_BUCKET)
    led = large.where(F.col("key") != F.col("leader")).select(*_pair(F.col("key"), F.col("leader")))
    found = scratch.keep(_verified(near.unionByName(led).distinct(), vectors, similar), "links")

    keys = large.select(F.col("key").alias("id")).distinct()
    between, n_links = found.select(F.col("a").alias("src"), F.col("b").alias("dst")), found.count()
    for end in ("src", "dst"):
        hot = hot_keys(between, end, total=n_links)
        between = lookup(between, keys.withColumnRenamed("id", end), end, how="left_semi", hot=hot, null_keys=False)
    labelled = scratch.keep(components(keys, between, scratch), "labels")
    leading = labelled.select(F.col("id").alias("leader"), F.col("component").alias("led"))
    placed = large.join(labelled.withColumnRenamed("id", "key"), "key").join(leading, "leader").select(
        "band", "hash", "key", "n", "component", (F.col("component") != F.col("led")).alias("is_left")
    )
    placed = scratch.keep(placed, "placed")
    count = placed.where("is_left").groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n_left"))
    mixed = placed.join(count, ["band", "hash"])
    spread = F.abs(F.xxhash64("key", "band"))
    left_blocks = F.ceil(F.col("n_left") / LEFT_BLOCK).cast("int")
    all_blocks = F.ceil(F.col("n") / ALL_BLOCK).cast("int")
    through = lambda blocks: F.explode(F.sequence(F.lit(0), blocks - 1))
    left = mixed.where("is_left").select(
        "band", "hash", "key", "component", "is_left", F.lit(True).alias("left"),
        F.pmod(spread, left_blocks).cast("int").alias("left_block"), through(all_blocks).alias("all_block"),
    )
    every = mixed.select(
        "band", "hash", "key", "component", "is_left", F.lit(False).alias("left"),
        through(left_blocks).alias("left_block"), F.pmod(spread, all_blocks).cast("int").alias("all_block"),
    )
    cells = left.unionByName(every).join(
        vectors.select("key", "total", "hashes", "weights", "bands"), "key"
    )
    rest = scratch.keep(_compare_left(cells, similar), "more-links")
    return found.unionByName(rest).distinct()


def near_duplicates(docs: DataFrame, scratch: Scratch, *, similar: float = SIMILAR) -> DataFrame:
    """``key, class_key, copies, links``: the class of every distinct text, by text key."""
    spark = docs.sparkSession
    importable(spark)
    keyed = docs.select(text_key().alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = keyed.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    bits = (blocks - 1).bit_length()
    # Copies in one task combine before they are sent, so a text that fills the table is no load.
    texts = scratch.keep(
        keyed.groupBy("key")
        .agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
        .withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")),
        "texts",
        compression="zstd",
    )
    n_texts = texts.count()
    # The shuffled texts are held by the last finished job until another one has run.
    release(spark)
    back = scratch.keep(_count(_send(texts, bits)), "shared")
    release(spark)
    vectors = scratch.keep(
        _sample(texts.select("block", "key", "text"), back, n_texts, bits, similar), "vectors"
    )
    ids = scratch.keep(texts.select("key", "copies"), "ids")
    scratch.drop("texts", "shared")
    release(spark)
    found = scratch.keep(links(vectors, scratch, similar), "all-links")
    ends = found.select(F.col("a").alias("key")).unionAll(found.select(F.col("b").alias("key")))
    degree = ends.groupBy("key").agg(F.count(F.lit(1)).alias("n_links"))
    labels = components(
        degree.select(F.col("key").alias("id"), "n_links"),
        found.select(F.col("a").alias("src"), F.col("b").alias("dst")),
        scratch,
    )
    joined = ids.join(labels.withColumnRenamed("id", "key"), "key", "left")
    return joined.select(
        "key",
        F.coalesce("component", "key").alias("class_key"),
        "copies",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def classes(docs: DataFrame, scratch: Scratch, *, similar: float = SIMILAR) -> DataFrame:
    """``doc_id, class_id, class_size, n_links``, one row per document.

    ``class_id`` is the smallest id in the class, ``n_links`` the verified links of the
    document's text to other texts.
    """
    found = scratch.keep(near_duplicates(docs, scratch, similar=similar), "classes")
    ids = docs.select("doc_id", text_key().alias("key"))
    smallest = ids.groupBy("key").agg(F.min("doc_id").alias("first"))
    named = found.join(smallest, "key")
    per_class = named.groupBy("class_key").agg(
        F.min("first").alias("class_id"), F.sum("copies").alias("class_size")
    )
    by_text = found.join(per_class, "class_key").select("key", "class_id", "class_size", "n_links")
    return ids.join(by_text, "key").select("doc_id", "class_id", "class_size", "n_links")


def keep_one(docs: DataFrame, scratch: Scratch, *, similar: float = SIMILAR) -> DataFrame:
    """One document of each class, with all its columns: of those with the smallest id, one."""
    found = scratch.keep(near_duplicates(docs, scratch, similar=similar), "classes")
    placed, file, row = addressed(docs, scratch)
    # Ids before none, then by text; of repeated rows the first in its place. Everything but the
    # last join is on digests and places, and that join is on places: no text is a hot key there.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", text_key().alias("key"), file, row)
    first = placed.select(order.alias("one")).groupBy("one.key").agg(F.min("one").alias("one"))
    chosen = (
        found.join(first, "key").groupBy("class_key").agg(F.min("one").alias("one"))
    ).select(F.col(f"one.{file}").alias(file), F.col(f"one.{row}").alias(row))
    return placed.join(chosen, [file, row], "left_semi").select(*docs.columns)
