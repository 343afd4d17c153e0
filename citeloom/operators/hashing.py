"""Content hashes for run folders, the same rule at every size.

Identifiers are hashed as a multiset: the SHA-256 digests of all values are added up as vectors of
limbs, which needs no order and no grouping and combines map-side; the sums and their number are
hashed once more. Two inputs agree by chance as rarely as digests do; unlike a plain digest, sums do
not resist somebody who searches for inputs that agree, which run folders need not fear. The tree of
digests does resist: distinct values with their counts are its leaves, in the order of their digests.

Files are hashed by their bytes: byte ranges of fixed length, read and digested by executors, are
the leaves of a tree of digests with bounded fan-in, so a file of any size, with or without line
ends, is spread over tasks and no task sees more than a range or one node's digests.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.identifiers import strip

HASH_LENGTH = 16
# Identifiers that the exact mode takes; they pass through one task.
EXACT_LIMIT = 1_000_000
# Hexadecimal digits in a limb: sums stay within 63 bits up to eight trillion values.
_LIMB = 5
# Bytes in a leaf, and digests in a node above.
RANGE = 8 << 20
_FANOUT = 1024
# Fixed value: what an input without identifiers is answered with.
_NO_IDENTIFIERS = "at least one identifier is required to compute a hash"


def _digest(values: Column) -> Column:
    return F.sha2(F.array_join(F.sort_array(values), "\n"), 256)


def _multiset_digest(items: DataFrame) -> DataFrame:
    """One-row ``hash, n`` of a column ``item``; an item counts as often as it occurs."""
    hashed = items.select(F.sha2("item", 256).alias("sha"))
    sums = [
        F.sum(F.conv(F.substring("sha", at, _LIMB), 16, 10).cast("bigint")).alias(f"limb{at}")
        for at in range(1, 65, _LIMB)
    ]
    added = hashed.agg(*sums, F.count(F.lit(1)).alias("n"))
    whole = F.concat_ws("\n", *[F.col(c).cast("string") for c in added.columns])
    return added.select(F.substring(F.sha2(whole, 256), 1, HASH_LENGTH).alias("hash"), "n")


def _tree_digest(items: DataFrame) -> DataFrame:
    """One-row ``hash, n`` of ``(item, n)`` rows, item distinct.

    Leaves come from the item's own digest, so they are even whatever the items look like; a
    value repeated a billion times is one item with a count.
    """
    hashed = items.select(F.sha2("item", 256).alias("sha"), "n")
    leaf = F.conv(F.substring("sha", 1, _LIMB), 16, 10).cast("int")
    leaves = hashed.select(
        leaf.alias("leaf"), F.concat_ws(":", "sha", F.col("n")).alias("entry"), "n"
    ).groupBy("leaf").agg(_digest(F.collect_list("entry")).alias("digest"), F.sum("n").alias("n"))
    labelled = F.concat_ws(":", F.lpad(F.col("leaf").cast("string"), 7, "0"), F.col("digest"))
    branches = leaves.groupBy(F.floor(F.col("leaf") / _FANOUT).cast("int").alias("leaf")).agg(
        _digest(F.collect_list(labelled)).alias("digest"), F.sum("n").alias("n")
    )
    return branches.agg(
        F.substring(_digest(F.collect_list(labelled)), 1, HASH_LENGTH).alias("hash"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
    )


def hash_identifiers(ids: DataFrame, column: str = "id", *, mode: str = "sum") -> DataFrame:
    """One-row ``hash, n`` of a column of identifiers: stripped, blanks dropped, order-free.

    Repeated identifiers count as often as they occur. ``mode="tree"`` is a tree of digests of the
    distinct values and their counts, of any number. ``mode="exact"`` is one SHA-256 over all
    values in sorted order, which passes through one task: for lists of at most ``EXACT_LIMIT``
    values, longer ones are refused, where the hash has to equal one made elsewhere.
    """
    if mode not in ("tree", "sum", "exact"):
        raise ValueError("mode is tree, sum or exact")
    cleaned = ids.select(strip(F.col(column)).alias("item")).where(F.col("item") != "")
    if mode == "exact":
        n = cleaned.limit(EXACT_LIMIT + 1).count()
        if n > EXACT_LIMIT:
            raise ValueError(f"the exact hash takes {EXACT_LIMIT} identifiers at most")
    else:
        n = not cleaned.isEmpty()
    if not n:
        raise ValueError(_NO_IDENTIFIERS)
    if mode == "exact":
        return cleaned.agg(
            F.substring(_digest(F.collect_list("item")), 1, HASH_LENGTH).alias("hash"),
            F.count(F.lit(1)).alias("n"),
        )
    if mode == "tree":
        return _tree_digest(cleaned.groupBy("item").agg(F.count(F.lit(1)).alias("n")))
    return _multiset_digest(cleaned)


def hash_values(values: Sequence[str]) -> str:
    """Exact hash of a short list held by the driver, such as a query and its date bounds."""
    cleaned = sorted(v.strip() for v in values if v.strip())
    if not cleaned:
        raise ValueError(_NO_IDENTIFIERS)
    return hashlib.sha256("\n".join(cleaned).encode()).hexdigest()[:HASH_LENGTH]


def _in_order(rows: DataFrame, keys: Sequence[str], place: str) -> DataFrame:
    """Digest of each group's digests in the order of ``place``, one level up the tree."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(place), F.col("digest"))))
    return rows.groupBy(*keys).agg(
        F.sha2(F.array_join(F.transform(listed, lambda r: r["digest"]), "\n"), 256).alias("digest")
    )


def file_digests(lines: DataFrame, levels: int = 3) -> DataFrame:
    """``path, digest`` of ``path, line_no, value`` rows; ``line_no`` counts from 1.

    ``levels`` times, stretches of as many rows as the fan-in become one; the few that are left of
    a file (more than a trillion lines apart) become its digest.
    """
    rows = lines.select("path", (F.col("line_no") - 1).alias("place"), F.sha2("value", 256).alias("digest"))
    return tree_digests(rows, levels)


def _read_ranges(length: int):
    """Digests of byte ranges, each read by itself from a store that Arrow can open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            digests = []
            for path, place in zip(batch.column("path").to_pylist(), batch.column("place").to_pylist()):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    digests.append(hashlib.sha256(file.read_at(length, place * length)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("place"), pa.array(digests, pa.string())],
                ["path", "place", "digest"],
            )

    return run


# Address schemes of stores that Arrow opens by itself.
_ARROW_STORES = ("file:", "hdfs:", "s3:", "gs:")


def range_digests(files: DataFrame, length: int = RANGE) -> DataFrame:
    """``path, place, digest`` of every byte range of binary files; Spark lists no empty ones.

    Only names and sizes are read before the ranges are dealt out. Files in a store that Arrow
    cannot open are read whole by Spark, which takes up to 2 GB a file, and cut the same way.
    """
    last = F.floor((F.col("length") - 1) / length)
    ranges = files.select("path", F.explode(F.sequence(F.lit(0), last)).alias("place"))
    opened = F.lower("path").rlike("^(" + "|".join(_ARROW_STORES) + ")")
    address = F.regexp_replace("path", "^file:/+", "file:///").alias("path")
    spread = ranges.where(opened).select(address, "place")
    spread = spread.repartition("path", "place")
    by_range = spread.mapInArrow(
        _read_ranges(length), "path string, place bigint, digest string"
    )
    cut = F.transform(
        F.sequence(F.lit(0), last),
        lambda p: F.sha2(F.substr("content", (p * length + 1).cast("int"), F.lit(length)), 256),
    )
    whole = files.where(~opened).select("path", F.posexplode(cut).alias("place", "digest"))
    return by_range.unionByName(whole.withColumn("place", F.col("place").cast("bigint")))


def tree_digests(leaves: DataFrame, levels: int = 3) -> DataFrame:
    """``path, digest`` of ``path, place, digest`` rows, in the order of their places."""
    rows = leaves
    for _ in range(levels):
        rows = _in_order(
            rows.withColumn("up", F.floor(F.col("place") / _FANOUT)), ["path", "up"], "place"
        ).withColumnRenamed("up", "place")
    return _in_order(rows, ["path"], "place")


def hash_files(spark: SparkSession, paths: Sequence[str], length: int = RANGE) -> str:
    """Hash of file contents in path order; names do not count, missing paths are skipped.

    Each file counts with its length and the tree digest of its bytes; a folder stands for the
    files in it.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def exists(path: str) -> bool:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(conf).exists(hadoop_path)

    found = [path for path in sorted(set(paths)) if exists(path)]
    whole = hashlib.sha256()
    for path in found:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        )
        sizes = {_bare(r["path"]): r["length"] for r in files.select("path", "length").collect()}
        # One row per file.
        digests = tree_digests(range_digests(files, length)).collect()
        for name, digest in sorted((_bare(r["path"]), r["digest"]) for r in digests):
            whole.update(f"{sizes[name]}:{digest}\n".encode())
    return whole.hexdigest()[:HASH_LENGTH]


def _bare(path: str) -> str:
    return re.sub(r"^file:/+", "/", path)
