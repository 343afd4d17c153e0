"""A run's folder appears whole or not at all.

A run writes under an attempt's folder beside its own and takes its place when everything is there.
If it fails, the attempt is removed and an earlier run stays as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def publishing(spark: SparkSession, path: str) -> Iterator[str]:
    """The folder to write to; on leaving without an error it becomes ``path``.

    Folders are renamed by the file system, so no reader sees records of one run beside the
    manifest of another. An earlier run is moved aside first and removed last: should the driver be
    lost between the two renames, it is still there, under a hidden name.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    mark = uuid.uuid4().hex
    attempt, aside = (f"{parent}/.{name}.{kind}-{mark}" for kind in ("attempt", "before"))
    target, new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, attempt, aside))
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        yield attempt
    except BaseException:
        store.delete(new, True)
        raise
    replaced = store.exists(target)
    if replaced and not store.rename(target, old):
        raise OSError(f"cannot move the earlier run at {path}")
    if not store.rename(new, target):
        if replaced:
            store.rename(old, target)
        raise OSError(f"cannot publish the run at {path}")
    if replaced:
        store.delete(old, True)
