"""Vectorised text primitives on Arrow buffers, and small Spark helpers shared by the operators of this subpackage.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; UTF-8 never uses these bytes inside a character, so byte
runs and character runs agree.  Hashes are multilinear with fixed pseudo-random multipliers modulo 2**64 and a final mix:
two different strings collide with a chance below 2**-56, and callers that need more use two independent seeds.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

U64 = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of text worked on at once; bounds the temporary arrays (about 60 times as many bytes). A longer document goes alone.
BLOCK_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of the public-domain splitmix64 generator."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_multipliers: dict[int, np.ndarray] = {}


def multipliers(seed: int, n: int) -> np.ndarray:
    have = _multipliers.get(seed)
    if have is None or len(have) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        steps = np.arange(1, size + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64((seed * 0xD1342543DE82EF95) & (2**64 - 1))
        have = _multipliers[seed] = mix(steps) | U64(1)
    return have


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column, size: int = 0):
    """(first, last, bytes, offsets) for runs of rows of about BLOCK_BYTES."""
    size = size or BLOCK_BYTES
    data, offsets = buffers(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; a document's end also ends a word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    solid = ~SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    starts, ends = solid.copy(), solid.copy()
    starts[1:] &= ~solid[:-1] | begins[1:-1]
    ends[:-1] &= ~solid[1:] | begins[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_index(starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every position of the spans one after another, and its distance from its span's start."""
    total = int(lens.sum())
    within = np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens)
    return np.repeat(starts, lens) + within, within


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: tuple[int, ...] = (1,), lower: bool = False) -> list[np.ndarray]:
    """A hash per seed of each span of bytes; an empty span has 0."""
    lens = ends - starts
    out = [np.zeros(len(starts), U64) for _ in seeds]
    full = np.flatnonzero(lens > 0)
    if not len(full):
        return out
    index, within = span_index(starts[full], lens[full])
    value = (LOWER[data[index]] if lower else data[index]).astype(U64) + U64(1)
    first = np.cumsum(lens[full]) - lens[full]
    most = int(lens.max())
    for h, seed in zip(out, seeds, strict=True):
        h[full] = mix(np.add.reduceat(value * multipliers(seed, most)[within], first) + lens[full].astype(U64))
    return out


def window_hashes(words: np.ndarray, k: int, seed: int = 7) -> np.ndarray:
    """Hash of each run of k consecutive word hashes; runs over document ends are included, so mask them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    r, out = multipliers(seed, k), np.zeros(n, U64)
    for j in range(k):
        out += words[j : j + n] * r[j]
    return mix(out)


def documents_of(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First word of each document, with the number of words at the end."""
    return np.searchsorted(starts, offsets, "left")


def line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of lines (split at \\n), and each document's first line, with the number of lines at the end."""
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, offsets, "left")
    n = len(offsets) - 1
    first = before + np.arange(n + 1)
    starts, ends = np.zeros(first[-1], np.int64), np.zeros(first[-1], np.int64)
    doc = np.searchsorted(offsets, breaks, "right") - 1
    at = np.arange(len(breaks)) + doc
    starts[first[:-1]] = offsets[:-1]
    starts[at + 1] = breaks + 1
    ends[first[1:] - 1] = offsets[1:]
    ends[at] = breaks
    return starts, ends, first


def texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, offsets: np.ndarray, first: np.ndarray, keep: np.ndarray, joint: int, unit_joint: bool = True) -> pa.Array:
    """Per document the kept units (words or lines) joined by one byte.  first: each document's first unit, and the end."""
    kept = np.flatnonzero(keep)
    doc = np.searchsorted(first, kept, "right") - 1
    lens = ends[kept] - starts[kept] + 1
    index, within = span_index(starts[kept], lens)
    last = np.repeat(lens - 1, lens) == within
    index[last] = 0
    out = data[index] if len(data) else np.zeros(len(index), np.uint8)
    out[last] = joint
    size = np.bincount(doc, weights=lens, minlength=len(first) - 1).astype(np.int64)
    whole = np.concatenate([[0], np.cumsum(size)])
    drop = whole[1:][size > 0] - 1  # the joint after a document's last unit
    solid = np.ones(len(out), bool)
    solid[drop] = False
    final = np.concatenate([[0], np.cumsum(size - (size > 0))]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(final), pa.py_buffer(np.ascontiguousarray(out[solid]))).cast(pa.string())


def positional(fields) -> list:
    """The columns under plain names, so that mapInArrow takes columns of any name (it cannot find a name with a dot)."""
    return [F.col(f"`{f.name}`").alias(f"riskloom {i}") for i, f in enumerate(fields)]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


#: Folders that shared_folder() has given out and nobody has removed.
_folders: list[str] = []


def shared_folder(spark) -> str:
    """A new folder that driver and executors share: inside spark.checkpoint.dir, or in a local run without one, in the warehouse.

    On a cluster the setting must be there: a folder of the driver's machine would not be seen by executors.  The folder is
    removed by sweep(), or when the driver's process ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.riskloom"
    if not _folders:
        atexit.register(_leave, spark)
    _folders.append(f"{base.rstrip('/')}/riskloom-{uuid.uuid4().hex}")
    return _folders[-1]


def folders_made() -> int:
    """How many folders there are, for sweep(since=...)."""
    return len(_folders)


def sweep(spark, since: int = 0) -> None:
    """Remove the folders made after the first `since`; DataFrames that still read them must have been used up."""
    for path in _folders[since:]:
        _delete(spark, path)
    del _folders[since:]


def _leave(spark) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone
        sweep(spark)


def stored(df, name: str, folder: str | None = None):
    """The rows written as Parquet in the shared folder and read again: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark, path: str) -> None:
    """Delete a folder made by shared_folder(), or one inside it, whatever store it is in."""
    _delete(spark, path)
    if path in _folders:
        _folders.remove(path)


def _delete(spark, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def binaries(parts: list[np.ndarray]) -> pa.Array:
    """A binary value of each array's bytes."""
    sizes = np.array([p.nbytes for p in parts], np.int64)
    data = np.concatenate([np.ascontiguousarray(p).view(np.uint8) for p in parts]) if parts else np.zeros(0, np.uint8)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())
