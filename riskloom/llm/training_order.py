"""Training-order materialisation: every fixed-length token sequence gets a global slot, and slots become binary shards.

Token ids have 1, 2 or 4 bytes, little-endian: a text gives its UTF-8 bytes as 8-bit ids, a binary column is taken as ids
already (those of pieces.encode_documents have 4 bytes).  The two greatest ids of the width are taken: END closes a document and
PAD fills its last sequence (0xFF and 0xFE, which do not occur in UTF-8).  Sequences are numbered by document id, hash of the
text, text and place, 0..N-1 (documents without an id come last); a keyed Feistel network permutes the numbers, walking its
cycle while a value falls outside 0..N-1, so slots are a permutation of 0..N-1 that any reader can recompute from (key, N).
A shard holds SHARD_SEQUENCES consecutive slots at a fixed stride: slot s lies at byte (s % SHARD_SEQUENCES) * stride of shard
s // SHARD_SEQUENCES, so reading is sequential and can resume at any slot.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

LENGTH = 1024
SHARD_SEQUENCES = 2048
ROUNDS = 6


def feistel(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """The slot of each index: a permutation of 0..total-1."""
    half = max(1, ((max(total - 1, 1)).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = K.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key & (2**64 - 1)))
    value = index.astype(np.uint64)
    todo = np.arange(len(value))
    while len(todo):
        left, right = value[todo] >> shift, value[todo] & mask
        for k in keys:
            left, right = right, left ^ (K.mix(right + k) & mask)
        value[todo] = left << shift | right
        todo = todo[value[todo] >= np.uint64(total)]  # outside: walk on along the cycle
    return value.astype(np.int64)


def feistel_inverse(slot: np.ndarray, total: int, key: int) -> np.ndarray:
    """The index of each slot."""
    half = max(1, ((max(total - 1, 1)).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = K.mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(key & (2**64 - 1)))[::-1]
    value = slot.astype(np.uint64)
    todo = np.arange(len(value))
    while len(todo):
        left, right = value[todo] >> shift, value[todo] & mask
        for k in keys:
            left, right = right ^ (K.mix(left + k) & mask), left
        value[todo] = left << shift | right
        todo = todo[value[todo] >= np.uint64(total)]
    return value.astype(np.int64)


def _place_in(bounds: list[int], value):
    """How many of the ordered bounds are not above a value, by binary search."""
    if not bounds:
        return F.lit(0)
    edges, n = F.array(*map(F.lit, bounds)), len(bounds)
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(n.bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= n) & (F.get(edges, at + step - 1) <= value), at + step).otherwise(at))


def _ranged(docs: DataFrame, length: int, token_bytes: int) -> tuple[DataFrame, dict[int, int], int]:
    """The documents in ranges of ids, sorted within (null ids in ranges of their texts' hashes); the number of each range's first sequence; the number of all.

    Ranges come from quantiles of the ids (bounded by the number of partitions) and sums by range, so that the texts are
    shuffled once and no table of numbers is joined to them, whatever their number.
    """
    spark = docs.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds = sorted({int(x) for x in docs.approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts)})
    digest = F.xxhash64("text")
    docs = docs.withColumn("range", F.when(F.col("id").isNull(), parts + F.pmod(digest, F.lit(parts)).cast("int")).otherwise(_place_in(bounds, F.col("id")))).withColumn("digest", digest)
    sums = docs.groupBy("range").agg(F.sum(F.ceil((F.octet_length("text") / token_bytes + 1) / length)).cast("long").alias("n")).collect()
    first, total = {}, 0
    for r in sorted(sums):
        first[r.range], total = total, total + r.n
    return docs.repartitionById(parts, "range").sortWithinPartitions("range", "id", "digest", "text"), first, total


def materialise(
    docs: DataFrame, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES, key: int = 20240101, id_col: str = "doc_id", text_col: str = "text", repeated: bool = False, token_bytes: int = 1
) -> DataFrame:
    """One row a shard: (shard, first_slot, n_sequences, length, total, doc_ids, places, payload).

    payload: the sequences of slots first_slot .. first_slot + n_sequences - 1 one after another, `length` ids of `token_bytes`
    bytes each; doc_ids and places: where each comes from.  A null or empty text has no sequence; longer texts have as
    many as they need.  A row with a null id has its sequences like others, with a null in doc_ids.  repeated: rows that
    share an id each have their own sequences, in the order of their texts' hashes, then texts (equal rows are interchangeable);
    without it they are refused.  An empty table gives no rows.
    """
    if token_bytes not in (1, 2, 4):
        raise ValueError("ids have 1, 2 or 4 bytes")
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("octet_length(text) > 0")
    ranged, base, total = _ranged(own, length, token_bytes)
    shards = max(1, -(-total // shard_sequences))
    kind, stride = np.dtype(f"<u{token_bytes}"), length * token_bytes
    end, pad = np.iinfo(kind).max, np.iinfo(kind).max - 1

    def cut(batches):
        done, last = dict(base), None
        for batch in batches:
            ids, ranges = batch.column(0), batch.column(2).to_numpy()
            if not repeated:
                held = ids.drop_null().to_numpy()
                if len(held) and ((held[1:] == held[:-1]).any() or held[0] == last):
                    raise ValueError("several rows have the same id")
                last = held[-1] if len(held) else last
            for lo, hi, data, offsets in K.blocks(batch.column(1)):
                size = np.diff(offsets) // token_bytes
                if len(data) != int(size.sum()) * token_bytes:
                    raise ValueError(f"a row's ids are not whole numbers of {token_bytes} bytes")
                n = -(-(size + 1) // length)
                begin = np.cumsum(n) - n
                firsts = np.zeros(hi - lo, np.int64)
                for r in np.unique(ranges[lo:hi]):
                    own = ranges[lo:hi] == r
                    firsts[own] = done[r] + np.cumsum(n[own]) - n[own]
                    done[r] += int(n[own].sum())
                out = np.full(int(n.sum()) * length, pad, kind)
                to, _ = K.span_index(begin * length, size)
                out[to] = np.frombuffer(data.tobytes(), kind)
                out[begin * length + size] = end
                index, place = K.span_index(firsts, n)
                slot = feistel(index, total, key)
                stops = np.arange(len(slot) + 1, dtype=np.int64) * stride
                tokens = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(slot), [None, pa.py_buffer(stops), pa.py_buffer(out)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array((slot // shard_sequences).astype(np.int32)), pa.array(slot), ids.take(pa.array(np.repeat(np.arange(lo, hi), n))), pa.array(place), tokens], ["shard", "slot", "id", "place", "tokens"])

    def pack(batches):
        rows: list = []
        shard = None

        def done():
            slots, ids, places, tokens = zip(*rows, strict=True)
            columns = [pa.array([shard], pa.int32()), pa.array([slots[0]], pa.int64()), pa.array([len(rows)], pa.int64()), pa.array([length], pa.int32()), pa.array([total], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([places], pa.list_(pa.int64())), pa.array([b"".join(tokens)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["shard", "first_slot", "n_sequences", "length", "total", "doc_ids", "places", "payload"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if row[0] != shard:
                    if rows:
                        yield done()
                    rows, shard = [], row[0]
                rows.append(row[1:])
        if rows:
            yield done()

    schema = "shard int, first_slot long, n_sequences long, length int, total long, doc_ids array<long>, places array<long>, payload binary"
    placed = ranged.select("id", "text", "range").mapInArrow(cut, "shard int, slot long, id long, place long, tokens binary")
    # slots are spread evenly, so equal ranges of shards are equal ranges of rows: no sampling pass is needed
    parts = min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-shards // 8)))
    packed = placed.repartitionById(parts, (F.col("shard").cast("long") * parts / shards).cast("int"))
    return packed.sortWithinPartitions("slot").mapInArrow(pack, schema)


def write_shards(shards: DataFrame, folder: str) -> DataFrame:
    """Write each shard of materialise() as <folder>/shard-<number>.bin; returns (shard, n_sequences, path, sha256).

    A file appears under its name only when it is whole, and equal rows write equal files, so a task that runs again does
    no harm and a job that stopped can be run again.  The folder is a URI that all executors reach, of a store that Arrow
    knows (file, hdfs, s3 or s3a, gs, abfs).
    """
    folder = "s3" + folder[3:] if folder.startswith("s3a:") else folder

    def write(batches):
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(folder)
        where.create_dir(base, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                name = f"{base}/shard-{row['shard']:08d}.bin"
                digest = hashlib.sha256(row["payload"]).hexdigest()
                with where.open_output_stream(f"{name}.{digest[:12]}.tmp") as f:
                    f.write(row["payload"])
                where.move(f"{name}.{digest[:12]}.tmp", name)
                yield pa.RecordBatch.from_pylist([{"shard": row["shard"], "n_sequences": row["n_sequences"], "path": name, "sha256": digest}], schema=pa.schema([("shard", pa.int32()), ("n_sequences", pa.int64()), ("path", pa.string()), ("sha256", pa.string())]))

    return shards.select("shard", "n_sequences", "payload").mapInArrow(write, "shard int, n_sequences long, path string, sha256 string")


def query(spark, sf_dir):
    """All shards of the documents' bytes; odd texts and ids as in materialise(), repeated ids with sequences of their own."""
    return materialise(spark.read.parquet(f"{sf_dir}/documents.parquet"), repeated=True).withColumn("payload_sha256", F.sha2("payload", 256))
