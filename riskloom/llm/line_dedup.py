"""Line dedup: lines that many documents share are found in perfect-hash shards, not by joining lines.

1. A pass over all texts hashes every line's key to 128 bits and counts documents a key (partial sums before the shuffle).
2. Keys of at least ``min_docs`` documents go, by hash, to shards of at most ``SHARD_KEYS`` expected keys; a task builds a
   minimal perfect hash for each with compact fingerprint and count arrays.  Rarer keys can never drop a line, so a miss
   in the arrays means "keep".  The slot is found from both hashes together, and the second hash is the fingerprint.
3. Lines probe the arrays.  While the shards are below ``broadcast_bytes`` together they are broadcast, and a second pass over
   the texts probes them and rebuilds the texts: no line is shuffled.  Beyond that, lines' hashes go to their shards, which
   are read once each (a shard with very many probes: once a part), and the lines found come back by their text's digest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .perfect_hash import Shard

SHARD_KEYS = 500_000
SHARD_BYTES = 13  # of a key, about
FLUSH_KEYS = 1_000_000
#: Documents with a shard's lines, about, for each part that the probes of a shard are cut into.
PART_DOCS = 2_000_000


def _keys(data, offsets):
    """Lines, each document's first line, and the two hashes of each line's key (0, 0: an empty key)."""
    starts, ends, first = K.line_bounds(data, offsets)
    begin, end = K.word_bounds(data, offsets)
    a, b = np.searchsorted(begin, starts, "left"), np.searchsorted(begin, ends, "left")
    full = b > a
    s, e = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    s[full], e[full] = begin[a[full]], end[b[full] - 1]
    h1, h2 = K.span_hashes(data, s, e, (11, 12), lower=True)
    return starts, ends, first, full, h1, h2


def _sum(parts):
    h1, h2, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((h2, h1))
    h1, h2, n = h1[order], h2[order], n[order]
    new = np.ones(len(h1), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    at = np.flatnonzero(new)
    return h1[at], h2[at], np.add.reduceat(n, at) if len(at) else n


def line_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(h1, h2, n): in how many rows each line key is found."""

    def count(batches):
        parts, held = [], 0
        for batch in batches:
            for _, _, data, offsets in K.blocks(batch.column(0)):
                _, _, first, full, h1, h2 = _keys(data, offsets)
                doc = np.repeat(np.arange(len(first) - 1), np.diff(first))[full]
                h1, h2 = h1[full], h2[full]
                order = np.lexsort((h2, h1, doc))
                doc, h1, h2 = doc[order], h1[order], h2[order]
                new = np.ones(len(h1), bool)
                new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | (doc[1:] != doc[:-1])
                parts.append((h1[new], h2[new], np.ones(int(new.sum()), np.int64)))
                held += len(parts[-1][0])
                if held > FLUSH_KEYS:
                    parts = [_sum(parts)]
                    held = len(parts[0][0])
                    if held > FLUSH_KEYS // 2:
                        yield _rows(parts.pop())
                        held = 0
        if parts:
            yield _rows(_sum(parts))

    def _rows(part):
        return pa.RecordBatch.from_arrays([pa.array(K.signed(part[0])), pa.array(K.signed(part[1])), pa.array(part[2])], ["h1", "h2", "n"])

    counts = docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "h1 long, h2 long, n long")
    return counts.groupBy("h1", "h2").agg(F.sum("n").alias("n"))


def build_index(docs: DataFrame, min_docs: int, text_col: str = "text", shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int, int]:
    """(shard, weight, blob) of every shard, written; the number of shards; the number of keys."""
    folder = K.shared_folder(docs.sparkSession)
    frequent = K.stored(line_counts(docs, text_col).filter(F.col("n") >= min_docs), "lines", folder)
    total = frequent.count()
    number = max(1, math.ceil(total / shard_keys))

    def build(key, table):
        h1, h2 = (table[c].to_numpy().view(np.uint64) for c in ("h1", "h2"))
        n = table["n"].to_numpy()
        # two keys with equal h1 would break the hash: they are told apart by h2
        blob = Shard.build(h1 ^ K.mix(h2), h2, np.minimum(n, 2**32 - 1)).to_bytes()
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "weight": pa.array([int(n.sum())], pa.int64()), "blob": pa.array([blob], pa.binary())})

    shards = frequent.withColumn("shard", F.pmod(F.col("h1"), F.lit(number)).cast("int")).groupBy("shard").applyInArrow(build, "shard int, weight long, blob binary")
    shards = K.stored(shards, "shards", folder)
    K.remove(docs.sparkSession, f"{folder}/lines")
    return shards, number, total


def _cut(batch, lo, hi, data, offsets, starts, ends, first, drop, names):
    """The rows lo..hi-1 without the dropped lines; the text is the first column, the row's other columns come after it."""
    text = K.texts(data, starts, ends, offsets, first, ~drop, 10)
    dropped = np.diff(np.concatenate([[0], np.cumsum(drop)])[first])
    return pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(1, len(names) - 2)), text, pa.array(np.diff(first)), pa.array(dropped)], names)


def _found_by_shard(docs: DataFrame, shards: DataFrame, number: int, min_docs: int) -> DataFrame:
    """(d1, d2, drop): the numbers of the frequent lines of every different text that has any; docs: (text, d1, d2)."""
    parts = {r.shard: r.parts for r in shards.select("shard", F.ceil(F.col("weight") / PART_DOCS).cast("int").alias("parts")).collect()}

    def hashes(batches):
        cuts = np.zeros(number, np.int64)  # shards that are not there have no keys
        for k, n in parts.items():
            cuts[k] = n
        for batch in batches:
            d1, d2 = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for lo, hi, data, offsets in K.blocks(batch.column(0)):
                _, _, first, full, h1, h2 = _keys(data, offsets)
                doc = np.repeat(np.arange(hi - lo), np.diff(first))
                line = np.arange(len(h1)) - first[doc]
                shard = h1.view(np.int64) % number
                use = np.flatnonzero(full & (cuts[shard] > 0))
                if len(use):
                    a, b = d1[lo + doc[use]], d2[lo + doc[use]]
                    part = (a.view(np.uint64) % cuts[shard[use]].astype(np.uint64)).astype(np.int32)
                    none = pa.nulls(len(use), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(shard[use].astype(np.int32)), pa.array(part), none, pa.array(K.signed(h1[use])), pa.array(K.signed(h2[use])), pa.array(a), pa.array(b), pa.array(line[use])], names)

    def probe(batches):
        index, at = None, None
        for batch in batches:
            shard, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            begin = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (part[1:] != part[:-1]))) if len(shard) else np.zeros(0, np.int64)
            for a, b in zip(begin.tolist(), [*begin[1:].tolist(), len(shard)], strict=True):
                rows = batch.slice(a, b - a)
                if (shard[a], part[a]) != at:  # a shard's part begins with its arrays
                    index, at = Shard.from_bytes(rows.column(2)[0].as_py()), (shard[a], part[a])
                    rows = rows.slice(1)
                h1, h2 = (rows.column(i).to_numpy().view(np.uint64) for i in (3, 4))
                hit = pa.array(np.flatnonzero(index.lookup(h1 ^ K.mix(h2), h2) >= min_docs))
                if len(hit):
                    yield pa.RecordBatch.from_arrays([rows.column(i).take(hit) for i in (5, 6, 7)], ["d1", "d2", "line"])

    schema = "shard int, part int, blob binary, h1 long, h2 long, d1 long, d2 long, line long"
    names = ["shard", "part", "blob", "h1", "h2", "d1", "d2", "line"]
    arrays = shards.select("shard", F.explode(F.sequence(F.lit(0), F.ceil(F.col("weight") / PART_DOCS).cast("int") - 1)).alias("part"), "blob", *(F.lit(None).cast("long").alias(c) for c in names[3:]))
    every = docs.mapInArrow(hashes, schema).unionByName(arrays)
    found = every.repartition("shard", "part").sortWithinPartitions("shard", "part", F.col("blob").isNull()).mapInArrow(probe, "d1 long, d2 long, line long")
    return found.groupBy("d1", "d2").agg(F.collect_set("line").alias("drop"))


def drop_common_lines(docs: DataFrame, min_docs: int = 10, text_col: str = "text", broadcast_bytes: int = 32 << 20, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """All columns of `docs` with the lines found in at least `min_docs` rows taken out of the text, and n_lines and
    n_dropped (columns of these names in the input are replaced).

    A key is the line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased; lines with an empty key always stay.  A
    null or empty text is one empty line and gives an empty text.  Every copy of a frequent line goes, in every row; a
    line that a row repeats counts once for it; rows that are equal count each.  An empty table gives an empty table.
    """
    shards, number, total = build_index(docs, min_docs, text_col, shard_keys)
    spark, text = docs.sparkSession, F.col(f"`{text_col}`")
    others = [f for f in docs.schema.fields if f.name not in (text_col, "n_lines", "n_dropped")]
    schema = T.StructType([*others, T.StructField(text_col, T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = schema.fieldNames()
    rest = K.positional(others)

    if total * SHARD_BYTES + 4096 * number <= broadcast_bytes:
        blobs = spark.sparkContext.broadcast({r.shard: bytes(r.blob) for r in shards.select("shard", "blob").collect()})

        def probe(batches):
            index = {k: Shard.from_bytes(raw) for k, raw in blobs.value.items()}
            for batch in batches:
                for lo, hi, data, offsets in K.blocks(batch.column(0)):
                    starts, ends, first, full, h1, h2 = _keys(data, offsets)
                    drop = np.zeros(len(starts), bool)
                    shard = np.where(full, h1.view(np.int64) % number, -1)
                    for k in np.unique(shard[full]).tolist():
                        if k in index:
                            at = np.flatnonzero(shard == k)
                            drop[at] = index[k].lookup(h1[at] ^ K.mix(h2[at]), h2[at]) >= min_docs
                    yield _cut(batch, lo, hi, data, offsets, starts, ends, first, drop, names)

        return docs.select(text.alias("riskloom text"), *rest).mapInArrow(probe, schema)

    digests = [F.xxhash64(F.coalesce(text, F.lit(""))), F.xxhash64(F.lit("riskloom"), F.coalesce(text, F.lit("")))]
    hits = _found_by_shard(docs.select(text.alias("text"), digests[0].alias("d1"), digests[1].alias("d2")), shards, number, min_docs)
    hits = K.stored(hits, "hits")  # the join below is then between plain shuffles: a text with very many copies can be split

    def cut(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            for lo, hi, data, offsets in K.blocks(batch.column(0)):
                starts, ends, first = K.line_bounds(data, offsets)
                drop = np.zeros(len(starts), bool)
                own = lists.slice(lo, hi - lo)
                sizes = np.nan_to_num(pc.list_value_length(own).to_numpy(zero_copy_only=False)).astype(np.int64)
                drop[own.flatten().to_numpy() + np.repeat(first[:-1], sizes)] = True
                yield _cut(batch, lo, hi, data, offsets, starts, ends, first, drop, names)

    left = docs.select(text.alias("riskloom text"), *rest, digests[0].alias("d1"), digests[1].alias("d2"))
    joined = left.join(hits, ["d1", "d2"], "left")
    return joined.select("`riskloom text`", *(f"`riskloom {i}`" for i in range(len(others))), "drop").mapInArrow(cut, schema)


def query(spark, sf_dir):
    """Digests of all texts without the lines of ten documents or more; odd texts as in drop_common_lines()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = drop_common_lines(docs, min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
with lines as (
 select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
 from documents),
keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from lines),
common as (select k from keyed where length(k) >= 1 group by k having count(distinct doc_id) >= 10)
select doc_id, count(*)::bigint as n_lines, (count(*) filter (where c.k is not null))::bigint as n_dropped,
 sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where c.k is null), '')) as kept_sha256
from keyed left join common c using (k) group by doc_id"""
