"""Substring dedup by suffix automata over shards of the repeated passages.

Only passages that occur more than once can lose words, so they alone become reference shards:

1. Every 13-word window has an anchor: its 5-word run of least hash (for other window lengths, see _anchor).  One pass counts
   anchors (partial sums first).
2. A bitmap of anchors that occur twice or more, of bounded size, goes to all tasks (a set bit may be wrong, which costs
   volume, never results; a clear bit is right).  A second pass cuts each document into spans of consecutive windows with
   the same anchor and sends the spans of set anchors to the anchor's shard, so equal windows always meet in one shard.
3. A shard's task reads its spans anchor by anchor, builds a suffix automaton over the different spans of the anchor, marks
   each state with the least document of its occurrences, and streams the spans through it: at every position with a match
   of 13 words or more, the state of that length names the least document that has the window.
4. Windows of very frequent anchors (over HOT occurrences) go by window instead, least document first within the task and
   then over all, and are joined back: such a group is never in one task.
5. The covered words of maximal spans are removed from the texts, one join on the document's id.

Broadcasting the automata themselves to every document would read the corpus once per shard; sending to each shard just
the spans that can match there gives the same statistics with one read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K

ANCHOR_WORDS = 5
#: Windows that a span has at most: the bits of its mask.
SPAN_WINDOWS = 31
#: Occurrences of an anchor from which its windows go one by one.
HOT = 64
HOT_BITS = 22
#: Largest bitmap of repeated anchors, as a power of two of bits (64 MB).
MOST_BITS = 29
FLUSH_ROWS = 2_000_000


class SuffixAutomaton:
    """Of several word sequences; each state knows its longest length and, once settled, the least owner of its occurrences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def _state(self, length, link, after, owner):
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(owner)
        return len(self.link) - 1

    def add(self, words, owner) -> None:
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for w in words:
            q = nexts[last].get(w)
            if q is not None and length[q] == length[last] + 1:
                last = q
            else:
                if q is None:
                    new, p = self._state(length[last] + 1, 0, {}, None), last
                    while p >= 0 and w not in nexts[p]:
                        nexts[p][w] = new
                        p = link[p]
                else:
                    new, p = None, last
                if p >= 0:
                    q = nexts[p][w]
                    if length[q] != length[p] + 1:
                        copy = self._state(length[p] + 1, link[q], dict(nexts[q]), self.owner[q])
                        while p >= 0 and nexts[p].get(w) == q:
                            nexts[p][w] = copy
                            p = link[p]
                        link[q] = q = copy
                    if new is not None:
                        link[new] = q
                last = q if new is None else new
            if self.owner[last] is None or owner < self.owner[last]:
                self.owner[last] = owner

    def settle(self) -> None:
        """Carry owners from longer to shorter suffixes."""
        owner, link = self.owner, self.link
        for s in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            p = link[s]
            if p > 0 and owner[s] is not None and (owner[p] is None or owner[s] < owner[p]):
                owner[p] = owner[s]

    def least_owners(self, words, n: int) -> list:
        """For each position with a match of n words or more that ends there, the least owner of these n words; else None."""
        out, state, matched = [], 0, 0
        nexts, link, length = self.next, self.link, self.length
        for w in words:
            while state and w not in nexts[state]:
                state = link[state]
                matched = length[state]
            if w in nexts[state]:
                state = nexts[state][w]
                matched += 1
            if matched < n:
                out.append(None)
                continue
            at = state
            while length[link[at]] >= n:
                at = link[at]
            out.append(self.owner[at])
        return out


def _anchor(window: int) -> int:
    """Words of an anchor: ANCHOR_WORDS, or fewer in a shorter window; more in a window of over 35 words, so that masks suffice."""
    return max(min(ANCHOR_WORDS, window), window - SPAN_WINDOWS + 1)


def _spans(data, offsets, window: int):
    """Words, each document's first word, and spans of windows with one anchor: first word, windows, anchor hash, document."""
    starts, ends = K.word_bounds(data, offsets)
    first = K.documents_of(starts, offsets)
    empty = np.zeros(0, np.int64)
    if len(starts) < window:
        return starts, ends, first, empty, empty, np.zeros(0, np.uint64), empty, np.zeros(0, np.uint64)
    (words,) = K.span_hashes(data, starts, ends)
    grams = K.window_hashes(words, _anchor(window))
    wide = window - _anchor(window) + 1
    least = np.lib.stride_tricks.sliding_window_view(grams, wide).argmin(1) + np.arange(len(grams) - wide + 1)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ok = doc[: len(least)] == doc[window - 1 :]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1 : len(least)] != doc[: len(least) - 1])
    begin = np.flatnonzero(ok & (new | np.append(True, ~ok[:-1])))
    group = np.cumsum(ok & (new | np.append(True, ~ok[:-1])))[ok] - 1
    count = np.bincount(group, minlength=len(begin)).astype(np.int64)
    return starts, ends, first, begin, count, grams[least[begin]], doc[begin], words


def _anchor_counts(docs: DataFrame, window: int) -> DataFrame:
    def count(batches):
        held, rows = [], 0
        for batch in batches:
            for _, _, data, offsets in K.blocks(batch.column(0)):
                anchors = _spans(data, offsets, window)[5]
                held.append(anchors)
                rows += len(anchors)
                if rows > FLUSH_ROWS:
                    yield flush(held)
                    held, rows = [], 0
        if rows:
            yield flush(held)

    def flush(held):
        value, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(K.signed(value)), pa.array(n.astype(np.int32))], ["anchor", "n"])

    return docs.select("text").mapInArrow(count, "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n")).filter(F.col("n") >= 2)


def _bitmaps(repeated: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Bits of the index, and the bitmaps of repeated and of hot anchors; built in slices, each in a task of its own."""
    total = repeated.count()
    bits = min(MOST_BITS, max(HOT_BITS, (16 * max(total, 1)).bit_length()))
    slices = min(12, max(6, (total >> 20).bit_length()))

    def build(key, table):
        anchors, n = table["anchor"].to_numpy().view(np.uint64), table["n"].to_numpy()
        out = []
        for b, chosen in ((bits, anchors), (HOT_BITS, anchors[n > HOT])):
            flags = np.zeros(1 << (b - slices), bool)
            flags[(chosen >> np.uint64(64 - b)).astype(np.int64) & ((1 << (b - slices)) - 1)] = True
            out.append(np.packbits(flags, bitorder="little").tobytes())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([out[0]], pa.binary()), "hot": pa.array([out[1]], pa.binary())})

    made = repeated.withColumn("slice", F.shiftrightunsigned("anchor", 64 - slices)).groupBy("slice").applyInArrow(build, "slice long, bits binary, hot binary")
    every, hot = np.zeros((1 << bits) // 8, np.uint8), np.zeros((1 << HOT_BITS) // 8, np.uint8)
    for row in made.collect():
        for whole, part in ((every, row.bits), (hot, row.hot)):
            size = len(whole) >> slices
            whole[row.slice * size : (row.slice + 1) * size] = np.frombuffer(part, np.uint8)
    return bits, every, hot


def _test(bitmap: np.ndarray, bits: int, value: np.ndarray) -> np.ndarray:
    at = (value >> np.uint64(64 - bits)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _candidate_spans(docs: DataFrame, window: int, bits: int, maps) -> DataFrame:
    """(anchor, doc, pos, text): the spans of repeated anchors that are not hot; pos counts words."""

    def cut(batches):
        every, hot = maps.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, data, offsets in K.blocks(batch.column(1)):
                starts, ends, first, begin, count, anchor, doc, _ = _spans(data, offsets, window)
                use = np.flatnonzero(_test(every, bits, anchor) & ~_test(hot, HOT_BITS, anchor))
                begin, count, anchor, doc = begin[use], count[use], anchor[use], doc[use]
                s, e = starts[begin], ends[begin + count + window - 2] if len(begin) else begin
                index, _ = K.span_index(s, e - s)
                out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(e - s)]).astype(np.int64)), pa.py_buffer(data[index])])
                yield pa.RecordBatch.from_arrays([pa.array(K.signed(anchor)), pa.array(ids[lo + doc]), pa.array((begin - first[doc]).astype(np.int32)), out.cast(pa.binary())], ["anchor", "doc", "pos", "span"])

    return docs.mapInArrow(cut, "anchor long, doc long, pos int, span binary")


def _match_shards(spans: DataFrame, window: int) -> DataFrame:
    """(doc, pos, mask): bit i of mask is set if the window at word pos + i also starts in a document of smaller id."""

    def match(batches):
        left = None  # the last anchor's rows may go on in the next batch
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if left is not None:
                table = pa.concat_tables([left, table])
            anchor = table["anchor"].to_numpy()
            cuts = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
            if not len(cuts):
                left = table.combine_chunks()
                continue
            yield groups(table.slice(0, cuts[-1]), np.concatenate([[0], cuts]))
            left = table.slice(cuts[-1]).combine_chunks()
        if left is not None and left.num_rows:
            yield groups(left, np.array([0, left.num_rows]))

    def groups(table, cuts):
        docs, pos, spans = table["doc"].to_numpy(), table["pos"].to_numpy(), table["span"].to_pylist()
        out_doc, out_pos, out_mask = [], [], []
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if b - a < 2 or docs[a] == docs[b - 1] and (docs[a:b] == docs[a]).all():
                continue
            least: dict[tuple, int] = {}
            words = [tuple(s.split()) for s in spans[a:b]]
            for w, d in zip(words, docs[a:b].tolist(), strict=True):
                if d < least.get(w, d + 1):
                    least[w] = d
            automaton = SuffixAutomaton()
            for w, d in least.items():
                automaton.add(w, d)
            automaton.settle()
            owners = {w: automaton.least_owners(w, window)[window - 1 :] for w in least}
            for w, d, p in zip(words, docs[a:b].tolist(), pos[a:b].tolist(), strict=True):
                mask = 0
                for i, o in enumerate(owners[w]):
                    if o < d:
                        mask |= 1 << i
                if mask:
                    out_doc.append(d)
                    out_pos.append(p)
                    out_mask.append(mask)
        return pa.RecordBatch.from_arrays([pa.array(out_doc, pa.int64()), pa.array(out_pos, pa.int32()), pa.array(out_mask, pa.int32())], ["doc", "pos", "mask"])

    return spans.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(match, "doc long, pos int, mask int")


def _hot_windows(docs: DataFrame, window: int, maps, pre_aggregate: bool) -> DataFrame:
    """Windows of hot anchors: (h1, h2, doc) with the least document in each block of rows, or (h1, h2, doc, pos) for all."""

    def cut(batches):
        hot = maps.value[1]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, data, offsets in K.blocks(batch.column(1)):
                starts, ends, first, begin, count, anchor, doc, words = _spans(data, offsets, window)
                use = np.flatnonzero(_test(hot, HOT_BITS, anchor))
                if not len(use):
                    continue
                at, _ = K.span_index(begin[use], count[use])
                doc = np.repeat(doc[use], count[use])
                h1, h2 = (K.window_hashes(words, window, seed)[at] for seed in (21, 22))
                own = ids[lo + doc]
                if pre_aggregate:
                    order = np.lexsort((own, h2, h1))
                    h1, h2, own = h1[order], h2[order], own[order]
                    new = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
                    yield pa.RecordBatch.from_arrays([pa.array(K.signed(h1[new])), pa.array(K.signed(h2[new])), pa.array(own[new])], ["h1", "h2", "doc"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(K.signed(h1)), pa.array(K.signed(h2)), pa.array(own), pa.array((at - first[doc]).astype(np.int32))], ["h1", "h2", "doc", "pos"])

    return docs.mapInArrow(cut, "h1 long, h2 long, doc long" + ("" if pre_aggregate else ", pos int"))


def repeated_words(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, found): per document that has any, (pos, mask) of windows that also start in a document of smaller id."""
    if window < 1:
        raise ValueError("a window has one word at least")
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text")).filter("doc is not null")
    folder = K.shared_folder(spark)
    repeated = K.stored(_anchor_counts(own, window), "anchors", folder)
    bits, every, hot = _bitmaps(repeated)
    any_hot = bool(hot.any())
    K.remove(spark, f"{folder}/anchors")
    maps = spark.sparkContext.broadcast((every, hot))
    found = _match_shards(_candidate_spans(own, window, bits, maps), window)
    if any_hot:
        least = K.stored(_hot_windows(own, window, maps, True).groupBy("h1", "h2").agg(F.min("doc").alias("least")), "least", folder)
        hits = _hot_windows(own, window, maps, False).join(least, ["h1", "h2"]).filter("doc > least")
        # both sides and the result are written: between plain shuffles, adaptive execution splits the join of a window that
        # very many have
        hits = K.stored(hits.select("doc", "pos", F.lit(1).alias("mask")), "hits", folder)
        found = found.unionByName(hits)
    # equal rows of one id find the same; written, for the same reason
    found = K.stored(found.groupBy("doc").agg(F.collect_set(F.struct("pos", "mask")).alias("found")), "found", folder)
    for done in ("least", "hits") if any_hot else ():
        K.remove(spark, f"{folder}/{done}")
    return found


def remove_repeats(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs` with the repeated words taken out of the text, and n_words and n_removed (input columns of
    these names are replaced).

    Words are runs outside ``[\\x20\\x09-\\x0D]``.  A word goes if a window of `window` words that covers it also starts in
    a document of smaller id; windows are judged on the input.  What is left is joined by single spaces.  A null or empty
    text gives an empty text.  The id identifies a document: rows that share an id are taken to be equal and do not count
    against each other; rows with a null id are neither searched nor cut.  An empty table gives an empty table.
    """
    found = repeated_words(docs, window, id_col, text_col)
    others = [f for f in docs.schema.fields if f.name not in (text_col, "n_words", "n_removed")]
    schema = T.StructType([*others, T.StructField(text_col, T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    own = docs.select(*K.positional(others), F.col(f"`{text_col}`").alias("riskloom text"), F.col(f"`{id_col}`").cast("long").alias("doc"))
    joined = own.join(found, "doc", "left").select(*own.columns[:-1], F.col("found.pos").alias("riskloom pos"), F.col("found.mask").alias("riskloom mask"))

    def cut(batches):
        for batch in batches:
            n = batch.num_columns
            pos, mask = batch.column(n - 2), batch.column(n - 1)
            for lo, hi, data, offsets in K.blocks(batch.column(n - 3)):
                starts, ends = K.word_bounds(data, offsets)
                first = K.documents_of(starts, offsets)
                p, m = pos.slice(lo, hi - lo), mask.slice(lo, hi - lo)
                sizes = np.nan_to_num(pa.compute.list_value_length(p).to_numpy(zero_copy_only=False)).astype(np.int64)
                at = p.flatten().to_numpy().astype(np.int64) + np.repeat(first[:-1], sizes)
                bits = m.flatten().to_numpy()
                steps = np.zeros(len(starts) + 1, np.int64)
                for i in range(min(window, SPAN_WINDOWS)):
                    begin = at[(bits >> i) & 1 == 1] + i
                    np.add.at(steps, begin, 1)
                    np.add.at(steps, begin + window, -1)
                gone = np.cumsum(steps[:-1]) > 0
                text = K.texts(data, starts, ends, offsets, first, ~gone, 32)
                removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(n - 3)), text, pa.array(np.diff(first)), pa.array(removed)], schema.fieldNames())

    return joined.mapInArrow(cut, schema)


def query(spark, sf_dir):
    """Digests of all texts without repeated 13-word windows; odd texts as in remove_repeats()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (select doc_id, i, array_to_string(ws[i:i + 12], ' ') as k from w, unnest(range(1, greatest(len(ws) - 11, 1))) as t(i)),
owner as (select k, min(doc_id) as least from win group by k),
gone as (select distinct doc_id, i + j as p from win join owner using (k), range(0, 13) as r(j) where least < doc_id),
words as (select doc_id, p, ws[p] as word from w, unnest(range(1, len(ws) + 1)) as t(p)),
kept as (select words.doc_id, count(*)::bigint as n_words, count(gone.p)::bigint as n_removed,
  string_agg(word, ' ' order by words.p) filter (where gone.p is null) as text
 from words left join gone on gone.doc_id = words.doc_id and gone.p = words.p group by words.doc_id)
select w.doc_id, coalesce(n_words, 0) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
from w left join kept using (doc_id)"""
