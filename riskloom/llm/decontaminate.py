"""Benchmark decontamination by template windows.

1. Words lose the marks around them and their case; numbers, names (capitals inside a sentence) and units after numbers
   become typed placeholders; a capitalised word that opens a sentence counts both as itself and as a name.  Every WINDOW
   consecutive tokens of a benchmark item with enough literal words give a window hash, and all give one of the words as
   they are.
2. A bitmap of these hashes, of fixed size, lets tasks keep only the document windows that may match; these are hash-joined
   with the item windows.  An item is looked for by its telling positions only: all but the most frequent ones, as long as
   those cover less than COVERAGE of it together, for a document without a telling position cannot cover enough.  So a phrase
   that many items and many documents share makes no pairs.
3. Each occurrence in a document is judged by the share of the item's tokens that its windows cover, and by its own slots: a
   slot of the item has one value in an occurrence.  An occurrence is a run of windows at one distance from the item's
   positions, alone or with its neighbours up to SHIFT tokens away (words put in or left out).  The document's windows are
   judged together as well (an item in pieces); there one item value must always meet the same document value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .tokens import LITERAL, NUMBER, template, variants

WINDOW = 8
#: Literal tokens that a window needs at least (a shorter item: half its tokens).
LITERALS = 4
BITS = 22
#: Share of an item's tokens that must be covered.
COVERAGE = 0.5
#: Tokens put in or left out between windows of one occurrence, at most.
SHIFT = 8


def _windows(data, offsets, widths):
    """(first token, width, hash, kinds used) of windows of the given widths, and the tokens.

    Every window comes once with its words as they are, whose slots are the numbers, and, with enough literal words, as a
    template.  Windows with words that may be names come once for each way to take them (see tokens.variants).  tokens: start, end,
    first of each document, document, and the kinds of tokens in each way.
    """
    s, e, first, kind, h, opening, plain = template(data, offsets)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    open_words = np.concatenate([[0], np.cumsum(opening)])
    parts, kinds = [], []
    exact = (np.where(kind == NUMBER, kind, LITERAL), plain)
    for v, (own, hashes) in enumerate((*variants(kind, h, opening), exact)):
        kinds.append(own)
        literal = np.concatenate([[0], np.cumsum(own == LITERAL)])
        for w in widths:
            if len(s) < w:
                continue
            at = np.arange(len(s) - w + 1)
            ok = doc[at] == doc[at + w - 1]
            if v < 4:
                ok &= literal[at + w] - literal[at] >= min(LITERALS, (w + 1) // 2)
            if 0 < v < 4:  # one such word: itself or a name; more: the halves too
                ok &= open_words[at + w] - open_words[at] >= (1 if v == 1 else 2)
            if ok.any():
                parts.append((at[ok], np.full(int(ok.sum()), w), K.window_hashes(hashes, w, (60 if v < 4 else 160) + w)[ok], np.full(int(ok.sum()), v)))
    at, width, hashes, way = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return at, width, hashes, way, (s, e, first, doc, kinds)


def _slots(data, at, width, way, tokens):
    """For each window its slot values, in order."""
    s, e, _, _, kinds = tokens
    out = []
    for a, w, v in zip(at.tolist(), width.tolist(), way.tolist(), strict=True):
        out.append([bytes(data[s[i] : e[i]]).decode("utf-8", "replace").lower() for i in range(a, a + w) if kinds[v][i]])
    return pa.array(out, pa.list_(pa.string()))


def _places(at, width, way, tokens):
    """For each window the places of its slots, from the document's first token, in order."""
    _, _, first, doc, kinds = tokens
    return pa.array([[i - int(first[doc[a]]) for i in range(a, a + w) if kinds[v][i]] for a, w, v in zip(at.tolist(), width.tolist(), way.tolist(), strict=True)], pa.list_(pa.int64()))


def _item_windows(items: DataFrame) -> DataFrame:
    """(hash, item, pos, width, tokens, slots, places); an item of fewer than WINDOW tokens is one window."""

    def cut(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, _, data, offsets in K.blocks(batch.column(1)):
                at, width, h, way, tokens = _windows(data, offsets, range(1, WINDOW + 1))
                first, doc = tokens[2], tokens[3]
                size = np.diff(first)[doc[at]] if len(at) else at
                use = width == np.minimum(size, WINDOW)
                at, width, h, way, size = at[use], width[use], h[use], way[use], size[use]
                yield pa.RecordBatch.from_arrays([pa.array(K.signed(h)), ids.take(pa.array(lo + doc[at])), pa.array(at - first[doc[at]]), pa.array(width), pa.array(size), _slots(data, at, width, way, tokens), _places(at, width, way, tokens), pa.array(way)], ["hash", "item", "pos", "width", "tokens", "slots", "places", "way"])

    return items.mapInArrow(cut, "hash long, item long, pos long, width long, tokens long, slots array<string>, places array<long>, way long")


def _bitmap(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """2**BITS bits of the hashes, and the widths in use; partitions' bitmaps are merged one at a time."""

    def mark(batches):
        flags, widths = np.zeros(1 << BITS, bool), set()
        for batch in batches:
            flags[(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - BITS)).astype(np.int64)] = True
            widths |= set(batch.column(1).to_pylist())
        if widths:
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(flags, bitorder="little").tobytes()], pa.binary()), pa.array([sorted(widths)], pa.list_(pa.int64()))], ["bits", "widths"])

    bits, widths = np.zeros((1 << BITS) // 8, np.uint8), set()
    for row in windows.select("hash", "width").mapInArrow(mark, "bits binary, widths array<long>").toLocalIterator():
        bits |= np.frombuffer(row.bits, np.uint8)
        widths |= set(row.widths)
    return bits, sorted(widths)


def _document_windows(docs: DataFrame, maps) -> DataFrame:
    def cut(batches):
        bits, widths = maps.value
        for batch in batches:
            ids = batch.column(0)
            for lo, _, data, offsets in K.blocks(batch.column(1)):
                at, width, h, way, tokens = _windows(data, offsets, widths)
                bit = (h >> np.uint64(64 - BITS)).astype(np.int64)
                use = (bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
                at, width, h, way = at[use], width[use], h[use], way[use]
                if len(at):
                    yield pa.RecordBatch.from_arrays([pa.array(K.signed(h)), ids.take(pa.array(lo + tokens[3][at])), pa.array(at - tokens[2][tokens[3][at]]), pa.array(width), _slots(data, at, width, way, tokens), pa.array(way)], ["hash", "doc", "place", "width", "values", "doc_way"])

    return docs.mapInArrow(cut, "hash long, doc long, place long, width long, values array<string>, doc_way long")


def _telling(used: DataFrame) -> DataFrame:
    """(item, pos): the positions by which each item is looked for; used: (item, pos, width, tokens, f), f documents' windows."""

    def choose(key, table):
        pos, width, f = (table[c].to_numpy() for c in ("pos", "width", "f"))
        places, where = np.unique(pos, return_inverse=True)
        often = np.bincount(where, weights=f)
        wide = np.zeros(len(places), np.int64)
        np.maximum.at(wide, where, width)
        covered, left = np.zeros(int((places + wide).max()), bool), []
        enough = COVERAGE * int(table["tokens"].to_numpy().min())
        order = np.lexsort((places, -often))
        for n, i in enumerate(order.tolist()):
            covered[places[i] : places[i] + wide[i]] = True
            if covered.sum() >= enough:
                left = order[n:]
                break
        return pa.table({"item": pa.array([key[0].as_py()] * len(left), pa.int64()), "pos": pa.array(places[left] if len(left) else [], pa.int64())})

    # an item's windows are bounded by its length
    return used.select("item", "pos", "width", "tokens", "f").groupBy("item").applyInArrow(choose, "item long, pos long")


def _judged(groups: DataFrame, by: str) -> DataFrame:
    """(doc, item, tokens, covered, n_slots, n_changed) of groups of windows that cover enough, with consistent slots.

    by: "place" if a place of the item must have one value, "a" if a changed value of the item must.
    """
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))
    covered = F.aggregate(F.array_sort("at"), start, lambda a, p: F.struct((a["total"] + p["pos"] + p["width"] - F.greatest(p["pos"], a["end"])).alias("total"), (p["pos"] + p["width"]).alias("end")), lambda a: a["total"])
    changed = F.filter("pairs", lambda p: p["a"] != p["b"])
    bound = F.col("pairs") if by == "place" else F.col("changed")
    kept = groups.withColumn("covered", covered).filter(F.col("covered") >= COVERAGE * F.col("tokens"))
    kept = kept.withColumn("changed", changed).filter(F.size(F.array_distinct(F.transform(bound, lambda p: F.struct(p[by], p["b"])))) == F.size(F.array_distinct(F.transform(bound, lambda p: p[by]))))
    return kept.select("doc", "item", "tokens", "covered", F.size(F.array_distinct(F.col("pairs.a"))).cast("long").alias("n_slots"), F.size(F.array_distinct(F.col("changed.a"))).cast("long").alias("n_changed"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id, item, covered, tokens, coverage, n_slots, n_changed) of every document that holds a benchmark item's template.

    covered: tokens of the item in matched windows; n_slots: different slot values of the item in these windows;
    n_changed: those that have another value in the document (0: a plain copy; more: a re-parameterised one); all of the
    occurrence that covers most (then the one with fewest changes).  A pair is returned if, in any occurrence, covered >=
    COVERAGE * tokens and no slot of the item meets two different values; or if that holds for the document's windows together
    and no value of the item meets two different values other than itself.  Null or empty texts and items, and rows with
    null ids, match nothing; equal documents and equal items each give their own rows, and rows that share an id are one
    document, or one item; empty tables give no rows.
    """
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.col(f"`{text_col}`").alias("text")).filter("doc is not null and text is not null")
    items = benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item"), F.col(f"`{item_text_col}`").alias("text")).filter("item is not null and text is not null")
    spark = docs.sparkSession
    folder = K.shared_folder(spark)
    windows = K.stored(_item_windows(items), "items", folder)
    maps = spark.sparkContext.broadcast(_bitmap(windows))
    # written tables on both sides of every join: adaptive execution can then split a window, item or document that very many rows have
    held = K.stored(_document_windows(own, maps), "windows", folder)
    often = K.stored(held.groupBy("hash", "width").agg(F.count(F.lit(1)).alias("f")), "often", folder)
    used = K.stored(windows.join(often, ["hash", "width"]), "used", folder)
    telling = K.stored(used.join(_telling(used), ["item", "pos"], "left_semi").select("hash", "width", "item").distinct(), "telling", folder)
    found = K.stored(held.select("hash", "width", "doc").join(telling, ["hash", "width"]).select("doc", "item").distinct(), "found", folder)
    own_windows = K.stored(found.join(used.drop("f"), "item"), "own", folder)
    pairs = F.transform(F.arrays_zip("places", "slots", "values"), lambda x: F.struct(x["places"].alias("place"), x["slots"].alias("a"), x["values"].alias("b")))
    hits = held.join(own_windows, ["doc", "hash", "width"]).select("doc", "item", "pos", "width", "tokens", (F.col("place") - F.col("pos")).alias("shift"), pairs.alias("pairs"), ((F.col("way") == 0) & (F.col("doc_way") == 0)).alias("plain"))
    hits = K.stored(hits, "hits", folder)  # read several times below, and small beside the texts
    for done in ("items", "windows", "often", "used", "telling", "found", "own"):
        K.remove(spark, f"{folder}/{done}")
    spot = F.struct("pos", "width")
    # a distance's lists are bounded by the item's length, and those of neighbours by SHIFT times that
    runs = hits.groupBy("doc", "item", "shift").agg(F.min("tokens").alias("tokens"), F.collect_set(spot).alias("at"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"))
    near = Window.partitionBy("doc", "item").orderBy("shift").rangeBetween(-SHIFT, SHIFT)
    joint = runs.select("doc", "item", "tokens", F.array_distinct(F.flatten(F.collect_list("at").over(near))).alias("at"), F.array_distinct(F.flatten(F.collect_list("pairs").over(near))).alias("pairs"))
    # one row for each (document, item, position) before the pairs are gathered: lists are bounded by the item's length
    alike = F.struct(-F.size(F.filter("pairs", lambda p: p["a"] != p["b"])), F.size("pairs"), F.array_join(F.col("pairs.b"), " "))

    def together(hits):
        best = hits.groupBy("doc", "item", "pos", "width", "tokens").agg(F.max_by("pairs", alike).alias("pairs"))
        return best.groupBy("doc", "item").agg(F.min("tokens").alias("tokens"), F.collect_list(spot).alias("at"), F.array_distinct(F.flatten(F.collect_list(F.transform("pairs", lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b")))))).alias("pairs"))

    # the plain templates also by themselves: other windows' values must not speak against a pair that these show
    every = _judged(runs, "place").unionByName(_judged(joint, "place"))
    for some in (hits, hits.filter("plain")):
        every = every.unionByName(_judged(together(some), "a"))
    found = every.groupBy("doc", "item").agg(F.max(F.struct("covered", (-F.col("n_changed")).alias("kept"), "n_slots", "tokens")).alias("m"))
    return found.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), "m.covered", "m.tokens", (F.col("m.covered") / F.col("m.tokens")).alias("coverage"), "m.n_slots", (-F.col("m.kept")).alias("n_changed"))


def query(spark, sf_dir):
    """All pairs of a document and a benchmark item that it holds; odd texts and ids as in contaminated()."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
