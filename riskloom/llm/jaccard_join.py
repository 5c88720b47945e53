"""N-gram Jaccard join: exact similarity join of shingle sets with prefix filtering and prefix trees.

1. One pass hashes each document's distinct word shingles.  It writes a 128-bit digest of each set, and a sketch of shingle
   frequencies (a fixed number of counters, summed over all documents); rarer shingles come first in the global order.
2. Two sets with Jaccard similarity of num/den or more share m shingles among the first ``n - ceil(n * num / den) + m`` of
   each in any global order.  These prefix shingles are sorted over all tasks in ranges of (shingle, set), so that a frequent
   shingle takes several tasks; those of one set only are dropped.
3. The sets of a prefix shingle join the star of its most central set.  A set with fewer than m shared shingles is out, and
   each set leaves its weakest stars as long as they hold fewer than m / 2 of them together: any two sets that may be
   similar still have a star in common, and sets that share a few words by chance have none.
   A star is cut into units of bounded size, each with the star's centre; a unit is joined with itself.
4. The links found give components.  Where a large star still has several, the sets outside its largest component are held
   against all sets of the star, in units again: no link that could change a component is lost, no pair of sets is ever a
   row, and sets already connected are not compared.
5. In a unit the globally ordered sets form a prefix tree, whose nodes are met by another set all at once.  Sets with equal
   beginnings share their partial overlap.
Sets are kept as 64-bit keys (8 bits of frequency class, 56 of hash); equal sets are one node.  A node's name is the first
half of its digest; the few sets whose first halves agree by chance get names of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernel as K
from .components import components

SKETCH_BITS = 22
SKETCH_BLOCK = 1 << 14
#: Sets in one prefix tree, about, and shingles in one unit, about.
TREE_SETS, UNIT_SHINGLES = 128, 1 << 20
#: Times that, in the units of what is left: each outsider is copied once for so many sets of its star, and they for so many outsiders.
REST = 8
#: Prefix shingles that similar sets must share: one, and one more for each STEP shingles, up to MOST_SHARED.
MOST_SHARED, STEP = 8, 24
#: Sets that a task remembers, so as to give each once.
SEEN = 200_000
LOW56 = np.uint64((1 << 56) - 1)


def _sets(data, offsets, k: int):
    """For each document its sorted distinct shingle hashes (56 bits)."""
    starts, ends = K.word_bounds(data, offsets)
    first = K.documents_of(starts, offsets)
    (words,) = K.span_hashes(data, starts, ends, (31,), lower=True)
    grams = K.window_hashes(words, k, 32) & LOW56
    short = [None, *(K.window_hashes(words, n, 40 + n) & LOW56 for n in range(1, k))]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        n = b - a
        yield np.unique(grams[a : b - k + 1]) if n >= k else short[n][a : a + 1] if n else grams[:0]


def _digest(s: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """Two halves of a set's digest, `bits` of the first."""
    sums = np.array([K.mix(s).sum(dtype=np.uint64), K.mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)]) + np.uint64(len(s))
    one, two = K.mix(sums)
    return int((one >> np.uint64(64 - bits)).view(np.int64)), int(two.view(np.int64))


class Names:
    """Node names: the first half of the digest, but for halves that several sets have."""

    def __init__(self, halves: list[tuple[int, int]], bits: int):
        """halves: the digests whose first half is not theirs alone."""
        self.bits, self.own = bits, {}
        for one, two in sorted(halves):
            self.own[one, two] = int(K.mix(K.mix(np.array([two], np.int64).view(np.uint64)) + np.uint64(one & (2**64 - 1)))[0].view(np.int64))

    def of(self, s: np.ndarray) -> int:
        pair = _digest(s, self.bits)
        return self.own.get(pair, pair[0])

    def column(self) -> Column:
        """The name from columns d1 and d2."""
        out = F.col("d1")
        for (one, two), name in self.own.items():
            out = F.when((F.col("d1") == one) & (F.col("d2") == two), F.lit(name)).otherwise(out)
        return out


def _class(counts: np.ndarray) -> np.ndarray:
    """Frequency classes 0..255, finer for rare counters."""
    return np.minimum(255, np.round(8 * np.log2(1 + counts.astype(np.float64)))).astype(np.uint8)


def _scan(docs: DataFrame, k: int, bits: int) -> DataFrame:
    """kind 0: (id, d1, d2, n) of each document; kind 1: (block number, counters) of the sketch."""
    names = ["kind", "id", "d1", "d2", "n", "counters"]

    def scan(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.uint16)
        for batch in batches:
            for lo, hi, data, offsets in K.blocks(batch.column(1)):
                sets = list(_sets(data, offsets, k))
                every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                at, n = np.unique((every & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64), return_counts=True)
                sketch[at] = np.minimum(65535, sketch[at].astype(np.int64) + n)
                digests = [_digest(s, bits) for s in sets]
                size = pa.array([len(s) for s in sets], pa.int64())
                halves = [pa.array([d[i] for d in digests], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays([pa.array(np.zeros(hi - lo, np.int32)), batch.column(0).slice(lo, hi - lo), *halves, size, pa.nulls(hi - lo, pa.binary())], names)
        parts = sketch.reshape(-1, SKETCH_BLOCK)
        used = np.flatnonzero(parts.any(1))
        # low bytes then high bytes: the high ones are nearly all zero and compress away
        blobs = [np.concatenate([(p & 255).astype(np.uint8), (p >> 8).astype(np.uint8)]).tobytes() for p in parts[used]]
        none = pa.nulls(len(used), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(used), np.int32)), pa.array(used), none, none, none, pa.array(blobs, pa.binary())], names)

    return docs.mapInArrow(scan, "kind int, id long, d1 long, d2 long, n long, counters binary")


def _order(parts: DataFrame) -> np.ndarray:
    """Frequency class of each counter, from the summed sketch (2**SKETCH_BITS bytes, whatever the input)."""

    def add(key, batches):
        total = np.zeros(SKETCH_BLOCK, np.int64)
        for batch in batches:
            for blob in batch.column(1).to_pylist():
                raw = np.frombuffer(blob, np.uint8).astype(np.int64)
                total += raw[:SKETCH_BLOCK] + 256 * raw[SKETCH_BLOCK:]
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([_class(total).tobytes()], pa.binary())], ["id", "classes"])

    out = np.zeros(1 << SKETCH_BITS, np.uint8)

    def add_table(key, table):
        return pa.Table.from_batches(list(add(key, table.to_batches())))

    for row in parts.select("id", "counters").groupBy("id").applyInArrow(add_table, "id long, classes binary").collect():
        out[row.id * SKETCH_BLOCK : (row.id + 1) * SKETCH_BLOCK] = np.frombuffer(row.classes, np.uint8)
    return out


def _keys(s: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The set in global order."""
    return np.sort(classes[(s & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | s)


def _prefixes(docs: DataFrame, k: int, num: int, den: int, classes, names) -> DataFrame:
    """(token, digest, n) for each prefix shingle of each set; a set about once in a task."""

    def cut(batches):
        seen: set = set()
        for batch in batches:
            for _, _, data, offsets in K.blocks(batch.column(1)):
                token, digest, size, many = [], [], [], []
                for s in _sets(data, offsets, k):
                    n = len(s)
                    if n and (d := names.value.of(s)) not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(d)
                        p = n - -(-n * num // den) + 1 + min(MOST_SHARED - 1, n // STEP)
                        token.append(_keys(s, classes.value)[:p])
                        digest.append(d)
                        size.append(n)
                        many.append(len(token[-1]))
                if token:
                    yield pa.RecordBatch.from_arrays([pa.array(K.signed(np.concatenate(token))), pa.array(np.repeat(np.array(digest, np.int64), many)), pa.array(np.repeat(np.array(size, np.int32), many))], ["token", "digest", "n"])

    return docs.mapInArrow(cut, "token long, digest long, n int")


def _shared(prefixes: DataFrame) -> DataFrame:
    """(token, digest, n): the prefix shingles that two or more different sets have.

    Each range of (token, digest) is gone through in order.  The first and the last token of a range may go on in its neighbours
    and are kept, and a set may be found twice where ranges meet: that adds candidates, and loses none.
    """

    def keep(batches):
        left, first = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = [batch.column(i).to_numpy() for i in range(3)]
            first = x[0][0] if first is None else first
            if left is not None:
                x = [np.concatenate([a, b]) for a, b in zip(left[0], x, strict=True)]
            out, left = live(x, left[1] if left is not None else False, first)
            if len(out[0]):
                yield rows(out)
        if left is not None:
            yield rows(left[0])

    def live(x, shared_before, first):
        """Rows to emit; and the last row, held back, with whether its token has been found shared."""
        token, digest, _ = x
        new = np.append(True, (token[1:] != token[:-1]) | (digest[1:] != digest[:-1]))
        x = [a[new] for a in x]
        token = x[0]
        same = token[1:] == token[:-1]
        use = np.append(False, same) | np.append(same, False) | (token == first)
        use[0] |= shared_before
        return [a[:-1][use[:-1]] for a in x], ([a[-1:] for a in x], bool(use[-1]))

    def rows(x):
        return pa.RecordBatch.from_arrays([pa.array(a) for a in x], ["token", "digest", "n"])

    return prefixes.repartitionByRange("token", "digest").sortWithinPartitions("token", "digest").mapInArrow(keep, "token long, digest long, n int")


class PrefixTree:
    """Of globally ordered sets.  A node is a run of keys; its sets all begin with the keys from the root to it.

    Nodes are numbered so that those below a node follow it, up to its `after`.  A probe finds its keys in all nodes at once,
    and adds each node's to the nodes below: a number of array operations that does not grow with the nodes.
    """

    def __init__(self, sets: list[np.ndarray]):
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.node = np.zeros(len(sets), np.int64)  # in which each set ends
        self.after: list[int] = []
        runs: list[np.ndarray] = []
        self._add(order, 0, runs)
        keys, many = np.concatenate(runs), [len(r) for r in runs]
        by_key = np.argsort(keys, kind="stable")
        self.nodes = np.repeat(np.arange(len(runs)), many)[by_key]
        self.keys, self.number = np.unique(keys, return_inverse=True)  # and each node's keys by their numbers
        self.first = np.append(np.searchsorted(keys[by_key], self.keys), len(keys))
        self.begins = np.concatenate([[0], np.cumsum(many)]).astype(np.int64)

    def _add(self, members: list[int], start: int, runs: list[np.ndarray]) -> None:
        here = len(runs)
        first, last = self.sets[members[0]], self.sets[members[-1]]
        n = min(len(first), len(last))
        differ = np.flatnonzero(first[start:n] != last[start:n])
        end = start + int(differ[0]) if len(differ) else n
        runs.append(first[start:end])
        self.after.append(0)
        rest = []
        for m in members:
            if len(self.sets[m]) == end:
                self.node[m] = here
            else:
                rest.append(m)
        while rest:
            key = self.sets[rest[0]][end]
            cut = next((i for i, m in enumerate(rest) if self.sets[m][end] != key), len(rest))
            self._add(rest[:cut], end, runs)
            rest = rest[cut:]
        self.after[here] = len(runs)

    def similar(self, probe: np.ndarray, num: int, den: int) -> list[int]:
        """Members whose Jaccard similarity with the probe is num/den or more."""
        if not len(self.keys) or not len(probe):
            return []
        at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
        at = at[self.keys[at] == probe]
        many = self.first[at + 1] - self.first[at]
        if 16 * many.sum() < len(self.nodes):
            found, _ = K.span_index(self.first[at], many)
            hits = np.bincount(self.nodes[found], minlength=len(self.after) + 1)
        else:  # many keys in many nodes: all keys are gone through
            has = np.zeros(len(self.keys), bool)
            has[at] = True
            upto = np.append(0, np.cumsum(has[self.number]))
            hits = np.append(np.diff(upto[self.begins]), 0)
        # what a node has counts from it to the last node below it
        overlap = np.cumsum(hits - np.bincount(self.after, weights=hits[:-1], minlength=len(hits)).astype(np.int64))[self.node]
        return np.flatnonzero((num + den) * overlap >= num * (len(probe) + self.sizes)).tolist()


class _Union(dict):
    """Disjoint sets of labels."""

    def find(self, x):
        while (up := self.get(x, x)) != x:
            x = up
        return x

    def join(self, x, y) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self[max(x, y)] = min(x, y)
        return x != y


def _keyed(docs: DataFrame, owners: DataFrame, k: int, classes, names) -> DataFrame:
    """(b, keys): the globally ordered set of each owner, named by its digest.  Other texts with an owner's id are left out."""

    def make(batches):
        seen: set = set()
        for batch in batches:
            want = batch.column(1).to_pylist()
            for lo, _, data, offsets in K.blocks(batch.column(0)):
                node, keys = [], []
                for i, s in enumerate(_sets(data, offsets, k)):
                    if (d := want[lo + i]) not in seen and names.value.of(s) == d:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(d)
                        node.append(d)
                        keys.append(_keys(s, classes.value))
                if node:
                    yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), K.binaries(keys)], ["b", "keys"])

    # one plan at every size: a small table of owners would otherwise be broadcast, a large one not
    return docs.join(owners.hint("merge"), "id").select("text", "digest").mapInArrow(make, "b long, keys binary")


def _unit_sets(table) -> dict:
    """name -> globally ordered set."""
    return {b: np.frombuffer(raw, np.uint64) for b, raw in zip(table["b"].to_pylist(), table["keys"].to_pylist(), strict=True)}


def _links(found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})


def _units(count: Column, shingles: Column, sets: int) -> Column:
    return F.greatest(F.ceil(count / sets), F.ceil(shingles / UNIT_SHINGLES)).cast("int")


def _join_units(stars: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): links that connect the similar sets of each unit (star, chunk)."""

    def search(key, table):
        sets, groups, found = _unit_sets(table), _Union(), []
        names = list(sets)
        tree = PrefixTree(list(sets.values())) if len(names) > 1 else None
        left = len(names)
        centre = key[0].as_py()
        for x in sorted(names, key=lambda n: n != centre) if tree else ():
            for m in tree.similar(sets[x], num, den):
                if groups.join(x, names[m]):
                    found.append((x, names[m]))
                    left -= 1
            if left == 1:
                break
        return _links(found)

    centres = stars.filter("chunks > 1").select("a", "chunks").distinct().select("a", F.col("a").alias("b"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    units = stars.filter("chunks = 1 or a <> b").select("a", "b", F.pmod(F.xxhash64("b"), "chunks").cast("int").alias("chunk")).unionByName(centres)
    return units.join(sets.hint("merge"), "b").select("a", "chunk", "b", "keys").groupBy("a", "chunk").applyInArrow(search, "a long, b long")


def _join_rest(stars: DataFrame, parts: DataFrame, sets: DataFrame, num: int, den: int, folder: str) -> DataFrame:
    """(a, b): links between sets of a large star that are in different components so far."""
    large = stars.filter("chunks > 1").join(parts.withColumnRenamed("node", "b"), "b", "left").withColumn("component", F.coalesce("component", "b"))
    large = K.stored(large, "large", folder)
    sizes = large.groupBy("a", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("shingles"))
    star = sizes.groupBy("a").agg(F.max_by("component", F.struct("n", "component")).alias("main"), (F.sum("n") - F.max("n")).alias("rest"), (F.sum("shingles") - F.max_by("shingles", F.struct("n", "component"))).alias("shingles")).filter("rest > 0")
    star = K.stored(star.select("a", "main", _units(F.col("rest"), F.col("shingles"), REST * TREE_SETS).alias("blocks")), "star", folder)
    large = large.join(star, "a").withColumn("chunks", F.ceil(F.col("chunks") / REST).cast("int")).withColumn("outside", F.col("component") != F.col("main"))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("b", F.lit(1)), n).cast("int")
    trees = large.filter("outside").select("a", "b", "component", F.lit(True).alias("tree"), place("blocks").alias("block"), spread("chunks").alias("chunk"))
    probes = large.select("a", "b", "component", F.lit(False).alias("tree"), spread("blocks").alias("block"), place("chunks").alias("chunk"))

    def search(key, table):
        found, groups = [], _Union()
        tree = np.array(table["tree"].to_pylist(), bool)
        name = np.array(table["b"].to_pylist(), dtype=object)
        label = dict(zip(name.tolist(), table["component"].to_pylist(), strict=True))
        sets = _unit_sets(table)
        held = list(dict.fromkeys(name[tree].tolist()))
        if not held:
            return _links(found)
        index = PrefixTree([sets[b] for b in held])
        for x in dict.fromkeys(name[~tree].tolist()):
            if any(groups.find(label[x]) != groups.find(label[b]) for b in held):
                for m in index.similar(sets[x], num, den):
                    if groups.join(label[x], label[held[m]]):
                        found.append((x, held[m]))
        return _links(found)

    units = trees.unionByName(probes).join(sets.hint("merge"), "b")
    return units.select("a", "block", "chunk", "b", "component", "tree", "keys").groupBy("a", "block", "chunk").applyInArrow(search, "a long, b long")


def jaccard_components(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", name_bits: int = 64) -> DataFrame:
    """(id, n_shingles, component_id) for every row of `docs` with an id that is not null.

    A document's set: distinct k-word shingles of its words (runs outside ``[\\x20\\x09-\\x0D]``, A-Z lower-cased); with fewer
    words, the whole sequence as one; a null or empty text has an empty set and is linked with nothing.  Documents link
    when intersection / union >= num / den.  component_id is the least id reachable by links.  Equal texts are linked
    (unless empty), whatever their number.  Rows that share an id are one document with several sets.  Rows with a null id are
    left out.  An empty table gives an empty table.  name_bits: bits of the digests' first halves (tests take few).

    Joins on a key that very many rows share are between tables that were written, so that adaptive execution splits them.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).filter("id is not null")
    folder = K.shared_folder(spark)
    scanned = K.stored(_scan(own, k, name_bits), "scan", folder)
    halves = scanned.filter("kind = 0 and n > 0").groupBy("d1").agg(F.min("d2").alias("low"), F.max("d2").alias("high")).filter("low <> high").select("d1")
    # by chance alone: about ten of 2e10 sets
    shared_halves = [r.d1 for r in halves.collect()]
    clashes = scanned.filter(F.col("d1").isin(shared_halves) & F.expr("kind = 0 and n > 0")).select("d1", "d2").distinct().collect() if shared_halves else []
    name = Names([(r.d1, r.d2) for r in clashes], name_bits)
    sizes = scanned.filter("kind = 0").select("id", name.column().alias("digest"), "n")
    names, classes = spark.sparkContext.broadcast(name), spark.sparkContext.broadcast(_order(scanned.filter("kind = 1")))
    # written before the ranges are drawn, which reads them twice
    prefixes = K.stored(_prefixes(own, k, num, den, classes, names), "prefixes", folder)
    shared = K.stored(_shared(prefixes), "shared", folder)
    K.remove(spark, f"{folder}/prefixes")
    # a set is the more central the more sets share its prefix shingles
    weight = K.stored(shared.groupBy("token").agg(F.count(F.lit(1)).alias("g")), "weight", folder)
    central = K.stored(shared.join(weight, "token").groupBy("digest").agg(F.sum("g").alias("score")), "central", folder)
    centre = K.stored(shared.join(central, "digest").groupBy("token").agg(F.max_by("digest", F.struct("score", "digest")).alias("a")), "centre", folder)
    stars = shared.join(centre, "token").groupBy("a", F.col("digest").alias("b")).agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("c"))
    # the least similar set has num/den of the shingles; a set's stars are at most as many as its prefix shingles
    least = 1 + F.least(F.lit(MOST_SHARED - 1), F.floor(F.ceil(F.col("n") * num / den) / STEP))
    by = Window.partitionBy("b")
    stars = stars.withColumn("all", F.sum("c").over(by)).withColumn("upto", F.sum("c").over(by.orderBy("c", "a"))).withColumn("m", least)
    stars = stars.filter((F.col("all") >= F.col("m")) & (2 * F.col("upto") > F.col("m") - 1)).select("a", "b", "n")
    stars = K.stored(stars, "stars", folder)
    size = stars.groupBy("a").agg(_units(F.count(F.lit(1)), F.sum("n"), TREE_SETS).alias("chunks"), F.count(F.lit(1)).alias("sets")).filter("sets > 1").drop("sets")
    stars = K.stored(stars.join(K.stored(size, "size", folder), "a"), "sized", folder)
    least_id = sizes.filter("n > 0").groupBy("digest").agg(F.min("id").alias("id"))
    first = K.stored(least_id, "first", folder)
    owners = K.stored(first.join(stars.select(F.col("b").alias("digest")).distinct(), "digest", "left_semi"), "owners", folder)
    sets = K.stored(_keyed(own, owners, k, classes, names), "sets", folder)
    links = K.stored(_join_units(stars, sets, num, den), "links", folder)
    joined = K.stored(components(links, folder, "cc"), "components", folder)
    rest = K.stored(_join_rest(stars, joined, sets, num, den, folder), "rest", folder)
    if not rest.isEmpty():
        joined = K.stored(components(links.unionByName(rest), folder, "ccr"), "components-all", folder)
    for done in ("shared", "weight", "central", "centre", "stars", "size", "sized", "owners", "sets", "links", "large", "star", "rest"):
        K.remove(spark, f"{folder}/{done}")
    # by distinct set first, so that copies are one row
    names = K.stored(first.join(joined.withColumnRenamed("node", "digest"), "digest", "left").select("digest", "id", F.coalesce("component", "digest").alias("component")), "names", folder)
    least = K.stored(names.groupBy("component").agg(F.min("id").alias("component_id")), "least", folder)
    labels = K.stored(names.join(least, "component").select("digest", "component_id"), "labels", folder)
    return sizes.join(labels, "digest", "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def query(spark, sf_dir):
    """Components at 4-word shingles and similarity 0.85; null, empty, repeated and very long texts as in jaccard_components()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs, k=4, num=85, den=100).withColumnRenamed("id", "doc_id")
