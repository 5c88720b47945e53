"""LM scoring by masked pseudo-likelihood with a bidirectional window network in numpy.

Tokens are words without the marks around them, in small letters.  The classes grow with the corpus: about the square root
of the number of different words (CLASSES at least), half of them for one frequent word each, half hash buckets of all
others; counts cover every document.  The network sees the classes of SIDE tokens before and SIDE after a masked token,
embeds and joins them, and gives a distribution over classes through one hidden layer and a softmax in two steps (group,
then class within the group), so that a token costs about the square root of the classes.

1. One pass counts words; another writes every document as class numbers, which all later steps read.
2. Every token of every document is masked and predicted once in training: in one of ROUNDS rounds, by its hash.  Documents
   are dealt by hash to training groups (one for GROUP_TOKENS tokens, MOST_GROUPS at most), whatever the cluster.  A group
   runs Adam from the common parameters, its documents in the order of their texts' hashes, and the groups' parameters are
   averaged by their tokens, in the order of the groups: another partitioning gives the same model.
3. A document's score is the sum over all its tokens of log P(class | both sides) + log P(word | class).  The latter comes
   from the words of all other documents: (n - t) / (N - T + 1) in a bucket of N tokens, T of them in the document, for a
   word found n times, t of them in the document; 1 / (N - T + 1) is left for words that no other document has, which are
   spelled out, each byte and the end with 1 / 257.  The network scores with weights and hidden values rounded to whole
   multiples, so few that every sum of a matrix product is exact in single precision, and logarithms are rounded to whole
   multiples of 1 / GRID before they are added: scores do not depend on order, place or partitioning.
Counts of at most about KNOWN frequent words are broadcast; those of all others stay in a table that the documents' words are
joined to.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .tokens import cores

#: Classes of a small corpus; a larger one has more.
CLASSES = 128
#: Words whose counts are broadcast, at most (the frequent classes' words at least).
KNOWN = 1 << 16
SIDE, EMBED, HIDDEN = 2, 8, 20
STEPS = (*range(-SIDE, 0), *range(1, SIDE + 1))
ROUNDS = 2
BATCH, RATE = 4096, 0.02
#: Tokens of a training group, about; groups at most; and tokens that are shuffled within a group, or scored, together.
GROUP_TOKENS, MOST_GROUPS, CHUNK = 500_000, 4096, 1 << 16
FLUSH_WORDS = 1_000_000
#: Groups whose parameters are summed at a time.
FAN = 16
#: Parts of one in which the scoring network's first layer, hidden values, weights and output biases are counted.
FIRST, STATE, WEIGHT = 2.0**12, 2.0**8, 2.0**7
GRID = 2.0**24
SPELL = math.log(257)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): occurrences of every word hash in all texts; summed within tasks before the shuffle."""

    def count(batches):
        held, rows = [], 0
        for batch in batches:
            for _, _, data, offsets in K.blocks(batch.column(0)):
                held.append(np.unique(cores(data, offsets)[5], return_counts=True))
                rows += len(held[-1][0])
                if rows > FLUSH_WORDS:
                    yield flush(held)
                    held, rows = [], 0
        if rows:
            yield flush(held)

    def flush(held):
        words, n = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(words, kind="stable")
        words, n = words[order], n[order]
        at = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        return pa.RecordBatch.from_arrays([pa.array(K.signed(words[at])), pa.array(np.add.reduceat(n, at))], ["word", "n"])

    return docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def class_number(distinct: int) -> int:
    """Classes of a corpus with so many different words."""
    return max(CLASSES, 2 * (math.isqrt(distinct) // 2))


def vocabulary(docs: DataFrame) -> dict:
    """Frequent words (sorted hashes and their classes), share of each class, known words, where all counts are stored, and training groups."""
    folder = K.shared_folder(docs.sparkSession)
    counts = K.stored(word_counts(docs), "counts", folder)
    # words by quarters of powers of two of their counts: a bounded table, from which the least known count follows
    held = sorted(counts.groupBy(F.floor(F.log2("n") * 4).alias("level")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
    classes = class_number(sum(r.words for r in held))
    frequent, room, least = classes // 2, max(KNOWN, classes // 2), None
    for r in held:
        room -= r.words
        if room < 0:
            break
        least = r.level
    top = counts.filter(F.floor(F.log2("n") * 4) >= least).collect() if least is not None else []
    words, n = np.array([r.word for r in top], np.int64), np.array([r.n for r in top], np.int64)
    order = np.lexsort((words, -n))
    words, n = words[order], n[order]
    total = np.zeros(classes)
    buckets = classes - frequent
    for r in counts.groupBy(F.pmod("word", F.lit(buckets)).alias("bucket")).agg(F.sum("n").alias("n")).collect():
        total[frequent + r.bucket] = r.n
    single = min(frequent, len(words))
    total[:single] = n[:single]
    np.subtract.at(total, frequent + np.mod(words[:single], buckets), n[:single])
    bias = np.log((total + 1) / (total + 1).sum()).astype(np.float32)
    first, known = np.argsort(words[:single].view(np.uint64)), np.argsort(words.view(np.uint64))
    groups = int(min(MOST_GROUPS, max(1, math.ceil(total.sum() / GROUP_TOKENS))))
    return {"words": words[:single].view(np.uint64)[first], "classes": first.astype(np.int64), "frequent": frequent, "bias": bias, "total": total, "known": words.view(np.uint64)[known], "n": n[known], "counts": f"{folder}/counts", "groups": groups}


def _found(words: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each word in the sorted words, and whether it is there."""
    if not len(ordered):
        return np.zeros(len(words), np.int64), np.zeros(len(words), bool)
    at = np.minimum(np.searchsorted(ordered, words), len(ordered) - 1)
    return at, ordered[at] == words


def _classes(words: np.ndarray, vocab: dict) -> np.ndarray:
    out = vocab["frequent"] + np.mod(words.view(np.int64), len(vocab["bias"]) - vocab["frequent"])
    at, hit = _found(words, vocab["words"])
    out[hit] = vocab["classes"][at[hit]]
    return out


def _kind(vocab: dict) -> str:
    """Bytes of a class number."""
    return "<u2" if len(vocab["bias"]) < 1 << 16 else "<u4"


def contexts(own: np.ndarray, doc: np.ndarray, at: np.ndarray, beyond: int) -> np.ndarray:
    """The classes around the tokens `at`; `beyond` outside their documents."""
    out = np.full((len(at), len(STEPS)), beyond, np.int64)
    for j, step in enumerate(STEPS):
        to = np.clip(at + step, 0, len(own) - 1)
        ok = (to == at + step) & (doc[to] == doc[at])
        out[ok, j] = own[to[ok]]
    return out


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Begins of runs of equal keys in sorted arrays."""
    new = np.zeros(max(0, len(keys[0]) - 1), bool)
    for k in keys:
        new |= k[1:] != k[:-1]
    return np.flatnonzero(np.append(True, new)) if len(keys[0]) else np.zeros(0, np.int64)


def _grid(x: np.ndarray) -> np.ndarray:
    return np.round(x * GRID).astype(np.int64)


ENCODED = [("row", T.LongType()), ("digest", T.LongType()), ("n", T.LongType()), ("classes", T.BinaryType()), ("base", T.LongType()), ("words", T.ArrayType(T.LongType())), ("times", T.ArrayType(T.LongType())), ("sizes", T.ArrayType(T.LongType()))]


def encode(docs: DataFrame, vocab: dict, counted: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as class numbers, written once: (id, row, digest, n, classes, base, words, times, sizes).

    base: the part of log P(word | class) that needs no stored count, in units of 1 / GRID; words, times, sizes: the row's
    different words whose counts are stored only.  counted: the rows are part of the corpus that the counts are of.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(*f) for f in ENCODED)])

    def run(batches):
        vocab = shared.value
        classes, total = len(vocab["bias"]), vocab["total"]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi, data, offsets in K.blocks(batch.column(1)):
                s, e, _, _, first, words = cores(data, offsets)
                own = _classes(words, vocab)
                docs_here = hi - lo
                doc = np.repeat(np.arange(docs_here), np.diff(first))
                some = np.flatnonzero(own >= vocab["frequent"])
                order = some[np.lexsort((words[some], doc[some]))]
                at = _runs(doc[order], words[order])
                times = np.diff(np.append(at, len(order)))
                pick = order[at]
                d, w, k, size = doc[pick], words[pick], own[pick], (e - s)[pick]
                key, where = np.unique(d * classes + k, return_inverse=True)
                here = np.bincount(where, weights=times, minlength=len(key))[where] if counted and len(key) else np.zeros(len(d))
                part = -times * _grid(np.log(np.maximum(total[k] - here, 0) + 1))
                place, hit = _found(w, vocab["known"])
                left = vocab["n"][place[hit]] - (times[hit] if counted else 0)
                part[hit] += times[hit] * np.where(left > 0, _grid(np.log(np.maximum(left, 1))), -_grid((size[hit] + 1) * SPELL))
                base = np.zeros(docs_here, np.int64)
                np.add.at(base, d, part)
                rest = np.flatnonzero(~hit)
                bounds = pa.array(np.searchsorted(d[rest], np.arange(docs_here + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(a)) for a in (K.signed(w[rest]), times[rest].astype(np.int64), size[rest].astype(np.int64))]
                numbers = np.split(own.astype(_kind(vocab)), first[1:-1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, docs_here), pa.array(row + np.arange(docs_here)), batch.column(2).slice(lo, docs_here), pa.array(np.diff(first)), K.binaries(numbers), pa.array(base), *lists], schema.fieldNames())
                row += docs_here

    text = F.col(f"`{text_col}`")
    return K.stored(docs.select(F.col(f"`{id_col}`"), text, F.xxhash64(F.coalesce(text, F.lit("")))).mapInArrow(run, schema), "encoded")


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The class numbers of all rows of a batch, and each one's row."""
    data, offsets = K.buffers(column)
    size = np.diff(offsets) // np.dtype(kind).itemsize
    return np.frombuffer(data.tobytes(), kind).astype(np.int64), np.repeat(np.arange(len(size)), size)


def initial(vocab: dict, seed: int = 5) -> list[np.ndarray]:
    """Embeddings, hidden layer, the groups' output layer, and each group's own output layer over its classes."""
    r = np.random.default_rng(seed)
    classes = len(vocab["bias"])
    groups = math.isqrt(classes - 1) + 1
    members = -(-classes // groups)
    shape = [(classes + 1, EMBED), (2 * SIDE * EMBED, HIDDEN), (HIDDEN,), (HIDDEN, groups), (groups, HIDDEN, members)]
    scale = [1 / np.sqrt(EMBED), 1 / np.sqrt(2 * SIDE * EMBED), 0.1, 0.1 / np.sqrt(HIDDEN), 0.1 / np.sqrt(HIDDEN)]
    embed, w, b, outer, inner = ((r.standard_normal(s) * k).astype(np.float32) for s, k in zip(shape, scale, strict=True))
    bias = np.full(groups * members, -1e9)
    bias[:classes] = vocab["bias"]
    bias = bias.reshape(groups, members)
    most = bias.max(1)
    group = most + np.log(np.exp(bias - most[:, None]).sum(1))
    within = np.where(bias > -1e8, bias - group[:, None], -1e9)
    return [embed, w, b, outer, group.astype(np.float32), inner, within.astype(np.float32)]


def _hidden(p, around):
    """Inputs, a row for each token, and hidden values, a column for each."""
    x = p[0].take(around.reshape(-1), axis=0).reshape(len(around), -1)
    h = p[1].T @ x.T
    h += p[2][:, None]
    return x, np.tanh(h, out=h)


def _softmax(z):
    """The columns' softmax, in place of z."""
    z -= z.max(0)
    np.exp(z, out=z)
    z /= z.sum(0)
    return z


def _log_chosen(z, at):
    """The log softmax of each column of z at its row `at`; z is used up."""
    if z.shape[1] == 1:  # numpy sums a single column in another order
        return _log_chosen(np.repeat(z, 2, axis=1), np.repeat(at, 2))[:1]
    z -= z.max(0)
    chosen = z[at, np.arange(len(at))]
    np.exp(z, out=z)
    chosen -= np.log(z.sum(0))
    return chosen


def _order(x: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0; those of two bytes are sorted by their digits."""
    return np.argsort(x.astype(np.uint16) if len(x) and x.max() < 1 << 16 else x, kind="stable")


def train(p: list[np.ndarray], own: np.ndarray, around: np.ndarray, state: list, t: int) -> int:
    """One pass of Adam over the given masked tokens; returns the steps so far."""
    members = p[5].shape[2]
    for lo in range(0, len(own), BATCH):
        by_class = _order(own[lo : lo + BATCH])  # so that a group's tokens lie together
        y, c = own[lo : lo + BATCH][by_class], around[lo : lo + BATCH][by_class]
        n = np.float32(1 / len(y))
        x, h = _hidden(p, c)
        z = p[3].T @ h
        z += p[4][:, None]
        g = _softmax(z)
        group = y // members
        g[group, np.arange(len(y))] -= 1
        g *= n
        gh = p[3] @ g
        inner, within = np.zeros_like(p[5]), np.zeros_like(p[6])
        cuts = _runs(group)
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(y)], strict=True):
            k, some = group[a], h[:, a:b]
            z = p[5][k].T @ some
            z += p[6][k][:, None]
            gk = _softmax(z)
            gk[y[a:b] - k * members, np.arange(b - a)] -= 1
            gk *= n
            np.matmul(some, gk.T, out=inner[k])
            gk.sum(1, out=within[k])
            gh[:, a:b] += p[5][k] @ gk
        gh *= 1 - h * h
        gx = (gh.T @ p[1].T).reshape(-1, EMBED)
        at = c.reshape(-1)  # gradients of embeddings: sums by class, as sorted runs
        order = _order(at)
        runs = _runs(at[order])
        ge = np.zeros_like(p[0])
        ge[at[order][runs]] = np.add.reduceat(gx.take(order, axis=0), runs, axis=0)
        t += 1
        rate, first, second = np.float32(RATE / np.sqrt(t / 50 + 1) / (1 - 0.9**t)), np.float32(0.1), np.float32(0.01)
        fade = np.float32(1 / (1 - 0.99**t))
        for q, grad, (m, v) in zip(p, (ge, x.T @ gh.T, gh.sum(1), h @ g.T, g.sum(1), inner, within), state, strict=True):
            m += first * (grad - m)
            grad *= grad
            v += second * (grad - v)
            q -= rate * m / (np.sqrt(fade * v) + np.float32(1e-7))
    return t


def prepared(p: list[np.ndarray]) -> list[np.ndarray]:
    """The parameters as whole multiples, with each place's embeddings already through its part of the hidden layer."""
    embed, w, b, outer, group, inner, within = (a.astype(np.float64) for a in p)

    def whole(x, parts, most):
        return np.rint(np.clip(x, -most, most) * parts).astype(np.float32)

    tables = np.stack([whole(embed @ w[j * EMBED : (j + 1) * EMBED], FIRST, 256) for j in range(len(STEPS))])
    # products are below 2**8 * 2**9, their sums below 2**23 with the biases
    bias = STATE * WEIGHT
    scale = np.float32(1 / bias)  # a power of two: all stay exact
    return [tables, whole(b, FIRST, 256), whole(outer, WEIGHT, 4).T * scale, whole(group, bias, 60)[:, None] * scale, whole(inner, WEIGHT, 4).transpose(0, 2, 1) * scale, whole(within, bias, 60)[:, :, None] * scale]


def log_probabilities(ready: list[np.ndarray], own: np.ndarray, around: np.ndarray, step: int = 8192) -> np.ndarray:
    """log P(class | classes around it) of each token, in single precision; ready: see prepared()."""
    tables, b, outer, group, inner, within = ready
    members = inner.shape[1]
    out = np.zeros(len(own), np.float32)
    for lo in range(0, len(own), step):
        by_class = _order(own[lo : lo + step])  # so that a group's tokens lie together
        y, c = own[lo : lo + step][by_class], around[lo : lo + step][by_class]
        h = tables[0].take(c[:, 0], axis=0)
        h += b
        for j in range(1, len(STEPS)):
            h += tables[j].take(c[:, j], axis=0)
        h *= np.float32(1 / FIRST)
        np.tanh(h, out=h)
        h *= np.float32(STATE)
        np.rint(h, out=h)
        h = np.ascontiguousarray(h.T)
        of = y // members
        z = outer @ h
        z += group
        total = _log_chosen(z, of)
        cuts = _runs(of)
        for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(y)], strict=True):
            k = of[s]
            z = inner[k] @ h[:, s:e]
            z += within[k]
            total[s:e] += _log_chosen(z, y[s:e] - k * members)
        out[lo + by_class] = total
    return out


def _fit(encoded: DataFrame, vocab: dict, rounds: int) -> list[np.ndarray]:
    spark = encoded.sparkSession
    p, groups, kind, beyond = initial(vocab), vocab["groups"], _kind(vocab), len(vocab["bias"])
    dealt = encoded.filter("n > 0").select(F.pmod(F.xxhash64("digest", "id"), F.lit(groups)).cast("int").alias("group"), "digest", "classes")
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(p)

        def run(batches, shared=shared, turn=turn):
            held: dict = {}

            def begin(group):
                q = [a.copy() for a in shared.value]
                held.update(group=group, q=q, state=[(np.zeros_like(a), np.zeros_like(a)) for a in q], t=0, seen=0, parts=[], waiting=0)

            def learn(least):
                """Train on whole chunks, and on the rest if it must be."""
                while held["waiting"] >= max(1, least):
                    whole = [np.concatenate(x) for x in zip(*held["parts"], strict=True)]
                    own, around, draw = (x[:CHUNK] for x in whole)
                    order = np.argsort(draw, kind="stable")
                    held["t"] = train(held["q"], own[order], around[order], held["state"], held["t"])
                    held["seen"] += len(own)
                    held["parts"], held["waiting"] = [[x[CHUNK:] for x in whole]], held["waiting"] - len(own)

            def end():
                learn(1)
                whole = np.concatenate([a.astype("<f8").ravel() for a in held["q"]]) * held["seen"]
                yield pa.RecordBatch.from_arrays([pa.array([held["group"]]), pa.array([held["seen"]]), pa.array([whole.tobytes()], pa.binary())], ["place", "n", "total"])

            for batch in batches:
                group = batch.column(0).to_numpy()
                digest = batch.column(1).to_numpy().view(np.uint64)
                own, doc = _flat(batch.column(2), kind)
                first = np.searchsorted(doc, np.arange(len(group) + 1))
                for a, b in zip(at := _runs(group).tolist(), [*at[1:], len(group)], strict=True):
                    if held.get("group") != group[a]:
                        if held:
                            yield from end()
                        begin(int(group[a]))
                    for lo in range(first[a], first[b], CHUNK):
                        hi = min(lo + CHUNK, first[b])
                        place = np.arange(lo, hi) - first[doc[lo:hi]]
                        draw = K.mix(digest[doc[lo:hi]] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                        mine = np.flatnonzero(draw % np.uint64(rounds) == turn)
                        held["parts"].append([own[lo + mine], contexts(own, doc, lo + mine, beyond), draw[mine]])
                        held["waiting"] += len(mine)
                        learn(CHUNK)
            if held:
                yield from end()

        def add(key, table):
            table = table.sort_by("place")  # a fixed order: float sums depend on it
            total = sum(np.frombuffer(x, "<f8") for x in table["total"].to_pylist())
            return pa.table({"place": pa.array([key[0].as_py()], pa.int64()), "n": pa.array([pa.compute.sum(table["n"]).as_py()], pa.int64()), "total": pa.array([total.tobytes()], pa.binary())})

        sums = dealt.repartitionById(groups, "group").sortWithinPartitions("group", "digest").mapInArrow(run, "place long, n long, total binary")
        left = groups
        while left > 1:  # a tree of sums: no task holds more than FAN models
            sums = sums.groupBy(F.floor(F.col("place") / FAN).alias("to")).applyInArrow(add, "place long, n long, total binary")
            left = -(-left // FAN)
        for row in sums.collect():
            whole, at = np.frombuffer(row.total, "<f8") / row.n, 0
            for i, a in enumerate(p):
                p[i] = whole[at : at + a.size].astype(np.float32).reshape(a.shape)
                at += a.size
    return p


def fit(docs: DataFrame, vocab: dict, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> list[np.ndarray]:
    """Parameters averaged over the groups' training; every token of every document is predicted in one of the rounds."""
    return _fit(encode(docs, vocab, True, id_col, text_col), vocab, rounds)


def _score(encoded: DataFrame, vocab: dict, p: list[np.ndarray], counted: bool, id_col: str) -> DataFrame:
    spark = encoded.sparkSession
    shared, kind, beyond = spark.sparkContext.broadcast(p), _kind(vocab), len(vocab["bias"])
    id_type = encoded.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), *(T.StructField(c, T.LongType()) for c in ("row", "n", "total"))])

    def run(batches):
        ready = prepared(shared.value)
        for batch in batches:
            own, doc = _flat(batch.column(4), kind)
            total = batch.column(3).to_numpy().copy()
            for lo in range(0, len(own), CHUNK):
                hi = min(lo + CHUNK, len(own))
                np.add.at(total, doc[lo:hi], _grid(log_probabilities(ready, own[lo:hi], contexts(own, doc, np.arange(lo, hi), beyond)).astype(np.float64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(total)], schema.fieldNames())

    rows = encoded.select("id", "row", "n", "base", "classes").mapInArrow(run, schema)
    counts = spark.read.schema("word long, n long").parquet(vocab["counts"]).withColumnRenamed("n", "found")
    rare = encoded.select("row", F.explode(F.arrays_zip("words", "times", "sizes")).alias("w")).select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"), F.col("w.sizes").alias("size"))
    left = F.coalesce("found", F.lit(0)) - (F.col("times") if counted else F.lit(0))
    each = F.when(left > 0, F.round(F.log(F.greatest(left, F.lit(1)).cast("double")) * GRID)).otherwise(-F.round((F.col("size") + 1) * SPELL * GRID)).cast("long")
    more = rare.join(counts, "word", "left").select(F.lit(None).cast(id_type).alias("id"), "row", F.lit(0).cast("long").alias("n"), (F.col("times") * each).alias("total"))
    whole = rows.unionByName(more).groupBy("row").agg(F.first("id", ignorenulls=True).alias("id"), F.sum("n").alias("n"), (F.sum("total") / GRID).alias("total"))
    return whole.select(F.col("id").alias(id_col), F.col("n").alias("n_tokens"), F.col("total").alias("pseudo_log_likelihood"), F.when(F.col("n") > 0, F.col("total") / F.col("n")).alias("mean_log_probability"))


def score(docs: DataFrame, vocab: dict, p: list[np.ndarray], id_col: str = "doc_id", text_col: str = "text", counted: bool = False) -> DataFrame:
    """(id, n_tokens, pseudo_log_likelihood, mean_log_probability) of every row.

    A null or empty text has no tokens, score 0 and a null mean.  Whole texts are scored; equal texts get equal scores,
    whatever the partitioning; rows with null or repeated ids each have a row; an empty table gives an empty table.
    counted: the rows are part of the corpus that the vocabulary was counted on, so their own words are left out of it.
    """
    return _score(encode(docs, vocab, counted, id_col, text_col), vocab, p, counted, id_col)


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Vocabulary, training and scoring on one table; see score()."""
    own = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").alias("text"))
    vocab = vocabulary(own)
    encoded = encode(own, vocab, True, id_col, "text")
    return _score(encoded, vocab, _fit(encoded, vocab, ROUNDS), True, id_col)


def query(spark, sf_dir):
    """Scores of all documents (null, empty, repeated and very long texts as in score())."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
