"""SentencePiece-style BPE encoding and decoding with vectorised merge rounds.

A text becomes segments that no piece can cross (a run of spaces and the characters after it).  All segments not met
before are encoded together on flat numpy arrays: each round finds every segment's minimum pair rank, merges its leftmost
pair of that rank (and the later ones too, where no better merge could have come between), and compacts; segments without
a mergeable pair leave.  Characters outside the vocabulary fall back to byte pieces.  Only reading the vocabulary uses
the sentencepiece library.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K

SPACE_MARK = "▁"
NONE = np.iinfo(np.int32).max
#: Segments kept by a worker with their ids; bounds its memory.
CACHE_SEGMENTS = 150_000
CACHE_IDS = 2_000_000
_SEGMENTS = re.compile(" *[^ ]+| +")


class Vocabulary:
    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        if sp.normalize("a  b ﬁ") != f"{SPACE_MARK}a{SPACE_MARK * 2}b ﬁ":
            raise ValueError("only models with the identity normaliser and a dummy prefix are supported")
        self.size = sp.get_piece_size()
        self.begin, self.end, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        pieces = [sp.id_to_piece(i) for i in range(self.size)]
        special = {i for i in range(self.size) if sp.is_control(i) or sp.is_unknown(i)}
        self.bytes = np.full(256, -1, np.int64)
        for i in range(self.size):
            if sp.is_byte(i):
                self.bytes[int(pieces[i][3:5], 16)] = i
                special.add(i)
        if (self.bytes < 0).any():
            raise ValueError("the model has no byte fallback")
        ids = {p: i for i, p in enumerate(pieces) if i not in special}
        scores = {p: sp.get_score(i) for p, i in ids.items()}
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in ids):
            raise ValueError("a piece crosses a space; segments would not be independent")
        chars = sorted(set("".join(ids)))
        extra = [c for c in chars if c not in ids]  # characters that only occur inside pieces
        symbols = ids | {c: self.size + k for k, c in enumerate(extra)}
        self.points = np.array([ord(c) for c in chars], np.uint32)
        self.of_point = np.array([symbols[c] for c in chars], np.int32)
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        rank = {p: order[s] for p, s in scores.items()}
        shared = {r for r, n in zip(*np.unique(list(rank.values()), return_counts=True), strict=True) if n > 1}
        keys, made, lefts = [], [], {}
        for p, i in ids.items():
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    made.append(i)
                    lefts.setdefault(p, []).append(p[:k])
        #: Pieces of which a round merges only the leftmost pair of a segment: a merge of equal or better rank could begin
        #: with that pair and take the left half of a later one.
        one = np.zeros(self.size, bool)
        for p, i in ids.items():
            if rank[p] in shared:
                one[i] = True
            for a in range(len(p)):
                for b in range(a + 2, len(p)):
                    q = p[a:b]
                    if q in lefts and rank[p] <= rank[q] and any(len(p) - b >= len(x) and p.endswith(x) for x in lefts[q]):
                        one[ids[q]] = True
        self.one = one
        by = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.append(np.array(keys, np.int64)[by], np.iinfo(np.int64).max)
        self.pair_made = np.append(np.array(made, np.int32)[by], -1)
        self.rank_of = np.array([rank.get(p, NONE) for p in pieces], np.int32)
        surface = [b"" if i in (self.begin, self.end) or sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_len = np.array([len(s) for s in surface], np.int64)
        self.surface_at = np.cumsum(self.surface_len) - self.surface_len
        self.is_byte = np.zeros(self.size, bool)
        self.is_byte[self.bytes] = True
        self.spaced = np.array([p.startswith(SPACE_MARK) for p in pieces])
        self.reset()

    def reset(self) -> None:
        self.cache: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.at, self.len = np.zeros(0, np.int64), np.zeros(0, np.int64)

    # --- encoding ---------------------------------------------------------------------------------------------------
    def _pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of what each pair would make; NONE if nothing."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        key[(a < 0) | (b < 0)] = -1
        at = np.searchsorted(self.pair_keys, key)
        made = np.where(self.pair_keys[at] == key, self.pair_made[at], -1)
        return np.where(made >= 0, self.rank_of[made], NONE), made

    def merge(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments one after another, and their number for each segment."""
        points = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        lens = np.fromiter(map(len, segments), np.int64, len(segments))
        near = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        sym = np.where(self.points[near] == points, self.of_point[near], -1)
        word, pos = np.repeat(np.arange(len(segments)), lens), np.arange(len(points))
        rank, made = np.full(len(sym), NONE, np.int32), np.full(len(sym), -1, np.int32)
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner], made[inner] = self._pairs(sym[inner], sym[inner + 1])
        done: list[tuple[np.ndarray, ...]] = []
        while len(sym):
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(first, len(sym)))
            least = np.minimum.reduceat(rank, first)
            over = least == NONE
            if over.any():
                out = np.repeat(over, size)
                done.append((word[out], sym[out], pos[out]))
                sym, word, pos, rank, made = (x[~out] for x in (sym, word, pos, rank, made))
                if not len(sym):
                    break
                size, least = size[~over], least[~over]
            hit = np.flatnonzero(rank == np.repeat(least, size))
            lead = np.append(True, word[hit[1:]] != word[hit[:-1]])
            run = np.append(True, np.diff(hit) != 1)  # overlapping pairs: every second one of a run
            start = np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
            take = lead | (~self.one[made[hit]] & ((hit - hit[start]) % 2 == 0))
            hit = hit[take]
            sym[hit] = made[hit]
            stay = np.ones(len(sym), bool)
            stay[hit + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[hit] = True
            sym, word, pos, rank, made, touched = (x[stay] for x in (sym, word, pos, rank, made, touched))
            new = np.flatnonzero(touched)
            new = np.unique(np.concatenate([new, new[new > 0] - 1]))
            rank[new], made[new] = NONE, -1
            new = new[new < len(sym) - 1]
            new = new[word[new] == word[new + 1]]
            rank[new], made[new] = self._pairs(sym[new], sym[new + 1])
        word, sym, pos = (np.concatenate([d[k] for d in done]) if done else np.zeros(0, np.int64) for k in range(3))
        order = np.argsort(pos, kind="stable")
        word, sym, pos = word[order], sym[order], pos[order]
        strange = (sym < 0) | (sym >= self.size)
        wide = np.ones(len(sym), np.int64)
        p = points[pos[strange]]
        wide[strange] = 1 + (p > 0x7F) + (p > 0x7FF) + (p > 0xFFFF)
        ids = np.repeat(np.where(strange, 0, sym), wide).astype(np.uint32)
        if strange.any():
            ids[np.repeat(strange, wide)] = self.bytes[np.frombuffer(p.tobytes().decode("utf-32-le").encode(), np.uint8)]
        return ids, np.bincount(np.repeat(word, wide), minlength=len(segments)).astype(np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids without begin and end of all texts one after another, and their number for each text."""
        if len(self.cache) > CACHE_SEGMENTS or self.used > CACHE_IDS:
            self.reset()
        segments: list[str] = []
        count = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                if SPACE_MARK in text:
                    text = text.replace(SPACE_MARK, " ")
                part = text.split(" ")
                if "" in part:  # runs of spaces
                    part = [s[1:] for s in _SEGMENTS.findall(" " + text)]
                count[i] = len(part)
                segments += part
        cache = self.cache
        fresh = list(set(segments).difference(cache))
        if fresh:
            ids, lens = self.merge([SPACE_MARK + s.replace(" ", SPACE_MARK) for s in fresh])
            if self.used + len(ids) > len(self.flat):
                self.flat = np.concatenate([self.flat[: self.used], np.zeros(self.used + 2 * len(ids), np.uint32)])
            self.flat[self.used : self.used + len(ids)] = ids
            self.at = np.concatenate([self.at, self.used + np.cumsum(lens) - lens])
            self.len = np.concatenate([self.len, lens])
            self.used += len(ids)
            cache.update(zip(fresh, range(len(cache), len(cache) + len(fresh)), strict=True))
        which = np.fromiter(map(cache.__getitem__, segments), np.int64, len(segments))
        lens = self.len[which]
        index, _ = K.span_index(self.at[which], lens)
        doc = np.repeat(np.arange(len(texts)), count)
        return self.flat[index], np.bincount(doc, weights=lens, minlength=len(texts)).astype(np.int64)

    # --- decoding ---------------------------------------------------------------------------------------------------
    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of id sequences, `sizes` ids each: byte pieces joined, marks to spaces, the dummy prefix removed."""
        lens = self.surface_len[ids]
        index, _ = K.span_index(self.surface_at[ids], lens)
        raw = self.surface[index].tobytes()
        ends = np.concatenate([[0], np.cumsum(lens)])[np.concatenate([[0], np.cumsum(sizes)])]
        out, at = [], 0
        for i, size in enumerate(sizes):
            part = raw[ends[i] : ends[i + 1]]
            own = ids[at : at + size]
            shown = own[lens[at : at + size] > 0]
            if len(shown) and self.spaced[shown[0]]:
                part = part[1:]
            try:
                out.append(part.decode())
            except UnicodeDecodeError:  # bytes that are no character: one U+FFFD each
                out.append(_lossy(part))
            at += size
        return out


def _lossy(raw: bytes) -> str:
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                pass
        else:
            out.append("�")
            at += 1
    return "".join(out)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary of a model, built once in each worker."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(model)
    return _loaded[key]


def encode_documents(docs: DataFrame, model_path: str, text_col: str = "text", with_ids: bool = True, block_bytes: int = 1 << 19) -> DataFrame:
    """All columns of `docs`, and n_tokens, ids_sha256, decoded_sha256, and with `with_ids` also ids (32-bit little-endian)
    and decoded; input columns of these names are replaced.

    Ids have begin and end ids.  A null or empty text has just these two and decodes to an empty text.  The text is
    encoded whole however long it is; equal rows give equal results; an empty table gives an empty table.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    made = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    made += [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())] if with_ids else []
    names = {f.name for f in made}
    others = [f for f in docs.schema.fields if f.name not in names]
    schema = T.StructType([*others, *made])
    source = [*K.positional(others), F.col(f"`{text_col}`").alias("riskloom text")]

    def run(batches):
        vocab = vocabulary(model.value)
        begin, end = (np.array([x], "<u4").tobytes() for x in (vocab.begin, vocab.end))
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for lo, hi, _, _ in K.blocks(column, block_bytes):
                ids, sizes = vocab.encode(column.slice(lo, hi - lo).to_pylist())
                decoded = vocab.decode(ids, sizes)
                raw, stops = ids.astype("<u4").tobytes(), np.cumsum(sizes) * 4
                whole = [begin + raw[b - 4 * n : b] + end for b, n in zip(stops.tolist(), sizes.tolist(), strict=True)]
                columns = [
                    *(batch.column(i).slice(lo, hi - lo) for i in range(batch.num_columns - 1)),
                    pa.array(sizes + 2),
                    pa.array([hashlib.sha256(w).hexdigest() for w in whole], pa.string()),
                    pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                ]
                columns += [pa.array(whole, pa.binary()), pa.array(decoded, pa.string())] if with_ids else []
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
        vocab.reset()  # workers are used again by other stages

    return docs.select(*source).mapInArrow(run, schema)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir):
    """Ids and decoded texts of all documents, as digests; odd texts as in encode_documents()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_documents(docs, default_model(), with_ids=False).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
