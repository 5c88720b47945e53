"""Minimal perfect hash of 64-bit keys, in shards of bounded size, with fingerprint and count arrays beside it.

A shard has levels: each level is a bit array of about ``GAMMA`` bits a key, in which a key that no other key meets sets
its bit; the others go to the next level.  A key's slot is the number of set bits before its own, over all levels.
"""

from __future__ import annotations

import struct

import numpy as np

from .kernel import U64, mix, multipliers

GAMMA = 2.0
RANK_STEP = 64


def _position(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ multipliers(101, 64)[level]) % U64(size)).astype(np.int64)


class Shard:
    """Distinct keys -> slots 0..n-1; slots hold a 64-bit fingerprint and a 32-bit count."""

    def __init__(self, bits: list[np.ndarray], fingerprints: np.ndarray, counts: np.ndarray):
        self.bits, self.fingerprints, self.counts = bits, fingerprints, counts
        self.packed = [np.packbits(b, bitorder="little") for b in bits]
        self.ranks, base = [], 0
        for b in bits:  # set bits before each block of RANK_STEP bits
            per = b.reshape(-1, RANK_STEP).sum(1)
            self.ranks.append(base + np.concatenate([[0], np.cumsum(per)[:-1]]).astype(np.int64))
            base += int(per.sum())

    @classmethod
    def build(cls, keys: np.ndarray, fingerprints: np.ndarray, counts: np.ndarray) -> "Shard":
        bits, rest = [], keys
        while len(rest):
            if len(bits) == 64:
                raise ValueError("keys of a perfect hash must be distinct")
            size = -(-max(RANK_STEP, int(GAMMA * len(rest))) // RANK_STEP) * RANK_STEP
            at = _position(rest, len(bits), size)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(alone)
            rest = rest[~alone[at]]
        out = cls(bits, np.zeros(len(keys), U64), np.zeros(len(keys), np.uint32))
        slots = out.slots(keys)
        out.fingerprints[slots] = fingerprints
        out.counts[slots] = counts
        return out

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1, or any slot, for keys that are not in the shard."""
        out, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (b, ranks) in enumerate(zip(self.bits, self.ranks, strict=True)):
            at = _position(keys[rest], level, len(b))
            hit = b[at]
            found, pos = rest[hit], at[hit]
            block = pos // RANK_STEP
            words = self.packed[level].view("<u8")[block]
            below = words & ((U64(1) << (pos % RANK_STEP).astype(U64)) - U64(1))
            out[found] = ranks[block] + np.bitwise_count(below)
            rest = rest[~hit]
            if not len(rest):
                break
        return out

    def lookup(self, keys: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
        """Count of each key, 0 where its fingerprint differs or it has no slot."""
        slots = self.slots(keys)
        found = np.flatnonzero(slots >= 0)
        found = found[self.fingerprints[slots[found]] == fingerprints[found]]
        out = np.zeros(len(keys), np.uint32)
        out[found] = self.counts[slots[found]]
        return out

    def to_bytes(self) -> bytes:
        head = struct.pack(f"<II{len(self.bits)}I", len(self.bits), len(self.counts), *map(len, self.bits))
        return head + b"".join(p.tobytes() for p in self.packed) + self.fingerprints.tobytes() + self.counts.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Shard":
        levels, n = struct.unpack_from("<II", raw)
        sizes, at = struct.unpack_from(f"<{levels}I", raw, 8), 8 + 4 * levels
        bits = []
        for size in sizes:
            bits.append(np.unpackbits(np.frombuffer(raw, np.uint8, size // 8, at), bitorder="little").astype(bool))
            at += size // 8
        return cls(bits, np.frombuffer(raw, U64, n, at), np.frombuffer(raw, np.uint32, n, at + 8 * n))
