"""Static binary-fuse filter: three slots of eight bits per key, built once, never changed."""

from __future__ import annotations

import numpy as np

M64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _layout(n: int) -> tuple[int, int]:
    """(length of a segment, number of segments); a key's slots lie in three neighbouring segments."""
    length = 1 << max(2, min(18, int(np.floor(np.log(max(n, 2)) / np.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    return length, max(3, int(np.ceil(n * factor / length)) + 2)


def _slots(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(n, 3) slot numbers and the fingerprints of the keys."""
    h = _mix(keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15))
    first = ((h >> np.uint64(32)) * np.uint64(segments - 2)) >> np.uint64(32)
    g = _mix(h + np.uint64(0x632BE59BD9B4E019))
    mask = np.uint64(length - 1)
    parts = [(first + np.uint64(i)) * np.uint64(length) + ((g >> np.uint64(20 * i)) & mask) for i in range(3)]
    return np.stack(parts, axis=1).astype(np.int64), (h & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> tuple[int, bytes]:
    """(seed, slots) of a filter that holds every key; repeated keys count once."""
    keys = np.unique(keys.astype(np.uint64))
    length, segments = _layout(len(keys))
    for seed in range(1, 200):
        at, prints = _slots(keys, seed, length, segments)
        layers = _peel(at, length * segments)
        if layers is None:
            if seed % 10 == 0:  # unlucky or tiny sets get more room
                segments += 1 + segments // 8
            continue
        table = np.zeros(length * segments, np.uint8)
        for key, column in reversed(layers):
            rows = at[key]
            value = prints[key] ^ table[rows[:, 0]] ^ table[rows[:, 1]] ^ table[rows[:, 2]]
            table[rows[np.arange(len(key)), column]] = value
        return seed, length.to_bytes(4, "little") + table.tobytes()
    raise RuntimeError("no filter found; the keys are not distinct hashes")


def _peel(at: np.ndarray, slots: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Layers of (keys, column of the slot that only the key uses), or None if a core is left."""
    n = len(at)
    uses = np.bincount(at.ravel(), minlength=slots)
    owner = np.zeros(slots, np.int64)  # xor of the keys that use a slot
    for i in range(3):
        np.bitwise_xor.at(owner, at[:, i], np.arange(n))
    layers, done = [], 0
    while done < n:
        alone = np.flatnonzero(uses == 1)
        if not len(alone):
            return None
        key, pick = np.unique(owner[alone], return_index=True)
        column = (at[key] == alone[pick][:, None]).argmax(axis=1)
        layers.append((key, column))
        done += len(key)
        for i in range(3):
            np.subtract.at(uses, at[key, i], 1)
            np.bitwise_xor.at(owner, at[key, i], key)
    return layers


def contains(seed: int, blob: bytes, keys: np.ndarray) -> np.ndarray:
    """False only for keys that are surely not in the filter."""
    length = int.from_bytes(blob[:4], "little")
    table = np.frombuffer(blob, np.uint8, offset=4)
    at, prints = _slots(keys.astype(np.uint64), seed, length, len(table) // length)
    return table[at[:, 0]] ^ table[at[:, 1]] ^ table[at[:, 2]] == prints
