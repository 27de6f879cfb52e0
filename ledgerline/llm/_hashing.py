"""Vectorised hashes of words and word windows over whole batches of texts."""

from __future__ import annotations

import numpy as np

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose outputs look independent (the finaliser of a public splittable generator)."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(1 << 20))
_BASE = 0x5851F42D4C957F2D
_STEP = np.uint64(0xD1342543DE82EF95)
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


#: Bytes that words() takes at a time, and powers that a worker keeps.
SEGMENT, KEPT = 1 << 20, 1 << 21


def _power(kind: str, n: int) -> np.ndarray:
    """The first n powers of the base (up) or of its inverse modulo 2**64 (down)."""
    if len(_powers[kind]) < n:
        base = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        full = np.full(max(n, KEPT), base, dtype=np.uint64)
        full[0] = 1
        full = np.multiply.accumulate(full)
        if n > KEPT:
            return full
        _powers[kind] = full
    return _powers[kind][:n]


def _segments(raw: np.ndarray):
    """(from, to) of about SEGMENT bytes each, cut at white space only, so that one very long text costs little more memory than many short ones."""
    at = 0
    while at < len(raw):
        to = min(len(raw), at + SEGMENT)
        while to < len(raw):
            near = np.flatnonzero(_SPACE[raw[to : to + 4096]])
            if len(near):
                to += int(near[0])
                break
            to = min(len(raw), to + 4096)
        yield at, to
        at = to


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of maximal runs of bytes other than x20 and x09 to x0D, over all texts: hash, start, end (in the joined bytes, texts parted by one space) and the text's index."""
    joined = b" ".join([b"", *texts, b""])
    raw = np.frombuffer(joined, dtype=np.uint8)
    found = []
    for at, to in _segments(raw):
        part = raw[at : to + 1]
        space = _SPACE[part]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        begin, end = edge[0::2], edge[1::2]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * _power("up", len(part)), out=total[1:])
        found.append((mix((total[end] - total[begin]) * _power("down", len(part))[begin] + (end - begin).astype(np.uint64)), begin + at, end + at))
    hashes, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True))
    first = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return hashes, starts, ends, np.searchsorted(first, starts, side="right") - 1


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, whichever texts they are of; places with fewer than k words left have none."""
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _power("up", len(hashes)), out=total[1:])
    n = max(0, len(hashes) - k + 1)
    return mix((total[k : k + n] - total[:n]) * _power("down", n))


def shingles(hashes: np.ndarray, owner: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's windows of k words, in order, and how many each text has. A text with fewer words has one window, all of it; without words none."""
    count = np.bincount(owner, minlength=n_texts)
    short = (count > 0) & (count < k)
    first = np.concatenate(([0], np.cumsum(count)))[:-1]
    if len(hashes) >= k:
        n = len(hashes) - k + 1
        whole = owner[:n] == owner[k - 1 :]
        acc = hashes[:n].copy()
        for j in range(1, k):
            acc = acc * _STEP + hashes[j : j + n]
        windows, owners = mix(acc[whole]), owner[:n][whole]
    else:
        windows, owners = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=owner.dtype)
    if short.any():
        extra = []
        for t in np.flatnonzero(short):
            acc = hashes[first[t] : first[t] + 1].copy()
            for j in range(1, count[t]):
                acc = acc * _STEP + hashes[first[t] + j]
            extra.append(mix(acc + np.uint64(count[t]))[0])
        windows = np.concatenate((windows, np.array(extra, dtype=np.uint64)))
        owners = np.concatenate((owners, np.flatnonzero(short)))
        order = np.argsort(owners, kind="stable")
        windows, owners = windows[order], owners[order]
    return windows, np.bincount(owners, minlength=n_texts)


def text_key(text: bytes) -> tuple[int, int]:
    """128 bits of a text, as two signed 64-bit integers."""
    import xxhash

    whole = xxhash.xxh3_128_intdigest(text)
    return (whole >> 64) - (1 << 63), (whole & ((1 << 64) - 1)) - (1 << 63)
