"""Vectorised text kernels over Arrow string columns: words, shingles, hashes and MinHash signatures.

All work on UTF-8 bytes in chunks of a few MB; one text is never cut, however long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
U64 = np.uint64
_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_COMB = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_MINA = _rng.integers(1, 1 << 31, 1024, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_MINB = _rng.integers(0, 1 << 32, 1024, dtype=np.uint32)
_probe: dict[int, np.ndarray] = {}
_pow = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}

#: Word bytes for the pattern [^\x20\x09-\x0D]+, and for [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
SPACED = np.array([b not in b"\x20\x09\x0a\x0b\x0c\x0d" for b in range(256)])
ALNUM = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> U64(33))
        x *= U64(0xFF51AFD7ED558CCD)
        x ^= x >> U64(33)
        x *= U64(0xC4CEB9FE1A85EC53)
        x ^= x >> U64(33)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow["p"]) < n:
        m = max(n, CHUNK)
        for key, base in (("p", _BASE), ("i", pow(_BASE, -1, 1 << 64))):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            with np.errstate(over="ignore"):
                _pow[key] = np.cumprod(a, dtype=np.uint64)
    return _pow["p"], _pow["i"]


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and absolute offsets of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    buf = col.buffers()[2]
    return (np.frombuffer(buf, np.uint8) if buf is not None and buf.size else np.zeros(0, np.uint8)), off


def chunks(off: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most so many bytes, or of one longer text."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, off: np.ndarray, i: int, j: int, table: np.ndarray = SPACED, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts i to j-1: 64-bit hash of every word (A-Z as a-z, if lower), start of each word in bytes
    after off[i], and where each text's words begin (j-i+1 positions)."""
    lo, hi = int(off[i]), int(off[j])
    d = data[lo:hi]
    n = hi - lo
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(j - i + 1, np.int64)
    inside = table[d]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = (off[i:j] - lo)[(off[i:j] < hi)]
    first[edge] = inside[edge]
    s = np.flatnonzero(first)
    at = np.searchsorted(s, off[i : j + 1] - lo)
    if not len(s):
        return np.zeros(0, np.uint64), s, at
    p, inv = powers(n)
    value = np.where(table, _BYTE[_LOWER] if lower else _BYTE, U64(0))
    with np.errstate(over="ignore"):
        h = np.add.reduceat(value[d] * p[:n], s) * inv[s]
    return mix(h), s, at


def grams(h: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-item shingles of each text and the bounds of each text's; a text with
    1 to k-1 items has its whole sequence as the one shingle, one without items has none."""
    count = np.diff(at)
    made = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    bound = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(bound[-1], np.uint64)
    with np.errstate(over="ignore"):
        if len(h) >= k:
            roll = h[: len(h) - k + 1] * _COMB[0]
            for t in range(1, k):
                roll += h[t : len(h) - k + 1 + t] * _COMB[t]
            ok = np.zeros(len(h) + 1, np.int64)  # marks starts that stay within their text
            full = count >= k
            np.add.at(ok, at[:-1][full], 1)
            np.add.at(ok, at[1:][full] - k + 1, -1)
            keep = np.cumsum(ok)[: len(roll)] > 0
            target = np.zeros(bound[-1] + 1, np.int64)
            np.add.at(target, bound[:-1][full], 1)
            np.add.at(target, bound[1:][full], -1)
            out[np.cumsum(target)[:-1] > 0] = roll[keep]
        for m in range(1, k):
            few = np.flatnonzero(count == m)
            if len(few):
                v = np.full(len(few), _COMB[40 + m], np.uint64)
                for t in range(m):
                    v += h[at[few] + t] * _COMB[20 + t]
                out[bound[few]] = v
    return mix(out), bound


def unique_sets(g: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and their bounds."""
    g = g.copy()
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
        g[a:b].sort()
    keep = np.ones(len(g), bool)
    keep[1:] = g[1:] != g[:-1]
    start = bound[:-1][bound[:-1] < bound[1:]]
    keep[start] = True
    return g[keep], np.concatenate([[0], np.cumsum(keep)])[bound]


def take_sets(x: np.ndarray, bound: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The given sets alone, and their bounds."""
    size = bound[rows + 1] - bound[rows]
    out = np.concatenate([[0], np.cumsum(size)])
    return x[np.repeat(bound[rows] - out[:-1], size) + np.arange(out[-1])], out


def set_ids(u: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """A 64-bit id of each set."""
    total = np.zeros(len(u) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mix(u ^ U64(0xA5A5A5A55A5A5A5A)), out=total[1:], dtype=np.uint64)
        return mix(total[bound[1:]] - total[bound[:-1]] + np.diff(bound).astype(np.uint64))


def signatures(x: np.ndarray, bound: np.ndarray, k: int) -> np.ndarray:
    """k MinHash values of each set, their low bytes; a row of zeros for an empty one. Repeats in x do no harm."""
    n = len(bound) - 1
    out = np.zeros((n, k), np.uint8)
    some = np.flatnonzero(bound[1:] > bound[:-1])
    if not len(some):
        return out
    v = (x >> U64(32)).astype(np.uint32)
    block = 1 << 16  # so that a block stays in cache
    i = 0
    while i < len(some):
        a = bound[some[i]]
        j = max(i + 1, int(np.searchsorted(bound[some + 1], a + block, side="right")))
        rows = some[i:j]
        part, start = v[a : bound[rows[-1] + 1]], bound[rows] - a
        for q in range(k):
            out[rows, q] = np.minimum.reduceat((part ^ _MINB[q]) * _MINA[q], start).astype(np.uint8)
        i = j
    return out


def one_permutation(x: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """k MinHash values (low bytes) of each set by one hash, and how many of its bins are filled: the hash's low bits choose one of k bins, each bin keeps its least value.

    An empty bin takes the value of another bin of its set, the first filled one in a sequence that
    depends on the bin alone (optimal densification), so two sets agree in a place as often as their similarity.
    Work for each item doesn't depend on k. Repeats in x do no harm; rows of zeros for empty sets."""
    n = len(bound) - 1
    spot = (((x & U64(0xFFFFFFFF)) * U64(k)) >> U64(32)).astype(np.int64)
    spot += np.repeat(np.arange(n) * k, np.diff(bound))
    return _densified((x >> U64(32)).astype(np.uint32), spot, n, k)


def characters(flat: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of joined UTF-8 texts, as bytes where all are below 256, and the texts' bounds in characters."""
    if not len(flat) or int(flat.max()) < 128:
        return flat, bound
    more = np.flatnonzero((flat & 0xC0) == 0x80)  # bytes that begin no character
    text = flat.tobytes().decode("utf-8", "replace")
    try:
        cp = np.frombuffer(text.encode("latin-1"), np.uint8)
    except UnicodeEncodeError:
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return cp, bound - np.searchsorted(more, bound)


def run_hashes(cp: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k characters from each place on, whatever the type of cp; runs of up to 8 characters below 256 never collide."""
    n = max(0, len(cp) - k + 1)
    with np.errstate(over="ignore"):
        if k > 8:
            h = mix(cp.astype(np.uint64) + U64(_BASE))
            v = h[:n] * _COMB[0]
            for t in range(1, k):
                v += h[t : t + n] * _COMB[t % 64]
        elif cp.dtype == np.uint8:
            eight = np.zeros(n + 8 + k, np.uint8)
            eight[: len(cp)] = cp
            v = np.ndarray((n,), "<u8", eight, 0, (1,)) & U64((1 << 8 * k) - 1)
        else:
            c = cp.astype(np.uint64)
            wide = np.flatnonzero(cp > 255)
            c[wide] = mix(c[wide] + U64(_BASE))
            v = c[:n].copy()
            for t in range(1, k):
                v += c[t : t + n] << U64(8 * t)
        # a finalizer as mix(), in place
        v *= U64(0xFF51AFD7ED558CCD)
        v ^= v >> U64(32)
        v *= U64(0xC4CEB9FE1A85EC53)
        v ^= v >> U64(29)
    return v


def _across(bound: np.ndarray, k: int, n: int) -> np.ndarray:
    """Of n runs of k characters of joined texts, those that go on into the next text."""
    at = (bound[1:-1, None] - np.arange(1, k)).ravel()
    return at[(at >= np.repeat(bound[:-2], k - 1)) & (at < n)]


def within(h: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the hashes of all runs of joined texts of k characters or more those that lie in one text, and their bounds."""
    keep = np.ones(len(h), bool)
    keep[_across(bound, k, len(h))] = False
    return h[keep], np.concatenate([[0], np.cumsum(np.diff(bound) - k + 1)])


def one_permutation_of_runs(h: np.ndarray, bound: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """As one_permutation(*within(h, bound, k), width), for texts of k characters or more."""
    value = (h >> U64(32)).astype(np.uint32)
    value[_across(bound, k, len(h))] = 0xFFFFFFFF  # counts in no bin
    spot = h & U64(0xFFFFFFFF)
    spot *= U64(width)
    spot >>= U64(32)
    spot = spot.view(np.int64)
    spot += np.repeat(np.arange(len(bound) - 1) * width, np.diff(bound))[: len(h)]
    return _densified(value, spot, len(bound) - 1, width)


def _densified(value: np.ndarray, spot: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of n sets by k bins, and how many bins are filled, from values and their bins."""
    if k not in _probe:
        _probe[k] = np.ascontiguousarray(np.random.default_rng(k).integers(0, k, (k, 256)).astype(np.int32).T)
    probe, none = _probe[k], np.uint32(0xFFFFFFFF)
    least = np.full(n * k, none, np.uint32)
    np.minimum.at(least, spot, value)
    least = least.reshape(n, k)
    empty = least == none
    filled = k - np.count_nonzero(empty, axis=1)
    full = least.copy()
    for donor in probe[:3]:  # most are filled by the first donors: whole columns at a time
        np.copyto(full, np.take(least, donor, axis=1), where=full == none)
    at = np.flatnonzero((full == none) & (filled > 0)[:, None])
    row = at // k
    c = at - row * k
    row *= k
    for donor in probe[3:]:
        if not len(at):
            break
        v = least.ravel()[row + donor[c]]
        full.ravel()[at] = v
        left = np.flatnonzero(v == none)
        at, c, row = at[left], c[left], row[left]
    if len(at):  # after so many misses: the least value of the whole set
        full.ravel()[at] = least.min(1)[row // k]
    # the place is part of the value: a donor's other borrowers are not the same place
    lent = full * np.uint32(2654435769) + np.arange(k, dtype=np.uint32) * np.uint32(37) >> np.uint32(7)
    out = np.where(empty, lent, least).astype(np.uint8)
    out[filled == 0, :] = 0
    return out, filled


def bloom(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each 64-bit id in a filter of 2^bits bits."""
    h = mix(x ^ U64(0x1234ABCD))
    return (h >> U64(64 - bits)).astype(np.int64), (h & U64((1 << bits) - 1)).astype(np.int64)


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each signature and band."""
    kind = sig[:, bands * rows :].sum(1, dtype=np.uint64)[:, None]  # signatures of different kinds share no key
    v = sig[:, : bands * rows].reshape(len(sig), bands, rows)
    if rows <= 8:
        eight = np.zeros((len(sig), bands, 8), np.uint8)
        eight[:, :, :rows] = v
        key = eight.reshape(len(sig), 8 * bands).view("<u8")
    else:
        key = np.zeros((len(sig), bands), np.uint64)
        for r in range(rows):
            key |= v[:, :, r].astype(np.uint64) << U64(8 * r)
    with np.errstate(over="ignore"):
        return mix(mix(key) + (np.arange(1, bands + 1, dtype=np.uint64) + kind * U64(1000)) * U64(_BASE))


def line_spans(d: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every line (split at line feeds) of texts with offsets off into d, and where each text's begin."""
    cut = np.flatnonzero(d == 10)
    starts = np.concatenate([off[:-1], cut + 1])
    ends = np.concatenate([off[1:], cut])
    # a text's first start is its offset; its last end is the next offset
    starts, ends = np.sort(starts, kind="stable"), np.sort(ends, kind="stable")
    n_lines = np.searchsorted(cut, off[1:]) - np.searchsorted(cut, off[:-1]) + 1
    return starts, ends, np.concatenate([[0], np.cumsum(n_lines)])


def char_grams(texts: bytes, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of k characters of each UTF-8 text lying between two consecutive bounds; shorter ones give one."""
    cp, bound = characters(np.frombuffer(texts, np.uint8), bounds)
    count = np.diff(bound)
    short = np.flatnonzero(count < k)
    if not len(short):
        return within(run_hashes(cp, k), bound, k)
    made = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    is_long = count >= k
    out = np.empty(int(made.sum()), np.uint64)
    where = np.repeat(is_long, made)
    long = cp[np.repeat(is_long, count)]
    out[where] = within(run_hashes(long, k), np.concatenate([[0], np.cumsum(count[is_long])]), k)[0]
    with np.errstate(over="ignore"):
        h = mix(cp[np.repeat(~is_long, count)].astype(np.uint64) + U64(_BASE))
    out[~where] = grams(h, np.concatenate([[0], np.cumsum(count[short])]), k)[0]
    return out, np.concatenate([[0], np.cumsum(made)])


def binary(m: np.ndarray) -> pa.Array:
    """Rows of a uint8 matrix as a binary column."""
    m = np.ascontiguousarray(m)
    off = np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(m), [None, pa.py_buffer(off), pa.py_buffer(m)])


def matrix(col: pa.Array, width: int) -> np.ndarray:
    """A binary column of equal widths as a uint8 matrix."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not len(col):
        return np.zeros((0, width), np.uint8)
    col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], np.uint8)[off[0] : off[-1]].reshape(len(col), width)


def longs(x: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


class Shingles:
    """Sets of shingles of k words (pattern [^\\x20\\x09-\\x0D]+, A-Z lowered) or k characters (trimmed, A-Z lowered)."""

    def __init__(self, kind: str, k: int):
        self.kind, self.k = kind, k

    def loose(self, data: np.ndarray, off: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the shingles of texts i to j-1, with repeats, and their bounds."""
        if self.kind == "words":
            h, _, at = words(data, off, i, j)
            return grams(h, at, self.k)
        low = _LOWER.astype(np.uint8)[data[off[i] : off[j]]]
        return char_grams(low.tobytes(), off[i : j + 1] - off[i], self.k)

    def sets(self, data: np.ndarray, off: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        return unique_sets(*self.loose(data, off, i, j))

    def alike(self, col: pa.Array, x: np.ndarray, y: np.ndarray, percent: int) -> Callable[[int], bool]:
        """Whether the texts in rows x[r] and y[r] of col have sets with a similarity of at least percent/100: a function of r. Exact.

        Each set's hashes are marked in a short row of bits. A bit that one of two rows has alone is a shingle of one set alone: most pairs that are
        unlike have too many of them, and their sets are never made."""
        data, off = raw(col)
        bits = 1 << min(13, max(8, (4 * (int(off[-1] - off[0]) // max(len(col), 1) + 1)).bit_length()))
        loose: list[np.ndarray] = []
        marks = np.zeros((len(col), bits // 64), np.uint64)
        for i, j in chunks(off):
            g, b = self.loose(data, off, i, j)
            loose += [g[s:e] for s, e in zip(b[:-1].tolist(), b[1:].tolist())]
            for r in range(i, j, 256):
                q = min(r + 256, j)
                lo, hi = b[r - i], b[q - i]
                spot = (g[lo:hi] >> U64(65 - bits.bit_length())).view(np.int64) + np.repeat(np.arange(q - r) * bits, np.diff(b[r - i : q - i + 1]))
                flags = np.zeros((q - r) * bits, np.uint8)
                flags[spot] = 1
                marks[r:q] = np.packbits(flags.reshape(q - r, bits), axis=1).view(np.uint64)
        n = np.array([len(g) for g in loose], np.int64)
        # |A ^ B| (100 + p) <= (100 - p) (|A| + |B|) says the same as similarity >= p/100
        may = np.empty(len(x), bool)
        for s in range(0, len(x), 4096):
            e = slice(s, s + 4096)
            may[e] = np.bitwise_count(marks[x[e]] ^ marks[y[e]]).sum(1, dtype=np.int64) * (100 + percent) <= (100 - percent) * (n[x[e]] + n[y[e]])
        own: dict[int, np.ndarray] = {}

        def one(r: int) -> np.ndarray:
            if r not in own:
                v = np.sort(loose[r])
                new = np.ones(len(v), bool)
                new[1:] = v[1:] != v[:-1]
                own[r] = v[new]
            return own[r]

        def judge(r: int) -> bool:
            if not may[r]:
                return False
            u, v = one(int(x[r])), one(int(y[r]))
            if 100 * min(len(u), len(v)) < percent * max(len(u), len(v)):
                return False
            both = np.concatenate([u, v])
            both.sort()
            inter = int(np.count_nonzero(both[1:] == both[:-1]))
            return 100 * inter >= percent * (len(u) + len(v) - inter)

        return judge

    def all_sets(self, col: pa.Array) -> list[np.ndarray]:
        data, off = raw(col)
        out: list[np.ndarray] = []
        for i, j in chunks(off):
            u, b = self.sets(data, off, i, j)
            out += [u[x:y] for x, y in zip(b[:-1].tolist(), b[1:].tolist())]
        return out
