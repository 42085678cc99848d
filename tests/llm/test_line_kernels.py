"""Kernels that line dedup spends its time in, against plain ones."""

import random

import numpy as np
import pyarrow as pa

from reachspark.llm import neardup as N
from reachspark.llm import textkernel as K


def joined(texts):
    data, off = K.raw(pa.array(texts))
    return K.characters(data[off[0] : off[-1]], off - off[0])


def test_runs_of_characters_hash_alike_in_every_encoding():
    texts = ["plain words here", "größe und maß", "ab中cdefgh", "größe und maß中"]
    own = []
    for t in texts:
        cp, bound = joined([t])
        assert bound.tolist() == [0, len(t)]
        h = K.run_hashes(cp, 5)
        own.append(h)
        assert len(np.unique(h)) == len({t[i : i + 5] for i in range(len(t) - 4)})
    assert np.array_equal(own[1], own[3][:-1])  # bytes and wide characters
    cp, bound = joined(texts)
    flat, b = K.within(K.run_hashes(cp, 5), bound, 5)
    assert np.array_equal(flat, np.concatenate(own)) and np.diff(b).tolist() == [len(t) - 4 for t in texts]


def test_bins_of_runs_are_those_of_single_texts():
    r = random.Random(5)
    texts = ["".join(r.choice("abcdé ") for _ in range(r.randrange(70, 400))) for _ in range(40)]
    cp, bound = joined(texts)
    h = K.run_hashes(cp, 5)
    for got, want in zip(K.one_permutation_of_runs(h, bound, 5, 252), K.one_permutation(*K.within(h, bound, 5), 252)):
        assert np.array_equal(got, want)


def test_pairs_are_judged_exactly_and_unlike_ones_by_their_marks():
    r = random.Random(7)
    texts = ["".join(r.choice("abcdefgh é") for _ in range(300)) for _ in range(60)] + ["", "abc", "abd", "abcde"]
    for i in range(60):
        s = list(texts[i])
        for _ in range(r.randrange(0, 14)):
            s[r.randrange(300)] = "x"
        texts.append("".join(s))
    x, y = (v.ravel() for v in np.meshgrid(np.arange(len(texts)), np.arange(len(texts))))
    sets = [{t[i : i + 5] for i in range(max(1, len(t) - 4))} if t else set() for t in texts]
    shingles, made = K.Shingles("chars", 5), []
    judge = shingles.alike(pa.array(texts), x, y, 80)
    for k, (i, j) in enumerate(zip(x.tolist(), y.tolist())):
        a, b = sets[i], sets[j]
        assert judge(k) == (100 * len(a & b) >= 80 * len(a | b)), (texts[i], texts[j])
        made.append(judge(k))
    assert 100 < sum(made) < len(made) / 10


def test_buckets_are_the_same_in_every_round():
    rng = np.random.default_rng(3)
    key = rng.integers(0, 1 << 63, 50_000, dtype=np.int64).view(np.uint64) * np.uint64(2)
    key[:3] = 0, (1 << 64) - 1, 1 << 63
    for shards in (4, 204, 844, 5000):
        ids = np.sort(N.bucket_ids(key, shards))
        cut = np.searchsorted(np.sort(key) >> np.uint64(32), N.shard_bounds(shards))
        assert cut[0] == 0 and cut[-1] == len(key)
        assert np.array_equal(np.bincount((ids >> np.uint64(32)).astype(np.int64), minlength=shards), np.diff(cut))
        # a task tells keys apart by at least as many bits as a bucket has
        fine, who, first, lead = N.grouped(key, np.arange(len(key)))
        assert len(np.unique(fine)) == first.sum() and np.array_equal(N.bucket_ids(fine, shards), N.bucket_ids(key, shards)[who])
