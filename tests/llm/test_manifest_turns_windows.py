"""Merkle manifests, conversation repair and substring dedup against brute force, on odd rows and with every switch of size."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reachspark.llm import merkle_manifest, superkmers, turn_repair
from reachspark.llm.merkle_manifest import authenticate, block_root, height, lower_cased, paths, verify
from reachspark.llm.superkmers import dedup_windows, super_kmers
from reachspark.llm.turn_repair import damaged, repair

H = lambda s: hashlib.sha256(s.encode()).hexdigest()
DOCS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, path int, `size` int, claim string"


def leaf_of(r, text=None):
    values = [r[0], r[1], r[2], r[3], r[4] if text is None else text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def way(levels, i):
    """(before, after) of a node at each level of a tree."""
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 16 * 16 : i // 16 * 16 + 16]
        out.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        i //= 16
    return out


def manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r[0] is not None, r[0] or 0, leaf_of(r), r))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    out = []
    for n, s in enumerate(order):
        for i, (_, _, leaf, r) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = way(trees[s], i) + way(top, n)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            h = leaf_of(r, re.sub("[A-Z]", lambda m: m[0].lower(), r[4])) if hit and r[4] is not None else leaf
            for a, b in path:
                h = H(a + h + b)
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in path)), h, h == top[-1][0]))
    return sorted(map(repr, out))


def odd_documents(seed=3):
    r = random.Random(seed)
    rows = [(i, "hot", "en", i, f"Text Number {i}") for i in range(700)]  # more than half in one source, in several levels
    rows += [(i, f"s{i % 20}", None if i % 3 else "de", None, "A" * (i % 7)) for i in range(1000, 1100)]
    rows += [(None, "hot", None, None, None), (5, None, None, None, None), (6, "", "é", 1, ""), (7, "lone", "x", 1, "Y"), (7, "hot", "en", 7, "Text Number 7"), (7, "hot", "en", 7, "Text Number 7"), (7, "hot", "en", 7, "other"), (8, "é", "x", -1, "long " * 30000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_manifest(spark, depth):
    rows = odd_documents()
    df = spark.createDataFrame([(*r, "clash", 1, 2, "c") for r in rows], DOCS).repartition(5)
    got = verify(df, lower_cased(df), depth).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    assert sorted(repr(tuple(x)) for x in got) == manifest(rows)


def test_manifest_of_few_rows(spark):
    one = spark.createDataFrame([(1, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    r = authenticate(one).collect()
    assert [(x.leaf == x.subroot == x.root == leaf_of((1, None, None, None, None)), x.path) for x in r] == [(True, [])]
    assert authenticate(one.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 4095, 4096])
def test_traversal_of_a_block(n):
    leaves = [H(str(i)) for i in range(n)]
    levels = levels_of(leaves)
    assert height(n) == len(levels) - 1 and block_root(leaves, height(n)) == levels[-1][0]
    assert list(paths(leaves, height(n))) == [way(levels, i) for i in range(n)]


def test_traversal_holds_little():
    """At no leaf do the growing subtrees hold more than a run's nodes of a level and fifteen of each below."""
    seen, add = [], merkle_manifest.Growing.add
    try:
        merkle_manifest.Growing.add = lambda self, x: (add(self, x), seen.append(len(self.nodes) + sum(map(len, self.open))))[0]
        list(paths([H(str(i)) for i in range(4096)], 3))
    finally:
        merkle_manifest.Growing.add = add
    assert max(seen) <= 16 + 15 * 2


# conversations


def plain_repair(rows):
    """Of rows (role, text) in order: (blank, duplicate, truncated), cost and audit by trying all edits of each row and up to two inserts anywhere."""
    faults, seen = [], set()
    for role, text in rows:
        faults.append("b" if not text.strip(" \t\n\v\f\r") else "d" if (role, text) in seen else "t" if text.rstrip(" \t\n\v\f\r")[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for edits in product("KRD", repeat=len(rows)):
        for inserts in product(("", "I", "II"), repeat=len(rows) + 1):
            cost, audit, out, need = 0, "", [], None
            for k in range(len(rows) + 1):
                for _ in inserts[k]:
                    cost, audit = cost + 2, audit + "I"
                    out.append(None)
                if k < len(rows):
                    e = edits[k]
                    audit += e
                    cost += {"K": 0, "R": 2, "D": 3}[e] + (e != "D" and faults[k] == "t")
                    need = need or (e != "D" and faults[k] in ("b", "d"))
                    if e != "D":
                        out.append(rows[k][0][:1] or "-" if e == "K" else None)
            if need:
                continue
            for start in (0, 1):  # with or without a system turn in front
                if start and (not out or out[0] != "s"):
                    continue
                rest = out[start:]
                if all(x is None or x == "ua"[i % 2] for i, x in enumerate(rest)) and len(rest) % 2 == 0 and (rest or not start):
                    best = min(best or (10**9, ""), (cost, audit))
    return [faults.count(x) for x in "bdt"], best


def test_repair_is_the_cheapest(spark):
    r = random.Random(5)
    rows, want = [], {}
    for conv in range(60):
        turns = [(r.choice(["system", "user", "assistant", "user", "assistant", "tool", ""]), r.choice(["Yes.", "No", "", "Good!", "A b c", " "])) for _ in range(r.randrange(0, 4))]
        rows += [(conv, k, role, text, False) for k, (role, text) in enumerate(turns)] + [(conv, 50, "user", "x", True)]
        want[conv] = plain_repair(turns)
    got = repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, gone boolean")).collect()
    assert {g.conv_id: ([g.blank, g.duplicate, g.truncated], (g.cost, g.audit)) for g in got} == want


def test_repair_goes_on_over_slices(spark):
    """Long conversations, cut into slices of rows, give what they give uncut."""
    r = random.Random(6)
    rows = [(c, k, r.choice(["system", "user", "assistant", "user", "assistant"]), r.choice(["One.", "Two", "", f"{k}."])) for c, n in enumerate([1, 700, 3, 40, 0, 1300]) for k in range(n)] + [(None, None, None, None), (None, 3, "user", None), (9, None, "user", "Hm."), (9, None, "user", "Hm.")]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "conv_id long, turn long, role string, text string, gone string, fault int").repartition(3)
    whole = sorted(map(repr, repair(damaged(df)).collect()))
    assert len(whole) == len({x[0] for x in rows})
    assert sorted(map(repr, repair(damaged(df), 64, 7).collect())) == whole
    assert repair(damaged(df.where("false"))).count() == 0


def test_repaired_text_is_the_audits():
    rows = [("system", "Be."), ("assistant", "a"), ("user", "u"), ("user", "u"), ("assistant", "b")]
    got = list(turn_repair.repaired(0, "KIKKDKI", rows))
    assert got == [("system", "Be."), ("user", ""), ("assistant", "a"), ("user", "u"), ("assistant", "b"), ("user", "")]


# windows


def plain_windows(rows, window):
    first = {}
    for i, t in sorted((x for x in rows if x[0] is not None), key=lambda x: x[0]):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        gone = {p for k in range(len(w) - window + 1) if i is not None and first[tuple(w[k : k + window])] < i for p in range(k, k + window)}
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return sorted(map(repr, out))


def window_rows(window, seed=7):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(300)}"
    text = lambda n: [word() for _ in range(n)]
    passage, rows = text(window + 15), []
    for i in range(120):
        t = text(r.randrange(0, 4 * window))
        if i % 2:  # a passage that half of all rows share, each time with other words around it
            k = r.randrange(len(t) + 1)
            t[k:k] = passage[r.randrange(3) : len(passage) - r.randrange(3)]
        rows.append((i + 10, r.choice([" ", "\n", " \t "]).join(t)))
    rows += [(3, rows[5][1]), (400, rows[5][1]), (401, rows[5][1].upper()), (402, rows[5][1].replace(" ", "\n\n")), (402, "x y z"), (402, rows[6][1]), (5, rows[6][1]), (5, rows[6][1]), (None, rows[5][1]), (None, None), (500, None), (501, ""), (502, " \n"), (503, "é " * (window - 1)), (504, "é " * window), (505, " ".join(["ab"] * 40 * window)), (506, " ".join(["ab"] * 3 * window)), (507, " ".join(passage * 60))]
    return rows


@pytest.mark.parametrize("crowded", [10**6, 2])
def test_windows(spark, monkeypatch, crowded):
    monkeypatch.setattr(superkmers, "CROWDED", crowded)
    rows = window_rows(20)
    df = spark.createDataFrame([(*x, "c", 1, 2) for x in rows], "doc_id long, text string, packed string, may int, spans int").repartition(4)
    got = dedup_windows(df, window=20, seed=6).select("row.doc_id", "n_words", "n_removed", "kept", "row.spans").collect()
    assert sorted(repr(tuple(x[:4])) for x in got) == plain_windows(rows, 20) and {x.spans for x in got} == {2}
    assert dedup_windows(df.where("false")).count() == 0


def test_equal_windows_have_equal_minimisers():
    from reachspark.llm import textkernel as K

    texts = [t for _, t in window_rows(50) if t]
    data, off = K.raw(pa.array(texts))
    h, _, at = K.words(data, off, 0, len(texts), lower=False)
    of, by = {}, set()
    for t, s, n, m in zip(*(x.tolist() for x in super_kmers(h, at, 50, 12))):
        w = texts[t].split()
        assert n <= superkmers.LONGEST
        for k in range(s, s + n):
            assert (t, k) not in by
            by.add((t, k))
            assert of.setdefault(tuple(w[k : k + 50]), m) == m
    assert by == {(t, k) for t, x in enumerate(texts) for k in range(len(x.split()) - 49)}


def test_crowded_buckets_spread(spark, monkeypatch):
    """A passage in every document makes one bucket of all: its windows are dealt out by their words, and no task gets more than a share."""
    monkeypatch.setattr(superkmers, "CROWDED", 8)
    rows = window_rows(20)
    strings = spark.createDataFrame([(1, k, 0, " ".join(t.split()[:40]), i, i) for k, (i, t) in enumerate(rows) if i is not None and t and len(t.split()) >= 40], "mini long, sid long, sid2 long, packed string, least long, most long")
    keyed = strings.mapInArrow(superkmers._windows(20), "key binary, mini long, sid long, sid2 long, w int, least long, most long").repartition(8, "key")
    share = [x["count"] for x in keyed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(share) == 8 and max(share) < 2.5 * sum(share) / 8
