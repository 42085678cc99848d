"""Near-duplicate documents, lines and vectors against brute force, and odd inputs."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from reachspark.llm.components import ONE_TASK_EDGES, connected_components
from reachspark.llm.embedding_forest import link_embeddings
from reachspark.llm import textkernel as K
from reachspark.llm.line_dedup import BANDS, ROWS, dedup_lines
from reachspark.llm.minhash_dedup import keep_first, near_duplicates
from reachspark.llm.neardup import stop_rule

SMALL = "/root/testdata/sf0.001"


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def roots(n, links):
    p = list(range(n))

    def f(x):
        while p[x] != x:
            x = p[x]
        return x

    for a, b in links:
        a, b = f(a), f(b)
        p[max(a, b)] = min(a, b)
    return [f(x) for x in range(n)]


def linked(sets, percent=80):
    return [(i, j) for i, a in enumerate(sets) for j in range(i) if (b := sets[j]) and a and 100 * len(a & b) >= percent * len(a | b)]


def word_sets(texts, k):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def near_table(spark, seed=1):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    docs = []
    base = [r.choice(words) for _ in range(120)]
    for _ in range(60):  # a group of near copies, and some that stray
        t = list(base)
        for _ in range(r.choice([0, 2, 5, 9, 14])):
            t[r.randrange(len(t))] = r.choice(words)
        docs.append(" ".join(t))
    docs += [" ".join(r.choice(words) for _ in range(r.randrange(1, 60))) for _ in range(40)]
    docs += ["One", "one", "Two words", "two  words", "", None, " \t\n", docs[0], docs[0].upper().lower(), "é " * 30, "long " * 20000]
    return [(i, t, i % 3) for i, t in enumerate(docs)]


def test_documents(spark):
    rows = near_table(spark)
    df = spark.createDataFrame(rows, "doc_id long, text string, sid int").repartition(5)
    for k in (2, 5):
        got = {r.doc_id: r for r in near_duplicates(df, words=k).collect()}
        sets = word_sets([t for _, t, _ in rows], k)
        want = roots(len(rows), linked(sets))
        assert [got[i].component_id for i in range(len(rows))] == want
        assert all(got[i].n_shingles == len(sets[i]) and got[i].kept == (want[i] == i) for i in range(len(rows)))


def test_documents_keep_and_odd_rows(spark):
    odd = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "x y z"), (None, None), (3, None), (None, "q r s t"), (None, "q r s t")]
    df = spark.createDataFrame([(i, t, "c") for i, t in odd], "doc_id long, text string, root string")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert len(got) == len(odd) and (True, 0, 2, 1, False) in got and (False, 3, 0, 3, True) in got
    left = keep_first(df.select("doc_id", "text", "root"))
    assert left.columns == ["doc_id", "text", "root"]
    assert sorted(r.text or "" for r in left.where("doc_id is not null").collect()) == ["", "a b c d e f", "x y z"]
    assert near_duplicates(df.limit(0)).count() == 0 and keep_first(df.limit(0)).count() == 0


def test_lines(spark):
    r = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "omega", "kappa"] + [f"x{i}" for i in range(300)]
    lines = [" ".join(r.choice(words) for _ in range(r.randrange(1, 40))) for _ in range(60)]
    docs = []
    for i in range(40):
        own = []
        for _ in range(r.randrange(0, 8)):
            s = list(r.choice(lines))
            for _ in range(r.choice([0, 0, 1, 3])):
                s[r.randrange(len(s))] = r.choice("abcxyz ")
            own.append("".join(s) + r.choice(["", " ", "\r"]))
        docs.append((i, "\n".join(own), "src"))
    docs += [(100, None, "a"), (101, "", "a"), (102, "\n\n", "a"), (103, "ab", "a"), (104, "AB ", "a"), (5, docs[5][1], "src"), (None, docs[6][1], "b")]
    df = spark.createDataFrame(docs, "doc_id long, text string, gone string").repartition(4)
    got = {(x.row.doc_id, x.row.gone, i): x for i, x in enumerate(dedup_lines(df).collect())}
    assert len(got) == len(docs)
    clean = lambda s: lower(s).strip(" \t\n\r\x0b\x0c")
    order = sorted(set(docs[:-2] + [docs[-1]]), key=lambda d: (d[0] is None, d[0] or 0))
    occ = [(d, n, clean(s)) for d in order for n, s in enumerate((d[1] or "").split("\n"))]
    names = list(dict.fromkeys(s for _, _, s in occ if s))
    comp = roots(len(names), linked([{s[i : i + 5] for i in range(max(1, len(s) - 4))} for s in names]))
    at, seen, keep = {s: comp[i] for i, s in enumerate(names)}, set(), {}
    for d, n, s in occ:
        if s and at[s] in seen:
            continue
        if s:
            seen.add(at[s])
        keep.setdefault(d, []).append(n)
    for (doc, gone, _), x in got.items():
        d = next(d for d in order if d[0] == doc and d[2] == gone)
        want = None if d[1] is None else "\n".join(d[1].split("\n")[n] for n in keep.get(d, []))
        assert x.clean == want, (doc, x.clean, want)
    assert dedup_lines(df.limit(0)).count() == 0


def test_line_bands_find_pairs_at_the_threshold():
    n, k = 40_000, BANDS * ROWS  # of 45 shingles on either side 40 are common: similarity 0.8
    rng = np.random.default_rng(11)
    x = rng.integers(0, 1 << 63, (n, 50), dtype=np.int64).view(np.uint64)
    bound = np.arange(n + 1) * 45
    keys = [K.band_keys(K.signatures(np.ascontiguousarray(part).ravel(), bound, k), BANDS, ROWS) for part in (x[:, :45], x[:, 5:])]
    missed = n - int((keys[0] == keys[1]).any(1).sum())
    assert (1 - 0.8**ROWS) ** BANDS < 1 / 4700 and missed < 20, missed


def test_repetitive_lines_of_unequal_length(spark):
    docs = [(1, "-" * 60), (2, "-" * 100), (3, "ab" * 30 + "\n" + "xyz" * 20), (4, "ab" * 200), (5, "xyz" * 50), (6, "=" * 100)]
    got = {r.row.doc_id: (r.clean, r.n_kept) for r in dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: ("-" * 60, 1), 2: ("", 0), 3: (docs[2][1], 2), 4: ("", 0), 5: ("", 0), 6: ("=" * 100, 1)}


def vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((150, 16))
    rows = [(i, (base[i % 150] + (0.05 if i >= 150 else 0) * rng.standard_normal(16)).tolist(), int(i % 150) % 3) for i in range(400)]
    rows += [(400 + i, rows[0][1], rows[0][2]) for i in range(5)]
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [None] * 16, 0), (504, rows[0][1], None), (505, [], 0), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0), (508, [x * 1e-200 for x in rows[0][1]], rows[0][2])]
    return rows


def test_embeddings(spark):
    rows = vectors(spark)
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, root string").repartition(4)
    got = {r.vec_id: r for r in link_embeddings(df, leaf=32).collect()}
    ok = [r for r in rows if r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    links = []
    for i, a in enumerate(ok):
        for j, b in enumerate(ok[:i]):
            if a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = np.array(a[1]) / max(map(abs, a[1])), np.array(b[1]) / max(map(abs, b[1]))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links.append((i, j))
    n = [0] * len(ok)
    for i, j in links:
        n[i] += 1
        n[j] += 1
    want = roots(len(ok), links)
    assert [got[r[0]].n_links for r in ok] == n and [got[r[0]].component_id for r in ok] == [ok[w][0] for w in want]
    assert all(got[r[0]].n_links == 0 and got[r[0]].component_id == r[0] and got[r[0]].kept for r in rows if r not in ok)
    assert link_embeddings(df.limit(0)).count() == 0


def test_components_both_ways(spark, monkeypatch):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 40)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    one = {(x.node, x.root) for x in connected_components(df).collect()}
    monkeypatch.setattr("reachspark.llm.components.ONE_TASK_EDGES", 0)
    assert one == {(x.node, x.root) for x in connected_components(df).collect()} and ONE_TASK_EDGES > 0
    names = sorted({v for e in edges if e[0] is not None and e[0] != e[1] for v in e})
    want = roots(len(names), [(names.index(a), names.index(b)) for a, b in edges if a is not None and a != b])
    assert one == {(names[i], names[w]) for i, w in enumerate(want)}


def test_stop_rule():
    rule = stop_rule(140, 20, 80, 1e-5)
    assert rule[-1][0] == 140 and all(a < b for (_, a), (_, b) in zip(rule, rule[1:])) and rule[-1][1] / 140 < 0.8


def test_fixture_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, words=2).collect()}
    want = roots(len(rows), linked(word_sets([r.text for r in rows], 2)))
    assert [got[r.doc_id] for r in rows] == [rows[w].doc_id for w in want]
    assert docs.select(F.count("*")).first()[0] == len(got)
