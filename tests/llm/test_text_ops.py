"""Packing, mixing, scoring, languages, licenses, search: against brute force, round trips and held-out accuracy."""

import importlib
import math
import os
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reachspark.llm import bfd_packing, kneser_ney, queries
from reachspark.llm.exact_topk import exact_top_k
from reachspark.llm.language_id import LEAST, fit, languages
from reachspark.llm.license_scan import scan_licenses
from reachspark.llm.mixing import mix, mixed
from reachspark.llm.tokens import encoder
from reachspark.llm.vector_packing import conversation_examples, document_examples, pack

SMALL = "/root/testdata/sf0.001"
ODD = [(1, "Plain text, twice."), (1, "Plain text, twice."), (2, None), (3, ""), (None, "no id <|endoftext|> here"), (4, "naïve café    日本語 \x85\x1c x"), (5, "word " * 9000)]


def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def odd(spark):
    return spark.createDataFrame([(i, t, "ids", "en" if t else None, "s" if t else None) for i, t in ODD], "doc_id long, text string, ids string, lang string, source string")


def all_ids(text, end):
    from tokenizers import Tokenizer

    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*t.encode(text or "", add_special_tokens=False).ids, end]


def test_tokens_are_the_librarys(spark):
    for _, t in ODD:
        assert [*encoder().ids(t or ""), 0] == all_ids(t, 0)


def test_vector_packing(spark):
    df = odd(spark)
    rows = pack(document_examples(df), capacity=256, segments=3, with_ids=True).toPandas()
    by_text = defaultdict(list)
    for _, seq in rows.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert seq.offset.tolist() == [0, *np.cumsum(seq.length)[:-1]] and seq.length.sum() <= 256 and len(seq) <= 3
    for r in rows.itertuples():
        by_text[(r.doc_id if r.doc_id == r.doc_id else None, r.doc_tokens)].append((r.start, list(r.ids)))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, np.uint32).tobytes())
    want = Counter()
    for i, t in ODD:
        want[(i, tuple(all_ids(t, 0)))] += 1
    for (i, ids), n in want.items():
        got = sorted(by_text[(i, len(ids))])
        assert sum(len(p) for _, p in got) == n * len(ids)
        assert all(list(ids[s : s + len(p)]) == p for s, p in got)
    assert pack(document_examples(df.limit(0))).count() == 0


def test_padding_and_limits(spark):
    rows = pack(document_examples(documents(spark)), with_ids=False).toPandas()
    total = rows.groupby("sequence_id").length.sum()
    assert total.max() <= 1024 and sum(0 if n & (n - 1) == 0 else 1024 - n for n in total) <= 0.001 * total.sum()
    conv = spark.read.parquet(f"{SMALL}/conversations.parquet")
    rows = pack(conversation_examples(conv), capacity=512, segments=4, loss=100, with_ids=False).toPandas()
    g = rows.groupby("sequence_id").agg(n=("length", "sum"), k=("length", "size"), loss=("loss_tokens", "sum"))
    assert g.n.max() <= 512 and g.k.max() <= 4 and g.loss.max() <= 100
    whole = rows.groupby("doc_id").agg(n=("length", "sum"), t=("doc_tokens", "first"))
    assert (whole.n == whole.t).all() and len(whole) == conv.select("conv_id").distinct().count()


def test_best_fit_decreasing(spark):
    lengths = [5, 9, 2, 7, 3, 8, 1, 10, 4, 6]
    bins = bfd_packing.best_fit_decreasing(lengths, 10)
    assert sorted(i for b in bins for i in b) == list(range(10)) and all(sum(lengths[i] for i in b) <= 10 for b in bins) and len(bins) == 6
    left = []
    for n in sorted(lengths, reverse=True):  # the same rule without the tree
        fit = [k for k, r in enumerate(left) if r >= n]
        k = min(fit, key=lambda k: left[k]) if fit else len(left)
        left = left if fit else [*left, 10]
        left[k] -= n
    assert sorted(left) == sorted(10 - sum(lengths[i] for i in b) for b in bins)


def test_id_matrices(spark, tmp_path):
    packed = bfd_packing.pack_ids(odd(spark), capacity=128, end_id=0, pad_id=7)
    bfd_packing.write_packed(packed, str(tmp_path / "out"))
    t = spark.read.parquet(str(tmp_path / "out")).toArrow().combine_chunks().to_batches()[0]
    ids, bounds, pos = bfd_packing.matrices(t, 128)
    docs, starts, used = t.column("doc_ids").to_pylist(), t.column("starts").to_pylist(), t.column("n_tokens").to_pylist()
    pieces = Counter()
    for r in range(len(ids)):
        assert bounds[r][-1] == used[r] and (ids[r][used[r] :] == 7).all()
        for k, (a, b) in enumerate(zip(bounds[r][:-1], bounds[r][1:])):
            assert pos[r][a:b].tolist() == list(range(b - a))
            pieces[(docs[r][k], starts[r][k], tuple(ids[r][a:b].tolist()))] += 1
    want = Counter()
    for i, text in ODD:
        own = all_ids(text, 0)
        want.update((i, a, tuple(own[a : a + 128])) for a in range(0, len(own), 128))
    assert pieces == want
    assert isinstance(t, pa.RecordBatch)


def test_packed_query_returns_the_matrices(spark):
    t = queries.op2_bfd_packing(spark, SMALL).toArrow().combine_chunks().to_batches()[0]
    ids, bounds, pos = bfd_packing.matrices(t, 2048)
    crc, used, segments = (t.column(c).to_pylist() for c in ("ids_crc32", "n_tokens", "n_segments"))
    for r in range(len(ids)):
        assert zlib.crc32(ids[r][: used[r]].tobytes()) == crc[r] and len(bounds[r]) == segments[r] + 1 and bounds[r][-1] == used[r]
        assert pos[r][: used[r]].tolist() == [i for a, b in zip(bounds[r][:-1], bounds[r][1:]) for i in range(b - a)]


def test_mixing(spark):
    docs = documents(spark)
    rows = mix(docs).toPandas()
    text = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in docs.collect()}
    assert len(rows) == len(text) and all(text[i] == n for i, n in zip(rows.doc_id, rows["size"]))
    g = rows.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"), one=("size", "max"))
    total, w = g["size"].sum(), {s: k % 3 + 1 for k, s in enumerate(sorted(g.index))}
    target, full = {}, set()
    while True:  # shares, and the excess of full sources again
        free = total - sum(3 * g["size"][s] for s in full)
        target = {s: 3 * g["size"][s] if s in full else free * w[s] / sum(w[x] for x in g.index if x not in full) for s in g.index}
        over = {s for s in g.index if s not in full and target[s] > 3 * g["size"][s]}
        if not over:
            break
        full |= over
    assert all(abs(g.target[s] - target[s]) < 1e-6 * total for s in g.index)
    assert ((g.taken - g.target).abs() <= g.one).all() and (rows.taken <= 3 * rows["size"]).all()
    again = mix(docs.repartition(7)).toPandas().set_index("doc_id").taken
    assert (again[rows.doc_id].to_numpy() == rows.taken.to_numpy()).all()
    out = mixed(docs)
    assert out.columns == docs.columns and out.groupBy("doc_id").count().toPandas().set_index("doc_id")["count"].max() <= 3


def test_mixing_odd(spark):
    rows = mix(odd(spark)).toPandas()
    assert len(rows) == len(ODD) and rows.taken[rows["size"] == 0].sum() == 0 and rows.source.isna().sum() == 2
    assert mix(odd(spark).limit(0)).count() == 0 and mixed(odd(spark)).columns == odd(spark).columns


def test_kneser_ney(spark):
    docs = documents(spark)
    got = {r.doc_id: r for r in kneser_ney.score_documents(docs).collect()}
    tok = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), "\0"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in tok}
    one, two = Counter(), Counter()
    for i, w in tok.items():
        if not held[i]:
            one.update(w)
            two.update(zip(["\1", *w], w))
    cont, total, kinds = Counter(w for _, w in two), Counter(), defaultdict(lambda: [0, 0, 0])
    for (u, _), n in two.items():
        total[u] += n
        kinds[u][min(n, 3) - 1] += 1
    of = lambda c: kneser_ney.discounts([Counter(c.values())[k] for k in (1, 2, 3, 4)])
    d2, d1 = of(two), of(cont)
    rest = sum(d1[min(n, 3) - 1] for n in cont.values()) / len(two)

    def p(u, w):
        low = (cont[w] - d1[min(cont[w], 3) - 1] if cont[w] else 0) / len(two) + rest / (len(one) + 1)
        if not total[u]:
            return low
        n = two[u, w]
        return (n - d2[min(n, 3) - 1] if n else 0) / total[u] + sum(a * b for a, b in zip(d2, kinds[u])) / total[u] * low

    assert abs(sum(p("the", w) for w in one) + p("the", "\2") - 1) < 1e-9
    n, v = sum(one.values()), len(one)
    for i, w in tok.items():
        assert math.isclose(got[i].score, sum(math.log10(p(u, x)) for u, x in zip(["\1", *w], w)), rel_tol=1e-9)
        assert math.isclose(got[i].base_score, sum(math.log10((one[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel_tol=1e-9)
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens, got[i].held_out) == (len(w), sum(one[x] > 0 for x in w), n, held[i])
    assert sum(r.score for r in got.values() if r.held_out) > sum(r.base_score for r in got.values() if r.held_out)


def brute_kneser_ney(texts, order):
    """P(context, w) by dictionaries."""
    grams = Counter()
    for w in texts:
        full = ["\1"] * (order - 1) + w
        grams.update(tuple(full[i : i + order]) for i in range(len(w)))
    levels = [grams]
    while len(next(iter(levels[0]))) > 1:
        levels.insert(0, Counter(g[1:] for g in levels[0]))
    tables = []
    for c in levels:
        d = kneser_ney.discounts([Counter(c.values())[k] for k in (1, 2, 3, 4)])
        total, spare = Counter(), Counter()
        for g, n in c.items():
            total[g[:-1]] += n
            spare[g[:-1]] += d[min(n, 3) - 1]
        tables.append((c, d, total, spare))

    def p(context, w):
        q = 1 / (len(levels[0]) + 1)
        for k, (c, d, total, spare) in enumerate(tables):
            u = context[len(context) - k :]
            if total[u]:
                n = c[(*u, w)]
                q = (n - d[min(n, 3) - 1] if n else 0) / total[u] + spare[u] / total[u] * q
        return q

    return p, levels


@pytest.mark.parametrize("order", [3, 4])
def test_kneser_ney_orders(spark, order):
    docs = documents(spark)
    frame = queries.op6_kneser_ney(spark, SMALL) if order == 3 else kneser_ney.score_documents(docs, order=order)
    got = {r.doc_id: r.score for r in frame.collect()}
    tok = {r.doc_id: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), "\0"] for r in docs.collect()}
    p, levels = brute_kneser_ney([w for i, w in tok.items() if zlib.crc32(str(i).encode()) % 5 != 1], order)
    seen = next(g[:-1] for g in levels[-1] if "\1" not in g)
    assert abs(sum(p(seen, g[0]) for g in levels[0]) + p(seen, "\2") - 1) < 1e-9
    for i, w in tok.items():
        full = ["\1"] * (order - 1) + w
        want = sum(math.log10(p(tuple(full[k : k + order - 1]), x)) for k, x in enumerate(w))
        assert math.isclose(got[i], want, rel_tol=1e-9)


def test_kneser_ney_odd(spark):
    rows = kneser_ney.score_documents(odd(spark)).collect()
    assert len(rows) == len(ODD) and all(np.isfinite(r.score) and r.score <= 0 for r in rows)
    assert kneser_ney.score_documents(odd(spark).limit(0)).count() == 0


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    own = rows[rows.held_out]
    assert (own.lang == own.lang_pred).mean() > 0.97 and rows.score.between(0, 1).all()
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(rows.doc_id, rows.held_out))
    strange = spark.createDataFrame([(1, None, "en"), (2, "12 34 !", "en"), (3, "", None), (4, "日本", None), (7, "the cat and the dog", "en"), (8, "der Hund und die Katze", "de"), (None, "le chat", "fr")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in languages(strange).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] != "und" and len(got) == 7
    assert languages(strange.limit(0)).count() == 0 and {r.lang_pred for r in languages(strange.where("lang is null")).collect()} == {"und"}


def test_every_language_is_learned(spark):
    codes = [f"{c}-{k:02}" for c in ("en", "fr", "ru", "fi", "tr", "ar", "hi", "zh") for k in range(27)]
    rows = [(i, f"{c} w{i} {i * 7919 % 1000}", c) for i, c in enumerate(codes * 4)] + [(10_000 + i, f"common words {i}", "en-00") for i in range(3000)]
    rows += [(20_000, "one text, very often", "en-01")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = {c for i, _, c in rows if zlib.crc32(str(i).encode()) % 5}
    model = fit(docs.repartition(3), sample=400)
    assert len(learned) > 200 and set(model.langs) == learned and LEAST > 400 // len(learned)
    again = fit(docs.repartition(7), sample=400)
    assert all((again.pair_w[k] == w).all() for k, w in model.pair_w.items()) and (again.family_w == model.family_w).all()


def test_licenses(spark):
    long = "x y z " * 500 + "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and, well, associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute"
    cases = [(1, "This is under the MIT License, under the mit license."), (2, None), (3, ""), (4, "This work is licensed under the GNU General Public License, version 3."), (5, long), (6, "Apache License Version 20, not 2"), (7, "licensed works of the general public"), (1, "CC BY-NC"), (None, "Apache License, Version 2.0!")]
    df = spark.createDataFrame([(i, t, "l") for i, t in cases], "doc_id long, text string, labels string")
    got = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in scan_licenses(df).collect()]
    at = {(r[0], r[1]): r[2:] for r in got}
    assert len(got) == len(cases) and at[1, 10] == (2, 2, 6, "mit", "mit", 1.0) and at[2, 0] == (0, None, None, "", "", 0.0)
    assert at[4, 12][4] == "gpl-3" and at[4, 12][0] == 0 and [v for k, v in at.items() if k[0] == 5][0][4] == "mit"
    assert at[6, 6] == (0, None, None, "", "", 0.0) and at[7, 6][4] == "" and at[1, 3][3] == "cc-by-nc" and at[None, 5][3] == "apache-2"
    assert scan_licenses(df.limit(0)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(12).tolist()) for i in range(300)] + [(300 + i, [0.5] * 12) for i in range(60)]
    rows += [(1000, None), (1050, [None] * 12), (1100, [float("inf")] * 12), (None, [1.0] * 12), (1150, [0.0] * 12), (1200, [1.0, 2.0]), (1201, [2.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score int").repartition(3)
    got = defaultdict(list)
    for r in exact_top_k(df).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ok = [(i, np.floor(256 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for i, v in ok:
        if i % 50 == 0:
            want = sorted(((-int(v @ w), j) for j, w in ok if j != i and len(w) == len(v)))[:5]
            assert got.pop(i) == [(k + 1, j, -s) for k, (s, j) in enumerate(want)]
    assert not got and exact_top_k(df.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = documents(spark)
    assert [n for n, _ in p.STAGES] and len(p.STAGES) == 5
    mark = odd(spark).select("doc_id", "text", "lang", "source", F.lit(5).cast("long").alias("n_chars"))
    docs = docs.unionByName(mark.where("doc_id is not null").withColumn("doc_id", F.col("doc_id") + 10_000))
    n = [docs.count()]
    for _, f in p.STAGES[:-1]:
        out = f(spark, docs, SMALL)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.toPandas().astype({"n_chars": "int64"}), docs.schema)
        n.append(docs.count())
    assert n[1] >= n[0] - 3 and n[2] <= n[1] and n[3] <= n[2] and n[4] > 0
    pieces = p.STAGES[-1][1](spark, docs, SMALL).toPandas()
    assert pieces.length.sum() == sum(len(all_ids(t, 0)) for t in docs.toPandas().text)


def test_entry_lists_every_operator():
    assert set(queries.oracle_sql()) <= set(queries.queries())
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    entry = importlib.import_module("__spark_entry__")
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} <= {x.split("_")[0] for x in entry.queries()}


@pytest.mark.parametrize("name", ["op3_mix_sources"])
def test_native_plan(spark, name):
    plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
