"""Whole queries against SQL, the pipeline stage by stage against brute force, and what an absent folder leaves."""

import os
import re
import shutil
import subprocess
import sys
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from reachspark.llm import embedding_forest, language_id, neardup, queries
from reachspark.llm.embedding_forest import Forest, unit
from reachspark.llm.exact_topk import exact_top_k
from reachspark.llm.license_scan import scan_licenses
from reachspark.llm.license_texts import TEMPLATES
from reachspark.llm.minhash_dedup import keep_first
from reachspark.llm.tokens import encoder
from tests.llm.test_dedup import linked, lower, roots, word_sets
from tests.test_oracles import rows

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, name):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    ours, theirs = queries.queries()[name](spark, SMALL).toPandas(), c.execute(queries.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_tiles_of_a_component_never_meet(spark):
    """A bucket of one large component and a stranger: pairs of tiles grow with the component's tiles, not with their square."""
    df = spark.range(400).select(F.lit(1).cast("long").alias("bkey"), F.col("id").alias("sid"), F.when(F.col("id") == 399, 399).otherwise(0).cast("long").alias("comp"), F.lit(400).cast("long").alias("n"))
    placed, pairs = neardup.tile_pairs(df, tile=16)
    tiles = placed.where("comp = 0").select("t").distinct().count()
    assert 25 <= tiles and pairs.count() <= tiles + 1
    both = pairs.alias("p").join(placed.alias("a"), F.col("p.x") == F.col("a.t")).join(placed.alias("b"), F.col("p.y") == F.col("b.t")).where("a.comp <> b.comp").select(F.least("a.sid", "b.sid"), F.greatest("a.sid", "b.sid")).distinct()
    assert both.count() == 399  # every pair of the stranger with a member
    # many small components: all of their pairs meet
    many = spark.range(60).select(F.lit(2).cast("long").alias("bkey"), F.col("id").alias("sid"), (F.col("id") % 20).alias("comp"), F.lit(60).cast("long").alias("n"))
    placed, pairs = neardup.tile_pairs(many, tile=16)
    both = pairs.alias("p").join(placed.alias("a"), F.col("p.x") == F.col("a.t")).join(placed.alias("b"), F.col("p.y") == F.col("b.t")).where("a.comp <> b.comp").select(F.least("a.sid", "b.sid"), F.greatest("a.sid", "b.sid")).distinct()
    assert both.count() == 60 * 59 // 2 - 20 * 3


def test_copies_and_recall_of_the_forest():
    rng, d = np.random.default_rng(0), 64
    x = unit(rng.standard_normal((16_000, d)))
    forest = Forest(x, 9, embedding_forest.TREES, embedding_forest.SPILL)
    assert len(forest.leaves(x)[0]) / len(x) <= 8
    a = x[:3000]
    away = rng.standard_normal(a.shape)
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * unit(away - (away * a).sum(1, keepdims=True) * a)
    own = set(zip(*(v.tolist() for v in forest.leaves(a))))
    assert len({r for r, c in zip(*(v.tolist() for v in forest.leaves(b))) if (r, c) in own}) / len(a) > 0.995


def test_huge_products_are_exact(spark):
    big = [(0, [1e300, 1.0]), (50, [1e8, -1e8]), (1, [1e8, 1e8]), (2, [1e8, 1e8 - 1]), (3, [-1e300, 0.0]), (4, [0.0, 0.0])]
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in exact_top_k(spark.createDataFrame(big, "vec_id long, embedding array<double>"), k=5).collect()}
    q = {i: [int(np.floor(256 * x)) for x in v] for i, v in big}
    for query in (0, 50):
        dots = sorted(((-sum(a * b for a, b in zip(q[query], q[i])), i) for i in q if i != query))
        clip = lambda v: max(-(2**63 - 1), min(2**63 - 1, v))
        want = sorted((-clip(-m), i) for m, i in dots)
        assert [got[query, r + 1] for r in range(5)] == [(i, -m) for m, i in want]


def test_waves_of_blocks(spark, monkeypatch):
    """Many blocks and groups of queries, met in several waves, with equal vectors and ties."""
    monkeypatch.setattr("reachspark.llm.exact_topk.BLOCK", 16)
    monkeypatch.setattr("reachspark.llm.exact_topk.QUERIES", 8)
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((600, 6)) * rng.choice([0.2, 1, 3], 600)[:, None], 1)
    x[300:330] = x[0]
    got = {}
    for r in exact_top_k(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), k=5, every=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = np.floor(256 * x).astype(np.int64)
    for q in range(0, 600, 20):
        dots = sorted((-int(whole[q] @ whole[i]), i) for i in range(600) if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -m) for k, (m, i) in enumerate(dots)]


def test_votes_against_brute_force():
    rng = np.random.default_rng(3)
    langs = [c for c in ("en", "de", "nl", "fr", "es", "xx") for _ in range(12)]
    centre = {c: rng.random(40) for c in set(langs)}
    x = np.array([centre[c] + 0.05 * rng.random(40) for c in langs], np.float32)
    model = language_id.Model(x, langs)
    asked = np.vstack([x, rng.random((50, 40)).astype(np.float32)])
    got, score = model.predict(asked)
    squash = lambda m: 1 / (1 + np.exp(-3 * m))
    for v, lang, s in zip(np.hstack([asked, np.ones((len(asked), 1), np.float32)]), got, score):
        chance = [squash(float(v @ w)) for w in model.family_w]
        own = model.of[model.families[int(np.argmax(chance))]]
        votes, sure = Counter(), Counter()
        for a, b in combinations(own, 2):
            p = squash(float(v @ model.pair_w[a, b]))
            votes[a if p > 0.5 else b] += 1
            sure[a] += p
            sure[b] += 1 - p
        best = max(own, key=lambda c: (votes[c], sure[c]))
        assert lang == best and abs(s - max(chance) / sum(chance) * (sure[best] / (len(own) - 1) if len(own) > 1 else 1)) < 1e-4
    assert got[: len(langs)] == langs


def test_spans_are_verified_on_words(spark):
    text = TEMPLATES["isc"][0].split()
    edited = [w if i % 12 else "changed" for i, w in enumerate(text)]
    shuffled = [w for k in range(0, len(text), 4) for w in text[k : k + 4][::-1]]
    docs = [(1, "intro words " + " ".join(text)), (2, "x y " + " ".join(edited)), (3, " ".join(shuffled)), (4, " ".join(text[:12])), (5, None)]
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[i].labels for i in (1, 2, 3, 4, 5)] == ["isc", "isc", "", "", ""] and len(TEMPLATES) >= 25
    part = {s.label: s.part for s in got[2].spans}["isc"]
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    assert abs(part - sum(a == b for a, b in zip(words(" ".join(edited)), words(" ".join(text)))) / len(words(" ".join(text)))) < 0.02


def test_every_row_is_judged_by_its_own_text(spark):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    docs = [(1, a), (2, a), (2, b), (None, a), (None, b), (None, "q r s t u v"), (3, None), (3, None)]
    left = keep_first(spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, h string"))
    assert sorted(((r.doc_id or 0, r.text or "") for r in left.collect())) == sorted([(1, a), (2, b), (0, "q r s t u v"), (3, "")])


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 120")
    extra = spark.createDataFrame([(900, None, None, None, 0), (901, "12 34 !", "en", "src0", 7), (902, "", "en", "src1", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(extra).withColumn("row", F.lit(1)).withColumn("h", F.lit("x")).cache()
    columns, before = docs.columns, docs
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        after[name] = stage(spark, before, SMALL).cache()
        if name != "packing":
            assert after[name].columns == columns
            before = after[name]
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    start, named, lined, near = (texts(d) for d in (docs, after["language"], after["lines"], after["near duplicates"]))
    assert named == {i: t for i, t in start.items() if t and any(ch.isalpha() for ch in t)}
    # lines: the first of each component of similar ones stays
    clean = lambda s: lower(s).strip(" \t\n\r\x0b\x0c")
    occ = [(i, n, s, clean(s)) for i in sorted(named) for n, s in enumerate(named[i].split("\n"))]
    names = list(dict.fromkeys(s for *_, s in occ if s))
    comp = dict(zip(names, roots(len(names), linked([{s[i : i + 5] for i in range(max(1, len(s) - 4))} for s in names]))))
    seen, kept = set(), {}
    for i, _, raw, s in occ:
        if not s or comp[s] not in seen:
            kept.setdefault(i, []).append(raw)
            seen |= {comp[s]} if s else set()
    want = {i: "\n".join(kept.get(i, [])) for i in named}
    assert lined == {i: t for i, t in want.items() if t == named[i] or re.search(r"[^\x20\x09-\x0D]", t)}
    ids = sorted(lined)
    comp = roots(len(ids), linked(word_sets([lined[i] for i in ids], 5)))
    assert near == {i: lined[i] for k, i in enumerate(ids) if comp[k] == k or not word_sets([lined[i]], 5)[0]}
    # mixing: whole copies, three at most, and each source near its target
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    mixed = Counter(r.doc_id for r in after["mixing"].collect())
    source = {r.doc_id: r.source for r in after["near duplicates"].collect()}
    assert set(mixed) <= set(near) and max(mixed.values()) <= 3
    whole, weight = Counter(), {s: k % 3 + 1 for k, s in enumerate(sorted(set(source.values())))}
    for i, s in source.items():
        whole[s] += size(near[i])
    target, free = {}, dict(weight)
    left = sum(whole.values())
    while free:
        over = [s for s in free if left * free[s] / sum(free.values()) >= 3 * whole[s]]
        if not over:
            target |= {s: left * w / sum(free.values()) for s, w in free.items()}
            break
        for s in over:
            target[s] = 3 * whole[s]
        left -= sum(target[s] for s in over)
        free = {s: w for s, w in free.items() if s not in over}
    for s in weight:
        taken = sum(n * size(near[i]) for i, n in mixed.items() if source[i] == s)
        assert abs(taken - target[s]) <= max(size(near[i]) for i in near if source[i] == s)
    # packing: every id of every copy once
    pieces = after["packing"].collect()
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.length
    assert all(total[i] == n * (len(encoder().ids(near[i])) + 1) for i, n in mixed.items()) and set(total) == set(mixed)
    per = Counter()
    for p in pieces:
        per[p.sequence_id] += p.length
    assert max(per.values()) <= 1024


def test_pipeline_of_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.count() == 0, name


def test_without_the_folders_the_rest_works(tmp_path):
    """A copy without this subpackage, its tests and the pipeline still imports, lists its queries and runs one."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    shutil.copytree(f"{here}/reachspark", tmp_path / "reachspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{here}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; from pyspark.sql import SparkSession as S; s = S.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate(); q = e.queries(); assert not any(k.startswith('op') or k == 'pipeline' for k in q); print('rows', q['src07_rail_routes'](s, '/root/testdata/sf0.001').count(), len(e.oracle_sql()) > 30)"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 5 True" in out.stdout, out.stderr[-2000:]


CLASH = ("row", "lang_pred", "score", "size", "h", "n", "sid", "thash", "word", "shard", "gone", "root", "level", "t")


def test_odd_rows_and_clashing_columns(spark):
    """Nulls, empty and very long texts, one very long line, repeated rows and columns named like the operators' own."""
    long_line = " ".join(f"w{i % 977}" for i in range(40_000))
    base = [(1, "plain words of a text", "en", "a"), (1, "plain words of a text", "en", "a"), (2, None, None, None), (None, "", "de", "b"), (3, long_line, "en", "a"), (4, long_line + " x", None, "b"), (5, "ein kurzer deutscher Satz", "de", None)]
    df = spark.createDataFrame(base, "doc_id long, text string, lang string, source string")
    for c in CLASH:
        df = df.withColumn(c, F.lit(c))
    n = len(base)
    scores = queries.score_documents(df, order=3).collect()
    assert len(scores) == n and {r.n_tokens for r in scores} == {6, 1, 40_001, 40_002, 5} and all(r.score < 0 for r in scores)
    assert queries.languages(df).count() == n
    lines = {r.row.doc_id: r for r in queries.dedup_lines(df).collect()}
    assert lines[3].n_kept == 1 and lines[4].n_kept == 0 and lines[3].row.gone == "gone" and lines[3].clean == long_line
    packed = queries.pack_ids(df, capacity=512).collect()
    assert sum(r.n_tokens for r in packed) == sum(len(encoder().ids(t or "")) + 1 for _, t, _, _ in base)
    assert {i for r in packed for i in r.doc_ids} == {1, 2, None, 3, 4, 5}
    assert sum(r.size for r in queries.mix(df).collect()) == 5 + 5 + 40_000 + 40_001 + 4
    assert queries.scan_licenses(df).count() == n and queries.near_duplicates(df).where("not kept").count() >= 1
    empty = df.limit(0)
    for op in (queries.score_documents, queries.languages, queries.dedup_lines, queries.pack_ids, queries.mix, queries.scan_licenses, queries.near_duplicates):
        assert op(empty).count() == 0, op
