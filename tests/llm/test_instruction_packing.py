"""Instruction data: all three limits of the packer at once, over conversations."""

import zlib

import numpy as np

from reachspark.llm import queries
from reachspark.llm.tokens import encoder
from reachspark.llm.vector_packing import conversation_examples, pack

SMALL = "/root/testdata/sf0.001"


def test_limits_bind_and_every_id_lies_in_one_piece(spark):
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet")
    limits = {"capacity": 1024, "segments": 3, "loss": 640}
    got = pack(conversation_examples(turns), **limits, with_ids=True).toPandas()
    enc, want, marks = encoder(None), {}, {}
    rows = turns.toPandas().sort_values(["conv_id", "turn", "role", "text"])
    for conv, own in rows.groupby("conv_id"):
        parts = [(np.asarray(enc.ids(t or ""), np.uint32), r == "assistant") for r, t in zip(own["role"], own["text"])]
        want[conv] = np.concatenate([*[p[0] for p in parts], np.zeros(1, np.uint32)])
        marks[conv] = np.concatenate([*[np.full(len(p[0]), p[1]) for p in parts], [parts[-1][1]]])
    seen = {c: np.zeros(len(w), int) for c, w in want.items()}
    for r in got.itertuples():
        span = slice(r.start, r.start + r.length)
        assert list(r.ids) == want[r.doc_id][span].tolist() and r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][span].astype("<u4").tobytes()) and r.loss_tokens == marks[r.doc_id][span].sum()
        seen[r.doc_id][span] += 1
    assert all((s == 1).all() for s in seen.values())
    per = got.groupby("sequence_id").agg(n=("length", "sum"), k=("length", "size"), loss=("loss_tokens", "sum"))
    assert per["n"].max() <= 1024 and per["k"].max() <= 3 and per["loss"].max() <= 640
    # each of the limits is what ends some sequence
    assert (per["n"] == 1024).any() and (per["k"] == 3).any() and (per["loss"] == 640).any()
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]


def test_query(spark):
    got = queries.queries()["instruction_packing"](spark, SMALL)
    assert got.select("doc_id").distinct().count() == spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id").distinct().count()
