"""Separated records of a file that many tasks read: quoted fields may hold separators, quotes and line feeds, and every record has its number.

A split of the file can begin inside a quoted field. Whether it does follows from the number of quotes in all splits before it, so a first pass
counts, for each split, its quotes and the records that begin in it (for either beginning); sums over splits, a row each, give every split's state and its first record's number. The second pass parses.
Records that go on in the next split are few: their pieces meet by record number."""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOM = "﻿"
#: Characters of one field at most (the parser's own limit is 128 KB).
csv.field_size_limit(min(sys.maxsize, 2**31 - 1))


class RecordError(ValueError):
    """A file that can't be read as records, with its name and the record's number."""


class HeaderError(ValueError):
    pass


@dataclass(frozen=True)
class State:
    """How a split begins: inside a quoted field or not, and the number of the first record that begins in it (the header is 1)."""

    inside: bool
    first: int


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, block): lines with the offset of the split that they begin in; a task has a split's lines in order. Line feeds alone end a line."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"), F.col("_metadata.file_block_start").alias("block"))


def _quotes(line: pa.Array) -> np.ndarray:
    return pc.count_substring(line, '"').to_numpy(zero_copy_only=False).astype(np.int64)


def _blank(line: pa.Array) -> np.ndarray:
    return pc.is_in(line, value_set=pa.array(["", "\r", BOM, BOM + "\r"])).to_numpy(zero_copy_only=False)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array]]:
    """Lines of one block at a time, in order; a block can come in several pieces."""
    for b in batches:
        block = b.column(1).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
            if e > a:
                yield int(block[a]), b.column(0).slice(a, e - a)


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, odd, outside, inside): whether its quotes are odd in number, and the records that begin in it if it begins outside or inside quotes."""
    out: dict[int, list[int]] = {}
    for block, line in _by_block(batches):
        s = out.setdefault(block, [0, 0, 0])
        q = _quotes(line)
        before = (np.cumsum(q) - q + s[0]) % 2
        some = ~_blank(line)
        s[1] += int(((before == 0) & some).sum())
        s[2] += int(((before == 1) & some).sum())
        s[0] = (s[0] + int(q.sum())) % 2
    yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int64()), *[pa.array([s[k] for s in out.values()], pa.int64()) for k in range(3)]], ["block", "odd", "outside", "inside"])


def _states(spark: SparkSession, path: str) -> tuple[dict[int, State], int]:
    """State of each split (one row for each comes to the driver), and the number of records."""
    states, inside, n = {}, False, 1
    for r in sorted(_lines(spark, path).mapInArrow(_summary, "block long, odd long, outside long, inside long").collect()):
        states[r.block] = State(inside, n)
        n += r.inside if inside else r.outside
        inside ^= r.odd == 1
    if inside:
        raise RecordError(f"{path}: row {n - 1}: a quote is left open")
    return states, n - 1


def _parse(lines: list[str], first: int, path: str, sep: str) -> Iterator[tuple[int, list[str]]]:
    """(number, fields) of whole records."""
    reader, n = csv.reader((x + "\n" for x in lines), delimiter=sep, strict=True), first
    while True:
        try:
            row = next(reader, None)
        except csv.Error as e:
            raise RecordError(f"{path}: row {n}: {e}") from e
        if row is None:
            return
        if row:
            yield n, row
            n += 1


def _batch(rows: list[tuple[int, list[str]]], columns: dict[str, int], width: int, path: str) -> pa.RecordBatch:
    for n, row in rows:
        if len(row) != width:
            raise RecordError(f"{path}: row {n}: {len(row)} fields, the header has {width}")
    own = [pa.array([row[k] for _, row in rows], pa.string()) for k in columns.values()]
    return pa.RecordBatch.from_arrays([pa.array([n for n, _ in rows], pa.int64()), *own], ["row", *columns])


def _sections(batches: Iterator[pa.RecordBatch], states: dict[int, State]) -> Iterator[tuple[int, int, list[str], str]]:
    """(block, number, lines, kind) in order: the rest of a record that began before the block (kind head), whole records (body), and the beginning of one that goes on in the next (tail)."""
    block, held, n, inside = None, [], 0, False

    def finish():
        if held:
            yield block, n - 1 if inside == "head" else n, list(held), "head" if inside == "head" else "tail"

    for at, line in _by_block(batches):
        if at != block:
            yield from finish()
            block, held, n = at, [], states[at].first
            inside = "head" if states[at].inside else False
        q, lines = _quotes(line), line.to_pylist()
        if at == 0 and lines and n == 1 and not held:
            lines[0] = lines[0].removeprefix(BOM)
        odd = (np.cumsum(q) + (1 if inside else 0)) % 2  # inside a quoted field after each line
        if inside == "head":
            shut = np.flatnonzero(odd == 0)
            if not len(shut):
                held += lines
                continue
            k = int(shut[0]) + 1
            yield block, n - 1, [*held, *lines[:k]], "head"
            held, lines, odd, inside = [], lines[k:], odd[k:], False
        if not lines:
            continue
        whole = np.flatnonzero(odd == 0)
        k = int(whole[-1]) + 1 if len(whole) else 0
        if k:
            body = [*held, *lines[:k]]
            yield block, n, body, "body"
            before = np.concatenate([[1 if held else 0], odd[: k - 1]])
            n += int(sum(1 for x, p in zip(lines[:k], before) if p == 0 and x not in ("", "\r"))) + (1 if held else 0)
            held = []
        held += lines[k:]
        inside = "tail" if held else False
    if block is not None:
        yield from finish()


def _records(states: dict[int, State], columns: dict[str, int], width: int, path: str, sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, n, lines, kind in _sections(batches, states):
            if kind == "body":
                rows = [r for r in _parse(lines, n, path, sep) if r[0] > 1]  # without the header
                if rows:
                    yield _batch(rows, columns, width, path)

    return run


def _pieces(states: dict[int, State]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, n, lines, kind in _sections(batches, states):
            if kind != "body":
                yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([block]), pa.array(["\n".join(lines)])], ["row", "block", "piece"])

    return run


def _joined(columns: dict[str, int], width: int, path: str, sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r for n, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for r in _parse(text.split("\n"), n, path, sep) if n > 1]
            if rows:
                yield _batch(rows, columns, width, path)

    return run


def header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Names of the first record, from as many first lines as it takes."""
    first, most = _lines(spark, path).where("block = 0"), 16
    while True:
        lines = [r.line for r in first.take(most)]
        if lines:
            lines[0] = lines[0].removeprefix(BOM)
        quotes, some = 0, []
        for x in lines:
            if some or x.rstrip("\r"):
                some.append(x)
                quotes += x.count('"')
                if quotes % 2 == 0:
                    return next(_parse(some, 1, path, sep))[1]
        if len(lines) < most:
            raise HeaderError(f"{path} is empty")
        most *= 64


def read_records(spark: SparkSession, path: str, need: list[str], also: list[str] = (), sep: str = ",") -> DataFrame:
    """(row, the columns of need and those of also that the file has): row is the record's number, the header being 1; blank lines count for nothing. All columns are text.

    One file with a header, UTF-8, with or without a byte order mark; lines end by LF or CR LF. A record has as many fields as the header. What isn't so raises RecordError (at the driver if a quote is left open, else
    when the rows are read), naming file and record."""
    names = header(spark, path, sep)
    lacking = [c for c in need if c not in names]
    if lacking:
        raise HeaderError(f"{path}: no column {', '.join(lacking)}")
    columns = {c: names.index(c) for c in [*need, *(c for c in also if c in names)]}
    states, _ = _states(spark, path)
    schema = "row long, " + ", ".join(f"`{c}` string" for c in columns)
    lines = _lines(spark, path)
    out = lines.mapInArrow(_records(states, columns, len(names), path, sep), schema)
    if not any(s.inside for s in states.values()):
        return out
    pieces = lines.mapInArrow(_pieces(states), "row long, block long, piece string").groupBy("row").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "piece"))), lambda p: p["piece"]), "\n").alias("text"))
    return out.unionByName(pieces.mapInArrow(_joined(columns, len(names), path, sep), schema))
