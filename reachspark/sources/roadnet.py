"""Prepared road networks: what they were made from, and their safe replacement. The road engine itself is a command that is passed in."""

from __future__ import annotations

import hashlib
import json
import os
import re
import shutil
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reachspark.operators.matrix import write_atomic
from reachspark.sources.artifacts import inspect_network
from reachspark.sources.localities import read_directory

# Fields of a road network's description, and what the profile and algorithm must be.
GRAPH = ("sourcePbfSha256", "osrmVersion", "profile", "algorithm")
PROFILE, ALGORITHM = "car.lua", "ch"


def extract_digest(path: str) -> tuple[int, str]:
    """Size and SHA-256 of the road extract, read in blocks; it must not be empty."""
    digest, size = hashlib.sha256(), 0
    with open(path, "rb") as f:
        while block := f.read(1 << 22):
            digest.update(block)
            size += len(block)
    if not size:
        raise ValueError(f"{path} is empty")
    return size, digest.hexdigest()


def parse_graph(text: str) -> dict:
    """The description in a manifest: {"roadGraph": {...}} with exactly these fields, a lower-case digest and a version of three numbers."""
    value = json.loads(text)
    graph = value.get("roadGraph") if isinstance(value, dict) and set(value) == {"roadGraph"} else None
    if not isinstance(graph, dict) or set(graph) != set(GRAPH):
        raise ValueError("road manifest: exactly roadGraph with its four fields is expected")
    faults = [
        ("sourcePbfSha256", re.fullmatch("[0-9a-f]{64}", str(graph["sourcePbfSha256"]))), ("osrmVersion", re.fullmatch(r"[0-9]+[.][0-9]+[.][0-9]+", str(graph["osrmVersion"]))),
        ("profile", graph["profile"] == PROFILE), ("algorithm", graph["algorithm"] == ALGORITHM),
    ]
    if bad := [name for name, ok in faults if not ok]:
        raise ValueError(f"road manifest: bad {', '.join(bad)}")
    return graph


def promote(staging: str, folder: str) -> None:
    """Puts staging in folder's place. What was there is moved aside first and comes back if that fails."""
    backup = f"{os.path.dirname(os.path.abspath(folder))}/.backup-{uuid.uuid4().hex}"
    was = os.path.exists(folder)
    if was:
        os.replace(folder, backup)
    try:
        os.replace(staging, folder)
    except OSError:
        if was:
            os.replace(backup, folder)
        raise
    if was:
        shutil.rmtree(backup)


def prepare(extract: str, folder: str, name: str, version: str, make: Callable[[str, str], None]) -> dict:
    """make(extract, target) writes the network's files as target.*; then they are inspected, described and put in place. The extract must not change meanwhile."""
    _, before = extract_digest(extract)
    staging = f"{os.path.dirname(os.path.abspath(folder))}/.staging-{uuid.uuid4().hex}"
    os.makedirs(staging)
    try:
        make(extract, f"{staging}/{name}")
        found = inspect_network(staging, name)
        if extract_digest(extract)[1] != before:
            raise ValueError("the extract changed while the network was made")
        graph = {"sourcePbfSha256": before, "osrmVersion": version, "profile": PROFILE, "algorithm": ALGORITHM}
        write_atomic(f"{staging}/manifest.json", json.dumps({"roadGraph": graph}, sort_keys=True))
        parse_graph(json.dumps({"roadGraph": graph}))
        promote(staging, folder)
        return found | graph
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def load(spark: SparkSession, extract: str, folder: str, name: str, version: str, localities_folder: str, localities: str) -> tuple[DataFrame, dict]:
    """Localities in order of id and the network's description, if it was made from this extract by this version."""
    inspect_network(folder, name)
    with open(f"{folder}/manifest.json") as f:
        graph = parse_graph(f.read())
    now = {"sourcePbfSha256": extract_digest(extract)[1], "osrmVersion": version, "profile": PROFILE, "algorithm": ALGORITHM}
    if other := [k for k in GRAPH if graph[k] != now[k]]:
        raise ValueError(f"the road network was made from something else: {', '.join(other)} differ")
    own = read_directory(spark, localities_folder, localities)
    if own.isEmpty():
        raise ValueError("no localities")
    return own, graph
