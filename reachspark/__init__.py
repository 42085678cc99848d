"""reachspark: travel-time reachability and corpus preparation on Spark DataFrames."""

from __future__ import annotations

import os
import sys


def _ship_code() -> None:
    """Python workers import this package by name where they can. Where the
    driver found it by other means than PYTHONPATH or its working directory,
    workers can't, so its functions travel by value instead."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    seen = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in seen or os.path.abspath(os.getcwd()) == root:
        return
    try:
        from pyspark import cloudpickle
    except ImportError:
        return
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_code()
