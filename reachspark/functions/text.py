"""Text keys: city names, postal codes, locality ids, search ranks."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachspark.checks import number


def normalize_city(name: str | None) -> str | None:
    """Trim, compatibility-decompose, drop marks, lower-case, squeeze white space."""
    if name is None:
        return None
    plain = "".join(ch for ch in unicodedata.normalize("NFKD", name.strip()) if not unicodedata.category(ch).startswith("M"))
    return re.sub(r"\s+", " ", plain.lower())


@F.pandas_udf(T.StringType())
def city_key(names: pd.Series) -> pd.Series:
    # Spark has no compatibility decomposition; names repeat, so each is worked out once a batch
    known = {n: normalize_city(n) for n in names.dropna().unique()}
    return names.map(known)


def ascii_city_key(name: Column) -> Column:
    """The same key for plain ASCII names, inside the JVM."""
    return F.regexp_replace(F.lower(F.trim(name)), r"\s+", " ")


def postal_key(code: Column) -> Column:
    """Four digits after trimming, else null."""
    t = F.trim(code)
    return F.when(t.rlike("^[0-9]{4}$"), t)


def locality_id(postal: Column, city: Column) -> Column:
    return F.concat_ws(":", postal, city)


def address_share(text: Column) -> Column:
    """A percentage with or without its sign; anything else is null."""
    return number(F.regexp_replace(F.trim(text), "%$", ""))


def search_rank(query: str | Column, postal: Column, city: Column) -> Column:
    """0 to 6, or null for no match: label, postal code and city equal the query, then start with it, then label contains it. A column holds queries that are normalised already."""
    q = query if isinstance(query, Column) else F.lit(normalize_city(query) or "")
    label = locality_label(postal, city)
    found = F.when(label == q, 0).when(postal == q, 1).when(city == q, 2).when(label.startswith(q), 3).when(postal.startswith(q), 4).when(city.startswith(q), 5).when(label.contains(q), 6)
    return F.when(q != "", found)


def locality_label(postal: Column, city: Column) -> Column:
    return F.concat(postal, F.lit(" "), city)


def duration_label(minutes: Column) -> Column:
    return F.when(minutes < 60, F.format_string("%d min", minutes)).otherwise(F.format_string("%d h %02d min", F.floor(minutes / 60).cast("int"), (minutes % 60).cast("int")))
