"""Localities: dedup, resolution, search (one query by a scan, many by an index of runs of characters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachspark.config import SEARCH_LIMIT
from reachspark.functions import text

#: Longest run of characters under which a label can be found.
GRAM = 3


def dedup(localities: DataFrame, city_key=text.city_key) -> DataFrame:
    """One row for each (postal code, normalised city): the largest address share, then the first row (row_no); a missing share comes last. Rows without a
    postal code of four digits are dropped. localities: (row_no, postal_code, city, share, latitude, longitude)."""
    keyed = localities.withColumn("postal_code", text.postal_key(F.col("postal_code"))).where("postal_code is not null").withColumn("city_key", city_key(F.col("city")))
    best = Window.partitionBy("postal_code", "city_key").orderBy(F.col("share").desc_nulls_last(), "row_no")
    one = keyed.withColumn("rn", F.row_number().over(best)).where("rn = 1").drop("rn")
    return one.withColumn("locality_id", text.locality_id(F.col("postal_code"), F.col("city_key")))


def resolve(queries: DataFrame, localities: DataFrame, city_key=text.city_key) -> DataFrame:
    """queries (postal_code, city) with the locality_id that they name, or null: malformed ones never fail."""
    keys = queries.withColumn("pk", text.postal_key(F.col("postal_code"))).withColumn("ck", city_key(F.col("city")))
    own = localities.select(F.split_part("locality_id", F.lit(":"), F.lit(1)).alias("pk"), F.expr("substr(locality_id, instr(locality_id, ':') + 1)").alias("ck"), "locality_id")
    return keys.join(own, ["pk", "ck"], "left").drop("pk", "ck")


def search(localities: DataFrame, query: str, limit: int = SEARCH_LIMIT, city_key=text.city_key) -> DataFrame:
    """The best matches in order of (rank, locality_id)."""
    rank = text.search_rank(query, F.col("postal_code"), F.col("ck"))
    return localities.withColumn("ck", city_key(F.col("city"))).withColumn("rank", rank).where("rank is not null").drop("ck").orderBy("rank", "locality_id").limit(limit)


def _runs(label: str, least: str) -> str:
    """SQL: distinct runs of characters of a label, of each length from least to GRAM (a shorter label is its own run)."""
    return f"array_distinct(flatten(transform(sequence({least}, {GRAM}), n -> transform(sequence(1, greatest(length({label}) - n + 1, 1)), i -> substr({label}, i, n)))))"


def search_index(localities: DataFrame, city_key=text.city_key) -> DataFrame:
    """(gram, locality_id, postal_code, ck): each locality under every run of 1 to GRAM characters of its label. Localities without a postal code or city are under none."""
    keyed = localities.select("locality_id", "postal_code", city_key(F.col("city")).alias("ck"))
    labelled = keyed.withColumn("label", text.locality_label(F.col("postal_code"), F.col("ck"))).where("label is not null")
    return labelled.select(F.explode(F.expr(_runs("label", "1"))).alias("gram"), "locality_id", "postal_code", "ck")


def search_many(requests: DataFrame, index: DataFrame, limit: int = SEARCH_LIMIT, city_key=text.city_key) -> DataFrame:
    """(request_id, place, locality_id, rank): of each request (request_id, query) the best matches in order of (rank, locality_id), place from 1; what search() gives for each.

    All matches hold the query in their label, so they lie under each of its runs of GRAM characters (a shorter query is a run itself): those under its rarest run are ranked. Equal queries are
    searched once. Requests whose query is null or blank have no rows. The best of a query are kept in each task before they are shuffled, so a query that nearly all localities match is no hot key."""
    asked = requests.select("request_id", city_key(F.col("query")).alias("q")).where("q != ''")
    queries = asked.select("q").distinct()
    runs = queries.select("q", F.explode(F.expr(_runs("q", f"least(length(q), {GRAM})"))).alias("gram"))
    runs = runs.where(f"length(gram) = least(length(q), {GRAM})")
    often = runs.join(index.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = often.groupBy("q").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    ranked = rarest.join(index, "gram").withColumn("rank", text.search_rank(F.col("q"), F.col("postal_code"), F.col("ck"))).where("rank is not null")
    best = Window.partitionBy("q").orderBy("rank", "locality_id")
    top = ranked.select("q", "locality_id", "rank").withColumn("place", F.row_number().over(best)).where(F.col("place") <= limit)
    return asked.join(top, "q").select("request_id", "place", "locality_id", "rank")
