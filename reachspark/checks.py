"""Validation: every stage collects violations (rule, key, message) in one DataFrame, which must be empty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

COLUMNS = ("rule", "key", "message")


class ViolationError(ValueError):
    def __init__(self, stage: str, rows: list):
        self.rows = rows
        super().__init__(f"{stage}: " + "; ".join(f"[{r.rule}] {r.key}: {r.message}" for r in rows))


def violation(df: DataFrame, rule: str, key: Column | str, message: str, when: Column | None = None) -> DataFrame:
    """Rows of df (where ``when`` holds) as violations."""
    df = df if when is None else df.where(when)
    k = F.col(key) if isinstance(key, str) else key
    return df.select(F.lit(rule).alias("rule"), k.cast("string").alias("key"), F.lit(message).alias("message"))


def found(df: DataFrame, *rules: tuple[str, Column | str, str, Column]) -> DataFrame:
    """Violations of many rules (rule, key, message, when) over the rows of df, in one pass over them: a row can break several."""
    one = lambda rule, key, message, when: F.when(when, F.struct(F.lit(rule).alias("rule"), (F.col(key) if isinstance(key, str) else key).cast("string").alias("key"), F.lit(message).alias("message")))
    return df.select(F.inline(F.array_compact(F.array(*[one(*r) for r in rules]))))


def union(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def enforce(violations: DataFrame, stage: str, show: int = 20) -> None:
    """One action a stage: raises with the first rows if there are any."""
    rows = violations.take(show)
    if rows:
        raise ViolationError(stage, rows)


def duplicates(df: DataFrame, keys: list[str], rule: str) -> DataFrame:
    return violation(df.groupBy(*keys).count().where("count > 1"), rule, F.concat_ws("/", *keys), "appears more than once")


def missing(df: DataFrame, other: DataFrame, key: str, rule: str) -> DataFrame:
    """Keys of df that other lacks."""
    return violation(df.select(key).distinct().join(other.select(key).distinct(), key, "left_anti"), rule, key, "is not known")


NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
CIVIL = r"^\d{8}$"


def number(text: Column) -> Column:
    """A finite number in plain notation, else null."""
    t = F.trim(text)
    v = F.when(t.rlike(NUMBER), t.try_cast("double"))
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def coordinate(text: Column, limit: float) -> Column:
    v = number(text)
    return F.when(v.between(-limit, limit), v)


def integer(text: Column, most: int = 2**53 - 1) -> Column:
    """A whole number from 0, written in digits."""
    v = F.when(text.rlike(r"^\d{1,18}$"), text.try_cast("long"))
    return F.when(v <= most, v)


def stop_time_violations(st: DataFrame, known_stops: DataFrame | None = None) -> DataFrame:
    """Faults of raw stop times (trip_id, ordinal, stop_id, stop_sequence, arr, dep): fewer than two rows, blank or unknown
    stop, sequence missing, repeated or falling in input order, missing times, arrival after departure, time going backwards, and where st has pickup_type and drop_off_type, unknown ones.
    One shuffle by trip serves all of them."""
    by_input = Window.partitionBy("trip_id").orderBy("ordinal")
    by_seq = Window.partitionBy("trip_id").orderBy("stop_sequence", "ordinal")
    if known_stops is not None:
        st = st.join(known_stops.select("stop_id").distinct().withColumn("known", F.lit(True)), "stop_id", "left")
    seen = st.withColumn("prev_seq", F.lag("stop_sequence").over(by_input)).withColumn("place", F.row_number().over(by_input)).withColumn("prev_dep", F.lag("dep").over(by_seq)).withColumn("prev_in_order", F.lag("stop_sequence").over(by_seq))
    seen = seen.withColumn("n", F.count("*").over(Window.partitionBy("trip_id")))
    at, named = F.concat_ws("/", "trip_id", F.col("stop_sequence").cast("string")), F.trim(F.coalesce("stop_id", F.lit(""))) != ""
    rules = [
        ("VAL-02.rows", "trip_id", "fewer than two stop times", (F.col("n") < 2) & (F.col("place") == 1)),
        ("VAL-02.stop", at, "blank stop", ~named),
        ("VAL-02.sequence", "trip_id", "missing or negative stop sequence", F.col("stop_sequence").isNull() | (F.col("stop_sequence") < 0)),
        ("VAL-02.repeated", at, "stop sequence repeated", F.col("stop_sequence") == F.col("prev_in_order")),
        ("VAL-02.falling", at, "stop sequence falls in input order", F.col("stop_sequence") < F.col("prev_seq")),
        ("VAL-02.blank", at, "missing time", F.col("arr").isNull() | F.col("dep").isNull()),
        ("VAL-02.dwell", at, "arrival after departure", F.col("arr") > F.col("dep")),
        ("VAL-02.backwards", at, "time goes backwards", F.col("arr") < F.col("prev_dep")),
    ]
    if known_stops is not None:
        rules.append(("VAL-02.unknown", at, "unknown stop", named & F.col("known").isNull()))
    if "pickup_type" in st.columns:
        rules.append(("VAL-02.kind", "trip_id", "pickup or drop-off type is not 0 to 3", F.col("pickup_type").isNull() | F.col("drop_off_type").isNull()))
    return found(seen, *rules)


def frequency_violations(freq: DataFrame) -> DataFrame:
    """Faults of frequency windows (trip_id, start, end, headway): empty or reversed, headway below 1, overlap (touching is allowed)."""
    order = Window.partitionBy("trip_id").orderBy("start", "end", "headway")
    at = F.concat_ws("/", "trip_id", F.col("start").cast("string"))
    before = freq.withColumn("prev_end", F.lag("end").over(order))
    return found(
        before,
        ("VAL-05.range", at, "start is not before end", F.coalesce(F.col("start") >= F.col("end"), F.lit(True))),
        ("VAL-05.headway", at, "headway below one second", F.coalesce(F.col("headway") < 1, F.lit(True))),
        ("VAL-05.overlap", at, "overlaps the window before", F.col("prev_end") > F.col("start")),
    )
