"""Travel plans: totals, calendar joins, catalog consistency, interests, weather, budget.

Plans are documents (nested days and recommendations); over a table of plans the checks work on the exploded items.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: conditions that rule out outdoor activities
BLOCKED = ("thunderstorm", "rainy")
# words, our own choice, that mark an activity as indoor or backed up
INDOOR = ("indoor", "inside", "covered", "museum")


def plan_items(plans: DataFrame, keep: list[str]) -> DataFrame:
    """One row per recommended activity of a nested plan: plan columns, day and the activity's fields."""
    days = plans.select(*keep, F.posexplode("itinerary_days").alias("day_no", "d"))
    recs = days.select(*keep, "day_no", F.col("d.date").alias("day"), F.explode("d.recommendations").alias("r"))
    return recs.select(*keep, "day_no", "day", "r.activity.*")


def plan_totals(items: DataFrame, plans: DataFrame, key: str = "plan_id") -> DataFrame:
    """Stated total next to the sum of the activity prices; a plan without activities computes to 0."""
    sums = items.groupBy(key).agg(F.sum("price").alias("computed"))
    out = plans.select(key, "total_cost").join(sums, key, "left").withColumn("computed", F.coalesce("computed", F.lit(0)))
    return out.withColumn("matches", F.col("total_cost") == F.col("computed"))


def catalog_differences(items: DataFrame, catalog: DataFrame, id_col: str, compare: list[str]) -> DataFrame:
    """Items unknown to the catalog or different from it: id, kind {missing, mismatch} and the differing columns."""
    known = catalog.select(F.col(id_col).alias("__id"), *[F.col(c).alias(f"__{c}") for c in compare])
    joined = items.join(known, items[id_col] == known["__id"], "left")
    other = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in compare]))
    kind = F.when(F.col("__id").isNull(), "missing").when(F.size(other) > 0, "mismatch")
    out = joined.withColumn("kind", kind).withColumn("columns", F.when(F.col("kind") == "mismatch", other))
    return out.filter(F.col("kind").isNotNull()).select(*items.columns, "kind", "columns")


def interest_hits(travelers: DataFrame, activities: DataFrame, key: str = "plan_id") -> DataFrame:
    """Number of activities of the plan that share an interest with each traveler, 0 included.

    Activities are reduced to one row per (plan, interest set) with a count, so travelers meet distinct sets, by an
    equi-join on (plan, interest), and never single activities. ``travelers``: key, traveler, interests.
    """
    sets = activities.groupBy(key, F.array_sort(F.array_distinct("interests")).alias("set")).agg(F.count("*").alias("n"))
    offered = sets.select(key, "set", "n", F.explode("set").alias("interest"))
    wanted = travelers.select(key, "traveler", F.explode(F.array_distinct("interests")).alias("interest"))
    met = wanted.join(offered, [key, "interest"]).groupBy(key, "traveler", "set").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_set("interest")).alias("shared")
    )
    per = met.groupBy(key, "traveler").agg(
        F.sum("n").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("shared")))).alias("matched")
    )
    out = travelers.select(key, "traveler").join(per, [key, "traveler"], "left")
    return out.select(key, "traveler", F.coalesce("hits", F.lit(0)).alias("hits"),
                      F.coalesce("matched", F.array().cast("array<string>")).alias("matched"))


def date_spine(plans: DataFrame, start: str, end: str, day: str = "day") -> DataFrame:
    """One row per plan and date from start to end."""
    return plans.withColumn(day, F.explode(F.sequence(F.col(start), F.col(end))))


def is_indoor(*texts: Column) -> Column:
    low = F.lower(F.concat_ws(" ", *texts))
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in INDOOR])


def weather_conflict(condition: Column, *texts: Column) -> Column:
    """Message where an outdoor activity without an indoor option falls on a blocked condition, else null."""
    return F.when(condition.isin(*BLOCKED) & ~is_indoor(*texts), F.concat(F.lit("outdoor activity on "), condition))


def date_check(start: Column, end: Column, asked_start: Column, asked_end: Column) -> Column:
    """Message unless the plan covers exactly the asked dates in order."""
    return F.when(start > end, "dates out of order").when(
        (start != asked_start) | (end != asked_end), "dates differ from the request"
    )


def budget_check(total: Column, budget: Column) -> Column:
    return F.when(total > budget, F.concat(F.lit("over budget by "), (total - budget).cast("string")))


def total_check(stated: Column, computed: Column) -> Column:
    return F.when(~stated.eqNullSafe(computed), F.concat(F.lit("stated "), stated.cast("string"), F.lit(" computed "), computed.cast("string")))
