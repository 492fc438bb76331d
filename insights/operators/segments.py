"""Case 8 — interest segments: cleaning, coverage, composition and index rankings.

Inputs: ``metrics`` (month_year text 'MM-YYYY' or NULL, interest_id text,
composition, index_value, ranking, percentile_ranking) and ``interest_map``
(id, interest_name, interest_summary, created_at, last_modified).

Ratios of the float metrics are rounded through an integer (see
``functions.numeric``) and means of rounded values are taken over their
integer cents, so results do not depend on summation order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import parse_date
from ..functions.numeric import pct, ratio
from .patterns import top_k, top_k_per_group, top_k_with_ties
from .selection import global_ranks

MIN_MONTHS = 6


def _id_key() -> Column:
    return F.col("interest_id").try_cast("int")


def _named(df: DataFrame, interest_map: DataFrame, *cols: str) -> DataFrame:
    m = interest_map.select(F.col("id"), *cols)
    return df.join(m, _id_key() == F.col("id")).drop("id")


# ---- cleaning -----------------------------------------------------------------------------------
def month_year_to_date(metrics: DataFrame) -> DataFrame:
    """'MM-YYYY' text → first-of-month DATE (unparsable → NULL)."""
    return metrics.withColumn("month_year", parse_date("month_year", "MM-yyyy"))


def records_per_month(typed: DataFrame) -> DataFrame:
    return (typed.groupBy("month_year").agg(F.count(F.lit(1)).alias("record_count"))
            .orderBy(F.col("month_year").asc_nulls_first()))


def drop_null_months(typed: DataFrame) -> DataFrame:
    return typed.filter(F.col("month_year").isNotNull())


def ids_missing_in_map(filtered: DataFrame, interest_map: DataFrame) -> DataFrame:
    ids = filtered.select(_id_key().alias("iid")).filter(F.col("iid").isNotNull()).distinct()
    orphans = ids.join(interest_map.select(F.col("id").alias("iid")), "iid", "left_anti")
    return orphans.agg(F.countDistinct("iid").alias("nb_missing_in_map"))


def ids_missing_in_metrics(filtered: DataFrame, interest_map: DataFrame) -> DataFrame:
    ids = filtered.select(_id_key().alias("id")).distinct()
    orphans = interest_map.select("id").join(ids, "id", "left_anti")
    return orphans.agg(F.countDistinct("id").alias("orphan_map_ids"))


def map_duplicate_check(interest_map: DataFrame) -> DataFrame:
    return interest_map.agg(F.count(F.lit(1)).alias("total_records"), F.countDistinct("id").alias("unique_ids"))


def joined_interest_rows(filtered: DataFrame, interest_map: DataFrame, interest_id: int) -> DataFrame:
    """Metrics of one interest with every map column except the id."""
    f = filtered.filter(_id_key() == interest_id)
    return _named(f, interest_map, "interest_name", "interest_summary", "created_at", "last_modified")


def records_before_creation(filtered: DataFrame, interest_map: DataFrame) -> DataFrame:
    j = _named(filtered, interest_map, "created_at")
    return j.filter(F.col("month_year") < F.col("created_at").cast("date")) \
        .agg(F.count(F.lit(1)).alias("nb_records_before_creation"))


# ---- coverage -----------------------------------------------------------------------------------
def interest_months(filtered: DataFrame) -> DataFrame:
    return filtered.groupBy("interest_id").agg(F.countDistinct("month_year").alias("month_count"))


def qualified_interests(filtered: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """Interests present in at least ``min_months`` distinct months."""
    return interest_months(filtered).filter(F.col("month_count") >= min_months)


def per_qualified(filtered: DataFrame, *aggregates: Column, min_months: int = MIN_MONTHS) -> DataFrame:
    """``aggregates`` per interest of ``min_months`` distinct months or more.

    The months are counted in the same aggregate, so the rows are read once and pre-aggregated per
    (interest, month) before they move: no semi-join of the metrics with themselves.
    """
    per = filtered.groupBy("interest_id").agg(F.countDistinct("month_year").alias("month_count"), *aggregates)
    return per.filter(F.col("month_count") >= min_months)


def keep_qualified(monthly: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """Rows of the interests of ``min_months`` distinct months or more.

    ``monthly`` holds a bounded number of rows per interest and month (one, in the metrics), so the
    window over an interest is bounded by the calendar.
    """
    months = F.size(F.collect_set("month_year").over(Window.partitionBy("interest_id")))
    return monthly.withColumn("_months", months).filter(F.col("_months") >= min_months).drop("_months")


def interests_in_all_months(filtered: DataFrame, interest_map: DataFrame) -> DataFrame:
    """Relational division: interests whose month count equals the number of months.

    Both counts come from the months of each interest (a set bounded by the calendar), whose shuffle
    Spark runs once for the two.
    """
    sets = filtered.groupBy("interest_id").agg(F.collect_set("month_year").alias("months"))
    total = F.broadcast(sets.select(F.explode("months").alias("m")).agg(F.countDistinct("m").alias("total")))  # one row
    counted = sets.select("interest_id", F.size("months").cast("bigint").alias("month_count"))
    full = counted.crossJoin(total).filter(F.col("month_count") == F.col("total"))
    # compared null-safe: a plain equality would filter one side's rows before the sets are shared
    names = interest_map.filter(F.col("id").isNotNull()).select("id", "interest_name")
    return full.join(names, _id_key().eqNullSafe(F.col("id"))).select("interest_id", "interest_name", "month_count")


def cumulative_pct_by_months(filtered: DataFrame) -> DataFrame:
    """Cumulative % of interests, counted from the most months down.

    The windows run over one row per distinct month count.
    """
    freq = interest_months(filtered).groupBy(F.col("month_count").alias("total_months")) \
        .agg(F.count(F.lit(1)).alias("num_interests"))
    run = F.sum("num_interests").over(Window.orderBy(F.col("total_months").desc()))
    tot = F.sum("num_interests").over(Window.partitionBy())
    return freq.select("total_months", "num_interests", pct(run, tot).alias("cumulative_percentage"))


def rows_removed_below_threshold(filtered: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    per = filtered.groupBy("interest_id").agg(F.countDistinct("month_year").alias("month_count"),
                                              F.count(F.lit(1)).alias("n"))
    return per.filter(F.col("month_count") < min_months) \
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("removed_rows"))


def unique_interests_per_month(filtered: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    pairs = filtered.select("interest_id", "month_year").distinct()
    return keep_qualified(pairs, min_months).groupBy("month_year") \
        .agg(F.count("interest_id").alias("unique_interest_count"))


# ---- segment analysis -----------------------------------------------------------------------------
def top_bottom_composition(filtered: DataFrame, interest_map: DataFrame, k: int = 10,
                           min_months: int = MIN_MONTHS) -> DataFrame:
    """Top and bottom ``k`` interests by their maximum monthly composition.

    Each interest contributes its best month only (earliest month on ties);
    the global ranks keep ties without an un-partitioned window.
    """
    best = per_qualified(
        filtered, F.max(F.struct("composition", (-F.unix_date("month_year")).alias("day"))).alias("best"),
        min_months=min_months)
    named = _named(best, interest_map, "interest_name").select(
        "interest_name", F.date_from_unix_date(-F.col("best.day")).alias("month_year"), "best.composition")
    top = top_k_with_ties(named, "composition", k, descending=True).withColumn("category", F.lit(f"Top {k}"))
    bottom = top_k_with_ties(named, "composition", k, descending=False).withColumn("category", F.lit(f"Bottom {k}"))
    return top.unionByName(bottom).select("category", "interest_name", "month_year", "composition")


def composition_ranks(filtered: DataFrame) -> DataFrame:
    """Every interest's composition in every month, ranked over all of them from both ends (ties share a rank)."""
    rows = filtered.select("interest_id", "month_year", "composition")
    return global_ranks(rows, "composition", "rank_asc", "rank_desc", "dense_rank_asc")


def lowest_avg_ranking(filtered: DataFrame, interest_map: DataFrame, k: int = 5,
                       min_months: int = MIN_MONTHS) -> DataFrame:
    per = per_qualified(filtered, ratio(F.sum("ranking"), F.count("ranking")).alias("avg_ranking"),
                        min_months=min_months)
    named = _named(per, interest_map, "interest_name")
    return top_k(named, [F.col("avg_ranking").asc(), F.col("interest_id")], k) \
        .select("interest_id", "interest_name", "avg_ranking")


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def exact_stddev(c: str) -> Column:
    """Sample stddev of a 2-decimal column from exact integer moments (aggregate)."""
    x = _cents(c)
    n, s1, s2 = F.count(x), F.sum(x), F.sum(x * x)
    var = (n * s2 - s1 * s1).cast("double") / F.nullif((n * (n - 1)).cast("double"), F.lit(0.0))
    return F.sqrt(var) / 100.0


def most_volatile_interests(filtered: DataFrame, interest_map: DataFrame, k: int = 5,
                            min_months: int = MIN_MONTHS) -> DataFrame:
    """The ``k`` interests whose percentile_ranking varies most (sample stddev)."""
    per = per_qualified(filtered, (F.round(exact_stddev("percentile_ranking") * 100) / 100.0).alias("stddev_ranking"),
                        min_months=min_months)
    named = _named(per, interest_map, "interest_name")
    return top_k(named, [F.col("stddev_ranking").desc(), F.col("interest_name")], k) \
        .select("interest_name", "stddev_ranking")


def volatile_extremes(filtered: DataFrame, interest_map: DataFrame, k: int = 5,
                      min_months: int = MIN_MONTHS) -> DataFrame:
    """For the ``k`` most volatile interests: min percentile with its (earliest)
    month and max percentile with its (latest) month — one aggregate."""
    per = per_qualified(
        filtered, (F.round(exact_stddev("percentile_ranking") * 100) / 100.0).alias("stddev_percentile"),
        F.min(F.struct("percentile_ranking", "month_year")).alias("lo"),
        F.max(F.struct("percentile_ranking", "month_year")).alias("hi"), min_months=min_months)
    named = _named(per, interest_map, "interest_name")
    top = top_k(named, [F.col("stddev_percentile").desc(), F.col("interest_name")], k)
    return top.select("interest_name", F.col("lo.percentile_ranking").alias("min_percentile"),
                      F.col("lo.month_year").alias("month_year_min"),
                      F.col("hi.percentile_ranking").alias("max_percentile"),
                      F.col("hi.month_year").alias("month_year_max"), "stddev_percentile")


# ---- index analysis ---------------------------------------------------------------------------------
def avg_composition(filtered: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    """composition / index_value (the clients' average composition), 2 decimals."""
    q = keep_qualified(filtered, min_months)
    return q.select("month_year", "interest_id", ratio(F.col("composition"), F.col("index_value"))
                    .alias("avg_composition"))


def top10_avg_composition_per_month(filtered: DataFrame, interest_map: DataFrame, k: int = 10,
                                    min_months: int = MIN_MONTHS) -> DataFrame:
    ac = avg_composition(filtered, min_months)
    ranked = top_k_per_group(ac, "month_year", [F.col("avg_composition").desc()], k, ties=True,
                             rank_col="rank_in_month")
    return _named(ranked, interest_map, "interest_name") \
        .select("month_year", "interest_name", "avg_composition", F.col("rank_in_month").cast("int"))


def top10_appearances(filtered: DataFrame, interest_map: DataFrame, k: int = 10) -> DataFrame:
    t = top10_avg_composition_per_month(filtered, interest_map, k)
    return t.groupBy("interest_name").agg(F.count(F.lit(1)).alias("times_in_top10"))


def avg_of_top10_per_month(filtered: DataFrame, interest_map: DataFrame, k: int = 10) -> DataFrame:
    t = top10_avg_composition_per_month(filtered, interest_map, k)
    return t.groupBy("month_year").agg(
        ratio(F.sum(_cents("avg_composition")), F.count(F.lit(1)) * 100).alias("avg_of_avg_composition"))


def rolling_max_composition(filtered: DataFrame, interest_map: DataFrame, start: dt.date, end: dt.date,
                            min_months: int = MIN_MONTHS) -> DataFrame:
    """Monthly leader by average composition, its 3-month moving average and
    the leaders one and two months earlier; the date window is applied last
    so the first months still see their predecessors."""
    ac = avg_composition(filtered, min_months)
    lead = _named(ac, interest_map, "interest_name")
    leader = top_k_per_group(lead, "month_year", [F.col("avg_composition").desc(), F.col("interest_name")], 1,
                             ties=False)
    w = Window.orderBy("month_year")
    label = F.concat(F.col("interest_name"), F.lit(": "), F.col("avg_composition").cast("decimal(10,2)").cast("string"))
    cents = _cents("avg_composition")
    out = leader.select(
        "month_year", "interest_name", F.col("avg_composition").alias("max_index_composition"),
        ratio(F.sum(cents).over(w.rowsBetween(-2, 0)), F.count(cents).over(w.rowsBetween(-2, 0)) * 100)
        .alias("moving_avg_3m"),
        F.lag(label, 1).over(w).alias("one_month_ago"), F.lag(label, 2).over(w).alias("two_months_ago"))
    return out.filter(F.col("month_year").between(F.lit(start), F.lit(end)))
