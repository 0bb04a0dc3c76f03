"""Quartile segments, shares and seasonality of aggregated sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcube.functions.measures import ratio, segment
from tillcube.operators.dedup import count_copies
from tillcube.operators.quantiles import quantiles

# Labels of the segments, highest first.
LABELS = ("top_25", "middle_50", "bottom_25")


def quartile_segments(members: DataFrame, measure: str) -> DataFrame:
    """Label every member by the quartiles of the measure over all members."""
    values = members.select(F.lit("all").alias("_all"), measure)
    quartiles = quantiles(count_copies(values), "_all", measure, "copies", (0.25, 0.75))
    low, high = quartiles.select("q0").scalar(), quartiles.select("q1").scalar()
    label = segment(F.col(measure).cast("double"), low, high, LABELS)
    return members.withColumn("segment", label)


def segment_summary(segments: DataFrame, member: str, measure: str) -> DataFrame:
    return segments.groupBy("segment").agg(
        F.count(member).alias("member_count"),
        F.sum(measure).alias("total_revenue"),
        (F.sum(measure).cast("double") / F.count(measure)).alias("avg_revenue"),
    )


def top_segment_share(segments: DataFrame, measure: str) -> DataFrame:
    """Percent of the total that the top segment holds."""
    in_top = F.sum(F.when(F.col("segment") == LABELS[0], F.col(measure)))
    share = ratio(in_top, F.sum(measure)) * 100
    return segments.agg(share.alias("top_segment_share"))


def seasonality(monthly: DataFrame, measure: str) -> DataFrame:
    """Best to worst month of the given monthly totals, 0 where the worst month sold nothing."""
    return monthly.agg(
        F.max(measure).alias("best_month_sales"),
        F.min(measure).alias("worst_month_sales"),
        ratio(F.max(measure), F.min(measure)).alias("seasonality_ratio"),
    )


def member_summary(members: DataFrame, measure: str, noun: str = "customer") -> DataFrame:
    """Count, mean, maximum and minimum over members as (metric, value) rows."""
    amount = F.col(measure)
    metrics = {
        f"number_of_{noun}s": F.count("*").cast("double"),
        f"average_revenue_per_{noun}": F.sum(amount).cast("double") / F.count(amount),
        f"max_{noun}_revenue": F.max(amount).cast("double"),
        f"min_{noun}_revenue": F.min(amount).cast("double"),
    }
    row = members.agg(*[column.alias(name) for name, column in metrics.items()])
    return row.unpivot([], list(metrics), "metric", "value")
