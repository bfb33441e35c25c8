"""Anomalous hours: standardised features, forest scores, threshold, status and triage."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import fixed, numbers
from logloom.operators.guards import require_columns
from logloom.operators.isolation_forest import fit_forest
from logloom.sources.durable import durable

EXACT_QUANTILE_ROWS = 1_000_000
FENCE_ACCURACY = 100_000
FENCE_MARGIN = 4 / FENCE_ACCURACY


def complete_rows(hours: DataFrame, features: Sequence[str] = fixed.FEATURES) -> DataFrame:
    """Rows in which no feature is null."""
    require_columns(hours, *features)
    return hours.na.drop(subset=list(features))


@dataclass(frozen=True)
class Scaler:
    """Row count, share to flag, means and population deviations of a table's features; fitting is one aggregate over it."""

    rows: int
    share: float
    mean: dict[str, float]
    deviation: dict[str, float]

    @classmethod
    def fit(cls, hours: DataFrame, features: Sequence[str] = fixed.FEATURES) -> "Scaler":
        totals = hours.agg(
            F.count(F.lit(1)).alias("rows"),
            contamination(F.count(F.lit(1))).alias("share"),
            F.struct(*[F.avg(name).alias(name) for name in features]).alias("mean"),
            F.struct(*[F.stddev_pop(name).alias(name) for name in features]).alias("deviation"),
        ).first()
        return cls(totals["rows"], totals["share"], totals["mean"].asDict(), totals["deviation"].asDict())

    def transform(self, hours: DataFrame) -> DataFrame:
        """Add each feature as distance from its mean in deviations, named ``<feature>_Z``.

        A constant feature is only centred.
        """
        return hours.withColumns(
            {
                f"{name}_Z": (F.col(name) - F.lit(mean)) / F.lit(self.deviation[name] or 1.0)
                for name, mean in self.mean.items()
            }
        )


def contamination(rows: Column) -> Column:
    """Share of rows to flag, by number of rows."""
    tiers = [F.when(rows < below, F.lit(share)) for below, share in fixed.CONTAMINATION_TIERS]
    return F.coalesce(*tiers, F.lit(fixed.CONTAMINATION_DEFAULT))


def contamination_tier(hours: DataFrame) -> DataFrame:
    """One row: how many complete rows there are and which share of them will be flagged."""
    return complete_rows(hours).agg(F.count(F.lit(1)).alias("Windows")).withColumn(
        "Contamination", contamination(F.col("Windows"))
    )


def quantile(
    rows: DataFrame, column: str, share: float, count: int | None = None, exact_rows: int = EXACT_QUANTILE_ROWS
) -> float:
    """Exact quantile with linear interpolation.

    Spark's exact percentile gathers all distinct values in one task. While there are more than ``exact_rows``
    rows, approximate quantiles fence off a narrow range around the wanted rank and only the rows in it stay.
    """
    value = F.col(column)
    count = rows.count() if count is None else count
    position = (count - 1) * share
    while count > exact_rows:
        rank = position / (count - 1)
        ends = [max(rank - FENCE_MARGIN, 0.0), min(rank + FENCE_MARGIN, 1.0)]
        low, high = rows.agg(F.percentile_approx(value, ends, FENCE_ACCURACY)).first()[0]
        inside = value.between(low, high)
        below, kept = rows.agg(F.count_if(value < low), F.count_if(inside)).first()
        if not below <= position <= below + kept - 1:
            raise ArithmeticError(f"values between {low} and {high} do not hold rank {position}")
        if kept == count:  # a few values repeated over and over, which the percentile keeps as value and count
            break
        rows, position, count = rows.filter(inside), position - below, kept
    return rows.agg(F.percentile(value, position / max(count - 1, 1))).first()[0]


def flag_lowest(
    rows: DataFrame, raw: str, share: float, score: str, flag: str, count: int | None = None
) -> DataFrame:
    """Add ``score``, the distance of ``raw`` from its ``share`` quantile, and ``flag`` where it is negative."""
    offset = quantile(rows, raw, share, count)
    return rows.withColumn(score, F.col(raw) - F.lit(offset)).withColumn(flag, F.col(score) < 0)


def anomaly_scores(
    hours: DataFrame, features: Sequence[str] = fixed.FEATURES, scaler: Scaler | None = None, **forest
) -> DataFrame:
    """Add ``Anomaly_Score`` (negative = anomalous, lower = worse) and ``Is_Anomaly`` to the complete rows.

    ``hours`` is read several times: pass a stored table, and the ``scaler`` of its complete rows if there is one. Raises
    ``ValueError`` if it lacks a feature or has fewer than two complete rows.
    """
    rows = complete_rows(hours, features)
    scaler = scaler or Scaler.fit(rows, features)
    if scaler.rows < 2:
        raise ValueError("anomaly scoring needs two complete rows or more")
    scaled = scaler.transform(rows)
    model = fit_forest(scaled, [f"{name}_Z" for name in features], count=scaler.rows, **forest)
    scored = durable(model.score(scaled).select(*hours.columns, "Raw_Score"), "scores")
    return flag_lowest(
        scored, "Raw_Score", scaler.share, "Anomaly_Score", "Is_Anomaly", scaler.rows
    ).drop("Raw_Score")


def with_status(scores: DataFrame) -> DataFrame:
    """Add the printed status and the marker size of each window."""
    return scores.withColumns(
        {
            "Status": F.when(F.col("Is_Anomaly"), fixed.STATUS_ANOMALY).otherwise(fixed.STATUS_NORMAL),
            "dot_size": F.greatest(F.col("CSI_Count"), F.lit(fixed.SMALLEST_DOT).cast("bigint")),
        }
    )


def flagged(scores: DataFrame) -> DataFrame:
    return scores.filter("Is_Anomaly")


def anomaly_kpis(scores: DataFrame) -> DataFrame:
    """One row: number of windows, of flagged windows, and the flagged share in percent."""
    rate = F.coalesce(F.avg(F.col("Is_Anomaly").cast("int")) * 100, F.lit(0.0))
    return scores.agg(
        F.count(F.lit(1)).alias("Total_Windows"),
        F.count_if("Is_Anomaly").alias("Flagged_Windows"),
        rate.alias("Anomaly_Rate"),
        F.concat(numbers.decimals(rate, 1), F.lit("%")).alias("Anomaly_Rate_Text"),
    )


def anomaly_triage(scores: DataFrame, k: int = fixed.TRIAGE_ROWS) -> DataFrame:
    """The ``k`` worst flagged windows, worst first."""
    return (
        flagged(scores)
        .select("Hour_Window", "Total_Logs", "CBS_Count", "CSI_Count", "CSI_Ratio", "Anomaly_Score")
        .orderBy("Anomaly_Score", "Hour_Window")
        .limit(k)
    )
