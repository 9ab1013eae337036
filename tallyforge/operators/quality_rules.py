"""Quality rules over metrics (R1-R8), each as one set-based plan.

Metrics: ticker, reporting_date, period_type, reporting_standard, metric_name,
value, currency, unit. A warning row has the keys, code and affected metrics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHAPE = ("ticker", "period_type", "reporting_standard")
PERIOD = (*SHAPE, "reporting_date")
TOLERANCE = 0.005
LARGEST_RATIO = 10.0


def _value(name: str) -> Column:
    return F.max(F.when(F.col("metric_name") == name, F.col("value")))


def _warning(df: DataFrame, code: str, affected: tuple[str, ...], *extra: str) -> DataFrame:
    names = F.array(*(F.lit(a) for a in affected)) if affected else F.array().cast("array<string>")
    return df.select(*extra, F.lit(code).alias("code"), names.alias("affected"))


def balance_mismatch(metrics: DataFrame, by: tuple[str, ...] = PERIOD) -> DataFrame:
    """Assets differ from equity and liabilities by more than half a per cent."""
    wide = metrics.groupBy(*by).agg(_value("total_assets").alias("a"), _value("total_equity").alias("e"), _value("total_liabilities").alias("l"))
    bad = wide.where(F.abs(F.col("a") - (F.col("e") + F.col("l"))) > F.abs("a") * TOLERANCE)
    return _warning(bad, "balance_mismatch", ("total_assets", "total_equity", "total_liabilities"), *by)


def negative_signs(metrics: DataFrame, by: tuple[str, ...] = PERIOD) -> DataFrame:
    """R2: assets and revenue must not be negative."""
    bad = metrics.where(F.col("metric_name").isin("total_assets", "revenue") & (F.col("value") < 0))
    code = F.when(F.col("metric_name") == "total_assets", "negative_assets").otherwise("negative_revenue")
    return bad.select(*by, code.alias("code"), F.array("metric_name").alias("affected"))


def previous_periods(metrics: DataFrame) -> DataFrame:
    """For each period the nearest earlier one of the same shape.

    Periods, not metrics, are lagged: a metric missing in the previous period
    is compared with nothing. Keys are reduced before the window.
    """
    keys = metrics.select(*PERIOD).distinct()
    before = F.lag("reporting_date").over(Window.partitionBy(*SHAPE).orderBy("reporting_date"))
    return keys.withColumn("previous_date", before)


def with_previous(metrics: DataFrame) -> DataFrame:
    """Each metric row with the value of its previous period, if that has one."""
    dated = metrics.join(previous_periods(metrics).where("previous_date is not null"), list(PERIOD))
    old = metrics.select(*SHAPE, F.col("reporting_date").alias("previous_date"), "metric_name", F.col("value").alias("previous_value"))
    return dated.join(old, [*SHAPE, "previous_date", "metric_name"])


def suspicious_change(metrics: DataFrame) -> DataFrame:
    """Both values present and not zero, and more than ten times apart."""
    both = with_previous(metrics).where("value <> 0 and previous_value <> 0")
    c, p = F.abs("value"), F.abs("previous_value")
    return both.where(F.greatest(c, p) / F.least(c, p) > LARGEST_RATIO)


def mixed(metrics: DataFrame, column: str, code: str, by: tuple[str, ...]) -> DataFrame:
    """More than one currency or unit (empty ones do not count)."""
    found = metrics.groupBy(*by).agg(F.array_sort(F.collect_set(F.nullif(F.col(column), F.lit("")))).alias("values"))
    return found.where(F.size("values") > 1).withColumn("code", F.lit(code))


def applicable(specs: DataFrame, strict: bool) -> Column:
    """Whether a spec holds for a standard. Empty sources: for all unless ``strict``."""
    listed = F.array_contains("only_in_sources", F.col("reporting_standard"))
    open_spec = F.col("only_in_sources").isNull() if strict else F.col("only_in_sources").isNull() | (F.size("only_in_sources") == 0)
    return open_spec | F.coalesce(listed, F.lit(False))


def completeness(metrics: DataFrame, specs: DataFrame, by: tuple[str, ...], threshold: float = 0.5) -> DataFrame:
    """Requested and extracted counts and whether the share is under the threshold.

    ``metrics`` has a profile; ``specs``: profile, metric_name, only_in_sources.
    """
    keys = tuple(dict.fromkeys((*by, "profile", *PERIOD)))
    periods = metrics.select(*keys).distinct()
    wanted = periods.join(F.broadcast(specs), "profile").where(applicable(specs, True)).select(*keys, "metric_name")
    have = metrics.where("value is not null").groupBy(*keys, "metric_name").agg(F.count("*").alias("n"))
    counted = wanted.join(have, [*keys, "metric_name"], "left").groupBy(*by).agg(F.count("*").alias("requested"), F.coalesce(F.sum("n"), F.lit(0)).alias("extracted"))
    return counted.withColumn("is_incomplete", F.col("extracted") / F.col("requested") < threshold)


def attach(metrics: DataFrame, warnings: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Codes of the warnings that touch each row: those of its name, in any period, and those of all."""
    grouped = warnings.groupBy(*by).agg(F.collect_set(F.struct("code", "affected")).alias("w"))
    joined = metrics.join(grouped, list(by), "left")
    hit = F.filter("w", lambda w: (F.size(w["affected"]) == 0) | F.array_contains(w["affected"], F.col("metric_name")))
    codes = F.array_sort(F.array_distinct(F.transform(hit, lambda w: w["code"])))
    return joined.withColumn("qa_codes", F.when(F.size(codes) > 0, codes)).drop("w")


def dedup_rows(rows: DataFrame, key: tuple[str, ...], seq: str = "seq", value: str = "value") -> DataFrame:
    """Per key the last row with a value, or the first row if none has one."""
    rest = [c for c in rows.columns if c not in key]
    has = F.col(value).isNotNull()
    order = F.struct(has.alias("has"), F.when(has, F.col(seq)).otherwise(-F.col(seq)).alias("at"))
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*key, *(F.col("_best")[c].alias(c) for c in rest))
