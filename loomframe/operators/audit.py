"""Audits: staleness, tracking error, grades, qualification, reasons, resumable runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

E = "episode_id"


def age_stats(ages: DataFrame, by: list[str], column: str = "age_ms") -> DataFrame:
    """Percentiles and maximum over finite ages, and how many are missing."""
    ok = F.col(column).isNotNull() & ~F.isnan(column)
    p = F.percentile(F.when(ok, F.col(column)), F.array(*map(F.lit, (0.5, 0.95, 0.99))))
    out = ages.groupBy(*by).agg(p.alias("p"), F.max(F.when(ok, F.col(column))).alias("max_ms"), F.count_if(~ok).alias("missing"))
    return out.select(*by, *[F.col("p")[i].alias(n) for i, n in enumerate(("p50_ms", "p95_ms", "p99_ms"))], "max_ms", "missing")


def tracking_error(aligned: DataFrame, by: list[str], a: str, b: str) -> DataFrame:
    """Mean error over components, and p95 and maximum of each row's largest."""
    e = F.zip_with(F.col(a), F.col(b), lambda x, y: F.abs(x - y))
    rows = aligned.withColumns({"worst": F.array_max(e), "mean": F.aggregate(e, F.lit(0.0), lambda s, x: s + x) / F.size(e)})
    return rows.groupBy(*by).agg(F.avg("mean").alias("mae"), F.percentile("worst", 0.95).alias("p95_max"), F.max("worst").alias("max"))


def dim_range(df: DataFrame, by: list[str], v: str) -> DataFrame:
    """Minimum and maximum of each dimension."""
    return df.select(*by, F.posexplode(v).alias("dim", "x")).groupBy(*by, "dim").agg(F.min("x").alias("min"), F.max("x").alias("max"))


def grade(metrics: DataFrame, levels: list[tuple[str, Column]], worst: str = "D") -> DataFrame:
    """The first letter whose condition holds. A missing metric must fail: conditions coalesce to False."""
    g = F.lit(worst)
    for letter, ok in reversed(levels):
        g = F.when(F.coalesce(ok, F.lit(False)), letter).otherwise(g)
    return metrics.withColumn("grade", g)


def regrade(stored: DataFrame, levels: list[tuple[str, Column]], worst: str = "D") -> DataFrame:
    """Stored metrics graded by other limits: a projection over the table, no recording is read again."""
    return grade(stored.drop("grade"), levels, worst)


def hand_range(frames: DataFrame, v: str, by: list[str], low: float = -0.05, high: float = 1.05) -> DataFrame:
    """Least and greatest hand state (a vector's last number) of each group, and whether both are in range; nothing finite isn't."""
    x = F.element_at(v, -1)
    x = F.when(~F.isnan(x), x)
    out = frames.groupBy(*by).agg(F.min(x).alias("least"), F.max(x).alias("most"))
    return out.withColumn("ok", F.coalesce((F.col("least") >= low) & (F.col("most") <= high), F.lit(False)))


def at_most(metric: str, limit: float) -> Column:
    return F.coalesce(F.col(metric), F.lit(float("inf"))) <= limit


def tenths(x: Column) -> Column:
    """A number as C's %.1f writes it: rounded by its exact binary value, ties to the even digit.

    format_string() rounds the shortest decimal form half up instead, so that 174683257.35, which is less than that, gets 174683257.4.
    """
    x = x.cast("double")
    word = F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf")
    whole = F.when(F.abs(x).between(2.0**53, 2.0**62), F.concat(x.cast("long"), F.lit(".0")))  # format_number() has 17 digits at most
    return F.coalesce(word, whole, F.call_function("format_number", x, F.lit("0.0")))


def qualify(metrics: DataFrame, tiers: dict[str, dict[str, float]]) -> DataFrame:
    """For each tier its reasons against (metric_value) and whether there are none. Missing metrics fail."""
    out = metrics
    for tier, limits in tiers.items():
        reasons = F.array_compact(F.array(*[F.when(~at_most(m, x), F.concat(F.lit(f"{m}_"), F.coalesce(tenths(F.col(m)), F.lit("missing")))) for m, x in limits.items()]))
        out = out.withColumn(f"{tier}_reasons", reasons).withColumn(tier, F.size(f"{tier}_reasons") == 0)
    return out


def reason_counts(df: DataFrame, reasons: str, cut: str = "_") -> DataFrame:
    """How often each reason occurs, without its value."""
    return df.select(F.explode(reasons).alias("r")).select(F.regexp_replace("r", f"{cut}[^{cut}]*$", "").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def tier_counts(df: DataFrame, tiers: list[str]) -> DataFrame:
    return df.agg(F.count("*").alias("total"), *[F.count_if(F.col(t)).alias(t) for t in tiers])


def grade_counts(df: DataFrame, letters: str = "ABCD") -> DataFrame:
    """Counts of all grades, those without a recording too."""
    every = df.sparkSession.createDataFrame([(x,) for x in letters], "grade string")
    return every.join(df.groupBy("grade").agg(F.count("*").alias("n")), "grade", "left").select("grade", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def pending_jobs(inputs: DataFrame, done: DataFrame, fingerprint: list[str]) -> DataFrame:
    """Inputs without a finished result of the same fingerprint."""
    return inputs.join(done.select(*fingerprint).distinct(), fingerprint, "left_anti")


def split_failures(df: DataFrame, error: Column) -> tuple[DataFrame, DataFrame]:
    """Rows without and with an error; a bad recording doesn't stop the batch."""
    marked = df.withColumn("error", error)
    return marked.where("error is null").drop("error"), marked.where("error is not null")


def success_rate(df: DataFrame, success: Column) -> DataFrame:
    return df.agg(F.count("*").alias("episodes"), F.count_if(success).alias("successes"), (F.count_if(success) / F.count("*")).alias("rate"))


def index_recordings(df: DataFrame, path: str) -> DataFrame:
    """Ordinal of each recording by its path. One row a recording reaches the one ordered window."""
    return df.select(path).distinct().withColumn("ordinal", (F.row_number().over(Window.orderBy(path)) - 1).cast("long"))
