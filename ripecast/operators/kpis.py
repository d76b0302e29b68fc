"""Revenue KPIs of a policy evaluation. All of them are aggregates with a map-side partial step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripecast import constants as K
from ripecast.functions import expiry_bucket, money_round, safe_corr, uplift


def with_expiry(evaluation: DataFrame, frame: DataFrame | None = None) -> DataFrame:
    """Evaluation rows with time_to_expiry, joined from the frame unless the sweep already kept it."""
    if frame is None:
        return evaluation
    return evaluation.join(frame.select(*K.KEYS, "time_to_expiry"), K.KEYS)


def overall(evaluation: DataFrame, frame: DataFrame | None = None) -> DataFrame:
    """One row of totals, average discounts and the correlation of discount and days left."""
    base, policy = F.col("baseline_revenue"), F.col("policy_revenue")
    gain = F.sum(policy - base)
    return with_expiry(evaluation, frame).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(base).alias("baseline_rev"),
        F.sum(policy).alias("policy_rev"),
        gain.alias("uplift_abs"),
        F.try_divide(gain, F.sum(base)).alias("uplift_pct"),
        F.avg("baseline_discount_pct").alias("avg_baseline_discount"),
        F.avg("policy_discount_pct").alias("avg_policy_discount"),
        safe_corr(F.col("policy_discount_pct"), F.col("time_to_expiry")).alias("corr_discount_vs_expiry"),
    )


def _revenues() -> list:
    base, policy = F.col("baseline_revenue"), F.col("policy_revenue")
    return [
        F.sum(base).alias("baseline_rev"),
        F.sum(policy).alias("policy_rev"),
        uplift(policy, base).alias("uplift_pct"),
    ]


def by_date(evaluation: DataFrame) -> DataFrame:
    return evaluation.groupBy("date").agg(*_revenues()).orderBy("date")


def by_expiry(evaluation: DataFrame, frame: DataFrame | None = None) -> DataFrame:
    return (
        with_expiry(evaluation, frame)
        .groupBy(expiry_bucket(F.col("time_to_expiry")).alias("expiry_bucket"))
        .agg(*_revenues(), F.avg("policy_discount_pct").alias("avg_policy_discount"))
        .orderBy("expiry_bucket")
    )


def discount_distribution(evaluation: DataFrame) -> DataFrame:
    return (
        evaluation.groupBy(money_round(F.col("policy_discount_pct"), 1).alias("discount_bin"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .orderBy("discount_bin")
    )


def revenue_gap(daily: DataFrame) -> DataFrame:
    """Daily KPIs with the gap of policy over baseline."""
    return daily.withColumn("gap", F.col("policy_rev") - F.col("baseline_rev"))


def peak_gap(daily: DataFrame) -> DataFrame:
    """Day of the largest gap, and of the smallest if that is another day and a loss; the earlier day wins a tie."""
    gaps = revenue_gap(daily).where(F.col("gap").isNotNull())
    day = F.struct("date", "baseline_rev", "policy_rev", "gap")
    order = F.unix_date("date")
    ends = gaps.agg(
        F.max_by(day, F.struct("gap", -order)).alias("top"),
        F.min_by(day, F.struct("gap", order)).alias("low"),
    ).where(F.col("top").isNotNull())
    loss = (F.col("low.gap") < 0) & (F.col("low.date") != F.col("top.date"))
    peaks = F.array(
        F.struct(F.lit("peak_positive").alias("kind"), F.col("top").alias("d")),
        F.when(loss, F.struct(F.lit("peak_negative").alias("kind"), F.col("low").alias("d"))),
    )
    return ends.select(F.explode(F.filter(peaks, lambda p: p.isNotNull())).alias("p")).select("p.kind", "p.d.*")


def uplift_points(by_bucket: DataFrame) -> DataFrame:
    """Bucket KPIs with the uplift in percentage points, in the buckets' fixed order."""
    names = [name for _, name in K.EXPIRY_BUCKETS] + [K.EXPIRY_BUCKET_LAST]
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("expiry_bucket"))
    return (
        by_bucket.withColumn("uplift_pct_pp", F.col("uplift_pct") * 100.0)
        .withColumn("bucket_order", place.cast("long"))
        .orderBy("bucket_order")
    )


def peak_uplift(by_bucket: DataFrame) -> DataFrame:
    """Bucket with the largest uplift; the earlier bucket wins a tie."""
    points = uplift_points(by_bucket).where(F.col("uplift_pct").isNotNull())
    top = F.max_by(F.struct("expiry_bucket", "uplift_pct_pp"), F.struct("uplift_pct_pp", -F.col("bucket_order")))
    return points.agg(top.alias("t")).where(F.col("t").isNotNull()).select("t.*")


# --- day states: the KPIs from mergeable sums, so that a new day reads its own rows only ---

STATE = (
    "date DATE, expiry_bucket STRING, discount_bin DOUBLE, n_rows BIGINT, baseline_rev DOUBLE, policy_rev DOUBLE, gain DOUBLE, "
    "baseline_discount DOUBLE, n_baseline_discount BIGINT, policy_discount DOUBLE, n_policy_discount BIGINT, "
    "n_pairs BIGINT, mean_discount DOUBLE, mean_expiry DOUBLE, m2_discount DOUBLE, m2_expiry DOUBLE, co_moment DOUBLE"
)


def day_states(evaluation: DataFrame) -> DataFrame:
    """One row per day, expiry bucket and discount bin: counts, sums, and the moments of discount and days left.

    The rows of different days or slices add up to the KPIs of all of them; moments are kept around their own means, so
    merging them loses nothing to cancellation.
    """
    base, policy = F.col("baseline_revenue"), F.col("policy_revenue")
    both = F.col("policy_discount_pct").isNotNull() & F.col("time_to_expiry").isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in ("policy_discount_pct", "time_to_expiry"))
    pairs = F.count_if(both)
    return evaluation.groupBy(
        "date",
        expiry_bucket(F.col("time_to_expiry")).alias("expiry_bucket"),
        money_round(F.col("policy_discount_pct"), 1).alias("discount_bin"),
    ).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(base).alias("baseline_rev"),
        F.sum(policy).alias("policy_rev"),
        F.sum(policy - base).alias("gain"),
        F.sum("baseline_discount_pct").alias("baseline_discount"),
        F.count("baseline_discount_pct").alias("n_baseline_discount"),
        F.sum("policy_discount_pct").alias("policy_discount"),
        F.count("policy_discount_pct").alias("n_policy_discount"),
        pairs.alias("n_pairs"),
        F.avg(x).alias("mean_discount"),
        F.avg(y).alias("mean_expiry"),
        (F.var_pop(x) * pairs).alias("m2_discount"),
        (F.var_pop(y) * pairs).alias("m2_expiry"),
        (F.covar_pop(x, y) * pairs).alias("co_moment"),
    )


def overall_of(states: DataFrame) -> DataFrame:
    """``overall`` from day states: moments are carried to the common mean and added."""
    n = F.col("n_pairs")
    mean = lambda c: states.agg(F.try_divide(F.sum(n * F.col(c)), F.sum(n)).alias("mean")).scalar()
    dx, dy = F.col("mean_discount") - mean("mean_discount"), F.col("mean_expiry") - mean("mean_expiry")
    moved = states.select("*", dx.alias("dx"), dy.alias("dy"))
    total = lambda m, a, b: F.sum(F.col(m) + n * F.col(a) * F.col(b))
    spread = F.sqrt(total("m2_discount", "dx", "dx")) * F.sqrt(total("m2_expiry", "dy", "dy"))
    return moved.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        F.sum("baseline_rev").alias("baseline_rev"),
        F.sum("policy_rev").alias("policy_rev"),
        F.sum("gain").alias("uplift_abs"),
        F.try_divide(F.sum("gain"), F.sum("baseline_rev")).alias("uplift_pct"),
        F.try_divide(F.sum("baseline_discount"), F.sum("n_baseline_discount")).alias("avg_baseline_discount"),
        F.try_divide(F.sum("policy_discount"), F.sum("n_policy_discount")).alias("avg_policy_discount"),
        F.try_divide(total("co_moment", "dx", "dy"), spread).alias("corr_discount_vs_expiry"),
    )


def _revenue_sums() -> list:
    base, policy = F.sum("baseline_rev"), F.sum("policy_rev")
    return [base.alias("baseline_rev"), policy.alias("policy_rev"), F.try_divide(policy - base, base).alias("uplift_pct")]


def by_date_of(states: DataFrame) -> DataFrame:
    return states.groupBy("date").agg(*_revenue_sums()).orderBy("date")


def by_expiry_of(states: DataFrame) -> DataFrame:
    discount = F.try_divide(F.sum("policy_discount"), F.sum("n_policy_discount")).alias("avg_policy_discount")
    return states.groupBy("expiry_bucket").agg(*_revenue_sums(), discount).orderBy("expiry_bucket")


def discount_distribution_of(states: DataFrame) -> DataFrame:
    return states.groupBy("discount_bin").agg(F.sum("n_rows").alias("n_rows")).orderBy("discount_bin")
