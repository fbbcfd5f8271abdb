"""Observation-date selection and exact, seeded, stratified sampling.

Sampling order: rows are ranked inside their stratum by
``md5(concat_ws('|', loan, month, seed))`` and then the loan id; the first ``n`` are
kept. The result depends only on the data and the seed (not on partitioning or
retries), so a lost executor recomputes the same rows.

No stratum is ever gathered into one task. The leading hex digits of the hash
split each stratum into ``16**digits`` buckets; a small histogram (partially
aggregated before its shuffle) locates the bucket in which the n-th row falls.
Rows in earlier buckets are kept outright, without a shuffle; only the rows of
that one boundary bucket (about stratum_size / 16**digits rows) are shuffled and
ranked exactly. The input is read three times (histogram, kept rows, boundary
rows): ``sample_panel`` checkpoints its input first.
"""

from __future__ import annotations

import datetime as _dt
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C

LOAN, MONTH = "Loan_Num", "Month"


def obs_month_ends(dates: list) -> list:
    """'YYYY-MM' strings -> month-end ``date`` objects (driver-side parameter list)."""
    out = []
    for s in dates:
        y, m = (int(x) for x in s.split("-"))
        nxt = _dt.date(y + (m == 12), m % 12 + 1, 1)
        out.append(nxt - _dt.timedelta(days=1))
    return out


def at_obs_dates(df: DataFrame, dates: list, month: str = MONTH) -> DataFrame:
    """Rows observed on the given months. Literal dates, so Parquet min/max statistics
    and partition filters apply."""
    return df.where(F.col(month).isin(obs_month_ends(dates)))


def performing(df: DataFrame, status: str = "Current_Delinquency_Status",
               zbc: str = "Zero_Balance_Code") -> DataFrame:
    """Loans still active and at most 60 days past due at the observation date."""
    return df.where(F.col(zbc).isNull() & F.col(status).isin(*C.PERFORMING_STATUSES))


def sample_hash(seed, key: str = LOAN, month: str = MONTH) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(month).cast("string"),
                             F.lit(str(seed))))


def stratified_sample(df: DataFrame, strata: list, n: int | None, seed=C.Settings().seed,
                      key: str = LOAN, month: str = MONTH, digits: int = 4) -> DataFrame:
    """``min(n, stratum size)`` rows of every stratum, without replacement.

    ``n=None`` keeps every row. ``seed=None`` draws a seed once on the driver, so
    recomputation stays consistent.
    """
    if n is None:
        return df
    if n < 1:
        raise ValueError("a stratum's sample size must be at least 1 (size // quarters // dates is 0?)")
    if seed is None:
        seed = random.SystemRandom().randrange(1 << 31)
    h = sample_hash(seed, key, month)
    d = (df.withColumn("_h", h)
         .withColumn("_b", F.conv(F.substring("_h", 1, digits), 16, 10).cast("long")))
    hist = d.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    cut = (hist.withColumn("_cum", F.sum("_c").over(w))
           .where((F.col("_cum") >= n) & (F.col("_cum") - F.col("_c") < n))
           .select(*[F.col(s).alias("_s_" + s) for s in strata], F.col("_b").alias("_bstar"),
                   (F.lit(n) - (F.col("_cum") - F.col("_c"))).alias("_take")))
    # one row per stratum holding more than n rows: bounded by the number of strata
    cond = [d[s].eqNullSafe(cut["_s_" + s]) for s in strata]
    j = d.join(F.broadcast(cut), cond, "left")
    drop = ["_h", "_b", "_bstar", "_take"] + ["_s_" + s for s in strata]
    # rows before the boundary bucket are kept where they are (no shuffle) ...
    whole = j.where(F.col("_bstar").isNull() | (F.col("_b") < F.col("_bstar")))
    # ... only the boundary bucket's rows (about stratum / 16**digits) are ranked
    edge = j.where(F.col("_b") == F.col("_bstar"))
    rw = Window.partitionBy(*strata).orderBy("_h", key)
    edge = edge.withColumn("_rn", F.row_number().over(rw)).where(F.col("_rn") <= F.col("_take"))
    return whole.drop(*drop).unionByName(edge.drop("_rn", *drop))


def sample_panel(df: DataFrame, train_dates: list, test_dates: list, train_size: int | None,
                 test_size: int | None, seed=C.Settings().seed, n_quarters: int = 1,
                 vintage=("Year", "Quarter"), materialize: bool = True):
    """Train and test sets: observation-date filter, performing loans, then an equal
    sample per (vintage, observation month). ``size // quarters // dates`` rows each."""
    base = performing(at_obs_dates(df, list(train_dates) + list(test_dates)))
    if materialize:
        # both sets and both passes of each sample read these few observation months:
        # write them once to the shared checkpoint folder instead of recomputing the input
        from ..session import checkpoint_dir
        checkpoint_dir(base.sparkSession)
        base = base.checkpoint(eager=True)
    strata = list(vintage) + [MONTH]
    n_tr = train_size // n_quarters // len(train_dates) if train_size is not None else None
    n_te = test_size // n_quarters // len(test_dates) if test_size is not None else None
    train = stratified_sample(at_obs_dates(base, train_dates), strata, n_tr, seed)
    test = stratified_sample(at_obs_dates(base, test_dates), strata, n_te, seed)
    return train, test


def train_test_split(df: DataFrame, train_dates: list, test_dates: list, train_size: int,
                     seed=C.Settings().seed, check: bool = True):
    """Train: ``train_size // len(dates)`` rows per observation month (error when a month
    holds fewer). Test: every row of the test months."""
    n = train_size // len(train_dates)
    # the check, both passes of the sample and the test set read these months: compute once
    from ..session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    df = at_obs_dates(df, list(train_dates) + list(test_dates)).checkpoint(eager=True)
    tr = at_obs_dates(df, train_dates)
    if check:
        # one row per observation month reaches the driver
        counts = {r[MONTH]: r["count"] for r in tr.groupBy(MONTH).count().collect()}
        short = [d for d in obs_month_ends(train_dates) if counts.get(d, 0) < n]
        if short:
            raise ValueError(f"observation months {short} hold fewer than {n} rows")
    return stratified_sample(tr, [MONTH], n, seed), at_obs_dates(df, test_dates)


def union_samples(train: DataFrame, test: DataFrame, label: str = "Set") -> DataFrame:
    return (train.withColumn(label, F.lit("train"))
            .unionByName(test.withColumn(label, F.lit("test")), allowMissingColumns=True))
