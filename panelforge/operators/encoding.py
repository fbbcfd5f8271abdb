"""Binary feature encoding as a fit/transform model.

``fit`` computes which columns hold nulls (one aggregate) and the exact percentile
cut points of every continuous column (``threshold_table``); only those per-column
summaries (a few numbers each) reach the driver. ``transform`` is one ``select`` of
indicator expressions, so it stays in whole-stage codegen and can be applied to
any frame (train, test, a fresh month of data) with identical output columns.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C
from ..functions import floor_to, rint2

CONTINUOUS_TYPES = (T.DoubleType, T.LongType)


def null_profile(df: DataFrame, cols: list | None = None) -> DataFrame:
    """(col_name, null_count) for the columns that hold at least one null."""
    cols = df.columns if cols is None else cols
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])
    long = counts.unpivot([], cols, "col_name", "null_count")
    return long.where(F.col("null_count") > 0)


def percent_points(num_thresholds: int) -> list:
    """Percentiles 5, 5+step, ... < 100 with step = round(100 / num_thresholds)."""
    step = round(100 / num_thresholds)
    return [float(q) for q in np.arange(5, 100, step)]


def continuous_columns(df: DataFrame, exclude=C.ENCODER_KEY_COLUMNS, also=()) -> list:
    """Columns encoded by thresholds: double and bigint columns except keys/target."""
    out = []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, CONTINUOUS_TYPES) or f.name in also:
            out.append(f.name)
    return out


def exact_percentiles(long: DataFrame, qs: list, key: str = "col_name", value: str = "v",
                      slice_rows: int = 1_000_000) -> DataFrame:
    """Exact linear-interpolation percentiles per ``key`` without gathering a column in
    one task: (key, thresholds array in the order of ``qs``).

    1. distinct values with their counts (partially aggregated before the shuffle);
    2. those rows are range-partitioned on (key, value) into ordered slices of about
       ``slice_rows`` distinct values (Spark samples the bounds); a hot value is one row;
    3. counts per (key, slice) give each slice's first rank (a window over at most
       #slices rows per key);
    4. only the slices holding a wanted rank are ranked internally, each in its own
       window partition; interpolation as numpy's 'linear' method.
    """
    spark = long.sparkSession
    # the input is read once: its distinct values are written to the shared checkpoint folder
    vf = long.groupBy(key, value).agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True)
    n_distinct = vf.count()
    slices = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_distinct // slice_rows), 1)
    vf = vf.repartitionByRange(slices, key, value).withColumn("_sl", F.spark_partition_id())
    vf = vf.checkpoint(eager=True)          # slice ids must be stable across the reads below
    per = vf.groupBy(key, "_sl").agg(F.sum("_c").alias("_sc"))
    w = Window.partitionBy(key).orderBy("_sl").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("_end", F.sum("_sc").over(w)).withColumn("_start", F.col("_end") - F.col("_sc"))
    n = per.groupBy(key).agg(F.max("_end").alias("_n"))
    # wanted 0-based ranks: floor and ceil of (n - 1) * q for every q
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    tg = n.select(key, "_n", F.posexplode(qarr).alias("_qi", "_q"))
    tg = tg.withColumn("_pos", (F.col("_n") - 1).cast("double") * F.col("_q"))
    ranks = tg.select(key, F.explode(F.array(F.floor("_pos"), F.ceil("_pos"))).alias("_r")).distinct()
    loc = (ranks.join(per, [key]).where((F.col("_r") >= F.col("_start")) & (F.col("_r") < F.col("_end")))
           .select(key, "_sl", "_r", "_start"))
    rw = Window.partitionBy(key, "_sl").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (vf.join(loc.select(key, "_sl").distinct(), [key, "_sl"], "left_semi")
              .withColumn("_hi", F.sum("_c").over(rw)).withColumn("_lo", F.col("_hi") - F.col("_c")))
    at = (loc.join(ranked, [key, "_sl"])
          .where((F.col("_r") - F.col("_start") >= F.col("_lo")) & (F.col("_r") - F.col("_start") < F.col("_hi")))
          .select(key, "_r", F.col(value).alias("_v")))
    lo = at.select(key, F.col("_r").alias("_rl"), F.col("_v").alias("_a"))
    hi = at.select(key, F.col("_r").alias("_rh"), F.col("_v").alias("_b"))
    res = (tg.withColumn("_rl", F.floor("_pos")).withColumn("_rh", F.ceil("_pos"))
           .join(lo, [key, "_rl"]).join(hi, [key, "_rh"])
           .withColumn("_t", F.col("_pos") - F.col("_rl")))
    d = F.col("_b") - F.col("_a")
    lerp = F.when(F.col("_t") >= 0.5, F.col("_b") - d * (F.lit(1.0) - F.col("_t"))).otherwise(F.col("_a") + d * F.col("_t"))
    res = res.withColumn("_p", F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise(lerp))
    return (res.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("_qi", "_p"))).alias("_s"))
            .select(key, F.transform("_s", lambda x: x["_p"]).alias("_p")))


def threshold_table(df: DataFrame, cols: list, num_thresholds: int, approx: bool = False,
                    accuracy: int = 100_000, floor50=("Credit_Score",)) -> DataFrame:
    """(col_name, thresholds array) computed by Spark: exact linear-interpolation
    percentiles of the non-null values, rounded to 2 decimals (credit score: floored to
    a multiple of 50), de-duplicated and sorted. The columns are unpivoted into
    (col_name, value).

    ``exact_percentiles`` never holds a column in one task, at any size. ``approx=True``
    uses the bounded-memory sketch instead."""
    qs = [q / 100.0 for q in percent_points(num_thresholds)]
    if not cols:
        return df.sparkSession.createDataFrame([], "col_name string, thresholds array<double>")
    long = (df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
            .unpivot([], cols, "col_name", "v").where(F.col("v").isNotNull()))
    arr = F.lit(qs)
    if approx:
        t = long.groupBy("col_name").agg(F.percentile_approx("v", arr, accuracy).alias("_p"))
    else:
        t = exact_percentiles(long, qs)
    rounded = F.when(F.col("col_name").isin(*floor50),
                     F.transform("_p", lambda x: floor_to(x, 50.0))).otherwise(
        F.transform("_p", lambda x: rint2(x)))
    return t.select("col_name", F.array_sort(F.array_distinct(rounded)).alias("thresholds"))


def _fmt(v: float) -> str:
    """Threshold as printed in column names: Python float repr (``80.0``, ``0.35``)."""
    return str(float(v))


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass
class BinaryEncoderModel:
    missing_cols: list
    yn_columns: list
    categorical_mappings: dict
    thresholds: dict            # col -> sorted list of floats
    missing_names: dict = field(default_factory=lambda: dict(C.MISSING_INDICATOR_NAMES))

    def output_plan(self, columns: list):
        """Column expressions of the encoded frame, in output order."""
        # 1. original columns, then missing indicators
        cols = [(c, _c(c)) for c in columns]
        for c in self.missing_cols:
            name = self.missing_names.get(c, f"{c} is Missing")
            cols.append((name, _c(c).isNull().cast("byte")))
        # 2. category and Y/N indicators (0 for null or unmapped values), sources dropped
        enc = [(f"{c} = Yes", c, "Y") for c in self.yn_columns]
        enc += [(f"{c} = {label}", c, v) for c, m in self.categorical_mappings.items() for v, label in m]
        for name, c, v in enc:
            cols.append((name, F.when(_c(c) == F.lit(v), F.lit(1)).otherwise(F.lit(0))))
        dropped = set(self.yn_columns) | set(self.categorical_mappings)
        cols = [x for x in cols if x[0] not in dropped]
        # 3. threshold indicators (null stays null), sources dropped
        for c, ts in self.thresholds.items():
            for t in ts:
                cols.append((f"{c} <= {_fmt(t)}", (_c(c) <= F.lit(float(t))).cast("byte")))
        cols = [x for x in cols if x[0] not in set(self.thresholds)]
        return cols

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[e.alias(n) for n, e in self.output_plan(df.columns)])

    def feature_names(self, columns: list) -> list:
        return [n for n, _ in self.output_plan(columns)]

    def vector_plan(self, schema: T.StructType) -> list:
        """Blocks (kind, source column, argument) of the feature vector, in the order that the
        numeric columns of ``transform`` have: ``raw`` values, ``null`` and ``equal`` indicators,
        ``below``: the thermometer of a column's sorted cut points."""
        dropped = {*self.yn_columns, *self.categorical_mappings, *self.thresholds, *C.ENCODER_KEY_COLUMNS}
        numeric = (T.NumericType, T.BooleanType)
        blocks = [("raw", f.name, None) for f in schema.fields if f.name not in dropped and isinstance(f.dataType, numeric)]
        blocks += [("null", c, self.missing_names.get(c, f"{c} is Missing")) for c in self.missing_cols]
        blocks += [("equal", c, "Y") for c in self.yn_columns]
        blocks += [("equal", c, v) for c, m in self.categorical_mappings.items() for v, _ in m]
        return blocks + [("below", c, ts) for c, ts in self.thresholds.items()]

    def transform_vectors(self, df: DataFrame, out: str = "features", missing: float = 0.0) -> DataFrame:
        """The key columns of ``df`` and ``out``: the numeric columns of ``transform`` as one sparse
        vector, null values as ``missing``. A thermometer costs one binary search per row and
        source column, however many cut points it has, and no indicator column is ever made."""
        blocks = self.vector_plan(df.schema)
        sources = list(dict.fromkeys(c for _, c, _ in blocks))
        keys = [c for c in C.ENCODER_KEY_COLUMNS if c in df.columns]
        size = sum(len(a) if kind == "below" else 1 for kind, _, a in blocks)
        schema = T.StructType([*(df.schema[c] for c in keys), T.StructField(out, VectorUDT())])
        numeric = {c for kind, c, _ in blocks if kind in ("raw", "below")}

        def run(batches):
            for batch in batches:
                n, at, found = batch.num_rows, 0, []
                cols = {c: batch.column(len(keys) + i) for i, c in enumerate(sources)}
                nulls = {c: v.is_null().to_numpy(zero_copy_only=False) for c, v in cols.items()}
                values = {c: cols[c].fill_null(0).to_numpy(zero_copy_only=False) for c in numeric}
                for kind, c, arg in blocks:
                    if kind == "below":
                        # v <= t holds from the first cut point that is not below v (NaN is greatest)
                        first = np.searchsorted(arg, values[c], side="left")
                        first[nulls[c]] = 0 if missing else len(arg)
                        width = len(arg) - first
                        row = np.repeat(np.arange(n), width)
                        index = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width) + first[row] + at
                        found.append((row, index, np.where(nulls[c][row], missing, 1.0)))
                        at += len(arg)
                        continue
                    if kind == "raw":
                        x = np.where(nulls[c], missing, values[c])
                    elif kind == "null":
                        x = nulls[c].astype(float)
                    else:
                        x = pc.fill_null(pc.equal(cols[c], arg), False).to_numpy(zero_copy_only=False).astype(float)
                    row = np.flatnonzero(x)
                    found.append((row, np.full(len(row), at), x[row]))
                    at += 1
                row, index, value = (np.concatenate([f[k] for f in found] or [np.zeros(0)]) for k in range(3))
                order = np.lexsort((index, row))
                ends = pa.array(np.r_[0, np.cumsum(np.bincount(row.astype(int), minlength=n))].astype(np.int32))
                vector = pa.StructArray.from_arrays(
                    [pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)),
                     pa.ListArray.from_arrays(ends, pa.array(index[order].astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(value[order].astype(float)))],
                    names=["type", "size", "indices", "values"])
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(keys)], vector], names=[*keys, out])

        cast = [_c(c).cast("double") if c in numeric else _c(c) for c in sources]
        return df.select(*[_c(c) for c in keys], *[e.alias(f"s{i}") for i, e in enumerate(cast)]).mapInArrow(run, schema)

    def to_json(self) -> str:
        return json.dumps({"missing_cols": self.missing_cols, "yn_columns": self.yn_columns,
                           "categorical_mappings": self.categorical_mappings,
                           "thresholds": self.thresholds, "missing_names": self.missing_names})

    @staticmethod
    def from_json(s: str) -> "BinaryEncoderModel":
        d = json.loads(s)
        d["categorical_mappings"] = {k: [tuple(x) for x in v] for k, v in d["categorical_mappings"].items()}
        return BinaryEncoderModel(**d)


@dataclass
class BinaryEncoder:
    """Missing indicators, category one-hots, Y/N flags and percentile thresholds."""
    yn_columns: list = field(default_factory=lambda: list(C.YN_COLUMNS))
    categorical_mappings: dict = field(default_factory=lambda: dict(C.CATEGORICAL_MAPPINGS))
    num_thresholds: int = 20
    approx: bool = False
    also_continuous: tuple = ()

    def fit(self, df: DataFrame) -> BinaryEncoderModel:
        missing = [r["col_name"] for r in null_profile(df).collect()]
        order = {c: i for i, c in enumerate(df.columns)}
        missing.sort(key=order.get)
        # thresholds are computed on the frame after categorical encoding, whose int
        # indicator columns are never continuous: only the surviving source columns count
        dropped = set(self.yn_columns) | set(self.categorical_mappings)
        cont = [c for c in continuous_columns(df, also=self.also_continuous) if c not in dropped]
        rows = threshold_table(df, cont, self.num_thresholds, approx=self.approx).collect()
        found = {r["col_name"]: [float(x) for x in r["thresholds"]] for r in rows}
        thresholds = {c: found.get(c, []) for c in cont}
        return BinaryEncoderModel(missing, list(self.yn_columns), dict(self.categorical_mappings),
                                  thresholds)
