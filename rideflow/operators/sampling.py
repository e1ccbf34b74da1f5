"""Reproducible sampling and splits (2.13) and disjoint batches.

``df.sample(f)`` without a seed gives other rows on every run, and even with a
seed the rows depend on the partitioning.  A threshold on ``md5`` of a key
picks the same rows on any cluster, on any engine that has ``md5``, and the
same key always lands in the same sample or batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rideflow.session import scratch_path
from rideflow.sources.sinks import save_table

_HEX_DIGITS = 32


def _key_text(keys: str | Sequence[str]) -> Column:
    """The key as text: each column tagged, a value with its length, so that different keys,
    nulls included, have different texts."""
    parts = []
    for name in [keys] if isinstance(keys, str) else keys:
        text = F.col(name).cast("string")
        value = F.concat(F.lit("v"), F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(value, F.lit("n")))
    return F.concat(*parts)


def md5_threshold(fraction: float) -> str:
    """The lowercase hex bound below which ``fraction`` of md5 values fall."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    bound = min(int(fraction * 16**_HEX_DIGITS), 16**_HEX_DIGITS - 1)
    return format(bound, f"0{_HEX_DIGITS}x")


def hash_sample(df: DataFrame, keys: str | Sequence[str], fraction: float) -> DataFrame:
    """Rows whose key hashes below ``fraction`` (M0): same rows every run.

    Rows sharing a key are kept or dropped together, so ``keys`` should
    identify rows (an id, or several columns that together do; ``row_sample``
    takes all columns).  A null is a key value like any other.
    """
    if fraction >= 1.0:
        return df
    return df.filter(F.md5(_key_text(keys)) < F.lit(md5_threshold(fraction)))


def row_sample(df: DataFrame, fraction: float) -> DataFrame:
    """``hash_sample`` by all columns: single rows, not groups that share an id, are kept (M0)."""
    return hash_sample(df, df.columns, fraction)


def seeded_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Spark's row sample with a seed (M0): the same rows for the same partitioning of the input."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_bucket(keys: str | Sequence[str], k: int) -> Column:
    """Bucket ``0..k-1`` from the first 32 bits of the key's md5 (M3)."""
    head = F.conv(F.substring(F.md5(_key_text(keys)), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(k)).cast("int")


def disjoint_batches(
    df: DataFrame,
    keys: str | Sequence[str],
    n_batches: int = 10,
    buckets: int = 1000,
    spark: SparkSession | None = None,
    out: str = "batch",
) -> DataFrame:
    """``n_batches`` non-overlapping samples of ``1/buckets`` each, saved and read back as one.

    The batches are written once, partitioned by ``out``, below the shared
    checkpoint folder; the returned DataFrame reads them back, so a filter on
    ``out`` prunes to one batch's files.
    """
    spark = spark or df.sparkSession
    tagged = df.withColumn(out, hash_bucket(keys, buckets)).filter(F.col(out) < n_batches)
    path = scratch_path(spark, "batches")
    save_table(tagged, path, partition_by=[out])
    return spark.read.parquet(path)


def random_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test parts, ``[1 - f, f]``, by Spark's ``randomSplit`` (M2).

    Reproducible only for the same partitioning of the same input; see ``hash_split``.
    """
    training, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
    return training, test


def rand_split(
    df: DataFrame, test_fraction: float = 0.2, seed: int = 42, out: str = "rand"
) -> tuple[DataFrame, DataFrame]:
    """Training and test parts by a random column ``out``: test where it is at most the fraction.

    Each part is planned from the input, so the same partitioning is needed for
    the two to be complementary: materialise the input first.
    """
    marked = df.withColumn(out, F.rand(seed))
    return marked.filter(F.col(out) > test_fraction), marked.filter(F.col(out) <= test_fraction)


def hash_split(
    df: DataFrame, test_fraction: float = 0.2, keys: str | Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Training and test parts by a hash of ``keys`` (default: the whole row): the same rows for any
    partitioning, on any engine that has ``md5``; every row is in exactly one part."""
    in_test = F.md5(_key_text(df.columns if keys is None else keys)) < F.lit(md5_threshold(test_fraction))
    return df.filter(~in_test), df.filter(in_test)


def stratified_sample(
    df: DataFrame, strata: str | Sequence[str], k: int, key: str | Sequence[str], weight: Column | str | None = None
) -> DataFrame:
    """Exactly ``k`` rows of each stratum (all, if it has fewer), the same on any cluster and engine.

    Rows are ordered by the md5 of ``key`` and the first ``k`` stay; Spark keeps at most ``k`` a stratum
    in each task before the shuffle, so a stratum of a third of all rows moves no more than others.
    With ``weight``, rows are ordered by -ln(u) / weight, u being the md5 as a number between 0 and 1:
    each next row is drawn with a chance in proportion to its weight among those left.  Rows whose
    weight is null or not positive are never drawn.  Rows of equal keys are drawn by their other columns.
    """
    key_cols = [key] if isinstance(key, str) else list(key)
    strata_cols = [strata] if isinstance(strata, str) else list(strata)
    text = F.md5(F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in key_cols]))
    order = text
    if weight is not None:
        w = (F.col(weight) if isinstance(weight, str) else weight).cast("double")
        # 52 bits of the digest, off both ends.
        u = (F.conv(F.substring(text, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
        df = df.filter(w > 0)
        order = -F.log(u) / w
    ties = [F.col(f"`{c}`") for c in df.columns if not df.schema[c].dataType.simpleString().startswith("map")]
    window = Window.partitionBy(*strata_cols).orderBy(order, *ties)
    return df.withColumn("_nth", F.row_number().over(window)).filter(F.col("_nth") <= k).drop("_nth")
