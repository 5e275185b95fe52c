"""Model features, the train/test split and the encoder."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlark import schemas as S
from meterlark.functions import scalar as X
from meterlark.operators.quantiles import MAX_ROWS_PER_TASK, values_at_ranks
from meterlark.session import materialize

# The named feature sets.
CATEGORICAL = [
    "primary_property_type",
    "self_property_type",
    "largest_property_type",
    "city",
    "postal_code",
]
ENGINEERED = ["n_property_types", "is_certified", "has_data_center"]
FEATURE_SETS = {
    "v1": {"categorical": CATEGORICAL, "numeric": []},
    "v2": {"categorical": CATEGORICAL, "numeric": ENGINEERED},
}

TEST_SHARE = 0.2
SEED = 42
MISSING_CATEGORY = "(missing)"


def drop_missing_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Rows with a target; it is never filled in."""
    return df.dropna(subset=[target])


def dropped_rows(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """One row: rows before and after `drop_missing_target`."""
    return df.agg(F.count("*").alias("n_before"), F.count(target).alias("n_after")).withColumn(
        "n_dropped", F.col("n_before") - F.col("n_after")
    )


def engineer_features(df: DataFrame) -> DataFrame:
    """Add the count of listed property types and the certification and data-center flags."""
    return df.withColumns(
        {
            "n_property_types": X.list_length(F.col("all_property_types")),
            "is_certified": X.present_flag(F.col("third_party_certification")),
            "has_data_center": X.contains_ignoring_case(F.col("all_property_types"), "Data Center"),
        }
    )


def feature_summary(df: DataFrame) -> DataFrame:
    """One row: range and mean of the type count, and how often each flag is set."""
    return df.agg(
        F.min("n_property_types").alias("min_types"),
        F.max("n_property_types").alias("max_types"),
        F.avg("n_property_types").alias("mean_types"),
        F.count_if(F.col("is_certified") == 0).alias("not_certified"),
        F.count_if(F.col("is_certified") == 1).alias("certified"),
        F.count_if(F.col("has_data_center") == 0).alias("without_data_center"),
        F.count_if(F.col("has_data_center") == 1).alias("with_data_center"),
    )


def feature_columns(feature_set: str) -> list[str]:
    if feature_set not in FEATURE_SETS:
        raise ValueError(f"unknown feature set {feature_set!r}; known: {sorted(FEATURE_SETS)}")
    chosen = FEATURE_SETS[feature_set]
    return chosen["categorical"] + chosen["numeric"]


def select_features(
    df: DataFrame, feature_set: str = "v1", target: str = S.TARGET, keep: Sequence[str] = ()
) -> DataFrame:
    """The columns of a feature set and the target, after any columns to `keep`."""
    wanted = feature_columns(feature_set)
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise ValueError(f"feature columns not found: {absent}")
    return df.select(*dict.fromkeys([*keep, *wanted, target]))


def build_encoder(categorical: Sequence[str], numeric: Sequence[str] = ()) -> Pipeline:
    """Unfit one-hot encoder; fit it on training rows only.

    A missing value is a category of its own. A category not seen in training gives zeros.
    """
    marked = ", ".join(
        f"coalesce(`{c}`, '{MISSING_CATEGORY}') AS `{c}_marked`" for c in categorical
    )
    stages = [
        SQLTransformer(statement=f"SELECT *, {marked} FROM __THIS__"),
        StringIndexer(
            inputCols=[f"{c}_marked" for c in categorical],
            outputCols=[f"{c}_index" for c in categorical],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        # The dropped last slot is the one for unseen categories.
        OneHotEncoder(
            inputCols=[f"{c}_index" for c in categorical],
            outputCols=[f"{c}_vector" for c in categorical],
            dropLast=True,
        ),
        VectorAssembler(
            inputCols=[f"{c}_vector" for c in categorical] + list(numeric), outputCol="features"
        ),
    ]
    return Pipeline(stages=stages)


def _digest(key: str, seed: int) -> Column:
    """Hash of the seed and the key; a missing key has a hash of its own."""
    marked = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.md5(F.coalesce(marked, F.lit(f"{seed}")))


def _leading(digest: Column, digits: int) -> Column:
    """The first hexadecimal digits as a number; 13 of them are 52 bits, which a double holds exactly."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("double")


def hash_split(df: DataFrame, key: str, test_share: float = TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add `is_test` from a hash of the key: no shuffle, and the same for any row order.

    The test share holds in expectation, not as an exact count. Rows without a key fall on
    one side together.
    """
    return df.withColumn("is_test", _leading(_digest(key, seed), 8) < int(test_share * 2**32))


def exact_split(
    df: DataFrame,
    key: str,
    test_share: float = TEST_SHARE,
    seed: int = SEED,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add `is_test` for exactly ceil(share * rows) rows: those with the smallest key hashes.

    Instead of sorting all rows, the largest hash of the test part is found by counting.
    Rows that share its leading digits are told apart by the whole hash. `key` is unique; a
    missing key counts as one more value. Runs jobs; `max_rows` is how many hashes one task sorts.
    """
    digest, text = _digest(key, seed), F.coalesce(F.col(key).cast("string"), F.lit(""))
    n_test = math.ceil(df.count() * test_share)
    if not n_test:
        return df.withColumn("is_test", F.lit(False))
    leading = _leading(digest, 13)
    rows = materialize(df.select(leading.alias("_x")), "digests")
    found = values_at_ranks(rows, (), [F.lit(n_test - 1).cast("bigint")], max_rows).first()
    bound, missing = found["_value"], n_test - found["_below"]
    if missing == found["_same"]:
        return df.withColumn("is_test", leading <= bound)
    last = (
        df.select(digest.alias("d"), text.alias("k"))
        .where(leading == bound)
        .orderBy("d", "k")
        .limit(missing)
        .agg(F.max(F.struct("d", "k")))
        .first()[0]
    )
    tied = (leading == bound) & ((digest < last["d"]) | ((digest == last["d"]) & (text <= last["k"])))
    return df.withColumn("is_test", (leading < bound) | tied)


def label_check(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Per side of the split: rows and rows without a target."""
    return df.groupBy("is_test").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(target).isNull()).alias("missing_labels")
    )


def prepare(
    df: DataFrame, target: str = S.TARGET, key: str = S.KEY, exact_size: bool = False
) -> DataFrame:
    """Modeling frame with a target on every row, the engineered features and the split.

    With `exact_size` the test part has exactly its share of the rows, for which `df` is read
    several times.
    """
    split = exact_split if exact_size else hash_split
    return df.transform(drop_missing_target, target).transform(engineer_features).transform(split, key)
