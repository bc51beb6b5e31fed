"""Splits, folds and fitted preprocessing: impute, scale, one-hot, group means."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lastmile.functions import numeric
from lastmile.operators.clean import exclude_columns, infer_roles, require_columns
from lastmile.operators.labels import fit_terciles, tercile_of
from lastmile.operators.quantiles import quantiles
from lastmile.operators.sizing import repeat_rows, running_before, small_side, written
from lastmile.schema import ID_COLUMN, LABEL, TARGET

SPLIT_KEY = "split_key"
BUCKETS = 10_000  # of the hashed key, so a share is met to a hundredth of a percent
STRATA_BUCKETS = 4096


def hashed_key(key: str, digits: int = 1) -> Column:
    """An even spread of any key, the same in every engine: eight digits of its text's MD5.

    ``digits`` says from which one on, so that splits and folds are independent. A null key
    counts as an empty text.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text.cast("binary")), digits, 8), 16, 10).cast("long")


def split_random(df: DataFrame, key: str = SPLIT_KEY, test_share: float = 0.2) -> DataFrame:
    """Add ``split``: a test share by key, the same whatever the partitioning."""
    if not 0 < test_share < 1:
        raise ValueError("the test share must lie between 0 and 1")
    bound = round(test_share * BUCKETS)
    return df.withColumn(
        "split", F.when(hashed_key(key) % BUCKETS < bound, "test").otherwise("train")
    )


def parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        df.where("split = 'train'").drop("split"),
        df.where("split = 'test'").drop("split"),
    )


def split_stratified(
    df: DataFrame, label: str = LABEL, key: str = SPLIT_KEY, test_share: float = 0.2
) -> DataFrame:
    """Add ``split`` with the test share met in every class and in total.

    Classes get the whole part of their share; what the total still lacks goes to the largest
    remainders, ties by class. Rows of a class are taken in the order of key buckets, keys and row contents.
    Bucket counts tell which buckets go to one side as a whole; only the one bucket
    per class where the quota falls is looked at row by row.
    """
    counts = df.groupBy(label).agg(F.count("*").alias("n")).collect()  # one row per class
    total = sum(r["n"] for r in counts)
    n_test = math.ceil(total * test_share - 1e-9)
    possible = (
        len(counts) > 1
        and min(r["n"] for r in counts) >= 2
        and n_test >= len(counts)
        and total - n_test >= len(counts)
    )
    if not possible:
        return split_random(df, key, test_share)
    bucket = (hashed_key(key) % STRATA_BUCKETS).cast("int")
    whole_part = {r[label]: math.floor(r["n"] * test_share + 1e-9) for r in counts}
    remainders = sorted(
        ((r["n"] * test_share - whole_part[r[label]], r[label]) for r in counts),
        key=lambda x: (-x[0], x[1] is None, x[1]),
    )
    for _, name in remainders[: n_test - sum(whole_part.values())]:
        whole_part[name] += 1
    quotas = df.sparkSession.createDataFrame(
        list(whole_part.items()), StructType([StructField("_q", df.schema[label].dataType), StructField("_quota", LongType())])
    )
    sizes = df.groupBy(F.col(label).alias("_l"), bucket.alias("_b")).agg(F.count("*").alias("_n"))
    by_class = Window.partitionBy("_l")  # at most STRATA_BUCKETS rows per class
    upto = F.sum("_n").over(by_class.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0))
    left = sizes.withColumn("_upto", upto).join(quotas, sizes["_l"].eqNullSafe(quotas["_q"])).withColumn(
        "_left", F.col("_quota") - F.col("_upto") + F.col("_n")
    ).select(
        "_l", "_b", "_left", (F.col("_left") >= F.col("_n")).alias("_all")
    )
    placed = (
        df.withColumns({"_l": F.col(label), "_b": bucket})
        .join(small_side(left), ["_l", "_b"])  # classes x STRATA_BUCKETS rows
        .withColumn("split", F.when(F.col("_all"), "test").when(F.col("_left") <= 0, "train"))
    )
    whole = placed.where(F.col("split").isNotNull()).select(*df.columns, "split")
    names = [c for c in df.columns if c not in (label, key)]
    cut = (
        placed.where(F.col("split").isNull())
        .groupBy(*df.columns, "_l", "_left")
        .agg(F.count("*").alias("_n"))
    )
    # Copies are collapsed, the cut buckets are lined up, and each class counts from its start.
    lined = written(running_before(cut, ["_l", key, *names], "_n", "_line"))
    starts = lined.groupBy("_l").agg(F.min("_line").alias("_first"))
    before = lined.join(F.broadcast(starts), "_l").withColumn(
        "_before", F.col("_line") - F.col("_first")
    )
    take = F.greatest(F.lit(0), F.least(F.col("_n"), F.col("_left") - F.col("_before")))
    shares = before.withColumn(
        "_s",
        F.explode(
            F.array(
                F.struct(F.lit("test").alias("split"), take.alias("k")),
                F.struct(F.lit("train").alias("split"), (F.col("_n") - take).alias("k")),
            )
        ),
    ).select(*df.columns, F.col("_s.split").alias("split"), F.col("_s.k").alias("_k"))
    return whole.unionByName(repeat_rows(shares, "_k"))


def effective_folds(df: DataFrame, label: str | None, folds: int) -> int:
    """Folds bounded by the smallest class; without a label just the wanted number."""
    if folds < 2:
        raise ValueError("at least 2 folds are needed")
    if label is None:
        return folds
    counts = [r["count"] for r in df.groupBy(label).count().collect()]
    if len(counts) < 2:
        raise ValueError("at least 2 classes are needed")
    if min(folds, *counts) < 2:
        raise ValueError("too few rows per class for cross validation")
    return min(folds, *counts)


def assign_folds(df: DataFrame, folds: int = 5, key: str = SPLIT_KEY) -> DataFrame:
    """Add ``fold`` from the key, by other digits of its hash than the split's."""
    return df.withColumn("fold", (hashed_key(key, 9) % folds).cast("int"))


# --- imputing, scaling, one-hot as plain columns -------------------------------


def fit_impute(
    df: DataFrame, numbers: list[str], categories: list[str]
) -> dict[str, float | str | None]:
    """Medians and most frequent categories (the smallest among ties)."""
    parsed = df.select(*[numeric(df, c).alias(c) for c in numbers])
    medians = quantiles(parsed, {c: [0.5] for c in numbers})
    values: dict[str, float | str | None] = {c: medians[c][0] for c in numbers}
    if categories:
        values.update(_most_frequent(df, categories))
    return values


def _most_frequent(df: DataFrame, categories: list[str]) -> dict[str, str]:
    # Counts per category instead of mode(): its state would hold every category in one task.
    long = df.select(*[F.col(c).cast("string").alias(c) for c in categories]).unpivot(
        [], categories, "_column", "_value"
    )
    counts = long.where("_value is not null").groupBy("_column", "_value").count()
    best = counts.groupBy("_column").agg(
        F.min_by("_value", F.struct((-F.col("count")).alias("n"), F.col("_value"))).alias("v")
    )
    return {r["_column"]: r["v"] for r in best.collect()}


def apply_impute(df: DataFrame, values: dict[str, float | str | None]) -> DataFrame:
    filled = {}
    for c, v in values.items():
        if isinstance(v, str):
            filled[c] = F.coalesce(F.col(c).cast("string"), F.lit(v))
        elif v is not None:
            filled[c] = F.coalesce(numeric(df, c), F.lit(float(v)))
    return df.withColumns(filled) if filled else df


def fit_scale(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population spread; a constant column gets spread 1."""
    row = df.agg(
        *[
            F.struct(F.avg(numeric(df, c)).alias("m"), F.stddev_pop(numeric(df, c)).alias("s")).alias(c)
            for c in columns
        ]
    ).first()
    return {c: (row[c]["m"] or 0.0, row[c]["s"] or 1.0) for c in columns}


def apply_scale(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (numeric(df, c) - m) / s for c, (m, s) in fitted.items()})


MAX_CATEGORIES = 10_000


def fit_one_hot(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted categories per column. Each becomes a feature, so the number is checked."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "_column", "_value"
    )
    found = (
        long.where("_value is not null").distinct().limit(MAX_CATEGORIES + 1).collect()
    )
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"more than {MAX_CATEGORIES} categories to one-hot encode")
    return {c: sorted(r["_value"] for r in found if r["_column"] == c) for c in columns}


def apply_one_hot(df: DataFrame, fitted: dict[str, list[str]]) -> DataFrame:
    """0/1 columns ``<column>_<category>``; unknown and null are all zero."""
    return df.withColumns(
        {
            f"{c}_{v}": F.coalesce(F.col(c).cast("string") == v, F.lit(False)).cast("double")
            for c, values in fitted.items()
            for v in values
        }
    )


# --- historical group means ----------------------------------------------------


@dataclass
class GroupMeans:
    """Mean target per category, learnt on the training rows."""

    columns: list[str] = field(
        default_factory=lambda: [ID_COLUMN, "tipo_vehiculo", "trafico_nivel"]
    )
    target: str = TARGET
    overall: float | None = None
    means: dict[str, DataFrame] = field(default_factory=dict)

    def fit(self, train: DataFrame) -> GroupMeans:
        present = [c for c in self.columns if c in train.columns]
        # Written once with these columns only: one pass for the mean, one per category column.
        train = written(train.select(self.target, *present))
        self.overall = train.agg(F.avg(self.target)).first()[0]
        self.means = {
            c: small_side(
                train.where(F.col(c).isNotNull())
                .groupBy(F.col(c).alias("_category"))
                .agg(F.avg(self.target).alias("_mean"))
            )
            for c in present
        }
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.overall is None:
            raise RuntimeError("group means are not fitted")
        out = df
        for c, means in self.means.items():
            name = f"hist_mean_target_by_{c}"
            if c not in df.columns:
                out = out.withColumn(name, F.lit(self.overall))
                continue
            out = (
                out.join(means, out[c] == means["_category"], "left")
                .withColumn(name, F.coalesce("_mean", F.lit(self.overall)))
                .drop("_category", "_mean")
            )
        return out


def out_of_fold_means(
    df: DataFrame, column: str, target: str = TARGET, fold: str = "fold"
) -> DataFrame:
    """Group means of training rows without the rows of their own fold."""
    present = df.where(F.col(target).isNotNull())
    per_fold = small_side(
        present.groupBy(F.col(column).alias("_category"), F.col(fold).alias("_fold")).agg(
            F.sum(target).alias("_s"), F.count("*").alias("_n")
        )
    )
    whole = per_fold.groupBy("_category").agg(F.sum("_s").alias("_ts"), F.sum("_n").alias("_tn"))
    left = per_fold.alias("f").join(
        whole.alias("w"), F.col("f._category").eqNullSafe(F.col("w._category"))
    ).select(
        F.col("f._category").alias("_category"), "_fold",
        F.try_divide(F.col("_ts") - F.col("_s"), F.col("_tn") - F.col("_n")).alias("_mean"),
    )
    overall = present.agg(F.avg(target)).first()[0]
    means = small_side(left)
    return (
        df.join(means, (df[column] == means["_category"]) & (df[fold] == means["_fold"]), "left")
        .withColumn(f"hist_mean_target_by_{column}", F.coalesce("_mean", F.lit(overall)))
        .drop("_category", "_fold", "_mean")
    )


# --- vectors for the learners --------------------------------------------------


FEATURES_COLUMN = "features"


def _sql(value: float | str) -> str:
    """A literal for an SQL transformer stage."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{float(value)!r}D"


def fit_encoder(
    train: DataFrame, numbers: list[str], categories: list[str], impute: bool = True
) -> PipelineModel:
    """Preprocessing to a vector as a saveable model.

    Numbers are imputed with the median and scaled with the population spread;
    categories are imputed with the most frequent value and one-hot encoded in
    alphabetical order, unknown ones as all zero.
    """
    fills = fit_impute(train, numbers, categories) if impute else {}
    present = [c for c in numbers if not impute or fills.get(c) is not None]
    scale = fit_scale(apply_impute(train, {c: fills[c] for c in present if c in fills}), present)
    if categories:
        _check_categories(train, categories)
    made = []
    for c in present:
        value = f"try_cast(`{c}` AS DOUBLE)"
        if impute:
            value = f"coalesce({value}, {_sql(fills[c])})"
        mean, spread = scale[c]
        made.append(f"({value} - {_sql(mean)}) / {_sql(spread)} AS `_num_{c}`")
    for c in categories:
        value = f"CAST(`{c}` AS STRING)"
        if fills.get(c) is not None:
            value = f"coalesce({value}, {_sql(fills[c])})"
        made.append(f"{value} AS `_cat_{c}`")
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(made)} FROM __THIS__")]
    inputs = [f"_num_{c}" for c in present]
    hidden = list(inputs)
    if categories:
        texts, marks, hot = ([f"_{kind}_{c}" for c in categories] for kind in ("cat", "idx", "hot"))
        stages += [
            StringIndexer(
                inputCols=texts, outputCols=marks,
                handleInvalid="keep", stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=marks, outputCols=hot, dropLast=True, handleInvalid="keep"),
        ]
        inputs += hot
        hidden += [*texts, *marks, *hot]
    stages.append(
        VectorAssembler(inputCols=inputs, outputCol=FEATURES_COLUMN, handleInvalid="keep")
    )
    stages.append(
        SQLTransformer(
            statement=f"SELECT * EXCEPT ({', '.join(f'`{c}`' for c in hidden)}) FROM __THIS__"
        )
    )
    return Pipeline(stages=stages).fit(train)


def _check_categories(df: DataFrame, categories: list[str]) -> None:
    """Every category becomes a vector slot and a label on the driver, so bound their number."""
    row = df.agg(*[F.approx_count_distinct(c).alias(c) for c in categories]).first()
    wide = [c for c in categories if row[c] > MAX_CATEGORIES]
    if wide:
        raise ValueError(f"too many categories to one-hot encode: {wide}")


def slot_names(encoded: DataFrame, column: str = FEATURES_COLUMN) -> list[str]:
    """Names of the vector slots, from the column's metadata."""
    groups = encoded.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [a["name"].removeprefix("_num_").removeprefix("_hot_") for a in slots]


def slots_of(encoder: PipelineModel, df: DataFrame) -> dict[str, list[int]]:
    """The vector slots that each raw column fills; ``encoder`` is one of ``fit_encoder``'s, ``df`` has its raw columns."""
    last = next(i for i, s in enumerate(encoder.stages) if isinstance(s, VectorAssembler))
    made = PipelineModel(encoder.stages[:last]).transform(df).schema
    out, at = {}, 0
    for name in encoder.stages[last].getInputCols():
        size = 1
        if name.startswith("_hot_"):
            groups = made[name].metadata["ml_attr"]["attrs"].values()
            size = sum(len(group) for group in groups)
        out[name[5:]] = list(range(at, at + size))
        at += size
    return out


# --- classification data -----------------------------------------------------------


@dataclass
class ClassData:
    """Labelled rows with a ``split`` column, feature roles and the fitted preprocessing."""

    rows: DataFrame
    numbers: list[str]
    categories: list[str]
    dropped: list[tuple[str, str]]
    thresholds: dict[str, float] | None = None

    def encoder(self) -> PipelineModel:
        return fit_encoder(self.rows.where("split = 'train'"), self.numbers, self.categories)


def _class_data(
    rows: DataFrame, basis: DataFrame, label: str, key: str, thresholds: dict[str, float] | None = None
) -> ClassData:
    dropped = exclude_columns(basis.drop("split", key), label)
    out = {c for c, _ in dropped} | {"split", key}
    roles = infer_roles(rows, out)
    if not roles["numeric"] and not roles["categorical"]:
        raise ValueError("no usable feature column is left")
    return ClassData(rows, roles["numeric"], roles["categorical"], dropped, thresholds)


def prepare_by_time(
    df: DataFrame, target: str = TARGET, key: str = SPLIT_KEY, test_share: float = 0.2
) -> ClassData:
    """Split first, then class thresholds and exclusions from the training rows only."""
    require_columns(df, [target])
    split = written(split_random(df, key, test_share))  # thresholds, exclusions and encoder read it
    train = split.where("split = 'train'")
    thresholds = fit_terciles(train, target)
    value = numeric(split, target)
    rows = split.withColumn(LABEL, tercile_of(F.when(value > 0, value), thresholds))
    return _class_data(rows, rows.where("split = 'train'"), LABEL, key, thresholds)


def prepare_by_label(
    df: DataFrame, label: str = LABEL, key: str = SPLIT_KEY, test_share: float = 0.2
) -> ClassData:
    """Stratified split of rows that carry a class; a missing class is an error."""
    require_columns(df, [label])
    if df.where(F.col(label).isNull()).take(1):
        raise ValueError(f"the class column {label} has missing values")
    return _class_data(split_stratified(df, label, key, test_share), df, label, key)
