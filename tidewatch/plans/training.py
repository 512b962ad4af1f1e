"""The risk classifier: split, cross-validation, training, metrics, importance.

Everything runs as Spark jobs over a stored feature table. The label is derived
from the rules' score, whose inputs are also model inputs, so high accuracy is
expected and says nothing about unseen crime; evaluation against the source
label is a separate report.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.config import MODEL_FEATURES, Rules
from tidewatch.functions import scalars as S
from tidewatch.operators import ranking as K
from tidewatch.plans.boosting import Growth, Trees, grow, values
from tidewatch.plans.reports import is_alert, precision_recall

BINARY = ("is_weekend", "is_offhours", "involves_high_risk_country")


@dataclass(frozen=True)
class TrainingSettings:
    """The full model; ``edge_rows`` bounds the rows that give the bins' edges."""

    rounds: int = 300
    depth: int = 5
    step: float = 0.05
    row_share: float = 0.8
    feature_share: float = 0.8
    folds: int = 5
    test_share: float = 0.20
    seed: int = 42
    edge_rows: int = 50_000

    def growth(self) -> Growth:
        return Growth(
            rounds=self.rounds,
            depth=self.depth,
            step=self.step,
            row_share=self.row_share,
            feature_share=self.feature_share,
            edge_rows=self.edge_rows,
            seed=self.seed,
        )


FULL_SETTINGS = TrainingSettings()
#: For each class: the digests below which rows are in the test part and, after that, in the first, second, ... fold.
Cuts = dict[int, list[str]]


# --- inputs ----------------------------------------------------------------


def model_inputs(scored: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Id, the ten features as doubles (unknown stays null) and the 0/1 label; an unknown
    score is no alert."""

    def number(name: str) -> Column:
        value = F.col(name).cast("int") if name in BINARY else F.col(name)
        return value.cast("double").alias(name)

    alert = F.coalesce(is_alert(rules), F.lit(False))
    return scored.select("transaction_id", *map(number, MODEL_FEATURES), alert.cast("int").alias("label"))


def label_balance(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy("label").count()


def _digest(salt: str) -> Column:
    """A place in an order that hangs on the row's id alone."""
    return F.md5(F.concat(F.coalesce("transaction_id", F.lit("")), F.lit(f"/{salt}")))


#: Hex digits by which a search for a cut goes deeper: 4096 counts for each open cut.
_DIGITS = 3


def split_cuts(inputs: DataFrame, settings: TrainingSettings = TrainingSettings()) -> Cuts:
    """Where each class is cut into test part and folds, in the order of the ids' digests.

    The test part gets exactly the rounded share of a class, and folds differ by at most
    one row. Each cut is a row's rank: rows are counted by the first digits of their
    digest, then only those that share the digits of an open cut by further ones,
    until a cut lies between two counts. No row is sorted or moved. Rows of one id stay together.
    """
    digest = _digest(f"split{settings.seed}")
    places = inputs.select("label", digest.alias("_digest"))
    sizes = {r.label: r.n for r in places.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    cuts: Cuts = {}
    open_cuts: dict[tuple[int, str], list[tuple[int, int]]] = {}
    for label, n in sizes.items():
        tested = int(settings.test_share * n + 0.5)
        ranks = [tested] + [tested + j * (n - tested) // settings.folds for j in range(1, settings.folds)]
        cuts[label] = [""] * len(ranks)
        open_cuts[label, ""] = list(enumerate(ranks))  # (which cut, rank below this prefix)
    for length in range(_DIGITS, 33, _DIGITS):
        if not open_cuts:
            break
        wanted = [(F.col("label") == label) & F.col("_digest").startswith(prefix) for label, prefix in open_cuts]
        near = places.where(reduce(Column.__or__, wanted))
        found = near.groupBy("label", F.substring("_digest", 1, length).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
        counted: dict[tuple[int, str], list[tuple[str, int]]] = {}
        for r in sorted(found.collect()):
            counted.setdefault((r.label, r.prefix[: length - _DIGITS]), []).append((r.prefix, r.n))
        deeper: dict[tuple[int, str], list[tuple[int, int]]] = {}
        for (label, prefix), asked in open_cuts.items():
            for which, rank in asked:
                passed = 0
                cuts[label][which] = prefix + "g"  # behind all of them
                for bucket, n in counted.get((label, prefix), []):
                    if rank < passed + n:
                        cuts[label][which] = bucket
                        if rank > passed and length + _DIGITS <= 33:
                            deeper.setdefault((label, bucket), []).append((which, rank - passed))
                        break
                    passed += n
        open_cuts = deeper
    return cuts


def with_split(
    inputs: DataFrame, settings: TrainingSettings = TrainingSettings(), cuts: Cuts | None = None
) -> DataFrame:
    """Add ``part`` (train or test) and ``fold`` (of use within train only).

    Both follow from the digest of the id and the cuts of its class, which a stored model
    keeps, so it meets the same test rows again. Without ``cuts`` they are sought in ``inputs``.
    """
    cuts = split_cuts(inputs, settings) if cuts is None else cuts
    digest = _digest(f"split{settings.seed}")
    tested, fold = F.lit(False), F.lit(0)
    for label, places in cuts.items():
        own = F.col("label") == int(label)
        tested = F.when(own, digest < places[0]).otherwise(tested)
        passed = sum(((digest >= place).cast("int") for place in places[1:]), F.lit(0))
        fold = F.when(own, passed).otherwise(fold)
    spread = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(settings.folds)).cast("int")
    return inputs.withColumns(
        {"part": F.when(tested, "test").otherwise("train"), "fold": F.when(tested, spread).otherwise(fold)}
    )


def train_part(split: DataFrame) -> DataFrame:
    return split.where(F.col("part") == "train")


def test_part(split: DataFrame) -> DataFrame:
    return split.where(F.col("part") == "test")


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("part", "label").count()


# --- model -----------------------------------------------------------------


@dataclass
class RiskModel:
    """The fitted trees, and the cuts that kept their test rows apart."""

    stages: list[Trees]
    cuts: Cuts | None = None

    @property
    def trees(self) -> Trees:
        return self.stages[-1]


def fit_all(split: DataFrame, settings: TrainingSettings = TrainingSettings()) -> tuple[RiskModel, DataFrame]:
    """The model of the train part, and the margins (fold, label, margin) that the models
    of the other folds give each train row: all of them grow in the same jobs."""
    (trees, *_), unseen = grow(train_part(split), MODEL_FEATURES, settings.folds, settings.growth())
    return RiskModel([trees]), unseen


def fit(split: DataFrame, settings: TrainingSettings = TrainingSettings()) -> RiskModel:
    (trees,), _ = grow(train_part(split), MODEL_FEATURES, 0, settings.growth())
    return RiskModel([trees])


def fold_report(unseen: DataFrame, settings: TrainingSettings = TrainingSettings()) -> DataFrame:
    """Mean, deviation and Gini of the folds' AUC."""
    probability = _probability(F.col("margin")).alias("probability")
    counts = K.score_counts(unseen.select("fold", "label", probability), "probability", F.col("label") == 1, by=["fold"])
    per_fold = K.auc_gini(counts, ["fold"])
    mean = F.avg("auc")
    return per_fold.agg(
        F.lit(settings.folds).alias("folds"),
        mean.alias("cv_mean_auc"),
        F.stddev_pop("auc").alias("cv_std_auc"),
        (2 * mean - 1).alias("cv_gini"),
    )


def cross_validate(split: DataFrame, settings: TrainingSettings = TrainingSettings()) -> DataFrame:
    """Mean, deviation and Gini of the AUC over the folds of the train part."""
    return fold_report(fit_all(split, settings)[1], settings)


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def _margins(trees: Trees, keep: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        margin = pa.array(trees.margins(values(batch, trees.names)))
        yield pa.RecordBatch.from_arrays([*map(batch.column, keep), margin], [*keep, "margin"])


def with_margin(model: RiskModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the model's margin (log odds) of each row."""
    needed = rows.select(*dict.fromkeys([*keep, *model.trees.names]))
    schema = T.StructType([*[needed.schema[c] for c in keep], T.StructField("margin", T.DoubleType())])
    return needed.mapInArrow(partial(_margins, model.trees, list(keep)), schema)


def predict(model: RiskModel, rows: DataFrame, keep: Sequence[str] = ("transaction_id", "label")) -> DataFrame:
    probability = _probability(F.col("margin"))
    return with_margin(model, rows, keep).select(
        *keep, probability.alias("probability"), (probability >= 0.5).cast("int").alias("predicted")
    )


def top_risks(predictions: DataFrame, n: int = 3) -> DataFrame:
    return predictions.orderBy(F.desc("probability"), "transaction_id").limit(n)


# --- metrics ---------------------------------------------------------------


def evaluate(predictions: DataFrame) -> DataFrame:
    """One row: AUC, Gini, KS, precision, recall, F1, confusion counts, size.

    All of it follows from the counts per distinct probability, so the
    predictions are read once.
    """
    counts = K.score_counts(predictions, "probability", F.col("label") == 1)

    def cell(kind: str, guess: Column) -> Column:
        return F.coalesce(F.sum(F.when(guess, F.col(kind))), F.lit(0))

    high = F.col("score") >= 0.5
    row = counts.agg(
        *[value.alias(f"test_{name}") for name, value in K.curve_metrics().items()],
        cell("positives", high).alias("tp"),
        cell("negatives", high).alias("fp"),
        cell("negatives", ~high).alias("tn"),
        cell("positives", ~high).alias("fn"),
    )
    n_test = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return precision_recall(row).withColumns(
        {"n_test": n_test, "pos_rate_test": S.share(F.col("tp") + F.col("fn"), n_test)}
    )


# --- importance ----------------------------------------------------------


def permutation_importance(
    model: RiskModel, rows: DataFrame, rows_per_bucket: int = 100_000, seed: int = 42
) -> DataFrame:
    """Fall of the AUC when one feature is shuffled among the rows.

    It ranks features by what the model loses without them and needs only scoring
    passes; ``attributions`` tells what they add to each row. Rows are put
    in random buckets of bounded size and random order; feature k takes the
    value of the row k + 1 places back. The first rows of a bucket keep their
    own value.
    """
    n = rows.count()
    buckets = max(1, math.ceil(n / rows_per_bucket))
    row_id = F.col("transaction_id")
    shuffled = Window.partitionBy("_bucket").orderBy("_order", "transaction_id")
    mixed = rows.withColumns(
        {
            "_bucket": F.pmod(F.xxhash64(row_id, F.lit("bucket"), F.lit(seed)), F.lit(buckets)),
            "_order": F.xxhash64(row_id, F.lit("order"), F.lit(seed)),
        }
    ).select(
        "transaction_id",
        "label",
        *MODEL_FEATURES,
        *[
            F.when(F.row_number().over(shuffled) > k + 1, F.lag(name, k + 1).over(shuffled))
            .otherwise(F.col(name))
            .alias(f"_mixed_{name}")
            for k, name in enumerate(MODEL_FEATURES)
        ],
    )

    def variant(target: str) -> Column:
        values = [F.col(f"_mixed_{c}" if c == target else c).alias(c) for c in MODEL_FEATURES]
        return F.struct(F.lit(target).alias("feature"), *values)

    variants = mixed.select(
        "transaction_id", "label", F.inline(F.array(*[variant(t) for t in ("none", *MODEL_FEATURES)]))
    )
    scored = predict(model, variants, ("feature", "label"))
    curves = K.auc_gini(K.score_counts(scored, "probability", F.col("label") == 1, by=["feature"]), ["feature"])
    per_variant = curves.groupBy().pivot("feature", ["none", *MODEL_FEATURES]).agg(F.first("auc"))
    gains = model.trees.importances()
    cells = ", ".join(f"'{c}', none - `{c}`, {gains[c]!r}D, none" for c in MODEL_FEATURES)
    return per_variant.selectExpr(
        f"stack({len(MODEL_FEATURES)}, {cells}) as (feature, auc_drop, split_gain, baseline_auc)"
    ).orderBy(F.desc("auc_drop"), "feature")


# --- storage ---------------------------------------------------------------


def save(model: RiskModel, path: str, rules: Rules = Rules(), settings: TrainingSettings = TrainingSettings()) -> None:
    """The model with the facts needed to evaluate it elsewhere, in one row of one file."""
    facts = json.dumps(
        {
            "features": list(MODEL_FEATURES),
            "label_threshold": rules.alert_threshold,
            "settings": asdict(settings),
            "cuts": model.cuts,
        }
    )
    spark = SparkSession.getActiveSession()
    row = spark.createDataFrame([(facts, model.trees.to_json())], "facts string, trees string")
    row.coalesce(1).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> tuple[RiskModel, dict]:
    row = spark.read.schema("facts string, trees string").parquet(path).first()
    facts = json.loads(row.facts)
    cuts = None if facts["cuts"] is None else {int(label): places for label, places in facts["cuts"].items()}
    return RiskModel([Trees.from_json(row.trees)], cuts), facts


def reload_and_evaluate(scored: DataFrame, path: str) -> DataFrame:
    """Evaluate a stored model on the test rows of the split it was trained with."""
    model, facts = load(scored.sparkSession, path)
    if facts["features"] != list(MODEL_FEATURES):
        raise ValueError("the stored model expects other features")
    settings = TrainingSettings(**facts["settings"])
    inputs = model_inputs(scored, Rules(alert_threshold=facts["label_threshold"]))
    return evaluate(predict(model, test_part(with_split(inputs, settings, model.cuts))))


def run_details(settings: TrainingSettings, rules: Rules, metrics: dict) -> dict:
    """Parameters and numeric metrics for the run log."""
    numbers = {k: v for k, v in metrics.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}
    return {
        "parameters": {
            **asdict(settings),
            "label_threshold": rules.alert_threshold,
            "features": ",".join(MODEL_FEATURES),
        },
        "metrics": numbers,
    }
