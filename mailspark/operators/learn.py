"""Boosted-tree classifier: split, fit, tune, self-train, evaluate, score."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mailspark.functions import scoring
from mailspark.operators import boosting, tuning
from mailspark.operators.boosting import BOOST_ROUNDS, SEED, BoostParams  # noqa: F401
from mailspark.operators.features import HashingEncoder, embed
from mailspark.operators.forest import Forest, predict
from mailspark.session import cut_lineage, scratch_dir

# Share of the hold-out, rounds of self-training, trials and how many at a time.
HOLD_OUT_PERCENT = 25
SELF_TRAINING_ROUNDS = 9
TRIALS = 25
PARALLEL_TRIALS = 5


def in_hold_out(id_col: Column, percent: int = HOLD_OUT_PERCENT) -> Column:
    """By a hash of the id, so a row stays on its side however the data is partitioned."""
    head = F.conv(F.substring(F.md5(id_col.cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(100)) < percent


def split(df: DataFrame, id_col: str = "id", percent: int = HOLD_OUT_PERCENT):
    held = in_hold_out(F.col(id_col), percent)
    return df.where(~held), df.where(held)


def fit(train: DataFrame, params: BoostParams = BoostParams()) -> Forest:
    """`train` holds features ARRAY and label 0/1; rows without either are not trained on. Two
    jobs: the bin edges, and all rounds of all members (see boosting)."""
    return fit_many(train, [params])[0]


def fit_many(train: DataFrame, fits: list[BoostParams]) -> list[Forest]:
    """Several fits on the same rows; the members of all of them grow in one job."""
    usable = boosting.usable(train)
    edges, n_rows = boosting.bin_edges(usable, fits[0].bins)
    members = boosting.member_count(n_rows, fits[0])
    binned = boosting.binned_rows(usable, edges, members)
    nodes = boosting.grow_members(binned, edges, members, fits).toArrow()
    return boosting.forests(nodes, edges, members, len(fits))


def confusion_matrix(scored: DataFrame, label: str = "label", predicted: str = "predicted"):
    """Rows actual 0 and 1, columns predicted_0 and predicted_1; empty cells are 0."""

    def cell(a, p):
        return F.count_if((F.col(label) == a) & (F.col(predicted) == p))

    rows = [
        F.struct(
            F.lit(a).alias("actual"),
            cell(a, 0).alias("predicted_0"),
            cell(a, 1).alias("predicted_1"),
        )
        for a in (0, 1)
    ]
    return scored.agg(F.array(*rows).alias("m")).select(F.inline("m"))


def recall(scored: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    """True positives over positives, 0 when there are none."""
    positive = F.count_if(F.col(label) == 1)
    found = F.count_if((F.col(label) == 1) & (F.col(predicted) == 1))
    return scored.agg(
        F.coalesce(F.try_divide(found, positive), F.lit(0.0)).alias("recall")
    )


def precision(scored: DataFrame, label: str = "label", predicted: str = "predicted") -> DataFrame:
    return recall(scored, predicted, label).withColumnRenamed("recall", "precision")


def tune(
    train: DataFrame,
    n_trials: int = TRIALS,
    parallel: int = PARALLEL_TRIALS,
    base: BoostParams = BoostParams(),
) -> tuple[BoostParams, DataFrame]:
    """The parameters of best recall on a validation slice of the training part (never
    on the hold-out), precision breaking ties, then the earlier trial; and a table of all trials.

    `parallel` trials at a time are drawn by a tree-structured Parzen estimator from what the
    trials before them gave; they are fitted in one job and checked in one.
    """
    slice_of = F.concat(F.lit("validation:"), F.col("id"))
    held = in_hold_out(slice_of)
    learn_on, check_on = train.where(~held), train.where(held)
    study = tuning.Study(base)
    while len(study.results) < n_trials:
        asked = study.ask(min(parallel, n_trials - len(study.results)))
        scored, counts = check_on, []
        for i, model in enumerate(fit_many(learn_on, asked)):
            scored = predict(model, scored, f"_p{i}")
            found = scoring.threshold(F.col(f"_p{i}"), scoring.EVEN_THRESHOLD) == 1
            counts += [F.count_if(found), F.count_if(found & (F.col("label") == 1))]
        positive, *both = scored.agg(F.count_if(F.col("label") == 1), *counts).first()
        for i, params in enumerate(asked):
            said, true = both[2 * i : 2 * i + 2]
            study.tell(params, true / positive if positive else 0.0, true / said if said else 0.0)
    rows = [
        {"trial": i, **asdict(p), "recall": r, "precision": q}
        for i, (p, r, q) in enumerate(study.results)
    ]
    return study.best(), train.sparkSession.createDataFrame(rows)


def pseudo_label_round(scored: DataFrame, cut: float | None = scoring.CONFIDENCE):
    """(confident rows with their predicted label, the rest), from rows with p; without a cut
    the column `sure` tells which is which."""
    sure = F.col("sure") if cut is None else scoring.is_confident(F.col("p"), cut)
    label = scoring.threshold(F.col("p"), scoring.EVEN_THRESHOLD).alias("label")
    return scored.where(sure).select("id", "features", label), scored.where(~sure).drop("p", "sure")


@dataclass
class SelfTraining:
    model: Forest
    labelled: DataFrame
    remaining: DataFrame
    rounds: DataFrame
    ledger: DataFrame


LEDGER = "round int, added bigint, labelled bigint, remaining bigint, model string"


class Ledger:
    """What each round of self-training did, in a folder: `scored/round=N` holds the rows that
    were still without label, with their p and whether the model was sure; `log/round=N`, written
    after it, the counts and the hash of the model. A round counts once its log is there, so a
    driver that is started again goes on at the round it was in. Rows are read by the columns of
    `unlabelled`, or each round would look into the files of all rounds for them."""

    def __init__(self, spark: SparkSession, path: str, unlabelled: DataFrame):
        self.spark, self.path = spark, path
        known = unlabelled.select("id", "features").schema
        self.schema = known.add("p", "double").add("sure", "boolean")

    def log(self) -> list:
        """The rounds that are complete, in order."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        out = []
        while True:
            folder = f"{self.path}/log/round={len(out) + 1}"
            done = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
            if not done.getFileSystem(conf).exists(done):
                return out
            out.append(self.spark.read.schema(LEDGER).json(folder).first())

    def scored(self, turn: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/scored/round={turn}")

    def write(self, turn: int, scored: DataFrame) -> DataFrame:
        scored.write.mode("overwrite").parquet(f"{self.path}/scored/round={turn}")
        return self.scored(turn)

    def close(self, row: tuple) -> None:
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("overwrite").json(
            f"{self.path}/log/round={row[0]}"
        )

    def picks(self, turns: int) -> DataFrame:
        """(round, id, features, label) of all rows the first rounds labelled."""
        empty = "round int, id string, features array<double>, label int"
        out = self.spark.createDataFrame([], empty)
        for turn in range(1, turns + 1):
            sure, _ = pseudo_label_round(self.scored(turn), None)
            out = out.unionByName(sure.withColumn("round", F.lit(turn)))
        return out


def self_train(
    labelled: DataFrame,
    unlabelled: DataFrame,
    params: BoostParams = BoostParams(),
    max_rounds: int = SELF_TRAINING_ROUNDS,
    cut: float = scoring.CONFIDENCE,
    ledger: str | None = None,
) -> SelfTraining:
    """Fit, label what the model is sure of, move it over, and again.

    Each round's scores are written once to the ledger (a folder of its own below the shared one,
    unless named), so the plan does not grow with the rounds, and a loop that was broken off goes
    on with the same inputs at the round it was in. Only counts and trees reach the driver.
    """
    spark = labelled.sparkSession
    book = Ledger(spark, ledger or scratch_dir(spark, "self-training"), unlabelled)
    labelled = cut_lineage(labelled.select("id", "features", F.col("label").cast("int")))
    log, final = book.log(), None
    size = log[-1]["labelled"] if log else labelled.count()

    def known(turns: int) -> DataFrame:
        return labelled.unionByName(book.picks(turns).drop("round"))

    def rest(turns: int) -> DataFrame:
        if turns:
            return pseudo_label_round(book.scored(turns), None)[1]
        return unlabelled.select("id", "features")

    while len(log) < max_rounds and not (log and not log[-1]["remaining"]):
        turn = len(log) + 1
        model = fit(known(turn - 1), params)
        sure = scoring.is_confident(F.col("p"), cut)
        scored = book.write(turn, predict(model, rest(turn - 1)).withColumn("sure", sure))
        left, added = scored.agg(F.count(F.lit(1)), F.count_if("sure")).first()
        if not added:
            final = model  # fitted on these very rows
            break
        size += added
        row = (turn, added, size, left - added, model.content_hash)
        book.close(row)
        log.append(dict(zip(("round", "added", "labelled", "remaining", "model"), row)))
    done = known(len(log))
    rows = [tuple(r[c] for c in ("round", "added", "labelled", "remaining")) for r in log]
    rounds = spark.createDataFrame(
        rows, "round int, added bigint, labelled bigint, remaining bigint"
    )
    picks = book.picks(len(log)).select("round", "id", "label")
    return SelfTraining(final or fit(done, params), done, rest(len(log)), rounds, picks)


def evaluate_scores(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confusion matrix and recall at p >= 0.5, of rows with p and label."""
    predicted = scored.withColumn(
        "predicted", scoring.threshold(F.col("p"), scoring.EVEN_THRESHOLD, strict=False)
    )
    return confusion_matrix(predicted), recall(predicted)


def evaluate(model: Forest, held_out: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Confusion matrix and recall of a model on the hold-out."""
    return evaluate_scores(predict(model, held_out))


MODEL = "encoder string, dim int, members int, features int, edges string, hash string"


def save_model(model: Forest, path: str, encoder=HashingEncoder()) -> None:
    """The nodes as a table, and the encoder the classifier was trained on, the bin edges and
    the hash of it all."""
    spark = SparkSession.active()
    spark.createDataFrame(model.nodes).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    about = (encoder.name, encoder.dim, model.members, model.dim, json.dumps(model.edges),
             model.content_hash)
    spark.createDataFrame([about], MODEL).coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load_model(path: str, encoder=HashingEncoder()) -> Forest:
    """Refuses a classifier trained on another encoder, and one whose files were changed."""
    spark = SparkSession.active()
    about = spark.read.schema(MODEL).json(f"{path}/about").first()
    if (about["encoder"], about["dim"]) != (encoder.name, encoder.dim):
        raise ValueError(f"classifier expects {about['encoder']}/{about['dim']}")
    nodes = spark.read.parquet(f"{path}/nodes").toArrow()
    model = Forest(
        boosting.in_order(nodes), about["members"], about["features"], json.loads(about["edges"])
    )
    if model.content_hash != about["hash"]:
        raise ValueError(f"the classifier in {path} differs from its hash")
    return model


def score_messages(
    df: DataFrame,
    model: Forest,
    encoder=HashingEncoder(),
    cut: float = scoring.SERVING_THRESHOLD,
    keep: list[str] | tuple[str, ...] = (),
) -> DataFrame:
    """(id, p, important) of messages with subject and body, and the columns named in `keep`,
    in one job."""
    rows = embed(df.select("id", *keep, "subject", "body"), encoder=encoder)
    scored = predict(model, rows.select("id", *keep, "features"))
    return scored.select("id", *keep, "p", scoring.threshold(F.col("p"), cut).alias("important"))


def score_one(
    spark: SparkSession, subject: str, body: str, model, encoder=HashingEncoder()
) -> DataFrame:
    """One ad-hoc message through the same path."""
    row = spark.createDataFrame(
        [("0" * 16, subject, body)], "id string, subject string, body string"
    )
    return score_messages(row, model, encoder)
