"""The whole datamart: one folder per table, one job per table for any number of months."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.functions.dates import TrainingWindows, assign_split
from featuremart.operators import metrics, modelling, pit, registry, sampling
from featuremart.operators.prep import Preprocessor
from featuremart.plans import gold, monitoring, pretrain, silver
from featuremart.session import materialise
from featuremart.sources import tables
from featuremart.sources.buckets import BucketedTable
from featuremart.sources.runs import VersionedTable

SILVER_STEPS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "loan_daily": silver.silver_loans,
    "clickstream": silver.silver_clickstream,
    "attributes": silver.silver_attributes,
    "financials": silver.silver_financials,
}
# gold table -> (silver table, step)
GOLD_STEPS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "label_store": ("loan_daily", gold.label_store),
    "feature_clickstream": ("clickstream", gold.gold_clickstream),
    "feature_attributes": ("attributes", gold.gold_attributes),
    "feature_financials": ("financials", gold.gold_financials),
}


@dataclass(frozen=True)
class Datamart:
    """Locations of all tables below one root folder.

    With ``buckets`` the gold tables are cut by customer as well, so that training rows are
    joined where they lie.  The number is fixed once a table is written: choose it so that
    a month's bucket has some 200 MB.
    """

    spark: SparkSession
    root: str
    buckets: int | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def read(self, layer: str, table: str, start: date | None = None, end: date | None = None) -> DataFrame:
        df = (tables.read_table(self.spark, self.path(layer, table)) if self.buckets is None or layer != "gold"
              else self._bucketed(table).read())
        column = pit.LABEL_DATE if pit.LABEL_DATE in df.columns else tables.SNAPSHOT
        return _between(df, column, start, end)

    def _bucketed(self, table: str, partition: str = tables.SNAPSHOT) -> BucketedTable:
        assert self.buckets is not None
        return BucketedTable(self.spark, self.path("gold", table), pit.KEY, self.buckets, partition)

    def _write_gold(
        self, built: DataFrame, table: str, covered: tuple[date | None, date | None], partition: str = tables.SNAPSHOT,
        rebalance: bool = True,
    ) -> None:
        if self.buckets is None:
            tables.write_snapshot(
                built, self.path("gold", table), partition_by=[partition], covered=covered, rebalance=rebalance)
        else:
            self._bucketed(table, partition).write(built, covered)

    # --- layers -------------------------------------------------------------------
    def build_bronze(self, raw: Mapping[str, str], start: date | None = None, end: date | None = None) -> None:
        """Land the raw extracts, all wanted months of a source in one scan, as they come: text rows are not shuffled."""
        one_month = start if start is not None and start == end else None
        for name, frame in tables.ingest_all(self.spark, raw, one_month).items():
            if tables.SNAPSHOT not in frame.columns:
                raise ValueError(f"{name} has no {tables.SNAPSHOT}; land it month by month, so that it gets the month's date")
            tables.write_snapshot(
                _between(frame, tables.SNAPSHOT, start, end), self.path("bronze", name), covered=(start, end),
                rebalance=False)

    def build_silver(self, start: date | None = None, end: date | None = None) -> None:
        for name, step in SILVER_STEPS.items():
            tables.write_snapshot(
                step(self.read("bronze", name, start, end)), self.path("silver", name), covered=(start, end),
                rebalance=False)  # row by row from months to the same months

    def build_gold(
        self, start: date | None = None, end: date | None = None, dpd: int = 30, mob: int = 6
    ) -> None:
        for name, (source, step) in GOLD_STEPS.items():
            frame = self.read("silver", source, start, end)
            built = step(frame, dpd, mob) if name == "label_store" else step(frame)
            self._write_gold(built, name, (start, end), rebalance=False)

    def build_pretrain(
        self,
        start: date | None = None,
        end: date | None = None,
        mob: int = 6,
        strategy: str = "latest",
        drop_nulls: bool = False,
    ) -> None:
        """Features for the labels of the given months; reads the labels, so runs after them.

        Feature tables are read over all months: the cutoff prunes what no label can use.
        """
        built = pretrain.pretrain_features(
            self.read("gold", "label_store", start, end),
            self.read("gold", "feature_attributes"),
            self.read("gold", "feature_financials"),
            self.read("gold", "feature_clickstream"),
            mob, strategy, drop_nulls,
        )
        self._write_gold(built, "pretrain_features", (start, end), pit.LABEL_DATE, rebalance=False)

    def build_training(
        self, start: date | None = None, end: date | None = None, drop_nulls: bool = False
    ) -> None:
        built = pretrain.training_rows(
            self.read("gold", "pretrain_features", start, end),
            self.read("gold", "label_store", start, end),
            drop_nulls,
        )
        self._write_gold(built, "training", (start, end), pit.LABEL_DATE, rebalance=False)

    # --- runs ---------------------------------------------------------------------
    def backfill(
        self,
        raw: Mapping[str, str],
        start: date | None = None,
        end: date | None = None,
        dpd: int = 30,
        mob: int = 6,
    ) -> None:
        """Every layer for every month of the range; running it again changes nothing."""
        self.build_bronze(raw, start, end)
        self.build_silver(start, end)
        self.build_gold(start, end, dpd, mob)
        self.build_pretrain(start, end, mob)
        self.build_training(start, end)

    def run_month(self, raw: Mapping[str, str], month: date) -> None:
        """The same for one new month; other months stay as they are."""
        self.backfill(raw, month, month)

    # --- models -------------------------------------------------------------------
    def runs(self) -> DataFrame:
        """The run table; empty before the first training."""
        return tables.read_runs(self.spark, self.path("models", "runs"))

    def train(
        self,
        windows: TrainingWindows,
        steps: Callable[[DataFrame], Preprocessor],
        learner: Callable[[int], Estimator],
        train_date: date,
        model_name: str,
        flavor: str,
    ) -> str:
        """Fit on the training window, judge all splits, store the model and append the run; its id."""
        rows = self.read("gold", "training")
        dated = rows.withColumn("_window", assign_split(pit.LABEL_DATE, windows)).filter(F.col("_window").isNotNull())
        split = sampling.stratified_split(
            dated.filter("_window = 'train_test'"), "label", columns=["loan_id", pit.KEY, pit.LABEL_DATE])
        every = materialise(split.unionByName(dated.filter("_window = 'oot'").withColumn("split", F.lit("oot"))), "splits")
        train = every.filter("split = 'train'").drop("_window", "split")
        fitted, model = modelling.fit_rows(train, steps(train), learner)
        scored = materialise(modelling.score_rows(model, fitted, every, ["label", "split"]), "scored")
        quality = metrics.evaluate_splits(scored).agg(*[
            F.max(F.when(F.col("split") == s, F.col(c))).alias(f"{n}_{s}")
            for s in ("train", "test", "oot") for c, n in (("auc_roc", "auc"), ("gini", "gini"))
        ], F.max(F.when(F.col("split") == "test", F.col("accuracy"))).alias("accuracy_test"),
            F.max(F.when(F.col("split") == "test", F.col("f1_weighted"))).alias("f1_weighted_test"))
        known = self.runs().filter(F.col("model_name") == model_name).agg(F.max("version").alias("v")).first()["v"]
        version = (known or 0) + 1
        run_id = f"{model_name}-{train_date.isoformat()}-{version}"
        uri = self.path("models", run_id)
        model.write().overwrite().save(uri)
        fitted.save(self.spark, uri + "-steps")
        tables.append_runs(quality.select(
            "*", F.lit(str(version)).alias("model_version"), F.lit(version).alias("version"), F.lit(run_id).alias("run_id"),
            F.lit("FINISHED").alias("status"), F.lit(train_date).alias("train_date"), F.lit(flavor).alias("flavor"),
            F.lit(model_name).alias("model_name"), F.lit("None").alias("stage"), F.lit(uri).alias("model_uri"),
            F.lit(False).alias("promoted_flag"), F.lit(windows.train_test_start).alias("train_start"),
            F.lit(windows.train_test_end).alias("train_end"), F.lit(windows.oot_start).alias("oot_start"),
            F.lit(windows.oot_end).alias("oot_end")), self.path("models", "runs"))
        return run_id

    def promote_best(self, train_date: date, min_test: float | None = fixed.MIN_TEST_AUC) -> DataFrame:
        """Move the best run of a training date to production if it passes the guard; the outcome.

        The run table changes in one step; the outcome is that of the version it changed.
        """
        found: list[DataFrame] = []

        def promoted(stored: DataFrame | None) -> DataFrame | None:
            runs = tables.no_runs(self.spark) if stored is None else stored
            outcome = materialise(registry.promotion_decision(
                runs.filter(F.col("train_date") == F.lit(train_date)), min_test=min_test), "outcome")
            found.append(outcome)
            chosen = outcome.filter("outcome = 'promote'").select("run_id")
            if chosen.isEmpty():
                return None
            return registry.promote(runs, runs.join(chosen, "run_id", "left_semi").select("model_name", "version"))

        VersionedTable(self.spark, self.path("models", "runs")).update(promoted)
        return found[-1]

    def score(self, day: date, model_name: str, load: Callable[[str], Model], scored_at: Column | None = None) -> None:
        """Score one label date with the model in production and store the predictions."""
        current = registry.latest_in_stage(self.runs().filter(F.col("model_name") == model_name)).first()
        if current is None:
            raise ValueError(f"no production version of {model_name}")
        uri = current["model_uri"]
        predictions = modelling.score_snapshot(
            load(uri), Preprocessor.load(self.spark, uri + "-steps"), self.read("gold", "training"), day,
            model_uri=uri, model_version=current["model_version"], model_stage=current["stage"], scored_at=scored_at)
        tables.write_predictions(predictions, self.path("gold", "predictions"))

    def predictions(self) -> DataFrame:
        return tables.read_predictions(self.spark, self.path("gold", "predictions"))

    def monitor(self, predictions: DataFrame | None = None, threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
        """Monitoring table of given, or of all stored, predictions against the labels."""
        found = self.predictions() if predictions is None else predictions
        return metrics.monitor(found, self.read("gold", "label_store"), threshold=threshold)

    def monitor_month(self, month: date, threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
        """The same of stored predictions, after one month was counted anew; other months come from stored counts."""
        path = self.path("gold", "score_counts")
        monitoring.update_state(self.predictions(), self.read("gold", "label_store"), path, month, month)
        return monitoring.monitor_state(self.spark, path, threshold)


def _between(df: DataFrame, column: str, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(column) <= F.lit(end))
    return df
