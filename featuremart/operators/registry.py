"""Model runs, versions, promotion and the monthly run decision, as plain tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from featuremart import fixed_values as fixed
from featuremart.functions.dates import month_floor, whole_months_between
from featuremart.operators.pit import latest_per_key


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def best_run(runs: DataFrame, metric: str = "auc_oot", train_date: date | None = None) -> DataFrame:
    """Finished run with the highest metric, for one or for every training date."""
    value = F.col(metric)
    usable = runs.filter((F.col("status") == "FINISHED") & value.isNotNull() & ~F.isnan(value))
    if train_date is not None:
        usable = usable.filter(F.col("train_date") == F.lit(train_date))
    return latest_per_key(usable, ["train_date"], [metric])


def promotion_decision(
    runs: DataFrame, metric: str = "auc_oot", min_test: float | None = fixed.MIN_TEST_AUC
) -> DataFrame:
    """Outcome per training date: ``promote``, ``guard_failed`` or ``no_run``."""
    best = best_run(runs, metric).select("train_date", "run_id", metric, "auc_test")
    every_date = runs.select("train_date").distinct()
    passes = F.lit(True) if min_test is None else F.coalesce(F.col("auc_test") >= min_test, F.lit(False))
    outcome = (
        F.when(F.col("run_id").isNull(), "no_run").when(passes, "promote").otherwise("guard_failed")
    )
    return every_date.join(best, "train_date", "left").select("*", outcome.alias("outcome"))


def latest_in_stage(registry: DataFrame, stage: str = "Production", keys: Sequence[str] = ("model_name",)) -> DataFrame:
    """Highest version of each model in a stage."""
    return latest_per_key(registry.filter(F.col("stage") == stage), list(keys), ["version"])


def champion_challenger(
    candidates: DataFrame,
    registry: DataFrame,
    metric: str = "auc_oot",
    epsilon: float = fixed.PROMOTION_EPSILON,
) -> DataFrame:
    """Whether each candidate beats the current production model by more than epsilon.

    No current model, or one without the metric, loses; a candidate without it never wins.
    """
    current = latest_in_stage(registry).select(
        "model_name", F.col(metric).alias("current_metric"), F.col("version").alias("current_version")
    )
    new, old = F.nanvl(F.col(metric), F.lit(None)), F.nanvl(F.col("current_metric"), F.lit(None))
    wins = new.isNotNull() & (old.isNull() | (new > old + epsilon))
    return candidates.join(current, "model_name", "left").select(
        *candidates.columns, "current_version", "current_metric", wins.alias("promote")
    )


def transition_stage(
    registry: DataFrame,
    chosen: DataFrame,
    stage: str = "Production",
    archive_existing: bool = True,
    snapshot: Sequence[str] = (),
) -> DataFrame:
    """Move chosen versions into a stage and archive the versions they replace.

    ``chosen`` has one ``version`` per ``model_name``.  The chosen rows get the listed
    columns as JSON text in ``description``; other rows keep theirs.
    """
    pick = chosen.select("model_name", F.col("version").alias("_chosen"))
    is_chosen = F.col("version") == F.col("_chosen")
    replaced = F.col("_chosen").isNotNull() & (F.col("stage") == stage) & F.lit(archive_existing)
    new_stage = F.when(is_chosen, stage).when(replaced, "Archived").otherwise(F.col("stage"))
    noted = [c for c in snapshot or registry.columns if c != "description"]
    old = F.col("description") if "description" in registry.columns else F.lit(None).cast("string")
    note = F.when(is_chosen, F.to_json(F.struct(*noted))).otherwise(old)
    return registry.join(pick, "model_name", "left").select(
        *[new_stage.alias("stage") if c == "stage" else F.col(c) for c in registry.columns if c != "description"],
        note.alias("description"),
    )


def promotion_note(prefix: str = "") -> Column:
    """Nested JSON of what is known at promotion: ``metrics`` and ``params`` of a run."""
    metrics = F.struct(*[F.col(f"{prefix}{m}").alias(m) for m in fixed.SNAPSHOT_METRICS])
    params = F.struct(*[F.col(f"{prefix}{p}").alias(p) for p in (
        "flavor", "train_start", "train_end", "oot_start", "oot_end")])
    return F.to_json(F.struct(F.col(f"{prefix}run_id").alias("run_id"), metrics.alias("metrics"), params.alias("params")))


def promote(registry: DataFrame, chosen: DataFrame, at: Column | None = None) -> DataFrame:
    """Registry after chosen versions went to production, with nested note, flag and time."""
    moved = transition_stage(registry, chosen, snapshot=["version"])
    pick = chosen.select("model_name", F.col("version").alias("_chosen"))
    is_chosen = F.col("version") == F.col("_chosen")
    new = {
        "description": F.when(is_chosen, promotion_note()).otherwise(F.col("description")),
        "promoted_flag": F.when(is_chosen, True).otherwise(F.col("promoted_flag")),
        "promoted_at": F.when(is_chosen, F.current_timestamp() if at is None else at).otherwise(F.col("promoted_at")),
    }
    return moved.join(pick, "model_name", "left").select(
        *[new[c].alias(c) if c in new else F.col(c) for c in moved.columns])


def dedupe_runs(runs: DataFrame, flag: str = "promoted_flag", at: str = "promoted_at") -> DataFrame:
    """Of rows equal in everything else, the promoted and most recently promoted one."""
    keys = [c for c in runs.columns if c not in (flag, at)]
    return latest_per_key(runs, keys, [flag, at]).select(*runs.columns)


def month_coverage(
    dates: Sequence[DataFrame], anchor: Column, minimum: int = fixed.MIN_HISTORY_MONTHS
) -> DataFrame:
    """Consecutive months, ending at the anchor month, that every table has.

    Each input is a one-column frame of dates.  They are reduced to distinct months
    before anything else; what remains is one row per calendar month.
    """
    monthly = [
        df.select(month_floor(df.columns[0]).alias("month")).filter(F.col("month").isNotNull()).distinct()
        for df in dates
    ]
    shared = reduce(lambda a, b: a.join(b, "month", "left_semi"), monthly)
    index = F.year("month") * 12 + F.month("month")
    anchor_month = month_floor(anchor)
    back = F.year(anchor_month) * 12 + F.month(anchor_month) - index
    gap = back - (F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("month"))) - 1)
    run = shared.filter(F.col("month") <= anchor_month).select(gap.alias("gap"))
    ready = F.count_if(F.col("gap") == 0)
    return run.agg(ready.alias("months_ready"), (ready >= minimum).alias("enough"))


def run_decision(
    registry: DataFrame,
    dates: Sequence[DataFrame],
    run_date: date,
    model_name: str,
    force: bool = False,
    retrain_after: int = fixed.RETRAIN_AFTER_MONTHS,
    minimum: int = fixed.MIN_HISTORY_MONTHS,
) -> DataFrame:
    """``train`` or ``infer`` for a run date and one model.

    Training needs enough consecutive months before the run month, and either a forced
    run, no production version of the model, or one at least ``retrain_after`` whole
    months old.
    """
    today = F.lit(run_date)
    newest = registry.filter((F.col("stage") == "Production") & (F.col("model_name") == model_name)).agg(
        F.max_by("train_date", "version").alias("last_train_date")
    )
    coverage = month_coverage(dates, F.add_months(today, -1), minimum).select(
        F.struct("months_ready", "enough").alias("c")
    )
    apart = whole_months_between("last_train_date", "run_date")
    due = F.coalesce(F.col("months_apart") >= retrain_after, F.lit(True))
    return (
        newest.select(today.alias("run_date"), "last_train_date", coverage.scalar().alias("c"))
        .select("run_date", "last_train_date", apart.alias("months_apart"), "c.months_ready", "c.enough")
        .select(
            "*",
            due.alias("training_due"),
            F.when(F.col("enough") & (F.lit(force) | due), "train").otherwise("infer").alias("next_step"),
        )
    )
