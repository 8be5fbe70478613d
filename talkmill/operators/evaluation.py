"""Scores of multiple-choice runs and ranking of model versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from talkmill.functions import grading


def grade(questions: DataFrame, responses: DataFrame, rounds: int = 3, mode: str = "MCQ") -> DataFrame:
    """``id, round, score, question, response`` for every question and round; a
    missing or failed response scores 0."""
    asked = questions.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    return asked.join(responses, ["id", "round"], "left").select(
        "id",
        "round",
        grading.score(F.col("response"), F.col("answer"), mode).alias("score"),
        F.when(F.col("response").isNull(), F.col("mcq_question"))
        .otherwise(F.concat("mcq_question", F.lit("\n\n"), "choice"))
        .alias("question"),
        "response",
        *[c for c in questions.columns if c not in ("id", "mcq_question", "choice", "answer")],
    )


def accuracy(scores: DataFrame, *by: str) -> DataFrame:
    """Share of right answers in percent per ``by``."""
    return scores.groupBy(*by).agg((F.sum("score") / F.count(F.lit(1)) * 100).alias("accuracy"))


def macro_mean(per_dataset: DataFrame) -> DataFrame:
    return per_dataset.agg(F.avg("accuracy").alias("mean_score"))


def accuracy_report(scores: DataFrame) -> DataFrame:
    """Accuracy per (dataset, round), per dataset and over everything."""
    return scores.rollup("dataset", "round").agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum("score") / F.count(F.lit(1)) * 100).alias("accuracy"),
    )


def version_scores(versions: DataFrame, metrics: DataFrame) -> DataFrame:
    """Versions with the score of their evaluation; versions without one are
    left out.  ``tags`` holds the evaluation id."""
    tagged = versions.withColumn("evaluation_id", F.try_element_at("tags", F.lit("evaluation_id")))
    scored = metrics.filter(F.col("mean_score").isNotNull())
    return tagged.join(scored, "evaluation_id")


def champions(scored: DataFrame, metric: str, model: str = "model", version: str = "version") -> DataFrame:
    """``alias`` champion and challenger: the two best versions of each model;
    equal scores keep version order."""
    order = Window.partitionBy(model).orderBy(F.col(metric).desc(), F.col(version))
    # rank <= 2 is applied before the shuffle too (window group limit).
    top = scored.withColumn("_rank", F.row_number().over(order)).filter("_rank <= 2")
    return top.withColumn("alias", F.when(F.col("_rank") == 1, "champion").otherwise("challenger")).drop("_rank")


def latest_numeric_version(rows: DataFrame, version: Column) -> DataFrame:
    """Largest number among version tags (``12`` or ``v12``)."""
    return rows.agg(F.max(version).alias("latest_version"))
