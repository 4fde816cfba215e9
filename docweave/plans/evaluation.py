"""Evaluation: a resumable run over questions with known answers, and aggregates over its scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as tx
from docweave.sources.store import Store

# The metrics and the domain that is out of scope.
METRICS = ("faithfulness", "answer_relevancy", "context_precision", "context_recall")
OUT_OF_SCOPE = "out_of_scope"


def slice_scores(scores: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Mean of every metric (unscored rows left out, 4 digits) and row count per slice.

    Slices: ``overall``, ``in_scope`` and ``domain:<name>``. Each row joins its slices before
    one grouping, which combines on the map side; a large domain is one row per task.
    """
    slices = F.array_compact(
        F.array(
            F.lit("overall"), F.when(F.col("domain") != OUT_OF_SCOPE, "in_scope"), F.concat(F.lit("domain:"), F.col("domain"))
        )
    )
    present = [m for m in metrics if m in scores.columns]
    rows = scores.select(F.explode_outer(slices).alias("slice"), *present)
    scored = {m: F.when(~F.isnan(m), F.col(m)) for m in present}
    return rows.groupBy("slice").agg(
        *[F.bround(F.avg(c), 4).alias(m) for m, c in scored.items()],
        *[F.count(c).alias(f"{m}_scored") for m, c in scored.items()],
        F.count(F.lit(1)).alias("count"),
    )


def coverage(scores: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """``metric, scored, total``: how many rows each metric has a number for."""
    present = [m for m in metrics if m in scores.columns]
    if not present:
        raise ValueError(f"no column of {', '.join(metrics)}")
    long = scores.unpivot([], present, "metric", "value")
    scored = F.count(F.when(~F.isnan("value"), F.col("value"))).alias("scored")
    return long.groupBy("metric").agg(scored, F.count(F.lit(1)).alias("total"))


# ---------------------------------------------------------------- the run

# (question, answer, contexts, ground truth) -> a score per metric; NaN or NULL where it can't be judged.
Judge = Callable[[Column, Column, Column, Column], dict[str, Column]]


def word_judge(question: Column, answer: Column, contexts: Column, truth: Column) -> dict[str, Column]:
    """Offline judge by shared words; a model that scores answers has the same form."""
    words = lambda text: F.array_distinct(tx.words(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}\s]+", " "))))
    share = lambda part, whole: F.when(F.size(part) > 0, F.size(F.array_intersect(part, whole)) / F.size(part)).otherwise(F.lit(float("nan")))
    read = words(F.array_join(contexts, " "))
    useful = F.size(F.filter(contexts, lambda c: F.size(F.array_intersect(words(c), words(truth))) > 0))
    return {
        "faithfulness": share(words(answer), read), "answer_relevancy": share(words(question), words(answer)),
        "context_precision": F.when(F.size(contexts) > 0, useful / F.size(contexts)).otherwise(F.lit(float("nan"))),
        "context_recall": share(words(truth), read),
    }


def first_items(items: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` questions by ``item_id``; None or 0 takes all."""
    return items.orderBy("item_id").limit(limit) if limit else items


def evaluation_run(
    store: Store, items: DataFrame, answer: Callable[[DataFrame], DataFrame], judge: Judge = word_judge, limit: int | None = None, batch_rows: int = 1000
) -> DataFrame:
    """Answer and score the questions ``items`` (``item_id, question, ground_truth, domain``) -> ``evaluation_rows``.

    ``answer`` maps ``query_id, query`` to ``query_id, answer, contexts``. What is stored stays: only questions without a row are
    answered, a batch at a time, and every batch is committed by itself, so a run that died goes on where it was.
    Citation markers are dropped before an answer is judged. Returns the rows of the questions asked for.
    """
    wanted = first_items(items, limit).select("item_id", "question", F.coalesce("ground_truth", F.lit("")).alias("ground_truth"), F.coalesce("domain", F.lit("unknown")).alias("domain"))
    number = 1 + wanted.count() // batch_rows
    for batch in range(number):
        part = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(number)) == batch)
        if store.exists("evaluation_rows"):
            part = part.join(store.read("evaluation_rows").select("item_id"), "item_id", "left_anti")
        if part.isEmpty():
            continue
        told = answer(part.select(F.col("item_id").alias("query_id"), F.col("question").alias("query")))
        told = told.select(F.col("query_id").alias("item_id"), tx.strip_citations(F.col("answer")).alias("answer"), F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"))
        joined = part.join(told, "item_id")
        scores = judge(F.col("question"), F.col("answer"), F.col("contexts"), F.col("ground_truth"))
        store.merge("evaluation_rows", joined.select("*", *(F.coalesce(c.cast("double"), F.lit(float("nan"))).alias(m) for m, c in scores.items())), "item_id", buckets=16)
    if not store.exists("evaluation_rows"):
        raise ValueError("there are no questions to evaluate")
    return store.read("evaluation_rows").join(wanted.select("item_id"), "item_id", "left_semi")
