"""Image captions: cache lookup, optional model, contextual fallback."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import text as tx

CaptionModel = Callable[[Column, Column], Column]

# Makes a client in a task; a client maps (content hash, prompt) to a caption and raises when it can't.
ClientMaker = Callable[[], Callable[[str, str], str]]

# Tries per image, and the longest pause between two of them, in seconds.
TRIES, LONGEST_PAUSE = 4, 8.0

MADE = "sha string, text string, error_type string"


def caption_images(
    images: DataFrame, cache: DataFrame, model_name: str, fields: dict[str, Column], model: CaptionModel | None = None
) -> DataFrame:
    """Adds ``caption, status, source`` to images with ``sha`` (NULL: file missing) and ``path_ok``.

    ``cache``: ``model, sha, text``, one row per pair. A new caption is asked for once per
    distinct content, so copies never reach the model twice.
    """
    known = cache.filter(F.col("model") == model_name).select("sha", tx.clean(F.col("text")).alias("cached")).filter("cached <> ''")
    joined = images.join(known, "sha", "left")
    joined = joined.withColumn("prompt", tx.caption_prompt(fields)).withColumn("fallback", tx.fallback_caption(fields))
    fresh = F.lit(None).cast("string")
    if model is not None:
        asked = joined.filter("path_ok AND sha IS NOT NULL AND cached IS NULL").groupBy("sha").agg(F.min("prompt").alias("asked"))
        made = asked.select("sha", model(F.col("sha"), F.col("asked")).alias("fresh"))
        joined = joined.join(made, "sha", "left")
        fresh = F.nullif(tx.clean(F.col("fresh")), F.lit(""))
    status = (
        F.when(~F.col("path_ok"), "invalid_path")
        .when(F.col("sha").isNull(), "missing_image")
        .when(F.col("cached").isNotNull(), "cached")
        .when(F.lit(model is None), "missing_api_key")
        .when(fresh.isNotNull(), "generated")
        .otherwise("generation_failed")
    )
    used = F.when(status == "cached", F.col("cached")).when(status == "generated", fresh)
    return joined.select(
        *images.columns, F.coalesce(used, F.col("fallback")).alias("caption"), status.alias("status"),
        F.when(status.isin("cached", "generated"), "model").otherwise("fallback").alias("source"),
    )


def refreshed_cache(cache: DataFrame, captioned: DataFrame, model_name: str) -> DataFrame:
    """The cache with the captions made in this run."""
    made = captioned.filter("status = 'generated'").groupBy("sha").agg(F.min("caption").alias("text"))
    rows = made.select(F.lit(model_name).alias("model"), "sha", "text")
    return cache.select("model", "sha", "text").unionByName(rows)


def made_captions(asked: DataFrame, make_client: ClientMaker, tries: int = TRIES, pause: float = 1.0) -> DataFrame:
    """``(sha, text, error_type)`` for ``asked`` (``sha, prompt``): one client per task, ``tries`` calls per image at most.

    An image that fails every time has a NULL text and the kind of its last error; it ends nothing. An empty answer
    counts as a failure.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = make_client()
        for batch in batches:
            rows = []
            for sha, prompt in zip(batch["sha"], batch["prompt"]):
                text, why = None, None
                for attempt in range(tries):
                    try:
                        text = " ".join((client(sha, prompt) or "").split()) or None
                        why = None if text else "EmptyCaption"
                    except Exception as error:  # noqa: BLE001 - whatever a remote model raises
                        why = type(error).__name__
                    if text:
                        break
                    if attempt + 1 < tries:
                        time.sleep(min(pause * 2**attempt, LONGEST_PAUSE))
                rows.append((sha, text, why))
            yield pd.DataFrame(rows, columns=["sha", "text", "error_type"])

    return asked.select("sha", "prompt").mapInPandas(run, MADE)
