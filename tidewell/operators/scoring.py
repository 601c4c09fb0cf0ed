"""Scorers: add `sentiment_result` and `classification_result` to rows of text.

A scorer is a function from a DataFrame with `review_text` to the same rows with
both result columns. A row that cannot be scored keeps null results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.lexicon import SERVICE_LEXICON, Lexicon, leading_theme, occurrences, polarity, tokens, weight
from tidewell.session import shared_dir

Scorer = Callable[[DataFrame], DataFrame]

TEXT = "review_text"


def sentiment_result(label: Column) -> Column:
    entry = F.struct(F.lit("overall").alias("name"), label.alias("sentiment"))
    return F.when(label.isNotNull(), F.struct(F.array(entry).alias("categories")))


def classification_result(label: Column) -> Column:
    return F.when(label.isNotNull(), F.struct(F.array(label).alias("labels")))


def sentiment_label() -> Column:
    return F.get(F.col("sentiment_result.categories"), F.lit(0))["sentiment"]


def theme_label() -> Column:
    return F.get(F.col("classification_result.labels"), F.lit(0))


def lexicon_scorer(lexicon: Lexicon = SERVICE_LEXICON) -> Scorer:
    """Score with word lists, in column expressions only: no shuffle, no Python."""

    def score(rows: DataFrame) -> DataFrame:
        # The columns of the rows travel in a struct, so they may have any names.
        words = rows.select(F.struct("*").alias("row"), tokens(F.col(TEXT)).alias("words"))
        counted = words.select(
            "row", weight(F.col("words"), lexicon.positive).alias("positive"), weight(F.col("words"), lexicon.negative).alias("negative"),
            *[occurrences(F.col("words"), kw).alias(f"theme_{i}") for i, kw in enumerate(lexicon.themes.values())],
        )
        themes = {name: F.col(f"theme_{i}") for i, name in enumerate(lexicon.themes)}
        has_text = F.col("row").getField(TEXT).isNotNull()
        labelled = counted.withColumn("label", F.when(has_text, polarity(F.col("positive"), F.col("negative"))))
        themed = labelled.withColumn("theme", F.when(has_text, leading_theme(themes, F.col("label"))))
        return themed.select(
            *[F.col("row").getField(c).alias(c) for c in rows.columns],
            sentiment_result(F.col("label")).alias("sentiment_result"),
            classification_result(F.col("theme")).alias("classification_result"),
        )

    return score


def function_scorer(label_text: Callable[[str], tuple[str | None, str | None]], error: str | None = None) -> Scorer:
    """Score with a user's function from text to (sentiment, theme).

    A text the function fails on gets nulls and the run goes on; `error` names a
    column to add that says what failed. Only the text goes through Python.
    """

    def one(text) -> tuple[str | None, str | None, str | None]:
        if text is None:
            return None, None, None
        try:
            return (*label_text(text), None)
        except Exception as e:
            return None, None, f"{type(e).__name__}: {e}"

    @F.pandas_udf("label string, theme string, error string")
    def judged(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame([one(t) for t in batch], columns=["label", "theme", "error"], dtype=object)

    def score(rows: DataFrame) -> DataFrame:
        scored = rows.select("*", judged(F.col(TEXT)).alias("_judged"))
        return scored.select(
            *rows.columns,
            sentiment_result(F.col("_judged.label")).alias("sentiment_result"),
            classification_result(F.col("_judged.theme")).alias("classification_result"),
            *([F.col("_judged.error").alias(error)] if error else []),
        )

    return score


def train_scorer(labelled: DataFrame, sentiment: str, theme: str | None = None, features: int = 1 << 14) -> Scorer:
    """Fit text classifiers on labelled rows; training and scoring both run on Spark.

    A fitted classifier is stored in the shared folder and read again: what it keeps of its training
    holds the session, which cannot be sent to tasks once any query of the session has been observed.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
    from pyspark.ml.feature import IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer

    def fit(label: str):
        rows = labelled.select(TEXT, F.col(label).alias("_label")).dropna()
        index = StringIndexer(inputCol="_label", outputCol="_index", stringOrderType="alphabetAsc").fit(rows)
        stages = [
            RegexTokenizer(inputCol=TEXT, outputCol="_w", pattern="[^a-z]+"),
            HashingTF(inputCol="_w", outputCol="_tf", numFeatures=features),
            IDF(inputCol="_tf", outputCol="_x"),
            LogisticRegression(featuresCol="_x", labelCol="_index", maxIter=20, regParam=0.01, predictionCol="_p",
                               rawPredictionCol="_raw", probabilityCol="_prob"),
            IndexToString(inputCol="_p", outputCol="_out", labels=index.labels),
        ]
        *before, classifier, named = Pipeline(stages=stages).fit(index.transform(rows)).stages
        spark = labelled.sparkSession
        path = f"{shared_dir(spark)}/tidewell-{spark.sparkContext.applicationId}/model-{uuid.uuid4().hex[:12]}"
        classifier.save(path)
        return PipelineModel([*before, LogisticRegressionModel.load(path), named])

    models = {"_sentiment": fit(sentiment), "_theme": fit(theme) if theme else None}

    def score(rows: DataFrame) -> DataFrame:
        out = rows.withColumn("_given", F.col(TEXT)).withColumn(TEXT, F.coalesce(TEXT, F.lit("")))
        for name, model in models.items():
            if model is None:
                out = out.withColumn(name, F.lit(None).cast("string"))
            else:
                scored = model.transform(out)
                out = scored.select(*out.columns, F.when(F.col("_given").isNotNull(), F.col("_out")).alias(name))
        return out.withColumn(TEXT, F.col("_given")).select(
            *rows.columns,
            sentiment_result(F.col("_sentiment")).alias("sentiment_result"),
            classification_result(F.col("_theme")).alias("classification_result"),
        )

    return score
