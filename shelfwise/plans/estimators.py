"""Fit/transform objects for Spark ML pipelines, backed by small tables."""

from __future__ import annotations

from typing import Any

from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import pricing, tfidf
from shelfwise.plans import features, train
from shelfwise.session import materialize


class _Writer(MLWriter):
    def __init__(self, stage: "Stored") -> None:
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        plain = {name: getattr(self.stage, name) for name in self.stage._plain}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extraMetadata={"plain": plain})
        for name in self.stage._tables:
            getattr(self.stage, name).write.parquet(f"{path}/{name}")
        self.stage._save_more(f"{path}/more", self.sparkSession)


class _Reader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> Any:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.cls.__new__(self.cls)
        super(self.cls, stage).__init__()
        for name, value in metadata["plain"].items():
            setattr(stage, name, value)
        for name in self.cls._tables:
            setattr(stage, name, self.sparkSession.read.parquet(f"{path}/{name}"))
        stage._load_more(f"{path}/more", self.sparkSession)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class Stored(MLWritable, MLReadable):
    """A stage that pipelines can save and load: ``_plain`` names attributes that go with the
    metadata, ``_tables`` those that are DataFrames and go to Parquet beside it."""

    _plain: tuple[str, ...] = ()
    _tables: tuple[str, ...] = ()

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _save_more(self, path: str, spark: SparkSession) -> None:
        pass

    def _load_more(self, path: str, spark: SparkSession) -> None:
        pass


class CompetitorPricing(Estimator, Stored, HasInputCol, HasOutputCol):
    """Learns the median price per tag from ``inputCol`` (a list of tags)."""

    _plain = ("price", "approx")

    def __init__(self, inputCol: str = "tags", outputCol: str = "competitor_pricing", price: str = "current_price",
                 approx: bool = False) -> None:
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.price, self.approx = price, approx

    def _fit(self, dataset: DataFrame) -> "CompetitorPricingModel":
        medians = pricing.tag_median_prices(dataset, self.getInputCol(), self.price, self.approx)
        return CompetitorPricingModel(materialize(medians, "tag-prices"), self.getInputCol(), self.getOutputCol(), self.price)


class CompetitorPricingModel(Model, Stored, HasInputCol, HasOutputCol):
    """Adds the mean of the tags' median prices."""

    _plain, _tables = ("price",), ("tag_prices",)

    def __init__(self, tag_prices: DataFrame, inputCol: str, outputCol: str, price: str) -> None:
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.tag_prices, self.price = tag_prices, price

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return pricing.competitor_price(dataset, self.tag_prices, self.getInputCol(), self.price, self.getOutputCol())

    def save_state(self, path: str) -> None:
        self.tag_prices.write.mode("overwrite").parquet(path)

    @classmethod
    def load_state(cls, spark: SparkSession, path: str, inputCol: str = "tags", outputCol: str = "competitor_pricing",
                   price: str = "current_price") -> "CompetitorPricingModel":
        return cls(spark.read.parquet(path), inputCol, outputCol, price)


class ReviewScore(Estimator, Stored, HasInputCol, HasOutputCol):
    """Learns term weights and the main direction of the texts in ``inputCol``. Of a listing that
    occurs several times the text is read once and counts that often."""

    _plain = ("key", "max_features", "steps")

    def __init__(self, inputCol: str = "review", outputCol: str = "review_score", key: str = "game_id",
                 max_features: int = tfidf.MAX_FEATURES, steps: int = tfidf.MAX_STEPS) -> None:
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.key, self.max_features, self.steps = key, max_features, steps

    def _fit(self, dataset: DataFrame) -> "ReviewScoreModel":
        text = self.getInputCol()
        texts = dataset.select(self.key, text).where(F.col(text) != "").dropDuplicates([self.key])
        copies = tfidf.document_copies(dataset, self.key)
        state = tfidf.fit_review_score(texts, self.key, text, copies, self.max_features, self.steps)
        return ReviewScoreModel(state, self.getInputCol(), self.getOutputCol(), self.key)


class ReviewScoreModel(Model, Stored, HasInputCol, HasOutputCol):
    """Adds the projection of each text on the fitted direction."""

    _plain, _tables = ("key",), ("state",)

    def __init__(self, state: DataFrame, inputCol: str, outputCol: str, key: str) -> None:
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)
        self.state, self.key = state, key

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = tfidf.add_review_score(dataset, dataset, self.state, self.key, self.getInputCol())
        return scored.withColumnRenamed("review_score", self.getOutputCol())

    def save_state(self, path: str) -> None:
        self.state.write.mode("overwrite").parquet(path)

    @classmethod
    def load_state(cls, spark: SparkSession, path: str, inputCol: str = "review", outputCol: str = "review_score",
                   key: str = "game_id") -> "ReviewScoreModel":
        return cls(spark.read.parquet(path), inputCol, outputCol, key)


class DropColumns(Transformer, Stored):
    """Pipeline form of a lenient column drop."""

    _plain = ("columns",)

    def __init__(self, *columns: str) -> None:
        super().__init__()
        self.columns = columns

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.columns)


class CleanListings(Transformer, Stored):
    """Raw listing rows to numbers and lists, as ``features.raw_numbers`` does; drops no row."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return features.raw_numbers(dataset)


class KnownItemsModel(Model, Stored, HasInputCol):
    """Keeps the items of the list in ``inputCol`` that the vocabulary holds."""

    _tables = ("vocabulary",)

    def __init__(self, vocabulary: DataFrame, inputCol: str) -> None:
        super().__init__()
        self._set(inputCol=inputCol)
        self.vocabulary = vocabulary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return pricing.restrict_to_vocabulary(dataset, self.getInputCol(), self.vocabulary)


class FittedRegressor(Model, Stored):
    """A linear fit or extremely randomised trees as the last stage; adds ``prediction``."""

    _plain = ("family",)

    def __init__(self, family: str, model: Any) -> None:
        super().__init__()
        self.family, self.model = family, model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.model.transform(dataset)

    def _save_more(self, path: str, spark: SparkSession) -> None:
        train.save_model(self.model, path, spark)

    def _load_more(self, path: str, spark: SparkSession) -> None:
        self.model = train.load_model(path, self.family, spark)


def scoring_pipeline(state: features.FeatureState, vectors: PipelineModel, family: str, model: Any, text: str = "review") -> PipelineModel:
    """One pipeline from raw listing rows with their text to ``prediction``: all fitted state, the
    vectorizer and the model of any family. ``write().save`` keeps it whole, ``PipelineModel.load`` brings it back."""
    last = FittedRegressor(family, model) if family in ("LinearSVR", "ExtraTrees") else model
    return PipelineModel([
        CleanListings(),
        KnownItemsModel(state.genres, "genres"),
        KnownItemsModel(state.tags, "tags"),
        ReviewScoreModel(state.terms, text, "review_score", "game_id"),
        CompetitorPricingModel(state.tag_prices, "tags", "competitor_pricing", "current_price"),
        vectors,
        last,
    ])
