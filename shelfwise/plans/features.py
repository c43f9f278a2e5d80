"""From the combined table to training, scoring and monitoring frames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.scalars import discount_fraction, parse_price
from shelfwise.functions.text import split_trim
from shelfwise.operators import cleaning, encoding, pricing, tfidf
from shelfwise.schemas import MONITORED_FEATURES, SEED
from shelfwise.session import materialize


@dataclass
class FeatureState:
    """Fitted state as small tables: vocabularies, tag prices, term weights. ``counted`` are the texts
    of the fit and the counts of the terms in them; it is not saved."""

    genres: DataFrame
    tags: DataFrame
    tag_prices: DataFrame
    terms: DataFrame
    counted: tuple[DataFrame, DataFrame] | None = None

    _parts = ("genres", "tags", "tag_prices", "terms")

    def save(self, path: str) -> None:
        for part in self._parts:
            getattr(self, part).write.mode("overwrite").parquet(f"{path}/{part}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FeatureState":
        return cls(*[spark.read.parquet(f"{path}/{part}") for part in cls._parts])


def clean_frame(combined: DataFrame, drop_empty: bool = False) -> DataFrame:
    """Complete rows with numeric prices, the target and item lists."""
    frame = cleaning.parse_prices(cleaning.drop_incomplete(combined))
    return frame.withColumns(
        {
            "discount_pct": discount_fraction("current_price", "discounted_price"),
            "genres": split_trim("genres", ",", drop_empty),
            "tags": split_trim("tags", ";", drop_empty),
        }
    )


def listing_rows(combined: DataFrame) -> DataFrame:
    """The combined listings without their text."""
    return combined.drop("review")


def review_texts(combined: DataFrame) -> DataFrame:
    """(game_id, review), each text once however often its listing is repeated."""
    return combined.where(F.col("review") != "").dropDuplicates(["game_id"]).select("game_id", "review")


def fit_state(frame: DataFrame, texts: DataFrame, max_terms: int = tfidf.MAX_FEATURES, steps: int = tfidf.MAX_STEPS) -> FeatureState:
    """Fit on the given frame: pass all rows, or the training rows only to keep the
    hold-out unseen. ``texts`` may be single reviews; they are never joined up."""
    terms, counts = tfidf.fit_and_count(
        texts, copies=tfidf.document_copies(frame, "game_id"), max_features=max_terms, steps=steps
    )
    return FeatureState(
        genres=materialize(encoding.vocabulary(frame, "genres"), "genres"),
        tags=materialize(encoding.vocabulary(frame, "tags"), "tags"),
        tag_prices=materialize(pricing.tag_median_prices(frame), "tag-prices"),
        terms=terms,
        counted=(texts, counts),
    )


def add_features(frame: DataFrame, texts: DataFrame, state: FeatureState) -> DataFrame:
    """Add ``review_score`` and ``competitor_pricing``. The texts of the fit are not counted again."""
    counts = state.counted[1] if state.counted and state.counted[0] is texts else None
    scored = tfidf.add_review_score(frame, texts, state.terms, counts=counts)
    return pricing.competitor_price(scored, state.tag_prices)


def vectorizer(train: DataFrame, state: FeatureState, kind: str = "full") -> PipelineModel:
    """Scaled numbers, derived numbers as they are, then 0/1 per genre and tag."""
    numbers = encoding.NUMERIC_FEATURES
    stats = encoding.scaler_stats(train).first().asDict()
    scaler = NumberScaler({c: (stats[f"mean_{c}"], stats[f"scale_{c}"]) for c in numbers})
    genres = encoding.multi_hot_vectorizer("genres", encoding.vocabulary_items(state.genres), "genres_hot")
    tags = encoding.multi_hot_vectorizer("tags", encoding.vocabulary_items(state.tags), "tags_hot")
    names = [f"scaled_{c}" for c in numbers] + encoding.feature_names(kind)[len(numbers) :]
    assembler = VectorAssembler(inputCols=[*names, "genres_hot", "tags_hot"], outputCol="features")
    return Pipeline(stages=[scaler.transformer(), genres, tags, assembler]).fit(train)


@dataclass
class NumberScaler:
    """Fit-time (mean, scale) per column as a SQL transformer."""

    stats: dict[str, tuple[float, float]]

    def transformer(self):
        from pyspark.ml.feature import SQLTransformer

        terms = [
            f"(CAST({c} AS DOUBLE) - ({mean!r}D)) / {scale!r}D AS scaled_{c}" for c, (mean, scale) in self.stats.items()
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def training_frame(
    combined: DataFrame, texts: DataFrame | None = None, fit_on: str = "all", max_terms: int = tfidf.MAX_FEATURES,
    steps: int = tfidf.MAX_STEPS, seed: int = SEED,
) -> tuple[DataFrame, FeatureState]:
    """(frame with features and target, fitted state); rows without a target left out.

    ``combined`` may come with or without review text; ``texts`` (game_id, review)
    may be single reviews, which is the way for listings with very many of them.

    ``fit_on='all'`` fits the state on every row before the split; ``'train'``
    keeps the hold-out rows out of it.
    """
    if fit_on not in ("all", "train"):
        raise ValueError(fit_on)
    texts = review_texts(combined) if texts is None else texts
    frame = clean_frame(listing_rows(combined)).where(F.col("discount_pct").isNotNull())
    frame = materialize(frame, "frame")  # read by every fit below
    basis = frame if fit_on == "all" else encoding.split(frame, seed=seed)[0]
    state = fit_state(basis, texts, max_terms, steps)
    return add_features(frame, texts, state), state


def raw_numbers(rows: DataFrame) -> DataFrame:
    """Raw rows with prices and numbers as numbers (0 where there is none) and lists of items."""
    frame = rows.withColumns(
        {
            "current_price": parse_price("current_price"),
            "genres": F.coalesce(split_trim("genres", ","), F.array().cast("array<string>")),
            "tags": F.coalesce(split_trim("tags", ";"), F.array().cast("array<string>")),
        }
    )
    numbers = [c for c in encoding.NUMERIC_FEATURES if c in frame.columns]
    return cleaning.sanitize(frame.drop("discounted_price"), *numbers)


def scoring_frame(rows: DataFrame, texts: DataFrame, state: FeatureState) -> DataFrame:
    """Features of new raw rows (as ``combine_rows`` gives them), one row per row.

    No target is needed and no row is dropped: prices that do not parse and missing
    numbers become 0, missing lists are empty, and items that no vocabulary holds are
    ignored. State comes from the training rows, as it was saved.
    """
    frame = raw_numbers(rows)
    for column, vocab in (("genres", state.genres), ("tags", state.tags)):
        frame = pricing.restrict_to_vocabulary(frame, column, vocab)
    return add_features(materialize(frame, "new-rows"), texts, state)


def item_columns(state: FeatureState) -> list[tuple[str, str, str]]:
    """(name, list column, item) of the 0/1 column for each known genre, then each known tag that is
    no genre. Names are the items; one that differs from an earlier name or a monitored column
    by case only, which a frame cannot tell apart, has its list column added."""
    taken, seen, out = {c.lower() for c in ["game_id", *MONITORED_FEATURES, "genres", "tags"]}, set(), []
    for column, vocab in (("genres", state.genres), ("tags", state.tags)):
        for item in encoding.vocabulary_items(vocab):
            if item in seen:
                continue
            name = item
            while name.lower() in taken:
                name += f" ({column})"
            taken.add(name.lower())
            seen.add(item)
            out.append((name, column, item))
    return out


def item_flag(column: str, item: str) -> Column:
    return F.coalesce(F.array_contains(column, item).cast("int"), F.lit(0))


def monitoring_frame(
    combined: DataFrame, texts: DataFrame, state: FeatureState, wide: bool = False, lists: bool = False
) -> DataFrame:
    """Compared columns of a batch, infinities and nulls as 0. With ``wide`` one 0/1
    column per known genre and tag is added (``item_columns``), with ``lists`` the lists of known ones.

    ``discounted_price`` is compared although no model is trained on it.
    """
    frame = materialize(clean_frame(listing_rows(combined), drop_empty=True), "batch")
    full = add_features(frame, texts, state)
    full = pricing.restrict_to_vocabulary(full, "genres", state.genres)
    full = pricing.restrict_to_vocabulary(full, "tags", state.tags)
    flags = [item_flag(column, item).alias(name) for name, column, item in item_columns(state)] if wide else []
    kept = full.select("game_id", *MONITORED_FEATURES, *flags, *(["genres", "tags"] if lists else []))
    return cleaning.sanitize(kept, *MONITORED_FEATURES)
