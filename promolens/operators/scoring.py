"""Align new feature rows with the training schema and score them."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promolens.config import COUNTRY_COLUMN, ID_COLUMN
from promolens.functions.expr import fill_zero, ident, quoted
from promolens.operators.prepare import PrepMetadata, replay
from promolens.operators.quality import NUMERIC
from promolens.operators.training import assemble, probability
from promolens.operators.trees import BoostedTrees


def align(df: DataFrame, names, key: str = ID_COLUMN) -> DataFrame:
    """Exactly the training columns in training order; absent ones are 0, others go."""
    text = [c for c in names if c in df.columns and not isinstance(df.schema[c].dataType, NUMERIC)]
    if text:
        raise ValueError(f"non-numeric feature columns: {text}")
    found = set(df.columns)
    return df.selectExpr(
        ident(key), *(ident(c) if c in found else f"0 AS {ident(c)}" for c in names)
    )


def scoring_frame(df: DataFrame, meta: PrepMetadata) -> DataFrame:
    """Replay preparation and align; every row stays, duplicates and gaps included.

    A gap becomes 0, the value trees trained on complete rows give it, which is also what a
    column without any value gets. So nothing has to be counted first.
    """
    if ID_COLUMN not in df.columns:
        raise ValueError(f"required column is missing: {ID_COLUMN}")
    if COUNTRY_COLUMN not in df.columns:
        raise ValueError(f"required column is missing: {COUNTRY_COLUMN}")
    aligned = align(replay(df, meta), meta.feature_columns)
    return fill_zero(aligned, meta.feature_columns)


def require_country(df: DataFrame) -> None:
    """Fail if no row has a country; stops at the first row that does."""
    if df.select(COUNTRY_COLUMN).filter(F.col(COUNTRY_COLUMN).isNotNull()).isEmpty():
        raise ValueError("the country column holds no value")


def score(
    df: DataFrame, model: GBTClassificationModel | BoostedTrees, meta: PrepMetadata
) -> DataFrame:
    """Customer key and probability, one row per input row."""
    require_country(df)
    frame = scoring_frame(df, meta)
    if isinstance(model, BoostedTrees):
        return model.probabilities(frame).select(ID_COLUMN, "score")
    vectors = assemble(frame, meta.feature_columns, [quoted(ID_COLUMN)])
    return model.transform(vectors).select(ID_COLUMN, probability().alias("score"))


def preview(scores: DataFrame, rows: int = 5) -> DataFrame:
    """The first few scored rows."""
    return scores.limit(rows)
