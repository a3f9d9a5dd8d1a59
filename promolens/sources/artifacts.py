"""A model folder: the trees, the preparation metadata they belong to, and the reports.

``save_run`` writes all of them to a fresh version folder and names it in a small record last, so
an interrupted save leaves the older version in use, or none. The metadata hold the model's uid.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import SparkSession

from promolens.operators.prepare import PrepMetadata
from promolens.operators.trees import BoostedTrees, load_text, save_text
from promolens.sources.sinks import read_json_record, write_json_record

MODEL_UID = "model_uid"
MODEL_TEXT = "model_text"  # in the metadata of a model that is stored as text


def _current_path(folder: str) -> str:
    return f"{folder}/current"


def _version(spark: SparkSession, folder: str) -> str:
    """The version folder in use; the folder itself if it holds no versions."""
    try:
        return f"{folder}/{read_json_record(spark, _current_path(folder))['version']}"
    except AnalysisException:
        return folder


def trees_path(spark: SparkSession, folder: str) -> str:
    return f"{_version(spark, folder)}/trees"


def _metadata_path(version: str) -> str:
    return f"{version}/prep_metadata"


def _metrics_path(version: str) -> str:
    return f"{version}/metrics"


def save_metadata(spark: SparkSession, meta: PrepMetadata, folder: str) -> None:
    """Metadata alone, without a model."""
    write_json_record(spark, meta.to_record(), _metadata_path(folder))


def _metadata_record(spark: SparkSession, folder: str) -> dict:
    try:
        return read_json_record(spark, _metadata_path(_version(spark, folder)))
    except AnalysisException as problem:
        raise FileNotFoundError(f"no preparation metadata in {folder}") from problem


def load_metadata(spark: SparkSession, folder: str) -> PrepMetadata:
    record = _metadata_record(spark, folder)
    record.pop(MODEL_UID, None)
    record.pop(MODEL_TEXT, None)
    return PrepMetadata.from_record(record)


def save_run(
    spark: SparkSession,
    model: GBTClassificationModel | BoostedTrees,
    meta: PrepMetadata,
    metrics: dict,
    folder: str,
) -> None:
    """Trees, metadata and metrics as one new version, put in use at the end."""
    version = f"version-{uuid.uuid4().hex}"
    path = f"{folder}/{version}"
    record = meta.to_record()
    if isinstance(model, BoostedTrees):
        save_text(spark, model, f"{path}/trees")
        record |= {MODEL_UID: _text_uid(model), MODEL_TEXT: True}
    else:
        model.save(f"{path}/trees")
        record |= {MODEL_UID: model.uid}
    write_json_record(spark, record, _metadata_path(path))
    write_json_record(spark, metrics, _metrics_path(path))
    write_json_record(spark, {"version": version}, _current_path(folder))


def _text_uid(model: BoostedTrees) -> str:
    return hashlib.sha256(model.to_text().encode()).hexdigest()


def _has_text(spark: SparkSession, folder: str) -> bool:
    try:
        return bool(_metadata_record(spark, folder).get(MODEL_TEXT))
    except FileNotFoundError:
        return False


def load_model(spark: SparkSession, folder: str) -> GBTClassificationModel | BoostedTrees:
    """The trees in use; fails if the metadata beside them belong to another model."""
    try:
        if _has_text(spark, folder):
            model = load_text(spark, trees_path(spark, folder))
        else:
            model = GBTClassificationModel.load(trees_path(spark, folder))
    except Exception as problem:
        if "does not exist" in str(problem) or "Input path" in str(problem):
            raise FileNotFoundError(f"no model in {folder}") from problem
        raise
    uid = _text_uid(model) if isinstance(model, BoostedTrees) else model.uid
    wanted = _metadata_record(spark, folder).get(MODEL_UID, uid)
    if wanted != uid:
        raise ValueError(f"the metadata in {folder} belong to model {wanted}, not {uid}")
    return model


def load_metrics(spark: SparkSession, folder: str) -> dict:
    return read_json_record(spark, _metrics_path(_version(spark, folder)))
