"""Fitted preparation and boosted trees as pipeline stages that are written, loaded and applied to raw rows."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession

from fraudlens.functions.scalars import MISSING
from fraudlens.operators.boosting import BoostedTrees
from fraudlens.operators.clean import MedianImputer, fill_categorical, normalize_nan, null_placeholders
from fraudlens.operators.encode import LabelEncoder, Scaler
from fraudlens.plans.preprocess import Prepared
from fraudlens.schema import FeatureSpec


class _StateWriter(MLWriter):
    def __init__(self, stage: _Stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage._write(f"{path}/state", self.sparkSession)


class _StateReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _Stage:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind._read(f"{path}/state", self.sparkSession)
        stage._resetUid(metadata["uid"])
        return stage


class _Stage(Transformer, MLWritable, MLReadable):
    """A transformer whose state is kept in a folder of its own."""

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)


def _write_json(about: dict, path: str, spark: SparkSession) -> None:
    spark.createDataFrame([(json.dumps(about),)], "about string").coalesce(1).write.mode("overwrite").text(path)


def _read_json(path: str, spark: SparkSession) -> dict:
    return json.loads(spark.read.text(path).first()[0])


class Preparation(_Stage):
    """Cleaning, fills, label codes and scaling as they were fitted, for merged raw rows.

    Medians, means and deviations are one JSON line; the dictionaries of label codes, which may be large,
    are a Parquet table inside the stage.
    """

    def __init__(self, spec: FeatureSpec, imputer: MedianImputer, encoder: LabelEncoder, scaler: Scaler):
        super().__init__()
        self.spec, self.imputer, self.encoder, self.scaler = spec, imputer, encoder, scaler

    @classmethod
    def of(cls, done: Prepared) -> Preparation:
        return cls(done.spec, done.imputer, done.encoder, done.scaler)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = normalize_nan(null_placeholders(dataset))
        filled = self.imputer.transform(fill_categorical(rows, self.spec.categorical, MISSING))
        return self.scaler.transform(self.encoder.transform(filled))

    def _write(self, path: str, spark: SparkSession) -> None:
        e, s = self.encoder, self.scaler
        about = {
            "spec": asdict(self.spec),
            "imputer": {"cols": self.imputer.cols, "fit_on": self.imputer.fit_on, "medians": self.imputer.medians},
            "encoder": {"cols": e.cols, "missing": e.missing, "reserve_unseen": e.reserve_unseen, "sizes": e.sizes, "fallback": e.fallback, "inline": e._inline},
            "scaler": {"cols": s.cols, "fit_on": s.fit_on, "mean": s.mean, "std": s.std},
        }
        _write_json(about, f"{path}/about", spark)
        dictionary = e.dictionary if e.dictionary is not None else spark.createDataFrame([], "column string, value string, code long")
        dictionary.write.mode("overwrite").parquet(f"{path}/dictionary")

    @classmethod
    def _read(cls, path: str, spark: SparkSession) -> Preparation:
        about = _read_json(f"{path}/about", spark)
        spec = FeatureSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in about["spec"].items()})
        imputer = MedianImputer(about["imputer"]["cols"], about["imputer"]["fit_on"])
        imputer.medians = about["imputer"]["medians"]
        known = about["encoder"]
        encoder = LabelEncoder(known["cols"], known["reserve_unseen"], known["missing"])
        encoder.cols, encoder.sizes, encoder.fallback, encoder._inline = known["cols"], known["sizes"], known["fallback"], known["inline"]
        if encoder.cols:
            encoder.dictionary = spark.read.parquet(f"{path}/dictionary")
        scaler = Scaler(about["scaler"]["cols"], about["scaler"]["fit_on"])
        scaler.cols, scaler.mean, scaler.std = (about["scaler"][k] for k in ("cols", "mean", "std"))
        return cls(spec, imputer, encoder, scaler)


class BoostedScorer(_Stage):
    """Boosted trees that add the column ``score``."""

    def __init__(self, trees: BoostedTrees):
        super().__init__()
        self.trees = trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.trees.score(dataset)

    def _write(self, path: str, spark: SparkSession) -> None:
        self.trees.save(path, spark)

    @classmethod
    def _read(cls, path: str, spark: SparkSession) -> BoostedScorer:
        return cls(BoostedTrees.load(path, spark))


def scoring_pipeline(done: Prepared, trees: BoostedTrees) -> PipelineModel:
    """One model from merged raw rows to scores."""
    return PipelineModel([Preparation.of(done), BoostedScorer(trees)])
