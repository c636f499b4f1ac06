"""Feature preparation and classifier as one ML pipeline, saved and loaded as one.

The statistics of the scaler and the normalisation of the cubes are part of the
fitted pipeline, so ``PipelineModel.load`` gives the batch job and the stream the
same features: every stage is column expressions over literals.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertflow.functions import images as I
from alertflow.functions.metadata import sentinel_fill
from alertflow.operators import model as ML
from alertflow.operators.scaler import fit_scaler


class SentinelFiller(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Null and NaN of the input columns to the sentinel."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return sentinel_fill(dataset, self.getInputCols())


class _Scaled(HasInputCols):
    suffix = Param(Params._dummy(), "suffix", "appended to the names of the scaled columns", TypeConverters.toString)


class PopulationScaler(Estimator, _Scaled, DefaultParamsReadable, DefaultParamsWritable):
    """Mean and population deviation of each column; NaN is left out, no deviation counts as 1."""

    @keyword_only
    def __init__(self, *, inputCols=None, suffix="_scaled"):
        super().__init__()
        self._setDefault(suffix="_scaled")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "PopulationScalerModel":
        cols = self.getInputCols()
        row = fit_scaler(dataset, cols).first()
        missing = [c for c in cols if row[f"mean_{c}"] is None]
        if missing:
            raise ValueError(f"no value to fit in {missing}")
        return PopulationScalerModel(inputCols=cols, suffix=self.getOrDefault(self.suffix), means=[row[f"mean_{c}"] for c in cols],
                                     deviations=[row[f"std_{c}"] for c in cols])


class PopulationScalerModel(Model, _Scaled, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "mean of each column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "deviation of each column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, suffix="_scaled", means=None, deviations=None):
        super().__init__()
        self._setDefault(suffix="_scaled")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        end = self.getOrDefault(self.suffix)
        stats = zip(self.getInputCols(), self.getOrDefault(self.means), self.getOrDefault(self.deviations))
        return dataset.withColumns({f"{c}{end}": (F.col(c).cast("double") - F.lit(m)) / F.lit(s) for c, m, s in stats})


class CubeNormaliser(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Pixels cleaned, then min-max over the whole cube or per channel (channel last)."""

    mode = Param(Params._dummy(), "mode", "cube or channel", TypeConverters.toString)
    channels = Param(Params._dummy(), "channels", "channels of an image", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "values of an image", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, mode="cube", channels=3, size=None):
        super().__init__()
        self._setDefault(mode="cube", channels=3)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        clean = dataset.withColumn("_clean", I.pixel_clean(self.getInputCol()))
        mode = self.getOrDefault(self.mode)
        if mode == "cube":
            out = I.minmax_cube(clean, "_clean", self.getOutputCol())
        elif mode == "channel":
            size = self.getOrDefault(self.size) if self.isDefined(self.size) else None
            out = I.minmax_channel(clean, "_clean", self.getOutputCol(), self.getOrDefault(self.channels), layout="hwc", size=size)
        else:
            raise ValueError(f"mode {mode!r}")
        return out.drop("_clean")


class FeatureAssembler(Transformer, HasInputCol, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One vector: the image's values, then the metadata columns."""

    @keyword_only
    def __init__(self, *, inputCol=None, inputCols=None, outputCol="features"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return ML.assemble(dataset, self.getInputCol(), self.getInputCols(), self.getOutputCol())


def feature_pipeline(image_col: str, meta_cols: list[str], mode: str = "cube", channels: int = 3, size: int | None = None,
                     classifier: Estimator | None = None) -> Pipeline:
    """Sentinel, scaler, normaliser, assembler and, if given, a classifier over ``features``."""
    stages = [SentinelFiller(inputCols=meta_cols), PopulationScaler(inputCols=meta_cols),
              CubeNormaliser(inputCol=image_col, outputCol="_norm", mode=mode, channels=channels, size=size),
              FeatureAssembler(inputCol="_norm", inputCols=[f"{c}_scaled" for c in meta_cols], outputCol="features")]
    return Pipeline(stages=stages + ([classifier] if classifier is not None else []))


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
