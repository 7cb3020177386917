"""Pipeline stages that Spark's library lacks, savable with the pipeline.

Fitted numbers are parameters of the stage, so ``PipelineModel.save`` and
``load`` keep them; each ``transform`` is column expressions only.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievekit.functions.names import col, quoted
from sievekit.functions.vectors import argmax_first


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def _with(self, **values):
        self._set(**values)
        return self


class RobustScale(_Stage, HasInputCols):
    """(x - center) / scale per column, as new columns with ``suffix``
    (none: in place). Missing stays missing."""

    centers = _param("centers", "median per column", TypeConverters.toListFloat)
    scales = _param("scales", "interquartile range per column", TypeConverters.toListFloat)
    suffix = _param("suffix", "appended to the names", TypeConverters.toString)

    @classmethod
    def of(cls, stats: dict[str, tuple[float, float]], suffix: str = "") -> "RobustScale":
        nan = float("nan")
        return cls()._with(inputCols=list(stats), suffix=suffix,
                           centers=[nan if c is None else c for c, _ in stats.values()],
                           scales=[s for _, s in stats.values()])

    def _transform(self, df: DataFrame) -> DataFrame:
        from sievekit.operators.quantiles import clean_double
        columns = zip(self.getInputCols(), self.getOrDefault(self.centers), self.getOrDefault(self.scales))
        return df.withColumns({c + self.getOrDefault(self.suffix): F.nanvl(
            (clean_double(c) - F.lit(m)) / F.lit(s), F.lit(None).cast("double")) for c, m, s in columns})


class AssembleColumns(_Stage, HasInputCols, HasOutputCol):
    """feature vector in the order given; any column name, missing is NaN."""

    @classmethod
    def of(cls, columns: list[str], out: str = "features") -> "AssembleColumns":
        return cls()._with(inputCols=list(columns), outputCol=out)

    def _transform(self, df: DataFrame) -> DataFrame:
        values = [F.coalesce(col(c).cast("double"), F.lit(float("nan"))) for c in self.getInputCols()]
        return df.withColumn(self.getOutputCol(), array_to_vector(F.array(*values)))


class SelectColumns(_Stage, HasInputCols):
    """Keeps the chosen columns and ``others`` (label, id)."""

    others = _param("others", "columns kept besides", TypeConverters.toListString)

    @classmethod
    def of(cls, chosen: list[str], others: list[str] = ()) -> "SelectColumns":
        return cls()._with(inputCols=list(chosen), others=list(others))

    def _transform(self, df: DataFrame) -> DataFrame:
        kept = [*self.getOrDefault(self.others), *self.getInputCols()]
        return df.select(*[quoted(c) for c in df.columns if c in kept])


def as_array(df: DataFrame, name: str) -> Column:
    vector = df.schema[name].dataType.typeName().startswith("vector")
    return vector_to_array(col(name)) if vector else col(name).cast("array<double>")


class ClassProbabilities(_Stage, HasInputCols, HasOutputCol):
    """The second component (class 1) of K binary models' probabilities,
    normalised to a distribution; ``scratch`` columns are dropped. Rows on
    which every model gives 0 get equal shares."""

    scratch = _param("scratch", "columns to drop", TypeConverters.toListString)

    @classmethod
    def of(cls, columns: list[str], out: str, scratch: list[str]) -> "ClassProbabilities":
        return cls()._with(inputCols=columns, outputCol=out, scratch=scratch)

    def _transform(self, df: DataFrame) -> DataFrame:
        own = F.array(*[F.get(as_array(df, c), F.lit(1)) for c in self.getInputCols()])
        total = F.aggregate(own, F.lit(0.0), lambda a, x: a + x)
        share = F.lit(1.0 / len(self.getInputCols()))
        return (df.withColumn(self.getOutputCol(), F.transform(own, lambda x: F.coalesce(F.try_divide(x, total), share)))
                  .drop(*self.getOrDefault(self.scratch)))


class SoftVote(_Stage, HasInputCols, HasOutputCol):
    """M8: mean of the models' probability arrays, its first maximum
    (``prediction``) and that probability (``confidence``)."""

    prediction = _param("prediction", "name of the index column", TypeConverters.toString)

    @classmethod
    def of(cls, columns: list[str], out: str = "probs", prediction: str = "pred_index") -> "SoftVote":
        return cls()._with(inputCols=list(columns), outputCol=out, prediction=prediction)

    def _transform(self, df: DataFrame) -> DataFrame:
        arrays = [as_array(df, c) for c in self.getInputCols()]
        n = len(arrays)
        mean = F.transform(arrays[0], lambda x, i: (x + sum((F.get(a, i) for a in arrays[1:]), F.lit(0.0))) / n)
        df = df.withColumn(self.getOutputCol(), mean)
        index, top = argmax_first(F.col(self.getOutputCol()))
        return df.withColumn(self.getOrDefault(self.prediction), index).withColumn("confidence", top)
