"""Scoring: from the wide table to points, as one fitted pipeline that is saved and loaded whole.

Every step is a pipeline stage with its settings as parameters, so what a model was trained on (names,
columns, their order, bins, offsets) travels with it, and a session that scores needs nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens import config as K
from basketlens.functions import columns as C
from basketlens.operators import prep as D
from basketlens.operators.kpi import HOUSEHOLD
from basketlens.sources.writers import write_file

REFUSE, ZERO = "refuse", "zero"


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A transformer whose parameters are set by keyword; those left out keep their defaults."""

    def __init__(self, **params):
        super().__init__()
        self._set(**params)

    def _get(self, name: str):
        return self.getOrDefault(self.getParam(name))


def _param(name: str, doc: str, kind=TypeConverters.identity) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class ModelNames(_Stage):
    """Columns of the wide table under the names the model knows; ``keep`` stay as they are."""

    tokens = _param("tokens", "parts of a name and what they become")
    keep = _param("keep", "columns that are no features", TypeConverters.toListString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        keep = [c for c in self._get("keep") if c in dataset.columns]
        return D.map_feature_names(dataset, tokens=self._get("tokens"), keep=keep)


class TrainedColumns(_Stage):
    """The trained columns, in that order and as doubles; gaps take the sentinel.

    An absent column stops the run (``refuse``) or counts as 0 (``zero``). Further columns go, but for ``keep``.
    """

    columns = _param("columns", "trained columns", TypeConverters.toListString)
    keep = _param("keep", "columns that are no features", TypeConverters.toListString)
    sentinel = _param("sentinel", "value of a gap", TypeConverters.toFloat)
    absent = _param("absent", "refuse or zero", TypeConverters.toString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        wanted = self._get("columns")
        lacking = [c for c in wanted if c not in dataset.columns]
        if lacking and self._get("absent") == REFUSE:
            raise ValueError(f"the model was trained on columns that the table lacks: {', '.join(lacking)}")
        keep = [c for c in self._get("keep") if c in dataset.columns]
        padded = D.pad_columns(dataset, wanted, [F.col(f"`{c}`") for c in keep])
        gap = F.lit(self._get("sentinel"))
        return padded.select(
            *[F.col(f"`{c}`") for c in keep],
            *[F.coalesce(F.col(f"`{c}`").cast("double"), gap).alias(c) for c in wanted],
        )


class WoeColumns(_Stage):
    """Adds ``<column>_woe``, the weight of evidence of the column's bin; null for a bin not trained on."""

    bins = _param("bins", "column to its edges and (bin, weight) pairs")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        added = {}
        for column, spec in self._get("bins").items():
            weights = F.create_map(*[F.lit(x) for b, woe in spec["woe"] for x in (int(b), float(woe))])
            added[f"{column}_woe"] = F.try_element_at(weights, D.bin_index(f"`{column}`", spec["edges"]))
        return dataset.withColumns(added)


class ScorePoints(_Stage):
    """Adds ``Probability``, moved back to the population, and ``Score``, from the column ``source``."""

    source = _param("source", "probability, or the vector a classifier gives", TypeConverters.toString)
    offset = _param("offset", "posterior offset; 1 leaves the probability as it is", TypeConverters.toFloat)
    base = _param("base", "points at even odds", TypeConverters.toFloat)
    double_odds = _param("double_odds", "points that double the odds", TypeConverters.toFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        raw = F.col(self._get("source"))
        if isinstance(dataset.schema[self._get("source")].dataType, VectorUDT):
            raw = vector_to_array(raw)[1]
        return dataset.withColumn("Probability", C.posterior(raw, self._get("offset"))).withColumn(
            "Score", C.points(F.col("Probability"), self._get("base"), self._get("double_odds"))
        )


def prepared(
    trained: Sequence[str], keep: Sequence[str], tokens: Mapping[str, str] = K.FEATURE_TOKENS,
    sentinel: float = K.CREDIT_SENTINEL, absent: str = REFUSE,
) -> list[Transformer]:
    """The stages before a model: names, columns and gaps."""
    return [
        ModelNames(tokens=dict(tokens), keep=list(keep)),
        TrainedColumns(columns=list(trained), keep=list(keep), sentinel=float(sentinel), absent=absent),
    ]


def points_stage(
    source: str = "probability", offset: float = K.POSTERIOR_OFFSET, base: float = K.SCORE_BASE,
    double_odds: float = K.SCORE_DOUBLE,
) -> Transformer:
    return ScorePoints(source=source, offset=float(offset), base=float(base), double_odds=float(double_odds))


def woe_spec(bins: DataFrame, edges: Sequence[float]) -> dict:
    """Bins of one column as a parameter: ``len(edges) + 2`` rows at most."""
    return {"edges": list(edges), "woe": [[r["bin"], r["woe"]] for r in bins.collect()]}


def fit_forest(
    train: DataFrame, trained: Sequence[str], label: str = "target", weight: str = "weight",
    trees: int = 20, depth: int = 5, seed: int = 0, **preparation,
) -> PipelineModel:
    """Balanced forest together with all that comes before and after it."""
    keep = (HOUSEHOLD, label, weight)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, weightCol=weight, numTrees=trees, maxDepth=depth, seed=seed)
    assembler = VectorAssembler(inputCols=list(trained), outputCol="features")
    stages = [*prepared(trained, keep, **preparation), assembler, forest, points_stage()]
    return Pipeline(stages=stages).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(
    model: PipelineModel, wide: DataFrame, segment: str | None = None,
    segment_column: str = "cash_card_customer_flag", keep: Sequence[str] = (HOUSEHOLD,),
) -> DataFrame:
    """``keep``, ``Probability`` and ``Score`` of the households of a segment, or of all."""
    rows = D.cast_decimals(D.subset_by_segment(wide, segment, segment_column))
    return model.transform(rows).select(*keep, "Probability", "Score")


def score_to(model_path: str, wide: DataFrame, out: str, fmt: str = "parquet", **options) -> None:
    """One scoring run: a saved model, the wide table, and where the points go."""
    write_file(score(load_model(model_path), wide, **options), out, fmt)
