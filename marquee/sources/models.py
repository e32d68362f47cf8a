"""Fitted pipelines to and from storage (``PipelineModel`` directories).

``TfidfVectorizer`` fits into a small inner pipeline; it is flattened into
its stages (``TermCounts``, ``ElementwiseProduct``, ``Normalizer``) before
saving, so the saved model is an ordinary pipeline of JVM stages plus the
package's parameter-only stages. Ensembles write the
models they hold (``ml.parts``), so the shipped stack is saved and served whole.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel


def flatten(model: PipelineModel) -> PipelineModel:
    from marquee.ml.features import TfidfModel
    stages = []
    for st in model.stages:
        if isinstance(st, TfidfModel):
            stages += flatten(st.inner).stages
        elif isinstance(st, PipelineModel):
            stages += flatten(st).stages
        else:
            stages.append(st)
    return PipelineModel(stages)


def save_model(model: PipelineModel, path: str) -> None:
    flatten(model).write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
