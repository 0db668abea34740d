"""Quality classifier by compression: two zstandard dictionaries, from good and from bad labelled text.

A text is cut into blocks of 1 KiB (whole, nothing is left out) and each is compressed with either dictionary.
The normalised difference of the summed sizes, with the compression ratio (text that repeats itself shrinks
under both) and their products, is calibrated to a probability by a logistic fit on labelled rows that the dictionaries don't have.

Training reads at most ``per_class`` labelled texts of each class, of at most ``longest`` bytes: a fixed bound.

Defined results: null and empty texts get the fit's value for an empty block; without labels of both classes
the score is 1 (nothing is known against a text); repeated rows get equal scores; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import bounded_batches, map_text
from .compression import Sizer, dictionary, labelled_sample, logistic, probability, remainder

BLOCK = 1024


def _blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]


class QualityModel:
    """Picklable: dictionaries and weights; compressors are made in each worker."""

    def __init__(self, good: bytes, bad: bytes, level: int):
        self.good, self.bad, self.level, self.fit, self._sizers = good, bad, level, None, None

    def __getstate__(self):
        return self.__dict__ | {"_sizers": None}

    def features(self, text: str) -> np.ndarray:
        if self._sizers is None:
            self._sizers = Sizer(self.good, self.level), Sizer(self.bad, self.level)
        data = text.encode()
        good, bad = (s.sizes(_blocks(data)).sum() for s in self._sizers)
        difference, ratio = (good - bad) / (good + bad + 1), (good + bad) / 2 / max(1, len(data))
        return np.array([difference, ratio, difference * ratio, ratio * ratio])

    def score(self, text: str) -> float:
        return 1.0 if self.fit is None else probability(self.fit, self.features(text))


def fit_quality(
    docs: DataFrame, labels: DataFrame, held_out: Column, per_class: int = 3000, longest: int = 16384, size: int = 65536, level: int = 3
) -> QualityModel:
    """Train on the rows of ``labels`` that ``held_out`` (on doc_id) does not exclude."""
    bad, good = labelled_sample(docs, labels, "quality", held_out, per_class, longest)
    if min(len(bad), len(good)) < 2:
        return QualityModel(b"\n", b"\n", level)
    cut = lambda texts: [block for t in texts[: max(1, len(texts) * 3 // 5)] for block in _blocks(t.encode())]
    model = QualityModel(dictionary(cut(good), size), dictionary(cut(bad), size), level)
    rest = [(t, y) for texts, y in ((good, 1), (bad, 0)) for t in texts[max(1, len(texts) * 3 // 5) :]]
    model.fit = logistic(np.array([model.features(t) for t, _ in rest]), np.array([y for _, y in rest]))
    return model


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and ``score`` of each row."""
    return map_text(docs, id_col, text_col, lambda text: (model.score(text),), "score double")


def quality_rows(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder_out: int = 0, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    out = remainder("doc_id", modulus) == remainder_out
    model = fit_quality(docs, labels, out)
    return score_quality(docs, model).select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, modulus: int = 5, remainder_out: int = 0) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns. Held-out labels are not read."""
    model = fit_quality(docs, labels, remainder("doc_id", modulus) == remainder_out)
    bounded_batches(docs.sparkSession)
    score = F.pandas_udf(lambda texts: texts.map(lambda t: model.score(t or "")).astype("float64"), "double")
    return docs.filter(score(F.col("text").cast("string")) >= threshold)
