"""Toxicity by compression distance: separate zstandard dictionaries for toxic and ordinary text.

Both dictionaries hold the most frequent ordinary words; the toxic one also holds the stretches of words that
labelled toxic texts have far more often than ordinary ones. zstandard's own trainer is not used: it weighs a
stretch by its frequency, ordinary wording is the most frequent in toxic texts as well, and two dictionaries
trained apart differ by chance as much as a toxic word saves (the README has figures). A window of six words is
compressed with either; ordinary windows cost the same under both, so the saved bytes point at toxic wording,
wherever it stands in a long text. Two thresholds of a window's saved bytes are chosen, and the largest savings
and the numbers of windows above them are calibrated to a probability, on labelled rows that the dictionaries
don't have.

Training reads at most ``toxic_rows`` and ``ordinary_rows`` labelled texts of at most ``longest`` bytes.

Defined results: null and empty texts are one empty window; without labels of both classes the score is 0;
repeated rows get equal scores; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from math import ceil, log

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import map_text
from .compression import Sizer, labelled_sample, logistic, probability, remainder

WINDOW_WORDS = 6
GRAM = 5
#: A stretch counts as toxic when its document rate exceeds the ordinary one by this factor's logarithm.
CONTRAST = 4.0
ORDINARY_BYTES = 16_000
#: Savings among which the thresholds are chosen; more says nothing new about a window of six words.
MOST_SAVED = 8
STRETCHES = 1500
#: A higher threshold is taken while it tells texts apart as well as the best one, less so much.
SLACK = 0.02
LEVEL = 6


def _grams(words: set[bytes]) -> set[bytes]:
    return {w[i : i + GRAM] for w in (b" " + x for x in words) for i in range(len(w) - GRAM + 1)}


def _stretches(word: bytes, grams: set[bytes]) -> set[bytes]:
    """The parts of ``word`` that toxic grams cover."""
    word = b" " + word
    covered = np.zeros(len(word) + 2, np.int8)
    for i in range(len(word) - GRAM + 1):
        if word[i : i + GRAM] in grams:
            covered[i + 1 : i + GRAM + 1] = 1
    edges = np.flatnonzero(np.diff(covered)).tolist()
    return {word[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)}


def windows(text: str) -> list[bytes]:
    words = text.encode().lower().split()
    return [b" " + b" ".join(words[i : i + WINDOW_WORDS]) for i in range(0, len(words), WINDOW_WORDS)] or [b""]


def train_dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary."""
    sets = {name: [set(t.encode().lower().split()) for t in texts] for name, texts in (("t", toxic), ("o", ordinary))}
    rate: dict[str, Counter] = {name: Counter() for name in sets}
    words: Counter = Counter()
    for name, group in sets.items():
        for own in group:
            rate[name].update(_grams(own))
            if name == "o":
                words.update(own)
    least = max(3, ceil(0.008 * len(toxic)))
    scale = len(toxic) / max(1, len(ordinary))
    contrast = min(CONTRAST, log(2 * max(least, 0.03 * len(toxic))))  # few texts can show no larger one
    grams = {g for g, n in rate["t"].items() if n >= least and log((n + 0.5) / (rate["o"][g] * scale + 0.5)) > contrast}
    found: Counter = Counter()
    for own in sets["t"]:
        found.update({s for w in own for s in _stretches(w, grams)})
    by_use = lambda counter, n: [w for w, _ in sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:n]][::-1]
    common = b" ".join(by_use(words, ORDINARY_BYTES // 8)) or b" "
    return common, b"".join(by_use(found, STRETCHES)) + b" " + common


def thresholds(toxic: list[np.ndarray], ordinary: list[np.ndarray]) -> tuple[int, int]:
    """Two savings of a window, one apart. The lower one is the largest of those that tell toxic from ordinary texts
    about as well as the best: by the difference of the shares of texts with such a window."""
    share = lambda texts, t: np.mean([x.max() >= t for x in texts])
    gain = {t: share(toxic, t) - share(ordinary, t) for t in range(1, MOST_SAVED)}
    low = max(t for t, g in gain.items() if g >= max(gain.values()) - SLACK)
    return low, low + 1


class ToxicityModel:
    """Picklable: dictionaries, thresholds and weights; compressors are made in each worker."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic, self.cuts, self.fit, self._sizers = ordinary, toxic, (1, 1), None, None

    def __getstate__(self):
        return self.__dict__ | {"_sizers": None}

    def saved(self, text: str) -> np.ndarray:
        """The bytes that the toxic dictionary saves in each window."""
        if self._sizers is None:
            self._sizers = Sizer(self.ordinary, LEVEL, raw=True), Sizer(self.toxic, LEVEL, raw=True)
        own = windows(text)
        return self._sizers[0].sizes(own) - self._sizers[1].sizes(own)

    def features(self, saved: np.ndarray) -> np.ndarray:
        top = np.sort(saved)[-3:]
        low, high = (saved >= c for c in self.cuts)
        return np.array([
            min(top[-1], MOST_SAVED), min(top.mean(), MOST_SAVED), min(low.sum(), 10) / 3, np.log1p(high.sum()), low.mean() * 10, log(len(saved))
        ])

    def score(self, text: str) -> float:
        return 0.0 if self.fit is None else probability(self.fit, self.features(self.saved(text)))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: Column, toxic_rows: int = 1500, ordinary_rows: int = 3000, longest: int = 16384
) -> ToxicityModel:
    """Train on the rows of ``labels`` that ``held_out`` (on doc_id) does not exclude."""
    ordinary, toxic = labelled_sample(docs, labels, "toxic", held_out, ordinary_rows, longest)
    toxic = toxic[:toxic_rows]
    if min(len(toxic), len(ordinary)) < 2:
        return ToxicityModel(b" ", b" ")
    parts = [(texts[: max(1, len(texts) * 2 // 3)], texts[max(1, len(texts) * 2 // 3) :]) for texts in (ordinary, toxic)]
    model = ToxicityModel(*train_dictionaries(parts[1][0], parts[0][0]))
    rest = [[model.saved(t) for t in texts] for _, texts in parts]
    model.cuts = thresholds(rest[1], rest[0])
    model.fit = logistic(np.array([model.features(x) for part in rest for x in part]), np.array([y for y, part in enumerate(rest) for _ in part]))
    return model


def toxicity_rows(docs: DataFrame, labels: DataFrame, modulus: int = 3, remainder_out: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    out = remainder("doc_id", modulus) == remainder_out
    model = fit_toxicity(docs, labels, out)
    scored = map_text(docs, "doc_id", "text", lambda text: (model.score(text),), "score double")
    return scored.select(
        "doc_id", F.coalesce(out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
