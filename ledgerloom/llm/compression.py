"""What the two compression classifiers share: dictionaries, block sizes, and a small logistic calibration."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int, longest: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[list[str], list[str]]:
    """Texts labelled 0 and 1 for training, at most ``per_class`` each, of at most ``longest`` bytes, none held out.

    The choice is by a hash of the id, so it is the same for the same rows. Ids are chosen from the labels alone;
    the texts follow by a join with these few ids (at most ``3 * per_class`` rows, hence broadcast), so no text is
    shuffled. At most ``3 * per_class * longest`` bytes reach the driver, however large the tables are. An id that is
    labelled both 0 and 1 is left out.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out).groupBy(id_col).agg(F.min(label).cast("int").alias("_y"), F.max(label).alias("_max"))
    known = known.filter(F.col("_y") == F.col("_max")).drop("_max")
    numbers = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    ids = []
    for y, n in sorted(numbers.items()):
        wanted = per_class * 3 // 2  # some have no text, or a long one
        part = (1 << 20) if n <= wanted else min(1 << 20, (wanted * (1 << 20)) // n + 1)
        cut = F.pmod(F.xxhash64(id_col, F.lit(label)), F.lit(1 << 20))
        ids.append(known.filter((F.col("_y") == y) & (cut < part)).orderBy(cut, id_col).limit(wanted))
    if not ids:
        return [], []
    few = ids[0] if len(ids) == 1 else ids[0].union(ids[1])
    chosen = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(few), id_col)
    rows = chosen.filter(F.octet_length("_text").between(1, longest)).groupBy(id_col, "_y").agg(F.min("_text").alias("_text")).collect()
    out: tuple[list[str], list[str]] = ([], [])
    for r in sorted(rows, key=lambda r: zlib.crc32(str(r[id_col]).encode())):
        if len(out[r["_y"]]) < per_class:
            out[r["_y"]].append(r["_text"])
    return out


def dictionary(samples: Sequence[bytes], size: int) -> bytes:
    """A zstandard dictionary trained on ``samples``; their own bytes where they are too few to train on."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(samples)[:size] or b"\n"


class Sizer:
    """Compressed sizes of small blocks under one dictionary, trained or (``raw``) plain content."""

    def __init__(self, data: bytes, level: int, raw: bool = False):
        params = zstandard.ZstdCompressionParameters.from_level(level, write_checksum=False, write_content_size=False, write_dict_id=False)
        held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_AUTO)
        held.precompute_compress(compression_params=params)
        self._compress = zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress

    def sizes(self, blocks: Sequence[bytes]) -> np.ndarray:
        compress = self._compress
        return np.fromiter((len(compress(b)) for b in blocks), np.float64, len(blocks))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (intercept first), means and scales of a logistic fit with balanced classes, by Newton's method."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    w = np.zeros(z.shape[1])
    penalty = ridge * len(y) / 100 * np.eye(len(w))
    penalty[0, 0] = 1e-9
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (share * (y - p)) - penalty @ w
        curve = (z * (share * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + penalty
        step = np.linalg.solve(curve, slope)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, scale


def probability(model: tuple[np.ndarray, np.ndarray, np.ndarray], features: np.ndarray) -> float:
    w, mean, scale = model
    return float(1 / (1 + np.exp(-np.clip(w[0] + ((features - mean) / scale) @ w[1:], -30, 30))))
