"""Best-fit packing: vector best-fit over residual tokens, document count and attention cost.

A piece's three needs follow from its length: tokens n, one document, attention cost n * n. Pieces of one length
are alike, so the driver packs *lengths with their numbers*, at most ``limit`` of them, whatever the corpus's
size: longest first, each into the open bins whose residual it fits best (largest weighted dot product of need
and residual, or smallest residual norm, among bins that satisfy every constraint). Bins with equal residuals
are one entry with a number of bins; a length takes whole entries and splits one at most, so the plan stays
small. The plan says where the j-th piece of a length goes; ranks within a length make it rows.

Token ids are those of the ``tokenizers`` file; its vocabulary is run by the faster byte-pair encoder of
``tiktoken`` if the file's rules are those of that encoder, which is also checked against ``tokenizers`` in each
worker before use.

Defined results: a null text counts as empty and has only the closing id; an empty table gives no rows;
repeated rows are packed each; extra columns are ignored. A literal special token in a text gets its own id, as by
``tokenizers``, which encodes such texts itself, and also texts with very long runs of blanks and those on which
``tiktoken`` fails.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded_batches, materialize, ranked, spread

PROBES = ("", "Hello world, it's 12 o'clock.\n\n  x", "Épreuve ñandú größer 中文 🙂 a_b", "\t\r\n \u00a0--==!! don't WE'LL", "0123 4567.89")

#: ``tiktoken`` fails on runs of about a million blanks; texts with runs of this length are left to ``tokenizers``.
BLANKS = 100_000
_BLANK = re.compile(r"\s+")

_encoders: dict[str, object] = {}


def runs_by_rank(file: dict) -> bool:
    """Whether a ``tokenizers`` file is byte-level pair encoding whose merges come in the order of the ids that they make,
    with the standard split and nothing else: then the ids are the ranks by which ``tiktoken`` merges."""
    model, split = file["model"], file.get("pre_tokenizer") or {}
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    plain &= file.get("normalizer") is None and split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    made = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m), -1) for m in model["merges"]]
    return plain and all(a < b for a, b in zip([-1, *made[:-1]], made, strict=True))


def encoder(path: str):
    """Text to ids as by ``tokenizers`` on ``path``, with no special tokens added."""
    if path not in _encoders:
        import tiktoken
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        vocabulary, added = file["model"]["vocab"], [t["content"] for t in file["added_tokens"]]
        # byte-level files spell bytes as printable characters: the printable ones stand for themselves
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(letters[c] for c in token): n for token, n in vocabulary.items() if all(c in letters for c in token) and not token.startswith("<|")}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        slow = lambda t: own.encode(t, add_special_tokens=False).ids

        def quick(text: str) -> list[int]:
            if any(a in text for a in added) or (len(text) >= BLANKS and any(m.end() - m.start() >= BLANKS for m in _BLANK.finditer(text))):
                return slow(text)
            try:
                return fast.encode_ordinary(text)
            except BaseException as e:  # a panic of the encoder is no Exception
                if not isinstance(e, Exception) and type(e).__name__ != "PanicException":
                    raise
                return slow(text)

        _encoders[path] = quick if runs_by_rank(file) and all(quick(t) == slow(t) for t in PROBES) else slow
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, limit: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32: each document's ids and ``end_id``, cut from the end into pieces of ``limit``."""
    bounded_batches(docs.sparkSession)
    key_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            keys, columns = [], ([], [], [], [])
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), end_id], "<u4").tobytes()
                total = len(ids) // 4
                first = (total - 1) % limit + 1
                for n, end in enumerate(range(first, total + 1, limit)):
                    start = max(0, end - limit)
                    keys.append(key)
                    for column, value in zip(columns, (n, start, end - start, zlib.crc32(ids[4 * start : 4 * end])), strict=True):
                        column.append(value)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.column(0).type), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=[id_col, "piece", "start", "length", "ids_crc32"],
            )

    source = spread(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")))
    return source.mapInArrow(run, f"`{id_col}` {key_type}, piece int, start long, length long, ids_crc32 long")


class Packer:
    """Plan for numbers of equal lengths; see the module's text."""

    def __init__(self, tokens: int, documents: int, attention: int, rule: str = "dot", weights: tuple[float, float, float] = (1.0, 0.25, 0.25)):
        self.capacity = (tokens, documents, attention)
        self.rule, self.weights = rule, weights
        self.open: list[tuple[tuple[int, int, int], int, int]] = []  # residual, first sequence, number of sequences
        self.plan: list[tuple[int, int, int, int]] = []  # length, first rank, first sequence, offset
        self.sequences = 0

    def _score(self, need: tuple[int, int, int], residual: tuple[int, int, int]) -> float:
        """Higher is better."""
        parts = [(w, n / c, r / c) for w, n, r, c in zip(self.weights, need, residual, self.capacity, strict=True)]
        if self.rule == "dot":  # the weighted dot product with the used part: full bins first
            return sum(w * n * (1 - r) for w, n, r in parts)
        return -sum(w * (r - n) ** 2 for w, n, r in parts)

    def add(self, length: int, number: int) -> None:
        need = (length, 1, length * length)
        if any(n > c for n, c in zip(need, self.capacity, strict=True)):
            raise ValueError(f"a piece of {length} tokens fits no empty sequence")
        rank = 0
        while rank < number:
            fits = [e for e in self.open if all(n <= r for n, r in zip(need, e[0], strict=True))]
            if not fits:
                residual, first, many = self.capacity, self.sequences, number - rank
                per_bin = max(1, min(c // n for n, c in zip(need, self.capacity, strict=True)))
                many = -(-many // per_bin)
                self.sequences += many
            else:
                residual, first, many = max(fits, key=lambda e: (self._score(need, e[0]), -e[1]))
                self.open.remove((residual, first, many))
            # filled bin by bin, so that the last one alone stays short
            per_bin = min(r // n for n, r in zip(need, residual, strict=True))
            whole = min(many, (number - rank) // per_bin)
            rest = number - rank - whole * per_bin if whole < many else 0
            for n in range(per_bin if whole else 0):
                self.plan.append((length, rank, first, self.capacity[0] - residual[0] + n * length))
                rank += whole
            self._keep(residual, need, per_bin, first, whole)
            if rest:
                for n in range(rest):
                    self.plan.append((length, rank, first + whole, self.capacity[0] - residual[0] + n * length))
                    rank += 1
                self._keep(residual, need, rest, first + whole, 1)
                whole += 1
            self._keep(residual, need, 0, first + whole, many - whole)

    def _keep(self, residual, need, times: int, first: int, many: int) -> None:
        left = tuple(r - times * n for r, n in zip(residual, need, strict=True))
        if many and left[0] > 0 and left[1] > 0:
            self.open.append((left, first, many))


def pack_lengths(numbers: dict[int, int], packer: Packer) -> Packer:
    for length in sorted(numbers, reverse=True):
        packer.add(length, numbers[length])
    return packer


def pack(
    docs: DataFrame, tokenizer: str, limit: int = 2048, documents: int | None = None, attention: int | None = None, rule: str = "dot", id_col: str = "doc_id"
) -> DataFrame:
    """One row a piece: id, piece, start, length, ids_crc32, sequence_id, offset. Sequences hold ``limit`` tokens.

    Without ``documents`` and ``attention`` those capacities are ``limit`` and ``limit`` squared, which tokens
    imply. The plan is shared with the tasks; its size depends on ``limit`` alone.
    """
    cut = materialize(pieces(docs, tokenizer, limit, id_col=id_col))
    numbers = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``limit`` rows
    plan = pack_lengths(numbers, Packer(limit, documents or limit, attention or limit * limit, rule)).plan
    by_length: dict[int, tuple[list[int], list[int], list[int]]] = {}
    for length, rank, first, offset in plan:
        for column, value in zip(by_length.setdefault(length, ([], [], [])), (rank, first, offset), strict=True):
            column.append(value)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = [], []
            for length, rank in zip(batch.column("length").to_pylist(), batch.column("rank").to_pylist(), strict=True):
                ranks, firsts, offsets = by_length[length]
                i = bisect_right(ranks, rank) - 1
                sequence.append(firsts[i] + rank - ranks[i])
                offset.append(offsets[i])
            kept = [batch.column(n) for n in (id_col, "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = ranked(cut, ["length"], [id_col, "piece"], id_col)
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInArrow(place, schema)
