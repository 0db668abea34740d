"""N-gram Jaccard self-join with rare-first prefix filtering, and its connected components.

A text's words are its stretches without ASCII white space, with A-Z in lower case; its set holds the distinct
n-word shingles, as 64-bit hashes (a shorter text is one shingle; a text without words has an empty set and
links with nothing). Texts with equal sets form one *class*, named by a 64-bit hash of the set, so exact copies
never meet in pairs. A second hash of each set tells names that two sets share, which very large corpora have a few
of: such sets are named by the second hash instead.

1. Shingles are counted over all texts in a sketch of ``2**sketch_bits`` counters; its size is fixed and it is
   shared with the tasks. Any total order makes prefix filtering exact; the sketch's makes it rare-first.
2. Each class emits the shingles of its prefix. Two sets that reach the threshold share one of them.
   Prefix shingles with one class only are dropped by an aggregation.
3. Every class follows a leader: the smallest class that it meets under a prefix shingle. Under each shingle a
   class goes to the unit of its leader with every leader met there, so each candidate pair of classes meets in
   exactly one unit (their two leaders'), however many shingles it shares, and is verified once. A group of
   near copies has few leaders, so units grow with the group, not with its square.
4. Large units are dealt out as pairs of blocks. A task first sees two blocks of sizes and *outlines* (counts
   over ranges of hashes, the more ranges the larger the set), and keeps the classes that have a partner by length
   and by the suffix filter's bound: an overlap is at most the sum of the smaller counts. Chance meetings end here,
   unread.
5. For the classes that remain, a task holds two blocks of sets, drops pairs by length, outline and position in
   the prefix, counts the overlaps of the rest exactly, and returns each class with its number of links and the
   root of its tree in that task, never the pairs. Every pair is counted, as the number of links is asked for.
6. Components of those trees are the components of all links.

Defined results: null and empty texts have n_shingles 0 and are their own component; repeated rows (equal ids
too) are rows of one class; an empty table gives no rows; extra columns are ignored (kept by ``keep_one``). Rows are told
apart by their sets, not by their ids: rows that share an id, or have none, are linked each by its own text.
Rows with a null id are never taken out by ``keep_one``. Ids are taken as whole numbers; others raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import bounded_batches, drop, materialize, runs, small, spread
from .components import components

SKETCH_BITS = 22
CHUNK_BITS = 16
#: Chunks that are summed in one place at most, about.
SUMMED = 64
#: Classes of one block; two blocks meet in a task. Larger units have more of them, up to BLOCK_MOST.
BLOCK, BLOCK_MOST = 64, 2048
#: Ranges of the outline of a small set, and members of a set for each range of a large one.
SUFFIX_RANGES, SUFFIX_MEMBERS = 64, 8

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(text: str, n: int) -> np.ndarray:
    """Distinct shingle hashes of a text, sorted."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    out = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        out = _mixed(out * _MIX[0] + hashes[k : len(words) - width + 1 + k] + np.uint64(k + 1))
    return np.unique(out)


def set_hash(s: np.ndarray, bits: int = 64) -> int:
    """A signed 64-bit name of a set; fewer ``bits`` make names that sets share, for tests."""
    return (xxhash.xxh3_64_intdigest(s.tobytes()) & ((1 << bits) - 1)) - (1 << 63)


def second_hash(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes(), seed=1) - (1 << 63)


def name_of(s: np.ndarray, shared_names: frozenset[int] = frozenset(), bits: int = 64) -> int:
    name = set_hash(s, bits)
    return second_hash(s) if name in shared_names else name


def outline(s: np.ndarray) -> np.ndarray:
    """How many hashes of a set fall in each of the ranges of the suffix filter; a power of two of them."""
    ranges = SUFFIX_RANGES
    while 2 * ranges * SUFFIX_MEMBERS <= len(s):
        ranges *= 2
    counts = np.bincount((s & np.uint64(ranges - 1)).astype(np.int64), minlength=ranges)
    return counts.astype(np.min_scalar_type(int(counts.max())))


def outline_bytes(s: np.ndarray) -> bytes:
    """An outline and, in front, the bytes of a count: one, but for texts that hardly exist."""
    counts = outline(s)
    return bytes([counts.itemsize]) + counts.tobytes()


def outline_read(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1)


def prefix_length(n: int, percent: int) -> int:
    """Sets of size n that reach the threshold share one of their first so many shingles in a common order."""
    return n - -(-percent * n // 100) + 1 if n else 0


def _bucket(s: np.ndarray, bits: int) -> np.ndarray:
    return (s >> np.uint64(64 - bits)).astype(np.int64)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _sketch_and_classes(docs: DataFrame, n: int, bits: int, name_bits: int) -> DataFrame:
    """Rows of ids (id, n, class, second, outline as ``counts``) and of sketch chunks (chunk, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            ids, sizes, names, seconds, outlines = batch.column(0), [], [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py(), n)
                np.add.at(counts, _bucket(s, bits), 1)
                sizes.append(len(s))
                names.append(set_hash(s, name_bits))
                seconds.append(second_hash(s))
                outlines.append(outline_bytes(s))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(x, pa.int64()) for x in (sizes, names, seconds)), pa.nulls(len(sizes), pa.int32()), pa.array(outlines, pa.binary())],
                names=["id", "n", "class", "second", "chunk", "counts"],
            )
        size = 1 << CHUNK_BITS
        for c in range(0, 1 << bits, size):
            part = counts[c : c + size]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64())] * 4 + [pa.array([c // size], pa.int32()), pa.array([_packed(part)], pa.binary())],
                    names=["id", "n", "class", "second", "chunk", "counts"],
                )

    return docs.mapInArrow(run, "id long, n long, class long, second long, chunk int, counts binary")


def _packed(counts: np.ndarray) -> bytes:
    """Counters, most of which are small, in about a bit each."""
    return zstandard.compress(counts.astype(np.uint32).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), np.uint32)


def _summed(rows: DataFrame, bits: int) -> np.ndarray:
    """The sketch: chunks are summed in steps of ``SUMMED``, so that no task reads many of them."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for chunk, way, data in zip(*(batch.column(k).to_pylist() for k in ("chunk", "way", "counts")), strict=True):
                part, held = _unpacked(data), sums.get((chunk, way))
                sums[chunk, way] = part if held is None else np.minimum(held.astype(np.uint64) + part, 0xFFFFFFFF).astype(np.uint32)
        for (chunk, way), part in sums.items():
            columns = [pa.array([chunk], pa.int32()), pa.array([way], pa.int32()), pa.array([_packed(part)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["chunk", "way", "counts"])

    chunks = max(1, 1 << (bits - CHUNK_BITS))
    found = rows.filter("chunk is not null").select("chunk", "counts")
    ways = -(-found.count() // (chunks * SUMMED))
    dealt = found.select("chunk", F.pmod(F.xxhash64("counts"), F.lit(max(1, ways))).cast("int").alias("way"), "counts")
    while ways > 0:
        parts = max(1, min(2048, chunks * ways // 4))  # a task sums several chunks, each of 4 * 2**CHUNK_BITS bytes
        dealt = materialize(dealt.repartition(parts, "chunk", "way").mapInArrow(add, "chunk int, way int, counts binary"))
        if ways == 1:
            break
        ways = -(-ways // SUMMED)
        dealt = dealt.withColumn("way", F.expr(f"cast(way div {SUMMED} as int)"))
    out = np.zeros(1 << bits, np.uint32)
    for row in dealt.select("chunk", "counts").collect() if ways else []:  # 2**bits counters in all, whatever the corpus; one job
        part = _unpacked(row["counts"])
        out[(row["chunk"] << CHUNK_BITS) : (row["chunk"] << CHUNK_BITS) + len(part)] += part
    return out


def _ordered(s: np.ndarray, sketch: np.ndarray, bits: int) -> np.ndarray:
    """The set, rare shingles first; ties by hash."""
    return s[np.argsort(sketch[_bucket(s, bits)], kind="stable")]


def _prefixes(docs: DataFrame, n: int, percent: int, shared, bits: int, name) -> DataFrame:
    """(shingle, class) for each prefix shingle; classes repeat within a task once at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        seen: set[int] = set()
        for batch in batches:
            keys, names = [], []
            for text in batch.column(0):
                s = shingles(text.as_py(), n)
                own = name(s)
                if not len(s) or own in seen:
                    continue
                if len(seen) < 1_000_000:  # beyond, a repeated class is emitted again, to the same result
                    seen.add(own)
                part = _ordered(s, sketch, bits)[: prefix_length(len(s), percent)]
                keys.append(part.view(np.int64))
                names.append(np.full(len(part), own, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(names))], names=["shingle", "class"])

    return docs.select("text").mapInArrow(run, "shingle long, class long")


def _sets(docs: DataFrame, n: int, shared, bits: int) -> DataFrame:
    """(class, copies, set): the sets of the given texts, rare first, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        for batch in batches:
            data = [_ordered(shingles(t.as_py(), n), sketch, bits).tobytes() for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(data, pa.binary())], names=["class", "copies", "set"])

    return docs.select("class", "copies", "text").mapInArrow(run, "class long, copies long, set binary")


def _named_sets(docs: DataFrame, n: int, shared, bits: int, name) -> DataFrame:
    """(class, set) of the given texts, each under its own name; classes repeat within a task once at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = shared.value
        seen: set[int] = set()
        for batch in batches:
            names, data = [], []
            for text in batch.column(0):
                s = shingles(text.as_py(), n)
                own = name(s)
                if not len(s) or own in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(own)
                names.append(own)
                data.append(_ordered(s, sketch, bits).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(data, pa.binary())], names=["class", "set"])

    return docs.select("text").mapInArrow(run, "class long, set binary")


def possible(sizes: np.ndarray, outlines: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that the length and the suffix filter leave, and the overlap that each pair needs for a link."""
    a, b = sizes[left][:, None], sizes[right][None, :]
    needed = -(-percent * (a + b) // (100 + percent))  # 100 * o >= percent * (a + b - o)
    alive = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
    # outlines of two sets are compared over the ranges of the coarser one; a finer one is summed up to it
    ranges = np.array([len(x) for x in outlines], np.int64)
    folded = {
        r: np.array([x.reshape(-1, r).sum(0, dtype=np.int32) if len(x) >= r else np.zeros(r, np.int32) for x in outlines])
        for r in np.unique(ranges).tolist()
    }
    for row in np.flatnonzero(alive.any(1)):
        cols = np.flatnonzero(alive[row])
        level = np.minimum(ranges[right[cols]], ranges[left[row]])
        for r in np.unique(level).tolist():
            own = cols[level == r]
            alive[row, own] = np.minimum(folded[r][left[row]], folded[r][right[own]]).sum(1) >= needed[row, own]
    return alive, needed


def verify(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Boolean matrix of links between sets ``left`` and ``right`` (indices), each given rare-first."""
    sizes = np.array([len(s) for s in sets], np.int64)
    alive, needed = possible(sizes, [outline(s) for s in sets], left, right, percent)
    if not alive.any():
        return alive
    every, codes = np.unique(np.concatenate([s for s in sets if len(s)] or [np.empty(0, np.uint64)]), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    coded = [codes[starts[i] : starts[i + 1]] for i in range(len(sets))]
    # positional filter: the first common prefix shingle leaves at most the shorter rest
    place = np.full(len(every), -1, np.int64)
    for row, i in enumerate(left):
        p = coded[i][: prefix_length(sizes[i], percent)]
        place[p] = np.arange(len(p))
        for col in np.flatnonzero(alive[row]):
            j = right[col]
            q = coded[j][: prefix_length(sizes[j], percent)]
            at = place[q]
            hit = np.flatnonzero(at >= 0)
            if not len(hit):
                alive[row, col] = False
                continue
            # common shingles in both prefixes, then what the rests still allow
            u, v = at[hit[0]], hit[0]
            if 1 + min(sizes[i] - u - 1, sizes[j] - v - 1) < needed[row, col]:
                alive[row, col] = False
        place[p] = -1
    mark = np.zeros(len(every), bool)
    for row in np.flatnonzero(alive.any(1)):
        mark[coded[left[row]]] = True
        for col in np.flatnonzero(alive[row]):
            alive[row, col] = np.count_nonzero(mark[coded[right[col]]]) >= needed[row, col]
        mark[coded[left[row]]] = False
    return alive


def _hopeful(dealt: DataFrame, percent: int) -> DataFrame:
    """(task, side, class) of those that may have a link in their task, from (task, side, class, n, outline)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "task"):
            side, sizes = (np.array(rows.column(c).to_pylist(), np.int64) for c in ("side", "n"))
            outlines = [outline_read(x) for x in rows.column("outline").to_pylist()]
            both = (side == 2).any()
            left, right = (np.arange(len(side)),) * 2 if both else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            if not len(left) or not len(right):
                continue
            alive, _ = possible(sizes, outlines, left, right, percent)
            if both:
                np.fill_diagonal(alive, False)
            kept = np.unique(np.concatenate([left[alive.any(1)], right[alive.any(0)]]))
            if len(kept):
                yield from rows.select(["task", "side", "class"]).take(pa.array(kept)).combine_chunks().to_batches()

    return dealt.mapInArrow(run, "task long, side int, class long")


def _verified(dealt: DataFrame, percent: int) -> DataFrame:
    """(class, root, links) from rows (task, side, class, copies, set), one task's rows together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "task"):
            side = np.array(rows.column("side").to_pylist(), np.int64)
            names = np.array(rows.column("class").to_pylist(), np.int64)
            copies = np.array(rows.column("copies").to_pylist(), np.int64)
            sets = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
            if (side == 2).any():  # one block with itself
                left = right = np.arange(len(sets))
                links = np.triu(verify(sets, left, right, percent), 1)
            else:
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                if not len(left) or not len(right):
                    continue
                links = verify(sets, left, right, percent)
            parent = list(range(len(sets)))
            number = np.zeros(len(sets), np.int64)

            def root(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for i, j in zip(*np.nonzero(links), strict=True):
                x, y = int(left[i]), int(right[j])
                number[x] += copies[y]
                number[y] += copies[x]
                parent[root(x)] = root(y)
            kept = np.flatnonzero(number)
            if len(kept):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[kept]), pa.array(names[[root(int(k)) for k in kept]]), pa.array(number[kept])], names=["class", "root", "links"]
                )

    return dealt.mapInArrow(run, "class long, root long, links long")


def jaccard_components(
    docs: DataFrame, n: int = 5, percent: int = 80, sketch_bits: int = SKETCH_BITS, id_col: str = "doc_id", text_col: str = "text", name_bits: int = 64
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reached by links), class_id, n_links: one row a row of ``docs``.

    ``class_id`` is the smallest id with an equal set; ``n_links`` counts the other rows that link with the row.
    """
    return _rows(*_linked(docs, n, percent, sketch_bits, id_col, text_col, name_bits)[:2], id_col)


def _linked(
    docs: DataFrame, n: int, percent: int, sketch_bits: int = SKETCH_BITS, id_col: str = "doc_id", text_col: str = "text", name_bits: int = 64
) -> tuple[DataFrame, DataFrame, Callable[[np.ndarray], int]]:
    """The rows (id, n, class, outline), for classes with shingles (class, class_id, copies, component, links), and the
    function that names a set."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = spread(_texts(docs, id_col, text_col))
    first = materialize(_sketch_and_classes(texts, n, sketch_bits, name_bits))
    shared = spark.sparkContext.broadcast(_summed(first, sketch_bits))  # 4 * 2**sketch_bits bytes
    members = first.filter("chunk is null").select("id", "n", "class", "second", F.col("counts").alias("outline"))
    twice = members.groupBy("class").agg(F.min("second").alias("a"), F.max("second").alias("b")).filter("a <> b")
    names_of_two = frozenset(r[0] for r in twice.select("class").collect())  # sets squared / 2**65 of them: 3 in 10**10 sets
    if names_of_two:
        members = members.withColumn("class", F.when(F.col("class").isin(list(names_of_two)), F.col("second")).otherwise(F.col("class")))
    members = members.drop("second")
    name = partial(name_of, shared_names=names_of_two, bits=name_bits)
    classes = members.filter("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))

    prefixes = materialize(_prefixes(texts, n, percent, shared, sketch_bits, name))
    met = prefixes.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high")).filter("low < high")
    posted = materialize(prefixes.join(met, "shingle").select("shingle", "class", "low").distinct())
    drop(prefixes)
    leaders = posted.groupBy("class").agg(F.min("low").alias("leader"))
    led = materialize(posted.join(leaders, "class").select("shingle", "class", "leader"))
    drop(posted)
    around = led.select("shingle", F.col("leader").alias("other")).distinct()
    units = materialize(
        led.join(around, "shingle").select(F.least("leader", "other").alias("p"), F.greatest("leader", "other").alias("q"), "class", "leader").distinct()
    )
    drop(led)
    # a unit of two leaders needs classes of both; a unit of one leader at least two
    sizes = units.groupBy("p", "q").agg(
        F.count(F.when(F.col("leader") == F.col("p"), 1)).alias("np"), F.count(F.when(F.col("leader") == F.col("q"), 1)).alias("nq")
    ).filter("(p = q and np > 1) or (p <> q and np > 0 and nq > 0)")
    largest = F.greatest("np", "nq")
    width = F.least(F.greatest(F.ceil(F.sqrt(largest)), F.lit(BLOCK)), F.lit(BLOCK_MOST))
    sizes = sizes.withColumns({"bp": F.ceil(F.col("np") / width).cast("int"), "bq": F.ceil(F.col("nq") / width).cast("int")})
    sided = units.join(sizes, ["p", "q"])
    own = F.when(F.col("leader") == F.col("p"), F.col("bp")).otherwise(F.col("bq"))
    sided = sided.withColumn("block", F.pmod(F.xxhash64("class"), own.cast("long")).cast("int"))
    same = F.transform(  # unit of one leader: block pairs (i, j) with i <= j
        F.sequence(F.lit(0), F.col("bp") - 1),
        lambda o: F.struct(
            F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j"),
            F.when(o == F.col("block"), 2).when(F.col("block") < o, 0).otherwise(1).alias("side"),
        ),
    )
    left = F.transform(F.sequence(F.lit(0), F.col("bq") - 1), lambda o: F.struct(F.col("block").alias("i"), o.alias("j"), F.lit(0).alias("side")))
    right = F.transform(F.sequence(F.lit(0), F.col("bp") - 1), lambda o: F.struct(o.alias("i"), F.col("block").alias("j"), F.lit(1).alias("side")))
    spots = F.when(F.col("p") == F.col("q"), same).when(F.col("leader") == F.col("p"), left).otherwise(right)
    spots_of = sided.select("class", "p", "q", F.explode(spots).alias("s")).select("class", F.xxhash64("p", "q", "s.i", "s.j").alias("task"), "s.side")
    outlines = members.filter("n > 0").groupBy("class").agg(F.min("n").alias("n"), F.min("outline").alias("outline"))
    judged = spots_of.join(outlines, "class").select("task", "side", "class", "n", "outline").repartition("task").sortWithinPartitions("task")
    tasks = materialize(_hopeful(judged, percent))
    drop(units)

    wanted = small(materialize(classes.join(tasks.select("class").distinct(), "class")))
    if _plain(members):
        sets = materialize(_sets(texts.join(wanted, "id"), n, shared, sketch_bits))
    else:  # an id does not name a text
        named_sets = _named_sets(texts, n, shared, sketch_bits, name).join(wanted.select("class", "copies"), "class")
        sets = materialize(named_sets.groupBy("class", "copies").agg(F.first("set").alias("set")))
    dealt = tasks.join(sets, "class").select("task", "side", "class", "copies", "set").repartition("task").sortWithinPartitions("task")
    trees = materialize(_verified(dealt, percent))

    grouped = components(trees.select(F.col("class").alias("a"), F.col("root").alias("b")))
    named = grouped.select(F.col("node").alias("class"), "component")
    links = trees.groupBy("class").agg(F.sum("links").alias("links"))
    info = classes.join(named, "class", "left").join(links, "class", "left").select(
        "class", F.col("id").alias("class_id"), "copies", F.coalesce("component", "class").alias("component"), F.coalesce("links", F.lit(0)).alias("links")
    )
    return members, materialize(info), name


def _rows(members: DataFrame, info: DataFrame, id_col: str) -> DataFrame:
    lowest = info.groupBy("component").agg(F.min("class_id").alias("component_id"))
    info = info.join(lowest, "component").select("class", "class_id", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    filled = members.filter("n > 0").join(info, "class").select("id", "n", "component_id", "class_id", "n_links")
    bare = members.filter("n = 0").select("id", "n", F.col("id").alias("component_id"), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return filled.union(bare).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", "class_id", "n_links")


def _plain(members: DataFrame) -> bool:
    """Whether every row has an id of its own."""
    row = members.groupBy("id").agg(F.count(F.lit(1)).alias("c")).agg(F.max(F.when(F.col("id").isNull(), 2).otherwise(F.col("c")))).first()
    return (row[0] or 0) <= 1


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The row with the smallest id of every component, with all columns. Rows are told apart by id and set, so
    that of rows with equal ids one stays for every component of which it is the smallest; rows without an id all stay."""
    members, info, name_set = _linked(docs, n, percent)
    if _plain(members):
        found = materialize(_rows(members, info, "doc_id").select("doc_id", "component_id"))
        gone = materialize(found.filter("doc_id <> component_id").select("doc_id").distinct())
        return docs.join(small(gone), "doc_id", "left_anti")
    name = F.pandas_udf(lambda texts: texts.map(lambda t: name_set(shingles(t, n))), "long")
    named = docs.withColumn("_class", name(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    first = F.min(F.struct("class_id", "class")).alias("first")
    chosen = small(materialize(info.filter("class_id is not null").groupBy("component").agg(first).select(F.col("first.class").alias("_kept"), F.col("first.class_id").alias("_kept_id"))))
    smallest = named.join(chosen, (F.col("_class") == F.col("_kept")) & (F.col("doc_id").cast("long") == F.col("_kept_id")), "left_semi")
    bare = named.filter(F.col("doc_id").isNotNull() & (F.col("_class") == name_set(shingles("", n))))
    return smallest.union(bare).dropDuplicates(["doc_id", "_class"]).union(named.filter("doc_id is null")).select(*docs.columns)
