"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Unit vectors are projected on many random lines. Around every vector lies a window on every line;
another vector that is similar enough falls into most windows, an unlike one into few. Pairs with a
count that similar ones miss almost never are confirmed by their cosine.

The vectors of a label are cut, along the first line, into tiles of a bounded number of vectors. Two
tiles are compared if the gap between them on that line is within a window; the sorted projections of
one tile and the windows of the other give the counts. What leaves a comparison is a number of links
and a component root per vector, never the pairs.
"""

from __future__ import annotations

import hashlib
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.components import components
from tallybook.llm.placing import bucket_count, running_sum
from tallybook.llm.stage import stage
from tallybook.llm.vectors import finite_vectors

LINES = 64
TILE = 1024
# Half a window, in standard deviations of what a pair at the threshold differs by on a line.
HALF_WINDOW = 1.0
HIT = 0.6826894921370859  # chance of such a pair to be in the window
# Such a pair may miss the count with this probability, and differ by more than the last gap.
MISS = 1e-7
GAP_DEVIATIONS = 5.4


def least_count() -> int:
    """The largest number of collisions that a pair at the threshold reaches but for ``MISS``."""
    below = 0.0
    for k in range(LINES + 1):
        below += comb(LINES, k) * HIT**k * (1 - HIT) ** (LINES - k)
        if below > MISS:
            return k
    return LINES


def lines(length: int) -> np.ndarray:
    return np.random.default_rng(9001).standard_normal((length, LINES))


def _prepared(batches):
    """(vec_id, label, vector) to (vec_id, label, print, first, unit); the last three null if unusable."""
    for batch in batches:
        count = len(batch)
        prints, first, units = [None] * count, [None] * count, [None] * count
        labels = batch.column(1).to_pylist()
        for length, (rows, matrix) in finite_vectors(batch.column(2)).items():
            # Scaling by the largest component keeps the norm within range.
            large = np.abs(matrix).max(axis=1, initial=0)
            use = large > 0
            rows, scaled = rows[use], matrix[use] / large[use][:, None]
            unit = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
            along = unit @ lines(length)[:, 0]
            for row, vector, source, value in zip(rows, unit, matrix[use], along):
                if labels[row] is not None:
                    prints[row] = hashlib.blake2b(repr((labels[row], length)).encode() + source.tobytes(), digest_size=16).digest()
                    first[row], units[row] = value, vector.astype("<f8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(prints, pa.binary()), pa.array(first, pa.float64()),
             pa.array(units, pa.binary())], names=["vec_id", "label", "print", "first", "unit"])


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable number in an undirected graph given as a symmetric matrix."""
    root = np.arange(len(linked))
    touched = np.flatnonzero(linked.any(axis=1))
    part = linked[np.ix_(touched, touched)]
    label = np.arange(len(touched))
    while len(touched):
        low = np.minimum(label, np.where(part, label[None, :], len(label)).min(axis=1))
        low = low[low]
        if (low == label).all():
            break
        label = low
    root[touched] = touched[label]
    return root


def _compared(batches, threshold: float):
    """Pairs of tiles to (print, links, root) of the vectors that have links between the two."""
    need, half = least_count(), HALF_WINDOW * (2 - 2 * threshold) ** 0.5
    for batch in batches:
        names = batch.schema.names
        for row in range(len(batch)):
            item = lambda name: batch.column(names.index(name))[row].as_py()  # noqa: E731, B023
            same = item("x") == item("y")
            tiles = []
            for side in "xy":
                prints = item(f"{side}_prints")
                units = np.frombuffer(b"".join(item(f"{side}_units")), "<f8").reshape(len(prints), -1)
                tiles.append((prints, units, np.array(item(f"{side}_sizes")), units @ lines(units.shape[1])))
            (a_prints, a, a_sizes, a_lines), (b_prints, b, b_sizes, b_lines) = tiles
            hits = np.zeros((len(a), len(b)), np.uint8)
            for k in range(LINES):
                order = np.argsort(b_lines[:, k])
                place = np.empty(len(b), np.int16)
                place[order] = np.arange(len(b))
                low = np.searchsorted(b_lines[order, k], a_lines[:, k] - half, "left").astype(np.int16)
                high = np.searchsorted(b_lines[order, k], a_lines[:, k] + half, "right").astype(np.int16)
                hits += (place[None, :] >= low[:, None]) & (place[None, :] < high[:, None])
            i, j = np.nonzero(hits >= need)
            if same:
                i, j = i[i < j], j[i < j]
            near = np.zeros(len(i), dtype=bool)
            for k in range(0, len(i), 1 << 16):
                near[k:k + (1 << 16)] = np.einsum("nd,nd->n", a[i[k:k + (1 << 16)]], b[j[k:k + (1 << 16)]]) >= threshold
            i, j = i[near], j[near]
            if not len(i):
                continue
            prints, shift = (a_prints, 0) if same else (a_prints + b_prints, len(a))
            links = np.bincount(i, b_sizes[j], len(prints)) + np.bincount(j + shift, a_sizes[i], len(prints))
            linked = np.zeros((len(prints), len(prints)), dtype=bool)
            linked[i, j + shift] = linked[j + shift, i] = True
            root = _roots(linked)
            found = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([prints[k] for k in found], pa.binary()), pa.array(links[found].astype(np.int64)),
                 pa.array([prints[root[k]] for k in found], pa.binary())], names=["print", "links", "root"])


def near_vectors(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = 0.93) -> DataFrame:
    """One row per row of ``df``: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of equal label (and length) are linked if their cosine, in double precision, is at least
    ``threshold``. A null label, and a vector that is null, empty, zero or has a null or non-finite
    component, is linked with nothing: 0 links, its own id as ``component_id``, kept. ``n_links`` counts
    the other rows linked directly, copies included; equal vectors are compared once. Rows with equal
    ids are rows of their own that share an id; a null id never is a component's smallest. An empty
    table gives an empty one.

    The work of a label grows with the square of its distinct vectors over all tiles, in bounded,
    evenly sized tasks: a label that holds most rows only has more of them.
    """
    kind, label_kind = df.schema[id_column].dataType.simpleString(), df.schema[label].dataType.simpleString()
    rows = stage(
        df.select(F.col(id_column).alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
        .mapInArrow(_prepared, f"vec_id {kind}, label {label_kind}, print binary, first double, unit binary"), "vectors")
    usable = rows.where("print IS NOT NULL")
    classes = stage(usable.groupBy("print").agg(
        F.min("vec_id").alias("vec_id"), F.count("*").alias("size"), F.first("label").alias("label"),
        F.first("first").alias("first"), F.first("unit").alias("unit")), "vector-classes")
    count = classes.count()

    # Ranks along the first line; its values lie around 0 with deviation 1.
    spread = 1 / (1 + F.exp(-1.7 * F.col("first")))
    placed = (
        classes.withColumn("group", F.concat_ws("|", F.col("label").cast("string"), F.length("unit")))
        .withColumn("bucket", F.floor(spread * bucket_count(count)))
        .withColumn("one", F.lit(1).cast("long"))
    )
    ranked = running_sum(placed, ["group"], "bucket", [F.col("first"), F.col("print")], "one", "rank")
    # At most TILE vectors in each list.
    tiles = stage(
        ranked.groupBy("group", F.floor(F.col("rank") / TILE).alias("tile")).agg(
            F.min("first").alias("low"), F.max("first").alias("high"),
            F.collect_list(F.struct("print", "size", "unit")).alias("members"))
        .select("group", "tile", "low", "high", F.col("members.print").alias("prints"),
                F.col("members.size").alias("sizes"), F.col("members.unit").alias("units")), "tiles")
    gap = GAP_DEVIATIONS * (2 - 2 * threshold) ** 0.5
    limits = tiles.select("group", "tile", "low", "high")
    x, y = limits.alias("a"), limits.alias("b")
    near = x.join(y, "group").where((F.col("a.tile") <= F.col("b.tile")) & (F.col("b.low") - F.col("a.high") <= gap))
    near = near.select("group", F.col("a.tile").alias("x"), F.col("b.tile").alias("y"))

    def side(name: str) -> DataFrame:
        return tiles.select("group", F.col("tile").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in ("prints", "sizes", "units")))

    both = near.join(side("x"), ["group", "x"]).join(side("y"), ["group", "y"])
    parallel = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    found = stage(both.repartition(parallel, "group", "x", "y").mapInArrow(
        lambda batches: _compared(batches, threshold), "print binary, links long, root binary"), "vector-links")
    counts = found.groupBy("print").agg(F.sum("links").alias("links"))
    labels = stage(components(found.select(F.col("print").alias("a"), F.col("root").alias("b"))), "vector-labels")

    named = (classes.select("print", "vec_id", "size").join(labels.withColumnRenamed("vertex", "print"), "print", "left")
             .withColumn("component", F.coalesce("label", "print")))
    lowest = named.groupBy("component").agg(F.min("vec_id").alias("low"))
    known = named.join(lowest, "component").join(counts, "print", "left").select(
        "print", "low", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n"))
    return (
        rows.select("vec_id", "print").join(known, "print", "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                F.coalesce("low", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
