"""Near-duplicates by circulant MinHash and exact Jaccard similarity.

A shingle's 64-bit hash is a cell of a circle of ``CELLS``; one permutation scatters the cells, a
second one, read at a shift of k, gives the k-th value of the signature. All values of a shingle
are a run of the second permutation's table, so a signature is the elementwise minimum of such runs.
Bands of the signature give candidates; links are confirmed on the full sets.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.arrow_text import SMALL_SLICE_BYTES, mix, shingle_hashes, slices, text_buffer, word_hashes, word_spans
from tallybook.llm.components import components
from tallybook.llm.stage import stage
from tallybook.llm.workers import small_batches

SIGNATURE = 512
# Of these, so many at most form bands; all serve the estimate that spares a comparison of sets.
BANDED = 128
# Columns of 64 bits that hold two bits of each value.
PACKED = tuple(f"s{k}" for k in range(2 * SIGNATURE // 64))
CELL_BITS = 22
CELLS = 1 << CELL_BITS
# Members of a bucket are compared in cells of about so many; the exact rest follows the labels.
CELL_MEMBERS = 5
# A band scheme may miss a pair at the threshold with this probability.
MISS = 1e-4
# Pairs whose signatures agree in so many standard deviations less than the threshold's mean are
# not compared on the sets.
DEVIATIONS = 3.0
# Ids of texts to compare are broadcast up to this number, joined by a shuffle of the texts beyond.
BROADCAST_IDS = 500_000

_tables: dict[str, np.ndarray] = {}


def _second_permutation() -> np.ndarray:
    if "second" not in _tables:
        order = np.random.default_rng(77003).permutation(CELLS).astype(np.int32)
        _tables["second"] = np.concatenate([order, order[:SIGNATURE]])
    return _tables["second"]


def _first_permutation(hashes: np.ndarray) -> np.ndarray:
    """Cells of hashes: odd multiples and shifts permute the circle."""
    mask = np.uint64(CELLS - 1)
    x = hashes & mask
    for odd in (0x2C1B3C6D, 0x297A2D39, 0x1B56C4E9):
        x = (x * np.uint64(odd)) & mask
        x ^= x >> np.uint64(CELL_BITS // 2)
    return x.astype(np.int64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The circulant MinHash values of one non-empty set of shingle hashes."""
    runs = np.lib.stride_tricks.sliding_window_view(_second_permutation(), SIGNATURE)
    cells = _first_permutation(hashes)
    lowest = np.full(SIGNATURE, CELLS, dtype=np.int32)
    for k in range(0, len(cells), 1024):
        np.minimum(lowest, runs[cells[k:k + 1024]].min(axis=0), out=lowest)
    return lowest


def shingle_sets(column: pa.Array, size: int):
    """Sorted distinct shingle hashes of each row of a string column, row by row.

    A text of fewer words is one shingle; one without words has none.
    """
    data, limits = text_buffer(column)
    for first, last in slices(limits, SMALL_SLICE_BYTES):
        part = limits[first:last + 1]
        text = data[part[0]:part[-1]]
        starts, ends, words = word_spans(text, part - part[0])
        hashes = word_hashes(text, starts, ends)
        shingles = shingle_hashes(hashes, size)
        for row in range(last - first):
            begin, count = words[row], words[row + 1] - words[row]
            if count >= size:
                yield first + row, np.unique(shingles[begin:begin + count - size + 1])
            elif count:
                # Another constant than in longer texts: no text of whole shingles equals it.
                yield first + row, mix(shingle_hashes(hashes[begin:begin + count], int(count)) + np.uint64(count))
            else:
                yield first + row, np.zeros(0, np.uint64)


def bands_for(percent: int) -> tuple[int, int]:
    """Rows in a band and number of bands: the longest bands that miss a pair at most with ``MISS``."""
    for rows in range(16, 0, -1):
        bands = BANDED // rows
        if (1 - (percent / 100) ** rows) ** bands <= MISS:
            return rows, bands
    return 1, BANDED


def set_print(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _cut(batches):
    """Batches of a few megabytes of text, the second column, so that a signature's temporaries stay small."""
    for batch in batches:
        _, limits = text_buffer(batch.column(1))
        for first, last in slices(limits, SMALL_SLICE_BYTES):
            yield batch.slice(first, last - first)


def _signature_rows(batches, size: int, rows: int, bands: int):
    for batch in _cut(batches):
        count = len(batch)
        sizes, prints = np.zeros(count, np.int64), [None] * count
        values = np.zeros((count, SIGNATURE), np.int32)
        for row, hashes in shingle_sets(batch.column(1), size):
            if len(hashes):
                sizes[row], prints[row] = len(hashes), set_print(hashes)
                values[row] = signature(hashes)
        keys = np.tile(np.arange(bands, dtype=np.uint64), (count, 1))
        for k in range(rows):
            keys = mix(keys + values[:, k:rows * bands:rows].astype(np.uint64))
        low = np.stack([values & 1, (values >> 1) & 1], axis=2).astype(np.uint8).reshape(count, -1)
        packed = np.packbits(low, axis=1).view(np.int64).reshape(count, len(PACKED))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1, dtype=np.int32) * bands),
                                         pa.array(keys.ravel().view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes), pa.array(prints, pa.binary()), lists,
             *(pa.array(np.ascontiguousarray(packed[:, k])) for k in range(len(PACKED)))],
            names=["doc_id", "n_shingles", "print", "bands", *PACKED])


def _set_rows(batches, size: int):
    """Sets of (print, text) rows; a row whose text has another print gives none."""
    for batch in _cut(batches):
        prints = batch.column(0).to_pylist()
        found = [(prints[row], hashes.view(np.int64)) for row, hashes in shingle_sets(batch.column(1), size)
                 if set_print(hashes) == prints[row]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.list_(pa.int64()))],
            names=["print", "hashes"])


def _unlike_values(a: str, b: str) -> Column:
    """Signature values in which two rows differ, two bits kept of each."""
    total = F.lit(0)
    for name in PACKED:
        odd = F.col(f"{a}.{name}").bitwiseXOR(F.col(f"{b}.{name}"))
        either = odd.bitwiseOR(F.shiftrightunsigned(odd, 1)).bitwiseAND(F.lit(0x5555555555555555))
        total = total + F.bit_count(either)
    return total


def _alike(a: str, b: str, percent: int) -> Column:
    """True unless sizes or signatures rule a link out (signatures: by ``DEVIATIONS``)."""
    small = F.least(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    large = F.greatest(F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles"))
    j = percent / 100
    agree = j + (1 - j) / 4
    most = SIGNATURE * (1 - agree) + DEVIATIONS * (SIGNATURE * agree * (1 - agree)) ** 0.5
    return (small * 100 >= large * percent) & (_unlike_values(a, b) <= int(most))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    left = sets.select(F.col("print").alias("a"), F.col("hashes").alias("of_a"))
    right = sets.select(F.col("print").alias("b"), F.col("hashes").alias("of_b"))
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return pairs.join(left, "a").join(right, "b").where(common * 100 >= union * percent).select("a", "b")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``.

    Words are runs without white space, A to Z taken as a to z; a text's set has its distinct runs of
    ``shingle`` words, or all its words as one if it has fewer. Two texts are linked if 100 times their
    common shingles reach ``percent`` times those of either; ``component_id`` is the smallest id that
    links reach. Texts without words are linked with nothing, nor are rows whose id is null: their
    ``component_id`` is their own id and they are kept. Rows with equal ids count as linked only if
    their texts are. Repeated rows all come out; those with the smallest id are kept.

    Texts with equal sets are one vertex. Buckets of up to about ``CELL_MEMBERS`` vertices are compared
    in full; larger ones in random cells of that size first, then each vertex outside a bucket's main
    component with all vertices of other components in the bucket. So components are those of all
    candidate pairs, without listing the pairs inside a component.
    """
    kind = df.schema[id_column].dataType.simpleString()
    rows, bands = bands_for(percent)
    texts = df.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    with small_batches(df.sparkSession):
        signed = stage(texts.mapInArrow(
            lambda batches: _signature_rows(batches, shingle, rows, bands),
            f"doc_id {kind}, n_shingles long, print binary, bands array<long>, " + ", ".join(f"{x} long" for x in PACKED)),
            "signatures")
    usable = signed.where("print IS NOT NULL AND doc_id IS NOT NULL")
    first = stage(usable.groupBy("print").agg(F.min("doc_id").alias("doc_id")), "first")
    # Equal sets have equal signatures, so any row of a print describes it.
    vertices = usable.join(first, ["print", "doc_id"], "left_semi")

    # Vertices that share a bucket with another one.
    spread = vertices.select("print", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    # Repeated rows of one text and id come once.
    members = stage(spread.join(shared, "bucket").distinct(), "members")
    involved = members.select("print").distinct()
    marks = stage(vertices.join(involved, "print", "left_semi").dropDuplicates(["print"]), "involved")
    wanted = marks.select("doc_id", "print")
    if marks.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    with small_batches(df.sparkSession):
        sets = stage(texts.join(wanted, "doc_id").select("print", "text").mapInArrow(
            lambda batches: _set_rows(batches, shingle), "print binary, hashes array<long>")
            .dropDuplicates(["print"]), "sets")

    described = members.join(marks.drop("doc_id", "bands"), "print")
    cells = F.greatest(F.lit(1), F.floor(F.col("members") / CELL_MEMBERS))
    placed = described.withColumn("cell", F.pmod(F.xxhash64("print", "bucket"), cells))
    pairs = (
        placed.alias("x").join(placed.alias("y"), ["bucket", "cell"])
        .where((F.col("x.print") < F.col("y.print")) & _alike("x", "y", percent))
        .select(F.col("x.print").alias("a"), F.col("y.print").alias("b")).distinct()
    )
    links = stage(_confirmed(pairs, sets, percent), "links")
    labels = stage(components(links), "labels")

    # In large buckets: what is outside the main component, against all other components.
    large = described.where(F.col("members") > CELL_MEMBERS)
    large = large.join(labels.withColumnRenamed("vertex", "print"), "print", "left").withColumn(
        "label", F.coalesce("label", "print"))
    per_label = large.groupBy("bucket", "label").agg(F.count("*").alias("n"))
    main = per_label.groupBy("bucket").agg(F.max(F.struct("n", "label")).alias("most"), F.count("*").alias("labels"))
    large = large.join(main.where("labels > 1").select("bucket", F.col("most.label").alias("main")), "bucket")
    large = stage(large.join(marks.select("print", "bands"), "print"), "open-buckets")
    # A pair that shares several buckets comes from the first of those alone.
    first_shared = F.array_min(F.array_intersect("x.bands", "y.bands")) == F.col("bucket")
    rest = (
        large.where("label <> main").alias("x").join(large.alias("y"), "bucket")
        .where((F.col("x.label") != F.col("y.label")) & _alike("x", "y", percent) & first_shared)
        .select(F.least("x.print", "y.print").alias("a"), F.greatest("x.print", "y.print").alias("b")).distinct()
    )
    late = stage(_confirmed(rest, sets, percent), "links")
    joined = labels.select(F.col("vertex").alias("a"), F.col("label").alias("b")).unionByName(late)
    labels = stage(components(joined), "labels")

    # From vertices back to rows.
    lowest = (
        first.join(labels.withColumnRenamed("vertex", "print"), "print", "left")
        .withColumn("label", F.coalesce("label", "print"))
    )
    named = lowest.groupBy("label").agg(F.min("doc_id").alias("__low"))
    lowest = lowest.join(named, "label").select("print", F.col("__low"))
    found = signed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("print")).alias("print"))
    found = found.join(lowest, "print", "left").withColumn("component_id", F.coalesce("__low", "doc_id"))
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
