"""Benchmark passages in documents, found by winnowed fingerprints.

Every window of ``window`` words has as its fingerprint the smallest hash of its runs of
``ceil(window / 2)`` words; neighbouring windows mostly share it, so a text has few. A window that two
texts share has the same fingerprint in both: no shared span of a window or more is missed. An item of
fewer words is one window of its own length, for which documents get fingerprints too.

A table of the items' fingerprints goes to the workers, bounded in bytes; windows whose fingerprint is
in it are put together to spans, and only those leave the document. Equal spans are looked up once:
they are joined with the items by fingerprint and words, so that neither a false hit nor a fingerprint
common to many items makes pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.arrow_text import LOWER, mix, shingle_hashes, slices, text_buffer, word_hashes, word_spans
from tallybook.llm.bloom import bit_table, power_of_two, probe, probe_positions
from tallybook.llm.spread import spread_join
from tallybook.llm.stage import stage

PROBES = 5
BITS_PER_KEY = 32
# The table's bound; with more fingerprints it lets more false hits through to the join.
TABLE_BYTES = 32 << 20

# Bytes of words: digits, Latin letters, and all beyond ASCII.
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = True
_WORD[0x80:] = True

_SPANS = pa.list_(pa.struct([("length", pa.int32()), ("start", pa.int64()), ("words", pa.string()),
                             ("prints", pa.list_(pa.int64()))]))
_SPANS_SQL = "array<struct<length: int, start: long, words: string, prints: array<long>>>"


def window_prints(hashes: np.ndarray, length: int) -> np.ndarray:
    """The fingerprint of each window of ``length`` words."""
    size = (length + 1) // 2
    grams = shingle_hashes(hashes, size)
    count = len(hashes) - length + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    low = grams[:count].copy()
    for k in range(1, length - size + 1):
        np.minimum(low, grams[k:k + count], out=low)
    return mix(low + np.uint64(length)).view(np.int64)


def _texts(batches, column: int = 1):
    """(first column's rows, lower-case bytes, word starts, word ends, rows' first words, hashes) of slices."""
    for batch in batches:
        data, limits = text_buffer(batch.column(column))
        for first, last in slices(limits):
            part = limits[first:last + 1]
            text = data[part[0]:part[-1]]
            starts, ends, rows = word_spans(text, part - part[0], _WORD[text])
            yield (batch.column(0).slice(first, last - first), LOWER[text], starts, ends, rows,
                   word_hashes(text, starts, ends))


def _joined(text: bytes, starts: np.ndarray, ends: np.ndarray, first: int, beyond: int) -> str:
    return b" ".join([text[a:b] for a, b in zip(starts[first:beyond], ends[first:beyond])]).decode()


def _item_windows(batches, window: int):
    for ids, data, starts, ends, rows, hashes in _texts(batches):
        text = data.tobytes()
        for row, item in enumerate(ids.to_pylist()):
            first, beyond = int(rows[row]), int(rows[row + 1])
            length = min(window, beyond - first)
            if not length:
                continue
            prints = window_prints(hashes[first:beyond], length)
            n = len(prints)
            yield pa.RecordBatch.from_arrays(
                [pa.array([item] * n, pa.string()), pa.array(np.full(n, length, np.int32)), pa.array(prints),
                 pa.array([_joined(text, starts, ends, first + k, first + k + length) for k in range(n)], pa.string())],
                names=["item", "length", "print", "window"])


def _runs(hit: np.ndarray, rows: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """(row, first window, window after the last) of runs of hit windows that lie in one row."""
    at = np.flatnonzero(hit)
    row = np.searchsorted(rows, at, side="right") - 1
    inside = at + length <= rows[row + 1]
    at, row = at[inside], row[inside]
    if len(at):
        new = np.flatnonzero((np.diff(at) > 1) | (np.diff(row) > 0)) + 1
        firsts, lasts = np.concatenate([[0], new]), np.concatenate([new, [len(at)]]) - 1
        yield from zip(row[firsts].tolist(), at[firsts].tolist(), (at[lasts] + 1).tolist())


def _document_spans(batches, sent, lengths: list[int]):
    """Per document: its words counted, and the spans of windows whose fingerprints an item may have."""
    table = sent.value
    for ids, data, starts, ends, rows, hashes in _texts(batches):
        text = data.tobytes()
        spans: list[list] = [[] for _ in range(len(ids))]
        for length in lengths:
            prints = window_prints(hashes, length)
            if not len(prints):
                continue
            changed = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
            seen = probe(table, prints[changed], PROBES)
            hit = np.repeat(seen, np.diff(np.append(changed, len(prints))))
            for row, first, beyond in _runs(hit, rows, length):
                spans[row].append({
                    "length": length, "start": first - int(rows[row]),
                    "words": _joined(text, starts, ends, first, beyond + length - 1),
                    "prints": prints[first:beyond].tolist()})
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(np.diff(rows)), pa.array(spans, _SPANS)], names=["doc_id", "n_words", "spans"])


def _sha256(items) -> F.Column:
    return F.sha2(F.array_join(items, ","), 256)


def find_items(df: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text",
               item_column: str = "item_id", item_text: str = "text", window: int = 10,
               table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items``,
    ``items_sha256``, ``contaminated``.

    ``n_hit`` counts the words inside any occurrence of a window of an item; ``items`` are the ids, as
    text and sorted, of the items with such windows. Words are runs of digits, Latin letters and
    characters beyond ASCII, A to Z taken as a to z. Null and wordless texts have no words: such a
    document is clean, such an item is never found. Repeated rows and null document ids come out like
    others; an item without id marks words but is in no list; items repeated under one id are one.
    Further columns do not matter. Without items all documents are clean.
    """
    spark = df.sparkSession
    kind = df.schema[id_column].dataType.simpleString()
    found = stage(
        items.select(F.col(item_column).cast("string").alias("item"), F.col(item_text).alias("text"))
        .mapInArrow(lambda b: _item_windows(b, window), "item string, length int, print long, window string")
        .groupBy("length", "print", "window").agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumn("set_id", F.md5(F.array_join("items", ",").cast("binary"))), "item-windows")
    lengths = [r.length for r in found.select("length").distinct().collect()]  # at most ``window`` of them

    wanted = found.select("print").distinct()
    bits = power_of_two(wanted.count() * BITS_PER_KEY, table_bytes * 8)
    table = bit_table(wanted.select(F.explode(probe_positions(F.col("print"), bits, PROBES)).alias("at")), "at", bits)
    sent = spark.sparkContext.broadcast(table)
    docs = stage(
        df.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
        .mapInArrow(lambda b: _document_spans(b, sent, lengths),
                    f"doc_id {kind}, n_words long, spans {_SPANS_SQL}")
        .withColumn("row", F.monotonically_increasing_id()), "document-spans")

    # Equal spans once; each of their windows against the items' windows of the same fingerprint.
    spans = docs.select("row", F.inline("spans"))
    apart = (
        spans.groupBy("length", "words").agg(F.any_value("prints").alias("prints"))
        .select("length", "words", F.posexplode("prints").alias("at", "print"))
        .withColumn("window", F.array_join(F.slice(F.split("words", " "), F.col("at") + 1, F.col("length")), " "))
    )
    hits = stage(
        apart.join(found.select("length", "print", "window", "set_id"), ["length", "print", "window"])
        .groupBy("length", "words").agg(F.collect_list(F.struct("at", "set_id")).alias("hits")), "span-hits")
    placed = (
        spread_join(spans.select("row", "length", "start", "words"), hits, ["length", "words"])
        .select("row", "length", "start", F.inline("hits"))
        .select("row", (F.col("start") + F.col("at")).alias("first"),
                (F.col("start") + F.col("at") + F.col("length")).alias("beyond"), "set_id")
    )
    earlier = Window.partitionBy("row").orderBy("first", "beyond").rowsBetween(Window.unboundedPreceding, -1)
    covered = F.coalesce(F.max("beyond").over(earlier), F.lit(0))
    dirty = stage(
        placed.withColumn("new", F.greatest(F.lit(0), F.col("beyond") - F.greatest("first", covered)))
        .groupBy("row").agg(F.sum("new").alias("n_hit"), F.array_sort(F.collect_set("set_id")).alias("sets"))
        .withColumn("key", F.md5(F.array_join("sets", ",").cast("binary"))), "dirty-rows")

    # Documents with the same items share one list.
    members = found.groupBy("set_id").agg(F.any_value("items").alias("items"))
    lists = (
        dirty.groupBy("key").agg(F.any_value("sets").alias("sets"))
        .select("key", F.explode("sets").alias("set_id")).join(members, "set_id")
        .groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    )
    named = spread_join(dirty.select("row", "n_hit", "key"), lists, ["key"])
    suspect = F.size("spans") > 0
    out = ("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
           _sha256(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
    none = F.array().cast("array<string>")
    checked = docs.where(suspect).select("row", "doc_id", "n_words").join(named, "row", "left").withColumns(
        {"n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"), "items": F.coalesce("items", none)})
    clean = docs.where(~suspect).select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    return checked.select(*out).unionByName(clean.select(*out))
