"""Scores of texts under a bigram model whose counts sit in a log-frequency Bloom filter.

A bigram seen c times is held as the levels 1 to 1 + floor(log2 c), each a key of the filter; probing
upwards until a level is missing gives c back, rounded down to a power of two. With c(v) the exact
count of v, p(w | v) = W c(v, w) / c(v) + (1 - W) p(w), and p(w) alone after an unknown v: rounded-down
counts never add up to more than c(v), so that the probabilities of all words stay below one, but
for the filter's rare false hits. A false hit cannot exceed c(v) or c(w) either, which are known exactly.

All bigrams of the training texts are held, those seen once too: a copy of a text tells by them.

Texts are handled in chunks of a few megabytes: a chunk has its distinct words, sorted by hash, and
its texts as places in that list. Counts of chunks are added up in segments of the hash range and
come back to each chunk for its own words, once. Bigrams go the same way: a chunk sends its distinct
ones to the segments of the filter, and each segment, filled from the training texts' own, is probed
there for all of them. So the filter is never in one place, and the work grows with the texts. All rows
that are shuffled are such bounded blocks, packed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.arrow_text import mix, slices, text_buffer, word_hashes, word_spans
from tallybook.llm.packed import pack, pack_sorted, unpack, unpack_sorted
from tallybook.llm.stage import discard, stage

CHUNK_BYTES = 1 << 23
# Distinct words of chunks that one segment adds up.
SEGMENT_WORDS = 1 << 19
# A segment of the filter, and its hash functions per level.
SEGMENT_BITS = 1 << 25
PROBES = 8
# Bits per training token. A bigram seen c times has 1 + floor(log2 c) levels, so there are at least as many
# bits per key.
BITS_PER_TOKEN = 16
# Bigrams with fewer occurrences are not held; a power of two.
LEAST = 1
# Segments that one task fills and probes together have at most so many bytes, or are a single one.
PART_BYTES = 4 << 20
# Weight of the bigram's share against the single word's probability.
WEIGHT = 0.25

_START, _END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
CHUNK = ("chunk string, doc_ids array<{kind}>, held array<boolean>, lengths array<int>, words binary, "
         "vocabulary binary, trained binary, n_words int, n_docs int, n_trained bigint")


def _lists(values: np.ndarray, limits, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.asarray(limits, dtype=np.int32)), pa.array(values, kind))


def _chunk_rows(batches):
    """Batches of (doc_id, text, held) to one row per chunk."""
    number = 0
    for batch in batches:
        data, limits = text_buffer(batch.column(1))
        held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        for first, last in slices(limits, CHUNK_BYTES):
            hashes, counts = [], []
            for a, b in slices(limits[first:last + 1]):
                part = limits[first + a:first + b + 1]
                text = data[part[0]:part[-1]]
                starts, ends, words = word_spans(text, part - part[0])
                hashes.append(word_hashes(text, starts, ends))
                counts.append(np.diff(words))
            lengths = np.concatenate(counts)
            vocabulary, words = np.unique(np.concatenate(hashes), return_inverse=True)
            training = ~held[first:last]
            trained = np.bincount(words[np.repeat(training, lengths)], minlength=len(vocabulary))
            one = lambda x, kind: _lists(x, [0, len(x)], kind)
            ids = batch.column(0).slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{TaskContext.get().partitionId()}-{number}"]),
                 pa.ListArray.from_arrays(pa.array([0, last - first], pa.int32()), ids),
                 one(held[first:last], pa.bool_()), one(lengths.astype(np.int32), pa.int32()),
                 pa.array([pack(words, "<u4")]), pa.array([pack_sorted(vocabulary, "<u8")]),
                 pa.array([pack(trained, "<u4")]), pa.array([len(vocabulary)], pa.int32()),
                 pa.array([int(training.sum())], pa.int32()), pa.array([int(trained.sum())], pa.int64())],
                names=["chunk", "doc_ids", "held", "lengths", "words", "vocabulary", "trained", "n_words",
                       "n_docs", "n_trained"])
            number += 1


def _segment(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Segments are equal ranges of the hash, so sorted hashes fall into them in order."""
    return ((hashes >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)


def _blocks(hashes: np.ndarray, counts: np.ndarray, segments: int):
    """(segment, hashes, counts) of the segments that occur among sorted hashes."""
    limits = np.searchsorted(_segment(hashes, segments), np.arange(segments + 1))
    for k in np.flatnonzero(np.diff(limits)):
        yield int(k), hashes[limits[k]:limits[k + 1]], counts[limits[k]:limits[k + 1]]


def _word_blocks(batches, segments: int):
    for batch in batches:
        for row in range(len(batch)):
            words, trained = unpack_sorted(batch.column(1)[row].as_py(), "<u8"), unpack(batch.column(2)[row].as_py(), "<u4")
            rows = [(k, pack_sorted(h, "<u8"), pack(c, "<u4"))
                    for k, h, c in _blocks(words, trained, segments)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * len(rows)),
                     pa.array([x[0] for x in rows], pa.int32()), *(pa.array([x[k] for x in rows]) for k in (1, 2))],
                    names=["chunk", "segment", "hashes", "counts"])


def _add_words(rows: pd.DataFrame) -> pd.DataFrame:
    """Counts over all chunks of a segment, for each chunk's words; the first row has the distinct ones."""
    parts = [unpack_sorted(x, "<u8") for x in rows["hashes"]]
    _, place = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(place, np.concatenate([unpack(x, "<u4") for x in rows["counts"]])).astype(np.int64)
    ends = np.cumsum([len(x) for x in parts])
    known = np.zeros(len(rows), np.int64)
    known[0] = int((total > 0).sum())
    return pd.DataFrame({
        "chunk": rows["chunk"].to_numpy(), "segment": rows["segment"].to_numpy(), "n_known": known,
        "totals": [pack(total[place[e - len(x):e]], "<i8") for x, e in zip(parts, ends)]})


def _bigrams(words: np.ndarray, lengths: np.ndarray, vocabulary: np.ndarray):
    """Hash of each token and of its bigram, the end of each text included; the text of each token."""
    ends = np.cumsum(lengths)
    tokens = np.insert(vocabulary[words], ends, _END)
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[np.concatenate([[0], (ends + np.arange(1, len(lengths) + 1))[:-1]])] = _START
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + tokens), np.repeat(np.arange(len(lengths)), lengths + 1)


def _keys(hashes: np.ndarray) -> np.ndarray:
    """What tells bigrams of a segment apart: the half of the hash that the segment is not taken from.

    Two of a segment's million bigrams share it far more rarely than the filter errs anyway.
    """
    return hashes & np.uint64(0xFFFFFFFF)


def _placed(hashes: np.ndarray, segments: int) -> np.ndarray:
    """Segment and key of each bigram in one number, the order in which chunks list their bigrams."""
    return (_segment(hashes, segments).astype(np.uint64) << np.uint64(32)) | _keys(hashes)


def _bigram_blocks(batches, segments: int):
    """Distinct bigrams of each chunk with their occurrences in training, which are none for held-out texts' own."""
    for batch in batches:
        for row in range(len(batch)):
            held, lengths = (batch.column(k)[row].values.to_numpy(zero_copy_only=False) for k in (1, 2))
            words, vocabulary = unpack(batch.column(3)[row].as_py(), "<u4"), unpack_sorted(batch.column(4)[row].as_py(), "<u8")
            hashes, text = _bigrams(words, lengths, vocabulary)
            # The lowest bit tells training from held-out texts.
            placed = np.sort((_placed(hashes, segments) << np.uint64(1)) | ~held[text])
            counts = (placed & np.uint64(1)).astype(np.int64)
            placed >>= np.uint64(1)
            first = np.flatnonzero(np.diff(placed, prepend=~placed[:1]))
            counts = np.add.reduceat(counts, first) if len(first) else counts
            placed = placed[first]
            owner = (placed >> np.uint64(32)).astype(np.int64)
            begins = np.flatnonzero(np.diff(owner, prepend=-1))
            rows = [(int(owner[x]), pack_sorted(_keys(placed[x:y]), "<u4"), pack(counts[x:y], "<u4"))
                    for x, y in zip(begins, [*begins[1:], len(placed)])]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[row].as_py()] * len(rows)),
                     pa.array([x[0] for x in rows], pa.int32()), *(pa.array([x[k] for x in rows]) for k in (1, 2))],
                    names=["chunk", "segment", "hashes", "counts"])


def _places(hashes: np.ndarray, level: int, probe: int, segment_bits: int) -> np.ndarray:
    return mix(hashes + np.uint64((level * 64 + probe) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(segment_bits)


def _fill_segment(rows: pd.DataFrame, lowest: int = 1, segment_bits: int = SEGMENT_BITS) -> pd.DataFrame:
    """One segment of the filter as bytes, with the levels from ``lowest`` on."""
    parts = [unpack_sorted(x, "<u4").astype(np.uint64) for x in rows["hashes"]]
    hashes, place = np.unique(np.concatenate(parts), return_inverse=True)
    levels = np.frexp(np.bincount(place, np.concatenate([unpack(x, "<u4") for x in rows["counts"]])))[1]
    bits = np.zeros(segment_bits, dtype=bool)
    for level in range(lowest, int(levels.max()) + 1):
        there = hashes[levels >= level]
        for probe in range(PROBES):
            bits[_places(there, level, probe, segment_bits)] = True
    return pd.DataFrame({"segment": rows["segment"].iloc[:1].to_numpy(), "bits": [np.packbits(bits, bitorder="little").tobytes()]})


def _counts_from(filter_bits: np.ndarray, hashes: np.ndarray, segment: np.ndarray, lowest: int = 1,
                 segment_bits: int = SEGMENT_BITS) -> np.ndarray:
    """Counts of bigrams, rounded down to powers of two, by probing level after level."""
    found = np.zeros(len(hashes))
    left, level = np.arange(len(hashes)), lowest - 1
    while len(left):
        level += 1
        for probe in range(PROBES):
            place = _places(hashes[left], level, probe, segment_bits)
            byte = filter_bits[segment[left] * (segment_bits // 8) + (place >> np.uint64(3)).astype(np.int64)]
            left = left[(byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        found[left] = 2.0 ** (level - 1)
    return found


def _probe_part(rows: pd.DataFrame, lowest: int, segment_bits: int) -> pd.DataFrame:
    """Fills some segments of the filter and probes each for the bigrams of all chunks: their levels, 0 for none."""
    found = []
    for segment, own in rows.groupby("segment"):
        bits = np.frombuffer(_fill_segment(own, lowest, segment_bits)["bits"].iloc[0], np.uint8)
        parts = [unpack_sorted(x, "<u4").astype(np.uint64) for x in own["hashes"]]
        hashes, place = np.unique(np.concatenate(parts), return_inverse=True)
        counts = _counts_from(bits, hashes, np.zeros(len(hashes), np.int64), lowest, segment_bits)
        levels = np.frexp(counts)[1].astype(np.uint8)
        ends = np.cumsum([len(x) for x in parts])
        found.append(pd.DataFrame({
            "chunk": own["chunk"].to_numpy(), "segment": segment,
            "levels": [pack(levels[place[e - len(x):e]], "u1") for x, e in zip(parts, ends)]}))
    return pd.concat(found)


def _score_rows(batches, segments: int, n: int, v: int, docs: int, weight: float):
    """A row per chunk: the figures of its texts."""
    for batch in batches:
        names = batch.schema.names
        for row in range(len(batch)):
            at = lambda name: batch.column(names.index(name))[row]  # noqa: E731, B023
            joined = lambda name, kind: np.concatenate(
                [unpack(x[name], kind) for x in sorted(at(name).as_py() or [], key=lambda x: x["segment"])]  # noqa: B023
                or [np.zeros(0, kind)])
            lengths = at("lengths").values.to_numpy()
            words, vocabulary = unpack(at("words").as_py(), "<u4"), unpack_sorted(at("vocabulary").as_py(), "<u8")
            total = joined("totals", "<i8")
            hashes, text = _bigrams(words, lengths, vocabulary)
            ends = np.cumsum(lengths)
            count = np.insert(total[words], ends, docs).astype(np.float64)
            context = np.empty_like(count)
            context[1:] = count[:-1]
            context[np.concatenate([[0], (ends + np.arange(1, len(lengths) + 1))[:-1]])] = docs
            _, place = np.unique(_placed(hashes, segments), return_inverse=True)
            levels = joined("levels", "u1")[place].astype(np.int64)
            joint = np.where(levels > 0, np.exp2(levels - 1.0), 0.0)
            joint = np.minimum(joint, np.minimum(context, count))
            share = weight * (context > 0)
            single = (count + 1) / (n + v + 1)
            score = np.log10(share * joint / np.maximum(context, 1) + (1 - share) * single)
            rows = len(lengths)
            one = lambda x: _lists(x, [0, rows], x.type if isinstance(x, pa.Array) else None)  # noqa: E731, B023
            columns = {
                "doc_id": one(at("doc_ids").values), "held_out": one(at("held").values),
                "n_tokens": one(lengths.astype(np.int64) + 1),
                "n_known": one(np.bincount(text, count > 0, rows).astype(np.int64)),
                "base_score": one(np.bincount(text, np.log10(single), rows)),
                "score": one(np.bincount(text, score, rows).astype(np.float64))}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def score_texts(df: DataFrame, held_out: Column, id_column: str = "doc_id", text: str = "text",
                weight: float = WEIGHT, part_bytes: int = PART_BYTES, least: int = LEAST,
                segment_bits: int = SEGMENT_BITS) -> DataFrame:
    """One row per row of ``df``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score``.

    Tokens are the words, A to Z taken as a to z, and one end per text. The model learns from the rows
    that are not ``held_out`` (null counts as false). ``base_score`` is the sum of log10((c + 1) / (N + V
    + 1)) from exact counts; ``score`` that of the bigram model. A null text is an empty one and has its
    end alone. Repeated rows and null ids come out like others; an empty table gives an empty one. If
    nothing is held in training, N is 0 and all tokens are unknown.

    The filter's size follows the training tokens. It is filled and probed in parts of at most ``part_bytes``,
    each by one task, so results do not depend on the parts.
    """
    lowest = least.bit_length()
    kind = df.schema[id_column].dataType.simpleString()
    chunks = stage(
        df.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"),
                  F.coalesce(held_out, F.lit(False)).alias("held"))
        .mapInArrow(_chunk_rows, CHUNK.format(kind=kind)), "chunks")
    sums = chunks.agg(F.sum("n_docs"), F.sum("n_trained"), F.sum("n_words")).first()
    docs, words, listed = (x or 0 for x in sums)
    train_tokens = docs + words

    word_segments = max(1, -(-listed // SEGMENT_WORDS))
    counted = stage(
        chunks.select("chunk", "vocabulary", "trained")
        .mapInArrow(lambda b: _word_blocks(b, word_segments), "chunk string, segment int, hashes binary, counts binary")
        .groupBy("segment").applyInPandas(_add_words, "chunk string, segment int, n_known bigint, totals binary"),
        "word-counts")
    distinct = (counted.agg(F.sum("n_known")).first()[0] or 0) + (1 if docs else 0)

    segments = max(1, -(-train_tokens * BITS_PER_TOKEN // segment_bits))
    each = max(1, part_bytes // (segment_bits // 8))
    probed = stage(
        chunks.select("chunk", "held", "lengths", "words", "vocabulary")
        .mapInArrow(lambda b: _bigram_blocks(b, segments), "chunk string, segment int, hashes binary, counts binary")
        .groupBy(F.expr(f"segment div {each}"))
        .applyInPandas(lambda x: _probe_part(x, lowest, segment_bits), "chunk string, segment int, levels binary"),
        "levels", codec="none")

    ready = chunks.select("chunk", "doc_ids", "held", "lengths", "words", "vocabulary")
    for table, name in ((counted, "totals"), (probed, "levels")):
        ready = ready.join(
            table.groupBy("chunk").agg(F.collect_list(F.struct("segment", name)).alias(name)), "chunk", "left")
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")
    found = stage(ready.mapInArrow(
        lambda b: _score_rows(b, segments, train_tokens, distinct, docs, weight),
        f"doc_id array<{kind}>, held_out array<boolean>, n_tokens array<bigint>, n_known array<bigint>, "
        "base_score array<double>, score array<double>"), "scores")
    discard(chunks, counted, probed)
    return found.select(F.inline(F.arrays_zip(*columns))).select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")
