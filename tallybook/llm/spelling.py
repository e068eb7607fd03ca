"""Variant spellings of words, found by probing edits in Bloom filters.

The vocabulary's words are put into blocked Bloom filters, one per word length, in one table of bounded
size that goes to the workers. Each word then probes its edits of one character. Of a pair of near words
one side generates the other: the longer deletes, and of equal lengths the smaller replaces; so no
insertions are tried. Edits the filters let through are joined with the vocabulary, which removes false
hits: results do not depend on the filters' size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.arrow_text import LOWER, mix, slices, text_buffer, word_spans
from tallybook.llm.bloom import BUCKET, bit_table
from tallybook.llm.stage import stage

BLOCK_BITS = 512
PROBES = 6
BITS_PER_KEY = 20
# The filters' bound in bytes; with more words there are fewer bits for each and more false hits.
TABLE_BYTES = 64 << 20
# Longer words share the filter of this length.
LONGEST = 255
# Edits of a batch that are held at once.
EDITS = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
# Leads U+00C0 to U+00FF; the byte behind it belongs to the same letter.
_LEAD = 0xC3

_random = np.random.default_rng(20240923)
_SYMBOL = _random.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))

WORD_COUNTS = "word string, size int, n long"


def _powers(base: np.uint64, n: int) -> np.ndarray:
    table = np.full(n, base, dtype=np.uint64)
    table[:1] = 1
    return np.cumprod(table, dtype=np.uint64)


def _letters(data: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """True for the bytes of Latin letters."""
    letter = _LETTER[data]
    lead = np.flatnonzero(data == _LEAD)
    letter[lead] = True
    letter[lead + 1] = True
    return letter


def _word_counts(batches, shortest: int, alter: Callable[[str, str], str] | None):
    """Per slice its distinct words with their counts."""
    for batch in batches:
        ids = batch.column(0)
        data, limits = text_buffer(batch.column(1))
        for first, last in slices(limits):
            part = limits[first:last + 1] - limits[first]
            text = LOWER[data[limits[first]:limits[last]]]
            starts, ends, rows = word_spans(text, part, _letters(text, part))
            # Letters are the bytes that do not continue one.
            begun = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
            sizes = begun[ends] - begun[starts]
            long = np.flatnonzero(sizes >= shortest)
            if not len(long):
                continue
            starts, ends, rows = starts[long], ends[long], np.searchsorted(long, rows)
            lengths = ends - starts
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
            words = pa.Array.from_buffers(
                pa.large_string(), len(long), [None, pa.py_buffer(offsets), pa.py_buffer(text[at])]).dictionary_encode()
            names, index = words.dictionary.to_pylist(), np.asarray(words.indices)
            counts = dict(zip(names, np.bincount(index, minlength=len(names)).tolist()))
            if alter:
                for old, new in alter(ids.slice(first, last - first), rows, names, index):
                    counts[old] -= 1
                    counts[new] = counts.get(new, 0) + 1
            found = [(w, n) for w, n in counts.items() if n and len(w) >= shortest]
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.string()), pa.array([len(w) for w, _ in found], pa.int32()),
                 pa.array([n for _, n in found], pa.int64())], names=["word", "size", "n"])


def drop_letters(every: int):
    """Changes an occurrence whose crc32 of ``<id>:<word>`` is a multiple of ``every``: one letter is cut out."""

    def alter(ids: pa.Array, rows: np.ndarray, names: list[str], index: np.ndarray):
        encoded = [w.encode() for w in names]
        place = index.tolist()
        for row, name in enumerate(ids.to_pylist()):
            prefix = zlib.crc32(f"{'' if name is None else name}:".encode())
            # The same word in the same text is changed alike, so one check does for all of them.
            seen: dict[int, int] = {}
            for k in place[rows[row]:rows[row + 1]]:
                seen[k] = seen.get(k, 0) + 1
            for k, times in seen.items():
                h = zlib.crc32(encoded[k], prefix)
                if h % every == 0:
                    word = names[k]
                    cut = h % len(word)
                    for _ in range(times):
                        yield word, word[:cut] + word[cut + 1:]

    return alter


def vocabulary(df: DataFrame, shortest: int = 6, least: int = 5, id_column: str = "doc_id", text: str = "text",
               alter: Callable | None = None) -> DataFrame:
    """``word``, ``size`` (letters) and ``n`` of the words of ``shortest`` letters that occur ``least`` times.

    Words are maximal runs of Latin letters (A to Z, a to z, U+00C0 to U+00FF), A to Z taken as a to z.
    """
    rows = df.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    return (
        rows.mapInArrow(lambda b: _word_counts(b, shortest, alter), WORD_COUNTS)
        .groupBy("word", "size").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    )


class Filters:
    """Places of words in the table: a run of blocks per length, and bits in one block per word."""

    def __init__(self, counts: dict[int, int], table_bytes: int):
        wanted = {size: max(1, n * BITS_PER_KEY // BLOCK_BITS + 1) for size, n in sorted(counts.items())}
        most = table_bytes * 8 // BLOCK_BITS
        scale = min(1.0, most / max(1, sum(wanted.values())))
        self.blocks = np.zeros(LONGEST + 1, np.uint64)
        for size, n in wanted.items():
            self.blocks[size] = max(1, int(n * scale))
        self.offset = np.concatenate([[0], np.cumsum(self.blocks)[:-1]]).astype(np.uint64)
        self.bits = -(-int(self.blocks.sum()) * BLOCK_BITS // BUCKET) * BUCKET or BUCKET

    def positions(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First bit of each key's block, and a number of which nine bits each are a place in it."""
        size = min(size, LONGEST)
        block = ((hashes >> np.uint64(32)) * self.blocks[size]) >> np.uint64(32)
        return (self.offset[size] + block) * np.uint64(BLOCK_BITS), mix(hashes)

    def bits_of(self, hashes: np.ndarray, size: int) -> np.ndarray:
        start, inner = self.positions(hashes, size)
        return np.concatenate([start + ((inner >> np.uint64(9 * j)) & np.uint64(BLOCK_BITS - 1))
                               for j in range(PROBES)])

    def probe(self, table: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
        """Places in ``hashes`` of the keys that the filter of ``size`` may hold."""
        if self.blocks[min(size, LONGEST)] == 0:
            return np.zeros(0, np.int64)
        left = np.arange(len(hashes))
        start, inner = self.positions(hashes, size)
        for j in range(PROBES):
            at = start[left] + ((inner[left] >> np.uint64(9 * j)) & np.uint64(BLOCK_BITS - 1))
            left = left[(table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0]
        return left


def _symbols(words: list[str], size: int) -> np.ndarray:
    """The words' letters, one byte each: all lie below U+0100."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), size)


def _hashes(symbols: np.ndarray) -> np.ndarray:
    """Unmixed hash of each row: letters times rising powers."""
    return (_SYMBOL[symbols] * _powers(_BASE, symbols.shape[1])).sum(axis=1, dtype=np.uint64)


def _by_size(batches, limit: int):
    """(size, words) of batches in groups of ``limit`` letters or so."""
    for batch in batches:
        groups: dict[int, list[str]] = {}
        for word in batch.column(0).to_pylist():
            groups.setdefault(len(word), []).append(word)
        for size, words in groups.items():
            step = max(1, limit // size)
            for k in range(0, len(words), step):
                yield size, words[k:k + step]


def _bit_rows(batches, filters: Filters):
    for size, words in _by_size(batches, EDITS):
        at = filters.bits_of(mix(_hashes(_symbols(words, size))), size)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64))], names=["at"])


def _near_candidates(batches, sent, filters: Filters, alphabet: np.ndarray):
    """(word, edit) for the edits of one letter that the filters let through."""
    table = sent.value
    for size, words in _by_size(batches, EDITS // max(1, len(alphabet))):
        symbols = _symbols(words, size)
        power = _powers(_BASE, size)
        terms = _SYMBOL[symbols] * power
        whole = terms.sum(axis=1, dtype=np.uint64)
        pairs: list[tuple[str, str]] = []

        # Without one letter; in a run of equal letters only the last one is tried.
        before = np.cumsum(terms, axis=1, dtype=np.uint64)
        shorter = (before - terms) + (whole[:, None] - before) * _BASE_INVERSE
        tried = np.ones(symbols.shape, dtype=bool)
        tried[:, :-1] = symbols[:, 1:] != symbols[:, :-1]
        row, place = np.nonzero(tried)
        for k in filters.probe(table, mix(shorter[row, place]), size - 1):
            word, cut = words[row[k]], place[k]
            pairs.append((word, word[:cut] + word[cut + 1:]))

        # With a greater letter in one place.
        for place in range(size):
            old = symbols[:, place]
            row, letter = np.nonzero(alphabet[None, :] > old[:, None])
            new = alphabet[letter]
            other = whole[row] + (_SYMBOL[new] - _SYMBOL[old[row]]) * power[place]
            for k in filters.probe(table, mix(other), size):
                word = words[row[k]]
                pairs.append((word, word[:place] + chr(new[k]) + word[place + 1:]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs], pa.string()), pa.array([b for _, b in pairs], pa.string())],
            names=["word", "near"])


def near_words(words: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``word``, ``near``: all ordered pairs that differ by one inserted, deleted or replaced letter.

    ``words`` (``word``, ``size``, ``n``) is read several times and should be a stored table.
    """
    spark = words.sparkSession
    # At most LONGEST rows, and at most a row per letter.
    counts = {r.size: r.n for r in words.groupBy(F.least("size", F.lit(LONGEST)).alias("size"))
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r.c) for r in letters.collect()), np.uint8)
    filters = Filters(counts, table_bytes)
    table = bit_table(words.select("word").mapInArrow(lambda b: _bit_rows(b, filters), "at long"), "at", filters.bits)
    sent = spark.sparkContext.broadcast(table)
    tried = words.select("word").mapInArrow(
        lambda b: _near_candidates(b, sent, filters, alphabet), "word string, near string")
    found = stage(tried.join(words.select(F.col("word").alias("near")), "near", "left_semi").select("word", "near"),
                  "near-words")
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


def group_variants(df: DataFrame, shortest: int = 6, least: int = 5, factor: int = 5, id_column: str = "doc_id",
                   text: str = "text", alter: Callable | None = None, table_bytes: int = TABLE_BYTES,
                   rounds: int = 40) -> DataFrame:
    """One row per word of the vocabulary: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    A word's form is its near word that occurs most often, the smallest on a tie, if that occurs at least
    ``factor`` times as often; ``root`` follows forms to the last. Null and empty texts have no words; a
    null id counts as empty in ``alter``, which may change occurrences before they are counted. Repeated
    rows count again; further columns do not matter; an empty table gives no rows; a run of letters of any
    length is one word.

    Each form occurs ``factor`` times as often as the word before it, and each round doubles the steps
    taken, so that a few rounds reach the ends of all chains.
    """
    words = stage(vocabulary(df, shortest, least, id_column, text, alter), "vocabulary")
    best = (
        near_words(words, table_bytes).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    )
    formed = F.when(-F.col("best.col1") >= F.col("n") * factor, F.struct(
        F.col("best.near").alias("form"), (-F.col("best.col1")).alias("form_n")))
    named = stage(
        words.join(best, "word", "left").withColumn("chosen", formed)
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "chosen.form", "chosen.form_n"),
        "forms")

    steps = named.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stage(steps.join(further, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                      "roots")
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    return named.join(steps.select("word", "root"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
