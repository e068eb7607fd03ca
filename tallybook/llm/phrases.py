"""Word sequences with their counts, from an index of each shard's word ids.

A shard is a few megabytes of text. Its words become numbers, its pieces a sequence of numbers that a
zero ends, and the sequence a Burrows-Wheeler transform over suffixes sorted by as many words as a
phrase may have. A row interval of the transform stands for a phrase: its length is the phrase's count,
the transform's symbols in it are the words to the phrase's left, and the intervals it falls into one
level deeper are its extensions to the right. All intervals of a level are extended at once, backwards
by the transform, until the wanted length. Counts of shards add up, and so do the occurrences that
cannot be extended because a piece begins or ends there.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.llm.arrow_text import LOWER, mix, shingle_hashes, slices, text_buffer, word_hashes, word_spans
from tallybook.llm.bloom import bit_table, power_of_two, probe, probe_positions
from tallybook.llm.packed import pack, pack_sorted, unpack, unpack_sorted
from tallybook.llm.spread import spread_join
from tallybook.llm.stage import stage

SHARD_BYTES = 2 << 20
# Rows of shards that a task adds up before they are shuffled.
HELD_ROWS = 1 << 17
# Text whose phrases' hashes are added up at once.
SEGMENT_BYTES = 16 << 20
PROBES = 5
BITS_PER_KEY = 16
# The bound of the table of frequent phrases; beyond it more rare ones are counted in vain.
TABLE_BYTES = 64 << 20
# Parts of a language in which its best phrases are picked before the last pick, which sees so many times
# the wanted phrases at most, however many candidates there are.
PICKS = 32

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = True
_BREAK[0x0A:0x0E] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True

NAMES = ("lang", "words", "phrase", "n", "starts", "ends")
SCHEMA = "lang string, words int, phrase string, n long, starts long, ends long"


class ShardIndex:
    """The transform of a sequence of numbers, cut by zeros, over suffixes sorted by ``depth`` numbers."""

    def __init__(self, sequence: np.ndarray, depth: int):
        order = np.lexsort([np.roll(sequence, -k) for k in range(depth - 1, -1, -1)])
        # The symbol to the left of each sorted suffix.
        self.left = sequence[order - 1]
        # The row of a suffix one symbol shorter; the inverse of the step to the left.
        self.shorter = np.argsort(self.left, kind="stable")
        self.first = self.left[self.shorter]
        self.depth = depth

    def levels(self):
        """Per length 1, 2, ...: first row, count, starts and ends of each phrase, and its words' rows.

        Row ``j`` of level d + 1 begins an interval where its own first symbol changes, or the interval of
        level d that it was extended from.
        """
        new = np.concatenate([[True], self.first[1:] != self.first[:-1]])
        bounds, whole, rows = new, self.first > 0, np.arange(len(self.first))
        for _ in range(self.depth):
            begin = np.flatnonzero(bounds)
            count = np.diff(np.append(begin, len(bounds)))
            rows = self.shorter[rows]  # after the phrase
            keep = whole[begin]
            starts = np.add.reduceat(self.left == 0, begin)
            ends = np.add.reduceat(self.first[rows] == 0, begin)
            yield begin[keep], count[keep], starts[keep], ends[keep]
            interval = np.cumsum(bounds)[self.shorter]
            bounds = new | np.concatenate([[True], interval[1:] != interval[:-1]])
            whole = (self.first > 0) & whole[self.shorter]

    def symbols(self, begin: np.ndarray, length: int) -> list[np.ndarray]:
        """The words of phrases by their first rows."""
        found, rows = [], begin
        for _ in range(length):
            found.append(self.first[rows])
            rows = self.shorter[rows]
        return found


class _Shard:
    """The words of some texts: places, numbers by spelling and language, hashes and pieces."""

    def __init__(self, langs: pa.Array, data: np.ndarray, limits: np.ndarray):
        self.data = data = LOWER[data]
        self.starts, self.ends, rows = word_spans(data, limits, ~_GAP[data])
        self.langs = langs.fill_null("und").dictionary_encode()
        self.lang = np.repeat(np.asarray(self.langs.indices), np.diff(rows))
        salt = np.array([zlib.crc32(x.encode()) for x in self.langs.dictionary.to_pylist()], np.uint64)
        self.hashes = mix(word_hashes(data, self.starts, self.ends) + salt[self.lang])
        breaks = np.cumsum(_BREAK[data])[self.starts]
        # True for the last word of each piece.
        self.last = np.ones(len(self.starts), dtype=bool)
        self.last[:-1] = breaks[1:] != breaks[:-1]
        self.last[rows[1:][rows[1:] > 0] - 1] = True

    def phrase_hashes(self, depth: int) -> np.ndarray:
        """Hashes of all occurrences of phrases of up to ``depth`` words."""
        piece = np.cumsum(self.last) - self.last
        found = []
        for size in range(1, depth + 1):
            within = piece[size - 1:] == piece[:len(piece) - size + 1]
            found.append(shingle_hashes(self.hashes, size)[within[:max(0, len(piece) - size + 1)]])
        return np.concatenate(found)

    def numbered(self):
        """Number of each word, and the number's text, language and hash."""
        # The bytes of all words without what separates them.
        kept = pa.py_buffer(self.data[~_GAP[self.data]])
        offsets = np.concatenate([[0], np.cumsum(self.ends - self.starts)])
        words = pa.Array.from_buffers(
            pa.large_string(), len(self.starts), [None, pa.py_buffer(offsets), kept]).dictionary_encode()
        kinds = len(self.langs.dictionary)
        keys, places, ids = np.unique(np.asarray(words.indices).astype(np.int64) * kinds + self.lang,
                                      return_index=True, return_inverse=True)
        return (ids, words.dictionary.take(pa.array(keys // kinds)),
                self.langs.dictionary.take(pa.array(keys % kinds)), self.hashes[places])


def _texts(batches):
    for batch in batches:
        data, limits = text_buffer(batch.column(1))
        for first, last in slices(limits, SHARD_BYTES):
            part = limits[first:last + 1]
            shard = _Shard(batch.column(0).slice(first, last - first), data[part[0]:part[-1]], part - part[0])
            if len(shard.starts):
                yield shard


def _shard_rows(shard: _Shard, depth: int, table: np.ndarray | None, shift: int):
    """(lang, words, phrase, n, starts, ends) of a shard's phrases, those in ``table`` if there is one."""
    ids, text, of_lang, hashes = shard.numbered()
    # A zero after the last word of each piece.
    sequence = np.insert((ids + 1).astype(np.int32), np.flatnonzero(shard.last) + 1, 0)
    index = ShardIndex(sequence, depth)
    for length, (begin, *numbers) in enumerate(index.levels(), 1):
        symbols = [x - 1 for x in index.symbols(begin, length)]
        if table is not None:
            total = np.zeros(len(begin), np.uint64)
            for k, x in enumerate(symbols, 1):
                total = mix(total + hashes[x] + np.uint64(k))
            kept = np.flatnonzero(probe(table, mix(total >> np.uint64(shift)), PROBES))
            symbols, numbers = [x[kept] for x in symbols], [x[kept] for x in numbers]
        parts = [text.take(pa.array(x)) for x in symbols]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if length > 1 else parts[0]
        yield [of_lang.take(pa.array(symbols[0])), pa.array(np.full(len(phrase), length, np.int32)), phrase,
               *(pa.array(x.astype(np.int64)) for x in numbers)]
    kinds = len(shard.langs.dictionary)
    none = pa.array(np.zeros(kinds, np.int64))
    yield [shard.langs.dictionary, pa.array(np.zeros(kinds, np.int32)), pa.array([""] * kinds),
           pa.array(np.bincount(shard.lang, minlength=kinds).astype(np.int64)), none, none]


def _added(held: list[pa.Table]):
    """One row per phrase of the tables."""
    table = pa.concat_tables(held).group_by(list(NAMES[:3]), use_threads=False).aggregate([(c, "sum") for c in NAMES[3:]])
    kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    columns = [*NAMES[:3], *(f"{c}_sum" for c in NAMES[3:])]
    table = pa.table([table[c].cast(t) for c, t in zip(columns, kinds)], names=NAMES)
    return table.to_batches(max_chunksize=1 << 16)


def _phrase_rows(batches, depth: int, sent, shift: int):
    held: list[pa.Table] = []
    for shard in _texts(batches):
        for columns in _shard_rows(shard, depth, sent and sent.value, shift):
            held.append(pa.table([x.cast(pa.large_string()) if pa.types.is_string(x.type) else x for x in columns],
                                 names=NAMES))
        if sum(map(len, held)) >= HELD_ROWS:
            yield from _added(held)
            held = []
    if held:
        yield from _added(held)


def _hash_blocks(batches, depth: int, segments: int, shift: int):
    """Per shard and range of hashes: the phrases' hashes, shortened, and their counts."""
    for shard in _texts(batches):
        hashes, counts = np.unique(shard.phrase_hashes(depth) >> np.uint64(shift), return_counts=True)
        limits = np.searchsorted((hashes << np.uint64(shift) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32),
                                 np.arange(segments + 1))
        full = np.flatnonzero(np.diff(limits))
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)),
             pa.array([pack_sorted(hashes[limits[k]:limits[k + 1]], "<u8") for k in full], pa.binary()),
             pa.array([pack(counts[limits[k]:limits[k + 1]], "<i4") for k in full], pa.binary())],
            names=["segment", "hashes", "counts"])


def _frequent_hashes(blocks: pd.DataFrame, least: int) -> pd.DataFrame:
    hashes = np.concatenate([unpack_sorted(x, "<u8") for x in blocks["hashes"]])
    counts = np.concatenate([unpack(x, "<i4") for x in blocks["counts"]])
    order = np.argsort(hashes)
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    enough = np.add.reduceat(counts[order].astype(np.int64), first) >= least
    return pd.DataFrame({"key": mix(hashes[first[enough]]).view(np.int64)})


def _frequent_table(rows: DataFrame, depth: int, least: int, table_bytes: int):
    """The table of hashes that occur ``least`` times, broadcast, and how far hashes are shortened."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = max(1, -(-size // SEGMENT_BYTES))
    # Few of the hashes of so many phrases are alike.
    shift = max(0, 64 - 8 - max(size, 1 << 20).bit_length())
    found = stage(
        rows.mapInArrow(lambda b: _hash_blocks(b, depth, segments, shift), "segment int, hashes binary, counts binary")
        .groupBy("segment").applyInPandas(lambda x: _frequent_hashes(x, least), "key long"), "frequent-hashes")
    bits = power_of_two(found.count() * BITS_PER_KEY, table_bytes * 8)
    at = found.select(F.explode(probe_positions(F.col("key"), bits, PROBES)).alias("at"))
    return rows.sparkSession.sparkContext.broadcast(bit_table(at, "at", bits)), shift


def phrase_counts(df: DataFrame, max_words: int = 3, least: int = 1, lang: str = "lang", text: str = "text",
                  table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``lang``, ``words``, ``phrase``, ``n``, ``starts``, ``ends`` of all phrases of 1 to ``max_words`` words
    that occur ``least`` times.

    ``n`` counts all occurrences, overlaps included; ``starts`` of them have no word to their left in
    their piece and ``ends`` none to their right. The row with no words has the language's word count.
    Pieces end at ``. , ; : ! ?`` and line ends, words at spaces and tabs; A to Z count as a to z. A null
    language is ``und``; null, empty and wordless texts have no phrases. Repeated rows count again;
    further columns do not matter; an empty table gives no rows. A very long text is a shard of its own.
    """
    rows = df.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    sent, shift = _frequent_table(rows, max_words, least, table_bytes) if least > 1 else (None, 0)
    return (
        rows.mapInArrow(lambda b: _phrase_rows(b, max_words, sent, shift), SCHEMA)
        .groupBy("lang", "words", "phrase")
        .agg(*[F.sum(c).alias(c) for c in ("n", "starts", "ends")])
        .where((F.col("n") >= least) | (F.col("words") == 0))
    )


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)) in whole numbers of up to 38 digits."""
    digits = "decimal(15,0)"
    top = a.cast(digits) * a.cast(digits) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top, left.cast(digits) * right.cast(digits)).cast("long")


def collocations(df: DataFrame, max_words: int = 3, least: int = 10, inside: int = 50, top: int = 2000,
                 lang: str = "lang", text: str = "text") -> DataFrame:
    """Per language its ``top`` phrases of 2 to ``max_words`` words: ``lang``, ``rank``, ``phrase``, ``a``,
    ``l``, ``r``, ``n``, ``score``.

    A phrase with a >= ``least`` occurrences is a candidate. A cut after its first words leaves parts with
    l and r occurrences; the cut with the lowest score floor(1000000 a a / (l r)) counts, the earliest on a
    tie. Candidates inside a longer one that has ``inside`` percent of their occurrences or more are
    dropped. Best score first, then more occurrences, then the phrase in byte order. Equal phrases are one
    row, so that ranks are never tied. The awkward cases are as in :func:`phrase_counts`.

    Parts of a candidate occur at least as often as it does, and so does every phrase inside a longer
    candidate: only frequent phrases are stored and joined, and one word more is the only extension to look at.
    """
    counts = stage(phrase_counts(df, max_words, least, lang, text), "frequent-phrases")
    totals = counts.where("words = 0").select("lang", F.col("n").alias("total"))
    phrases = counts.where("words > 0").select("lang", "words", "phrase", F.col("n").alias("a"))

    longer = phrases.where("words > 2").select(
        "lang", "a", F.explode(F.array(
            F.expr("substring_index(phrase, ' ', words - 1)"),
            F.expr("substring_index(phrase, ' ', 1 - words)"))).alias("phrase"))
    extended = longer.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    free = (
        phrases.where("words > 1").join(extended, ["lang", "phrase"], "left")
        .where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * inside))
    )
    cuts = stage(
        free.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        .withColumns({"left_part": F.expr("substring_index(phrase, ' ', k)"),
                      "right_part": F.expr("substring_index(phrase, ' ', k - words)")}), "cuts")

    def part(side: str, name: str) -> DataFrame:
        return phrases.select("lang", F.col("phrase").alias(side), F.col("a").alias(name))

    with_left = stage(spread_join(cuts, part("left_part", "l"), ["lang", "left_part"]), "cuts")
    both = spread_join(with_left, part("right_part", "r"), ["lang", "right_part"])
    lowest = (
        both.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    picked = lowest.withColumn("pick", F.pmod(F.xxhash64("phrase"), F.lit(PICKS)))
    first = Window.partitionBy("lang", "pick").orderBy(*order)
    picked = picked.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top)
    last = Window.partitionBy("lang").orderBy(*order)
    ranked = picked.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    # One row per language.
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
