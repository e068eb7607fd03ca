"""Spelling variants, phrases and benchmark passages against brute-force versions on awkward tables."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import bloom, decontaminate, phrases, spelling, spread
from tallybook.llm.arrow_text import text_buffer

LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
DOCS = "doc_id long, text string, lang string, word string, n long, row long, phrase string"

PASSAGE = " ".join(f"item{k}" for k in range(24))
TEXTS = [
    (1, "Receive receive RECEIVE recieve, receive; receive receive? receives receivés"),
    (2, "receives receives receives receives receives receives Straße Straßen straßen straßen straßen straßen"),
    (3, "receivés receivés receivés receivés ×receive receive÷ fooooo foooooo foooooo foooooo foooooo foooooo"),
    (4, "abcdef abcdef abcdef abcdef abcdef abcdeg abcdeg abcdeg abcdeg abcdeg " + "abcdeh " * 60),
    (5, None), (6, ""), (7, " \t\n .,!"), (8, "x" * 40_000), (8, "x" * 40_000),
    (9, PASSAGE), (9, PASSAGE), (10, f"Before {PASSAGE.upper()}, after."), (11, PASSAGE.replace("item12", "other")),
    (None, f"{PASSAGE} {PASSAGE}"), (12, "New York is big. New York is old! New York; New York is it"),
    (13, "new york is " * 40), (14, "a b a b a b a b a b a b a b a b a b a b a b a"), (15, "tiny item here"),
    (16, " ".join(f"long{k % 97} filler text" for k in range(3000))), (17, "日本 語 日本 語"), (18, "x\ty  z\x0bw"),
]
LANGS = ["en", "en", "de", None, "und"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, LANGS[k % 5], "clash", 7, 7, "clash") for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, DOCS).cache()


def rows_of(df):
    return [r.asDict() for r in df.collect()]


# --- spelling -----------------------------------------------------------------


def counted(texts, every=None):
    counts = Counter()
    for name, text in texts:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = word.translate(LOWER)
            h = zlib.crc32(f"{'' if name is None else name}:{word}".encode())
            if every and h % every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def variants(counts):
    near = {w: [x for x in counts if one_apart(w, x)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 5 * counts[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def found_variants(df, **options):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"])
            for r in rows_of(spelling.group_variants(df, **options))}


@pytest.mark.parametrize("every", [None, 2, 7])
def test_variants_equal_brute_force(docs, every):
    alter = spelling.drop_letters(every) if every else None
    expected = variants(counted(TEXTS, every))
    assert len(expected) > 5 and found_variants(docs, alter=alter) == expected


def test_forms_lead_to_their_root(spark):
    chain = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "zzzzzz": 5, "zzzzzzz": 5}
    rows = [(k, f"{w} " * n) for k, (w, n) in enumerate(chain.items())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found_variants(df)
    assert got == variants(chain) and ("aaaaaa", "aaaaab", "aabbbb", 5, 1, 25) in got


def test_a_crowded_filter_changes_nothing(spark):
    rng = np.random.default_rng(5)
    words = {"".join(rng.choice(list("abcé"), rng.integers(6, 9))) for _ in range(1500)}
    counts = {w: int(n) for w, n in zip(sorted(words), rng.integers(5, 60, len(words)))}
    df = spark.createDataFrame([(1, " ".join(f"{w} " * n for w, n in counts.items()))], "doc_id long, text string")
    expected = variants(counts)
    assert found_variants(df) == expected and found_variants(df, table_bytes=64) == expected


# --- phrases ------------------------------------------------------------------


def phrase_table(texts, most=3):
    counts, starts, ends, totals = Counter(), Counter(), Counter(), Counter()
    for k, (_, text) in enumerate(texts):
        lang = LANGS[k % 5] or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    key = lang, " ".join(words[i:i + size])
                    counts[key] += 1
                    starts[key] += i == 0
                    ends[key] += i + size == len(words)
    return counts, starts, ends, totals


def test_phrase_counts_equal_brute_force(docs):
    counts, starts, ends, totals = phrase_table(TEXTS, 4)
    got = rows_of(phrases.phrase_counts(docs, 4))
    assert {(r["lang"], r["phrase"]): (r["n"], r["starts"], r["ends"]) for r in got if r["words"]} == {
        k: (n, starts[k], ends[k]) for k, n in counts.items()}
    assert {r["lang"]: r["n"] for r in got if not r["words"] and r["n"]} == {k: n for k, n in totals.items() if n}


def best_phrases(texts, least, top):
    counts, _, _, totals = phrase_table(texts)
    candidates = {k: n for k, n in counts.items() if n >= least and " " in k[1]}
    rows = {}
    for (lang, phrase), a in candidates.items():
        if any(lang == other and f" {phrase} " in f" {longer} " and longer != phrase and 100 * f >= 50 * a
               for (other, longer), f in candidates.items()):
            continue
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right))
    return {(lang, rank, phrase.decode(), -a, left, right, totals[lang], -score)
            for lang, found in rows.items()
            for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1)}


@pytest.mark.parametrize("table_bytes", [4096, 1 << 20])
def test_frequent_phrases_equal_brute_force(spark, monkeypatch, table_bytes):
    """Several shards and hash ranges, and a table too small for its keys."""
    monkeypatch.setattr(phrases, "SEGMENT_BYTES", 20_000)
    rng = np.random.default_rng(8)
    texts = [(k, " ".join(f"w{x}" for x in rng.zipf(1.3, 300) % 5000)) for k in range(200)]
    df = spark.createDataFrame([(t, LANGS[k % 5]) for k, t in texts], "text string, lang string").repartition(7)
    counts, starts, ends, _ = phrase_table(texts)
    got = rows_of(phrases.phrase_counts(df, 3, 4, table_bytes=table_bytes).where("words > 0"))
    assert {(r["lang"], r["phrase"]): (r["n"], r["starts"], r["ends"]) for r in got} == {
        k: (n, starts[k], ends[k]) for k, n in counts.items() if n >= 4}


@pytest.mark.parametrize("least,top", [(2, 2000), (10, 2000), (2, 7)])
def test_collocations_equal_brute_force(docs, least, top):
    got = rows_of(phrases.collocations(docs, least=least, top=top))
    names = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert {tuple(r[c] for c in names) for r in got} == best_phrases(TEXTS, least, top)


def test_scores_beyond_64_bits_stay_exact(spark):
    a, left, right = 3_000_000_001, 3_000_000_007, 4_999_999_999
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(phrases._score(F.col("a"), F.col("l"), F.col("r"))).first()[0] == 1_000_000 * a * a // (left * right)


def test_index_levels_of_a_known_sequence():
    index = phrases.ShardIndex(np.array([1, 2, 1, 2, 0, 2, 1, 0], np.int32), 3)
    levels = list(index.levels())
    found = []
    for size, (begin, count, starts, ends) in enumerate(levels, 1):
        words = zip(*(x.tolist() for x in index.symbols(begin, size)))
        found.append(dict(zip(words, zip(count.tolist(), starts.tolist(), ends.tolist()))))
    assert found == [{(1,): (3, 1, 1), (2,): (3, 1, 1)}, {(1, 2): (2, 1, 1), (2, 1): (2, 1, 1)},
                     {(1, 2, 1): (1, 1, 0), (2, 1, 2): (1, 0, 1)}]


# --- benchmark passages ---------------------------------------------------------

ITEMS = [
    ("b1", PASSAGE), ("b2", PASSAGE[: PASSAGE.index("item15")]), ("b3", "tiny item"), ("b4", None), ("b5", "?! --"),
    (None, "日本"), ("b1", "new york is new york is new york is new york"), ("b6", "receive"),
    ("b7", " ".join(f"long{k} filler text" for k in range(40, 45))), ("b8", "never in any of the documents at all, is it"),
    ("b10", PASSAGE),
]


def split(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def contaminated(texts, items, window):
    wanted = {}
    for name, text in items:
        words = split(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1) if size else ():
            wanted.setdefault(tuple(words[i:i + size]), set()).add(name)
    rows = []
    for name, text in texts:
        words, hit, names = split(text), set(), set()
        for size in {len(w) for w in wanted}:
            for i in range(len(words) - size + 1):
                if found := wanted.get(tuple(words[i:i + size])):
                    hit |= set(range(i, i + size))
                    names |= found
        names = sorted(names - {None})
        rows.append((name, len(words), len(hit), len(names),
                     hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(rows, key=str)


def found_items(df, items, **options):
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return sorted((tuple(r[c] for c in names) for r in rows_of(decontaminate.find_items(df, items, **options))), key=str)


@pytest.mark.parametrize("window,table_bytes", [(10, 32 << 20), (10, 4096), (3, 32 << 20), (1, 32 << 20)])
def test_items_in_documents_equal_brute_force(spark, docs, window, table_bytes):
    items = spark.createDataFrame([(*x, "clash") for x in ITEMS], "item_id string, text string, length string")
    expected = contaminated(TEXTS, ITEMS, window)
    assert sum(r[-1] for r in expected) >= 5
    assert found_items(docs, items, window=window, table_bytes=table_bytes) == expected


def test_every_shared_span_is_found(spark):
    """Random texts over few words share spans of all lengths."""
    rng = np.random.default_rng(3)
    texts = [(k, " ".join(rng.choice(list("abcd"), rng.integers(1, 300)))) for k in range(60)]
    items = [(f"i{k}", " ".join(rng.choice(list("abcd"), rng.integers(1, 14)))) for k in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    assert found_items(df, benchmark) == contaminated(texts, items, 10)


def test_fingerprints_of_equal_windows_are_equal():
    rng = np.random.default_rng(9)
    hashes = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    for length in range(1, 11):
        prints = decontaminate.window_prints(hashes, length)
        assert len(prints) == 5000 - length + 1
        assert all(decontaminate.window_prints(hashes[k:k + length], length)[0] == prints[k] for k in range(0, 4900, 97))
        if length > 4:  # neighbours share fingerprints
            assert (prints[1:] == prints[:-1]).mean() > 0.4


# --- empty tables and helpers -----------------------------------------------------


def test_empty_tables(spark, docs):
    empty = docs.where("false")
    items = spark.createDataFrame([], "item_id string, text string")
    assert spelling.group_variants(empty).count() == 0
    assert phrases.collocations(empty).count() == 0
    assert decontaminate.find_items(empty, items).count() == 0
    assert found_items(docs, items) == contaminated(TEXTS, [], 10)


def test_hot_keys_join_like_others(spark, monkeypatch):
    many = spark.range(20_000).select((F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))).alias("k"), "id")
    one = spark.range(0, 20_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        expected = sorted(many.join(one, "k", how).select("k", "id", "v").collect())
        assert sorted(spread.spread_join(many, one, ["k"], how).select("k", "id", "v").collect()) == expected


def test_bit_tables_hold_all_their_keys(spark):
    keys = np.random.default_rng(2).integers(-2**63, 2**63, 4000, dtype=np.int64)
    df = spark.createDataFrame([(int(k),) for k in keys], "key long")
    bits = bloom.power_of_two(4000 * 32, 1 << 20)
    table = bloom.bit_table(df.select(F.explode(bloom.probe_positions(F.col("key"), bits, 5)).alias("at")), "at", bits)
    assert bloom.probe(table, keys, 5).all()
    others = np.random.default_rng(4).integers(-2**63, 2**63, 100_000, dtype=np.int64)
    assert bloom.probe(table, others, 5).mean() < 0.001


def test_null_text_is_empty():
    import pyarrow as pa
    data, limits = text_buffer(pa.array(["a", None, "bc"]))
    assert data.tobytes() == b"abc" and limits.tolist() == [0, 1, 1, 3]
