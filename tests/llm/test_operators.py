"""Each corpus operator against a brute-force version on small, awkward tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook.llm import (embedding_dedup, html_text, lm, minhash, mixing, packed, packing, quality, queries,
                           sharding, token_files, tokens, topk)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})

BASE = " ".join(f"word{k}" for k in range(60))
TEXTS = [
    (1, BASE), (2, BASE.upper()), (3, BASE + " tail"), (4, BASE.replace("word30", "other")),
    (5, "short text"), (6, "Short  TEXT"), (7, ""), (8, None), (9, " \t\n"), (10, "one"),
    (11, "It's 12,345 — naïve café… 日本 語 x y \U0001F600 don't.\n\n  two  spaces "),
    (12, " ".join(f"long{k % 997} filler" for k in range(4000))), (13, BASE), (13, BASE), (None, BASE),
    (14, "<|endoftext|> a"), (15, BASE + " tail end"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", s, len(t or ""), "x") for (i, t), s in zip(TEXTS, "a a a a b b b b c c c c c c d d".split() + [None])]
    return spark.createDataFrame(rows, DOCS).cache()


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def encoder():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.tokenizer_file())


def ids_of(text):
    return encoder().encode(text or "", add_special_tokens=False).ids


def test_shards_follow_the_key(spark, docs):
    got = rows_of(sharding.shard_rows(docs.withColumn("slot", F.lit("clash")), ["doc_id"], 16))
    assert len(got) == len(TEXTS) and {r["extra"] for r in got} == {"x"}
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    keys = np.random.default_rng(1).integers(-2**63, 2**63, 20_000)
    before, after = sharding.jump_hash(keys, 16), sharding.jump_hash(keys, 17)
    assert np.bincount(before, minlength=16).min() > 1000
    assert set(after[before != after]) == {16} and 0.04 < (before != after).mean() < 0.08
    assert sharding.shard_rows(docs.limit(0), ["doc_id"], 16).count() == 0


def test_mix_reaches_the_targets(spark, docs):
    got = rows_of(mixing.mix_sources(docs.withColumn("target", F.lit("clash"))))
    assert len(got) == len(TEXTS)
    sizes = Counter()
    for r in got:
        assert r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights, target, left, open_ = dict(zip(order, [3, 1, 2] * 9)), {}, 1.5 * sum(sizes.values()), set(order)
    while True:
        level = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level >= 2 * sizes[s]}
        if not full:
            break
        target |= {s: 2 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
        if not open_:
            break
    target |= {s: weights[s] * level for s in open_}
    for s in order:
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["target"] == pytest.approx(target[s])
        assert sum(r["taken"] for r in mine) == pytest.approx(target[s], abs=1)
    mixed = mixing.mix_sources(docs)
    counted = mixing.mixed_rows(mixed).select(F.sum(mixing.word_count(F.col("text")))).first()[0]
    assert counted == sum(r["taken"] for r in got)
    again = {(r["doc_id"], r["size"]): r["taken"] for r in rows_of(mixed.repartition(7)) if r["doc_id"] != 13}
    assert again == {(r["doc_id"], r["size"]): r["taken"] for r in got if r["doc_id"] != 13}
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_pieces_of_texts_encode_as_the_whole():
    import pyarrow as pa
    texts = [t for _, t in TEXTS] + ["a b", " a", "a ", "x×.y", "a\n b", "a\nb", "it's. we'll!", "é.è", "1.2,3", "a <|endoftext|>  b", "x<|endoftext|><|endoftext|>,y", "<|endoftext", "|>", "<|endoftext|>", "a\u0085 b", "—a —b"]
    found = []
    for first, last, ids, limits in tokens.token_slices(pa.array(texts), queries.tokenizer_file()):
        found += [ids[limits[k]:limits[k + 1]].tolist() for k in range(last - first)]
    tokenizer = encoder()
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_token_files_read_back(spark, docs, folder):
    token_files.write_tokens(docs, f"{folder}/tokens", queries.tokenizer_file(), files=3)
    got = token_files.read_tokens(spark, f"{folder}/tokens")
    got = rows_of(got.withColumn("crc", token_files.ids_crc32(F.col("tokens"))))
    assert len(got) == len(TEXTS)
    got.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    place = 0
    texts = dict(TEXTS)
    for r in got:
        expected = ids_of(texts[r["doc_id"]]) + [0]
        assert r["tokens"] == expected and r["start"] == place and r["n_tokens"] == len(expected)
        assert r["crc"] == zlib.crc32(np.array(expected, "<u4").tobytes())
        place += len(expected)
    token_files.write_tokens(docs.limit(0), f"{folder}/none", queries.tokenizer_file(), files=2)
    assert token_files.read_tokens(spark, f"{folder}/none").count() == 0


def test_packing_is_gapless_and_tight(spark, docs):
    got = rows_of(packing.pack(docs, queries.tokenizer_file()))
    texts, by_sequence, total = dict(TEXTS), {}, 0
    for r in got:
        expected = (ids_of(texts[r["doc_id"]]) + [2])[r["start"]:r["start"] + r["length"]]
        assert np.frombuffer(r["ids"], "<u4").tolist() == expected
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and (r["length"] == 1024 or r["piece"] == 0)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        total += r["length"]
    assert total == sum(len(ids_of(t)) + 1 for _, t in TEXTS)
    for places in by_sequence.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(by_sequence) <= math.ceil(total / 1024) + 1
    assert packing.pack(docs.limit(0), queries.tokenizer_file()).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(5)
    for _ in range(20):
        capacity = int(rng.integers(5, 60))
        lengths = rng.integers(1, capacity + 1, int(rng.integers(1, 300))).tolist()
        bins = []
        for length in sorted(lengths, reverse=True):
            fits = [k for k, left in enumerate(bins) if left >= length]
            if fits:
                bins[min(fits, key=lambda k: bins[k])] -= length
            else:
                bins.append(capacity - length)
        places = packing.plan(Counter(lengths), capacity)
        assert 1 + max(s + (b - a - 1) // e for _, a, b, s, e, _ in places) == len(bins)
        for length, n in Counter(lengths).items():
            spans = sorted((a, b) for x, a, b, *_ in places if x == length)
            assert spans[0][0] == 0 and spans[-1][1] == n and all(p[1] == q[0] for p, q in zip(spans, spans[1:]))


def sets_of(size):
    found = []
    for doc_id, text in TEXTS:
        w = words(text)
        found.append((doc_id, {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size
                      else {tuple(w)} if w else set()))
    return found


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates_are_components_of_exact_links(spark, docs, size, percent):
    got = rows_of(minhash.near_duplicates(docs, shingle=size, percent=percent))
    sets = sets_of(size)
    root = {d: d for d, _ in sets}
    for _ in sets:
        for a, x in sets:
            for b, y in sets:
                if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in got) == sorted(
        (d or 0, len(x), root[d] or 0) for d, x in sets)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_a_large_group_of_near_copies_keeps_its_components(spark):
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(150):
        w = list(base)
        for at in rng.integers(0, 120, int(rng.integers(0, 9))):
            w[at] = f"n{rng.integers(10**9)}"
        texts.append((k, " ".join(w)))
    got = rows_of(minhash.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), shingle=3, percent=85))
    sets = {k: {tuple(t.split()[j:j + 3]) for j in range(118)} for k, t in texts}
    root = {k: k for k in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert {r["doc_id"]: r["component_id"] for r in got} == root


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(8)
    shared, one, two = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (700, 150, 150))
    a, b = (minhash.signature(np.concatenate([shared, x])) for x in (one, two))
    assert abs((a == b).mean() - 0.7) < 0.1


def test_vectors_link_by_cosine(spark):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal((6, 32))
    rows = [(k, (centre[k % 6] + 0.28 * rng.standard_normal(32)).astype(np.float32).tolist(), k % 3) for k in range(240)]
    rows += [(240, rows[0][1], 0), (241, rows[0][1], None), (242, None, 0), (243, [0.0] * 32, 0),
             (244, [float("nan")] + [1.0] * 31, 0), (245, [None] + [1.0] * 31, 0), (246, [], 0), (247, [1.0, 2.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("print", F.lit(1))
    got = {r["vec_id"]: r for r in rows_of(embedding_dedup.near_vectors(df))}
    usable = {i: np.array(v, float) for i, v, label in rows if label is not None and i < 241}
    label = {i: x for i, _, x in rows}
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    linked = {i: {j for j in usable if j != i and label[i] == label[j] and cosine(usable[i], usable[j]) >= 0.93} for i in usable}
    assert sum(map(len, linked.values())) > 20
    root = {i: i for i in got}
    for _ in range(60):
        for i in linked:
            for j in linked[i]:
                root[i] = root[j] = min(root[i], root[j])
    assert {i: (r["n_links"], r["component_id"], r["kept"]) for i, r in got.items()} == {
        i: (len(linked.get(i, ())), root[i], root[i] == i) for i in got}
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(k, rng.standard_normal(20).astype(np.float32).tolist()) for k in range(300)]
    rows += [(300, rows[7][1]), (301, rows[7][1]), (302, None), (303, [float("inf")] * 20), (304, [1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = rows_of(topk.top_k(df.where("vec_id % 50 = 0"), df))
    x = {i: np.floor(np.array(v, float) * 1024) for i, v in rows[:302]}
    for q in range(0, 301, 50):
        expected = sorted((-int(x[q] @ x[i]), i) for i in x if i != q)[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert mine == [(k + 1, i, -s) for k, (s, i) in enumerate(expected)]
    assert topk.top_k(df.limit(0), df).count() == 0 and topk.top_k(df, df.limit(0)).count() == 0
    assert topk.top_k(df.where("vec_id = 0"), df.where("vec_id < 4")).count() == 3


def test_scores_have_exact_counts(spark, docs):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    got = rows_of(lm.score_texts(docs, held))
    split = lm.score_texts(docs, held, part_bytes=1)
    assert sorted(round(r["score"], 9) for r in got) == sorted(round(r["score"], 9) for r in rows_of(split))
    texts, count = dict(TEXTS), Counter()
    for doc_id, text in TEXTS:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2:
            count.update([*words(text), "\n"])
    n, v = sum(count.values()), len(count)
    assert len(got) == len(TEXTS)
    for r in got:
        w = [*words(texts[r["doc_id"]]), "\n"]
        assert r["base_score"] == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(count[x] > 0 for x in w), n)
        assert r["score"] < 0
    assert lm.score_texts(docs.limit(0), held).count() == 0


@pytest.mark.parametrize("least,weight", [(1, 0.25), (2, 0.25), (4, 0.6)])
def test_scores_equal_brute_force(spark, docs, least, weight):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    single, pairs, starts = Counter(), Counter(), 0
    for doc_id, text in TEXTS:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 != 2:
            w = ["\r", *words(text), "\n"]
            single.update(w[1:])
            pairs.update(zip(w, w[1:]))
            starts += 1
    n, v = sum(single.values()), len(single)

    def log_p(before, w):
        context = starts if before == "\r" else single[before]
        joint = min(2 ** int(math.log2(pairs[before, w])) if pairs[before, w] >= least else 0, context, single[w])
        share = weight if context else 0
        return math.log10(share * joint / max(context, 1) + (1 - share) * (single[w] + 1) / (n + v + 1))

    texts = dict(TEXTS)
    # One part, and passes over several of one segment each.
    for options in ({}, {"segment_bits": 1 << 14, "part_bytes": (1 << 14) // 8}):
        got = rows_of(lm.score_texts(docs, held, weight=weight, least=least, **options))
        assert len(got) == len(TEXTS)
        for r in got:
            w = ["\r", *words(texts[r["doc_id"]]), "\n"]
            assert r["score"] == pytest.approx(sum(map(log_p, w, w[1:])))


def test_bigrams_seen_once_are_held(spark):
    """A held-out copy of a training text scores above the same words in another order."""
    words_ = [f"word{k}" for k in range(40)]
    df = spark.createDataFrame([(1, " ".join(words_)), (2, " ".join(words_)), (3, " ".join(words_[::-1]))],
                               "doc_id long, text string")
    got = {r["doc_id"]: r for r in rows_of(lm.score_texts(df, F.col("doc_id") > 1))}
    assert got[2]["base_score"] == pytest.approx(got[3]["base_score"])
    assert got[2]["score"] == pytest.approx(got[1]["score"]) and got[2]["score"] > got[3]["score"] + 10


def test_words_after_a_word_share_its_count():
    """At the designed load the counts of all words after a word hardly exceed that word's own."""
    import pandas as pd
    rng = np.random.default_rng(12)
    words_, size = rng.integers(0, 2**63, 4000, dtype=np.uint64), 400_000
    text = rng.zipf(1.2, size) % 4000
    pairs, counts = np.unique(text[:-1] * 4000 + text[1:], return_counts=True)
    hashes = lambda x: lm._keys(lm.mix(words_[x // 4000] * np.uint64(0x9E3779B97F4A7C15) + words_[x % 4000]))
    order = np.argsort(hashes(pairs))
    bits = size * lm.BITS_PER_TOKEN
    filled = lm._fill_segment(pd.DataFrame({"segment": [0], "hashes": [packed.pack_sorted(hashes(pairs)[order], "<u4")],
                                            "counts": [packed.pack(counts[order], "<u4")]}), 2, bits)["bits"][0]
    single = np.bincount(text, minlength=4000)
    for v in rng.choice(np.flatnonzero(single), 60):
        after = np.arange(4000) + v * 4000
        joint = lm._counts_from(np.frombuffer(filled, np.uint8), hashes(after), np.zeros(4000, np.int64), 2, bits)
        assert np.minimum(joint, np.minimum(single[v], single)).sum() <= single[v]


def test_filter_counts_are_rounded_down():
    import pandas as pd
    hashes = np.sort(np.random.default_rng(6).integers(0, 2**63, 2000, dtype=np.uint64))
    counts = np.random.default_rng(7).integers(1, 300, 2000)
    bits = lm._fill_segment(pd.DataFrame({"segment": [0], "hashes": [packed.pack_sorted(np.sort(lm._keys(hashes)), "<u4")],
                                          "counts": [packed.pack(counts[np.argsort(lm._keys(hashes))], "<u4")]}))["bits"][0]
    found = lm._counts_from(np.frombuffer(bits, np.uint8), lm._keys(hashes), np.zeros(2000, np.int64))
    assert (found == 2.0 ** np.floor(np.log2(counts))).mean() > 0.999
    absent = np.random.default_rng(9).integers(0, 2**63, 5000, dtype=np.uint64)
    assert (lm._counts_from(np.frombuffer(bits, np.uint8), lm._keys(absent), np.zeros(5000, np.int64)) > 0).mean() < 0.01


def test_classifier_on_held_out_labels(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality.score_documents(docs.withColumn("score", F.lit("clash")), labels.where("doc_id % 2 = 0"))
    tested = rows_of(got.join(labels.where("doc_id % 2 = 1"), "doc_id").select("quality", "keep"))
    assert np.mean([r["quality"] == r["keep"] for r in tested]) > 0.97
    assert not [r for r in tested if r["quality"] == 1 and not r["keep"]]


def test_classifier_with_odd_rows_and_labels(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, None), (99, 0), (3, 1), (3, 1)], "doc_id long, quality int")
    got = rows_of(quality.score_documents(docs, labels))
    assert len(got) == len(TEXTS) and all(r["keep"] for r in got)  # one class: no evidence
    got = rows_of(quality.score_documents(docs, labels.limit(0)))
    assert len(got) == len(TEXTS) and all(r["keep"] for r in got)
    assert quality.score_documents(docs.limit(0), labels).count() == 0


def sites(spark):
    """Clean and spoilt texts by site: (documents, labels); texts numbered from 9000 on are of mixed quality."""
    pick = np.random.default_rng(12)
    plain = [f"{a}{b}" for a in ("river", "market", "paper", "winter", "garden") for b in ("", "s", "side")]

    def text(spoilt):
        """A share of the words is shouted or made of signs."""
        return ". ".join(" ".join(w if pick.random() > spoilt else pick.choice([w.upper() + "!!!", "$$$ ###", "BUY"])
                                  for w in pick.choice(plain, 9)) for _ in range(6))

    rows, labels = [], []
    for k in range(600):
        host, good = ("fine", k % 20 != 0) if k % 3 == 0 else ("foul", k % 20 == 1) if k % 3 == 1 else (f"wide{k % 11}", k % 2 == 0)
        rows.append((k, text(0.02 if good else 0.6), host, "xy"[k % 2]))
        if k % 2 == 0 or host.startswith("wide"):
            labels.append((k, int(good)))
    rows += [(9000 + k, text(0.05 + 0.0125 * k), "?", "x") for k in range(40)]
    names = "doc_id long, text string, source string, lang string"
    return rows, names, spark.createDataFrame(labels, "doc_id long, quality int")


def test_posteriors_equal_those_reckoned_by_hand(spark):
    rows, names, labels = sites(spark)
    rows += [(9100, None, None, None), (9101, "", None, "x"), (9102, rows[0][1], "once", None)]
    got = rows_of(quality.score_documents(spark.createDataFrame(rows, names), labels))
    assert len(got) == len(rows)
    p = np.array([r["p_text"] for r in got])
    host = np.array([str(r["source"]) for r in got])
    path = np.array([f"{r['source']} {r['lang']}" for r in got])
    known = [x.quality for x in labels.collect()]
    prior = (sum(known) + 0.5) / (len(known) + 1)

    def strength(names_of, centre):
        """Worth of the prior in documents, from the spread of site means that chance does not explain."""
        between = noise = 0.0
        for name in set(names_of):
            q = p[names_of == name]
            between += len(q) * (q.mean() - centre(name)) ** 2 / len(p)
            noise += len(q) * (q.var() / len(q)) / len(p)
        whole = p.mean()
        return min(max(whole * (1 - whole) / max(between - noise, 1e-9) - 1, 1.0), 1e6)

    of_host = {name: p[host == name].mean() for name in set(host)}
    strong_host = strength(host, lambda name: p.mean())
    strong_path = strength(path, lambda name: of_host[host[path == name][0]])
    logit = lambda x: math.log(x / (1 - x))
    for k, r in enumerate(got):
        others_host, others_path = host == host[k], path == path[k]
        h = (strong_host * p.mean() + p[others_host].sum() - p[k]) / (strong_host + others_host.sum() - 1)
        assert r["host_posterior"] == pytest.approx(h, rel=1e-9)
        q = (strong_path * h + p[others_path].sum() - p[k]) / (strong_path + others_path.sum() - 1)
        assert r["path_posterior"] == pytest.approx(q, rel=1e-9)
        score = 1 / (1 + math.exp(-(logit(p[k]) - logit(prior) + logit(q))))
        assert r["score"] == pytest.approx(score, rel=1e-9) and r["keep"] == (score >= 0.5)


def test_sites_change_decisions(spark):
    rows, names, labels = sites(spark)

    def kept(host):
        placed = [(i, t, host if h == "?" else h, path) for i, t, h, path in rows]
        got = rows_of(quality.score_documents(spark.createDataFrame(placed, names), labels))
        doubtful = {r["doc_id"]: r for r in got if r["doc_id"] >= 9000}
        return {i for i, r in doubtful.items() if r["keep"]}, got

    (fine, at_fine), (foul, _) = kept("fine"), kept("foul")
    # The same texts at another site: the good site's come through, none of the bad one's alone does.
    assert foul < fine and len(fine) - len(foul) >= 2
    # Sparse sites stay near the global share, large ones go their own way.
    standing = {r["source"]: r["host_posterior"] for r in at_fine}
    whole = np.mean([r["p_text"] for r in at_fine])
    assert standing["foul"] < whole < standing["fine"]
    lone = [(i, t, f"lone{i}" if h == "?" else h, path) for i, t, h, path in rows]
    got = rows_of(quality.score_documents(spark.createDataFrame(lone, names), labels))
    alone = [r["host_posterior"] for r in got if r["doc_id"] >= 9000]
    assert alone == pytest.approx([np.mean([r["p_text"] for r in got])] * 40)


def test_sample_of_labels_is_bounded(spark, small):
    """Fitted on fewer labelled rows than there are, the model judges much the same."""
    docs, labels = (spark.read.parquet(f"{small}/../sf0.01/{t}.parquet") for t in ("documents", "labels"))
    assert labels.count() > 300
    full, part = ({r["doc_id"]: r["keep"] for r in rows_of(quality.score_documents(docs, labels, sample_rows=n))}
                  for n in (50_000, 200))
    assert np.mean([full[i] == part[i] for i in full]) > 0.95


def test_main_text(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class='ad'>Buy, now.</div>"
            "<article><h1>A &amp; B</h1><p>First  line,<br>goes\non.<p>Second <b>bold</b> one.<!-- no --><script>x('</p>')</script>"
            "<form>Name</form><div class=comments>Reader, here.</div></article><footer>&copy; me</footer></body></html>")
    bare = ("<div id=menu><a>One</a> <a>Two</a></div><div id=main><h2>Head</h2><p>A long sentence, with commas, and an end.</p>"
            "<p>Another long sentence; it goes on.</p></div><div id=footer>small print</div>")
    rows = [(1, page), (2, bare), (3, ""), (4, None), (5, "<p></p>"), (6, "just text & more"), (1, page), (7, "<p>" + "long " * 50_000)]
    got = rows_of(html_text.extract(spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("clash"))))
    found = {r["page_id"]: r["text"] for r in got}
    assert found[1] == "A & B\n\nFirst line, goes on.\n\nSecond bold one."
    assert found[2] == "Head\n\nA long sentence, with commas, and an end.\n\nAnother long sentence; it goes on."
    assert (found[3], found[4], found[5], found[6]) == ("", "", "", "just text & more")
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got) and len(found[7]) == 249_999
