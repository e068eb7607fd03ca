"""Quality of documents from a text classifier and the standing of their site.

A logistic model on features of the text says how good a document looks. Sites have standings of
their own: a host's share of good documents is shrunk towards the global share, a path's towards its
host's, each by a strength that the spread between sites calls for. Both levels are grouped sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.arrow_text import SMALL_SLICE_BYTES, slices, text_buffer, word_hashes, word_spans
from tallybook.llm.stage import stage
from tallybook.llm.workers import small_batches

FEATURES = ("log_words", "word_length", "upper", "digits", "other_ascii", "wide", "exclaimed",
            "marked_words", "lone_signs", "repeated", "distinct", "line_length", "stops")
# Labelled rows the model is fitted on at most; they are taken by the hash of their id.
SAMPLE_ROWS = 50_000
CLOSEST = 1e-6

_CLASS = np.zeros((256, 7), dtype=bool)
_CLASS[ord("A"):ord("Z") + 1, 0] = True
_CLASS[ord("0"):ord("9") + 1, 1] = True
for _code in b"!\"#$%&*+/<=>@[\\]^_`{|}~":
    _CLASS[_code, 2] = True
_CLASS[0x80:, 3] = True
_CLASS[ord("!"), 4] = True
_CLASS[0x0A, 5] = True
_CLASS[[ord(c) for c in ".?;"], 6] = True
_SIGN = _CLASS[:, 2] | _CLASS[:, 6] | np.isin(np.arange(256), np.frombuffer(b",:-'()", np.uint8))


def text_features(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty or null text has zeros."""
    data, limits = text_buffer(column)
    out = np.zeros((len(limits) - 1, len(FEATURES)))
    for first, last in slices(limits, SMALL_SLICE_BYTES):
        part = limits[first:last + 1]
        text = data[part[0]:part[-1]]
        edges = part - part[0]
        starts, ends, words = word_spans(text, edges)
        if not len(starts):
            continue
        size = np.maximum(np.diff(edges), 1)
        count = np.diff(words)
        per_word = np.maximum(count, 1)
        row = np.repeat(np.arange(last - first), count)

        def share(mask, whole):
            sums = np.concatenate([[0], np.cumsum(mask)])
            at = edges if len(mask) == len(text) else words
            return (sums[at[1:]] - sums[at[:-1]]) / whole

        hashes = word_hashes(text, starts, ends)
        same = np.zeros(len(starts), dtype=bool)
        same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        order = np.lexsort((hashes, row))
        fresh = np.ones(len(starts), dtype=bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[1:] != row[:-1])
        final = text[ends - 1]
        signs = np.concatenate([[0], np.cumsum(_SIGN[text])])
        lone = signs[ends] - signs[starts] == ends - starts
        marked = _CLASS[final, 2]
        lines = np.maximum(share(_CLASS[text, 5], 1), 1)
        out[first:last] = np.column_stack([
            np.log1p(count), np.minimum(size / per_word, 40), share(_CLASS[text, 0], size),
            share(_CLASS[text, 1], size), share(_CLASS[text, 2], size), share(_CLASS[text, 3], size),
            share(_CLASS[text, 4], size), share(marked, per_word), share(lone, per_word),
            share(same, per_word), share(fresh, per_word), np.log1p(count / lines), share(_CLASS[text, 6], per_word)])
        out[first:last][count == 0] = 0
    return out


@dataclass(frozen=True)
class Model:
    """Weights of the standardised features, the intercept last, and the sample's share of good rows."""

    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float

    def probability(self, features: Column) -> Column:
        """Chance of being good, kept off 0 and 1."""
        score = F.lit(self.weights[-1])
        for k, (mean, scale, weight) in enumerate(zip(self.mean, self.scale, self.weights)):
            score = score + (features[k] - F.lit(mean)) / F.lit(scale) * F.lit(weight)
        return F.greatest(F.lit(CLOSEST), F.least(F.lit(1 - CLOSEST), 1 / (1 + F.exp(-score))))


def fit(features: np.ndarray, good: np.ndarray, ridge: float = 1.0, steps: int = 40) -> Model:
    """Ridge-penalised logistic regression by Newton steps.

    Without rows of either class there is no evidence: the model then gives every text the same
    chance, one half if there are no rows at all.
    """
    width = len(FEATURES)
    prior = float((good.sum() + 0.5) / (len(good) + 1))
    if len(good) == 0 or good.min() == good.max():
        odds = float(np.log(prior / (1 - prior)))
        return Model((0.0,) * width, (1.0,) * width, (*(0.0,) * width, odds), prior)
    mean, scale = features.mean(axis=0), features.std(axis=0)
    scale[scale < 1e-9] = 1.0
    x = np.column_stack([(features - mean) / scale, np.ones(len(good))])
    penalty = np.full(width + 1, ridge)
    penalty[-1] = 1e-6
    w = np.zeros(width + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (good - p) - penalty * w)
        w += step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    return Model(*(tuple(map(float, v)) for v in (mean, scale, w)), prior)


def _strength(share: float, spread: float | None, noise: float | None) -> float:
    """Documents' worth of the prior: what a beta distribution with that spread between sites has."""
    between = max((spread or 0.0) - (noise or 0.0), 1e-9)
    return float(np.clip(share * (1 - share) / between - 1, 1.0, 1e6))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def score_documents(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text",
                    host: str = "source", path: str = "lang", label: str = "quality",
                    sample_rows: int = SAMPLE_ROWS, limit: float = 0.5) -> DataFrame:
    """Adds ``p_text``, ``host_posterior``, ``path_posterior``, ``score`` and ``keep`` to every row.

    The model is fitted on at most ``sample_rows`` labelled rows (those with the smallest hashes of
    their id). The query's hosts are sources and its paths languages; any two columns will do. A site's
    share is the mean of ``p_text`` without the row being judged. The score's odds are the text's odds
    times what the path's odds are above the sample's; ``keep`` is score >= ``limit``. Null or empty texts are judged by their (zero)
    features; a null host or path is a site of its own; labels that are null, or of unknown ids, count
    for nothing, and of several labels for an id the lowest counts. Without labels, or with one class
    only, every text looks alike and is kept. All rows and columns stay, columns of the five names are
    replaced; an empty table gives an empty one. Texts are read twice; the second pass joins a row per
    path and shuffles no text while those fit a broadcast.
    """
    df = df.drop("p_text", "host_posterior", "path_posterior", "score", "keep")

    @F.arrow_udf("array<double>")
    def features_of(texts: pa.Array) -> pa.Array:
        found = text_features(texts)
        limits = pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES))
        return pa.ListArray.from_arrays(limits, pa.array(found.ravel()))

    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(id_column).alias("__id")).agg(
        F.min(label).cast("double").alias("__label"))
    with small_batches(df.sparkSession):
        rows = stage(
            df.select(F.col(id_column).alias("__id"), F.col(host).alias("__host"), F.col(path).alias("__path"),
                      features_of(F.col(text)).alias("__features")).join(known, "__id", "left"), "quality-features")
    labelled = rows.where("__label IS NOT NULL")
    # A bound on the hash leaves somewhat more than the rows wanted, so that tasks send no more than these.
    share_wanted = (sample_rows + 6 * sample_rows**0.5) / max(labelled.count(), 1)
    drawn = labelled.withColumn("__hash", F.xxhash64("__id"))
    if share_wanted < 1:
        drawn = drawn.where(F.col("__hash") < F.lit(int(share_wanted * 2**64) - 2**63))
    sample = drawn.orderBy("__hash").limit(sample_rows).select("__features", "__label").toPandas()
    good = sample["__label"].to_numpy(dtype=float)
    model = fit(np.stack(sample["__features"]) if len(good) else np.zeros((0, len(FEATURES))), good)
    one_class = len(good) == 0 or good.min() == good.max()

    site = rows.select("__host", "__path", model.probability(F.col("__features")).alias("q"))
    paths = stage(site.groupBy("__host", "__path").agg(
        F.sum("q").alias("path_sum"), F.count("*").alias("path_n"), F.sum(F.col("q") * F.col("q")).alias("squares")), "paths")
    hosts = paths.groupBy("__host").agg(
        F.sum("path_sum").alias("host_sum"), F.sum("path_n").alias("host_n"), F.sum("squares").alias("squares"))
    whole = hosts.agg(F.sum("host_sum"), F.sum("host_n")).first()
    share = float(np.clip(whole[0] / whole[1], CLOSEST, 1 - CLOSEST)) if whole[1] else 0.5

    def spread(sites: DataFrame, total: str, n: str, centre: Column) -> float:
        """Prior strength from the variance between sites less what the rows' own variance explains."""
        mean = F.col(total) / F.col(n)
        inner = F.greatest(F.lit(0.0), F.col("squares") / F.col(n) - mean * mean) / F.col(n)
        found = sites.agg(F.sum(F.col(n) * (mean - centre) * (mean - centre)) / F.sum(n),
                          F.sum(F.col(n) * inner) / F.sum(n)).first()
        return _strength(share, found[0], found[1])

    host_strength = spread(hosts, "host_sum", "host_n", F.lit(share))
    by_host = paths.join(hosts.select(F.col("__host").alias("__h"), "host_sum", "host_n"),
                         F.col("__host").eqNullSafe(F.col("__h"))).drop("__h")
    path_strength = spread(by_host, "path_sum", "path_n", F.col("host_sum") / F.col("host_n"))
    sites = by_host.select(F.col("__host").alias("__h"), F.col("__path").alias("__p"),
                           "path_sum", "path_n", "host_sum", "host_n")

    judged = (
        df.withColumn("__features", features_of(F.col(text)))
        .withColumn("p_text", model.probability(F.col("__features"))).drop("__features")
        .join(sites, F.col(host).eqNullSafe(F.col("__h")) & F.col(path).eqNullSafe(F.col("__p")))
    )
    own = F.col("p_text")
    host_share = (F.lit(host_strength * share) + F.col("host_sum") - own) / (F.lit(host_strength) + F.col("host_n") - 1)
    judged = judged.withColumn("host_posterior", F.greatest(F.lit(CLOSEST), F.least(F.lit(1 - CLOSEST), host_share)))
    path_share = ((F.lit(path_strength) * F.col("host_posterior") + F.col("path_sum") - own)
                  / (F.lit(path_strength) + F.col("path_n") - 1))
    judged = judged.withColumn("path_posterior", F.greatest(F.lit(CLOSEST), F.least(F.lit(1 - CLOSEST), path_share)))
    odds = _logit(F.col("p_text")) - F.lit(float(np.log(model.prior / (1 - model.prior)))) + _logit(F.col("path_posterior"))
    keep = F.lit(True) if one_class else F.col("score") >= limit
    return (judged.withColumn("score", 1 / (1 + F.exp(-odds))).withColumn("keep", keep)
            .select(*df.columns, "p_text", "host_posterior", "path_posterior", "score", "keep"))
