"""Toxicity by classifier chains.

One linear model a category, in a fixed order; each later model also sees the
earlier categories' probabilities.  While training, those come from models
that did not see the row (out-of-fold), so the later model learns how far the
earlier ones can be trusted.

Features are hashed lower-case words and word beginnings of 5 to 8 bytes of
the whole text.  They are chosen, and the models fitted, on at most
``train_rows`` labelled documents (those of the smallest seeded digest); every
document is scored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat
from fieldlake.llm.common import stored, table

CATEGORIES = ("quality", "toxic")
TRAIN_ROWS = 20_000
FOLDS = 5
BITS = 20            # features are hashed to 2**BITS
SEED = "tox-1"

_BREAK = np.ones(256, bool)  # all ASCII but letters and digits
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def features(t: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of a slice, sorted by document."""
    low = flat.Texts(np.concatenate([_FOLD[t.data[:-8]], t.data[-8:]]), t.offsets, t.rows)
    w = flat.Words(low, _BREAK)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    view = np.ndarray((len(low.data) - 7,), "<u8", low.data, strides=(1,))
    head, size = view[w.start], w.end - w.start
    keys, docs = [w.hashes(low)], [w.doc]
    for n in (5, 6, 7, 8):
        longer = np.flatnonzero(size > n)
        keys.append(flat.mix((head[longer] & flat.MASK[n]) ^ np.uint64(n << 58)))
        docs.append(w.doc[longer])
    key = np.concatenate(keys) >> np.uint64(64 - BITS)
    pair = np.unique((np.concatenate(docs).astype(np.uint64) << np.uint64(BITS)) | key)
    return (pair >> np.uint64(BITS)).astype(np.int64), (pair & np.uint64((1 << BITS) - 1)).astype(np.int64)


def training_sample(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, train_rows: int = TRAIN_ROWS,
                    seed: str = SEED) -> DataFrame:
    """(doc_id, text, categories): at most ``train_rows`` labelled documents."""
    order = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")))
    chosen = (labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id"))
              .agg(*[F.max(c).cast("int").alias(c) for c in categories])
              .orderBy(order, "doc_id").limit(train_rows))
    texts = docs.select(F.col("doc_id").alias("_d"), "text")
    # bounded by train_rows rows of a few integers
    return (texts.join(F.broadcast(chosen), F.col("_d") == F.col("doc_id"))
            .groupBy("doc_id", *categories).agg(F.min("text").alias("text")))


def _feature_counts(categories):
    def run(batches):
        for b in batches:
            y = np.stack([b.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in categories])
            for t in flat.slices(b.column("text")):
                doc, key = features(t)
                found, inv = np.unique(key, return_inverse=True)
                out = {"key": found.astype(np.int32)}
                for i, c in enumerate(categories):
                    of = y[i, t.rows.start + doc]
                    out[f"{c}_1"] = np.bincount(inv, of == 1, len(found)).astype(np.int64)
                    out[f"{c}_0"] = np.bincount(inv, of == 0, len(found)).astype(np.int64)
                yield pa.RecordBatch.from_pydict(out)
    return flat.tidy(run)


def _g(k1, k0, n1, n0, term):
    """G statistic of a feature in k1 of n1 and k0 of n0 documents; ``term(o, e)`` is o * log(o / e)."""
    n, k = n1 + n0, k1 + k0
    return 2 * (term(k1, k * (n1 / n)) + term(k0, k * (n0 / n)) + term(n1 - k1, (n - k) * (n1 / n)) + term(n0 - k0, (n - k) * (n0 / n)))


def _least_g(totals: np.ndarray, features: np.ndarray, n1: int, n0: int) -> float:
    """The G that about one feature reaches by chance, where ``features``
    features occur in ``totals`` documents each: 2 * log of how many can reach
    it at all, that is, would if all their documents were of one class."""
    def term(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1) / np.maximum(e, 1e-300)), 0)

    in_1, in_0 = np.minimum(totals, n1), np.minimum(totals, n0)
    most = np.maximum(_g(in_1, totals - in_1, n1, n0, term), _g(totals - in_0, in_0, n1, n0, term))
    order = np.argsort(-most)
    least = 2 * np.log(np.cumsum(features[order]))
    reached = np.flatnonzero(most[order] >= least)
    return float(least[reached[-1]]) if len(reached) else np.inf


def choose_features(sample: DataFrame, categories=CATEGORIES) -> dict[str, np.ndarray]:
    """For each category the features whose share of documents differs most
    between its two classes, by a G test.  A feature may be as rare as it
    likes: what it must reach follows from the classes' sizes and the number
    of features."""
    totals = sample.agg(*[F.count_if(F.col(c) == v).alias(f"{c}_{v}") for c in categories for v in (0, 1)]).first()
    names = [f"{c}_{v}" for c in categories for v in (1, 0)]
    counts = (sample.select("text", *categories)
              .mapInArrow(_feature_counts(categories), "key int, " + ", ".join(f"{n} long" for n in names))
              .groupBy("key").agg(*[F.sum(n).alias(n) for n in names]))
    counts = stored(counts, "tox-counts")
    chosen = {}
    for c in categories:
        n1, n0 = totals[f"{c}_1"], totals[f"{c}_0"]
        if not n1 or not n0:
            chosen[c] = np.zeros(0, np.int64)
            continue
        k1, k0 = F.col(f"{c}_1"), F.col(f"{c}_0")
        seen = counts.where(k1 + k0 > 0)
        # at most train_rows different totals
        of = np.array([tuple(r) for r in seen.groupBy((k1 + k0).alias("total")).count().collect()], np.int64).reshape(-1, 2)
        g = _g(k1, k0, n1, n0, lambda o, e: F.when(o > 0, o * F.ln(o / e)).otherwise(0.0))
        best = seen.where(g >= _least_g(of[:, 0], of[:, 1], n1, n0)).select("key").toArrow()  # 2**BITS at most
        chosen[c] = np.sort(best.column("key").to_numpy().astype(np.int64))
    return chosen


def _present(chosen: np.ndarray, doc: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The (document, place among the chosen) pairs that occur."""
    if not len(chosen):
        return doc[:0], key[:0]
    at = np.minimum(np.searchsorted(chosen, key), len(chosen) - 1)
    hit = chosen[at] == key
    return doc[hit], at[hit]


def _sample_rows(chosen, categories):
    def run(batches):
        for b in batches:
            for t in flat.slices(b.column("text")):
                doc, key = features(t)
                out = {c: b.column(c).slice(t.rows.start, len(t)) for c in ["doc_id", *categories]}
                for c in categories:
                    row, at = _present(chosen[c], doc, key)
                    ends = np.searchsorted(row, np.arange(len(t) + 1))
                    out[f"{c}_at"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_pydict(out)
    return flat.tidy(run)


class Linear:
    """Logistic regression on present features and a few dense columns."""

    def __init__(self, weights: np.ndarray, dense: np.ndarray, bias: float):
        self.weights, self.dense, self.bias = weights, dense, bias

    def margin(self, n: int, row: np.ndarray, at: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return self.bias + np.bincount(row, self.weights[at], n) + dense @ self.dense

    def probability(self, *x) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(*x), -40, 40)))

    @classmethod
    def fit(cls, n, row, at, dense, y, features: int, ridge: float = 2e-5, steps: int = 150) -> "Linear":
        """Adam on the mean log loss with a ridge penalty."""
        theta = np.zeros(features + dense.shape[1] + 1)
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        theta[-1] = np.log(p / (1 - p))
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, steps + 1):
            model = cls(theta[:features], theta[features:-1], theta[-1])
            err = (model.probability(n, row, at, dense) - y) / n
            g = np.concatenate([np.bincount(at, err[row], features), dense.T @ err, [err.sum()]])
            g[:-1] += ridge * theta[:-1]
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            theta = theta - 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-9)
        return cls(theta[:features], theta[features:-1], theta[-1])


def fit_chain(sample: pa.Table, chosen: dict[str, np.ndarray], categories=CATEGORIES, folds: int = FOLDS) -> list:
    """[(category, chosen features, model or None, threshold)].  A category
    without both classes in the sample has no model: probability 0."""
    sample = sample.sort_by("doc_id").combine_chunks()
    ids = sample.column("doc_id").to_numpy().astype(np.uint64)
    fold = flat.mix(ids) % np.uint64(folds)
    earlier, chain = np.zeros((len(ids), 0)), []
    for c in categories:
        y = sample.column(c).fill_null(-1).to_numpy().astype(np.int64)
        lists = sample.column(f"{c}_at").combine_chunks()
        row = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        at = lists.flatten().to_numpy().astype(np.int64)

        def part(use):
            place = np.cumsum(use) - 1
            keep = use[row]
            return int(use.sum()), place[row[keep]], at[keep], earlier[use]

        fit = lambda use: Linear.fit(*part(use), y[use].astype(float), len(chosen[c]))  # noqa: E731, B023
        known = y >= 0
        if len(set(y[known])) < 2:
            chain.append((c, chosen[c], None, 0.5))
            earlier = np.column_stack([earlier, np.zeros(len(ids))])
            continue
        out_of_fold = np.zeros(len(ids))
        for k in range(folds):
            train, held = known & (fold != k), fold == k
            if held.any():
                out_of_fold[held] = fit(train).probability(*part(held)) if len(set(y[train])) == 2 else y[known].mean()
        cuts = np.linspace(0.4, 0.8, 17)
        f1 = [2 * (hit := ((out_of_fold >= t) & (y == 1)).sum()) / max(1, 2 * hit + (known & ((out_of_fold >= t) != (y == 1))).sum())
              for t in cuts]
        chain.append((c, chosen[c], fit(known), float(cuts[int(np.argmax(f1))])))
        earlier = np.column_stack([earlier, out_of_fold])
    return chain


def train(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, train_rows: int = TRAIN_ROWS) -> list:
    """Fit the chain.  What reaches the driver, as Arrow, is bounded by
    ``train_rows`` rows of chosen features and 2**BITS features a category."""
    sample = stored(training_sample(docs, labels, categories, train_rows), "tox-sample")
    chosen = choose_features(sample, categories)
    schema = "doc_id long, " + ", ".join(f"{c} int" for c in categories) + "".join(f", {c}_at array<int>" for c in categories)
    rows = sample.mapInArrow(_sample_rows(chosen, categories), schema).toArrow()
    return fit_chain(rows, chosen, categories)


def _score(chain, keep: list[str]):
    def run(batches):
        for b in batches:
            for t in flat.slices(b.column("text")):
                doc, key = features(t)
                out = {c: b.column(c).slice(t.rows.start, len(t)) for c in keep}
                earlier = np.zeros((len(t), 0))
                for c, chosen, model, threshold in chain:
                    row, at = _present(chosen, doc, key)
                    p = model.probability(len(t), row, at, earlier) if model else np.zeros(len(t))
                    earlier = np.column_stack([earlier, p])
                    out["p_" + c], out["is_" + c] = p, p >= threshold
                yield pa.RecordBatch.from_pydict(out)
    return flat.tidy(run)


def score(docs: DataFrame, chain: list, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with p_<category> and is_<category> of each row.

    A null or empty text has no features and gets the models' base rates;
    repeated rows score alike; an empty table gives no rows."""
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    schema = ", ".join(kept + [f"p_{c} double, is_{c} boolean" for c, *_ in chain])
    names = list(dict.fromkeys([*keep, "text"]))
    return docs.select(*names).mapInArrow(_score(chain, keep), schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    chain = train(docs, table(spark, sf_dir, "labels", "doc_id", *CATEGORIES))
    return score(docs, chain, ["doc_id"]).select("doc_id", "p_quality", "p_toxic", F.col("is_toxic").alias("toxic"))
