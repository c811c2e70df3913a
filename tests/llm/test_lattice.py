"""Lattice likelihood: all segmentations listed by hand, base columns by SQL."""

import itertools
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldlake.llm import flat, lattice
from tests.llm.helpers import SF, duck, with_clashes

SMALL = lattice.Pieces([b" ", b" a", b" ab", b"a", b"ab", b"abab", b"b", b"ba", b"c" * 20, b"c", b"\xc3", b"\xa9", "é".encode()], np.arange(1.0, 14))


def segmentations(word, strings):
    if not word:
        yield []
    for i, s in enumerate(strings):
        if word.startswith(s):
            for rest in segmentations(word[len(s):], strings):
                yield [i, *rest]


def words(texts):
    return next(flat.slices(lattice.marked(pa.array(texts))))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcé", min_size=1, max_size=7), min_size=1, max_size=5))
def test_forward_and_expected_counts_equal_all_segmentations(texts):
    score = np.log(SMALL.first)
    net = lattice.Lattice(words(texts), SMALL)
    got, count = net.log_probability(score), np.arange(1, len(texts) + 1)
    expected = np.zeros(len(score))
    for text, p, n in zip(texts, got, count):
        paths = list(segmentations(b" " + text.encode(), SMALL.strings))
        weights = [math.exp(sum(score[i] for i in path)) for path in paths]
        assert math.isclose(math.exp(p), sum(weights), rel_tol=1e-9)
        for path, w in zip(paths, weights):
            for i in path:
                expected[i] += n * w / sum(weights)
    assert np.allclose(net.expected(score, count), expected)


def test_probabilities_of_all_texts_sum_to_one_at_most():
    """One-byte pieces and the end: texts of up to 6 bytes behind blanks."""
    v = lattice.Pieces([b" ", b"a", b" a", b"aa"], np.array([1.0, 2, 3, 4]))
    score = np.log(v.first * 0.9)
    total = 0.0
    for sizes in itertools.chain.from_iterable(itertools.product(range(1, 5), repeat=n) for n in range(4)):
        p = lattice.Lattice(words(["a" * s for s in sizes]), v).log_probability(score).sum() if sizes else 0.0
        total += math.exp(p) * 0.1
    assert 0.1 < total <= 1


def test_long_words_do_not_underflow():
    v = lattice.pieces(lattice.default_vocabulary())
    score = np.log(v.first)
    p = lattice.Lattice(words(["ab" * 20_000, "x", "日本" * 50]), v).log_probability(score)
    assert np.isfinite(p).all() and p[0] < -20_000


BASE_SQL = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS r, list_append(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), ' end') AS w FROM documents),
o AS (SELECT d.*, h.held_out, unnest(w) AS token FROM t d JOIN held h ON d.doc_id IS NOT DISTINCT FROM h.doc_id),
c AS (SELECT token, count(*) AS c FROM o WHERE NOT held_out GROUP BY 1),
k AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM c)
SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens, sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) AS base_score
FROM o LEFT JOIN c USING (token), k GROUP BY r, doc_id, held_out
"""


def check_base(got, docs, held):
    con = duck(documents=docs, held=held)
    want = sorted(((d, h, n, k, int(t), round(b, 6)) for d, h, n, k, t, b in con.sql(BASE_SQL).fetchall()), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == want
    assert all(r.score <= 0 and math.isfinite(r.score) for r in got)


def crc_held(docs):
    return docs.select("doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False)).alias("held_out")).distinct()


def test_whole_table(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text")
    got = lattice.op11_lattice_likelihood(spark, SF).collect()
    check_base(got, docs, crc_held(docs))
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 7 == 2) for r in got)
    # what was learned helps: much better than the vocabulary's own scores, also on held-out documents
    raw = {r.doc_id: r.score for r in lattice.likelihoods(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, rounds=0).collect()}
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.5 * sum(raw[r.doc_id] for r in held)


@pytest.mark.parametrize("block_bytes", [20, 8 << 20])
def test_odd_rows(spark, block_bytes):
    texts = [None, "", " \t\n\x0b\x0c\r ", "A a B", "a\xa0b é É 日本", "the the the", "z" * 5000, "w " * 50_000, "▁x x▁"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "the the the"), (5, "other"), (None, "a b"), (-7, "the A")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = F.col("doc_id") % 3 == 1
    got = lattice.likelihoods(with_clashes(docs), held, block_bytes=block_bytes).collect()
    check_base(got, docs, docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out")).distinct())
    alike = [r.score for r in got if r.doc_id == 5 and r.n_tokens == 4]
    assert len(alike) == 2 and alike[0] == alike[1]
    assert re.fullmatch("[a-z_]+", "_".join(got[0].asDict()))


def test_scores_are_those_of_the_words(spark):
    """A document's score is its words' and the end's, each word by every segmentation."""
    docs = spark.createDataFrame([(1, "ab abc ab"), (2, "abc q"), (3, "zz")], "doc_id long, text string")
    path = lattice.default_vocabulary()
    v = lattice.pieces(path)
    words_of = spark.createDataFrame([("ab", 2), ("abc", 2), ("q", 1), ("zz", 0)], "key string, train long")
    score = lattice.train(words_of, 2, path)
    assert math.isclose(np.exp(score).sum(), 1.0, rel_tol=1e-9)
    by_word = {}
    for w in ("ab", "abc", "q", "zz"):
        by_word[w] = math.log(sum(math.exp(sum(score[i] for i in p)) for p in segmentations(b" " + w.encode(), v.strings)))
    got = {r.doc_id: r.score for r in lattice.likelihoods(docs, F.col("doc_id") == 3).collect()}
    for doc_id, text in ((1, "ab abc ab"), (2, "abc q"), (3, "zz")):
        assert math.isclose(got[doc_id], (sum(by_word[w] for w in text.split()) + score[-1]) / math.log(10), rel_tol=1e-9)


def test_without_training_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lattice.likelihoods(docs, F.lit(True)).collect()}
    assert got[1].train_tokens == got[1].n_known == 0 and got[1].base_score == 0 and math.isfinite(got[1].score) and got[2].n_tokens == 1
    assert lattice.likelihoods(docs.limit(0), F.lit(True)).count() == 0
