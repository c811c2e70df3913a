"""ProbMinHash, its verification and the classes, against brute force."""

import collections
import random
import re

import numpy as np
import pyarrow as pa

from fieldlake.llm import flat, neardup
from fieldlake.llm.components import components
from tests.llm.helpers import SF, repacked, with_clashes


def weighted(text, k=neardup.WORDS):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(w) < k:
        return collections.Counter([tuple(w)] if w else [])
    return collections.Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def similarity(x, y):
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in set(x) | set(y)) for d in x if d in y)


def class_of(rows, threshold=neardup.THRESHOLD):
    """Classes by comparing all pairs that share a shingle."""
    sets, up = [weighted(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    having = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for e in s:
            having[e].append(i)
    pairs = {(a, b) for ids in having.values() if len(ids) < 400 for n, b in enumerate(ids) for a in ids[:n]}
    for a, b in pairs:
        if similarity(sets[a], sets[b]) >= threshold:
            up[top(b)] = top(a)
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[top(i)].append(rows[i][0])
    smallest = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return sorted(((rows[i][0], smallest[top(i)]) for i in range(len(rows))), key=repr)


def text(r, n, k=26):
    return " ".join(r.choice("abcdefghijklmnopqrstuvwxyz"[:k]) + r.choice("abcdef") for _ in range(n))


def test_registers_estimate_probability_jaccard():
    r = random.Random(3)
    a = text(r, 300)
    b = a.split()
    b[50:53], b[200] = ["new"] * 3, "other"
    texts = [a, " ".join(b), "one two", "", None, "é " * 9]
    t = next(flat.slices(pa.array(texts)))
    doc, element, count = neardup.shingles(t)
    sign = neardup.prob_min_hash(len(t), doc, element, count.astype(float), 4096)
    true = similarity(weighted(texts[0]), weighted(texts[1]))
    assert abs((sign[0] == sign[1]).mean() - true) < 0.03
    assert [int((doc == i).sum()) for i in range(6)] == [len(weighted(x)) for x in texts]
    assert not sign[3].any() and not sign[4].any()
    of = lambda i: (np.zeros(int((doc == i).sum()), np.int64), element[doc == i], count[doc == i])
    assert abs(neardup.prob_jaccard(1, of(0), of(1))[0] - true) < 1e-9


def test_prob_jaccard_of_weighted_sets():
    r = random.Random(4)
    for _ in range(100):
        x, y = ({d: r.randint(1, 4) for d in r.sample(range(12), r.randint(1, 10))} for _ in range(2))
        flat_of = lambda s: (np.zeros(len(s), np.int64), np.array(sorted(s), np.uint64), np.array([s[k] for k in sorted(s)]))
        got = neardup.prob_jaccard(1, flat_of(x), flat_of(y))[0]
        assert abs(got - similarity(collections.Counter(x), collections.Counter(y))) < 1e-9


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(map(tuple, neardup.op1_near_dedup(spark, SF).collect()), key=repr)
    assert got == class_of(rows)


def test_odd_rows_and_large_bucket(spark):
    """A group of near copies of which many are not links of each other, larger than ALL_PAIRS."""
    r = random.Random(6)
    base = text(r, 120).split()
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "a b c"), (4, "a b"), (4, "a b c"), (7, None)]
    for i in range(40):
        w = list(base)
        for _ in range(r.randint(1, 4)):
            w[r.randrange(120)] = f"n{i}"
        rows.append((100 + i, " ".join(w)))
    rows += [(200, rows[-1][1])] * 3
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = sorted(map(tuple, neardup.classes(df).collect()), key=repr)
    want = class_of(rows)
    empties = {1: 1, 2: 2, 7: 7}
    want = sorted(((d, empties.get(d, c)) for d, c in want), key=repr)
    assert got == want
    assert neardup.classes(df.limit(0)).count() == 0
    kept = neardup.keep_one(df).select("doc_id", "text").collect()
    # a row a class, and every row without words
    assert len(kept) == len({c for d, c in want if d not in empties}) + 3
    assert len(set(map(tuple, kept))) == len(kept)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (500, 400)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    groups = collections.defaultdict(set)
    for r in got:
        groups[r.label].add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 130)), [400, 500]]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_nodes_outlast_other_partitions(spark, monkeypatch):
    """Ids that stored tables share name the same text whatever partitions its file is read in."""
    rows = [tuple(r) for r in spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text").collect()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    repacked(monkeypatch, spark, neardup)
    try:
        got = sorted(map(tuple, neardup.op1_near_dedup(spark, SF).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == class_of(rows)


def test_spanning_forest_joins_what_all_links_join():
    r = np.random.default_rng(5)
    a, b = r.integers(0, 40, 900), r.integers(100, 160, 900)
    keep = neardup._spanning(a, b)
    assert len(keep) < 100 and set(a[keep]) == set(a) and set(b[keep]) == set(b)
    assert len(neardup._spanning(a[:0], b[:0])) == 0
    x, y = np.array([1, 1, 3, 2, 3]), np.array([2, 3, 2, 3, 9])
    assert len(neardup._spanning(x, y)) == 3


def test_a_text_is_compared_once_however_often_its_row_stands_there(spark, monkeypatch):
    words = [f"w{i}" for i in range(200)]
    near = " ".join(words[:100] + ["other"] + words[101:])
    docs = spark.createDataFrame([(1, " ".join(words)), (2, near), (None, "x " + near)] * 300, "doc_id long, text string")
    counts, plain = [], neardup.texts_of

    def counted(*args):
        out = plain(*args)
        counts.append((out.count(), out.select("node").distinct().count()))
        return out

    monkeypatch.setattr(neardup, "texts_of", counted)
    assert {tuple(r) for r in neardup.classes(docs).collect()} == {(1, 1), (2, 1), (None, 1)}
    assert counts and all(a == b <= 3 for a, b in counts)
    assert neardup.keep_one(docs).count() == 1


def test_a_slice_of_signatures_is_small_and_given_back(monkeypatch):
    assert neardup.SLICE <= flat.SLICE_BYTES
    given, sizes, shingles = [], [], neardup.shingles
    monkeypatch.setattr(flat, "give_back", lambda: given.append(1))
    monkeypatch.setattr(neardup, "SLICE", 50)
    monkeypatch.setattr(neardup, "shingles", lambda t, *a: sizes.append(int(t.offsets[-1])) or shingles(t, *a))
    texts = [f"one two three four five six {i}" for i in range(20)]
    b = pa.RecordBatch.from_pydict({"doc_id": range(20), "digest": [b"x"] * 20, "text": texts})
    got = [k for x in neardup._sign(2, 3, neardup.WORDS)(iter([b])) for k in x.column("bands").to_pylist()]
    assert given and max(sizes) <= 50
    monkeypatch.setattr(neardup, "SLICE", 1 << 20)
    assert got == [k for x in neardup._sign(2, 3, neardup.WORDS)(iter([b])) for k in x.column("bands").to_pylist()]
