"""Substring and suffix deduplication against brute force."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fieldlake.llm import flat, substrings, suffixes
from tests.llm.helpers import SF, with_clashes


def by_words(rows, window=20):
    rank = lambda d: (d is None, d or 0)
    first, out = {}, []
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    for (d, _), w in zip(rows, split):
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            first[k] = min(first.get(k, rank(d)), rank(d))
    for (d, _), w in zip(rows, split):
        gone, seen = [False] * len(w), set()
        for s in range(len(w) - window + 1):
            k = tuple(w[s:s + window])
            if first[k] < rank(d) or k in seen:
                gone[s:s + window] = [True] * window
            seen.add(k)
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def by_bytes(rows, length):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = collections.Counter(t[i:i + length] for _, t in texts for i in range(len(t) - length + 1))
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def words_of(df):
    cols = ("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    return sorted(map(tuple, substrings.deduplicate(df).select(*cols).collect()), key=repr)


def bytes_of(df, length, gram, frequent=suffixes.FREQUENT):
    cols = ("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))
    return sorted(map(tuple, suffixes.deduplicate(df, length, gram, frequent=frequent).select(*cols).collect()), key=repr)


def test_substrings_odd_rows(spark):
    r = random.Random(5)
    text = lambda n, k=3: " ".join(r.choice("abcdef"[:k]) for _ in range(n))
    p, q = text(40, 6), text(25, 6)
    rows = [(5, None), (6, ""), (7, "a " * 100), (8, "a " * 100), (9, p), (3, text(30) + " " + p + " " + text(30)), (2, p[2:] + " " + q),
            (11, q + " " + q), (11, q + " " + q), (None, p), (None, q + " x"), (12, text(19)), (13, text(300, 2)), (14, text(300, 2)),
            (-4, text(60, 1)), (2, "zz " + q), (15, "é " * 25), (16, "x" * 5000 + " " + "é\t" * 25)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert words_of(df) == by_words(rows)
    assert words_of(df.limit(0)) == []
    factors = {x.doc_id: x.factors for x in substrings.deduplicate(df).collect()}
    assert factors[9] and all(f.source in (2, 3) for f in factors[9])


def test_substrings_whole_table(spark):
    got = sorted(map(tuple, substrings.op6_substring_dedup(spark, SF).collect()), key=repr)
    assert got == by_words([tuple(x) for x in spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text").collect()])


def test_substrings_very_frequent_window_across_blocks(spark):
    shared = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"a{i} " + shared + f" z{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert words_of(df) == by_words(rows)


@pytest.mark.parametrize("seed,length,gram", [(1, 30, 8), (2, 12, 5), (3, 12, 12)])
def test_suffixes_odd_rows(spark, seed, length, gram):
    r = random.Random(seed)
    text = lambda n, k=3: "".join(r.choice("abcdé"[:k]) for _ in range(n))
    p = text(60, 5)
    rows = [(1, None), (2, ""), (None, p), (3, text(50) + p + text(50)), (4, p[5:] + p[3:50]), (5, "ab" * 70), (6, "x" + "ab" * 40),
            (7, text(400, 2)), (8, text(400, 2)), (9, p), (9, p), (10, text(30, 5)), (11, p[:29]), (12, "é" * 50)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    for frequent in (suffixes.FREQUENT, 4, 2):  # few, many and all repeated grams go by the windows' hashes
        assert bytes_of(df, length, gram, frequent) == by_bytes(rows, length)
    assert bytes_of(df.limit(0), length, gram) == []


def test_suffixes_whole_table(spark):
    got = sorted(map(tuple, suffixes.op7_suffix_dedup(spark, SF).collect()), key=repr)
    assert got == by_bytes([tuple(x) for x in spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text").collect()], 400)


def test_kept_text_has_whole_characters(spark):
    p = "é" * 30
    rows = [(1, "ü" + p), (2, "ö" + p + "x"), (3, None)]
    got = {x.doc_id: x.kept_text for x in suffixes.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"), 21, 6).collect()}
    assert got[3] is None and set(got[1] + got[2]) <= set("üöx")


def test_loser_tree_merge():
    r = random.Random(8)
    for _ in range(200):
        runs = [sorted(bytes(r.choice(b"ab\0") for _ in range(r.randint(0, 8))) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 9))]
        coded = [suffixes.front_decode(**suffixes.front_code(x)) for x in runs]
        assert [s for _, s in coded] == runs
        order, common = suffixes.merge(coded)
        merged = [runs[a][b] for a, b in order]
        assert merged == sorted(s for x in runs for s in x)
        assert common[1:] == [suffixes.common_prefix(a, b) for a, b in zip(merged, merged[1:])]


def test_workers_make_python_objects_of_few_rows_at_a_time_and_give_memory_back(monkeypatch):
    import pyarrow as pa
    given = []
    monkeypatch.setattr(flat, "give_back", lambda: given.append(1))
    texts = [f"{i} " * 500 for i in range(50)]
    b = pa.RecordBatch.from_pydict({"doc_id": range(50), "text": texts, "found": [[{"start": 0, "end": i}] for i in range(50)]})
    parts = list(flat.small(iter([b, b.slice(0, 0)]), 5000))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([b])) and max(p.num_rows for p in parts) < 6
    monkeypatch.setattr(flat.small, "__defaults__", (5000,))
    out = list(flat.tidy(suffixes._cut)(iter([b])))
    assert given and len(out) > 9
    assert [x for o in out for x in o.column("kept").to_pylist()] == [t.encode()[i:] for i, t in enumerate(texts)]
    given.clear()
    assert suffixes._match(40, 20)(pa.table({n: [] for n in suffixes._RUN.names}, schema=suffixes._RUN)).num_rows == 0 and given
