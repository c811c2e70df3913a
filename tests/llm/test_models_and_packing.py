"""Toxicity, fingerprints, packing, top-k search and the pipeline."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldlake.llm import fingerprints, flat, packing, topk, toxicity
from tests.llm.helpers import SF, repacked, with_clashes

SF_10K = "/root/testdata/sf0.1"


# -- toxicity ---------------------------------------------------------------

def test_toxicity_on_held_out_rows(spark):
    docs = spark.read.parquet(SF_10K + "/documents.parquet")
    labels = spark.read.parquet(SF_10K + "/labels.parquet")
    chain = toxicity.train(docs, with_clashes(labels.where("doc_id % 4 <> 0")))
    assert [c for c, *_ in chain] == list(toxicity.CATEGORIES)
    got = toxicity.score(with_clashes(docs), chain, ["doc_id"]).join(labels.where("doc_id % 4 = 0"), "doc_id")
    n = {(r.toxic, r.is_toxic): r["count"] for r in got.groupBy("toxic", "is_toxic").count().collect()}
    assert n[1, True] / (n[1, True] + n[1, False]) > 0.8
    assert n.get((0, True), 0) / (n[0, False] + n.get((0, True), 0)) < 0.01


def test_chain_uses_earlier_category():
    """The second category is the first one's probability; words alone don't show it."""
    rows = [{"doc_id": i, "quality": i % 2, "toxic": i % 2, "quality_at": [0] if i % 2 else [], "toxic_at": []} for i in range(400)]
    schema = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("toxic", pa.int32()), ("quality_at", pa.list_(pa.int32())), ("toxic_at", pa.list_(pa.int32()))])
    chain = toxicity.fit_chain(pa.Table.from_pylist(rows, schema), {"quality": np.array([5]), "toxic": np.zeros(0, np.int64)})
    model = chain[1][2]
    none = np.zeros(0, np.int64)
    p = model.probability(2, none, none, np.array([[0.95], [0.05]]))
    assert p[0] > 0.9 and p[1] < 0.1


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(i, ("idiot " if i % 2 else "kind ") + f"w{i} " * 5) for i in range(60)] + [(None, "idiot"), (900, None), (901, ""), (1, "idiot x")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (3, 1, 1), (902, 0, None)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(with_clashes(docs), with_clashes(labels))
    got = toxicity.score(docs, chain, ["doc_id"]).collect()
    assert len(got) == 64
    assert all(r.is_toxic == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.doc_id < 60)
    empty = toxicity.train(docs.limit(0), labels.limit(0))
    assert [r.is_toxic for r in toxicity.score(docs.limit(1), empty, ["doc_id"]).collect()] == [False]
    assert toxicity.score(docs.limit(0), chain, ["doc_id"]).count() == 0


def test_toxicity_of_a_small_or_rare_class(spark):
    """Words that a handful of toxic documents alone have are found in the
    smallest table, and chance words of a rare class are not chosen."""
    docs = spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text")
    words = ("idiot", "scum", "moron", "loser")
    planted = docs.orderBy("doc_id").limit(20).withColumn("doc_id", F.col("doc_id") + 10_000_000)
    planted = planted.withColumn("text", F.concat(F.lit(" ".join(words) + " "), F.substring("text", 1, 200)))
    clean = docs.orderBy("doc_id").limit(20).select((F.col("doc_id") + 20_000_000).alias("doc_id"), F.substring("text", 1, 200).alias("text"))
    chain = toxicity.train(docs, spark.read.parquet(SF + "/labels.parquet"))
    assert len(chain[1][1]) > 0
    p = {r.doc_id: r.p_toxic for r in toxicity.score(planted.unionByName(clean), chain, ["doc_id"]).collect()}
    pairs = [(p[d], p[d + 10_000_000]) for d in p if d < 20_000_000]
    assert len(pairs) == 20 and sum(x > y + 0.2 for x, y in pairs) >= 18

    r = random.Random(8)
    rows = [(i, " ".join(f"w{r.randrange(400)}" for _ in range(12)) + f" own{i}" + (" vile" if i < 9 and i % 3 else "")) for i in range(1500)]
    rare = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"),
                          spark.createDataFrame([(i, 1, int(i < 9)) for i in range(1500)], "doc_id long, quality int, toxic int"))
    found = next(flat.slices(pa.array(["vile"])))
    assert set(toxicity.features(found)[1]) <= set(rare[1][1]) and len(rare[1][1]) <= 6


# -- fingerprints -----------------------------------------------------------

def check_prints(rows, got):
    order = sorted(((d is None, -(d or 0), t is not None, t or "") for d, t in rows))
    texts = [x[3] for x in order]
    want = []
    for i, (none, d, _, t) in enumerate(order):
        cut = len(t) // 3
        want.append((None if none else -d, len(t), hashlib.sha256((t[:len(t) - cut] + texts[(i + 1) % len(texts)][:cut]).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_fingerprints_whole_table(spark):
    got = fingerprints.op8_fingerprints(spark, SF).collect()
    rows = [tuple(r) for r in spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text").collect()]
    check_prints(rows, got)
    by_text = collections.defaultdict(set)
    texts = dict(rows)
    for r in got:
        by_text[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert np.mean([r.near_edited for r in got]) > 0.4 > 0.1 > np.mean([r.near_next for r in got])


@pytest.mark.parametrize("per_range", [1, 2, 100])
def test_fingerprints_odd_rows(spark, per_range):
    rows = [(1, None), (None, "abc"), (None, None), (1, "zz"), (7, "hello world"), (7, "hello world"), (-3, "é" * 50), (12, "𝄞" * 9), (40, ""), (41, "x" * 3000)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    check_prints(rows, fingerprints.fingerprints(df, per_range).collect())
    assert fingerprints.fingerprints(df.limit(0)).count() == 0
    check_prints([(None, "abc"), (None, None)], fingerprints.fingerprints(df.where("doc_id IS NULL")).collect())
    assert [r.near_next for r in fingerprints.fingerprints(df.where("doc_id = 12")).collect()] == [1.0]


def test_longest_common_extension():
    r = random.Random(1)
    for _ in range(300):
        s, u = ("".join(r.choice("ab") for _ in range(r.randint(0, 60))) for _ in range(2))
        p, q = (fingerprints.Prefix(fingerprints.code_points(x)) for x in (s, u))
        i, j, n = r.randint(0, len(s)), r.randint(0, len(u)), 0
        while i + n < len(s) and j + n < len(u) and s[i + n] == u[j + n]:
            n += 1
        assert fingerprints.longest_common_extension(p, i, q, j) == n


def test_long_unrelated_texts_are_unlike():
    r = np.random.default_rng(2)
    a, b = (fingerprints.Fingerprint(r.integers(97, 123, 2_000_000).astype(np.uint32)) for _ in range(2))
    assert a.likeness(b) == 0 and (a.sketch >= 0).all()
    assert len(str(a).split(":")[2]) == fingerprints.BINS * fingerprints.BITS // 4


# -- packing ----------------------------------------------------------------

def test_chunked_encoding_equals_the_tokenizer():
    texts = ["a  b c \n d", "", "  lead and  double ", "x<|endoftext|> y <|endoftext|>", "tab\tb c\n\nd e", "\n", "a\xa0b　 c", "é à ñ", "don't it's 12 345 .. !!",
             "z" * 3000, " ", "a   b", "a\u0085 b", "x\x1c y", "ab\n cd\n\n ef", None]
    enc = packing.Encoder(packing.default_tokenizer())
    for _ in range(2):  # from scratch, and from what it has learnt
        got = []
        for t in flat.slices(pa.array(texts), 64):
            ids, counts = enc.encode(t)
            got += [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [enc.tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts]


def check_pieces(rows, tokens):
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc, pieces in by.items():
        ids, at = tokens[doc], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(np.array(ids[at:at + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    padding = 0
    for s in sequences.values():
        at = 0
        for p in sorted(s, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.CAPACITY
        padding += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    return padding


def test_packing_whole_table(spark):
    enc = packing.Encoder(packing.default_tokenizer()).tokenizer
    rows = spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text").collect()
    tokens = {r.doc_id: [*enc.encode(r.text, add_special_tokens=False).ids, 1] for r in rows}
    padding = check_pieces(packing.op9_pack(spark, SF).collect(), tokens)
    assert padding / sum(map(len, tokens.values())) < 0.02


def test_packing_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (None, "c " * 5000), (4, "é" * 7000)]
    df = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    enc = packing.Encoder(packing.default_tokenizer()).tokenizer
    tokens = {d: [*enc.encode(t or "", add_special_tokens=False).ids, 1] for d, t in rows}
    check_pieces(packing.pack(df).collect(), tokens)
    check_pieces(packing.pack(df, group_pieces=1).collect(), tokens)
    assert packing.pack(df.union(df)).count() == 2 * packing.pack(df).count()
    assert packing.pack(df.limit(0)).count() == 0


def test_first_fit_decreasing():
    r = random.Random(2)
    for _ in range(100):
        sizes = [r.randint(1, 20) for _ in range(r.randint(0, 60))]
        free, want = [], {}
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            b = next((b for b, f in enumerate(free) if f >= sizes[i]), None)
            if b is None:
                b = len(free)
                free.append(20)
            want[i] = (b, 20 - free[b])
            free[b] -= sizes[i]
        bins, offsets = packing.first_fit_decreasing(sizes, 20)
        assert {i: (b, o) for i, (b, o) in enumerate(zip(bins, offsets))} == want


# -- top-k ------------------------------------------------------------------

def best(rows, k, every=20):
    v = [(i, [int(np.floor(64 * y)) for y in x]) for i, x in rows
         if i is not None and x is not None and all(y is not None and np.isfinite(y) for y in x)]
    out = []
    for at, (i, q) in enumerate(v):
        if i % every == 0:
            s = [(min(topk._LIMIT, max(-topk._LIMIT, sum(a * b for a, b in zip(q, c)))), j) for n, (j, c) in enumerate(v) if n != at]
            out += [(i, n + 1, j, x) for n, (x, j) in enumerate(sorted(s, key=lambda p: (-p[0], p[1]))[:k])]
    return sorted(out)


def test_topk_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(SF + "/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert sorted(map(tuple, topk.op10_topk(spark, SF).collect())) == best(rows, topk.K)


def test_topk_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (20, [1.0, 2.0]), (40, None), (60, [nan, 1.0]), (80, [None, 1.0]), (None, [1.0, 1.0]), (1, [3.0, -2.0]),
            (2, [0.5]), (3, []), (4, [1e9, 1e9]), (100, [1e9, -3.0]), (5, [1e30, 1.0]), (-20, [-1.0, 0.25])] + [(7, [1.0, 1.0])] * 40
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))
    for k in (5, 1000):
        assert sorted(map(tuple, topk.search(df, k).collect())) == best(rows, k)
    assert topk.search(df.limit(0)).count() == 0


def test_topk_blocks_outlast_other_partitions(spark, monkeypatch):
    """A query's own row is masked whatever partitions the files of blocks are read in."""
    rows = [tuple(r) for r in spark.read.parquet(SF + "/embeddings.parquet").select("vec_id", "embedding").collect()]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    repacked(monkeypatch, spark, topk)
    try:
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
        got = sorted(tuple(r) for r in topk.search(df, 3).select("query_id", "rank", "vec_id", "score").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == best(rows, 3)


# -- pipeline ---------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(SF + "/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, with_clashes(docs), SF)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == columns
            counts.append(docs.count())
    assert counts[0] >= counts[1] > counts[2] == counts[3]
    assert docs.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert docs.where((F.col("offset") < 0) | (F.col("offset") + F.col("length") > packing.CAPACITY)).isEmpty()


def test_pipeline_odd_documents(spark, tmp_path):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c d e f", "en", None, 11), (3, "g " * 30, "en", "s", 60), (3, "g " * 30, "en", "s", 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, some, SF)
            some = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.ORACLE_SQL is None


def test_new_chunks_are_encoded_without_offsets_in_small_calls(monkeypatch):
    monkeypatch.setattr(packing, "LEARN_CHUNKS", 7, raising=False)
    enc = packing.Encoder(packing.default_tokenizer())
    plain, calls = enc.tokenizer, []

    class Fast:
        def encode_batch_fast(self, texts, **k):
            calls.append(len(texts))
            return plain.encode_batch_fast(texts, **k)

    enc.tokenizer = Fast()   # has no call that keeps offsets
    texts = ["", "one two\nthree " * 3, "é ß 漢字  tab\t<|endoftext|> it's", *(f"w{i} x{i * i}" for i in range(40))]
    t, = flat.slices(pa.chunked_array([pa.array(texts)]))
    ids, counts = enc.encode(t)
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == [len(x) for x in want]
    assert max(calls) == 7 and sum(calls) > 60


def test_new_chunks_are_encoded_many_in_one_text():
    enc = packing.Encoder(packing.default_tokenizer())
    plain, calls = enc.tokenizer, []

    class Fast:
        def encode_batch_fast(self, texts, **k):
            calls.append(len(texts))
            return plain.encode_batch_fast(texts, **k)

    enc.tokenizer = Fast()
    r = random.Random(3)
    word = lambda: "".join(r.choices("abeé日🙂.,'1<|>\n\t ", k=r.randint(1, 9)))
    texts = ["".join(r.choice([" ", "\n", "  ", " <|endoftext|> "]) + word() for _ in range(300)) for _ in range(12)]
    texts += [f"n{i} " + " ".join(f"w{i * 50 + k}" for k in range(50)) for i in range(40)] + ["wide\xa0x y " * 9, " ends in blank ", ""]
    want = [plain.encode(x, add_special_tokens=False).ids for x in texts]
    for size in (500, 1 << 20):
        enc.forget()
        calls.clear()
        for t in flat.slices(pa.array(texts), size):
            ids, counts = enc.encode(t)
            of = [want[i] for i in t.rows]
            assert ids.tolist() == [i for x in of for i in x] and counts.tolist() == [len(x) for x in of]
    # more than 4,000 distinct chunks; those that begin a text, or end one in white space, stand alone
    assert sum(calls) < 4000 / packing.JOINED + 100


def test_a_tokenizer_whose_tokens_do_not_show_their_bytes_is_asked_chunk_by_chunk(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers
    words = [f"w{i}" for i in range(300)]
    made = Tokenizer(models.WordLevel({"?": 0, **{w: i + 1 for i, w in enumerate(words[:200])}}, unk_token="?"))
    made.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    made.save(str(tmp_path / "words.json"))
    enc = packing.Encoder(str(tmp_path / "words.json"))
    t, = flat.slices(pa.array([" ".join(words)]))
    ids, counts = enc.encode(t)
    assert ids.tolist() == [*range(1, 201), *[0] * 100] and counts.tolist() == [300]
