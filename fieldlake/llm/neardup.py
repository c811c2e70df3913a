"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is a weighted set: its five-word shingles with their counts.  Each
element's points arrive as a Poisson process with the element's weight as its
rate, at times and in registers that depend on the element alone; a register
keeps the element that arrives first, and an element stops once it is later
than every register.  Two documents agree in a register with the probability
Jaccard of their weighted sets.  Registers are banded, documents that agree in
a band are compared, and a link is a pair whose probability Jaccard, computed
from the whole texts, reaches the threshold.  Classes are the connected
components of the links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat
from fieldlake.llm.common import stored, table
from fieldlake.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5      # misses a pair of similarity 0.8 with probability 5e-5
ALL_PAIRS = 8            # buckets of up to so many texts are compared in full at once
CLOSE = 1e-9             # rounding of a sum of reciprocals
LEFT_BLOCK, BLOCK = 128, 512   # texts of a block on either side
SLICE = flat.SLICE_BYTES   # 125 registers a text and all shingles of a slice lie in memory at once


def shingles(t: flat.Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, element, count), sorted by both; elements have 48 bits.
    A text of fewer words is one shingle of all of them."""
    w = flat.Words(t)
    windows = flat.Windows(w.hashes(t))
    grams = windows.all(words)
    inside = np.flatnonzero(w.doc[:len(grams)] == w.doc[words - 1:]) if len(grams) else np.zeros(0, np.int64)
    short = np.flatnonzero((w.count > 0) & (w.count < words))
    doc = np.concatenate([w.doc[inside], short])
    gram = np.concatenate([grams[inside], flat.mix(windows.at(w.first[short], w.count[short]) ^ flat.ODD)])
    key, count = np.unique((doc.astype(np.uint64) << np.uint64(48)) | (gram >> np.uint64(16)), return_counts=True)
    return (key >> np.uint64(48)).astype(np.int64), key & np.uint64((1 << 48) - 1), count


def prob_min_hash(n: int, doc: np.ndarray, element: np.ndarray, weight: np.ndarray, registers: int) -> np.ndarray:
    """The first element of each register for n documents; rows without elements stay 0."""
    first = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    time, turn = np.zeros(len(doc)), 0
    seed = flat.mix(element + flat.ODD)
    while len(doc):
        seed = flat.mix(seed + flat.ODD)   # one draw a turn: its high bits are the waiting time, another scramble the register
        time = time - np.log1p(-(seed >> np.uint64(11)).astype(np.float64) * 2.0 ** -53) / weight
        at = doc * registers + (flat.mix(seed ^ flat.ODD) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = first[at] == time
        winner[at[won]] = element[won]
        turn += 1
        here = np.unique(doc)
        latest = np.zeros(n)
        latest[here] = first.reshape(n, registers)[here].max(axis=1)
        on = time < latest[doc]
        doc, element, weight, time, seed = doc[on], element[on], weight[on], time[on], seed[on]
    return winner.reshape(n, registers)


def _sign(bands: int, rows: int, words: int):
    def run(batches):
        for b in batches:
            for t in flat.slices(b.column("text"), SLICE):
                doc, element, count = shingles(t, words)
                sign = prob_min_hash(len(t), doc, element, count.astype(np.float64), bands * rows)
                key = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * flat.ODD, (len(t), 1))
                for r in range(rows):
                    key = flat.mix(key ^ sign[:, r::rows])
                filled = np.zeros(len(t), bool)
                filled[doc] = True
                ends = np.concatenate([[0], np.cumsum(filled * bands)])
                yield pa.RecordBatch.from_arrays([
                    *(b.column(c).slice(t.rows.start, len(t)) for c in ("doc_id", "digest")),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key[filled].ravel().view(np.int64)))], ["doc_id", "digest", "bands"])
    return flat.tidy(run)


def prob_jaccard(n: int, a: tuple, b: tuple) -> np.ndarray:
    """Probability Jaccard of n pairs of weighted sets (pair, element, weight), each sorted by pair and element.

    The sum over shared d of 1 / sum over all e of max(a_e / a_d, b_e / b_d):
    the maximum is a's term for elements with a_e / b_e at least a_d / b_d and
    b's term for the others, so one sort by that ratio gives all inner sums."""
    key = [(p.astype(np.uint64) << np.uint64(48)) | e for p, e, _ in (a, b)]
    _, i, j = np.intersect1d(*key, assume_unique=True, return_indices=True)
    pair, x, y = a[0][i], a[2][i].astype(float), b[2][j].astype(float)
    order = np.lexsort((x / y, pair))
    pair, x, y = pair[order], x[order], y[order]
    total = lambda p, w: np.bincount(p, w, n)
    shared_x, shared_y = total(pair, x), total(pair, y)
    only_x, only_y = total(a[0], a[2]) - shared_x, total(b[0], b[2]) - shared_y
    start = np.searchsorted(pair, pair)
    before = lambda w: (c := np.concatenate([[0.0], np.cumsum(w)]))[:-1] - c[start]
    inner = (shared_x[pair] - before(x) + only_x[pair]) / x + (before(y) + only_y[pair]) / y
    return total(pair, 1 / inner)


def _verify(words: int, threshold: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a_at, b_at = batch.column("a"), batch.column("b")
            texts_a, texts_b = batch.column("text_a"), batch.column("text_b")
            for t in flat.slices(texts_a, SLICE // 2):
                # the other side in step, cut again where its texts are longer
                for u in flat.slices(texts_b.slice(t.rows.start, len(t)), SLICE // 2):
                    lo = u.rows.start
                    part = flat.Texts(t.data[t.offsets[lo]:t.offsets[lo + len(u)] + 8], t.offsets[lo:lo + len(u) + 1] - t.offsets[lo], u.rows)
                    s = prob_jaccard(len(u), shingles(_padded(part), words), shingles(u, words))
                    hit = pa.array(np.flatnonzero(s >= threshold - CLOSE) + t.rows.start + lo)
                    yield pa.RecordBatch.from_arrays([a_at.take(hit), b_at.take(hit)], ["a", "b"])
    return flat.tidy(run)


def _sets(words: int):
    def run(batches):
        for b in batches:
            for t in flat.slices(b.column("text"), SLICE):
                doc, element, count = shingles(t, words)
                cut = np.searchsorted(doc, np.arange(len(t) + 1)).tolist()
                yield pa.RecordBatch.from_arrays([
                    b.column("node").slice(t.rows.start, len(t)),
                    *(pa.array([x[i:j].tobytes() for i, j in zip(cut, cut[1:])], pa.binary()) for x in (element.astype("<u8"), count.astype("<u4")))],
                    ["node", "elements", "counts"])
    return flat.tidy(run)


def _sums(n: int, m: int, row_a, col_a, value_a, row_b, col_b, value_b, columns: int) -> np.ndarray:
    """Sums over shared columns of products: two sparse matrices multiplied, some dense columns at a time."""
    out = np.zeros((n, m))
    for first in range(0, columns, 4096):
        a, b = np.zeros((n, 4096), np.float32), np.zeros((m, 4096), np.float32)
        for dense, row, col, value in ((a, row_a, col_a, value_a), (b, row_b, col_b, value_b)):
            use = (col >= first) & (col < first + 4096)
            dense[row[use], col[use] - first] = value[use]
        out += a @ b.T
    return out


def _spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the edges (a, b) form a spanning forest; the others join what is joined already."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    n = max(1, len(names))
    edges, at = np.unique(ends[:len(a)] * n + ends[len(a):], return_index=True)
    up, keep = list(range(n)), []

    def top(i):
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    for edge, i in zip(edges.tolist(), at.tolist()):
        x, y = top(edge // n), top(edge % n)
        if x != y:
            up[x] = y
            keep.append(i)
    return np.array(keep, np.int64)


def _linked(threshold: float):
    """Links between texts of a bucket outside its largest component and texts
    of other components, as many as join the components that links join (a
    spanning forest of the block).  Sets without repeated shingles need only the sizes of
    their intersections; for the others the sum of sqrt(p q) bounds the
    probability Jaccard from above, and pairs it does not rule out are computed."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def columns(t: pa.Table):
        element = [np.frombuffer(x, "<u8") for x in t["elements"].to_pylist()]
        count = [np.frombuffer(x, "<u4") for x in t["counts"].to_pylist()]
        size = np.array([len(x) for x in element])
        total = np.array([x.sum() for x in count], float)
        row = np.repeat(np.arange(len(size)), size)
        return t["node"].to_numpy(), t["label"].to_numpy(), size, total, row, np.concatenate(element), np.concatenate(count)

    def run(left: pa.Table, members: pa.Table) -> pa.Table:
        if not left.num_rows or not members.num_rows:
            return schema.empty_table()
        a_node, a_label, a_size, a_total, a_row, a_el, a_n = columns(left)
        b_node, b_label, b_size, b_total, b_row, b_el, b_n = columns(members)
        shared = np.intersect1d(a_el, b_el)
        a_use, b_use = np.isin(a_el, shared), np.isin(b_el, shared)
        a_row_, a_col, b_row_, b_col = a_row[a_use], np.searchsorted(shared, a_el[a_use]), b_row[b_use], np.searchsorted(shared, b_el[b_use])
        shape = (len(a_size), len(b_size), a_row_, a_col)
        both = _sums(*shape, np.ones(len(a_col)), b_row_, b_col, np.ones(len(b_col)), len(shared))
        other = a_label[:, None] != b_label[None, :]
        plain = (a_size == a_total)[:, None] & (b_size == b_total)[None, :]
        x, y = np.nonzero(other & plain & (both >= (threshold - CLOSE) * (a_size[:, None] + b_size[None, :] - both)))
        out = [np.stack([x, y])]
        if not plain.all():
            near = _sums(*shape, np.sqrt(a_n[a_use] / a_total[a_row_]), b_row_, b_col, np.sqrt(b_n[b_use] / b_total[b_row_]), len(shared))
            x, y = np.nonzero(other & ~plain & (near >= threshold - 1e-4))
            a_at, b_at = np.cumsum(a_size) - a_size, np.cumsum(b_size) - b_size
            for i in range(0, len(x), 512):
                p, q = x[i:i + 512], y[i:i + 512]
                sides = []
                for at, size, el, n, of in ((a_at, a_size, a_el, a_n, p), (b_at, b_size, b_el, b_n, q)):
                    pair, k = flat.ragged(size[of])
                    place = at[of][pair] + k
                    sides.append((pair, el[place], n[place].astype(float)))
                hit = prob_jaccard(len(p), *sides) >= threshold - CLOSE
                out.append(np.stack([p[hit], q[hit]]))
        x, y = np.concatenate(out, axis=1)
        keep = _spanning(a_label[x], b_label[y])
        found = np.sort(np.stack([a_node[x[keep]], b_node[y[keep]]]), axis=0)
        return pa.table([pa.array(found[0]), pa.array(found[1])], schema=schema)
    return run


def left_over(members: DataFrame, labels: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links (a, b) that the first pairs missed: in each bucket of ``members``
    (key, node), every text outside the bucket's largest component is compared
    with every text of another component, in blocks of bounded size that emit
    links alone."""
    at = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    at = stored(at, "members")
    sizes = at.groupBy("key", "label").agg(F.count("*").alias("size"))
    mixed = stored(sizes.groupBy("key").agg(F.max_by("label", F.struct("size", "label")).alias("largest"), F.count("*").alias("parts"),
                                            F.sum("size").alias("all"), F.max("size").alias("most")).where("parts > 1"), "mixed")
    blocks = lambda n, size: F.ceil(n / F.lit(size)).cast("int")
    left_blocks, all_blocks = blocks(F.col("all") - F.col("most"), LEFT_BLOCK), blocks(F.col("all"), BLOCK)
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    here = stored(at.join(mixed, "key"), "here")
    sets = stored(texts_of(here.select("node").distinct(), docs, nodes).mapInArrow(_sets(words), "node long, elements binary, counts binary"), "sets")
    here = here.join(sets, "node")
    columns = ("key", "i", "j", "node", "label", "elements", "counts")
    left = (here.where("label <> largest").withColumn("i", F.pmod(F.xxhash64("node"), left_blocks).cast("int")).withColumn("j", each(all_blocks))
            .select(*columns).toDF(*columns))
    right = (here.withColumn("j", F.pmod(F.xxhash64("node"), all_blocks).cast("int")).withColumn("i", each(left_blocks))
             .select(*columns).toDF(*columns))
    return (left.groupBy("key", "i", "j").cogroup(right.groupBy("key", "i", "j"))
            .applyInArrow(_linked(threshold), "a long, b long").distinct())


def texts_of(needed: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the needed nodes, one row each: a row of documents may
    stand there many times."""
    where = nodes.join(needed, "node").select("node", F.col("rep").alias("_r"), F.col("digest").alias("_g"))
    return docs.join(where, F.col("doc_id").eqNullSafe(F.col("_r")) & (F.col("digest") == F.col("_g"))).select("node", "text").dropDuplicates(["node"])


def _padded(t: flat.Texts) -> flat.Texts:
    data = t.data.copy()
    data[-8:] = 0
    return flat.Texts(data, t.offsets, t.rows)


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes that are links.  Joins on node and document
    ids are plain ones, so Spark splits a node with very many partners."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    texts = stored(texts_of(needed, docs, nodes), "texts")
    of = lambda n: texts.select(F.col("node").alias(n), F.col("text").alias("text_" + n))
    return stored(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "text_a", "text_b")
                  .mapInArrow(_verify(words, threshold), "a long, b long").distinct(), "links")


def _classes(docs: DataFrame, words: int, threshold: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest, bands) of every row; (digest, rep, class_id, chosen) of
    every text with words, where one text of each class is chosen."""
    d = docs.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"), "text")
    signed = stored(d.mapInArrow(_sign(bands, rows, words), "doc_id long, digest binary, bands array<long>"), "signed")
    wordy = signed.where(F.size("bands") > 0)
    # the id is stored with its row: computed anew, it would follow how Spark packs the files into partitions
    nodes = stored(wordy.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
                   .withColumn("node", F.monotonically_increasing_id()), "nodes")
    postings = stored(nodes.select("node", F.explode("bands").alias("key")), "postings")
    buckets = stored(postings.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("lead")).where("n > 1"), "buckets")
    postings = stored(postings.join(buckets, "key"), "postings")
    few, many = postings.where(F.col("n") <= ALL_PAIRS), postings.where(F.col("n") > ALL_PAIRS)
    pairs = (few.select("key", F.col("node").alias("a")).join(few.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b")
             .unionByName(many.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))).distinct())
    links = verified(stored(pairs, "pairs"), d, nodes, words, threshold)
    more = stored(left_over(many.select("key", "node"), components(links), d, nodes, words, threshold), "links")
    links = links.unionByName(more)
    labels = components(links)
    named = nodes.select("digest", "rep", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    first = (named.groupBy("label").agg(F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node")).alias("first"))
             .select("label", F.col("first.rep").alias("class_id"), F.col("first.node").alias("first")))
    named = stored(named.join(first, "label").select("digest", "rep", "class_id", (F.col("node") == F.col("first")).alias("chosen")), "classes")
    return signed, named


def classes(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id) for every row of docs(doc_id, text).

    ``class_id`` is the smallest doc_id of the class.  Equal texts are one
    class before anything is compared.  A null text and one without words is
    a class of its own row; repeated rows get the same class; a null doc_id
    is never the smallest unless its class has no other; an empty table gives
    no rows.

    Within a band's bucket of more than ALL_PAIRS texts everything is compared
    with one text.  Where a bucket then holds several components, each of its
    texts outside the largest meets all texts of other components, so every
    link between two components of a bucket is found."""
    signed, named = _classes(docs, words, threshold, bands, rows)
    of_text = named.select(F.col("digest").alias("_g"), "class_id")
    return (signed.where(F.size("bands") > 0).join(of_text, F.col("digest") == F.col("_g")).select("doc_id", "class_id")
            .unionByName(signed.where(F.size("bands") == 0).select("doc_id", F.col("doc_id").alias("class_id"))))


def keep_one(docs: DataFrame, words: int = WORDS, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row of its text with
    the smallest doc_id, and every row without words."""
    _, named = _classes(docs, words, threshold, bands, rows)
    stay = named.where("chosen").select(F.col("digest").alias("_g"), F.col("rep").alias("_r"))
    digest = F.unhex(F.md5(F.coalesce("text", F.lit(""))))
    wordless = F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*\z")
    d = docs.withColumn("_digest", digest)
    kept = d.where(~wordless).join(stay, F.col("doc_id").eqNullSafe(F.col("_r")) & (F.col("_digest") == F.col("_g")))
    return (kept.dropDuplicates(["doc_id", "_digest"]).select(*docs.columns)
            .unionByName(docs.where(wordless)))


def op1_near_dedup(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents", "doc_id", "text"))
