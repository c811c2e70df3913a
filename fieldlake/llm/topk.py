"""Exact top-k inner-product search by distributed histogram selection.

Vectors are stored in blocks, query blocks meet candidate blocks in groups of
bounded size, and everything is scored.  Each pass sends only a histogram of
the scores: the global counts show which interval holds a query's k-th best
score, and the next pass refines that interval, until it is a single integer.
A last pass sends what reaches it, ties by smaller id, and a window ranks
those few rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.llm.common import stored, table

K = 20
EVERY = 20          # queries: ids divisible by it
SCALE = 64.0
BLOCK = 1024        # vectors of a candidate block
QUERY_BLOCK = 512
GROUP_BLOCKS = 8    # candidate blocks of a group
GROUP_QUERIES = 4   # query blocks of a group
BINS = 256
_LIMIT = 1 << 61

_BLOCK_SCHEMA = "ids binary, vectors binary, kind string, width int, norm double"


def _quantised(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and floor(SCALE * x) of the vectors that take part, shorter ones filled with zeros."""
    ids, column = batch.column("vec_id"), batch.column("embedding")
    keep = np.array(ids.is_valid()) & np.array(column.is_valid())
    column, ids = column.filter(pa.array(keep)), ids.filter(pa.array(keep))
    flat = column.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes nan
    sizes = np.array(column.value_lengths(), np.int64)
    n, width = len(column), int(sizes.max(initial=0))
    row = np.repeat(np.arange(n), sizes)
    dense = np.zeros((n, width))
    dense[row, np.arange(len(row)) - (np.cumsum(sizes) - sizes)[row]] = values
    fine = np.isfinite(dense).all(axis=1)
    with np.errstate(over="ignore"):
        dense = np.clip(np.floor(SCALE * dense[fine]), -2.0 ** 1000, 2.0 ** 1000)
    return np.array(ids, np.int64)[fine], dense


def _blob(ids: np.ndarray, dense: np.ndarray) -> dict:
    kind = next((k for k in ("<i2", "<i4") if not dense.size or np.abs(dense).max() <= np.iinfo(k).max), "<f8")
    return {"ids": ids.astype("<i8").tobytes(), "vectors": dense.astype(kind).tobytes(), "kind": kind, "width": dense.shape[1],
            "norm": float(np.sqrt(np.square(np.minimum(np.abs(dense), 1e150)).sum(axis=1)).max(initial=0.0))}


def _vectors(row: dict) -> np.ndarray:
    return np.frombuffer(row["vectors"], row["kind"]).reshape(-1, row["width"]) if row["width"] else np.zeros((len(row["ids"]) // 8, 0))


def _to_blocks(batches):
    for b in batches:
        ids, dense = _quantised(b)
        rows = [_blob(ids[i:i + BLOCK], dense[i:i + BLOCK]) for i in range(0, len(ids), BLOCK)]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("ids", pa.binary()), ("vectors", pa.binary()), ("kind", pa.string()),
                                                              ("width", pa.int32()), ("norm", pa.float64())]))


def _to_queries(every: int):
    """Each query remembers its own row: the block and the place in it."""
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = np.frombuffer(row["ids"], "<i8")
                at = np.flatnonzero(ids % every == 0)
                for i in range(0, len(at), QUERY_BLOCK):
                    own = at[i:i + QUERY_BLOCK]
                    out = _blob(ids[own], _vectors(row)[own].astype(np.float64)) | {"own_block": row["block"], "own_at": own.astype("<i8").tobytes()}
                    yield pa.RecordBatch.from_pylist([out], pa.schema([
                        ("ids", pa.binary()), ("vectors", pa.binary()), ("kind", pa.string()), ("width", pa.int32()),
                        ("norm", pa.float64()), ("own_block", pa.int64()), ("own_at", pa.binary())]))
    return run


def inner(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products as int64; what passes that range stops at its ends."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x.astype(np.float64), ((0, 0), (0, width - x.shape[1]))) for x in (q, c))
    size = width * float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0))
    if size < 2.0 ** 53:
        return (q @ c.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in q], object).reshape(q.shape) @ np.array([[int(x) for x in r] for r in c], object).reshape(c.shape).T
    return np.clip(exact, -_LIMIT, _LIMIT).astype(np.int64)


def _pairs(candidates: pa.Table, queries: pa.Table):
    """Query block, its row, and the scores of one candidate block after the other (own rows masked)."""
    blocks = [(r["block"], np.frombuffer(r["ids"], "<i8"), _vectors(r)) for r in candidates.to_pylist()]
    for q in queries.to_pylist():
        ids, vectors = np.frombuffer(q["ids"], "<i8"), _vectors(q)

        def scored(q=q, vectors=vectors, n=len(ids)):
            for block, c_ids, c in blocks:
                other = np.ones((n, len(c_ids)), bool)
                if block == q["own_block"]:
                    other[np.arange(n), np.frombuffer(q["own_at"], "<i8")] = False
                yield c_ids, inner(vectors, c), other

        yield q, ids, scored


def _bin_width(low, high):
    return np.maximum(1, -((low - high) // BINS))


def _histogram(k: int):
    schema = pa.schema([("query_block", pa.int64()), ("at", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())])

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        for q, ids, scored in _pairs(candidates, queries):
            low, high = np.array(q["low"], np.int64), np.array(q["high"], np.int64)
            step, n = _bin_width(low, high), len(ids)
            counts = np.zeros((n, BINS + 1), np.int64)  # the last column: at or above high
            for _, s, other in scored():
                place = np.where(s >= high[:, None], BINS, (s - low[:, None]) // step[:, None])
                use = other & (s >= low[:, None])
                counts += np.bincount((np.arange(n)[:, None] * (BINS + 1) + place)[use], minlength=counts.size).reshape(counts.shape)
            # where k scores of this group alone lie higher, the global k-th does too
            higher = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
            row, place = np.nonzero((counts[:, :BINS] > 0) & (higher[:, :BINS] < k))
            out.append(pa.table([pa.array(np.full(len(row), q["query_block"])), pa.array(row, pa.int32()), pa.array(place, pa.int32()),
                                 pa.array(counts[row, place])], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def _reaching(k: int):
    schema = pa.schema([("query_block", pa.int64()), ("at", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        for q, ids, scored in _pairs(candidates, queries):
            low = np.array(q["low"], np.int64)
            found = [np.zeros((3, 0), np.int64)]
            for c_ids, s, other in scored():
                row, col = np.nonzero(other & (s >= low[:, None]))
                found.append(np.stack([row, c_ids[col], s[row, col]]))
            row, vec, score = np.concatenate(found, axis=1)
            order = np.lexsort((vec, -score, row))
            row, vec, score = row[order], vec[order], score[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, vec, score = row[best], vec[best], score[best]
            out.append(pa.table([pa.array(np.full(len(row), q["query_block"])), pa.array(row, pa.int32()), pa.array(ids[row]),
                                 pa.array(vec), pa.array(score)], schema=schema))
        return pa.concat_tables(out) if out else schema.empty_table()
    return run


def search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of vectors(vec_id, embedding) whose id is
    divisible by ``every``, its k best other rows, all if there are fewer.

    Vectors that are null or hold null, nan or infinite components take no
    part, nor do rows without an id; a shorter vector counts as filled up with
    zeros; rows of one id are rows of their own, each a candidate of the
    other; scores beyond 2**61 stop there; an empty table gives no rows."""
    # ids are stored with their rows: computed anew, they would follow how Spark packs the files into partitions
    blocks = stored(vectors.select("vec_id", "embedding").mapInArrow(_to_blocks, _BLOCK_SCHEMA)
                    .withColumn("block", F.monotonically_increasing_id()), "vectors")
    queries = stored(blocks.mapInArrow(_to_queries(every), _BLOCK_SCHEMA + ", own_block long, own_at binary")
                     .withColumn("query_block", F.monotonically_increasing_id()), "queries")
    n_blocks, norm = blocks.agg(F.count("*"), F.max("norm")).first()
    n_queries = queries.count()
    groups, q_groups = -(-n_blocks // GROUP_BLOCKS) or 1, -(-n_queries // GROUP_QUERIES) or 1
    numbered = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every_group = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = (blocks.withColumn("g", numbered("block", groups)).withColumn("h", every_group(q_groups))
                  .select("g", "h", "block", "ids", "vectors", "kind", "width").groupBy("g", "h"))
    n_of = (F.octet_length("ids") / 8).cast("int")
    bound = F.least(F.col("norm") * ((norm or 0.0) * (1 + 1e-9)) + 1, F.lit(float(_LIMIT))).cast("long") + 1
    state = stored(queries.select("query_block", F.array_repeat(-bound, n_of).alias("low"), F.array_repeat(bound + 1, n_of).alias("high"),
                                  F.array_repeat(F.lit(0).cast("long"), n_of).alias("above")), "topk-state")

    def meet(run, schema):
        asked = (queries.join(state, "query_block").withColumn("h", numbered("query_block", q_groups)).withColumn("g", every_group(groups))
                 .select("g", "h", "query_block", "ids", "vectors", "kind", "width", "own_block", "own_at", "low", "high").groupBy("g", "h"))
        return candidates.cogroup(asked).applyInArrow(run, schema)

    while (state.select(F.max(F.array_max(F.zip_with("high", "low", lambda a, b: a - b)))).first()[0] or 0) > 1:
        counts = meet(_histogram(k), "query_block long, at int, bin int, n long").groupBy("query_block", "at", "bin").agg(F.sum("n").alias("n"))
        state = stored(_refined(state, counts, k), "topk-state")

    found = meet(_reaching(k), "query_block long, at int, query_id long, vec_id long, score long")
    best = Window.partitionBy("query_block", "at").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _refined(state: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The bin that holds each k-th score becomes its interval; a query with
    fewer than k candidates keeps its lowest value, so that all reach it."""
    down = Window.partitionBy("query_block", "at").orderBy(F.col("bin").desc())
    one = state.select("query_block", F.posexplode(F.arrays_zip("low", "high", "above")).alias("at", "s")).select("query_block", "at", "s.*")
    seen = counts.withColumn("upto", F.sum("n").over(down)).join(one, ["query_block", "at"])
    hit = (seen.where((F.col("above") + F.col("upto") >= k) & (F.col("above") + F.col("upto") - F.col("n") < k))
           .select("query_block", "at", "bin", (F.col("above") + F.col("upto") - F.col("n")).alias("now_above")))
    step = F.greatest(F.lit(1).cast("long"), F.ceil((F.col("high") - F.col("low")) / F.lit(BINS)).cast("long"))
    step = F.when(F.col("high") - F.col("low") > (1 << 52), F.expr(f"(high - low) div {BINS} + 1")).otherwise(step)
    low = F.when(F.col("bin").isNull(), F.col("low")).otherwise(F.col("low") + F.col("bin") * step)
    high = F.when(F.col("bin").isNull(), F.col("low") + 1).otherwise(F.least(F.col("high"), F.col("low") + (F.col("bin") + 1) * step))
    new = (one.join(hit, ["query_block", "at"], "left")
           .select("query_block", F.struct("at", low.alias("low"), high.alias("high"), F.coalesce("now_above", "above").alias("above")).alias("s")))
    # at most QUERY_BLOCK entries each
    return (new.groupBy("query_block").agg(F.array_sort(F.collect_list("s")).alias("s"))
            .select("query_block", "s.low", "s.high", "s.above"))


def op10_topk(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
