"""Looking up values for what blocks of documents hold.

A block is a few MB of whole documents, reduced to the distinct keys (words,
pairs of ids) they hold and, for each document, which of them how often.  A
key is asked for once a block, however many documents of the block hold it, so
a key that is everywhere costs a row a block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat


def slices(column, most: int, prepare=lambda c: c) -> Iterator[flat.Texts]:
    """The texts of an Arrow column, about ``most`` bytes at a time; no more of it is copied at once."""
    rows = max(1, int(len(column) * most / max(1, column.nbytes)))
    for first in range(0, len(column), rows):
        for t in flat.slices(prepare(column.slice(first, rows)), most):
            yield flat.Texts(t.data, t.offsets, range(first + t.rows.start, first + t.rows.stop))


def held(doc: np.ndarray, key: np.ndarray, keys: int, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, key) pairs, sorted, and how often each occurs."""
    pair, inverse = np.unique(doc * np.int64(max(1, keys)) + key, return_inverse=True)
    count = np.zeros(len(pair), np.int64)
    np.add.at(count, inverse, 1 if times is None else times)
    return pair // max(1, keys), pair % max(1, keys), count


def pack(x: np.ndarray) -> bytes:
    """Numbers that are not negative, as few bytes wide as the largest needs,
    all lowest bytes first: Spark's compression finds what is empty."""
    width = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w)
    return np.ascontiguousarray(x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T).tobytes()


def unpack(blob: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.int64)
    width = len(blob) // n
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(width, n).T).view(f"<u{width}").ravel().astype(np.int64)


#: which keys each document of a block holds, how often, as ``vectors`` packs them
VECTORS = "n_keys long, n_pairs long, steps binary, times binary"


def vectors(doc: np.ndarray, of: np.ndarray, times: np.ndarray, keys: int) -> dict:
    pair = doc.astype(np.int64) * max(1, keys) + of
    return {"n_keys": pa.array([keys], pa.int64()), "n_pairs": pa.array([len(pair)], pa.int64()),
            "steps": pa.array([pack(np.diff(pair, prepend=0))], pa.binary()), "times": pa.array([pack(times)], pa.binary())}


def unpack_vectors(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, key, times) again."""
    pair = np.cumsum(unpack(row["steps"], row["n_pairs"]))
    return pair // max(1, row["n_keys"]), pair % max(1, row["n_keys"]), unpack(row["times"], row["n_pairs"])


def lists(values, kind) -> pa.Array:
    """A column of one row that holds all values."""
    values = pa.array(values, kind) if not isinstance(values, pa.Array) else values
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def look_up(blocks: DataFrame, values: DataFrame, run, schema: str, asked_only: tuple[str, ...]) -> DataFrame:
    """``run(block, found)`` for every row of blocks(block, keys, ...), where
    ``found`` holds the rows of values(key, ...) for its keys, each with the
    place ``pos`` of the key in ``keys``.  Blocks are stored already; their
    ``asked_only`` columns and keys do not travel with them."""
    asked = blocks.select(F.col("block").alias("asking"), F.posexplode("keys").alias("pos", "key"))
    found = asked.join(values, "key").drop("key")

    def looked_up(f, b):
        out = run(b, f)
        flat.give_back()
        return out

    return found.groupBy("asking").cogroup(blocks.drop("keys", *asked_only).groupBy("block")).applyInArrow(looked_up, schema)


def column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def at_places(found: pa.Table, name: str, n: int, missing=0) -> np.ndarray:
    """A column of ``found`` in the order of the block's keys."""
    x = column(found, name)
    out = np.full(n, missing, x.dtype if len(x) else np.float64)
    out[column(found, "pos")] = x
    return out
