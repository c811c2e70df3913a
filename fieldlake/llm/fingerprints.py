"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every i, the polynomial hash of its
first i code points modulo a prime, for two bases.  Two entries give the hash
of any span, so equal spans are recognised in constant time and the longest
common extension of two places is found by binary search over span lengths.

A fingerprint is the length, the hash of the whole text and a sketch: the
hashes of all spans of eight code points are dealt into 64 bins and each bin
keeps the smallest, in 48 bits, so that the minima of long texts do not meet by
chance.  Likeness is the share of bins that agree among those that
either text fills."""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat
from fieldlake.llm.common import table

PRIME = (1 << 31) - 1
BASES = (911_382_323, 972_663_749)
SPAN = 8
BINS = 64
BITS = 48            # of a bin's minimum
DOCS_PER_RANGE = 4096


@functools.lru_cache(12)
def _powers(base: int, bits: int) -> np.ndarray:
    """base**0 .. base**(2**bits - 1) modulo PRIME."""
    out = np.ones(1 << bits, np.uint64)
    for b in range(bits):
        out[1 << b:2 << b] = out[:1 << b] * np.uint64(pow(base, 1 << b, PRIME)) % np.uint64(PRIME)
    return out


def powers(base: int, n: int) -> np.ndarray:
    bits = int(n).bit_length()
    kept = next((b for b in (12, 16, 20) if bits <= b), None)
    return (_powers(base, kept) if kept else _powers.__wrapped__(base, bits))[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


class Prefix:
    """Prefix arrays of a text under both bases.  Sums stay below 2**63: a
    term is below 2**31 and a text has under 2**31 code points."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.sums, self.back = [], []
        for base in BASES:
            s = np.zeros(self.n + 1, np.uint64)
            np.cumsum((points + np.uint64(1)) * powers(base, self.n) % np.uint64(PRIME), out=s[1:])
            self.sums.append(s % np.uint64(PRIME))
            self.back.append(powers(pow(base, -1, PRIME), self.n + 1))

    def spans(self, start, length) -> np.ndarray:
        """62-bit hashes of the spans text[start:start + length]; arrays or integers."""
        start = np.asarray(start)
        out = []
        for s, back in zip(self.sums, self.back):
            out.append((s[start + length] + np.uint64(PRIME) - s[start]) * back[start] % np.uint64(PRIME))
        return (out[0] << np.uint64(31)) | out[1]

    def whole(self) -> int:
        return int(self.spans(0, self.n))


def equal_spans(a: Prefix, i: int, b: Prefix, j: int, length: int) -> bool:
    return i + length <= a.n and j + length <= b.n and int(a.spans(i, length)) == int(b.spans(j, length))


def longest_common_extension(a: Prefix, i: int, b: Prefix, j: int) -> int:
    """How many code points a[i:] and b[j:] have in common at their beginning."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        middle = (low + high + 1) // 2
        if equal_spans(a, i, b, j, middle):
            low = middle
        else:
            high = middle - 1
    return low


_EMPTY = np.full(BINS, -1, np.int64)


class Fingerprint:
    def __init__(self, points: np.ndarray):
        p = Prefix(points)
        self.n, self.whole, self.sketch = p.n, p.whole(), _EMPTY.copy()
        if p.n:
            size = min(SPAN, p.n)
            h = flat.mix(p.spans(np.arange(p.n - size + 1), size))
            small = np.full(BINS, 1 << BITS, np.int64)
            np.minimum.at(small, (h >> np.uint64(58)).astype(np.int64), ((h >> np.uint64(58 - BITS)) & np.uint64((1 << BITS) - 1)).astype(np.int64))
            self.sketch = np.where(small < 1 << BITS, small, -1)

    def __str__(self) -> str:
        return f"{self.n:x}:{self.whole:016x}:" + "".join("-" * (BITS // 4) if x < 0 else f"{x:0{BITS // 4}x}" for x in self.sketch.tolist())

    def likeness(self, other: "Fingerprint") -> float:
        """1 for equal texts, two empty ones included; 0 if nothing agrees."""
        if (self.n, self.whole) == (other.n, other.whole):
            return 1.0
        filled = (self.sketch >= 0) | (other.sketch >= 0)
        return float(((self.sketch == other.sketch) & filled).sum() / max(1, filled.sum()))


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last third replaced by as many code points (or all) of the following text."""
    cut = len(points) // 3
    return np.concatenate([points[:len(points) - cut], following[:cut]])


def _rows(batches):
    """Rows sorted by (bucket, doc_id descending): each needs the next one's
    text, so one row is held back; a guest closes its bucket."""
    held = None
    for b in batches:
        out = {k: [] for k in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")}
        for bucket, guest, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text"))):
            if held is not None and held[0] == bucket and held[1] and guest:
                continue  # a bucket needs one closing text
            points = code_points(text or "")
            print_ = Fingerprint(points)
            if held is not None and held[0] == bucket and not held[1]:
                _, _, before_id, before, before_print = held
                other = edited(before, points)
                other_print = Fingerprint(other)
                for k, v in zip(out, (before_id, len(before), hashlib.sha256(other.tobytes().decode("utf-32-le").encode()).hexdigest(),
                                      str(before_print), str(other_print), before_print.likeness(other_print), before_print.likeness(print_))):
                    out[k].append(v)
            held = (bucket, guest, doc_id, points, print_)
        yield pa.RecordBatch.from_pydict(out, pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                                                         ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                                                         ("near_edited", pa.float64()), ("near_next", pa.float64())]))


def range_ends(docs: DataFrame, per_range: int = DOCS_PER_RANGE) -> list[int]:
    """Existing doc_ids that split the table into ranges of about
    ``per_range`` rows, the largest id last; read from the id column alone."""
    ids = docs.where("doc_id IS NOT NULL").select("doc_id")
    n, most = ids.agg(F.count("doc_id"), F.max("doc_id")).first()
    if not n:
        return []
    ranges = max(1, -(-n // per_range))
    ends = ids.stat.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.2 / ranges) if ranges > 1 else []
    return sorted({*map(int, ends), most})


def fingerprints(docs: DataFrame, per_range: int = DOCS_PER_RANGE) -> DataFrame:
    """One row of fingerprints for every row of docs(doc_id, text).

    The next document is the one of the next smaller doc_id, after the last
    the first.  Ids are dealt by range, each range gets a copy of the next
    range's first document as its guest, and a range is read in descending
    order; so each text is shuffled once.  A null text counts as empty;
    repeated ids come in the order of their texts; null ids come last; the
    only row of a table is its own next; an empty table gives no rows."""
    ends = range_ends(docs, per_range)
    d = docs.select("doc_id", "text")
    if not ends:  # null ids only, in one range
        everything = d.withColumn("bucket", F.lit(0)).withColumn("guest", F.lit(False))
        guests = everything.orderBy(F.col("text").asc_nulls_first()).limit(1).withColumn("guest", F.lit(True))
        return _laid_out(everything.unionByName(guests), 1)
    # bucket i holds the ids above ends[i - 1] up to ends[i]; null ids go with the smallest
    edges = F.array(*[F.lit(e).cast("long") for e in ends])
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(F.size(F.filter(edges, lambda e: e < F.col("doc_id"))))
    is_end = F.col("doc_id").isin(ends)
    after = F.when(bucket == len(ends) - 1, 0).otherwise(bucket + 1)
    places = F.when(is_end, F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("guest")),
                                    F.struct(after.alias("bucket"), F.lit(True).alias("guest")))
                    ).otherwise(F.array(F.struct(bucket.alias("bucket"), F.lit(False).alias("guest"))))
    return _laid_out(d.select("doc_id", "text", F.inline(places)), len(ends))


def _laid_out(d: DataFrame, buckets: int) -> DataFrame:
    return (d.repartitionById(buckets, F.col("bucket"))
            .sortWithinPartitions("bucket", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first())
            .mapInArrow(_rows, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                               "near_edited double, near_next double"))


def op8_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))
