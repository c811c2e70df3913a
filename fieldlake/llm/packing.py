"""Packing token sequences by first-fit decreasing with a tournament tree.

Every document is tokenised once, with an end id; full sequences are cut off
it at once and what is left is one piece.  Those pieces are dealt to random
groups of bounded size, and each group packs its pieces, longest first, into
the first sequence with room, found through a tournament tree of free space.

Only ids of pieces, their lengths and checksums leave the tokenising task."""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat
from fieldlake.llm.common import stored, table

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 4096
SEED = 9
MOST_CACHED = 1 << 19
LEARN_CHUNKS = 1 << 10  # chunks encoded by one call: their encodings stay in the processor's cache
JOINED = 64             # of them in one text

# white space beyond ASCII's, and control characters some engines count as such
_WIDE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of whole slices.

    The tokenizer's pattern always starts a new piece at a single blank or
    line feed between two characters that are not white space, so texts are
    cut there, and each distinct chunk is encoded once and remembered by its
    hash and length.  Texts with rarer white space are encoded uncut.  Chunks
    between two such cuts are encoded many in one text, and the bytes that each
    token stands for tell whose it is."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # a byte-level vocabulary has a character a byte; added tokens stand in texts as they are
        sizes = {i: len(s) for s, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        sizes |= {i: len(x.content.encode()) for i, x in self.tokenizer.get_added_tokens_decoder().items()}
        self.sizes = np.zeros(max(sizes, default=-1) + 1, np.int64)
        self.sizes[list(sizes)] = list(sizes.values())
        self.forget()

    def forget(self) -> None:
        self.known = [self._none(), self._none()]  # long kept, and recent; both point into pool
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    @staticmethod
    def _none():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _cuts(self, t: flat.Texts) -> np.ndarray:
        data, off = t.data[:-8], t.offsets
        blank = (data == 0x20) | (data == 0x0A)
        space = flat.SPACE[data]
        cut = np.zeros(len(data), bool)
        cut[1:-1] = blank[1:-1] & ~space[:-2] & ~space[2:]
        last = off[1:][off[1:] > off[:-1]] - 1
        cut[last] = False
        for i in range(len(t)):
            a, b = off[i], off[i + 1]
            if a < b:
                if _WIDE_SPACE.search(t.text(i).decode()):
                    cut[a:b] = False
                cut[a] = True
        return np.flatnonzero(cut)

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, n = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        for key, start, count in self.known:
            if len(key):
                i = np.minimum(np.searchsorted(key, keys), len(key) - 1)
                hit = key[i] == keys
                at[hit], n[hit] = start[i[hit]], count[i[hit]]
        return at, n

    def _ids(self, chunks: list[bytes], joined: int) -> tuple[np.ndarray, np.ndarray]:
        """The chunks' token ids, chunk after chunk, and how many each has; up to ``joined`` are encoded as one text."""
        ids, count = [np.zeros(0, np.uint32)], []
        for i in range(0, len(chunks), LEARN_CHUNKS):
            part = chunks[i:i + LEARN_CHUNKS]
            texts = [b"".join(part[k:k + joined]).decode() for k in range(0, len(part), joined)]
            # the fast call gives the same ids and keeps no offsets, which nothing here reads
            found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            ids.append(np.fromiter(itertools.chain.from_iterable(found), np.uint32))
            count += map(len, found)
        ids = np.concatenate(ids)
        if joined == 1 or not chunks:
            return ids, np.array(count, np.int64)
        end = np.cumsum(self.sizes[ids])
        size = np.cumsum([len(c) for c in chunks])
        last = np.searchsorted(end, size)
        if last[-1] != len(ids) - 1 or (end[last] != size).any():
            return self._ids(chunks, 1)   # a token crosses two chunks, or does not stand for its bytes
        return ids, np.diff(last, prepend=-1)

    def _learn(self, keys: np.ndarray, chunks: list[bytes], joined: int = 1) -> None:
        ids, count = self._ids(chunks, joined)
        total = len(ids)
        if self.used + total > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(total, len(self.pool)), np.uint32)])
        self.pool[self.used:self.used + total] = ids
        start = self.used + np.cumsum(count) - count
        self.used += total
        old, new = self.known
        new = [np.concatenate(x) for x in zip(new, (keys, start, count))]
        if len(new[0]) > len(old[0]) // 4:
            old, new = [np.concatenate(x) for x in zip(old, new)], self._none()
            old = tuple(x[order] for order in [np.argsort(old[0])] for x in old)
        else:
            new = tuple(x[order] for order in [np.argsort(new[0])] for x in new)
        self.known = [old, new]

    def encode(self, t: flat.Texts) -> tuple[np.ndarray, np.ndarray]:
        """The slice's token ids, document after document, and how many each has."""
        if len(self.known[0][0]) > MOST_CACHED:
            self.known, self.used = [self._none(), self._none()], 0
        start = self._cuts(t)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(t), np.int64)
        end = np.append(start[1:], t.offsets[-1])
        keys, first, inverse = np.unique(flat.span_hashes(t, start, end), return_index=True, return_inverse=True)
        at, n = self._find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            a, z = start[first[new]], end[first[new]]
            # in front of a chunk that begins no text, and behind one that ends in no white space, others may stand
            alone = np.isin(a, t.offsets[:-1]) | flat.SPACE[t.data[z - 1]]
            if np.count_nonzero(~alone) < JOINED:   # not one whole text of them
                alone[:] = True
            raw = t.data.tobytes()
            for use, joined in ((alone, 1), (~alone, JOINED)):
                if use.any():
                    self._learn(keys[new[use]], [raw[i:k] for i, k in zip(a[use].tolist(), z[use].tolist())], joined)
            at[new], n[new] = self._find(keys[new])
        at, n = at[inverse], n[inverse]
        place = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
        doc = np.searchsorted(t.offsets, start, "right") - 1
        return self.pool[place], np.bincount(doc, n, len(t)).astype(np.int64)


@functools.lru_cache(1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches):
        enc = encoder(path)
        for b in batches:
            ids_of = b.column("doc_id")
            for t in flat.slices(b.column("text")):
                ids, counts = enc.encode(t)
                rows = []
                first = 0
                for i, n in enumerate(counts.tolist()):
                    own = np.append(ids[first:first + n], np.uint32(end_id)).astype("<u4")
                    first += n
                    for start in range(0, n + 1, capacity):
                        piece = own[start:start + capacity]
                        rows.append((t.rows[i], start, len(piece), zlib.crc32(piece.tobytes()), n + 1))
                row, *rest = (pa.array(x, pa.int64()) for x in zip(*rows))
                yield pa.RecordBatch.from_arrays([ids_of.take(row), *rest], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        enc.forget()   # a worker that waits, or serves another stage, holds no chunks
    return flat.tidy(run)


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item.  The tree's leaves hold the free space of
    the bins, each inner node the larger of its two children; the leftmost
    bin with room is found by going down from the root."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    free = [capacity] * (2 * leaves)
    bins, offsets = [0] * len(lengths), [0] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need, node = lengths[item], 1
        while node < leaves:
            node *= 2
            if free[node] < need:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - free[node]
        free[node] -= need
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
    return bins, offsets


def _pack_group(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("piece")
        bins, offsets = first_fit_decreasing(pdf["length"].tolist(), capacity)
        # even ids: group and bin; odd ids belong to pieces that fill a sequence alone
        pdf["sequence_id"] = 2 * (pdf["pack_group"] * (1 << 32) + np.array(bins, np.int64))
        pdf["offset"] = np.array(offsets, np.int64)
        return pdf.drop(columns=["piece", "pack_group"])
    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
         group_pieces: int = GROUP_PIECES, seed: int = SEED) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row a piece,
    for every row of docs(doc_id, text).

    A null or empty text is the end id alone.  A document of more than
    ``capacity`` ids is cut into full sequences and a rest.  Repeated rows and
    null ids are packed like any other; an empty table gives no rows."""
    path = tokenizer or default_tokenizer()
    cols = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = stored(docs.select("doc_id", "text").mapInArrow(_pieces(path, capacity, end_id), cols), "pieces")
    pieces = pieces.withColumn("piece", F.monotonically_increasing_id())
    rest = F.col("length") < capacity
    groups = max(1, -(-pieces.where(rest).count() // group_pieces))
    alone = (pieces.where(~rest).withColumn("sequence_id", 2 * F.col("piece") + 1).withColumn("offset", F.lit(0).cast("long"))
             .drop("piece"))
    packed = (pieces.where(rest)
              .withColumn("pack_group", F.pmod(F.xxhash64("piece", F.lit(seed)), F.lit(groups)).cast("long"))
              .groupBy("pack_group").applyInPandas(_pack_group(capacity), cols + ", sequence_id long, offset long"))
    return alone.unionByName(packed)


def op9_pack(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents", "doc_id", "text"))
