"""Token groups on which two tokenizers agree, from the spans they report.

A text is encoded by a byte-level tokenizer, which reports character offsets,
and by a sentencepiece model, whose proto reports spans.  The ends of these
spans are coarse cuts.  Where a token ends inside a character (byte pieces of a
multibyte character) spans say too little: there the tokens' decoded bytes
give the exact ends.  A group ends where tokens of both end.

Both tokenizers split a text at a blank or line feed that stands between two
characters that are no white space, so texts are cut there; every distinct
chunk is encoded and aligned once a worker and remembered.  An id pair's count
over all documents is summed from blocks, and a block asks for each of its
pairs once (see blocks.py)."""

from __future__ import annotations

import functools
import hashlib
import os
from array import array
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import blocks, flat
from fieldlake.llm.common import stored, table
from fieldlake.llm.packing import _WIDE_SPACE

BLOCK_BYTES = 2 << 20
MOST_CACHED = 250_000   # chunks remembered by a worker; what is forgotten is encoded again
LEARNT = 8192           # chunks encoded together
JOINED = 64             # of them in one text
SHIFT = 1 << 16         # an id pair is a * SHIFT + b


def default_paths() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable Latin-1 for itself, the others in order from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _pool(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings' bytes one after the other, where each begins, and its length."""
    size = np.array([len(s) for s in strings], np.int64)
    return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(size) - size, size


class Side:
    """One tokenizer's tokens of many chunks: ids, the chunk and end byte of
    each (ends count from the first chunk's first byte)."""

    def __init__(self, ids: np.ndarray, count: np.ndarray, coarse: np.ndarray, pool, t: flat.Texts):
        """``coarse`` has the ends that the spans tell, as bytes of each chunk."""
        data, start, size = pool
        self.ids, self.chunk = ids, np.repeat(np.arange(len(count)), count)
        first = np.cumsum(count) - count
        length = size[ids]
        total = np.append(0, np.cumsum(length))
        decoded = total[1:] - total[first][self.chunk]
        begin = t.offsets[:-1]
        # a chunk whose tokens end in different places, at characters' ends, needs no look at bytes; tokens that
        # share a character share its span, and only their bytes tell them apart
        before = np.append(0, coarse[:-1])
        before[first[count > 0]] = 0
        inner = np.bincount(self.chunk, coarse <= before, len(count)) > 0
        self.ends = np.where(inner[self.chunk], decoded, coarse) + begin[self.chunk]
        # joined bytes that differ from the chunk's
        n_bytes = np.diff(t.offsets)
        self.differs = np.bincount(self.chunk, length, len(count)) != n_bytes
        row, i = flat.ragged(length)
        same = ~self.differs[self.chunk[row]]
        row, i = row[same], i[same]
        mine = data[start[ids[row]] + i]
        theirs = t.data[begin[self.chunk[row]] + decoded[row] - length[row] + i]
        self.differs |= np.bincount(self.chunk[row], mine != theirs, len(count)) > 0

    def only(self, chunks: np.ndarray) -> "Side":
        keep = chunks[self.chunk]
        self.ids, self.chunk, self.ends = self.ids[keep], self.chunk[keep], self.ends[keep]
        return self


class Groups:
    """The groups of many chunks.  ``of_a`` and ``of_b`` give each token's
    group; ``end`` each group's end byte, ``chunk`` its chunk."""

    def __init__(self, a: Side, b: Side, n_bytes: int):
        self.a, self.b = a, b
        both = np.zeros(n_bytes + 1, bool)
        both[a.ends] = True
        ends_b = np.zeros(n_bytes + 1, bool)
        ends_b[b.ends] = True
        both &= ends_b
        so_far = np.cumsum(both)
        self.end = np.flatnonzero(both)
        self.of_a, self.of_b = (so_far[x.ends] - both[x.ends] for x in (a, b))
        self.n = len(self.end)
        self.size_a, self.size_b = (np.bincount(x, minlength=self.n) for x in (self.of_a, self.of_b))
        self.first_a, self.first_b = (np.cumsum(x) - x for x in (self.size_a, self.size_b))
        self.chunk = a.chunk[self.first_a]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Chunk and id pair of every two tokens that share a group."""
        of, i = flat.ragged(self.size_b[self.of_a])
        return self.a.chunk[of], self.a.ids[of] * SHIFT + self.b.ids[self.first_b[self.of_a[of]] + i]

    def texts(self, chunks: int) -> list[bytes]:
        """Each chunk's groups as `a1,a2|b1;a3|b2`."""
        digits, start, size = _DIGITS
        ids, group = np.concatenate([self.a.ids, self.b.ids]), np.concatenate([self.of_a, self.of_b])
        side = np.repeat([0, 1], [len(self.a.ids), len(self.b.ids)])
        order = np.lexsort((side, group))
        ids, group, side = ids[order], group[order], side[order]
        # what follows each id: a comma inside a side, a bar between the sides, a semicolon behind a group
        last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True)[:len(ids)]
        follows = np.where(last, np.where(side == 0, ord("|"), ord(";")), ord(",")).astype(np.uint8)
        row, i = flat.ragged(size[ids] + 1)
        out = np.where(i < size[ids][row], digits[np.minimum(start[ids][row] + i, len(digits) - 1)], follows[row]).tobytes()
        at = np.append(0, np.cumsum(np.bincount(self.chunk[group], size[ids] + 1, chunks).astype(np.int64))).tolist()
        return [out[a:max(a, z - 1)] for a, z in zip(at, at[1:])]


_DIGITS = _pool([str(i).encode() for i in range(SHIFT)])


class Aligner:
    """Encodes and aligns chunks, each once; what it knows of a chunk lies in
    flat arrays under the chunk's number."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        of = byte_alphabet()
        entries = dict(sorted((i, s) for s, i in self.a.get_vocab().items()))
        self.pool_a = _pool([bytes(of[c] for c in s) if all(c in of for c in s) else s.encode() for s in (entries.get(i, "") for i in range(max(entries) + 1))])
        self.pool_b = _pool([bytes([int(s[3:5], 16)]) if self.b.is_byte(i) else s.replace("▁", " ").encode()
                             for i, s in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))])
        self.blank = self.b.piece_to_id("▁")
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.counts = array("q")      # n_a, n_b, n_groups, n_links and the number of pairs; n_a is -1 if bytes differ
        self.pairs, self.times = array("q"), array("q")
        self.texts: list[bytes] = []

    def _joinable(self, t: flat.Texts) -> np.ndarray:
        """Chunks that may stand between others in one text without a change:
        a blank or line feed and a character that is no white space in front,
        one at the end, and neither other white space nor a literal U+2581."""
        size = np.diff(t.offsets)
        head, last = t.data[np.minimum(t.offsets[:-1] + 1, t.offsets[-1])], t.data[t.offsets[1:] - 1]
        fine = (size > 1) & ~flat.SPACE[head] & ~flat.SPACE[last] & np.isin(t.data[t.offsets[:-1]], (0x20, 0x0A))
        odd = np.append(0, np.cumsum((t.data[:-8] >= 0x80) | ((t.data[:-8] >= 0x1C) & (t.data[:-8] < 0x20))))
        for i in np.flatnonzero(fine & (odd[t.offsets[1:]] > odd[t.offsets[:-1]])).tolist():
            text = t.text(i).decode()
            fine[i] = "▁" not in text and not _WIDE_SPACE.search(text)
        return fine

    def groups(self, t: flat.Texts, joined: int = JOINED) -> tuple[Groups, np.ndarray]:
        """The groups of chunks ``t`` and which chunks have none, as the joined
        bytes of either side differ from theirs.  Up to ``joined`` chunks are
        encoded as one text."""
        n = len(t)
        fine = self._joinable(t) if joined > 1 else np.zeros(n, bool)
        begins = ~fine
        begins[1:] |= ~fine[:-1]
        begins[:1] = True
        run = np.cumsum(begins) - 1
        begins |= (np.arange(n) - np.flatnonzero(begins)[run]) % joined == 0
        unit = np.flatnonzero(begins)
        g, none = self._groups(flat.Texts(t.data, np.append(t.offsets[unit], t.offsets[-1]), range(len(unit))))
        size = np.diff(np.append(unit, n))
        if (none & (size > 1)).any():
            return self.groups(t, 1)
        g.a.chunk, g.b.chunk, g.chunk = (np.searchsorted(t.offsets, x - 1, "right") - 1 for x in (g.a.ends, g.b.ends, g.end))
        return g, np.repeat(none, size)

    def _groups(self, t: flat.Texts) -> tuple[Groups, np.ndarray]:
        """A text begins with a blank, which B adds by itself, or with a line
        feed, before which the blank that B adds is taken off."""
        n = len(t)
        texts = [t.text(i).decode() for i in range(n)]
        lead = t.data[t.offsets[:-1]] == 0x20
        found = self.a.encode_batch(texts, add_special_tokens=False)
        count = np.fromiter(map(len, found), np.int64, n)
        ids = np.fromiter(chain.from_iterable(map(attrgetter("ids"), found)), np.int64, count.sum())
        ends = np.fromiter(chain.from_iterable(chain.from_iterable(map(attrgetter("offsets"), found))), np.int64, 2 * len(ids))[1::2]
        # A's ends count characters: to bytes
        begins = np.append((t.data[:-8] & 0xC0) != 0x80, True)
        place = np.flatnonzero(begins)
        char = np.cumsum(begins)[t.offsets[:-1]] - 1
        of = np.repeat(np.arange(n), count)
        a = Side(ids, count, place[char[of] + ends] - t.offsets[of], self.pool_a, t)
        # B's count bytes of what it was given
        found = [x.pieces for x in self.b.encode([x[y:] for x, y in zip(texts, lead.tolist())], return_type="proto", num_threads=1)]
        count = np.fromiter(map(len, found), np.int64, n)
        pieces = list(chain.from_iterable(found))
        ids = np.fromiter(map(attrgetter("id"), pieces), np.int64, len(pieces))
        ends = np.fromiter(map(attrgetter("end"), pieces), np.int64, len(pieces))
        of = np.repeat(np.arange(n), count)
        drop = np.zeros(len(ids), bool)
        drop[(np.cumsum(count) - count)[~lead & (count > 0)]] = True
        odd = np.bincount(of[drop], ids[drop] != self.blank, n) > 0
        b = Side(ids[~drop], np.bincount(of[~drop], minlength=n), (ends + lead[of])[~drop], self.pool_b, t)
        none = a.differs | b.differs | odd
        return Groups(a.only(~none), b.only(~none), int(t.offsets[-1])), none

    def _learn(self, chunks: list[bytes]) -> None:
        t = next(flat.slices(pa.array(chunks, pa.large_binary()), 1 << 62))
        n, (g, none) = len(chunks), self.groups(t)
        chunk, pair = g.links()
        link, times = np.unique(chunk << 32 | pair, return_counts=True)
        counts = np.stack([np.where(none, -1, np.bincount(g.a.chunk, minlength=n)), *[np.bincount(x, minlength=n) for x in (g.b.chunk, g.chunk, chunk, link >> 32)]], 1)
        self.number.update(zip(chunks, range(len(self.texts), len(self.texts) + n)))
        self.counts.frombytes(counts.astype(np.int64).tobytes())
        self.pairs.frombytes((link & ((1 << 32) - 1)).tobytes())
        self.times.frombytes(times.astype(np.int64).tobytes())
        self.texts += g.texts(n)

    def cuts(self, t: flat.Texts) -> np.ndarray:
        """Where chunks begin; each text begins with its blank or is empty."""
        data, off = t.data[:-8], t.offsets
        blank = (data == 0x20) | (data == 0x0A)
        space = flat.SPACE[data]
        cut = np.zeros(len(data), bool)
        cut[1:-1] = blank[1:-1] & ~space[:-2] & ~space[2:]
        some = np.flatnonzero(off[1:] > off[:-1])
        cut[off[some + 1] - 1] = False
        for i in some.tolist():
            if _WIDE_SPACE.search(t.text(i).decode()):
                cut[off[i]:off[i + 1]] = False
        cut[off[some]] = True
        return np.flatnonzero(cut)

    def chunks(self, t: flat.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the slice's distinct chunks; for every chunk in the texts which of those it is, and whose."""
        start = self.cuts(t)
        end = np.append(start[1:], t.offsets[-1])
        _, first, which = np.unique(flat.span_hashes(t, start, end), return_index=True, return_inverse=True)
        keys = [t.data[a:z].tobytes() for a, z in zip(start[first].tolist(), end[first].tolist())]
        if len(self.number) > MOST_CACHED:
            self._forget()
        new = [k for k in keys if k not in self.number]
        for i in range(0, len(new), LEARNT):
            self._learn(new[i:i + LEARNT])
        return np.array([self.number[k] for k in keys], np.int64), which, np.searchsorted(t.offsets, start, "right") - 1


@functools.lru_cache(1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def spaced(column) -> pa.Array:
    """Each text behind one blank; null and empty ones are empty."""
    text = column.cast(pa.large_binary()).fill_null(b"")
    blank, none = pa.scalar(b" ", pa.large_binary()), pa.scalar(b"", pa.large_binary())
    return pc.if_else(pc.equal(pc.binary_length(text), 0), text, pc.binary_join_element_wise(none, text, blank))


def _spans(paths, keep: list[str]):
    def run(batches):
        own = aligner(*paths)
        for b in batches:
            for t in blocks.slices(b.column("text"), flat.SLICE_BYTES, spaced):
                start = own.cuts(t)
                doc = np.searchsorted(t.offsets, start, "right") - 1
                g, none = own.groups(flat.Texts(t.data, np.append(start, t.offsets[-1]), range(len(start))))
                use = ~np.bincount(doc, none, len(t)).astype(bool)
                of = doc[g.chunk]
                groups, of = np.flatnonzero(use[of]), of[use[of]]
                # groups of one text lie end to end
                before = np.append(0, g.end[:-1])[groups]
                before = np.where(np.diff(of, prepend=-1) != 0, t.offsets[of], before)
                lists = []
                for x, first, size in ((g.a, g.first_a, g.size_a), (g.b, g.first_b, g.size_b)):
                    row, i = flat.ragged(size[groups])
                    lists.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size[groups])), pa.int32()), pa.array(x.ids[first[groups][row] + i], pa.int32())))
                spans = pa.StructArray.from_arrays([pa.array(before - t.offsets[of], pa.int32()), pa.array(g.end[groups] - t.offsets[of], pa.int32()), *lists], ["start", "end", "a", "b"])
                rows = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(t) + 1)), pa.int32()), spans)
                yield pa.RecordBatch.from_arrays([*[b.column(c).slice(t.rows.start, len(t)) for c in keep], rows], [*keep, "groups"])
    return flat.tidy(run)


def align(docs: DataFrame, keep: list[str] = ["doc_id"], path_a: str | None = None, path_b: str | None = None) -> DataFrame:  # noqa: B006
    """The ``keep`` columns with ``groups`` of every row of docs(doc_id, text):
    byte spans in blank + text, and the ids of both tokenizers in each.

    A null or empty text, and one that a tokenizer does not give back byte for
    byte, has no groups; an empty table gives no rows."""
    paths = tuple(x or y for x, y in zip((path_a, path_b), default_paths()))
    names = list(dict.fromkeys([*keep, "text"]))
    d = docs.select(*names)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.select(*keep).schema]
    return d.mapInArrow(_spans(paths, keep), ", ".join(kept) + ", groups array<struct<start: int, end: int, a: array<int>, b: array<int>>>")


def _blocks(paths, block_bytes: int):
    """One row a block: its documents with what concerns them alone, its
    distinct linked pairs, how many of its documents hold each, and which
    pairs each document has how often."""
    def run(batches):
        own = aligner(*paths)
        for b in batches:
            for t in blocks.slices(b.column("text"), block_bytes, spaced):
                n = len(t)
                number, which, doc = own.chunks(t)
                counts = np.array(own.counts, np.int64).reshape(-1, 5)
                first = np.cumsum(counts[:, 4]) - counts[:, 4]
                bad = np.bincount(doc, counts[number[which], 0] < 0, n) > 0
                use = ~bad[doc]
                which, doc = which[use], doc[use]
                sums = [np.bincount(doc, counts[number[which], c], n).astype(np.int64) for c in range(4)]
                edges = np.searchsorted(doc, np.arange(n + 1)).tolist()
                texts = [own.texts[i] for i in number.tolist()]
                order = which.tolist()
                shas = [hashlib.sha256(b";".join([texts[k] for k in order[a:z]])).hexdigest() if a < z else "" for a, z in zip(edges, edges[1:])]
                # pairs of each document's distinct chunks
                doc, chunk, times = blocks.held(doc, which, len(number))
                place, i = flat.ragged(counts[number[chunk], 4])
                at = first[number[chunk]][place] + i
                keys, of = np.unique(np.frombuffer(own.pairs, np.int64)[at], return_inverse=True)
                holders = np.zeros(len(keys), np.int64)
                doc, of, times = blocks.held(doc[place], of, len(keys), np.frombuffer(own.times, np.int64)[at] * times[place])
                np.add.at(holders, of, 1)
                packed = blocks.vectors(doc, of, times, len(keys))
                yield pa.RecordBatch.from_arrays(
                    [blocks.lists(b.column("doc_id").slice(t.rows.start, n), pa.int64()), *[blocks.lists(x, pa.int64()) for x in sums], blocks.lists(shas, pa.string()),
                     blocks.lists(keys, pa.int64()), blocks.lists(holders, pa.int64()), *packed.values()],
                    ["ids", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "keys", "holders", *packed])
        own._forget()   # a worker that waits for its next task holds no chunks
    return flat.tidy(run)


_OWN = ("n_a", "n_b", "n_groups", "n_links")


def _documents(block: pa.Table, found: pa.Table) -> pa.Table:
    out = []
    for i in range(block.num_rows):
        own = {c: block.column(c).combine_chunks()[i].values for c in ("ids", *_OWN, "groups_sha256")}
        packed = {c: block.column(c)[i].as_py() for c in ("n_keys", "n_pairs", "steps", "times")}
        n, keys = len(own["ids"]), packed["n_keys"]
        count, best = blocks.at_places(found, "n", keys), blocks.at_places(found, "best", keys, False).astype(bool)
        doc, of, times = blocks.unpack_vectors(packed)
        sums = np.zeros((2, n), np.int64)   # whole numbers: exact beyond 2**53 too
        np.add.at(sums[0], doc, times * best[of])
        np.add.at(sums[1], doc, times * count[of].astype(np.int64))
        out.append(pa.table([own["ids"], *[own[c] for c in _OWN], *sums, own["groups_sha256"]], names=["doc_id", *_OWN, "n_best", "count_sum", "groups_sha256"]))
    return pa.concat_tables(out)


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def pair_counts(made: DataFrame) -> DataFrame:
    """(key, n, best): how many documents hold the pair, and whether no other pair of its A id is in more."""
    counts = stored(made.select(F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("holders").alias("holders"))))
                    .groupBy("key").agg(F.sum("holders").alias("n")), "pair-counts")
    a = F.floor(F.col("key") / SHIFT).cast("long")
    # one row an id of A: bounded by its vocabulary
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(highest), a == F.col("a")).select("key", "n", (F.col("n") == F.col("most")).alias("best"))


def link_statistics(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row of docs(doc_id, text).

    All links count, whatever their number.  A null or empty text, and one that
    a tokenizer does not give back byte for byte, has no tokens: zeros and an
    empty groups_sha256.  Every row is a document of its own, repeated ones and
    null ids too; an empty table gives no rows.  Chunks of a block are told
    apart by 64-bit hashes, across blocks by their bytes."""
    paths = tuple(x or y for x, y in zip((path_a, path_b), default_paths()))
    made = docs.select("doc_id", "text").mapInArrow(
        _blocks(paths, block_bytes), "ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
                                     "keys array<long>, holders array<long>, " + blocks.VECTORS)
    made = stored(made.withColumn("block", F.monotonically_increasing_id()), "token-blocks")
    return blocks.look_up(made, pair_counts(made), _documents, _OUT, ("holders",))


def op12_align_tokens(spark, sf_dir: str) -> DataFrame:
    return link_statistics(table(spark, sf_dir, "documents", "doc_id", "text"))
