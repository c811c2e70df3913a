"""Substring deduplication by windows of words, looked up by hash.

Every slice of documents is a reference block.  Its index lists each window of
20 words once, under the smallest 5-word gram inside the window (by hash), so
that a window's entries from all blocks meet in one index part.  The earliest
document that its own block or else the index part knows for a window is the
window's source.  Every word of a window that also starts earlier is removed.
All windows are looked up, by hash, not only those at factor boundaries as in
a greedy parse; factors are runs of windows with one source, listed afterwards.

A block sends each window once however often it repeats there, so a passage
that a third of all documents share costs an index part one entry a block.
Windows are compared by 64-bit hashes inside the part of their gram."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat
from fieldlake.llm.common import stored, table

WINDOW = 20
GRAM = 5
BLOCK_BYTES = 4 << 20   # text of a reference block
PART_BYTES = 8 << 20    # text behind an index part, on average
_LAST = np.iinfo(np.int64).max


def same_text(text: Column) -> Column:
    """Tells rows of one doc_id apart; wholly equal rows stay together."""
    return F.xxhash64(text)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new run begins: the first column steps by other than one or another column changes."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.diff(columns[0]) != 1
    for c in columns[1:]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


_RUN = pa.schema([("doc_id", pa.int64()), ("same", pa.int64()), ("start", pa.int32()), ("length", pa.int32()), ("source", pa.int64())])
#: windows travel as runs of consecutive ones; open runs come first and have a hash a window, known runs have sources
_ENTRY = pa.schema([("part", pa.int64()), *[(c, pa.binary()) for c in ("hashes", "ids", "sames", "starts", "lengths", "sources")]])


def _order_id(column) -> np.ndarray:
    """doc_id as the order of documents; null comes last."""
    return column.fill_null(_LAST).to_numpy(zero_copy_only=False)


def _index(window: int, gram: int, parts: int):
    """Entries of each block by index part.  Windows that the block itself has
    earlier pass through the part as known runs, unasked."""
    def run(batches):
        for b in batches:
            ids_of, sames_of = _order_id(b.column("doc_id")), b.column("same").to_numpy(zero_copy_only=False)
            for t in flat.slices(b.column("text"), BLOCK_BYTES):
                w = flat.Words(t)
                hashed = flat.Windows(w.hashes(t))
                h = hashed.all(window)
                if not len(h):
                    continue
                inside = w.doc[:len(h)] == w.doc[window - 1:]
                grams = hashed.all(gram)
                place, first, count = flat.anchors(grams, window - gram + 1, inside)
                row, i = flat.ragged(count)
                at = first[row] + i
                part = (flat.mix(grams[place]) % np.uint64(parts)).astype(np.int64)[row]
                h, doc = h[at], w.doc[at]
                del grams, inside
                ids = ids_of[t.rows.start + doc]
                order = np.lexsort((at, ids, h))
                group = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]))
                lead = np.repeat(order[group], np.diff(group, append=len(order)))
                again = np.zeros(len(h), bool)   # the same document has the window earlier
                again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
                source = np.empty(len(h), np.int64)
                source[order] = ids[lead]
                known = again | (ids > source)
                del row, i, lead, again
                order = np.lexsort((at, known, part))
                cut = np.flatnonzero(np.diff(part[order], prepend=-1))
                for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
                    own = order[a:z]
                    n = int(np.count_nonzero(~known[own]))
                    begin = runs(at[own], doc[own], known[own], np.where(known[own], source[own], 0))
                    first_of = own[begin]
                    of = doc[first_of]
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (
                        int(part[own[0]]), h[own[:n]].tobytes(), ids[first_of].tobytes(), sames_of[t.rows.start + of].tobytes(),
                        (at[first_of] - w.first[of]).astype("<i4").tobytes(), np.diff(begin, append=len(own)).astype("<i4").tobytes(),
                        source[first_of[known[first_of]]].tobytes())], schema=_ENTRY)
    return run


def _look_up(entries: pa.Table) -> pa.Table:
    """One index part: every open window that a smaller document has too, as
    runs of windows with one source, and the runs the blocks already knew."""
    h, open_, known = [], [], []
    for e in entries.to_pylist():
        sources = np.frombuffer(e["sources"], "<i8")
        columns = [np.frombuffer(e[c], kind) for c, kind in (("ids", "<i8"), ("sames", "<i8"), ("starts", "<i4"), ("lengths", "<i4"))]
        n = len(columns[0]) - len(sources)
        h.append(np.frombuffer(e["hashes"], np.uint64))
        open_.append([c[:n] for c in columns])
        known.append([*(c[n:] for c in columns), sources])
    h = np.concatenate(h)
    ids, sames, starts, lengths = (np.concatenate(c) for c in zip(*open_))
    run, place = flat.ragged(lengths)
    order = np.argsort(h)
    own = ids[run[order]]
    group = np.flatnonzero(np.diff(h[order], prepend=~h[order[:1]]))
    earliest = np.minimum.reduceat(own, group) if len(group) else own
    earliest = np.repeat(earliest, np.diff(group, append=len(h)))
    hit = own > earliest
    window, source = order[hit], earliest[hit]
    order = np.argsort(window)
    window, source = window[order], source[order]
    begin = runs(window, run[window], source)
    size, source, window = np.diff(begin, append=len(window)).astype(np.int32), source[begin], window[begin]
    of = run[window]
    known.append([ids[of], sames[of], (starts[of] + place[window]).astype(np.int32), size, source])
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*known)], schema=_RUN)


def duplicate_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, same, start, length, source): ``length`` consecutive windows from word ``start`` on, each
    of which also starts earlier, in document ``source`` (the same one for a repeat inside it).  A null
    doc_id appears as the largest integer."""
    d = docs.select("doc_id", "text", same_text(F.col("text")).alias("same"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    entries = d.mapInArrow(_index(window, gram, parts), "part long, hashes binary, ids binary, sames binary, starts binary, lengths binary, sources binary")
    return entries.groupBy("part").applyInArrow(_look_up, "doc_id long, same long, start int, length int, source long")


def _parse(window: int, extra: list[str]):
    """Words left of each document, and its windows' runs of one source as factors."""
    def run(batches):
        for b in batches:
            out = {k: [] for k in ("n_words", "n_removed", "kept_text", "factors")}
            found = b.column("found").to_pylist()
            for t in flat.slices(b.column("text")):
                w = flat.Words(t)
                for i in range(len(t)):
                    n, lo = int(w.count[i]), int(w.first[i])
                    text, gone, factors = t.text(i), np.zeros(n + 1, np.int32), []
                    for start, length, source in sorted((f["start"], f["length"], f["source"]) for f in found[t.rows[i]] or ()):
                        if factors and factors[-1]["source"] == source and start <= factors[-1]["start"] + factors[-1]["windows"]:
                            factors[-1]["windows"] = start + length - factors[-1]["start"]
                        else:
                            factors.append({"start": start, "windows": length, "source": source})
                        gone[start] += 1
                        gone[start + length + window - 1] -= 1
                    keep = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    off = t.offsets[i]
                    a, z = w.start[lo + keep] - off, w.end[lo + keep] - off
                    out["n_words"].append(n)
                    out["n_removed"].append(n - len(keep))
                    out["kept_text"].append(b" ".join([text[x:y] for x, y in zip(a.tolist(), z.tolist())]).decode())
                    out["factors"].append([{"start": f["start"], "length": f["windows"] + window - 1, "source": f["source"]} for f in factors])
            yield pa.RecordBatch.from_arrays([b.column(c) for c in extra] + [
                pa.array(out["n_words"], pa.int64()), pa.array(out["n_removed"], pa.int64()), pa.array(out["kept_text"], pa.string()),
                pa.array(out["factors"], pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("source", pa.int64())])))],
                [*extra, "n_words", "n_removed", "kept_text", "factors"])
    return run


def deduplicate(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text, factors) for every row of docs(doc_id, text).

    ``factors`` lists the duplicate spans in words with the document they
    were matched to.  A null text has no words; documents of fewer than
    ``window`` words lose nothing; a null doc_id comes after all others; rows
    of one doc_id are separate documents of equal rank, so none of them is
    earlier than the other; an empty table gives no rows."""
    found = stored(duplicate_windows(docs, window, gram), "windows")
    found = (found.groupBy("doc_id", "same").agg(F.collect_list(F.struct("start", "length", "source")).alias("found"))
             .select(F.col("doc_id").alias("_d"), F.col("same").alias("_s"), "found"))
    d = docs.select("doc_id", "text")
    joined = d.join(found, (F.coalesce("doc_id", F.lit(int(_LAST))) == F.col("_d")) & (same_text(F.col("text")) == F.col("_s")), "left")
    return (joined.select("doc_id", "text", "found")
            .mapInArrow(_parse(window, ["doc_id"]), "doc_id long, n_words long, n_removed long, kept_text string, "
                                                    "factors array<struct<start: int, length: int, source: long>>"))


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    d = deduplicate(table(spark, sf_dir, "documents", "doc_id", "text"))
    return d.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
