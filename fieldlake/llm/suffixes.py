"""Exact duplicate passages by a common-prefix-aware distributed merge sort of suffixes.

Every string of ``length`` bytes contains an anchor: the place of the smallest
gram (by hash) in it.  Equal strings have their anchor at the same offset, so
only suffixes at anchors are sorted, and of those only the ones whose gram
occurs twice.  A task sorts its suffixes, each cut to ``length`` bytes, into a
run per part and front-codes it: a suffix is sent as the length of the prefix
it shares with the one before and the rest.  The part merges its runs with a
loser tree that knows, for every run's head, how much it shares with the last
suffix put out; only what lies beyond is ever compared, and the merge yields
the common prefixes of neighbours as it goes.  The bytes to the left of each
anchor travel with it, front-coded too.  Two occurrences share the window that
begins t bytes before the anchor exactly if they share t bytes to the left and
length - t to the right.

A gram with very many places would bring them all to one part.  Its windows
go by their own hashes instead, each once a run, so that no part receives more
than an entry a run of any of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat
from fieldlake.llm.common import stored, table
from fieldlake.llm.substrings import runs, same_text

LENGTH = 400
GRAM = 160
RUN_BYTES = 8 << 20     # text behind one run
PART_BYTES = 16 << 20   # text behind a part, on average
SLICE = 1 << 20
FREQUENT = 10_000       # places from which a gram's windows go by their own hashes
_BYTE = flat.mix(np.arange(1, 257, dtype=np.uint64) * flat.ODD)


def _grams(t: flat.Texts, gram: int) -> flat.Windows:
    return flat.Windows(_BYTE[t.data[:-8]])


def _anchors(length: int, gram: int):
    def run(batches):
        for b in batches:
            for t in flat.slices(b.column("text"), SLICE):
                grams = _grams(t, gram).all(gram)
                size = np.diff(t.offsets)
                inside = np.zeros(max(0, len(t.data) - 8), bool)
                row, i = flat.ragged(np.maximum(0, size - length + 1))
                inside[t.offsets[row] + i] = True
                place, _, _ = flat.anchors(grams, length - gram + 1, inside)
                ends = np.searchsorted(place, t.offsets)
                doc = np.searchsorted(t.offsets, place, "right") - 1
                some = pa.array(np.flatnonzero(np.diff(ends)))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x).take(some)
                         for x in (pa.array(grams[place].view(np.int64)), pa.array((place - t.offsets[doc]).astype(np.int32)))]
                yield pa.RecordBatch.from_arrays([b.column(c).slice(t.rows.start, len(t)).take(some) for c in ("doc_id", "same")] + lists,
                                                 ["doc_id", "same", "grams", "places"])
    return flat.tidy(run)


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (differ.bit_length() + 7) // 8


def front_code(strings: list[bytes]) -> dict:
    """Shared prefix lengths, string lengths and the rests, as binaries."""
    shared, rests, before = [], [], b""
    for s in strings:
        n = common_prefix(before, s)
        shared.append(n)
        rests.append(s[n:])
        before = s
    return {"shared": np.array(shared, "<u2").tobytes(), "sizes": np.array([len(s) for s in strings], "<u2").tobytes(), "rests": b"".join(rests)}


def front_decode(shared: bytes, sizes: bytes, rests: bytes) -> tuple[list[int], list[bytes]]:
    shared, sizes = np.frombuffer(shared, "<u2").tolist(), np.frombuffer(sizes, "<u2").tolist()
    out, before, at = [], b"", 0
    for n, size in zip(shared, sizes):
        before = before[:n] + rests[at:at + size - n]
        at += size - n
        out.append(before)
    return shared, out


def merge(runs: list[tuple[list[int], list[bytes]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Merge sorted runs (shared prefixes, strings) with a loser tree: the
    order as (run, place) and each string's common prefix with the one before.

    ``share[r]`` is what run r's head has in common with the string that beat
    it, so along the winner's path it is relative to the last string put out:
    the head that shares more is smaller, and only equal shares need a look,
    from there on."""
    heads = [0] * len(runs)
    share = [0] * len(runs)
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    losers = [-1] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); -1 is a run that has ended."""
        if a < 0 or b < 0:
            return (b, a) if a < 0 else (a, b)
        if share[a] != share[b]:
            return (a, b) if share[a] > share[b] else (b, a)
        x, y = runs[a][1][heads[a]], runs[b][1][heads[b]]
        n = common_prefix(x, y, share[a])
        first = n == len(x) or (n < len(y) and x[n] < y[n])
        win, lose = (a, b) if first else (b, a)
        share[lose] = n
        return win, lose

    level = [r if r < len(runs) and runs[r][1] else -1 for r in range(leaves)]
    width = leaves
    while width > 1:
        width //= 2
        played = [play(level[2 * i], level[2 * i + 1]) for i in range(width)]
        level = [w for w, _ in played]
        losers[width:2 * width] = [x for _, x in played]
    winner = level[0]
    order, common = [], []
    while winner >= 0:
        run = winner
        order.append((run, heads[run]))
        common.append(share[run])
        heads[run] += 1
        if heads[run] < len(runs[run][1]):
            share[run] = runs[run][0][heads[run]]
        else:
            winner = -1
        node = (leaves + run) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return order, common


_SPAN = pa.schema([("doc_id", pa.int64()), ("same", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
_BLOBS = ("shared", "sizes", "rests", "left_shared", "left_sizes", "left_rests", "twice", "has_id", "ids", "sames", "places", "hashes")
_RUN = pa.schema([("part", pa.int64()), *[(b, pa.binary()) for b in _BLOBS]])


def _spans(has_id, ids, sames, starts, ends) -> pa.Table:
    return pa.table([pa.array(ids, pa.int64(), mask=~has_id), pa.array(sames, pa.int64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], schema=_SPAN)


def _where(places: list[tuple]) -> dict:
    return {"has_id": bytes(i is not None for i, *_ in places), "ids": np.array([i or 0 for i, *_ in places], "<i8").tobytes(),
            "sames": np.array([s for _, s, *_ in places], "<i8").tobytes(), "places": np.array([p[2:] for p in places], "<i4").tobytes()}


def _row(**blobs) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([blobs], _RUN)


def _known(part: int, spans: list[tuple]) -> pa.RecordBatch:
    """Spans (doc_id, same, start, end) that need no other run pass through a part."""
    return _row(part=part, **_where(spans))


def _whole(left: int, right: int, length: int, reach: int) -> tuple[int, int]:
    """Smallest and largest t whose window lies in the text."""
    return max(0, length - right), min(reach, left)


def _runs(length: int, gram: int, parts: int, run_bytes: int = RUN_BYTES):
    """Sorted front-coded runs.  Suffixes with equal surroundings are one
    entry: if a run has it twice, all of those are duplicates at once and the
    entry goes on without places, only to be met by other runs."""
    reach = length - gram

    def send_windows(entries):
        """Of frequent grams: every window once, with its place if the run has it once."""
        surroundings: dict[tuple, list] = {}
        for _, right, left, where in entries:
            surroundings.setdefault((right, left), []).append(where)
        keys, starts = list(surroundings), []
        hashes, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for i, (right, left) in enumerate(keys):
            low, high = _whole(len(left), len(right), length, reach)
            text = np.frombuffer(left[::-1] + right, np.uint8)
            start = np.arange(len(left) - high, len(left) - low + 1)
            starts.append(start - len(left))
            if len(start):
                # with the anchor's offset: two anchors of one place must not make it a duplicate of itself
                h = flat.Windows(_BYTE[text]).at(start, length)
                hashes.append(flat.mix(h ^ (len(left) - start).astype(np.uint64) * flat.ODD))
            of.append(np.full(len(start), i))
        h, of, start = np.concatenate(hashes), np.concatenate(of), np.concatenate(starts or [np.zeros(0, np.int64)])
        many = np.array([len(surroundings[k]) for k in keys], np.int64)
        found, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        again = np.bincount(inverse, many[of], len(found)) > 1
        # windows that the run has twice are duplicates at once, everywhere in it
        spans = []
        hit = np.flatnonzero(again[inverse])
        begin = runs(start[hit], of[hit])
        for a, n in zip(hit[begin].tolist(), np.diff(begin, append=len(hit)).tolist()):
            for doc_id, same, p in surroundings[keys[of[a]]]:
                spans.append((doc_id, same, p + int(start[a]), p + int(start[a]) + n - 1 + length))
        place = [(None, 0, -1) if twice else surroundings[keys[of[i]]][0][:2] + (surroundings[keys[of[i]]][0][2] + int(start[i]),)
                 for i, twice in zip(first.tolist(), again.tolist())]
        part = (found % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cut = np.flatnonzero(np.diff(part[order], prepend=-1))
        for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
            own = order[a:z]
            yield _row(part=int(part[own[0]]), hashes=found[own].tobytes(), **_where([place[i] for i in own.tolist()]))
        if spans:
            yield _known(0 if not len(part) else int(part[0]), spans)

    def send(entries):
        yield from send_windows([e for e in entries if e[0] < 0])
        by_part: dict[int, dict] = {}
        for part, right, left, where in entries:
            if part >= 0:
                by_part.setdefault(part, {}).setdefault((right, left), []).append(where)
        for part, group in by_part.items():
            keys = sorted(group)
            once = [group[k][0] if len(group[k]) == 1 else (None, 0, -1) for k in keys]
            found = []
            for k in keys:
                low, high = _whole(len(k[1]), len(k[0]), length, reach)
                if len(group[k]) > 1 and low <= high:
                    found += [(i, s, p - high, p - low + length) for i, s, p in group[k]]
            code, left = front_code([k[0] for k in keys]), front_code([k[1] for k in keys])
            yield _row(part=part, **code, **{"left_" + n: v for n, v in left.items()}, twice=bytes(len(group[k]) > 1 for k in keys), **_where(once))
            if found:
                yield _known(part, found)

    def run(batches):
        entries, held = [], 0
        for b in flat.small(batches):
            for doc_id, same, text, anchors in zip(*(b.column(c).to_pylist() for c in ("doc_id", "same", "text", "anchors"))):
                text = text.encode()
                for a in anchors:
                    p = a["place"]
                    entries.append((a["part"], text[p:p + length], text[max(0, p - reach):p][::-1], (doc_id, same, p)))
                held += len(text)
                if held > run_bytes:
                    yield from send(entries)
                    entries, held = [], 0
        yield from send(entries)
    return flat.tidy(run)


def _match(length: int, gram: int):
    reach = length - gram

    def run(rows: pa.Table) -> pa.Table:
        heads, lefts, twice, places, windows, out = [], [], [], [], [], []
        for r in rows.to_pylist():
            where = (np.frombuffer(r["has_id"], bool), np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["sames"], "<i8"))
            if r["hashes"] is not None:
                windows.append((np.frombuffer(r["hashes"], np.uint64), *where, np.frombuffer(r["places"], "<i4")))
                continue
            if r["shared"] is None:
                ends = np.frombuffer(r["places"], "<i4").reshape(-1, 2)
                out.append(_spans(*where, ends[:, 0], ends[:, 1]))
                continue
            heads.append(front_decode(r["shared"], r["sizes"], r["rests"]))
            lefts.append(front_decode(r["left_shared"], r["left_sizes"], r["left_rests"])[1])
            twice.append(np.frombuffer(r["twice"], bool))
            places.append((*where, np.frombuffer(r["places"], "<i4")))
        if windows:
            h, has, ids, sames, start = (np.concatenate(x) for x in zip(*windows))
            _, inverse, count = np.unique(h, return_inverse=True, return_counts=True)
            hit = np.flatnonzero((count[inverse] > 1) & (start >= 0))
            out.append(_spans(has[hit], ids[hit], sames[hit], start[hit], start[hit] + length))
        if heads:
            order, common = merge(heads)
            base = np.cumsum([0] + [len(x) for x in lefts])
            at = np.array([base[r] + i for r, i in order], np.int64)
            right_size = np.array([len(heads[r][1][i]) for r, i in order])
            left = [lefts[r][i] for r, i in order]
            low, high = shared_windows(np.array(common), right_size, left, np.concatenate(twice)[at], length, reach)
            has, ids, sames, place = (np.concatenate(x)[at] for x in zip(*places))
            hit = np.flatnonzero((low <= high) & (place >= 0))
            out.append(_spans(has[hit], ids[hit], sames[hit], place[hit] - high[hit], place[hit] - low[hit] + length))
        return pa.concat_tables(out) if out else _SPAN.empty_table()

    def tidied(rows: pa.Table) -> pa.Table:
        found = run(rows)
        flat.give_back()
        return found
    return tidied


def shared_windows(common: np.ndarray, right_size: np.ndarray, left: list[bytes], twice: np.ndarray, length: int, reach: int):
    """For suffixes in sorted order the smallest and largest t at which
    another one shares the window from t bytes before the anchor (low > high
    if none does).  All windows of an anchor contain it, so what lies between
    is covered too."""
    n = len(left)
    by_left = np.array(sorted(range(n), key=left.__getitem__), np.int64)
    left_common = np.array([0] + [common_prefix(left[a], left[b]) for a, b in zip(by_left[:-1], by_left[1:])], np.int64)
    left_size = np.array([len(x) for x in left])
    follows = np.append(common[1:], -1)
    next_left = np.append(left_common[1:], -1)
    common, left_common = common.copy(), left_common.copy()
    common[:1] = left_common[:1] = -1
    right_most = np.maximum(common, follows)          # longest that any other suffix shares to the right
    left_most = np.empty(n, np.int64)
    left_most[by_left] = np.maximum(left_common, next_left)
    right_most[twice], left_most[twice] = right_size[twice], left_size[twice]
    low, high = np.full(n, reach + 1), np.full(n, -1)
    for t in range(reach + 1):
        use = np.flatnonzero((right_size >= length - t) & (left_size >= t) & (right_most >= length - t) & (left_most >= t))
        if not len(use):
            continue
        right_class = np.cumsum(common < length - t)
        left_class = np.empty(n, np.int64)
        left_class[by_left] = np.cumsum(left_common < t)
        _, inverse, count = np.unique(right_class[use] * np.int64(n + 1) + left_class[use], return_inverse=True, return_counts=True)
        hit = use[(count[inverse] > 1) | twice[use]]
        low[hit] = np.minimum(low[hit], t)
        high[hit] = t
    return low, high


def duplicate_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, part_bytes: int = PART_BYTES,
                    frequent: int = FREQUENT, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(doc_id, same, start, end): byte spans covered by strings of ``length`` bytes that occur elsewhere too."""
    d = docs.select("doc_id", "text", same_text(F.col("text")).alias("same"))
    parts = max(1, -(-(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // part_bytes))
    anchors = stored(d.mapInArrow(_anchors(length, gram), "doc_id long, same long, grams array<long>, places array<int>"), "anchors")
    one = anchors.select("doc_id", "same", F.inline(F.arrays_zip(F.col("grams").alias("gram"), F.col("places").alias("place"))))
    # stored, so that the join below deals both sides anew and Spark can split a gram with very many places
    repeated = stored(one.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "repeated-grams")
    part = F.when(F.col("n") >= frequent, -1).otherwise(F.pmod(F.xxhash64("gram"), F.lit(parts))).cast("long")
    kept = stored(one.join(repeated, "gram").groupBy("doc_id", "same")
                  .agg(F.collect_set(F.struct("place", part.alias("part"))).alias("anchors"))
                  .select(F.col("doc_id").alias("_d"), F.col("same").alias("_s"), "anchors"), "repeated-anchors")
    schema = "part long, " + ", ".join(f"{b} binary" for b in _BLOBS)
    return (d.join(kept, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("same") == F.col("_s")))
            .select("doc_id", "same", "text", "anchors").mapInArrow(_runs(length, gram, parts, run_bytes), schema)
            .groupBy("part").applyInArrow(_match(length, gram), "doc_id long, same long, start int, end int"))


def _cut(batches):
    for b in flat.small(batches):
        n_bytes, n_removed, kept, readable, spans = [], [], [], [], []
        for text, found in zip(b.column("text").to_pylist(), b.column("found").to_pylist()):
            absent, text = text is None, (text or "").encode()
            merged: list[list[int]] = []
            for start, end in sorted((f["start"], f["end"]) for f in found or ()):
                if merged and start <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([start, end])
            edges = [0, *[x for s in merged for x in s], len(text)]
            n_bytes.append(len(text))
            n_removed.append(sum(e - s for s, e in merged))
            rest = [text[a:z] for a, z in zip(edges[::2], edges[1::2])]
            kept.append(b"".join(rest))
            readable.append(None if absent else "".join(x.decode(errors="ignore") for x in rest))
            spans.append([{"start": s, "end": e} for s, e in merged])
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in b.schema.names if c not in ("text", "found")], pa.array(n_bytes, pa.int64()),
                                          pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()), pa.array(readable, pa.string()),
                                          pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                                         [*[c for c in b.schema.names if c not in ("text", "found")], "n_bytes", "n_removed", "kept", "kept_text", "spans"])


def deduplicate(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: list[str] = ["doc_id"],  # noqa: B006
                frequent: int = FREQUENT, part_bytes: int = PART_BYTES, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The ``keep`` columns with n_bytes, n_removed, kept (binary), kept_text and spans of every row of docs(doc_id, text).

    Every byte covered by a string of ``length`` bytes that also starts
    elsewhere, in any document, is removed, all occurrences alike.  A null text
    counts as empty; texts shorter than ``length`` lose nothing; repeated rows
    are occurrences of their own; null ids are kept; an empty table gives no
    rows.  A span may begin or end inside a UTF-8 character; ``kept_text`` drops what
    is left of such characters, and is null where the text is."""
    found = stored(duplicate_spans(docs, length, gram, part_bytes, frequent, run_bytes), "spans")
    found = (found.groupBy("doc_id", "same").agg(F.collect_set(F.struct("start", "end")).alias("found"))
             .select(F.col("doc_id").alias("_d"), F.col("same").alias("_s"), "found"))
    names = list(dict.fromkeys([*keep, "doc_id", "text"]))
    d = docs.select(*names)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.select(*[c for c in names if c != "text"]).schema]
    return (d.join(found, d["doc_id"].eqNullSafe(F.col("_d")) & (same_text(F.col("text")) == F.col("_s")), "left")
            .select(*names, "found")
            .mapInArrow(flat.tidy(_cut), ", ".join(kept) + ", n_bytes long, n_removed long, kept binary, kept_text string, spans array<struct<start: int, end: int>>")
            .select(*keep, "n_bytes", "n_removed", "kept", "kept_text", "spans"))


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    d = deduplicate(table(spark, sf_dir, "documents", "doc_id", "text"))
    return d.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
