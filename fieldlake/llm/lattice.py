"""Document likelihood over all segmentations into subwords.

The pieces of an existing vocabulary span a lattice over each word; a path
through it is a segmentation, and the forward recursion adds up all of them in
log space, so a word's probability does not hang on one segmentation.  A word
is its bytes behind one blank (the mark of a word's beginning); no piece goes
on into the next word, so a document's probability is the product of its
words' and of the end's.  Every byte is a piece, so every text has a path.

The vocabulary's own scores give the first probabilities: of a file with merge
ranks by Zipf's law, of one with log probabilities by these.  They stay in as
pseudo-counts while forward and backward recursions over the training words
(each distinct word once, weighted by its count) expect new counts.

What each document needs is summed from its words.  A block of documents asks
for each distinct word once (see blocks.py); nothing is broadcast but the
vocabulary."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import blocks, flat
from fieldlake.llm.common import stored, table

BLOCK_BYTES = 4 << 20
SLICE_BYTES = 1 << 18   # words whose lattices are in memory together
ROUNDS = 3              # re-estimations of the pieces' probabilities
END = "</s>"
LN10 = np.log(10)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The byte strings of a vocabulary file that can occur in a word, and
    their first probabilities; the end is the last entry, without bytes."""

    def __init__(self, strings: list[bytes], first: np.ndarray):
        self.strings, self.first = strings, first / first.sum()
        size = np.array([len(s) for s in strings])
        self.longest = int(size.max())
        # for each length the beginnings of pieces, as keys of up to eight bytes a word, and the piece that ends there
        padded = np.zeros((len(strings), -(-self.longest // 8) * 8 + 8), np.uint8)
        for i, s in enumerate(strings):
            padded[i, :len(s)] = np.frombuffer(s, np.uint8)
        words = padded.view("<u8")
        self.steps = []   # for each length: sorted (number of the beginning one shorter, next byte), piece or -1
        node = np.zeros(len(strings), np.int64)
        for n in range(self.longest):
            use = np.flatnonzero(size > n)
            key = node[use] * 256 + padded[use, n]
            keys, inverse = np.unique(key, return_inverse=True)
            ends = np.full(len(keys), -1)
            done = size[use] == n + 1
            ends[inverse[done]] = use[done]
            self.steps.append((keys, ends))
            node[use] = inverse
        del words

    @classmethod
    def read(cls, path: str, ranks: bool = True) -> "Pieces":
        """``ranks``: scores are negative merge ranks, not log probabilities."""
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        scores, byte = {}, []
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                byte.append(bytes([int(model.id_to_piece(i)[3:5], 16)]))
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                s = model.id_to_piece(i).replace("▁", " ")
                # words are lower-case and have their only blank in front
                if " " not in s[1:] and not any("A" <= c <= "Z" for c in s):
                    scores[s.encode()] = model.get_score(i)
        least = min(scores.values(), default=0.0)
        for b in byte:
            scores.setdefault(b, least)
        strings = sorted(scores)
        score = np.array([scores[s] for s in strings])
        return cls(strings, 1 / (1 - score) if ranks else np.exp(score - score.max()))

    def arcs(self, t: flat.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first byte, length, piece) of every piece at every place of the
        words ``t``: all places step through the pieces' beginnings together,
        and those go on where a longer piece may still come."""
        at = np.arange(len(t.data) - 8)
        left = np.repeat(t.offsets[1:], np.diff(t.offsets)) - at
        node, out = np.zeros(len(at), np.int64), []
        for n, (keys, ends) in enumerate(self.steps):
            key = node * 256 + t.data[at + n]
            found = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[found] == key
            at, left, found = at[hit], left[hit], found[hit]
            piece = ends[found]
            is_piece = piece >= 0
            out.append((at[is_piece], np.full(np.count_nonzero(is_piece), n + 1), piece[is_piece]))
            more = left > n + 1
            at, left, node = at[more], left[more], found[more]
            if not len(at):
                break
        return tuple(np.concatenate(x) for x in zip(*out))


@functools.lru_cache(2)
def pieces(path: str, ranks: bool = True) -> Pieces:
    return Pieces.read(path, ranks)


def _recursion(nodes: int, begin: np.ndarray, origin: np.ndarray, target: np.ndarray, order: np.ndarray, step: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log of the summed weight of all paths from ``begin`` to each node; arcs
    go from ``origin`` to ``target`` and come in ``order``, where all arcs of a
    ``step`` start at nodes that earlier steps have finished."""
    total = np.full(nodes, -np.inf)
    total[begin] = 0.0
    origin, target, weight = origin[order], target[order], weight[order]
    first = np.flatnonzero(np.diff(target, prepend=-1))
    of = step[order][first]
    cut = np.flatnonzero(np.diff(of, prepend=-1))
    bounds = np.append(first, len(target))
    for a, z in zip(cut.tolist(), [*cut[1:].tolist(), len(first)]):
        lo, hi = bounds[a], bounds[z]
        x = total[origin[lo:hi]] + weight[lo:hi]
        group = first[a:z] - lo
        most = np.maximum.reduceat(x, group)
        size = np.diff(bounds[a:z + 1])
        total[target[first[a:z]]] = most + np.log(np.add.reduceat(np.exp(x - np.repeat(most, size)), group))
    return total


class Lattice:
    """The lattices of the words ``t``, each with its leading blank."""

    def __init__(self, t: flat.Texts, vocabulary: Pieces):
        self.n = len(t)
        start, size, self.piece = vocabulary.arcs(t)
        # a word of n bytes has n + 1 nodes
        word = np.searchsorted(t.offsets, start, "right") - 1
        self.source, self.target = start + word, start + word + size
        self.begin, self.end = t.offsets[:-1] + np.arange(self.n), t.offsets[1:] + np.arange(self.n)
        self.forth = self.target - self.begin[word]
        self.back = self.end[word] - self.source
        self.nodes = int(self.end[-1]) + 1 if self.n else 0
        self.word = word

    def forward(self, score: np.ndarray) -> np.ndarray:
        return _recursion(self.nodes, self.begin, self.source, self.target, np.lexsort((self.target, self.forth)), self.forth, score[self.piece])

    def log_probability(self, score: np.ndarray) -> np.ndarray:
        return self.forward(score)[self.end]

    def expected(self, score: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Expected number of each piece in ``count`` occurrences of each word."""
        forward = self.forward(score)
        backward = _recursion(self.nodes, self.end, self.target, self.source, np.lexsort((self.source, self.back)), self.back, score[self.piece])
        share = np.exp(forward[self.source] + score[self.piece] + backward[self.target] - forward[self.end][self.word])
        return np.bincount(self.piece, share * count[self.word], len(score))


def marked(column) -> pa.Array:
    """The words behind their blank."""
    return pc.binary_join_element_wise(pa.scalar(b" "), column.cast(pa.binary()), b"")


def _blocks(block_bytes: int):
    """One row a block: its documents, its distinct words, how often training
    documents hold each, and which words each document has."""
    def run(batches):
        for b in batches:
            ids, out_of = b.column("doc_id"), b.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for t in blocks.slices(b.column("text"), block_bytes):
                low = flat.Texts(np.concatenate([_LOWER[t.data[:-8]], t.data[-8:]]), t.offsets, t.rows)
                w = flat.Words(low)
                _, first, key = np.unique(w.hashes(low), return_index=True, return_inverse=True)
                start, size = w.start[first], w.end[first] - w.start[first]
                row, i = flat.ragged(size)
                words = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.append(0, np.cumsum(size)).astype(np.int32)), pa.py_buffer(low.data[start[row] + i]))
                held_out = out_of[t.rows.start:t.rows.start + len(t)]
                train = np.bincount(key, ~held_out[w.doc], len(first)).astype(np.int64)
                packed = blocks.vectors(*blocks.held(w.doc, key, len(first)), len(first))
                yield pa.RecordBatch.from_arrays([
                    blocks.lists(ids.slice(t.rows.start, len(t)), pa.int64()), blocks.lists(held_out, pa.bool_()), blocks.lists(w.count, pa.int64()),
                    blocks.lists(words, pa.string()), blocks.lists(train, pa.int64()), *packed.values()],
                    ["ids", "held_out", "words_of", "keys", "train", *packed])
    return run


def document_blocks(docs: DataFrame, held_out, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    d = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    made = d.mapInArrow(_blocks(block_bytes), "ids array<long>, held_out array<boolean>, words_of array<long>, keys array<string>, train array<long>, " + blocks.VECTORS)
    return stored(made.withColumn("block", F.monotonically_increasing_id()), "lm-blocks")


def _expect(path: str, ranks: bool, score: np.ndarray):
    def run(batches):
        v, total = pieces(path, ranks), np.zeros(len(score))
        for b in batches:
            count = b.column("train").to_numpy(zero_copy_only=False)
            for t in flat.slices(marked(b.column("key")), SLICE_BYTES):
                total += Lattice(t, v).expected(score, count[t.rows.start:t.rows.start + len(t)])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["piece", "expected"])
    return run


def train(words: DataFrame, ends: int, path: str, ranks: bool = True, rounds: int = ROUNDS) -> np.ndarray:
    """Log probability of every piece and, last, of the end, from
    words(key, train) and the number of training documents.  The driver
    receives one number a piece: the vocabulary bounds it."""
    v = pieces(path, ranks)
    seen, score = words.where("train > 0"), np.log(v.first)
    for _ in range(rounds):
        sums = seen.mapInArrow(_expect(path, ranks, score), "piece int, expected double").groupBy("piece").agg(F.sum("expected").alias("expected"))
        count = len(v.strings) * v.first   # as pseudo-counts, one a piece on average
        got = sums.toArrow()
        count[blocks.column(got, "piece")] += blocks.column(got, "expected")
        # words only here; the end takes its own share below
        score = np.log(count) - np.log(count.sum())
    if not rounds:
        count = v.first
    end = ends + 1.0   # one pseudo-count more
    return np.append(np.log(count), np.log(end)) - np.log(count.sum() + end)


def _word_scores(path: str, ranks: bool, score: np.ndarray):
    def run(batches):
        v = pieces(path, ranks)
        for b in batches:
            for t in flat.slices(marked(b.column("key")), SLICE_BYTES):
                yield pa.RecordBatch.from_arrays([*b.slice(t.rows.start, len(t)).select(["key", "train"]).columns,
                                                  pa.array(Lattice(t, v).log_probability(score[:-1]))], ["key", "train", "log_p"])
    return run


def word_scores(words: DataFrame, score: np.ndarray, path: str, ranks: bool = True) -> DataFrame:
    """words(key, train) with log_p, the natural log of each word's probability over all segmentations."""
    return words.select("key", "train").mapInArrow(_word_scores(path, ranks, score), "key string, train long, log_p double")


def _documents(n_train: int, distinct: int, ends: int, end_score: float):
    least = -np.log10(n_train + distinct + 1)

    def run(block: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for i in range(block.num_rows):
            own = {c: block.column(c).combine_chunks()[i].values for c in ("ids", "held_out", "words_of")}
            packed = {c: block.column(c)[i].as_py() for c in ("n_keys", "n_pairs", "steps", "times")}
            n, keys = len(own["ids"]), packed["n_keys"]
            seen, log_p = blocks.at_places(found, "train", keys), blocks.at_places(found, "log_p", keys)
            doc, of, times = blocks.unpack_vectors(packed)
            total = lambda x: np.bincount(doc, times * x[of], n)  # noqa: E731, B023
            base = total(np.log10(seen + 1) + least) + np.log10(ends + 1) + least
            out.append(pa.table([own["ids"], own["held_out"], pa.array(own["words_of"].to_numpy(zero_copy_only=False) + 1),
                                 pa.array((total((seen > 0).astype(float)) + (ends > 0)).astype(np.int64)), pa.array(np.full(n, n_train)), pa.array(base),
                                 pa.array((total(log_p) + end_score) / LN10)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.concat_tables(out)
    return run


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def likelihoods(docs: DataFrame, held_out, path: str | None = None, ranks: bool = True, rounds: int = ROUNDS,
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score
    of every row of docs(doc_id, text); ``held_out`` is the condition that keeps
    a document from training.

    Tokens are the words and one end.  ``base_score`` is their add-one unigram
    log10 probability, ``score`` the lattice's.  A null or empty text is the end
    alone; a null id is its own row, and held out only if the condition is true
    for it; repeated rows count and score each; without training documents the
    vocabulary's own scores remain; an empty table gives no rows.  Words of a
    block are told apart by 64-bit hashes, across blocks by their bytes."""
    path = path or default_vocabulary()
    made = document_blocks(docs, held_out, block_bytes)
    words = stored(made.select(F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("train").alias("train"))))
                   .groupBy("key").agg(F.sum("train").alias("train")), "lm-words")
    n, distinct = words.agg(F.coalesce(F.sum("train"), F.lit(0)), F.count_if(F.col("train") > 0)).first()
    ends = made.select(F.coalesce(F.sum(F.size(F.filter("held_out", lambda x: ~x))), F.lit(0))).first()[0]
    score = train(words, ends, path, ranks, rounds)
    values = word_scores(words, score, path, ranks)
    return blocks.look_up(made, values, _documents(n + ends, distinct + (ends > 0), ends, float(score[-1])), _OUT, ("train",))


def op11_lattice_likelihood(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return likelihoods(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
