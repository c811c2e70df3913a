"""Token alignment against whole texts encoded by hand."""

import collections
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlake.llm import alignment, flat
from tests.llm.helpers import SF, with_clashes

TEXT = st.text(alphabet="abe x.\n\t é日🙂▁\xa0 '1<|>s/\r", max_size=60)


class Plain:
    """Whole texts, decoded bytes only: no chunks, no offsets."""

    def __init__(self):
        own = alignment.aligner(*alignment.default_paths())
        self.a, self.b = own.a, own.b
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.of = {chr(x): x for x in shown} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in shown)}

    def groups(self, text):
        if not text:
            return []
        a = [(i, bytes(self.of[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, bytes([i - 3]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()) for i in self.b.encode(text)]
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            return []
        out, p, q, left, right = [], [], [], 0, 0
        a, b = collections.deque(a), collections.deque(b)
        while a or b:
            if left <= right:
                i, x = a.popleft()
                p.append(i)
                left += len(x)
            else:
                i, x = b.popleft()
                q.append(i)
                right += len(x)
            if left == right:
                out.append((p, q))
                p, q = [], []
        return out


def plainly(rows):
    plain = Plain()
    groups = [plain.groups(t) for _, t in rows]
    links = [[(a, b) for p, q in g for a in p for b in q] for g in groups]
    count = collections.Counter(x for own in links for x in set(own))
    most = collections.Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    for (doc_id, _), g, own in zip(rows, groups, links):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        yield (doc_id, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(own), sum(count[x] == most[x[0]] for x in own), sum(count[x] for x in own),
               hashlib.sha256(text.encode()).hexdigest() if g else "")


def same(rows, df):
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, plainly(rows)))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_chunks_give_the_whole_texts_tokens(texts):
    import pyarrow as pa
    own, plain = alignment.aligner(*alignment.default_paths()), Plain()
    for t in flat.slices(alignment.spaced(pa.array(texts))):
        number, which, doc = own.chunks(t)
        for i, text in enumerate(texts):
            mine = [number[k] for k in which[doc == i]]
            ok = text and all(own.counts[5 * k] >= 0 for k in mine)
            got = b";".join(own.texts[k] for k in mine).decode() if ok else ""
            assert got == ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in plain.groups(text))


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text").collect()]
    same(rows, alignment.op12_align_tokens(spark, SF))


@pytest.mark.parametrize("block_bytes", [30, 4 << 20])
def test_odd_rows(spark, block_bytes):
    texts = [None, "", " ", "\n", "  two  blanks ", "a\nb\n\nc", "▁literal", "x▁y z", "日本語 テキスト 🙂🙂 ", "<|endoftext|> <s> </s> <unk> <0x41>",
             "tab\there\r\nnext", "wide space\xa0x y", "\x00 nul", "é" * 3000, "word " * 60_000, "y" * 60_000, "same same", "same same"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(16, "same same"), (16, "other"), (None, "same"), (None, None), (-1, "a b")]
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    same(rows, alignment.link_statistics(docs, block_bytes=block_bytes))
    plain = Plain()
    for r in alignment.align(docs, ["doc_id", "text", "size"]).collect():
        want = plain.groups(r.text)
        assert [(list(g.a), list(g.b)) for g in r.groups] == want and r.size == "x"
        data = (" " + (r.text or "")).encode()
        assert [g.start for g in r.groups] == [0, *[g.end for g in r.groups]][:len(want)] and (not want or r.groups[-1].end == len(data))


def test_empty_table_and_forgotten_chunks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"w{i} x{i % 3} common") for i in range(40)], "doc_id long, text string")
    assert alignment.link_statistics(docs.limit(0)).count() == 0 and alignment.align(docs.limit(0)).count() == 0
    monkeypatch.setattr(alignment, "MOST_CACHED", 3)
    own = alignment.Aligner(*alignment.default_paths())
    import pyarrow as pa
    for _ in range(3):
        t = next(flat.slices(alignment.spaced(pa.array(["one two three four", "five six"]))))
        number, which, doc = own.chunks(t)
        assert b";".join(own.texts[number[k]] for k in which[doc == 1]).decode() == ";".join(f"{p[0]}|{q[0]}" for p, q in Plain().groups("five six"))


def test_workers_give_memory_back_when_a_task_ends(monkeypatch):
    import pyarrow as pa
    given = []
    monkeypatch.setattr(flat, "give_back", lambda: given.append(1))
    batches = [pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two", None]})]
    for run in (alignment._blocks(alignment.default_paths(), 100), alignment._spans(alignment.default_paths(), ["doc_id"])):
        given.clear()
        made = run(iter(batches))
        assert sum(b.num_rows for b in made) > 0 and given
    # and a task that ends early
    given.clear()
    made = alignment._blocks(alignment.default_paths(), 100)(iter(batches))
    next(made)
    made.close()
    assert given
