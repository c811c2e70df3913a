"""Fill-in-the-middle: SQL, brute force, exact round trip."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldlake.llm import infill
from tests.llm.helpers import SF, same_as_sql, with_clashes

TEXT = st.text(alphabet="ab\n\n<PSM>é🙂 ", max_size=40)


def plainly(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, z = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:z]), "".join(units[z:])
    form = "spm" if h4 % 100 < spm else "psm"
    return n, form, len(p), len(m), f"<P>{p}<S>{s}<M>{m}" if form == "psm" else f"<S>{s}<P>{p}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(TEXT, st.integers(0, 60), st.integers(0, 60), st.sampled_from(["psm", "spm"]))
def test_blocks_turn_and_turn_back(text, a, z, form):
    data = text.encode()
    if any(s in data for s in (b"<P>", b"<S>", b"<M>")):
        return
    a, z = sorted((a % (len(data) + 1), z % (len(data) + 1)))
    p, m, s = data[:a], data[a:z], data[z:]
    got = bytes(infill.turn(data, a, z, form))
    assert got == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    assert infill.turn_back(got, form) == data


def test_whole_table_is_as_sql(spark):
    same_as_sql(infill.op13_fill_in_middle(spark, SF), infill.OP13_SQL)


@pytest.mark.parametrize("rate,spm", [(100, 50), (40, 10), (0, 50)])
def test_odd_rows(spark, rate, spm):
    texts = [None, "", "\n", "\n\n\n", "one line", "a\nb\nc", "a\nb\nc\n", "x <P> y\nz", "<", "<\n<P\n", "é\n🙂\n日本", "\r\n\r\n", "S>\n<", "word\n" * 400_000, "y" * 3_000_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "a\nb\nc"), (5, "other"), (None, "p\nq\nr\ns"), (None, None), (-3, "m\nn")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = infill.restore(infill.fill_in_middle(with_clashes(docs), ["doc_id", "size"], rate, spm)).collect()
    want = sorted(((d, *plainly(d, t, rate, spm), t or "") for d, t in rows), key=lambda r: repr(r)[:300])
    assert len(got) == len(rows) and all(r["size"] == "x" for r in got)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got), key=lambda r: repr(r)[:300]) == want


def test_empty_table_and_sql_on_odd_rows(spark, tmp_dir):
    docs = spark.createDataFrame([(1, "a\nb"), (2, None), (3, ""), (None, "q\nr"), (4, "<M>")], "doc_id long, text string")
    docs.coalesce(1).write.parquet(tmp_dir + "/documents.parquet")
    same_as_sql(infill.op13_fill_in_middle(spark, tmp_dir), infill.OP13_SQL, documents=docs)
    assert infill.restore(infill.fill_in_middle(docs.limit(0))).count() == 0
