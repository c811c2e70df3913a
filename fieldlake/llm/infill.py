"""Fill-in-the-middle documents by block rotations in place.

A document is cut into lines; a prefix, a middle and a suffix of whole lines
are chosen by digests of its id.  Sentinels are inserted before each part in
one bytearray, and two neighbouring blocks are exchanged by three reversals:
the first block, the second and then both together.  Turning the same blocks
back and taking the sentinels out restores the text exactly.

No row meets another, so nothing is shuffled."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlake.llm import flat
from fieldlake.llm.common import table

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
RATE = 100      # percent of documents that are turned
SPM_RATE = 50   # percent of those whose suffix comes first
SEED = "7"


def exchange(buffer: bytearray, start: int, middle: int, end: int) -> None:
    """Swap the blocks [start, middle) and [middle, end) by three reversals."""
    view = np.frombuffer(buffer, np.uint8)
    for a, z in ((start, middle), (middle, end), (start, end)):
        view[a:z] = view[a:z][::-1]


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends: after its line feed, or at the end of the text."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x0A) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def draws(doc_id, seed: str = SEED) -> list[int]:
    """Four integers that follow from the seed and the id; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def turn(text: bytes, first: int, second: int, form: str) -> bytearray:
    """The text with its middle, bytes ``first`` to ``second``, moved to the end."""
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    exchange(buffer, middle if form == "psm" else 0, suffix, len(buffer))
    return buffer


def turn_back(output: bytes, form: str) -> bytes:
    """The text from what ``turn`` made of it; plain output is the text itself."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        suffix = buffer.index(SUFFIX)
        at = buffer.index(MIDDLE, suffix)
        exchange(buffer, suffix, at, len(buffer))
        middle, suffix = suffix, suffix + len(buffer) - at
    else:
        at = buffer.index(PREFIX)
        middle, suffix = buffer.index(MIDDLE, at) - at, len(buffer) - at
        exchange(buffer, 0, at, len(buffer))
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[at:at + len(sentinel)]
    return bytes(buffer)


def _code_points(part: np.ndarray) -> int:
    return int(np.count_nonzero((part & 0xC0) != 0x80))


def _turned(keep: list[str], rate: int, spm_rate: int, seed: str):
    def run(batches):
        for b in batches:
            ids = b.column("doc_id")
            for t in flat.slices(b.column("text")):
                rows = []
                for i, row in enumerate(t.rows):
                    text = t.text(i)
                    ends = line_ends(text)
                    h1, h2, h3, h4 = draws(ids[row].as_py(), seed)
                    n = len(ends)
                    if not text or h3 % 100 >= rate or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
                        rows.append((n, "plain", None, None, text))
                        continue
                    first, second = (int(ends[k - 1]) if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
                    form = "spm" if h4 % 100 < spm_rate else "psm"
                    points = np.frombuffer(text, np.uint8)
                    rows.append((n, form, _code_points(points[:first]), _code_points(points[first:second]), bytes(turn(text, first, second, form))))
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [b.column(c).slice(t.rows.start, len(t)) for c in keep]
                    + [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                    [*keep, "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, keep: list[str] = ["doc_id"], rate: int = RATE, spm_rate: int = SPM_RATE,  # noqa: B006
                   seed: str = SEED) -> DataFrame:
    """The ``keep`` columns with n, form, prefix_chars, middle_chars and output
    of every row of docs(doc_id, text).

    ``rate`` percent of the documents are turned, of those ``spm_rate`` percent
    with the suffix first (spm), the others with the prefix first (psm).  A null
    or empty text, and one that holds a sentinel already, stays plain and has
    no prefix_chars and middle_chars; a null text gives an empty output.
    Repeated rows come out alike; a null id draws as one without digits; an
    empty table gives no rows."""
    names = list(dict.fromkeys([*keep, "doc_id", "text"]))
    d = docs.select(*names)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in d.select(*keep).schema]
    return d.mapInArrow(_turned(keep, rate, spm_rate, seed), ", ".join(kept) + ", n long, form string, prefix_chars long, middle_chars long, output string")


def _restored(batches):
    for b in batches:
        forms = b.column("form")
        for t in flat.slices(b.column("output")):
            texts = pa.array([turn_back(t.text(i), forms[row].as_py()) for i, row in enumerate(t.rows)], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.slice(t.rows.start, len(t)).columns, texts], [*b.schema.names, "restored"])


def restore(turned: DataFrame) -> DataFrame:
    """The rows with ``restored``, the text rebuilt from output and form alone."""
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in turned.schema]
    return turned.mapInArrow(_restored, ", ".join(columns) + ", restored string")


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    d = restore(fill_in_middle(table(spark, sf_dir, "documents", "doc_id", "text")))
    return d.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                    F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))


# list_slice counts from 1; the prefix is the first `a` lines, the middle ends with line `z`
OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
h AS (
  SELECT doc_id, text, lines, len(lines) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT doc_id, text, lines, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT doc_id, text, n, form, array_to_string(list_slice(lines, 1, a), '') AS prefix,
         array_to_string(list_slice(lines, a + 1, z), '') AS middle, array_to_string(list_slice(lines, z + 1, n), '') AS suffix
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
