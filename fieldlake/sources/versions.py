"""Tables that change together.

Each build writes its tables into a folder of its own and then creates one
small commit file, ``_commits/<number>.json`` (table name -> folder).  Readers
take the newest commit that is whole, so a build that dies on the way leaves
them on the last one; nothing is overwritten in place.  The file is created
exclusively: of two builds that started from the same commit the second fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

_COMMITS = "_commits"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _join(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, p = _fs(spark, _join(root, _COMMITS))
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)


def head(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """(number of the newest commit file, tables of the newest whole one);
    (0, {}) where nothing was committed."""
    numbers = _numbers(spark, root)
    for n in numbers:
        fs, p = _fs(spark, _join(root, _COMMITS, f"{n:012d}.json"))
        stream = fs.open(p)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return numbers[0], json.loads(text)["tables"]
        except (ValueError, KeyError):
            continue          # its writer died: the commit before it holds
    return 0 if not numbers else numbers[0], {}


def new_folder(root: str) -> str:
    """A folder for one build's tables."""
    return _join(root, f"build-{uuid.uuid4().hex}")


def commit(spark: SparkSession, root: str, base: int, tables: dict[str, str]) -> int:
    """Make ``tables`` (name -> folder) the current ones in one step; ``base``
    is the number that :func:`head` gave when the build began.  Raises if
    another build has committed since.  Folders below ``root`` are noted
    relative to it, so the whole can be moved."""
    prefix = _join(root, "")
    noted = {k: v[len(prefix):] if v.startswith(prefix) else v for k, v in tables.items()}
    fs, p = _fs(spark, _join(root, _COMMITS, f"{base + 1:012d}.json"))
    if fs.exists(p):
        raise RuntimeError(f"commit {base + 1} of {root} was made by another build")
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps({"tables": noted}, sort_keys=True).encode()))
    finally:
        out.close()
    return base + 1


def table_path(spark: SparkSession, root: str, name: str) -> str | None:
    """Folder of the committed table, None without one."""
    at = head(spark, root)[1].get(name)
    return at if at is None or "/" == at[:1] or "://" in at else _join(root, at)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    at = table_path(spark, root, name)
    if at is None:
        raise LookupError(f"no committed table {name} in {root}")
    return spark.read.parquet(at)


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete build folders that none of the newest ``keep`` whole commits
    names; returns them.  Not to be run beside a build, whose folder no commit
    names yet."""
    used, whole = set(), 0
    for n in _numbers(spark, root):
        fs, p = _fs(spark, _join(root, _COMMITS, f"{n:012d}.json"))
        stream = fs.open(p)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            tables = json.loads(text)["tables"]
        except (ValueError, KeyError):
            continue
        used |= {v.split("/")[0] for v in tables.values()}
        whole += 1
        if whole == keep:
            break
    fs, p = _fs(spark, root)
    gone = []
    for st in fs.listStatus(p) if whole else []:
        name = st.getPath().getName()
        if name.startswith("build-") and name not in used:
            fs.delete(st.getPath(), True)
            gone.append(name)
    return sorted(gone)
