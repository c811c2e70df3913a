"""Mixing, licence scan and URL filter against their SQL, on the test tables and on odd input."""

import collections
import textwrap

import pytest
from pyspark.sql import functions as F

from fieldlake.llm import licences, mixing, queries, urls
from tests.llm.helpers import SF, same_as_sql, with_clashes


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    same_as_sql(queries.QUERIES[name](spark, SF), queries.SQL[name])


def test_oracles_are_sql_texts():
    assert all(isinstance(sql, str) for sql in queries.SQL.values())
    assert set(queries.SQL) <= set(queries.QUERIES)


DOCS = [(1, "a b c " * 40, "s1"), (1, "a b c " * 40, "s1"), (2, None, "s1"), (3, "", None), (4, "x\ty\nz" * 30, None), (None, "q " * 500, "s2"),
        (None, None, "s2"), (5, "é ß " * 33, "S1"), (6, "w " * 2000, "s3"), (7, "  ", "s4")]


def test_mix_odd_rows(spark):
    docs = with_clashes(spark.createDataFrame(DOCS, "doc_id long, text string, source string"))
    got = mixing.mixed(docs).drop("source", "key")
    same_as_sql(got, mixing.OP2_SQL, documents=docs.select("doc_id", "text", "source"))
    for r in got.collect():
        assert 0 <= r.taken <= 2 * r.size
    by = collections.defaultdict(lambda: [0, 0.0])
    for r in mixing.mixed(docs).collect():
        by[r.source][0] += r.taken
        by[r.source][1] = r.target
    for taken, target in by.values():
        assert abs(taken - target) <= 2 * mixing.BLOCK_WORDS
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_apportion_is_highest_quotients(spark):
    votes = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.5, "e": 0.0}
    for seats in (1, 7, 10, 101):
        won = collections.Counter()
        for _ in range(seats):
            best = min(votes, key=lambda k: (-votes[k] / (2 * won[k] + 1), k))
            won[best] += 1
        df = spark.createDataFrame([(k, v, seats) for k, v in votes.items()], "k string, v double, seats long")
        assert {r.k: r.quota for r in mixing.apportion(df, [], "k", "v", "seats").collect()} == {k: won[k] for k in votes}


def test_water_fill(spark):
    s = spark.createDataFrame([("a", 10), ("b", 1000), (None, 50), ("z", 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.water_fill(s).collect()}
    assert got["a"] == 20 and got["z"] == 0 and got[None] <= 100
    assert abs(sum(got.values()) - 1.5 * 1060) < 1e-6


def test_apply_mix_repeats_whole_texts(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, source string")
    rows = mixing.apply_mix(with_clashes(docs)).select("doc_id", "text").collect()
    known = {(d, t) for d, t, _ in DOCS}
    assert rows and {tuple(r) for r in rows} <= known
    assert max(collections.Counter(map(tuple, rows)).values()) <= 4  # two equal rows, twice each


def test_url_odd_rows(spark):
    pages = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.COM"), (5, "http://A.COM/"), (6, "x://www.Example.com/en/x?y"),
             (7, "x://www.example.com/fr/#"), (8, "x://m.example.com/en/"), (9, "x://badexample.com/en/"), (10, "x://a.net/es/1"),
             (11, "x://net/fr/"), (11, "x://net/fr/"), (12, "x://a.org/é?"), (None, "x://a.org/en/1"), (13, "://"), (14, "a://b://c")]
    df = with_clashes(spark.createDataFrame(pages, "page_id long, url string"))
    got = urls.judge(df).drop("score")
    same_as_sql(got, urls.OP5_SQL, pages=df.select("page_id", "url"))
    by = {r.page_id: r for r in got.collect()}
    assert (by[4].rule, by[5].rule, by[6].rule, by[7].rule, by[8].rule, by[9].rule) == (
        None, "com/", "www.example.com/en/", "com/", "example.com/en/", "com/")
    assert (by[1].host, by[1].path, by[3].host) == ("", "", "")
    assert urls.judge(df.limit(0)).count() == 0
    undecided = urls.judge(df.where("page_id IN (1, 12)"))
    assert {r.verdict for r in undecided.collect()} == {"allow"}


def test_url_model_prefers_like_urls(spark):
    pages = [(i, f"x://good{i}.com/aaa/aab/{i}") for i in range(40)] + [(100 + i, f"x://z{i}.net/es/zzz/zyz/{i}") for i in range(40)]
    pages += [(200, "x://a.org/aaa/aab/aaa/aab"), (201, "x://z.org/es/zzz/zyz/zzz")]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string")).collect()}
    assert (got[200], got[201]) == ("allow", "block")


def test_url_tables_are_not_broadcast(spark, monkeypatch):
    """Not even where all are small: windows look as small as the file of their urls."""
    pages = [(i, f"x://good{i}.com/aaa/{i}") for i in range(9)] + [(100 + i, f"x://z{i}.net/es/{i}") for i in range(9)]
    df = spark.createDataFrame(pages + [(200, "x://a.org/" + "ab" * 1000), (201, "x://a.org/"), (201, "x://a.org/")], "page_id long, url string")
    plans = []

    def ran(frame):
        frame.collect()
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return frame

    for name in ("stored", "calibrated"):
        monkeypatch.setattr(urls, name, lambda frame, *a, step=getattr(urls, name): step(ran(frame), *a))
    ran(urls.judge(df))
    assert len(plans) == 6 and sum("SortMergeJoin" in p for p in plans) == 3
    assert not [p for p in plans if "Broadcast" in p]


def test_licence_forms(spark):
    mit = dict(licences.LICENCES[:1])["MIT"]
    docs = [(1, "Copyright (c) 2020 Some One\n\n" + mit.upper().replace(",", " ;")), (2, mit.replace("sublicense", "sub-licence")), (3, mit + " and more"),
            (4, "text\nreleased under the MIT licence\nLicensed under CC BY-NC 4.0.\n"), (5, None), (6, "..."), (None, "Licensed under CC BY-NC 4.0."),
            (7, "© me"), (4, "other")]
    df = with_clashes(spark.createDataFrame(docs, "doc_id long, text string"))
    got = licences.scan(df)
    same_as_sql(got, licences.OP3_SQL, documents=df.select("doc_id", "text"))
    by = {(r.doc_id, r.n_license_lines): r for r in got.collect()}
    assert by[(1, 0)].license == by[(2, 0)].license == "MIT" and by[(3, 0)].license is None
    assert by[(4, 2)].line_licenses == "CC-BY-NC-4.0,MIT" and by[(4, 0)].line_licenses is None
    assert by[(None, 1)].license == "CC-BY-NC-4.0"
    assert licences.scan(df.limit(0)).count() == 0
    assert licences.scan(df.select("doc_id", F.col("text"))).count() == len(docs)


def test_licences_wrapped_commented_and_on_one_line(spark):
    """A licence is known however its lines are broken, and whatever copyright statement stands before it."""
    texts = {n: t for n, t in reversed(licences.LICENCES) if "\n" in t and "License\n\n" not in t}
    assert set(texts) == {"MIT", "ISC", "0BSD", "BSD-2-Clause"}
    docs, want = [], {}
    for name, text in texts.items():
        forms = ["\n\n".join(textwrap.fill(" ".join(p.split()), w) for p in text.split("\n\n")) for w in range(58, 101)]
        forms += [" ".join(text.split()), text.replace("\n", "\r\n"), text.replace("\n", "\r")]
        for statement in ("Copyright (c) 2020 A B", "Copyright 2020 A B", "Copyright (C) A B", "Copyright © 1999-2001 A", "(c) 2020 A", "© A"):
            own = statement + "\n\n" + text
            forms += [own, own.replace("\n", "\r\n"), own.replace("\n", "\r"),
                      *("\n".join(lead + x for x in own.split("\n")) for lead in ("// ", "# ", " * ", ";; ", "-- "))]
        for f in forms:
            want[len(docs)] = name
            docs.append((len(docs), f))
    got = licences.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.license for r in got} == want
    # a text's own lines stay; a lone carriage return ends a line
    own = licences.scan(spark.createDataFrame([(1, "copyright notice"), (2, "(c) You must retain"), (3, "a\rReleased under the MIT License.\rb")],
                                              "doc_id long, text string")).collect()
    empty = licences.scan(spark.createDataFrame([(1, "")], "doc_id long, text string")).first().digest
    assert all(r.digest != empty for r in own)
    assert [r.n_license_lines for r in sorted(own)] == [0, 0, 1]


def test_common_licences_are_known(spark):
    """Whole texts, standard headers, SPDX lines and one-line notices of common licences; no text names two."""
    known = licences.known_licences()
    files = {"Apache-2.0", "GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MPL-1.1", "MPL-2.0", "CC0-1.0", "CC-BY-SA-4.0", "GFDL-1.2", "GFDL-1.3",
             "Unlicense", "Zlib"}
    assert {n for n, t in known if len(t) > 900} >= files - {"Zlib"} and files <= {n for n, _ in known}
    header = next(t for n, t in known if n == "Apache-2.0" and t.startswith("Licensed under the Apache License, Version 2.0 (the"))
    whole = {n: max((t for m, t in known if m == n), key=len) for n in files | {"BSD-3-Clause"}}
    docs = [(n, t) for n, t in whole.items()] + [("Apache-2.0", "\n".join("# " + x for x in ("Copyright 2021 A\n\n" + header).split("\n")))]
    docs += [(n.removesuffix("-only"), "// SPDX-License-Identifier: " + n) for n in ("GPL-2.0-only", "GPL-2.0-or-later", "BSD-3-Clause", "LGPL-2.1-only", "MPL-2.0")]
    docs += [("BSD-3-Clause", "Licensed under the BSD 3-Clause License."), ("GPL-2.0", "Released under the GNU General Public License, version 2.")]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id long, text string")
    assert {r.doc_id: r.license for r in licences.scan(df).collect()} == {i: n for i, (n, _) in enumerate(docs)}
    digests = spark.createDataFrame(list(known), "license string, text string").groupBy(licences.canonical(F.col("text")).alias("c"))
    assert digests.agg(F.count_distinct("license").alias("n"), F.collect_set("license").alias("l")).where("n > 1").collect() == []
