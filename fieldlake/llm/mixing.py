"""Mixing sources to target weights by Sainte-Lague apportionment.

Words are laid out in equal blocks.  The blocks of the whole mix are dealt to
the sources by highest quotients votes / (2 n + 1), the blocks of a source to
its shards in the same way, and each shard takes its quota of blocks from its
documents in a seeded order, from the start again once all were taken.

Everything is DataFrame work: a row per document holds only its id, source,
word count and seeded key; a source of any share of the corpus is split into
shards of bounded size, and only counts of sources and shards are ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.llm.common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_TIMES = 2
BLOCK_WORDS = 32
SHARD_WORDS = 1 << 18
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def seeded_key(seed: str, doc_id: Column, text: Column) -> Column:
    """Hex digest of seed, id and text: only rows that are wholly equal share it."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")),
                             F.md5(F.coalesce(text, F.lit("")))))


def water_fill(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, times: int = MOST_TIMES) -> DataFrame:
    """Add ``pos``, ``weight`` and ``target`` to (source, source_size).

    Sources by code point, null last, get the weights in turn.  Targets are
    ``share`` of all sizes split by weight; one that passes ``times`` its
    source's size stops there and the excess goes to the others by weight
    until none is above.  The sources that stop are those of the smallest
    size / weight, so a running sum finds them without repeating."""
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy(F.col("ratio"), F.col("pos")).rowsBetween(Window.unboundedPreceding, -1)
    cap = F.lit(times) * F.col("source_size")
    s = (sources.withColumn("pos", F.row_number().over(by_name))
         .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                            (F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1).cast("int")))
         .withColumn("ratio", cap / F.col("weight"))
         .withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
         .withColumn("weights", F.sum("weight").over(everything)))
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum(cap).over(by_ratio), F.lit(0)))
                     / (F.col("weights") - F.coalesce(F.sum("weight").over(by_ratio), F.lit(0))))
    s = s.withColumn("stops", F.col("ratio") <= F.col("level"))
    stopped = lambda c: F.sum(F.when(F.col("stops"), c).otherwise(0)).over(everything)
    rest = F.col("weights") - stopped(F.col("weight"))
    level = (F.col("total") - stopped(cap)) / F.when(rest > 0, rest)
    return (s.withColumn("target", F.when(F.col("stops"), cap.cast("double")).otherwise(level * F.col("weight")))
            .select("source", "source_size", "pos", "weight", "target"))


def apportion(df: DataFrame, parts: list[str], key: str, votes: str, seats: str) -> DataFrame:
    """Add ``quota``: integer seats for each row of (parts, key) by highest
    quotients votes / (2 n + 1), ties to the smaller key.

    A row's share can stray from votes * seats / all votes by less than
    1.5 rows' worth spread by votes, plus one, so only that many quotients
    around its share are ranked: a few times the number of rows in all."""
    part = Window.partitionBy(*parts)
    all_votes, count = F.sum(votes).over(part), F.count(F.lit(1)).over(part)
    portion = F.when(all_votes > 0, F.col(votes) / all_votes).otherwise(F.lit(0.0))
    d = (df.withColumn("_slack", (F.ceil(1.5 * count * portion) + 1).cast("long"))
         .withColumn("_base", F.greatest(F.lit(0), F.floor(portion * F.col(seats) + 0.5).cast("long") - F.col("_slack")).cast("long"))
         .withColumn("_need", F.col(seats) - F.sum("_base").over(part)))
    d = d.withColumn("_n", F.explode(F.sequence(F.col("_base"), F.col("_base") + 2 * F.col("_slack"))))
    ranked = Window.partitionBy(*parts).orderBy((F.col(votes) / (2 * F.col("_n") + 1)).desc(), F.col(key), F.col("_n"))
    d = d.withColumn("_won", (F.row_number().over(ranked) <= F.col("_need")) & (F.col(votes) > 0))
    return (d.groupBy(*df.columns)
            .agg((F.max("_base") + F.count_if("_won")).alias("quota")))


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, times: int = MOST_TIMES,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, key, size, source_size, target, taken) for every row of docs(doc_id, source, text).

    ``taken`` counts the words the mix takes of the document, repeats
    counted, at most ``times`` its size.  A null text has size 0; a null
    source is a source of its own, last; a null doc_id is an id like any
    other; repeated rows are taken in turn like different ones; an empty
    table gives no rows.  Other columns of ``docs`` are ignored."""
    base = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                              seeded_key(seed, F.col("doc_id"), F.col("text")).alias("key")), "mix-sizes")
    sources = water_fill(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, times)
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / block_words).cast("long")
    sources = apportion(sources.withColumn("blocks", blocks), [], "pos", "target", "blocks")
    sources = sources.select(F.col("source").alias("s_source"), "pos", "source_size", "target",
                             F.col("quota").alias("source_blocks"),
                             (F.floor(F.col("source_size") / shard_words) + 1).cast("long").alias("shards"))
    docs_at = (base.join(sources, F.col("source").eqNullSafe(F.col("s_source")))
               .withColumn("shard", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("shards"))))
    shards = (docs_at.groupBy("pos", "shard", "source_blocks").agg(F.sum("size").alias("shard_size")))
    shards = (apportion(shards, ["pos"], "shard", "shard_size", "source_blocks")
              .select(F.col("pos").alias("p"), F.col("shard").alias("h"), "shard_size",
                      F.least(F.col("quota") * block_words, F.lit(times) * F.col("shard_size")).alias("words")))
    tape = (Window.partitionBy("pos", "shard").orderBy("key", "size")
            .rowsBetween(Window.unboundedPreceding, -1))
    d = (docs_at.withColumn("before", F.coalesce(F.sum("size").over(tape), F.lit(0)))
         .join(shards, (F.col("pos") == F.col("p")) & (F.col("shard") == F.col("h"))))
    turns = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.col("words") - turns * F.col("shard_size")
    taken = F.col("size") * turns + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return d.select("doc_id", "source", "key", "size", "source_size", "target", taken.cast("long").alias("taken"))


def apply_mix(docs: DataFrame, seed: str = SEED, **params) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, in whole texts: a
    document cut by the last block of its shard stays if at least half of it
    was taken.  Texts without words are not taken."""
    taken = (mixed(docs, seed=seed, **params).groupBy("key")
             .agg(F.floor(F.sum("taken") / F.nullif(F.max("size"), F.lit(0)) + 0.5).cast("int").alias("copies"))
             .where("copies > 0").withColumnRenamed("key", "_taken_key"))
    d = docs.withColumn("_key", seeded_key(seed, F.col("doc_id"), F.col("text"))).dropDuplicates(["_key"])
    return (d.join(taken, F.col("_key") == F.col("_taken_key"))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*docs.columns))


def op2_mix(spark, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents", "doc_id", "source", "text")).drop("source", "key")


_QUOTA = """
  SELECT *, ceil(1.5 * count(*) OVER w * p)::BIGINT + 1 AS slack FROM (
    SELECT *, CASE WHEN sum({votes}) OVER ({part}) > 0 THEN {votes} / sum({votes}) OVER ({part}) ELSE 0.0 END AS p FROM {name})
  WINDOW w AS ({part})"""

OP2_SQL = f"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS key FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS pos FROM s0),
s2 AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][(pos - 1) % {len(WEIGHTS)} + 1] AS weight FROM s1),
s3 AS (SELECT *, {MOST_TIMES} * source_size / weight AS ratio, {SHARE}::DOUBLE * sum(source_size) OVER () AS total, sum(weight) OVER () AS weights FROM s2),
s4 AS (SELECT *, (total - coalesce(sum({MOST_TIMES} * source_size) OVER b, 0)) / (weights - coalesce(sum(weight) OVER b, 0)) AS level
  FROM s3 WINDOW b AS (ORDER BY ratio, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s5 AS (SELECT *, CASE WHEN ratio <= level THEN ({MOST_TIMES} * source_size)::DOUBLE ELSE
    (total - sum(CASE WHEN ratio <= level THEN {MOST_TIMES} * source_size ELSE 0 END) OVER ())
    / (weights - sum(CASE WHEN ratio <= level THEN weight ELSE 0 END) OVER ()) * weight END AS target FROM s4),
s6 AS (SELECT source, source_size, pos, target, round(sum(target) OVER () / {BLOCK_WORDS})::BIGINT AS seats FROM s5),
a1 AS ({_QUOTA.format(votes="target", part="", name="s6")}),
a2 AS (SELECT *, greatest(0, floor(p * seats + 0.5)::BIGINT - slack) AS lo FROM a1),
a3 AS (SELECT *, seats - sum(lo) OVER () AS need, unnest(generate_series(lo, lo + 2 * slack)) AS n FROM a2),
a4 AS (SELECT *, row_number() OVER (ORDER BY target / (2 * n + 1) DESC, pos, n) AS r FROM a3),
sources AS (SELECT source, pos, source_size, target, max(lo) + count(*) FILTER (r <= need AND target > 0) AS source_blocks,
    floor(source_size / {SHARD_WORDS})::BIGINT + 1 AS shards FROM a4 GROUP BY source, pos, source_size, target),
d AS (SELECT base.*, pos, source_size, target, source_blocks, ('0x' || substr(key, 1, 8))::BIGINT % shards AS shard
  FROM base JOIN sources ON base.source IS NOT DISTINCT FROM sources.source),
h0 AS (SELECT pos, shard, source_blocks AS seats, sum(size)::BIGINT AS shard_size FROM d GROUP BY ALL),
b1 AS ({_QUOTA.format(votes="shard_size", part="PARTITION BY pos", name="h0")}),
b2 AS (SELECT *, greatest(0, floor(p * seats + 0.5)::BIGINT - slack) AS lo FROM b1),
b3 AS (SELECT *, seats - sum(lo) OVER (PARTITION BY pos) AS need FROM b2),
b4 AS (SELECT *, unnest(generate_series(lo, lo + 2 * slack)) AS n FROM b3),
b5 AS (SELECT *, row_number() OVER (PARTITION BY pos ORDER BY shard_size / (2 * n + 1) DESC, shard, n) AS r FROM b4),
shards AS (SELECT pos, shard, shard_size, least((max(lo) + count(*) FILTER (r <= need AND shard_size > 0)) * {BLOCK_WORDS}, {MOST_TIMES} * shard_size)::BIGINT AS words
  FROM b5 GROUP BY pos, shard, shard_size),
e AS (SELECT d.doc_id, d.size, d.source_size, d.target, shard_size, words,
    CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END AS turns,
    coalesce(sum(size) OVER (PARTITION BY d.pos, d.shard ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN shards ON d.pos = shards.pos AND d.shard = shards.shard)
SELECT doc_id, size, source_size, target,
  (size * turns + greatest(0, least(size, words - turns * shard_size - before)))::BIGINT AS taken FROM e
"""
