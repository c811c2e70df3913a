"""URL filter: host and path rules first, a character language-model ratio for the rest.

Urls that a rule judges are the training text of two smoothed variable-order
Markov models, one of allowed and one of blocked urls.  The probability of a
character blends the counts after its longest seen context with the
probability under the next shorter one, down to a uniform start.  A url's
score is the log-likelihood difference of the models divided by its length;
the threshold is set on held-out scores of the judged urls (each half is
scored by models of the other half).

All of it is DataFrame work: characters become rows of (url, five-character
window), windows are scored once each and joined back.  Urls are distinct
rows first, so one very common url is scored once.

Every join asks for a merge join.  Spark takes the windows of a url file for
as small as the file, though they are some hundred times larger, and would
broadcast them, through the driver's memory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlake.llm.common import stored, table

# (host, path prefix, verdict); fixed values of the query
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
ORDER = 5          # characters of the longest window: four of context and one
SMOOTHING = 2.0    # weight of the shorter context
ALPHABET = 256.0   # the uniform start
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
START, END = "\x02", "\x03"


def host_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and one without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _windows(urls: DataFrame, *columns: str) -> DataFrame:
    padded = F.concat(F.lit(START * (ORDER - 1)), F.col("url"), F.lit(END))
    return (urls.select(*columns, padded.alias("_p"), F.explode(F.sequence(F.lit(1), F.length("url") + 1)).alias("_i"))
            .select(*columns, F.substr(F.col("_p"), F.col("_i"), F.lit(ORDER)).alias("gram")))


_CLASSES = (("a0", "allow", 0), ("a1", "allow", 1), ("b0", "block", 0), ("b1", "block", 1))


def window_scores(grams: DataFrame, counts: DataFrame) -> DataFrame:
    """(gram, l0, l1, l2): log-likelihood differences of each window's last
    character under models that leave out fold 0, fold 1, or nothing.
    ``counts`` has the windows of judged urls with counts a0, a1, b0, b1."""
    orders = F.explode(F.sequence(F.lit(1), F.lit(ORDER)))
    sums = [F.sum(c).alias(c) for c, _, _ in _CLASSES]
    suffix = F.substr(F.col("gram"), F.lit(ORDER + 1) - F.col("o"), F.col("o"))
    ends = (counts.select("*", orders.alias("o")).withColumn("tail", suffix)
            .groupBy("tail").agg(*sums))
    contexts = (ends.withColumn("context", F.substr(F.col("tail"), F.lit(1), F.length("tail") - 1))
                .groupBy("context").agg(*[F.sum(c).alias("x" + c) for c, _, _ in _CLASSES]))
    # stored, so that Spark can split the joins on very common contexts
    ends, contexts = stored(ends, "url-ends"), stored(contexts, "url-contexts")
    g = grams.select("gram", orders.alias("o")).withColumn("tail", suffix)
    g = g.withColumn("context", F.substr(F.col("tail"), F.lit(1), F.col("o") - 1))
    g = g.join(ends.hint("merge"), "tail", "left").join(contexts.hint("merge"), "context", "left")
    names = [p + c for c, _, _ in _CLASSES for p in ("", "x")]
    g = g.groupBy("gram").agg(*[F.coalesce(F.max(F.when(F.col("o") == o, F.col(n))), F.lit(0)).alias(f"{n}_{o}")
                                for o in range(1, ORDER + 1) for n in names])

    def log_p(kind: str, folds: tuple[int, ...]) -> Column:
        p: Column = F.lit(1.0 / ALPHABET)
        for o in range(1, ORDER + 1):
            seen, after = (reduce(lambda a, b: a + b, [F.col(f"{x}{kind}{f}_{o}") for f in folds]) for x in ("", "x"))
            p = (seen + SMOOTHING * p) / (after + SMOOTHING)
        return F.log(p)

    return g.select("gram", *[(log_p("a", f) - log_p("b", f)).alias(n)
                              for n, f in (("l0", (1,)), ("l1", (0,)), ("l2", (0, 1)))])


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every row of pages(page_id, url).

    ``score`` is null where a rule decides.  A null url counts as the empty
    one: no host, no path, and the method's verdict on an empty url; a url
    with no evidence either way scores 0.  Repeated rows are judged alike.
    Without allowed and blocked urls to learn from, the threshold is 0 and
    everything undecided is allowed.  An empty table gives no rows."""
    spark = pages.sparkSession
    url = F.coalesce(F.col("url"), F.lit(""))
    distinct = pages.select(url.alias("url")).distinct()
    host, path = host_path(F.col("url"))
    distinct = distinct.select("url", host.alias("host"), path.alias("path"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    half = F.pmod(F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("long"), F.lit(2)).cast("int")
    urls = stored(distinct.select(F.monotonically_increasing_id().alias("uid"), "url", "host", "path", rule.alias("rule"),
                                  verdict.alias("ruled"), F.when(rule.isNull(), 2).otherwise(half).alias("part")), "urls")
    counts = (_windows(urls.where("rule IS NOT NULL"), "ruled", "part").groupBy("gram")
              .agg(*[F.count_if((F.col("ruled") == v) & (F.col("part") == f)).alias(c) for c, v, f in _CLASSES]))
    grams = _windows(urls, "uid", "part")
    scores = window_scores(grams.select("gram").distinct(), counts)
    part = F.when(F.col("part") == 0, F.col("l0")).when(F.col("part") == 1, F.col("l1")).otherwise(F.col("l2"))
    scored = stored(grams.join(scores.hint("merge"), "gram").groupBy("uid").agg(F.avg(part).alias("score")), "url-scores")
    known = urls.join(scored.hint("merge"), "uid").where("rule IS NOT NULL")
    threshold = calibrated(known)
    by_url = (urls.join(scored.hint("merge"), "uid", "left")
              .select(F.col("url").alias("_url"), "host", "path", "rule",
                      F.coalesce("ruled", F.when(F.coalesce("score", F.lit(0.0)) >= threshold, "allow").otherwise("block")).alias("verdict"),
                      F.when(F.col("rule").isNull(), F.col("score")).alias("score")))
    return (pages.select("page_id", url.alias("_u")).join(by_url.hint("merge"), F.col("_u") == F.col("_url"))
            .select("page_id", "host", "path", "rule", "verdict", "score"))


def calibrated(known: DataFrame) -> float:
    """The score that lies equally many standard deviations below the mean
    held-out score of allowed urls and above that of blocked ones."""
    of = lambda v: F.when(F.col("ruled") == v, F.col("score"))
    a, sa, b, sb = known.agg(F.avg(of("allow")), F.stddev_pop(of("allow")), F.avg(of("block")), F.stddev_pop(of("block"))).first()
    if a is None or b is None:
        return 0.0
    return (a + b) / 2 if sa + sb == 0 else (a * sb + b * sa) / (sa + sb)


def op5_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages", "page_id", "url")).drop("score")


def _fits(h: str, p: str) -> str:
    return f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"


def _log_p(kind: str, folds: str) -> str:
    p = str(1.0 / ALPHABET)
    for o in range(1, ORDER + 1):
        seen, after = (" + ".join(f"{x}{kind}{f}_{o}" for f in folds) for x in ("", "x"))
        p = f"(({seen}) + {SMOOTHING} * {p}) / (({after}) + {SMOOTHING})"
    return f"ln({p})"


_LONGEST = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
_PADDED = f"repeat(chr({ord(START)}), {ORDER - 1}) || url || chr({ord(END)})"
_NAMES = [p + c for c, _, _ in _CLASSES for p in ("", "x")]
OP5_SQL = f"""
WITH u0 AS (SELECT DISTINCT coalesce(url, '') AS url FROM pages),
u1 AS (SELECT url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM u0),
u2 AS (SELECT url, translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u1),
u AS (SELECT *, CASE {' '.join(f"WHEN {_fits(h, p)} THEN '{h}{p}'" for h, p, _ in _LONGEST)} END AS rule,
  CASE {' '.join(f"WHEN {_fits(h, p)} THEN '{v}'" for h, p, v in _LONGEST)} END AS ruled,
  ('0x' || substr(md5(url), 1, 8))::BIGINT % 2 AS half FROM u2),
w AS (SELECT url, ruled, half, substr({_PADDED}, i, {ORDER}) AS gram
  FROM (SELECT *, unnest(generate_series(1, length(url) + 1)) AS i FROM u)),
counts AS (SELECT gram, {', '.join(f"count(*) FILTER (ruled = '{v}' AND half = {f}) AS {c}" for c, v, f in _CLASSES)}
  FROM w WHERE ruled IS NOT NULL GROUP BY gram),
ends AS (SELECT right(gram, o) AS tail, {', '.join(f"sum({c}) AS {c}" for c, _, _ in _CLASSES)}
  FROM counts, generate_series(1, {ORDER}) t(o) GROUP BY 1),
contexts AS (SELECT left(tail, length(tail) - 1) AS context, {', '.join(f"sum({c}) AS x{c}" for c, _, _ in _CLASSES)} FROM ends GROUP BY 1),
g0 AS (SELECT gram, o, right(gram, o) AS tail, left(right(gram, o), o - 1) AS context
  FROM (SELECT DISTINCT gram FROM w), generate_series(1, {ORDER}) t(o)),
g1 AS (SELECT gram, {', '.join(f"coalesce(max({n}) FILTER (o = {o}), 0) AS {n}_{o}" for o in range(1, ORDER + 1) for n in _NAMES)}
  FROM g0 LEFT JOIN ends USING (tail) LEFT JOIN contexts USING (context) GROUP BY gram),
g AS (SELECT gram, {', '.join(f"{_log_p('a', f)} - {_log_p('b', f)} AS {n}" for n, f in (("l0", "1"), ("l1", "0"), ("l2", "01")))} FROM g1),
s AS (SELECT url, any_value(ruled) AS ruled, avg(CASE WHEN ruled IS NULL THEN l2 WHEN half = 0 THEN l0 ELSE l1 END) AS score
  FROM w JOIN g USING (gram) GROUP BY url),
m AS (SELECT avg(score) FILTER (ruled = 'allow') AS a, stddev_pop(score) FILTER (ruled = 'allow') AS sa,
  avg(score) FILTER (ruled = 'block') AS b, stddev_pop(score) FILTER (ruled = 'block') AS sb FROM s),
t AS (SELECT CASE WHEN a IS NULL OR b IS NULL THEN 0 WHEN sa + sb = 0 THEN (a + b) / 2 ELSE (a * sb + b * sa) / (sa + sb) END AS threshold FROM m)
SELECT page_id, host, path, rule, coalesce(u.ruled, CASE WHEN coalesce(score, 0) >= threshold THEN 'allow' ELSE 'block' END) AS verdict
FROM pages JOIN u ON coalesce(pages.url, '') = u.url LEFT JOIN s ON s.url = u.url, t
"""
