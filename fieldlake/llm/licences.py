"""Licence scan by canonical digest.

A text is brought to a canonical form (copyright statements dropped, ASCII case
folded, every run of punctuation and white space one blank, equivalent
spellings unified) and its SHA-256 is hash-joined to the digests of known
licences.  Whole texts are looked up, and each line of a text as a text of its
own, which finds the one-line notices inside longer documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import table
from fieldlake.llm.licence_texts import EQUIVALENT, LICENCES, known_licences
from fieldlake.llm.urls import LOWER, UPPER

# a line that is a copyright statement, also behind a comment leader: the word with a sign or a year, a sign, or (c) with a
# year.  Other lines that begin with the word are a licence's own text, wrapped there
_YEAR = r"[<\[{]?(?:\d{4}|yyyy|year\b)"
_STATEMENT = (r"(?i)(?<![^\r\n])[ \t/*#;%!|<>\"'.:-]*+"
              rf"(?:copyright[ \t:]*+(?:\(c\)|©|&copy;|{_YEAR})|©|&copy;|\(c\)[ \t]*+(?:copyright[ \t]*+)?{_YEAR})[^\r\n]*")
_BLANKS = r"[\x00-/:-@\[-`{-\x7f]+"  # ASCII but for digits and lower-case letters


def canonical(text: Column, spellings=EQUIVALENT) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), _STATEMENT, "")
    t = F.regexp_replace(F.translate(t, UPPER, LOWER), _BLANKS, " ")
    t = F.concat(F.lit(" "), F.trim(t), F.lit(" "))
    for variant, word in spellings:
        t = F.replace(t, F.lit(" " + variant), F.lit(" " + word))
    return F.trim(t)


def known_digests(spark: SparkSession, licences=None, spellings=EQUIVALENT) -> DataFrame:
    """(known_digest, license), one row a digest; for a text given twice the smaller name."""
    given = spark.createDataFrame(list(licences or known_licences()), "license string, text string")
    return (given.groupBy(F.sha2(canonical(F.col("text"), spellings), 256).alias("known_digest"))
            .agg(F.min("license").alias("license")))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, license, n_license_lines, line_licenses) for every row of docs(doc_id, text).

    ``license`` names the licence whose text the whole document is, else
    null; ``line_licenses`` those of its lines, sorted, comma-separated, else
    null; ``n_license_lines`` counts such lines.  A null text counts as
    empty; a text or line with nothing but punctuation matches nothing;
    repeated rows are scanned alike and null ids kept.  A ``known``
    (known_digest, license) of one's own may be of any size: Spark chooses the join."""
    if known is None:
        known = F.broadcast(known_digests(docs.sparkSession))  # the fixed list of known_licences()
    else:
        known = known.select("known_digest", "license")
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    whole = docs.select("doc_id", F.md5("text").alias("same"), F.sha2(canonical(F.col("text")), 256).alias("digest"))
    lines = (docs.select("doc_id", F.md5("text").alias("line_same"),
                         F.posexplode(F.split(F.replace("text", F.lit("\r"), F.lit("\n")), "\n")).alias("line_at", "line"))
             .select(F.col("doc_id").alias("line_doc"), "line_same", "line_at", canonical(F.col("line")).alias("line"))
             .where("line <> ''")
             .join(known, F.sha2("line", 256) == F.col("known_digest"))
             .groupBy("line_doc", "line_same")
             .agg(F.count_distinct("line_at").alias("n"), F.array_sort(F.collect_set("license")).alias("names")))
    return (whole.join(known, F.col("digest") == F.col("known_digest"), "left")
            .join(lines, F.col("doc_id").eqNullSafe(F.col("line_doc")) & (F.col("same") == F.col("line_same")), "left")
            .select("doc_id", "digest", "license", F.coalesce("n", F.lit(0)).cast("long").alias("n_license_lines"),
                    F.concat_ws(",", "names").alias("line_licenses"))
            .withColumn("line_licenses", F.nullif("line_licenses", F.lit(""))))


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents", "doc_id", "text"))


# OP3_SQL has an older rule: every line that begins with the word is dropped, comment leaders hide a statement, and only \n
# ends a line.  Both agree on texts that hold neither such lines nor a lone \r
_COPYRIGHT = r"^[ \t]*(copyright|\(c\)|©)[^\n]*"


def _canonical_sql(text: str) -> str:
    t = f"regexp_replace({text}, '(?im){_COPYRIGHT}', '', 'g')"
    t = f"' ' || trim(regexp_replace(translate({t}, '{UPPER}', '{LOWER}'), '{_BLANKS}', ' ', 'g'), ' ') || ' '"
    for variant, word in EQUIVALENT:
        t = f"replace({t}, ' {variant}', ' {word}')"
    return f"trim({t}, ' ')"


_KNOWN = ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in LICENCES)
OP3_SQL = f"""
WITH known AS (SELECT sha256({_canonical_sql("text")}) AS digest, min(license) AS license
  FROM (VALUES {_KNOWN}) t(license, text) GROUP BY 1),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, md5(text) AS same, generate_subscripts(string_split(text, chr(10)), 1) AS line_no,
  {_canonical_sql("unnest(string_split(text, chr(10)))")} AS line FROM d),
found AS (SELECT doc_id, same, count(DISTINCT line_no) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS names
  FROM lines JOIN known ON sha256(line) = digest WHERE line <> '' GROUP BY 1, 2)
SELECT d.doc_id, sha256({_canonical_sql("text")}) AS digest, known.license, coalesce(n, 0)::BIGINT AS n_license_lines, names AS line_licenses
FROM d LEFT JOIN known ON sha256({_canonical_sql("text")}) = known.digest
  LEFT JOIN found ON d.doc_id IS NOT DISTINCT FROM found.doc_id AND md5(d.text) = same
"""
