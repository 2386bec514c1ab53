"""Licence scan by canonical digest lookup, in SQL expressions only.

A text is normalised (case, copyright lines, equivalent spellings, punctuation and
white space) and the SHA-256 of the whole normalised text is looked up among the
digests of known licences. A document's lines are looked up in the same way, since a
one-line notice is a whole licence text of its own. There is no shuffle of texts: the
digest table is small by construction (the texts and digests in ``licences``) and is broadcast;
a table given by the caller carries no hint, so Spark picks the join by its size.

Defined results: null and empty texts have no digest and no licence; a text of
punctuation only normalises to nothing and counts as empty. If a known digest has
several licence names the smallest is taken. Repeated rows give repeated rows. Other
columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylattice.llm.licences import DIGESTS, EQUIVALENT, TEXTS

#: A line that only states who holds the copyright, or that all rights are reserved.
COPYRIGHT_LINE = (
    r"\n[ \t]*((copyright[ \t]*)?(\(c\)|©)|copyright[ \t]*[0-9]{4}|all rights reserved)[^\n]*"
)
NOT_WORD = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    out = F.lower(text)
    out = F.regexp_replace(F.concat(F.lit("\n"), out), COPYRIGHT_LINE, "\n")
    for spelling, other in EQUIVALENT:
        out = F.replace(out, F.lit(spelling), F.lit(other))
    return F.trim(F.regexp_replace(out, NOT_WORD, " "))


def digest(text: Column) -> Column:
    words = canonical(text)
    return F.when(words != "", F.sha2(words, 256))


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, licence) of the texts and digests of this package."""

    def table(pairs: tuple[tuple[str, str], ...], name: str) -> DataFrame:
        rows = (F.struct(F.lit(n).alias("n"), F.lit(x).alias(name)) for n, x in pairs)
        return spark.range(1).select(F.inline(F.array(*rows)))

    texts = table(TEXTS, "t").select("n", digest(F.col("t")).alias("digest"))
    known = texts.unionByName(table(DIGESTS, "digest"))
    return known.groupBy("digest").agg(F.min("n").alias("licence"))


def scan_licences(
    docs: DataFrame,
    known: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: doc_id, text_digest, licence, notices.

    ``licence`` is that of the whole text. ``notices`` has, in ascending order, the
    licences of lines that are known as a whole, joined by commas, or null.
    """
    if known is None:
        known = F.broadcast(known_digests(docs.sparkSession))
    known = known.select("digest", "licence")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text_column}`").alias("text")
    )
    # Each line goes through the lookup as a row of its own; line 0 is the whole text.
    parts = F.concat(F.array("text"), F.split("text", "\n"))
    lines = (
        rows.withColumn("row", F.monotonically_increasing_id())
        .select("doc_id", "row", F.posexplode_outer(parts).alias("line", "part"))
        .withColumn("digest", digest(F.col("part")))
        .drop("part")
    )
    found = lines.join(known, "digest", "left")
    whole = F.coalesce(F.col("line"), F.lit(0)) == 0
    return (
        found.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max(F.when(whole, F.col("digest"))).alias("text_digest"),
            F.max(F.when(whole, F.col("licence"))).alias("licence"),
            F.nullif(
                F.array_join(
                    F.array_sort(F.collect_set(F.when(~whole, F.col("licence")))), ","
                ),
                F.lit(""),
            ).alias("notices"),
        )
        .drop("row")
    )


def oracle_sql() -> str:
    """The same in DuckDB's SQL, over ``documents``."""

    def sql_digest(text: str) -> str:
        out = rf"regexp_replace(chr(10) || lower({text}), '{COPYRIGHT_LINE}', chr(10), 'g')"
        for spelling, other in EQUIVALENT:
            out = f"replace({out}, '{spelling}', '{other}')"
        out = rf"trim(regexp_replace({out}, '{NOT_WORD}', ' ', 'g'))"
        return f"case when {out} <> '' then sha256({out}) end"

    values = ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in TEXTS)
    digests = ", ".join(f"('{n}', '{digest}')" for n, digest in DIGESTS)
    return f"""
with known as (
  select digest, min(n) as licence
  from (
    select n, {sql_digest("t")} as digest from (values {values}) as v(n, t)
    union all select n, digest from (values {digests}) as w(n, digest))
  group by 1
), lines as (
  select doc_id, {sql_digest("part")} as digest
  from (select doc_id, unnest(string_split(text, chr(10))) as part from documents)
), notices as (
  select doc_id, string_agg(distinct licence, ',' order by licence) as notices
  from lines join known using (digest) group by doc_id
), whole as (
  select doc_id, {sql_digest("text")} as text_digest from documents
)
select doc_id, text_digest, licence, notices
from whole left join known on digest = text_digest left join notices using (doc_id)
"""
