"""Removal of repeated line runs through a suffix array over lines, built by prefix doubling.

Every line that occurs more than once is a symbol; the suffixes of the documents' symbol sequences
are ranked by their first line, then by 2, 4, 8 .. lines: the pair (rank, rank of the suffix as
many lines on) is counted, sorted and numbered in each round. Suffixes of equal rank at a length
form the interval of suffixes whose common prefix is at least that long, so two ranks that overlap
name any run of lines exactly. All of it is DataFrame work; hot lines are counted before they
are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentrel.llm.stages import Stages

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Settings:
    """A run counts as repeated content when it holds at least so many words."""

    min_words: int = 50


def _key(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_key", F.md5("text"))


def _documents(docs: DataFrame, stages: Stages) -> DataFrame:
    """Distinct documents in the order that says which copy is earlier, numbered in that order."""
    lines = F.split("text", "\n")
    rows = _key(docs.select("doc_id", "text")).where(F.col("text").isNotNull()).select(
        "doc_id", "text_key",
        F.transform(lines, lambda x: F.unhex(F.md5(x))).alias("hashes"),
        F.transform(lines, lambda x: F.regexp_count(x, F.lit(WORD))).alias("words"),
    )
    distinct = rows.groupBy("doc_id", "text_key").agg(
        F.first("hashes").alias("hashes"), F.first("words").alias("words")
    )
    return stages.write(
        distinct.orderBy(F.col("doc_id").asc_nulls_last(), "text_key")
        .withColumn("doc", F.monotonically_increasing_id())
    )


def _numbered(pairs: DataFrame, stages: Stages, *order: str) -> DataFrame:
    """Distinct rows with a rank that follows their order; written, so that it stays."""
    return stages.write(pairs.orderBy(*order).withColumn("rank", F.monotonically_increasing_id()))


def _symbols(documents: DataFrame, stages: Stages) -> DataFrame:
    """``doc, place, words, rank`` of every line that occurs more than once."""
    lines = documents.select(
        "doc", "words", F.posexplode("hashes").alias("place", "hash")
    ).select("doc", "place", F.element_at("words", F.col("place") + 1).alias("words"), "hash")
    repeated = _numbered(
        lines.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("hash"),
        stages, "hash",
    )
    out = stages.write(lines.join(repeated, "hash").select("doc", "place", "words", "rank"))
    stages.drop(repeated)
    return out


def _windows(symbols: DataFrame, settings: Settings) -> DataFrame:
    """``doc, start, lines``: the shortest runs from every line on, and up to every line, that
    hold enough words. They lie within unbroken stretches of repeated lines, and together they
    cover every repeated run of enough words.
    """
    by_doc = Window.partitionBy("doc").orderBy("place")
    rows = symbols.select(
        "doc", "place", "words", (F.col("place") - F.row_number().over(by_doc)).alias("stretch"),
        F.sum("words").over(by_doc.rowsBetween(Window.unboundedPreceding, 0)).alias("upto"),
    ).withColumn("before", F.col("upto") - F.col("words"))
    enough = F.lit(settings.min_words)

    def marks(start: Column, end: Column) -> DataFrame:
        ends = F.struct(F.lit(False).alias("start"), end.alias("at"))
        starts = F.struct(F.lit(True).alias("start"), start.alias("at"))
        return rows.select(
            "doc", "stretch", "place", F.inline(F.array(starts, ends)).alias("is_start", "at")
        )

    within = Window.partitionBy("doc", "stretch")
    # Running minima and maxima look back only, which Spark keeps incrementally.
    forward = marks(F.col("before") + enough, F.col("upto")).withColumn(
        "end", F.min(F.when(~F.col("is_start"), F.col("place"))).over(
            within.orderBy(F.desc("at"), "is_start", F.desc("place"))
            .rowsBetween(Window.unboundedPreceding, 0)
        ),
    ).where(F.col("is_start") & F.col("end").isNotNull()).select(
        "doc", F.col("place").alias("start"), (F.col("end") - F.col("place") + 1).alias("lines")
    )
    backward = marks(F.col("before"), F.col("upto") - enough).withColumn(
        "begin", F.max(F.when(F.col("is_start"), F.col("place"))).over(
            within.orderBy("at", F.desc("is_start"), "place")
            .rowsBetween(Window.unboundedPreceding, 0)
        ),
    ).where(~F.col("is_start") & F.col("begin").isNotNull()).select(
        "doc", F.col("begin").alias("start"), (F.col("place") - F.col("begin") + 1).alias("lines")
    )
    return forward.unionByName(backward).where(F.col("lines") > 0).distinct()


def _doubled(symbols: DataFrame, longest: int, stages: Stages) -> DataFrame:
    """``doc, place, ranks``: the rank of every suffix by its first 1, 2, 4 .. lines.

    A suffix that an unrepeated line or the document's end cuts short ranks by what is left.
    """
    by_doc = Window.partitionBy("doc").orderBy("place")

    def ahead(rows: DataFrame, step: int) -> DataFrame:
        follows = F.lead("place", step).over(by_doc) == F.col("place") + step
        return rows.withColumn(
            "next", F.coalesce(F.when(follows, F.lead("rank", step).over(by_doc)), F.lit(-1))
        )

    step = 1
    current = symbols.select("doc", "place", "rank", F.array("rank").alias("ranks"))
    current = stages.write(ahead(current, step))
    while 2 * step <= longest:
        current = current.withColumnRenamed("rank", "first")
        pairs = _numbered(current.select("first", "next").distinct(), stages, "first", "next")
        following = current.join(pairs, ["first", "next"]).select(
            "doc", "place", "rank", F.concat("ranks", F.array("rank")).alias("ranks")
        )
        step *= 2
        written = stages.write(ahead(following, step))
        stages.drop(pairs)
        current = written
    return current.select("doc", "place", "ranks")


def repeated_lines(docs: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, Stages]:
    """``doc_id, text_key, places``: the lines to delete of every document that has any."""
    stages = Stages(docs.sparkSession, "line-dedup")
    documents = _documents(docs, stages)
    symbols = _symbols(documents, stages)
    windows = stages.write(_windows(symbols, settings))
    longest = windows.agg(F.max("lines")).first()[0] or 1
    suffixes = _doubled(symbols, longest, stages)
    # The largest power of two within the run, and where the second of two overlapping runs of
    # that length starts.
    level = F.length(F.bin("lines")) - 1
    rows = windows.withColumn("level", level).withColumn(
        "second", (F.col("start") + F.col("lines") - F.expr("shiftleft(1, level)")).cast("int")
    )
    ranks = F.element_at("ranks", F.col("level") + 1)
    named = stages.write(
        rows.join(suffixes.withColumnRenamed("place", "start"), ["doc", "start"])
        .withColumn("a", ranks).drop("ranks")
        .join(suffixes.withColumnRenamed("place", "second"), ["doc", "second"])
        .withColumn("b", ranks).select("doc", "start", "lines", "a", "b")
    )
    # Only the places of runs that occur more than once are looked up again.
    first = stages.write(
        named.groupBy("lines", "a", "b").agg(
            F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n")
        ).where(F.col("n") > 1).drop("n")
    )
    later = named.join(first, ["lines", "a", "b"]).where(
        (F.col("doc") != F.col("first.doc")) | (F.col("start") != F.col("first.start"))
    )
    places = later.select(
        "doc", F.explode(F.sequence("start", F.col("start") + F.col("lines") - 1)).alias("place")
    ).groupBy("doc").agg(F.collect_set("place").alias("places"))
    found = stages.write(places.join(documents.select("doc", "doc_id", "text_key"), "doc").drop("doc"))
    stages.drop(documents, symbols, windows, named, first)
    stages.release()
    return found, stages


def line_dedup(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All rows and columns, with the repeated lines deleted from ``text``; ``n_lines`` and
    ``n_removed`` count them.

    A line goes if it lies in a run of consecutive lines that holds at least ``min_words`` words
    and also occurs earlier, in an earlier document (by ``doc_id``, nulls last, then by text) or
    further up in its own; overlapping copies count. The first copy always stays. Rows equal in
    ``doc_id`` and ``text`` are one document and get equal results. A null text has no lines and
    stays null; an empty text is one empty line. Columns of other names pass through; columns
    named like the two counts are replaced.
    """
    found, _ = repeated_lines(docs, settings)
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    # The lines to delete grow with the corpus: texts meet them by key at every size.
    other = found.select(
        F.col("doc_id").alias("__doc_id"), F.col("text_key").alias("__text_key"),
        F.col("places").alias("__places"),
    ).hint("merge")
    lines = F.split("text", "\n")
    places = F.coalesce("__places", F.array().cast("array<int>"))
    kept = F.filter(lines, lambda x, i: ~F.array_contains(places, i))
    joined = docs.select(*own).withColumn("__text_key_own", F.md5("text")).join(
        other,
        (F.col("__text_key_own") == F.col("__text_key")) & F.col("doc_id").eqNullSafe(F.col("__doc_id")),
        "left",
    )
    return joined.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)),
            "n_removed": F.size(places),
            "__kept": F.when(F.size(places) == 0, F.col("text")).otherwise(F.array_join(kept, "\n")),
        }
    ).withColumn("text", F.col("__kept")).select(*own, "n_lines", "n_removed")


def oracle(settings: Settings = Settings()) -> str:
    """DuckDB SQL over ``documents`` for ``doc_id, n_lines, n_removed, text_md5``."""
    return f"""
WITH docs AS (
  SELECT doc_id, text, md5(text) AS k, string_split(text, chr(10)) AS ls FROM documents),
uniq AS (SELECT DISTINCT doc_id, k, ls FROM docs WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, k, ls, i, len(regexp_extract_all(ls[i], '[^\\x20\\x09-\\x0D]+')) AS w
  FROM (SELECT doc_id, k, ls, unnest(range(1, len(ls) + 1)) AS i FROM uniq)),
sums AS (
  SELECT *, sum(w) OVER (PARTITION BY doc_id, k ORDER BY i) AS upto FROM lines),
runs AS (
  SELECT a.doc_id, a.k, a.i AS s, b.i AS e, md5(array_to_string(a.ls[a.i:b.i], chr(10))) AS h,
         b.i - a.i AS n
  FROM sums a JOIN sums b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.k = b.k AND a.i <= b.i
  -- Shortest windows from a line on or up to a line.
  WHERE b.upto - a.upto + a.w >= {settings.min_words}
    AND (b.upto - b.w - a.upto + a.w < {settings.min_words} OR b.upto - a.upto < {settings.min_words})),
later AS (
  SELECT doc_id, k, s, e FROM (
    SELECT *, row_number() OVER (PARTITION BY h, n ORDER BY doc_id NULLS LAST, k, s) AS o FROM runs)
  WHERE o > 1),
gone AS (SELECT DISTINCT doc_id, k, unnest(range(s, e + 1)) AS i FROM later),
kept AS (
  SELECT l.doc_id, l.k, count(*) FILTER (WHERE g.i IS NOT NULL) AS n_removed,
         coalesce(string_agg(l.ls[l.i], chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') AS t
  FROM lines l LEFT JOIN gone g
    ON l.doc_id IS NOT DISTINCT FROM g.doc_id AND l.k = g.k AND l.i = g.i
  GROUP BY l.doc_id, l.k)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(d.ls) END AS n_lines,
       coalesce(n_removed, 0) AS n_removed, md5(t) AS text_md5
FROM docs d LEFT JOIN kept x ON d.doc_id IS NOT DISTINCT FROM x.doc_id AND d.k = x.k
"""
