"""Records of text files that may lie across lines and across the splits a file is read in.

A file is read as pieces (text up to a separator) by as many tasks as it has splits. What a piece
means depends on the state it starts in: inside quotes or not, and how deep. Each piece is read
under both starting states, which makes it a function from state to state; functions compose, so
splits are summed up to one row each, a running composition over these few rows gives every split
its true starting state, and pieces find their own record borders. Only records that lie in
several pieces are gathered, each by its own key. The rows of the splits are written before the
pieces are joined to them: as Spark then knows that they are few, pieces are not shuffled for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from sentrel.session import materialize

SPLIT = ["file", "block"]


def named_like(reader: DataFrameReader, suffix: str | None) -> DataFrameReader:
    """Only files whose name ends in ``suffix``, in any case."""
    if not suffix:
        return reader
    glob = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in suffix)
    return reader.option("pathGlobFilter", f"*{glob}")


def pieces(spark: SparkSession, path: str | list[str], suffix: str | None, separator: str) -> DataFrame:
    """``file, file_name, file_size, block, row, text`` of files whose name ends in ``suffix``.

    ``row`` counts up in a split. Suffixes match in any case.
    """
    return named_like(spark.read.option("lineSep", separator), suffix).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"), F.col("value").alias("text"),
    )


def with_state(rows: DataFrame, within: list[str], order: str, fixed: Column, flips: Column) -> DataFrame:
    """The state each row starts in: ``known``, null as long as it follows from where ``within`` starts,
    and ``flipped``, whether it is that start's opposite.

    A row sets the state to ``fixed``, or where that is null turns it round if ``flips``.
    """
    partition = Window.partitionBy(*within).orderBy(order)
    earlier = partition.rowsBetween(Window.unboundedPreceding, -1)
    turn = F.when(fixed.isNull() & flips, 1).otherwise(0)
    turns = F.coalesce(F.col("__upto") - turn - F.coalesce(F.col("__last.turns"), F.lit(0)), F.lit(0))
    return (
        rows.withColumn("__upto", F.sum(turn).over(partition.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn(
            "__last",
            F.last(F.when(fixed.isNotNull(), F.struct(fixed.alias("state"), F.col("__upto").alias("turns"))), True)
            .over(earlier),
        )
        .withColumn("flipped", turns % 2 == 1)
        .withColumn("known", _turned(F.col("__last.state"), F.col("flipped")))
        .drop("__upto", "__last")
    )


def _turned(state: Column, flipped: Column) -> Column:
    return F.when(flipped, ~state).otherwise(state)


def _earlier(column: Column) -> Column:
    """Sum over the earlier splits of a file; one row stands for a split."""
    rows = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(rows), F.lit(0))


# ------------------------------------------------------------------------------------- CSV

# A cell in quotes holds any text in which quotes are doubled; quotes elsewhere are text.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'


def _opens(text: Column) -> Column:
    """Whether a line that starts outside quotes ends inside."""
    rest = F.regexp_replace(text, f"(^﻿?|,){_QUOTED}", "$1")
    return F.regexp_like(rest, F.lit('(^﻿?|,)"'))


def csv_records(spark: SparkSession, path: str | list[str], suffix: str | None = None) -> DataFrame:
    """``file, file_name, record, text``: records of CSV files as text, the header being record 1.

    A cell in quotes may hold line breaks and reach over any number of splits. Empty lines between
    records count for nothing.
    """
    lines = pieces(spark, path, suffix, "\n")
    text = F.col("text")
    closed = F.regexp_like(text, F.lit(r'^[^"]*+(?:""[^"]*+)*+"'))
    after = F.concat(F.lit("x"), F.regexp_replace(text, r'^[^"]*+(?:""[^"]*+)*+"', ""))
    lines = lines.withColumns(
        {
            "from_out": _opens(text), "from_in": ~closed | _opens(after),
            "blank": F.regexp_replace(text, "\r$", "") == "",
        }
    )
    fixed = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out"))
    lines = with_state(lines, SPLIT, "row", fixed, F.col("from_out"))
    upto = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)

    def inside(start: bool) -> Column:
        return F.coalesce(F.col("known"), _turned(F.lit(start), F.col("flipped")))

    def starts(start: bool) -> Column:
        return F.sum(F.when(~inside(start) & ~F.col("blank"), 1).otherwise(0)).over(upto)

    ending = F.when(F.col("known").isNotNull() | F.col("fixed").isNotNull(), F.when(
        F.coalesce("known", F.lit(False)), F.col("from_in")).otherwise(F.col("from_out")))
    lines = materialize(
        lines.withColumn("fixed", fixed).withColumns(
            {
                "starts_out": starts(False), "starts_in": starts(True), "ending": ending,
                "turned": F.col("flipped") != (F.col("fixed").isNull() & F.col("from_out")),
            }
        ),
        "csv-lines",
    )
    splits = lines.groupBy(*SPLIT).agg(
        F.max_by(F.struct("ending", "turned", "starts_out", "starts_in"), "row").alias("s")
    ).select(*SPLIT, "s.*")
    splits = with_state(splits, ["file"], "block", F.col("ending"), F.col("turned"))
    # Files start outside quotes.
    splits = splits.withColumn("begins_in", F.coalesce("known", "flipped")).select(
        *SPLIT, "begins_in",
        _earlier(F.when(F.col("begins_in"), F.col("starts_in")).otherwise(F.col("starts_out"))).alias("before"),
    )
    splits = materialize(splits, "csv-splits")
    placed = lines.join(splits, SPLIT).withColumns(
        {
            "inside": F.when(F.col("begins_in"), inside(True)).otherwise(inside(False)),
            "record": F.col("before") + F.when(F.col("begins_in"), F.col("starts_in")).otherwise(F.col("starts_out")),
        }
    ).where(F.col("inside") | ~F.col("blank"))
    goes_on = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out"))
    keys = ["file", "file_name", "record"]
    alone = placed.where(~F.col("inside") & ~goes_on).select(*keys, "text")
    several = placed.where(F.col("inside") | goes_on).groupBy(*keys).agg(
        _joined(F.struct("block", "row", "text"), "\n").alias("text")
    )
    return alone.unionByName(several).withColumn("text", F.regexp_replace("text", "\r$", ""))


def _joined(piece: Column, separator: str) -> Column:
    """Pieces of one record in file order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), separator)


def csv_cells(text: Column) -> Column:
    """Cells of a CSV record; quotes around a cell and doubled quotes inside it are undone."""
    # With a comma before the first cell as well, no match is empty.
    cell = rf",((?:{_QUOTED})?[^,]*+)"
    return F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(cell), F.lit(1)),
        lambda c: F.when(
            c.startswith('"'),
            F.concat(
                F.replace(F.regexp_extract(c, r'^"([^"]*+(?:""[^"]*+)*+)"', 1), F.lit('""'), F.lit('"')),
                F.regexp_replace(c, f"^{_QUOTED}", ""),
            ),
        ).otherwise(c),
    )


# ------------------------------------------------------------------------------ JSON arrays


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\.", "")


def _levels(text: Column) -> Column:
    """Brackets and braces opened less those closed, outside strings."""
    rest = F.regexp_replace(text, '"[^"]*("|$)', "")
    count = lambda marks: F.length(rest) - F.length(F.translate(rest, marks, ""))
    return count("{[") - count("}]")


def json_segments(spark: SparkSession, path: str | list[str], suffix: str | None = None) -> DataFrame:
    """``file, file_name, block, place, text, tail, opener``: documents cut after each top-level object.

    A document is an array (``opener`` is ``[``), whose segments are all that precedes an object
    element, and the object; or an object (``{``) alone. What follows the last object is the ``tail``.
    ``place`` counts the segments of a file from 0. ``sound`` is false for files whose quotes or
    brackets do not close where the file ends.
    """
    chunks = pieces(spark, path, suffix, "}")
    text = F.col("text")
    bare = _bare(text)
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    chunks = chunks.withColumns(
        {
            "odd": quotes % 2 == 1,
            "levels_out": _levels(bare), "levels_in": _levels(F.regexp_replace(bare, '^[^"]*("|$)', "")),
        }
    )
    upto = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*SPLIT)
    # Quotes in strings are escaped, so a chunk always turns the state or leaves it.
    chunks = chunks.withColumn("flipped", F.sum(F.col("odd").cast("int")).over(upto) % 2 == 1)
    turned_before = F.col("flipped") != F.col("odd")

    def depth(start_in: bool) -> Column:
        """Depth after the chunk and the brace that ends it, less the depth the split starts at."""
        levels = F.when(turned_before != F.lit(start_in), F.col("levels_in")).otherwise(F.col("levels_out"))
        closes = F.when(F.col("flipped") == F.lit(start_in), 1).otherwise(0)
        return F.sum(levels - closes).over(upto)

    chunks = chunks.withColumns({"depth_out": depth(False), "depth_in": depth(True)})
    # A split's last chunk is judged later: it may be the file's, which no brace ends.
    chunks = chunks.withColumn("last", F.col("row") == F.max("row").over(whole))
    for name, start_in in (("out", False), ("in", True)):
        outside = (F.col("flipped") == F.lit(start_in)) & ~F.col("last")
        least = F.min(F.when(outside, F.col(f"depth_{name}"))).over(whole)
        ends = outside & (F.col(f"depth_{name}") == least)
        chunks = chunks.withColumns({f"least_{name}": least, f"ends_{name}": F.coalesce(ends, F.lit(False))})
    for name in ("out", "in"):
        chunks = chunks.withColumn(f"n_{name}", F.sum(F.col(f"ends_{name}").cast("int")).over(upto))
    chunks = materialize(chunks, "json-chunks")

    sums = chunks.groupBy(*SPLIT).agg(
        F.max_by(F.struct("flipped", "depth_out", "depth_in", "n_out", "n_in"), "row").alias("s"),
        F.max("least_out").alias("least_out"), F.max("least_in").alias("least_in"),
        F.sum(F.octet_length("text") + 1).alias("bytes"), F.max("file_size").alias("file_size"),
        F.min_by(F.substring(F.regexp_replace("text", r"^[﻿\s]+", ""), 1, 1), "row").alias("opener"),
    ).select(*SPLIT, "s.*", "least_out", "least_in", "bytes", "file_size", "opener")
    in_file = Window.partitionBy("file")
    by_start = lambda name: F.when(F.col("starts_in"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    splits = sums.withColumns(
        {
            "starts_in": _earlier(F.col("flipped").cast("int")) % 2 == 1,
            "opener": F.min_by("opener", "block").over(in_file),
            # Without a brace at its end a file has one byte less than its chunks and their braces; a
            # byte order mark, of three bytes, is not read.
            "unended": (F.sum("bytes").over(in_file) - F.col("file_size")).isin(1, -2).cast("int"),
            "last_block": F.max("block").over(in_file) == F.col("block"),
        }
    )
    base = F.when(F.col("opener") == "[", 1).otherwise(0)
    splits = splits.withColumn("depth_before", _earlier(by_start("depth"))).withColumn(
        "has_ends", F.coalesce(F.col("depth_before") + by_start("least") == base, F.lit(False))
    )
    unended = F.when(F.col("last_block"), F.col("unended")).otherwise(0)
    final_out = F.col("starts_in") == F.col("flipped")
    final_depth = F.col("depth_before") + by_start("depth")
    ended = final_out & (final_depth + unended == 0) & F.col("opener").isin("[", "{")
    splits = splits.withColumn("last_ends", final_out & (final_depth == base) & (unended == 0)).select(
        *SPLIT, "starts_in", "opener", "has_ends", "last_ends",
        _earlier(
            F.when(F.col("has_ends"), by_start("n")).otherwise(0) + F.col("last_ends").cast("int")
        ).alias("before"),
        F.min(F.when(F.col("last_block"), ended)).over(in_file).alias("sound"),
    )
    splits = materialize(splits, "json-splits")
    ends = F.when(F.col("last"), F.col("last_ends")).otherwise(F.col("has_ends") & by_start("ends"))
    placed = chunks.join(splits, SPLIT).withColumn("ends", ends).withColumn(
        "place", F.col("before")
        + F.when(F.col("has_ends"), by_start("n") - by_start("ends").cast("int")).otherwise(0)
    )
    keys = ["file", "file_name", "place", "opener", "sound"]
    return placed.groupBy(*keys).agg(
        F.min("block").alias("block"), _joined(F.struct("block", "row", "text"), "}").alias("text"),
        (~F.max("ends")).alias("tail"),
    )
