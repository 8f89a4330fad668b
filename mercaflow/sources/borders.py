"""Borders of the JSON documents in files that may hold several.

Files are scanned by line, so a file of any length is split over tasks and no
text is held but one line. A JSON string cannot go on in the next line, hence a
line's brackets can be read by themselves: with string literals taken out and
matched pairs removed, what is left is some closing and then some opening ones.
The depth at the start of a line is a prefix sum of those, taken within blocks of
a file first and then over its blocks; a closing bracket at depth 0 is junk and
leaves the depth at 0.

The scan tells three kinds of files apart: those of one document (or one array
of records), those of one document a line, and others. The first two are left to
Spark's JSON reader. The others are cut at their borders: lines in which a
document ends are split into tokens, all others stay whole, and what lies between
two borders is put together again.
"""
from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mercaflow.session import shared_folder

ONE, LINES, CUT = "one", "lines", "cut"
_SPACES = " \t\n\x0b\x0c\r"
# A string literal, closed or up to the end of its line.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+(?:"|\\?$)'
_TOKENS = _STRING + r'|[\[\]{}]|[^"\[\]{}]++'
_BLOCK = ["file", "block"]
# Rounds in which matched pairs are removed at once; deeper nesting is walked through.
_ROUNDS = 12


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value").alias("text"),
    )


def _unmatched(brackets: Column) -> Column:
    """The closing and then the opening brackets that ``brackets`` leaves."""
    for _ in range(_ROUNDS):
        brackets = F.replace(brackets, F.lit("()"), F.lit(""))
    start = F.struct(F.lit(0).alias("closing"), F.lit(0).alias("opening"))

    def walk(seen: Column, bracket: Column) -> Column:
        opens = bracket == "("
        matched = ~opens & (seen["opening"] > 0)
        return F.struct(
            (seen["closing"] + F.when(opens | matched, 0).otherwise(1)).alias("closing"),
            (seen["opening"] + F.when(opens, 1).when(matched, -1).otherwise(0)).alias("opening"),
        )

    opening = F.length(F.replace(brackets, F.lit(")"), F.lit("")))
    counted = F.struct((F.length(brackets) - opening).alias("closing"), opening.alias("opening"))
    return F.when(F.contains(brackets, F.lit("()")), F.aggregate(F.split(brackets, ""), start, walk)).otherwise(counted)


def _measured(lines: DataFrame) -> DataFrame:
    """Lines with what their brackets do to the depth: ``delta``, the ``lowest``
    and the ``inner`` lowest change before the last bracket (0 or less), and
    whether a line is ``blank``, ends behind its last bracket (``closed``), or
    begins with a bracket that none closes before the last (``begins``)."""
    bare = F.regexp_replace("text", _STRING, '"')
    df = lines.withColumn("bare", F.trim(bare, F.lit(_SPACES)))
    kept = F.regexp_replace("bare", r"[^\[\]{}]++", "")
    df = df.withColumn("brackets", F.translate(kept, "{}[]", "()()"))
    n = F.length("brackets")
    # What lies between the first and the last bracket tells the rest.
    df = df.withColumn("between", _unmatched(F.substring("brackets", F.lit(2), F.greatest(n - 2, F.lit(0)))))
    first, last = F.substring("brackets", 1, 1), F.substring("brackets", -1, 1)
    a, b = F.col("between.closing"), F.col("between.opening")
    opens = first == "("
    closing = F.when(n == 0, 0).when(opens, F.greatest(a - 1, F.lit(0))).otherwise(a + 1)
    opening = F.when(n == 0, 0).when(opens, b + F.when(a == 0, 1).otherwise(0)).otherwise(b)
    df = df.withColumns({"closing": closing, "opening": opening})
    single, ends = n == 1, last == ")"
    # A line of one bracket has no bracket before its last one.
    inner = F.when(n <= 1, 0).otherwise(-F.col("closing"))
    all_closing = (
        F.when(n == 0, 0)
        .when(single, ends.cast("int"))
        .otherwise(F.col("closing") + F.when(ends & (F.col("opening") == 0), 1).otherwise(0))
    )
    delta = 2 * F.length(F.replace("brackets", F.lit(")"), F.lit(""))) - n
    return df.select(
        *lines.columns,
        delta.alias("delta"),
        (-all_closing).alias("lowest"),
        inner.alias("inner"),
        (F.col("bare") == "").alias("blank"),
        (n == 0).alias("flat"),
        F.substring("bare", -1, 1).isin("]", "}").alias("closed"),
        (F.substring("bare", 1, 1).isin("[", "{") & (single | (a == 0))).alias("begins"),
        F.substring(F.ltrim("text", F.lit(_SPACES)), 1, 1).isin("]", "}", '"', ",", ":").alias("inside"),
    )


def _whole_alone(df: DataFrame) -> Column:
    """Whether a line is one document, or none that anything follows, by itself."""
    document = F.col("begins") & F.col("closed") & (F.col("delta") == 0) & ~F.col("flat")
    unfinished = F.col("begins") & (F.col("lowest") == 0) & (F.col("delta") > 0)
    return document | unfinished | (F.col("flat") & ~F.col("inside"))


def _within_block() -> Window:
    return Window.partitionBy(*_BLOCK).orderBy("line")


def _blocks(measured: DataFrame) -> DataFrame:
    """What each block of a file does to the depth, and what its lines are like."""
    order = _within_block()
    text = measured.filter("not blank").withColumn("alone", _whole_alone(measured)).drop("text")
    before = F.sum("delta").over(order) - F.col("delta")
    numbered = text.withColumns(
        {"before": before, "no": F.row_number().over(order), "left": F.count(F.lit(1)).over(Window.partitionBy(*_BLOCK))}
    )
    first, last = F.col("no") == 1, F.col("no") == F.col("left")
    reached, inner = F.col("before") + F.col("lowest"), F.col("before") + F.col("inner")
    return numbered.groupBy(*_BLOCK).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("delta").alias("delta"),
        F.min(reached).alias("lowest"),
        F.min(F.when(~first & ~last, reached)).alias("middle"),
        F.min(F.when(first, reached)).alias("first"),
        F.min(F.when(last, reached)).alias("last"),
        F.min(F.when(last, inner)).alias("last_inner"),
        F.bool_and("alone").alias("alone"),
        F.bool_or(F.col("alone") & ~F.col("flat") & (F.col("delta") == 0)).alias("documents"),
        F.bool_or(first & F.col("begins")).alias("begins"),
        F.bool_or(first & F.col("begins") & (F.col("delta") > 0) & (F.col("lowest") == 0)).alias("goes_on"),
        F.bool_or(last & F.col("closed")).alias("closed"),
    )


def _along(blocks: DataFrame) -> DataFrame:
    """Blocks with the depth sum before them and the lowest one reached by then."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("delta").over(earlier), F.lit(0)).alias("start")
    along = blocks.select("*", start)
    reached = F.min(F.col("start") + F.col("lowest")).over(earlier)
    return along.withColumn("floor", F.least(F.coalesce(reached, F.lit(0)), F.lit(0)))


def scan(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of all files of ``path`` that hold anything, stored."""
    return stored(_along(_blocks(_measured(_lines(spark, path)))), "borders")


def kinds(blocks: DataFrame) -> dict[str, list[str]]:
    """Files by their kind: names only, which the driver lists in any case."""
    ordered = Window.partitionBy("file").orderBy("block")
    ends = blocks.withColumns(
        {
            "is_first": F.row_number().over(ordered) == 1,
            "is_last": F.lead("block").over(ordered).isNull(),
        }
    )
    first, last, start = F.col("is_first"), F.col("is_last"), F.col("start")
    # The lowest depth of all lines but the first and, before its last bracket, the last.
    single = F.col("n") == 1
    rest = F.least(
        start + F.col("middle"),
        F.when(~first & ~(last & single), start + F.col("first")),
        F.when(~last & ~(first & single), start + F.col("last")),
        F.when(last & ~(first & single), start + F.col("last_inner")),
    )
    files = ends.groupBy("file").agg(
        F.sum("n").alias("n"),
        F.sum("delta").alias("depth"),
        F.min(rest).alias("rest"),
        F.bool_and("alone").alias("alone"),
        F.bool_or("documents").alias("documents"),
        F.bool_or(first & F.col("goes_on")).alias("goes_on"),
        F.bool_or(last & F.col("closed")).alias("closed"),
    )
    one = F.when(F.col("n") == 1, F.col("alone")).otherwise(
        F.col("goes_on") & (F.col("rest") > 0) & (F.col("depth") == 0) & F.col("closed")
    )
    lines = (F.col("n") > 1) & F.col("alone") & F.col("documents")
    kind = F.when(lines, LINES).when(one, ONE).otherwise(CUT)
    found: dict[str, list[str]] = {}
    for file, name in files.select("file", kind).toLocalIterator():
        found.setdefault(name, []).append(file)
    return found


def as_path(file: str) -> str:
    """A file's name as a path that matches just this file."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", unquote(file))


def _tokens(spark: SparkSession, files: list[str], blocks: DataFrame) -> DataFrame:
    """What the files consist of, in order: whole lines, and tokens of lines in
    which a document ends before the last bracket or something follows it."""
    lines = _measured(_lines(spark, [as_path(f) for f in files])).join(
        blocks.select(*_BLOCK, "start", "floor"), _BLOCK
    )
    order = _within_block()
    before = F.col("start") + F.sum("delta").over(order) - F.col("delta")
    lines = lines.withColumn("before", before)
    lowest = F.min(F.col("before") + F.col("lowest")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    depth = F.col("before") - F.least(F.col("floor"), F.coalesce(lowest, F.lit(0)))
    lines = lines.withColumn("depth", depth)
    after = F.col("depth") + F.col("delta")
    inside = (F.col("depth") > 0) & (F.col("depth") + F.col("inner") > 0) & ((after > 0) | F.col("closed"))
    alone = (F.col("depth") == 0) & _whole_alone(lines)
    whole = F.col("blank") | inside | alone
    parts = F.when(whole, F.array("text")).otherwise(F.regexp_extract_all("text", F.lit(_TOKENS), F.lit(0)))
    tokens = lines.select(
        *_BLOCK, "line", "start", "floor", F.when(whole, F.col("delta")).alias("of_line"), F.posexplode(parts).alias("no", "token"),
        F.size(parts).alias("n"),
    )
    own = F.when(F.col("token").isin("[", "{"), 1).when(F.col("token").isin("]", "}"), -1).otherwise(0)
    delta = F.coalesce("of_line", own)
    # The end of a line stays with the line's last token.
    token = F.when(F.col("no") + 1 == F.col("n"), F.concat("token", F.lit("\n"))).otherwise(F.col("token"))
    return tokens.withColumns({"delta": delta, "token": token})


def documents(spark: SparkSession, files: list[str], blocks: DataFrame) -> DataFrame:
    """``file`` and ``document`` of what lies between the borders of ``files``,
    in full: documents, scalars and junk. What no bracket closes by the end of a
    file comes block by block, so that no text is larger than a document or a
    block."""
    order = Window.partitionBy(*_BLOCK).orderBy("line", "no")
    tokens = _tokens(spark, files, blocks)
    sums = F.col("start") + F.sum("delta").over(order)
    tokens = tokens.withColumn("sums", sums)
    floor = F.least(F.col("floor"), F.min("sums").over(order))
    tokens = tokens.withColumn("ends", (F.col("sums") == floor).cast("int"))
    ended = F.sum("ends").over(order) - F.col("ends")
    tokens = stored(tokens.select(*_BLOCK, "line", "no", "token", "ends", ended.alias("ended")), "tokens")
    in_block = tokens.groupBy(*_BLOCK).agg(F.sum("ends").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = in_block.select(
        *_BLOCK,
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"),
        F.sum("n").over(Window.partitionBy("file")).alias("total"),
    )
    numbered = tokens.join(offsets, _BLOCK).withColumn("number", F.col("offset") + F.col("ended"))
    rest = F.when(F.col("number") == F.col("total"), F.col("block")).alias("rest")
    pieces = numbered.groupBy("file", "number", rest).agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "no", "token"))).alias("tokens")
    )
    text = F.trim(F.array_join("tokens.token", ""), F.lit(_SPACES))
    return pieces.select("file", text.alias("document")).filter("document <> ''")
