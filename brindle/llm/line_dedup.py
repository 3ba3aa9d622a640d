"""Line deduplication by a suffix array over line-ID sequences, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_written, heavy_join, text_of, word_count, written

#: Words from which a repeated run of lines is a copy; shorter ones are left alone.
MIN_WORDS = 50


def numbered(df: DataFrame, ranges: list[Column], name: str, what: str, order: list[Column] | None = None) -> DataFrame:
    """``df`` with a number in the order of the keys: ranges of them, sorted within, written once."""
    return written(df.repartitionByRange(*ranges).sortWithinPartitions(*(order or ranges)).withColumn(name, F.monotonically_increasing_id()), what)


def line_table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``_id, _h, line, seq, words, digest`` for every line with a word; ``seq`` numbers those within their text."""
    rows = df.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).withColumn("_h", F.xxhash64("_text"))
    lines = F.transform(F.split("_text", "\n"), lambda x, i: F.struct(i.alias("line"), word_count(x).alias("words"), x.alias("text")))
    found = rows.select("_id", "_h", F.posexplode(F.filter(lines, lambda x: x["words"] > 0)).alias("seq", "x"))
    return found.select("_id", "_h", "x.line", "seq", "x.words", F.unhex(F.md5(F.col("x.text"))).alias("digest"))


def copied_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_id, _h, removed``: the line ranges of each text (``start``, ``end``, inclusive) that copy earlier lines.

    A run of lines with ``min_words`` words or more is a copy if the same run of lines begins earlier, in order of id
    (null last), text hash and line. Lines have positions in that order; a chain is a run of repeated lines of one text.
    The suffixes of all line-ID sequences are ranked by prefix doubling: the rank of 2n lines is the rank of the pair of
    ranks of n lines. Suffixes whose prefix occurs once drop out, so do lines that stand in no chain of ``min_words``
    words, before the first rank is made.

    Suffixes with one prefix are an interval of longest common prefixes at least as long. For every suffix the shortest
    prefix with ``min_words`` words is looked up, and for every line the shortest run with so many words that ends there:
    each is a pair of overlapping ranks, and all its copies have the same length. The interval's smallest position is the
    first copy; the union of the later ones is the union of all maximal repeated runs, as each line of such a run lies in
    one of the two within the run. Ranks are thus doubled until no prefix is repeated or they span every run looked up.
    """
    lines = written(line_table(df, id_col, text_col), "lines")
    repeated = lines.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    kept = lines.join(repeated, "digest", "left_semi")
    # rows that repeat id and text have every line several times and count as one text
    in_text = Window.partitionBy("_id", "_h").orderBy("seq")
    kept = kept.withColumn("chain", F.col("seq") - F.dense_rank().over(in_text))
    kept = kept.withColumn("total", F.sum("words").over(Window.partitionBy("_id", "_h", "chain"))).where(F.col("total") >= min_words).drop("total", "chain")
    kept = kept.dropDuplicates(["_id", "_h", "seq"])
    text_order = [F.col("_id").asc_nulls_last(), F.col("_h")]
    kept = numbered(kept, text_order, "pos", "line-positions", [*text_order, F.col("seq")])
    drop_written(lines)

    digests = numbered(kept.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), [F.col("digest")], "rank", "line-ranks")
    base = heavy_join(kept.select("_id", "_h", "seq", "line", "words", "pos", "digest"), digests, "digest", "n").drop("digest", "n")
    base = base.withColumn("chain", F.col("seq") - F.row_number().over(in_text))
    base = base.withColumn("c", F.min("pos").over(Window.partitionBy("_id", "_h", "chain")))
    base = written(base.select("_id", "_h", "line", "pos", "c", "words", "rank"), "line-ids")
    drop_written(kept)
    # from each line, and back from each line, how many it takes to have min_words words; a line has one at least
    along = Window.partitionBy("c").orderBy("pos")
    sized = base.select("c", "pos", "words").withColumn("upto", F.sum("words").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    sized = sized.withColumn("before", F.col("upto") - F.col("words")).withColumn("total", F.max("upto").over(Window.partitionBy("c")))
    up = F.count(F.lit(1)).over(Window.partitionBy("c").orderBy("before").rangeBetween(0, min_words - 1))
    down = F.count(F.lit(1)).over(Window.partitionBy("c").orderBy("upto").rangeBetween(-(min_words - 1), 0))
    sized = sized.withColumn("up", F.when(F.col("total") - F.col("before") >= min_words, up)).withColumn("down", F.when(F.col("upto") >= min_words, down))
    both = F.array(F.struct(F.col("pos").alias("from"), F.col("up").alias("size")), F.struct((F.col("pos") - F.col("down") + 1).alias("from"), F.col("down").alias("size")))
    asked = written(sized.select("c", F.explode(both).alias("x")).where("x.size IS NOT NULL").select("c", "x.from", "x.size").distinct(), "line-windows")
    longest = asked.agg(F.max("size")).first()[0] or 0
    level, runs, width, made = base.select("c", "pos", "rank"), None, 1, []
    while width <= longest:
        part = asked.where((F.col("size") >= width) & (F.col("size") < 2 * width))
        a = level.select(F.col("pos").alias("from"), F.col("rank").alias("ra"))
        b = level.select(F.col("pos").alias("last"), F.col("rank").alias("rb"))
        keyed = part.join(a, "from").withColumn("last", F.col("from") + F.col("size") - width).join(b, "last").select("c", "from", "size", "ra", "rb")
        runs = keyed if runs is None else runs.unionByName(keyed)
        if 2 * width > longest:
            break
        later = F.max("rank").over(along.rangeBetween(width, width))
        pairs = level.withColumn("next", later).where("next IS NOT NULL")
        ranks = numbered(pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), [F.col("rank"), F.col("next")], "pair", "line-ranks")
        level = written(heavy_join(pairs, ranks, ["rank", "next"], "n").select("c", "pos", F.col("pair").alias("rank")), "line-level")
        made += [ranks, level]
        width *= 2
        if level.isEmpty():
            break
    if runs is None:
        runs = asked.select("c", "from", "size", F.lit(0).cast("long").alias("ra"), F.lit(0).cast("long").alias("rb"))
    runs = written(runs, "line-runs")
    same = ["size", "ra", "rb"]
    first = written(runs.groupBy(*same).agg(F.min("from").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "line-first")
    copies = heavy_join(runs, first, same, "n").where("first < from").select("c", "from", (F.col("from") + F.col("size") - 1).alias("to"))
    by_start = Window.partitionBy("c").orderBy("from", "to")
    reached = F.max("to").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    copies = copies.withColumn("new", (reached.isNull() | (F.col("from") > reached + 1)).cast("int"))
    copies = copies.withColumn("run", F.sum("new").over(by_start)).groupBy("c", "run").agg(F.min("from").alias("from"), F.max("to").alias("to"))
    copies = copies.join(base.select(F.col("pos").alias("from"), "_id", "_h", F.col("line").alias("start")), "from")
    copies = copies.join(base.select(F.col("pos").alias("to"), F.col("line").alias("end")), "to")
    out = written(copies.groupBy("_id", "_h").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("removed")), "line-copies")
    for table in (base, digests, asked, runs, first, *made):
        drop_written(table)
    return out


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with ``text_col`` rid of later copies of repeated line runs, and ``n_lines, n_removed, removed``.

    ``removed`` lists the line ranges taken out (``start``, ``end``, inclusive, from 0) of the ``n_lines`` lines; blank
    lines between removed lines go with them. A text that copies earlier ones as a whole becomes empty. Null texts stay null and
    have no lines. Rows that repeat id and text count as one text and get the same result, an earlier copy of any line
    always stays. An empty table gives an empty result. All other columns pass through, except ones named like the three
    added, which these replace.
    """
    runs = copied_runs(df, id_col, text_col, min_words).select(F.col("_id").alias("_line_i"), F.col("_h").alias("_line_h"), F.col("removed").alias("_line_removed"))
    own = [c for c in df.columns if c not in ("n_lines", "n_removed", "removed")]
    joined = df.select(*own).withColumn("_line_x", F.xxhash64(text_of(text_col)))
    # merged at every size: whether the ranges are few enough to broadcast depends on the corpus
    joined = joined.join(runs.hint("merge"), F.col(id_col).eqNullSafe(F.col("_line_i")) & (F.col("_line_x") == F.col("_line_h")), "left")
    gone = F.coalesce("_line_removed", F.array().cast("array<struct<start:int,end:int>>"))
    n = F.size(gone)

    def cut(lines: Column, ranges: Column) -> Column:
        """What stays, as slices between the ranges."""
        own = F.size(ranges)
        slices = F.transform(
            F.sequence(F.lit(0), own),
            lambda k: F.struct(
                F.when(k == 0, 0).otherwise(F.get(ranges, k - 1)["end"] + 1).alias("from"),
                F.when(k == own, F.size(lines)).otherwise(F.get(ranges, k)["start"]).alias("to"),
            ),
        )
        return F.struct(F.size(lines).alias("n"), F.when(own > 0, F.array_join(F.flatten(F.transform(slices, lambda s: F.slice(lines, s["from"] + 1, s["to"] - s["from"]))), "\n")).alias("text"))

    # a lambda's argument is evaluated once: the text is split once, whatever is removed
    both = F.transform(F.array(F.struct(F.split(F.col(text_col), "\n").alias("l"), gone.alias("r"))), lambda x: cut(x["l"], x["r"]))
    joined = joined.withColumn("_line_cut", F.get(both, F.lit(0)))
    count = F.when(F.col(text_col).isNull(), 0).otherwise(F.col("_line_cut.n"))
    text = F.when(n == 0, F.col(text_col)).otherwise(F.col("_line_cut.text"))
    lost = F.aggregate(gone, F.lit(0), lambda a, r: a + r["end"] - r["start"] + 1)
    columns = [text.alias(text_col) if c == text_col else F.col(c) for c in own]
    return joined.select(*columns, count.cast("long").alias("n_lines"), lost.cast("long").alias("n_removed"), gone.alias("removed"))
