"""Mixing sources to target weights by Pfair scheduling, with DataFrame and SQL functions only.

A source's documents are laid end to end and cut into blocks of block_size. Block k of a source of weight w may run from
the slot in which an ideal fluid mix would begin it (release) to the slot in which that mix would have finished it
(deadline). Earliest deadline first over the released blocks then keeps every source, at every slot boundary, less than
one block from its fluid share. Sources that run out leave their share to the others: the fluid mix is piecewise linear
in virtual time V, slot t(V) = sum of min(n_j, w_j V), and all bounds come from it in integer arithmetic.

Weights are whole numbers, so at every whole V the fluid mix has given each source a whole number of blocks: min(n_j, w_j V).
Frames between whole V therefore begin and end with no block in progress and are independent, and all frames between two
ends of sources are alike. One EDF run for each kind of frame, a fold over its slots, gives the schedule of all of them;
there are at most two kinds for each source and one more. A frame has at most UNITS slots and one for each source.

Ranks of documents in a source come from hashed chunks and their prefix sums: a source with a third of all rows is
summed in as many tasks as its size asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.shared import documents, written

UNITS = 10_000  # target weights are rounded to whole units of one in so many


def _div(a: Column, b: Column) -> Column:
    """The whole quotient of whole numbers of 0 and more."""
    return F.floor((a - F.pmod(a, b)) / b).cast("long")  # exact: the dividend is a multiple, far below 2**53


def kinds(sources: DataFrame) -> DataFrame:
    """(kind, first, last, slot, each): frames first .. last - 1 of one kind, the first one's slot, and slots in each.

    sources(s, n blocks, w weight), a written table. A source is whole in the frames before n div w, and has blocks in those
    before that quotient rounded up; kinds change where one of the two does.
    """
    q = _div(F.col("n"), F.col("w"))
    up = _div(F.col("n") + F.col("w") - 1, F.col("w"))
    # t(V) = n of the sources that ended by frame V + V * w of the others
    ends = sources.groupBy(up.alias("first")).agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    cuts = ends.unionByName(sources.select(F.explode(F.array(F.lit(0).cast("long"), q)).alias("first"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("w")))
    order = Window.partitionBy(F.lit(0)).orderBy("first")  # two rows for each source
    total = sources.agg(F.sum("w")).scalar()
    cuts = cuts.groupBy("first").agg(F.sum("n").alias("n"), F.sum("w").alias("w"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    at = cuts.select("first", (F.row_number().over(order) - 1).alias("kind"), F.lead("first").over(order).alias("last"), F.sum("n").over(upto).alias("ended"), (total - F.sum("w").over(upto)).alias("rate"))
    slot = F.col("ended") + F.col("first") * F.col("rate")
    return at.withColumn("slot", slot).withColumn("each", _div(F.lead("slot").over(order) - F.col("slot"), F.col("last") - F.col("first"))).where("last IS NOT NULL").select("kind", "first", "last", "slot", "each")


def templates(sources: DataFrame, frames: DataFrame) -> DataFrame:
    """(kind, s, i, pos, release, deadline): where in a frame of this kind block i of the source's share runs, and its window."""
    up = _div(F.col("n") + F.col("w") - 1, F.col("w"))
    # the kinds in which a source has blocks are those before the one that begins where it has ended
    last = sources.withColumn("first", up).join(frames.select("first", F.col("kind").alias("k")), "first", "left")
    count = frames.agg(F.max("kind") + 1).scalar()
    within = last.select("s", "n", "w", F.explode(F.sequence(F.lit(0), F.coalesce("k", count) - 1)).alias("kind"))
    own = within.join(frames.select("kind", "first"), "kind").withColumn("m", F.least("w", F.col("n") - F.col("w") * F.col("first"))).where("m > 0").select("kind", "s", "w", "m")
    # t(v) within the frame, by one order of the sources' ends (v = m / w) and the blocks' bounds (v = i / w). Weights are
    # far below 2**26, so quotients are equal as doubles only where they are equal
    share = own.groupBy("kind").agg(F.sum("w").alias("all"))
    ends = own.where("m < w").select("kind", (F.col("m") / F.col("w")).alias("v"), F.col("m").alias("em"), F.col("w").alias("ew"), F.lit(None).cast("long").alias("i"), "s", "w", "m")
    bounds = own.select("kind", F.explode(F.sequence(F.lit(0).cast("long"), "m")).alias("i"), "s", "w", "m")
    bounds = bounds.select("kind", (F.col("i") / F.col("w")).alias("v"), F.lit(0).cast("long").alias("em"), F.lit(0).cast("long").alias("ew"), "i", "s", "w", "m")
    upto = Window.partitionBy("kind").orderBy("v").rangeBetween(Window.unboundedPreceding, 0)
    t = ends.unionByName(bounds).withColumn("em", F.sum("em").over(upto)).withColumn("ew", F.sum("ew").over(upto)).where("i IS NOT NULL").join(share, "kind")
    top = (F.col("all") - F.col("ew")) * F.col("i")
    t = t.select("kind", "s", "i", "m", (F.col("em") + _div(top, F.col("w"))).alias("down"), (F.col("em") + _div(top + F.col("w") - 1, F.col("w"))).alias("up"))
    jobs = t.withColumn("deadline", F.lead("up").over(Window.partitionBy("kind", "s").orderBy("i"))).where("i < m").withColumnRenamed("down", "release")
    # a frame's jobs by release, then the fold: slot by slot the released ones in order of deadline, the first of which runs
    groups = jobs.groupBy("kind", "release").agg(F.sort_array(F.collect_list(F.struct("deadline", "s", "i", "release"))).alias("jobs"))
    frame = groups.groupBy("kind").agg(F.sort_array(F.collect_list(F.struct("release", "jobs"))).alias("g"), F.sum(F.size("jobs")).alias("slots"), F.first("jobs").alias("some"))
    due = "coalesce(try_element_at(g, x.at).release = p, false)"
    fold = f"""aggregate(sequence(0L, slots - 1), struct(slice(some, 1, 0) AS ready, slice(some, 1, 0) AS done, 1 AS at),
        (x, p) -> aggregate(array(if({due}, array_sort(concat(x.ready, element_at(g, x.at).jobs)), x.ready)), x,
            (y, r) -> struct(slice(r, 2, size(r)) AS ready, concat(y.done, slice(r, 1, 1)) AS done, y.at + if({due}, 1, 0) AS at)), x -> x.done)"""
    return frame.select("kind", F.posexplode(F.expr(fold)).alias("pos", "j")).select("kind", "j.s", "j.i", "pos", "j.release", "j.deadline")


def placed(blocks: DataFrame, frames: DataFrame, inner: DataFrame) -> DataFrame:
    """blocks(s, k, w, ...) with release, deadline and slot. frames: from kinds; inner: from templates; both written."""
    each = frames.select("kind", F.explode(F.sequence("first", F.col("last") - 1)).alias("frame"), (F.col("slot") - F.col("first") * F.col("each")).alias("base"), "each")
    begin = each.select("kind", "frame", (F.col("base") + F.col("frame") * F.col("each")).alias("starts"))
    own = blocks.withColumn("frame", _div(F.col("k"), F.col("w"))).withColumn("i", F.pmod("k", "w"))
    at = own.join(begin, "frame").join(inner, ["kind", "s", "i"])
    return at.withColumn("slot", F.col("starts") + F.col("pos")).withColumn("release", F.col("starts") + F.col("release")).withColumn("deadline", F.col("starts") + F.col("deadline")).drop("kind", "frame", "i", "starts", "pos")


def schedule(sources: DataFrame) -> DataFrame:
    """sources(s, n blocks, w weight) -> (s, k, release, deadline, slot) for every block; slots run from 0 without a gap."""
    sources = written(sources, "sources")
    frames = written(kinds(sources), "kinds")
    inner = written(templates(sources, frames), "templates")
    blocks = sources.select("s", "w", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("k"))
    return placed(blocks, frames, inner).select("s", "k", "release", "deadline", "slot")


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block_size: int = 1 << 16, power: float = 0.5, chunk_rows: int = 4096) -> DataFrame:
    """One row per input row: id, source, block, release, deadline, slot, within (where in its block it begins).

    Ordering by slot and within gives the mixed stream. weights(source, weight): target shares; without them a source's
    share is its characters to the given power (0.5: small sources come up more often). A block is block_size characters;
    a document belongs to the block in which it begins, one longer than a block takes the slots of all that it covers.
    A null source counts as ''. Null and empty texts count one character. Repeated rows and rows with null ids are rows of
    their own, dealt by their place in the input. Sources without a weight, or with one of 0 or less, get the least unit, of
    which there is one for each source at least, however many sources there are. An empty table gives an empty result.
    Columns beside id, source and text are not read.
    """
    size = F.greatest(F.coalesce(F.length(F.col(f"`{text_col}`").cast("string")), F.lit(0)), F.lit(1)).cast("long")
    source = F.col(f"`{source_col}`")
    base = docs.select(F.col(f"`{id_col}`").alias("id"), source.alias("source"), F.coalesce(source.cast("string"), F.lit("")).alias("s"), size.alias("size"), F.monotonically_increasing_id().alias("u"))
    base = written(base, "mix")
    totals = base.groupBy("s").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("rows"))
    if weights is None:
        totals = totals.withColumn("share", F.pow("total", F.lit(power)))
    else:
        given = weights.select(F.coalesce(F.col("source").cast("string"), F.lit("")).alias("s"), F.col("weight").cast("double").alias("share")).groupBy("s").agg(F.sum("share").alias("share"))
        totals = totals.join(given, "s", "left").withColumn("share", F.greatest(F.coalesce("share", F.lit(0.0)), F.lit(0.0)))
    all_ = totals.agg(F.sum("share")).scalar()
    unit = F.greatest(F.coalesce(F.round(UNITS * F.col("share") / F.nullif(all_, F.lit(0.0))), F.lit(1)), F.lit(1)).cast("long")
    sources = written(totals.select("s", "rows", _div(F.col("total") + block_size - 1, F.lit(block_size)).alias("n"), unit.alias("w")), "sources")
    frames = written(kinds(sources), "kinds")
    inner = written(templates(sources, frames), "templates")
    chunked = base.join(sources.select("s", "rows", "w"), "s").withColumn("chunk", F.pmod(F.xxhash64("id", "u"), F.ceil(F.col("rows") / chunk_rows)))
    running = F.sum("size").over(Window.partitionBy("s", "chunk").orderBy("id", "u").rowsBetween(Window.unboundedPreceding, -1))
    sums = chunked.groupBy("s", "chunk").agg(F.sum("size").alias("size"))
    before = sums.select("s", "chunk", F.coalesce(F.sum("size").over(Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    begin = chunked.withColumn("own", F.coalesce(running, F.lit(0))).join(before, ["s", "chunk"]).withColumn("begin", F.col("own") + F.col("before"))
    rows = begin.select("id", "source", "s", "w", "begin", _div(F.col("begin"), F.lit(block_size)).alias("k"))
    return placed(rows, frames, inner).select(F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("k").alias("block"), "release", "deadline", "slot", (F.col("begin") - F.col("k") * block_size).alias("within"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix: files follow each other by slot, and rows within a file.

    Null sources count as one source, null and empty texts as one character. Rows of one doc_id come at one place, rows with
    a null doc_id at the end. Extra columns pass through under any name. Empty in, empty out.
    """
    order = mix_sources(docs.select("doc_id", "source", "text")).where("doc_id IS NOT NULL")
    order = order.groupBy(F.col("doc_id").alias("_of")).agg(F.min(F.struct("slot", "within")).alias("_at"))
    carried = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)], F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_h"))
    at = carried.join(order, carried["_id"] == order["_of"], "left")
    at = at.withColumns({"_slot": F.coalesce("_at.slot", F.lit((1 << 63) - 1)), "_within": F.coalesce("_at.within", F.lit(0).cast("long"))})
    dealt = at.repartitionByRange("_slot", "_within", "_h").sortWithinPartitions("_slot", "_within", "_h")
    return dealt.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


QUERIES = {"op8_mix_sources": op8_mix_sources}
