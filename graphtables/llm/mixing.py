"""Mixing sources to target weights along a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphtables.llm.common import pick, read, settled
from graphtables.session import join_side, size_of

WORD = r"[^\x20\x09-\x0D]+"
#: Words of a block.
BLOCK = 1024
#: Hash ranges that the documents of a source, and runs that the slots of the schedule, are cut into
#: for running sums and ranks: one task never orders a whole source.
RANGES = 4096  # 2 ** 12 of 2 ** 60 hashes
RUN = 65536
#: Bits of a slot's number.
BITS = 40


def targets(sizes: DataFrame, weights=(5.0, 2.0, 1.0), cap: float = 3.0) -> DataFrame:
    """The words each source should give: source, source_size, weight, target.

    ``sizes`` has source and source_size. Sources in the order of their code points, null last, take the
    ``weights`` in turn and share the sum of all sizes by them. No target exceeds ``cap`` times its
    source's size: what is above is shared again by weight among the others until nothing is above.
    The end of that process is ``min(cap * size, level * weight)``: sources are full in the order of size
    over weight, so the level follows from running sums over them. One row per source meets in one
    task, never the documents.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    ranked = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")))
    before = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = before.rowsBetween(Window.unboundedPreceding, -1)
    rest = before.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - cap * F.coalesce(F.sum("source_size").over(upto), F.lit(0))
    level = ranked.withColumn("level", left / F.sum("weight").over(rest)).withColumn("pos", F.row_number().over(before))
    full = F.col("level") * F.col("weight") > cap * F.col("source_size")
    # the first source that is not full gives the level of all that follow it
    free = F.min(F.when(~full, F.struct("pos", "level"))).over(Window.partitionBy())["level"]
    target = F.least(cap * F.col("source_size"), F.coalesce(free * F.col("weight"), cap * F.col("source_size")))
    return level.select("source", "source_size", "weight", target.alias("target"))


def slots(plan: DataFrame, block: int = BLOCK) -> DataFrame:
    """The schedule: slot, sid, rank, words. ``plan`` has sid, target.

    Slot s lies at the s-th van der Corput point (its bits read backwards), and belongs to the source on
    whose stretch of the cumulative targets that point falls, so every run of slots has the sources in
    their proportions. The ranks of a source's slots are the numbers of the blocks that it gives. A source
    gives whole blocks and then the rest of its target; slots beyond that are dropped (their numbers are left
    out), and blocks that the points did not reach follow at the end, source after source.
    """
    spark = plan.sparkSession
    ordered = Window.orderBy("sid")
    total = Window.partitionBy()
    goal = F.floor(F.col("target")).cast("bigint")
    stretch = plan.select(
        "sid",
        goal.alias("goal"),
        F.ceil(goal / block).cast("bigint").alias("n"),
        (F.coalesce(F.sum("target").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
         / F.sum("target").over(total)).alias("low"),
        (F.sum("target").over(ordered) / F.sum("target").over(total)).alias("high"),
    ).where("goal > 0")
    stretch = settled(stretch, "stretches")
    n_slots = stretch.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    bits = F.lpad(F.bin("id"), BITS, "0")
    point = F.conv(F.reverse(bits), 2, 10).cast("bigint") / F.lit(float(2**BITS))
    drawn = spark.range(n_slots).select(F.col("id").alias("slot"), F.floor(point * RANGES).alias("cell"), point.alias("x"))
    # a stretch is found by its cells, so this is an equality join and not a comparison with every source
    cells = stretch.select(
        "sid", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") * RANGES), F.least(F.floor(F.col("high") * RANGES), F.lit(RANGES - 1).cast("bigint")))).alias("cell"),
    )
    drawn = drawn.join(join_side(cells, size_of(cells)), "cell").where("x >= low AND x < high").select("slot", "sid")
    drawn = drawn.withColumn("run", F.floor(F.col("slot") / RUN))
    runs = settled(drawn.groupBy("sid", "run").agg(F.count(F.lit(1)).alias("n")), "runs")
    reached = runs.groupBy("sid").agg(F.sum("n").alias("reached")).withColumnRenamed("sid", "rsid")
    missed = F.greatest(F.col("n") - F.coalesce("reached", F.lit(0)), F.lit(0))
    behind = F.coalesce(F.sum(missed).over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    stretch = stretch.join(reached, F.col("sid") == F.col("rsid"), "left").select(
        "sid", "goal", "n", (F.lit(n_slots) + behind - F.coalesce("reached", F.lit(0))).alias("tail")
    )
    earlier = Window.partitionBy("sid").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("sid", "run", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "run").orderBy("slot")
    ranked = drawn.join(runs, ["sid", "run"]).select(
        "slot", "sid", (F.col("base") + F.row_number().over(within) - 1).alias("rank")
    )
    wanted = stretch.where("n > 0").select("sid", "goal", "tail", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("rank"))
    return wanted.join(ranked, ["sid", "rank"], "left").select(
        F.coalesce("slot", F.col("tail") + F.col("rank")).alias("slot"), "sid", "rank",
        F.least(F.lit(block).cast("bigint"), F.col("goal") - F.col("rank") * block).alias("words"),
    )


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` (sid, id, size, h) with the offset of each among the words of its source, in the order of h."""
    cell = F.shiftright("h", 48).alias("cell")
    rows = docs.select("*", cell)
    cells = rows.groupBy("sid", "cell").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("sid", "cell", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("sid", "cell").orderBy("h", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(cells, ["sid", "cell"]).withColumn(
        "off", F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )


def _shuffle_key(doc_id, seed: int):
    """60 bits of a hash of seed and id; a null id counts as empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _mixture(docs: DataFrame, id_col, text_col, source_col, weights, cap, block, seed) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sources with their targets, the documents with their offsets, and the rows of the mix."""
    rows = pick(docs, id=id_col, text=text_col, source=source_col)
    size = F.regexp_count("text", F.lit(WORD)).cast("bigint")
    sized = settled(
        rows.select(
            "id",
            "source",
            F.coalesce(size, F.lit(0).cast("bigint")).alias("size"),
            _shuffle_key(F.col("id"), seed).alias("h"),
        ),
        "sizes",
    )
    plan = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    plan = settled(plan.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))), "targets")
    side = join_side(plan, size_of(plan))
    given = F.floor(F.col("target")).cast("bigint")
    known = sized.join(side, sized["source"].eqNullSafe(side["source"])).select("id", "size", "h", "sid", "source_size", "target")
    docs_at = settled(placed(known), "placed")

    # each time that a document is laid out, the blocks it lies in
    begin = F.col("off") + F.col("time") * F.col("source_size")
    laid = docs_at.where("size > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(int(-(-cap // 1)) - 1))).alias("time"))
    laid = laid.select("id", "sid", "off", "size", begin.alias("begin"), given.alias("given")).where("begin < given")
    first, last = F.floor(F.col("begin") / block), F.floor((F.least(F.col("begin") + F.col("size"), F.col("given")) - 1) / block)
    pieces = laid.select("*", F.explode(F.sequence(first, last)).alias("rank"))
    chosen = slots(plan.select("sid", "target"), block)
    start = F.greatest(F.col("begin"), F.col("rank") * block)
    end = F.least(F.col("begin") + F.col("size"), F.col("rank") * block + F.col("words"))
    mixed = pieces.join(chosen, ["sid", "rank"]).select(
        "slot", "sid", "rank", (start - F.col("rank") * block).alias("at"), "id", "off",
        (start - F.col("begin")).alias("from_word"), (end - F.col("begin")).alias("to_word"),
    )
    return plan, docs_at, settled(mixed, "mixed")


def mixture(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=(5.0, 2.0, 1.0),
    cap: float = 3.0,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """The mix itself: slot, source, rank, at, id, from_word, to_word.

    ``targets`` says what each source gives. The documents of a source are shuffled (by a hash of ``seed`` and id),
    laid end to end as often as needed, and cut into blocks of ``block`` words; block ``rank`` of a source lies in
    the ``slot`` that the schedule (``slots``) gives it. A row is a stretch of a document, its words from_word to
    to_word (counted from 0, end exclusive), that begins at word ``at`` of that block. Read in the order of
    slot and at, the rows are the mixed sequence: as many words as the whole parts of all targets, and every run of
    slots has the sources in their proportions.

    Words, null sources, ties and repeated ids are as in ``mix``.
    """
    plan, _, mixed = _mixture(docs, id_col, text_col, source_col, weights, cap, block, seed)
    names = plan.select("sid", "source")
    return mixed.join(join_side(names, size_of(names)), "sid").select(
        "slot", "source", "rank", "at", F.col("id").alias(id_col), "from_word", "to_word"
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=(5.0, 2.0, 1.0),
    cap: float = 3.0,
    block: int = BLOCK,
    seed: int = 17,
) -> DataFrame:
    """One row per row of ``docs``: id, size, source_size, target, taken.

    Size is the number of words (runs of anything but white space; null has none). Target is what the source gives
    (``targets``), taken the words of the document in the rows of the mix (``mixture``), repeats counted. A
    source gives the whole part of its target, and a document at most ``ceil(cap)`` times its size.

    A null source is a source. Ties of the hash go by id and size. Rows of one id are so many documents;
    when they also have the same size they are interchangeable. Documents without words, and tables
    without any, take part with zeros; an empty table gives an empty table.
    """
    _, docs_at, mixed = _mixture(docs, id_col, text_col, source_col, weights, cap, block, seed)
    taken = mixed.groupBy("sid", "off").agg(F.sum(F.col("to_word") - F.col("from_word")).alias("part"))
    # documents that have words differ in where they begin; the others take nothing
    key = F.when(F.col("size") > 0, F.col("off"))
    return (
        docs_at.withColumn("key", key)
        .join(taken.withColumnsRenamed({"sid": "tsid", "off": "toff"}), (F.col("sid") == F.col("tsid")) & (F.col("key") == F.col("toff")), "left")
        .select(
            F.col("id").alias(id_col), "size", "source_size", "target",
            F.coalesce("part", F.lit(0)).cast("bigint").alias("taken"),
        )
    )


def op7_mix(spark, sf_dir):
    return mix(read(spark, sf_dir, "documents"))


QUERIES = {"op7_mix": op7_mix}

ORACLE = {
    "op7_mix": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
            FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
            FROM d GROUP BY source
        ), r AS (
            SELECT *, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS pos,
                   sum(source_size) OVER () - 3.0::DOUBLE * (coalesce(sum(source_size) OVER (
                       ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lft,
                   sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS wts
            FROM s
        ), f AS (
            SELECT lft / wts AS level FROM r WHERE lft / wts * w <= 3.0::DOUBLE * source_size ORDER BY pos LIMIT 1
        ), p AS (
            SELECT doc_id, size, source_size,
                   least(3.0::DOUBLE * source_size, coalesce((SELECT level FROM f) * w, 3.0::DOUBLE * source_size)) AS target,
                   sum(size) OVER (PARTITION BY d.source ORDER BY
                       ('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT, doc_id, size) - size AS off
            FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
        )
        SELECT doc_id, size, source_size, target,
               CAST(greatest(0, least(off + size, floor(target)) - off)
                    + greatest(0, least(off + size, floor(target) - source_size) - off)
                    + greatest(0, least(off + size, floor(target) - 2 * source_size) - off) AS BIGINT) AS taken
        FROM p
    """,
}
