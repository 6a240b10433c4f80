"""Mixing sources to target weights by systematic sampling, in DataFrame functions only."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkrank.llm.common import WORD, Work

#: Weights of the sources in code point order, again and again.
WEIGHTS = (5, 2, 1)
DRAWS = 32
#: A document of over one part in so many of its source is drawn first, and the others make up for it.
HEAVY_PART = 50
#: Rows alike in id, source and size that one task gives back at a time.
ALIKE = 10_000


def offsets(seed: int, draws: int = DRAWS) -> list[float]:
    """The random offsets among which each source takes the one that brings it nearest to its target."""
    rng = random.Random(seed)
    return [rng.random() for _ in range(draws)]


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, times: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row for each source.

    All targets together are ``times[0] / times[1]`` of all sizes, shared by weight; a target above ``most`` times its
    source's size stops there, and the excess goes to the others by weight. The sources that stop are a prefix
    in the order of cap over weight, so two running sums over the sources find the level. All sums are whole numbers.
    """
    up, down = times
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")).cast("long")
    rows = sizes.withColumn("w", weight).withColumn("cap", F.col("source_size") * most)
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.select(
        "source", "source_size", "w", "cap",
        (up * F.sum("source_size").over(every) - down * F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("num"),
        (down * (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0)))).alias("den"),
    )
    stops = F.col("w") * F.col("num") > F.col("cap") * F.col("den")
    level = F.min(F.when(~stops, F.struct(F.col("cap") / F.col("w"), F.col("num").alias("num"), F.col("den").alias("den")))).over(every)
    rows = rows.withColumn("stops", stops).withColumn("level", level)
    share = (F.col("w") * F.col("level.num")).cast("double") / F.col("level.den").cast("double")
    return rows.select("source", "source_size", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(documents: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS, draws: int = DRAWS, heavy_part: int = HEAVY_PART) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies)`` for each row of ``documents (doc_id, text, source)``.

    size is the number of words in the whole text, 0 for null. A document's expected copies are its source's target over its size.
    They are summed up along the source, a random offset is added, and the document is taken once for each whole number
    passed. Within a source documents come by size class, then spread by a hash of doc_id, then by size, which
    keeps the words taken near the target. The fewer than ``heavy_part`` documents that each hold over one part in ``heavy_part`` of their
    source are drawn first, and the expected copies of the others are set to what is left of the target. The best of ``draws``
    seeded offsets is used, so reruns agree; with ``draws=1`` and ``heavy_part=1`` it is the plain method, one offset and one rate.
    Rows alike in doc_id, source and size share one decision. A null source is a source of its own, the last one; null
    ids are allowed. Sources of size 0 take what their expected copies of 0 give: nothing.

    Ranks along a source come from blocks of about the square root of a size class: a count within each block, and a running
    sum over the blocks. No task holds a whole source, and only the table of sources is ordered in one place.
    """
    work = Work(documents.sparkSession, "mix")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = documents.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    key = F.coalesce(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("long"), F.lit(0))
    units = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("rows")).withColumn("key", key).withColumn("class", F.length(F.bin("size")))
    units = work.store(units, "units")
    classes = work.store(units.groupBy("source", "class").agg(F.count("*").alias("n"), F.sum(F.col("size") * F.col("rows")).alias("words")), "classes")
    sources = work.store(targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights), "sources")
    several = classes.join(sources, classes.source.eqNullSafe(sources.source)).select(classes.source.alias("of"), F.col("class").alias("in"), "source_size", "target", (F.floor(F.sqrt("n")) + 1).alias("parts"))
    several = work.store(several, "parts")
    placed = units.join(several, units.source.eqNullSafe(several["of"]) & (units["class"] == several["in"])).drop("of", "in")
    placed = placed.withColumn("part", F.col("key") % F.col("parts")).withColumn("heavy", F.col("size") * F.col("rows") * heavy_part > F.col("source_size"))
    blocks = placed.groupBy("source", "heavy", "class", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("source", "heavy").orderBy("class", "part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = work.store(blocks.select("source", "heavy", "class", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead")), "blocks")
    within = Window.partitionBy("source", "heavy", "class", "part").orderBy("size", "key", "doc_id")
    local = work.store(placed.withColumn("place", F.row_number().over(within)), "local")
    at = blocks.select(F.col("source").alias("of"), F.col("heavy").alias("kind"), F.col("class").alias("in"), F.col("part").alias("no"), "ahead")
    ranked = local.join(at, local.source.eqNullSafe(at["of"]) & (local["heavy"] == at["kind"]) & (local["class"] == at["in"]) & (local["part"] == at["no"]))
    ranked = work.store(ranked.select("doc_id", "source", "size", "rows", "source_size", "target", "heavy", (F.col("ahead") + F.col("place")).alias("rank")), "ranked")
    at_random = offsets(seed, draws)

    def crossed(rate, offset):
        return F.floor(rate * F.col("rank") + offset) - F.floor(rate * (F.col("rank") - 1) + offset)

    words, rate = F.col("size") * F.col("rows"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    first = ranked.where("heavy").groupBy("source").agg(F.sum(words).alias("words"), F.array(*(F.sum(words * crossed(rate, F.lit(u))) for u in at_random)).alias("taken"))
    first = sources.alias("s").join(first.alias("f"), F.col("s.source").eqNullSafe(F.col("f.source")), "left")
    none = F.array(*(F.lit(0).cast("long") for _ in at_random))
    first = first.select(F.col("s.source").alias("of"), (F.col("source_size") - F.coalesce("words", F.lit(0))).alias("light"), F.col("target").alias("goal"), F.coalesce("taken", none).alias("taken"))
    left = F.transform("taken", lambda x: F.when(F.col("light") > 0, F.greatest(F.lit(0.0), F.least(F.lit(2.0), (F.col("goal") - x) / F.col("light")))).otherwise(F.lit(0.0)))
    first = work.store(first.select("of", "goal", "taken", left.alias("rates")), "first")
    others = ranked.where("not heavy").join(first.select("of", "rates"), F.col("source").eqNullSafe(F.col("of")))
    others = others.groupBy("of").agg(F.array(*(F.sum(words * crossed(F.col("rates")[k], F.lit(u))) for k, u in enumerate(at_random))).alias("more"))
    all_ = first.alias("f").join(others.alias("o"), F.col("f.of").eqNullSafe(F.col("o.of")), "left")
    best = F.array_min(F.array(*(F.struct(F.abs(F.col("taken")[k] + F.coalesce(F.col("more")[k], F.lit(0)) - F.col("goal")).alias("miss"), F.lit(u).alias("offset"), F.col("rates")[k].alias("rate")) for k, u in enumerate(at_random))))
    chosen = work.store(all_.select(F.col("f.of").alias("of"), best["offset"].alias("offset"), best["rate"].alias("light_rate")), "offsets")
    taken = ranked.join(chosen, ranked.source.eqNullSafe(chosen["of"]))
    copies = crossed(F.when(F.col("heavy"), rate).otherwise(F.col("light_rate")), F.col("offset"))
    columns = ["doc_id", "source", "size", "source_size", "target", "copies"]
    taken = taken.withColumn("copies", copies.cast("long"))
    few = taken.where(F.col("rows") <= ALIKE).select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("row"))
    # Many rows alike: their pieces are dealt over all tasks before they become rows again.
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / ALIKE))).alias("piece")
    many = taken.where(F.col("rows") > ALIKE).select(*columns, "rows", piece).repartition("piece", "doc_id")
    many = many.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(ALIKE).cast("long"), F.col("rows") - F.col("piece") * ALIKE))).alias("row"))
    return few.unionByName(many).select(*columns)


def mixed(documents: DataFrame, seed: int = 7, weights: Sequence[int] = WEIGHTS, draws: int = DRAWS, heavy_part: int = HEAVY_PART) -> DataFrame:
    """The mix itself: each row of ``documents`` as often as it is taken, with its columns as they are."""
    decided = mix(documents, seed, weights, draws, heavy_part).where("copies > 0").select(*(F.col(c).alias(f"of_{c}") for c in ("doc_id", "source", "size", "copies"))).distinct()
    row = F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")  # so that no column of the caller's can clash
    size = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    rows = documents.select(row, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    same = rows.doc_id.eqNullSafe(decided.of_doc_id) & rows.source.eqNullSafe(decided.of_source) & (rows["size"] == decided.of_size)
    taken = rows.join(decided, same).select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("of_copies"))).alias("copy"))
    return taken.select("row.*")
