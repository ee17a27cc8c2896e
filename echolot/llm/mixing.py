"""Mixing sources to target weights: Sainte-Lague apportionment of equal-token blocks.

The mix has as many words as all documents together. Each source has a target by its weight,
never above ``REPEATS`` times its size. The mix is cut into blocks of equal size; sources
get blocks by highest quotients ``target / (2k + 1)``, and the blocks of a source go to its
shards in the same way by the shards' sizes. So each shard has an integer quota before any
block is chosen. A shard is a stream of its documents in seeded order, repeated up to
``REPEATS`` times and cut into blocks; the quota takes blocks of the first pass in seeded
order, then those of the next. A document gets the words that chosen blocks share with it.

Everything is Spark functions. A source that holds most rows is many shards. Tables with one
row per source or per shard are small: there are at most ``MAX_SHARDS`` shards beyond one
per source, whatever the input. Null and empty texts have size 0 and take nothing; a null
source is a source, last in order; repeated rows are documents of their own; an empty table
gives an empty mix. Digests are MD5, which every SQL engine has, so reruns agree anywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolot.llm.common import staged, text_or_empty

REPEATS = 3
SEED = "mix"
MAX_BLOCK = 512
BLOCKS = 65536
SHARD_WORDS = 65536
MAX_SHARDS = 16384
ONE = 2**32
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def apportion(rows: DataFrame, group: list[str], votes: str, seats: str, tie: str) -> DataFrame:
    """``rows`` with ``quota``: the seats of each group by highest quotients votes / (2k + 1).

    Quotients far above the last seat's are won in any case, so only those near a row's exact
    share are listed and ranked: about five for each row and two for each row's share.
    """
    within = Window.partitionBy(*group)
    n, total = F.count(F.lit(1)).over(within), F.sum(votes).over(within)
    share = F.when(total > 0, F.col(votes) / total).otherwise(F.lit(0.0))
    near = rows.withColumn("_margin", 2 + F.ceil(n * share)).withColumn(
        "_sure", F.greatest(F.lit(0), F.floor(F.col(seats) * share) - F.col("_margin"))
    )
    near = near.withColumn("_open", F.col(seats) - F.sum("_sure").over(within))
    listed = near.where(F.col(votes) > 0).select(
        *group, tie, "_open", votes,
        F.explode(F.sequence(F.col("_sure"), F.col("_sure") + 2 * F.col("_margin"))).alias("_k"),
    ).withColumn("_q", F.col(votes) / (2 * F.col("_k") + 1))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("_q"), tie))
    won = listed.withColumn("_rank", rank).where(F.col("_rank") <= F.col("_open"))
    won = won.groupBy(*group, tie).agg(F.count(F.lit(1)).alias("_won"))
    return (
        near.join(won, [*group, tie], "left")
        .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .drop("_margin", "_sure", "_open", "_won")
    )


def targets(sources: DataFrame, total: int) -> DataFrame:
    """Target of each source: ``weight * level``, or its cap where that is less.

    Sources in the order of ``cap / weight`` fill up one after another, so the level at which the
    rest share what is left follows from running sums.
    """
    by_name = Window.partitionBy("one").orderBy(F.asc_nulls_last("source"))
    rows = (
        sources.withColumn("one", F.lit(1))
        .withColumn("source_no", F.row_number().over(by_name))
        .withColumn("weight", (F.col("source_no") - 1) % 3 + 1)
        .withColumn("cap", REPEATS * F.col("source_size"))
    )
    by_fill = Window.partitionBy("one").orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = F.sum("cap").over(by_fill) - F.col("cap")
    left = F.sum("weight").over(Window.partitionBy("one")) - F.sum("weight").over(by_fill) + F.col("weight")
    rows = rows.withColumn("_level", (F.lit(total) - before).cast("double") / left)
    full = F.col("cap") / F.col("weight") <= F.col("_level")
    level = F.min(F.when(~full, F.struct(F.col("cap") / F.col("weight"), F.col("source_no"), F.col("_level"))))
    return rows.withColumn(
        "target",
        F.coalesce(
            F.least(F.col("cap").cast("double"), F.col("weight") * level.over(Window.partitionBy("one"))["_level"]),
            F.col("cap").cast("double"),
        ),
    ).drop("_level")


def mix(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of ``docs``."""
    return placed_mix(docs, seed).select("doc_id", "size", "source_size", "target", "taken")


def placed_mix(docs: DataFrame, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """The mix with each row's source_no, shard and place in the shard, and with the columns ``keep``,
    which also order rows of equal id and size."""
    sized = staged(
        docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), *keep), "mix-sizes"
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    block = max(1, min(MAX_BLOCK, total // BLOCKS))
    shard_words = max(SHARD_WORDS, total // MAX_SHARDS)
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = apportion(
        targets(sources, total).withColumn("seats", F.lit((2 * total + block) // (2 * block))),
        ["one"], "target", "seats", "source_no",
    )
    sources = staged(
        sources.select(
            "source", "source_no", "source_size", "target", F.col("quota").alias("source_quota"),
            F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).alias("shards"),
        ),
        "mix-sources",
    )
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    placed = (
        sized.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .withColumn("digest", digest)
        .withColumn("shard", F.conv(F.substring("digest", 1, 8), 16, 10).cast("long") % F.col("shards"))
    )
    in_shard = Window.partitionBy("source_no", "shard").orderBy("digest", "doc_id", "size", *keep)
    placed = staged(
        placed.withColumn("place", F.row_number().over(in_shard))
        .withColumn("end", F.sum("size").over(in_shard.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("shard_size", F.sum("size").over(Window.partitionBy("source_no", "shard")))
        .drop("source", "name", "digest", "shards"),
        "mix-places",
    )
    shards = placed.groupBy("source_no", "shard").agg(
        F.first("shard_size").alias("shard_size"), F.first("source_quota").alias("source_quota")
    )
    shards = apportion(shards, ["source_no"], "shard_size", "source_quota", "shard")
    room = F.ceil(REPEATS * F.col("shard_size") / block)
    shards = staged(
        shards.select("source_no", "shard", "shard_size", F.least("quota", room).alias("quota")), "mix-quotas"
    )
    shards = shards.where("quota > 0").withColumn("passes", passes_of(block))

    number = F.explode(
        F.sequence(
            F.lit(0).cast("long"),
            F.least(F.ceil(REPEATS * F.col("shard_size") / block), F.ceil(F.col("passes") * F.col("shard_size") / block)) - 1,
        )
    )
    blocks = shards.select("source_no", "shard", "shard_size", "quota", number.alias("block"))
    name = F.md5(F.concat_ws(":", F.lit(seed), "source_no", "shard", "block"))
    first_passes = Window.partitionBy("source_no", "shard").orderBy(
        F.floor(F.col("block") * block / F.col("shard_size")), name, "block"
    )
    chosen = (
        blocks.withColumn("rank", F.row_number().over(first_passes))
        .where("rank <= quota")
        .select("source_no", "shard", "block", F.lit(True).alias("chosen"))
    )

    start = F.col("end") - F.col("size")
    meets = placed.join(shards.select("source_no", "shard", "passes"), ["source_no", "shard"], "left")
    meets = meets.select(
        "*",
        F.explode_outer(
            F.when(
                F.col("size") > 0,
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(0).cast("long"), F.least(F.lit(REPEATS), F.col("passes") + 1) - 1),
                        lambda p: F.transform(
                            F.sequence(
                                F.floor((p * F.col("shard_size") + start) / block),
                                F.floor((p * F.col("shard_size") + F.col("end") - 1) / block),
                            ),
                            lambda b: F.struct(
                                b.alias("block"),
                                (
                                    F.least(p * F.col("shard_size") + F.col("end"), (b + 1) * block)
                                    - F.greatest(p * F.col("shard_size") + start, b * block)
                                ).alias("shared"),
                            ),
                        ),
                    )
                ),
            )
        ).alias("x"),
    ).select("*", "x.block", "x.shared")
    return (
        meets.join(chosen, ["source_no", "shard", "block"], "left")
        .groupBy("source_no", "shard", "place", "doc_id", "size", "source_size", "target", *keep)
        .agg(F.coalesce(F.sum(F.when(F.col("chosen"), F.col("shared"))), F.lit(0)).alias("taken"))
    )


def whole_copies(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """Rows of ``docs``, each as many times as the mix takes of it, in whole documents.

    A document gets ``taken div size`` copies, and one more with the chance that is left. The parts
    left are added up along the shards of a source, within a shard by size, and each time
    the sum passes an integer, the document there gets its further copy. A seeded offset
    makes this free of bias for each document. Neighbours in this order have nearly equal sizes (odd shards
    run downwards), so what one document has too much its neighbours have too little, and the words of
    a source come near its target. Rows are told apart by a row number in a written table.
    """
    rows = staged(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("row_no")), "mix-rows")
    order = F.md5(F.to_json("row")).alias("row_key")
    mixed = placed_mix(rows.select("row.doc_id", "row.source", "row.text", order, "row_no"), seed, ("row_key", "row_no"))
    mixed = staged(
        mixed.where("taken > 0").select(
            "source_no", "shard", "place", "size", "row_no",
            F.expr("taken div size").alias("whole"), F.expr(f"(taken % size) * {ONE} div size").alias("part"),
        ),
        "mix-taken",
    )
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "source_no")), 1, 8), 16, 10).cast("long")
    by_shard = Window.partitionBy("source_no").orderBy("shard")
    offsets = mixed.groupBy("source_no", "shard").agg(F.sum("part").alias("parts")).select(
        "source_no", "shard", (start + F.sum("parts").over(by_shard) - F.col("parts")).alias("offset")
    )
    by_size = Window.partitionBy("source_no", "shard").orderBy(
        F.when(F.col("shard") % 2 == 0, F.col("size")).otherwise(-F.col("size")), "place"
    )
    upto = F.col("offset") + F.sum("part").over(by_size.rowsBetween(Window.unboundedPreceding, 0))
    further = F.shiftright(upto, 32) - F.shiftright(upto - F.col("part"), 32)
    copies = (
        mixed.join(offsets, ["source_no", "shard"])
        .select("row_no", (F.col("whole") + further).cast("int").alias("copies"))
        .where("copies > 0")
    )
    each = rows.join(copies, "row_no").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select("row.*")


def passes_of(block: int) -> Column:
    """Passes over a shard in which its quota of blocks starts."""
    return F.least(F.lit(REPEATS).cast("long"), F.floor(F.col("quota") * block / F.col("shard_size")) + 1)
