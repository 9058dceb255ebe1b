"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets: sources by code point, null last, weigh 3, 1, 2 and so on; they share EXTRA times all words,
a target stops at LIMIT times its source's size and the excess is shared by weight again until none
is above. Blocks of BLOCK words go to the sources by highest quotients target / (2 j - 1), then
inside a source to its regions and inside a region to its shards by size, so that no window holds
more than the sources, the regions of one source or REGION shards. A shard lays its documents out in
seeded order, cuts the words into equal blocks and takes its quota: whole passes first, then the
blocks of lowest seeded hash. A hot source has many shards, none of which is large.

Defined results: a null text has size 0, is taken 0 words and its row is returned; repeated rows are
rows of their own; a null source is a source; all sizes zero give targets of zero; no rows give no
rows. Only doc_id, text and source are read, whatever other columns are called. Everything here is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.llm.common import SPACES
from tripflow.session import stage

WEIGHTS = (3, 1, 2)
EXTRA, LIMIT = 1.5, 2
BLOCK = 256
SHARD_WORDS = 1 << 15
REGION = 1024
SEED = 20
#: Up to so many sources are broadcast as a table; more are joined by a shuffle.
SENT = 50_000


def word_count(text: Column) -> Column:
    """Words between white space; null: 0."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(F.length(body) == 0, 0).otherwise(F.size(F.split(body, SPACES))).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(unnamed, source, source_size, weight, target) from (unnamed, source, source_size).

    Below the common level a source gets weight times the level, above it its limit. Ordered by
    limit per weight, the first source that the level of it and all later ones does not lift above
    its limit fixes that level.
    """
    by_name, everything = W.partitionBy(F.lit(0)).orderBy("unnamed", "source"), W.partitionBy(F.lit(0))
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    rows = sizes.withColumn("weight", F.get(weights, (F.row_number().over(by_name) - 1) % len(WEIGHTS)))
    rows = rows.withColumn("most", LIMIT * F.col("source_size").cast("double"))
    by_limit = everything.orderBy(F.col("most") / F.col("weight"), "unnamed", "source")
    earlier, later = by_limit.rowsBetween(W.unboundedPreceding, -1), by_limit.rowsBetween(0, W.unboundedFollowing)
    to_share = EXTRA * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(earlier), F.lit(0.0))
    rows = rows.withColumn("place", F.row_number().over(by_limit)).withColumn("level", to_share / F.sum("weight").over(later))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("place"))
    level = F.min_by(F.col("level"), fits).over(everything)
    target = F.least(F.col("weight") * F.coalesce(level, F.lit(float("inf"))), F.col("most"))
    return rows.withColumn("target", target).select("unnamed", "source", "source_size", "weight", "target")


def apportion(parts: DataFrame, group: list[str], member: list[str]) -> DataFrame:
    """``parts`` with their ``quota`` of the group's ``seats``: the highest quotients votes / (2 j - 1) win.

    With n members, votes * (seats - n/2) / total rounded gives at most all seats, and with + n/2 at
    least all, so only the seats between the two, at most 2 n of them, are ranked. Ties go to the
    smaller member.
    """
    whole = W.partitionBy(*group)
    rows = parts.withColumn("_all", F.sum("votes").over(whole)).withColumn("_n", F.count(F.lit(1)).over(whole))

    def rounded(seats: Column) -> Column:
        share = F.col("votes") * F.greatest(seats, F.lit(0.0)) / F.col("_all")
        return F.when((seats > 0) & (F.col("_all") > 0), F.floor(share + 0.5)).otherwise(F.lit(0)).cast("long")

    rows = rows.withColumn("_sure", rounded(F.col("seats") - F.col("_n") / 2))
    rows = rows.withColumn("_most", rounded(F.col("seats") + F.col("_n") / 2))
    rows = rows.withColumn("_left", F.col("seats") - F.sum("_sure").over(whole))
    seat = F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))).alias("_seat")
    open_seats = rows.where("_most > _sure AND _left > 0").select(*group, *member, "votes", "_left", seat)
    best = whole.orderBy((F.col("votes") / (2 * F.col("_seat") - 1)).desc(), *member)
    won = open_seats.withColumn("_rank", F.row_number().over(best)).where("_rank <= _left")
    won = won.groupBy(*group, *member).agg(F.count(F.lit(1)).alias("_won"))
    keys = list(dict.fromkeys([*group, *member]))
    joined = rows.join(won, keys, "left").withColumn("quota", F.col("_sure") + F.coalesce(F.col("_won"), F.lit(0)))
    return joined.select(*parts.columns, "quota")


def _sized(docs: DataFrame, *carried: str) -> DataFrame:
    """One written row per row of ``docs``: a row number that stays, its size and its seeded place."""
    source = F.col("source").cast("string")
    return stage(
        docs.select(
            F.monotonically_increasing_id().alias("_row"),
            F.col("doc_id").cast("long").alias("_doc"),
            source.isNull().alias("_unnamed"),
            F.coalesce(source, F.lit("")).alias("_source"),
            word_count(F.col("text")).alias("_size"),
            F.xxhash64(F.lit(SEED), "doc_id", "text").alias("_draw"),
            *[F.struct(*[F.col(f"`{c}`") for c in carried]).alias("_doc_row")] * bool(carried),
        ),
        "mix-rows",
    )


def _layout(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with shard and word place, shards with quota), both written; from the rows of ``_sized``."""
    names = ["unnamed", "source"]
    narrow = rows.select("_row", "_doc", F.col("_unnamed").alias("unnamed"), F.col("_source").alias("source"), "_size", "_draw")
    sizes = narrow.groupBy(*names).agg(F.sum("_size").alias("source_size"))
    targets = stage(source_targets(sizes), "mix-targets")
    small = F.broadcast(targets) if targets.count() <= SENT else targets

    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / SHARD_WORDS)).cast("long")
    placed = narrow.join(small, names).withColumn("shard", F.pmod("_draw", shards))
    order = W.partitionBy(*names, "shard").orderBy("_draw", "_doc", "_row")
    begin = F.sum("_size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("_size")
    placed = stage(placed.withColumn("begin", begin).withColumn("region", F.floor(F.col("shard") / REGION)), "mix-places")

    seats = F.round(F.sum("target").over(W.partitionBy(F.lit(0))) / BLOCK).cast("long")
    level = targets.select(*names, F.col("target").alias("votes"), seats.alias("seats"), F.lit(0).alias("all"))
    level = apportion(level, ["all"], names).select(*names, F.col("quota").alias("seats"))
    sums = placed.groupBy(*names, "region", "shard").agg(F.sum("_size").alias("shard_size"))
    for group, member in ((names, ["region"]), ([*names, "region"], ["shard"])):
        votes = sums.groupBy(*group, *member).agg(F.sum("shard_size").cast("double").alias("votes"))
        level = apportion(votes.join(level, group), group, member).select(*group, *member, F.col("quota").alias("seats"))
    quotas = sums.join(level, [*names, "region", "shard"]).withColumn(
        "blocks", F.greatest(F.lit(1), F.round(F.col("shard_size") / BLOCK)).cast("long")
    )
    quota = F.least(F.col("seats"), LIMIT * F.col("blocks"))
    quotas = quotas.withColumn("passes", F.floor(quota / F.col("blocks"))).withColumn("rest", quota % F.col("blocks"))
    return placed, stage(quotas.where("shard_size > 0").drop("region", "seats"), "mix-quotas")


def _chosen(quotas: DataFrame) -> DataFrame:
    """(unnamed, source, shard, block): the blocks that a shard takes once more than its whole passes."""
    shard = ["unnamed", "source", "shard"]
    each = quotas.where("rest > 0").select(*shard, "rest", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    drawn = W.partitionBy(*shard).orderBy(F.xxhash64(F.lit(SEED), *shard, "block"), "block")
    return each.withColumn("_rank", F.row_number().over(drawn)).where("_rank <= rest").select(*shard, "block")


def _pieces(placed: DataFrame, quotas: DataFrame) -> DataFrame:
    """(_row, first, after): the word ranges of documents that lie in the chosen blocks, in words of the document."""
    shard = ["unnamed", "source", "shard"]
    docs = placed.where("_size > 0").select("_row", "_size", "begin", *shard).join(quotas, shard).where("rest > 0")

    def block(word: Column) -> Column:
        return F.floor(((word + 1) * F.col("blocks") - 1) / F.col("shard_size")).cast("long")

    spans = F.sequence(block(F.col("begin")), block(F.col("begin") + F.col("_size") - 1))
    parts = docs.select("_row", "_size", "begin", "shard_size", "blocks", *shard, F.explode(spans).alias("block"))
    edge = [F.floor((F.col("block") + k) * F.col("shard_size") / F.col("blocks")) - F.col("begin") for k in (0, 1)]
    # Rows that an explode makes are not in the planner's estimate, which would broadcast them.
    parts = parts.join(_chosen(quotas).hint("merge"), [*shard, "block"])
    return parts.select("_row", F.greatest(edge[0], F.lit(0)).alias("first"), F.least(edge[1], F.col("_size")).alias("after")).where("first < after")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken, the words the mix takes with repeats, for every row of ``docs``."""
    placed, quotas = _layout(_sized(docs))
    extra = _pieces(placed, quotas).groupBy("_row").agg(F.sum(F.col("after") - F.col("first")).alias("extra"))
    passes = quotas.select("unnamed", "source", "shard", "passes")
    rows = placed.join(passes, ["unnamed", "source", "shard"], "left").join(extra.hint("merge"), "_row", "left")
    taken = F.coalesce(F.col("passes"), F.lit(0)) * F.col("_size") + F.coalesce(F.col("extra"), F.lit(0))
    return rows.select(
        F.col("_doc").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself, in the columns of ``docs``: whole copies, and the pieces of documents in the chosen blocks.

    A piece is a document's text from the first to the last word of neighbouring chosen blocks, with
    the white space between its words as it was; n_chars, where it stands, follows the text.
    """
    rows = _sized(docs, *docs.columns)
    placed, quotas = _layout(rows)
    own = W.partitionBy("_row").orderBy("first")
    pieces = _pieces(placed, quotas).withColumn("_new", (F.coalesce(F.lag("after").over(own), F.lit(-1)) < F.col("first")).cast("int"))
    pieces = pieces.withColumn("_run", F.sum("_new").over(own)).groupBy("_row", "_run")
    pieces = pieces.agg(F.min("first").alias("first"), F.max("after").alias("after")).select("_row", "first", "after")
    passes = placed.join(quotas.select("unnamed", "source", "shard", "passes"), ["unnamed", "source", "shard"]).where("passes > 0 AND _size > 0")
    whole = passes.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))).alias("_pass"))
    whole = whole.select("_row", F.lit(0).cast("long").alias("first"), F.lit(None).cast("long").alias("after"))
    texts = rows.join(pieces.union(whole).hint("merge"), "_row")
    words = F.split(F.ltrim(F.col("_doc_row.text"), F.lit(" \t\n\x0b\x0c\r")), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    cut = F.array_join(F.slice(words, F.col("first").cast("int") + 1, (F.col("after") - F.col("first")).cast("int")), "")
    text = F.when(F.col("after").isNull(), F.col("_doc_row.text")).otherwise(cut)
    made = {c: F.col(f"_doc_row.`{c}`") for c in docs.columns} | {"text": text}
    if "n_chars" in made:
        made["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return texts.select(*[column.alias(name) for name, column in made.items()])
