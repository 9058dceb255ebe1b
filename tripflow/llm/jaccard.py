"""Jaccard join of word 3-gram sets: subsets for small sets, inverted lists for large ones.

Equal sets are one node from the start. Two sets of sizes s <= t link if they share at least
``least_shared(s, t)`` shingles. A small set lists all its subsets of exactly that fixed size, once for
every size a partner may have: sets that list the same subset are linked, without a check, and each
list costs links in proportion to its length. A large set is scanned against inverted lists of the
shingles that any partner must share one of: its rarest ones, in one order for all sets (global counts,
then hash). The boundary is the size up to which listing subsets costs less than scanning, both
counted for the sets at hand.

A list never makes all its pairs. Its smallest set, the hub, is checked against every member; then only
pairs of members that these links have not already brought into one component are left to check, which
loses no component. Checks are exact: a parity bitmap (a lower bound of the difference) comes first,
then the shingles themselves are intersected.

Defined results: a null or empty text, or one of spaces only, has no shingle and its own id as
component. A null id keeps its row and takes part; it is no component's smallest id unless all are
null. Repeated rows and equal texts share a component. Columns other than doc_id and text are ignored.
Shingles are compared by 64-bit hashes, sets by 128-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import text_rows
from tripflow.llm.components import smallest_reachable
from tripflow.session import stage

SHINGLE_WORDS = 3
#: Sets link from this share of their union, in hundredths.
SHARE = 90
#: Subsets are worth counting for sets up to this size; beyond it each set would list tens of thousands.
LISTED = 39
#: Shingles whose global count orders the lists (12 bytes each are broadcast); all others count as rare.
COUNTED = 1 << 19
#: Hashes counted together; those seen fewer than REPEATED times among them are not handed on.
CHUNK = 1 << 21
REPEATED = 3
#: A set's parity bitmap has a bit for every two shingles, rounded up to a power of two, between these bounds.
LEAST_BITS, MOST_BITS = 512, 1 << 15
#: Sizes of one band differ by this factor at most.
BAND = 1.5
#: Up to so many sets (8 bytes each) are broadcast to pick the texts to check; more are joined by a shuffle.
SENT = 1 << 20
SLICE = 1 << 21


# -- shingles -----------------------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _draws(n: int, salt: int) -> np.ndarray:
    """Odd 64-bit numbers drawn by a fixed rule."""
    with np.errstate(over="ignore"):
        return _mix((np.arange(n, dtype=np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _byte_values() -> np.ndarray:
    """A number for every byte: 0 for separators, A-Z as a-z."""
    values = _draws(256, 1 << 20)
    values[65:91] = values[97:123]
    values[[32, *range(9, 14)]] = 0
    return values


BYTE = _byte_values()
PLACE = _draws(256, 1 << 30)


def _word_hashes(data: np.ndarray, starts_of_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word of ``data``; no word reaches over a start of a text."""
    values = BYTE[data]
    filled = values != 0
    begins = filled.copy()
    begins[1:] &= ~filled[:-1]
    at = starts_of_text[starts_of_text < len(data)]
    begins[at] = filled[at]
    first = np.flatnonzero(begins)
    if not len(first):
        return np.zeros(0, np.uint64), first
    length = np.diff(np.append(first, len(data)))
    place = np.arange(first[0], len(data)) - np.repeat(first, length)
    longest = int(place.max()) + 1
    weight = PLACE if longest <= len(PLACE) else _draws(longest, 1 << 30)
    return _mix(np.add.reduceat(values[first[0] :] * weight[place], first - first[0])), first


def _pieces(data: np.ndarray) -> Iterator[np.ndarray]:
    """``data`` cut before separators into pieces of about SLICE bytes."""
    at = 0
    while at < len(data):
        end = min(len(data), at + SLICE)
        while end < len(data):
            gap = np.flatnonzero(BYTE[data[end : end + SLICE]] == 0)
            end += int(gap[0]) if len(gap) else min(SLICE, len(data) - end)
            if len(gap):
                break
        yield data[at:end]
        at = end


def _shingles(words: np.ndarray) -> np.ndarray:
    """The distinct shingle hashes of a text's word hashes, sorted; of fewer than three words the whole sequence is one."""
    if not len(words):
        return words
    n = min(SHINGLE_WORDS, len(words))
    made = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        made = _mix(made * np.uint64(0x9E3779B97F4A7C15) + words[i : len(words) - n + 1 + i])
    return np.unique(made)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text (a binary array without nulls), several texts at a time."""
    with np.errstate(over="ignore"):
        bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
        body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + SLICE, "right")) - 1)
            data = body[bounds[at] : bounds[end]]
            if end == at + 1 and len(data) > SLICE:
                yield _shingles(np.concatenate([_word_hashes(part, np.zeros(1, np.int64))[0] for part in _pieces(data)]))
            else:
                words, first = _word_hashes(data, bounds[at:end] - bounds[at])
                cuts = np.searchsorted(first, bounds[at : end + 1] - bounds[at])
                for i in range(end - at):
                    yield _shingles(words[cuts[i] : cuts[i + 1]])
            at = end


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted distinct shingle hashes of one text."""
    return next(shingle_sets(pa.array([(text or "").encode()], pa.binary())))


# -- sizes ----------------------------------------------------------------------------------------


def least_shared(s: int, t: int, share: int = SHARE) -> int:
    """The fewest shingles that linked sets of ``s`` and ``t`` have in common."""
    return -(-share * (s + t) // (100 + share))


def partners(s: int, share: int = SHARE) -> range:
    """The sizes t >= s of sets that a set of ``s`` can link with."""
    return range(s, 100 * s // share + 1)


def probed(n: int, share: int = SHARE) -> int:
    """So many first shingles of a set of ``n`` meet one of the first ``indexed(s)`` of any smaller partner."""
    return n - -(-share * n // 100) + 1


def indexed(n: int, share: int = SHARE) -> int:
    return n - least_shared(n, n, share) + 1


@cache
def listings(n: int, share: int = SHARE) -> tuple[tuple[int, int, int], ...]:
    """(smaller size, larger size, subset size) under which a set of ``n`` lists its subsets."""
    below = [s for s in range(-(-share * n // 100), n) if n in partners(s, share)]
    sizes = [(n, t) for t in partners(n, share)] + [(s, n) for s in below]
    return tuple((s, t, least_shared(s, t, share)) for s, t in sizes)


def subsets(n: int, share: int = SHARE) -> int:
    """How many subsets a set of ``n`` lists."""
    return sum(comb(n, c) for _, _, c in listings(n, share))


# -- passes over the texts ------------------------------------------------------------------------


def shingle_counts(texts: DataFrame) -> DataFrame:
    """(shingle, n): in how many texts a shingle occurs, short by less than REPEATED for each chunk of CHUNK hashes.

    Every text is counted; what a chunk holds fewer than REPEATED times is left out before the shuffle,
    so rare shingles, which need no count, cost nothing.
    """

    def repeated(held: list[np.ndarray]) -> pa.RecordBatch:
        found, n = np.unique(np.concatenate(held), return_counts=True)
        often = n >= REPEATED
        return pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(n[often])], ["shingle", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [np.zeros(0, np.uint64)], 0
        for batch in batches:
            for found in shingle_sets(batch.column("text")):
                held.append(found)
                size += len(found)
                if size >= CHUNK:
                    yield repeated(held)
                    held, size = [np.zeros(0, np.uint64)], 0
        yield repeated(held)

    return texts.select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))


def frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The COUNTED most frequent shingles, sorted, and their counts: a fixed size, whatever the input's."""
    top = shingle_counts(texts).orderBy(F.desc("n"), "shingle").limit(COUNTED).toPandas()
    shingles, n = top["shingle"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)
    order = np.argsort(shingles)
    return shingles[order], np.minimum(n[order], np.iinfo(np.int32).max).astype(np.int32)


def _lists(values: list[np.ndarray], empty: list[bool] | None = None) -> pa.Array:
    """Arrays of hashes as a column of lists of longs; null where ``empty``."""
    ends = np.cumsum([0, *map(len, values)]).astype(np.int32)
    flat = np.concatenate([np.zeros(0, np.uint64), *values]).view(np.int64)
    mask = None if empty is None else pa.array(empty)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=mask)


def parity(found: np.ndarray) -> np.ndarray:
    """Whether an odd number of the shingles falls on each bit. A differing bit is a differing shingle."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (len(found) // 2).bit_length()))
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bitmap: np.ndarray) -> np.ndarray:
    """A bitmap laid over itself until it has LEAST_BITS: still a lower bound, and short enough to go with every posting."""
    return np.bitwise_xor.reduce(bitmap.reshape(-1, LEAST_BITS // 64), 0)


def described(texts: DataFrame, share: int = SHARE) -> DataFrame:
    """For every row of ``texts``: doc_id, size, digest, parity, its first shingles in the common order, and all if few."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(frequent(texts))  # COUNTED entries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, counts = shared.value
        for batch in batches:
            sets, first, bits, short = [], [], [], []
            for found in shingle_sets(batch.column("text")):
                place = np.minimum(np.searchsorted(hot, found), max(0, len(hot) - 1))
                count = np.where(hot[place] == found, counts[place], 0) if len(hot) else np.zeros(len(found), np.int32)
                head = np.argsort(count, kind="stable")[: probed(len(found), share)] if len(found) else []
                first.append(found[head])
                bits.append(parity(found))
                short.append(folded(bits[-1]))
                sets.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), found if len(found) <= LISTED else found[:0]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([s[0] for s in sets], pa.int64()),
                    pa.array([s[1] for s in sets], pa.binary()),
                    _lists(bits),
                    _lists(short),
                    _lists(first),
                    _lists([s[2] for s in sets], [s[0] > LISTED for s in sets]),
                ],
                ["doc_id", "n", "digest", "parity", "short", "first", "whole"],
            )

    schema = "doc_id long, n long, digest binary, parity array<long>, short array<long>, first array<long>, whole array<long>"
    return texts.mapInArrow(run, schema)


def shingles_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(digest, shingles): the whole set of each ``wanted`` digest, read from any text that has it."""
    n = wanted.count()
    picked = None
    if n <= SENT:
        rows = wanted.select(F.xxhash64("digest").alias("h")).toPandas()["h"].to_numpy(np.int64)
        picked = texts.sparkSession.sparkContext.broadcast(np.unique(rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = None if picked is None else picked.value
        for batch in batches:
            sets = [s for s in shingle_sets(batch.column("text")) if len(s)]
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            if heads is not None:
                keep = [_spark_hash(d) for d in digests]
                at = np.minimum(np.searchsorted(heads, keep), max(0, len(heads) - 1)) if len(heads) else []
                kept = [len(heads) > 0 and heads[a] == k for a, k in zip(at, keep)]
                sets, digests = [s for s, k in zip(sets, kept) if k], [d for d, k in zip(digests, kept) if k]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), _lists(sets)], ["digest", "shingles"])

    return texts.select("text").mapInArrow(run, "digest binary, shingles array<long>")


def _spark_hash(digest: bytes) -> int:
    """Spark's xxhash64 of a binary value."""
    value = xxhash.xxh64_intdigest(digest, 42)
    return value - (1 << 64) if value >> 63 else value


# -- links ----------------------------------------------------------------------------------------


def subset_links(sets: DataFrame, boundary: int, share: int = SHARE) -> DataFrame:
    """(a, b): sets of at most ``boundary`` shingles that list the same subset, as stars.

    All smaller sets of a list link with all larger ones. Every larger one links to the first of the
    smaller ones, every smaller one to the first of the larger ones: as many links as members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, n, whole in zip(*(batch.column(c).to_pylist() for c in ("id", "n", "whole"))):
                found = np.array(whole, np.int64)
                keys, larger = [], []
                for s, t, c in listings(n, share):
                    for chosen in combinations(range(n), c):
                        keys.append(xxhash.xxh3_128_digest(bytes((s, t)) + found[list(chosen)].tobytes()))
                        larger.append(n > s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(np.full(len(keys), node)), pa.array(larger)], ["subset", "id", "larger"]
                )

    listed = sets.where(F.col("n") <= boundary).select("id", "n", "whole").mapInArrow(run, "subset binary, id long, larger boolean")
    larger = F.col("larger")
    lists = listed.groupBy("subset").agg(
        F.min(F.when(~larger, F.col("id"))).alias("small"), F.min(F.when(larger, F.col("id"))).alias("large"), F.count(F.lit(1)).alias("members")
    ).where("members > 1")
    met = listed.join(lists.hint("merge"), "subset")
    # Sizes in the key are equal within one list, so lists without larger ones are of equal sizes.
    return met.select(
        F.col("id").alias("b"), F.when(F.col("larger") | F.col("large").isNull(), F.col("small")).otherwise(F.col("large")).alias("a")
    ).where("a is not null and a <> b").select("a", "b").distinct()


def _least_shared(a: str, b: str, share: int) -> Column:
    """``least_shared`` of two columns."""
    return F.expr(f"({share} * ({a} + {b}) + {100 + share - 1}) div {100 + share}")


def _postings(sets: DataFrame, share: int) -> DataFrame:
    """(list, id, n, pos, index, probe): every set under its first shingles, by band of size.

    The larger set of a pair probes its own band; the smaller one is indexed in its own and, where its
    largest partner lies in the next, there too.
    """
    def band(size: Column) -> Column:
        return F.floor(F.log(size) / float(np.log(BAND)))

    n = F.col("n").cast("double")
    index = F.col("pos") < F.expr(f"n - (({share} * 2 * n + {100 + share - 1}) div {100 + share}) + 1")
    # A little beyond the largest partner, so that rounding loses no pair.
    beyond = band(n * (100 / share * (1 + 1e-9))) > F.col("band")
    first = sets.select("id", "n", band(n).alias("band"), F.posexplode("first").alias("pos", "shingle"))
    up = F.explode(F.when(index & beyond, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("up")
    return first.select("id", "n", "band", "pos", "shingle", index.alias("index"), up).select(
        F.xxhash64("shingle", F.col("band") + F.col("up")).alias("list"),
        *[F.col(c).cast("int") if c != "id" else F.col(c) for c in ("id", "n", "pos")],
        "index",
        (F.col("up") == 0).alias("probe"),
    )


def _may_link(x: str, y: str, share: int) -> Column:
    """Whether postings ``x`` and ``y`` of one list, of sets that are not the same, can belong to linked ones.

    Sizes, and positions: before the shingle they have in common sets share at most the shorter head,
    after it the shorter rest.
    """
    bound = f"least({x}.pos, {y}.pos) + least({x}.n - {x}.pos, {y}.n - {y}.pos)"
    need = f"({share} * ({x}.n + {y}.n) + {100 + share - 1}) div {100 + share}"
    sizes = f"100 * least({x}.n, {y}.n) >= {share} * greatest({x}.n, {y}.n)"
    return F.expr(f"{x}.id <> {y}.id and {sizes} and {bound} >= {need}")


def _smaller(x: str, y: str) -> str:
    """The order of sets in which the smaller of two is indexed and the larger probes."""
    return f"({x}.n < {y}.n or ({x}.n = {y}.n and {x}.id < {y}.id))"


def choose_boundary(sizes: dict[int, int], scanned: dict[int, int], share: int = SHARE) -> int:
    """The size up to which subsets are listed: where listing below and scanning above cost least, in rows."""
    costs = {
        b: sum(n * subsets(s, share) for s, n in sizes.items() if s <= b) + sum(n for s, n in scanned.items() if s > b)
        for b in range(LISTED + 1)
    }
    return min(costs, key=lambda b: (costs[b], b))


def _near(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """``pairs`` (a, b and more) that their parity bitmaps do not rule out, with sizes and digests."""
    for end in ("a", "b"):
        own = sets.select(*[F.col(c).alias(f"{c}_{end}") for c in ("id", "n", "digest", "parity")])
        pairs = pairs.join(own, F.col(end) == F.col(f"id_{end}")).drop(f"id_{end}")
    words = F.least(F.size("parity_a"), F.size("parity_b"))

    def fitted(bitmap: str) -> Column:
        """The bitmap, or the longer of two laid over itself: sizes of linked sets differ by less than a factor of two."""
        halves = F.zip_with(F.slice(bitmap, 1, words), F.slice(bitmap, words + 1, words), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(bitmap) > words, halves).otherwise(F.col(bitmap))

    differ = F.zip_with(fitted("parity_a"), fitted("parity_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differ, F.lit(0), lambda x, y: x + y)
    allowed = F.col("n_a") + F.col("n_b") - 2 * _least_shared("n_a", "n_b", share)
    return pairs.where(apart <= allowed).drop("parity_a", "parity_b")


def _checked(near: DataFrame, texts: DataFrame, share: int) -> DataFrame:
    """(a, b) of the pairs whose sets share enough shingles."""
    ends = near.select(F.col("digest_a").alias("digest")).union(near.select(F.col("digest_b").alias("digest"))).distinct()
    found = shingles_of(texts, stage(ends, "digests"))
    # Copies of a text bring the same set; one is kept in each task before anything is shuffled, once for both joins.
    found = found.groupBy("digest").agg(F.first("shingles").alias("shingles"))
    for end in ("b", "a"):
        near = near.join(found.toDF(f"digest_{end}", f"shingles_{end}").hint("merge"), f"digest_{end}")
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    return near.where(shared >= _least_shared("n_a", "n_b", share)).select("a", "b")


def _crowded_pairs(crowd: DataFrame, share: int) -> DataFrame:
    """(a, b): pairs of one list that lie in different components and may link, the hub's pairs apart.

    Members of the hub's component need no check against one another, so one side of every pair is
    outside of it. Folded bitmaps are compared inside the join, so it gives out few pairs however many
    members a list has outside; a long list is split by Spark like any skewed key of a join.
    """
    inside = F.col("root") == F.col("hub_root")
    apart = crowd.where(F.col("id") != F.col("hub.id"))
    index, probe = apart.where("index"), apart.where("probe")
    words = range(LEAST_BITS // 64)
    difference = " + ".join(f"bit_count(x.bits_{i} ^ y.bits_{i})" for i in words)
    need = f"({share} * (x.n + y.n) + {100 + share - 1}) div {100 + share}"

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        other = F.expr(f"x.root <> y.root and {_smaller('x', 'y')} and {difference} <= x.n + y.n - 2 * ({need})")
        on = (F.col("x.list") == F.col("y.list")) & _may_link("x", "y", share) & other
        return x.alias("x").join(y.alias("y"), on).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))

    return met(index.where(~inside), probe).union(met(index.where(inside), probe.where(~inside)))


def links(sets: DataFrame, texts: DataFrame, share: int = SHARE, boundary: int | None = None) -> DataFrame:
    """(a, b): ids of ``sets`` that link, enough of them to join every two linked sets in one component."""
    postings = _postings(sets, share)
    lists = postings.groupBy("list").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = stage(postings.join(lists, "list"), "shared-lists")
    # The member that has the fewest rarer shingles: what the others are most likely copies of.
    hub = F.min(F.struct("pos", "n", "id")).alias("hub")
    kinds = [F.count_if("probe").alias("probes"), F.count_if("index").alias("indexed")]
    hubs = met.groupBy("list").agg(hub, *kinds).where("probes > 0 and indexed > 0").drop("probes", "indexed")
    busy = stage(met.join(hubs, "list"), "busy-lists")
    if boundary is None:
        few = F.col("n") <= LISTED
        sizes = {r["n"]: r["c"] for r in sets.where(few).groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()}
        scanned = busy.where(few & F.col("probe")).groupBy("n").agg(F.sum("members").alias("c"))
        boundary = choose_boundary(sizes, {r["n"]: r["c"] for r in scanned.collect()}, share)  # LISTED rows each
    busy = busy.withColumn("probe", F.col("probe") & (F.col("n") > boundary))

    met = busy.alias("y").where(_may_link("hub", "y", share) & F.expr(f"hub.n > {boundary} or y.n > {boundary}"))
    met = met.groupBy(F.col("hub.id").alias("a"), F.col("id").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    met = stage(met, "met")
    # First every set against the one hub it shares most lists with.
    best = stage(met.groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")), "best")
    made = _checked(stage(_near(best, sets, share), "near"), texts, share)
    if boundary:
        made = made.union(subset_links(sets, boundary, share))
    made = stage(made, "links")
    roots = stage(smallest_reachable(made), "roots")

    def rooted(rows: DataFrame, node: str, name: str) -> DataFrame:
        own = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
        joined = rows.join(own, F.col(node) == F.col("_node"), "left")
        return joined.withColumn(name, F.coalesce("_root", F.col(node))).drop("_node", "_root")

    # Then the other hubs, and the pairs away from hubs, as far as they would join two components.
    other = rooted(rooted(met.join(best, ["a", "b"], "left_anti"), "a", "root_a"), "b", "root_b").where("root_a <> root_b")
    crowd = rooted(rooted(busy.where("members > 2"), "id", "root"), "hub.id", "hub_root")
    bits = [F.get("short", F.lit(i)).alias(f"bits_{i}") for i in range(LEAST_BITS // 64)]
    crowd = stage(crowd.join(sets.select("id", *bits), "id"), "crowd")
    pairs = other.select("a", "b").union(_crowded_pairs(crowd, share)).distinct()
    left = stage(_near(pairs, sets, share), "other-near")
    if left.isEmpty():
        return made
    return stage(made.union(_checked(left, texts, share)), "links")


def joined(docs: DataFrame, share: int = SHARE, boundary: int | None = None) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of ``docs``; ``boundary`` overrides the chosen one."""
    texts = text_rows(docs)
    rows = stage(described(texts, share), "described")
    one = [F.first(c).alias(c) for c in ("n", "parity", "short", "first", "whole")]
    sets = rows.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("least"), *one)
    sets = stage(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    roots = smallest_reachable(links(sets, texts, share, boundary))
    nodes = stage(roots.join(sets.select("id", "digest", "least"), F.col("node") == F.col("id")), "linked")
    linked = nodes.join(nodes.groupBy("root").agg(F.min("least").alias("component")), "root").select("digest", "component")
    alone = sets.join(linked.select("digest"), "digest", "left_anti").select("digest", F.col("least").alias("component"))
    return (
        rows.select("doc_id", "n", "digest")
        .join(linked.union(alone), "digest", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
    )
