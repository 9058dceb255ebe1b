"""SimHash near-duplicates found through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints that differ in at most four bits
differ in at most four bytes, so they share at least four positional bytes: the guaranteed minimum
of the count filter. A posting of the index therefore holds the fingerprints that share one set of
four positional bytes (70 sets), pairs inside a posting are tallied and verified bit by bit, and a
pair that meets in several postings is kept once.

Defined results: a null or empty text has fingerprint zero and links like any other; equal rows get
equal rows; a null doc_id keeps its fingerprint but is never a component's smallest id unless all
ids of the component are null. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import text_rows
from tripflow.llm.components import smallest_reachable
from tripflow.session import stage

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
POSITIONS = 8
SHARED = POSITIONS - MAX_DISTANCE
SEED = 42
#: Postings beyond this many fingerprints are linked through hubs, where work is linear in the posting.
PAIRED = 512
#: Up to so many crowded postings (16 bytes each) are broadcast; more are joined by a shuffle.
SENT = 250_000
CHUNK = 1 << 16

#: The byte masks of all sets of four positions, in the order in which a pair looks for its first.
MASKS = [sum(0xFF << (8 * p) for p in kept) for kept in combinations(range(POSITIONS), SHARED)]


def shingle_hashes(text: bytes) -> np.ndarray:
    """XXH64 of every word shingle of ``text``, in order, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line, n = b" ".join(words), max(1, len(words) - SHINGLE_WORDS + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])[:n].tolist()
    digest = xxhash.xxh64_intdigest
    stops = ends[min(len(words), SHINGLE_WORDS) - 1 :].tolist()
    return np.array([digest(line[a:b], SEED) for a, b in zip(begins, stops)], np.uint64)


def fingerprint(text: bytes | None) -> int:
    """The SimHash of ``text`` as a signed 64-bit number: a bit is set if over half the hashes set it."""
    hashes = shingle_hashes(text or b"")
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK]
        counts += np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint long) for every row of ``docs``."""
    return fingerprint_column(text_rows(docs)).select("doc_id", "fingerprint")


def fingerprint_column(rows: DataFrame) -> DataFrame:
    """``rows`` and the fingerprint of their ``text``, in place of any column of that name."""
    rows = rows.drop("fingerprint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (text.as_py() for text in batch.column("text"))
            marks = [fingerprint(t.encode() if isinstance(t, str) else t) for t in texts]
            yield batch.append_column("fingerprint", pa.array(marks, pa.int64()))

    schema = rows.schema
    return rows.mapInArrow(run, type(schema)([*schema.fields, T.StructField("fingerprint", T.LongType())]))


def _postings(marks: DataFrame) -> DataFrame:
    """(posting, mask, mark): each distinct fingerprint under its 70 sets of four positional bytes."""
    masks = F.array(*[F.lit(m if m < 1 << 63 else m - (1 << 64)) for m in MASKS])
    each = marks.select("mark", F.explode(masks).alias("mask"))
    return each.select(F.xxhash64("mask", F.col("mark").bitwiseAND(F.col("mask"))).alias("posting"), "mask", "mark")


def _shared_bytes(a: str, b: str):
    """The mask of the positional bytes that two fingerprints share."""
    differ = F.col(a).bitwiseXOR(F.col(b))
    same = F.lit(0).cast("long")
    for p in range(POSITIONS):
        byte = 0xFF << (8 * p)
        byte = byte if byte < 1 << 63 else byte - (1 << 64)
        same = same.bitwiseOR(F.when(differ.bitwiseAND(F.lit(byte)) == 0, F.lit(byte)).otherwise(F.lit(0)))
    return same


def _verified(a: str, b: str):
    """Count filter, then bits: at least four shared bytes, at most four differing bits."""
    tally = F.bit_count(_shared_bytes(a, b)) / 8
    return (tally >= SHARED) & (F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MAX_DISTANCE)


def links(marks: DataFrame) -> DataFrame:
    """(a, b): distinct fingerprints of ``marks`` (column mark) linked, or joined through a linked third.

    One aggregation with map-side combine sizes the postings. Postings of one drop out, those of two
    are their smallest and largest, those of up to PAIRED are joined with themselves under the
    verification, larger ones link every member to the smallest member around a hub.
    """
    index = _postings(marks)
    sizes = index.groupBy("posting").agg(
        F.count(F.lit(1)).alias("n"), F.min("mark").alias("a"), F.max("mark").alias("b")
    ).where("n > 1")
    sizes = stage(sizes, "postings")
    two = sizes.where("n = 2").where(_verified("a", "b")).select("a", "b")

    busy = sizes.where("n > 2").select("posting", "n")
    if busy.count() <= SENT:
        busy = F.broadcast(busy)
    crowded = index.join(busy, "posting")
    crowded = stage(crowded, "crowded")
    some = crowded.where(F.col("n") <= PAIRED)
    left = some.select("posting", "mask", F.col("mark").alias("a"))
    right = some.select("posting", "mask", F.col("mark").alias("b"))
    pairs = left.join(right, (left["posting"] == right["posting"]) & (left["mask"] == right["mask"]) & (F.col("a") < F.col("b")) & _verified("a", "b"))
    return two.union(pairs.select("a", "b")).union(_through_hubs(crowded.where(F.col("n") > PAIRED))).distinct()


def _through_hubs(crowded: DataFrame) -> DataFrame:
    """Links inside crowded postings, in work linear in their size.

    Two members differ in at most four of the 32 bits their posting leaves free exactly if some value,
    the hub, is within two free bits of both. Members of a hub link to its smallest member.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips: dict[int, np.ndarray] = {}
        for batch in batches:
            for posting, mask, mark in zip(*(batch.column(n).to_pylist() for n in ("posting", "mask", "mark"))):
                if mask not in flips:
                    free = [1 << i for i in range(64) if not mask >> i & 1]
                    flips[mask] = np.array([0, *free, *(x | y for x, y in combinations(free, 2))], np.uint64)
                hubs = (np.int64(mark).view(np.uint64) ^ flips[mask]).view(np.int64)
                n = len(hubs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, posting)), pa.array(hubs), pa.array(np.full(n, mark))], ["posting", "hub", "mark"]
                )

    around = crowded.select("posting", "mask", "mark").mapInArrow(run, "posting long, hub long, mark long")
    least = around.groupBy("posting", "hub").agg(F.min("mark").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # The planner's estimate knows nothing of the hubs a row makes, so it must not choose a broadcast.
    return around.join(least.drop("n").hint("merge"), ["posting", "hub"]).where("mark > a").select("a", F.col("mark").alias("b")).distinct()


def classes(rows: DataFrame, key: str) -> DataFrame:
    """(mark, component, n_links) for every fingerprint of ``rows``: the smallest ``key`` of its component, and its links.

    Rows are reduced to distinct fingerprints before anything is paired, so a group of exact copies
    is one node. n_links counts the other fingerprints that a fingerprint was linked to.
    """
    marks = rows.groupBy(F.col("fingerprint").alias("mark")).agg(F.min(key).alias("least"))
    marks = stage(marks, "marks")
    found = stage(links(marks.select("mark")), "near-links")
    roots = smallest_reachable(found)
    ends = found.select(F.col("a").alias("node")).union(found.select(F.col("b").alias("node")))
    degree = ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    nodes = stage(roots.join(degree, "node", "left").join(marks, F.col("node") == F.col("mark")), "near-nodes")
    ids = nodes.groupBy("root").agg(F.min("least").alias("component"))
    linked = nodes.join(ids, "root").select("mark", "component", "n_links")
    alone = marks.join(linked.select("mark"), "mark", "left_anti")
    return linked.union(alone.select("mark", F.col("least").alias("component"), F.lit(0).cast("long").alias("n_links")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id and n_links for every row of ``docs``."""
    rows = stage(fingerprints(docs), "fingerprints")
    found = classes(rows, "doc_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return rows.join(found, rows["fingerprint"] == found["mark"]).select(
        "doc_id", digits, F.col("component").alias("component_id"), "n_links"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row, all columns, of each component: that of the smallest id, of equal or null ids any one.

    Row numbers are fixed by a written table before they are compared, and only they are shuffled.
    The written copy holds the rows until the result is read.
    """
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col("text").alias("text"))
    marks = fingerprint_column(own).select("document", "fingerprint", F.monotonically_increasing_id().alias("row"))
    rows = stage(marks, "marked")
    place = F.struct(F.coalesce(F.col("document.doc_id").cast("long"), F.lit((1 << 63) - 1)), "row").alias("place")
    places = rows.select("fingerprint", place)
    found = classes(places, "place")
    firsts = found.groupBy(F.col("component.row").alias("row")).agg(F.count(F.lit(1)).alias("n"))
    return rows.join(firsts.select("row"), "row", "left_semi").select("document.*")
