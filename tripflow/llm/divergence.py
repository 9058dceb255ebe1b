"""How far apart the sources of a language are, by hash-consed segment trees over its term ids.

Counts of terms are gathered for every (language, source) group. The kept terms of a language are
dealt into blocks; in a block every group's counts form a segment tree over the term ids, and equal
subtrees, of one group or of many, are one node. Two groups are compared by walking both trees at
once: a pair of nodes that occurs several times in the walk is priced once and counted with its
multiplicity. The top of the trees, over the blocks, is a sum by Spark, so neither a language nor a
source has to fit into one task.

Defined results: null text, lang and source read as ''. Every group that occurs takes part, with or
without terms; repeated rows count each time; an empty table gives no rows. Columns other than text,
lang and source are ignored. All arithmetic is exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.session import stage

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BETWEEN = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
LEAST_DOCUMENTS = 30
SMOOTH = 5
UNIT = 1_000_000_000
TOP_TERMS = 50
#: Counts in a block of terms, groups times terms; more where many groups would make more pairs than counts.
CELLS = 1 << 15
MOST_CELLS = 1 << 22
HELD = 200_000
PIECE = 1 << 20


def terms(text: bytes) -> Iterator[bytes]:
    """The terms of ``text``, A-Z in lower case; a long text is worked off in pieces that end between terms."""
    at = 0
    while at < len(text):
        cut = BETWEEN.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield from TERM.findall(text[at:end].lower())
        at = end


def tallies(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, documents): occurrences and documents of each term in each group.

    A row with a null term stands for the group itself. Batches are summed before anything is
    shuffled, so a frequent term leaves a task as few rows.
    """

    def rows(held: dict) -> pa.RecordBatch:
        keys, made = list(held), list(held.values())
        columns = [pa.array([k[i] for k in keys], pa.binary()).cast(pa.string()) for i in range(3)]
        counts = [pa.array([m[i] for m in made], pa.int64()) for i in range(2)]
        return pa.RecordBatch.from_arrays([*columns, *counts], ["lang", "source", "term", "n", "documents"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[int]] = {}
        for batch in batches:
            for lang, source, text in zip(*batch.columns):
                lang, source = lang.as_py(), source.as_py()
                own: dict[bytes, int] = {}
                for term in terms(text.as_py()):
                    own[term] = own.get(term, 0) + 1
                held.setdefault((lang, source, None), [0, 0])[1] += 1
                for term, n in own.items():
                    seen = held.get((lang, source, term))
                    if seen is None:
                        held[(lang, source, term)] = [n, 1]
                    else:
                        seen[0] += n
                        seen[1] += 1
                if len(held) > HELD:
                    yield rows(held)
                    held = {}
        if held:
            yield rows(held)

    read = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary").alias(c) for c in ("lang", "source", "text")])
    made = read.mapInArrow(run, "lang string, source string, term string, n long, documents long")
    return made.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))


class Trees:
    """The hash-consed segment trees of the rows of ``counts`` (groups x terms)."""

    def __init__(self, counts: np.ndarray):
        groups, width = counts.shape
        self.counts, leaf = np.unique(counts, return_inverse=True)
        full = 1 << max(0, (width - 1).bit_length())
        nodes = np.full((groups, full), len(self.counts), np.int64)  # the last leaf stands for no term
        nodes[:, :width] = leaf.reshape(counts.shape)
        self.sizes, self.children = [len(self.counts) + 1], []
        while nodes.shape[1] > 1:
            key = nodes[:, 0::2] * self.sizes[-1] + nodes[:, 1::2]
            pairs, own = np.unique(key, return_inverse=True)
            self.children.append(np.stack(np.divmod(pairs, self.sizes[-1])))
            self.sizes.append(len(pairs))
            nodes = own.reshape(key.shape)
        self.roots = nodes[:, 0]

    def leaf_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, ...]:
        """(pair, leaf of a, leaf of b, multiplicity) of the walks through the trees of groups a[i] and b[i]."""
        pair, u, v, times = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), np.int64)
        for level in range(len(self.children) - 1, -1, -1):
            kids, size = self.children[level], self.sizes[level]
            key = np.concatenate([(pair * size + kids[side][u]) * size + kids[side][v] for side in (0, 1)])
            key, own = np.unique(key, return_inverse=True)
            times = np.bincount(own, np.tile(times, 2)).astype(np.int64)  # below 2**53: at most the terms of a block
            key, v = np.divmod(key, size)
            pair, u = np.divmod(key, size)
        return pair, u, v, times


def price(counts: np.ndarray, total: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 5) / (N + 5 V)) in whole numbers."""
    if int(counts.max(initial=0)) + SMOOTH >= (1 << 62) // UNIT:
        counts, total = counts.astype(object), total.astype(object)
    return 1 + UNIT * (counts + SMOOTH) // (total + SMOOTH * kept)


def block_distances(counts: np.ndarray, totals: np.ndarray, kept: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(a, b, sum of |p - q| over the block's terms) for all groups a < b, some at a time."""
    groups, width = counts.shape
    firsts, seconds = np.triu_indices(groups, 1)
    if not width:
        yield firsts, seconds, np.zeros(len(firsts), np.int64)
        return
    trees = Trees(counts)
    step = max(1, (1 << 20) // width)
    values = np.append(trees.counts, 0)
    for at in range(0, len(firsts), step):
        a, b = firsts[at : at + step], seconds[at : at + step]
        pair, u, v, times = trees.leaf_pairs(a, b)
        cost = np.abs(price(values[u], totals[a[pair]], kept) - price(values[v], totals[b[pair]], kept))
        cost = np.where(u == len(trees.counts), 0, cost).astype(np.int64) * times
        sums = np.zeros(len(a), np.int64)
        np.add.at(sums, pair, cost)
        yield a, b, sums


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    """Distances of all pairs of groups over the terms of one block of one language."""
    of_group = rows[rows["term"].isna()].sort_values("source")
    sources = of_group["source"].to_numpy()
    kept = int(of_group["kept"].iloc[0])
    counted = rows[rows["term"].notna()]
    place = {source: i for i, source in enumerate(sources)}
    column, names = pd.factorize(counted["term"], sort=True)
    counts = np.zeros((len(sources), len(names)), np.int64)
    counts[[place[s] for s in counted["source"]], column] = counted["n"].to_numpy(np.int64)
    made = list(block_distances(counts, of_group["total"].to_numpy(np.int64), kept))
    a, b, value = (np.concatenate([m[i] for m in made]) for i in range(3))
    return pd.DataFrame(
        {
            "lang": rows["lang"].iloc[0],
            "source": np.concatenate([sources[a], sources[b]]),
            "item": np.concatenate([sources[b], sources[a]]),
            "value": np.concatenate([value, value]),
        }
    )


def _price(count: str, total: str):
    """``price`` as an expression over whole columns."""
    return F.expr(f"1 + cast({UNIT} as decimal(10,0)) * cast({count} + {SMOOTH} as decimal(20,0)) div ({total} + {SMOOTH} * kept)")


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top_terms: int = TOP_TERMS, cells: int = CELLS) -> DataFrame:
    """lang, source, part, item, value, rank: distances to the language's other sources, and the terms a source prefers."""
    found = stage(tallies(docs), "tallies")
    kept = found.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("documents").alias("d"))
    kept = kept.where(F.col("d") >= least_documents).select("lang", "term", "lang_n")
    counts = stage(found.where("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-terms")

    # One row per group and one per language from here on.
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = found.where("term is null").select("lang", "source").join(sums, ["lang", "source"], "left").fillna(0, ["total"])
    vocabulary = counts.groupBy("lang").agg(F.count_distinct("term").alias("kept"))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups"), F.sum("total").alias("lang_total"))
    per_block = F.greatest(F.lit(cells), F.least(F.col("groups") * F.col("groups"), F.lit(MOST_CELLS)))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("groups") / per_block)).cast("int")
    langs = sizes.join(vocabulary, "lang", "left").fillna(0, ["kept"]).withColumn("blocks", blocks)
    groups = stage(groups.join(langs, "lang"), "groups")
    langs = stage(langs, "langs")

    placed = counts.join(langs.select("lang", "blocks"), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "term", "n",
        F.lit(None).cast("long").alias("total"), F.lit(None).cast("long").alias("kept"),
    )
    everywhere = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source",
        F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"), "total", "kept",
    )
    priced = placed.union(everywhere).groupBy("lang", "block").applyInPandas(_block, "lang string, source string, item string, value long")
    pairs = priced.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_part = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    rated = counts.join(groups.select("lang", "source", "total", "lang_total", "kept"), ["lang", "source"])
    rated = rated.select("lang", "source", F.col("term").alias("item"), (_price("n", "total") - _price("lang_n", "lang_total")).alias("value"))
    # The limit on ranks is applied in every task before rows are shuffled to their group.
    best = rated.where("value > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    term_part = best.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pair_part.union(term_part)


#: The same rows from ``documents`` for an engine with whole numbers of 128 bits.
ORACLE_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
),
words AS (
    SELECT row_id, lang, source, unnest(regexp_extract_all(body, '[^\x{00}-\x{40}\x{5B}-\x{60}\x{7B}-\x{7F}]+')) AS term FROM docs
),
kept AS (
    SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30
),
counted AS (
    SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL
),
groups AS (
    SELECT g.lang, g.source, coalesce(t.total, 0)::HUGEINT AS total, coalesce(v.kept, 0)::HUGEINT AS kept, coalesce(v.lang_total, 0)::HUGEINT AS lang_total
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counted GROUP BY ALL) t ON g.lang = t.lang AND g.source = t.source
    LEFT JOIN (SELECT lang, count(*) AS kept, sum(lang_n) AS lang_total FROM kept GROUP BY ALL) v ON g.lang = v.lang
),
priced AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.total + 5 * g.kept) AS p,
           1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (g.lang_total + 5 * g.kept) AS q
    FROM groups g JOIN kept k ON g.lang = k.lang
    LEFT JOIN counted c ON g.lang = c.lang AND g.source = c.source AND k.term = c.term
),
distances AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
every AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM priced WHERE n > 0 AND p > q
),
ranked AS (
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
           CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM every
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
