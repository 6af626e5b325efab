"""How sources of a language differ in their terms: an audit over a quadtree of the count matrix.

The counts of a language, groups (rows) by terms (columns), are cut into tiles of terms. A tile is a K^2
tree with K = 2: a square is split in four as long as it holds a count, down to small dense leaves. To compare
all pairs of groups, the tree is walked by two nodes at once, over the same columns. Where both are empty, every
term has the same price for a pair of groups, which is known without looking at it; only leaves in which one of the two has
a count are evaluated. All arithmetic is on whole numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careerloom.llm.common import written

#: Letters, as bytes of UTF-8 of which A-Z are in lower case; all characters beyond ASCII count as letters.
TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Documents of a language that a kept term is in, at least.
LEAST_DOCS = 3
#: Terms that are listed for each group.
TERM_RANKS = 200
#: Distinct (group, term) pairs that a task counts before it passes them on.
HELD = 1 << 19
#: Counts in a tile, about, and cells of it (groups x terms).
TILE_COUNTS = 1 << 19
TILE_CELLS = 1 << 22
#: Side of a leaf; cells of all pairs of leaf rows that are evaluated at once.
LEAF = 16
AT_ONCE = 1 << 20


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs) of some of a task's documents each."""
    counts: dict[tuple[str, str, bytes], list[int]] = {}

    def flush() -> pa.RecordBatch:
        keys = list(counts)
        columns = [
            pa.array([k[0] for k in keys], pa.string()),
            pa.array([k[1] for k in keys], pa.string()),
            pa.array([k[2] for k in keys], pa.binary()).cast(pa.string()),
            pa.array([v[0] for v in counts.values()], pa.int64()),
            pa.array([v[1] for v in counts.values()], pa.int64()),
        ]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text")), strict=True):
            own: dict[bytes, int] = {}
            for match in TERM.finditer(text.encode().lower()):
                term = match.group()
                own[term] = own.get(term, 0) + 1
            for term, n in own.items():
                total = counts.setdefault((lang, source, term), [0, 0])
                total[0] += n
                total[1] += 1
            if len(counts) >= HELD:
                yield flush()
    yield flush()


def shares(counts: np.ndarray, sums: np.ndarray, kept: int) -> np.ndarray:
    """1 + floor(10^9 * (count + 1) / (sum + kept)), in steps of three digits so that no product overflows."""
    bottom = np.asarray(sums, np.uint64) + np.uint64(kept)
    rest = np.asarray(counts, np.uint64) + np.uint64(1)
    whole = np.zeros(np.broadcast_shapes(rest.shape, bottom.shape), np.uint64)
    for _ in range(3):
        rest = rest * np.uint64(1000)
        whole = whole * np.uint64(1000) + rest // bottom
        rest = rest % bottom
    return (whole + np.uint64(1)).astype(np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); both are at most 10^9 + 1."""
    apart = p - q
    return ((apart * apart).view(np.uint64) // q.view(np.uint64)).view(np.int64)


class CountTree:
    """K^2 tree of a matrix of counts. Nodes of a level are sorted numbers; missing ones hold no count."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, counts: np.ndarray, n_rows: int, n_cols: int):
        self.n_rows, self.n_cols, self.height = n_rows, n_cols, min(LEAF, n_rows)
        self.levels: list[np.ndarray] = []
        leaves, place = np.unique(self.node(rows // LEAF, cols // LEAF), return_inverse=True)
        self.levels.append(leaves)
        while LEAF << (len(self.levels) - 1) < max(n_rows, n_cols):
            nodes = self.levels[-1]
            self.levels.append(np.unique(self.node((nodes >> 32) // 2, (nodes & 0xFFFFFFFF) // 2)))
        self.values = np.zeros((len(leaves), self.height, LEAF), np.int64)
        self.values[place, rows % LEAF, cols % LEAF] = counts

    @staticmethod
    def node(row: np.ndarray, col: np.ndarray) -> np.ndarray:
        return (row.astype(np.int64) << 32) | col

    def find(self, level: int, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        """Places of the nodes in their level, -1 for empty ones."""
        nodes, wanted = self.levels[level], self.node(row, col)
        if not len(nodes):
            return np.full(len(wanted), -1)
        at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
        return np.where(nodes[at] == wanted, at, -1)


def walk(tree: CountTree) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Columns in which both groups of a pair are in empty nodes, as a matrix; and the leaves (i, j, column) to evaluate."""
    empty_columns = np.zeros((tree.n_rows, tree.n_rows), np.int64)
    i = j = c = np.zeros(1, np.int64)
    for level in range(len(tree.levels) - 1, -1, -1):
        side = LEAF << level
        empty = (tree.find(level, i, c) < 0) & (tree.find(level, j, c) < 0)
        across = -(-tree.n_rows // side)
        widths = np.zeros((across, across), np.int64)
        np.add.at(widths, (i[empty], j[empty]), np.minimum(side, tree.n_cols - c[empty] * side))
        block = np.arange(tree.n_rows) // side
        empty_columns += widths[np.ix_(block, block)]
        i, j, c = i[~empty], j[~empty], c[~empty]
        if level:
            half = side // 2
            children = [(2 * i + a, 2 * j + b, 2 * c + d) for a in (0, 1) for b in (0, 1) for d in (0, 1)]
            i, j, c = (np.concatenate(parts) for parts in zip(*children, strict=True))
            there = (i * half < tree.n_rows) & (j * half < tree.n_rows) & (c * half < tree.n_cols)
            i, j, c = i[there], j[there], c[there]
    return empty_columns, (i, j, c)


def pair_prices(tree: CountTree, sums: np.ndarray, kept: int) -> np.ndarray:
    """The price of every pair (group, other group), summed over the columns of the tree."""
    across = -(-tree.n_rows // LEAF)
    padded = np.zeros(across * LEAF, np.int64)
    padded[: tree.n_rows] = sums
    by_block = padded.reshape(across, LEAF)[:, : tree.height]
    zero = shares(np.zeros(1), sums, kept) if kept else np.ones(tree.n_rows, np.int64)
    empty_columns, (i, j, c) = walk(tree)
    result = empty_columns * price(zero[:, None], np.ascontiguousarray(np.broadcast_to(zero, (len(zero),) * 2)))
    if not len(i):
        return result
    # Shares of all leaves, and after them, for each block of rows, those of a leaf without counts.
    own = shares(tree.values, by_block[tree.levels[0] >> 32][:, :, None], kept)
    none = np.broadcast_to(shares(np.zeros(1), by_block, kept)[:, :, None], (across, tree.height, LEAF))
    all_shares = np.concatenate([own, none])
    total = np.zeros((across, across, tree.height, tree.height), np.int64)
    step = max(1, AT_ONCE // (tree.height * tree.height * LEAF))
    for at in range(0, len(i), step):
        a, b, col = i[at : at + step], j[at : at + step], c[at : at + step]
        left, right = tree.find(0, a, col), tree.find(0, b, col)
        p = all_shares[np.where(left < 0, len(own) + a, left)][:, :, None, :]
        q = all_shares[np.where(right < 0, len(own) + b, right)][:, None, :, :]
        prices = price(p, np.ascontiguousarray(np.broadcast_to(q, (len(a), tree.height, tree.height, LEAF))))
        inside = (col[:, None] * LEAF + np.arange(LEAF) < tree.n_cols)[:, None, None, :]
        np.add.at(total, (a, b), np.where(inside, prices, 0).sum(axis=3))
    whole = total.transpose(0, 2, 1, 3).reshape(across * tree.height, across * tree.height)
    return result + whole[: tree.n_rows, : tree.n_rows]


TILE_RESULT = "lang string, place int, other int, item string, value bigint"


def compare_tile(most: int):
    """Of the counts of a tile and the groups of its language: prices of all pairs, and each group's dearest terms."""

    def compare(counts: pa.Table, groups: pa.Table) -> pa.Table:
        groups = groups.sort_by("place")
        sums, lang = groups.column("n").to_numpy(), groups.column("lang")[0].as_py()
        lang_n, kept = groups.column("lang_n")[0].as_py(), groups.column("kept")[0].as_py()
        terms = pc.unique(counts.column("term")) if counts.num_rows else pa.array([], pa.string())
        order = pc.sort_indices(terms).to_numpy().astype(np.int64)
        alphabet = np.empty(len(terms), np.int64)
        alphabet[order] = np.arange(len(terms))
        term = pc.index_in(counts.column("term"), terms).to_numpy().astype(np.int64)
        rows, n = counts.column("place").to_numpy().astype(np.int64), counts.column("n").to_numpy()
        # Terms of many groups come first, and groups of many terms, so that empty squares are large.
        spread = np.argsort(np.lexsort((alphabet, -np.bincount(term, minlength=len(terms)))))
        by_size = np.argsort(-np.bincount(rows, minlength=len(sums)), kind="stable")
        rank = np.argsort(by_size)
        tree = CountTree(rank[rows], spread[term], n, len(sums), len(terms))
        prices = pair_prices(tree, sums[by_size], kept)[np.ix_(rank, rank)]
        g, h = np.nonzero(~np.eye(len(sums), dtype=bool))
        # Terms that a group has more of than its language.
        p = shares(n, sums[rows], kept) if len(n) else n
        q = shares(counts.column("total").to_numpy(), np.array(lang_n), kept) if len(n) else n
        more = np.flatnonzero(p > q)
        more = more[np.lexsort((alphabet[term[more]], -price(p[more], q[more]), rows[more]))]
        starts = np.searchsorted(rows[more], np.arange(len(sums)))
        more = more[np.arange(len(more)) - starts[rows[more]] < most]
        names = terms.take(pa.array(term[more], pa.int64()))
        return pa.table(
            {
                "lang": pa.array([lang] * (len(g) + len(more)), pa.string()),
                "place": pa.array(np.concatenate([g, rows[more]]), pa.int32()),
                "other": pa.concat_arrays([pa.array(h, pa.int32()), pa.nulls(len(more), pa.int32())]),
                "item": pa.concat_arrays([pa.nulls(len(g), pa.string()), pa.array(names, pa.string())]),
                "value": pa.array(np.concatenate([prices[g, h], price(p[more], q[more])]), pa.int64()),
            }
        )

    return compare


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_docs: int = LEAST_DOCS,
    most: int = TERM_RANKS,
    tile_counts: int = TILE_COUNTS,
    tile_cells: int = TILE_CELLS,
) -> DataFrame:
    """Rows lang, source, part, item, value, rank: how far a group (lang, source) is from the other sources of
    its language (part 'pair', every other source), and the terms that it has more of than its
    language (part 'term', the first `most`). Larger values come first, of equal ones the item that sorts first.

    Null texts, languages and sources count as ''. A language of a single source has no pairs, one without a
    kept term has pairs of value 0. Repeated rows count as often as they occur; an empty table gives no rows, and
    other columns aren't read. A pair of each two sources of a language is what is asked for, so its
    rows, and a task's memory, grow with the square of their number; with the texts, only the number of tiles grows.
    """
    some = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    docs = docs.select(some(lang_col, "lang"), some(source_col, "source"), some(text_col, "text"))
    of_term, first = Window.partitionBy("lang", "term"), Window.partitionBy("lang", "term").orderBy("source")
    counts = written(
        docs.mapInArrow(count_terms, "lang string, source string, term string, n bigint, docs bigint")
        .groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .withColumns(
            {
                "total": F.sum("n").over(of_term),
                "docs": F.sum("docs").over(of_term),
                "first": F.row_number().over(first) == 1,
            }
        )
        .filter(F.col("docs") >= least_docs)
        .drop("docs"),
        "counts",
    )
    langs = counts.groupBy("lang").agg(
        F.sum("n").alias("lang_n"), F.count_if("first").alias("kept"), F.count("*").alias("counts")
    )
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    of_lang = Window.partitionBy("lang")
    tiles = F.greatest(
        F.ceil(F.col("counts") / tile_counts), F.ceil(F.col("kept") * F.col("groups") / tile_cells), F.lit(1)
    )
    groups = written(
        docs.select("lang", "source")
        .distinct()
        .join(sums, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0)
        .withColumns(
            {
                "place": F.row_number().over(of_lang.orderBy("source")) - 1,
                "groups": F.count("*").over(of_lang),
            }
        )
        .withColumn("tiles", tiles.cast("int")),
        "groups",
    )
    dealt = counts.join(groups.select("lang", "source", "place", "tiles"), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), "tiles").cast("int").alias("tile"), "place", "term", "n", "total"
    )
    # New names for the columns: both sides of the grouping come from the same table.
    own = [F.col(c).alias(c) for c in ("lang", "place", "n", "lang_n", "kept")]
    each = groups.select(*own, F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    keys = ["lang", "tile"]
    found = written(
        dealt.groupBy(keys).cogroup(each.groupBy(keys)).applyInArrow(compare_tile(most), TILE_RESULT), "prices"
    )
    names = groups.select("lang", "place", "source")
    pairs = (
        found.filter("other is not null")
        .groupBy("lang", "place", "other")
        .agg(F.sum("value").alias("value"))
        .join(names.select("lang", F.col("place").alias("other"), F.col("source").alias("item")), ["lang", "other"])
        .select("lang", "place", F.lit("pair").alias("part"), "item", "value")
    )
    terms = found.filter("item is not null").select("lang", "place", F.lit("term").alias("part"), "item", "value")
    by_value = Window.partitionBy("lang", "place").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(by_value)) for df in (pairs, terms)]
    both = ranked[0].unionByName(ranked[1].filter(F.col("rank") <= most))
    return both.join(names, ["lang", "place"]).select("lang", "source", "part", "item", "value", "rank")
