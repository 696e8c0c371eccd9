"""Near-duplicate documents by a MinHash LSH forest.

A document is its set of word shingles. Documents with one set are one node. Each node has a MinHash
signature, and each tree of the forest is an order of the signature's values: Spark sorts all nodes in
that order by ranges, and nodes that share a prefix stand together. Every node is compared, by
signature, with the nodes just before it that share its first values. Where few share them, that is
all of them; where many do, it is those with the longest common prefixes, so the depth follows how
crowded a region is. Likely pairs are confirmed on their full sets.

To confirm little, the best pair of each node comes first. Their links give first components. Then all
nodes that share the first values of a tree are compared across components, however many they are: those
with a likely partner bring their full sets, and likely pairs are confirmed where they meet. Likely pairs
are never rows: a family of near copies just short of the threshold has as many as its square.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import mixed, shingle_hashes, slices, word_hashes, words_of
from ledgerwatch.llm.components import components
from ledgerwatch.session import settle


@dataclass(frozen=True)
class Forest:
    """Sizes of the forest. With 14 trees of depth 3 a pair at 0.8 is missed by all with chance 10^-4."""

    values: int = 128  # of a signature
    trees: int = 14
    depth: int = 3  # values that neighbours share at least
    length: int = 12  # values that a tree sorts by
    reach: int = 32  # nodes before a node that it is compared with at first
    block: int = 4096  # nodes of a crowded run that are compared with as many others in one piece
    shingles: int = 1 << 21  # of the sets of a block, if it has fewer nodes
    slack: float = 0.14  # four deviations of the estimate, taken off the threshold

    def orders(self) -> np.ndarray:
        """Which values each tree sorts by; the first ones are its own."""
        rng = np.random.default_rng(11)
        rows = []
        for t in range(self.trees):
            own = [(t * self.depth + k) % self.values for k in range(self.depth)]
            rest = [int(v) for v in rng.permutation(self.values) if v not in own]
            rows.append(own + rest[: self.length - self.depth])
        return np.array(rows)


FOREST = Forest()
PAIRS_AT_ONCE = 1 << 17  # likely pairs that a task holds before it passes them on or keeps the best


# --- sets and signatures ------------------------------------------------------------


def sets_of(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and sorted distinct 64-bit shingle hashes of each text."""
    bounds, words = words_of(texts)
    starts, hashes = shingle_hashes(bounds, word_hashes(words), width)
    parts = [np.unique(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([np.zeros(0, np.uint64), *parts])


def nodes_of(starts: np.ndarray, members: np.ndarray) -> list[bytes | None]:
    """128 bits that name a set; None for the empty one."""
    one, two = mixed(members), mixed(members ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    out: list[bytes | None] = []
    for a, b in zip(starts[:-1], starts[1:]):
        pair = np.array([one[a:b].sum(dtype=np.uint64), two[a:b].sum(dtype=np.uint64)], ">u8")
        out.append(mixed(pair.astype(np.uint64)).astype(">u8").tobytes() if b > a else None)
    return out


def signatures(starts: np.ndarray, members: np.ndarray, forest: Forest) -> np.ndarray:
    """A byte of each MinHash value, by row; rows of empty sets mean nothing."""
    rng = np.random.default_rng(5)
    factors = rng.integers(1 << 31, size=(forest.values, 2), dtype=np.uint32) * 2 + 1
    low, high = members.astype(np.uint32), (members >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(starts) - 1, forest.values), np.uint8)
    full = np.flatnonzero(np.diff(starts))
    if len(full):
        at = starts[full]
        for k, (f, g) in enumerate(factors):
            hashed = low * f
            hashed ^= high * g
            hashed *= np.uint32(0x9E3779B1)
            hashed ^= hashed >> np.uint32(15)
            least = np.minimum.reduceat(hashed, at)
            out[full, k] = (least * np.uint32(0x85EBCA6B)) >> np.uint32(24)
    return out


def profiles(docs: DataFrame, width: int, forest: Forest) -> DataFrame:
    """(doc_id, node, n, sig): the name, size and signature of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            starts, members = sets_of(batch.column(1), width)
            sig = signatures(starts, members, forest)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes_of(starts, members), pa.binary()), pa.array(np.diff(starts)),
                 pa.array([row.tobytes() for row in sig], pa.binary())], names=["doc_id", "node", "n", "sig"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, node binary, n long, sig binary")


# --- the forest ---------------------------------------------------------------------


def laid_out(nodes: DataFrame, forest: Forest) -> DataFrame:
    """Nodes (node, n, sig, root) once for each tree, with the key that the tree sorts by."""
    orders = forest.orders()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            for t, order in enumerate(orders):
                keys = np.ascontiguousarray(sig[:, order])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, t, np.int32)), pa.array([k.tobytes() for k in keys], pa.binary()), *batch.columns],
                    names=["tree", "key", *batch.schema.names],
                )

    kept = nodes.select("node", "n", "sig", "root")
    keys = ["tree", "key", "node"]
    rows = kept.mapInArrow(run, "tree int, key binary, node binary, n long, sig binary, root binary")
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def among_best(group: np.ndarray, value: np.ndarray, k: int) -> np.ndarray:
    """Whether each value is one of the k largest of its group."""
    order = np.lexsort((-value, group))
    starts = np.concatenate([[True], group[order][1:] != group[order][:-1]])[: len(order)]
    first = np.maximum.accumulate(np.where(starts, np.arange(len(order)), 0))
    out = np.zeros(len(order), bool)
    out[order] = np.arange(len(order)) - first < k
    return out


def likely_pairs(sorted_nodes: DataFrame, threshold: float, forest: Forest) -> DataFrame:
    """(a, b, likeness): of the nodes just before each node in an order, the one whose signature agrees most."""
    reach = forest.reach

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = 0 if last is None else last.num_rows
            table = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            keys = np.frombuffer(b"".join(table.column("key").to_pylist()), np.uint8).reshape(table.num_rows, -1)
            trees, prefix = table.column("tree").to_numpy(), keys[:, : forest.depth]
            begins = np.ones(table.num_rows, bool)
            begins[1:] = (trees[1:] != trees[:-1]) | (prefix[1:] != prefix[:-1]).any(1)
            found = compared(table, begins, fresh, reach, threshold - forest.slack, threshold)
            yield named_pairs(table, *best_of(found, lambda at, other: at, 1))
            last = table.slice(max(0, table.num_rows - reach))

    return sorted_nodes.mapInArrow(run, "a binary, b binary, likeness float")


def compared(
    table: pa.RecordBatch, begins: np.ndarray, fresh: int, reach: int, least: float, threshold: float,
    blocks: np.ndarray | None = None, roots: np.ndarray | None = None,
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(at, other, alike): rows from `fresh` on with rows up to `reach` before them in their run, of other roots.

    They come nearest rows first, in parts of bounded size.

    Runs start where `begins` is true. Given blocks, only rows of different ones are compared, or those of
    negative ones with all. Given `roots`, they stand for those of the table and may be joined between parts.
    """
    count, sizes = table.num_rows, table.column("n").to_numpy()
    sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(count, -1)
    if roots is None:
        roots = np.asarray(pc.dictionary_encode(table.column("root")).indices)
    first = np.maximum.accumulate(np.where(begins, np.arange(count), 0))
    rows, found, held = np.arange(fresh, count), [], 0
    for back in range(1, min(reach, count - 1) + 1):
        rows = rows[rows - first[rows] >= back]
        if not len(rows):
            break
        other = rows - back
        differ = roots[rows] != roots[other]
        if blocks is not None:
            differ &= (blocks[rows] < 0) | (blocks[rows] != blocks[other])
        at, other = rows[differ], other[differ]
        at = at[np.minimum(sizes[at], sizes[other]) >= threshold * np.maximum(sizes[at], sizes[other])]
        alike = (sigs[at] == sigs[at - back]).mean(1)
        good = alike >= least
        found.append((at[good], at[good] - back, alike[good]))
        held += int(good.sum())
        if held > PAIRS_AT_ONCE:
            yield tuple(np.concatenate(x) for x in zip(*found))
            found, held = [], 0
    if found:
        yield tuple(np.concatenate(x) for x in zip(*found))


def best_of(
    found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], group: Callable[[np.ndarray, np.ndarray], np.ndarray], k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the pairs `found` the k most alike of each group; of equal ones those that come first."""
    none = np.zeros(0, np.int64)
    best = (none, none, np.zeros(0))
    for part in found:
        best = tuple(np.concatenate(x) for x in zip(best, part))
        keep = among_best(group(*best[:2]), best[2], k)
        best = tuple(x[keep] for x in best)
    return best


def named_pairs(table: pa.RecordBatch, at: np.ndarray, other: np.ndarray, alike: np.ndarray) -> pa.RecordBatch:
    nodes = table.column("node")
    a, b = nodes.take(pa.array(at)).to_pylist(), nodes.take(pa.array(other)).to_pylist()
    return pa.RecordBatch.from_arrays(
        [pa.array([min(x) for x in zip(a, b)], pa.binary()), pa.array([max(x) for x in zip(a, b)], pa.binary()),
         pa.array(alike.astype(np.float32))], names=["a", "b", "likeness"],
    )


def crossing_rows(rooted: DataFrame, forest: Forest) -> DataFrame:
    """(run, i, j, block, ...): nodes that share the first values of a tree with nodes of another root.

    Runs of nodes with one root go before signatures are moved. A run of more nodes than `forest.block`,
    or of more shingles than `forest.shingles`, is cut into blocks, and each two of them, i and j, are a piece
    of their own, so no pair is out of reach and no task holds a whole run.
    """
    orders = forest.orders()[:, : forest.depth]

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(batch.num_rows, -1).astype(np.int64)
            for t, order in enumerate(orders):
                run = np.full(batch.num_rows, t, np.int64)
                for value in order:
                    run = run * 256 + sig[:, value]
                yield pa.RecordBatch.from_arrays([pa.array(run), *(batch.column(c) for c in ("node", "n", "root"))], names=["run", "node", "n", "root"])

    where, _ = settle(rooted.select("node", "n", "sig", "root").mapInArrow(places, "run long, node binary, n long, root binary"))
    mixed_runs = where.groupBy("run").agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min("root").alias("x"), F.max("root").alias("y")
    ).where("x <> y")
    blocks = F.ceil(F.greatest(F.col("size") / forest.block, F.col("shingles") / forest.shingles)).cast("int")
    pieces = where.join(mixed_runs.select("run", blocks.alias("blocks")), "run").withColumn(
        "block", F.expr("pmod(xxhash64(node), blocks)").cast("int")
    )
    pieces = pieces.groupBy("node").agg(F.collect_list(F.struct("run", "blocks", "block")).alias("at"))
    # at most one place in each tree
    rows = rooted.join(pieces, "node").withColumn("at", F.explode("at")).select(*rooted.columns, "at.run", "at.blocks", "at.block")
    rows = rows.withColumn("o", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "run", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", *rooted.columns
    )
    return rows


def in_pieces(rows: DataFrame) -> DataFrame:
    return rows.repartition("run", "i", "j").sortWithinPartitions("run", "i", "j", "node")


def whole_pieces(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, begins): whole pieces in their order, as many at once as have `most` shingles, or one that has more."""
    last: pa.RecordBatch | None = None

    def cut(table: pa.RecordBatch, ended: bool) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        run, i, j = (table.column(c).to_numpy() for c in ("run", "i", "j"))
        begins = np.ones(table.num_rows, bool)
        begins[1:] = (run[1:] != run[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        heads = np.append(np.flatnonzero(begins), table.num_rows)
        total = np.concatenate([[0], np.cumsum(table.column("n").to_numpy())])[heads]
        at, end = 0, len(heads) - (1 if ended else 2)
        while at < end:
            to = min(end, max(at + 1, int(np.searchsorted(total, total[at] + most, side="right")) - 1))
            yield table.slice(heads[at], heads[to] - heads[at]), begins[heads[at] : heads[to]]
            at = to
        yield table.slice(heads[end]), begins[heads[end] :]

    for batch in batches:
        if batch.num_rows:
            table = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            *whole, (last, _) = cut(table, False)
            yield from whole
    if last is not None:
        yield from list(cut(last, True))[:-1]


def crossing(
    table: pa.RecordBatch, begins: np.ndarray, threshold: float, forest: Forest, roots: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """As `compared` on whole pieces, each pair in the first tree only whose first values it shares."""
    orders = forest.orders()[:, : forest.depth]
    sigs = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint8).reshape(table.num_rows, -1)
    keys = sum(sigs[:, orders[:, k]].astype(np.int64) << (8 * k) for k in range(forest.depth))
    tree = table.column("run").to_numpy() >> (8 * forest.depth)
    blocks = np.where(table.column("i").to_numpy() == table.column("j").to_numpy(), -1, table.column("block").to_numpy())
    for at, other, alike in compared(table, begins, 0, table.num_rows, threshold - forest.slack, threshold, blocks, roots):
        first = (keys[at] == keys[other]).argmax(1) == tree[at]
        yield at[first], other[first], alike[first]


def crossing_pairs(rooted: DataFrame, threshold: float, forest: Forest, best: int | None) -> DataFrame:
    """(a, b): likely pairs of nodes with other roots that share the first values of a tree, as rows.

    With `best` the node of the smaller component (`many`) brings so many partners in each piece, those most
    like it. `crossing_links` decides the same pairs without making them rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in whole_pieces(batches, forest.shingles):
            found, many = crossing(table, begins, threshold, forest), table.column("many").to_numpy()
            for part in found if best is None else [best_of(found, lambda at, other: np.where(many[at] <= many[other], at, other), best)]:
                yield named_pairs(table, *part)

    return in_pieces(crossing_rows(rooted, forest)).mapInArrow(scan, "a binary, b binary, likeness float").select("a", "b").distinct()


def crossing_nodes(rooted: DataFrame, threshold: float, forest: Forest) -> DataFrame:
    """The rows of `crossing_rows` that have a likely partner in their piece."""
    rows = crossing_rows(rooted.select("node", "n", "sig", "root"), forest)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in whole_pieces(batches, forest.shingles):
            met = np.zeros(table.num_rows, bool)
            for at, other, _ in crossing(table, begins, threshold, forest):
                met[at] = met[other] = True
            yield table.filter(pa.array(met))

    return in_pieces(rows).mapInArrow(scan, rows.schema)


def crossing_links(nodes: DataFrame, sets: DataFrame, percent: int, forest: Forest) -> DataFrame:
    """(a, b): links between the roots of the rows of `crossing_nodes`, confirmed on full sets where they meet.

    Of links that join what others in the task have joined already, none but those come out, so there are no more
    than nodes; every other likely pair is confirmed or refused.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in whole_pieces(batches, forest.shingles):
            roots = np.array(pc.dictionary_encode(table.column("root")).indices)
            found = crossing(table, begins, percent / 100, forest, roots)
            links = list(joining(found, [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()], roots, percent))
            at, other = (np.array(x, np.int64) for x in (zip(*links) if links else ((), ())))
            yield named_pairs(table, at, other, np.ones(len(at)))

    rows = in_pieces(nodes.join(sets.select("node", "members"), "node"))
    return rows.mapInArrow(scan, "a binary, b binary, likeness float").select("a", "b").distinct()


def joining(
    found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], sets: list[np.ndarray], roots: np.ndarray, percent: int
) -> Iterator[tuple[int, int]]:
    """(at, other) of the pairs `found` that are links on their full sets and join two roots; `roots` are joined with them."""
    sizes = np.array([len(x) for x in sets], np.int64)
    starts = np.cumsum(sizes) - sizes
    names, codes = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
    held = np.zeros(len(names), bool)
    for at, other, alike in found:
        order = np.lexsort((-alike, at))
        for partners in np.split(order, np.flatnonzero(np.diff(at[order])) + 1) if len(order) else ():
            a, others = at[partners[0]], other[partners]
            own = codes[starts[a] : starts[a] + sizes[a]]
            held[own] = True
            while len(others := others[roots[others] != roots[a]]):
                # some at a time: what one of them joins, the next need not
                some, others = others[:64], others[64:]
                ends = np.cumsum(sizes[some])
                places = np.repeat(starts[some] - (ends - sizes[some]), sizes[some]) + np.arange(int(ends[-1]))
                both = np.add.reduceat(held[codes[places]], ends - sizes[some], dtype=np.int64)
                for b in some[100 * both >= percent * (sizes[a] + sizes[some] - both)]:
                    if roots[a] != roots[b]:
                        roots[roots == roots[b]] = roots[a]
                        yield int(a), int(b)
            held[own] = False


# --- confirming ---------------------------------------------------------------------


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, members): the sorted shingle hashes of the wanted (node, doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            starts, members = sets_of(batch.column("text"), width)
            named, raw = nodes_of(starts, members), members.tobytes()
            wanted_nodes = batch.column("node").to_pylist()
            # rows that share an id with another text are not the one wanted
            own = [k for k, node in enumerate(wanted_nodes) if named[k] == node]
            yield pa.RecordBatch.from_arrays(
                [pa.array([wanted_nodes[k] for k in own], pa.binary()),
                 pa.array([raw[8 * starts[k] : 8 * starts[k + 1]] for k in own], pa.binary())], names=["node", "members"],
            )

    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(wanted.select("doc_id", "node"), "doc_id")
    found = texts.select("node", "text").mapInArrow(run, "node binary, members binary")
    return found.dropDuplicates(["node"])


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * |both| >= percent * |either| on their full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


# --- all together -------------------------------------------------------------------


def groups(docs: DataFrame, width: int = 5, percent: int = 80, forest: Forest = FOREST) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id, text).

    Documents are linked if their sets' similarity is `percent` or more; component_id is the smallest
    doc_id that links reach, and kept tells whether it is the document's own. Documents without words
    or text have no shingles and are linked with nothing; with fewer words than `width` all of them are
    one shingle. Rows with one set are one node, however many; rows that repeat an id share their fate.
    A null id is no component's name, and its rows are kept. Other columns are not read.
    """
    threshold = percent / 100
    rows, _ = settle(profiles(docs, width, forest))
    reps = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )
    reps, _ = settle(reps)
    likely, _ = settle(likely_pairs(laid_out(reps.withColumn("root", F.col("node")), forest), threshold, forest))
    ends = likely.select(F.col("a").alias("node"), F.col("b").alias("other"), "likeness").unionByName(
        likely.select(F.col("b").alias("node"), F.col("a").alias("other"), "likeness")
    )
    best, _ = settle(ends.groupBy("node").agg(F.max(F.struct("likeness", "other")).alias("m")))
    pairs = best.select(F.least("node", "m.other").alias("a"), F.greatest("node", "m.other").alias("b")).distinct()
    named = reps.select("node", F.col("doc_id").alias("component_id"))
    nodes = reps.where("doc_id IS NOT NULL")
    pairs, _ = settle(pairs)

    def sets_of_nodes(some: DataFrame) -> DataFrame:
        wanted, _ = settle(nodes.join(some.distinct(), "node"))
        return settle(full_sets(docs, wanted, width))[0]

    sets = sets_of_nodes(pairs.select(F.col("a").alias("node")).union(pairs.select("b")))
    links, _ = settle(confirmed(pairs, sets, percent))
    roots = components(links)
    rooted = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # all likely pairs between components
    near, seen = settle(crossing_nodes(rooted, threshold, forest))
    if seen["rows"]:
        missing = near.select("node").join(sets, "node", "left_anti")
        more, found = settle(crossing_links(near, sets.unionByName(sets_of_nodes(missing)), percent, forest))
        if found["rows"]:
            roots = components(links.unionByName(more))
    classes = named.join(roots, "node")
    least = classes.groupBy("root").agg(F.min("component_id").alias("least"))
    linked = classes.join(least, "root").select("node", "least")
    named = named.join(linked, "node", "left").select("node", F.coalesce("least", "component_id").alias("component_id"))
    result = rows.select("doc_id", "node", "n").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return result.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
