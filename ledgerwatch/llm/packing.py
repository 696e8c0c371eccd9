"""Best-fit packing of documents into sequences by a grouping genetic algorithm on islands.

Documents are tokenised, cut into pieces no longer than a sequence, and the pieces dealt out to
blocks of bounded size. Every block is evolved by several islands, each a Spark task with a
population of its own. A child takes whole well-filled bins from one parent, keeps those bins of
the other that share no piece with them, and best-fits the displaced pieces. Between epochs the
best packing of each island migrates to the next island of its block. Bins that end up full
enough are final; the pieces of all others are dealt out anew, so that odd ends of many blocks
meet, until one last round accepts all bins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.bpe import encoder
from ledgerwatch.llm.common import slices
from ledgerwatch.session import settle


@dataclass(frozen=True)
class Evolution:
    """How blocks are evolved. None of it depends on the data."""

    block: int = 4096  # pieces in a block, about
    islands: int = 2
    epochs: int = 2
    population: int = 3
    children: int = 4  # per epoch
    rounds: int = 3
    done: float = 0.998  # fill from which a bin is final before the last round


# --- pieces -------------------------------------------------------------------------


def pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end: int = 2, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, piece, start, length, ids): tokens of each text, then `end`, cut into pieces of `capacity`.

    The first piece takes what is over. A null or empty text is one piece that holds `end` alone.
    Rows that repeat an id give their own pieces under the same numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path)
        for batch in slices(batches, 4096, 8 << 20):
            coded = own.encode_all(batch.column(1))
            sizes = pc.binary_length(coded).to_numpy().astype(np.int64) // 4 + 1
            counts = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), counts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            first = sizes - (counts - 1) * capacity
            start = np.where(piece > 0, first[row] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[row])
            # the bytes of all texts lie one after another; put the end behind each text
            tail = np.array([end], "<u4").tobytes()
            raw = b"".join(x + tail for x in coded.to_pylist())
            at = (np.cumsum(sizes) - sizes)[row] + start
            bounds = np.append(at, at[-1:] + length[-1:]) * 4 if len(row) else np.zeros(1, np.int64)
            ids = pa.Array.from_buffers(
                pa.large_binary(), len(row), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), ids],
                names=["id", "piece", "start", "length", "ids"],
            )

    keyed = docs.select(F.col(id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = keyed.schema["id"].dataType.simpleString()
    made = keyed.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary")
    return made.withColumnRenamed("id", id)


# --- one island ---------------------------------------------------------------------

Bins = list[list[int]]


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: Bins) -> Bins:
    """Put pieces, in the given order, where they leave least room; open a bin if none has room.

    Open bins are kept by room in lists, and a set of bits tells which rooms there are.
    """
    by_room: dict[int, list[int]] = {}
    rooms = 0
    for k, own in enumerate(bins):
        room = capacity - sum(map(sizes.__getitem__, own))
        if room:
            by_room.setdefault(room, []).append(k)
            rooms |= 1 << room
    for item in order:
        size = sizes[item]
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            held = by_room[room]
            k = held.pop()
            if not held:
                rooms ^= 1 << room
            bins[k].append(item)
        else:
            room, k = capacity, len(bins)
            bins.append([item])
        left = room - size
        if left:
            by_room.setdefault(left, []).append(k)
            rooms |= 1 << left
    return bins


def fitness(bins: Bins, sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones: the sum of squared fills."""
    return -len(bins), sum((sum(map(sizes.__getitem__, own)) / capacity) ** 2 for own in bins)


def cross(one: Bins, other: Bins, sizes: list[int], capacity: int, rng: np.random.Generator) -> Bins:
    """The better half of `one`'s bins, those bins of `other` without their pieces, the rest best-fitted."""
    room = [capacity - sum(map(sizes.__getitem__, own)) for own in one]
    ranked = sorted(range(len(one)), key=lambda k: room[k] + 8 * rng.random())
    taken = [list(one[k]) for k in ranked[: max(1, len(ranked) // 2)] if room[k] * 50 <= capacity]
    used = {item for own in taken for item in own}
    kept = [list(own) for own in other if used.isdisjoint(own)]
    # also displace a few of the emptiest bins, so that their pieces try other places
    kept.sort(key=lambda own: -sum(map(sizes.__getitem__, own)))
    kept = kept[: len(kept) - len(kept) // 10]
    used.update(item for own in kept for item in own)
    loose = sorted((k for k in range(len(sizes)) if k not in used), key=lambda k: -sizes[k])
    return best_fit(loose, sizes, capacity, taken + kept)


def evolve(sizes: list[int], capacity: int, seeds: list[Bins], how: Evolution, rng: np.random.Generator) -> Bins:
    """One epoch of an island: its population from the seeds and shuffled best-fits, then children."""
    falling = sorted(range(len(sizes)), key=lambda k: -sizes[k])
    people = [[list(own) for own in bins] for bins in seeds]
    while len(people) < how.population:
        noise = rng.random(len(sizes)) * (0.1 * capacity * len(people))
        order = sorted(falling, key=lambda k: -sizes[k] - noise[k]) if people else falling
        people.append(best_fit(order, sizes, capacity, []))
    least = -(-sum(sizes) // capacity)
    ranked = sorted(((fitness(p, sizes, capacity), n, p) for n, p in enumerate(people)), reverse=True)
    for child_no in range(how.children):
        if -ranked[0][0][0] <= least:
            break
        a, b = rng.choice(len(ranked), 2, replace=False) if len(ranked) > 1 else (0, 0)
        child = cross(ranked[a][2], ranked[b][2], sizes, capacity, rng)
        ranked.append((fitness(child, sizes, capacity), len(people) + child_no, child))
        ranked = sorted(ranked, reverse=True)[: how.population]
    return ranked[0][2]


# --- islands as Spark tasks ---------------------------------------------------------


def _epoch(rows: DataFrame, capacity: int, how: Evolution, epoch: int, seed: int) -> DataFrame:
    """The best packing of each (block, island), from the packings that have migrated there."""

    def island(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, number = (int(k) for k in key)
        pdf = pdf.sort_values(["source", "item"])
        base = pdf[pdf["source"] == pdf["source"].iloc[0]]
        sizes = base["length"].tolist()
        seeds: list[Bins] = []
        if epoch:
            for _, part in pdf.groupby("source"):
                seeds.append([list(own) for own in pd.Series(range(len(part))).groupby(part["bin"].to_numpy()).agg(list)])
        rng = np.random.default_rng([seed, epoch, block, number])
        bins = evolve(sizes, capacity, seeds, how, rng)
        bin_of = np.empty(len(sizes), np.int64)
        for k, own in enumerate(bins):
            bin_of[own] = k
        return pd.DataFrame({
            "block": block, "island": number, "source": number, "item": base["item"].to_numpy(),
            "length": base["length"].to_numpy(), "bin": bin_of, "bins": len(bins),
        })

    shape = "block long, island int, source int, item long, length long, bin long, bins long"
    return rows.groupBy("block", "island").applyInPandas(island, shape)


def _round(items: DataFrame, capacity: int, how: Evolution, seed: int) -> DataFrame:
    """(block, item, length, bin) of the best island of each block."""
    islands = F.explode(F.sequence(F.lit(0), F.lit(how.islands - 1)))
    rows = items.withColumn("island", islands).selectExpr("block", "island", "island AS source", "item", "length", "0L AS bin")
    for epoch in range(how.epochs):
        if epoch:
            to = F.array_distinct(F.array(F.col("island"), (F.col("island") + 1) % how.islands))
            rows = rows.withColumn("island", F.explode(to))
        rows = _epoch(rows.select("block", "island", "source", "item", "length", "bin"), capacity, how, epoch, seed)
    rows, _ = settle(rows)
    best = rows.groupBy("block").agg(F.min(F.col("bins") * how.islands + F.col("island")).alias("best"))
    won = rows.join(best, "block").where(F.col("best") % how.islands == F.col("island"))
    return won.select("block", "item", "length", "bin")


def pack(items: DataFrame, capacity: int = 1024, how: Evolution = Evolution(), seed: int = 7) -> DataFrame:
    """(item, sequence_id, offset) for items (item long, unique; length long from 1 to capacity).

    Items of full length are a sequence of their own. Sequence ids are any numbers; offsets are
    gapless from 0. An empty table gives an empty one. An item over the capacity is an error.
    """
    items = items.select(
        "item", F.when(F.col("length") <= capacity, F.col("length")).otherwise(F.raise_error(F.lit("item over the capacity"))).alias("length")
    )
    # sequences are numbered by round, block and bin
    full = items.where(F.col("length") == capacity).selectExpr("item", "item AS sequence_id", "0L AS offset")
    left, done = items.where(F.col("length") < capacity), []
    total = left.count()
    for number in range(how.rounds):
        if not total:
            break
        last = number == how.rounds - 1 or total <= how.block // 8
        blocks = max(1, -(-total // how.block))
        block = F.pmod(F.xxhash64("item", F.lit(seed + number)), F.lit(blocks))
        placed, _ = settle(_round(left.withColumn("block", block), capacity, how, seed + number))
        fills = placed.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
        chosen = placed.join(fills, ["block", "bin"]).withColumn("ready", F.lit(last) | (F.col("fill") >= how.done * capacity))
        chosen, seen = settle(chosen, F.count_if(~F.col("ready")).alias("left"))
        done.append(chosen.where("ready").selectExpr(f"{number} AS round", "block", "bin", "item", "length"))
        left, total = chosen.where("NOT ready").select("item", "length"), seen["left"] or 0
        if last:
            break
    if not done:
        return full
    all_done = done[0]
    for more in done[1:]:
        all_done = all_done.unionByName(more)
    # a bin has at most `capacity` items, so its list is bounded
    bins = all_done.groupBy("round", "block", "bin").agg(F.sort_array(F.collect_list(F.struct("item", "length"))).alias("own"))
    starts = F.expr("transform(sequence(1, size(own)), k -> aggregate(slice(own, 1, k - 1), 0L, (s, x) -> s + x.length))")
    numbered = bins.select(
        F.expr("-1 - own[0].item").alias("sequence_id"),
        F.explode(F.arrays_zip(F.col("own").alias("o"), starts.alias("s"))).alias("z"),
    )
    return full.unionByName(numbered.select(F.col("z.o.item").alias("item"), "sequence_id", F.col("z.s").alias("offset")))


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end: int = 2, how: Evolution = Evolution(), seed: int = 7
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece of every document.

    Pieces are numbered 0..n-1 in the written table; the numbers only tell rows apart, so null
    and repeated ids are packed like others.
    """
    cut = pieces(docs, tokenizer_path, capacity, end).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), F.monotonically_increasing_id().alias("item")
    )
    cut, _ = settle(cut)
    placed = pack(cut.select("item", "length"), capacity, how, seed)
    return cut.join(placed, "item").drop("item")
