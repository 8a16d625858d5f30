"""Byte-balanced shards in order of a key: histogram sort with sampled probes.

Rows stand in the order of (hash of the text, doc_id, a number given once), so equal texts stand together and a group of
copies of any size can be cut anywhere. A round counts rows and bytes exactly between all probes, in one pass over
narrow columns, and draws the next probes, by bytes, from the gaps that still hold a boundary; a boundary is settled
when a probe lies within tolerance of its byte rank, or between two rows next to each other. Rows then move once, to cells
of some CELL_BYTES; a shard is a run of cells, and the exact counts below boundaries number its rows without another shuffle.

The driver holds a few numbers for each boundary. Rounds are logarithmic in bytes by tolerance; every round splits each open gap.

Edge cases: a null text has no bytes and hashes as one value; a null doc_id sorts first. Rows alike in text and doc_id
stand together, in any order. A row larger than a shard takes one alone, and shards that it covers stay empty; so do shards
beyond the number of rows. An empty table gives no rows. Columns of documents named size, shard or slot are replaced;
others are kept. Texts of any length are moved whole, and only their size and hash reach Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veritrail.llm.common import free_name, settle

N_SHARDS = 40
ROW_BYTES = 16  #: what a row takes besides its text
TOLERANCE = 0.001  #: of a shard's bytes, at each shard boundary
CELL_BYTES = 64 << 20  #: one task's share of a shard after the exchange
CELL_TOLERANCE = 0.1  #: of a cell's bytes, at boundaries within a shard
SLOTS = 8  #: probes drawn from each open gap
LEAST = -(1 << 63)
COUNTS = "gap int, slot int, n long, bytes long, priority double, a long, b long, c long"
ONES = np.int64(-1)


def below(probes: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """For each key (a, b, c) the number of probes, rows of a sorted array of three columns, that are not above it."""
    out = np.searchsorted(probes[:, 0], a, "right")
    first = np.searchsorted(probes[:, 0], a, "left")
    tied = np.flatnonzero(first < out)
    for value in np.unique(a[tied]):
        lo, hi = np.searchsorted(probes[:, 0], value, "left"), np.searchsorted(probes[:, 0], value, "right")
        at = tied[a[tied] == value]
        inner, top = probes[lo:hi, 1], b[at]
        out[at] = lo + np.searchsorted(inner, top, "right")
        for second in np.unique(top[np.isin(top, inner)]):
            left, right = np.searchsorted(inner, second, "left"), np.searchsorted(inner, second, "right")
            here = at[top == second]
            out[here] = lo + left + np.searchsorted(probes[lo + left : lo + right, 2], c[here], "right")
    return out


def mixed(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit mix of integer columns."""
    out = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        out = (out ^ p.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def ahead(values: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    """Places of the smallest value of each gap."""
    order = np.lexsort((values, gaps))
    return order[np.flatnonzero(np.diff(gaps[order], prepend=-1))]


def histogram(keys: DataFrame, probes: np.ndarray, drawn: np.ndarray, tied: np.ndarray, turn: int) -> dict[tuple[int, int], tuple]:
    """(gap, slot) -> (rows, bytes, key) over all rows; gap i lies before probe i. Slots under SLOTS: keys drawn from gaps marked in drawn, by the last
    part of the key alone in gaps marked in tied. SLOTS: rows, bytes and the least key; SLOTS + 1: the greatest."""
    names = [c.split()[0] for c in COUNTS.split(", ")]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, c, size = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            if not len(a):
                continue
            gap = below(probes, a, b, c)
            order = np.lexsort((c, b, a))
            first = np.flatnonzero(np.diff(gap[order], prepend=-1))
            lows, highs, present = order[first], order[np.append(first[1:], len(order)) - 1], gap[order[first]]
            n, total = np.bincount(gap), np.bincount(gap, size).astype(np.int64)  # a batch's bytes are far below 2^53
            out = [(present, np.full(len(present), SLOTS), n[present], total[present], np.zeros(len(present)), a[lows], b[lows], c[lows])]
            none = np.zeros(len(present), np.int64)
            out.append((present, none + SLOTS + 1, none, none, np.zeros(len(present)), a[highs] ^ ONES, b[highs] ^ ONES, c[highs] ^ ONES))  # inverted, as the least is kept
            at = np.flatnonzero(drawn[gap])
            if len(at):
                seed = np.where(tied[gap[at]], mixed(c[at]), mixed(a[at], b[at]))
                for slot in range(SLOTS):
                    chance = (mixed(seed, np.full(len(at), turn * SLOTS + slot + 1)) >> np.uint64(11)).astype(np.float64) + 0.5
                    priority = -np.log(chance / 2.0**53) / size[at]
                    best = ahead(priority, gap[at])
                    here, zero = at[best], np.zeros(len(best), np.int64)
                    out.append((gap[here], zero + slot, zero, zero, priority[best], a[here], b[here], c[here]))
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    merged = keys.mapInArrow(count, COUNTS).groupBy("gap", "slot").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min(F.struct("priority", "a", "b", "c")).alias("k"))
    out = {}
    for r in merged.collect():  # SLOTS + 2 rows a gap, and a few gaps a boundary
        key = (r.k.a, r.k.b, r.k.c)
        out[r.gap, r.slot] = (r.n, r.bytes, tuple(~x for x in key) if r.slot == SLOTS + 1 else key)
    return out


@dataclass
class Borders:
    """keys[i] is the least key of cell i + 1 or above, with rows[i] and bytes[i] below it."""

    keys: np.ndarray
    rows: np.ndarray
    bytes: np.ndarray
    cells: int  #: a shard
    total: int
    rounds: int


def find_borders(keys: DataFrame, n_shards: int, tolerance: float, cell_bytes: int) -> Borders:
    """Refine probes until every boundary is met; keys (a, b, c, size) of all rows."""
    probes = np.zeros((0, 3), np.int64)
    drawn, tied = np.ones(1, bool), np.zeros(1, bool)
    turn = cells = 0
    while True:
        found = histogram(keys, probes, drawn, tied, turn)
        n, size = (np.array([found.get((g, SLOTS), (0, 0))[k] for g in range(len(probes) + 1)], np.int64) for k in (0, 1))
        rows, sizes = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(size)])  # below gap g
        total = int(sizes[-1])
        if not cells:
            cells = max(1, -(-total // (n_shards * cell_bytes)))
        m = n_shards * cells
        targets = np.array([total * i // m for i in range(1, m)], np.int64)
        slack = np.where(np.arange(1, m) % cells == 0, total / n_shards * tolerance, total / m * CELL_TOLERANCE)
        gaps = np.minimum(np.searchsorted(sizes[1:], targets, "left"), len(probes))
        nearer = np.where(targets - sizes[gaps] <= sizes[gaps + 1] - targets, gaps, gaps + 1)  # a probe's number, plus one
        is_open = (np.abs(sizes[nearer] - targets) > slack) & (n[gaps] > 1)
        if not is_open.any():
            ends = np.concatenate([[(LEAST, LEAST, LEAST)], probes, [(~LEAST, ~LEAST, ~LEAST)]]).astype(np.int64)
            return Borders(ends[nearer], rows[nearer], sizes[nearer], cells, total, turn + 1)
        turn += 1
        kept = {tuple(map(int, probes[g - 1])) for g in np.unique(np.concatenate([gaps, gaps + 1, nearer])) if 0 < g <= len(probes)}
        fresh: dict[tuple[int, int, int], None] = {}
        for g in np.unique(gaps[is_open]).tolist():
            for slot in [*range(SLOTS), SLOTS + 1]:  # the greatest key always cuts off a row
                if (g, slot) in found:
                    fresh[found[g, slot][2]] = None
        before = probes
        probes = np.array(sorted(kept | fresh.keys()), np.int64).reshape(-1, 3)
        # a new gap lies in an old one; it may hold a boundary if that did, and holds one text and id alone if that did
        inside = below(before, *(np.concatenate([[x], probes[:, i]]) for i, x in enumerate((LEAST, LEAST, LEAST))))
        drawn = np.isin(inside, gaps[is_open])
        one = np.array([found[g, SLOTS][2][:2] == found[g, SLOTS + 1][2][:2] if (g, SLOTS) in found else False for g in range(len(before) + 1)])
        tied = one[inside]


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, tolerance: float = TOLERANCE, cell_bytes: int = CELL_BYTES) -> DataFrame:
    """docs with size (UTF-8 bytes of the text and ROW_BYTES), shard and slot (its place in the shard, from 0)."""
    docs = docs.drop("size", "shard", "slot")
    a, b, c, cell = (free_name(docs, x) for x in ("hash", "id", "number", "cell"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    given = docs.withColumns({"size": size, a: F.xxhash64("text"), b: F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)), c: F.monotonically_increasing_id()})
    rows = settle(given, "keyed")  # written once, so that a row keeps its number whatever is lost
    found = find_borders(rows.select(a, b, c, "size"), n_shards, tolerance, cell_bytes)
    per, m = found.cells, n_shards * found.cells
    starts = np.concatenate([[0], found.rows])
    offsets = (starts - starts[np.arange(m) // per * per]).tolist()  # of each cell in its shard

    @F.pandas_udf("int")
    def cell_of(x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
        return pd.Series(below(found.keys, x.to_numpy(), y.to_numpy(), z.to_numpy()).astype(np.int32))

    dealt = rows.withColumn(cell, cell_of(a, b, c)).repartitionById(m, cell)
    places = dealt.sparkSession.createDataFrame(list(enumerate(offsets)), f"`{cell}` int, _offset long")  # a row a cell
    number = F.row_number().over(Window.partitionBy(cell).orderBy(a, b, c)).cast("long")
    numbered = dealt.withColumn("slot", number - 1).join(F.broadcast(places), cell, "left")
    kept = [F.col(f"`{x}`") for x in docs.columns]
    return numbered.select(*kept, "size", F.floor(F.col(cell) / per).cast("int").alias("shard"), (F.col("slot") + F.col("_offset")).alias("slot"))


def shard_report(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document."""
    done = shard_documents(docs)
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return done.select("doc_id", "size", crc.cast("long").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
