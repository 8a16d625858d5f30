"""Best-fit packing of documents into sequences of several permitted lengths, chosen jointly.

A document longer than the largest capacity is cut into full pieces and a rest. Pieces are placed in decreasing size,
each in the open bin that it leaves the least room in. Where none has room, a bin is opened of the size that costs
least for each word it can come to hold: the piece itself, and the smaller pieces still to come that fit beside it. At the end each
bin is downsized to the smallest capacity that holds its contents.

A bin costs a fixed part, its length, and attention that grows with the square of its length. So short bins are cheaper a word
but fill worse, and which lengths pay depends on the pieces. That is settled jointly for a block: it is packed with every set of the
capacities that may be opened, and the plan of least total cost after downsizing stays.

Documents are dealt into blocks of about BLOCK rows by a hash of id, text and, for rows repeated in full, the number of the copy,
and each block is packed alone; text itself does not move. A task holds the pieces of its block: a few numbers for each document, and for each full
piece of the largest capacity, so a text of any length is a few bytes for every thousand words.

Edge cases: sizes are numbers of words; a null or empty text is one piece of no words, put where least room is left.
Rows with the same id or text are packed each. An empty table gives an empty table. Further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from itertools import accumulate, combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritrail.llm.common import n_words, settle

CAPACITIES = (512, 1024, 2048, 4096)
FIXED_COST, ATTENTION = 64, 4096  #: of a bin of c words: FIXED_COST + c + c * c / ATTENTION
BLOCK = 4096
COPIES = 64  #: copies of one row that go to a block together

PACKED = "doc_id long, piece int, first_word long, n_words long, bin_id long, bin_capacity int, place int"
Plan = tuple[list[int], list[int], list[int]]


def cost(capacity: int) -> float:
    return FIXED_COST + capacity + capacity * capacity / ATTENTION


def best_fit(order: Sequence[int], sizes: Sequence[int], capacities: Sequence[int], final: Sequence[int]) -> Plan:
    """(bin of each piece, place in its bin, capacity of each bin) if only capacities may be opened; order: by decreasing size."""
    costs = [(c, cost(c)) for c in sorted(capacities)]
    falling = [sizes[i] for i in order]
    rising = [-s for s in falling]
    words = [0, *accumulate(falling)]
    where, place = [0] * len(sizes), [0] * len(sizes)
    used: list[int] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # sorted keys of by_room
    for k, i in enumerate(order):
        size = falling[k]
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                del rooms[at]
        else:
            b = len(used)
            used.append(0)
            room, least = 0, 0.0
            for c, price in costs:
                if c >= size:
                    beside = words[-1] - words[max(k + 1, bisect_left(rising, size - c))]  # pieces to come of c - size words or less
                    each = price / max(1, min(c, size + beside))
                    if not room or each < least:
                        room, least = c, each
        where[i], place[i] = b, used[b]
        used[b] += size
        room -= size
        if room not in by_room:
            by_room[room] = []
            insort(rooms, room)
        by_room[room].append(b)
    return where, place, [final[bisect_left(final, u)] for u in used]


def pack(sizes: Sequence[int], capacities: Sequence[int] = CAPACITIES) -> Plan:
    """The plan of least cost among those of all sets of capacities; of equal ones that of the fewest. No size may pass the largest."""
    final = sorted(capacities)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    longest = max(sizes, default=0)
    sets = [s for n in range(1, len(final) + 1) for s in combinations(final, n) if s[-1] >= longest]
    plans = (best_fit(order, sizes, s, final) for s in sets)
    return min(plans, key=lambda plan: sum(map(cost, plan[2])))


def pack_documents(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, block: int = BLOCK) -> DataFrame:
    """A row for each piece: doc_id, its number and first word, its words, the bin's id and capacity, place in the bin."""
    most = max(capacities)
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("h"), n_words(F.col("text")).alias("n"))
    sized = settle(sized.groupBy("h", "doc_id", "n").agg(F.count("*").alias("rows")), "pack-sizes")
    blocks = max(1, -(-(sized.agg(F.sum("rows")).first()[0] or 0) // block))
    lots = F.sequence(F.lit(0).cast("long"), F.floor((F.col("rows") - 1) / COPIES))
    dealt = sized.withColumn("lot", F.explode(lots)).withColumn("copies", F.least(F.lit(COPIES), F.col("rows") - F.col("lot") * COPIES).cast("int"))

    def run(key: tuple, group: pa.Table) -> pa.Table:
        rows = sorted(zip(*(group.column(c).to_pylist() for c in ("h", "lot", "doc_id", "n", "copies")), strict=True), key=lambda r: (*r[:2], r[2] is None, r[2] or 0, r[3]))
        pieces = [(d, k, k * most, min(most, n - k * most)) for _, _, d, n, copies in rows for _ in range(copies) for k in range(max(1, -(-n // most)))]
        where, place, size = pack([p[3] for p in pieces], capacities)
        base = key[0].as_py() << 32
        columns = [list(c) for c in zip(*pieces, strict=True)] or [[]] * 4
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
        values = [*columns, [base + b for b in where], [size[b] for b in where], place]
        return pa.table({c.split()[0]: pa.array(v, t) for c, v, t in zip(PACKED.split(", "), values, kinds, strict=True)})

    return dealt.withColumn("block", F.pmod(F.xxhash64("h", "lot"), F.lit(blocks))).groupBy("block").applyInArrow(run, PACKED)
