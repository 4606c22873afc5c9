"""Rolling exact median and deviation (op 11) by hierarchical bitsets over the ranks of events.

A series (clicks of one kind, null being a kind) is cut into chunks of time; every chunk also gets its halo, the events of the
`minutes` before it, so that chunks need nothing else. Spark shuffles by series and chunk and sorts each chunk by time.
In a task, every event with an amount has a rank of its own in its chunk, by amount, then by place. A bitset over these ranks, with
the popcounts of its 64-bit words and of all pairs, pairs of pairs and so on above them, holds the window: sliding sets
the bits of events that come and clears those of events that go. Select on the popcounts gives the middle amounts. The
deviations from the median grow to either side of it, so the middle deviations are found by a binary search for how many of the smallest lie
below the median, each probe being two selects. Events at one time share a window, which is looked at once.

Windows are taken in lanes: a lane is a run of windows of one chunk with a bitset of its own, loaded with the events of its
first window. All lanes of a block go one window further at a time, as one array operation.

A task holds a block of `block_rows` events, or one chunk and halo if that has more; work and memory for an event do
not depend on how many chunks there are. `chunk_minutes` bounds a chunk by time: a third of a chunk of 120 minutes is its halo.

Every id counts once: of rows that share an id and hold different values, the smallest time, then series, then amount, null first.
Rows with a null id or a null time are left out. Null amounts, and amounts that are no number, infinite or of 10**16 and
more, have no cents: such events have a window, but are in none. Windows with fewer than two amounts have null median2, mad4 and far.
Ties all stay. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spotweave.runtime import release_worker_memory

MINUTE = 60_000_000
LANE_BYTES = 64 << 20  # of bitsets that go together


class Bitsets:
    """A bitset of 2 ** p ranks for each lane; counts are the popcounts of its words (the leaves) and of the halves above them."""

    def __init__(self, lanes: int, p: int):
        self.levels, self.words = p - 6, 1 << (p - 6)
        self.bits = np.zeros(lanes * self.words, np.uint64)
        self.counts = np.zeros(lanes * 2 * self.words, np.int32)

    def turn(self, lane: np.ndarray, rank: np.ndarray, by: int) -> None:
        """Set bits that are clear (by = 1), or clear bits that are set (by = -1)."""
        word = rank >> 6
        np.bitwise_xor.at(self.bits, lane * self.words + word, np.uint64(1) << (rank & 63).astype(np.uint64))
        base, node = lane * (2 * self.words), word + self.words
        for _ in range(self.levels + 1):
            np.add.at(self.counts, base + node, by)
            node = node >> 1

    def select(self, lane: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The rank of the set bit that has k set bits before it."""
        base, node = lane * (2 * self.words), np.ones(len(lane), np.int64)
        for _ in range(self.levels):
            node = node << 1
            left = self.counts[base + node]
            on = k >= left
            k = k - left * on
            node += on
        word = node - self.words
        x, at = self.bits[lane * self.words + word], word << 6
        for half in (32, 16, 8, 4, 2, 1):
            low = np.bitwise_count(x & np.uint64((1 << half) - 1))
            on = k >= low
            k = k - low * on
            step = half * on
            at += step
            x = x >> step.astype(np.uint64)
        return at


def middles(sets: Bitsets, lane: np.ndarray, n: np.ndarray, at: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Doubled median and doubled median of the doubled deviations of each lane's window of n >= 2 amounts; the amount of a
    lane's rank r is amounts[at + r]."""
    two, at2 = np.concatenate([lane, lane]), np.concatenate([at, at])

    def pair(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = amounts[at2 + sets.select(two, np.concatenate([i, j]))]
        return found[: len(lane)], found[len(lane) :]

    k, even = (n - 1) >> 1, (n & 1) == 0
    low, high = pair(k, n >> 1)
    median2 = low + high
    # below: amounts k, k - 1, ... 0; above: k + 1, ... n - 1; deviations grow along both
    below, above, first = k + 1, n - 1 - k, k + 1
    least, most = np.maximum(0, first - above), np.minimum(first, below)
    while (least < most).any():
        mid = (least + most) >> 1
        open_ = least < most
        probe = np.where(open_, mid, 0)
        a, b = pair(k - probe, np.where(open_, k + first - mid, k))
        more = median2 - 2 * a <= 2 * b - median2
        least, most = np.where(open_ & more, mid + 1, least), np.where(open_ & ~more, mid, most)
    i, j = least, first - least
    a, b = pair(np.minimum(k - i + 1, k), np.minimum(k + j, n - 1))
    last = np.maximum(np.where(i > 0, median2 - 2 * a, -1), np.where(j > 0, 2 * b - median2, -1))
    a, b = pair(np.maximum(k - i, 0), np.minimum(k + 1 + j, n - 1))
    far = np.iinfo(np.int64).max
    following = np.minimum(np.where(i < below, median2 - 2 * a, far), np.where(j < above, 2 * b - median2, far))
    return median2, last + np.where(even, following, last)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


def slide(sets: Bitsets, lane: np.ndarray, step: np.ndarray, lo: np.ndarray, hi: np.ndarray, rank: np.ndarray, at: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The middles of windows [lo, hi) of events: of each lane step 0, 1, ... in turn."""
    order = np.lexsort((lane, step))
    lane, lo, hi, at = lane[order], lo[order], hi[order], at[order]
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    before = np.where(step > 0, place[np.maximum(np.arange(len(order)) - 1, 0)], -1)[order]  # a lane's windows come in order
    came, gone = np.where(before < 0, lo, hi[before]), np.where(before < 0, lo, lo[before])
    comes, goes = hi - came, lo - gone
    sets_at, clears_at = np.concatenate([[0], np.cumsum(comes)]), np.concatenate([[0], np.cumsum(goes)])
    coming, going = rank[ranges(came, comes)], rank[ranges(gone, goes)]
    coming_lane, going_lane = np.repeat(lane, comes), np.repeat(lane, goes)
    bounds = np.searchsorted(step[order], np.arange(step.max() + 2))
    median2, mad4 = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    n = hi - lo
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        s, e = sets_at[a], sets_at[b]
        sets.turn(coming_lane[s:e], coming[s:e], 1)
        s, e = clears_at[a], clears_at[b]
        sets.turn(going_lane[s:e], going[s:e], -1)
        asked = a + np.flatnonzero(n[a:b] > 1)
        if len(asked):
            median2[asked], mad4[asked] = middles(sets, lane[asked], n[asked], at[asked], amounts)
    return median2[place], mad4[place]


def windows(new: np.ndarray, time: np.ndarray, cents: np.ndarray, has: np.ndarray, own: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n, median2 and mad4 of the events that are own, in their order. Events come by chunk (new marks the first of each), then time."""
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    local = time - time[begin][group] + width
    span = int(local.max()) + width + 1
    key = group * span + local
    event = np.flatnonzero(has)
    of = group[event]
    order = np.lexsort((cents[event], of))  # stable: equal amounts by place
    amounts = cents[event][order]
    size = np.bincount(of, minlength=len(begin))
    first = np.cumsum(size) - size
    rank = np.empty(len(event), np.int64)
    rank[order] = np.arange(len(event)) - first[of[order]]
    mine, back = np.unique(key[own], return_inverse=True)
    series = mine // span
    hi = np.searchsorted(key[event], mine, "right")
    lo = np.searchsorted(key[event], mine - width, "right")
    median2, mad4 = np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64)
    logs = np.maximum(6, np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))
    for p in np.unique(logs[series]):
        asked = np.flatnonzero(logs[series] == p)
        most = max(1, LANE_BYTES // (16 << int(p - 6)))
        length = max(32, -(-len(asked) // min(1024, most)), 1 << int(p - 4))
        run = series[asked]
        head = np.concatenate([[True], run[1:] != run[:-1]])
        nth = np.arange(len(asked)) - np.flatnonzero(head)[np.cumsum(head) - 1]
        step = nth % length
        lane = np.cumsum(step == 0) - 1
        for a in range(0, int(lane[-1]) + 1, most):
            part = slice(*np.searchsorted(lane, [a, a + most]))
            q = asked[part]
            sets = Bitsets(int(lane[part][-1]) - a + 1, int(p))
            median2[q], mad4[q] = slide(sets, lane[part] - a, step[part], lo[q], hi[q], rank, first[series[q]], amounts)
    return (hi - lo)[back], median2[back], mad4[back]


def micros(time: Column, kind: str) -> Column:
    """Microseconds since 1970 without a zone."""
    if kind == "timestamp_ntz":
        passed = (time - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).cast("interval second")
        return (passed.cast("decimal(20,6)") * 1_000_000).cast("long")
    return F.unix_micros(time)


def rolling_median(events: DataFrame, *, ident: str = "click_id", series: str = "kind", time: str = "ts", amount: str = "value", minutes: int = 60, chunk_minutes: int = 120, block_rows: int = 1 << 18) -> DataFrame:
    """ident, series, n, median2, mad4 and far for each id, from the window of `minutes` that ends with its own time."""
    width, chunk = minutes * MINUTE, chunk_minutes * MINUTE
    value = F.col(amount).cast("double")
    cents = F.when(F.abs(value) < 1e16, F.floor(100 * value + 0.5))  # NaN is greater than any number here
    once = events.select(F.col(ident).alias("id"), F.struct(micros(F.col(time), dict(events.dtypes)[time]).alias("us"), F.col(series).alias("series"), cents.alias("cents")).alias("e"))
    once = once.where("id is not null and e.us is not null").groupBy("id").agg(F.min("e").alias("e")).select("id", "e.*")
    home = F.floor(F.col("us") / chunk)  # exact: both are below 2 ** 53
    last = F.when(F.col("cents").isNotNull(), F.floor((F.col("us") + (width - 1)) / chunk)).otherwise(home)
    dealt = once.withColumn("chunk", F.explode(F.sequence(home, last))).withColumn("own", F.col("chunk") == home)
    number = F.row_number().over(Window.partitionBy("series", "chunk").orderBy("us", "id"))
    dealt = dealt.select("series", "chunk", "us", "id", "cents", "own", (number == 1).alias("new"))
    kinds = dict(dealt.dtypes)

    def solved(rows: pa.Table) -> pa.RecordBatch:
        column = lambda name: rows.column(name).to_numpy()
        own, given = column("own"), rows.column("cents")
        has = given.is_valid().to_numpy()
        own_cents = given.fill_null(0).to_numpy()
        n, median2, mad4 = windows(column("new"), column("us"), own_cents, has, own, width)
        kept, none = rows.filter(rows.column("own")), n < 2
        far = 2 * np.abs(2 * own_cents[own] - median2) > 3 * mad4
        return pa.Table.from_arrays(
            [kept.column("id"), kept.column("series"), pa.array(n), pa.array(median2, mask=none), pa.array(mad4, mask=none), pa.array(far, mask=none | ~has[own])],
            names=[ident, series, "n", "median2", "mad4", "far"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            heads = np.flatnonzero(batch.column("new").to_numpy(zero_copy_only=False))
            if rows + len(batch) >= block_rows and len(heads):
                cut = int(heads[-1])
                block = [*held, batch.slice(0, cut)]
                held, rows = [], 0
                batch = batch.slice(cut)
                if sum(map(len, block)):
                    yield from solved(pa.Table.from_batches(block)).to_batches()
            held.append(batch)
            rows += len(batch)
        if rows:
            yield from solved(pa.Table.from_batches(held)).to_batches()
        release_worker_memory(collect=False)

    return dealt.mapInArrow(task, f"`{ident}` {kinds['id']}, `{series}` {kinds['series']}, n long, median2 long, mad4 long, far boolean")
