"""Same and nearly the same records on two sides of a split, by a sparse suffix array over partitioned texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.periods import speech_periods
from ..session import forget, shuffle_parts, stored
from .codepoints import from_arrow, letters, to_arrow
from .leaks import mix

LEFT, RIGHT = 1, 2
#: Texts with fewer letters are never near one another.
LEAST = 10
#: Letters of a seed, and so of the common prefix that makes two suffixes candidates.
SHORT, LONG = 5, 8
FIRST = 0
#: Blocks in which seeds are chosen; their number of seeds is what the text's length asks for.
BLOCK = 96
#: Counters of the sketches: a fixed size, whatever the data's. They steer which seeds are taken and which suffixes
#: can't match at all; a full sketch rules out less, but never loses a match.
COUNTERS, SLICES = 1 << 21, 64
#: Cost of the most frequent seeds; more frequent ones aren't told apart.
DEAR = 1 << 20
#: A beginning with more rows than this, and than the share of all rows, is split over several tasks.
HOT, HOT_SHARE = 50_000, 10_000
#: Rows that a task of the suffix sort holds on average.
TASK_ROWS = 1_000_000
PAIRS = 1 << 21
SIGNATURE = [f"_s{i}" for i in range(4)]
ROWS = "_k1 long, _k2 long, _salt int, _c long, _p long, " + ", ".join(f"{c} long" for c in SIGNATURE)


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        codes, offsets = letters(*from_arrow(b.column("_t")))
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], to_arrow(codes, offsets)], names=[*b.schema.names[:-1], "_l"])


def pieces(n: np.ndarray) -> np.ndarray:
    """How many seeds a text of n letters has: one more than the edits that any partner may be away."""
    return n // 9 + 1


def _signature(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """256 bits a text, of which an edit changes four at most: its ideographs, and pairs of its other letters; and which
    texts are of ideographs only, between which an edit changes two."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    han = (codes >= 0x3400) & (codes < 0xA000)
    after = np.r_[codes[1:], 0].astype(np.int64)
    after[offsets[1:][offsets[1:] > 0] - 1] = 0
    bit = mix(np.where(han, codes.astype(np.int64), codes.astype(np.int64) << 21 | after)) >> np.uint64(56)
    flags = np.zeros((n, 256), bool)
    flags[row, bit.astype(np.int64)] = True
    return np.packbits(flags, axis=1).view(np.int64), np.bincount(row[~han], minlength=n) == 0


def _unit(codes: np.ndarray) -> np.ndarray:
    """A letter in 16 bits, never 0; letters beyond them share some, which only makes candidates."""
    c = codes.astype(np.int64)
    return np.where(c < 0x10000, c, (mix(c) >> np.uint64(50)).astype(np.int64) + 1)


def _beginnings(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place's first eight letters, four in each of two longs; 0 after the text's end."""
    n = len(codes)
    end = np.repeat(offsets[1:], np.diff(offsets))
    unit = np.r_[_unit(codes), np.zeros(LONG, np.int64)]
    out = []
    for half in (0, 4):
        k = np.zeros(n, np.int64)
        for i in range(half, half + 4):
            k = k << 16 | np.where(np.arange(n) + i < end, unit[i : i + n], 0)
        out.append(k)
    return out[0], out[1]


def _cut_to(k2: np.ndarray, q: np.ndarray | int) -> np.ndarray:
    """The second half of beginnings of q letters."""
    return k2 & (np.int64(-1) << (np.int64(16) * (LONG - np.asarray(q, np.int64))))


def _counter(k1: np.ndarray, k2: np.ndarray, q: int) -> np.ndarray:
    """The sketch's counter of beginnings of q letters (FIRST: of as many as SHORT, counted apart)."""
    return (mix(k1 ^ mix(_cut_to(k2, q or SHORT)).view(np.int64) ^ np.int64(q)) >> np.uint64(64 - 21)).astype(np.int64)


def _summed(counters: Callable[[pa.RecordBatch], Iterator[np.ndarray]], rows: DataFrame) -> np.ndarray:
    """A sketch over all rows: as many counts as COUNTERS, summed slice by slice before they reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(COUNTERS, np.int64)
        waiting, size = [], 0
        for b in batches:
            for at in counters(b):
                waiting.append(at)
                size += len(at)
                # As many at a time as there are counters, as each count touches all of them.
                if size > COUNTERS:
                    held += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
                    waiting, size = [], 0
        if size:
            held += np.bincount(np.concatenate(waiting), minlength=COUNTERS)
        if held.any():
            # In as few bytes as the largest count needs.
            part = [x.astype(np.min_scalar_type(int(x.max()))).tobytes() for x in held.reshape(SLICES, -1)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(part)], names=["_i", "_n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, n in zip(b.column("_i").to_pylist(), b.column("_n").to_pylist(), strict=True):
                x = np.frombuffer(n, f"u{len(n) * SLICES // COUNTERS}").astype(np.int64)
                held[i] = held[i] + x if i in held else x
        top = np.iinfo(np.uint32).max
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array([np.minimum(x, top).astype(np.uint32).tobytes() for x in held.values()], pa.binary())], names=["_i", "_n"])

    out = np.zeros((SLICES, COUNTERS // SLICES), np.uint32)
    parts = min(SLICES, shuffle_parts(rows.sparkSession))
    for r in rows.mapInArrow(count, "_i int, _n binary").repartition(parts, "_i").mapInArrow(add, "_i int, _n binary").collect():
        out[r["_i"]] = np.frombuffer(r["_n"], np.uint32)
    return out.reshape(-1)


def _parts(b: pa.RecordBatch, side: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Texts of one side in slices, as letters."""
    of = b.column("_side").to_numpy(zero_copy_only=False)
    b = b.take(pa.array(np.flatnonzero(of & side > 0)))
    for a in range(0, b.num_rows, 1024):
        part = b.slice(a, 1024)
        yield part, *from_arrow(part.column("_l"))


def _right_counters(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    for _, codes, offsets in _parts(b, RIGHT):
        k1, k2 = _beginnings(codes, offsets)
        end = np.repeat(offsets[1:], np.diff(offsets))
        for q in range(SHORT, LONG + 1):
            yield _counter(k1, k2, q)[np.arange(len(codes)) + q <= end]


def _seeds(codes: np.ndarray, offsets: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, length, k1, k2) of each text's seeds: pieces(n) disjoint ones of five to eight letters, chosen to occur
    least on the right side; those that can't occur there at all are left out.

    An edit spoils one seed at most, so a partner shares at least one with the text whatever the choice. The choice
    is by dynamic programming over blocks of a text, many at once.
    """
    n = np.diff(offsets)
    k1, k2 = _beginnings(codes, offsets)
    cost = np.full((LONG - SHORT + 1, len(codes)), DEAR, np.int32)
    end = np.repeat(offsets[1:], n)
    least = np.full(len(codes), DEAR, np.int64)
    for q in range(SHORT, LONG + 1):
        # A longer beginning is never more frequent than a shorter one.
        least = np.minimum(least, often[_counter(k1, k2, q)])
        inside = np.arange(len(codes)) + q <= end
        cost[q - SHORT][inside] = least[inside]
    blocks = np.maximum(-(-n // BLOCK), 1)
    text = np.repeat(np.arange(len(n)), blocks)
    i = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    m, total = blocks[text], pieces(n)[text]
    first, last = offsets[text] + i * n[text] // m, offsets[text] + (i + 1) * n[text] // m
    seeds = (i + 1) * total // m - i * total // m
    order = np.lexsort((last - first, seeds))
    order = order[(n[text] >= LEAST)[order]]
    out = []
    for a in range(0, len(order), 512):
        some = order[a : a + 512]
        out.append(_chosen(cost, first[some], last[some], seeds[some]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    place, q = (np.concatenate(x) for x in zip(*out, strict=True))
    known = cost[q - SHORT, place] > 0
    place, q = place[known], q[known]
    return place, q, k1[place], _cut_to(k2[place], q)


def _chosen(cost: np.ndarray, first: np.ndarray, last: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and lengths of the cheapest disjoint seeds of each block: seeds[i] of them in cost[., first[i] : last[i]]."""
    size, most = int((last - first).max()), int(seeds.max())
    at = first[:, None] + np.arange(size)
    big = np.int32(1 << 28)
    local = cost[:, np.minimum(at, cost.shape[1] - 1)]
    for q in range(SHORT, LONG + 1):
        local[q - SHORT][np.arange(size) + q > (last - first)[:, None]] = big
    best = np.full((most + 1, len(first), size + 1), big, np.int32)
    best[0] = 0
    for s in range(1, most + 1):
        ended = np.full((len(first), size + 1), big, np.int32)
        for q in range(SHORT, LONG + 1):
            if q <= size:
                np.minimum(ended[:, q:], best[s - 1][:, : size + 1 - q] + local[q - SHORT][:, : size + 1 - q], out=ended[:, q:])
        best[s] = np.minimum(np.minimum.accumulate(ended, 1), big)
    rows, todo, spot = np.arange(len(first)), seeds.copy(), last - first
    places, lengths = [], []
    while len(rows):
        # Back to where the least cost was first reached; a seed ends there. Costs only fall with the place.
        here = best[todo, rows, spot]
        back = (best[todo, rows] > here[:, None]).sum(1)
        q = np.zeros(len(rows), np.int64)
        for k in range(LONG, SHORT - 1, -1):
            a = np.maximum(back - k, 0)
            fits = (back >= k) & (best[todo - 1, rows, a] + local[k - SHORT, rows, a] == here)
            q[fits] = k
        places.append(first[rows] + back - q), lengths.append(q)
        rows, todo, spot = rows[todo > 1], (todo - 1)[todo > 1], (back - q)[todo > 1]
    return np.concatenate(places), np.concatenate(lengths)


def _seeded(often: np.ndarray):
    """Classes with the seeds of their texts as _z: each one's place and length in a long; right texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 1024):
                part = b.slice(a, 1024)
                left = np.flatnonzero(part.column("_side").to_numpy(zero_copy_only=False) & LEFT)
                codes, offsets = from_arrow(part.column("_l").take(pa.array(left)))
                at, q, _, _ = _seeds(codes, offsets, often)
                by = np.argsort(at)
                at, q = at[by], q[by]
                text = np.searchsorted(offsets, at, "right") - 1
                bounds = np.r_[0, np.cumsum(np.bincount(left[text], minlength=part.num_rows))].astype(np.int32)
                seeds = pa.ListArray.from_arrays(pa.array(bounds), pa.array((at - offsets[text]) << 4 | q))
                yield pa.RecordBatch.from_arrays([*part.columns, seeds], names=[*part.schema.names, "_z"])

    return run


def _known(part: pa.RecordBatch, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, length, k1, k2) of the seeds that _seeded() found."""
    z = part.column("_z")
    text = np.repeat(np.arange(part.num_rows), pc.list_value_length(z).to_numpy(zero_copy_only=False))
    z = z.flatten().to_numpy(zero_copy_only=False)
    at, q = offsets[text] + (z >> 4), z & 15
    k1, k2 = _beginnings(codes, offsets)
    return at, q, k1[at], _cut_to(k2[at], q)


def _left_counters(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    for part, codes, offsets in _parts(b, LEFT):
        _, q, k1, k2 = _known(part, codes, offsets)
        for size in range(SHORT, LONG + 1):
            yield _counter(k1[q == size], k2[q == size], size)
        # And by the first letters alone: what is partitioned by.
        yield _counter(k1, k2, FIRST)


def _suffixes(often: np.ndarray, wanted: np.ndarray, most_rows: int):
    """The suffixes that are sorted: those of left texts at their seeds, and of right texts those that begin as some seed does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for side in (LEFT, RIGHT):
                for part, codes, offsets in _parts(b, side):
                    n = np.diff(offsets)
                    if side == LEFT:
                        at, q, k1, k2 = _known(part, codes, offsets)
                    else:
                        k1, k2 = _beginnings(codes, offsets)
                        at = np.flatnonzero((np.arange(len(codes)) + SHORT <= np.repeat(offsets[1:], n)) & (np.repeat(n, n) >= LEAST))
                        at = at[np.logical_or.reduce([wanted[_counter(k1[at], k2[at], size)] > 0 for size in range(SHORT, LONG + 1)])]
                        q, k1, k2 = np.full(len(at), SHORT), k1[at], k2[at]
                    row = np.searchsorted(offsets, at, "right") - 1
                    signature, pure = _signature(codes, offsets)
                    ids = part.column("_c").to_numpy(zero_copy_only=False)[row]
                    # Length, place, seed length, kind and side share a long, as these rows are what the shuffle moves.
                    packed = n[row] << 32 | (at - offsets[row]) << 4 | (q - SHORT) << 2 | pure[row].astype(np.int64) << 1 | (side == RIGHT)
                    # A hot beginning: a grid of tasks, in which each row of a side meets each of the other once.
                    spots = ((wanted, _counter(k1, k2, FIRST)), (often, _counter(k1, k2, SHORT)))
                    across, down = (np.minimum(-(-x[spot].astype(np.int64) // most_rows), 1 << 10).clip(1) for x, spot in spots)
                    own, other = (across, down) if side == LEFT else (down, across)
                    copy = np.repeat(np.arange(len(at)), other)
                    nth = np.arange(len(copy)) - np.repeat(np.cumsum(other) - other, other)
                    mine = ((mix(ids) >> np.uint64(11)).astype(np.int64) % own)[copy]
                    salt = mine * down[copy] + nth if side == LEFT else nth * down[copy] + mine
                    columns = [k1[copy], k2[copy], salt.astype(np.int32), ids[copy], packed[copy], *signature[row[copy]].T]
                    yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], names=["_k1", "_k2", "_salt", "_c", "_p", *SIGNATURE])

    return run


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted suffixes to candidates. They are read in order, and taken whenever enough with whole beginnings are held."""
    held: list[pa.RecordBatch] = []
    size, enough = 0, TASK_ROWS // 4
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= enough:
            t = pa.Table.from_batches(held).combine_chunks()
            new = np.flatnonzero(_changes(t, SHORT))
            if len(new) > 1:
                yield from _adjacent(t.slice(0, new[-1]))
                t = t.slice(new[-1])
            held, size = t.to_batches(), t.num_rows
            enough = max(TASK_ROWS // 4, 2 * size)
    if held:
        yield from _adjacent(pa.Table.from_batches(held))


def _changes(t: pa.Table, q: int) -> np.ndarray:
    """Where a suffix and the one before share less than q letters."""
    columns = [t.column("_salt").to_numpy(), t.column("_k1").to_numpy(), _cut_to(t.column("_k2").to_numpy(), q)]
    out = np.ones(t.num_rows, bool)
    if t.num_rows:
        out[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in columns])
    return out


def _adjacent(t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Neighbours of both sides whose common prefix is as long as the left one's seed, at about one place."""
    col = {c: t.column(c).to_numpy() for c in t.column_names}
    packed = col["_p"]
    col |= {"_side": packed & 1, "_pure": packed >> 1 & 1, "_q": (packed >> 2 & 3) + SHORT, "_at": packed >> 4 & 0xFFFFFFF, "_n": packed >> 32}
    signature = np.stack([col[c] for c in SIGNATURE], 1)
    for q in range(SHORT, LONG + 1):
        left = np.flatnonzero((col["_side"] == 0) & (col["_q"] == q))
        if not len(left):
            continue
        group = np.cumsum(_changes(t, q)) << 32
        # A right suffix with less than q letters left ends in zeros, as no seed does.
        right = np.flatnonzero(col["_side"] == 1)
        spot = group + col["_at"]
        right = right[np.argsort(spot[right], kind="stable")]
        slack = col["_n"][left] // 9
        lo = np.searchsorted(spot[right], np.maximum(spot[left] - slack, group[left]), "left")
        hi = np.searchsorted(spot[right], spot[left] + slack, "right")
        m = hi - lo
        upto = np.cumsum(m)
        first = 0
        while first < len(left):
            last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PAIRS, "right")))
            some = slice(first, last)
            first = last
            if not (count := m[some]).any():
                continue
            a = np.repeat(left[some], count)
            b = right[np.repeat(lo[some], count) + np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)]
            most = np.maximum(col["_n"][a], col["_n"][b]) // 10
            # The edits before the shared seed move its place, those after it the rest of the length.
            moved, longer = col["_at"][a] - col["_at"][b], col["_n"][a] - col["_n"][b]
            ok = np.abs(moved) + np.abs(longer - moved) <= most
            a, b, most = a[ok], b[ok], most[ok]
            # As unsigned: the count of a negative number would be that of its magnitude.
            apart = np.bitwise_count((signature[a] ^ signature[b]).view(np.uint64)).sum(1)
            ok = apart <= np.where((col["_pure"][a] & col["_pure"][b]) > 0, 2, 4) * most
            a, b, most = a[ok], b[ok], most[ok]
            if not len(a):
                continue
            # How many of the left text's seeds the pair shares here; a seed lies in one partition, so counts add up.
            need = np.maximum(pieces(col["_n"][a]) - most, 1)
            # Pairs are told apart by 64 mixed bits, which sort faster than rows of columns.
            name = mix(col["_c"][a]) + np.uint64(3) * mix(col["_c"][b] ^ 0x5555)
            hit = np.unique(name ^ mix(col["_at"][a]), return_index=True)[1]
            one, shared = np.unique(name[hit], return_index=True, return_counts=True)[1:]
            pair = hit[one]
            columns = [col["_c"][a[pair]], col["_c"][b[pair]], need[pair].astype(np.int32), shared.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["_ca", "_cb", "_need", "_k"])


def _class_counter(c: np.ndarray) -> np.ndarray:
    return (mix(c) >> np.uint64(64 - 21)).astype(np.int64)


def _paired(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    for c in b.columns:
        yield _class_counter(c.to_numpy(zero_copy_only=False))


def _members(some: np.ndarray):
    """Rows without those whose class is in no pair for sure."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(some[_class_counter(b.column("_c").to_numpy(zero_copy_only=False))] > 0))

    return run


def classes_of(rows: DataFrame) -> DataFrame:
    """(_id, _side, _c) of rows (_id, _side, _t): the class of texts with equal letters; short texts have none."""
    return rows.where("_t IS NOT NULL").mapInArrow(_letters, "_id string, _side int, _l string").where(F.length("_l") >= LEAST).select("_id", "_side", F.xxhash64("_l").alias("_c"))


def members_of(rows: DataFrame, near: DataFrame) -> DataFrame:
    """(id, side, class) of records whose class has a partner; a few others may be among them."""
    some = _summed(_paired, near.select("_ca", "_cb"))
    rows = classes_of(rows).mapInArrow(_members(some), "_id string, _side int, _c long")
    return rows.select(F.col("_id").alias("id"), F.col("_side").alias("side"), F.col("_c").alias("class"))


def near_classes(rows: DataFrame) -> DataFrame:
    """For rows (_id, _side, _t): (_ca, _cb, _la, _lb, _d, _m), the classes of a left and a right text, their letters and
    the _d edits between them, a tenth of the longer's _m letters at most."""
    named = rows.where("_t IS NOT NULL").select("_side", "_t").mapInArrow(_letters, "_side int, _l string").where(F.length("_l") >= LEAST)
    # The sides of a class in one pass: 1, 2 or both. Copies fold here, before any suffix is made.
    classes = stored(named.groupBy("_l").agg(F.bit_or("_side").alias("_side")).select(F.xxhash64("_l").alias("_c"), "_l", "_side"))
    often = _summed(_right_counters, classes.select("_l", "_side"))
    plain, classes = classes, stored(classes.mapInArrow(_seeded(often), "_c long, _l string, _side int, _z array<long>"))
    forget(plain)
    wanted = _summed(_left_counters, classes.select("_l", "_side", "_z"))
    total = int(often.sum(dtype=np.int64)) // (LONG - SHORT + 1) + int(wanted.sum(dtype=np.int64)) // 2
    parts = max(shuffle_parts(rows.sparkSession), -(-total // TASK_ROWS))
    found = classes.mapInArrow(_suffixes(often, wanted, max(HOT, total // HOT_SHARE)), ROWS)
    found = found.repartition(parts, "_k1", F.shiftright("_k2", 48), "_salt").sortWithinPartitions("_salt", "_k1", "_k2")
    pairs = found.mapInArrow(_matches, "_ca long, _cb long, _need int, _k int")
    # Each edit spoils one seed at most, so most pairs must share more than one.
    pairs = stored(pairs.groupBy("_ca", "_cb", "_need").agg(F.sum("_k").alias("_k")).where("_k >= _need").select("_ca", "_cb"))
    some = classes.select("_c", "_l").mapInArrow(_members(_summed(_paired, pairs)), "_c long, _l string")
    a, b = (some.select(F.col("_c").alias(f"_c{x}"), F.col("_l").alias(f"_l{x}")) for x in "ab")
    near = pairs.join(a, "_ca").join(b, "_cb").withColumn("_m", F.greatest(F.length("_la"), F.length("_lb")))
    near = near.withColumn("_most", F.floor(F.col("_m") / 10).cast("int"))
    return near.withColumn("_d", F.expr("levenshtein(_la, _lb, _most)")).where("_d >= 0").drop("_most")


def _sided(df: DataFrame, ident: str, text: str, side: str) -> DataFrame:
    rows = df.select(F.col(ident).cast("string").alias("_id"), F.col(side).cast("int").alias("_side"), F.col(text).alias("_t"))
    return rows.where("_id IS NOT NULL AND _side IN (1, 2)")


def overlaps(df: DataFrame, ident: str, text: str, side: str) -> tuple[DataFrame, DataFrame]:
    """Records of side 1 and of side 2 with (nearly) the same text, as classes: (id, side, class), a row per row whose class has a partner, and pairs (left, right,
    edits, length) of a class with left and one with right records; the two may be one class.

    Letters and digits count, without case and width; a tenth of the longer text's letters may be put in, left
    out or replaced; texts below ten letters are no cases. Rows with a null id, text or side are left out,
    as are sides other than 1 and 2; repeated rows count once; other columns aren't read. Copies are never
    expanded into pairs here; record_pairs() does so for a query that wants them.

    Texts with equal letters fold into one class. Of a left text one seed more is taken than it may have edits, so
    one stands unchanged in any partner. The suffixes that begin at seeds, and those of right texts, are partitioned by
    their first letters and sorted; neighbours of both sides whose common prefix covers the seed, at about one
    place, are candidates. Those that share too few seeds or whose letter signatures are too far apart go at
    once, the others are verified by edit distance. Exact: no pair is lost.
    """
    rows = _sided(df, ident, text, side)
    near = stored(near_classes(rows).drop("_la", "_lb"))
    return members_of(rows, near), near.select(F.col("_ca").alias("left"), F.col("_cb").alias("right"), F.col("_d").alias("edits"), F.col("_m").alias("length"))


def record_pairs(members: DataFrame, near: DataFrame) -> DataFrame:
    """(left_id, right_id), distinct, from the classes of overlaps(); an id on both sides doesn't meet itself."""
    left = members.where("side = 1").select(F.col("id").alias("left_id"), F.col("class").alias("left"))
    right = members.where("side = 2").select(F.col("id").alias("right_id"), F.col("class").alias("right"))
    return near.select("left", "right").join(left, "left").join(right, "right").where("left_id <> right_id").select("left_id", "right_id").distinct()


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal shared spans of each pair: runs of equal letters, SHORT or more, on the diagonals that its edits allow."""
    for b in batches:
        out: list[tuple] = []
        for ca, cb, la, lb, d in zip(*(b.column(c).to_pylist() for c in ("_ca", "_cb", "_la", "_lb", "_d")), strict=True):
            x, y = (np.frombuffer(t.encode("utf-32-le"), np.int32) for t in (la, lb))
            for shift in range(-d, d + 1):
                i = max(0, -shift)
                n = min(len(x) - i, len(y) - i - shift)
                if n < SHORT:
                    continue
                same = np.r_[0, (x[i : i + n] == y[i + shift : i + shift + n]).astype(np.int8), 0]
                edge = np.flatnonzero(np.diff(same)).reshape(-1, 2) + i
                for p, q in edge[edge[:, 1] - edge[:, 0] >= SHORT].tolist():
                    out += [(ca, LEFT, p, q, len(x)), (cb, RIGHT, p + shift, q + shift, len(y))]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True) if out else [[]] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["class", "side", "_a", "_b", "_n"])


def coverage(df: DataFrame, ident: str, text: str, side: str) -> tuple[DataFrame, DataFrame]:
    """As overlaps(), but per class and side (class, side, partners, covered): how many records of the other side it is near
    to, and the share of its letters that lies in spans shared with them.

    The shared spans of all its pairs are merged into disjoint stretches, which is what covers it.
    """
    rows = _sided(df, ident, text, side)
    near = stored(near_classes(rows))
    members = stored(members_of(rows, near).distinct())
    size = members.groupBy("class", "side").agg(F.count("*").alias("_r"))
    left, right = (near.select(F.col(a).alias("class"), F.lit(s).alias("side"), F.col(b).alias("_o"), F.lit(3 - s).alias("_os")) for a, b, s in (("_ca", "_cb", LEFT), ("_cb", "_ca", RIGHT)))
    others = left.unionByName(right).join(size.select(F.col("class").alias("_o"), F.col("side").alias("_os"), "_r"), ["_o", "_os"])
    partners = others.groupBy("class", "side").agg(F.sum("_r").alias("partners"))
    spans = near.select("_ca", "_cb", "_la", "_lb", "_d").mapInArrow(_spans, "class long, side int, _a long, _b long, _n long")
    length = spans.groupBy("class", "side").agg(F.max("_n").alias("_n"))
    merged = speech_periods(spans, ["class", "side"], F.col("_a"), F.col("_b"), BLOCK * 1000).where("kind = 'period'")
    merged = merged.groupBy("class", "side").agg(F.sum(F.col("end") - F.col("start")).alias("_in"))
    share = merged.join(length, ["class", "side"]).select("class", "side", (F.col("_in") / F.col("_n")).alias("covered"))
    return members, partners.join(share, ["class", "side"])


def shared_keys(df: DataFrame, ident: str, key: Column, side: str) -> DataFrame:
    """(key, side, id), distinct: records of keys that have records of both sides, a class per key.

    Null keys, ids and sides are left out, as are keys with one record only; repeated rows count once. Sides
    fold before any join, so a hot key costs no more than its rows.
    """
    rows = df.select(key.alias("key"), F.col(side).cast("int").alias("side"), F.col(ident).alias("id")).where("key IS NOT NULL AND id IS NOT NULL AND side IN (1, 2)").distinct()
    both = rows.groupBy("key").agg(F.bit_or("side").alias("_s"), F.min("id").alias("_a"), F.max("id").alias("_b")).where("_s = 3 AND _a <> _b").select("key")
    return rows.join(both, "key", "left_semi")
