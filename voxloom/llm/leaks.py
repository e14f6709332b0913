"""Passages of evaluation items inside corpus documents, with a tenth of the letters changed at most."""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..operators.ranges import range_blocks, running_total
from ..session import stored
from .codepoints import from_arrow, letters


@dataclass(frozen=True)
class Walk:
    """Steps of the random walk, and how many of them each of so many hash tables samples.

    A walk of t steps reads about t/2 letters. The figures were chosen by recall of runs with exactly a tenth
    of edits (tests measure it again) against candidates per window.
    """

    steps: int
    samples: int
    tables: int
    spread: bool

    def sampled(self) -> list[set[int]]:
        """Steps of each table: any, or one out of each of so many equal stretches, which read more different letters."""
        r = random.Random(0)
        if not self.spread:
            return [set(r.sample(range(self.steps), self.samples)) for _ in range(self.tables)]
        return [{int((i + r.random()) * self.steps / self.samples) for i in range(self.samples)} for _ in range(self.tables)]


#: For scripts with many letters, whose runs are short, and for alphabets, whose letters say less and whose runs are
#: long. An item is one or the other by its least run; both ways find runs of any length from that on.
SHORT, LONG, LONG_FROM = Walk(44, 8, 7, False), Walk(84, 10, 6, True), 80
SLOTS = 22
CHUNK = 1 << 17
#: Letters of evaluation items that one scan of the corpus holds in memory; more are taken in blocks.
BLOCK_LETTERS = 2_000_000
#: Hits of an item within so many diagonals and places are looked at together.
DIAGONALS, PLACES = 16, 64
DOC_END, ITEM_END = 0, 1


def mix(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits per code point."""
    x = (x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def window_keys(codes: np.ndarray, first: int, last: int, walk: Walk, odd: np.ndarray) -> list[np.ndarray]:
    """Hash keys, one array a table, of the windows that begin at first..last-1 (a CGK walk and samples of it).

    In step t the walk writes down the letter it stands on and moves on if a random bit of (t, letter) says so.
    """
    n = last - first
    bits = mix(codes[first : min(last + walk.steps, len(codes))])
    if len(bits) < n + walk.steps:
        bits = np.r_[bits, np.zeros(n + walk.steps - len(bits), np.uint64)]
    letter = (bits ^ (bits >> np.uint64(31))).astype(np.uint32)
    at = np.arange(n, dtype=np.int32)
    keys = [np.zeros(n, np.uint32) for _ in range(walk.tables)]
    sampled = walk.sampled()
    for t in range(walk.steps):
        users = [i for i, x in enumerate(sampled) if t in x]
        if users:
            low = letter.take(at, mode="clip")
            for i in users:
                keys[i] += low * odd[i, t]
        move = (bits >> np.uint64(8 + t % 56)).astype(np.int8) & np.int8(1)
        at += move.take(at, mode="clip")
    return [k ^ (k >> np.uint32(15)) for k in keys]


class Items:
    """Evaluation items whose runs have one least length, as letters, with the hash tables of their windows."""

    def __init__(self, ids: list, codes: np.ndarray, offsets: np.ndarray, least: int) -> None:
        self.ids, self.codes, self.least = ids, codes, least
        self.walk = LONG if least >= LONG_FROM else SHORT
        self.odd = np.random.default_rng(7).integers(1, 2**32, (self.walk.tables, self.walk.steps), dtype=np.uint32) | np.uint32(1)
        self.owner = np.repeat(np.arange(len(ids)), np.diff(offsets))
        self.tables = []
        for key in window_keys(np.r_[codes, np.full(self.walk.steps, ITEM_END, np.int32)], 0, len(codes), self.walk, self.odd):
            by = np.argsort(key)
            slot = np.zeros(1 << SLOTS, bool)
            slot[key >> np.uint32(32 - SLOTS)] = True
            self.tables.append((key[by], by, slot))
        # Run lengths that matter, as (shortest, longest) with one number of edits, a tenth, each: a run of twice the least
        # length holds a shorter one within the tenth.
        self.longest = 2 * least - 1
        self.most = self.longest // 10
        self.lengths = [(max(10 * m, least), min(10 * m + 9, self.longest)) for m in range(least // 10, self.most + 1)]
        # Ends after each item, and as many more as a run is long, so that slices need no bounds.
        self.pad = self.longest + self.most
        self.ended = np.full(len(codes) + len(ids) + 2 * self.pad + 1, ITEM_END, np.int32)
        self.ended[self.pad + np.arange(len(codes)) + self.owner + 1] = codes
        # What a document must have of ideographs and of other letters to hold any run at all.
        upto, size = np.r_[0, np.cumsum(_ideograph(codes))], np.diff(offsets)
        han, other = [], []
        for low, _ in self.lengths if len(codes) else ():
            at = np.flatnonzero(self.owner[: len(codes) - low + 1] == self.owner[low - 1 :]) if len(codes) >= low else np.zeros(0, int)
            run = upto[at + low] - upto[at]
            han.append(run.min(initial=low) - low // 10)
            other.append(low - run.max(initial=0) - low // 10)
        self.need = (min(han, default=0), min(other, default=0))
        self.any = bool((size >= least).any())
        # Short grams of the items, hashed with their item into one table of flags: what the counting filter looks up.
        # A flag that two share only makes a candidate plausible.
        self.gram = 4 if least >= LONG_FROM else 2
        self.bits = max(14, (16 * len(codes)).bit_length())
        self.flags = np.zeros(1 << self.bits, bool)
        inside = np.flatnonzero(self.owner[self.gram - 1 :] == self.owner[: len(self.owner) - self.gram + 1]) if len(codes) >= self.gram else np.zeros(0, int)
        self.flags[self.flag(self.grams(codes)[inside], self.owner[inside])] = True
        self.ended_grams = self.grams(self.ended)

    def grams(self, codes: np.ndarray) -> np.ndarray:
        """A hash of each place's gram."""
        bits = mix(np.r_[codes, np.full(self.gram - 1, DOC_END, np.int32)])
        out = np.zeros(len(codes), np.uint64)
        for i in range(self.gram):
            out = out * np.uint64(0x9E3779B97F4A7C15) + bits[i : i + len(codes)]
        return (out >> np.uint64(33)).astype(np.int32)

    def flag(self, grams: np.ndarray, item: np.ndarray) -> np.ndarray:
        return ((grams.astype(np.uint64) + mix(item)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)


def _ideograph(codes: np.ndarray) -> np.ndarray:
    return ((codes >= 0x3400) & (codes < 0xA000) | (codes >= 0x20000)).astype(np.int64)


def _reach(text: np.ndarray, letters_: np.ndarray, most: int) -> np.ndarray:
    """best[i, j]: least edits between the first j letters of row i and any beginning of its text, if the j-th is there.

    text has `most` more signs before its beginning and after its end. A band of `most` edits on either side
    of the diagonal; entries above `most` are large. Letters missing at a run's end are no part of the run.
    """
    n, length = letters_.shape
    big, width = np.int16(999), 2 * most + 1
    best = np.full((n, length + 1), big, np.int16)
    best[:, 0] = 0
    live, slope = np.arange(n), np.arange(width, dtype=np.int16)
    d = np.full((n, width), big, np.int16)  # d[., c]: j letters, j + c - most signs of text
    d[:, most:] = np.arange(most + 1, dtype=np.int16)
    for j in range(1, length + 1):
        letter = letters_[:, j - 1]
        # No way leads past the end of an item or a document.
        miss = text[:, j - 1 : j - 1 + width] != letter[:, None]
        ended = np.where(miss, big, d).min(1)
        ended[letter <= ITEM_END] = big
        best[live, j] = ended
        fresh = d + miss
        np.minimum(fresh[:, :-1], d[:, 1:] + 1, out=fresh[:, :-1])
        if j <= most:
            fresh[:, : most - j] = big
            fresh[:, most - j] = j
        fresh = np.minimum.accumulate(fresh - slope, axis=1) + slope
        fresh[letter <= ITEM_END] = big
        stay = fresh.min(1) <= most
        if not stay.all():
            live, fresh = live[stay], fresh[stay]
            if not len(live):
                break
            text, letters_ = text[stay], letters_[stay]
        d = fresh
    return best


def _dense(seen: np.ndarray, items: Items, lost: int) -> np.ndarray:
    """Whether any stretch of a row has as many grams as a run of one of the lengths leaves: an edit spoils `gram` of
    them at most, and `lost` more an edit may lie outside. Lengths are taken three sorts at a time, which asks less."""
    upto = np.zeros((len(seen), seen.shape[1] + 1), np.int16)
    np.cumsum(seen, 1, dtype=np.int16, out=upto[:, 1:])
    out, q = np.zeros(len(seen), bool), items.gram
    for k in range(0, len(items.lengths), 3):
        some = items.lengths[k : k + 3]
        width = min(some[-1][1] + some[-1][0] // 10 - q + 1, seen.shape[1])
        need = min(low - q + 1 - (q + lost) * (low // 10) for low, _ in some)
        out |= (upto[:, width:] - upto[:, :-width]).max(1) >= need
    return out


def plausible(grams: np.ndarray, items: Items, p: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Whether the document around p to p + PLACES has enough of the item's grams for a case of any length."""
    around = np.lib.stride_tricks.sliding_window_view(grams, 2 * items.pad + PLACES)
    out = np.zeros(len(p), bool)
    for a in range(0, len(p), 1024):
        out[a : a + 1024] = _dense(items.flags[items.flag(around[p[a : a + 1024] - items.pad], item[a : a + 1024, None])], items, 0)
    return out


def in_place(grams: np.ndarray, items: Items, p: np.ndarray, s: np.ndarray) -> np.ndarray:
    """As plausible(), but a gram of the document counts only where the item has it at most `most` places off, for any of
    DIAGONALS diagonals. s is where the item's ended letters stand at p on the first of them in the item's order."""
    size, most = items.longest, items.most
    width = 2 * size + PLACES
    around = np.lib.stride_tricks.sliding_window_view(grams, width)
    spare = np.full(PLACES + 2 * DIAGONALS, -1, np.int32)
    own = np.r_[spare, items.ended_grams, spare]
    own = np.lib.stride_tricks.sliding_window_view(own, width + 2 * most + DIAGONALS)
    # A run's letters in the item are within size of s, their grams in the document within size + most of p;
    # what of them lies outside the places looked at here is allowed for.
    out = np.zeros(len(p), bool)
    for a in range(0, len(p), 1024):
        text = around[p[a : a + 1024] - size]
        mine = own[s[a : a + 1024] + len(spare) - size - most]
        seen = np.zeros(text.shape, bool)
        for shift in range(2 * most + DIAGONALS):
            seen |= text == mine[:, shift : shift + width]
        out[a : a + 1024] = _dense(seen, items, 1)
    return out


def verified(doc: np.ndarray, items: Items, p: np.ndarray, s: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Whether a run of the item's least length or more through the aligned places p (of doc) and s has a tenth of edits at
    most, and begins and ends with letters that are there.

    doc begins and ends with as many end signs as items.pad says, which p counts.
    """
    out = np.zeros(len(p), bool)
    size, most, least = items.longest, items.most, items.least
    texts = np.lib.stride_tricks.sliding_window_view(doc, size + 2 * most)
    runs = np.lib.stride_tricks.sliding_window_view(items.ended, size)
    letter = np.arange(size + 1, dtype=np.int16)
    for a in range(0, len(p), 4096):
        here, there = p[a : a + 4096], s[a : a + 4096] + item[a : a + 4096] + 1 + items.pad
        right = _reach(texts[here - most], runs[there], most)
        # The way to the left is the same with both sides turned round.
        left = _reach(texts[here - size - most][:, ::-1], runs[there - size][:, ::-1], most)
        # Ten times the edits less the letters, to be 0 at most for both ways together; for each way to the left the
        # best to the right that makes the run long enough.
        right, left = 10 * right - letter, 10 * left - letter
        right = np.minimum.accumulate(right[:, ::-1], 1)[:, ::-1]
        out[a : a + 4096] = (left + right[:, np.maximum(least - letter, 0)]).min(1) <= 0
    return out


def _scan(items: Items, codes: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, items) that are cases, for documents given as letters."""
    upto = np.r_[0, np.cumsum(_ideograph(codes))][offsets]
    n = np.diff(offsets)
    han = np.diff(upto)
    use = np.flatnonzero((n > 0) & (han >= items.need[0]) & (n - han >= items.need[1]))
    if not len(use) or not items.any:
        return
    n = n[use]
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    # Documents one behind the other, an end sign after each, so that no window or run leaves its document.
    owner = np.repeat(np.arange(len(n)), n)
    margin = items.pad
    stop = margin + n.sum() + len(n)
    doc = np.full(stop + margin + PLACES, DOC_END, np.int32)
    doc[margin + np.arange(n.sum()) + owner] = codes[np.repeat(offsets[use], n) + inner]
    starts = margin + np.cumsum(n) - n + np.arange(len(n))
    hits_p, hits_s = [], []
    for first in range(margin, stop, CHUNK):
        last = min(first + CHUNK, stop)
        for key, (known, where, slot) in zip(window_keys(doc, first, last, items.walk, items.odd), items.tables, strict=True):
            at = np.flatnonzero(slot[key >> np.uint32(32 - SLOTS)])
            lo = np.searchsorted(known, key[at], "left")
            some = known[np.minimum(lo, len(known) - 1)] == key[at]
            at, lo = at[some], lo[some]
            m = np.searchsorted(known, key[at], "right") - lo
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            hits_p.append(np.repeat(at, m) + first)
            hits_s.append(where[np.repeat(lo, m) + inner])
    p, s = np.concatenate(hits_p), np.concatenate(hits_s)
    if not len(p):
        return
    item, row = items.owner[s], np.searchsorted(starts, p, "right") - 1
    pair = row * len(items.ids) + item
    # Hits of a pair on about one diagonal at about one place stand or fall together.
    shift, spot = (p - s) // DIAGONALS, p // PLACES
    by = np.lexsort((p, p - s, spot, shift, pair))
    p, s, item, pair, shift, spot = (x[by] for x in (p, s, item, pair, shift, spot))
    new = np.r_[True, (pair[1:] != pair[:-1]) | (shift[1:] != shift[:-1]) | (spot[1:] != spot[:-1])]
    first, cluster = np.flatnonzero(new), np.cumsum(new) - 1
    grams = items.grams(doc)
    begin = np.maximum(spot[first] * PLACES, margin)
    good = plausible(grams, items, begin, item[first])
    some = first[good]
    good[good] = in_place(grams, items, begin[good], begin[good] - (shift[some] * DIAGONALS + DIAGONALS - 1) + item[some] + 1 + items.pad)
    keep = good[cluster]
    p, s, item, pair = p[keep], s[keep], item[keep], pair[keep]
    # Of hits that follow each other on a diagonal the first and the last stand for all, as a window may begin shortly
    # before an edit that moved the diagonal.
    lead = np.r_[True, (pair[1:] != pair[:-1]) | (p[1:] - s[1:] != p[:-1] - s[:-1]) | (p[1:] - p[:-1] > 1)][: len(p)]
    lead |= np.r_[lead[1:], True][: len(p)]
    p, s, item, pair = p[lead], s[lead], item[lead], pair[lead]
    # On to the first letter that both have: a run begins and ends with such, so one that passes here passes there too.
    ahead = np.arange(DIAGONALS)
    same = doc[np.minimum(p[:, None] + ahead, len(doc) - 1)] == items.ended[(s + item + 1 + items.pad)[:, None] + ahead]
    on, some = same.argmax(1), same.any(1)
    p, s, item, pair = (p + on)[some], (s + on)[some], item[some], pair[some]
    # One candidate of each pair decides most; the others are looked at together.
    turn = np.r_[True, pair[1:] != pair[:-1]][: len(pair)]
    for _ in range(2):
        good = verified(doc, items, p[turn], s[turn], item[turn])
        found = np.unique(pair[turn][good])
        yield use[found // len(items.ids)], found % len(items.ids)
        rest = ~turn & ~np.isin(pair, found)
        p, s, item, pair = p[rest], s[rest], item[rest], pair[rest]
        turn = np.ones(len(pair), bool)


def _finder(held: list[tuple[list, np.ndarray, np.ndarray, int]], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = [Items(*x) for x in held]
        for b in batches:
            codes, offsets = letters(*from_arrow(b.column("_t")))
            begin = 0
            # Rows in runs of a bounded number of letters; a longer text is a run of its own, whole.
            while begin < len(offsets) - 1:
                end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + 4 * CHUNK, "right")) - 1)
                part = offsets[begin : end + 1]
                for items in groups:
                    for rows, found in _scan(items, codes[part[0] : part[-1]], part - part[0]):
                        ids = b.column("_d").take(pa.array(rows + begin))
                        yield pa.RecordBatch.from_arrays([ids, pa.array([items.ids[i] for i in found], schema.field(1).type)], names=["_d", "_i"])
                begin = end

    return run


def leaked(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, least: Column) -> DataFrame:
    """(doc_id, item_id), distinct: the document contains a run of the item's letters of at least `least` letters
    (an expression over items), of which a tenth at most was changed, doubled or left out.

    Only letters and digits count, without case and width. Null and empty texts, and items shorter than
    their least run, are no cases; null ids are left out; repeated rows count once; a text of any length is
    searched whole; other columns aren't read.

    Every window of every document, and of every item, is embedded by a CGK random walk, which turns edits into
    a few differing places; tables of sampled places bring windows together, and candidates are verified by
    banded edit distance. Documents are never shuffled. Items are held in memory in blocks of at most
    BLOCK_LETTERS letters, one scan of the documents for each block.
    """
    rows = items.select(F.col(item_id).alias("_i"), F.col(item_text).alias("_t"), least.cast("int").alias("_n")).where("_i IS NOT NULL AND _t <> ''")
    rows = rows.distinct().withColumn("_w", F.length("_t").cast("long"))
    total = rows.agg(F.coalesce(F.sum("_w"), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // BLOCK_LETTERS))
    if blocks > 1:
        # Cut where the running total of letters passes a block, so that none holds more than a block and one item.
        order = [F.xxhash64("_i"), F.col("_i"), F.col("_n"), F.col("_t")]
        rows = stored(running_total(range_blocks(rows, order), order, "_w", "_run").withColumn("_block", F.expr(f"(_run - _w) div {BLOCK_LETTERS}")).select("_i", "_t", "_n", "_block"))
    else:
        rows = rows.select("_i", "_t", "_n", F.lit(0).alias("_block"))
    kinds = [docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()]
    source = docs.select(F.col(doc_id).alias("_d"), F.col(text).alias("_t")).where("_d IS NOT NULL AND _t <> ''")
    found = None
    schema = to_arrow_schema(StructType([StructField("_d", docs.schema[doc_id].dataType), StructField("_i", items.schema[item_id].dataType)]))
    for block in range(blocks):
        held = rows.where(F.col("_block") == block).drop("_block").toPandas()
        groups = [(x["_i"].tolist(), *letters(*from_arrow(pa.array(x["_t"], pa.string()))), int(n)) for n, x in held.groupby("_n")]
        part = source.mapInArrow(_finder(groups, schema), f"_d {kinds[0]}, _i {kinds[1]}")
        found = part if found is None else found.unionByName(part)
    return found.distinct().select(F.col("_d").alias(doc_id), F.col("_i").alias(item_id))
