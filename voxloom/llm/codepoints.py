"""Text as arrays of code points: table gathers, expansion and composition without a call per row."""

from __future__ import annotations

import unicodedata as U
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 0x110000
#: Code points with properties that matter here lie below or in these ranges.
ASSIGNED = [*range(0x20, 0x323B0), *range(0xE0000, 0xE01F0)]

# Greek, Cyrillic, Armenian, Cherokee and Lisu letters that look like Latin ones, and the Latin letters.
LOOKALIKES = (
    ("օսհո", "ouhn"),
    ("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ", "ABCDEHJKLMPRSTVWZ"),
    ("ꓐꓑꓓꓔꓖꓗꓙꓚꓜꓝꓠꓡꓢꓣꓦꓧꓪꓫꓬꓮꓰꓲꓳꓴ", "BPDTGKJCZFNLSRVHWXYAEIOU"),
    ("ԌԚԜӀ", "GQWI"),
    ("ӏѵ", "lv"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX"),
    ("οιν", "oiv"),
    ("АВЕЅІЈКМНОРСТУХ", "ABESIJKMHOPCTYX"),
    ("аеоѕіјрсухһԁԛԝ", "aeosijpcyxhdqw"),
)

# Signs without visible shape besides those of category Cf.
INVISIBLE = (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x180B, 0x180C, 0x180D, 0x180F, 0x3164, 0xFFA0)

# Blocks whose compatibility forms look like what they stand for (radicals, Roman numerals,
# digraphs, ligatures), besides the full-width and half-width forms, which are marked as such.
SAME_LOOK = ((0x132, 0x133), (0x1C4, 0x1CC), (0x2160, 0x217F), (0x2E80, 0x2FDF), (0xFB00, 0xFB06))


class Table:
    """For each code point what replaces it: itself, another, none or several."""

    def __init__(self, rule) -> None:
        self.one = np.arange(SIZE, dtype=np.int32)
        self.length = np.ones(SIZE, np.int8)
        many: list[str] = []
        for c in [*range(0x20), *ASSIGNED]:
            if 0xD800 <= c < 0xE000:
                continue
            s = rule(c)
            if len(s) == 1:
                self.one[c] = ord(s)
            else:
                self.length[c] = len(s)
                self.one[c] = len(many)
                if s:
                    many.append(s)
        self.many = np.array([ord(x) for s in many for x in s], np.int32)
        self.first = np.r_[0, np.cumsum([len(s) for s in many])].astype(np.int64)

    def apply(self, codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = self.length[codes]
        if (length == 1).all():
            return self.one[codes], offsets
        at = np.r_[0, np.cumsum(length, dtype=np.int64)]
        out = np.empty(at[-1], np.int32)
        single = length == 1
        out[at[:-1][single]] = self.one[codes[single]]
        if (several := np.flatnonzero(length > 1)).size:
            n = length[several].astype(np.int64)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(at[several], n) + inner] = self.many[np.repeat(self.first[self.one[codes[several]]], n) + inner]
        return out, at[offsets]


def from_arrow(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All code points of a string array, and where each row begins; null rows are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or bounds[-1] == bounds[0]:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    raw = memoryview(texts.buffers()[2])[bounds[0] : bounds[-1]]
    codes = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.int32)
    begins = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    return codes, np.r_[0, np.cumsum(begins)][bounds - bounds[0]]


def to_arrow(codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    raw = codes.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
    at = np.r_[0, np.cumsum(width, dtype=np.int64)][offsets]
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(at)), pa.py_buffer(raw)).cast(pa.string())


def keep(codes: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return codes[mask], np.r_[0, np.cumsum(mask, dtype=np.int64)][offsets]


@lru_cache(1)
def _marks() -> tuple[np.ndarray, Table, np.ndarray, np.ndarray]:
    """Combining class per code point; canonical decomposition; sorted pairs that compose, and what they give."""
    order = np.zeros(SIZE, np.uint8)
    pairs: dict[int, int] = {}
    for c in ASSIGNED:
        order[c] = U.combining(chr(c))
        d = U.decomposition(chr(c))
        if d and d[0] != "<" and len(d.split()) == 2:
            a, b = (int(x, 16) for x in d.split())
            if U.normalize("NFC", chr(a) + chr(b)) == chr(c):
                pairs[a << 21 | b] = c
    keys = np.array(sorted(pairs), np.int64)
    table = Table(lambda c: chr(c) if 0xAC00 <= c <= 0xD7A3 else U.normalize("NFD", chr(c)))
    return order, table, keys, np.array([pairs[k] for k in keys.tolist()], np.int32)


def compose(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Normalisation form C, given that every code point alone already has it.

    Only clusters with a combining mark are taken apart: expanded, their marks ordered by class, and
    composed one mark at a time for all clusters at once.
    """
    order, table, keys, made = _marks()
    mark = order[codes] > 0
    if not mark.any():
        return codes, offsets
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    head = np.r_[True, row[1:] != row[:-1]]
    cluster = mark | (np.r_[mark[1:], False] & ~np.r_[head[1:], True])
    rest, inside = np.flatnonzero(~cluster), np.flatnonzero(cluster)
    sub, bounds = table.apply(codes[inside], np.arange(len(inside) + 1))
    place = np.repeat(inside, np.diff(bounds))
    level = order[sub].astype(np.int64)
    begin = (level == 0) | np.r_[True, row[place[1:]] != row[place[:-1]]]
    group = np.cumsum(begin) - 1
    by = np.lexsort((level, group))
    sub, level = sub[by].astype(np.int64), level[by]  # places stay: a group's marks only change among themselves
    first = np.flatnonzero(begin)  # the place of each group's starter; a mark without one stands for itself
    alive, failed = np.ones(len(sub), bool), np.zeros(len(sub), bool)
    failed[first] = True
    done = np.zeros(len(first), np.int64)  # class of the last mark that stayed in the group
    while (todo := np.flatnonzero(~failed)).size:
        todo = todo[np.r_[True, group[todo[1:]] != group[todo[:-1]]]]
        failed[todo] = True
        g = group[todo]
        key = sub[first[g]] << 21 | sub[todo]
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        ok = (keys[at] == key) & (level[first[g]] == 0) & (done[g] < level[todo])
        sub[first[g[ok]]] = made[at[ok]]
        alive[todo[ok]] = False
        done[g[~ok]] = level[todo[~ok]]
    joined = np.r_[codes[rest], sub[alive]]
    where = np.r_[rest, place[alive]]
    by = np.argsort(where, kind="stable")
    return joined[by].astype(np.int32), np.r_[0, np.cumsum(np.bincount(row[where], minlength=len(offsets) - 1))]


def _look(c: int) -> str:
    """What a reader sees of one code point, before composition with what follows."""
    ch = chr(c)
    kind = U.category(ch)
    if c in (0x0A, 0x0B, 0x0C, 0x85, 0x2028, 0x2029):
        return "\n"
    if kind == "Zs" or ch == "\t":
        return " "
    if kind in ("Cf", "Cc") or c in INVISIBLE or 0xFE00 <= c <= 0xFE0F or 0xE0100 <= c <= 0xE01EF:
        return ""
    form = U.decomposition(ch)
    if form.startswith(("<wide>", "<narrow>")) or form.startswith("<compat>") and any(a <= c <= b for a, b in SAME_LOOK):
        ch = U.normalize("NFKC", ch)
    return U.normalize("NFC", U.normalize("NFD", ch).translate(_letters_alike()))


@lru_cache(1)
def _letters_alike() -> dict[int, int]:
    return {ord(a): ord(b) for x, y in LOOKALIKES for a, b in zip(x, y, strict=True)}


@lru_cache(1)
def look_table() -> Table:
    return Table(_look)


def _letters(c: int) -> str:
    s = U.normalize("NFC", U.normalize("NFKC", chr(c)).casefold())
    return "".join(x for x in s if U.category(x)[0] in "LN" or U.combining(x))


@lru_cache(1)
def letter_table() -> Table:
    return Table(_letters)


def seen(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One form for all texts that look alike: same signs, composed accents, plain blanks, none at the ends."""
    codes, offsets = compose(*look_table().apply(codes, offsets))
    shown = (codes != 0x20) & (codes != 0x0A)
    upto = np.r_[0, np.cumsum(shown)]
    n = np.diff(offsets)
    before, after = np.repeat(upto[offsets[:-1]], n), np.repeat(upto[offsets[1:]], n)
    return keep(codes, offsets, (upto[1:] > before) & (upto[:-1] < after))


def letters(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits only, without case, width and compatibility forms; marks that compose with none go."""
    codes, offsets = compose(*letter_table().apply(codes, offsets))
    left = _marks()[0][codes] > 0
    return keep(codes, offsets, ~left) if left.any() else (codes, offsets)
