"""Text that was decoded with a wrong encoding: found by the garbled forms of clean corpus words, and restored."""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .codepoints import SIZE, from_arrow
from .leaks import mix

# Encodings that take a byte for a sign, of Latin and of other alphabets, and those that take two for most.
LATIN = ("cp1252", "latin_1", "cp1250", "iso8859_15", "mac_roman", "cp437", "cp850")
OTHER = ("cp1251", "koi8_r", "iso8859_5", "cp866", "cp1253", "iso8859_7")
DOUBLE = ("gbk", "cp932", "big5")
SINGLE = LATIN + OTHER
#: Encodings in which text is garbled again and again, up to DEPTH times.
AGAIN, DEPTH = ("cp1252", "latin_1"), 3
LOST = "�"
WORDS_HELD = 1 << 20
SLICE = 512
#: Sorts of chains, in the order in which a form's word is chosen: through UTF-8 as often as possible (else the word itself
#: may be garbled), from two bytes, from another alphabet's byte (only where the word is more frequent than the form),
#: and with lost signs.
ONCE, TWO_BYTES, ONE_BYTE, LOSING = range(DEPTH - 1, DEPTH + 3)
LETTER, PAIR, WORD = range(3)
#: n: in how many texts a form may stand to be one; any number for letters of UTF-8, whose forms are no words.
FORMS = "_h long, rank int, chain string, word string, form string, n long"
ANY = 1 << 62
#: What sets apart the hashes of letters read in another alphabet.
APART = 0x5555555555555555


def _chains() -> dict[int, list[tuple[int, str]]]:
    """Chains, written as steps "encoded in > decoded as", for single letters, pairs of wide signs, and words of alphabets.

    All pairs of the encodings above where one reads what the other wrote.
    """
    once = {x: (ONCE, f"utf_8>{x}") for x in SINGLE + DOUBLE}
    again = [(DEPTH - n, ",".join([f"utf_8>{x}"] * n)) for x in AGAIN for n in range(2, DEPTH + 1)]
    pairs = [once[x] for x in DOUBLE + OTHER] + [(TWO_BYTES, f"{a}>{x}") for a in DOUBLE for x in SINGLE] + [(LOSING, f"{a}>utf_8") for a in DOUBLE]
    words = [*once.values(), *again] + [(ONE_BYTE, f"{a}>{x}") for a in SINGLE for x in SINGLE if a != x] + [(LOSING, f"{a}>utf_8") for a in SINGLE]
    return {LETTER: [once[x] for x in SINGLE] + again, PAIR: pairs, WORD: words}


@lru_cache(None)
def _singles(encoding: str) -> str:
    """The sign of each byte, as decoders in the wild have it: where there is none, the control sign of that number."""
    return "".join(chr(b) if c == LOST else c for b, c in enumerate(bytes([b]).decode(encoding, "replace") for b in range(256)))


def decode(raw: bytes, encoding: str) -> str:
    if encoding in SINGLE:
        return codecs.charmap_decode(raw, "strict", _singles(encoding))[0]
    return raw.decode(encoding, "replace")


def garble(word: str, chain: str) -> str | None:
    """word after a chain; None where it can't be encoded so, or comes through unchanged."""
    out = word
    for step in chain.split(","):
        source, target = step.split(">")
        try:
            out = decode(out.encode(source), target)
        except UnicodeEncodeError:
            return None
    return None if out == word else out


@lru_cache(1)
def _tables() -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], dict[str, np.ndarray], np.ndarray]:
    """Per single-byte encoding a sign's byte, or 0; per double-byte one the signs that may begin a wide sign's UTF-8, and
    those that may follow there; and the signs of any of the single-byte ones."""
    single, begins, follows = {}, {}, {}
    some = np.zeros(SIZE, bool)
    for d in SINGLE:
        single[d] = np.zeros(SIZE, np.uint8)
        for b in range(0x80, 0x100):
            single[d][ord(_singles(d)[b])] = b
        some |= single[d] > 0
    for d in DOUBLE:
        begins[d], follows[d] = np.zeros(SIZE, bool), np.zeros(SIZE, bool)
        rest = range(0x80, 0xC0)
        heads = range(0xE2, 0xF0)
        raws = [(begins, bytes([a, b])) for a in heads for b in rest] + [(follows, bytes([b])) for b in [*rest, *heads]]
        raws += [(follows, bytes([a, b])) for a in [*rest, *heads] for b in [*rest, *heads]]
        for where, raw in raws:
            out = raw.decode(d, "replace")
            if len(out) == 1:
                where[d][ord(out)] = True
        begins[d][0xFFFD], follows[d][0xFFFD] = False, True
        if d == "cp932":
            # Its single bytes read the UTF-8's first byte too.
            begins[d][[ord(bytes([a]).decode(d, "replace")[0]) for a in range(0xC2, 0xE0)]] = True
    return single, begins, follows, some


class Hashes:
    """Hashes of any stretches of a row of letters, without making the stretches."""

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        power, self.back = _powers(1 << max(10, n.bit_length()))
        self.upto = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(codes) * power[:n], out=self.upto[1:])

    def of(self, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        return mix((self.upto[first + n] - self.upto[first]) * self.back[first] ^ n.astype(np.uint64)).view(np.int64)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def hashes_of(texts: list[str]) -> np.ndarray:
    codes, offsets = from_arrow(pa.array(texts, pa.string()))
    return Hashes(codes).of(offsets[:-1], np.diff(offsets))


def _row_of(offsets: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def _wide(codes: np.ndarray) -> np.ndarray:
    return (codes >= 0x2E80) & (codes < 0x10000) & (codes != 0xFFFD) | (codes >= 0x20000)


def _runs(codes: np.ndarray, row: np.ndarray, clean: bool) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of words with a sign beyond ASCII, bounded by ASCII blanks and signs; of clean words those without
    wide signs, which belong to no alphabet. A lone letter, which may be garbled to an ordinary sign, comes with the
    word before or after it."""
    ascii_ = codes < 0x80
    plain = ascii_ & ((codes >= 0x30) & (codes < 0x3A) | ((codes | 32) >= 0x61) & ((codes | 32) < 0x7B))
    at = np.flatnonzero(plain | ~ascii_)
    if not len(at):
        return at, at
    begin = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (row[at[1:]] != row[at[:-1]])])
    n = np.diff(np.r_[begin, len(at)])
    plains = np.add.reduceat(plain[at].astype(np.int64), begin)
    fit = np.add.reduceat(_wide(codes[at]).astype(np.int64), begin) == 0 if clean else np.ones(len(begin), bool)
    first = at[begin]
    ok = (plains < n) & fit & (n > 1)
    lone = np.flatnonzero((plains == 0) & (n <= (1 if clean else 4)) & fit)
    out = [(first[ok], n[ok])]
    for a, b in ((lone[lone > 0] - 1, lone[lone > 0]), (lone[lone < len(n) - 1], lone[lone < len(n) - 1] + 1)):
        some = (row[first[a]] == row[first[b]]) & (plains[a] + plains[b] > 0) & fit[a] & fit[b]
        out.append((first[a[some]], first[b[some]] + n[b[some]] - first[a[some]]))
    first, n = (np.concatenate(x) for x in zip(*out, strict=True))
    return first, n


def _sequences(b: np.ndarray, left: np.ndarray) -> np.ndarray:
    """How long a UTF-8 sequence of bytes b begins at each place, or 0."""
    size = len(b)
    b = np.r_[b, np.zeros(4, np.uint8)]
    follows = (b & 0xC0) == 0x80
    n = np.zeros(size, np.int64)
    for k, low, top in ((2, 0xC2, 0xDF), (3, 0xE0, 0xEF), (4, 0xF0, 0xF4)):
        ok = (b[:size] >= low) & (b[:size] <= top) & (left >= k)
        for i in range(1, k):
            ok &= follows[i : i + size]
        n[ok] = k
    return n


def _left(at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """How many of the places at follow each other from each on, within a row."""
    end = np.r_[np.flatnonzero((np.diff(at) != 1) | (row[at[1:]] != row[at[:-1]])), len(at) - 1]
    return end[np.searchsorted(end, np.arange(len(at)))] - np.arange(len(at)) + 1


def suspects(codes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, length, apart) of stretches that could be garbled forms of letters or pairs, by the bytes they would stand for;
    apart are those of letters read in another alphabet."""
    single, begins, follows, some = _tables()
    starts, lengths, apart = [], [], []
    at = np.flatnonzero(some[codes])
    if len(at):
        left, c = _left(at, row), codes[at]
        latin = ((codes | 32) >= 0x61) & ((codes | 32) < 0x7B)
        for d in SINGLE:
            b = single[d][c]
            n = _sequences(b, left)
            if d in LATIN:
                hit = np.flatnonzero(n)
                starts.append(at[hit]), lengths.append(n[hit])
                if d in AGAIN and len(hit):
                    # Letters garbled more than once are several sequences on end: of four at most for the first time,
                    # so of 12 at most for the third.
                    after = np.full(len(c) + 5, -1)
                    after[hit] = hit + n[hit]
                    origin, stop = hit, hit + n[hit]
                    for _ in range(4 * 3 ** (DEPTH - 2) - 1):
                        more = (after[stop] >= 0) & (left[origin] > stop - origin)
                        origin, stop = origin[more], after[stop[more]]
                        starts.append(at[origin]), lengths.append(stop - origin)
            else:
                # A letter of two bytes is two ordinary ones of that alphabet, unless it stands beside an ASCII letter.
                a, z = np.maximum(at - 1, 0), np.minimum(at + 2, len(codes) - 1)
                beside = latin[a] & (row[a] == row[at]) & (at > 0) | latin[z] & (row[z] == row[at]) & (at + 2 < len(codes))
                hit = np.flatnonzero((n == 3) | (n == 2) & beside)
                apart.append(len(starts))
                starts.append(at[hit]), lengths.append(n[hit])
                # Two wide signs on end.
                three = np.r_[n == 3, np.zeros(3, bool)]
                hit = np.flatnonzero(three[: len(n)] & three[3:] & (left >= 6))
                starts.append(at[hit]), lengths.append(np.full(len(hit), 6))
            # Two wide signs in two bytes each.
            high = np.r_[b >= 0x81, np.zeros(4, bool)]
            hit = np.flatnonzero(high[: len(c)] & high[1 : 1 + len(c)] & high[2 : 2 + len(c)] & high[3 : 3 + len(c)] & (left >= 4))
            starts.append(at[hit]), lengths.append(np.full(len(hit), 4))
    at = np.flatnonzero(codes >= 0x80)
    if len(at):
        left, c = _left(at, row), codes[at]
        for d in DOUBLE:
            on = np.r_[follows[d][c], np.zeros(5, bool)]
            hit = np.flatnonzero(begins[d][c] & on[1 : 1 + len(c)])
            for k in (2, 3, 4, 5):
                hit = hit[(left[hit] >= k) & on[hit + k - 1]]
                if k > 2:
                    starts.append(at[hit]), lengths.append(np.full(len(hit), k))
        # What is left of signs of two bytes read as UTF-8: lost ones, and others of two bytes between them.
        lost = np.r_[c == 0xFFFD, np.zeros(4, bool)]
        pale = np.r_[(c == 0xFFFD) | (c < 0x800), np.zeros(4, bool)]
        for k in (2, 3, 4):
            ok, any_, all_ = left >= k, np.zeros(len(c), bool), np.ones(len(c), bool)
            for i in range(k):
                ok, any_, all_ = ok & pale[i : i + len(c)], any_ | lost[i : i + len(c)], all_ & lost[i : i + len(c)]
            hit = np.flatnonzero(ok & any_ & ~all_)
            starts.append(at[hit]), lengths.append(np.full(len(hit), k))
    if not starts:
        return at, at, at > 0
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate([np.full(len(x), i in apart) for i, x in enumerate(starts)])


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for whole in batches:
        for a in range(0, whole.num_rows, SLICE):
            b = whole.slice(a, SLICE)
            codes, offsets = from_arrow(b.column("_t"))
            if len(codes):
                yield b, codes, offsets


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_d, _h): hashes of all stretches of a text that could be garbled forms; one of equal ones in a row is enough."""
    for b, codes, offsets in _sliced(batches):
        row = _row_of(offsets)
        *stretches, apart = suspects(codes, row)
        first, n = (np.concatenate(x) for x in zip(stretches, _runs(codes, row, False), strict=True))
        if len(first):
            h = Hashes(codes).of(first, n)
            h[: len(apart)][apart] ^= APART
            by = np.lexsort((h, row[first]))
            h, r = h[by], row[first][by]
            new = np.r_[True, (h[1:] != h[:-1]) | (r[1:] != r[:-1])]
            yield pa.RecordBatch.from_arrays([b.column("_d").take(pa.array(r[new])), pa.array(h[new])], names=["_d", "_h"])


def _per_text(row: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct names, one place of each, and in how many rows each stands."""
    by = np.lexsort((name, row))
    new = np.r_[True, (name[by[1:]] != name[by[:-1]]) | (row[by[1:]] != row[by[:-1]])][: len(by)]
    name_, one, n = np.unique(name[by[new]], return_index=True, return_counts=True)
    return name_, by[new][one], n


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_w, _kind, n): the distinct letters beyond ASCII, pairs of adjacent wide signs, and words of alphabets, with the
    number of texts that have them."""
    held, often, words = np.zeros(0, np.int64), np.zeros(0, np.int64), {}

    def out() -> pa.RecordBatch:
        made = [chr(w >> 21) + chr(w & 0x1FFFFF) if w >> 21 else chr(w) for w in held.tolist()]
        kinds = [PAIR if len(w) == 2 else LETTER for w in made] + [WORD] * len(words)
        return pa.RecordBatch.from_arrays([pa.array([*made, *words], pa.string()), pa.array(kinds, pa.int32()), pa.array([*often.tolist(), *words.values()], pa.int64())], names=["_w", "_kind", "n"])

    for _, codes, offsets in _sliced(batches):
        row, c = _row_of(offsets), codes.astype(np.int64)
        wide = _wide(codes)
        both = np.flatnonzero(wide[:-1] & wide[1:] & (row[1:] == row[:-1]))
        fresh = np.unique(c[(c >= 0x80) & (c != 0xFFFD)])
        pair, _, n = _per_text(row[both], c[both] << 21 | c[both + 1])
        held, at = np.unique(np.r_[held, fresh, pair], return_inverse=True)
        often = np.bincount(at, np.r_[often, np.ones(len(fresh), np.int64), n], len(held)).astype(np.int64)
        first, n = _runs(codes, row, True)
        if len(first):
            _, one, count = _per_text(row[first], Hashes(codes).of(first, n))
            text = codes.astype("<u4").tobytes().decode("utf-32-le")
            for x, k, m in zip(first[one].tolist(), n[one].tolist(), count.tolist(), strict=True):
                w = text[x : x + k]
                words[w] = words.get(w, 0) + m
        if len(held) + len(words) > WORDS_HELD:
            yield out()
            held, often, words = held[:0], often[:0], {}
    yield out()


def _garbled(word: str, chains: list[tuple[int, str]]) -> dict[str, tuple[int, str]]:
    """The distinct forms of word, each with the surest of its chains; what is encoded alike is encoded once."""
    raws: dict[str, bytes | None] = {}
    made: dict[str, tuple[int, str]] = {}
    for rank, chain in chains:
        source, _, target = chain.partition(">")
        if "," in target:
            form = garble(word, chain)
        else:
            if source not in raws:
                try:
                    raws[source] = word.encode(source)
                except UnicodeEncodeError:
                    raws[source] = None
            raw = raws[source]
            form = None if raw is None else decode(raw, target)
        # Lost signs alone say nothing of the word; with its other signs around them they do.
        if form and form != word and (rank != LOSING or LOST in form and form.strip(LOST)):
            made.setdefault(form, (rank, chain))
    return made


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    chains = _chains()
    # A word of few letters reads as an ordinary one in another alphabet.
    short = [x for x in chains[WORD] if x[0] != ONE_BYTE]
    other = {f"utf_8>{x}" for x in OTHER}
    for whole in batches:
        for a in range(0, whole.num_rows, SLICE):
            b = whole.slice(a, SLICE)
            out: list[tuple] = []
            for word, kind, n in zip(*(b.column(c).to_pylist() for c in ("_w", "_kind", "n")), strict=True):
                for form, (rank, chain) in _garbled(word, short if kind == WORD and len(word) < 4 else chains[kind]).items():
                    out.append((rank, chain, word, form, ANY if kind == LETTER else n - (rank == ONE_BYTE)))
            if out:
                rank, chain, word, form, n = zip(*out, strict=True)
                # A letter read in another alphabet is looked for where it stands apart, never as a word of its own.
                h = hashes_of(list(form)) ^ np.array([APART if len(w) == 1 and c in other else 0 for w, c in zip(word, chain, strict=True)], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(rank, pa.int32()), pa.array(chain), pa.array(word), pa.array(form), pa.array(n, pa.int64())], names=FORM_NAMES)


FORM_NAMES = [c.split()[0] for c in FORMS.split(", ")]


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(hashes_of(b.column("_w").to_pylist())), b.column("_w")], names=["_h", "word"])


def clean_words(rows: DataFrame) -> DataFrame:
    """(_w, _kind, n): distinct words of the texts _t, with the number of texts.

    Words of garbled texts are among them. Their forms are those of texts garbled twice, or, where one chain undoes another,
    clean words: therefore a form must not stand in more texts than its word does.
    """
    return rows.select("_t").mapInArrow(_words, "_w string, _kind int, n long").groupBy("_w", "_kind").agg(F.sum("n").alias("n"))


def _texts(df: DataFrame, ident: str, text: str) -> DataFrame:
    return df.select(F.col(ident).alias("_d"), F.col(text).alias("_t")).where("_d IS NOT NULL AND _t <> ''")


def garbled_records(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident), distinct: records with a stretch that is a garbled form of a word of all of df, as garbled_tokens() has it."""
    return _hits(df, ident, text)[0].select(F.col("_d").alias(ident)).distinct()


def _hits(df: DataFrame, ident: str, text: str) -> tuple[DataFrame, DataFrame]:
    rows = _texts(df, ident, text)
    words = stored(clean_words(rows))
    tokens = rows.mapInArrow(_found, f"_d {df.schema[ident].dataType.simpleString()}, _h long")
    forms = words.mapInArrow(_forms, FORMS)
    hits = stored(tokens.join(forms.groupBy("_h").agg(F.max("n").alias("_most")), "_h"))
    rare = hits.groupBy("_h").agg(F.count("*").alias("_n"), F.max("_most").alias("_most")).where("_n <= _most").select("_h", "_n")
    return hits.join(rare, "_h").select("_d", "_h", "_n"), forms


def garbled_tokens(df: DataFrame, ident: str, text: str) -> DataFrame:
    """(ident, form, chain, word, sure), distinct: stretches of texts that are garbled forms of words of all of df.

    Null and empty texts, and null ids, are left out; a foreign or rare sign is no case, as it is no garbled
    form of a word, nor is a sign that names a lost one; repeated rows count once; other columns aren't read; texts are
    read whole. Stretches are found by a hash of 64 bits, so nothing but hashes is shuffled. chain is the surest
    encoding chain that gives this form, word its original; sure is false where that chain's sort has several.
    """
    hits, made = _hits(df, ident, text)
    hits = stored(hits)
    some = stored(made.join(hits.select("_h", "_n").distinct(), "_h").where("_n <= n"))
    # Words that are garbled forms themselves are originals only where there is no other.
    names = some.select(F.col("word").alias("_w")).distinct().mapInArrow(_named, "_h long, word string")
    again = names.join(made.where(F.col("rank") <= ONCE).select("_h"), "_h", "left_semi").select("word", F.lit(True).alias("_again")).distinct()
    some = some.join(again, "word", "left").withColumn("_order", F.struct(F.coalesce("_again", F.lit(False)).alias("again"), "rank"))
    best = some.groupBy("_h").agg(F.min(F.struct("_order", "chain", "word", "form")).alias("_x"))
    best = best.join(some.select("_h", F.col("_order").alias("_r"), F.col("word").alias("_w")), "_h").where("_r = _x._order")
    best = best.groupBy("_h").agg(F.first("_x").alias("_x"), (F.min("_w") == F.max("_w")).alias("sure"))
    return hits.join(best, "_h").select(F.col("_d").alias(ident), "_x.form", "_x.chain", "_x.word", "sure").distinct()


def _restore(text: str, found: list[dict]) -> str:
    """Letters are replaced and runs decoded back along the chain that was found for pairs of signs, what covers more of the
    text first; then other stretches are replaced by their words."""
    sure = {x["form"]: x["word"] for x in found if x["sure"] and LOST not in x["form"]}
    letters = {f: w for f, w in sure.items() if len(w) == 1}
    two = [x["form"] for x in found if len(x["word"]) == 2 and _order_of(x["chain"]) == TWO_BYTES]
    first = _covered(text, list(letters)) >= _covered(text, two)
    if first:
        text = _replaced(text, letters)
    pairs = {x["chain"] for x in found if len(x["word"]) == 2 and _wide(np.array(list(map(ord, x["word"])))).all() and not x["chain"].endswith(">utf_8")}
    # Forms that both encodings have in common name the one; the rest of a run may need the other.
    pairs |= {c.replace("cp1252", "latin_1") for c in pairs}
    for chain in sorted(pairs):
        source, target = chain.split(">")
        text = re.sub(r"[^\x00-\x7f�]{3,}", lambda m: _back(m[0], source, target), text)
    if not first:
        text = _replaced(text, letters)
    known = {f: w for f, w in sure.items() if len(w) > 1 and not _wide(np.array(list(map(ord, w)))).all()}
    if not known:
        return text
    # Short words say too little to be known by themselves; among known ones they went the same way.
    ways = {x["chain"] for x in found if x["form"] in known and "," not in x["chain"] and all(e in SINGLE for e in x["chain"].split(">"))}
    lines = text.split("\n")
    for source, target in (c.split(">") for c in sorted(ways)):
        for i, line in enumerate(lines):
            words = [m for m in re.findall(r"[^\W_]*[^\x00-\x7f](?:[^\x00-\x7f]|[^\W_])*", line) if m not in known]
            if len(words) * 2 < sum(line.count(f) for f in known if len(f) > 3):
                lines[i] = line = re.sub("|".join(map(re.escape, [*sorted(known, key=len, reverse=True), *words])), lambda m: known.get(m[0]) or _back(m[0], source, target), line)
    return _replaced("\n".join(lines), known)


def _order_of(chain: str) -> int:
    return TWO_BYTES if chain.split(">")[0] in DOUBLE and not chain.endswith(">utf_8") else ONCE


def _covered(text: str, stretches: list[str]) -> int:
    return sum(len(m[0]) for m in re.finditer("|".join(map(re.escape, sorted(stretches, key=len, reverse=True))), text)) if stretches else 0


def _replaced(text: str, known: dict[str, str]) -> str:
    return re.sub("|".join(map(re.escape, sorted(known, key=len, reverse=True))), lambda m: known[m[0]], text) if known else text


def _back(run: str, source: str, target: str) -> str:
    try:
        raw = bytes(_singles(target).index(ch) for ch in run) if target in SINGLE else run.encode(target)
    except (ValueError, UnicodeEncodeError):
        return run
    # Where signs were lost at a run's ends, up to three bytes there belong to them.
    for a in range(4):
        for b in range(4):
            try:
                return LOST * (a > 0) + raw[a : len(raw) - b].decode(source) + LOST * (b > 0)
            except UnicodeDecodeError:
                continue
    return run


def restored(df: DataFrame, ident: str, text: str, tokens: DataFrame) -> DataFrame:
    """(ident, chains, restored) of the garbled records; what can't be restored keeps its signs.

    tokens as from garbled_tokens(). A record's distinct stretches are gathered, which its own text bounds.
    """
    per = tokens.groupBy(ident).agg(F.collect_list(F.struct("form", "chain", "word", "sure")).alias("_x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column("_x").to_pylist()
            out = [_restore(t, x) for t, x in zip(b.column("_t").to_pylist(), found, strict=True)]
            chains = [sorted({y["chain"] for y in x}) for x in found]
            yield pa.RecordBatch.from_arrays([b.column("_d"), pa.array(chains, pa.list_(pa.string())), pa.array(out, pa.string())], names=[ident, "chains", "restored"])

    rows = df.select(F.col(ident).alias("_d"), F.col(text).alias("_t")).where("_t <> ''")
    joined = rows.join(per.withColumnRenamed(ident, "_d"), "_d").select("_d", "_t", "_x")
    return joined.mapInArrow(run, f"`{ident}` {df.schema[ident].dataType.simpleString()}, chains array<string>, restored string")
