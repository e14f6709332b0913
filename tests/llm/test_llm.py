from __future__ import annotations

import random
import unicodedata as U
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxloom.llm import codepoints as C, garbled as G, leaks as K
from voxloom.operators import skew
from voxloom.llm.capping import dropped_by_cap
from voxloom.llm.cutoffs import below_cutoff, cutoffs
from voxloom.llm.grouping import assign_splits, linked_groups
from voxloom.llm.lookalike import alike_classes, alike_pairs, with_form
from voxloom.llm import overlaps as O
from voxloom.llm.overlaps import coverage, overlaps, record_pairs, shared_keys
from voxloom.llm.packing import pack, sum_of_squares, token_counts
from voxloom.llm.percentiles import exact_percentiles, sketch, sketch_percentiles, value_counts


def test_hot_contributors_and_groups(spark, monkeypatch):
    """Joins that spread hot keys give what plain ones give."""
    rng = random.Random(19)
    rows = [(rng.choice(["hot", "hot", "warm", *"abcdef"]), round(rng.random(), 3), f"i{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "c string, s double, i string")
    plain = [sorted(map(tuple, dropped_by_cap(df, "c", "s", "i", most=30).collect())), sorted(map(tuple, exact_percentiles(value_counts(df, "c", ["s"]), ["0.1", "0.5"]).collect()))]
    monkeypatch.setattr(skew, "FLOOR", 10)
    monkeypatch.setattr(skew, "SHARE", 5)
    assert plain == [sorted(map(tuple, dropped_by_cap(df, "c", "s", "i", most=30).collect())), sorted(map(tuple, exact_percentiles(value_counts(df, "c", ["s"]), ["0.1", "0.5"]).collect()))]


def test_capping(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "b", "c", None]), rng.choice([0.5, 0.25, -1.0, 0.1234, None, 0.5001]), f"id{rng.randrange(10**rng.randrange(1, 12)):d}-{i}") for i in range(600)]
    rows += [("hot", 0.5, None), ("é", 0.5, "z"), ("é", 0.5, "é"), ("é", 0.5, "𝒜"), ("é", 0.5, "￿")]
    df = spark.createDataFrame(rows, "c string, s double, i string").withColumn("_k", F.lit("clash"))
    for kw, most in (({"share": "0.1"}, len(rows) // 10), ({"most": 2}, 2), ({"most": 0}, 0), ({"most": 10**6}, 10**6)):
        by = defaultdict(list)
        for c, s, i in rows:
            if c is not None and s is not None and i is not None:
                by[c].append((-s, i.encode()))
        want = {(c, i.decode()) for c, x in by.items() for _, i in sorted(x)[most:]}
        got = {(r["c"], r["i"]) for r in dropped_by_cap(df, "c", "s", "i", **kw).collect()}
        assert got == want
    # Equal rows that straddle the cap: none of them is kept.
    same = spark.createDataFrame([("a", 1.0, "x")] * 3 + [("a", 2.0, "y")], "c string, s double, i string")
    assert dropped_by_cap(same, "c", "s", "i", most=2).count() == 3
    assert dropped_by_cap(df.limit(0), "c", "s", "i", share="0.1").count() == 0


def test_cutoffs(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "b", None]), rng.choice([None, *[x / 8 for x in range(9)]])) for _ in range(400)] + [("one", 0.3), ("nan", float("nan")), ("nan", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").withColumn("cutoff", F.lit(1))
    got = {r["g"]: tuple(r)[1:] for r in cutoffs(df, "g", "x", "0.8").collect()}
    for g in {r[0] for r in rows} - {None, "nan"}:
        xs = [x for k, x in rows if k == g and x is not None]
        t = max(t for t in xs if sum(x >= t for x in xs) * 10 >= 8 * len(xs))
        assert got[g] == (t, len(xs), sum(x >= t for x in xs))
    assert below_cutoff(df.drop("cutoff"), "g", "x", "0.8").count() == sum(n - k for _, n, k in got.values())
    assert cutoffs(df.limit(0), "g", "x", "0.8").count() == 0


def test_percentiles(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", "hot", "hot", None]), rng.choice([rng.uniform(-5, 5), 0.0, -0.0, 1e300, -1e-300, None, float("nan"), round(rng.random(), 2)]), rng.randrange(3)) for _ in range(500)] + [("one", 7.0, 1)]
    df = spark.createDataFrame(rows, "g string, x double, d int").withColumn("metric", F.lit("clash"))
    fr = ["0", "0.1", "0.5", "0.95", "1"]
    days = [value_counts(df.where(f"d = {d}"), "g", ["x"]) for d in range(3)]
    got = {(r["_g"], r["fraction"]): r for r in exact_percentiles(days[0].unionByName(days[1]).unionByName(days[2]), fr).collect()}
    for g in ("a", "b", "hot", "one"):
        xs = [x for k, x, _ in rows if k == g and x is not None and x == x]
        for f in fr:
            assert got[g, f]["n"] == len(xs)
            assert got[g, f]["value"] == pytest.approx(np.percentile(xs, float(f) * 100), rel=1e-9, abs=1e-12)
    for r in sketch_percentiles(sketch(df, "g", ["x"], by=("d",)), ["0.5"]).collect():
        xs = sorted(x for k, x, _ in rows if k == r["_g"] and x is not None and x == x)
        v = xs[max(1, -(-len(xs) // 2)) - 1]
        assert r["low"] <= v <= r["high"]
        assert v <= 0 or r["high"] <= r["low"] * (1 + 2**-7) or r["low"] == 0
    assert exact_percentiles(value_counts(df.limit(0), "g", ["x"]), fr).count() == 0


def test_groups(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(f"r{rng.randrange(120):03d}", rng.choice([None, f"s{rng.randrange(70)}"])) for _ in range(200)] + [(f"h{i:02d}", "hub") for i in range(60)] + [(None, "s1")]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r, s in rows:
        if r is not None:
            find(("r", r))
            if s is not None:
                parent[find(("r", r))] = find(("s", s))
    group = defaultdict(list)
    for r, _ in rows:
        if r is not None:
            group[find(("r", r))].append(r)
    want = want_groups = {r: min(g) for g in group.values() for r in g}
    df = spark.createDataFrame(rows, "r string, s string").withColumn("group_id", F.lit("clash"))
    got = linked_groups(df, "r", F.col("s"))
    assert {x["r"]: x["group_id"] for x in got.collect()} == want and got.count() == len(want)
    assert linked_groups(df.limit(0), "r", F.col("s")).count() == 0
    sizes = spark.createDataFrame([(f"g{i}", 1.0) for i in range(2000)] + [("big", 1000.0), (None, 1.0), ("none", None)], "g string, w double")
    splits = {r["g"]: (r["w"], r["split"]) for r in assign_splits(sizes, "g", "w", {"train": "0.8", "valid": "0.1", "test": "0.1"}).collect()}
    assert len(splits) == 2002 and splits["big"][1] == "train"
    for name, share in (("train", 0.8), ("valid", 0.1), ("test", 0.1)):
        assert sum(w for w, s in splits.values() if s == name) / 3000 == pytest.approx(share, abs=0.01)
    # Few groups: none is split, and each split has one if there are as many.
    for weights, want in (([1.0] * 4, [2, 1, 1]), ([9.0, 1.0, 1.0], [1, 1, 1]), ([5.0, 4.0], [1, 1, 0]), ([5.0], [1, 0, 0]), ([100.0] + [0.1] * 400, None)):
        sizes = spark.createDataFrame([(f"g{i}", w) for i, w in enumerate(weights)], "g string, w double")
        got = assign_splits(sizes, "g", "w", {"train": "0.92", "valid": "0.04", "test": "0.04"}).collect()
        count = [sum(r["split"] == n for r in got) for n in ("train", "valid", "test")]
        assert count == want if want else min(count) > 20
        if not want:
            assert all(sum(r["w"] for r in got if r["split"] == n) == pytest.approx(s * 140, abs=0.2) for n, s in (("train", 0.92), ("valid", 0.04), ("test", 0.04)))
    assert assign_splits(sizes.limit(0), "g", "w", {"train": "0.9", "test": "0.1"}).count() == 0
    # A hot entity's records meet by broadcast.
    monkeypatch.setattr(skew, "FLOOR", 10)
    monkeypatch.setattr(skew, "SHARE", 50)
    got = linked_groups(df, "r", F.col("s"))
    assert {x["r"]: x["group_id"] for x in got.collect()} == want_groups


def look(s):
    return U.normalize("NFC", "".join(C._look(ord(c)) for c in s)).strip(" \n")


def test_forms(spark):
    rng = random.Random(5)
    signs = list("abcäé éẹ̊́̈​ ﬁＡ⼈οаêế𝒜龘，á̧\n﻿ゔ가")
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(14))) for _ in range(4000)] + ["", None, "x" * 200_000]
    got = C.to_arrow(*C.seen(*C.from_arrow(pa.array(texts)))).to_pylist()
    assert got == [look(t or "") for t in texts]
    df = spark.createDataFrame([("a", "Café"), ("b", "Café "), ("c", "Cafe"), ("d", "Café"), ("e", None), ("f", ""), ("g", "​"), ("h", "Ｃafé"), ("a", "Café")], "i string, t string").withColumn("_form", F.lit("clash"))
    classes = alike_classes(df, "i", "t")
    assert {r["id"] for r in classes.collect()} == set("abdh") and len({r["class"] for r in classes.collect()}) == 1
    pairs = {tuple(r) for r in alike_pairs(classes).collect()}
    assert pairs == {("a", "b"), ("a", "h"), ("b", "d"), ("b", "h"), ("d", "h")}
    assert with_form(df, "t", "t").where("i = 'b'").first()["t"] == "Café"
    assert alike_pairs(alike_classes(df.limit(0), "i", "t")).count() == 0


def test_forms_by_hand():
    """What looks alike and what doesn't, spelled out."""
    same = [("ＡＢＣ１２３", "ABC123"), ("e\u0301", "é"), ("a\u0323\u0302", "ậ"), ("a\u00a0b\u3000c\u2009d", "a b c d"), ("z\u200be\u200dr\u2060o\ufeff", "zero"), ("soft\u00adhyphen", "softhyphen"), (" x\u3000", "x")]
    same += [("АВС", "ABC"), ("сору", "copy"), ("ΑΒΕ", "ABE"), ("Ꮯᴏ"[0], "C"), ("ꓮꓐ", "AB"), ("օ", "o"), ("ﬁn", "fin"), ("Ⅷ", "VIII"), ("ｶﾞ", "ガ"), ("！？", "!?"), ("⼈", "人"), ("한", "한")]
    other = [("é", "e"), ("A", "a"), ("a  b", "a b"), ("x²", "x2"), ("１", "2"), ("ß", "ss"), ("𝐀", "A"), ("，", "。"), ("ab", "a b"), ("ё", "e")]
    form = lambda x: C.to_arrow(*C.seen(*C.from_arrow(pa.array([x])))).to_pylist()[0]
    assert [x for x in same if form(x[0]) != form(x[1])] == [] and [x for x in other if form(x[0]) == form(x[1])] == []


def test_letters():
    texts = ["Süße Straße! ＡＢ 12", "SÜSSE", None, "", "é-É", "…"]
    assert C.to_arrow(*C.letters(*C.from_arrow(pa.array(texts)))).to_pylist() == ["süssestrasseab12", "süsse", "", "", "éé", ""]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, n, letters):
    x = list(text)
    for _ in range(n):
        k, way = rng.randrange(len(x)), rng.randrange(3)
        if way == 0:
            x[k] = rng.choice(letters)
        elif way == 1:
            x.insert(k, rng.choice(letters))
        elif len(x) > 1:
            del x[k]
    return "".join(x)


@pytest.mark.parametrize("letters", ["abcdefghij", "一二三四五六七八九十百千万亿东西南北上下左右"])
def test_overlaps(spark, letters):
    rng = random.Random(6)
    left = [f"{''.join(rng.choice(letters) for _ in range(rng.choice([9, 10, 11, 18, 30, 45, 77])))}" for _ in range(60)]
    right = [edited(rng, rng.choice(left), rng.randrange(9), letters) for _ in range(80)] + left[:5]
    rows = [(f"l{i}", t, 1) for i, t in enumerate(left)] + [(f"r{i}", t + "!", 2) for i, t in enumerate(right)] + [("n", None, 1), ("e", "", 2), ("x", left[7], 3), (None, left[7], 2), ("l0", left[0], 1)]
    df = spark.createDataFrame(rows, "i string, t string, s int").withColumn("_c", F.lit("clash"))
    want = {(f"l{i}", f"r{j}") for i, a in enumerate(left) for j, b in enumerate(right) if min(len(a), len(b)) >= 10 and distance(a, b) <= max(len(a), len(b)) // 10}
    members, near = overlaps(df, "i", "t", "s")
    assert {(r["left_id"], r["right_id"]) for r in record_pairs(members, near).collect()} == want
    members, near = overlaps(df.limit(0), "i", "t", "s")
    assert near.count() == 0 and record_pairs(members, near).count() == 0
    members, per = coverage(df, "i", "t", "s")
    per = {(r["id"], r["side"]): r for r in members.join(per, ["class", "side"]).collect()}
    assert {i for i, s in per if s == 1} == {a for a, _ in want} and {i for i, s in per if s == 2} == {b for _, b in want}
    for (i, s), r in per.items():
        own = (left if s == 1 else right)[int(i[1:])]
        others = [(right if s == 1 else left)[int((p[1] if s == 1 else p[0])[1:])] for p in want if p[s - 1] == i]
        assert r["partners"] == len(others)
        inside = set()
        for x in others:
            most = distance(own, x)
            inside |= {k + j for shift in range(-most, most + 1) for k in range(len(own) - 4) if 0 <= k + shift <= len(x) - 5 and own[k : k + 5] == x[k + shift : k + shift + 5] for j in range(5)}
        assert r["covered"] == pytest.approx(len(inside) / len(own))


def test_overlaps_hot_beginnings(spark, monkeypatch):
    """Long texts, texts of one template, and beginnings split over a grid of tasks, against brute force."""
    monkeypatch.setattr(O, "HOT", 3)
    monkeypatch.setattr(O, "HOT_SHARE", 10**9)
    rng = random.Random(16)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(3, 8))) for _ in range(12)]
    texts = ["thank you for watching this " + " ".join(rng.choice(words) for _ in range(rng.choice([4, 8, 60]))) for _ in range(90)] + ["\U00020001\U00020002字" * 8]
    rows = [(f"{s}{i}", x if s == 1 else edited(rng, x, rng.randrange(len(x) // 8), "abcxyz"), s) for i, x in enumerate(texts) for s in (1, 2)]
    plain = {i: x.replace(" ", "") for i, x, _ in rows}
    want = {(a, b) for a in plain for b in plain if a[0] == "1" and b[0] == "2" and abs(len(plain[a]) - len(plain[b])) <= 40 and distance(plain[a], plain[b]) <= max(len(plain[a]), len(plain[b])) // 10}
    got = record_pairs(*overlaps(spark.createDataFrame(rows, "i string, t string, s int"), "i", "t", "s")).collect()
    assert {tuple(r) for r in got} == want and len(want) > 40


def test_shared_keys(spark):
    rows = [("a", "x", 1), ("b", "x", 2), ("b", "x", 2), ("c", "y", 1), ("d", "y", 1), ("e", "z", 1), ("e", "z", 2), (None, "x", 1), ("f", None, 2), ("g", "x", 3)]
    got = {tuple(r) for r in shared_keys(spark.createDataFrame(rows, "i string, k string, s int"), "i", F.col("k"), "s").collect()}
    assert got == {("x", 1, "a"), ("x", 2, "b")}


def test_leaks_shorter_quotations(spark):
    """A quotation below the least length is no case, however few edits would make up for what is missing."""
    rng = random.Random(18)
    zh, other = ([chr(0x4E00 + 37 * i + k) for i in range(400)] for k in (0, 1))
    items = [(i, "".join(rng.choice(zh) for _ in range(90)), 40) for i in range(40)]
    docs = []
    for i, text, _ in items:
        n = 36 + i % 8
        a = rng.randrange(90 - n)
        docs.append((i, "".join(rng.choice(other) for _ in range(60)) + text[a : a + n] + "".join(rng.choice(other) for _ in range(60))))
    df, it = spark.createDataFrame(docs, "d long, t string"), spark.createDataFrame(items, "i long, t string, n int")
    got = {tuple(r) for r in K.leaked(df, "d", "t", it, "i", "t", F.col("n")).collect()}
    assert got == {(i, i) for i in range(40) if 36 + i % 8 >= 40}


def test_leaks_recall_and_precision(spark, monkeypatch):
    rng = random.Random(7)
    zh = [chr(0x4E00 + 37 * i) for i in range(400)]
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 9))) for _ in range(300)]
    items = [(i, "".join(rng.choice(zh) for _ in range(90)), 40) for i in range(20)] + [(100 + i, " ".join(rng.choice(words) for _ in range(45)), 120) for i in range(20)]
    docs, want, maybe = [], set(), set()
    for d in range(400):
        i, text, least = rng.choice(items)
        plain = text.replace(" ", "")
        a = rng.randrange(len(plain) - least + 1)
        run = plain[a : a + least]
        around = ["".join(rng.choice(zh) for _ in range(80)) if least == 40 else "".join(rng.choice(words) for _ in range(40)) for _ in range(2)]
        short = d % 4 == 3
        x = edited(rng, run, least // 10, zh if least == 40 else "abcdefgh") if not short else run[: least // 2]
        docs.append((d, f"{around[0]}\n{x.upper()}, {around[1]}"))
        if not short:
            maybe.add((d, i))
            # Where an edit took an end of the run, what is left is a shorter quotation and no case.
            if (x[0], x[-1]) == (run[0], run[-1]):
                want.add((d, i))
    docs += [(900, None), (901, ""), (902, "x" * 100_000), (docs[0][0], docs[0][1])]
    df = spark.createDataFrame(docs, "d long, t string").withColumn("_i", F.lit("clash"))
    it = spark.createDataFrame([*items, (500, None, 40), (501, "short", 40)], "i long, t string, n int")
    got = {tuple(r) for r in K.leaked(df, "d", "t", it, "i", "t", F.col("n")).collect()}
    assert got <= maybe
    got &= want
    # Recall of either script by itself, at exactly a tenth of edits and exactly the least length.
    for script in (lambda i: i < 100, lambda i: i >= 100):
        assert sum(script(i) for _, i in got) >= 0.95 * sum(script(i) for _, i in want)
    monkeypatch.setattr(K, "BLOCK_LETTERS", 700)
    assert {tuple(r) for r in K.leaked(df, "d", "t", it, "i", "t", F.col("n")).collect()} & want == got
    assert K.leaked(df.limit(0), "d", "t", it, "i", "t", F.col("n")).count() == 0
    assert K.leaked(df, "d", "t", it.limit(0), "i", "t", F.col("n")).count() == 0


def test_packing(spark):
    rng = random.Random(8)
    sizes = np.array([rng.randrange(1, 101) for _ in range(3000)])
    container, offset = sum_of_squares(sizes, 100)
    fill = np.bincount(container, sizes)
    assert fill.max() <= 100 and len(fill) <= 1.04 * sizes.sum() / 100
    for c in range(20):
        at = np.flatnonzero(container == c)
        assert sorted(offset[at]) == list(np.r_[0, np.cumsum(sizes[at][np.argsort(offset[at])])[:-1]])
    rows = [(i, rng.choice([1, 7, 40, 99, 100, 250, 0, None, -3])) for i in range(400)] + [(5, 40), (5, 40), (None, 9)]
    df = spark.createDataFrame(rows, "i int, n int").withColumn("piece", F.lit("clash"))
    got = pack(df, "i", "n", 100, shard=50).collect()
    per, items = defaultdict(list), defaultdict(int)
    for r in got:
        per[r["container"]].append((r["offset"], r["length"]))
        items[r["i"]] += r["length"]
    want = defaultdict(int)
    for i, n in rows:
        if i is not None and n and n > 0:
            want[i] += n
    assert items == want
    for x in per.values():
        end = 0
        for o, n in sorted(x):
            assert o == end
            end += n
        assert end <= 100
    assert all(r["length"] == 100 for r in got if r["piece"] == 0 and r["i"] in {i for i, n in rows if n == 250})
    again = pack(df.repartition(7), "i", "n", 100, shard=50).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    assert pack(df.limit(0), "i", "n", 100).count() == 0
    counts = token_counts(spark.createDataFrame([(1, "hello world"), (2, None), (3, "")], "i int, t string"), "i", "t").collect()
    assert [(r["i"], r["n_tokens"] > 0) for r in counts] == [(1, True)]


def test_garbled(spark):
    clean = ["Die Bücher für Jürgen kosten 5 € – früh gelöscht.", "Élève déjà à la fenêtre, forêt brûlée.", "柳河诊所的木头话筒比槐荫花房的更响亮", "司机说周一收工前要去松坪茶馆看会响的渔网", "19 °C and §4 ½", "Привет, мир", "pão irmã", "«É» “quoted” É"]
    rows, bad = [(i, t) for i, t in enumerate(clean)], {}
    n = 100
    for t in clean[:5]:
        for chain in ("utf_8>cp1252", "utf_8>cp1251", "utf_8>mac_roman", "utf_8>cp437", "utf_8>gbk", "utf_8>cp932", "gbk>cp1252", "utf_8>cp1252,utf_8>cp1252", "cp1252>utf_8"):
            x = G.garble(t, chain)
            pairs = [c for c in t if ord(c) > 0x3000]
            if x is None or (chain == "gbk>cp1252" and not pairs):
                continue
            rows.append((n, x))
            bad[n] = (t, chain)
            n += 1
    rows += [(900, None), (901, ""), (902, "a" * 50_000)]
    df = spark.createDataFrame(rows, "d long, t string").withColumn("word", F.lit("clash"))
    tokens = G.garbled_tokens(df, "d", "t")
    found = {r["d"] for r in tokens.collect()}
    assert not found - set(bad)
    assert len(found) >= 0.9 * len(bad), [bad[d] for d in set(bad) - found]
    back = {r["d"]: r["restored"] for r in G.restored(df, "d", "t", tokens).collect()}
    whole = [d for d, (t, c) in bad.items() if c in ("utf_8>cp1252", "utf_8>cp1252,utf_8>cp1252", "gbk>cp1252") and d in back]
    assert sum(back[d] == bad[d][0] for d in whole) >= 0.8 * len(whole), [(bad[d], back[d]) for d in whole if back[d] != bad[d][0]]
    assert G.garbled_tokens(df.limit(0), "d", "t").count() == 0


@pytest.mark.parametrize("size, where", [(60, (21, 40)), (50, (20, 30)), (180, (80, 100))])
def test_leaks_longer_runs(spark, size, where):
    """Runs longer than the least with a tenth of edits close together: no part of the least length has but a tenth."""
    rng = random.Random(17)
    zh = [chr(0x4E00 + 37 * i) for i in range(400)]
    letters, least = (zh, 40) if size < 80 else ("abcdefghijklmnopqrstuvwxyz", 120)
    items = [(i, "".join(rng.choice(letters) for _ in range(size)), least) for i in range(40)]
    docs = []
    for i, text, _ in items:
        x, spare = list(text), [c for c in letters if c not in text] or ["7"]
        for k in rng.sample(range(*where), size // 10 + i % 2):
            x[k] = rng.choice(spare)
        around = ["".join(rng.choice(letters) for _ in range(150)) for _ in range(2)]
        docs.append((i, around[0] + "".join(x) + around[1]))
    df, it = spark.createDataFrame(docs, "d long, t string"), spark.createDataFrame(items, "i long, t string, n int")
    got = {tuple(r) for r in K.leaked(df, "d", "t", it, "i", "t", F.col("n")).collect()}
    want = {(i, i) for i, *_ in items if i % 2 == 0}
    assert len(got & want) >= 0.95 * len(want)
    # One edit more is no case, but for the few that the letters around bring back.
    assert len(got - want) <= 2


def test_garbled_latin_1(spark):
    """Texts decoded as Latin-1 whose bytes fall in 80 to 9F, where cp1252 has other signs."""
    clean = ["Er sagte “gut” – und l’heure kam", "Straße und Übung", "柳河诊所的木头话筒更响亮", "这些样本从皯亹开始"]
    bad = {}
    for t in clean[:3]:
        for chain in ("utf_8>latin_1", "utf_8>latin_1,utf_8>latin_1", "utf_8>latin_1,utf_8>latin_1,utf_8>latin_1"):
            bad[len(bad) + 100] = (t, G.garble(t, chain))
    bad[200] = ("“gut”", G.garble("“gut”", "utf_8>latin_1"))
    bad[201] = (clean[3], G.garble(clean[3], "gbk>latin_1"))
    rows = [*enumerate(clean), *((d, x) for d, (_, x) in bad.items())]
    df = spark.createDataFrame(rows, "d long, t string")
    tokens = G.garbled_tokens(df, "d", "t")
    assert {r["d"] for r in tokens.collect()} == set(bad)
    assert {r["d"]: r["restored"] for r in G.restored(df, "d", "t", tokens).collect()} == {d: t for d, (t, _) in bad.items()}


def test_garbled_clean_words_beside_suspects(spark):
    """A structurally possible stretch bars neither its text nor itself from the clean words unless it is a garbled form."""
    clean = ["网格提案和木槌话筒", "Привет, дорогой", "Die Grüße – GrÃ¼n", "grün"]
    bad = [G.garble(t, c) for t, c in (("网格", "utf_8>cp1252"), ("木槌", "utf_8>gbk"), ("提案", "gbk>cp1252"), ("ж", "utf_8>cp437"), ("р", "utf_8>mac_roman"), ("Füße", "utf_8>cp1252"), ("Grüße", "utf_8>gbk"))]
    assert None not in bad
    rows = [*enumerate(clean), (9, "ж")] + [(100 + i, t) for i, t in enumerate(bad)]
    df = spark.createDataFrame(rows, "d long, t string")
    words = {r["_w"] for r in G.clean_words(df.select(F.col("t").alias("_t"))).collect()}
    assert {"网", "网格", "木槌", "р", "о", "ü", "ß", "Grüße", "grün"} <= words
    tokens = G.garbled_tokens(df, "d", "t").collect()
    assert {r["d"] for r in tokens} == {2, *range(100, 107)}
    # A garbled word is no original, though it is among the words.
    assert not {"GrÃ¼n", "FÃ¼ÃŸe"} & {r["word"] for r in tokens}


def test_report_counts_shared_recordings(spark, tmp_path):
    from voxloom.llm.queries import p1_report

    sides = [("u1", "a", "train", "other words here"), ("u2", "b", "test", None), ("u3", "c", "valid", "the same text twice"), ("u3", "d", "train", "the same text twice"), ("u4", "e", "valid", "The same text, twice")]
    spark.createDataFrame(sides, "utt_id string, source_audio_id string, split string, text string").write.parquet(str(tmp_path / "manifests.parquet"))
    spark.createDataFrame([("a", "F0"), ("b", " f0 "), ("c", None)], "audio_id string, audio_hash string").write.parquet(str(tmp_path / "ingest.parquet"))
    got = {(r["split"], r["source_audio_id"], r["kind"], r["records"], r["pairs"], r["covered"]) for r in p1_report(spark, str(tmp_path)).collect()}
    assert got == {("train", "a", "recording", 1, 1, 1.0), ("test", "b", "recording", 1, 1, 1.0), ("train", "d", "text", 1, 1, 1.0), ("valid", "e", "text", 1, 1, 1.0)}


@pytest.mark.parametrize("chain", ["utf_8>gbk", "utf_8>cp932"])
def test_garbled_lone_letters_and_long_words(spark, chain):
    """A word of one letter is known beside its neighbour; words of any length are known; ideographs that belong are no case."""
    word = "Donaudampfschifffahrtsgesellschaftskapitänsmütze"
    clean = [(0, "il va à la gare"), (1, f"die {word}"), (2, "眉毛和枚"), (3, "the 脿 sign")]
    bad = [(10, "il va à la gare"), (11, word)]
    df = spark.createDataFrame(clean + [(d, G.garble(t, chain)) for d, t in bad], "d long, t string")
    tokens = G.garbled_tokens(df, "d", "t")
    assert {r["d"] for r in tokens.collect()} == {10, 11}
    assert {r["d"]: r["restored"] for r in G.restored(df, "d", "t", tokens).collect()} == dict(bad)


def test_garbled_all_encodings(spark):
    """Chains between any of the encodings; a sentence that names the sign for lost signs is no case, nor are rare letters."""
    clean = [(0, "москва слезам не верит никогда"), (1, "Die größten Übungen für Jürgen"), (2, "η γάτα κοιμάται ήσυχα"), (3, "柳河诊所的木头话筒比槐荫花房的更响亮"), (4, "The sign � stands for what was lost"), (5, "СТАНЦИЯ МЕТРО, Рёмер, Dvořák, 19 °C"), (6, "Grundstücksverkehrsgenehmigungszuständigkeitsübertragungsverordnung")]
    bad = [(0, "cp1251>cp1252"), (0, "koi8_r>cp1251"), (0, "cp1251>koi8_r"), (0, "utf_8>iso8859_5"), (0, "utf_8>cp1251"), (0, "utf_8>cp866"), (2, "utf_8>cp1253"), (1, "utf_8>cp1253"), (1, "cp1252>cp437"), (1, "mac_roman>cp1252"), (1, "cp1252>utf_8"), (3, "utf_8>iso8859_5"), (3, "utf_8>koi8_r"), (3, "big5>cp1252"), (3, "gbk>cp1251"), (3, "gbk>utf_8")]
    bad += [(6, f"utf_8>{d}") for d in G.DOUBLE]
    rows = clean * 3 + [(100 + i, G.garble(dict(clean)[d], c)) for i, (d, c) in enumerate(bad)]
    assert all(t for _, t in rows if t is not None)
    df = spark.createDataFrame([r for r in rows if r[1] is not None], "d long, t string")
    want = {d for d, t in rows if d >= 100 and t is not None}
    assert {r["d"] for r in G.garbled_records(df, "d", "t").collect()} == want
    tokens = G.garbled_tokens(df, "d", "t")
    back = {r["d"]: r["restored"] for r in G.restored(df, "d", "t", tokens).collect()}
    assert set(back) == want
    whole = [d for d in want if (c := bad[d - 100][1])[:6] == "cp1251" or c in ("utf_8>iso8859_5", "cp1252>cp437")]
    assert all(back[d] == dict(clean)[bad[d - 100][0]] for d in whole), [back[d] for d in whole]
    assert G.garbled_records(df.limit(0), "d", "t").count() == 0


def test_garbled_letters_of_other_alphabets(spark):
    """Words that stand nowhere else: their letters tell, but not where these are ordinary letters of the alphabet."""
    clean = [(0, "ï ’ ‘ é л и"), (1, "«СССР» Рёв, Сё Рё, №"), (2, "Ρ» αΈ")]
    bad = [G.garble("‘Again, please’, the naïve", c) for c in ("utf_8>cp1251", "utf_8>koi8_r", "utf_8>iso8859_5", "utf_8>cp1253")]
    df = spark.createDataFrame([*clean, *((10 + i, t) for i, t in enumerate(bad))], "d long, t string")
    assert {r["d"] for r in G.garbled_records(df, "d", "t").collect()} == {10, 11, 12, 13}
    back = {r["d"]: r["restored"] for r in G.restored(df, "d", "t", G.garbled_tokens(df, "d", "t")).collect()}
    assert back == {10 + i: "‘Again, please’, the naïve" for i in range(4)}


def test_garbled_chains_that_undo_one_another(spark):
    """A clean stretch is no case for a garbled text whose signs would give it: it stands in more texts."""
    word = b"\xe9\xb3\xb7\xec\xb2\xb9".decode("gbk")
    rows = [(i, f"木{word}{'很好' * i}") for i in range(4)] + [(9, word.encode("gbk").decode("utf_8"))]
    assert {r["d"] for r in G.garbled_records(spark.createDataFrame(rows, "d long, t string"), "d", "t").collect()} <= {9}
