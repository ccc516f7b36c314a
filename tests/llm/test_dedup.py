"""Exact, near and passage deduplication against brute force."""

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ventilake.llm import near_dedup as nd
from ventilake.llm import paragraph_dedup as pd8
from ventilake.llm.common import checkpointed, shared_folder
from ventilake.llm.components import connected_components
from ventilake.llm.decontaminate import drop_contaminated
from ventilake.llm.exact_dedup import drop_exact_copies, exact_dedup

DOCS = "doc_id long, text string"


def _words(rnd, n, vocabulary=4000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


# -- exact ------------------------------------------------------------------------


def _brute_exact(rows):
    out = []
    norm = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    for i, t in rows:
        same = [(-len(u or ""), j is None, j) for j, u in rows if norm(u) == norm(t)]
        keep = min(same, key=lambda x: (x[0], x[1], x[2] or 0))[2]
        out.append((i, keep, len(same), i == keep))
    return sorted(out, key=str)


ROWS = [
    (1, "a b"), (2, "ab "), (3, "a  b"), (4, None), (5, ""), (6, " \t\n"), (7, "é x"), (7, "é x"), (8, "a b"),
    (None, "ab   "), (9, "x" * 50_000), (10, "x " * 50_000), (-3, "ab  "), (None, "alone"),
]


@pytest.mark.parametrize("digest", [None, lambda c: F.lit("same"), lambda c: F.substring(c, 1, 1)])
def test_exact_equals_brute_force(spark, digest):
    df = spark.createDataFrame(ROWS, DOCS).withColumns({"digest": F.lit(1), "norm": F.lit("n"), "salt": F.lit(2)})
    out = exact_dedup(df, salts=3, **({"digest": digest} if digest else {}))
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in out.collect()), key=str)
    assert got == _brute_exact(ROWS)


def test_exact_empty_table_and_filter(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup(empty).collect() == []
    df = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], DOCS).withColumn("lang", F.lit("en"))
    kept = drop_exact_copies(df)
    assert kept.columns == ["doc_id", "text", "lang"] and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


# -- near --------------------------------------------------------------------------


def _set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def _brute_components(rows, threshold):
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [_set(t) for _, t in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    of = {}
    for k, (i, _) in enumerate(rows):
        of.setdefault(root(k), []).append(i)
    return sorted((i, len(sets[k]), min(of[root(k)])) for k, (i, _) in enumerate(rows))


def _edited(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rnd.randrange(len(words))
        words[k] = f"e{rnd.randrange(10**6)}"
    return words


def test_near_equals_brute_force(spark):
    rnd = random.Random(4)
    rows, n = [], 0
    for group in range(6):
        base = _words(rnd, rnd.choice([6, 40, 150]))
        for _ in range(rnd.choice([2, 12, 45])):
            rows.append((n, " ".join(_edited(rnd, base, rnd.randrange(5)))))
            n += 1
    common = " ".join(_words(rnd, 12))
    rows += [(n + i, common + " " + " ".join(_words(rnd, 30))) for i in range(40)]
    rows += [(900, None), (901, ""), (902, " \n"), (903, "Short text"), (904, "short  TEXT"), (905, "a b c d e"), (906, "a " * 30_000)]
    out = nd.near_dedup(spark.createDataFrame(rows, DOCS).withColumn("bands", F.lit(1)))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out.collect())
    assert got == _brute_components(rows, 85)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out.collect())


def test_near_chain_of_links_is_followed(spark):
    """Documents linked only through others, in a bucket whose hub is linked with few of them."""
    rnd = random.Random(7)
    words = _words(rnd, 120, 10**6)
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = words[2:] + [f"n{rnd.randrange(10**6)}" for _ in range(2)]
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in nd.near_dedup(spark.createDataFrame(rows, DOCS)).collect())
    assert got == _brute_components(rows, 85)
    assert {c for _, _, c in got} == {0}


def test_near_ids_repeated_null_and_empty(spark):
    text, other = " ".join(map(str, range(30))), " ".join(map(str, range(50, 90)))
    rows = [(1, text), (1, text), (1, other), (2, other), (None, text), (None, "quite another text of seven words")]
    out = nd.near_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in out), key=str) == sorted(
        [(1, 1), (1, 1), (1, 1), (2, 1), (None, 1), (None, None)], key=str
    )
    assert nd.near_dedup(spark.createDataFrame([], DOCS)).collect() == []
    kept = nd.drop_near_copies(spark.createDataFrame(rows, DOCS).withColumn("lang", F.lit("x")))
    assert kept.columns == ["doc_id", "text", "lang"]


def test_min_max_estimates_jaccard():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    a, b = np.unique(pool[:2000]), np.unique(pool[1000:])
    truth = 1000 / 3000
    factors = nd.multipliers(400)
    (la, ha), (lb, hb) = nd.min_max(a, factors), nd.min_max(b, factors)
    both = ((la == lb).mean() + (ha == hb).mean()) / 2
    assert abs(both - truth) < 0.06
    values = np.concatenate(nd.min_max(a, nd.multipliers(nd.PERMS)))
    assert len(nd.band_keys(values, nd.ROWS)) == 2 * nd.PERMS // nd.ROWS


def test_sketches_tell_linked_pairs_from_others(spark):
    rng = np.random.default_rng(3)
    factors, rows = nd.multipliers(nd.PERMS), []
    for k in range(300):
        pool = rng.integers(0, 2**63, 400, dtype=np.uint64)
        shift = 30 if k % 2 else 150  # Jaccard 0.86 and 0.45
        pair = [nd.sketch(np.concatenate(nd.min_max(np.unique(x), factors))).tolist() for x in (pool[: 400 - shift], pool[shift:])]
        rows.append((k, *pair))
    df = spark.createDataFrame(rows, "k long, a array<long>, b array<long>")
    n = 2 * nd.PERMS
    passed = df.where(nd._agreeing(F.col("a"), F.col("b"), len(rows[0][1]), n, 85)).collect()
    assert sum(r["k"] % 2 for r in passed) == 150 and sum(r["k"] % 2 == 0 for r in passed) == 0


def test_components_of_random_links(spark):
    rnd = random.Random(2)
    links = [(rnd.randint(-99, 99), rnd.randint(-99, 99)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(40)]
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()}
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert got == {v: root(v) for v in parent}


# -- passages ------------------------------------------------------------------------


def test_repeated_passages_are_found_inside_lines(spark):
    rnd = random.Random(11)
    passage = _words(rnd, 55)
    edited = list(passage)
    edited[3] = "changed"
    line = " ".join(_words(rnd, 12))
    rows = []
    for i in range(60):
        w = _words(rnd, 150)
        if i < 8:
            at = rnd.randrange(150)
            w = w[:at] + (edited if i == 7 else passage) + w[at:]
        rows.append((i, " ".join(w) + "\n" + line))  # a common short line is no repeat
    rows += [(100, " ".join(_words(rnd, 30) * 9)), (101, None), (102, ""), (103, "few words"), (None, " ".join(passage))]
    out = pd8.repeated_passages(spark.createDataFrame(rows, DOCS).withColumn("start", F.lit(0))).collect()
    assert {r["doc_id"] for r in out} == set(range(8))
    texts = {i: (t or "").split() for i, t in rows}
    for r in out:
        assert r["end"] - r["start"] == pd8.WORDS_PER_UNIT and r["n_docs"] >= 2
        assert any(texts[r["doc_id"]][r["start"] : r["end"]][j : j + 18] == p[k : k + 18] for p in (passage,) for j in range(7) for k in range(38)) or r["doc_id"] == 7
    assert {r["doc_id"] for r in out if not r["removed"]} == {0}


def test_every_shared_run_has_a_common_start():
    rnd = random.Random(5)
    run = _words(rnd, pd8.RUN)
    for _ in range(60):
        found = []
        for _ in range(2):
            before = _words(rnd, rnd.randrange(60))
            h = nd.shingle_hashes([w.encode() for w in before + run + _words(rnd, rnd.randrange(60))])
            starts = pd8.starts_of(h, pd8.WORDS_PER_UNIT, pd8.RUN - pd8.WORDS_PER_UNIT + 1)
            found.append({int(s) - len(before) for s in starts})
        common = {s for s in found[0] & found[1] if 0 <= s <= pd8.RUN - pd8.WORDS_PER_UNIT}
        assert common


def test_passages_of_an_empty_table_and_of_one_document(spark):
    assert pd8.repeated_passages(spark.createDataFrame([], DOCS)).collect() == []
    same = " ".join(f"a{i}" for i in range(80))
    assert pd8.repeated_passages(spark.createDataFrame([(1, same + " b " + same)], DOCS)).collect() == []


def test_whole_paragraphs_repeat_short_long_and_edited(spark):
    rnd = random.Random(21)
    own = lambda n: " ".join(_words(rnd, n, 10**7))
    line, edited, block = own(8), own(60).split(), [own(9), own(9)]
    other = list(edited)
    other[30] = "changed"  # 51 of 61 shingles: Jaccard 0.84
    rows = [
        (1, "\n".join([own(30), line, own(40)])), (2, "\n".join([line, own(50)])), (3, "two words"), (4, "Two  words\n"),
        (5, own(40) + "\n" + " ".join(edited)), (6, " ".join(other) + "\n" + own(35)),
        (7, own(40) + "\n\n" + "\n".join(block)), (8, " ".join(block[0].split()[:5]) + "\n" + " ".join(block[0].split()[5:]) + "\n" + block[1] + "\n\n" + own(33)),
        (9, own(70)), (10, own(10) + "\n" + own(10)), (11, None), (12, " \n\n"), (None, line),
    ]
    got = {tuple(r) for r in pd8.repeated_paragraphs(spark.createDataFrame(rows, DOCS)).select("doc_id", "start", "end", "n_docs", "removed").collect()}
    wanted = {
        (1, 30, 38, 2, False), (2, 0, 8, 2, True), (3, 0, 2, 2, False), (4, 0, 2, 2, True),
        (5, 40, 100, 2, False), (6, 0, 60, 2, True), (7, 40, 58, 2, False), (8, 0, 18, 2, True),
    }
    assert wanted <= got
    assert {r[0] for r in got} == set(range(1, 9))


def test_passages_are_reported_with_the_whole_shared_run(spark):
    rnd = random.Random(22)
    own = lambda n: _words(rnd, n, 10**7)
    rows, at, passages = [], {}, [own(51), own(90), own(400)]
    for i in range(24):
        before, p = own(rnd.randrange(20, 90)), passages[i % 3]
        rows.append((i, " ".join(before + p + own(60))))
        at[i] = (len(before), len(before) + len(p))
    got = pd8.repeated_paragraphs(spark.createDataFrame(rows, DOCS)).collect()
    for i, (low, high) in at.items():
        assert i > 2 or not any(r["removed"] for r in got if r["doc_id"] == i)
        spans = [(r["start"], r["end"]) for r in got if r["doc_id"] == i and r["removed"] == (i > 2)]
        # all words of the run in one span; a window at its edge may hold a word or two more (Jaccard 0.8)
        assert any(a <= low and high <= b for a, b in spans)
        assert min(a for a, _ in spans) >= low - 3 and max(b for _, b in spans) <= high + 3


def test_a_run_longer_than_what_is_read_at_once_is_followed(spark):
    words = [f"a{i}" for i in range(700)]
    rows = spark.createDataFrame([(1, "x " + " ".join(words)), (2, "y z " + " ".join(words) + " end")], DOCS)
    one = spark.createDataFrame([(2, 302, 7, (1, 301, 24))], "doc_id long, start int, passage_id long, like struct<doc_id:long,start:int,length:int>")
    got = pd8._runs(rows, one, 24, 28).collect()
    assert [(r["low"], r["high"]) for r in got] == [(2, 702)]


def test_runs_of_any_length_end_where_the_words_differ(spark):
    own = lambda i, n: [f"d{i}w{k}" for k in range(n)]
    rows, windows, expected = [], [], {}
    for i, n in enumerate([24, 25, 51, 52, 53, 79, 80, 81, 107, 136, 1000, 1816, 1817, 5000]):
        shared = [f"s{i}x{k}" for k in range(n)]
        before, after = own(2 * i, 3 + i), own(2 * i + 1, i % 3)
        rows += [(2 * i, " ".join(shared)), (2 * i + 1, " ".join(before + shared + after))]
        for at in {0, (n - 24) // 2, n - 24}:
            windows.append((2 * i + 1, len(before) + at, at, (2 * i, at, 24)))
            expected[2 * i + 1, len(before) + at] = (len(before), len(before) + n)
    removed = spark.createDataFrame(windows, "doc_id long, start int, passage_id long, like struct<doc_id:long,start:int,length:int>")
    got = pd8._runs(spark.createDataFrame(rows + rows[:3], DOCS), removed, 24, 28).collect()
    assert {(r["doc_id"], r["start"]): (r["low"], r["high"]) for r in got} == expected


def test_runs_that_go_over_into_each_other_are_followed_once(spark, monkeypatch):
    shared = [f"s{k}" for k in range(420)]
    other = list(shared)
    other[25 + 26 * 7] = "else"  # between the windows at 182 and 208
    inside = list(shared)
    inside[26 * 7 + 3] = "else"  # in the window at 182, which is taken for alike
    rows = [(0, " ".join(shared)), (1, "x " + " ".join(shared) + " y"), (2, " ".join(other)), (3, " ".join(inside))]
    windows = [(d, at + (d == 1), at, (0, at, 24)) for d in (1, 2, 3) for at in range(0, 380, 26)]
    asked, further = [], pd8._further

    def counted(rows, open_, *args):
        asked.append(open_.where("side < 2").count())
        return further(rows, open_, *args)

    monkeypatch.setattr(pd8, "_further", counted)
    removed = spark.createDataFrame(windows, "doc_id long, start int, passage_id long, like struct<doc_id:long,start:int,length:int>")
    got = {(r["doc_id"], r["start"]): (r["low"], r["high"]) for r in pd8._runs(spark.createDataFrame(rows, DOCS), removed, 24, 28).collect()}
    assert len(got) == len(windows)
    for (doc_id, start), span in got.items():
        if doc_id == 1:
            assert span == (1, 421)
        elif doc_id == 2:
            assert span == ((0, 207) if start <= 182 else (208, 420))
        else:
            # the window itself goes on as far as the words beside it are alike
            assert span == ((0, 185) if start < 182 else (0, 420) if start == 182 else (186, 420))
    # both sides of 45 windows at first, then the ends of few stretches only
    assert asked[0] == 90 and all(n <= 6 for n in asked[1:])


def test_texts_cut_together_have_the_units_they_have_alone():
    rnd = random.Random(61)
    texts = ["", " \n", "a", "a b c d", "a b c d e", "a " * 200, "x y\n\nz w\n\n"]
    for n in range(120):
        seps = rnd.choice([[" "], [" "] * 9 + ["\n", "\n\n"], [" ", "\n"]])
        vocabulary = rnd.choice([1, 2, 5, 40, 10**6])
        texts.append("".join(f"w{rnd.randrange(vocabulary)}{rnd.choice(seps)}" for _ in range(n)))
    factors = nd.multipliers(30)
    together = pd8._cut(texts, 24, 51, 10, factors)
    for text, (many, at, names, sizes, bands) in zip(texts, together, strict=True):
        assert pd8._cut([text], 24, 51, 10, factors) == [(many, at, names, sizes, bands)]
        words, spans = pd8.paragraphs(text)
        at = np.frombuffer(at, dtype=np.int32).reshape(-1, 2).tolist()
        starts = pd8.starts_of(nd.shingle_hashes(words), 24, 28).tolist()
        assert many == len(spans) and [tuple(p) for p in at] == spans + [(a, 24) for a in starts]
        sets = [nd.shingle_set(" ".join(w.decode() for w in words[a : a + n])) for a, n in at]
        assert np.frombuffer(sizes, dtype=np.int32).tolist() == [len(s) for s in sets]
        sums = [[(pd8._mixed(s, f).sum(dtype=np.uint64) + np.uint64(len(s))).view(np.int64) for f in pd8._NAMES] for s in sets]
        assert np.frombuffer(names, dtype=np.int64).reshape(-1, 2).tolist() == sums
        lowest = [(pd8._folded(s) * factors[:, None]).min(axis=1) for s in sets[:many] if len(s) >= pd8.LEAST]
        keys = pd8._keys(np.stack(lowest, axis=1)).tobytes() if lowest else b""
        assert bands == keys


def test_long_texts_are_cut_by_themselves(monkeypatch):
    monkeypatch.setattr(pd8, "_TOGETHER", 10)
    assert list(pd8._portions(["a" * 4, "b" * 6, "c", "d" * 50, "", "e"])) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(pd8._portions([])) == []


def test_names_of_stretches_and_the_lengths_asked_for():
    rnd = random.Random(41)
    words = [w.encode() for w in _words(rnd, 60, 3)]
    text = pd8._Stretches(words)
    spans = [(a, b) for a in range(61) for b in range(a, 61)]
    names = text.names(np.array([a for a, _ in spans]), np.array([b for _, b in spans]))
    seen = {}
    for (a, b), name in zip(spans, names.tolist(), strict=True):
        assert seen.setdefault(name, words[a:b]) == words[a:b]
    assert len(seen) == len({tuple(words[a:b]) for a, b in spans})
    assert pd8._Stretches([]).names(np.array([0]), np.array([0])).tolist() == [0]
    assert pd8._lengths(0, 28, 0, 0).tolist() == [] and pd8._lengths(30, 28, 28, 1).tolist() == [29, 30]
    assert pd8._lengths(120, 28, 0, 0).tolist() == [*range(1, 29), 56, 112]


def test_units_that_overlap_what_is_kept_stay(spark):
    words = _words(random.Random(23), 60, 10**7)
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words))], DOCS)
    got = pd8._occurrences(rows, 24, 25, 10, 80).collect()  # a window at every other position or so
    assert len(got) > 20 and all(r["removed"] == (r["doc_id"] == 2) for r in got)


def test_paragraphs_of_an_empty_table_and_of_one_document(spark):
    assert pd8.repeated_paragraphs(spark.createDataFrame([], DOCS)).collect() == []
    assert pd8.repeated_paragraphs(spark.createDataFrame([(1, "a b c\na b c")], DOCS)).collect() == []


def _bytes_below(folder):
    sizes = []
    for d, _, names in os.walk(folder):
        sizes += [os.path.getsize(os.path.join(d, f)) for f in names]
    return sum(sizes)


def test_the_units_are_gone_while_paragraphs_are_compared(spark, monkeypatch):
    rnd = random.Random(51)
    alike = _words(rnd, 40, 10**7)
    rows = [(i, "\n".join(" ".join(_words(rnd, 12, 10**7)) for _ in range(100))) for i in range(60)]
    rows += [(60, " ".join(alike)), (61, " ".join([*alike[:-1], "else"]))]
    folder = shared_folder(spark).removeprefix("file:")
    before, held = _bytes_below(folder), []

    def compared(*args, **kwargs):
        held.append(_bytes_below(folder) - before)
        return nd.class_components(*args, **kwargs)

    monkeypatch.setattr(pd8, "class_components", compared)
    got = pd8.repeated_paragraphs(spark.createDataFrame(rows, DOCS)).select("doc_id", "start", "end", "removed").collect()
    assert {(60, 0, 40, False), (61, 0, 40, True)} <= {tuple(r) for r in got}
    # 6,000 lines that resemble no other one, of 25 bytes and ten bands each, are not kept until then
    assert held[0] < 6000 * 25


def test_paragraphs_of_rows_that_repeat_an_id_are_compared_once(spark):
    rnd = random.Random(52)
    a, other = _words(rnd, 40, 10**7), _words(rnd, 30, 10**7)
    line, edited = " ".join(a), " ".join([*a[:-1], "else"])
    rows = [(1, line), (1, line), (1, line + "\n" + " ".join(other)), (1, " ".join(other)), (2, edited), (2, edited + "\nand"), (None, line)]
    docs = spark.createDataFrame(rows, DOCS)
    places = pd8._candidates(pd8._units(docs, 24, 51, 10), 10)
    sets = pd8._sets_of(docs, places, places.select("id")).collect()
    # both lines and the two blocks that hold them
    assert sorted(len(r["shingles"]) for r in sets) == [36, 36, 37, 66] and len({r["id"] for r in sets}) == 4
    got = {tuple(r) for r in pd8.repeated_paragraphs(docs).select("doc_id", "start", "end", "n_docs", "removed").collect()}
    assert {(1, 0, 40, 2, False), (2, 0, 40, 2, True)} <= got


def test_pairs_of_a_common_band_that_cannot_be_linked_are_not_compared(spark, monkeypatch):
    rnd = np.random.default_rng(53)
    universe = rnd.integers(0, 2**64, 100, dtype=np.uint64)
    sets = [np.sort(rnd.choice(universe, 75, replace=False)) for _ in range(60)]  # Jaccard 0.6 or so
    for k in (7, 31):
        twin = sets[k].copy()
        twin[0] = np.setdiff1d(universe, sets[k])[0]
        sets.append(np.sort(twin))
    table = [(i, s.view(np.int64).tolist(), pd8._cells(s).tolist()) for i, s in enumerate(sets)]
    table = spark.createDataFrame(table, "id long, shingles array<long>, cells array<long>")
    classes = spark.createDataFrame([(i, 75, [1]) for i in range(62)], "id long, n_shingles long, bands array<long>")
    compared, confirmed = [], nd._confirmed

    def counted(pairs, *args):
        compared.append(pairs.count())
        return confirmed(pairs, *args)

    monkeypatch.setattr(nd, "_confirmed", counted)
    got = nd.class_components(classes, lambda ids: checkpointed(table.join(ids, "id")), 80, words=pd8.CELL_WORDS).collect()
    assert {tuple(r) for r in got} == {(7, 7), (60, 7), (31, 31), (61, 31)}
    # the hub's 61, then the links alone of the 1,830
    assert compared[0] == 61 and sum(compared[1:]) <= 10


def test_cells_bound_what_sets_have_in_common(spark):
    rnd = np.random.default_rng(54)
    rows, linked = [], set()
    for k, n in enumerate([1, 4, 20, 200, 900, 3000] * 20):
        a = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: n - rnd.integers(0, n // 5 + 1)], rnd.integers(0, 2**64, n // 9, dtype=np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 80 * (len(a) + len(b) - common):
            linked.add(k)
        row = [k]
        for s in (a, b):
            cells = pd8._cells(s)
            row += [len(s), len(s) - int(np.bitwise_count(cells.view(np.uint64)).sum()), *cells.tolist()]
        rows.append(tuple(row))
    columns = [c + x for x in ("", "_x") for c in ("n_shingles", "spare", *(f"cell{i}" for i in range(pd8.CELL_WORDS)))]
    left = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in ["k", *columns])).where(nd._reach_by_cells(pd8.CELL_WORDS, 80))
    assert len(linked) > 20 and linked <= {r["k"] for r in left.collect()}


# -- the filters of the pipeline, with null and repeated ids ---------------------------


def _left(df):
    return sorted(((r["doc_id"], r["text"], r["lang"]) for r in df.collect()), key=str)


def test_exact_filter_judges_rows(spark):
    rows = [(1, "a b"), (1, "a b"), (2, "ab"), (2, "unique"), (None, "a  b"), (None, "a  b"), (None, "c"), (None, "c"), (5, "C"), (6, None), (6, "")]
    df = spark.createDataFrame(rows, DOCS).withColumn("lang", F.lit("x"))
    got = _left(drop_exact_copies(df))
    assert [r for r in got if r[1]] == sorted([(2, "unique", "x"), (None, "a  b", "x"), (None, "c", "x"), (5, "C", "x")], key=str)
    assert len(got) == 5 and any(r[0] == 6 for r in got)


def test_near_filter_judges_rows(spark):
    rnd = random.Random(31)
    base, alone, third = _words(rnd, 200, 10**6), _words(rnd, 40, 10**6), _words(rnd, 200, 10**6)
    near = [" ".join(_edited(rnd, base, 1)) for _ in range(3)]
    nulls = [" ".join(_edited(rnd, third, 1)) for _ in range(2)]
    rows = [(3, near[0]), (3, near[0]), (4, near[1]), (4, " ".join(alone)), (None, near[2]), (None, nulls[0]), (None, nulls[1]), (None, nulls[1]), (9, "")]
    got = _left(nd.drop_near_copies(spark.createDataFrame(rows, DOCS).withColumn("lang", F.lit("x"))))
    assert len(got) == 4 and {(3, near[0], "x"), (4, " ".join(alone), "x"), (9, "", "x")} < set(got)
    assert [r[0] for r in got if r[1] in nulls] == [None]


def test_contaminated_filter_judges_rows(spark):
    item = " ".join(f"i{k}" for k in range(12))
    rows = [(1, "x " + item), (1, "clean text"), (1, "clean text"), (None, item + " y"), (None, "clean too"), (2, None)]
    bench = spark.createDataFrame([(1, item), (2, "another")], "item_id long, text string")
    df = spark.createDataFrame(rows, DOCS).withColumn("lang", F.lit("x"))
    want = sorted([(1, "clean text", "x"), (1, "clean text", "x"), (None, "clean too", "x"), (2, None, "x")], key=str)
    assert _left(drop_contaminated(df, bench)) == want and _left(drop_contaminated(df, bench, batch_windows=1)) == want


def test_pipeline_drops_near_copies_from_four_fifths_on(spark):
    import corpus_pipeline

    rows = []
    for k in range(30):
        words = [f"d{k}w{i}" for i in range(204)]
        # 178 shingles in common of 222: 0.802
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:182] + [f"d{k}v{i}" for i in range(22)]))]
    sets = [nd.shingle_set(t) for _, t in rows]
    like = lambda a, b: 100 * len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert all(80 <= like(sets[2 * k], sets[2 * k + 1]) < 85 for k in range(30))
    left = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOCS), "")
    assert sorted(r["doc_id"] for r in left.collect()) == [2 * k for k in range(30)]


def test_filters_leave_columns_of_any_name_alone(spark):
    """Columns named like the filters' own, in any case of letters, come back as they were."""
    from ventilake.llm.quality import keep_good
    from ventilake.llm.toxicity import drop_toxic

    text = " ".join(f"w{i}" for i in range(30))
    names = ["row_key_a", "ROW_KEY_B", "text_digest", "text_rank", "Text_MD5", "toxicity", "quality_score", "_key", "also", "component", "key", "hits"]
    rows = [(1, text, "first"), (2, text, "copy"), (3, text + " more", "near"), (4, "another text", "x"), (None, text, "nameless"), (5, None, "null"), (5, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, note string").withColumns({n: F.concat(F.lit(f"{n}-"), "note") for n in names})
    bench = spark.createDataFrame([(1, "another text")], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    kept = {
        "exact": (drop_exact_copies(df), {"first", "near", "x", None}),
        "near": (nd.drop_near_copies(df), {"first", "x", "null", "empty"}),
        "bench": (drop_contaminated(df, bench), {"first", "copy", "near", "nameless", "null", "empty"}),
        "toxic": (drop_toxic(df, labels), {r[2] for r in rows}),
        "quality": (keep_good(df, labels), None),
    }
    for name, (out, want) in kept.items():
        assert out.columns == df.columns, name
        found = out.collect()
        assert all(r[n] == f"{n}-{r['note']}" for r in found for n in names), name
        if want is not None:
            # of the two empty texts with one id either may stay, or both where shingles decide
            got = {r["note"] for r in found} - ({"null", "empty"} if name != "bench" else set())
            assert got == {w for w in want if w not in ((None, "null", "empty") if name != "bench" else (None,))}, name


def test_components_of_many_tasks(spark, monkeypatch):
    from ventilake.llm import components as cp

    rnd = random.Random(12)
    links = [(rnd.randrange(900), rnd.randrange(900)) for _ in range(500)] + [(5000, 5000 + k) for k in range(400)] + [(7000 + k, 7001 + k) for k in range(150)]
    df = spark.createDataFrame(links, "a long, b long").repartition(6)
    want = {r["id"]: r["component"] for r in connected_components(df).collect()}
    monkeypatch.setattr(cp, "LINKS_PER_TASK", 90)
    assert {r["id"]: r["component"] for r in connected_components(df).collect()} == want
    assert len({c for i, c in want.items() if i >= 5000}) == 2 and want[7150] == 7000
