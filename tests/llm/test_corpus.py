import itertools
import math
import random
import re
import time
import zlib
from collections import Counter
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import _spark, compact_windows, context_mixing, language_crf, licenses, line_rules, mixing, no_random_access, packing, quality_trees, setsketch

ODD = [(1, None, None), (2, "", "s"), (3, " \n ", "s"), (4, "one two", "s"), (4, "one two", "s"), (5, "x" * 300_000, None), (6, "Dé jà vu — ünïcode ☃ text.\n" * 40, "t"), (None, "no id here at all", "t")]


def docs(spark, rows=ODD):
    return spark.createDataFrame([(*r, "q") for r in rows], "doc_id long, text string, source string, n_words string")


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n)]


def prose(seed, n, words=None):
    r = random.Random(seed)
    return " ".join(r.choice(words or vocabulary(0)) for _ in range(n))


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_and_clashing_columns(spark, empty):
    d = docs(spark).where("false") if empty else docs(spark)
    n = d.count()
    labels = spark.createDataFrame([(2, 0), (4, 1), (6, 1), (None, 1), (5, None)], "doc_id long, label int")
    assert setsketch.near_duplicates(d).count() == (0 if empty else n - 1)
    assert quality_trees.score(d, quality_trees.train(d, labels)).count() == n
    assert compact_windows.repeated_passages(d).count() == 0
    assert compact_windows.remove_passages(d, compact_windows.repeated_passages(d)).columns == d.columns
    assert licenses.scan_licenses(d).count() == n
    assert line_rules.line_rules(d).count() == n
    assert language_crf.predict(d, language_crf.train(d.withColumn("lang", F.lit("x")), F.lit(True))).count() == n
    assert context_mixing.score(d, F.col("doc_id") % 7 == 2).count() == n
    assert set(mixing.mix_sources(d).columns) >= set(d.columns)
    pieces = packing.pack(d).toPandas()
    assert pieces["length"].sum() == sum(len(packing.token_ids((r.text or "").encode())) for r in d.collect())


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(3)
    rows = []
    for g in range(12):
        base = prose(g, r.choice([3, 30, 120])).split()
        for c in range(r.choice([1, 2, 25])):
            t = list(base)
            for _ in range(r.randint(0, 4)):
                t[r.randrange(len(t))] = r.choice(vocabulary(9))
            rows.append((len(rows), " ".join(t), "s"))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for _, t, _ in rows)]
    part = list(range(len(rows)))
    for _ in range(len(rows)):
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if 100 * len(a & b) >= 80 * len(a | b):
                    part[i] = part[j] = min(part[i], part[j])
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in setsketch.near_duplicates(docs(spark, rows)).collect()}
    assert got == {i: (len(sets[i]), part[i]) for i in range(len(rows))}


def test_sketch_estimates_similarity():
    words = np.random.default_rng(0).integers(0, 1 << 63, 1500).astype(np.uint64)
    a, b = words[:1000], words[250:1250]
    regs = setsketch.registers(np.concatenate([a, b]), np.repeat([0, 1], 1000), np.array([1000, 1000]))
    at = setsketch.estimate(regs[:1], regs[1:], np.array([1000.0]), np.array([1000.0]))[0]
    assert abs(at - 0.6) < 0.15


def test_poisson_rates(spark):
    rows = [(i, "abcd", "big" if i < 4000 else "small") for i in range(5000)]
    got = dict(mixing.mix_sources(docs(spark, rows)).groupBy("source").count().collect())
    assert all(abs(n - 2500) < 200 for n in got.values())
    named = mixing.mix_sources(docs(spark, rows), {"small": 1.0}).groupBy("source").count().collect()
    assert [r.source for r in named] == ["small"]


def test_mixed_rows_are_in_one_order_over_all(spark):
    rows = [(i, f"t{i}", "big" if i % 3 else None) for i in range(400)] + [(7, "t7", "big"), (None, "x", "big"), (900, None, "big")]
    got = mixing.mix_sources(docs(spark, rows)).select("shuffle_key", "replica", "doc_id", "source").collect()
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    n = Counter(r.doc_id for r in got)
    alone = Counter(r.doc_id for r in mixing.mix_sources(docs(spark, rows)).where("replica = 1").collect())
    assert alone[7] in (0, 2) and n[7] % 2 == 0 and {r.source for r in got} == {"big", None}
    assert mixing.mix_sources(docs(spark, rows), size=0).collect() == [] == mixing.mix_sources(docs(spark, rows), {}).collect()


def test_trees_learn_a_rule():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, len(quality_trees.FEATURES)))
    y = ((x[:, 3] > 0.2) & (x[:, 5] < 1)).astype(float)
    p = quality_trees.predict(quality_trees.fit(x[:1500], y[:1500]), x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.97


def test_passages_are_found_and_cut(spark):
    passage, rows = prose(77, 60, vocabulary(5)), []
    for i in range(8):
        own = prose(100 + i, 120, vocabulary(200 + i))
        rows.append((i, f"{own} {passage if i % 2 else ''} {prose(300 + i, 50, vocabulary(400 + i))}", "s"))
    d = docs(spark, rows)
    found = compact_windows.repeated_passages(d).collect()
    assert {r.doc_id for r in found} == {3, 5, 7} and all(r.ref_doc_id in (1, 3, 5) and r.ref_doc_id < r.doc_id and r.n_words >= 60 for r in found)
    cut = {r.doc_id: r.text for r in compact_windows.remove_passages(d, compact_windows.repeated_passages(d)).collect()}
    assert passage in cut[1] and not any(passage.split()[30] in cut[i].split() for i in (3, 5, 7)) and cut[0] == rows[0][1]


def covered(found, n):
    """Words of each document that found passages hold."""
    out = {i: np.zeros(k, bool) for i, k in n.items()}
    for r in found:
        out[r.doc_id][r.start : r.start + r.n_words] = True
    return out


def test_long_stretches_that_repeat_themselves_are_passages(spark):
    line = prose(31, 12, vocabulary(31))
    twice = prose(32, 70, vocabulary(32))
    own = lambda i, n: prose(500 + i, n, vocabulary(500 + i))
    rows = [(0, f"{own(0, 37)} {' '.join([line] * 200)} {own(1, 30)}", "s"), (1, f"{own(2, 80)} {' '.join([line] * 200)} {own(3, 30)}", "s")]
    rows += [(5, f"{own(4, 60)} {twice}", "s"), (6, f"{twice} {own(5, 300)} {twice} {own(6, 20)}", "s")]
    found = compact_windows.repeated_passages(docs(spark, rows)).collect()
    hit = covered(found, {i: len(t.split()) for i, t, _ in rows})
    assert hit[1][80:2480].all() and not hit[1][:70].any() and not hit[0].any()
    assert hit[6][:70].all() and hit[6][370:440].all()


def test_places_of_a_chunks_first_document_all_go_on():
    key, doc, place = np.array([5, 5, 5, 9]), np.array([1, 1, 2, 2]), np.array([10, 400, 30, 7])
    got = compact_windows._led(key, doc, place).to_pylist()
    assert [(r["key"], r["doc"], r["at"], r["at2"]) for r in got if r["at2"] < 0] == [(5, 1, 10, -1), (5, 1, 400, -1), (9, 2, 7, -1)]
    assert [(r["doc"], r["at"], r["doc2"], r["at2"]) for r in got if r["at2"] >= 0] == [(2, 30, 1, 10)]


def test_passages_do_not_depend_on_how_texts_are_dealt(spark):
    rows = []
    for g in range(6):
        base = prose(40 + g, 70, vocabulary(40 + g)).split()
        for k in range(9):
            w = list(base)
            w[10 + 5 * k] = f"changed{k}"
            rows.append((9 * g + k, " ".join([prose(4000 + 9 * g + k, 30, vocabulary(9 * g + k)), *w, prose(5000 + 9 * g + k, 30, vocabulary(99 + 9 * g + k))]), "s"))
    found = lambda n: sorted(map(tuple, compact_windows.repeated_passages(docs(spark, rows).repartition(n)).collect()))
    one = found(1)
    assert one == found(7) and {r[0] for r in one} >= {9 * g + k for g in range(6) for k in range(1, 9)}


def test_passages_with_inserted_and_deleted_words(spark):
    rows, want = [], {}
    for i in range(12):
        base = prose(600 + i, 60, vocabulary(600 + i)).split()
        edited = list(base)
        if i % 3 == 0:
            edited.insert(30, "inserted")
        elif i % 3 == 1:
            del edited[30]
        else:
            edited[20:20] = ["two", "more"]
        grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (base, edited)]
        if 100 * len(grams[0] & grams[1]) >= 80 * len(grams[0] | grams[1]):
            want[2 * i + 1] = len(edited)
        for k, t in enumerate((base, edited)):
            rows.append((2 * i + k, f"{prose(700 + 2 * i + k, 40, vocabulary(700 + 2 * i + k))} {' '.join(t)} {prose(800 + 2 * i + k, 40, vocabulary(800 + 2 * i + k))}", "s"))
    hit = covered(compact_windows.repeated_passages(docs(spark, rows)).collect(), {i: len(t.split()) for i, t, _ in rows})
    assert len(want) == 12
    # two hash functions: a passage at 80 to 90 percent shares a key with high probability, not always
    whole = [i for i, n in want.items() if hit[i][40 : 40 + n].all()]
    assert len(whole) >= 10 and not any(hit[i].any() for i in hit if i not in want)
    assert all(not hit[i][:35].any() and not hit[i][40 + n + 5 :].any() for i, n in want.items())


def test_stretches_pass_over_gaps():
    a = np.arange(100, 160).astype(np.uint16)
    b = np.insert(a, 30, 7)
    assert compact_windows.stretch(a, b, 5, 5) == (0, 60, 0) == compact_windows.stretch(a, b, 50, 51)
    assert compact_windows.stretch(b, a, 50, 49) == (0, 61, 0)
    assert compact_windows.stretch(a[:49], b[:50], 5, 5) is None


def test_passages_that_the_first_document_holds_in_part(spark):
    rows = []
    for g in range(40):
        passage = prose(900 + g, 50, vocabulary(900 + g)).split()
        for k, n in enumerate((45 if g % 2 else 40, 50, 50)):
            own = [prose(3000 + 6 * g + 2 * k + s, 30, vocabulary(3000 + 6 * g + 2 * k + s)) for s in (0, 1)]
            rows.append((3 * g + k, f"{own[0]} {' '.join(passage[:n])} {own[1]}", "s"))
    hit = covered(compact_windows.repeated_passages(docs(spark, rows)).collect(), {i: len(t.split()) for i, t, _ in rows})
    assert all(hit[3 * g + 2][30:80].all() for g in range(40))
    # brute force: words of all stretches of 50 words that an earlier document holds
    seen, want = {}, {i: np.zeros(len(t.split()), bool) for i, t, _ in rows}
    for i, t, _ in rows:
        w = t.split()
        for s in range(len(w) - 49):
            if seen.setdefault(tuple(w[s : s + 50]), i) != i:
                want[i][s : s + 50] = True
    assert all(hit[i][want[i]].all() for i in want)


@pytest.mark.parametrize("edits", [3, 5])
def test_passages_that_are_not_like_their_first_holder(spark, edits):
    """Of three documents the first holds the passage with words changed, so that the two later ones are like each other only."""
    rows, groups = [], 150
    for g in range(groups):
        passage = prose(20_000 + g, 60, vocabulary(20_000 + g)).split()
        first, last = list(passage), list(passage)
        for e in range(edits):
            first[(7 + e * 50 // edits) % 60] = f"other{g}x{e}"
        last[30] = f"changed{g}"
        for k, p in enumerate((first, passage, last)):
            own = [prose(30_000 + 6 * g + 2 * k + s, 30, vocabulary(30_000 + 6 * g + 2 * k + s)) for s in (0, 1)]
            rows.append((3 * g + k, f"{own[0]} {' '.join(p)} {own[1]}", "s"))
    pairs = {(r.doc_id, r.ref_doc_id) for r in compact_windows.repeated_passages(docs(spark, rows)).collect()}
    # brute force over all pairs of passages
    grams = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t, _ in rows for w in [t.split()[30:90]]}
    alike = {(b, a) for a in grams for b in range(a + 1, a - a % 3 + 3) if 100 * len(grams[a] & grams[b]) >= 80 * len(grams[a] | grams[b])}
    assert alike == {(3 * g + 2, 3 * g + 1) for g in range(groups)}
    print("found", len(alike & pairs), "of", groups)
    assert len(alike & pairs) >= 0.95 * groups and pairs <= alike


def test_passages_behind_many_unlike_holders_of_their_keys(spark):
    """Thirty documents hold a passage with words changed, none like another; two later ones are like each other only."""
    rows, groups, before = [], 12, 30
    rng = np.random.default_rng(5)
    for g in range(groups):
        passage = prose(50_000 + g, 60, vocabulary(50_000 + g)).split()
        held = []
        for k in range(before):
            w = list(passage)
            for e, at in enumerate(rng.choice(np.arange(2, 58), 4, replace=False)):
                w[at] = f"other{g}x{k}x{e}"
            held.append(w)
        last = list(passage)
        last[30] = f"changed{g}"
        for k, p in enumerate((*held, passage, last)):
            own = [prose(60_000 + 100 * g + 2 * k + s, 30, vocabulary(60_000 + 100 * g + 2 * k + s)) for s in (0, 1)]
            rows.append((100 * g + k, f"{own[0]} {' '.join(p)} {own[1]}", "s"))
    pairs = {(r.doc_id, r.ref_doc_id) for r in compact_windows.repeated_passages(docs(spark, rows)).collect()}
    want = {(100 * g + before + 1, 100 * g + before) for g in range(groups)}
    print("found", len(want & pairs), "of", groups)
    assert len(want & pairs) >= 0.9 * groups


def test_crowded_keys_lose_no_alike_pair(spark, monkeypatch):
    """Places of crowded keys are looked up by further shingles that they share; that finds what all pairs find."""
    rows, phrase = [], prose(70_000, 40, vocabulary(70_000)).split()
    for k in range(40):
        own = [prose(71_000 + 2 * k + s, 30, vocabulary(71_000 + 2 * k + s)) for s in (0, 1)]
        tail = prose(72_000 + k // 2, 20, vocabulary(72_000 + k // 2)).split()
        if k % 2:
            tail[2] = f"changed{k}"
        rows.append((k, f"{own[0]} {' '.join([*phrase, *tail])} {own[1]}", "s"))
    found = []
    for most in (10**9, 0):
        monkeypatch.setattr(compact_windows, "CROWD", most)
        found.append({(r.doc_id, r.start, r.n_words, r.ref_doc_id, r.ref_start) for r in compact_windows.repeated_passages(docs(spark, rows)).collect()})
    assert found[0] == found[1] and sum(x[0] % 2 and x[3] == x[0] - 1 for x in found[0]) >= 18


def test_crowds_list_every_alike_pair(spark, monkeypatch):
    """Forty near copies of a passage, some of them too far apart: each is listed with all earlier ones that it is like, also if their seed has more places than a row."""
    passage, rng = prose(73_000, 60, vocabulary(73_000)).split(), np.random.default_rng(11)
    rows = []
    for k in range(40):
        w = list(passage)
        for at in rng.choice([*range(20), *range(40, 60)], k % 3, replace=False):
            w[at] = f"other{k}x{at}"
        rows.append((k, f"{prose(74_000 + k, 40, vocabulary(74_000 + k))} {' '.join(w)} {prose(75_000 + k, 40, vocabulary(75_000 + k))}", "s"))
    hashes = [np.array([zlib.crc32(x.encode()) & 0xFFFF for x in t.split()], np.uint16) for _, t, _ in rows]
    alike = {(b, a) for b in range(40) for a in range(b) if compact_windows.stretch(hashes[b], hashes[a], 64, 64)}
    assert 200 < len(alike) < 40 * 39 // 2
    members = spark.createDataFrame([(7, k, 64, True) for k in range(40)], "g long, doc long, at long, own boolean")
    for most in (8, 10**9):
        monkeypatch.setattr(compact_windows, "CROWD", most)
        found = compact_windows._further(docs(spark, rows), _spark.Stash(members), spark.createDataFrame([], "doc long, doc2 long"), 50, 80)
        assert {(r.doc, r.doc2) for f in found for r in f.read().collect()} == alike


def test_tiles_meet_all_alike_places_in_few_rows():
    """Near copies of a passage with words changed, put in or left out: pairs found equal brute force, and only alike ones become rows."""
    rng, passage, held = np.random.default_rng(8), prose(95_000, 160, vocabulary(95_000)).split(), []
    for k in range(150):
        w, edits = list(passage), rng.integers(0, 9)
        for at in np.sort(rng.choice([*range(70), *range(90, 160)], edits, replace=False))[::-1]:
            w[at : at + 1] = ([f"other{k % 40}x{at}"], [], [w[at], f"more{k}"])[rng.integers(0, 3)]
        at = w.index(passage[74])
        hashes = np.array([zlib.crc32(x.encode()) & 0xFFFF for x in w], np.uint16)
        held.append({"doc": k, "at": at, "seen": hashes[max(0, at - compact_windows.CONTEXT) : at + compact_windows.CONTEXT + compact_windows.SHINGLE].tobytes(), "but": [3] if k == 9 else None})
    seen = [np.frombuffer(x["seen"], np.uint16) for x in held]
    alike = {(b, a) for b in range(150) for a in range(b) if compact_windows.stretch(seen[b], seen[a], min(held[b]["at"], compact_windows.CONTEXT), min(held[a]["at"], compact_windows.CONTEXT))} - {(9, 3)}
    found = lambda every: [(r[0], r[2]) for r in compact_windows._met(held, held[::-1], every, 50, 80)]
    assert set(found(True)) == alike and 500 < len(alike) < 150 * 149 // 2 - 500
    assert found(False) == [(b, min(a for c, a in alike if c == b)) for b in sorted({b for b, _ in alike})]
    batch = pa.RecordBatch.from_arrays([pa.array([held]), pa.array([held]), pa.array([False])], names=["own", "others", "every"])
    assert sum(b.num_rows for b in compact_windows._tiles(50, 80)([batch])) == len({b for b, _ in alike})


def test_tiles_compare_few_unlike_places_in_full(monkeypatch):
    """Places that share a phrase just too short for a passage, among words of their own or one word over and over: pairs found equal brute force, and those that no gap could make longer aren't compared in full."""
    phrase, held = [f"phrase{x}" for x in range(45)], []
    for k in range(120):
        before, behind = ([f"own{k}x{s}x{x if k % 3 else 0}" for x in range(120)] for s in range(2))
        w = [*before, *phrase[: 45 - k % 5 * (k % 10 < 8)], *behind]
        if k % 10 >= 8:  # the passage goes on in its like
            w[165:200] = [f"more{k // 10}x{x if k % 20 < 10 else x % 3}" for x in range(35)]
            w[170 + k % 3] = "changed"
        hashes = np.array([zlib.crc32(x.encode()) & 0xFFFF for x in w], np.uint16)
        held.append({"doc": k, "at": 125, "seen": hashes[125 - compact_windows.CONTEXT : 125 + compact_windows.CONTEXT + compact_windows.SHINGLE].tobytes(), "but": [98] if k == 99 else None})
    seen, at, whole = [np.frombuffer(x["seen"], np.uint16) for x in held], compact_windows.CONTEXT, compact_windows._stretch
    alike = {(b, a) for b in range(120) for a in range(b) if compact_windows.stretch(seen[b], seen[a], at, at) and a not in (held[b]["but"] or ())}
    calls = []
    monkeypatch.setattr(compact_windows, "_stretch", lambda *a: calls.append(a) or whole(*a))
    assert {(r[0], r[2]) for r in compact_windows._met(held, held, True, 50, 80)} == alike
    print("alike", len(alike), "in full", len(calls))
    assert len(alike) >= 8 and len(calls) <= 2 * len(alike) + 20


def test_alike_stretches_always_share_a_seed():
    ids, texts = [], []
    for g in range(1000):
        passage = prose(90_000 + g, 55, vocabulary(g % 7)).split()
        for k in range(2):
            ids.append(2 * g + k)
            texts.append(" ".join([*passage[:27], f"changed{k}", *passage[27:]]))
    held = {}
    for b in compact_windows._windows([pa.record_batch({"doc_id": pa.array(ids), "text": pa.array(texts)})]):
        for r in b.to_pylist():
            held.setdefault(r["key"], set()).add(r["doc"])
    met = {d // 2 for x in held.values() for d in x if d ^ 1 in x}
    assert len(met) == 1000


def test_centres_are_window_minima():
    values = np.random.default_rng(2).integers(0, 50, 300).astype(np.uint64)
    want = set()
    for lo in range(300 - 19):
        want.add(lo + int(values[lo : lo + 20].argmin()))
    assert set(compact_windows.centres(values, np.zeros(300, np.int64), 20).tolist()) == want


def test_license_labels_and_places(spark):
    texts = {"Licensed under the Apache License, Version 2.0.": "apache,apache-2.0", "x MIT License y mit license": "mit", "This is under the GNU General Public License, version 3.": "gpl,gpl-3", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "GNU Lesser General Public License v2.1": "gpl,lgpl-2.1", "nothing here": ""}
    d = docs(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r for r in licenses.scan_licenses(d).collect()}
    assert [got[i].labels for i in range(len(texts))] == list(texts.values())
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].n_words) == (2, 1, 4, 6)


def scanned(text):
    """Base columns, labels, score and kept matches by brute force: all rules over the text, every match against every other."""
    low = text.lower()
    found = {(m.start(), m.end(), r["priority"], r["label"], r["confidence"]) for r in licenses.rules() if r["keyword"] in low for m in re.finditer(r["regex"], low)}
    over = lambda o, m: o[0] <= m[0] and o[1] >= m[1] and (o[2] > m[2] or (o[2] == m[2] and (o[1] - o[0] > m[1] - m[0] or (o[:2] == m[:2] and o[3] < m[3]))))
    kept = {m for m in found if not any(over(o, m) for o in found)}
    ws = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    base = [(i, label) for i in range(len(ws)) for phrase, label in licenses.PHRASES.items() if tuple(ws[i : i + len(phrase)]) == phrase]
    plain = sorted({label for _, label in base})
    score = max([m[4] for m in kept] + [0.5 if base else 0.0])
    return (len(ws), len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(plain), ",".join(sorted({*plain, *(m[3] for m in kept)})), score, sorted(kept))


def found_by_scan(df):
    return {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, sorted(map(tuple, r.matches))) for r in licenses.scan_licenses(df).collect()}


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="needs the driver's tables")
def test_licenses_of_a_whole_table_by_brute_force(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert found_by_scan(d) == {r.doc_id: scanned(r.text or "") for r in d.collect()}


def test_licenses_by_brute_force(spark):
    r, plain = random.Random(3), ["Apache License", "MIT license", "GNU General Public License, version 2 or (at your option) any later version", "licensed under the Apache License, Version 2.0", "BSD 3-Clause", "CC BY-SA 4.0", "all rights reserved", "SPDX-License-Identifier: GPL-2.0-only", "Mozilla Public License 2.0", "permission is hereby granted, free of charge, to any person obtaining a copy"]
    texts = [" ".join(r.choice(plain) if r.random() < 0.4 else r.choice(vocabulary(3)) for _ in range(n)) for n in (0, 1, 5, 30, 300, 300)]
    got = found_by_scan(docs(spark, [(i, t, "s") for i, t in enumerate(texts)]))
    assert got == {i: scanned(t) for i, t in enumerate(texts)}


def test_repeated_notices_take_linear_time(spark):
    notice = "Licensed under the Apache License, Version 2.0 by the MIT license. "
    took = []
    for n in (500, 1000, 8000):
        began = time.time()
        (row,) = licenses.scan_licenses(docs(spark, [(1, notice * n, "s")])).collect()
        took.append(time.time() - began)
        assert row.n_base == 2 * n and row.labels == "apache,apache-2.0,mit" and len(row.matches) == 2 * n
    assert took[2] < 8 * took[1] + 5


def test_licenses_beside_other_characters(spark):
    texts = {"See \u201cApache License\u201d.": "apache", "under GPLv3\u2014see": "gpl-3", "\u8bb8\u53efApache License\u8bb8\u53ef": "apache", "Mozilla Public LicenseV2": "mpl,mpl-2.0", "xBSD-3-Clausey": "bsd-3-clause", "MPL 2.0\u3002": "mpl-2.0"}
    got = {r.doc_id: r for r in licenses.scan_licenses(docs(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    for i, (t, labels) in enumerate(texts.items()):
        assert set(labels.split(",")) & set(got[i].labels.split(",")), t
    assert all(got[i].score > 0.5 for i in got)
    # each rule's plainest match passes
    shapes = [r["regex"] for r in licenses.rules()]
    plain = [re.sub(r"\(\?<?!.*?\)", "", x) for x in shapes]
    plain = [x for x in (re.sub(r"\[(.)[^\]]*\]", r"\1", re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)[?*]?", r"\1", x)) for x in plain) if x.isascii()]
    texts = [t for x, shape in zip(plain, shapes) for t in [x.replace(" *", " ").replace("\\.", ".").replace("\\(", "").replace("\\+?", "").replace("?", "").replace("*", "")] if re.search(shape, t)]
    assert len(texts) > 300
    d = spark.createDataFrame([(t,) for t in texts], "low string")
    assert d.where(~licenses.searched(F.col("low"))).collect() == []


def test_forward_backward_in_blocks_is_exact():
    rng = np.random.default_rng(4)
    scores, links, sizes = rng.normal(size=(700, 3)), rng.normal(size=(3, 3)), np.array([1, 300, 64, 65, 270])
    whole, parts = (language_crf.posteriors(scores, sizes, links, b) for b in (1000, 16))
    assert np.allclose(whole, parts)
    two, t = scores[:2], np.exp(links)
    joint = np.exp(two[0])[:, None] * t * np.exp(two[1])[None, :]
    assert np.allclose(language_crf.posteriors(two, np.array([2]), links)[0], (joint.sum(axis=1) / joint.sum()))


def test_gradient_of_the_links_is_that_of_the_likelihood():
    """Expected pairs against finite differences of log Z, and against all labellings."""
    rng = np.random.default_rng(6)
    scores, links = rng.normal(size=(1, 6, 3)), rng.normal(size=(3, 3))

    def total(links):
        every = itertools.product(range(3), repeat=6)
        return math.log(sum(math.exp(sum(scores[0, i, y[i]] for i in range(6)) + sum(links[y[i], y[i + 1]] for i in range(5))) for y in every))

    one, pairs = language_crf.chains(scores, links)
    for a in range(3):
        for b in range(3):
            step = np.zeros((3, 3))
            step[a, b] = 1e-5
            assert pairs[a, b] == pytest.approx((total(links + step) - total(links - step)) / 2e-5, abs=1e-6)
    assert np.allclose(one[0], language_crf.posteriors(scores[0], np.array([6]), links)) and pairs.sum() == pytest.approx(5)


def test_many_languages_are_learned(spark):
    d = spark.createDataFrame([(i, prose(i, 6, vocabulary(i, 5)), f"l{i % 300:03}") for i in range(900)] + [(i, prose(1, 6, vocabulary(1, 5)), "l001") for i in range(2000, 2400)], "doc_id long, text string, lang string")
    seen = {}
    keep = language_crf.Field.learn
    try:
        language_crf.Field.learn = lambda self, texts, labels, seed=11: seen.update(n=Counter(labels.tolist()), languages=self.languages)
        language_crf.train(d, F.lit(True), 10)
    finally:
        language_crf.Field.learn = keep
    assert len(seen["languages"]) == 300 and max(seen["n"].values()) == 10 and min(seen["n"].values()) == 3


def test_long_words_count_in_full():
    words = [b"abcd" * 3, b"x" * 12 + b"middle" * 5 + b"y" * 12, b"x" * 12 + b"y" * 12, b"a"]
    owner, ids = language_crf.features(words)
    assert np.bincount(owner).tolist() == [sum(max(0, len(w) + 3 - n) for n in (2, 3, 4)) + 1 for w in words]
    inner, cut = set(ids[owner == 1].tolist()), set(ids[owner == 2].tolist())
    alone = language_crf.features([b"middle"])
    assert len(inner - cut) > 5 and len(inner & set(alone[1].tolist())) >= 5


def test_languages_on_held_out_texts(spark):
    kinds = {"aa": ["ba", "ke", "lo", "mi"], "zz": ["schr", "ung", "keit", "ver"]}
    rows = []
    for i in range(60):
        lang = "aa" if i % 2 else "zz"
        r = random.Random(i)
        rows.append((i, " ".join("".join(r.choice(kinds[lang]) for _ in range(3)) for _ in range(40)), lang))
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language_crf.predict(d, language_crf.train(d, F.col("doc_id") < 30)).join(d.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang == r.lang_pred for r in got)


def test_line_rules_keep_prose(spark):
    good = "This is a plain line of prose that says something useful here today.\nAnd another line follows it with more to say about things."
    d = docs(spark, [(1, good, "s"), (2, good.upper().replace(".", "!!"), "s"), (3, "a | b | c | d | e |\n" * 10, "s")])
    got = {r.doc_id: (r.kept, r.cleaned) for r in line_rules.line_rules(d).collect()}
    assert got[1] == (True, good) and not got[2][0] and not got[3][0]


LINES = {
    "symbols": ["a | b | c | d | e |", "### *** %%% one"],
    "shouting": ["BUY NOW AND SAVE a LOT", "THIS IS AN OFFER"],
    "repetition": ["spam " * 12 + "and eggs.", "a b " * 8 + "."],
    "boilerplate": ["Read our Privacy Policy for more about what we keep of you.", "Alle Rechte vorbehalten.", "© 2024 Firma, tous droits réservés dans le monde entier.", "Todos los derechos reservados, Madrid 2024.", "Home Login", "Impressum", "Subscribe: newsletter, contact us"],
    "links": ["http://example.com/a www.example.org", "mail me@example.com"],
    "menu": ["Sport · Politics · Arts · Weather", "News - Local - Abroad"],
    "counter": ["12.05.2024 10:33", "Page 2 of 14", "3 comments"],
    "navigation": ["Latest reports", "Sport"],
    "unfinished": ["What the minister said about the bridge", "Ten ways to cook a pumpkin"],
}
PROSE = ["He left, and nobody knew why.", "She said - and he believed it - that it was late.", "In 1990, 2000 came.", "Everyone is at home by the evening, and we share what there is.", "One word more?", "The town lies at the foot of a hill from which one sees as far as the sea when it is clear", "El tiempo pasa y nadie vuelve.", "Der Kontakt zu den Nachbarn brach im Winter nach dem Streit um den Zaun ab."]


@pytest.mark.parametrize("rule", LINES)
def test_each_line_rule(rule):
    assert [line_rules.failing(x.encode()) for x in LINES[rule]] == [rule] * len(LINES[rule])


def test_prose_passes_line_rules():
    assert [line_rules.failing(x.encode()) for x in PROSE] == [None] * len(PROSE)
    wrapped = b"The river rose in the night and\nby morning the lower fields were\n\n under water.\nThe river rose in the night and\nThen"
    assert [rule for _, rule in line_rules.judged(wrapped)] == [None, None, None, "unfinished", "navigation"]


def test_line_rules_equal_their_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    lines = [*(x for part in LINES.values() for x in part), *PROSE, "", " \t ", "élan vital et plus encore»", "ends in a quote ”"]
    texts = [None, "", *lines, "\n".join(lines)] + ["\n".join(random.Random(i).choices(lines, k=9)) for i in range(200)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    got = line_rules.line_rules(spark.read.parquet(f"{tmp_path}/d"), with_text=False).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = con.execute(line_rules.SQL).df()[list(got.columns)]
    rows = lambda df: sorted(map(tuple, df.values.tolist()))
    assert rows(got) == rows(want)


def lm_rows():
    return [(i, prose(i, 80, vocabulary(1, 50)), "s") for i in range(80)] + [(200, "zqxj wvkq" * 20, "s"), (201, None, "s")]


def test_language_model_scores(spark, monkeypatch):
    rows = lm_rows()
    found = lambda: {r.doc_id: r for r in context_mixing.score(docs(spark, rows), F.col("doc_id") >= 60).collect()}
    got = found()
    assert got[70].bits_per_byte < 2 < got[200].bits_per_byte and got[201].n_tokens == 1
    seen = Counter(w for i, t, _ in rows if i < 60 for w in [*t.split(), None])
    total = sum(seen.values())
    for i, t, _ in rows:
        w = [*(t or "").split(), None]
        assert got[i].base_score == pytest.approx(sum(np.log10((seen[x] + 1) / (total + len(seen) + 1)) for x in w)) and got[i].train_tokens == total
        assert (got[i].n_tokens, got[i].n_known) == (len(w), sum(seen[x] > 0 for x in w))
    # words and windows that don't go to the tasks meet theirs in joins
    monkeypatch.setattr(context_mixing, "TOP", 20)
    monkeypatch.setattr(context_mixing, "PART", 1000)
    few = found()
    assert all(few[i].base_score == pytest.approx(got[i].base_score) and few[i].n_known == got[i].n_known for i in got)
    assert all(few[i].score == pytest.approx(got[i].score, rel=0.1) for i in range(80))


def test_counts_of_contexts_by_brute_force():
    texts = [t.encode() for _, t, _ in lm_rows()[:20]]
    packed, owner = context_mixing.windows(texts)
    raw = [bytes(7) + t + b"\0" for t in texts]
    at = [(t, i) for t, x in enumerate(raw) for i in range(7, len(x))]
    assert [t for t, _ in at] == owner.tolist()

    def context(x, i, order):
        out = x[i - order : i]
        far = out[: max(0, order - context_mixing.ACROSS)]
        for k in range(order, context_mixing.ACROSS, -1):  # beyond ACROSS bytes only within the word
            if any(c in b" \t\n\x0b\x0c\r\0" for c in x[i - k + 1 : i]):
                far = far[: order - k] + b"\0" + far[order - k + 1 :]
        return far + out[max(0, order - context_mixing.ACROSS) :]

    keys, n = np.unique(packed, return_counts=True)
    three, back = np.unique(context_mixing._low(keys, context_mixing.SPLIT), return_inverse=True)
    levels = context_mixing.seen(keys, n, (three, np.bincount(back, n).astype(np.int64)))
    where = {k: i for i, k in enumerate(keys.tolist())}
    for o, order in enumerate(context_mixing.ORDERS):
        want = Counter()
        for t, i in at:
            for bit in range(9):
                want[context(raw[t], i, order), bit, raw[t][i] >> (8 - bit)] += 1
        for j in range(0, len(at), 37):
            t, i = at[j]
            assert [levels[o, bit, where[packed[j]]] for bit in range(9)] == [want[context(raw[t], i, order), bit, raw[t][i] >> (8 - bit)] for bit in range(9)]


def test_probabilities_of_all_bytes_add_up():
    packed, _ = context_mixing.windows([t.encode() for _, t, _ in lm_rows()[:40]])
    keys, n = np.unique(packed, return_counts=True)
    every = np.unique(np.concatenate([keys, *((keys[100:104] & ~np.int64(255)) | np.int64(b) for b in range(256))]))
    n = np.where(np.isin(every, keys), n[np.minimum(np.searchsorted(keys, every), len(keys) - 1)], 0)
    three, back = np.unique(context_mixing._low(every, context_mixing.SPLIT), return_inverse=True)
    levels = context_mixing.seen(every, n, (three, np.bincount(back, n).astype(np.int64)))
    weights, sums = context_mixing.learn(every, n, levels)
    p = 10 ** context_mixing.costs(every, levels, weights, context_mixing.refined(sums))
    for k in keys[100:104]:
        assert p[(every & ~np.int64(255)) == (k & ~np.int64(255))].sum() == pytest.approx(1, abs=1e-6)


def best_by_brute_force(rows, every, k):
    """Sorted (query_id, rank, vec_id, score) in Python integers."""
    use = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in use:
        if i % every == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in use if j != i and len(v) == len(q))[:k]
            out += [(i, r, j, max(min(-s, 2**63 - 1), 1 - 2**63)) for r, (s, j) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 50])
def test_top_k_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(no_random_access, "BLOCK", block)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(400, 8))
    v[7] = v[9] = v[0]
    rows = [(i, [float(x) for x in v[i]]) for i in range(400)]
    rows += [(900, None), (1000, [float("nan")] * 8), (1100, [1.0, None] * 4), (1200, []), (1300, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(0, rows[0][1])] * 15 + [(2000 + i, [float(i), 1.0]) for i in range(0, 300, 50)] + [(500, [3e6, 1.0, 1.0, 1.0]), (501, [1.0, 2.0, 3.0, -4.0]), (600, [-3e6, 2.0, 1.0, 0.0])]
    rows += [(700, [1e300, 1.0, -1.0]), (701, [1.7e308, 2.0, 5.0]), (702, [-1e300, 3.0, 1.0]), (703, [0.5, 3.0, 1.0]), (704, [0.25, 3.0, 1.0])]
    got = no_random_access.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash")), 100, 5).collect()
    assert sorted(tuple(r) for r in got) == best_by_brute_force(rows, 100, 5)
    assert sum(r.query_id == 0 for r in got) == 16 * 5


def test_top_k_of_an_empty_table(spark):
    assert no_random_access.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def best_of(v, queries, k=10, block=256):
    """What Best keeps of vectors that come by falling length, with the pairs whose scores it resolved."""
    best, order, resolved = no_random_access.Best(np.arange(queries), v[:queries], k), np.argsort(-(v * v).sum(axis=1)), 0
    keep = best._keep

    def counted(query, score, vector):
        nonlocal resolved
        resolved += len(query)
        keep(query, score, vector)

    best._keep = counted
    for at in range(0, len(v), block):
        best.read(order[at : at + block], v[order[at : at + block]])
    got = [[] for _ in range(queries)]
    for a, score, i in zip(best.query, best.score, best.vector, strict=True):
        got[a].append((int(score), int(i)))
    return got, resolved, best.share


@pytest.mark.parametrize("kind", ["normal", "decaying", "lengths", "ties", "zeros", "copies"])
def test_bounds_close_before_all_is_read(kind):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(4096, 32))
    v = {"normal": v, "decaying": v / np.arange(1, 33), "lengths": v * rng.lognormal(0, 1.5, (4096, 1)), "ties": np.sign(v), "zeros": v * 0, "copies": v[rng.integers(0, 9, 4096)]}[kind]
    got, resolved, share = best_of(v, 40)
    w = no_random_access.whole(v)
    for i in range(40):
        assert got[i] == [(-a, j) for a, j in sorted((-int(x), j) for j, x in enumerate(w @ w[i]) if j != i)[:10]]
    if kind in ("normal", "decaying", "lengths"):
        assert resolved < 40 * 4096 / 20
    if kind in ("decaying", "lengths"):
        assert share is None or share < 1


def test_queries_pass_over_blocks_that_cannot_reach():
    rng = np.random.default_rng(9)
    near, far = rng.normal(size=(512, 16)), rng.normal(size=(2048, 16)) / 1000
    best = no_random_access.Best(np.arange(20), near[:20], 10)
    best.read(np.arange(512), near)
    floor = best.floor.copy()
    best.read(np.arange(512, 2560), far)
    assert best.share is None and (best.floor == floor).all() and (best.vector < 512).all()


def test_packing_round_trip(spark):
    rows = [(i, prose(i, 5 + i * 37 % 900), "s") for i in range(60)]
    p = packing.pack(docs(spark, rows)).toPandas()
    ids = {i: packing.token_ids(t.encode()) for i, t, _ in rows}
    for r in p.itertuples():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids[r.doc_id])
    for _, s in p.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= 1024 and (s["offset"] == s["length"].cumsum() - s["length"]).all()
    assert p["length"].sum() == sum(map(len, ids.values()))


def test_plan_meets_the_histogram():
    h = {k: (k * 7919) % 97 for k in range(1, 129) if (k * 7919) % 97}
    combos = packing.plan(h)
    used = Counter()
    for parts, n in combos:
        assert sum(parts) <= 128
        for p in parts:
            used[p] += n
    assert dict(used) == h


def test_token_ids_match_the_json_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text in ["Hello  world\n\n it's", "éàü ☃ 日本", "a<|endoftext|>b", "", "   ", "x" * 3000]:
        assert packing.token_ids(text.encode()).tolist() == [*t.encode(text, add_special_tokens=False).ids, 0]
