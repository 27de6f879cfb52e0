import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import compact_windows, context_mixing, packing, quality_trees, queries, setsketch

TABLES = Path("/root/testdata")
needs_tables = pytest.mark.skipif(not TABLES.exists(), reason="needs the driver's tables")


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(n)]


def prose(seed, n, words=None):
    r = random.Random(seed)
    return " ".join(r.choice(words or vocabulary(0)) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "xx", s, len(t or ""), "q") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, row string")


def near(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in ((x or "").lower().split() for x in (a, b))]
    return bool(sets[0] and sets[1]) and 100 * len(sets[0] & sets[1]) >= 80 * len(sets[0] | sets[1])


def test_near_dedup_keeps_one_of_each_group_by_brute_force(spark):
    rows = []
    for g in range(10):
        base = prose(g, 60).split()
        for c in range(1 + g % 4):
            w = list(base)
            for _ in range(c):
                w[random.Random(9 * g + c).randrange(60)] = f"x{c}"
            rows.append((len(rows) * 7 % 31, " ".join(w), "s"))
    rows += [(200, None, "s"), (201, "", "s"), (202, "one", None), (203, "one", None), (None, rows[0][1], "s")]
    part = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(rows):
            for j, b in enumerate(rows):
                if None not in (a[0], b[0]) and near(a[1], b[1]):
                    part[i] = part[j] = min(part[i], part[j])
    groups = {}
    for i, p in enumerate(part):
        groups.setdefault(p, []).append(rows[i][0])
    got = corpus_pipeline.near_dedup(spark, documents(spark, rows), "")
    assert got.columns == documents(spark, rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == sorted((None in ids, min(ids) if None not in ids else 0) for ids in groups.values())


def test_texts_that_share_a_doc_id(spark):
    one, two = prose(1, 40), prose(2, 40)
    rows = [(1, one, "s"), (5, one, "s"), (5, two, "s"), (3, two, "s"), (5, "", "s")]
    found = sorted((r.doc_id, r.n_shingles, r.component_id) for r in setsketch.near_duplicates(documents(spark, rows)).collect())
    assert found == [(1, 36, 1), (3, 36, 1), (5, 0, 5), (5, 36, 1), (5, 36, 1)]
    # the pipeline goes by texts: of each of the two one row stays
    kept = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect())
    assert kept == [(1, one), (3, two), (5, "")]
    apart = [(5, one, "s"), (5, two, "s"), (5, two, "s")]
    assert sorted(r.text for r in corpus_pipeline.near_dedup(spark, documents(spark, apart), "").collect()) == sorted([one, two])


def test_substring_stage_takes_later_places_only(spark):
    passage = prose(77, 60, vocabulary(5))
    rows = [(i, f"{prose(100 + i, 80, vocabulary(200 + i))} {passage if i % 2 else ''} {prose(300 + i, 40, vocabulary(400 + i))}", "s") for i in range(6)] + [(9, None, "s")]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.substring_dedup(spark, documents(spark, rows), "").collect()}
    held = [i for i, (t, _) in got.items() if t and passage in t]
    assert set(got) == {*range(6), 9} and held == [1] and all(n == len(t) for t, n in got.values() if t and passage not in t)
    assert got[0][0] == rows[0][1] and got[9][0] is None


def test_substring_stage_takes_all_that_any_earlier_document_holds(spark, monkeypatch):
    """Of three near copies the later two go on alike for some words: these go with the third, though the first, which it is like too, ends before them."""
    monkeypatch.setattr(compact_windows, "CROWD", 2)  # each key has more places
    rows, groups = [], 12
    for g in range(groups):
        passage = prose(80_000 + g, 68, vocabulary(80_000 + g)).split()
        held = [passage[:30], passage[31:60], *([*passage[:30], f"changed{g}x{k}", *passage[31 : 68 if k else 60]] for k in range(3))]
        rows += [(10 * g + k, f"{prose(81_000 + 20 * g + k, 40, vocabulary(81_000 + 20 * g + k))} {' '.join(p)} {prose(82_000 + 20 * g + k, 40, vocabulary(82_000 + 20 * g + k))}", "s") for k, p in enumerate(held)]
    texts = {i: t.split() for i, t, _ in rows}
    got = {r.doc_id: r.text.split() for r in corpus_pipeline.substring_dedup(spark, documents(spark, rows), "").collect()}
    for i, words in texts.items():
        gone = [*words[:40], *words[100:]] if i % 10 == 3 else [*words[:40], *words[108:]] if i % 10 == 4 else words
        assert got[i] == gone, (i, len(words), len(got[i]))


def test_mixing_and_packing_stages(spark):
    rows = [(i, prose(i, 30), "big" if i % 4 else None) for i in range(300)]
    mixed = corpus_pipeline.source_mixing(spark, documents(spark, rows), "")
    sizes = dict(mixed.groupBy("source").agg(F.sum(F.length("text"))).collect())
    assert set(sizes) == {"big", None} and 0.6 < sizes["big"] / sizes[None] < 1.6 and mixed.columns == documents(spark, rows).columns
    pieces = corpus_pipeline.packed(spark, mixed, "").toPandas()
    n = Counter(r.doc_id for r in mixed.collect())
    for doc, part in pieces.groupby("doc_id"):
        assert part["length"].sum() == n[doc] * len(packing.token_ids(rows[doc][1].encode()))
    assert (pieces.groupby("sequence_id")["length"].sum() <= 1024).all()


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[1:]])
def test_stages_of_an_empty_table(spark, stage):
    assert stage(spark, documents(spark, []), "").collect() == []


@needs_tables
def test_quality_stage_and_whole_run(spark):
    folder = f"{TABLES}/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality(spark, docs, folder).select("doc_id").collect()}
    scored = {r.doc_id: r.predicted for r in queries.op3_quality_classifier(spark, folder).collect()}
    assert kept == {i for i, p in scored.items() if p}
    pieces = corpus_pipeline.run(spark, folder).toPandas()
    assert set(pieces["doc_id"]) <= kept and (pieces.groupby("sequence_id")["length"].sum() <= 1024).all()
    # gapless and each id in one piece
    for _, part in pieces.sort_values("offset").groupby("sequence_id"):
        assert (part["offset"] == part["length"].cumsum() - part["length"]).all()


@needs_tables
def test_held_out_quality(spark):
    folder = f"{TABLES}/sf0.1"
    found = queries.op3_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality"), "doc_id")
    rows = found.where("held_out").select("predicted", "quality", "score").collect()
    assert len(rows) > 500 and np.mean([r.predicted == r.quality for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


@needs_tables
def test_pieces_of_a_whole_table_against_the_json_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    folder = f"{TABLES}/sf0.01"
    ids = {r.doc_id: np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    pieces = queries.op10_packing(spark, folder).toPandas()
    for r in pieces.itertuples():
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
    assert pieces.groupby("doc_id")["length"].sum().to_dict() == {i: len(x) for i, x in ids.items()}
    sequences = pieces.groupby("sequence_id")["length"].sum()
    assert sequences.max() <= 1024 and sequences.sum() / (1024 * len(sequences)) > 0.98


def test_white_space_that_runs_on(spark):
    rows = [(1, " " * 1_000_000, "s"), (2, "a" + "\n" * 400_000 + "b", "s"), (3, "x", "s")]
    pieces = packing.pack(documents(spark, rows)).toPandas()
    assert pieces.groupby("doc_id")["length"].sum().to_dict()[1] == 1_000_001 and set(pieces["doc_id"]) == {1, 2, 3}


@needs_tables
def test_held_out_texts_cost_less_than_under_words_alone(spark):
    found = context_mixing.score(spark.read.parquet(f"{TABLES}/sf0.1/documents.parquet"), quality_trees.held_out(7, 2)).join(spark.read.parquet(f"{TABLES}/sf0.1/documents.parquet").select("doc_id", quality_trees.held_out(7, 2).alias("held_out")), "doc_id")
    sums = found.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def changed(words, kind, r):
    w, n = list(words), len(words)
    if kind == "inserted":
        w.insert(n // 2, "inserted")
    elif kind == "deleted":
        del w[r.randrange(5, n - 5)]
    else:
        for _ in range(1 if n < 90 else 2):
            w[r.randrange(5, n - 5)] = f"changed{r.randrange(99)}"
    return w


def test_recall_of_passages_that_are_alike(spark):
    """Pairs with a similarity of 0.8 or more over five-word shingles, by brute force; found where nine tenths of the words are."""
    r, rows, cases, words = random.Random(5), [], {}, vocabulary(1, 3000)
    for kind in ("inserted", "deleted", "substituted"):
        for n in (60, 100):
            for _ in range(40):
                base = [r.choice(words) for _ in range(n)]
                edited = changed(base, kind, r)
                if not near(" ".join(base), " ".join(edited)):
                    continue
                i = len(rows)
                for k, t in enumerate((base, edited)):
                    own = [r.choice(words) for _ in range(80)]
                    rows.append((i + k, " ".join([*own[:40], *t, *own[40:]]), "s"))
                cases[i + 1] = (kind, n, len(edited))
    hit = {i: np.zeros(400, bool) for i in cases}
    for p in compact_windows.repeated_passages(documents(spark, rows)).collect():
        hit[p.doc_id][p.start : p.start + p.n_words] = True
    recall = {}
    for i, (kind, n, size) in cases.items():
        recall.setdefault((kind, n), []).append(hit[i][40 : 40 + size].mean() > 0.9)
    assert all(np.mean(v) >= 0.85 for v in recall.values()) and np.mean([x for v in recall.values() for x in v]) >= 0.95
    assert all(not h[:30].any() for h in hit.values())
