import random
import zlib
from collections import defaultdict

import pytest

from ledgerline.llm import q_chunks


def alignment(a, b):
    """Optimal string alignment distance, by its recursion."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows[-1][-1]


def edited(r, name, times, letters):
    for _ in range(times):
        at = r.randrange(len(name) + 1)
        kind = r.randrange(4)
        if kind == 0:
            name = name[:at] + r.choice(letters) + name[at:]
        elif kind == 1:
            name = name[:at] + name[at + 1 :]
        elif kind == 2:
            name = name[:at] + r.choice(letters) + name[at + 1 :]
        else:
            name = name[:at] + name[at : at + 2][::-1] + name[at + 2 :]
    return name


@pytest.mark.parametrize("edits, q", [(2, 3), (1, 2), (2, 2)])
def test_pairs_against_all_pairs(spark, edits, q):
    """Names of all lengths over few letters, so that far more than the planted pairs are near each other."""
    r = random.Random(edits * 10 + q)
    letters = "abé☃𝒳 "
    base = ["".join(r.choice(letters) for _ in range(r.choice([1, 2, 3, 5, 8, 11, 12, 13, 14, 15, 16, 18, 25]))) for _ in range(120)]
    left = sorted({edited(r, n, r.randint(0, 2), letters) for n in base} - {""})
    right = sorted({edited(r, n, r.randint(0, 3), letters) for n in base for _ in range(3)} - {""})
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    found = q_chunks.similar_names(frame(left), frame(right), edits, q).collect()
    wanted = {(v, c, d) for v in left for c in right if abs(len(v) - len(c)) <= edits and (d := alignment(v, c)) <= edits}
    assert len(found) == len({(p.v, p.c) for p in found})
    assert {tuple(p) for p in found} == wanted and len(wanted) > 200


def test_planted_edits_of_long_names(spark):
    """Two exchanges that each straddle two chunks lose four chunks of five."""
    name = "abcdefghijklm"
    turned = "abdcefghikjlm"  # places 3|4 and 10|11 of chunks abc def ghi jkl m
    frame = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    found = q_chunks.similar_names(frame(name), frame(turned, "abdcefghikjml", name[::-1]))
    assert [tuple(x) for x in found.collect()] == [(name, turned, 2)]


def test_bounded_distances_against_recursion():
    r = random.Random(4)
    a = ["".join(r.choice("ab𝒳") for _ in range(r.randint(0, 9))) for _ in range(3000)]
    b = [edited(r, n, r.randint(0, 4), "ab𝒳") for n in a]
    for edits in (0, 1, 2, 3):
        assert q_chunks.alignment(a, b, edits).tolist() == [min(alignment(x, y), edits + 1) for x, y in zip(a, b, strict=True)]


def crc(x):
    return zlib.crc32(str(x).encode())


def test_join_with_odd_rows(spark):
    clients = [(1, "Anna Berg"), (2, "Anna Berg"), (2, "Anna Berg"), (3, ""), (4, None), (None, "Ana Berg"), (5, "anna berg"), (6, "A"), (7, "BC"), (8, "Anna  Berg"), (9, "Annaliese Bergström-Holm"), (10, "Annaliese Bergströ-mHolm")]
    vendors = [(1, "Anna Berg"), (1, "Anna Berg"), (2, ""), (3, None), (None, "Anna Berg"), (4, "AB"), (5, "Annaliese Bergström-Holm")]
    c = spark.createDataFrame([(*x, "z") for x in clients], "client_id long, name string, v string")
    v = spark.createDataFrame([(*x, 1) for x in vendors], "vendor_id long, name string, distance int")
    wanted = defaultdict(list)
    for vendor_id, v_name in vendors:
        for client_id, c_name in clients:
            if v_name and c_name and (d := alignment(v_name, c_name)) <= 2:
                wanted[vendor_id, d].append(client_id)
    found = {(x.vendor_id, x.distance): (x.n_clients, x.first_client_id, x.clients_crc) for x in q_chunks.name_join(c, v).collect()}
    assert found == {k: (len(ids), min((i for i in ids if i is not None), default=None), sum(crc(i) for i in ids if i is not None) if any(i is not None for i in ids) else None) for k, ids in wanted.items()}
    assert q_chunks.name_join(c.where("false"), v).count() == 0
    assert q_chunks.name_join(c, v.where("false")).count() == 0


def test_hot_keys_are_dealt_over_parts(spark, monkeypatch):
    """Half of all names share a beginning: its key has several parts, and no pair is lost."""
    monkeypatch.setattr(q_chunks, "PARTS", 16)
    r = random.Random(1)
    tail = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    left = sorted({"common start " + tail(6) for _ in range(60)} | {tail(18) for _ in range(60)})
    right = sorted({edited(r, n, 2, "abcdefgh") for n in left} | {"common start " + tail(6) for _ in range(300)})
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "name string")
    found = {tuple(p) for p in q_chunks.similar_names(frame(left), frame(right)).collect()}
    assert found == {(v, c, d) for v in left for c in right if (d := alignment(v, c)) <= 2}


def test_misspelling(spark):
    rows = [(i, n) for i in range(40) for n in ("Zoë 𝒳y", "ab", "a", "", None)] + [(None, "abc")]

    def turned(i, n):
        if i is None or not n or len(n) < 2 or crc(i) % 2:
            return n
        at = crc(i) % (len(n) - 1)
        return n[:at] + n[at + 1] + n[at] + n[at + 2 :]

    found = q_chunks.misspelt(spark.createDataFrame(rows, "vendor_id long, name string")).collect()
    assert [tuple(x) for x in found] == [(i, turned(i, n)) for i, n in rows]
