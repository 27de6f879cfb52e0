"""Join of two lists of names by edit distance, with asymmetric q-chunks.

The index side cuts each name into disjoint chunks of q characters (the last one filled up), the probing side takes the q-gram
at every position. An edit of one character touches one chunk, an exchange of two neighbours up to two, so of a name's chunks at most
2 * edits are lost: of its 2 * edits + 1 chunks that are rarest among the probes at least one stands in every name that qualifies, no
further than `edits` places away. A chunk's key holds its number, and a gram probes the numbers whose places are that near.

Names of at most 2 * edits chunks have no chunk to spare and are handled exhaustively: both sides list all that is left
of a name when up to `edits` characters are taken out, and two names within that distance have one of these in common.

Names under one key meet inside a sort-merge join whose condition compares how often letters occur (64 bits a name; two
names within the distance differ in at most 2 * edits of them) and then the bounded Levenshtein distance, which is at most
twice the wanted one. Only what passes leaves the join; the exact distance is then taken by dynamic programming over Arrow batches.

Equal names are one row on each side before keys are made. A key's share of all meetings decides over how many parts it
is dealt: the probing names are spread, the indexed ones repeated. Only keys above a share of 1 / PARTS have several parts, so the table
of them has at most PARTS rows, and is the only one that is broadcast.

Characters are code points, and names are compared as they are. Defined results: null and empty names take no part; a null id is kept (it has
no crc32 and is never the smallest); a repeated row counts again; an empty side gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._spark import Stash, map_arrow

EDITS, Q = 2, 3
#: Parts into which all meetings of names under keys are dealt at least; copies of a name's few result rows that meet its ids.
PARTS, SPREAD = 1024, 16
_FILL = "\x01"


def _letters(name: str) -> Column:
    """64 bits: for 16 classes of characters whether at least 1, 2, 3, 4 of the name's are of it."""
    classes = f"transform(sequence(1, length({name})), i -> cast(pmod(shiftright(ascii(substr({name}, i, 1)) * 2654435761L, 7), 16) * 4 as int))"
    return F.expr(f"aggregate({classes}, 0L, (m, b) -> m | shiftleft(((shiftright(m, b) & 15L) * 2 + 1) & 15L, b))")


def _chunk_keys(q: int) -> Column:
    """Keys of a name's chunks."""
    return F.expr(f"transform(sequence(0, cast(ceil(length(name) / {q}) as int) - 1), i -> xxhash64(i, substr(filled, i * {q} + 1, {q})))")


def _gram_keys(q: int, edits: int) -> Column:
    """Keys that a name's q-grams probe: with the number of each chunk that may stand there."""
    near = f"sequence(cast(greatest(0, ceil((a - {edits}) / {q})) as int), cast(floor((a + {edits}) / {q}) as int))"
    numbers = f"if(ceil((a - {edits}) / {q}) > floor((a + {edits}) / {q}), cast(array() as array<int>), {near})"
    return F.expr(f"array_distinct(flatten(transform(sequence(0, length(name) - 1), a -> transform({numbers}, i -> xxhash64(i, substr(filled, a + 1, {q}))))))")


def _rest_keys(edits: int) -> Column:
    """Keys of all that is left of a name when up to `edits` characters are taken out."""
    left = shorter = F.array("name")
    for _ in range(edits):
        one_less = lambda v: F.when(F.length(v) > 0, F.transform(F.sequence(F.lit(1), F.length(v)), lambda i: F.concat(F.substr(v, F.lit(1), i - 1), F.substr(v, i + 1)))).otherwise(F.array().cast("array<string>"))
        shorter = F.array_distinct(F.flatten(F.transform(shorter, one_less)))
        left = F.array_union(left, shorter)
    return F.transform(left, lambda v: F.xxhash64(F.lit("rest"), v))


def _named(rows: DataFrame, q: int) -> DataFrame:
    """(name, letters, filled) of distinct names."""
    return rows.select("name", _letters("name").alias("letters"), F.concat("name", F.lit(_FILL * (q - 1))).alias("filled"))


def _distances(edits: int):
    """Keeps pairs (v, c) of names within the distance of optimal string alignment."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                v, c = (batch.column(batch.schema.get_field_index(x)) for x in "vc")
                d = alignment(v.to_pylist(), c.to_pylist(), edits)
                keep = pa.array(d <= edits)
                yield pa.RecordBatch.from_arrays([v.filter(keep), c.filter(keep), pa.array(d.astype(np.int32)).filter(keep)], names=["v", "c", "distance"])

    return run


def _codes(names: list[str], fill: int) -> tuple[np.ndarray, np.ndarray]:
    points = [np.frombuffer(n.encode("utf-32-le", "surrogatepass"), np.uint32) for n in names]
    sizes = np.array([len(p) for p in points])
    out = np.full((len(names), int(sizes.max(initial=0)) + 1), fill, np.int64)
    for row, p in zip(out, points, strict=True):
        row[: len(p)] = p
    return out, sizes


def alignment(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """Optimal string alignment distance of each pair; edits + 1 stands for all that is more. Only cells within `edits` of the diagonal are filled."""
    x, nx = _codes(a, -1)
    y, ny = _codes(b, -2)
    most = edits + 1
    out = np.full(len(a), most, np.int64)
    width = int(ny.max(initial=0))
    rows = [np.minimum(np.tile(np.arange(width + 1), (len(a), 1)), most)]
    for i in range(int(nx.max(initial=0)) + 1):
        if i:
            row = np.full((len(a), width + 1), most, np.int64)
            row[:, 0] = min(i, most)
            for j in range(max(1, i - edits), min(width, i + edits) + 1):
                best = np.minimum(rows[-1][:, j - 1] + (x[:, i - 1] != y[:, j - 1]), np.minimum(rows[-1][:, j], row[:, j - 1]) + 1)
                if i > 1 and j > 1:
                    exchanged = (x[:, i - 1] == y[:, j - 2]) & (x[:, i - 2] == y[:, j - 1])
                    best = np.where(exchanged, np.minimum(best, rows[-2][:, j - 2] + 1), best)
                row[:, j] = np.minimum(best, most)
            rows = [*rows[-1:], row]
        done = np.flatnonzero(nx == i)
        out[done] = rows[-1][done, ny[done]]
    return out


def similar_names(indexed: DataFrame, probing: DataFrame, edits: int = EDITS, q: int = Q) -> DataFrame:
    """(v, c, distance): every pair of a name of indexed and one of probing (each with distinct names in `name`, none null or empty) within the distance, once."""
    v = Stash(_named(indexed, q))
    c = Stash(_named(probing, q))
    spare = 2 * edits * q  # names up to this length have at most 2 * edits chunks
    long_v, short_v = v.read().where(F.length("name") > spare), v.read().where(F.length("name") <= spare)
    grams = c.read().where(F.length("name") > spare - edits).select("name", "letters", F.explode(_gram_keys(q, edits)).alias("key"))
    rests = c.read().where(F.length("name") <= spare + edits).select("name", "letters", F.explode(_rest_keys(edits)).alias("key"))

    seen = grams.groupBy("key").agg(F.count("*").alias("seen"))
    chunks = long_v.select("name", "letters", F.explode(_chunk_keys(q)).alias("key"))
    met = chunks.join(seen.hint("merge"), "key", "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    rarest = Window.partitionBy("name").orderBy("seen", "key")
    # a chunk that no probe has can't be the one in common, but it counts among the 2 * edits + 1
    chosen = Stash(met.withColumn("rank", F.row_number().over(rarest)).where((F.col("rank") <= 2 * edits + 1) & (F.col("seen") > 0)).drop("rank"))

    work = chosen.read().groupBy("key").agg((F.count("*") * F.first("seen")).alias("work"))
    total = work.agg(F.sum("work")).first()[0] or 1
    share = F.ceil(F.col("work") * PARTS / F.lit(int(total))).cast("int")
    parted = Stash(work.select("key", share.alias("parts")).where("parts > 1"))  # at most PARTS keys have so large a share
    few = F.broadcast(parted.read())
    kept = chosen.read().drop("seen").join(few, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    dealt = grams.join(few, "key", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("name"), F.col("parts")), F.lit(0)).cast("int")).drop("parts")

    kept = kept.unionByName(short_v.select("name", "letters", F.explode(_rest_keys(edits)).alias("key"), F.lit(0).alias("part")))
    dealt = dealt.unionByName(rests.withColumn("part", F.lit(0)))
    kept = kept.select("key", "part", F.col("name").alias("v"), F.col("letters").alias("v_letters"))
    dealt = dealt.select("key", "part", F.col("name").alias("c"), F.col("letters").alias("c_letters"))
    near = (F.bit_count(F.col("v_letters").bitwiseXOR(F.col("c_letters"))) <= 2 * edits) & (F.levenshtein("v", "c", 2 * edits) >= 0)
    on = (F.col("l.key") == F.col("r.key")) & (F.col("l.part") == F.col("r.part")) & near
    pairs = dealt.alias("l").join(kept.alias("r").hint("merge"), on).select("v", "c").distinct()
    return map_arrow(pairs, _distances(edits), "v string, c string, distance int")


def name_join(clients: DataFrame, vendors: DataFrame, edits: int = EDITS, q: int = Q) -> DataFrame:
    """(vendor_id, distance, n_clients, first_client_id, clients_crc) for each vendor of vendors (vendor_id, name) and each distance at which clients (client_id, name) have names like its own.

    clients_crc: the sum of the unsigned crc32 of each client's id as text.
    """
    named = lambda rows: rows.where("name is not null and name <> ''")
    crc = F.crc32(F.col("client_id").cast("string").cast("binary"))
    held = named(clients).groupBy("name").agg(F.count("*").alias("n_clients"), F.min("client_id").alias("first_client_id"), F.sum(crc).alias("clients_crc"))
    held = Stash(held)
    asked = named(vendors).select("vendor_id", "name")
    pairs = similar_names(asked.select("name").distinct(), held.read().select("name"), edits, q)
    per_name = pairs.join(held.read().withColumnRenamed("name", "c").hint("merge"), "c").groupBy("v", "distance").agg(
        F.sum("n_clients").alias("n_clients"), F.min("first_client_id").alias("first_client_id"), F.sum("clients_crc").alias("clients_crc")
    )
    # a name that very many vendors share has at most edits + 1 rows here: they are repeated, the vendors dealt
    per_name = per_name.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("vendor_id"), F.lit(SPREAD)).cast("int")).withColumnRenamed("name", "v")
    rows = asked.join(per_name.hint("merge"), ["v", "part"])
    totals = rows.groupBy("vendor_id", "distance").agg(F.sum("n_clients").alias("n_clients"), F.min("first_client_id").alias("first_client_id"), F.sum("clients_crc").alias("clients_crc"))
    return totals


def misspelt(vendors: DataFrame) -> DataFrame:
    """vendors with two neighbouring characters of the name exchanged where the crc32 of vendor_id is even; a null id or name and names of one character stay as they are."""
    h = F.crc32(F.col("vendor_id").cast("string").cast("binary"))
    at = (h % (F.length("name") - 1)).cast("int")
    turned = F.concat(F.substr("name", F.lit(1), at), F.substr("name", at + 2, F.lit(1)), F.substr("name", at + 1, F.lit(1)), F.substr("name", at + 3))
    return vendors.withColumn("name", F.when((h % 2 == 0) & (F.length("name") >= 2), turned).otherwise(F.col("name")))


#: The same in DuckDB, by the distance's recursion over all pairs of names whose lengths fit; crc32 as remainders folded over an id's digits.
SQL = """
WITH tab AS (SELECT list(c ORDER BY n) AS tab FROM (SELECT n, list_reduce(range(0, 8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n) AS c FROM (SELECT unnest(range(0, 256)) AS n))),
cl AS (SELECT client_id, name, xor(list_reduce(list_transform(string_split(CAST(client_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS crc FROM clients, tab WHERE name <> ''),
ve AS (SELECT vendor_id, name, length(name) AS n, xor(list_reduce(list_transform(string_split(CAST(vendor_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS h FROM vendors, tab WHERE name <> ''),
vm AS (SELECT vendor_id, CASE WHEN h % 2 = 0 AND n >= 2 THEN substr(name, 1, h % (n - 1)) || substr(name, h % (n - 1) + 2, 1) || substr(name, h % (n - 1) + 1, 1) || substr(name, h % (n - 1) + 3) ELSE name END AS name FROM ve),
p AS (SELECT v.name AS v, c.name AS c, string_split(v.name, '') AS x, string_split(c.name, '') AS y FROM (SELECT DISTINCT name FROM vm) v JOIN (SELECT DISTINCT name FROM cl) c ON abs(length(v.name) - length(c.name)) <= 2),
d AS (SELECT v, c, list_reduce(range(1, len(x) + 1), lambda s, i: {'two': s.one, 'one': list_reduce(range(1, len(y) + 1), lambda r, j: list_append(r, least(r[j] + 1, s.one[j + 1] + 1, s.one[j] + (x[i] <> y[j])::BIGINT,
  CASE WHEN i > 1 AND j > 1 AND x[i] = y[j - 1] AND x[i - 1] = y[j] THEN s.two[j - 1] + 1 ELSE 1000000 END)), [i])}, {'two': range(0, len(y) + 1), 'one': range(0, len(y) + 1)}).one[-1] AS distance FROM p)
SELECT vendor_id, distance::INT AS distance, count(*) AS n_clients, min(client_id) AS first_client_id, sum(crc)::BIGINT AS clients_crc
FROM d JOIN vm ON vm.name = d.v JOIN cl ON cl.name = d.c WHERE distance <= 2 GROUP BY vendor_id, distance
"""
