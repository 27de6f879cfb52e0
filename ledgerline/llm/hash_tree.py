"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

A tree names regions, their racks and the racks' shards with a weight each; a rack weighs what its shards weigh, a region what
its racks weigh. A key descends the tree: at each level every child draws the number -ln(u) / weight, with u from the hash of
the seed, the child's name and the key, and the smallest draw wins, so that a child gets its weight's share of the keys. A
draw depends on the child and the key alone: if weights change under one rack, keys move between the children of the
nodes above it only as far as those weights changed, and no key moves between subtrees whose weights stayed. A shard that is
added by grow() comes as a region of its own, so that every key which moves goes to it and to none beside it.

Placing a row needs its key and the tree, which is a literal in the plan: no shuffle, no join, and only the levels on the
key's way are drawn. Numbers within the shards (slots) come from one aggregation of equal rows, sums over buckets of about
BUCKET_ROWS rows that the hash of the rows orders, and running sums inside the buckets.

Defined results: a null key is placed as the text 'null'; a null text is empty (size 1); a child of weight 0 gets nothing, and a tree
without weight is refused; equal rows get slots of their own; an empty table gives no rows. Columns of docs with the operator's
names (size, text_crc32, law, shard, slot, grown_shard) are replaced, others pass through place() and write_shards().
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._spark import Stash, sized

SEED = 20240311
#: Rows that one bucket of a shard holds about while slots are given.
BUCKET_ROWS = 50_000

#: region -> rack -> shard -> weight.
Tree = dict[str, dict[str, dict[int, float]]]


def even_tree(shards: int = 8, racks: int = 2, per_rack: int = 2) -> Tree:
    """A tree of equal shards: so many of them a rack, so many racks a region."""
    tree: Tree = {}
    for s in range(shards):
        rack = s // per_rack
        tree.setdefault(f"region{rack // racks}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    return tree


def grow(tree: Tree, shard: int, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region and a rack of its own."""
    if any(shard in shards for racks in tree.values() for shards in racks.values()):
        raise ValueError(f"shard {shard} is in the tree")
    return tree | {f"added{shard}": {f"added{shard}": {shard: float(weight)}}}


def _checked(tree: Tree) -> Tree:
    shards = [(s, w) for racks in tree.values() for own in racks.values() for s, w in own.items()]
    if len({s for s, _ in shards}) < len(shards):
        raise ValueError("a shard stands twice in the tree")
    if any(not (math.isfinite(w) and w >= 0) for _, w in shards) or not any(w for _, w in shards):
        raise ValueError("weights must be finite, not negative and not all 0")
    return tree


def _key_text(key: str) -> Column:
    return F.coalesce(F.col(key).cast("string"), F.lit("null"))


def _winner(children: list[tuple[str, float]], key: Column, seed: int) -> Column:
    """The position of the child that draws the smallest number."""
    live = [(i, name, w) for i, (name, w) in enumerate(children) if w > 0]
    if len(live) == 1:
        return F.lit(live[0][0])

    def draw(name: str, weight: float) -> Column:
        bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:{name}:"), key)), 1, 13), 16, 10).cast("double")
        return -F.ln((bits + 0.5) / 2.0**52) / F.lit(float(weight))

    return F.array_min(F.array(*(F.struct(draw(name, w).alias("draw"), F.lit(i).alias("at")) for i, name, w in live)))["at"]


def shard_of(key: Column, tree: Tree, seed: int = SEED) -> Column:
    """The shard of a key (text), by weighted draws at each level."""
    tree = _checked(tree)
    pick = lambda at, cases: F.coalesce(*(F.when(at == i, c) for i, c in cases)) if len(cases) > 1 else cases[0][1]
    regions = []
    for i, (region, racks) in enumerate(tree.items()):
        weight = sum(sum(s.values()) for s in racks.values())
        if not weight:
            continue
        in_region = []
        for j, (rack, shards) in enumerate(racks.items()):
            if sum(shards.values()):
                at = _winner([(f"{region}/{rack}/{s}", w) for s, w in shards.items()], key, seed)
                in_region.append((j, pick(at, [(k, F.lit(s)) for k, (s, w) in enumerate(shards.items()) if w])))
        at = _winner([(f"{region}/{rack}", sum(s.values())) for rack, s in racks.items()], key, seed)
        regions.append((i, pick(at, in_region)))
    at = _winner([(region, sum(sum(s.values()) for s in racks.values())) for region, racks in tree.items()], key, seed)
    return pick(at, regions).cast("int")


def place(docs: DataFrame, tree: Tree | None = None, grown: Tree | None = None, key: str = "doc_id", seed: int = SEED) -> DataFrame:
    """docs' columns, law ('key'), shard by the tree and grown_shard by the grown tree (by default with one more shard of weight 1)."""
    tree = tree or even_tree()
    if grown is None:
        grown = grow(tree, 1 + max(s for racks in tree.values() for own in racks.values() for s in own))
    return docs.withColumns({"law": F.lit("key"), "shard": shard_of(_key_text(key), tree, seed), "grown_shard": shard_of(_key_text(key), grown, seed)})


def write_shards(docs: DataFrame, path: str, tree: Tree | None = None, key: str = "doc_id", seed: int = SEED) -> None:
    """Writes each shard's rows, whole, to path/shard=N. Rows aren't shuffled first: every task appends a file to each shard that it has rows of."""
    docs.withColumn("shard", shard_of(_key_text(key), tree or even_tree(), seed)).write.partitionBy("shard").parquet(path)


def with_slots(placed: DataFrame, seed: int = SEED) -> DataFrame:
    """placed (narrow columns: doc_id, size, text_crc32, law, shard, grown_shard) with slot: numbers from 0 without gaps in each shard, ordered by a hash of doc_id and text_crc32."""
    text = F.concat(F.lit(f"slot:{seed}:"), _key_text("doc_id"), F.lit(":"), F.col("text_crc32").cast("string"))
    drawn = placed.withColumn("draw", F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long"))
    # equal rows are counted before they are put in order, so that copies don't gather in one bucket
    groups = Stash(drawn.groupBy(*drawn.columns).agg(F.count("*").alias("copies")))
    total = groups.read().agg(F.sum("copies").alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // BUCKET_ROWS))
    dealt = groups.read().withColumn("bucket", F.floor(F.col("draw") / F.lit(2.0**52) * buckets).cast("int"))
    counts = dealt.groupBy("shard", "bucket").agg(F.sum("copies").alias("rows"))
    before = counts.withColumn("before", F.sum("rows").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("rows")).drop("rows")
    run = Window.partitionBy("shard", "bucket").orderBy("draw", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = dealt.withColumn("last", F.sum("copies").over(run)).join(sized(Stash(before).read()), ["shard", "bucket"])
    first = F.col("before") + F.col("last") - F.col("copies")
    slots = F.explode(F.sequence(first, F.col("before") + F.col("last") - 1))
    return ended.select("doc_id", "size", "text_crc32", "law", "shard", slots.alias("slot"), "grown_shard")


def shard(docs: DataFrame, tree: Tree | None = None, grown: Tree | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs (doc_id, text). size: UTF-8 bytes and 1; text_crc32: of the UTF-8 bytes."""
    bytes_ = F.coalesce("text", F.lit("")).cast("binary")
    narrow = docs.select("doc_id", (F.octet_length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"))
    return with_slots(place(narrow, tree, grown, seed=seed), seed)


def _draw_sql(name: str) -> str:
    return f"-ln((('0x' || substr(md5('{SEED}:{name}:' || k), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE)"


def _pick_sql(children: list[tuple[str, float, str]]) -> str:
    """SQL that takes the value of the child (name, weight, value) with the smallest draw."""
    return "list_sort([" + ", ".join(f"{{'draw': {_draw_sql(n)} / {float(w)}::DOUBLE, 'value': {v}}}" for n, w, v in children) + "])[1].value"


def _tree_sql(tree: Tree) -> str:
    regions = []
    for region, racks in tree.items():
        own = [(f"{region}/{rack}", sum(s.values()), _pick_sql([(f"{region}/{rack}/{n}", w, str(n)) for n, w in s.items()])) for rack, s in racks.items()]
        regions.append((region, sum(w for _, w, _ in own), _pick_sql(own)))
    return _pick_sql(regions)


#: The same in DuckDB, which has no crc32: its table of 256 remainders is made first, then folded over each text's bytes.
SQL = f"""
WITH tab AS (SELECT list(c ORDER BY n) AS tab FROM (SELECT n, list_reduce(range(0, 8), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, n) AS c FROM (SELECT unnest(range(0, 256)) AS n))),
d AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS k, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, k, bytes + 1 AS size, xor(list_reduce(list_transform(range(0, bytes), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32 FROM d, tab),
p AS (SELECT doc_id, size, text_crc32, {_tree_sql(even_tree())}::INT AS shard, {_tree_sql(grow(even_tree(), 8))}::INT AS grown_shard,
  ('0x' || substr(md5('slot:{SEED}:' || k || ':' || text_crc32), 1, 13))::BIGINT AS draw FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY draw, doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard FROM p
"""
