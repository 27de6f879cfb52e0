"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source with share w of the target size T and size s in the corpus is repeated at the mean rate w * T / s. A document's
number of copies is the quantile of the Poisson distribution with that mean at a number in [0, 1) that md5 draws from
the seed and the doc_id, so it's the same in every run and on every machine, and needs no shuffle of the texts. Copies are
exploded and then ordered globally by another hash.

Defined results: a null source is a source of its own; a null text has size 0 and is repeated at its source's rate;
a null doc_id is drawn as the text 'null'; repeated rows get the same number of copies; a source that target weights
don't name has rate 0; a source so small that its rate is above MOST is refused with a message; an empty table or a size of 0 gives no rows. Columns besides doc_id, text and source pass through;
the operator's own columns are replica, rate and shuffle_key, and a column of docs with such a name is dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._spark import Stash, sized

SEED = 20240229
OWN = ("replica", "rate", "shuffle_key")
#: The largest mean number of copies that is carried out, and copies that are listed at a time.
MOST, COPIES = 1e9, 4096


def _draw(label: str, *columns):
    """52 bits of md5 of the label and columns."""
    text = F.concat_ws(":", F.lit(label), *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None) -> DataFrame:
    """(source, rate): the mean number of copies. weights: shares of the target by source (any scale), None: equal. size: the target in characters, None: as large as docs."""
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.lit(1.0))
    else:
        table = docs.sparkSession.createDataFrame([(str(k), float(v)) for k, v in weights.items()] or [("", 0.0)], "named string, weight double")
        weighed = sizes.join(F.broadcast(table), F.col("source") == F.col("named"), "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    # every row of sizes is one source; their totals are one row
    totals = weighed.agg(F.sum("size").alias("total"), F.sum("weight").alias("weights"))
    target = F.col("total") if size is None else F.lit(float(size))
    rate = F.when((F.col("size") > 0) & (F.col("weights") > 0), F.col("weight") / F.col("weights") * target / F.col("size")).otherwise(0.0)
    return weighed.join(F.broadcast(totals)).select("source", rate.alias("rate"))


def _steps(rates: DataFrame) -> DataFrame:
    """(source, rate, lo, cdf): the distribution function at lo, lo + 1, ... Beyond 12 deviations and 20 on either side of the rate nothing is left, so a list is as long as the root of its rate."""
    wide = 12 * F.sqrt("rate") + 20
    lo, hi = F.greatest(F.lit(0), F.floor(F.col("rate") - wide)).cast("long"), F.ceil(F.col("rate") + wide).cast("long")
    rows = rates.select("source", "rate", lo.alias("lo"), hi.alias("hi")).select("source", "rate", "lo", F.explode(F.sequence("lo", "hi")).alias("k"))
    every = Window.partitionBy("source")
    run = every.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    # each mass by its ratio to the one before, in logarithms from the largest on, so that no large numbers cancel
    step = F.when((F.col("k") > F.col("lo")) & (F.col("rate") > 0), F.log1p((F.col("rate") - F.col("k")) / F.col("k"))).otherwise(0.0)
    logs = rows.withColumn("log", F.sum(step).over(run)).withColumn("most", F.max("log").over(every))
    mass = F.when(F.col("rate") > 0, F.exp(F.col("log") - F.col("most"))).otherwise(F.when(F.col("k") == 0, 1.0).otherwise(0.0))
    sums = logs.withColumn("mass", mass).withColumn("sum", F.sum("mass").over(run))
    cdf = sums.withColumn("cdf", F.col("sum") / F.max("sum").over(every))
    return cdf.groupBy("source", "rate", "lo").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "cdf"))), lambda x: x["cdf"]).alias("cdf"))


def with_copies(docs: DataFrame, rates: DataFrame, seed: int = SEED) -> DataFrame:
    """docs' columns, rate and copies (long): how many times each document stands in the mix. rates: (source, rate)."""
    rates = Stash(rates.select("source", "rate"))
    if beyond := rates.read().where(F.col("rate") > MOST).first():
        raise ValueError(f"source {beyond['source']!r} would be repeated {beyond['rate']:.3g} times, more than {MOST:.0e}: give weights or a size that ask for less")
    small = sized(Stash(_steps(rates.read())).read().withColumnRenamed("source", "step_source"))
    drawn = docs.alias("d").join(small, F.col("d.source").eqNullSafe(F.col("step_source")))
    # an array of one element binds the draw, which is hashed once and compared with every step
    copies = F.transform(F.array(_draw(f"copies:{seed}", "d.doc_id") / F.lit(2.0**52)), lambda u: F.col("lo") + F.size(F.filter("cdf", lambda x: x <= u)))[0]
    return drawn.select(*(F.col(f"d.`{c}`") for c in docs.columns), "rate", copies.alias("copies"))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, size: float | None = None, seed: int = SEED) -> DataFrame:
    """docs' columns, replica (from 1), rate and shuffle_key, ordered by shuffle_key: each document as many times as its draw says."""
    docs = docs.drop(*OWN)
    names = dict.fromkeys(docs.columns)
    copies, first = (next(n for n in (c, *(f"{c}_{i}" for i in range(len(names)))) if n not in names) for c in ("copies", "first"))
    counted = with_copies(docs, source_rates(docs, weights, size), seed).toDF(*docs.columns, "rate", copies).where(F.col(copies) > 0)
    # copies are listed by blocks, so that no array is as long as their number
    blocks = counted.withColumn(first, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies), F.lit(COPIES).cast("long"))))
    numbers = F.sequence(F.col(first), F.least(F.col(copies), F.col(first) + (COPIES - 1)))
    out = blocks.select(*(F.col(f"`{c}`") for c in docs.columns), "rate", F.explode(numbers).alias("replica")).withColumn("replica", F.col("replica").cast("int"))
    out = out.withColumn("shuffle_key", _draw(f"order:{seed}", "doc_id", "replica"))
    # keys are spread evenly over 52 bits, so the bounds of ranges are known without a look at the rows
    parts = int(spark_conf(docs, "spark.sql.shuffle.partitions"))
    share = F.floor(F.col("shuffle_key") / F.lit(2.0**52) * parts).cast("int")
    return out.repartitionById(parts, share).sortWithinPartitions("shuffle_key", "replica")


def spark_conf(df: DataFrame, name: str) -> str:
    return df.sparkSession.conf.get(name)


#: The same in DuckDB: equal weights, the corpus' own size.
SQL = f"""
WITH sizes AS (SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source),
rates AS (SELECT source, CASE WHEN size > 0 THEN 1.0::DOUBLE / (count(*) OVER ())::DOUBLE * (sum(size) OVER ()) / size ELSE 0 END AS rate FROM sizes),
k AS (SELECT source, rate, unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k FROM rates),
logs AS (SELECT *, sum(CASE WHEN k > 0 THEN ln(k) ELSE 0 END) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS lf FROM k),
cdf AS (SELECT source, rate, k, sum(CASE WHEN rate > 0 THEN exp(k * ln(rate) - rate - lf) WHEN k = 0 THEN 1.0 ELSE 0.0 END) OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS cdf FROM logs),
steps AS (SELECT source, rate, list(cdf ORDER BY k) AS cdf FROM cdf GROUP BY source, rate),
drawn AS (SELECT d.doc_id, d.text, d.source, s.rate, len(list_filter(s.cdf, lambda x: x <= ('0x' || substr(md5('copies:{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)) AS copies
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source),
copied AS (SELECT doc_id, text, source, rate, CAST(unnest(range(1, copies + 1)) AS INTEGER) AS replica FROM drawn)
SELECT doc_id, text, source, round(rate, 9) AS rate, replica, ('0x' || substr(md5('order:{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || replica), 1, 13))::BIGINT AS shuffle_key FROM copied
"""
