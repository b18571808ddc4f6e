"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target size / source size. The documents of a source
stand in one fixed order; the running sum of expected copies plus one random offset of the source is followed, and a
document is emitted once per whole number that its own step crosses. Order: size class, then a hash of the
identifier, so that neighbours are of similar size and the words taken stay within about one large document of the target.

Defined cases: a null or empty text has size 0 and is emitted like any other document, taking no words; a null source is
a source of its own, ordered last; repeated rows are separate documents; a source without words has target 0 and takes
no copy; an empty table gives an empty result; other columns are ignored, or carried along unread where asked for.

The running sums are made level by level (documents of a bucket, buckets and heads of a size class, classes of a source),
so that no task holds more than one bucket of one size class, even if one source or one size has most of the rows. Sources are
ordered in runs dealt by range, so as many as there are documents are no burden to one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import Stages
from .common import significant_bits, staged, table, word_count

#: Weights by place of the source, repeating; share of all sizes; most that a source may give, times its size.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def _in_runs(stages: Stages, rows: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """Rows with their ``place`` from 0 in an order without ties, and ``before_<column>``: the sum of a column over all earlier rows.

    The rows are dealt to runs by range and written, so that runs stay as they are; places are counted within a run, behind the totals
    of the runs before it. Only these totals, a row for each run, are ordered as a whole.
    """
    runs = stages.add(rows.repartitionByRange(*order).withColumn("run", F.spark_partition_id()), "mix-runs")
    counted = [F.lit(1).alias("one"), *(F.col(c) for c in sums)]
    names = ["one", *sums]
    earlier = W.orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    totals = runs.select("run", *counted).groupBy("run").agg(*(F.sum(c).alias(c) for c in names))
    starts = totals.select("run", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"start_{c}") for c in names))
    within = W.partitionBy("run").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    before = lambda c, x: (F.coalesce(F.sum(x).over(within), F.lit(0)) + F.col(f"start_{c}"))
    return runs.join(starts, "run").select(
        *rows.columns, before("one", F.lit(1)).alias("place"), *(before(c, F.col(c)).alias(f"before_{c}") for c in sums)
    )


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source_key, source_size, target) from one row (source, source_size) per source.

    Sources reach their cap in the order of cap / weight. If the first i are full, the others stand at the level
    (total - their caps) / (the other weights); the level rises with every source that is full and falls
    after the first that is not, so its maximum is the common level, and a target is the smaller of cap and level.
    """
    by_name = F.col("source").asc_nulls_last()
    with Stages(sizes.sparkSession) as stages:
        named = _in_runs(stages, sizes.select("source", "source_size"), [by_name], [])
        weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
        weighed = named.withColumn("weight", weight).drop("place").withColumn("top", F.lit(float(cap)) * F.col("source_size"))
        weighed = weighed.withColumn("ratio", F.col("top") / F.col("weight"))
        filled = stages.add(_in_runs(stages, weighed, [F.col("ratio"), by_name], ["top", "weight"]).drop("place"), "mix-filled")
        total, weights_of_all = filled.agg(F.sum("source_size"), F.sum("weight")).first()
        level = (F.lit(float(share)) * F.lit(total) - F.col("before_top")) / (F.lit(weights_of_all) - F.col("before_weight"))
        highest = filled.agg(F.max(level)).first()[0]
        goal = F.least("top", F.col("weight") * F.lit(highest)).cast("double").alias("target")
        return staged(filled.select(_key(F.col("source")).alias("source_key"), "source_size", goal), "mix-targets")


def _uniform(text: Column) -> Column:
    """A number in [0, 1) from a text, the same in every run."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def _before(within: list[str], order: str) -> Column:
    """Members of what comes earlier in the order, within the same group."""
    earlier = W.partitionBy(*within).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("members").over(earlier), F.lit(0))


def sized(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """What mixing needs of a document, and the carried columns as one struct."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    held = [F.struct(*carry).alias("held")] if carry else []
    return docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").alias("source"), word_count(F.col("text")).alias("size"),
        digest.alias("digest"), *held,
    )


def mix(
    spark: SparkSession, documents: DataFrame, seed: str = "mix", weights: Sequence[float] = WEIGHTS,
    share: float = SHARE, cap: float = CAP,
) -> DataFrame:
    """``sized`` rows plus source_size, target and copies (0 to ``cap``) of each."""
    placed = documents.select(
        "*", _key(F.col("source")).alias("source_key"), significant_bits(F.col("size")).alias("size_class"),
        F.substring("digest", 1, 3).alias("bucket"),
    )
    stages = Stages(spark)
    groups = stages.add(
        placed.groupBy("source_key", "size_class", "bucket").agg(
            F.first("source").alias("source"), F.count(F.lit(1)).alias("members"), F.sum("size").alias("words")
        ),
        "mix-groups",
    )
    classes = groups.groupBy("source_key", "size_class").agg(
        F.first("source").alias("source"), F.sum("members").alias("members"), F.sum("words").alias("words")
    )
    sources = classes.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    goal = targets(sources.drop("source_key"), weights, share, cap)

    # Where a bucket starts, level by level: classes of a source, heads (first digit) of a class, buckets of a head.
    by_class, by_head = ["source_key", "size_class"], ["source_key", "size_class", "head"]
    headed = groups.withColumn("head", F.substring("bucket", 1, 1))
    heads = headed.groupBy(*by_head).agg(F.sum("members").alias("members"))
    starts = classes.select(*by_class, _before(["source_key"], "size_class").alias("class_start")).join(goal, "source_key")
    starts = heads.select(*by_head, _before(by_class, "head").alias("head_start")).join(starts, by_class)
    starts = headed.select(*by_head, "bucket", _before(by_head, "bucket").alias("bucket_start")).join(starts, by_head)
    starts = starts.withColumn("start", F.col("class_start") + F.col("head_start") + F.col("bucket_start"))
    with stages:  # the groups are not needed any more once the starts are written
        starts = staged(starts.drop("head", "class_start", "head_start", "bucket_start"), "mix-starts")

    place = W.partitionBy("source_key", "size_class", "bucket").orderBy("digest", "size")
    rank = F.row_number().over(place)
    step = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = _uniform(F.concat(F.lit(f"{seed}:"), F.col("source_key")))
    crossed = F.floor(offset + step * F.col("rank")) - F.floor(offset + step * (F.col("rank") - 1))
    return (
        placed.withColumn("rank_in_bucket", rank)
        .join(starts, ["source_key", "size_class", "bucket"])
        .withColumn("rank", F.col("start") + F.col("rank_in_bucket"))
        .withColumn("copies", F.least(crossed, F.lit(int(-(-cap // 1)))).cast("long"))
        .drop("source_key", "size_class", "bucket", "digest", "rank_in_bucket", "start", "rank")
    )


def repeated(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves: every row as often as it is taken, with the columns of ``docs``."""
    mixed = mix(spark, sized(docs, docs.columns), **options)
    again = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return mixed.filter("copies > 0").select("held", again.alias("again")).select("held.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, target and words taken of every document."""
    documents = staged(sized(table(spark, sf_dir, "documents")), "mix-sizes")
    return mix(spark, documents).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


ORACLE = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    case when source is null then 'n' else 's' || source end as source_key,
    md5(coalesce(doc_id::varchar, '')) as digest
  from documents),
classed as (
  select *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) as size_class from sized),
sources as (
  select source_key, source, sum(size)::bigint as source_size from classed group by 1, 2),
weighed as (
  select *, (case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end)::double
    as weight
  from sources),
levels as (
  select *, (1.5::double * sum(source_size) over ()
      - coalesce(sum(2.0::double * source_size) over (order by 2.0::double * source_size / weight, source nulls last
          rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by 2.0::double * source_size / weight, source nulls last
          rows between current row and unbounded following) as level
  from weighed),
goals as (
  select source_key, source_size, least(2.0::double * source_size, weight * max(level) over ()) as target,
    ('0x' || substr(md5('mix:' || source_key), 1, 8))::bigint / 4294967296.0::double as shift
  from levels),
ranked as (
  select *, row_number() over (partition by source_key order by size_class, digest, size) as place from classed)
select doc_id, size, source_size, target,
  (size * case when source_size = 0 then 0 else
    floor(shift + target / source_size * place) - floor(shift + target / source_size * (place - 1)) end)::bigint as taken
from ranked join goals using (source_key)
"""
