"""Mix sources to target weights by systematic sampling of whole documents.

A source's documents stand in order of size; each has the same expected number of
copies. The prefix sum of these, shifted by one random offset of the source, crosses
an integer once for every copy to emit. As neighbours in the order have like sizes,
the words taken follow the target closely without any further draw.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import WORD, ranked, written_table

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: No document is taken more often.
MOST_COPIES = 3


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(*parts: Column) -> Column:
    """60 bits of the MD5 of the parts as text, as a long."""
    text = F.concat_ws("/", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target, rate and offset of every source of ``rows`` (source, size).

    Targets share the total size by weight; none exceeds ``most`` times its source's
    size, and what is cut off is shared again among the others by weight. In the order
    of size per weight a source is cut off exactly if its limit is below its share of
    what the sources before it have left. One row per source passes the window.
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    sums = sums.withColumn("weight", cycle).withColumn("limit", F.col("source_size") * most)
    every = Window.partitionBy()
    ahead = Window.orderBy(F.col("limit") / F.col("weight"), "source").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(ahead), F.lit(0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))
    sums = sums.withColumns({"left": left, "open_weight": open_weight})
    # limit / weight <= left / open_weight, in whole numbers
    sums = sums.withColumn("cut", F.col("limit") * F.col("open_weight") <= F.col("left") * F.col("weight"))
    first = F.min(F.when(~F.col("cut"), F.struct(F.col("limit") / F.col("weight"), "source", "left", "open_weight"))).over(every)
    sums = sums.withColumn("first", first)
    share = F.col("first.left").cast("double") * F.col("weight") / F.col("first.open_weight")
    target = F.when(F.col("cut"), F.col("limit").cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = draw(F.lit("offset"), F.col("source")) % 65536 / 65536.0
    return sums.withColumn("target", target).select("source", "source_size", "target", rate.alias("rate"), offset.alias("offset"))


def copies(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``rows`` (doc_id, source, size and more) with source_size, target and copies."""
    rows = written_table(rows, "sizes")
    targets = written_table(source_targets(rows, weights, most), "targets").withColumnRenamed("source", "_source")
    placed = ranked(rows.withColumn("_draw", draw(F.col("doc_id"))), ["source"], ["size", "_draw", "doc_id"], "_rank")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("_source")))
    until = F.floor(F.col("_rank") * F.col("rate") + F.col("offset"))
    since = F.floor((F.col("_rank") - 1) * F.col("rate") + F.col("offset"))
    return joined.withColumn("copies", until - since).drop("_draw", "_rank", "_source", "rate", "offset")


def mix_plan(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and copies of every row of ``docs``.

    A null text has size 0; null sources are one source and come last; a source
    without words has target 0 and takes nothing. Rows with equal ids count one by one.
    An empty table gives an empty result. Other columns are not read. The draws are
    hashes of ids and sources, so reruns agree.
    """
    return copies(docs.select("doc_id", "source", size_in_words(F.col("text")).alias("size")))


def mix(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as it is taken.

    Rows are told apart by a number written with them, so repeated and null ids lose
    nothing; see ``mix_plan`` for sizes and targets. All columns are kept as they are.
    """
    words = size_in_words(F.col("text")).alias("size")
    rows = docs.select(F.struct("*").alias("document"), F.monotonically_increasing_id().alias("row"), words)
    rows = written_table(rows, "numbered")
    plan = copies(rows.select("row", "document.doc_id", "document.source", "size"))
    taken = plan.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.select("row", "document").join(taken, "row").select("document.*")


MIX_SQL = r"""
with sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as draw
  from documents
), sums as (
  select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
  from sizes group by source
), filled as (
  select *, 3 * source_size as most,
    sum(source_size) over () - coalesce(sum(3 * source_size) over w, 0) as remaining,
    sum(weight) over () - coalesce(sum(weight) over w, 0) as open_weight
  from sums
  window w as (order by 3 * source_size / weight, source nulls first rows between unbounded preceding and 1 preceding)
), cut as (
  select *, most * open_weight <= remaining * weight as capped from filled
), level as (
  select arg_max(remaining, open_weight)::double as remaining, max(open_weight) as open_weight from cut where not capped
), targets as (
  select source, source_size,
    case when capped then most::double else level.remaining * weight / level.open_weight end as target,
    ('0x' || substr(md5('offset/' || coalesce(source, '')), 1, 15))::bigint % 65536 / 65536.0::double as shift
  from cut left join level on true
), placed as (
  select s.doc_id, s.size, t.source_size, t.target, t.shift,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
    row_number() over (partition by s.source order by s.size, s.draw, s.doc_id) as place
  from sizes s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
  ((floor(place * rate + shift) - floor((place - 1) * rate + shift)) * size)::bigint as taken
from placed
"""
