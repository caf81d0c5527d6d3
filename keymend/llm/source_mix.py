"""Mixing sources to target weights by a low-discrepancy schedule (DataFrame functions only).

Targets: sources, by code point with null last, weigh 5, 2, 1, repeating, and share all words;
a target stops at MAX_EPOCHS times its source's words and the excess is shared again.
Schedule: slot t is the point frac((t + 1/2) / golden ratio) of the unit interval, and belongs to the source whose
stretch of the cumulative targets holds the point; so any run of slots holds every source in its
proportion. A source's slots are ranked by t. Its documents form a shuffled stream (by md5 of the
id), repeated MAX_EPOCHS times and cut into blocks of equally many words; slot of rank r takes block r.

Prefix sums over the slots and documents of a source are taken in two levels (chunks, then
within a chunk), so a hot source is never in one task.

Cases: null or empty texts have size 0 and are never taken; a null source is a source of its
own; rows that repeat a doc_id each have a place in the stream and report what is taken of them; rows with a null doc_id
come last in their source's stream, by md5 of the text; a table without words takes nothing; empty tables give empty results; extra input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keymend.llm.common import attach, documents, stash

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
GOLDEN = 0.6180339887498949
#: Words in a block at most; shorter where the table would have under MIN_SLOTS slots.
BLOCK_WORDS = 1024
MIN_SLOTS = 65536
#: Rows or slots in a chunk of the two-level prefix sums.
CHUNK = 20000
#: Cells of the unit interval that slots and sources meet in; as many as there are sources, if that is more.
GRID = 1024


def targets(sources: DataFrame) -> DataFrame:
    """Adds weight and target to (src, source, source_size, cnt), one row per source. Unordered
    windows over one row per source: the only part that isn't dealt out."""
    one = Window.partitionBy(F.lit(1))
    ordered = one.orderBy(F.col("source").isNull(), F.col("source"))
    rank = (F.row_number().over(ordered) - 1) % len(WEIGHTS)
    weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank + 1).cast("int")))
    limit = F.col("source_size") * MAX_EPOCHS
    # sources stop in the order of limit / weight: one stops if it is above its share of what those before leave
    by = one.orderBy(limit / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(one) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    stopped = weighed.withColumn("stops", limit * F.sum("weight").over(after) <= left * F.col("weight"))
    rest = F.sum("source_size").over(one) - F.coalesce(F.sum(F.when(F.col("stops"), limit)).over(one), F.lit(0))
    free = F.sum(F.when(~F.col("stops"), F.col("weight"))).over(one)
    share = rest.cast("double") * F.col("weight") / free
    return stopped.withColumn("target", F.when(F.col("stops"), limit.cast("double")).otherwise(share)).drop("stops")


def schedule(goals: DataFrame, total: int, block: int, n_sources: int = 1) -> DataFrame:
    """src, slot, rank: the source of each slot and the slot's number within its source. A cell that many small
    sources share holds few slots: slots and sources meet about slots * (1 + sources / grid) times."""
    spark, grid = goals.sparkSession, max(GRID, n_sources)
    upto = Window.partitionBy(F.lit(1)).orderBy(F.col("source").isNull(), F.col("source"))
    ends = goals.withColumn("high", F.sum("target").over(upto) / F.lit(float(max(total, 1))))
    last = F.lead("src").over(upto).isNull()
    ends = ends.select("src", F.lag("high", 1, 0.0).over(upto).alias("low"), F.when(last, 2.0).otherwise(F.col("high")).alias("high"))
    cells = ends.filter("high > low").select("src", "low", "high", F.explode(F.sequence(
        F.floor(F.least(F.col("low"), F.lit(1.0)) * grid), F.floor(F.least(F.col("high"), F.lit(1.0)) * grid))).alias("cell"))
    point = (F.col("slot") + 0.5) * GOLDEN
    slots = spark.range(-(-total // block)).withColumnRenamed("id", "slot").withColumn("x", point - F.floor(point))
    slots = slots.withColumn("cell", F.floor(F.col("x") * grid))
    hit = slots.join(cells, "cell").filter("x >= low and x < high").select("src", "slot", F.floor(F.col("slot") / CHUNK).alias("chunk"))
    return _ranked(hit, "slot", F.lit(1).cast("long"), "rank").select("src", "slot", "rank")


def _ranked(rows: DataFrame, order: str, amount, name: str) -> DataFrame:
    """Adds the sum of `amount` over the rows before, by source, chunk and `order`."""
    rows = rows.withColumn("_n", amount)
    sums = rows.groupBy("src", "chunk").agg(F.sum("_n").alias("_s"))
    before = Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("src", "chunk", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("src", "chunk").orderBy(order, *(["doc_id", "row"] if "doc_id" in rows.columns else []))
    run = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    return rows.withColumn("_run", run).join(sums, ["src", "chunk"]).withColumn(name, F.col("_base") + F.col("_run")).drop("_n", "_run", "_base")


def mix_sources(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, src, size, source_size, target) and the mix: slot, row, doc_id, low, high
    (words of the document that the slot takes, as a half-open range, and the epoch). `row` numbers the rows of
    `docs`, in no order."""
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    src = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    late = F.when(F.col("doc_id").isNull(), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    rows = stash(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", src.alias("src"), size.alias("size"), late.alias("late")), "sizes")
    sources = rows.groupBy("src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("cnt"))
    goals = stash(targets(sources), "targets")
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = max(1, min(BLOCK_WORDS, total // MIN_SLOTS))
    placed = attach(rows.drop("source"), goals.drop("source", "weight"), "src", count)
    slots = stash(schedule(goals, total, block, goals.count()), "slots")
    # null ids after all others, in chunks of their own
    code = F.coalesce(F.md5(F.concat(F.lit("mix:"), F.col("doc_id").cast("string"))), F.concat(F.lit("~"), F.col("late")))
    chunks = F.ceil(F.col("cnt") / CHUNK)
    stream = placed.filter("size > 0").withColumn("code", code)
    digits = F.substring(F.ltrim(F.col("code"), F.lit("~")), 1, 8)
    chunk = F.floor(F.conv(digits, 16, 10).cast("double") / 2**32 * chunks)
    stream = stream.withColumn("chunk", F.when(F.col("late").isNull(), chunk).otherwise(chunk + chunks))
    stream = _ranked(stream.select("row", "doc_id", "src", "size", "source_size", "code", "chunk"), "code", F.col("size"), "at")
    stream = stream.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(MAX_EPOCHS - 1))))
    begin = F.col("at") + F.col("epoch") * F.col("source_size")
    stream = stream.withColumn("begin", begin).withColumn("end", begin + F.col("size"))
    parts = stream.select("row", "doc_id", "src", "epoch", "begin", "end", F.explode(F.sequence(
        F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))).alias("rank"))
    low, high = F.greatest("begin", F.col("rank") * block), F.least("end", (F.col("rank") + 1) * block)
    mix = parts.join(slots, ["src", "rank"]).select(
        "slot", "row", "doc_id", "epoch", (low - F.col("begin")).alias("low"), (high - F.col("begin")).alias("high"))
    return placed.drop("late"), mix


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(documents(spark, sf_dir))


def source_mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of `docs` (doc_id, text, source)."""
    rows, mix = mix_sources(docs)
    taken = mix.groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return rows.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


OP5_SQL = r"""
with sized as (
  select doc_id, source, cast(case when text is null then 0 else len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) end as bigint) as size,
         md5('mix:' || doc_id) as code, source is null as no_source from documents),
src as (
  select source, no_source, cast(sum(size) as bigint) as source_size, count(*) as cnt,
         case (row_number() over (order by no_source, source) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as weight
  from sized group by source, no_source),
tot as (select cast(sum(source_size) as bigint) as total from src),
sk as (
  select *, 3 * source_size * sum(weight) over (o rows between current row and unbounded following)
         <= (total - coalesce(sum(3 * source_size) over (o rows between unbounded preceding and 1 preceding), 0)) * weight as stops
  from src, tot window o as (order by 3 * source_size / cast(weight as double), no_source, source)),
goal as (
  select *, case when stops then cast(3 * source_size as double)
            else cast(total - coalesce(sum(case when stops then 3 * source_size end) over (), 0) as double) * weight
                 / sum(case when not stops then weight end) over () end as target,
         greatest(1, least(1024, total // 65536)) as block
  from sk),
cum as (
  select *, sum(target) over (order by no_source, source rows unbounded preceding) / cast(total as double) as high,
         lead(no_source) over (order by no_source, source) is null as final from goal),
ends as (
  select *, coalesce(lag(high) over (order by no_source, source), 0.0) as low, case when final then 2.0 else high end as top from cum),
slots as (
  select x - floor(x) as x from (select (cast(i as double) + 0.5) * 0.6180339887498949 as x
    from tot, lateral (select unnest(range(cast(ceil(total / cast(greatest(1, least(1024, total // 65536)) as double)) as bigint))) as i))),
used as (
  select e.*, (select count(*) from slots s where s.x >= e.low and s.x < e.top) as n from ends e),
stream as (
  select doc_id, source, no_source, size, sum(size) over (partition by no_source, source order by code, doc_id rows unbounded preceding) - size as at from sized)
select s.doc_id, s.size, u.source_size, u.target,
       cast(case when s.size = 0 then 0 else
         least(u.n * u.block, 3 * u.source_size) // u.source_size * s.size
         + greatest(0, least(s.size, least(u.n * u.block, 3 * u.source_size) % u.source_size - s.at)) end as bigint) as taken
from stream s join used u on s.no_source = u.no_source and s.source is not distinct from u.source
"""
