"""Mixing sources to target weights by systematic sampling (operator 1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import fresh, WORD, stored, table

#: Copies are counted in units of 2**-20, so that prefix sums are exact integers.
UNIT = 1 << 20
#: Slices of a size class. A window holds the documents of one source, one size
#: class (an eighth of an octave) and one slice; no source is ever in one window.
SLICES = 256


def word_count(text: Column) -> Column:
    """Words of ``text``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """Target size of each source, from rows (source, source_size).

    Sources in code point order, null last, get ``weights`` in turn and share
    the sum of all sizes in proportion. A target stops at ``limit`` times its
    source's size and the excess goes to the others by weight, until none is
    above: the level at which the pool runs dry, found with running sums over
    the sources by the level at which each is full. The input has one row per
    source, already summed.
    """
    position = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighted = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), ((position - 1) % len(weights) + 1).cast("int"))
        .cast("long")
        .alias("weight"),
        (F.col("source_size") * limit).alias("cap"),
    )
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fullest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = weighted.select(
        "*",
        F.sum("source_size").over(everything).alias("pool"),
        F.sum("weight").over(everything).alias("weights"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    ).withColumn(
        "full",
        F.col("cap") / F.col("weight")
        <= (F.col("pool") - F.col("cap_before")) / (F.col("weights") - F.col("weight_before")),
    )
    level = (F.col("pool") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(everything)) / F.sum(
        F.when(F.col("full"), 0).otherwise(F.col("weight"))
    ).over(everything)
    return ranked.select(
        "source",
        "source_size",
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(level * F.col("weight")).alias("target"),
    )


def _hex(text: Column, digits: int) -> Column:
    return F.conv(F.substring(text, 1, digits), 16, 10).cast("long")


def mix_copies(
    docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3, seed: str = "mix"
) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target and copies.

    ``docs`` needs doc_id, text and source; all its columns are kept, and
    those of the four names are replaced. Within a source, documents are
    ordered by size class and then by a hash of their id. Each expects
    target / source_size copies; the running sum of that, moved by one offset
    of the source, crosses ``copies`` whole numbers at the document. Ordering by
    size keeps the words taken near the target, since the sum is never off by
    more than one document at any size. Copies never exceed ``limit``.

    The position is the count of documents in earlier slices (a table of at
    most a few hundred size classes by SLICES for each source) plus the
    position within the slice, so no window holds a source.

    Null texts have size 0; null sources are a source; null ids are alike.
    Rows that agree in id, size and text are interchangeable, so ties do not
    show. A source without words has target 0 and no copies. An empty table
    gives an empty result. Sources named by any text, "null" included, differ
    from null.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    rows = docs.select("doc_id", "text", "source", F.struct(F.lit(0).alias(fresh(docs, "_")), *others).alias("rest"))
    hashed = F.md5(F.concat_ws(" ", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    placed = (
        rows.withColumn("size", word_count(F.col("text")))
        .withColumn("hash", hashed)
        .withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
        .withColumn("bits", F.length(F.bin(F.col("size") + 1)))
        .withColumn("band", F.expr("8 * bits + shiftright(8 * (size + 1), bits - 1)"))
        .withColumn("slice", _hex(F.col("hash"), 2))
    )
    counts = stored(
        placed.groupBy("key", "band", "slice").agg(F.count("*").alias("n"), F.sum("size").alias("words")),
        "mix-counts",
    )
    sizes = counts.groupBy(
        "key", F.when(F.col("key") != "n", F.expr("substring(key, 2)")).alias("source")
    ).agg(F.sum("words").alias("source_size"))
    share = F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0))
    targets = source_targets(sizes, weights, limit).select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key"),
        "source_size",
        "target",
        F.least(F.lit(limit * UNIT), F.floor(share * UNIT)).alias("unit"),
        _hex(F.md5(F.concat_ws(" ", F.lit(seed), F.col("source")).cast("binary")), 5).alias("offset"),
    )
    earlier = Window.partitionBy("key").orderBy("band", "slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("key", "band", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("key", "band", "slice").orderBy("size", "hash", F.xxhash64("text"))
    numbered = placed.withColumn("place", F.row_number().over(inside))
    matched = numbered.join(starts, ["key", "band", "slice"]).join(targets, "key")
    copies = f"((start + place) * unit + offset) div {UNIT} - ((start + place - 1) * unit + offset) div {UNIT}"
    return matched.select(
        "doc_id",
        "text",
        "source",
        *[F.col(f"rest.`{c}`").alias(c) for c in others if c not in ("size", "source_size", "target", "copies")],
        "size",
        "source_size",
        "target",
        F.expr(copies).alias("copies"),
    )


def mix(docs: DataFrame, **parameters) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as it is taken, same columns."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "source")]
    packed = docs.select("doc_id", "text", "source", F.struct(F.lit(0).alias(fresh(docs, "_")), *others).alias("rest"))
    taken = mix_copies(packed, **parameters).where("copies > 0")
    repeated = taken.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return repeated.select(*[F.col(f"rest.`{c}`").alias(c) if c in others else F.col(c) for c in docs.columns])


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


OP1_SQL = r"""
with sized as (
  select doc_id, source,
         cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         md5('mix' || coalesce(' ' || cast(doc_id as varchar), '')) as h
  from documents
),
sources as (
  select source, sum(size)::bigint as source_size,
         ((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint as weight
  from sized group by source
),
ranked as (
  select *, source_size * 3 as cap, sum(source_size) over () as pool, sum(weight) over () as weights,
         coalesce(sum(source_size * 3) over w, 0) as cap_before, coalesce(sum(weight) over w, 0) as weight_before
  from sources
  window w as (order by source_size * 3 / weight, source nulls last
               rows between unbounded preceding and 1 preceding)
),
filled as (
  select *, cap / weight <= (pool - cap_before)::double / (weights - weight_before)::double as is_full from ranked
),
targets as (
  select source, source_size,
         case when is_full then cap::double
              else (pool - sum(case when is_full then cap else 0 end) over ())::double
                   / (sum(case when is_full then 0 else weight end) over ())::double * weight end as target,
         ('0x' || substr(md5('mix' || coalesce(' ' || source, '')), 1, 5))::bigint as start
  from filled
),
placed as (
  select s.doc_id, s.size, t.source_size, t.target, t.start,
         least(3 * 1048576, floor(coalesce(case when t.source_size > 0 then t.target / t.source_size end, 0) * 1048576))::bigint as unit,
         row_number() over (partition by s.source
           order by 8 * length(bin(s.size + 1)) + ((8 * (s.size + 1)) >> (length(bin(s.size + 1)) - 1)::bigint), substr(h, 1, 2), s.size, h) as k
  from sized s join targets t on s.source is not distinct from t.source
)
select doc_id, size, source_size, target,
       ((k * unit + start) // 1048576 - ((k - 1) * unit + start) // 1048576) * size as taken,
       (k * unit + start) // 1048576 - ((k - 1) * unit + start) // 1048576 as copies
from placed
"""
