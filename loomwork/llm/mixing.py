"""Mixing sources to target weights by capped water-filling.

The mixture has ``budget`` times the characters of the corpus. Each source is to have its weight's share of it, but
at most ``max_epochs`` passes over itself: sources beyond are clamped and what they leave is redistributed to the
others in proportion to their weights, until none is beyond. That fixed point has one level: with the sources in
order of cap / weight, it is the first (budget - caps before) / (weights from here on) which that source's own cap
allows, found by one window over the table of sources (from there on the quotient only falls, so it is the greatest
that is allowed). Sizes, caps and weights are integers, so every sum is exact.

A document of a source with e epochs is repeated floor(e) times, and once more where a hash of seed and document id
(of the text, where the id is null) is below the fraction of e. Sources without a weight, the null source
among them, have ``default_weight``. Null texts count as empty; a source without characters, or of weight 0, gets no
epochs. Where all caps together are below the budget, every source has ``max_epochs``. Repeated rows are drawn
alike. Empty tables give empty results. Other columns are passed through, whatever their names (dots too) and types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomwork.columns import col, cols
from loomwork.workspace import Workspace


def _weight(source: Column, weights: dict[str, int], default: int) -> Column:
    got = F.lit(default)
    for name, w in sorted(weights.items()):
        got = F.when(source == name, w).otherwise(got)
    return got.cast("long")


def epochs(docs: DataFrame, weights: dict[str, int], default_weight: int = 1, budget: float = 1.0, max_epochs: int = 2, source: str = "source", text: str = "text") -> DataFrame:
    """Columns source, chars, epochs: one row for each source. The scan aggregates lengths only."""
    sizes = docs.groupBy(col(source).alias("source")).agg(F.coalesce(F.sum(F.length(col(text))), F.lit(0)).alias("chars"))
    s = sizes.withColumn("w", _weight(F.col("source"), weights, default_weight)).withColumn("cap", F.col("chars") * max_epochs)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("want", F.floor(F.sum("chars").over(everything) * F.lit(float(budget))))
    live = (F.col("w") > 0) & (F.col("cap") > 0)
    s = s.withColumn("lw", F.when(live, F.col("w")).otherwise(0)).withColumn("lcap", F.when(live, F.col("cap")).otherwise(0))
    before = Window.orderBy((~live).cast("int"), F.col("cap") / F.expr("nullif(w, 0)"), F.col("source").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("want") - F.coalesce(F.sum("lcap").over(before), F.lit(0))
    rest = F.sum("lw").over(everything) - F.coalesce(F.sum("lw").over(before), F.lit(0))
    s = s.withColumn("level", F.when(live, left / rest)).withColumn("fits", live & (F.col("level") * F.col("w") <= F.col("cap")))
    s = s.withColumn("water", F.max(F.when(F.col("fits"), F.col("level"))).over(everything))
    share = F.when(F.col("water").isNull(), F.col("cap").cast("double")).otherwise(F.least(F.col("cap").cast("double"), F.col("water") * F.col("w")))
    return s.select("source", "chars", F.when(live, share / F.col("chars")).otherwise(F.lit(0.0)).alias("epochs"))


def draw(doc_id: Column, text: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on the seed and the document alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.md5(text), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix(docs: DataFrame, weights: dict[str, int], default_weight: int = 1, budget: float = 1.0, max_epochs: int = 2, seed: int = 17, source: str = "source", text: str = "text", doc_id: str = "doc_id", epoch: str | None = None) -> DataFrame:
    """``docs`` with each row as often as the mixture has it; ``epoch`` names a column for the number of the pass.

    The plan has one row a source and is written to the shared folder, so that the planner knows its size: it is
    broadcast where that is small, else joined by a shuffle."""
    ws = Workspace(docs.sparkSession, "mix")
    plan = ws.save(epochs(docs, weights, default_weight, budget, max_epochs, source, text).select(F.col("source").alias("__lw_source"), F.col("epochs").alias("__lw_epochs")))
    e = F.col("__lw_epochs")
    times = F.floor(e) + (draw(col(doc_id), col(text), seed) < e - F.floor(e)).cast("int")
    joined = docs.join(plan, col(source).eqNullSafe(F.col("__lw_source")))
    out = joined.withColumn("__lw_times", times.cast("int")).filter("__lw_times > 0")
    out = out.withColumn("__lw_epoch", F.explode(F.sequence(F.lit(1), F.col("__lw_times"))))
    return out.select(*cols(docs), *([F.col("__lw_epoch").alias(epoch)] if epoch else []))


def mix_sql(weights: dict[str, int], default_weight: int, budget: float, max_epochs: int, seed: int) -> str:
    """DuckDB SQL for ``mix`` over documents, with the column epoch."""
    case = " ".join(f"when source = '{k}' then {w}" for k, w in sorted(weights.items()))
    return f"""
with s as (select source, coalesce(sum(length(text)), 0)::bigint as chars, (case {case} else {default_weight} end)::bigint as w from documents group by source),
c as (select *, (chars * {max_epochs})::bigint as cap, floor((sum(chars) over ()) * {float(budget)})::bigint as want, w > 0 and chars > 0 as live from s),
o as (select *, row_number() over (order by (not live)::int, cap / nullif(w, 0)::double, source nulls first) as r from c),
l as (select *, case when live then (want - coalesce(sum(case when live then cap else 0 end) over (order by r rows between unbounded preceding and 1 preceding), 0))::double
  / ((sum(case when live then w else 0 end) over ()) - coalesce(sum(case when live then w else 0 end) over (order by r rows between unbounded preceding and 1 preceding), 0))::double end as level from o),
m as (select *, max(case when level * w <= cap then level end) over () as water from l),
e as (select source, case when not live then 0.0::double when water is null then {max_epochs}::double else least(cap::double, water * w) / chars end as epochs from m),
d as (select d.*, floor(epochs)::int + ((('0x' || substr(md5('{seed}:' || coalesce(doc_id::varchar, md5(text), '')), 1, 8))::bigint / 4294967296.0::double) < epochs - floor(epochs))::int as times
  from documents d join e on d.source is not distinct from e.source)
select * exclude (times), unnest(range(1, times + 1))::int as epoch from d where times > 0"""
