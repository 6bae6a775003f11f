"""Aggregates of the entity summary, metrics and samples."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomwork.workspace import Workspace

#: A key of more rows than this is summed up by partial aggregates, and not by one task.
HOT = 100_000
#: Rows of whole keys that a task sums up at a time.
CHUNK = 50_000
#: Types whose values are equal in Arrow where they are in Spark (a NaN isn't).
_EXACT = (T.IntegralType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """value, n by descending count, ties by value; nulls are not counted."""
    return df.filter(F.col(column).isNotNull()).groupBy(F.col(column)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def mode_by(df: DataFrame, key: str, column: str, out: str) -> DataFrame:
    """The most frequent value of each group, ties to the least; null where a group has none. Two aggregations of one scan, each combined
    before its shuffle, whatever the size of a group."""
    counted = df.groupBy(key, column).agg(F.count(column).alias("n"))
    return counted.groupBy(key).agg(F.min_by(F.col(column), F.struct(-F.col("n"), F.col(column))).alias(out))


def set_concat_of(distinct: Column, max_items: int | None = None, max_chars: int | None = None) -> Column:
    """Ordered distinct values joined by " | ", the rest counted, long results cut."""
    n = F.size(distinct)
    text = F.array_join(distinct, " | ")
    if max_items:
        text = F.when(n > max_items, F.concat(F.array_join(F.slice(distinct, 1, max_items), " | "), F.lit(" (+ "), (n - max_items).cast("string"), F.lit(" more)"))).otherwise(text)
    return F.when(F.length(text) > max_chars, F.concat(F.substring(text, 1, max_chars), F.lit("..."))).otherwise(text) if max_chars else text


def _joined(items: Column, n: Column, max_items: int | None, max_chars: int | None) -> Column:
    """``set_concat_of`` for the first items of a list of n."""
    text = F.array_join(items, " | ")
    if max_items:
        text = F.when(n > max_items, F.concat(text, F.lit(" (+ "), (n - max_items).cast("string"), F.lit(" more)"))).otherwise(text)
    return F.when(F.length(text) > max_chars, F.concat(F.substring(text, 1, max_chars), F.lit("..."))).otherwise(text) if max_chars else text


def _distinct_lists(values: DataFrame, keys: list[str], max_items: int | None) -> DataFrame:
    """keys, __l (the distinct values v in the order of their first place p, no more than ``max_items``), __n (how many there are). Values
    without a place are last.

    A group's values are never gathered whole where a number is given: a row number that is limited before the shuffle leaves the first."""
    first = values.filter("v is not null").groupBy(*keys, "v").agg(F.min("p").alias("p"))
    counts = first.groupBy(*keys).agg(F.count("*").alias("__n"))
    if max_items:
        w = Window.partitionBy(*keys).orderBy(F.col("p").asc_nulls_last(), "v")
        first = first.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= max_items)
    lists = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col("p").isNull().alias("o"), "p", "v"))).alias("__l"))
    return counts.join(lists, keys).select(*keys, F.col("__l.v").alias("__l"), "__n")


def set_concat(df: DataFrame, key: str, column: str, order: str, out: str, max_items: int | None = None, max_chars: int | None = None) -> DataFrame:
    """Distinct non-null values of each group in the order they first occur (by ``order``), joined. Values are made distinct
    before they are gathered, and no more of them than are shown."""
    values = df.select(F.col(key), F.col(column).cast("string").alias("v"), F.col(order).alias("p"))
    joined = df.select(key).distinct().join(_distinct_lists(values, [key], max_items), key, "left")
    return joined.select(key, F.coalesce(_joined(F.col("__l"), F.col("__n"), max_items, max_chars), F.lit("")).alias(out))


def _changes(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it; nulls are equal."""
    a, b = column[:-1], column[1:]
    return pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.not_equal(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def _block(t: pa.Table, schema: pa.Schema, modes: list[str], sets: dict[str, int | None]) -> pa.RecordBatch:
    """A row a key of whole keys, whose rows are in order: columns are the key, its place, and values as strings."""
    key, place = (c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in t.columns[:2])
    new = _changes(key)
    group = np.concatenate([[0], np.cumsum(new)])
    at = np.concatenate([[0], np.cumsum(new | _changes(place))])
    groups = int(group[-1]) + 1
    out = [key.take(pa.array(np.flatnonzero(np.concatenate([[True], new]))))]
    for c in [*modes, *sets]:
        coded = t.column(c).combine_chunks().dictionary_encode()
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        words, n = coded.dictionary, max(1, len(coded.dictionary))
        by = pc.sort_indices(words).to_numpy()
        rank = np.empty(n, np.int64)
        rank[by] = np.arange(len(by))
        rows = np.flatnonzero(coded.is_valid().to_numpy(zero_copy_only=False))
        code = rank[pc.fill_null(coded.indices, 0).to_numpy()[rows]] if len(rows) else np.zeros(0, np.int64)
        pairs, first, count = np.unique(group[rows] * n + code, return_index=True, return_counts=True)
        g, r = np.divmod(pairs, n)
        if c in sets:
            order = np.argsort(at[rows][first] * n + r)
            g, r, size = g[order], r[order], np.bincount(g, minlength=groups)
            if sets[c]:
                kept = np.arange(len(g)) - (np.cumsum(size) - size)[g] < sets[c]
                g, r = g[kept], r[kept]
            ends = np.concatenate([[0], np.cumsum(np.bincount(g, minlength=groups))]).astype(np.int32)
            out += [pa.ListArray.from_arrays(pa.array(ends), words.take(pa.array(by[r]))), pa.array(size.astype(np.int32))]
        else:
            order = np.lexsort((r, -count, g))
            g, r = g[order], r[order]
            lead = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, np.int64)
            best = np.zeros(groups, np.int64)
            best[g[lead]] = by[r[lead]]
            none = np.ones(groups, bool)
            none[g[lead]] = False
            out.append(words.take(pa.array(best, mask=none)))
    return pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(out, schema)], schema=schema)


def _by_key(rows: DataFrame, key: str, order: str, modes: list[str], sets: dict[str, int | None], values: dict[str, Column]) -> DataFrame:
    """key, the modes, and of each set its first items and, with "__n" behind its name, their number. Rows move once, as they are; a task
    gets those of a key one after another and sums up some thousand keys at a time."""
    chunk = CHUNK
    moved = rows.repartition(F.col(key)).sortWithinPartitions(key, F.col(order).asc_nulls_last())
    need = dict.fromkeys([*modes, *sets])
    shown = moved.select(F.col(key), F.col(order).alias("__p"), *[values.get(c, F.col(c)).cast("string").alias(c) for c in need])
    fields = [T.StructField(c, T.StringType()) for c in modes]
    for c in sets:
        fields += [T.StructField(c, T.ArrayType(T.StringType())), T.StructField(f"{c}__n", T.IntegerType())]
    arrow = [pa.field(f.name, pa.int32() if f.dataType == T.IntegerType() else pa.string() if f.dataType == T.StringType() else pa.list_(pa.string())) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, enough = [], 0, chunk
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < enough:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            starts = np.flatnonzero(_changes(t.column(0).chunk(0)))
            cut = int(starts[-1]) + 1 if len(starts) else 0
            if cut:
                yield _block(t.slice(0, cut), pa.schema([t.schema.field(0), *arrow]), modes, sets)
            held, n = t.slice(cut).to_batches(), t.num_rows - cut
            enough = max(chunk, 2 * n)
        if n:
            t = pa.Table.from_batches(held).combine_chunks()
            yield _block(t, pa.schema([t.schema.field(0), *arrow]), modes, sets)

    return shown.mapInArrow(run, T.StructType([rows.schema[key], *fields]))


def _by_value(rows: DataFrame, key: str, order: str, modes: list[str], sets: dict[str, int | None]) -> DataFrame:
    """``_by_key`` for keys of any number of rows and any type: modes and sets of all columns share one unpivoted table (key, column, value),
    counted before it moves."""
    long = lambda names: rows.select(key, F.col(order).alias("p"), F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in names])).alias("x")).select(key, "p", "x.c", "x.v")
    out = rows.select(key).distinct()
    if modes:
        counted = long(modes).groupBy(key, "c", "v").agg(F.count("v").alias("n"))
        best = counted.groupBy(key).agg(*[F.min_by(F.when(F.col("c") == c, F.col("v")), F.when(F.col("c") == c, F.struct(-F.col("n"), F.col("v")))).alias(c) for c in modes])
        out = out.join(best, key, "left")
    for items in dict.fromkeys(sets.values()):
        own = [c for c in sets if sets[c] == items]
        lists = _distinct_lists(long(own), [key, "c"], items)
        both = [x for c in own for x in (F.max(F.when(F.col("c") == c, F.col("__l"))).alias(c), F.max(F.when(F.col("c") == c, F.col("__n"))).cast("int").alias(f"{c}__n"))]
        out = out.join(lists.groupBy(key).agg(*both), key, "left")
    return out.select(key, *modes, *[x for c in sets for x in (c, f"{c}__n")])


def summarise(df: DataFrame, key: str, order: str, modes: list[str] = (), sets: dict[str, tuple[int | None, int | None]] | None = None, mins: list[str] = (), means: list[str] = (), values: dict[str, Column] | None = None, hot: int = HOT) -> DataFrame:
    """One row a key: modes, ordered set concatenations, minima and means (two decimals, half to even). Null keys are dropped; columns that
    neither ``df`` nor ``values`` has are left out. Modes are of values as strings, ties to the least.

    ``values`` are columns by expression: those that modes and sets need are computed where they are counted, so only what they are made of
    moves. Rows move once, to the task of their key; those of keys with more than ``hot`` rows are counted before they move instead."""
    values = values or {}
    have = {*df.columns, *values}
    modes, sets = [c for c in modes if c in have], {c: x for c, x in (sets or {}).items() if c in have}
    rows = df.filter(F.col(key).isNotNull())
    of = lambda c: values.get(c, F.col(c))
    plain = [F.min(of(c)).alias(c) for c in mins if c in have] + [F.bround(F.avg(of(c)), 2).alias(c) for c in means if c in have]
    shown = [c for c in (*mins, *means) if c in have] or ["n"]
    out = rows.groupBy(key).agg(*(plain or [F.count("*").alias("n")]), F.count("*").alias("__rows"))
    if not modes and not sets:
        return out.drop("__rows")
    out = Workspace(df.sparkSession, "summary").save(out)
    items = {c: x for c, (x, _) in sets.items()}
    by_value = lambda part: _by_value(part.withColumns(values), key, order, modes, items)
    large = out.filter(F.col("__rows") > hot).select(key)
    if not all(isinstance(df.schema[c].dataType, _EXACT) for c in (key, order)):
        found = by_value(rows)
    elif large.isEmpty():
        found = _by_key(rows, key, order, modes, items, values)
    else:
        large = F.broadcast(large)  # of n rows no more than n / hot keys
        found = _by_key(rows.join(large, key, "left_anti"), key, order, modes, items, values).unionByName(by_value(rows.join(large, key, "left_semi")))
    joined = [F.coalesce(_joined(F.col(c), F.col(f"{c}__n"), *x), F.lit("")).alias(c) for c, x in sets.items()]
    return out.join(found, key, "left").select(key, *shown, *modes, *joined)


def length_stats(df: DataFrame, value: str, doc: str | None = None) -> DataFrame:
    """n, mean, population deviation, maximum and exact interpolated percentiles, in one pass."""
    v = F.col(value)
    q = [F.percentile(v, p / 100).alias(f"p{p}") for p in (25, 50, 75, 95, 99)]
    return df.agg((F.countDistinct(doc) if doc else F.count("*")).alias("n_docs"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.max(v).alias("max"), *q)


def describe(df: DataFrame, value: str) -> DataFrame:
    v = F.col(value)
    return df.agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), *[F.percentile(v, p / 100).alias(f"p{p}") for p in (25, 50, 75)], F.max(v).alias("max"))


def stats_by_parameter(df: DataFrame, parameter: str, value: str) -> DataFrame:
    """One row of statistics a parameter value."""
    v = F.col(value)
    return df.groupBy(parameter).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.percentile(v, 0.5).alias("median"), F.max(v).alias("max"))


def classification_metrics(df: DataFrame, truth: Column, predicted: Column) -> DataFrame:
    """tp, fp, fn, tn, accuracy, precision, recall, f1; a ratio without a base is 0."""
    t, p = truth.cast("boolean"), predicted.cast("boolean")
    counts = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(~t & ~p).alias("tn"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select("tp", "fp", "fn", "tn", ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def token_cost(df: DataFrame, prompt: str, completion: str, prompt_price: float, completion_price: float, rows: int | None = None) -> DataFrame:
    """Token totals, their cost at prices for a million tokens and, for ``rows`` rows, the cost by extrapolation."""
    out = df.agg(F.count("*").alias("n"), F.sum(prompt).alias("prompt_tokens"), F.sum(completion).alias("completion_tokens"))
    out = out.withColumn("cost", F.col("prompt_tokens") / 1e6 * prompt_price + F.col("completion_tokens") / 1e6 * completion_price)
    return out.withColumn("projected_cost", F.col("cost") / F.col("n") * rows) if rows else out


def union_of_lists(df: DataFrame, column: str) -> DataFrame:
    """The distinct elements of an array column."""
    return df.select(F.explode(column).alias("item")).distinct()


def failures(df: DataFrame, flag: str) -> DataFrame:
    return df.agg(F.count_if(F.coalesce(F.col(flag).cast("boolean"), F.lit(False))).alias("failures"))


def interest_score(stage: Column, signal: Column) -> Column:
    """0.65 stage + 0.35 signal, rounded half up, from 1 to 5."""
    return F.greatest(F.lit(1), F.least(F.lit(5), F.round(stage * 0.65 + signal * 0.35).cast("int")))


def latest_per_key(df: DataFrame, key: str, date: str, tie: str) -> DataFrame:
    """The row of greatest date of each key (null dates last, then least ``tie``, whatever its type); null keys form one group. The row number is
    limited before the shuffle, so a partition sends one row a key."""
    w = Window.partitionBy(key).orderBy(F.col(date).desc_nulls_last(), F.col(tie).asc_nulls_last())
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def sample_n(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), by a seeded md5 of the key: the same rows whatever the partitions."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def sample_halves(df: DataFrame, length: str, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows each of the shorter and the longer half, split at the median length."""
    cut = df.agg(F.percentile(length, 0.5).alias("__cut"))
    both = df.crossJoin(F.broadcast(cut))
    low, high = both.filter(F.col(length) <= F.col("__cut")).drop("__cut"), both.filter(F.col(length) > F.col("__cut")).drop("__cut")
    return sample_n(low, n, key, seed).unionByName(sample_n(high, n, key, seed))


def head(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ranked(df: DataFrame, score: str, date: str, key: str) -> DataFrame:
    """By score and date, both descending, then key."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(date).desc_nulls_last(), F.col(key))
