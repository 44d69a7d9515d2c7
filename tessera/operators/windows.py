"""Windows over token arrays, line arrays and one global token stream, in closed form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.tokens import fit
from tessera.session import cut


def multi_scale_windows(df: DataFrame, tokens: str, widths: list[int], overlap: float = 0.75, pad: int = 0) -> DataFrame:
    """Windows of every width at stride ``width - int(overlap * width)``, kept if at least half full, padded.

    Adds window_size, window_start, n_real and window.  Null and empty arrays give no window.
    """
    scale = F.explode(F.array(*(F.struct(F.lit(w).alias("w"), F.lit(w - int(overlap * w)).alias("stride")) for w in widths)))
    each = df.where(F.size(tokens) > 0).withColumn("scale_", scale)
    starts = F.explode(F.sequence(F.lit(0), F.size(tokens) - 1, F.col("scale_.stride")))
    each = each.withColumn("window_start", starts).withColumn("n_real", F.least(F.col("scale_.w"), F.size(tokens) - F.col("window_start")))
    each = each.where(F.col("n_real") >= F.floor(F.col("scale_.w") / 2))
    real = F.slice(tokens, F.col("window_start") + 1, F.col("n_real"))
    return each.select("*", F.col("scale_.w").alias("window_size"), F.concat(real, F.array_repeat(F.lit(pad), F.col("scale_.w") - F.col("n_real"))).alias("window")).drop("scale_")


def counted_windows(df: DataFrame, tokens: str, width: int, stride: int, pad: int = 0) -> DataFrame:
    """``max(1, (n - width) div stride + 1)`` padded windows of each array; a tail shorter than the stride is not covered."""
    n = F.greatest(F.lit(1), F.floor((F.size(tokens) - width) / stride).cast("int") + 1)
    each = df.where(F.size(tokens) >= 0).withColumn("window_no", F.explode(F.sequence(F.lit(0), n - 1)))
    part = F.slice(tokens, F.col("window_no") * stride + 1, width)
    return each.withColumn("n_real", F.size(part)).withColumn("window", fit(part, width, pad))


def with_offsets(df: DataFrame, order: list[str], size: Column, name: str = "stream_start") -> DataFrame:
    """Adds where each row starts in the concatenation of all rows, by two-level prefix sums.

    Rows are range-partitioned by ``order`` and kept so (one checkpoint); partitions add up their own sizes, and
    only one total per partition is summed globally, so no task sees more than its share of the rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut(df.withColumn("size_", size.cast("bigint")).repartitionByRange(parts, *order).withColumn("part_", F.spark_partition_id()))
    totals = placed.groupBy("part_").agg(F.sum("size_").alias("t"))
    before = totals.select("part_", (F.sum("t").over(W.orderBy("part_")) - F.col("t")).alias("before_"))  # one row per partition
    inside = F.sum("size_").over(W.partitionBy("part_").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)) - F.col("size_")
    return placed.withColumn("inside_", inside).join(F.broadcast(before), "part_").withColumn(name, F.col("inside_") + F.col("before_")).drop("part_", "inside_", "before_", "size_")


def stream_windows(df: DataFrame, tokens: str, order: list[str], length: int, overlap: int, pad: int | None = None, keep_from: int = 1) -> DataFrame:
    """(window_no, n_real, window): overlapping windows over all rows' tokens in order.

    Window i covers ``[i S, i S + length)`` with ``S = length - overlap``; the last covers what remains and is
    padded with ``pad``, or left short if ``pad`` is None.  Windows with fewer than ``keep_from`` tokens are left out.
    """
    if not 0 <= overlap < length:
        raise ValueError("the overlap must be smaller than the length")
    stride = length - overlap
    rows = with_offsets(df.where(F.size(tokens) > 0).select(*order, F.col(tokens).alias("t_")), order, F.size("t_"))
    n = F.size("t_")
    first = F.greatest(F.lit(0), F.floor((F.col("stream_start") - length) / stride) + 1)
    last = F.floor((F.col("stream_start") + n - 1) / stride)
    total = rows.agg(F.sum(F.size("t_")).alias("total_"))
    hit = rows.withColumn("window_no", F.explode(F.sequence(first, last)))
    begin = F.col("window_no") * stride
    lo = F.greatest(F.lit(0), begin - F.col("stream_start"))
    hi = F.least(n, begin + length - F.col("stream_start"))
    piece = hit.select("window_no", "stream_start", F.slice("t_", (lo + 1).cast("int"), (hi - lo).cast("int")).alias("piece"))
    whole = piece.groupBy("window_no").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("stream_start", "piece"))), lambda x: x["piece"])).alias("window"))
    # full windows, and the single one after them
    whole = whole.crossJoin(F.broadcast(total)).where(F.col("window_no") <= F.when(F.col("total_") >= length, F.floor((F.col("total_") - length) / stride) + 1).otherwise(0))
    whole = whole.withColumn("n_real", F.size("window")).where(F.col("n_real") >= keep_from)
    out = F.col("window") if pad is None else fit(F.col("window"), length, pad)
    return whole.select("window_no", "n_real", out.alias("window"))


def context_targets(df: DataFrame, tokens: str, order: list[str], context: int, target: int, stride: int) -> DataFrame:
    """(window_no, context, target) pairs over the global stream; both must be more than half full."""
    pairs = stream_windows(df, tokens, order, context + target, context + target - stride)
    ctx, tgt = F.slice("window", 1, context), F.slice("window", context + 1, target)
    return pairs.select("window_no", ctx.alias("context"), tgt.alias("target")).where((F.size("context") > context / 2) & (F.size("target") > target / 2))


def line_windows(lines: Column, size: int, overlap: int) -> Column:
    """Array of (start_line, end_line), 1-based and inclusive; the last ends at the last line."""
    stride = max(1, size - overlap)
    total = F.size(lines)
    n = F.greatest(F.lit(0), F.ceil((total - size) / stride)).cast("int")
    at = F.transform(F.sequence(F.lit(0), n), lambda i: F.struct((i * stride + 1).alias("start_line"), F.least(total, i * stride + size).alias("end_line")))
    return F.when(total > 0, at).otherwise(F.slice(at, 1, 0))


def grouped_examples(df: DataFrame, key: str, order: list[str], tokens: str, context: int, target: int) -> DataFrame:
    """Per key: all tokens in order; the first fill the context, the next the target; needs more than half of both."""
    g = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(tokens).alias("t_")))), lambda x: F.coalesce(x["t_"], F.array().cast("array<int>")))).alias("all_"), F.count("*").alias("num_chunks"))
    out = g.select(key, "num_chunks", F.slice("all_", 1, context).alias("context"), F.slice("all_", context + 1, target).alias("target"))
    return out.where((F.size("context") > context / 2) & (F.size("target") > target / 2))


def sliding_examples(df: DataFrame, tokens: str, context: int, target: int, least_target: int = 10) -> DataFrame:
    """Windows within each array at stride ``int(0.8 target)``: context from the start, target after it."""
    stride = max(1, int(target * 0.8))
    n = F.size(tokens)
    each = df.where(n > target).withColumn("start_idx", F.explode(F.sequence(F.lit(0), n - target - 1, F.lit(stride))))
    end = F.least(F.col("start_idx") + context, n)
    out = each.withColumn("context", F.slice(tokens, F.col("start_idx") + 1, context)).withColumn("target", F.slice(tokens, end + 1, target))
    return out.where(F.size("target") >= least_target)


def breakpoints(df: DataFrame, key: str, text: str, pattern: str, margin: int) -> DataFrame:
    """(key, point): number of words up to lines that match, if more than ``margin`` words follow."""
    lines = df.where(F.col(text).isNotNull()).select(key, F.split(text, "\n").alias("l"))
    counts = F.transform("l", lambda x: F.size(F.filter(F.split(x, " "), lambda w: w != "")))
    upto = F.aggregate(counts, F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("a")), lambda a, n: F.struct((a["s"] + n).alias("s"), F.concat(a["a"], F.array(a["s"] + n)).alias("a")))
    rows = lines.select(key, "l", upto.alias("u"))
    hits = F.filter(F.arrays_zip(F.col("l"), F.col("u.a").alias("a")), lambda z: z["l"].rlike(pattern) & (F.col("u.s") - z["a"] > margin))
    return rows.select(key, F.explode(F.array_distinct(F.transform(hits, lambda z: z["a"]))).alias("point")).withColumn("point", F.col("point").cast("bigint"))
