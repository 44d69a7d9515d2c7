"""Small linear algebra on vector columns and on matrices as (i, j, value) rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.embedding import l2_normalised

__all__ = ["l2_normalised"]


def filled(value: float, n: int | Column) -> Column:
    return F.array_repeat(F.lit(value), n)


def _paired(a: Column, b: Column, f) -> Column:
    """Item-wise with broadcasting of arrays of one item; other unequal lengths give an empty array."""
    same = F.zip_with(a, b, f)
    one_b, one_a = F.transform(a, lambda x: f(x, F.get(b, F.lit(0)))), F.transform(b, lambda y: f(F.get(a, F.lit(0)), y))
    return F.when(F.size(a) == F.size(b), same).when(F.size(b) == 1, one_b).when(F.size(a) == 1, one_a).otherwise(F.slice(same, 1, 0))


def add(a: Column, b: Column) -> Column:
    return _paired(a, b, lambda x, y: x + y)


def mul(a: Column, b: Column) -> Column:
    return _paired(a, b, lambda x, y: x * y)


def div(a: Column, b: Column, safe: bool = False) -> Column:
    """Quotients; a zero divisor is an error, or gives 0 if ``safe``."""

    def q(x: Column, y: Column) -> Column:
        bad = F.lit(0.0) if safe else F.raise_error(F.lit("division by zero")).cast("double")
        return F.when(y == 0, bad).otherwise(x / y)

    return _paired(a, b, q)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def mean(a: Column) -> Column:
    return F.when(F.size(a) > 0, total(a) / F.size(a))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.when((norm(a) > 0) & (norm(b) > 0), dot(a, b) / (norm(a) * norm(b))).otherwise(0.0)


def sliced(a: Column, start: int, stop: int, step: int = 1) -> Column:
    part = F.slice(a, start + 1, stop - start)
    return part if step == 1 else F.filter(part, lambda _, i: i % step == 0)


def to_coo(df: DataFrame, row: str, vector: str) -> DataFrame:
    return df.select(F.col(row).alias("i"), F.posexplode(vector).alias("j", "value"))


def transpose(m: DataFrame) -> DataFrame:
    return m.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")


def matmul(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two matrices: equi-join on the shared axis and a sum per cell."""
    x, y = a.select("i", F.col("j").alias("k"), F.col("value").alias("x")), b.select(F.col("i").alias("k"), "j", F.col("value").alias("y"))
    return x.join(y, "k").groupBy("i", "j").agg(F.sum(F.col("x").cast("double") * F.col("y")).alias("value"))


def reduce_axis(m: DataFrame, axis: int, how: str = "sum") -> DataFrame:
    keep = "j" if axis == 0 else "i"
    return m.groupBy(keep).agg((F.sum if how == "sum" else F.avg)(F.col("value").cast("double")).alias("value"))


def quantise(v: Column, group: int) -> Column:
    """(scale, codes) of each group of a vector: scale = absmax / 127, codes rounded half to even in [-127, 127]."""
    n = F.ceil(F.size(v) / group).cast("int")
    parts = F.transform(F.sequence(F.lit(0), n - 1), lambda g: F.slice(v, g * group + 1, group))

    def one(p: Column) -> Column:
        scale = F.greatest(F.array_max(F.transform(p, lambda x: F.abs(x).cast("double"))) / 127, F.lit(1e-8))
        return F.struct(scale.alias("scale"), F.transform(p, lambda x: F.greatest(F.lit(-127), F.least(F.lit(127), F.bround(x.cast("double") / scale).cast("int")))).alias("codes"))

    return F.transform(parts, one)


def dequantise(groups: Column) -> Column:
    return F.flatten(F.transform(groups, lambda g: F.transform(g["codes"], lambda c: c * g["scale"])))


def attention(q: DataFrame, k: DataFrame, v: DataFrame, scale: float, causal: bool = True) -> DataFrame:
    """(seq, i, vector): softmax of scaled, causally masked scores times the values, within each sequence.

    Rows are (seq, i, vector); sequences are of bounded length, and the join is on the sequence.
    """
    a, b = q.select("seq", "i", F.col("vector").alias("q")), k.select("seq", F.col("i").alias("j"), F.col("vector").alias("k"))
    s = a.join(b, "seq").where(F.col("j") <= F.col("i") if causal else F.lit(True)).select("seq", "i", "j", (dot(F.col("q"), F.col("k")) * scale).alias("s"))
    top = s.groupBy("seq", "i").agg(F.max("s").alias("m"))
    e = s.join(top, ["seq", "i"]).select("seq", "i", "j", F.exp(F.col("s") - F.col("m")).alias("e"))
    parts = e.join(v.select("seq", F.col("i").alias("j"), F.posexplode("vector").alias("p", "x")), ["seq", "j"])
    cells = parts.groupBy("seq", "i", "p").agg((F.sum(F.col("e") * F.col("x")) / F.sum("e")).alias("x"))
    return cells.groupBy("seq", "i").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "x"))), lambda z: z["x"]).alias("vector"))


#: Rows of a block of the exhaustive search, of vectors and of queries.
VECTOR_BLOCK, QUERY_BLOCK = 20_000, 2_000


def nearest(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query, key, similarity, rank): the k most similar other vectors of each query by cosine, by exhaustive search in blocks.

    A task compares one block of queries with one block of vectors and keeps k of each query; the best of
    these are chosen by a second aggregation.  Null vectors are in no result.
    """
    q, v = queries.where(F.col(vector).isNotNull()), vectors.where(F.col(vector).isNotNull())
    nq, nv = -(-max(1, q.count()) // QUERY_BLOCK), -(-max(1, v.count()) // VECTOR_BLOCK)

    def blocks(df: DataFrame, mine: str, n: int, other: str, m: int) -> DataFrame:
        return df.select(key, vector, F.pmod(F.xxhash64(key), F.lit(n)).alias(mine), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(m - 1).cast("bigint"))).alias(other))

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query": [], key: [], "similarity": []})
        x, y = (np.stack(d[vector].to_numpy()).astype(float) for d in (a, b))
        x, y = (np.divide(m, n, out=np.zeros_like(m), where=n > 0) for m, n in ((m, np.linalg.norm(m, axis=1, keepdims=True)) for m in (x, y)))
        s = x @ y.T
        s[a[key].to_numpy()[:, None] == b[key].to_numpy()[None, :]] = -np.inf
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        out = pd.DataFrame({"query": np.repeat(a[key].to_numpy(), top.shape[1]), key: b[key].to_numpy()[top.ravel()], "similarity": np.take_along_axis(s, top, 1).ravel()})
        return out[np.isfinite(out["similarity"])]

    kind = dict(vectors.dtypes)[key]
    pairs = blocks(q, "qb", nq, "vb", nv).groupBy("qb", "vb").cogroup(blocks(v, "vb", nv, "qb", nq).groupBy("qb", "vb")).applyInPandas(best, f"query {kind}, {key} {kind}, similarity double")
    listed = pairs.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("similarity")).alias("s"), key))), 1, k).alias("l"))
    return listed.select("query", F.posexplode("l").alias("pos", "x")).select("query", F.col(f"x.{key}").alias(key), (-F.col("x.s")).alias("similarity"), (F.col("pos") + 1).alias("rank"))


# Gradients in closed form: what each input of an operation receives from the gradient of its result.


def grad_add(g: Column) -> tuple[Column, Column]:
    return g, g


def grad_mul(g: Column, a: Column, b: Column) -> tuple[Column, Column]:
    return mul(g, b), mul(g, a)


def grad_div(g: Column, a: Column, b: Column, safe: bool = False) -> tuple[Column, Column]:
    """Of a / b: g / b and -g a / b^2."""
    return div(g, b, safe), F.transform(div(mul(g, a), mul(b, b), safe), lambda x: -x)


def grad_sum(g: Column, n: int | Column) -> Column:
    """Every item of a sum receives the gradient of the sum."""
    return F.array_repeat(g, n)


def grad_mean(g: Column, n: int | Column) -> Column:
    return F.array_repeat(g / n, n)


def grad_matmul(g: DataFrame, a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a product of matrices: g b' and a' g."""
    return matmul(g, transpose(b)), matmul(transpose(a), g)


def grad_transpose(g: DataFrame) -> DataFrame:
    return transpose(g)
