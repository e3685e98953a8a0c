"""Vectors: normalising, int8 codes with a scale each, principal components, top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalised(v: Column) -> Column:
    return let(F.greatest(norm(v), F.lit(1e-12)), lambda n: F.transform(v, lambda x: (x / n).cast("float")))


def scale_of(v: Column) -> Column:
    """The step of a vector's int8 codes."""
    return F.greatest(F.array_max(F.transform(v, F.abs)).cast("double"), F.lit(1e-12)) / 127.0


def quantised(v: Column) -> Column:
    """struct(codes, scale): round half to even, clipped to +-127."""
    return let(scale_of(v), lambda s: F.struct(F.transform(v, lambda x: F.least(F.lit(127.0), F.greatest(F.lit(-127.0), F.rint(x.cast("double") / s))).cast("tinyint")).alias("codes"), s.alias("scale")))


def dequantised(codes: Column, scale: Column) -> Column:
    return F.transform(codes, lambda c: c * scale)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(1e-12))


def top_k(units: DataFrame, query: list[float], k: int, codes: str = "codes", scale: str = "scale", key: str = "unit_row", mask: str | None = None) -> DataFrame:
    """The k units whose dequantised vectors have the largest dot product with the query; ties by key.  One pass, no full sort."""
    q = F.array(*[F.lit(float(x)) for x in query])
    rows = units.where(F.col(mask) == 1) if mask else units
    scored = rows.withColumn("score", dot(F.col(codes), q) * F.col(scale))
    return scored.orderBy(F.desc("score"), key).limit(k)


def pca(rows: DataFrame, k: int, vec: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, list[float], list[list[float]], list[float]]:
    """(key, reduced) centred, projected on k components and normalised again; mean, components and explained variance."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    vectors = rows.select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("v"))
    mean = [float(x) for x in vectors.agg(Summarizer.mean(F.col("v")).alias("m")).first()["m"]]
    centred = rows.select(key, F.zip_with(F.col(vec).cast("array<double>"), F.array(*[F.lit(x) for x in mean]), lambda a, b: a - b).alias("c")).withColumn("v", array_to_vector("c"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(centred)
    out = model.transform(centred).select(key, l2_normalised(vector_to_array("p")).alias("reduced"))
    return out, mean, model.pc.toArray().T.tolist(), [float(x) for x in model.explainedVariance]


def mean_of_chunks(chunks: DataFrame, key: str, vec: str) -> DataFrame:
    """Vectors of a text's chunks averaged by dimension and normalised."""
    one = chunks.select(key, F.posexplode(vec).alias("d", "x")).groupBy(key, "d").agg(F.avg("x").alias("x"))
    whole = one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("v"), F.lit(1).alias("one"))
    return whole.select(key, l2_normalised(F.transform("v", lambda p: p["x"])).alias(vec))
