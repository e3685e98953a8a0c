"""Queries over vectors, ledgers and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ledger as B
from ..operators import sampling as S
from ..operators import vectors as V
from ..sources.tables import table


def _units(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", V.l2_normalised(F.col("embedding")).alias("v"))
    return rows.select("vec_id", "v", V.quantised(F.col("v")).alias("q")).select("vec_id", "v", "q.codes", "q.scale")


def l2_normalize(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "embeddings").select("vec_id", V.l2_normalised(F.col("embedding")).alias("v"))
    return rows.select("vec_id", F.rint(V.dot(F.col("v"), F.col("v")) * 1e5).cast("long").alias("norm_e5"), F.floor(F.col("v")[0].cast("double") * 1e4).cast("long").alias("first_e4"))


def quantize(spark: SparkSession, sf: str) -> DataFrame:
    return _units(spark, sf).select("vec_id", F.array_join(F.transform("codes", lambda c: c.cast("int")), ",").alias("codes"))


def dequantize(spark: SparkSession, sf: str) -> DataFrame:
    rows = _units(spark, sf).select("vec_id", V.dequantised(F.col("codes"), F.col("scale")).alias("d"))
    return rows.select("vec_id", F.array_join(F.transform("d", lambda x: F.floor(x * 1e4).cast("long")), ",").alias("d"))


def roundtrip_cosine(spark: SparkSession, sf: str) -> DataFrame:
    rows = _units(spark, sf).select(V.cosine(F.col("v"), V.dequantised(F.col("codes"), F.col("scale"))).alias("c"))
    return rows.agg(F.floor(F.min("c") * 1e6).cast("long").alias("min_ppm"), F.floor(F.avg("c") * 1e6).cast("long").alias("mean_ppm"))


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    units = _units(spark, sf)
    query = units.orderBy("vec_id").select("v").first()[0]
    return V.top_k(units, query, 20, key="vec_id").select("vec_id", F.floor(F.col("score") * 1e5).cast("long").alias("score_e5"))


def pca_project(spark: SparkSession, sf: str) -> DataFrame:
    out, _, _, _ = V.pca(table(spark, sf, "embeddings"), 16)
    return out.select("vec_id", F.array_join(F.transform("reduced", lambda x: F.rint(x * 1e4).cast("long").cast("string")), ",").alias("reduced_e4"))


def mean_vectors(spark: SparkSession, sf: str) -> DataFrame:
    chunks = table(spark, sf, "embeddings").select(F.floor(F.col("vec_id") / 5).cast("long").alias("unit"), "embedding")
    return V.mean_of_chunks(chunks, "unit", "embedding").select("unit", F.posexplode("embedding").alias("k", "x")).select("unit", F.col("k").cast("long").alias("k"), F.rint(F.col("x") * 1e2).cast("long").alias("x_e2"))


def _ledger(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("engine"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("usd"), F.rint(F.col("o_totalprice") * 100).cast("long").alias("cents"))


def budget_month(spark: SparkSession, sf: str) -> DataFrame:
    return _ledger(spark, sf).groupBy(F.date_format("ts", "yyyy-MM").alias("month"), "engine").agg(F.count("*").alias("calls"), F.sum("cents").alias("cents"))


def budget_cap(spark: SparkSession, sf: str) -> DataFrame:
    return B.against_cap(_ledger(spark, sf), 5_000_000.0).select("month", "seq", "total", "allowed")


def ledger_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Daily calls and spend by engine, as the stream over the ledger reports them."""
    ev = table(spark, sf, "events")
    out = ev.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("calls"), F.sum(F.rint(F.col("value") * 100).cast("long")).alias("cents"))
    return out.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), F.col("event_type").alias("engine"), "calls", "cents")


def _sized(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "lang", F.length("text").cast("long").alias("n"))


def length_thirds(spark: SparkSession, sf: str) -> DataFrame:
    return S.thirds(_sized(spark, sf), "n", "doc_id").select("doc_id", "third")


def length_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.length_sample(_sized(spark, sf), "n", "doc_id", 50).select("doc_id", "third")


def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    return S.quota_sample(_sized(spark, sf), "lang", "doc_id", {"en": 12, "fr": 8, "de": 3, "es": 2}).select("lang", "doc_id")


def queries() -> dict:
    own = (l2_normalize, quantize, dequantize, roundtrip_cosine, vector_topk, pca_project, mean_vectors, budget_month, budget_cap, ledger_windows, length_thirds, length_sample, stratified_sample)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    dot = "list_sum(list_transform(range(1, len({a}) + 1), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE))"
    unit = f"""n AS (SELECT vec_id, embedding, greatest(sqrt({dot.format(a='embedding', b='embedding')}), 1e-12) AS n FROM embeddings),
        u AS (SELECT vec_id, list_transform(embedding, lambda x: (x::DOUBLE / n)::FLOAT) AS v FROM n),
        s AS (SELECT vec_id, v, greatest(list_max(list_transform(v, lambda x: abs(x)))::DOUBLE, 1e-12) / 127.0 AS scale FROM u),
        q AS (SELECT vec_id, v, scale, list_transform(v, lambda x: least(127.0, greatest(-127.0, round_even(x::DOUBLE / scale, 0)))::INT) AS codes FROM s),
        d AS (SELECT vec_id, v, scale, codes, list_transform(codes, lambda c: c * scale) AS d FROM q)"""
    cos = f"{dot.format(a='v', b='d')} / greatest(sqrt({dot.format(a='v', b='v')}) * sqrt({dot.format(a='d', b='d')}), 1e-12)"
    ledger = "l AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderdate AS ts, o_orderpriority AS engine, o_orderkey AS seq, round_even(o_totalprice * 100, 0)::BIGINT AS cents FROM orders)"
    sized = "z AS (SELECT doc_id, lang, length(text) AS n FROM documents)"
    third = "t AS (SELECT doc_id, lang, least(2, (row_number() OVER (ORDER BY n, doc_id) - 1) // greatest(1, count(*) OVER () // 3))::INT AS third FROM z)"
    order = "md5('0:' || doc_id), doc_id"
    return {
        "l2_normalize": f"WITH {unit} SELECT vec_id, round_even({dot.format(a='v', b='v')} * 1e5, 0)::BIGINT AS norm_e5, floor(v[1]::DOUBLE * 1e4)::BIGINT AS first_e4 FROM u",
        "quantize": f"WITH {unit} SELECT vec_id, array_to_string(codes, ',') AS codes FROM q",
        "dequantize": f"WITH {unit} SELECT vec_id, array_to_string(list_transform(d, lambda x: floor(x * 1e4)::BIGINT), ',') AS d FROM d",
        "roundtrip_cosine": f"WITH {unit} SELECT floor(min(c) * 1e6)::BIGINT AS min_ppm, floor(avg(c) * 1e6)::BIGINT AS mean_ppm FROM (SELECT {cos} AS c FROM d)",
        "vector_topk": f"WITH {unit}, one AS (SELECT v AS q FROM u ORDER BY vec_id LIMIT 1), sc AS (SELECT vec_id, {dot.format(a='codes', b='q')} * scale AS score FROM q, one) SELECT vec_id, floor(score * 1e5)::BIGINT AS score_e5 FROM sc ORDER BY score DESC, vec_id LIMIT 20",
        "mean_vectors": f"WITH x AS (SELECT vec_id // 5 AS unit, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS k FROM embeddings), a AS (SELECT unit, k, avg(x::DOUBLE) AS x FROM x GROUP BY ALL) SELECT unit, k - 1 AS k, round_even(x / sqrt(sum(x * x) OVER (PARTITION BY unit)) * 1e2, 0)::BIGINT AS x_e2 FROM a",
        "budget_month": f"WITH {ledger} SELECT month, engine, count(*) AS calls, sum(cents)::BIGINT AS cents FROM l GROUP BY ALL",
        "budget_cap": f"WITH {ledger}, c AS (SELECT month, seq, sum(cents) OVER (PARTITION BY month ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)::BIGINT AS total FROM l) SELECT month, seq, total, total <= 500000000 AS allowed FROM c",
        "ledger_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS engine, count(*) AS calls, sum(round_even(value * 100, 0)::BIGINT)::BIGINT AS cents FROM events GROUP BY ALL",
        "length_thirds": f"WITH {sized}, {third} SELECT doc_id, third FROM t",
        "length_sample": f"WITH {sized}, {third}, r AS (SELECT doc_id, third, row_number() OVER (PARTITION BY third ORDER BY {order}) AS r FROM t) SELECT doc_id, third FROM r WHERE r <= 16 + (third < 2)::INT",
        "stratified_sample": f"WITH r AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY {order}) AS r FROM documents) SELECT lang, doc_id FROM r WHERE r <= CASE lang WHEN 'en' THEN 12 WHEN 'fr' THEN 8 WHEN 'de' THEN 3 WHEN 'es' THEN 2 ELSE 0 END",
    }
