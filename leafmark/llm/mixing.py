"""Mixing to target weights with soft domain membership.  DataFrame functions only.

A classifier learnt from a labelled table gives every document a posterior over domains.  Document rates r >= 0 are then fitted
so that the expected tokens of each domain, sum(r * tokens * posterior), meet their targets, by distributed projected-gradient
least squares: a step is one aggregation of a number a domain; rates stay with the rows, which are written every few steps.
"""

from __future__ import annotations

import logging
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rows as R
from . import scratch

#: Words and runs of symbols are separate tokens.
_CUT = r"[\x20\x09-\x0D]+|(?<=[\p{L}\p{N}])(?=[^\p{L}\p{N}\x20\x09-\x0D])"
#: Bounds of what reaches the driver or is broadcast: labelled rows, features, domains.
SAMPLE, FEATURES, DOMAINS = 20_000, 1024, 64
#: A feature's chi-square, and how many times commoner it is in some domain than in the others, at least.
CHI_SQUARE, RATIO = 40.0, 10.0


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _CUT), lambda w: w != "")


def labelled_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled table: toxic, else junk (quality 0), else clean; rows without an id or any label go."""
    domain = F.expr("CASE WHEN toxic = 1 THEN 'toxic' WHEN quality = 0 THEN 'junk' WHEN quality = 1 THEN 'clean' END")
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), domain.alias("domain")).where("doc_id is not null AND domain is not null")
    return rows.groupBy("doc_id").agg(F.min("domain").alias("domain"))


def posteriors(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> tuple[DataFrame, list[str]]:
    """(row, doc_id, n_tokens, p array<double>) for each row of ``docs``, and the domains in the order of ``p``.

    ``row`` is PLACE where ``docs`` has it, else a number.

    Bernoulli naive Bayes over presence and absence of the ``features`` tokens that tell domains apart best (chi-square),
    learnt from at most ``sample`` labelled documents in the order of a hash of their ids.  Both bounds are fixed, so both
    lists are broadcast.  A token must be RATIO times commoner in some domain than elsewhere, so long texts gather no noise.
    """
    known = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select(F.col("doc_id").alias("__id"), F.col("domain").alias("__domain"))
    taught = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("__id"))
    words = taught.select("__domain", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), _tokens(F.col("text"))))).alias("word"))
    counts = scratch.written(words.groupBy("word", "__domain").agg(F.count("*").alias("c")).groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("__domain", "c"))).alias("by"), F.sum("c").alias("all")).where("`all` >= 5 OR word = ''"), "features")
    top = counts.where("word = ''").select("by").first()
    sizes = dict(sorted(top[0].items())) if top else {}
    if len(sizes) > DOMAINS:
        raise ValueError(f"{len(sizes)} domains; {DOMAINS} at most")
    names = list(sizes) or ["all"]
    total = sum(sizes.values())
    rows = docs.select((F.col(R.PLACE) if R.PLACE in docs.columns else F.monotonically_increasing_id()).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), _tokens(F.col("text").cast("string")).alias("words"))
    prior = {d: math.log((sizes.get(d, 0) + 1) / (total + len(names))) for d in names}
    if len(names) == 1:
        return rows.select("row", "doc_id", F.size("words").cast("long").alias("n_tokens"), F.array(F.lit(1.0)).alias("p")), names

    def share(d: str) -> Column:
        return (F.coalesce(F.col("by")[d], F.lit(0)) + 0.5) / (sizes[d] + 1)

    def elsewhere(d: str) -> Column:
        return (F.col("all") - F.coalesce(F.col("by")[d], F.lit(0)) + 0.5) / (total - sizes[d] + 1)

    square = sum(((F.coalesce(F.col("by")[d], F.lit(0)) - F.col("all") * sizes[d] / total) ** 2 / (F.col("all") * sizes[d] / total) for d in names), F.lit(0.0))
    told = counts.where("word <> ''").withColumn("square", square).where(f"square >= {CHI_SQUARE}").where(F.greatest(*[share(d) / elsewhere(d) for d in names]) >= RATIO)
    told = told.orderBy(F.desc("square"), "word").limit(features)
    told = told.select("word", F.array(*[F.log(share(d) / (1 - share(d))) for d in names]).alias("w"), F.array(*[F.log(1 - share(d)) for d in names]).alias("none"))
    weights = scratch.written(told, "weights")
    none = weights.agg(*[F.coalesce(F.sum(F.col("none")[k]), F.lit(0.0)) for k in range(len(names))]).first()
    prior = {d: prior[d] + none[k] for k, d in enumerate(names)}
    weights = weights.drop("none")
    hits = rows.select("row", "doc_id", F.size("words").cast("long").alias("n_tokens"), F.explode_outer(F.array_distinct("words")).alias("word")).join(F.broadcast(weights), "word", "left")
    score = hits.groupBy("row", "doc_id", "n_tokens").agg(*[F.coalesce(F.sum(F.col("w")[k]), F.lit(0.0)).alias(f"s{k}") for k in range(len(names))])
    z = [F.col(f"s{k}") + prior[d] for k, d in enumerate(names)]
    most = F.greatest(*z)
    e = [F.exp(x - most) for x in z]
    whole = sum(e[1:], e[0])
    return score.select("row", "doc_id", "n_tokens", F.array(*[x / whole for x in e]).alias("p")), names


def fit_rates(soft: DataFrame, names: list[str], targets: dict[str, float], cap: float = math.inf, steps: int = 40, tolerance: float = 1e-6, every: int = 5, least: Column | None = None) -> tuple[DataFrame, dict[str, dict[str, float]]]:
    """``soft`` with ``rate``, and by domain what was there, the target and what the rates give, in tokens.

    ``targets``: tokens wanted of each domain (missing: what is there).  Minimises sum over domains of (given - target)**2 /
    available over ``least`` (0) <= rate <= ``cap``, from rate 1, by gradient steps in the token-weighted metric; their
    Hessian's norm is 1 at most, so step length 1 needs no search.  Domains without tokens are left out.
    A target that the bounds put out of reach by over 1 % of what is there is logged as a warning.
    """
    dims = range(len(names))
    table = scratch.written(soft.withColumn("rate", F.lit(float(min(1.0, cap)))), "rates")
    held = table.agg(*[F.sum(F.col("n_tokens") * F.col("p")[k]).alias(f"a{k}") for k in dims]).first()
    there = [held[k] or 0.0 for k in dims]
    want = [targets.get(d, there[k]) / there[k] if there[k] > 0 else 0.0 for k, d in enumerate(names)]
    rate, y = F.col("rate"), [min(1.0, cap)] * len(names)
    for step in range(steps):
        gap = [round(y[k] - want[k], 12) if there[k] > 0 else 0.0 for k in dims]
        if max(map(abs, gap)) < tolerance:
            break
        rate = F.greatest(F.lit(0.0) if least is None else least, rate - sum((F.col("p")[k] * gap[k] for k in dims), F.lit(0.0)))
        if cap < math.inf:
            rate = F.least(F.lit(float(cap)), rate)
        if (step + 1) % every == 0:
            table, rate = scratch.written(table.withColumn("rate", rate), "rates"), F.col("rate")
        got = table.agg(*[F.sum(rate * F.col("n_tokens") * F.col("p")[k]).alias(f"y{k}") for k in dims]).first()
        now = [got[k] / there[k] if there[k] > 0 else 0.0 for k in dims]
        if max(abs(a - b) for a, b in zip(now, y, strict=True)) < tolerance / 10:
            y = now
            break
        y = now
    for k, d in enumerate(names):
        if abs(y[k] - want[k]) > 0.01:
            logging.getLogger(__name__).warning("domain %s: rates give %.4f of its tokens, target %.4f", d, y[k], want[k])
    report = {d: {"available": there[k], "target": want[k] * there[k], "given": y[k] * there[k]} for k, d in enumerate(names)}
    return table.withColumn("rate", rate), report


def mixed(docs: DataFrame, labels: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0, cap: float = math.inf) -> DataFrame:
    """row, doc_id, n_tokens, one posterior a domain (p_<domain>), rate, copies for each row of ``docs``.

    ``weights``: share of the output's tokens for each domain; ``budget``: output tokens as a multiple of the input's.
    copies = floor(rate + u), u uniform in [0, 1) by a hash of the doc_id, so that expected copies are the rate.
    A null or empty text has no tokens and the prior as its posterior; repeated rows each have a row; no labels: one domain.
    """
    soft, names = posteriors(docs, labelled_domains(labels))
    soft = scratch.written(soft, "soft")
    total = soft.agg(F.sum("n_tokens")).first()[0] or 0
    weights = weights or {}
    scale = sum(weights.get(d, 0.0) for d in names) or 1.0
    targets = {d: weights[d] / scale * budget * total for d in names if d in weights}
    fitted, _ = fit_rates(soft, names, targets, cap)
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return fitted.select("row", "doc_id", "n_tokens", *[F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(names)], "rate", F.floor(F.col("rate") + u).cast("long").alias("copies"))


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``docs`` after mixing without repetition (rates at most 1): a row stays with the probability of its rate.

    ``targets``: for each domain the part of its tokens to keep; others keep theirs.  A row that more likely than not belongs to
    domains without a target is bound to rate 1 in the fit itself, so that an unsure posterior costs no document.
    Rows are dropped by place: rows that repeat a doc_id, or have none, are judged by themselves.
    """
    docs = R.placed(docs)
    soft, names = posteriors(docs, labelled_domains(labels))
    soft = scratch.written(soft, "soft")
    held = soft.agg(*[F.sum(F.col("n_tokens") * F.col("p")[k]) for k in range(len(names))]).first()
    own = sum((F.col("p")[k] for k, d in enumerate(names) if d not in targets), F.lit(0.0))
    least = F.when(own >= 0.5, F.lit(1.0)).otherwise(F.lit(0.0))
    fitted, _ = fit_rates(soft, names, {d: targets[d] * (held[k] or 0.0) for k, d in enumerate(names) if d in targets}, cap=1.0, least=least)
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(9)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return R.without(docs, fitted.where(u >= F.col("rate")).select("row"))
