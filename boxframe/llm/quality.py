"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

``measure`` takes the text measures of every whole text. ``certify`` picks
cutoffs for every stratum on labelled documents. The documents of a fitting
half give candidates: quantiles of the good documents (and a quartile of the bad
ones beyond all good), from the loosest down, and among the rules of one
quantile the one first that rejects most bad documents. Every step adds one
candidate; on the other half an exact binomial test must show that all cutoffs
so far together reject at most ``max_reject`` of the good documents. The steps are
tested in this fixed sequence until one fails, so that only the number of
strata divides the level. A stratum or rule without a certified cutoff rejects
nothing.

``judge`` tests strata that have too few good documents to certify anything as
one stratum. The limit then holds for all of them together, so a member takes a
pooled cutoff only on evidence of its own: at least ``Risk.member`` labelled good
documents, none of which is beyond the cutoff. Strata without labels reject nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.llm.common import WORD, cut_lineage, small

WINDOW = 8
MAX_BROADCAST = 50_000  # rows of the candidate and cutoff tables; beyond it they are shuffled
RULES = ("symbols", "dup_lines", "repeats", "short_words", "long_words")


@dataclass(frozen=True)
class Risk:
    """Parameters of the certification."""

    max_reject: float = 0.01  # of the good documents of a stratum, by all its rules together
    alpha: float = 0.05  # chance that any certified cutoff breaks its limit
    member: int = 30  # labelled good documents that a stratum must have to take a cutoff certified with others
    quantiles: tuple[float, ...] = (0.95, 0.98, 0.99, 0.995, 0.999, 1.0)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, ``keep`` columns and the measures (all BIGINT).

    A NULL text counts as empty: all measures are zero. Repeated rows give
    repeated results. Windows shorter than 8 words do not exist, so a text of
    under 8 words has no repeated words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col), *keep, F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)).alias("__words"),
        F.split(text, "\n").alias("__lines"), F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    hashed = base.select(
        id_col, *keep, "n_symbols",
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        F.filter("__lines", lambda x: x.rlike(WORD)).alias("__lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__wh"),
    )
    wh = F.col("__wh")
    windows = F.when(F.size(wh) >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(wh) - WINDOW), lambda i: F.xxhash64(*[wh[i + k] for k in range(WINDOW)])),
    ).otherwise(F.array().cast("array<bigint>"))
    win = hashed.select(
        id_col, *keep, "n_words", "word_chars", "n_symbols", F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("__win"))
    # Only texts with a repeated window are sorted: (hash, start) pairs put equal windows side by side.
    pairs = win.withColumn("__pairs", F.when(
        F.size(F.array_distinct("__win")) < F.size("__win"),
        F.sort_array(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.cast("long").alias("p"))))))
    ps = F.col("__pairs")
    starts = pairs.withColumn("__starts", F.when(ps.isNotNull(), F.sort_array(F.transform(F.filter(
        ps, lambda s, i: ((i > 0) & (F.get(ps, i - 1)["h"] == s["h"]))
        | ((i < F.size(ps) - 1) & (F.get(ps, i + 1)["h"] == s["h"]))), lambda s: s["p"]))))
    # Sorted starts: each adds what it covers beyond the previous one.
    covered = F.aggregate(
        "__starts", F.struct(F.lit(-WINDOW).cast("long").alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW).cast("long"), p - acc["last"])).alias("n")),
        lambda acc: acc["n"])
    return starts.select(id_col, *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"), "n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def with_rules(measured: DataFrame) -> DataFrame:
    """The rule scores (higher: worse); a text without words scores 0 everywhere."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))

    mean = share("word_chars", "n_words")
    return measured.withColumns({
        "r_symbols": share("n_symbols", "word_chars"), "r_dup_lines": share("n_dup_lines", "n_lines"),
        "r_repeats": share("n_repeat_words", "n_words"), "r_short_words": -mean, "r_long_words": mean})


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exactly summed in log space (no underflow for large n).

    Only needed (and only summed) for k at most n*p; beyond that the value is over any level in use and 1 is returned.
    """
    ratio = math.log(p) - math.log1p(-p)
    start = n * math.log1p(-p)
    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.when(i > 0, F.log((n - i + 1) / F.greatest(i, F.lit(1)).cast("double")) + ratio).otherwise(0.0)
        high = F.greatest(acc["total"], term)
        low = F.least(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    total = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct(start.cast("double").alias("term"), F.lit(-1e308).alias("total")), step, lambda acc: F.exp(acc["total"]))
    return F.when(k <= n * p, total).otherwise(F.lit(1.0))


def certify(labelled: DataFrame, stratum: str, good: str = "good", fit: str = "fit", risk: Risk = Risk()) -> DataFrame:
    """One row per stratum and rule: ``cutoff`` (NULL: nothing certified), ``n_good``, ``n_rejected``, ``p_value``.

    ``labelled`` holds the rule scores, the stratum, ``good`` (boolean) and
    ``fit`` (boolean: fitting half; else the certifying holdout).
    """
    stacked = labelled.select(stratum, good, fit, F.explode(F.map_from_arrays(
        F.array(*[F.lit(r) for r in RULES]), F.array(*[F.col(f"r_{r}") for r in RULES]))).alias("rule", "score"))
    levels = sorted({float(q) for q in risk.quantiles}, reverse=True)
    fitting = stacked.filter(F.col(fit))
    top = fitting.filter(F.col(good)).groupBy(stratum, "rule").agg(
        F.percentile_approx("score", levels, 100_000).alias("__q"), F.max("score").alias("__top"))
    top = cut_lineage(top, "quantiles")
    beyond = fitting.filter(~F.col(good)).join(small(top, MAX_BROADCAST, "tops"), [stratum, "rule"]).filter(F.col("score") > F.col("__top")).groupBy(
        stratum, "rule").agg(F.percentile_approx("score", 0.25, 100_000).alias("__loose"))
    candidates = cut_lineage(top.join(beyond, [stratum, "rule"], "left").select(stratum, "rule", F.posexplode(
        F.concat(F.array("__loose"), "__q")).alias("level", "cutoff")).filter("cutoff is not null"), "candidates")
    hits = fitting.filter(~F.col(good)).join(small(candidates, MAX_BROADCAST, "levels"), [stratum, "rule"]).filter(F.col("score") > F.col("cutoff")).groupBy(
        stratum, "rule", "level", "cutoff").agg(F.count("*").alias("bad_hit"))
    order = Window.partitionBy(stratum).orderBy("level", F.desc("bad_hit"), "rule")
    steps = cut_lineage(hits.withColumn("step", F.row_number().over(order)), "steps")
    # Every good document of the holdout is rejected from one step on: cutoffs only get stricter.
    table = steps.groupBy(F.col(stratum).alias("__s")).agg(F.collect_list(F.struct("rule", "cutoff", "step")).alias("__steps"))
    scores = F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(f"r_{r}"))])
    held = labelled.filter(~F.col(fit) & F.col(good)).withColumn("__scores", scores).join(
        small(table, MAX_BROADCAST, "steps-of"), F.col(stratum).eqNullSafe(F.col("__s"))).select(stratum, F.array_min(F.transform(F.filter(
            "__steps", lambda x: F.col("__scores")[x["rule"]] > x["cutoff"]), lambda x: x["step"])).alias("step"))
    rejected = held.groupBy(stratum, "step").agg(F.count("*").alias("__n"))
    size = held.groupBy(stratum).agg(F.count("*").alias("n_good"))
    tests = top.select(stratum).distinct().count()
    so_far = Window.partitionBy(stratum).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    tested = steps.join(rejected, [stratum, "step"], "left").join(size, stratum).withColumn(
        "n_rejected", F.sum(F.coalesce("__n", F.lit(0))).over(so_far)).withColumn(
        "p_value", binomial_tail(F.col("n_rejected"), F.col("n_good"), risk.max_reject))
    passed = tested.withColumn("ok", F.min(F.col("p_value") * tests <= risk.alpha).over(so_far)).filter("ok")
    best = passed.groupBy(stratum, "rule").agg(F.max(F.struct("step", "cutoff", "n_good", "n_rejected", "p_value", "bad_hit")).alias("b"))
    return top.select(stratum, "rule").join(best, [stratum, "rule"], "left").select(
        stratum, "rule", "b.cutoff", "b.n_good", "b.n_rejected", "b.p_value", "b.bad_hit")


def pooled(labelled: DataFrame, stratum: str, good: str = "good", fit: str = "fit", risk: Risk = Risk()) -> DataFrame:
    """The strata (column ``__own``) that are tested alone: even without a rejection, others have too few good documents of the holdout."""
    counts = labelled.groupBy(F.col(stratum).alias("__own")).agg(F.count_if(~F.col(fit) & F.col(good)).alias("__n"))
    tests = labelled.select(stratum).distinct().count() + 1
    return counts.filter(F.col("__n") * math.log1p(-risk.max_reject) <= math.log(risk.alpha / tests)).select("__own")


def member_cutoffs(labelled: DataFrame, pool: DataFrame, stratum: str, good: str = "good", risk: Risk = Risk()) -> DataFrame:
    """``stratum, rule, cutoff``: the pooled cutoffs (``pool``: rule, cutoff) that each stratum of ``labelled`` may take.

    A stratum needs ``risk.member`` good documents, of both halves, all of them within the cutoff.
    """
    tops = labelled.filter(F.col(good)).groupBy(stratum).agg(
        F.count("*").alias("__n"), *[F.max(f"r_{r}").alias(f"r_{r}") for r in RULES]).filter(F.col("__n") >= risk.member)
    stacked = tops.select(stratum, F.explode(F.map_from_arrays(
        F.array(*[F.lit(r) for r in RULES]), F.array(*[F.col(f"r_{r}") for r in RULES]))).alias("rule", "__top"))
    return stacked.join(pool.select("rule", "cutoff"), "rule").filter(F.col("__top") <= F.col("cutoff")).select(stratum, "rule", "cutoff")


def apply_cutoffs(scored: DataFrame, cutoffs: DataFrame, stratum: str) -> DataFrame:
    """``rejected_by``: array of the rules whose certified cutoff the row exceeds (empty without a cutoff)."""
    table = cutoffs.filter(F.col("cutoff").isNotNull()).groupBy(F.col(stratum).alias("__s")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("__cut"))
    joined = scored.join(small(table, MAX_BROADCAST, "cutoffs"), F.col(stratum).eqNullSafe(F.col("__s")), "left")
    hit = [F.when(F.col(f"r_{r}") > F.col("__cut")[r], F.lit(r)) for r in RULES]
    return joined.withColumn("rejected_by", F.array_compact(F.array(*hit))).drop("__s", "__cut")


def judge(docs: DataFrame, labels: DataFrame, risk: Risk = Risk()) -> DataFrame:
    """Measures, base verdict and certified verdict of every row of ``docs`` (doc_id, text, lang).

    Strata are the values of ``lang`` (NULL is one of its own); those with too
    few labelled good documents are certified as one (``member_cutoffs``). Labels count
    once per id (the smallest, if they differ); rows without a quality label
    only get the verdict. The measures are written once (numbers only) and
    read for certification and verdict.
    """
    measured = cut_lineage(measure(docs, keep=("lang",)), "quality")
    scored = with_rules(measured).withColumn("stratum", F.coalesce(F.col("lang"), F.lit("")))
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("quality").alias("quality"))
    labelled = scored.join(marks, "doc_id").select(
        "stratum", *[f"r_{r}" for r in RULES], (F.col("quality") == 1).alias("good"),
        (F.crc32(F.concat(F.lit("fit"), F.col("doc_id").cast("string"))) % 2 == 0).alias("fit"))
    labelled = cut_lineage(labelled, "labelled")
    alone = small(pooled(labelled, "stratum", risk=risk), MAX_BROADCAST, "alone")

    def group(df: DataFrame) -> DataFrame:
        """``stratum`` as certified: ``=`` and its own, or ``small`` for the small ones together."""
        return df.join(alone, F.col("stratum") == F.col("__own"), "left").withColumn(
            "stratum", F.when(F.col("__own").isNull(), F.lit("small")).otherwise(F.concat(F.lit("="), "__own"))).drop("__own")

    cutoffs = cut_lineage(certify(group(labelled), "stratum", risk=risk).filter("cutoff is not null"), "cutoffs")
    own = cutoffs.filter(F.col("stratum").startswith("=")).select(F.expr("substring(stratum, 2)").alias("stratum"), "rule", "cutoff")
    rest = labelled.join(alone, F.col("stratum") == F.col("__own"), "left_anti")
    taken = member_cutoffs(rest, cutoffs.filter("stratum = 'small'"), "stratum", risk=risk)
    return apply_cutoffs(scored, cut_lineage(own.unionByName(taken), "own-cutoffs"), "stratum").withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rejected_by") == 0))
