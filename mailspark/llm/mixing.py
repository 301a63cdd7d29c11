"""Mixing sources to target weights by iterative proportional fitting.

Tokens are counted by cell (source, language, topic). The cells' weights are raked: in turn they
are scaled so that the sums by source, by language and by topic meet their targets. No cell can
give more than its tokens, so they are then raked again with the tokens as bounds, until every sum
is within TOLERANCE of its target, for the largest sample for which that can be done. A document is
kept with the probability of its cell, sampled tokens / tokens. The decision is a hash of the
document, so it is the same in a task that runs again.

A sample holds a value's target share only if it is no larger than the value's tokens divided by
that share, so the rarest values bound it. With `repeats` above 1 a cell can give its tokens so many
times: a probability above 1 is so many whole copies of each document and a draw for the rest, and
the sample is the largest one up to the size of the corpus. A `kept_share` that is given holds whatever the targets:
one beyond that bound takes rare values whole, and the others' shares are larger than wanted.
Targets that contradict each other (a language of one source, with another share than the source)
are met by no sample; then the weights as raked decide, and none is cut off.

Targets are shares given by value, or, where none are given, the corpus's own shares flattened:
tokens ** POWER. Only cells are raked, never documents; a cell table that Spark finds small is
broadcast, another one is joined by its keys.

Null sources, languages and topics are values like any other. Texts without words, null ones
too, weigh nothing and count one token, so that their cells have a probability. A value without
target among given ones has the target 0 and goes; targets of the values that stay are scaled to
sum to 1. A very long text is one document of its cell. Repeated rows are drawn alike. An empty
table stays empty, and other columns are kept whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from mailspark.llm.common import own_columns
from mailspark.session import scratch_dir

DIMENSIONS = ("source", "lang", "topic")
POWER = 0.8
ROUNDS = 8
TOLERANCE = 0.001
MOST_ROUNDS = 1000
SEED = 17
# How often the query and the pipeline let a document of a rare cell come
REPEATS = 4.0
# the complement of [\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F], which Java matches far more slowly
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]++"


def topic_of(text: Column) -> Column:
    """A topic by layout, for tables that have none: table, list, shout, marks, note or prose."""
    size = F.length(text)
    # most texts have a small letter, and are not changed in case to find that out
    shouts = ~text.rlike("[a-z]") & (F.upper(text) == text) & (F.lower(text) != text)

    def share_of(mark: str) -> Column:
        return (size - F.length(F.replace(text, F.lit(mark)))) / F.greatest(size, F.lit(1))

    return (
        F.when(text.isNull() | (size == 0), "none")
        .when(share_of("|") > 0.01, "table")
        .when(share_of("\n") > 0.02, "list")
        .when(shouts, "shout")
        .when((share_of("#") + share_of("*") + share_of("&") + share_of("$")) > 0.02, "marks")
        .when(size < 400, "note")
        .otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """Words, at least one."""
    words = F.regexp_count(text, F.lit(WORD))
    return F.greatest(F.coalesce(words, F.lit(0)), F.lit(1)).cast("double")


def cells_of(keyed: DataFrame) -> DataFrame:
    """Tokens by cell; `keyed` has the dimensions and tokens. Sums of whole numbers, so exact."""
    return keyed.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))


def with_targets(cells: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Adds the target share of each dimension's value as t_<dimension>."""
    for d in DIMENSIONS:
        if d in targets:
            share = F.lit(0.0)
            for value, wanted in sorted(targets[d].items()):
                share = F.when(F.col(d) == value, F.lit(float(wanted))).otherwise(share)
        else:
            own = F.sum("tokens").over(Window.partitionBy(d))
            share = F.pow(own, F.lit(POWER - 1.0)) * F.col("tokens")  # sums to own ** POWER
        cells = cells.withColumn(f"raw_{d}", share)
    every = Window.partitionBy()
    for d in DIMENSIONS:
        of_value = Window.partitionBy(d)
        if d in targets:
            total = sum(targets[d].values()) or 1.0
            cells = cells.withColumn(f"t_{d}", F.col(f"raw_{d}") / F.lit(total))
        else:
            cells = cells.withColumn(
                f"t_{d}", F.sum(f"raw_{d}").over(of_value) / F.sum(f"raw_{d}").over(every)
            )
    return cells.drop(*[f"raw_{d}" for d in DIMENSIONS])


def rake(cells: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Adds `weight`: the cells' tokens, scaled in turn to the targets of each dimension. The
    weights sum to 1 if the cells allow it."""
    cells = cells.withColumn("weight", F.col("tokens"))
    for _ in range(rounds):
        for d in DIMENSIONS:
            now = F.sum("weight").over(Window.partitionBy(d))
            scaled = F.col("weight") * F.col(f"t_{d}") / now
            cells = cells.withColumn("weight", F.when(now > 0, scaled).otherwise(F.lit(0.0)))
    return cells


def _scaled(amount, tokens, code, wanted):
    """`amount` times one factor for each value, so that the sums of min(amount, tokens) are
    `wanted`; a value that has less is taken whole."""
    bound = tokens / amount
    order = np.lexsort((bound, code))
    own, bound = code[order], bound[order]
    rows = pd.DataFrame({"own": own, "amount": amount[order], "tokens": tokens[order]})
    before = (rows.groupby("own").tokens.cumsum() - rows.tokens).to_numpy()
    free = rows[::-1].groupby("own").amount.cumsum()[::-1].to_numpy()
    # what the free cells need if those before are at their bounds; the first that fits holds
    factor = (wanted[own] - before) / free
    fitting = pd.Series(np.where(factor <= bound, factor, np.nan)).groupby(own).first()
    return amount * fitting.fillna(pd.Series(bound).groupby(own).last()).to_numpy()[code]


def _fitted(tokens, weight, codes, shares, total):
    """The sample of `total` tokens by cell that is raked with the tokens as bounds, and whether
    its sums are the shares."""
    amount, best, since = weight * total, np.inf, 0
    for _ in range(MOST_ROUNDS):
        for code, share in zip(codes, shares):
            amount = _scaled(amount, tokens, code, total * share)
        sample = np.minimum(amount, tokens)
        error = max(
            np.abs(np.bincount(code, sample) / (total * share) - 1).max()
            for code, share in zip(codes, shares)
        )
        if error <= TOLERANCE:
            return sample, True
        best, since = (error, 0) if error < 0.99 * best else (best, since + 1)
        if since == 50:  # it no longer nears them
            break
    return sample, False


def _largest(tokens, weight, codes, shares, most):
    """The largest sample of at most `most` tokens that has the shares; if none has, the largest
    that is as raked."""
    low = min((tokens / weight).min(), most)
    sample, meets = _fitted(tokens, weight, codes, shares, low * (1 - TOLERANCE))
    if not meets:
        return low * weight
    high = min((np.bincount(code, tokens) / share).min() for code, share in zip(codes, shares))
    total = high = min(high, most)
    while high > low * (1 + TOLERANCE):
        tried, meets = _fitted(tokens, weight, codes, shares, total)
        if meets:
            sample, low = tried, total
        else:
            high = total
        if low == high:
            break
        total = (low * high) ** 0.5
    return sample


def calibrated(
    cells: DataFrame, kept_share: float | None = None, repeats: float = 1.0
) -> DataFrame:
    """The dimensions with `chance`, the part of the cell's tokens to be sampled, at most `repeats`:
    of the largest sample with the target shares, or of one with kept_share of the tokens.

    One task reads the cells; there is one for each combination of values, not for documents.
    """

    def fit(batches):
        parts = list(batches)
        if not parts:
            return
        all_cells = pd.concat(parts, ignore_index=True)
        all_cells["chance"] = 0.0
        live = all_cells[all_cells.weight > 0]
        if len(live):
            tokens, weight = live.tokens.to_numpy(), live.weight.to_numpy()
            codes, shares = [], []
            for d in DIMENSIONS:
                code = pd.factorize(live[d], use_na_sentinel=False)[0]
                share = live[f"t_{d}"].groupby(code).first().to_numpy()
                codes.append(code)
                shares.append(share / share.sum())
            weight = weight / weight.sum()
            bound = repeats * tokens
            if kept_share is None:
                sample = _largest(bound, weight, codes, shares, all_cells.tokens.sum())
            else:
                total = kept_share * all_cells.tokens.sum()
                sample = _fitted(bound, weight, codes, shares, total)[0]
                sample = _scaled(sample, bound, np.zeros(len(live), int), np.array([total]))
            all_cells.loc[live.index, "chance"] = np.minimum(sample / tokens, repeats)
        yield all_cells[[*DIMENSIONS, "chance"]]

    names = ", ".join(f"{d} string" for d in DIMENSIONS)
    return cells.repartition(1).mapInPandas(fit, f"{names}, chance double")


def sampled(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    kept_share: float | None = None,
    text_col: str = "text",
    id_col: str = "doc_id",
    source_col: str = "source",
    lang_col: str = "lang",
    topic: Column | None = None,
    seed: int = SEED,
    repeats: float = 1.0,
) -> DataFrame:
    """The documents sampled to the targets, with their own columns and, as __source, __lang,
    __topic and __chance, their cell and its probability. Without kept_share, as many as the
    targets allow; with `repeats` above 1 a document comes up to so many times."""
    spark = docs.sparkSession
    text = F.col(text_col)
    keys = {
        "source": F.col(source_col).cast("string"),
        "lang": F.col(lang_col).cast("string"),
        "topic": topic if topic is not None else topic_of(text),
    }
    keyed = docs.select(*[c.alias(d) for d, c in keys.items()], tokens_of(text).alias("tokens"))
    path = scratch_dir(spark, "cells")
    cells = with_targets(cells_of(keyed), targets or {})
    rake(cells).write.parquet(path)
    fitted = scratch_dir(spark, "chances")
    calibrated(spark.read.parquet(path), kept_share, repeats).write.parquet(fitted)
    chances = spark.read.parquet(fitted).select(
        *[F.col(d).alias(f"__{d}_of") for d in DIMENSIONS], F.col("chance").alias("__chance")
    )
    marked = docs.withColumns({f"__{d}": c for d, c in keys.items()})
    uniform = F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), text), F.lit(1 << 40)) / F.lit(
        float(1 << 40)
    )
    same = F.lit(True)
    for d in DIMENSIONS:
        same = same & F.col(f"__{d}").eqNullSafe(F.col(f"__{d}_of"))
    added = [f"__{x}" for x in (*DIMENSIONS, "chance")]
    whole = F.floor("__chance").cast("int")
    copies = whole + (uniform < F.col("__chance") - whole).cast("int")
    chosen = marked.join(chances, same).withColumn("__copies", copies).where("__copies > 0")
    if repeats > 1:
        chosen = chosen.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    return chosen.select(*own_columns(docs), *added)


def mix(docs: DataFrame, *args, **options) -> DataFrame:
    """The documents, with their own columns, sampled to the targets; see sampled."""
    return sampled(docs, *args, **options).select(*own_columns(docs))


def mixing_report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, lang, topic, chance) of the documents that are sampled."""
    return sampled(docs, **options).select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("__source").alias("source"),
        F.col("__lang").alias("lang"),
        F.col("__topic").alias("topic"),
        F.col("__chance").alias("chance"),
    )
