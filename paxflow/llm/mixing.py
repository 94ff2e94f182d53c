"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the word budget in proportion to its weight,
but no more than ``max_epochs`` times its own size; what a capped source
cannot take is dealt again among the others, by weight, until none is above
its cap. A source's target is then met by whole repetitions of all its
documents plus one more repetition of a seeded part of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paxflow.llm.store import WORD, running_total
from paxflow.plans.sizing import stored

WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def by_name() -> list[Column]:
    return [F.col("source").asc_nulls_last()]


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``source, source_size, source_start, target``, one row per source.

    ``sizes`` has (source, size). Weights are dealt to the sources in code
    point order, null last, repeating. ``source_start`` is the size of all
    sources before. A round fixes every source that is above its cap and
    deals the rest anew; the level only rises, so at most one round per
    source is needed, each a single aggregate row.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = running_total(totals.withColumn("one", F.lit(1)), by_name(), "one", "rank")
    started = running_total(ranked.drop("one"), by_name(), "source_size", "source_start")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    cap = (F.col("source_size") * F.lit(float(max_epochs))).alias("cap")
    sources = stored(started.select("source", "source_size", "source_start", weight.alias("weight"), cap), "sources")
    budget = budget_share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        above = F.col("cap") < F.lit(level) * F.col("weight")
        fixed, free = sources.agg(
            F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        raised = (budget - (fixed or 0.0)) / free if free else level
        if raised <= level:
            break
        level = raised
    share = F.lit(level) * F.col("weight")
    return sources.select(
        "source", "source_size", "source_start", F.when(F.col("cap") < share, F.col("cap")).otherwise(share).alias("target")
    )


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    budget_share: float = BUDGET_SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
) -> DataFrame:
    """One row per input row: ``id_col, size, source_size, target, taken, epochs``.

    ``epochs`` is how often the mix takes the document and ``taken`` its
    words times that. Documents of a source are ordered by the MD5 of seed
    and id; the fractional repetition takes those whose middle lies inside
    the missing words, so a source misses its target by at most half a
    document. A null text has size 0 and is taken like any other; null
    sources are one source of their own; a null id is drawn as the text
    "null"; repeated rows are separate documents. An empty table gives an
    empty result.
    """
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    sizes = stored(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), draw.alias("draw")
        ),
        "sizes",
    )
    targets = source_targets(sizes, weights, budget_share, max_epochs).withColumnRenamed("source", "of")
    order = [*by_name(), F.col("draw"), F.col("id").asc_nulls_last(), F.col("size")]
    placed = running_total(sizes, order, "size", "before")
    joined = placed.join(targets, F.col("source").eqNullSafe(F.col("of")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    missing = F.col("target") - F.col("whole") * F.col("source_size")
    middle = F.col("before") - F.col("source_start") + F.col("size") / F.lit(2.0)
    return (
        joined.withColumn("whole", whole)
        .withColumn("epochs", (F.col("whole") + F.when((F.col("size") > 0) & (middle <= missing), 1).otherwise(0)).cast("int"))
        .select(
            F.col("id").alias(id_col),
            F.col("size"),
            "source_size",
            "target",
            (F.col("epochs") * F.col("size")).cast("long").alias("taken"),
            "epochs",
        )
    )
