"""Batch-wide admission (T8): one byte budget shared fairly by all files.

``bytes.max`` caps each file; ``bytes.batch`` caps a batch.  A file's demand is
what it could send under ``bytes.max``: whole lines, so a half-written tail
demands nothing.  The budget is shared by deficit round robin in one step.
Every file with a demand gets the same level added to its credit (less where
it needs less), and the level is the highest that the budget covers:

    allowed = min(demand, max(0, level + credit))
    sum of min(level, max(0, demand - credit)) <= budget

So small backlogs are read whole, and large ones (a hot file with a third of all
bytes) get equal shares of the rest, whatever their size.  Shares then move to
line ends.  What a file was allowed and did not send (the next line did not
fit), or sent beyond it (a line longer than its share is read whole, as under
``bytes.max``), is its credit for the next batch, so shares are equal over time
though lines differ in length.  A file that sent all of its demand keeps no credit.

Over many batches the bytes sent follow the budget; one batch may exceed it by
less than a line of each file that it reads.  Where every file is still in debt
the level rises until one may send, so a step with a demand always sends.
Demands and credits are catalog-sized, and the level comes from a few passes of
64 sums each: no file list reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from appendlog.plans import rules as R

PROBES = 64  # levels tried per pass


def allowed_at(level: int, demand: int, credit: int) -> int:
    """Bytes that a file may send at ``level``."""
    return min(demand, max(0, level + credit))


def next_credit(share: int, demand: int, sent: int) -> int:
    """Credit that a file takes along: none if all of its demand was allowed."""
    return 0 if demand <= share else min(demand, share - sent)


def fair_level(files: Iterable[tuple[int, int]], budget: int) -> int | None:
    """The level for (demand, credit) pairs, None if every demand fits."""
    files = [(d, c) for d, c in files if d > 0]
    needs = [max(0, d - c) for d, c in files]
    if sum(needs) <= budget:
        return None
    low, high = 0, max(needs)  # the budget covers low, not high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if sum(min(n, mid) for n in needs) <= budget else (low, mid)
    return max(low, 1 - max(c for _, c in files))


def _demand() -> Column:
    return F.when((F.col("align") == R.ALIGN_RANGE) & (F.col("end_offset") > F.col("start_offset")),
                  F.col("end_offset") - F.col("start_offset")).otherwise(0).cast("bigint")


def fair_level_of(aligned: DataFrame, budget: int) -> int | None:
    """``fair_level`` of an aligned plan, by aggregates (the plan should be
    pinned: it is read once per pass)."""
    d = aligned.select(_demand().alias("d"), F.col("credit").alias("c")).where("d > 0").select(
        F.greatest(F.lit(0), F.col("d") - F.col("c")).alias("n"), "c")
    total, high, richest = d.agg(F.sum("n"), F.max("n"), F.max("c")).first()
    if total is None or total <= budget:
        return None
    low = 0
    while high - low > 1:
        step = max(1, -(-(high - low) // (PROBES + 1)))
        levels = list(range(low + step, high, step))
        sums = d.agg(*[F.sum(F.least("n", F.lit(x))) for x in levels]).first()
        low = max([low, *(x for x, s in zip(levels, sums) if s <= budget)])
        high = min([high, *(x for x, s in zip(levels, sums) if s > budget)])
    return max(low, 1 - richest)


def admit(aligned: DataFrame, budget: int) -> DataFrame | None:
    """``aligned`` (pinned) with the ends of its ranges brought within the
    budget, to be aligned again (which settles the credits: ``demand`` and ``share`` are added
    for it); None if everything fits."""
    level = fair_level_of(aligned, budget)
    if level is None:
        return None
    demand, share = _demand(), (F.col("credit") + F.lit(level)).cast("bigint")
    cut = F.col("demand") > F.greatest(F.lit(0).cast("bigint"), F.col("share"))
    return (aligned.withColumn("demand", demand).withColumn("share", share)
            .withColumn("end_offset", F.when(cut, F.col("start_offset") + F.greatest(F.lit(0).cast("bigint"), F.col("share")))
                        .otherwise(F.col("end_offset")))
            .withColumn("align", F.when(cut, F.col("align")).otherwise(R.ALIGN_NONE)))
