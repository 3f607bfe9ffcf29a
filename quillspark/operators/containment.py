"""Which texts hold which phrases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.operators.blocks import against, small

#: Words of an anchor at most.
ANCHOR = 4


def containing(texts: DataFrame, tid: str, text: str, phrases: DataFrame, pid: str, phrase: str) -> DataFrame:
    """(tid, pid) for each row of texts whose text holds a phrase as a substring; both normalised to single blanks.

    Where a phrase stands in a text, its words but the first and last stand there whole. Up to four of them are its anchor,
    found by an equality join with the texts' runs of as many words, and every hit is verified. Phrases of fewer than three
    words have no anchor and meet the texts block by block.
    """
    words = F.split(phrase, " ")
    inner = F.size(words) - 2
    anchored = phrases.withColumn("_g", F.least(inner, F.lit(ANCHOR))).where(F.col("_g") > 0)
    anchored = anchored.select(pid, phrase, "_g", F.xxhash64(F.array_join(F.slice(words, F.lit(2), F.col("_g")), " ")).alias("_h"))
    sizes = sorted(r["_g"] for r in anchored.select("_g").distinct().collect())  # at most ANCHOR rows
    out = None
    if sizes:
        # split once a text, as a variable of the lambda: a split inside the inner one would be done again at every word
        run = lambda own, g: F.when(F.size(own) >= g, F.transform(F.sequence(F.lit(1), F.size(own) - g + 1), lambda i: F.xxhash64(F.array_join(F.slice(own, i, F.lit(g)), " "))))
        runs = F.element_at(F.transform(F.array(F.split(text, " ")), lambda own: F.array(*[F.array_distinct(run(own, g)) for g in sizes])), 1)
        # in a step of its own, so that the words' rows are made and joined by generated code, without copies of the text
        dealt = texts.where(F.col(text).isNotNull()).select(tid, text, runs.alias("_runs"))
        keyed = [dealt.select(tid, text, F.lit(g).alias("_g"), F.explode(F.col("_runs")[k]).alias("_h")) for k, g in enumerate(sizes)]
        hits = reduce(DataFrame.unionByName, keyed).join(small(anchored), ["_g", "_h"])
        # two phrases may share an anchor, but a text has each run once
        out = hits.where(F.col(text).contains(F.col(phrase))).select(tid, pid)
    short = phrases.where(inner <= 0)
    if short.limit(1).count():
        few = against(texts, short.select(pid, phrase), pid, F.col(text).contains(F.col(phrase)), lambda hits: hits.select(tid, pid))
        out = few if out is None else out.unionByName(few)
    return out if out is not None else texts.select(tid).join(phrases.select(pid)).limit(0)
