"""Quality rules with risk-controlled cutoffs.

Each rule is a score of the text that grows with suspicion. Labelled documents
tell, for each stratum and rule, how many good documents a cutoff would reject.
A cutoff may be used only if an exact binomial test shows, at a level corrected
for all strata and rules, that it rejects at most its share of good documents;
within a rule cutoffs are tested from the mildest on until one fails, which
needs no further correction. So with probability 1 - confidence_loss no stratum
loses more than max_false_rejection of its good documents to all rules together.
A stratum with too few labels to show that gets no cutoff, and loses nothing.

The thresholds come from counts over all labelled documents, not from a sample.

Edge cases: a null text has no words and fails the fixed base rules; a null
stratum is a stratum of its own; without labels no cutoff is set; a document
that is labelled twice counts twice; a label other than 0 or 1 is ignored.
"""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.frames import keep_ids, map_batches, prepare, texts_of
from starloom.session import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
CAPITALS, SMALL = string.ascii_uppercase.encode(), string.ascii_lowercase.encode()
MARKS = (string.digits + string.punctuation).encode()
MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_letters long, n_marks long"
# Scores between 0 and 1, in steps of 1 / GRID, from the measures. Each compares text with itself, so that length does not matter.
RULES = {
    "symbols": "n_symbols / greatest(n_words, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "upper_case": "n_upper / greatest(n_letters, 1)",
    "marks": "n_marks / greatest(word_chars, 1)",
}
GRID = 200


@dataclass(frozen=True)
class Risk:
    max_false_rejection: float = 0.02
    confidence_loss: float = 0.05
    # Among proven cutoffs, a point of good documents lost weighs as much as this many points of bad ones kept.
    loss_weight: float = 10.0
    # At most this many strata are broadcast with their cutoffs.
    broadcast_strata: int = 100_000


def measure_text(text: str) -> tuple[int, ...]:
    """The counts of one whole text, in the order of MEASURES. Letters, capitals and marks are those of ASCII."""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, covered = Counter(windows), 0
        for k, window in enumerate(windows):
            if seen[window] > 1:
                repeated += k + 3 - max(covered, k)
                covered = k + 3
    lines = [line for line in text.split("\n") if WORD.search(line)]
    data = text.encode("utf-8", "surrogatepass")
    upper = len(data) - len(data.translate(None, CAPITALS))
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        len(lines),
        upper,
        upper + len(data) - len(data.translate(None, SMALL)),
        len(data) - len(data.translate(None, MARKS)),
    )


def measure(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns in keep with the measures of each text. Reads only these columns and the text."""
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)
    names = [part.split()[0] for part in MEASURES.split(", ")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = zip(*map(measure_text, texts_of(batch, text)), strict=True)
        kept = [batch.column(name) for name in keep]
        return pa.RecordBatch.from_arrays([*kept, *(pa.array(c, pa.int64()) for c in columns)], [*keep, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in keep)
    return map_batches(source, work, f"{schema}, {MEASURES}")


def filter_documents(docs: DataFrame, labels: DataFrame, key: str = "doc_id", stratum: str = "lang", text: str = "text", risk: Risk = Risk()) -> DataFrame:
    """The rows of docs that neither the fixed rules nor the learned cutoffs reject, with docs' own columns."""
    own = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    plain = docs.toDF(*own.values())
    marked = keep_ids(plain, labels.select(F.col(key).alias(own[key])), own[key])
    measured = stage(measure(marked, [own[key], own[stratum]], own[text]), "measures")
    chosen = cutoffs(measured, labels.withColumnRenamed(key, own[key]), own[key], own[stratum], risk)
    judged = judge(measure(plain, list(own.values()), own[text]), chosen, own[stratum], risk)
    return judged.filter("kept").select(*own.values()).toDF(*docs.columns)


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    return F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")


def _steps() -> Column:
    """Each rule's score as a whole number of grid steps, as (rule, step) rows. Rounded down, so equal scores share a step."""
    scores = [
        F.struct(F.lit(name).alias("rule"), F.expr(f"cast(floor(least({score}, 1) * {GRID}) as int)").alias("step"))
        for name, score in RULES.items()
    ]
    return F.explode(F.array(*scores))


def binomial_tail(hits: int, trials: int, rate: float) -> float:
    """P(X <= hits) for X of Binomial(trials, rate): the exact p-value of "the true rate is above rate"."""
    if hits >= trials:
        return 1.0
    log_p, log_q = math.log(rate), math.log1p(-rate)
    start = math.lgamma(trials + 1)
    logs = [start - math.lgamma(k + 1) - math.lgamma(trials - k + 1) + k * log_p + (trials - k) * log_q for k in range(hits + 1)]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def mildest_first(good: list[int], bad: list[int], rate: float, level: float, loss_weight: float) -> tuple[int | None, int, int]:
    """The best cutoff proven safe: (step from which on documents are rejected, good and bad ones it rejects).

    good and bad count the labelled documents by step. Cutoffs are tested from
    the mildest, which rejects the highest step alone, to ever stricter ones, up
    to the first that fails; any of those before it may be used. Of these the
    one with the most bad documents caught for the good ones lost is taken, the
    mildest on a tie; None if none catches more than it loses.
    """
    n_good, n_bad, lost, caught, most, best = sum(good), sum(bad), 0, 0, 0.0, (None, 0, 0)
    for step in range(len(good) - 1, 0, -1):
        lost += good[step]
        caught += bad[step]
        if binomial_tail(lost, n_good, rate) > level:
            break
        gain = caught / max(n_bad, 1) - loss_weight * lost / max(n_good, 1)
        if gain > most:
            most, best = gain, (step, lost, caught)
    return best


def cutoffs(measured: DataFrame, labels: DataFrame, key: str, stratum: str, risk: Risk = Risk()) -> DataFrame:
    """(stratum, rule, cutoff_step, n_good, n_bad, good_rejected, bad_rejected) for each stratum and rule that has a safe cutoff.

    measured holds key, stratum and measures of at least all labelled documents.
    The counts are summed by Spark; one task sees one stratum and rule, at most GRID + 1 counts.
    """
    marks = labels.select(F.col(key).alias("_key"), F.col("quality").alias("_good")).filter("_key is not null and _good in (0, 1)")
    joined = measured.join(marks, measured[key] == marks["_key"]).select(
        F.coalesce(F.col(stratum).cast("string"), F.lit("\0null")).alias("stratum"), "_good", _steps().alias("s")
    )
    counts = joined.groupBy("stratum", "s.rule", "s.step").agg(
        F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")
    )
    counts = stage(counts, "rule-counts")
    strata = max(1, counts.select("stratum").distinct().count())
    rate = risk.max_false_rejection / len(RULES)
    level = risk.confidence_loss / (strata * len(RULES))

    prepare(measured.sparkSession)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        good, bad = [0] * (GRID + 1), [0] * (GRID + 1)
        for step, g, b in zip(rows["step"], rows["good"], rows["bad"], strict=True):
            good[step], bad[step] = int(g), int(b)
        step, lost, caught = mildest_first(good, bad, rate, level, risk.loss_weight)
        if step is None:
            return pd.DataFrame(columns=["stratum", "rule", "cutoff_step", "n_good", "n_bad", "good_rejected", "bad_rejected"])
        return pd.DataFrame(
            {
                "stratum": [rows["stratum"].iloc[0]], "rule": [rows["rule"].iloc[0]], "cutoff_step": [step],
                "n_good": [sum(good)], "n_bad": [sum(bad)], "good_rejected": [lost], "bad_rejected": [caught],
            }
        )

    schema = "stratum string, rule string, cutoff_step int, n_good long, n_bad long, good_rejected long, bad_rejected long"
    return stage(counts.groupBy("stratum", "rule").applyInPandas(choose, schema), "cutoffs")


def judge(measured: DataFrame, chosen: DataFrame, stratum: str, risk: Risk = Risk()) -> DataFrame:
    """measured with base_failed, rejected_by (names of the learned rules that reject the text, sorted) and kept."""
    by_stratum = chosen.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff_step"))).alias("_cutoffs")
    )
    if by_stratum.limit(risk.broadcast_strata + 1).count() <= risk.broadcast_strata:
        by_stratum = F.broadcast(by_stratum)
    own = F.coalesce(F.col(stratum).cast("string"), F.lit("\0null"))
    rejects = [
        F.when(F.expr(f"floor(least({score}, 1) * {GRID})") >= F.col("_cutoffs")[name], F.lit(name))
        for name, score in sorted(RULES.items())
    ]
    joined = measured.withColumn("_stratum", own).join(by_stratum.withColumnRenamed("stratum", "_stratum"), "_stratum", "left")
    named = joined.withColumns({"base_failed": base_failed(), "rejected_by": F.array_compact(F.array(*rejects))})
    return named.withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("_stratum", "_cutoffs")
