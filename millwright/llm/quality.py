"""Quality of texts by weak supervision, in DataFrame functions only.

Each rule votes good (1) or bad (-1) or abstains (0). Which votes a text gets depends on
its hidden class alone, rule by rule; expectation-maximisation over the counts of the
vote patterns estimates each rule's accuracies and the share of good texts, without any
labels. A text is kept if the posterior probability that it is good reaches a half. So
a text may fail a weak rule, and no rule decides alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import WORD, let, stored, take

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Votes by a column: bad from `bad` on, good up to `good`, or the other way round."""

    name: str
    value: Column
    good: float
    bad: float

    def vote(self) -> Column:
        up, down = (F.col(f"f_{self.name}") <= self.good, F.col(f"f_{self.name}") >= self.bad)
        if self.good > self.bad:
            up, down = (F.col(f"f_{self.name}") >= self.good, F.col(f"f_{self.name}") <= self.bad)
        return F.when(up, 1).when(down, -1).otherwise(0)


def _per(count: Column, of: Column) -> Column:
    return F.coalesce(F.try_divide(count.cast("double"), of), F.lit(0.0))


def rules() -> list[Rule]:
    """The default rules over the columns of `measured`."""
    n = F.col("n_words")
    return [
        Rule("symbols", _per(F.col("n_symbols"), n), 0.02, 0.1),
        Rule("dup_lines", _per(F.col("n_dup_lines"), F.col("n_lines")), 0.05, 0.3),
        Rule("repeats", _per(F.col("n_repeat_words"), n), 0.1, 0.2),
        Rule("word_length", F.abs(_per(F.col("word_chars"), n) - 5.0), 1.3, 2.0),
        Rule("variety", _per(F.col("n_distinct"), F.least(n, F.lit(2000))), 0.5, 0.3),
        Rule("capitals", _per(F.col("n_capitals"), n), 0.1, 0.3),
        Rule("letters", _per(F.col("n_letters"), n), 0.95, 0.8),
        Rule("sentences", _per(F.col("n_ended"), F.col("n_lines")), 0.6, 0.2),
    ]


def repeat_words(words: Column) -> Column:
    """How many words stand in a window of five that the text has twice or more."""
    last = F.size(words) - WINDOW
    window = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    hashes = F.when(last >= 1, F.transform(F.sequence(F.lit(0), last), window)).otherwise(F.array().cast("array<bigint>"))

    def covered(starts: Column) -> Column:
        step = F.transform(starts, lambda p, i: F.least(F.coalesce(F.get(starts, i + 1) - p, F.lit(WINDOW)), F.lit(WINDOW)))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def repeated(ordered: Column) -> Column:
        same = lambda x, i: F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get(ordered, i + 1)["h"] == x["h"], F.lit(False)
        )
        return let(F.sort_array(F.transform(F.filter(ordered, same), lambda x: x["i"])), covered)

    def count(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(placed, repeated))

    return let(hashes, count)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules use, for every row; a null text has no words."""
    text = F.coalesce("text", F.lit(""))
    rows = take(docs, "doc_id", "text").select("doc_id", text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    rows = rows.withColumn("lines", lines)
    words, lines = F.col("words"), F.col("lines")
    capital = lambda w: (w == F.upper(w)) & (w != F.lower(w)) & (F.length(w) > 1)
    counts = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeat_words(words),
        "n_lines": F.size(lines),
        "n_distinct": F.size(F.array_distinct(words)),
        "n_capitals": F.size(F.filter(words, capital)),
        "n_letters": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))),
        "n_ended": F.size(F.filter(lines, lambda x: x.rlike(r"[.!?…。！？][^\p{L}\p{N}]*$"))),
    }
    return rows.select("doc_id", *[c.cast("long").alias(k) for k, c in counts.items()])


@dataclass(frozen=True)
class Model:
    """Share of good texts, and each rule's vote probabilities: good then bad texts."""

    prior: float
    votes: list[tuple[dict[int, float], dict[int, float]]]

    def posterior(self, votes: list[Column]) -> Column:
        odds = F.lit(math.log(self.prior / (1 - self.prior)))
        for column, (good, bad) in zip(votes, self.votes, strict=True):
            gain = {v: math.log(good[v] / bad[v]) for v in good}
            odds = odds + F.when(column == 1, gain[1]).when(column == -1, gain[-1]).otherwise(gain[0])
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200, smooth: float = 1.0) -> Model:
    """Expectation-maximisation over (votes, how many texts): 3**rules patterns at most.

    It starts from the share of good votes among those cast, and stops when the
    posteriors stand still. Without texts, all votes count as nothing.
    """
    width = len(patterns[0][0]) if patterns else 0
    good = [(p.count(1) + 0.5) / (len(p) - p.count(0) + 1) for p, _ in patterns]
    prior, tables = 0.5, []
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        weight = sum(g * n for g, (_, n) in zip(good, patterns, strict=True))
        prior = (weight + smooth) / (total + 2 * smooth)
        tables = []
        for k in range(width):
            sums = {v: [smooth, smooth] for v in (-1, 0, 1)}
            for g, (p, n) in zip(good, patterns, strict=True):
                sums[p[k]][0] += g * n
                sums[p[k]][1] += (1 - g) * n
            tables.append(
                (
                    {v: s[0] / (weight + 3 * smooth) for v, s in sums.items()},
                    {v: s[1] / (total - weight + 3 * smooth) for v, s in sums.items()},
                )
            )
        new = []
        for p, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(g[v] / b[v]) for v, (g, b) in zip(p, tables, strict=True))
            new.append(1 / (1 + math.exp(-max(-500.0, min(500.0, odds)))))
        moved = max((abs(a - b) for a, b in zip(good, new, strict=True)), default=0.0)
        good = new
        if moved < 1e-9:
            break
    return Model(prior, tables)


def judge(docs: DataFrame, checks: list[Rule] | None = None, min_words: int = 10, max_repeats: int = 20) -> DataFrame:
    """doc_id, counts, base_failed, kept, good and votes for every row of docs.

    base_failed: fewer than min_words words, or more than max_repeats per cent of them
    in repeated windows; such texts are not kept, and the rules' accuracies are estimated
    on all others, which are those that the verdict is for. good: the
    posterior probability. Null and empty texts fail; an empty table gives no rows.
    """
    checks = rules() if checks is None else checks
    rows = measured(docs)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeats * F.col("n_words"))
    rows = rows.withColumn("base_failed", failed)
    rows = rows.select("*", *[r.value.alias(f"f_{r.name}") for r in checks])
    names = [f"vote_{r.name}" for r in checks]
    kept = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    rows = stored(rows.select(*kept, *[r.vote().alias(n) for r, n in zip(checks, names, strict=True)]), "quality")
    counted = rows.where("not base_failed").groupBy(*names).count().orderBy(*names).collect()  # 3**rules rows at most
    model = estimate([(tuple(r[:-1]), r[-1]) for r in counted])
    good = model.posterior([F.col(n) for n in names]) if model.votes else F.lit(0.5)
    rows = rows.withColumn("good", good)
    return rows.select(*kept, (~F.col("base_failed") & (F.col("good") >= 0.5)).alias("kept"), "good", *names)
