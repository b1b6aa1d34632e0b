import math
import re
from collections import Counter

import numpy as np
import regex
from conftest_llm import ODD

from millwright.llm import quality
from millwright.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {p for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def check(got, rows):
    have = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got]
    assert sorted(have, key=str) == sorted([(d, *plain(t)) for d, t in rows], key=str)
    assert not any(r.kept and r.base_failed for r in got)


def test_counts_against_brute_force(spark, rows_of):
    got = quality.judge(table(spark, "/root/testdata/sf0.001", "documents")).collect()
    check(got, rows_of("documents", "doc_id, text"))
    junk = {r[0] for r in rows_of("labels", "doc_id, quality", "quality = 0")}
    good = {r[0] for r in rows_of("labels", "doc_id, quality", "quality = 1")}
    kept = {r.doc_id for r in got if r.kept}
    assert len(junk & kept) <= 0.1 * len(junk)
    fine = {r.doc_id for r in got if not r.base_failed} & good
    assert len(fine & kept) >= 0.97 * len(fine)


def plain_votes(text):
    """The rules' votes, by their definition."""
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    n, chars, symbols, doubled, covered, _ = plain(text)
    capitals = sum(w == w.upper() != w.lower() and len(w) > 1 for w in words)
    ended = sum(bool(regex.search(r"[.!?…。！？][^\p{L}\p{N}]*$", x)) for x in lines)
    per = lambda a, b: a / b if b else 0.0
    low = lambda x, good, bad: 1 if x <= good else -1 if x >= bad else 0
    return [
        low(per(symbols, n), 0.02, 0.1),
        low(per(doubled, len(lines)), 0.05, 0.3),
        low(per(covered, n), 0.1, 0.2),
        low(abs(per(chars, n) - 5), 1.3, 2.0),
        low(-per(len(set(words)), min(n, 2000)), -0.5, -0.3),
        low(per(capitals, n), 0.1, 0.3),
        low(-per(sum(bool(regex.search(r"\p{L}", w)) for w in words), n), -0.95, -0.8),
        low(-per(ended, len(lines)), -0.6, -0.2),
    ]


def plain_posteriors(votes, rounds=200):
    """Expectation-maximisation text by text, without patterns or sufficient counts."""
    votes = np.array(votes)
    good = ((votes == 1).sum(axis=1) + 0.5) / ((votes != 0).sum(axis=1) + 1)
    for _ in range(rounds):
        prior = (good.sum() + 1) / (len(votes) + 2)
        odds = np.full(len(votes), math.log(prior / (1 - prior)))
        for column in votes.T:
            for v in (-1, 0, 1):
                hit = column == v
                of_good = (good[hit].sum() + 1) / (good.sum() + 3)
                of_bad = ((1 - good)[hit].sum() + 1) / ((1 - good).sum() + 3)
                odds[hit] += math.log(of_good / of_bad)
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        moved, good = np.abs(new - good).max(), new
        if moved < 1e-9:
            break
    return good


def test_verdicts_against_brute_force(spark, rows_of):
    rows = dict(rows_of("documents", "doc_id, text"))
    got = {r.doc_id: r for r in quality.judge(table(spark, "/root/testdata/sf0.001", "documents")).collect()}
    votes = {d: plain_votes(t) for d, t in rows.items()}
    names = [f"vote_{r.name}" for r in quality.rules()]
    assert {d: [r[n] for n in names] for d, r in got.items()} == votes
    ids = [d for d, t in rows.items() if not plain(t)[-1]]
    good = dict(zip(ids, plain_posteriors([votes[d] for d in ids]), strict=True))
    assert all(abs(got[d].good - p) < 1e-6 for d, p in good.items())
    assert {d for d, r in got.items() if r.kept} == {d for d, p in good.items() if p >= 0.5}
    assert 0 < sum(p >= 0.5 for p in good.values()) < len(rows)


def test_odd_rows(documents):
    rows = [
        *ODD,
        (20, "a b c d e a b c d e f"),
        (21, "a a a a a a a"),
        (22, "x\nx\n\n x\nx"),
        (23, "a b c d e x a b c d e a b c d e"),
        (24, "1 # * $ % & | < >"),
        (25, "dup\r\ndup\r\ndup"),
    ]
    check(quality.judge(documents(*rows)).collect(), [r[:2] for r in rows])


def test_empty_table(documents):
    assert quality.judge(documents()).collect() == []


def test_main_path_is_native(documents):
    plan = quality.measured(documents(*ODD))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_estimation_finds_the_accurate_rule():
    good = [((1, 1, 1), 700), ((1, 1, -1), 150), ((1, 0, 1), 50)]
    bad = [((-1, -1, 1), 40), ((-1, -1, -1), 50), ((-1, 1, -1), 10)]
    model = quality.estimate([*good, *bad])
    assert abs(model.prior - 0.9) < 0.02
    first, last = model.votes[0], model.votes[2]
    assert first[1][-1] > 0.9 and first[0][1] > 0.9
    assert last[0][1] - last[1][1] < first[0][1] - first[1][1]
    assert quality.estimate([]).votes == []
