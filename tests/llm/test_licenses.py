import math
import re
import time

from conftest_llm import ODD

from millwright.llm import licenses
from millwright.llm.common import table
from millwright.llm.license_texts import TEXTS as WHOLE_TEXTS


def plain(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def check(got, rows):
    have = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(have, key=str) == sorted([(d, *plain(t)) for d, t in rows], key=str)
    for r in got:
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.labels.split(",") == sorted(set(r.labels.split(",")))


def test_against_brute_force(spark, rows_of):
    got = licenses.scan(table(spark, "/root/testdata/sf0.001", "documents")).collect()
    check(got, rows_of("documents", "doc_id, text"))


TEXTS = [
    (50, "All rights reserved. ALL RIGHTS RESERVED all-rights\nreserved", "reserved"),
    (51, "Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc"),
    (52, "code Released under the MIT License.", "mit"),
    (53, "the license of mit is nice", ""),
    (54, "This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    (55, "Licensed under the Apache License, Version 2.0 now", "apache-2.0"),
    (56, "x " * 40_000 + "licensed under the Apache License, Version 2.0", "apache-2.0"),
    (57, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    (58, "apache version 2 0 license", ""),
    (59, "Licensed under the very good Apache License, Version 2.0", "apache-2.0"),
    (60, "cc by cc by", "cc-by"),
    (61, "license", ""),
]


def by_hand(texts, coverage=0.6, slack=2, anchors=3):
    """The method's labels and score of every text, start by start and word by word."""
    split = lambda t: [w.decode() for w in licenses.WORDS.findall((t or "").lower().encode())]
    files = [split(t) for t in texts]
    base = [p.split() for p in licenses.PHRASES]
    templates = {n: (split(t), [split(m) for m in re.findall(r"\[([^\]]*)\]", t)]) for n, t in (licenses.TEMPLATES | WHOLE_TEXTS).items()}
    vocabulary = {w for words, _ in templates.values() for w in words} | {w for p in base for w in p}
    holding = {w: sum(w in set(f) for f in files) for w in vocabulary}
    idf = {w: math.log((len(files) + 1) / (n + 1)) + 1 for w, n in holding.items()}
    out = []
    for f in files:
        hit = lambda p, i: i >= 0 and f[i : i + len(p)] == p  # noqa: E731, B023
        labels = {label for phrase, label in licenses.PHRASES.items() if any(hit(phrase.split(), i) for i in range(len(f)))}
        score = 1.0 if labels else 0.0
        for name, (words, phrases) in templates.items():
            near = slack + len(words) // 20
            # The marked phrases stand in the template in order.
            places, at = [], 0
            for p in phrases:
                at = next(i for i in range(at, len(words)) if words[i : i + len(p)] == p)
                places.append((at, p))
                at += len(p)
            rare = sorted(set(words), key=lambda w: (-idf[w], w.encode()))[: max(anchors, len(words) // 10)]
            for start in range(-len(words), len(f)):
                some = lambda i, p: any(hit(p, start + i + d) for d in range(-near, near + 1))  # noqa: E731, B023
                if not all(some(i, p) for i, p in places):
                    continue
                if not any(w in rare and hit([w], start + i) for i, w in enumerate(words)):
                    continue
                if sum(any(v == w and some(i, [w]) for i, v in enumerate(words)) for w in rare) < min(2, len(rare)):
                    continue
                share = sum(idf[w] for i, w in enumerate(words) if some(i, [w])) / sum(idf[w] for w in words)
                if share >= coverage:
                    labels.add(name.split("/")[0])
                    score = max(score, min(1.0, share))
        out.append((",".join(sorted(labels)), round(score, 9)))
    return out


def plain_text(name):
    return WHOLE_TEXTS[name].replace("[", "").replace("]", "")


WHOLE = [
    ("x y z " + plain_text("mit/text") + " end", "mit"),
    ("Copyright me.\n" + plain_text("bsd-3-clause/text").replace("the copyright holder nor", "Some Company nor"), "bsd,bsd-3-clause"),
    (plain_text("bsd-2-clause/text"), "bsd,bsd-2-clause"),
    (plain_text("gpl-3.0/notice"), "gpl,gpl-3.0"),
    (plain_text("agpl-3.0/notice"), "agpl-3.0,gpl"),
    (plain_text("isc/text").replace("THE AUTHOR", "THE MAINTAINER"), "isc"),
    (plain_text("apache-2.0/notice").replace("(the", "of January (the"), "apache-2.0"),
    (plain_text("zlib/text")[:150], ""),
    (plain_text("zlib/text"), "zlib"),
    ("provided as is without warranty of any kind, express or implied", ""),
]


def test_labels_and_score_against_brute_force(documents):
    texts = [t for t, _ in WHOLE] + [t[:400] for _, t, _ in TEXTS] + ["apache version 2 0 " * 60, None, ""]
    got = licenses.scan(documents(*enumerate(texts))).collect()
    assert [(r.labels, round(r.score, 9)) for r in sorted(got, key=lambda r: r.doc_id)] == by_hand(texts)


def test_whole_texts(documents):
    got = licenses.scan(documents(*enumerate(t for t, _ in WHOLE))).collect()
    assert {r.doc_id: r.labels for r in got} == dict(enumerate(want for _, want in WHOLE))


def test_long_texts_of_common_anchors_take_linear_time():
    made = [licenses.Template(n, t) for n, t in (licenses.TEMPLATES | WHOLE_TEXTS).items()]
    index = licenses.Index(made, licenses.PHRASES, {}, 3)
    for text in ("apache version 2 0 ", "licensed under the apache license version 2 0 ", plain_text("mit/text")):
        words = licenses.WORDS.findall((text.lower() * (2_000_000 // len(text))).encode())
        start = time.process_time()
        index.scan(words, 2, 0.6)
        assert time.process_time() - start < 10


def test_notices_and_odd_rows(documents):
    rows = [*[r[:2] for r in ODD], *[r[:2] for r in TEXTS]]
    got = licenses.scan(documents(*rows)).collect()
    check(got, rows)
    labels = {r.doc_id: r.labels for r in got}
    assert {d: labels[d] for d, _, _ in TEXTS} == {d: want for d, _, want in TEXTS}


def test_idf_covers_all_documents(documents):
    found = licenses.idf(documents((1, "mit x"), (2, "the mit"), (3, None)), {b"mit", b"the", b"zzz"})
    assert found[b"zzz"] > found[b"the"] > found[b"mit"]


def test_empty_table(documents):
    assert licenses.scan(documents()).collect() == []
