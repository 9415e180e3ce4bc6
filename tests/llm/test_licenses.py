import random
import re

from entrygraph.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_against_the_description(spark):
    rng = random.Random(3)
    pool = ["under", "the", "MIT", "License", "apache", "version", "2", "cc", "BY", "nc", "xİ", "é", "mitK", "K", "\x7f"]
    texts = [None, "", " ", "...", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Apache License, Version 2.0", "under the mit license under the mit license", "cc by nc", "ncc by nc by nc cc by nc"]
    texts += [rng.choice(["", " ", "é"]) + "".join(rng.choice(pool) + rng.choice([" ", "-", ", ", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["w " * 30000 + "Under THE MIT license"]
    rows = list(enumerate(texts)) + [(None, "cc by nc"), (5, texts[5])]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, score double")
    got = sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(docs).collect() if r.doc_id is not None)
    assert got == sorted((k, *plain(t)) for k, t in rows if k is not None)
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_labels_of_the_method(spark):
    rows = [(1, "This work is licensed under the GNU General Public License, version 3."), (2, "licensed under the general store"), (3, "Permission is hereby granted, free of charge, to any person who gets a copy of the software"), (4, "Public license version 3 of the general")]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ("gpl-3", 1.0) and got[2][0] == "" and got[3][0] == "mit" and got[4][0] == ""
    assert all(0 <= s <= 1 for _, s in got.values())


def test_a_template_is_found_without_its_rarest_words(spark):
    rows = [(1, "released under the creative commons attribution sharealike licence")]
    (got,) = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert (got.labels, got.score) == ("cc-by-sa", 6 / 8)


def plain_labels(text):
    """Labels and score by trying every template at every place."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    labels, best = set(filter(None, plain(text)[4].split(","))), 0.0
    for template, label, key in licenses.TEMPLATES:
        t, k = template.split(), key.split()
        at = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
        share = 0.0
        for i in range(len(words) - len(k) + 1):
            if words[i : i + len(k)] == k:
                start = i - at
                share = max(share, sum(0 <= start + j < len(words) and words[start + j] == w for j, w in enumerate(t)) / len(t))
        best = max(best, share)
        if share >= licenses.SHARE:
            labels.add(label)
    return ",".join(sorted(labels)), 1.0 if plain(text)[1] else best


def test_labels_and_score_against_every_place(spark):
    rng = random.Random(8)
    texts = [None, ""]
    for template, _, key in licenses.TEMPLATES:
        words = template.split()
        texts += [template.upper(), " ".join(words[:-1]), "before " + ", ".join(words) + ". " + template, key, key + " " + key]
        for _ in range(4):
            some = [w if rng.random() < 0.75 else rng.choice(["other", "license", "the"]) for w in words]
            at = rng.randrange(len(some))
            texts.append("x " * rng.randint(0, 5) + " ".join(some) + rng.choice(["", " " + key]) + " " + " ".join(words[at:]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.labels, round(r.score, 9)) for r in licenses.scan_licenses(docs).collect()}
    assert got == {i: (p[0], round(p[1], 9)) for i, t in enumerate(texts) for p in [plain_labels(t)]}
    # what other documents hold decides nothing
    alone = {i: licenses.scan_licenses(docs.filter(f"doc_id = {i}")).first() for i in (5, 40, 90)}
    assert {i: (r.labels, round(r.score, 9)) for i, r in alone.items()} == {i: got[i] for i in alone}
