import random

import duckdb

from entrygraph.llm import decontaminate


def made(seed=4):
    rng = random.Random(seed)
    pool = ["aa", "Bb", "cc", "dd", "é", "ff", "gg"]
    text = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(i, text(rng.randint(1, 40))) for i in range(40)] + [(100, ""), (101, "aa bb cc"), (102, "zz")]
    docs = []
    for i in range(250):
        t = text(rng.randint(0, 60)).split()
        if rng.random() < 0.6:
            own = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, 2)):
                if own and rng.random() < 0.7:
                    own[rng.randrange(len(own))] = "other"
            cut = rng.randint(0, len(t))
            t = t[:cut] + own + t[cut:]
        docs.append((i, rng.choice([" ", "\n", " \t"]).join(t)))
    return docs + [(900, ""), (901, "x " * 3000 + items[3][1] + " y" * 3000)], items


def test_against_sql(spark):
    docs, items = made()
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, doc_id int")
    got = sorted((r.doc_id, r.item_id, r.start_word, r.n_words, round(r.similarity, 9)) for r in decontaminate.matches(d, b).collect())
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into benchmark values (?, ?)", items)
    want = sorted((*r[:4], round(r[4], 9)) for r in con.execute(decontaminate.ORACLE).fetchall())
    assert got == want and len(got) > 100
    dirty = {r[0] for r in want}
    kept = decontaminate.clean_documents(d, b)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {k for k, _ in docs} - dirty


def test_nulls_repeats_and_runs(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 10)
    d = spark.createDataFrame([(1, None), (None, "one two three four five six"), (2, "one two three four five six"), (2, "one two three four five six")], "doc_id long, text string")
    b = spark.createDataFrame([(None, "one two three four five six"), (5, None), (6, "one two three four five six"), (6, "one two three four five six")], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in decontaminate.matches(d, b).collect()]
    assert len(got) == 9 and got.count((2, 6)) == 4 and got.count((None, None)) == 1
    assert decontaminate.clean_documents(d, b).count() == 1
    assert decontaminate.matches(d, b.limit(0)).count() == 0 and decontaminate.matches(d.limit(0), b).count() == 0
    assert decontaminate.clean_documents(d, b.limit(0)).count() == 4


def test_stretches_are_cut_with_what_windows_need():
    for a, b, span, most in ((0, 100, 7, 10), (5, 6, 3, 10), (0, 20, 30, 10)):
        parts = list(decontaminate._cut([(a, b)], span, most))
        assert parts[0][0] == a and parts[-1][1] == b
        for start in range(a, b - span + 1):
            assert any(x <= start and start + span <= y for x, y in parts)


def test_an_item_less_its_last_words(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(1, " ".join(item.split()[:-2])), (2, " ".join(item.split()[:-8])), (3, "w0 w1 w2 w3")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string")
    got = decontaminate.matches(d, b).collect()
    assert [(r.doc_id, r.start_word, r.n_words, round(r.similarity, 6)) for r in got] == [(1, 0, 28, round(24 / 26, 6))]
    assert sorted(r.doc_id for r in decontaminate.clean_documents(d, b).collect()) == [2, 3]
