import hashlib
import random

from entrygraph.llm import suffixes


def plain(rows):
    """Straight from the description, over whole rows; equal rows are one document."""
    keyed = sorted({(k is None, k or 0, suffixes.text_hash((t or "").encode())): (t or "").encode() for k, t in rows}.items())
    seen, out = {}, {}
    for n, (key, data) in enumerate(keyed):
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if seen.setdefault(data[i : i + 100], (n, i)) != (n, i):
                gone[i : i + 100] = b"\1" * 100
        kept = bytes(c for c, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[key] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return sorted([(str(k), *out[k is None, k or 0, suffixes.text_hash((t or "").encode())]) for k, t in rows])


def rows_of(seed):
    rng = random.Random(seed)
    letters = "abcdefgh é"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [make(n) for n in (99, 100, 101, 130, 400, 75, 60)]
    rows = []
    for i in range(150):
        text = "".join(rng.choice([make(rng.randint(0, 120)), rng.choice(passages)]) for _ in range(rng.randint(1, 6)))
        rows.append((rng.randint(0, 120), text))
    rows += [(500, "x" * 1000), (501, "ab" * 300), (502, "x" * 99), (2, None), (None, ""), (None, passages[4]), (7, passages[4] * 3)]
    rows += [(900, make(200)), rows[0], rows[1], rows[1]]
    rows += [(901, make(150_000) + passages[4] + make(140_000) + passages[3]), (300, "q" + passages[4][:250] + "z" + passages[4][120:])]
    return rows


def test_against_the_description(spark):
    for seed, parts in ((1, 1), (2, 3)):
        rows = rows_of(seed)
        docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_bytes int").repartition(parts)
        got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeated_spans(docs).collect())
        assert got == plain(rows)


def test_small_sends_and_empty(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HELD", 50)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffixes, "BUCKET_WINDOWS", 50)
    rows = rows_of(3)[:170]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.repeated_spans(docs).collect())
    assert got == plain(rows)
    assert suffixes.repeated_spans(docs.limit(0)).count() == 0
