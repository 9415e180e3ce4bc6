import hashlib
import random


from entrygraph.llm import lines


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def plain(rows):
    """All pairs, straight from the description; rows have distinct doc_ids."""
    earlier, out = [], {}
    for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        kept, exact, near = [], 0, 0
        for line in [] if t is None else t.split("\n"):
            norm = line.strip(" \t\r")
            if not norm:
                kept.append(line)
                continue
            if norm in earlier:
                exact += 1
            elif len(norm) >= 20 and any(len(e) >= 20 and abs(len(e) - len(norm)) < 2 and edits(e, norm) <= 1 for e in earlier):
                near += 1
            else:
                kept.append(line)
            earlier.append(norm)
        out[k] = (0 if t is None else len(t.split("\n")), exact, near, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def rows_of(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(17, 24))) for _ in range(25)] + ["a" * 22, "a" * 21 + "b", "x" * 300, "ab" * 11]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rng.randint(0, 5)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 2)):
                p = rng.randrange(len(line))
                line[p : p + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
            text.append(rng.choice(["", " ", "\t"]) + "".join(line) + rng.choice(["", "\r", " "]))
        text += rng.choice([[], [""], ["  "], ["short"], ["short"]])
        rows.append((i, "\n".join(text)))
    return rows + [(500, None), (None, base[0] + "\n" + base[1]), (501, ""), (502, "\n\n"), (503, "\n".join(base[:4]) * 30)]


def test_against_all_pairs(spark):
    for seed in (1, 2):
        rows = rows_of(seed)
        docs = spark.createDataFrame([(*r, 3, "e") for r in rows], "doc_id long, text string, line_no int, near string")
        got = {r.doc_id: (r.n_lines, r.n_exact, r.n_near, r.kept_sha256) for r in lines.line_report(docs).collect()}
        assert got == plain(rows)
        assert sum(v[2] for v in got.values()) > 20


def test_repeated_rows_extra_columns_and_empty(spark):
    names = ["th", "k", "row", "kept", "exact", "near", "n_exact", "_th", "_n_lines", "_kept", "_exact", "a b"]
    rows = [(1, "a line that is long enough\nshort"), (1, "a line that is long enough\nshort"), (2, "A line that is long enough\nshort\n "), (3, None)]
    docs = spark.createDataFrame([(k, *[f"{n}{k}" for n in names[:6]], t, *[f"{n}{k}" for n in names[6:]]) for k, t in rows], ["doc_id", *names[:6], "text", *names[6:]])
    got = lines.clean_lines(docs)
    assert got.columns == docs.columns
    want = [(k, *[f"{n}{k}" for n in names[:6]], {2: " "}.get(k, t), *[f"{n}{k}" for n in names[6:]]) for k, t in rows]
    assert sorted(map(tuple, got.collect())) == want
    assert lines.line_report(docs.limit(0)).count() == 0 and lines.clean_lines(docs.limit(0)).count() == 0


def test_very_long_lines(spark):
    """A near copy of a line of 100,000 characters is found, wherever the edit is; the neighbourhood stays small."""
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(100_000)).strip() + "."
    n = len(base)
    copies = [base[:7] + "X" + base[8:], base[: n // 2] + base[n // 2 + 1 :], base[:-3] + "Y" + base[-3:], base[: n // 3] + "XY" + base[n // 3 :]]
    docs = spark.createDataFrame([(0, base), *[(i + 1, c) for i, c in enumerate(copies)]], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_near) for r in lines.line_report(docs).collect()) == [(0, 0), (1, 1), (2, 1), (3, 1), (4, 0)]


def test_least_length_is_an_argument(spark):
    docs = spark.createDataFrame([(1, "ab"), (2, "abc"), (3, "x"), (4, "xyzw")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_near) for r in lines.line_report(docs, least=1).collect()) == [(1, 0), (2, 1), (3, 0), (4, 0)]
    assert sum(r.n_near for r in lines.line_report(docs).collect()) == 0
