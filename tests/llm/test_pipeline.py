import hashlib
import random

import public_tokenizers as P

import corpus_pipeline
from entrygraph.llm import bpe, decontaminate, quality


def made():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on", "é"]) for _ in range(rng.randint(1, 3)))
    line = lambda: " ".join(word() for _ in range(14)).capitalize() + "."
    shared = line()
    items = [(i, " ".join(word() for _ in range(20))) for i in range(5)]
    docs = []
    for i in range(160):
        text = [line() for _ in range(9)]
        if i % 7 == 0:
            text[3] = shared
        if i % 11 == 0:
            text[5] = text[5] + " " + items[i % 5][1]
        if i % 13 == 0 and docs:
            text = docs[-1][1].split("\n")
        if i % 17 == 0:
            text = [" ".join(w + "###" for w in x.split()) for x in text]
        docs.append((i, "\n".join(text), "en", "src", len("\n".join(text))))
    docs += [(300, None, "en", "s", 0), (301, "", None, "s", None), (302, docs[5][1], "en", "s", 5), (2, docs[2][1], "en", "src", docs[2][4])]
    return docs, items


def test_each_stage_against_plain_versions(spark, tmp_path):
    docs, items = made()
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {"": now.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != "encoding":
            assert out.columns == now.columns
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = now.collect()
    # quality: those under 50 words and the ones full of symbols go, clean ones stay
    good = {r.doc_id for r in kept["quality"]}
    assert not good & {300, 301} and not good & {i for i in range(160) if i % 17 == 0}
    assert len(good) > 140 and all(r in kept[""] for r in kept["quality"])
    # lines: nothing stands twice; what is left are lines of the input
    seen = [x for r in sorted(kept["lines"], key=lambda r: r.doc_id) for x in set(r.text.split("\n"))]
    assert len(seen) - len(set(seen)) <= len([r for r in kept["lines"] if r.doc_id == 2]) * 9
    assert all(r.n_chars == len(r.text) for r in kept["lines"])
    assert {x for r in kept["lines"] for x in r.text.split("\n")} == {x for r in kept["quality"] for x in r.text.split("\n")}
    # near-duplicates: one of each class by all pairs
    rows = sorted(kept["lines"], key=lambda r: r.doc_id)
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (r.text.lower().split() for r in rows)]
    label = list(range(len(rows)))
    for _ in rows:
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if len(x & y) >= 0.8 * len(x | y):
                    label[i] = label[j] = min(label[i], label[j])
    assert sorted(r.doc_id for r in kept["near_duplicates"]) == sorted({rows[i].doc_id for i in set(label)})
    # decontamination
    index = decontaminate.Items(items)
    assert {r.doc_id for r in kept["decontamination"]} == {r.doc_id for r in kept["near_duplicates"] if not any(decontaminate.words_of(t) and any(decontaminate.similarity(decontaminate.words_of(r.text)[i : i + 20], decontaminate.words_of(t), 5) >= 0.8 for i in range(max(0, len(r.text.split()) - 19))) for _, t in items)}
    assert index.ids == [0, 1, 2, 3, 4]
    # encoding: the ids decode to the texts
    texts = {r.doc_id: r.text for r in kept["decontamination"]}
    back = {i: b for b, i in bpe.read_ranks(P.path(corpus_pipeline.RANKS)).items()}
    assert {r.doc_id for r in kept["encoding"]} == set(texts)
    for r in kept["encoding"]:
        assert b"".join(back[i] for i in r.ids).decode() == texts[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    same = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in same) == sorted((r.doc_id, r.ids_sha256) for r in kept["encoding"])
    assert quality.RULES


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
