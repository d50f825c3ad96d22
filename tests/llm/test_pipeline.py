"""Each stage of the corpus pipeline against a brute-force version over the rows it is given."""

import random

import numpy as np
import pytest
from chronokey.llm import quality, toxicity
from chronokey.llm.queries import not_held_out, tokenizer
from chronokey.llm.shared import read
from test_native import by_hand as mixed_by_hand
from test_texts import by_hand as toxicity_by_hand

pipeline = pytest.importorskip("corpus_pipeline")


def corpus(spark, path):
    rng = random.Random(13)
    words = ["".join(rng.choice("lmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    docs, labels = [], []
    for i in range(300):
        own = [rng.choice(words) for _ in range(rng.randint(5, 90))]
        if i % 6 == 1:
            own = [w + "###" for w in own]
        if i % 6 == 2:
            own[1] = own[-1] = rng.choice(["vilegob", "horridact"])
        docs.append((i, " ".join(own), "en", f"s{i % 4}" if i % 9 else None, 0))
        labels.append((i, int(i % 6 != 1), int(i % 6 == 2)))
        if i % 10 == 0:
            near = list(own)
            near[rng.randrange(len(near))] = "other"
            docs += [(1000 + i, " ".join(near), "en", "s1", 0), (2000 + i, docs[-1][1], "fr", "s2", 0)]
    docs += [(3000, None, None, None, None), (3001, "", "en", "s1", 0), (docs[0])]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def one_of_each(rows):
    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(r["text"]) for r in rows]
    up = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                low, high = sorted((up[i], up[j]))
                up = [low if x == high else x for x in up]
    return sorted(min(rows[i]["doc_id"] for i in range(len(rows)) if up[i] == g) for g in set(up))


def test_stages(spark, tmp_path):
    import sentencepiece

    path = str(tmp_path)
    corpus(spark, path)
    labels, docs = read(spark, path, "labels"), read(spark, path, "documents")
    stages = [f for _, f in pipeline.STAGES]

    def step(stage, docs, n):
        stage(spark, docs, path).write.parquet(f"{path}/out{n}")
        return spark.read.parquet(f"{path}/out{n}")

    def ids(rows):
        return sorted(r["doc_id"] for r in rows)

    model, rows = quality.train(docs, labels, "quality"), docs.collect()
    good = []
    for r in rows:
        idx, val = quality.shares(r["text"])
        score = quality.SCALE * float(model.weights[idx].astype(float) @ val) if len(idx) else 0.0
        if 1 / (1 + np.exp(-(score - model.thresholds[-1]))) >= 0.5:
            good.append(r)
    docs = step(stages[0], docs, 0)
    assert ids(docs.collect()) == ids(good) and len(good) < len(rows)

    model, rows = toxicity.train(docs, labels, not_held_out()), docs.collect()
    good = [r for r in rows if toxicity_by_hand(model, r["text"]) < 0.5]
    docs = step(stages[1], docs, 1)
    assert ids(docs.collect()) == ids(good) and len(good) < len(rows)

    rows, docs = docs.collect(), step(stages[2], docs, 2)
    assert ids(docs.collect()) == one_of_each(rows) and docs.count() < len(rows) - 20

    want = mixed_by_hand([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()])
    docs = step(stages[3], docs, 3)
    got = {}
    for r in docs.collect():
        got[r["source"], r["doc_id"]] = got.get((r["source"], r["doc_id"]), 0) + 1
    assert got == {k: n for k, n in want.items() if n}

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    out = step(stages[4], docs, 4).collect()
    assert ids(out) == ids(docs.collect()) and all(list(r["ids"]) == library.encode(texts[r["doc_id"]]) and r["decodes"] for r in out)
