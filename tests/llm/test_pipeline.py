"""The pipeline's stages on a small corpus against what brute force says each must do."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from loamline.llm.queries import tokenizer_json


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(900)}" for _ in range(n))


def shingled(t):
    w = t.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_stages(spark, tmp_path):
    from tokenizers import Tokenizer

    item = prose(30, 10**6)
    data, toxic = [], set()
    for i in range(400):
        t = prose(40 + i % 30, i if i % 20 else 0)
        if i % 9 == 4:
            t, _ = t + " foulword", toxic.add(i)
        if i % 50 == 7:
            t += " " + item
        data.append((i, t, "en", f"s{i % 3}", len(t)))
    d = str(tmp_path)
    spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(400)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        stage(spark, docs, d).write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        kept[name] = docs.collect()
        assert name == "token_output" or docs.columns == before
    text = {r[0]: r[1] for r in data}
    ids = {k: {r.doc_id for r in v} for k, v in kept.items()}
    assert not ids["toxicity"] & toxic and len(ids["toxicity"]) >= 0.97 * (400 - len(toxic))
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    sets = {i: shingled(text[i]) for i in ids["toxicity"]}
    left = ids["ngram_join"]
    assert not any(near(sets[a], sets[b]) for a in left for b in left if a < b)
    assert all(any(near(sets[a], sets[b]) for b in ids["toxicity"] if b < a) for a in ids["toxicity"] - left)
    windows = {" ".join(item.split()[k : k + 10]) for k in range(21)}
    assert ids["decontaminate"] == {i for i in left if not any(w in " ".join(re.findall(r"\w+", text[i].lower())) for w in windows)}
    drawn = Counter(r.doc_id for r in kept["mixing"])
    assert set(drawn) <= ids["decontaminate"] and max(drawn.values()) <= 2
    size = lambda i: len(text[i].split())
    total = sum(size(i) for i in ids["decontaminate"])
    assert abs(sum(size(i) * n for i, n in drawn.items()) - 1.5 * total) < 400
    whole, start = Tokenizer.from_str(tokenizer_json()), 0
    for r in sorted(kept["token_output"], key=lambda r: r.start):
        tokens = [*whole.encode(text[r.doc_id], add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes()))
        start += len(tokens)
    assert len(kept["token_output"]) == sum(drawn.values())


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, _id string, row string"


def tables(spark, d, docs, labels=(), bench=()):
    spark.createDataFrame(list(docs), COLUMNS).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int, score int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(bench), "item_id long, text string, n_hit long").write.parquet(f"{d}/benchmark.parquet")


def stages(spark, d):
    docs, out = spark.read.parquet(f"{d}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, d).write.parquet(f"{d}/{name}")
        docs = spark.read.parquet(f"{d}/{name}")
        out[name] = docs
    return out


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and columns of the operators' own names."""
    d, item = str(tmp_path), prose(12, 10**6)
    long = prose(60_000, 5)
    data = [
        (1, prose(50, 1), "en", "a", 1, 0.5, 1, "x", "r"), (1, prose(50, 1), "en", "a", 1, 0.5, 1, "x", "r"), (2, None, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, 0.5, 1, "x", "r"), (4, long, "en", None, 1, 0.5, 1, "x", "r"), (5, long + " more", "en", "b", 1, 0.5, 1, "x", "r"),
        (None, prose(50, 2), None, "b", None, 0.1, 0, "x", "r"), (None, prose(50, 2), None, "b", None, 0.1, 0, "x", "r"), (6, prose(20, 3) + " " + item, "en", "b", 1, 0.5, 1, "x", "r"),
        (7, " \n ", "en", "a", 3, 0.5, 1, "x", "r"), (8, prose(50, 8), "en", "a", 1, None, None, None, None), (8, prose(50, 9), "en", "a", 1, 0.5, 1, "x", "r"),
    ]
    tables(spark, d, data, [(1, 1, 0, 1), (None, 1, 1, 1), (4, None, None, None)], [(1, item, 1), (None, None, 1), (2, "", 1)])
    out = stages(spark, d)
    kinds = dict(spark.read.parquet(f"{d}/documents.parquet").dtypes)
    assert all(dict(out[n].dtypes) == kinds for n, _ in corpus_pipeline.STAGES[:-1])
    assert Counter(map(tuple, out["toxicity"].collect())) == Counter(data)
    left = Counter(r.doc_id for r in out["ngram_join"].collect())
    assert left == {1: 2, 2: 1, 3: 1, 4: 1, None: 1, 6: 1, 7: 1, 8: 2}
    assert Counter(r.doc_id for r in out["decontaminate"].collect()) == left - Counter([6])
    drawn = Counter(r.doc_id for r in out["mixing"].collect())
    assert set(drawn) <= {1, 4, None, 8} and drawn[4] and all(n <= 2 * left[i] for i, n in drawn.items())
    assert out["token_output"].count() == sum(drawn.values())


@pytest.mark.parametrize("rows", [0, 1])
def test_stages_on_empty_tables(spark, tmp_path, rows):
    d = str(tmp_path)
    tables(spark, d, [(1, prose(50, 1), "en", "a", 1, 0.5, 1, "x", "r")] * rows)
    assert {n: x.count() for n, x in stages(spark, d).items()} == dict.fromkeys([n for n, _ in corpus_pipeline.STAGES], rows) | ({"mixing": 2, "token_output": 2} if rows else {})


def test_run_is_the_stages_in_turn(spark, tmp_path):
    d = str(tmp_path)
    tables(spark, d, [(i, prose(50, i % 20), "en", f"s{i % 2}", 1, 0.5, 1, "x", "r") for i in range(40)])
    want = {tuple(r) for r in stages(spark, d)["token_output"].collect()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, d).collect()} == want
