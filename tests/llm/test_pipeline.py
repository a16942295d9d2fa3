"""The corpus pipeline, stage by stage and as a whole, against plain Python on small tables."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from commentlens.llm import toxicity
from tests.llm.test_operators import by_hand, components_by_hand, prose, windows_by_hand, words_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def made() -> tuple[list[tuple], list[tuple], list[tuple]]:
    rnd = random.Random(12)
    items = [(k, " ".join(words_of(prose(900 + k, 30)))) for k in range(4)]
    docs, labels = [], []
    for i in range(120):
        body = words_of(prose(3000 + i, rnd.choice([30, 80, 200])))
        bad = i % 6 == 0
        if bad:
            for _ in range(8):
                body[rnd.randrange(len(body))] = rnd.choice(["groliknau", "vumpakol", "zherrituk"])
        text = "\n".join(" ".join(body[k : k + 12]) for k in range(0, len(body), 12))
        if i % 5 == 1:
            text += "\nall rights are reserved by us"
        if i % 7 == 2:
            text += "\n" + items[i % 4][1]
        docs.append((1000 - i, text, rnd.choice(["en", "de", None]), f"s{i % 4}" if i % 9 else None, len(text)))
        labels.append((1000 - i, 1, int(bad)))
    for k, i in enumerate(range(3, 90, 10)):  # near and exact copies
        words = docs[i][1].split(" ")
        words[len(words) // 2] = f"new{k}" if k % 2 else words[len(words) // 2]
        docs.append((2000 + k, " ".join(words), "en", "s2", 1))
    docs += [(3000, "", "en", "s1", 0), (3001, None, None, "s1", 0), (3002, "all rights are reserved by us", "en", "s3", 29)]
    return docs, labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels, items = made()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def kept_by_score(spark, docs: list[tuple], folder: str) -> list[tuple]:
    frame = spark.createDataFrame(docs, SCHEMA)
    scores = {r["doc_id"]: r["toxicity"] for r in toxicity.scored(frame, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    return [d for d in docs if scores[d[0]] < 0.5]


def without_lines(docs: list[tuple]) -> list[tuple]:
    out = []
    for d, text in zip(docs, by_hand(docs)):
        if text == d[1]:
            out.append(d)
        elif words_of(text):
            out.append((d[0], text, *d[2:4], len(text)))
    return out


def one_of_each(docs: list[tuple]) -> list[tuple]:
    return [d for d, (i, n, least) in zip(docs, components_by_hand(docs)) if n == 0 or i == least]


def without_items(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    out = []
    for d in docs:
        n, hit, _ = windows_by_hand(d[1], items)
        if not (hit and 20 * hit >= n):
            out.append(d)
    return out


def stage(spark, k: int, docs: list[tuple], folder: str):
    frame = spark.createDataFrame(docs, SCHEMA)
    found = corpus_pipeline.STAGES[k][1](spark, frame, folder)
    if k < 4:
        assert found.columns == COLUMNS and found.dtypes == frame.dtypes
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram join", "decontamination", "mixing"]


def test_each_stage(spark, folder):
    docs, _, items = made()
    same = lambda k, want: stage(spark, k, docs, folder) == sorted(want, key=str)
    assert same(0, kept_by_score(spark, docs, folder)) and len(kept_by_score(spark, docs, folder)) < len(docs)
    assert same(1, without_lines(docs)) and same(2, one_of_each(docs)) and same(3, without_items(docs, items))
    taken = stage(spark, 4, docs, folder)
    sizes = {d[0]: len(words_of(d[1])) for d in docs}
    assert len(taken) == len(docs) and all(r[2] == sizes[r[0]] and 0 <= r[5] <= 3 * r[2] for r in taken)


def test_stages_on_nothing(spark, folder):
    for k in range(5):
        assert stage(spark, k, [], folder) == []


def test_the_whole_pipeline(spark, folder):
    docs, _, items = made()
    left = without_items(one_of_each(without_lines(kept_by_score(spark, docs, folder))), items)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((d[0], len(words_of(d[1]))) for d in left)
    by_source: dict = {}
    for r in got:
        by_source.setdefault((r["source"], r["target"]), []).append(r["taken"])
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert all(abs(sum(taken) - target) <= max(50, target / 10) for (_, target), taken in by_source.items())
