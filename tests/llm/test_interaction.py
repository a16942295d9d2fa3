"""Filter audit: late smaller ids, odd rows, and every figure against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter
from itertools import permutations

import pyarrow as pa
import pytest

from commentlens.llm import interaction

SCHEMA = "doc_id long, text string, lang string, mask int, key string, good int"


def fails(rows: list[tuple], labels: list[tuple]) -> list[tuple]:
    """Part, set of failing filters, good and toxic of every row."""
    least: dict = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good, toxic = ({i for i, *flag in labels if flag[k] == 1} for k in (0, 1))
    out = []
    for i, text, lang, *_ in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        found = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": i is not None and i > least[t],
        }
        out.append((lang or "", {k for k, v in found.items() if v}, i is not None and i in good, i is not None and i in toxic))
    return out


def audited(rows: list[tuple], labels: list[tuple]) -> Counter:
    docs, out = fails(rows, labels), Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = own
            for name in order:
                shapley[name] += sum(name in d[1] for d in left)
                left = [d for d in left if name not in d[1]]
        for order in permutations("ABCDE"):
            left = own
            for k, name in enumerate(order):
                gone = [d for d in left if name in d[1]]
                left = [d for d in left if name not in d[1]]
                every = sum(name in d[1] for d in own)
                unique = sum(d[1] == {name} for d in own)
                figures = (len(left), len(gone), every - len(gone), unique, sum(d[2] for d in gone), sum(d[3] for d in gone), shapley[name])
                out[(part, "".join(order), k + 1, *figures)] += 1
    return out


def made() -> tuple[list[tuple], list[tuple]]:
    rnd = random.Random(4)
    words = [f"w{k}" for k in range(300)]
    texts = []
    for _ in range(25):
        body = " ".join(rnd.choice(words[: rnd.choice([20, 300])]) for _ in range(rnd.choice([5, 199, 200, 260])))
        texts.append(body + rnd.choice(["", " $5", " ABC" * 40]))
    texts += ["", None, " \n", "é" * 70 + "ABC", "x" * 97 + "ABC"]
    # ids fall, so that later files hold the smaller ids; a hot text comes in every file
    rows = [(1000 - k, rnd.choice([*texts, *[texts[0]] * 12]), rnd.choice(["de", "en", None, ""]), 1, "k", 2) for k in range(160)]
    rows += [rows[5], rows[-1], rows[-1], (None, texts[0], "de", 1, "k", 2), (None, None, None, 1, "k", 2)]
    labels = [(1000 - k, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for k in range(0, 160, 2)] + [(999, 1, 0), (998, 0, 0), (998, 1, 1), (None, 1, 1)]
    return rows, labels


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows, labels = made()
    folder = str(tmp_path_factory.mktemp("audit"))
    for k in range(0, len(rows), 20):
        spark.createDataFrame(rows[k : k + 20], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def audit(spark, folder: str, batches: int):
    return interaction.audit(
        spark, f"{folder}/documents.parquet", spark.read.parquet(f"{folder}/labels.parquet"), interaction.document_rules(), batches=batches
    )


@pytest.mark.parametrize("batches", [1, 9])
def test_every_figure(spark, stored, batches):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = audit(spark, stored, batches).collect()
    assert Counter(tuple(r) for r in got) == audited(*made())
    assert len(got) == 3 * 600
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_earlier_counts_are_taken_back(spark, tmp_path):
    for k, i in enumerate([9, 5, 7, 2]):  # one file a batch, oldest first
        spark.createDataFrame([(i, "same text", "de")], "doc_id long, text string, lang string").coalesce(1).write.mode("append").parquet(
            f"{tmp_path}/documents.parquet"
        )
    labels = spark.createDataFrame([(9, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    conditions = {"A": interaction.document_rules()["A"]}
    found = interaction.counters(spark, f"{tmp_path}/documents.parquet", labels, conditions, batches=4).where("n != 0").collect()
    assert sorted(tuple(r) for r in found) == [("de", 1, 0, 1, 1), ("de", 3, 0, 0, 2), ("de", 3, 1, 0, 1)]


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert audit(spark, str(tmp_path), 4).collect() == []


def test_a_file_as_path(spark, stored, tmp_path):
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"doc_id": [1, 2], "text": ["a", "a"], "lang": ["x", "x"]}), f"{tmp_path}/documents.parquet")
    labels = spark.read.parquet(f"{stored}/labels.parquet")
    found = interaction.counters(spark, f"{tmp_path}/documents.parquet", labels, {"A": interaction.document_rules()["A"]}).collect()
    assert sorted((r["mask"], r["n"]) for r in found if r["n"]) == [(1, 1), (3, 1)]


def test_copies_of_a_batch_become_one_row():
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c) for c in (["k"] * 5, ["de"] * 5, [1] * 5, [0] * 5, [0] * 5, [4, 3, None, 3, 9])],
        ["key", "part", "mask", "good", "toxic", "id"],
    )
    (out,) = interaction.reduce_copies(iter([batch]))
    assert out.to_pylist() == [{"key": "k", "part": "de", "mask": 1, "good": 0, "toxic": 0, "low": 3, "n_low": 2, "n": 4, "n_null": 1}]
