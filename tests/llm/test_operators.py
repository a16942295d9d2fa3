"""Corpus operators on small frames with nulls, empty and long texts, ties, repeated rows and extra columns."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from commentlens.llm import chat, components, decontam, htmltext, linedup, lmscore, mixing, ngramjoin, qualitybayes, qualityrules, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, token string, size int, cls int, stop int"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    words = [rnd.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))


def rows() -> list[tuple]:
    """Documents with every odd case; the last columns clash with names the operators use."""
    base = prose(1, 300)
    near = base.replace("w7 ", "w8 ")
    texts = [base, base, near, prose(2, 300), "", None, " \n\t ", "one two", "one two", prose(3, 30_000), prose(4, 60), prose(4, 60)]
    made = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 4 else None, len(t or ""), "x", 1, 2, 3) for i, t in enumerate(texts)]
    made.append((None, prose(5, 80), "en", "s1", 0, None, None, None, None))
    made.append((None, None, None, None, None, None, None, None, None))
    made.append(made[3])  # a repeated row
    return made


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Mixing


def test_mix_sizes_targets_and_bounds(docs):
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows())
    size = Counter()
    for r in rows():
        size[r[3]] += len(words_of(r[1]))
    assert {r["source"]: r["source_size"] for r in found} == size
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    taken, target = Counter(), {}
    for r in found:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert sum(target.values()) == pytest.approx(sum(size.values()))
    for s, t in target.items():
        assert t <= 3 * size[s] + 1e-6
        assert taken[s] == pytest.approx(t, rel=0.02, abs=2)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(docs).collect()))


def test_mix_of_nothing(none):
    assert mixing.mix(none).count() == 0


def test_apportion_equals_highest_quotients(spark):
    rnd = random.Random(3)
    votes = [(g, p, float(rnd.choice([1, 5, 5, 100, 1000])), 17 + g) for g in range(3) for p in range(1 + 9 * g)]
    got = mixing.apportion(spark.createDataFrame(votes, "g long, p long, v double, n long"), "g", "p", "v", "n").collect()
    for g in range(3):
        own = [(p, v, n) for gg, p, v, n in votes if gg == g]
        quotients = sorted((-v / (2 * k + 1), p) for p, v, _ in own for k in range(own[0][2]))
        want = Counter(p for _, p in quotients[: own[0][2]])
        assert {r["p"]: r["quota"] for r in got if r["g"] == g} == {p: want[p] for p, _, _ in own}


# Line removal


def by_hand(data: list[tuple], least_sites: int = 3) -> list[str | None]:
    sites, first = defaultdict(set), {}
    for r in data:
        for at, line in enumerate((r[1] or "").split("\n") if r[1] is not None else []):
            if len(words_of(line)) >= 3:
                place = (2**63 - 1 if r[0] is None else r[0], at)
                sites[line].add(r[3])
                first[line] = min(first.get(line, place), place)
    out = []
    for r in data:
        if r[1] is None:
            out.append(None)
            continue
        doc = 2**63 - 1 if r[0] is None else r[0]
        out.append("\n".join(x for at, x in enumerate(r[1].split("\n")) if len(sites[x]) < least_sites or first[x] == (doc, at)))
    return out


def test_spread_lines_leave_their_first_place(docs):
    data = [(i, f"line {i} of its own\nshared by all of us\nshared by two only" if i < 2 else f"shared by all of us\n{i}", None, f"s{i}") for i in range(6)]
    frame = docs.sparkSession.createDataFrame(data, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["text"] for r in linedup.remove_spread_lines(frame).collect()}
    assert got == dict(zip([r[0] for r in data], by_hand(data), strict=True))
    assert got[0].endswith("shared by two only") and "all of us" in got[0] and got[4] == "4"


def test_spread_lines_of_odd_rows(docs, none):
    got = linedup.remove_spread_lines(docs, least_sites=2)
    assert sorted(map(str, [r["text"] for r in got.collect()])) == sorted(map(str, by_hand(rows(), 2)))
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    assert linedup.remove_spread_lines(none).count() == 0


def test_documents_without_an_id_are_spread(spark):
    frame = spark.createDataFrame([(None, prose(i, 20), "s0") for i in range(300)], "doc_id long, text string, source string")
    draws = mixing.sizes(frame).select("draw").distinct().count()
    assert draws == 300
    taken = mixing.mix(frame, shard_words=500).collect()
    assert len(taken) == 300 and abs(sum(r["taken"] for r in taken) - sum(r["size"] for r in taken)) <= 60


# Decontamination


def windows_by_hand(text: str | None, items: list[tuple], window: int = 13) -> tuple[int, int, set]:
    def split(t):
        low = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    words, hit, names = split(text), set(), set()
    for name, item in items:
        own = split(item)
        k = min(window, len(own))
        known = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if tuple(words[i : i + k]) in known:
                hit |= set(range(i, i + k))
                names.add(str(name))
    return len(words), len(hit), names


@pytest.mark.parametrize("block_bytes", [1 << 20, 120])
def test_suffix_arrays_equal_windows(spark, docs, block_bytes):
    base = rows()[0][1]
    items = [(1, " ".join(words_of(base)[20:60])), (2, "one TWO"), (3, None), (4, "?!"), (5, prose(9, 40)), (5, "w1"), (None, "w3 w4")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [("null" if n is None else n, t) for n, t in items]
    got = decontam.judged(decontam.matches(docs, bench, shard_words=500, block_bytes=block_bytes)).collect()
    assert len(got) == len(rows())
    for r in got:
        n, hit, names = windows_by_hand(r["text"], named)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(names))
        assert r["items_sha256"] == __import__("hashlib").sha256(",".join(sorted(names)).encode()).hexdigest()
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def longest_by_hand(text: str | None, items: list[tuple], window: int = 13) -> tuple:
    """Length, place and smallest name of the longest common run that holds a window of its item."""
    words, found = windows_words(text), []
    for name, item in items:
        own = windows_words(item)
        least = min(window, len(own))
        for i in range(len(words)):
            for j in range(len(own)):
                if words[i] == own[j] and (not i or not j or words[i - 1] != own[j - 1]):
                    n = 0
                    while i + n < len(words) and j + n < len(own) and words[i + n] == own[j + n]:
                        n += 1
                    if n >= least:
                        found.append((-n, i, str(name)))
    return (-min(found)[0], *min(found)[1:]) if found else (0, None, None)


def windows_words(text: str | None) -> list[str]:
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("shard_words, block_bytes", [(1 << 20, 1 << 20), (40, 1 << 20), (200, 100)])
def test_longest_matches_by_hand(spark, shard_words, block_bytes):
    rnd = random.Random(shard_words)
    few = ["a", "b", "c", "d"]
    say = lambda n, words: " ".join(rnd.choice(words) for _ in range(n))
    items = [(i, say(rnd.choice([1, 3, 14, 20, 40]), few if i % 2 else WORDS[:30])) for i in range(25)] + [(3, "a b a"), (30, "c c c c")]
    texts = []
    for i in range(60):
        own = words_of(rnd.choice(items)[1])
        cut = rnd.randrange(len(own))
        texts.append(f"{say(rnd.randint(0, 30), few)} {' '.join(own[cut:])} {say(rnd.randint(0, 20), WORDS[:30])} {' '.join(own)}")
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", None])], "doc_id long, text string").coalesce(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.judged(decontam.matches(frame, bench, shard_words=shard_words, block_bytes=block_bytes)).collect()
    for r in got:
        n, hit, names = windows_by_hand(r["text"], items)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, hit, len(names))
        assert (r["longest"], r["longest_at"], r["longest_item"]) == longest_by_hand(r["text"], items)


def test_many_equal_items_meet_a_common_word_once():
    import tracemalloc

    items = decontam.Items([(f"i{k}", "the") for k in range(400)], 13)
    shard = [np.array([1] * 200) for _ in range(400)]  # 80,000 times the word
    tracemalloc.start()
    found = decontam._search(shard, items)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    assert len(found) == 400 and len(found[7][1]) == 400 and found[7][0] == [{"start": 0, "stop": 200}] and found[7][2:] == (1, 0, "i0")


def test_columns_of_documents_never_meet_the_operators_own(spark):
    names = ["_hits", "_words", "n_hit", "n_words", "n_items", "contaminated", "longest", "row", "toxicity", "_gone", "_doc", "_body", "_own", "_row",
             "n_lines", "n_removed", "doc", "body", "site", "at", "line", "mark", "first"]
    schema = "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names)
    own = tuple(range(len(names)))
    data = [(i, f"line {i} of its own\nshared by all of us\nshared by all of them", f"s{i}", *own) for i in range(4)]
    frame = spark.createDataFrame(data, schema)
    bench = spark.createDataFrame([(1, "line 2 of its own")], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)], "doc_id long, toxic int")
    clean = decontam.remove_contaminated(frame, bench)
    assert clean.columns == frame.columns and sorted(tuple(r) for r in clean.collect()) == [d for d in data if d[0] != 2]
    lines = linedup.remove_spread_lines(frame)
    assert lines.columns == [*frame.columns, "n_lines_2", "n_removed_2"]
    assert {tuple(r)[3 : 3 + len(names)] for r in lines.collect()} == {own}
    assert {(r["doc_id"], r["n_lines_2"], r["n_removed_2"]) for r in lines.collect()} == {(0, 3, 0), (1, 3, 2), (2, 3, 2), (3, 3, 2)}
    kept = toxicity.remove_toxic(frame, labels, limit=1.1)
    assert kept.columns == frame.columns and sorted(tuple(r) for r in kept.collect()) == data


def test_longest_match_and_place(spark):
    text = prose(6, 200)
    item = "zz " + " ".join(words_of(text)[50:90]) + " yy"
    found = decontam.matches(spark.createDataFrame([(1, text)], "doc_id long, text string"), spark.createDataFrame([(7, item)], "item_id long, text string"))
    hits = found.first()["_hits"]
    assert (hits["longest"], hits["longest_at"], hits["longest_item"]) == (40, 50, "7")
    assert [tuple(s) for s in hits["spans"]] == [(50, 90)]


def test_decontamination_of_nothing(spark, docs, none):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.remove_contaminated(docs, empty).count() == len(rows())
    assert decontam.remove_contaminated(none, empty).count() == 0


# Near copies


def components_by_hand(data: list[tuple]) -> list[tuple]:
    sets = []
    for r in data:
        w = words_of((r[1] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    parent = list(range(len(data)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least: dict = {}
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i))) for i, r in enumerate(data)]


def test_near_copies_equal_all_pairs(spark, docs, none):
    got = [(r["doc_id"], r["n"], r["component_id"]) for r in ngramjoin.near_copies(docs).collect()]
    assert sorted(got, key=str) == sorted(components_by_hand(rows()), key=str)
    assert ngramjoin.near_copies(none).count() == 0


def test_chain_of_edits_and_trees(spark, monkeypatch):
    """Edits pile up along a chain; blocks of a few members make the trees meet in parts."""
    monkeypatch.setattr(ngramjoin, "BLOCK", 8)
    monkeypatch.setattr(ngramjoin, "LEADERS", 1)
    rnd, data, words = random.Random(8), [], prose(10, 120).split(" ")
    for i in range(60):
        if i:
            words = list(words)
            words[rnd.randrange(len(words))] = f"x{i}"
        data.append((i, " ".join(words)))
    rest = [(100 + i, prose(200 + i, 100) + "\n" + prose(10, 120)[:200]) for i in range(30)]
    frame = spark.createDataFrame(data + rest, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n"], r["component_id"]) for r in ngramjoin.near_copies(frame).collect())
    assert got == sorted(components_by_hand(data + rest))


def test_first_of_groups(docs):
    got = ngramjoin.first_of_groups(docs)
    want = components_by_hand(rows())
    ids = sorted((r["doc_id"] for r in got.collect() if r["doc_id"] is not None))
    assert ids == sorted({d for d, n, c in want if d is not None and (n == 0 or d == c)})
    assert got.columns == docs.columns


def test_tree_leaves_every_link():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 9, (40, ngramjoin.GROUPS))
    points = np.concatenate([base, np.maximum(base + (rnd.random(base.shape) < 0.02), 0), rnd.integers(0, 9, (200, ngramjoin.GROUPS))])
    n, part = points.sum(axis=1), np.arange(len(points))
    for rest, least in ((n, 40), (n - rnd.integers(0, n // 6), 5)):  # all of a set lies ahead, or a part
        x, y = ngramjoin._tree_join(n, rest, part, points.astype(np.int32))
        got = {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist(), strict=True)}
        want = {
            (i, j)
            for i in range(len(points))
            for j in range(i + 1, len(points))
            if 4 * min(n[i], n[j]) >= 3 * max(n[i], n[j])
            and 7 * min(np.minimum(points[i], points[j]).sum(), rest[i], rest[j]) >= 3 * (n[i] + n[j])
        }
        assert got == want and len(got) >= least


def test_large_counts_keep_their_bound(spark):
    """One shingle group holds more than a byte counts."""
    blobs = [np.array([300, *[1] * (ngramjoin.GROUPS - 1)], "<u4").tobytes(), np.ones(ngramjoin.GROUPS, np.uint8).tobytes()]
    assert ngramjoin._points(blobs)[:, 0].tolist() == [300, 1]
    long = prose(77, 40_000)
    frame = spark.createDataFrame([(1, long), (2, long + " end"), (3, prose(78, 40_000))], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngramjoin.near_copies(frame).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 60)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 60)}}


# Toxicity


def toxic_corpus(n: int) -> list[tuple]:
    rnd, made = random.Random(5), []
    for i in range(n):
        words, bad = words_of(prose(1000 + i, rnd.choice([60, 200, 900]))), i % 4 == 0
        for _ in range(len(words) // 40 + 1 if bad else 0):
            words[rnd.randrange(len(words))] = rnd.choice(["grolik", "vumpa"]) + rnd.choice(["", "ta", "mi", "ze", "un", "or"])
        made.append((i, " ".join(words), int(bad)))
    return made


def test_toxicity_on_held_out_rows(spark):
    data = toxic_corpus(900)
    frame = spark.createDataFrame([(d, t) for d, t, _ in data] + [(5000, None), (5001, ""), (None, "grolik")], "doc_id long, text string")
    labels = spark.createDataFrame([(d, b) for d, _, b in data] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["toxicity"] for r in toxicity.scored(frame, labels).collect()}
    held = [(got[d] >= 0.5, bool(b)) for d, _, b in data if zlib.crc32(str(d).encode()) % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) >= 0.95
    assert all(0 <= s <= 1 for s in got.values()) and got[5000] == got[5001]


def test_misspelling_shares_its_grams():
    data = toxic_corpus(600)
    words = toxicity.Words(toxicity.fit([t for _, t, _ in data], [b for _, _, b in data]))
    assert words["grolikxyz"] > 0 and words["groliik"] > words["w17"]


def test_toxicity_without_labels(spark, docs, none):
    empty = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.remove_toxic(docs, empty).columns == docs.columns
    assert toxicity.scored(none, empty).count() == 0


# Quality rules and posteriors


def test_counts_by_hand():
    text = "a b c d\na b c x\n \na b c d\ncafé #1 <b>"
    words = words_of(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    assert qualityrules.counts(text) == (len(words), sum(map(len, words)), 3, 1, len(covered))
    assert qualityrules.counts(None) == (0, 0, 0, 0, 0) == qualityrules.counts("")
    assert qualityrules.distance(np.array([1.0, 0]), np.array([0, 1.0])) == pytest.approx(1)


def test_rules_reject_what_diverges(spark, docs, none):
    odd = " ".join(f"@@@{i}###$$$" for i in range(80))
    data = [(i, prose(300 + i, 200), "en") for i in range(60)] + [(100, odd, "en"), (101, "too short", "en"), (102, None, None), (103, "a b c " * 50, "de")]
    got = {r["doc_id"]: r for r in qualityrules.judged(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["kept"] for i in range(60))
    assert not got[100]["kept"] and not got[100]["base_failed"]
    assert got[101]["base_failed"] and got[102]["base_failed"] and got[103]["base_failed"]
    assert qualityrules.judged(docs).count() == len(rows())
    assert qualityrules.judged(none).count() == 0


def test_rules_in_blocks_of_languages(spark, docs, monkeypatch):
    whole = sorted(map(str, qualityrules.judged(docs, keep_text=False).collect()))
    monkeypatch.setattr(qualityrules, "LANGUAGES_AT_ONCE", 1)
    assert sorted(map(str, qualityrules.judged(docs, keep_text=False).collect())) == whole


def test_sparse_sites_shrink(spark, docs, none):
    data = [(i, prose(i, 80), "en", "big") for i in range(40)] + [(50 + i, "### $$$ !! " * 30, "en", "bad") for i in range(40)] + [(99, prose(99, 80), "en", "lone")]
    labels = spark.createDataFrame([(d, int(s != "bad")) for d, _, _, s in data], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in qualitybayes.posteriors(spark.createDataFrame(data, "doc_id long, text string, lang string, source string"), labels).collect()}
    assert all(got[i]["kept"] for i in range(40)) and not any(got[50 + i]["kept"] for i in range(40))
    mean = sum(r["evidence"] for r in got.values()) / len(got)
    assert mean < got[99]["host_mean"] <= got[0]["host_mean"] + 1e-9
    assert qualitybayes.posteriors(docs, labels).count() == len(rows())
    assert qualitybayes.posteriors(none, labels).count() == 0


# Language models


def test_difference_prefers_the_target(spark, docs, none):
    good = [(i, " ".join(f"g{(i + k) % 50}" for k in range(100))) for i in range(40)]
    bad = [(100 + i, " ".join(f"b{(i * k) % 50}" for k in range(100))) for i in range(40)]
    frame = spark.createDataFrame([*good, *bad, (999, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 40, 2)] + [(100, 0), (None, 1), (0, 1)], "doc_id long, quality int")
    got = {r["doc_id"]: r["difference"] for r in lmscore.scored(frame, labels).collect()}
    assert max(got[i] for i, _ in good) < min(got[i] for i, _ in bad) and got[999] is None
    assert lmscore.scored(docs, labels).count() == len(rows())
    assert lmscore.scored(none, labels).count() == 0


def test_losses_equal_plain_counts(spark, docs, monkeypatch):
    labels = spark.createDataFrame([(1, 1), (3, 1), (9, 0)], "doc_id long, quality int")
    texts = [(r["doc_id"], (r["text"] or "").lower().split()) for r in docs.collect()]
    models = []
    for ids in ({1, 3}, {i for i, _ in texts}):
        single, pair = Counter(), Counter()
        for i, words in texts:
            if i in ids:
                single.update(words)
                pair.update(zip(words, words[1:]))
        models.append((single, pair, sum(single.values())))

    def mean(words, model):
        single, pair, total = model
        loss = 0.0
        for before, word in zip([None, *words], words):
            base = (single[word] + 1) / (total + lmscore.UNSEEN)
            seen = single[before] if before else 0
            loss -= math.log2((pair[before, word] + lmscore.PRIOR * base) / (seen + lmscore.PRIOR))
        return loss / len(words)

    want = sorted((len(w), *(round(mean(w, m), 6) for m in models)) if w else (0,) for _, w in texts)
    for chunk, part in ((250_000, 1_000_000), (50, 100)):
        monkeypatch.setattr(lmscore, "CHUNK_WORDS", chunk)
        monkeypatch.setattr(lmscore, "PART_WORDS", part)
        found = lmscore.scored(docs, labels).collect()
        got = sorted((r["n_words"], round(r["target_loss"], 6), round(r["background_loss"], 6)) if r["n_words"] else (0,) for r in found)
        assert got == want


# Pages


PAGE = """<html><head><title>T</title><style>p{x}</style></head><body><nav><a href="/">Home</a></nav><header>Site name</header>
<div class="cookie-notice">We use the cookies and you must be told of it in this long text for all</div>
<article><header><h1>The title of a page</h1></header><p>This is the first of the paragraphs &amp; it is as long as it has to be.</p>
<p>Ok.<p>It is the second of the paragraphs,   and that one is &lt;also&gt; as long as it has to be to count.<br>Same block.
<form>Your name <input></form><script>var x = "</p>";</script><div class="comments"><p>I was the first of all to say it is a nice page for you</p></div>
</article><aside>Read this and that in the other part of the page if you like to</aside><footer>&copy; me</footer></body></html>"""


def test_article_only():
    assert htmltext.main_text(PAGE).split("\n") == [
        "The title of a page",
        "This is the first of the paragraphs & it is as long as it has to be.",
        "Ok.",
        "It is the second of the paragraphs, and that one is <also> as long as it has to be to count. Same block.",
    ]


def test_page_without_article():
    menu = "".join(f'<li><a href="/{i}">Entry {i} of it</a></li>' for i in range(9))
    page = f"<div><ul>{menu}</ul></div><div>This is the text of a page that has no mark of an article and it is long.</div><div>Short.</div>"
    assert htmltext.main_text(page).split("\n")[-2:] == ["This is the text of a page that has no mark of an article and it is long.", "Short."]
    assert "Entry" not in htmltext.main_text(page)


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<a href='x", "</p></div>", "<!-- never closed", "<script>never closed", "a < b > c", "&#xD800;&bogus;"])
def test_broken_pages(page):
    assert isinstance(htmltext.main_text(page), str)


def test_extract_frame(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "old"), (1, "u", PAGE, "old"), (None, None, None, None), (2, "v", "x " * 200_000, "old")], "page_id long, url string, html string, text string")
    got = htmltext.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    lengths = sorted(r["n_chars"] for r in got.collect())
    assert lengths == sorted([len(htmltext.main_text(PAGE))] * 2 + [0, 399_999])


# Chats


def test_snapshots_collapse(spark):
    def conv(name, *texts):
        return [(name, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]

    data = conv(1, "a", "b") + conv(2, "a", "b", "c") + conv(3, "a", "x") + conv(4, "a", "b", "c") + conv(5, None, "b") + conv(None, "q") + [(2, 0, "user", "a")]
    frame = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["text"]) for r in chat.chats(frame).collect()}
    assert set(got) == {2, 3, 5, None}
    assert got[2] == (3, "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\nc<|im_end|>\n")
    assert chat.chats(frame.where("false")).count() == 0


def test_long_conversation_in_parts(spark):
    turns = [(1, i, "user", f"t{i}") for i in range(1300)] + [(2, i, "user", f"t{i}") for i in range(700)]
    got = chat.chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).orderBy("part").collect()
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in got] == [(1, 0, 512), (1, 1, 512), (1, 2, 276)]


def test_near_copies_gives_no_partial_count_of_links(spark):
    """Three texts that all link: one component; their links are not all compared, so none are counted."""
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words), " ".join([*words, "x"]), " ".join([*words, "y"])]
    found = ngramjoin.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING"))
    assert found.columns == ["doc_id", "body", "n", "cls", "root", "component_id"]
    assert {r["component_id"] for r in found.collect()} == {0}


def test_rounds_give_a_large_meeting_few_partners_a_member():
    """300 members that all pass the bound: all pairs without a salt, a few for each member with one."""
    size, blob = 300, np.ones(ngramjoin.GROUPS, np.uint8).tobytes()
    whole = {"token": np.zeros(size), "i": np.zeros(size), "j": np.zeros(size), "n": np.full(size, ngramjoin.GROUPS)}
    whole |= {"rest": whole["n"], "cls": np.arange(size), "root": np.arange(size)}
    columns = {k: pa.array(v.astype(np.int64)) for k, v in whole.items()} | {"vector": pa.array([blob] * size, pa.binary())}
    batches = pa.table(columns).to_batches(max_chunksize=100)
    pairs = lambda salt: sum(b.num_rows for b in ngramjoin._tree_pairs(salt)(iter(batches)))
    assert pairs(0) == size * (size - 1) // 2
    assert size - 1 <= pairs(1) <= (ngramjoin.NEAREST + 1) * size


def test_meetings_of_one_leaf_equal_trees():
    rnd = np.random.default_rng(3)
    sizes = rnd.integers(1, ngramjoin.LEAF + 3, 60)
    base = np.repeat(rnd.integers(0, 9, (60, ngramjoin.GROUPS)), sizes, axis=0)
    points = np.maximum(base + rnd.integers(-1, 2, base.shape), 0)
    n, part, cuts = points.sum(axis=1), rnd.integers(0, 40, len(points)), np.append(0, np.cumsum(sizes)[:-1])
    rest = n - rnd.integers(0, n // 6)
    blobs = np.array([p.astype(np.uint8).tobytes() for p in points], object)
    got = set(zip(*(v.tolist() for v in ngramjoin._leaf_join(cuts, n, rest, part, blobs)), strict=True))
    want = set()
    for a, size in zip(cuts, sizes, strict=True):
        if size <= ngramjoin.LEAF:
            x, y = ngramjoin._tree_join(n[a : a + size], rest[a : a + size], part[a : a + size], points[a : a + size].astype(np.int32))
            want |= {(a + min(p), a + max(p)) for p in zip(x.tolist(), y.tolist(), strict=True)}
    assert got == want and got


def _edited(count, size, families):
    """Families of near copies: texts of ``size`` words, of which copies have another last word."""
    return [" ".join([f"f{f}w{k}" for k in range(size - 1)] + [f"end{c}"]) for f in range(families) for c in range(count)]


def test_verification_moves_each_text_once_a_pair_and_no_sets(spark, monkeypatch):
    """The text of a member goes to one copy of its leader's, rows that repeat an id and text are one."""
    monkeypatch.setattr(ngramjoin, "MEMBERS", 4)
    texts = [*_edited(30, 40, 1), "other words " * 9]
    own = spark.createDataFrame([(k, t) for k, t in enumerate(texts) for _ in range(1 + k % 2)], "doc_id LONG, text STRING")
    classes = own.distinct().selectExpr("doc_id AS cls", "struct(doc_id, xxhash64(text) AS body) AS first")
    pairs = spark.createDataFrame([*((0, k) for k in range(1, 30)), (5, 30)], "a LONG, b LONG")
    got = sorted((r["a"], r["b"]) for r in ngramjoin._verified(pairs, own, classes).collect())
    assert got == [(0, k) for k in range(1, 30)]


def test_finer_counts_part_large_unrelated_sets(spark):
    """Counts in 256 groups bound the overlap of unrelated sets of 6,000 shingles above a link's, finer ones far below."""
    rnd = np.random.default_rng(11)
    found = [np.unique(rnd.integers(0, 2**63, 6000, dtype=np.uint64) * np.uint64(2)) for _ in range(2)]
    found.append(np.unique(np.concatenate([found[0][:5500], found[1][:200]])))
    found.append(found[0][:1500])
    rows = [
        (k, len(v), np.bincount((v >> np.uint64(56)).astype(int), minlength=256).astype(np.uint8).tobytes(), ngramjoin._fine_counts(v))
        for k, v in enumerate(found)
    ]
    brief = spark.createDataFrame(rows, "cls LONG, n LONG, vector BINARY, fine BINARY")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "a LONG, b LONG")
    coarse = {(r["a"], r["b"]) for r in ngramjoin._bounded(pairs, brief).collect()}
    assert {(0, 1), (0, 2)} <= coarse
    assert {(r["a"], r["b"]) for r in ngramjoin._finer(pairs, brief).collect()} == {(0, 2), (0, 3)}
    assert rows[3][3] is None


def test_meetings_hold_no_member_alone(spark):
    """One who stays without a partner after the first judgement goes too."""
    rows = [(1, 100, [7]), (2, 100, [*range(1000, 1020), 7]), (3, 70, [*range(2000, 2030), 7]), (4, 100, [8]), (5, 90, [8])]
    described = spark.createDataFrame(rows, "cls LONG, n LONG, prefix ARRAY<LONG>")
    assert {r["cls"] for r in ngramjoin._meetings(described, 4).collect()} == {4, 5}
