"""Operators on pairs against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from clauseforge.llm import _arrays, _blocks, _postings, lookalikes, near_duplicates, shared_spans

SCHEMA = "id string, content string, attachment string, k int, text string, token string"
random.seed(5)
WORDS = ["fee", "cover", "claim", "दावा", "rate", "rule", "form", "net", "day", "bank", "risk", "loss", "é", "x1", "y-2", "z"]


def words(n):
    return [random.choice(WORDS) + random.choice(WORDS) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    texts = {}
    for g in range(12):
        base = words(random.choice([40, 60, 150]))
        for v in range(5):
            w = list(base)
            for _ in range(v * 2):
                w[random.randrange(len(w))] = random.choice(WORDS)
            if v == 4:
                w = w[20:] + w[:20]
            texts[f"{g:02d}{v}"] = random.choice([" ", "\n", "\t "]).join(w)
    texts |= {"copy1": texts["000"], "copy2": texts["000"], "short1": "only a few tokens", "short2": "only a few tokens", "empty": "", "blank": " \n", "null": None, "long": " ".join(words(3000))}
    texts |= {"t39": " ".join(WORDS[i % 16] for i in range(39)), "t40": " ".join(WORDS[i % 16] for i in range(40)), "t40b": " ".join(WORDS[i % 16] for i in range(40)) + " "}
    return texts


@pytest.fixture(scope="module")
def frame(spark, corpus):
    rows = [(i, t, None if n % 3 else "a", n, "clash", "clash") for n, (i, t) in enumerate(corpus.items())]
    return spark.createDataFrame(rows + rows[:20] + [(None, corpus["000"], None, 0, None, None)], SCHEMA).repartition(5)


def similar(a, b, w=3, least=40):
    a, b = (re.findall(r"[^ \t\n]+", t or "") for t in (a, b))
    if min(len(a), len(b)) < least:
        return False
    x, y = ({tuple(t[i : i + w]) for i in range(len(t) - w + 1)} for t in (a, b))
    return 10 * len(x & y) >= 7 * len(x | y)


def pairs(corpus, test):
    return {(a, b) for a, b in itertools.combinations(sorted(corpus), 2) if test(corpus[a], corpus[b])}


def test_near_duplicates(spark, frame, corpus, monkeypatch):
    want = pairs(corpus, similar)
    assert len(want) > 20
    assert {tuple(r) for r in near_duplicates.similar_pairs(frame).collect()} == want
    groups = near_duplicates.near_duplicate_groups(frame).collect()
    assert {r.id for r in groups} == {x for p in want for x in p}
    root = {i: i for i in corpus}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in want:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert all(find(r.id) == r.group_id for r in groups)
    assert near_duplicates.similar_pairs(frame.limit(0)).count() == 0 and near_duplicates.near_duplicate_groups(frame.limit(0)).count() == 0


def test_hot_tokens_in_blocks_give_the_same_pairs():
    rng = np.random.default_rng(0)
    docs = np.arange(300, dtype=np.uint64) * np.uint64(977)
    index, group, side = _postings.spread(np.full(300, 42, np.uint64), docs, np.full(300, 5_000), block=1_000)
    met = set()
    for g in np.unique(group):
        at = np.flatnonzero(group == g)
        for i, j in itertools.combinations(at, 2):
            if side[i] == side[j] == 0 or side[i] + side[j] == 3:
                pair = tuple(sorted((index[i], index[j])))
                assert pair not in met
                met.add(pair)
    assert len(met) == 300 * 299 // 2
    key = np.sort(rng.integers(0, 20, 500))
    got = {(i, j) for a, b in _arrays.pairs_in_runs(key, block=37) for i, j in zip(a, b)}
    assert got == {(i, j) for i, j in itertools.combinations(range(500), 2) if key[i] == key[j]}


def test_blocks_and_dealt_out_tokens_change_nothing(spark, frame, corpus, passages, monkeypatch):
    monkeypatch.setattr(_postings, "BLOCK_DOCS", 2)
    assert {tuple(r) for r in near_duplicates.similar_pairs(frame).collect()} == pairs(corpus, similar)
    monkeypatch.setattr(_postings, "SWAMPED", 1)
    monkeypatch.setattr(_postings, "LEAST_POSTINGS", 50)
    assert {tuple(r) for r in near_duplicates.similar_pairs(frame).collect()} == pairs(corpus, similar)
    texts, df = passages
    assert {tuple(r) for r in shared_spans.sharing_pairs(df).collect()} == {p for p in itertools.combinations(sorted(texts), 2) if share(texts[p[0]], texts[p[1]])}


@pytest.mark.parametrize("load", [1, 1_000, 1_000_000_000])
def test_cold_postings_are_never_copied(load):
    counts = np.full(1 << 12, load)  # every cell is full, none stands out
    token = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    docs = np.zeros(100, shared_spans.DOC)
    docs["k"] = np.arange(100)
    packer = _postings.Packer(7_000_000)  # far more buckets than postings
    dealt = _postings.shares(counts)[_postings.cell_of(token, 12)]
    rows = [b for part in (packer.add(docs, token, np.arange(5000) % 100, dealt), packer.flush()) for b in part]
    assert sum(len(t) for b in rows for t in b.column("token").to_pylist()) == 5000 * 4
    hot = counts.copy()
    hot[5] += 3 * _postings.SWAMPED
    assert (_postings.shares(hot) > 1).sum() == 1


def test_runs_of_one_character_cost_no_more_than_other_text(spark):
    a, b = "." * 100_000 + " one", "two " + "." * 100_000
    row, pos, h = shared_spans.runs_joined(*shared_spans.anchors([a, "ab" * 50_000]), 200)
    assert len(row) < 10 and (pos < 0).any()
    df = spark.createDataFrame([("a", a), ("b", b), ("c", "." * 150), ("d", "-" * 300)], "id string, content string")
    assert [tuple(r) for r in shared_spans.sharing_pairs(df).collect()] == [("a", "b")]
    got = {r.id: r.shared_chars for r in shared_spans.shared_per_record(df).collect()}
    assert got == {"a": 100_000, "b": 100_000}


def test_a_passage_repeated_in_both_texts(spark):
    line = "".join(random.choice("abcdefgh") for _ in range(230))
    a, b = (x.join([line] * 300) for x in ("1", "2"))
    df = spark.createDataFrame([("a", a), ("b", b)], "id string, content string")
    assert shared_spans.meetings(shared_spans._rows(df, "content", 200)).count() <= 20
    assert {r.id: r.shared_chars for r in shared_spans.shared_per_record(df).collect()} == {"a": 69_000, "b": 69_000}
    classes = shared_spans.sharing_classes(df).collect()
    assert len(classes) == 1 and classes[0].shared_a == classes[0].shared_b == 69_000


def test_pairs_within_blocks(spark):
    df = spark.createDataFrame([(i % 3, i, "v") for i in range(90)], "key int, row int, other string")
    got = [(r.key, r.a.row, r.b.row) for r in _blocks.pairs_within(df, ["key"], "row", per_block=7).collect()]
    assert sorted(got) == sorted((k, a, b) for k in range(3) for a, b in itertools.combinations(range(k, 90, 3), 2))


def test_a_hot_group_of_copies_stays_one_document(spark):
    base = words(60)
    near = " ".join([*base[:59], "changed"])
    rows = [(f"c{i:04d}", " ".join(base), None, i, None, None) for i in range(1500)] + [("near", near, None, 0, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    groups = near_duplicates.near_duplicate_groups(df).collect()
    assert len(groups) == 1501 and {(r.group_id, r.records) for r in groups} == {("c0000", 1501)} and {r.links for r in groups} == {1}
    shared = {r.id: r for r in shared_spans.shared_per_record(df).collect()}
    assert len(shared) == 1501 and len({r.class_id for r in shared.values()}) == 2 and shared["c0007"].shared_chars == len(" ".join(base))


def share(a, b, n=200):
    return bool(a and b and {a[i : i + n] for i in range(len(a) - n + 1)} & {b[i : i + n] for i in range(len(b) - n + 1)})


@pytest.fixture(scope="module")
def passages(spark):
    common = "".join(random.choice("abcdefgh क") for _ in range(600))

    def noise(n):
        return "".join(random.choice("ijklmnop") for _ in range(n))

    texts = {
        "a": noise(300) + common[:200] + noise(100), "b": noise(10) + common[:200], "c": common[1:200] + noise(300), "d": common[100:500] + noise(50) + common[:250], "e": "." * 900, "f": "." * 200 + noise(80),
        "g": "." * 199, "h": common, "i": common, "j": None, "k": "", "l": noise(50_000) + common[300:] + noise(100), "m": noise(400), "ab": "ab" * 400, "ab2": "ab" * 150,
    }
    rows = [(i, t, None, 1, None, None) for i, t in texts.items()]
    return texts, spark.createDataFrame(rows + rows[:5] + [(None, common, None, 1, None, None)], SCHEMA).repartition(4)


def test_shared_spans(passages):
    texts, df = passages
    want = {(a, b) for a, b in itertools.combinations(sorted(texts), 2) if share(texts[a], texts[b])}
    assert {tuple(r) for r in shared_spans.sharing_pairs(df).collect()} == want
    got = {r.id: r for r in shared_spans.shared_per_record(df).collect() if r.id}
    assert set(got) == {x for p in want for x in p}
    for i, r in got.items():
        t, mark = texts[i], bytearray(len(texts[i]))
        others = {u[p : p + 200] for j, u in texts.items() if j != i and u for p in range(len(u) - 199)}
        for p in range(len(t) - 199):
            if t[p : p + 200] in others:
                mark[p : p + 200] = b"\1" * 200
        assert r.shared_chars == sum(mark)
    assert shared_spans.sharing_pairs(df.limit(0)).count() == 0


def test_long_text_in_parts(monkeypatch):
    text = "".join(random.choice("abc") for _ in range(5000))
    whole = shared_spans.anchors([text])
    monkeypatch.setattr(shared_spans, "PART", 700)
    parts = shared_spans.anchors([text])
    assert all((a == b).all() for a, b in zip(whole, parts))


LOOK = [
    ("plain", "Fee for office No. 12 at Crèvelle"), ("wide", "Ｆｅｅ for ｏｆfice No. １２ at Crèvelle"), ("decomposed", "Fee for office No. 12 at Cre\u0300velle"), ("ligature", "Fee for o\ufb03ce No. 12 at Crèvelle"),
    ("zero", "F\u200bee for of\u00adfice\u2060 No. 12 at Crèvelle\ufeff"), ("space", "Fee\u00a0for\u2009office\u3000No. 12 at Crèvelle"), ("cyr", "Fее fоr оfficе Nо. 12 at Crèvellе"), ("grk", "Fee for \u03bfffice \u039do. 12 at Crèvelle"),
    ("case", "fee for office No. 12 at Crèvelle"), ("accent", "Fee for office No. 12 at Crevelle"), ("spaces", "Fee  for office No. 12 at Crèvelle"), ("line", "Fee\nfor office No. 12 at Crèvelle"), ("one", "Fee for office No. l2 at Crèvelle"), ("dot", "Fee for office No 12 at Crèvelle"),
    ("sq", "10 m²"), ("sq2", "10 m2"), ("roman", "Part Ⅷ"), ("roman2", "Part VIII"), ("mixed", "Фонд"), ("mixed2", "Фoнд"), ("deva", "क\u093c"), ("deva2", "\u0958"), ("blank", " "), ("blank2", "\u00a0"), ("null", None), ("empty", ""), ("copy", "Part VIII"),
]


def test_lookalikes(spark):
    df = spark.createDataFrame([(i, t, None, 1, None, None) for i, t in LOOK] * 2 + [(None, "Part VIII", None, 1, None, None)], SCHEMA)
    same = [{"plain", "wide", "decomposed", "ligature", "zero", "space", "cyr", "grk"}, {"roman", "roman2", "copy"}, {"mixed", "mixed2"}, {"deva", "deva2"}]
    stored = dict(LOOK)
    want = {tuple(sorted(p)) for g in same for p in itertools.combinations(g, 2) if stored[p[0]] != stored[p[1]]}
    assert {tuple(r) for r in lookalikes.lookalike_pairs(df).collect()} == want
    forms = {r.id: r.content for r in lookalikes.canonical_texts(df).collect()}
    assert forms["mixed2"] == "Фонд" and forms["cyr"] == stored["plain"] and forms["null"] is None and forms["empty"] == "" and forms["sq"] == "10 m²"
    assert lookalikes.lookalike_pairs(df.limit(0)).count() == 0


def test_spelling_depends_on_the_skeleton_alone():
    model = lookalikes.Model()
    for text in ("Москва и Κρήτη, ΡΑΧ pax рах", "Ноу-хау λόγος ο", "ёлка е\u0308лка", "A\u0301 Ά"):
        form = model.canonical(text)
        assert model.canonical(form) == form and lookalikes.skeleton(form) == lookalikes.skeleton(text)
