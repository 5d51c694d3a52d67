from hypothesis import given, settings
from hypothesis import strategies as st

from clauseforge.llm import splitting

SCHEMA = "id string, content string, heading string, loaded_at int, piece int, extra string"


def check(text, limit, overlap):
    cut = splitting.split(text, limit, overlap)
    assert cut[0][:2] == (0, 0) and cut[-1][2] == len(text)
    for k, (a, b, c) in enumerate(cut):
        assert c - a <= limit and 0 <= b - a <= overlap
        if k:
            assert b == cut[k - 1][2] and a >= cut[k - 1][1]
    return cut


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab .,;\n।क़́‍", max_size=400), st.integers(5, 60), st.integers(0, 20))
def test_pieces_cover_the_text(text, limit, overlap):
    check(text, limit, min(overlap, limit - 1))


def test_cuts_at_the_strongest_boundaries():
    text = ("Sentence one is here. Sentence two is here.\n\n" * 3).strip()
    cut = check(text, 60, 0)
    assert [text[b:c].strip() for _, b, c in cut] == ["Sentence one is here. Sentence two is here."] * 3
    words = "word " * 100
    assert all(words[c - 1] == " " for _, _, c in check(words, 33, 10))
    assert len(check("x" * 10_000, 1800, 200)) == 7  # no boundary: forced
    marks = "क्षि" * 1000
    assert all(marks[c] == "क" for _, _, c in check(marks, 1800, 0)[:-1])
    assert len(check("é" * 4001, 1800, 200)) == 3
    check("sentence. " * 100_000, 1800, 200)


def test_what_fits_a_piece_is_not_cut():
    text = "Some words before it. " * 20
    for size in (1601, 1700, 1799, 1800):
        run = text + "y" * size + " and after"
        assert not any(len(text) < c < len(text) + size for _, _, c in check(run, 1800, 200))
        sentence = text + ("word, " * 400)[: size - 2] + ". " + text
        cut = check(sentence, 1800, 200)
        assert (len(text), len(text) + size) in [(b, c) for _, b, c in cut]


def test_operator(spark):
    long = "One sentence. " * 300
    rows = [("a", long, "h", 1, 0, "x"), ("a", long, "h", 2, 0, "x"), ("b", "short", None, 1, 0, "x"), ("c", None, None, 1, 0, None), ("d", "", None, None, 0, None), (None, long, None, None, 0, None), ("e", "y" * 1800, "h", 1, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    out = splitting.split_oversized(df).collect()
    by = {}
    for r in sorted(out, key=lambda r: r.piece):
        by.setdefault(r.id, []).append(r)
    assert set(by) == {"a", None} and all(r.heading == "h" for r in by["a"])
    assert "".join(r.content[r.repeated :] for r in by["a"]) == long and [r.piece for r in by["a"]] == list(range(by["a"][0].pieces))
    assert {r.id for r in splitting.oversized(df).collect()} == {"a", None}
    assert splitting.oversized(df.limit(0)).count() == 0
