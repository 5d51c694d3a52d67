import datetime as dt

from clauseforge import schemas
from clauseforge.operators import orphans

PROVISIONS = f"doc string, id string, events array<{schemas.EVENT}>, built_at timestamp_ntz, extra string"


def doc(pos, slug, last="2025-05-01T00:00:00Z", first="2025-01-01T00:00:00+00:00", status="Existing", relations=None):
    source = (None, None, None, None, None, None, first, last, None)
    return (pos, slug, *[None] * 4, status, *[None] * 12, relations, None, source)


def docs_of(spark, rows):
    names = schemas.DOCS
    full = []
    for r in rows:
        d = dict(zip(("pos", "slug", "status", "relations", "_source"), (r[0], r[1], r[6], r[19], r[21])))
        full.append(d)
    return spark.createDataFrame(full, names) if full else spark.createDataFrame([], names)


def event(target):
    return ("amend", target, None, None, None)


def test_cases(spark):
    docs = docs_of(spark, [
        doc(1, "a", relations={"amends": ["B ", "gone", None, " ", "dead", "late"]}),
        doc(2, "a", last="2024-01-01T00:00:00Z", relations={"amends": ["never-counted"]}),
        doc(3, "b"),
        doc(4, "b"),
        doc(5, "dead", status="Deleted"),
        doc(6, "late", first="2025-05-01T05:30:01+05:30"),
        doc(7, "edge", first="2025-05-01T05:30:00+05:30", last="2025-06-01T00:00:00.5+00:00"),
        doc(8, None, relations={"amends": ["from-nowhere"]}),
    ])
    t = dt.datetime(2025, 5, 1)
    provisions = spark.createDataFrame([
        ("\tEDGE\n", "p1", [event("late"), event(None), event("x")], t, "clash"),
        ("\tEDGE\n", "p1", [event("late"), event(None), event("x")], t, "clash"),
        (None, "p2", None, t, None),
        ("  ", None, [event("x")], None, None),
    ], PROVISIONS)
    got = {tuple(r) for r in orphans.orphan_references(docs, provisions).collect()}
    assert got == {
        ("docs", "a", "relations.amends", "gone", "2025-05"),
        ("docs", "a", "relations.amends", "dead", "2025-05"),
        ("docs", "a", "relations.amends", "late", "2025-05"),
        ("provisions", "p1", "events.doc", "late", "2025-05"),
        ("provisions", "p1", "events.doc", "x", "2025-05"),
        ("provisions", None, "events.doc", "x", None),
    }
    # spreading hot slugs changes nothing
    assert {tuple(r) for r in orphans.orphan_references(docs, provisions, per_task=1).collect()} == got
    report = {(r.src_table, r.period): (r.orphans, r.slugs) for r in orphans.orphan_report(orphans.orphan_references(docs, provisions)).collect()}
    assert report[("docs", "2025-05")] == (3, 3)


def test_empty_tables(spark):
    empty = orphans.orphan_references(docs_of(spark, []), spark.createDataFrame([], PROVISIONS))
    assert empty.collect() == [] and empty.columns == ["src_table", "src_key", "field", "ref_slug", "period"]


def test_state_moves_on_by_deltas(spark):
    schema = "ref_slug string, delta long"
    first = orphans.apply_deltas(spark.createDataFrame([("a", 1), ("a", 1), ("b", 1)], schema))
    assert {tuple(r) for r in first.collect()} == {("a", 2), ("b", 1)}
    second = orphans.apply_deltas(spark.createDataFrame([("b", -1), ("c", 1), ("c", -1), ("d", 1)], schema), first)
    assert {tuple(r) for r in second.collect()} == {("a", 2), ("d", 1)}  # b and c have left the state
    records = spark.createDataFrame([("a", 5, 1)], "slug string, first_us long, delta long")
    assert {tuple(r) for r in orphans.orphan_keys(orphans.slug_state(second, records)).collect()} == {("d", 1)}


def test_changes_give_what_a_full_computation_gives(spark):
    t = dt.datetime(2025, 5, 1)
    docs = [
        docs_of(spark, [doc(1, "a", relations={"amends": ["b", "x", "late"]}), doc(2, "b"), doc(3, "c", relations={"amends": ["a"]})]),
        # a loses a reference, b is deleted, late arrives later than the reference, x arrives in time, c is gone
        docs_of(spark, [doc(1, "a", relations={"amends": ["b", "late", "x"]}), doc(2, "b", status="Deleted"), doc(4, "late", first="2025-07-01T00:00:00Z"), doc(5, "x")]),
        docs_of(spark, [doc(1, "a", relations={"amends": ["late"]}), doc(4, "late", first="2025-01-01T00:00:00Z")]),
    ]
    provisions = [spark.createDataFrame(rows, PROVISIONS) for rows in ([("c", "p1", [event("b")], t, "")], [("c", "p1", [event("b")], t, ""), ("a", "p2", None, t, "")], [("a", "p2", None, t, "")])]
    for n in (1, 2, 3):
        want = {tuple(r) for r in orphans.orphan_references(docs[n - 1], provisions[n - 1]).collect()}
        assert {tuple(r) for r in orphans.orphans_after_changes(list(zip(docs, provisions))[:n]).collect()} == want
        assert n == 3 or want
    assert want == set()
