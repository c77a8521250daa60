"""Rows without a doc_id of their own are dropped as near duplicates only."""

from colloquia.llm import simhash


def test_unrelated_rows_without_an_own_id_stay(make_docs):
    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    rows = [(None, text("a")), (None, text("b")), (None, text("b")),   # b: one of two
            (1, text("c")), (1, text("d")), (1, text("d")),            # one id, two texts
            (2, text("e")), (None, text("e")), (None, text("f")),      # e: the named row
            (3, text("d")), (4, text("g")), (0, text("g"))]            # g: the smallest id
    kept = simhash.one_of_each(make_docs(rows)).collect()
    got = sorted((repr(r["doc_id"]), r["text"][0]) for r in kept)
    assert got == sorted([("None", "a"), ("None", "b"), ("1", "c"), ("1", "d"), ("2", "e"), ("None", "f"), ("0", "g")])
    none = simhash.one_of_each(make_docs([(None, text(c)) for c in "abc"]))
    assert none.count() == 3 and none.columns == make_docs([]).columns
