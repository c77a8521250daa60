"""Licence templates against a plain search of every place, and edited licence texts."""

import random

import pytest

from colloquia.llm import licenses
from colloquia.llm.license_texts import BODIES, HEADERS, TEMPLATES

import brute


def plain(text, templates=TEMPLATES, base=licenses.BASE, slack=licenses.SLACK):
    """(labels, score): every place of every phrase is tried, without an index."""
    words = brute.letter_words(text)

    def starts(own, at):
        return [p - at for p in range(len(words)) if words[p:p + len(own)] == own]

    labels, score = set(), 0.0
    for phrase, label in base:
        if starts(phrase.split(), 0):
            labels.add(label)
            score = max(score, 0.5)
    for label, body, phrases in templates:
        whole = brute.letter_words(body)
        places = []
        for p in phrases:
            own = brute.letter_words(p)
            at = next(i for i in range(len(whole)) if whole[i:i + len(own)] == own)
            places.append(starts(own, at))
        for s in places[0]:
            if all(any(abs(s - o) <= slack for o in other) for other in places[1:]):
                labels.add(label)
                held = sum(any(0 <= k < len(words) and words[k] == w for k in range(s + i - slack, s + i + slack + 1))
                           for i, w in enumerate(whole))
                score = max(score, held / len(whole))
    return ",".join(sorted(labels)), round(score, 9)


@pytest.fixture(scope="module")
def edited():
    """Licence texts as files hold them: in comments, with names put in, cut, shuffled, repeated."""
    r = random.Random(11)
    out = [(1, None), (2, ""), (3, " \n. "), (4, "cc by " * 400), (5, "license " * 3000)]
    for n, (_, text, _) in enumerate(TEMPLATES):
        words = text.split()
        out.append((100 + n, "\n".join(f"// {line}" for line in text.strip().splitlines()) + "\nint main() {}"))
        at = r.randrange(len(words))
        out.append((200 + n, " ".join([*words[:at], "ACME", "Corp", "2021", *words[at:]])))
        out.append((300 + n, " ".join([*words[:at], *["x"] * 12, *words[at:]])))
        out.append((400 + n, " ".join(words[:at])))
        out.append((500 + n, " ".join(words[at:])))
        out.append((600 + n, " ".join(r.sample(words, len(words)))))
        out.append((700 + n, f"{text}\n{text} {TEMPLATES[r.randrange(len(TEMPLATES))][1]}"))
    return out


def test_templates_as_a_plain_search(make_docs, edited):
    for rows in (edited, edited * 2):  # repeated rows change frequencies, not results
        got = sorted(((r["doc_id"], r["labels"], round(r["score"], 9))
                      for r in licenses.scan(make_docs(rows)).collect()))
        assert got == sorted((i, *plain(t)) for i, t in rows)


def test_rarity_changes_no_result(make_docs, edited, monkeypatch):
    want = sorted((r["doc_id"], r["labels"], r["score"]) for r in licenses.scan(make_docs(edited)).collect())
    for rare in (1, 1 << 40):  # postings of every key-phrase word; of each phrase's rarest only
        monkeypatch.setattr(licenses, "RARE", rare)
        assert sorted((r["doc_id"], r["labels"], r["score"]) for r in licenses.scan(make_docs(edited)).collect()) == want


def test_whole_texts_score_one(make_docs):
    rows = [(n, f"Copyright 2020 Some Body\n\n{t}") for n, (_, t, _) in enumerate(HEADERS + BODIES)]
    got = {r["doc_id"]: r for r in licenses.scan(make_docs(rows)).collect()}
    for n, (label, _, _) in enumerate(HEADERS + BODIES):
        assert label in got[n]["labels"].split(",") and got[n]["score"] == 1.0


def test_names_put_in_move_nothing_beyond_the_slack(make_docs):
    bsd = next(t for label, t, _ in BODIES if label == "bsd-3-clause")
    own = bsd.replace("the copyright holder nor", "Example Software Foundation of Europe nor")
    far = bsd.replace("3. Neither", "3. " + "word " * 20 + "Neither")
    got = {r["doc_id"]: r for r in licenses.scan(make_docs([(1, own), (2, far)])).collect()}
    assert got[1]["labels"] == "bsd,bsd-3-clause" and got[1]["score"] >= 0.95
    assert got[2]["labels"] == "bsd"


def test_a_phrase_outside_its_template_is_refused():
    with pytest.raises(ValueError):
        licenses.Index([("x", "some words", ("other words",))])


def test_op7_equals_its_sql(spark, make_docs, edited, tmp_path):
    import duckdb

    from colloquia.llm import queries

    make_docs(edited).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.QUERIES["op7_licenses"](spark, str(tmp_path))
    want = con.execute(queries.ORACLE["op7_licenses"])
    names = [c[0] for c in want.description]

    def tidy(rows):
        return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)

    assert tidy(tuple(r[c] for c in names) for r in got.collect()) == tidy(want.fetchall())
