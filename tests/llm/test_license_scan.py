"""License scans: phrases against brute force, notices with changes."""

import re

import numpy as np

from tallystream.llm import license_scan as ls
from tallystream.llm import queries

DOCS = "doc_id long, text string, row string, pos int"


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(text):
    w = words(text)
    out = []
    for label, phrase in (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")):
        p = phrase.split()
        out += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return len(w), out


def scanned(spark, rows):
    return ls.scan(spark.createDataFrame([(*r, "x", 1) for r in rows], DOCS)).collect()


def test_phrases_against_brute_force(spark):
    rng = np.random.default_rng(1)
    parts = ["MIT", "license", "License,", "apache", "GENERAL", "public", "general-public", "license.", "é", "mit_license", "Mit\nLicense"]
    rows = [(i, " ".join(rng.choice(parts, 60))) for i in range(60)]
    rows += [(None, "mit license"), (1, None), (2, ""), (3, "--"), (4, "mit license " * 30_000), (5, "mit license"), (5, "mit license"), (6, "general public general public license")]
    got = scanned(spark, rows)
    mine = sorted((str(r.doc_id), r.n_words, sorted((s.start, s.label) for s in r.licenses if s.base)) for r in got)
    assert mine == sorted((str(i), places(t)[0], sorted(places(t)[1])) for i, t in rows)
    assert scanned(spark, []) == []


def test_notices(spark):
    mit = dict(ls.NOTICES)["mit"]  # the long one
    gpl = dict(ls.NOTICES)["gpl"]
    before, after = "some words before it. ", " and some after it"
    changed = mit.replace("free of charge, ", "").replace("without limitation", "without any limitation at all").replace("modify", "change")
    half = " ".join(mit.split()[:30])
    cc = "Licensed under CC BY-NC 4.0."
    rows = [(1, before + mit + after), (2, before + changed + after), (3, half), (4, mit + "\n" + gpl + "\n" + mit), (5, cc), (6, "licensed under cc by 4.0"), (7, "no license at all"), (8, "The MIT license")]
    got = {r.doc_id: r.licenses for r in scanned(spark, rows)}
    texts = {i: [s for s in spans if not s.base] for i, spans in got.items()}
    assert [(s.label, s.start, s.stop, s.similarity) for s in texts[1]] == [("mit", 4, 4 + len(words(mit)), 1.0)]
    assert [s.label for s in texts[2]] == ["mit"] and 0.85 < texts[2][0].similarity < 1
    assert texts[3] == [] and texts[7] == [] and texts[8] == []
    assert [s.label for s in texts[4]] == ["mit", "gpl", "mit"] and [s.start for s in texts[4]] == [0, len(words(mit)), len(words(mit + " " + gpl))]
    assert [s.label for s in texts[5]] == ["cc-by-nc"] and [s.label for s in texts[6]] == ["cc-by"]


def test_digest(spark, tmp_path, monkeypatch):
    rows = [(1, "the mit license and the Apache license and the MIT license"), (2, "Licensed under CC BY-NC 4.0."), (3, None), (4, "plain")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op12_license_scan(spark, str(tmp_path)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels, got[1].labels, got[1].score) == (3, 1, 9, "apache,mit", "apache,mit", 0.5)
    assert (got[2].n_base, got[2].first_word, got[2].base_labels, got[2].labels, got[2].score) == (0, None, "", "cc-by-nc", 1.0)
    assert (got[3].n_words, got[3].n_base, got[3].labels, got[3].score) == (0, 0, "", 0.0) and got[4].score == 0.0


def test_beyond_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ls, "BROADCAST_SPANS", 0)
    rows = [(i, "a mit license" if i % 2 else f"text {i % 5}") for i in range(200)]
    got = {r.doc_id: [s.start for s in r.licenses] for r in scanned(spark, rows)}
    assert got == {i: [1] if i % 2 else [] for i in range(200)}
