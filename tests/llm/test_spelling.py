"""Spelling variants against brute force."""

import zlib
from collections import Counter

import numpy as np
import pytest

from tallystream.llm import spelling as sp

DOCS = "doc_id long, text string, word string, n int"


def near(a, b):
    """One inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def brute(words):
    rows, forms = {}, {}
    for w, n in words.items():
        around = sorted((-m, v) for v, m in words.items() if near(w, v))
        form = around[0][1] if around and -around[0][0] >= 10 * n else None
        forms[w] = form
        rows[w] = [form, None, n, len(around), words[form] if form else None]
    for w in words:
        root = w
        while forms[root]:
            root = forms[root]
        rows[w][1] = root
    return {w: tuple(r) for w, r in rows.items()}


def found(spark, words):
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = sp.variants(df).collect()
    assert len(got) == len(words)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


@pytest.mark.parametrize("letters,least", [("ab", 7), ("abcdé", 7), ("abc", 1)])
def test_variants_against_brute_force(spark, letters, least):
    rng = np.random.default_rng(len(letters))
    words = {}
    for _ in range(250):
        word = "".join(rng.choice(list(letters), int(rng.integers(least, least + 5))))
        words[word] = int(10 ** rng.integers(0, 5)) * int(rng.integers(1, 3))
    for word in list(words)[:60]:  # near ones
        k = int(rng.integers(0, len(word)))
        words.setdefault(word[:k] + "z" + word[k + int(rng.integers(0, 2)) :], int(rng.integers(1, 9)))
        words.setdefault(word + "z", 3), words.setdefault("z" + word, 3)
    assert found(spark, words) == brute(words)


def test_long_words_ties_and_chains(spark):
    long = "ab" * 6_000
    words = {long: 50, long[:5000] + long[5001:]: 5, long[:-1] + "é": 4, long[::-1]: 2}
    words |= {"aaaaaaaa": 3, "aaaaaaab": 40, "aaaaaaac": 40, "aaaaaaad": 39}  # equal counts: the smaller word
    words |= {"chainab": 2, "chainabc": 20, "chainabcd": 200, "chainabcde": 2000}
    got = found(spark, words)
    assert got == brute(words)
    assert got["aaaaaaaa"][:2] == ("aaaaaaab", "aaaaaaab") and got["chainab"][1] == "chainabcde"


def test_vocabulary(spark):
    rows = [(i, "Straßen STRASSEN Überflug déjàvues x" * 1 + " short", "w", 1) for i in range(40)]
    rows += [(None, "nullishly", "w", 1), (None, "nullishly", "w", 1), (7, None, None, None), (8, "", "", 0), (8, "1234 \n", "", 0)]
    rows += [(9, "Repeated repeated", "", 0)] * 2 + [(10, "a" * 100_000, "", 0)] * 2
    want = Counter()
    import re

    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    df = spark.createDataFrame(rows, DOCS)
    assert {r.word: r.n for r in sp.vocabulary(df).collect()} == want
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in sp.variants(sp.vocabulary(df)).collect()}
    assert got == brute(want)
    empty = spark.createDataFrame([], DOCS)
    assert sp.vocabulary(empty).count() == 0 and sp.variants(sp.vocabulary(empty)).count() == 0
