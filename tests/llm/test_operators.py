"""The package's operators on small tables: brute force, edge rows, both sides of every block."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallystream.llm import (
    decontaminate,
    html_extract,
    minhash,
    packing,
    pii,
    quality_classifier,
    quality_rules,
    sharding,
    substring_dedup,
    token_counts,
)
from tallystream.llm.tokens import encoder

DOCS = "doc_id long, text string, kept string, n_chars long"
LONG = " ".join(f"w{i}" for i in range(30_000))
EDGE = [(None, "a b c", "x", 5), (1, None, None, None), (2, "", "x", 0), (3, " \n\t", "x", 3), (4, LONG, "x", 1), (5, LONG, "x", 1), (5, LONG, "x", 1)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def _text(seed: int, n: int, words: int = 400) -> list[str]:
    rng = np.random.default_rng(seed)
    return [f"v{x}" for x in rng.integers(0, words, n)]


# -- near duplicates --------------------------------------------------------------------


def _sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _components(rows):
    sets = {i: _sets(t) for i, t in rows}
    least = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and 100 * both >= 85 * len(sets[a] | sets[b]) and least[a] < least[b]:
                    least[b], changed = least[a], True
    return {i: (len(sets[i]), least[i], least[i] == i) for i in sets}


def test_minhash_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 3)  # several blocks
    rows, base = [], _text(1, 300, 10_000)
    rng = np.random.default_rng(2)
    for i in range(40):
        words = list(base)
        for k in rng.integers(0, 300, i % 9):
            words[k] = f"x{i}_{k}"
        rows.append((100 - i, " ".join(words)))
    rows += [(200, " ".join(base)), (201, "Short one"), (202, "short ONE"), (203, ""), (204, None), (205, "other")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _components(rows)


def test_minhash_edges(edge, empty):
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minhash.duplicates(edge).collect())
    assert got == Counter([(None, None, True), (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (5, 4, False)])
    assert Counter(r.doc_id for r in minhash.one_of_each(edge).collect()) == Counter([None, 1, 2, 3, 4])
    twice = edge.filter("doc_id = 5")
    assert minhash.one_of_each(twice).count() == 1 and minhash.one_of_each(twice).columns == edge.columns
    assert minhash.duplicates(empty).count() == 0 and minhash.one_of_each(empty).count() == 0


def test_one_of_each_leaves_one_row_of_null_and_repeated_ids(spark):
    base = {k: _text(40 + k, 200, 10_000) for k in range(4)}
    near = lambda k, i: " ".join([*base[k][:100], f"x{i}", *base[k][101:]])
    rows = [(None, near(0, i)) for i in range(3)] + [(None, near(0, 0))]  # null ids only
    rows += [(7, near(1, i)) for i in range(3)] + [(9, near(1, 3))]  # a repeated id
    rows += [(None, near(2, 0)), (5, near(2, 1)), (None, ""), (None, None), (7, "")]
    rows += [(8, near(3, 0)), (8, near(3, 0)), (8, near(3, 0).upper())]  # one class, two texts
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in minhash.one_of_each(docs).collect()]
    assert Counter(d for d, t in left if t) == Counter([None, 7, 5, 8]) and set(left) <= set(rows)
    assert Counter((d, t) for d, t in left if not t) == Counter([(None, ""), (None, None), (7, "")])


# -- passages -----------------------------------------------------------------------------


def _without(rows):
    first = {}
    windows = []
    for i, (d, t) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for s in range(len(words) - 19):
            w = tuple(words[s : s + 20])
            key = (float("inf") if d is None else d, s)
            first[w] = min(first.get(w, key), key)
            windows.append((i, s, w, key))
    gone = {i: set() for i in range(len(rows))}
    for i, s, w, key in windows:
        if key > first[w]:
            gone[i] |= set(range(s, s + 20))
    out = []
    for i, (d, t) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        kept = " ".join(w for k, w in enumerate(words) if k not in gone[i])
        out.append((d, len(words), len(gone[i]), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("slice_bytes", [4_000_000, 500])
def test_passages_against_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(substring_dedup, "SLICE_BYTES", slice_bytes)
    shared, line = _text(3, 60), ["same"] * 45
    rows = [(i, " ".join(_text(10 + i, 50, 90) + shared[i : i + 30] + _text(50 + i, 30, 90))) for i in range(12)]
    rows += [(40, " ".join(line)), (41, " ".join(line[:30])), (42, None), (43, ""), (44, "one two"), (None, " ".join(shared)), (3, rows[3][1])]
    rows += [(60 + i, " ".join(shared)) for i in range(30)]
    got = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == _without(rows)


def test_passages_around_one_short_notice(spark, monkeypatch):
    limit = 3_000
    monkeypatch.setattr(substring_dedup, "BUCKET_BYTES", limit)
    largest, bounded = [], substring_dedup.bounded

    def seen(strings, bound):
        out = bounded(strings, bound)
        sizes = out.filter(F.col("kind") == substring_dedup.STRING).groupBy("bucket").agg(F.sum(F.length("packed")).alias("size"))
        largest.append([x.agg(F.max("size")).head()[0] for x in (strings.groupBy("bucket").agg(F.sum(F.length("packed")).alias("size")), sizes)])
        return out

    monkeypatch.setattr(substring_dedup, "bounded", seen)
    notice = _text(7, 12, 10_000)
    rows = [(i, " ".join(_text(100 + i, 40, 10_000) + notice + _text(300 + i % 40, 40, 10_000))) for i in range(80)]
    got = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == _without(rows)
    assert largest[0][0] > limit >= largest[0][1]


def test_passages_at_one_place_of_null_and_repeated_ids(spark):
    head, part = _text(8, 25, 10_000), _text(9, 40, 10_000)
    rows = [(None, " ".join(head + _text(500 + i, 30, 10_000))) for i in range(12)] + [(7, " ".join(part + _text(600 + i, 30, 10_000))) for i in range(12)]
    rows += [(1, " ".join(_text(700, 9, 10_000) + head)), (2, " ".join(_text(701, 5, 10_000) + part[8:])), (3, " ".join(_text(702, 30, 10_000)))]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")  # slices of four rows
    try:
        for bound in (4_000_000, 100):  # whole buckets, split ones
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(substring_dedup, "BUCKET_BYTES", bound)
                got = substring_dedup.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
            assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == _without(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_passages_edges(edge, empty):
    got = Counter((r.doc_id, r.n_removed) for r in substring_dedup.without_repeats(edge).collect())
    assert got == Counter([(None, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 30_000), (5, 30_000)])
    assert substring_dedup.without_repeats(empty).count() == 0


# -- decontamination -----------------------------------------------------------------------


def test_decontamination(spark, monkeypatch, edge, empty):
    bench = spark.createDataFrame(
        [("b", "Alpha beta, gamma!"), ("a", " ".join(f"q{i}" for i in range(14))), ("c", None), (None, "?"), ("a", "w7 w8")], "item_id string, text string"
    )
    rows = [(1, "x ALPHA beta gamma y " + " ".join(f"q{i}" for i in range(1, 13))), (2, "alpha beta delta"), (3, None), (4, "w7-w8 w7 w8")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (8_000_000, 20):  # one block, several blocks
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", size)
        got = {r.doc_id: r for r in decontaminate.contamination(docs, bench).collect()}
        assert {d: (r.n_words, r.n_hit, r["items"], r.contaminated) for d, r in got.items()} == {
            1: (17, 15, ["a", "b"], True), 2: (3, 0, [], False), 3: (0, 0, [], False), 4: (4, 4, ["a"], True),
        }
        assert ("a", 5, 1, 12) in {tuple(m) for m in got[1].matches}
        assert [r.doc_id for r in decontaminate.keep_clean(docs, bench).orderBy("doc_id").collect()] == [2, 3]
    assert decontaminate.contamination(edge, bench).count() == len(EDGE)
    assert decontaminate.keep_clean(edge, bench).columns == edge.columns
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.keep_clean(edge, bench.limit(0)).count() == len(EDGE)


# -- shards ---------------------------------------------------------------------------------


def test_shards(spark, edge, empty):
    docs = spark.createDataFrame([(i, "x" * (i % 97 * 10)) for i in range(3_000)], "doc_id long, text string")
    placed, table = sharding.shard(docs)
    rows = placed.collect()
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
        assert r.size == r.doc_id % 97 * 10 + 1 and r.text_crc32 == zlib.crc32(b"x" * (r.size - 1))
    assert max(load.values()) - min(load.values()) < 100
    for s in range(16):
        own = sorted(r.slot for r in rows if r["shard"] == s)
        assert own == list(range(len(own)))
    assert table.groupBy("version").count().orderBy("version").collect() == [(1, 4096), (2, 4096)]
    assert Counter((r.doc_id, r["size"]) for r in sharding.shard(edge)[0].collect()) == Counter((d, len(t or "") + 1) for d, t, *_ in EDGE)
    assert sharding.shard(empty)[0].count() == 0
    at, sizes = sharding.even_map(), {s: 10 + s % 7 for s in range(4096)}
    more = sharding.grown(at, sizes)
    assert all(more[s] in (at[s], 16) for s in at) and abs(sum(sizes[s] for s in at if more[s] == 16) * 17 / sum(sizes.values()) - 1) < 0.05


# -- personal data ----------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def _plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card" and 14 <= len(digits) <= 19 and _luhn(digits)
                or kind == "phone" and 10 <= len(digits) <= 15
            ):
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x for _, _, x in sorted(out))


def test_pii_against_plain_patterns(spark, edge, empty):
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("01234567890123456789.@-+ ()aé😀%_"), 200)) for _ in range(600)]
    texts += ["4111 1111 1111 1111", "x4111-1111-1111-1111,41111111111111112222", "a@b.c.@x.y 1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.255", "7" * 60_000, "a" * 60_000 + "@b.c", "1." * 30_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.with_spans(docs).select("doc_id", pii.joined(F.col("pii_spans"), pii.BASE_KINDS).alias("spans")).collect()}
    assert got == {i: _plain_spans(t) for i, t in enumerate(texts)}
    rows = [(1, "é mail a@b.cc now +1 (017) 555-7713", "k", 9), (2, "IBAN GB82 WEST 1234 5698 7654 32.", "k", 9), (3, "none", "k", 4), (4, None, "k", None)]
    out = {r.doc_id: r for r in pii.masked(spark.createDataFrame(rows, DOCS)).collect()}
    assert out[1].text == "é mail <email> now <phone>" and out[1].n_chars == len(out[1].text)
    assert out[2].text == "IBAN <iban>." and out[3].text == "none" and out[4].text is None
    assert pii.masked(edge).columns == edge.columns and pii.masked(edge).count() == len(EDGE) and pii.masked(empty).count() == 0


def test_account_numbers_in_running_text(spark):
    gb, de, spaced, no, other = "GB29NWBK60161331926819", "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "NO9386011117947", "ZZ92ABCD1234567890"
    cases = {
        f"{gb} Please call": [gb],
        f"{spaced} 12 May": [spaced],
        f"{de} BIC: X": [de],
        f"Überweisung an {spaced} Commerzbank": [spaced],
        f"{no} 7 {spaced} {gb} A B C": [no, spaced, gb],
        f"REF12 AT12 {spaced} {'1234 ' * 9}": [spaced],
        f"{other} OF 1 MAY": [other],
        f"{other}.": [other],
        f"{de}0 {de}x x{de} DE88370400440532013000 DE89 3704 0044": [],
        "": [],
    }
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "doc_id long, text string")
    got = {r.doc_id: [r.text[s.start : s.stop] for s in r.pii_spans if s.kind == "iban"] for r in pii.with_spans(docs).collect()}
    assert got == dict(enumerate(cases.values()))
    out = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert out[0] == "<iban> Please call" and out[1] == "<iban> 12 May" and out[2] == "<iban> BIC: X"


# -- tokens -------------------------------------------------------------------------------------


def test_ids_are_those_of_the_whole_text():
    e = encoder()
    texts = ["Hello, World's end!! İstanbul été, ΣΑΣ...", "don't <|endoftext|>x 12 a1b2,c é!?", "", "  ", "naïve\x0bĿ·x ǅ ŉ 'tis we'll, x'", "日本語 テスト。", LONG[:5000]]
    ids, counts = e.encode(pa.array(texts))
    plain = [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(p) for p in plain] and ids.tolist() == [i for p in plain for i in p]


def test_packing_keeps_every_id_once(spark, edge, empty):
    docs = edge.unionByName(spark.createDataFrame([(10 + i, " ".join(_text(i, 7 * i)), "x", 1) for i in range(60)], DOCS))
    rows = packing.pack(docs, with_ids=True).collect()
    e = encoder()
    want = Counter()
    for d, t, *_ in docs.collect():
        want[d, tuple(e.tokenizer.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    got: dict = {}
    for r in rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, tuple(r.ids)))
    for (d, n), pieces in got.items():
        copies = sum(c for (i, ids), c in want.items() if i == d and len(ids) == n)
        assert sorted(pieces)[::copies] and sum(len(p) for _, p in pieces) == n * copies
        assert (d, tuple(x for _, p in sorted(pieces)[::copies] for x in p)) in want
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))] and sum(n for _, n in own) <= 2048
    assert packing.pack(empty).count() == 0


def test_shortest_pack_first():
    hist = {2048: 3, 1500: 10, 548: 4, 300: 20, 1: 5_000}
    packed = packing.shortest_pack_first(hist)
    assert all(sum(p) <= 2048 for p, _ in packed)
    assert Counter({k: sum(c * p.count(k) for p, c in packed) for k in hist}) == Counter(hist)


def test_token_histogram(spark, edge, empty):
    sums = token_counts.with_suffix_sums(token_counts.length_histogram(token_counts.with_token_counts(edge))).cache()
    n = sorted(len(encoder().tokenizer.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in EDGE)
    for r in sums.collect():
        assert (r.n_docs, r.docs_at_least) == (n.count(r.n_tokens), sum(x >= r.n_tokens for x in n))
        assert r.tokens_at_least == sum(x for x in n if x >= r.n_tokens)
        assert r.tokens_truncated == sum(min(x, r.n_tokens) for x in n) and r.tokens_total == sum(n)
    limits = [1, 2, 100, 10**7]
    assert token_counts.truncated_totals(sums, limits) == [(k, sum(min(x, k) for x in n)) for k in limits]
    assert token_counts.quantiles(sums, [0.5, 1.0]) == [(0.5, n[3]), (1.0, n[-1])]
    assert token_counts.with_suffix_sums(token_counts.length_histogram(token_counts.with_token_counts(empty))).count() == 0


# -- quality ---------------------------------------------------------------------------------------


def test_rule_order_never_changes_the_verdict(spark, edge, empty):
    good = [(i, " ".join(_text(i, 80)), "x", 1) for i in range(20)]
    bad = [(100, "a b c " * 40, "x", 1), (101, " ".join(f"{w}###" for w in _text(1, 80)), "x", 1), (102, "\n".join(" ".join(_text(3, 30)) for _ in range(9)), "x", 1)]
    docs = spark.createDataFrame(good + bad, DOCS)
    assert Counter(r.kept for r in quality_rules.judge(docs).collect()) == Counter({True: 20, False: 3})
    a = [quality_rules.first_rejecting(quality_rules.Measures(t.encode()), quality_rules.RULES) is None for _, t, *_ in good + bad]
    b = [quality_rules.first_rejecting(quality_rules.Measures(t.encode()), quality_rules.RULES[::-1]) is None for _, t, *_ in good + bad]
    assert a == b
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == 20
    assert quality_rules.judge(edge).filter("kept").count() == 3 and quality_rules.judge(empty).count() == 0
    assert quality_rules.keep_good(empty).count() == 0


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    out = quality_classifier.classify(docs, labels.filter(~held), F.col("source"), F.col("lang")).join(labels.filter(held), "doc_id").collect()
    right = sum(r.kept == (r.quality == 1 and r.toxic == 0) for r in out) / len(out)
    clean = [r.kept for r in out if r.quality == 1 and r.toxic == 0]
    assert right > 0.96 and sum(clean) / len(clean) > 0.98


def test_classifier_edges(spark, edge, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = quality_classifier.classify(edge, labels, F.col("kept"), F.lit(None)).collect()
    assert len(out) == len(EDGE) and all(r.kept for r in out)
    assert quality_classifier.classify(empty, labels, F.col("kept"), F.lit(None)).count() == 0
    assert spark.range(1).select(*quality_classifier.url_levels(F.lit("https://U@Ex.org:80/a/b?c"))).head()[:] == ("ex.org", "/a")


def test_sparse_sites_shrink_more(spark):
    rows = [(i, "big", "p", 0.2, ) for i in range(400)] + [(1000 + i, "small", "p", 0.2) for i in range(2)] + [(2000 + i, "good", "p", 0.9) for i in range(400)]
    out = quality_classifier.combined(spark.createDataFrame(rows, "doc_id long, host string, path string, p_t double"), ["t"])
    at = {r.host: r.path_t for r in out.select("host", "path_t").distinct().collect()}
    assert at["big"] < at["small"] < at["good"]


# -- pages --------------------------------------------------------------------------------------------


def test_pages(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header>Top</header><nav><ul><li>Home<li>More</ul></nav>
    <div class="side sidebar">Links here, many, many.</div><article><h1>Head &amp; tail</h1><p><b>One<br>two.<p>Three,
    &lt;four&gt;.</p><script>var t="</p>";</script><p>x</p><form>Mail: <input></form><section id="comments"><p>I disagree, strongly.</p></section>
    </article><!-- <p>no</p> --><aside>By the way</aside><footer>&copy; me</footer>"""
    assert html_extract.main_text(page) == "Head & tail\n\nOne two.\n\nThree, <four>.\n\nx"
    plain = '<body><div class="menu">a | b | c</div><div><div>Long text, with marks, and more of it.</div><div>Another one, long enough.</div></div></body>'
    assert html_extract.main_text(plain) == "Long text, with marks, and more of it.\n\nAnother one, long enough."
    for odd in (None, "", "<", "<p", "<p>a<", "no markup", "<script>x", "<!-- x", "</p></div>", "<a b='"):
        assert isinstance(html_extract.main_text(odd), str)
    rows = spark.createDataFrame([(1, "u", page, "t"), (1, "u", page, "t"), (2, None, None, None)], "page_id long, url string, html string, text string")
    assert Counter(r.text for r in html_extract.extract(rows).collect()) == Counter({html_extract.main_text(page): 2, "": 1})


def test_names_and_short_blocks_of_pages():
    text, more = "A long sentence, with marks, about the matter. " * 3, "Another one, just as long, and to the point. " * 3
    side = '<div class="sidebar"><p>Links, ads, and more links.</p></div>'
    want = f"Head\n\n{text.strip()}\n\n{more.strip()}"
    inner = f"<h1>Head</h1><p>{text}</p><p>{more}</p>"
    for name in ("layout has-sidebar", "with-sidebar", "no-ads", "elementor-widget-container", "has-header", "comments-open"):
        for tag in ("article", "main", "div"):
            assert html_extract.main_text(f'<body><div class="{name}"><{tag}>{inner}</{tag}>{side}</div></body>') == want, (name, tag)
        assert html_extract.main_text(f'<body><article><div class="{name}">{inner}</div></article>{side}</body>') == want, name
    assert html_extract.main_text(f'<body><x-app class="has-sidebar"><article>{inner}</article>{side}</x-app></body>') == want
    talk = '<div id="comments"><article class="comment"><p>I disagree, strongly, with all of it.</p></article></div>'
    teasers = '<div class="related"><article><p>Another story, in short.</p></article></div>'
    assert html_extract.main_text(f'<body><main><div class="no-ads"><article>{inner}</article>{talk}</div>{teasers}</main></body>') == want
    assert html_extract.main_text(f'<p>One <span class="social">Share</span> two, three, four.</p><p>{text}</p>') == f"One two, three, four.\n\n{text.strip()}"
    short = f"<div><h2>Head</h2><p>{text}</p><ul><li>a</li><li>b</li></ul><table><caption>T</caption><tr><td>1</td><td>2</td></tr></table><p>{more}</p></div>"
    assert html_extract.main_text(f"<body><div>Top</div>{short}<div>End</div></body>") == "\n\n".join(["Head", text.strip(), "a", "b", "T", "1", "2", more.strip()])


def test_given_pages():
    import pyarrow.parquet as pq

    for page in pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist():
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        import html

        want = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert html_extract.main_text(page) == "\n\n".join(b for b in want if b)
