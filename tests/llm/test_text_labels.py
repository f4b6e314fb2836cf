"""Language CRF, URL cascade and contextual PII."""
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from triagekit.llm import langid, pii, queries, url_filter

SMALL = "/root/testdata/sf0.001"


# --- language ------------------------------------------------------------------------------

def test_posteriors_equal_enumeration():
    rng = np.random.default_rng(1)
    emission, transition = rng.normal(size=(12, 3)), rng.normal(size=(3, 3))
    sizes = np.array([1, 5, 6])
    for block in (2, 3, 100):
        got, at = langid.posteriors(emission, sizes, transition, block), 0
        for n in sizes:
            e, total = emission[at:at + n], np.zeros((n, 3))
            for ys in itertools.product(range(3), repeat=int(n)):
                s = sum(e[i, y] for i, y in enumerate(ys)) + sum(transition[a, b] for a, b in zip(ys, ys[1:]))
                total[np.arange(n), list(ys)] += np.exp(s) * np.exp(transition)[:, ys[0]].sum()
            assert np.allclose(got[at:at + n], total / total.sum(1, keepdims=True))
            at += n


def test_pair_posteriors_are_consistent_with_the_single_ones():
    rng = np.random.default_rng(2)
    emission, transition, sizes = rng.normal(size=(9, 2)), rng.normal(size=(2, 2)), np.array([4, 5])
    post = langid.posteriors(emission, sizes, transition)
    prev = np.array([0, 1, 2, 4, 5, 6, 7])
    pair = langid._pair_posteriors(emission, sizes, transition, prev, prev + 1)
    assert np.allclose(pair.sum(1), post[prev].sum(0)) and np.allclose(pair.sum(0), post[prev + 1].sum(0))


@pytest.fixture(scope="module")
def model(spark):
    return queries.language_model(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op4(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out and lang is not null")
    assert held.count() > 100
    assert held.where("lang = lang_pred").count() / held.count() > 0.97
    assert got.count() == docs.count() and got.where("score < 0 or score > 1").count() == 0


def test_edge_texts(documents, model):
    rows = [(1, None), (2, ""), (3, "123 !! ..."), (None, "the of and"), (4, "the " * 20000), (4, "the " * 20000), (5, "东京")]
    got = langid.predict(documents(rows), model).collect()
    assert sorted((r.doc_id or 0, r.lang_pred == "und", r.score == 0) for r in got) == [
        (0, False, False), (1, True, True), (2, True, True), (3, True, True), (4, False, False), (4, False, False), (5, False, False)]
    assert langid.predict(documents([]), model).count() == 0


def test_code_switched_words(spark, documents, model):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").where("length(text) > 400").collect()
    text = {lang: " ".join(next(r.text for r in rows if r.lang == lang).split()[:25]) for lang in ("en", "de")}
    labels = langid.label_words(documents([(1, text["en"] + " " + text["de"])]), model).first().labels
    half = len(labels) // 2
    assert labels[:half].count("en") > 0.8 * half and labels[half:].count("de") > 0.8 * half


def test_no_labels_and_one_label(documents, spark):
    none = langid.fit([])
    assert langid.predict(documents([(1, "abc")]), none).first().lang_pred == "und"
    one = langid.fit([("xx", ["abc", "abd"])])
    r = langid.predict(documents([(1, "abc")]), one).first()
    assert (r.lang_pred, r.score) == ("xx", 1.0)
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.sample(empty) == []


def test_predictions_do_not_depend_on_other_columns(documents, model):
    a = langid.predict(documents([(1, "there and the"), (5, "there and the")]), model).collect()
    assert a[0].score == a[1].score


# --- urls ----------------------------------------------------------------------------------

URLS = ["http://a.example.org/en/12?x=1", "https://EXAMPLE.ORG/es/", "http://example.org", "http://badexample.org/es/1", None,
        "no scheme", "x://y.com/fr/1", "x://com/de/#z", "http://a.b.com/dex", "http://a.com?/fr/", "http://org/", "http://.org/",
        "://", "a://b://c.org/en/1", "http://x.org./", "http://exämple.org/ÉS/", "http://" + "a." * 5000 + "org/" + "b" * 5000, ""]


def brute_judge(url, rules):
    m = re.search("://", url or "")
    rest = url[m.end():] if m else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for r in rules:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(r[len(h):]) and (best is None or len(r) > len(best)):
            best = r
    return host, path, best, rules[best] if best else "allow"


def test_rules_equal_brute_force(spark):
    rng = random.Random(8)
    rules = dict(queries.URL_RULES) | {f"site{i}.com/": rng.choice(["allow", "block"]) for i in range(300)}
    urls = URLS + [f"https://{rng.choice(['', 'www.', 'a.b.'])}site{rng.randrange(600)}.com/{rng.choice(['', 'fr/', 'de/', 'x'])}" for _ in range(400)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[0], None)],
                                  "page_id long, url string, host string")
    for use in (rules, queries.URL_RULES):
        got = url_filter.judge(pages, use).collect()
        assert len(got) == len(urls) + 2
        for r in got:
            assert (r.host, r.path, r.rule, r.verdict) == brute_judge(urls[r.page_id or 0], use)


def test_cascade_is_exact_with_false_positives(spark, monkeypatch):
    """Too few bits: several levels are needed, and the answers stay exact over the universe."""
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 3)
    monkeypatch.setattr(url_filter, "LEAST_BITS", 64)
    universe = spark.range(20000).selectExpr("concat('k', id) as key")
    listed = spark.range(700).selectExpr("concat('k', id * 31) as key")
    cascade = url_filter.build(listed, universe)
    assert len(cascade.levels) >= 3
    got = {r.key for r in universe.where(cascade.holds(F.col("key"))).collect()}
    assert got == {f"k{i * 31}" for i in range(700) if i * 31 < 20000}


def test_no_pages_no_rules(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge(empty, queries.URL_RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_filter.judge(one, {}).first().verdict == "allow"


# --- personal data -------------------------------------------------------------------------

PLAIN = [(0, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), (1, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         (2, r"[0-9]([\x20-]?[0-9])+"), (3, r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    out = []
    for kind, form in PLAIN:
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {0: True, 1: kind == 1 and all(int(p) <= 255 for p in m[0].split(".") if kind == 1),
                  2: 12 <= len(digits) <= 19 and pii.luhn(digits), 3: 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    parts = ["a", "b.c", "@", "@x.y", ".", "1", "12", "255", "256", "4539578763621486", " ", "-", "+1", "(408)", "555-7800", "é", "%", "\n"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 16)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_long_runs_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1 " * 100_000):
        pii.base_spans(text)


def test_contexts_discover_unseen_identifiers(documents):
    rng = random.Random(3)
    card = lambda: "4539 5787 6362 1486".replace(" ", "")  # noqa: E731, F841
    def luhn_card():
        while True:
            x = "4" + "".join(rng.choice("0123456789") for _ in range(15))
            if pii.luhn(x):
                return x
    rows = [(i, f"please charge card number {luhn_card()} today thanks w{i}") for i in range(60)]
    rows += [(100 + i, f"order id {rng.randrange(10**15, 10**16 - 1)} was shipped w{i}") for i in range(30)]
    bad = "4539578763621487"
    rows += [(200, f"please charge card number {bad} today thanks"), (201, f"order id {bad[:-1]}9 was shipped"), (202, None), (None, "")]
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in pii.find(documents(rows)).collect()}
    assert got[200] == [(26, 2, 42)]
    assert got[201] == [] and got[202] == [] and got[None] == []
    assert all(len(got[i]) == 1 for i in range(60))


def test_contexts_discover_other_shapes(documents):
    """Values of shapes that no seed has: national numbers, a spaced card, an address without a dot."""
    rng = random.Random(5)

    def luhn_card():
        while True:
            x = "4" + "".join(rng.choice("0123456789") for _ in range(15))
            if pii.luhn(x):
                return x

    rows = [(i, f"please call +1 408-555-{7000 + i} today") for i in range(40)]
    rows += [(100 + i, f"they mail bob{i}@x{i}.org about it") for i in range(40)]
    rows += [(200 + i, f"we charge card number {luhn_card()} then") for i in range(40)]
    rows += [(300 + i, f"in year {1980 + i} order number {10**9 + i} was sent") for i in range(30)]
    text = {400: "please call 408-555-7800 today", 401: "please call (408) 555-7801 today.", 402: "they mail bob@localhost about it",
            403: "we charge card number 4539 5787 6362 1487 then", 404: "please call 1985 today", 405: "order number 1000000099 was sent"}
    want = {400: "408-555-7800", 401: "(408) 555-7801", 402: "bob@localhost", 403: "4539 5787 6362 1487"}
    got = {r.doc_id: r for r in pii.find(documents(rows + list(text.items()))).collect()}
    for i, t in text.items():
        assert [t[x["start"]:x["end"]] for x in got[i].spans] == ([want[i]] if i in want else []), t
    assert [got[i].spans[0]["kind"] for i in sorted(want)] == [3, 3, 0, 2]
    assert all(len(got[i].spans) == (i < 300) for i, _ in rows)


def test_bootstrap_follows_long_chains_of_contexts(documents):
    """Each group of numbers is known only after the group before it."""
    def number(i, j):
        return next(x for x in (str(4 * 10**15 + i * 10**6 + j * 100 + d) for d in range(100)) if pii.luhn(x) == (i == 0))

    depth, rows = 5, []
    for i in range(depth):
        for j in range(5):
            for value in [number(i, k) for k in range(20)] + [number(i + 1, k) for k in range(4 * j, 4 * j + 4)]:
                rows.append((i + 1, f"a{i}x{j}e b{i}x{j}e {value} c{i}x{j}e d{i}x{j}e"))
    got = pii.find(documents(rows)).collect()
    assert all(r.spans and r.spans[0]["kind"] == 2 for r in got) and len(got) == 120 * depth
    extracted = pii.extract(documents(rows[:120]))
    with pytest.raises(RuntimeError):
        pii.bootstrap(extracted, rounds=1)


def test_long_values_and_words_are_told_apart(documents):
    rows = [(i, f"they mail bob{i}@x{i}.org about it") for i in range(40)]
    long = "y" * 300
    rows += [(100, f"they mail {long}1@localhost about it"), (101, f"see {long}2@localhost or not")]
    got = {r.doc_id: len(r.spans) for r in pii.find(documents(rows)).collect()}
    assert got[100] == 1 and got[101] == 0
    assert len({tuple(pii.instances(f"{long}{i} 1234567", [])[0][-1]) for i in "ab"}) == 2


def test_numbers_of_several_words():
    def found(text):
        return [text[b:e] for b, e in pii.numbers(text, sorted((s, e, k) for s, k, e in pii.base_spans(text)))]
    assert found("at (408) 555-7800. tel:408 555 - 7801, (or 408.555.7802) 12 x7 v1.2.3 4539 5787 6362 1487\n99") == [
        "(408) 555-7800", "408 555 - 7801", "408.555.7802", "4539 5787 6362 1487"]
    assert found("+1 408-555-7800 and 4111111111111111") == [] and found("12345678ab 123456") == []
    assert found("1234567890 1234567890 1234567890") == ["1234567890", "1234567890"]
    for text in ("1 " * 200_000, "1)" * 200_000, "1." * 200_000 + "a", "(" * 200_000 + "1234567" + ")" * 200_000):
        pii.instances(text, pii.base_spans(text))


def test_redaction_and_repeated_rows(documents):
    rows = [(1, "mail x@y.org or x@y.org now 🙂 +1 (408) 555-7800."), (1, "mail x@y.org or x@y.org now 🙂 +1 (408) 555-7800."),
            (2, "nothing"), (3, None), (None, "a@b.cd")]
    got = pii.redact(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in got) == [
        (0, "<EMAIL>"), (1, "mail <EMAIL> or <EMAIL> now 🙂 <PHONE>."), (1, "mail <EMAIL> or <EMAIL> now 🙂 <PHONE>."),
        (2, "nothing"), (3, "")]
    assert pii.redact(documents([])).columns == ["doc_id", "text", "length"]
    assert pii.find(documents([])).count() == 0


def test_long_words_are_labelled_whole(spark):
    model = langid.fit([("aa", ["alpha", "beta", "gamma"] * 8), ("bb", ["uno", "due", "tre"] * 8)])
    ends, middle = "alphabetagamma" * 3, "unoduetre" * 30
    assert "".join(langid.pieces(ends + middle)) == ends + middle and langid.pieces("short-ish") == ["shortish"]
    assert langid.pieces("--12--") == [] and max(len(p.encode()) for p in langid.pieces("文" * 999)) <= langid.MAX_WORD_BYTES
    docs = spark.createDataFrame([(1, ends + middle + ends), (2, ends * 8), (3, "alpha " + middle + " beta")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert got == {1: "bb", 2: "aa", 3: "bb"}
    labels = {r.doc_id: r.labels for r in langid.label_words(docs, model).collect()}
    assert len(labels[3]) == 2 + len(langid.pieces(middle))
