"""Rules, pseudonyms, classifier and url verdicts on small fixtures."""

from __future__ import annotations

import re
from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from creditloom.llm import host_reputation, pseudonyms, quality_rules, rule_ensemble

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + o for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for o in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_a_plain_count(documents, nothing):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = quality_rules.measured(documents, keep=("text",)).select("text", *names).collect()
    assert len(rows) == documents.count()
    assert all(tuple(r)[1:] == by_hand(r["text"]) for r in rows)
    assert quality_rules.ledger(nothing).count() == 0


def test_policies_and_ablations_follow_from_the_bits(documents):
    table = quality_rules.ledger(documents.select("doc_id", "text")).cache()
    passed = table.where(quality_rules.passes(quality_rules.STRICT))
    assert passed.count() == table.where("failure_bits = 0").count()
    rows = {r["rule"]: r for r in quality_rules.ablations(table, quality_rules.STRICT).collect()}
    bits = [r["failure_bits"] for r in table.collect()]
    for i, rule in enumerate(quality_rules.RULES):
        assert rows.get(rule.name, {"failed": 0})["failed"] == sum(b >> i & 1 for b in bits)
        assert rows.get(rule.name, {"only": 0})["only"] == sum(b == 1 << i for b in bits)
    kept = quality_rules.passing(documents, (quality_rules.BASE,))
    assert kept.columns == documents.columns and [r["doc_id"] for r in kept.collect()] == [6]


def test_pseudonyms_keep_format_and_link_equal_values():
    key = b"key"
    text = ("card 4111 1111 1111 1111 or 4111-1111-1111-1111, 4111111111111112 is none. 10.0.0.1 300.1.1.1 2024-02-29 2023-02-29 "
            "31/12/1999 123-45-6789 000-12-3456 GB82WEST12345698765432 +1 (415) 555-2671 a.b12@mail.example.com 4111111111111111 10.0.0.2")
    new, n = pseudonyms.replaced(text, key)
    assert n == 11 and pseudonyms.replaced(text, key) == (new, n)
    kept = ("4111111111111112", "300.1.1.1", "2023-02-29", "000-12-3456", "@mail.example.com", "+1 (")
    gone = ("4111 1111", "4111-1111", "10.0.0.1 ", "2024-02-29", "31/12/1999", "123-45-6789", "WEST", "555-2671", "a.b12@")
    assert all(k in new for k in kept) and not any(g in new for g in gone)
    cards = [re.sub(r"\D", "", c) for c in re.findall(r"\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}\b|\b4\d{15}\b", new)]
    same = [c for c in cards if c != "4111111111111112"]
    assert len(same) == 3 and len(set(same)) == 1 and pseudonyms.luhn_digit(same[0][:-1]) == same[0][-1]
    date.fromisoformat(re.search(r"\d{4}-\d\d-\d\d(?= 2023)", new).group())
    assert pseudonyms.replaced(text, b"other")[0] != new


def test_usual_notations_get_pseudonyms():
    iban = "DE89 3704 0044 0532 0130 00"
    values = ["2021-03-04", "04-03-1990", "2021-3-4", "2021/3/4", "2021.03.04", iban, "AT61 1904 3002 3457 3201", "1-800-555-1234",
              "415 555 2671", "020 7946 0958", "+14155552671", "3782-822463-10005", "3782 822463 10005"]
    for value in values:
        for text in (f"a {value} b", value, f"({value})", f"{value}, IBAN"):
            new, n = pseudonyms.replaced(text, b"key")
            assert n == 1 and value not in new and len(new) == len(text), (text, new)
    new, n = pseudonyms.replaced("2021-03-04T10:00:00Z", b"key")
    assert n == 1 and new[10:] == "T10:00:00Z" and new[:10] == pseudonyms.replaced("2021-03-04", b"key")[0] != "2021-03-04"
    new, n = pseudonyms.replaced("AT61 1904 3002 3457 3201 PLUS 4111 1111 1111 1111", b"key")
    assert n == 2 and " PLUS " in new and "4111 1111" not in new
    assert pseudonyms.replaced(iban, b"key")[0].replace(" ", "") == pseudonyms.replaced(iban.replace(" ", ""), b"key")[0]


def test_notations_of_a_phone_stay_linked():
    plain = re.sub(r"\D", "", pseudonyms.replaced("415-555-2671", b"key")[0])
    for value in ("+1 415-555-2671", "+1 (415) 555-2671", "+14155552671", "1-415-555-2671", "1 (415) 555-2671", "415 555 2671", "415.555.2671"):
        new, n = pseudonyms.replaced(value, b"key")
        assert n == 1 and re.sub(r"\D", "", new)[-10:] == plain != "4155552671", value
    english = [re.sub(r"\D", "", pseudonyms.replaced(v, b"key")[0])[-10:] for v in ("+44 20 7946 0958", "020 7946 0958")]
    assert english[0] == english[1] or english[0][-9:] == english[1][-9:]


def test_numbers_that_are_no_phone_stay():
    for text in ("100 200 3000", "2 000 000", "1.5-2.5", "version 1.2.3", "30-30-3000-1"):
        assert pseudonyms.replaced(text, b"key") == (text, 0)


def test_permutations_are_one_to_one():
    for size in (1, 2, 3, 10, 1000, 4097):
        assert sorted(pseudonyms.permute(x, size, b"k", "t") for x in range(size)) == list(range(size))


def test_pseudonyms_pass_other_rows_through(documents, nothing):
    made = pseudonyms.pseudonymised(documents, b"k", counter="n_words")
    assert made.columns == documents.columns
    assert Counter(made.select("doc_id", "text", "node").collect()) == Counter(documents.select("doc_id", "text", "node").collect())
    assert pseudonyms.pseudonymised(nothing, b"k").count() == 0


def test_rules_learn_a_separable_class(spark):
    good = [(i, "plain words follow each other in a calm line " * (3 + i % 5), 1) for i in range(60)]
    bad = [(100 + i, "LOUD!! NOISE!! " * (5 + i % 7), 0) for i in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in good + bad] + [(900, None), (901, ""), (None, "a calm line")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in good + bad if i % 3] + [(3, None)], "doc_id long, label int")
    scores, model = rule_ensemble.scored(docs, labels)
    found = {r["doc_id"]: r["score"] for r in scores.collect()}
    assert len(found) == docs.count() and all(0 <= s <= 1 for s in found.values())
    assert model.rules and all((found[i] >= 0.3) == (q == 1) for i, _, q in good + bad)


def test_one_class_or_no_labels_give_a_constant(spark, documents, nothing):
    one = spark.createDataFrame([(0, 1), (6, 1)], "doc_id long, label int")
    assert {r["score"] for r in rule_ensemble.scored(documents, one)[0].collect()} == {1.0}
    assert {r["score"] for r in rule_ensemble.scored(documents, one.limit(0))[0].collect()} == {0.5}
    assert rule_ensemble.scored(nothing, one)[0].count() == 0


def test_url_parts_rules_and_shrinkage(spark):
    rule = host_reputation.UrlRule
    rules = [rule("block", "net", "/"), rule("allow", "example.net", "/en/"), rule("block", "example.com", "/de/")]
    urls = ["http://A.Example.NET/en/1?x", "https://b.example.net", "ftp://example.com/de/#a", "no url", None, "http://x.net/y",
            "http://bad.example.org/a", "http://new.example.org/b", "http://good.example.org/c", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([("http://bad.example.org/z", 0)] * 60 + [("http://good.example.org/z", 1)] * 60
                                     + [("http://good.example.org/q", None)], "url string, good int")
    rows = {r["page_id"]: r for r in host_reputation.judged(pages, outcomes, rules).collect()}
    parts = [(r["host"], r["path"], r["rule"], r["verdict"]) for _, r in sorted(rows.items())]
    assert parts[:6] == [("a.example.net", "/en/1", "example.net/en/", "allow"), ("b.example.net", "", None, "allow"),
                         ("example.com", "/de/", "example.com/de/", "block"), ("", "", None, "allow"), ("", "", None, "allow"),
                         ("x.net", "/y", "net/", "block")]
    assert [p[3] for p in parts[6:]] == ["block", "allow", "allow", "allow"] and parts[9][:2] == ("b:", "//c/d")
    assert host_reputation.judged(pages.limit(0), outcomes, rules).count() == 0
    assert host_reputation.judged(pages, outcomes.limit(0), rules).where("verdict = 'block'").count() == 2  # by rule


def test_posterior_moves_from_domain_to_host(spark):
    outcomes = spark.createDataFrame([("a.x.org", 0)] * 50 + [("b.x.org", 1)] * 50 + [("c.x.org", 1)], "host string, good int")
    rows = {r["host"]: r for r in host_reputation.host_posteriors(outcomes, spark.createDataFrame([("d.x.org",)], "host string")).collect()}
    assert rows["a.x.org"]["mean"] < rows["d.x.org"]["mean"] < rows["c.x.org"]["mean"] < rows["b.x.org"]["mean"]
    assert rows["d.x.org"]["deviation"] > rows["a.x.org"]["deviation"]


def test_suffix_lists_with_wildcards_part_registrants(spark):
    hosts = ["a.x.co.il", "x.github.io", "b.y.any.ck", "www.ck", "a.www.ck", "ck", "x.co.uk:80", "co.il", "p.q.s3.example.com", "", "one"]
    table = spark.createDataFrame([(h,) for h in hosts], "host string")
    own = (*host_reputation.TWO_LABEL_SUFFIXES, "co.il", "github.io", "*.ck", "!www.ck", "s3.example.com")
    found = [(r["suffix"], r["domain"]) for r in host_reputation.with_levels(table, own).collect()]
    assert found == [("co.il", "x.co.il"), ("github.io", "x.github.io"), ("any.ck", "y.any.ck"), ("ck", "www.ck"), ("ck", "www.ck"),
                     ("ck", "ck"), ("co.uk", "x.co.uk"), ("co.il", "co.il"), ("s3.example.com", "q.s3.example.com"), ("", ""), ("one", "one")]
    outcomes = spark.createDataFrame([("a.x.co.il", 0)] * 50 + [("b.y.co.il", 1)] * 50, "host string, good int")
    rows = {r["host"]: r["mean"] for r in host_reputation.host_posteriors(
        outcomes, spark.createDataFrame([("new.x.co.il",), ("new.y.co.il",)], "host string"), suffixes=own).collect()}
    assert rows["new.x.co.il"] < rows["new.y.co.il"]
