"""Long texts of one kind each: no stack runs out, and time grows with the length."""

from __future__ import annotations

import random
import re
import time

import pytest

from strata.llm import licenses, pii, quality_classifier, quality_rules, toxicity

N = 100_000
NOTICE = "Released under the MIT License. "
KINDS = {
    "menu": "home ",
    "labels": "About us | Contact us, ",
    "marks": "! ? ",
    "separators": "| > ",
    "blanks": " \t",
    "letters": "abcdefgh",
    "figures": "12345 ",
    "digits": "one ",
    "dots": "dot ",
    "ats": "joe at ",
    "signs": "a @ ",
    "brackets": "one [ ",
    "dotted": "x dot at ",
    "notices": NOTICE,
    "furniture": "privacy policy ",
    "lines": "one word\n",
    "breaks": "\n",
}
TEXTS = [(i, "one " + unit * N) for i, unit in enumerate(KINDS.values())]


@pytest.fixture(scope="module")
def long_texts(spark):
    df = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    return df.repartition(8).cache()


def test_rules(long_texts):
    rows = {list(KINDS)[row["doc_id"]]: row for row in quality_rules.judge(long_texts).collect()}
    assert len(rows) == len(KINDS) and not any(row["kept"] for kind, row in rows.items() if kind != "letters" and row["base_failed"])
    assert rows["menu"]["n_words"] == N + 1 and rows["breaks"]["n_words"] == 1
    labels = "home " * N
    judged = quality_rules.judge(long_texts.sparkSession.createDataFrame([(1, labels), (2, labels + "x")], "doc_id int, text string"))
    assert {row["doc_id"]: row["n_lines_removed"] for row in judged.collect()} == {1: 1, 2: 0}


def test_menu_lines(spark):
    """The rule against one pattern for the whole line, on short lines."""
    drawn = random.Random(2)
    parts = ["home", "About", "about us", "us", "log in", "log", "FAQ", " ", "  ", "|", ">", ", ", "-", "news", "x", "contact us", "\t"]
    lines = ["".join(drawn.choice(parts) for _ in range(drawn.randint(1, 7))) for _ in range(2_000)]
    space = quality_rules.SPACE
    whole = re.compile(f"^[{space}]*(?:(?:{quality_rules.MENU})[{space}|/»>·•,-]*){{2,}}$", re.I)
    df = spark.createDataFrame([(line,) for line in lines], "line string")
    got = {row["line"]: row["menu"] for row in df.withColumn("menu", quality_rules.nothing_but_labels(df["line"])).collect()}
    assert got == {line: bool(whole.match(line)) for line in lines}
    assert sum(got.values()) > 50


def seconds(function, text):
    start = time.process_time()
    function(text)
    return time.process_time() - start


@pytest.mark.parametrize("unit", KINDS.values(), ids=KINDS)
def test_time_grows_with_the_length(unit):
    """Eight times the text takes far less than 64 times as long."""
    ready = licenses.prepared(licenses.TEMPLATES, 0.8)
    for function in (pii.find_all, lambda text: licenses.match(text, ready, 0.8)):
        short, long = ("one " + unit * (n // len(unit)) for n in (50_000, 400_000))
        assert seconds(function, long) < 25 * max(seconds(function, short), 0.02)


def test_long_runs_of_blanks_and_letters():
    assert pii.find_all("one" + " " * 2_000_000) == ([], [])
    assert pii.find_all("one " + "a" * 2_000_000) == ([], [])
    base, spans = pii.find_all("joe" + " " * 1_000_000 + "at x dot com, one")
    assert (base, spans) == ([], [("email", 0, 1_000_015)])


def test_licences_side_by_side():
    ready = licenses.prepared(licenses.TEMPLATES, 0.8)
    found = licenses.match(NOTICE * 5_000, ready, 0.8)
    assert len(found) == 5_000 and {name for name, *_ in found} == {"MIT notice"}
    assert all(a[3] <= b[2] for a, b in zip(found, found[1:]))


def test_scoring(long_texts):
    assert all(len(toxicity.tokens_of(text)) < 50 for _, text in TEXTS)
    texts = long_texts.select("text").toArrow().combine_chunks()["text"]
    texts = texts.combine_chunks() if hasattr(texts, "combine_chunks") else texts
    assert quality_classifier.terms_of(texts).shape == (len(KINDS), quality_classifier.BUCKETS)
