import re
import time

import pytest

from tapeline.llm import licenses, registry

KNOWN = [
    ("Released under the MIT License.", "MIT"),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
]


@pytest.mark.parametrize("name, text", licenses.TEMPLATES)
def test_every_template_finds_itself(name, text):
    around = f"Lorem ipsum dolor.\nsit amet {text} consectetur adipiscing elit"
    known = licenses.prepared(licenses.TEMPLATES)[1]
    hits = [licenses.judged(around[a:b], licenses.TEMPLATES) for a, b in licenses.candidates(around, known)]
    assert (name, True) in [(h[2], h[-1]) for h in hits]


@pytest.mark.parametrize(
    "text, name, good",
    [
        ("Licensed under the Apache License, Version 3.0.", "Apache-2.0", False),
        ("Licensed under CC BY 4.0.", "CC-BY-4.0", True),
        ("Licensed under CC BY-ND 4.0.", None, False),
        ("licensed UNDER the  apache\nlicense version 2.0", "Apache-2.0", True),
        ("This software is licensed under the GNU General Public License, version 2.", "GPL-2.0", True),
        ("You need a driving license to rent a car here.", None, False),
    ],
)
def test_wording_decides(text, name, good):
    known = licenses.prepared(licenses.TEMPLATES)[1]
    hits = [licenses.judged(text[a:b], licenses.TEMPLATES) for a, b in licenses.candidates(text, known)]
    assert any(h[-1] for h in hits) == good
    if good:
        assert [h[2] for h in hits if h[-1]] == [name]


def test_differences_are_those_outside_a_common_sequence():
    missing, added, first, last = licenses.differences("x a b q c y".split(), "a b c d".split())
    assert (missing, added, first, last) == (["d"], ["q"], 1, 5)
    assert licenses.differences([], ["a"]) == (["a"], [], 0, 0)


def test_odd_rows(spark):
    long = "filler " * 50_000 + "\n" + KNOWN[0][0] + "\n" + "words " * 50_000
    rows = [(1, None, 0), (2, "", 0), (3, "no notice", 0), (None, KNOWN[1][0], 0), (4, KNOWN[1][0], 0), (4, KNOWN[1][0], 0), (5, long, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license int")
    got = licenses.notices(df).collect()
    assert sorted((str(r.doc_id), r.license, r.confirmed) for r in got) == [
        ("4", "Apache-2.0", True), ("4", "Apache-2.0", True), ("5", "MIT", True), ("None", "Apache-2.0", True),
    ]
    found = [r for r in got if r.doc_id == 5][0]
    assert long[found.start : found.stop] == "Released under the MIT License"
    assert licenses.notices(df.limit(0)).collect() == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {(d.doc_id, name) for d in docs for text, name in KNOWN if text in (d.text or "")}
    got = registry.QUERIES["op7_licenses"](spark, sf_dir).collect()
    assert {(r.doc_id, r.license) for r in got if r.confirmed} == want
    texts = {d.doc_id: d.text for d in docs}
    for r in got:
        assert re.search(licenses.TRIGGER, texts[r.doc_id][r.start : r.stop])


def found_in(text):
    known = licenses.prepared(licenses.TEMPLATES)[1]
    spans = licenses.candidates(text, known)
    hits = [(a, h) for a, b in spans for h in licenses.verdicts(text[a:b], licenses.TEMPLATES)]
    return [(h[2], text[a + h[0] : a + h[1]]) for a, h in hits if h[-1]]


@pytest.mark.parametrize("one, first", KNOWN)
@pytest.mark.parametrize("other, second", KNOWN)
def test_neighbouring_notices_are_all_found(one, first, other, second):
    assert [h[0] for h in found_in(f"Code: {one} Docs: {other}")] == [first, second]
    assert [h[0] for h in found_in(f"{one}\n{other}\n{one}")] == [first, second, first]


def test_all_notices_of_a_header_are_found():
    texts = dict(licenses.TEMPLATES)
    names = ["Apache-2.0", "MIT", "GPL-3.0", "CC-BY-SA-4.0", "CC0-1.0"]
    assert [h[0] for h in found_in("\n".join(texts[n] for n in names))] == names
    assert found_in("Released under the MIT License. You need a driving license.") == [
        ("MIT", "Released under the MIT License")
    ]


@pytest.mark.parametrize("name, text", licenses.TEMPLATES)
@pytest.mark.parametrize("blank", ["\n", "\n * ", "  "])
def test_every_template_is_found_over_lines(name, text, blank):
    broken = text.replace(" ", blank)
    assert re.search(licenses.TRIGGER, broken)
    assert name in [h[0] for h in found_in(broken)]


def test_rows_of_neighbouring_notices(spark):
    text = "Code: Released under the MIT License. Docs: Licensed under CC BY 4.0."
    cc0 = licenses.TEMPLATES[-1][1].replace(" ", "\n")
    got = licenses.notices(spark.createDataFrame([(1, text), (2, cc0)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.license) for r in got if r.confirmed] == [(1, "MIT"), (1, "CC-BY-4.0"), (2, "CC0-1.0")]


@pytest.mark.parametrize("n", [1, 2, 69, 70, 79, 80, 81, 120, 500])
@pytest.mark.parametrize("kinds", [KNOWN[:1], KNOWN[:2], KNOWN])
def test_notices_in_a_row_are_all_found(n, kinds):
    row = [kinds[k % len(kinds)] for k in range(n)]
    got = found_in(" ".join(text for text, _ in row))
    assert [h[0] for h in got] == [name for _, name in row]


def test_long_notices_in_a_row_are_all_found():
    row = [licenses.TEMPLATES[k * 7 % len(licenses.TEMPLATES)] for k in range(100)]
    got = found_in("\n".join(text for _, text in row))
    assert [h[0] for h in got] == [name for name, _ in row]


def test_time_grows_with_the_text():
    def seconds(n):
        began = time.process_time()
        assert found_in("license " * n) == []
        return time.process_time() - began

    seconds(500)
    few, many = seconds(2_000), seconds(16_000)
    assert many < 16 * few
    text = "license " * 3_000 + KNOWN[1][0] + " license" * 3_000
    assert [h[0] for h in found_in(text)] == ["Apache-2.0"]
