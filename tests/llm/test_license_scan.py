import random

import duckdb
import pytest

from martforge.llm import license_scan as L

from .conftest import rows_of, words


def with_licenses(rng):
    rows = []
    for i, (name, text) in enumerate(sorted(L.TEMPLATES.items()) * 3):
        inside = text.split()
        if i % 3 == 1 and len(inside) > 12:
            inside[len(inside) // 2] = "changed"  # five shingles fewer
        if i % 3 == 2:
            inside = [w.upper().strip(".") for w in inside]
        around = words(rng, rng.randrange(0, 90)), words(rng, rng.randrange(0, 90))
        rows.append((i, " ".join(around[0] + inside + around[1])))
    long_text = " ".join(words(rng, 20000) + L.TEMPLATES["MIT notice"].split() + words(rng, 10))
    return rows + [(100, None), (101, ""), (102, "Released under the MIT"), (103, "one two"), (104, long_text),
                   (105, "Released under the MIT License. " * 3), (106, "x " * 300), (None, L.TEMPLATES["MIT notice"]),
                   (107, L.TEMPLATES["GPL-3.0 notice"]), (107, L.TEMPLATES["GPL-3.0 notice"])]


def test_matches_are_those_of_all_windows(spark):
    rows = with_licenses(random.Random(8))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    expect = sorted(con.execute(L.oracle_sql()).fetchall(), key=repr)
    assert len(expect) > 25
    columns = ["doc_id", "license", "n_windows", "start_word", "shared", "containment"]
    assert rows_of(L.scan(table), *columns) == expect
    clash = table.selectExpr("*", "'x' as words", "1 as window", "2 as band", "'y' as license")
    assert rows_of(L.scan(clash), *columns) == expect


def test_bands_follow_from_the_least_similar_match():
    for c in L.window_classes(L.TEMPLATES):
        for name in c.names:
            n = len(L.re.findall(L.WORD, L.TEMPLATES[name].lower())) - 4
            held = L.needed(n + 4)
            alike = held / (c.shingles + n - held)
            assert (1 - alike) ** c.bands <= L.MISS or alike >= 1
            assert c.shingles >= n + c.stride - 1  # a copy at any place lies in a window whole


def test_short_templates_are_refused_and_empty_table(empty):
    with pytest.raises(ValueError):
        L.window_classes({"short": "too few words"})
    assert L.scan(empty).collect() == []
