"""Header matching against brute force."""

import random

import pytest

import time

from pyspark.sql import functions as F

from rowharbor.functions.names import INFINITE
from rowharbor.functions.names import field_name_distance as distance_column
from rowharbor.operators.match import match_columns, score_columns


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, above[j] + 1, above[j - 1] + (x != y)))
    return row[-1]


def word(c):
    return c.isalpha() or c.isdecimal()


def weighted(source, target, substitution, deletion, insertion):
    if source == target:
        return 0.0
    if not source or not target:
        return float(len(source) or len(target))
    above = [j * insertion for j in range(len(target) + 1)]
    for a in source:
        row = [above[0] + deletion(a)]
        for j, b in enumerate(target):
            change = 0.0 if a == b else substitution(a, b)
            row.append(min(row[j] + insertion, above[j + 1] + deletion(a), above[j] + change))
        above = row
    return above[-1]


def field_name_distance(header, field):
    lost = weighted(field, header, lambda a, b: 0.0 if a == "_" and not word(b) else 1.0, lambda c: 1.0, 0.0)
    if lost >= len(field) * 0.25:
        return INFINITE
    return weighted(
        header, field, lambda a, b: 0.1 if (b == "_" and not word(a)) or (a.isupper() and b.islower()) else 1.0,
        lambda c: 1.0 if word(c) or c == "_" else 0.1, 1.0)


def distances(spark, pairs):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, h string, f string")
    got = rows.select("i", distance_column(F.col("h"), F.col("f")).alias("d")).orderBy("i").collect()
    return [r["d"] for r in got]


def badness(header, field, display):
    distance = plain_distance(header, display)
    by_display = distance if distance < max(len(header), len(display)) * 0.25 else INFINITE
    return min(float(by_display), field_name_distance(header, field))


@pytest.mark.parametrize("header,field,cost", [
    ("Another Name", "another_name", 0.3), ("ID", "id", INFINITE), ("Date", "date", INFINITE),
    ("o_orderkey (PK)", "o_orderkey", 2.3), ("TOTALPRICE", "totalprice", INFINITE),
    ("same", "same", 0.0), ("", "x", INFINITE),
])
def test_worked_distances(spark, header, field, cost):
    assert field_name_distance(header, field) == pytest.approx(cost)
    assert distances(spark, [(header, field)]) == [pytest.approx(cost)]


def test_random_distances_against_the_plain_table(spark):
    rng = random.Random(11)
    pairs = []
    for _ in range(600):
        field = "".join(rng.choices("abcdeß_1é", k=rng.choice([0, 3, 9, 20, 70])))
        header = "".join(rng.choice([c, c, c, c, c, c.upper(), c.replace("_", " "), "", c + rng.choice("x! _é")]) for c in field)
        pairs.append((header, field))
    got = distances(spark, pairs)
    assert sum(d < INFINITE for d in got) > 100
    assert got == [pytest.approx(field_name_distance(h, f)) for h, f in pairs]


def greedy(headers, columns):
    """Best pair first, over and over."""
    pairs = sorted(
        (badness(h, f, d), hp, cp, f)
        for hp, h in headers for cp, f, d in columns
        if badness(h, f, d) < INFINITE
    )
    used_h, used_c, out = set(), set(), {}
    for b, hp, cp, f in pairs:
        if hp not in used_h and cp not in used_c:
            used_h.add(hp)
            used_c.add(cp)
            out[hp] = (f, round(b, 6))
    return out


def test_random_files_against_brute_force(spark):
    rng = random.Random(7)
    words = ["first name", "first names", "last name", "Last_Name", "zip", "zip code", "Zip-Code",
             "date", "dates", "total price", "total_prices", "city", "City name", "id number"]
    headers, columns = [], []
    for dataset in range(4):
        named = rng.sample(words, 9)
        columns += [(dataset, i, w.lower().replace(" ", "_").replace("-", "_") + "_" * (i % 2), w)
                    for i, w in enumerate(named)]
    for file in range(12):
        cells = [rng.choice(words) + rng.choice(["", "!", " 2", "s"]) for _ in range(8)]
        headers += [(file, file % 4, i, c) for i, c in enumerate(cells)]
    h = spark.createDataFrame(headers, "file_id int, dataset_id int, pos int, name string")
    c = spark.createDataFrame(columns, "dataset_id int, pos int, field_name string, display_name string")
    got = {}
    for r in match_columns(h, c).collect():
        if r.field_name is not None:
            got.setdefault(r.file_id, {})[r.header_pos] = (r.field_name, round(r.badness, 6))
    for file in range(12):
        mine = [(p, n) for f, d, p, n in headers if f == file]
        theirs = [(p, f, n) for d, p, f, n in columns if d == file % 4]
        assert got.get(file, {}) == greedy(mine, theirs)
    assert match_columns(h, c).count() == len(headers)
    scored = score_columns(h, c).filter("badness = double('infinity')").count()
    assert scored == 0


def test_nothing_matches(spark):
    h = spark.createDataFrame([(1, 1, 0, "abc")], "file_id int, dataset_id int, pos int, name string")
    c = spark.createDataFrame([(1, 0, "xyz", "Xyz")],
                              "dataset_id int, pos int, field_name string, display_name string")
    assert [r.field_name for r in match_columns(h, c).collect()] == [None]


def test_equal_headers_take_columns_in_order(spark):
    width = 40
    h = spark.createDataFrame([(1, 1, i, "value") for i in range(width)],
                              "file_id int, dataset_id int, pos int, name string")
    c = spark.createDataFrame([(1, i, "value", "Value") for i in range(width)],
                              "dataset_id int, pos int, field_name string, display_name string")
    got = match_columns(h, c).collect()
    assert len(got) == width and all(r.field_name == "value" for r in got)
    assert match_columns(h, c.limit(3)).filter("field_name IS NOT NULL").count() == 3


def test_wide_files_of_equal_headers_take_seconds(spark):
    width = 200
    h = spark.createDataFrame([(1, 1, i, "Total value") for i in range(width)], "file_id int, dataset_id int, pos int, name string")
    c = spark.createDataFrame([(1, i, "total_value", "Total Value") for i in range(width)],
                              "dataset_id int, pos int, field_name string, display_name string")
    got = match_columns(h, c)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    start = time.time()
    rows = got.collect()
    assert len({r.header_pos for r in rows if r.field_name}) == width and time.time() - start < 60
