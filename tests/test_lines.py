import pytest
from golden import LINES
from pyspark.sql import functions as F

from larder.functions import lines as L
from larder.operators import normalize as N


def one(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(x[0],) for x in LINES], "line string").distinct()
    return {r.line: r for r in L.parse_lines(df).collect()}


@pytest.mark.parametrize("line,cleaned,volume,weight,count", LINES, ids=[x[0] for x in LINES])
def test_golden(parsed, line, cleaned, volume, weight, count):
    r = parsed[line]
    if cleaned is not None:
        assert r.cleaned == cleaned
    for want, got in ((volume, r.volume), (weight, r.weight), (count, r["count"])):
        if want is not None:
            assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize(
    "function,text,want",
    [
        (L.remove_accents, "jalapeño", "jalapeno"),
        (L.remove_dimensions, '1 3x1" strip of lemon peel', "1  strip of lemon peel"),
        (L.remove_dimensions, "8 1/2-inch-thick slices country white bread", "8   slices country white bread"),
        (L.remove_percentage, "3cups 2-percent milk", "3cups milk"),
        (L.remove_percentage, "3cups 2% milk", "3cups milk"),
        (L.standardize_characters, "mac n cheese", "mac and cheese"),
        (L.standardize_characters, "mac&cheese", "mac and cheese"),
        (L.standardize_characters, "mac-and-cheese", "mac and cheese"),
        (L.standardize_ending, "strawberries", "strawberry"),
        (L.standardize_ending, "leaves", "leaf"),
        (L.standardize_ending, "loaves", "loaf"),
        (L.standardize_ending, "olives", "olive"),
        (L.plain_form, "1,000 grams flour", "1000 grams flour"),
        (L.plain_form, "fifteen olives", "15 olives"),
        (L.plain_form, "1 dozen eggs", "12 eggs"),
        (L.plain_form, "two dozen eggs", "24 eggs"),
        (L.plain_form, "half a lemon", "1/2 lemon"),
        (L.standardize_ending, "cookies", "cookie"),
        (L.standardize_ending, "tomatoe", "tomato"),
        (L.standardize_ending, "peaches", "peach"),
        (L.standardize_ending, "octopuses", "octopus"),
        (L.standardize_ending, "molasses", "molass"),
        (L.standardize_ending, "swiss", "swiss"),
    ],
)
def test_cleaning(spark, function, text, want):
    assert one(spark, function(F.lit(text))) == want


def test_compound_numbers_and_counted_wholes(spark):
    want = {
        "twenty-one olives": ("olive", None, 2520.0, 21.0), "thirty five grams salt": ("salt", None, 35.0, None),
        "Ninety-nine leaves": ("leaf", None, 11880.0, 99.0), "1 cup half-and-half": ("half and half", 1.0, 180.0, None),
        "1/2 cup Half and Half": ("half and half", 0.5, 90.0, None), "2 large eggs plus 1 egg yolk": ("egg", None, 308.0, 2.4),
        "5 egg whites plus 2 egg yolks": ("egg", None, 190.0, None), "twenty 1 ounce packages": None,
    }
    rows = L.parse_lines(spark.createDataFrame([(x,) for x in want], "line string")).collect()
    got = {r.line: (r.cleaned, r.volume, r.weight, r["count"]) for r in rows}
    assert {k: v for k, v in got.items() if want[k]} == {k: v for k, v in want.items() if v}
    assert got["twenty 1 ounce packages"][2] == 566.8


def test_odd_lines_do_not_fail(spark):
    rows = ["", " ", None, "1/0 cups x", "(((", "or", "<1|2>", "½", "#", "plus", "each", "1", "a", ", , ,", "é®", "1 1 1 1 cup"]
    df = spark.createDataFrame([(r,) for r in rows], "line string")
    assert L.parse_lines(df).count() == len(rows)


def test_normalize_gives_every_row_its_line(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "1 cup milk").otherwise(
        F.concat((F.col("id") % 50 + 1).cast("string"), F.lit(" cups flour"))).alias("line"))
    got = {r.id: (r.cleaned, r.volume) for r in N.normalize(df, ["id"]).collect()}
    assert len(got) == 500
    for i, v in got.items():
        assert v == (("milk", 1.0) if i % 3 == 0 else ("flour", float(i % 50 + 1)))


def test_hot_lines_go_apart(spark, monkeypatch):
    """Hot lines are broadcast, others joined; a NULL line stays a row."""
    monkeypatch.setattr(N, "HOT_PARTS", 5)
    df = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "1 cup milk").when(F.col("id") % 100 == 1, None).otherwise(
        F.concat((F.col("id") % 70 + 1).cast("string"), F.lit(" cups flour"))).alias("line"))
    rows = N.normalize(df, ["id"]).collect()
    assert len(rows) == 900
    for r in rows:
        if r.id % 3 == 0:
            assert (r.cleaned, r.volume) == ("milk", 1.0)
        elif r.id % 100 == 1:
            assert r.line is None and r.cleaned is None
        else:
            assert (r.cleaned, r.volume) == ("flour", float(r.id % 70 + 1))


def test_conversion_lookup(spark):
    lines = spark.createDataFrame([(1, "2 cup onions"), (2, "2 onion"), (3, "200 grams onion"), (4, "2 cups leek")], "id long, line string")
    portions = spark.createDataFrame([("onion", "1 cup", 160.0), ("onion", "1 medium", 110.0)], "ingredient string, measure string, grams double")
    table = N.conversion_table(portions)
    assert [tuple(r) for r in table.collect()] == [("onion", 160.0, 110.0)]
    got = N.convert(N.normalize(lines, ["id"]), table, ["id"])
    assert {r.id: r.weight for r in got.collect()} == {1: 320.0, 2: 220.0, 3: 200.0, 4: 360.0}
