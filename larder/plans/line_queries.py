"""Queries over ingredient lines, their SQL twins beside them.

Each operator gets the lines of the star-schema tables written in the way it is
there for. The twin states name, cups, grams and count from the columns.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import vocabulary as voc
from larder.functions.lines import standardize_ending
from larder.operators.normalize import convert, normalize
from larder.plans import views as v
from larder.plans.oracles import LINES

SPREAD = ["l_orderkey", "l_linenumber", "l_suppkey"]
Q = "l_quantity"  # a double in both engines

VOL = "CASE l_linenumber WHEN 1 THEN amount WHEN 2 THEN amount * (1.0::DOUBLE / 16) END"
WT = (
    "CASE l_linenumber WHEN 3 THEN amount * 28.34::DOUBLE WHEN 4 THEN amount WHEN 5 THEN amount * 3 "
    "WHEN 6 THEN amount * 453.59::DOUBLE END"
)
CNT = "CASE l_linenumber WHEN 7 THEN amount END"
NULL = "CAST(NULL AS DOUBLE)"


@dataclass(frozen=True)
class Variant:
    """How a line is written, and what it means (SQL over the columns of ``lp``)."""

    line: Callable[[], Column]
    name: str = "name"
    vol: str = VOL
    wt: str = WT
    cnt: str = CNT


def _t(template: str) -> Column:
    """``'{q} cups {nouns}'`` with columns for the names in braces."""
    columns = {
        "q": F.col(Q).cast("int").cast("string"),
        "q2": (F.col(Q) * 2).cast("int").cast("string"),
        "q3": (F.col(Q) * 3).cast("int").cast("string"),
        "qto": (F.col(Q) + 2).cast("int").cast("string"),
        "amount": F.col("amount_text"),
        "unit": F.coalesce("unit_text", F.lit("")),
        "units": F.when(F.col("unit") == "pinch", "pinches").otherwise(F.concat("unit", F.lit("s"))),
        "noun": F.col("noun"),
        "nouns": F.concat("name", F.lit("s")),
        "first": F.split("name", " ")[0],
    }
    out, rest = [], template
    while "{" in rest:
        plain, _, rest = rest.partition("{")
        key, _, rest = rest.partition("}")
        out += [F.lit(plain), columns[key]]
    return F.concat(*out, F.lit(rest))


def _by_order(*templates: str | Column) -> Column:
    """One of several templates, by order key."""
    out = F.when(F.lit(False), F.lit(""))
    for i, t in enumerate(templates):
        out = out.when(F.col("l_orderkey") % len(templates) == i, _t(t) if isinstance(t, str) else t)
    return out


def _case(*values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(values))
    return f"CASE l_orderkey % {len(values)} {whens} END"


def _spelled() -> Column:
    """Amounts in words as far as twelve."""
    words = F.array(*[F.lit(w.capitalize()) for w in list(voc.NUMBER_WORDS)[:12]])
    q = F.col(Q).cast("int")
    whole, rest = F.floor(q / 4).cast("int"), q % 4

    def word(n: Column) -> Column:
        return F.when((n >= 1) & (n <= 12), F.get(words, n - 1)).otherwise(n.cast("string"))

    mixed = (
        F.when(rest == 0, word(whole))
        .when((whole == 0) & (rest == 1), F.lit("One fourth"))
        .when((whole == 0) & (rest == 2), F.lit("One half"))
        .when(whole == 0, F.lit("Three fourths"))
        .when(rest == 1, F.concat(word(whole), F.lit(" and a fourth")))
        .when(rest == 2, F.concat(word(whole), F.lit(" and a half")))
        .otherwise(F.concat(word(whole), F.lit(" 3/4")))
    )
    text = F.when(F.col("l_linenumber") <= 2, mixed).when(q == 1, F.lit("A")).otherwise(word(q))
    return F.concat_ws(" ", text, "unit_text", "noun")


def _quarters(glyphs: bool) -> Column:
    q = F.col(Q).cast("int")
    whole, rest = F.floor(q / 4), q % 4
    head = F.when(whole > 0, whole.cast("string")).otherwise(F.lit(""))
    if glyphs:
        tail = F.get(F.array(*[F.lit(x) for x in ("", "¼", "½", "¾")]), rest)
    else:
        dash = F.when(whole > 0, F.lit("-")).otherwise(F.lit(""))
        tail = F.when(rest > 0, F.concat(dash, rest.cast("string"), F.lit("/4"))).otherwise(F.lit(""))
    text = F.when(F.col("l_linenumber") <= 2, F.concat(head, tail)).otherwise(F.col("amount_text"))
    return F.concat_ws(" ", text, "unit_text", "noun")


def _range_line() -> Column:
    bare = F.col("unit").isNull()
    plain = F.concat_ws(" ", _t("{q} to {qto}"), F.when(~bare, _t("{units}")), _t("{nouns}"))
    return F.when(bare, plain).otherwise(
        _by_order("{q} to {qto} {units} {nouns}", "{q} or {qto} {units} {nouns}",
                  "{q}-to {qto} {units} {nouns}", "{q} {units} to {qto} {units} {nouns}")
    )


_VOLUME_UNITS = [("ml", 0.0042268), ("L", 4.2268), (" tspn", None), (" table spoons", None), (" fluid oz", 0.125),
                 ("C", 1.0), (" pints", 2.0), (" qt", 4.0), (" gallons", 16.0)]
_VOLUME_SQL = {" tspn": "(1.0::DOUBLE / 48)", " table spoons": "(1.0::DOUBLE / 16)"}
_WEIGHT_UNITS = [("g.", 1.0), ("oz.", 28.34), (" lbs", 453.59), ("kg", 1000.0), (" kilo grams", 1000.0)]

LB = f"{Q} * 453.59::DOUBLE"
_PER_CUP = dict(vol=Q, wt=NULL, cnt=NULL)
_PER_COUNT = dict(vol=NULL, wt=NULL, cnt=Q)


def variants() -> dict[str, Variant]:
    ranged = {k: x.replace("amount", f"({Q} + 1)") for k, x in (("vol", VOL), ("wt", WT), ("cnt", CNT))}
    return {
        "i1_accents": Variant(lambda: F.concat_ws(" ", "amount_text", "unit_text", F.translate("noun", "eo", "éö"))),
        "i2_dimensions": Variant(lambda: _by_order('{amount} {unit} 3x1" {noun}', "{amount} {unit} 1/2-inch-thick {noun}")),
        "i4_percentages": Variant(lambda: _by_order("{amount} {unit} 2% {noun}", "{amount} {unit} 2-percent {noun}")),
        "i5_conjunctions": Variant(
            lambda: F.concat_ws(
                " ", "amount_text", "unit_text",
                F.replace("noun", F.lit(" "), F.get(F.array(F.lit("&"), F.lit(" n "), F.lit("-and-")), F.col("l_orderkey") % 3)),
            ),
            name="replace(name, ' ', ' and ')",
        ),
        "i6_spelled_numbers": Variant(_spelled),
        "i7_fraction_glyphs": Variant(lambda: _quarters(True)),
        "i8_mixed_numbers": Variant(lambda: _quarters(False)),
        "i9_ranges": Variant(_range_line, **ranged),
        "i10_volume_units": Variant(
            lambda: _by_order(*["{q}" + u + " of {nouns}" for u, _ in _VOLUME_UNITS]),
            vol=_case(*[f"{Q} * " + _VOLUME_SQL.get(u, f"{f}::DOUBLE") for u, f in _VOLUME_UNITS]), wt=NULL, cnt=NULL,
        ),
        "i11_weight_units": Variant(
            lambda: _by_order(*["{q}" + u + " {nouns}" for u, _ in _WEIGHT_UNITS]),
            vol=NULL, wt=_case(*[f"{Q} * {f}::DOUBLE" for _, f in _WEIGHT_UNITS]), cnt=NULL,
        ),
        "i12_vague_measures": Variant(
            lambda: _by_order("{q} pinches of {nouns}", "{q} generous drizzles of {nouns}", "{q} sticks of butter",
                              "{q} thick slices country {first} bread", "{q} large garlic cloves, peeled",
                              "{q} whole cloves", "{q} fresh sage leaves"),
            name=_case("name", "name", "'butter'", "split_part(name, ' ', 1) || ' bread'", "'garlic'", "'clove'", "'sage'"),
            vol=NULL, cnt=NULL,
            wt=_case(*[f"{Q} * {f}::DOUBLE" for f in (3, 3, 113.4, 30, 5, 0.5, 3)]),
        ),
        "i13_counts": Variant(lambda: _t("{q} {nouns}"), **_PER_COUNT),
        "i14_several_measures": Variant(
            lambda: _by_order("{q} cups {nouns} ({q2} kilos)", "{q} oz / {q3} g {nouns}", "{q} cups/{q}fl oz/300ml {nouns}"),
            vol=_case(Q, NULL, Q), wt=_case(f"{Q} * 2000", f"{Q} * 3", NULL), cnt=NULL,
        ),
        "i15_packages": Variant(
            lambda: _by_order("2 {q} gram cans of {nouns}", "{q} (100 gram) bags {nouns}", "1 1/2 ({q}g) cans {nouns}"),
            vol=NULL, wt=_case(f"{Q} * 2", f"{Q} * 100", f"{Q} * 1.5::DOUBLE"), cnt=NULL,
        ),
        "i16_each": Variant(
            lambda: _by_order("{q} bags {nouns}, about 100 grams each", "{q} sticks butter, each 5000 grams"),
            name=_case("name", "'butter'"), vol=NULL, wt=_case(f"{Q} * 100", f"{Q} * 113.4::DOUBLE"), cnt=_case(Q, NULL),
        ),
        "i17_plus": Variant(
            lambda: _by_order("{q} cups plus 2 tablespoons {nouns}", "{q} pounds plus 1/2 cup {nouns}",
                              "{q} egg whites plus 2 egg yolks"),
            name=_case("name", "name", "'egg'"),
            vol=_case(f"{Q} + 0.125::DOUBLE", "0.5::DOUBLE", NULL), wt=_case(NULL, LB, f"{Q} * 30 + 40"), cnt=NULL,
        ),
        "i18_secondary_count": Variant(lambda: _t("{q} lbs {nouns} (about 5 medium)"), vol=NULL, wt=LB, cnt=NULL),
        "i19_size_factors": Variant(
            lambda: _by_order("{q} firmly packed cups {nouns}", "{q} scant cups {nouns}", "{q} large {nouns}", "{q} very small {nouns}"),
            vol=_case(f"{Q} * 1.2::DOUBLE", f"{Q} * 0.9::DOUBLE", NULL, NULL), wt=NULL,
            cnt=_case(NULL, NULL, f"{Q} * 1.2::DOUBLE", f"{Q} * 0.8::DOUBLE"),
        ),
        "i20_containers": Variant(
            lambda: _by_order("{q} cans of {nouns}", "{q} bags {nouns}", "{q} jars {nouns}", "{q} packages of {nouns}"), **_PER_COUNT
        ),
        "i21_descriptors": Variant(
            lambda: _by_order("{q} cups finely chopped {nouns}", "{q} cups of melted softened {nouns}", "{q} cups grated {nouns}",
                              "{q} cups all-purpose {nouns}", "{q} cups lukewarm {nouns}"), **_PER_CUP
        ),
        "i22_compounds": Variant(
            lambda: _by_order("{q} cups low -fat, high-fiber, burrito-size {nouns}", "{q} cups ready-to-serve creamy {nouns}",
                              "{q} cups no-salt-added thick-cut {nouns}"), **_PER_CUP
        ),
        "i23_tail_phrases": Variant(
            lambda: _by_order("{q} cups {nouns} for frying, or as needed", "{q} cups {nouns} such as colemans",
                              "{q} cups {nouns} like colemans", "{q} cups {nouns} available at specialty stores"), **_PER_CUP
        ),
        "i24_brands": Variant(lambda: _by_order("{q} cups Crisco® {nouns}", "{q} cups Coleman's {nouns}"), **_PER_CUP),
        "i25_comma_clauses": Variant(
            lambda: _by_order("{q} cups peeled, cored, and thickly sliced {nouns}", "{q} cups {nouns}, seeded and diced",
                              "{q} cups sliced, ripe {nouns}"), **_PER_CUP
        ),
        "i26_meat_parts": Variant(
            lambda: _by_order("{q} lbs {first} chicken breasts", "{q} lbs {first} pork shoulder", "{q} lbs {first} turkey thighs"),
            name="split_part(name, ' ', 1) || ' ' || " + _case("'chicken'", "'pork'", "'turkey'"), vol=NULL, wt=LB, cnt=NULL,
        ),
        "i27_alternatives": Variant(
            lambda: _by_order("{q} cups golden or {nouns}", "{q} cups {nouns}, or 3 pounds silver tacks",
                              "{q} cups red, orange/yellow, or {nouns}", "{q} cups {nouns}, or to taste",
                              "{q} cups {nouns}, regular or spicy"),
            vol=Q, wt=_case(NULL, "3 * 453.59::DOUBLE", NULL, NULL, NULL), cnt=NULL,
        ),
        "i28_default_weights": Variant(lambda: F.col("line")),
        "i31_cleaned_names": Variant(lambda: F.concat_ws(
            " ", "amount_text", "unit_text", F.lit("Coleman's finely chopped"),
            F.concat("noun", F.lit(", peeled and diced, or to taste")))),
    }


RESULT = ["cleaned", "volume", "weight", "count"]


def _tally(df: DataFrame) -> DataFrame:
    return df.groupBy(*RESULT).agg(F.count(F.lit(1)).alias("n"))


def _written(s: SparkSession, d: str, line: Column) -> DataFrame:
    return v.line_parts(s, d).select(*SPREAD, F.trim(line).alias("line"))


def conversions(s: SparkSession, d: str) -> DataFrame:
    """(ingredient, per_cup, per_count): factors of each ingredient, from the part sizes."""
    return v.table(s, d, "part").groupBy(v.ingredient_name(F.col("p_name")).alias("ingredient")).agg(
        (F.min("p_size") + 100.0).alias("per_cup"), (F.max("p_size") + 50.0).alias("per_count")
    )


CONVERSIONS = """
conv AS (
  SELECT replace(replace(p_name, 'small', 'green'), 'large', 'amber') AS ingredient,
         min(p_size) + 100.0::DOUBLE AS per_cup, max(p_size) + 50.0::DOUBLE AS per_count
  FROM part GROUP BY 1)"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def run(variant: Variant):
        return lambda s, d: _tally(normalize(_written(s, d, variant.line()), SPREAD))

    def converted(s: SparkSession, d: str, line: Column) -> DataFrame:
        return _tally(convert(normalize(_written(s, d, line), SPREAD), conversions(s, d), SPREAD))

    def endings(s: SparkSession, d: str) -> DataFrame:
        """Plurals of four kinds, made from the part names."""
        word = F.split("p_name", " ")[1]
        kind = F.col("p_partkey") % 4
        stem = F.concat(word, F.get(F.array(*[F.lit(x) for x in ("", "tch", "r", "to")]), kind))
        plural = F.concat(stem, F.get(F.array(*[F.lit(x) for x in ("s", "es", "ies", "es")]), kind))
        return v.table(s, d, "part").select("p_partkey", standardize_ending(plural).alias("singular"))

    out = {k: run(x) for k, x in variants().items()}
    out["i3_singular_endings"] = endings
    out["i29_given_weight_stays"] = lambda s, d: converted(s, d, _t("{q} grams {nouns}"))
    out["i30_conversion_lookup"] = lambda s, d: converted(s, d, F.col("line"))
    return dict(sorted(out.items(), key=lambda kv: int(kv[0][1:].split("_")[0])))


def sql() -> dict[str, str]:
    def expected(x: Variant, per_cup: str = "180", per_count: str = "120", more: str = "", join: str = "") -> str:
        return f"""WITH {LINES}{more}, e AS (
            SELECT {x.name} AS cleaned, {x.vol} AS vol, {x.wt} AS wt, {x.cnt} AS cnt, name FROM lp)
          SELECT cleaned, round(vol, 4) AS volume, round(coalesce(wt, vol * {per_cup}, cnt * {per_count}), 4) AS weight,
                 round(cnt, 4) AS count, count(*) AS n
          FROM e {join} GROUP BY 1, 2, 3, 4"""

    out = {k: expected(x) for k, x in variants().items()}
    plain = Variant(lambda: F.col("line"))
    out["i3_singular_endings"] = """SELECT p_partkey, split_part(p_name, ' ', 2) ||
        CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'tch' WHEN 2 THEN 'ry' ELSE 'to' END AS singular FROM part"""
    out["i29_given_weight_stays"] = expected(Variant(plain.line, vol=NULL, wt=Q, cnt=NULL))
    out["i30_conversion_lookup"] = expected(
        plain, "coalesce(per_cup, 180)", "coalesce(per_count, 120)", "," + CONVERSIONS, "LEFT JOIN conv ON ingredient = name"
    )
    return out
