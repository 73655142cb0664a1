"""Ingredient lines to amounts and names, as column expressions.

A line is brought to a plain form (lower case, single blanks, digits), one
pattern finds its measures, arrays of measures are reduced to volume, weight
and count, and what is left of the text becomes the name.
"""

from __future__ import annotations

import unicodedata
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import vocabulary as voc
from larder.functions.text import col, let


def _accent_table() -> tuple[str, str]:
    """Latin letters with marks, and the letters under the marks."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x180)]
    pairs = [(a, b) for a, b in pairs if a != b]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_MARKED, _PLAIN = _accent_table()

# --- text cleaning ---------------------------------------------------------------

_SIZE = r"\d+/\d+|\d+(?:\.\d+)?"
_CROSSED = rf"(?:{_SIZE})(?:\s*x\s*(?:{_SIZE}))+(?:\s?\"|[\s-]?inch(?:es)?\b|-?in\b|\s?cm\b)?"
_LENGTH = (
    rf"(?:{_SIZE})(?:\s?\"|[\s-]?inch(?:es)?\b|-?in\b|\s?cm\b|-foot\b|-feet\b)"
    r"(?:[\s-]+(?:thick|long|wide|diameter|square|round|high)\b)?"
)


def remove_accents(c: Column | str) -> Column:
    return F.translate(col(c), _MARKED, _PLAIN)


def remove_dimensions(c: Column | str) -> Column:
    """Drop ``3x1"`` and ``1/2-inch-thick``."""
    return F.regexp_replace(F.regexp_replace(col(c), _CROSSED, ""), _LENGTH, " ")


def remove_percentage(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"\s*\b\d+(?:\.\d+)?(?:\s?%|[\s-]*percent\b)", "")


def standardize_characters(c: Column | str) -> Column:
    """``&``, ``-and-`` and a lone ``n`` become ``and``."""
    return F.regexp_replace(col(c), r"\s*&\s*|-and-| n ", " and ")


def standardize_ending(word: Column | str) -> Column:
    """Singular of one lower-case word."""
    w = col(word)
    n = F.length(w)
    exceptions = F.when(F.lit(False), w)
    for plural, singular in voc.ES_EXCEPTIONS.items():
        exceptions = exceptions.when(w == plural, F.lit(singular))
    return (
        exceptions.when(w.rlike(r"..ies$"), F.concat(F.substring(w, F.lit(1), n - 3), F.lit("y")))
        .when(w.rlike(r"(?:ea|oa|al|el)ves$"), F.concat(F.substring(w, F.lit(1), n - 3), F.lit("f")))
        .when(w.rlike(r".oes$"), F.substring(w, F.lit(1), n - 2))
        .when(w.rlike(r"(?:ch|sh|s|x|z)es$"), F.substring(w, F.lit(1), n - 2))
        .when(w.rlike(r".oe$"), F.substring(w, F.lit(1), n - 1))
        .when(w.rlike(r"[^su]s$"), F.substring(w, F.lit(1), n - 1))
        .otherwise(w)
    )


def fraction_glyphs(c: Column | str) -> Column:
    """``½`` becomes `` 1/2``."""
    out = F.replace(col(c), F.lit("⁄"), F.lit("/"))
    for glyph, plain in voc.FRACTION_GLYPHS.items():
        out = F.replace(out, F.lit(glyph), F.lit(" " + plain))
    return F.when(col(c).rlike("[½⅓⅔¼¾⅕-⅞⁄]"), out).otherwise(col(c))


def _words_of(d: dict[str, str]) -> str:
    return "|".join(sorted(d, key=len, reverse=True))


def spelled_numbers(c: Column | str) -> Column:
    """Number and fraction words of a plain-form line to digits; a leading ``a`` is 1."""
    # the cream of that name holds no number, and twenty-one is one
    t = F.regexp_replace(col(c), r"\bhalf[- ]and[- ]half\b", voc.HALF_AND_HALF)
    t = F.regexp_replace(t, rf"\b({'|'.join(voc.TENS)})[- ](?=(?:{'|'.join(voc.ONES)})\b)", "$1_ ")
    t = F.regexp_replace(t, r"\bhalf-(?=[a-z])", "half ")
    tens = {f"{w}_": f"{voc.NUMBER_WORDS[w][0]}_" for w in voc.TENS}
    words = F.expr(_map_sql({**voc.NUMBER_WORDS, **voc.FRACTION_WORDS, **tens}))
    t = F.array_join(F.transform(F.split(t, " "), lambda w: F.coalesce(F.element_at(words, w), w)), " ")
    t = F.regexp_replace(t, r"\b(\d)_ (\d)\b", "$1$2")
    t = F.regexp_replace(t, r"\b(\d+) and (?:an? |1 )?/(\d)\b", "$1 1/$2")
    t = F.regexp_replace(t, r"\b(\d+) /(\d)\b", "$1/$2")
    t = F.regexp_replace(t, r"^(?:an? )?/(\d)\b", "1/$1")
    t = F.regexp_replace(t, r"^1/(\d) an? ", "1/$1 ")
    for n in range(1, 13):  # dozens
        t = F.regexp_replace(t, rf"(?:\b{n} |^an? )dozen\b" if n == 1 else rf"\b{n} dozen\b", str(12 * n))
    t = F.replace(F.replace(t, F.lit(" /2"), F.lit(" half")), F.lit(" /4"), F.lit(" quarter"))
    has_words = rf"^an? |\bdozen\b|\b(?:{_words_of(voc.NUMBER_WORDS)}|{_words_of(voc.FRACTION_WORDS)})\b"
    t = F.regexp_replace(F.regexp_replace(t, r"^an? (?=\d)", ""), r"^an? ", "1 ")
    return F.when(col(c).rlike(has_words), t).otherwise(col(c))


def remove_brands(c: Column | str) -> Column:
    """Drop words with a trademark sign and possessives."""
    return F.regexp_replace(col(c), r"\S+®|\b[a-zA-Z]+['’]s\b", "")


def plain_text(line: Column | str) -> Column:
    """Lower case, digits apart from letters, punctuation as words, single blanks."""
    t = F.lower(remove_accents(fraction_glyphs(line)))
    t = F.regexp_replace(t, r"[<>|#§]", " ")
    t = F.regexp_replace(t, r"(?<=\d),(?=\d{3}(?!\d))", "")  # thousands
    t = remove_brands(standardize_characters(remove_dimensions(remove_percentage(t))))
    # 3-1/2 and 15.1/2 are mixed numbers; 5-pound and 3cups are two words; 'low -fat' is one
    t = F.regexp_replace(t, r"(?<=\d)(?:[-.](?=\d+/\d)|-(?=[a-z]))", " ")
    t = F.regexp_replace(t, r"(?<=\d)(?=[a-z])", " ")
    t = F.regexp_replace(t, r"\b(\d+)\s*[-–]\s*(?=\d)", "$1 to ")
    t = F.regexp_replace(t, r"\s-(?=[a-z])", "-")
    t = F.regexp_replace(t, r"(?<!\d)\.(?=\d)", "0.")
    t = F.regexp_replace(t, r"\.(?!\d)", " ")
    t = F.regexp_replace(t, r"[;:]", ",")
    t = F.regexp_replace(t, r"([(),])|(?<!\d)/|/(?!\d)", " $0 ")
    return F.trim(F.regexp_replace(t, r"[\s\p{Z}]+", " "))


def plain_form(line: Column | str) -> Column:
    """:func:`plain_text` with numbers in digits."""
    return let(plain_text(line), spelled_numbers)


# --- measures ----------------------------------------------------------------------

_Q = r"(?:\d+ \d+/\d+|\d+/\d+|\d+(?:\.\d+)?)(?![\d/.])"
_MULTIPLIER = r"(?:\d+ \d+/\d+|\d+/\d+|\d+(?:\.\d+)?(?! \d+/\d))"


def _unit_pattern() -> str:
    names = sorted({*voc.CUPS, *voc.GRAMS}, key=len, reverse=True)
    long = [n + ("(?:es)?" if n.endswith("ch") else "s?") for n in names if len(n) > 1]
    return "(?:" + "|".join(long + [n for n in names if len(n) == 1]) + r")\b"


_UNIT = _unit_pattern()
# groups: 1 plus/each, 2 multiplier, 3 low, 4 unit, 5 high, 6 unit, 7 high, 8 high, 9 unit, 10 each
_MEASURE = (
    rf"(?:\b(plus|each) (?:about )?)?(?<![\d/.])(?:({_MULTIPLIER}) (?:\( (?:about )?)?)?({_Q})"
    rf"(?: ({_UNIT})(?: to ({_Q})(?: ({_UNIT}))?| or ({_Q})(?! (?:{_UNIT}|\d|\()))?"
    rf"| (?:to|or) ({_Q}) ({_UNIT}))(?: (each)\b)?"
)
_MARK = r"<[^>]*>"
_LEADING_COUNT = rf"^({_Q})(?: (?:to|or) ({_Q}))?(?= |$)"

# An item named together with its unit: (guard, pattern, replacement).
_ITEMS = [
    ("garlic", r"(?<=\d )(?:[a-z]+ )?garlic cloves?\b", "garlicclove garlic"),
    ("garlic", r"(?<=\d )cloves?(?: of)? garlic\b", "garlicclove garlic"),
    ("clove", r"(?<=\d )whole cloves?\b", "spiceclove clove"),
    ("sage", r"(?<=\d )(?:fresh )?sage lea(?:f|ves)\b", "sageleaf sage"),
    ("egg", r"(?<=\d )egg (white|yolk)s?\b", "egg$1 egg"),
    ("butter|margarine", r"(?<=\d )sticks?\b", "butterstick"),
    ("bread", r"(?<=\d )(?:(?:thick|thin|thickly|thinly|whole|fresh) )*slices?\b", "breadslice"),
]
# 'one half-pound piece', not one and a half pounds (weights of pieces only)
_PIECE = r"^(\d+) (\d+/\d+) (lb|pound)\b(?=.*\b(?:breast|thigh|fillet|filet|steak|chop|drumstick)s?\b)"


def size_factor(plain: Column) -> Column:
    """Product of the size and packing words of a plain-form line."""
    size = rf"^{_Q}(?: (?:to|or) {_Q})? "
    return (
        F.when(plain.rlike(r"\bfirmly packed\b"), voc.FIRMLY_PACKED).otherwise(1.0)
        * F.when(plain.rlike(r"\bscant\b"), voc.SCANT).otherwise(1.0)
        * F.when(plain.rlike(size + r"(?:extra |very )?large\b"), voc.LARGE)
        .when(plain.rlike(size + r"very small\b"), voc.VERY_SMALL)
        .otherwise(1.0)
    )


def mark_measures(plain: Column) -> Column:
    """Plain form with each measure as ``<plus|times|low|unit|high|unit|each>``."""
    t = F.regexp_replace(plain, r"(?<![-\w])(?:" + "|".join(voc.SIZE_WORDS) + r")(?![-\w]) ?", "")
    t = F.regexp_replace(t, r"^(?=(?:pinch|drizzle)\b)", "1 ")
    guards = "|".join(sorted({g for g, _, _ in _ITEMS}))
    t = let(t, lambda x: F.when(x.rlike(guards), _replaced_items(x)).otherwise(x))
    t = F.regexp_replace(t, _PIECE, "$1 ( $2 $3 )")
    return F.regexp_replace(t, _MEASURE, "<$1|$2|$3|$4|$5$7$8|$6$9|$10>")


def _replaced_items(t: Column) -> Column:
    out = t
    for guard, pattern, new in _ITEMS:
        # a pattern that spells its guard needs no test of its own
        if guard in pattern:
            out = F.regexp_replace(out, pattern, new)
        else:
            out = F.regexp_replace(out, rf"^(?=.*(?:{guard}))(.*?){pattern}", f"$1{new}")
    return out


# The expressions from here to the names are SQL text: most of their steps sit
# inside lambdas, and one call builds what would take hundreds of column calls.


def _number(q: str) -> str:
    """``'2 1/2'`` -> 2.5; empty -> NULL."""
    return (
        f"CASE WHEN {q} <> '' THEN aggregate(split({q}, ' '), 0D, (a, x) -> a + "
        "CASE WHEN contains(x, '/') THEN try_divide(double(split(x, '/')[0]), double(split(x, '/')[1])) "
        "ELSE double(x) END) END"
    )


def _bound(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _map_sql(d: dict[str, str] | dict[str, float]) -> str:
    def value(v: str | float) -> str:
        return f"'{v}'" if isinstance(v, str) else f"{v!r}D"

    return "map(" + ", ".join(f"'{k}', {value(v)}" for k, v in d.items()) + ")"


def _factors(table: dict[str, float]) -> str:
    forms = {}
    for n, f in table.items():
        forms[n] = f
        if len(n) > 1:
            forms[n + ("es" if n.endswith("ch") else "s")] = f
    return _map_sql(forms)


def measures(marked: str) -> Column:
    """Measures of a marked line (column name): ARRAY<STRUCT<plus, each, preferred, cups, grams>>."""
    low_unit, high_unit = "coalesce(nullif(p[3], ''), p[5])", "coalesce(nullif(p[5], ''), p[3])"

    def amount(table: dict[str, float]) -> str:
        low = f"{_number('p[2]')} * element_at({_factors(table)}, {low_unit})"
        high = f"{_number('p[4]')} * element_at({_factors(table)}, {high_unit})"
        return (
            f"CASE WHEN p[4] = '' THEN {low} ELSE ({low} + {high}) / 2 END * coalesce({_number('p[1]')}, 1D)"
        )

    preferred = ", ".join(f"'{u}', '{u}s'" for u in voc.PREFERRED_UNITS)
    fields = (
        "named_struct('plus', p[0] = 'plus', 'each', p[0] = 'each' OR p[6] = 'each', "
        f"'preferred', array_contains(array({preferred}), {low_unit}), "
        f"'cups', {amount(voc.CUPS)}, 'grams', {amount(voc.GRAMS)})"
    )
    return F.expr(
        f"transform(regexp_extract_all({marked}, '<([^>]*)>', 1), m -> {_bound("split(m, '[|]')", 'p', fields)})"
    )


def _pick(ms: str, field: str, each: bool = False) -> str:
    """The preferred measure of a dimension (else the first), plus what is added to it."""
    mine = f"filter({ms}, m -> m.{field} IS NOT NULL AND m.each = {each})"
    main = (
        "array_min(transform(filter(own, m -> NOT m.plus), "
        f"(m, i) -> named_struct('later', NOT m.preferred, 'at', i, 'value', m.{field}))).value"
    )
    added = f"aggregate(filter(own, m -> m.plus), 0D, (a, m) -> a + m.{field})"
    return _bound(mine, "own", f"CASE WHEN size(own) > 0 THEN coalesce({main}, 0D) + {added} END")


def leading_count(marked: str) -> Column:
    """Number at the start of a marked line that no measure has taken."""
    pattern = _LEADING_COUNT.replace("\\", "\\\\")
    low, high = (f"regexp_extract({marked}, '{pattern}', {i})" for i in (1, 2))
    mean = f"CASE WHEN e[1] = '' THEN {_number('e[0]')} ELSE ({_number('e[0]')} + {_number('e[1]')}) / 2 END"
    return F.expr(_bound(f"array({low}, {high})", "e", mean))


# --- names ---------------------------------------------------------------------------


def drop_compounds(c: Column) -> Column:
    """Drop hyphenated modifiers."""
    return F.regexp_replace(c, r"[^ ,]*[a-z]-[^ ,]*", " ")


def cut_tails(c: Column) -> Column:
    """Drop ``or to taste`` and everything from a cue word to the end of its clause."""
    t = F.regexp_replace(c, r"\bor (?:to taste|as needed)\b", " ")
    return F.regexp_replace(t, r"(?<= )(?:" + "|".join(voc.TAIL_CUES) + r")\b[^,]*", " ")


_DROPPED = r"(?<![^ ])(?:" + "|".join(sorted({*voc.DESCRIPTORS, *voc.CONTAINERS}, key=len, reverse=True)) + r")(?![^ ])"
_FILLER_CLAUSE = r"(?:^|(?<=,))[ #/]*(?:(?:" + "|".join(voc.CONNECTORS) + r")[ #/]+)*[ #/]*(?:,|$)"


def choose_alternative(c: Column) -> Column:
    """One side of the first ``or``, judged by commas and numbers around it."""
    parts = F.split(c, " or ", 2)

    def judge(p: Column) -> Column:
        left, right = p[0], p[1]
        bare = r"^[ ,#/]*$"
        commas = F.length(left) - F.length(F.replace(left, F.lit(","), F.lit("")))
        last = F.regexp_replace(right, r"^.* or ", " ")
        return (
            F.when(F.size(p) < 2, left)
            .when(left.rlike(bare), right)
            .when(right.rlike(bare), left)
            .when(right.rlike(r"^ *[#\d]"), left)
            .when((commas >= 2) | (commas == 0), last)
            .otherwise(left)
        )

    return let(parts, judge)


def clean_name(marked: Column) -> Column:
    """Name of the ingredient: what remains of the marked text."""
    t = F.regexp_replace(marked, _MARK, " # ")
    t = F.regexp_replace(t, r"\([^)]*\)|[()]", " ")
    t = F.regexp_replace(F.trim(t), _LEADING_COUNT, "#")
    t = cut_tails(drop_compounds(t))
    t = F.regexp_replace(t, _DROPPED, " ")
    # clauses without a word of their own go, with their comma
    t = F.regexp_replace(t, _FILLER_CLAUSE, " ")
    t = choose_alternative(F.concat(F.lit(" "), F.regexp_replace(t, " +", " "), F.lit(" ")))
    parts = "|".join(voc.MEAT_PARTS)
    t = let(
        t,
        lambda x: F.when(
            x.rlike(r"\b(?:" + "|".join(voc.MEATS) + r")s?\b"), F.regexp_replace(x, rf"\b(?:{parts})\b", " ")
        ).otherwise(x),
    )
    links = "|".join(voc.CONNECTORS)
    # the first clause that holds a word, without connectors at its ends
    t = F.regexp_extract(t, rf"^(?:[ ,#/]|(?:{links})\b)*([^,#/]*)", 1)
    t = F.trim(F.regexp_replace(F.regexp_replace(t, rf"(?: (?:{links}))+ *$", ""), " +", " "))
    t = F.array_join(F.transform(F.split(t, " "), standardize_ending), " ")
    return F.replace(t, F.lit(voc.HALF_AND_HALF), F.lit("half and half"))


# --- whole lines ----------------------------------------------------------------------


def parse_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Add ``cleaned``, ``volume`` (cups), ``weight`` (grams) and ``count`` to each row.

    Weights come from the line itself, else from volume and count by the average
    factors. ``measured_weight`` is the weight before that fallback;
    ``exact_volume`` and ``exact_count`` are the values before rounding.
    """
    steps = (
        df.withColumn("_text", plain_text(line))
        .withColumn("_plain", spelled_numbers("_text"))
        .withColumn("_marked", mark_measures(F.col("_plain")))
        .withColumns({
            "_ms": measures("_marked"), "_factor": size_factor(F.col("_plain")), "_count": leading_count("_marked"),
        })
        .withColumns({
            "exact_volume": F.expr(_pick("_ms", "cups")) * F.col("_factor"),
            "exact_count": F.col("_count") * F.col("_factor"),
            "measured_weight": F.expr(
                f"coalesce({_pick('_ms', 'grams')}, {_pick('_ms', 'grams', each=True)} * coalesce(_count, 1D))"
            ),
        })
    )
    # '2 eggs plus 1 egg yolk': what is counted is not in the weight that is added to it
    counted_apart = F.col("_marked").rlike(rf"^{_Q}[^<]*<plus")
    fallback = F.coalesce(
        F.when(counted_apart, F.col("measured_weight") + F.col("exact_count") * voc.GRAMS_PER_COUNT),
        F.col("measured_weight"),
        F.col("exact_volume") * voc.GRAMS_PER_CUP,
        F.col("exact_count") * voc.GRAMS_PER_COUNT,
    )
    return steps.select(
        *df.columns,
        clean_name(F.col("_marked")).alias("cleaned"),
        F.round("exact_volume", 4).alias("volume"),
        F.round(fallback, 4).alias("weight"),
        F.round("exact_count", 4).alias("count"),
        F.round("measured_weight", 4).alias("measured_weight"),
        "exact_volume",
        "exact_count",
    )
