"""Words and factors of ingredient lines. All fixed values; plain lists, no rules."""

from __future__ import annotations

# Cups per unit.
CUPS = {
    "ml": 0.0042268, "milliliter": 0.0042268, "millilitre": 0.0042268,
    "l": 4.2268, "liter": 4.2268, "litre": 4.2268,
    "tsp": 1 / 48, "tspn": 1 / 48, "teaspoon": 1 / 48, "tea spoon": 1 / 48,
    "tbsp": 1 / 16, "tbs": 1 / 16, "tablespoon": 1 / 16, "table spoon": 1 / 16, "spoonful": 1 / 16,
    "fl oz": 1 / 8, "fluid oz": 1 / 8, "fluid ounce": 1 / 8,
    "c": 1.0, "cup": 1.0,
    "pt": 2.0, "pint": 2.0,
    "qt": 4.0, "quart": 4.0,
    "gal": 16.0, "gallon": 16.0,
}

# Grams per unit. The joined words stand for an item together with its name.
GRAMS = {
    "g": 1.0, "gram": 1.0,
    "oz": 28.34, "ounce": 28.34,
    "lb": 453.59, "pound": 453.59,
    "kg": 1000.0, "kilo": 1000.0, "kilogram": 1000.0, "kilo gram": 1000.0,
    "pinch": 3.0, "drizzle": 3.0,
    "butterstick": 113.4, "breadslice": 30.0, "garlicclove": 5.0, "spiceclove": 0.5, "sageleaf": 3.0,
    "eggwhite": 30.0, "eggyolk": 20.0,
}

# Where a line gives several measures, these come first.
PREFERRED_UNITS = ["c", "cup", "g", "gram", "kg", "kilo", "kilogram", "kilo gram"]

# Grams where a line has no weight.
GRAMS_PER_CUP = 180.0
GRAMS_PER_COUNT = 120.0

# Factors on volume and count.
FIRMLY_PACKED, SCANT, LARGE, VERY_SMALL = 1.2, 0.9, 1.2, 0.8

NUMBER_WORDS = {
    "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7",
    "eight": "8", "nine": "9", "ten": "10", "eleven": "11", "twelve": "12", "few": "3",
    "thirteen": "13", "fourteen": "14", "fifteen": "15", "sixteen": "16", "seventeen": "17", "eighteen": "18",
    "nineteen": "19", "twenty": "20", "thirty": "30", "forty": "40", "fifty": "50", "sixty": "60", "seventy": "70",
    "eighty": "80", "ninety": "90", "hundred": "100",
}
TENS = ("twenty", "thirty", "forty", "fifty", "sixty", "seventy", "eighty", "ninety")
ONES = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine")
# Half-and-half while a line is read: no number, no conjunction.
HALF_AND_HALF = "halfandhalf"
FRACTION_WORDS = {
    "half": "/2", "halves": "/2", "third": "/3", "thirds": "/3", "fourth": "/4", "fourths": "/4",
    "quarter": "/4", "quarters": "/4", "fifth": "/5", "fifths": "/5", "sixth": "/6", "sixths": "/6",
    "eighth": "/8", "eighths": "/8",
}
FRACTION_GLYPHS = {
    "½": "1/2", "⅓": "1/3", "⅔": "2/3", "¼": "1/4", "¾": "3/4", "⅕": "1/5", "⅖": "2/5", "⅗": "3/5",
    "⅘": "4/5", "⅙": "1/6", "⅚": "5/6", "⅛": "1/8", "⅜": "3/8", "⅝": "5/8", "⅞": "7/8",
}

# Between a number and its unit, or before a name: say how much of a unit, never what.
SIZE_WORDS = [
    "firmly packed", "lightly packed", "packed", "scant", "heaping", "heaped", "rounded", "generous",
    "very", "extra", "large", "medium", "small", "big",
]

CONTAINERS = [
    "bag", "bags", "bottle", "bottles", "box", "boxes", "bunch", "bunches", "can", "cans", "carton", "cartons",
    "container", "containers", "envelope", "envelopes", "head", "heads", "jar", "jars", "package", "packages",
    "packet", "packets", "piece", "pieces", "slice", "slices", "sprig", "sprigs", "stalk", "stalks", "stick",
    "sticks", "strip", "strips", "tin", "tins", "tub", "tubs", "box", "handful", "handfuls", "dash", "dashes",
]

DESCRIPTORS = [
    "about", "approximately", "baked", "boiled", "boned", "boneless", "bottled", "canned", "chilled", "chopped",
    "coarse", "coarsely", "cooked", "cored", "country", "creamy", "crosswise", "crumbled", "crushed", "cubed",
    "cut", "deveined", "diagonally", "diced", "dried", "drained", "each", "european", "finely", "firm", "firmly",
    "fresh", "freshly", "frozen", "grated", "ground", "halved", "if", "julienned", "lengthwise", "lightly",
    "lukewarm", "mashed", "melted", "minced", "natural", "organic", "paper", "peeled", "pitted", "plain", "quartered",
    "regular", "rinsed", "ripe", "roasted", "rotisserie", "roughly", "seeded", "shelled", "shredded", "shucked",
    "sifted", "skinless", "skinned", "sliced", "smashed", "softened", "spicy", "stemmed", "thick", "thickly", "thin",
    "thinly", "toasted", "trimmed", "unsalted", "virgin", "warm", "washed", "whole", "optional", "divided",
]

MEATS = ["beef", "chicken", "duck", "fish", "lamb", "pork", "salmon", "turkey", "veal"]
MEAT_PARTS = [
    "breast", "breasts", "chop", "chops", "drumstick", "drumsticks", "fillet", "fillets", "filet", "filets", "leg",
    "legs", "loin", "loins", "shoulder", "shoulders", "side", "sides", "steak", "steaks", "thigh", "thighs", "wing",
    "wings",
]
CONNECTORS = ["and", "or", "of", "to", "with", "in"]
TAIL_CUES = ["for", "such as", "like", "available", "plus"]
ES_EXCEPTIONS = {"cookies": "cookie"}
