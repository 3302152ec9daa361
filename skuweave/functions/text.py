"""Attributes read from titles and texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skuweave.functions import scalars as S

#: Small word lists of the attribute rules. A user passes own lists to the functions.
COLOURS = ("black", "white", "red", "blue", "green", "grey", "pink", "brown", "beige", "navy")
STOP_WORDS = ("the", "and", "with", "for", "of")
CONNECTORS = (("usb_c", r"(?i)(usb[- ]?c|type[- ]?c)"), ("lightning", r"(?i)(lightning|8[- ]?pin)"), ("micro", r"(?i)(micro[- ]?usb|5[- ]?pin)"))
CATEGORIES = (("metal", "steel"), ("metal", "brass"), ("plated", "plated"), ("polished", "polished"), ("promo", "promo"))
VOLUME = {"ml": 1.0, "cl": 10.0, "l": 1000.0}
WEIGHT = {"mg": 0.001, "g": 1.0, "kg": 1000.0}
POWER = {"w": 1.0, "kw": 1000.0}
LINES = ("gear", "plate", "ring", "widget", "bolt")
SIZES = (("small", r"(?i)(?<![a-z])(?:small|mini)(?![a-z])"), ("large", r"(?i)(?<![a-z])(?:large|big)(?![a-z])"))


@F.pandas_udf(T.StringType())
def nfkc(texts):
    """Compatibility normal form; Spark has no function for it."""
    import unicodedata

    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def fold(c, synonyms: dict[str, str] | None = None, normal: bool = True) -> Column:
    out = F.lower(nfkc(S.col(c)) if normal else S.col(c))
    for a, b in (synonyms or {}).items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def tokens(c, stop: tuple[str, ...] = STOP_WORDS, terms: dict[str, str] | None = None) -> Column:
    """Runs of letters, digits and Hangul in small letters, without stop words and 'spf' numbers, terms replaced."""
    out = F.regexp_extract_all(F.lower(S.col(c)), F.lit(r"[a-z0-9가-힣]+"), F.lit(0))
    out = F.filter(out, lambda w: ~w.isin(*stop) & ~w.rlike(r"^spf[0-9]*$"))
    return F.transform(out, lambda w: S.from_map(w, terms, w)) if terms else out


def measure(c, units: dict[str, float]) -> Column:
    """The first number with one of the units, in the base unit; null without one."""
    names = "|".join(sorted(units, key=lambda u: (-len(u), u)))
    pattern = rf"(?i)([0-9]+(?:\.[0-9]+)?) ?({names})(?![a-z0-9])"
    number = F.nullif(F.regexp_extract(S.col(c), pattern, 1), F.lit("")).cast("double")
    return number * S.from_map(F.lower(F.regexp_extract(S.col(c), pattern, 2)), units, None)


def pack_count(c, words: str = "pcs|pack|ea") -> Column:
    """N of 'xN' or 'N pcs', whichever comes first."""
    pattern = rf"(?i)(?<![a-z0-9])x ?([0-9]+)(?![0-9a-z])|([0-9]+) ?(?:{words})(?![a-z])"
    g = lambda i: F.nullif(F.regexp_extract(S.col(c), pattern, i), F.lit(""))
    return F.coalesce(g(1), g(2)).cast("int")


def pack_count_priority(c, words: str = "pcs|pack|ea") -> Column:
    """xN if there is one, else the last 'N pcs', else 1."""
    x = F.nullif(F.regexp_extract(S.col(c), r"(?i)(?<![a-z0-9])x ?([0-9]+)(?![0-9a-z])", 1), F.lit(""))
    last = F.try_element_at(F.regexp_extract_all(S.col(c), F.lit(rf"(?i)([0-9]+) ?(?:{words})(?![a-z])"), F.lit(1)), F.lit(-1))
    return F.coalesce(x, last, F.lit("1")).cast("int")


def first_listed(toks: Column, wanted: tuple[str, ...]) -> Column:
    return F.get(F.filter(toks, lambda w: w.isin(*wanted)), F.lit(0))


def colour(c) -> Column:
    """The first token that is a colour, else the first colour of the list that is part of the text."""
    part = F.lit(None).cast("string")
    for name in reversed(COLOURS):
        part = F.when(F.contains(F.lower(S.col(c)), F.lit(name)), name).otherwise(part)
    return F.coalesce(first_listed(tokens(c), COLOURS), part)


def product_lines(c, lines: tuple[str, ...] = LINES) -> Column:
    """The lines that the title's words name, sorted and distinct."""
    return F.array_sort(F.array_distinct(F.filter(tokens(c), lambda w: w.isin(*lines))))


def size_token(c) -> Column:
    """A size in words or letters in one form; null without one."""
    return first_rule(c, SIZES)


def first_rule(c, rules: tuple[tuple[str, str], ...]) -> Column:
    """The label of the first rule whose pattern is in the text; null if none is."""
    out = F.lit(None).cast("string")
    for label, pattern in reversed(rules):
        out = F.when(S.col(c).rlike(pattern), label).otherwise(out)
    return out


def earliest_marker(c, markers: tuple[tuple[str, str], ...]) -> Column:
    """The label of the marker that stands first in the text; of two at one place the first of the list."""
    hits = F.array(*[F.struct(F.instr(F.lower(S.col(c)), m).alias("at"), F.lit(i).alias("i"), F.lit(label).alias("label")) for i, (label, m) in enumerate(markers)])
    return F.array_min(F.filter(hits, lambda h: h["at"] > 0))["label"]


def model_codes(c, brand=None) -> Column:
    """Runs of letters and digits mixed, hyphens removed, at least three long, no measures or ordinals; longest first."""
    raw = F.regexp_extract_all(F.upper(S.col(c)), F.lit(r"[A-Z0-9]+(?:-[A-Z0-9]+)*"), F.lit(0))
    codes = F.transform(raw, lambda w: F.regexp_replace(w, "-", ""))
    codes = F.filter(codes, lambda w: w.rlike("[A-Z]") & w.rlike("[0-9]") & (F.length(w) >= 3) & ~w.rlike("^[0-9]+(ML|CL|L|MG|G|KG|CM|MM|W|X[0-9]+|GX[0-9]+|ST|ND|RD|TH)$") & ~w.rlike("^X[0-9]+$"))
    if brand is not None:
        own = F.coalesce(F.upper(F.regexp_replace(S.col(brand), "[^A-Za-z0-9]", "")), F.lit(""))
        codes = F.filter(codes, lambda w: w != own)
    keyed = F.array_sort(F.transform(F.array_distinct(codes), lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w"))))
    return F.transform(keyed, lambda s: s["w"])


def is_bundle(c) -> Column:
    """Bundle words or a plus sign, once sun-protection marks and '1+1' are out."""
    text = F.regexp_replace(F.lower(S.col(c)), r"spf ?[0-9]+\+*|pa\++|1\+1", "")
    return text.rlike(r"\+|(?<![a-z])(?:set|bundle|combo)(?![a-z])|[0-9]종")


def condition(c) -> Column:
    return F.when(S.col(c).rlike("(?i)refurb"), "refurb").when(S.col(c).rlike("(?i)(?<![a-z])used(?![a-z])"), "used")


def is_grey(c) -> Column:
    return S.col(c).rlike("(?i)(?<![a-z])(?:import|grey market|parallel)(?![a-z])")


def unit_sizes(c) -> Column:
    """Every number with a unit as 'unit:value', values with two decimals, sorted and distinct."""
    p = r"(?i)([0-9]+(?:\.[0-9]+)?) ?(ml|cl|l|mg|g|kg)(?![a-z0-9])"
    both = F.arrays_zip(F.regexp_extract_all(F.lower(S.col(c)), F.lit(p), F.lit(1)).alias("n"), F.regexp_extract_all(F.lower(S.col(c)), F.lit(p), F.lit(2)).alias("u"))
    return F.array_sort(F.array_distinct(F.transform(both, lambda s: F.concat(s["u"], F.lit(":"), F.bround(s["n"].cast("double"), 2).cast("string")))))


def size_mismatch(a, b) -> Column:
    """Some unit is in both sets of 'unit:value' without a common value."""
    unit = lambda x: F.substring_index(x, ":", 1)
    units = F.array_intersect(F.transform(S.col(a), unit), F.transform(S.col(b), unit))
    return F.exists(units, lambda u: F.size(F.array_intersect(F.filter(S.col(a), lambda x: unit(x) == u), F.filter(S.col(b), lambda x: unit(x) == u))) == 0)


def style_code(c) -> Column:
    return F.nullif(F.upper(F.regexp_extract(S.col(c), r"([A-Za-z]{2}[0-9]{4}(?:-[0-9]{3})?)", 1)), F.lit(""))


def host_of(url) -> Column:
    return F.parse_url(S.col(url), F.lit("HOST"))


def is_question(c) -> Column:
    return F.trim(S.col(c)).rlike(r"\?$|(?iU)^(who|what|when|where|why|how|is|are|can|does|do)\b")


def polarity(c, good: tuple[str, ...], bad: tuple[str, ...], negation: str = r"(?iU)\b(not|no|never)\b") -> Column:
    """pos, neg or null; a negation cancels."""
    has = lambda ws: S.any_of([F.contains(F.lower(S.col(c)), F.lit(w)) for w in ws])
    return F.when(S.col(c).rlike(negation), None).when(has(good) & ~has(bad), "pos").when(has(bad) & ~has(good), "neg")


def signals(c, phrases: tuple[str, ...]) -> Column:
    return F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains(F.lower(S.col(c)), p))


def parse_option(c) -> Column:
    """'a:x/b:y' or 'a:x,b:y' as a map."""
    parts = F.filter(F.split(S.col(c), "[/,]"), lambda p: F.contains(p, F.lit(":")))
    entry = lambda p: F.struct(F.lower(F.trim(F.substring_index(p, ":", 1))).alias("key"), F.trim(F.substr(p, F.instr(p, ":") + 1)).alias("value"))
    return F.map_from_entries(F.array_distinct(F.transform(parts, entry)))


def sku_variants(c) -> Column:
    """The SKU as it is, squeezed, and its first two parts joined and with a slash."""
    parts = F.split(S.col(c), "[-_/ #]")
    two = F.slice(parts, 1, 2)
    return F.array_distinct(F.array(S.col(c), F.regexp_replace(S.col(c), "[-_/ #]", ""), F.array_join(two, ""), F.array_join(two, "/")))


def clean_colours(c) -> Column:
    """Distinct colour words in order, without words that look like codes."""
    return F.array_distinct(F.filter(F.split(F.lower(S.col(c)), r"[^\p{L}\p{N}]+"), lambda w: (w != "") & ~w.rlike("[0-9]")))


def sku_in_title(sku, title) -> Column:
    """The SKU if the title holds it or its first seven characters, else null."""
    return F.when(F.contains(S.col(title), S.col(sku)) | F.contains(S.col(title), F.left(S.col(sku), F.lit(7))), S.col(sku))


def display_name(c, brand=None) -> Column:
    """Bracket parts and what follows a slash go; so does a repeated brand at the start."""
    out = S.strip_decoration(F.substring_index(S.col(c), "/", 1))
    if brand is not None:
        twice = F.concat(S.col(brand), F.lit(" "), S.col(brand))
        out = F.when(F.startswith(out, twice), F.trim(F.substr(out, F.length(S.col(brand)) + 2))).otherwise(out)
    return out


def purchase_quantity(c) -> Column:
    """'N+M' summed, else the pack count, at least 1."""
    plus = lambda i: F.nullif(F.regexp_extract(S.col(c), r"(?<![0-9])([0-9]{1,2})\+([0-9]{1,2})(?![0-9])", i), F.lit("")).cast("int")
    return F.greatest(F.coalesce(plus(1) + plus(2), pack_count(c), F.lit(1)), F.lit(1))


#: Words that stand before a colour without being part of it, fibres that make a text a material, countries.
COLOUR_NOISE = ("new", "the", "color", "colour", "shade")
FIBRES = "polyester|cotton|nylon|wool|acrylic|rayon|spandex|leather|mesh|blend|%"
COUNTRIES = "China|Vietnam|Korea|Indonesia|India|Cambodia|Bangladesh|Myanmar|Japan|Italy|Thailand"


def clean_colour(c, noise: tuple[str, ...] = COLOUR_NOISE) -> Column:
    """The colour without the noise words at its start."""
    words = F.filter(F.split(F.trim(S.col(c)), r"\s+"), lambda w: w != "")
    start = F.array_position(F.transform(words, lambda w: F.lower(w).isin(*noise)), False)
    return F.when(start > 0, F.array_join(F.slice(words, F.greatest(start, F.lit(1)).cast("int"), F.greatest(F.size(words), F.lit(1))), " ")).otherwise("")


def clean_sizes(c) -> Column:
    """'a|b|c' distinct and without 'hidden', by number if all are numbers, else by text."""
    parts = F.array_distinct(F.filter(F.transform(F.split(S.col(c), r"\|"), lambda p: F.trim(p)), lambda p: (p != "") & (F.lower(p) != "hidden")))
    numbers = F.forall(parts, lambda p: p.rlike(r"^[0-9]+(\.[0-9]+)?$"))
    by_number = F.transform(F.array_sort(F.transform(parts, lambda p: F.struct(p.try_cast("double").alias("n"), p.alias("p")))), lambda s: s["p"])
    return F.array_join(F.when(numbers, by_number).otherwise(F.array_sort(parts)), "|")


def notice_facts(c, fibres: str = FIBRES, countries: str = COUNTRIES) -> Column:
    """A notice text's origin (named, else a country in it), material (only if it names a fibre or a share) and month of making."""
    found = lambda pattern: F.nullif(F.trim(F.regexp_extract(S.col(c), pattern, 1)), F.lit(""))
    origin = F.coalesce(found(r"(?i)origin\s*:?\s*([A-Za-z]{2,12})"), found(rf"({countries})"))
    material = found(r"(?i)material\s*:?\s*([^\n;]{2,60})")
    made = found(r"(?i)made in month\s*:?\s*([0-9]{4}[.\- /]*[0-9]{0,2})")
    return F.struct(F.coalesce(origin, F.lit("")).alias("origin"), F.when(material.rlike(f"(?i){fibres}"), material).otherwise("").alias("material"), F.coalesce(made, F.lit("")).alias("made"))


def distinct_list(c, sep: str = ",") -> Column:
    """A separated list without repeats and blanks, in order."""
    return F.array_join(F.array_distinct(F.filter(F.transform(F.split(S.col(c), sep), lambda p: F.trim(p)), lambda p: p != "")), sep)


#: Common codes of units of measure, and labels of dimensions and genders.
UNIT_CODES = {"kg": "KGM", "g": "GRM", "mg": "MGM", "ml": "MLT", "l": "LTR", "mm": "MMT", "cm": "CMT", "m": "MTR", "w": "WTT", "kw": "KWT", "v": "VLT", "hz": "HTZ", "gb": "E34", "tb": "E35"}
GENDERS = {"m": "male", "men": "male", "f": "female", "women": "female", "u": "unisex", "kids": "kids"}


def unit_code(c) -> Column:
    return S.from_map(F.lower(S.col(c)), UNIT_CODES, None)


def gender_label(c) -> Column:
    return S.from_map(F.lower(F.trim(S.col(c))), GENDERS, None)


def priority(reviews, malls) -> Column:
    """Rank of a package in the work queue: reviews and five for each mall, then reviews."""
    n = F.coalesce(S.col(reviews), F.lit(0))
    return F.struct((n + F.coalesce(S.col(malls), F.lit(0)) * 5).alias("weight"), n.alias("reviews"))
