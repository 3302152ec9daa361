"""Measures in titles by a table of units."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.functions import text as A

#: Unit, dimension, base unit, factor to it, how it is written. Every count has a dimension of its own, so that sheets and tablets never mix.
UNITS = (
    ("mg", "mass", "g", 0.001, "mg"), ("g", "mass", "g", 1.0, "g"), ("kg", "mass", "g", 1000.0, "kg"), ("lb", "mass", "g", 453.592, "lb"), ("lbs", "mass", "g", 453.592, "lb"), ("oz", "mass", "g", 28.3495, "oz"),
    ("ml", "volume", "ml", 1.0, "ml"), ("cc", "volume", "ml", 1.0, "cc"), ("l", "volume", "ml", 1000.0, "L"), ("fl", "volume", "ml", 29.5735, "fl"),
    ("mm", "length", "mm", 1.0, "mm"), ("cm", "length", "mm", 10.0, "cm"), ("m", "length", "mm", 1000.0, "m"), ("in", "length", "mm", 25.4, "in"), ("인치", "length", "mm", 25.4, "인치"),
    ("w", "power", "W", 1.0, "W"), ("kw", "power", "W", 1000.0, "kW"), ("a", "current", "A", 1.0, "A"), ("v", "voltage", "V", 1.0, "V"), ("mah", "capacity", "mAh", 1.0, "mAh"), ("wh", "energy", "Wh", 1.0, "Wh"), ("hz", "refresh", "Hz", 1.0, "Hz"),
    ("gb", "storage", "GB", 1.0, "GB"), ("tb", "storage", "GB", 1024.0, "TB"), ("mb", "storage", "GB", 1 / 1024.0, "MB"), ("ms", "response", "ms", 1.0, "ms"),
    ("개", "count", "개", 1.0, "개"), ("입", "count", "개", 1.0, "입"), ("개입", "count", "개", 1.0, "개입"),
    ("매", "count_매", "매", 1.0, "매"), ("장", "count_장", "장", 1.0, "장"), ("정", "count_정", "정", 1.0, "정"), ("캡슐", "count_캡슐", "캡슐", 1.0, "캡슐"), ("봉", "count_봉", "봉", 1.0, "봉"), ("봉지", "count_봉", "봉", 1.0, "봉지"),
    ("캔", "count_캔", "캔", 1.0, "캔"), ("팩", "count_팩", "팩", 1.0, "팩"), ("병", "count_병", "병", 1.0, "병"), ("포", "count_포", "포", 1.0, "포"), ("롤", "count_롤", "롤", 1.0, "롤"), ("겹", "count_겹", "겹", 1.0, "겹"),
    ("족", "count_족", "족", 1.0, "족"), ("켤레", "count_족", "족", 1.0, "켤레"), ("줄", "count_줄", "줄", 1.0, "줄"), ("구", "count_구", "구", 1.0, "구"), ("미", "count_미", "미", 1.0, "미"), ("마리", "count_마리", "마리", 1.0, "마리"),
    ("박스", "count_박스", "박스", 1.0, "박스"), ("세트", "count_세트", "세트", 1.0, "세트"), ("단계", "count_단계", "단계", 1.0, "단계"),
    ("sheets", "sheets", "sheets", 1.0, "sheets"), ("tablets", "tablets", "tablets", 1.0, "tablets"), ("capsules", "capsules", "capsules", 1.0, "capsules"), ("pcs", "pieces", "pcs", 1.0, "pcs"), ("pack", "packs", "pack", 1.0, "pack"), ("ea", "pieces", "pcs", 1.0, "ea"),
)
#: Other spellings, and units that are too short to be trusted alone.
SYNONYMS = {"floz": "fl", "inch": "in", "리터": "l", "그램": "g", "킬로그램": "kg"}
AMBIGUOUS = ("g", "w", "a", "m", "in", "v")
#: Resolutions are no measures, and an x between a unit and a number of packs is a blank.
_RESOLUTION = r"[0-9][0-9,]*\s*[xX]\s*[0-9][0-9,]*"
_TIMES = r"([0-9][0-9.,]*[A-Za-z가-힣]{1,3})\s*[xX*×]\s*(?=[0-9])"


#: Letters of a word that only begins with a unit; a longer word must be one.
SHORT = 3


def _longest(units: tuple, synonyms: dict[str, str]) -> int:
    return max([SHORT, *(len(x) for x in (*synonyms, *(u[0] for u in units)))])


def measures_of(text, units: tuple = UNITS, synonyms: dict[str, str] = SYNONYMS, ambiguous: tuple[str, ...] = AMBIGUOUS) -> Column:
    """The measures of a text, the first of each dimension: an array of (dim, raw, value, base_value, unit, base_unit, ambiguous).

    A number and the word behind it are a measure if the word is a unit of the table, or has at most SHORT letters and begins with one (the
    longest counts); numbers inside words and model codes are not. units is the table (unit, dim, base_unit, factor, written) of the caller; without one the built-in table counts.
    """
    work = F.regexp_replace(F.regexp_replace(S.col(text), _RESOLUTION, "  "), _TIMES, "$1 ")
    pair = rf"(?<![A-Za-z0-9.])([0-9][0-9,]*(?:\.[0-9]+)?)\s*([A-Za-z가-힣]{{1,{_longest(units, synonyms)}}})(?![A-Za-z0-9])"
    found = F.arrays_zip(F.regexp_extract_all(work, F.lit(pair), F.lit(1)).alias("n"), F.regexp_extract_all(work, F.lit(pair), F.lit(2)).alias("u"))
    table = F.create_map(*[x for u, dim, base, factor, written in units for x in (F.lit(u), F.struct(F.lit(u).alias("key"), F.lit(dim).alias("dim"), F.lit(base).alias("base"), F.lit(float(factor)).alias("factor"), F.lit(written).alias("written")))])

    def unit(u: Column) -> Column:
        low = F.lower(u)
        low = S.from_map(low, synonyms, low) if synonyms else low
        part = F.coalesce(*[F.try_element_at(table, F.left(low, F.lit(n))) for n in range(SHORT, 0, -1)])
        return F.coalesce(F.try_element_at(table, low), F.when(F.length(u) <= SHORT, part))

    known = F.filter(F.transform(found, lambda m: F.struct(F.replace(m["n"], F.lit(","), F.lit("")).alias("n"), unit(m["u"]).alias("k"))), lambda m: m["k"].isNotNull())
    first = F.filter(known, lambda m, i: ~F.exists(F.slice(known, 1, i), lambda x: x["k"]["dim"] == m["k"]["dim"]))
    return F.transform(first, lambda m: F.struct(
        m["k"]["dim"].alias("dim"), F.concat(m["n"], m["k"]["written"]).alias("raw"), m["n"].cast("double").alias("value"), (m["n"].cast("double") * m["k"]["factor"]).alias("base_value"),
        m["k"]["written"].alias("unit"), m["k"]["base"].alias("base_unit"), m["k"]["key"].isin(*ambiguous).alias("ambiguous"),
    ))


def all_measures(df: DataFrame, text: str, units: tuple = UNITS) -> DataFrame:
    """Rows of df times the measures of text: the first of each dimension, in its base unit. Inside the row: no window, no row number."""
    return df.select("*", F.explode(measures_of(text, units)).alias("_m")).select(*df.columns, F.col("_m.unit").alias("unit"), F.col("_m.dim").alias("dim"), F.col("_m.base_value").alias("base_value"))


def strip_measures(text, units: tuple = UNITS, synonyms: dict[str, str] = SYNONYMS) -> Column:
    """The text without its measures, white space squeezed."""
    spelt = "|".join(sorted({*synonyms, *(u[0] for u in units)}, key=lambda u: (-len(u), u)))
    pair = rf"(?i)(?<![A-Za-z0-9.])[0-9][0-9,]*(?:\.[0-9]+)?\s*(?:(?:{spelt})|(?=(?:{spelt}))[A-Za-z가-힣]{{1,{SHORT}}})(?![A-Za-z0-9])"
    work = F.regexp_replace(F.regexp_replace(S.col(text), _RESOLUTION, "  "), _TIMES, "$1 ")
    return F.trim(F.regexp_replace(F.regexp_replace(work, pair, " "), r"\s+", " "))


def parse_variant(text, units: tuple = UNITS) -> Column:
    """(base, measures, volume, count, count_unit): the name without measures, all measures, and what variants are mostly told apart by."""
    m = measures_of(text, units)
    of = lambda *dims: F.get(F.filter(m, lambda x: x["dim"].isin(*dims)), F.lit(0))
    count = F.get(F.filter(m, lambda x: F.startswith(x["dim"], F.lit("count")) | x["dim"].isin("pieces", "packs", "sheets", "tablets", "capsules")), F.lit(0))
    base = strip_measures(text, units)
    return F.struct(F.when(base == "", S.col(text)).otherwise(base).alias("base"), m.alias("measures"), F.coalesce(of("volume")["raw"], of("mass")["raw"]).alias("volume"), count["value"].cast("int").alias("count"), count["unit"].alias("count_unit"))


def family_axes(variants: DataFrame, family: str, key: str, text: str, units: tuple = UNITS) -> DataFrame:
    """(family, dim, n): the dimensions in which a family's members differ. One of an ambiguous unit counts if two members have it."""
    m = variants.select(family, key, F.explode(measures_of(text, units)).alias("m")).select(family, key, "m.*")
    g = m.groupBy(family, "dim").agg(F.count_distinct(key).alias("members"), F.count_distinct("base_value").alias("n"), F.min("ambiguous").alias("always"))
    return g.where((F.col("n") >= 2) & (~F.col("always") | (F.col("members") >= 2))).select(family, "dim", "n")


def fine_tokens(text, alias: dict[str, str] | None = None) -> Column:
    """Words of a name without measures, numbers, stop words and colours; aliases replaced."""
    words = F.filter(F.split(F.lower(strip_measures(text)), r"\s+"), lambda w: (w != "") & ~w.rlike("[0-9]") & ~w.isin(*A.STOP_WORDS) & ~w.isin(*A.COLOURS))
    return F.transform(words, lambda w: S.from_map(w, alias, w)) if alias else words
