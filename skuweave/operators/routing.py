"""Predicates that route rows: suspect offers, offers of the product itself, containment of flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.functions import text as A
from skuweave.operators.measures import UNITS, strip_measures

#: What marks an offer of several goods, widely (for routing) and strictly (for dropping), and a word of Hangul that is left over.
COMBO = r"(?i)\S\s*\+\s*\S|\bor\b|[0-9]\s*종|골라\s*담|선택|택\s*[0-9]|외\s*\(|/\s*[가-힣]"
BUNDLE = r"\+|[0-9]\s*종|외\s|모음|골라담기|혼합구성"
SUB_TYPE = "[가-힣]{2,}"


# Suspects ----------------------------------------------------------------------------------------------------------


def combo_marker(title) -> Column:
    """The title may name several goods or a choice; null is none."""
    return F.coalesce(S.col(title).rlike(COMBO), F.lit(False))


def pair_recall(name, title) -> Column:
    """Share of the name's pairs of neighbouring characters, small letters without white space, that the title has; 1 where the name has none."""
    grams = lambda c: S.char_ngrams(F.lower(F.coalesce(S.col(c), F.lit(""))), 2)
    return S.recall(grams(name), grams(title), 1.0)


def suspect(name, title, lo: float, hi: float) -> Column:
    """Why an offer is not trusted without a verdict: 'recall' in [lo, hi), 'combo' or 'size', in this order; null for a trusted one."""
    r = pair_recall(name, title)
    size = F.coalesce(A.size_mismatch(A.unit_sizes(name), A.unit_sizes(title)), F.lit(False))
    return F.when((r >= lo) & (r < hi), "recall").when(combo_marker(title), "combo").when(size, "size")


# Relevance ---------------------------------------------------------------------------------------------------------


def irrelevant(name, core, bundle: str = BUNDLE, sub_type: str = SUB_TYPE, units: tuple = UNITS) -> Column:
    """Why a goods name is not the product of the core words: 'core', 'bundle' or 'sub_type', the first that holds; null if it is the product.

    core is an array of words. core: a word is not in the name, blanks aside. bundle: the name has a mark of several goods. sub_type: without
    measures, what stands before the first core word (the maker), and the core words, a word of `sub_type` is left. Without core
    words only bundles are told. A null name lacks every word.
    """
    text = F.coalesce(S.col(name), F.lit(""))
    bare = lambda c: F.regexp_replace(c, r"\s+", "")
    words = F.filter(F.transform(F.coalesce(S.col(core), F.array().cast("array<string>")), bare), lambda w: F.coalesce(w, F.lit("")) != "")
    region = bare(strip_measures(text, units))
    places = F.filter(F.transform(words, lambda w: F.position(w, region)), lambda p: p > 0)
    rest = F.substr(region, F.coalesce(F.array_min(places), F.lit(1)))
    rest = F.aggregate(words, rest, lambda left, w: F.replace(left, w, F.lit("")))
    lacks = F.exists(words, lambda w: ~F.contains(bare(text), w))
    return F.when(lacks, "core").when(text.rlike(bundle), "bundle").when((F.size(words) > 0) & rest.rlike(sub_type), "sub_type")


# Flags -------------------------------------------------------------------------------------------------------------


def _member(v: Column, name: str) -> Column:
    """The object's value of a key; a path cannot name an empty key or one with both kinds of quotes."""
    quote = next((q for q in "'\"" if q not in name), None)
    if name and quote:
        return F.try_variant_get(v, f"$[{quote}{name}{quote}]", "variant")
    return F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.lit(name))


def _holds(v: Column, wanted) -> Column:
    kind = F.schema_of_variant(v)
    if isinstance(wanted, dict):
        out = kind.like("OBJECT%")
        for name, value in wanted.items():
            out = out & _holds(_member(v, name), value)
    elif isinstance(wanted, list):
        items = F.try_variant_get(v, "$", "array<variant>")
        out = kind.like("ARRAY%")
        like = lambda value: lambda x: _holds(x, value)
        for value in wanted:
            out = out & F.exists(items, like(value))
    elif wanted is None:
        out = F.is_variant_null(v)
    elif isinstance(wanted, bool):
        out = (kind == "BOOLEAN") & (F.try_variant_get(v, "$", "boolean") == wanted)
    elif isinstance(wanted, (int, float)):
        out = (kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.like("DECIMAL%")) & (F.try_variant_get(v, "$", "double") == float(wanted))
    else:
        out = (kind == "STRING") & (F.try_variant_get(v, "$", "string") == wanted)
    return F.coalesce(out, F.lit(False))


def holds_flags(flags, wanted) -> Column:
    """The JSON text contains `wanted`: every key of an object with a value that contains the wanted one, every wanted item of a list in any order.

    Numbers are equal by value, a flag of another type is not; a key that is null is not one that is missing. Text that is no JSON, and null, contain nothing.
    """
    return _holds(F.try_parse_json(S.col(flags)), wanted)
