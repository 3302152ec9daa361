"""Column functions that the operators share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jaccard(a, b) -> Column:
    """Both empty: 1, one empty: 0."""
    both, either = F.size(F.array_intersect(col(a), col(b))), F.size(F.array_union(col(a), col(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(both.cast("double") / F.greatest(either, F.lit(1)))


def recall(wanted, have, empty: float = 0.0) -> Column:
    """Share of wanted's elements in have; `empty` where nothing is wanted."""
    n = F.size(F.array_distinct(col(wanted)))
    return F.when(n == 0, F.lit(empty)).otherwise(F.size(F.array_intersect(col(wanted), col(have))).cast("double") / F.greatest(n, F.lit(1)))


def differs(a, b, tolerance: float = 1e-6) -> Column:
    """Both known and more than tolerance apart; never null."""
    return F.coalesce(F.abs(col(a) - col(b)) > tolerance, F.lit(False))


def conflict(a, b) -> Column:
    """Both known and unequal; never null."""
    return F.coalesce(col(a) != col(b), F.lit(False))


def model_match(xs, ys, least: int = 4) -> Column:
    """Any two equal models, or one a beginning of the other with at least `least` characters."""
    return F.exists(col(xs), lambda x: F.exists(col(ys), lambda y: (x == y) | ((F.length(x) >= least) & F.startswith(y, x)) | ((F.length(y) >= least) & F.startswith(x, y))))


def soft_text(c) -> Column:
    """Small letters, white space squeezed."""
    return F.trim(F.regexp_replace(F.lower(col(c)), r"\s+", " "))


def hard_text(c) -> Column:
    """Small letters and digits of ASCII, Hangul and other letters only, nothing between them."""
    return F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}]+", "")


def strip_tags(c) -> Column:
    out = F.regexp_replace(col(c), "<[^>]*>", "")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return out


def age_days(day, today) -> Column:
    return F.datediff(col(today), col(day))


def compact_date(c) -> Column:
    """YYYYMMDD text as a date; anything else null."""
    return F.when(col(c).rlike("^[0-9]{8}$"), F.try_to_date(col(c), "yyyyMMdd"))


def safe_int(c) -> Column:
    """'' and '0' are unknown."""
    return F.nullif(F.expr("null").cast("bigint") if c is None else col(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def round_even(c, n: int) -> Column:
    """Rounded to n decimals, half to even by the number's own value: bround goes by its shortest text, where 1.275 (in binary 1.27499...) is a half."""
    return F.rint(col(c) * F.lit(10.0**n)) / F.lit(10.0**n)


def severity(pct) -> Column:
    return F.when(col(pct) >= 40, "serious").when(col(pct) >= 20, "caution").when(col(pct) > 0, "slight").otherwise("none")


def percent_below(price, official) -> Column:
    """How many percent price lies under official, one decimal, half to even; null where official is unknown or 0."""
    return F.bround(F.try_divide((col(official) - col(price)) * F.lit(100.0), col(official)), 1)


def quadrant(demand, gap, demand_mid, gap_mid) -> Column:
    return F.when((demand >= demand_mid) & (gap >= gap_mid), "act").when(demand >= demand_mid, "watch").when(gap >= gap_mid, "check").otherwise("rest")


def keyword_of(name, n: int = 3) -> Column:
    """The first n words without digits."""
    return F.array_join(F.slice(F.filter(F.split(col(name), r"\s+"), lambda w: (w != "") & ~w.rlike("[0-9]")), 1, n), " ")


def strip_decoration(c) -> Column:
    out = F.regexp_replace(col(c), r"\[[^\]]*\]|\([^)]*\)|★[^★]*★", " ")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def squeeze_words(c) -> Column:
    return F.filter(F.split(F.lower(col(c)), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def char_ngrams(c, n: int = 3) -> Column:
    """Distinct runs of n characters of the text without white space; a shorter text is its own run; '' has none."""
    text = F.regexp_replace(col(c), r"\s+", "")
    size = F.length(text)
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substr(text, i, F.lit(n))))
    return F.when(size == 0, F.array().cast("array<string>")).otherwise(grams)


def korean_particle(word, with_final: str, without_final: str) -> Column:
    """The particle that fits the word's last syllable: by whether it ends in a consonant."""
    code = F.ascii(F.right(col(word), F.lit(1)))
    return F.when((code >= 44032) & (code <= 55203) & ((code - 44032) % 28 > 0), with_final).otherwise(without_final)


def from_map(key, mapping: dict, default=None) -> Column:
    """Lookup in a small fixed dictionary."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(pairs[col(key)], default if isinstance(default, Column) else F.lit(default))


def threshold_of(category, by_category: dict[str, float], default: float) -> Column:
    return from_map(category, by_category, default) if by_category else F.lit(default)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def median_floor(c) -> Column:
    """Mean of the middle two, cut to a whole number."""
    return F.floor(F.percentile(col(c), F.lit(0.5))).cast("bigint")


def median_even(c) -> Column:
    """Interpolated, rounded half to even."""
    return F.bround(F.percentile(col(c), F.lit(0.5)), 0).cast("bigint")


def spread_over_min(low, high) -> Column:
    return F.bround(F.try_divide((col(high) - col(low)) * F.lit(100.0), col(low)), 1)


def spread_over_max(low, high) -> Column:
    return F.bround(F.try_divide((col(high) - col(low)) * F.lit(100.0), col(high)), 1)
