"""Nested serving records: flat summaries, product groups, consumer guides and the catalogue report, one row for each key.

A record holds all that its key has, so its lists are as long as the key's distinct texts; equal rows are merged before the shuffle.
Null keys have no record, null and empty texts are left out, columns that a function does not name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.operators import voice as V
from skuweave.operators.measures import UNITS, measures_of

#: Labels of the dimensions of measures, and codes of units in product records.
MEASURE_LABELS = {
    "mass": "중량", "volume": "용량", "length": "크기", "power": "소비전력", "current": "전류", "voltage": "전압", "capacity": "배터리용량", "energy": "에너지", "refresh": "주사율", "storage": "저장용량",
    "response": "응답속도", "count": "개수", "count_매": "매수", "count_장": "장수", "count_정": "정수", "count_캡슐": "캡슐수", "count_봉": "봉수", "count_캔": "캔수", "count_팩": "팩수", "count_병": "병수", "count_포": "포수",
    "count_롤": "롤수", "count_겹": "겹수", "count_족": "족수", "count_줄": "줄수", "count_구": "구수", "count_미": "미수", "count_마리": "마리수", "count_박스": "박스수", "count_세트": "세트수", "count_단계": "단계",
}
UNIT_CODES = {
    "kg": "KGM", "g": "GRM", "mg": "MGM", "lb": "LBR", "oz": "ONZ", "ml": "MLT", "cc": "CMQ", "L": "LTR", "l": "LTR", "mm": "MMT", "cm": "CMT", "m": "MTR", "in": "INH", "인치": "INH",
    "W": "WTT", "kW": "KWT", "A": "AMP", "V": "VLT", "Hz": "HTZ", "GB": "E34", "TB": "E35",
}
WEAK = "verdict.weaknesses"


def _listed(order: list[Column | str], value: Column) -> Column:
    """All values of a group, by order."""
    return F.transform(F.sort_array(F.collect_list(F.struct(*order, value.alias("_v")))), lambda x: x["_v"])


def _told(df: DataFrame, key: str, text: str = "point") -> DataFrame:
    return df.where(F.col(key).isNotNull() & (F.coalesce(F.trim(text), F.lit("")) != ""))


# Flat summaries ----------------------------------------------------------------------------------------------------


def recommendations(blocks: DataFrame, uid: str = "product_uid", taxonomy: str = "taxonomy") -> DataFrame:
    """Taxonomy JSON -> (uid, recommendation) where it has one; of repeated keys the last by text."""
    text = F.try_variant_get(F.try_parse_json(taxonomy), "$.verdict.overall_recommendation", "string")
    return blocks.select(uid, text.alias("recommendation")).where("recommendation <> ''").groupBy(uid).agg(F.max("recommendation").alias("recommendation"))


def flat_summary(points: DataFrame, faqs: DataFrame, recommended: DataFrame, key: str = "product_uid") -> DataFrame:
    """(key, recommendation, strengths, weaknesses, aspects, faqs) of every key that has a point, a FAQ or a recommendation.

    points: key, dim_path, ord, point; faqs: key, ord, question, short_answer; recommended: key, recommendation. Texts come by
    dimension and their order in it, each once; aspects maps each filled aspect.* dimension to its texts; what a key lacks is empty.
    """
    first = _told(points, key).groupBy(key, "dim_path", "point").agg(F.min("ord").alias("ord"))
    dims = first.groupBy(key, "dim_path").agg(_listed(["ord", "point"], F.col("point")).alias("texts"))
    under = lambda prefix: F.sort_array(F.collect_list(F.when(F.startswith("dim_path", F.lit(prefix)), F.struct("dim_path", "texts"))))
    part = lambda prefix: F.array_distinct(F.flatten(F.transform(under(prefix), lambda d: d["texts"])))
    said = dims.groupBy(key).agg(part("verdict.strengths").alias("strengths"), part(WEAK).alias("weaknesses"), F.map_from_entries(under("aspect.")).alias("aspects"))
    pair = F.struct("question", F.coalesce("short_answer", F.lit("")).alias("short_answer"))
    asked = _told(faqs, key, "question").groupBy(key).agg(_listed(["ord", "question"], pair).alias("faqs"))
    out = said.join(asked, key, "full_outer").join(recommended.where(F.col(key).isNotNull()).select(key, "recommendation"), key, "full_outer")
    none = F.array().cast("array<string>")
    return out.select(
        key, F.coalesce("recommendation", F.lit("")).alias("recommendation"), F.coalesce("strengths", none).alias("strengths"), F.coalesce("weaknesses", none).alias("weaknesses"),
        F.coalesce("aspects", F.create_map().cast("map<string,array<string>>")).alias("aspects"), F.coalesce("faqs", F.array().cast("array<struct<question:string,short_answer:string>>")).alias("faqs"),
    )


# Product groups ----------------------------------------------------------------------------------------------------


def product_groups(members: DataFrame, prices: DataFrame, ratings: DataFrame, family: str = "family", key: str = "uid", name: str = "name", units: tuple = UNITS) -> DataFrame:
    """(family, varies_by, variants): a family's members with the measures in their names, price and rating, by name.

    prices: key, price; ratings: key, rating, n; one row for each key. varies_by has the labels of the dimensions in which members have two
    values or more, compared in the base unit to four decimals; one that all share, or that one member alone has, does not count.
    A price that is null or not above 0 is none.
    """
    label = lambda d: S.from_map(d, MEASURE_LABELS, d)
    m = members.where(F.col(family).isNotNull()).select(F.col(family).alias("family"), F.col(key).alias("uid"), F.col(name).alias("name"), F.coalesce(measures_of(name, units), measures_of(F.lit(""), units)).alias("measures"))
    values = m.select("family", F.explode("measures").alias("m")).groupBy("family", F.col("m.dim").alias("dim")).agg(F.count_distinct(F.round("m.base_value", 4)).alias("n"))
    varies = values.where("n >= 2").groupBy("family").agg(F.sort_array(F.collect_set(label(F.col("dim")))).alias("varies_by"))
    props = F.transform("measures", lambda x: F.struct(label(x["dim"]).alias("name"), x["raw"].alias("value"), x["value"].alias("number"), x["unit"].alias("unit"), S.from_map(x["unit"], UNIT_CODES, F.lit(None).cast("string")).alias("code")))
    j = m.join(prices.select(F.col(key).alias("uid"), "price"), "uid", "left").join(ratings.select(F.col(key).alias("uid"), "rating", F.col("n").alias("n_ratings")), "uid", "left")
    variant = F.struct("uid", "name", props.alias("properties"), F.when(F.col("price") > 0, F.col("price")).alias("price"), "rating", "n_ratings")
    groups = j.groupBy("family").agg(_listed(["name", "uid"], variant).alias("variants"))
    return groups.join(varies, "family", "left").select(F.col("family").alias(family), F.coalesce("varies_by", F.array().cast("array<string>")).alias("varies_by"), "variants")


def group_json(groups: DataFrame, family: str = "family", currency: str = "KRW") -> DataFrame:
    """product_groups -> (family, record): the group as a schema.org ProductGroup in JSON; what is not known has no key."""
    typed = lambda t, *columns: F.struct(F.lit(t).alias("@type"), *columns)
    filled = lambda c: F.when(F.size(c) > 0, c)
    prop = lambda p: typed("PropertyValue", p["name"].alias("name"), p["value"].alias("value"), typed("QuantitativeValue", p["number"].alias("value"), p["unit"].alias("unitText"), p["code"].alias("unitCode")).alias("valueReference"))
    variant = lambda v: typed(
        "Product", v["name"].alias("name"), filled(F.transform(v["properties"], prop)).alias("additionalProperty"), F.when(v["price"].isNotNull(), typed("Offer", v["price"].alias("price"), F.lit(currency).alias("priceCurrency"))).alias("offers"),
        F.when(v["rating"].isNotNull(), typed("AggregateRating", v["rating"].alias("ratingValue"), v["n_ratings"].alias("reviewCount"))).alias("aggregateRating"),
    )
    record = F.struct(F.lit("https://schema.org/").alias("@context"), F.lit("ProductGroup").alias("@type"), F.col(family).alias("name"), F.transform("variants", variant).alias("hasVariant"), filled(F.col("varies_by")).alias("variesBy"))
    return groups.select(family, F.to_json(record).alias("record"))


# Consumer guides ---------------------------------------------------------------------------------------------------


def _folded(c: Column) -> Column:
    return F.replace(F.lower(F.trim(c)), F.lit(" "), F.lit(""))


def _most_said(items: Column, k: int) -> Column:
    """The k items with most mentions; of equal ones those that come first."""
    ranked = F.array_sort(F.transform(items, lambda x, i: F.struct((-x["mentions"]).alias("less"), i.alias("i"), x.alias("x"))))
    return F.transform(F.slice(ranked, 1, k), lambda r: r["x"])


def consumer_guide(points: DataFrame, videos: DataFrame, offers: DataFrame, buzz: DataFrame, major: Column, key: str = "bundle_uid", cards: int = 3, of_videos: int = 4) -> DataFrame:
    """One row for each key with a customer's page: headline, card, pros, video_pros, cons, head price, ladder, buzz, review_count.

    points and videos: what customer_pages takes; offers: key, product_uid, mall, price; buzz: key, buzz. cons are all weaknesses, those
    cited most first. pros are the page's sections without its caveats; a text that is also a weakness, whatever its case and blanks, is no
    pro. card has the `cards` most mentioned pros. video_pros are those of the `of_videos` most mentioned ones of the videos' page that are no weakness.
    head is the lowest offer, those of major malls first; ladder has each product's lowest price and number of malls.
    """
    plain = lambda name: F.filter(name, lambda s: s["section"] != "caveat")
    pages = V.customer_pages(points.where(F.col(key).isNotNull()), key)
    filmed = V.customer_pages(videos.where(F.col(key).isNotNull()), key).select(key, _most_said(F.flatten(F.transform(plain("sections"), lambda s: s["items"])), of_videos).alias("filmed"))

    weak = _told(points, key).where(F.startswith("dim_path", F.lit(WEAK))).withColumn("cited", F.coalesce("cited", F.lit(0)).cast("long"))
    at = F.struct((-F.col("cited")).alias("less"), "dim_rank", "ord")
    weak = weak.groupBy(key, F.trim("point").alias("text")).agg(F.min(at).alias("at"), F.min_by("evidence", at).alias("evidence"))
    linked = F.transform(F.filter("evidence", lambda e: F.coalesce(e["url"], F.lit("")) != ""), lambda e: F.struct(e["source"].alias("source"), e["url"].alias("url"), e["quote"].alias("quote")))
    con = F.struct("text", (-F.col("at.less")).alias("mentions"), linked.alias("evidence"))
    cons = weak.groupBy(key).agg(_listed(["at", "text"], con).alias("cons"))

    priced = offers.where(F.col(key).isNotNull() & (F.col("price") > 0)).withColumn("minor", ~F.coalesce(major, F.lit(False)))
    rungs = priced.groupBy(key, "product_uid").agg(F.min("price").alias("low"), F.count_distinct("mall").alias("n_malls"))
    ladder = rungs.groupBy(key).agg(_listed(["low", "product_uid"], F.struct("product_uid", "low", "n_malls")).alias("ladder"))
    head = priced.groupBy(key).agg(F.min(F.struct("minor", "price", "mall")).alias("h")).select(key, F.struct("h.mall", "h.price", (~F.col("h.minor")).alias("major")).alias("head"))

    j = pages.join(filmed, key, "left").join(cons, key, "left").join(head, key, "left").join(ladder, key, "left").join(buzz.select(key, "buzz"), key, "left")
    j = j.withColumn("blamed", F.coalesce(F.transform("cons", lambda c: _folded(c["text"])), F.array().cast("array<string>")))
    good = lambda i: ~F.array_contains(F.col("blamed"), _folded(i["text"]))
    sections = F.transform(plain("sections"), lambda s: F.struct(s["section"].alias("section"), F.filter(s["items"], good).alias("items")))
    j = j.withColumn("pros", F.filter(sections, lambda s: F.size(s["items"]) > 0))
    return j.select(
        key, "headline", _most_said(F.flatten(F.transform("pros", lambda s: s["items"])), cards).alias("card"), "pros", F.filter("filmed", good).alias("video_pros"), "cons", "head", "ladder",
        F.coalesce("buzz", F.lit(0)).cast("long").alias("buzz"), "review_count",
    )


# The catalogue report ----------------------------------------------------------------------------------------------


def dims_of(points: DataFrame, key: str) -> DataFrame:
    """(key, dims, n_sources): a key's dimensions in their order, each (label, points of (text, evidence)); n_sources counts different links.

    points: key, dim_path, dim_rank, ord, point, evidence of (source, url, quote, is_ad). A text is once in a dimension, with its first evidence.
    """
    told = _told(points, key)
    once = told.groupBy(key, "dim_path", F.trim("point").alias("text")).agg(F.min("dim_rank").alias("dim_rank"), F.min("ord").alias("ord"), F.min_by("evidence", "ord").alias("evidence"))
    pieces = F.coalesce(F.transform("evidence", lambda e: F.struct(e["quote"].alias("quote"), e["url"].alias("url"), e["source"].alias("source"))), F.array().cast("array<struct<quote:string,url:string,source:string>>"))
    dims = once.groupBy(key, "dim_path").agg(F.min("dim_rank").alias("dim_rank"), _listed(["ord", "text"], F.struct("text", pieces.alias("evidence"))).alias("points"))
    dims = dims.withColumn("d", F.struct(V.dim_label("dim_path").alias("label"), "points")).groupBy(key).agg(_listed(["dim_rank", "dim_path"], F.col("d")).alias("dims"))
    urls = told.select(key, F.explode("evidence").alias("e")).where("e.url <> ''").groupBy(key).agg(F.count_distinct("e.url").alias("n_sources"))
    return dims.join(urls, key, "left").select(key, "dims", F.coalesce("n_sources", F.lit(0)).alias("n_sources"))


def catalog_report(catalog: DataFrame, prices: DataFrame, points: DataFrame, faqs: DataFrame, videos: DataFrame, video_faqs: DataFrame, key: str, extracted_only: bool = True) -> DataFrame:
    """The catalogue's own columns, price, dims, n_sources, faqs, has_video, video_dims, video_sources, video_faqs: one row for each of its rows.

    prices: a price ladder by key; points and videos: what dims_of takes; faqs: key, ord, question, short_answer. price is null where no
    offer has one. With extracted_only, rows that have neither a price nor dimensions nor a video are left out.
    """

    def asked(rows: DataFrame, name: str) -> DataFrame:
        return _told(rows, key, "question").groupBy(key).agg(_listed(["ord", "question"], F.struct("question", F.coalesce("short_answer", F.lit("")).alias("short_answer"))).alias(name))

    price = F.struct(F.col("min_price").alias("low"), F.col("median_price").alias("median"), F.col("max_price").alias("high"), "n_malls", F.col("cheapest_mall").alias("low_mall"), "spread_pct")
    own = [c for c in catalog.columns if c not in ("price", "dims", "n_sources", "faqs", "has_video", "video_dims", "video_sources", "video_faqs")]
    out = catalog.select(*own).join(prices.where("min_price is not null").select(key, price.alias("price")), key, "left").join(dims_of(points, key), key, "left").join(asked(faqs, "faqs"), key, "left")
    filmed = dims_of(videos, key).select(key, F.col("dims").alias("video_dims"), F.col("n_sources").alias("video_sources"))
    out = out.join(filmed, key, "left").join(asked(video_faqs, "video_faqs"), key, "left").withColumn("has_video", F.col("video_dims").isNotNull())
    if extracted_only:
        out = out.where("price is not null or dims is not null or has_video")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select(*own, "price", "dims", zero("n_sources"), "faqs", "has_video", "video_dims", zero("video_sources"), "video_faqs")
