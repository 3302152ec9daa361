"""Nested serving records against literal rows: order, repeats, nulls, empty tables, clashing columns."""

import json

from pyspark.sql import functions as F

from skuweave.operators import serving as R

POINTS = "bundle_uid string, dim_path string, dim_rank int, ord int, point string, cited int, evidence array<struct<source:string,url:string,quote:string,is_ad:boolean>>, text string"
FAQS = "bundle_uid string, ord int, question string, short_answer string"


def test_flat_summary(spark):
    e = []
    rows = [
        ("a", "verdict.strengths.x", 1, 1, "light", 1, e, "t"), ("a", "verdict.strengths.x", 1, 0, "cheap", 1, e, "t"), ("a", "verdict.strengths.y", 2, 0, "light", 9, e, "t"), ("a", "verdict.strengths.y", 2, 3, "soft", 9, e, "t"),
        ("a", "verdict.weaknesses", 3, 0, "thin", 1, e, "t"), ("a", "aspect.size", 4, 0, "big", 1, e, "t"), ("a", "aspect.size", 4, 5, "big", 1, e, "t"), ("a", "aspect.size", 4, 2, "round", 1, e, "t"), ("a", "context.use", 5, 0, "home", 1, e, "t"),
        ("a", "aspect.none", 6, 0, " ", 1, e, "t"), ("a", "aspect.none", 6, 1, None, 1, e, "t"), (None, "aspect.size", 1, 0, "lost", 1, e, "t"),
    ]
    blocks = spark.createDataFrame([("a", '{"verdict": {"overall_recommendation": "buy"}}'), ("a", "no json"), ("b", '{"verdict": {}}'), ("c", '{"verdict": {"overall_recommendation": "wait"}}'), (None, '{"verdict": {"overall_recommendation": "x"}}')], "bundle_uid string, taxonomy string")
    faqs = spark.createDataFrame([("a", 1, "why", "so"), ("a", 0, "how", None), ("d", 0, "", "x"), ("e", 0, "who", "me")], FAQS)
    told = R.recommendations(blocks, "bundle_uid")
    got = {r["bundle_uid"]: (r["recommendation"], r["strengths"], r["weaknesses"], r["aspects"], [tuple(f) for f in r["faqs"]]) for r in R.flat_summary(spark.createDataFrame(rows, POINTS), faqs, told, "bundle_uid").collect()}
    assert got == {
        "a": ("buy", ["cheap", "light", "soft"], ["thin"], {"aspect.size": ["big", "round"]}, [("how", ""), ("why", "so")]),
        "c": ("wait", [], [], {}, []),
        "e": ("", [], [], {}, [("who", "me")]),
    }
    assert R.flat_summary(spark.createDataFrame([], POINTS), faqs.limit(0), told.limit(0), "bundle_uid").count() == 0


def test_product_groups(spark):
    members = spark.createDataFrame([("soap", 1, "Soap 1L 3개", 0), ("soap", 2, "Soap 1000ml 5개", 0), ("soap", 3, "Soap", 0), ("tea", 4, "Tea 20g", 0), ("tea", 5, None, 0), (None, 6, "Lost 3g", 0)], "family string, uid int, name string, price int")
    prices = spark.createDataFrame([(1, 500), (2, 0), (4, None), (9, 5)], "uid int, price int")
    ratings = spark.createDataFrame([(1, 4.5, 3, "x")], "uid int, rating double, n int, origin string")
    groups = R.product_groups(members, prices, ratings)
    got = {r["family"]: (r["varies_by"], [(v["uid"], [(p["name"], p["value"], p["code"]) for p in v["properties"]], v["price"], v["rating"], v["n_ratings"]) for v in r["variants"]]) for r in groups.collect()}
    assert got == {
        "soap": (["개수"], [(3, [], None, None, None), (2, [("용량", "1000ml", "MLT"), ("개수", "5개", None)], None, None, None), (1, [("용량", "1L", "LTR"), ("개수", "3개", None)], 500, 4.5, 3)]),
        "tea": ([], [(5, [], None, None, None), (4, [("중량", "20g", "GRM")], None, None, None)]),
    }
    record = {r["family"]: json.loads(r["record"]) for r in R.group_json(groups).collect()}
    assert record["soap"]["variesBy"] == ["개수"] and "variesBy" not in record["tea"] and record["tea"]["@type"] == "ProductGroup"
    assert record["soap"]["hasVariant"][0] == {"@type": "Product", "name": "Soap"}
    assert record["soap"]["hasVariant"][2]["offers"] == {"@type": "Offer", "price": 500, "priceCurrency": "KRW"} and record["soap"]["hasVariant"][2]["aggregateRating"] == {"@type": "AggregateRating", "ratingValue": 4.5, "reviewCount": 3}
    assert record["tea"]["hasVariant"][1]["additionalProperty"] == [{"@type": "PropertyValue", "name": "중량", "value": "20g", "valueReference": {"@type": "QuantitativeValue", "value": 20.0, "unitText": "g", "unitCode": "GRM"}}]


def test_consumer_guide(spark):
    link = lambda *u: [("blog", x, "q", False) for x in u]
    points = [
        ("a", "verdict.strengths", 1, 0, "Strong Smell", 9, [], "x"), ("a", "verdict.strengths", 1, 1, "light", 2, [], "x"), ("a", "verdict.strengths", 1, 2, "soft", 5, [], "x"), ("a", "context.use", 2, 0, "camping", 5, [], "x"), ("a", "context.use", 2, 1, "home", 1, [], "x"),
        ("a", "verdict.weaknesses", 3, 0, "strongsmell ", 3, link("u1", "", "u2"), "x"), ("a", "verdict.weaknesses", 3, 1, "thin", 7, None, "x"), ("a", "verdict.weaknesses", 3, 2, "thin", None, [], "x"), ("a", "verdict.weaknesses", 3, 3, None, 1, [], "x"),
        ("b", "verdict.weaknesses", 1, 0, "dear", None, [], "x"), (None, "verdict.strengths", 1, 0, "lost", 1, [], "x"),
    ]
    videos = [("a", "aspect.taste", 1, 0, "thin", 9, [], "x"), ("a", "aspect.taste", 1, 1, "crisp", 8, [], "x"), ("a", "context.use", 2, 0, "picnic", 7, [], "x"), ("a", "verdict.weaknesses", 3, 0, "loud", 9, [], "x")]
    offers = spark.createDataFrame([("a", "P1", "small", 90), ("a", "P1", "big", 100), ("a", "P2", "big", 95), ("a", "P3", None, None), ("a", "P4", "small", 0), ("c", "P9", "big", 1)], "bundle_uid string, product_uid string, mall string, price int")
    buzz = spark.createDataFrame([("a", 12), ("c", 3)], "bundle_uid string, buzz int")
    df = lambda rows: spark.createDataFrame(rows, POINTS)
    got = {r["bundle_uid"]: r.asDict(True) for r in R.consumer_guide(df(points), df(videos), offers, buzz, F.col("mall") == "big").collect()}
    assert set(got) == {"a", "b"}
    a, names = got["a"], lambda items: [(i["text"], i["mentions"]) for i in items]
    assert [(s["section"], names(s["items"])) for s in a["pros"]] == [("good", [("soft", 5), ("light", 2)]), ("use", [("camping", 5), ("home", 1)])]
    assert a["headline"] == "Strong Smell" and names(a["card"]) == [("soft", 5), ("camping", 5), ("light", 2)] and names(a["video_pros"]) == [("crisp", 8), ("picnic", 7)]
    assert names(a["cons"]) == [("thin", 7), ("strongsmell", 3)] and [e["url"] for e in a["cons"][1]["evidence"]] == ["u1", "u2"]
    assert a["head"] == {"mall": "big", "price": 95, "major": True} and a["ladder"] == [{"product_uid": "P1", "low": 90, "n_malls": 2}, {"product_uid": "P2", "low": 95, "n_malls": 1}] and a["buzz"] == 12
    assert got["b"]["pros"] == [] and got["b"]["card"] == [] and got["b"]["video_pros"] is None and got["b"]["head"] is None and got["b"]["buzz"] == 0 and names(got["b"]["cons"]) == [("dear", 0)]
    assert R.consumer_guide(df([]), df([]), offers, buzz, F.col("mall") == "big").count() == 0


def test_catalog_report(spark):
    link = lambda *u: [("blog", x, "q", False) for x in u]
    catalog = spark.createDataFrame([("a", "A", 9), ("b", "B", 9), ("c", "C", 9), ("d", "D", 9), ("d", "D again", 9), (None, "N", 9)], "bundle_uid string, name string, price int")
    prices = spark.createDataFrame([("a", 5, 6, 7, 2, "m", 40.0), ("c", None, None, None, 0, None, None)], "bundle_uid string, min_price int, median_price int, max_price int, n_malls int, cheapest_mall string, spread_pct double")
    points = [("a", "aspect.taste.x", 2, 0, "sweet", 1, link("u1", "u2"), "x"), ("a", "aspect.taste.x", 2, 1, "sweet ", 1, link("u3"), "x"), ("a", "other.far.y", 1, 0, "odd", 1, None, "x"), ("a", "other.far.y", 1, 1, "", 1, [], "x")]
    videos = [("d", "aspect.size.x", 1, 0, "big", 1, link("u1", ""), "x")]
    faqs = spark.createDataFrame([("a", 0, "why", "so")], FAQS)
    df = lambda rows: spark.createDataFrame(rows, POINTS)
    out = R.catalog_report(catalog, prices, df(points), faqs, df(videos), faqs.limit(0), "bundle_uid")
    got = {r["name"]: r.asDict(True) for r in out.collect()}
    assert set(got) == {"A", "D", "D again"}
    a = got["A"]
    assert a["price"] == {"low": 5, "median": 6, "high": 7, "n_malls": 2, "low_mall": "m", "spread_pct": 40.0} and a["n_sources"] == 3 and a["faqs"] == [{"question": "why", "short_answer": "so"}] and not a["has_video"]
    assert [(d["label"], [(p["text"], [e["url"] for e in p["evidence"]]) for p in d["points"]]) for d in a["dims"]] == [("far", [("odd", [])]), ("Taste", [("sweet", ["u1", "u2"])])]
    d = got["D"]
    assert d["price"] is None and d["dims"] is None and d["has_video"] and d["video_sources"] == 1 and d["video_dims"][0]["label"] == "Size" and d["video_faqs"] is None
    assert R.catalog_report(catalog, prices, df(points), faqs, df(videos), faqs, "bundle_uid", extracted_only=False).count() == 6
