"""Walks of nested records, page facts and the variant tree against literal rows and plain loops."""

import random

from pyspark.sql import functions as F

from skuweave.operators import nested as N
from skuweave.operators import shape as H
from skuweave.operators import voice as V


def test_taxonomy_round_trip_at_any_depth(spark):
    rows = [("a", "x", 0, "p1", 2, [("S1", "q", None)]), ("a", "y.z.deep.er.still", 0, 'say "hi"', None, []), ("a", "y.z.deep.er.still", 1, "p3", 1, [("S2", None, "verified"), ("S3", "r", None)]), ("b", "k'1.m", 0, "p4", 0, [])]
    points = spark.createDataFrame(rows, "product_uid string, dim_path string, ord int, point string, cited int, evidence array<struct<source_id:string,quote:string,match:string>>")
    got = N.walk_points(N.nest_points(points)).collect()
    assert {(r["product_uid"], r["dim_path"], r["ord"], r["point"], r["cited"], tuple(map(tuple, r["evidence"]))) for r in got} == {(*r[:5], tuple(r[5])) for r in rows}
    assert [tuple(r) for r in N.point_evidence(N.walk_points(N.nest_points(points))).orderBy("dim_path", "ord").collect()] == [("a", "x", 0, 0, "S1", "q", None), ("a", "y.z.deep.er.still", 1, 0, "S2", "", "verified"), ("a", "y.z.deep.er.still", 1, 1, "S3", "r", None)]
    assert N.nest_points(points.limit(0)).count() == 0


def test_walk_skips_what_holds_no_points(spark):
    text = '{"flags": {"a": [{"point": "no"}]}, "v": {"flags": [{"point": "no"}], "e": [], "l": ["x"], "n": null, "o": [{"other": 1}, {"point": "no"}], "p": [{"point": ""}, {"point": "yes", "evidence": null}]}, "s": "t"}'
    df = spark.createDataFrame([("a", text), ("b", "no json"), ("c", None), ("d", "[1]"), ("e", "3")], "product_uid string, taxonomy string")
    assert [tuple(r) for r in N.walk_points(df).collect()] == [("a", "v.p", "yes", None, 1, [])]


def test_dotted_pairs(spark):
    text = '{"@id": 1, "@type": "T", "a": {"b": [1, 2.5, "x", null, true], "c": [{"d": 1}, {"d": [["deep"], ["no"], ["never"]]}, {"d": 3}]}, "n": null, "e": "", "l": [], "long": "%s", "t": false}' % ("y" * 130)
    df = spark.createDataFrame([(1, text), (2, "nothing"), (3, None), (4, "7"), (5, "{}"), (5, '{"k": 1}')], "id int, j string")
    got = {(r["id"], r["name"]): r["value"] for r in N.flatten_json(df, "id", "j").collect()}
    assert got == {(1, "@type"): "T", (1, "a.b"): "1, 2.5, x, null, true", (1, "a.c.0.d"): "1", (1, "a.c.1.d.0"): "deep", (1, "a.c.1.d.1"): "no", (1, "long"): "y" * 120, (1, "t"): "false", (5, "k"): "1"}


def test_page_facts(spark):
    html = """<html><title>A
 b</title><script type='application/ld+json'>{"@type": "Product", "brand": {"name": "x"}, "n": 1}</script><script type="application/ld+json">{broken</script>
<script type="application/ld+json">[{"n": 2}, 5, {"@graph": [{"no": 1}], "m": 3}]</script><script type="application/ld+json">{"@context": "c", "@graph": [{"g": 1}, {"g": 2, "h": {"@id": 4, "i": "z"}}]}</script>
<meta property="og:title" content="T"><meta name="og:title" content="T2"><meta name="og:empty" content=" "><meta name="other" content="no">
<dl><dt>소재</dt><dd>면 &amp; <b>wool</b></dd><dt>Menu</dt><dd>no</dd><dt>Size</dt><dd>#tag</dd><dt>size</dt> <dd> 3  cm</dd></dl>
<select><option value="">All</option><option value="1">- - -</option><option value="2">선택하세요</option><option value="3"> red
 one</option></select>"""
    got = {tuple(r) for r in N.page_facts(spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<title></title>")], "page_id int, html string")).collect()}
    ld = {"@type": "Product", "brand.name": "x", "n": "2", "m": "3", "g": "2", "h.i": "z"}
    want = {(1, "title", "title", "A\n b"), (1, "meta", "og:title", "T2"), (1, "spec", "소재", "면 & wool"), (1, "spec", "size", "3 cm"), (1, "option", "0", "- - -"), (1, "option", "1", "red one")}
    assert got == want | {(1, "jsonld", k, v) for k, v in ld.items()}


def test_refused_sizes(spark):
    df = spark.createDataFrame([("p", "k", [("S",), ("a|b",), ("",), (None,), ("S",), ("x::y",), ("M",)])], "parent_uid string, keyword string, sizes array<struct<value:string>>")
    rows, refused = H.build_products(df)
    assert sorted(r["uid"] for r in rows.collect()) == ["p", "p::M", "p::S"]
    assert {(r["pos"], r["reason"]) for r in refused.collect()} == {(1, "separator"), (2, "empty"), (3, "empty"), (4, "repeated"), (5, "separator")}


def test_points_along_a_variant_tree(spark):
    rng = random.Random(8)
    parent = {i: None if i < 3 else rng.choice([None, *range(max(0, i - 12), i)]) for i in range(80)}
    says = {i: {f"p{rng.randrange(40)}": f"d{rng.randrange(3)}" for _ in range(rng.randrange(6))} for i in parent}
    shared = {"p1", "p2"}
    children = {}
    for c, p in parent.items():
        children.setdefault(p, []).append(c)
    own, fixed = {}, {}

    def fill(n, above):
        own[n] = {p: d for p, d in says[n].items() if p not in above | shared}
        for c in children.get(n, []):
            fill(c, above | set(says[n]))

    def promote(n):
        kids = children.get(n, [])
        for c in kids:
            promote(c)
        for p in {p for c in kids for p in own[c]}:
            if len(having := [c for c in kids if p in own[c]]) >= 2:
                (fixed if n is None else own[n]).setdefault(p, own[min(having)][p])
                for c in having:
                    del own[c][p]

    def alive(n):
        return bool(own[n]) | any([alive(c) for c in children.get(n, [])])

    for c in children[None]:
        fill(c, set())
    promote(None)
    tree = spark.createDataFrame([("f", c, p) for c, p in parent.items()], "family string, child int, parent int")
    points = spark.createDataFrame([("f", i, d, p) for i, ps in says.items() for p, d in ps.items()] + [("f", 999, "d", "stray")], "family string, member int, dim string, point string")
    out, kept = V.variant_points(tree, points, spark.createDataFrame([("f", p) for p in shared], "family string, point string"), "family")
    assert {(r["node"], r["point"], r["dim"]) for r in out.collect()} == {(n, p, d) for n, ps in own.items() for p, d in ps.items()} | {(None, p, d) for p, d in fixed.items()}
    got = {r["node"]: r["n_points"] for r in kept.collect()}
    assert got == {n: len(own[n]) for n in parent if alive(n)} and len(set(got.values())) > 2 and len(got) < len(parent)


def test_customer_pages(spark):
    ev = lambda *x: [("blog", u, "q" * 100, ad) for u, ad in x]
    rows = [
        ("a", "verdict.compare.x", 1, 0, "hidden", 9, ev()), ("a", "aspect.taste", 2, 0, "Sweet ", 1, ev(("u1", True), ("", False), ("u2", False), ("u3", None), ("u4", True))),
        ("a", "verdict.strengths", 3, 0, "sw eet", 7, None), ("a", "verdict.strengths", 3, 1, "Cheap", None, []), ("a", "verdict.strengths", 3, 2, "", 5, []), ("a", "verdict.strengths", 3, 3, "Light", 4, []), ("a", "verdict.strengths", 3, 4, "Small", 3, []), ("a", "verdict.strengths", 3, 5, "Soft", 2, []),
        ("b", None, 1, 0, "odd", 1, []), ("b", "context.gift.who", 2, 0, "gift", 2, []), ("c", "verdict.compare", 1, 0, "only sellers", 1, []),
    ]
    schema = "bundle_uid string, dim_path string, dim_rank int, ord int, point string, cited int, evidence array<struct<source:string,url:string,quote:string,is_ad:boolean>>"
    got = {r["bundle_uid"]: r for r in V.customer_pages(spark.createDataFrame(rows, schema)).collect()}
    page = lambda k: [(s["section"], [(i["text"], i["mentions"], [e["url"] for e in i["evidence"]]) for i in s["items"]]) for s in got[k]["sections"]]
    assert set(got) == {"a", "b"} and got["a"]["headline"] == "sw eet" and got["a"]["review_count"] == 5 + 0 + 4 + 3 + 2
    assert page("a") == [("good", [("Light", 4, []), ("Small", 3, []), ("Soft", 2, [])]), ("taste", [("Sweet", 5, ["u2", "u3", "u1"])])]
    assert got["b"]["headline"] == "odd" and page("b") == [("use", [("odd", 1, [])]), ("gift", [("gift", 2, [])])]
    assert len(got["a"]["sections"][1]["items"][0]["evidence"][0]["quote"]) == 90
