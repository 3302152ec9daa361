"""Behaviours of the product operators on small literal tables."""

import hashlib
import random
import re
import unicodedata
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from skuweave.functions import scalars as S
from skuweave.functions import text as A
from skuweave.operators import grounding as G
from skuweave.operators import prices as P
from skuweave.operators import resolve as R
from skuweave.operators import shape as H
from skuweave.operators import search as X
from skuweave.operators import voice as V
from skuweave.operators.measures import all_measures, family_axes, measures_of, parse_variant, strip_measures
from skuweave.plans import registry
from skuweave.plans.views import v_listing, v_title
from skuweave.sources.keyed import KeyedTable


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_similarity_of_arrays(spark):
    arr = lambda *xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    assert one(spark, S.jaccard(arr(), arr())) == 1.0
    assert one(spark, S.jaccard(arr("a"), arr())) == 0.0
    assert one(spark, S.recall(arr(), arr("a"), empty=1.0)) == 1.0
    assert one(spark, S.model_match(arr("AB12"), arr("AB12X"))) and not one(spark, S.model_match(arr("AB1"), arr("AB1X")))


def test_text_rules(spark):
    assert one(spark, A.nfkc(F.lit("ｅｇｇ㎖"))) == "eggml"
    assert one(spark, A.measure(F.lit("샴푸 1.5L x2"), A.VOLUME)) == 1500.0
    assert one(spark, A.pack_count(F.lit("tea 500ml x12"))) == 12 and one(spark, A.pack_count(F.lit("soap 3 pcs"))) == 3
    assert one(spark, A.colour(F.lit("Navy bag in blue"))) == "navy" and one(spark, A.colour(F.lit("plain"))) is None
    assert one(spark, A.is_bundle(F.lit("cream spf50+ 1+1"))) is False and one(spark, A.is_bundle(F.lit("gift set"))) is True
    assert one(spark, S.korean_particle(F.lit("책"), "은", "는")) == "은" and one(spark, S.korean_particle(F.lit("사과"), "은", "는")) == "는"
    assert one(spark, A.purchase_quantity(F.lit("milk 2+1"))) == 3
    assert one(spark, A.tokens(F.lit("The 김치 spf50 Red"))) == ["김치", "red"]


def test_attribute_rules_over_whole_tables(spark, tmp_path):
    texts = ["Amazing ﬁne tea", "THE Ｔｅａ ① the", "Été: noé singing", "stupid über, nö", "no wing", None, "", "ça va?", "isé so", "Is it", "トイレ？ who"]
    sf = f"file://{tmp_path}"
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 0, t) for i, t in enumerate(texts)], "conv_id long, turn int, text string").write.parquet(f"{sf}/conversations.parquet")
    got = lambda name, key, value, at=sf: {r[key]: r[value] for r in registry.QUERIES[name](spark, at).collect()}
    fold = lambda t: hashlib.md5(unicodedata.normalize("NFKC", t).lower().replace("the", "da").encode()).hexdigest()
    assert got("att1_fold_all", "doc_id", "folded") == {i: None if t is None else fold(t) for i, t in enumerate(texts)}

    def polarity(t):
        good, bad = "ing" in t.lower(), "stupid" in t.lower() or "trash" in t.lower()
        return None if re.search(r"(?i)\b(not|no|never)\b", t) or good == bad else "pos" if good else "neg"

    assert got("att24_polarity_all", "doc_id", "polarity") == {i: None if t is None else polarity(t) for i, t in enumerate(texts)}
    ask = lambda t: bool(re.search(r"\?$", t.strip()) or re.match(r"(?i)(who|what|when|where|why|how|is|are|can|does|do)\b", t.strip()))
    assert got("att26_question_all", "conv_id", "question") == {i: None if t is None else ask(t) for i, t in enumerate(texts)}

    part = [(1, "navy red tea"), (2, "shared blue"), (3, "red red tea 5kg"), (4, "bored"), (5, "plain")]
    one = spark.read.parquet("/root/testdata/sf0.001/part.parquet").limit(1)
    both = one.drop("p_partkey", "p_name").crossJoin(spark.createDataFrame(part, "p_partkey long, p_name string"))
    both.write.parquet(f"{sf}/part.parquet")
    assert got("att7_colour_all", "p_partkey", "colour") == {1: "navy", 2: "blue", 3: "red", 4: "red", 5: None}
    titles = {r["title_id"]: r["title"] for r in v_title(spark, sf).collect()}
    words = {i: [w for w in re.split(r"[\W_]+", t.lower()) if w and not re.search("[0-9]", w)] for i, t in titles.items()}
    assert len(titles) == 5 and any(len(set(w)) < len(w) for w in words.values())
    assert got("att27_clean_colours_all", "title_id", "words") == {i: "|".join(dict.fromkeys(w)) for i, w in words.items()}


def test_size_mismatch_needs_a_common_unit(spark):
    s = lambda t: A.unit_sizes(F.lit(t))
    assert one(spark, A.size_mismatch(s("bar 92g"), s("bar 96g"))) is True
    assert one(spark, A.size_mismatch(s("bar 92g x2"), s("bar 92g x3"))) is False
    assert one(spark, A.size_mismatch(s("bar 92g"), s("bar 92ml"))) is False


def test_measures(spark):
    df = spark.createDataFrame([("a 2kg box 500 g 30cm",), (None,)], "t string")
    assert {(r["dim"], r["base_value"]) for r in all_measures(df, "t").collect()} == {("mass", 2000.0), ("length", 300.0)}
    assert one(spark, strip_measures(F.lit("oat 2kg bar"))) == "oat bar"


def test_unit_table(spark):
    def of(text, **more):
        return {m["dim"]: m["raw"] for m in one(spark, measures_of(F.lit(text), **more))}

    assert of("두유 190ml 16개입 x 2팩 1,200g") == {"volume": "190ml", "count": "16개입", "count_팩": "2팩", "mass": "1200g"}
    assert of("아이폰15 갤럭시S24 256GB 1920x1080 27인치 144 Hz") == {"storage": "256GB", "length": "27인치", "refresh": "144Hz"}
    assert of("210gX36개 and 130G*6번들") == {"mass": "210g", "count": "36개"} and of("5 models, 7 modes, v2.5l") == {} and of("") == {}
    assert of("0.5 리터 3 inch 60캡슐") == {"volume": "0.5L", "length": "3in", "count_캡슐": "60캡슐"}
    assert of("3 bolts 12 crates", units=(("crates", "count", "crate", 1.0, "crates"),)) == {"count": "12crates"}
    v = one(spark, parse_variant(F.lit("Oat bar 35g x 6개 box")))
    assert (v["base"], v["volume"], v["count"], v["count_unit"]) == ("Oat bar box", "35g", 6, "개")
    assert one(spark, parse_variant(F.lit("500ml")))["base"] == "500ml"
    rows = [("f", 1, "tv 40 in 60Hz"), ("f", 2, "tv 50 in"), ("g", 3, "fan 5m"), ("g", 4, "fan"), ("h", 5, "milk 1L"), ("h", 6, "milk 500ml")]
    df = spark.createDataFrame(rows, "family string, id long, t string")
    assert {tuple(r) for r in family_axes(df, "family", "id", "t").collect()} == {("f", "length", 2), ("h", "volume", 2)}


def test_key_buckets(spark, tmp_path):
    path, files = f"file://{tmp_path}/t", lambda: {str(p): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    table = KeyedTable(spark, path, ["k"], spark.range(0).select(F.col("id").alias("k"), F.col("id").alias("v")).schema, buckets=8)
    assert table.read().count() == 0
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(1).cast("long").alias("v"))
    table.upsert(rows, ["v"])
    before = files()
    few = spark.createDataFrame([(5, 9), (5, 7), (105, 3), (6, 0)], "k long, v long")
    table.upsert(few, ["v"])
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert got == {**dict.fromkeys(range(100), 1), 5: 9, 105: 3}
    after = files()
    assert {p: t for p, t in after.items() if p in before} == before  # nothing is written twice
    touched = {r[0] for r in few.select(table.bucket()).collect()}
    assert {p.split("bucket=")[1].split("/")[0] for p in set(after) - set(before)} == set(map(str, touched)) and len(touched) < 8
    assert table.upsert(few.withColumn("v", F.lit(50).cast("long")), ["v"], version=1) == 1 and {r["k"]: r["v"] for r in table.read().collect()} == got  # a repeated batch
    for _ in range(2):
        table.replace(spark.createDataFrame([(5, 2), (5, 4)], "k long, v long"))
        assert sorted(r["v"] for r in table.read().where("k = 5").collect()) == [2, 4] and table.read().count() == 102
    table.vacuum(1)
    assert table.read().count() == 102 and len(table.versions()) == 1 and table.read(table.versions()[0]).count() == 102


def test_block_split_gives_every_pair_once(spark):
    keys = [(i, "m", "hot") for i in range(53)] + [(i, "g", f"k{i % 7}") for i in range(30)] + [(99, "g", "alone")]
    want = {(a, b, leg, key) for a, leg, key in keys for b, leg2, key2 in keys if a < b and (leg, key) == (leg2, key2)}
    df = spark.createDataFrame(keys, "id long, leg string, key string")
    for largest in (1000, 10, 1):
        got = [tuple(r) for r in R.key_pairs(df, largest).collect()]
        assert len(got) == len(want) and set(got) == want
    x = R.extract_attributes(v_listing(spark, "/root/testdata/sf0.001"))
    legs = {(r["a"], r["b"]): r["bits"] for r in R.candidate_legs(x, minhash=True).collect()}
    for bit, pairs in ((31, R.block_pairs(R.block_keys(x)).select("a", "b")), (64, R.minhash_pairs(x, "title_id", R.brand_shingles(), bands=40, rows=3)), (128, R.minhash_pairs(x, "title_id", F.col("toks")))):
        assert {tuple(r) for r in pairs.collect()} == {p for p, bits in legs.items() if bits & bit}


def test_trigram_search(spark):
    texts = ["The Battery lasts", "battery LASTS long", "bat", "ba", "", None, "番茄酱很好吃", "a" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    queries = ["battery", "ATT", "ba", "b", "", None, "酱很好", "zzz", "aaaa", "lasts long"]
    q = spark.createDataFrame(list(enumerate(queries)), "qid long, q string")
    post = X.trigram_postings(df, "id", "t")
    want = {(i, k) for i, x in enumerate(queries) for k, t in enumerate(texts) if x is not None and t is not None and x.lower() in t.lower()}
    got = [tuple(r) for r in X.substring_search(post, df, q, "id", "t").collect()]
    assert set(got) == want and len(got) == len(want)
    grams = lambda t: {t.lower()[i : i + 3] for i in range(len(t) - 2)} if t else set()
    near = {(i, k): round(len(a & b) / len(a | b), 4) for i, x in enumerate(queries) for k, t in enumerate(texts) if (a := grams(x)) and (b := grams(t)) and len(a & b) * 100 >= 30 * len(a | b)}
    assert {(r["qid"], r["id"]): r["similarity"] for r in X.similarity_search(post, q, "id", 30).collect()} == near and near


def test_clean_offers_never_empties_a_group_but_by_the_gate(spark):
    rows = [("A", 100, 4, 1), ("A", 900, 5, 1), ("B", 100, 1, 1), ("B", 110, 1, 1), ("B", 9000, 1, 1), ("B", 90, 2, 1)]
    df = spark.createDataFrame(rows, "product_uid string, price long, product_type int, qty int").withColumns({c: F.lit("m") for c in ("mall", "day", "title", "official_price")})
    got = {(r["product_uid"], r["price"]) for r in P.clean_offers(df).collect()}
    assert got == {("A", 100), ("A", 900), ("B", 100), ("B", 110), ("B", 90)}  # all of A are used, so that stage is skipped


def test_upserts(spark):
    old = spark.createDataFrame([("a", "done", 2, 3), ("b", "pending", 4, 0), ("c", "empty", 1, 0)], "uid string, status string, attempts int, n_dims int")
    new = spark.createDataFrame([(u, "pending", 0, 0) for u in "abcd"], old.schema)
    got = {r["uid"]: (r["status"], r["attempts"], r["n_dims"]) for r in H.merge_preserving(new, old).collect()}
    assert got == {"a": ("done", 2, 3), "b": ("pending", 4, 0), "c": ("pending", 0, 0), "d": ("pending", 0, 0)}
    once = H.replace_by_key(old, old.where("uid = 'a'").withColumn("attempts", F.lit(9)), ["uid"])
    assert sorted(r["attempts"] for r in once.collect()) == [1, 4, 9]
    kept = H.upsert_labels(old.select("uid", "attempts"), new.select("uid", "attempts"), "uid", overwrite=False)
    assert {r["uid"]: r["attempts"] for r in kept.collect()} == {"a": 2, "b": 4, "c": 1, "d": 0}


def test_strong_key_wins_in_order(spark):
    rows = spark.createDataFrame([(1, "s1", "b9"), (2, "s2", "b1"), (3, None, "b1")], "id long, style string, barcode string")
    seeds = spark.createDataFrame([(10, "s2", "b9"), (11, None, "b1"), (12, "", "zz")], rows.schema)
    got = {r["id"]: (r["match_id"], r["method"]) for r in H.strong_key_match(seeds, rows, "id", "id", ("style", "barcode")).collect()}
    assert got == {10: (2, "style"), 11: (2, "barcode")}


def test_quote_check(spark):
    assert one(spark, G.quote_check(F.lit("Very  Good"), F.lit("it is very good!"))) == "verified"
    assert one(spark, G.quote_check(F.lit("crisp sweet apple pie"), F.lit("sweet apple, a pie"))) == "partial"
    assert one(spark, G.quote_check(F.lit("bad"), F.lit("nice"))) == "unverified"


def test_reground_finds_the_nearest_span(spark):
    quotes = spark.createDataFrame([(1, "the battery lasts two days")], "evidence_id long, quote string")
    src = spark.createDataFrame([(7, "Nice box. The battery lasts for two days. Cheap.")], "doc_id long, body string")
    got = G.reground(quotes, G.spans_of(src)).first()
    assert got["doc_id"] == 7 and "battery lasts for two days" in got["span"]


def test_supporting_sources_miss_no_quote(spark):
    bodies = ["A fine e-mail program, rated 5 of 5.", "Our email programme was fine!", "番茄酱很好吃，推荐", "rated", "", None, "It is unbelievably good value for money"]
    quotes = ["fine", "e-mail", "email program", "believably good val", "很好", "a", "!!", "rated 5 of 5. And more", "", None, "Fine, E-Mail program rated"]
    src = spark.createDataFrame([(f"p{i % 2}" if i else None, i, b) for i, b in enumerate(bodies)], "product_uid string, doc_id long, body string")
    ev = spark.createDataFrame(list(enumerate(quotes)), "evidence_id long, quote string")
    hard = lambda t: re.sub(r"[\W_]+", "", t.lower())
    want = {(e, d) for e, q in enumerate(quotes) for d, b in enumerate(bodies) if q is not None and b is not None and hard(q) in hard(b)}
    got = G.supporting_sources(ev, src).collect()
    assert {(r["evidence_id"], r["doc_id"]) for r in got} == want and len(got) == len(want)


def test_reground_tries_every_span(spark):
    quotes = ["batteries lasted two dayz", "電池が二日間もちます", "colour fades afterwards", "it'sreallygreat", "nothing like this anywhere", None, ""]
    body = "The battery lasts two days. Batteries last two day. 電池は二日間もちました! Colours faded afterward. Its really great! ok ok ok. " + "Some filler text about a kettle. " * 9
    src = spark.createDataFrame([(7, body), (8, body[20:400] + "x" * 300)], "doc_id long, body string")
    spans = G.spans_of(src)
    got = {r["evidence_id"]: (r["doc_id"], r["span"], r["ratio"]) for r in G.reground(spark.createDataFrame(list(enumerate(quotes)), "evidence_id long, quote string"), spans).collect()}
    rows = sorted(spans.collect(), key=lambda r: (r["doc_id"], r["pos"], r["width"]))
    want = {}
    for i, q in enumerate(quotes):
        tried = [(SequenceMatcher(None, q, r["span"]).ratio(), r) for r in rows] if q else []
        if tried and (best := max(tried, key=lambda t: t[0]))[0] >= 0.72:
            want[i] = (best[1]["doc_id"], best[1]["span"], best[0])
    assert got == want and {0, 1, 2, 3} <= set(want)


def held_by(quote, body):
    soft = lambda t: re.sub(r"\s+", " ", t.lower()).strip()
    hard = lambda t: re.sub(r"[\W_]+", "", t.lower())
    if soft(quote) in soft(body) or hard(quote) in hard(body):
        return "verified"
    words = {w for w in re.split(r"[\W_]+", quote.lower()) if len(w) >= 2}
    return "partial" if words and sum(w in body.lower() for w in words) / len(words) >= 0.6 else None


def most_similar(quote, body, least=0.72):
    parts = [x for p in re.split(r"[.!?\n]+", body) if (x := p.strip(" "))]
    spans = [x.lower() for x in [*parts, *(f"{a} {b}" for a, b in zip(parts, parts[1:], strict=False))] if len(x) >= 6]
    found = [(SequenceMatcher(None, quote.lower(), x).ratio(), -i, x) for i, x in enumerate(spans)]
    return max(f for f in found) if found and max(found)[0] >= least else None


def test_citations_take_the_whole_path(spark):
    bodies = {
        1: "The lid fits well. It keeps soup warm for six hours! Cheap too.", 2: "My kettle boils fast. The handle gets hot.", 3: "Keeps soup warm all day long. The lid leaks.", 4: None, 5: "Lid? Fits. The handle gets really hot, careful",
    }
    product = {1: "a", 2: "a", 3: "b", 4: "b", 5: "a"}
    quotes = [
        ("a", "[s1]", "It keeps soup warm"), ("a", "[s1]", "KEEPS  SOUP-warm"), ("a", "[S1 ]", "soup warm and cheap lid"), ("a", "s2", "keeps soup warm for six hours"), ("a", "S9", "the lid fits well"), ("a", "s1", "it kept soup warn for 6 hours"),
        ("a", "s2", "it kept soup warn for 6 hours"), ("a", "s9", "xq zz vv"), ("a", "s1", "xq zz vv"), ("a", "s2", "does the lid fit?"), ("b", "s2", "the lid leaks"), ("b", "s1", ""), ("b", "s1", None), ("c", "s1", "the lid"), ("a", "s3", "Lid?"), ("a", "s9", "the handel gets realy hot, carefull"),
        ("a", "s2", "warm soup kept for two"), ("b", "s1", "!!"), (None, "s1", "the lid"), ("a", None, "the lid fits well"), ("a", "s1", "it keepz soop warmm for sixx hourz"), ("a", "s2", "it keepz soop warmm for sixx hourz"),
    ]
    c = spark.createDataFrame([(i, p, s, q, i % 2 == 1) for i, (p, s, q) in enumerate(quotes)], "citation_id long, product_uid string, local_source_id string, quote string, allow_question boolean")
    local = {1: "S1", 2: "S2", 5: "S3", 3: "S1", 4: "S2"}
    src = spark.createDataFrame([(product[d], local[d], d, b) for d, b in bodies.items()], "product_uid string, local_id string, doc_id long, body string")
    want = {}
    for i, (p, s, q) in enumerate(quotes):
        m = re.search("([A-Za-z]+[0-9]+)", s or "")
        own = next((d for d in bodies if m and product[d] == p and local[d] == m[1].upper()), None)
        mine = {d: b for d, b in bodies.items() if product[d] == p and b is not None}
        blank = not (q or "").strip()
        status = None if blank or own not in mine else held_by(q, mine[own])
        got = (own, q, status, None) if status else None
        if not got and not blank:
            if own in mine and (near := most_similar(q, mine[own])):
                got = own, near[2], "regrounded", "quote_same"
            elif hit := next(((d, st) for d, b in mine.items() if (st := held_by(q, b))), None):
                got = hit[0], q, hit[1], "quote_cross" if own else "id"
            elif near := max(((n[0], -d, n[2]) for d, b in mine.items() if (n := most_similar(q, b))), default=None):
                got = -near[1], near[2], "regrounded", "quote_cross" if own else "id"
        question = got and i % 2 == 0 and re.search(r"\?$|^(who|what|when|where|why|how|is|are|can|does|do)\b", got[1].strip(), re.I)
        want[i] = (*(got or (None, None, None, None)), ("question" if question else None) if got else "quote" if own else "id")
    got = {r["citation_id"]: (r["doc_id"], r["quote"], r["match"], r["recovery"], r["dropped"]) for r in G.ground_citations(c, src).collect()}
    assert got == want
    assert {w[2] for w in want.values()} == {"verified", "partial", "regrounded", None} and {w[3] for w in want.values()} == {"id", "quote_same", "quote_cross", None} and {w[4] for w in want.values()} >= {"id", "quote", "question"}
    assert G.ground_citations(c.limit(0), src).count() == 0


def test_fingerprints_of_any_length(spark):
    rng = random.Random(4)
    bodies = ["".join(rng.choice("abc ") for _ in range(rng.randrange(0, 200))) for _ in range(40)]
    quotes = [b[(at := rng.randrange(len(b) + 1)) : at + rng.randrange(40)] for b in bodies if b for _ in range(4)]
    src = spark.createDataFrame([("", i, b) for i, b in enumerate(bodies)], "scope string, doc_id long, text string")
    got = {(r["q"], r["doc_id"]) for r in G.texts_that_hold(spark.createDataFrame([(q,) for q in quotes], "q string"), src).collect()}
    assert got == {(q, i) for q in quotes for i, b in enumerate(bodies) if q in b}


def test_spans_meet_without_a_nested_loop(spark, monkeypatch):
    rng = random.Random(6)
    words = ["kettle", "lid", "warm", "soup", "handle", "hot", "leaks", "fits"]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(2, 9)))
    spans = [(rng.choice("xy"), line(), [i, 0, 1], i) for i in range(300)]
    quotes = [(i, rng.choice("xyz"), line()[rng.randrange(3) :]) for i in range(60)]
    want = {}
    for i, scope, q in quotes:
        best = max(((SequenceMatcher(None, q, s).ratio(), -o[0], s) for sc, s, o, _ in spans if sc == scope), default=None)
        if best and best[0] >= 0.72:
            want[i] = (best[0], -best[1], best[2])
    for size in (4096, 20):
        monkeypatch.setattr(G, "CELL_SPANS", size)
        monkeypatch.setattr(G, "CELL_QUOTES", max(3, size // 8))
        out = G.nearest_spans(spark.createDataFrame(quotes, "qid long, scope string, quote string"), spark.createDataFrame(spans, "scope string, span string, ord array<long>, doc_id long"), 0.72)
        assert {r["qid"]: (r["ratio"], r["doc_id"], r["span"]) for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and len(want) > 20


def test_components_and_guard(spark):
    edges = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.8), (5, 4, 0.9), (9, 9, 1.0), (3, 10, 0.7)], "a long, b long, score double")
    got = {r["id"]: r["component"] for r in R.connected_components(edges).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 4: 4, 5: 4}
    barred = spark.createDataFrame([(1, 10)], "a long, b long")
    guarded = {r["id"]: r["cluster_id"] for r in R.guarded_clusters(edges.where("a <> b"), barred).collect()}
    assert guarded[1] == guarded[3] != guarded[10] and guarded[4] == guarded[5]


def greedy(edges, barred):
    at = {v: v for a, b, *_ in [*edges, *barred] for v in (a, b)}
    for a, b, _ in sorted(edges, key=lambda x: (-x[2], x[0], x[1])):
        a, b = at[a], at[b]
        if a != b and not any({at[x], at[y]} == {a, b} for x, y in barred):
            at = {v: min(a, b) if c in (a, b) else c for v, c in at.items()}
    return at


def test_guarded_clusters_lose_no_edge_of_a_large_component(spark):
    def check(n_ids, n_edges, n_bars, **more):
        rng = random.Random(n_edges)
        pairs = rng.sample([(a, b) for a in range(n_ids) for b in range(n_ids) if a < b], n_edges + n_bars)
        edges = [(*(p if i % 2 else p[::-1]), rng.randrange(50, 99) / 100) for i, p in enumerate(pairs[:n_edges])]
        edges += [(i, n_ids + i, 0.01) for i in range(9)]  # ends that only the weakest edges reach
        barred = [*pairs[n_edges:], (n_ids, n_ids + 1), (3, n_ids + 500)]
        got = R.guarded_clusters(spark.createDataFrame(edges, "a long, b long, score double"), spark.createDataFrame(barred, "a long, b long"), **more).collect()
        want = greedy(edges, barred)
        assert len(got) == len(want) and {r["id"]: r["cluster_id"] for r in got} == want and len(set(want.values())) > 2

    check(240, 21_000, 400)
    check(40, 150, 60, largest=40)  # rounds


def test_minhash_finds_what_the_exact_join_finds(spark):
    rows = [(i, " ".join(f"w{(i // 3) * 40 + k}" for k in range(40)) + (f" x{i}" if i % 3 else "")) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t string")
    exact = {(r["a"], r["b"]) for r in R.exact_jaccard_pairs(df, "id", F.split("t", " ")).collect()}
    near = {(r["a"], r["b"]) for r in R.minhash_pairs(df, "id", F.split("t", " ")).collect()}
    assert len(exact) == 60 and len(exact & near) >= 0.95 * len(exact)


def test_empty_tables(spark):
    offers = spark.createDataFrame([], "product_uid string, category string, brand string, mall string, price long, official_price long, qty int, product_type int, day date, title string")
    for f in (P.price_ladder, P.category_statistics, P.official_undercut, P.violation_report, P.headline_offer and P.cheapest_per_mall, P.demand_priority):
        assert f(offers).count() == 0
    assert P.clean_offers(offers, trim=(0.05, 0.95), iqr=1.5).count() == 0


def test_char_minhash_finds_what_exact_jaccard_finds(spark):
    from skuweave.operators import resolve as R
    from skuweave.plans.views import v_listing

    t = v_listing(spark, "/root/testdata/sf0.001")
    grams = R.brand_shingles()
    exact = {(r["a"], r["b"]) for r in R.exact_jaccard_pairs(t, "title_id", grams, 80).collect()}
    found = {(r["a"], r["b"]) for r in R.minhash_pairs(t, "title_id", grams, bands=40, rows=3).collect()}
    assert len(exact & found) >= 0.95 * len(exact)


def test_exact_jaccard_of_copies_and_classes(spark):
    from skuweave.operators import resolve as R

    sets = [["a", "b", "c", "d", "e"]] * 6 + [["a", "b", "c", "d", "x"], ["a", "b", "c", "d", "e", "f"], [], ["q"], ["q"], ["e", "d", "c", "b", "a", "a"]]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, t array<string>")
    want = {(i, j) for i, x in enumerate(sets) for j, y in enumerate(sets) if i < j and x and y and 100 * len({*x} & {*y}) >= 80 * len({*x} | {*y})}
    assert {(r["a"], r["b"]) for r in R.exact_jaccard_pairs(df, "id", F.col("t")).collect()} == want
    got = {r["id"]: r["cluster_id"] for r in R.clusters(df, R.similarity_edges(df, "id", F.col("t")), "id").collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0, 6: 6, 7: 0, 8: 8, 9: 9, 10: 9, 11: 0}


def test_scores_routes_and_verdicts(spark):
    from skuweave.operators import resolve as R

    rows = [
        (1, "Acme", "Acme bolt MX12A 500g x2", "880"), (2, "Acme", "Acme bolt MX12A 500g x2 refurb", "880"), (3, "Acme", "Acme bolt MX12A 400g x2", ""), (4, "Other", "Other bolt MX12A 500g x2", "880"),
        (5, None, "thing", "99"), (6, None, "something else", "99"), (7, None, "bolt MX12AB 500g x2", None),
    ]
    t = spark.createDataFrame(rows, "title_id long, brand_raw string, title string, gtin string").withColumn("category", F.lit("c"))
    x = R.extract_attributes(t)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (5, 6), (1, 7)], "a long, b long")
    got = {(r["a"], r["b"]): r for r in R.adjudicate(R.route(R.score_pairs(pairs, x))).collect()}
    assert got[1, 2]["score"] == 0.66 and got[1, 2]["same"] is False and got[1, 2]["reason"] == "condition mismatch"
    assert got[1, 3]["conflicts"] == "grams" and got[1, 3]["score"] == 0.3 and got[1, 3]["route"] == "reject"
    assert got[1, 4]["brand_ok"] is False and got[1, 4]["score"] == 0.3 and got[1, 4]["reason"] == "brand mismatch"
    assert got[5, 6]["score"] == 0.1 and got[5, 6]["brand_ok"] is None  # a GTIN that nothing backs
    assert got[1, 7]["same"] is True  # no brand, the model's beginning and all numbers agree
    legs = {(r["a"], r["b"]): r["legs"] for r in R.block_pairs(R.block_keys(x)).collect()}
    assert legs[1, 2] == "gtin|model|numbers|prefix" and legs[1, 7] == "prefix" and legs[5, 6] == "gtin"


def test_matching_of_names(spark):
    from skuweave.operators import match as M

    seeds = [(1, "green", "green", None, "x", None), (2, "noodle soup", "red", "120", "x", None), (3, "noodle soup", None, "110", "x", "food"), (4, "soup bowl", None, None, "strict", None), (5, "noodle soup", None, None, "x", "shoes"), (6, None, None, None, None, None)]
    s = spark.createDataFrame(seeds, "seed_id long, name string, color string, size string, category string, domain string")
    rows = [(10, "Noodle Soup", "black", "110", None), (11, "noodle soup 500g", "dark red", "120g", "food"), (12, "noodle soup", "red", "90", "food"), (13, "green tea", "green", "1", None), (14, "green", "green", "", None)]
    r = spark.createDataFrame(rows, "row_id long, name string, color string, sizes string, domain string")
    got = {x["seed_id"]: (x["row_id"], x["tag"]) for x in M.match_by_name(s, r, thresholds={"strict": 0.9}).collect()}
    assert got == {2: (11, "name+color+size"), 3: (10, "name+size"), 5: (10, "name")}


def test_readers_take_marks_blanks_and_refuse_the_rest(spark, tmp_path):
    from skuweave.sources import readers, writers

    (tmp_path / "i.json").write_text('{"uid": "a", "dims": [{"path": "p", "points": [{"point": "x", "cited": 2}]}]}\n\n   \nnot json\n{"uid": "b"}\n')
    good, bad = readers.read_insights(spark, f"file://{tmp_path}/i.json")
    assert sorted(x["uid"] for x in good.collect()) == ["a", "b"] and [x[0] for x in bad.collect()] == ["not json"]
    for name, text in (("a", "\ufeffname,size\nn1,1\nn2,2\nn3,\n"), ("b", "name,brand\nm1,B\nm2,\nm3,B\n"), ("c", "name\nx\ny\n")):
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    out = readers.read_catalogs(spark, {k: f"file://{tmp_path}/{k}.csv" for k in "abc"}, {"a": "A", "b": "BB"})
    assert sorted((x["source"], x["name"], x["brand"], x["size"]) for x in out.collect()) == [("a", "n1", "A", "1"), ("a", "n2", "A", "2"), ("a", "n3", "A", None), ("b", "m1", "B", None), ("b", "m2", "BB", None), ("b", "m3", "B", None)]
    (tmp_path / "l.json").write_text('[{"title": "t", "mall": "m", "price": 5}, {"title": "t", "mall": "m", "price": 5}, {"title": "u", "mall": "m", "price": null}]')
    assert [(x["title"], x["price"]) for x in readers.read_listings(spark, f"file://{tmp_path}/l.json").collect()] == [("t", 5)]
    df = spark.createDataFrame([("u", None)], "insight_uid string, size string")
    writers.write_seed(df, f"file://{tmp_path}/seed")
    back = spark.read.option("header", True).csv(f"file://{tmp_path}/seed")
    assert back.columns == list(writers.SEED_COLUMNS) and back.first()["insight_uid"] == "u" and back.first()["size"] is None


def test_rules_find_nothing_after_repair(spark):
    from skuweave.operators import quality as Q

    s = spark.createDataFrame([(1, True, 0), (2, False, 3), (3, True, 1), (4, None, None)], "uid long, has_insight boolean, n_dims int")
    rules = [Q.Rule("drift", "low", F.col("has_insight") != (F.col("n_dims") > 0), {"has_insight": F.col("n_dims") > 0}), Q.Rule("missing", "low", F.col("n_dims").isNull())]
    found, repaired = Q.run_rules(s, rules, "uid", fix=True)
    assert sorted((r["uid"], r["rule"], r["fixed"]) for r in found.collect()) == [(1, "drift", True), (2, "drift", True), (4, "missing", False)]
    assert [(r["uid"], r["rule"]) for r in Q.run_rules(repaired, rules, "uid")[0].collect()] == [(4, "missing")]
    ev = spark.createDataFrame([(1, 1, "96 g bar"), (1, 2, "96g"), (1, 3, "92 g"), (2, 1, "12 pcs"), (3, 1, "1 kg"), (3, 2, "900 g")], "uid long, n int, text string")
    cat = spark.createDataFrame([(1, 92.0, None), (2, 10.0, None), (3, 1000.0, None)], "uid long, mass double, vol double")
    assert [(r["uid"], r["evidence"]) for r in Q.quantity_mismatch(cat, ev, "uid", "text", ["n"]).collect()] == [(1, 96.0)]


def test_near_vectors_recall(spark):
    from skuweave.operators import shape as H

    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").withColumn("label", F.lit(0))
    q = e.where("vec_id % 20 = 0")
    exact = {(r["query_id"], r["vec_id"]) for r in H.cosine_top_k(e, q, 5, block=100).collect()}
    found = {(r["query_id"], r["vec_id"]) for r in H.approx_top_k(e, q, 5).collect()}
    assert len(exact) == q.count() * 5 and len(exact & found) >= 0.9 * len(exact)
