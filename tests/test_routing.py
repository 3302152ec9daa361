"""Routing predicates against literal rows and a plain containment."""

import json

from pyspark.sql import functions as F

from skuweave.operators import routing as R


def test_suspects(spark):
    rows = [
        ("신라면 120g", "농심 신라면 120g", None), ("신라면 120g", "신라면 120g + 김", "combo"), ("신라면 120g", "신라면 240g", "recall"), ("왕교자 만두 큰 것 350g", "왕교자 만두 큰 것 350 g 3종", "combo"), ("abcdefghij 10g", "abcdefghij 10g 0g", None),
        ("abcdefghijklmnopqrst 10g", "ABCDEFGHIJKLMNOPQRST 15g", "size"), ("abc", "xyz", None), ("abcd", "abxx cd", "recall"), ("red or", "red orange", None), ("red", "red OR blue", "combo"), (None, None, None), ("", "a", None), ("a", None, None), ("tea", "tea / 홍차", "combo"),
    ]
    got = spark.createDataFrame([(i, n, t) for i, (n, t, _) in enumerate(rows)], "id int, name string, title string").select("id", R.suspect("name", "title", 0.5, 0.85).alias("r")).collect()
    assert {r["id"]: r["r"] for r in got} == {i: r for i, (_, _, r) in enumerate(rows)}


def test_relevance(spark):
    rows = [
        ("농심 신라면 120g 5개", ["농심", "신라면"], None), ("농심 봉지라면 3종 세트", ["농심", "신라면"], "core"), ("CJ제일제당 비비고 왕 교자 1.05kg", ["비비고", "왕교자"], None), ("비비고 김치 왕 교자 1kg", ["비비고", "왕교자"], "sub_type"), ("도브 유자 바디 워시", ["도브", "바디워시"], "sub_type"),
        ("신라면 건면", ["신라면"], "sub_type"), ("신라면 컵6개 + 튀김우동컵6개", ["신라면"], "bundle"), ("anything", [], None), ("a + b", None, "bundle"), (None, ["x"], "core"), (None, [], None), ("", ["", None], None), ("신라면 27인치", ["신 라면"], None),
    ]
    got = spark.createDataFrame([(i, n, c) for i, (n, c, _) in enumerate(rows)], "id int, name string, core array<string>").select("id", R.irrelevant("name", "core").alias("r")).collect()
    assert {r["id"]: r["r"] for r in got} == {i: r for i, (_, _, r) in enumerate(rows)}


def _contains(have, wanted):
    if isinstance(wanted, dict):
        return isinstance(have, dict) and all(k in have and _contains(have[k], v) for k, v in wanted.items())
    if isinstance(wanted, list):
        return isinstance(have, list) and all(any(_contains(h, w) for h in have) for w in wanted)
    if isinstance(wanted, bool) or isinstance(have, bool):
        return have is wanted
    return not isinstance(have, (dict, list)) and have == wanted


def test_flag_containment(spark):
    texts = ['{"a": true, "n": 1}', '{"a": "true", "n": 1.0}', '{"a": false, "n": null}', '{"n": 12345678901, "t": ["x", "y", {"k": [1, 2]}], "o": {"p": {"q": "r"}, "it\'s": 2.5}}', "{}", "[]", json.dumps({"": 1, "b'\"": {"x]": None}}), '["x", 1]', "1", "null", '{"a": null}', '{"t": "x"}']
    wanted = [{}, {"a": True}, {"a": None}, {"a": "true"}, {"n": 1}, {"n": 12345678901}, {"t": ["y", "x"]}, {"t": [{"k": [2]}]}, {"o": {"p": {"q": "r"}}}, {"o": {"it's": 2.5}}, {"": 1}, {"b'\"": {"x]": None}}, ["x"], [], 1, None, {"missing": None}, {"t": "x"}]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "no json", None])], "id int, f string")
    got = {r["id"]: [r[f"w{k}"] for k in range(len(wanted))] for r in df.select("id", *[R.holds_flags("f", w).alias(f"w{k}") for k, w in enumerate(wanted)]).collect()}
    for i, t in enumerate(texts):
        assert got[i] == [_contains(json.loads(t), w) for w in wanted], t
    assert not any(got[len(texts)]) and not any(got[len(texts) + 1])
    assert df.where(R.holds_flags(F.col("f"), {"a": True, "n": 1})).count() == 1
