"""Hard negatives, decontamination and the Merkle manifest against brute force, with odd inputs."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skuweave.llm import decontamination, hard_negatives, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, at int, digest string, up int"
ITEMS = "item_id long, text string, words string, rid long"
VECTORS = "vec_id long, embedding array<double>, label int, g string, band int, score long"


def digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def manifest(rows):
    """rows of (doc_id, text, lang, source, n_chars), one by one."""
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: digest(part(r[0]) + part(r[3]) + part(r[2]) + part(r[4]) + part(text))

    def grown(level):
        out = [level]
        while len(out[-1]) > 1:
            out.append([digest("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
        return out

    def beside(tree, at):
        for level in tree[:-1]:
            first = at // 16 * 16
            yield "".join(level[first:at]), "".join(level[at + 1 : first + 16])
            at //= 16

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    own = {}
    for source, rs in groups.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        own[source] = rs, grown([leaf(r, r[1]) for r in rs])
    names = sorted(own, key=lambda s: (s is not None, (s or "").encode()))
    top = grown([own[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        rs, tree = own[s]
        for at, r in enumerate(rs):
            path, text = [*beside(tree, at), *beside(top, k)], r[1]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = re.sub("[A-Z]+", lambda m: m[0].lower(), text)
            fold = leaf(r, text)
            for before, after in path:
                fold = digest(before + fold + after)
            out.append((r[0], tree[0][at], tree[-1][0], top[-1][0], digest("".join(a + b for a, b in path)), fold, fold == top[-1][0]))
    return out


def by_text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("sources", [1, 3, 40])
def test_manifest_of_many_trees(spark, sources):
    rows = [(i, f"Text {i} Ä" if i % 7 else None, "en", None if i % sources == 1 else f"s{i * i % sources}", i) for i in range(700)]
    rows += [(5000, "LONE one", None, "Ω alone", None), (None, "No Id", "x", "s0", 1), (None, "No Id", "x", "s0", 1), (3, "a repeated ID", None, "s0", None), (3, "a repeated ID", None, "s0", None), (7, "", "", "", 0)]
    docs = spark.createDataFrame([(*r, "t", 1, "d", 2) for r in rows], DOCS)
    assert by_text(tuple(r) for r in merkle.document_manifest(docs).collect()) == by_text(manifest(rows))


def test_manifest_of_few_rows(spark):
    assert merkle.document_manifest(spark.createDataFrame([], DOCS)).count() == 0
    for n in (1, 2, 16, 17):
        rows = [(i, f"Row {i}", None, "one", 0) for i in range(n)]
        docs = spark.createDataFrame([(*r, None, None, None, None) for r in rows], DOCS)
        assert by_text(tuple(r) for r in merkle.document_manifest(docs).collect()) == by_text(manifest(rows))


def test_manifest_climbs_by_shuffles_and_by_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_NODES", 1)
    rows = [(i, f"Text {i}", "en", f"s{i % 2}", i) for i in range(900)]
    docs = spark.createDataFrame([(*r, None, None, None, None) for r in rows], DOCS)
    assert by_text(tuple(r) for r in merkle.document_manifest(docs).collect()) == by_text(manifest(rows))
    changed = merkle.merkle_manifest(docs, tampered={"text": F.lit("other")}, touched=F.col("doc_id") == 9).where("not verified").select("doc_id").collect()
    assert [r[0] for r in changed] == [9]


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text)) if text else []


def contaminated(docs, items, window=10):
    known = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for at in range(len(w) - n + 1 if n and item is not None else 0):
            known.setdefault(tuple(w[at : at + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, own = words(text), set(), set()
        for n in {len(k) for k in known}:
            for at in range(len(w) - n + 1):
                if found := known.get(tuple(w[at : at + n])):
                    hit.update(range(at, at + n))
                    own |= found
        ids = sorted(map(str, own))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def test_decontamination_finds_every_window(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(30)] + ["naïve", "日本", "x9", "été"]
    draw = lambda n: " ".join(vocabulary[i] for i in rng.integers(0, len(vocabulary), n))
    items = [(i, draw(int(rng.integers(11, 40)))) for i in range(30)] + [(100, "one"), (101, "two Words"), (102, "a b c d e f"), (103, ""), (104, None), (None, "w1 w2"), (5, "again the same id here"), (105, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    docs = [(None, "no id: two words"), (1, ""), (2, None), (3, "ONE!"), (3, "ONE!"), (4, "w1 " * 5000), (5, "\u00a0one\u00a0"), (6, "two\x00words"), (7, "... --")]
    for i in range(300):
        text = draw(int(rng.integers(0, 60)))
        if i % 3 == 0:
            own = items[int(rng.integers(0, 30))][1].split()
            at = int(rng.integers(0, len(own)))
            text += " " + "-, ".join(own[at : at + 25]).upper().replace("É", "é").replace("Ï", "ï") + "; " + draw(5)
        docs.append((1000 + i, text))
    d = spark.createDataFrame([(*r, None, None, None, None, None, None, None) for r in docs], DOCS)
    b = spark.createDataFrame([(*r, "x", 1) for r in items], ITEMS)
    want = contaminated(docs, items)
    assert sum(r[5] for r in want) > 60
    for size in (32 << 20, 0):  # by broadcast and by shuffle
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", size)
        assert by_text(tuple(r)[:6] for r in decontamination.decontaminate(d, b).collect()) == by_text(want)
    assert by_text(tuple(r)[:6] for r in decontamination.decontaminate(d, b, window=6, shingle=2).collect()) == by_text(contaminated(docs, items, 6))


def test_decontamination_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b", None, None, None, None, None, None, None)], DOCS)
    none = spark.createDataFrame([], ITEMS)
    assert [tuple(r)[:6] for r in decontamination.decontaminate(d, none).collect()] == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    item = spark.createDataFrame([(9, "A b", None, None)], ITEMS)
    assert decontamination.decontaminate(d.limit(0), item).count() == 0
    assert decontamination.keep_clean(d, item).count() == 0 and decontamination.keep_clean(d, none).count() == 1


def negatives(rows):
    """rows of (vec_id, embedding, label): anchor by anchor."""
    fit = [(i, [int(np.floor(256 * x)) for x in v], (lab + 1) % 10 if i % 7 == 0 else lab) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, v, lab) in enumerate(fit):
        if i % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, same == lab) for b, (j, w, same) in enumerate(fit) if b != a and len(v) == len(w))
        for s, j, _ in [x for x in scored if x[2]][:5]:
            hits = [x for x in scored if not x[2] and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(i, j, k + 1, x[1], -s, -x[0]) for k, x in enumerate(hits)]
    return out


def test_hard_negatives(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(900):
        v = rng.normal(size=6) * float(rng.choice([0.01, 1, 1, 3, 40]))
        rows.append((i, np.abs(v).tolist() if i % 2 else v.tolist(), int(rng.integers(0, 3)) if i % 3 else 1))
    rows += [(i, rows[10][1], 1 + i % 2) for i in range(900, 960)]  # ties
    rows += [(None, [1.0] * 6, 1), (2000, None, 1), (2001, [1.0] * 5 + [None], 1), (2100, [float("nan")] * 6, 1), (2200, [1.0] * 6, None), (2300, [0.0] * 6, 1), (100, rows[100][1], 2), (100, [2.0] * 6, 1), (2400, [1.0, 2.0], 1), (2401, [1.0, 2.1], 1), (2402, [0.5, 0.9], 2), (2500, [], 1), (2503, [], 1), (2505, [], 2), (-700, [-1.0] * 6, 0), (2600, [float("inf")] * 6, 0)]
    v = spark.createDataFrame([(*r, "g", 1, 2) for r in rows], VECTORS)
    want = by_text(negatives(rows))
    assert by_text(tuple(r) for r in hard_negatives.mine_embeddings(v).collect()) == want
    for name, value in (("BLOCK", 50), ("QUERY_BLOCK", 3), ("LABEL_SAMPLE", 40), ("SAMPLE", 90)):
        monkeypatch.setattr(hard_negatives, name, value)
    assert by_text(tuple(r) for r in hard_negatives.mine_embeddings(v).collect()) == want
    monkeypatch.setattr(hard_negatives, "BROADCAST_ROWS", 0)
    assert by_text(tuple(r) for r in hard_negatives.mine_embeddings(v).collect()) == want
    assert hard_negatives.mine_embeddings(v.limit(0)).count() == 0


def test_coordinate_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(20, 16))
    x = centre[rng.integers(0, 20, 4000)] + 0.1 * rng.normal(size=(4000, 16))
    v = np.floor(256 * x / np.linalg.norm(x, axis=1)[:, None]).astype(np.int64)  # as in one bucket of lengths
    block = hard_negatives.Block(np.arange(4000), np.arange(4000), np.zeros(4000, int), v)
    tried = 0
    for q in v[:200]:
        least = int(0.9 * np.sort(v @ q)[-20])
        some = block.candidates(q.astype(float), float(np.sqrt((q * q).sum())), least)
        tried += len(v) if some is None else len(some)
        assert some is None or set(np.flatnonzero(v @ q >= least)) <= set(some.tolist())
    assert tried < 200 * len(v) // 4
