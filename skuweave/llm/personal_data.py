"""Personal data: base patterns, and a linear-chain conditional random field over word shapes that adds spans."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skuweave.llm.common import hold, small_batches

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *[f"{p}-{k}" for k in KINDS for p in "BI"])

#: The labelled table: [kind|span] marks a span. A user's own table has the same form.
LABELLED = (
    "please write to [email|anna.berg@mail.example.com] before friday",
    "please write to [email|anna at mail dot example dot com] before friday",
    "contact: [email|j.doe (at) example.org] for details",
    "contact [email|j.doe (at) example (dot) org] for details.",
    "mail me, [email|bob [at] host [dot] net], thanks",
    "mail me, [email|bob_k[at]host[dot]net], thanks",
    "reach [email|maria AT uni DOT edu] or come by",
    "her address is [email|k.lee@corp.example.co] now",
    "the email is [email|sam at example dot com].",
    "Email: [email|tom at web dot de], room 12",
    "he stayed at home and looked at the dot on the wall",
    "look at page 12 at noon at the latest",
    "we met at the station. at nine they left at once",
    "a red dot and a blue dot at the end",
    "They are at work at the moment, at least today.",
    "call [phone|+1 (555) 010-2233] after six",
    "call [phone|(555) 010-2233] after six",
    "phone [phone|555-010-2233], or fax [phone|555-010-2234].",
    "Tel: [phone|555.010.2233] (office)",
    "tel [phone|0171 555 0102] evenings only",
    "Phone: [phone|0049 30 5550102], ask for Eva",
    "my mobile is [phone|+44 20 5550 1234] now",
    "ring [phone|(030) 555-0199] any time",
    "fax [phone|1-555-010-7788] works too",
    "the number is [phone|555-010-9911] at home",
    "from host [ip|10.20.30.40] came nothing",
    "address [ip|192.168.1.77], port 80",
    "ip [ip|2001:db8::1] answered",
    "server [ip|fe80::1ff:fe23:4567:890a] is down",
    "The ping to [ip|172.16.0.9] failed.",
    "paid with [card|4111 1111 1111 1111] today",
    "card [card|4111-1111-1111-1111] was used",
    "card number [card|4111.1111.1111.1111] expired",
    "visa [card|4012.8888.8888.1881], thanks",
    "the card [card|5500005555555559] is lost",
    "on 2024-01-15 we paid 12.50 for 3 books",
    "Licensed under the Apache License, Version 2.0.",
    "version 2.0.1 of 12/05/2021 has 1,024 lines",
    "at 10:30 on 15.01.2024 there were 250 people",
    "see chapter 4, page 123 and table 7.2",
    "item 12345 costs $19.99 or 20% less",
    "id 9233a8ecf7c5b09fe5949719b6b82bc439e9329b token 77",
    "THE BIG SALE!! BUY NOW!! 50% OFF!!",
    "a | b | c | 12 | 13 | 14",
    "name*** of*** the&&& thing### is$$$ here%%%",
    "open https://www.example.com/a/b?c=1 in a browser",
    "x = y[3] + z(4) - 5 # note",
    "<p>some html</p> and &amp; more",
    "The quick brown fox jumps over the lazy dog.",
    "It was, as they say, a long day; and nothing happened.",
    "Eine lange Geschichte, die niemand hören will.",
    "C'est la vie, dit-il en partant avec l'ami.",
    "el perro come en la casa de su tía",
    "one two three four five six seven eight nine ten",
    "(in brackets) \"and quotes\" - with dashes -",
    "10 20 30 40 50 60 70 80 90 100",
    "room 101, floor 3, building 12b, 1998-2004",
    "score 3-2, ratio 1:2, range 10-20, size 5x7",
    "write [email|lena.k at post dot example dot net] today",
    "my mail: [email|tom_b at corp dot example dot org].",
    "or use [email|info(at)example.org] instead",
    "send it to [email|sales [at] shop.example.com] please",
    "so [email|pat.ng AT example DOT com] will answer",
    "ask [email|ida at example dot co dot nz] for it",
    "dial [phone|555 0133] first",
    "ring [phone|01632 960983] today",
    "ask [email|rita at example dot org] about it",
    "you may mail [email|kim at provider dot net], or not",
    "tel [phone|040 555 21 43], only in the morning",
    "answer to [email|k.lee[at]corp.example] only",
    "or [email|jan(at)post.example.net], if you must",
    "call us on [phone|0800 555 0166] for free",
    "tel. [phone|030 555 01 77] or come by",
    "cell [phone|555-0144] after nine",
    "Phone [phone|(0221) 5550 188], second floor",
    "fax: [phone|+49-30-555-0112]",
    "her number [phone|07700 900 123] is new",
    "reach me at [phone|555 555 0123], any day",
    "node [ip|2001:db8:85a3::8a2e:370:7334] joined",
    "from [ip|2001:db8:0:42::9] to [ip|fe80::1] again",
    "gateway [ip|10.0.0.254] replied to [ip|10.0.0.7]",
    "Visa [card|4012 8888 8888 1881], due in May",
    "mastercard [card|5500-0000-0000-0004] was charged",
    "card no. [card|3782 822463 10005] is blocked",
    "at 12:30:45 on 2024-03-05T10:20:30 it stopped",
    "call 20 people and ring 3 bells at 10 or 11",
    "phone 3 of 12 rang at room 404 twice",
    "the server has 16 cores, 64 GB and 2 disks",
    "ip rights and card games are at page 21",
    "order 2024-000123-77 of 1998-2004 costs 1,250.00",
    "isbn 978-0-306-40615-7 and issn 1234-5679",
    "at home dot matrix printers dot the floor",
    "look at the map at dawn, not at night.",
    "a::b and c::d are names in std::vector<int>",
    "lines 100 200 300 400 and 500 600 700 800",
    "in 2019 2020 2021 2022 sales were 10 20 30 40",
    "hash 5f4dcc3b5aa765d61d8327deb882cf99 of 32 signs",
    "mac 00:1a:2b:3c:4d:5e has six parts",
    "ratio 3:4:5 and time 01:02:03 are fine",
    "call f(x) at (10, 20) with (30, 40) twice",
    "12 34 56 78 90 12 are numbers of a game",
    "version 10.20.30 and build 4.5.6.78901 shipped",
)
#: Words that are features themselves, beside the shapes.
CUES = ("at", "dot", "(at)", "(dot)", "[at]", "[dot]", "phone", "tel", "tel:", "phone:", "fax", "call", "mobile", "ring", "card", "visa", "ip", "server", "email", "email:", "version", "page", "dial", "cell", "number", "mastercard", "host", "isbn", "hash", "mac")

SPELT = frozenset(f"={c}" for c in CUES[:6])
_TAIL = re.compile(r"[.,;:!?]+$")


def shape(word: str) -> str:
    """x for runs of small letters, X for capitals, d1..d4 or d+ for digits by their number; other signs as they are."""
    low = word.lower()
    cue = _TAIL.sub("", low) if low not in CUES else low
    if cue in CUES:
        return f"={cue}"
    out = []
    for kind, run in itertools.groupby(word, lambda c: "d" if c.isdigit() else ("X" if c.isupper() else "x") if c.isalpha() else c):
        n = sum(1 for _ in run)
        out.append(f"d{n if n < 5 else '+'}" if kind == "d" else kind)
    text = "".join(out).replace("Xx", "x") if word.isalpha() else "".join(out)
    return text[:40]


PLAIN = "plain"
#: Words that no address has as a part of its own.
ARTICLES = frozenset(("a", "an", "the", "this", "that", "it", "all", "my", "his", "her", "our", "their"))
NEVER = -1e4
_COUNTS = re.compile(r"d[0-9+]")
_HEX_COLON = re.compile(r"[0-9a-fA-F]{0,4}(?::[0-9a-fA-F]{0,4}){2,7}")


def features(word: str, beside: int) -> tuple[str, ...]:
    """What the chain sees of a word: its shape, and parts of it that unseen shapes share with seen ones.

    beside: 1 next to a spelt-out sign of an address, 2 in a run of words with "at" and "dot" two places on. A word of
    letters has its case and closing sign only; without such neighbours it is PLAIN: no datum of any kind has such a
    word, so it is outside whatever stands around it.
    """
    s = shape(word)
    if s[0] == "=":
        return ("", s, f"form {beside == 2}", f"form {beside == 2} {s}") if s in SPELT else (PLAIN, "", s)
    core = _TAIL.sub("", word)
    if not core:
        return (PLAIN, "", f"end {word[:1]}")
    end = f"end {word[len(core):][:1]}" if len(core) < len(word) else "end"
    if core.isalpha():
        beside = 0 if core.lower() in ARTICLES else beside
        kind = "x" if core.islower() else "X" if core.isupper() else "Xx" if core[0].isupper() and core[1:].islower() else "mixed"
        return ("", f"beside {kind}", f"form {beside == 2}", f"form {beside == 2} letters", end) if beside else (PLAIN, "", f"letters {kind}", end)
    digits, loose = sum(c.isdigit() for c in core), _COUNTS.sub("d", shape(core))
    size = "0" if not digits else "1-2" if digits < 3 else str(digits) if digits < 5 else "5-6" if digits < 7 else "7-8" if digits < 9 else "9-11" if digits < 12 else "12-15" if digits < 16 else "16+"
    out = ["", f"shape {s}", f"loose {loose}", f"digits {size}", f"digits {size} {'only' if core.isdigit() else 'mixed'}", end]
    out += [f"has {c}" for c in "@:()[]_-+/" if c in core]
    out += [f"dots {min(core.count('.'), 4)}"] if "." in core else []
    out += ["hex parts" + (" gap" if "::" in core else "")] if _HEX_COLON.fullmatch(core) else []
    out += ["hidden at"] if _HIDDEN.search(core) else []
    out += ["date or time"] if _DATE.fullmatch(core) else []
    return (*out, *(("beside sign", f"form {beside == 2}") if beside else ()))


_HIDDEN = re.compile(r"\w[(\[](?:at|AT|dot|DOT)[)\]]\w")
_DATE = re.compile(r"[0-9]{1,4}([-./])[0-9]{1,2}\1[0-9]{1,4}|[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?|[0-9]{4}-[0-9]{2}-[0-9]{2}T\S+")


def besides(spelt: list[str | None]) -> list[int]:
    """For each word of a line its neighbourhood of spelt-out signs ("at", "dot" or None for each word)."""
    out = [int(bool((i and spelt[i - 1]) or (i + 1 < len(spelt) and spelt[i + 1]))) for i in range(len(spelt))]
    for i, sign in enumerate(spelt):
        if sign == "at" and i + 2 < len(spelt) and spelt[i + 2] == "dot":
            j = i + 3
            while j + 1 < len(spelt) and spelt[j + 1] == "dot":
                j += 2
            for k in range(max(0, i - 1), min(len(spelt), j + 1)):
                out[k] = 2
    return out


def sign_of(word: str) -> str | None:
    s = shape(word)
    return s.strip("=()[]") if s in SPELT else None


def seen_in(words: list[str]) -> list[tuple[str, ...]]:
    """The features of the words of a line."""
    return [features(w, b) for w, b in zip(words, besides([sign_of(w) for w in words]), strict=True)]


def parse_labelled(line: str) -> tuple[list[str], list[int]]:
    """Words and labels of one line of the labelled table."""
    words, labels = [], []
    for m in re.finditer(r"\[(email|ip|card|phone)\|((?:[^\[\]]|\[[a-z]+\])+)\](\S*)|(\S+)", line):
        if m[1]:
            own = (m[2] + (m[3] or "")).split()
            words += own
            labels += [LABELS.index(f"{'I' if k else 'B'}-{m[1]}") for k in range(len(own))]
        else:
            words.append(m[4])
            labels.append(0)
    return words, labels


#: Kinds of words that a worker knows at most; beyond that its memory starts afresh.
KINDS_HELD = 50_000


@dataclass
class ChainModel:
    """Scores of a label by the features of the word, of those before and after it, and the label before it."""

    weights: dict[str, np.ndarray]  # feature -> (now, before, after) x labels
    move: np.ndarray  # (labels, labels)
    start: np.ndarray
    of_word: dict[str, int] = field(default_factory=dict, repr=False)
    kinds: dict[tuple, int] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.forget()

    def forget(self) -> None:
        """Empties the memory of words; kind 0 is what is outside a line."""
        self.of_word.clear()
        self.kinds.clear()
        self.scores = np.zeros((1024, 3, len(LABELS)))
        self.kind(("edge",))

    def kind(self, seen: tuple[str, ...]) -> int:
        """The number of a set of features; its scores are summed once."""
        k = self.kinds.get(seen)
        if k is None:
            k = self.kinds[seen] = len(self.kinds)
            if k == len(self.scores):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            for f in seen:
                if f in self.weights:
                    self.scores[k] += self.weights[f]
            if seen[0] == PLAIN:
                self.scores[k, 0, 1:] = NEVER
        return k

    def ids(self, words: list[str]) -> list[int]:
        hold(self.of_word)
        if len(self.of_word) > 200_000 or len(self.kinds) > KINDS_HELD:
            raise RuntimeError("the memory of words must be emptied between batches")
        found = list(map(self.of_word.get, words))
        if None in found:
            for w in words:
                if w not in self.of_word:
                    # Negative: a spelt-out sign of an address.
                    k = self.kind(features(w, 0))
                    self.of_word[w] = -k if sign_of(w) else k
            found = [self.of_word[w] for w in words]
        if min(found, default=0) >= 0:
            return found
        near = besides([sign_of(w) if k < 0 else None for w, k in zip(words, found, strict=True)])
        return [self.kind(features(w, b)) if b else abs(k) for w, k, b in zip(words, found, near, strict=True)]

    def begin_batch(self) -> None:
        """Numbers of kinds are good until the next call."""
        if len(self.of_word) > 150_000 or len(self.kinds) > KINDS_HELD // 2 or not self.kinds:
            self.forget()

    def viterbi(self, lines: list[list[int]]) -> list[np.ndarray]:
        """The best labels of each line of shape numbers, many lines at a time: step t for all lines longer than t."""
        order = sorted(range(len(lines)), key=lambda i: -len(lines[i]))
        size = np.array([len(lines[i]) for i in order])
        out: list[np.ndarray] = [np.zeros(0, int)] * len(lines)
        if not len(size) or not size[0]:
            return out
        flat = np.concatenate([np.array([0, *lines[i], 0]) for i in order])
        first = np.concatenate([[0], np.cumsum(size + 2)[:-1]]) + 1
        score = self.scores[flat, 0] + self.scores[np.roll(flat, 1), 1] + self.scores[np.roll(flat, -1), 2]
        live = np.searchsorted(-size, -np.arange(size[0]), "left")  # lines longer than t
        best = self.start + score[first[: live[0]]]
        back, ends = [], np.zeros((len(size), len(LABELS)))
        ends[: live[0]] = best
        for t in range(1, size[0]):
            k = live[t]
            both = best[:k, :, None] + self.move[None]
            frm = both.argmax(1)
            best = np.take_along_axis(both, frm[:, None], 1)[:, 0] + score[first[:k] + t]
            back.append(frm.astype(np.int8))
            ends[:k] = best
        last = ends.argmax(1)
        for r, i in enumerate(order):
            n = size[r]
            path = np.zeros(n, int)
            if n:
                path[-1] = last[r]
                for t in range(n - 1, 0, -1):
                    path[t - 1] = back[t - 1][r, path[t]]
            out[i] = path
        return out


def fit_chain(labelled: tuple[str, ...] | list[str] = LABELLED, rounds: int = 400, rate: float = 0.1, l2: float = 2e-4) -> ChainModel:
    """Maximum likelihood by Adam with forward and backward sums over all lines of the small table at once."""
    data = [(seen_in(words), labels) for words, labels in map(parse_labelled, labelled)]
    names = ["edge", *sorted({f for line, _ in data for seen in line for f in seen})]
    number = {f: i for i, f in enumerate(names)}
    n, width, k = len(data), max(len(w) for w, _ in data), len(LABELS)
    most = max(len(seen) for line, _ in data for seen in line)
    # x: the numbers of each place's features; the last row of weights stays 0.
    x, y, mask = np.full((n, width + 2, most), len(names)), np.zeros((n, width), int), np.zeros((n, width), bool)
    for i, (line, labels) in enumerate(data):
        x[i, [0, len(line) + 1], 0] = 0
        for j, seen in enumerate(line):
            x[i, j + 1, : len(seen)] = [number[f] for f in seen]
        y[i, : len(line)], mask[i, : len(line)] = labels, True
    size = mask.sum(1)
    allowed = np.array([[not b.startswith("I-") or a[2:] == b[2:] for b in LABELS] for a in LABELS])
    begin = np.array([not b.startswith("I-") for b in LABELS])
    never = NEVER
    outside = np.array([[[0.0] + [never] * (k - 1) if j < len(line) and line[j][0] == PLAIN else [0.0] * k for j in range(width)] for line, _ in data])
    p = [np.zeros((len(names) + 1, k)) for _ in range(3)] + [np.zeros((k, k)), np.zeros(k)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    rows = np.arange(n)
    hot = np.eye(k)[y] * mask[..., None]
    sides = (x[:, 1:-1], x[:, :-2], x[:, 2:])
    for t in range(1, rounds + 1):
        e = sum(a[cols].sum(2) for a, cols in zip(p[:3], sides, strict=True)) + outside
        move, start = np.where(allowed, p[3], never), np.where(begin, p[4], never)
        fwd = np.zeros((n, width, k))
        fwd[:, 0] = start + e[:, 0]
        for s in range(1, width):
            fwd[:, s] = np.logaddexp.reduce(fwd[:, s - 1, :, None] + move, axis=1) + e[:, s]
        z = np.logaddexp.reduce(fwd[rows, size - 1], axis=1)
        bwd = np.zeros((n, width, k))
        for s in range(width - 2, -1, -1):
            step = np.logaddexp.reduce(move[None] + (e[:, s + 1] + bwd[:, s + 1])[:, None, :], axis=2)
            bwd[:, s] = np.where(mask[:, s + 1, None], step, 0.0)
        post = np.exp(np.minimum(fwd + bwd - z[:, None, None], 0)) * mask[..., None]
        g_e = hot - post
        grad = [np.zeros_like(a) for a in p]
        for a, cols in zip(grad, sides, strict=False):
            np.add.at(a, cols[mask], g_e[mask][:, None, :])
            a[-1] = 0
        pair = np.exp(np.minimum(fwd[:, :-1, :, None] + move + (e + bwd)[:, 1:, None, :] - z[:, None, None, None], 0)) * mask[:, 1:, None, None]
        grad[3] = np.einsum("nsa,nsb->ab", hot[:, :-1], hot[:, 1:]) - pair.sum((0, 1))
        grad[4] = hot[:, 0].sum(0) - post[:, 0].sum(0)
        for i in range(5):
            g = grad[i] / n - l2 * p[i]
            m[i], v[i] = 0.9 * m[i] + 0.1 * g, 0.999 * v[i] + 0.001 * g * g
            p[i] = p[i] + rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    weights = {f: np.stack([p[0][i], p[1][i], p[2][i]]) for f, i in number.items()}
    return ChainModel(weights, np.where(allowed, p[3], never), np.where(begin, p[4], never))


#: What a line of PLAIN words does not have: other signs, digits, a sign inside a word, a spelt-out sign of an address.
_ODD = re.compile(r"[^\w\s.,;:!?]|[\d_]|[.,;:!?]\S")
_AT_DOT = re.compile(r"\b(?:at|dot)\b", re.IGNORECASE)


_EMAIL_TAIL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Leftmost non-overlapping matches of each kind's pattern, without those that fail its check."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    at, end = text.find("@"), 0
    while at >= 0:
        a = at
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        m = _EMAIL_TAIL.match(text, at + 1) if a < at else None
        if m:
            end = m.end()
            out["email"].append((a, end))
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        if "." in text:
            out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m.group()) <= 15]
    return out


def _tighten(text: str, a: int, b: int) -> tuple[int, int]:
    """Without signs around the span; a bracket stays if its partner is inside."""
    while b > a and (text[b - 1] in ".,;:!?\"'" or text[b - 1] in ")]" and text[a:b].count("([)]"["([)]".index(text[b - 1]) - 2 if text[b - 1] == ")" else 1]) < text[a:b].count(text[b - 1])):
        b -= 1
    while a < b and (text[a] in "\"'," or text[a] in "([" and text[a:b].count(")" if text[a] == "(" else "]") < text[a:b].count(text[a])):
        a += 1
    return a, b


def find_spans(texts: list[str], model: ChainModel) -> list[tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]]:
    """For each text: its base spans, and all spans (kind, start, end) sorted by kind and start.

    The chain labels line by line. Its spans are added where they overlap no base span.
    """
    base = [base_spans(t) for t in texts]
    model.begin_batch()
    jobs, where = [], []
    for k, t in enumerate(texts):
        if not _ODD.search(t) and not _AT_DOT.search(t):
            continue
        at = 0
        for line in t.split("\n"):
            if line and (_ODD.search(line) or _AT_DOT.search(line)):
                words = line.split()
                jobs.append(model.ids(words))
                where.append((k, at, line))
            at += len(line) + 1
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for path, (k, at, line) in zip(model.viterbi(jobs), where, strict=True):
        if not path.any():
            continue
        places = [m.span() for m in re.finditer(r"\S+", line)]
        i = 0
        while i < len(path):
            if path[i] and LABELS[path[i]][0] == "B":
                j = i + 1
                while j < len(path) and LABELS[path[j]] == f"I-{LABELS[path[i]][2:]}":
                    j += 1
                a, b = _tighten(line, places[i][0], places[j - 1][1])
                added[k].append((LABELS[path[i]][2:], at + a, at + b))
                i = j
            else:
                i += 1
    out = []
    for text, own, more in zip(texts, base, added, strict=True):
        taken = sorted(s for spans in own.values() for s in spans)
        spans = [(k, a, b) for k in KINDS for a, b in own[k]]
        for kind, a, b in more:
            if a < b and believable(kind, text[a:b]) and not any(x < b and a < y for x, y in taken):
                spans.append((kind, a, b))
        spans.sort(key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
        out.append((own, spans))
    return out


_CARD_SIGNS = re.compile(r"[0-9][0-9 ./_\u2010-\u2015\u00a0-]*[0-9]")
#: Characters of the longest datum that the chain may add.
LONGEST = 120


def believable(kind: str, span: str) -> bool:
    """An added span must have what no such datum lacks."""
    if len(span) > LONGEST:
        return False
    digits = sum(c.isdigit() for c in span)
    if kind == "email":
        return bool(re.search(r"\w.*(?:@|\bat\b).+?(?:\.\w|\bdot\b.*\w)", span, re.IGNORECASE))
    if kind == "ip":
        parts = span.split(".")
        return len(parts) == 4 and all(p.isdecimal() and int(p) < 256 for p in parts) or bool(_HEX_COLON.fullmatch(span))
    if kind == "phone":
        return 7 <= digits <= 15
    # A card has digits and signs between them only: hex strings hold numbers that pass Luhn by chance.
    return 12 <= digits <= 19 and bool(_CARD_SIGNS.fullmatch(span)) and luhn("".join(c for c in span if "0" <= c <= "9"))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first and longest counts."""
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
            end = b
    return "".join(out) + text[end:]


@lru_cache(maxsize=2)
def model_of(labelled: tuple[str, ...]) -> ChainModel:
    return fit_chain(labelled)


def personal_data(docs: DataFrame, labelled: tuple[str, ...] = LABELLED, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """docs -> (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans[, redacted]) for every whole text.

    The counts and base_sha256 are of the base patterns' spans; spans also has those that the chain model adds, as
    kind:start:end in code points, end exclusive. The model is fitted once from the small labelled table. Null or
    empty text has no spans. Null ids and repeated rows are kept; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(model_of(tuple(labelled)))
    fields = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string" + (", redacted string" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 256):
                batch = whole.slice(lo, 256)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                got = find_spans(texts, model.value)
                cols = [batch.column(0), *[pa.array([len(base[k]) for base, _ in got], pa.int64()) for k in KINDS]]
                digests = [hashlib.sha256(",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in base[k]).encode()).hexdigest() for base, _ in got]
                cols += [pa.array(digests, pa.string()), pa.array([",".join(f"{k}:{a}:{b}" for k, a, b in spans) for _, spans in got], pa.string())]
                if with_text:
                    cols.append(pa.array([redact(t, spans) for t, (_, spans) in zip(texts, got, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[f.split()[0] for f in fields.split(", ")])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, fields)


def redact_documents(docs: DataFrame, labelled: tuple[str, ...] = LABELLED, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns of docs with spans replaced by their kinds and length_col set anew; null text stays null."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(model_of(tuple(labelled)))

    @F.pandas_udf("string")
    def clean(texts):
        own = [t if isinstance(t, str) else None for t in texts]
        spans = iter(find_spans([t for t in own if t is not None], model.value))
        return texts.__class__([None if t is None else redact(t, next(spans)[1]) for t in own], index=texts.index, dtype=object)

    out = docs.withColumn(text_col, clean(F.col(text_col).cast("string")))
    return out.withColumn(length_col, F.length(text_col).cast("long")) if length_col in docs.columns else out
