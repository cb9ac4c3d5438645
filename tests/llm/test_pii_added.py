"""Spans that the tagger of op2_pii adds, by length and place."""
import re
import time

import numpy as np
import pytest

from tempora.llm import pii


def _filler(r, n):
    return " ".join("".join(r.choice(list("abcdefghilmnorstu"), int(r.integers(2, 9)))) for _ in range(n))


@pytest.fixture(scope="module")
def model():
    r = np.random.default_rng(4)
    name = lambda n: "".join(r.choice(list("abcdefghilmnorstu"), n))
    texts = []
    for _ in range(400):
        card = "".join(str(x) for x in r.integers(0, 10, 15))
        card += next(str(x) for x in range(10) if pii.luhn(card + str(x)))
        data = [f"{name(5)}.{name(6)}@{name(7)}.com", ".".join(str(x) for x in r.integers(0, 256, 4)), card,
                f"+1 ({r.integers(200, 999)}) {r.integers(200, 999)}-{r.integers(1000, 9999)}"]
        texts.append(_filler(r, 15) + " " + f" {_filler(r, 10)} ".join(data) + " " + _filler(r, 15))
    windows, y = pii.labelled_windows(texts)
    tagger = pii.Tagger()
    tagger.fit(pii.classes(windows, pii.WINDOW), y)
    return tagger


def _address(n):
    local = ("first.last-" * 20)[:max(3, n // 2 - 3)].strip(".-") + "x"
    rest = n - len(local) - 3
    return f"{local} @ {('some-department.university.' * 20)[:rest - 4].strip('.-')}.org"


@pytest.mark.parametrize("n", [12, 20, 31, 32, 45, 63, 64, 100, 150, 200])
def test_added_address_at_every_offset(model, n):
    form = _address(n)
    assert not pii.base_spans(form) and pii.plausible(0, form) and abs(len(form) - n) <= 2
    r = np.random.default_rng(n)
    lead = _filler(r, 300)
    texts = [lead[:500 + k].rstrip() .ljust(500 + k, "x") + " " + form + " " + _filler(r, 60) for k in range(pii.STRIDE)]
    for t, spans in zip(texts, pii.spans_of(texts, model)):
        i = t.index(form)
        assert (0, i, i + len(form)) in spans, (n, i % pii.STRIDE, spans)


@pytest.mark.parametrize("form,kind", [("4111.1111.1111.1111", 2), ("(264) 555-5961", 3), ("10 . 20 . 30 . 40", 1)])
def test_added_numbers_at_every_offset(model, form, kind):
    r = np.random.default_rng(1)
    texts = [_filler(r, 120)[:500 + k].ljust(500 + k, "x") + " " + form + " " + _filler(r, 60) for k in range(pii.STRIDE)]
    assert not pii.base_spans(form)
    got = [(kind, t.index(form), t.index(form) + len(form)) in s for t, s in zip(texts, pii.spans_of(texts, model))]
    assert all(got), got


def test_stretches_hold_every_plausible_span():
    text = "a b.c-d @ e-f.gh 12 (34) 5+6-7 x . 1 . 2" + "y" * 300 + "@" + "z" * 300 + ".org 9"
    runs = pii.stretches(text)
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1 if i > 340 else min(len(text), i + 40)):
            s = text[i:j].strip()
            if s and re.fullmatch(r"[A-Za-z0-9._%+-]+ ?@ ?[A-Za-z0-9.-]+|[0-9 ().+-]*[0-9][0-9 ().+-]*", text[i:j]) and text[i:j] == s:
                assert any(a <= i and j <= b for a, b in runs), text[i:j]


def test_ips_are_the_patterns():
    r = np.random.default_rng(3)
    for _ in range(3000):
        t = "".join(r.choice(list("0123..9 a.")) for _ in range(int(r.integers(0, 60))))
        assert list(pii._ips(t)) == [m.span() for m in pii.IP.finditer(t)], t


def test_windows_cover_every_place_once():
    sizes = np.array([1, 63, 64, 65, 96, 97, 128, 129, 1000])
    of, start, lo, hi = pii.windows(sizes)
    for i, n in enumerate(sizes):
        seen = np.zeros(n + pii.WINDOW, int)
        for s, a, b in zip(start[of == i], lo[of == i], hi[of == i]):
            seen[s + a:s + b] += 1
            assert a == 0 or a >= (pii.WINDOW - pii.STRIDE) // 2
        assert (seen[:n] == 1).all(), n


@pytest.mark.parametrize("text", ["1" * 1_000_000, "12 345.6 (7) - 8+" * 60_000, "1.2.3.4.5 " * 100_000, "a" * 500_000 + "@" + "b" * 500_000,
                                  "a @ b.cd " * 110_000, "+1" * 500_000, "- " * 500_000 + "7"], ids=["digits", "table", "dotted", "run", "addresses", "plus", "dashes"])
def test_a_megabyte_of_anything(model, text):
    t = time.time()
    spans = pii.spans_of([text], model)[0]
    assert time.time() - t < 60
    assert all(0 <= i < j <= len(text) for _, i, j in spans)


def brute_spans(text, model):
    """Whole texts, window by window: tags from the middles, spans drawn out and reconciled one by one."""
    base = pii.base_spans(text)
    forms = {}
    for lo, hi in pii.stretches(text):
        lo, hi = max(0, lo - pii.STRIDE), min(len(text), hi + pii.STRIDE)
        n, tags, odds = hi - lo, [0] * (hi - lo), [0.0] * (hi - lo)
        starts = [0]
        while starts[-1] + pii.WINDOW < n:
            starts.append(starts[-1] + pii.STRIDE)
        for s in starts:
            path, score = model.decode(pii.classes([text[lo + s:min(hi, lo + s + pii.WINDOW)]], pii.WINDOW))
            for c in range(0 if s == 0 else 16, pii.WINDOW if s == starts[-1] else 48):
                if s + c < n:
                    tags[s + c], odds[s + c] = int(path[0, c]), float(score[0, c, path[0, c]] - score[0, c, 0])
        j = 0
        while j < n:
            if not tags[j]:
                j += 1
                continue
            k, e = (tags[j] - 1) // 2, j + 1
            while e < n and tags[e] == 2 + 2 * k:
                e += 1
            a, b = lo + j, lo + e
            while a < b and text[a].isspace():
                a += 1
            while b > a and text[b - 1].isspace():
                b -= 1
            if a < b and np.mean(odds[j:e]) >= pii.MARGIN:
                if k == 0 and text.find("@", max(0, a - 2), b + 2) >= 0:
                    a, b = pii.around(text, text.find("@", max(0, a - 2), b + 2))
                    b -= len(text[a:b]) - len(text[a:b].rstrip(".-"))
                elif k:
                    while a > 0 and text[a - 1] in "0123456789":
                        a -= 1
                    while b < len(text) and text[b] in "0123456789":
                        b += 1
                if pii.plausible(k, text[a:b]):
                    forms[a, b, k] = max(forms.get((a, b, k), -9e9), float(np.mean(odds[j:e])))
            j = e
    taken = list(base)
    for _, a, b, k in sorted((-o, a, b, k) for (a, b, k), o in forms.items()):
        if all(b <= i or a >= j for _, i, j in taken):
            taken.append((k, a, b))
    return sorted(taken)


def test_spans_against_brute_force(model):
    r = np.random.default_rng(11)
    kinds = ["x.y @ host.org", "4111.1111.1111.1111", "(264) 555-5961", "10 . 20 . 30 . 40", "a.b@c.de", "1.2.3.4", "+1 555 123 4567", "77", "3 - 4", "me @ you", "555-123-9876"]
    texts = ["".join(_filler(r, int(r.integers(0, 12))) + " " + r.choice(kinds) + r.choice([" ", ", ", "\n", "-"]) for _ in range(int(r.integers(0, 9)))) for _ in range(80)]
    texts += ["", " ", "@", "9", _address(180) + " 1 2 3"]
    got = pii.spans_of(texts, model)
    want = [brute_spans(t, model) for t in texts]
    assert sum(len(w) for w in want) > sum(len(pii.base_spans(t)) for t in texts) + 50
    assert sum(g != w for g, w in zip(got, want)) == 0
