"""License scans against a brute force that slides every template over every text."""
import re
from collections import Counter

import pytest

from tempora.llm import licenses as lic

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
WORD = re.compile(lic.WORD)


def brute(rows, templates=lic.TEMPLATES):
    out = Counter()
    for doc_id, text in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        places, base, labels, best = [], set(), set(), 0.0
        for t in templates:
            want = t.text.split()
            votes = [(d, p) for d in range(len(w) - t.k + 1) for p in range(len(want) - t.k + 1) if w[d:d + t.k] == want[p:p + t.k]]
            for band in {b for d, p in votes for b in ((d - p,) if not t.slack else ((d - p) // t.slack, (d - p) // t.slack + 1))}:
                mine = {p for d, p in votes if (d - p == band if not t.slack else (d - p) // t.slack in (band - 1, band))}
                share = len({x for p in mine for x in range(p, p + t.k)}) / len(want)
                best = max(best, share)
                if share >= t.need:
                    labels.add(t.label)
                    if t.base:
                        places.append(band)
                        base.add(t.label)
        for t in templates:  # the contract's places, without votes
            if t.base:
                n = len(t.text.split())
                assert sum(w[i:i + n] == t.text.split() for i in range(len(w))) == 0 or t.label in base
        out[(doc_id, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best)] += 1
    return out


def run(spark, rows, schema="doc_id long, text string", **how):
    return Counter(tuple(r) for r in lic.scan(spark.createDataFrame(rows, schema), **how).select(*COLUMNS).collect())


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)"
TEXTS = [None, "", " .,; ", "MIT License", "the mit-license and MIT, License; mit", "GNU General Public License, version 3", "general public general public license",
         "Apache\nLicense Apache License", "mit", MIT, "x " * 40 + MIT + " y" * 9, MIT.replace("free of charge", "free of any charge"),
         MIT.replace("obtaining a copy of this software and associated documentation files", ""), "Licensed under CC BY-NC 4.0", "licensed under cc by", "mit licenİse",
         "miK license Kelvin", "mıt license", "MIT Licensé", "mitt license mit license", "İmit license", "licensed under the apache license 2 0"]


def test_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "mit license"), (3, "MIT License"), (3, "MIT License")]
    assert run(spark, rows) == brute(rows)


def test_places_are_the_contracts(spark):
    rows = [(i, " ".join(["mit", "license", "general", "public", "apache", "x"][(i * j * j + j) % 6] for j in range(60))) for i in range(40)]
    got = run(spark, rows)
    for doc_id, text in rows:
        w = text.split()
        places = [i for p in ("mit license", "apache license", "general public license") for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        row = next(r for r in got if r[0] == doc_id)
        assert row[2:5] == (len(places), min(places, default=None), max(places, default=None))


def test_long_text_and_many_copies(spark):
    long = "word " * 30_000 + "mit license " * 2_000 + MIT
    rows = [(1, long)] + [(i, "Released under the MIT License.") for i in range(300)]
    got = run(spark, rows)
    assert sum(got.values()) == 301
    assert got[(5, 5, 1, 3, 3, "mit", "mit", 1.0)] == 1
    row = next(r for r in got if r[1] > 30_000)
    assert row[2:5] == (2_000, 30_000, 33_998)


@pytest.mark.parametrize("schema", ["doc_id long, text string, rid long, pos int, words string, label string, k int"])
def test_clashing_columns_and_empty_table(spark, schema):
    assert not run(spark, [], schema)
    assert run(spark, [(1, "mit license", 1, 2, "w", "l", 3)], schema) == brute([(1, "mit license")])


def test_no_python_worker(spark):
    plan = lic.scan(spark.createDataFrame([(1, "mit license")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_templates_are_checked(spark):
    with pytest.raises(ValueError):
        lic.positions(spark, [lic.Template("x", "Not lower", 2)])
    with pytest.raises(ValueError):
        lic.positions(spark, [lic.Template("x", "a b c " * 40_000 + "d", 2)])
