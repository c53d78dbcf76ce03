"""License scan against brute force over windows."""

import random
import re

import pytest

from barloom.llm import licenses as L

SCHEMA = "doc_id bigint, text string, grams string, license string, windows int"


def brute(rows, templates):
    out = set()
    for i, text in rows:
        w = L._plain_words(text or "")
        for name, t in templates.items():
            tw = L._plain_words(t)
            grams = {tuple(tw[k : k + 5]) for k in range(max(1, len(tw) - 4))}
            length, step = L.window_of(len(tw))
            span = max(length - 4, 1)
            own = [tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))] if w else []
            found = {}
            for at in range(0, len(own), step):
                n = len(grams.intersection(own[at : at + span]))
                if n >= len(grams) * L.LEAST:
                    found[at] = n
            if found:
                out.add((i, name, max(found.values()), len(grams), len(found), min(found)))
    return out


def run(spark, rows, templates=None):
    df = spark.createDataFrame([(i, t, "g", "l", 1) for i, t in rows], SCHEMA)
    return [tuple(r) for r in L.scan(df, templates).collect()]


def test_equals_brute_force(spark):
    r = random.Random(6)
    filler = "the of and software license permission this work under any copy granted released version".split()
    rows = []
    for k in range(120):
        parts = []
        for _ in range(r.randrange(0, 4)):
            parts.append(" ".join(r.choices(filler, k=r.randrange(0, 60))))
            w = re.sub(r"\s+", " ", r.choice(list(L.TEMPLATES.values()))).split(" ")
            for _ in range(r.randrange(0, 3)):
                w[r.randrange(len(w))] = r.choice(filler)
            parts.append(" ".join(w))
        rows.append((k, "\n".join(parts)))
    rows += [(500, None), (501, ""), (502, "!!"), (503, "license"), (None, L.TEMPLATES["mit"].upper()), (504, "filler word " * 30_000 + L.TEMPLATES["isc"])]
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == brute(rows, L.TEMPLATES)
    assert len({g[1] for g in got}) == len(L.TEMPLATES)


def test_own_templates_repeated_rows_and_empty(spark):
    own = {"two": "hello world", "none": " ", "six": "one two three four five six"}
    rows = [(1, "Hello, world"), (1, "Hello, world"), (2, "say hello world now please again"), (3, "zero one two three four five six seven")]
    assert sorted(run(spark, rows, own)) == sorted(brute([rows[0], *rows[2:]], {k: own[k] for k in ("two", "six")}))
    assert run(spark, []) == [] and run(spark, rows, {}) == []


@pytest.mark.parametrize("text", L.TEMPLATES.values())
def test_needed_words_are_in_every_match(text):
    w = L._plain_words(text)
    grams = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    without = [g for g in grams if not L.needed_words(text).intersection(g)]
    assert len(without) < len(grams) * L.LEAST


def test_edited_notices_are_found_at_every_offset(spark):
    """A run of foreign words in the middle of a notice, at all start offsets of the window grid."""
    rows, want = [], set()
    for name, foreign in (("gpl-2.0", 12), ("gpl-3.0", 8), ("mpl-2.0", 12), ("isc", 12)):
        w = L._plain_words(L.TEMPLATES[name])
        edited = w[: len(w) // 2] + [f"foreign{k}" for k in range(foreign)] + w[len(w) // 2 :]
        for offset in range(L.window_of(len(w))[1] + 2):
            rows.append((len(rows), " ".join([f"before{k}" for k in range(offset)] + edited + [f"after{k}" for k in range(90)])))
            want.add((rows[-1][0], name))
    got = L.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert want <= {(r.doc_id, r.license) for r in got}
