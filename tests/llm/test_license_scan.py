"""Operator 1: planted notices, ordinary text, odd inputs, and the table's licence lines by search."""
import re

import pytest

from ledgerline.llm import license_scan as L
from ledgerline.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def scanner(spark):
    return L.train(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))


def scanned(spark, scanner, rows):
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id long, text string, families string, gram double")
    return sorted(L.scan(df, scanner).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))


def test_every_template_names_its_family_whole_or_cut(spark, scanner):
    shown = [(f, t) for f, ts in L.TEMPLATES.items() for t in ts if len(t.split()) > 5]
    for cut in (lambda t: t, lambda t: "Notice\n\n" + t.upper(), lambda t: " ".join(w for i, w in enumerate(t.split()) if i != 2)):
        rows = scanned(spark, scanner, [(i, cut(t)) for i, (_, t) in enumerate(shown)])
        right = sum(r.families == [f] for r, (f, _) in zip(rows, shown))
        assert right >= 0.85 * len(shown), [(f, r.families) for r, (f, _) in zip(rows, shown) if r.families != [f]]


def test_ordinary_text_has_none_and_odd_inputs_are_defined(spark, scanner):
    rows = scanned(spark, scanner, [
        (1, None), (2, ""), (3, " \n\n "), (4, "\n".join(L.ORDINARY)), (5, "word " * 30000), (6, "Released under the MIT License.\nfoo\nLicensed under CC BY-SA 4.0."),
        (6, "Released under the MIT License.\nfoo\nLicensed under CC BY-SA 4.0."), (None, "Released under the MIT License.")])
    assert [(r.doc_id, r.n_paragraphs, r.n_licensed, r.families) for r in rows] == [
        (1, 0, 0, []), (2, 0, 0, []), (3, 0, 0, []), (4, len(L.ORDINARY), 0, []), (5, 1, 0, []), (6, 3, 2, ["CC-BY-SA", "MIT"]), (6, 3, 2, ["CC-BY-SA", "MIT"]),
        (None, 1, 1, ["MIT"])]
    assert [(f.place, f.family) for f in rows[5].found] == [(0, "MIT"), (2, "CC-BY-SA")]
    assert all(0 <= r.best <= 1 for r in rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.scan(empty, L.train(empty)).count() == 0


def test_query_finds_the_tables_notices_without_python(spark):
    df = queries.op1_license_scan(spark, SF)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    notice = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
              "GPL": "licensed under the GNU General Public License, version 3.", "CC-BY-NC": "Licensed under CC BY-NC 4.0."}
    want = {r.doc_id: ",".join(sorted(f for f, n in notice.items() if n in r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r.doc_id: r.families for r in df.collect()} == want


MIT_WRAPPED = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0""".replace("\n", " ")


def filler(n, salt=0):
    return " ".join(f"{w}{(i + salt) % 7}" if i % 3 else w for i, w in zip(range(n), "the river and of stone to hill with cloud in meadow for song".split() * n))


def test_notices_wrapped_inside_long_lines_and_side_by_side(spark, scanner):
    rows = scanned(spark, scanner, [
        (1, MIT_WRAPPED), (2, "Copyright 2020 Jane Doe. Released under the MIT License."),
        (3, f"{filler(97)} Released under the MIT License. {filler(103, 2)}"), (4, f"{APACHE} {filler(110)}"),
        (5, "Licensed under the GNU Lesser General Public License, version 3."), (6, "# This project is licensed under\n# the terms of the MIT license."),
        (7, f"{filler(40)} Released under the MIT License. Licensed under CC BY-SA 4.0. {filler(40)}"), (8, filler(20000) + " Released under the MIT License."),
        (9, "Licensed under the Harbour Company License, Version 2.0."), (10, filler(5000))])
    assert [r.families for r in rows] == [["MIT"], ["MIT"], ["MIT"], ["Apache-2.0"], ["LGPL"], ["MIT"], ["CC-BY-SA", "MIT"], ["MIT"], [], []]
    assert rows[2].n_licensed == 1 and rows[7].n_licensed == 1


def test_scan_equals_a_slow_version_on_the_whole_table(spark, scanner):
    """Every line and every window of every text, in plain Python."""
    from math import exp
    weights = {w[0]: w[1:] for w in scanner.weights}
    pairs = lambda ws: {(a, b) for a, b in zip(ws, ws[1:])}
    known = [(k, pairs(ws)) for k, ws in L.segments()]

    def judged(words):
        have = pairs(words)
        shares = [(len(have & s) / len(s) if len(have & s) >= L.LEAST_PAIRS else 0.0, k) for k, s in known]
        top = max(s for s, _ in shares)
        if top < L.CONFIRMED:
            return None, []
        grams = set(words) | {f"{a} {b}" for a, b in have}
        z = [c + sum(weights[g][k] for g in grams if g in weights) for k, c in enumerate(scanner.intercepts)]
        p = [1 / (1 + exp(z[-1] - zk)) for zk in z[:-1]]
        owners = [[k for k, s in known if s == segment] for (share, _), (_, segment) in zip(shares, known) if share == top]
        return top, [scanner.families[k] for k in sorted({max(ks, key=lambda k: (p[k], -k)) for ks in owners}) if p[k] >= scanner.least]

    def slow(text):
        lines = [re.findall(r"[^\W_]+", p.lower()) for p in (text or "").split("\n") if p.strip(" ")]
        found, flat = [], []
        for i, words in enumerate(lines):
            top, names = judged(words) if len(words) <= L.WINDOW else (None, [])
            found += [(i, f) for f in names]
            flat += [(i, "")] if top else [(i, w) for w in words]
        last = {}
        for k in range(0, max(1, -(-len(flat) // L.STEP))):
            part = flat[k * L.STEP:k * L.STEP + L.WINDOW]
            for f in judged([w for _, w in part])[1] if part else []:
                if last.get(f) != k - 1:
                    found.append((part[0][0], f))
                last[f] = k
        return len(lines), sorted(found)

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([
        (-1, MIT_WRAPPED), (-2, f"{filler(300)} {APACHE} {filler(50)}\n{MIT_WRAPPED}\n\nLicensed under CC BY 4.0."), (-3, None)], "doc_id long, text string"))
    got = {r.doc_id: (r.n_paragraphs, sorted((f.place, f.family) for f in r.found)) for r in L.scan(docs, scanner).collect()}
    assert got == {r.doc_id: slow(r.text) for r in docs.collect()}


def test_the_unknown_class_is_learnt_from_every_document(spark):
    """One line a document, in more documents than the sample that once taught it."""
    docs = spark.range(700).selectExpr("id AS doc_id", "concat('You may use the copy ', id, ' in the library free of charge.') AS text")
    assert L.train(docs).units == 2 * 700  # the line, and the window it lies in


def test_every_unit_is_scored_whether_or_not_a_template_confirms_it(spark, scanner):
    """The regression sees all units: a slow version over every line that is a notice and every window."""
    from math import exp
    weights = {w[0]: w[1:] for w in scanner.weights}
    texts = [(1, f"{filler(100)}\nReleased under the MIT License.\n{filler(30, 3)}"), (2, filler(500)), (3, ""), (4, "of the licensed"), (5, None),
             (6, f"{filler(40)} licensed under the unheard of licensed version license {filler(40)}")]

    def slow(text):
        lines = [re.findall(r"[^\W_]+", p.lower()) for p in (text or "").split("\n") if p.strip(" ")]
        alone = [ws for ws in lines if " ".join(ws) == "released under the mit license"]
        flat = [w for ws in lines for w in ([""] if ws in alone else ws)]
        units = alone + [flat[k:k + L.WINDOW] for k in range(0, len(flat), L.STEP)]
        tops = []
        for ws in units:
            grams = set(ws) | {f"{a} {b}" for a, b in zip(ws, ws[1:])}
            z = [c + sum(weights[g][k] for g in grams if g in weights) for k, c in enumerate(scanner.intercepts)]
            tops.append(max(1 / (1 + exp(z[-1] - zk)) for zk in z[:-1]))
        return len(units), sum(t >= scanner.least for t in tops) - len(alone), pytest.approx(max(tops, default=0.0))

    rows = scanned(spark, scanner, texts)
    assert [(r.n_units, r.n_unconfirmed, r.highest) for r in rows] == [slow(t) for _, t in texts]
    assert rows[1].highest > 0 == rows[1].n_licensed and rows[0].best == rows[0].highest
