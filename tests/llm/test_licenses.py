import textwrap

import numpy as np

from farelane.llm import licenses
from tests.llm import frames

MODEL = licenses.train()


def test_families_and_clean_text(spark):
    rows, want = [], {}
    i = 0
    for family, texts in licenses.TEMPLATES.items():
        for t in texts:
            rows.append((i, f"Some words before it.\n{t}\nAnd the rest of the text."))
            want[i] = family
            i += 1
    for j, c in enumerate(licenses.COUNTEREXAMPLES + ["Die Zeit mit der Lizenz und mit allem.", "All the rights of the people.", "to be or not to be of the and"]):
        rows.append((1000 + j, c))
    got = {r["doc_id"]: r for r in licenses.scan(frames.docs(spark, rows), MODEL).collect()}
    assert {k: v["family"] for k, v in got.items()} == want
    assert all(r["paragraph"] == 1 and r["confirmed"] for r in got.values())


def test_inside_a_paragraph_and_versions(spark):
    got = licenses.scan(frames.docs(spark, [
        (1, "Long prose goes here and there of the. " * 30 + "Licensed under the Apache License, Version 2.0. " + "More prose of the same. " * 30),
        (2, "This work is licensed under the GNU General Public License, version 2."),
        (3, "LICENSED UNDER CC BY-NC 3.0.\r\nall rights reserved")]), MODEL).collect()
    assert sorted((r["doc_id"], r["paragraph"], r["family"]) for r in got) == [
        (1, 0, "Apache"), (2, 0, "GPL"), (3, 0, "CC-BY-NC"), (3, 1, "proprietary")]


def test_sql_probability_equals_model(spark):
    texts = ["Released under the MIT License.", "The copyright of the software is reserved.", "GNU General Public License, v3 of the work"]
    got = {r["doc_id"]: r for r in licenses.scan(frames.docs(spark, list(enumerate(texts))), MODEL, least=0.0).collect()}
    for i, t in enumerate(texts):
        p = MODEL.probabilities(licenses.tokens(t))
        k = int(p.argmax())
        if MODEL.families[k] == licenses.UNKNOWN:
            assert i not in got
        else:
            assert got[i]["family"] == MODEL.families[k] and abs(got[i]["probability"] - p[k]) < 1e-5


def test_wrapped_notices(spark):
    notices = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts if len(t) > 120]
    rows = []
    for i, (_, t) in enumerate(notices):
        for k, (width, mark) in enumerate(((70, " * "), (45, "# "), (80, "// "))):
            lines = textwrap.wrap(t, width, initial_indent=mark, subsequent_indent=mark)
            rows.append((10 * i + k, "/*\nSome words before it, and more.\n" + ("\r\n" if k else "\n").join(lines) + "\nAnd the rest of the text.\n" + "of the cat " * 40))
    got = [r for r in licenses.scan(frames.docs(spark, rows), MODEL).collect()]
    confirmed = {(r["doc_id"], r["paragraph"], r["family"]) for r in got if r["confirmed"]}
    assert confirmed == {(10 * i + k, 2, f) for i, (f, _) in enumerate(notices) for k in range(3)}


def test_cc_combinations(spark):
    got = licenses.scan(frames.docs(spark, [(1, "Licensed under CC BY-NC-SA 4.0"), (2, "Licensed under CC BY-NC-ND 3.0."), (3, "Licensed under CC BY-SA 4.0"),
                                            (4, "Licensed under CC BY-NC 4.0")]), MODEL).collect()
    assert sorted((r["doc_id"], r["family"], r["confirmed"]) for r in got) == [
        (1, "CC-BY-NC-SA", True), (2, "CC-BY-NC-ND", True), (3, "CC-BY-SA", True), (4, "CC-BY-NC", True)]


#: Notices in other words than the templates'.
OUTSIDE = [
    ("MIT", "This plugin is open source software licensed under the MIT license, see LICENSE for details."),
    ("Apache", "Our code is made available under the Apache License, Version 2.0, as of March."),
    ("GPL", "You can copy this tool under the GNU General Public License version 2 or later."),
    ("LGPL", "The bindings are covered by the GNU Lesser General Public License, version 3."),
    ("AGPL", "The server is offered under the GNU Affero General Public License version 3."),
    ("MPL", "Parts of this code are under the Mozilla Public License version 2.0."),
    ("EPL", "All content is available under the terms of the Eclipse Public License v2.0, as published."),
    ("EPL", "SPDX-License-Identifier: EPL-1.0"),
    ("Zlib", "This file is released under the zlib license."),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("BSD", "Neither the name of Example Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."),
    ("BSD", "THIS SOFTWARE IS PROVIDED BY THE REGENTS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED."),
    ("CC-BY", "Dieser Text ist lizenziert unter einer Creative Commons Namensnennung 3.0 International Lizenz."),
    ("public-domain", "The map was released into the public domain."),
]


def test_notices_outside_the_templates(spark):
    rows = [(i, f"Words of the text.\n{t}\nAnd more.") for i, (_, t) in enumerate(OUTSIDE)]
    got = {(r["doc_id"], r["family"]) for r in licenses.scan(frames.docs(spark, rows), MODEL).collect()}
    assert got == {(i, f) for i, (f, _) in enumerate(OUTSIDE)}


def test_denied_and_mentioned(spark):
    denied = ["We do not release this under the MIT License.", "This work is not licensed under the GNU General Public License, version 3.",
              "The archive isn't available under the Apache License 2.0.", "Das Werk ist nicht lizenziert unter einer Creative Commons Namensnennung 4.0 International Lizenz.",
              "The text was never released into the public domain.", "There was an eclipse in public.", "The warranty covers software of any kind."]
    got = licenses.scan(frames.docs(spark, list(enumerate(denied)) + [
        (50, "It is not licensed under the MIT License but licensed under the Apache License, Version 2.0."),
        (51, "It is no longer distributed. Released under the MIT License."),
        (52, "You may not use this file except in compliance. Licensed under the Apache License, Version 2.0.")]), MODEL).collect()
    assert sorted((r["doc_id"], r["family"], r["confirmed"]) for r in got) == [(50, "Apache", True), (51, "MIT", True), (52, "Apache", True)]


def test_odd_rows(spark):
    odd = frames.with_clashes(frames.docs(spark, frames.odd_rows() + [(None, "All rights reserved."), (77, "All rights reserved."), (77, "All rights reserved.")]))
    got = sorted(str(r["doc_id"]) for r in licenses.scan(odd, MODEL).collect())
    assert got == ["77", "None"]
    assert licenses.scan(frames.docs(spark, []), MODEL).count() == 0


def test_native_plan(spark):
    plan = licenses.scan(frames.docs(spark, [(1, "a")]), MODEL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_model_is_sparse_and_calibrated():
    dense = sum(np.count_nonzero(np.abs(w) > 1e-6) for w in MODEL.weights.values())
    assert dense < 0.5 * len(MODEL.weights) * len(MODEL.families)
    assert MODEL.probabilities(["the", "of"]).argmax() == 0
