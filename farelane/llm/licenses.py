"""Licence scan: a trained paragraph classifier with template confirmation.

Paragraphs are the lines of a whole text, and runs of lines over which a notice
is wrapped: word trigrams are taken across line ends, counted per template in
windows of its length, and lines that together hold a template are joined.  A multinomial logistic regression
on the presence of word 1- to 3-grams (sparse weights, proximal gradient) tells
the licence families from each other and from ``unknown``.  It is trained on
the driver from the bounded table of templates below, thinned and embedded
copies of them, and counterexamples; a temperature fitted on held-out examples
calibrates its probabilities.

Scoring is SQL functions only: paragraphs with a key word of the templates are
cut into n-grams, joined with the weights, and summed; a paragraph without a
key word has no n-gram of the model, so it is unknown.  A prediction is
confirmed if the word trigrams of a template of its family occur in the
paragraph to a share of ``confirm`` or more.  What a sentence denies ("not
released under ...") is left out before all of it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import WORD, broadcast_if_small, quoted, small_table, words
from farelane.session import materialize

UNKNOWN = "unknown"
#: Licence notices by family (fixed values: the wording of the public notices).
TEMPLATES: dict[str, list[str]] = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Distributed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The software is provided \"as is\", without warranty of any kind, express or implied, including but not limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the software."],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "This software is available under the Apache License 2.0."],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "Licensed under the GNU GPL v3.",
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU General Public License for more details.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-only",
        "This library is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU Lesser General Public License for more details.",
        "You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "AGPL": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "This program is distributed in the hope that it will be useful, but without any warranty; without even the implied warranty of merchantability or fitness for a particular purpose. See the GNU Affero General Public License for more details.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0"],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
        "Licensed under the Eclipse Public License, version 2.0.",
        "SPDX-License-Identifier: EPL-2.0"],
    "Zlib": [
        "Released under the zlib License.",
        "SPDX-License-Identifier: Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "This software is provided by the copyright holders and contributors \"as is\" and any express or implied warranties, including, but not limited to, the implied warranties of merchantability and fitness for a particular purpose are disclaimed."],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "The software is provided \"as is\" and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness."],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung 4.0 International Lizenz."],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung - Weitergabe unter gleichen Bedingungen 4.0 International Lizenz."],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung - Nicht kommerziell 4.0 International Lizenz."],
    "CC-BY-ND": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung - Keine Bearbeitungen 4.0 International Lizenz."],
    "CC-BY-NC-SA": [
        "Licensed under CC BY-NC-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."],
    "CC-BY-NC-ND": [
        "Licensed under CC BY-NC-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."],
    "public-domain": [
        "This work has been released into the public domain.",
        "Released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights (CC0 1.0)."],
    "Unlicense": [
        "SPDX-License-Identifier: Unlicense",
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) 2020 by the authors. All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher."],
}
#: Sentences that share words with the notices.
COUNTEREXAMPLES = [
    "She got her driving license in version two of the test.", "He works at the public library and reads in general.",
    "The software was free of charge for any person.", "Under the terms of the contract the work was done.",
    "The rights of the people are reserved for the court.", "A copy of the file was found in the source.",
    "Apache is the name of a people and of a helicopter.", "The mit of the river is under the bridge.",
    "He reserved all seats in the restaurant.", "The foundation published the general plan of the work.",
    "You may not use this road without permission.", "Creative people share their work.", "The domain of the function is public.",
    "This version of the program is distributed to schools.", "The author of the work has copied the notice.",
    "International trade is subject to the terms of the law.", "A license plate was found under the car.",
    "Mit der Zeit und mit den anderen.", "The eclipse of the sun was seen by the public.", "The warranty of the car was limited to a particular year.",
    "The product is provided with a commercial contract.", "Dieses Werk ist unter anderen Bedingungen entstanden.", "The holders of the shares were liable for the damages.",
    "The event was held in the hope that it would be useful.", "The products were derived from the means of the contributors.", "The clause in the contract was modified.", "The commons was part of the village."]
#: Words of the templates that are too ordinary to tell anything alone.
ORDINARY = frozenset(
    "the of and to in is that it for on are as with this be at have or by a an any all can you may not it has been into their if no work use file "
    "part person without above following met appear later either at your option extent possible law mit v c sa nc nd form code source see "
    "under terms general version both other 0 but not limited more will shall from out or used its name names nor neither even hope useful details event "
    "non regard kind particular purpose means made held use dieses werk ist unter einer nicht keine gleichen anyone whether contract action claim other".split())
#: Short names that together tell a Creative Commons licence.
CC_PARTS = frozenset("by nc sa nd".split())
MAX_NGRAM = 3
#: A licence that a sentence denies, from the denial to the sentence's end or its ``but``.
DENIED = (r"(?<![\p{L}\p{N}])(?:not|never|no longer|nor|nicht|\p{L}+n['’]t)\s+(?:\p{L}+\s+){0,3}?"
          r"(?:(?:re)?licen[sc](?:ed?|ing)|releas(?:ed?|ing)|distribut(?:ed?|ing)|available|covered|published?|lizenziert|veröffentlicht)"
          r"(?![\p{L}\p{N}])(?:(?!\bbut\b|\bsondern\b)[^.;!?]|\.(?=\p{N}))*")


def tokens(text: str) -> list[str]:
    """Words as the SQL side has them; numbers become 0."""
    return ["0" if w[0].isdigit() and w.isdigit() else w for w in WORD.findall(text.lower())]


def key_words() -> list[str]:
    return sorted({w for ts in TEMPLATES.values() for t in ts for w in tokens(t)} - ORDINARY)


def _grams(ws: list[str], keys: frozenset[str]) -> set[str]:
    return {" ".join(ws[i:i + n]) for n in range(1, MAX_NGRAM + 1) for i in range(len(ws) - n + 1)
            if any(w in keys for w in ws[i:i + n]) or n > 1 and CC_PARTS.issuperset(ws[i:i + n])}


def examples(seed: int = 1, copies: int = 24) -> list[tuple[list[str], str]]:
    """Labelled token lists: templates whole, with words dropped, inside other
    words; and unknown ones: counterexamples, shuffled and single words."""
    rng = np.random.default_rng(seed)
    filler = [w for c in COUNTEREXAMPLES for w in tokens(c)]
    key = key_words()
    out = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            w = tokens(t)
            for _ in range(copies):
                x = list(w)
                if len(x) > 6 and rng.random() < 0.6:
                    x = [y for y in x if rng.random() > 0.08]
                if rng.random() < 0.5:
                    x = list(rng.choice(filler, rng.integers(1, 12))) + x
                if rng.random() < 0.5:
                    x = x + list(rng.choice(filler, rng.integers(1, 12)))
                out.append((x, family))
    for c in COUNTEREXAMPLES:
        out.extend([(tokens(c), UNKNOWN)] * 4)
    for _ in range(600):
        some = list(rng.choice(filler, rng.integers(2, 25))) + list(rng.choice(key, rng.integers(1, 4)))
        rng.shuffle(some)
        out.append((some, UNKNOWN))
    return out


class LicenceModel:
    """families (unknown first), n-gram -> weights, intercepts, temperature."""

    def __init__(self, families, weights, intercepts, temperature):
        self.families, self.weights, self.intercepts, self.temperature = families, weights, intercepts, temperature

    def probabilities(self, ws: list[str]) -> np.ndarray:
        z = np.array(self.intercepts)
        for g in _grams(ws, frozenset(key_words())):
            if g in self.weights:
                z = z + self.weights[g]
        z = z / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()


def train(rounds: int = 400, l1: float = 2e-4, seed: int = 1) -> LicenceModel:
    """Proximal gradient with momentum on four fifths of the examples; the
    temperature of least log-loss on the rest."""
    keys = frozenset(key_words())
    rows = [(_grams(w, keys), y) for w, y in examples(seed)]
    families = [UNKNOWN, *TEMPLATES]
    vocabulary = sorted({g for t in TEMPLATES.values() for x in t for g in _grams(tokens(x), keys)})
    index = {g: i for i, g in enumerate(vocabulary)}
    x, y = np.zeros((len(rows), len(vocabulary)), np.float32), np.array([families.index(r[1]) for r in rows])
    for i, (gs, _) in enumerate(rows):
        x[i, [index[g] for g in gs if g in index]] = 1
    order = np.random.default_rng(seed).permutation(len(rows))
    held, own = order[::5], np.delete(order, np.s_[::5])
    target = np.eye(len(families), dtype=np.float32)[y[own]]
    xt = x[own]
    step = 4.0 * len(own) / max(1.0, float(np.linalg.norm(xt, 2)) ** 2)
    w, b = np.zeros((len(vocabulary), len(families)), np.float32), np.zeros(len(families), np.float32)
    vw, vb = w.copy(), b.copy()
    for t in range(rounds):
        z = xt @ vw + vb
        p = np.exp(z - z.max(axis=1, keepdims=True))
        g = (p / p.sum(axis=1, keepdims=True) - target) / len(own)
        nw = vw - step * (xt.T @ g)
        nw = np.sign(nw) * np.maximum(0, np.abs(nw) - step * l1)
        nb = vb - g.sum(axis=0)
        a = t / (t + 3)
        vw, vb, w, b = nw + a * (nw - w), nb + a * (nb - b), nw, nb
    z = x[held] @ w + b

    def loss(temp: float) -> float:
        s = z / temp
        s = s - s.max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(held)), y[held]]).mean())
    temperature = min((0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    return LicenceModel(families, {g: w[i].astype(float) for g, i in index.items() if np.abs(w[i]).max() > 1e-6},
                        b.astype(float).tolist(), temperature)


def _gate() -> str:
    """A pattern that finds any key word, by first letter."""
    first: dict[str, list[str]] = {}
    for w in key_words():
        first.setdefault(w[0], []).append(w[1:])
    return r"(?<![\p{L}\p{N}])(?:" + "|".join(f"{a}(?:{'|'.join(sorted(r, reverse=True))})" for a, r in sorted(first.items())) + r")(?![\p{L}\p{N}])"


def _ngrams(w: Column, n: int) -> Column:
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)),
                                              lambda i: F.array_join(F.slice(w, i, n), " "))).otherwise(F.array().cast("array<string>"))


LINE_END = r"\r?\n|\r"


def _numbers(w: Column) -> Column:
    return F.transform(w, lambda x: F.when(x.rlike(r"^\p{Nd}+$"), "0").otherwise(x))


def _wrapped(texts: DataFrame, confirm: float) -> DataFrame:
    """(doc_id, text_hash, paragraph, last): runs of lines of ``texts`` (doc_id,
    text_hash, low) that together, and no line alone, hold ``confirm`` of a
    template's trigrams; runs that share a line are one."""
    shapes = []
    number = 0
    for ts in TEMPLATES.values():
        for t in ts:
            w = tokens(t)
            gs = sorted({tuple(w[j:j + 3]) for j in range(len(w) - 2)})
            number += 1
            shapes += [{"template": number, "a": a, "b": b, "c": c, "size": len(gs), "span": len(w) + len(w) // 2 + 4} for a, b, c in gs]
    shapes = small_table(texts.sparkSession, shapes, "template int, a string, b string, c string, size int, span int").select(
        "template", "size", "span", F.xxhash64("a", "b", "c").alias("gram"))
    by_line = F.transform(F.split("low", LINE_END), lambda x: _numbers(words(x)))
    ws = (texts.withColumn("lines", by_line)
          .withColumn("w", F.flatten("lines"))
          .withColumn("at", F.flatten(F.transform("lines", lambda x, i: F.array_repeat(i, F.size(x)))))
          .filter((F.size("w") >= 3) & (F.size("lines") >= 2)).select("doc_id", "text_hash", "w", "at"))
    three = F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.struct(
        F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("gram"), i.alias("i"),
        F.get("at", i).alias("line"), F.get("at", i + 2).alias("last")))
    hits = (ws.select("doc_id", "text_hash", F.inline(three)).join(F.broadcast(shapes), "gram")
            # windows of two spans, a span apart: a notice is whole in one of them
            .withColumn("window", F.explode(F.array(F.floor(F.col("i") / F.col("span")), F.floor(F.col("i") / F.col("span")) - 1))))
    part = ["doc_id", "text_hash", "template", "size", "window"]
    hits = hits.groupBy(*part).agg(F.collect_set(F.struct("gram", "line", "last")).alias("g"), F.min("line").alias("paragraph"), F.max("last").alias("last"))
    enough = F.col("size") * confirm - 1e-9
    one_line = F.exists(F.transform("g", lambda x: x["line"]), lambda n: F.size(F.array_distinct(F.transform(
        F.filter("g", lambda y: (y["line"] == n) & (y["last"] == n)), lambda y: y["gram"]))) >= enough)
    runs = hits.filter((F.col("paragraph") < F.col("last")) & (F.size(F.array_distinct(F.transform("g", lambda x: x["gram"]))) >= enough)
                       & ~one_line).select("doc_id", "text_hash", "paragraph", "last").distinct()
    doc = Window.partitionBy("doc_id", "text_hash").orderBy("paragraph", "last")
    before = F.max("last").over(doc.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("new", F.coalesce((F.col("paragraph") > before).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(doc))
    return runs.groupBy("doc_id", "text_hash", "run").agg(F.min("paragraph").alias("paragraph"), F.max("last").alias("last")).drop("run")


def scan(docs: DataFrame, model: LicenceModel, text: str = "text", doc_id: str = "doc_id", least: float = 0.5, confirm: float = 0.6) -> DataFrame:
    """One row per paragraph that is no ``unknown``: ``doc_id``, ``text_hash``,
    ``paragraph`` (line number from 0; the first line of a wrapped notice, whose
    other lines give a row only if confirmed alone), ``family``, ``probability`` (``least``
    or more), ``template_share`` (the largest share of a template of the family
    whose word trigrams occur) and ``confirmed``.

    Null, empty and wordless texts give no row; rows alike in doc_id and text
    give one row per paragraph.  Ties of families go to the first by the
    table's order.  An empty table gives an empty one."""
    spark = docs.sparkSession
    names = [f"w{i}" for i in range(len(model.families))]
    table = small_table(spark, [{"gram": g} | dict(zip(names, map(float, w))) for g, w in sorted(model.weights.items())],
                        "gram string, " + ", ".join(f"{n} double" for n in names))
    gate = _gate()
    texts = (docs.select(quoted(doc_id).alias("doc_id"), F.xxhash64(quoted(text)).alias("text_hash"), F.lower(quoted(text)).alias("low"))
             .filter(F.col("low").rlike(gate)))
    rows = (texts.select("doc_id", "text_hash", F.posexplode(F.split("low", LINE_END)).alias("paragraph", "line"))
            .filter(F.col("line").rlike(gate)).distinct().withColumn("last", F.col("paragraph")))
    runs = materialize(_wrapped(texts, confirm))
    r2 = broadcast_if_small(runs.select(F.col("doc_id").alias("d2"), F.col("text_hash").alias("h2"), F.col("paragraph").alias("p2"), F.col("last").alias("l2")))
    joined = (texts.join(r2, texts["doc_id"].eqNullSafe(F.col("d2")) & (F.col("text_hash") == F.col("h2")))
              .select("doc_id", "text_hash", F.col("p2").alias("paragraph"), F.col("l2").alias("last"),
                      F.array_join(F.slice(F.split("low", LINE_END), F.col("p2") + 1, F.col("l2") - F.col("p2") + 1), " ").alias("line")).distinct())
    rows = rows.select("doc_id", "text_hash", "paragraph", "last", "line").unionByName(joined)
    rows = rows.withColumn("line", F.regexp_replace("line", DENIED, " "))
    ws = rows.select("doc_id", "text_hash", "paragraph", "last", _numbers(words(F.col("line"))).alias("w"))
    grams = F.array_distinct(F.concat(*[_ngrams(F.col("w"), n) for n in range(1, MAX_NGRAM + 1)]))
    key = ["doc_id", "text_hash", "paragraph", "last"]
    sums = (ws.select(*key, "w", F.explode(grams).alias("gram")).join(F.broadcast(table), "gram")  # a fixed number of weights
            .groupBy(*key, "w").agg(*[F.sum(n).alias(n) for n in names]))
    logits = [(F.col(n) + b) / model.temperature for n, b in zip(names, model.intercepts)]
    z = sums.withColumn("z", F.array(*logits)).withColumn("top", F.array_max("z"))
    z = z.withColumn("total", F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))))
    z = z.withColumn("best", F.array_position("z", F.col("top")).cast("int"))
    said = (z.withColumn("family", F.element_at(F.array(*[F.lit(f) for f in model.families]), F.col("best")))
            .withColumn("probability", 1 / F.col("total"))
            .filter((F.col("family") != UNKNOWN) & (F.col("probability") >= least)).select(*key, "w", "family", "probability"))
    shapes = []
    for family, texts in TEMPLATES.items():
        for i, t in enumerate(texts):
            w = tokens(t)
            gs = sorted({" ".join(w[j:j + 3]) for j in range(max(1, len(w) - 2))})
            shapes += [{"f": family, "template": i, "gram": g, "size": len(gs)} for g in gs]
    shapes = small_table(spark, shapes, "f string, template int, gram string, size int")
    three = F.array_distinct(F.when(F.size("w") >= 3, _ngrams(F.col("w"), 3)).otherwise(F.array(F.array_join("w", " "))))
    shared = (said.select(*key, "family", F.explode(three).alias("gram"))
              .join(F.broadcast(shapes), "gram")
              .filter(F.col("family") == F.col("f"))
              .groupBy(*key, "template", "size").agg(F.count(F.lit(1)).alias("n"))
              .groupBy(*key).agg(F.max(F.col("n") / F.col("size")).alias("template_share")))
    s2 = shared.select(F.col("doc_id").alias("d2"), F.col("text_hash").alias("h2"), F.col("paragraph").alias("p2"), F.col("last").alias("l2"), "template_share")
    found = (said.join(s2, said["doc_id"].eqNullSafe(F.col("d2")) & (said["text_hash"] == F.col("h2")) & (said["paragraph"] == F.col("p2"))
                       & (said["last"] == F.col("l2")), "left")
             .select(*key, "family", F.round("probability", 6).alias("probability"),
                     F.coalesce("template_share", F.lit(0.0)).alias("template_share"),
                     (F.coalesce("template_share", F.lit(0.0)) >= confirm).alias("confirmed")))
    # a confirmed run of lines stands for its lines, a run that isn't gives no row
    over = F.max(F.when(F.col("confirmed"), F.when(F.col("last") > F.col("paragraph"), F.col("last")))).over(
        Window.partitionBy("doc_id", "text_hash").orderBy("paragraph").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    found = found.withColumn("over", F.coalesce(over, F.lit(-1)))
    return found.filter(F.col("confirmed") | (F.col("last") == F.col("paragraph")) & (F.col("paragraph") > F.col("over"))).drop("last", "over")
