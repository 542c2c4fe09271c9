"""License scans against brute force over every stretch of every paragraph."""

import re
import textwrap

import numpy as np
import pytest

from fjordlake.llm import licenses
from fjordlake.llm.queries import QUERIES

LONG = " ".join(["word"] * 5000)
TEXTS = [None, "", "\n", "no cue at all", "Released under the MIT License.", "a\n\n🙂 é All rights reserved.\r\nLicensed under the Frobozz Magic License.", f"{LONG} licensed under CC BY-NC 4.0. {LONG}\nend",
         "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.", "The driver lost his license.", "one line\nlicensed under the MIT\nLicense. Released under the Mozilla\n Public License, version 2.0\n \n\nMIT License\n\n\n", "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0.\nDual licensed under the MIT License or the Mozilla Public License, version 2.0."]


def stretches(words):
    return [(i, words[i : i + licenses.STRETCH]) for i in range(0, max(len(words) - (licenses.STRETCH - licenses.STEP), 1), licenses.STEP)]


def of_stretch(model, part, line):
    """License number to score and share of what a stretch states; -1 for unknown."""
    z, pairs, text = model.logits(part), {f"{a} {b}" for a, b in zip(part, part[1:])}, " " + " ".join(part) + " "
    if z[0] < 0:
        return {}
    notice = [max((len(pairs & set(t)) / len(t) for j, t in model.templates if j == k), default=0.0) for k in range(len(model.licenses))]
    alike = [max(n, float(x)) for n, x in zip(notice, model.named(text, line))]
    known = {k: (z[k + 1], alike[k]) for k in range(len(alike)) if (notice[k] >= licenses.ALIKE and notice[k] == max(notice)) or (z[k + 1] >= 0 and alike[k] >= licenses.ALIKE)}
    return known or ({-1: (z[0], max(alike))} if re.search(licenses.UNDER, text) and re.search(licenses.SPEAKS, text) else {})


def brute(text):
    model, out, at, block = licenses.model(), [], 0, []
    for line in [*(text or "").split("\n"), ""]:
        if line.strip():
            block.append((at, at + len(line), line))
        elif block:
            out += of_block(model, block)
            block = []
        at += len(line) + 1
    return [(model.licenses[k] if k >= 0 else licenses.UNKNOWN, a, b, round(1 / (1 + np.exp(-z)), 6), round(x, 6)) for a, k, b, z, x in sorted(out)]


def of_block(model, block):
    own, wide = [], {}
    for start, end, line in block:
        best = {}
        for _, part in stretches(licenses.words_of(line)):
            for k, (z, x) in of_stretch(model, part, line).items():
                old = best.get(k, (-np.inf, 0))
                best[k] = (max(old[0], z), max(old[1], x))
        own += [(start, k, end, *v) for k, v in best.items() if k >= 0 or len(best) == 1]
    words = [(w, start, end) for start, end, line in block for w in licenses.words_of(line)]
    for i, part in stretches(words):
        if part and part[0][1] < part[-1][1]:
            for k, (z, x) in of_stretch(model, [w for w, _, _ in part], "").items():
                if k >= 0:
                    a, b, old_z, old_x = wide.get(k, (part[0][1], part[-1][2], -np.inf, 0))
                    wide[k] = (min(a, part[0][1]), max(b, part[-1][2]), max(z, old_z), max(x, old_x))
    new = {k: w for k, w in wide.items() if not any(j == k and w[0] <= a and b <= w[1] for a, j, b, _, _ in own)}
    own = [f for f in own if f[1] >= 0 or not any(w[0] <= f[0] and f[2] <= w[1] for w in wide.values())]
    wide = new
    return own + [(a, k, b, z, x) for k, (a, b, z, x) in wide.items()]


def test_licenses(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(TEXTS, 10_000)), "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: [(s["license"], s["start"], s["end"], round(s["score"], 6), round(s["alike"], 6)) for s in r["licenses"]] for r in licenses.find_licenses(docs).collect()}
    assert got == {i: brute(t) for i, t in texts.items()}
    assert [[s[0] for s in got[10_000 + i]] for i in range(len(TEXTS))] == [[], [], [], [], ["MIT"], ["all rights reserved", "unknown"], ["CC-BY-NC"], ["BSD"], [], ["MPL-2.0", "MIT", "MIT"], ["Apache-2.0", "MIT", "MPL-2.0"]]


def test_every_license_line_of_the_documents_is_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").toPandas()
    got = QUERIES["op4_license_scans"](spark, sf_dir).toPandas().set_index("doc_id")
    line = re.compile(r"Licensed under|Released under|licensed under|All rights reserved")
    assert len(got) == len(docs)
    assert {i: sum(bool(line.search(p)) for p in t.split("\n")) for i, t in zip(docs.doc_id, docs.text)} == got.n_paragraphs.to_dict()


def test_without_a_cue_nothing_is_stated():
    model = licenses.model()
    cue = re.compile(model.cue_pattern())
    assert model.bias[0] + sum(max(0, w[0]) for g, w in model.weights.items() if not cue.search(g)) < 0


def test_licenses_that_the_model_never_saw_are_unknown():
    model = licenses.model()
    for name in ("Frobozz Magic License", "Quux Content Agreement", "Helsinki Data License 4"):
        z = model.logits(licenses.words_of(f"This work is licensed under the {name}."))
        assert z[0] >= 0 and z[1:].max() < 0


def wrapped(text, width):
    return textwrap.fill(text, width)


#: Headers as files carry them, and the license of each.
HEADERS = {
    "MIT": "Copyright (c) 2021 Some One\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software is distributed on an \"AS IS\" BASIS.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software.",
}
TITLES = {"MIT License": "MIT", "The MIT License (MIT)": "MIT", "Apache License": "Apache-2.0", "Apache License, Version 2.0, January 2004": "Apache-2.0", "BSD 3-Clause License": "BSD", "GNU General Public License v3.0": "GPL-3.0", "ISC License": "ISC", "Mozilla Public License Version 2.0": "MPL-2.0", "CC0 1.0 Universal": "CC0", "The Unlicense": "Unlicense"}
#: Statements in frames that no example has, and ordinary lines with the same words.
STATED = {"You can use this library under the MIT license": "MIT", "MIT-licensed, see COPYING for details": "MIT", "The data is published under a CC BY 4.0 license by the institute": "CC-BY", "Our images are licensed as CC BY-NC 4.0 unless marked": "CC-BY-NC", "Code here is covered by the Apache License, Version 2.0": "Apache-2.0", "The plugin is offered under the GNU Lesser General Public License": "LGPL", "We provide this under the BSD 2-Clause License to everybody": "BSD", "(c) 1999 by the press, all rights reserved": "all rights reserved"}
SILENT = ("The book entered the public domain in 1950.", "It was released under pressure from the public.", "MIT researchers published a new paper under the Apache foundation.", "All rights reserved for the bride were lost.", "The apache pilots flew under the general public bridge.", "She has a degree from MIT and a driving license.", "Er kam mit dem Rad und mit ihr.", "The commons was open to the public in version 2 of the park.", "A copyright lawyer spoke about the eclipse in public.", "Rights of the public were reserved in the agreement of 1990.")


@pytest.mark.parametrize("width", [30, 60, 76, 2000])
def test_wrapped_headers_and_titles_are_named(spark, width):
    texts = [*("Some text before.\n\n" + "\n\n".join(wrapped(p, width) for p in t.split("\n\n")) + "\n\nint main() {}" for t in HEADERS.values()), *TITLES, *(f"intro\n\n{t}\n\n{SILENT[0]}" for t in TITLES)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [s["license"] for s in r["licenses"]] for r in licenses.find_licenses(docs).collect()}
    for i, name in enumerate([*HEADERS, *TITLES.values(), *TITLES.values()]):
        assert got[i] and set(got[i]) == {name}, (texts[i], got[i])


def test_precision_and_recall_beyond_the_frames(spark):
    docs = spark.createDataFrame(list(enumerate([*STATED, *SILENT])), "doc_id long, text string")
    got = {r["doc_id"]: {s["license"] for s in r["licenses"]} for r in licenses.find_licenses(docs).collect()}
    named = [got[i] == {k} for i, k in enumerate(STATED.values())]
    assert not any(got[i] for i in range(len(STATED), len(got))), got
    assert sum(named) >= 7, got
