"""License scans in DataFrame expressions alone: sparse word n-gram logistic regression, a calibrated unknown class, templates.

A paragraph is what lies between blank lines. It is read line by line and, since notices are wrapped, as a whole; either way its
words are runs of ASCII letters and digits, lower-cased, and what is longer than STRETCH words is read in overlapping stretches, all
of them. One logistic regression with an L1 penalty over the presence of words and word pairs says whether a stretch states a license,
one for each license whether it is that one, so that a stretch may name two. They learn on the driver from the names and notices
below, not from the input, so equal texts always score alike. Scores are calibrated on folds that leave out whole licenses: what names
a license that a model never saw counts as a miss of all it knows.

Templates confirm. A predicted license counts only if the stretch holds nearly all word pairs of one of its notices, or one of its names
where the words of a statement are, or nothing but such a name; a stretch that holds a notice, and no other license's as well, is that
license whatever its score. What states a license but has none confirmed is `unknown` if it has a statement's words and speaks of a
license, and nothing otherwise. Of stretches that cross lines only confirmed licenses count that no line among them states by itself;
their lines are no longer unknown.

A text without any cue can't state a license: cues are chosen such that all other n-grams together stay below one half. So the
regular expression that looks for them first loses nothing.

Rows: a null text is empty and states nothing; a text of any length is scanned whole; rows with equal or null doc_ids are scanned each
for itself; of licenses that tie each counts; an empty table gives no rows; other columns are ignored. Offsets count code points, ends
are exclusive.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fjordlake.llm.common import documents
from fjordlake.llm.secrets import _let, spans_of

#: Words of a stretch, and words from one's start to the next's.
STRETCH, STEP = 40, 20
#: Share of a notice's word pairs with which a stretch holds that notice, and words from which on a sentence is one.
ALIKE = 0.9
NOTICE = 7
UNKNOWN = "unknown"
#: Argument of the logistic function for a stretch without any known n-gram.
NOTHING = -6.0
#: Sentences of random words of PLAIN from which the model learns what states nothing.
RANDOM_SENTENCES = 1500

#: Names by which a license goes, then sentences of its own notice.
LICENSES: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "Apache-2.0": (("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0 license", "Apache License", "Apache 2 license"), ("you may not use this file except in compliance with the License", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0")),
    "MIT": (("MIT License", "MIT license", "MIT", "MIT/X11 license", "Expat license", "The MIT License (MIT)"), ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software")),
    "BSD": (("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "BSD-3-Clause", "BSD-2-Clause", "New BSD License", "Simplified BSD License", "modified BSD license", "BSD-style license"), ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer")),
    "GPL-2.0": (("GNU General Public License, version 2", "GNU General Public License v2.0", "GPL version 2", "GPLv2", "GPL-2.0", "GPL-2.0-only", "GNU GPL v2", "GNU General Public License version 2 or later"), ("under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",)),
    "GPL-3.0": (("GNU General Public License, version 3", "GNU General Public License v3.0", "GPL version 3", "GPLv3", "GPL-3.0", "GPL-3.0-or-later", "GNU GPL v3", "GNU General Public License version 3 or later"), ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",)),
    "LGPL": (("GNU Lesser General Public License", "GNU Lesser General Public License, version 3", "GNU Lesser General Public License v2.1", "LGPL-3.0", "LGPL-2.1", "LGPLv3", "LGPL", "GNU LGPL version 3", "GNU Library General Public License"), ("under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",)),
    "AGPL-3.0": (("GNU Affero General Public License", "GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3", "GNU AGPL v3", "AGPL"), ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3",)),
    "MPL-2.0": (("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL-2.0", "MPL 2.0", "Mozilla Public License"), ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",)),
    "EPL": (("Eclipse Public License, version 2.0", "Eclipse Public License 1.0", "EPL-2.0", "EPL 2.0", "Eclipse Public License"), ("This program and the accompanying materials are made available under the terms of the Eclipse Public License",)),
    "ISC": (("ISC License", "ISC license", "ISC"), ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",)),
    "Unlicense": (("Unlicense", "The Unlicense"), ("This is free and unencumbered software released into the public domain",)),
    "CC0": (("CC0", "CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons CC0 license"), ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",)),
    "public domain": (("public domain",), ("This work is in the public domain", "dedicated to the public domain", "The author releases this work into the public domain")),
    "CC-BY": (("CC BY 4.0", "CC BY 3.0", "CC BY", "CC-BY-4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License", "Creative Commons Attribution 3.0"), ("available under the Creative Commons Attribution License",)),
    "CC-BY-SA": (("CC BY-SA 4.0", "CC BY-SA 3.0", "CC BY-SA", "CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike License", "Creative Commons Attribution-Share Alike 3.0"), ("Text is available under the Creative Commons Attribution-ShareAlike License",)),
    "CC-BY-NC": (("CC BY-NC 4.0", "CC BY-NC 3.0", "CC BY-NC", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial License", "Creative Commons Attribution-Non Commercial 3.0"), ("available under the Creative Commons Attribution-NonCommercial License",)),
    "CC-BY-ND": (("CC BY-ND 4.0", "CC BY-ND 3.0", "CC BY-ND", "CC-BY-ND-4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License", "Creative Commons Attribution-NoDerivs License"), ("available under the Creative Commons Attribution-NoDerivatives License",)),
    "CC-BY-NC-SA": (("CC BY-NC-SA 4.0", "CC BY-NC-SA 3.0", "CC BY-NC-SA", "CC-BY-NC-SA-4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "Creative Commons Attribution-NonCommercial-ShareAlike License"), ("available under the Creative Commons Attribution-NonCommercial-ShareAlike License",)),
    "CC-BY-NC-ND": (("CC BY-NC-ND 4.0", "CC BY-NC-ND 3.0", "CC BY-NC-ND", "CC-BY-NC-ND-4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "Creative Commons Attribution-NonCommercial-NoDerivs License"), ("available under the Creative Commons Attribution-NonCommercial-NoDerivatives License",)),
    "all rights reserved": ((), ("All rights reserved.", "All rights reserved", "All rights are reserved by the publisher", "Copyright 2021 Example Ltd. All rights reserved.", "(c) 2019 by the authors, all rights reserved", "Copyright by Example Media. All rights reserved. No part of this publication may be reproduced")),
}
#: Sentences that name a license.
FRAMES = (
    "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "Released under {}.", "This work is licensed under the {}.", "This work is licensed under a {}.", "This software is distributed under the {}.", "This document is made available under {}.",
    "License: {}", "Licence: {}", "SPDX-License-Identifier: {}", "The code is published under the terms of the {}.", "This project is licensed under the {} - see the LICENSE file for details.", "Except where otherwise noted, content on this site is licensed under {}.", "Copyright 2020 The Authors. Licensed under {}.",
    "Available under the {}.", "Distributed under the {}.", "The text may be used under {}.", "You may use this under the {}, see below.", "This file is covered by the {}.", "Dieses Werk ist lizenziert unter {}.", "Lizenz: {}", "Publié sous licence {}.", "Esta obra está bajo una licencia {}.",
)
#: Licenses beyond the list above, which a model must not take for one of them.
OTHER_NAMES = (
    "Artistic License 2.0", "zlib License", "Boost Software License", "Open Data Commons Open Database License", "SIL Open Font License, version 1.1", "Python Software Foundation License", "European Union Public Licence, version 1.2", "CeCILL", "Microsoft Public License", "Open Government Licence v3.0",
    "Example Corporation Proprietary License", "Blue Oak Model License 1.0.0", "Academic Free License 3.0", "Common Development and Distribution License", "GNU Free Documentation License, version 1.3", "Server Side Public License", "Business Source License 1.1", "the terms of our customer agreement", "Acme Content License", "Do What The Fuck You Want To Public License",
)
#: Ordinary sentences, many with a cue.
PLAIN = (
    "The driver lost his license after the accident.", "She renewed her driving licence last week.", "The restaurant was granted a liquor license in May.", "A fishing licence is required on this river.", "Licensed premises must close at midnight.", "He is a licensed electrician with ten years of work.", "The poet took some license with the facts.", "The band released an album under the title Version 2.",
    "Copyright law protects the author of a work for many years.", "They argued about copyright in court and the court agreed with the author.", "The apache tribe lived in the south west.", "He flew an Apache helicopter and landed on the public square.", "The eclipse was visible to the public in the north.", "The public has a general interest in the work of the committee.", "This work is hard and the terms of the agreement are not clear.", "A copy of the report was made available under the table.",
    "Mozilla is a company and so is the foundation that owns it.", "The students at MIT wrote a paper on this.", "Er ging mit seiner Frau in die Stadt und kam mit ihr zurück.", "Der Hund und die Katze sind mit dem Kind im Haus.", "Les gens de la ville sont allés à la mer avec le chien.", "Los niños de la casa fueron a la playa con el perro.", "A table was reserved for all the guests, and all rights of way were kept.", "The seats are reserved and all guests have the same rights.",
    "Human rights are rights of all people.", "The zero was a creative invention and common among merchants.", "Attribution of the painting to the master is doubtful.", "The license plate of the car was dirty.", "The agency will license the drug next year.", "The gnu is an animal of the general family of antelopes.", "Permission to land was granted to the pilot.", "The conditions are met and the use of the source is permitted.",
    "Version 3 of the plan was published by the foundation.", "The version 2.0 release of the program is available in the shop.", "Under the bridge the work went on as published in the notes.", "The domain of the function is the real line and the public knows it.", "She was released from prison without conditions.", "It was distributed to the public free of charge by the city.", "The software was expensive, and we did not use it for this work.", "and the of to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so up said what its about than into them can only other time new some could these two may first then do any like my now over such our man me even most made after also did many off before must well back through years where much your way down should because long each just state those people too",
    "under the terms of this by or to be following any software public rights note file source code forms provided identifier modification permission commons domain general version attribution creative free foundation library artistic model agreement international universal",
    "unter dem dieses werk ist este obra una bajo esta œuvre est sous publié lizenz führerschein licence de pêche licencia de conducir",
    "der die das und in zu den nicht von sie ist des sich mit dem er es ein ich auf so eine auch als an nach wie im für man aber aus durch wenn nur war noch werden bei hat wir was wird sein einen welche sind oder zur um haben einer mir über ihm diese einem ihr uns da zum kann doch vor dieser mich ihn du hatte seine mehr am denn nun unter sehr selbst schon hier bis habe ihre dann ihnen seiner alle wieder meine",
    "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec on ou son ses aux mais comme nous sous cette tout y el que los del las un por con no una su para es al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante bajo",
)

#: Fixed pattern of the words around a license's name in a statement, and of those that speak of a license; words between single blanks.
STATES = " (?:licen[sc]ed (?:under|by|as)|(?:released|distributed|published|provided|offered|covered|governed) (?:under|by)|(?:use|used|using|redistribute) .{0,60}under|available under|under the terms|under an?|licen[sc]e|licen[sc]es|licen[sc]ing|spdx|lizenz|lizenziert|licencia|in the public domain|into the public domain|to the public domain|rights reserved|copyright) "
#: The same without words that also stand elsewhere, for licenses that none of the names confirms.
UNDER = "(?: (?:licen[sc]ed (?:under|by|as)|(?:released|distributed|published|provided|offered|covered|governed) (?:under|by)|available under|under the terms|under an?|spdx|lizenziert|sous licence|bajo una)|^ (?:licen[sc]e|lizenz|licencia)) "
SPEAKS = " (?:licen[sc]e|licen[sc]es|licen[sc]ed|licen[sc]ing|lizenz|lizenziert|licencia|agreement|terms|spdx) "
#: Fixed pattern of what may stand beside a name in a title.
BESIDE = "(?: (?:the|mit|licen[sc]e|version|v|[0-9]+|january|june|november|december|international|only|or|later|clause|text)){0,6} "
#: Fixed pattern of rights that are reserved, to the end of the sentence or by someone.
RESERVED = r"(?i)all\s+rights\s+(?:are\s+)?reserved(?=[^a-z0-9]*$|\s*[.;:,!)\n]|\s+(?:by|except|worldwide)\b)"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = "[a-z0-9]+"


#: Words that half of the random sentences hold.
CUES = ("license", "licence", "licensed", "lizenz", "lizenziert", "licencia", "copyright", "rights", "reserved", "public", "mit", "apache", "commons", "gnu")
#: Words that say nothing by themselves, only in pairs.
COMMON = frozenset("""under the of to and in a is that for it as was with be by on not at are this have from or an which you all will no may any can des de la le et les der die das und zu den von mit dem es ein une un el los una por con para que unter dieses werk ist est esta este obra bajo sous oder following except see use used made file note work terms note 2020 2019 2021""".split())


def words_of(text: str) -> list[str]:
    return re.findall(_WORD, text.translate(str.maketrans(_UPPER, _LOWER)))


def grams_of(words: list[str]) -> list[str]:
    """Words, then pairs of neighbours, each once."""
    return list(dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]))


def is_feature(gram: str) -> bool:
    return " " in gram or (gram not in COMMON and len(gram) > 1)


def examples() -> list[tuple[str, frozenset[str], int]]:
    """Text, its licenses (or UNKNOWN, or none) and the number of its frame."""
    out = []
    for k, (names, notices) in LICENSES.items():
        out += [(f.format(n), frozenset([k]), i) for n in names for i, f in enumerate(FRAMES)]
        out += [(f.format(n), frozenset([k]), i) for n in names if " " in n for i, f in enumerate(("{}", "{}.", "The {}", "{}, see below"))]
        out += [(form.format(n), frozenset([k]), i) for i, n in enumerate(notices) for form in ("{}", "{}.", "Note: {}.", "{} for any purpose.")]
    out += [(f.format(n), frozenset([UNKNOWN]), i) for n in OTHER_NAMES for i, f in enumerate(FRAMES)]
    named = [k for k, (names, _) in LICENSES.items() if names]
    for i, a in enumerate(named):
        for b in (named[(i + 1) % len(named)], named[(i + 5) % len(named)]):
            out.append((f"Dual licensed under the {LICENSES[a][0][0]} or the {LICENSES[b][0][0]}.", frozenset([a, b]), i))
            for x, y in ((0, -1), (-1, 0), (2, 2)):
                first, second = LICENSES[a][0][x % len(LICENSES[a][0])], LICENSES[b][0][y % len(LICENSES[b][0])]
                out.append((f"Dual licensed under {first} or {second}.", frozenset([a, b]), i))
                out.append((f"Licensed under {second} or {first}, whichever you prefer.", frozenset([a, b]), i))
            out.append((f"Licensed under either of {LICENSES[b][0][0]} and {LICENSES[a][0][-1]} at your option.", frozenset([a, b]), i))
    out += [(p, frozenset(), i) for i, p in enumerate(PLAIN)]
    out += [(f"{p} {PLAIN[(i * 7 + 3) % len(PLAIN)]}", frozenset(), i) for i, p in enumerate(PLAIN)]
    random, pool = np.random.default_rng(4), sorted({w for p in PLAIN for w in words_of(p)})
    for i, n in enumerate(random.integers(3, STRETCH + 1, RANDOM_SENTENCES)):
        words = random.choice(pool, n).tolist()
        words[n // 2] = CUES[i // 2 % len(CUES)] if i % 2 else words[n // 2]
        out.append((" ".join(words), frozenset(), i))
    return out


#: Licenses whose names are also ordinary words and so no titles.
COMMON_NAMES = ("public domain",)


@dataclass
class LicenseModel:
    licenses: list[str]
    weights: dict[str, list[float]]  # of each n-gram: for being a license at all, then for each license
    bias: list[float]
    templates: list[tuple[int, list[str]]]  # number of the license, word pairs of a notice

    def logits(self, words: list[str]) -> np.ndarray:
        return np.sum([self.bias, *(self.weights[g] for g in grams_of(words) if g in self.weights)], axis=0)

    def names(self, k: int) -> str:
        """Pattern of a license's names; that of the reserved rights is not one of words."""
        return "|".join(sorted({" ".join(words_of(n)) for n in LICENSES[self.licenses[k]][0]}, key=lambda n: (-len(n), n)))

    def named(self, text: str, line: str) -> list[bool]:
        """For each license whether a stretch, its words between blanks, names it in a statement or as a title; line: where it is one, its text."""
        out = []
        for k, own in enumerate(self.licenses):
            names = self.names(k)
            if not names:
                out.append(bool(re.search(RESERVED, line)) or (" all rights reserved " in text and " copyright " in text))
            else:
                title = re.search(f"^ (?:the )?(?:{names}){BESIDE}$", text) and (own not in COMMON_NAMES)
                out.append(bool(title) or bool(re.search(f" (?:{names}) ", text) and re.search(STATES, text)))
        return out

    def cues(self) -> list[str]:
        """Words and pairs such that all n-grams without any of them, together, do not make a license; begun with the heaviest.

        A common word is no cue, only its pairs are."""
        own = {g: w[0] for g, w in self.weights.items() if w[0] > 0}
        out: list[str] = []
        while self.bias[0] + sum(own.values()) >= 0:
            covers: dict[str, float] = {}
            for g, w in own.items():
                for c in {g, *g.split()}:
                    if is_feature(c):
                        covers[c] = covers.get(c, 0) + w
            out.append(max(sorted(covers), key=covers.get))
            own = {g: w for g, w in own.items() if out[-1] != g and out[-1] not in g.split()}
        return out

    def cue_pattern(self) -> str:
        return "(?i)(?<![a-z0-9])" + _any_of(self.cues()).replace(" ", "[^a-z0-9]+") + "(?![a-z0-9])"


def _any_of(words: list[str]) -> str:
    """A pattern of any of the words (letters, digits and blanks) that tells them apart character by character, so that a place is tried once for each first character."""
    rest: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        rest.setdefault(w[:1], []).append(w[1:])
    ends = rest.pop("", None) is not None
    each = [c + (_any_of(own) if own != [""] else "") for c, own in rest.items()]
    return each[0] if len(each) == 1 and not ends else f"(?:{'|'.join(each)}){'?' if ends else ''}" if each else ""


class _Presence:
    """A sparse 0/1 matrix, a list of columns for each row, and a last column of ones; the products that the fit needs."""

    def __init__(self, rows: list[list[int]], columns: int):
        sizes = np.array([len(r) + 1 for r in rows])
        self.column = np.concatenate([[*r, columns] for r in rows]).astype(np.int64)
        self.starts = np.cumsum(sizes) - sizes
        order = np.argsort(self.column, kind="stable")
        self.row = np.repeat(np.arange(len(rows)), sizes)[order]
        self.used, self.column_starts = np.unique(self.column[order], return_index=True)
        self.width = columns + 1

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.add.reduceat(w[self.column], self.starts, axis=0)

    def back(self, error: np.ndarray) -> np.ndarray:
        out = np.zeros((self.width, error.shape[1]), np.float32)
        out[self.used] = np.add.reduceat(error[self.row], self.column_starts, axis=0)
        return out


def _fitted(rows: list[list[int]], columns: int, y: np.ndarray, penalty: float = 3e-4, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of logistic regressions (a column of y each) with an L1 penalty, by accelerated proximal steps.

    Both sides of a column count alike. The first column's bias is held at NOTHING."""
    x = _Presence(rows, columns)
    share = np.where(y > 0, 0.5 / np.maximum(y.sum(axis=0), 1), 0.5 / np.maximum((1 - y).sum(axis=0), 1)).astype(np.float32)
    v = np.ones((x.width, y.shape[1]), np.float32)
    for _ in range(20):  # the largest curvature of each column by power iteration
        v = x.back(share * x.times(v))
        top = np.linalg.norm(v, axis=0)
        v /= top
    step = (4 / (1.1 * top)).astype(np.float32)
    w = np.zeros((x.width, y.shape[1]), np.float32)
    w[-1, 0] = NOTHING
    ahead, t = w, 1.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(x.times(ahead), -30, 30))) - y) * share
        new = ahead - step * x.back(error)
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        new[-1, 0] = NOTHING
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = (new + (t - 1) / t_new * (new - w)).astype(np.float32), new, t_new
    return w[:-1], w[-1]


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset with which a logistic of z fits y best, by Newton's method."""
    a = np.array([1.0, 0.0])
    m = np.stack([z, np.ones_like(z)], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(m @ a, -30, 30)))
        step = np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + 1e-3 * np.eye(2), m.T @ (p - y) + 1e-3 * (a - [1, 0]))
        a -= np.clip(step, -1, 1)
    return float(max(a[0], 0.1)), float(a[1])


@cache
def model() -> LicenseModel:
    """Learned from examples(), calibrated on folds that leave out licenses and frames; the same each time."""
    rows, licenses = examples(), list(LICENSES)
    grams = [grams_of(words_of(t)) for t, _, _ in rows]
    seen: dict[str, int] = {}
    for own in grams:
        for g in own:
            seen[g] = seen.get(g, 0) + 1
    at = {g: i for i, g in enumerate(sorted(g for g, n in seen.items() if n > 1 and is_feature(g)))}
    present = [[at[g] for g in own if g in at] for own in grams]
    y = np.array([[bool(k), *(name in k for name in licenses)] for _, k, _ in rows], np.float32)
    frame = np.array([f for _, _, f in rows])
    weights, bias = _fitted(present, len(at), y)
    z_all, y_all, gate = [], [], []
    folds = 4
    for fold in range(folds):
        new = np.array([j % folds == fold for j in range(len(licenses))])
        left_out = (y[:, 1:][:, new].any(axis=1)) | (frame % folds == fold)
        w, b = _fitted([r for r, out in zip(present, left_out) if not out], len(at), y[~left_out], rounds=70)
        z = _Presence([r for r, out in zip(present, left_out) if out], len(at)).times(np.vstack([w, b]))
        known = np.flatnonzero(~new)
        best = z[:, 1:][:, known].argmax(axis=1)
        z_all.append(z[np.arange(len(z)), 1 + known[best]])
        y_all.append(y[left_out][np.arange(len(z)), 1 + known[best]])
        gate.append((z[:, 0], y[left_out][:, 0]))
    slope, offset = _platt(np.concatenate(z_all), np.concatenate(y_all))
    gate_slope, gate_offset = _platt(np.concatenate([g for g, _ in gate]), np.concatenate([g for _, g in gate]))
    gate_offset = min(gate_offset, NOTHING / 2 - gate_slope * NOTHING)  # whatever has no n-gram in common with the examples is no license
    scale = np.array([gate_slope, *[slope] * len(licenses)])
    weights, bias = weights * scale, bias * scale + np.array([gate_offset, *[offset] * len(licenses)])
    used = {g: [round(float(v), 4) for v in weights[i]] for g, i in at.items() if np.abs(weights[i]).max() >= 5e-4}
    templates = []
    for j, (_, notices) in enumerate(LICENSES.values()):
        templates += [(j, pairs) for n in notices if len(words_of(n)) >= NOTICE and (pairs := [g for g in grams_of(words_of(n)) if " " in g])]
    return LicenseModel(licenses, used, [round(float(v), 4) for v in bias], templates)


def _literal(value, kind: str) -> Column:
    """A constant of any size in one expression, which the optimizer folds."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def find_licenses(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of each row of docs, and licenses: license, start, end, score and alike of each license of each paragraph, in order.

    score is the calibrated chance (for `unknown`, that it is a license at all), alike the largest share of a template's pairs."""
    own = model()
    cue = own.cue_pattern()
    vocabulary = _literal(sorted(own.weights), "array<string>")
    weights, bias = _literal(own.weights, "map<string,array<double>>"), _literal(own.bias, "array<double>")
    templates = _literal([[p for k, p in own.templates if k == j] for j in range(len(own.licenses))], "array<array<array<string>>>")
    names = F.array(*(F.lit(k) for k in own.licenses))
    text = F.coalesce(F.col("text"), F.lit(""))

    def pairs_of(words: Column) -> Column:
        n = F.greatest(F.size(words) - 1, F.lit(0))
        return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))

    def known_grams(words: Column) -> Column:
        """The model's n-grams among words and their pairs, with their weights: looked up once for all stretches of a paragraph."""
        hits = F.array_intersect(F.concat(words, pairs_of(words)), vocabulary)
        return F.transform(hits, lambda g: F.struct(g.alias("gram"), F.element_at(weights, g).alias("weights")))

    def logits(words: Column, pairs: Column, known: Column) -> Column:
        own = F.concat(words, pairs)
        return F.aggregate(F.filter(known, lambda h: F.array_contains(own, h["gram"])), bias, lambda a, h: F.zip_with(a, h["weights"], lambda x, y: x + y))

    def named(text: Column, line: Column) -> Column:
        """LicenseModel.named as an expression; names of a license are one pattern."""
        states, out = text.rlike(STATES), []
        for k, license in enumerate(own.licenses):
            names = own.names(k)
            if not names:
                out.append(line.rlike(RESERVED) | (F.contains(text, F.lit(" all rights reserved ")) & F.contains(text, F.lit(" copyright "))))
            else:
                title = F.lit(False) if license in COMMON_NAMES else text.rlike(f"^ (?:the )?(?:{names}){BESIDE}$")
                out.append(title | (text.rlike(f" (?:{names}) ") & states))
        return F.array(*out)

    def of_stretch(s: Column) -> Column:
        """The licenses of a stretch that states any: number (-1 for unknown), score, alike."""
        notices = F.transform(templates, lambda t: F.coalesce(F.array_max(F.transform(t, lambda p: F.size(F.array_intersect(p, s["pairs"])) / F.size(p))), F.lit(0.0)))
        text = F.concat(F.lit(" "), F.array_join(s["words"], " "), F.lit(" "))
        gate = 1.0 / (1.0 + F.exp(-F.element_at(s["z"], 1)))

        def chosen(x: Column) -> Column:
            each = F.transform(F.slice(s["z"], 2, len(own.licenses)), lambda z, k: F.struct(k.alias("k"), (1.0 / (1.0 + F.exp(-z))).alias("score"), F.greatest(F.get(x["notices"], k), F.get(x["named"], k).cast("double")).alias("alike"), F.get(x["notices"], k).alias("notice")))
            most = F.array_max(x["notices"])
            known = F.filter(each, lambda e: ((e["notice"] >= ALIKE) & (e["notice"] == most)) | ((e["score"] >= 0.5) & (e["alike"] >= ALIKE)))
            found = F.transform(known, lambda e: F.struct(*(e[c].alias(c) for c in ("k", "score", "alike"))))
            unknown = F.array(F.struct(F.lit(-1).alias("k"), gate.alias("score"), F.array_max(F.transform(each, lambda e: e["alike"])).alias("alike")))
            states = x["text"].rlike(UNDER) & x["text"].rlike(SPEAKS)
            return _let(found, lambda f: F.when(F.size(f) > 0, f).when(states, unknown).otherwise(F.slice(unknown, 1, 0)))

        return _let(F.struct(notices.alias("notices"), named(text, s["line"]).alias("named"), text.alias("text")), chosen)

    def stretches_of(words: Column, line: Column, known: Column, some=None) -> Column:
        """The stretches of words that pass the first regression: words, pairs, line, z and the number of the first word. some: from that number to whether a stretch is wanted.

        Only those with a cue can pass, so that the others are never scored."""
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (STRETCH - STEP), F.lit(1)), F.lit(STEP))
        cut = F.transform(F.filter(starts, some) if some else starts, lambda i: F.struct(i.alias("i"), F.slice(words, i, STRETCH).alias("words")))
        cued = F.filter(cut, lambda w: F.array_join(w["words"], " ").rlike(cue))
        paired = F.transform(cued, lambda w: F.struct(w["i"].alias("i"), w["words"].alias("words"), pairs_of(w["words"]).alias("pairs")))
        scored = F.transform(paired, lambda s: F.struct(s["i"].alias("i"), s["words"].alias("words"), s["pairs"].alias("pairs"), line.alias("line"), logits(s["words"], s["pairs"], known).alias("z")))
        return F.filter(scored, lambda s: F.element_at(s["z"], 1) >= 0)

    def merged(found: Column) -> Column:
        """Each license of a line once, with its largest score; unknown only where no other is."""
        most = lambda k, c: F.array_max(F.transform(F.filter(found, lambda s: s["k"] == k), lambda s: s[c]))
        named = lambda kinds: F.transform(F.array_sort(F.when(F.size(kinds) > 1, F.array_remove(kinds, -1)).otherwise(kinds)), lambda k: F.struct(k.alias("k"), most(k, "score").alias("score"), most(k, "alike").alias("alike")))
        return _let(F.array_distinct(F.transform(found, lambda s: s["k"])), named)

    def across(lines: Column, known: Column) -> Column:
        """The licenses of stretches that cross lines of a paragraph, each once: from its first to its last line."""
        words = F.flatten(F.transform(lines, lambda p: p["words"]))
        number = F.flatten(F.transform(lines, lambda p, i: F.array_repeat(i, F.size(p["words"]))))

        def placed(x: Column) -> Column:
            first = lambda i: F.element_at(x["number"], i)
            last = lambda i: F.element_at(x["number"], F.least(i + (STRETCH - 1), F.size(x["number"])))
            crossing = stretches_of(x["words"], F.lit(""), known, lambda i: F.coalesce(first(i) < last(i), F.lit(False)))
            spot = lambda s, f: F.struct(f["k"].alias("k"), F.get(lines, first(s["i"]))["start"].alias("start"), F.get(lines, last(s["i"]))["end"].alias("end"), f["score"].alias("score"), f["alike"].alias("alike"))
            return F.filter(F.flatten(F.transform(crossing, lambda s: F.transform(of_stretch(s), lambda f: spot(s, f)))), lambda f: f["k"] >= 0)

        def once(found: Column) -> Column:
            of = lambda k, c, f: f(F.transform(F.filter(found, lambda s: s["k"] == k), lambda s: s[c]))
            return F.transform(F.array_distinct(F.transform(found, lambda s: s["k"])), lambda k: F.struct(k.alias("k"), of(k, "start", F.array_min).alias("start"), of(k, "end", F.array_max).alias("end"), of(k, "score", F.array_max).alias("score"), of(k, "alike", F.array_max).alias("alike")))

        return F.when(F.size(lines) > 1, _let(_let(F.struct(words.alias("words"), number.alias("number")), placed), once))

    def of_paragraph(p: Column) -> Column:
        """The licenses of a paragraph (start, text) by line, and across lines where no line has them."""
        nothing = F.struct(p["start"].alias("at"), F.expr("cast(array() as array<struct<start:int,end:int,line:string>>)").alias("out"))

        def step(a: Column, line: Column) -> Column:
            end = a["at"] + F.char_length(line)
            return F.struct((end + 1).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("start"), end.alias("end"), line.alias("line")))).alias("out"))

        lines = F.aggregate(F.split(p["text"], "\n", -1), nothing, step, lambda a: a["out"])
        worded = F.transform(lines, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["line"].alias("line"), F.regexp_extract_all(F.translate(x["line"], _UPPER, _LOWER), F.lit(_WORD), F.lit(0)).alias("words")))
        by_line = lambda w, known: F.flatten(F.transform(F.filter(w, lambda x: x["line"].rlike(cue)), lambda x: F.transform(merged(F.flatten(F.transform(stretches_of(x["words"], x["line"], known), of_stretch))), lambda f: F.struct(f["k"].alias("k"), x["start"].alias("start"), x["end"].alias("end"), f["score"].alias("score"), f["alike"].alias("alike")))))

        def both(x: Column) -> Column:
            inside = lambda f, s: (f["start"] >= s["start"]) & (f["end"] <= s["end"])
            every = F.coalesce(x["wide"], F.slice(x["own"], 1, 0))
            wide = F.filter(every, lambda s: ~F.exists(x["own"], lambda f: (f["k"] == s["k"]) & inside(f, s)))
            single = F.filter(x["own"], lambda f: ~((f["k"] < 0) & F.exists(every, lambda s: inside(f, s))))
            return _let(F.concat(single, wide), lambda w: F.array_sort(F.transform(w, lambda f: F.struct(f["start"].alias("start"), f["k"].alias("k"), *(f[c].alias(c) for c in ("end", "score", "alike"))))))

        every = lambda w: known_grams(F.flatten(F.transform(w, lambda x: x["words"])))
        return _let(worded, lambda w: _let(every(w), lambda known: _let(F.struct(by_line(w, known).alias("own"), across(w, known).alias("wide")), both)))

    kind = "array<struct<license:string,start:int,end:int,score:double,alike:double>>"
    blank = r"\n\s*\n"
    ends = F.concat(F.array(F.lit(0)), F.transform(spans_of(text, blank, 0), lambda s: s["end"]))
    paragraphs = F.zip_with(ends, F.split(text, blank, -1), lambda start, t: F.struct(start.alias("start"), t.alias("text")))
    found = F.flatten(F.transform(F.filter(paragraphs, lambda p: p["text"].rlike(cue)), of_paragraph))
    listed = F.transform(found, lambda f: F.struct(F.when(f["k"] < 0, UNKNOWN).otherwise(F.get(names, f["k"])).alias("license"), *(f[c].alias(c) for c in ("start", "end", "score", "alike")))).cast(kind)
    return docs.select(*keep, F.when(text.rlike(cue), listed).otherwise(F.expr(f"cast(array() as {kind})")).alias("licenses"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_licenses(documents(spark, sf_dir))
    listed = F.transform("licenses", lambda s: F.concat_ws(":", s["license"], s["start"].cast("string"), s["end"].cast("string"), F.format_number(s["score"], 3), F.format_number(s["alike"], 3)))
    return found.select(
        "doc_id",
        F.size(F.array_distinct(F.transform("licenses", lambda s: s["start"]))).cast("long").alias("n_paragraphs"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda s: s["license"]))), ",").alias("licenses"),
        F.array_join(listed, ",").alias("spans"),
    )
