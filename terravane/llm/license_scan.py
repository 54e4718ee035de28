"""Licence scans: a trained paragraph classifier over sparse word n-grams, in DataFrame functions only on the data's path.

A paragraph is a block between blank lines; its wrapped lines are one run of words. It is read in overlapping windows of
``WINDOW`` words, so a notice inside a long unbroken text is read with its own neighbourhood only; most paragraphs are one window.
A multinomial logistic regression over n-grams of one to three words knows a class per licence family, one for ``unknown``
licences and one for prose. Features are indicators without a length in them: words that the model does not know change nothing.
``unknown`` is fitted on notices of families that have no class of their own and on frames such as ``licensed under the ... license``
with made-up names; the intercepts are fitted with the weights. The temperature is chosen on notices, families and prose that the fit has
not seen. A family is confirmed if the window shares enough word pairs with one of its templates; a second family in a window must have pairs that the first one's templates lack.

The fit is a bounded loop over the fixed texts below, on the driver. Its weights are constants of the plan (a hash set of
known n-grams and a table by hash), whatever the corpus, so texts are read once and never shuffled; only findings are.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Notices as the licences' own texts and their usual references word them.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
        "Apache License Version 2.0, January 2004",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
        "MIT License",
        "The MIT License (MIT)",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GPL v3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "GNU General Public License version 2",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Released under the LGPL.",
        "SPDX-License-Identifier: LGPL-2.1",
        "SPDX-License-Identifier: LGPL-3.0-or-later",
        "GNU Lesser General Public License",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "BSD 3-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Released under the BSD 2-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Creative Commons Attribution NonCommercial, no commercial use without permission, CC BY-NC.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "CC BY-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
        "Creative Commons Attribution NoDerivs, CC BY-ND.",
    ),
    "cc-by-nc-sa": (
        "Licensed under CC BY-NC-SA 4.0.",
        "CC BY-NC-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Creative Commons Attribution NonCommercial ShareAlike, CC BY-NC-SA.",
    ),
    "cc-by-nc-nd": (
        "Licensed under CC BY-NC-ND 4.0.",
        "CC BY-NC-ND 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.",
        "Creative Commons Attribution NonCommercial NoDerivs, CC BY-NC-ND.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Distributed under the terms of the Creative Commons Attribution License, CC BY.",
    ),
    "public-domain": (
        "This work is released into the public domain.",
        "This file is in the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights, CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain, the Unlicense.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this publication may be reproduced without prior written permission of the publisher.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
}
PROSE = "prose"
UNKNOWN = "unknown"
# Sentences that use the vocabulary without stating a licence.
PROSE_TEXTS = (
    "He lost his driving license after the third accident and had to take the bus to work.",
    "The software was released on Monday, and the public reaction was mostly kind.",
    "Version 3 of the plan was drawn up by the foundation and sent to every member of the committee.",
    "The general public is invited to the opening of the library, free of charge.",
    "A copy of the letter was found in a form that nobody could read.",
    "Permission to build the bridge was granted by the city in the spring.",
    "The source of the river lies in the mountains, and its use is governed by an old treaty.",
    "The terms of the agreement were never published, and the conditions of the sale remain unknown.",
    "Work on the house began in May and was completed under the supervision of the architect.",
    "The common attribution of the painting to his pupil is disputed.",
    "Commercial use of the port grew while international trade recovered.",
    "The rights of the workers were reserved for a later session of the parliament.",
    "This file of old photographs shows the domain of the family before the war.",
    "MIT students presented a new kind of battery at the conference.",
    "Apache helicopters were seen near the border, and mozilla was the name of an early browser.",
    "The creative writers of the commons room met on Fridays to share alike and laugh.",
    "The license plate was covered in mud.",
    "A hunting license costs ten dollars in this state.",
    "They distribute food and clothes under difficult conditions.",
    "The material is soft and the contributors to the fund were thanked in writing.",
    "The books were published under the old name of the house, and the source of the money stayed hidden.",
    "Version 2 of the program was shown to the public under a general title at the free fair.",
    "They worked under the terms of a contract with the foundation.",
    "He may use the file and copy the map for any purpose he likes.",
    "Under the terms of the act of 1884 the company held a license to dig for coal.",
    "A license to sell spirits was granted to the inn by the magistrate, and the fee was paid in silver.",
    "The station lost its license to broadcast under the new law.",
    "The ferry was run under a license of the county until the bridge was opened.",
    "Each license was granted for one season under the rules of the guild.",
    "The treaty was signed under the terms of an earlier convention.",
    "The right to operate the railway was granted by the crown in 1845.",
    "A license to operate a tavern was given to the widow of the captain.",
    "The charter of the market was granted under the terms of an act of 1790.",
    "A license under the act was needed to keep the inn open at night.",
)
# Notices of families without a class of their own, and frames around names that nobody knows: the class ``unknown``.
OTHER_NOTICES = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "You should have received a copy of the GNU Affero General Public License along with this program.",
    "Released under the AGPL.",
    "Licensed under the GNU Free Documentation License, version 1.3.",
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "Distributed under the Boost Software License, Version 1.0.",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
    "The contents of this file are subject to the terms of the Common Development and Distribution License.",
    "Released under the Artistic License 2.0.",
    "Licensed under the Elastic License 2.0 and the Server Side Public License, version 1.",
    "This source file is subject to version 3.01 of the PHP license.",
    "SPDX-License-Identifier: Zlib",
    "Licensed under the EUPL, Version 1.2 or later.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Licensed under the Microsoft Public License.",
    "Licensed under the Business Source License 1.1.",
    "Licensed under the Apache Software License, Version 1.1.",
    "The Apache Software License, Version 1.0",
)
FRAMES = (
    "Licensed under the {0} License.", "Released under the {0} License, version {1}.", "This project is licensed under the {0} {2} License {1}.", "Licensed under the {0}, Version {1}.",
    "This work is licensed under the {0} Public License, version {1}.", "Licensed under the {0} Public License {1}.", "SPDX-License-Identifier: {0}", "Released under the {0} license.",
    "This file is distributed under the terms of the {0} license.", "Use of this software is governed by the {0} License.", "Subject to the terms of the {0} Public License, v. {1}.",
)
# Seen by the calibration only: other wordings, other families, other prose.
HELD_NOTICES: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("Distributed under the Apache License 2.0, see the file for details.", "The code in this folder is available under the Apache License, version 2.0."),
    "mit": ("This code is available under the MIT License.", "MIT License Copyright 2020 the authors", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the Software without restriction."),
    "gpl": ("This file is part of a program under the GNU General Public License version 2 or later.", "It is free software, licensed under the GNU GPL v3."),
    "lgpl": ("You can redistribute this library under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-3.0-only"),
    "cc-by-nd": ("These texts are available under CC BY-ND 3.0.",),
    "cc-by-nc-sa": ("The recordings are published under CC BY-NC-SA 3.0.",),
    "cc-by-nc-nd": ("The essays are available under CC BY-NC-ND 3.0.",),
    "bsd": ("Licensed under the 3-clause BSD license.", "Redistributions of source code must retain the above; redistribution and use in source and binary forms are permitted."),
    "mpl-2.0": ("This file is covered by the Mozilla Public License 2.0.",),
    "cc-by-nc": ("These photos are available under CC BY-NC 3.0.",),
    "cc-by-sa": ("Content is available under the Creative Commons Attribution-ShareAlike 3.0 License.",),
    "cc-by": ("The data are available under a Creative Commons Attribution 4.0 License.",),
    "public-domain": ("The author has placed this work in the public domain.",),
    "proprietary": ("Copyright 2019 by the publisher. All rights reserved.",),
}
HELD_OTHER = (
    "Licensed under the Open Software License version 3.0.", "Licensed under the CeCILL License.", "SPDX-License-Identifier: NCSA", "Made available under the Open Database License.",
    "Released under the University of Illinois Open Source License.", "Licensed under the Academic Free License version 2.1.", "This program is licensed under the Vovida Software License.",
)
HELD_PROSE = (
    "She renewed her license at the office and went home.", "The work was modified by two later painters.", "A public version of the report was distributed to the press.",
    "The foundation published three books on free trade.", "All the seats had been reserved since spring.", "The notice on the door said that the library was closed.",
    "Copies of the map were sold without the names of the streets.", "The source of the noise was a binary star.", "Rights of way cross the domain.", "He was granted a permit to sell fish.", "A license to run trains was granted under the act of 1846.", "The mill stood under the terms of an old lease.",
)
STOP = frozenset(
    "a an and any are as at be by can for from has have in into is it its may most no not of on one or part that the their then these this to until was were while with without you your".split()
)
_CUT = r"[^a-z0-9]+"
_BLANK = r"\n[\x20\t\x0B\f]*(?:\n[\x20\t\x0B\f]*)+"
WINDOW, STRIDE, LONGEST = 64, 32, 3


def tokens_of(text: str) -> list[str]:
    """The same cut as in ``scan``; an empty string can stand at either end."""
    return re.split(_CUT, text.lower())


def ngrams_of(tokens: list[str]) -> list[tuple[str, ...]]:
    """Distinct n-grams that start with a word that is no stop word, in order."""
    found = [tuple(tokens[i : i + n]) for i, t in enumerate(tokens) if t and t not in STOP for n in range(1, LONGEST + 1) if i + n <= len(tokens) and tokens[i + n - 1]]
    return list(dict.fromkeys(found))


@dataclass(frozen=True)
class Model:
    """weights: n-gram -> a weight per class. Class 0 is prose, class 1 unknown."""

    classes: tuple[str, ...]
    weights: dict[tuple[str, ...], tuple[float, ...]]
    intercepts: tuple[float, ...]
    temperature: float


def _examples(seed: int) -> list[tuple[list[str], str]]:
    """(tokens, class): the templates, fragments of them, the other notices and frames, prose, and words of notices out of their places."""
    rng, out = random.Random(seed), []
    filler = lambda: f"\x00{rng.randrange(10**9)}"  # a word of no vocabulary

    def put(text: str, name: str) -> None:
        out.append((tokens_of(text), name))

    for name, texts in [*TEMPLATES.items(), (UNKNOWN, OTHER_NOTICES)]:
        for text in texts:
            put(text, name)
            put(rng.choice(PROSE_TEXTS) + " " + text, name)
            put(text + " " + rng.choice(PROSE_TEXTS), name)
            cut = text.split()
            for _ in range(5 if len(cut) > 7 else 0):
                size = rng.randint(max(7, len(cut) // 2), len(cut))
                at = rng.randint(0, len(cut) - size)
                put(" ".join(cut[at : at + size]), name)
    for frame in FRAMES:
        for _ in range(6):
            words = tokens_of(frame.format("q", f"{rng.randint(1, 4)}.{rng.randint(0, 2)}", "r"))
            out.append(([filler() if w in ("q", "r") else w for w in words], UNKNOWN))
    for text in PROSE_TEXTS:
        put(text, PROSE)
        put(text + " " + rng.choice(PROSE_TEXTS), PROSE)
        cut = text.split()
        put(" ".join(cut[: len(cut) // 2]), PROSE)
        put(" ".join(cut[len(cut) // 2 :]), PROSE)
    known = sorted({w for texts in [*TEMPLATES.values(), OTHER_NOTICES] for t in texts for w in tokens_of(t) if w and w not in STOP})
    for word in known:  # a single word of a notice is no notice, nor are a few in other places
        out.append(([word], PROSE))
        out.append(([x for w in [word, *rng.sample(known, rng.randint(1, 3))] for x in (w, filler())], PROSE))
    out += [([filler()], PROSE)] * 40
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@lru_cache(maxsize=4)
def train(seed: int = 11, steps: int = 400, decay: float = 2e-3, least: int = 2) -> Model:
    """Accelerated gradient descent on the L2-regularised log-loss of the fixed examples, intercepts included; then a temperature by held-out ones."""
    classes = (PROSE, UNKNOWN, *TEMPLATES)
    rows = [(ngrams_of(tokens), classes.index(name)) for tokens, name in _examples(seed)]
    often = Counter(g for grams, _ in rows for g in grams if not any(w.startswith("\x00") for w in g))
    names = sorted(g for g, n in often.items() if n >= least)
    number = {g: i for i, g in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for r, (grams, _) in enumerate(rows):
        x[r, [number[g] for g in grams if g in number]] = 1.0
    y = np.eye(len(classes))[[c for _, c in rows]]
    size = y.sum(axis=0)
    each = (y / np.sqrt(size)).sum(axis=1)  # rare classes count more, but not as much as frequent ones together
    each /= each.sum()
    w, b = np.zeros((len(names), len(classes))), np.zeros(len(classes))
    past_w, past_b, rate = w.copy(), b.copy(), 1.0
    for step in range(steps):
        ahead = step / (step + 3)
        at_w, at_b = w + ahead * (w - past_w), b + ahead * (b - past_b)
        gap = (_softmax(x @ at_w + at_b) - y) * each[:, None]
        past_w, past_b = w, b
        w, b = at_w - rate * (x.T @ gap + decay / 100 * at_w), at_b - rate * gap.sum(axis=0)
    w, b = np.round(w, 5), np.round(b, 5)
    held = [(t, c) for c, texts in [*HELD_NOTICES.items(), (UNKNOWN, HELD_OTHER), (PROSE, HELD_PROSE)] for t in texts]
    z = np.array([b + sum((w[number[g]] for g in ngrams_of(tokens_of(t)) if g in number), np.zeros(len(b))) for t, _ in held])
    truth = [classes.index(c) for _, c in held]

    def loss(t: float) -> float:
        return -float(np.log(np.maximum(_softmax(z / t)[np.arange(len(held)), truth], 1e-12)).sum())

    temperature = min((2 ** (k / 8) for k in range(-24, 33)), key=loss)
    return Model(classes, {g: tuple(w[i].tolist()) for g, i in number.items()}, tuple(b.tolist()), temperature)


def gram_hash(gram: tuple[str, ...]) -> int:
    """Spark's ``xxhash64`` of the words as columns, signed."""
    h = 42
    for word in gram:
        h = xxhash.xxh64_intdigest(word.encode(), h)
    return h - (1 << 64) if h >= 1 << 63 else h


def _numbers(values: list, kind: str) -> Column:
    """A constant array; split and cast fold to one literal."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


def paragraphs(docs: DataFrame) -> DataFrame:
    """(row, doc_id, paragraph, block): the blocks between blank lines of whole texts, numbered from 0; ``row`` tells rows apart that repeat an id."""
    lines = F.replace(F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    blocks = F.filter(F.split(lines, _BLANK), lambda b: F.btrim(b, F.lit(" \n\t\x0b\f")) != "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("row", "doc_id", F.posexplode(blocks).alias("paragraph", "block"))


def scan(docs: DataFrame, confident: float = 0.6, confirm: float = 0.5, seed: int = 11) -> DataFrame:
    """documents -> (doc_id, paragraph, family, probability, template, template_similarity, confirmed, start_word, text), a row per paragraph and family found in it.

    family is a licence family or ``unknown``: the class ``unknown`` is the best one, or the best family stays below ``confident``.
    A paragraph of several windows tells each family once, by its most probable window (to nine digits), ties to the first. Beside the best family, a
    window tells every other one that outweighs both prose and unknown, is confirmed and has evidence of its own: of the word pairs of one of its templates that no template of the best family has, the window holds
    at least the share ``confirm``. Its probability is taken against prose and unknown. ``unknown`` is told only where the paragraph holds no family.
    template is the number of the nearest template of the family (null for unknown), template_similarity the share of the
    shorter one's word pairs that both hold, ties to the first template. start_word is the window's first word in the paragraph, counted as ``tokens_of`` counts, and text the window's lower-cased words.
    Null and empty texts have no paragraph. Repeated rows give their findings once for each; null ids are ids like others. Other columns are not read. No rows give no rows.
    """
    model = train(seed)
    n, depth = len(model.classes), 1 << max(4, len(model.weights).bit_length() + 2)
    # the known n-grams in the order of their buckets: bucket k holds entries firsts[k] to firsts[k + 1] - 1
    entries = sorted(((gram_hash(g), w) for g, w in model.weights.items()), key=lambda e: (e[0] % depth, e[0]))
    held = Counter(h % depth for h, _ in entries)
    firsts = [0, *accumulate(held.get(k, 0) for k in range(depth))]
    keys, first = _numbers([h for h, _ in entries], "bigint"), _numbers(firsts, "int")
    weight = _numbers([x for _, w in entries for x in w], "double")
    # what an n-gram can at most add to a class over prose: windows that cannot reach any class are left early, exactly
    reach = _numbers([max(max(w[1:]) - w[0], 0.0) for _, w in entries], "double")
    needed = model.intercepts[0] - max(model.intercepts[1:])
    starts = sorted({g[0] for g in model.weights})
    known_hashes = [h for h, _ in entries]

    tokens = paragraphs(docs).select("row", "doc_id", "paragraph", F.split(F.lower("block"), _CUT).alias("tokens"))
    last = F.greatest(F.lit(0), F.ceil((F.size("tokens") - WINDOW) / STRIDE).cast("int"))
    cut = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(F.col("tokens"), k * STRIDE + 1, WINDOW))
    some = F.when(F.exists("tokens", lambda t: t.isin(starts)), cut)
    windows = tokens.select("row", "doc_id", "paragraph", F.posexplode(some).alias("window", "words"))

    def grams(t: Column, i: Column) -> Column:
        word = lambda k: F.get(F.col("words"), i + k)
        # past the end there is no word, and xxhash64 of a null leaves the hash as it is: the shorter n-gram once more
        return F.when(t.isin(starts), F.array(*[F.xxhash64(*[word(k) for k in range(m)]) for m in range(1, LONGEST + 1)])).otherwise(F.array().cast("array<bigint>"))

    hits = windows.select(
        "row", "doc_id", "paragraph", "window", "words",
        F.array_distinct(F.filter(F.flatten(F.transform("words", grams)), lambda h: h.isin(known_hashes))).alias("hits"),
    )

    def entry(h: Column) -> Column:
        bucket = F.pmod(h, F.lit(depth)).cast("int")
        at = F.get(first, bucket)
        return (at + F.array_position(F.slice(keys, at + 1, F.get(first, bucket + 1) - at), h) - 1).cast("int")

    # each step is carried on beside the next, so that the optimiser computes it once and does not copy it into a lambda
    found = hits.select("row", "doc_id", "paragraph", "window", "words", "hits", F.transform("hits", entry).alias("entries"))
    weighed = found.select("*", F.aggregate("entries", F.lit(0.0), lambda a, e: a + F.get(reach, e)).alias("most"))
    logit = lambda k: (F.lit(model.intercepts[k]) + F.aggregate("entries", F.lit(0.0), lambda a, e: a + F.get(weight, e * n + k))) / model.temperature
    able = weighed.select("*", F.when(F.col("most") > needed, F.array(*[logit(k) for k in range(n)])).alias("z"))
    top = able.select("*", F.array_max("z").alias("top"))
    scored = top.select("*", (F.array_position("z", F.col("top")) - 1).cast("int").alias("best"), F.aggregate("z", F.lit(0.0), lambda a, z: a + F.exp(z - F.col("top"))).alias("whole"))
    names = F.array(*[F.lit(c) for c in model.classes])

    def claim(k: int) -> Column:
        z = F.get("z", F.lit(k))
        best = F.col("best") == k
        apart = F.exp(F.get("z", F.lit(0)) - z) + F.exp(F.get("z", F.lit(1)) - z)
        told = F.struct(F.lit(k).alias("k"), best.alias("best"), F.col("best").alias("leader"), F.when(best, 1 / F.col("whole")).otherwise(1 / (1 + apart)).alias("probability"))
        return F.when(best | (F.lit(k > 1) & (z > F.get("z", F.lit(0))) & (z > F.get("z", F.lit(1)))), told)

    claims = F.when(F.col("best") > 0, F.array_compact(F.array(*[claim(k) for k in range(1, n)])))
    claimed = scored.select("row", "doc_id", "paragraph", "window", "words", F.explode(claims).alias("claim")).select(
        "row", "doc_id", "paragraph", "window", "words", "claim.*",
        F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.get("words", i - 1), F.get("words", i)))).alias("pairs"),
    )
    # what the best family's templates hold is no evidence for another
    led = F.array(*[F.array(*[F.lit(p) for p in family_pairs(c)]).cast("array<string>") for c in model.classes])
    claimed = claimed.withColumn("led", F.get(led, F.col("leader")))
    options, owned = [], []
    for family, texts in TEMPLATES.items():
        for i, text in enumerate(texts):
            pairs = template_pairs(text)
            told_apart = F.array_except(F.array(*[F.lit(p) for p in pairs]), F.col("led"))
            own = F.size(F.array_intersect("pairs", told_apart)) / F.greatest(F.size(told_apart), F.lit(1))
            owned.append(F.when(F.get(names, F.col("k")) == family, own.cast("double")))
            shared = F.size(F.array_intersect("pairs", F.array(*[F.lit(p) for p in pairs])))
            share = shared / F.greatest(F.least(F.size("pairs"), F.lit(len(pairs))), F.lit(1))
            options.append(F.when(F.get(names, F.col("k")) == family, F.struct(share.cast("double").alias("similarity"), F.lit(-i).alias("back"))))
    near = claimed.withColumn("near", F.array_max(F.array_compact(F.array(*options)))).withColumn("own", F.array_max(F.array_compact(F.array(*owned))))
    sure = F.col("probability") >= confident
    family = F.when(sure, F.get(names, F.col("k"))).otherwise(F.lit(UNKNOWN))
    is_family = (F.col("k") > 1) & sure
    similarity = F.coalesce("near.similarity", F.lit(0.0))
    told = near.select(
        "row", "doc_id", "paragraph", "best", family.alias("family"),
        F.struct(
            F.round("probability", 9).alias("probability"), (-F.col("window")).alias("back"), F.when(F.col("k") > 1, -F.col("near.back")).alias("template"), similarity.alias("template_similarity"),
            (is_family & (similarity >= confirm)).alias("confirmed"), F.array_join("words", " ").alias("text"),
        ).alias("said"), "own",
    ).where(F.col("best") | (F.col("said.confirmed") & (F.col("own") >= confirm)))
    per = told.groupBy("row", "doc_id", "paragraph", "family").agg(F.max("said").alias("said"))
    # at most one row a family in each of these partitions
    families = F.sum(F.when(F.col("family") != UNKNOWN, 1).otherwise(0)).over(Window.partitionBy("row", "paragraph"))
    return per.withColumn("families", families).where((F.col("family") != UNKNOWN) | (F.col("families") == 0)).select(
        "doc_id", "paragraph", "family", "said.probability", "said.template", "said.template_similarity", "said.confirmed", (-F.col("said.back") * STRIDE).alias("start_word"), "said.text"
    )


def template_pairs(text: str) -> list[str]:
    t = tokens_of(text)
    return sorted({f"{a} {b}" for a, b in zip(t, t[1:], strict=False)})


def family_pairs(family: str) -> list[str]:
    """The word pairs of all templates of a family; none for prose and unknown."""
    return sorted({p for text in TEMPLATES.get(family, ()) for p in template_pairs(text)})
