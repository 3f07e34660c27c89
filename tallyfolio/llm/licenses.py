"""Licence scan: Dice coefficient of word bigrams between a document's passages and licence templates.

A passage is a line, the whole text where it has several lines, or a run of words. It is lower-cased and cut into runs
of letters and digits. Dice = 2 |A and B| / (|A| + |B|) over the sets of word bigrams. It can reach t only
if A holds t / (2 - t) of B. So of any 1 - t / (2 - t) of a template's bigrams, and one more, a passage that
matches has one: a document without any of these anchors matches nothing and is not looked at again. The
others meet the templates they hold enough bigrams of, a table of fixed size.

Runs are windows of the words of the text, across lines and inside them, for wrapped, embedded and longer
notices. Per template they start at every bigram of it and have every length that can match, if it has fewer
than ``2 * STEPS`` bigrams; else at one in each step of 1 / ``STEPS`` of its bigrams, as do lengths. Then a window
holds a passage of Dice d with at most two steps beside it, and has a Dice of 0.94 d or more: a passage of
0.85 is always found, one between 0.8 and 0.85 may be missed if it is long and neither a line nor the whole
text. Of windows that overlap, the best is the passage. One inside a line that matches by itself is none; one
that touches such a line, or is in a text that matches as a whole, can be the best match and isn't counted again.

Templates are short notices (``TEMPLATES``), standard headers and full texts (``TEXTS``). No full texts are
there for AGPL-3.0, CC-BY-NC-4.0 and CC-BY-SA-4.0.

Only built-in functions. Null, empty or one-word texts match nothing. Ties go to the smallest template
name, then the first passage. Repeated rows count as one document (per id, the best match over all its
rows). A null id is a document like any other. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
STEPS = 20

# Wordings of licence notices, by SPDX identifier.
TEMPLATES = [
    ("AGPL-3.0", "This program is free software under the GNU Affero General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License, version 3."),
    ("ISC", "Released under the ISC License."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


_GNU = (
    "This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2} as published by the "
    "Free Software Foundation{3}"
)
_LATER = "either version {0} of the License, or (at your option) any later version."
_WARRANTY = (
    " This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} for more details."
)
_GOT = " You should have received a copy of the GNU {1} along with this {0}. If not, see <https://www.gnu.org/licenses/>."


def _gnu_headers() -> list[tuple[str, str]]:
    """The FSF's headers: the sentence alone, and with the disclaimer."""
    found = []
    for spdx, what, name, version in (
        ("AGPL-3.0", "program", "Affero General Public License", "3"),
        ("GPL-2.0", "program", "General Public License", "2"),
        ("GPL-3.0", "program", "General Public License", "3"),
        ("LGPL-3.0", "library", "Lesser General Public License", "3"),
    ):
        for later in (_LATER.format(version), f"version {version} of the License."):
            first = _GNU.format(what, ":", name, ", " + later)
            found += [(spdx, first), (spdx, first + _WARRANTY.format(what, name) + _GOT.format(what, name))]
    return found


# Standard headers and canonical texts, by SPDX identifier.
TEXTS = [
    *_gnu_headers(),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    *((p.stem, p.read_text(encoding="utf-8")) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))),
]
# The paragraph that grants the MIT licence stands alone too.
TEXTS += [(name, text.split("\n\n")[0]) for name, text in TEXTS if name == "MIT" and "\n\n" in text]

COMMON = frozenset("the of to and or a an in is for by with any this that be not on as are from under it its you your such may at no if all".split())


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def _pairs(words: Column) -> Column:
    """The pairs of neighbouring words."""
    return F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1))
    )


def _with(df: DataFrame, name: str, value: Column) -> DataFrame:
    """A column that is computed once; a plain one could be computed again for every element that uses it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def size_range(n: int, threshold: float) -> tuple[int, int]:
    """The sizes that can reach the threshold beside a set of n."""
    low, high = n * threshold / (2 - threshold), n * (2 - threshold) / threshold
    return max(1, math.ceil(low - 1e-9)), math.floor(high + 1e-9)


def _table(docs: DataFrame, templates: list[tuple[str, str]], threshold: float) -> tuple[DataFrame, list[str]]:
    """One row with all templates, and their anchors: of each template so many of its rarest bigrams, by the
    look of them, that every passage that can match holds one."""
    rows, anchors = [], set()
    for name, wording in templates:
        words = "".join(c if c.isascii() and c.isalnum() else " " for c in wording.lower()).split()
        pairs = sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})
        if not pairs:
            continue
        n = len(pairs)
        least = size_range(n, threshold)
        need = least[0]
        rows.append((name, pairs, n, need, least[1], math.ceil((len(words) - 1) * (2 - threshold) / threshold), max(1, n // STEPS)))
        rare = sorted(pairs, key=lambda p: (sum(w in COMMON for w in p.split()), -len(p), p))
        anchors.update(rare[: n - need + 1])
    kind = "license: string, pairs: array<string>, n: int, need: int, most: int, longest: int, step: int"
    return docs.sparkSession.createDataFrame([(rows,)], f"templates array<struct<{kind}>>"), sorted(anchors)


def scan_licenses(
    docs: DataFrame, id: str = "doc_id", text: str = "text", templates: list[tuple[str, str]] = TEMPLATES + TEXTS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per document: id, ``license`` of the best match (null: none), its ``dice``, its ``line_no`` (0: the
    whole text) and ``n_notices``, the number of passages that match some template."""
    table, anchors = _table(docs, templates, threshold)
    rows = _with(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), "words", _words(F.col("text")))
    listed = ", ".join(f"'{a}'" for a in anchors)
    rows = rows.filter(F.expr(
        "exists(transform(slice(words, 1, greatest(size(words) - 1, 0)), (w, i) -> concat(w, ' ', get(words, i + 1))), "
        f"p -> p in ({listed or 'null'}))"
    ))
    rows = _with(rows.select("id", "text", "words"), "pairs", _pairs(F.col("words"))).crossJoin(F.broadcast(table))
    enough = F.filter("templates", lambda t: F.size(F.array_intersect("pairs", t["pairs"])) >= t["need"])
    rows = _with(rows, "candidates", enough).filter(F.size("candidates") > 0).drop("templates", "words")
    rows = _with(rows, "lines", F.transform(F.split("text", "\n", -1), _words)).drop("text")

    def scored(mine: Column, t: Column) -> Column:
        return F.lit(-2.0) * F.size(F.array_intersect(mine, t["pairs"])) / (F.size(mine) + t["n"])

    single = F.transform("lines", lambda x, i: F.struct((i + 1).alias("line_no"), F.array_distinct(_pairs(x)).alias("mine")))
    whole = F.struct(F.lit(0).alias("line_no"), F.array_distinct("pairs").alias("mine"))
    rows = _with(rows, "passages", F.when(F.size("lines") > 1, F.concat(F.array(whole), single)).otherwise(single))

    def match(p: Column) -> Column:
        fits = F.filter("candidates", lambda t: F.size(p["mine"]).between(t["need"], t["most"]))
        return F.array_min(
            F.transform(fits, lambda t: F.struct(scored(p["mine"], t).alias("minus"), t["license"].alias("license"), p["line_no"].alias("line_no")))
        )

    rows = _with(rows, "hits", F.filter(F.transform("passages", match), lambda h: h["minus"] <= -threshold)).drop("passages")

    def starts(t: Column) -> Column:
        """In each step the first bigram of the template, if a window from there can hold enough of it."""
        cell = lambda i: F.sequence(i, F.least(i + t["step"], F.size("pairs")) - 1)
        first = lambda i: F.array_min(F.filter(cell(i), lambda j: F.array_contains(t["pairs"], F.get("pairs", j))))
        held = lambda i: F.size(F.array_intersect(F.slice("pairs", i + 1, t["longest"]), t["pairs"])) >= t["need"]
        steps = F.transform(F.sequence(F.lit(0), F.size("pairs") - 1, t["step"]), first)
        return F.filter(steps, lambda i: i.isNotNull() & held(i))

    def window(t: Column, i: Column, n: Column) -> Column:
        mine = F.array_distinct(F.slice("pairs", i + 1, n))
        stop = F.least(i + n, F.size("pairs"))
        return F.struct(scored(mine, t).alias("minus"), t["license"].alias("license"), i.alias("start"), stop.alias("stop"))

    def best(t: Column) -> Column:
        lengths = F.sequence(t["need"], t["longest"] + t["step"] * 2, t["step"])
        return F.transform(starts(t), lambda i: F.array_min(F.transform(lengths, lambda n: window(t, i, n))))

    windows = F.filter(F.flatten(F.transform("candidates", best)), lambda h: h["minus"] <= -threshold)
    rows = _with(rows, "windows", F.array_sort(windows))
    apart = F.aggregate(
        "windows", F.slice("windows", 1, 0),
        lambda kept, h: F.when(
            F.exists(kept, lambda k: (k["start"] < h["stop"]) & (h["start"] < k["stop"])), kept
        ).otherwise(F.concat(kept, F.array(h))),
    )
    rows = _with(rows, "at", F.flatten(F.transform("lines", lambda x, i: F.transform(x, lambda _: i + 1))))
    placed = F.transform(apart, lambda h: F.struct(
        h["minus"].alias("minus"), h["license"].alias("license"), F.get("at", h["start"]).alias("line_no"), F.get("at", h["stop"]).alias("last")
    ))
    rows = _with(rows, "runs", placed)
    within = lambda r: F.exists("hits", lambda h: (h["line_no"] == r["line_no"]) & (h["line_no"] == r["last"]))
    touched = lambda r: F.exists("hits", lambda h: (h["line_no"] == 0) | h["line_no"].between(r["line_no"], r["last"]))
    more = F.transform(F.filter("runs", lambda r: ~within(r)), lambda r: F.struct(r["minus"].alias("minus"), r["license"].alias("license"), r["line_no"].alias("line_no")))
    found = rows.select(
        "id", F.array_min(F.concat("hits", more)).alias("hit"),
        (F.size("hits") + F.size(F.filter("runs", lambda r: ~touched(r)))).alias("n"),
    )
    ids = docs.select(F.col(id).alias("id"), F.lit(None).cast(found.schema["hit"].dataType).alias("hit"), F.lit(0).alias("n"))
    return ids.unionByName(found).groupBy("id").agg(F.min("hit").alias("hit"), F.sum("n").alias("n_notices")).select(
        F.col("id").alias(id),
        F.col("hit.license").alias("license"),
        (-F.col("hit.minus")).alias("dice"),
        F.col("hit.line_no").cast("long").alias("line_no"),
        "n_notices",
    )
